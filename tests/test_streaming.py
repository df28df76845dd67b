"""Streaming merges over several micro-batches equal the batch result."""

from pyspark.sql import functions as F

from cadenza.operators import derived as D
from cadenza.sources.buckets import BucketedTable, latest_manifest, write_manifest
from cadenza.streaming import counters as C

from .conftest import SMALL

ORDER = ["ts", "event_id"]


def steps():
    t = F.col("event_type")
    return {"likes": F.when(t == "click", 1).when(t == "error", -1), "comments": F.when(t == "purchase", 1)}


def by_hand(rows):
    """{item: (likes, comments)} taken event by event."""
    out = {}
    for r in sorted(rows, key=lambda r: (r.ts, r.event_id)):
        likes, comments = out.get(r.item, (0, 0))
        out[r.item] = (max(likes + {"click": 1, "error": -1}.get(r.event_type, 0), 0), comments + (r.event_type == "purchase"))
    return out


def timed_files(events, folder, n):
    """Events cut by time into ``n`` files, the earliest written first."""
    import time
    cuts = events.approxQuantile("event_id", [i / n for i in range(n + 1)], 0.0)
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        upper = F.col("event_id") <= b if i == n - 1 else F.col("event_id") < b
        events.filter((F.col("event_id") >= a) & upper).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)


def test_several_epochs_equal_batch(spark, tmp_path):
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    flat = str(tmp_path / "flat")
    timed_files(events, flat, 3)                    # three files = three micro-batches with maxFilesPerTrigger=1
    item = F.get_json_object("props", "$.k").cast("long")
    stream = C.file_stream(spark, flat, "part-*.parquet", events.schema, max_files=1).withColumn("item", item)
    got = C.floored_counter_stream(stream, "item", steps(), ORDER, "t", run_dir=str(tmp_path / "run"), buckets=4)
    got = {r["item"]: (r["likes"], r["comments"]) for r in got.collect()}
    rows = events.withColumn("item", item)
    batch = D.item_counters(rows, "item", "event_type", "user_id", ORDER, like="click", unlike="error", listen="view", comment="purchase")
    want = by_hand(rows.collect())
    assert {r["item"]: (r["likes"], r["comments"]) for r in batch.collect()} == want
    assert {k: got.get(k, (0, 0)) for k in want} == want
    versions = sorted(p.name for p in (tmp_path / "run" / "table").iterdir())
    assert len(versions) == 3                       # one folder per epoch, touched buckets only


def test_one_hot_item_lies_in_many_slots(spark):
    rows = [(i, i // 3, "click" if (i * 7919) % 5 < 2 else "error") for i in range(3000)]
    events = spark.createDataFrame(rows, "event_id long, at long, event_type string").withColumn("ts", F.timestamp_seconds("at")) \
        .withColumn("item", F.lit(1))
    slots = events.withColumn("slot", D._time_slot(events, "ts", 32)).groupBy("slot").count().collect()
    assert len(slots) == 32 and max(r["count"] for r in slots) < 300
    got = D.floor_moves(events, "item", steps(), ORDER).select(D.floored("likes").alias("n"), D.floored("likes", 7).alias("from7")).first()
    want = [0, 7]
    for r in sorted(rows):
        want = [max(w + (1 if r[2] == "click" else -1), 0) for w in want]
    assert [got.n, got.from7] == want


def test_unlike_before_like(spark):
    events = spark.createDataFrame([(1, 1, "error"), (2, 1, "click"), (1, 2, "click"), (2, 2, "error"), (3, 2, "error"), (4, 2, "click"),
                                    (1, None, "click")], "at long, item long, event_type string")
    assert dict(map(tuple, D.signed_counter(events, "item", "event_type", ["at"], "click").collect())) == {1: 1, 2: 1}


def test_an_epoch_that_is_run_again(spark, tmp_path):
    moves = D.floor_moves(spark.createDataFrame([(1, 1, "error"), (2, 1, "click"), (3, 1, "click")], "at long, item long, event_type string"),
                          "item", {"likes": steps()["likes"]}, ["at"])
    table = BucketedTable(spark, str(tmp_path / "t"), ["item"], moves.schema, 4)

    def then(old, new, _):
        return D.then_moves(old, new, "item", ["likes"])

    for epoch in (0, 1, 1, 1):                      # epoch 1 three times: as if once
        table.merge(moves, epoch, then)
    assert [r.n for r in table.read().select(D.floored("likes").alias("n")).collect()] == [3]


def test_manifest_roundtrip(spark, tmp_path):
    base = str(tmp_path / "m")
    assert latest_manifest(spark, base) == (-1, {})
    write_manifest(spark, base, 3, {1: "/a", 0: "/b"})
    write_manifest(spark, base, 12, {1: "/c"})
    assert latest_manifest(spark, base) == (12, {1: "/c"})
