"""Streaming queries: drained with availableNow, result = the upserted table.

Their oracles are the batch SQL of the same counters: streaming result =
batch result is the equivalence the re-aim promises.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import counters as C
from .common import T, rnd
from .quality import EVENT_RULES
from .registry import query
from .warehouse import STEPS, like_and_comment


def _events_stream(spark, sf_dir):
    schema = T(spark, sf_dir, "events").schema
    return C.file_stream(spark, sf_dir, "events.parquet", schema)


def _item_events(events):
    return events.withColumn("item", F.get_json_object("props", "$.k").cast("long"))


@query("stream_item_counters", ("STR-01", "DRV-06", "DRV-08", "UPS-03"), f"""
WITH e AS (SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS item, event_type, ts, event_id FROM events)
SELECT item, {STEPS.format(up='click', down='error')} AS likes, {STEPS.format(up='purchase', down='signup')} AS comments
FROM e WHERE item IS NOT NULL AND event_type IN ('click', 'error', 'purchase', 'signup') GROUP BY item
""")
def stream_item_counters(spark, sf_dir):
    """Likes and comments floored at every event (``signup`` takes a comment back)."""
    return C.floored_counter_stream(_item_events(_events_stream(spark, sf_dir)), "item", like_and_comment(), ["ts", "event_id"], "counters")


@query("stream_without_replays", ("STR-01", "DRV-06", "DRV-07"), f"""
WITH e AS (SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS item, event_type, user_id, ts, event_id FROM events)
SELECT item, {STEPS.format(up='click', down='error')} AS likes, count(DISTINCT CASE WHEN event_type = 'view' THEN user_id END) AS listeners
FROM e WHERE item IS NOT NULL GROUP BY item
""")
def stream_without_replays(spark, sf_dir):
    """Every second event is delivered twice, as a source that retries does; counters and listeners see each once."""
    def once():
        events = _events_stream(spark, sf_dir)
        twice = events.withColumn("__n", F.explode(F.when(F.col("event_id") % 2 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        return _item_events(C.without_replays(twice.drop("__n"), "event_id", "ts", "1 hour"))

    likes = C.floored_counter_stream(once(), "item", {"likes": like_and_comment()["likes"]}, ["ts", "event_id"], "replays")
    pairs = C.run_upsert(once().filter((F.col("event_type") == "view") & F.col("item").isNotNull()).select("item", "user_id"),
                         ["item", "user_id"], "replay-pairs", "append", prepare=lambda b: b.distinct())
    heard = pairs.groupBy("item").agg(F.count(F.lit(1)).alias("listeners"))
    items = _item_events(T(spark, sf_dir, "events")).select("item").filter("item is not null").distinct()
    return items.join(likes, "item", "left").join(heard, "item", "left").select(
        "item", F.coalesce("likes", F.lit(0)).alias("likes"), F.coalesce("listeners", F.lit(0)).alias("listeners"))


@query("stream_listeners", ("STR-01", "DRV-07"), """
SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS item, count(DISTINCT user_id) AS listeners
FROM events WHERE event_type = 'view' AND json_extract(props, '$.k') IS NOT NULL GROUP BY 1
""")
def stream_listeners(spark, sf_dir):
    views = _item_events(_events_stream(spark, sf_dir)).filter(F.col("event_type") == "view")
    return C.run_upsert(C.listener_stream(views, "item", "user_id"), ["item"], "listeners").select("item", "listeners")


@query("stream_latest_per_key", ("STR-02", "JOIN-08"), """
SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(round(value, 6), (ts, event_id)) AS value,
       max(ts) AS ts
FROM events GROUP BY user_id
""")
def stream_latest_per_key(spark, sf_dir):
    latest = C.latest_per_key_stream(_events_stream(spark, sf_dir), "user_id", "ts", ["event_type", "value", "ts"],
                                     tie_cols=["event_id"])
    table = C.run_upsert(latest, ["user_id"], "latest")
    return table.select("user_id", "event_type", rnd("value").alias("value"), "ts")


@query("stream_clean_events", ("STR-03",), """
WITH p AS (
  SELECT CASE WHEN event_id % 97 = 5 THEN NULL WHEN event_id % 113 = 7 THEN event_id - 1 ELSE event_id END AS eid,
         CASE WHEN event_id % 89 = 1 THEN NULL ELSE CAST(ts AS DATE) END AS d,
         user_id, event_type, CASE WHEN event_id % 71 = 3 THEN -value ELSE value END AS v
  FROM events
)
SELECT eid AS event_id, d AS ts, user_id, event_type, round(v, 6) AS value FROM p
WHERE eid IS NOT NULL AND d IS NOT NULL AND v >= 0
""")
def stream_clean_events(spark, sf_dir):
    from .quality import inject_event_defects  # the same injected defects, as a stream
    dirty = inject_event_defects(_events_stream(spark, sf_dir))
    cleaned = C.clean_stream(dirty, EVENT_RULES, as_of="2030-01-01 00:00:00")
    table = C.run_append(cleaned, "clean")
    return table.select("event_id", "ts", "user_id", "event_type", rnd("value").alias("value"))
