"""Streaming counters, latest-per-key and row-local cleaning (STR-01 … STR-03).

The source has no streaming operator; its incremental logic is row triggers.
The additive ones run here as Structured Streaming aggregations over an
append-only event stream.  Results never go through driver memory: every
micro-batch upserts the changed keys into a key-bucketed parquet table under
the cluster's shared checkpoint folder (``foreachBatch``): only the buckets a
batch touches are rewritten, into a folder named by the epoch id, so a
retried epoch rewrites the same folder -- idempotent.
``trigger(availableNow=True)`` drains what exists and stops, which is also
how the batch-equivalence checks run.
"""

from __future__ import annotations

import os
import uuid
from typing import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import derived as D
from ..operators.quality import TableRules, clean_table
from ..session import ensure_checkpoint_dir
from ..sources.buckets import BucketedTable, replace_rows


def file_stream(spark: SparkSession, folder: str, name_glob: str, schema, max_files: int | None = None) -> DataFrame:
    """Append-only file source over ``folder`` restricted to ``name_glob``."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", name_glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(folder)


def _run_dir(spark: SparkSession, tag: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark).replace("file:", ""), f"stream-{tag}-{uuid.uuid4().hex[:10]}")


def run_upsert(agg: DataFrame, keys: Sequence[str], tag: str, output_mode: str = "update",
               run_dir: str | None = None, buckets: int = 16, prepare: Callable[[DataFrame], DataFrame] | None = None,
               combine: Callable = replace_rows) -> DataFrame:
    """Drain ``agg`` with availableNow and merge every micro-batch into a
    key-bucketed table (:class:`BucketedTable`, the epoch as the change's number);
    return the final table (a batch DataFrame).

    ``prepare`` turns a micro-batch into rows of the table (by default it holds
    them), ``combine`` puts them together with the stored rows of their buckets (by
    default they replace those of their keys).
    """
    spark = agg.sparkSession
    base = run_dir or _run_dir(spark, tag)
    prepare = prepare or (lambda batch: batch)
    table = BucketedTable(spark, base, keys, prepare(spark.createDataFrame([], agg.schema)).schema, buckets)
    q = (agg.writeStream.outputMode(output_mode).foreachBatch(lambda batch, epoch: table.merge(prepare(batch), epoch, combine))
         .option("checkpointLocation", os.path.join(base, "checkpoint"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return table.read()


def run_append(stream: DataFrame, tag: str, run_dir: str | None = None) -> DataFrame:
    """Drain a row-local stream into a parquet file sink (exactly-once via its
    commit log) and return the written table."""
    spark = stream.sparkSession
    base = run_dir or _run_dir(spark, tag)
    out = os.path.join(base, "table")
    q = (stream.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", os.path.join(base, "checkpoint"))
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def without_replays(events: DataFrame, id_col: str, ts_col: str, delay: str | None = None) -> DataFrame:
    """STR-01: events of an id that came before, within the watermark ``delay`` of ``ts_col``, are dropped.

    ``delay`` must be named, as events that come later than it are lost.
    """
    if delay is None:
        raise ValueError("delay is required: rows later than the watermark are dropped")
    return events.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withWatermark(ts_col, delay).dropDuplicatesWithinWatermark([id_col])


def floored_counter_stream(events: DataFrame, key: str, deltas: Mapping, order: Sequence[str], tag: str, **table) -> DataFrame:
    """STR-01 / DRV-06/08: counters that are floored at 0 at every step, over a stream.

    The state of a key is the pair of :func:`derived.floor_moves`; a micro-batch's
    pairs follow the stored ones.  Events count in the order of the batches, and
    by ``order`` within one.  Returns (key, the counters).
    """
    names = list(deltas)
    moves = run_upsert(events, [key], tag, "append", prepare=lambda batch: D.floor_moves(batch, key, deltas, order),
                       combine=lambda old, new, _: D.then_moves(old, new, key, names), **table)
    return moves.select(key, *[D.floored(n).alias(n) for n in names])


def listener_stream(events: DataFrame, item: str, user: str) -> DataFrame:
    """STR-01 / DRV-07: distinct listeners per item, each (item, user) pair once."""
    return (events.filter(F.col(item).isNotNull()).select(item, user).dropDuplicates([item, user])
            .groupBy(item).agg(F.count(F.lit(1)).alias("listeners")))


def latest_per_key_stream(events: DataFrame, key: str, order_col: str, value_cols: Sequence[str],
                          tie_cols: Sequence[str] = ()) -> DataFrame:
    """STR-02: running ``max_by(struct, ts)`` per key (update mode)."""
    ordering = F.struct(*[F.col(c) for c in [order_col, *tie_cols]])
    payload = F.struct(*[F.col(c) for c in value_cols])
    return (events.groupBy(key).agg(F.max_by(payload, ordering).alias("__l"))
            .select(key, *[F.col(f"__l.`{c}`").alias(c) for c in value_cols]))


def clean_stream(events: DataFrame, rules: TableRules, *, as_of=None, dedupe_key: str | None = None,
                 ts_col: str | None = None, delay: str | None = None) -> DataFrame:
    """STR-03: the row-local standardise / convert / validate expressions on a
    stream.  ``unique`` cannot see the future, so it is replaced by dropping
    *later* copies of ``dedupe_key`` inside the watermark, whose ``delay`` must
    be named: rows that come later are lost."""
    val = {c: [r for r in rs if r != "unique"] for c, rs in rules.validation.items()}
    stream_rules = TableRules(validation=val, standardisation=rules.standardisation, rename=rules.rename,
                              subheader_key=rules.subheader_key, subheader_values=rules.subheader_values,
                              standardisers=rules.standardisers, validators=rules.validators)
    src = events
    if dedupe_key and ts_col:
        if delay is None:
            raise ValueError("delay is required: rows later than the watermark are dropped")
        src = src.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark([dedupe_key])
    return clean_table(src, stream_rules, as_of=as_of).clean
