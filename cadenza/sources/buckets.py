"""Keyed tables that a batch changes in part.

Rows lie in hash buckets of the key, one folder a bucket.  A change reads and
writes only the buckets that its keys touch, into folders named by the change's
number; a small file per change lists which folder holds each bucket.  A change
starts from the newest list below its number, so one that is run again meets
the rows it met before.
"""

from __future__ import annotations

import json
import os
from typing import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_manifest(spark: SparkSession, base: str, epoch: int, manifest: dict[int, str]) -> None:
    """One small JSON file per change, written with the file-system API (no job)."""
    fs, p = _fs(spark, os.path.join(base, "manifest", f"epoch-{epoch:09d}.json"))
    out = fs.create(p, True)
    try:
        out.write(bytearray(json.dumps({str(k): v for k, v in sorted(manifest.items())}).encode("utf-8")))
    finally:
        out.close()


def latest_manifest(spark: SparkSession, base: str, below: int | None = None) -> tuple[int, dict[int, str]]:
    """(number, {bucket: path}) of the newest list under ``base``; with ``below``, of a change before it."""
    fs, p = _fs(spark, os.path.join(base, "manifest"))
    if not fs.exists(p):
        return -1, {}
    names = sorted(str(st.getPath().getName()) for st in fs.listStatus(p) if str(st.getPath().getName()).endswith(".json"))
    names = [n for n in names if below is None or int(n[len("epoch-"):-len(".json")]) < below]
    if not names:
        return -1, {}
    latest = names[-1]
    stream = fs.open(fs.makeQualified(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, latest)))
    try:
        data = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return int(latest[len("epoch-"):-len(".json")]), {int(k): v for k, v in json.loads(data).items()}


def replace_rows(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` in place of those of their keys."""
    return old.join(new.select(*keys), list(keys), "left_anti").unionByName(new)


class BucketedTable:
    """A table of ``schema`` under ``base``, in ``buckets`` hash buckets of ``keys``."""

    def __init__(self, spark: SparkSession, base: str, keys: Sequence[str], schema: StructType, buckets: int = 16):
        self.spark, self.base, self.keys, self.schema, self.buckets = spark, base, list(keys), schema, buckets

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _touched(self, rows: DataFrame) -> list[int]:
        return sorted(r[0] for r in rows.select(self._bucket()).distinct().collect())          # at most ``buckets`` numbers

    def _read(self, paths: Sequence[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self, keys_of: DataFrame | None = None, below: int | None = None) -> DataFrame:
        """The table, or only the buckets that hold the keys of the rows ``keys_of``, as it stood before change ``below``."""
        _, held = latest_manifest(self.spark, self.base, below)
        return self._read([held[b] for b in (self._touched(keys_of) if keys_of is not None else sorted(held)) if b in held])

    def merge(self, rows: DataFrame, epoch: int, combine: Callable[[DataFrame, DataFrame, list[str]], DataFrame] = replace_rows) -> None:
        """Write the touched buckets anew: ``combine(old rows, rows, keys)``."""
        placed = rows.withColumn("__bucket", self._bucket()).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            touched = sorted(r[0] for r in placed.select("__bucket").distinct().collect())
            if not touched:
                return
            rows = placed.select(*self.schema.names)
            _, held = latest_manifest(self.spark, self.base, below=epoch)
            olds = [held[b] for b in touched if b in held]
            merged = combine(self._read(olds), rows, self.keys) if olds else rows
            out = os.path.join(self.base, "table", f"v{epoch:09d}")
            merged.withColumn("__bucket", self._bucket()).repartition(min(len(touched), 200), "__bucket") \
                .write.mode("overwrite").partitionBy("__bucket").parquet(out)
            write_manifest(self.spark, self.base, epoch, {**held, **{b: os.path.join(out, f"__bucket={b}") for b in touched}})
        finally:
            placed.unpersist()
