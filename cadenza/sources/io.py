"""Other sources and sinks (SRC-09 … SRC-16)."""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_jdbc(spark: SparkSession, url: str, table_or_query: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """SRC-10: a database table or query as a frame, split over
    ``num_partitions`` range reads of ``partition_column`` when given."""
    props = dict(properties or {})
    if partition_column:
        return spark.read.jdbc(url, table_or_query, column=partition_column, lowerBound=lower, upperBound=upper,
                               numPartitions=num_partitions, properties=props)
    return spark.read.jdbc(url, table_or_query, properties=props)


def load_first_available(loaders: Sequence[Callable[[], DataFrame]], keep: Sequence[str] | None = None) -> DataFrame:
    """SRC-11: the first loader that succeeds, restricted to the known columns present."""
    errors = []
    for load in loaders:
        try:
            df = load()
            if keep is not None:
                df = df.select(*[c for c in keep if c in df.columns])
            return df
        except Exception as e:  # noqa: BLE001 - fall through to the next source
            errors.append(f"{type(e).__name__}: {e}")
    raise RuntimeError("no source available: " + " | ".join(errors))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> None:
    """SRC-09/16: write a result (parquet by default)."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def prediction_records(pred: DataFrame, id_col: str, pred_col: str, actual_col: str) -> DataFrame:
    """SRC-15: ``{track_id, predicted_listens, actual_listens}`` with −1 for unknown actual."""
    return pred.select(F.col(id_col).alias("track_id"), F.col(pred_col).alias("predicted_listens"),
                       F.coalesce(F.col(actual_col).cast("double"), F.lit(-1.0)).alias("actual_listens"))


def write_predictions_json(pred: DataFrame, path: str) -> None:
    pred.write.mode("overwrite").json(path)
