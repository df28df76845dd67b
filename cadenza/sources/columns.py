"""Schema-level helpers: they inspect ``df.schema`` only and start no job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)


class MissingColumnsError(ValueError):
    pass


def require_columns(df: DataFrame, cols) -> DataFrame:
    """SRC-13: fail with the missing names, else return ``df`` unchanged."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"missing required columns: {missing}")
    return df


def select_existing(df: DataFrame, keep) -> DataFrame:
    """SRC-11/12: keep the known columns that exist, in ``keep`` order."""
    present = set(df.columns)
    return df.select(*[c for c in keep if c in present])


def numeric_columns(df: DataFrame, exclude=(), preferred=None) -> list[str]:
    """PRJ-07: numeric columns by type minus identifiers; optional preferred list.

    With ``preferred`` the result is the preferred columns that are numeric and
    present, in that order (absent ones are reported through ``missing``).
    """
    numeric = [f.name for f in df.schema.fields
               if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in set(exclude)]
    if preferred is None:
        return numeric
    return [c for c in preferred if c in numeric]


def strip_dots(df: DataFrame) -> DataFrame:
    """PRJ-05: remove '.' from column names (dynamic wide feature tables)."""
    return df.toDF(*[c.replace(".", "") for c in df.columns])


def all_plus_derived(base: DataFrame, derived: DataFrame, key: str) -> DataFrame:
    """PRJ-04: ``t.*`` plus the derived columns of ``derived`` not already present."""
    extra = [c for c in derived.columns if c != key and c not in base.columns]
    return base.join(derived.select(key, *extra), key, "left")


def labelled_id(prefix: str, col) -> "F.Column":
    """PRJ-06: ``'prefix' || id``."""
    return F.concat(F.lit(prefix), F.col(col).cast("string") if isinstance(col, str) else col.cast("string"))
