"""Validation predicates (VAL-01 … VAL-12) and typed conversion (SCL-20).

A predicate is ``(col, ctx) -> Column[boolean]`` where TRUE means the value
passes.  Null passes every rule except ``notNull`` (``unique`` flags repeated
nulls through its pre-computed duplicate column).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .standardise import TRUE_WORDS, parse_date_col, strip_ws


@dataclass(frozen=True)
class RuleContext:
    column: str
    dtype: T.DataType
    as_of: Column
    duplicate_col: str | None = None


def _num(c: Column, dtype) -> Column:
    if isinstance(dtype, (T.StringType,)):
        return c.try_cast("double")
    if isinstance(dtype, (T.BooleanType, T.DateType, T.TimestampType, T.ArrayType)):
        return F.lit(None).cast("double")
    return c.cast("double")


def _passes_if_null(c: Column, cond: Column) -> Column:
    return c.isNull() | F.coalesce(cond, F.lit(False))


def not_null(c, ctx: RuleContext) -> Column:
    if isinstance(ctx.dtype, (T.DoubleType, T.FloatType)):
        return c.isNotNull() & ~F.isnan(c)
    return c.isNotNull()


def not_negative(c, ctx):
    return _passes_if_null(c, _num(c, ctx.dtype) >= 0)


def positive_number(c, ctx):
    return _passes_if_null(c, _num(c, ctx.dtype) > 0)


def is_lower(c, ctx):
    """Text equal to its lower-case form; a non-text value fails (null passes)."""
    return c.isNull() if not isinstance(ctx.dtype, T.StringType) else _passes_if_null(c, c == F.lower(c))


def is_upper(c, ctx):
    return c.isNull() if not isinstance(ctx.dtype, T.StringType) else _passes_if_null(c, c == F.upper(c))


def _as_ts(c, ctx) -> Column:
    if isinstance(ctx.dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return c.cast("timestamp")
    return parse_date_col(c.cast("string")).cast("timestamp")


def before_now(c, ctx):
    return _passes_if_null(c, _as_ts(c, ctx) < ctx.as_of)


def after_now(c, ctx):
    return _passes_if_null(c, _as_ts(c, ctx) > ctx.as_of)


def is_int(c, ctx):
    if isinstance(ctx.dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return F.lit(True)
    n = _num(c, ctx.dtype)
    return _passes_if_null(c, n == F.floor(n))


def is_float(c, ctx):
    if isinstance(ctx.dtype, T.NumericType):
        return F.lit(True)
    return _passes_if_null(c, _num(c, ctx.dtype).isNotNull())


def is_string(c, ctx):
    """A text value (after conversion every ``string``-typed column is text)."""
    return F.lit(True) if isinstance(ctx.dtype, T.StringType) else c.isNull()


def is_date(c, ctx):
    if isinstance(ctx.dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit(True)
    return _passes_if_null(c, parse_date_col(c.cast("string")).isNotNull())


def is_boolean(c, ctx):
    """A real boolean (the typed conversion makes one); other values fail."""
    return F.lit(True) if isinstance(ctx.dtype, T.BooleanType) else c.isNull()


def is_array(c, ctx):
    if isinstance(ctx.dtype, T.ArrayType):
        return F.lit(True)
    return _passes_if_null(c, F.json_array_length(c.cast("string")).isNotNull())


def unique(c, ctx):
    if not ctx.duplicate_col:
        raise ValueError("unique needs a pre-computed duplicate column")
    return ~F.coalesce(F.col(ctx.duplicate_col), F.lit(False))


def is_true(c, ctx):
    return F.coalesce(c.cast("boolean"), F.lit(False)) if isinstance(ctx.dtype, T.BooleanType) else \
        F.coalesce(F.lower(c.cast("string")) == "true", F.lit(False))


# UDF-02: registry of validation rules by name (open for users).
VALIDATORS: dict[str, Callable[[Column, RuleContext], Column]] = {
    "notNull": not_null,
    "notNegative": not_negative,
    "positiveNumber": positive_number,
    "toLowerCase": is_lower,
    "toUpperCase": is_upper,
    "beforeNow": before_now,
    "afterNow": after_now,
    "int": is_int,
    "float": is_float,
    "double": is_float,
    "string": is_string,
    "date": is_date,
    "boolean": is_boolean,
    "array": is_array,
    "unique": unique,
}
SURVEY_VALIDATORS = dict(VALIDATORS, isTrue=is_true)

# Conversion precedence of the typed conversion.
TYPE_PRECEDENCE = ["int", "double", "float", "date", "boolean", "string"]


def _text_double(text: Column) -> Column:
    """Text → double; the Unicode-whitespace strip runs only when the plain
    cast fails (standardised text is already canonical)."""
    return F.coalesce(text.try_cast("double"), strip_ws(text).try_cast("double"))


def convert(c: Column, rules, dtype=T.StringType(), strict_int: bool = False) -> tuple[Column, T.DataType]:
    """SCL-20: typed conversion by the first type rule in precedence order.

    int truncates (``int(float(x))``, Q-02; ``strict_int`` keeps fractions as
    NULL); failures become NULL; boolean is text in {true, 1, yes}.
    """
    kind = next((k for k in TYPE_PRECEDENCE if k in rules), None)
    text = c.cast("string")
    if kind == "int":
        d = c.cast("double") if isinstance(dtype, T.NumericType) else _text_double(text)
        ok = d.isNotNull() & ~F.isnan(d) & (F.abs(d) < F.lit(9.2e18))
        if strict_int:
            ok = ok & (d == F.floor(d))
        return F.when(ok, d.cast("long")), T.LongType()
    if kind in ("double", "float"):
        d = c.cast("double") if isinstance(dtype, T.NumericType) else _text_double(text)
        return d, T.DoubleType()
    if kind == "date":
        if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return c.cast("date"), T.DateType()
        return parse_date_col(text), T.DateType()
    if kind == "boolean":
        if isinstance(dtype, T.BooleanType):
            return c, T.BooleanType()
        return F.when(c.isNotNull(), F.lower(text).isin(TRUE_WORDS[:3])), T.BooleanType()
    if kind == "string" and isinstance(dtype, T.ArrayType):
        return F.to_json(c), T.StringType()
    return c, dtype
