"""Rule-driven data-quality job (JOB-01 … JOB-03, AGG-31, PRJ-01 … PRJ-03).

``clean_table`` turns a rule config into ONE logical plan:
rename → drop sub-header rows by content → select → standardise (one
projection) → typed conversion (one projection) → duplicate flags for
``unique`` columns (aggregate + join, not a window) → ``first_failure``
(ordered coalesce: first failing rule of the first failing column, in
source-column order) → filter.  The report is one aggregate over the same
plan: a ``groupBy(first_failure)`` whose null group is the kept rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.standardise import STANDARDISERS, apply_rules
from ..functions.validate import VALIDATORS, RuleContext, convert
from ..session import cut_lineage
from .aggregates import duplicate_flag

ALL = "__all__"


@dataclass(frozen=True)
class TableRules:
    """Driver-side rule config for one table (never data)."""
    validation: Mapping[str, Sequence[str]]
    standardisation: Mapping[str, Sequence[str]] = field(default_factory=dict)
    rename: Mapping[str, str] = field(default_factory=dict)
    subheader_key: str | None = None            # SRC-03: key column of sub-header rows
    subheader_values: Sequence[str] = ()        # ... and the values that mark them
    header_rows: int = 1                        # SRC-02: header lines of the raw file
    standardisers: Mapping | None = None
    validators: Mapping | None = None

    def check(self) -> None:
        std = self.standardisers or STANDARDISERS
        val = self.validators or VALIDATORS
        for col, rules in self.standardisation.items():
            bad = [r for r in rules if r not in std]
            if bad:
                raise ValueError(f"unknown standardiser(s) {bad} for column {col}")
        for col, rules in self.validation.items():
            bad = [r for r in rules if r not in val]
            if bad:
                raise ValueError(f"unknown validation rule(s) {bad} for column {col}")


@dataclass
class CleanResult:
    clean: DataFrame          # kept rows, typed
    flagged: DataFrame        # every row with its first_failure (null = kept)
    selected: list[str]
    missing: list[str]
    rules: dict[str, list[str]]
    standardised: dict[str, list[str]] = field(default_factory=dict)

    def rejected(self, rule_key: str | None = None) -> DataFrame:
        """Rows that failed (optionally: whose first failure is ``rule_key``)."""
        return self.flagged.filter(F.col("first_failure").isNotNull() if rule_key is None else (F.col("first_failure") == rule_key))

    def applied(self) -> DataFrame:
        """SRC-18: standardisers applied per column (a small frame)."""
        spark = self.flagged.sparkSession
        rows = [(c, ", ".join(r)) for c, r in self.standardised.items() if r]
        return spark.createDataFrame(rows, "column string, standardisers string")

    def failures(self) -> DataFrame:
        """AGG-31: ``column:rule`` → count, descending."""
        return (self.rejected()
                .groupBy("first_failure").agg(F.count(F.lit(1)).alias("failures"))
                .orderBy(F.desc("failures"), "first_failure"))

    def report(self) -> DataFrame:
        """JOB-03 / SRC-18: one-row report with counts and retention %."""
        agg = self.flagged.agg(F.count(F.lit(1)).alias("filtered_rows"),
                               F.count(F.when(F.col("first_failure").isNull(), 1)).alias("cleaned_rows"))
        return agg.select("filtered_rows", "cleaned_rows",
                          (F.col("filtered_rows") - F.col("cleaned_rows")).alias("removed_rows"),
                          F.when(F.col("filtered_rows") > 0,
                                 100.0 * F.col("cleaned_rows") / F.col("filtered_rows"))
                          .otherwise(F.lit(0.0)).alias("retention_pct"))


def clean_table(df: DataFrame, rules: TableRules, *, as_of=None, strict_int: bool = False,
                null_bool_as_true: bool = False) -> CleanResult:
    rules.check()
    std_reg = rules.standardisers or STANDARDISERS
    val_reg = rules.validators or VALIDATORS
    if rules.rename:
        df = df.withColumnsRenamed(dict(rules.rename))
    if rules.subheader_key and rules.subheader_values:
        k = F.col(rules.subheader_key)
        df = df.filter(k.isNull() | ~F.trim(k).isin(list(rules.subheader_values)))

    default_val = list(rules.validation.get(ALL, []))
    specific_val = {c: list(r) for c, r in rules.validation.items() if c != ALL}
    missing = [c for c in specific_val if c not in df.columns]                 # PRJ-03
    selected = list(df.columns) if default_val else [c for c in df.columns if c in specific_val]  # PRJ-01/02
    if not selected:
        raise ValueError(f"no column of the table has a rule; missing: {missing}")
    eff_val = {c: specific_val.get(c, default_val) for c in selected}
    default_std = list(rules.standardisation.get(ALL, []))
    eff_std = {c: list(rules.standardisation.get(c, default_std)) for c in selected}

    # Standardise: every column's rule chain in ONE projection.
    dtypes = dict((f.name, f.dataType) for f in df.schema.fields)
    std_cols = []
    for c in selected:
        col = F.col(f"`{c}`")
        if eff_std[c] and not isinstance(dtypes[c], T.StringType):
            col = col.cast("string")
        std_cols.append(apply_rules(col, eff_std[c], std_reg).alias(c))
    work = df.select(*std_cols)

    # Typed conversion: one projection.
    conv, types = [], {}
    for c in selected:
        expr, dt = convert(F.col(f"`{c}`"), eff_val[c], work.schema[c].dataType, strict_int=strict_int)
        conv.append(expr.alias(c))
        types[c] = dt
    work = work.select(*conv)

    # Duplicate flags for ``unique`` columns (all copies, nulls included).
    dup_cols = {}
    for c in selected:
        if "unique" in eff_val[c]:
            name = f"__dup_{len(dup_cols)}"
            work = duplicate_flag(work, c, name)
            dup_cols[c] = name

    as_of_col = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    checks = []
    for c in selected:
        ctx = RuleContext(c, types[c], as_of_col, dup_cols.get(c))
        for r in eff_val[c]:
            ok = val_reg[r](F.col(f"`{c}`"), ctx)
            checks.append(F.when(~F.coalesce(ok, F.lit(False)), F.lit(f"{c}:{r}")))
    first = F.coalesce(*checks) if checks else F.lit(None).cast("string")
    flagged = work.withColumn("first_failure", first).drop(*dup_cols.values())
    if flagged.isStreaming:
        # ``__task`` (spark_partition_id, non-deterministic) pins first_failure to
        # the projection over the converted columns: without it the optimizer
        # pushes the filter below the standardise / convert projections and
        # inlines every parser once per rule that reads its column.
        pinned = flagged.withColumn("__task", F.spark_partition_id())
        clean, flagged = pinned.filter(F.col("first_failure").isNull() & (F.col("__task") >= 0)).drop("__task"), pinned.drop("__task")
    else:
        # every row is parsed and judged once: clean rows, rejects and reports read the written table
        flagged = cut_lineage(flagged, "flagged")
        clean = flagged.filter(F.col("first_failure").isNull())
    clean = clean.drop("first_failure")
    if null_bool_as_true:
        for c in selected:
            if isinstance(types[c], T.BooleanType):
                clean = clean.withColumn(c, F.coalesce(F.col(c), F.lit(True)))
    return CleanResult(clean, flagged, selected, missing, eff_val, eff_std)


def clean_file(spark, path: str, rules: TableRules, **kw) -> CleanResult:
    """JOB-01 from a raw file: k-row header scan (SRC-01…04), then ``clean_table``."""
    from ..sources.csv import read_raw_csv
    raw = read_raw_csv(spark, path, header_rows=rules.header_rows)
    return clean_table(raw, rules, **kw)


def clean_folder(spark, folder: str, presets: dict, names=None, **kw) -> dict:
    """SRC-06: every ``*.csv`` of a folder (or the named ones) with a preset;
    files without one are reported and skipped."""
    import warnings
    from ..sources.csv import list_csv
    out = {}
    for path in list_csv(spark, folder, names):
        name = path.rsplit("/", 1)[-1]
        rules = presets.get(name)
        if rules is None:
            warnings.warn(f"no rule set for {name}; skipped")
            continue
        out[name] = clean_file(spark, path, rules, **kw)
    return out
