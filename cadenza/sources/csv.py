"""CSV sources and sinks (SRC-01 … SRC-08, SRC-14, SRC-17).

Raw files are read with every column as text (types are decided by the rule
config later).  A multi-row header is read by peeking at its k lines only;
header and sub-header rows inside the data are dropped by *content*, so the
scan stays splittable and no row numbering of the whole data set is needed.
"""

from __future__ import annotations

import csv
import io
import json
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import cut_lineage

UNNAMED_PREFIX = "Unnamed: 0_"


def flatten_header(rows: Sequence[Sequence[str]]) -> list[str]:
    """SRC-02: join header levels with ``_`` (blank cells become pandas-style
    ``Unnamed: i_level_k``), strip ``_``, drop the ``Unnamed: 0_`` prefix,
    suffix duplicates ``.1``, ``.2`` …"""
    width = max(len(r) for r in rows)
    names = []
    for i in range(width):
        parts = []
        for k, r in enumerate(rows):
            cell = r[i].strip() if i < len(r) else ""
            parts.append(cell if cell else f"Unnamed: {i}_level_{k}" if len(rows) > 1 else f"Unnamed: {i}")
        name = "_".join(parts).strip("_")
        names.append(name.replace(UNNAMED_PREFIX, "").strip("_"))
    seen: dict[str, int] = {}
    out = []
    for n in names:
        if n in seen:
            seen[n] += 1
            out.append(f"{n}.{seen[n]}")
        else:
            seen[n] = 0
            out.append(n)
    return out


def peek_header(spark: SparkSession, path: str, header_rows: int) -> list[list[str]]:
    """Read the first ``header_rows`` lines only (k rows reach the driver).

    A folder's header is that of its first file by name.
    """
    lister = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = lister.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(lister) and files.getFileStatus(lister).isDirectory():
        names = sorted(str(s.getPath()) for s in files.listStatus(lister) if s.isFile() and not str(s.getPath().getName()).startswith(("_", ".")))
        path = names[0] if names else path
    lines = [r[0] for r in spark.read.text(path).limit(header_rows).collect()]
    return [next(csv.reader(io.StringIO(line))) for line in lines]


def read_raw_csv(spark: SparkSession, path: str, header_rows: int = 1, header_path: str | None = None,
                 rename: dict | None = None, drop_key: str | None = None, drop_values: Sequence[str] = (),
                 recursive: bool = False, multi_line: bool = False) -> DataFrame:
    """SRC-01/02/03/04: all-text scan with a flattened k-row header.

    ``multi_line`` is for files with line breaks inside quoted cells; such files
    cannot be split, each is read by one task.

    Header lines found among the data (every cell equal) are removed; rows
    whose ``drop_key`` holds one of ``drop_values`` (sub-header rows) too.
    """
    header = peek_header(spark, header_path or path, header_rows) if header_rows else []
    names = flatten_header(header) if header else None
    reader = (spark.read.option("header", "false").option("multiLine", str(multi_line).lower()).option("escape", '"')
              .option("mode", "PERMISSIVE"))
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.csv(path)
    if names:
        if len(names) != len(df.columns):
            raise ValueError(f"header has {len(names)} columns, data {len(df.columns)}")
        df = df.toDF(*names)
        # one comparison a line: a disjunction over the columns would be pushed, inferred and simplified term by term
        cells = F.array(*[F.col(f"`{c}`") for c in df.columns])
        for line in header:
            whole = [F.lit(v) if v != "" else F.lit(None).cast("string") for v in [*line, *[""] * (len(names) - len(line))]]
            df = df.filter(~cells.eqNullSafe(F.array(*whole)))
    if rename:
        df = df.withColumnsRenamed(dict(rename))
    if drop_key and drop_values:
        k = F.col(f"`{drop_key}`")
        df = df.filter(k.isNull() | ~F.trim(k).isin(list(drop_values)))
    return df


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """SRC-08: typed bulk load; any malformed row fails the load (``\\copy``)."""
    return spark.read.schema(schema).option("header", str(header).lower()).option("mode", "FAILFAST").csv(path)


def limited(df: DataFrame, n: int | None) -> tuple[DataFrame, int | None]:
    """SRC-05: process only the first ``n`` rows; report the pre-limit count."""
    if n is None or n < 0:
        return df, None
    return df.limit(n), df.count()


def list_csv(spark: SparkSession, folder: str, names: Sequence[str] | None = None) -> list[str]:
    """SRC-06: every ``*.csv`` in a folder (metadata listing only), or the
    named subset that exists."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(conf)
    found = sorted(str(s.getPath().getName()) for s in fs.listStatus(p) if str(s.getPath().getName()).endswith(".csv"))
    if names is None:
        return [f"{folder.rstrip('/')}/{n}" for n in found]
    return [f"{folder.rstrip('/')}/{n}" for n in names if n in found]


def to_text_columns(df: DataFrame) -> DataFrame:
    """Arrays / structs / maps as JSON text, dates ISO (CSV cannot hold nesting)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            c = F.to_json(c)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        out.append(c.alias(f.name))
    return df.select(*out)


def write_clean_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SRC-07: ``clean_<name>`` as CSV with a header, nested values as JSON."""
    to_text_columns(df).write.mode(mode).option("header", "true").csv(path)


def read_scoring_input(spark: SparkSession, path: str, required: Sequence[str] = ("track_date_created",),
                       id_col: str = "track_id") -> DataFrame:
    """SRC-14: scoring CSV; required columns checked; ids added when absent.

    An added id numbers the rows by file and place (``csv_row_<n>``): the same
    at every evaluation, and gapless for a single file.
    """
    df = spark.read.option("header", "true").csv(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    if id_col not in df.columns:
        # rows before each file and block come from one small count per block; within a block rows keep their order
        placed = df.select("*", F.col("_metadata.file_path").alias("__f"), F.col("_metadata.file_block_start").alias("__b"),
                           F.monotonically_increasing_id().alias("__m"))
        placed = cut_lineage(placed, "scoring")
        blocks = placed.groupBy("__f", "__b").agg(F.count("*").alias("__n"), F.min("__m").alias("__first"))
        before = F.coalesce(F.sum("__n").over(Window.orderBy("__f", "__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        starts = blocks.select("__f", "__b", "__first", before.alias("__before"))
        df = placed.join(starts, ["__f", "__b"]) \
            .withColumn(id_col, F.concat(F.lit("csv_row_"), (F.col("__before") + F.col("__m") - F.col("__first")).cast("string"))) \
            .drop("__f", "__b", "__m", "__first", "__before")
    return df


def load_label_map(path_or_text: str) -> dict[str, float]:
    """SRC-17: question → label → number JSON, flattened to label → number
    (first label wins across questions, case-insensitive) for SCL-17."""
    try:
        data = json.loads(path_or_text)
    except json.JSONDecodeError:
        with open(path_or_text, encoding="utf-8") as fh:
            data = json.load(fh)
    flat: dict[str, float] = {}
    for labels in data.values():
        for label, value in labels.items():
            flat.setdefault(label.lower().strip(), float(value))
    return flat
