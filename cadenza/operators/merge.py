"""Catalogue merge (JOB-06): genres exploded, then a chain of priority merges.

One lazy plan: the base table's genre list is exploded (empty list ⇒ one
row with a null genre), each source is left-joined with base columns kept
authoritative, a second source column back-fills a first one
(``combine_first``), and the result is written once, sorted by
(track, genre) with nulls last *within* partitions (``sortWithinPartitions``
after range partitioning) so no single task sorts the whole table.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.standardise import json_list_text, parse_track_genres
from .joins import explode_join, priority_merge


def merge_catalog(tracks: DataFrame, key: str, genre_list_col: str, genres: DataFrame, genre_key: str,
                  merges: Sequence[dict], fill_from: Sequence[tuple[str, str]] = (),
                  sort: bool = True) -> DataFrame:
    """``merges``: dicts with ``df``, ``key``, optional ``suffix``/``drop``/``rename``.
    ``fill_from``: (target, source) column pairs for ``combine_first``."""
    base = tracks.withColumn("__genre_ids", parse_track_genres(F.col(genre_list_col)))
    out = explode_join(base, "__genre_ids", genres, genre_key).drop("__genre_ids")
    for m in merges:
        out = priority_merge(out, m["df"], m["key"], suffix=m.get("suffix", "other"), drop=m.get("drop"),
                             rename=m.get("rename"))
    for target, source in fill_from:
        out = out.withColumn(target, F.coalesce(F.col(target), F.col(source)))
    out = out.withColumn(genre_list_col, json_list_text(parse_track_genres(F.col(genre_list_col))))
    if sort:
        out = (out.repartitionByRange(F.asc_nulls_last(key), F.asc_nulls_last(genre_key))
               .sortWithinPartitions(F.asc_nulls_last(key), F.asc_nulls_last(genre_key)))
    return out


def merge_job(tracks: DataFrame, key: str, genre_list_col: str, genres: DataFrame, genre_key: str,
              merges: Sequence[dict], fill_from: Sequence[tuple[str, str]] = (), out_path: str | None = None,
              dry_run: bool = False, fmt: str = "parquet") -> DataFrame:
    """SRC-09: build the merged table; write it once unless ``dry_run``
    (the frame is returned either way, lazily)."""
    merged = merge_catalog(tracks, key, genre_list_col, genres, genre_key, merges, fill_from)
    if not dry_run:
        if out_path is None:
            raise ValueError("out_path is required unless dry_run")
        out = merged
        if fmt == "csv":
            from ..sources.csv import to_text_columns
            out = to_text_columns(merged)
        out.write.mode("overwrite").format(fmt).option("header", "true").save(out_path)
    return merged
