"""All eight music presets over raw files made from the driver tables (JOB-04, SRC-02/03/06, PRJ-03, SCL-06).

Each catalogue file is written as the raw CSV it stands for: headers of one to
three rows, sub-header rows below them, text cells, and defects injected by
expressions of the key.  A folder run then finds the files, picks each one's
preset by name and cleans it.  The oracle states every row's first failure and
its typed values from the original columns.
"""

from __future__ import annotations

import os
import uuid
import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.presets import PRESETS
from ..operators.quality import clean_folder
from ..session import ensure_checkpoint_dir
from .common import T, rnd
from .registry import query

_AUDIO = ["acousticness", "danceability", "energy", "instrumentalness", "liveness", "speechiness", "tempo", "valence"]
_RANKS = ["artist_discovery_rank", "artist_familiarity_rank", "artist_hotttnesss_rank", "song_currency_rank", "song_hotttnesss_rank"]
_SOCIAL = ["artist_discovery", "artist_familiarity", "artist_hotttnesss", "song_currency", "song_hotttnesss"]


def _text(c):
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def _comma(c):
    """Decimal comma on even keys, so both notations occur."""
    return F.regexp_replace(_text(c), r"\.", ",")


def _write_file(data: DataFrame, folder: str, name: str, *lines) -> None:
    """``lines`` (header and sub-header rows, blank cells as None) head the first part of the file."""
    spark = data.sparkSession
    schema = ", ".join(f"c{i} string" for i in range(len(data.columns)))
    head = spark.createDataFrame([tuple(x) for x in lines], schema).coalesce(1)
    head.union(data).write.option("escape", '"').option("ignoreLeadingWhiteSpace", "false") \
        .option("ignoreTrailingWhiteSpace", "false").csv(f"{folder}/{name}")


def _write_catalogue(spark, sf_dir: str, folder: str) -> None:
    part, key, size = T(spark, sf_dir, "part"), F.col("p_partkey"), F.col("p_size")
    day = F.date_format(F.date_add(F.lit("2008-01-01").cast("date"), size), "yyyy/MM/dd")
    tracks = part.select(
        F.when(key % 19 == 4, key - 1).otherwise(key).cast("string"), F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")),
        F.when(key % 11 == 3, F.lit("abc")).otherwise(F.concat((size / 60).cast("int"), F.lit(":"), F.lpad((size % 60).cast("string"), 2, "0"))),
        F.col("p_type"), F.concat(F.lit("[21, "), size, F.lit("]")), F.concat(F.lit("['"), F.col("p_brand"), F.lit("', ' x ']")),
        _text(size), F.when(key % 13 == 5, F.lit("-4")).otherwise(F.lit("4")),
        F.when(key % 2 == 0, _comma("p_retailprice")).otherwise(_text("p_retailprice")), F.lit("0"),
        F.when(key % 17 == 2, F.lit("2999-01-01")).otherwise(day), F.lit(None).cast("string"), F.lit(None).cast("string"),
        F.lit(None).cast("string"), F.lit("1"), F.lit("1"))
    fields = ["title", "duration", "genre_top", "genres", "tags", "listens", "favorites", "interest", "comments", "date_created",
              "composer", "lyricist", "publisher", "id", "id"]
    _write_file(tracks, folder, "tracks.csv", [None] + ["track"] * 13 + ["album", "artist"], [None] + fields, ["track_id"] + [None] * 15)

    explicit = F.when(key % 5 == 0, F.lit(None)).otherwise(F.element_at(F.array(*map(F.lit, ["yes", "No", " Y", "maybe"])), (key % 4 + 1).cast("int")))
    raw = {"track_id": key, "album_id": F.lit(1), "artist_id": F.lit(2), "track_number": F.lit("3.0"), "track_disc_number": F.lit(None),
           "track_favorites": F.lit("1,234"), "track_listens": F.concat(key, F.lit(" "), F.lpad(size.cast("string"), 3, "0")),
           "track_interest": F.when(key % 23 == 6, F.lit("n/a")).otherwise(F.col("p_retailprice").cast("string")), "track_comments": F.lit(0),
           "track_title": F.col("p_name"), "track_duration": F.lit("1:02:03"),
           "track_bit_rate": F.when(key % 9 == 1, F.lit("-256000")).otherwise(F.lit("256000")),
           "track_genres": F.concat(F.lit("[{'genre_id': '21'}, {'genre_id': '"), size, F.lit("'}]")), "tags": F.lit("[]"),
           "track_explicit": explicit, "track_instrumental": F.lit("0"), "track_date_created": day, "album_title": F.lit("A"),
           "artist_name": F.col("p_brand")}
    _write_file(part.select(*map(_text, raw.values())), folder, "raw_tracks.csv", list(raw))

    order = F.col("o_orderkey")
    albums = {"album_id": order, "album_title": F.concat(F.lit("  Album "), order),
              "album_type": F.when(F.col("o_orderstatus") == "F", F.lit("Album")).when(F.col("o_orderstatus") == "O", F.lit("Single")),
              "album_tracks": order % 7, "album_date_released": F.date_format("o_orderdate", "yyyyMMdd"), "album_listens": F.col("o_custkey"),
              "album_favorites": F.lit("3,0"), "album_comments": F.when(order % 31 == 8, F.lit("x")).otherwise(F.lit("5")),
              "album_producer": F.lit(None), "tags": F.lit("['live', 'live']")}
    _write_file(T(spark, sf_dir, "orders").select(*map(_text, albums.values())), folder, "raw_albums.csv", list(albums))

    supp = F.col("s_suppkey")
    artists = {"artist_id": supp, "artist_name": F.col("s_name"), "artist_bio": F.lit('says "hi", twice'), "artist_location": F.lit(" here "),
               "artist_latitude": _comma("s_acctbal"), "artist_longitude": F.lit(None), "artist_members": F.lit(None),
               "artist_associated_labels": F.lit(None), "artist_related_projects": F.lit(None), "tags": F.lit("('a', 'b c')"),
               "artist_active_year_begin": F.when(supp % 9 == 7, F.lit(0)).otherwise(F.lit(1990) + supp % 20), "artist_active_year_end": F.lit(None),
               "artist_favorites": F.lit(0), "artist_comments": F.when(supp % 6 != 2, F.lit(1))}
    _write_file(T(spark, sf_dir, "supplier").select(*map(_text, artists.values())), folder, "raw_artists.csv", list(artists))

    nation = F.col("n_nationkey")
    genres = {"genre_id": nation + 1, "#tracks": F.when(nation % 8 == 7, F.lit(-1)).otherwise(nation * 10), "parent": F.col("n_regionkey"),
              "title": F.col("n_name"), "top_level": F.col("n_regionkey")}
    _write_file(T(spark, sf_dir, "nation").select(*map(_text, genres.values())), folder, "genres.csv", list(genres))

    features = part.select(_text(key), _text(size / 2), F.when(key % 29 == 6, F.lit("x")).otherwise(_text(size)),
                           F.when(key % 31 == 9, F.lit("nan")).otherwise(_comma("p_retailprice")))
    _write_file(features, folder, "features.csv", ["feature", "chroma_cens", "chroma_cens", "mfcc"], ["statistics", "kurtosis", "kurtosis", "mean"],
                ["number", "01", "02", "01"], ["track_id", None, None, None])

    cust = F.col("c_custkey")
    echo = T(spark, sf_dir, "customer")
    cells = [cust.cast("string"), F.col("c_acctbal").cast("string"), *[_text((cust + j) / 4) for j in range(7)],
             *[_text(F.when(cust % 3 != 0, cust + j)) for j in range(5)], *[_text((cust + j) / 8) for j in range(4)],
             _text(F.when(cust % 10 != 7, cust / 2))]
    head = [[None] + ["echonest"] * 18, [None] + ["audio_features"] * 8 + ["ranks"] * 5 + ["social_features"] * 5,
            [None, *_AUDIO, *_RANKS, *_SOCIAL], ["track_id"] + [None] * 18]
    _write_file(echo.select(*cells), folder, "raw_echonest.csv", *head)
    _write_file(echo.filter("c_acctbal >= 0").select(*cells), folder, "echonest.csv", *head)
    _write_file(T(spark, sf_dir, "region").select(F.col("r_name")), folder, "notes.csv", ["note"])


def _shown() -> dict:
    """Key, text, number, list and date column of each file's report."""
    explicit = F.concat_ws("|", "artist_name", F.coalesce(F.col("track_explicit").cast("string"), F.lit("none")))
    ranked = F.when(F.col("song_currency_rank").isNull(), F.lit("no rank")).otherwise(F.lit("rank"))
    echonest = ("track_id", ranked, "acousticness", None, None)
    return {
        "tracks.csv": ("track_id", "track_title", "track_interest", "track_tags", "track_date_created"),
        "raw_tracks.csv": ("track_id", explicit, "track_listens", "track_genres", "track_date_created"),
        "raw_albums.csv": ("album_id", F.concat_ws("|", "album_title", "album_type"), "album_listens", "tags", "album_date_released"),
        "raw_artists.csv": ("artist_id", F.concat_ws("|", "artist_bio", "artist_location"), "artist_latitude", "tags", None),
        "genres.csv": ("genre_id", "title", "#tracks", None, None),
        "features.csv": ("track_id", F.col("`chroma_cens_kurtosis.1`").cast("long").cast("string"), "mfcc_mean", None, None),
        "raw_echonest.csv": echonest, "echonest.csv": echonest,
    }


_SQL = """
WITH parts AS (
  SELECT *, CASE WHEN p_partkey % 19 = 4 THEN p_partkey - 1 ELSE p_partkey END AS k, DATE '2008-01-01' + p_size AS day FROM part
), found AS (
  SELECT 'tracks.csv' AS file_name, k AS key_id,
         CASE WHEN count(*) OVER (PARTITION BY k) > 1 THEN 'track_id:unique' WHEN p_partkey % 11 = 3 THEN 'track_duration:notNull'
              WHEN p_partkey % 13 = 5 THEN 'track_favorites:notNegative' WHEN p_partkey % 17 = 2 THEN 'track_date_created:beforeNow' END AS first_failure,
         p_name AS text_value, p_retailprice AS number_value, '["' || p_brand || '", "x"]' AS list_value, day AS date_value FROM parts
  UNION ALL
  SELECT 'raw_tracks.csv', p_partkey, CASE WHEN p_partkey % 23 = 6 THEN 'track_interest:notNull' WHEN p_partkey % 9 = 1 THEN 'track_bit_rate:notNegative' END,
         p_brand || '|' || CASE WHEN p_partkey % 5 = 0 THEN 'none' WHEN p_partkey % 2 = 0 THEN 'true' ELSE 'false' END,
         1000 * p_partkey + p_size, '[21, ' || p_size || ']', day FROM parts
  UNION ALL
  SELECT 'raw_albums.csv', o_orderkey, CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'album_type:notNull' WHEN o_orderkey % 7 = 0 THEN 'album_tracks:positiveNumber'
         WHEN o_orderkey % 31 = 8 THEN 'album_comments:notNull' END,
         'Album ' || o_orderkey || CASE o_orderstatus WHEN 'F' THEN '|Album' ELSE '|Single' END, o_custkey, '["live", "live"]', o_orderdate::DATE FROM orders
  UNION ALL
  SELECT 'raw_artists.csv', s_suppkey, CASE WHEN s_suppkey = 0 THEN 'artist_id:positiveNumber' WHEN s_suppkey % 9 = 7 THEN 'artist_active_year_begin:positiveNumber'
         WHEN s_suppkey % 6 = 2 THEN 'artist_comments:notNull' END, 'says "hi", twice|here', s_acctbal, '["a", "b c"]', NULL FROM supplier
  UNION ALL
  SELECT 'genres.csv', n_nationkey + 1, CASE WHEN n_nationkey % 8 = 7 THEN '#tracks:notNegative' WHEN n_regionkey = 0 THEN 'top_level:positiveNumber' END,
         n_name, 10 * n_nationkey, NULL, NULL FROM nation
  UNION ALL
  SELECT 'features.csv', p_partkey, CASE WHEN p_partkey % 29 = 6 THEN 'chroma_cens_kurtosis.1:notNull' WHEN p_partkey % 31 = 9 THEN 'mfcc_mean:notNull' END,
         p_size::VARCHAR, p_retailprice, NULL, NULL FROM part
  UNION ALL
  SELECT f.name, c_custkey, CASE WHEN c_acctbal < 0 THEN 'acousticness:notNegative' WHEN c_custkey % 10 = 7 THEN 'song_hotttnesss:notNull' END,
         CASE WHEN c_custkey % 3 = 0 THEN 'no rank' ELSE 'rank' END, c_acctbal, NULL, NULL
  FROM customer, (VALUES ('raw_echonest.csv'), ('echonest.csv')) f(name) WHERE f.name = 'raw_echonest.csv' OR c_acctbal >= 0
)
SELECT file_name, key_id::BIGINT AS key_id, first_failure, CASE WHEN first_failure IS NULL THEN text_value END AS text_value,
       CASE WHEN first_failure IS NULL THEN round(number_value::DOUBLE, 6) END AS number_value, CASE WHEN first_failure IS NULL THEN list_value END AS list_value,
       CASE WHEN first_failure IS NULL THEN date_value END AS date_value FROM found
UNION ALL SELECT 'raw_tracks.csv', NULL, 'missing column', c, NULL, NULL, NULL FROM (VALUES ('track_composer'), ('track_lyricist'), ('track_publisher')) m(c)
"""


@query("music_presets_cleaned", ("JOB-04", "SRC-02", "SRC-03", "SRC-06", "PRJ-03", "SCL-06", "JOB-01"), _SQL)
def music_presets_cleaned(spark, sf_dir):
    """Every row of the eight music files with its first failure, or its typed values; rule columns that a file lacks."""
    folder = os.path.join(ensure_checkpoint_dir(spark), f"catalogue-{uuid.uuid4().hex[:10]}")
    _write_catalogue(spark, sf_dir, folder)
    shown = _shown()
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")                       # notes.csv has no preset, absent.csv is no file
        results = clean_folder(spark, folder, PRESETS, names=[*shown, "notes.csv", "absent.csv"])
    out, kept = None, F.col("first_failure").isNull()
    for name, res in results.items():
        key, *values = shown[name]
        cells = [F.when(kept, F.lit(None) if v is None else F.col(f"`{v}`") if isinstance(v, str) else v).cast(kind)
                 for v, kind in zip(values, ("string", "double", "string", "date"))]
        rows = res.flagged.select(F.lit(name).alias("file_name"), F.col(key).cast("long").alias("key_id"), "first_failure",
                                  cells[0].alias("text_value"), rnd(cells[1]).alias("number_value"), cells[2].alias("list_value"),
                                  cells[3].alias("date_value"))
        if res.missing:
            lacking = spark.createDataFrame([(name, None, "missing column", c, None, None, None) for c in res.missing], rows.schema)
            rows = rows.unionByName(lacking)
        out = rows if out is None else out.unionByName(rows)
    return out
