"""Corpus pipeline: documents in, packed training sequences out.

STAGES lists (name, function); each function takes (spark, docs, sf_dir), works
on all rows of ``docs`` and returns a DataFrame, with the columns of
``documents`` but for the last.  Between stages the rows are written as Parquet
and read again (``run`` does so in the shared checkpoint folder).

A null, empty or very long text, a repeated row, a null in any column and an
empty table are taken by every stage; columns beyond those of ``documents`` are
carried through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cadenza.llm import decontaminate, lang_id, ngram_join, packing, substring_dedup
from cadenza.llm.queries import tokenizer_path
from cadenza.session import cut_lineage, ensure_checkpoint_dir
from cadenza.sources.tables import load_table

#: A text stays if its pooled language probability reaches this.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject texts without a letter (null ones too), and those whose language stays in doubt.

    Without any labelled text nothing can be learned; then only the former go.
    """
    name = F.col("doc_id").cast("string").cast("binary")
    net = lang_id.train(docs.filter(F.crc32(name) % 3 != 1), "text", "lang", F.md5(name))
    if net is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    out = lang_id.predict(docs, "text", net, docs.columns)
    return out.filter((F.col("lang_pred") != lang_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component of five-word shingle similarity 0.8: the smallest doc_id, null last.

    The rows to keep are named by id and text, so texts need not travel with the
    join; of rows that repeat both, one stays.
    """
    keyed = docs.withColumn("_text_key", F.xxhash64("text"))
    groups = ngram_join.jaccard_components(keyed, "doc_id", "text", k=5, num=80, den=100, carry=["_text_key"])
    kept = groups.groupBy("row.doc_id", "row._text_key").agg(F.max("first").alias("first"), F.count("*").alias("n")) \
        .filter("first").select(F.col("doc_id").alias("_id"), F.col("_text_key").alias("_key"), F.col("n").alias("_n"))
    kept = cut_lineage(kept, "kept")
    mine = keyed.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key")))
    once = mine.filter("_n = 1").select(*docs.columns)
    return once.unionByName(mine.filter("_n > 1").dropDuplicates(["_id", "_key"]).select(*docs.columns))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut every window of 35 words that occurs at two places or more; a document that loses all its words goes."""
    rest = [c for c in docs.columns if c != "text"]
    out = substring_dedup.remove_repeats(docs, "text", rest, window=35, keep_spacing=True)
    out = out.filter("n_removed = 0 or n_removed < n_words").select("row.*", F.col("kept_text").alias("text"), "n_removed")
    length = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", length).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark passage of 13 words or more, substitutions tolerated."""
    return decontaminate.without_overlaps(docs, "text", load_table(spark, sf_dir, "benchmark"), "item_id", "text")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of 4096 tokens: one row per piece, with its place and ids' checksum."""
    pieces = packing.token_pieces(docs, "text", tokenizer_path("word_bpe_49k.json"), ["doc_id"])
    placed = packing.pack(pieces.select("item", "length"))
    digest = pieces.select("item", "row.doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return digest.join(placed, "item").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "bound")


STAGES = [("language_id", identify_language), ("ngram_join", drop_near_duplicates), ("substring_dedup", drop_repeated_passages),
          ("decontamination", drop_contaminated), ("packing", pack_sequences)]

#: The language network and the packing cannot be said in SQL; tests/llm/test_pipeline.py holds every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again before the next."""
    ensure_checkpoint_dir(spark)
    docs = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
