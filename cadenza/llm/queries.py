"""Registered queries of the dealt operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import load_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql.strip()
        return fn
    return deco


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document; a crossing token goes to the line with most of its characters."""
    import public_tokenizers

    from .token_counts import section_token_counts
    counts = section_token_counts(load_table(spark, sf_dir, "documents"), "doc_id", ["text"],
                                  tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, rule="most")
    return counts.select("doc_id", "section", "char_start", "char_end",
                         F.col("tokens").cast("long").alias("n_tokens"), "crossing")


@query("op9_substring_dedup")
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words outside every repeated window of 35 words, as a digest."""
    from .substring_dedup import remove_repeats
    out = remove_repeats(load_table(spark, sf_dir, "documents"), "text", ["doc_id"], window=35)
    return out.select("row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op7_ngram_join")
def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share nine tenths of their 3-word shingles."""
    from .ngram_join import jaccard_components
    out = jaccard_components(load_table(spark, sf_dir, "documents"), "doc_id", "text", k=3, num=90, den=100)
    return out.select("row.doc_id", "n_shingles", "component_id")


@query("op4_lm_mixing")
def op4_lm_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document, learned from four fifths of them."""
    from .lm_mixing import score
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    out = score(load_table(spark, sf_dir, "documents"), "text", fold != 1, ["doc_id"])
    return out.select("row.doc_id", F.coalesce(F.crc32(F.col("row.doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False)).alias("held_out"),
                      "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte")


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids packed into sequences of 4096 tokens."""
    from .packing import pack, token_pieces
    pieces = token_pieces(load_table(spark, sf_dir, "documents"), "text", tokenizer_path("word_bpe_49k.json"), ["doc_id"])
    placed = pack(pieces.select("item", "length"))
    digest = pieces.select("item", "row.doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return digest.join(placed, "item").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "bound")


def learned_languages(spark: SparkSession, sf_dir: str):
    """The language network of a folder's ``documents``: two thirds of them are open to learning."""
    from .lang_id import train
    docs = load_table(spark, sf_dir, "documents")
    name = F.col("doc_id").cast("string")
    return train(docs.filter(F.crc32(name.cast("binary")) % 3 != 1), "text", "lang", F.md5(name.cast("binary")))


@query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text."""
    from .lang_id import predict
    out = predict(load_table(spark, sf_dir, "documents"), "text", learned_languages(spark, sf_dir), ["doc_id"])
    held = F.crc32(F.col("row.doc_id").cast("string").cast("binary")) % 3 == 1
    return out.select("row.doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op3_sharding", """
WITH d AS (
  SELECT doc_id, source, text, coalesce(strlen(text), 0) + 8 AS size,
         md5('1:' || coalesce(doc_id::VARCHAR, 'null')) AS h FROM documents),
bytes AS (
  SELECT doc_id, source, size, h, list_transform(range(1, 2 * (size - 8) + 1, 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT) AS b
  FROM (SELECT *, hex(encode(coalesce(text, ''))) AS x FROM d)),
step AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) AS v
    FROM range(256) r(i))),
summed AS (
  SELECT doc_id, source, size, h,
         xor(list_reduce(b, lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS crc
  FROM bytes, step),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY h, doc_id, size, crc) - 1 AS r, count(*) OVER (PARTITION BY source) AS n,
         ('0x' || substr(md5('1:source:' || coalesce(source, 'null')), 1, 8))::BIGINT::DOUBLE / 4294967296::DOUBLE AS u FROM summed),
placed AS (
  SELECT *, row_number() OVER (ORDER BY (r + u) / n, h, doc_id, size, crc, source NULLS FIRST) - 1 AS place, count(*) OVER () AS total FROM ranked)
SELECT doc_id, size, crc::BIGINT AS text_crc32, 'rows' AS law, (place * 24 // total)::INT AS shard,
       place - ((place * 24 // total) * total + 23) // 24 AS slot, NULL::INT AS grown_shard, source
FROM placed
""")
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of equal row counts, each with the sources' mixture."""
    from .sharding import interleave
    text = F.coalesce("text", F.lit("")).cast("binary")
    docs = load_table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    out = interleave(docs, F.col("source"), F.col("doc_id"), [F.col("doc_id"), F.col("size"), F.col("text_crc32")], 24)
    return out.select("row.doc_id", "row.size", "row.text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "row.source")


@query("op8_decontamination")
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage, with the passage's place.

    A passage: at least 13 aligned words (all words of a shorter item) whose matches exceed three times the
    substitutions; items of fewer than ten words count only unchanged.
    """
    from .decontaminate import overlaps
    out = overlaps(load_table(spark, sf_dir, "documents"), "text", load_table(spark, sf_dir, "benchmark"), "item_id", "text", ["doc_id"])
    return out.select("row.doc_id", "item_id", "doc_start", "doc_end", "item_start", "item_end", "n_words", "n_matches")


@query("op2_maxscore", """
WITH v AS (
  SELECT vec_id, min(c) AS c FROM (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS c FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
  GROUP BY vec_id),
pairs AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.c::DOUBLE[], d.c::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id % 20 = 0 AND q.vec_id <> d.vec_id)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= 20
""")
def op2_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best vectors of every twentieth one, by integer inner product."""
    from .maxscore import top_k

    def scaled(x):
        """floor(64 * x) as a double: one of 2**53 or more in size is whole already."""
        y = F.lit(64.0) * x.cast("double")
        return F.when(F.abs(y) < 2.0 ** 53, F.floor(y).cast("double")).otherwise(y)
    whole = load_table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", scaled).alias("v"))
    return top_k(whole, "vec_id", "v", F.col("id") % 20 == 0, 20)


@query("op10_warc", """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
k AS (SELECT b, max(page_id) AS keeper FROM p WHERE octet_length(b) >= 1000 GROUP BY b HAVING count(*) > 1)
SELECT page_id, octet_length(p.b) AS payload_bytes, sha1(p.b) AS payload_digest,
       CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM p LEFT JOIN k ON p.b = k.b
""")
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC bundles and read back."""
    from .warc import archive_folder, read_archive, write_archive
    index = write_archive(load_table(spark, sf_dir, "pages"), archive_folder(spark))
    return read_archive(index, payload=False).drop("url")


@query("op11_byte_bpe")
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded again, as digests."""
    import public_tokenizers

    from .byte_bpe import decode, encode
    path, pattern = tokenizer_path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    ids = encode(load_table(spark, sf_dir, "documents"), "text", path, pattern, ["doc_id"])
    ids = ids.select("row.doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "ids")
    back = decode(ids, "ids", path, pattern, ["doc_id", "n_tokens", "ids_sha256"])
    return back.select("row.*", F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


#: Tree levels that the SQL of op12 unrolls: trees of up to 8 ** 9 leaves.
_SQL_LEVELS = 9


def _merkle_sql() -> str:
    """SQL of op12: levels and paths unrolled, one table expression a level."""
    parts = ["""
fields AS (
  SELECT doc_id, lang, text, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
step AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) AS v
    FROM range(256) r(i))),
docs AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS h,
         sha256(head || coalesce(strlen(low) || ':' || low, '-')) AS low_h,
         xor(list_reduce(list_transform(range(1, strlen(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT),
                         lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) % 3 = 0 AS hit
  FROM fields, step),
a0 AS (
  SELECT lang AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS i,
         count(*) OVER (PARTITION BY lang) AS n, h, doc_id, low_h, hit FROM docs)"""]

    def climb(name: str) -> None:
        for k in range(_SQL_LEVELS):
            parts.append(f"""
{name}{k}s AS (
  SELECT *, coalesce(string_agg(h, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lo,
         coalesce(string_agg(h, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS hi
  FROM {name}{k} WINDOW r AS (PARTITION BY tree, i // 8 ORDER BY i)),
{name}{k + 1} AS (
  SELECT tree, i // 8 AS i, CASE WHEN n > 1 THEN (n + 7) // 8 ELSE 1 END AS n,
         CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h
  FROM {name}{k} GROUP BY tree, i // 8, n)""")

    climb("a")
    parts.append(f"""
b0 AS (SELECT 0 AS tree, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS i, count(*) OVER () AS n, h, tree AS lang FROM a{_SQL_LEVELS})""")
    climb("b")
    parts.append("""
f0 AS (SELECT a.doc_id, a.tree, a.i, a.h AS leaf, CASE WHEN hit AND low_h IS NOT NULL THEN low_h ELSE h END AS acc, '' AS sib FROM a0 a)""")
    at = 0
    for name in "ab":
        for k in range(_SQL_LEVELS):
            keep = "f.subroot, " if name == "b" else ""
            parts.append(f"""
f{at + 1} AS (
  SELECT f.doc_id, f.tree, f.i // 8 AS i, f.leaf, {keep}CASE WHEN s.n > 1 THEN sha256(s.lo || f.acc || s.hi) ELSE f.acc END AS acc, f.sib || s.lo || s.hi AS sib
  FROM f{at} f JOIN {name}{k}s s ON f.tree IS NOT DISTINCT FROM s.tree AND f.i = s.i)""")
            at += 1
        if name == "a":
            parts.append(f"""
f{at + 1} AS (
  SELECT f.doc_id, 0 AS tree, b.i, f.leaf, b.h AS subroot, f.acc, f.sib FROM f{at} f JOIN b0 b ON f.tree IS NOT DISTINCT FROM b.lang)""")
            at += 1
    return "WITH" + ",".join(parts) + f"""
SELECT doc_id, leaf, subroot, r.h AS root, sha256(sib) AS proof_sha256, acc AS folded_root, acc = r.h AS verified
FROM f{at}, b{_SQL_LEVELS} r"""


@query("op12_merkle", _merkle_sql())
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and recomputed root; a third of them tampered with."""
    from .merkle import fold, leaf_digest, manifest, proofs, siblings_digest
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = load_table(spark, sf_dir, "documents").select(
        "doc_id", "lang", leaf_digest(*head, F.col("text")).alias("leaf"),
        F.when(hit, leaf_digest(*head, F.translate("text", upper, upper.lower()))).alias("tampered"))
    made = manifest(rows, "lang", ["doc_id"], "leaf", ["doc_id", "tampered"])
    out = proofs(made).withColumn("folded_root", fold(F.coalesce("row.tampered", "leaf"), F.col("path")))
    return out.select("row.doc_id", "leaf", "subroot", "root", siblings_digest(F.col("path")).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


@query("op13_alignment")
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers over every text's bytes: groups, links, and how common the links are."""
    import public_tokenizers

    from .alignment import align
    out = align(load_table(spark, sf_dir, "documents"), "text", tokenizer_path("byte_bpe_50k.json"), public_tokenizers.PATTERN,
                tokenizer_path("piece_bpe_32k.model"), ["doc_id"])
    return out.select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links")
