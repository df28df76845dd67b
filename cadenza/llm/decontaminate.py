"""Benchmark decontamination by spaced-seed hashing (operator 8), with DataFrame functions only.

Each window of a text is hashed through fixed masks that skip some of its
words, so a window still hits a benchmark's when the words it skips were
changed.  Hits of test and training hashes name an alignment of a document with
an item; the words aligned around it are then compared one by one.  Of the runs
of at least ``min_words`` words, the best one by matches less PENALTY for each
substitution is taken if that is above 0 (more than three words in four match),
then the best ones of what lies before and behind it, and so on.

The masks miss no such run.  For 10 to 22 words the tests go through every
placement of the substitutions that leaves a positive score: some window keeps
clear of them.  A longer run of positive score has a half of positive score, of
11 words at least, and so on down to 22 or fewer.  Items shorter than a window
are looked up as a whole, unchanged.

Only windows whose hashed words all occur in the benchmark are hashed: a window
with another word cannot hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage

#: Fixed masks: 1 marks a word that is hashed, 0 one that is ignored.
MASKS = ("1010011001", "1100100011", "0011110010", "0110001110", "1101010100", "0001101101", "1111100000")
SPAN = len(MASKS[0])
PENALTY = 3
#: Seeds of the benchmark, or keys of texts that hit one, that may be broadcast (about 40 bytes each); more of them are joined by shuffle.
BROADCAST_SEEDS = 500_000
#: Distinct words of the benchmark that windows are sifted by (a list in the plan); with more of them every window is hashed.
SIFTING_WORDS = 100_000


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; null has none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _key(text: str) -> Column:
    """128 bits that stand for a text; null has its own."""
    return F.coalesce(F.md5(F.col(text).cast("binary")), F.lit("null"))


def _bind(value: Column, then) -> Column:
    """``then(value)``, with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _windows(hashes: Column, known: list[int] | None) -> Column:
    """pos * 2 ** SPAN + bits of every window that some mask may hit; bit i from the left: whether its word i is known."""
    ones = 2 ** SPAN - 1
    if known is None:
        return F.transform(F.sequence(F.lit(0), F.size(hashes) - SPAN), lambda at: at.cast("long") * 2 ** SPAN + ones)
    wanted = [int(m, 2) for m in MASKS]
    good = [x for x in range(2 ** SPAN) if any(x & m == m for m in wanted)]
    n = F.size(hashes)

    def wider(left, right, skip, bits, length):
        """Patterns of ``length`` words from those of their first and last ones, which begin ``skip`` words later."""
        return F.zip_with(F.slice(left, F.lit(1), n - length + 1), F.slice(right, F.lit(skip + 1), n - length + 1), lambda x, y: x * 2 ** bits + y)

    def sifted(ten):
        marked = F.transform(ten, lambda x, i: F.when(x.isin(good), i.cast("long") * 2 ** SPAN + x))
        return F.filter(marked, lambda x: x.isNotNull())

    one = F.transform(hashes, lambda h: F.when(h.isin(known), F.lit(1)).otherwise(F.lit(0)))
    return _bind(one, lambda w1: _bind(wider(w1, w1, 1, 1, 2), lambda w2: _bind(wider(w2, w2, 2, 2, 4), lambda w4: sifted(
        wider(wider(w4, w4, 4, 4, 8), w2, 8, 2, 10)))))


def _seeds(hashes: Column, short: list[int], known: list[int] | None) -> Column:
    """(pos, seed) of every window of every mask; for each of the ``short`` lengths also of every run of so many words."""
    kind = "array<struct<pos:int,seed:bigint>>"

    def masked(at, bits, number, mask):
        kept, m = [i for i, c in enumerate(mask) if c == "1"], int(mask, 2)
        return F.when(bits.bitwiseAND(m) == m, F.struct(at.alias("pos"), F.xxhash64(F.lit(number), *[F.get(hashes, at + i) for i in kept]).alias("seed")))

    def of_window(w):
        at, bits = F.shiftright(w, SPAN).cast("int"), w.bitwiseAND(2 ** SPAN - 1).cast("int")
        return F.filter(F.array(*[masked(at, bits, i, m) for i, m in enumerate(MASKS)]), lambda x: x.isNotNull())

    def runs(number, length):
        found = F.transform(F.sequence(F.lit(0), F.size(hashes) - length), lambda at: F.struct(
            at.alias("pos"), F.xxhash64(F.lit(number), *[F.get(hashes, at + i) for i in range(length)]).alias("seed")))
        return F.when(F.size(hashes) >= length, found).otherwise(F.array().cast(kind))

    windows = F.when(F.size(hashes) >= SPAN, F.flatten(F.transform(_windows(hashes, known), of_window))).otherwise(F.array().cast(kind))
    return F.concat(windows, *[runs(len(MASKS) + n, n) for n in short])


def _exploded(rows: DataFrame, keys: list[str], text: str, short: list[int], known: list[int] | None = None) -> DataFrame:
    """(keys, pos of the window's first word, seed)."""
    hashed = rows.select(*keys, F.transform(words(F.col(text)), lambda w: F.xxhash64(w)).alias("hashes"))
    # outer: the filter that a plain explode implies would be pushed down to the text and hash it anew for each window
    return hashed.select(*keys, F.explode_outer(_seeds(F.col("hashes"), short, known)).alias("at")) \
        .select(*keys, "at.pos", "at.seed").filter("seed is not null")


def _best_run(same: Column, least: Column) -> Column:
    """(best, start, stop) of the best run of at least ``least`` of a list of booleans; the shortest first one of equals."""
    def gain(x):
        return F.when(x, F.lit(1)).otherwise(F.lit(-PENALTY))

    # total: sum up to here; lag: sum up to `least` before; low, low_at: least lag so far and its place
    begin = F.struct(*[F.lit(0).alias(n) for n in ("i", "total", "lag", "low", "low_at", "best", "start", "stop")])

    def step(s, x):
        total, stop = s["total"] + gain(x), s["i"] + 1
        lag = F.when(stop > least, s["lag"] + gain(F.get(same, stop - least - 1))).otherwise(F.lit(0))
        lower = (stop >= least) & (lag <= s["low"])
        low, low_at = F.when(lower, lag).otherwise(s["low"]), F.when(lower, stop - least).otherwise(s["low_at"])
        better = (stop >= least) & (total - low > s["best"])
        return F.struct(stop.alias("i"), total.alias("total"), lag.alias("lag"), low.alias("low"), low_at.alias("low_at"),
                        F.when(better, total - low).otherwise(s["best"]).alias("best"),
                        F.when(better, low_at).otherwise(s["start"]).alias("start"),
                        F.when(better, stop).otherwise(s["stop"]).alias("stop"))
    return F.aggregate(same, begin, step)


def _runs(aligned: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, item_start, n_words, n_matches) of every run of (keys, lo: first item word, least, same: list of booleans)."""
    parts, open_ = [], aligned
    while True:
        step = cut_lineage(open_.withColumn("run", _best_run(F.col("same"), F.col("least"))).filter("run.best > 0"), "aligned-runs")
        length = F.col("run.stop") - F.col("run.start")
        parts.append(step.select(*keys, (F.col("lo") + F.col("run.start")).alias("item_start"), length.alias("n_words"),
                                 ((F.col("run.best") + PENALTY * length) / (1 + PENALTY)).cast("int").alias("n_matches")))
        before = F.struct(F.col("lo").alias("lo"), F.slice("same", F.lit(1), F.col("run.start")).alias("same"))
        behind = F.struct((F.col("lo") + F.col("run.stop")).alias("lo"),
                          F.slice("same", F.col("run.stop") + 1, F.size("same") - F.col("run.stop")).alias("same"))
        rest = step.select(*keys, "least", F.explode(F.array(before, behind)).alias("rest")) \
            .select(*keys, "least", "rest.lo", "rest.same").filter(F.size("same") >= F.col("least"))
        # a round for each run of an alignment that lies inside what another left: at most an item's words by min_words
        if rest.isEmpty():
            break
        open_ = rest
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    return found


def overlaps(docs: DataFrame, text_col: str, items: DataFrame, item_id: str, item_text: str, carry: list[str],
             min_words: int = 13) -> DataFrame:
    """Benchmark passages in whole texts.

    Returns one row for each input row and aligned run: (row struct of
    ``carry``, item_id, doc_start, doc_end, item_start, item_end: word positions,
    n_words, n_matches int).  A run holds at least ``min_words`` aligned words (all
    words of a shorter item).  Words are runs of letters and
    digits, lower-cased.  Null and empty texts hold none; equal items each give their
    rows; repeated rows and null ids are reported as they come.
    """
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{text_col}`").alias("text")) \
        .withColumn("text_key", _key("text"))
    tests = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{item_text}`").alias("item_text")).distinct()
    size = F.size(words(F.col("item_text")))
    short = sorted(r.n for r in tests.select(size.alias("n")).filter(F.col("n").between(1, SPAN - 1)).distinct().collect())   # below SPAN
    keyed = tests.withColumn("item_key", _key("item_text")).select("item_key", "item_text", size.alias("n")).distinct()
    seeds = _exploded(keyed.filter(F.col("n") >= SPAN), ["item_key"], "item_text", [])
    for n in short:
        seeds = seeds.unionByName(_exploded(keyed.filter(F.col("n") == n), ["item_key"], "item_text", [n]))
    seeds = cut_lineage(seeds.withColumnRenamed("pos", "item_pos"), "seeds")
    probe = F.broadcast(seeds) if seeds.count() <= BROADCAST_SEEDS else seeds
    vocabulary = keyed.select(F.explode(F.transform(words(F.col("item_text")), lambda w: F.xxhash64(w))).alias("h")).distinct()
    known = [r.h for r in vocabulary.limit(SIFTING_WORDS + 1).collect()]          # of the benchmark, not of the documents
    known = known if 0 < len(known) <= SIFTING_WORDS else None
    hits = _exploded(held, ["text_key"], "text", short, known).join(probe, "seed") \
        .select("text_key", "item_key", (F.col("pos") - F.col("item_pos")).alias("shift")).distinct()
    hits = cut_lineage(hits, "seed-hits")

    hit = cut_lineage(hits.select("text_key").distinct(), "hit-texts")
    hit = F.broadcast(hit) if hit.count() <= BROADCAST_SEEDS else hit           # else the texts are shuffled once
    texts = held.select("text_key", "text").join(hit, "text_key", "left_semi").groupBy("text_key") \
        .agg(F.first("text").alias("text")).select("text_key", words(F.col("text")).alias("dw"))
    test_words = tests.withColumn("item_key", _key("item_text")).groupBy("item_key").agg(F.first("item_text").alias("t")) \
        .select("item_key", words(F.col("t")).alias("iw"))
    lo, hi = F.greatest(F.lit(0), -F.col("shift")), F.least(F.size("iw"), F.size("dw") - F.col("shift")) - 1
    least = F.least(F.lit(min_words), F.size("iw"))
    aligned = hits.join(texts, "text_key").join(test_words, "item_key").withColumn("lo", lo).select(
        "text_key", "item_key", "shift", "lo", least.alias("least"),
        F.transform(F.sequence("lo", hi), lambda j: F.get("iw", j) == F.get("dw", j + F.col("shift"))).alias("same")) \
        .filter(F.size("same") >= F.col("least"))
    aligned = cut_lineage(aligned, "aligned")             # each list is compared once and read often
    found = _runs(aligned, ["text_key", "item_key", "shift"]).withColumn("item_end", F.col("item_start") + F.col("n_words"))
    found = cut_lineage(found, "overlaps")
    named = tests.select("item_id", _key("item_text").alias("item_key"))
    return held.select("row", "text_key").join(found, "text_key").join(named, "item_key").select(
        "row", "item_id", (F.col("item_start") + F.col("shift")).alias("doc_start"), (F.col("item_end") + F.col("shift")).alias("doc_end"),
        "item_start", "item_end", "n_words", "n_matches")


def without_overlaps(docs: DataFrame, text_col: str, items: DataFrame, item_id: str, item_text: str, min_words: int = 13) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark passage, as they are."""
    bad = overlaps(docs.select(F.col(f"`{text_col}`").alias("text")), "text", items, item_id, item_text, ["text"], min_words) \
        .select(_key("row.text").alias("_text_key")).distinct()
    bad = cut_lineage(bad, "contaminated")
    return docs.withColumn("_text_key", _key(f"`{text_col}`")).join(bad, "_text_key", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
