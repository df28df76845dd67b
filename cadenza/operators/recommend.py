"""Similarity and recommendation (REC-01 … REC-16) as joins over feature tables.

Features are materialised ONCE as tables instead of being re-vectorised per
request:

* ``postings``  (item, comp, term, w): TF-IDF (or binary) weights, L2-normalised
  per (item, comp).  Sparse, partitioned by (comp, term) when scored.
* ``numeric``   (item, vec array<double>): the z-scored numeric block.

A request -- one seed item, one user, or a batch of users -- is a join
against them: ``history ⋈ postings → profile → ⋈ postings on (comp, term) →
sum → anti-join heard → top-n``.  Nothing is collected before the final
top-n.  Cost is linear in the postings that share a term with the query; a
batch of users costs the sum of its users, and top-n per user is a
``row_number() <= n`` that Spark turns into a partial WindowGroupLimit.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, tasks_for
from ..functions.ids import normal_noise, uniform_noise
from ..functions.standardise import tokenize

# Scores are ranked on this many decimals, then by key: sums of the same terms
# in a different order can differ in the last bit, and exact ties must stay ties.
RANK_DIGITS = 9


# ----------------------------------------------------------------- features

def catalogue_features(items: DataFrame, key: str, text_sources: Sequence[tuple[DataFrame, str, str, str]] = (),
                       numeric: DataFrame | None = None) -> DataFrame:
    """REC-01: per item, distinct-values text per component (AGG-21) + numerics (left).

    ``text_sources``: (frame, key col, value col, output col) -- each becomes
    ``string_agg(DISTINCT value, ' ')`` per item.
    """
    out = items
    for df, k, v, alias in text_sources:
        agg = (df.groupBy(F.col(k).alias(key))
               .agg(F.array_join(F.array_sort(F.collect_set(v)), " ").alias(alias)))
        out = out.join(agg, key, "left")
    if numeric is not None:
        out = out.join(numeric, key, "left")
    return out


def text_postings(items: DataFrame, key: str, components: dict[str, str], *,
                  stop_words: Sequence[str] | None = None, binary: bool = False) -> DataFrame:
    """REC-02 / REC-03: postings (item, comp, term, w).

    TF-IDF as the source application's vectoriser: tf = raw count, idf =
    ln((1 + n) / (1 + df)) + 1 with n = number of items, then L2 norm per
    (item, comp).  ``binary=True`` gives presence vectors (weight 1, same
    normalisation).  Empty text gives no posting (a zero vector: cosine 0).
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("comp"), F.col(col).cast("string").alias("text"))
                                for c, col in components.items()]))
    docs = items.select(F.col(key).alias("item"), pairs.alias("__p")).select("item", "__p.comp", "__p.text")
    terms = docs.select("item", "comp", F.explode(tokenize(F.col("text"), stop_words)).alias("term"))
    # read three times below: tokenised once
    tf = cut_lineage(terms.groupBy("item", "comp", "term").agg(F.count(F.lit(1)).alias("tf")), "tf")
    if binary:
        weighted = tf.select("item", "comp", "term", F.lit(1.0).alias("w"))
    else:
        n_items = items.select(key).agg(F.count(F.lit(1))).scalar()
        dfreq = tf.groupBy("comp", "term").agg(F.count(F.lit(1)).alias("df"))
        weighted = (tf.join(dfreq, ["comp", "term"])
                    .select("item", "comp", "term",
                            (F.col("tf") * (F.log((1.0 + n_items) / (1.0 + F.col("df"))) + 1.0)).alias("w")))
    weighted = weighted.repartition(tasks_for(tf.count()), "item", "comp")           # the window's sort in tasks of bounded size
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("item", "comp")))     # one item's terms
    return cut_lineage(weighted.select("item", "comp", "term", (F.col("w") / norm).alias("w")), "postings")


def _column_scales(items: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """(mean, scale) of each column with null as 0: the population std, 1 without variance.  ONE aggregate."""
    if not cols:
        return {}
    filled = items.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"x{i}") for i, c in enumerate(cols)])
    row = filled.agg(*[F.avg(f"x{i}").alias(f"m_{i}") for i in range(len(cols))],
                     *[F.stddev_pop(f"x{i}").alias(f"s_{i}") for i in range(len(cols))]).collect()[0]
    return {c: (row[f"m_{i}"] or 0.0, row[f"s_{i}"] or 1.0) for i, c in enumerate(cols)}


def numeric_block(items: DataFrame, key: str, cols: Sequence[str], scaler: dict | None = None) -> DataFrame:
    """REC-04: (item, vec) with null → 0, then z-score with the population std
    (zero variance ⇒ scale 1), or with a fitted ``scaler``.  The column
    statistics are inlined as literals."""
    scaler = scaler or _column_scales(items, cols)
    scaled = [(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.lit(scaler[c][0])) / F.lit(scaler[c][1]) for c in cols]
    return items.select(F.col(key).alias("item"), (F.array(*scaled) if scaled else F.array().cast("array<double>")).alias("vec"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def _norm(a: Column) -> Column:
    return F.sqrt(_dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; 0 when either is the zero vector."""
    den = _norm(a) * _norm(b)
    return F.when(den > 0, _dot(a, b) / den).otherwise(F.lit(0.0))


# ------------------------------------------------------------------ scoring

def _text_scores(query_postings: DataFrame, postings: DataFrame, qkey: str, one_item: bool = False) -> DataFrame:
    """Cosine per (qkey, item, comp) between query vectors and item vectors.

    Query vectors need not be unit length: they are divided by their norm
    here.  Only items sharing a term appear (others score 0).  The terms of ``one_item`` are broadcast: by
    (comp, term), a frequent term's postings would be one task."""
    qn = query_postings.groupBy(qkey, "comp").agg(F.sqrt(F.sum(F.col("qw") * F.col("qw"))).alias("__qn"))
    q = query_postings.join(qn, [qkey, "comp"]).select(qkey, "comp", "term", (F.col("qw") / F.col("__qn")).alias("qw"))
    return ((F.broadcast(q) if one_item else q).join(postings, ["comp", "term"])
            .groupBy(qkey, "item", "comp").agg(F.sum(F.col("qw") * F.col("w")).alias("sim")))


def item_similarity(postings: DataFrame, numeric: DataFrame, catalogue: DataFrame, key: str, seed_item,
                    n_text_components: int, *, audio_weight: float = 0.5, noise_sigma: float = 0.0,
                    noise_seed: int = 0, top_n: int = 10) -> DataFrame:
    """REC-05 (mk1: w = 0.5; mk2: w in [0, 1] + seeded N(0, σ) noise).

    score = w·cos(audio) + (1 − w)·mean over text components of cos; the
    seed item is excluded.  ``seed_item`` is a literal or a scalar Column.
    """
    if not 0.0 <= audio_weight <= 1.0:
        raise ValueError("audio_weight must be in [0, 1]")
    seed = seed_item if isinstance(seed_item, Column) else F.lit(seed_item)
    qp = postings.filter(F.col("item") == seed).select(F.lit(0).alias("__q"), "comp", "term", F.col("w").alias("qw"))
    text = (_text_scores(qp, postings, "__q", one_item=True).groupBy("item")
            .agg((F.sum("sim") / float(n_text_components)).alias("text_sim")))
    seed_vec = numeric.filter(F.col("item") == seed).select("vec").scalar()
    # Scalars are projected as a column first: sub-queries may not sit inside
    # higher-order functions, column references may.
    items = (catalogue.select(F.col(key).alias("item")).join(numeric, "item", "left")
             .withColumn("__seed_vec", seed_vec))
    scored = (items.join(text, "item", "left")
              .withColumn("audio_sim", F.coalesce(cosine(F.col("vec"), F.col("__seed_vec")), F.lit(0.0)))
              .withColumn("score", F.lit(audio_weight) * F.col("audio_sim")
                          + F.lit(1.0 - audio_weight) * F.coalesce(F.col("text_sim"), F.lit(0.0))))
    if noise_sigma > 0:
        scored = scored.withColumn("score", F.col("score") + normal_noise(F.col("item"), noise_seed, noise_sigma))
    return (scored.filter(F.col("item") != seed).orderBy(F.desc(F.round("score", RANK_DIGITS)), F.asc("item")).limit(top_n)
            .select(F.col("item").alias(key), "score"))


@dataclass
class FittedItems:
    """REC-02/04/05: what fitting a catalogue leaves behind, as written tables, for any number of requests.

    ``postings`` (item, comp, term, w), ``vocabulary`` (comp, term, idf), ``numeric`` (item, vec) and the
    ``scaler`` (column -> (mean, scale)) that an unseen item is transformed with.
    """
    key: str
    components: dict[str, str]
    stop_words: Sequence[str] | None
    binary: bool
    postings: DataFrame
    vocabulary: DataFrame
    numeric: DataFrame
    scaler: dict[str, tuple[float, float]]

    def transform(self, payload: dict) -> tuple[DataFrame, list[float]]:
        """(postings comp, term, qw; numeric vector) of an item that is not in the catalogue.

        ``payload`` holds the components' texts and the numeric columns' values by name; what is missing or
        None counts as '' and 0.  Terms that the vocabulary does not hold are dropped.
        """
        spark = self.postings.sparkSession
        texts = spark.createDataFrame([(c, payload.get(c)) for c in self.components], "comp string, text string")
        terms = texts.select("comp", F.explode(tokenize(F.col("text"), self.stop_words)).alias("term"))
        counts = terms.groupBy("comp", "term").agg(F.count(F.lit(1)).alias("tf"))
        weight = F.lit(1.0) if self.binary else F.col("tf") * F.col("idf")
        known = self.vocabulary.join(F.broadcast(counts), ["comp", "term"])           # the words of one text
        vec = [(float(payload.get(c) or 0.0) - mean) / scale for c, (mean, scale) in self.scaler.items()]
        return known.select("comp", "term", weight.alias("qw")), vec


def fit_items(items: DataFrame, key: str, components: dict[str, str], numeric_cols: Sequence[str], *,
              stop_words: Sequence[str] | None = None, binary: bool = False) -> FittedItems:
    """REC-02/03/04: fit the vectoriser and the scaler once; see :class:`FittedItems`."""
    postings = text_postings(items, key, components, stop_words=stop_words, binary=binary)
    n_items = items.select(key).agg(F.count(F.lit(1))).scalar()
    vocabulary = cut_lineage(postings.groupBy("comp", "term").agg(F.count(F.lit(1)).alias("df"))
                             .withColumn("n", n_items)
                             .select("comp", "term", (F.log((1.0 + F.col("n")) / (1.0 + F.col("df"))) + 1.0).alias("idf")), "vocabulary")
    scaler = _column_scales(items, numeric_cols)
    return FittedItems(key, dict(components), stop_words, binary, postings, vocabulary,
                       numeric_block(items, key, numeric_cols, scaler), scaler)


def payload_similarity(fitted: FittedItems, payload: dict, *, audio_weight: float = 0.5, noise_sigma: float = 0.0,
                       noise_seed: int = 0, top_n: int = 10) -> DataFrame:
    """REC-05 with an ad-hoc item: as :func:`item_similarity`, with no catalogue item left out."""
    if not 0.0 <= audio_weight <= 1.0:
        raise ValueError("audio_weight must be in [0, 1]")
    terms, vec = fitted.transform(payload)
    text = (_text_scores(terms.withColumn("__q", F.lit(0)), fitted.postings, "__q", one_item=True).groupBy("item")
            .agg((F.sum("sim") / float(len(fitted.components))).alias("text_sim")))
    audio = cosine(F.col("vec"), F.array(*[F.lit(float(x)) for x in vec])) if vec else F.lit(0.0)
    scored = fitted.numeric.join(text, "item", "left").withColumn(
        "score", F.lit(audio_weight) * audio + F.lit(1.0 - audio_weight) * F.coalesce("text_sim", F.lit(0.0)))
    if noise_sigma > 0:
        scored = scored.withColumn("score", F.col("score") + normal_noise(F.col("item"), noise_seed, noise_sigma))
    return (scored.orderBy(F.desc(F.round("score", RANK_DIGITS)), F.asc("item")).limit(top_n)
            .select(F.col("item").alias(fitted.key), "score"))


def history_weights(history: DataFrame, catalogue_items: DataFrame, user: str, item: str,
                    count: str) -> DataFrame:
    """REC-12 / JOIN-17: count / Σcount over the history items found in the catalogue."""
    h = history.select(F.col(user).alias("user"), F.col(item).alias("item"), F.col(count).cast("double").alias("c"))
    h = h.join(catalogue_items.select(F.col(item).alias("item")).distinct(), "item")
    tot = h.groupBy("user").agg(F.sum("c").alias("__t"))
    return h.join(tot, "user").select("user", "item", (F.col("c") / F.col("__t")).alias("weight"))


def hybrid_recommend(history: DataFrame, postings: DataFrame, numeric: DataFrame | None, catalogue: DataFrame,
                     key: str, target, *, user: str, item: str, count: str,
                     n_text_components: int, mode: str = "mk1", noise_amplitude: float = 0.0,
                     noise_seed: int = 0, top_n: int = 10) -> DataFrame:
    """REC-08 … REC-11: hybrid user-profile recommender for one target user.

    mk1: mean over text components of cos(profile, item);
    mk2: + the numeric block as one more component;
    mk3: mk2 + uniform [0, amplitude) noise (hash-seeded, reproducible);
    mk4: every numeric feature is its own 1-D component (sign(u)·sign(x)),
    plus the same noise.  Listened items are excluded; top-n.

    ``target`` is a literal or a scalar Column.  The user's numeric profile is
    a scalar sub-query, so every catalogue item is scored in one linear scan
    (the exact semantics: numeric similarity is dense) with no user × item
    product; the text part only touches postings that share a term with the
    user's profile.
    """
    if mode not in ("mk1", "mk2", "mk3", "mk4"):
        raise ValueError(mode)
    tgt = target if isinstance(target, Column) else F.lit(target)
    hist = history.filter(F.col(user) == tgt)
    weights = history_weights(hist, catalogue.select(F.col(key).alias(item)), user, item, count)

    profile = (weights.join(postings, "item").groupBy("user", "comp", "term")
               .agg(F.sum(F.col("weight") * F.col("w")).alias("qw")))
    text = _text_scores(profile, postings, "user").groupBy("item").agg(F.sum("sim").alias("text_sum"))

    n_comp = float(n_text_components)
    items = catalogue.select(F.col(key).alias("item")).join(text, "item", "left")
    text_sum = F.coalesce(F.col("text_sum"), F.lit(0.0))
    if mode == "mk1":
        scored = items.withColumn("score", text_sum / n_comp)
    else:
        uvec = (weights.join(numeric, "item").select(F.posexplode("vec").alias("j", "x"), "weight")
                .groupBy("j").agg(F.sum(F.col("x") * F.col("weight")).alias("u"))
                .agg(F.array_sort(F.collect_list(F.struct("j", "u"))).alias("__u"))
                .select(F.transform("__u", lambda s: s["u"]).alias("uvec"))).scalar()
        items = items.join(numeric, "item", "left").withColumn("__uvec", uvec)
        uvec = F.col("__uvec")
        vec = F.coalesce(F.col("vec"), F.array_repeat(F.lit(0.0), F.size(uvec)))
        if mode in ("mk2", "mk3"):
            num, n_total = cosine(uvec, vec), F.lit(n_comp + 1.0)
        else:
            num = F.aggregate(F.zip_with(uvec, vec, lambda a, b: F.signum(a) * F.signum(b)),
                              F.lit(0.0), lambda acc, v: acc + v)
            n_total = F.lit(n_comp) + F.size(uvec).cast("double")
        scored = items.withColumn("score", (text_sum + num) / n_total)
        if mode in ("mk3", "mk4") and noise_amplitude > 0:
            scored = scored.withColumn("score", F.col("score") + F.lit(noise_amplitude)
                                       * uniform_noise(F.col("item"), noise_seed))
    heard = hist.select(F.col(item).alias("item")).distinct()
    fresh = scored.join(heard, "item", "left_anti")
    return (fresh.orderBy(F.desc(F.round("score", RANK_DIGITS)), F.asc("item")).limit(top_n)
            .select(F.col("item").alias(key), "score"))


# ---------------------------------------------------------- user-based recs

def knn_cosine(vectors: DataFrame, key: str, vec_col: str, target, k: int = 5) -> DataFrame:
    """REC-06 / JOIN-16 / TOP-07: the k nearest vectors by cosine distance
    (1 − cos), self excluded, ties by key.  The target vector is a scalar
    sub-query: one linear scan, no pairs."""
    tgt = target if isinstance(target, Column) else F.lit(target)
    tvec = vectors.filter(F.col(key) == tgt).select(F.col(vec_col).cast("array<double>")).scalar()
    dist = F.lit(1.0) - cosine(F.col(vec_col).cast("array<double>"), F.col("__tv"))
    return (vectors.filter(F.col(key) != tgt).withColumn("__tv", tvec).select(key, dist.alias("distance"))
            .orderBy("distance", key).limit(k)
            .withColumn("neighbour_rank", F.row_number().over(Window.orderBy("distance", key))))


def neighbour_history(neighbours: DataFrame, key: str, history: DataFrame, hist_key: str) -> DataFrame:
    """REC-06 / SET-04 / REC-16: neighbours' histories concatenated in neighbour
    order, duplicates and already-heard items kept (Q-13)."""
    return neighbours.join(history.withColumnRenamed(hist_key, key), key)


def preference_vector(df: DataFrame, key: str, slots: Sequence[tuple]) -> DataFrame:
    """REC-07: dense preference vector from a slot spec (driver-side config).

    Slot kinds: ``("ordinal", col, {label: value}, scale)``, ``("onehot", col,
    label, scale)``, ``("multihot", array_col, {label: value}, scale)`` (the
    last matching label wins, Q-19), ``("numeric", col, scale)``.  Unknown
    labels give 0.
    """
    exprs = []
    for slot in slots:
        kind = slot[0]
        if kind == "ordinal":
            _, col, mapping, scale = slot
            m = F.create_map(*[x for kv in mapping.items() for x in (F.lit(kv[0]), F.lit(float(kv[1])))])
            v = F.coalesce(F.try_element_at(m, F.col(col).cast("string")), F.lit(0.0))
        elif kind == "onehot":
            _, col, label, scale = slot
            v = F.when(F.col(col) == F.lit(label), F.lit(1.0)).otherwise(F.lit(0.0))
        elif kind == "multihot":
            _, col, mapping, scale = slot
            m = F.create_map(*[x for kv in mapping.items() for x in (F.lit(kv[0]), F.lit(float(kv[1])))])
            hits = F.filter(F.transform(F.col(col), lambda x: F.try_element_at(m, x)), lambda x: x.isNotNull())
            v = F.coalesce(F.try_element_at(hits, F.lit(-1)), F.lit(0.0))
        elif kind == "numeric":
            _, col, scale = slot
            v = F.coalesce(F.col(col).cast("double"), F.lit(0.0))
        else:
            raise ValueError(f"unknown slot kind {kind}")
        exprs.append(v / float(scale))
    return df.select(key, F.array(*exprs).alias("vector"))


def profile_similarity(profiles: DataFrame, key: str, target, attributes: Sequence[tuple]) -> DataFrame:
    """REC-13: additive attribute-match score of every other profile vs the target.

    ``attributes``: (column, weight, tolerance or None).  Equality (or
    ``|a − b| <= tolerance``) on non-null values adds the weight.  The
    target's attributes are one scalar sub-query (a struct): no cross join.
    """
    tgt = target if isinstance(target, Column) else F.lit(target)
    cols = [a[0] for a in attributes]
    trow = profiles.filter(F.col(key) == tgt).select(F.struct(*[F.col(c) for c in cols])).limit(1).scalar()
    score = F.lit(0)
    for col, weight, tol in attributes:
        t = trow.getField(col)
        if tol is None:
            hit = F.col(col).isNotNull() & (F.col(col) == t)
        else:
            hit = F.col(col).isNotNull() & t.isNotNull() & (F.abs(F.col(col) - t) <= tol)
        score = score + F.when(hit, F.lit(weight)).otherwise(F.lit(0))
    return profiles.filter(F.col(key) != tgt).select(key, score.alias("score"))


def _genre_gate(df: DataFrame, genre_col: str, target_genres: DataFrame) -> DataFrame:
    """Keep rows whose genre is a target genre -- or all rows when the target
    has no genre preference (the source application's ``has_genres`` branch, set-based)."""
    n_pref = target_genres.agg(F.count(F.lit(1))).scalar()
    flagged = df.join(target_genres.select(F.col("genre").alias(genre_col), F.lit(True).alias("__pref")).distinct(),
                      genre_col, "left")
    return flagged.filter((n_pref == 0) | F.col("__pref").isNotNull()).drop("__pref")


def _first(df: DataFrame, top_n: int | None, *order) -> DataFrame:
    """The first ``top_n`` rows by ``order``, or all as they are."""
    return df if top_n is None else df.orderBy(*order).limit(top_n)


def similar_user_scores(listens: DataFrame, similar: DataFrame, item_genres: DataFrame, target,
                        target_genres: DataFrame, *, user: str, item: str, count: str, top_n: int | None = 10,
                        genre_weighted: bool = True) -> DataFrame:
    """REC-14 / AGG-23 / JOIN-18 / FIL-11: Σ count·max(score, 1) over similar
    users' listens; target's heard items excluded; optional genre gate; > 0."""
    tgt = target if isinstance(target, Column) else F.lit(target)
    l = listens.select(F.col(user).alias("user"), F.col(item).alias("item"), F.col(count).alias("cnt"))
    heard = l.filter(F.col("user") == tgt).select("item").distinct()
    sim = similar.select(F.col(user).alias("user"), "score")
    rows = l.join(sim, "user")
    genres = item_genres.select(F.col(item).alias("item"), "genre")
    if not genre_weighted:
        genres = genres.distinct()
    rows = rows.join(genres, "item", "left")
    rows = _genre_gate(rows, "genre", target_genres).join(heard, "item", "left_anti")
    agg = (rows.groupBy("item").agg(F.sum(F.col("cnt") * F.greatest(F.col("score"), F.lit(1))).alias("total_score"))
           .filter(F.col("total_score") > 0))
    return _first(agg, top_n, F.desc("total_score"), F.asc("item")).select(F.col("item").alias(item), "total_score")


def fallback_recommend(listens: DataFrame, similar: DataFrame, item_genres: DataFrame, genre_prefs: DataFrame,
                       target, target_genres: DataFrame, *, user: str, item: str, count: str,
                       top_n: int | None = 10, seed: int = 0) -> DataFrame:
    """REC-15: similar users → global popularity → genre-preference popularity.

    All three tiers are computed as one union with a ``tier`` column and the
    lowest non-empty tier is kept (a scalar ``min``): no driver branching.
    Tier 3 breaks score ties with a seeded hash instead of ``random()``.
    ``top_n`` None ranks every candidate of each tier.
    """
    t1 = similar_user_scores(listens, similar, item_genres, target, target_genres, user=user, item=item,
                             count=count, top_n=top_n).select(item, F.col("total_score").cast("double").alias("score"),
                                                              F.lit(1).alias("tier"))
    l = listens.select(F.col(item).alias("item"), F.col(count).alias("cnt"))
    g = item_genres.select(F.col(item).alias("item"), "genre")
    pop = _genre_gate(l.join(g, "item", "left"), "genre", target_genres)
    t2 = (_first(pop.groupBy("item").agg(F.sum("cnt").cast("double").alias("score")), top_n, F.desc("score"), F.asc("item"))
          .select(F.col("item").alias(item), "score", F.lit(2).alias("tier")))
    pref_counts = genre_prefs.groupBy("genre").agg(F.count(F.lit(1)).alias("pc"))
    cand = _genre_gate(item_genres.select(F.col(item).alias("item"), "genre"), "genre", target_genres)
    t3 = (_first(cand.join(pref_counts, "genre", "left").groupBy("item")
                 .agg(F.max(F.coalesce(F.col("pc"), F.lit(0))).cast("double").alias("score")),
                 top_n, F.desc("score"), uniform_noise("item", seed), "item")
          .select(F.col("item").alias(item), "score", F.lit(3).alias("tier")))
    tiers = t1.unionByName(t2).unionByName(t3)
    if top_n is None:                                # any number of rows: written once, one distributed sort of the kept tier
        every = cut_lineage(tiers, "tiers")
        tie = F.when(F.col("tier") == 3, uniform_noise(item, seed)).otherwise(F.lit(0.0))
        return every.filter(F.col("tier") == every.agg(F.min("tier")).scalar()).orderBy(F.desc("score"), tie, item)
    # At most 3·top_n rows after the per-tier limits: a global window over
    # them is tiny, and each tier is computed once.
    return (tiers.withColumn("__best", F.min("tier").over(Window.partitionBy()))
            .filter(F.col("tier") == F.col("__best")).drop("__best"))
