"""Recommendation queries on the driver tables.

Mapping: catalogue = part (text components title = p_name, artist = p_brand,
genre = p_type; numeric block p_size, p_retailprice); users = customers;
listens = (o_custkey, l_partkey, number of lines); the target user is the
heaviest listener and the seed item the most-listened part (ties: smallest
key), both derived by the query itself.  Noise is off in the oracle-checked
variants (σ = 0); the seeded-noise variant is checked for rows only.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import preferences as P
from ..operators import recommend as R
from ..session import cut_lineage, tasks_for
from .common import T, rnd, spread
from .registry import query

TEXT = {"titles": "p_name", "artists": "p_brand", "genres": "p_type"}
NUMS = ["p_size", "p_retailprice"]
TOP = 20


def _features(spark, sf_dir, binary: bool = False):
    """Catalogue features: TF-IDF postings (user-profile recommenders) or
    binary presence postings (the item-to-item recommender)."""
    part = T(spark, sf_dir, "part")
    return part, R.text_postings(part, "p_partkey", TEXT, binary=binary), R.numeric_block(part, "p_partkey", NUMS)


ITEM_TEXT = {"titles": "p_name", "artists": "artists", "genres": "p_type"}


def _artist_names(spark, sf_dir):
    """(part, supplier's name) per line item, by part in partitions whose number grows with the lines: names, texts and
    terms of a part are all made in its task, so a merged shuffle partition would hold too much."""
    lines = T(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    names = lines.join(T(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), "l_suppkey")
    return names.repartition(tasks_for(lines.count()), "l_partkey")


def _item_features(spark, sf_dir):
    """REC-01: the item-to-item catalogue frame -- title, genre, and the
    distinct names of the suppliers (artists) of each part's line items."""
    part = T(spark, sf_dir, "part")
    lines = _artist_names(spark, sf_dir)
    cat = R.catalogue_features(part.select("p_partkey", "p_name", "p_type", *NUMS), "p_partkey",
                               [(lines, "l_partkey", "s_name", "artists")])
    return (cat, R.text_postings(cat, "p_partkey", ITEM_TEXT, binary=True),
            R.numeric_block(cat, "p_partkey", NUMS))


def _history(spark, sf_dir):
    """(user, item, count), built once: the target, its profile and the scores all read the written table."""
    li = T(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    o = T(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return cut_lineage(li.join(o, "l_orderkey").groupBy("o_custkey", "l_partkey").agg(F.count(F.lit(1)).alias("c")), "history")


def _one_key(df):
    """The request key derived from the data: one value fetched, then used as
    a literal so the scans can push ``key = value`` down."""
    rows = df.limit(1).collect()
    return rows[0][0] if rows else None


def _target_user(hist):
    return _one_key(hist.groupBy("o_custkey").agg(F.sum("c").alias("n")).orderBy(F.desc("n"), "o_custkey")
                    .select("o_custkey"))


def _seed_item(spark, sf_dir):
    return _one_key(T(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
                    .orderBy(F.desc("n"), "l_partkey").select("l_partkey"))


_FEATURES_SQL = """
WITH docs AS (
  SELECT p_partkey AS item, 'titles' AS comp, p_name AS text FROM part
  UNION ALL SELECT p_partkey, 'artists', p_brand FROM part
  UNION ALL SELECT p_partkey, 'genres', p_type FROM part
), terms AS (
  SELECT item, comp, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}_]{2,}')) AS term FROM docs
), tf AS (SELECT item, comp, term, count(*) AS tf FROM terms GROUP BY ALL),
nn AS (SELECT count(*) AS n FROM part),
dfreq AS (SELECT comp, term, count(*) AS df FROM tf GROUP BY ALL),
wt AS (
  SELECT tf.item, tf.comp, tf.term, tf.tf * (ln((1.0 + nn.n) / (1.0 + dfreq.df)) + 1.0) AS w
  FROM tf JOIN dfreq USING (comp, term) CROSS JOIN nn
), norms AS (SELECT item, comp, sqrt(sum(w * w)) AS nrm FROM wt GROUP BY ALL),
postings AS (SELECT wt.item, wt.comp, wt.term, wt.w / norms.nrm AS w FROM wt JOIN norms USING (item, comp)),
num AS (SELECT p_partkey AS item, coalesce(CAST(p_size AS DOUBLE), 0.0) AS x1, coalesce(p_retailprice, 0.0) AS x2 FROM part),
st AS (SELECT avg(x1) AS m1, stddev_pop(x1) AS s1, avg(x2) AS m2, stddev_pop(x2) AS s2 FROM num),
scaled AS (
  SELECT item, (x1 - m1) / (CASE WHEN s1 IS NULL OR s1 = 0 THEN 1.0 ELSE s1 END) AS z1,
         (x2 - m2) / (CASE WHEN s2 IS NULL OR s2 = 0 THEN 1.0 ELSE s2 END) AS z2
  FROM num CROSS JOIN st
), hist AS (
  SELECT o.o_custkey AS usr, l.l_partkey AS item, count(*) AS c
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2
), tgt AS (SELECT usr FROM hist GROUP BY usr ORDER BY sum(c) DESC, usr LIMIT 1)
"""


_BINARY_SQL = _FEATURES_SQL.replace(
    "wt AS (\n  SELECT tf.item, tf.comp, tf.term, tf.tf * (ln((1.0 + nn.n) / (1.0 + dfreq.df)) + 1.0) AS w\n"
    "  FROM tf JOIN dfreq USING (comp, term) CROSS JOIN nn\n)",
    "wt AS (SELECT item, comp, term, 1.0 AS w FROM tf)").replace(
    "  UNION ALL SELECT p_partkey, 'artists', p_brand FROM part\n",
    "  UNION ALL SELECT p.p_partkey, 'artists', a.names FROM part p LEFT JOIN (\n"
    "    SELECT l.l_partkey, string_agg(DISTINCT s.s_name, ' ') AS names\n"
    "    FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey GROUP BY l.l_partkey\n"
    "  ) a ON a.l_partkey = p.p_partkey\n")


@query("item_similarity_text", ("REC-01", "REC-02", "REC-04", "REC-05", "TOP-04", "SCL-27", "AGG-21"),
       _BINARY_SQL + """
, seed AS (SELECT l_partkey AS item FROM lineitem GROUP BY l_partkey ORDER BY count(*) DESC, l_partkey LIMIT 1),
qp AS (SELECT comp, term, w AS qw FROM postings WHERE item = (SELECT item FROM seed)),
qn AS (SELECT comp, sqrt(sum(qw * qw)) AS qn FROM qp GROUP BY comp),
q AS (SELECT comp, term, qw / qn AS qw FROM qp JOIN qn USING (comp)),
txt AS (SELECT p.item, sum(q.qw * p.w) / 3.0 AS text_sim FROM q JOIN postings p USING (comp, term) GROUP BY p.item),
sv AS (SELECT z1 AS v1, z2 AS v2 FROM scaled WHERE item = (SELECT item FROM seed)),
aud AS (
  SELECT s.item, CASE WHEN sqrt(s.z1 * s.z1 + s.z2 * s.z2) * sqrt(v1 * v1 + v2 * v2) > 0
                      THEN (s.z1 * v1 + s.z2 * v2) / (sqrt(s.z1 * s.z1 + s.z2 * s.z2) * sqrt(v1 * v1 + v2 * v2))
                      ELSE 0.0 END AS audio_sim
  FROM scaled s CROSS JOIN sv
), sc AS (
  SELECT a.item, 0.5 * a.audio_sim + 0.5 * coalesce(t.text_sim, 0.0) AS score
  FROM aud a LEFT JOIN txt t USING (item) WHERE a.item <> (SELECT item FROM seed)
)
SELECT item AS p_partkey, round(score, 6) AS score FROM sc ORDER BY round(score, 9) DESC, item LIMIT 20
""")
def item_similarity_text(spark, sf_dir):
    part, postings, numeric = _item_features(spark, sf_dir)
    out = R.item_similarity(postings, numeric, part, "p_partkey", _seed_item(spark, sf_dir), len(ITEM_TEXT),
                            audio_weight=0.5, top_n=TOP)
    return out.select("p_partkey", rnd("score").alias("score"))


def _user_sql(score_expr: str) -> str:
    return _FEATURES_SQL + f"""
, h AS (SELECT hist.item, hist.c FROM hist JOIN part ON part.p_partkey = hist.item WHERE usr = (SELECT usr FROM tgt)),
wts AS (SELECT item, c / sum(c) OVER () AS weight FROM h),
prof AS (SELECT p.comp, p.term, sum(wts.weight * p.w) AS qw FROM wts JOIN postings p USING (item) GROUP BY ALL),
pn AS (SELECT comp, sqrt(sum(qw * qw)) AS qn FROM prof GROUP BY comp),
q AS (SELECT comp, term, qw / qn AS qw FROM prof JOIN pn USING (comp)),
txt AS (SELECT p.item, sum(q.qw * p.w) AS text_sum FROM q JOIN postings p USING (comp, term) GROUP BY p.item),
uv AS (SELECT sum(wts.weight * s.z1) AS u1, sum(wts.weight * s.z2) AS u2 FROM wts JOIN scaled s USING (item)),
sc AS (
  SELECT s.item, {score_expr} AS score
  FROM scaled s LEFT JOIN txt t USING (item) CROSS JOIN uv
  WHERE s.item NOT IN (SELECT item FROM h)
)
SELECT item AS p_partkey, round(score, 6) AS score FROM sc ORDER BY round(score, 9) DESC, item LIMIT 20
"""


_COS_U = ("(CASE WHEN sqrt(u1 * u1 + u2 * u2) * sqrt(s.z1 * s.z1 + s.z2 * s.z2) > 0 "
          "THEN (u1 * s.z1 + u2 * s.z2) / (sqrt(u1 * u1 + u2 * u2) * sqrt(s.z1 * s.z1 + s.z2 * s.z2)) ELSE 0.0 END)")


def _hybrid(spark, sf_dir, mode, noise=0.0):
    part, postings, numeric = _features(spark, sf_dir)
    hist = _history(spark, sf_dir)
    out = R.hybrid_recommend(hist, postings, numeric, part, "p_partkey", _target_user(hist), user="o_custkey",
                             item="l_partkey", count="c", n_text_components=len(TEXT), mode=mode,
                             noise_amplitude=noise, noise_seed=11, top_n=TOP)
    return out.select("p_partkey", rnd("score").alias("score"))


@query("hybrid_user_recs", ("REC-03", "REC-08", "REC-12", "REC-16", "JOIN-17", "JOIN-11"),
       _user_sql("coalesce(t.text_sum, 0.0) / 3.0"))
def hybrid_user_recs(spark, sf_dir):
    return _hybrid(spark, sf_dir, "mk1")


@query("hybrid_numeric_recs", ("REC-09",), _user_sql(f"(coalesce(t.text_sum, 0.0) + {_COS_U}) / 4.0"))
def hybrid_numeric_recs(spark, sf_dir):
    return _hybrid(spark, sf_dir, "mk2")


@query("hybrid_sign_recs", ("REC-11",),
       _user_sql("(coalesce(t.text_sum, 0.0) + (sign(u1) * sign(s.z1) + sign(u2) * sign(s.z2))) / 5.0"))
def hybrid_sign_recs(spark, sf_dir):
    return _hybrid(spark, sf_dir, "mk4")


@query("hybrid_noise_recs", ("REC-10",), _user_sql(
    f"(coalesce(t.text_sum, 0.0) + {_COS_U}) / 4.0 + 0.05 * (('0x' || substr(md5('11:' || s.item::VARCHAR), 1, 12))::BIGINT / 281474976710656.0)"))
def hybrid_noise_recs(spark, sf_dir):
    return _hybrid(spark, sf_dir, "mk3", noise=0.05)


@query("user_knn_cosine", ("REC-06", "JOIN-16", "TOP-07"), """
WITH t AS (SELECT CAST(embedding AS DOUBLE[]) AS tv FROM embeddings WHERE vec_id = (SELECT min(vec_id) FROM embeddings)),
d AS (
  SELECT vec_id, 1.0 - list_cosine_similarity(CAST(embedding AS DOUBLE[]), tv) AS distance
  FROM embeddings CROSS JOIN t WHERE vec_id <> (SELECT min(vec_id) FROM embeddings)
)
SELECT vec_id, round(distance, 6) AS distance, row_number() OVER (ORDER BY distance, vec_id) AS neighbour_rank
FROM d ORDER BY distance, vec_id LIMIT 5
""")
def user_knn_cosine(spark, sf_dir):
    emb = T(spark, sf_dir, "embeddings")
    out = R.knn_cosine(emb, "vec_id", "embedding", _one_key(emb.agg(F.min("vec_id"))), k=5)
    return out.select("vec_id", rnd("distance").alias("distance"), F.col("neighbour_rank").cast("long"))


@query("knn_neighbour_history", ("REC-06", "SET-04", "REC-16"), """
WITH t AS (SELECT CAST(embedding AS DOUBLE[]) AS tv FROM embeddings WHERE vec_id = (SELECT min(vec_id) FROM embeddings)),
nb AS (
  SELECT vec_id, row_number() OVER (ORDER BY 1.0 - list_cosine_similarity(CAST(embedding AS DOUBLE[]), tv), vec_id) AS neighbour_rank
  FROM embeddings CROSS JOIN t WHERE vec_id <> (SELECT min(vec_id) FROM embeddings)
)
SELECT nb.neighbour_rank, d.doc_id FROM nb JOIN documents d ON d.doc_id % (SELECT count(*) FROM embeddings) = nb.vec_id WHERE nb.neighbour_rank <= 5
""")
def knn_neighbour_history(spark, sf_dir):
    """Neighbours' 'histories': documents whose id maps onto the vector id, over all vectors."""
    emb = T(spark, sf_dir, "embeddings")
    nb = R.knn_cosine(emb, "vec_id", "embedding", _one_key(emb.agg(F.min("vec_id"))), k=5)
    docs = T(spark, sf_dir, "documents").select((F.col("doc_id") % emb.count()).alias("vec_id"), "doc_id")
    return R.neighbour_history(nb, "vec_id", docs, "vec_id").select(F.col("neighbour_rank").cast("long"), "doc_id")


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_PRIORITY = {"1-URGENT": 4, "2-HIGH": 3, "3-MEDIUM": 2}


def _slots(vec):
    """(customer, slot, value) of dense vectors.  They are never empty, so the outer form gives the same rows; for the
    inner one Spark adds a filter on the array's size, which computes every slot's expression again for each row."""
    return vec.select("c_custkey", F.posexplode_outer("vector").alias("slot", "value")).select(
        "c_custkey", "slot", rnd("value").alias("value"))


def _pref_slots():
    slots = [("onehot", "c_mktsegment", s, 1.0) for s in _SEGMENTS]
    slots += [("numeric", "c_nationkey", 24.0), ("ordinal", "n_regionkey", {"0": 1, "1": 2, "2": 3, "3": 4, "4": 5}, 6.0),
              ("numeric", "c_acctbal", 10000.0), ("multihot", "priorities", _PRIORITY, 4.0)]
    return slots


def _pref_sql():
    parts = [f"SELECT c_custkey, {i} AS slot, CASE WHEN c_mktsegment = '{s}' THEN 1.0 ELSE 0.0 END AS value FROM base"
             for i, s in enumerate(_SEGMENTS)]
    parts.append("SELECT c_custkey, 5, coalesce(CAST(c_nationkey AS DOUBLE), 0.0) / 24.0 FROM base")
    parts.append("SELECT c_custkey, 6, coalesce(CAST(n_regionkey AS DOUBLE) + 1.0, 0.0) / 6.0 FROM base")
    parts.append("SELECT c_custkey, 7, coalesce(c_acctbal, 0.0) / 10000.0 FROM base")
    parts.append("SELECT c_custkey, 8, coalesce(pv, 0.0) / 4.0 FROM base")
    union = "\nUNION ALL ".join(parts)
    return f"""
WITH pr AS (
  SELECT o_custkey, arg_max(CASE o_orderpriority WHEN '1-URGENT' THEN 4.0 WHEN '2-HIGH' THEN 3.0 ELSE 2.0 END,
                            (o_orderdate, o_orderkey)) AS pv
  FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY o_custkey
), base AS (
  SELECT c.c_custkey, c.c_mktsegment, c.c_nationkey, n.n_regionkey, c.c_acctbal, pr.pv
  FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN pr ON pr.o_custkey = c.c_custkey
)
SELECT c_custkey, CAST(slot AS INTEGER) AS slot, round(value, 6) AS value FROM ({union})
"""


@query("preference_vector", ("REC-07",), _pref_sql())
def preference_vector(spark, sf_dir):
    cust = T(spark, sf_dir, "customer")
    nat = T(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    o = T(spark, sf_dir, "orders")
    # Each customer's distinct priorities ordered by their latest use: the
    # last mapped one is the priority of the latest mapped order, and the
    # array holds at most one entry per priority level (bounded), however
    # many orders a customer has.
    last_use = (o.groupBy(F.col("o_custkey").alias("c_custkey"), "o_orderpriority")
                .agg(F.max(F.struct("o_orderdate", "o_orderkey")).alias("last")))
    pri = (last_use.groupBy("c_custkey")
           .agg(F.array_sort(F.collect_list(F.struct("last", "o_orderpriority"))).alias("s"))
           .select("c_custkey", F.transform("s", lambda x: x["o_orderpriority"]).alias("priorities")))
    base = cust.join(nat, "c_nationkey", "left").join(pri, "c_custkey", "left")
    vec = R.preference_vector(base, "c_custkey", _pref_slots())
    return _slots(vec)


_ATTRS = [("c_nationkey", 3, None), ("c_mktsegment", 2, None), ("n_regionkey", 2, None), ("c_acctbal", 1, 500.0)]


def _profiles(spark, sf_dir):
    nat = T(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    return T(spark, sf_dir, "customer").join(nat, "c_nationkey", "left")


def _genre_prefs(spark, sf_dir):
    li = T(spark, sf_dir, "lineitem").filter(F.col("l_quantity") >= 48).select("l_orderkey", "l_partkey")
    o = T(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    p = T(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("genre"))
    return cut_lineage(li.join(o, "l_orderkey").join(p, "l_partkey").select("o_custkey", "genre").distinct(), "genre-prefs")


_PROFILE_SQL = """
WITH prof AS (
  SELECT c.c_custkey, c.c_nationkey, c.c_mktsegment, n.n_regionkey, c.c_acctbal
  FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
), hist AS (
  SELECT o.o_custkey AS usr, l.l_partkey AS item, count(*) AS c
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2
), tgt AS (SELECT usr FROM hist GROUP BY usr ORDER BY sum(c) DESC, usr LIMIT 1),
t AS (SELECT * FROM prof WHERE c_custkey = (SELECT usr FROM tgt)),
sim AS (
  SELECT p.c_custkey AS usr,
    (CASE WHEN p.c_nationkey IS NOT NULL AND p.c_nationkey = t.c_nationkey THEN 3 ELSE 0 END) +
    (CASE WHEN p.c_mktsegment IS NOT NULL AND p.c_mktsegment = t.c_mktsegment THEN 2 ELSE 0 END) +
    (CASE WHEN p.n_regionkey IS NOT NULL AND p.n_regionkey = t.n_regionkey THEN 2 ELSE 0 END) +
    (CASE WHEN p.c_acctbal IS NOT NULL AND t.c_acctbal IS NOT NULL AND abs(p.c_acctbal - t.c_acctbal) <= 500.0 THEN 1 ELSE 0 END)
    AS score
  FROM prof p CROSS JOIN t WHERE p.c_custkey <> t.c_custkey
), gp AS (
  SELECT DISTINCT o.o_custkey AS usr, p.p_type AS genre
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey
  WHERE l.l_quantity >= 48
), tg AS (SELECT genre FROM gp WHERE usr = (SELECT usr FROM tgt)),
gate AS (SELECT (SELECT count(*) FROM tg) = 0 AS open_all),
t1 AS (
  SELECT h.item, sum(h.c * greatest(s.score, 1)) AS total_score
  FROM hist h JOIN sim s ON s.usr = h.usr LEFT JOIN part pt ON pt.p_partkey = h.item
  WHERE h.item NOT IN (SELECT item FROM hist WHERE usr = (SELECT usr FROM tgt))
    AND ((SELECT open_all FROM gate) OR pt.p_type IN (SELECT genre FROM tg))
  GROUP BY h.item HAVING sum(h.c * greatest(s.score, 1)) > 0
  ORDER BY total_score DESC, h.item LIMIT 20
)
"""


@query("similar_users", ("REC-13", "JOIN-10", "SCL-23"), _PROFILE_SQL + "SELECT usr AS c_custkey, score FROM sim")
def similar_users(spark, sf_dir):
    sim = R.profile_similarity(_profiles(spark, sf_dir), "c_custkey", _target_user(_history(spark, sf_dir)), _ATTRS)
    return sim.select("c_custkey", F.col("score").cast("int").alias("score"))


def _scored(spark, sf_dir):
    hist = _history(spark, sf_dir)
    target = _target_user(hist)
    sim = R.profile_similarity(_profiles(spark, sf_dir), "c_custkey", target, _ATTRS).withColumnRenamed(
        "c_custkey", "o_custkey")
    genres = T(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("genre"))
    prefs = _genre_prefs(spark, sf_dir)
    tgenres = prefs.filter(F.col("o_custkey") == target).select("genre")
    return hist, target, sim, genres, prefs, tgenres


@query("profile_score_recs", ("REC-14", "AGG-23", "JOIN-18", "FIL-10", "FIL-11", "TOP-05"),
       _PROFILE_SQL + "SELECT item AS l_partkey, CAST(total_score AS BIGINT) AS total_score FROM t1")
def profile_score_recs(spark, sf_dir):
    hist, target, sim, genres, _, tgenres = _scored(spark, sf_dir)
    out = R.similar_user_scores(hist, sim, genres, target, tgenres, user="o_custkey", item="l_partkey", count="c",
                                top_n=TOP)
    return out.select("l_partkey", F.col("total_score").cast("long").alias("total_score"))


@query("fallback_recs", ("REC-15", "AGG-24", "AGG-25", "TOP-06"),
       _PROFILE_SQL + """
, t2 AS (
  SELECT h.item, sum(h.c) AS score FROM hist h LEFT JOIN part pt ON pt.p_partkey = h.item
  WHERE (SELECT open_all FROM gate) OR pt.p_type IN (SELECT genre FROM tg)
  GROUP BY h.item ORDER BY score DESC, h.item LIMIT 20
), tiers AS (
  SELECT item, CAST(total_score AS DOUBLE) AS score, 1 AS tier FROM t1
  UNION ALL SELECT item, CAST(score AS DOUBLE), 2 FROM t2
)
SELECT item AS l_partkey, score, tier FROM tiers WHERE tier = (SELECT min(tier) FROM tiers)
""")
def fallback_recs(spark, sf_dir):
    hist, target, sim, genres, prefs, tgenres = _scored(spark, sf_dir)
    out = R.fallback_recommend(hist, sim, genres, prefs.withColumnRenamed("o_custkey", "user"), target, tgenres,
                               user="o_custkey", item="l_partkey", count="c", top_n=TOP, seed=3)
    return out.select("l_partkey", "score", F.col("tier").cast("int").alias("tier"))


# ------------------------------------------------- an item that is not in the catalogue

_PAYLOAD_SQL = _BINARY_SQL + """
, x AS (SELECT p_name || ' zzunseen' AS titles, 'ECONOMY standard' AS genres FROM part WHERE p_partkey = (SELECT max(p_partkey) FROM part)),
names AS (SELECT min(s_name) || ' ' || max(s_name) AS artists FROM supplier),
pt AS (
  SELECT 'titles' AS comp, titles AS text FROM x UNION ALL SELECT 'genres', genres FROM x UNION ALL SELECT 'artists', artists FROM names),
qt AS (SELECT DISTINCT comp, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS term FROM pt),
known AS (SELECT * FROM qt WHERE (comp, term) IN (SELECT (comp, term) FROM tf)),
q AS (SELECT comp, term, 1.0 / sqrt(count(*) OVER (PARTITION BY comp)) AS qw FROM known),
txt AS (SELECT p.item, sum(q.qw * p.w) / 3.0 AS text_sim FROM q JOIN postings p USING (comp, term) GROUP BY p.item),
sv AS (SELECT (25.0 - m1) / s1 AS v1, (0.0 - m2) / s2 AS v2 FROM st),
aud AS (
  SELECT s.item, (s.z1 * v1 + s.z2 * v2) / (sqrt(s.z1 * s.z1 + s.z2 * s.z2) * sqrt(v1 * v1 + v2 * v2)) AS audio_sim FROM scaled s CROSS JOIN sv)
"""


def _payload(spark, sf_dir):
    part, sup = T(spark, sf_dir, "part"), T(spark, sf_dir, "supplier")
    title = part.agg(F.max_by("p_name", "p_partkey")).first()[0]
    names = sup.agg(F.min("s_name"), F.max("s_name")).first()
    return {"titles": f"{title} zzunseen", "artists": f"{names[0]} {names[1]}", "genres": "ECONOMY standard", "p_size": 25, "p_retailprice": None}


def _fitted(spark, sf_dir):
    part = T(spark, sf_dir, "part")
    lines = _artist_names(spark, sf_dir)
    cat = cut_lineage(R.catalogue_features(part.select("p_partkey", "p_name", "p_type", *NUMS), "p_partkey",
                                           [(lines, "l_partkey", "s_name", "artists")]), "catalogue")
    return R.fit_items(cat, "p_partkey", ITEM_TEXT, NUMS, binary=True)


@query("payload_similarity", ("REC-05", "REC-02", "REC-04"), _PAYLOAD_SQL + """
, sc AS (SELECT a.item, 0.2 * a.audio_sim + 0.8 * coalesce(t.text_sim, 0.0) AS score FROM aud a LEFT JOIN txt t USING (item))
SELECT item AS p_partkey, round(score, 6) AS score FROM sc ORDER BY round(score, 9) DESC, item LIMIT 20
""")
def payload_similarity(spark, sf_dir):
    """Items like one that is not in the catalogue (an unseen word, a missing price), audio weight 0.2."""
    out = R.payload_similarity(_fitted(spark, sf_dir), _payload(spark, sf_dir), audio_weight=0.2, top_n=TOP)
    return out.select("p_partkey", rnd("score").alias("score"))


def _uniform_sql(seed: int) -> str:
    return f"(('0x' || substr(md5('{seed}:' || a.item::VARCHAR), 1, 12))::BIGINT / 281474976710656.0)"


@query("payload_similarity_noise", ("REC-05",), _PAYLOAD_SQL + f"""
, sc AS (
  SELECT a.item, 0.2 * a.audio_sim + 0.8 * coalesce(t.text_sim, 0.0)
         + 0.1 * sqrt(-2.0 * ln(greatest({_uniform_sql(5)}, 1e-12))) * cos(2.0 * pi() * {_uniform_sql(5 + 7919)}) AS score
  FROM aud a LEFT JOIN txt t USING (item))
SELECT item AS p_partkey, round(score, 6) AS score FROM sc ORDER BY round(score, 9) DESC, item LIMIT 20
""")
def payload_similarity_noise(spark, sf_dir):
    """The same with seeded normal noise of 0.1."""
    out = R.payload_similarity(_fitted(spark, sf_dir), _payload(spark, sf_dir), audio_weight=0.2, noise_sigma=0.1, noise_seed=5, top_n=TOP)
    return out.select("p_partkey", rnd("score").alias("score"))


# ------------------------------------------------- survey preferences

def _answer_labels() -> dict[str, list[str]]:
    """Labels of each answer column, in slot order."""
    out: dict[str, list[str]] = {}
    for column, labels in P.VECTOR_SLOTS:
        if labels is not None:
            out.setdefault(column, []).extend(x for x in labels if x not in out.get(column, []))
    return out


#: Customer -> answers: label number (key * a + b) % (labels + 2); the two numbers beyond are an unknown label and none.
_PICK = {c: (7 + 2 * i, 3 * i) for i, c in enumerate(_answer_labels())}
_NUMBERS = {"when_listening": (3, 6), "duration_pref": (5, 13), "tempo_pref": (7, 30), "quality_pref": (11, 7), "curiosity_pref": (13, 8)}


def _preferences(spark, sf_dir):
    """A preference row per customer: one label per column, two or three for columns of several answers."""
    cust = spread(T(spark, sf_dir, "customer").select("c_custkey"))
    key = F.col("c_custkey")
    cols = []
    for c, labels in _answer_labels().items():
        a, b = _PICK[c]
        every = F.array(*[F.lit(x) for x in [*labels, "autre chose"]])

        def pick(shift):
            return F.get(every, ((key * a + b + shift) % (len(labels) + 2)).cast("int"))

        if c not in P.SEVERAL:
            cols.append(pick(0).alias(c))
        elif P.SEVERAL[c]:
            cols.append(F.when(key % 17 != 0, F.concat_ws(P.SEVERAL[c], pick(0), pick(1))).alias(c))
        else:
            quoted = F.transform(F.filter(F.array(pick(0), pick(1), pick(3)), lambda x: x.isNotNull()),
                                 lambda x: F.concat(F.lit('"'), x, F.lit('"')))
            cols.append(F.when(key % 17 != 0, F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))).alias(c))
    for c, (a, n) in _NUMBERS.items():
        cols.append(F.when(key % 19 != 0, (key * a) % n).cast("int").alias(c))
    return cust.select("c_custkey", *cols)


def _sql_text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _preferences_sql() -> str:
    """One row per (customer, column, label), and the numbers."""
    long, wide = [], []
    for c, labels in _answer_labels().items():
        a, b = _PICK[c]
        every = "[" + ", ".join(map(_sql_text, [*labels, "autre chose"])) + "]"
        shifts = [0] if c not in P.SEVERAL else [0, 1] if P.SEVERAL[c] else [0, 1, 3]
        picks = [f"{every}[1 + (c_custkey * {a} + {b + s}) % {len(labels) + 2}]" for s in shifts]
        gate = "" if c not in P.SEVERAL else " WHERE c_custkey % 17 <> 0"
        long += [f"SELECT c_custkey, '{c}' AS col, {p} AS label FROM customer{gate}" for p in picks]
        if c not in P.SEVERAL:
            wide.append(f"{picks[0]} AS {c}")
        else:
            wide.append(f"CASE WHEN c_custkey % 17 <> 0 THEN concat_ws('|', {', '.join(picks)}) END AS {c}")
    numbers = [f"CASE WHEN c_custkey % 19 <> 0 THEN (c_custkey * {a}) % {n} END AS {c}" for c, (a, n) in _NUMBERS.items()]
    return ("answers AS (" + "\nUNION ALL ".join(long) + "),\nprofile AS (SELECT c_custkey, " + ",\n".join([*wide, *numbers]) + " FROM customer)")


def _vector_sql() -> str:
    rows, numeric = [], []
    for i, (c, labels) in enumerate(P.VECTOR_SLOTS):
        scale = P.SCALE.get(c, 1.0)
        if labels is None:
            numeric.append(f"SELECT c_custkey, {i} AS slot, coalesce({c}, 0) / {scale} AS value FROM profile")
            rows.append(f"({i}, NULL, NULL, 0.0)")
        else:
            rows += [f"({i}, '{c}', {_sql_text(x)}, {v / scale})" for x, v in labels.items()]
    return f"""
WITH {_preferences_sql()},
spec(slot, col, label, value) AS (VALUES {', '.join(rows)}),
hits AS (SELECT a.c_custkey, s.slot, max(s.value) AS value FROM answers a JOIN spec s USING (col, label) GROUP BY ALL),
numbers AS ({' UNION ALL '.join(numeric)}),
vec AS (
  SELECT c.c_custkey, n.slot, coalesce(h.value, m.value, 0.0) AS value
  FROM customer c CROSS JOIN (SELECT DISTINCT slot FROM spec) n
  LEFT JOIN hits h ON h.c_custkey = c.c_custkey AND h.slot = n.slot LEFT JOIN numbers m ON m.c_custkey = c.c_custkey AND m.slot = n.slot)
"""


@query("survey_vector", ("REC-07",), _vector_sql() + "SELECT c_custkey, CAST(slot AS INTEGER) AS slot, round(value, 6) AS value FROM vec")
def survey_vector(spark, sf_dir):
    """All 71 slots of every customer's preference vector."""
    vec = R.preference_vector(P.several_answers(_preferences(spark, sf_dir)), "c_custkey", P.vector_slots())
    return _slots(vec)


@query("survey_vector_knn", ("REC-07", "REC-06", "JOIN-16", "TOP-07"), _vector_sql() + """
, t AS (SELECT slot, value FROM vec WHERE c_custkey = (SELECT min(c_custkey) FROM customer)),
d AS (SELECT v.c_custkey, 1.0 - sum(v.value * t.value) / (sqrt(sum(v.value * v.value)) * sqrt(sum(t.value * t.value))) AS distance
      FROM vec v JOIN t USING (slot) WHERE v.c_custkey <> (SELECT min(c_custkey) FROM customer) GROUP BY v.c_custkey)
SELECT c_custkey, round(distance, 6) AS distance FROM d ORDER BY round(distance, 9), c_custkey LIMIT 5
""")
def survey_vector_knn(spark, sf_dir):
    """The five customers nearest to the first one by the 71 slots."""
    vec = R.preference_vector(P.several_answers(_preferences(spark, sf_dir)), "c_custkey", P.vector_slots())
    first = _one_key(T(spark, sf_dir, "customer").agg(F.min("c_custkey")))
    return R.knn_cosine(vec, "c_custkey", "vector", first, k=5).select("c_custkey", rnd("distance").alias("distance"))


def _attributes_sql() -> str:
    terms = []
    for c, points, within in P.PROFILE_ATTRIBUTES:
        hit = f"p.{c} = t.{c}" if within is None else f"abs(p.{c} - t.{c}) <= {within}"
        terms.append(f"(CASE WHEN {hit} THEN {points} ELSE 0 END)")
    return " + ".join(terms)


@query("survey_similar_users", ("REC-13", "JOIN-10"), f"""
WITH {_preferences_sql()},
t AS (SELECT * FROM profile WHERE c_custkey = (SELECT max(c_custkey) FROM customer))
SELECT p.c_custkey, {_attributes_sql()} AS score FROM profile p CROSS JOIN t WHERE p.c_custkey <> t.c_custkey
""")
def survey_similar_users(spark, sf_dir):
    """All 15 attributes of every customer against those of the last one."""
    last = _one_key(T(spark, sf_dir, "customer").agg(F.max("c_custkey")))
    out = R.profile_similarity(_preferences(spark, sf_dir), "c_custkey", last, P.PROFILE_ATTRIBUTES)
    return out.select("c_custkey", F.col("score").cast("int").alias("score"))
