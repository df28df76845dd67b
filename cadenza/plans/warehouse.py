"""Warehouse queries: loads, views, upserts and derived counters on the driver tables.

Mapping: orders = album, lineitem = track rows / listens, part = track,
supplier = artist, customer = user, events = likes / listens / comments
(``click`` = like, ``error`` = unlike, ``view`` = listen, ``purchase`` =
comment; the item is ``props.k``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.ids import surrogate_id
from ..operators import derived as D
from ..operators import joins as J
from ..operators import warehouse as W
from .common import T, rnd
from .registry import query

_UUID = "regexp_replace(md5({x}), '(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})', '\\1-\\2-\\3-\\4-\\5')"


def uuid_sql(entity: str, col: str) -> str:
    return _UUID.format(x=f"'{entity}:' || CAST({col} AS VARCHAR)")


_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]


@query("nested_entity_view", ("JOIN-13", "AGG-22", "JOIN-05"), f"""
SELECT o.o_orderkey, c.c_name, l.n_lines, l.part_keys
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN (
  SELECT l_orderkey, count(*) AS n_lines,
         string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY {', '.join(_LINE_ORDER)}) AS part_keys
  FROM lineitem GROUP BY l_orderkey
) l ON l.l_orderkey = o.o_orderkey
""")
def nested_entity_view(spark, sf_dir):
    orders = T(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = T(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    li = T(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    v = W.nested_view(orders.join(cust, "o_custkey", "left"), "o_orderkey",
                      [{"df": li, "key": "o_orderkey", "out": "lines", "fields": ["l_partkey", "l_quantity"],
                        "order_by": _LINE_ORDER}])
    return v.select("o_orderkey", "c_name",
                    F.when(F.col("lines").isNotNull(), F.size("lines")).cast("long").alias("n_lines"),
                    F.array_join(F.transform("lines", lambda x: x["l_partkey"].cast("string")), ",").alias("part_keys"))


@query("track_popularity_view", ("VIEW-05", "VIEW-10", "JOIN-08", "AGG-24"), """
WITH c AS (
  SELECT l_partkey, count(*) AS listens, sum(l_quantity) AS favorites,
         arg_max(l_extendedprice, (l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice)) AS hotness,
         max(l_shipdate) AS rank_date
  FROM lineitem GROUP BY l_partkey
)
SELECT p.p_partkey, p.p_name, coalesce(c.listens, 0) AS listens, round(coalesce(c.favorites, 0), 6) AS favorites,
       round(c.hotness, 6) AS hotness, c.rank_date
FROM part p LEFT JOIN c ON c.l_partkey = p.p_partkey
""")
def track_popularity_view(spark, sf_dir):
    part = T(spark, sf_dir, "part").select("p_partkey", "p_name")
    li = T(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    counters = li.groupBy("p_partkey").agg(F.count(F.lit(1)).alias("listens"), F.sum("l_quantity").alias("favorites"))
    ranks = li.select("p_partkey", F.col("l_extendedprice").alias("hotness"), F.col("l_shipdate").alias("rank_date"),
                      "l_orderkey", "l_linenumber", "l_suppkey")
    v = W.popularity_view(part.join(counters, "p_partkey", "left"), "p_partkey", ranks, "rank_date", ["hotness"],
                          tie_cols=["l_orderkey", "l_linenumber", "l_suppkey", "hotness"])
    return v.select("p_partkey", "p_name", F.coalesce("listens", F.lit(0)).alias("listens"),
                    rnd(F.coalesce("favorites", F.lit(0.0))).alias("favorites"), rnd("hotness").alias("hotness"),
                    "rank_date")


@query("entity_tags_union", ("VIEW-11", "SET-01"), """
SELECT 'track' AS entity_type, CAST(p_partkey AS VARCHAR) AS entity_id, p_type AS tag FROM part
UNION ALL
SELECT 'artist', CAST(s.s_suppkey AS VARCHAR), n.n_name FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
""")
def entity_tags_union(spark, sf_dir):
    sup = T(spark, sf_dir, "supplier").join(
        T(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name"), "s_nationkey")
    return W.entity_tags([("track", T(spark, sf_dir, "part"), "p_partkey", "p_type"),
                          ("artist", sup, "s_suppkey", "n_name")])


def like_and_comment():
    """Steps of an item's likes (click, error) and comments (purchase, signup)."""
    t = F.col("event_type")
    return {"likes": F.when(t == "click", 1).when(t == "error", -1), "comments": F.when(t == "purchase", 1).when(t == "signup", -1)}


#: SQL: a counter taken event by event, never below 0.
STEPS = """CAST(coalesce(list_reduce(list(CASE event_type WHEN '{up}' THEN 1 WHEN '{down}' THEN -1 ELSE 0 END ORDER BY ts, event_id),
               lambda n, d: greatest(n + d, 0), 0), 0) AS BIGINT)"""


@query("derived_counters", ("DRV-06", "DRV-07", "DRV-08", "UDF-04"), f"""
WITH e AS (SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS item, event_type, user_id, ts, event_id FROM events)
SELECT item, {STEPS.format(up='click', down='error')} AS likes, {STEPS.format(up='purchase', down='signup')} AS comments,
       count(DISTINCT CASE WHEN event_type = 'view' THEN user_id END) AS listeners
FROM e WHERE item IS NOT NULL GROUP BY item
""")
def derived_counters(spark, sf_dir):
    ev = T(spark, sf_dir, "events").withColumn("item", F.get_json_object("props", "$.k").cast("long"))
    return D.item_counters(ev, "item", "event_type", "user_id", ["ts", "event_id"], like="click", unlike="error",
                           listen="view", comment="purchase", uncomment="signup")


@query("listen_upsert", ("UPS-03",), """
SELECT user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS item, count(*) AS count
FROM events WHERE event_type = 'view' GROUP BY 1, 2
""")
def listen_upsert(spark, sf_dir):
    ev = T(spark, sf_dir, "events").filter(F.col("event_type") == "view")
    ev = ev.withColumn("item", F.get_json_object("props", "$.k").cast("long"))
    return W.upsert_counter(ev, ["user_id", "item"])


@query("artist_rollup_main_feat", ("DRV-11", "JOIN-12", "AGG-30"), """
WITH links AS (
  SELECT l_suppkey AS s_suppkey, l_partkey AS p_partkey FROM lineitem WHERE l_linenumber = 1
  UNION
  SELECT l_suppkey, l_partkey FROM lineitem WHERE l_linenumber > 1
), sums AS (
  SELECT s_suppkey, sum(p_size) AS total_p_size, sum(p_retailprice) AS total_p_retailprice
  FROM links JOIN part USING (p_partkey) GROUP BY s_suppkey
)
SELECT s.s_suppkey, CAST(coalesce(total_p_size, 0) AS BIGINT) AS total_p_size,
       round(coalesce(total_p_retailprice, 0), 6) AS total_p_retailprice
FROM supplier s LEFT JOIN sums USING (s_suppkey)
""")
def artist_rollup_main_feat(spark, sf_dir):
    li = T(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"),
                                             F.col("l_partkey").alias("p_partkey"), "l_linenumber")
    main = li.filter(F.col("l_linenumber") == 1)
    feat = li.filter(F.col("l_linenumber") > 1)
    out = D.rollup_over_links(T(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey", main, feat,
                              "p_partkey", T(spark, sf_dir, "part"), ["p_size", "p_retailprice"])
    return out.select("s_suppkey", F.col("total_p_size").cast("long").alias("total_p_size"),
                      rnd("total_p_retailprice").alias("total_p_retailprice"))


@query("anti_orphans", ("JOIN-11", "SET-06"), """
SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
""")
def anti_orphans(spark, sf_dir):
    li = T(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return J.anti_join(T(spark, sf_dir, "orders").select("o_orderkey"), li, "o_orderkey")


@query("default_rank_rows", ("UPS-02", "DRV-03", "DRV-10"), """
SELECT p.p_partkey, round(coalesce(l.rank_value, 0.0), 6) AS rank_value
FROM part p LEFT JOIN (
  SELECT l_partkey, arg_max(l_extendedprice, (l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice)) AS rank_value
  FROM lineitem GROUP BY l_partkey
) l ON l.l_partkey = p.p_partkey
""")
def default_rank_rows(spark, sf_dir):
    li = T(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"),
                                             F.col("l_extendedprice").alias("rank_value"),
                                             "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey")
    existing = J.latest_per_key(li, "p_partkey", "l_shipdate", ["rank_value"],
                                tie_cols=["l_orderkey", "l_linenumber", "l_suppkey", "rank_value"])
    out = D.default_rows(T(spark, sf_dir, "part"), existing, "p_partkey", {"rank_value": 0.0})
    return out.select("p_partkey", rnd("rank_value").alias("rank_value"))


@query("singles_for_orphans", ("DRV-02",), f"""
SELECT {uuid_sql('album', 'p_partkey')} AS album_uuid, p_partkey, p_name || ' - Single' AS album_title,
       'single' AS album_type, DATE '2024-01-01' AS album_date_released
FROM part WHERE p_size > 40
""")
def singles_for_orphans(spark, sf_dir):
    """Tracks = parts; a part of size > 40 has no album (its album key is null)."""
    tracks = T(spark, sf_dir, "part").withColumn(
        "album_key", F.when(F.col("p_size") <= 40, F.col("p_size")))
    s = D.singles_for_orphans(tracks, "p_partkey", "album_key", "p_name", as_of="2024-01-01")
    return s.select("album_uuid", "p_partkey", "album_title", "album_type", "album_date_released")


@query("album_track_count", ("DRV-01",), """
SELECT o.o_orderkey, coalesce(c.n, 0) AS n_children
FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) c ON c.l_orderkey = o.o_orderkey
""")
def album_track_count(spark, sf_dir):
    li = T(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return D.child_count(T(spark, sf_dir, "orders").select("o_orderkey"), li, "o_orderkey")


@query("cascade_delete", ("DRV-04",), """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_size = 1)
""")
def cascade_delete(spark, sf_dir):
    deleted = T(spark, sf_dir, "part").filter(F.col("p_size") == 1).select(F.col("p_partkey").alias("l_partkey"))
    li = T(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return D.cascade_delete(li, deleted, "l_partkey")


@query("blocked_deletes", ("DRV-05",), """
SELECT DISTINCT o_orderkey FROM orders o WHERE o_orderstatus = 'P'
  AND EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
""")
def blocked_deletes(spark, sf_dir):
    req = T(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "P")
    li = T(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return D.blocked_deletes(req, li, "o_orderkey")


@query("first_playlist", ("DRV-09",), f"""
SELECT DISTINCT {uuid_sql('playlist', 'user_id')} AS playlist_uuid, user_id, 'My first playlist' AS playlist_title
FROM events e WHERE event_type = 'click'
  AND NOT EXISTS (SELECT 1 FROM events o WHERE o.event_type = 'signup' AND o.value >= 250 AND o.user_id = e.user_id)
""")
def first_playlist(spark, sf_dir):
    ev = T(spark, sf_dir, "events")
    owners = ev.filter((F.col("event_type") == "signup") & (F.col("value") >= 250))
    return D.first_owned(ev.filter(F.col("event_type") == "click"), owners,
                         "user_id").select("playlist_uuid", "user_id", "playlist_title")


@query("genre_tree", ("LOAD-01", "JOIN-07"), f"""
SELECT c.n_nationkey, {uuid_sql('genre', 'c.n_nationkey')} AS genre_uuid,
       CASE WHEN p.n_nationkey IS NOT NULL THEN {uuid_sql('genre', 'p.n_nationkey')} END AS parent_genre_uuid
FROM nation c LEFT JOIN nation p ON p.n_nationkey = (CASE WHEN c.n_nationkey % 5 = 0 THEN NULL ELSE c.n_nationkey % 5 END)
""")
def genre_tree(spark, sf_dir):
    n = T(spark, sf_dir, "nation").select("n_nationkey", (F.col("n_nationkey") % 5).alias("parent"))
    return W.load_tree(n, "n_nationkey", "parent").select("n_nationkey", "genre_uuid", "parent_genre_uuid")


@query("load_links", ("LOAD-02", "LOAD-03", "LOAD-04", "JOIN-06", "PRJ-06"), f"""
SELECT o.o_orderkey, {uuid_sql('track', 'o.o_orderkey')} AS track_uuid, {uuid_sql('artist', 'o.o_custkey')} AS artist_uuid,
       CASE WHEN n.n_nationkey IS NOT NULL THEN {uuid_sql('album', 'n.n_nationkey')} END AS album_uuid
FROM orders o JOIN (SELECT DISTINCT c_custkey, c_nationkey FROM customer WHERE c_acctbal >= 0) c ON c.c_custkey = o.o_custkey
LEFT JOIN (SELECT DISTINCT n_nationkey FROM nation WHERE n_regionkey <> 0) n ON n.n_nationkey = c.c_nationkey
""")
def load_links(spark, sf_dir):
    cust = T(spark, sf_dir, "customer")
    orders = T(spark, sf_dir, "orders").join(
        cust.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey", "left")
    known = cust.filter(F.col("c_acctbal") >= 0)
    nations = T(spark, sf_dir, "nation").filter(F.col("n_regionkey") != 0)
    return W.load_links(orders, "o_orderkey", "track", known, "c_custkey", "o_custkey", "artist",
                        optional=nations, optional_key="n_nationkey", optional_fk="c_nationkey",
                        optional_entity="album")


@query("tag_vocabulary", ("LOAD-05", "SET-02", "JOIN-14", "AGG-26"), f"""
WITH t AS (
  SELECT DISTINCT unnest(string_split(p_name, ' ')) AS tag_name FROM part
  UNION SELECT DISTINCT p_type FROM part
)
SELECT {uuid_sql('tag', 'tag_name')} AS tag_uuid, tag_name FROM t WHERE tag_name <> ''
""")
def tag_vocabulary(spark, sf_dir):
    part = T(spark, sf_dir, "part").select(
        F.concat(F.lit("['"), F.array_join(F.split("p_name", " "), "', '"), F.lit("']")).alias("name_tags"),
        F.concat(F.lit("['"), F.col("p_type"), F.lit("']")).alias("type_tags"))
    return W.tag_vocabulary([(part, "name_tags"), (part, "type_tags")])


@query("tag_link_counts", ("JOIN-14", "LOAD-05"), """
WITH pairs AS (SELECT DISTINCT p_partkey, unnest(string_split(p_name, ' ')) AS tag_name FROM part)
SELECT tag_name, count(*) AS n_tracks FROM pairs WHERE tag_name <> '' GROUP BY tag_name
""")
def tag_link_counts(spark, sf_dir):
    part = T(spark, sf_dir, "part").select(
        "p_partkey", F.concat(F.lit("['"), F.array_join(F.split("p_name", " "), "', '"), F.lit("']")).alias("name_tags"))
    vocab = W.tag_vocabulary([(part, "name_tags")])
    links = W.tag_links(part, "p_partkey", "name_tags", vocab)
    return links.join(vocab, "tag_uuid").groupBy("tag_name").agg(F.count(F.lit(1)).alias("n_tracks"))


@query("rank_upsert", ("UPS-01", "LOAD-06", "LOAD-07"), """
WITH new AS (
  SELECT l_partkey AS p_partkey,
         arg_max(l_extendedprice, (l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice)) AS p_retailprice,
         CAST(arg_max(l_quantity, (l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice)) AS INTEGER) AS p_size
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_partkey
)
SELECT p.p_partkey, CASE WHEN n.p_partkey IS NOT NULL THEN n.p_size ELSE p.p_size END AS p_size,
       round(CASE WHEN n.p_partkey IS NOT NULL THEN n.p_retailprice ELSE p.p_retailprice END, 6) AS p_retailprice
FROM part p LEFT JOIN new n ON n.p_partkey = p.p_partkey
""")
def rank_upsert(spark, sf_dir):
    li = T(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R").select(
        F.col("l_partkey").alias("p_partkey"), F.col("l_extendedprice").alias("p_retailprice"),
        F.col("l_quantity").cast("int").alias("p_size"), "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey",
        F.col("l_extendedprice").alias("__price_tie"))
    new = J.latest_per_key(li, "p_partkey", "l_shipdate", ["p_retailprice", "p_size"],
                           tie_cols=["l_orderkey", "l_linenumber", "l_suppkey", "__price_tie"])
    old = T(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    out = W.upsert(old, new.select("p_partkey", "p_size", "p_retailprice"), "p_partkey")
    return out.select("p_partkey", "p_size", rnd("p_retailprice").alias("p_retailprice"))


@query("case_insensitive_join", ("JOIN-15",), """
WITH dim AS (SELECT DISTINCT upper(event_type) AS genre_title FROM events)
SELECT d.genre_title, count(*) AS n FROM events e JOIN dim d ON lower(e.event_type) = lower(d.genre_title)
GROUP BY d.genre_title
""")
def case_insensitive_join(spark, sf_dir):
    ev = T(spark, sf_dir, "events").select("event_type")
    dim = ev.select(F.upper("event_type").alias("genre_title")).distinct()
    return J.ci_equi_join(ev, dim, "event_type", "genre_title").groupBy("genre_title").agg(
        F.count(F.lit(1)).alias("n"))


@query("user_summary_view", ("VIEW-09", "VIEW-08", "JOIN-05", "AGG-22"), """
SELECT c.c_custkey, c.c_name, n.n_name, coalesce(o.n_orders, 0) AS n_orders, o.priorities
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN (
  SELECT o_custkey, count(*) AS n_orders, array_to_string(list_sort(list_distinct(list(o_orderpriority))), '|') AS priorities
  FROM orders GROUP BY o_custkey
) o ON o.o_custkey = c.c_custkey
""")
def user_summary_view(spark, sf_dir):
    cust = T(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nat = T(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    orders = T(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    agg = orders.groupBy("c_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.array_join(F.array_sort(F.collect_set("o_orderpriority")), "|").alias("priorities"))
    return (cust.join(nat, "c_nationkey", "left").join(agg, "c_custkey", "left")
            .select("c_custkey", "c_name", "n_name", F.coalesce("n_orders", F.lit(0)).alias("n_orders"), "priorities"))


@query("listen_history_view", ("VIEW-08", "VIEW-06", "VIEW-07", "AGG-22"), """
SELECT user_id, string_agg(CAST(json_extract(props, '$.k') AS VARCHAR), ',' ORDER BY ts, event_id) AS items
FROM events WHERE event_type = 'view' GROUP BY user_id
""")
def listen_history_view(spark, sf_dir):
    ev = T(spark, sf_dir, "events").filter(F.col("event_type") == "view")
    ev = ev.withColumn("item", F.get_json_object("props", "$.k"))
    users = ev.select("user_id").distinct()
    v = J.nested_lookup(users, ev, "user_id", "h", ["item"], order_by=["ts", "event_id"])
    return v.select("user_id", F.array_join(F.transform("h", lambda x: x["item"]), ",").alias("items"))


@query("artist_accounts", ("DRV-12", "LOAD-02", "PRJ-06"), f"""
WITH owners AS (SELECT DISTINCT l_suppkey AS s_suppkey FROM lineitem WHERE l_returnflag = 'R')
SELECT s.s_suppkey, CASE WHEN o.s_suppkey IS NOT NULL THEN 'existing' ELSE 'created' END AS origin,
       'artist_' || s.s_suppkey AS login
FROM supplier s LEFT JOIN owners o ON o.s_suppkey = s.s_suppkey
""")
def artist_accounts(spark, sf_dir):
    """Accounts exist for suppliers with a returned line; every other artist gets one."""
    sup = T(spark, sf_dir, "supplier").select("s_suppkey")
    existing = (T(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
                .select(F.col("l_suppkey").alias("s_suppkey")).distinct().withColumn("origin", F.lit("existing")))
    out = D.default_rows(sup, existing, "s_suppkey", {"origin": "created"})
    return out.select("s_suppkey", "origin", F.concat(F.lit("artist_"), F.col("s_suppkey").cast("string")).alias("login"))


@query("track_audio_view", ("VIEW-12", "SCL-24", "JOIN-05"), """
SELECT p.p_partkey, p.p_size, round(p.p_retailprice, 6) AS p_retailprice, t.n_lines, round(t.avg_qty, 6) AS avg_qty
FROM part p LEFT JOIN (SELECT l_partkey, count(*) AS n_lines, avg(l_quantity) AS avg_qty FROM lineitem GROUP BY 1) t
  ON t.l_partkey = p.p_partkey
""")
def track_audio_view(spark, sf_dir):
    """Audio columns + the temporal features as one JSON object (nulls kept), read back field by field."""
    from ..functions.standardise import row_json
    part = T(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    temporal = (T(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey"))
                .agg(F.count(F.lit(1)).alias("n_lines"), F.avg("l_quantity").alias("avg_qty"))
                .select("p_partkey", row_json(["n_lines", "avg_qty"]).alias("temporal_features")))
    v = part.join(temporal, "p_partkey", "left")
    return v.select("p_partkey", "p_size", rnd("p_retailprice").alias("p_retailprice"),
                    F.get_json_object("temporal_features", "$.n_lines").cast("long").alias("n_lines"),
                    rnd(F.get_json_object("temporal_features", "$.avg_qty").cast("double")).alias("avg_qty"))


@query("listen_history_long", ("VIEW-08", "JOIN-13", "AGG-22"), """
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS position,
       CAST(json_extract(props, '$.k') AS BIGINT) AS item
FROM events WHERE event_type = 'view'
""")
def listen_history_long(spark, sf_dir):
    """The listen-history view in long form: one row per (user, position)."""
    ev = T(spark, sf_dir, "events").filter(F.col("event_type") == "view")
    ev = ev.withColumn("item", F.get_json_object("props", "$.k").cast("long"))
    users = ev.select("user_id").distinct()
    out = J.children_long(users, ev, "user_id", ["item"], ["ts", "event_id"])
    return out.select("user_id", F.col("position").cast("long"), "item")


@query("artist_rank_rows", ("LOAD-06", "AGG-26", "UPS-02"), """
WITH r AS (
  SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_size END AS discovery,
         CAST(trunc(p_retailprice) AS BIGINT) AS familiarity, CAST(p_size * 2 AS BIGINT) AS hotttnesss
  FROM part
), main AS (SELECT DISTINCT l_partkey AS p_partkey, l_suppkey AS s_suppkey FROM lineitem WHERE l_linenumber = 1)
SELECT DISTINCT m.s_suppkey, CAST(r.discovery AS BIGINT) AS discovery, r.familiarity, r.hotttnesss
FROM r JOIN main m USING (p_partkey) WHERE r.discovery IS NOT NULL
""")
def artist_rank_rows(spark, sf_dir):
    """Track rank rows (part-derived) rolled to the tracks' main artists."""
    p = T(spark, sf_dir, "part")
    ranks = p.select("p_partkey",
                     F.when(F.col("p_partkey") % 9 == 0, F.lit(None)).otherwise(F.col("p_size")).alias("discovery"),
                     F.col("p_retailprice").alias("familiarity"), (F.col("p_size") * 2).alias("hotttnesss"))
    main = (T(spark, sf_dir, "lineitem").filter(F.col("l_linenumber") == 1)
            .select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey")))
    return W.entity_rank_rows(ranks, "p_partkey", main, "s_suppkey", ["discovery", "familiarity", "hotttnesss"],
                              required="discovery")


@query("artist_counters_refreshed", ("DRV-11", "UDF-04", "DRV-06", "DRV-08", "JOIN-12"), f"""
WITH e AS (SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS item, event_type, ts, event_id FROM events),
items AS (
  SELECT item, {STEPS.format(up='click', down='error')} AS likes, {STEPS.format(up='purchase', down='signup')} AS comments
  FROM e WHERE item IS NOT NULL GROUP BY item),
links AS (SELECT DISTINCT l_partkey % 100 AS item, l_suppkey FROM lineitem WHERE l_linenumber = 1 OR l_returnflag <> 'R'),
touched AS (SELECT DISTINCT l_suppkey FROM lineitem)
SELECT l_suppkey, CAST(coalesce(sum(likes), 0) AS BIGINT) AS likes, CAST(coalesce(sum(comments), 0) AS BIGINT) AS comments
FROM touched LEFT JOIN links USING (l_suppkey) LEFT JOIN items USING (item) GROUP BY l_suppkey
""")
def artist_counters_refreshed(spark, sf_dir):
    """Artists' likes and comments after three batches: most events and all links, more events while the returned
    featured links end, and the last events alone (item = ``k``, artist = supplier, main link = first line)."""
    import uuid

    from ..operators.incremental import EntityCounters
    from ..session import ensure_checkpoint_dir
    ev = T(spark, sf_dir, "events").withColumn("item", F.get_json_object("props", "$.k").cast("long"))
    last = ev.agg(F.max("event_id")).first()[0] or 0
    li = T(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 100).alias("item"), "l_suppkey", "l_linenumber", "l_returnflag")
    every = li.withColumn("change", F.lit(1))
    ended = li.filter((F.col("l_linenumber") > 1) & (F.col("l_returnflag") == "R")).withColumn("change", F.lit(-1))
    made = EntityCounters(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/artists-{uuid.uuid4().hex[:10]}", "item", "l_suppkey",
                          like_and_comment(), ["ts", "event_id"])
    made.refresh(0, ev.filter(F.col("event_id") <= last * 0.6), every)
    made.refresh(1, ev.filter((F.col("event_id") > last * 0.6) & (F.col("event_id") <= last * 0.8)), ended)
    made.refresh(2, ev.filter(F.col("event_id") > last * 0.8), every.filter(F.lit(False)))
    return made.sums.read().select("l_suppkey", "likes", "comments")


#: Tracks = parts; the album of part p is order p // 4 (none for sizes above 40); artists = suppliers of its lines.
_TRACKS_SQL = """
track AS (SELECT p_partkey AS track_id, p_name AS track_title, CAST(p_size AS BIGINT) AS track_number,
                 CASE WHEN p_size <= 40 THEN p_partkey // 4 END AS album_id, p_type, p_brand FROM part),
main AS (SELECT DISTINCT l_partkey AS track_id, l_suppkey AS artist_id FROM lineitem WHERE l_linenumber = 1),
feat AS (SELECT DISTINCT l_partkey AS track_id, l_suppkey AS artist_id FROM lineitem WHERE l_linenumber > 1)"""


def _track_tables(spark, sf_dir):
    part, li = T(spark, sf_dir, "part"), T(spark, sf_dir, "lineitem")
    tracks = part.select(F.col("p_partkey").alias("track_id"), F.col("p_name").alias("track_title"),
                         F.col("p_size").cast("long").alias("track_number"),
                         F.when(F.col("p_size") <= 40, F.expr("p_partkey div 4")).alias("album_id"), "p_type", "p_brand")
    links = li.select(F.col("l_partkey").alias("track_id"), F.col("l_suppkey").alias("artist_id"), "l_linenumber")
    main, feat = (links.filter(c).drop("l_linenumber").distinct() for c in ("l_linenumber = 1", "l_linenumber > 1"))
    albums = T(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("album_id"), F.col("o_orderpriority").alias("album_title"),
                                               F.to_date("o_orderdate").alias("album_date_released"))
    return tracks, albums, main, feat


@query("track_full_view", ("VIEW-01", "JOIN-13", "AGG-22", "JOIN-05", "SCL-24"), f"""
WITH {_TRACKS_SQL},
genres AS (SELECT track_id, p_type AS genre FROM track UNION ALL SELECT track_id, p_brand FROM track WHERE track_id % 3 = 0),
tags AS (SELECT DISTINCT track_id, unnest(string_split(track_title, ' ')) AS tag FROM track WHERE track_id % 5 <> 0),
temporal AS (SELECT l_partkey AS track_id, count(*) AS n_lines, CAST(sum(l_quantity) AS BIGINT) AS quantity,
                    max(CASE WHEN l_returnflag = 'R' THEN year(l_shipdate) END) AS last_return FROM lineitem GROUP BY 1)
SELECT t.track_id, t.track_title, t.album_id, o.o_orderpriority AS album_title, CAST(o.o_orderdate AS DATE) AS album_date_released,
  (SELECT CASE WHEN count(*) > 0 THEN CAST(to_json(list({{'artist_id': artist_id}} ORDER BY artist_id)) AS VARCHAR) END FROM main m WHERE m.track_id = t.track_id) AS main_artists,
  (SELECT CASE WHEN count(*) > 0 THEN CAST(to_json(list({{'artist_id': artist_id}} ORDER BY artist_id)) AS VARCHAR) END FROM feat f WHERE f.track_id = t.track_id) AS feat_artists,
  (SELECT CASE WHEN count(*) > 0 THEN CAST(to_json(list(genre ORDER BY genre)) AS VARCHAR) END FROM genres g WHERE g.track_id = t.track_id) AS genres,
  (SELECT CASE WHEN count(*) > 0 THEN CAST(to_json(list(tag ORDER BY tag)) AS VARCHAR) END FROM tags g WHERE g.track_id = t.track_id) AS tags,
  round(p.p_retailprice, 6) AS energy,
  CASE WHEN x.track_id IS NOT NULL THEN CAST(json_object('n_lines', x.n_lines, 'quantity', x.quantity, 'last_return', x.last_return) AS VARCHAR) END AS temporal_features
FROM track t LEFT JOIN orders o ON o.o_orderkey = t.album_id LEFT JOIN part p ON p.p_partkey = t.track_id LEFT JOIN temporal x ON x.track_id = t.track_id
""")
def track_full_view(spark, sf_dir):
    """The full track view; arrays and the temporal object as JSON text."""
    tracks, albums, main, feat = _track_tables(spark, sf_dir)
    genres = tracks.select("track_id", F.col("p_type").alias("genre")).unionByName(
        tracks.filter("track_id % 3 = 0").select("track_id", F.col("p_brand").alias("genre")))
    tags = tracks.filter("track_id % 5 <> 0").select("track_id", F.explode(F.split("track_title", " ")).alias("tag")).distinct()
    audio = T(spark, sf_dir, "part").select(F.col("p_partkey").alias("track_id"), F.col("p_retailprice").alias("energy"))
    temporal = T(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("track_id")).agg(
        F.count("*").alias("n_lines"), F.sum("l_quantity").cast("long").alias("quantity"),
        F.max(F.when(F.col("l_returnflag") == "R", F.year("l_shipdate"))).cast("long").alias("last_return"))
    v = W.track_full(tracks, albums, "track_id", "album_id", main=main, feat=feat, artist="artist_id", genres=genres, genre="genre",
                     tags=tags, tag="tag", audio=audio, temporal=temporal)
    text = [F.to_json(c, {"ignoreNullFields": "false"}).alias(c) for c in ("main_artists", "feat_artists", "genres", "tags", "temporal_features")]
    return v.select("track_id", "track_title", "album_id", "album_title", "album_date_released", *text, rnd("energy").alias("energy"))


@query("album_full_view", ("VIEW-02", "JOIN-13", "AGG-22"), f"""
WITH {_TRACKS_SQL},
whole AS (
  SELECT t.*, (SELECT list({{'artist_id': artist_id}} ORDER BY artist_id) FROM main m WHERE m.track_id = t.track_id) AS artists FROM track t),
album_artist AS (SELECT DISTINCT t.album_id, m.artist_id FROM track t JOIN main m USING (track_id))
SELECT o.o_orderkey AS album_id, o.o_orderpriority AS album_title, CAST(o.o_orderdate AS DATE) AS album_date_released,
  (SELECT CASE WHEN count(*) > 0 THEN CAST(to_json(list({{'artist_id': artist_id}} ORDER BY artist_id)) AS VARCHAR) END
   FROM album_artist a WHERE a.album_id = o.o_orderkey) AS artists,
  (SELECT CASE WHEN count(*) > 0 THEN CAST(to_json(list({{'track_id': track_id, 'track_title': track_title, 'track_number': track_number, 'artists': artists}}
                                           ORDER BY track_number, track_id)) AS VARCHAR) END
   FROM whole w WHERE w.album_id = o.o_orderkey) AS tracks
FROM orders o
""")
def album_full_view(spark, sf_dir):
    """The full album view: tracks are objects that hold their artists; arrays as JSON text."""
    tracks, albums, main, _ = _track_tables(spark, sf_dir)
    album_artists = tracks.join(main, "track_id").select("album_id", "artist_id").filter("album_id is not null").distinct()
    v = W.album_full(albums, tracks, "album_id", "track_id", ["track_id", "track_title", "track_number"], ["track_number", "track_id"],
                     album_artists=album_artists, track_artists=main, artist="artist_id")
    return v.select("album_id", "album_title", "album_date_released",
                    *[F.to_json(c, {"ignoreNullFields": "false"}).alias(c) for c in ("artists", "tracks")])


#: What hangs on a track: (table, SQL of its rows with track_id).
_DEPENDANTS = [
    ("track_artist_main", "SELECT DISTINCT l_partkey AS track_id, l_suppkey FROM lineitem WHERE l_linenumber = 1"),
    ("track_artist_feat", "SELECT DISTINCT l_partkey AS track_id, l_suppkey FROM lineitem WHERE l_linenumber > 1"),
    ("track_license", "SELECT p_partkey AS track_id, p_brand FROM part"),
    ("track_genre", "SELECT p_partkey AS track_id, p_type FROM part"),
    ("track_tag", "SELECT p_partkey AS track_id, unnest(string_split(p_name, ' ')) FROM part"),
    ("playlist_track", "SELECT l_partkey AS track_id, l_orderkey FROM lineitem WHERE l_linenumber <= 3"),
    ("track_user_like", "SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS track_id, event_id FROM events WHERE event_type = 'click'"),
    ("track_user_listen", "SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS track_id, event_id FROM events WHERE event_type = 'view'"),
    ("track_comment", "SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS track_id, event_id FROM events WHERE event_type = 'purchase'"),
    ("rank_track", "SELECT DISTINCT l_partkey AS track_id, l_shipdate FROM lineitem"),
    ("audio_feature", "SELECT p_partkey AS track_id, p_size FROM part"),
    ("temporal_feature", "SELECT l_partkey AS track_id, count(*) FROM lineitem GROUP BY 1"),
]


def _dependant_tables(spark, sf_dir):
    part, li = T(spark, sf_dir, "part").withColumnRenamed("p_partkey", "track_id"), T(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "track_id")
    ev = T(spark, sf_dir, "events").withColumn("track_id", F.get_json_object("props", "$.k").cast("long"))
    links = li.select("track_id", "l_suppkey", "l_linenumber")
    return {"track_artist_main": links.filter("l_linenumber = 1").select("track_id", "l_suppkey").distinct(),
            "track_artist_feat": links.filter("l_linenumber > 1").select("track_id", "l_suppkey").distinct(),
            "track_license": part.select("track_id", "p_brand"), "track_genre": part.select("track_id", "p_type"),
            "track_tag": part.select("track_id", F.explode(F.split("p_name", " ")).alias("tag")),
            "playlist_track": li.filter("l_linenumber <= 3").select("track_id", "l_orderkey"),
            **{t: ev.filter(F.col("event_type") == e).select("track_id", "event_id")
               for t, e in (("track_user_like", "click"), ("track_user_listen", "view"), ("track_comment", "purchase"))},
            "rank_track": li.select("track_id", "l_shipdate").distinct(), "audio_feature": part.select("track_id", "p_size"),
            "temporal_feature": li.groupBy("track_id").agg(F.count("*").alias("n"))}


@query("cascade_delete_all", ("DRV-04", "DRV-01"), "WITH gone AS (SELECT p_partkey FROM part WHERE p_size = 1),\n" + ",\n".join(
    f"{t} AS ({q})" for t, q in _DEPENDANTS) + "\n" + "\nUNION ALL ".join(
    f"SELECT '{t}' AS dependant, count(*) AS n_before, count(*) FILTER (WHERE track_id IS NULL OR track_id NOT IN (SELECT p_partkey FROM gone)) AS n_after FROM {t}"
    for t, _ in _DEPENDANTS) + """
UNION ALL SELECT 'playlist_owner', count(*), count(*) FILTER (WHERE l_orderkey NOT IN (
  SELECT l_orderkey FROM lineitem WHERE l_linenumber <= 3 AND l_partkey IN (SELECT p_partkey FROM gone)))
FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_linenumber <= 3)
UNION ALL SELECT 'track', count(*), count(*) FILTER (WHERE p_size <> 1) FROM part
""")
def cascade_delete_all(spark, sf_dir):
    """Tracks of size 1 go, and with them the rows of all twelve dependants (and of a table that hangs on one of them)."""
    tables = _dependant_tables(spark, sf_dir)
    references = [(t, "track_id", "track", "track_id") for t in tables] + [("playlist_owner", "l_orderkey", "playlist_track", "l_orderkey")]
    tables["track"] = T(spark, sf_dir, "part").select(F.col("p_partkey").alias("track_id"), "p_size")
    tables["playlist_owner"] = tables["playlist_track"].select("l_orderkey").distinct()
    gone = tables["track"].filter("p_size = 1").select("track_id")
    left = D.cascade_delete_tables(tables, references, "track", gone)
    rows = [tables[t].agg(F.count("*").alias("n_before")).withColumn("n_after", left[t].agg(F.count("*")).scalar())
            .select(F.lit(t).alias("dependant"), "n_before", "n_after") for t in sorted(left)]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


@query("track_default_rows", ("DRV-03", "UPS-02"), """
WITH temporal AS (SELECT l_partkey, count(*) AS n_lines FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
rank AS (SELECT l_partkey, max(l_extendedprice) AS hotttnesss FROM lineitem WHERE l_linenumber = 7 GROUP BY 1)
SELECT p_partkey, round(coalesce(r.hotttnesss, 0.0), 6) AS hotttnesss, CASE WHEN p_size <= 25 THEN p_retailprice END AS energy, t.n_lines
FROM part p LEFT JOIN temporal t ON t.l_partkey = p.p_partkey LEFT JOIN rank r ON r.l_partkey = p.p_partkey
""")
def track_default_rows(spark, sf_dir):
    """Rank, audio and temporal rows of every track, defaults where a track has none."""
    part = T(spark, sf_dir, "part")
    li = T(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    rank = li.filter("l_linenumber = 7").groupBy("p_partkey").agg(F.max("l_extendedprice").alias("hotttnesss"))
    audio = part.filter("p_size <= 25").select("p_partkey", F.col("p_retailprice").alias("energy"))
    temporal = li.filter("l_returnflag = 'R'").groupBy("p_partkey").agg(F.count("*").alias("n_lines"))
    made = D.track_defaults(part, "p_partkey", {"rank": (rank, {"hotttnesss": 0.0}), "audio": (audio, {"energy": None}),
                                                "temporal": (temporal, {"n_lines": None})})
    return made["rank"].join(made["audio"], "p_partkey").join(made["temporal"], "p_partkey").select(
        "p_partkey", rnd("hotttnesss").alias("hotttnesss"), "energy", "n_lines")


#: Parts as track rows with list columns; suppliers in debt are unknown artists, order states other than F unknown albums.
_LINK_SQL = """
stg AS (SELECT p_partkey AS track, p_partkey % 10 AS artist, p_partkey // 4 AS album,
               [CAST(p_size % 25 AS VARCHAR), CAST(p_partkey % 31 AS VARCHAR), CAST(p_size % 25 AS VARCHAR)] AS genre_ids,
               CASE WHEN p_size % 3 = 0 THEN [CAST((p_partkey + 3) % 12 AS VARCHAR), CAST(p_partkey % 10 AS VARCHAR)] ELSE [] END AS feat_ids FROM part),
known AS (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0),
loaded AS (SELECT * FROM stg WHERE artist IN (SELECT s_suppkey FROM known))"""


def _track_links(spark, sf_dir):
    p = T(spark, sf_dir, "part")

    def listed(*cols):
        return F.concat(F.lit("['"), F.concat_ws("', ' ", *[c.cast("string") for c in cols]), F.lit("']"))

    key, size = F.col("p_partkey"), F.col("p_size")
    tracks = p.select(key.alias("track"), (key % 10).alias("artist"), F.expr("p_partkey div 4").alias("album"),
                      listed(size % 25, key % 31, size % 25).alias("genres"),
                      F.when(size % 3 == 0, listed((key + 3) % 12, key % 10)).otherwise("[]").alias("featured"))
    return W.load_track_links(tracks, "track", "artist", "album", T(spark, sf_dir, "supplier").filter("s_acctbal >= 0"), "s_suppkey",
                              T(spark, sf_dir, "orders").filter("o_orderstatus = 'F'"), "o_orderkey",
                              T(spark, sf_dir, "nation").filter("n_regionkey <> 0"), "n_nationkey", "genres", "featured")


@query("track_artist_links", ("LOAD-04", "JOIN-06", "JOIN-14"), f"""
WITH {_LINK_SQL},
links AS (SELECT track, artist AS id, 'main' AS role FROM loaded
          UNION SELECT track, CAST(unnest(feat_ids) AS BIGINT), 'feat' FROM loaded)
SELECT {uuid_sql('track', 'track')} AS track_uuid, {uuid_sql('artist', 'id')} AS artist_uuid, role FROM links WHERE id IN (SELECT s_suppkey FROM known)
""")
def track_artist_links(spark, sf_dir):
    return _track_links(spark, sf_dir)["track_artist"]


@query("album_artist_links", ("LOAD-04", "JOIN-06"), f"""
WITH {_LINK_SQL}
SELECT DISTINCT {uuid_sql('album', 'album')} AS album_uuid, {uuid_sql('artist', 'artist')} AS artist_uuid
FROM loaded WHERE album IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
""")
def album_artist_links(spark, sf_dir):
    return _track_links(spark, sf_dir)["album_artist"]


@query("track_genre_links", ("LOAD-04", "JOIN-14", "SCL-18"), f"""
WITH {_LINK_SQL},
links AS (SELECT DISTINCT track, CAST(unnest(genre_ids) AS INTEGER) AS id FROM loaded)
SELECT {uuid_sql('track', 'track')} AS track_uuid, {uuid_sql('genre', 'id')} AS genre_uuid
FROM links WHERE id IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 0)
""")
def track_genre_links(spark, sf_dir):
    return _track_links(spark, sf_dir)["track_genre"]


@query("user_accounts_and_preferences", ("LOAD-08", "VIEW-09", "PRJ-06"), f"""
WITH u AS (SELECT *, {uuid_sql('user', 'c_custkey')} AS id FROM customer)
SELECT c_custkey, id AS account_uuid, 'user_' || substr(id, 1, 8) AS login, 'User ' || substr(id, 1, 8) AS name,
       'user_' || substr(id, 1, 8) || '@test.com' AS email, 'User_' || substr(id, 1, 8) AS pseudo, c_mktsegment AS gender,
       c_acctbal AS tempo_pref, CAST(round_even(c_acctbal / 100.0, 0) AS INTEGER) AS duration_pref, c_nationkey % 2 = 0 AS has_consented
FROM u
""")
def user_accounts_and_preferences(spark, sf_dir):
    """Accounts and preference rows of every customer, met again on the account's id."""
    answers = T(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("gender"), F.col("c_acctbal").alias("tempo_pref"),
                                                  (F.col("c_acctbal") / 100.0).alias("duration_pref"),
                                                  F.when(F.col("c_nationkey") % 2 == 0, "Oui").otherwise("Non").alias("has_consented"))
    accounts, prefs = W.load_preferences(answers, "c_custkey", texts=["gender"], numbers=["tempo_pref"], whole=["duration_pref"],
                                         flags=["has_consented"])
    return accounts.join(prefs, "account_uuid")
