"""Warehouse loads, views and upserts (LOAD-*, VIEW-*, UPS-*, JOIN-05/06/07/14/15).

The relational schema becomes one DataFrame per entity.  Views are lazy
plans over them; the correlated JSON sub-queries of the source views are
rewritten as pre-aggregated ``collect_list`` frames joined back once
(see :func:`cadenza.operators.joins.nested_lookup`).  Legacy ids are mapped
by a deterministic expression (:func:`cadenza.functions.ids.surrogate_id`),
so no id-map table has to be joined at load time.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ids import surrogate_id
from ..functions.standardise import parse_python_list
from ..session import cut_lineage
from .joins import latest_per_key, nested_lookup, parent_resolve


def load_tree(df: DataFrame, id_col: str, parent_col: str, entity: str = "genre",
              root_values=(0,)) -> DataFrame:
    """LOAD-01 / JOIN-07: new id per node; parent id resolved (root ⇒ null)."""
    resolved = parent_resolve(df, id_col, parent_col, "__parent_old", root_values=root_values)
    return resolved.select(surrogate_id(entity, F.col(id_col)).alias(f"{entity}_uuid"), "*",
                           F.when(F.col("__parent_old").isNotNull(), surrogate_id(entity, F.col("__parent_old")))
                           .alias(f"parent_{entity}_uuid")).drop("__parent_old")


def load_entity(df: DataFrame, id_col: str, entity: str, rename: dict | None = None) -> DataFrame:
    """LOAD-02/03: new id + column renames (a projection, no id-map join)."""
    out = df.select(surrogate_id(entity, F.col(id_col)).alias(f"{entity}_uuid"), "*")
    return out.withColumnsRenamed(rename) if rename else out


def load_links(fact: DataFrame, fact_id: str, fact_entity: str, must_exist: DataFrame, must_key: str,
               fk_col: str, fk_entity: str, optional: DataFrame | None = None, optional_key: str | None = None,
               optional_fk: str | None = None, optional_entity: str | None = None) -> DataFrame:
    """LOAD-04 / JOIN-06: facts whose mandatory parent exists (semi join: the
    source's inner join drops unknown artists), optional parent kept only
    when it exists (left join), ids mapped by expression."""
    kept = fact.join(must_exist.select(F.col(must_key).alias(fk_col)).distinct(), fk_col, "left_semi")
    cols = [surrogate_id(fact_entity, F.col(fact_id)).alias(f"{fact_entity}_uuid"),
            surrogate_id(fk_entity, F.col(fk_col)).alias(f"{fk_entity}_uuid")]
    if optional is not None:
        opt = optional.select(F.col(optional_key).alias("__opt")).distinct()
        kept = kept.join(opt, kept[optional_fk] == opt["__opt"], "left")
        cols.append(F.when(F.col("__opt").isNotNull(), surrogate_id(optional_entity, F.col("__opt")))
                    .alias(f"{optional_entity}_uuid"))
    return kept.select(fact_id, *cols)


def load_track_links(tracks: DataFrame, track: str, artist: str, album: str, artists: DataFrame, artist_key: str, albums: DataFrame,
                     album_key: str, genres: DataFrame, genre_key: str, genre_list: str,
                     featured_list: str | None = None) -> dict[str, DataFrame]:
    """LOAD-04: the link tables of the loaded tracks (those whose main artist is known).

    ``track_artist`` (track, artist, role: main or feat), ``album_artist`` (of known albums, main artists)
    and ``track_genre``.  The list columns are text; all links of a track leave it in one
    explode, entries that name no known artist or genre fall out by one semi join
    against the tagged ids of both, and repeated links are one.  The pruned links
    are written once; the three tables are projections of them.
    """
    known = artists.select(F.col(artist_key).cast("string").alias("id")).dropna().distinct()

    def entries(col, kind, role):
        ids = F.coalesce(parse_python_list(F.col(col)), F.array().cast("array<string>"))
        return F.transform(ids, lambda x: F.struct(F.lit(kind).alias("kind"), F.trim(x).alias("id"), F.lit(role).alias("role")))

    main = F.array(F.struct(F.lit("artist").alias("kind"), F.col(artist).cast("string").alias("id"), F.lit("main").alias("role")))
    each = [main, entries(genre_list, "genre", "")] + ([entries(featured_list, "artist", "feat")] if featured_list else [])
    loaded = tracks.join(known, F.col(artist).cast("string") == F.col("id"), "left_semi")
    links = loaded.select(F.col(track).alias("track"), F.col(album).alias("album"), F.explode(F.concat(*each)).alias("l")) \
        .select("track", "album", "l.*").distinct()
    ids = known.select(F.lit("artist").alias("kind"), "id").unionByName(
        genres.select(F.lit("genre").alias("kind"), F.col(genre_key).cast("string").alias("id")).dropna().distinct())
    links = cut_lineage(links.join(ids, ["kind", "id"], "left_semi"), "track-links")
    uuid = {k: surrogate_id(k, F.col(c)).alias(f"{k}_uuid") for k, c in (("track", "track"), ("album", "album"), ("artist", "id"), ("genre", "id"))}
    with_album = links.filter("role = 'main'").join(albums.select(F.col(album_key).alias("album")).dropna().distinct(), "album", "left_semi")
    return {"track_artist": links.filter("kind = 'artist'").select(uuid["track"], uuid["artist"], "role"),
            "album_artist": with_album.select(uuid["album"], uuid["artist"]).distinct(),
            "track_genre": links.filter("kind = 'genre'").select(uuid["track"], uuid["genre"]).distinct()}


def tag_vocabulary(sources: Sequence[tuple[DataFrame, str]], is_text_list: bool = True) -> DataFrame:
    """LOAD-05 / SET-02 / JOIN-14: distinct tag names over several list columns."""
    out = None
    for df, col in sources:
        arr = parse_python_list(F.col(col)) if is_text_list else F.col(col)
        t = df.select(F.explode(arr).alias("tag_name")).filter(F.col("tag_name") != "")
        out = t if out is None else out.unionByName(t)
    return out.distinct().select(surrogate_id("tag", F.col("tag_name")).alias("tag_uuid"), "tag_name")


def tag_links(df: DataFrame, id_col: str, list_col: str, vocabulary: DataFrame,
              is_text_list: bool = True) -> DataFrame:
    """JOIN-14: ``CROSS JOIN LATERAL unnest(parse(list))`` then the tag dimension."""
    arr = parse_python_list(F.col(list_col)) if is_text_list else F.col(list_col)
    pairs = df.select(id_col, F.explode(arr).alias("tag_name")).distinct()
    return pairs.join(vocabulary, "tag_name").select(id_col, "tag_uuid")


def upsert(old: DataFrame, new: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """UPS-01: insert-or-replace by key (``ON CONFLICT DO UPDATE``).

    A full outer join: rows of ``new`` replace their key's old row entirely;
    untouched old rows and brand-new keys pass through.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = [c for c in old.columns if c not in keys]
    n = new.select(*keys, *[F.col(c).alias(f"__n_{c}") for c in cols], F.lit(True).alias("__hit"))
    j = old.join(n, keys, "full_outer")
    return j.select(*keys, *[F.when(F.col("__hit"), F.col(f"__n_{c}")).otherwise(F.col(c)).alias(c) for c in cols])


def insert_if_absent(old: DataFrame, new: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """UPS-02: ``ON CONFLICT DO NOTHING`` = old ∪ (new ▷ old)."""
    return old.unionByName(new.join(old.select(key if isinstance(key, str) else list(key)), key, "left_anti"))


def upsert_counter(events: DataFrame, keys: Sequence[str], alias: str = "count") -> DataFrame:
    """UPS-03: first event inserts 1, later ones add 1 ⇒ a count per key."""
    return events.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def nested_view(entity: DataFrame, key: str, children: Sequence[dict]) -> DataFrame:
    """VIEW-01/02/03/06/07/08: entity + one array column per child relation.

    Each child dict: ``{"df", "key", "out", "fields", "order_by"}``.  Every
    child is aggregated on its own (partial aggregation) and left-joined;
    a key without children gets NULL, as the correlated sub-query does.
    """
    out = entity
    for ch in children:
        child = ch["df"] if ch["key"] == key else ch["df"].withColumnRenamed(ch["key"], key)
        out = nested_lookup(out, child, key, ch["out"], ch["fields"], ch.get("order_by"))
    return out


def nest(entity: DataFrame, key: str, relations: Sequence[dict]) -> DataFrame:
    """VIEW-01/02: entity + one array column per child relation, all relations in one shuffle.

    Each relation is ``{"df", "out", "fields", "order_by"}`` with optional ``key`` (its
    column for ``key``) and ``value`` (True: the array holds the single field's values,
    not objects).  The children of all relations are tagged rows of one union and one
    aggregate on the key collects each relation's array, so a further relation
    costs no exchange and no join.  A child's field may itself be an array
    built by ``nest``: views of several levels are built from the bottom up.

    A key without children of a relation gets NULL there, as the correlated
    sub-query of the source gives; ``order_by`` must order a key's children.
    """
    tagged, kinds = [], []
    for i, r in enumerate(relations):
        child = r["df"]
        order = [F.col(c).alias(f"o{j}") for j, c in enumerate(r["order_by"])]
        item = F.struct(*order, *[F.col(c).alias(f"f{j}") for j, c in enumerate(r["fields"])])
        tagged.append(child.select(F.col(r.get("key", key)).alias(key), item.alias("c")).filter(F.col(key).isNotNull()))
        kinds.append(tagged[-1].schema["c"].dataType)
    union = None
    for i, t in enumerate(tagged):
        t = t.select(key, *[(F.col("c") if i == j else F.lit(None).cast(k)).alias(f"c{j}") for j, k in enumerate(kinds)])
        union = t if union is None else union.unionByName(t)
    arrays = union.groupBy(key).agg(*[F.array_sort(F.collect_list(f"c{i}")).alias(f"c{i}") for i in range(len(relations))])

    def shaped(i, r):
        def one(x):
            return x["f0"] if r.get("value") else F.struct(*[x[f"f{j}"].alias(c) for j, c in enumerate(r["fields"])])
        return F.when(F.size(f"c{i}") > 0, F.transform(f"c{i}", one)).alias(r["out"])

    return entity.join(arrays.select(key, *[shaped(i, r) for i, r in enumerate(relations)]), key, "left")


def object_of(cols: Sequence[str]) -> Column:
    """VIEW-01: a map of column name -> value, as the source's row object; null values stay."""
    return F.map_from_arrays(F.array(*[F.lit(c) for c in cols]), F.array(*[F.col(c) for c in cols]))


def track_full(tracks: DataFrame, albums: DataFrame, track: str, album: str, *, main: DataFrame, feat: DataFrame, artist: str,
               genres: DataFrame, genre: str, tags: DataFrame, tag: str, audio: DataFrame, temporal: DataFrame) -> DataFrame:
    """VIEW-01: a track with its album's columns, its main and featured artists, genres, tags, audio
    columns, and the temporal features as one object (NULL without a row)."""
    rest = [c for c in temporal.columns if c != track]
    temporal = temporal.select(track, object_of(rest).alias("temporal_features"))
    out = nest(tracks, track, [
        {"df": main, "out": "main_artists", "fields": [artist], "order_by": [artist]},
        {"df": feat, "out": "feat_artists", "fields": [artist], "order_by": [artist]},
        {"df": genres, "out": "genres", "fields": [genre], "order_by": [genre], "value": True},
        {"df": tags, "out": "tags", "fields": [tag], "order_by": [tag], "value": True}])
    return out.join(albums, album, "left").join(audio, track, "left").join(temporal, track, "left")


def album_full(albums: DataFrame, tracks: DataFrame, album: str, track: str, track_fields: Sequence[str], track_order: Sequence[str], *,
               album_artists: DataFrame, track_artists: DataFrame, artist: str) -> DataFrame:
    """VIEW-02: an album with its artists and its tracks, each track an object that holds its own artists."""
    with_artists = nest(tracks, track, [{"df": track_artists, "out": "artists", "fields": [artist], "order_by": [artist]}])
    return nest(albums, album, [
        {"df": album_artists, "out": "artists", "fields": [artist], "order_by": [artist]},
        {"df": with_artists, "out": "tracks", "fields": [*track_fields, "artists"], "order_by": list(track_order)}])


def popularity_view(entity: DataFrame, key: str, ranks: DataFrame, order_col: str,
                    rank_cols: Sequence[str], tie_cols: Sequence[str] = ()) -> DataFrame:
    """VIEW-05/10 / JOIN-08: entity counters + latest rank row (left join)."""
    latest = latest_per_key(ranks, key, order_col, list(rank_cols) + [order_col], tie_cols)
    return entity.join(latest, key, "left")


def entity_tags(parts: Sequence[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """VIEW-11 / SET-01: ``UNION ALL`` of (entity_type, entity_id, tag)."""
    out = None
    for etype, df, id_col, tag_col in parts:
        f = df.select(F.lit(etype).alias("entity_type"), F.col(id_col).cast("string").alias("entity_id"),
                      F.col(tag_col).alias("tag"))
        out = f if out is None else out.unionByName(f)
    return out


def list_view(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """VIEW-04: list projections."""
    return df.select(*cols)


def load_survey_users(answers: DataFrame, respondent: str, genre_list: str, genres: DataFrame,
                      genre_id: str, genre_title: str, consent: str | None = None) -> tuple[DataFrame, DataFrame]:
    """LOAD-08: survey users and their genre preferences.

    Accounts get deterministic ids and a ``user_<first 8 of the id>`` login;
    consent is the survey boolean rule applied to the answer text (Q-05:
    comparing lower-cased free text with ``'True'`` is never true).  The
    genre list (JSON text or array) is exploded and matched to the genre
    table case-insensitively (JOIN-15).
    """
    from ..functions.standardise import survey_to_boolean
    uid = surrogate_id("user", F.col(respondent))
    cols = [F.col(respondent), uid.alias("user_uuid"), F.concat(F.lit("user_"), F.substring(uid, 1, 8)).alias("login")]
    if consent:
        cols.append((survey_to_boolean(F.col(consent).cast("string")) == "true").alias("has_consented"))
    users = answers.select(*cols)
    arr = F.col(genre_list)
    if not isinstance(answers.schema[genre_list].dataType, T.ArrayType):
        arr = F.from_json(arr, "array<string>")
    wanted = answers.select(F.col(respondent), F.explode(arr).alias("__g")).distinct()
    prefs = (wanted.join(genres.select(F.col(genre_id), F.col(genre_title)), F.lower("__g") == F.lower(F.col(genre_title)))
             .select(respondent, surrogate_id("user", F.col(respondent)).alias("user_uuid"),
                     surrogate_id("genre", F.col(genre_id)).alias("genre_uuid"), genre_title))
    return users, prefs


def load_preferences(answers: DataFrame, respondent: str, *, texts: Sequence[str], numbers: Sequence[str], whole: Sequence[str],
                     flags: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """LOAD-08 / VIEW-09: account and preference rows of every respondent.

    Accounts carry login, name, address and pseudonym formed from the id; preferences
    keep ``texts``, ``numbers`` as doubles, ``whole`` rounded to integers as the source's cast does,
    and ``flags`` by the survey's boolean rule.
    """
    from ..functions.standardise import survey_to_boolean
    uid = surrogate_id("user", F.col(respondent))
    short = F.substring(uid, 1, 8)
    accounts = answers.select(F.col(respondent), uid.alias("account_uuid"), F.concat(F.lit("user_"), short).alias("login"),
                              F.concat(F.lit("User "), short).alias("name"), F.concat(F.lit("user_"), short, F.lit("@test.com")).alias("email"),
                              F.concat(F.lit("User_"), short).alias("pseudo"))
    prefs = answers.select(uid.alias("account_uuid"), *texts, *[F.col(c).cast("double").alias(c) for c in numbers],
                           *[F.rint(F.col(c).cast("double")).cast("int").alias(c) for c in whole],
                           *[(survey_to_boolean(F.col(c).cast("string")) == "true").alias(c) for c in flags])
    return accounts, prefs


def entity_rank_rows(item_ranks: DataFrame, item_key: str, links: DataFrame, entity_key: str,
                     rank_cols: Sequence[str], required: str) -> DataFrame:
    """LOAD-06: an entity's rank rows from its items' rank rows -- distinct
    (entity, ranks) over the item→entity links, ranks cast to integers, rows
    without ``required`` skipped (insert-if-absent of distinct rows)."""
    ranked = item_ranks.filter(F.col(required).isNotNull()).select(
        item_key, *[F.col(c).cast("long").alias(c) for c in rank_cols])
    return ranked.join(links.select(item_key, entity_key).distinct(), item_key).select(
        entity_key, *rank_cols).distinct()
