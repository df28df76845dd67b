"""Nested views: one shuffle for all child relations, several levels, keys without children."""

import re

from pyspark.sql import functions as F

from cadenza.operators import warehouse as W


def frames(spark):
    tracks = spark.createDataFrame([(1, 10, "a"), (2, 10, "b"), (3, None, "c")], "track long, album long, title string")
    artists = spark.createDataFrame([(1, 7), (1, 5), (2, 5), (None, 9), (8, 8)], "track long, artist long")
    tags = spark.createDataFrame([(1, "x"), (3, None), (3, "y")], "of long, tag string")
    return tracks, artists, tags


def test_nest(spark):
    tracks, artists, tags = frames(spark)
    out = W.nest(tracks, "track", [{"df": artists, "out": "artists", "fields": ["artist"], "order_by": ["artist"]},
                                   {"df": tags, "key": "of", "out": "tags", "fields": ["tag"], "order_by": ["tag"], "value": True}])
    got = {r.track: (r.artists and [a.artist for a in r.artists], r.tags) for r in out.collect()}
    assert got == {1: ([5, 7], ["x"]), 2: ([5], None), 3: (None, [None, "y"])}


def test_two_levels(spark):
    tracks, artists, _ = frames(spark)
    albums = spark.createDataFrame([(10,), (11,)], "album long")
    out = W.album_full(albums, tracks, "album", "track", ["track", "title"], ["title"],
                       album_artists=spark.createDataFrame([(10, 5)], "album long, artist long"), track_artists=artists, artist="artist")
    got = {r.album: r.asDict(recursive=True) for r in out.collect()}
    assert got[11] == {"album": 11, "artists": None, "tracks": None}
    assert got[10]["tracks"] == [{"track": 1, "title": "a", "artists": [{"artist": 5}, {"artist": 7}]},
                                 {"track": 2, "title": "b", "artists": [{"artist": 5}]}]


def test_children_share_one_exchange(spark):
    tracks, artists, tags = frames(spark)
    relations = [{"df": artists, "out": f"a{i}", "fields": ["artist"], "order_by": ["artist"]} for i in range(4)]
    plan = W.nest(tracks, "track", relations)._jdf.queryExecution().executedPlan().toString()
    shuffles = re.findall(r"Exchange hashpartitioning\(track", plan)
    assert len(shuffles) <= 2 and plan.count("Join") == 1          # the children's, and the tracks' to meet them


def test_object_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a long, b long")
    assert df.select(W.object_of(["a", "b"]).alias("o")).first().o == {"a": 1, "b": None}
