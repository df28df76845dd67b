"""Raw CSV scan: multi-row headers, sub-header rows, presets."""

from cadenza.functions.presets import TRACKS_RULES
from cadenza.operators.quality import clean_folder
from cadenza.sources.csv import flatten_header


def test_flatten_header():
    assert flatten_header([["", "album", "album"], ["", "id", "title"]]) == ["level_0_level_1", "album_id", "album_title"]
    assert flatten_header([["a", "a", "b"]]) == ["a", "a.1", "b"]


def test_clean_tracks_file(spark, tmp_path):
    lines = [
        ",track,track,track,track,track,track,album,artist,track,track,track,track,track,track,track",
        ",title,duration,genre_top,genres,tags,listens,id,id,favorites,interest,comments,date_created,composer,lyricist,publisher",
        "track_id,,,,,,,,,,,,,,,",
        "2,Food ,3:45,Hip-Hop,\"[21, 103]\",\"['x', ' y ']\",1 234,1,1,4,\"1,5\",0,2008/11/26,,,",
        "3,Electric Ave,abc,Hip-Hop,[21],[],10,1,1,4,0.5,0,2008-11-26,,,",
        "5,This World,02:30,Pop,[],[],5,1,1,4,0.5,0,26-11-2008,,,",
    ]
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "tracks.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    (folder / "unknown.csv").write_text("a\n1\n", encoding="utf-8")
    res = clean_folder(spark, str(folder), {"tracks.csv": TRACKS_RULES})["tracks.csv"]
    rows = {r["track_id"]: r for r in res.clean.collect()}
    assert sorted(rows) == [2, 5]                        # track 3: duration 'abc' fails
    assert rows[2]["track_title"] == "Food" and rows[2]["track_duration"] == 225
    assert rows[2]["track_listens"] == 1234 and rows[2]["track_interest"] == 1.5
    assert rows[2]["track_genres"] == "[21, 103]"
    assert rows[2]["track_tags"] == '["x", "y"]'
    assert str(rows[5]["track_date_created"]) == "2008-11-26"
    fails = {r["first_failure"]: r["failures"] for r in res.failures().collect()}
    assert fails == {"track_duration:notNull": 1}
