"""WARC bundles: exact round trip, seek table, lookup of single records, revisits."""

import hashlib
import io
import struct
from collections import Counter

import duckdb
import zstandard

from cadenza.llm import warc as W
from cadenza.llm.queries import QUERIES, SQL


def test_bundle_reads_from_front_and_by_frame(tmp_path):
    records = [W.make_record(i, f"http://x/{i} é\r\n", bytes([i % 256]) * (i * 37 % 5000), hashlib.sha1(bytes([i % 256]) * (i * 37 % 5000)).hexdigest())
               for i in range(200)]
    path = tmp_path / "b.warc.zst"
    writer = W.BundleWriter(path.open("wb"), frame=10_000)
    places = [writer.add(r) for r in records]
    writer.close()
    raw = path.read_bytes()
    front = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert front == b"".join(records)
    assert struct.unpack("<IBI", raw[-9:])[2] == 0x8F92EAB1 and struct.unpack("<IBI", raw[-9:])[0] == places[-1][0] + 1
    reader = W.BundleReader(str(path))
    for i in (0, 7, 150, 199):
        frame, offset = places[i]
        page = W.read_page(reader.frame(frame), offset)
        assert page["page_id"] == i and page["payload"] == bytes([i % 256]) * (i * 37 % 5000) and page["record_type"] == "response"


def rows_of(spark, rows, tmp_path, name):
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(3)
    return W.write_archive(df, f"file://{tmp_path}/{name}")


def test_revisits_nulls_and_repeats(spark, tmp_path):
    big, edge, small = "é" * 600, "x" * 1000, "y" * 999
    rows = [(1, "u", big, "d"), (5, "u", big, None), (3, None, big, "d"), (None, "u", big, "d"), (5, "u", big, "d"), (7, "a\nb", edge, "d"),
            (8, "u", edge, "d"), (9, "u", small, "d"), (10, "u", small, "d"), (11, "u", None, "d"), (12, "u", "", "d"), (13, "u", "WARC/1.1\r\n\r\n" * 300, "d")]
    index = rows_of(spark, rows, tmp_path, "a")
    got = W.read_archive(index).collect()
    want = []
    for page, _, html, _ in rows:
        raw = (html or "").encode()
        same = [p for p, _, h, _ in rows if h == html and p is not None]
        keeper = max(same) if len(raw) >= 1000 and len([1 for r in rows if r[2] == html]) > 1 else page
        again = keeper != page
        want.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", keeper if again else None, None if again else raw))
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got) == Counter(want)
    where = {r.page_id: r for r in W.locations(index).collect()}
    one = W.BundleReader(where[13].bundle).frame(where[13].frame)
    assert W.read_page(one, where[13].offset)["payload"] == rows[-1][2].encode()


def test_empty_table_and_very_long_page(spark, tmp_path):
    assert W.read_archive(rows_of(spark, [], tmp_path, "e")).count() == 0
    long = "<p>" * 1_500_000
    row = W.read_archive(rows_of(spark, [(1, "u", long, None)], tmp_path, "l")).first()
    assert bytes(row.payload) == long.encode()


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    cur = con.execute(SQL["op10_warc"])
    names = [d[0] for d in cur.description]
    df = QUERIES["op10_warc"](spark, sf)
    assert sorted(df.columns) == sorted(names)
    assert Counter(tuple(r[n] for n in names) for r in df.collect()) == Counter(cur.fetchall())
