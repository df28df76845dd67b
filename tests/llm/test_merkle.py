"""Merkle manifest against trees built level by level in plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cadenza.llm import merkle as M, queries as Q


def H(*x):
    return hashlib.sha256("".join(x).encode()).hexdigest()


def plain(leaves):
    """(root, path of each leaf) of one tree; a path is a list of (left, right)."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    found = []
    for i in range(len(leaves)):
        path = []
        for level in levels[:-1]:
            a = i - i % 8
            path.append(("".join(level[a:i]), "".join(level[i + 1:a + 8])))
            i //= 8
        found.append(path)
    return levels[-1][0], found


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def brute(rows):
    """(doc_id, leaf, subroot, root, proof, path) of (doc_id, source, lang, n_chars, text) rows."""
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, H(*map(field, r)), r))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    made = {}
    for n in names:
        trees[n].sort(key=lambda x: x[:3])
        made[n] = plain([x[2] for x in trees[n]])
    root, tops = plain([made[n][0] for n in names]) if names else (None, [])
    out = []
    for n, top in zip(names, tops):
        for (_, _, leaf, r), path in zip(trees[n], made[n][1]):
            path = path + top
            out.append((r, leaf, made[n][0], root, H(*[x for p in path for x in p]), path))
    return out


def folded(leaf, path):
    for left, right in path:
        leaf = H(left, leaf, right)
    return leaf


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")


def check(spark, rows, path):
    frame(spark, rows).repartition(3).write.parquet(f"{path}/documents.parquet")
    got = sorted(map(tuple, Q.op12_merkle(spark, path).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)
    want = []
    for r, leaf, subroot, root, proof, siblings in brute(rows):
        changed = leaf
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
            changed = H(*map(field, (*r[:4], low)))
        back = folded(changed, siblings)
        want.append((r[0], leaf, subroot, root, proof, back, back == root))
    assert got == sorted(want, key=repr)


def documents(n, seed=1, langs=("en", "fr", None, "ü", "")):
    rng = random.Random(seed)
    return [(i, rng.choice(["web", None, "a:b"]), rng.choices(langs, [9, 3, 2, 1, 1][:len(langs)])[0], rng.choice([None, i * 7]),
             rng.choice([None, "", "Ärger MIT Ümlaut", f"Text {i}", "plain"])) for i in range(n)]


@pytest.mark.parametrize("n", [1, 8, 9, 700])
def test_against_plain_trees(spark, tmp_path, n):
    check(spark, documents(n), str(tmp_path))


def test_many_trees(spark, tmp_path):
    check(spark, documents(600, 2) + [(1000 + i, None, f"l{i}", 1, "One Tree Each") for i in range(600)], str(tmp_path))


@pytest.mark.parametrize("stride", [1, 2, 5])
def test_any_stride_gives_the_same_proofs(spark, stride):
    rows = documents(600, 2)
    want = {r[0]: (root, path) for r, _, _, root, _, path in brute(rows)}
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    df = frame(spark, rows).withColumn("leaf", M.leaf_digest(*fields))
    got = M.proofs(M.manifest(df, "lang", ["doc_id"], "leaf", ["doc_id"], stride=stride)).collect()
    assert {r.row.doc_id: (r.root, [tuple(x) for x in r.path]) for r in got} == want


def test_repeated_rows_null_ids_long_text(spark, tmp_path):
    rows = [(5, "s", "en", 1, "Same")] * 20 + [(None, None, None, None, None)] * 3 + [(5, "s", "en", 1, "Other")] + [(6, "s", "en", 1, "Word " * 200000)]
    check(spark, rows, str(tmp_path))


def test_same_digests_for_any_partitioning(spark):
    rows = documents(300, 3)
    roots = set()
    for parts in (1, 7):
        df = frame(spark, rows).repartition(parts).withColumn("leaf", M.leaf_digest(F.col("doc_id"), F.col("text")))
        roots.add(M.manifest(df, "lang", ["doc_id"], "leaf").root)
    assert len(roots) == 1


def test_stored_levels_are_few_and_can_be_discarded(spark):
    df = spark.range(5000).select("id", F.lit("x").alias("tree"), F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("idx"))
    made = M.manifest(df, "tree", ["id"], "idx", ["id", "idx", "tree"])       # names that the operator uses itself
    assert [x.count() for x in made.levels] == [5000, 10, 1]
    rows = M.proofs(made).withColumn("back", M.fold(F.col("leaf"), F.col("path"))).collect()
    assert len(rows) == 5000 and {r.back for r in rows} == {made.root} and all(r.row.idx == r.leaf for r in rows)
    made.discard()


def test_empty_table(spark, tmp_path):
    check(spark, [], str(tmp_path))
    df = frame(spark, []).withColumn("leaf", F.lit("x"))
    assert M.manifest(df, "lang", ["doc_id"], "leaf").root is None
