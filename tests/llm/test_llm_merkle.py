"""Merkle manifest against a plain recursion over all leaves."""
import hashlib
import zlib

import pytest
from llm_cases import clash, documents
from pyspark.sql import functions as F

from ontime_spark.llm import merkle as M


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def up(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append([h("".join(x[i:i + 8])) for i in range(0, len(x), 8)])
    return levels


def path(levels, i):
    out = []
    for x in levels[:-1]:
        first = i - i % 8
        out.append(("".join(x[first:i]), "".join(x[i + 1:first + 8])))
        i //= 8
    return out


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = up([leaf(r) for r in groups[g]])
    tops = up([trees[g][-1][0] for g in order])
    root = tops[-1][0]
    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            steps = path(trees[g], i) + path(tops, k)
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None
            cur = leaf((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))) if bad else leaf(r)
            for a, b in steps:
                cur = h(a + cur + b)
            out.append((r[0], leaf(r), trees[g][-1][0], root, h("".join(a + b for a, b in steps)), cur, cur == root))
    return sorted(out, key=str)


def run(spark, rows, tmp_dir, extra=False):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string").repartition(3)
    if extra:
        df = clash(df).withColumn("tree", F.lit("x")).withColumn("hash", F.lit("x")).withColumn("idx", F.lit(9)).withColumn("n", F.lit(2))
    df.write.parquet(f"{tmp_dir}/documents.parquet")
    return M.op12_merkle_manifest(spark, tmp_dir)


def table(langs):
    rows = documents()
    return [(d, None if i % 7 == 0 else f"s{i % 3}", langs[i % len(langs)], None if t is None else len(t), t) for i, (d, t) in enumerate(rows)]


@pytest.mark.parametrize("langs", [["en"], ["en", None, "de", "", "é", "fr"], [f"l{i}" for i in range(19)]])
def test_matches_plain_recursion(spark, tmp_dir, langs):
    rows = table(langs)
    out = run(spark, rows, tmp_dir, extra=True).collect()
    assert sorted((tuple(r) for r in out), key=str) == brute(rows)
    assert any(r.verified for r in out) and not all(r.verified for r in out)


def test_several_layers_of_superblocks(spark):
    """Superblocks of 8 nodes: several layers in the groups' trees and in that of 70 subroots."""
    rows = [(i, "s", f"l{i % 70}" if i % 9 == 0 else "en", i, f"text {i % 50}") for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string").repartition(3)
    own = M.leaf_digest([F.col(c) for c in M.FIELDS])
    out = M.prove(df, own, own, levels=1)
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 2])
def test_small_tables(spark, tmp_dir, n):
    rows = [(i, None, f"l{i}", 1, "A") for i in range(n)]
    assert sorted((tuple(r) for r in run(spark, rows, tmp_dir).collect()), key=str) == (brute(rows) if n else [])


def test_repeated_rows_are_leaves_of_their_own(spark, tmp_dir):
    rows = [(1, "s", "en", 1, "Same")] * 3 + [(1, "s", "en", 1, "Other"), (2, "s", "en", None, None)]
    out = run(spark, rows, tmp_dir).collect()
    assert sorted((tuple(r) for r in out), key=str) == brute(rows)
