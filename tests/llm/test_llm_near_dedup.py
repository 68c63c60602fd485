"""b-bit MinHash groups against all pairs of full sets."""
import random

import pytest
from llm_cases import LOWER, WORD, clash, documents, frame, sentence
from pyspark.sql import functions as F

from ontime_spark.llm import near_dedup as N


def sets(rows):
    out = []
    for _, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        out.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    return out


def brute(rows):
    """(id, n_shingles, component_id) of each row by comparing all pairs."""
    s = sets(rows)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= 75 * len(s[i] | s[j]):
                parent[find(i)] = find(j)
    group = {}
    for i, (d, _) in enumerate(rows):
        group.setdefault(find(i), []).append(d)
    low = {k: min([x for x in v if x is not None], default=None) for k, v in group.items()}
    return sorted(((d, len(s[i]), low[find(i)] if s[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def test_matches_all_pairs_on_odd_rows(spark):
    rows = documents()
    out = N.near_duplicates(clash(frame(spark, rows))).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str) == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_large_group_of_near_copies_goes_through_hubs(spark):
    """300 near copies of one text and a chain of growing edits: more pairs than the direct
    listing takes at once."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    rows = []
    for i in range(300):
        w = list(base)
        for _ in range(rng.randint(1, 3)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        rows.append((1000 + i, " ".join(w)))
    rows += [(i, sentence(rng, 40)) for i in range(30)]
    out = N.near_duplicates(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str) == brute(rows)


def test_over_edited_copies_are_not_listed_in_pairs(spark, monkeypatch):
    """700 copies of one text with 1 to 14 words replaced from a small vocabulary: most are linked
    with nothing, and all share the buckets of the text."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    rows = []
    for i in range(700):
        w = list(base)
        for _ in range(rng.randint(1, 14)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(40)}"
        rows.append((i, " ".join(w)))
    listed, write = [], N.materialize

    def counted(df, name="table"):
        out = write(df, name)
        if name in ("pairs", "new-pairs"):
            listed.append(out.count())
        return out

    monkeypatch.setattr(N, "materialize", counted)
    out = N.near_duplicates(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str) == brute(rows)
    assert max(listed) < 8 * len(rows), listed


def test_empty_table(spark):
    assert N.near_duplicates(frame(spark, [])).count() == 0


def test_representatives_keep_columns_and_one_row_of_each(spark):
    rows = documents()
    docs = clash(frame(spark, rows))
    kept = N.representatives(docs)
    assert kept.columns == docs.columns
    want = {(d, t) for d, t in rows if (d, brute_component(rows, d, t)) == (d, d)}
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def brute_component(rows, d, t):
    n = len(sets([(d, t)])[0])
    return next(c for x, k, c in brute(rows) if x == d and k == n)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(5, 5)]
    out = {r.node: r.label for r in N.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert out == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)}


def test_component_steps_have_small_plans(spark, monkeypatch):
    """Plans stay in the driver's memory: each step reads a few tables, not the edges many times, and
    groups that meet over several rounds get their smallest node."""
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)]
    group = {x: {x} for e in edges for x in e}
    for a, b in edges:
        if group[a] is not group[b]:
            group[a] |= group[b]
            for x in group[b]:
                group[x] = group[a]
    read, write = [], N.materialize

    def counted(df, name="table"):
        read.append(df._jdf.queryExecution().optimizedPlan().collectLeaves().size())
        return write(df, name)

    monkeypatch.setattr(N, "materialize", counted)
    df = write(spark.createDataFrame([*edges, (None, 1), (2, None)], "u long, v long"))
    out = {r.node: r.label for r in N.components(df).collect()}
    assert out == {x: min(g) for x, g in group.items() if x != min(g)}
    assert len(read) > 4 and max(read) <= 3, read


@pytest.mark.parametrize("same", [0, 32, 96, 128])
def test_estimate_corrects_chance_agreement(spark, same):
    """Minima of which a known share is equal: unequal ones still agree in 1 of 4 low values."""
    rng = random.Random(same)
    pack = lambda v: [sum(x << (2 * i) for i, x in enumerate(v[k:k + 32])) for k in range(0, 128, 32)]
    signed = lambda v: [x - (1 << 64) if x >= 1 << 63 else x for x in v]
    pairs = []
    for _ in range(300):
        a = [rng.randrange(4) for _ in range(128)]
        b = a[:same] + [rng.randrange(4) for _ in range(128 - same)]
        pairs.append((signed(pack(a)), signed(pack(b))))
    df = spark.createDataFrame(pairs, "a array<long>, b array<long>")
    mean = df.select(F.avg(N.estimate(F.col("a"), F.col("b"), minima=128))).first()[0]
    assert abs(mean - same / 128) < 0.02
