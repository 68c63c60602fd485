"""Removal of repeated strings against a dictionary of all strings."""
import hashlib
import random

import numpy as np
import pytest
from llm_cases import clash, documents, frame

from ontime_spark.llm import suffix_dedup as S


def brute(rows, length=100):
    """(id, n_bytes, n_removed, n_spans, sha256) of each row; ids are different or the rows equal."""
    first, out, seen = {}, [], {}
    for d, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (text or "").encode()
        if (d, text) in seen:
            out.append(seen[d, text])
            continue
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if first.setdefault(raw[i:i + length], (d, i)) != (d, i):
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        row = (d, len(raw), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest())
        seen[d, text] = row
        out.append(row)
    return sorted(out, key=str)


def result(df, **options):
    out, r = S.remove_repeats(df, **options)
    rows = out.select("doc_id", f"{r}.*").collect()
    for x in rows:
        assert sum(s.end - s.start for s in x.spans) == x.n_removed
    return sorted(((x.doc_id, x.n_bytes, x.n_removed, len(x.spans), hashlib.sha256(bytes(x.kept)).hexdigest()) for x in rows), key=str)


def spliced(seed, n, alphabet="abcdefgh é"):
    """Texts made of passages that other texts have, whole, cut or edited, and of letters of their own."""
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    passages = [word(rng.randint(80, 700)) for _ in range(15)]
    rows = []
    for i in range(n):
        t = ""
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages)
            a = rng.randrange(len(p) // 2)
            p = p[a:rng.randint(a + 1, len(p))] if rng.random() < 0.5 else p
            if rng.random() < 0.3:
                k = rng.randrange(len(p))
                p = p[:k] + "#" + p[k + 1:]
            t += word(rng.randint(0, 60)) + p
        rows.append((i * 3, t))
    return rows


@pytest.mark.parametrize("seed,alphabet", [(1, "abcdefgh é"), (2, "ab"), (3, "日本語 text")])
def test_matches_all_strings(spark, seed, alphabet):
    rows = spliced(seed, 80, alphabet)
    want = brute(rows)
    assert result(frame(spark, rows)) == want and sum(w[2] for w in want) > 2000


def test_exact_bounds(spark):
    """A string of 100 bytes is removed, one of 99 is not; the earlier place keeps it."""
    rng = random.Random(5)
    own = lambda k: "".join(rng.choice("abcdefghijklmnop") for _ in range(k))
    p, q, r = own(100), own(99), own(100)
    rows = [(1, own(50) + p + own(7)), (2, own(3) + "." + p + "!" + own(90)), (3, own(20) + "," + q + ";"), (4, q + ":" + own(30)),
            (5, own(10) + r + own(33) + r), (6, own(130))]
    got = {x[0]: x[2:4] for x in result(frame(spark, rows))}
    assert got == {1: (0, 0), 2: (100, 1), 3: (0, 0), 4: (0, 0), 5: (100, 1), 6: (0, 0)}
    assert result(frame(spark, rows)) == brute(rows)


def test_runs_of_one_character_and_periodic_texts(spark):
    rows = [(1, "=" * 5000), (2, "=" * 130 + "x" + "=" * 99), (3, "ab" * 400), (4, "ba" * 60), (5, "abc " * 300), (6, "-" * 99), (7, "é" * 60)]
    assert result(frame(spark, rows)) == brute(rows)


def test_odd_rows(spark):
    """Nulls, copies, a null id, repeated rows, long texts; clashing names."""
    rows = documents() + [(300, "same text " * 30), (300, "same text " * 30), (-5, "same text " * 30)]
    df = clash(frame(spark, rows))
    assert result(df) == brute(rows)
    out, name = S.remove_repeats(df)
    assert out.columns == [*df.columns, name]


def test_different_texts_of_one_id_keep_one_copy(spark):
    rng = random.Random(1)
    t = "".join(rng.choice("abcdefgh") for _ in range(300))
    got = result(frame(spark, [(1, t + "1"), (1, t + "2")]))
    assert sorted(x[2] for x in got) == [0, 300]


def test_empty_table(spark):
    assert result(frame(spark, [])) == []


def test_small_pieces_blocks_and_hot_names(spark, monkeypatch):
    """Long texts over several pieces, blocks and buckets, names that are spread: run in this process."""
    import pyarrow as pa
    for k, v in {"PIECE": 700, "BLOCK": 2000, "HOT": 4}.items():
        monkeypatch.setattr(S, k, v)
    rows = spliced(9, 60)
    rows.append((1000, "".join(t for _, t in spliced(9, 12)) + "z" * 900))
    texts = pa.array([t for _, t in rows])
    data, offsets = S.common.utf8(texts)
    units = []
    for docs, begin, part, off in S._pieces(texts, 100):
        d, first, many, h, k = S.units_of(part, off, 100)
        units += zip(docs[d].tolist(), (first + begin[d]).tolist(), many.tolist())
    strings = sorted((d, f + i) for d, f, m in units for i in range(m))
    assert strings == [(d, i) for d, (_, t) in enumerate(rows) for i in range(len(t.encode()) - 99)]
    # All strings as one list of units a document, through the rounds.
    lists = [[f * 256 + m - 1 for d, f, m in units if d == i] for i in range(len(rows))]
    captured = capture(S, monkeypatch)
    table = pa.table({"id": [d for d, _ in rows], "version": pa.array([0] * len(rows), pa.int32()), "text": texts, "ats": pa.array(lists, pa.list_(pa.int64()))})
    blocks = [(i, *r[1:]) for i, r in enumerate(captured.map(S._blocks, table, 100))]
    assert len(blocks) > 5
    names = captured.groups(lambda t: S._names(t, 3, 1), captured.map(S._triples, captured.table(blocks), 3), "bucket")
    again = captured.groups(lambda t: S._names(t, 3, 2), captured.groups(lambda t: S._triples_of_names(t, t, 3, 100), blocks + names, "block"), "bucket")
    assert any(n >> 63 for r in again for n in np.frombuffer(r[2], np.uint64).tolist())
    suffixes = captured.groups(lambda t: S._suffixes(t, t, 3, 100), blocks + names + again, "block")
    hits = captured.groups(lambda t: S._merged(t, 3, 100), suffixes, "bucket")
    got = {(d, (at >> 8) + i) for d, _, at in hits for i in range((at & 255) + 1)}
    first, want = {}, set()
    for d, t in rows:
        raw = t.encode()
        for i in range(len(raw) - 99):
            if first.setdefault(raw[i:i + 100], (d, i)) != (d, i):
                want.add((d, i))
    assert got == want and len(want) > 1000


def capture(module, monkeypatch):
    """Runs the operator's task functions on lists of rows instead of on a cluster, so that module
    parameters set by a test apply."""
    import pyarrow as pa
    names = ["block", "bucket", "a", "b"]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    class Frame:
        def __init__(self):
            self.fn = None

        def mapInArrow(self, fn, schema):
            self.fn = fn
            return self

        applyInArrow = mapInArrow

        def __getattr__(self, name):
            return lambda *a, **k: self

    monkeypatch.setattr(module.F, "monotonically_increasing_id", lambda: type("C", (), {"alias": lambda self, n: n})())

    class Runner:
        def table(self, rows):
            return pa.Table.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

        def rows(self, table):
            return list(zip(*[table.column(i).to_pylist() for i in range(table.num_columns)]))

        def map(self, build, table, *args):
            frame_ = Frame()
            build(frame_, *args)
            return [r for b in frame_.fn(iter(table.to_batches())) for r in self.rows(b)]

        def groups(self, build, rows, key, *args):
            frame_ = Frame()
            build(frame_, *args)
            out = []
            at = names.index(key)
            for k in sorted({r[at] for r in rows}):
                out += self.rows(frame_.fn(self.table([r for r in rows if r[at] == k])))
            return out

    return Runner()
