"""Periodic runs against all periods of all stretches."""
import hashlib
import random
import zlib

import numpy as np
import pytest
from llm_cases import WORD, clash, documents, frame

from ontime_spark.llm import periodic_runs as P


def brute(w):
    """(start, length, period) by scanning every lag; smallest period by trying all smaller ones."""
    n, out = len(w), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            e = j + q
            if e - i >= max(24, 3 * q) and not any(all(w[k] == w[k + p] for k in range(i, e - p)) for p in range(1, q)):
                out.append((i, e - i, q))
            i = j
    return sorted(out, key=lambda t: (t[0], t[2]))


def found(texts):
    """Runs of each text, a list of words each."""
    ids = {}
    x = np.array([hash_of(ids.setdefault(w, len(ids))) for t in texts for w in t], np.uint64)
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    got = P.runs_of_words(x, doc, len(texts))
    return [got.get(d, []) for d in range(len(texts))]


def hash_of(i):
    return int.from_bytes(hashlib.sha256(str(i).encode()).digest()[:8], "little")


def texts(seed, n, vocab):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        w = []
        for _ in range(rng.randint(0, 5)):
            q = rng.choice([1, 2, 3, 7, 8, 9, 12, 13, 14, 15, 16, 18, 19, 23, 24, 31, 40, 57, 64])
            unit = [rng.randrange(vocab) for _ in range(q)]
            if rng.random() < 0.3 and q > 6:  # a period that is nearly a power itself
                unit = (unit[:q // 3] * 3)[:q - 1] + [rng.randrange(vocab)]
            w += [rng.randrange(vocab) for _ in range(rng.randint(0, 30))]
            w += (unit * 8)[:rng.randint(q, 5 * q + 20)]
        out.append(w)
    return out


@pytest.mark.parametrize("vocab", [2, 3, 50, 10**6])
def test_matches_all_lags(vocab):
    many = texts(vocab, 120, vocab)
    want = [brute(t) for t in many]
    assert found(many) == want
    assert sum(map(len, want)) > 50 and {q for r in want for _, _, q in r} - set(range(13))


def test_exactly_three_periods_at_every_length():
    """The shortest possible run of each period, alone and between other words."""
    for q in range(1, 140):
        n = max(24, 3 * q)
        unit = list(range(q))
        exact = [-1, -2] + (unit * 30)[:n] + [-3]
        short = [-1] + (unit * 30)[:n - 1] + [-3]
        assert found([exact, short, []]) == [[(2, n, q)], [], []], q


def test_scales_leave_no_period_out():
    for lo, hi in P.scales(100000):
        assert hi <= 2 * (lo + 1) - 1 and 2 * (lo + 1) - hi + 1 >= 1
    spans = list(P.scales(1000))
    assert spans[0][0] == P.SHORT and all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and spans[-1][1] >= 333


def test_thue_morse_and_fibonacci_words():
    """Words full of squares, with few cubes, and long repetitions of them."""
    tm, fib = [0], ([0], [0, 1])
    while len(tm) < 512:
        tm += [1 - c for c in tm]
    while len(fib[1]) < 500:
        fib = fib[1], fib[1] + fib[0]
    many = [tm, fib[1], tm[:100] * 4, fib[1][:89] * 5]
    assert found(many) == [brute(t) for t in many]


def query_rows(rows):
    out = []
    for d, text in rows:
        w = WORD.findall(text or "")
        h = zlib.crc32(("" if d is None else str(d)).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        runs = brute(w)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((d, len(runs), *best, best[1] and 1000 * best[1] // best[2], sha("".join("%d,%d,%d\n" % r for r in runs)),
                    sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return sorted(out, key=str)


def test_query_on_odd_rows(spark, tmp_dir):
    rng = random.Random(4)
    rows = documents() + [(1000 + i, " \t".join(f"w{rng.randrange(400)}" for _ in range(rng.randint(0, 300)))) for i in range(150)]
    clash(frame(spark, rows)).write.parquet(f"{tmp_dir}/documents.parquet")
    out = P.op13_periodic_runs(spark, tmp_dir).collect()
    got = sorted((tuple(r) for r in out), key=str)
    assert got == query_rows(rows) and sum(r.n_runs > 0 for r in out) > 8


def test_very_long_text(spark):
    rng = random.Random(8)
    unit = [f"u{rng.randrange(10**6)}" for _ in range(20011)]
    text = " ".join(["x"] * 5 + unit * 4 + ["end"])
    out, r = P.periodic_runs(frame(spark, [(1, text), (2, "b " * 300000), (3, None)]))
    got = {x.doc_id: x[r] for x in out.collect()}
    assert [tuple(x) for x in got[1].runs] == [(5, 80044, 20011)] and got[1].collapsed == " ".join(["x"] * 5 + unit + ["end"])
    assert [tuple(x) for x in got[2].runs] == [(0, 300000, 1)] and got[2].collapsed == "b"
    assert got[3].n_runs == 0 and got[3].collapsed == "" and got[3].start is None


def test_empty_table_and_names(spark):
    out, r = P.periodic_runs(clash(frame(spark, [])))
    assert out.count() == 0 and r in out.columns
