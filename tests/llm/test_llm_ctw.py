"""Context-tree weighting against a direct recursion over the whole tree."""
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import LOWER, WORD, clash, documents, frame
from pyspark.sql import functions as F

from ontime_spark.llm import ctw

D = ctw.DEPTH


def stream(text):
    words = WORD.findall((text or "").translate(LOWER))
    return b"".join(w.encode() + b" " for w in words) + b"\n", words


def brute(rows, held):
    """{(id, text): (tokens, known, total, base, score)} with an explicit tree."""
    n = Counter()  # (context, node, bit)
    for d, text in rows:
        if not held(d):
            data = b"\n" * D + stream(text)[0]
            for i in range(D, len(data)):
                node = 1
                for k in range(8):
                    bit = data[i] >> (7 - k) & 1
                    for depth in range(D + 1):
                        n[data[i - depth:i], node, bit] += 1
                    node = node * 2 + bit
    kids = {}
    for ctx, node, _ in n:
        if ctx:
            kids.setdefault((ctx[1:], node), set()).add(ctx)
    kt = lambda a, b: math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)
    memo = {}

    def weighted(ctx, node):
        if (ctx, node) not in memo:
            own = kt(n[ctx, node, 0], n[ctx, node, 1])
            if len(ctx) == D:
                memo[ctx, node] = own
            else:
                below = sum(weighted(c, node) for c in kids.get((ctx, node), ()))
                memo[ctx, node] = np.logaddexp(own, below) - math.log(2)
        return memo[ctx, node]

    def one(data, i, node, depth=0):
        ctx = data[i - depth:i]
        a, b = n[ctx, node, 0], n[ctx, node, 1]
        p = (b + .5) / (a + b + 1)
        if depth == D:
            return p
        share = math.exp(kt(a, b) - math.log(2) - weighted(ctx, node))
        return share * p + (1 - share) * one(data, i, node, depth + 1)

    words = Counter()
    for d, text in rows:
        if not held(d):
            words.update([*stream(text)[1], None])
    total, v = sum(words.values()), len(words)
    out = {}
    for d, text in rows:
        raw, own = stream(text)
        data, score = b"\n" * D + raw, 0.0
        for i in range(D, len(data)):
            node = 1
            for k in range(8):
                bit = data[i] >> (7 - k) & 1
                p = one(data, i, node)
                score += math.log10(p if bit else 1 - p)
                node = node * 2 + bit
        tokens = [*own, None]
        base = sum(math.log10((words[w] + .1) / (total + .1 * (v + 1))) for w in tokens)
        out[d, text] = (len(tokens), sum(words[w] > 0 for w in tokens), total, base, score)
    return out


def crc(d):
    return zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0


def test_matches_explicit_tree(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["ab", "Ba", "abc", "é", "c"]) for _ in range(rng.randint(0, 12)))) for i in range(40)]
    rows += [(50, None), (51, ""), (52, " \t"), (None, "ab ab"), (7, rows[7][1]), (53, "x" * 400)]
    want = brute(rows, crc)
    monkeypatch.setattr(ctw, "BLOCK_BYTES", 200)  # several blocks
    out = ctw.score(clash(frame(spark, rows)).drop("id", "key").withColumn("held_out", F.lit("no"))).join(
        frame(spark, [(d, t, t is None) for d, t in rows], "d long, t string, n boolean").select("d").distinct(),
        F.expr("doc_id <=> d")).collect()
    assert len(out) == len(rows)
    by_id = {}
    for (d, _), v in want.items():
        by_id.setdefault(d, []).append(v)
    for r in out:
        near = [v for v in by_id[r.doc_id] if v[:3] == (r.n_tokens, r.n_known, r.train_tokens)
                and abs(v[3] - r.base_score) < 1e-6 and abs(v[4] - r.score) < 1e-6]
        assert near and r.held_out == crc(r.doc_id)


def test_long_and_odd_documents(spark):
    rows = documents()
    out = ctw.score(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.score < 0 and math.isfinite(r.score) and r.n_tokens >= 1
    assert ctw.score(frame(spark, [])).count() == 0


def test_nothing_to_learn_from(spark):
    out = ctw.score(frame(spark, [(1, "ab"), (2, None)]), held=F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.bits_per_byte == pytest.approx(8) for r in out)


@pytest.mark.parametrize("x", [0.5, 1.0, 7.5, 1234.5, 1e9])
def test_log_gamma(spark, x):
    got = spark.range(1).select(ctw.log_gamma(F.lit(x))).first()[0]
    assert got == pytest.approx(math.lgamma(x), rel=1e-12, abs=1e-9)
