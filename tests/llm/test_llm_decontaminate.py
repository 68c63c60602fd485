"""Wu-Manber search against direct comparison of every position."""
import hashlib
import random
import re

from llm_cases import LOWER, clash, documents, frame, sentence
from pyspark.sql import functions as F

from ontime_spark.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(rows, items):
    wins = {}
    for name, text in items:
        w = WORD.findall((text or "").translate(LOWER))
        for i in range(max(1, len(w) - 9) if w else 0):
            wins.setdefault(tuple(w[i:i + 10]), set()).add("" if name is None else str(name))
    out = []
    for d, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        hit, names = set(), set()
        for p, ids in wins.items():
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i:i + len(p)]) == p:
                    hit |= set(range(i, i + len(p)))
                    names |= ids
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(names), digest))
    return sorted(out, key=str)


def test_matches_direct_comparison(spark):
    rng = random.Random(9)
    rows = documents()
    items = [(1, sentence(rng, 30)), (2, sentence(rng, 12)), (2, "alpha beta"), (3, "gamma"), (4, None), (5, ""),
             (6, "..."), (None, "delta the of"), (10, rows[0][1]), (9, rows[0][1]), (11, "x1 zeta. the")]
    rows += [(300, f"{rows[3][1]} {items[0][1]} {rows[4][1]}"), (301, items[1][1].upper()), (302, "x1, zeta the")]
    want = brute(rows, items)
    for block in (1 << 20, 40):  # one block of items, and several
        out, r = D.occurrences(clash(frame(spark, rows)), frame(spark, items, "item_id long, text string"), block_bytes=block)
        got = [(x.doc_id, x[r].n_words, x[r].n_hit, len(x[r]["items"]),
                hashlib.sha256(",".join(x[r]["items"]).encode()).hexdigest()) for x in out.collect()]
        assert sorted(got, key=str) == want


def test_nothing_to_search_for_or_in(spark):
    none = frame(spark, [], "item_id long, text string")
    out, r = D.occurrences(frame(spark, documents()), none)
    assert out.where(F.col(r)["n_hit"] > 0).count() == 0
    assert D.clean_documents(frame(spark, []), none).count() == 0


def test_clean_documents_keep_rows_and_columns(spark):
    docs = clash(frame(spark, [(1, "we pass by here"), (2, "so a b c it is"), (3, None)]))
    out = D.clean_documents(docs, frame(spark, [(7, "A B C")], "item_id long, text string"))
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == {1, 3}


def test_shift_table_skips_and_finds_overlaps():
    text = [b"a"] * 6 + [b"b"] * 3
    found = D.WuManber([(b"a", b"a", b"a"), (b"a", b"b", b"b"), (b"b", b"b", b"b")], 3).find(text)
    assert sorted(i for i, _ in found) == [0, 1, 2, 3, 5, 6]
    assert D.WuManber([(b"x", b"y", b"z")], 3).default == 2
