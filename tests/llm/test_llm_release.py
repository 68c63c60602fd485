"""Intermediate tables and memory are given up as soon as nothing reads them."""
import os

from ontime_spark import session
from ontime_spark.llm import common, line_dedup, near_dedup

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu nu xi omicron pi rho sigma tau upsilon".split()


def _docs(spark):
    same = [" ".join(WORDS)] * 3
    near = [" ".join([*WORDS, f"tail{i}"]) for i in range(6)]
    lines = ["\n".join(["all rights are reserved here", f"own text number {'abcdefghij'[i]} is {WORDS[i]} only"]) for i in range(8)]
    return spark.createDataFrame([(i, t) for i, t in enumerate([*same, *near, *lines, None, ""])], "doc_id long, text string")


def _left(since: list[str]) -> list[str]:
    return [p for p in session._written if p not in since and os.path.isdir(p.removeprefix("file:"))]


def test_near_duplicates_leaves_only_what_its_result_reads(spark):
    before = list(session._written)
    out = near_dedup.near_duplicates(_docs(spark))
    left = _left(before)
    assert len([p for p in left if "/stars-" not in p]) <= 3
    got = {r["doc_id"]: r["component_id"] for r in out.collect()}
    assert all(got[i] == 0 for i in range(9))
    assert got[17] == 17 and got[18] == 18


def test_line_dedup_leaves_only_what_its_result_reads(spark):
    before = list(session._written)
    out = line_dedup.drop_recurring(_docs(spark))
    assert len(_left(before)) <= 2
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got[9].startswith("all rights") and got[10] == "own text number b is beta only"


def test_discard_takes_only_tables_it_wrote(spark):
    kept, gone = session.materialize(spark.range(3), "kept"), session.materialize(spark.range(4), "gone")
    session.discard(gone, None, spark.range(2))
    assert kept.count() == 3 and not any("/gone-" in p for p in session._written)


def test_giving_back_follows_each_group(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))

    def one(rows):
        return rows + 1

    def two(left, right):
        return left * right

    assert common.giving_back(one)(2) == 3 and common.giving_back(two)(2, 5) == 10 and len(calls) == 2
