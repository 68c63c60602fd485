"""Decision lists: counted statistics against plain code, learned verdicts on held-out rows."""
import random
import re
from collections import Counter

from llm_cases import WORD, clash, documents, frame
from pyspark.sql import functions as F

from ontime_spark.llm import quality_rules as Q


def counts(text):
    t = text or ""
    w, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
    c, rep = Counter(zip(w, w[1:], w[2:])), set()
    for i in range(len(w) - 2):
        if c[w[i], w[i + 1], w[i + 2]] > 1:
            rep |= {i, i + 1, i + 2}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep))


def test_statistics(spark):
    rng = random.Random(2)
    rows = documents() + [(600 + i, " ".join(rng.choice("a b c # $x".split()) for _ in range(rng.randint(0, 30)))) for i in range(40)]
    rows += [(700, "l\nl\n\n \nl\n l"), (701, "a a a a"), (702, "a b c"), (703, "a b c a b c"), (704, "|<>&%$*#\x0b\x0c\r x")]
    out = Q.statistics(clash(frame(spark, rows)).withColumn("words", F.lit(1)).withColumn("s", F.lit(1))).collect()
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out), key=str)
    assert got == sorted(((d, *counts(t)) for d, t in rows), key=str)


def labelled(spark, n, seed):
    """Low quality: many symbols, or upper case with few distinct words."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        kind = rng.choice(["good", "good", "good", "symbols", "upper"])
        words = [f"{rng.choice('abcdefgh')}{rng.choice('aeiou')}{rng.randrange(900)}" for _ in range(80)]
        if kind == "symbols":
            words = [w + "##" for w in words]
        if kind == "upper":
            words = [w.upper() + "XX" for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, 1 if kind == "good" else 0, 0))
    return frame(spark, rows), frame(spark, labels, "doc_id long, quality int, toxic int")


def test_learned_list_separates_held_out_rows(spark):
    docs, labels = labelled(spark, 300, 1)
    out, rules = Q.judged(docs, labels.where("doc_id % 2 = 0"))
    r = out.join(labels, "doc_id").where("doc_id % 2 = 1").agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int"))).first()
    assert r[0] > 0.97 and 1 <= len(rules) <= Q.MAX_RULES
    assert all(n in Q.FEATURES for x in rules for n, _, _ in x.conditions)


def test_first_rule_that_holds_decides(spark):
    rules = [Q.Rule([("n_words", True, 5.0), ("symbols_per_word", True, 0.5)]), Q.Rule([("n_words", False, 1.0)])]
    df = spark.createDataFrame([(10, 9), (10, 1), (1, 0)], "n_words long, n_symbols long")
    assert [r[0] for r in df.select(Q.verdict(rules)).collect()] == [False, True, False]
    assert spark.range(1).select(Q.verdict([])).first()[0] is True


def test_without_use_of_labels(spark):
    docs, labels = labelled(spark, 30, 3)
    for some in (labels.where("doc_id < 0"), labels.withColumn("quality", F.lit(1)), labels.withColumn("quality", F.lit(None).cast("int"))):
        out, rules = Q.judged(docs, some)
        assert rules == [] and out.where("kept = base_failed").count() == 0
    out, _ = Q.judged(frame(spark, []), labels)
    assert out.count() == 0


def test_no_python_in_the_plan(spark):
    plan = Q.op7_quality_rules(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
