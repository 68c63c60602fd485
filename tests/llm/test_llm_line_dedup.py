"""Log-template tree against a plain version on small rows."""
import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from llm_cases import clash, frame, sentence
from pyspark.sql import functions as F

from ontime_spark.llm import line_dedup as L


def masked(line):
    return " ".join("<*>" if re.search("[0-9]", t) else t for t in re.split(r"[\x20\x09-\x0D]+", line) if t)


def key_of(line):
    """(tokens, whether it is long) of a line, None if it is left alone."""
    t = masked(line)
    n, chars, octets = t.count(" ") + 1, len(t), len(t.encode())
    words = max(n, chars // 2) if octets > L.UNSPACED * n and chars > L.UNSPACED * n else n
    return (tuple(t.split(" ")), words > L.LONG_WORDS) if t and words >= L.MIN_TOKENS else None


def line_hash(tokens):
    return xxhash.xxh64(" ".join(tokens).encode(), seed=42).intdigest() + (1 << 63) & (1 << 64) - 1


def brute(rows, min_docs=L.MIN_DOCS, long_docs=L.LONG_DOCS):
    """{(doc, text): dropped line numbers}."""
    leaves = defaultdict(lambda: defaultdict(set))
    for d, text in rows:
        for line in (text or "").split("\n"):
            if k := key_of(line):
                leaves[len(k[0]), k[1], " ".join(k[0][:L.LEADING])][k[0]].add(d)
    template, docs_of, fresh = {}, defaultdict(set), iter(range(10**9))
    for (size, long, _), lines in leaves.items():
        need = long_docs if long else min_docs
        todo = [lines]
        while todo:
            left = todo.pop()
            if len(left) < 2 or sum(map(len, left.values())) < need:
                continue
            weights = [weigh(left, i) for i in range(size)]
            tops = [max((n, t.encode()) for t, n in w.items()) for w in weights]
            total = sum(map(len, left.values()))
            pattern = max(left, key=lambda x: (len(left[x]), line_hash(x))) if long else [t.decode() for _, t in tops]
            cuts = [(len(w), n, i) for i, (w, (n, _)) in enumerate(zip(weights, tops)) if n * 100 <= total * L.SIMILAR]
            fits = {x for x in left if 100 * sum(a == b for a, b in zip(x, pattern)) >= L.SIMILAR * size}
            if len(set().union(*[left[x] for x in fits])) >= need:
                name = next(fresh)
                template |= {x: name for x in fits}
                todo.append({x: d for x, d in left.items() if x not in fits})
            elif cuts:
                at = min(cuts)[2]
                todo += [{x: d for x, d in left.items() if x[at] == t} for t in weights[at]]
            else:
                todo.append({x: d for x, d in left.items() if x not in fits})
        for x, d in lines.items():
            template.setdefault(x, x)
            docs_of[template[x]] |= d
    first = lambda s: min((x for x in s if x is not None), default=None)
    out = {}
    for d, text in rows:
        gone = set()
        for i, line in enumerate((text or "").split("\n")):
            if k := key_of(line):
                docs = docs_of[template[k[0]]]
                if len(docs) >= (long_docs if k[1] else min_docs) and d != first(docs):
                    gone.add(i)
        out[(d, text)] = gone
    return out


def weigh(lines, i):
    c = Counter()
    for t, docs in lines.items():
        c[t[i]] += len(docs)
    return c


def rows():
    rng = random.Random(8)
    out = []
    for i in range(40):
        lines = [sentence(rng, rng.randint(1, 12)) for _ in range(rng.randint(1, 4))]
        if i % 3 == 0:
            lines.insert(rng.randint(0, len(lines)), f"Order {i} was shipped on day {i * 7} of the year")
        if i % 4 == 0:
            lines.append("Read more about  our terms\there: " + ("today" if i % 8 else "tomorrow"))
        if i % 5 == 0:
            lines.append("This passage stands in many documents and has " + "more " * 50 + ("words" if i % 10 else "terms"))
        out.append((i, "\n".join(lines)))
    return out + [(100, None), (101, ""), (102, "\n\n"), (3, out[3][1]), (None, out[0][1]), (None, out[4][1]),
                  (103, "same line here again\n" * 9), (104, "word " * 3000)]


def test_matches_plain_version(spark):
    data = rows()
    want = brute(data)
    out = L.drop_recurring(clash(frame(spark, data)).withColumn("_row", F.lit(2))).collect()
    assert len(out) == len(data)
    texts = Counter()
    for (d, text), gone in want.items():
        kept = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
        texts[(d, kept, len(gone))] += sum(1 for r in data if r == (d, text))
    assert Counter((r.doc_id, r.text, r.n_dropped) for r in out) == texts
    assert sum(r.n_dropped for r in out) > 20


def test_variable_fields_share_a_template(spark):
    data = [(i, f"Session {i} opened for user{i}") for i in range(6)] + [(50, "Session was opened for nobody")]
    out = {r.doc_id: r for r in L.drop_recurring(frame(spark, data)).collect()}
    assert [out[i].n_dropped for i in range(6)] == [0, 1, 1, 1, 1, 1] and out[50].n_dropped == 0
    assert out[1].text == "" and out[1].mostly_recurring and not out[0].mostly_recurring


def test_clean_and_empty_tables_stay(spark):
    data = [(i, f"{'abcdefgh'[i]} quite different text of its own") for i in range(4)]
    assert all(r.n_dropped == 0 for r in L.drop_recurring(frame(spark, data)).collect())
    assert L.drop_recurring(frame(spark, [])).count() == 0


def test_cleaned_documents_keep_columns(spark):
    docs = spark.createDataFrame([(i, f"own{'abcdefghij'[i]} words of it\nthe same line in all", 7) for i in range(6)],
                                 "doc_id long, text string, n_chars long")
    out = L.cleaned_documents(docs)
    assert out.dtypes == docs.dtypes
    assert all(r.n_chars == len(r.text) for r in out.collect())


def test_long_passages_count_from_two_documents(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(400)]
    passage = " ".join(words[:60])
    half = " ".join(w if i < 3 or i % 5 < 3 else "other" + w for i, w in enumerate(words[100:160]))
    chinese, chinese_short = "".join(chr(0x4E00 + i) for i in range(120)), "".join(chr(0x5E00 + i) for i in range(30))
    data = [(1, "one of its own\n" + passage), (2, passage + "\nanother line that stays"), (3, " ".join(words[200:250])),
            (4, " ".join(words[200:250])), (5, " ".join(words[100:160])), (6, half), (7, "before\n" + chinese), (8, chinese),
            (9, chinese_short + "\nfirst"), (10, chinese_short + "\nsecond"),
            *[(20 + i, chinese_short[::-1] + f"\nrest{i}") for i in range(5)]]
    out = {r.doc_id: r for r in L.drop_recurring(frame(spark, data)).collect()}
    assert {d for d, r in out.items() if r.n_dropped} == {2, 8, 21, 22, 23, 24}
    assert out[2].text == "another line that stays" and out[8].text == "" and out[21].text == "rest1"
    assert all(r.n_dropped == 0 for r in L.drop_recurring(frame(spark, data[:8]), long_docs=L.MIN_DOCS).collect())


def test_no_passage_is_lost_from_all_documents(spark):
    a = "this long block stands in both of the first documents and in some others as well"
    b = "a shorter passage that recurs"
    data = [(0, a), (1, f"{a}\n{b}\nonly here"), *[(i, f"{b}\nown{'abcdefghij'[i]} text") for i in range(2, 10)],
            *[(i, a) for i in range(20, 24)], (30, None), (31, "")]
    out = {r.doc_id: r.text for r in L.cleaned_documents(frame(spark, data)).collect()}
    assert out[0] == a and out[1] == f"{b}\nonly here" and out[2] == "ownc text"
    assert set(out) == {*range(10), 30, 31}


def test_leaf_with_several_templates(spark):
    tail = {"left": "alpha yankee beta xray gamma whiskey {} now", "right": "zulu bravo victor charlie tango delta {} then"}
    data = [(10 * k + i, "we go on " + tail[side].format(name)) for k, side in enumerate(tail)
            for i, name in enumerate(["anna", "bert", "carl", "dora", "emil", "fred"])]
    data += [(100 + i, "we go on " + " ".join(c * k for k in range(1, 9))) for i, c in enumerate("pqrstuvwxyz")]
    out = {r.doc_id: r.n_dropped for r in L.drop_recurring(frame(spark, data)).collect()}
    assert {d for d, n in out.items() if n} == {1, 2, 3, 4, 5, 11, 12, 13, 14, 15}
    assert {d: len(g) for (d, _), g in brute(data).items()} == out


@pytest.mark.parametrize("seed", [1, 2])
def test_crowded_leaves_match_plain_version(spark, seed):
    """Few words in many lines of few leaves: candidates that recur, splits, and lines set aside."""
    rng = random.Random(seed)
    data = []
    for i in range(120):
        lines = [" ".join(["on", "we", "go"] + [rng.choice("ab" if rng.random() < 0.8 else "cdefg") for _ in range(rng.choice([2, 7]))])
                 for _ in range(3)]
        lines.append(" ".join(rng.choice(["aa", "bb"]) if j % 9 == 0 else f"w{chr(97 + j % 20)}" for j in range(60)))
        data.append((i, "\n".join(lines)))
    out = Counter((r.doc_id, r.n_dropped) for r in L.drop_recurring(frame(spark, data)).collect())
    assert out == Counter((d, len(g)) for (d, _), g in brute(data).items()) and sum(n for _, n in out) > 100
