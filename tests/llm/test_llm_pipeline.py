"""The corpus pipeline: stage order, columns, and each stage against a plain version."""
import hashlib

import corpus_pipeline as P
from llm_cases import frame
from test_llm_decontaminate import brute as brute_hits
from test_llm_line_dedup import brute as brute_lines
from test_llm_near_dedup import brute as brute_groups

from ontime_spark.llm import bpe, language_id, line_dedup
from ontime_spark.session import materialize

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontaminate", "byte_bpe"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.dtypes
    net = language_id.fit(docs)
    for name, stage in P.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        out = materialize(stage(spark, docs, SF), f"test-{name}")
        rows = out.collect()
        if name != "byte_bpe":
            assert out.dtypes == columns
            after = sorted((r.doc_id, r.text) for r in rows)
        if name == "language_id":
            named, r = language_id.identify(docs, net)
            assert after == sorted((x.doc_id, x.text) for x in named.collect()
                                   if x[r].lang != "und" and x[r].score >= language_id.MIN_SCORE)
            assert len(after) > 0.95 * len(before)
        elif name == "line_dedup":
            gone = brute_lines(before, long_docs=line_dedup.MIN_DOCS)
            want = []
            for d, text in before:
                left = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone[d, text])
                if not gone[d, text] or left.strip(" \t\n\v\f\r"):
                    want.append((d, left))
            assert after == sorted(want)
            assert all(r.n_chars == len(r.text) for r in rows)
        elif name == "near_dedup":
            assert [d for d, _ in after] == sorted(d for d, _, c in brute_groups(before) if d == c)
        elif name == "decontaminate":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert [d for d, _ in after] == sorted(x[0] for x in brute_hits(before, items) if x[2] == 0)
        else:
            path, pattern = bpe.vocabulary()
            e = bpe.Encoder(bpe.load_ranks(path), pattern)
            ids = dict(zip([d for d, _ in before], e.encode_texts([t for _, t in before])))
            text = dict(before)
            assert {r.doc_id for r in rows} == set(text)
            for r in rows:
                assert " ".join(map(str, r.ids)) == ids[r.doc_id] and r.n_tokens == len(r.ids)
                assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
        docs = out


def test_run_on_odd_documents(spark, tmp_dir):
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (3, "the of and " * 30, "en", "s", 1),
            (4, "the of and " * 30, "en", "s", 1), (None, "la et de " * 30, "fr", "s", 2), (5, "le la et un " * 20, "fr", None, 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame(spark, rows, schema, 1).write.parquet(f"{tmp_dir}/documents.parquet")
    frame(spark, [(1, "nothing of it is here")], "item_id long, text string", 1).write.parquet(f"{tmp_dir}/benchmark.parquet")
    assert sorted(str(r.doc_id) for r in P.run(spark, tmp_dir).collect()) == ["3", "5", "None"]
    frame(spark, [], schema, 1).write.mode("overwrite").parquet(f"{tmp_dir}/documents.parquet")
    assert P.run(spark, tmp_dir).count() == 0
