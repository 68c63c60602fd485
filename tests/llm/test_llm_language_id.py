"""Byte CNN: held-out accuracy, windows, odd texts."""
import random

import numpy as np
from llm_cases import clash, documents, frame
from pyspark.sql import functions as F

from ontime_spark.llm import language_id as L

SF = "/root/testdata/sf0.01"


def test_windows_cover_every_byte():
    for size in (0, 1, 3, 255, 256, 257, 506, 507, 2000):
        data = np.arange(size, dtype=np.int64).astype(np.uint8)
        x, owner, length = L.windows(data, np.array([0, size, size]))
        assert set(owner.tolist()) <= {0} and (len(x) > 0) == (size > 0)
        stride = L.WINDOW - max(L.WIDTHS) + 1
        seen = np.zeros(size, bool)
        for k, n in enumerate(length):
            assert (x[k][:n] == data[k * stride:k * stride + n]).all() and (x[k][n:] == 0).all()
            seen[k * stride:k * stride + n] = True
        assert seen.all()


def test_held_out_accuracy_on_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = L.op5_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    r = out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a"), F.min("score"), F.max("score")).first()
    assert r["a"] > 0.95 and r[1] >= 0 and r[2] <= 1


def test_training_rows_and_odd_texts(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(("le la et".split(), "the of and".split())[i % 2]) for _ in range(30)),
             ("fr", "en")[i % 2]) for i in range(60)] + [(900, "zzz", None)]
    net = L.fit(frame(spark, rows, "doc_id long, text string, lang string"))
    assert net.languages == ["en", "fr"]
    docs = clash(frame(spark, documents() + [(500, "12 34 ..."), (501, "é"), (502, "la et le et"), (503, "the of")]))
    out, r = L.identify(docs, net)
    got = {x.doc_id: x[r] for x in out.collect()}
    assert out.columns[:-1] == docs.columns
    for d in (203, 204, 205, 500):
        assert tuple(got[d]) == ("und", 0.0)
    assert got[502].lang == "fr" and got[503].lang == "en" and got[501].lang in net.languages
    assert {r.doc_id for r in L.accepted(docs, net).collect()}.isdisjoint({203, 204, 205, 500})


def test_no_labels_no_rows(spark):
    schema = "doc_id long, text string, lang string"
    assert L.fit(frame(spark, [(1, "text", None), (3, None, "en"), (4, "", "en")], schema)) is None
    out, r = L.identify(frame(spark, [(1, "text")]), None)
    assert tuple(out.first()[r]) == ("und", 0.0)
    assert L.identify(frame(spark, []), None)[0].count() == 0
