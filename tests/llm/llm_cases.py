"""Rows shared by the tests: nulls, empty and long texts, ties and repeats."""
import random
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
VOCAB = ["alpha", "Beta", "gamma", "delta", "the", "of", "and", "über", "naïve", "日本", "x1", "zeta."]


def sentence(rng, n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def documents(seed=5):
    """(doc_id, text) rows: near copies, exact copies, repeated rows, null id, odd texts."""
    rng = random.Random(seed)
    base = [sentence(rng, rng.randint(1, 60)) for _ in range(25)]
    rows = list(enumerate(base))
    for i in range(8):
        w = base[i].split(" ")
        w[rng.randrange(len(w))] = "changed"
        rows.append((100 + i, " ".join(w)))
    rows += [(200, base[0]), (201, base[0].upper()), (202, base[0]), (202, base[0]), (203, None), (204, ""),
             (205, " \n\t "), (206, "one"), (207, "ONE"), (208, "word " * 4000), (209, "x" * 50000), (None, base[1]),
             (None, None), (210, "a b c d"), (211, "a  b\nc d"), (212, "nbsp joined words here now ok")]
    return rows


def frame(spark, rows, schema="doc_id long, text string", parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts)


def clash(df):
    """The rows with extra columns named like helpers of the operators."""
    from pyspark.sql import functions as F
    for c in ("_result", "node", "id", "key", "sig", "label", "version", "n_dropped", "_version", "_text_hash", "bands"):
        df = df.withColumn(c, F.lit(1))
    return df
