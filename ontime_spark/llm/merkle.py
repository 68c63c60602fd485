"""Merkle manifest of a dataset by cogrouped subtree exchange (operator 12).

Every row is a leaf: the digest of its fields. The leaves of a group (a language) are numbered in
order; runs of ``FANOUT`` consecutive nodes become one, until one node, the group's subroot, is
left; the subroots, in order of their groups, make the root in the same way.

Up: nodes are reduced in superblocks of ``FANOUT ** LEVELS``, one job for each such layer (two for
16 million leaves), so no task sees more than 4,096 nodes. Down: the nodes of a superblock and
the one row of outer nodes that it needs (what stands beside its path to the root) are cogrouped
by superblock; ``applyInPandas`` reduces the block again, joins the proofs and folds them at once.

Rows of a group are ordered by the order column, nulls first, then by leaf, so rows that repeat an id
have a defined place; equal rows are leaves of their own. Null fields are a mark of their own, a
null group is the first one, very long texts are hashed in the JVM and never moved. An empty table
has no rows; other columns are ignored."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ontime_spark.llm import common
from ontime_spark.session import materialize

#: Consecutive nodes that become one.
FANOUT = 8
#: Levels of a superblock.
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and its text."""
    parts = []
    for f in fields:
        text = f.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with idx (place inside ``tree``) and n (rows of the tree). One range-partitioned sort
    over all trees, so that a tree of any size is spread; only the counts of (tree, partition) meet."""
    by = [F.col("tree"), *order]
    placed = materialize(rows.repartitionByRange(*by).sortWithinPartitions(*by)
                         .withColumn("at", F.monotonically_increasing_id())
                         .withColumn("part", F.shiftright("at", 33)), "merkle-placed")
    counts = placed.groupBy("tree", "part").agg(F.min("at").alias("lo"), F.count(F.lit(1)).alias("c"))
    tree = Window.partitionBy("tree")
    before = F.sum("c").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("c")
    starts = counts.select("tree", "part", (F.col("lo") - before).alias("base"), F.sum("c").over(tree).alias("n"))
    return placed.join(starts, ["tree", "part"]).withColumn("idx", F.col("at") - F.col("base")).drop("at", "part", "base")


def _levels(nodes: list[str], n: int, most: int) -> list[list[str]]:
    """The nodes of a superblock and what they become, level by level, as long as the tree, which
    has ``n`` nodes, has more than one (at most ``most`` times)."""
    out = [nodes]
    while n > 1 and len(out) <= most:
        below = out[-1]
        out.append([_h("".join(below[i:i + FANOUT])) for i in range(0, len(below), FANOUT)])
        n = -(-n // FANOUT)
    return out


def _beside(level: list[str]) -> list[tuple[str, str]]:
    """What stands left and right of each node in its run, concatenated."""
    out = []
    for i in range(len(level)):
        first = i - i % FANOUT
        out.append(("".join(level[first:i]), "".join(level[i + 1:first + FANOUT])))
    return out


def _block(levels: int) -> Column:
    return F.expr(f"idx div {FANOUT ** levels}").alias("block")


def _reduced(nodes: DataFrame, levels: int) -> DataFrame:
    """One node for each superblock: tree, idx, n, hash of the next layer."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        n = int(pdf["n"].iloc[0])
        top = _levels(list(pdf["hash"]), n, levels)[-1]
        return pd.DataFrame({"tree": pdf["tree"].iloc[:1], "idx": pdf["block"].iloc[:1],
                             "n": [-(-n // FANOUT ** levels)], "hash": top})

    blocks = nodes.select("tree", "idx", "n", "hash", _block(levels))
    return blocks.groupBy("tree", "block").applyInPandas(run, "tree string, idx long, n long, hash string")


def _layers(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """``nodes`` and the layers above, the last with one node for each tree."""
    out = [nodes]
    while (out[-1].agg(F.max("n")).first()[0] or 0) > 1:
        out.append(materialize(_reduced(out[-1], levels), "merkle-layer"))
    return out


_PATH = "lefts array<string>, rights array<string>"


def _paths(nodes: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """tree, idx, lefts, rights: for each node what stands beside its path to the root, from the
    rows of its superblock and the superblock's own path."""
    def run(pdf: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        beside = [_beside(x) for x in _levels(list(pdf["hash"]), int(pdf["n"].iloc[0]), levels)[:-1]]
        steps = [[b[i // FANOUT ** k] for k, b in enumerate(beside)] for i in range(len(pdf))]
        return pd.DataFrame({"tree": pdf["tree"], "idx": pdf["idx"],
                             "lefts": [[s[0] for s in x] + list(above["lefts"].iloc[0]) for x in steps],
                             "rights": [[s[1] for s in x] + list(above["rights"].iloc[0]) for x in steps]})

    blocks = nodes.select("tree", "idx", "n", "hash", _block(levels))
    above = outer.select("tree", F.col("idx").alias("block"), "lefts", "rights")
    return (blocks.groupBy("tree", "block").cogroup(above.groupBy("tree", "block"))
            .applyInPandas(run, f"tree string, idx long, {_PATH}"))


def _down(layers: list[DataFrame], outer: DataFrame, levels: int) -> DataFrame:
    """Paths of the superblocks of the lowest layer: those of the top node led down."""
    for nodes in reversed(layers[1:]):
        outer = materialize(_paths(nodes, outer, levels), "merkle-paths")
    return outer


def prove(docs: DataFrame, leaf: Column, claimed: Column, group_col: str = "lang",
          order_col: str = "doc_id", levels: int = LEVELS) -> DataFrame:
    """order_col, leaf, subroot, root, proof_sha256, folded_root, verified for each row of
    ``docs``: the manifest over ``leaf``, and whether ``claimed`` with the siblings of ``leaf`` folds
    to the root."""
    id_type = docs.schema[order_col].dataType.simpleString()
    group = F.col(group_col).cast("string")
    rows = materialize(docs.select(F.coalesce(F.concat(F.lit("+"), group), F.lit("")).alias("tree"),
                                   F.col(order_col).alias("id"), leaf.alias("hash"), claimed.alias("claimed")), "merkle-leaves")
    leaves = materialize(_numbered(rows, [F.col("id").asc_nulls_first(), F.col("hash"), F.col("claimed")]), "merkle-numbered")
    below = _layers(leaves.select("tree", "idx", "n", "hash"), levels)
    subroots = below[-1].select("tree", F.col("hash").alias("subroot"))
    # The tree of subroots; its key is one that no group has.
    tops = _numbered(subroots.select(F.lit("root").alias("tree"), F.col("tree").alias("of"), F.col("subroot").alias("hash")),
                     [F.col("of")])
    tops = materialize(tops, "merkle-subroots")
    above = _layers(tops.select("tree", "idx", "n", "hash"), levels)
    none = F.array().cast("array<string>")
    outer = above[-1].select("tree", "idx", none.alias("lefts"), none.alias("rights"))
    if len(above) > 1:
        outer = _paths(above[0], _down(above, outer, levels), levels)
    named = tops.select(F.col("tree").alias("_root"), F.col("idx").alias("_idx"), F.col("of"), F.col("hash").alias("subroot"))
    root = above[-1].select(F.col("tree").alias("_root"), F.col("hash").alias("root"))
    ends = materialize(named.join(outer, (F.col("_root") == F.col("tree")) & (F.col("_idx") == F.col("idx")))
                       .drop("tree", "idx").join(root, "_root")
                       .select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("idx"), "lefts", "rights", "subroot", "root"),
                       "merkle-ends")
    paths = _down(below, ends.select("tree", "idx", "lefts", "rights"), levels)
    outer = paths.join(ends.select("tree", "subroot", "root"), "tree").withColumnRenamed("idx", "block")

    def run(pdf: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        nodes = list(pdf["hash"])
        beside = [_beside(x) for x in _levels(nodes, int(pdf["n"].iloc[0]), levels)[:-1]]
        o = above.iloc[0]
        upper = list(zip(o["lefts"], o["rights"]))
        upper_text = "".join(a + b for a, b in upper)
        proofs, folded = [], []
        for i, own in enumerate(pdf["claimed"]):
            steps = [b[i // FANOUT ** k] for k, b in enumerate(beside)]
            proofs.append(_h("".join(a + b for a, b in steps) + upper_text))
            for a, b in steps + upper:
                own = _h(a + own + b)
            folded.append(own)
        return pd.DataFrame({"id": pdf["id"], "leaf": nodes, "subroot": o["subroot"], "root": o["root"],
                             "proof_sha256": proofs, "folded_root": folded, "verified": [x == o["root"] for x in folded]})

    blocks = leaves.withColumn("block", _block(levels))
    out = (blocks.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(
        run, f"id {id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"))
    return out.withColumnRenamed("id", order_col)


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """Every document with its leaf, proof and roots; where 3 divides the id's crc32 the claimed
    row has the text in lower case."""
    docs = common.read(spark, sf_dir, "documents")
    row = {c: F.col(c) for c in FIELDS}
    lowered = row | {"text": F.translate("text", _UPPER, _LOWER)}
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaf = leaf_digest(list(row.values()))
    return prove(docs, leaf, F.when(changed, leaf_digest(list(lowered.values()))).otherwise(leaf))


_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda i: CAST(i AS BIGINT))), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""


def _sql_leaf(text: str) -> str:
    fields = [f if f != "text" else text for f in FIELDS]
    return "sha256(" + " || ".join(f"coalesce(CAST(strlen(CAST({f} AS VARCHAR)) AS VARCHAR) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields) + ")"


SQL = {"op12_merkle_manifest": f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce('+' || lang, '') AS g, {_sql_leaf('text')} AS leaf,
    CASE WHEN {_CRC32} % 3 = 0 THEN {_sql_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS low FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM d),
t AS (SELECT g, 0 AS lvl, i, leaf AS h, n FROM l
    UNION ALL SELECT g, lvl + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM t WHERE n > 1 GROUP BY g, lvl, i // 8, n),
s AS (SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1),
r AS (SELECT 0 AS lvl, i, h, n FROM s
    UNION ALL SELECT lvl + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM r WHERE n > 1 GROUP BY lvl, i // 8, n),
-- Both trees as one list of levels for each group: the group's own, then those of the subroots.
top AS (SELECT g, max(lvl) AS up FROM t GROUP BY g),
a AS (SELECT g, lvl, i, h FROM t WHERE n > 1
    UNION ALL SELECT top.g, up + r.lvl, r.i, r.h FROM r, top WHERE r.n > 1),
p AS (SELECT l.doc_id, l.leaf, l.g, l.i, s.i AS si, coalesce(low, leaf) AS cur, up FROM l JOIN top USING (g) JOIN s USING (g)),
f AS (SELECT doc_id, leaf, g, i, si, up, cur, 0 AS lvl, '' AS proof FROM p
    UNION ALL SELECT f.doc_id, f.leaf, f.g, f.i, f.si, f.up,
        sha256(string_agg(CASE WHEN a.i = x THEN f.cur ELSE a.h END, '' ORDER BY a.i)), f.lvl + 1,
        f.proof || coalesce(string_agg(a.h, '' ORDER BY a.i) FILTER (a.i <> x), '')
    FROM (SELECT *, CASE WHEN lvl < up THEN i // (8 ** lvl)::BIGINT ELSE si // (8 ** (lvl - up))::BIGINT END AS x FROM f) f
    JOIN a ON a.g = f.g AND a.lvl = f.lvl AND a.i // 8 = f.x // 8
    GROUP BY f.doc_id, f.leaf, f.g, f.i, f.si, f.up, f.cur, f.lvl, f.proof)
SELECT doc_id, leaf, s.h AS subroot, root.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root.h AS verified
FROM f JOIN s USING (g), (SELECT h FROM r WHERE n = 1) root
WHERE f.lvl = f.up + (SELECT max(lvl) FROM r)"""}
