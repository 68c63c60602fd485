"""b-bit MinHash near-duplicate groups (operator 4).

A document's set is its distinct k-word shingles. Documents of equal sets are one class, so a
group of exact copies costs one node however large it is. For each class MinHash minima are
computed; hashed bands of minima give candidate buckets, and the low bits of all minima, packed
in a few longs, give a collision-corrected similarity by bit counts that drops candidates far
below the threshold. What remains is confirmed on the full sets, and confirmed links are joined
to components.

Large groups of near copies are not expanded into pairs: first each document is tested against
the most similar of a few hubs of its buckets and the links found are contracted; only pairs that
still belong to different components are then listed. While that would be very many, hub rounds
are repeated with other hubs. No bucket is capped. Copies that were edited too much for a link
are kept out of the list by exact bounds: a shingle that only one candidate has is in no
intersection; and all members of a bucket are compared with one hub, the label of its largest
component, and their shingles counted by cells (in the hub or not, and by hash): two texts share
at most the smaller count of each cell. The bound is a popcount of a few longs inside the bucket join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime_spark.llm import common
from ontime_spark.session import discard, materialize

SHINGLE_WORDS = 5
#: Two documents are linked when 100 * intersection >= PERCENT * union.
PERCENT = 75
#: A pair at the threshold shares no band with probability (1 - 0.75^6)^64 = 4e-6. Six rows keep
#: passages that many documents share (similarity 0.2 and less) from filling the buckets.
BANDS, ROWS = 64, 6
#: Low bits kept of each minimum; a long holds 32 minima.
BITS = 2
#: Candidates with an estimate this far below the threshold are dropped: five and a half
#: standard deviations of the estimate of a pair at the threshold (384 minima of 2 bits).
MARGIN = 0.15
#: Hubs of a bucket in a hub round.
HUBS = 4
#: Another hub round follows while the last one joined this share of the components in buckets
#: that hold several, but never more rounds than ``HUB_ROUNDS``; then the other pairs are listed.
JOINED, HUB_ROUNDS = 0.05, 6
#: Cells of the shingles in a hub, and as many of the others; counts up to ``CELL_LEVELS`` are bits, the
#: rest of a count is kept in a sum.
CELLS, CELL_LEVELS = 256, 4
#: Documents of one array step: a document's minima take 3 KB, however short its text.
CHUNK_DOCS = 1024

_rng = np.random.default_rng(20240918)
_MULT = _rng.integers(1, 2**63, 1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, 1024, dtype=np.uint64)
_SUM2 = np.uint64(0xD6E8FEB86659FD93)


def _sets(texts, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, shingles, offsets) for chunks of a text column."""
    data, offsets = common.utf8(texts)
    for i, j in common.chunks(offsets, rows=CHUNK_DOCS):
        part = common.LOWER[data[offsets[i]:offsets[j]]]
        own = offsets[i:j + 1] - offsets[i]
        starts, ends, doc = common.words(part, own)
        h, off = common.shingles(common.word_hashes(part, starts, ends), doc, j - i, k)
        yield i, j, h, off


def _per_doc(ufunc, values: np.ndarray, off: np.ndarray, empty) -> np.ndarray:
    """``ufunc`` reduced over each document's values; ``empty`` where it has none."""
    full = off[1:] > off[:-1]
    out = np.full(len(off) - 1, empty, values.dtype)
    if full.any():
        out[full] = ufunc.reduceat(values, off[:-1][full])
    return out


def _set_keys(h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit keys of each set (order-free sums of mixed shingles)."""
    n = (off[1:] - off[:-1]).astype(np.uint64)
    a = common.mix64(_per_doc(np.add, common.mix64(h), off, 0) + n)
    b = common.mix64(_per_doc(np.add, common.mix64(h * _SUM2), off, 0) ^ n)
    return a.view(np.int64), b.view(np.int64)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               k: int = SHINGLE_WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, the set's keys ``node`` and ``check``, its packed low bits ``sig``
    and its band hashes ``bands`` (both null for an empty set)."""
    minima = bands * rows
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for i, j, h, off in _sets(batch.column(1), k):
                size = off[1:] - off[:-1]
                node, check = _set_keys(h, off)
                mins = np.empty((j - i, minima), np.uint64)
                for m in range(minima):
                    mins[:, m] = _per_doc(np.minimum, h * _MULT[m] + _ADD[m], off, 0)
                low = (mins >> np.uint64(17)) & np.uint64((1 << BITS) - 1)
                lanes = 64 // BITS
                shift = (np.arange(minima) % lanes * BITS).astype(np.uint64)
                packed = np.add.reduceat(low << shift, np.arange(0, minima, lanes), axis=1)
                mixed = mins * _MULT[512:512 + minima]
                band = np.add.reduceat(common.mix64(mixed), np.arange(0, minima, rows), axis=1)
                band = common.mix64(band + _ADD[512:512 + bands])
                empty = size == 0
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), pa.array(size), pa.array(node),
                    pa.array(check), _lists(packed.view(np.int64), empty),
                    _lists(band.view(np.int64), empty)],
                    ["id", "n_shingles", "node", "check", "sig", "bands"])
            common.give_back()

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {id_type}, n_shingles long, node long, `check` long, sig array<long>, bands array<long>")


def _lists(rows: np.ndarray, null: np.ndarray) -> pa.Array:
    width = rows.shape[1]
    keep = rows[~null].ravel()
    off = np.concatenate([[0], np.cumsum(np.where(null, 0, width))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(keep), mask=pa.array(null))


def estimate(a: Column, b: Column, minima: int = BANDS * ROWS, bits: int = BITS) -> Column:
    """Similarity from two packed signatures: the share of equal lanes, corrected for lanes that
    agree by chance with probability 2^-bits."""
    lanes = 64 // bits
    ones = sum(1 << (i * bits) for i in range(lanes))
    ones = ones - (1 << 64) if ones >= 1 << 63 else ones
    unequal = F.lit(0)
    for i in range((minima + lanes - 1) // lanes):
        x = a[i].bitwiseXOR(b[i])
        folded = x
        for s in range(1, bits):
            folded = folded.bitwiseOR(F.shiftrightunsigned(x, s))
        unequal = unequal + F.bit_count(folded.bitwiseAND(F.lit(ones)))
    chance = 2.0 ** -bits
    return (1 - unequal / F.lit(float(minima)) - chance) / (1 - chance)


def shingle_sets(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """node, n, shingles (array of hashes) of each row."""
    def run(batches):
        for batch in batches:
            for i, j, h, off in _sets(batch.column(0), k):
                node, _ = _set_keys(h, off)
                sets = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(off[1:] - off[:-1]), sets],
                                                 ["node", "n", "shingles"])
            common.give_back()

    return docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "node long, n long, shingles array<long>")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node each node of ``edges`` (u, v) is connected to, by
    alternating large-star and small-star contraction; groups are only ever reduced to minima.

    An edge is kept once, from its larger node u to the smaller v, and each step is written before
    the next one reads it: a plan over several steps would hold the edges' plan many times."""
    def written(e: DataFrame) -> DataFrame:
        return materialize(e.where("u <> v").distinct(), "stars")

    def lowest(e: DataFrame) -> DataFrame:
        return materialize(e.groupBy("u").agg(F.min("v").alias("m"), F.count("v").alias("n")), "lowest")

    e = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    while True:
        low = lowest(e)
        # Done when every node has one smaller neighbour, which has none itself.
        if low.where("n > 1").isEmpty() and e.join(low.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            discard(low)
            return e.select(F.col("u").alias("node"), F.col("v").alias("label"))
        # Large star: a node's larger neighbours go to its smallest one, or stay.
        large = written(e.join(low.select(F.col("u").alias("v"), "m"), "v", "left").select("u", F.coalesce("m", "v").alias("v")))
        # Small star: a node and its smaller neighbours go to the smallest of them.
        least = lowest(large)
        small = large.join(least.select("u", "m"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, e = (e, low, large, least), written(small.union(least.select("u", F.col("m").alias("v"))))
        discard(*before)


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with the size ``i`` of their intersection on the full sets, and whether
    they are ``linked``."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    i = F.col("i")
    return (pairs.join(left, "a").join(right, "b").withColumn("i", F.size(F.array_intersect("sa", "sb")))
            .select("a", "b", "i", (i * 100 >= (F.col("na") + F.col("nb") - i) * percent).alias("linked")))


def _profiles(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """For each (node, main): ``cells``, the shingles of node by cell as a unary code, those in main's
    set first, and the counts that the code leaves out, ``over_in`` and ``over_out``."""
    left = sets.select("node", F.col("shingles").alias("own"))
    right = sets.select(F.col("node").alias("main"), F.col("shingles").alias("hub"))

    def run(batches):
        for batch in batches:
            bits, over = [], ([], [])
            for own, hub in zip(batch.column(2), batch.column(3)):
                own, hub = own.values.to_numpy(), hub.values.to_numpy()
                inside = np.isin(own, hub)
                code = np.zeros((2, CELL_LEVELS, CELLS), np.uint8)
                for k, part in enumerate((own[inside], own[~inside])):
                    count = np.bincount(common.mix64(part.view(np.uint64)).astype(np.int64) & (CELLS - 1), minlength=CELLS)
                    code[k] = count > np.arange(CELL_LEVELS)[:, None]
                    over[k].append(int(np.maximum(count - CELL_LEVELS, 0).sum()))
                bits.append(np.packbits(code).view(np.int64))
            flat = np.concatenate(bits) if bits else np.zeros(0, np.int64)
            cells = pa.ListArray.from_arrays(pa.array(np.arange(len(bits) + 1, dtype=np.int32) * _LONGS), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), cells, *[pa.array(o, pa.int64()) for o in over]],
                                             ["node", "main", "cells", "over_in", "over_out"])

    return (pairs.join(left, "node").join(right, "main").select("node", "main", "own", "hub")
            .mapInArrow(run, "node long, main long, cells array<long>, over_in long, over_out long"))


#: Longs of a profile's code.
_LONGS = 2 * CELLS * CELL_LEVELS // 64


def _most_by_cells() -> Column:
    """The most shingles that two profiles, the second's columns named with ``_1``, can share."""
    both = [F.bit_count(F.col("cells")[i].bitwiseAND(F.col("cells_1")[i])) for i in range(_LONGS)]
    most = F.least("over_in", "over_in_1") + F.least("over_out", "over_out_1")
    for b in both:
        most = most + b
    return most


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    k: int = SHINGLE_WORDS, percent: int = PERCENT, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (smallest id reachable over links),
    kept (id = component_id).

    Null or wordless texts have an empty set, are linked with nothing and kept. Copies of a row
    (same id and text) are one document and all kept or not alike. A null id never becomes a
    component id while its component has another id. Extra columns are ignored."""
    sig = materialize(signatures(docs, id_col, text_col, k, bands, rows), "signatures")
    classes = materialize(
        sig.where("n_shingles > 0").groupBy("node", "check")
        .agg(F.min("id").alias("first_id"), F.first("n_shingles").alias("n"),
             F.first("sig").alias("sig"), F.first("bands").alias("bands")), "classes")
    exploded = classes.select("node", F.explode("bands").alias("key"))
    crowded = exploded.groupBy("key").agg(F.count("node").alias("c")).where("c > 1").select("key")
    buckets = materialize(exploded.join(crowded, "key").select("key", "node"), "buckets")
    candidates = materialize(buckets.select("node").distinct()
                             .join(classes.select("node", "first_id", "n", "sig"), "node"), "candidates")
    # What the result reads of the rows and classes, without the signatures.
    whole = (sig, classes)
    sig = materialize(sig.select("id", "n_shingles", "node", "check"), "rows")
    classes = materialize(classes.select("node", "check", "first_id"), "class-ids")
    discard(*whole)
    wanted = candidates.select(F.col("first_id").alias("_first"))
    texts = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
             .join(wanted.distinct(), F.col("_id").eqNullSafe(F.col("_first")), "left_semi"))
    sets = materialize(shingle_sets(texts, "_id", "_text", k).join(candidates.select("node"), "node", "left_semi")
                       .groupBy("node").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles")),
                       "sets")

    # Shingles that no other candidate has can be in no intersection: they bound it.
    lone = (sets.select("node", F.explode("shingles").alias("shingle")).groupBy("shingle")
            .agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("node")).where("c = 1")
            .groupBy("node").agg(F.count(F.lit(1)).alias("lone")))
    known = materialize(candidates.select("node", "n", "sig").join(lone, "node", "left")
                        .withColumn("shared", F.col("n") - F.coalesce("lone", F.lit(0))).drop("lone"), "known")
    discard(candidates)
    labels: DataFrame | None = None
    similar = estimate(F.col("sig"), F.col("sig_1"), bands * rows)
    most = F.least("shared", "shared_1")

    def enough(shared: Column) -> Column:
        """100 * shared >= percent * union, with the shared shingles named once."""
        return shared * (100 + percent) >= (F.col("n") + F.col("n_1")) * percent

    alike = enough(most) & (similar >= percent / 100 - MARGIN)
    other = [F.col(c).alias(f"{c}_1") for c in ("node", "n", "shared", "sig")]

    def compared(pairs: DataFrame, before: DataFrame | None) -> DataFrame:
        """All comparisons so far, with the new ones of ``pairs`` made on the full sets."""
        new = materialize(pairs.select(F.greatest("node", "node_1").alias("a"), F.least("node", "node_1").alias("b")).distinct(), "pairs")
        all_new = None if before is None else materialize(new.join(before, ["a", "b"], "left_anti"), "new-pairs")
        made.append(materialize(_compared(new if all_new is None else all_new, sets, percent), "compared"))
        discard(new, all_new)
        return made[-1] if before is None else before.union(made[-1])

    def labelled() -> DataFrame:
        links = tested.where("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))
        return materialize(known.select("node").join(components(links), "node", "left")
                           .select("node", F.coalesce("label", "node").alias("label")), "labels")

    made: list[DataFrame] = []
    over: tuple[DataFrame, ...] = ()
    tested, members = None, buckets
    for turn in range(HUB_ROUNDS):
        # The first hub is the member with the fewest shingles of its own: the text that others
        # are edited from, if there is one.
        named = members.select("key", "node").join(known, "node")
        order = [F.struct((1 - F.col("shared") / F.col("n")).alias("own"), F.xxhash64("node", F.lit(turn)).alias("h"))] if not turn else []
        order += [F.xxhash64("node", F.lit(HUBS * turn + i)) for i in range(HUBS - len(order))]
        hub = F.struct(*[F.col(c) for c in ("node", "n", "shared", "sig")])
        hubs = named.groupBy("key").agg(F.array_distinct(F.array(*[F.min_by(hub, o) for o in order])).alias("hubs"))
        hubs = hubs.select("key", F.explode("hubs").alias("hub")).select("key", *[F.col("hub")[c].alias(f"{c}_1") for c in ("node", "n", "shared", "sig")])
        pairs = named.join(hubs, "key").where((F.col("node") != F.col("node_1")) & alike)
        best = materialize(pairs.groupBy("node").agg(F.max_by("node_1", similar).alias("node_1")), "best-hubs")
        tested = compared(best, tested)
        discard(best, labels, *over)
        labels = labelled()
        named = materialize(buckets.join(labels, "node"), "named")
        parts = named.groupBy("key", "label").agg(F.count("node").alias("c"))
        mixed = parts.groupBy("key").agg(F.count("label").alias("parts"), F.max(F.struct("c", "label"))["label"].alias("main")).where("parts > 1")
        mixed = materialize(mixed, "mixed")
        over = (named, mixed)
        members = named.join(mixed.select("key", "main"), "key")
        apart_now = members.agg(F.countDistinct("label")).first()[0]
        if not apart_now or (turn and apart_now > before_now * (1 - JOINED)):
            break
        before_now = apart_now
    if apart_now:
        # Members outside a bucket's largest component against all members of other components.
        profiles = materialize(_profiles(members.select("node", "main").distinct(), sets), "profiles")
        active = materialize(members.join(known, "node").join(profiles, ["node", "main"]), "active")
        other = [F.col(c).alias(f"{c}_1") for c in ("node", "n", "shared", "sig", "cells", "over_in", "over_out")]
        alike = alike & enough(_most_by_cells())
        left = active.where("label <> main").select("key", F.col("label").alias("label_1"), F.col("main").alias("main_1"), *other)
        apart = (F.col("label") != F.col("label_1")) & ((F.col("label") == F.col("main_1")) | (F.col("node") < F.col("node_1")))
        tested = compared(active.join(left, "key").where(apart & alike).select("node", "node_1"), tested)
        discard(profiles, active, labels)
        labels = labelled()
    discard(buckets, sets, known, *over, *made)

    named = classes.select("node", "check", "first_id").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    tops = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    owner = named.join(tops, "label").select("node", "check", "component_id")
    out = sig.select("id", "n_shingles", "node", "check").join(owner, ["node", "check"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id"))
    return (out.withColumn("component_id", component)
            .select(F.col("id").alias(id_col), "n_shingles", "component_id",
                    F.col("id").eqNullSafe(F.col("component_id")).alias("kept")))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that are kept, one row of each, columns unchanged. Rows that agree in id and
    text are one document; documents without words are all kept."""
    text = F.col(text_col).cast("string")
    flagged = near_duplicates(docs.select(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(text).alias("text")).alias("key"),
                                          text.alias("text")), "key", "text", **options)
    kept = flagged.where("kept").select(F.col("key")["id"].alias("_id"), F.col("key")["text"].alias("_version")).distinct()
    name = common.fresh(docs.columns, "_text_hash")
    kept = kept.withColumnsRenamed({"_id": common.fresh(docs.columns, "_kept_id"), "_version": common.fresh(docs.columns, "_kept_hash")})
    rows = docs.withColumn(name, F.xxhash64(text)).dropDuplicates([id_col, name])
    return rows.join(kept, rows[id_col].eqNullSafe(kept[kept.columns[0]]) & (rows[name] == kept[kept.columns[1]]), "left_semi").drop(name)


def op4_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document with its shingle count, component and whether it is the one kept."""
    return near_duplicates(common.read(spark, sf_dir, "documents"))


SQL = {"op4_minhash_near_dedup": r"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT r, doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS sh FROM w),
x AS (SELECT r, len(sh) AS n, unnest(sh) AS g FROM s),
p AS (SELECT a.r AS a, b.r AS b, a.n AS na, b.n AS nb, count(*) AS i FROM x a JOIN x b ON a.g = b.g AND a.r < b.r GROUP BY ALL),
l AS (SELECT a, b FROM p WHERE 100 * i >= 75 * (na + nb - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach(r, t) AS (SELECT r, r FROM s UNION SELECT reach.r, e.b FROM reach JOIN e ON e.a = reach.t),
c AS (SELECT reach.r, min(s.doc_id) AS component_id FROM reach JOIN s ON s.r = reach.t GROUP BY reach.r)
SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM s JOIN c USING (r)"""}
