"""Language-model scoring by context-tree weighting over bytes (operator 1).

A text is modelled as its token sequence: lower-cased words, each followed by a space, then an
end byte. Every byte is decomposed into eight binary decisions, and each decision node has its
own tree of byte contexts of depth 0 to ``DEPTH``. A node keeps Krichevsky-Trofimov counts; its
weighted probability is half its own KT probability and half the product of its children's, so
the prediction is a mixture of the KT estimates of all depths whose weights the training text
decides. The tree is frozen after training; a text's score is the sum of its bytes' log10
probabilities.

Nothing is broadcast. Documents are packed into blocks of bounded size as they are read; a block
states which byte strings of ``DEPTH`` + 1 bytes and which words it has, with their training
counts, as sorted arrays cut into slots. All arrays of a slot meet in one group; slots divide
strings by the last ``SPLIT`` context bytes, so a group holds whole subtrees, weights them and
hands up one row per node at depth ``SPLIT``. The few levels above are joins and sums of those
rows. Going down again, each group turns its strings into probabilities, and each block gets
back the values of its own strings and words.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime_spark.llm import common
from ontime_spark.session import materialize

DEPTH = 5
#: Context bytes that decide a byte string's slot; deeper levels are computed inside a slot.
SPLIT = 3
#: Bytes of text in a block (a single longer document is one block).
BLOCK_BYTES = 32 << 20
#: Bytes of text that one array step handles.
CHUNK_BYTES = 1 << 20
#: Slots for each shuffle partition: the more, the smaller a group.
SLOTS_EACH = 4
#: Base model: additive smoothing of a word unigram.
ALPHA = 0.1
END = 0x0A
_END_WORD = np.int64(-0x61C8864680B583EB)
_DOCS, _GRAM, _WORD = 0, 1, 2


def _stream(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, modelled bytes per document) of a chunk: for each document ``DEPTH`` end bytes as
    context, its words with a space each, and the end byte."""
    low = common.LOWER[data]
    starts, ends, doc = common.words(low, offsets)
    n = len(offsets) - 1
    lengths = ends - starts
    size = np.bincount(doc, weights=lengths + 1, minlength=n).astype(np.int64) + 1
    begin = np.concatenate([[0], np.cumsum(size + DEPTH)])
    out = np.full(int(begin[-1]), END, np.uint8)
    if len(starts):
        at_word = np.cumsum(lengths + 1) - (lengths + 1)
        place = at_word - np.concatenate([[0], np.cumsum(size - 1)])[doc] + begin[doc] + DEPTH
        step = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out[np.repeat(place, lengths) + step] = low[np.repeat(starts, lengths) + step]
        out[place + lengths] = 0x20
    return out, size


def _events(stream: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(strings of DEPTH + 1 bytes as integers, word hashes with the end word, tokens per
    document) of documents laid out by ``_stream``."""
    n = len(size)
    begin = np.concatenate([[0], np.cumsum(size + DEPTH)])
    wide = stream.astype(np.uint64)
    grams = np.zeros(max(0, len(stream) - DEPTH), np.uint64)
    for i in range(DEPTH + 1):
        grams = grams << np.uint64(8) | wide[i:i + len(grams)]
    own = np.repeat(np.arange(n), size + DEPTH)
    grams = grams[(np.arange(len(stream)) - begin[own] >= DEPTH)[DEPTH:]]
    starts, ends, doc = common.words(stream, begin)
    tokens = np.bincount(doc, minlength=n) + 1
    words = np.full(int(tokens.sum()), _END_WORD, np.int64)
    words[np.arange(len(starts)) + doc] = common.word_hashes(stream, starts, ends).view(np.int64)
    return grams.view(np.int64), words, tokens


def _counted(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sums of their counts."""
    keys = np.concatenate([k for k, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, counts
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[new], np.add.reduceat(counts, new)


def _tally(keys: np.ndarray, training: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with the number of their places that are in training texts."""
    seen, n = np.unique(keys[training], return_counts=True)
    other = np.unique(keys[~training])
    return _counted([(seen, n), (other, np.zeros(len(other), np.int64))])


def _slots(keys: np.ndarray, kind: int, slots: int) -> np.ndarray:
    """The slot of each key: of a string its nearest context bytes decide, of a word its hash."""
    part = (keys >> 8) & ((1 << 8 * SPLIT) - 1) if kind == _GRAM else keys
    return (common.mix64(part.astype(np.uint64)) % np.uint64(slots)).astype(np.int64)


def pack(docs: DataFrame, id_col: str, text_col: str, held_out: Column, slots: int) -> DataFrame:
    """Blocks: one row of documents each (kind 0: ids, held_out, size, and the modelled bytes,
    compressed), and a row for each slot with byte strings (kind 1) or words (kind 2): keys and
    training counts as arrays of integers."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        part = TaskContext.get().partitionId()
        schema = None
        state = {"seq": 0, "bytes": 0, "ids": [], "held": [], "sizes": [], "stream": [], _GRAM: [], _WORD: []}

        def finish():
            block = (part << 24) + state["seq"]
            sizes = np.concatenate(state["sizes"])
            held = np.concatenate(state["held"])
            ids = pa.concat_arrays(state["ids"])
            whole = lambda values: pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), values)
            blob = pa.compress(np.concatenate(state["stream"]).tobytes(), codec="zstd", asbytes=True)
            columns = {"block": pa.array([block]), "kind": pa.array([_DOCS], pa.int32()), "ids": whole(ids),
                       "held_out": whole(pa.array(held)), "sizes": whole(pa.array(sizes)), "blob": pa.array([blob])}
            yield pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(1, f.type) for f in schema], schema=schema)
            for what in (_GRAM, _WORD):
                keys, counts = _counted(state[what])
                slot = _slots(keys, what, slots)
                order = np.argsort(slot, kind="stable")
                keys, counts, slot = keys[order], counts[order], slot[order]
                cuts = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
                ends = [*cuts[1:].tolist(), len(keys)]
                columns = {
                    "block": pa.array(np.full(len(cuts), block, np.int64)), "kind": pa.array(np.full(len(cuts), what, np.int32)),
                    "slot": pa.array(slot[cuts].astype(np.int32)),
                    "keys": pa.array([keys[a:b].tobytes() for a, b in zip(cuts.tolist(), ends)], pa.binary()),
                    "counts": pa.array([counts[a:b].astype(np.int64).tobytes() for a, b in zip(cuts.tolist(), ends)], pa.binary())}
                yield pa.RecordBatch.from_arrays(
                    [columns[f.name] if f.name in columns else pa.nulls(len(cuts), f.type) for f in schema], schema=schema)
            state.update({"seq": state["seq"] + 1, "bytes": 0, "ids": [], "held": [], "sizes": [], "stream": [], _GRAM: [], _WORD: []})

        for batch in batches:
            schema = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("slot", pa.int32()),
                                ("ids", pa.list_(batch.column(0).type)), ("held_out", pa.list_(pa.bool_())),
                                ("sizes", pa.list_(pa.int64())), ("blob", pa.binary()), ("keys", pa.binary()), ("counts", pa.binary())])
            data, offsets = common.utf8(batch.column(2))
            flags = np.asarray(batch.column(1))
            for i, j in common.chunks(offsets, CHUNK_BYTES):
                if state["bytes"] and state["bytes"] + offsets[j] - offsets[i] > BLOCK_BYTES:
                    yield from finish()
                stream, size = _stream(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                grams, words, tokens = _events(stream, size)
                state["ids"].append(batch.column(0).slice(i, j - i))
                state["held"].append(flags[i:j])
                state["sizes"].append(size)
                state["stream"].append(stream)
                state["bytes"] += int(offsets[j] - offsets[i])
                for what, keys, each in ((_GRAM, grams, size), (_WORD, words, tokens)):
                    state[what].append(_tally(keys, ~np.repeat(flags[i:j], each)))
                    if len(state[what]) > 8:
                        state[what] = [_counted(state[what])]
            common.give_back()
        if state["ids"]:
            yield from finish()
            common.give_back()

    rows = docs.select(F.col(id_col).alias("id"), held_out.alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"block long, kind int, slot int, ids array<{kind}>, held_out array<boolean>, "
                                "sizes array<long>, blob binary, keys binary, counts binary")


def _arrays(column, dtype=np.int64) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype) for x in column.to_pylist()]


def _binary(parts: list[np.ndarray]) -> pa.Array:
    return pa.array([p.tobytes() for p in parts], pa.binary())


def _word_totals(rows: pa.Table) -> pa.Table:
    """The corpus count of every word of a slot, for each block that has it; the first row also
    has the slot's training tokens and distinct training words."""
    keys = _arrays(rows.column("keys"))
    distinct, total = _counted(list(zip(keys, _arrays(rows.column("counts")))))
    values = [total[np.searchsorted(distinct, k)].astype(np.float64) for k in keys]
    first = [0] * (len(keys) - 1)
    return pa.table({"block": rows.column("block"), "kind": rows.column("kind"), "keys": rows.column("keys"),
                     "values": _binary(values), "tokens": pa.array([int(total.sum()), *first]),
                     "words": pa.array([int((total > 0).sum()), *first])})


def _np_log_gamma(x: np.ndarray) -> np.ndarray:
    y = x + 7
    product = x.copy()
    for i in range(1, 7):
        product *= x + i
    sq = y * y
    series = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * sq * y)
    return series + 1 / (1260 * sq * sq * y) - 1 / (1680 * sq * sq * sq * y) - np.log(product)


class _Subtrees:
    """The levels DEPTH to SPLIT of the nodes that some byte strings pass. A node's code is its
    context followed by its place among the decisions of a byte."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        context, symbol = keys >> 8, keys & 255
        k = np.arange(8)[:, None]
        code = (context << 8 | 1 << k | symbol >> (8 - k)).ravel()
        self.bit = (symbol >> (7 - k) & 1).ravel().astype(bool)
        n = np.tile(n, 8).astype(np.float64)
        self.codes, self.place = np.unique(code, return_inverse=True)
        n1 = np.bincount(self.place, weights=n * self.bit, minlength=len(self.codes))
        n0 = np.bincount(self.place, weights=n * ~self.bit, minlength=len(self.codes))
        weighted = self._kt(n0, n1)
        #: From DEPTH up: (KT probability of a 1, share of the KT estimate, place of the parent).
        self.levels = [((n1 + 0.5) / (n0 + n1 + 1), np.ones(len(n0)), None)]
        codes = self.codes
        for depth in range(DEPTH - 1, SPLIT - 1, -1):
            up, parent = np.unique((codes >> 8 & ((1 << 8 * depth) - 1)) << 8 | codes & 255, return_inverse=True)
            self.levels[-1] = (*self.levels[-1][:2], parent)
            n0, n1, below = (np.bincount(parent, weights=x, minlength=len(up)) for x in (n0, n1, weighted))
            own = self._kt(n0, n1)
            weighted = np.logaddexp(own, below) - math.log(2)
            with np.errstate(over="ignore"):
                share = 1 / (1 + np.exp(below - own))
            self.levels.append(((n1 + 0.5) / (n0 + n1 + 1), share, None))
            codes = up
        self.top, self.n0, self.n1, self.weighted = codes, n0, n1, weighted

    @staticmethod
    def _kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
        return _np_log_gamma(n0 + 0.5) + _np_log_gamma(n1 + 0.5) - _np_log_gamma(n0 + n1 + 1) - math.log(math.pi)

    def log10(self, done: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """log10 probability of each string's last byte, given for each node at depth SPLIT the
        probability mixed above it and the weight that is left."""
        for i, (kt, share, _) in enumerate(reversed(self.levels)):
            if i:
                parent = self.levels[len(self.levels) - 1 - i][2]
                done, rest = done[parent], rest[parent]
            done, rest = done + rest * share * kt, rest * (1 - share)
        p = done[self.place]
        return np.log10(np.where(self.bit, p, 1 - p)).reshape(8, -1).sum(axis=0)


def _subtree_tops(rows: pa.Table) -> pa.Table:
    """The nodes at depth SPLIT of a slot: counts and weighted log probability."""
    t = _Subtrees(*_counted(list(zip(_arrays(rows.column("keys")), _arrays(rows.column("counts"))))))
    return pa.table({"slot": pa.array(np.full(len(t.top), rows.column("slot")[0].as_py(), np.int32)), "code": t.top,
                     "ctx": t.top >> 8, "node": (t.top & 255).astype(np.int32), "n0": t.n0, "n1": t.n1, "weighted": t.weighted})


def _string_values(rows: pa.Table, above: pa.Table) -> pa.Table:
    """log10 probabilities of a slot's byte strings, for each block that has them."""
    keys = _arrays(rows.column("keys"))
    distinct, n = _counted(list(zip(keys, _arrays(rows.column("counts")))))
    t = _Subtrees(distinct, n)
    code = np.asarray(above.column("code").combine_chunks())
    order = np.argsort(code)[np.searchsorted(np.sort(code), t.top)]
    done, rest = (np.asarray(above.column(c).combine_chunks())[order] for c in ("done", "rest"))
    values = t.log10(done, rest)
    return pa.table({"block": rows.column("block"), "kind": rows.column("kind"), "keys": rows.column("keys"),
                     "values": _binary([values[np.searchsorted(distinct, k)] for k in keys])})


def log_gamma(x: Column) -> Column:
    """Natural logarithm of the gamma function for x >= 0.5 (Stirling's series at x + 7)."""
    y = x + 7
    product = x
    for i in range(1, 7):
        product = product * (x + i)
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y)
    square = y * y
    return series + 1 / (1260 * square * square * y) - 1 / (1680 * square * square * square * y) - F.log(product)


def _log_kt(n0: Column, n1: Column) -> Column:
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1.0) - math.log(math.pi)


def _above(tops: DataFrame) -> DataFrame:
    """For each node at depth SPLIT (slot, code): the probability of a 1 mixed at depths below
    SPLIT, ``done``, and the weight that is left, ``rest``. ``tops`` has slot, code, ctx, node,
    n0, n1, weighted."""
    kt = (F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1.0)
    own = _log_kt(F.col("n0"), F.col("n1"))
    levels = [tops.select("ctx", "node", "n0", "n1", "weighted")]
    for d in range(SPLIT - 1, -1, -1):
        up = (levels[-1].groupBy(F.col("ctx").bitwiseAND((1 << 8 * d) - 1).alias("ctx"), "node")
              .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("weighted").alias("below"))
              .withColumn("own", own))
        gap = F.col("below") - F.col("own")
        mixed = F.greatest("own", "below") + F.log1p(F.exp(-F.abs(gap))) - math.log(2)
        levels.append(materialize(up.select("ctx", "node", "n0", "n1", mixed.alias("weighted"),
                                            (1 / (1 + F.exp(gap))).alias("share"), kt.alias("kt")), "ctw-level"))
    path = levels[SPLIT].select("ctx", "node", (F.col("share") * F.col("kt")).alias("done"), (1 - F.col("share")).alias("rest"))
    for d in range(1, SPLIT + 1):
        here = tops if d == SPLIT else levels[SPLIT - d]
        here = here.withColumn("up", F.col("ctx").bitwiseAND((1 << 8 * (d - 1)) - 1))
        joined = here.join(path.select(F.col("ctx").alias("up"), "node", "done", "rest"), ["up", "node"])
        path = joined.select("slot", "code", "done", "rest") if d == SPLIT else joined.select(
            "ctx", "node", (F.col("done") + F.col("rest") * F.col("share") * F.col("kt")).alias("done"),
            (F.col("rest") * (1 - F.col("share"))).alias("rest"))
    return path.withColumnRenamed("slot", "slot_above")


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text has remainder 0 modulo 10 (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 10 == 0


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          held: Column | None = None) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte (code length of the modelled bytes).

    Null and empty texts are one token, the end. Rows with the same id or text are scored and
    learned from separately. Without training rows every byte costs eight bits."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    slots = SLOTS_EACH * int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = materialize(pack(docs, id_col, text_col, held_out(id_col) if held is None else held, slots), "ctw-blocks")
    arrays = packed.select("block", "kind", "slot", "keys", "counts")
    words = materialize(arrays.where(F.col("kind") == _WORD).groupBy("slot").applyInArrow(
        common.giving_back(_word_totals), "block long, kind int, keys binary, values binary, tokens long, words long"), "ctw-words")
    total = words.agg(F.sum("tokens").alias("n"), F.sum("words").alias("v")).first()
    n_train, vocabulary = int(total["n"] or 0), int(total["v"] or 0)
    grams = arrays.where(F.col("kind") == _GRAM)
    tops = materialize(grams.groupBy("slot").applyInArrow(
        common.giving_back(_subtree_tops), "slot int, code long, ctx long, node int, n0 double, n1 double, weighted double"), "ctw-tops")
    strings = grams.groupBy("slot").cogroup(_above(tops).groupBy("slot_above")).applyInArrow(
        common.giving_back(_string_values), "block long, kind int, keys binary, values binary")
    values = strings.union(words.select("block", "kind", "keys", "values")).select(
        F.col("block").alias("of"), "kind", "keys", "values")
    blocks = packed.where(F.col("kind") == _DOCS).select("block", "ids", "held_out", "sizes", "blob")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        what = np.asarray(right.column("kind").combine_chunks())
        tables = []
        for k in (_GRAM, _WORD):
            rows = right.filter(pa.array(what == k))
            keys = np.concatenate(_arrays(rows.column("keys")))
            vals = np.concatenate(_arrays(rows.column("values"), np.float64))
            order = np.argsort(keys, kind="stable")
            tables.append((keys[order], vals[order]))
        size = np.asarray(left.column("sizes").combine_chunks().flatten())
        begin = np.concatenate([[0], np.cumsum(size + DEPTH)])
        stream = np.frombuffer(pa.decompress(left.column("blob")[0].as_buffer(), int(begin[-1]), codec="zstd"), np.uint8)
        out = []
        for i, j in common.chunks(begin, CHUNK_BYTES):
            g, w, tokens = _events(stream[begin[i]:begin[j]], size[i:j])
            p = tables[0][1][np.searchsorted(tables[0][0], g)]
            c = tables[1][1][np.searchsorted(tables[1][0], w)]
            base = np.log10((c + ALPHA) / (n_train + ALPHA * (vocabulary + 1)))
            first_g, first_w = np.cumsum(size[i:j]) - size[i:j], np.cumsum(tokens) - tokens
            out.append((tokens, np.add.reduceat((c > 0).astype(np.int64), first_w), np.add.reduceat(base, first_w),
                        np.add.reduceat(p, first_g)))
        tokens, known, base, model = (np.concatenate(x) for x in zip(*out))
        return pa.table({
            "id": left.column("ids").combine_chunks().flatten(), "held_out": left.column("held_out").combine_chunks().flatten(),
            "n_tokens": tokens, "n_known": known, "train_tokens": np.full(len(tokens), n_train, np.int64),
            "base_score": base, "score": model, "bits_per_byte": -model * math.log2(10) / size})

    return (blocks.groupBy("block").cogroup(values.groupBy("of")).applyInArrow(
        common.giving_back(run), f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
             "base_score double, score double, bits_per_byte double").withColumnRenamed("id", id_col))


def op1_ctw_score(spark, sf_dir: str) -> DataFrame:
    """Every document scored by the model and by the word unigram."""
    return score(common.read(spark, sf_dir, "documents"))
