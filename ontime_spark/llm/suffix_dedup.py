"""Repeated byte strings by a distributed difference cover (operator 11).

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier (in a document before, or
before in the same one) is removed; what is earlier is decided on the input.

1. What is sorted. Each string of ``LENGTH`` bytes has one anchor, its 32-byte gram with the smallest
   hash; neighbouring strings with one anchor are a unit. A string whose anchor occurs once is unique.
   Equal units are one sort item, the earliest stands for all (the rest repeat it), so a group of
   copies costs one item however large it is. Units whose anchor has no other neighbourhood are done;
   what is left, with the bytes its strings reach into, are stretches, packed into blocks.
2. Sampled triples. In a stretch the places 0, 1, 4, 14 and 16 modulo 21 are sampled; any two places
   reach two sampled ones by one shift below 21. The triple of 7-byte characters at a sampled place
   (21 bytes) gets a name, its rank in the order of all triples.
3. Recursion on names. The triple of names 0, 21 and 42 further (63 bytes) is named in the same way.
   A triple that occurs once is in no repeated string and is discarded in both rounds.
4. Merge. The sampled suffixes of one name are sorted by the bytes after it, and neighbours compared:
   the common prefix tells how far they are equal. The remaining suffixes, up to 20 before a sampled
   one, are ordered by the bytes before it and its rank; of each class of equal strings all but the
   earliest are repeated.

Names need one entry of each block for a triple, so that equal triples are aggregated before they
move; they meet in buckets by hash, sorted inside a bucket (bucket, then bytes, is an order that
brings equal prefixes together, which is all that is asked of it). Blocks settle their own classes
first and send the earliest of each; strings under a name with more than ``HOT`` places go to
buckets of their own. Bytes decide in the sort; hashes only choose anchors and tell units apart (128 bits).

Ids are integers; a null id comes before all others. Rows that agree in id and text are one document
and have one result; different texts of one id are ordered by a hash of the text. Null and empty texts
have no bytes; texts shorter than ``LENGTH`` keep theirs. An empty table stays empty. Very long texts are
handled in pieces of 1 MB (the text itself is in one task). Other columns pass through."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ontime_spark.llm import common
from ontime_spark.session import mark, materialize, release

LENGTH = 100
#: Bytes of an anchor.
GRAM = 32
#: A difference cover: every difference modulo ``PERIOD`` is one of two of its places.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)
CHAR = PERIOD // 3
NAMED = 3 * PERIOD
#: Bytes of text in an array step, in a block of stretches, and bytes of stretches for each bucket.
PIECE, BLOCK, BUCKET = 1 << 20, 2 << 20, 1 << 20
#: Places of a name from which on its strings are spread over all buckets.
HOT = 50_000

_META = np.dtype([("id", "<i8"), ("version", "<i4"), ("start", "<i8"), ("size", "<i4")])
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_ODD), -1, 1 << 64))
_back = np.ones(1, np.uint64)


def _back_powers(n: int) -> np.ndarray:
    """Inverses of ``common.powers``."""
    global _back
    if len(_back) < n:
        _back = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(max(n, 1 << 16), _BACK, np.uint64))])
    return _back


def _window_min(v: np.ndarray, width: int) -> np.ndarray:
    have, out = 1, v
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[:len(out) - (width - have)], out[width - have:]) if width > have else out


# --- units ---------------------------------------------------------------------------------------

def _pieces(texts, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(documents, where in them, bytes, offsets) of steps of bounded size; a long text comes in
    several, which overlap by a string's length."""
    data, offsets = common.utf8(texts)
    for i, j in common.chunks(offsets, PIECE):
        size = int(offsets[j] - offsets[i])
        if j == i + 1 and size > PIECE + length:
            for a in range(0, size - length + 1, PIECE):
                part = data[offsets[i] + a:min(offsets[i] + a + PIECE + length - 1, offsets[j])]
                yield np.array([i]), np.array([a]), part, np.array([0, len(part)])
        else:
            yield np.arange(i, j), np.zeros(j - i, np.int64), data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]


def units_of(part: np.ndarray, offsets: np.ndarray, length: int):
    """(document, first string, number of strings, hash of the anchor, hash of all bytes) of the units."""
    n = len(part) - length + 1
    if n < 1:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(common._BYTE_CODE[part] * common.powers(len(part))[:len(part)])])
    back = _back_powers(len(part))
    gram = common.mix64((total[GRAM:] - total[:-GRAM]) * back[:len(total) - GRAM])
    bits = np.uint64(len(gram).bit_length())
    # The leftmost of the smallest: the place breaks ties.
    low = _window_min(gram >> bits << bits | np.arange(len(gram), dtype=np.uint64), length - GRAM + 1)
    anchor = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    for end in offsets[1:-1].tolist():
        anchor[max(0, end - length + 1):end] = -1
    cut = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
    first = np.concatenate([[0], cut])
    many = np.diff(np.concatenate([first, [n]]))
    inside = anchor[first] >= 0
    first, many = first[inside], many[inside]
    doc = np.searchsorted(offsets, first, "right") - 1
    whole = common.mix64((total[first + many + length - 1] - total[first]) * back[first] + many.astype(np.uint64))
    return doc, first - offsets[doc], many, gram[anchor[first]], whole


def _units(docs: DataFrame, length: int, anchors_only: bool) -> DataFrame:
    """h (anchor), k (whole), id, version, at (first string * 256 + strings - 1) of the units of ``docs``
    (id, version, text), and whether the anchor was seen twice in the array step; or h alone, each
    once for an array step with ``n``, its count."""
    def anchors(batches):
        for batch in batches:
            for _, _, part, off in _pieces(batch.column(2), length):
                h, n = np.unique(units_of(part, off, length)[3], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])

    def units(batches):
        for batch in batches:
            ids, versions = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for docs_, begin, part, off in _pieces(batch.column(2), length):
                d, first, many, h, k = units_of(part, off, length)
                at = (first + begin[d]) * 256 + many - 1
                d = docs_[d]
                _, which, n = np.unique(h, return_inverse=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(k.view(np.int64)), pa.array(ids[d]), pa.array(versions[d]),
                                                  pa.array(at), pa.array(n[which] > 1)], ["h", "k", "id", "version", "at", "seen"])

    if anchors_only:
        return docs.mapInArrow(anchors, "h long, n long")
    return docs.mapInArrow(units, "h long, k long, id long, version int, at long, seen boolean")


# --- blocks of stretches -------------------------------------------------------------------------

_ROW = "block long, bucket long, a binary, b binary"


def _row(block: int, bucket: int, a: np.ndarray | bytes, b: np.ndarray | bytes) -> tuple:
    return block, bucket, bytes(a) if isinstance(a, bytes) else a.tobytes(), bytes(b) if isinstance(b, bytes) else b.tobytes()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["block", "bucket", "a", "b"])


def _stretches(lists, data: np.ndarray, offsets: np.ndarray, length: int):
    """(document, start, end) as places in ``data``: unions of the units of each document with the
    bytes that their strings reach into, cut into pieces of at most ``PIECE`` strings."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    at = lists.flatten().to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    lo = offsets[doc] + (at >> 8)
    hi = lo + (at & 255) + 1
    order = np.argsort(lo, kind="stable")
    lo, hi, doc = lo[order], np.maximum.accumulate(hi[order]), doc[order]
    new = np.ones(len(lo), bool)
    # A gap that is shorter than the bytes a second stretch would repeat is taken along.
    new[1:] = (doc[1:] != doc[:-1]) | (lo[1:] >= hi[:-1] + length - 1)
    begin = np.flatnonzero(new)
    last = np.concatenate([begin[1:], [len(lo)]]) - 1
    for d, s, e in zip(doc[begin].tolist(), lo[begin].tolist(), hi[last].tolist()):
        for a in range(s, e, PIECE):
            yield d, a, min(a + PIECE, e) + length - 1


def _blocks(rows: DataFrame, length: int) -> DataFrame:
    """Blocks of the stretches of ``rows`` (id, version, text, ats)."""
    def run(batches):
        meta: list[tuple] = []
        body: list[bytes] = []
        held = 0
        for batch in batches:
            ids, versions = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            data, offsets = common.utf8(batch.column(2))
            for d, s, e in _stretches(batch.column(3), data, offsets, length):
                meta.append((ids[d], versions[d], s - int(offsets[d]), e - s))
                body.append(data[s:e].tobytes())
                held += e - s
                if held >= BLOCK:
                    yield _batch([_row(0, -1, np.array(meta, _META), b"".join(body))])
                    meta, body, held = [], [], 0
        if held:
            yield _batch([_row(0, -1, np.array(meta, _META), b"".join(body))])

    blocks = rows.mapInArrow(run, _ROW)
    return blocks.select(F.monotonically_increasing_id().alias("block"), "bucket", "a", "b")


class _Block:
    """The arrays of a block: bytes, and for each place its stretch and place in it."""

    def __init__(self, a: bytes, b: bytes):
        self.meta = np.frombuffer(a, _META)
        self.body = np.frombuffer(b, np.uint8)
        self.size = self.meta["size"].astype(np.int64)
        self.base = np.cumsum(self.size) - self.size

    def sampled(self, reach: int) -> np.ndarray:
        """The sampled places that have ``reach`` bytes left in their stretch."""
        local = np.arange(len(self.body)) - np.repeat(self.base, self.size)
        cover = np.zeros(PERIOD, bool)
        cover[list(COVER)] = True
        return np.flatnonzero(cover[local % PERIOD] & (local + reach <= np.repeat(self.size, self.size)))

    def owner(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.base, at, "right") - 1


# --- names ---------------------------------------------------------------------------------------

def _grouped(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, whether a new key begins, number of the key in order) of the sorted rows."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        s = c[order]
        new[1:] |= s[1:] != s[:-1]
    return order, new, np.cumsum(new) - 1


def _bucket(columns: list[np.ndarray], buckets: int) -> np.ndarray:
    f = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        f = common.mix64(f * _ODD + c)
    return (f % np.uint64(buckets)).astype(np.int64)


class _Distinct:
    """The distinct triples of a block by bucket and order, their counts, and the number of each
    place's triple among them."""

    def __init__(self, columns: list[np.ndarray], buckets: int):
        order, new, key = _grouped(columns)
        begin = np.flatnonzero(new)
        count = np.diff(np.concatenate([begin, [len(order)]]))
        distinct = [c[order][begin] for c in columns]
        bucket = _bucket(distinct, buckets)
        by = np.argsort(bucket, kind="stable")
        number = np.empty(len(by), np.uint32)
        number[by] = np.arange(len(by), dtype=np.uint32)
        self.of = np.empty(len(order), np.uint32)
        self.of[order] = number[key]
        self.keys, self.count, self.bucket = np.stack(distinct, 1)[by], count[by].astype(np.uint32), bucket[by]

    def rows(self, block: int) -> list[tuple]:
        return [_row(block, int(self.bucket[i]), self.keys[i:j], self.count[i:j]) for i, j in _cuts(self.bucket)]


def _cuts(values: np.ndarray) -> list[tuple[int, int]]:
    """(first, last + 1) of the rows of equal values."""
    if not len(values):
        return []
    at = np.flatnonzero(values[1:] != values[:-1]) + 1
    return list(zip([0, *at.tolist()], [*at.tolist(), len(values)]))


def _names(sent: DataFrame, buckets: int, turn: int) -> DataFrame:
    """The ranks of the triples of each row of ``sent``: (bucket, place in its order), 0 for a triple
    that occurs once, with the highest bit set for one of more than ``HOT`` places. ``b`` is the
    round."""
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        keys = [np.frombuffer(x, np.uint64).reshape(-1, 3) for x in table.column("a").to_pylist()]
        counts = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("b").to_pylist()]).astype(np.int64)
        every = np.concatenate(keys)
        order, new, key = _grouped([every[:, i] for i in range(3)])
        places = np.add.reduceat(counts[order], np.flatnonzero(new))
        name = np.uint64(bucket << 32) + np.arange(1, len(places) + 1, dtype=np.uint64)
        name[places > HOT] |= np.uint64(1 << 63)
        name[places < 2] = 0
        out = np.empty(len(every), np.uint64)
        out[order] = name[key]
        parts = np.split(out, np.cumsum([len(k) for k in keys])[:-1])
        return pa.Table.from_arrays([table.column("block").cast(pa.int64()), table.column("bucket").cast(pa.int64()),
                                     pa.array([p.tobytes() for p in parts], pa.binary()), pa.array([bytes([turn])] * len(parts), pa.binary())],
                                    ["block", "bucket", "a", "b"])

    return sent.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(run, _ROW)


def _characters(block: _Block) -> tuple[np.ndarray, list[np.ndarray]]:
    """First round: the sampled places and their triples of 7-byte characters."""
    at = block.sampled(PERIOD)
    columns = []
    for c in range(3):
        char = np.zeros(len(at), np.uint64)
        for i in range(CHAR):
            char = char << np.uint64(8) | block.body[at + (c * CHAR + i)]
        columns.append(char)
    return at, columns


def _named(block: _Block, at: np.ndarray, name: np.ndarray, length: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Second round: the places with a string before them, and their triples of names; those
    with a discarded name are left out."""
    every = np.zeros(len(block.body) + NAMED, np.uint64)
    every[at] = name
    o = block.owner(at)
    at = at[(name > 0) & (at - block.base[o] + length - PERIOD + 1 <= block.size[o])]
    columns = [every[at + i * PERIOD] for i in range(3)]
    full = (columns[1] > 0) & (columns[2] > 0)
    return at[full], [c[full] for c in columns]


def _answered(table: pa.Table) -> tuple[int, _Block, list[np.ndarray]]:
    """(number, block, names of each round) from a block's row and the answers to it."""
    rows = sorted(zip(table.column("bucket").to_pylist(), table.column("a").to_pylist(), table.column("b").to_pylist()), key=lambda r: r[0])
    names = [np.frombuffer(b"".join(a for bucket, a, b in rows if bucket >= 0 and b[0] == turn), np.uint64) for turn in (1, 2)]
    return table.column("block")[0].as_py(), _Block(*rows[0][1:]), names


def _triples(blocks: DataFrame, buckets: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for number, a, b in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                rows = _Distinct(_characters(_Block(a, b))[1], buckets).rows(number)
                if rows:
                    yield _batch(rows)

    return blocks.mapInArrow(run, _ROW)


def _triples_of_names(blocks: DataFrame, names: DataFrame, buckets: int, length: int) -> DataFrame:
    """The triples of the second round. A block makes its triples again, in the same order, rather
    than keep them: its text is a fraction of them."""
    def run(table: pa.Table) -> pa.Table:
        number, block, names = _answered(table)
        at, columns = _characters(block)
        columns = _named(block, at, names[0][_Distinct(columns, buckets).of], length)[1]
        return pa.Table.from_batches([_batch(_Distinct(columns, buckets).rows(number))])

    return blocks.unionByName(names).groupBy("block").applyInArrow(run, _ROW)


# --- merge ---------------------------------------------------------------------------------------

def _record(length: int) -> np.dtype:
    """A sampled suffix: its name, the bytes before it and after its name, the shifts (bits) at which
    a string before it is open, and its document and place."""
    return np.dtype([("name", "<u8"), ("left", "u1", PERIOD - 1), ("right", "u1", length - NAMED), ("open", "<u4"),
                     ("id", "<i8"), ("version", "<i4"), ("at", "<i8")])


def _words_of(raw: np.ndarray) -> list[np.ndarray]:
    """Rows of bytes as big-endian 64-bit columns, first column first."""
    pad = np.zeros((len(raw), -(-raw.shape[1] // 8) * 8), np.uint8)
    pad[:, :raw.shape[1]] = raw
    w = pad.view(">u8").astype(np.uint64)
    return [w[:, i] for i in range(w.shape[1])]


def _common(raw: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row, in order, with the one before."""
    same = raw[order[1:]] == raw[order[:-1]]
    return np.where(same.all(1), raw.shape[1], same.argmin(1))


def repeated_shifts(records: np.ndarray) -> np.ndarray:
    """For each record the shifts (bits) at which the string before it also starts earlier among
    the records."""
    hit = np.zeros(len(records), np.uint32)
    if len(records) < 2:
        return hit
    records_order, new, number = _grouped([records["id"].view(np.uint64) ^ np.uint64(1 << 63), records["version"].astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63),
                                           records["at"].view(np.uint64)])
    # In the order of documents and places; equal places (of equal rows) have one number.
    records = records[records_order]
    right, left = np.ascontiguousarray(records["right"]), np.ascontiguousarray(records["left"][:, ::-1])
    width = right.shape[1]
    # Suffixes in order, and how far neighbours of one name are equal.
    order = np.lexsort([*_words_of(right)[::-1], records["name"]])
    after = _common(right, order)
    after[records["name"][order[1:]] != records["name"][order[:-1]]] = -1
    before_order = np.lexsort(_words_of(left)[::-1])
    before = _common(left, before_order)
    found = np.zeros(len(records), np.uint32)
    rank, rank_before = np.zeros(len(records), np.uint64), np.zeros(len(records), np.uint64)
    for shift in range(PERIOD):
        mine = np.flatnonzero(records["open"] >> np.uint32(shift) & np.uint32(1))
        if len(mine) < 2:
            continue
        rank[order[1:]] = np.cumsum(after < width - shift)
        rank_before[before_order[1:]] = np.cumsum(before < shift)
        key = rank[mine] << np.uint64(32) | rank_before[mine]
        by = np.argsort(key, kind="stable")
        first = np.ones(len(by), bool)
        first[1:] = key[by][1:] != key[by][:-1]
        earliest = number[mine[by]][np.flatnonzero(first)][np.cumsum(first) - 1]
        found[mine[by][number[mine[by]] != earliest]] |= np.uint32(1 << shift)
    hit[records_order] = found
    return hit


def _ranges(records: np.ndarray, shifts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """id, version, at (first string * 256 + strings - 1) of the strings at the shifts."""
    ids, versions, ats = [], [], []
    left = shifts.astype(np.int64)
    here = np.flatnonzero(left)
    while len(here):
        m = left[here]
        low = m & -m
        rest = m + low
        end = rest & -rest
        lowest, above = np.log2(low).astype(np.int64), np.log2(end).astype(np.int64)
        ids.append(records["id"][here])
        versions.append(records["version"][here])
        ats.append((records["at"][here] - above + 1) * 256 + (above - lowest) - 1)
        left[here] = rest ^ end
        here = here[left[here] > 0]
    if not ids:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.concatenate(ids), np.concatenate(versions), np.concatenate(ats)


_HIT = np.dtype([("id", "<i8"), ("version", "<i4"), ("at", "<i8")])


def _suffixes(blocks: DataFrame, names: DataFrame, buckets: int, length: int) -> DataFrame:
    """The sampled suffixes for each bucket of names, after each block has settled its own classes
    (what it found is passed along with them)."""
    record = _record(length)

    def run(table: pa.Table) -> pa.Table:
        number, block, names = _answered(table)
        at, columns = _characters(block)
        at, columns = _named(block, at, names[0][_Distinct(columns, buckets).of], length)
        name = names[1][_Distinct(columns, buckets).of]
        at, name = at[name > 0], name[name > 0]
        o = block.owner(at)
        local, size = at - block.base[o], block.size[o]
        records = np.zeros(len(at), record)
        records["name"] = name
        pad = np.concatenate([np.zeros(PERIOD, np.uint8), block.body, np.zeros(length, np.uint8)])
        records["left"] = pad[at[:, None] + np.arange(1, PERIOD)]
        records["right"] = pad[at[:, None] + np.arange(PERIOD + NAMED, PERIOD + length)]
        most = np.minimum(local, PERIOD - 1)
        least = np.maximum(local + length - size, 0)
        records["open"] = np.where(most >= least, (1 << (most + 1)) - (1 << least), 0)
        for f in ("id", "version"):
            records[f] = block.meta[f][o]
        records["at"] = block.meta["start"][o] + local
        order, new, key = _grouped([name])
        several = np.zeros(len(at), bool)
        several[order] = (np.bincount(key, minlength=1) > 1)[key] if len(key) else False
        several = np.flatnonzero(several)
        shifts = np.zeros(len(at), np.uint32)
        shifts[several] = repeated_shifts(records[several])
        found = np.zeros(0, _HIT)
        if shifts.any():
            columns = _ranges(records, shifts)
            found = np.zeros(len(columns[0]), _HIT)
            for f, c in zip(_HIT.names, columns):
                found[f] = c
        records["open"] &= ~shifts
        going = [records[(records["open"] > 0) & (name >> np.uint64(63) == 0)]]
        goals = [_bucket([going[0]["name"]], buckets)]
        hot = np.flatnonzero((records["open"] > 0) & (name >> np.uint64(63) > 0))
        if len(hot):
            # By the whole string: equal strings meet, others of the name don't.
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(common._BYTE_CODE[block.body] * common.powers(len(block.body))[:len(block.body)])])
            back = _back_powers(len(block.body))
            for shift in range(PERIOD):
                mine = hot[records["open"][hot] >> np.uint32(shift) & np.uint32(1) > 0]
                string = at[mine] - shift
                one = records[mine]
                one["open"] = 1 << shift
                going.append(one)
                goals.append(_bucket([(total[string + length] - total[string]) * back[string]], buckets))
        records, goal = np.concatenate(going), np.concatenate(goals)
        order = np.argsort(goal, kind="stable")
        records, goal = records[order], goal[order]
        rows = [_row(number, int(goal[i]), records[i:j], b"") for i, j in _cuts(goal)]
        if len(found):
            rows.append(_row(number, number % buckets, b"", found))
        return pa.Table.from_batches([_batch(rows)])

    return blocks.unionByName(names).groupBy("block").applyInArrow(run, _ROW)


def _merged(suffixes: DataFrame, buckets: int, length: int) -> DataFrame:
    """id, version, at of the strings that also start earlier."""
    record = _record(length)

    def run(table: pa.Table) -> pa.Table:
        records = np.frombuffer(b"".join(table.column("a").to_pylist()), record)
        order, new, key = _grouped([records["name"]])
        several = np.zeros(len(records), bool)
        several[order] = (np.bincount(key, minlength=1) > 1)[key] if len(key) else False
        records = records[several]
        ids, versions, ats = _ranges(records, repeated_shifts(records))
        found = np.frombuffer(b"".join(table.column("b").to_pylist()), _HIT)
        return pa.Table.from_arrays([pa.array(np.concatenate([ids, found["id"]])), pa.array(np.concatenate([versions, found["version"]])),
                                     pa.array(np.concatenate([ats, found["at"]]))], ["id", "version", "at"])

    return suffixes.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(run, "id long, version int, at long")


# --- the operator --------------------------------------------------------------------------------

def _key(id_col: str, text: Column) -> list[Column]:
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"), F.hash(text).alias("version")]


def repeated_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """id, version, at of the strings of ``length`` bytes that also start earlier, a few ranges (first
    string * 256 + strings - 1) for each repeated stretch."""
    if not NAMED + PERIOD <= length <= 255:
        raise ValueError(f"length must be from {NAMED + PERIOD} to 255")
    text = F.col(text_col).cast("string")
    rows = docs.select(*_key(id_col, text), text.alias("text")).where(F.octet_length("text") >= length)
    twice = _units(rows, length, True).groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select(F.col("h").alias("twice"))
    # A frequent anchor is seen twice in its step and needs no partner: its rows are spread.
    units = _units(rows, length, False).withColumn("to", F.when(F.col("seen"), F.xxhash64("id", "at")).otherwise(F.col("h")))
    units = units.join(twice, (F.col("to") == F.col("twice")) & ~F.col("seen"), "left").where("seen OR twice IS NOT NULL")
    units = materialize(units.select("h", "k", "id", "version", "at"), "units")
    firsts = materialize(units.groupBy("h", "k").agg(F.min(F.struct("id", "version", "at")).alias("first"), F.count(F.lit(1)).alias("n")), "first-units")
    own = F.struct("id", "version", "at")
    repeated = units.join(firsts.where("n > 1").select("h", "k", "first"), ["h", "k"]).where(own != F.col("first")).select("id", "version", "at")
    kinds = firsts.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    open_units = firsts.join(kinds, "h", "left_semi").select("first.*").groupBy("id", "version").agg(F.collect_list("at").alias("ats"))
    blocks = materialize(_blocks(rows.join(open_units, ["id", "version"]).select("id", "version", "text", "ats"), length), "stretches")
    size = blocks.agg(F.sum(F.octet_length("b"))).first()[0] or 0
    buckets = 1 + size // BUCKET
    names = materialize(_names(_triples(blocks, buckets), buckets, 1), "names")
    both = names.unionByName(materialize(_names(_triples_of_names(blocks, names, buckets, length), buckets, 2), "names-of-names"))
    merged = _merged(_suffixes(blocks, both, buckets, length), buckets, length)
    return repeated.unionByName(merged)


_FIELDS = "n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary"


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> tuple[DataFrame, str]:
    """(``docs`` with a struct column, its name): n_bytes, n_removed, the removed spans and the bytes that
    are kept (which need not be whole characters)."""
    text = F.col(text_col).cast("string")
    since = mark()
    found = repeated_strings(docs, id_col, text_col, length)
    steps = mark()
    ats = materialize(found, "repeats").groupBy("id", "version").agg(F.collect_list("at").alias("ats"))
    release(docs.sparkSession, since, steps)  # nothing reads the tables of the steps any more
    own = {c: common.fresh(docs.columns, f"_{c}") for c in ("id", "version", "ats", "key", "hash")}
    ats = ats.select(*[F.col(c).alias(own[c]) for c in ("id", "version", "ats")])
    key, version = _key(id_col, text)
    joined = docs.withColumns({own["key"]: key, own["hash"]: version})
    joined = joined.join(ats, (F.col(own["key"]) == F.col(own["id"])) & (F.col(own["hash"]) == F.col(own["version"])), "left")
    joined = joined.select(*[F.col(f"`{c}`") for c in docs.columns], F.coalesce(own["ats"], F.array().cast("array<long>")).alias(own["ats"]))
    name = common.fresh(joined.columns, "_repeats")
    at_text, at_list = docs.columns.index(text_col), len(docs.columns)
    schema = StructType(list(docs.schema.fields)).add(name, StructType.fromDDL(_FIELDS))

    def run(batches):
        for batch in batches:
            data, offsets = common.utf8(batch.column(at_text).cast(pa.string()))
            lists = batch.column(at_list)
            flat, bounds = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(pa.compute.list_value_length(lists).to_numpy())])
            removed, spans, kept = [], [], []
            for d in range(len(offsets) - 1):
                at = np.sort(flat[bounds[d]:bounds[d + 1]])
                raw = data[offsets[d]:offsets[d + 1]]
                if not len(at):
                    removed.append(0)
                    spans.append([])
                    kept.append(raw.tobytes())
                    continue
                lo, hi = at >> 8, np.maximum.accumulate((at >> 8) + (at & 255) + length)
                new = np.flatnonzero(np.concatenate([[True], lo[1:] > hi[:-1]]))
                lo, hi = lo[new], hi[np.concatenate([new[1:], [len(hi)]]) - 1]
                removed.append(int((hi - lo).sum()))
                spans.append([{"start": s, "end": e} for s, e in zip(lo.tolist(), hi.tolist())])
                ends = np.concatenate([[0], hi])
                kept.append(b"".join(raw[s:e].tobytes() for s, e in zip(ends.tolist(), [*lo.tolist(), len(raw)])))
            struct = pa.StructArray.from_arrays(
                [pa.array(np.diff(offsets)), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                ["n_bytes", "n_removed", "spans", "kept"])
            yield pa.RecordBatch.from_arrays([*batch.columns[:at_list], struct], schema=None, names=[*batch.schema.names[:at_list], name])

    return joined.mapInArrow(run, schema), name


def op11_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document with what its repeated strings of 100 bytes take away."""
    out, r = remove_repeats(common.read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col(f"{r}.n_bytes").alias("n_bytes"), F.col(f"{r}.n_removed").alias("n_removed"),
                      F.size(f"{r}.spans").cast("long").alias("n_spans"), F.sha2(F.col(f"{r}.kept"), 256).alias("kept_sha256"))
