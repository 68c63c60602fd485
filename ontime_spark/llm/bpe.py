"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue (operator 8).

Pre-tokens are merged lowest rank first, leftmost first. Candidate pairs wait in buckets, one per
merge rank, that hold positions of a linked list of tokens. A bitmap of two levels tells which
buckets are not empty: the top level has a bit for each 64 ranks, so the next rank is two
find-first-set steps away whatever the length of the pre-token. Long pre-tokens have a queue of
their own; the short ones of a chunk of text share one (``merge_many``). A merge does not search the
queue for the pairs it destroys; entries whose pair has changed are skipped when they come up.
"""

from __future__ import annotations

import base64
import hashlib
import importlib.util
import re
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime_spark.llm import common

#: Where the public vocabularies are (a parameter of every operator below).
TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
#: The published pre-token pattern of these vocabularies (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pre-tokens whose ids a worker remembers; the rest are merged again when they come up.
MEMORY = 150_000
#: Bytes of the longest pre-token that shares a queue with others; a longer one has its own.
QUEUE_BYTES = 64
#: Bytes of text whose unknown pre-tokens share a queue.
CHUNK_BYTES = 2 << 20


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a rank file (base64 token, rank on each line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    get = ranks.get
    end = list(range(1, n + 1))    # end[i]: where the token that begins at i ends
    before = list(range(-1, n))    # before[i]: where the token before the one at i begins
    pair = [-1] * n                # pair[i]: rank of the pair that begins at i, -1 if none
    top = 0
    leaf: dict[int, int] = {}
    bucket: dict[int, list[int]] = {}
    for i in range(n - 1):
        r = get(piece[i:i + 2])
        if r is not None:
            pair[i] = r
            if r in bucket:
                bucket[r].append(i)
            else:
                bucket[r] = [i]
                w = r >> 6
                leaf[w] = leaf.get(w, 0) | 1 << (r & 63)
                top |= 1 << w
    while top:
        w = (top & -top).bit_length() - 1
        bits = leaf[w]
        r = w << 6 | (bits & -bits).bit_length() - 1
        waiting = bucket[r]
        i = heappop(waiting)
        if not waiting:
            del bucket[r]
            leaf[w] = bits = bits & (bits - 1)
            if not bits:
                top ^= 1 << w
        if pair[i] != r:
            continue
        j = end[i]
        e = end[i] = end[j]
        pair[j] = -1
        changed = []
        if e < n:
            before[e] = i
            changed.append((i, piece[i:end[e]]))
        else:
            pair[i] = -1
        p = before[i]
        if p >= 0:
            changed.append((p, piece[p:e]))
        for k, text in changed:
            q = get(text, -1)
            if q == pair[k] and k != i:
                continue
            pair[k] = q
            if q >= 0:
                if q in bucket:
                    heappush(bucket[q], k)
                else:
                    bucket[q] = [k]
                    w = q >> 6
                    leaf[w] = leaf.get(w, 0) | 1 << (q & 63)
                    top |= 1 << w
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class PairTable:
    """Rank of every pair of tokens that merge, as a hash table of numpy arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for token, r in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 20 | right)
                    values.append(r)
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        key, value = np.array(keys, np.int64), np.array(values, np.int32)
        slot = self._slot(key)
        while len(key):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = key[free]  # of keys with one slot the last stays
            placed = self.keys[slot] == key
            self.values[slot[placed]] = value[placed]
            key, value, slot = key[~placed], value[~placed], (slot[~placed] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs, -1 for those that don't merge."""
        key = left.astype(np.int64) << 20 | right
        slot = self._slot(key)
        at = self.keys[slot]
        out = np.where(at == key, self.values[slot], np.int32(-1))
        left_over = np.flatnonzero((at != key) & (at >= 0))
        while len(left_over):
            slot[left_over] = (slot[left_over] + 1) & ((1 << self.bits) - 1)
            at = self.keys[slot[left_over]]
            hit = at == key[left_over]
            out[left_over[hit]] = self.values[slot[left_over[hit]]]
            left_over = left_over[~hit & (at >= 0)]
        return out


def merge_many(pieces: list[bytes], pairs: PairTable, byte_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, count of each piece) of many short pre-tokens that share one rank queue.

    The linked lists of all pieces lie in one array. A step takes the bucket of the lowest rank
    and merges its leftmost valid position of each piece at once; further positions of a piece
    go back to the bucket. No merge touches another piece, so each piece sees its own merges in
    the order in which it would see them alone."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    n = int(first[-1])
    token = byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
    piece = np.repeat(np.arange(len(pieces)), sizes)
    after = np.arange(1, n + 1)
    before = np.arange(-1, n - 1)
    after[first[1:] - 1] = -1
    before[first[:-1]] = -1
    pair = np.full(n, -1, np.int32)
    inner = np.flatnonzero(after >= 0)
    pair[inner] = pairs.find(token[inner], token[inner + 1])
    alive = np.ones(n, bool)
    bucket: dict[int, list[np.ndarray]] = {}
    leaf: dict[int, int] = {}
    top = 0

    def push(where: np.ndarray, rank: np.ndarray) -> int:
        added = 0
        valid = rank >= 0
        where, rank = where[valid], rank[valid]
        if not len(where):
            return 0
        order = np.argsort(rank, kind="stable")
        where, rank = where[order], rank[order]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        lows = [0, *cuts.tolist()]
        for r, lo, hi in zip(rank[lows].tolist(), lows, [*lows[1:], len(where)]):
            if r in bucket:
                bucket[r].append(where[lo:hi])
            else:
                bucket[r] = [where[lo:hi]]
                w = r >> 6
                leaf[w] = leaf.get(w, 0) | 1 << (r & 63)
                added |= 1 << w
        return added

    top |= push(inner, pair[inner])
    while top:
        w = (top & -top).bit_length() - 1
        bits = leaf[w]
        r = w << 6 | (bits & -bits).bit_length() - 1
        waiting = bucket.pop(r)
        at = np.unique(np.concatenate(waiting)) if len(waiting) > 1 else waiting[0]
        at = at[pair[at] == r]
        if len(at) > 1:
            own = piece[at]
            lead = np.ones(len(at), bool)
            lead[1:] = own[1:] != own[:-1]
            rest = at[~lead]
            at = at[lead]
        else:
            rest = at[:0]
        if len(rest):
            bucket[r] = [rest]
        else:
            leaf[w] = bits = bits & (bits - 1)
            if not bits:
                top ^= 1 << w
        if not len(at):
            continue
        gone = after[at]
        new = after[gone]
        alive[gone] = False
        pair[gone] = -1
        pair[at] = -1
        token[at] = r
        after[at] = new
        right = at[new >= 0]
        new = new[new >= 0]
        before[new] = right
        q = pairs.find(token[right], token[new])
        pair[right] = q
        left = before[at]
        has = left >= 0
        left = left[has]
        t = pairs.find(token[left], token[at[has]])
        pair[left] = t
        top |= push(np.concatenate([right, left]), np.concatenate([q, t]))
    kept = np.flatnonzero(alive)
    return token[kept], np.bincount(piece[kept], minlength=len(pieces))


#: Characters for which the two regular-expression libraries may class a text differently
#: (separators, numerals that are no digits, everything beyond Latin).
_RARE = re.compile("[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbe\u0250-\U0010ffff]").search
#: The public pattern for texts without such characters, in the faster library's terms.
_LATIN = re.compile(r"""'(?:[stmd]|re|ve|ll)| ?[^\W\d_]++| ?\d++| ?(?:[^\s\w]|_)++|\s+(?!\S)|\s+""").findall


class Encoder:
    """Encodes and decodes with one vocabulary; remembers the ids of short pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.exact = regex.compile(pattern).findall
        self.latin = _LATIN if pattern == PATTERN else self.exact
        self.tokens = {str(r): t for t, r in ranks.items()}
        self.known: dict[str, str] = {}
        self.pairs = PairTable(ranks)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)

    def _learn(self, new: list[str], extra: dict[str, str]) -> None:
        """Ids of the pieces ``new``, into ``known`` while there is room and else ``extra``."""
        raw = [p.encode() for p in new]
        short = [(p, b) for p, b in zip(new, raw) if len(b) <= QUEUE_BYTES]
        if short:
            ids, counts = merge_many([b for _, b in short], self.pairs, self.byte_ids)
            texts = list(map(str, ids.tolist()))
            at = 0
            room = MEMORY - len(self.known)
            for (p, _), c in zip(short, counts.tolist()):
                (self.known if room > 0 else extra)[p] = " ".join(texts[at:at + c])
                room -= 1
                at += c
        for p, b in zip(new, raw):
            if len(b) > QUEUE_BYTES:
                extra[p] = " ".join(map(str, merge(b, self.ranks)))

    def encode_texts(self, texts: list[str]) -> list[str]:
        """The ids of each text in decimal, joined by one space."""
        pieces = [(self.exact if _RARE(t) else self.latin)(t) for t in texts]
        extra: dict[str, str] = {}
        new: set[str] = set()
        for p in pieces:
            new.update(p)
        new.difference_update(self.known)
        if not new:
            return [" ".join(map(self.known.__getitem__, p)) for p in pieces]
        self._learn(sorted(new), extra)
        if not extra:
            return [" ".join(map(self.known.__getitem__, p)) for p in pieces]
        known = self.known
        return [" ".join([known[x] if x in known else extra[x] for x in p]) for p in pieces]

    def decode_bytes(self, ids: str) -> bytes:
        """The bytes of ids as ``encode_texts`` writes them."""
        return b"".join(map(self.tokens.__getitem__, ids.split(" "))) if ids else b""

    def chunks(self, texts):
        """(texts, their ids) of an Arrow column in steps of bounded size; null is empty."""
        _, offsets = common.utf8(texts)
        for i, j in common.chunks(offsets, CHUNK_BYTES):
            part = [t or "" for t in texts.slice(i, j - i).to_pylist()]
            yield part, self.encode_texts(part)


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The encoder of a vocabulary file, made once in a process."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(load_ranks(path), pattern)
    return _encoders[path, pattern]


def vocabulary(tokenizers: str = TOKENIZERS, name: str = VOCABULARY) -> tuple[str, str]:
    """(path of the vocabulary file, pre-token pattern) of the public tokenizers' folder, which
    every executor has."""
    spec = importlib.util.spec_from_file_location("public_tokenizers", f"{tokenizers}/__init__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module.path(name), module.PATTERN


def encode(docs: DataFrame, text_col: str = "text", tokenizers: str = TOKENIZERS,
           name: str = VOCABULARY) -> tuple[DataFrame, str]:
    """``docs`` plus a struct (its name is returned too): n_tokens, ids (array of int).

    Null and empty texts have no ids. Special-token strings in a text are ordinary text."""
    path, pattern = vocabulary(tokenizers, name)

    def run(texts):
        e = encoder(path, pattern)
        ids = [[int(x) for x in s.split(" ")] if s else []
               for _, done in e.chunks(texts) for s in done]
        return [pa.array([len(x) for x in ids], pa.int64()), pa.array(ids, pa.list_(pa.int32()))]

    return common.with_result(docs, text_col, "n_tokens: bigint, ids: array<int>", run)


def decode(encoded: DataFrame, ids_col: str = "ids", tokenizers: str = TOKENIZERS,
           name: str = VOCABULARY) -> tuple[DataFrame, str]:
    """``encoded`` plus a struct (its name is returned too) with ``bytes``, what the ids stand
    for. Null ids have no bytes."""
    path, pattern = vocabulary(tokenizers, name)

    def run(ids):
        e = encoder(path, pattern)
        return [pa.array([e.decode_bytes(" ".join(map(str, x or ()))) for x in ids.to_pylist()],
                         pa.binary())]

    return common.with_result(encoded, ids_col, "bytes: binary", run)


def round_trip(docs: DataFrame, text_col: str = "text", tokenizers: str = TOKENIZERS,
               name: str = VOCABULARY, keep_ids: bool = False) -> tuple[DataFrame, str]:
    """``docs`` plus a struct (its name is returned too): n_tokens, ids_sha256 (of the decimal
    ids joined by one space), decoded_sha256 (of the bytes that the ids decode to) and, if asked
    for, ids. Encodes and decodes in one pass, so that ids need not be written between."""
    path, pattern = vocabulary(tokenizers, name)

    def run(texts):
        e = encoder(path, pattern)
        n, ids_sha, decoded_sha, arrays = [], [], [], []
        for _, done in e.chunks(texts):
            for ids in done:
                n.append(ids.count(" ") + 1 if ids else 0)
                ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                decoded_sha.append(hashlib.sha256(e.decode_bytes(ids)).hexdigest())
                if keep_ids:
                    arrays.append(np.fromstring(ids, np.int32, sep=" "))
        out = [pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())]
        return out + ([pa.array(arrays, pa.list_(pa.int32()))] if keep_ids else [])

    fields = "n_tokens: bigint, ids_sha256: string, decoded_sha256: string" + ", ids: array<int>" * keep_ids
    return common.with_result(docs, text_col, fields, run)


def digest_columns(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document."""
    done, r = round_trip(docs.select("doc_id", "text"), **options)
    return done.select("doc_id", *[F.col(r)[c].alias(c) for c in ("n_tokens", "ids_sha256", "decoded_sha256")])


def op8_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded: token count and the two digests."""
    return digest_columns(common.read(spark, sf_dir, "documents"))
