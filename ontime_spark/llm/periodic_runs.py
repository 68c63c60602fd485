"""Periodic runs of words by multi-scale minimizers (operator 13).

A run is a stretch of words with smallest period q, at least three periods and ``MIN_WORDS`` long,
that cannot be extended with that period. Periods up to ``SHORT`` are found by direct scans: words
equal to the one q before, in an unbroken row. Longer periods are cut into scales, each a quarter
wider than the one before. In a scale with periods in (lo, hi]:

* grams of hi words are hashed; a gram is no shorter than the period, so inside a run of period q
  equal grams are a multiple of q apart (two periods that overlap this far would make a shorter one);
* of every 2 (lo + 1) - hi + 1 consecutive grams the smallest is kept: two such windows at distance q
  fit into three periods, and their minima are q apart;
* two kept grams that are equal, next to each other and at most hi apart seed the period, and the
  words themselves are compared to both sides of the seed.

So no run is missed, and nothing but hashes of some grams is compared for text without runs. A run
whose words have a divisor of its period as period is dropped (the shorter period's run is found
in its own scale). Texts are handled whole, many at a time as arrays; words are compared by 64-bit
hashes.

A null, empty or white-space text has no words and no run: ``start`` to ``exponent_milli`` are null,
``runs`` and ``collapsed`` are empty. Rows are independent, so repeated rows give equal results; ties
in the exponent go to the smallest start, then the smallest period. An empty table stays empty, and
other columns pass through, whatever their names."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime_spark.llm import common

MIN_WORDS = 24
PERIODS = 3
#: Periods found by direct scans.
SHORT = 12

_STEP = 0x9E3779B97F4A7C15
_BACK = np.uint64(pow(_STEP, -1, 1 << 64))


def _back_powers(n: int) -> np.ndarray:
    out = np.full(n, _BACK, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out)


def _rows_of(true: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last + 1) of the unbroken rows in an ascending array of positions."""
    cut = np.flatnonzero(np.diff(true) != 1)
    return true[np.concatenate([[0], cut + 1])], true[np.concatenate([cut, [len(true) - 1]])] + 1


def _short(x: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(start, end, lag) of the stretches of lags up to ``SHORT``."""
    for q in range(1, min(SHORT, len(x) - 1) + 1):
        same = np.flatnonzero((x[q:] == x[:-q]) & (doc[q:] == doc[:-q]))
        if len(same):
            first, last = _rows_of(same)
            long = last - first + q >= max(MIN_WORDS, PERIODS * q)
            for s, e in zip(first[long].tolist(), last[long].tolist()):
                yield s, e + q, q


def scales(longest: int) -> Iterator[tuple[int, int]]:
    """(lo, hi) of the scales that texts of up to ``longest`` words need."""
    lo = SHORT
    while PERIODS * (lo + 1) <= longest:
        hi = lo + max(1, lo // 4)
        yield lo, hi
        lo = hi


def _window_min(v: np.ndarray, width: int) -> np.ndarray:
    have, out = 1, v
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[:len(out) - (width - have)], out[width - have:]) if width > have else out


def _seeds(x: np.ndarray, doc: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, lag) of neighbouring equal window minima, lags in (lo, hi], by lag and position."""
    none = np.zeros(0, np.int64)
    width = 2 * (lo + 1) - hi + 1
    n = len(x) - hi + 1
    if n < width:
        return none, none
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * common.powers(len(x))[:len(x)])])
    gram = common.mix64((total[hi:] - total[:-hi]) * _back_powers(n))
    bits = np.uint64(n.bit_length())
    place = np.arange(n, dtype=np.uint64)
    low = _window_min(gram >> bits << bits | place, width) & ((np.uint64(1) << bits) - np.uint64(1))
    inside = doc[:len(low)] == doc[hi + width - 2:hi + width - 2 + len(low)]
    kept = low[inside].astype(np.int64)
    if not len(kept):
        return none, none
    kept = kept[np.concatenate([[True], kept[1:] != kept[:-1]])]
    key = gram[kept]
    order = np.argsort(key + doc[kept].astype(np.uint64) * np.uint64(_STEP), kind="stable")
    at, key = kept[order], key[order]
    lag = at[1:] - at[:-1]
    pair = (key[1:] == key[:-1]) & (doc[at[1:]] == doc[at[:-1]]) & (lag > lo) & (lag <= hi)
    at, lag = at[:-1][pair], lag[pair]
    order = np.lexsort((at, lag))
    return at[order], lag[order]


def _equal_until(x: np.ndarray, at: int, lag: int, end: int) -> int:
    """The first position from ``at`` on where the word differs from the one ``lag`` later."""
    step = 64
    while at + lag < end:
        stop = min(at + step, end - lag)
        differs = np.flatnonzero(x[at:stop] != x[at + lag:stop + lag])
        if len(differs):
            return at + int(differs[0])
        at, step = stop, step * 2
    return at


def _equal_since(x: np.ndarray, at: int, lag: int, begin: int) -> int:
    """The first position of the unbroken row of equal words that ends before ``at``."""
    step = 64
    while at > begin:
        stop = max(begin, at - step)
        differs = np.flatnonzero(x[stop:at] != x[stop + lag:at + lag])
        if len(differs):
            return stop + int(differs[-1]) + 1
        at, step = stop, step * 2
    return at


def _long(x: np.ndarray, doc: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(start, end, lag) of the stretches of longer lags."""
    sizes = np.diff(bounds)
    for lo, hi in scales(int(sizes.max(initial=0))):
        enough = np.flatnonzero((sizes >= PERIODS * (lo + 1))[doc])
        at, lag = _seeds(x[enough], doc[enough], lo, hi)
        at = enough[at] if len(at) else at
        i = 0
        while i < len(at):
            m, q = int(at[i]), int(lag[i])
            begin, end = int(bounds[doc[m]]), int(bounds[doc[m] + 1])
            right = _equal_until(x, m, q, end)
            # Where hashes agree by chance the words don't, and nothing is found.
            left = _equal_since(x, m, q, begin) if right > m else m
            if right + q - left >= max(MIN_WORDS, PERIODS * q):
                yield left, right + q, q
            i += 1
            while i < len(at) and lag[i] == q and at[i] < right:
                i += 1


def _smallest(x: np.ndarray, start: int, end: int, q: int) -> bool:
    """No divisor of ``q`` is a period of the stretch, too."""
    rest, f = q, 2
    while rest > 1:
        if f * f > rest:
            f = rest
        if rest % f == 0:
            p = q // f
            if np.array_equal(x[start:end - p], x[start + p:end]):
                return False
            while rest % f == 0:
                rest //= f
        f += 1
    return True


def runs_of_words(x: np.ndarray, doc: np.ndarray, n_docs: int) -> dict[int, list[tuple[int, int, int]]]:
    """document -> (start, length, period) of its runs by start, then period; ``x`` are word
    hashes, ``doc`` the ascending document of each word."""
    bounds = np.searchsorted(doc, np.arange(n_docs + 1))
    out: dict[int, set] = {}
    for stretches in (_short(x, doc), _long(x, doc, bounds)):
        for s, e, q in stretches:
            if _smallest(x, s, e, q):
                d = int(doc[s])
                out.setdefault(d, set()).add((s - int(bounds[d]), e - s, q))
    return {d: sorted(r, key=lambda t: (t[0], t[2])) for d, r in out.items()}


def _best(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    best = runs[0]
    for r in runs[1:]:
        if r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run has after its first period, joined by one space."""
    keep = np.ones(len(words), bool)
    for s, n, q in runs:
        keep[s + q:s + n] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


_FIELDS = ("n_runs long, start long, length long, period long, exponent_milli long, "
           "runs array<struct<start: long, length: long, period: long>>, collapsed string")


def _columns(texts) -> list[pa.Array]:
    data, offsets = common.utf8(texts)
    n = len(offsets) - 1
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
    for i, j in common.chunks(offsets):
        part, own = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        starts, ends, doc = common.words(part, own)
        for d, r in runs_of_words(common.word_hashes(part, starts, ends), doc, j - i).items():
            runs[i + d] = r
    rest = []
    for d in range(n):
        words = data[offsets[d]:offsets[d + 1]].tobytes().split()
        rest.append(collapsed(words, runs[d]) if runs[d] else b" ".join(words))
    best = [_best(r) if r else (None, None, None) for r in runs]
    whole = pa.array([x for r in runs for x in r] or [], pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    ends_at = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
    return [pa.array([len(r) for r in runs], pa.int64()), *[pa.array([b[k] for b in best], pa.int64()) for k in range(3)],
            pa.array([1000 * b[1] // b[2] if b[2] else None for b in best], pa.int64()),
            pa.ListArray.from_arrays(pa.array(ends_at), whole), pa.array(rest, pa.binary()).cast(pa.string())]


def periodic_runs(docs: DataFrame, text_col: str = "text", name: str = "_runs") -> tuple[DataFrame, str]:
    """(``docs`` with a struct column of ``_FIELDS``, its name): the runs of each text, the one of the
    greatest exponent, and the text without repetitions (words joined by one space)."""
    return common.with_result(docs, text_col, _FIELDS, _columns, name)


def planted(doc_id, text):
    """The text with a periodic end in every tenth document, by the crc32 of its id (null: empty)."""
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def periodic(w):
        n = F.size(w)
        g = F.floor(h / 10)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, place(i).cast("int"))), " ")).otherwise("")

    # A one-element transform: the words are cut once, not once for each use.
    return F.when(h % 10 == 0, F.transform(F.array(words), periodic)[0]).otherwise(text)


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Every document, with the planted repetitions, and its runs."""
    docs = common.read(spark, sf_dir, "documents")
    docs = docs.select("doc_id", planted(F.col("doc_id"), F.coalesce("text", F.lit(""))).alias("text"))
    out, r = periodic_runs(docs)
    f = lambda c: F.col(f"{r}.{c}")
    listed = F.array_join(F.transform(f("runs"), lambda x: F.format_string("%d,%d,%d\n", x["start"], x["length"], x["period"])), "")
    return out.select("doc_id", *[f(c).alias(c) for c in ("n_runs", "start", "length", "period", "exponent_milli")],
                      F.sha2(listed, 256).alias("runs_sha256"), F.sha2(f("collapsed"), 256).alias("collapsed_sha256"))
