"""Benchmark decontamination by Wu-Manber multi-pattern search over words (operator 10).

The alphabet of the search is the word. Patterns are the windows of the benchmark items: ten
consecutive words, or all words of an item that has fewer. For each pattern length a shift table
over blocks of two words tells how far the search may move without missing an occurrence, so
most positions of a text are never looked at; a block that ends some pattern has its patterns in
a suffix bucket, divided by their first words, and direct comparison confirms an occurrence.

The benchmark is the stated query set. It is read in blocks of bounded size and every text is
searched for each of them. One block, the usual case, is one pass. With more, each block is
broadcast for a pass of its own, whose hits are written and joined by text at the end: neither the
driver nor a task ever holds more than one block, however large the benchmark is.

Null texts have no words and equal texts equal results; very long texts are searched whole.
Items without words have no window; rows of one item id count as one item. Empty tables and
clashing names change nothing.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime_spark.llm import common
from ontime_spark.session import materialize

WINDOW = 10
#: Words: maximal runs of ASCII letters, digits and non-ASCII characters.
WORD = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of item texts in one block of the query set (a single longer item is a block).
BLOCK_BYTES = 4 << 20

_LOWER = bytes(common.LOWER)


class WuManber:
    """Search for patterns of one length (tuples of words)."""

    def __init__(self, patterns: Iterable[tuple[bytes, ...]], length: int):
        self.length = length
        self.block = min(2, length)
        self.default = length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = {}
        for p in patterns:
            for j in range(self.block, length + 1):
                key = p[j - self.block:j]
                self.shift[key] = min(self.shift.get(key, self.default), length - j)
            self.buckets.setdefault(p[-self.block:], {}).setdefault(p[:self.block], []).append(p)

    def find(self, words: list[bytes]) -> list[tuple[int, tuple[bytes, ...]]]:
        """(first word, pattern) of every occurrence."""
        found = []
        m, size, default, shift = self.length, self.block, self.default, self.shift
        end, n = m, len(words)
        while end <= n:
            key = tuple(words[end - size:end])
            step = shift.get(key, default)
            if step:
                end += step
                continue
            first = end - m
            for p in self.buckets[key].get(tuple(words[first:first + size]), ()):
                if tuple(words[first:end]) == p:
                    found.append((first, p))
            end += 1
        return found


class QueryBlock:
    """The windows of some items, with the items that each window stands for."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.items: dict[tuple[bytes, ...], set[str]] = {}
        for name, text in items:
            w = re.findall(WORD, text.translate(_LOWER))
            for i in range(max(1, len(w) - window + 1) if w else 0):
                self.items.setdefault(tuple(w[i:i + window]), set()).add(name)
        by_length: dict[int, list] = {}
        for p in self.items:
            by_length.setdefault(len(p), []).append(p)
        self.searchers = [WuManber(ps, m) for m, ps in sorted(by_length.items())]

    def find(self, words: list[bytes]):
        for s in self.searchers:
            if len(words) >= s.length:
                yield from s.find(words)


def _query_blocks(benchmark: DataFrame, id_col: str, text_col: str, limit: int):
    """Lists of (item id as text, text) of bounded size; only one is held at a time."""
    block, size = [], 0
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"),
                            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    for r in rows.toLocalIterator():
        text = r["t"].encode()
        if block and size + len(text) > limit:
            yield block
            block, size = [], 0
        block.append((r["i"], text))
        size += len(text)
    if block:
        yield block


_FIELDS = "n_words: bigint, n_hit: bigint, items: array<string>, spans: array<struct<first: bigint, last: bigint>>"


def occurrences(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, str]:
    """``docs`` plus a struct (its name is returned too): n_words, n_hit (words inside any
    occurrence of a window), items (ids as text, sorted) and spans (merged ranges of hit word
    numbers, last included).

    Null texts have no words; items without words have no window; rows of one item id count as
    one item; a null item id is the empty text. Without benchmark rows nothing is hit."""
    blocks = _query_blocks(benchmark, item_col, item_text_col, block_bytes)
    first, second = next(blocks, None), next(blocks, None)
    if second is None:
        return _searched(docs, text_col, first, window)[:2]
    text = F.col(text_col).cast("string")
    same = [F.xxhash64(text), F.octet_length(text)]
    found = None
    for block in itertools.chain((first, second), blocks):
        marked, r, sent = _searched(docs.select(text_col), text_col, block, window)
        hits = (marked.where(F.col(r)["n_hit"] > 0).groupBy(same[0].alias("h"), same[1].alias("n"))
                .agg(F.first(F.col(r)["items"]).alias("items"), F.first(F.col(r)["spans"]).alias("spans")))
        hits = materialize(hits, "block-hits")
        sent.destroy()
        found = hits if found is None else found.union(hits)
    # At most one row of each block meets here, whatever the number of copies of a text.
    found = found.groupBy("h", "n").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
                                        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    own = {c: common.fresh(docs.columns, f"_{c}") for c in found.columns}
    found = found.select(*[F.col(c).alias(n) for c, n in own.items()])
    counted, r, _ = _searched(docs, text_col, None, window)
    joined = counted.join(found, (same[0] == F.col(own["h"])) & (same[1] == F.col(own["n"])), "left")
    spans = _merged(F.coalesce(own["spans"], F.col(r)["spans"]))
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda t, x: t + x["last"] - x["first"] + 1)
    result = F.struct(F.col(r)["n_words"].alias("n_words"), n_hit.alias("n_hit"), F.coalesce(own["items"], F.col(r)["items"]).alias("items"), spans.alias("spans"))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], result.alias(r)), r


def _merged(spans):
    """Sorted ranges with those that touch made one."""
    def add(done, x):
        last = F.get(done, F.size(done) - 1)
        joined = F.struct(last["first"].alias("first"), F.greatest(last["last"], x["last"]).alias("last"))
        return F.when((F.size(done) > 0) & (x["first"] <= last["last"] + 1), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(
            F.concat(done, F.array(x)))

    return F.aggregate(spans, F.filter(spans, lambda x: F.lit(False)), add)


def _searched(docs: DataFrame, text_col: str, block, window: int):
    """(``docs`` with the struct for one block of items, its name, the broadcast block)."""
    sent = docs.sparkSession.sparkContext.broadcast(block) if block else None
    pattern = re.compile(WORD)
    span = pa.struct([("first", pa.int64()), ("last", pa.int64())])
    ready: list[QueryBlock] = []  # made once in a task

    def run(texts):
        if sent is not None and not ready:
            ready.append(QueryBlock(sent.value, window))
        data, offsets = common.utf8(texts)
        lists = []
        n_words = np.zeros(len(offsets) - 1, np.int64)
        n_hit = np.zeros(len(offsets) - 1, np.int64)
        for i, j in common.chunks(offsets):
            low = common.LOWER[data[offsets[i]:offsets[j]]].tobytes()
            own = (offsets[i:j + 1] - offsets[i]).tolist()
            for d in range(i, j):
                words = pattern.findall(low, own[d - i], own[d - i + 1])
                n_words[d] = len(words)
                items: set[str] = set()
                merged: list[list[int]] = []
                if ready:
                    spans = []
                    for first, p in ready[0].find(words):
                        items.update(ready[0].items[p])
                        spans.append((first, first + len(p) - 1))
                    for first, last in sorted(spans):
                        if merged and first <= merged[-1][1] + 1:
                            merged[-1][1] = max(merged[-1][1], last)
                        else:
                            merged.append([first, last])
                    n_hit[d] = sum(b - a + 1 for a, b in merged)
                lists.append((sorted(items), [{"first": a, "last": b} for a, b in merged]))
        return [pa.array(n_words), pa.array(n_hit), pa.array([x for x, _ in lists], pa.list_(pa.string())),
                pa.array([x for _, x in lists], pa.list_(span))]

    return *common.with_result(docs, text_col, _FIELDS, run), sent


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents without an occurrence of a benchmark window, columns unchanged."""
    marked, r = occurrences(docs, benchmark, text_col, **options)
    return marked.where(F.col(r)["n_hit"] == 0).drop(r)


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every document with its words, hit words and the items whose windows occur in it."""
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text")
    marked, r = occurrences(docs, common.read(spark, sf_dir, "benchmark"))
    hit = F.col(r)
    return marked.select("doc_id", hit["n_words"].alias("n_words"), hit["n_hit"].alias("n_hit"),
                         F.size(hit["items"]).cast("long").alias("n_items"),
                         F.sha2(F.array_join(hit["items"], ","), 256).alias("items_sha256"),
                         (hit["n_hit"] > 0).alias("contaminated"))


SQL = {"op10_decontamination": r"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
i AS (SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
p AS (SELECT DISTINCT item_id, least(len(words), 10) AS m,
    array_to_string(words[k:k + 9], ' ') AS win
    FROM (SELECT *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS k FROM i WHERE len(words) > 0)),
lens AS (SELECT DISTINCT m FROM p),
g AS (SELECT r, m, k, array_to_string(words[k:k + m - 1], ' ') AS win
    FROM (SELECT r, words, m, unnest(range(1, len(words) - m + 2)) AS k FROM w, lens WHERE len(words) >= m)),
o AS (SELECT DISTINCT r, k, p.m, item_id FROM g JOIN p ON g.m = p.m AND g.win = p.win),
h AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(k, k + m)) AS x FROM o) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM o) GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN h USING (r) LEFT JOIN it USING (r)"""}
