"""Language identification with a byte convolutional network (operator 5).

Texts are read as bytes (UTF-8, A-Z lower-cased) in fixed-length windows that overlap by the
widest filter less one, so every byte of every text is seen. Each byte has a learned embedding;
filters of several widths run over it, the largest response of each filter in the window is kept
(max pooling), and a softmax over the learned languages follows. A text's probabilities are the
means over its windows, weighted by their bytes.

The network is trained in numpy with Adam on a bounded sample of labelled rows (``TRAIN_ROWS``
documents by smallest hash of the id, ``TRAIN_WINDOWS`` windows of each); it is a few kilobytes
and goes to the tasks with the function. Prediction covers all rows and whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime_spark.llm import common

WINDOW = 256
WIDTHS = (2, 3, 4)
EMBEDDING, FILTERS = 8, 16
#: Bound of the training sample: documents, and windows taken from each.
TRAIN_ROWS, TRAIN_WINDOWS = 4000, 3
EPOCHS, BATCH, RATE, SEED = 4, 64, 0.01, 7
#: Windows per matrix product; keeps the intermediate arrays in cache.
STEP = 64
#: A document whose best language has a lower mean probability is rejected by the pipeline.
MIN_SCORE = 0.3
UNKNOWN = "und"


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows x WINDOW bytes, owner document, bytes in each window); the last window of a
    text is filled with zeros. Empty texts have no window."""
    stride = WINDOW - max(WIDTHS) + 1
    sizes = offsets[1:] - offsets[:-1]
    counts = np.where(sizes > 0, np.maximum(1, -(-(sizes - max(WIDTHS) + 1) // stride)), 0)
    owner = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = offsets[owner] + nth * stride
    length = np.minimum(offsets[owner + 1] - begin, WINDOW)
    place = np.arange(WINDOW)
    inside = place < length[:, None]
    if not len(owner):
        return np.zeros((0, WINDOW), np.uint8), owner, length
    index = np.where(inside, begin[:, None] + place, 0)
    return np.where(inside, data[index], 0).astype(np.uint8), owner, length


@dataclass
class Network:
    """``kernel`` has one column per filter over the widest width; narrower filters are zero in
    the rows they don't cover."""

    languages: list[str]
    embedding: np.ndarray   # 256 x E
    kernel: np.ndarray      # widest * E x filters
    bias: np.ndarray
    out: np.ndarray         # filters x languages
    out_bias: np.ndarray

    def _responses(self, batch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wide = max(WIDTHS)
        e = self.embedding[batch]
        n, w, size = e.shape
        flat = np.lib.stride_tricks.as_strided(
            e, (n, w - wide + 1, wide * size), (e.strides[0], e.strides[1], e.strides[2]))
        flat = np.ascontiguousarray(flat).reshape(-1, wide * size)
        return flat, (flat @ self.kernel).reshape(n, w - wide + 1, -1)

    def probabilities(self, batch: np.ndarray) -> np.ndarray:
        """Softmax of each window."""
        out = np.empty((len(batch), len(self.languages)), np.float32)
        for i in range(0, len(batch), STEP):
            _, r = self._responses(batch[i:i + STEP])
            pooled = np.maximum(r.max(axis=1) + self.bias, 0)
            z = pooled @ self.out + self.out_bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            out[i:i + STEP] = z / z.sum(axis=1, keepdims=True)
        return out


def train(texts: list[str], labels: list[str], seed: int = SEED) -> Network:
    """Fit the network on labelled texts (at least one). Deterministic for a given input."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    index = {x: i for i, x in enumerate(languages)}
    wide, total = max(WIDTHS), len(WIDTHS) * FILTERS
    mask = np.zeros((wide, EMBEDDING, total), np.float32)
    for n, w in enumerate(WIDTHS):
        mask[:w, :, n * FILTERS:(n + 1) * FILTERS] = 1
    mask = mask.reshape(wide * EMBEDDING, total)
    net = Network(languages, rng.normal(0, 0.3, (256, EMBEDDING)).astype(np.float32),
                  (rng.normal(0, 0.2, (wide * EMBEDDING, total)) * mask).astype(np.float32),
                  np.zeros(total, np.float32), rng.normal(0, 0.1, (total, len(languages))).astype(np.float32),
                  np.zeros(len(languages), np.float32))
    x, y = [], []
    for text, label in zip(texts, labels):
        raw = common.LOWER[np.frombuffer(text.encode(), np.uint8)]
        own, _, _ = windows(raw, np.array([0, len(raw)]))
        pick = own[rng.permutation(len(own))[:TRAIN_WINDOWS]]
        x.append(pick)
        y += [index[label]] * len(pick)
    x, y = np.concatenate(x), np.array(y, int)
    if not len(x):
        return net
    # Each language weighs alike, however many documents it has in the sample.
    weight = (len(y) / np.maximum(np.bincount(y, minlength=len(languages)), 1) / len(languages))[y]
    names = ("embedding", "kernel", "bias", "out", "out_bias")
    first = {k: np.zeros_like(getattr(net, k)) for k in names}
    second = {k: np.zeros_like(getattr(net, k)) for k in names}
    step, steps = 0, EPOCHS * -(-len(x) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for i in range(0, len(order), BATCH):
            at = order[i:i + BATCH]
            batch, want, own = x[at], y[at], weight[at][:, None]
            n = len(at)
            flat, r = net._responses(batch)
            best = r.argmax(axis=1)
            top = np.take_along_axis(r, best[:, None], 1)[:, 0] + net.bias
            pooled = np.maximum(top, 0)
            z = pooled @ net.out + net.out_bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(n), want] -= 1
            p = (p * own / n).astype(np.float32)
            grads = {"out": pooled.T @ p, "out_bias": p.sum(0)}
            back = (p @ net.out.T) * (top > 0)
            grads["bias"] = back.sum(0)
            per = r.shape[1]
            row = (np.arange(n)[:, None] * per + best)          # n x filters
            seen = flat[row]                                     # n x filters x (wide*E)
            grads["kernel"] = np.einsum("nf,nfk->kf", back, seen, optimize=True) * mask
            into = back[:, :, None] * net.kernel.T[None]         # n x filters x (wide*E)
            into = into.reshape(n, total, wide, EMBEDDING)
            bytes_at = batch[np.arange(n)[:, None, None], best[:, :, None] + np.arange(wide)]
            g = np.zeros_like(net.embedding)
            np.add.at(g, bytes_at.reshape(-1), into.reshape(-1, EMBEDDING))
            grads["embedding"] = g
            step += 1
            rate = RATE * max(0.02, 1 - step / steps)
            for k in names:
                first[k] += 0.1 * (grads[k] - first[k])
                second[k] += 0.001 * (grads[k] ** 2 - second[k])
                m = first[k] / (1 - 0.9 ** step)
                v = second[k] / (1 - 0.999 ** step)
                setattr(net, k, (getattr(net, k) - rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32))
    return net


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text has remainder 2 modulo 4 (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        rows: int = TRAIN_ROWS) -> Network | None:
    """Train on a bounded sample of the rows that are not held out and have a language and
    text; None if there is none."""
    order = F.xxhash64(F.col(id_col).cast("string"), F.lit("train"))
    labelled = (docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & (F.octet_length(F.col(text_col).cast("string")) > 0))
                .select(order.alias("o"), F.col(text_col).cast("string").alias("t"), F.col(lang_col).cast("string").alias("l")))
    # The sample's largest hash first, from hashes alone; then only its rows come to the driver.
    last = labelled.select("o").orderBy("o").limit(rows).agg(F.max("o")).first()[0]
    if last is None:
        return None
    sample = sorted(labelled.where(F.col("o") <= last).collect(), key=lambda r: (r["o"], r["l"], r["t"]))[:rows]
    return train([r["t"] for r in sample], [r["l"] for r in sample])


def _predictor(network: Network | None):
    """The function from texts to arrays of languages and scores."""
    def run(texts):
        data, offsets = common.utf8(texts)
        n = len(offsets) - 1
        names = [UNKNOWN] * n
        scores = np.zeros(n)
        if network is not None:
            for i, j in common.chunks(offsets):
                part = common.LOWER[data[offsets[i]:offsets[j]]]
                x, owner, size = windows(part, offsets[i:j + 1] - offsets[i])
                p = network.probabilities(x) * size[:, None]
                total = np.zeros((j - i, p.shape[1]))
                np.add.at(total, owner, p)
                weight = np.bincount(owner, weights=size, minlength=j - i)
                best = total.argmax(axis=1)
                for d in range(i, j):
                    text = data[offsets[d]:offsets[d + 1]].tobytes()
                    if _has_letter(text):
                        names[d] = network.languages[best[d - i]]
                        scores[d] = min(1.0, total[d - i, best[d - i]] / weight[d - i])
        return [pa.array(names, pa.string()), pa.array(scores)]

    return run


def identify(docs: DataFrame, network: Network | None, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` plus a struct (its name is returned too): lang and score (mean probability of
    that language over the text's windows).

    Null texts and texts without a letter are ``und`` with score 0, as is every text when there
    is no network. Short texts are one window filled with zeros. Rows are independent: repeated
    rows give equal results, and of languages with equal probability the first by name counts.
    Other columns pass through, whatever their names."""
    return common.with_result(docs, text_col, "lang: string, score: double", _predictor(network))


def _has_letter(text: bytes) -> bool:
    if any(65 <= b <= 90 or 97 <= b <= 122 for b in text[:64]):
        return True
    return any(c.isalpha() for c in text.decode())


def accepted(docs: DataFrame, network: Network | None, text_col: str = "text",
             min_score: float = MIN_SCORE) -> DataFrame:
    """The documents that have a language of at least ``min_score``, columns unchanged."""
    predict = _predictor(network)

    def verdict(texts: pa.Array) -> pa.Array:
        names, scores = predict(texts)
        common.give_back()
        return pa.compute.and_(pa.compute.not_equal(names, UNKNOWN), pa.compute.greater_equal(scores, min_score))

    # Only the text goes to Python and only the verdict comes back.
    return docs.where(F.arrow_udf(verdict, "boolean")(F.col(text_col).cast("string")))


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    """Every document with its predicted language; learned from the rows not held out."""
    docs = common.read(spark, sf_dir, "documents")
    marked, r = identify(docs.select("doc_id", "text"), fit(docs))
    return marked.select("doc_id", held_out().alias("held_out"), F.col(r)["lang"].alias("lang_pred"),
                         F.col(r)["score"].alias("score"))
