"""Second-order gradient boosting over histograms (M3), with the published regularisation.

Features are cut into at most ``max_bins`` bins once (each distinct value its own bin where there are
few, quantiles of one aggregation elsewhere) and written as one byte a feature. A level of a
tree is one job: every task adds the gradients and Hessians of its rows to (node, feature, bin) cells,
which are summed; running sums per (node, feature) give the gain

    T(G_l)^2 / (H_l + lambda) + T(G_r)^2 / (H_r + lambda) - T(G)^2 / (H + lambda),
    T(G) = sign(G) * max(|G| - alpha, 0),

of every split whose sides hold a Hessian of ``min_child`` or more. The driver sees the cells' sums, at most
2^(depth - 1) x features x bins, and no data rows: a published fit is 3,000 short jobs, so a job has no more
stages than it needs. A leaf is -rate * T(G) / (H + lambda). Missing values
go to the side with the greater gain. Rows are sampled by a hash of (row, round), columns by
(feature, round), so a lost task computes the same again. Equal gains (to 6 decimals) go to the
first feature, then the smallest threshold.

Margins are not kept in step with every tree: tasks add the few trees since the last rewrite of the
binned table (``REFRESH`` rounds), which keeps each pass one scan of bytes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime_spark import schemas as S
from ontime_spark.session import mark, materialize, release, scratch_path

#: Rounds between rewrites of the margins.
REFRESH = 8
#: Tasks whose sums the driver adds up itself.
DIRECT_TASKS = 16


@dataclass(frozen=True)
class Settings:
    """The published hyper-parameters."""
    rounds: int = 500
    depth: int = 6
    rate: float = 0.1
    subsample: float = 0.8
    colsample: float = 0.8
    min_child: float = 3.0
    alpha: float = 0.1
    reg_lambda: float = 1.0
    max_bins: int = 255
    seed: int = S.RANDOM_STATE


# ---------------------------------------------------------------- trees as arrays
@dataclass
class Tree:
    """Nodes by number: children (-1 at a leaf), the split (left if value <= threshold), the side of
    missing values, output, Hessian, gain and the place in a full tree (children 2i+1, 2i+2)."""
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    cover: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    place: list[int] = field(default_factory=list)

    def add(self, value: float, cover: float, place: int) -> int:
        for name, x in (("left", -1), ("right", -1), ("feature", 0), ("threshold", 0.0), ("bin", 0), ("missing_left", False),
                        ("value", value), ("cover", cover), ("gain", 0.0), ("place", place)):
            getattr(self, name).append(x)
        return len(self.left) - 1

    def arrays(self) -> dict[str, np.ndarray]:
        return {k: np.array(v) for k, v in asdict(self).items()}


def _leaf_of(tree: dict, rows: int, depth: int, goes_left) -> np.ndarray:
    """The node where each of ``rows`` rows ends; ``goes_left(rows, nodes)`` decides at inner nodes."""
    node = np.zeros(rows, np.int64)
    for _ in range(depth):
        inner = np.flatnonzero(tree["left"][node] >= 0)
        if not len(inner):
            break
        at = node[inner]
        node[inner] = np.where(goes_left(inner, at), tree["left"][at], tree["right"][at])
    return node


def _next_nodes(tree: dict, span: int = 256) -> np.ndarray:
    """Where a row at (node, bin of the node's feature) goes, as one flat table; a leaf leads to itself."""
    n, bins = len(tree["left"]), np.arange(span)
    left = np.where(bins == 0, tree["missing_left"][:, None], bins <= tree["bin"][:, None])
    to = np.where(left, tree["left"][:, None], tree["right"][:, None])
    return np.where(tree["left"][:, None] >= 0, to, np.arange(n)[:, None]).astype(np.int32).ravel()


def _by_bins(tree: dict, bins: np.ndarray, depth: int) -> np.ndarray:
    """The node where each row ends: two look-ups a level, whatever the rows."""
    if "next" not in tree:
        tree["next"] = _next_nodes(tree)
    at, feature, flat = np.arange(0, bins.size, bins.shape[1] or 1, dtype=np.int32), tree["feature"].astype(np.int32), bins.ravel()
    node = np.zeros(len(bins), np.int32)
    for _ in range(depth if tree["left"][0] >= 0 else 0):
        node = tree["next"].take(node * 256 + flat.take(at + feature.take(node)))
    return node


def _by_values(tree: dict, x: np.ndarray, depth: int) -> np.ndarray:
    def left(rows, at):
        v = x[rows, tree["feature"][at]]
        return np.where(np.isnan(v), tree["missing_left"][at], v <= tree["threshold"][at])
    return _leaf_of(tree, len(x), depth, left)


# ---------------------------------------------------------------- bins
def bin_cuts(df: DataFrame, features: Sequence[str], max_bins: int) -> list[list[float]]:
    """Ascending upper bounds of the bins of each feature but the last. Two aggregations, of which the
    driver gets at most ``max_bins`` numbers a feature."""
    value = {f: F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")) for f in features}
    few = df.agg(*[F.approx_count_distinct(value[f]).alias(str(i)) for i, f in enumerate(features)]).first()
    # The count is approximate: the collected set is bounded by it, with room for its error.
    small = [few[i] <= max_bins * 0.8 for i in range(len(features))]
    shares = [(k + 1) / max_bins for k in range(max_bins - 1)]
    found = df.agg(*[(F.collect_set(value[f]) if small[i] else F.percentile_approx(value[f], shares, 20 * max_bins)).alias(str(i))
                     for i, f in enumerate(features)]).first()
    return [sorted(set(found[i] or []))[:-1][:max_bins - 1] if small[i] else sorted(set(found[i] or [])) for i in range(len(features))]


#: The binned table: a block of rows in each of its rows (the number of the first, then the labels, margins
#: and bins as bytes), which a pass hands to Python whole instead of value by value.
_BLOCKS = "row long, y binary, margin binary, bins binary"


def _block(row: int, y: np.ndarray, margin: np.ndarray, bins: np.ndarray) -> tuple:
    return row, y.astype(np.float64).tobytes(), margin.astype(np.float64).tobytes(), bins.tobytes()


def _table(blocks: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([b[i] for b in blocks], t) for i, t in enumerate(types)], ["row", "y", "margin", "bins"])


def _binned(df: DataFrame, features: Sequence[str], label: str, cuts: list[list[float]], base: float) -> DataFrame:
    """Blocks of rows with label, margin and bins (one byte a feature, 0 for missing)."""
    bounds = [np.array(c, float) for c in cuts]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            bins = np.zeros((batch.num_rows, len(bounds)), np.uint8)
            for i, c in enumerate(bounds):
                v = batch.column(2 + i).to_numpy(zero_copy_only=False).astype(float)
                bins[:, i] = np.where(np.isnan(v), 0, np.searchsorted(c, v, "left") + 1)
            # The numbers of a task's rows follow each other.
            yield _table([_block(batch.column(0)[0].as_py(), batch.column(1).to_numpy(), np.full(batch.num_rows, base), bins)])

    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(label).cast("double").alias("y"),
                     *[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)])
    return rows.mapInArrow(run, _BLOCKS)


def _arrays(batch: pa.RecordBatch, width: int):
    """(rows, y, margin, bins) of each block of the binned table."""
    for row, y, margin, bins in zip(*[batch.column(i) for i in range(4)]):
        y, margin = np.frombuffer(y.as_buffer(), np.float64), np.frombuffer(margin.as_buffer(), np.float64).copy()
        bins = np.frombuffer(bins.as_buffer(), np.uint8) if width else np.zeros(0, np.uint8)
        yield np.arange(row.as_py(), row.as_py() + len(y)), y, margin, bins.reshape(len(y), width)


def _uniform(row: np.ndarray, turn: int) -> np.ndarray:
    """A number in [0, 1) for each row, fixed by (row, turn)."""
    h = row.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (turn + 1) & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return (h ^ (h >> np.uint64(31))) / float(1 << 64)


# ---------------------------------------------------------------- one level
_SUMS = "feature int, g binary, h binary"


def _sum_rows(sums: np.ndarray) -> pa.RecordBatch:
    """The cells' sums (2 x columns x cells), a row for each column."""
    return pa.RecordBatch.from_arrays([pa.array(np.arange(sums.shape[1], dtype=np.int32)), *(pa.array([c.tobytes() for c in part], pa.binary()) for part in sums)],
                                      ["feature", "g", "h"])


def _cells(binned: DataFrame, tasks: int, width: int, since: list[dict], tree: dict, active: list[int], columns: list[int],
           turn: int, positive: float, s: Settings) -> np.ndarray:
    """The gradients and Hessians (first axis) summed by column, active node and bin. Each task sums its rows;
    the sums of more than ``DIRECT_TASKS`` tasks are added up by column before they come to the driver."""
    slot = np.full(len(tree["left"]), -1)
    slot[active] = np.arange(len(active))
    span = s.max_bins + 1
    shape = (2, len(columns), len(active) * span)

    def run(batches):
        sums = np.zeros(shape)
        level = int(tree["place"].max() + 1).bit_length() - 1
        for row, y, margin, bins in (block for batch in batches for block in _arrays(batch, width)):
            if s.subsample < 1:
                kept = _uniform(row, s.seed + turn) < s.subsample
                y, margin, bins = y[kept], margin[kept], bins[kept]
            for t in since:
                margin += t["value"][_by_bins(t, bins, s.depth)]
            node = slot[_by_bins(tree, bins, level)]
            inside = node >= 0
            p = 1 / (1 + np.exp(-margin[inside]))
            weight = np.where(y[inside] > 0, positive, 1.0)
            g, h = weight * (p - y[inside]), weight * p * (1 - p)
            at = node[inside] * span
            for k, c in enumerate(columns):
                cell = at + bins[inside, c]
                sums[0, k] += np.bincount(cell, g, shape[2])
                sums[1, k] += np.bincount(cell, h, shape[2])
        yield _sum_rows(sums)

    def added(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, *parts in zip(*[batch.column(i) for i in range(3)]):
                one = np.stack([np.frombuffer(x.as_buffer()) for x in parts])
                sums[k.as_py()] = sums[k.as_py()] + one if k.as_py() in sums else one
        for k, one in sums.items():
            yield _sum_rows(one[:, None]).set_column(0, "feature", pa.array([k], pa.int32()))

    parts = binned.mapInArrow(run, _SUMS)
    if tasks > DIRECT_TASKS:
        parts = parts.repartition("feature").mapInArrow(added, _SUMS)
    total = np.zeros(shape)
    for r in parts.collect():
        total[:, r["feature"]] += np.frombuffer(r["g"]), np.frombuffer(r["h"])
    return total.reshape(2, len(columns), len(active), span)


def _score(g: np.ndarray, h: np.ndarray, s: Settings) -> np.ndarray:
    size = h + s.reg_lambda
    return np.divide(np.maximum(np.abs(g) - s.alpha, 0.0) ** 2, size, out=np.zeros_like(size), where=size != 0)


def best_splits(cells: np.ndarray, active: list[int], columns: list[int], s: Settings) -> dict[int, dict]:
    """For each active node with rows g, h and its best split (feature, bin, missing_left, gl, hl, gain; None
    if none has a gain)."""
    if not columns:
        return {}
    g, h = cells
    side = np.array([1.0, 0.0])  # what is known as missing goes to the right, to the left
    gt, ht = g.sum(axis=2)[:, :, None, None], h.sum(axis=2)[:, :, None, None]
    gl = g.cumsum(axis=2)[..., None] - g[:, :, :1, None] * side
    hl = h.cumsum(axis=2)[..., None] - h[:, :, :1, None] * side
    gain = np.round(_score(gl, hl, s) + _score(gt - gl, ht - hl, s) - _score(gt, ht, s), 6)
    # Only nearly empty sides can come out a little below zero by the order of the sums.
    valid = (h[..., None] != 0) & (hl >= s.min_child) & (ht - hl >= s.min_child) & (gain > 0)
    valid[:, :, 0] = False
    order = np.where(valid, gain, 0.0).transpose(1, 0, 2, 3)
    found = {}
    for i, node in enumerate(active):
        if not h[:, i].any():
            continue
        k, cut, left = np.unravel_index(order[i].argmax(), order[i].shape)
        best = {"feature": columns[k], "bin": int(cut), "missing_left": bool(left), "gl": float(gl[k, i, cut, left]), "hl": float(hl[k, i, cut, left]),
                "gain": float(order[i, k, cut, left])} if order[i].any() else None
        found[node] = {"g": float(gt[:, i].max()), "h": float(ht[:, i].max()), "best": best}
    return found


def _output(g: float, h: float, s: Settings) -> float:
    size = h + s.reg_lambda
    return -s.rate * float(np.sign(g)) * max(abs(g) - s.alpha, 0.0) / size if size else 0.0


# ---------------------------------------------------------------- fit
def fit(df: DataFrame, features: Sequence[str], label: str, settings: Settings = Settings()) -> BoostedTreesModel:
    """Boost on a numeric table; ``label`` is 0 or 1. Positives weigh n_neg / n_pos. Null and NaN
    features are missing; rows without a label are left out."""
    s, spark = settings, df.sparkSession
    df = df.where(F.col(label).isNotNull())
    counts = df.agg(F.sum(F.col(label).cast("double")).alias("pos"), F.count(F.lit(1)).alias("n")).first()
    positive = (counts["n"] - counts["pos"]) / counts["pos"] if counts["pos"] else 1.0
    cuts = bin_cuts(df, features, s.max_bins)
    begin = mark()
    binned = materialize(_binned(df, features, label, cuts, 0.0), "binned")
    tasks = binned.rdd.getNumPartitions()
    trees: list[dict] = []
    since: list[dict] = []
    for turn in range(s.rounds if counts["n"] else 0):
        rng = np.random.default_rng([s.seed, turn])
        columns = sorted(rng.permutation(len(features))[:max(1, round(s.colsample * len(features)))].tolist())
        tree = Tree()
        tree.add(0.0, 0.0, 0)
        active = [0]
        for _ in range(s.depth):
            cells = _cells(binned, tasks, len(features), since, tree.arrays(), active, columns, turn, positive, s)
            found = best_splits(cells, active, columns, s)
            after = []
            for node in active:
                r = found.get(node)
                if r is None:
                    continue
                tree.value[node], tree.cover[node] = _output(r["g"], r["h"], s), r["h"]
                b = r["best"]
                if b is None:
                    continue
                own = cuts[b["feature"]]
                tree.feature[node], tree.bin[node], tree.missing_left[node] = b["feature"], b["bin"], b["missing_left"]
                tree.threshold[node] = own[b["bin"] - 1] if b["bin"] <= len(own) else float("inf")
                tree.gain[node] = b["gain"]
                gr, hr, place = r["g"] - b["gl"], r["h"] - b["hl"], tree.place[node]
                tree.left[node] = tree.add(_output(b["gl"], b["hl"], s), b["hl"], 2 * place + 1)
                tree.right[node] = tree.add(_output(gr, hr, s), hr, 2 * place + 2)
                after += [tree.left[node], tree.right[node]]
            active = after
            if not active:
                break
        since.append(tree.arrays())
        trees.append(since[-1])
        if len(since) == REFRESH and turn + 1 < s.rounds:
            old, binned, since = mark(), materialize(_moved(binned, len(features), since, s.depth), "binned"), []
            release(spark, begin, old)
            tasks = binned.rdd.getNumPartitions()
    release(spark, begin)
    return BoostedTreesModel(list(features), trees, 0.0, s)


def _moved(binned: DataFrame, width: int, since: list[dict], depth: int) -> DataFrame:
    """The binned table with the margins after ``since``."""
    def run(batches):
        for batch in batches:
            for row, y, margin, bins in _arrays(batch, width):
                for t in since:
                    margin += t["value"][_by_bins(t, bins, depth)]
                yield _table([_block(int(row[0]), y, margin, bins)])

    return binned.mapInArrow(run, _BLOCKS)


# ---------------------------------------------------------------- model
_NODES = ("left", "right", "feature", "threshold", "bin", "missing_left", "value", "cover", "gain", "place")
_SCHEMA = ("tree int, id int, left int, right int, feature int, threshold double, bin int, missing_left boolean, "
           "value double, cover double, gain double, place int")


class BoostedTreesModel:
    """Fitted trees: ``margin`` (log-odds) and ``probability`` columns, node table, importances, files.
    Its size is bounded by the settings (rounds * 2^(depth + 1) nodes)."""

    def __init__(self, features: list[str], trees: list[dict], base: float, settings: Settings):
        self.features, self.trees, self.base, self.settings = features, trees, base, settings

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for t in self.trees:
            out += t["value"][_by_values(t, x, self.settings.depth)]
        return out

    def margin(self) -> Column:
        """Log-odds of the positive class from the feature columns."""
        margins = self.margins

        def run(*columns: pd.Series) -> pd.Series:
            return pd.Series(margins(np.column_stack([c.to_numpy(float) for c in columns])))

        return F.pandas_udf(run, "double")(*[F.col(f).cast("double") for f in self.features])

    def probability(self) -> Column:
        return 1 / (1 + F.exp(-self.margin()))

    def nodes(self, spark: SparkSession) -> DataFrame:
        rows = [(k, i, *[t[c][i].item() for c in _NODES]) for k, t in enumerate(self.trees) for i in range(len(t["left"]))]
        return spark.createDataFrame(rows, _SCHEMA)

    def importances(self) -> list[tuple[str, float]]:
        """Mean gain of each feature's splits, as shares of all features'."""
        total, count = np.zeros(len(self.features)), np.zeros(len(self.features))
        for t in self.trees:
            inner = t["left"] >= 0
            np.add.at(total, t["feature"][inner], t["gain"][inner])
            np.add.at(count, t["feature"][inner], 1)
        mean = total / np.maximum(count, 1)
        return list(zip(self.features, (mean / (mean.sum() or 1.0)).tolist()))

    def save(self, spark: SparkSession, path: str) -> str:
        self.nodes(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        about = json.dumps({"features": self.features, "base": self.base, "settings": asdict(self.settings), "trees": len(self.trees)})
        spark.createDataFrame([(about,)], "about string").coalesce(1).write.mode("overwrite").text(f"{path}/about")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTreesModel:
        about = json.loads(spark.read.text(f"{path}/about").first()[0])
        pdf = spark.read.schema(_SCHEMA).parquet(f"{path}/nodes").orderBy("tree", "id").toPandas()
        trees = [{c: part[c].to_numpy() for c in _NODES} for _, part in pdf.groupby("tree")]
        return cls(about["features"], trees, about["base"], Settings(**about["settings"]))


def saved_copy(spark: SparkSession, model: BoostedTreesModel) -> BoostedTreesModel:
    """The model written to the shared folder and read again."""
    return BoostedTreesModel.load(spark, model.save(spark, scratch_path(spark, f"boosted-{uuid.uuid4().hex}")))
