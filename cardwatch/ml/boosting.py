"""Gradient boosting with L1 and L2 penalties, from histograms that the executors add up.

Features are binned once by their quantiles (or by equal widths) into a written table of bytes. Each level of a tree is one
job: a task adds up gradients and hessians of its rows per (node, feature, bin), Spark sums the tasks' cells, and the
driver, which sees nodes x features x bins numbers whatever the number of rows, picks the splits. The margin of the trees
so far is kept beside the bins: after every tree it is stored on the executors, so that no tree is evaluated twice, and
every few trees it is written, so that lineage stays short.

Per node with gradient sum G and hessian sum H, and T the sum shrunk by the L1 penalty towards 0:
gain = (T_left^2 / (H_left + l2) + T_right^2 / (H_right + l2) - T^2 / (H + l2)) / 2, leaf = -rate T / (H + l2).
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.operators.sampling import id_hash
from cardwatch.session import scratch_path

#: Trees after which the margins are written anew.
WRITE_EVERY = 20


@dataclass(frozen=True)
class Penalised:
    """The published settings of the boosted model."""

    # Trees, depth, learning rate, row and column share, L1 and L2 penalty.
    trees: int = 100
    depth: int = 4
    rate: float = 0.1
    rows: float = 0.8
    columns: float = 0.8
    l1: float = 0.1
    l2: float = 1.0
    # Least hessian of a child, bins of a feature (255 at most), seed.
    least_hessian: float = 1.0
    bins: int = 64
    seed: int = 42


@dataclass
class Tree:
    """Node k has the children 2 k + 1 and 2 k + 2; a node without a feature (-1) is a leaf."""

    feature: list[int]
    cut: list[int]
    value: list[float]

    def leaf_of(self, binned: np.ndarray) -> np.ndarray:
        at, rows = np.zeros(len(binned), np.int64), np.arange(len(binned))
        feature, cut = np.array(self.feature), np.array(self.cut)
        for _ in range(len(self.feature).bit_length()):
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                break
            right = binned[rows, np.maximum(f, 0)] > cut[at]
            at = np.where(inner, 2 * at + 1 + right, at)
        return at

    def margin(self, binned: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaf_of(binned)]


@dataclass
class Boosted:
    """Bin edges per feature, and the trees. A value is in the bin of the number of edges below it; null and NaN in 0."""

    features: list[str]
    edges: list[list[float]]
    trees: list[Tree] = field(default_factory=list)

    def binned(self) -> Column:
        """One byte per feature: how many of its edges are smaller than the value."""
        return F.concat(*[bin_byte(F.col(c), e) for c, e in zip(self.features, self.edges)])

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with the double column ``probability``."""
        names = df.columns
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        return df.withColumn("__bins", self.binned()).mapInArrow(
            partial(_score, trees=self.trees, width=len(self.features), names=names), f"{schema}, probability double"
        )

    def splits(self) -> int:
        return sum(f >= 0 for t in self.trees for f in t.feature)

    def save(self, spark, path: str) -> None:
        """As one JSON row in a text table that every executor can reach."""
        text = json.dumps({"features": self.features, "edges": self.edges, "trees": [asdict(t) for t in self.trees]})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)

    @staticmethod
    def load(spark, path: str) -> Boosted:
        saved = json.loads(spark.read.text(path).first()[0])
        return Boosted(saved["features"], saved["edges"], [Tree(**t) for t in saved["trees"]])


def bin_byte(value: Column, edges: Sequence[float]) -> Column:
    """The bin as one byte, by a search among constants."""
    value = F.when(F.isnan(value.cast("double")), None).otherwise(value.cast("double"))
    below = F.size(F.filter(F.lit(list(edges)) if edges else F.array().cast("array<double>"), lambda e: e < value))
    return F.unhex(F.lpad(F.hex(F.coalesce(F.when(value.isNotNull(), below), F.lit(0))), 2, "0"))


def quantile_edges(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """At most ``bins`` - 1 edges a feature from one pass of mergeable quantile sketches."""
    shares = [k / bins for k in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.nanvl(F.col(c).cast("double"), F.lit(None)), shares, 10_000).alias(c) for c in features]).first()
    return [sorted(set(row[c] or [])) for c in features]


def width_edges(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Edges of equal distance between the least and the greatest value."""
    value = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None))
    row = df.agg(*[x for c in features for x in (F.min(value(c)).alias(f"{c} low"), F.max(value(c)).alias(f"{c} high"))]).first()
    out = []
    for c in features:
        low, high = row[f"{c} low"], row[f"{c} high"]
        out.append([low + (high - low) * k / bins for k in range(1, bins)] if low is not None and high > low else [])
    return out


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    # Every row has one byte a feature, so the values lie in a row.
    bins = batch.column("__bins").cast(pa.binary())
    first = np.frombuffer(bins.buffers()[1], np.int32)[bins.offset] if len(bins) else 0
    return np.frombuffer(bins.buffers()[2] or b"", np.uint8, len(bins) * width, first).reshape(len(bins), width)


def _margin(trees: Sequence[Tree], binned: np.ndarray) -> np.ndarray:
    out = np.zeros(len(binned))
    for t in trees:
        out += t.margin(binned)
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-z))


def _score(batches: Iterator[pa.RecordBatch], trees: list[Tree], width: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        p = _sigmoid(_margin(trees, _matrix(batch, width)))
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(p)], names=[*names, "probability"])


#: A block holds the rows of one Arrow batch, a column as the bytes of its array: the margin that was written, and that of
#: the trees since then, are apart.
BLOCK = {"__key": np.int64, "__bins": np.uint8, "__label": np.float64, "__margin": np.float64, "__since": np.float64}
_BLOCKS = ", ".join(f"{c} binary" for c in BLOCK)


def _block(arrays: Sequence[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in arrays], names=list(BLOCK))


def _pack(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key, label, margin = (batch.column(c).to_numpy() for c in ("__key", "__label", "__margin"))
        yield _block([key, _matrix(batch, width), label, margin, np.zeros(len(key))])


def _unpacked(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[list[np.ndarray]]:
    """Per block the key, the bins by row, label, margin and margin since."""
    for batch in batches:
        columns = [batch.column(c) for c in BLOCK]
        for i in range(len(batch)):
            key, bins, *rest = (np.frombuffer(c[i].as_buffer(), t) for c, t in zip(columns, BLOCK.values()))
            yield [key, bins.reshape(len(key), width), *rest]


def _add_margin(batches: Iterator[pa.RecordBatch], tree: Tree, width: int, fold: bool) -> Iterator[pa.RecordBatch]:
    for key, binned, label, margin, since in _unpacked(batches, width):
        since = since + tree.margin(binned)
        yield _block([key, binned, label, *((margin + since, np.zeros(len(key))) if fold else (margin, since))])


def gradients(label: np.ndarray, margin: np.ndarray, positive: float) -> tuple[np.ndarray, np.ndarray]:
    """Of the logistic loss, positive rows weighted."""
    p, w = _sigmoid(margin), np.where(label > 0, positive, 1.0)
    return w * (p - label), w * p * (1 - p)


def _histograms(
    batches: Iterator[pa.RecordBatch], grown: Tree, open_nodes: list[int], columns: list[int],
    width: int, bins: int, positive: float, turn: int, share: float,
) -> Iterator[pa.RecordBatch]:
    place = np.full(len(grown.feature), -1)
    place[open_nodes] = np.arange(len(open_nodes))
    cells = np.zeros((2, len(open_nodes) * len(columns) * bins))
    for key, binned, label, margin, since in _unpacked(batches, width):
        # The sample of a tree goes by the row's key and the tree's number.
        key = key.astype(np.uint64) + np.uint64(turn) * np.uint64(0x9E3779B97F4A7C15)
        key = (key ^ (key >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        drawn = ((key ^ (key >> np.uint64(29))) >> np.uint64(11)).astype(float) / (1 << 53) < share
        binned = binned[drawn]
        margin = (margin + since)[drawn]
        g, h = gradients(label[drawn], margin, positive)
        node = place[grown.leaf_of(binned)]
        here = node >= 0
        binned, g, h, node = binned[here], g[here], h[here], node[here]
        for k, c in enumerate(columns):
            at = (node * len(columns) + k) * bins + binned[:, c]
            cells[0] += np.bincount(at, g, cells.shape[1])
            cells[1] += np.bincount(at, h, cells.shape[1])
    at = np.flatnonzero(cells[1])
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(cells[0][at]), pa.array(cells[1][at])], names=["cell", "g", "h"])


def _shrunk(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0)


def split_gains(g: np.ndarray, h: np.ndarray, spec: Penalised) -> np.ndarray:
    """The gain of a cut behind every bin but the last; -inf where a child is too light. Bins are the last axis."""
    left_g, left_h = np.cumsum(g, -1)[..., :-1], np.cumsum(h, -1)[..., :-1]
    all_g, all_h = g.sum(-1, keepdims=True), h.sum(-1, keepdims=True)
    score = lambda a, b: _shrunk(a, spec.l1) ** 2 / (b + spec.l2)
    gain = (score(left_g, left_h) + score(all_g - left_g, all_h - left_h) - score(all_g, all_h)) / 2
    light = (left_h < spec.least_hessian) | (all_h - left_h < spec.least_hessian)
    return np.where(light, -np.inf, gain)


def _leaf(g: float, h: float, spec: Penalised) -> float:
    return float(-spec.rate * _shrunk(np.array(g), spec.l1) / (h + spec.l2))


def _cells(rows: DataFrame, task, shape: tuple[int, ...]) -> np.ndarray:
    """(2, nodes, features, bins): the cells of all tasks, summed by Spark."""
    found = rows.mapInArrow(task, "cell long, g double, h double").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
    out = np.zeros((2, int(np.prod(shape))))
    at = found.column("cell").to_numpy()
    out[0, at], out[1, at] = found.column("g").to_numpy(), found.column("h").to_numpy()
    return out.reshape(2, *shape)


def _grow(rows: DataFrame, turn: int, width: int, bins: int, positive: float, spec: Penalised) -> Tree:
    """One tree, level by level."""
    size = (1 << (spec.depth + 1)) - 1
    tree = Tree([-1] * size, [0] * size, [0.0] * size)
    rng = np.random.default_rng((spec.seed, turn))
    columns = sorted(rng.choice(width, max(1, round(spec.columns * width)), replace=False).tolist())
    nodes = [0]
    for _ in range(spec.depth):
        task = partial(
            _histograms, grown=tree, open_nodes=nodes, columns=columns, width=width, bins=bins,
            positive=positive, turn=turn, share=spec.rows,
        )
        g, h = _cells(rows, task, (len(nodes), len(columns), bins))
        gains, after = split_gains(g, h, spec), []
        # Sums in another order differ in the last digits, which must not choose among equal gains.
        level_gains = np.round(gains / max(float(gains.max()), 1e-300), 9)
        for k, node in enumerate(nodes):
            tree.value[node] = _leaf(g[k, 0].sum(), h[k, 0].sum(), spec)
            best = int(np.argmax(level_gains[k]))
            c, cut = divmod(best, gains.shape[-1])
            if not gains[k, c, cut] > 0:
                continue
            tree.feature[node], tree.cut[node] = columns[c], cut
            for child, part in ((2 * node + 1, slice(None, cut + 1)), (2 * node + 2, slice(cut + 1, None))):
                tree.value[child] = _leaf(g[k, c, part].sum(), h[k, c, part].sum(), spec)
                after.append(child)
        nodes = after
        if not nodes:
            break
    return tree


def prepared(df: DataFrame, model: Boosted, label: str, id_column: str, seed: int) -> DataFrame:
    """(key, bins, label, margin) per labelled row."""
    return df.where(F.col(label).isNotNull()).select(
        id_hash(id_column, seed).alias("__key"), model.binned().alias("__bins"), F.col(label).cast("double").alias("__label"),
        F.lit(0.0).alias("__margin"),
    )


def _written(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "boosting")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fit(
    df: DataFrame, features: Sequence[str], label: str = "is_fraud", id_column: str = "transaction_id",
    spec: Penalised = Penalised(), edges: list[list[float]] | None = None,
) -> Boosted:
    """Fit on the labelled rows of ``df``; positive rows weigh as much together as the others.

    The result does not depend on partitioning but for the last digits of sums. Rows with a null label are left out, null
    and NaN features are in the first bin, and rows that repeat an id are drawn together. Without rows of both classes, or
    without a split that gains, trees are single leaves.
    """
    model = Boosted(list(features), edges or quantile_edges(df, features, spec.bins))
    bins = 1 + max((len(e) for e in model.edges), default=0)
    rows = _written(prepared(df, model, label, id_column, spec.seed))
    n, positives = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("__label"), F.lit(0.0))).first()
    positive = (n - positives) / positives if positives else 1.0
    blocks = rows.mapInArrow(partial(_pack, width=len(features)), _BLOCKS)
    stored = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for turn in range(spec.trees if n else 0):
            tree = _grow(stored, turn, len(features), bins, positive or 1.0, spec)
            model.trees.append(tree)
            if len(model.trees) == spec.trees:
                break
            fold = len(model.trees) % WRITE_EVERY == 0
            before, blocks = stored, stored.mapInArrow(partial(_add_margin, tree=tree, width=len(features), fold=fold), _BLOCKS)
            stored = (_written(blocks) if fold else blocks).persist(StorageLevel.MEMORY_AND_DISK)
            stored.count()
            before.unpersist()
    finally:
        stored.unpersist()
    return model


def root_gains(
    df: DataFrame, features: Sequence[str], label: str = "is_fraud", id_column: str = "transaction_id",
    spec: Penalised = Penalised(rows=1.0, columns=1.0), edges: list[list[float]] | None = None,
) -> DataFrame:
    """(feature, cut, gain): the best first cut of every feature, the least bin of equal ones."""
    model = Boosted(list(features), edges or quantile_edges(df, features, spec.bins))
    bins = 1 + max((len(e) for e in model.edges), default=0)
    rows = prepared(df, model, label, id_column, spec.seed)
    n, positives = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("__label"), F.lit(0.0))).first()
    positive = ((n - positives) / positives if positives else 1.0) or 1.0
    leaf = Tree([-1], [0], [0.0])
    task = partial(
        _histograms, grown=leaf, open_nodes=[0], columns=list(range(len(features))), width=len(features), bins=bins,
        positive=positive, turn=0, share=2.0,
    )
    g, h = _cells(rows.mapInArrow(partial(_pack, width=len(features)), _BLOCKS), task, (1, len(features), bins))
    gains = np.round(split_gains(g, h, spec)[0], 6)
    best = [(c, int(np.argmax(x)), float(x.max())) for c, x in zip(features, gains) if np.isfinite(x).any()]
    return df.sparkSession.createDataFrame(best, "feature string, cut int, gain double")
