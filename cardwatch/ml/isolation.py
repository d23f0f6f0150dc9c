"""Isolation forest, and its combination with a classifier's probability.

Liu, Ting and Zhou, "Isolation Forest" (2008): a tree cuts a small subsample at random values
until its points are alone; points that need few cuts stand out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

#: Subsample per tree, as in the paper.
SUBSAMPLE = 256
_SPAN = 2**31
_NODES = "tree int, feature array<int>, cut array<double>, child array<int>, length array<double>"


def _path_length(n: np.ndarray | float) -> np.ndarray:
    """Mean number of cuts of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 2)
    mean = 2 * (np.log(big - 1) + np.euler_gamma) - 2 * (big - 1) / big
    return np.where(n > 2, mean, np.where(n == 2, 1.0, 0.0))


def _grow(points: np.ndarray, rng: np.random.Generator, limit: int) -> dict[str, list]:
    """One tree as arrays; a leaf has feature -1, the right child follows the left one."""
    feature, cut, child, length = [-1], [0.0], [0], [0.0]
    work = [(0, points, 0)]
    while work:
        node, rows, depth = work.pop()
        wide = np.flatnonzero(np.ptp(rows, axis=0) > 0) if len(rows) > 1 else []
        if depth >= limit or len(wide) == 0:
            length[node] = depth + float(_path_length(len(rows)))
            continue
        f = int(rng.choice(wide))
        low, high = rows[:, f].min(), rows[:, f].max()
        at = float(rng.uniform(low, high))
        left = rows[:, f] <= at
        feature[node], cut[node], child[node] = f, at, len(feature)
        for side in (rows[left], rows[~left]):
            work.append((len(feature), side, depth + 1))
            feature.append(-1)
            cut.append(0.0)
            child.append(0)
            length.append(0.0)
    return {"feature": feature, "cut": cut, "child": child, "length": length}


@dataclass(frozen=True)
class IsolationForest:
    """Fitted trees: at most ``2 * SUBSAMPLE`` nodes each, whatever the table's size."""

    features: tuple[str, ...]
    trees: tuple[dict[str, np.ndarray], ...]
    subsample: int

    def score(self) -> Column:
        """Anomaly score in (0, 1) of the feature columns; near 1 stands out."""
        trees, usual = self.trees, float(_path_length(self.subsample))

        @pandas_udf("double")
        def anomaly(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in batches:
                x = np.column_stack([c.fillna(0).to_numpy(float) for c in columns])
                total = np.zeros(len(x))
                every = np.arange(len(x))
                for tree in trees:
                    node = np.zeros(len(x), dtype=np.int64)
                    open_ = tree["feature"][node] >= 0
                    while open_.any():
                        at, rows = node[open_], every[open_]
                        right = x[rows, tree["feature"][at]] > tree["cut"][at]
                        node[open_] = tree["child"][at] + right
                        open_ = tree["feature"][node] >= 0
                    total += tree["length"][node]
                yield pd.Series(2.0 ** (-total / max(len(trees), 1) / max(usual, 1e-9)))

        return anomaly(*[F.col(c).cast("double") for c in self.features])


def fit_isolation_forest(
    df: DataFrame,
    features: Sequence[str],
    id_column: str = "transaction_id",
    trees: int = 100,
    subsample: int = SUBSAMPLE,
    seed: int = 42,
) -> IsolationForest:
    """Draw a subsample per tree by a hash of the id, and grow the trees side by side.

    The subsample is the method, not a shortcut: about ``trees * subsample`` rows are drawn in
    all, and every row of the table is scored.
    """
    features = list(features)
    n = df.count()

    def draw(salt: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed + salt), F.col(id_column)), F.lit(_SPAN))

    share = min(1.0, trees * subsample / max(n, 1))
    drawn = df.where(draw(0) < int(share * _SPAN)).select(
        (draw(1) % trees).cast("int").alias("tree"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features],
    )
    limit = int(np.ceil(np.log2(max(subsample, 2))))

    def grow(key: tuple[int], points: pd.DataFrame) -> pd.DataFrame:
        rng = np.random.default_rng([seed, key[0]])
        values = points[features].sort_values(features).to_numpy(float)
        return pd.DataFrame([{"tree": key[0], **_grow(values, rng, limit)}])

    rows = drawn.groupBy("tree").applyInPandas(grow, _NODES).orderBy("tree").collect()
    grown = tuple(
        {
            "feature": np.asarray(r["feature"]),
            "cut": np.asarray(r["cut"]),
            "child": np.asarray(r["child"]),
            "length": np.asarray(r["length"]),
        }
        for r in rows
    )
    per_tree = min(subsample, max(2, round(n * share / trees)))
    return IsolationForest(tuple(features), grown, per_tree)


def combined_score(anomaly: Column, probability: Column) -> Column:
    """Mean of anomaly score and classifier probability."""
    return (anomaly + probability) / 2
