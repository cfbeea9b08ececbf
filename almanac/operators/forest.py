"""Isolation forest (Liu, Ting and Zhou, 2008) as Spark jobs.

Every tree is grown from its own small sample, so fitting shuffles trees x sample rows whatever
the table size. The grown trees are a small table that every scoring task receives.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

EULER_GAMMA = 0.5772156649015329
NO_SPREAD = 1e-7  # an input that varies by less of its deviation is not split on

NODES = T.StructType(
    [
        T.StructField("tree", T.IntegerType()),
        T.StructField("node", T.IntegerType()),  # heap order: children of i are 2i + 1 and 2i + 2
        T.StructField("feature", T.IntegerType()),  # -1 on leaves
        T.StructField("threshold", T.DoubleType()),  # at most this goes left
        T.StructField("size", T.IntegerType()),
        T.StructField("depth", T.IntegerType()),
    ]
)


@dataclass(frozen=True)
class ForestSize:
    """Trees, rows per tree, seed."""

    trees: int = 300
    sample: int = 256
    seed: int = 42

    def depth(self, per_tree: int) -> int:
        """How deep trees grow that see ``per_tree`` rows, fewer than ``sample`` only if the table has no more."""
        return max(1, math.ceil(math.log2(max(2, min(self.sample, per_tree)))))


def average_path(n: float) -> float:
    """Mean depth of an unsuccessful search among ``n`` values."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


def share_of(*columns) -> Column:
    """A hash of the columns, joined as text, as a number in [0, 1): 52 bits of an MD5, which other engines have too."""
    text = F.concat_ws("|", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def node_share(*parts: int) -> float:
    """``share_of`` of whole numbers, outside of a query."""
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:13], 16) / (1 << 52)


# How many more rows than needed are drawn for a tree, so that every tree is filled.
SPARE = 1.6


def tree_samples(
    df: DataFrame, key: Sequence[str], n_rows: int, size: ForestSize, extra: Sequence[str]
) -> DataFrame:
    """``size.sample`` rows for every tree (all rows of a smaller table), drawn by key hash.

    Trees draw independently: each takes a row with probability p, a little more than it needs, and keeps the rows
    of least hash. From one tree that holds a row to the next it is a geometric jump, so a row costs one hash to find
    its first tree, which most rows of a large table do not have, and one for each tree it is in. The draw depends on
    the keys alone, which must be unique, not on partitioning.
    """
    rows = df.select(*key, *extra)
    every = F.sequence(F.lit(0), F.lit(size.trees - 1))
    p = min(1.0, SPARE * size.sample / max(n_rows, 1))
    if p < 1.0:
        seed = F.lit(size.seed)
        passed_over = lambda u: F.floor(F.log1p(-u) / F.lit(math.log1p(-p)))
        none = math.exp(size.trees * math.log1p(-p))  # in no tree at all
        rows = rows.withColumn("_u", share_of(seed, *key)).filter(F.col("_u") < F.lit(1.0 - none))

        def step(found, _):
            after = found["tree"] + 1 + passed_over(share_of(seed, found["tree"], *key))
            taken = F.concat(found["taken"], F.array(found["tree"].cast("int")))
            return F.when(found["tree"] < size.trees, F.struct(taken.alias("taken"), after.alias("tree"))).otherwise(found)

        start = F.struct(F.array().cast("array<int>").alias("taken"), F.least(passed_over(F.col("_u")), F.lit(size.trees - 1)).alias("tree"))
        every = F.aggregate(every, start, step, lambda found: found["taken"])
    drawn = rows.withColumn("tree", F.explode(every)).withColumn("_draw", share_of(F.lit(size.seed + 1), "tree", *key))
    order = Window.partitionBy("tree").orderBy("_draw", *key)
    ranked = drawn.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= size.sample)
    return ranked.select(*key, *extra, "tree", "_draw", "_rank")


def grow_trees(
    samples: DataFrame, values: str, scales: Sequence[float], size: ForestSize, per_tree: int
) -> DataFrame:
    """One node table row per node; ``values`` is an array column of the model inputs.

    Splits do not depend on the unit of an input; ``scales`` (deviations) only tell which inputs
    vary at all. A node's input and threshold follow from a hash of seed, tree and node, so that the same trees can
    be grown anywhere.
    """
    seed, limit, least = size.seed, size.depth(per_tree), NO_SPREAD * np.asarray(scales)

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_rank")
        tree = int(rows["tree"].iloc[0])
        x = np.array(rows[values].tolist(), dtype=np.float64)
        out = []
        todo = [(0, 0, np.arange(len(x)))]
        while todo:
            node, depth, at = todo.pop()
            low, high = x[at].min(axis=0), x[at].max(axis=0)
            splittable = np.flatnonzero(high - low > least)
            if depth == limit or len(at) <= 1 or len(splittable) == 0:
                out.append((tree, node, -1, 0.0, len(at), depth))
                continue
            feature = int(splittable[int(node_share(seed, tree, node, 0) * len(splittable))])
            threshold = float(low[feature] + node_share(seed, tree, node, 1) * (high[feature] - low[feature]))
            left = x[at, feature] <= threshold
            out.append((tree, node, feature, threshold, len(at), depth))
            todo.append((2 * node + 2, depth + 1, at[~left]))
            todo.append((2 * node + 1, depth + 1, at[left]))
        return pd.DataFrame(out, columns=["tree", "node", "feature", "threshold", "size", "depth"])

    return samples.select("tree", "_rank", values).groupBy("tree").applyInPandas(grow, NODES)


def _packed(nodes: DataFrame, trees: int, deep: int):
    """The node table (at most trees x 2^(depth+1) rows) as arrays for scoring.

    Trees are completed to full depth: below a leaf every row goes left, and the leaf's path
    length waits at the bottom.
    """
    inner, bottom = 2**deep - 1, 2**deep
    feature = np.zeros((trees, inner), dtype=np.int64)
    threshold = np.full((trees, inner), np.inf, dtype=np.float64)
    path = np.zeros((trees, bottom), dtype=np.float64)
    for tree, node, f, cut, n, depth in nodes.select(*NODES.names).collect():
        if f >= 0:
            feature[tree, node], threshold[tree, node] = f, cut
            continue
        while node < inner:
            node = 2 * node + 1
        path[tree, node - inner] = depth + average_path(n)
    return feature, threshold, path


def with_path_score(df: DataFrame, nodes: DataFrame, inputs: Sequence, size: ForestSize, per_tree: int, name: str):
    """Add the isolation score in (-1, 0): the lower, the easier a row is set apart.

    ``inputs`` are the model's value expressions in training order; ``per_tree`` is the number of
    rows a tree has seen. Only the inputs go to Python, the other columns stay in the JVM.
    """
    spark = df.sparkSession
    depth, trees, scale = size.depth(per_tree), size.trees, average_path(per_tree) or 1.0
    packed = spark.sparkContext.broadcast(_packed(nodes, trees, depth))

    @F.pandas_udf(T.DoubleType())
    def score(*columns: pd.Series) -> pd.Series:
        feature, threshold, path = packed.value
        inner = feature.shape[1]
        x = np.column_stack([c.to_numpy(dtype=np.float64) for c in columns])
        total = np.zeros(len(x))
        for start in range(0, len(x), 4096):  # the working arrays stay in cache
            part = np.ascontiguousarray(x[start : start + 4096].T)  # one line per feature
            n = part.shape[1]
            flat, row, line = part.ravel(), np.arange(n), feature * n
            for t in range(trees):
                # All rows read one feature at the root; deeper levels gather.
                node = 1 + (part[feature[t, 0]] > threshold[t, 0]).astype(np.int64)
                for _ in range(depth - 1):
                    cell = line[t].take(node)
                    cell += row
                    goes_right = flat.take(cell) > threshold[t].take(node)
                    node *= 2
                    node += 1
                    node += goes_right
                total[start : start + n] += path[t].take(node - inner)
        return pd.Series(-np.exp2(-(total / trees) / scale))

    return df.withColumn(name, score(*inputs))
