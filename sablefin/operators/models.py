"""Anomaly models: gradient-boosted trees in two configurations and an isolation forest."""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sablefin.config import Monitoring
from sablefin.session import ship


class LeakageError(ValueError):
    """A score is better than honest features allow."""


@dataclass(frozen=True)
class Boosting:
    trees: int
    depth: int
    step: float
    subsample: float = 0.8


#: The two supervised configurations: many shallow trees, fewer deeper ones.
SHALLOW, DEEP = Boosting(40, 3, 0.1), Boosting(25, 5, 0.1)


def boosted_scores(train: DataFrame, test: DataFrame, features: list[str], conf: Boosting, key: list[str], seed: int = 7) -> tuple[DataFrame, list[tuple[str, float]]]:
    """Scores of ``test``(key, y) and importances, largest first. Positives weigh as much as negatives do in
    all; the weight comes from training rows only."""
    pos, n = train.agg(F.sum(F.col("y").cast("long")), F.count(F.lit(1))).first()
    weight = (n - pos) / max(pos or 0, 1)
    rows = train.select(*features, F.col("y").cast("double").alias("label"), F.when(F.col("y"), weight).otherwise(1.0).alias("w"))
    join = VectorAssembler(inputCols=features, outputCol="x")
    gbt = GBTClassifier(featuresCol="x", labelCol="label", weightCol="w", maxIter=conf.trees, maxDepth=conf.depth, stepSize=conf.step, subsamplingRate=conf.subsample, seed=seed)
    model = gbt.fit(join.transform(rows))
    out = model.transform(join.transform(test)).select(*key, "y", vector_to_array("probability")[1].alias("score"))
    total = float(model.featureImportances.values.sum()) or 1.0
    ranked = sorted(((f, float(v) / total) for f, v in zip(features, model.featureImportances.toArray(), strict=True)), key=lambda t: (-t[1], t[0]))
    return out, ranked


def _grow(x: np.ndarray, rng: np.random.Generator, depth: int, limit: int) -> tuple:
    """A random isolation tree: (feature, cut, low, high) or the number of rows of a leaf."""
    if depth >= limit or len(x) <= 1:
        return (len(x),)
    low, high = x.min(axis=0), x.max(axis=0)
    open_ = np.flatnonzero(high > low)
    if not len(open_):
        return (len(x),)
    f = int(rng.choice(open_))
    cut = float(rng.uniform(low[f], high[f]))
    left = x[:, f] < cut
    return f, cut, _grow(x[left], rng, depth + 1, limit), _grow(x[~left], rng, depth + 1, limit)


def _unlucky(n: np.ndarray | float):
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, float)
    safe = np.maximum(n, 2.0)
    return np.where(n > 2, 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe, np.where(n == 2, 1.0, 0.0))


def _flat(tree: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A tree as columns by node, level by level: feature, cut, first child and path length. A leaf is its own child under a cut of infinity,
    which nothing reaches; second children stand behind first ones."""
    nodes, at = [(tree, 0)], 0
    feature, cut, child, length = [], [], [], []
    while at < len(nodes):
        node, depth = nodes[at]
        leaf = len(node) == 1
        feature.append(0 if leaf else node[0])
        cut.append(np.inf if leaf else node[1])
        child.append(at if leaf else len(nodes))
        length.append(depth + float(_unlucky(node[0])) if leaf else 0.0)
        if not leaf:
            nodes += [(node[2], depth + 1), (node[3], depth + 1)]
        at += 1
    return np.array(feature, np.int32), np.array(cut), np.array(child, np.int32), np.array(length)


#: Rows that descend a tree together.
_ROWS = 2_048


def _descend(flat: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    """Path length of each row, by a step a level for all rows at once and not a call a node."""
    feature, cut, child, length = flat
    out, width = np.empty(len(x)), x.shape[1]
    for k in range(0, len(x), _ROWS):
        cells = np.ascontiguousarray(x[k : k + _ROWS]).ravel()
        base = np.arange(0, len(cells), width)
        node = np.zeros(len(base), np.int32)
        while True:
            # as the tree was grown: what isn't under the cut, not-a-number too, goes to the second child
            to = child[node]
            to += ~(cells[base + feature[node]] < cut[node]) & (to != node)
            if (to == node).all():
                break
            node = to
        out[k : k + _ROWS] = length[node]
    return out


def _depths(tree: tuple, x: np.ndarray) -> np.ndarray:
    return _descend(_flat(tree), x)


SAMPLE = 256
#: Rows that are sent on at a time.
HELD = 10_000
#: How many rows a tree's candidates are expected to be, in samples; that fewer than one sample come has a chance of e^-200.
_SPARE = 4


def tree_hashes(rows: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """A hash of each row's hash for one tree, as unsigned 64 bits: a sample's members are those with the least."""
    with np.errstate(over="ignore"):
        z = rows.astype(np.uint64) ^ (np.uint64(tree + 1) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
        y = z >> np.uint64(30)
        z ^= y
        z *= np.uint64(0xBF58476D1CE4E5B9)
        np.right_shift(z, np.uint64(27), out=y)
        z ^= y
        z *= np.uint64(0x94D049BB133111EB)
        np.right_shift(z, np.uint64(31), out=y)
        z ^= y
        return z


def grow_tree(x: np.ndarray, tree: int, seed: int) -> tuple:
    """The isolation tree of a sample, its rows in the order of their hashes."""
    return _grow(x, np.random.default_rng([seed, tree]), 0, int(np.ceil(np.log2(max(len(x), 2)))))


def isolation_forest(train: DataFrame, features: list[str], key: list[str], trees: int = 200, sample: int = SAMPLE, seed: int = 7) -> list[tuple]:
    """Isolation trees, each on its own ``sample`` rows of all of ``train``, fewer if it has fewer.

    A tree's sample are the rows with its least hashes of the key. Tasks hash every row for every tree and keep those under a threshold that
    leaves a few samples' worth in all; these are shuffled by tree, and each tree is grown by one task from bounded rows. The
    driver holds the trees, of fixed size, and no row.
    """
    ship(train.sparkSession)
    n = train.count()
    if not n:
        return []
    share = min(1.0, _SPARE * sample / n)
    most = np.uint64(min(int(share * 2.0**64), 2**64 - 1))
    names = ["_tree", "_mark", *features]

    def chosen(batches):
        for b in batches:
            h = b.column("_h").to_numpy()
            at, of, order = [], [], []
            for t in range(trees):
                mark = tree_hashes(h, t, seed)
                some = np.flatnonzero(mark <= most)
                if len(some):
                    at.append(some)
                    of.append(np.full(len(some), t, np.int32))
                    # signed, in the same order
                    order.append((mark[some] ^ np.uint64(1 << 63)).view(np.int64))
            if at:  # one batch of all trees, not one a tree
                rows, of, order = (np.concatenate(c) for c in (at, of, order))
                for k in range(0, len(rows), HELD):
                    take = pa.array(rows[k : k + HELD])
                    yield pa.RecordBatch.from_arrays([pa.array(of[k : k + HELD]), pa.array(order[k : k + HELD]), *(b.column(f).take(take) for f in features)], names=names)

    def grown(g: pd.DataFrame) -> pd.DataFrame:
        some = g.sort_values("_mark", kind="stable").head(sample)
        t = int(g["_tree"].iat[0])
        return pd.DataFrame({"tree": [t], "size": [len(some)], "body": [pickle.dumps(grow_tree(some[features].to_numpy(float), t, seed))]})

    rows = train.select(F.xxhash64(*key, F.lit(seed)).alias("_h"), *(F.col(f).cast("double").alias(f) for f in features))
    schema = "_tree int, _mark long, " + ", ".join(f"`{f}` double" for f in features)
    got = rows.mapInArrow(chosen, schema).groupBy("_tree").applyInPandas(grown, "tree int, size int, body binary")
    return [(r["size"], pickle.loads(bytes(r["body"]))) for r in sorted(got.collect(), key=lambda r: r["tree"])]  # made above, of fixed size


def isolation_scores(train: DataFrame, test: DataFrame, features: list[str], key: list[str], trees: int = 200, sample: int = SAMPLE, seed: int = 7) -> DataFrame:
    """``test``(key, y) with score 2^(-E[h]/c(n)) (Liu et al. 2008), label-free, of ``isolation_forest``. Scoring is distributed. Without
    training rows every score is 1."""
    forest = isolation_forest(train, features, key, trees, sample, seed)
    norm = float(_unlucky(forest[0][0])) if forest else 1.0
    held = train.sparkSession.sparkContext.broadcast(([_flat(t) for _, t in forest], norm or 1.0))  # of fixed size: trees x sample nodes

    def run(parts):
        forest, norm = held.value
        for p in parts:
            x = p[features].to_numpy(float)
            h = np.mean([_descend(t, x) for t in forest], axis=0) if forest and len(x) else np.zeros(len(x))
            yield pd.DataFrame({**{k: p[k] for k in key}, "y": p["y"], "score": 2.0 ** (-h / norm)})

    return test.select(*key, "y", *features).mapInPandas(run, test.select(*key, "y").schema.add("score", "double"))


def tripwire(auc: float, supervised: bool = True, cfg: Monitoring | None = None) -> str:
    """'ok' or 'weak'; raises LeakageError above the ceiling."""
    cfg = cfg or Monitoring()
    ceiling = cfg.supervised_ceiling if supervised else cfg.unsupervised_ceiling
    if auc > ceiling:
        raise LeakageError(f"ROC-AUC {auc:.4f} is above {ceiling}: a feature leaks the label")
    return "weak" if auc < cfg.floor_warning else "ok"
