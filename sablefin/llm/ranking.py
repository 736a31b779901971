"""Quality scores by Bradley-Terry pairwise ranking.

One pass turns every whole text into a short feature vector, settled; the text isn't read or shuffled
again. Labels join the features. Weights are learned by logistic loss on the feature differences of
every preference pair, a good and a bad one of all labelled rows: each step of Newton's method is a pass
that sums the rows of like score, and pairs are taken between these sums. All documents are scored from
their features by a JVM expression. The decision threshold is a quantile of all labelled rows' scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sablefin.llm import ranking_kernel as kernel
from sablefin.llm.common import table
from sablefin.session import settle

#: Most steps of Newton's method, and the change of weights that ends it.
STEPS = 25
STILL = 1e-5
#: Score quantiles among which the threshold is chosen.
GRID = 200
#: Scores are shifted so that the chosen quantile lies here.
THRESHOLD = 0.3


def with_features(docs: DataFrame, keep: tuple[str, ...], text: str = "text") -> DataFrame:
    src = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"))

    def run(batches):
        for b in batches:
            x = [kernel.features(t).astype(np.float64) for t in b.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(x, pa.list_(pa.float64()))], names=[*keep, "_x"])

    return src.mapInArrow(run, docs.select(*keep).schema.add("_x", T.ArrayType(T.DoubleType())))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for the fold that isn't learned from: crc32 of the id as text, mod ``folds``, is 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def _arrays(batches):
    """(features, labels) of each batch that has rows."""
    for b in batches:
        if b.num_rows:
            yield b.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1), b.column("_y").to_numpy(zero_copy_only=False)


def _sums_batch(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.int64()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["key", "sums"])


def _add(total: dict[int, np.ndarray], more: dict[int, np.ndarray]) -> None:
    for k, v in more.items():
        total[k] = total[k] + v if k in total else v


def _moments(learned: DataFrame) -> tuple | None:
    """The ``moments`` of all rows: a row per task comes to the driver."""

    def run(batches):
        got = None
        for x, _ in _arrays(batches):
            got = kernel.moments(x) if got is None else kernel.joined(got, kernel.moments(x))
        if got is not None:
            yield pa.RecordBatch.from_arrays([pa.array([got[0]]), *(pa.array([v.tobytes()], pa.binary()) for v in got[1:])], names=["n", "mean", "squares"])

    all_ = None
    for r in learned.mapInArrow(run, "n long, mean binary, squares binary").collect():
        one = (r["n"], np.frombuffer(r["mean"]), np.frombuffer(r["squares"]))
        all_ = one if all_ is None else kernel.joined(all_, one)
    return all_


def _cell_sums(learned: DataFrame, mean: np.ndarray, spread: np.ndarray, w: np.ndarray) -> dict[int, np.ndarray]:
    """``cell_sums`` of all rows: as many as there are cells, a fixed number at most."""
    width = kernel.cell_width(w)

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for x, y in _arrays(batches):
            _add(total, kernel.cell_sums(kernel.scale(x, mean, spread), y, w, width))
        yield _sums_batch(total)

    def merge(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, v in zip(b.column("key").to_pylist(), b.column("sums").to_pylist(), strict=True):
                _add(total, {k: np.frombuffer(v)})
        yield _sums_batch(total)

    schema = "key long, sums binary"
    got = learned.mapInArrow(run, schema).repartition("key").mapInArrow(merge, schema).collect()
    return {r["key"]: np.frombuffer(r["sums"]) for r in got}


def fitted(learned: DataFrame, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Bradley-Terry weights over every pair of a good and a bad row of ``learned``(_y int, _x)."""
    w = np.zeros(len(mean))
    for _ in range(STEPS):
        step = kernel.newton_step(_cell_sums(learned, mean, spread, w), w)
        w = w - step
        if np.abs(step).max() < STILL:
            break
    return np.round(w, 6)  # sums differ in the last bits from run to run


def cut(scored: DataFrame, grid: int = GRID) -> float:
    """The quantile of ``scored``(s, _y), of ``grid`` ones, at which accepting what lies at or above it is right
    most often in the mean of both labels, over all rows.

    Rows fold to one per distinct score first; running counts are taken in slices of the score range.
    """
    spark = scored.sparkSession
    fold = scored.groupBy("s").agg(F.sum("_y").alias("good"), F.sum(1 - F.col("_y")).alias("bad"))
    fold = settle(fold.repartitionByRange("s").withColumn("_p", F.spark_partition_id()), "quality-scores")
    base, goods, bads = [], 0, 0
    for r in sorted(fold.groupBy("_p").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).collect(), key=lambda r: r["_p"]):
        base.append((r["_p"], goods, bads))
        goods, bads = goods + r["good"], bads + r["bad"]
    n = goods + bads
    before = Window.partitionBy("_p").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    under = fold.join(spark.createDataFrame(base, "_p int, _good long, _bad long"), "_p")
    for c in ("good", "bad"):
        under = under.withColumn(f"_{c}", F.col(f"_{c}") + F.coalesce(F.sum(c).over(before), F.lit(0)))
    # a score is the k-th quantile if its rows, numbered from below, include k * n / grid
    k = F.expr(f"((_good + _bad) * {grid} + {n - 1}) div {n}")
    at = under.withColumn("_k", k).where((F.col("_k") < grid) & (F.expr(f"_k * {n} div {grid}") < F.col("_good") + F.col("_bad") + F.col("good") + F.col("bad")))
    right = (goods - F.col("_good")) / float(goods) + F.col("_bad") / float(bads)
    return at.agg(F.max(F.struct(right.alias("right"), (-F.col("s")).alias("low")))["low"]).first()[0] * -1.0


def score(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, held_out, score double, predicted int.

    Learned are all rows labelled 0 or 1 outside the held-out fold. Ids that carry both labels aren't
    learned from; null labels count as none. Without labels of both kinds all scores are ``threshold``
    and all is accepted. Only texts enter a score.
    """
    x = settle(with_features(docs, (doc_id,), text), "quality-features")
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.min(label).alias("_y"), F.max(label).alias("_z"))
    known = known.where((F.col("_y") == F.col("_z")) & ~held_out(F.col("_id"))).select("_id", "_y")
    learned = settle(x.join(known, F.col(doc_id) == F.col("_id")).select(F.col("_y").cast("long").alias("_y"), "_x"), "quality-learned")
    n = len(kernel.FEATURES)
    w, mean, spread, at = np.zeros(n), np.zeros(n), np.ones(n), 0.0

    def total() -> Column:
        out = F.lit(0.0)
        for k in range(n):
            v = (F.col("_x")[k] - float(mean[k])) / float(spread[k])
            out = out + F.greatest(F.lit(-6.0), F.least(F.lit(6.0), v)) * float(w[k])
        return out

    if learned.select("_y").distinct().count() == 2:
        rows, mean, squares = _moments(learned)
        mean, spread = (np.array([float(f"{v:.9g}") for v in a]) for a in (mean, np.maximum(np.sqrt(squares / rows), 1e-6)))
        w = fitted(learned, mean, spread)
        at = cut(learned.select(total().alias("s"), "_y"))
    shift = float(np.log(threshold / (1 - threshold)) - at)
    value = F.lit(1.0) / (F.lit(1.0) + F.exp(-(total() + shift)))
    # a hair below the quantile's own score, which rounding of the sum must not reject
    out = x.select(doc_id, held_out(F.col(doc_id)).alias("held_out"), F.round(value, 9).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op8_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
