"""Document quality by Bradley-Terry pairwise ranking."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranking import ordinals
from ..operators.spread import quantiles
from .common import crc_mod, join_spread, packed, pieces, settle, slices, table, text_of, tidy
from .textstats import NAMES, dense

FOLD = (3, 1)
KNOTS = (0.02, 0.1, 0.25, 0.5, 0.75, 0.9, 0.98)
RIDGE = 1e-3
CHUNK = 1024  # pairs to a row of their table


def matrix(texts: pa.Array) -> np.ndarray:
    parts = [dense(data, off) for _, _, data, off in slices(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, len(NAMES)))


@dataclass
class Model:
    """A document's strength is weights . basis(features): the features, standardised, and hinges at their quantiles."""

    centre: np.ndarray
    scale: np.ndarray
    knots: np.ndarray  # knots x features
    weights: np.ndarray | None
    threshold: float
    share: float

    def basis(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -8, 8)
        return np.concatenate([z, *[np.maximum(z - k, 0) for k in self.knots]], axis=1)

    def strength(self, x: np.ndarray) -> np.ndarray:
        return self.basis(x) @ self.weights

    def score(self, texts: pa.Array) -> np.ndarray:
        """0 to 1: the chance that the document beats one that lies at the threshold."""
        if self.weights is None:
            return np.full(len(texts), self.share)
        return 1 / (1 + np.exp(-np.clip(self.strength(matrix(texts)) - self.threshold, -40, 40)))


def minimise(terms: Callable[[np.ndarray], tuple[float, np.ndarray, np.ndarray]], size: int, ridge: float, steps: int = 60, rate: float = 1.0) -> np.ndarray:
    """Newton's steps, halved while they do not lower the sum, on the mean loss of terms(w) (loss, gradient, second derivatives) + ridge / 2 * w . w."""

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        f, g, h = terms(w)
        return f + ridge / 2 * w @ w, g + ridge * w, h + ridge * np.eye(size)

    w = np.zeros(size)
    f, g, h = at(w)
    for _ in range(steps):
        step, t = np.linalg.solve(h, g), rate
        if g @ step < 1e-10:
            break
        new = at(w - t * step)
        while new[0] > f - 1e-4 * t * (g @ step) and t > 1e-6:
            t /= 2
            new = at(w - t * step)
        w, (f, g, h) = w - t * step, new
    return w


def pair_terms(diff: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Sums over rows of log(1 + exp(-w . row)), of its gradient and of its second derivatives."""
    m = diff @ w
    miss = 1 / (1 + np.exp(np.clip(m, -700, 700)))
    return float(np.logaddexp(0, -m).sum()), -(miss @ diff), (diff * (miss * (1 - miss))[:, None]).T @ diff


def learn_weights(basis: np.ndarray, y: np.ndarray, pairs: int, seed: int = 7, steps: int = 60, ridge: float = RIDGE, rate: float = 1.0) -> np.ndarray:
    """Bradley-Terry on rows at hand: minimises log(1 + exp(-w . (winner - loser))) over drawn pairs of a preferred and another document."""
    rng = np.random.default_rng(seed)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    # each document of the smaller class meets equally many of the other
    win, lose = rng.permutation(np.resize(good, pairs)), rng.permutation(np.resize(bad, pairs))
    diff = basis[win] - basis[lose]
    return minimise(lambda w: tuple(v / pairs for v in pair_terms(diff, w)), basis.shape[1], ridge, steps, rate)


def featured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, x): the features of each row's whole text."""
    bare = docs.select(F.col(id_col).alias("id"), text_of(text_col).cast("string").alias("text"))
    schema = T.StructType([bare.schema["id"], T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for b in (p for whole in batches for p in pieces(whole, 1, 8 << 20)):
            x = matrix(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * len(NAMES), x.ravel())], ["id", "x"])

    return bare.mapInArrow(run, schema)


def all_pairs(rows: DataFrame, bad: int, good: int) -> DataFrame:
    """(chunk, data): pairs of a preferred and another row of rows (rank, y, x), their features one behind the other, CHUNK pairs to a row.

    Each row of the larger class is in one pair, those of the smaller class in equally many (or one more). Ranks have class 0 first.
    """
    many, few, large = max(good, bad), min(good, bad), int(good >= bad)
    spot = F.col("rank") - F.when(F.col("y") == 1, F.lit(bad + 1)).otherwise(F.lit(1))
    side = lambda y: rows.where(F.col("y") == y).withColumn("i", spot)
    left = side(large).select("i", (F.col("i") % few).alias("r"), F.col("x").alias("p"))
    right = side(1 - large).select(F.col("i").alias("r"), F.col("x").alias("q"), (F.lit(many // few) + (F.col("i") < many % few).cast("int")).alias("held"))
    both = join_spread(left, right, "r", "held", many)
    win, lose = ("p", "q") if large else ("q", "p")
    both = both.select(F.floor(F.col("i") / CHUNK).cast("long").alias("chunk"), "i", F.col(win).alias("win"), F.col(lose).alias("lose"))

    def chunk(t: pa.Table) -> pa.Table:
        t = t.sort_by("i").combine_chunks()
        x = np.stack([t[c].combine_chunks().flatten().to_numpy().reshape(-1, len(NAMES)) for c in ("win", "lose")])
        return pa.table({"chunk": t["chunk"][:1], "data": pa.array([x.tobytes()], pa.binary())})

    return both.groupBy("chunk").applyInArrow(chunk, "chunk long, data binary")


def summed(pairs: DataFrame, n: int, model: Model, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The mean over n pairs of what pair_terms sums. A task adds up its own, as whole numbers of 2^-40: the result does not depend on the order."""
    k = len(w)

    def run(batches):
        total = np.zeros(1 + k + k * k, np.int64)
        for b in batches:
            for data in b.column(0):
                win, lose = np.frombuffer(data.as_py(), float).reshape(2, -1, len(NAMES))
                f, g, h = pair_terms(model.basis(win) - model.basis(lose), w)
                total += np.rint(np.concatenate([[f], g, h.ravel()]) / n * 2.0**40).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    got = pairs.select("data").mapInArrow(run, "sums binary").toLocalIterator()
    total = sum((np.frombuffer(r.sums, np.int64) for r in got), np.zeros(1 + k + k * k, np.int64)) / 2.0**40
    return float(total[0]), total[1 : k + 1], total[k + 1 :].reshape(k, k)


@tidy
def fit(docs: DataFrame, labels: DataFrame, fold: tuple[int, int] = FOLD, id_col: str = "doc_id", text_col: str = "text", label: str = "quality") -> Model:
    """Learns from all labelled documents outside the held-out fold; what goes to the driver are sums, quantiles and the weights.

    A pair prefers a document labelled 1 to one labelled 0; each document is in a pair at least. The threshold is the quantile of all
    strengths below which the share of documents labelled 0 lies. Rows with a null id or label are left out; an id labelled twice takes its larger label.
    Without labels, or with one class only, every score is the share of positives (0 without labels).
    """
    inside = lambda d: d.where(F.col(id_col).isNotNull() & (crc_mod(id_col, fold[0]) != fold[1]))
    known = inside(labels.where(F.col(label).isNotNull())).groupBy(F.col(id_col).alias("id")).agg(F.max(label).cast("int").alias("y"))
    rows = featured(inside(docs), id_col, text_col).join(known, "id").select(F.xxhash64("id").alias("h"), "id", "y", "x")
    rows = settle(ordinals(rows, ["y", "h", "id", "x"], "rank").select("rank", "y", "x"))
    exact = lambda c: F.sum(c.cast("decimal(38,12)")).alias("v")
    x = [F.col("x")[i] for i in range(len(NAMES))]
    n, good, *sums = rows.agg(F.count("*"), F.sum("y"), *[exact(c) for c in x], *[exact(c * c) for c in x]).first()
    share = good / n if n else 0.0
    if not n or good in (0, n):
        k = len(NAMES)
        return Model(np.zeros(k), np.ones(k), np.zeros((0, k)), None, 0.0, share)
    mean = [Fraction(v) / n for v in sums[: len(NAMES)]]
    scale = np.sqrt([max(float(Fraction(v) / n - m * m), 0.0) for v, m in zip(sums[len(NAMES) :], mean)])
    model = Model(np.array(mean, float), np.where(scale > 1e-5, scale, 1.0), np.zeros((0, len(NAMES))), None, 0.0, share)
    found = quantiles(rows.select(F.posexplode("x").alias("f", "v")), "f", "v", list(KNOTS)).collect()
    knots = np.zeros((len(KNOTS), len(NAMES)))
    for r in found:
        knots[r.i, r.f] = r.value
    model.knots = np.clip((knots - model.centre) / model.scale, -8, 8)
    pairs, many = settle(all_pairs(rows, n - good, good)), max(good, n - good)
    model.weights = minimise(lambda w: summed(pairs, many, model, w), len(NAMES) * (1 + len(KNOTS)), RIDGE)

    def strengths(batches):
        for b in batches:
            v = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(v), np.int32)), pa.array(model.strength(v))], ["g", "v"])

    model.threshold = quantiles(rows.select("x").mapInArrow(strengths, "g int, v double"), "g", "v", [1 - share]).first().value
    return model


def score(docs: DataFrame, model: Model, out: str = "score", text_col: str = "text") -> DataFrame:
    """All columns of `docs` and the score of each row's whole text in the column `out` (which replaces one of that name).

    A null text scores as an empty one; equal texts score equally; ids are not used and may repeat or be null.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    bare = docs.select(packed(docs, out).alias("row"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([bare.schema["row"], T.StructField("out", T.DoubleType())])

    def run(batches):
        for b in (p for whole in batches for p in pieces(whole, 1, 8 << 20)):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sent.value.score(b.column(1)), pa.float64())], ["row", "out"])

    return bare.mapInArrow(run, schema).select("row.*", F.col("out").alias(out))


def op9_quality(spark, sf_dir: str) -> DataFrame:
    """Per document: held_out, score, predicted."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (crc_mod("doc_id", FOLD[0]) == FOLD[1]).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
