"""A quality classifier: random Fourier features, ridge scores, isotonic calibration.

``statistics`` describes a text by some twenty numbers. Standardised, they are
mapped by cosines of random projections, whose inner products approximate a
Gaussian kernel. Each partition sums its part of the normal equations, one row
for each row of the matrix; these are summed again by row, in the order of the
partitions, and the driver solves a system whose size does not depend on the
data. Two folds are summed apart: each one's model scores the other's rows,
what labels those scores meet is counted in fixed bins, and pool-adjacent
violators makes the counts monotone. The model that scores is fitted on both.

Labels are learnt only from rows whose crc32(doc_id as text) mod 3 is not 1.
Inputs of a score are the statistics of the text and nothing else.

Defined results: a null text counts as empty and is scored as such; labels other
than 0 and 1 are left out, and of several labels of a document the largest
counts; a null doc_id has no label and is not held out; repeated rows each get a
row. Without labels of both kinds every score is 0.5. An empty table gives an
empty result.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsforge.llm.common import small_batches, written

#: Random projections, length scale of the kernel in standard deviations, ridge per row.
PROJECTIONS, SCALE, RIDGE, SEED = 192, 4.0, 1e-4, 7
#: Bins of the calibration, over scores from -0.5 to 1.5.
BINS = 2000

_GROUPS = {
    "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digit": b"0123456789", "space": b" \t\r\x0b\x0c", "line": b"\n",
    "stop": b".,;:?'\"-()", "shout": b"!", "bar": b"|", "hash": b"#", "dollar": b"$%", "amp": b"&", "star": b"*", "other": b"@/\\<>[]{}=+_~^`", "wide": bytes(range(128, 256)),
}
_TABLE = np.zeros((256, len(_GROUPS)))
for _i, _chars in enumerate(_GROUPS.values()):
    _TABLE[list(_chars), _i] = 1
#: Numbers in a text's statistics.
WIDTH = len(_GROUPS) + 8


def statistics(text: str) -> np.ndarray:
    """Shares of kinds of bytes, and of lengths and repetitions of words and lines."""
    data = text.encode()
    n = max(1, len(data))
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words, lines = data.split(), data.split(b"\n")
    m = max(1, len(words))
    some = counts[counts > 0] / n
    more = [
        np.log1p(len(data)), np.log1p(len(words)), len(data) / m if words else 0, len(set(words)) / m, sum(map(eq, words, words[1:])) / m,
        np.log1p(len(data) / len(lines)), len(set(lines)) / len(lines), -(some * np.log2(some)).sum(),
    ]
    return np.concatenate([np.sqrt(counts @ _TABLE / n), more])


def _described(batches):
    for batch in batches:
        found = measured(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(found)], names=["doc_id", "x"])


def measured(texts: list[str | None]) -> np.ndarray:
    """The statistics of texts, a row each, in the width that all scores are made of."""
    return np.array([statistics(t or "") for t in texts]).reshape(-1, WIDTH).astype(np.float32)


def _lists(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)), pa.array(rows.reshape(-1)))


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, WIDTH).astype(np.float64)


def described(docs: DataFrame) -> DataFrame:
    """A written table of doc_id and x, the statistics of each document."""
    small_batches(docs.sparkSession)
    return written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_described, "doc_id long, x array<float>"), "statistics")


class Model:
    """Standardisation, projections, weights and calibration: a few hundred numbers."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        self.w = rng.normal(size=(WIDTH, PROJECTIONS)) / SCALE
        self.b = rng.uniform(0, 2 * np.pi, PROJECTIONS)
        self.weights: np.ndarray | None = None
        self.knots, self.values = np.array([0.0, 1.0]), np.array([0.5, 0.5])

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        return np.concatenate([np.ones((len(x), 1)), np.sqrt(2 / PROJECTIONS) * np.cos(z @ self.w + self.b)], axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Calibrated scores; a thousandth follows the ridge score, so that ranks within a step stay."""
        if self.weights is None:
            return np.full(len(x), 0.5)
        raw = self.features(x) @ self.weights
        return np.clip(0.999 * np.interp(raw, self.knots, self.values) + 0.001 * np.clip((raw + 0.5) / 2, 0, 1), 0, 1)


def solve(a: np.ndarray, b: np.ndarray, n: float) -> np.ndarray:
    return np.linalg.solve(a + RIDGE * max(n, 1) * np.eye(len(a)), b)


def isotonic(score: np.ndarray, positive: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the blocks' mean scores and shares of positives, ascending."""
    blocks: list[list[float]] = []
    for s, p, t in zip(score.tolist(), positive.tolist(), total.tolist()):
        blocks.append([s * t, p, t])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([s / t for s, _, t in blocks]), np.array([p / t for _, p, t in blocks])


def fold() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3


def fit(stats: DataFrame, labels: DataFrame) -> Model:
    """A model from the statistics of all documents and the labels (doc_id, quality) of some."""
    marked = labels.filter("quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("double").alias("y"))
    rows = written(stats.withColumn("fold", fold()).filter("fold != 1").join(marked, "doc_id").select("doc_id", "fold", "x", "y"), "labelled")
    moments = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).orderBy("i").collect()
    model = Model(np.array([r.m for r in moments]), np.array([r.s for r in moments])) if moments else Model(np.zeros(WIDTH), np.ones(WIDTH))

    def partial(batches):
        sums = {}
        for batch in batches:
            z, y, f = model.features(_matrix(batch.column("x"))), batch.column("y").to_numpy(), batch.column("fold").to_numpy()
            for k in (0, 2):
                zk, yk = z[f == k], y[f == k]
                total = np.concatenate([zk.T @ zk, (zk.T @ yk)[:, None]], axis=1)
                sums[k] = sums[k] + total if k in sums else total
        part = TaskContext.get().partitionId() if TaskContext.get() else 0
        for k, total in sums.items():
            n = len(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, k, np.int32)), pa.array(np.arange(n, dtype=np.int32)), pa.array(np.full(n, part, np.int32)), pa.array(list(total), pa.list_(pa.float64()))], names=["fold", "i", "part", "sums"])

    def add(group: pa.Table) -> pa.Table:
        group = group.sort_by("part")
        total = np.sum(group.column("sums").combine_chunks().flatten().to_numpy().reshape(group.num_rows, -1), axis=0)
        return pa.table({"fold": group.column("fold")[:1], "i": group.column("i")[:1], "sums": pa.array([total], pa.list_(pa.float64()))})

    if not moments:
        return model
    summed = rows.mapInArrow(partial, "fold int, i int, part int, sums array<double>").groupBy("fold", "i").applyInArrow(add, "fold int, i int, sums array<double>")
    size = PROJECTIONS + 1
    totals = {0: np.zeros((size, size + 1)), 2: np.zeros((size, size + 1))}
    for r in summed.collect():
        totals[r.fold][r.i] = r.sums
    whole = totals[0] + totals[2]
    n, positive = whole[0, 0], whole[0, -1]
    if not 0 < positive < n:
        return model
    weights = {k: solve(t[:, :-1], t[:, -1], t[0, 0]) for k, t in totals.items()}

    def cross(batches):
        for batch in batches:
            z, f = model.features(_matrix(batch.column("x"))), batch.column("fold").to_numpy()
            raw = np.where(f == 0, z @ weights[2], z @ weights[0])
            cell = np.clip(np.floor((raw + 0.5) / 2 * BINS), 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(cell), batch.column("y")], names=["cell", "y"])

    cells = rows.mapInArrow(cross, "cell int, y double").groupBy("cell").agg(F.sum("y").alias("p"), F.count("*").alias("n")).orderBy("cell").collect()
    found = np.array([((r.cell + 0.5) / BINS * 2 - 0.5, r.p, r.n) for r in cells], float)
    model.weights = solve(whole[:, :-1], whole[:, -1], n)
    model.knots, model.values = isotonic(*found.T)
    return model


def score(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of the statistics."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.scores(_matrix(batch.column("x"))))], names=["doc_id", "score"])

    found = stats.mapInArrow(run, "doc_id long, score double")
    return found.select("doc_id", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents whose score is at least ``least``, in one pass over their texts."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            keep = model.scores(measured(batch.column("text").to_pylist()).astype(np.float64)) >= least
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
