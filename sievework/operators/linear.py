"""Linear classifiers over sparse vectors, any number of them in the same scans.

Several problems lie side by side: every row belongs to one of them, and each has its own stretch of one long
weight vector. A scan gives losses and gradients, or the product of the Hessians with a vector, of all
problems at once, summed up by stretches of the vector in Spark. The solver is Newton's method in a trust
region with conjugate gradients, in step for all problems; those that are done take no part in a scan.

The more rows, the further the curvatures along frequent and rare features lie apart, and the more steps conjugate
gradients take. They are therefore measured by the products of the HEAD features of the largest squares with each
other, and by the squares of the others, which two scans add up before the first step. That steers the steps only:
losses, gradients and the test for the end are those of all rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel
from pyspark.ml import Estimator
from pyspark.ml.classification import LinearSVCModel, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.ml.util import Identifiable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.session import cut_lineage

CHUNK = 1 << 16                 # numbers of the weight vector that one task sums up
ENTRIES = 1 << 20               # entries of the vectors of a batch
HEAD, HEAD_ROWS = 256, 4096     # features of a problem whose products with each other are known, and rows that a task multiplies at once
LOGISTIC, SQUARED_HINGE = "logistic", "squared_hinge"


# -- sparse rows ----------------------------------------------------------------------------------

def flat_vectors(column: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and values that are not zero of a batch of ML vectors, sparse or dense, and the bounds of each."""
    values = column.field("values")
    bounds = values.offsets.to_numpy().astype(np.int64)
    bounds, x = bounds - bounds[0], values.flatten().to_numpy()
    owner = np.repeat(np.arange(len(column)), np.diff(bounds))
    places = np.arange(len(x)) - bounds[owner]
    sparse = column.field("type").to_numpy(zero_copy_only=False) == 0
    places[sparse[owner]] = column.field("indices").flatten().to_numpy()
    kept = x != 0
    return places[kept], x[kept], np.append(0, np.cumsum(np.bincount(owner[kept], minlength=len(column))))


def _sparse(batches, kept: list[str]):
    for batch in batches:
        places, values, bounds = flat_vectors(batch.column("features"))
        lists = lambda v, kind: pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(v, kind))
        vectors = batch.column("features")
        width = pc.coalesce(vectors.field("size"), pc.list_value_length(vectors.field("values")))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), lists(places, pa.int32()), lists(values, pa.float64()), width], names=[*kept, "places", "x", "width"])


def sparse_rows(df: DataFrame, features: str, kept: Sequence[str]) -> DataFrame:
    """``kept`` columns, and the vectors as arrays ``places`` and ``x`` and their ``width``."""
    rows = df.select(*kept, F.col(features).alias("features"))
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.drop("features").schema.fields]
    return rows.mapInArrow(partial(_sparse, kept=list(kept)), ", ".join([*kinds, "places array<int>", "x array<double>", "width int"]))


def _packed(batches):
    for batch in batches:
        bounds = batch.column("places").offsets.to_numpy().astype(np.int64)
        ends, at = bounds[1:] - bounds[0], 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(int(np.searchsorted(ends, before + ENTRIES, "right")), at + 1)
            part = pa.RecordBatch.from_arrays([pa.concat_arrays([c.slice(at, to - at)]) for c in batch.columns], names=batch.schema.names)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema) as writer:
                writer.write_batch(part)
            yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["batch"])
            at = to


def kept_for_scans(rows: DataFrame) -> RDD:
    """Rows that many scans read, written once: batches of at most ENTRIES entries or one row, dealt evenly over the cores.

    A scan is then one plain job over finished arrays, without a plan to make or rows to convert.
    """
    even = rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, 1))
    return cut_lineage(even.mapInArrow(_packed, "batch binary")).rdd.map(_bytes).persist(StorageLevel.MEMORY_AND_DISK)


def _bytes(row) -> bytes:
    return bytes(row[0])


def opened(parts):
    """The batches of a task of :func:`kept_for_scans`."""
    for part in parts:
        yield pa.ipc.open_stream(part).read_next_batch()


def lists(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, values and owners of the sparse rows of a batch."""
    bounds = batch.column("places").offsets.to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
    return batch.column("places").flatten().to_numpy().astype(np.int64), batch.column("x").flatten().to_numpy(), owner


def chunked(total: np.ndarray):
    """A task's sums as (chunk, numbers); chunks of zeros are left out."""
    for k in range(0, len(total), CHUNK):
        part = total[k:k + CHUNK]
        if part.any():
            yield k // CHUNK, part


def summed(parts: RDD, size: int) -> np.ndarray:
    """The sum of all tasks' vectors: each chunk is added up by a task of its own."""
    out = np.zeros(size)
    for k, part in parts.reduceByKey(np.add, min(-(-size // CHUNK), parts.getNumPartitions())).collect():
        out[k * CHUNK:k * CHUNK + len(part)] = part
    return out


# -- the scans ------------------------------------------------------------------------------------

@dataclass
class Problems:
    """``rows`` (problem, y of -1 or 1, weight, places, x); problem k owns w[bounds[k]:bounds[k + 1]], its intercept last."""

    rows: RDD
    bounds: np.ndarray
    loss: str

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def scan(self, w: np.ndarray, active: np.ndarray, direction: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(losses and curvatures, gradient) at ``w``, or (zeros, Hessian times ``direction``); a curvature is that along the intercept."""
        total = self.total(_sums, (w, active, direction, self.bounds, self.loss), len(w) + 2 * len(self))
        return total[len(w):].reshape(2, -1), total[:len(w)]

    def total(self, sums, state, size: int) -> np.ndarray:
        """What ``sums`` makes of the rows of each task, added up."""
        shared = self.rows.context.broadcast(state)
        out = summed(self.rows.mapPartitions(partial(sums, state=shared)), size)
        shared.unpersist()
        return out

    def scale(self, penalty: np.ndarray) -> Scale:
        """How the rows stretch the weights of each problem."""
        squares = self.total(_squares, self.bounds, int(self.bounds[-1]))
        heads = [a + np.sort(np.argsort(-squares[a:b], kind="stable")[:HEAD]) for a, b in zip(self.bounds[:-1], self.bounds[1:])]
        slot = np.full(len(squares), -1, np.int32)
        for head in heads:
            slot[head] = np.arange(len(head))
        sizes = np.array([len(h) for h in heads])
        ends = np.append(0, np.cumsum(sizes * sizes))
        products = self.total(_products, (slot, self.bounds, sizes, ends), int(ends[-1]))
        return Scale(squares, heads, [products[a:b].reshape(n, n) for a, b, n in zip(ends[:-1], ends[1:], sizes)], self.bounds, penalty)


def inverse(a: np.ndarray) -> np.ndarray:
    """Of a small positive definite matrix, by sweeps. The library's own was seen to hang on a driver; the cause is not known."""
    a = a.copy()
    for k in range(len(a)):
        pivot, row, column = a[k, k], a[k] / a[k, k], a[:, k].copy()
        a -= column[:, None] * row
        a[k], a[:, k], a[k, k] = row, -column / pivot, 1 / pivot
    return a


class Scale:
    """A matrix like the Hessian of each problem, with an inverse that is quickly applied: whole between the features of
    ``heads``, diagonal elsewhere. ``at`` sets the mean curvature of each problem's rows."""

    def __init__(self, squares: np.ndarray, heads: list[np.ndarray], products: list[np.ndarray], bounds: np.ndarray, penalty: np.ndarray):
        self.squares, self.heads, self.products, self.bounds, self.penalty = squares, heads, products, bounds, penalty
        self.weight = np.maximum(squares[bounds[1:] - 1], 1e-300)       # of all rows, the squares of the intercept

    def at(self, curvature: np.ndarray) -> Scale:
        mean = np.maximum(curvature / self.weight, 1e-6)
        self.diagonal = np.maximum(np.repeat(mean, np.diff(self.bounds)) * self.squares + self.penalty, 1e-12)
        self.blocks = []
        for m, head, product in zip(mean, self.heads, self.products):
            block = m * product
            block[np.diag_indices(len(head))] = self.diagonal[head] * (1 + 1e-9)
            self.blocks.append((block, inverse(block)))
        return self

    def times(self, v: np.ndarray, inverted: bool = False) -> np.ndarray:
        out = v / self.diagonal if inverted else v * self.diagonal
        for head, block in zip(self.heads, self.blocks):
            out[head] = np.einsum("ij,j->i", block[inverted], v[head])
        return out


def _widths(batches):
    for batch in opened(batches):
        found = pa.table([batch.column("problem"), batch.column("width")], names=["problem", "width"]).group_by("problem").aggregate([("width", "max")])
        yield from zip(found.column("problem").to_pylist(), found.column("width_max").to_pylist())


def _sums(batches, state):
    w, active, direction, bounds, loss = state.value
    out, losses, curves, last = np.zeros(len(w)), np.zeros(len(bounds) - 1), np.zeros(len(bounds) - 1), bounds[1:] - 1
    for batch in opened(batches):
        batch = batch.filter(pa.array(active[batch.column("problem").to_numpy()]))
        if not batch.num_rows:
            continue
        own = batch.column("problem").to_numpy()
        y, c = batch.column("y").to_numpy(), batch.column("weight").to_numpy()
        places, x, owner = lists(batch)
        places = places + bounds[own][owner]
        along = lambda v: np.bincount(owner, x * v[places], batch.num_rows) + v[last[own]]
        margin = y * along(w)
        if loss == LOGISTIC:
            s = np.exp(-np.logaddexp(0, margin))
            value, slope, curve = np.logaddexp(0, -margin), -y * s, s * (1 - s)
        else:
            short = np.maximum(1 - margin, 0)
            value, slope, curve = short * short, -2 * y * short, 2.0 * (short > 0)
        if direction is None:
            losses += np.bincount(own, c * value, len(losses))
            curves += np.bincount(own, c * curve, len(losses))
            r = c * slope
        else:
            r = c * curve * along(direction)
        out += np.bincount(places, x * r[owner], len(w))
        out[last] += np.bincount(own, r, len(losses))
    yield from chunked(np.concatenate([out, losses, curves]))


def _squares(batches, state):
    bounds = state.value
    out, last = np.zeros(int(bounds[-1])), bounds[1:] - 1
    for batch in opened(batches):
        own, c = batch.column("problem").to_numpy(), batch.column("weight").to_numpy()
        places, x, owner = lists(batch)
        out += np.bincount(places + bounds[own][owner], c[owner] * x * x, len(out))
        out[last] += np.bincount(own, c, len(last))
    yield from chunked(out)


def _products(batches, state):
    slot, bounds, sizes, ends = state.value
    out = np.zeros(int(ends[-1]))
    for batch in opened(batches):
        own, root = batch.column("problem").to_numpy(), np.sqrt(batch.column("weight").to_numpy())
        places, x, owner = lists(batch)
        at = slot[places + bounds[own][owner]]
        at, x, owner = at[at >= 0], (x * root[owner])[at >= 0], owner[at >= 0]
        inside = np.append(0, np.cumsum(np.bincount(owner, minlength=batch.num_rows)))
        for k in np.unique(own):
            rows, n, middle = np.flatnonzero(own == k), sizes[k], slot[bounds[k + 1] - 1]
            for some in np.split(rows, np.arange(HEAD_ROWS, len(rows), HEAD_ROWS)):
                counts = inside[some + 1] - inside[some]
                entries = np.repeat(inside[some] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
                block = np.zeros((len(some), n))
                block[np.repeat(np.arange(len(some)), counts), at[entries]] = x[entries]
                if middle >= 0:
                    block[:, middle] = root[some]
                out[ends[k]:ends[k + 1]] += (block.T @ block).ravel()
    yield from chunked(out)


@dataclass
class Solution:
    weights: np.ndarray
    objective: np.ndarray       # of each problem
    residual: np.ndarray        # norm of the gradient, as a share of that at zero
    scans: int


def minimise(problems: Problems, penalty: np.ndarray, tolerance: float = 1e-4, steps: int = 100, inner: int = 60) -> Solution:
    """The weights with the least weighted loss plus half the penalised squares, of every problem."""
    starts, sizes = problems.bounds[:-1], np.diff(problems.bounds)
    seg = lambda v: np.add.reduceat(v, starts)
    wide = lambda v: np.repeat(v, sizes)
    norm = lambda v: np.sqrt(seg(v * v))
    n = len(problems)
    w, active, scans = np.zeros(int(problems.bounds[-1])), np.ones(n, bool), 3
    (f, bent), g = problems.scan(w, active)
    scale = problems.scale(penalty).at(bent)
    start = np.maximum(norm(g), 1e-300)
    radius, active = np.sqrt(np.maximum(seg(g * scale.times(g, inverted=True)), 1e-300)), norm(g) > 0
    for step in range(steps):
        if not active.any():
            break
        s, r = np.zeros_like(w), np.where(wide(active), -g, 0.0)
        z = scale.times(r, inverted=True)
        d, rz = z.copy(), seg(r * z)
        goal = 0.1 * np.sqrt(rz)
        going, edge = active.copy(), np.zeros(n, bool)
        for _ in range(inner):
            going &= np.sqrt(np.maximum(rz, 0)) > goal
            if not going.any():
                break
            d[~wide(going)] = 0
            hd = problems.scan(w, going, d)[1] + penalty * d
            scans += 1
            curve = np.where(going, seg(d * hd), 1.0)
            ahead = np.where(going, rz / np.maximum(curve, 1e-300), 0.0)
            # Lengths are those that the scale gives.
            md, ms = scale.times(d), scale.times(s)
            dd, sd, ss = seg(d * md), seg(s * md), seg(s * ms)
            beyond = going & (ss + 2 * ahead * sd + ahead * ahead * dd >= radius ** 2)
            to_edge = (-sd + np.sqrt(np.maximum(sd * sd + dd * (radius ** 2 - ss), 0))) / np.maximum(dd, 1e-300)
            ahead = np.where(beyond, to_edge, ahead)
            s, r = s + wide(ahead) * d, r - wide(ahead) * hd
            edge |= beyond
            going &= ~beyond
            z = scale.times(r, inverted=True)
            now = seg(r * z)
            d, rz = z + wide(np.where(going, now / np.maximum(rz, 1e-300), 0.0)) * d, now
        trial = w + s
        (loss, curvature), slope = problems.scan(trial, active)
        scans += 1
        f_new, g_new = loss + 0.5 * seg(penalty * trial * trial), slope + penalty * trial
        expected, got = -0.5 * (seg(g * s) - seg(s * r)), f - f_new
        ratio = np.where(expected > 0, got / np.maximum(expected, 1e-300), 0.0)
        length = np.sqrt(np.maximum(seg(s * scale.times(s)), 0))
        radius = np.where(ratio < 0.25, 0.25 * length, np.where((ratio > 0.75) & edge, 2 * radius, radius))
        better = active & (got > 1e-4 * expected)
        w, g, f = np.where(wide(better), trial, w), np.where(wide(better), g_new, g), np.where(better, f_new, f)
        bent = np.where(better, curvature, bent)
        scale.at(bent)
        # At the precision of doubles no step helps any more.
        active &= (norm(g) > tolerance * start) & (expected > 1e-14 * np.abs(f)) & (radius > 0)
    return Solution(w, f, norm(g) / start, scans)


# -- estimators -----------------------------------------------------------------------------------

class NewtonClassifier(Estimator):
    """A linear classifier: C times the weighted loss plus half the squared weights.

    The logistic loss leaves the intercept free, the squared hinge penalises it, as the usual solvers do.
    It fits to the built-in model of its kind.
    """

    def __init__(self, loss: str = LOGISTIC, c: float = 1.0, features: str = "features", label: str = "bid", weight: str = "weight"):
        super().__init__()
        self.loss, self.c, self.features, self.label, self.weight = loss, c, features, label, weight

    def _fit(self, dataset):
        return self.fit_many([dataset])[0]

    def fit_many(self, frames: Sequence[DataFrame]) -> list:
        """The models of several frames, fitted in the same scans."""
        parts = []
        for k, frame in enumerate(frames):
            y = F.when(F.col(self.label) == 1, 1.0).otherwise(-1.0).alias("y")
            parts.append(frame.select(F.lit(k).alias("problem"), y, (F.col(self.weight) * self.c).alias("weight"), F.col(self.features).alias("features")))
        rows = kept_for_scans(sparse_rows(reduce(DataFrame.unionByName, parts), "features", ["problem", "y", "weight"]))
        found = dict(rows.mapPartitions(_widths).reduceByKey(max, 1).collect())
        widths = [found.get(k, 0) for k in range(len(frames))]
        bounds = np.append(0, np.cumsum(np.array(widths) + 1)).astype(np.int64)
        penalty = np.ones(int(bounds[-1]))
        if self.loss == LOGISTIC:
            penalty[bounds[1:] - 1] = 0
        solution = minimise(Problems(rows, bounds, self.loss), penalty)
        rows.unpersist()
        out = []
        for k in range(len(frames)):
            own = solution.weights[bounds[k]:bounds[k + 1]]
            model = self.model(own[:-1], float(own[-1]))
            model.objective, model.residual, model.scans = float(solution.objective[k]), float(solution.residual[k]), solution.scans
            out.append(model)
        return out

    def model(self, weights: np.ndarray, intercept: float):
        from pyspark import SparkContext

        context = SparkContext._active_spark_context
        wrapper, name = (LogisticRegressionModel, "LogisticRegressionModel") if self.loss == LOGISTIC else (LinearSVCModel, "LinearSVCModel")
        uid = f"{name}_{Identifiable().uid[-12:]}"
        java = getattr(context._jvm.org.apache.spark.ml.classification, name)(uid, _py2java(context, Vectors.dense(weights)), intercept)
        model = wrapper(java)
        model._resetUid(uid)
        return model.setFeaturesCol(self.features)
