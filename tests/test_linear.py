"""The solver of linear classifiers against a plain one, many problems at once."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from sievework.operators import linear


def plain(x, y, c, loss):
    """Newton's method with the whole Hessian."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.ones(x.shape[1])
    if loss == linear.LOGISTIC:
        penalty[-1] = 0
    w = np.zeros(x.shape[1])

    def at(w):
        margin = y * (x @ w)
        if loss == linear.LOGISTIC:
            s = np.exp(-np.logaddexp(0, margin))
            value, slope, curve = np.logaddexp(0, -margin), -y * s, s * (1 - s)
        else:
            short = np.maximum(1 - margin, 0)
            value, slope, curve = short ** 2, -2 * y * short, 2.0 * (short > 0)
        return (c * value).sum() + (penalty * w * w).sum() / 2, x.T @ (c * slope) + penalty * w, (x * (c * curve)[:, None]).T @ x + np.diag(penalty)

    for _ in range(200):
        f, g, h = at(w)
        step = np.linalg.lstsq(h, g, rcond=None)[0]
        size = 1.0
        while at(w - size * step)[0] > f and size > 1e-10:
            size /= 2
        w = w - size * step
    return w, at(w)[0]


@pytest.mark.parametrize("loss", [linear.LOGISTIC, linear.SQUARED_HINGE])
def test_many_fits_equal_the_plain_solution(spark, loss):
    rng = np.random.default_rng(4)
    frames, want = [], []
    for k, (n, d) in enumerate([(80, 6), (40, 11), (60, 3)]):
        x = rng.normal(size=(n, d)) * (rng.random((n, d)) < 0.5)
        y = np.where(x[:, 0] + rng.normal(size=n) > 0.3, 1.0, -1.0)
        c = rng.random(n) + 0.1
        want.append(plain(x, y, c * 2.0, loss))
        rows = [(int(b > 0), float(u), Vectors.dense(r) if i % 3 else Vectors.sparse(d, [(j, v) for j, v in enumerate(r) if v])) for i, (r, b, u) in enumerate(zip(x, y, c))]
        frames.append(spark.createDataFrame(rows, ["bid", "weight", "features"]))
    models = linear.NewtonClassifier(loss, c=2.0).fit_many(frames)
    for model, (w, objective) in zip(models, want):
        assert abs(model.objective - objective) <= 1e-5 * objective and model.residual < 2e-4
        assert np.allclose([*model.coefficients.toArray(), model.intercept], w, atol=1e-2)
    assert models[0].transform(frames[0]).select("rawPrediction", "prediction").count() == 80


def test_flat_vectors():
    import pyarrow as pa
    kind = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])
    rows = [{"type": 0, "size": 5, "indices": [1, 4], "values": [2.0, 0.0]}, {"type": 1, "size": None, "indices": None, "values": [0.0, 3.0]}, {"type": 0, "size": 5, "indices": [], "values": []}]
    places, values, bounds = linear.flat_vectors(pa.array(rows, kind))
    assert places.tolist() == [1, 1] and values.tolist() == [2.0, 3.0] and bounds.tolist() == [0, 1, 2, 2]


def test_scans_read_packed_batches_on_every_core(spark):
    """The rows of a fit are packed once, bounded in entries and dealt over the cores; a scan adds them all up."""
    rows = spark.range(400).selectExpr("0 problem", "1.0D y", "1.0D weight", "array(int(id % 7), 8) places", "array(1.0D, double(id)) x", "9 width")
    kept = linear.kept_for_scans(rows)
    sizes = kept.mapPartitions(lambda parts: [sum(b.num_rows for b in linear.opened(parts))]).collect()
    assert sum(sizes) == 400 and sum(s > 0 for s in sizes) >= min(2, spark.sparkContext.defaultParallelism)

    def dense(parts):
        out = np.zeros(9)
        for batch in linear.opened(parts):
            places, x, _owner = linear.lists(batch)
            out += np.bincount(places, x, 9)
        yield from linear.chunked(out)

    total = linear.summed(kept.mapPartitions(dense), 9)
    assert total[8] == sum(range(400)) and total[:7].sum() == 400
    kept.unpersist()


def test_packed_batches_are_bounded(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(linear, "ENTRIES", 5)
    batch = pa.RecordBatch.from_pydict({"places": [[0]] * 3, "x": [[1.0]] * 3}).slice(1)
    long = pa.RecordBatch.from_pydict({"places": [list(range(9)), [1, 2], [3, 4], [5, 6]], "x": [[1.0] * 9, [1.0] * 2, [1.0] * 2, [1.0] * 2]})
    parts = [b.as_py() for out in linear._packed([batch, long]) for b in out.column("batch")]
    assert [b.num_rows for b in linear.opened(parts)] == [2, 1, 2, 1]


@pytest.mark.parametrize("loss", [linear.LOGISTIC, linear.SQUARED_HINGE])
def test_frequent_and_rare_features_need_few_scans(spark, loss):
    """Scans do not multiply where some features are in every row, always together, and others in a few."""
    rng = np.random.default_rng(8)
    n, rare = 1500, 100
    group, odd = rng.integers(0, 4, n), rng.integers(0, rare, n)
    y = rng.random(n) < 0.15 + 0.1 * group + 0.3 * (odd % 3 == 0)
    rows = [
        (int(b), 300.0, Vectors.sparse(6 + rare, (0, 1, 2 + g, 6 + k), (1.0, 0.9 + 0.2 * u, 1.0, 0.5)))
        for b, g, k, u in zip(y.tolist(), group.tolist(), odd.tolist(), rng.random(n).tolist())
    ]
    model = linear.NewtonClassifier(loss).fit_many([spark.createDataFrame(rows, ["bid", "weight", "features"])])[0]
    assert model.residual < 2e-4 and model.scans <= 25
