"""Large families are compared without a matrix of all pairs, and what is written leaves no shuffles behind."""

import glob
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sievework.llm import minhash
from sievework.llm.common import stored

U64 = np.uint64


def some_sets(rng, n, values):
    """Sets of which half are made from an earlier one by leaving out and adding a few members."""
    sets = []
    for _ in range(n):
        if sets and rng.random() < 0.5:
            old = sets[rng.integers(len(sets))]
            few = max(1, len(old) // rng.integers(4, 30))
            new = np.append(old[rng.permutation(len(old))[few:]], rng.integers(1, values, rng.integers(0, few + 1)).astype(U64))
        else:
            new = rng.integers(1, values, rng.integers(1, 60)).astype(U64)
        sets.append(np.unique(new) if len(new) else np.array([1], U64))
    return sets


@pytest.mark.parametrize("percent", [33, 80, 100])
@pytest.mark.parametrize("pairs", [5, 1 << 20])
def test_rare_first_forest_is_that_of_all_pairs(monkeypatch, percent, pairs):
    monkeypatch.setattr(minhash, "PAIRS", pairs)
    monkeypatch.setattr(minhash, "LOOKUPS", 3 * pairs)
    rng = np.random.default_rng(percent)
    for values in (12, 60, 5000):
        sets = some_sets(rng, 90, values)
        links = np.array([[100 * len(np.intersect1d(a, b)) >= percent * len(np.union1d(a, b)) for b in sets] for a in sets])
        assert (minhash.rare_first_forest(sets, percent) == minhash.forest(links)).all()


def test_a_chained_family_is_compared_quickly():
    rng = np.random.default_rng(1)
    common = np.arange(1, 11, dtype=U64)
    sets = [np.unique(np.append(common, rng.integers(100, 1 << 40, 20).astype(U64))) for _ in range(6000)]
    sets[4000] = np.append(sets[17], U64(1 << 41))
    group = pa.table({"family": np.zeros(6000, np.int64), "cls": np.arange(6000), "members": pa.array([s.tobytes() for s in sets], pa.binary())})
    began = time.process_time()
    assert minhash.compared(group, 80).to_pylist() == [{"a": 4000, "b": 17}]
    assert time.process_time() - began < 10


def test_families_over_blocks(spark, monkeypatch):
    rows = [(k, " ".join(f"w{k // 7}x{j}" for j in range(30)) + f" end{k}") for k in range(70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name, value in (("BLOCK", 2), ("BLOCK_SETS", 3), ("BLOCK_MEMBERS", 100)):
        monkeypatch.setattr(minhash, name, value)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, size=2).collect()}
    assert got == {k: k // 7 * 7 for k in range(70)}


def test_written_tables_leave_no_shuffles(spark):
    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    files = lambda: {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")}
    before = files()
    kept = stored(spark.range(5000).groupBy((F.col("id") % 97).alias("k")).agg(F.sum("id").alias("n")), "shuffled")
    until = time.time() + 5
    while files() - before and time.time() < until:
        time.sleep(0.1)
    assert not files() - before
    assert kept.agg(F.count("k"), F.sum("n")).first() == (97, 4999 * 2500)
