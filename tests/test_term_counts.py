from collections import Counter

import pyarrow as pa
import pytest

from sievework.operators import encode


@pytest.mark.parametrize("size", [3, 1 << 20])
def test_blocks_send_one_row_per_term(monkeypatch, size):
    """Occurrences and documents of words and pairs, once per block; pairs stay within a text."""
    monkeypatch.setattr(encode, "BLOCK_WORDS", size)
    texts = [["a", "b", "a", "b"], None, [], ["b"], ["a", "b", "c"], ["c"]]
    batch = pa.RecordBatch.from_pydict({"words": pa.array([["x", "y"], *texts], pa.list_(pa.string()))}).slice(1)
    tf, df = Counter(), Counter()
    rows = [r for out in encode._term_counts([batch], True) for r in out.to_pylist()]
    for r in rows:
        tf[r["term"]] += r["tf"]
        df[r["term"]] += r["df"]
    want = [[*t, *(f"{x} {y}" for x, y in zip(t, t[1:]))] for t in texts if t]
    assert tf == Counter(x for t in want for x in t) and df == Counter(x for t in want for x in set(t))
    if size > 3:
        assert len(rows) == len(tf)
