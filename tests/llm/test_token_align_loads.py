"""A worker loads its two tokenizers once, however many tasks it runs."""

import public_tokenizers
import pyarrow as pa

from sievework.llm import token_align


def test_tasks_of_a_worker_share_an_aligner(monkeypatch):
    loads = []
    plain = token_align.Aligner
    monkeypatch.setattr(token_align, "Aligner", lambda *paths: loads.append(paths) or plain(*paths))
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["some text", None])], names=["doc_id", "text"])
    first, second = ([b.to_pydict() for b in token_align.aligned(iter([batch]), *paths)] for _ in range(2))
    assert first == second and first[0]["n_a"][0] > 0
    assert len(loads) <= 1
