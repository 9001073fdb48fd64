"""Workers hold the ids of few documents at a time."""

import numpy as np
import pyarrow as pa

from barforge.llm import packing


def test_a_worker_encodes_few_documents_at_a_time(frame, monkeypatch):
    docs, sizes, given = frame([(1, "a")]), [], {}

    class Encoder:
        def encode(self, texts):
            sizes.append(len(texts))
            return [np.arange(len(t), dtype=np.uint32) for t in texts]

    class Context:
        get = staticmethod(lambda: Context)
        partitionId = staticmethod(lambda: 7)

    def take(df, f, schema):
        given["f"] = f
        return df

    monkeypatch.setattr(type(docs), "mapInArrow", take)
    monkeypatch.setattr(packing, "materialise", lambda df, name: df)
    monkeypatch.setattr(packing, "encoder", lambda path: Encoder())
    monkeypatch.setattr(packing, "TaskContext", Context)
    packing.tokenized(docs, "unused")
    texts = ["x" * (k % 5) for k in range(9000)]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(a, b)), pa.array(texts[a:b])], names=["doc_id", "text"]) for a, b in ((0, 8500), (8500, 8500), (8500, 9000))]
    rows = [r for batch in given["f"](iter(batches)) for r in batch.to_pylist()]
    assert max(sizes) <= 4096 and [r["doc_id"] for r in rows] == list(range(9000))
    n = np.array([len(t) + 1 for t in texts])
    assert [r["n"] for r in rows] == n.tolist() and [r["first"] for r in rows] == (np.cumsum(n) - n).tolist()
    assert {r["part"] for r in rows} == {7} and all(len(r["ids"]) == 4 * r["n"] for r in rows)
