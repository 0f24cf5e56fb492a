"""Decontamination has a chunk of a batch at once as words and vectors, whatever the batch holds."""

import tracemalloc

import numpy as np
import pyarrow as pa

from cairn.llm import decontaminate


def test_a_batch_is_never_whole_in_python():
    b = pa.RecordBatch.from_pydict({"text": pa.array([bytes([97 + k % 26]) * 2_000 for k in range(10_000)], pa.binary()).cast(pa.string())})
    seen = []
    tracemalloc.start()
    for _, rows, texts in decontaminate._chunks(iter([b])):
        assert len(rows) == len(texts) and texts[0][:1] == bytes([97 + rows[0] % 26])
        seen += rows
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == list(range(10_000)) and peak < 4_000_000  # of 20 MB


def test_long_empty_and_no_texts_are_chunks():
    long = "x" * (decontaminate.CHUNK + 1)
    b = pa.RecordBatch.from_pydict({"text": pa.array(["a", long, "", "", long, "b"])})
    assert [r for _, rows, _ in decontaminate._chunks(iter([b, b.slice(0, 0)])) for r in rows] == list(range(6))
    assert [t for _, _, texts in decontaminate._chunks(iter([b])) for t in texts] == [t.encode() for t in ("a", long, "", "", long, "b")]


def test_sums_take_memory_for_their_result():
    t = decontaminate.Texts(np.arange(20_000) % 50, np.arange(20_000), np.zeros(1, np.int64), 20_000, [])
    matrix = np.ones((100, 50), np.float32)
    tracemalloc.start()
    sums = decontaminate.block_sums(t, matrix)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sums.shape == (100, 20_000) and sums.dtype == np.float32 and (sums == 1).all() and peak < 1.5 * sums.nbytes
