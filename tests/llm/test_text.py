import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from seatmeter.llm import text as tx

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \t\n\x0b\x0c\raAéß 😀.z", max_size=60)), max_size=8), st.integers(1, 5))
@settings(max_examples=200, deadline=None)
def test_words_and_shingles(texts, k):
    w = tx.Words(*tx.utf8(pa.array(texts, pa.string())))
    ref = [WORD.findall(t or "") for t in texts]
    assert w.counts().tolist() == [len(r) for r in ref]
    assert [w.piece(a, b).decode() for a, b in zip(w.first[:-1], w.first[1:])] == [" ".join(r) for r in ref]
    h, first = w.shingles(k)
    want = [[tuple(r[i:i + k]) for i in range(max(1, len(r) - k + 1))] if r else [] for r in ref]
    assert np.diff(first).tolist() == [len(x) for x in want]
    flat = [g for x in want for g in x]
    names = {}
    for g, x in zip(flat, h.tolist()):
        assert names.setdefault(g, x) == x
    assert len(set(names.values())) == len(names)


def test_runs_cover_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array(["x" * (i * 7 % 40) for i in range(50)])], ["doc_id", "text"])
    seen = []
    for rows, data, offsets in tx.runs(batch.slice(3), "text", most=64):
        seen += [(i, bytes(data[a:b]).decode()) for i, a, b in zip(rows.column(0).to_pylist(), offsets[:-1], offsets[1:])]
    assert seen == list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))[3:]
