import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from voltrail.llm import words

TEXTS = st.lists(st.text(alphabet="ab é中\n\t \x0b\x1c ", max_size=30), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_runs_of_other_than_ascii_space(texts):
    w = words.split([t.encode() for t in texts])
    found = [w.data[a:b].tobytes().decode() for a, b in zip(w.starts, w.ends)]
    expected = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    assert found == [x for e in expected for x in e]
    assert np.diff(w.first).tolist() == [len(e) for e in expected]
    h = w.hashes()
    assert len(set(h.tolist())) == len(set(found))


def test_equal_runs_have_equal_hashes_anywhere():
    v = np.array([5, 6, 7, 5, 6, 7, 8], dtype=np.uint64)
    h = words.run_hash(v, np.array([0, 3, 1]), np.array([3, 6, 4]))
    assert h[0] == h[1] != h[2]


def test_table_finds_what_it_holds():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**62, 5000).astype(np.uint64))
    table = words.Table(keys, np.arange(len(keys)))
    assert (table.get(keys) == np.arange(len(keys))).all()
    assert (table.get(np.setdiff1d(rng.integers(0, 2**62, 5000).astype(np.uint64), keys)) == -1).all()
    assert (words.Table(keys[:0], np.empty(0, dtype=np.int64)).get(keys) == -1).all()


def test_parts_keep_rows_together_and_bound_their_size():
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["aa", None, "b" * 50, "", "cc", "dd"])], ["i", "text"])
    got = list(words.parts([batch], "text", limit=5))
    assert [x for p, _ in got for x in p.column(0).to_pylist()] == list(range(6))
    assert [len(t) for _, ts in got for t in ts] == [2, 0, 50, 0, 2, 2]
