import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from smelter.llm.words import BLOCK, each_words, shingles_of, slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXT = st.text(alphabet="ab \n\té漢\x85\xa0", max_size=60)


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, max_size=8))
def test_words_of_a_batch_are_the_words_of_each_text(texts):
    got = list(each_words(t.encode() for t in texts))
    assert [len(g) for g in got] == [len(WORD.findall(t)) for t in texts]
    by_hash = {}
    for g, t in zip(got, texts):
        for h, w in zip(g.tolist(), WORD.findall(t)):
            assert by_hash.setdefault(h, w) == w
    assert len(set(by_hash.values())) == len(by_hash)


def test_shingles_depend_on_order_and_short_texts_have_one():
    a, b, c, d = (next(each_words([w])) for w in (b"a", b"b", b"c", b"d"))
    abc, cba = np.concatenate([a, b, c]), np.concatenate([c, b, a])
    assert len(shingles_of(np.concatenate([a, b, c, d]), 3)) == 2
    assert shingles_of(abc, 3)[0] != shingles_of(cba, 3)[0]
    assert len(shingles_of(np.concatenate([a, b]), 3)) == 1
    assert len(shingles_of(a[:0], 3)) == 0


def test_slices_are_the_batch_in_parts_of_a_block_or_one_text():
    texts = ["x" * n for n in (0, 10, BLOCK, 5, BLOCK // 2, BLOCK // 2, 3 * BLOCK, 0, 7)] + [None] * 3 + ["y" * 1000] * 3000
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["i", "text"])
    parts = list(slices(batch, 1))
    assert pa.Table.from_batches(parts) == pa.Table.from_batches([batch])
    for part in parts:
        sizes = [len(t or "") for t in part.column(1).to_pylist()]
        assert sum(sizes[:-1]) <= BLOCK
    assert list(slices(batch.slice(0, 0), 1)) == []
