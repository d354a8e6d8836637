import hashlib

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from smelter.llm.exact_dedup import decode, drop_duplicates, encode, exact_duplicates
from smelter.llm.words import LOWER
from tests.llm.conftest import rows, words


@given(st.sets(st.integers(0, (1 << 64) - 1), min_size=1, max_size=50))
def test_golomb_code_round_trip(values):
    sorted_values = np.array(sorted(values), np.uint64)
    assert decode(encode(sorted_values), len(values)).tolist() == sorted(values)


@pytest.mark.parametrize("dense", [1, 3, 1000, 1 << 40])
def test_golomb_code_is_near_the_gaps_size(dense):
    gaps = np.random.default_rng(3).geometric(1 / dense, 5000).astype(np.uint64)
    values = np.cumsum(gaps)
    code = encode(values)
    assert decode(code, len(values)).tolist() == values.tolist()
    assert len(code) * 8 / len(values) < np.log2(dense) + 2.5


def brute(df):
    texts = {}
    for r in df.collect():
        texts.setdefault((r.text or "").encode().translate(LOWER), []).append(r.doc_id)
    out = []
    for text, ids in texts.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text).hexdigest()
        left = True
        for i in ids:
            out.append((i, sha, keep, len(ids), left and i == keep))
            left = left and i != keep
    return sorted(out, key=lambda r: [(v is not None, v) for v in r])


@pytest.mark.parametrize("bits", [64, 2])
def test_groups_are_those_of_equal_texts(odd_docs, bits):
    got = exact_duplicates(odd_docs, keep_bits=bits)
    assert rows(got, "doc_id", "text_sha256", "keep_id", "group_size", "kept") == brute(odd_docs)


def test_one_row_of_each_group_is_left_with_its_columns(odd_docs):
    left = drop_duplicates(odd_docs)
    assert left.columns == odd_docs.columns
    texts = [(r.text or "").encode().translate(LOWER) for r in left.collect()]
    assert len(texts) == len(set(texts)) == len({(r.text or "").encode().translate(LOWER) for r in odd_docs.collect()})


def test_many_copies_and_an_empty_table(docs):
    text = words(20, 9)
    many = docs(*((i, text if i % 3 else words(5, i)) for i in range(300)))
    got = exact_duplicates(many).filter("group_size > 1").select("keep_id", "group_size").distinct().collect()
    assert [tuple(r) for r in got] == [(299, 200)]
    assert exact_duplicates(many.limit(0)).count() == 0
    assert drop_duplicates(many.limit(0)).count() == 0
