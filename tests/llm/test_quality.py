import re
import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from smelter.llm.quality import CLEAN_LOSS, assess, base_failed, calibrate, fit, keep_good, measure, statistics
from tests.llm.conftest import rows, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    found = WORD.findall(text)
    runs = Counter(tuple(found[i : i + 3]) for i in range(len(found) - 2))
    covered = {i + k for i in range(len(found) - 2) if runs[tuple(found[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(found), sum(map(len, found)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\té#|\x85", max_size=50)), max_size=5))
def test_counts_equal_brute_force(texts):
    got = measure(texts)
    assert [tuple(r) for r in got.iloc[:, :5].itertuples(index=False)] == [brute(t) for t in texts]


def test_a_text_with_repeats():
    text = "a b c d\na b c e\n\na b c d\n " + "x y z " * 20
    assert tuple(measure([text]).iloc[0, :5]) == brute(text)


def good(i):
    return words(90 + i % 40, i).capitalize() + "."


def bad(i):
    return [" ".join(w + "$$$" for w in words(80, i).split()), words(80, i).upper() + "!!!", " | ".join(words(90, i).split())][i % 3]


@pytest.fixture(scope="module")
def forest():
    texts = [good(i) for i in range(400)] + [bad(i) for i in range(90)]
    return fit(measure(texts).assign(quality=[1] * 400 + [0] * 90))


def test_held_out_rows(forest):
    clean, junk = measure([good(i) for i in range(1000, 1300)]), measure([bad(i) for i in range(1000, 1090)])
    assert not base_failed(clean).any() and not base_failed(junk).any()
    assert (forest.paths(statistics(clean)) >= forest.limit).mean() > 0.98
    assert (forest.paths(statistics(junk)) < forest.limit).mean() > 0.9


def test_path_lengths_follow_the_trees(forest):
    points = statistics(measure([good(5), bad(5), bad(6)]))
    for x, got in zip(points, forest.paths(points)):
        total = 0.0
        for feature, value, left, path in zip(forest.feature, forest.value, forest.left, forest.path):
            node = 0
            while feature[node] >= 0:
                node = left[node] + int(x[feature[node]] >= value[node])
            total += path[node]
        assert got == pytest.approx(total / len(forest.feature))


def test_labels_of_one_kind_reject_nothing_more():
    counts = measure([good(i) for i in range(20)])
    forest = fit(counts.assign(quality=1))
    assert (forest.paths(statistics(counts)) >= forest.limit).all()
    assert fit(pd.DataFrame(counts.iloc[:0]).assign(quality=[])).limit < 0


def test_the_limit_loses_few_clean_rows(forest):
    points = statistics(measure([good(i) for i in range(400)]))
    assert (forest.paths(points) < forest.limit).mean() <= CLEAN_LOSS + 0.01


def test_verdicts_of_a_table(spark, docs, odd_docs):
    table = odd_docs.unionByName(docs(*((100 + i, good(i)) for i in range(60)), *((200 + i, bad(i)) for i in range(30))))
    labels = spark.createDataFrame(
        [(100 + i, 1, 0) for i in range(60)] + [(200 + i, 0, 0) for i in range(30)] + [(None, 1, 0), (3, None, None), (999, 1, 0), (100, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    got = rows(assess(table, labels), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = [(r.doc_id, *brute(r.text)) for r in table.collect()]
    want = [(*w, w[1] < 50 or 100 * w[5] > 50 * w[1]) for w in want]
    assert got == sorted(want, key=lambda r: [(v is not None, v) for v in r])
    kept = {r[0] for r in rows(assess(table, labels).filter("kept"), "doc_id")}
    assert {100 + i for i in range(60)} <= kept and not kept & {3, 4, 5, 10, 11}
    assert len(kept & {200 + i for i in range(30)}) <= 2
    left = keep_good(table, labels)
    assert left.columns == table.columns and {r.doc_id for r in left.collect()} == kept
    assert calibrate(table, labels, most=10).limit is not None


def test_an_empty_table_and_no_labels(spark, odd_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert assess(odd_docs.limit(0), labels).count() == 0
    got = assess(odd_docs, labels)
    assert got.filter("kept = base_failed").count() == 0
    assert np.isclose(got.filter("kept").count(), keep_good(odd_docs, labels).count())


def test_a_batch_is_encoded_a_block_at_a_time():
    texts = [words(100, i) * 6 for i in range(40)] * 250
    total = sum(map(len, texts))

    def peak(some):
        tracemalloc.start()
        measure(some)
        got = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return got

    assert total > 20 << 20
    assert peak(texts) < peak(texts[:500]) + total / 2
