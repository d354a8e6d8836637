import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from smelter.llm import bucket_join, ngram_join
from smelter.llm.common import BATCH_BYTES, BATCH_SETTING, small_batches
from smelter.llm.components import components
from smelter.llm.ngram_join import allowed_missing, drop_similar, signatures, similar_documents, size_classes
from tests.llm.conftest import rows, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    found = WORD.findall((text or "").translate(LOWER))
    return {tuple(found[i : i + k]) for i in range(max(1, len(found) - k + 1))} if found else set()


def reach(nodes, links):
    """The smallest node that each one reaches; None is larger than any."""
    parent = {n: n for n in range(len(nodes))}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        parent[root(a)] = root(b)
    groups = {}
    for i in range(len(nodes)):
        groups.setdefault(root(i), []).append(nodes[i])
    least = {r: min((n for n in g if n is not None), default=None) for r, g in groups.items()}
    return [least[root(i)] for i in range(len(nodes))]


def brute(df, k, num, den):
    got = df.collect()
    sets = [shingles(r.text, k) for r in got]
    links = [
        (i, j) for i in range(len(sets)) for j in range(i)
        if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])
    ]
    ids = reach([r.doc_id for r in got], links)
    return sorted(((r.doc_id, len(s), c) for r, s, c in zip(got, sets, ids)), key=lambda r: [(v is not None, v) for v in r])


@pytest.mark.parametrize("num", [80, 90, 50])
@pytest.mark.parametrize("share", [0.0, 0.5, 0.95, 1.0])
def test_similar_sets_share_a_signature(num, share):
    rng = np.random.default_rng(6)
    for _ in range(400):
        n = int(rng.integers(1, 120))
        one = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        other = one.copy()
        for _ in range(int(rng.integers(0, 30))):
            drop = int(rng.integers(0, len(other)))
            other = np.unique(np.concatenate([np.delete(other, drop), rng.integers(0, 1 << 63, int(rng.integers(0, 2))).astype(np.uint64)]))
            if not len(other):
                break
        common = len(np.intersect1d(one, other))
        if len(other) and 100 * common >= num * (len(one) + len(other) - common):
            hot = lambda s: (s % np.uint64(1000)) < np.uint64(1000 * share)
            assert np.intersect1d(signatures(one, hot(one), num, 100), signatures(other, hot(other), num, 100)).size


def test_bounds_are_exact():
    for n in range(1, 200):
        similar = [m for m in range(1, 500) if 100 * min(n, m) >= 80 * max(n, m)]
        assert {m.bit_length() - 1 for m in similar} <= set(size_classes(n, 80, 100))
        assert max(n - c for c in range(1, n + 1) if 100 * c >= 80 * n) == allowed_missing(n, 80, 100)


def edited(text, seed, n):
    rng, found = random.Random(seed), text.split()
    for _ in range(n):
        found[rng.randrange(len(found))] = f"w{rng.randrange(50)}"
    return " ".join(found)


@pytest.fixture
def table(docs, odd_docs):
    base = [words(120, 70 + i) for i in range(6)]
    passage = words(60, 99)
    more = [(1000 + i, edited(base[i % 6], i, i % 9)) for i in range(240)]
    more += [(2000 + i, passage + " " + words(4 + i % 12, 500 + i)) for i in range(60)]
    return odd_docs.unionByName(docs(*more, *((3000 + i, base[0].upper()) for i in range(30))))


@pytest.mark.parametrize("k, num, frequent, bits, small", [(3, 90, 4, 26, 32), (5, 80, 2, 8, 3), (3, 80, 1000, 26, 2)])
def test_components_equal_brute_force(table, monkeypatch, k, num, frequent, bits, small):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    monkeypatch.setattr(ngram_join, "FREQUENT_BITS", bits)
    monkeypatch.setattr(bucket_join, "SMALL_BUCKET", small)
    monkeypatch.setattr(ngram_join, "PER_PLACE", 5)
    got = rows(similar_documents(table, k, num, 100), "doc_id", "n_shingles", "component_id")
    assert got == brute(table, k, num, 100)


def test_one_document_of_each_group_stays(table):
    groups = {(r.component_id) for r in similar_documents(table).filter("doc_id > 100").collect()}
    left = drop_similar(table)
    assert left.columns == table.columns
    assert {r.doc_id for r in left.collect() if r.doc_id and r.doc_id > 100} == groups


def test_rows_that_share_a_doc_id_are_told_apart_by_their_text(odd_docs, docs):
    kept = [tuple(r) for r in drop_similar(odd_docs).select("doc_id", "text").collect()]
    given = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    copies = [(i, t) for i, t in given if t and t.lower().startswith("one two three four") and i != 1]
    want = [r for r in given if r not in copies and r[0] not in (7, 11)]
    order = lambda r: [(v is not None, v) for v in r]
    assert sorted(kept, key=order) == sorted(want, key=order)
    near = words(60, 3)
    left = drop_similar(docs((None, near), (None, near + " end"), (None, words(50, 8)), (5, words(50, 9)), (5, near)))
    assert sorted(r.text for r in left.filter("doc_id is null").collect()) == [words(50, 8)] and left.filter("doc_id = 5").count() == 2
    assert drop_similar(docs((None, near), (None, near + " end"))).count() == 1


def test_empty_tables(docs, table):
    assert similar_documents(table.limit(0)).count() == 0
    assert drop_similar(table.limit(0)).count() == 0
    assert rows(similar_documents(docs((1, None), (2, ""), (2, ""))), "doc_id", "n_shingles", "component_id") == [(1, 0, 1), (2, 0, 2), (2, 0, 2)]


@pytest.mark.parametrize("links", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(50, 60), (60, 55), (29, 31)]])
def test_components(spark, links):
    found = components(spark.createDataFrame(links, "a long, b long"))
    nodes = sorted({n for a, b in links for n in (a, b) if a != b})
    want = reach(nodes, [(nodes.index(a), nodes.index(b)) for a, b in links if a != b])
    assert rows(found, "node", "label") == list(zip(nodes, want))


def test_a_task_holds_a_block_of_a_large_batch():
    n, size = 5000, 5000
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array([f"{i} " + "a b c " * (size // 6) for i in range(n)]), pa.array([b"m"] * n)], ["doc_id", "text", "mark"])
    index = ngram_join.indexer(5, 80, 100, None)
    tracemalloc.start()
    got = sum(part.num_rows for part in index(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == n
    # words and hashes of a block of 1 MB of such short words take about 40 times its size; all texts would be 25 MB more
    ones = pa.RecordBatch.from_arrays([c.slice(0, 200) for c in batch.columns], batch.schema.names)
    tracemalloc.start()
    list(index(iter([ones])))
    least = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < least + n * size / 2


def test_texts_are_sent_to_python_in_small_batches(spark, conf):
    texts = spark.range(0, 20_000, 1, 1).selectExpr("id doc_id", "concat(id, repeat(' a b c', 300)) text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    def largest():
        return texts.mapInArrow(sizes, "n long").agg({"n": "max"}).first()[0]

    conf({BATCH_SETTING: "64m"})
    with small_batches(spark):
        assert largest() < 1.5 * BATCH_BYTES
    assert spark.conf.get(BATCH_SETTING) == "64m" and largest() > 1.5 * BATCH_BYTES
    with pytest.raises(ValueError), small_batches(spark):
        raise ValueError
    assert spark.conf.get(BATCH_SETTING) == "64m"
    conf({BATCH_SETTING: "1m"})
    with small_batches(spark):
        assert largest() < 1.5 * 2**20


def test_the_join_sends_small_batches(docs, monkeypatch):
    made, plain = [], ngram_join.SetJoin.nodes
    monkeypatch.setattr(ngram_join.SetJoin, "nodes", lambda self: made.append(self.docs.sparkSession.conf.get(BATCH_SETTING)) or plain(self))
    table = docs((1, words(40, 1)), (2, words(40, 1) + " x"), (3, words(40, 2)))
    before = table.sparkSession.conf.get(BATCH_SETTING)
    assert [r.component_id for r in sorted(similar_documents(table).collect())] == [1, 1, 3]
    assert [r.doc_id for r in sorted(drop_similar(table).collect())] == [1, 3]
    assert made == [str(BATCH_BYTES)] * 2 and table.sparkSession.conf.get(BATCH_SETTING) == before
