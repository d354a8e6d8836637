import re
from collections import defaultdict
from hashlib import md5

import pytest

from smelter.llm import mixing
from smelter.llm.common import durable
from smelter.llm.mixing import mix, mixed_documents, schedule, sized, targets
from tests.llm.conftest import rows, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def filled(sizes: dict, weights=(5, 2, 1), share=1.5, most=2) -> dict:
    """Targets as the contract tells them: fill by weight, stop those above, share the excess anew."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    got, open_, left = dict.fromkeys(names, 0.0), set(names), share * sum(sizes.values())
    while open_ and left > 1e-9:
        total = sum(w[s] for s in open_)
        for s in open_:
            got[s] += left * w[s] / total
        left = 0.0
        for s in [s for s in open_ if got[s] >= most * sizes[s]]:
            left += got[s] - most * sizes[s]
            got[s] = most * sizes[s]
            open_.discard(s)
    return got


@pytest.fixture
def table(docs, odd_docs):
    more = [(1000 + i, words(3 + i % 37, i), f"s{i % 7}" if i % 3 else "big") for i in range(400)]
    return odd_docs.unionByName(docs(*more, (2000, "", "no words"), (2001, None, "no words")))


def test_targets_rise_until_they_stop(table):
    sizes = defaultdict(int)
    for r in table.collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    got = {r.source: r for r in mix(table).collect()}
    for source, target in filled(dict(sizes)).items():
        assert got[source].source_size == sizes[source]
        assert got[source].target == pytest.approx(target)


@pytest.mark.parametrize("block", [4, 1024])
def test_taken_words_follow_from_the_shuffle(table, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK", block)
    got = mix(table).collect()
    assert len(got) == table.count()
    by_source = defaultdict(list)
    for r in got:
        by_source[r.source].append(r)
    for rows_ in by_source.values():
        size, target = rows_[0].source_size, int(rows_[0].target + 0.5)
        assert sum(r.taken for r in rows_) == target
        start = 0
        for r in sorted((r for r in rows_ if r.size), key=lambda r: r.start):
            assert r.start == start
            start += r.size
            assert r.first_pass == max(0, min(r.size, target - r.start))
            assert r.second_pass == max(0, min(r.size, target - size - r.start))
            assert r.taken == r.first_pass + r.second_pass <= 2 * r.size
        order = [md5(f"7:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest() for r in sorted((r for r in rows_ if r.size), key=lambda r: r.start)]
        assert order == sorted(order)


def test_reruns_and_partitions_agree(docs):
    table = docs(*((i, words(3 + i % 9, i), f"s{i % 3}") for i in range(200)))
    assert rows(mix(table), "doc_id", "taken") == rows(mix(table.repartition(7, "n_chars")), "doc_id", "taken")


def test_the_schedule_mixes_all_along(spark, table, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 4)
    plan = durable(targets(durable(sized(table, 7))))
    slots = schedule(spark, plan).orderBy("slot").collect()
    wanted = {(r.no_source, r.source_name): r.slots for r in plan.collect()}
    turns = defaultdict(list)
    for r in slots:
        turns[r.no_source, r.source_name].append(r.turn)
    assert {k: len(v) for k, v in turns.items()} == {k: v for k, v in wanted.items() if v}
    assert all(sorted(t) == list(range(len(t))) for t in turns.values())
    # at every point of the schedule each source has its share, within a few slots
    n = sum(wanted.values())
    seen = defaultdict(int)
    for i, r in enumerate(slots, 1):
        seen[r.no_source, r.source_name] += 1
        if i % 50 == 0:
            assert all(abs(seen[s] - i * wanted[s] / n) < 12 for s in wanted)


def test_documents_of_the_mix(table):
    plan = {(r.doc_id, r.size): (r.first_pass, r.second_pass) for r in mix(table).collect() if r.doc_id is not None and r.doc_id >= 1000}
    out = defaultdict(list)
    mixed = mixed_documents(table)
    assert mixed.columns == table.columns
    texts = {r.doc_id: r.text for r in table.collect()}
    for r in mixed.collect():
        if r.doc_id is not None and r.doc_id >= 1000:
            assert texts[r.doc_id].startswith(r.text)
            out[r.doc_id].append(len(WORD.findall(r.text)))
    assert {k: sorted(v) for k, v in out.items()} == {d: sorted(p for p in passes if p) for (d, _), passes in plan.items() if any(passes)}
    assert sum(len(WORD.findall(r.text or "")) for r in mixed.collect()) == sum(r.taken for r in mix(table).collect())


def test_empty_tables(docs, table):
    assert mix(table.limit(0)).count() == 0
    assert mixed_documents(table.limit(0)).count() == 0
    assert rows(mix(docs((1, None), (2, " "))), "doc_id", "taken", "target") == [(1, 0, 0.0), (2, 0, 0.0)]


def shares_along(mixed, step):
    """Words of each source in stretches of the mix, as it lies in the result."""
    out = []
    for i, r in enumerate(mixed.collect()):
        if i % step == 0:
            out.append(defaultdict(int))
        out[-1][r.source] += len(WORD.findall(r.text))
    return out[:-1]


def test_each_stretch_of_the_result_is_in_proportion(docs, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 8)
    table = docs(*((i, words(8, i), "abc"[min(i % 6, 2)]) for i in range(600)))
    targets_ = {r.source: r.target for r in mix(table).collect()}
    whole = sum(targets_.values())
    stretches = shares_along(mixed_documents(table), 60)
    assert len(stretches) >= 10
    for found in stretches:
        for source, target in targets_.items():
            assert abs(found[source] / sum(found.values()) - target / whole) < 0.08


def test_the_result_follows_the_sequence(docs, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 8)
    table = docs(*((i, words(8, i), "abc"[i % 3]) for i in range(120)))
    golden = [r.doc_id for r in mixed_documents(table).collect()]
    assert golden == [r.doc_id for r in mixed_documents(table.repartition(5)).collect()]
    monkeypatch.setattr(mixing, "GOLDEN", 3 << 48)
    other = [r.doc_id for r in mixed_documents(table).collect()]
    assert golden != other and sorted(golden) == sorted(other)
