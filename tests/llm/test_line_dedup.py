import random
import time

import pytest

from smelter.llm import bucket_join, line_dedup
from smelter.llm.line_dedup import WHITE, drop_lines, edit_distance, line_report, segments, signatures, similar_lines
from tests.llm.conftest import rows, words
from tests.llm.test_ngram_join import reach


def distance(a, b):
    before = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        now = [i]
        for j, d in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (c != d)))
        before = now
    return before[-1]


def changed(rng, text, edits, alphabet="abc"):
    out = list(text)
    for _ in range(edits):
        at, kind = rng.randint(0, len(out)), rng.random()
        if kind < 0.33 or not out:
            out.insert(at, rng.choice(alphabet))
        elif kind < 0.66:
            out.pop(min(at, len(out) - 1))
        else:
            out[min(at, len(out) - 1)] = rng.choice(alphabet)
    return "".join(out)


def test_banded_distance_equals_the_plain_one():
    rng = random.Random(7)
    for _ in range(6000):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))
        b, most = changed(rng, a, rng.randint(0, 5)), rng.randint(1, 3)
        assert edit_distance(a, b, most) == min(distance(a, b), most + 1)


def test_lines_within_the_distance_share_a_signature():
    rng = random.Random(8)
    for _ in range(3000):
        edits = rng.randint(1, 3)
        a = "".join(rng.choice("abcd") for _ in range(rng.randint(8, 30)))
        b = changed(rng, a, rng.randint(0, edits), "abcd")
        one, other = ({*found.tolist()} for found in signatures([a, b], edits))
        assert one & other and one == {*signatures([b, a], edits)[1].tolist()}
    assert segments(11, 2) == [(0, 3), (3, 4), (7, 4)]


def brute(df, edits, shortest):
    lines = [
        (r.doc_id, at, line.strip(WHITE))
        for r in df.collect() for at, line in enumerate((r.text or "").split("\n")) if line.strip(WHITE)
    ]
    order = sorted(range(len(lines)), key=lambda i: (lines[i][0] is None, lines[i][0] or 0, lines[i][1]))
    lines = [lines[i] for i in order]
    links = []
    for i, (_, _, a) in enumerate(lines):
        for j in range(i):
            b = lines[j][2]
            if a == b or (min(len(a), len(b)) >= shortest and abs(len(a) - len(b)) <= edits and edit_distance(a, b, edits) <= edits):
                links.append((i, j))
    first = reach(list(range(len(lines))), links)
    out = [(d, at, lines[f][0], lines[f][1], (d, at) == lines[f][:2]) for (d, at, _), f in zip(lines, first)]
    return sorted(out, key=lambda r: [(v is not None, v) for v in r])


@pytest.fixture
def table(docs, odd_docs):
    rng = random.Random(9)
    base = [words(9, 300 + i) for i in range(12)]
    common = "this line stands in very many of the texts"
    more = []
    for i in range(120):
        lines = [changed(rng, rng.choice(base), rng.randint(0, 3)), changed(rng, common, rng.randint(0, 2)), "ok", rng.choice(["yes", "no", ""]), f"  {rng.choice(base)}\t"]
        more.append((1000 + i, "\n".join(lines)))
    return odd_docs.unionByName(docs(*more))


@pytest.mark.parametrize("edits, small", [(2, 32), (1, 3), (3, 2)])
def test_classes_equal_brute_force(table, monkeypatch, edits, small):
    monkeypatch.setattr(bucket_join, "SMALL_BUCKET", small)
    monkeypatch.setattr(line_dedup, "PER_PLACE", 7)
    got = rows(similar_lines(table, edits), "doc_id", "line", "class_doc", "class_line", "kept")
    assert got == brute(table, edits, 20)


def test_report_and_texts_follow_the_classes(table):
    lines = similar_lines(table).collect()
    gone, seen = {}, {}
    for r in lines:
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
        if not r.kept:
            gone.setdefault(r.doc_id, []).append((r.line, r.class_doc, r.class_line))
    report = {r.doc_id: (r.n_lines, r.n_dropped, [tuple(x) for x in r.dropped]) for r in line_report(table).collect()}
    assert report == {i: (seen.get(i, 0), len(gone.get(i, [])), sorted(gone.get(i, []))) for i in {r.doc_id for r in table.collect()}}
    left = drop_lines(table)
    assert left.columns == table.columns
    texts = {r.doc_id: r.text for r in left.collect()}
    for r in table.filter("doc_id >= 1000").collect():
        away = {x[0] for x in gone.get(r.doc_id, [])}
        assert texts[r.doc_id] == "\n".join(x for i, x in enumerate(r.text.split("\n")) if i not in away)
    assert texts[3] is None and texts[4] == ""


def test_empty_tables(docs, table):
    assert similar_lines(table.limit(0)).count() == line_report(table.limit(0)).count() == drop_lines(table.limit(0)).count() == 0
    assert rows(line_report(docs((1, None), (2, " \n"))), "doc_id", "n_lines", "n_dropped") == [(1, 0, 0), (2, 0, 0)]


def test_long_similar_lines_take_time_in_proportion():
    rng = random.Random(4)

    def seconds(n):
        one = "".join(rng.choice("abcdefgh ") for _ in range(n))
        other = "x" + one[1 : n - 1] + "y"
        start = time.process_time()
        assert edit_distance(one, other, 2) == 2 and edit_distance(one, "yy" + other, 2) == 3
        return time.process_time() - start

    assert seconds(400_000) < 10 * seconds(100_000)


def test_many_rows_without_doc_id(docs):
    base = [words(30, i) for i in range(40)]
    lines = docs(*((None, base[i % 40] + " ab"[: i % 3]) for i in range(1500)))
    found = similar_lines(lines).collect()
    assert len(found) == 1500 and all(r.class_doc is None for r in found)


def test_small_tables_take_few_tasks(spark, table, conf):
    conf({"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    spark.sparkContext.setJobGroup("few", "")
    found = similar_lines(table)
    tracker = spark.sparkContext.statusTracker()
    stages = {s for job in tracker.getJobIdsForGroup("few") for s in tracker.getJobInfo(job).stageIds}
    tasks = sum(info.numCompletedTasks for s in stages if (info := tracker.getStageInfo(s)))
    spark.sparkContext.setJobGroup("", "")
    assert found.count() > 500 and 0 < tasks < 3000
