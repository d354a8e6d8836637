import re
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from smelter.llm.packing import pack
from smelter.llm.quality import assess
from smelter.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_every_operator_has_one_query():
    names = [q for q in __spark_entry__.queries() if re.match(r"op\d+_", q)]
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries() and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.sql(f"create view {table} as select * from read_parquet('{SF}/{table}.parquet')")
    want = con.sql(ORACLE[name])
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == sorted(want.select(*(duckdb.ColumnExpression(c) for c in columns)).fetchall())


def test_stages_follow_each_other(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept[-1], SF).write.parquet(str(tmp_path / name))
        kept.append(spark.read.parquet(str(tmp_path / name)))
    raw, good, distinct, apart, mixed, packed = kept
    assert all(k.columns == docs.columns for k in kept[:-1])
    assert raw.count() > good.count() > distinct.count() >= apart.count() > 0
    texts = [r.text.lower() for r in distinct.collect()]
    assert len(texts) == len(set(texts))
    shingles = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (WORD.findall(r.text.lower()) for r in apart.collect())]
    assert not [1 for i, a in enumerate(shingles) for b in shingles[:i] if 100 * len(a & b) >= 80 * len(a | b)]
    words_in = sum(len(WORD.findall(r.text)) for r in apart.collect())
    words_out = sum(len(WORD.findall(r.text)) for r in mixed.collect())
    assert abs(words_out - 1.5 * words_in) < 20
    ends = defaultdict(int)
    for r in packed.collect():
        ends[r.sequence_id] = max(ends[r.sequence_id], r.offset + r.length)
    assert sum(ends.values()) == packed.agg({"length": "sum"}).first()[0] and max(ends.values()) <= 2048
    assert packed.select("doc_id").distinct().count() == mixed.select("doc_id").distinct().count()


def test_run_applies_all_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0


def test_nothing_outside_imports_the_subpackage():
    from pathlib import Path

    root = Path(corpus_pipeline.__file__).parent
    users = [p for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts and re.search(r"smelter\.llm|corpus_pipeline", p.read_text())]
    assert {p.name for p in users} == {"__spark_entry__.py", "corpus_pipeline.py"}


#: Every name that the modules of the stages use for a column of their own.
NAMES = [
    "quality", "labelled_id", "judged_", "found", "row", "first", "h", "m", "id", "mark", "nth", "words", "taken", "slot", "start", "size", "id_", "mark_", "nth_",
    "words_", "part", "block", "source_size", "target", "first_pass", "sid", "rep_id", "node", "digest", "keep_id", "kept", "group_size", "total", "rank", "length", "piece",
]


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES if s[0] != "packing"], ids=lambda s: s[0])
def test_columns_with_inner_names_come_back_unchanged(spark, stage):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    more = [F.concat(F.lit(f"{name} "), "doc_id").alias(name) for name in NAMES]
    got = stage[1](spark, docs.select("*", *more), SF)
    assert got.columns == [*docs.columns, *NAMES]
    found = got.collect()
    assert found
    for r in found:
        assert [r[name] for name in NAMES] == [f"{name} {r.doc_id}" for name in NAMES]


def test_query_ignores_columns_with_inner_names(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    wide = docs.select("*", *(F.lit(name).alias(name) for name in NAMES))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert sorted(assess(wide, labels).collect()) == sorted(assess(docs, labels).collect())
    assert sorted(pack(wide).drop("sequence_id", "offset").collect()) == sorted(pack(docs).drop("sequence_id", "offset").collect())
