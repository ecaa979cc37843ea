import re

import compare
import odd_documents as odd
import pytest

import __spark_entry__ as spark_entry
import corpus_pipeline
from parcelflow.llm import queries

SF_DIR = "/root/testdata/sf0.001"


def test_numbered_queries_are_registered():
    names = spark_entry.queries()
    for n in range(1, 14):
        assert sum(bool(re.match(rf"op{n}_", name)) for name in names) == 1
    assert "pipeline" in names and set(queries.SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_twin(spark, name):
    db = compare.connect(SF_DIR)
    assert compare.check(spark, db, name, SF_DIR) > 0


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_one_row_per_document(spark, name):
    got = queries.QUERIES[name](spark, SF_DIR)
    n = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    if name.startswith("op7"):
        n = 20 * sum(r.vec_id % 20 == 0 for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect())
    if name.startswith("op1_"):
        got = got.where("piece = 0")
    if name.startswith("op11_"):
        got = got.where("start = 0")
    assert got.count() == n


def junk(i):
    return " ".join(f"WORD{i}{k}!!" for k in range(40))


def prose(i):
    return " ".join(f"word{i}x{k}" + ("." if k % 8 == 7 else "") for k in range(80))


def test_stages_take_effect(spark, tmp_path):
    rows = [(i, prose(i)) for i in range(60)]
    rows += [(100 + i, junk(i)) for i in range(20)]
    rows += [(200, prose(0)), (201, prose(1))]  # exact copies, the larger id stays
    rows += [(300, prose(2) + " and"), (301, prose(2) + " or")]  # near copies, the least id stays
    rows += [(400, prose(70) + " write to bob@example.com now."), (401, prose(71) + " bob@example.com is gone.")]
    docs = odd.documents(spark, rows)
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        path = str(tmp_path / name.replace(" ", "_"))
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        after[name] = docs
    ids = [{r.doc_id for r in after[name].select("doc_id").collect()} for name, _ in corpus_pipeline.STAGES]
    good = {i for i, _ in rows if not 100 <= i < 200}
    assert ids[0] == good
    assert ids[1] == good - {0, 1}
    assert ids[2] == ids[3] == ids[4] == good - {0, 1, 300, 301}
    texts = {r.doc_id: r.text for r in after["surrogates"].collect()}
    found = {re.search(r"\S+@\S+", texts[i])[0] for i in (400, 401)}
    assert len(found) == 1 and found != {"bob@example.com"}
    assert all(texts[i] == t for i, t in rows if i in texts and i < 400)
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert after[name].columns == odd.empty(spark).columns
    assert sum(r.length for r in after["packing"].collect()) > len(texts)


@pytest.mark.parametrize("rows", [odd.ROWS, []])
def test_stages_on_odd_documents(spark, tmp_path, rows):
    docs = odd.documents(spark, rows) if rows else odd.empty(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).select("doc_id", "text").count() <= len(rows)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() >= len(rows)


def test_run(spark):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert 0 < got.where("piece = 0").count() <= spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
