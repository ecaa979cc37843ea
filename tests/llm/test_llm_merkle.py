import hashlib
import zlib
from collections import defaultdict

import duckdb
import odd_documents as odd
import pytest
from pyspark.sql import functions as F

from parcelflow.llm import merkle
from parcelflow.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.01"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(digests):
    """The top, and for each leaf the lists of siblings (left, right) by level."""
    proofs, owners, level = [[] for _ in digests], [[k] for k in range(len(digests))], digests
    while len(level) > 1:
        up, up_owners = [], []
        for k in range(0, len(level), 3):
            run = level[k : k + 3]
            for j in range(len(run)):
                for one in owners[k + j]:
                    proofs[one].append((run[:j], run[j + 1 :]))
            up.append(sha(*run))
            up_owners.append([o for own in owners[k : k + 3] for o in own])
        level, owners = up, up_owners
    return level[0], proofs


def expected(rows):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of (doc_id, text, source, lang, n)."""
    by_source = defaultdict(list)
    for doc_id, text, source, lang, n in rows:
        by_source[source].append((doc_id is not None, doc_id, leaf(doc_id, source, lang, n, text), (doc_id, text, source, lang, n)))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for name in names:
        own = sorted(by_source[name], key=lambda r: (r[0], r[1] or 0, r[2]))
        built[name] = own, *tree([r[2] for r in own])
    root, upper = tree([built[name][1] for name in names])
    out = []
    for name, above in zip(names, upper):
        own, subroot, proofs = built[name]
        for (_, doc_id, digest, row), proof in zip(own, proofs):
            at = digest
            even = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 2 == 0
            if even and row[1] is not None:
                at = leaf(doc_id, name, row[3], row[4], row[1].replace("\n", ""))
            siblings = []
            for left, right in proof + above:
                at = sha(*left, at, *right)
                siblings += left + right
            out.append((doc_id, digest, subroot, root, sha(*siblings), at, at == root))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def given(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, n_chars bigint")


def test_query_against_trees_in_memory(spark):
    rows = [
        (r.doc_id, r.text, r.source, r.lang, r.n_chars)
        for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    ]
    got = odd.rows_of(QUERIES["op13_merkle_manifest"](spark, SF_DIR), *COLUMNS)
    assert got == expected(rows)
    assert 0 < sum(r[-1] for r in got) < len(got)
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
        twin = db.sql(SQL["op13_merkle_manifest"])
        assert set(twin.columns) == set(COLUMNS)
        assert sorted(twin.project(",".join(COLUMNS)).fetchall(), key=repr) == got


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 9, 10, 28, 82])
def test_heights(spark, n):
    rows = [(i * 7 % 101, f"t{i}\n", "s" if i % 2 else None, None, i) for i in range(n)]
    docs = given(spark, rows)
    got = odd.rows_of(merkle.check_rows(docs, merkle.without_line_ends()), *COLUMNS)
    assert got == (expected(rows) if rows else [])


def test_blocks_of_a_hot_source_and_many_small_ones(spark, monkeypatch):
    """Rounds whose segments reach over blocks, on few rows: blocks of three neighbours."""
    monkeypatch.setattr(merkle, "NEAR", 1)
    monkeypatch.setattr(merkle, "BLOCK", 3)
    rows = [(i, f"a\n{i}", "hot" if i % 3 else f"s{i}", "en", 1) for i in range(400)]
    got = merkle.check_rows(given(spark, rows).repartition(5), merkle.without_line_ends())
    assert odd.rows_of(got, *COLUMNS) == expected(rows)


def test_a_changed_row_does_not_verify_and_a_kept_one_does(spark):
    rows = [(i, f"text {i}", "s", "en", 1) for i in range(30)]
    claim = merkle.row_digest(text=F.when(F.col("doc_id") == 7, "another").otherwise(F.col("text")))
    got = {r.doc_id: r.verified for r in merkle.check_rows(given(spark, rows), claim).collect()}
    assert got == {i: i != 7 for i in range(30)}
    proofs = merkle.manifest(given(spark, rows)).collect()
    assert all(r.claim == r.leaf and len(r.proof) == 4 for r in proofs)


def test_odd_documents(spark):
    docs = odd.documents(spark).withColumns(
        {"source": F.col("kept"), "lang": F.lit(None).cast("string"), "n_chars": F.length("text").cast("bigint")}
    )
    rows = [(r.doc_id, r.text, r.source, r.lang, r.n_chars) for r in docs.collect()]
    got = odd.rows_of(merkle.check_rows(docs, merkle.without_line_ends()), *COLUMNS)
    assert got == expected(rows)
    none = odd.empty(spark).withColumns(
        {"source": F.lit("s"), "lang": F.lit("en"), "n_chars": F.lit(1).cast("bigint")}
    )
    assert merkle.check_rows(none, merkle.without_line_ends()).count() == 0
