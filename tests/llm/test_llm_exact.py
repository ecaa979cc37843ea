from collections import Counter
import hashlib

import odd_documents as odd

from parcelflow.llm import exact_dedup


def brute(rows):
    groups, out = {}, []
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    for i, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_odd_documents(spark):
    got = odd.rows_of(exact_dedup.exact_duplicates(odd.documents(spark)), *COLUMNS)
    assert got == brute(odd.ROWS)
    assert exact_dedup.exact_duplicates(odd.empty(spark)).count() == 0


def test_a_third_of_all_rows_is_one_text(spark):
    rows = [(i, "same" if i % 3 == 0 else f"text {i // 2}") for i in range(3000)]
    docs = odd.documents(spark, rows, 8)
    hot = exact_dedup.frequent(exact_dedup.digests(docs)).collect()
    assert [(r.keep_id, r.group_size, r.keep_rows) for r in hot] == [(2997, 1000, 1)]
    assert odd.rows_of(exact_dedup.exact_duplicates(docs), *COLUMNS) == brute(rows)


def test_kept_documents_are_whole_rows(spark):
    for rows in (odd.ROWS, [(i % 900, "same" if i % 3 else f"t{i % 50}") for i in range(2000)], []):
        docs = odd.documents(spark, rows) if rows else odd.empty(spark)
        kept = exact_dedup.keep_documents(docs)
        assert kept.schema == docs.schema
        got = kept.select("doc_id", "text").collect()
        want = {}
        for i, t in rows:
            key = t or ""
            want[key] = max((x for x in (want.get(key), i) if x is not None), default=None)
        assert Counter((r.doc_id, r.text or "") for r in got) == Counter((i, t) for t, i in want.items())


def test_main_path_has_no_python(spark):
    plan = exact_dedup.exact_duplicates(odd.documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
