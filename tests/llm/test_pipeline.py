"""The pipeline stage by stage against brute force, on hand-made documents and on a test folder."""

import pytest

import corpus_pipeline
from pacecast.llm import pii
from tests.llm.test_exact_ops import components_brute, fingerprint_brute, windows_brute


@pytest.fixture(scope="module")
def folder(docs, labels, benchmark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('corpus')}"
    docs.write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    benchmark.write.parquet(f"{path}/benchmark.parquet")
    return path


def texts(df):
    return sorted((r["doc_id"] if r["doc_id"] is not None else -99, r["text"] or "", r["text"] is None) for r in df.collect())


def test_near_copies_leave_one(spark, docs, doc_rows, folder):
    kept = corpus_pipeline.drop_near_copies(spark, docs, folder)
    assert kept.columns == docs.columns
    parts = components_brute([(i, fingerprint_brute(r[1])) for i, r in enumerate(doc_rows)], 2)
    groups = {}
    for i, _, c in parts:
        groups.setdefault(c, []).append(doc_rows[i])
    got = kept.collect()
    assert len(got) == len(groups)
    first = {min((r[0] is None, r[0] or 0) for r in rows) for rows in groups.values()}
    assert {(r["doc_id"] is None, r["doc_id"] or 0) for r in got} == first


def test_contaminated_documents_go(spark, docs, doc_rows, benchmark, folder):
    kept = corpus_pipeline.drop_benchmark(spark, docs, folder)
    found = windows_brute(doc_rows, [tuple(r)[:2] for r in benchmark.collect()])
    want = [r for r, (_, _, hit, _) in zip(doc_rows, found) if not hit]
    assert kept.columns == docs.columns and len(want) < len(doc_rows)
    assert texts(kept) == sorted((r[0] if r[0] is not None else -99, r[1] or "", r[1] is None) for r in want)


def test_run(spark, folder):
    got = corpus_pipeline.run(spark, folder).collect()
    assert got and len({r["doc_id"] for r in got if r["doc_id"] is not None}) <= len(got)
    assert all(r["ids"][-1] == 2 for r in got)


def test_empty_folder(spark, none, labels, benchmark, tmp_path):
    path = f"file://{tmp_path}"
    none.write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    benchmark.write.parquet(f"{path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, path).collect() == []


def test_redaction_leaves_no_base_span(spark, docs, folder):
    after = corpus_pipeline.redact(spark, docs, folder).collect()
    assert all(not pii.base_spans(r["text"] or "") for r in after)


def test_stage_order():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash_dedup", "decontamination", "personal_data", "sentencepiece"]
