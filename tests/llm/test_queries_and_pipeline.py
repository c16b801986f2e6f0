"""The registered queries on the smallest tables, held-out accuracy, and the pipeline."""

import hashlib
import os
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.test_text_operators import brute_repeats

SF = "/root/testdata/sf0.01"


def test_names_and_oracles():
    names = entry.queries()
    assert [n for n in names if n.startswith("op")] and {f"op{i}_" for i in range(1, 14)} == {n[: n.index("_") + 1] for n in names if n.startswith("op")}
    assert "pipeline" in names and "pipeline" not in entry.oracle_sql()


def test_packing_reaches_workers_a_few_texts_at_a_time(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    docs = spark.createDataFrame([(i, f"text {i} " * 3) for i in range(2500)] + [(None, None)], "doc_id long, text string").coalesce(1)
    got = corpus_pipeline.pack(spark, docs, SF)
    assert "MapInArrow" not in got._jdf.queryExecution().toString()  # written already, in small batches
    assert spark.conf.get(key) == before
    rows = got.collect()
    assert len(rows) == 2501 and sum(r.length for r in rows) == sum(r.doc_tokens for r in rows)


def test_repeats_over_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = {r.doc_id: r for r in entry.queries()["op6_substring_doubling"](spark, SF_SMALL).collect()}
    for d, (n, gone, kept) in zip(docs, brute_repeats([d.text for d in docs], 35), strict=True):
        assert (got[d.doc_id].n_words, got[d.doc_id].n_removed, got[d.doc_id].kept_sha256) == (n, gone, hashlib.sha256(kept.encode()).hexdigest())


def test_held_out_language(spark):
    docs = {d.doc_id: d for d in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = entry.queries()["op3_language_crf"](spark, SF).collect()
    assert len(rows) == len(docs) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([docs[r.doc_id].lang == r.lang_pred for r in held]) > 0.98


def test_held_out_toxicity(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in entry.queries()["op10_toxicity_fm"](spark, sf).collect() if r.held_out and r.doc_id in labels]
    y, p = np.array([labels[r.doc_id] for r in rows]), np.array([r.predicted for r in rows])
    assert len(y) > 500 and p[y == 1].mean() > 0.8 and p[y == 0].mean() < 0.01
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)


def test_search_recall_over_the_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = {}
    for r in entry.queries()["op1_ads_search"](spark, SF).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = []
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        s[q] = -np.inf
        hits.append(len(got[ids[q]] & set(ids[np.argsort(-s)[:20]])) / 20)
    assert np.mean(hits) >= 0.95


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF_SMALL}/documents.parquet"), []
    for i, (name, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, docs, SF_SMALL).write.parquet(os.path.join(folder, str(i)))
        done = spark.read.parquet(os.path.join(folder, str(i)))
        out.append((name, docs, done))
        docs = done
    return out


def test_stages_filter_their_input(stages):
    assert [n for n, _, _ in stages] == ["language ID", "toxicity", "MinHash near-dedup", "substring dedup", "packing"]
    for name, before, after in stages[:-1]:
        assert after.columns == before.columns
        assert {r.doc_id for r in after.collect()} <= {r.doc_id for r in before.collect()}
    for name, before, after in stages[:3]:
        text = {r.doc_id: r.text for r in before.collect()}
        assert all(text[r.doc_id] == r.text for r in after.collect())


def test_stage_contents_match_brute_force(stages):
    _, before, after = stages[3]
    rows = before.collect()
    got = {r.doc_id: r for r in after.collect()}
    for d, (_, _, kept) in zip(rows, brute_repeats([d.text for d in rows], 35), strict=True):
        assert got[d.doc_id].text == kept and got[d.doc_id].n_chars == len(kept)
    _, before, after = stages[2]
    texts = [r.text for r in after.collect()]
    assert len(texts) == len(set(texts)) and set(texts) == {r.text for r in before.collect()} - (set(r.text for r in before.collect()) - set(texts))
    _, before, after = stages[4]
    per = {}
    for r in after.collect():
        per[r.doc_id] = per.get(r.doc_id, 0) + r.length
        assert r.doc_tokens >= r.length
    assert set(per) == {r.doc_id for r in before.collect()}


def test_stages_take_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, extra string"
    docs = spark.createDataFrame([(1, "The theon and the of it.", "en", "s", 1, None), (None, None, None, None, None, "x"), (2, "", None, None, 0, None),
                                  (3, "The theon and the of it.", "en", None, None, None)], schema)
    for name, f in corpus_pipeline.STAGES:
        done = f(spark, docs, SF_SMALL)
        empty = f(spark, docs.limit(0), SF_SMALL)
        assert empty.count() == 0 and done.count() >= 1
        if name != "packing":
            assert done.columns == docs.columns
