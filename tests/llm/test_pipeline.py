"""The stages one by one, each judged on its own input."""

import re
from collections import defaultdict

import pytest

import corpus_pipeline
from tests.llm.odd import LABELS, no_docs, odd_docs
from tests.llm.test_near import kept

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, FOLDER).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def test_names_and_columns(tables):
    assert len(corpus_pipeline.STAGES) == 5
    for before, after in tables[:-1]:
        assert after.columns == before.columns and after.count() > 0


def test_good_documents_stay(spark, tables):
    before, after = tables[0]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    kept = {r.doc_id for r in after.collect()}
    good, bad = ([r.doc_id for r in labels.where(f"quality = {q}").collect()] for q in (1, 0))
    assert len(kept & set(good)) >= 0.99 * len(good)
    assert len(kept & set(bad)) <= 0.1 * len(bad)


def test_lines_only_go(tables):
    texts = {r.doc_id: r.text for r in tables[1][0].collect()}
    rows = tables[1][1].collect()
    assert len(rows) == len(texts) and any(r.text != texts[r.doc_id] for r in rows)
    for r in rows:
        left = iter(texts[r.doc_id].split("\n"))
        assert all(line in left for line in r.text.split("\n"))
        assert r.text == texts[r.doc_id] or r.n_chars == len(r.text)


def test_one_of_each_group_stays(tables):
    before, after = tables[2]
    assert sorted(r.doc_id for r in after.collect()) == kept([(r.doc_id, r.text) for r in before.collect()])


def test_mix_takes_whole_documents(tables):
    before, after = tables[3]
    size = lambda rows: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in rows)
    copies = defaultdict(int)
    rows = after.collect()
    for r in rows:
        copies[r.doc_id] += 1
    assert max(copies.values()) <= 3
    assert abs(size(rows) - size(before.collect())) <= 0.02 * size(rows)


def test_sequences_are_full(tables):
    rows = tables[4][1].collect()
    ids = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= 1.01 * -(-ids // 1024)
    assert all(len(r.ids) == r.length for r in rows)


def test_run_gives_the_last_table(spark, tables):
    assert corpus_pipeline.run(spark, FOLDER).count() == tables[4][1].count()


def test_stages_take_odd_rows(spark, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], LABELS)
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (odd_docs(spark), no_docs(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.dtypes == docs.dtypes, name
            out.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() >= docs.count()
