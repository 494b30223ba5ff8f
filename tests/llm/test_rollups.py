"""Rollups against counting again."""

import re
from collections import Counter

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lectern.llm import rollups
from lectern.llm.queries import LICENCE_LINES, op10_token_rollups
from tests.llm.odd import no_docs, odd_docs


def test_query_against_counting(spark):
    folder = "/root/testdata/sf0.001"
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    toxic = {r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if r.toxic == 1}
    want_docs, want_tokens, revised = Counter(), Counter(), 0
    for d in spark.read.parquet(f"{folder}/documents.parquet").collect():
        if d.doc_id in toxic:
            continue
        text = re.sub(LICENCE_LINES, "", d.text)
        revised += text != d.text
        key = (d.source, d.lang, "byte_bpe_50k")
        want_docs[key] += 1
        want_tokens[key] += len(whole.encode(text, add_special_tokens=False).ids)
    assert revised
    got = {(r.source, r.lang, r.version): (r.documents, r.tokens) for r in op10_token_rollups(spark, folder).collect()}
    assert got == {k: (n, want_tokens[k]) for k, n in want_docs.items()}


def test_commits_are_idempotent(spark, tmp_path):
    rollup = rollups.Rollup(spark, str(tmp_path / "totals"))
    assert rollup.totals().count() == 0
    docs = odd_docs(spark)
    counts = rollups.counted(docs, extra=("n",)).cache()
    assert rollup.commit("one", rollups.inserts(counts))
    before = sorted(map(str, rollup.totals().collect()))
    assert not rollup.commit("one", rollups.inserts(counts))
    assert sorted(map(str, rollup.totals().collect())) == before
    rollup.compact()
    assert sorted(map(str, rollup.totals().collect())) == before
    assert not rollup.commit("one", rollups.inserts(counts))
    part = counts.where("doc_id = 6")
    assert rollup.commit("two", rollups.revisions(part.withColumn("old_tokens", F.col("tokens")).withColumn("tokens", F.lit(7))))
    row = rollup.totals().where("source = 'c'").first()
    assert (row.documents, row.tokens) == (1, 7)
    rollup.compact()
    assert rollup.commit("three", rollups.deletes(part.withColumn("tokens", F.lit(7))))
    assert rollup.totals().where("source = 'c'").count() == 0
    assert rollup.totals().agg(F.sum("documents")).first()[0] == docs.count() - 1


def test_broken_commit_is_written_over(spark, tmp_path):
    folder = tmp_path / "totals"
    rollup = rollups.Rollup(spark, str(folder))
    counts = rollups.counted(odd_docs(spark))
    rollups.inserts(counts).groupBy("source", "lang", "version").agg(F.sum("documents").cast("long").alias("documents"), F.sum("tokens").cast("long").alias("tokens")).write.parquet(str(folder / "batches" / "one"))
    (folder / "batches" / "one" / "_SUCCESS").unlink()
    assert rollup.totals().count() == 0
    assert rollup.commit("one", rollups.inserts(counts))
    assert rollup.totals().agg(F.sum("documents")).first()[0] == 10


def test_empty(spark, tmp_path):
    rollup = rollups.Rollup(spark, str(tmp_path / "totals"))
    assert rollup.commit("none", rollups.inserts(rollups.counted(no_docs(spark))))
    assert rollup.totals().count() == 0
