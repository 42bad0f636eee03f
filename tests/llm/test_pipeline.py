"""The pipeline's stages on a small table, and on awkward rows."""

from collections import Counter

import corpus_pipeline
from metaseries.llm.shared import stash
from metaseries.llm.tokens import TokenCache

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_the_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "benchmark", "packing"]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stash(stage(spark, before, SF))
        assert after.schema.names == docs.schema.names, name
        assert after.select("doc_id").subtract(before.select("doc_id")).isEmpty()
        before = after
    assert 0 < before.count() < docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert last.select("doc_id").distinct().count() == before.count()


def test_awkward_rows_pass_every_stage(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "some text with a few words in it", "en", "s", 32), (3, "a b c", None, None, 5), (3, "a b c", None, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, table, SF)
            left = Counter((r.doc_id, r.text) for r in table.collect())
            if name == "packing":
                # an end id each, and the texts' own ids
                ids = sum(len(TokenCache.of().whole(t or "")) // 4 + 1 for _, t in left.elements())
                assert sum(r.length for r in found.collect()) == ids
                continue
            kept = Counter((r.doc_id, r.text) for r in found.collect())
            if name == "quality":
                assert kept <= left
            elif name == "near_duplicates":
                assert kept == Counter(dict.fromkeys(left, 1))
            else:
                assert kept == left
