import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm.pieces import MODEL
from tests.llm.test_near_join import brute
from tests.llm.test_private import brute as private_spans


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(stage(spark, kept[-1], small).cache())
    assert all(k.columns == columns for k in kept[:-1])
    after_language = kept[1].collect()
    assert len(after_language) >= 0.95 * docs.count()
    after_near = {r.doc_id for r in kept[2].collect()}
    assert after_near == {c for _, c, _ in brute([(r.doc_id, r.text) for r in after_language])} and kept[2].count() == len(after_near)
    assert not any(private_spans(r.text) for r in kept[3].collect())
    assert {r.doc_id for r in kept[3].collect()} == after_near
    mixed = kept[4].groupBy("doc_id").count().agg(F.max("count")).first()[0]
    assert 1 <= mixed <= 3
    model, text = sentencepiece.SentencePieceProcessor(model_file=MODEL), {r.doc_id: r.text for r in kept[4].collect()}
    rows = kept[5].collect()
    assert len(rows) == kept[4].count() and all(r.ids == model.encode(text[r.doc_id]) for r in rows)
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, small).collect()) == sorted(r.doc_id for r in rows)
