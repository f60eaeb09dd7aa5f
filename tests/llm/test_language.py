import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm.language import identify, is_held_out, train, viterbi

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_viterbi_is_best_path():
    rng = np.random.default_rng(1)
    emission, rows = rng.normal(size=(11, 3)), np.array([0, 4, 4, 9, 11])
    label = viterbi(emission, rows, 1.0)
    for a, b in zip(rows[:-1], rows[1:]):
        def value(path):
            return sum(emission[a + i, p] for i, p in enumerate(path)) - sum(x != y for x, y in zip(path, path[1:]))
        if b > a:
            assert np.isclose(value(label[a:b]), max(map(value, itertools.product(range(3), repeat=b - a))))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = identify(docs, train(docs)).withColumn("held_out", is_held_out(F.col("doc_id")))
    right = out.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.min("score"), F.max("score")).first()
    assert right[0] > 0.98 and 0 <= right[1] <= right[2] <= 1
    assert out.count() == docs.count()


def test_spans_scripts_and_odd_rows(spark):
    random.seed(2)
    def say(words, n):
        return " ".join(random.choices(words, k=n))
    en, de, ru = ["the", "house", "and", "where", "thing"], ["der", "und", "schön", "Straße", "nicht"], ["дом", "и", "где", "человек"]
    data = [(i, say(w, 30), lang, None, 0) for i, (w, lang) in enumerate([(en, "en"), (de, "de"), (ru, "ru")] * 20)]
    model = train(spark.createDataFrame(data, SCHEMA))
    mixed = say(en, 20) + " " + say(de, 20)
    odd = [(1, mixed, None, None, 0), (2, None, None, None, 0), (3, "12 %", None, None, 0), (4, "где", None, None, 0), (5, "漢字", None, None, 0), (None, "", None, None, None)]
    out = {r.text: r for r in identify(spark.createDataFrame(odd, SCHEMA).withColumn("lang_pred", F.lit(1)), model, prefix="p_", spans=True).collect()}
    assert [s.lang for s in out[mixed].p_spans] == ["en", "de"] and out[mixed].p_spans[0].start == 0 and out[mixed].p_spans[1].end == len(mixed)
    assert [out[t].p_lang_pred for t in (None, "12 %", "где", "")] == ["und", "und", "ru", "und"]
    assert out["漢字"].p_lang_pred in ("en", "de", "ru") and out[None].p_score == 0
    empty = train(spark.createDataFrame([], SCHEMA))
    assert {r.lang_pred for r in identify(spark.createDataFrame(odd, SCHEMA), empty).collect()} == {"und"}
