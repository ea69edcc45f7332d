import numpy as np

import messy
from conftest import SF_MID
from tastemap.llm import langid


def test_held_out_accuracy(spark):
    got = langid.op6(spark, SF_MID).join(spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 100 and sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_families_join_the_closest():
    rng = np.random.default_rng(0)
    a, b = rng.random(50), rng.random(50)
    rows = np.stack([a, b, a + 0.05 * rng.random(50), b + 0.05 * rng.random(50)])
    assert langid.families_of(rows) == [[0, 2], [1, 3]]
    assert langid.families_of(rows[:1]) == [[0]]


def test_vectors_count_byte_grams_of_each_row_alone():
    data = np.frombuffer(b"abab" + b"" + b"ABAB" + b"z", np.uint8)
    x = langid.vectors(data, np.array([0, 4, 4, 8, 9]))
    assert np.allclose(x[0], x[2]) and (x[1] == 0).all() and (x[3] > 0).sum() == 1
    assert np.allclose((x[[0, 2, 3]] ** 2).sum(1), 1)


def test_awkward_rows(spark):
    docs = messy.docs(spark)
    model = langid.train(docs)
    got = langid.predict(docs, model).collect()
    assert len(got) == len(messy.TEXTS) and model["names"] == ["de", "en", "fr"]
    for r in got:
        assert r.lang_pred in ("de", "en", "fr", "und") and 0 <= r.score <= 1
        if r.doc_id in (3, 4, 5):
            assert r.lang_pred == "und" and r.score == 0
    only = spark.createDataFrame([(1, "123 !? 😀"), (2, "日本")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred != "und" for r in langid.predict(only, model).collect()} == {1: False, 2: True}


def test_repeatable_and_one_language(spark):
    docs = messy.docs(spark)
    a, b = langid.train(docs), langid.train(docs.repartition(5))
    assert all(np.allclose(x, y) for x, y in zip(a["top"], b["top"]))
    one = langid.train(docs.filter("lang = 'en'"))
    assert {r.lang_pred for r in langid.predict(docs, one).collect()} == {"en", "und"}


def test_rows_without_an_id_teach_and_repeated_rows_count_once(spark):
    docs = messy.docs(spark)
    bare = langid.train(docs.withColumn("doc_id", docs.doc_id * None))
    assert bare["names"] == ["de", "en", "fr"]
    again = langid.train(docs.unionByName(docs).unionByName(docs.filter("doc_id = 10")))
    assert all(np.allclose(x, y) for x, y in zip(langid.train(docs)["top"], again["top"]))
    pure = docs.filter("lang = 'fr'")
    assert {r.lang_pred for r in langid.predict(pure, langid.train(docs)).collect()} == {"fr"}


def test_empty_table(spark):
    assert langid.train(messy.docs(spark, [])) is None
    assert {r.lang_pred for r in langid.predict(messy.docs(spark), None).collect()} == {"und"}
