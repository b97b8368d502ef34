"""Language ID: accuracy on held-out rows, codes, and texts without a language."""

import numpy as np
import pytest
from llm.cases import LONG, documents

from clickloom.llm import langid


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return langid.fit(docs.where(~langid.held_out("doc_id", 4, 2)))


def test_accuracy_on_held_out_rows(spark, sf_dir, model):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where(langid.held_out("doc_id", 4, 2))
    found = langid.identify(docs, model).toPandas()
    assert len(found) >= 30 and (found["lang"] == found["lang_pred"]).mean() >= 0.95
    assert found["score"].between(0, 1).all()


def test_labels_are_no_input(spark, model):
    rows = documents(spark, [(1, "le la de que et est un une pour dans")])
    a = langid.identify(rows, model).first()
    b = langid.identify(rows.replace("en", "de", ["lang"]).replace("src0", "x", ["source"]), model).first()
    assert (a.lang_pred, a.score) == (b.lang_pred, b.score)


def test_texts_without_letters(spark, model):
    rows = [(1, None), (2, ""), (3, " 12 :-) ½"), (3, " 12 :-) ½"), (4, "the and of"), (None, LONG)]
    docs = documents(spark, rows).withColumnRenamed("fingerprint", "lang_pred")
    found = langid.identify(docs, model)
    assert found.columns.count("score") == found.columns.count("lang_pred") == 1
    got = found.collect()
    assert [(r.lang_pred, r.score) for r in got if r.doc_id in (1, 2, 3)] == [("und", 0.0)] * 4
    assert all(r.lang_pred in model.languages and 0 < r.score <= 1 for r in got if r.doc_id not in (1, 2, 3))
    kept = langid.accepted(docs, model)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 4]


def test_steps_do_not_change_the_answer(model, monkeypatch):
    text = "Voilà ein Text with several λέξεις in it, " * 50
    whole = model.margins(text)
    monkeypatch.setattr(langid, "STEP", 97)
    assert np.allclose(whole, model.margins(text))


@pytest.mark.parametrize("languages", [2, 3, 5, 6, 40])
def test_codewords_lie_apart(languages):
    codes = langid.codewords(languages).astype(int)
    apart = (codes[:, None, :] != codes[None, :, :]).sum(axis=2) + 99 * np.eye(languages, dtype=int)
    assert apart.min() >= max(1, codes.shape[1] // 4) and (abs(codes.sum(axis=0)) < languages).all()


def test_one_language_and_none(spark):
    docs = documents(spark, [(1, "some text"), (2, None)])
    one = langid.identify(docs, langid.fit(docs)).collect()
    assert [(r.lang_pred, r.score) for r in one] == [("en", 1.0), ("und", 0.0)]
    none = langid.fit(docs.where("false"))
    assert {r.lang_pred for r in langid.identify(docs, none).collect()} == {"und"}
    assert langid.identify(docs.where("false"), none).count() == 0


def test_equally_near_languages_are_ambiguous(spark):
    rows = [(f"aaa bbb {i}", "x") for i in range(20)] + [(f"aaa bbb {i}", "y") for i in range(20)]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert model.predict("aaa bbb")[::2] == ("x", True)


def test_held_out(spark):
    import zlib

    rows = spark.range(200).withColumn("h", langid.held_out("id", 4, 2)).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)
    assert spark.sql("select cast(null as long) id").select(langid.held_out("id", 4, 2)).first()[0] is False


@pytest.fixture(scope="module")
def larger(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rest = docs.where(langid.held_out("doc_id", 4, 2)).toPandas()
    words = {lang: " ".join(texts["text"].dropna()).split() for lang, texts in rest.groupby("lang")}
    return docs.where(~langid.held_out("doc_id", 4, 2)), rest, words


def test_halves_of_two_languages_are_ambiguous_at_any_length(larger):
    docs, rest, words = larger
    model, draw = langid.fit(docs), np.random.default_rng(5)
    for n in (10, 50, 200, 1000, 5000):
        found = []
        for _ in range(40):
            halves = []
            for lang in draw.choice(sorted(words), 2, replace=False):
                at = draw.integers(max(1, len(words[lang]) - n))
                halves += words[lang][at : at + n]
            found.append(model.predict(" ".join(halves)))
        assert np.mean([ambiguous for _, _, ambiguous in found]) >= (0.7 if n == 10 else 0.9), n
        assert all(score <= 0.75 for _, score, ambiguous in found if ambiguous)
    assert np.mean([model.predict(text)[2] for text in rest["text"]]) <= 0.02


def test_a_language_that_was_not_learned_is_ambiguous(larger):
    docs, rest, _ = larger
    model = langid.fit(docs.where("lang <> 'de'"))
    unknown = rest["lang"] == "de"
    assert np.mean([model.predict(text)[2] for text in rest["text"][unknown]]) >= 0.9
    assert np.mean([model.predict(text)[2] for text in rest["text"][~unknown]]) <= 0.03
