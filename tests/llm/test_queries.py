"""The registered queries against SQL, and the pipeline against a plain version of it."""

import random

import corpus_pipeline
import numpy as np
import pytest
from compare import connect, difference
from llm.cases import words
from llm.test_packing import check
from llm.test_simhash import classes, plain

from clickloom.llm import langid, queries, toxicity


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_all_are_there():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.queries()) == list(range(1, 14))


@pytest.mark.parametrize("name", queries.SQL)
def test_same_as_sql(spark, sf_dir, con, name):
    assert difference(queries.queries()[name](spark, sf_dir), con, queries.SQL[name]) is None


def test_similar_documents_by_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    prints = {r.doc_id: plain(r.text) for r in docs}
    want = classes(prints)
    found = queries.op6_simhash(spark, sf_dir).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in found} == {(i, f"{p:016x}", want[i]) for i, p in prints.items()}


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents with toxic ones, near copies and junk, and labels."""
    folder, draw, rows = str(tmp_path_factory.mktemp("corpus")), random.Random(2), []
    for i in range(400):
        text = words(i, draw.randint(80, 400), "abcdefgh" if i % 2 else "stuvwxyz").split()
        for _ in range(4 * (i % 5 == 0)):
            text.insert(draw.randrange(len(text)), draw.choice(["idiot", "scum"]))
        rows.append((i, " ".join(text), "en" if i % 2 else "de", "src0", len(text)))
    rows += [(1000 + i, rows[i][1] + " end", rows[i][2], "src1", 5) for i in range(1, 60)]
    rows += [(2000 + i, t, "en", "src2", 0) for i, t in enumerate([None, "", "12 34", "!!!"])]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i % 5 == 0)) for i in range(400)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows


def test_pipeline_by_brute_force(spark, corpus):
    folder, rows = corpus
    left = [(i, t) for i, t, *_ in rows if langid.has_letter(t)]
    # The lexicon is known here, so the toxicity stage has a plain version.
    left = [(i, t) for i, t in left if not {"idiot", "scum"} & set(t.split())]
    want = classes({i: plain(t) for i, t in left})
    left = [(i, t) for i, t in left if want[i] == i]
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert {p.doc_id for p in pieces} == {i for i, _ in left}
    check(left, pieces, 1024)


def test_stages_keep_the_columns(spark, corpus):
    folder, rows = corpus
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language ID", "toxicity", "SimHash near-dedup", "packing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns and 0 < kept.count() < len(rows)


def test_stages_on_no_documents(spark, corpus):
    folder, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_learned_queries_keep_to_their_folds(spark, sf_dir):
    """Labels of held-out rows change nothing."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = langid.held_out("doc_id", 4, 2)
    a = langid.fit(docs.where(~held))
    b = langid.fit(docs.withColumn("lang", langid.F.when(held, "xx").otherwise(docs["lang"])).where(~held))
    assert a.languages == b.languages and np.array_equal(a.weights, b.weights)
    assert toxicity.TRAIN_ROWS >= 10_000
