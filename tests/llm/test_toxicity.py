"""Toxicity: the automaton against plain edit distance, context, accuracy, odd tables."""

import itertools
import random
import struct

import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from llm.cases import LONG, documents, words

from clickloom.llm import toxicity

WORDS = ["idiot", "scum", "moron", "worthless", "disgusting", "vile"]
STEMS = ["lowei", "garbagepre"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain(word):
    found = [d for t in WORDS if (d := distance(word, t)) <= toxicity._errors(t, False)]
    for stem in STEMS:
        near = min(distance(word[:i], stem) for i in range(len(word) + 1))
        if near <= toxicity._errors(stem, True):
            found.append(near)
    return min(found, default=None)


def near_terms(draw):
    word = list(draw.choice(WORDS + STEMS))
    for _ in range(draw.randint(0, 3)):
        at = draw.randrange(len(word) + 1)
        word[at : at + draw.randint(0, 1)] = draw.choices("idotscumrnvle", k=draw.randint(0, 1))
    return "".join(word) + draw.choice(["", "", "isch", "x"])


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.integers().map(lambda s: near_terms(random.Random(s))), st.text("idotscumrn", max_size=9)))
def test_matches_by_edit_distance(word):
    assert toxicity.Matcher(WORDS, STEMS).errors(word) == plain(word)


def test_dropped_states_change_nothing(monkeypatch):
    monkeypatch.setattr(toxicity.Matcher, "MOST_STATES", 3)
    matcher, draw = toxicity.Matcher(WORDS, STEMS), random.Random(4)
    for _ in range(300):
        word = near_terms(draw)
        assert matcher.errors(word) == plain(word)


def test_context_tells_quotation_from_abuse():
    model = toxicity.Model(WORDS, [])
    weight = {k: next(model.hits(t))[4] for k, t in {
        "abuse": "They are a moron and that is that", "quoted": 'They read "moron" on it', "reported": "someone said moron there",
        "addressed": "listen you moron", "other line": 'A "big\nmoron stays',
    }.items()}
    assert weight["quoted"] < weight["reported"] < weight["abuse"] == weight["other line"] == 1 < weight["addressed"]


@pytest.fixture(scope="module")
def trained(spark):
    draw, rows, labels = random.Random(1), [], []
    for i in range(900):
        text = words(i, 60).split()
        toxic = i % 6 == 0
        for _ in range(3 * toxic):
            text.insert(draw.randrange(60), draw.choice(["idiot", "scum", "worthless", f"lowei{draw.choice('abcdefgh')}{draw.choice('abcdefgh')}"]))
        rows.append((i, " ".join(text)))
        labels.append((i, None if i % 9 == 8 else int(toxic)))
    # Copies of one toxic document are no evidence for its other words.
    rows += [(2000 + i, "idiot " + words(5000, 40, "klmn")) for i in range(40)]
    labels += [(2000 + i, 1) for i in range(40)] + [(2000, 0), (None, 1), (77_777, 1)]
    docs, marks = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    return toxicity.fit(docs, marks), docs


def test_learned_lexicon(trained):
    model, _ = trained
    assert set(model.words) == {"idiot", "scum", "worthless"} and model.stems == ["lowei"]


def test_scores(spark, trained):
    model, docs = trained
    found = toxicity.score(docs, model, keep=["doc_id", "score"]).toPandas()
    assert list(found.columns) == ["doc_id", "score", "predicted"]
    toxic = (found["doc_id"] % 6 == 0) & (found["doc_id"] < 900) | (found["doc_id"] >= 2000)
    assert (found["predicted"] == toxic).mean() > 0.995 and found["score"].between(0, 1).all()
    odd = documents(spark, [(1, None), (2, ""), (3, "worthles idiots of lowei"), (3, "such plain words"), (None, LONG), (4, LONG + "idiot scum")])
    got = [(r.doc_id, r.predicted) for r in toxicity.score(odd, model).collect()]
    assert sorted(got, key=str) == sorted([(1, 0), (2, 0), (3, 1), (3, 0), (None, 0), (4, 1)], key=str)
    kept = toxicity.accepted(odd, model)
    assert kept.columns == odd.columns and kept.count() == 4


def test_no_labels_and_no_rows(spark, trained):
    model, docs = trained
    none = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(docs, none).where("predicted = 1").count() == 0
    assert toxicity.score(docs.where("false"), model).count() == 0


def test_accuracy_on_held_out_rows(spark):
    from clickloom.llm import queries

    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic is not null").toPandas()
    found = queries.op3_toxicity(spark, sf_dir).toPandas().merge(labels, on="doc_id")
    found = found[found["held_out"]]
    toxic = found[found["toxic"] == 1]
    assert (found["predicted"] == found["toxic"]).mean() > 0.97 and toxic["predicted"].mean() > 0.85


def test_only_verified_copies_are_left_out(spark):
    draw, lists, rows = random.Random(8), [words(i, 400, "abcdef").split() for i in range(3)], []
    # Documents with a common passage, but hardly an eighth of their shingles in common.
    for i in range(300):
        rows.append((i, " ".join([*draw.choice(lists)[:40], *words(1000 + i, 300).split()]), i % 2))
    rows += [(400 + i, " ".join([*lists[0], f"end{i}"]), 0) for i in range(50)]
    rows += [(500 + i, " ".join(lists[0]).upper(), 0) for i in range(50)] + [(600, " ".join(lists[0]), 1), (600, "other text", 1)]
    rows += [(700, "", 0), (701, "two words", 0), (702, "Two, words!", 0)]
    sample = spark.createDataFrame(rows, "id long, text string, toxic int")
    kept = toxicity.without_copies(sample)
    assert kept.columns == ["id", "text", "toxic"]
    got = kept.collect()
    ids = sorted(r.id for r in got)
    assert [i for i in ids if i < 300] == list(range(300))
    assert sum(400 <= i < 600 for i in ids) == 1 and [i for i in ids if i in (600, 700)] == [600, 600, 700]
    assert sum(i in (701, 702) for i in ids) == 1 and len({(r.id, r.text) for r in got}) == len(got)


def spark_hash(seed, value):
    """Spark's xxhash64 of a long, an int or a text, from a seed on."""
    data = value.encode() if isinstance(value, str) else value
    return xxhash.xxh64_intdigest(data, seed)


def signed(number):
    return number - (1 << 64) if number >> 63 else number


def test_rounds_start_from_what_is_left_and_find_the_same_copies(spark, monkeypatch):
    draw, base, rows = random.Random(4), words(1, 100).split(), []
    for i in range(300):  # one large group, where only some are near enough
        text = list(base)
        for k in range(draw.randrange(4)):
            text[draw.randrange(100)] = f"x{i}y{k}"
        rows.append((i, " ".join(text), 0))
    rows = [r for i, r in enumerate(rows) if r[1] not in {x[1] for x in rows[:i]}]
    rows += [(1000 + i, words(2000 + i, 60), i % 2) for i in range(300)]
    tables, save = [], toxicity.saved

    def joins(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("LeftAnti")

    def saved(df, label, *more):
        tables.append((label, joins(df), out := save(df, label, *more)))
        return out

    monkeypatch.setattr(toxicity, "saved", saved)
    kept = toxicity.without_copies(spark.createDataFrame(rows, "id long, text string, toxic int"))

    # The same rounds in plain Python.
    keys = [signed(spark_hash(spark_hash(42, struct.pack("<q", i)), text)) for i, text, _ in rows]
    columns = [pa.array(x) for x in (keys, [r[2] for r in rows], [r[1] for r in rows])]
    table = next(toxicity._copy_keys([pa.RecordBatch.from_arrays(columns, ["key", "toxic", "text"])]))
    sets = dict(zip(keys, map(set, table.column(2).to_pylist()), strict=True))
    left = {k: [(r[2], b) for b in bands] for k, r, bands in zip(keys, rows, table.column(3).to_pylist(), strict=True)}
    for rounds in itertools.count(1):
        order = {k: signed(spark_hash(spark_hash(42, struct.pack("<q", k)), struct.pack("<i", rounds - 1))) for k in left}
        leader = {}
        for k in sorted(left, key=order.get, reverse=True):
            leader.update(dict.fromkeys(left[k], k))
        pairs = {(k, leader[b]) for k, bands in left.items() for b in bands if leader[b] != k}
        alike = {(k, o) for k, o in pairs if len(sets[k] & sets[o]) >= toxicity.COPY * len(sets[k] | sets[o])}
        going = {k for k, _ in alike}
        if not going:
            break
        for k in {k for k, o in alike if o not in going}:
            del left[k]
    assert sorted(r.id for r in kept.collect()) == sorted(r[0] for k, r in zip(keys, rows, strict=True) if k in left)

    # No round makes those before it anew, and rows that share no band are in the first only.
    assert [label for label, _, _ in tables].count("copy-pairs") == rounds >= 4
    assert max(n for _, n, _ in tables) == joins(kept) == 1
    later = [t.count() for label, _, t in tables if label == "copy-left"]
    assert len(later) == rounds - 1 and 300 > later[0] >= later[-1] > 0


def test_many_rows_of_one_id_do_not_break_the_bound(spark):
    rows = [(1, f"text {i}") for i in range(3000)] + [(1, "copy")] * 3000 + [(i, f"own {i}") for i in range(2, 500)]
    rows += [(2, None), (None, "no id"), (9000, "no label")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 500)] + [(3, 0), (4, None)], "doc_id long, toxic int")
    sample = toxicity.labelled_sample(documents(spark, rows), labels, "doc_id", "text", "toxic", 600)
    got = [tuple(r) for r in sample.collect()]
    assert 450 < len(got) < 750 and len(set(got)) == len(got)
    assert {i for i, _, _ in got} <= set(range(1, 500)) and all(toxic == i % 2 for i, _, toxic in got)
    every = toxicity.labelled_sample(documents(spark, rows), labels, "doc_id", "text", "toxic", 10_000)
    want = {(i, text, i % 2) for i, text in rows if i in range(1, 500) and text is not None}
    assert sorted(tuple(r) for r in every.collect()) == sorted(want)


def test_six_toxic_documents_and_no_clean_one_are_evidence(spark):
    counts = spark.createDataFrame([(6, 0), (4, 0), (4, 1)], "toxic long, clean long")
    told = counts.select("*", toxicity._telling(342, 2703, min(toxicity.EVIDENCE)).alias("told")).collect()
    assert [(r.toxic, r.clean) for r in told if r.told] == [(6, 0)]


def test_long_compounds_are_matched():
    model = toxicity.Model(WORDS, STEMS)
    assert [model.errors("lowei" + "x" * n) for n in (10, 43, 44, 100_000)] == [0] * 4
    assert model.errors("q" * 100_000) is None and all(len(w) <= 48 for w in model._known)
