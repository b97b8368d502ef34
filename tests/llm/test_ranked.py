import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from llm.cases import LONG, documents

from clickloom.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def plain(docs, items, k=10):
    counted = [(i, Counter(plain_terms(t))) for i, t in docs if i is not None]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(c.total() for _, c in counted)
    df = Counter(term for _, c in counted for term in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(plain_terms(t))
    out = set()
    for item, terms in asked.items():
        scores = []
        for doc, c in counted:
            m = 10 + 90 * c.total() * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms
                if t in c
            )
            if score > 0:
                scores.append((-score, doc))
        out |= {(item, r, doc, -score) for r, (score, doc) in enumerate(sorted(scores)[:k], 1)}
    return out


def told(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len({r[:2] for r in rows})
    return set(rows)


@given(st.text())
def test_terms(text):
    text = text.encode("utf-8", "ignore").decode()
    assert [t.decode() for t in ranked.terms_of(text.encode())] == plain_terms(text)


@settings(max_examples=50, deadline=None)
@given(st.randoms(use_true_random=False), st.integers(1, 12), st.sampled_from([0, 0.01, 0.2, 1]))
def test_best_by_brute_force(draw, k, short):
    n = draw.choice([1, 50, 2048, 2049, 7000])
    lists, total = [], np.zeros(n, np.int64)
    for _ in range(draw.randint(0, 7)):
        places = np.array(sorted(draw.sample(range(n), draw.randint(1, max(1, int(n * draw.choice([0.002, 0.1, 1])))))), np.int64)
        scores = np.array(draw.choices([0, 1, 2, 50, 51], k=len(places)), np.int64)
        total[places] += scores
        lists.append((places, scores))
    ids = np.array(draw.sample(range(n), n))
    at, scores = ranked.best(lists, ids, k, short)
    want = sorted((-s, i) for s, i in zip(total.tolist(), ids.tolist()) if s > 0)[:k]
    assert [(-s, i) for s, i in zip(scores.tolist(), ids[at].tolist())] == want


def test_windows_below_the_threshold_are_passed_over(monkeypatch):
    """Beyond the first window nothing can reach the k-th score, so no sums are made there."""
    n = 20 * ranked.DOCS
    first = np.zeros(n, np.int64)
    first[:10] = 1000
    looked, at = [], ranked._List.window
    monkeypatch.setattr(ranked._List, "window", lambda self, i: looked.append(i) or at(self, i))
    ranked.best([(np.arange(n), first + 1), (np.arange(0, n, 2), first[::2] + 1)], np.arange(n), 5, 0)
    assert set(looked) == {0}


def vocabulary_rows(seed, n):
    draw = random.Random(seed)
    terms = [f"w{i}" for i in range(300)] + ["É", "日本", "x9"]
    weights = [1 / (i + 1) for i in range(len(terms))]
    return [(i, " ".join(draw.choices(terms, weights, k=draw.randint(0, 80)))) for i in range(n)]


@pytest.mark.parametrize("chunk,block", [(7, 3), (40, 1000)])
def test_search_by_brute_force(spark, monkeypatch, chunk, block):
    monkeypatch.setattr(ranked, "CHUNK_DOCS", chunk)
    docs, items = vocabulary_rows(1, 300), vocabulary_rows(2, 20)
    found = ranked.search(documents(spark, docs), documents(spark, items), 10, item_id="doc_id", items_a_block=block)
    assert told(found) == plain(docs, items)


def test_nulls_ties_repeated_rows_and_long_texts(spark):
    docs = [(i, "Apple-pie AND apple") for i in range(9, 0, -1)] + [(3, "apple pie"), (3, "apple pie"), (None, "apple"), (20, None), (21, ""), (22, "..."), (23, LONG + "apple"), (24, "côte d'azur")]
    items = [(1, "apple"), (1, "PIE"), (2, None), (3, ""), (None, "apple"), (4, "unknown"), (5, "word"), (6, "côte d azur azur"), (7, "pie"), (7, "pie")]
    table = documents(spark, items).withColumnRenamed("doc_id", "item_id").withColumn("rank", ranked.F.lit(1)).withColumn("block", ranked.F.lit(1))
    found = told(ranked.search(documents(spark, docs).withColumn("chunk", ranked.F.lit(0)), table, 10))
    assert found == plain(docs, items) and len(found) > 20


def test_no_rows(spark):
    docs, items = documents(spark, [(1, "a b")]), documents(spark, [(1, "a")])
    for a, b in ((docs.where("false"), items), (docs, items.where("false")), (docs.where("false"), items.where("false"))):
        assert ranked.search(a, b, 10, item_id="doc_id").count() == 0
    # A term in all documents weighs something as long as they are few.
    assert told(ranked.search(docs, items, 10, item_id="doc_id")) == plain([(1, "a b")], [(1, "a")])


def test_index_of_all_terms(spark):
    rows = vocabulary_rows(3, 50)
    lists = ranked.index(documents(spark, rows)).collect()
    df = Counter()
    for r in lists:
        if r.term is not None:
            df[r.term.decode()] += r.docs
            assert len(r.places) == len(r["values"]) == 4 * r.docs
    assert df == Counter(t for _, text in rows for t in set(plain_terms(text)))
