import random
import re
import zlib
from collections import Counter

import pytest
from llm.cases import LONG, documents, words
from hypothesis import given, settings, strategies as st

from clickloom.llm import queries, variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain_counts(rows, length=6, count=5, spoil=None):
    total = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if spoil and h % spoil == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= length and n >= count}


def one_edit(a, b):
    """By trying every edit."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(counts, times=5):
    """Neighbours by deleting a code point, which two words one edit apart have in common."""
    by_rest = {}
    for w in counts:
        for rest in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            by_rest.setdefault(rest, []).append(w)
    near = {w: set() for w in counts}
    for group in by_rest.values():
        for a in group:
            near[a] |= {b for b in group if b != a and b not in near[a] and one_edit(a, b)}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x.encode()), default=None)
        form[w] = best if best is not None and counts[best] >= times * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] is not None else None)
    return out


def told(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def table(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abé\U0001f600\0", min_size=1, max_size=7), min_size=1, max_size=40, unique=True))
def test_tiles_by_brute_force(given_words):
    for width in {len(w) + more for w in given_words for more in (0, 1)}:
        for side in (0, 1):
            tiles = variants._Tiles()
            tiles.add(width, side, [(w, 1) for w in given_words if width - 1 <= len(w) <= width], None)
            tiles.finish()
            want = set()
            for i, a in enumerate(given_words):
                for b in given_words[:i]:
                    common = next((p for p, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
                    if max(len(a), len(b)) == width and one_edit(a, b) and (common >= width // 2) == (side == 0):
                        want.add(frozenset((a, b)))
            assert {frozenset(x[:2]) for x in tiles.found} == want and len(tiles.found) == len(want)


@pytest.mark.parametrize("block", [3, 40, variants.BLOCK])
def test_groups_by_brute_force(spark, block):
    draw, counts = random.Random(block), {}
    for _ in range(300):
        # One beginning for a third of all words, so that a group is cut into blocks.
        start = draw.choice(["abcabc", "", ""])
        counts[start + "".join(draw.choices("abcé", k=draw.randint(0, 8)))] = draw.choice([5, 6, 30, 180, 1000, 9000])
    assert told(variants.group(table(spark, counts), block=block)) == plain_groups(counts)


def test_chain_of_forms(spark):
    chain = {"aaaaaa" + "b" * i: 5 * 6**i for i in range(12)}
    found = told(variants.group(table(spark, chain)))
    assert found == plain_groups(chain)
    assert {r[1] for r in found.values()} == {"aaaaaa" + "b" * 11}


def test_ties_repeated_rows_nulls_and_no_rows(spark):
    rows = [("haouse", 3), ("haouse", 2), ("haousé", 25), ("haousa", 25), (None, 9), ("x" * 5000, 7), ("x" * 4999, 70)]
    found = told(variants.group(spark.createDataFrame(rows, "word string, n long")))
    assert found["haouse"] == ("haousa", "haousa", 5, 2, 25)
    assert found["x" * 5000] == ("x" * 4999, "x" * 4999, 7, 1, 70)
    assert len(found) == 5
    assert variants.group(table(spark, {"a": 1}).where("false")).count() == 0
    with pytest.raises(ValueError):
        variants.group(table(spark, {"a": 1}), times=1)


def test_counts_by_brute_force(spark):
    draw = random.Random(4)
    rows = [(i, " ".join(draw.choices(["Strasse", "straßen", "ÉCOLES", "écoles", "naïveté×÷", "ab", "x1yyyyyyy", "日本語日本語", "àbcdefgh", "Ÿabcdef"], k=draw.randint(0, 60)))) for i in range(80)]
    rows += [(1, rows[1][1]), (None, "Strasse " * 9), (90, None), (91, ""), (92, LONG + "wordword " * 9), (93, "q" * 100_000)]
    docs = documents(spark, rows)
    for spoil in (None, 3):
        found = {r.word: r.n for r in variants.word_counts(docs, spoil=spoil).collect()}
        assert found == plain_counts(rows, spoil=spoil) and found
    assert variants.word_counts(docs.where("false")).count() == 0
    assert variants.word_counts(docs.where("text is null")).count() == 0


def test_words_beyond_what_a_task_keeps(spark, monkeypatch):
    monkeypatch.setattr(variants, "COUNTED", 10)
    rows = [(i, words(i % 7, 200)) for i in range(30)]
    found = {r.word: r.n for r in variants.word_counts(documents(spark, rows)).collect()}
    assert found == plain_counts(rows)


def test_query_by_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = queries.op11_variants(spark, sf_dir)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = plain_groups(plain_counts(docs, spoil=199))
    assert told(found) == want
    assert any(r[0] for r in want.values())
