"""SimHash near-duplicates against brute force."""

import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from llm.cases import LONG, documents, words

from clickloom.llm import components, simhash


def plain(text):
    """The fingerprint by the definition, bit by bit."""
    tokens = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + 4]) for i in range(max(1, len(tokens) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, bits=4):
    """The smallest id that each id reaches, by repeated minimum over all pairs."""
    ids, values = list(prints), np.array(list(prints.values()), np.uint64)
    near = [np.flatnonzero(np.bitwise_count(values ^ v) <= bits) for v in values]
    label = list(ids)
    while True:
        new = [min(label[j] for j in n) for n in near]
        if new == label:
            return dict(zip(ids, label))
        label = new


@settings(max_examples=60, deadline=None)
@given(st.one_of(st.none(), st.text(max_size=60), st.text("aB \t\n\x0b\x1c ", max_size=40)))
def test_fingerprint_by_definition(text):
    assert simhash.fingerprint(None if text is None else text.encode("utf-8", "replace")) == plain(text)


def test_golay_code():
    leaders, near, far, tails = simhash._golay()
    codewords = (np.arange(4096) << 11) | tails
    weights = np.bincount(np.bitwise_count(codewords), minlength=24)
    assert {w: int(n) for w, n in enumerate(weights) if n} == {0: 1, 7: 253, 8: 506, 11: 1288, 12: 1288, 15: 506, 16: 253, 23: 1}
    assert np.bitwise_count(leaders).max() == 3 and len(np.unique(leaders)) == 2048
    assert near.shape == (2048, 6) and far.shape == (2048, 22)


@pytest.mark.parametrize("bits", [0, 1, 3, 4])
def test_links_are_all_pairs_in_reach(spark, bits):
    draw = np.random.default_rng(bits)
    base = draw.integers(0, 2**64, 40, dtype=np.uint64)
    values = [base]
    for flips in (1, 2, 3, 4, 4, 5):
        moved = base.copy()
        for i in range(len(moved)):
            for bit in draw.choice(64, flips, replace=False):
                moved[i] ^= np.uint64(1) << np.uint64(bit)
        values.append(moved)
    signed = np.sort(np.unique(np.concatenate(values)).view(np.int64))
    found = simhash.links(spark.createDataFrame([(int(v),) for v in signed], "print long"), bits).collect()
    want = {(int(a), int(b)) for i, a in enumerate(signed) for b in signed[i + 1 :] if np.bitwise_count(np.int64(a ^ b).view(np.uint64)) <= bits}
    assert len(found) == len(want) and {(r.a, r.b) for r in found} == want


def test_more_bits_than_the_code_finds_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.range(1).withColumnRenamed("id", "print"), 5)


def test_components_of_a_chain_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (None, 3), (3, 2), (3, 2)]
    found = components.components(spark.createDataFrame(pairs, "x long, y long"), "x", "y").collect()
    roots = {r.node: r.root for r in found}
    assert len(found) == len(roots)
    assert roots == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


def test_no_links(spark):
    assert components.components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


ROWS = [
    (1, words(1, 300)), (2, words(1, 300)), (3, words(1, 300) + " more"), (4, words(1, 299)), (9, words(2, 50)),
    (5, None), (6, ""), (7, " \t\n"), (8, "one two"), (8, "one two"), (10, "ONE\ttwo"), (None, words(1, 300)), (11, LONG),
]


def test_components_by_brute_force(spark):
    found = simhash.near_duplicates(documents(spark, ROWS)).collect()
    assert len(found) == len(ROWS)
    prints = {i: plain(t) for i, t in ROWS if i is not None}
    want = classes(prints)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r["print"] & (2**64 - 1) == plain(words(1, 300))
        else:
            assert (r["print"] & (2**64 - 1), r.component_id) == (prints[r.doc_id], want[r.doc_id])
    assert want[2] == 1 and want[6] == want[7] == 5 and want[10] == 8


def test_one_of_each_stays(spark):
    docs = documents(spark, ROWS)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    want = classes({i: plain(t) for i, t in ROWS if i is not None})
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({i for i in want if want[i] == i}) and ids.count(None) == 1


@pytest.mark.parametrize(
    "given_rows, want",
    [
        ("1a 1b 2c", "1a 1b 2c"),
        ("1a 2a 2b 3c", "1a 2b 3c"),
        ("2a 1b 1a 3a", "1a 1b"),
        ("1a 1a 1b 2b 5b", "1a 1b"),
        ("4a 4a 4b 3b", "3b 4a"),
    ],
)
def test_one_id_on_different_texts(spark, given_rows, want):
    texts = {x: words(i, 60) for i, x in enumerate("abc")}
    rows = [(int(r[0]), texts[r[1]]) for r in given_rows.split()]
    kept = simhash.one_of_each(documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted((int(r[0]), texts[r[1]]) for r in want.split())


def test_empty_table(spark):
    docs = documents(spark, [])
    assert simhash.near_duplicates(docs).count() == 0 and simhash.one_of_each(docs).count() == 0


def test_many_copies_are_one_class(spark):
    rows = [(i, words(3, 30)) for i in range(400)] + [(1000 + i, words(i, 30)) for i in range(20)]
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(documents(spark, rows)).collect()}
    assert {found[i] for i in range(400)} == {0}
