"""Packing: every id in exactly one place, windows gapless, best fit as by brute force."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from llm.cases import LONG, documents, words
from tokenizers import Tokenizer

from clickloom.llm import packing

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
ENCODER, LIBRARY = packing.Encoder(PATH), Tokenizer.from_file(PATH)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.text(max_size=50), st.text("ab 's\n\t\xa0é1ß.中<|endoftext|>", max_size=40)))
def test_ids_as_the_library_gives_them(text):
    text = text.encode("utf-8", "replace").decode()
    assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == ids_of(text)


@pytest.mark.parametrize("text", ["<|endoftext|>", "a<|endoftext|> b", "  x\n\n y  ", "a" * 5000, " " * 3000 + "x", "ab" * 3000, "", "中文 text"])
def test_ids_of_odd_texts(text):
    assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == ids_of(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=80))
def test_best_fit_by_brute_force(lengths):
    lengths.sort(reverse=True)
    placed, made = packing.best_fit(lengths, 32)
    room: list[int] = []
    for length in lengths:
        fits = [r for r in room if r >= length]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - length)
        else:
            room.append(32 - length)
    used = [0] * made
    for length, (window, offset) in zip(lengths, placed):
        assert offset == used[window]
        used[window] += length
    assert sorted(32 - u for u in used) == sorted(room)


ROWS = [(i, words(i, random.Random(i).randint(1, 900))) for i in range(60)] + [
    (100, None), (101, ""), (102, LONG), (103, LONG), (103, LONG), (None, "no id"), (104, "ALL ß 中 <|endoftext|>"),
]


def check(rows, pieces, window):
    """All that must hold of any packing."""
    by_sequence, by_doc = {}, {}
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"] and 0 < p["length"] <= window
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        by_doc.setdefault(p["doc_id"], []).append(p)
    for placed in by_sequence.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= window
    texts = {}
    for key, text in rows:
        texts.setdefault(key, []).append(text)
    assert set(by_doc) == set(texts)
    for key, copies in texts.items():
        want = np.array([*ids_of(copies[0]), 0], "<u4")
        found = sorted((p["start"], bytes(p["ids"])) for p in by_doc[key])
        assert sum(len(x) for _, x in found) == len(copies) * 4 * len(want)
        for start, ids in found:
            assert ids == want[start : start + len(ids) // 4].tobytes()
        assert {p["doc_tokens"] for p in by_doc[key]} == {len(want)}
    return len(by_sequence)


@pytest.mark.parametrize("block", [packing.BLOCK_TOKENS, 3000])
def test_every_id_is_in_one_place(spark, block):
    pieces = packing.pack(documents(spark, ROWS).coalesce(1), PATH, block_tokens=block).collect()
    sequences = check(ROWS, pieces, 1024)
    if block > 3000:
        assert sum(p["length"] for p in pieces) > 0.98 * 1024 * sequences


@pytest.mark.parametrize("partitions", [1, 40])
def test_padding_does_not_depend_on_files(spark, partitions):
    """Also where every partition holds a few documents only."""
    rows = [(i, words(i, random.Random(i).randint(1, 300))) for i in range(200)]
    pieces = packing.pack(documents(spark, rows).repartition(partitions), PATH).collect()
    lengths = [len(ids_of(t)) + 1 for _, t in rows]
    rests = sorted((n % 1024 for n in lengths if n % 1024), reverse=True)
    assert check(rows, pieces, 1024) == sum(n // 1024 for n in lengths) + packing.best_fit(rests, 1024)[1]


def test_one_document_on_most_rows(spark):
    """Copies are dealt to groups like other rests."""
    rows = [(7, words(1, 100))] * 300 + ROWS[:5]
    check(rows, packing.pack(documents(spark, rows), PATH, block_tokens=5000).collect(), 1024)


def test_other_windows(spark):
    check(ROWS[:20], packing.pack(documents(spark, ROWS[:20]), PATH, window=64).collect(), 64)


def test_empty_table(spark):
    assert packing.pack(documents(spark, []), PATH).count() == 0


def test_query_digests(spark, tmp_path):
    from clickloom.llm import queries

    documents(spark, ROWS).write.parquet(f"{tmp_path}/documents.parquet")
    ids = {k: np.array([*ids_of(t), 0], "<u4") for k, t in ROWS}
    for r in queries.op1_packing(spark, str(tmp_path)).collect():
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
