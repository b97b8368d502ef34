"""BPE encoding by dynamic programming over prefixes, and decoding.

Every prefix of a word has exactly one encoding, so its last token is unique. It is the
one token that ends the prefix, and that is compatible with the last token of the prefix
before it. An automaton over all tokens gives, at every position, the tokens that are a
suffix of the prefix; a pair of tokens is compatible if no merge would have crossed
their border before both were complete. Back-pointers over last tokens give the ids.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.wordcache import BLANKS, LATIN, LATIN_TEXT, WordCache, char_ranges

#: What marks a letter that ends a word, added to its code.
LAST = 0x10000
NEVER = 1 << 60


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others get the codes from 256 on, in order."""
    itself = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in itself]
    return {b: chr(b) for b in itself} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Vocabulary:
    """A tokenizer file with byte-level BPE and a mark on the last letter of a word."""

    def __init__(self, path: str):
        import ahocorasick

        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model, added = whole["model"], whole["added_tokens"]
        if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "byte_fallback", "continuing_subword_prefix")):
            raise ValueError("a BPE model without dropout, byte fallback and prefixes is needed")
        self.mark = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in added}
        self.ids: dict[str, int] = model["vocab"]
        self.strings = {i: s for s, i in self.ids.items()} | {i: s for s, i in self.special.items()}
        parts = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.merges: dict[tuple[int, int], int] = {}
        made: dict[int, tuple[int, int, int]] = {}
        for rank, (left, right) in enumerate(parts):
            joined = left[: len(left) - len(self.mark)] if self.mark and left.endswith(self.mark) else left
            a, b, c = self.ids[left], self.ids[right], self.ids[joined + right]
            self.merges[a, b] = rank
            made.setdefault(c, (a, b, rank))
        self.made = made
        self._spines: dict[tuple[int, bool], tuple[tuple[int, int], ...]] = {}
        self.fits: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for string, i in self.ids.items():
            letters = self._letters(string)
            if len(letters) == 1 or (i in made and self._whole(i)):
                self.automaton.add_word(letters, (i, len(letters)))
        self.automaton.make_automaton()
        self.of_byte = byte_letters()
        self.translate = str.maketrans({chr(b): c for b, c in self.of_byte.items()})

    def _letters(self, token: str) -> str:
        """The token as letters of the automaton: a last letter of a word is another letter."""
        if self.mark and token.endswith(self.mark) and token != self.mark:
            token = token[: len(token) - len(self.mark)]
            return token[:-1] + chr(ord(token[-1]) + LAST)
        return token

    def _spine(self, token: int, right: bool) -> tuple[tuple[int, int], ...]:
        """What stands at an edge of the token while it is built: (token, rank of the merge
        that takes it up), from the letter to the token itself."""
        if (token, right) not in self._spines:
            steps, at, taken = [], token, NEVER
            while True:
                steps.append((at, taken))
                if at not in self.made:
                    break
                left, last, taken = self.made[at]
                at = last if right else left
            self._spines[token, right] = tuple(reversed(steps))
        return self._spines[token, right]

    def crosses(self, a: int, b: int, before: int = NEVER) -> bool:
        """Whether some merge over the border of neighbours a and b comes earlier than the
        ones that complete them (and than rank `before`). Of equal merges the left is first."""
        left, right = self._spine(a, True), self._spine(b, False)
        i = j = 0
        while True:
            (x, x_taken), (y, y_taken) = left[i], right[j]
            rank = self.merges.get((x, y))
            if rank is not None and rank < x_taken and rank <= y_taken and rank < before:
                return True
            if x_taken == y_taken == NEVER:
                return False
            if x_taken <= y_taken:
                i += 1
            else:
                j += 1

    def _whole(self, token: int) -> bool:
        """Whether the letters of a token, by themselves, are merged into it."""
        todo = [token]
        while todo:
            at = todo.pop()
            if at in self.made:
                left, right, rank = self.made[at]
                if self.crosses(left, right, rank):
                    return False
                todo += [left, right]
        return True

    def encode(self, word: str) -> list[int]:
        """Ids of one word: a run of byte letters without white space."""
        letters = word[:-1] + chr(ord(word[-1]) + LAST) if self.mark else word
        last = [0] * (len(letters) + 1)
        length = [0] * (len(letters) + 1)
        length[0] = 1
        fits = self.fits
        for end, (token, n) in self.automaton.iter(letters):
            start = end + 1 - n
            if length[end + 1] or not length[start]:
                continue
            if start:
                pair = last[start] << 20 | token
                fit = fits.get(pair)
                if fit is None:
                    if len(fits) > 2_000_000:
                        fits.clear()
                    fit = fits[pair] = not self.crosses(last[start], token)
                if not fit:
                    continue
            last[end + 1], length[end + 1] = token, n
        ids, at = [], len(letters)
        while at:
            ids.append(last[at])
            at -= length[at]
        ids.reverse()
        return ids


@cache
def _latin() -> re.Pattern:
    """How the tokenizer file cuts Latin texts into words (fixed value); to normalise those
    is to lower-case them."""
    letters, numbers = char_ranges("L", LATIN), char_ranges("N", LATIN)
    return re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{BLANKS}{letters}{numbers}]+"
    )


class Coder:
    """Encodes and decodes whole texts; words that occur again are worked out once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.vocabulary = Vocabulary(path)
        tokenizer = Tokenizer.from_file(path)
        self.normal, self.cut = tokenizer.normalizer, tokenizer.pre_tokenizer
        self.byte_of = {letter: byte for byte, letter in self.vocabulary.of_byte.items()}
        self.ids_of = WordCache(self._ids)
        self.text_of = WordCache(lambda word: self.decode(np.frombuffer(self.ids_of[word], "<u4").tolist()))
        self.special = self.vocabulary.special
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def _ids(self, word: str) -> bytes:
        if word in self.special:
            return np.array([self.special[word]], "<u4").tobytes()
        vocabulary = self.vocabulary
        ids = vocabulary.encode(word.encode("utf-8").decode("latin-1").translate(vocabulary.translate))
        return np.array(ids, "<u4").tobytes()

    def decode(self, ids: list[int]) -> str:
        """The tokens of the ids, as the file has no decoder: with a blank between."""
        strings = self.vocabulary.strings
        return " ".join([strings[i] for i in ids])

    def _cut(self, text: str) -> list[str]:
        """The words of a text without special tokens. Other than Latin texts are cut by the
        tokenizer file itself, since which characters are letters differs by the Unicode
        version; it gives the letters that stand for a word's bytes."""
        if LATIN_TEXT.fullmatch(text) and LATIN_TEXT.fullmatch(lowered := text.lower()):
            return _latin().findall(lowered)
        found = self.cut.pre_tokenize_str(self.normal.normalize_str(text))
        return [bytes(map(self.byte_of.__getitem__, word)).decode() for word, _ in found]

    def code(self, text: str | None) -> tuple[bytes, str]:
        """Ids of a text as little-endian unsigned 32-bit numbers, and their decoding."""
        if not text:
            return b"", ""
        if not any(mark in text for mark in self.special):
            words = self._cut(text)
        else:
            words = []
            for part in self.marks.split(text):
                words += [part] if part in self.special else self._cut(part)
        return b"".join(map(self.ids_of.__getitem__, words)), " ".join(map(self.text_of.__getitem__, words))


@cache
def _coder(path: str) -> Coder:
    return Coder(path)


def encode(docs: DataFrame, tokenizer: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all, if not given), ids (little-endian unsigned 32-bit numbers)
    and decoded, the text that decoding the ids gives.

    `tokenizer` is the path of the tokenizer file on every executor. Null and empty texts
    have no ids and decode to nothing. Whole texts are encoded, in time that grows with
    their length. A column of `docs` named ids or decoded is replaced; an empty table
    stays empty.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("ids", "decoded")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [coder.code(x.as_py()) for x in part.column(len(kept))]
                new = [pa.array([x for x, _ in found], pa.binary()), pa.array([s for _, s in found], pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *new], [*kept, "ids", "decoded"])

    rows = docs.select(*kept, F.col(text).cast("string").alias("__text"))
    return rows.mapInArrow(work, docs.select(*kept).schema.add("ids", "binary").add("decoded", "string"))
