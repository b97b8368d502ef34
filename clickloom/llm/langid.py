"""Language identification by error-correcting output codes.

Every language gets a codeword of +1 and -1. For each position of the codewords a linear
classifier over hashed byte n-grams predicts the bit: its weights are log ratios of how
often the n-gram occurs in the languages on either side. Decoding adds up, for every
language, the loss of its codeword against the predicted margins. Each bit's loss is
weighted by how often that bit came out right for that language in training. The
language with the smallest loss wins; a runner-up that is almost as near makes the text
ambiguous. How near is measured on the mean margins of an n-gram, which do not grow with
the text, and held against the rows that the language was learned from: a text half in
another language, or in one that was not learned, has a far smaller lead than those.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
#: n-grams are hashed into so many buckets: bounds the model, whatever the corpus.
BUCKETS = 1 << 16
#: Rows on which the reliability of the bits is measured, about.
RELIABILITY_ROWS = 20_000
#: A share of the two best languages' probability; a runner-up nearer than this is ambiguous.
AMBIGUITY = 0.02
#: So is a text whose lead an n-gram is below this share of the median of its language's
#: labelled rows (a quarter of the text speaks for the runner-up), unless more than LOW of
#: those rows have so small a lead.
LEAST_LEAD, LOW = 0.5, 0.005
#: Different n-grams that a text must have for its lead to say anything: about three words.
LEAST_GRAMS = 32
#: Bytes looked at in one step, so that a very long text needs no more memory.
STEP = 1 << 18

_LETTER = regex.compile(r"\p{L}")
#: ASCII letters and all bytes of other characters stay, the rest is a blank.
_KEPT = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def grams(text: str) -> Iterator[np.ndarray]:
    """Buckets of the byte pairs and triples of a lower-cased text, a step at a time."""
    data = f" {text.lower()} ".encode("utf-8", "replace").translate(_KEPT)
    whole = np.frombuffer(data, np.uint8)
    for at in range(0, max(1, len(whole) - 2), STEP):
        b = whole[at : at + STEP + 2].astype(np.uint32)
        pairs = b[:-1] << 8 | b[1:]
        triples = pairs[:-1] << 8 | b[2:]
        pairs = pairs[: len(triples) or None]
        yield np.concatenate([pairs * np.uint32(40503), triples * np.uint32(2654435761) >> 16]) & (BUCKETS - 1)


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def codewords(languages: int) -> np.ndarray:
    """A codeword a row. Up to five languages get every split there is, more get a
    random code: of many draws the one whose rows lie farthest apart."""
    if languages < 2:
        return np.ones((languages, 0), np.int8)
    if languages <= 5:
        splits = np.arange(1, 1 << (languages - 1))
        return np.where(splits[None, :] >> np.arange(languages)[:, None] & 1, 1, -1).astype(np.int8)
    bits = int(np.ceil(12 * np.log2(languages)))
    draw = np.random.default_rng(7)
    best, distance = None, -1
    for _ in range(64):
        code = draw.choice(np.array([-1, 1], np.int8), (languages, bits))
        apart = (bits - code.astype(int) @ code.T.astype(int)) // 2 + bits * np.eye(languages, dtype=int)
        if apart.min() > distance and (abs(code.astype(int).sum(0)) < languages).all():
            best, distance = code, apart.min()
    return best


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    reliability: np.ndarray
    #: For each language, the least lead that is not ambiguous and the usual one.
    leads: np.ndarray | None = None

    def _sums(self, text: str) -> tuple[np.ndarray, int]:
        """Sum of the log ratios, for each bit, and the number of n-grams."""
        total, n = np.zeros(self.codes.shape[1]), 0
        for buckets in grams(text):
            total += np.take(self.weights, buckets, axis=0).sum(axis=0, dtype=np.float64)
            n += len(buckets)
        return total, n

    def margins(self, text: str) -> np.ndarray:
        """Mean log ratio an n-gram, for each bit, grown with the evidence there is."""
        total, n = self._sums(text)
        return total / max(1.0, np.sqrt(n))

    def _losses(self, margins: np.ndarray) -> np.ndarray:
        return (self.reliability * np.logaddexp(0, -self.codes * margins)).sum(axis=1)

    def decode(self, text: str) -> tuple[int, np.ndarray, float]:
        """The nearest language, the probabilities of all, and the lead over the runner-up:
        the difference of their losses by the mean margins of an n-gram."""
        total, n = self._sums(text)
        loss = self._losses(total / max(1.0, np.sqrt(n)))
        chance = np.exp(loss.min() - loss)
        chance /= chance.sum()
        best = int(chance.argmax())
        loss = self._losses(total / max(1, n))
        return best, chance, float(np.delete(loss, best).min() - loss[best])

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, probability and whether another language is almost as near. An ambiguous
        text's probability is at most the share of it that speaks for the language."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        best, chance, lead = self.decode(text)
        score, second = float(chance[best]), np.delete(chance, best).max()
        if self.leads is not None and lead < self.leads[best, 0] and _many_grams(text):
            share = (1 + max(0.0, lead) / max(1e-9, self.leads[best, 1])) / 2
            return self.languages[best], min(score, float(share)), True
        return self.languages[best], score, bool((score - second) < AMBIGUITY * (score + second))


def _many_grams(text: str) -> bool:
    """Whether the text has LEAST_GRAMS different n-grams."""
    seen: set[int] = set()
    for buckets in grams(text):
        for at in range(0, len(buckets), 1024):
            seen.update(np.unique(buckets[at : at + 1024]).tolist())
            if len(seen) >= LEAST_GRAMS:
                return True
    return False


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n) of a partition, a batch of texts at a time."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py()
            if not has_letter(text):
                continue
            if lang not in sums:
                sums[lang] = np.zeros(BUCKETS, np.int64)
            for buckets in grams(text):
                if len(buckets) > BUCKETS // 8:
                    sums[lang] += np.bincount(buckets, minlength=BUCKETS)
                else:
                    np.add.at(sums[lang], buckets, 1)
        if len(sums) > 64:
            yield from _given(sums)
            sums = {}
    yield from _given(sums)


def _given(sums: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for lang, n in sums.items():
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(seen), pa.string()), pa.array(seen), pa.array(n[seen])], ["lang", "bucket", "n"]
        )


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Learns from all rows with a language and a letter in the text.

    Counts of n-grams cover every row; they are added up before they are shuffled and
    come to BUCKETS numbers a language. How reliable the bits are is measured on a sample
    of about RELIABILITY_ROWS rows, the usual leads on every row. No usable row gives a
    model that knows no language.
    """
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    rows = rows.where("lang is not null and text is not null")
    counts = (
        rows.mapInArrow(_counts, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    ).toPandas()
    languages = sorted(counts["lang"].unique())
    codes = codewords(len(languages))
    table = np.zeros((len(languages), BUCKETS))
    table[np.searchsorted(languages, counts["lang"]), counts["bucket"]] = counts["n"]
    share = (table + 0.1) / (table.sum(axis=1, keepdims=True) + 0.1 * BUCKETS)
    weights = np.zeros((BUCKETS, codes.shape[1]), np.float32)
    for bit in range(codes.shape[1]):
        up, down = share[codes[:, bit] > 0], share[codes[:, bit] < 0]
        weights[:, bit] = np.log(up.mean(axis=0)) - np.log(down.mean(axis=0))
    model = Model(languages, codes, weights, np.ones(codes.shape))
    if codes.shape[1]:
        model.reliability = _reliability(rows, model)
        model.leads = _leads(rows, model)
    return model


def _reliability(rows: DataFrame, model: Model) -> np.ndarray:
    """For each language, how often each bit came out right, scaled to a sum of one bit each."""
    total = rows.count()
    keep = min(1.0, RELIABILITY_ROWS / max(1, total))
    sample = rows.where(F.pmod(F.xxhash64("text"), F.lit(1_000_003)) < int(keep * 1_000_003))
    shared = rows.sparkSession.sparkContext.broadcast(model)
    width = model.codes.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        right = np.zeros((len(model.languages), width + 1), np.int64)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                if has_letter(text) and lang in model.languages:
                    at = model.languages.index(lang)
                    right[at, :width] += model.codes[at] * model.margins(text) > 0
                    right[at, width] += 1
        at, bit = np.indices(right.shape)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.ravel()), pa.array(bit.ravel()), pa.array(right.ravel())], ["at", "bit", "n"]
        )

    found = sample.mapInArrow(work, "at long, bit long, n long").groupBy("at", "bit").agg(F.sum("n").alias("n")).toPandas()
    right = np.zeros((len(model.languages), width + 1))
    right[found["at"], found["bit"]] = found["n"]
    accuracy = (right[:, :width] + 1) / (right[:, width:] + 2)
    return accuracy / accuracy.sum(axis=1, keepdims=True) * width


def _leads(rows: DataFrame, model: Model) -> np.ndarray:
    """For each language, the least lead that is not ambiguous and the median, over all its
    rows that are told right and have enough different n-grams."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = {lang: i for i, lang in enumerate(shared.value.languages)}
        for batch in batches:
            found = []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                if lang in at and has_letter(text) and _many_grams(text):
                    best, _, lead = shared.value.decode(text)
                    if best == at[lang]:
                        found.append((best, lead))
            best, lead = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(best, pa.int64()), pa.array(lead, pa.float64())], ["at", "lead"])

    usual = rows.mapInArrow(work, "at long, lead double").groupBy("at").agg(
        F.percentile_approx("lead", [LOW, 0.5], 10_000).alias("lead")
    )
    leads = np.zeros((len(model.languages), 2))
    for row in usual.collect():
        low, median = row["lead"]
        leads[row["at"]] = min(low, LEAST_LEAD * median), median
    return leads


def identify(
    docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The columns `keep` (all, if not given) and lang_pred, score, ambiguous.

    Texts that are null or have no letter are `und` with score 0. Whole texts count, in
    steps of bounded size. The same text always gets the same answer; equally near
    languages go to the first by name and are ambiguous, and so are texts of which much is
    in another language, or all in one that was not learned. Columns of `docs` that are named
    like a new column are replaced. An empty table stays empty.
    """
    new = ["lang_pred", "score", "ambiguous"]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in new]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(x.as_py()) for x in batch.column(len(kept))]
            lang, score, ambiguous = zip(*found, strict=True) if found else ((), (), ())
            columns = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(ambiguous, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *columns], [*kept, *new])

    rows = docs.select(*kept, F.col(text).cast("string").alias("__text"))
    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")
    return rows.mapInArrow(work, schema)


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` without the rows whose language cannot be told: no letters, or two
    languages almost equally near. Columns, order and repeats of the others stay as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(x.as_py()) for x in batch.column(at)]
            yield batch.filter(pa.array([lang != UNKNOWN and not ambiguous for lang, _, ambiguous in found], pa.bool_()))

    return docs.mapInArrow(work, docs.schema)


def held_out(doc_id: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves `part` on division by `parts`; null ids do not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == part, F.lit(False))
