"""Toxicity of whole texts: a learned lexicon, matched with spelling errors, in context.

The lexicon is learned from labelled documents: words, and productive word beginnings,
that occur in toxic documents and hardly in others. Words of a text are matched by
Levenshtein automata intersected with the lexicon's trie: both are walked at once, and
the sets of (trie node, errors so far) that a word can reach are kept as states of one
automaton that is built as far as words need it. A window of words around each hit tells
a quotation or a report from abuse and weighs the hit; a logistic model of the weighted
hits gives the score.

Words of every length are matched. Only words of at most LONGEST letters without a digit
are learned, so scripts that do not separate words teach next to nothing.
"""

from __future__ import annotations

import functools
import itertools
import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.store import saved

#: Labelled rows learned from, about: a model needs no more.
TRAIN_ROWS = 40_000
#: A term's documents must be toxic at this share (both classes taken as equally large),
#: by more than chance (twice the log likelihood ratio), and it must stand behind so many
#: different words. Terms beyond doubt come first; weaker evidence counts only in
#: documents that hold none of those.
LEAST_SHARE, EVIDENCE, LEAST_PLACES = 0.9, (100.0, 20.0), 4
#: Documents that have this share of their five-word shingles in common are near copies, and
#: one of them is evidence enough. Pairs to compare agree in a band of BAND least hashes.
COPY, SHINGLE, BANDS, BAND = 0.8, 5, 16, 4
MIXERS = np.random.default_rng(11).integers(1 << 62, size=BANDS * BAND, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: A word beginning is productive from so many different words on.
LEAST_FORMS = 4
STEM, LONGEST = 4, 24
#: Words on either side of a hit that make its context.
WINDOW = 5
#: Words whose hits a task remembers.
KNOWN_WORDS = 100_000

#: Words that report what others said, and quotation marks.
REPORTING = frozenset(
    "said says say quote quoted quotes wrote writes called calls word words term terms slur insult"
    " sagte schrieb wort begriff zitat dit écrit mot terme citation dijo escribió palabra término cita".split()
)
ADDRESS = frozenset("you your yours u ur du dein deine dich ihr euch tu toi vous votre tú tus eres usted".split())
QUOTES = {'"': '"', "“": "”", "„": "“", "«": "»", "‹": "›", "‘": "’"}

_WORD = regex.compile(r"[^\W_]+")
_DIGIT = regex.compile(r"\d")


def _errors(term: str, stem: bool) -> int:
    """Spelling errors that a term forgives: short ones none, as they are near too much."""
    n = len(term) - 2 * stem
    return 0 if n < 5 else 1 if n < 9 else 2


class Matcher:
    """Levenshtein automata of all terms, as one automaton over the trie of the lexicon.

    A state is a set of (node, errors): the places in the trie that the letters read so
    far can have led to. Only states that some word reaches are made; when there are too
    many they are dropped and made anew.
    """

    MOST_STATES = 100_000

    def __init__(self, words: Iterable[str], stems: Iterable[str]):
        self.children: list[dict[str, int]] = [{}]
        self.word_end: list[int] = [-1]
        self.stem_end: list[int] = [-1]
        self.allowed: list[int] = [0]
        for term, stem in [*((w, False) for w in words), *((s, True) for s in stems)]:
            errors, node = _errors(term, stem), 0
            for letter in term:
                self.allowed[node] = max(self.allowed[node], errors)
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.word_end.append(-1)
                    self.stem_end.append(-1)
                    self.allowed.append(0)
                node = self.children[node][letter]
            self.allowed[node] = max(self.allowed[node], errors)
            ends = self.stem_end if stem else self.word_end
            ends[node] = errors
        self._start_over()

    def _start_over(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.at_end: list[int] = []
        self.on_way: list[int] = []
        self._state({(0, 0)})

    def _state(self, places: set) -> int:
        """The number of a state, closed under letters that are missing in the word."""
        todo, least = list(places), {}
        while todo:
            node, errors = todo.pop()
            if errors > self.allowed[node] or errors >= least.get(node, 99):
                continue
            least[node] = errors
            if errors < self.allowed[node]:
                todo += [(child, errors + 1) for child in self.children[node].values()]
        key = frozenset(least.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            none = 99
            self.at_end.append(min((e for n, e in key if e <= self.word_end[n]), default=none))
            self.on_way.append(min((e for n, e in key if e <= self.stem_end[n]), default=none))
        return self.states[key]

    def _step(self, state: int, letter: str) -> int:
        places = set()
        for node, errors in self.sets[state]:
            for other, child in self.children[node].items():
                places.add((child, errors + (other != letter)))
            places.add((node, errors + 1))
        return self._state({(n, e) for n, e in places if e <= self.allowed[n]})

    def errors(self, word: str) -> int | None:
        """Fewest spelling errors between the word and a term it may stand for, or None."""
        if len(self.sets) > self.MOST_STATES:
            self._start_over()
        state, best = 0, 99
        for letter in word:
            step = self.steps[state]
            if letter in step:
                state = step[letter]
            else:
                before, state = state, self._step(state, letter)
                self.steps[before][letter] = state
            if not self.sets[state]:
                break
            best = min(best, self.on_way[state])
        else:
            best = min(best, self.at_end[state])
        return None if best == 99 else best


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _quoted(text: str) -> list[tuple[int, int]]:
    """Spans between quotation marks of one line."""
    spans, start = [], 0
    for line in text.split("\n"):
        open_at, closing = None, ""
        for i, c in enumerate(line):
            if open_at is not None and c == closing:
                spans.append((start + open_at, start + i))
                open_at = None
            elif open_at is None and c in QUOTES:
                open_at, closing = i, QUOTES[c]
        start += len(line) + 1
    return spans


FEATURES = ("exact", "misspelled", "quoted", "density", "kinds")


@dataclass
class Model:
    words: list[str]
    stems: list[str]
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES) + 1))
    _matcher: Matcher | None = None
    _known: dict = field(default_factory=dict)

    def __getstate__(self):
        return {"words": self.words, "stems": self.stems, "weights": self.weights, "_matcher": None, "_known": {}}

    def __setstate__(self, state):
        self.__dict__.update(state)

    def errors(self, word: str) -> int | None:
        """Words of every length are matched; long ones are not remembered. None has a term
        of fewer than three letters."""
        known = self._known
        if word not in known:
            if self._matcher is None:
                self._matcher = Matcher(self.words, self.stems)
            found = self._matcher.errors(word) if len(word) >= 3 else None
            if len(word) > 2 * LONGEST:
                return found
            if len(known) >= KNOWN_WORDS:
                known.clear()
            known[word] = found
        return known[word]

    def hits(self, text: str) -> Iterator[tuple[str, int, int, int, float]]:
        """(word, start, end, spelling errors, weight): the weight is 1 for abuse, less in
        a quotation or a report, more where someone is addressed."""
        lowered = text.lower()
        found = [(m.group(), m.start(), m.end()) for m in _WORD.finditer(lowered)]
        quoted = _quoted(lowered)
        for i, (word, start, end) in enumerate(found):
            errors = self.errors(word)
            if errors is None:
                continue
            near = {w for w, _, _ in found[max(0, i - WINDOW) : i + WINDOW + 1]}
            weight = 1.0
            if any(a < start and end <= b for a, b in quoted):
                weight *= 0.3
            if near & REPORTING:
                weight *= 0.5
            if near & ADDRESS and weight == 1.0:
                weight = 1.2
            yield word, start, end, errors, weight

    def features(self, text: str | None) -> np.ndarray:
        row = np.zeros(len(FEATURES))
        if not text:
            return row
        words = words_of(text)
        errors = self.errors
        hit = [w for w in words if errors(w) is not None]
        if not hit:
            return row
        exact = misspelled = quoted = 0.0
        for _, _, _, off, weight in self.hits(text):
            if weight < 1:
                quoted += 1
            exact += weight * (off == 0)
            misspelled += weight * (off > 0)
        row[:] = np.log1p(exact), np.log1p(misspelled), np.log1p(quoted), 10 * (exact + misspelled) / len(words), np.log1p(len(set(hit)))
        return row

    def score(self, text: str | None) -> float:
        return float(_chance(self.weights, self.features(text)[None, :])[0])


def _chance(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(weights[0] + rows @ weights[1:], -30, 30)))


def _logistic(rows: np.ndarray, labels: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Ridge logistic regression by Newton steps, classes weighted alike."""
    x = np.hstack([np.ones((len(rows), 1)), rows])
    share = max(1e-9, labels.mean()), max(1e-9, 1 - labels.mean())
    importance = np.where(labels > 0, 0.5 / share[0], 0.5 / share[1])
    weights = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(40):
        p = _chance(weights, rows)
        slope = x.T @ (importance * (labels - p)) / len(x) * 100 - penalty @ weights
        curve = (x * (importance * p * (1 - p))[:, None]).T @ x / len(x) * 100 + penalty
        step = np.linalg.solve(curve, slope)
        weights += step
        if abs(step).max() < 1e-8:
            break
    return weights


def labelled_sample(
    docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, rows: int = TRAIN_ROWS
) -> DataFrame:
    """(id, text, toxic) of about `rows` labelled documents. Ids are chosen by a hash, and if
    their texts are more than `rows`, as where one id stands on many, so are those. Texts that
    are equal within a label count once, with their least id. An id with several labels is
    toxic if one says so. Only the chosen ids are broadcast."""
    known = labels.where(f"{label} in (0, 1) and {doc_id} is not null").groupBy(F.col(doc_id).alias("id")).agg(
        F.max(label).cast("int").alias("toxic")
    )
    chosen = _share(known, rows, "id")
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where("text is not null")
    found = texts.join(F.broadcast(chosen), "id").groupBy("toxic", "text").agg(F.min("id").alias("id"))
    return _share(saved(found.select("id", "text", "toxic"), "labelled-texts"), rows, "id", "text")


def _share(table: DataFrame, rows: int, *key: str) -> DataFrame:
    """About `rows` rows, chosen by a hash of the key; all, if there are fewer."""
    keep = min(1.0, rows / max(1, table.count()))
    return table.where(F.pmod(F.xxhash64(*key), F.lit(1_000_003)) < math.ceil(keep * 1_000_003))


def _copy_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, toxic, shingles, bands): the hashes of each document's different five-word
    shingles (of all words, if there are fewer), and its bands of least hashes."""
    digest = xxhash.xxh64_intdigest
    for batch in batches:
        sets, bands = [], []
        for text in batch.column(2):
            words = words_of(text.as_py())
            shingles = (" ".join(words[j : j + SHINGLE]) for j in range(max(1, len(words) - SHINGLE + 1)))
            hashes = np.unique(np.fromiter((digest(t.encode("utf-8", "replace")) for t in shingles), np.uint64))
            least = np.array([(hashes * mixer).min() for mixer in MIXERS]).reshape(BANDS, BAND)
            sets.append(hashes.view(np.int64))
            bands.append([digest(row.tobytes(), k) >> 1 for k, row in enumerate(least)])
        kind = pa.list_(pa.int64())
        columns = [batch.column(0), batch.column(1), pa.array(sets, kind), pa.array(bands, kind)]
        yield pa.RecordBatch.from_arrays(columns, ["key", "toxic", "shingles", "bands"])


def without_copies(sample: DataFrame) -> DataFrame:
    """The sample with one of its near copies, so that a document copied many times is no
    more evidence than others.

    A row goes only if it shares COPY of its shingles with a row of the same label that
    stays. In each round, the rows of a band are compared with one of them, by another
    order each time; rounds end when one finds no copy. A round starts from the rows that
    shared a band with another in the last one and stayed, written once, so its work grows
    with those and not with the rounds before. Keys and pairs of keys of a bounded sample
    are broadcast.
    """
    rows = sample.groupBy("toxic", "text").agg(F.min("id").alias("id"))
    rows = saved(rows.select(F.xxhash64("id", "text").alias("key"), "id", "text", "toxic"), "copy-rows")
    keyed = rows.select("key", "toxic", "text").mapInArrow(
        _copy_keys, "key long, toxic int, shingles array<long>, bands array<long>"
    )
    keyed = saved(keyed, "copy-keys")
    sets = keyed.select("key", "shingles")
    left, copies = keyed.select("key", "toxic", "bands"), []
    # Every round but the last takes rows away, so there is a last one.
    for order in itertools.count():
        banded = left.select("key", "toxic", F.explode("bands").alias("band"))
        first = F.min(F.struct(F.xxhash64("key", F.lit(order)), "key"))["key"].alias("leader")
        leaders = banded.groupBy("toxic", "band").agg(first, F.count("*").alias("n")).where("n > 1").drop("n")
        pairs = banded.join(F.broadcast(leaders), ["toxic", "band"]).where("key <> leader").select("key", "leader")
        pairs = saved(pairs.distinct(), "copy-pairs")
        # Only the shingles of rows in a pair are shuffled.
        of_leader = sets.toDF("leader", "of_leader").join(F.broadcast(pairs.select("leader").distinct()), "leader", "left_semi")
        common = F.size(F.array_intersect("shingles", "of_leader"))
        alike = common / (F.size("shingles") + F.size("of_leader") - common) >= COPY
        both = sets.join(F.broadcast(pairs), "key").join(of_leader, "leader")
        found = saved(both.where(alike).select("key", "leader"), "copies")
        # A leader that goes itself takes no row along.
        going = found.select(F.col("key").alias("leader")).distinct()
        gone = saved(found.join(F.broadcast(going), "leader", "left_anti").select("key").distinct(), "copies")
        if gone.isEmpty():
            break
        copies.append(gone)
        # A row that shares no band will share none later, as rows only go.
        met = pairs.select(F.explode(F.array("key", "leader")).alias("key")).distinct()
        staying = met.join(F.broadcast(gone), "key", "left_anti")
        left = saved(left.join(F.broadcast(staying), "key", "left_semi"), "copy-left")
    if copies:
        rows = rows.join(F.broadcast(functools.reduce(DataFrame.union, copies)), "key", "left_anti")
    return rows.select("id", "text", "toxic")


def _terms(sample: DataFrame, model: Model, toxic_rows: int, clean_rows: int, evidence: float) -> tuple[list, list]:
    """New words and beginnings, told by the documents in which `model` finds nothing."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _term_rows(batches, shared.value)

    terms = saved(
        sample.mapInArrow(work, "term string, toxic long, clean long, before long")
        .groupBy("term")
        .agg(
            F.sum("toxic").alias("toxic"),
            F.sum("clean").alias("clean"),
            F.bit_count(F.bit_or("before")).cast("long").alias("places"),
        )
        .where("toxic > 0 or length(term) > 4"),
        "terms",
    )
    telling = _telling(toxic_rows, clean_rows, evidence) & (F.col("places") >= LEAST_PLACES)
    words = [r["term"] for r in terms.where(telling).select("term").collect()]
    # Beginnings are judged by all their words, rare and clean ones too.
    beginning = F.substring("term", 1, STEM)
    starts = terms.where(F.length("term") > STEM).groupBy(beginning.alias("start")).agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.sum("places").alias("places")
    )
    pure = [r["start"] for r in starts.where(telling & (F.col("clean") <= 0.01 * F.col("toxic"))).collect()]
    forms = terms.where(beginning.isin(pure) & (F.col("toxic") > 0)).select("term", "toxic").collect()
    return words, _stems(dict(forms))


def _term_rows(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """(term, toxic, clean, before): in how many documents of the partition a word occurs,
    and, as bits, which words stand before it in toxic ones."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    before: Counter = Counter()
    for batch in batches:
        for text, toxic in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
            words = words_of(text.as_py())
            unique = set(words)
            if (model.words or model.stems) and any(model.errors(w) == 0 for w in unique):
                continue
            counts[toxic].update(w for w in unique if 3 <= len(w) <= LONGEST and not _DIGIT.search(w))
            if toxic:
                for last, word in zip(["", *words], words, strict=False):
                    before[word] |= 1 << zlib.crc32(last.encode("utf-8", "replace")) % 63
            if len(counts[0]) + len(before) > 100_000:
                yield _term_batch(counts, before)
                for seen in (*counts, before):
                    seen.clear()
    yield _term_batch(counts, before)


def _term_batch(counts: tuple[Counter, Counter], before: Counter) -> pa.RecordBatch:
    terms = list(counts[0].keys() | counts[1].keys())
    numbers = [pa.array([seen[t] for t in terms], pa.int64()) for seen in (counts[1], counts[0], before)]
    return pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *numbers], ["term", "toxic", "clean", "before"])


def _telling(toxic_rows: int, clean_rows: int, evidence: float) -> Column:
    """Whether counts `toxic` and `clean` are mostly toxic, and not by chance."""
    toxic, clean = F.col("toxic"), F.col("clean")
    n, share = toxic + clean, toxic_rows / (toxic_rows + clean_rows)
    gain = toxic * F.log(toxic / (n * share)) + F.when(clean > 0, clean * F.log(clean / (n * (1 - share)))).otherwise(0)
    rate = toxic / toxic_rows / (toxic / toxic_rows + clean / clean_rows)
    return (toxic > 0) & (rate >= LEAST_SHARE) & (2 * gain >= evidence)


def _stems(forms: dict[str, int]) -> list[str]:
    """Productive beginnings of toxic words: each as long as all its forms share it."""
    families: dict[str, list[str]] = defaultdict(list)
    for word in forms:
        families[word[:STEM]].append(word)
    found = []
    for words in families.values():
        total = sum(forms[w] for w in words)
        if len(words) < LEAST_FORMS or max(forms[w] for w in words) > total / 2:
            continue
        stem = words[0]
        while not all(w.startswith(stem) for w in words):
            stem = stem[:-1]
        if len(stem) >= STEM:
            found.append(stem)
    return found


def fit(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", rows: int = TRAIN_ROWS
) -> Model:
    """Learns lexicon and weights from about `rows` labelled documents of `docs`.

    Terms and their counts are found by Spark; the driver gets those that pass the
    limits, and one row of numbers for each training row. Without toxic and clean
    examples the model finds nothing and scores every text alike, below a half.
    """
    sample = labelled_sample(docs, labels, doc_id, text, label, rows)
    sample = saved(without_copies(sample), "labelled")
    totals = sample.groupBy("toxic").count().toPandas().set_index("toxic")["count"].to_dict()
    toxic_rows, clean_rows = totals.get(1, 0), totals.get(0, 0)
    model = Model([], [], np.array([-2.0, *np.zeros(len(FEATURES))]))
    if not toxic_rows or not clean_rows:
        return model
    for evidence in EVIDENCE:
        words, stems = _terms(sample, model, toxic_rows, clean_rows, evidence)
        stems = sorted({*model.stems, *stems})
        words = sorted(w for w in {*model.words, *words} if not any(w.startswith(s) for s in stems))
        model = Model(words, stems, model.weights)
    seen = _feature_rows(sample, model).toPandas()
    model.weights = _logistic(seen[list(FEATURES)].to_numpy(), seen["toxic"].to_numpy())
    return model


def _feature_rows(sample: DataFrame, model: Model) -> DataFrame:
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([shared.value.features(x.as_py()) for x in batch.column(1)]).reshape(-1, len(FEATURES))
            columns = [pa.array(rows[:, i]) for i in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays([batch.column(2).cast(pa.int32()), *columns], ["toxic", *FEATURES])

    return sample.mapInArrow(work, "toxic int, " + ", ".join(f"{f} double" for f in FEATURES))


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all, if not given), score and predicted (1 from a half on).

    Null and empty texts have no hits and score alike. The same text always scores the
    same. A column of `docs` named score or predicted is replaced. Whole texts count; an
    empty table stays empty.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.fromiter((shared.value.score(x.as_py()) for x in batch.column(len(kept))), float, batch.num_rows)
            new = [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *new], [*kept, "score", "predicted"])

    rows = docs.select(*kept, F.col(text).cast("string").alias("__text"))
    return rows.mapInArrow(work, docs.select(*kept).schema.add("score", "double").add("predicted", "integer"))


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` without the rows that score a half or more; the others stay as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([shared.value.score(x.as_py()) < 0.5 for x in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(work, docs.schema)
