"""Toxicity of texts that may hide their words: noisy-channel deobfuscation, then a linear score of the restored text.

Deobfuscation. What a writer meant is taken as the hidden text, and what stands there as its output through a channel that
swaps letters for look-alike digits and signs, puts separators between letters, and repeats letters. Suspicious stretches (a
word with look-alikes, single letters in a row, a letter three times or more) become lattices of the characters that may be
meant, and the Viterbi algorithm finds the reading with the least cost of channel and character language model (trigrams,
backed off). Other words have one reading and stay.

Score. The restored text is what is scored. Its features are its distinct words. A word weighs its log ratio of frequency in
toxic and other documents, less two and a half standard errors, and counts if it weighs for toxicity. A text's evidence is
twofold: its heaviest word, which does not depend on its length, and the weight of all its words over the square root of their
number, since the weights that chance gives to many words add up like that. Both pass through a logistic curve fitted to the labels.

Defined results. Null and empty texts score like a text without features. Without usable labels of both kinds all scores are 0.
Labels other than 0 and 1 and null ids are passed over; an id with several labels is toxic if one says so. Rows of the
held-out fold are not learnt from. Repeated rows are scored one by one; a text that several labelled rows share is learnt from once for each label. Null doc_id: scored, held_out false. Other columns are not read.

At scale: the language model counts all texts over an alphabet of 128 symbols (space, the small Latin letters up to U+017F, and
one symbol for all other letters, which no sign stands for), so that its entries grow with the corpus but have 128 ** 3 as
their bound whatever the scripts; counts are summed before the shuffle. Weights are fitted on a sample of SAMPLE_ROWS rows of
each label at most, in expectation, chosen by a hash; all words of the sample can be features. Scoring is one pass without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, remainder, written

# Letters that a sign can stand for.
LOOKALIKES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i"}
SEPARATORS = " .-_*~"
#: Expected rows of each label that weights are fitted on, and labels that are broadcast at most.
SAMPLE_ROWS, BROADCAST_LABELS = 20_000, 1_000_000
#: Costs of the channel, and standard errors that are taken off a weight.
SWAP, KEEP_SIGN, DROP_SEPARATOR, KEEP_SEPARATOR, DROP_REPEAT, ERRORS = 1.0, 8.0, 0.5, 4.0, 0.5, 2.5
_EDGE = ".,;:?\"'()[]{}<>*%&#~`…«»“”‘’-_/\\="
_SPACED = re.compile(r"(?<!\S)(?:[^\W_][ .\-_*~]){3,}[^\W_](?!\w)")
_RUN = re.compile(r"([^\W\d_])\1\1")
_LETTERS = [c for c in map(chr, range(0x180)) if c.isalpha() and c == c.lower() != c.upper()]
_OTHER, _BITS = 127, 7
#: Characters that are counted at a time, and entries of the model of each order.
CHUNK, SIZES = 1 << 20, [1 << _BITS * n for n in (1, 2, 3)]
_SYMBOL: np.ndarray | None = None


def symbols(text: str) -> np.ndarray:
    """The symbol of every character: 0 for what is no letter."""
    global _SYMBOL
    if _SYMBOL is None:
        table = np.fromiter((_OTHER * chr(c).isalpha() for c in range(0x110000)), np.int32, 0x110000)
        table[[ord(c) for c in _LETTERS]] = np.arange(1, len(_LETTERS) + 1)
        _SYMBOL = table
    return _SYMBOL[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]


class Counts:
    """Counts of 1 to 3 symbols in a row over texts; runs of other characters are one space, and none of three has it in the middle."""

    def __init__(self):
        self.of = [np.zeros(n, np.int64) for n in SIZES]

    def add(self, text: str) -> None:
        tail = np.zeros(2, np.int32)
        for start in range(0, len(text), CHUNK):
            end = start + CHUNK
            tail = self._add(tail, symbols(text[start:end].lower() + " " * (end >= len(text))))

    def _add(self, tail: np.ndarray, new: np.ndarray) -> np.ndarray:
        kept = new != 0
        kept[1:] |= new[:-1] != 0
        kept[0] |= tail[1] != 0
        a = np.concatenate([tail, new[kept]])
        z, y, x = a[2:], a[1:-1], a[:-2]
        self.of[0] += np.bincount(z[z != 0], minlength=SIZES[0])
        self.of[1] += np.bincount(y << _BITS | z, minlength=SIZES[1])
        own = y != 0
        codes, n = np.unique((x << 2 * _BITS | y << _BITS | z)[own], return_counts=True)
        self.of[2][codes] += n
        return a[-2:]

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """Codes (order and symbols) and counts of what occurs."""
        found = [np.flatnonzero(c) for c in self.of]
        return np.concatenate([f + (k << 32) for k, f in enumerate(found)]), np.concatenate([c[f] for c, f in zip(self.of, found, strict=True)])


@dataclass
class CharModel:
    """Costs (negative natural logs) of a character after two others, from the entries of Counts."""

    codes: np.ndarray
    counts: np.ndarray
    cache: dict[tuple[str, str, str], float] = field(default_factory=dict)

    @cached_property
    def tables(self) -> tuple:
        """Counts of 1, 2 and 3 symbols, and of what begins with 1 and 2."""
        of = [np.zeros(n, np.int64) for n in SIZES]
        for k, c in enumerate(of):
            own = self.codes >> 32 == k
            c[self.codes[own] & (1 << 32) - 1] = self.counts[own]
        side = SIZES[0]
        return (*of, of[1].reshape(side, side).sum(1), of[2].reshape(side * side, side).sum(1))

    @property
    def total(self) -> int:
        return int(self.tables[0].sum())

    def __getstate__(self):
        return {"codes": self.codes, "counts": self.counts, "cache": {}}

    def cost(self, a: str, b: str, c: str) -> float:
        key = (a, b, c)
        known = self.cache.get(key)
        if known is None:
            x, y, z = symbols(a + b + c).tolist()
            ones, twos, threes, after_one, after_two = self.tables
            pair = x << _BITS | y
            one = (int(ones[z]) + 0.5) / (int(ones.sum()) + 1000.0)
            two = (int(twos[y << _BITS | z]) + 5 * one) / (int(after_one[y]) + 5)
            three = (int(threes[pair << _BITS | z]) + 5 * two) / (int(after_two[pair]) + 5)
            known = self.cache[key] = -math.log(three)
            if len(self.cache) > 500_000:
                self.cache.clear()
        return known


def lattice(observed: str) -> list[list[tuple[str, float]]]:
    """For every observed character the readings and their channel costs; the empty reading drops it."""
    out = []
    for i, c in enumerate(observed):
        run = 0  # earlier copies in a row of three letters or more
        if c.isalpha():
            start = i
            while start > 0 and observed[start - 1] == c:
                start -= 1
            end = i
            while end + 1 < len(observed) and observed[end + 1] == c:
                end += 1
            run = i - start if end - start >= 2 else 0
        if run >= 2:
            out.append([("", DROP_REPEAT)])
        elif run == 1:
            out.append([(c, 0.0), ("", DROP_REPEAT)])
        elif c in LOOKALIKES:
            out.append([(x, SWAP) for x in LOOKALIKES[c]] + [(c, KEEP_SIGN)] + [("", DROP_SEPARATOR)] * (c == "!" and i + 1 == len(observed)))
        elif c in SEPARATORS:
            out.append([("", DROP_SEPARATOR), (" ", KEEP_SEPARATOR)])
        else:
            out.append([(c, 0.0)])
    return out


def decode(observed: str, model: CharModel) -> str:
    """The cheapest reading of a stretch of lower-case characters."""
    states: dict[tuple[str, str], tuple[float, tuple]] = {(" ", " "): (0.0, ())}
    for options in lattice(observed):
        following: dict[tuple[str, str], tuple[float, tuple]] = {}
        for (a, b), (cost, path) in states.items():
            for reading, channel in options:
                if reading:
                    step = cost + channel + (model.cost(a, b, reading) if reading.isalpha() or reading == " " else 0.0)
                    state = (b, reading) if reading.isalpha() else (" ", " ")
                    way = (path, reading)
                else:
                    step, state, way = cost + channel, (a, b), path
                if state not in following or step < following[state][0]:
                    following[state] = (step, way)
        states = following
    best = min(((cost + (model.cost(a, b, " ") if b != " " else 0.0), (a, b), path) for (a, b), (cost, path) in states.items()), key=lambda x: x[:2])[2]
    letters = []
    while best:
        best, reading = best
        letters.append(reading)
    return "".join(reversed(letters))


class _Remembered(dict):
    """A function of words that remembers what it has said, up to a bound."""

    def __init__(self, fn, most: int = 200_000):
        super().__init__()
        self.fn, self.most = fn, most

    def __missing__(self, word):
        if len(self) >= self.most:
            self.clear()
        said = self[word] = self.fn(word)
        return said


class Restorer:
    """Restores words and texts."""

    def __init__(self, model: CharModel):
        self.model = model
        self.cores, self.wholes = _Remembered(self._word), _Remembered(self._whole)

    def _word(self, word: str) -> str:
        core = word
        for _ in range(4):
            if len(core) > 3 and core[-1] == core[-2] == core[-3] and not core[-1].isalnum():
                core = core.rstrip(core[-1])
            core = core.strip(_EDGE)
        closed = core.rstrip("!")
        if closed.isalpha():
            core = closed
        letters = sum(c.isalpha() for c in core)
        if letters == len(core):
            return decode(core, self.model) if _RUN.search(core) else core
        mixed = any(c in LOOKALIKES and (i and core[i - 1].isalpha() or i + 1 < len(core) and core[i + 1].isalpha()) for i, c in enumerate(core))
        parted = letters >= 4 and len(re.findall(r"(?<![^\W_])[^\W_](?![^\W_])", core)) >= 4
        known = all(c.isalpha() or c in LOOKALIKES or c in SEPARATORS for c in core)
        if letters >= 2 and known and (mixed or parted) or _RUN.search(core):
            return decode(core, self.model)
        return core

    def _whole(self, word: str) -> str:
        """A word of a text, restored where its core is; the marks around an unchanged core stay."""
        if word.isalpha() and not _RUN.search(word):
            return word
        new = self.cores[word]
        return word if not new or new == word.strip(_EDGE) else new

    def text(self, text: str | None) -> str:
        """The whole text in lower case, suspicious stretches restored, with single spaces between words."""
        low = _SPACED.sub(lambda m: decode(m[0], self.model), (text or "").lower())
        return " ".join(map(self.wholes.__getitem__, low.split()))

    def words(self, restored: str) -> set[str]:
        """The distinct words of a restored text, freed of marks at their edges."""
        out = set()
        for word in set(restored.split()):
            if word.isalpha():
                out.add(word)
            else:
                out.update(self.cores[word].split())
        out.discard("")
        return out


@dataclass
class Scorer:
    """slopes, offset: of the logistic curve over the two kinds of evidence."""

    model: CharModel
    weights: dict[str, float]
    slopes: tuple[float, float] = (0.0, 0.0)
    offset: float = -745.0

    def __post_init__(self):
        self.restorer = Restorer(self.model)

    def evidence(self, text: str | None) -> tuple[float, float]:
        """Of the restored text, the weight of the heaviest word, and of all words over the square root of their number."""
        words = self.restorer.words(self.restorer.text(text))
        held = [self.weights[w] for w in words if w in self.weights]
        return (max(held), math.fsum(held) / math.sqrt(len(words))) if held else (0.0, 0.0)

    def score(self, text: str | None) -> float:
        if not self.weights:
            return 0.0
        most, whole = self.evidence(text)
        x = self.slopes[0] * most + self.slopes[1] * whole + self.offset
        return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def language_model(docs: DataFrame) -> CharModel:
    """Counts over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Counts()
        for batch in batches:
            for text in batch.column(0):
                sums.add(text.as_py())
        codes, n = sums.entries()
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], ["gram", "n"])

    grams = docs.where("text is not null").select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    rows = grams.collect()  # the alphabet bounds them
    return CharModel(np.array([r["gram"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.int64))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """text, y: texts of labelled rows outside the held-out fold, equal texts once for a label."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (remainder(F.col("doc_id")) != 0)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    known = written(known, "labels")
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if len(sizes) < 2:
        return docs.select("text", F.lit(0).alias("y")).where("false")
    share = F.when(F.col("y") == 1, min(1.0, rows / sizes[1])).otherwise(min(1.0, rows / sizes[0]))
    known = written(known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30)).withColumnRenamed("doc_id", "of"), "sample")
    few = known.count() <= BROADCAST_LABELS
    texts = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(known) if few else known, F.col("doc_id") == F.col("of")).select("text", "y")
    return written(texts.dropDuplicates(["text", "y"]), "texts")


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Scorer:
    """A scorer from the texts and the labels outside the held-out fold."""
    model = language_model(docs)
    sample = labelled_sample(docs, labels, rows)
    sizes = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    if len(sizes) < 2:
        return Scorer(model, {})

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        sums: dict[int, Counter] = {0: Counter(), 1: Counter()}

        def out() -> Iterator[pa.RecordBatch]:
            for y, own in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.string()), pa.array([y] * len(own), pa.int32()), pa.array(list(own.values()), pa.int64())], ["word", "y", "n"])
                own.clear()

        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[y].update(restorer.words(restorer.text(text)))
                if len(sums[0]) + len(sums[1]) > 300_000:
                    yield from out()
        yield from out()

    of = lambda y: F.sum(F.when(F.col("y") == y, F.col("n")).otherwise(0))
    words = sample.select("text", "y").mapInArrow(restore, "word string, y int, n long").groupBy("word").agg(of(1).alias("t"), of(0).alias("o"))
    ratio = F.log((F.col("t") + 0.5) / (sizes[1] + 1)) - F.log((F.col("o") + 0.5) / (sizes[0] + 1))
    weight = ratio - ERRORS * F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("o") + 0.5))
    # words of a bounded sample of toxic documents
    scorer = Scorer(model, {r["word"]: r["w"] for r in words.where("t > 0").select("word", weight.alias("w")).where("w > 0.5").collect()})

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = [scorer.evidence(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([s[0] for s in seen], pa.float64()), pa.array([s[1] for s in seen], pa.float64()), batch.column(1)], ["most", "whole", "y"])

    # no more rows than the sample has
    points = sample.select("text", "y").mapInArrow(weigh, "most double, whole double, y int").groupBy(F.round("most", 1).alias("most"), F.round("whole", 1).alias("whole"), "y").count().collect()
    *slopes, scorer.offset = logistic([((r["most"], r["whole"]), r["y"], r["count"]) for r in points])
    scorer.slopes = tuple(slopes)
    return scorer


def logistic(points: list[tuple[tuple[float, ...], int, int]], ridge: float = 0.05) -> list[float]:
    """Slopes and offset of the logistic curve through weighted points (variables, 0 or 1, weight), by Newton's method with a small ridge."""
    x = np.array([[*p[0], 1.0] for p in points])
    y, w = np.array([p[1] for p in points], float), np.array([p[2] for p in points], float)
    b = np.zeros(x.shape[1])
    b[-1] = math.log(((w * y).sum() + 0.5) / ((w * (1 - y)).sum() + 0.5))
    loss = lambda b: (w * np.logaddexp(0, np.where(y == 1, -1, 1) * (x @ b))).sum() + ridge * (b @ b) / 2
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -500, 500)))
        g = x.T @ (w * (p - y)) + ridge * b
        h = (x * (w * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b))
        step, size = np.linalg.solve(h, g), 1.0
        while size > 1e-6 and loss(b - size * step) > loss(b):
            size /= 2
        b = b - size * step
        if size * np.abs(step).max() < 1e-9:
            break
    return b.tolist()


def score_toxicity(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [scorer.score(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def restored(docs: DataFrame, model: CharModel) -> DataFrame:
    """doc_id and the restored text of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([restorer.text(t.as_py()) for t in batch.column(1)], pa.string())], ["doc_id", "restored"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, restored string")
