"""Language identification by rank-order profiles.

A language's profile is the list of its most frequent character n-grams (1 to 3 letters, words padded by a space), in order
of frequency. A document's own list is compared with every profile by the out-of-place distance: the sum, over the document's
n-grams, of how far their ranks differ, where an n-gram that the profile lacks counts as the whole profile length.

Defined results. Text that is null, empty or without a letter: `und`, score 0. Ties between languages: the smaller name.
Ties between n-grams: the smaller code points. Repeated rows are judged one by one, alike. Null doc_id: predicted like any
other, not learnt from, held_out false. With nothing to learn from, everything is `und`. Other columns are not read.

At scale: profiles are fitted on a sample of labelled rows of about `sample_rows` a language, chosen by a hash, so that
fitting costs the same for any corpus; every label that occurs is learnt. The counts are summed before they are shuffled, and
what reaches the driver are the profiles, `length` rows a language. Prediction is one pass over the texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import held_out, remainder, written

UNDETERMINED = "und"
#: N-grams of a profile, expected sample rows per language.
PROFILE_LENGTH, SAMPLE_ROWS = 400, 1500
#: Letters of a text that are counted at a time.
CHUNK = 1 << 18
_SPREAD = 16
_BITS = np.uint64(21)
_LETTER: np.ndarray | None = None


def _letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text, each run of other characters as one space, padded by spaces."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    a = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    a = np.where(_LETTER[a], a, 32)
    keep = a != 32
    keep[1:] |= a[:-1] != 32
    keep[0] = True  # the padding before the first word
    return a[keep].astype(np.uint64)


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text, packed into integers of 21 bits a letter and in ascending order, and how often each occurs."""
    a = _letters(text or "")
    parts = []
    for start in range(0, len(a), CHUNK):
        c = a[start : start + CHUNK + 2]
        own = min(CHUNK, len(a) - start)
        one = c[:own]
        two = (c[:-1] << _BITS | c[1:])[:own]
        three = (c[:-2] << _BITS << _BITS | c[1:-1] << _BITS | c[2:])[:own]
        parts.append(np.unique(np.concatenate([one[one != 32], two, three[c[1:-1][:own] != 32]]), return_counts=True))
    if not parts or len(a) < 3:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    if len(parts) == 1:
        return parts[0]
    codes, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(back, np.concatenate([p[1] for p in parts])).astype(np.int64)


@dataclass(frozen=True)
class Profiles:
    """grams: all n-grams of any profile, ascending; gram i is in the languages `lang[first[i]:first[i + 1]]`, at rank `rank[...]`."""

    languages: list[str]
    grams: np.ndarray
    first: np.ndarray
    lang: np.ndarray
    rank: np.ndarray
    length: int

    @staticmethod
    def of(ranked: dict[str, list[int]], length: int) -> Profiles:
        languages = sorted(ranked)
        entries = sorted((g, k, r) for k, name in enumerate(languages) for r, g in enumerate(ranked[name][:length]))
        grams = np.array([e[0] for e in entries], np.uint64)
        kept, first = np.unique(grams, return_index=True)
        return Profiles(languages, kept, np.append(first, len(entries)), np.array([e[1] for e in entries], np.int64), np.array([e[2] for e in entries], np.int64), length)

    def closest(self, text: str | None) -> tuple[str, float]:
        """The language with the least out-of-place distance, and 1 minus that distance over the greatest possible."""
        codes, counts = gram_counts(text)
        if not len(codes) or not self.languages:
            return UNDETERMINED, 0.0
        order = np.argsort(-counts, kind="stable")[: self.length]
        top = codes[order]
        at = np.searchsorted(self.grams, top)
        at[at == len(self.grams)] = 0
        found = np.flatnonzero(self.grams[at] == top) if len(self.grams) else np.empty(0, np.int64)
        begin, sizes = self.first[at[found]], self.first[at[found] + 1] - self.first[at[found]]
        which = np.repeat(begin - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum()) if len(found) else np.empty(0, np.int64)
        nearness = self.length - np.abs(np.repeat(found, sizes) - self.rank[which])
        gained = np.bincount(self.lang[which], nearness, len(self.languages))
        best = int(np.argmax(gained))
        return self.languages[best], float(gained[best] / (self.length * len(top)))


def fit(docs: DataFrame, length: int = PROFILE_LENGTH, sample_rows: int = SAMPLE_ROWS) -> Profiles:
    """Profiles from text and lang of the rows outside the held-out fold."""
    rows = docs.select("doc_id", "text", "lang").where((remainder(F.col("doc_id")) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = written(rows.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    share = F.least(F.lit(1.0), F.lit(float(sample_rows)) / F.col("n"))
    sample = rows.join(sizes, "lang").where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30)).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = sums.setdefault(lang, [])
                own.append(gram_counts(text.as_py()))
                if len(own) >= 64:
                    sums[lang] = [_sum(own)]
        for lang, own in sums.items():
            codes, n = _sum(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes)), pa.array(codes.astype(np.int64)), pa.array(n)], ["lang", "gram", "n"])

    grams = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # the most frequent of each sixteenth of a language's n-grams hold the most frequent of all
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("gram"), F.lit(_SPREAD))).orderBy(F.desc("n"), "gram")
    top = grams.withColumn("place", F.row_number().over(part)).where(F.col("place") <= length)
    whole = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = top.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= length).select("lang", "gram", "rank").collect()
    ranked: dict[str, list] = {}
    for r in sorted(top, key=lambda r: (r["lang"], r["rank"])):
        ranked.setdefault(r["lang"], []).append(r["gram"])
    return Profiles.of(ranked, length)


def _sum(parts: list) -> tuple[np.ndarray, np.ndarray]:
    codes, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(back, np.concatenate([p[1] for p in parts]), len(codes)).astype(np.int64)


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = [profiles.closest(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x[0] for x in said], pa.string()), pa.array([x[1] for x in said], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, profiles: Profiles, least: float = 0.0) -> DataFrame:
    """The rows of docs, all columns, whose language can be told with a score above `least`; where `lang` is a column and null, the predicted one is filled in."""
    names = docs.columns
    at, lang = names.index("text"), names.index("lang") if "lang" in names else None

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = [profiles.closest(t.as_py()) for t in batch.column(at)]
            kept = pa.array([name != UNDETERMINED and score > least for name, score in said], pa.bool_())
            columns = list(batch.columns)
            if lang is not None and columns[lang].null_count:
                columns[lang] = pa.compute.coalesce(columns[lang], pa.array([name for name, _ in said], columns[lang].type))
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(kept)

    return docs.mapInArrow(passing, docs.schema)
