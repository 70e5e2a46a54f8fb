"""Language identification with language-bitmask n-gram filters.

Training counts character n-grams of words by language and keeps, for each language, the n-grams that are frequent in it
and not much rarer than in the language that uses them most. They go into one bit-sliced Bloom filter: slot i holds a
mask with one bit for each language, so ANDing the masks of an n-gram's few slots gives all languages that contain it.
A text's languages are scored by the popcount of each bit over its n-grams, corrected for the filter's known rate of
false positives: (hits - n * rate) / (n * (1 - rate)).

Learned from a sample of labelled rows whose size is the parameter `sample_rows` (a classifier's bounded sample, taken
by a hash of the text); predictions cover every row and whole texts.

Defined results: a null text or one without a letter is `und` with score 0; with no labelled row every text is `und`;
ties go to the language that sorts first. Repeated rows are each predicted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import column_list, prepare

UNKNOWN = "und"
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def grams(text: str, n: int) -> np.ndarray:
    """A 64-bit code for each n-gram of the lower-cased text, where every run of other characters than letters is one blank.

    N-grams that hold a blank inside are left out: only those inside a word or at its borders count.
    """
    low = text.lower()
    codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
    if low.isascii():
        letter = (codes >= 97) & (codes <= 122)
    else:
        seen, where = np.unique(codes, return_inverse=True)
        letter = np.array([chr(c).isalpha() for c in seen.tolist()])[where]
    codes = np.where(letter, codes, 0).astype(np.uint64)
    keep = np.concatenate([[False], codes != 0]) | np.concatenate([codes != 0, [False]])  # one blank of each run
    codes = np.concatenate([[0], codes]).astype(np.uint64)[keep]
    codes = np.concatenate([codes, np.zeros(1, np.uint64)])
    if len(codes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(codes) - n + 1, np.uint64)
    inner = np.ones(len(out), bool)
    for k in range(n):
        part = codes[k : k + len(out)]
        out = (out ^ part) * _MIX[0]
        out ^= out >> np.uint64(29)
        if 0 < k < n - 1:
            inner &= part != 0
    return out[inner]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class LanguageFilter:
    """masks: (slots, ceil(languages / 8)) bytes; rate: each language's share of false positives."""

    languages: list[str]
    masks: np.ndarray
    rate: np.ndarray
    n: int
    hashes: int

    @classmethod
    def build(cls, sets: dict[str, np.ndarray], n: int, hashes: int, slots_log2: int) -> LanguageFilter:
        names = sorted(sets)
        masks = np.zeros((1 << slots_log2, max(1, -(-len(names) // 8))), np.uint8)
        out = cls(names, masks, np.zeros(len(names)), n, hashes)
        for k, name in enumerate(names):
            for j in range(hashes):
                np.bitwise_or.at(masks[:, k // 8], out.slots(sets[name], j), np.uint8(1 << (k % 8)))
            out.rate[k] = ((masks[:, k // 8] >> (k % 8)) & 1).mean() ** hashes
        return out

    def slots(self, codes: np.ndarray, j: int) -> np.ndarray:
        return ((codes * _MIX[j + 1]) >> np.uint64(64 - int(math.log2(len(self.masks))))).astype(np.int64)

    def members(self, codes: np.ndarray) -> np.ndarray:
        """For each n-gram the mask of the languages that contain it."""
        found = self.masks[self.slots(codes, 0)]
        for j in range(1, self.hashes):
            found = found & self.masks[self.slots(codes, j)]
        return found

    def shares(self, text: str) -> np.ndarray:
        """Each language's corrected share of the text's n-grams."""
        hits, total = np.zeros(len(self.languages)), 0
        for n in range(self.n, 0, -1):  # shorter n-grams only where a text has none of the full length
            codes = grams(text, n)
            if len(codes):
                break
        for k in range(0, len(codes), 1 << 16):
            found = self.members(codes[k : k + (1 << 16)])
            if found.shape[1] == 1:
                counts = np.bincount(found[:, 0], minlength=256)
                hits += [counts[_HAS_BIT[b]].sum() for b in range(len(self.languages))]
            else:
                hits += np.unpackbits(found, axis=1, bitorder="little")[:, : len(self.languages)].sum(axis=0)
            total += len(found)
        if not total:
            return hits
        return np.clip((hits - total * self.rate) / (total * np.maximum(1 - self.rate, 1e-9)), 0, 1)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        shares = self.shares(text)
        best = int(np.argmax(shares))
        return self.languages[best], float(shares[best] / total) if (total := shares.sum()) > 0 else 0.0


_HAS_BIT = [np.array([m for m in range(256) if m >> b & 1]) for b in range(8)]


def train(rows: DataFrame, n: int = 4, hashes: int = 2, slots_log2: int = 21, sample_rows: int = 6_000, least_count: int = 3, least_ratio: float = 0.25) -> LanguageFilter:
    """A filter from the columns text and lang. Rows without either don't count.

    `least_ratio`: an n-gram belongs to a language if its frequency there is at least this part of its highest frequency
    in any language; `least_count`: and it was seen so often there. Lengths 1 to n are all stored, for very short texts.
    """
    prepare(rows.sparkSession)
    labelled = rows.select("text", "lang").where("text is not null and lang is not null")
    known = labelled.count()
    if not known:
        return LanguageFilter.build({}, n, hashes, 4)
    if known > sample_rows:
        labelled = labelled.where(F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1 << 30)) < int((1 << 30) * sample_rows / known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str, int], int] = {}
        for batch in batches:
            for text, lang in zip(column_list(batch, "text"), column_list(batch, "lang"), strict=True):
                for size in range(1, n + 1):
                    codes, counts = np.unique(grams(text, size), return_counts=True)
                    for code, count in zip(codes.view(np.int64).tolist(), counts.tolist(), strict=True):
                        total[lang, code] = total.get((lang, code), 0) + count
                if len(total) > 500_000:
                    yield packed(total)
                    total = {}
        if total:
            yield packed(total)

    def packed(total: dict[tuple[str, int], int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in total]), pa.array([k[1] for k in total], pa.int64()), pa.array(list(total.values()), pa.int64())], names=["lang", "code", "count"])

    counted = labelled.mapInArrow(run, "lang string, code long, count long").groupBy("lang", "code").agg(F.sum("count").alias("count")).where(F.col("count") >= least_count)
    # What reaches the driver is bounded by the sample: distinct frequent n-grams of at most `sample_rows` texts.
    got = counted.toPandas()
    got["share"] = got["count"] / got.groupby("lang")["count"].transform("sum")
    got = got[got["share"] >= least_ratio * got.groupby("code")["share"].transform("max")]
    langs = {r["lang"] for r in labelled.select("lang").distinct().collect()}
    sets = {lang: got.loc[got["lang"] == lang, "code"].to_numpy(np.int64).view(np.uint64) for lang in langs}
    return LanguageFilter.build(sets, n, hashes, slots_log2)


def predict(docs: DataFrame, model: LanguageFilter) -> DataFrame:
    """doc_id, lang_pred, score for every row; only the text is looked at."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)  # a few MB, fixed by slots_log2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t) for t in column_list(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
