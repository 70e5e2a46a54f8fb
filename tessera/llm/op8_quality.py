"""Quality rules: gradient-boosted trees over document statistics.

Statistics of every whole text are taken in one pass. Trees are grown on the driver by histograms over a bounded sample of
labelled rows (`sample_rows`), with monotonic constraints: more repetition, symbols or shouting never raises the score. The
trees are flattened into numpy node arrays, which score a batch of rows level by level without a loop over rows or trees.

Defined results: a null or empty text has zero words and fails the base rule; without labels of both classes the trees keep
everything that the base rule keeps; repeated rows are each scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import SPACE, column_list, prepare

SYMBOLS = "#*$%&|<>"

#: Statistics that the trees read; 1: the score may only rise with it, -1: may only fall, 0: free.
FEATURES = {
    "log_words": 0, "mean_word_chars": 0, "symbol_share": -1, "symbol_word_share": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": -1, "exclaim_share": -1, "bar_word_share": -1,
    "digit_share": 0, "distinct_share": 0, "line_words": 0, "top_word_share": 0,
}


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """[n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words] and the trees' features of a whole text."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    if not n:
        return [0] * 5, [0.0] * len(FEATURES)
    chars = len(text) - sum(map(text.count, SPACE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = text.split("\n")
    seen, dup, filled = set(), 0, 0
    for line in lines:
        if line.strip(SPACE):
            filled += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    ids = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)  # equality within this text is all that is asked
    repeats = 0
    if n > 5:
        windows = np.zeros(n - 4, np.uint64)
        for k in range(5):
            windows = (windows ^ ids[k : k + n - 4]) * np.uint64(0x9E3779B97F4A7C15)
            windows ^= windows >> np.uint64(31)
        order = np.argsort(windows, kind="stable")
        same = windows[order[1:]] == windows[order[:-1]]
        if same.any():
            twice = np.zeros(n - 4, bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            edge = np.zeros(n + 1, np.int64)
            at = np.flatnonzero(twice)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + 5, -1)
            repeats = int((np.cumsum(edge[:-1]) > 0).sum())
    distinct, counts = np.unique(ids, return_counts=True)
    letters = sum(map(str.isalpha, text)) if not text.isascii() else 0
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    by = np.bincount(raw, minlength=256)
    upper = int(by[65:91].sum())
    letters = int(by[65:91].sum() + by[97:123].sum()) if not letters else letters
    marked = sum(1 for w in words if w[-1] in _SYMBOL_BYTES)
    features = [
        float(np.log1p(n)), chars / n, symbols / chars, marked / n, dup / max(filled, 1), repeats / n, upper / max(letters, 1), text.count("!") / n, text.count("|") / n,
        int(by[48:58].sum()) / chars, len(distinct) / n, n / max(filled, 1), int(counts.max()) / n,
    ]
    return [n, chars, symbols, dup, repeats], features


_SYMBOL_BYTES = frozenset(SYMBOLS.encode())


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 10 or 100 * n_repeat_words > 20 * n_words


@dataclass
class Trees:
    """Node arrays of all trees: a leaf's `left` is itself, so walking on from it changes nothing."""

    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    cut: np.ndarray = field(default_factory=lambda: np.zeros(0))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    right: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    roots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    depth: int = 0
    start: float = 0.0
    threshold: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        if not len(self.roots):
            return np.full(len(x), self.start)
        node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = np.where(x[rows, self.feature[node]] <= self.cut[node], self.left[node], self.right[node])
        return self.start + self.value[node].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def grow(x: np.ndarray, y: np.ndarray, signs: list[int], trees: int = 60, depth: int = 4, rate: float = 0.15, l2: float = 1.0, bins: int = 64, least_leaf: float = 2.0) -> Trees:
    """Boosted trees for the logistic loss by histograms, with monotonic constraints.

    A split on a constrained feature whose children's weights stand in the wrong order is refused, and the middle of the two
    weights bounds all weights below it, so the constraint holds for the whole tree.
    """
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(width)], axis=1)  # bin b: x <= cuts[b]
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    start = float(np.log(share / (1 - share)))
    margin = np.full(n, start)
    feature, cut, left, right, value, roots = [], [], [], [], [], []

    def leaf(weight: float) -> int:
        at = len(feature)
        feature.append(0), cut.append(0.0), left.append(at), right.append(at), value.append(weight)
        return at

    def weight_of(g, h, low: float, high: float):
        return np.clip(-g / (h + l2), low, high)

    def build(rows: np.ndarray, level: int, low: float, high: float) -> int:
        g, h = gradient[rows], hessian[rows]
        total_g, total_h = g.sum(), h.sum()
        here = float(weight_of(total_g, total_h, low, high))
        best = (1e-6, None)
        if level < depth and len(rows) >= 2:
            gain_of = lambda gg, hh, w: -(gg * w + 0.5 * (hh + l2) * w * w)  # noqa: E731  what a leaf of this weight takes off the loss
            for j in range(width):
                k = len(cuts[j])
                if not k:
                    continue
                hist_g = np.bincount(binned[rows, j], g, k + 1).cumsum()[:k]
                hist_h = np.bincount(binned[rows, j], h, k + 1).cumsum()[:k]
                wl, wr = weight_of(hist_g, hist_h, low, high), weight_of(total_g - hist_g, total_h - hist_h, low, high)
                gain = gain_of(hist_g, hist_h, wl) + gain_of(total_g - hist_g, total_h - hist_h, wr) - gain_of(total_g, total_h, here)
                gain[(hist_h < least_leaf) | (total_h - hist_h < least_leaf)] = -1
                if signs[j]:
                    gain[(wr - wl) * signs[j] < 0] = -1
                at = int(np.argmax(gain))
                if gain[at] > best[0]:
                    best = (gain[at], (j, at, float(wl[at]), float(wr[at])))
        if best[1] is None:
            at = leaf(rate * here)
            step[rows] = rate * here
            return at
        j, b, wl, wr = best[1]
        at = leaf(0.0)
        feature[at], cut[at] = j, float(cuts[j][b])
        middle = (wl + wr) / 2
        bounds_l, bounds_r = (low, high), (low, high)
        if signs[j] > 0:
            bounds_l, bounds_r = (low, middle), (middle, high)
        elif signs[j] < 0:
            bounds_l, bounds_r = (middle, high), (low, middle)
        go_left = binned[rows, j] <= b
        left[at] = build(rows[go_left], level + 1, *bounds_l)
        right[at] = build(rows[~go_left], level + 1, *bounds_r)
        return at

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian, step = p - y, p * (1 - p), np.zeros(n)
        roots.append(build(np.arange(n), 0, -8.0, 8.0))
        margin += step
    return Trees(np.array(feature, np.int32), np.array(cut), np.array(left, np.int32), np.array(right, np.int32), np.array(value), np.array(roots, np.int32), depth, start)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 10_000, lost_share: float = 0.001) -> Trees:
    """Trees for quality = 1, from at most about `sample_rows` labelled rows (by a hash of doc_id).

    The threshold is the highest one, 0.5 at most, that rejects no more than `lost_share` of the sample's good rows.
    """
    prepare(docs.sparkSession)
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    n = labels.where("quality is not null and doc_id is not null").count()
    if n > sample_rows:
        known = known.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) < int((1 << 30) * sample_rows / n))
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("quality", "text")  # the sample is bounded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(t) for t in column_list(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([f[0] for f in found], pa.list_(pa.int64())), pa.array([f[1] for f in found], pa.list_(pa.float64()))], names=["quality", "base", "features"])

    got = rows.mapInArrow(run, "quality long, base array<long>, features array<double>").toPandas()
    if not len(got):
        return Trees()
    got = got[[not base_failed(int(b[0]), int(b[4])) for b in got["base"]]]
    if got["quality"].nunique() < 2:
        return Trees()
    x, y = np.stack(got["features"].to_list()), (got["quality"].to_numpy() == 1).astype(float)
    order = np.lexsort([*x.T, y])  # the same trees whatever order the rows arrive in
    x, y = x[order], y[order]
    model = grow(x, y, list(FEATURES.values()))
    model.threshold = min(0.5, float(np.quantile(model.probability(x[y == 1]), lost_share, method="lower")))
    return model


SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean"


def judge(docs: DataFrame, model: Trees, carried: list[str] | None = None) -> DataFrame:
    """Columns of docs in `carried` (default doc_id; text may be one), the base statistics, the trees' score and the verdict."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)  # node arrays, of a size fixed by trees and depth
    carried = carried or ["doc_id"]
    read = "text" if "text" in carried else "_text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            found = [statistics(t) for t in column_list(batch, read)]
            base = np.array([f[0] for f in found], np.int64)
            failed = np.array([base_failed(int(b[0]), int(b[4])) for b in base])
            score = trees.probability(np.array([f[1] for f in found]))
            kept = ~failed & (score >= trees.threshold)
            columns = [*(batch.column(k) for k in range(len(carried))), *(pa.array(base[:, k]) for k in range(5)), pa.array(failed), pa.array(score), pa.array(kept)]
            yield pa.RecordBatch.from_arrays(columns, names=[*carried, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carried) + ", " + SCHEMA
    return docs.select(*carried, *([] if read == "text" else [F.col("text").alias(read)])).mapInArrow(run, schema)
