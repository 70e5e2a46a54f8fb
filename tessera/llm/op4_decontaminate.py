"""Benchmark decontamination by spaced-seed hashing, in DataFrame operations only.

A seed is a mask over a span of tokens: the hash of the selected positions ignores the others, so a passage with a replaced
word still meets its test item through a mask that skips it. Hashes of the test items' windows are joined with those of
the training texts; a hit names the document, the item and the shift between them. Around each hit the item is laid over
the document at that shift, and the passage counts as contamination if in some window of `window` tokens (the whole item
if it is shorter) at least `percent` hundredths of the tokens agree in place.

Tokens are runs of letters and digits in lower case, so punctuation, layout and case don't matter. The test items are
the small side; they are broadcast after a check of their number. Candidate documents are read again by their ids.

The masks depend on the number of an item's tokens, so that with the default window and percentage every pattern of replaced
or cut off tokens within the rule leaves a window of some mask whole (tests enumerate them all). Texts are hashed by the masks that
the test items need.

Defined results: null or empty texts and items have no tokens and no hits; items with fewer than three tokens never have one;
repeated items are each reported; repeated rows of a document once; rows without doc_id or item_id are left out; texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, small

#: Fixed masks by the least number of an item's tokens: selected positions in a span of eight tokens at most.
SEEDS = {
    3: ((0, 1, 2), (0, 1, 3), (0, 2, 3)),
    8: ((0, 1, 2, 4), (0, 3, 4, 5), (0, 1, 3, 6)),
    16: ((0, 1, 2, 3, 7), (0, 1, 4, 5, 6), (0, 2, 4, 6, 7), (0, 1, 2, 3, 5), (0, 1, 2, 4, 5)),
}
SPAN = 8


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def seeds_for(n: int) -> tuple[tuple[int, ...], ...]:
    """The masks for an item of n tokens."""
    return SEEDS[max(least for least in SEEDS if least <= n)] if n >= min(SEEDS) else ()


def seed_hashes(rows: DataFrame, keys: list[str], seeds: tuple[tuple[int, ...], ...], words: str = "words") -> DataFrame:
    """(keys, at, hash): the hash of every window by every mask that doesn't reach behind the end.

    Words are hashed once each; shifted slices of the numbers are zipped, so that one generator gives all windows and the
    masks are compiled code over numbers. Behind the end the zip has nulls.
    """
    numbers = rows.select(*keys, F.transform(words, lambda w: F.xxhash64(w)).alias("h"))
    slices = [F.slice("h", k + 1, F.size("h")).alias(f"w{k}") for k in range(SPAN)]
    windows = numbers.select(*keys, F.posexplode(F.arrays_zip(*slices)).alias("at", "w"))
    names = [f"_{s}" for s in range(len(seeds))]
    coded = [F.when(F.col(f"w.w{seed[-1]}").isNotNull(), F.xxhash64(F.lit("-".join(map(str, seed))), *(F.col(f"w.w{k}") for k in seed))) for seed in seeds]
    hashed = windows.select(*keys, "at", *(c.alias(n) for n, c in zip(names, coded, strict=True)))
    return hashed.select(*keys, "at", F.explode(F.array(*names)).alias("hash")).where("hash is not null")


def hits(docs: DataFrame, items: DataFrame, scratch: Scratch) -> DataFrame:
    """Distinct (doc_id, item_id, shift) at which a seed of an item meets a document."""
    n = F.size("words")
    bounds = [*sorted(SEEDS), (1 << 31) - 1]
    kinds = {low: items.where((n >= low) & (n < high)) for low, high in zip(bounds, bounds[1:], strict=False)}
    kinds = {low: some for low, some in kinds.items() if not some.isEmpty()}
    wanted = items.select("item_id", F.lit(0).alias("item_at"), F.lit(0).cast("long").alias("hash")).limit(0)
    for low, some in kinds.items():
        wanted = wanted.union(seed_hashes(some, ["item_id"], SEEDS[low]).select("item_id", F.col("at").alias("item_at"), "hash"))
    wanted = scratch.keep(wanted.distinct(), "seeds")
    words = docs.select("doc_id", tokens(F.col("text")).alias("words"))
    seeds = tuple(seed for low in kinds for seed in SEEDS[low]) or SEEDS[16]
    found = seed_hashes(words, ["doc_id"], seeds).join(small(wanted), "hash").select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift"))
    return scratch.keep(found.distinct(), "hits")


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = 20, percent: int = 75) -> DataFrame:
    """doc_id, item_id, shift, matched, item_tokens, best_window (agreeing tokens in the best window), of every contaminated passage.

    docs: doc_id and text; benchmark: item_id and text.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    docs = docs.select("doc_id", "text").where("doc_id is not null")
    items = scratch.keep(benchmark.where("item_id is not null").select("item_id", tokens(F.col("text")).alias("words")).where(F.size("words") > 0), "items")
    met = hits(docs, items, scratch)
    ids = scratch.keep(met.select("doc_id").distinct(), "ids")
    texts = docs.join(small(ids), "doc_id", "left_semi").select("doc_id", tokens(F.col("text")).alias("words"))
    n = F.size("item_words")
    laid = met.join(texts, "doc_id").join(small(items.select("item_id", F.col("words").alias("item_words"))), "item_id")
    # Places of the item that fall into the document, from the item's first to its last.
    aligned = F.slice("words", F.greatest(F.col("shift"), F.lit(0)) + 1, n + F.least(F.col("shift"), F.lit(0)))
    before = F.greatest(-F.col("shift"), F.lit(0))
    agree = F.transform("item_words", lambda w, k: F.when((k >= before) & (k - before < F.size("aligned")), (F.get("aligned", k - before) == w).cast("int")).otherwise(F.lit(0)))
    width = F.least(n, F.lit(window))
    laid = laid.withColumn("aligned", aligned).withColumn("agree", agree)
    sums = F.transform(F.sequence(F.lit(1), n - width + 1), lambda k: F.aggregate(F.slice("agree", k, width), F.lit(0), lambda z, x: z + x))
    scored = laid.select("doc_id", "item_id", "shift", F.aggregate("agree", F.lit(0), lambda z, x: z + x).alias("matched"), n.alias("item_tokens"), F.array_max(sums).alias("best_window"), width.alias("width"))
    return scored.where(F.col("best_window") * 100 >= F.col("width") * percent).drop("width").distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 20, percent: int = 75) -> DataFrame:
    """One row for each document and item that meet: doc_id, item_id, the best passage's shift, matched, item_tokens and best_window."""
    best = F.max(F.struct("best_window", "matched", (-F.col("shift")).alias("_shift"), "item_tokens")).alias("best")
    found = overlaps(docs, benchmark, window, percent).groupBy("doc_id", "item_id").agg(best, F.count(F.lit(1)).alias("passages"))
    return found.select("doc_id", "item_id", (-F.col("best._shift")).alias("shift"), "best.matched", "best.item_tokens", "best.best_window", "passages")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 20, percent: int = 75) -> DataFrame:
    """The rows of docs without contamination."""
    return docs.join(overlaps(docs, benchmark, window, percent).select("doc_id").distinct(), "doc_id", "left_anti")
