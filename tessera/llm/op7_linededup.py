"""Line deduplication over levelled sorted runs of line hashes.

`LineRuns` keeps, in the shared folder, runs of (key hash, documents) sorted by hash, on levels as a log-structured merge
tree does: a new batch of documents is anti-joined with the runs to tell its new keys from known ones, and its counts become
a run on level 0; when a level has `fanout` runs they are merged into one on the next level. Every run is dealt by the same
hash to the same number of sorted buckets, so a lookup merges sorted sequences.

`dedup` is the whole-corpus rule over such runs: a line whose key is found in at least `least_documents` documents is
dropped wherever it stands. Hashes have 128 bits (two longs), so no two keys of a corpus meet in practice.

A key is the line without `[\\x20\\x09-\\x0D]` at both ends, with A-Z in lower case. Defined results: a null or empty text
is one empty line; an empty key is never dropped; repeats within a document count once; repeated doc_ids count as separate
documents (rows); texts of any length are split whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, column_list, lower_ascii_bytes, prepare, utf8

_STRIPPED = b" \t\n\x0b\x0c\r"


def line_keys(lines: list[bytes]) -> list[bytes]:
    """Each line's 16-byte hash, or nothing for a line whose key is empty."""
    digest, strip = xxhash.xxh3_128_digest, _STRIPPED
    return [digest(key) if (key := lower_ascii_bytes(line.strip(strip))) else b"" for line in lines]


def hashed_lines(docs: DataFrame, batches: int) -> DataFrame:
    """(batch, hi, lo, docs): for each Arrow batch of documents, how many hold each key. Rows are dealt to batches by doc_id."""
    prepare(docs.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            counts: dict[tuple[int, bytes], int] = {}
            for number, text in zip(column_list(part, "batch"), column_list(part, "text"), strict=True):
                for key in set(line_keys(utf8(text).split(b"\n"))):
                    if key:
                        counts[number, key] = counts.get((number, key), 0) + 1
            halves = np.frombuffer(b"".join(k[1] for k in counts), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in counts], pa.int32()), pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(list(counts.values()), pa.int64())], names=["batch", "hi", "lo", "docs"]
            )

    number = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch")
    return docs.select(number, "text").mapInArrow(run, "batch int, hi long, lo long, docs long")


class LineRuns:
    """Levelled sorted runs of line keys with their document counts."""

    def __init__(self, spark: SparkSession, scratch: Scratch | None = None, fanout: int = 3) -> None:
        self.spark, self.scratch, self.fanout = spark, scratch or Scratch(spark, "line-runs"), fanout
        self.levels: list[list[str]] = []
        self.made = 0

    def names(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def read(self, names: list[str] | None = None) -> DataFrame:
        """The rows of the runs; a key has one in each run that holds it."""
        paths = [self.scratch.path(n) for n in (self.names() if names is None else names)]
        schema = "hi long, lo long, docs long, known boolean"
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _write(self, rows: DataFrame) -> str:
        name = f"run-{self.made:05d}"
        self.made += 1
        self.scratch.keep(rows.sortWithinPartitions("hi", "lo"), name)
        return name

    def append(self, batch: DataFrame) -> DataFrame:
        """Adds a batch (hi, lo, docs) as a run and returns its new keys, those that no run had: the merge anti-join."""
        counted = batch.groupBy("hi", "lo").agg(F.sum("docs").alias("docs"))
        known = self.read().select("hi", "lo", F.lit(True).alias("known")).distinct()
        if self.levels:
            marked = counted.hint("merge").join(known, ["hi", "lo"], "left").select("hi", "lo", "docs", F.coalesce("known", F.lit(False)).alias("known"))
        else:
            marked = counted.withColumn("known", F.lit(False))
        name = self._write(marked)
        self.levels = self.levels or [[]]
        self.levels[0].append(name)
        new = self.read([name]).where("not known").select("hi", "lo")
        self._compact()
        return new

    def _compact(self) -> None:
        for depth in range(len(self.levels)):
            if len(self.levels[depth]) >= self.fanout:
                old = self.levels[depth]
                merged = self.read(old).groupBy("hi", "lo").agg(F.sum("docs").alias("docs"), F.lit(True).alias("known"))
                name = self._write(merged.select("hi", "lo", "docs", "known"))
                self.levels[depth] = []
                if depth + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[depth + 1].append(name)

    def totals(self) -> DataFrame:
        return self.read().groupBy("hi", "lo").agg(F.sum("docs").alias("docs"))


def frequent_keys(docs: DataFrame, least_documents: int, scratch: Scratch, batches: int) -> DataFrame:
    """Keys in at least `least_documents` rows of docs, counted through the runs batch by batch."""
    hashed = scratch.keep(hashed_lines(docs, batches), "hashed")
    runs = LineRuns(docs.sparkSession, scratch)
    for number in range(batches):
        runs.append(hashed.where(F.col("batch") == number))
    found = scratch.keep(runs.totals().where(F.col("docs") >= least_documents).select("hi", "lo"), "frequent")
    scratch.drop("hashed", *(f"run-{k:05d}" for k in range(runs.made)))
    return found


def dedup(docs: DataFrame, least_documents: int = 10, batches: int = 4, carried: list[str] | None = None) -> DataFrame:
    """Columns of docs in `carried` (default doc_id), n_lines, n_dropped, kept: the text without lines in at least `least_documents` documents.

    The frequent keys are broadcast if their count allows it. Beyond, each document's keys are looked up by a shuffle join
    of (row, key) and only the found ones return to the rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "linededup")
    frequent = frequent_keys(docs, least_documents, scratch, batches)
    rows = frequent.count()
    carried = carried or ["doc_id"]
    out_schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carried) + ", n_lines long, n_dropped long, kept string"

    def strip(batch: pa.RecordBatch, drops) -> pa.RecordBatch:
        n, dropped, kept = [], [], []
        for text, drop in zip(column_list(batch, "_text"), drops, strict=True):
            lines = utf8(text).split(b"\n")
            stay = [line for line, key in zip(lines, line_keys(lines), strict=True) if not (key and key in drop)]
            n.append(len(lines))
            dropped.append(len(lines) - len(stay))
            kept.append(b"\n".join(stay).decode("utf-8", "surrogatepass"))
        return pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(carried))), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())], names=[*carried, "n_lines", "n_dropped", "kept"])

    prepare(spark)
    source = docs.select(*carried, F.col("text").alias("_text"))
    if rows <= KEYS_AT_HAND:
        got = frequent.toPandas()
        shared = spark.sparkContext.broadcast(np.ascontiguousarray(got[["hi", "lo"]].to_numpy(np.int64)).tobytes())

        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            raw = shared.value
            drop = {raw[k : k + 16] for k in range(0, len(raw), 16)}
            for batch in parts:
                yield strip(batch, [drop] * batch.num_rows)

        return source.mapInArrow(run, out_schema)
    return _dedup_shuffled(source, frequent, carried, strip, out_schema)


#: Frequent keys (16 bytes each) that are sent to every executor; beyond that they are joined.
KEYS_AT_HAND = 500_000


def _dedup_shuffled(source: DataFrame, frequent: DataFrame, carried: list[str], strip, out_schema: str) -> DataFrame:
    scratch = Scratch(source.sparkSession, "linededup-rows")
    numbered = scratch.keep(source.withColumn("_row", F.monotonically_increasing_id()), "rows")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows, keys = [], []
            for row, text in zip(column_list(part, "_row"), column_list(part, "_text"), strict=True):
                own = {k for k in line_keys(utf8(text).split(b"\n")) if k}
                rows += [row] * len(own)
                keys += own
            halves = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1])], names=["_row", "hi", "lo"])

    found = numbered.select("_row", "_text").mapInArrow(run, "_row long, hi long, lo long").join(frequent, ["hi", "lo"])
    # A row's list has no more entries than the row has lines.
    lists = found.groupBy("_row").agg(F.collect_list(F.struct("hi", "lo")).alias("_drop"))
    joined = numbered.join(lists, "_row", "left").select(*carried, "_text", "_drop")

    def finish(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            drops = [{np.array([d["hi"], d["lo"]], np.int64).tobytes() for d in (drop or ())} for drop in column_list(batch, "_drop")]
            yield strip(batch, drops)

    return joined.mapInArrow(finish, out_schema)


def digest(deduped: DataFrame) -> DataFrame:
    """The kept text as lowercase hex of its SHA-256."""
    return deduped.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


