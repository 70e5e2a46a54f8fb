"""Proportional stratified interleaving into shards.

Rows of each source are shuffled by a seeded hash and ranked; a row's place in the whole is its fractional rank
(rank - 0.5) / rows of the source. Sorting all rows by it interleaves the sources in proportion, and cutting the sorted
sequence into equal runs gives every shard the mixture of the whole. The law is `rows`: counts differ by one at most.

Both ranks come from range-partitioned sorts with offsets from a small table of counts for each partition, so a source
that holds a third of all rows is sorted by many tasks. Only keys are shuffled, never texts.

Defined results: a null text has size 1 (its bytes plus one) and crc32 of nothing (0); null sources form one stratum;
repeated rows are placed row by row (ties are broken by all shuffled columns, so equal rows are interchangeable); an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch


def ranked(df: DataFrame, scratch: Scratch, name: str, order: list[str], within: str | None = None, tasks: int | None = None) -> DataFrame:
    """`df` with `rank` (from 0) by `order`, over all rows or over those of equal `within`, which must lead `order`.

    One range shuffle; the table of offsets has a row for each partition, or each partition and value that meet.
    """
    spark = df.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    row = F.monotonically_increasing_id()
    sorted_rows = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order).withColumn("_at", row)
    kept = scratch.keep(sorted_rows.withColumn("_part", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))), name)
    keys: list[Column] = [F.col(within)] if within else []
    parts = kept.groupBy("_part", *keys).agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("_part", *keys, "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    a, b = kept.alias("a"), offsets.alias("b")
    same = F.col("a._part") == F.col("b._part")
    if within:
        same &= F.col(f"a.{within}").eqNullSafe(F.col(f"b.{within}"))
    columns = [F.col(f"a.{c}") for c in df.columns]
    return a.join(b, same).select(*columns, (F.col("a._at") - F.col("b._first") + F.col("b._before")).alias("rank"))


def interleave(docs: DataFrame, shards: int = 16, seed: int = 42) -> DataFrame:
    """doc_id, source, size, text_crc32, position (place in the whole, from 0), shard, slot of every row of docs (doc_id, text, source)."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    scratch = Scratch(docs.sparkSession, "interleave")
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id", F.col("source").alias("source"), (F.octet_length(raw) + F.lit(1)).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.xxhash64(F.lit(seed), F.col("doc_id")).alias("shuffled"),
    )
    by_source = ranked(rows, scratch, "by_source", ["source", "shuffled", "doc_id", "text_crc32", "size"], within="source")
    totals = by_source.groupBy("source").agg(F.count(F.lit(1)).alias("_total")).withColumnRenamed("source", "_source")
    placed = by_source.join(totals, F.col("source").eqNullSafe(F.col("_source"))).withColumn("place", (F.col("rank") + 0.5) / F.col("_total"))
    whole = ranked(placed.select("place", "shuffled", "doc_id", "source", "size", "text_crc32"), scratch, "whole", ["place", "shuffled", "doc_id", "text_crc32", "size", "source"])
    n = docs.sparkSession.read.parquet(scratch.path("whole")).count()
    # Shard s takes positions from ceil(s * n / shards) on: exact integer arithmetic.
    out = whole.withColumnRenamed("rank", "position").withColumn("shard", F.expr(f"(position * {shards}L) div {max(n, 1)}L").cast("int"))
    start = F.expr(f"(cast(shard as bigint) * {n}L + {shards - 1}L) div {shards}L")
    return out.withColumn("slot", F.col("position") - start).select("doc_id", "source", "size", "text_crc32", "position", "shard", "slot")


def write_shards(docs: DataFrame, placed: DataFrame, path: str) -> None:
    """Documents with their shard and slot, in a folder for each shard, sorted by slot within its files."""
    docs.join(placed.select("doc_id", "shard", "slot"), "doc_id").repartition("shard", F.pmod(F.col("slot"), F.lit(8))).sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)
