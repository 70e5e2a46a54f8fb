"""Structural rules of result lists, each as anti-joins or aggregates that yield issue rows (file, rule, key, detail, severity)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources import tables

#: The header of each result file.
HEADERS = {"matches": ["source1_entity_id", "matched_entity_ids"], "candidates": ["source1_entity_id", "candidate_entity_ids"]}


def _issues(rows: DataFrame, file: str, rule: str, key: str, detail=None, severity: str = "error") -> DataFrame:
    return rows.select(F.lit(file).alias("file"), F.lit(rule).alias("rule"), F.col(key).cast("string").alias("key"), (F.lit("") if detail is None else detail).cast("string").alias("detail"), F.lit(severity).alias("severity"))


def header_issue(spark, file: str, header: list[str], expected: list[str]) -> DataFrame:
    """V1: the first two header fields."""
    bad = [] if header[:2] == expected[:2] else [("\t".join(header),)]
    return _issues(spark.createDataFrame(bad, "k string"), file, "header", "k")


def duplicate_keys(rows: DataFrame, file: str) -> DataFrame:
    """V2: one issue for each repeat of a key."""
    again = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return _issues(again.select("key", F.explode(F.sequence(F.lit(2), F.col("n").cast("int"))).alias("k")), file, "duplicate_key", "key", F.col("k"))


def unknown_keys(rows: DataFrame, s1: DataFrame, file: str) -> DataFrame:
    """V3."""
    return _issues(rows.join(s1.select(F.col("id").alias("key")), "key", "left_anti"), file, "unknown_key", "key")


def repeated_ids(rows: DataFrame, file: str) -> DataFrame:
    """V4."""
    return _issues(rows.where(F.size("ids") != F.size(F.array_distinct("ids"))), file, "repeated_id", "key")


def self_matches(rows: DataFrame, file: str, prefix: str = "S1-") -> DataFrame:
    """V5."""
    listed = rows.select("key", F.explode("ids").alias("id")).where(F.col("id").startswith(prefix))
    return _issues(listed, file, "self_match", "key", F.col("id"))


def unknown_ids(rows: DataFrame, pool: DataFrame, file: str, skip_prefix: str | None = None) -> DataFrame:
    """V6: listed ids outside the pool."""
    listed = rows.select("key", F.explode("ids").alias("id"))
    if skip_prefix:
        listed = listed.where(~F.col("id").startswith(skip_prefix))
    return _issues(listed.join(pool.select("id"), "id", "left_anti"), file, "unknown_id", "key", F.col("id"))


def missing_keys(rows: DataFrame, s1: DataFrame, file: str) -> DataFrame:
    """V7: one issue with the count and the five least ids."""
    lost = s1.select(F.col("id").alias("key")).join(rows.select("key"), "key", "left_anti")
    least = lost.orderBy("key").limit(5).agg(F.array_join(F.array_sort(F.collect_list("key")), ",").alias("some"))
    n = lost.agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    return _issues(n.crossJoin(least).select(F.col("n").cast("string").alias("n"), "some"), file, "missing_key", "n", F.col("some"))


def not_candidates(matches: DataFrame, cands: DataFrame) -> DataFrame:
    """V8: matched ids that were no candidates; reported as warnings that fail the run."""
    listed = matches.select("key", F.explode("ids").alias("id")).distinct()
    offered = cands.select("key", F.explode("ids").alias("id")).distinct()
    extra = listed.join(offered, ["key", "id"], "left_anti").groupBy("key").agg(F.array_join(F.array_sort(F.collect_set("id")), ",").alias("d"))
    return _issues(extra, "matches", "not_candidate", "key", F.col("d"), "warning")


def validate(matches: DataFrame, cands: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """All row rules over (key, ids) frames; the run passes if there is no issue at all."""
    parts = []
    for rows, file in ((matches, "matches"), (cands, "candidates")):
        parts += [duplicate_keys(rows, file), unknown_keys(rows, s1, file), repeated_ids(rows, file), missing_keys(rows, s1, file)]
    parts += [self_matches(matches, "matches"), unknown_ids(matches, pool, "matches", "S1-"), unknown_ids(cands, pool, "candidates"), not_candidates(matches, cands)]
    return reduce(DataFrame.unionByName, parts)


def universe(s2: DataFrame, s3: DataFrame) -> DataFrame:
    """Ids that may be listed: those of both candidate sources."""
    return tables.id_universe(s2, "S2-").union(tables.id_universe(s3, "S3-")).distinct()


def validate_files(spark: SparkSession, matching: str, candidate: str, s1: DataFrame, s2: DataFrame, s3: DataFrame) -> DataFrame:
    """All rules over two result files and the three sources' records, headers included."""
    heads = [header_issue(spark, file, tables.read_header(spark, path), HEADERS[file]) for file, path in (("matches", matching), ("candidates", candidate))]
    rows = validate(tables.read_id_lists(spark, matching), tables.read_id_lists(spark, candidate), tables.id_universe(s1, "S1-"), universe(s2, s3))
    return reduce(DataFrame.unionByName, heads, rows)


def report(issues: DataFrame, first: int = 5) -> DataFrame:
    """The issues with, of those about matches that were no candidates, only the `first` by key and one more that counts the rest."""
    subset = F.col("rule") == "not_candidate"
    some = issues.where(subset).orderBy("key").limit(first)
    rest = issues.where(subset).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > first)
    more = _issues(rest.select((F.col("n") - first).cast("string").alias("n")), "matches", "not_candidate_rest", "n", severity="warning")
    return issues.where(~subset).unionByName(some).unionByName(more)


def verdict(issues: DataFrame, first: int = 5) -> DataFrame:
    """(n_issues, passed): the rows of the report, without sorting any."""
    subset = F.count(F.when(F.col("rule") == "not_candidate", 1))
    n = F.count(F.lit(1)) - subset + F.least(subset, F.lit(first)) + (subset > first).cast("long")
    return issues.agg(n.alias("n_issues")).select("n_issues", (F.col("n_issues") == 0).alias("passed"))
