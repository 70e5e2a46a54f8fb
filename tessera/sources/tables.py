"""Tab-separated sources and sinks with explicit schemas, the country-partitioned layout, and id-list files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import country_slug, format_ids, parse_ids

RECORD = "entity_id string, business_name string, business_address string, country string"
TRUTH = "source1_entity_id string, matched_entity_ids string"


def _csv(spark: SparkSession, path: str, schema: str, malformed: str = "PERMISSIVE") -> DataFrame:
    df = spark.read.csv(path, sep="\t", header=True, schema=schema, quote="", mode=malformed)
    return df.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in df.columns))


def read_records(spark: SparkSession, path: str, limit: int | None = None, drop_short: bool = False) -> DataFrame:
    """Source records; blanks are empty strings. `drop_short` leaves out rows with too few fields."""
    df = _csv(spark, path, RECORD, "DROPMALFORMED" if drop_short else "PERMISSIVE")
    return df if limit is None else df.limit(limit)


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, TRUTH).select(F.col("source1_entity_id").alias("s1"), parse_ids(F.col("matched_entity_ids")).alias("ids"))


def read_id_lists(spark: SparkSession, path: str) -> DataFrame:
    """(key, ids) of a headed two-column file; further tabs belong to the list."""
    lines = spark.read.csv(path, sep="\x01", header=True, schema="value string", quote="").where(F.col("value") != "")  # whole lines; each file's first is its header
    parts = F.split("value", "\t", 2)
    return lines.select(parts[0].alias("key"), parse_ids(F.get(parts, F.lit(1))).alias("ids"))


def read_header(spark: SparkSession, path: str) -> list[str]:
    """The fields of the first line; none for an empty file."""
    first = spark.read.text(path).first()
    return first["value"].split("\t") if first else []


def write_id_lists(df: DataFrame, path: str, key_name: str, list_name: str, mode: str = "overwrite") -> None:
    """(key, ids) as headed tab-separated text; `mode="append"` adds to earlier rows."""
    df.select(F.col("key").alias(key_name), format_ids(F.col("ids")).alias(list_name)).write.mode(mode).csv(path, sep="\t", header=True, emptyValue="", quote="")


def write_partitioned(sources: dict[str, DataFrame], path: str) -> None:
    """Records of all sources by source and country slug; readers prune partitions. A source that is written again is replaced."""
    for name, df in sources.items():
        df.withColumn("country_slug", country_slug(F.col("country"))).write.mode("overwrite").partitionBy("country_slug").parquet(f"{path}/source={name}")


def read_pool(spark: SparkSession, path: str, slug: str | None = None, sources: tuple[str, ...] = ("source2", "source3")) -> DataFrame:
    df = spark.read.parquet(path).where(F.col("source").isin(*sources))
    return df if slug is None else df.where(F.col("country_slug") == slug)


def country_slugs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where("source = 'source1'").select("country_slug").distinct().orderBy("country_slug")


def sample(df: DataFrame, n: int, key: str = "entity_id", seed: int = 42) -> DataFrame:
    """A uniform sample of n rows by a seeded hash of the key."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"#{seed}"))), key).limit(n)


def rows_with_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key).distinct(), key, "left_semi")


def rows_without_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key).distinct(), key, "left_anti")


def id_universe(df: DataFrame, prefix: str, key: str = "entity_id") -> DataFrame:
    return df.where(F.col(key).startswith(prefix)).select(F.col(key).alias("id")).distinct()
