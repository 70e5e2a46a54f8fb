"""Token blocking: an inverted index as an equi-join on (view, country, token) with a weighted top-k.

Document-frequency pruning bounds the rows that a token joins on the pool side; the posting cap, where given, is part of the
result's definition. Nothing is collected, and no pair is formed that does not share a kept token.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def explode_tokens(records: DataFrame, tokens: Column, carried: list[str]) -> DataFrame:
    """One row for each record and distinct non-empty token."""
    return records.select(*carried, F.explode(F.array_distinct(F.filter(tokens, lambda t: t != ""))).alias("token"))


def document_frequency(tokens: DataFrame) -> DataFrame:
    return tokens.groupBy("country", "token").agg(F.count(F.lit(1)).alias("df"))


def kept_tokens(pool: DataFrame, tokens: DataFrame, max_df_ratio: float = 0.003, floor: int = 20) -> DataFrame:
    """(country, token, df, idf) of tokens that are not too frequent in their country's pool. Records without tokens count in its size."""
    sizes = pool.groupBy("country").agg(F.count(F.lit(1)).alias("n"))
    limit = F.greatest(F.lit(floor), F.floor(F.col("n") * F.lit(max_df_ratio)).cast("int"))
    return document_frequency(tokens).join(sizes, "country").where(F.col("df") <= limit).select("country", "token", "df", F.log(1 + F.col("n") / (1.0 + F.col("df"))).alias("idf"))


def postings(tokens: DataFrame, kept: DataFrame, max_postings: int | None = 900, order: tuple[str, ...] = ("id",)) -> DataFrame:
    """(country, token, idf, id) with at most `max_postings` records a token in the given order; None lifts the cap."""
    rows = tokens.join(kept.select("country", "token", "idf"), ["country", "token"])
    if max_postings is None:
        return rows
    rank = F.row_number().over(Window.partitionBy("country", "token").orderBy(*order))
    return rows.withColumn("posting", rank).where(F.col("posting") <= max_postings).drop("posting")


def top_k(query_tokens: DataFrame, kept: DataFrame, index: DataFrame, k: int = 15) -> DataFrame:
    """(q_id, pool_id, score, rank): the k records with the largest sum of idf; score is its share of the query's indexed idf.

    Ties go to the smaller id, on sums rounded to nine digits so that the order of addition doesn't matter.
    """
    found = query_tokens.select(F.col("id").alias("q_id"), "country", "token")
    raw = found.join(index.select("country", "token", "idf", F.col("id").alias("pool_id")), ["country", "token"]).groupBy("q_id", "pool_id").agg(F.sum("idf").alias("raw"))
    best = raw.withColumn("rank", F.row_number().over(Window.partitionBy("q_id").orderBy(F.desc(F.round("raw", 9)), "pool_id"))).where(F.col("rank") <= k)
    whole = found.join(kept.select("country", "token", "idf"), ["country", "token"]).groupBy("q_id").agg(F.sum("idf").alias("whole"))
    return best.join(whole, "q_id").select("q_id", "pool_id", (F.col("raw") / F.col("whole")).alias("score"), "rank")


def block_view(queries: DataFrame, pool: DataFrame, tokens: Column, k: int = 15, max_df_ratio: float = 0.003, max_postings: int | None = 900, order: tuple[str, ...] = ("id",)) -> DataFrame:
    """Top-k candidates of one view. Both frames have id, country and the columns that `tokens` reads."""
    own = explode_tokens(pool, tokens, list(dict.fromkeys(["id", "country", *order])))
    kept = kept_tokens(pool, own, max_df_ratio)
    return top_k(explode_tokens(queries, tokens, ["id", "country"]), kept, postings(own, kept, max_postings, order), k)


def merge_views(name_view: DataFrame, blend_view: DataFrame) -> DataFrame:
    """Candidates of either view with both scores, 0 where a view lacks them."""
    both = name_view.select("q_id", "pool_id", F.col("score").alias("n"), F.lit(None).cast("double").alias("b")).union(blend_view.select("q_id", "pool_id", F.lit(None).cast("double"), F.col("score")))
    return both.groupBy("q_id", "pool_id").agg(F.coalesce(F.max("n"), F.lit(0.0)).alias("name_score"), F.coalesce(F.max("b"), F.lit(0.0)).alias("blend_score"))


def first_by_id(rows: DataFrame, order: str, key: str = "id") -> DataFrame:
    """Distinct by key, the first by `order` kept."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_n = 1").drop("_n")


def candidates(queries: DataFrame, pool: DataFrame, k: int = 15, max_df_ratio: float = 0.003, max_postings: int | None = 900) -> DataFrame:
    """Two-view candidates of normalized records (id, country, norm_name, norm_address); a query only meets its own country's pool."""
    from tessera.functions.text import blocking_tokens, word_tokens

    name, blend = word_tokens(F.col("norm_name")), blocking_tokens(F.col("norm_name"), F.col("norm_address"))
    return merge_views(block_view(queries, pool, name, k, max_df_ratio, max_postings), block_view(queries, pool, blend, k, max_df_ratio, max_postings))
