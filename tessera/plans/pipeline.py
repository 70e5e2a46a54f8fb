"""End-to-end plans: pairs, training, linking and resuming."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.features import FEATURE_NAMES, with_features
from tessera.functions.text import with_normalized
from tessera.operators import index as stored_index
from tessera.operators.blocking import candidates, first_by_id
from tessera.operators.metrics import best_threshold, recall_ceiling, threshold_sweep
from tessera.plans import model as m
from tessera.sources import tables


def records(df: DataFrame, compose: bool = True) -> DataFrame:
    """Source records as normalized rows: id, country, norm_name, norm_address, norm_country, blend_text."""
    return with_normalized(df, compose=compose).select(F.col("entity_id").alias("id"), F.col("norm_country").alias("country"), "norm_name", "norm_address", "norm_country", "blend_text")


def pool_of(*sources: DataFrame) -> DataFrame:
    """Union of candidate sources, distinct by id with the earlier source kept."""
    rows = None
    for k, s in enumerate(sources):
        part = s.withColumn("_k", F.lit(k))
        rows = part if rows is None else rows.unionByName(part)
    return first_by_id(rows, "_k", "entity_id").drop("_k")


def truth_pairs(truth: DataFrame, s1: DataFrame) -> DataFrame:
    """(s1, pool_id) of the true matches (s1, ids) of the given records; records without a truth row have none."""
    own = truth.join(s1.select(F.col("entity_id").alias("s1")).distinct(), "s1", "left_semi")
    return own.select("s1", F.explode("ids").alias("pool_id")).distinct()


def training_pool(s2: DataFrame, s3: DataFrame, truth: DataFrame, size: int, seed: int = 42) -> DataFrame:
    """Every true match (truth: s1, pool_id), and seeded samples of both sources that fill the pool up to about `size`, half each.

    `size` bounds the filling only; true matches are never left out. Distinct by id, true matches first.
    """
    needed = truth.select(F.col("pool_id").alias("entity_id"))
    forced = tables.rows_with_ids(s2, needed, "entity_id").unionByName(tables.rows_with_ids(s3, needed, "entity_id"))
    fill = max(0, size - forced.count())
    extra = [tables.rows_without_ids(tables.sample(s, n, seed=seed), needed, "entity_id") for s, n in ((s2, fill // 2), (s3, fill - fill // 2))]
    return pool_of(forced.dropDuplicates(["entity_id"]), *extra)


def pairs_of(cands: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """Candidates with both records' attributes."""
    side = lambda df, key, i: df.select(F.col("id").alias(key), *(F.col(f"norm_{c}").alias(f"norm_{c}_{i}") for c in ("name", "address", "country")))
    named = cands.withColumnsRenamed({"name_score": "tok_name_score", "blend_score": "tok_blend_score"})
    return named.join(side(s1, "q_id", 1), "q_id").join(side(pool, "pool_id", 2), "pool_id")


def compared_pairs(s1: DataFrame, pool: DataFrame, k: int = 15, use_block_scores: bool = False, cands: DataFrame | None = None) -> DataFrame:
    """(q_id, pool_id, the 13 features) of the candidates of s1 and pool, which are `records`."""
    found = candidates(s1, pool, k) if cands is None else cands
    return with_features(pairs_of(found, s1, pool), use_block_scores).select("q_id", "pool_id", *FEATURE_NAMES)


def train(s1: DataFrame, pool: DataFrame, truth_pairs: DataFrame, k: int = 15, rounds: int = 200, depth: int = 6, seed: int = 42, use_block_scores: bool = False, include_uncovered: bool = False, compared: DataFrame | None = None) -> tuple[PipelineModel | None, float, dict]:
    """Model, threshold and metrics. s1 and pool are `records`; truth_pairs: s1, pool_id. No model if the training pairs are of fewer than two classes.

    `compared`: `compared_pairs` of s1 and pool, if they are made already.
    """
    split = m.split_groups(s1, "id", seed=seed).cache()
    cands = candidates(s1, pool, k).cache() if compared is None else compared.select("q_id", "pool_id")
    rows = compared_pairs(s1, pool, k, use_block_scores, cands) if compared is None else compared
    pairs = m.labelled(rows, truth_pairs).join(split.withColumnRenamed("id", "q_id"), "q_id").cache()
    classes = pairs.where("not is_val").select("label").distinct().count()
    model = m.fit(pairs.where("not is_val"), rounds, depth, seed=seed) if classes > 1 else None
    val = m.probabilities(model, pairs.where("is_val")).withColumnRenamed("q_id", "s1")
    n_true = split.where("is_val").select(F.col("id").alias("s1")).join(truth_pairs.groupBy("s1").agg(F.count(F.lit(1)).alias("n_true")), "s1", "left").fillna(0, ["n_true"])
    best = best_threshold(threshold_sweep(val, n_true, include_uncovered)).collect()
    threshold = float(best[0]["threshold"]) if best else 0.5
    ceiling = recall_ceiling(cands, truth_pairs).first()
    metrics = {"n_train_pairs": pairs.where("not is_val").count(), "n_val_pairs": pairs.where("is_val").count(), "best_threshold": threshold, "val_macro_f05": float(best[0]["score"]) if best else 0.0, "blocking_recall_ceiling": float(ceiling["recall"])}
    return model, threshold, metrics


def link(s1: DataFrame, pool: DataFrame, model: PipelineModel | None, threshold: float, k: int = 15, use_block_scores: bool = False, index: str | None = None, compared: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(matches, candidates) of all S1 records. `index` is the folder where the pool's token index is stored and found again; `compared` as in `train`."""
    if compared is not None:
        return m.decide(m.probabilities(model, compared), s1, threshold)
    cands = candidates(s1, pool, k) if index is None else stored_index.candidates(s1, stored_index.stored(pool, index), k)
    scored = m.probabilities(model, with_features(pairs_of(cands, s1, pool), use_block_scores))
    return m.decide(scored, s1, threshold)


def resume(s1: DataFrame, done: DataFrame) -> DataFrame:
    """S1 records without a finished row (key)."""
    return s1.join(done.select(F.col("key").alias("id")).distinct(), "id", "left_anti")


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(feature, importance), one row for each of the 13 features; importances add up to 1."""
    values = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(FEATURE_NAMES, values, strict=True)], "feature string, importance double").orderBy(F.desc("importance"), "feature")


def save_bundle(spark: SparkSession, model: PipelineModel, threshold: float, metrics: dict, path: str) -> None:
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(threshold, json.dumps(metrics))], "threshold double, metrics string").coalesce(1).write.mode("overwrite").json(f"{path}/bundle")


def load_bundle(spark: SparkSession, path: str) -> tuple[PipelineModel, float]:
    row = spark.read.schema("threshold double, metrics string").json(f"{path}/bundle").first()
    return PipelineModel.load(f"{path}/model"), float(row["threshold"])
