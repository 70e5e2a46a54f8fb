"""Registered queries of the linkage engine over the driver tables, with their DuckDB counterparts.

Records are made from `documents`: the language is the country, characters 1-80 of the text the name, 81-200 the address; documents
divisible by three by id are the query side, the others the pool.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import features as feat
from tessera.functions import text as tx
from tessera.operators import blocking, cosine, index, metrics, validate
from tessera.plans import model, pipeline
from tessera.sources import tables
from tessera.sources.shared import fresh

Query = Callable[[SparkSession, str], DataFrame]


# -- frames


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")


def _source(spark: SparkSession, sf: str) -> DataFrame:
    d, k = _docs(spark, sf), F.pmod("doc_id", F.lit(3))
    return d.select(
        F.concat(F.lit("S"), (k + 1).cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"),
        F.substring("text", 1, 80).alias("business_name"), F.substring("text", 81, 120).alias("business_address"), F.col("lang").alias("country"), "doc_id",
    )


def _records(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Normalized query side and pool. The texts are in NFKC already."""
    r = pipeline.records(_source(spark, sf), compose=False)
    return r.where(F.col("id").startswith("S1-")), r.where(~F.col("id").startswith("S1-"))


def _cands(spark: SparkSession, sf: str) -> DataFrame:
    return blocking.candidates(*_records(spark, sf))


def _truth(spark: SparkSession, sf: str) -> DataFrame:
    """Equal texts of equal language across the sides."""
    d = _docs(spark, sf)
    s, key = _source(spark, sf).select("entity_id", "doc_id"), ["h", "lang"]
    rows = d.join(s, "doc_id").select("entity_id", F.md5(F.col("text")).alias("h"), "lang")
    a = rows.where(F.col("entity_id").startswith("S1-")).select(F.col("entity_id").alias("s1"), *key)
    return a.join(rows.where(~F.col("entity_id").startswith("S1-")).select(F.col("entity_id").alias("pool_id"), *key), key).select("s1", "pool_id")


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbouring documents as pairs."""
    r = tx.with_normalized(_source(spark, sf), compose=False).select("doc_id", "norm_name", "norm_address", "norm_country")
    one = r.select("doc_id", *(F.col(c).alias(f"{c}_1") for c in r.columns[1:]))
    return one.join(r.select((F.col("doc_id") - 1).alias("doc_id"), *(F.col(c).alias(f"{c}_2") for c in r.columns[1:])), "doc_id")


def _lists(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Result lists with planted faults: matches, candidates, S1 ids, pool ids."""
    s = _source(spark, sf).select(F.col("entity_id").alias("id"), "doc_id")
    s1, pool = s.where(F.col("id").startswith("S1-")), s.where(~F.col("id").startswith("S1-"))
    n, text = F.col("doc_id"), lambda p, k: F.concat(F.lit(p), (F.col("doc_id") + k).cast("string"))
    own = F.array(text("S2-", 1), text("S3-", 2))
    match = s1.where(n % 7 != 0).select(
        F.col("id").alias("key"), F.when(n % 11 == 0, F.array(text("S2-", 1), text("S2-", 1))).when(n % 13 == 0, F.array(F.col("id"))).when(n % 17 == 0, F.array(F.lit("S2-x"))).when(n % 19 == 0, F.array(text("S3-", 5))).otherwise(own).alias("ids"), n.alias("n")
    )
    match = match.union(match.where(F.col("n") % 10 == 0)).select("key", "ids").union(spark.createDataFrame([("S1-none", ["S2-1"])], "key string, ids array<string>"))
    cands = s1.select(F.col("id").alias("key"), F.array(text("S2-", 1), text("S3-", 2), text("S2-", 4)).alias("ids"))
    return match, cands, s1.select("id"), pool.select("id")


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates with a fixed score (their name score) and their label."""
    return model.labelled(_cands(spark, sf), _truth(spark, sf)).select(F.col("q_id").alias("s1"), "pool_id", F.round("name_score", 6).alias("prob"), "label")


def _n_true(spark: SparkSession, sf: str) -> DataFrame:
    return _records(spark, sf)[0].select(F.col("id").alias("s1")).join(_truth(spark, sf).groupBy("s1").agg(F.count(F.lit(1)).alias("n_true")), "s1", "left").fillna(0, ["n_true"])


# -- queries


def norm_text(spark, sf):
    return tx.with_normalized(_source(spark, sf), compose=False).select("entity_id", "norm_name", "norm_country", F.length("blend_text").alias("blend_length"))


def norm_text_nfkc(spark, sf):
    return tx.with_normalized(_source(spark, sf)).select("entity_id", "norm_name", "norm_address")


def norm_address_abbrev(spark, sf):
    return _source(spark, sf).select("entity_id", tx.normalize_address(F.concat(F.lit("Hno 5 St "), F.col("business_address")), compose=False).alias("norm_address"))


def consecutive_dedupe(spark, sf):
    doubled = F.concat_ws(" ", F.col("business_name"), F.regexp_extract("business_name", r"(\S+)\s*$", 1))
    return _source(spark, sf).select("entity_id", F.array_join(tx.consecutive_distinct(tx.word_tokens(doubled)), " ").alias("deduped"))


def country_slugs(spark, sf):
    return spark.read.parquet(f"{sf}/nation.parquet").select("n_nationkey", tx.country_slug(F.concat(F.lit(" "), F.col("n_name"), F.lit("-x"))).alias("slug"))


def country_partition_counts(spark, sf):
    return _source(spark, sf).groupBy(F.substring("entity_id", 1, 2).alias("source"), tx.country_slug(F.col("country")).alias("slug")).agg(F.count(F.lit(1)).alias("n"))


def _pool_tokens(spark, sf):
    pool = _records(spark, sf)[1]
    return pool, blocking.explode_tokens(pool, tx.word_tokens(F.col("norm_name")), ["id", "country"])


def token_df(spark, sf):
    return blocking.document_frequency(_pool_tokens(spark, sf)[1])


def df_prune(spark, sf):
    return blocking.kept_tokens(*_pool_tokens(spark, sf)).select("country", "token", "df")


def token_idf(spark, sf):
    return blocking.kept_tokens(*_pool_tokens(spark, sf)).select("country", "token", F.round("idf", 6).alias("idf"))


def posting_cap(spark, sf):
    pool, tokens = _pool_tokens(spark, sf)
    return blocking.postings(tokens, blocking.kept_tokens(pool, tokens), 5).select("country", "token", "id")


def _view(spark, sf, tokens):
    return blocking.block_view(*_records(spark, sf), tokens).select("q_id", "pool_id", F.round("score", 6).alias("score"), "rank")


def block_name_topk(spark, sf):
    return _view(spark, sf, tx.word_tokens(F.col("norm_name")))


def block_blend_topk(spark, sf):
    return _view(spark, sf, tx.blocking_tokens(F.col("norm_name"), F.col("norm_address")))


def block_two_view_merge(spark, sf):
    return _cands(spark, sf).select("q_id", "pool_id", F.round("name_score", 6).alias("name_score"), F.round("blend_score", 6).alias("blend_score"))


def tfidf_cosine_topk(spark, sf):
    return cosine.cosine_top_k(*_records(spark, sf), "norm_name").select("q_id", "pool_id", F.round("score", 6).alias("score"), "rank")


def tfidf_cosine_pool_fit(spark, sf):
    return cosine.cosine_top_k(*_records(spark, sf), "norm_name", fit_on_pool=True).select("q_id", "pool_id", F.round("score", 6).alias("score"), "rank")


def cosine_two_views(spark, sf):
    q, pool = _records(spark, sf)
    found = cosine.by_query(q, cosine.cosine_candidates(q, pool))
    part = lambda f: F.array_join(F.transform("candidates", f), ",")
    return found.select("q_id", F.size("candidates").alias("n"), part(lambda c: c["pool_id"]).alias("pool_ids"), part(lambda c: F.when(c["name_score"] == 0, "b").when(c["blend_score"] == 0, "n").otherwise("nb")).alias("views"))


def stored_index_candidates(spark, sf):
    """Two-view candidates from an index that was stored and found again."""
    q, pool = _records(spark, sf)
    place = fresh(spark, "index")
    index.stored(pool, place)
    return index.candidates(q, index.stored(pool, place)).select("q_id", "pool_id", F.round("name_score", 6).alias("name_score"), F.round("blend_score", 6).alias("blend_score"))


def pair_vector(spark, sf):
    """All 13 features of every candidate pair."""
    r = _records(spark, sf)
    pairs = feat.with_features(pipeline.pairs_of(blocking.candidates(*r), *r))
    return pairs.select("q_id", "pool_id", *(F.round(c, 6).alias(c) for c in feat.FEATURE_NAMES))


def training_pool(spark, sf):
    """The pool of a sample of 100 query records, filled up to 300."""
    s = _source(spark, sf)
    s1 = tables.sample(s.where(F.col("entity_id").startswith("S1-")), 100)
    truth = _truth(spark, sf).join(s1.select(F.col("entity_id").alias("s1")), "s1", "left_semi")
    side = lambda p: s.where(F.col("entity_id").startswith(p)).drop("doc_id")
    return pipeline.training_pool(side("S2-"), side("S3-"), truth, 300).select("entity_id", "country")


def _issues_of_files(spark, sf):
    """The planted faults written as result files, candidates under a wrong header, and read again."""
    m, c, s1, pool = _lists(spark, sf)
    place = fresh(spark, "files")
    tables.write_id_lists(m, f"{place}/m", *validate.HEADERS["matches"])
    tables.write_id_lists(c, f"{place}/c", "key", "ids")
    entity = lambda rows: rows.withColumnRenamed("id", "entity_id")
    return validate.validate_files(spark, f"{place}/m", f"{place}/c", entity(s1), entity(pool), entity(pool))


def validate_files(spark, sf):
    return _issues_of_files(spark, sf).groupBy("file", "rule").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("least_key"))


def validate_report(spark, sf):
    return validate.report(validate.validate(*_lists(spark, sf))).groupBy("file", "rule").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("least_key"))


def validate_verdict(spark, sf):
    return validate.verdict(validate.validate(*_lists(spark, sf)))


def _pair_query(*columns):
    return lambda spark, sf: feat.with_features(_pairs(spark, sf)).select("doc_id", *(F.round(c, 9).alias(c) for c in columns))


def recall_ceiling(spark, sf):
    return metrics.recall_ceiling(_cands(spark, sf), _truth(spark, sf)).select("n_true", "n_found", F.round("recall", 9).alias("recall"))


def macro_f05(spark, sf):
    best = _scored(spark, sf).where("prob >= 0.9").groupBy("s1").agg(F.collect_set("pool_id").alias("ids"))
    q = _records(spark, sf)[0].select(F.col("id").alias("s1"))
    truth = q.join(_truth(spark, sf).groupBy("s1").agg(F.collect_set("pool_id").alias("ids")), "s1", "left").withColumn("ids", F.coalesce("ids", F.array().cast("array<string>")))
    return metrics.macro_f(best, truth).select(F.round("macro_f", 9).alias("macro_f"), "n")


def threshold_sweep(spark, sf):
    return metrics.threshold_sweep(_scored(spark, sf), _n_true(spark, sf)).select("i", F.round("score", 9).alias("score"), "n")


def best_threshold(spark, sf):
    return metrics.best_threshold(metrics.threshold_sweep(_scored(spark, sf), _n_true(spark, sf))).select("i", F.round("score", 9).alias("score"))


def singleton_rate(spark, sf):
    q = _records(spark, sf)[0].select(F.col("id").alias("q_id"))
    hit = _cands(spark, sf).where("blend_score >= 0.5").select("q_id").distinct().withColumn("hit", F.lit(1))
    return q.join(hit, "q_id", "left").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("hit").isNull(), 1).otherwise(0)).alias("singletons"))


def semi_filter_ids(spark, sf):
    return tables.rows_with_ids(_docs(spark, sf), spark.read.parquet(f"{sf}/labels.parquet").where("toxic = 0"), "doc_id").select("doc_id", "lang")


def anti_resume(spark, sf):
    return tables.rows_without_ids(_docs(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("doc_id", "lang")


def pool_union_dedup(spark, sf):
    a = _source(spark, sf).where("doc_id % 3 > 0").withColumn("entity_id", F.concat(F.lit("P-"), (F.col("doc_id") % 100).cast("string")))
    b = a.withColumn("country", F.upper("country"))
    one = blocking.first_by_id(a, "doc_id", "entity_id").drop("doc_id")
    return pipeline.pool_of(one, b.where("doc_id % 7 = 0 or doc_id % 100 < 3").groupBy("entity_id").agg(F.min("business_name").alias("business_name"), F.min("business_address").alias("business_address"), F.min("country").alias("country"))).select("entity_id", "country")


def group_split(spark, sf):
    return model.split_groups(_docs(spark, sf), "doc_id").select("doc_id", "is_val")


def hash_sample(spark, sf):
    return tables.sample(_docs(spark, sf), 100, "doc_id").select("doc_id", "lang")


def idlist_parse_roundtrip(spark, sf):
    joined = F.concat_ws(",", F.col("doc_id").cast("string"), F.lit(""), F.col("lang"), F.lit(""))
    ids = tx.parse_ids(joined)
    return _docs(spark, sf).select("doc_id", F.size(ids).alias("n"), tx.format_ids(ids).alias("ids"))


def label_counts(spark, sf):
    return _scored(spark, sf).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("s1").alias("entities"))


def match_lists(spark, sf):
    s = _scored(spark, sf).withColumnRenamed("s1", "q_id")
    m, c = model.decide(s, _records(spark, sf)[0], 0.5)
    return m.select("key", tx.format_ids(F.col("ids")).alias("matched")).join(c.select("key", tx.format_ids(F.col("ids")).alias("candidates")), "key")


def _rule(part):
    return lambda spark, sf: part(*_lists(spark, sf)).groupBy("file", "rule").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("least_key"))


validate_duplicates = _rule(lambda m, c, s, p: validate.duplicate_keys(m, "matches").unionByName(validate.repeated_ids(m, "matches")))
validate_unknown_ids = _rule(lambda m, c, s, p: validate.unknown_keys(m, s, "matches").unionByName(validate.unknown_ids(m, p, "matches", "S1-")).unionByName(validate.self_matches(m, "matches")))
validate_subset = _rule(lambda m, c, s, p: validate.not_candidates(m, c))
validate_all = _rule(validate.validate)


def validate_missing(spark, sf):
    m, _, s, _ = _lists(spark, sf)
    return validate.missing_keys(m, s, "matches").select("rule", F.col("key").alias("n"), "detail")


def gbt_link(spark, sf):
    """Training and linking end to end on perturbed copies whose truth is known, with the operator's own rounds and depth."""
    s = _source(spark, sf)
    n = F.col("doc_id")
    make = lambda rows, p, name: rows.select(F.concat(F.lit(p), n.cast("string")).alias("entity_id"), name.alias("business_name"), "business_address", "country")
    s1 = pipeline.records(make(s, "S1-", F.col("business_name")))
    s2 = make(s.where("doc_id % 5 in (0, 1, 2)"), "S2-", F.concat(F.lit("LLC "), F.upper("business_name")))
    s3 = make(s.where("doc_id % 5 in (2, 3)"), "S3-", F.concat(F.expr("substring(business_name, 13)"), F.lit(" Ltd")))
    pool = pipeline.records(pipeline.pool_of(s2, s3))
    truth = pool.select(F.concat(F.lit("S1-"), F.substring_index("id", "-", -1)).alias("s1"), F.col("id").alias("pool_id"))
    s1, pool = s1.cache(), pool.cache()
    # Training and linking meet the same pairs: compared once, and written.
    place = fresh(spark, "pairs")
    made = pipeline.compared_pairs(s1, pool)
    made.write.parquet(place)
    compared = spark.read.schema(made.schema).parquet(place)
    fitted, threshold, _ = pipeline.train(s1, pool, truth, compared=compared)
    matches, _ = pipeline.link(s1, pool, fitted, threshold, compared=compared)
    return matches.select("key", tx.format_ids(F.col("ids")).alias("matched"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        norm_text, norm_text_nfkc, norm_address_abbrev, consecutive_dedupe, country_slugs, country_partition_counts, token_df, df_prune, token_idf, posting_cap, block_name_topk, block_blend_topk,
        block_two_view_merge, tfidf_cosine_topk, tfidf_cosine_pool_fit, recall_ceiling, macro_f05, threshold_sweep, best_threshold, singleton_rate, semi_filter_ids, anti_resume, pool_union_dedup, group_split,
        hash_sample, idlist_parse_roundtrip, label_counts, match_lists, validate_missing, gbt_link,
        cosine_two_views, stored_index_candidates, pair_vector, training_pool, validate_files, validate_report, validate_verdict,
    )
} | {
    "pair_token_jaccard": _pair_query("name_tok_jaccard", "addr_tok_jaccard"),
    "pair_char3_jaccard": _pair_query("name_char_jaccard", "addr_char_jaccard"),
    "pair_seq_ratio": _pair_query("name_seq_ratio", "addr_seq_ratio"),
    "pair_len_diff": _pair_query("name_len_diff", "addr_len_diff"),
    "pair_flags": _pair_query("name_substr", "first_tok_match", "country_match"),
    "validate_duplicates": validate_duplicates,
    "validate_unknown_ids": validate_unknown_ids,
    "validate_subset": validate_subset,
    "validate_all": validate_all,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


# -- DuckDB


def _blank(x: str) -> str:
    return rf"regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}_\s&]', ' ', 'g')"


def _tokens(x: str) -> str:
    return rf"list_filter(regexp_split_to_array({x}, '\s+'), lambda t: t <> '')"


def _dedupe(x: str) -> str:
    return f"list_filter({x}, lambda z, i: i = 1 or z <> ({x})[i - 1])"


_SUFFIX = r"'(?i)\.(com|in|co|org|net|fr)($|[^\p{L}\p{N}_])', '\2', 'g'"


def _name(x: str) -> str:
    s = rf"regexp_replace(regexp_replace({x}, '\|\s*www\.\S+$', ''), '^[\-#<>|*.\s]+', '')"
    s = f"regexp_replace(regexp_replace(replace({s}, '&', ' and '), {_SUFFIX}), {_SUFFIX})"
    s = f"replace(replace(' ' || {_blank(s)} || ' ', ' l l c ', ' '), ' l l p ', ' ')"
    forms = ", ".join(f"'{f}'" for f in tx.LEGAL_FORMS if " " not in f)
    return f"list_filter({_tokens(s)}, lambda t: t not in ({forms}))"


def _address(x: str) -> str:
    s = rf"{_blank(rf"regexp_replace({x}, '^[\-#<>|*.\s]+', '')")}"
    cases = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in tx.ABBREVIATIONS.items())
    return f"list_transform({_tokens(s)}, lambda t: CASE t {cases} ELSE t END)"


_SRC = "src AS (SELECT 'S' || (doc_id % 3 + 1) || '-' || doc_id AS entity_id, substring(text, 1, 80) AS name, substring(text, 81, 120) AS addr, lang AS country, doc_id, text FROM documents)"
_REC = f"""{_SRC}, r0 AS (SELECT entity_id AS id, doc_id, lower(country) AS country, {_name("name")} AS nt0, {_address("addr")} AS at0 FROM src),
rec AS (SELECT id, doc_id, country, {_dedupe("nt0")} AS nt, {_dedupe("at0")} AS at, array_to_string({_dedupe("nt0")}, ' ') AS norm_name, array_to_string({_dedupe("at0")}, ' ') AS norm_address FROM r0),
q AS (SELECT * FROM rec WHERE id LIKE 'S1-%'), pool AS (SELECT * FROM rec WHERE id NOT LIKE 'S1-%'),
sizes AS (SELECT country, count(*) AS n FROM pool GROUP BY country)"""


def _index(v: str, toks: str, cap: int = 900) -> str:
    return f"""{v}_pt AS (SELECT country, id, unnest(list_distinct({toks})) AS token FROM pool), {v}_qt AS (SELECT country, id, unnest(list_distinct({toks})) AS token FROM q),
{v}_df AS (SELECT country, token, count(*) AS df FROM {v}_pt GROUP BY ALL),
{v}_keep AS (SELECT country, token, df, ln(1 + n / (1.0::DOUBLE + df)) AS idf FROM {v}_df JOIN sizes USING (country) WHERE df <= greatest(20, floor(0.003 * n)::INT)),
{v}_post AS (SELECT country, token, idf, id FROM {v}_pt JOIN {v}_keep USING (country, token) QUALIFY row_number() OVER (PARTITION BY country, token ORDER BY id) <= {cap}),
{v}_raw AS (SELECT a.id AS q_id, p.id AS pool_id, sum(idf) AS raw FROM {v}_qt a JOIN {v}_post p USING (country, token) GROUP BY ALL),
{v}_whole AS (SELECT a.id AS q_id, sum(idf) AS whole FROM {v}_qt a JOIN {v}_keep USING (country, token) GROUP BY ALL),
{v} AS (SELECT q_id, pool_id, raw / whole AS score, row_number() OVER (PARTITION BY q_id ORDER BY round(raw, 9) DESC, pool_id) AS rank FROM {v}_raw JOIN {v}_whole USING (q_id) QUALIFY rank <= 15)"""


_TWO = f"""{_REC}, {_index("nv", "nt")}, {_index("bv", "list_concat(nt, list_filter(string_split(norm_address, ' '), lambda t: t <> ''))")},
cands AS (SELECT coalesce(a.q_id, b.q_id) AS q_id, coalesce(a.pool_id, b.pool_id) AS pool_id, coalesce(a.score, 0) AS name_score, coalesce(b.score, 0) AS blend_score
  FROM nv a FULL JOIN bv b ON a.q_id = b.q_id AND a.pool_id = b.pool_id),
truth AS (SELECT a.entity_id AS s1, b.entity_id AS pool_id FROM src a JOIN src b ON a.text = b.text AND a.country = b.country WHERE a.entity_id LIKE 'S1-%' AND b.entity_id NOT LIKE 'S1-%'),
scored AS (SELECT q_id AS s1, c.pool_id, round(name_score, 6) AS prob, CASE WHEN t.s1 IS NULL THEN 0 ELSE 1 END AS label FROM cands c LEFT JOIN truth t ON t.s1 = q_id AND t.pool_id = c.pool_id),
ntrue AS (SELECT id AS s1, count(t.s1) AS n_true FROM q LEFT JOIN truth t ON t.s1 = id GROUP BY id)"""

_F = "CASE WHEN np = 0 AND n_true = 0 THEN 1.0 WHEN np = 0 OR n_true = 0 OR tp = 0 THEN 0.0 ELSE 1.25 * (tp / np) * (tp / n_true) / (0.25 * (tp / np) + tp / n_true) END"
_SWEEP = f"""{_TWO}, ents AS (SELECT * FROM ntrue WHERE s1 IN (SELECT s1 FROM scored)), grid AS (SELECT unnest(range(37))::INT AS i),
cells AS (SELECT e.s1, n_true::DOUBLE AS n_true, i, coalesce(sum(label), 0)::DOUBLE AS tp, count(s.s1)::DOUBLE AS np
  FROM ents e CROSS JOIN grid LEFT JOIN scored s ON s.s1 = e.s1 AND floor((prob - 0.05::DOUBLE) / 0.025::DOUBLE + 1e-9) >= i GROUP BY ALL),
swept AS (SELECT i, avg({_F}) AS score, count(*) AS n FROM cells GROUP BY i)"""

_PAIRS = f"{_REC}, p AS (SELECT a.doc_id, a.norm_name AS n1, b.norm_name AS n2, a.norm_address AS a1, b.norm_address AS a2, a.country AS c1, b.country AS c2 FROM rec a JOIN rec b ON b.doc_id = a.doc_id + 1)"


def _jaccard(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) = 0 AND len({b}) = 0 THEN 1.0 ELSE len(list_intersect({a}, {b}))::DOUBLE / len(list_distinct(list_concat({a}, {b}))) END"


def _set(x: str) -> str:
    return f"list_distinct(list_filter(string_split({x}, ' '), lambda t: t <> ''))"


def _grams(x: str) -> str:
    s = f"replace({x}, ' ', '')"
    return f"(CASE WHEN {s} = '' THEN []::VARCHAR[] ELSE list_distinct(list_transform(range(1, greatest(length({s}) - 2, 1) + 1), lambda i: substring({s}, i::BIGINT, 3))) END)"


def _ratio(a: str, b: str) -> str:
    common = f"list_sum(list_transform(list_distinct(string_split({a}, '')), lambda c: least(length({a}) - length(replace({a}, c, '')), length({b}) - length(replace({b}, c, '')))))"
    return f"CASE WHEN {a} = '' AND {b} = '' THEN 1.0 WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE 2.0 * {common} / (length({a}) + length({b})) END"


def _lendiff(a: str, b: str) -> str:
    return f"abs(length({a}) - length({b}))::DOUBLE / greatest(length({a}), length({b}), 1)"


def _two(kind, name: str, addr: str) -> str:
    return f"WITH {_PAIRS} SELECT doc_id, round({kind('n1', 'n2')}, 9) AS {name}, round({kind('a1', 'a2')}, 9) AS {addr} FROM p"


def _cosine_view(v: str, toks: str, fit: str) -> str:
    word = "list_concat(list_transform(range(1, greatest(length(w) - 1, 1) + 1), lambda i: substring(w, i::BIGINT, 2)), CASE WHEN length(w) > 2 THEN list_transform(range(1, greatest(length(w) - 2, 1) + 1), lambda i: substring(w, i::BIGINT, 3)) ELSE [] END, CASE WHEN length(w) > 3 THEN list_transform(range(1, greatest(length(w) - 3, 1) + 1), lambda i: substring(w, i::BIGINT, 4)) ELSE [] END)"
    return f"""{v}words AS (SELECT country, id, ' ' || unnest({toks}) || ' ' AS w FROM rec), {v}g AS (SELECT country, id, unnest({word}) AS gram FROM {v}words),
{v}tf AS (SELECT country, id, gram, count(*) AS tf FROM {v}g GROUP BY ALL), {v}fitted AS (SELECT * FROM {fit}), {v}fn AS (SELECT country, count(*) AS n FROM {v}fitted GROUP BY country),
{v}voc AS (SELECT country, gram, ln((1 + n) / (1.0::DOUBLE + df)) + 1 AS idf FROM (SELECT * FROM (SELECT country, gram, sum(tf) AS total, count(*) AS df FROM {v}tf WHERE id IN (SELECT id FROM {v}fitted) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY country ORDER BY total DESC, gram) <= 60000) JOIN {v}fn USING (country)),
{v}w AS (SELECT country, id, gram, tf * idf AS w FROM {v}tf JOIN {v}voc USING (country, gram)), {v}nm AS (SELECT id, sqrt(sum(w * w)) AS nm FROM {v}w GROUP BY id), {v}u AS (SELECT country, id, gram, w / nm AS w FROM {v}w JOIN {v}nm USING (id)),
{v}s AS (SELECT a.id AS q_id, b.id AS pool_id, sum(a.w * b.w) AS score FROM {v}u a JOIN {v}u b USING (country, gram) WHERE a.id LIKE 'S1-%' AND b.id NOT LIKE 'S1-%' GROUP BY ALL),
{v}t AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY round(score, 9) DESC, pool_id) AS rank FROM {v}s QUALIFY rank <= 15),
{v}top AS (SELECT q_id, pool_id, score, rank FROM {v}t WHERE round(score, 9) >= 0.12)"""


def _cosine(pool_only: bool) -> str:
    return f"WITH {_REC}, {_cosine_view('', 'nt', 'pool' if pool_only else 'rec')} SELECT q_id, pool_id, round(score, 6) AS score, rank FROM top"


_BLEND = "list_concat(nt, list_filter(string_split(norm_address, ' '), lambda t: t <> ''))"
_COSINE_VIEWS = f"""WITH {_REC}, {_cosine_view("nc", "nt", "rec")}, {_cosine_view("bc", _BLEND, "rec")},
m AS (SELECT coalesce(x.q_id, y.q_id) AS q_id, coalesce(x.pool_id, y.pool_id) AS pool_id, CASE WHEN x.q_id IS NULL THEN 'b' WHEN y.q_id IS NULL THEN 'n' ELSE 'nb' END AS view FROM nctop x FULL JOIN bctop y ON x.q_id = y.q_id AND x.pool_id = y.pool_id)
SELECT id AS q_id, count(pool_id)::INT AS n, coalesce(string_agg(pool_id, ',' ORDER BY pool_id), '') AS pool_ids, coalesce(string_agg(view, ',' ORDER BY pool_id), '') AS views FROM q LEFT JOIN m ON q_id = id GROUP BY id"""


_LISTS = f"""{_SRC}, s1 AS (SELECT entity_id AS id, doc_id AS n FROM src WHERE entity_id LIKE 'S1-%'), pl AS (SELECT entity_id AS id FROM src WHERE entity_id NOT LIKE 'S1-%'),
m0 AS (SELECT id AS key, n, CASE WHEN n % 11 = 0 THEN ['S2-' || (n + 1), 'S2-' || (n + 1)] WHEN n % 13 = 0 THEN [id] WHEN n % 17 = 0 THEN ['S2-x'] WHEN n % 19 = 0 THEN ['S3-' || (n + 5)] ELSE ['S2-' || (n + 1), 'S3-' || (n + 2)] END AS ids FROM s1 WHERE n % 7 <> 0),
m AS (SELECT key, ids FROM m0 UNION ALL SELECT key, ids FROM m0 WHERE n % 10 = 0 UNION ALL SELECT 'S1-none', ['S2-1']),
c AS (SELECT id AS key, ['S2-' || (n + 1), 'S3-' || (n + 2), 'S2-' || (n + 4)] AS ids FROM s1),
ml AS (SELECT key, unnest(ids) AS id FROM m), cl AS (SELECT key, unnest(ids) AS id FROM c)"""


def _dups(t: str, f: str) -> str:
    return f"SELECT '{f}' AS file, 'duplicate_key' AS rule, key FROM (SELECT key, unnest(range(count(*) - 1)) FROM {t} GROUP BY key) UNION ALL SELECT '{f}', 'repeated_id', key FROM {t} WHERE len(ids) <> len(list_distinct(ids))"


def _unknown(t: str, lst: str, f: str, selfs: bool) -> str:
    out = f"SELECT '{f}' AS file, 'unknown_key' AS rule, key FROM {t} WHERE key NOT IN (SELECT id FROM s1) UNION ALL SELECT '{f}', 'unknown_id', key FROM {lst} WHERE id NOT IN (SELECT id FROM pl)" + (" AND id NOT LIKE 'S1-%'" if selfs else "")
    return out + (f" UNION ALL SELECT '{f}', 'self_match', key FROM {lst} WHERE id LIKE 'S1-%'" if selfs else "")


_SUBSET = "SELECT DISTINCT 'matches' AS file, 'not_candidate' AS rule, key FROM (SELECT key, id FROM ml EXCEPT SELECT key, id FROM cl)"
_LOST = "SELECT '{f}' AS file, 'missing_key' AS rule, count(*)::VARCHAR AS key FROM s1 WHERE id NOT IN (SELECT key FROM {t}) HAVING count(*) > 0"


def _grouped(body: str) -> str:
    return f"WITH {_LISTS}, issues AS ({body}) SELECT file, rule, count(*) AS n, min(key) AS least_key FROM issues GROUP BY file, rule"


def _all_issues() -> str:
    return " UNION ALL ".join([_dups("m", "matches"), _dups("c", "candidates"), _unknown("m", "ml", "matches", True), _unknown("c", "cl", "candidates", False), _SUBSET, _LOST.format(f="matches", t="m"), _LOST.format(f="candidates", t="c")])


_VERDICT = "SELECT count(*) - count(*) FILTER (rule = 'not_candidate') + least(count(*) FILTER (rule = 'not_candidate'), 5) + CASE WHEN count(*) FILTER (rule = 'not_candidate') > 5 THEN 1 ELSE 0 END AS n_issues FROM issues"
_REPORT = """SELECT file, rule, key FROM issues WHERE rule <> 'not_candidate' UNION ALL SELECT * FROM (SELECT file, rule, key FROM issues WHERE rule = 'not_candidate' ORDER BY key LIMIT 5)
UNION ALL SELECT 'matches', 'not_candidate_rest', (count(*) - 5)::VARCHAR FROM issues WHERE rule = 'not_candidate' HAVING count(*) > 5"""


def _hashed(c: str) -> str:
    return f"md5({c} || '#42')"


_VECTOR = f"""WITH {_TWO}, p AS (SELECT c.*, a.norm_name AS n1, b.norm_name AS n2, a.norm_address AS a1, b.norm_address AS a2, a.country AS c1, b.country AS c2 FROM cands c JOIN rec a ON a.id = c.q_id JOIN rec b ON b.id = c.pool_id)
SELECT q_id, pool_id, round({_jaccard(_set("n1"), _set("n2"))}, 6) AS name_tok_jaccard, round({_jaccard(_set("a1"), _set("a2"))}, 6) AS addr_tok_jaccard, round({_jaccard(_grams("n1"), _grams("n2"))}, 6) AS name_char_jaccard,
  round({_jaccard(_grams("a1"), _grams("a2"))}, 6) AS addr_char_jaccard, round({_ratio("n1", "n2")}, 6) AS name_seq_ratio, round({_ratio("a1", "a2")}, 6) AS addr_seq_ratio, round({_lendiff("n1", "n2")}, 6) AS name_len_diff, round({_lendiff("a1", "a2")}, 6) AS addr_len_diff,
  (n1 <> '' AND n2 <> '' AND (contains(n1, n2) OR contains(n2, n1)))::INT::DOUBLE AS name_substr, (n1 <> '' AND n2 <> '' AND split_part(n1, ' ', 1) = split_part(n2, ' ', 1))::INT::DOUBLE AS first_tok_match, (c1 = c2 AND c1 <> '')::INT::DOUBLE AS country_match,
  round(name_score, 6) AS tok_name_score, round(blend_score, 6) AS tok_blend_score FROM p"""


def oracle_sql() -> dict[str, str]:
    named = f"{_REC}, {_index('nv', 'nt')}"
    return {
        "norm_text": f"WITH {_REC} SELECT id AS entity_id, norm_name, country AS norm_country, length(trim(CASE WHEN norm_name = '' THEN norm_address ELSE norm_name || ' ' || norm_address END))::INT AS blend_length FROM rec",
        "norm_text_nfkc": f"WITH {_REC} SELECT id AS entity_id, norm_name, norm_address FROM rec",
        "norm_address_abbrev": f"WITH {_SRC}, a AS (SELECT entity_id, {_address("('Hno 5 St ' || addr)")} AS t FROM src) SELECT entity_id, array_to_string({_dedupe('t')}, ' ') AS norm_address FROM a",
        "consecutive_dedupe": f"WITH {_SRC}, a AS (SELECT entity_id, {_tokens(r"(name || ' ' || regexp_extract(name, '(\S+)\s*$', 1))")} AS t FROM src) SELECT entity_id, array_to_string({_dedupe('t')}, ' ') AS deduped FROM a",
        "country_slugs": "SELECT n_nationkey, regexp_replace(lower(trim(' ' || n_name || '-x')), '[^a-z0-9]+', '_', 'g') AS slug FROM nation",
        "country_partition_counts": f"WITH {_SRC} SELECT entity_id[1:2] AS source, regexp_replace(lower(trim(country)), '[^a-z0-9]+', '_', 'g') AS slug, count(*) AS n FROM src GROUP BY ALL",
        "token_df": f"WITH {named} SELECT country, token, df FROM nv_df",
        "df_prune": f"WITH {named} SELECT country, token, df FROM nv_keep",
        "token_idf": f"WITH {named} SELECT country, token, round(idf, 6) AS idf FROM nv_keep",
        "posting_cap": f"WITH {_REC}, {_index('nv', 'nt', 5)} SELECT country, token, id FROM nv_post",
        "block_name_topk": f"WITH {named} SELECT q_id, pool_id, round(score, 6) AS score, rank FROM nv",
        "block_blend_topk": f"WITH {_TWO} SELECT q_id, pool_id, round(score, 6) AS score, rank FROM bv",
        "block_two_view_merge": f"WITH {_TWO} SELECT q_id, pool_id, round(name_score, 6) AS name_score, round(blend_score, 6) AS blend_score FROM cands",
        "tfidf_cosine_topk": _cosine(False),
        "tfidf_cosine_pool_fit": _cosine(True),
        "recall_ceiling": f"WITH {_TWO} SELECT count(*) AS n_true, count(c.q_id) AS n_found, CASE WHEN count(*) = 0 THEN 1.0 ELSE round(count(c.q_id)::DOUBLE / count(*), 9) END AS recall FROM truth t LEFT JOIN cands c ON c.q_id = t.s1 AND c.pool_id = t.pool_id",
        "macro_f05": f"WITH {_TWO}, e AS (SELECT n.s1, n_true::DOUBLE AS n_true, count(s.s1)::DOUBLE AS np, coalesce(sum(label), 0)::DOUBLE AS tp FROM ntrue n LEFT JOIN scored s ON s.s1 = n.s1 AND prob >= 0.9 GROUP BY ALL) SELECT round(avg({_F}), 9) AS macro_f, count(*) AS n FROM e",
        "threshold_sweep": f"WITH {_SWEEP} SELECT i, round(score, 9) AS score, n FROM swept",
        "best_threshold": f"WITH {_SWEEP} SELECT i, round(score, 9) AS score FROM swept ORDER BY round(score, 12) DESC, i LIMIT 1",
        "singleton_rate": f"WITH {_TWO} SELECT count(*) AS n, count(*) FILTER (WHERE id NOT IN (SELECT q_id FROM cands WHERE blend_score >= 0.5)) AS singletons FROM q",
        "semi_filter_ids": "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 0)",
        "anti_resume": "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
        "pool_union_dedup": "WITH a AS (SELECT 'P-' || (doc_id % 100) AS entity_id, lang AS country, doc_id FROM documents WHERE doc_id % 3 > 0), one AS (SELECT entity_id, country FROM a QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY doc_id) = 1), b AS (SELECT entity_id, min(upper(country)) AS country FROM a WHERE doc_id % 7 = 0 OR doc_id % 100 < 3 GROUP BY entity_id) SELECT * FROM one UNION ALL SELECT * FROM b WHERE entity_id NOT IN (SELECT entity_id FROM one)",
        "group_split": f"SELECT doc_id, row_number() OVER (ORDER BY {_hashed('doc_id')}, doc_id) <= greatest(1, floor(0.2 * count(*) OVER ())) AS is_val FROM (SELECT DISTINCT doc_id FROM documents)",
        "hash_sample": f"SELECT doc_id, lang FROM documents ORDER BY {_hashed('doc_id')}, doc_id LIMIT 100",
        "idlist_parse_roundtrip": "SELECT doc_id, 2 AS n, array_to_string(list_sort([doc_id::VARCHAR, lang]), ',') AS ids FROM documents",
        "label_counts": f"WITH {_TWO} SELECT label, count(*) AS n, count(DISTINCT s1) AS entities FROM scored GROUP BY label",
        "match_lists": f"WITH {_TWO} SELECT id AS key, coalesce(array_to_string(list_sort(list(DISTINCT pool_id) FILTER (WHERE prob >= 0.5)), ','), '') AS matched, coalesce(array_to_string(list_sort(list(DISTINCT pool_id) FILTER (WHERE pool_id IS NOT NULL)), ','), '') AS candidates FROM q LEFT JOIN scored ON s1 = id GROUP BY id",
        "validate_missing": f"WITH {_LISTS}, lost AS (SELECT id FROM s1 WHERE id NOT IN (SELECT key FROM m)) SELECT 'missing_key' AS rule, count(*)::VARCHAR AS n, (SELECT string_agg(id, ',' ORDER BY id) FROM (SELECT id FROM lost ORDER BY id LIMIT 5)) AS detail FROM lost HAVING count(*) > 0",
        "validate_duplicates": _grouped(_dups("m", "matches")),
        "validate_unknown_ids": _grouped(_unknown("m", "ml", "matches", True)),
        "validate_subset": _grouped(_SUBSET),
        "validate_all": _grouped(_all_issues()),
        "validate_files": _grouped(f"{_all_issues()} UNION ALL SELECT 'candidates', 'header', 'key' || chr(9) || 'ids'"),
        "validate_report": f"WITH {_LISTS}, issues AS ({_all_issues()}), report AS ({_REPORT}) SELECT file, rule, count(*) AS n, min(key) AS least_key FROM report GROUP BY file, rule",
        "validate_verdict": f"WITH {_LISTS}, issues AS ({_all_issues()}), v AS ({_VERDICT}) SELECT n_issues, n_issues = 0 AS passed FROM v",
        "cosine_two_views": _COSINE_VIEWS,
        "stored_index_candidates": f"WITH {_TWO} SELECT q_id, pool_id, round(name_score, 6) AS name_score, round(blend_score, 6) AS blend_score FROM cands",
        "pair_vector": _VECTOR,
        "training_pool": f"""WITH {_SRC}, s1 AS (SELECT * FROM src WHERE entity_id LIKE 'S1-%' ORDER BY {_hashed("entity_id")}, entity_id LIMIT 100),
needed AS (SELECT DISTINCT b.entity_id FROM s1 a JOIN src b ON a.text = b.text AND a.country = b.country WHERE b.entity_id NOT LIKE 'S1-%'), fill AS (SELECT greatest(0, 300 - count(*)) AS n FROM needed),
extra AS (SELECT entity_id, row_number() OVER (PARTITION BY entity_id[1:2] ORDER BY {_hashed("entity_id")}, entity_id) AS r FROM src WHERE entity_id NOT LIKE 'S1-%')
SELECT entity_id, country FROM src WHERE entity_id IN (SELECT entity_id FROM needed) OR entity_id IN (SELECT entity_id FROM extra, fill WHERE r <= CASE WHEN entity_id LIKE 'S2-%' THEN n // 2 ELSE n - n // 2 END)""",
        "pair_token_jaccard": _two(lambda a, b: _jaccard(_set(a), _set(b)), "name_tok_jaccard", "addr_tok_jaccard"),
        "pair_char3_jaccard": _two(lambda a, b: _jaccard(_grams(a), _grams(b)), "name_char_jaccard", "addr_char_jaccard"),
        "pair_seq_ratio": _two(_ratio, "name_seq_ratio", "addr_seq_ratio"),
        "pair_len_diff": _two(_lendiff, "name_len_diff", "addr_len_diff"),
        "pair_flags": f"WITH {_PAIRS} SELECT doc_id, (n1 <> '' AND n2 <> '' AND (contains(n1, n2) OR contains(n2, n1)))::INT::DOUBLE AS name_substr, (n1 <> '' AND n2 <> '' AND split_part(n1, ' ', 1) = split_part(n2, ' ', 1))::INT::DOUBLE AS first_tok_match, (c1 = c2 AND c1 <> '')::INT::DOUBLE AS country_match FROM p",
    }
