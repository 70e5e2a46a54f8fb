"""Programs from files to files, the stored index, the training pool, streaming and degenerate training sets."""

import pytest
from pyspark.sql import functions as F

from tessera import programs
from tessera.functions import features as feat
from tessera.operators import blocking, cosine, index, validate
from tessera.plans import model, pipeline
from tessera.sources import tables
from tessera.streaming.link import stream_links

WORDS = ["amber", "birch", "cedar", "delta", "ember", "frost", "grove", "haven", "iris", "jasper", "kestrel", "lumen"]
HEADER = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"


def _name(k: int) -> str:
    return f"{WORDS[k % 12]} {WORDS[k // 12 % 12]} trading{k}"


def _write(folder, prefix: str) -> None:
    """60 records with one true match each, in either source, and as many unrelated ones."""
    row = lambda s, k, name: f"{s}-{k}\t{name}\t{k} Main St\t{'France' if k % 3 else 'India'}\n"
    (folder / f"{prefix}source1.tsv").write_text(HEADER + "".join(row("S1", k, _name(k)) for k in range(60)))
    (folder / f"{prefix}source2.tsv").write_text(HEADER + "".join(row("S2", k, f"LLC {_name(k).upper()}") for k in range(0, 60, 2)) + "".join(row("S2", k, _name(k * 7)) for k in range(100, 130)))
    (folder / f"{prefix}source3.tsv").write_text(HEADER + "".join(row("S3", k, f"{_name(k)} Ltd") for k in range(1, 60, 2)) + "".join(row("S3", k, _name(k * 5)) for k in range(100, 130)))


def test_programs(spark, tmp_path, capsys):
    _write(tmp_path, "train_")
    _write(tmp_path, "test_")
    (tmp_path / "train_ground_truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "".join(f"S1-{k}\tS{3 if k % 2 else 2}-{k}\n" for k in range(60)))
    run = lambda *words: programs.main([str(w) for w in words], spark)
    assert run("train", "--train-dir", tmp_path, "--model", tmp_path / "model", "--sample", 50, "--pool-sample", 100, "--rounds", 3, "--depth", 2) == 0
    assert '"feature_importance"' in capsys.readouterr().out
    for _ in range(2):  # a rerun replaces the records
        assert run("partition", "--in-dir", tmp_path, "--part-dir", tmp_path / "parts") == 0
    assert tables.read_pool(spark, str(tmp_path / "parts")).count() == 120
    out = tmp_path / "out"
    link = ["link", "--part-dir", tmp_path / "parts", "--model", tmp_path / "model", "--out-dir", out, "--index-dir", tmp_path / "index"]
    check = ["validate", "--matching", out / "matching_results.tsv", "--candidate", out / "candidate_pairs.tsv", "--test-dir", tmp_path]
    keys = lambda: sorted(r["key"] for r in tables.read_id_lists(spark, str(out / "matching_results.tsv")).collect())
    assert run(*link, "--only-country", "india", "--resume") == 0  # there is no earlier output
    assert keys() == sorted(f"S1-{k}" for k in range(0, 60, 3))
    assert run(*check) == 1 and "missing_key" in capsys.readouterr().out
    assert run(*link, "--resume") == 0 and run(*link, "--resume") == 0
    assert keys() == sorted(f"S1-{k}" for k in range(60))
    assert run(*check) == 0 and "PASS" in capsys.readouterr().out
    assert run(*link) == 0 and len(keys()) == 60
    found = {r["key"]: r["ids"] for r in tables.read_id_lists(spark, str(out / "matching_results.tsv")).collect()}
    assert sum(f"S{3 if k % 2 else 2}-{k}" in found[f"S1-{k}"] for k in range(60)) >= 50
    (tmp_path / "bad.tsv").write_text("a\tb\nS1-1\tS2-2\n")
    assert run("validate", "--matching", tmp_path / "bad.tsv", "--candidate", out / "candidate_pairs.tsv", "--test-dir", tmp_path) == 1
    assert "error matches header: a\tb" in capsys.readouterr().out


def test_streamed_links_equal_batch_ones(spark, tmp_path):
    _write(tmp_path, "")
    s1, s2, s3 = (tables.read_records(spark, f"{tmp_path}/source{k}.tsv") for k in (1, 2, 3))
    pool = pipeline.records(pipeline.pool_of(s2, s3))
    s1.repartition(3).write.parquet(f"{tmp_path}/in")
    stream_links(spark.readStream.schema(s1.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in"), pool, None, 0.5, f"{tmp_path}/out", f"{tmp_path}/cp", index=f"{tmp_path}/index").awaitTermination()
    lists = lambda df: {r["key"]: r["ids"] for r in df.collect()}
    matches, cands = pipeline.link(pipeline.records(s1), pool, None, 0.5)
    assert lists(spark.read.parquet(f"{tmp_path}/out/candidates").drop("batch")) == lists(cands)
    assert set(map(tuple, lists(spark.read.parquet(f"{tmp_path}/out/matches").drop("batch")).values())) == {()} and matches.count() == 60


def test_stored_index(spark, tmp_path):
    schema = "id string, country string, norm_name string, norm_address string"
    rows = [("p1", "x", "alpha beta", "road"), ("p2", "x", "alpha", ""), ("p3", "y", "gamma", "")]
    pool, q = spark.createDataFrame(rows, schema), spark.createDataFrame([("a", "x", "alpha", "road"), ("b", "y", "delta", "")], schema)
    assert index.fingerprint(pool, k=1) == index.fingerprint(spark.createDataFrame(rows[::-1], schema), k=1)
    assert len({index.fingerprint(pool, k=1), index.fingerprint(pool, k=2), index.fingerprint(pool.union(pool), k=1), index.fingerprint(pool.limit(2), k=1)}) == 4
    key = lambda df: sorted(map(tuple, df.collect()))
    for _ in range(2):
        assert key(index.candidates(q, index.stored(pool, str(tmp_path)))) == key(blocking.candidates(q, pool))
    place = tmp_path / index.fingerprint(pool, max_df_ratio=0.003, max_postings=900)
    for f in (place / "done").iterdir():
        f.unlink()
    assert index._tables(spark, str(place)) is None  # a build that was broken off
    assert key(index.candidates(q, index.stored(pool, str(tmp_path)))) == key(blocking.candidates(q, pool))
    assert index.candidates(q, index.stored(pool.where("id = 'none'"), str(tmp_path))).count() == 0


def test_training_pool_keeps_every_true_match(spark):
    ids = lambda p, n: spark.createDataFrame([(f"{p}-{k}", "n", "a", "c") for k in range(n)], tables.RECORD)
    truth = spark.createDataFrame([("S1-1", "S2-1"), ("S1-2", "S2-1"), ("S1-1", "S3-4"), ("S1-3", "S3-99")], "s1 string, pool_id string")
    for size in (0, 2, 9, 1000):
        got = [r[0] for r in pipeline.training_pool(ids("S2", 20), ids("S3", 30), truth, size).select("entity_id").collect()]
        assert len(got) == len(set(got)) and {"S2-1", "S3-4"} <= set(got)
        assert max(2, min(size, 50) - 2) <= len(got) <= max(2, min(size, 50))


def test_one_class_or_nothing_trains_no_model(spark):
    schema = "entity_id string, business_name string, business_address string, country string"
    none = pipeline.records(spark.createDataFrame([], schema))
    no_truth = spark.createDataFrame([], "s1 string, pool_id string")
    fitted, threshold, metrics = pipeline.train(none, none, no_truth)
    assert (fitted, threshold, metrics["n_train_pairs"], metrics["blocking_recall_ceiling"]) == (None, 0.5, 0, 1.0)
    assert pipeline.link(none, none, None, 0.5)[0].count() == 0
    some = pipeline.records(spark.createDataFrame([(f"S1-{k}", _name(k), "", "x") for k in range(10)], schema))
    assert pipeline.train(some, some, no_truth)[0] is None


def test_report_and_verdict(spark):
    lists = "key string, ids array<string>"
    matches, cands = spark.createDataFrame([(f"S1-{k}", ["S2-1"]) for k in range(8)], lists), spark.createDataFrame([(f"S1-{k}", []) for k in range(8)], lists)
    issues = validate.not_candidates(matches, cands)
    assert issues.count() == 8 and tuple(validate.verdict(issues).first()) == (6, False)
    assert [(r["rule"], r["key"]) for r in validate.report(issues).orderBy(F.length("rule"), "key").collect()] == [("not_candidate", f"S1-{k}") for k in range(5)] + [("not_candidate_rest", "3")]
    assert tuple(validate.verdict(issues.limit(5)).first()) == (5, False) and validate.report(issues.limit(5)).count() == 5
    assert tuple(validate.verdict(issues.where("false")).first()) == (0, True)


def test_an_id_list_keeps_a_line_equal_to_its_header(spark, tmp_path):
    (tmp_path / "l.tsv").write_text("k\tv\nS1-1\tb,,a\nk\tv\n\nS1-2\n")
    got = [(r["key"], r["ids"]) for r in tables.read_id_lists(spark, f"{tmp_path}/l.tsv").collect()]
    assert sorted(got) == [("S1-1", ["b", "a"]), ("S1-2", []), ("k", ["v"])]
    assert tables.read_header(spark, f"{tmp_path}/l.tsv") == ["k", "v"]


def test_grams_of_short_long_and_astral_texts(spark):
    texts = ["", "a", "ab", "a b c", "abcabc", "x𝄞y z", "lorem " * 5000]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    for r in rows.select("k", feat.char_grams(F.col("t")).alias("g")).collect():
        s = texts[r["k"]].replace(" ", "")
        assert r["g"] == list(dict.fromkeys(s[i : i + 3] for i in range(max(len(s) - 2, 1)))) * bool(s)


def test_cosine_rows_for_queries_without_pool(spark):
    schema = "id string, country string, norm_name string, blend_text string"
    q = spark.createDataFrame([("a", "x", "alpha beta", "alpha beta road"), ("b", "z", "alpha", "alpha")], schema)
    pool = spark.createDataFrame([("p", "x", "alpha beta", "other words"), ("q", "x", "gamma", "road")], schema)
    got = {r["q_id"]: [tuple(c) for c in r["candidates"]] for r in cosine.by_query(q, cosine.cosine_candidates(q, pool)).collect()}
    assert got["b"] == [] and got["a"][0][0] == "p" and got["a"][0][1] == pytest.approx(1.0)


def test_importance_and_stored_model(spark, tmp_path):
    rows = spark.createDataFrame([(float(k % 2), k % 2) for k in range(40)], "x double, label int").select("label", *(F.col("x").alias(f) if f == "name_seq_ratio" else F.lit(0.0).alias(f) for f in feat.FEATURE_NAMES))
    fitted = model.fit(rows, 2, 2)
    best = pipeline.feature_importance(spark, fitted).collect()
    assert (best[0]["feature"], best[0]["importance"], len(best)) == ("name_seq_ratio", 1.0, 13)
    pipeline.save_bundle(spark, fitted, 0.4, {"n": 1}, f"{tmp_path}/m")
    again, threshold = pipeline.load_bundle(spark, f"{tmp_path}/m")
    assert threshold == 0.4 and model.probabilities(again, rows).where("(prob >= 0.5) <> (label = 1)").count() == 0
