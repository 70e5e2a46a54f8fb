"""Golden scalars, invariants and each rule of the linkage engine."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import features as feat
from tessera.functions import text as tx
from tessera.operators import blocking, cosine, metrics, validate
from tessera.plans import model, pipeline
from tessera.sources import tables

NAMES = [
    ("LLC Moncada Learning Center", "moncada learning center"), ("Moncada Learning Center LLC", "moncada learning center"), ("wilfordhancock.com", "wilfordhancock"), ("foo.co.in", "foo"), (".com Foo", "com foo"),
    ("--## Acme.com", "acme"), ("Pvt. Ltd. Acme & Sons | www.acme.in", "acme and sons"), ("A & A Co", "a and a"), ("Foo Inc Foo", "foo"), ("L.L.C. Foo", "foo"), ("L. L. C. Foo", "l c foo"), ("Sa Sa", ""),
    ("Café & Co. Pvt Ltd", "café and"), ("ＡＣＭＥ Ltd", "acme"), ("हिन्दी दुकान", "ह न द क न"), ("Acme Sarl Paris Limited", "acme paris"), (None, ""),
]
ADDRESSES = [("12 Main St., Apt 4", "12 main street apartment 4"), ("HNO 5 MG Rd Rd", "house number 5 mg road"), ("St Street", "street"), ("hno number 7", "house number number 7"), ("A & B Rd", "a & b road"), ("#12-B, 3rd Fl", "12 b 3rd floor"), ("", ""), (None, "")]


def test_normalization(spark):
    rows = spark.createDataFrame([(n, e, None, None) for n, e in NAMES], "n string, e string, a string, c string")
    out = tx.with_normalized(rows, "n", "a", "c").select("e", "norm_name").collect()
    assert [r["norm_name"] for r in out] == [r["e"] for r in out]
    rows = spark.createDataFrame(ADDRESSES, "a string, e string")
    assert all(r[0] == r[1] for r in rows.select(tx.normalize_address(F.col("a"), compose=False), "e").collect())
    assert spark.range(1).select(tx.country_slug(F.lit(" Côte d'Ivoire ")), tx.country_slug(F.lit(""))).first()[:] == ("c_te_d_ivoire", "unknown")


def test_features(spark):
    rows = spark.createDataFrame([("acme shop", "acme store"), ("", ""), ("x", "")], "a string, b string")
    a, b = F.col("a"), F.col("b")
    got = rows.select(feat.jaccard(feat.token_set(a), feat.token_set(b)), feat.jaccard(feat.char_grams(a), feat.char_grams(b)), feat.seq_ratio(a, b), feat.len_diff(a, b), feat.contained(a, b), feat.first_token_equal(a, b)).collect()
    assert tuple(got[0]) == pytest.approx((1 / 3, 0.3, 14 / 19, 0.1, 0, 1))
    assert tuple(got[1]) == (1, 1, 1, 0, 0, 0)
    assert tuple(got[2]) == (0, 0, 0, 1, 0, 0)


def test_token_index(spark):
    schema = "id string, country string, t string"
    pool = spark.createDataFrame([("p1", "x", "alpha beta"), ("p2", "x", "alpha"), ("p3", "x", "gamma")], schema)
    q = spark.createDataFrame([("a", "x", "alpha beta"), ("b", "x", "delta"), ("c", "x", "alpha delta"), ("d", "y", "alpha")], schema)
    got = {(r["q_id"], r["pool_id"]): r["score"] for r in blocking.block_view(q, pool, tx.word_tokens(F.col("t"))).collect()}
    assert got == pytest.approx({("a", "p1"): 1.0, ("a", "p2"): 0.4306765581, ("c", "p1"): 1.0, ("c", "p2"): 1.0})
    capped = blocking.block_view(q, pool, tx.word_tokens(F.col("t")), max_postings=1).collect()
    assert {(r["q_id"], r["pool_id"]) for r in capped} == {("a", "p1"), ("c", "p1")}


def test_cosine_counts_short_words_once(spark):
    got = spark.range(1).select(cosine.padded_grams(F.lit("a bc"))).first()[0]
    assert got == [" a", "a ", " a ", " b", "bc", "c ", " bc", "bc ", " bc "]


def test_metrics(spark):
    cases = [([], [], 1.0), (["a"], [], 0.0), ([], ["a"], 0.0), (["a", "b"], ["a"], 0.555556), (["a"], ["a", "b"], 0.833333), (["a", "b", "c"], ["a", "b"], 0.714286)]
    schema = "s1 string, ids array<string>"
    pred = spark.createDataFrame([(str(k), c[0]) for k, c in enumerate(cases)] + [("else", ["a"])], schema)
    truth = spark.createDataFrame([(str(k), c[1]) for k, c in enumerate(cases)], schema)
    assert {r["s1"]: r["f"] for r in metrics.entity_scores(pred, truth).collect()} == pytest.approx({str(k): c[2] for k, c in enumerate(cases)}, abs=1e-6)
    assert metrics.macro_f(pred, truth).first()["macro_f"] == pytest.approx(0.517196, abs=1e-6)
    scored = spark.createDataFrame([("s", "p", 0.9, 1), ("s", "q", 0.3, 0)], "s1 string, pool_id string, prob double, label int")
    best = metrics.best_threshold(metrics.threshold_sweep(scored, spark.createDataFrame([("s", 1), ("t", 0)], "s1 string, n_true long"))).first()
    assert best["threshold"] == pytest.approx(0.325) and best["score"] == 1.0 and best["n"] == 1


def test_validator_rules(spark):
    ids = "id string"
    s1, pool = spark.createDataFrame([("S1-1",), ("S1-2",)], ids), spark.createDataFrame([("S2-1",), ("S3-1",)], ids)
    lists = "key string, ids array<string>"
    good = [("S1-1", ["S2-1"]), ("S1-2", [])]
    c = spark.createDataFrame([("S1-1", ["S2-1", "S3-1"]), ("S1-2", ["S2-1"])], lists)
    found = lambda rows: {r["rule"] for r in validate.validate(spark.createDataFrame(rows, lists), c, s1, pool).collect()}
    assert found(good) == set()
    assert found(good[:1]) == {"missing_key"}
    assert found([*good, good[1]]) == {"duplicate_key"}
    assert found([*good, ("S1-9", [])]) == {"unknown_key"}
    assert found([("S1-1", ["S2-1", "S2-1"]), good[1]]) == {"repeated_id"}
    assert found([("S1-1", ["S1-1"]), good[1]]) == {"self_match", "not_candidate"}
    assert found([("S1-1", ["S2-7"]), good[1]]) == {"unknown_id", "not_candidate"}
    assert found([good[0], ("S1-2", ["S3-1"])]) == {"not_candidate"}
    assert validate.header_issue(spark, "matches", ["a", "b"], ["a", "c"]).count() == 1


def test_sources_and_sinks(spark, tmp_path):
    path = tmp_path / "r.tsv"
    path.write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tAcme\t\tFrance\nS1-2\tB \"q\"\tRd\tIndia\n")
    rows = tables.read_records(spark, str(path))
    assert [tuple(r) for r in rows.orderBy("entity_id").collect()] == [("S1-1", "Acme", "", "France"), ("S1-2", 'B "q"', "Rd", "India")]
    tables.write_partitioned({"source1": rows, "source2": rows}, str(tmp_path / "parts"))
    assert tables.read_pool(spark, str(tmp_path / "parts"), "france").count() == 1
    assert [r[0] for r in tables.country_slugs(spark, str(tmp_path / "parts")).collect()] == ["france", "india"]
    lists = spark.createDataFrame([("S1-1", ["b", "a"]), ("S1-2", [])], "key string, ids array<string>")
    tables.write_id_lists(lists.coalesce(1), str(tmp_path / "lists"), "k", "v")
    assert {r["key"]: r["ids"] for r in tables.read_id_lists(spark, str(tmp_path / "lists")).collect()} == {"S1-1": ["a", "b"], "S1-2": []}


def test_split_and_decision(spark):
    ids = spark.range(50).withColumnRenamed("id", "k")
    split = model.split_groups(ids, "k").collect()
    assert sum(r["is_val"] for r in split) == 10 and len(split) == 50
    scored = spark.createDataFrame([("a", "p", 0.9), ("a", "q", 0.1)], "q_id string, pool_id string, prob double")
    m, c = model.decide(scored, spark.createDataFrame([("a",), ("b",)], "id string"), 0.5)
    assert {r["key"]: r["ids"] for r in m.collect()} == {"a": ["p"], "b": []}
    assert {r["key"]: r["ids"] for r in c.collect()} == {"a": ["p", "q"], "b": []}
    assert pipeline.resume(spark.createDataFrame([("a",), ("b",)], "id string"), m.where("key = 'a'")).first()[0] == "b"
    with pytest.raises(ValueError, match="one class"):
        model.balanced(spark.createDataFrame([(1,)], "label int"))


def test_registered_link_trains_the_whole_forest(spark, monkeypatch):
    import inspect

    from tessera import catalog
    from tessera.plans import pipeline

    asked, own = {}, inspect.signature(pipeline.train)

    def train(*args, **named):
        bound = own.bind(*args, **named)
        bound.apply_defaults()
        asked.update(bound.arguments)
        raise StopIteration

    monkeypatch.setattr(pipeline, "train", train)
    with pytest.raises(StopIteration):
        catalog.gbt_link(spark, "/root/testdata/sf0.001")
    assert (asked["rounds"], asked["depth"]) == (200, 6)


def test_training_pairs_lie_in_partitions_by_their_number(spark, monkeypatch):
    from pyspark.ml import Pipeline

    from tessera.functions.features import FEATURE_NAMES

    seen = []

    def fit(self, pairs):
        seen.append((pairs.rdd.getNumPartitions(), pairs.count(), pairs.select("label").distinct().count()))

    monkeypatch.setattr(Pipeline, "fit", fit)
    rows = spark.range(0, 250, 1, 37).selectExpr("int(id % 2) as label", *(f"id / 250.0 as {c}" for c in FEATURE_NAMES))
    model.fit(rows)
    monkeypatch.setattr(model, "PART_ROWS", 100)
    model.fit(rows)
    assert seen == [(1, 250, 2), (3, 250, 2)]


def test_cosine_in_cells_equals_brute_force(spark, monkeypatch):
    import math
    import random
    from collections import Counter

    for name, value in (("QUERY_BLOCK", 16), ("POOL_BLOCK", 40), ("CHUNK", 8), ("DENSE_GRAMS", 12)):
        monkeypatch.setattr(cosine, name, value)
    r = random.Random(5)
    words = ["acme", "a", "shop", "épicerie", "x1", "paris", "nord", "sud", "og", "bar"]
    text = lambda: " ".join(r.choices(words, k=r.randint(0, 5)))
    rows = [(f"p{i:03}", r.choice("xy"), "acme shop" if i % 4 == 0 else text()) for i in range(200)]
    asked = [(f"q{i:03}", r.choice("xyz"), text()) for i in range(60)] + [("q900", "x", "acme shop"), ("q901", "x", None)]
    schema = "id string, country string, t string"
    q, pool = spark.createDataFrame(asked, schema), spark.createDataFrame(rows, schema)
    library = {k: g for k, g in spark.createDataFrame([(w,) for w in words], "w string").select("w", cosine.padded_grams(F.col("w"))).collect()}
    assert all(sorted(cosine.grams_of(w)) == sorted(library[w]) for w in words)
    grams = {i: Counter(g for w in (t or "").split() for g in library[w]) for i, _, t in asked + rows}
    for fit_on_pool in (False, True):
        got = {(x["q_id"], x["rank"]): (x["pool_id"], x["score"]) for x in cosine.cosine_top_k(q, pool, "t", 7, fit_on_pool=fit_on_pool).collect()}
        want = {}
        for c in "xy":
            fitted = [i for i, k, _ in (rows if fit_on_pool else asked + rows) if k == c]
            df = Counter(g for i in fitted for g in grams[i])
            idf = {g: math.log((1 + len(fitted)) / (1 + n)) + 1 for g, n in df.items()}

            def unit(i, idf=idf):
                w = {g: n * idf[g] for g, n in grams[i].items() if g in idf}
                norm = math.sqrt(sum(x * x for x in w.values()))
                return {g: x / norm for g, x in w.items()}

            own = {i: unit(i) for i, k, _ in rows if k == c}
            for i in (i for i, k, _ in asked if k == c):
                a = unit(i)
                scores = sorted((-round(sum(w * b.get(g, 0) for g, w in a.items()), 9), j) for j, b in own.items())[:7]
                want |= {(i, n): (j, -s) for n, (s, j) in enumerate(scores, 1) if -s >= 0.12}
        assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
        assert {k: v[1] for k, v in got.items()} == pytest.approx({k: v[1] for k, v in want.items()}, abs=1e-8)


def test_cell_multiplies_in_single_and_ranks_in_double_precision(monkeypatch):
    from tessera.operators import cosine

    monkeypatch.setattr(cosine, "DENSE_GRAMS", 64)
    texts = {f"p{i:02}": f"ab {w}" for i, w in enumerate(["uu", "vv", "ww", "xx"] * 5)}
    for one in ("uu", "vv", "ww", "xx"):  # the likest by 2e-8 of the score
        cell = cosine._Cell(1, 0.12)
        for word in ("ab", "uu", "vv", "ww", "xx"):
            for gram in cosine.grams_of(word):
                cell.place[gram] = len(cell.place)
                cell.idf.append(1.0 - 1e-7 * (word == one))
        cell.ids, cell.texts = list(texts), list(texts.values())
        got = cell.best({"ab": ["q0"]}).to_pydict()
        assert cell.dense.dtype == "float32" and cell.dense.shape[1] > 0
        assert got["pool_id"] == [min(i for i, t in texts.items() if t == f"ab {one}")]
        assert got["score"][0] == pytest.approx((1 / (1 + (1 - 1e-7) ** 2)) ** 0.5, abs=1e-12)


def test_compared_texts_equal_the_native_expressions(spark):
    import random

    r = random.Random(1)
    text = lambda: None if r.random() < 0.03 else "".join(r.choices(["a", "b", " ", "é", "𝒳", "x", "\t", "ab ", "c", "&"], k=r.choice([0, 1, 2, 3, 5, 9, 30])))
    columns = [f"norm_{c}_{i}" for c in ("name", "address", "country") for i in (1, 2)]
    pairs = spark.createDataFrame([tuple(text() for _ in columns) for _ in range(1500)], ", ".join(f"{c} string" for c in columns))
    n1, n2 = F.col("norm_name_1"), F.col("norm_name_2")
    native = [feat.jaccard(feat.token_set(n1), feat.token_set(n2)), feat.jaccard(feat.char_grams(n1), feat.char_grams(n2)), feat.seq_ratio(n1, n2), feat.len_diff(n1, n2), feat.contained(n1, n2), feat.first_token_equal(n1, n2)]
    made = feat.with_features(pairs)
    assert "ArrowEvalPython" in made._jdf.queryExecution().toString()
    got = made.select("name_tok_jaccard", "name_char_jaccard", "name_seq_ratio", "name_len_diff", "name_substr", "first_tok_match")
    assert [tuple(x) for x in got.collect()] == [tuple(x) for x in pairs.select(*native).collect()]


def test_boosting_grows_the_same_trees_in_one_task_and_in_three(spark, monkeypatch):
    from tessera.functions.features import FEATURE_NAMES

    rows = spark.range(0, 600, 1, 5).selectExpr("int(id % 7 < 3) as label", *(f"double(pmod(xxhash64(id, {k}), 40) + int(id % 7 < 3) * {k}) as {c}" for k, c in enumerate(FEATURE_NAMES)))
    trees = []
    for size in (1000, 200):
        monkeypatch.setattr(model, "PART_ROWS", size)
        fitted = model.fit(rows, 4, 3)
        trees.append([x.strip() for x in fitted.stages[-1].toDebugString.split("\n") if "If (" in x])
        wrong = model.probabilities(fitted, rows).where("(prob >= 0.5) != (label = 1)").count()
        assert wrong < 170  # of 257 that are the rarer class; the features overlap
    assert trees[0] == trees[1] and len(trees[0]) > 8
