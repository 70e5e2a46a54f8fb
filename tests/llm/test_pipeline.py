"""The corpus pipeline against a brute-force version of all its stages, and the folds of registered queries."""

import hashlib
import random
import re
from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm import queries

from test_operators import brute_components

WORDS = [f"w{k}" for k in range(3000)]
SPACE = " \t\n\x0b\x0c\r"


def rows(seed=9):
    r = random.Random(seed)
    prose = lambda n: " ".join(r.choices(WORDS, k=n))
    out = [prose(r.randint(30, 120)) for _ in range(60)]
    line = "Subscribe to our NEWSLETTER today"
    out += [f"{prose(40)}\n{line if k % 2 else '  ' + line.lower()}\n{prose(20)}" for k in range(12)]  # the line is in twelve documents
    items = [prose(24), prose(9)]
    out += [f"{prose(30)} {items[0]} {prose(20)}", f"{prose(30)}. {items[1].upper()}! {prose(25)}"]
    out += [out[3], out[4] + " changed", out[5].upper()]
    out += [None, "", " \n ", "too few words", "again and again " * 30, prose(6000)]
    return [(k, t, "en", None if k % 7 == 0 else f"s{k % 3}", len(t or "")) for k, t in enumerate(out)], [(1, items[0]), (2, items[1]), (3, None), (4, "")]


def written(spark, folder, docs, items, labels):
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS id", "'x' AS token").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def base_failed(text):
    words = re.findall(f"[^{SPACE}]+", text or "")
    runs = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    again = {j for k in range(len(words) - 4) if runs[tuple(words[k : k + 5])] > 1 for j in range(k, k + 5)}
    return len(words) < 10 or 100 * len(again) > 20 * len(words)


def leaks(text, item):
    a, b = ([w for w in re.split(r"[\W_]+", t.lower()) if w] for t in (text, item or ""))
    width = min(20, len(b))
    for shift in range(1 - len(b), len(a)) if len(b) > 2 else ():
        agree = [0 <= shift + k < len(a) and a[shift + k] == w for k, w in enumerate(b)]
        if max(sum(agree[k : k + width]) for k in range(len(b) - width + 1)) * 100 >= 75 * width:
            return True
    return False


def brute(docs, items):
    kept = {k: t for k, t, *_ in docs if not base_failed(t)}
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(SPACE))
    held = Counter(x for t in kept.values() for x in {key(y) for y in t.split("\n")} if x)
    kept = {k: "\n".join(y for y in t.split("\n") if not (key(y) and held[key(y)] >= 10)) for k, t in kept.items()}
    kept = {k: t for k, t in kept.items() if brute_components(kept)[k][1] == k} if len(kept) < 5 else _least(kept)
    return {k: t for k, t in kept.items() if not any(leaks(t, i) for _, i in items)}


def _least(kept):
    found = brute_components(kept)
    return {k: t for k, t in kept.items() if found[k][1] == k}


def test_pipeline_equals_brute_force(spark, tmp_path):
    docs, items = rows()
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, written(spark, tmp_path, docs, items, [])).collect()}
    wanted = brute(docs, items)
    assert set(got) == set(wanted) and len(wanted) > 50
    library = Tokenizer.from_file(queries.tokenizer_path())
    library.no_truncation()
    library.no_padding()
    for k, text in wanted.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert got[k]["n_tokens"] == len(ids)
        assert got[k]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[k]["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_pipeline_keeps_the_columns_of_documents(spark, tmp_path):
    docs, items = rows()
    folder = written(spark, tmp_path, docs, items, [])
    table = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        table = stage(spark, table, folder)
        assert table.columns == corpus_pipeline.COLUMNS


def test_pipeline_of_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, written(spark, tmp_path, [], [], [])).collect() == []


@pytest.mark.parametrize("name", ["op3_language_id", "op6_mixing_score"])
def test_registered_folds(spark, tmp_path, name):
    """Held-out rows are those whose crc32 of the doc_id's text leaves 1; a null doc_id is held out by neither rule."""
    import zlib

    docs, items = rows()
    folder = written(spark, tmp_path, [*docs, (None, "without id but with words", "en", "s", 1)], items, [])
    fold = {"op3_language_id": 3, "op6_mixing_score": 5}[name]
    got = queries.queries()[name](spark, folder).collect()
    assert len(got) == len(docs) + 1
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % fold == 1)
