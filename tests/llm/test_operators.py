"""Each operator against a brute-force version or an exact property, with nulls, empty and odd rows."""

import hashlib
import itertools
import math
import random
import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import op1_license, op2_bpe, op3_langid, op4_decontaminate, op5_html, op6_mixing, op7_linededup, op8_quality, op9_sharding, op10_jaccard
from tessera.llm.queries import queries, tokenizer_path
from tessera.llm.shingles import unpack

WORDS = [f"w{k}" for k in range(400)]
DOCS = "doc_id long, text string, lang string, source string, rank int"


def texts(n=60, seed=3):
    """Random texts with exact and near copies, a shared passage, and null, empty, blank and short rows."""
    r = random.Random(seed)
    rows = [" ".join(r.choices(WORDS, k=r.randint(30, 90))) for _ in range(n)]
    passage = " ".join(r.choices(WORDS, k=14))
    for k in range(0, n, 6):
        rows.append(rows[k])
        w = rows[k].split()
        w[len(w) // 2] = "Changed"
        rows.append(" ".join(w))
        rows.append(rows[k] + "\n" + passage)
    return [*rows, None, "", " \n\t", "a b", "a b", "a b c d e f", "x\ny\n\n  X "]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en" if k % 4 else None, f"s{k % 3}" if k % 5 else None, 7) for k, t in enumerate(texts())]
    return spark.createDataFrame(rows, DOCS)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_license(spark):
    rows = [(1, "Intro\nReleased under the MIT License.\nEnd"), (2, "Licensed under the Apache License, Version 2.1.\n\nnone"), (3, None), (4, ""), (5, "my license plate"), (6, "Licensed under CC BY-NC 4.0.\nx\nLicensed under CC BY-NC 4.0.")]
    got = by_id(op1_license.scan(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got[1]["licenses"] == ["MIT-short"] and got[1]["matches"][0]["exact"]
    assert not any(m["exact"] for m in got[2]["matches"])
    assert [got[k]["licenses"] for k in (3, 4, 5)] == [[], [], []] and got[5]["n_blocks"] == 1
    assert got[6]["matches"][0]["repeats"] == 2


def test_license_within_lines_and_across_them(spark):
    own = op1_license.TEMPLATES
    wrap = lambda name, width, mark="": "\n".join(mark + x for x in textwrap.wrap(own[name], width))
    sentence = "It was a long and quiet day by the river and nobody in the town had thought of the old mill again. "
    rows = [
        "Copyright 2021 Foo Bar. Released under the MIT License.", sentence + own["MIT-short"] + " " + sentence, sentence * 30 + wrap("MIT", 60) + "\n" + sentence * 30, wrap("GPL-3.0", 40, "# "),
        own["MIT-short"] + "\n" + own["CC-BY-NC-4.0-short"], wrap("Apache-2.0", 70) + "\n\n" + wrap("BSD-3-Clause", 70), sentence + "The permission is with the license office.",
    ]
    got = by_id(op1_license.scan(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")))
    assert [got[k]["licenses"] for k in range(7)] == [["MIT-short"], ["MIT-short"], ["MIT"], ["GPL-3.0"], ["CC-BY-NC-4.0-short", "MIT-short"], ["Apache-2.0", "BSD-3-Clause"], []]
    assert all(m["exact"] for k in range(6) for m in got[k]["matches"])


def test_license_compression_decides_before_the_wording():
    text = "Some words before. " + op1_license.TEMPLATES["MIT-short"] + " " + op1_license.TEMPLATES["Unlicense"] + " Some words after."
    for limit, found in ((0.35, ["MIT-short", "Unlicense"]), (9.0, [])):
        scanner, aligned = op1_license.LicenseScanner(least_reduction=limit), []
        exact = scanner.aligned
        scanner.aligned = lambda name, words, exact=exact, aligned=aligned: aligned.append(name) or exact(name, words)
        assert [m.template for block in scanner.blocks(text) for _, m in scanner.scan_block(text, block)] == found
        assert set(aligned) == set(found)


def test_bpe_equals_the_library(spark, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    r = random.Random(1)
    odd = ["".join(r.choices("aethionsr  '\n<|>x\x1c019éÉİΣß中́.,!", k=r.randint(0, 60))) for _ in range(300)]
    odd += ["a<|endoftext|>b <|startoftext|>", "a" * 5000, "don't WE'LL"]
    own = [t for t in texts() if t is not None] + odd
    got = by_id(op2_bpe.encode_documents(spark.createDataFrame(list(enumerate(own)), "doc_id long, text string"), tokenizer_path(), True, True))
    for k, t in enumerate(own):
        ids = library.encode(t, add_special_tokens=False).ids
        assert list(got[k]["ids"]) == ids and got[k]["n_tokens"] == len(ids)
        assert got[k]["decoded"] == library.decode(ids, skip_special_tokens=False)
        assert got[k]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert by_id(op2_bpe.encode_documents(spark.createDataFrame([(1, None)], "doc_id long, text string"), tokenizer_path()))[1]["n_tokens"] == 0


def test_bpe_leaves_no_large_memos_in_a_worker(spark):
    r = random.Random(5)
    rows = spark.createDataFrame([(k, " ".join("".join(r.choices("abcdefghij", k=8)) for _ in range(1000))) for k in range(30)], "doc_id long, text string").coalesce(1)
    assert len(op2_bpe.encode_documents(rows, tokenizer_path()).collect()) == 30

    def remembered(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sum(e.remembered() for e in op2_bpe._LOADED.values())] * batch.num_rows)], names=["n"])

    assert max(x["n"] for x in spark.range(64, numPartitions=8).mapInArrow(remembered, "n long").collect()) <= op2_bpe.KEPT


def test_language(spark):
    sides = {"en": "the that with from this have", "de": "der und nicht eine schon über", "fr": "le une être avec près où"}
    r = random.Random(2)
    rows = [(k, " ".join(r.choices(sides[c].split(), k=20)), c) for k, c in enumerate(list(sides) * 20)]
    model = op3_langid.train(spark.createDataFrame([*rows, (99, None, "en"), (98, "the", None)], "doc_id long, text string, lang string"))
    ask = [(1, "with the that from", "x"), (2, "eine und nicht über", "x"), (3, None, "x"), (4, "12 !", "x"), (5, "être où une", None)]
    got = by_id(op3_langid.predict(spark.createDataFrame(ask, "doc_id long, text string, lang string"), model))
    assert [got[k]["lang_pred"] for k in range(1, 6)] == ["en", "de", "und", "und", "fr"]
    assert all(0 <= g["score"] <= 1 for g in got.values())
    empty = op3_langid.train(spark.createDataFrame([], "text string, lang string"))
    assert empty.predict("text") == ("und", 0.0)


def test_decontamination(spark):
    r = random.Random(4)
    items = [(k, " ".join(r.choices(WORDS, k=25))) for k in range(5)] + [(9, None), (10, ""), (11, "tiny item here")]
    w = items[0][1].split()
    w[6] = w[13] = w[20] = "swapped"
    fill = lambda: " ".join(r.choices(WORDS, k=40))
    rows = [(1, f"{fill()} {items[1][1].upper()}, {fill()}"), (2, fill() + " " + " ".join(w)), (3, fill()), (4, None), (5, ""), (6, fill() + " Tiny item, here! " + fill()), (7, " ".join(items[2][1].split()[:9])), (1, items[1][1])]
    got = op4_decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(g["doc_id"], g["item_id"]) for g in got} == {(1, 1), (2, 0), (6, 11)}
    assert next(g for g in got if g["doc_id"] == 2)["matched"] == 22
    kept = op4_decontaminate.clean(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {k["doc_id"] for k in kept.collect()} == {3, 4, 5, 7}


def test_html(spark):
    page = lambda k: f"<html><body><nav>menu</nav><div class='x'>same on all</div><p>own {k} &amp; text<br>more <b>bo</b>ld<script>var a='</p>'</script></p><div class=comments>reader</div></body></html>"
    rows = [(k, "http://h.example/" + str(k), page(k)) for k in range(30)]
    rows += [(100, None, None), (101, "u", ""), (102, "http://o.example/", "<article><h1>T</h1><p>a<p>b <!-- c --></article><footer>f</footer><aside>s"), (103, "x", "plain text <a"), (100, None, None)]
    got = {r["page_id"]: r["text"] for r in op5_html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[7] == "own 7 & text more bold"
    assert (got[100], got[101], got[102], got[103]) == ("", "", "T a b", "plain text")


@pytest.mark.parametrize("n", range(3, 21))
def test_decontamination_masks_miss_no_pattern(n):
    for gone in itertools.combinations(range(n), n - math.ceil(0.75 * n)):
        assert any(all(at + k not in gone for k in seed) for seed in op4_decontaminate.seeds_for(n) for at in range(n - seed[-1]))


def test_decontamination_of_short_items(spark):
    """Every substitution within the rule is found in documents that hold little else, for items below and above the masks' span."""
    items, rows = [], []
    for n in (3, 4, 5, 7, 8, 9, 12):
        w = [f"t{n}x{k}" for k in range(n)]
        items.append((n, " ".join(w)))
        for gone in itertools.combinations(range(n), n - math.ceil(0.75 * n)):
            rows.append((len(rows), n, " ".join("other" if k in gone else x for k, x in enumerate(w))))
    docs = spark.createDataFrame([(k, t) for k, _, t in rows], "doc_id long, text string")
    got = op4_decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(g["doc_id"], g["item_id"]) for g in got} == {(k, n) for k, n, _ in rows}


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<div>{}</div>"])
def test_html_keeps_near_copies(spark, wrap):
    """A host of editions of one article, each with a word of its own, loses no paragraph; a menu among different pages goes."""
    r = random.Random(6)
    paragraph = lambda: " ".join(r.choices(WORDS, k=40))
    common = [paragraph() for _ in range(5)]
    rows = [(k, "http://near.example/", wrap.format("".join(f"<p>{p}</p>" for p in [*common, f"edition {k} of this text"]))) for k in range(60)]
    rows += [(100 + k, "http://other.example/", f"<div>home news about</div><p>{paragraph()}</p>") for k in range(30)]
    got = {g["page_id"]: g["text"] for g in op5_html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[k] == " ".join([*common, f"edition {k} of this text"]) for k in range(60))
    assert not any("home" in got[100 + k] for k in range(30))


def test_mixing_and_base_scores(spark, docs):
    own = {k: t for k, t in enumerate(texts())}
    got = by_id(op6_mixing.score(docs.withColumn("training", F.expr("doc_id % 5 <> 1"))))
    words = {k: re.findall("[^\x20\x09-\x0d]+", (t or "").lower()) + [None] for k, t in own.items()}
    c = Counter(w for k, ws in words.items() if k % 5 != 1 for w in ws)
    n, v = sum(c.values()), len(c)
    for k, ws in words.items():
        assert got[k]["base_score"] == pytest.approx(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
        assert (got[k]["n_tokens"], got[k]["n_known"], got[k]["train_tokens"]) == (len(ws), sum(c[w] > 0 for w in ws), n)
        assert got[k]["score"] < 0
    for copy in range(0, 60, 6):  # a text's score is its own
        assert got[copy]["score"] == pytest.approx(got[60 + copy // 2]["score"], rel=1e-6)


def slow_bits(symbols, train, code, model):
    """The bits of one text, decision by decision, from the counts of the training texts in dictionaries."""
    seen = [Counter() for _ in op6_mixing.ORDERS]
    path = lambda s: [(int(code.node[a]), int(code.bit[a])) for a in range(code.start[s], code.start[s] + code.length[s])]
    before = lambda text, k, order: tuple(text[max(0, k - order) : k]) + (None,) * max(0, order - k)
    for text in train:
        for k, s in enumerate(text):
            for node, bit in path(s):
                for kind, order in enumerate(op6_mixing.ORDERS):
                    seen[kind][before(text, k, order), node, bit] += 1
    # Weights and the mix are single-precision numbers as in the operator: on a border of two cells of the map the rounding decides.
    weights, refine, total = model.weights.astype(np.float32) / np.float32(16), model.refine.astype(float).copy(), 0.0
    for step in range(0, len(symbols), op6_mixing.STEP):
        slopes, times, cells = np.zeros(weights.shape), np.zeros(op6_mixing.GATES), []
        for k in range(step, min(step + op6_mixing.STEP, len(symbols))):
            for depth, (node, bit) in enumerate(path(symbols[k])):
                x, gate = [float(code.plain[node])], min(depth, op6_mixing.GATES // 4 - 1)
                for kind, order in enumerate(op6_mixing.ORDERS):
                    zeros, ones = (seen[kind][before(symbols, k, order), node, b] for b in (0, 1))
                    x.append(float(op6_mixing.stretch(zeros, ones)) if zeros + ones else 0.0)
                    gate += (op6_mixing.GATES // 4 << kind) * (x[-1] != 0)
                mixed = weights[gate][0] * np.float32(x[0])
                for w, v in zip(weights[gate][1:], x[1:], strict=True):
                    mixed += w * np.float32(v)
                mixed = np.clip(np.array([mixed], np.float32), -12, 12)
                chance, cell = 1 / (1 + math.exp(-float(mixed[0]))), int(op6_mixing.cell_of(mixed)[0])
                final = min(max((chance + refine[gate, cell]) / 2, 1e-5), 1 - 1e-5)
                total -= math.log2(final if bit else 1 - final)
                slopes[gate] += [(bit - chance) * v for v in x]
                times[gate] += 1
                cells.append((gate, cell, bit - refine[gate, cell]))
        weights += (op6_mixing.RATE / 256 * slopes / np.maximum(times, 1)[:, None] ** 0.5).astype(np.float32)
        many = Counter((g, c) for g, c, _ in cells)
        for g, c, away in cells:
            refine[g, c] += away / (many[g, c] + 60)
    return total


def test_mixing_equals_a_slow_one(spark, monkeypatch):
    """All training texts, some cut into many chunks and buckets, texts from none to several steps and windows, spelled words."""
    r = random.Random(4)
    rows = [(k, " ".join(r.choices(WORDS[:60], k=r.choice([1, 5, 20, 70])))) for k in range(60)]
    rows += [(60, rows[3][1]), (61, None), (62, "ωων " * 3 + "once-seen"), (63, " ".join(r.choices(WORDS[:60], k=300))), (64, "Never seen " * 50)]
    kept = {}
    settled, huffman = op6_mixing.settled, op6_mixing.Code.huffman
    monkeypatch.setattr(op6_mixing, "settled", lambda lessons: kept.setdefault("model", settled(lessons)))
    monkeypatch.setattr(op6_mixing.Code, "huffman", lambda *a: kept.setdefault("code", huffman(*a)))
    docs = spark.createDataFrame([(k, t, k % 5 != 1 and k != 64) for k, t in rows], "doc_id long, text string, training boolean").repartition(3)
    got = {g["doc_id"]: g["total_bits"] for g in op6_mixing.score(docs).collect()}
    code, model = kept["code"], kept["model"]
    every, ends = op6_mixing.symbols_of([(t or "").encode() for _, t in rows], code)
    parts = {k: part.tolist() for (k, _), part in zip(rows, np.split(every, ends[:-1]), strict=True)}
    train = [parts[k] for k in parts if k % 5 != 1 and k != 64]
    for k in (0, 1, 2, 6, 11, 60, 61, 62, 63, 64):
        assert got[k] == pytest.approx(slow_bits(parts[k], train, code, model), rel=2e-3)


def test_mixing_predictions_of_a_bucket():
    """Predictions along the paths equal counts in a dictionary; contexts of one hash bucket share nothing."""
    rng = np.random.default_rng(3)
    code = op6_mixing.Code.huffman(np.sort(rng.integers(0, 1 << 63, 40).astype(np.uint64)), rng.integers(1, 500, 40), 7, 9)
    assert sum(2.0 ** -int(n) for n in code.length[: code.words]) == pytest.approx(1.0)  # the decisions are a complete code
    symbols = rng.integers(0, code.words, 600).astype(np.uint64)
    pairs, times = np.unique(rng.integers(0, 9, 600).astype(np.uint64) << np.uint64(24) | symbols, return_counts=True)
    got, at = op6_mixing.path_predictions(pairs, times, code), 0
    held = Counter()
    paths = [[(int(p) >> 24, int(code.node[a]), int(code.bit[a])) for a in range(code.start[int(p) & 0xFFFFFF], code.start[int(p) & 0xFFFFFF] + code.length[int(p) & 0xFFFFFF])] for p in pairs]
    for path, n in zip(paths, times.tolist(), strict=True):
        for step in path:
            held[step] += n
    for path in paths:
        for c, node, _ in path:
            assert got[at] == op6_mixing.stretch(held[c, node, 0], held[c, node, 1])
            at += 1
    assert at == len(got)


def test_mixing_answers_are_sent_in_parts():
    """The end of a path that repeats is sent once, and what comes back is the whole path of each asked pair."""
    rng = np.random.default_rng(4)
    code = op6_mixing.Code.huffman(np.sort(rng.integers(0, 1 << 63, 300).astype(np.uint64)), rng.integers(1, 500, 300), 7, 9)
    pairs = np.unique(rng.integers(0, 200, 2000).astype(np.uint64) << np.uint64(24) | rng.integers(0, code.words, 2000).astype(np.uint64))
    times, places = rng.integers(0, 4, len(pairs)), np.arange(0, len(pairs), 3)
    parts = op6_mixing.path_parts(pairs, times, code)
    back = op6_mixing.received(op6_mixing.sent(parts, np.cumsum(parts[0], dtype=np.int64) - parts[0], places))
    length = code.length[(pairs & np.uint64(0xFFFFFF)).astype(np.int64)]
    whole = op6_mixing.path_agreements(pairs, times, code)
    assert (op6_mixing.whole_paths(*back, length[places]) == whole[op6_mixing.spread((np.cumsum(length) - length)[places], length[places])]).all()
    assert sum(map(len, back)) < length[places].sum()


def test_mixing_answers_are_short_and_texts_stand_alone(monkeypatch):
    """Agreements are the predictions towards the path's own bit, also of lone and unseen pairs; texts scored side by side don't change each other."""
    rng = np.random.default_rng(8)
    code = op6_mixing.Code.huffman(np.sort(rng.integers(0, 1 << 63, 900).astype(np.uint64)), rng.integers(1, 500, 900), 7, 9)
    symbols = rng.integers(0, code.words, 9000).astype(np.uint64)
    pairs, times = np.unique(rng.integers(0, 6000, 9000).astype(np.uint64) << np.uint64(24) | symbols, return_counts=True)
    times[::7] = 0
    said, sign = op6_mixing.path_agreements(pairs, times, code), []
    for p in pairs.tolist():
        begin = int(code.start[p & 0xFFFFFF])
        sign += (2 * code.bit[begin : begin + int(code.length[p & 0xFFFFFF])].astype(int) - 1).tolist()
    assert (said * np.array(sign) == op6_mixing.path_predictions(pairs, times, code)).all()
    assert 3 * len(op6_mixing.pack(said)) < 2 * len(op6_mixing.pack(op6_mixing.path_predictions(pairs, times, code)))
    ends = np.cumsum(rng.integers(1, 90, 40))
    text, model = rng.integers(0, code.words, int(ends[-1])), op6_mixing.Mixer.fresh()
    places = op6_mixing._places(text, ends, np.ones(len(ends), np.uint8), code)
    answers = [rng.integers(-120, 120, int(p.max()) + 40).astype(np.int8) for p in places]
    bits = lambda: op6_mixing.bits_of(list(range(len(ends))), ends, text, places, answers, code, model)
    whole = bits()
    monkeypatch.setattr(op6_mixing, "ABREAST", 3)
    assert (bits() == whole).all()


def test_mixing_finds_words_by_slots_and_keeps_the_fold_apart():
    """Slots find what a search finds; a path's numbers hold logit, bit and depth; a chunk lists the texts of the fold by themselves."""
    rng = np.random.default_rng(5)
    keys = np.append(rng.integers(0, 1 << 64, 3000, dtype=np.uint64), np.uint64(1 << 60) + np.arange(40, dtype=np.uint64))  # some share a slot
    code = op6_mixing.Code.huffman(keys, rng.integers(1, 500, len(keys)), 7, 9)
    wanted = np.concatenate([keys, keys + np.uint64(1), np.array([0, (1 << 64) - 1], np.uint64)])
    assert (op6_mixing.key_places(wanted, code) == np.searchsorted(code.keys, wanted)).all()
    for s in range(0, len(code.start), 50):
        path = slice(int(code.start[s]), int(code.start[s] + code.length[s]))
        along, bit = code.along[path].astype(int), code.bit[path].astype(int)
        assert ((along >> 4) * 8 == code.plain[code.node[path]] * (2 * bit - 1)).all() and (along >> 3 & 1 == bit).all() and (along & 7 == np.minimum(np.arange(len(bit)), 7)).all()
    held = [(k, k, " ".join(map(str, rng.integers(0, 50, 20))), k % 5 != 1) for k in range(200)] + [(200, 200, None, True)]
    chunk = op6_mixing.chunk_of(held, code, np.zeros(0, np.int64), np.zeros(0), np.zeros(code.words)).to_pylist()[0]
    symbols, ends, kinds = op6_mixing.unpack(chunk["symbols"], np.uint32), np.frombuffer(chunk["ends"], np.int64), np.frombuffer(chunk["kinds"], np.uint8)
    apart = [part for part, kind in zip(np.split(symbols, ends[:-1]), kinds, strict=True) if kind == 2]
    assert 0 < len(apart) < len(held) and (op6_mixing.unpack(chunk["fold"], np.uint32) == np.concatenate(apart)).all()
    assert np.frombuffer(chunk["fold_ends"], np.int64).tolist() == np.cumsum([len(part) for part in apart]).tolist()


def test_mixing_without_training_texts_and_empty(spark, tmp_path):
    docs = spark.createDataFrame([(1, "some words", None), (None, None, False)], "doc_id long, text string, training boolean")
    got = {g["doc_id"]: g for g in op6_mixing.score(docs).collect()}
    assert got[1]["train_tokens"] == 0 and got[1]["n_tokens"] == 3 and got[1]["total_bits"] > got[None]["total_bits"] >= 0
    docs.where("doc_id > 5").write.parquet(str(tmp_path / "none"))
    assert op6_mixing.score(spark.read.parquet(str(tmp_path / "none"))).count() == 0


def test_line_dedup(spark, docs, monkeypatch):
    own = {k: t for k, t in enumerate(texts())}
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    held = Counter(x for t in own.values() for x in {key(y) for y in (t or "").split("\n")} if x)
    for limit in (op7_linededup.KEYS_AT_HAND, 0):
        monkeypatch.setattr(op7_linededup, "KEYS_AT_HAND", limit)
        got = by_id(op7_linededup.dedup(docs, least_documents=3))
        for k, t in own.items():
            lines = (t or "").split("\n")
            stay = [x for x in lines if held[key(x)] < 3]
            assert (got[k]["n_lines"], got[k]["n_dropped"], got[k]["kept"]) == (len(lines), len(lines) - len(stay), "\n".join(stay))
    assert op7_linededup.dedup(docs.limit(0)).count() == 0


def test_line_runs_tell_new_keys_and_compact(spark):
    runs = op7_linededup.LineRuns(spark, fanout=2)
    make = lambda *keys: spark.createDataFrame([(k, k, 1) for k in keys], "hi long, lo long, docs long")
    assert sorted(r["hi"] for r in runs.append(make(1, 2)).collect()) == [1, 2]
    assert sorted(r["hi"] for r in runs.append(make(2, 3)).collect() if r) in ([3], [])
    assert [r["hi"] for r in runs.append(make(3, 4)).collect()] == [4]
    assert {r["hi"]: r["docs"] for r in runs.totals().collect()} == {1: 1, 2: 2, 3: 2, 4: 1}
    assert len(runs.levels) > 1


def test_quality_statistics_and_trees():
    def slow(text):
        w = re.findall("[^\x20\x09-\x0d]+", text or "")
        windows = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        seen = Counter(windows)
        inside = {k + j for k, x in enumerate(windows) if seen[x] > 1 for j in range(5)}
        lines, dup, before = (text or "").split("\n"), 0, set()
        for x in lines:
            dup += x in before and bool(re.search("[^\x20\x09-\x0d]", x))
            before.add(x)
        return [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(inside)]

    for t in [*texts(), "a b c d e a b c d e", "x\nx\n\n\nx", "é#é ***|", "k " * 30]:
        assert op8_quality.statistics(t)[0] == slow(t)
    r = np.random.default_rng(0)
    x = r.random((800, 3))
    y = ((x[:, 0] + 0.3 * r.random(800)) < 0.6).astype(float)
    model = op8_quality.grow(x, y, [-1, 0, 1], trees=20, depth=3)
    assert ((model.probability(x) > 0.5) == y).mean() > 0.85
    line = np.stack([np.linspace(0, 1, 50), np.full(50, 0.5), np.full(50, 0.5)], 1)
    assert (np.diff(model.margin(line)) <= 1e-12).all()  # falls with a feature that may only fall


def test_quality_verdicts(spark, docs):
    labels = spark.createDataFrame([(k, int(k % 2), 0) for k in range(10)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = by_id(op8_quality.judge(docs, op8_quality.fit(docs, labels)))
    assert all(not g["kept"] for g in got.values() if g["base_failed"]) and got[90]["base_failed"]
    empty = op8_quality.fit(docs, labels.limit(0))
    assert all(g["kept"] != g["base_failed"] for g in by_id(op8_quality.judge(docs, empty)).values())


def test_sharding(spark, docs):
    got = op9_sharding.interleave(docs, shards=4).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(len(texts())))
    sizes = Counter(r["shard"] for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for s in range(4):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sizes[s]))
    for source in ("s0", "s1", "s2", None):
        each = [sum(r["source"] == source for r in got if r["shard"] == s) for s in range(4)]
        assert max(each) - min(each) <= 2
    for r in got:
        raw = (texts()[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
    assert op9_sharding.interleave(docs.limit(0)).count() == 0


def brute_components(rows, percent=75):
    sets, up = {}, {}
    for k, t in rows.items():
        w = re.findall("[^\x20\x09-\x0d]+", (t or "").lower())
        sets[k] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        up[k] = k

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in rows:
        for b in rows:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), root(k)) for k in rows}


def test_prefixes_are_dealt_evenly(spark):
    """Prefixes are the least hashes of a set, so without spreading a quarter of the buckets would get all of them."""
    r = random.Random(8)
    rows = spark.createDataFrame([(k, " ".join(str(r.random()) for _ in range(200))) for k in range(100)], "doc_id long, text string").coalesce(1)
    found = op10_jaccard.dealt_prefixes(op10_jaccard.signatures(rows, 5, 75), 5).collect()
    held = Counter()
    for row in found:
        held[row["bucket"]] += len(unpack(row["tokens"], np.uint64))
    assert sum(held.values()) == 100 * 50 and len(held) == 32 and max(held.values()) < 2 * 5000 / 32


@pytest.mark.parametrize(("bucket", "block"), [(op10_jaccard.BUCKET, op10_jaccard.BLOCK), (40, 3)])
def test_jaccard_join(spark, docs, bucket, block):
    own = dict(enumerate(texts()))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in op10_jaccard.GroupJoin(docs, bucket=bucket, block=block).run().collect()}
    assert got == brute_components(own)


def near_copies(n, words=60, most=16, seed=5):
    """Copies of one text with up to `most` words exchanged: many of the pairs link, others only by a chain or not at all."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for k in rng.sample(range(words), rng.randrange(most) // 4):
            copy[k] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def test_jaccard_join_of_a_dense_group_and_a_chain(spark):
    """A group in which about a part of the pairs link, a chain whose ends don't, and copies that differ in case and layout."""
    step = [" ".join(f"c{j}" for j in range(4 * k, 4 * k + 60)) for k in range(12)]  # each links with the next one only
    rows = dict(enumerate([*near_copies(70), *step, "Same Text of seven words for all", "same  text of seven\nwords for ALL", *near_copies(30, 12, 9, 6)]))
    found = op10_jaccard.GroupJoin(spark.createDataFrame([(k, t) for k, t in rows.items()], "doc_id long, text string"), block=8).run()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()}
    assert got == brute_components(rows)
    assert len({c for _, c in got.values()}) > 5


def test_jaccard_join_of_components_inside_one_group(spark):
    """Families of one text, each with exchanged words of its own: similar enough for one group, linked only inside a family or by a few go-betweens."""
    rng = random.Random(8)
    base = [f"w{k}" for k in range(80)]
    rows = []
    for k in range(9):
        family = list(base)
        for place in rng.sample(range(80), 1 + k % 4):
            family[place] = f"f{k}-{place}"
        for j in range(6):
            copy = list(family)
            for place in rng.sample(range(80), j % 3):
                copy[place] = f"x{k}-{j}-{place}"
            rows.append(" ".join(copy))
    rng.shuffle(rows)
    found = op10_jaccard.GroupJoin(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), block=4).run()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()}
    assert got == brute_components(dict(enumerate(rows)))
    assert len({c for _, c in got.values()}) > 3


def test_jaccard_join_of_odd_ids_and_columns(spark):
    """Repeated rows share a class, one doc_id with two texts is one document with all its links, null ids name nothing, extra columns stay out."""
    a, b = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    rows = [(5, a, 1), (5, a, 1), (7, b, 2), (9, a, 3), (9, b, 3), (None, a, 4), (None, "alone and unseen elsewhere in here", 5), (11, None, 6), (12, " \n", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id long").withColumn("token", F.lit("x")).withColumn("tokens", F.lit(1))
    got = sorted((tuple(r) for r in op10_jaccard.jaccard_components(docs).collect()), key=str)
    assert got == sorted([(5, 36, 5, 4), (5, 36, 5, 4), (7, 36, 5, 2), (9, 36, 5, 4), (9, 36, 5, 2), (None, 36, 5, 4), (None, 2, None, 1), (11, 0, 11, 1), (12, 0, 12, 1)], key=str)


def test_jaccard_join_of_nothing(spark, docs):
    assert op10_jaccard.jaccard_components(docs.limit(0)).count() == 0


def test_language_of_held_out_documents(spark):
    """Accuracy of the registered query on rows that it didn't learn from."""
    sf = "/root/testdata/sf0.01"
    found = queries()["op3_language_id"](spark, sf).where("held_out").select("doc_id", "lang_pred")
    known = spark.read.parquet(f"{sf}/documents.parquet").where("lang is not null and text rlike '\\\\p{L}'").select("doc_id", "lang")
    right, n = found.join(known, "doc_id").agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert n > 250 and right >= 0.98 * n
