"""BPE encoding by backtracking over Aho-Corasick matches, and decoding from an offset table.

The merge rules of a word-level BPE model are turned into two tables: the longest tokens that start at each position
(from one Aho-Corasick pass), and a memo of which two tokens may stand side by side. A sequence of tokens whose
neighbours are all compatible is the one that merging by rank would give, so the encoder takes the longest token that
fits, and goes back a step when none does. Each position is tried once, hence linear time in the piece's length.

Nulls and empty texts give no token. Very long texts are handled word by word, with memory in proportion to the text.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tessera.llm.common import column_list, give_back, prepare, sha256_hex

#: Words, pieces and token pairs that a worker remembers, each in two generations: a full younger one replaces the older.
#: So memory is bounded and frequent words stay; results don't depend on it. At a task's end more than
#: KEPT entries (all together may be 200 MB) go, as the worker process may serve another operator next.
MEMO, KEPT = 200_000, 50_000


class Memo:
    """A bounded memo of two generations around a function of one argument."""

    def __init__(self, function, size: int = MEMO) -> None:
        self.function, self.size, self.young, self.old = function, size, {}, {}

    def clear(self) -> None:
        self.young, self.old = {}, {}

    def __call__(self, key):
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is None:
                found = self.function(key)
            if len(self.young) >= self.size:
                self.old, self.young = self.young, {}
            self.young[key] = found
        return found


_SPACE = regex.compile(r"\s+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself if printable, else 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class WordBpe:
    """Encoder and decoder for a tokenizer file with word ends: NFC, white space dropped, lower case, pattern, byte-level BPE."""

    def __init__(self, definition: str) -> None:
        spec = json.loads(definition)
        model = spec["model"]
        vocab, self.suffix = model["vocab"], model["end_of_word_suffix"]
        self.pattern = regex.compile(next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None

        # A piece is written with one character for each start symbol: byte b, or 256 + b for the byte that ends a word.
        letters = byte_symbols()
        symbol = {c: chr(b) for b, c in enumerate(letters)} | {c + self.suffix: chr(256 + b) for b, c in enumerate(letters)}
        self.base = {symbol[t]: i for t, i in vocab.items() if t in symbol}
        self.left, self.right, self.rank_of = {}, {}, {}
        spelled = {i: s for s, i in self.base.items()}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            token = vocab[a + b]
            pair = (vocab[a], vocab[b])
            self.rank_of[pair] = (rank, token)
            if token not in self.left:
                self.left[token], self.right[token] = pair
                spelled[token] = spelled[pair[0]] + spelled[pair[1]]
        # Only tokens that merging itself reaches can appear in a text: the automaton leaves the others out.
        self.length = {i: len(s) for i, s in spelled.items()}
        self.merge_rank = {t: self.rank_of[(self.left[t], self.right[t])][0] for t in self.left}
        self.compatible = Memo(self._compatible)
        self.piece_memo = Memo(self._piece_ids)
        self.word = Memo(self._word)
        self.automaton = ahocorasick.Automaton()
        for i, s in spelled.items():
            if len(s) == 1 or self.merged(s) == [i]:
                self.automaton.add_word(s, i)
        self.automaton.make_automaton()

        # The offset table: token i is blob[offset[i]:offset[i + 1]], with the blank that separates tokens at its end.
        text = {i: t for t, i in vocab.items()} | {i: t for t, i in special.items()}
        parts = [(text.get(i, "") + " ").encode() for i in range(max(text) + 1)]
        self.offset = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        self.blob = np.frombuffer(b"".join(parts), np.uint8)
        self.decimal = [str(i) for i in range(len(parts))]

    def remembered(self) -> int:
        return sum(len(m.young) + len(m.old) for m in (self.compatible, self.piece_memo, self.word))

    def forget(self) -> None:
        """Empties large memos; the tables, about 40 MB, stay."""
        if self.remembered() > KEPT:
            for memo in (self.compatible, self.piece_memo, self.word):
                memo.clear()

    def merged(self, symbols: str) -> list[int]:
        """Merging by rank, step by step: used for single tokens when the tables are built, and as the tests' yardstick."""
        ids = [self.base[c] for c in symbols]
        while len(ids) > 1:
            rank, at = min(((self.rank_of[p][0], k) for k, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.rank_of), default=(None, 0))
            if rank is None:
                break
            ids[at : at + 2] = [self.rank_of[ids[at], ids[at + 1]][1]]
        return ids

    def _compatible(self, pair: tuple[int, int]) -> bool:
        """Whether two tokens stay apart side by side.

        Undoing merges from the latest rank down, the two tokens that face each other across the border change. Had a
        merge of such a pair a rank below that of the merges undone so far, it would have come first.
        """
        a, b = pair
        until_a = until_b = float("inf")  # the ranks at which the present faces are merged into something larger
        while True:
            pair = self.rank_of.get((a, b))
            # At equal ranks the merge further left goes first: that inside the left token, but not that inside the right one.
            if pair is not None and pair[0] < until_a and pair[0] <= until_b:
                return False
            born_a, born_b = self.merge_rank.get(a, -1), self.merge_rank.get(b, -1)
            if born_a < 0 and born_b < 0:
                return True
            if born_a > born_b:
                until_a, a = born_a, self.right[a]
            else:
                until_b, b = born_b, self.left[b]

    def piece(self, symbols: str) -> list[int]:
        """Ids of one piece. Aho-Corasick gives the tokens that start at each place; the longest that fits is taken first."""
        compatible = self.compatible
        ids = [token for _, token in self.automaton.iter_long(symbols)]
        if all(map(compatible, pairwise(ids))):
            return ids  # nowhere did the longest token have to give way
        n = len(symbols)
        starts: list[list[int]] = [[] for _ in range(n)]
        length = self.length
        for end, token in self.automaton.iter(symbols):
            starts[end + 1 - length[token]].append(token)
        for found in starts:  # in the order of their ends, so the longest is last
            if not found:
                raise ValueError("a symbol is missing in the vocabulary")
        ids = []
        left = [0] * (n + 1)  # how many of a place's tokens are still to be tried
        dead = bytearray(n + 1)  # places from which no end was reached
        at, fresh = 0, True
        while at < n:
            tokens = starts[at]
            k = len(tokens) if fresh else left[at]
            fresh = True
            while k:
                k -= 1
                token = tokens[k]
                if not dead[at + length[token]] and (not ids or compatible((ids[-1], token))):
                    break
            else:
                if not ids:
                    raise ValueError("no sequence of tokens fits")
                dead[at] = 1
                at -= length[ids.pop()]
                fresh = False
                continue
            left[at] = k
            ids.append(token)
            at += length[token]
        return ids

    def _piece_ids(self, piece: str) -> list[int]:
        raw = piece.encode("utf-8")
        return self.piece(raw[:-1].decode("latin-1") + chr(256 + raw[-1]))

    def _word(self, word: str) -> tuple[bytes, str]:
        """Ids of a text without white space: as 32-bit numbers, and in decimals joined by blanks."""
        ids: list[int] = []
        for part in self.special_pattern.split(word) if self.special_pattern and "<" in word else (word,):
            if part in self.special:
                ids.append(self.special[part])
            elif part.isascii() and part.isalpha():
                ids += self.piece_memo(part.lower())
            elif part:
                normal = part if part.isascii() else unicodedata.normalize("NFC", part)
                normal = normal.lower() if normal.isascii() else "".join([c.lower() for c in normal])
                for piece in self.pattern.findall(normal):
                    ids += self.piece_memo(piece) if len(piece) <= 64 else self._piece_ids(piece)
        return array("I", ids).tobytes(), " ".join([self.decimal[i] for i in ids])

    def encode_joined(self, text: str) -> tuple[np.ndarray, str]:
        """Ids of a text, as an array and in decimals joined by blanks. No piece spans white space, so words are independent."""
        words = text.split() if not any(c in text for c in "\x1c\x1d\x1e\x1f") else _SPACE.split(text)
        known, word = self.word.young, self.word
        found = [known.get(w) or (word(w) if len(w) <= 64 else self._word(w)) for w in words]
        return np.frombuffer(b"".join([f[0] for f in found]), np.uint32), " ".join([f[1] for f in found if f[1]])

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_joined(text or "")[0]

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """Token texts joined by blanks, in UTF-8: one gather from the blob by the offset table."""
        if not len(ids):
            return b""
        out = []
        for k in range(0, len(ids), 1 << 16):  # bounds the index array of long texts
            part = ids[k : k + (1 << 16)].astype(np.int64)
            start, size = self.offset[part], self.offset[part + 1] - self.offset[part]
            ends = np.cumsum(size)
            index = np.arange(ends[-1]) + np.repeat(start - ends + size, size)
            out.append(self.blob[index].tobytes())
        return b"".join(out)[:-1]

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(np.asarray(ids)).decode("utf-8")


_LOADED: dict[str, WordBpe] = {}


def loaded(key: str, definition: str) -> WordBpe:
    """One encoder for each worker process and tokenizer."""
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = WordBpe(definition)
    return _LOADED[key]


def encode_documents(docs: DataFrame, tokenizer_path: str, keep_ids: bool = False, keep_decoded: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text; on demand also ids and the decoded text.

    `tokenizer_path` is read on the driver and broadcast (its size is that of the vocabulary, whatever the corpus).
    Repeated and null doc_ids are kept row by row; columns of other names are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    key, shared = sha256_hex(definition.encode()), spark.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(key, shared.value)
        for batch in batches:
            n, ids_sha, decoded_sha, all_ids, all_text = [], [], [], [], []
            for text in column_list(batch, "text"):
                ids, joined = bpe.encode_joined(text or "")
                decoded = bpe.decode_bytes(ids)
                n.append(len(ids))
                ids_sha.append(sha256_hex(joined.encode()))
                decoded_sha.append(sha256_hex(decoded))
                if keep_ids:
                    all_ids.append(ids.astype(np.int32))
                if keep_decoded:
                    all_text.append(decoded.decode("utf-8"))
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns, names = [*columns, pa.array(all_ids, pa.list_(pa.int32()))], [*names, "ids"]
            if keep_decoded:
                columns, names = [*columns, pa.array(all_text, pa.string())], [*names, "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)
        bpe.forget()
        give_back()

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids + ", decoded string" * keep_decoded
    return docs.select("doc_id", "text").mapInArrow(run, schema)
