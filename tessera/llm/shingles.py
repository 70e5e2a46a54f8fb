"""Word shingles of many texts at once, as sorted sets of 64-bit hashes, and the blobs in which hashes travel to their buckets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

#: Bytes of text that are hashed at once.
PIECE = 1 << 20

_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(71).integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_BYTE[_SPACES] = 0
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
_FACTORS = [np.random.default_rng(72).integers(0, 1 << 64, 1 << 12, dtype=np.uint64) | np.uint64(1)]


def _factors(n: int) -> np.ndarray:
    """A factor for each place in a word; a longer table begins with the shorter one."""
    if n > len(_FACTORS[0]):
        _FACTORS[0] = np.random.default_rng(72).integers(0, 1 << 64, 1 << n.bit_length(), dtype=np.uint64) | np.uint64(1)
    return _FACTORS[0]


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words `[^\\x20\\x09-\\x0D]+`, A-Z taken as a-z, where each begins, and their lengths."""
    data = np.frombuffer(raw, np.uint8)
    inside = np.concatenate([[False], ~_SPACES[data], [False]])
    starts = np.flatnonzero(inside[1:-1] & ~inside[:-2])
    if not len(starts):
        return np.zeros(0, np.uint64), starts, starts
    lengths = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1 - starts
    first = int(starts[0])
    place = np.arange(first, len(data)) - np.repeat(starts, np.diff(starts, append=len(data)))
    parts = _BYTE.take(data[first:]) * _factors(int(lengths.max())).take(place, mode="clip")  # white space adds nothing
    out = np.add.reduceat(parts, starts - first)
    out ^= out >> np.uint64(32)
    out *= _ODD[0]
    out ^= out >> np.uint64(29)
    return out, starts, lengths


def pieces(raws: list[bytes]) -> Iterator[tuple[bytes, np.ndarray, list[int]]]:
    """Bytes of some texts, where each begins, and their numbers. Texts beyond PIECE are cut at white space."""
    held, numbers, size = [], [], 0
    for k, raw in enumerate(raws):
        at = 0
        while len(raw) - at > PIECE:
            end = at + PIECE
            while end < len(raw) and not _SPACES[raw[end]]:
                end += 1
            yield raw[at:end], np.zeros(1, np.int64), [k]
            at = end
        held.append(raw[at:] if at else raw)
        numbers.append(k)
        size += len(held[-1]) + 1
        if size >= PIECE:
            yield b"\n".join(held), np.cumsum([0, *(len(h) + 1 for h in held[:-1])]), numbers
            held, numbers, size = [], [], 0
    if held:
        yield b"\n".join(held), np.cumsum([0, *(len(h) + 1 for h in held[:-1])]), numbers


def token_sets(raws: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingle sets of all texts one behind the other, each in rising order (int64), and their sizes.

    A text with fewer words than `width` has its whole sequence as the one shingle, one without words an empty set.
    """
    hashes, words = [], np.zeros(len(raws), np.int64)
    for raw, begins, numbers in pieces(raws):
        found, starts, _ = word_hashes(raw)
        hashes.append(found)
        cut = np.append(np.searchsorted(starts, begins), len(starts))
        np.add.at(words, numbers, np.diff(cut))
    every = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(raws)), words)
    n = max(len(every) - width + 1, 0)
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out ^= every[j : j + n]
        out *= _ODD[j % len(_ODD)]
        out ^= out >> np.uint64(32)
    whole = owner[:n] == owner[width - 1 : width - 1 + n]
    tokens, owner = out[whole].view(np.int64), owner[:n][whole]
    ends = np.cumsum(np.maximum(words - width + 1, 0))
    begin = 0
    for end in ends.tolist():
        tokens[begin:end].sort()
        begin = end
    keep = np.ones(len(tokens), bool)
    keep[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
    tokens, sizes = tokens[keep], np.bincount(owner[keep], minlength=len(raws))
    short = np.flatnonzero((words > 0) & (words < width))
    if len(short):
        first = np.cumsum(words) - words
        alone = []
        for k in short.tolist():
            code = np.uint64(words[k])
            with np.errstate(over="ignore"):
                for h in every[first[k] : first[k] + words[k]]:
                    code = (code ^ h) * _ODD[1]
                    code ^= code >> np.uint64(32)
            alone.append(code)
        tokens = np.insert(tokens, (np.cumsum(sizes) - sizes)[short], np.array(alone, np.uint64).view(np.int64))
        sizes[short] = 1
    return tokens, sizes


_PACK, _UNPACK = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes."""
    return _PACK.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes())


def unpack(raw: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(_UNPACK.decompress(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


class Dealer:
    """Collects sets and deals their tokens to 2 ** bits buckets by the first bits: rows of (bucket, tokens, owners, ids, sizes)."""

    HELD = 1 << 20

    def __init__(self, bits: int) -> None:
        self.bits = bits
        self.clear()

    def clear(self) -> None:
        self.ids, self.sizes, self.tokens, self.counts, self.held, self.known = [], [], [], [], 0, set()

    def add(self, number: int, size: int, tokens: np.ndarray) -> None:
        """A set's tokens; equal ids have equal sets, so the second one adds nothing."""
        if number not in self.known and len(tokens):
            self.known.add(number)
            self.ids.append(number)
            self.sizes.append(size)
            self.tokens.append(tokens)
            self.counts.append(len(tokens))
            self.held += len(tokens)

    def full(self) -> bool:
        return self.held >= self.HELD

    def rows(self) -> list[dict]:
        if not self.ids:
            return []
        tokens = np.concatenate(self.tokens).view(np.uint64)
        owner = np.repeat(np.arange(len(self.ids), dtype=np.uint32), self.counts)
        ids, sizes = np.array(self.ids, np.int64), np.array(self.sizes, np.int64)
        order = np.argsort(tokens)
        tokens, owner = tokens[order], owner[order]
        cuts = np.searchsorted(tokens, np.arange(1, 1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)) if self.bits else []
        out, low = [], 0
        for bucket, high in enumerate([*cuts, len(tokens)]):
            if high > low:
                mine, at = np.unique(owner[low:high], return_inverse=True)
                out.append({"bucket": bucket, "tokens": pack(np.diff(tokens[low:high], prepend=np.uint64(0))), "owners": pack(at.astype(np.uint32)), "ids": ids[mine].tobytes(), "sizes": pack(sizes[mine].astype(np.uint64))})
            low = high
        self.clear()
        return out


DEALT = "bucket int, tokens binary, owners binary, ids binary, sizes binary"


def shared(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """token, id, size, number of the token and how many ids hold it, for all tokens of a bucket that two ids hold; by token and id."""
    tokens, ids, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for row in zip(*(table.column(c) for c in ("tokens", "owners", "ids", "sizes")), strict=True):
        deltas, owners, own, size = (v.as_py() for v in row)
        owners = unpack(owners, np.uint32)
        tokens.append(np.cumsum(unpack(deltas, np.uint64), dtype=np.uint64))
        ids.append(np.frombuffer(own, np.int64)[owners])
        sizes.append(unpack(size, np.uint64).view(np.int64)[owners])
    token = np.concatenate(tokens)
    order = np.argsort(token)
    token = token[order]
    times = np.diff(np.flatnonzero(np.append(True, token[1:] != token[:-1])[: len(token)]), append=len(token))
    several = np.repeat(times > 1, times)
    order, token = order[several], token[several]
    number, size = np.concatenate(ids)[order], np.concatenate(sizes)[order]
    order = np.lexsort((number, token))
    token, number, size = token[order], number[order], size[order]
    once = np.append(True, (token[1:] != token[:-1]) | (number[1:] != number[:-1]))[: len(token)]
    token, number, size = token[once], number[once], size[once]
    first = np.append(True, token[1:] != token[:-1])[: len(token)]
    times = np.diff(np.flatnonzero(first), append=len(token))
    held, which = np.repeat(times, times), np.repeat(np.arange(len(times)), times)
    several = held > 1
    return token[several].view(np.int64), number[several], size[several], which[several], held[several]
