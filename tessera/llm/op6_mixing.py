"""Language-model scoring by online logistic context mixing.

A text is scored as a sequence of symbols: its lower-cased words, where the VOCABULARY most frequent training words are symbols
and others are spelled (an escape, their bytes, a blank), and an end symbol. Each symbol is a path of binary decisions: the
Huffman code of the words' counts in all training texts, or the eight bits of a byte. Each decision has several predictions: one of
the node alone and one for each of ORDERS, the counts that followed the hash of the last one or three symbols at this node.
Stretched predictions are added up with weights chosen by a gate (depth in the path, and which contexts are known), squashed, and
refined by an adaptive map from the mixed prediction to the observed share. Weights and map move on with the text in steps of
STEP symbols, each step being scored before all of its decisions are learned; the texts of a chunk are stepped through side by
side, each with weights and map of its own. The sum of -log2 over all decisions is the text's bits.

What is gathered grows with the corpus and never meets in one place. Texts are cut into chunks of about CHUNK symbols. A chunk
asks for its distinct (context, symbol) pairs with their counts; pairs are dealt to buckets by the context's hash (40 bits),
about BUCKET pairs each, a bucket sums the counts of all chunks, forms the predictions along each symbol's path, and answers
every chunk with those that it asked for, positive where the symbol's own bit is expected: so the end of most paths is one
repeated prediction, which is sent once. A pair goes to a bucket once for each chunk however often it occurs.

Learning: the counts, the code and the vocabulary come from all training texts. Weights and map are learned from a fold of them that
grows with the corpus (one text in FOLD, by a hash of its symbols, so equal texts go together), predicted from the counts of all
others: each chunk fits the weights of its gates by Newton steps, and their means by decisions are the model's.

`base_score` is the unigram yardstick: word counts of all training texts; the vocabulary's go to every task, those of words above
a share of the tokens, few by arithmetic, too; the others meet their counts in a shuffle join by a 64-bit hash.

Defined results: null or empty texts are the end symbol alone; without training texts all predictions are even; repeated
rows are scored each by itself; a text's score depends on that text and the model only, not on its neighbours.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, column_list, lower_ascii_bytes, prepare, utf8
from tessera.llm.shingles import pack, pieces, unpack, word_hashes

ORDERS = (1, 3)  # contexts: so many symbols before
INPUTS = 1 + len(ORDERS)
VOCABULARY = 1 << 18
SLOT = 19
GATES, CELLS, LIMIT = 32, 33, 12
STEP, STEPS = 32, 16  # symbols after which a text's own weights and map adapt, and steps whose decisions are laid out at once
FOLD = 16
CHUNK, BUCKET = 600_000, 2_000_000
#: Texts that are scored side by side, few enough for what they use to stay in the cache.
ABREAST = 64
#: Parts of the buckets, and of the chunks, that are shuffled one after the other, so that little lies on disk at a time. A part of
#: the chunks finds its answers in folders of their own, which go when it is scored.
PARTS, SHARES = 4, 8
#: Pace of a text's own weights.
RATE = 0.02

#: A word with at least this share of the training tokens is known to every task: at most 1 / share words.
FREQUENT_SHARE = 1 / 1_000_000

_END_KEY = xxhash.xxh3_64_intdigest(b"\x00 end of text")  # holds a blank, so it is no word


# -- symbols and their code


@dataclass
class Code:
    """Vocabulary and binary paths. Symbols 0 to words - 1 are the tree's leaves from left to right, words + b is byte b."""

    keys: np.ndarray  # hashes of the vocabulary's words, rising
    slots: np.ndarray  # where the keys with each of the possible first SLOT bits begin
    symbol: np.ndarray  # of each key
    escape: int
    end: int
    words: int
    start: np.ndarray  # the path of s is at start[s] to start[s] + length[s]
    length: np.ndarray
    node: np.ndarray
    bit: np.ndarray
    plain: np.ndarray  # the node's own logit in sixteenths
    along: np.ndarray  # for each decision of a path in one number: twice the logit towards its own bit, that bit times 8, the depth up to 7

    @classmethod
    def huffman(cls, keys: np.ndarray, counts: np.ndarray, escapes: int, ends: int) -> Code:
        every = [*counts.tolist(), escapes, ends]
        heap = [(c + 1, s) for s, c in enumerate(every)]
        heapq.heapify(heap)
        sons: list[tuple[int, int]] = []
        while len(heap) > 1:
            (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
            heapq.heappush(heap, (a + b, len(every) + len(sons)))
            sons.append((x, y))
        total = np.zeros(len(every) + len(sons), np.int64)
        total[: len(every)] = every
        for k, (x, y) in enumerate(sons):
            total[len(every) + k] = total[x] + total[y]
        start, length, node, bit, leaves = [], [], [], [], []
        stack: list[tuple[int, list[int], list[int]]] = [(heap[0][1], [], [])]
        while stack:
            at, nodes, bits = stack.pop()
            if at < len(every):
                leaves.append(at)
                start.append(len(node))
                length.append(len(bits))
                node += nodes
                bit += bits
            else:
                k = at - len(every)
                stack.append((sons[k][1], [*nodes, k], [*bits, 1]))
                stack.append((sons[k][0], [*nodes, k], [*bits, 0]))
        for byte in range(256):
            start.append(len(node))
            length.append(8)
            node += [len(sons) + (1 << d) - 1 + (byte >> (8 - d)) for d in range(8)]
            bit += [byte >> (7 - d) & 1 for d in range(8)]
        plain = np.zeros(len(sons) + 255, np.float32)
        for k, (x, y) in enumerate(sons):
            plain[k] = stretch(total[x], total[y])
        place = np.empty(len(every), np.int64)
        place[leaves] = np.arange(len(every))
        order = np.argsort(keys)
        start, length, node, bit = np.array(start), np.array(length), np.array(node, np.int32), np.array(bit, np.uint8)
        depth = np.arange(len(node)) - np.repeat(start, length)
        along = plain.take(node).astype(np.int16) * sign_of(bit) * np.int16(2) + bit * np.int16(8) + np.minimum(depth, GATES // 4 - 1).astype(np.int16)
        keys = keys[order].astype(np.uint64)
        slots = np.searchsorted(keys, np.arange(1 << SLOT, dtype=np.uint64) << np.uint64(64 - SLOT))
        return cls(keys, slots.astype(np.int32), place[:-2][order], int(place[-2]), int(place[-1]), len(every), start, length, node, bit, plain, along)


def key_places(wanted: np.ndarray, code: Code) -> np.ndarray:
    """`np.searchsorted(code.keys, wanted)` by the slots of the first bits, as hashes lie evenly."""
    at = code.slots.take((wanted >> np.uint64(64 - SLOT)).astype(np.int64)).astype(np.int64)
    late = np.flatnonzero(at < len(code.keys))
    while len(late):
        late = late[code.keys.take(at.take(late)) < wanted.take(late)]
        at[late] += 1
        late = late[at.take(late) < len(code.keys)]
    return at


def stretch(zeros, ones):
    """Logit of the share of ones in sixteenths, to a half, so that answers are short. Unseen contexts say nothing (0)."""
    return (8 * np.clip(np.rint(2 * np.log((ones + 0.05) / (zeros + 0.05))), -15, 15)).astype(np.int8)


def words_of(raws: list[bytes]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of the texts with their words' hashes, places and lengths and the number of the text that each is in."""
    for raw, begins, numbers in pieces(raws):
        found, starts, lengths = word_hashes(raw)
        cut = np.append(np.searchsorted(starts, begins), len(starts))
        yield raw, found, starts, lengths, np.repeat(np.array(numbers, np.int64), np.diff(cut))


def symbols_of(raws: list[bytes], code: Code, words: list[tuple] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all texts one behind the other, and where each text ends. `words`: what `words_of` gives for the texts."""
    parts, owners = [], []
    for raw, found, starts, lengths, owner in words_of(raws) if words is None else words:
        at = np.minimum(key_places(found, code), max(len(code.keys) - 1, 0))
        known = code.keys[at] == found if len(code.keys) else np.zeros(len(found), bool)
        times = np.where(known, 1, lengths + 2)
        out = np.full(int(times.sum()), code.escape, np.int64)
        first = np.cumsum(times) - times
        out[first[known]] = code.symbol[at[known]]
        low = np.frombuffer(lower_ascii_bytes(raw), np.uint8)
        out[spread(first[~known] + 1, lengths[~known])] = low[spread(starts[~known], lengths[~known])] + np.int64(code.words)
        out[first[~known] + 1 + lengths[~known]] = code.words + 32
        parts.append(out)
        owners.append(np.repeat(owner, times))
    symbols = np.concatenate([np.zeros(0, np.int64), *parts])
    size = np.bincount(np.concatenate([np.zeros(0, np.int64), *owners]), minlength=len(raws))
    symbols = np.insert(symbols, np.cumsum(size), code.end)
    return symbols.astype(np.uint32), np.cumsum(size + 1)


def pairs_of(symbols: np.ndarray, ends: np.ndarray, order: int) -> np.ndarray:
    """For each symbol the pair of its context, the `order` symbols before it in its text, and itself: 40 bits of a hash and 24."""
    wide = symbols.astype(np.uint64)
    wide += np.uint64(1)
    begins = ends - np.diff(ends, prepend=0)
    context = np.full(len(symbols), order, np.uint64)
    for k in range(1, order + 1):
        before = np.zeros(len(symbols), np.uint64)
        before[k:] = wide[: max(len(symbols) - k, 0)]
        lead = begins[:, None] + np.arange(k)
        before[lead[lead < ends[:, None]]] = 0  # before the text
        context ^= before
        context *= np.uint64(0x9E3779B97F4A7C15)
        context ^= context >> np.uint64(32)
    context *= np.uint64(0xBF58476D1CE4E5B9)
    context ^= context >> np.uint64(29)
    return context >> np.uint64(24) << np.uint64(24) | symbols.astype(np.uint64)


# -- predictions of a bucket


#: What a context says along the path of the only symbol that it has, by how often it had that symbol.
_ALONE = np.append(0, stretch(0, np.arange(1, 128))).astype(np.int8)


def path_parts(pairs: np.ndarray, times: np.ndarray, code: Code) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For distinct pairs in rising order the stretched predictions (int8) along each pair's path, positive where they say the path's own bit.

    Given are how many predictions are the pair's own, the one that repeats from there on, and the own ones one behind the other.
    The symbols of a context come in the order of the tree's leaves, so the pairs under a node are neighbours: `first` marks where a
    node's pairs begin, and one step down the path it also marks where the bit changes. From the node on where a pair is alone, as
    most are from the root, all predictions are the same.
    """
    symbol = (pairs & np.uint64(0xFFFFFF)).astype(np.int64)
    context = pairs >> np.uint64(24)
    length = code.length[symbol]
    tails = _ALONE[np.minimum(times, len(_ALONE) - 1)]
    first = np.append(True, context[1:] != context[:-1])[: len(pairs)]
    at = np.flatnonzero((length > 0) & ~(first & np.append(first[1:], True)[: len(pairs)]))
    start, length, first, n = code.start[symbol[at]], length[at], first[at], times[at].astype(np.int64)
    heads, walked, depth = np.zeros(len(pairs), np.uint8), [], 0
    while len(start):
        bit = code.bit.take(start + depth)
        begins = np.flatnonzero(first)
        total = np.add.reduceat(n, begins)
        ones = np.add.reduceat(n * bit, begins)
        said = np.repeat(np.where(total > 0, stretch(total - ones, ones), 0).astype(np.int8), np.diff(begins, append=len(n)))
        walked.append((at, said * sign_of(bit)))
        first[1:] |= bit[1:] != bit[:-1]
        depth += 1
        heads[at] = depth
        stay = np.flatnonzero((length > depth) & ~(first & np.append(first[1:], True)))
        start, at, length, first, n = (some.take(stay) for some in (start, at, length, first, n))
    begin = np.cumsum(heads, dtype=np.int64) - heads
    body = np.empty(int(heads.sum(dtype=np.int64)), np.int8)
    for depth, (at, said) in enumerate(walked):
        body[begin[at] + depth] = said
    return heads, tails, body


def whole_paths(heads: np.ndarray, tails: np.ndarray, body: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The predictions of `path_parts` written out, for paths of these lengths."""
    out = np.repeat(tails, length)
    own = np.flatnonzero(heads)
    out[spread((np.cumsum(length) - length)[own], heads[own].astype(np.int64))] = body
    return out


def path_agreements(pairs: np.ndarray, times: np.ndarray, code: Code) -> np.ndarray:
    """The same along whole paths, one behind the other."""
    return whole_paths(*path_parts(pairs, times, code), code.length[(pairs & np.uint64(0xFFFFFF)).astype(np.int64)])


def sent(parts: tuple[np.ndarray, np.ndarray, np.ndarray], begin: np.ndarray, places: np.ndarray) -> bytes:
    """The parts of the pairs at these places, packed; `begin`: where each pair's own predictions begin."""
    heads, tails, body = parts
    mine = heads[places]
    some = mine > 0
    return np.uint32(len(places)).tobytes() + pack(np.concatenate([mine.view(np.int8), tails[places], body[spread(begin[places[some]], mine[some].astype(np.int64))]]))


def received(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, values = int(np.frombuffer(raw[:4], np.uint32)[0]), unpack(raw[4:], np.int8)
    return values[:n].view(np.uint8), values[n : 2 * n], values[2 * n :]


def path_predictions(pairs: np.ndarray, times: np.ndarray, code: Code) -> np.ndarray:
    """The same, positive where a one is expected."""
    symbol = (pairs & np.uint64(0xFFFFFF)).astype(np.int64)
    return path_agreements(pairs, times, code) * sign_of(code.bit[spread(code.start[symbol], code.length[symbol])])


def sign_of(bit: np.ndarray) -> np.ndarray:
    return 2 * bit.astype(np.int8) - np.int8(1)


def distinct(values: np.ndarray, kind: str = "stable") -> tuple[np.ndarray, np.ndarray]:
    """`np.unique` with the inverse; the stable sort merges runs which are in order already."""
    order = np.argsort(values, kind=kind)
    rising = values[order]
    first = np.append(True, rising[1:] != rising[:-1])[: len(rising)]
    which = np.empty(len(values), np.int64)
    which[order] = np.cumsum(first) - 1
    return rising[first], which


def chunk_pairs(symbols: np.ndarray, ends: np.ndarray, kinds: np.ndarray, order: int, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A chunk's distinct pairs of a part (the first two bits) in rising order, and their times in training texts and in those of the fold."""
    pairs = pairs_of(symbols, ends, order)
    mine = pairs >> np.uint64(62) == part
    # The bits of the part make room for the kind, so one sort of plain numbers is enough.
    keyed = np.sort(pairs[mine] << np.uint64(2) | np.repeat(kinds, np.diff(ends, prepend=0))[mine])
    pairs, kind = keyed >> np.uint64(2), keyed & np.uint64(3)
    begins = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)])
    last = np.append(begins, len(pairs))
    times, folded = (np.diff(np.append(0, np.cumsum(some))[last]).astype(np.uint32) for some in (kind > 0, kind > 1))
    return pairs[begins] | np.uint64(part) << np.uint64(62), times, folded


_ASKED = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int32()), ("pairs", pa.binary()), ("times", pa.binary()), ("folded", pa.binary())])


def asked_pairs(chunks: DataFrame, bits: int, part: int) -> DataFrame:
    """Each chunk's pairs of a part with their times, dealt to buckets, 2 ** bits in all parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, symbols, ends, kinds in zip(*(batch.column(k) for k in range(4)), strict=True):
                symbols, ends, kinds = unpack(symbols.as_py(), np.uint32), np.frombuffer(ends.as_py(), np.int64), np.frombuffer(kinds.as_py(), np.uint8)
                for kind, order in enumerate(ORDERS):
                    pairs, times, folded = chunk_pairs(symbols, ends, kinds, order, part)
                    cuts = np.searchsorted(pairs, np.arange((1 << bits) + 1, dtype=np.uint64)[:-1] << np.uint64(64 - bits))
                    rows = []
                    for bucket, (low, high) in enumerate(zip(cuts, [*cuts[1:], len(pairs)], strict=True)):
                        if high > low:
                            rows.append({"bucket": bucket, "chunk": chunk.as_py(), "kind": kind, "pairs": pack(np.diff(pairs[low:high], prepend=np.uint64(0))), "times": pack(times[low:high]), "folded": pack(folded[low:high])})
                    yield pa.RecordBatch.from_pylist(rows, _ASKED)

    return chunks.select("chunk", "symbols", "ends", "kinds").mapInArrow(run, "bucket int, chunk long, kind int, pairs binary, times binary, folded binary")


def answers(asked: DataFrame, code) -> DataFrame:
    """(chunk, kind, bucket, known, taught): agreements for each chunk's pairs, and for those of the fold without the fold's counts."""

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        coded = code.value
        kinds = table.column("kind").to_numpy()
        out = []
        for kind in range(len(ORDERS)):
            mine = np.flatnonzero(kinds == kind)
            if not len(mine):
                continue
            own, all_times, all_folded = [], [], []
            for k in mine.tolist():
                own.append(np.cumsum(unpack(table.column("pairs")[k].as_py(), np.uint64), dtype=np.uint64))
                all_times.append(unpack(table.column("times")[k].as_py(), np.uint32))
                all_folded.append(unpack(table.column("folded")[k].as_py(), np.uint32))
            pairs, which = distinct(np.concatenate(own))
            times, folded = (np.bincount(which, np.concatenate(t), len(pairs)).astype(np.int64) for t in (all_times, all_folded))
            known = path_parts(pairs, times, coded)
            begin = np.cumsum(known[0], dtype=np.int64) - known[0]
            # Only contexts that the fold holds are asked for without it.
            context = pairs >> np.uint64(24)
            begins = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
            apart = np.repeat(np.add.reduceat(folded, begins) > 0, np.diff(begins, append=len(pairs)))
            taught, number = path_parts(pairs[apart], (times - folded)[apart], coded), np.cumsum(apart) - 1
            taught_begin = np.cumsum(taught[0], dtype=np.int64) - taught[0]
            at = 0
            for k, mine_pairs, mine_folded in zip(mine.tolist(), own, all_folded, strict=True):
                places = which[at : at + len(mine_pairs)]
                at += len(mine_pairs)
                teaching = places[mine_folded > 0]
                out.append({"chunk": table.column("chunk")[k].as_py(), "kind": kind, "bucket": key[0].as_py(), "known": sent(known, begin, places), "taught": sent(taught, taught_begin, number[teaching])})
        return pa.Table.from_pylist(out, pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("known", pa.binary()), ("taught", pa.binary())]))

    return asked.groupBy("bucket").applyInArrow(answer, "chunk long, kind int, bucket int, known binary, taught binary")


def spread(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The places begin[k] to begin[k] + length[k], for all k one behind the other."""
    at = np.repeat(begin - (np.cumsum(length) - length), length)
    at += np.arange(len(at))
    return at


# -- mixing


@dataclass
class Mixer:
    """What chunks share: gated weights (GATES, INPUTS) and the map's probabilities (GATES, CELLS)."""

    weights: np.ndarray
    refine: np.ndarray

    @classmethod
    def fresh(cls) -> Mixer:
        weights = np.tile(np.array([0.3, 0.3, 0.5], np.float32), (GATES, 1))
        cells = 1 / (1 + np.exp(-np.linspace(-8, 8, CELLS)))
        return cls(weights, np.tile(cells.astype(np.float32), (GATES, 1)))


@dataclass
class Decisions:
    """The decisions of some symbols in order: inputs (float32, positive where they say the path's own bit), gate (int8), bit, and how many each symbol has."""

    inputs: list[np.ndarray]
    gate: np.ndarray
    bit: np.ndarray
    length: np.ndarray

    @classmethod
    def of(cls, symbols: np.ndarray, places: list[np.ndarray], predictions: list[np.ndarray], code: Code) -> Decisions:
        """`places`: for each kind where a symbol's predictions begin."""
        length = code.length.take(symbols)
        begin = np.cumsum(length) - length
        turn = np.arange(int(length.sum()))
        along = code.along.take(np.repeat(code.start.take(symbols) - begin, length) + turn)
        gate = (along & np.int16(7)).astype(np.int8)
        inputs = [(along >> np.int16(4)).astype(np.float32) * np.float32(8)]
        for k in range(len(ORDERS)):
            said = predictions[k].take(np.repeat(places[k] - begin, length) + turn)
            gate += (said != 0).view(np.int8) * np.int8(GATES // 4 << k)
            inputs.append(said.astype(np.float32))
        return cls(inputs, gate, (along >> np.int16(3)).astype(np.uint8) & np.uint8(1), length)


def cell_of(mixed: np.ndarray) -> np.ndarray:
    """The map's cell for a mixed prediction."""
    at = mixed + 8
    at *= (CELLS - 1) / 16
    at += 0.5
    np.maximum(at, 0, out=at)
    np.minimum(at, CELLS - 0.5, out=at)
    return at.astype(np.int64)


def bits_of(texts: list[int], ends: np.ndarray, symbols: np.ndarray, places: list[np.ndarray], predictions: list[np.ndarray], code: Code, model: Mixer, rate: float = RATE, adapt: bool = True) -> np.ndarray:
    """Total bits of the texts with these numbers. Weights and map of each start from the model's and adapt step by step, apart from the others'."""
    lengths = np.diff(ends, prepend=0)[texts]
    order = np.argsort(-lengths, kind="stable")  # texts of like lengths side by side, and those which still go on are the first ones
    out = np.empty(len(texts))
    for low in range(0, len(texts), ABREAST):
        some = order[low : low + ABREAST]
        out[some] = _bits_abreast(ends[np.asarray(texts)[some]] - lengths[some], lengths[some], symbols, places, predictions, code, model, rate, adapt)
    return out


def _bits_abreast(first: np.ndarray, lengths: np.ndarray, symbols: np.ndarray, places: list[np.ndarray], predictions: list[np.ndarray], code: Code, model: Mixer, rate: float, adapt: bool) -> np.ndarray:
    """Total bits of the texts that begin at `first`, longest first."""
    total = np.zeros(len(first))
    weights = np.zeros((len(first), GATES, 4), np.float32)
    weights[:, :, :INPUTS] = model.weights.astype(np.float32) / np.float32(16)
    weights = weights.reshape(-1, 4)
    wide = weights.view(np.complex128).ravel()  # a gate's weights are fetched at once
    refine = np.tile(model.refine.astype(np.float64).ravel(), len(first))
    share = 1 / (60 + np.arange(STEP * int(code.length.max(initial=0)) + 1))  # a step of a text has no more decisions
    for begin in range(0, int(lengths.max(initial=0)), STEP * STEPS):
        on = int((lengths > begin).sum())
        size = np.minimum(lengths[:on] - begin, STEP * STEPS)
        owner = np.repeat(np.arange(on), size)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
        step = (inside // STEP).astype(np.int16)
        turn = np.argsort(step, kind="stable")  # by step, text and place in the text
        here, text = (first[owner] + begin + inside)[turn], owner[turn]
        d = Decisions.of(symbols[here], [p[here] for p in places], predictions, code)
        gates = np.repeat(text * GATES, d.length) + d.gate
        corners = gates * CELLS
        sign, zero = sign_of(d.bit).astype(np.float32), (d.bit == 0).astype(np.float64)
        symbol_stops = np.cumsum(np.bincount(step))
        stops = np.append(0, np.cumsum(d.length))[symbol_stops]
        cost, low = np.empty(len(gates)), 0
        for high, last in zip(stops.tolist(), text[symbol_stops - 1].tolist(), strict=True):
            now, low = slice(low, high), high
            if now.stop == now.start:
                continue
            g, x = gates[now], [i[now] for i in d.inputs]
            w = wide.take(g).view(np.float32).reshape(-1, 4)
            mixed = w[:, 0] * x[0]
            for j in range(1, INPUTS):
                mixed += w[:, j] * x[j]
            np.maximum(mixed, np.float32(-LIMIT), out=mixed)
            np.minimum(mixed, np.float32(LIMIT), out=mixed)
            chance = np.exp(-mixed)  # of the own bit
            chance += 1
            np.reciprocal(chance, out=chance)
            mixed *= sign[now]
            cell = cell_of(mixed) + corners[now]
            mapped = refine.take(cell)
            mapped -= zero[now]
            own = np.abs(mapped, out=mapped)
            np.add(own, chance, out=cost[now])
            if not adapt:
                continue
            # A step along the mean slope of each gate of each text, and the map's cells towards the observed share.
            error, most = 1 - chance, (last + 1) * GATES
            pace = rate / 256 / np.sqrt(np.maximum(np.bincount(g, minlength=most), 1))
            for j in range(INPUTS):
                slope = np.zeros(most, np.float32)
                np.add.at(slope, g, error * x[j])
                weights[:most, j] += pace * slope
            away = np.subtract(1, own, out=own)
            away *= sign[now]
            away *= share.take(np.bincount(cell).take(cell))
            np.add.at(refine, cell, away)
        # The bits of a symbol from the product of its decisions' probabilities, which no path is long enough to bring to nothing.
        cost *= 0.5
        np.clip(cost, 1e-5, 1 - 1e-5, out=cost)
        some = np.flatnonzero(d.length)
        if len(some):
            total[:on] -= np.bincount(text[some], np.log2(np.multiply.reduceat(cost, (np.cumsum(d.length) - d.length)[some])), on)
    return total


def lesson_of(d: Decisions) -> bytes:
    """What a chunk learns from its decisions: weights by Newton steps from the fresh ones, with their numbers, and counts for the map's cells."""
    start, seen = Mixer.fresh().weights.astype(np.float64), np.bincount(d.gate, minlength=GATES)
    order = np.argsort(d.gate, kind="stable")
    inputs, sign = [i.take(order) / np.float64(16) for i in d.inputs], sign_of(d.bit.take(order))
    weights, count, ones, high = start.copy(), np.zeros((GATES, CELLS)), np.zeros((GATES, CELLS)), 0
    for gate in np.flatnonzero(seen).tolist():
        low, high = high, high + int(seen[gate])
        x, w = [i[low:high] for i in inputs], start[gate].copy()
        for _ in range(4):
            chance = 1 / (1 + np.exp(-np.clip(sum(w[j] * x[j] for j in range(INPUTS)), -LIMIT, LIMIT)))
            error, slope = 1 - chance, chance * (1 - chance)
            down = np.array([(error * x[j]).sum() for j in range(INPUTS)]) - 50 * (w - start[gate])
            bend = np.empty((INPUTS, INPUTS))
            for j in range(INPUTS):
                bent = slope * x[j]
                for k in range(j, INPUTS):
                    bend[j, k] = bend[k, j] = (bent * x[k]).sum() + 50 * (j == k)
            w = np.clip(w + np.linalg.solve(bend, down), -2, 3)
        weights[gate] = w
        cell = cell_of(np.clip(sum(w[j] * x[j] for j in range(INPUTS)), -LIMIT, LIMIT) * sign[low:high])
        count[gate] = np.bincount(cell, minlength=CELLS)
        ones[gate] = np.bincount(cell[sign[low:high] > 0], minlength=CELLS)
    return np.concatenate([(weights * seen[:, None]).ravel(), seen, count.ravel(), ones.ravel()]).tobytes()


def settled(lessons: list[bytes]) -> Mixer:
    """The weights' means and the map of all lessons."""
    model = Mixer.fresh()
    if lessons:
        sums, seen, count, ones = np.split(np.sum([np.frombuffer(raw) for raw in lessons], axis=0), np.cumsum([GATES * INPUTS, GATES, GATES * CELLS]))
        met = seen > 0
        model.weights[met] = sums.reshape(GATES, -1)[met] / seen[met, None]
        model.refine = np.clip((ones.reshape(GATES, CELLS) + 60 * model.refine) / (count.reshape(GATES, CELLS) + 60), 1e-5, 1 - 1e-5).astype(np.float32)
    return model


# -- the yardstick


def word_counts(train: DataFrame) -> DataFrame:
    """(key, c): how often each token of the training texts occurs; key is the token's 64-bit hash."""
    prepare(train.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, ends = [], 0, 0

        def settle() -> pa.RecordBatch:
            keys, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(c.astype(np.int64))], names=["key", "c"])

        for batch in batches:
            raws = [utf8(t) for t in column_list(batch, "text")]
            ends += len(raws)
            for _, found, *_ in words_of(raws):
                held.append(found)
                size += len(found)
            if size > 2_000_000:
                yield settle()
                held, size = [], 0
        held.append(np.full(ends, _END_KEY, np.uint64))
        yield settle()

    return train.select("text").mapInArrow(run, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))


_CHUNK = (
    "chunk long, symbols binary, ends binary, kinds binary, n_symbols long, fold binary, fold_ends binary, row array<long>, doc_id array<long>, n_tokens array<long>, seen array<long>, base array<double>, n_bytes array<long>, "
    "rare_row array<long>, rare_key array<long>, rare_times array<long>"
)


def chunked(docs: DataFrame, shared, known, norm: float) -> DataFrame:
    """Chunks of texts (_row, doc_id, text, training): symbols, and for each text what the yardstick knows of it at once; rare words are listed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, (keys, counts, by_symbol) = shared.value, known.value
        logs, own = np.log10(counts + 0.5) - norm, np.log10(by_symbol + 0.5) - norm
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(column_list(batch, c) for c in ("_row", "doc_id", "text", "training")), strict=True):
                held.append(row)
                size += len(row[2] or "")
                if size > CHUNK * 5 or len(held) >= 20_000:
                    yield chunk_of(held, code, keys, logs, own)
                    held, size = [], 0
        if held:
            yield chunk_of(held, code, keys, logs, own)

    return docs.select("_row", "doc_id", "text", "training").mapInArrow(run, _CHUNK)


def chunk_of(held: list[tuple], code: Code, keys: np.ndarray, logs: np.ndarray, own: np.ndarray) -> pa.RecordBatch:
    """`keys`, `logs`: frequent words and what the yardstick gives them; `own`: what it gives the words that are symbols, and the end."""
    raws = [utf8(h[2]) for h in held]
    found_words = list(words_of(raws))
    symbols, ends = symbols_of(raws, code, found_words)
    kinds = np.array([0 if not h[3] else 1 + (xxhash.xxh3_64_intdigest(symbols[b:e].tobytes()) % FOLD == 0) for h, b, e in zip(held, [0, *ends[:-1].tolist()], ends.tolist(), strict=True)], np.uint8)
    n = len(held)
    folded, size = kinds > 1, np.diff(ends, prepend=0)
    words, chars = np.zeros(n, np.int64), np.zeros(n, np.int64)
    every, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for _, found, _, lengths, owner in found_words:
        words += np.bincount(owner, minlength=n)
        chars += np.bincount(owner, lengths, n).astype(np.int64)
        every.append(found)
        owners.append(owner)
    key, owner = np.concatenate(every).view(np.int64), np.concatenate(owners)
    spelled = symbols[(symbols < code.words) & (symbols != code.end)] == code.escape  # of each word
    base = np.full(n, own[code.end]) + np.bincount(owner[~spelled], own.take(symbols[(symbols < code.words) & (symbols != code.end) & (symbols != code.escape)]), n)
    key, owner = key[spelled], owner[spelled]
    at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
    met = keys[at] == key if len(keys) else np.zeros(len(key), bool)
    base += np.bincount(owner[met], logs[at[met]], n)
    rare, whose = key[~met], owner[~met]
    seen = words - np.bincount(whose, minlength=n)
    # By text and the first bits of the key: so equal words of a text lie together, and one that another word parts is listed twice.
    shift = np.uint64(n.bit_length())
    order = np.argsort(whose.astype(np.uint64) << (np.uint64(64) - shift) | rare.view(np.uint64) >> shift)
    rare, whose = rare[order], whose[order]
    first = np.flatnonzero(np.append(True, (rare[1:] != rare[:-1]) | (whose[1:] != whose[:-1]))[: len(rare)])
    rows = np.array([h[0] for h in held], np.int64)
    columns = [
        rows[0].item(), pack(symbols), ends.astype(np.int64).tobytes(), kinds.tobytes(), len(symbols), pack(symbols[np.repeat(folded, size)]), np.cumsum(size[folded]).astype(np.int64).tobytes(),
        rows, [h[1] for h in held], words + 1, seen, base, chars + np.maximum(words - 1, 0),
        rows[whose[first]], rare[first], np.diff(first, append=len(rare)),
    ]
    return pa.RecordBatch.from_arrays([pa.array([c.tolist() if isinstance(c, np.ndarray) else c], t) for c, t in zip(columns, _CHUNK_TYPES, strict=True)], names=[c.split()[0] for c in _CHUNK.split(", ")])


_CHUNK_TYPES = [{"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64())}[c.split()[1]] for c in _CHUNK.split(", ")]


# -- the whole


def _texts(mine: pa.Table, symbols: str, ends: str) -> tuple[np.ndarray, np.ndarray]:
    """A chunk's symbols and where its texts end."""
    return unpack(mine.column(symbols)[0].as_py(), np.uint32).astype(np.int64), np.frombuffer(mine.column(ends)[0].as_py(), np.int64)


def _answered(said: pa.Table, column: str) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each kind the parts of a chunk's answers from all buckets, one behind the other."""
    kind, bucket = said.column("kind").to_numpy(), said.column("bucket").to_numpy()
    parts: list[list[tuple]] = [[(np.zeros(0, np.uint8), np.zeros(0, np.int8), np.zeros(0, np.int8))] for _ in ORDERS]
    for k in np.lexsort((bucket, kind)).tolist():
        parts[kind[k]].append(received(said.column(column)[k].as_py()))
    return [tuple(np.concatenate(p) for p in zip(*own, strict=True)) for own in parts]


def _pairs_met(symbols: np.ndarray, ends: np.ndarray, order: int, code: Code) -> tuple[np.ndarray, np.ndarray]:
    """Which of these texts' distinct pairs each symbol is, and how long their paths are."""
    pairs, which = distinct(pairs_of(symbols, ends, order), "quicksort")
    return which, code.length[(pairs & np.uint64(0xFFFFFF)).astype(np.int64)]


def _places(symbols: np.ndarray, ends: np.ndarray, kinds: np.ndarray, code: Code) -> list[np.ndarray]:
    """For each kind and symbol where its predictions begin in the answers for these texts' pairs, written out."""
    met = [_pairs_met(symbols, ends, order, code) for order in ORDERS]
    return [(np.cumsum(length) - length)[which] for which, length in met]


def _written_out(symbols: np.ndarray, ends: np.ndarray, parts: list[tuple], code: Code) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The places, and the predictions of these texts' pairs along whole paths."""
    met = [_pairs_met(symbols, ends, order, code) for order in ORDERS]
    return [(np.cumsum(length) - length)[which] for which, length in met], [whole_paths(*own, length) for own, (_, length) in zip(parts, met, strict=True)]


def score(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score, total_bits, n_bytes of every row of docs (doc_id, text, training).

    The model is learned from the rows whose `training` is true; `score` is its log10 probability, `total_bits` the same in bits.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    counts = scratch.keep(word_counts(docs.where("training")), "counts")
    ends_key = int(np.uint64(_END_KEY).view(np.int64))
    size = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.max(F.when(F.col("key") == ends_key, F.col("c"))), F.lit(0))).first()
    n, v, ends = int(size[0]), int(size[1]), int(size[2])
    least = max(1, math.ceil(n * FREQUENT_SHARE))
    frequent = counts.where(F.col("c") >= least).toPandas().sort_values("key")  # at most 1 / FREQUENT_SHARE rows
    chosen = counts.where((F.col("c") > 1) & (F.col("key") != ends_key)).orderBy(F.desc("c"), "key").limit(VOCABULARY).toPandas()  # the vocabulary is a parameter
    coded = Code.huffman(chosen["key"].to_numpy(np.int64).view(np.uint64), chosen["c"].to_numpy(np.int64), n - ends - int(chosen["c"].sum()), ends)
    code = spark.sparkContext.broadcast(coded)
    chosen = chosen.sort_values("key", key=lambda k: k.astype("uint64"))  # as code.keys
    by_symbol = np.zeros(coded.words, np.int64)
    by_symbol[coded.symbol], by_symbol[coded.end] = chosen["c"].to_numpy(np.int64), ends
    most = min(least - 1, int(chosen["c"].min()) if len(chosen) == VOCABULARY else 1)  # of a word that is neither frequent nor in the vocabulary
    known = spark.sparkContext.broadcast((frequent["key"].to_numpy(np.int64), frequent["c"].to_numpy(np.int64), by_symbol))
    norm = math.log10(n + 0.5 * (v + 1))

    prepare(spark)
    numbered = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "text", F.coalesce("training", F.lit(False)).alias("training"))
    share = F.pmod(F.xxhash64("chunk"), F.lit(SHARES)).cast("int")
    chunks = scratch.keep(chunked(numbered, code, known, norm).withColumn("share", share), "chunks", "share")
    symbols = chunks.agg(F.coalesce(F.sum("n_symbols"), F.lit(0))).first()[0]
    bits = max(5, math.ceil(math.log2(max(1, symbols * len(ORDERS) / BUCKET))))
    said = [scratch.keep(answers(asked_pairs(chunks, bits, part), code).withColumn("share", share), f"answers-{part}", "share") for part in range(PARTS)]
    said = reduce(DataFrame.union, said)

    def teach(key: tuple, mine: pa.Table, its: pa.Table) -> pa.Table:
        symbols, ends = _texts(mine, "fold", "fold_ends")
        lessons = []
        if len(ends):  # the fold's texts end with a symbol each
            places, predictions = _written_out(symbols, ends, _answered(its, "taught"), code.value)
            lessons = [lesson_of(Decisions.of(symbols, places, predictions, code.value))]
        return pa.table([pa.array(lessons, pa.binary())], names=["lesson"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for raw in column_list(batch, "lesson"):
                total = np.frombuffer(raw) + (0 if total is None else total)
        yield pa.RecordBatch.from_arrays([pa.array([] if total is None else [total.tobytes()], pa.binary())], names=["lesson"])

    # Only the fold's symbols and answers are shuffled; a row of 18 KB comes from each task.
    lessons = chunks.select("chunk", "fold", "fold_ends").groupBy("chunk").cogroup(said.select("chunk", "kind", "bucket", "taught").groupBy("chunk")).applyInArrow(teach, "lesson binary").mapInArrow(summed, "lesson binary")
    model = spark.sparkContext.broadcast(settled(sorted(bytes(r["lesson"]) for r in scratch.keep(lessons, "lessons").collect())))

    def rate(key: tuple, mine: pa.Table, its: pa.Table) -> pa.Table:
        symbols, ends = _texts(mine, "symbols", "ends")
        places, predictions = _written_out(symbols, ends, _answered(its, "known"), code.value)
        total = bits_of(list(range(len(ends))), ends, symbols, places, predictions, code.value, model.value)
        plain = [pa.array(mine.column(c)[0].as_py(), t) for c, t in (("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("seen", pa.int64()), ("base", pa.float64()), ("n_bytes", pa.int64()))]
        return pa.table([*plain, pa.array(total)], names=["_row", "doc_id", "n_tokens", "seen", "base", "n_bytes", "total_bits"])

    whole = chunks.select("chunk", "share", "symbols", "ends", "row", "doc_id", "n_tokens", "seen", "base", "n_bytes")
    rows = []
    for k in range(SHARES):
        its = said.where(F.col("share") == k).select("chunk", "kind", "bucket", "known").groupBy("chunk")
        rated = whole.where(F.col("share") == k).drop("share").groupBy("chunk").cogroup(its).applyInArrow(rate, "_row long, doc_id long, n_tokens long, seen long, base double, n_bytes long, total_bits double")
        rows.append(scratch.keep(rated, f"rows-{k}"))
        scratch.drop(*(f"answers-{part}/share={k}" for part in range(PARTS)))
    rows = reduce(DataFrame.union, rows)
    scratch.drop("lessons", *(f"answers-{part}" for part in range(PARTS)))
    words = chunks.select(F.explode(F.arrays_zip("rare_row", "rare_key", "rare_times")).alias("w")).select(F.col("w.rare_row").alias("_row"), F.col("w.rare_key").alias("key"), F.col("w.rare_times").alias("times"))
    met = words.join(counts.where(F.col("c") <= most), "key", "left")
    # Rare counts are small integers, so the sums of a row come from few distinct logarithms.
    rest = met.groupBy("_row").agg(
        F.sum(F.col("times") * (F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.5)) - F.lit(norm))).alias("rest"), F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(F.lit(0))).alias("rest_seen")
    )
    joined = rows.join(rest, "_row", "left")
    return joined.select(
        "doc_id", "n_tokens", (F.col("seen") + F.lit(int(ends > 0)) + F.coalesce("rest_seen", F.lit(0))).cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"), (F.col("total_bits") * F.lit(-math.log10(2))).alias("score"), "total_bits", "n_bytes",
    )
