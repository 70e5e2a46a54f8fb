"""Exact n-gram Jaccard join with a token-group matrix.

Every document is the set of its word shingles as 64-bit hashes. Documents with the same set are one class from the start.
In any global order of tokens the first tokens of a set, its prefix, decide: sets that reach the similarity have prefix
tokens in common, and the number of common ones bounds their overlap.

1. A first matrix has a row for each prefix token (in the order of hashes) and a column for each class of set sizes. A class
   of documents stays if its tokens in some column allow an overlap with any set of such a size; all others have no link.
2. For those that stay every token is counted, and the prefix is taken in the order of frequency, rare first, so that shared
   passages hardly matter as keys. The same test by sizes again leaves only what may link.
3. Similar classes are partitioned into groups: each class is compared exactly with centres that it shares tokens
   with. Linked ones become one component. A component also joins the group of a larger one, that of the centre with which
   one of its classes has most prefix tokens in common, linked or not.
4. The token-group matrix has a row for each token and a column for each group and size: the union of prefix tokens of the
   group's members. Each class queries the matrix; the number of its tokens in another group's union bounds the overlap with
   every member. Groups below the bound stay closed; only members of qualifying groups are compared exactly, in blocks.
   Inside a group the classes of all components but the largest ask the other components in the same way.

The third step only saves work: the fourth covers every pair of different groups and every pair of different components of
one group, so no link that could change a component is lost. Hash collisions aside (64 bits), results are exact. Components
are formed by the star algorithm in `components`.

Tokens are counted in buckets of about BUCKET tokens by their first bits. A bucket gets at most one row of a set from
each task, so neither many copies nor a token found everywhere make one bucket much larger than others. Blocks of a
comparison hold about BLOCK sets of either side, whatever the size of a group.

Defined results: documents without words (null, empty or only white space) have no shingle and are components of
their own; with fewer words than a shingle the whole sequence is the one shingle; repeated rows share a class; rows of one
doc_id with different texts count as one document with all their links; a null doc_id names no component, so a component
without any other has a null one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, column_list, give_back, prepare, small, utf8
from tessera.llm.components import components
from tessera.llm.shingles import DEALT, Dealer, shared, token_sets

#: Tokens in a bucket, about, and sets of either side in a block of a comparison.
BUCKET, BLOCK = 1_000_000, 256

#: Set sizes within a factor of STEP are one class of sizes.
STEP = 1.08

#: Prefixes in the order of hashes are the least ones, a quarter of all values; times this odd number they are spread over all buckets.
SPREAD = np.int64(-0x61C8864680B583EB)


def prefix_size(n: np.ndarray, percent: int) -> np.ndarray:
    """How many tokens of a set of n must be looked at: any set that reaches the similarity shares one of them."""
    return np.where(n > 0, n - -(-n * percent // 100) + 1, 0)


def size_class(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log(np.maximum(n, 1)) / math.log(STEP)).astype(np.int64)


def signatures(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n, hi, lo (128-bit hash of the whole set) and prefix: the first tokens in the order of hashes."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, sizes = token_sets([utf8(t) for t in column_list(batch, "text")], width)
            ends = np.cumsum(sizes)
            digests = [xxhash.xxh3_128_digest(tokens[end - n : end].tobytes()) for end, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            first = prefix_size(sizes, percent)
            chosen = np.arange(len(tokens)) - np.repeat(ends - sizes, sizes) < np.repeat(first, sizes)
            prefix = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(first)), pa.int32()), pa.array(tokens[chosen]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1]), prefix], names=["doc_id", "n", "hi", "lo", "prefix"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, hi long, lo long, prefix array<long>")


def dealt_prefixes(signed: DataFrame, bits: int) -> DataFrame:
    """The prefixes' tokens times SPREAD, dealt to buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealer = Dealer(bits)
        for batch in batches:
            ends, values = batch.column(2).offsets.to_numpy(), batch.column(2).values.to_numpy()
            for k, (number, n) in enumerate(zip(column_list(batch, "lo"), column_list(batch, "n"), strict=True)):
                dealer.add(number, n, values[ends[k] : ends[k + 1]] * SPREAD)
            if dealer.full():
                yield pa.RecordBatch.from_pylist(dealer.rows(), _DEALT)
        yield pa.RecordBatch.from_pylist(dealer.rows(), _DEALT)
        give_back()

    return signed.select("lo", "n", "prefix").mapInArrow(run, DEALT)


def dealt_sets(docs: DataFrame, width: int, bits: int) -> DataFrame:
    """All tokens of the texts, dealt to buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealer = Dealer(bits)
        for batch in batches:
            tokens, sizes = token_sets([utf8(t) for t in column_list(batch, "text")], width)
            for end, n in zip(np.cumsum(sizes).tolist(), sizes.tolist(), strict=True):
                mine = tokens[end - n : end]
                dealer.add(int.from_bytes(xxhash.xxh3_128_digest(mine.tobytes())[8:], "little", signed=True), n, mine)
            if dealer.full():
                yield pa.RecordBatch.from_pylist(dealer.rows(), _DEALT)
        yield pa.RecordBatch.from_pylist(dealer.rows(), _DEALT)
        give_back()

    return docs.select("text").mapInArrow(run, DEALT)


_DEALT = pa.schema([("bucket", pa.int32()), ("tokens", pa.binary()), ("owners", pa.binary()), ("ids", pa.binary()), ("sizes", pa.binary())])


def sizes_met(key: tuple, table: pa.Table) -> pa.Table:
    """Step 1, a bucket: for each id and class of sizes, how many of its tokens another id of such a size holds."""
    give_back()
    _, number, size, which, _ = shared(table)
    own = size_class(size)
    cells, held = np.unique(which * 1024 + own, return_counts=True)
    ids, at = np.unique(number, return_index=True)
    sizes, back = size[at], np.searchsorted(ids, number)
    parts = []
    for away in range(-4, 5):  # a size beyond these classes differs by more than a factor of 4 / 3
        look = which * 1024 + own + away
        place = np.minimum(np.searchsorted(cells, look), max(len(cells) - 1, 0))
        others = (np.where(cells[place] == look, held[place], 0) if len(cells) else np.zeros(0)) - (away == 0)
        met = np.bincount(back, others > 0, len(ids)).astype(np.int64)
        some = met > 0
        parts.append((ids[some], sizes[some], size_class(sizes[some]) + away, met[some]))
    columns = [np.concatenate([p[k] for p in parts]) for k in range(4)]
    return pa.table([pa.array(c.astype(np.int64)) for c in columns], names=["id", "n", "other", "met"])


def tokens_shared(key: tuple, table: pa.Table) -> pa.Table:
    """Step 2, a bucket: the tokens that two ids hold, with the number of ids."""
    give_back()
    token, number, size, _, held = shared(table)
    return pa.table([pa.array(number), pa.array(size), pa.array(token), pa.array(held.astype(np.int64))], names=["id", "n", "token", "held"])


def partners(asking: list[tuple[int, int, int, np.ndarray]], members: list[tuple[int, int, int, np.ndarray]], percent: int) -> list[tuple[int, int]]:
    """Pairs (a, b): for each asking set (id, size, component, sorted shared tokens) one member of each other component that reaches the similarity."""
    mine, others = np.concatenate([a[3] for a in asking]), np.concatenate([m[3] for m in members])
    common = np.intersect1d(mine, others)
    inter = np.zeros((len(asking), len(members)), np.float32)
    if len(common):
        rows = [_found(common, a[3]) for a in asking]
        columns = [_found(common, m[3]) for m in members]
        for low in range(0, len(common), 4096):
            width = min(4096, len(common) - low)
            left, right = np.zeros((len(rows), width), np.float32), np.zeros((len(columns), width), np.float32)
            for side, places in ((left, rows), (right, columns)):
                for k, p in enumerate(places):
                    side[k, p[np.searchsorted(p, low) : np.searchsorted(p, low + width)] - low] = 1
            inter += left @ right.T
    a, b = np.array([a[1] for a in asking])[:, None], np.array([m[1] for m in members])[None, :]
    own, theirs = np.array([a[2] for a in asking]), np.array([m[2] for m in members])
    linked = (inter * 100 >= (a + b - inter) * percent) & (own[:, None] != theirs[None, :])
    pairs = []
    for k in np.flatnonzero(linked.any(axis=1)).tolist():
        which = np.flatnonzero(linked[k])
        pairs += [(asking[k][0], members[j][0]) for j in which[np.unique(theirs[which], return_index=True)[1]].tolist()]
    return pairs


def _found(common: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Places in `common` of those tokens that it holds, rising."""
    at = np.searchsorted(common, tokens)
    at[at == len(common)] = 0
    return at[common[at] == tokens]


class GroupJoin:
    """One run of the join; its tables live in the shared folder."""

    def __init__(self, docs: DataFrame, width: int = 5, percent: int = 75, rounds: int = 2, bucket: int = BUCKET, block: int = BLOCK) -> None:
        self.docs, self.width, self.percent, self.rounds, self.bucket, self.block = docs.select("doc_id", "text"), width, percent, rounds, bucket, block
        self.spark, self.scratch = docs.sparkSession, Scratch(docs.sparkSession, "jaccard")
        self.made = 0

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self.made += 1
        return self.scratch.keep(df, f"{self.made:03d}-{name}")

    def bits(self, tokens: int) -> int:
        """Buckets for so many tokens, as a power of two; 32 at least, to use all executors."""
        return max(5, math.ceil(math.log2(max(1, tokens / self.bucket))))

    # -- bounds

    def fits(self, na: Column, nb: Column) -> Column:
        return F.least(na, nb) * 100 >= F.greatest(na, nb) * self.percent

    def least_overlap(self, na: Column, nb: Column) -> Column:
        """The smallest intersection that reaches the similarity: ceil(percent * (na + nb) / (100 + percent))."""
        whole = (na + nb) * self.percent
        return F.floor((whole + (100 + self.percent - 1)) / (100 + self.percent))

    def prefix_rest(self, n: Column) -> Column:
        """Tokens of a set behind its prefix."""
        return F.ceil(n * self.percent / 100) - 1

    def allows(self, n: Column, least: Column, most: Column, met: Column) -> Column:
        """Whether `met` common prefix tokens allow a link with a set of `least` to `most` tokens.

        The wanted overlap less what may follow the prefixes falls with the distance of the sizes, so both ends are asked; one
        token less is wanted for what rounding does in between.
        """
        low, high = F.greatest(least, F.ceil(n * self.percent / 100)), F.least(most, F.floor(n * 100 / self.percent))
        wanted = F.least(*(self.least_overlap(n, m) - self.prefix_rest(F.greatest(n, m)) for m in (low, high))) - 1
        return (low <= high) & (met >= 1) & (met >= wanted)

    def allows_class(self, n: Column, other: Column, met: Column) -> Column:
        return self.allows(n, F.floor(F.pow(F.lit(STEP), other)).cast("long"), F.ceil(F.pow(F.lit(STEP), other + 1)).cast("long"), met)

    # -- steps 1 and 2

    def classes(self) -> None:
        """The documents' classes, and which may have a link by size and prefix tokens."""
        prefixed = self.keep(signatures(self.docs, self.width, self.percent), "prefixed")
        self.signed = self.keep(prefixed.drop("prefix"), "signed")
        some = prefixed.where("n > 0")
        tokens = some.agg(F.coalesce(F.sum(F.size("prefix")), F.lit(0))).first()[0]
        dealt = dealt_prefixes(some, self.bits(tokens)).groupBy("bucket").applyInArrow(sizes_met, "id long, n long, other long, met long")
        met = dealt.groupBy("id", "n", "other").agg(F.sum("met").alias("met"))
        likely = self.keep(met.where(self.allows_class(F.col("n"), F.col("other"), F.col("met"))).select("id").distinct(), "likely")
        self.scratch.drop("001-prefixed")
        some = self.signed.where("n > 0")
        # One text of each class is read again, found by a document of the class.
        reps = some.select(F.col("lo").alias("id"), "n", "doc_id").join(small(likely), "id", "left_semi").groupBy("id", "n").agg(F.min("doc_id").alias("doc_id"))
        self.likely = self.keep(reps.where("doc_id is not null"), "texts")

    def sets(self) -> DataFrame:
        """(token, id, n, s, own) of the prefixes in the order of frequency, own being the share of tokens that no other class holds; also writes every likely class's shared tokens in that order."""
        tokens, n = self.likely.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
        texts = self.docs.join(small(self.likely.select("doc_id").distinct(), n), "doc_id", "left_semi")
        dealt = dealt_sets(texts, self.width, self.bits(tokens)).groupBy("bucket").applyInArrow(tokens_shared, "id long, n long, token long, held long")
        ordered = dealt.groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("held", "token"))).alias("order"))  # at most a document's tokens
        self.shared = self.keep(ordered.select("id", "n", F.col("order.token").alias("tokens")), "sets")
        # The tokens that nobody shares come first in the order.
        first = F.greatest(F.lit(0), (F.col("n") - F.ceil(F.col("n") * self.percent / 100) + 1) - (F.col("n") - F.size("tokens"))).cast("int")
        size = F.floor(F.log("n") / F.lit(math.log(STEP)) + 1e-12).cast("int").alias("s")
        own = ((F.col("n") - F.size("tokens")) * 1_000_000 / F.col("n")).cast("long").alias("own")
        rows = self.shared.select("id", "n", size, own, F.explode(F.slice("tokens", F.lit(1), first)).alias("token"))
        rows = self.keep(rows, "prefixes")
        for k in range(2):
            cells = rows.groupBy("token", F.col("s").alias("other")).agg(F.count(F.lit(1)).alias("held"))
            met = rows.join(cells, "token").where((F.abs(F.col("s") - F.col("other")) <= 4) & ((F.col("held") > 1) | (F.col("s") != F.col("other"))))
            counted = met.groupBy("id", "n", "other").agg(F.count(F.lit(1)).alias("met"))
            may = self.keep(counted.where(self.allows_class(F.col("n"), F.col("other"), F.col("met"))).select("id").distinct(), f"may-{k}")
            rows = self.keep(rows.join(small(may), "id", "left_semi"), f"prefixes-{k}")
        return rows

    # -- exact comparison

    def linked(self, asked: DataFrame, members: DataFrame, name: str) -> DataFrame:
        """Pairs (a, b): for each row (id, target) of `asked` a linked member (target, id) of each other component in each block of the target's members."""
        asked = self.keep(asked.select("id", "target"), f"{name}-asked")
        members = members.join(asked.select("target").distinct(), "target", "left_semi")
        sizes = members.groupBy("target").agg(F.ceil(F.count(F.lit(1)) / self.block).cast("int").alias("of_members")).join(
            asked.groupBy("target").agg(F.ceil(F.count(F.lit(1)) / self.block).cast("int").alias("of_asking")), "target"
        )

        def blocks(rows: DataFrame, own: str, other: str, side: bool) -> DataFrame:
            one = rows.join(sizes, "target").select("id", "target", F.pmod(F.xxhash64("id"), F.col(own)).alias("own"), F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias("other"))
            mine, its = (F.col("own"), F.col("other")) if side else (F.col("other"), F.col("own"))
            return one.select("id", F.lit(side).alias("asks"), F.xxhash64("target", mine.cast("long"), its.cast("long")).alias("key"))

        dealt = self.keep(self.labelled(blocks(asked, "of_asking", "of_members", True).union(blocks(members, "of_members", "of_asking", False))), f"{name}-blocks")
        whole = self.shared.join(small(dealt), "id").select("key", "asks", "id", "n", "own", "tokens")
        percent = self.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sides: dict[bool, list] = {True: [], False: []}
            at = None

            def settle() -> list[tuple[int, int]]:
                pairs = partners(sides[True], sides[False], percent) if sides[True] and sides[False] else []
                sides[True], sides[False] = [], []
                return pairs

            out: list[tuple[int, int]] = []
            for batch in batches:
                ends, values = batch.column(5).offsets.to_numpy(), batch.column(5).values.to_numpy()
                for k, (key, asks, number, n, own) in enumerate(zip(*(batch.column(j).to_pylist() for j in range(5)), strict=True)):
                    if key != at:
                        out += settle()
                        at = key
                    sides[asks].append((number, n, own, np.sort(values[ends[k] : ends[k + 1]])))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["a", "b"])
                    out = []
            out = settle()
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["a", "b"])

        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        found = self.keep(whole.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(run, "a long, b long"), f"{name}-links")
        self.scratch.drop(f"{self.made - 1:03d}-{name}-blocks", f"{self.made - 2:03d}-{name}-asked")
        return found

    def link(self, found: DataFrame, name: str) -> bool:
        """Adds links; False if there was none."""
        if found.isEmpty():
            return False
        self.links = self.keep(found if self.links is None else self.links.union(found), f"{name}-all")
        self.labels = components(self.links, self.scratch, f"components-{self.made}")
        return True

    # -- steps 3 and 4

    def labelled(self, rows: DataFrame) -> DataFrame:
        """Adds each class's component of what is linked so far as `own`, itself without links."""
        return rows.join(small(self.labels), "id", "left").withColumn("own", F.coalesce("component", "id")).drop("component")

    def partition(self, rows: DataFrame) -> None:
        """Step 3: groups of similar classes by comparison with centres."""
        for k in range(self.rounds):
            mine = self.labelled(rows.withColumnRenamed("own", "alone")).withColumnRenamed("own", "g")
            # Centres of a token among its holders: the class with the least share of tokens of its own, and one by a hash, another in each round.
            who = (F.col("id").alias("c"), F.col("g").alias("cg"), F.col("n").alias("cn"))
            chosen = (F.struct(F.col("alone").alias("h"), *who), F.struct(F.xxhash64("id", F.lit(k)).alias("h"), *who))
            centres = mine.groupBy("token").agg(F.min("g").alias("low"), F.max("g").alias("high"), F.array(*(F.min(c) for c in chosen)).alias("centres")).where("low < high")
            each = centres.select("token", F.explode("centres").alias("centre")).select("token", "centre.c", "centre.cg", "centre.cn").distinct()
            met = mine.join(each, "token").where((F.col("g") != F.col("cg")) & self.fits(F.col("n"), F.col("cn")))
            counted = met.groupBy("id", "n", "c", "cn").agg(F.count(F.lit(1)).alias("met"))
            n, other = F.col("n"), F.col("cn")
            may = F.col("met") + self.prefix_rest(F.greatest(n, other)) >= self.least_overlap(n, other)
            centre = F.struct("met", "c")
            # No more than two centres a token.
            ranked = counted.groupBy("id").agg(*(F.slice(F.sort_array(F.collect_list(v), asc=False), 1, 2).alias(name) for name, v in (("near", centre), ("likely", F.when(may, centre)))))
            ranked = self.keep(ranked, f"ranked-{k}")
            near = ranked.select("id", F.explode("near").alias("centre")).select("id", F.col("centre.c").alias("target"), "centre.met")
            self.near = near if self.near is None else self.near.union(near)
            asked = ranked.select("id", F.explode("likely.c").alias("target"))
            if not self.link(self.linked(asked, asked.select("target", F.col("target").alias("id")).distinct(), f"round-{k}"), f"round-{k}"):
                break

    def groups(self, rows: DataFrame) -> DataFrame:
        """(id, n, s, own, g) of every class: its component and its group."""
        classes = self.labelled(rows.select("id", "n", "s").distinct())
        if self.near is None:
            return self.keep(classes.withColumn("g", F.col("own")), "groups")
        classes = self.keep(classes, "labelled")
        sizes = self.keep(classes.groupBy("own").agg(F.count(F.lit(1)).alias("held")), "held")
        mine = self.keep(classes.join(small(sizes), "own").select("id", F.struct("held", F.col("own").alias("g")).alias("part")), "parts")
        theirs = mine.select(F.col("id").alias("target"), F.col("part").alias("larger"))
        met = self.near.join(small(mine), "id").join(small(theirs), "target").where("part < larger")
        joins = self.keep(met.groupBy(F.col("part.g").alias("own")).agg(F.max(F.struct("met", "larger")).alias("best")).select("own", F.col("best.larger.g").alias("g")), "joins")
        return self.keep(classes.join(small(joins), "own", "left").select("id", "n", "s", "own", F.coalesce("g", "own").alias("g")), "groups")

    def query(self, rows: DataFrame) -> None:
        """Step 4: every class against the matrix, opening only groups whose bound allows a link."""
        groups = self.groups(rows)
        width = self.keep(groups.groupBy("g").agg(F.count(F.lit(1)).alias("of_group")), "of-group")
        where = self.keep(groups.join(small(width), "g").select("id", "own", "g", "of_group"), "where")
        rows = self.keep(rows.drop("own").join(small(where), "id"), "matrix-rows")
        cells = rows.groupBy("token", "g", "of_group", "s").agg(F.min("n").alias("least"), F.max("n").alias("most"))
        several = cells.groupBy("token").agg(F.min("g").alias("low"), F.max("g").alias("high")).where("low < high").select("token")
        matrix = self.keep(cells.join(several, "token", "left_semi").select("token", F.struct("of_group", "g").alias("og"), F.col("s").alias("os"), "least", "most"), "matrix")
        # Of two groups the one with fewer classes asks the other (the lesser label among equals): each pair of classes is met once,
        # and the many members of a large group don't each ask about every single class.
        n = F.col("n")
        asked = rows.join(matrix, "token").where((F.struct("of_group", "g") < F.col("og")) & (F.col("least") * self.percent <= n * 100) & (F.col("most") * 100 >= n * self.percent))
        overlap = asked.groupBy("id", "n", "og", "os").agg(F.count(F.lit(1)).alias("met"), F.min("least").alias("least"), F.max("most").alias("most"))
        opened = overlap.where(self.allows(n, F.col("least"), F.col("most"), F.col("met")))
        target = F.xxhash64("g", F.col("s").cast("int")).alias("target")
        opened = opened.select("id", F.col("og.g").alias("g"), F.col("os").alias("s")).union(self.inside(rows)).select("id", target)
        self.link(self.linked(opened, groups.select("id", target), "opened"), "opened")

    def inside(self, rows: DataFrame) -> DataFrame:
        """(id, g, s): step 4 for the classes of all components but the largest of their group and the group itself."""
        several = rows.groupBy("g").agg(F.min("own").alias("low"), F.max("own").alias("high")).where("low < high").select("g")
        rows = self.keep(rows.join(small(self.keep(several, "several")), "g", "left_semi"), "inside-rows")
        largest = rows.groupBy("g", "own").agg(F.count(F.lit(1)).alias("held")).groupBy("g").agg(F.max(F.struct("held", "own")).alias("largest"))
        cells = rows.groupBy("token", "g", F.col("s").alias("os")).agg(F.min("n").alias("least"), F.max("n").alias("most"), F.min("own").alias("low"), F.max("own").alias("high"))
        n = F.col("n")
        asking = rows.join(small(self.keep(largest, "largest")), "g").where(F.col("own") != F.col("largest.own")).select("token", "g", "id", "n", "own")
        met = asking.join(cells, ["token", "g"]).where(((F.col("low") != F.col("own")) | (F.col("high") != F.col("own"))) & (F.col("least") * self.percent <= n * 100) & (F.col("most") * 100 >= n * self.percent))
        overlap = met.groupBy("id", "n", "g", "os").agg(F.count(F.lit(1)).alias("met"), F.min("least").alias("least"), F.max("most").alias("most"))
        return overlap.where(self.allows(n, F.col("least"), F.col("most"), F.col("met"))).select("id", "g", F.col("os").alias("s"))

    def run(self) -> DataFrame:
        """doc_id, n_shingles, component_id, copies (documents with the same set) of every row."""
        self.links = self.near = None
        self.labels = self.spark.createDataFrame([], "id long, component long")
        self.classes()
        rows = self.sets()
        self.partition(rows)
        self.query(rows)
        some = self.signed.where("n > 0")
        # Rows of one doc_id with different texts are one document.
        same = some.where("doc_id is not null").groupBy("doc_id").agg(F.min("lo").alias("b"), F.max("lo").alias("most")).where("b < most").select("doc_id", "b")
        self.link(self.keep(some.join(same, "doc_id").where("lo <> b").select(F.col("lo").alias("a"), "b"), "same-id"), "same-id")
        # Only classes with several documents or links need another label than their own doc_id.
        classes = some.groupBy(F.col("lo").alias("id")).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
        classes = classes.join(small(self.labels), "id", "left").where("copies > 1 or component is not null")
        classes = self.keep(classes.select("id", F.coalesce("component", "id").alias("g"), "rep", "copies"), "classes")
        least = classes.groupBy("g").agg(F.min("rep").alias("component"))
        named = self.keep(classes.select(F.col("id").alias("lo"), "g", "copies").join(least, "g").select("lo", "component", "copies"), "named")
        out = self.signed.select("doc_id", "n", "lo").join(small(named), "lo", "left")
        alone = (F.col("n") == 0) | F.col("copies").isNull()
        return out.select(
            "doc_id", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"), F.when(alone, F.lit(1)).otherwise(F.col("copies")).cast("long").alias("copies")
        )


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """Components of documents (doc_id, text) whose shingle sets have a Jaccard similarity of `percent` hundredths or more."""
    return GroupJoin(docs, width, percent).run()


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """The rows of docs that stay when one document, that with the least doc_id, is kept of each component."""
    found = jaccard_components(docs, width, percent)
    leaving = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(leaving, "doc_id", "left_anti")
