"""Joining documents by the Jaccard similarity of their word n-grams, with the n-gram order cut into fragments.

All n-grams have one order: those that few documents use by hash, then the frequent ones, the rarest first. Of two sets
that are similar enough, the first few n-grams in that order have one in common; that gives the pairs to look at.
The order is cut into fragments. A pair's overlap is counted in each fragment separately, from the two sets' segments
there, and the partial counts are summed per pair; so no task holds more of a set than a segment.

Only different sets take part: documents with the same set are one node. Pairs come in two steps. First every n-gram
names its most connected node, and the others are held against that one. What this links is one component, and the
second step takes the pairs of nodes of different components only. So a group of thousands of near copies costs links
in proportion to its size, and no link between components is missed.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtally.llm.rows import bit_filter, in_slices, join_split, may_hold, per_text, stage, text_or_empty
from adtally.llm.simhash import components

SHINGLE = 4
#: Two sets are linked if the intersection has at least so many hundredths of the union.
SHARE = 85
#: N-grams that more sets than this begin with are frequent.
FREQUENT = 64
#: Frequent n-grams that are told apart, and so the rows that are sent to every worker, at most.
FREQUENT_ROWS = 1 << 20
#: Fragments of the rare and of the frequent n-grams.
RARE_PARTS, FREQUENT_PARTS = 8, 2
#: Words of 64 bits, at least, in which each n-gram of a set flips one bit.
SHAPE = 16
#: Leading bits of a filter of n-grams or nodes, at least and at most: 8 MB.
LEAST_BITS, MOST_BITS = 16, 26
#: Nodes of one n-gram that one task compares; more are cut into blocks, and pairs of blocks are compared.
BLOCK = 4096
#: Bytes of a text whose words are objects at a time.
WINDOW = 1 << 20
#: Sets whose repetition a worker notices; then it starts anew.
SEEN = 100_000

_MIX, _END = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_BLANK = re.compile(rb"[\x20\x09-\x0d]")


def word_hashes(raw: bytes) -> np.ndarray:
    """A hash of every word of a text, A-Z in lower case, in order."""
    digest, parts, start = xxhash.xxh64_intdigest, [np.zeros(0, np.uint64)], 0
    while start < len(raw):
        blank = _BLANK.search(raw, start + WINDOW)
        end = blank.start() if blank else len(raw)
        words = raw[start:end].lower().split()
        parts.append(np.fromiter(map(digest, words), np.uint64, len(words)))
        start = end
    return np.concatenate(parts)


def shingles(raw: bytes, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the different runs of ``size`` words, sorted; fewer words are one run, none have none."""
    words = word_hashes(raw)
    size = min(size, len(words))
    if not size:
        return words
    last = len(words) - size + 1
    mixed = np.full(last, size, np.uint64)
    for k in range(size):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX + words[k:k + last]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _END
    return np.unique(mixed ^ (mixed >> np.uint64(29)))


def node_of(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def shape_of(grams: np.ndarray) -> np.ndarray:
    """Which bits an odd number of n-grams hit, of at least 64 * SHAPE and four for each n-gram: two shapes differ in no
    more bits than the sets do in n-grams. Half a shape's words xored with the other half are the shape of half the size.
    """
    bits = max(64 * SHAPE, 1 << (4 * len(grams) - 1).bit_length())
    odd = (np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


def beginning(size: np.ndarray | int) -> np.ndarray | int:
    """How many n-grams a set of this size begins with: two linked sets have one of them in common."""
    return size - (SHARE * size + 99) // 100 + 1


def reach_of(size: int, first: int) -> np.ndarray:
    """For each of the ``first`` n-grams a set of this size begins with, the largest set that may be linked to it if this
    is the first n-gram they have in common: those before it are in one set only.
    """
    return ((100 * size - (100 + SHARE) * np.arange(first)) // SHARE).astype(np.int32)


class Order:
    """The order of all n-grams: frequent ones are known by hash with their rank, all others go by hash before them."""

    def __init__(self, frequent: np.ndarray, times: np.ndarray):
        by_hash = np.argsort(frequent)
        self.frequent = frequent[by_hash]
        rank = np.empty(len(frequent), np.int64)
        rank[np.lexsort((frequent, times))] = np.arange(len(frequent))
        self.rank = rank[by_hash]

    def ranks(self, grams: np.ndarray) -> np.ndarray:
        """The rank of each frequent n-gram, -1 for others."""
        if not len(self.frequent):
            return np.full(len(grams), -1)
        at = np.minimum(np.searchsorted(self.frequent, grams), len(self.frequent) - 1)
        return np.where(self.frequent[at] == grams, self.rank[at], -1)

    def first(self, grams: np.ndarray, n: int) -> np.ndarray:
        """The first ``n`` of sorted n-grams."""
        ranks = self.ranks(grams)
        rare = grams[ranks < 0]
        if len(rare) >= n:
            return rare[:n]
        last = np.flatnonzero(ranks >= 0)
        return np.concatenate([rare, grams[last[np.argsort(ranks[last])]][:n - len(rare)]])

    def parts(self, grams: np.ndarray) -> np.ndarray:
        """The fragment of each n-gram: equal stretches of the hashes, then of the ranks."""
        ranks = self.ranks(grams)
        rare = (grams >> np.uint64(32)).astype(np.int64) * RARE_PARTS >> 32
        return np.where(ranks < 0, rare, RARE_PARTS + ranks * FREQUENT_PARTS // max(1, len(self.rank)))


class Filter:
    """A bitmap of 64-bit hashes: what it has not held is surely absent."""

    def __init__(self, bits: int, slots: np.ndarray, words: np.ndarray):
        self.shift = np.uint64(70 - bits)
        self.words = np.zeros(1 << (bits - 6), np.uint64)
        self.words[slots] = words

    def has(self, hashes: np.ndarray) -> np.ndarray:
        return (self.words[hashes >> self.shift] >> (hashes & np.uint64(63))) & np.uint64(1) == 1


def gather_filter(hashes: DataFrame) -> Filter:
    """A filter of the long column ``h``, sized by the count of its rows up to ``MOST_BITS``."""
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * hashes.count()).bit_length()))
    slots = hashes.groupBy(F.shiftrightunsigned("h", 70 - bits).alias("slot")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(h & 63 AS int))")).alias("word")
    ).toArrow()
    return Filter(bits, slots["slot"].to_numpy(), slots["word"].to_numpy().view(np.uint64))


def ahead(size: int) -> int:
    """How many of a set's n-grams are kept beside it: the first by hash, twice as many as it begins with and a few."""
    return 2 * beginning(size) + 16


def describe(docs: DataFrame) -> DataFrame:
    """For every row: doc_id, n_shingles, node (null without words), text_hash, shape, and the n-grams kept with it."""

    def score(texts: list[bytes]) -> list[pa.Array]:
        held = [shingles(t) for t in texts]
        return [
            pa.array([len(g) for g in held], pa.int64()),
            pa.array([node_of(g) if len(g) else None for g in held], pa.binary()),
            pa.array(np.array([xxhash.xxh64_intdigest(t, 42) for t in texts], np.uint64).view(np.int64)),
            pa.array([shape_of(g) if len(g) else None for g in held], pa.list_(pa.int64())),
            pa.array([g[:ahead(len(g))].tobytes() for g in held], pa.binary()),
        ]

    return per_text(docs, score, "n_shingles long, node binary, text_hash long, shape array<bigint>, zone binary")


def _of_zones(sets: DataFrame, rows: Callable[[pa.RecordBatch, list[np.ndarray]], list[pa.Array]], columns: str) -> DataFrame:
    """What ``rows`` makes of node, n, text_hash and the n-grams kept with a few sets; repeated ones are mostly passed over."""
    names = [c.split()[0] for c in columns.split(", ")]
    narrow = sets.filter("node IS NOT NULL").select("zone", "node", F.col("n_shingles").cast("int").alias("n"), "text_hash")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for part in in_slices(batch, 0):
                new = []
                for i, node in enumerate(part.column(1).to_pylist()):
                    if node not in seen:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(node)
                        new.append(i)
                if new:
                    part = part.take(pa.array(new))
                    zones = [np.frombuffer(z, np.uint64) for z in part.column(0).to_pylist()]
                    yield pa.RecordBatch.from_arrays(rows(part, zones), names=names)

    return narrow.mapInArrow(run, columns)


def counted(sets: DataFrame) -> DataFrame:
    """gram, times: the n-grams that more than one set may begin with, and about how many."""

    def rows(part: pa.RecordBatch, zones: list[np.ndarray]) -> list[pa.Array]:
        found, times = np.unique(np.concatenate(zones), return_counts=True)
        return [pa.array(found.view(np.int64)), pa.array(times)]

    return _of_zones(sets, rows, "gram long, times long").groupBy("gram").agg(F.sum("times").alias("times")).filter("times > 1")


def order_of(sets: DataFrame, repeated: DataFrame, frequent: int = FREQUENT) -> Order:
    """The order of all n-grams: frequent ones are those that more than ``frequent`` sets may begin with.

    Where ``FREQUENT_ROWS`` would not hold these, so many more sets must have them.
    """
    total = sets.agg(F.sum(F.octet_length("zone") / 8).alias("n")).first()["n"] or 0
    least = max(frequent, int(-(-total // FREQUENT_ROWS)))
    rows = repeated.filter(F.col("times") > least).toArrow()
    return Order(rows["gram"].to_numpy().view(np.uint64), rows["times"].to_numpy())


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """text and the columns of ``wanted``, which has text_hash: each different text of such a hash once for each row."""
    hashed = docs.select(text_or_empty().alias("text")).withColumn("text_hash", F.xxhash64("text"))
    held = bit_filter(wanted.select(F.col("text_hash").alias("h")))
    there = may_hold(hashed, "text_hash", held, "hit").filter("hit").select("text_hash", "text").distinct()
    return there.join(wanted, "text_hash").withColumn("text", F.col("text").cast("binary"))


def _of_texts(texts: DataFrame, kept: list[str], rows: Callable[[np.ndarray], list[pa.Array]], columns: str) -> DataFrame:
    """The columns ``kept`` of ``texts`` (text, node, ...) with what ``rows`` makes of the set of each; columns of equal length.

    A text that does not have the set ``node`` gives nothing: another text had its hash.
    """
    narrow = texts.select("text", "node", *(c for c in kept if c != "node"))
    schema = T.StructType([*[narrow.schema[c] for c in kept], *T.StructType.fromDDL(columns).fields])
    at = [narrow.columns.index(c) for c in kept]
    names = schema.names

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, grams, node = None, None, None
        for batch in batches:
            for part in in_slices(batch, 0):
                for i, (text, wanted) in enumerate(zip(*[part.column(c).to_pylist() for c in (0, 1)], strict=True)):
                    if text != raw:
                        raw, grams = text, shingles(text)
                        node = node_of(grams) if len(grams) else None
                    if node == wanted:
                        made = rows(grams)
                        same = pa.array(np.full(len(made[0]), i))
                        yield pa.RecordBatch.from_arrays([*(part.column(c).take(same) for c in at), *made], names=names)

    return narrow.mapInArrow(run, schema)


def beginnings(docs: DataFrame, sets: DataFrame, repeated: DataFrame, order: Order) -> DataFrame:
    """gram, node, n, reach: what each set begins with, but for n-grams that no other document begins with.

    For most sets the n-grams kept with them are enough. Sets with many frequent ones among those are made anew.
    """
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(order)

    def enough(zone: np.ndarray, n: int) -> bool:
        return len(zone) == n or int((shared.value.ranks(zone) < 0).sum()) >= beginning(n)

    def short(part: pa.RecordBatch, zones: list[np.ndarray]) -> list[pa.Array]:
        lacking = [not enough(z, n) for z, n in zip(zones, part.column(2).to_pylist(), strict=True)]
        return [part.column(i).filter(pa.array(lacking, pa.bool_())) for i in (3, 1, 2)]

    def late_rows(grams: np.ndarray) -> list[pa.Array]:
        head = shared.value.first(grams, beginning(len(grams)))
        return [pa.array(head.view(np.int64)), pa.array(reach_of(len(grams), len(head)))]

    wanted = stage(_of_zones(sets, short, "text_hash long, node binary, n int").dropDuplicates(["node"]), "jaccard-short")
    late = stage(_of_texts(texts_of(docs, wanted), ["node", "n"], late_rows, "gram bigint, reach int"), "jaccard-late")
    worth = context.broadcast(gather_filter(repeated.select(F.col("gram").alias("h")).union(late.select("gram"))))

    def rows(part: pa.RecordBatch, zones: list[np.ndarray]) -> list[pa.Array]:
        heads, reaches = [], []
        for zone, n in zip(zones, part.column(2).to_pylist(), strict=True):
            head = shared.value.first(zone, beginning(n)) if enough(zone, n) else zone[:0]
            held = worth.value.has(head)
            heads.append(head[held])
            reaches.append(reach_of(n, len(head))[held])
        which = pa.array(np.repeat(np.arange(len(zones)), [len(h) for h in heads]))
        return [
            pa.array(np.concatenate(heads).view(np.int64)), part.column(1).take(which), part.column(2).take(which),
            pa.array(np.concatenate(reaches)),
        ]

    early = _of_zones(sets, rows, "gram long, node binary, n int, reach int")
    return early.union(late.select("gram", "node", "n", "reach")).repartition("gram").distinct()


def near_in_size(a: Column, b: Column) -> Column:
    """Whether sets of these sizes can be linked at all."""
    return (F.lit(100) * F.least(a, b)) >= (F.lit(SHARE) * F.greatest(a, b))


def in_company(found: DataFrame) -> DataFrame:
    """Rows of n-grams that more than one node begins with, with how many do, as ``length``.

    Nodes that no other one's size and reach allow a link with there are left out: all of them where two meet, and
    elsewhere those that the least size and the largest reach rule out.
    """
    lengths = found.groupBy("gram").agg(
        F.count(F.lit(1)).alias("length"), F.min("n").alias("low"), F.max("reach").alias("high"),
        F.sum("n").alias("both"), F.min(F.col("n").cast("long") + F.col("reach")).alias("least"),
    ).filter("length > 2 OR (length = 2 AND least >= both)")
    fit = found.join(lengths, "gram").filter("reach >= low AND high >= n")
    return fit.select("gram", "node", "n", "reach", "length")


def around_centres(posts: DataFrame) -> DataFrame:
    """Pairs a, b of each n-gram's most connected node and the others that begin with it, sizes allowing."""
    ties = posts.groupBy("node").agg(F.sum("length").alias("ties"))
    centres = posts.join(ties, "node").groupBy("gram").agg(F.max(F.struct("ties", "node", "n")).alias("most"))
    named = centres.select("gram", F.col("most.node").alias("y"), F.col("most.n").alias("ny"))
    met = posts.select("gram", F.col("node").alias("x"), F.col("n").alias("nx")).join(named, "gram")
    fit = met.filter((F.col("x") != F.col("y")) & near_in_size(F.col("nx"), F.col("ny")))
    return fit.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def folded(shape: Column, words: Column | int) -> Column:
    """A shape of ``words`` words from one of twice as many."""
    halves = F.slice(shape, F.lit(1), words), F.slice(shape, F.lit(1) + words, words)
    return F.zip_with(*halves, lambda x, y: x.bitwiseXOR(y))


def coarse(shape: Column) -> Column:
    """A shape of just SHAPE words: word i is all words of the shape that are i modulo SHAPE, xored."""
    def word(i: int) -> Column:
        mine = F.transform(F.sequence(F.lit(i), F.size(shape) - 1, F.lit(SHAPE)), lambda at: F.get(shape, at))
        return F.aggregate(mine, F.lit(0).cast("long"), lambda s, x: s.bitwiseXOR(x))

    return F.array(*[word(i) for i in range(SHAPE)])


def _close(
    size: np.ndarray, reach: np.ndarray, root: np.ndarray, shape: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows i < j of one n-gram's nodes that may be linked and are not known to be.

    Sizes are asked first: the shapes of a large and a small set say little, as the small one's has few bits.
    """
    step = max(1, (1 << 17) // len(size))
    for start in range(0, len(size), step):
        mine = slice(start, start + step)
        fit = (size[mine, None] <= reach[None, start:]) & (size[None, start:] <= reach[mine, None])
        i, j = np.nonzero(fit & (root[mine, None] != root[None, start:]))
        i, j = i[j > i] + start, j[j > i] + start
        apart = np.bitwise_count(shape[i] ^ shape[j]).sum(1, dtype=np.int64)
        total = size[i] + size[j]
        near = 100 * (total - apart) >= SHARE * (total + apart)
        yield i[near], j[near]


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs a, b within each run of equal (gram, cell) of sorted rows; a run may go on in the next batch."""
    held: pa.Table | None = None

    def pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        gram, cell, size, reach = (table[c].to_numpy() for c in ("gram", "cell", "n", "reach"))
        node = table["node"].combine_chunks() if isinstance(table["node"], pa.ChunkedArray) else table["node"]
        root = table["root"].combine_chunks().dictionary_encode().indices.to_numpy()
        shape = table["shape"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, SHAPE)
        starts = np.flatnonzero(np.r_[True, (gram[1:] != gram[:-1]) | (cell[1:] != cell[:-1])])
        left, right = [], []
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(gram)], strict=True):
            run = slice(start, end)
            if (root[run] != root[start]).any():
                for i, j in _close(size[run].astype(np.int64), reach[run], root[run], shape[run]):
                    left.append(i + start)
                    right.append(j + start)
        if left and (i := np.concatenate(left)).size:
            one, two = node.take(pa.array(i)), node.take(pa.array(np.concatenate(right)))
            turn = pc.greater(one, two)
            yield pa.RecordBatch.from_arrays([pc.if_else(turn, two, one), pc.if_else(turn, one, two)], names=["a", "b"])

    for batch in batches:
        now = pa.Table.from_batches([batch])
        held = now if held is None else pa.concat_tables([held, now])
        if held.num_rows:
            gram, cell = (held[c].to_numpy() for c in ("gram", "cell"))
            done = np.flatnonzero((gram != gram[-1]) | (cell != cell[-1]))
            cut = int(done[-1]) + 1 if len(done) else 0
            if cut:
                yield from pairs(held.slice(0, cut))
                held = held.slice(cut)
    if held is not None and held.num_rows:
        yield from pairs(held)


def across(posts: DataFrame, roots: DataFrame, nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Pairs a, b of nodes that begin with the same n-gram, are in different components (``roots``: node, root), and
    whose sizes, reaches and coarse shapes allow a link.

    Nodes of an n-gram are compared where they meet, and only pairs that pass are rows. An n-gram of more than
    ``block`` nodes is cut into blocks, each pair of which is a cell of its own.
    """
    placed = nodes.select("node", coarse(F.col("shape")).alias("shape")).join(roots, "node", "left")
    several = F.ceil(F.col("length") / block).cast("int").alias("k")
    met = posts.select("gram", "node", "n", "reach", several).join(
        placed.withColumn("root", F.coalesce("root", "node")), "node"
    )
    mine = F.pmod(F.xxhash64("node"), F.col("k")).cast("int")
    cells = F.transform(
        F.sequence(F.lit(0), F.col("k") - 1),
        lambda j: F.least(mine, j).cast("long") * F.lit(1 << 31) + F.greatest(mine, j),
    )
    dealt = met.select("gram", F.explode(cells).alias("cell"), "node", "n", "reach", "root", "shape")
    ordered = dealt.repartition("gram", "cell").sortWithinPartitions("gram", "cell")
    return ordered.mapInArrow(_compare, "a binary, b binary").distinct()


def not_far(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """a, b, sizes and text hashes of the pairs whose shapes allow a link: sets differ in as many n-grams at least."""
    one, two = (
        nodes.select(F.col("node").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("n", "shape", "text_hash"))) for x in "ab"
    )
    words = F.least(F.size("shape_a"), F.size("shape_b"))

    def fitted(shape: str) -> Column:
        return F.when(F.size(shape) > words, folded(F.col(shape), words)).otherwise(F.col(shape))

    differ = F.zip_with(fitted("shape_a"), fitted("shape_b"), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    apart = F.aggregate(differ, F.lit(0), lambda s, x: s + x)
    total = F.col("n_a") + F.col("n_b")
    # linked: 100 * (total - apart) / 2 >= SHARE * (total + apart) / 2
    return pairs.join(one, "a").join(two, "b").filter(100 * (total - apart) >= SHARE * (total + apart)).select(
        "a", "b", "n_a", "n_b", "text_hash_a", "text_hash_b"
    )


def linked(docs: DataFrame, order: Order, pairs: DataFrame) -> DataFrame:
    """a, b of the pairs that are linked: partial overlaps by fragment, summed per pair.

    Segments of the node with fewer pairs go where those of the other one are, so each goes about once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(order)
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    pairs_of = ends.groupBy("node").agg(F.count(F.lit(1)).alias("pairs"))
    known = pairs.join(pairs_of.select(F.col("node").alias("a"), F.col("pairs").alias("pairs_a")), "a").join(
        pairs_of.select(F.col("node").alias("b"), F.col("pairs").alias("pairs_b")), "b"
    )
    turn = F.col("pairs_a") > F.col("pairs_b")
    aimed = stage(known.select(*(
        F.when(turn if x == "hub" else ~turn, F.col(f"{c}a")).otherwise(F.col(f"{c}b")).alias(f"{c}{x}")
        for x in ("hub", "spoke") for c in ("", "n_", "text_hash_")
    )), "jaccard-aimed")

    def rows(grams: np.ndarray) -> list[pa.Array]:
        part = shared.value.parts(grams)
        by_part = np.argsort(part, kind="stable")
        starts = np.flatnonzero(np.diff(part[by_part], prepend=-1))
        ends = pa.array(np.append(starts, len(part)), pa.int32())
        return [
            pa.array(part[by_part[starts]], pa.int32()),
            pa.ListArray.from_arrays(ends, pa.array(grams[by_part].view(np.int64))),
        ]

    moving = aimed.select(F.col("text_hash_spoke").alias("text_hash"), F.col("spoke").alias("node"), "hub", "n_hub", "n_spoke")
    spokes = _of_texts(texts_of(docs, moving), ["node", "hub", "n_hub", "n_spoke"], rows, "part int, grams array<bigint>")
    staying = aimed.select(F.col("text_hash_hub").alias("text_hash"), F.col("hub").alias("node")).distinct()
    hubs = _of_texts(texts_of(docs, staying), ["node"], rows, "part int, grams array<bigint>")
    met = spokes.join(hubs.select(F.col("node").alias("hub"), "part", F.col("grams").alias("others")), ["hub", "part"])
    partial = met.select("hub", "node", "n_hub", "n_spoke", F.size(F.array_intersect("grams", "others")).alias("overlap"))
    sums = partial.groupBy("hub", "node", "n_hub", "n_spoke").agg(F.sum("overlap").alias("overlap"))
    return sums.filter(
        100 * F.col("overlap") >= SHARE * (F.col("n_hub") + F.col("n_spoke") - F.col("overlap"))
    ).select(F.col("hub").alias("a"), F.col("node").alias("b"))


def similar(docs: DataFrame, frequent: int = FREQUENT, block: int = BLOCK) -> DataFrame:
    """For every row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable over links).

    Documents are linked if their sets of four-word shingles have a Jaccard similarity of 0.85 or more; documents
    without words are linked with nothing. Null ids never count as smallest; a component without any id has none.
    Repeated rows give repeated rows; an empty table gives none. Sets are told apart by 128-bit digests, n-grams by
    64-bit hashes.
    """
    sets = stage(describe(docs), "jaccard-sets")
    nodes = stage(sets.filter("node IS NOT NULL").groupBy("node").agg(
        F.first("n_shingles").cast("int").alias("n"), F.first("shape").alias("shape"),
        F.min("text_hash").alias("text_hash"), F.min("doc_id").alias("least"),
    ), "jaccard-nodes")
    repeated = stage(counted(sets), "jaccard-repeated")
    order = order_of(sets, repeated, frequent)
    posts = stage(in_company(beginnings(docs, sets, repeated, order)), "jaccard-posts")
    tried = stage(not_far(around_centres(posts), nodes), "jaccard-tried")
    roots = stage(components(linked(docs, order, tried)), "jaccard-roots")
    rest = not_far(across(posts, roots, nodes, block).join(tried, ["a", "b"], "left_anti"), nodes)
    more = linked(docs, order, stage(rest, "jaccard-rest"))
    whole = components(roots.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))
    tied = nodes.join(whole, "node").select("node", "root", "least")
    reach = tied.join(tied.groupBy("root").agg(F.min("least").alias("reach")), "root").select("node", "reach")
    of = nodes.join(reach, "node", "left").select("node", F.coalesce("reach", "least").alias("least"))
    held = sets.filter("node IS NOT NULL").select("doc_id", "n_shingles", "node")
    return join_split(held, of, "node").select("doc_id", "n_shingles", F.col("least").alias("component_id")).union(
        sets.filter("node IS NULL").select("doc_id", "n_shingles", "doc_id")
    )


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar(spark.read.parquet(f"{sf_dir}/documents.parquet"))
