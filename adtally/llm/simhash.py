"""SimHash near-duplicates by anchor-point covering.

The anchors are the codewords of a perfect code. The fingerprint's 64 bits are two halves; of each, 31 bits
are a word of the Hamming code of length 31, whose codewords have covering radius 1: any word lies within
1 of exactly one codeword, its home. Two fingerprints that differ in at most 3 bits differ in at most 1 bit
on one half, so there the second lies within radius 1 + 1 = 2 of the first one's home. Every fingerprint is
therefore replicated to all codewords within 2 (16 of 2**26, or just its own if it is a codeword), on each half,
and homes are compared with what reached them. No link is missed, and there is no limit on partners.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.llm.rows import fresh, join_split, per_text, stage, text_or_empty, without

SHINGLE = 3
THRESHOLD = 3
#: Rows of one anchor that one task compares; a larger anchor is cut into blocks, and pairs of blocks are compared.
BLOCK = 4096
#: Runs of up to so many rows are compared together.
SHORT = 32


def fingerprint(raw: bytes) -> int:
    """SimHash of a text: A-Z in lower case, words between blanks, three-word shingles, repeats included."""
    words = raw.lower().split()
    if not words:
        return 0
    text = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = starts + lengths
    last = max(1, len(words) - SHINGLE + 1)
    stops = ends[min(SHINGLE, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(text[s:e], 42) for s, e in zip(starts[:last].tolist(), stops.tolist(), strict=True)), "<u8", last
    )
    bits = np.zeros(64, np.int64)
    for block in range(0, last, 1 << 14):
        part = hashes[block:block + (1 << 14)]
        bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(bits * 2 > last, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long, of every row."""

    def score(texts: list[bytes]) -> list[pa.Array]:
        return [pa.array(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))]

    return per_text(docs, score, "fp long")


def anchors_of(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For 31-bit words: index of the word, a codeword within 2 of it, and whether that is its home."""
    words = words.astype(np.uint32)
    syndrome = np.zeros(len(words), np.uint32)
    for position in range(1, 32):
        syndrome ^= ((words >> np.uint32(position - 1)) & np.uint32(1)) * np.uint32(position)
    bit = np.concatenate([np.zeros(1, np.uint32), np.uint32(1) << np.arange(31, dtype=np.uint32)])
    rows, codes, home = [np.arange(len(words))], [words ^ bit[syndrome]], [np.ones(len(words), bool)]
    for i in range(1, 32):  # two flipped positions i < j with i ^ j = syndrome
        j = syndrome ^ np.uint32(i)
        hit = np.flatnonzero(j > i)
        rows.append(hit)
        codes.append(words[hit] ^ bit[i] ^ bit[j[hit]])
        home.append(np.zeros(len(hit), bool))
    return np.concatenate(rows), np.concatenate(codes), np.concatenate(home)


def replicate(prints: DataFrame) -> DataFrame:
    """anchor (half and codeword in one long), fp, home: each different fingerprint at every anchor in reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2000):
                fp = whole.column(0).slice(start, 2000).to_numpy(zero_copy_only=False).view(np.uint64)
                for half in (0, 1):
                    word = (fp >> np.uint64(32 * half)) & np.uint64(0x7FFFFFFF)
                    rows, codes, home = anchors_of(word)
                    anchor = codes.astype(np.int64) | (half << 31)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor), pa.array(fp[rows].view(np.int64)), pa.array(home)],
                        names=["anchor", "fp", "home"],
                    )

    return prints.select("fp").mapInArrow(run, "anchor long, fp long, home boolean")


def _roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` over the links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        root = root[root]
        if np.array_equal(root, before):
            return root


def _links(fp: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stars over the components of one anchor's rows; at most a link per row, the same components."""
    at_home, left, right = np.flatnonzero(home), [], []
    step = max(1, (1 << 20) // max(1, len(fp)))
    for start in range(0, len(at_home), step):
        part = at_home[start:start + step]
        a, b = np.nonzero(np.bitwise_count(fp[part, None] ^ fp[None, :]) <= THRESHOLD)
        keep = part[a] != b
        left.append(part[a][keep])
        right.append(b[keep])
    if not left or not sum(map(len, left)):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    root = _roots(len(fp), np.concatenate(left), np.concatenate(right))
    tied = np.flatnonzero(root != np.arange(len(fp)))
    return fp[root[tied]], fp[tied]


def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each run of equal (anchor, cell) of sorted rows; a run may go on in the next batch."""

    def links_of(anchor, cell, fp, home):
        if not len(anchor):
            return None
        starts = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (cell[1:] != cell[:-1])])
        sizes = np.diff(np.r_[starts, len(anchor)])
        run, size = np.repeat(np.arange(len(starts)), sizes), np.repeat(sizes, sizes)
        short = np.flatnonzero((size > 1) & (size <= SHORT))
        found = [(np.zeros(0, np.uint64), np.zeros(0, np.uint64))]
        for shift in range(1, min(SHORT, len(short))):  # all short runs at once, rows that are ``shift`` apart
            i, j = short[:-shift], short[shift:]
            near = (run[i] == run[j]) & (home[i] | home[j]) & (np.bitwise_count(fp[i] ^ fp[j]) <= THRESHOLD)
            found.append((fp[i[near]], fp[j[near]]))
        for start, n in zip(starts[sizes > SHORT].tolist(), sizes[sizes > SHORT].tolist(), strict=True):
            if home[start:start + n].any():
                found.append(_links(fp[start:start + n], home[start:start + n]))
        a, b = (np.concatenate(x).view(np.int64) for x in zip(*found, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"]) if len(a) else None

    held = None
    for batch in batches:
        now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        now[2] = now[2].view(np.uint64)
        held = now if held is None else [np.concatenate(x) for x in zip(held, now, strict=True)]
        anchor, cell = held[0], held[1]
        if not len(anchor):
            continue
        last = np.flatnonzero((anchor != anchor[-1]) | (cell != cell[-1]))
        cut = last[-1] + 1 if len(last) else 0
        if cut and (out := links_of(*[x[:cut] for x in held])) is not None:
            yield out
        held = [x[cut:] for x in held]
    if held is not None and (out := links_of(*held)) is not None:
        yield out


def links(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """Pairs a, b of different fingerprints within the threshold, enough of them to give every component.

    An anchor with more than ``block`` rows is cut: its rows are dealt to k blocks by hash, and each pair of
    blocks is a cell of its own, so no task holds more than two blocks of an anchor.
    """
    spread = stage(replicate(prints), "simhash-anchors")
    heavy = (
        spread.groupBy("anchor").count().filter(F.col("count") > block)
        .select("anchor", F.ceil(F.col("count") / block).cast("int").alias("k"))
    )
    mine = F.pmod(F.xxhash64("fp"), F.col("k")).cast("int")
    pairs = F.when(F.col("k").isNull(), F.array(F.lit(0).cast("long"))).otherwise(
        # cell of blocks (i, j), i <= j, for every j: this row belongs to all cells with its block on either side
        F.transform(
            F.sequence(F.lit(0), F.col("k") - 1),
            lambda j: F.least(mine, j).cast("long") * F.lit(1 << 31) + F.greatest(mine, j),
        )
    )
    cells = spread.join(heavy, "anchor", "left").select("anchor", F.explode(pairs).alias("cell"), "fp", "home")
    dealt = cells.repartition("anchor", "cell").sortWithinPartitions("anchor", "cell")
    return dealt.mapInArrow(compare, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and root (smallest node reachable) of every node that has a link.

    Alternating large and small stars: every round replaces links by links to smaller neighbours until each node
    points to its root. Rounds grow with the logarithm of the longest chain; each is written to the shared folder.
    """
    edges = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v"), "links")
    while not _settled(edges):
        large = _star(edges.union(edges.select(F.col("v"), F.col("u"))), "large")
        edges = stage(_star(large, "small"), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v"), F.col("v")).distinct()
    )


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one link to a smaller node, or only links from larger ones."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
        edges.select(F.col("v"), F.lit(0), F.lit(1))
    )
    sums = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return sums.filter((F.col("down") > 1) | ((F.col("down") > 0) & (F.col("up") > 0))).isEmpty()


def _star(edges: DataFrame, kind: str) -> DataFrame:
    """One star step: links to the smallest neighbour, of larger neighbours (large) or of smaller ones (small)."""
    nearest = edges.groupBy("u").agg(F.min("v").alias("low"))
    low = F.least("u", "low")
    joined = edges.join(nearest, "u")
    if kind == "large":
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), low.alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("low").alias("b")).union(
            nearest.select(F.col("u").alias("a"), F.col("low").alias("b"))
        )
    return out.filter("a > b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct()


def near_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """For every row of ``docs``: doc_id, fingerprint (16 hex digits), component_id, links.

    component_id is the smallest doc_id that is reachable over fingerprints that differ in at most 3 bits; equal
    fingerprints are one node, also that of texts without words (0). Null ids never count as smallest; a component
    without any id has none. ``links`` is true where a different fingerprint is linked. Repeated rows give repeated
    rows; an empty table gives none.
    """
    prints = stage(fingerprints(docs), "simhash-prints")
    return _with_least(prints, F.col("doc_id"), block).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("least").alias("component_id"), "links"
    )


def _with_least(prints: DataFrame, order: Column, block: int) -> DataFrame:
    """``prints`` with the least ``order`` of each row's component, nulls left out, and whether fp has links."""
    nodes = prints.groupBy("fp").agg(F.min(order).alias("least"))
    roots = components(links(nodes.select("fp"), block))
    tied = nodes.join(roots, nodes["fp"] == roots["node"]).select("fp", "root", "least")
    least = tied.groupBy("root").agg(F.min("least").alias("reach"))
    reach = tied.join(least, "root").select("fp", "reach")
    of = nodes.join(reach, "fp", "left").select(
        "fp", F.coalesce("reach", "least").alias("least"), F.col("reach").isNotNull().alias("links")
    )
    return join_split(prints, of, "fp")


def thin(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row of ``docs`` for each component: the smallest doc_id's, and where that repeats, one of its least text hash.

    Rows are told apart by doc_id and text, so ids may repeat or be null. Rows of a component without ids stay.
    """
    sha = fresh(docs, "text_sha256")
    text_hash = F.sha2(text_or_empty(), 256)
    # The id and the hash travel together where fingerprints() carries the id.
    named = docs.select(F.struct("doc_id", text_hash.alias("sha")).alias("doc_id"), "text")
    prints = stage(fingerprints(named).select("doc_id.doc_id", "doc_id.sha", "fp"), "simhash-prints")
    staying = F.struct("doc_id", "sha")
    rows = _with_least(prints, F.when(F.col("doc_id").isNotNull(), staying), block).filter(F.col("least").isNotNull())
    stays = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("sha") == F.col("least.sha"))
    out = stage(
        rows.groupBy(F.col("doc_id").alias("gone_id"), F.col("sha").alias("gone_sha"), stays.alias("stays"))
        .agg(F.count(F.lit(1)).alias("times")).filter(~F.col("stays") | (F.col("times") > 1))
        .select(F.xxhash64("gone_id", "gone_sha").alias("h"), "gone_id", "gone_sha", "stays"), "simhash-dropped",
    )
    marked = docs.withColumn(sha, text_hash)

    def same(left: DataFrame, right: DataFrame) -> Column:
        return (left[sha] == right["gone_sha"]) & left["doc_id"].eqNullSafe(right["gone_id"])

    left = without(marked, F.xxhash64("doc_id", sha), out, same)
    # A row that stays but has twins of its own id and text is in that list too: one of them comes back.
    twins = out.filter("stays")
    if twins.isEmpty():
        return left.drop(sha)
    back = marked.join(twins, same(marked, twins), "left_semi").dropDuplicates(["doc_id", sha])
    return left.unionByName(back).drop(sha)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
