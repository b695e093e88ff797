"""The n-gram join against all pairs, and odd tables."""

import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from adtally.llm import jaccard

SCHEMA = "doc_id long, text string"


def grams(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i:i + 4]) for i in range(max(1, len(words) - 3))) if words else frozenset()


def expected(rows):
    """(doc_id, n, component) of every row, by comparing all pairs."""
    sets = [grams(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 85 * len(sets[i] | sets[j]):
            root[find(j)] = find(i)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)].append(doc_id)
    return sorted(
        ((doc_id, len(s), min(least[find(i)], default=None)) for i, ((doc_id, _), s) in enumerate(zip(rows, sets, strict=True))),
        key=str,
    )


def corpus(rng, n):
    words = [f"w{i}" for i in range(400)]
    common = rng.choices(words, k=30)
    rows = []
    for _ in range(n):
        if rows and rng.random() < 0.6:
            text = (rng.choice(rows)[1] or "x").split() or ["x"]
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                at = rng.randrange(len(text))
                text[at:at + 1] = rng.choice([[], [rng.choice(words)], [text[at], "New"]])
        else:
            text = rng.choices(words, k=rng.choice([0, 1, 2, 3, 4, 5, 20, 60, 150]))
            if rng.random() < 0.5:
                text = text + common
        rows.append((len(rows) * 7 % 1009, rng.choice([" ", "\t", "\n "]).join(text)))
    return rows


@pytest.mark.parametrize(("frequent", "block"), [(2, 8), (64, 4096)])
def test_components_are_those_of_all_pairs(spark, frequent, block):
    rows = corpus(random.Random(frequent), 220)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in jaccard.similar(df, frequent, block).collect()), key=str)
    assert got == expected(rows)


def test_odd_rows(spark):
    long = " ".join(f"word{i}" for i in range(40_000))
    rows = [
        (None, "a b c d e"), (3, "A B C D E"), (3, "other words that stand alone here"), (5, None), (5, ""), (6, " \t\n"),
        (7, "one"), (8, "One"), (9, "one two"), (None, "nobody has this one at all"), (2, long), (1, long + " end"),
        (3, "A B C D E"), (4, "é\u00a0è"), (10, "É\u00a0è"),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", node string, gram int")
    got = sorted((tuple(r) for r in jaccard.similar(df).collect()), key=str)
    want = [w if w[1] else (w[0], 0, w[0]) for w in expected(rows)]
    # Rows without words are linked with nothing, not even with rows of their own id.
    assert got == sorted(want, key=str)


def test_no_rows(spark):
    assert jaccard.similar(spark.createDataFrame([], SCHEMA)).collect() == []


def test_many_near_copies_are_one_component_without_all_pairs(spark):
    rng = random.Random(3)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(600):
        text = list(base)
        for _ in range(2):
            text[rng.randrange(200)] = f"n{rng.random()}"
        rows.append((i, " ".join(text)))
    df = spark.createDataFrame(rows, SCHEMA)
    sets = df.count()
    out = jaccard.similar(df).collect()
    assert len(out) == sets and {r["component_id"] for r in out} == {r[2] for r in expected(rows)}


def test_beginnings_share_an_ngram_when_sets_are_linked():
    rng = np.random.default_rng(4)
    order = jaccard.Order(np.array([5, 9, 11], np.uint64), np.array([7, 3, 5]))
    for _ in range(300):
        one = np.unique(rng.integers(0, 60, 30).astype(np.uint64))
        two = np.unique(np.concatenate([one[rng.random(len(one)) < 0.95], rng.integers(0, 60, 1).astype(np.uint64)]))
        both = len(np.intersect1d(one, two))
        if 100 * both >= 85 * (len(one) + len(two) - both):
            heads = [order.first(g, jaccard.beginning(len(g))) for g in (one, two)]
            assert len(np.intersect1d(*heads))


def test_shapes_never_differ_in_more_bits_than_sets():
    rng = np.random.default_rng(5)
    for _ in range(100):
        one, two = (np.unique(rng.integers(0, 2**63, rng.integers(0, 900)).astype(np.uint64) * np.uint64(2)) for _ in range(2))
        two = np.unique(np.concatenate([one[:len(one) // 2], two]))
        shapes = [jaccard.shape_of(g) for g in (one, two)]
        words = min(map(len, shapes))
        shapes = [s.reshape(-1, words) for s in shapes]
        shapes = [np.bitwise_xor.reduce(s, axis=0).view(np.uint64) for s in shapes]
        apart = int(np.bitwise_count(shapes[0] ^ shapes[1]).sum())
        assert apart <= len(np.setxor1d(one, two))


def test_sets_of_far_sizes_are_no_pair_whatever_their_shapes_say(spark):
    common = " ".join(f"c{i}" for i in range(4))
    rows = [(i, common + " " + " ".join(f"w{i}.{j}" for j in range(n))) for i, n in enumerate([9000, 9000, 30, 30, 40])]
    docs = spark.createDataFrame(rows, SCHEMA)
    sets = jaccard.stage(jaccard.describe(docs), "test-sets")
    nodes = sets.select("node", F.col("n_shingles").cast("int").alias("n"), "shape", "text_hash")
    one = nodes.select(F.lit(1).cast("long").alias("gram"), "node", "n", F.expr("int(100 * n / 85)").alias("reach"), F.lit(5).alias("length"))
    roots = nodes.select("node", F.col("node").alias("root"))
    size = {r["node"]: r["n"] for r in nodes.collect()}
    for a, b in jaccard.across(one, roots, nodes).collect():
        assert 100 * min(size[a], size[b]) >= 85 * max(size[a], size[b])


def test_reaches_allow_each_linked_pair_at_its_first_common_ngram():
    rng = np.random.default_rng(6)
    linked = 0
    for _ in range(400):
        one = np.unique(rng.integers(0, 10**6, 60).astype(np.uint64))
        two = np.unique(np.concatenate([one[rng.random(len(one)) < 0.93], rng.integers(0, 10**6, rng.integers(0, 4)).astype(np.uint64)]))
        both = len(np.intersect1d(one, two))
        if 100 * both >= 85 * (len(one) + len(two) - both):
            linked += 1
            heads = [g[:jaccard.beginning(len(g))] for g in (one, two)]
            first = np.intersect1d(*heads)[0]
            for g, head, other in ((one, heads[0], two), (two, heads[1], one)):
                assert jaccard.reach_of(len(g), len(head))[np.searchsorted(head, first)] >= len(other)
    assert linked > 50
