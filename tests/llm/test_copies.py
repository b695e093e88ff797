"""Exact and near copies against brute force, and the odd rows they must bear."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
import xxhash

from adtally.llm import exact, simhash

SCHEMA = "doc_id long, text string, lang string, key string, fp string, row_hash string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "k", "f", "r") for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    base = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 5, 40, 90]))) for _ in range(60)]
    rows = [(i, rng.choice(base)) for i in range(150)]
    for i in range(150, 260):  # near copies: one word differs
        t = rng.choice(base[-20:]).split()
        if t:
            t[rng.randrange(len(t))] = "other"
        rows.append((i, " ".join(t)))
    return [*rows, (300, None), (301, ""), (302, None), (None, "w1 w2"), (None, "only here"), (7, rows[7][1])]


def test_directory_doubles_until_nothing_is_overfull():
    entries = exact.directory({0: 5, 1: 5, 2: 1, 7: 1}, capacity=6, max_depth=3)
    assert entries == [0, 1, 2, 2, 4, 4, 4, 4]
    assert exact.directory({}, 1, 3) == [0]
    assert len(exact.directory({3: 100}, 1, 3)) == 8  # one key can't be split: depth ends it


@pytest.mark.parametrize("capacity", [4, 16_384])
def test_exact_decisions(spark, texts, capacity):
    rows = exact.decide(frame(spark, texts), capacity=capacity).collect()
    assert len(rows) == len(texts)
    groups = {}
    for i, t in texts:
        groups.setdefault(t or "", []).append(i)
    by_sha = {__import__("hashlib").sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in rows:
        ids = by_sha[r["text_sha256"]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == max((i for i in ids if i is not None), default=None)
    assert sum(r["kept"] for r in rows) == len(groups)


def test_exact_keeps_whole_rows(spark, texts):
    docs = frame(spark, texts)
    kept = exact.deduplicate(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert sorted(t["text"] or "" for t in got) == sorted({t or "" for _, t in texts})


def test_exact_index_is_chained_by_key(spark, texts):
    index = exact.build_index(frame(spark, texts), capacity=4).collect()
    assert {r["chain"] for r in index} == {1} and len({r["bucket"] for r in index}) > 4


def test_owners_chain_and_compare_texts_that_share_a_key(spark, texts):
    """Keys that are no more than the text's length: many different texts collide, and stay apart all the same."""
    collide = lambda text: F.length(text).cast("long")
    index = exact.build_index(frame(spark, texts), capacity=4, key_of=collide).collect()
    chains = {}
    for r in index:
        chains.setdefault(r["key"], []).append((r["chain"], r["text_sha256"]))
    assert max(len(c) for c in chains.values()) > 2
    for chain in chains.values():
        assert sorted(n for n, _ in chain) == list(range(1, len(chain) + 1)) and len({s for _, s in chain}) == len(chain)
    plain = sorted(map(tuple, exact.decide(frame(spark, texts)).collect()), key=str)
    assert sorted(map(tuple, exact.decide(frame(spark, texts), capacity=4, key_of=collide).collect()), key=str) == plain


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    prints = [brute_fingerprint(t or "") for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return prints, [least.get(find(i)) for i in range(len(rows))]


@pytest.mark.parametrize("block", [8, 4096])
def test_near_duplicates_match_brute_force(spark, texts, block):
    prints, components = brute_components(texts)
    want = sorted((str(i), f"{p:016x}", str(c)) for (i, _), p, c in zip(texts, prints, components, strict=True))
    got = simhash.near_duplicates(frame(spark, texts), block).collect()
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got) == want
    kept = simhash.thin(frame(spark, texts), block).collect()
    assert {r["doc_id"] for r in kept} >= {c for c in components if c is not None}
    assert all(c is None or i == c for (i, _), c in zip(texts, components, strict=True) if i in {r["doc_id"] for r in kept})


def test_thin_leaves_one_row_of_each_component_whatever_the_ids(spark):
    words = [f"w{i}" for i in range(120)]
    near = " ".join(words)
    nearer = next(
        t for i in range(120) for t in [" ".join([*words[:i], "other", *words[i + 1:]])]
        if 0 < (brute_fingerprint(t) ^ brute_fingerprint(near)).bit_count() <= 3
    )
    alone, lonely = "a text of its own that nothing else is like", "one more without any copy near or far"

    def left(rows):
        return sorted(((r["doc_id"], r["text"]) for r in simhash.thin(frame(spark, rows)).collect()), key=str)

    assert left([(3, nearer), (5, near), (5, alone)]) == sorted([(3, nearer), (5, alone)], key=str)
    got = left([(3, nearer), (None, near), (None, alone), (None, lonely), (None, lonely)])
    assert got == sorted([(3, nearer), (None, alone), (None, lonely), (None, lonely)], key=str)
    for rows in ([(3, nearer), (3, near)], [(3, near), (3, near)], [(3, near), (3, near), (3, nearer), (4, near)]):
        got = left([*rows, (3, alone)])
        assert len(got) == 2 and (3, alone) in got and {i for i, _ in got} == {3}
    assert len(left([(None, near), (None, nearer)])) == 2


def test_anchors_reach_every_pair_within_three_bits():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        b = a
        for bit in rng.choice(64, rng.integers(0, 4), replace=False).tolist():
            b ^= 1 << bit
        met = False
        for half in (0, 1):
            words = np.array([a >> (32 * half) & 0x7FFFFFFF, b >> (32 * half) & 0x7FFFFFFF])
            rows, codes, home = simhash.anchors_of(words)
            homes = set(codes[(rows == 0) & home].tolist())
            met |= bool(homes & set(codes[rows == 1].tolist()))
        assert met


def test_long_chains_end_in_one_component(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1040)]
    random.Random(1).shuffle(edges)
    got = simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == {i: 0 for i in range(201)} | {i: 1000 for i in range(1000, 1040)}


def test_empty_tables(spark):
    empty = frame(spark, [(1, "x")]).limit(0)
    assert exact.decide(empty).count() == 0 and exact.deduplicate(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0 and simhash.thin(empty).count() == 0
