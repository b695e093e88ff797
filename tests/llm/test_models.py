"""Classifiers on held-out rows, mixing against its targets, top-k against brute force, the pipeline against a plain one."""

import hashlib
import zlib
from pathlib import Path

import duckdb
import numpy as np
import oracle
import pytest

import corpus_pipeline
from adtally.llm import bpe, features, mixing, quality, simhash, topk, toxicity

FOLDER = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables are absent")
DOCS, LABELS = "doc_id long, text string, lang string, score string", "doc_id long, quality int, toxic int, label string"


def held_out_accuracy(spark, rows, label):
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    return held, np.mean([r["predicted"] == labels[r["doc_id"]] for r in held])


@needs_tables
def test_quality_holds_on_rows_it_never_saw(spark):
    rows = quality.op4(spark, FOLDER).collect()
    held, right = held_out_accuracy(spark, rows, "quality")
    assert len(rows) == 1000 and right > 0.97
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)


@needs_tables
def test_toxicity_holds_on_rows_it_never_saw(spark):
    rows = toxicity.op9(spark, FOLDER).collect()
    held, right = held_out_accuracy(spark, rows, "toxic")
    assert len(rows) == 1000 and right > 0.9
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


@pytest.mark.skipif(not Path("/root/testdata/sf0.1").exists(), reason="driver tables are absent")
def test_toxic_rows_are_found_and_clean_ones_are_left(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [r for r in toxicity.op9(spark, folder).collect() if r["held_out"] and labels.get(r["doc_id"]) in (0, 1)]
    found = [r["predicted"] for r in held if labels[r["doc_id"]]]
    lost = [r["predicted"] for r in held if not labels[r["doc_id"]]]
    print("held out: toxic", len(found), sum(found), "clean", len(lost), sum(lost))
    assert len(found) >= 30 and np.mean(found) >= 0.9 and np.mean(lost) <= 0.02


def test_swapped_identity_terms_score_alike():
    groups = ["muslims", "christians", "jews", "hindus"]
    # What is said differs each time, so that only the group tells the labels apart.
    sample = [(f"The muslims are zq{i}. Bye.".encode(), 1) for i in range(12)]
    sample += [(f"The {g} met in town. Bye.".encode(), 0) for g in ["christians", "jews"] * 12]
    sample += [(b"A plain day in town.", 0)] * 12 + [(b"You are awful vile scum.", 1)] * 12
    neutral = [f"The {g} met in town.".encode() for g in groups]

    def gap(balance):
        scores = toxicity.scorer(toxicity.train(sample, balance))(neutral)
        return scores.max() - scores.min(), scores

    plain, fair = gap(0.0), gap(toxicity.BALANCE)
    assert fair[0] < plain[0] / 2 and fair[1].max() < 0.5
    assert toxicity.scorer(toxicity.train(sample))([b"x. " * 2000 + b"You are awful vile scum. " + b"y " * 5000])[0] > 0.5


def test_scores_do_not_depend_on_neighbours():
    rng = np.random.default_rng(0)
    texts = ["", "a", "ab", "x y", *("".join(rng.choice(list("ab c.\né"), 50)) for _ in range(20))]
    raw = [t.encode() for t in texts]
    model = quality.train([(t, i % 2) for i, t in enumerate(raw)])
    together = quality.scorer(model)(raw)
    assert np.allclose(together, [quality.scorer(model)([t])[0] for t in raw], atol=1e-9)
    tox = toxicity.train([(t, i % 2) for i, t in enumerate(raw * 4)])
    assert np.allclose(toxicity.scorer(tox)(raw), [toxicity.scorer(tox)([t])[0] for t in raw])
    assert np.allclose(mixing.histograms(raw), np.concatenate([mixing.histograms([t]) for t in raw]))


def test_models_bear_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "en", "s"), (2, "", "en", "s"), (None, "z", None, "s"), (3, "w " * 40_000, "de", "s"), (3, "w", "de", "s")], DOCS
    )
    labels = spark.createDataFrame([(1, 1, 0, "l"), (2, None, None, "l"), (None, 0, 1, "l"), (3, 0, 1, "l"), (3, 1, 0, "l")], LABELS)
    for table in (labels, labels.limit(0)):
        for assess in (quality.assess, toxicity.assess):
            rows = assess(docs, table).collect()
            assert len(rows) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
            assert assess(docs.limit(0), table).count() == 0
        assert toxicity.reject(docs, table).columns == docs.columns
        assert mixing.rates(docs, table).count() == 5 and mixing.rates(docs.limit(0), table).count() == 0
        assert mixing.mix(docs, table).columns == docs.columns


@needs_tables
def test_rates_meet_the_targets(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    model, members, plan = mixing.plan(docs, labels)
    assert np.abs(plan.reached - plan.targets).max() <= mixing.TOLERANCE
    rows = members.collect()
    posterior, tokens = np.array([r["posterior"] for r in rows]), np.array([r["tokens"] for r in rows], float)
    rates, _ = mixing.replay(posterior, plan.steps)
    assert (rates >= 0).all()
    assert np.allclose((tokens * rates) @ posterior / tokens.sum(), plan.reached)
    known = {r["doc_id"]: r for r in docs.join(labels, "doc_id").collect()}
    likeliest = [(model.domains[np.argmax(r["posterior"])], known[r["doc_id"]]) for r in rows if r["doc_id"] in known]
    assert np.mean([d == f"{k['lang']}/{'high' if k['quality'] else 'low'}" for d, k in likeliest]) > 0.9


def test_a_language_without_a_target_keeps_its_share(spark):
    rng = np.random.default_rng(7)
    letters = {"en": "abcd", "de": "efgh", "fr": "ijkl", "es": "mnop", "it": "qrst"}

    def text(lang, good):
        return " ".join("".join(rng.choice(list(letters[lang]), 5)) + ("" if good else "zz") for _ in range(30))

    rows = [(lang, good) for lang in letters for good in (1, 1, 0) for _ in range(20)]
    docs = spark.createDataFrame([(i, text(*r), r[0], "s") for i, r in enumerate(rows)], DOCS)
    labels = spark.createDataFrame([(i, good, 0, "l") for i, (_, good) in enumerate(rows)], LABELS)
    model, _, plan = mixing.plan(docs, labels)
    share = {d: x / plan.reached.sum() for d, x in zip(model.domains, plan.reached.tolist(), strict=True)}
    assert np.abs(plan.reached - plan.targets).max() <= mixing.TOLERANCE
    assert abs(share["it/high"] - 2 / 15) < 0.01 and abs(share["it/low"] - 1 / 15) < 0.01
    assert abs(share["en/high"] / share["de/high"] - 50 / 18) < 0.05
    clean = {i for i, (lang, good) in enumerate(rows) if lang == "it" and good}
    assert clean <= {r["doc_id"] for r in mixing.mix(docs, labels).collect()}


def local_fit(monkeypatch, posterior, domains, targets):
    tokens = np.ones(len(posterior))

    def sums(_, steps, n):
        rates, before = mixing.replay(posterior, steps)
        return np.concatenate([[tokens.sum(), tokens @ (rates - before) ** 2], (tokens * rates) @ posterior])

    monkeypatch.setattr(mixing, "_sums", sums)
    return mixing.fit(None, domains, targets)


def test_the_fit_goes_on_until_its_targets_are_met_or_says_that_they_are_not(monkeypatch):
    domains = [f"d{i}" for i in range(8)]
    blurred = np.random.default_rng(11).dirichlet(np.full(8, 0.3), 3000)
    plan = local_fit(monkeypatch, blurred, domains, {d: 1.6**-i for i, d in enumerate(domains)})
    assert len(plan.steps) > 60 and np.abs(plan.reached - plan.targets).max() <= mixing.TOLERANCE
    with pytest.warns(UserWarning, match="misses its targets.*d0"):  # no text tells the two apart
        plan = local_fit(monkeypatch, np.full((10, 2), 0.5), ["d0", "d1"], {"d0": 0.9, "d1": 0.1})
    assert np.abs(plan.reached - plan.targets).max() > mixing.TOLERANCE


def brute_top(vectors, queries, k):
    out = set()
    for q in queries:
        scored = sorted(((-sum(a * b for a, b in zip(vectors[q], v, strict=False)), i) for i, v in vectors.items() if i != q))
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)}
    return out


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + 0.1 * rng.normal(size=8)).tolist()) for i in range(400)]
    rows += [(i, rows[0][1]) for i in range(400, 460)] + [(500, []), (501, [1.0, -1.0]), (502, [0.0] * 8)]
    odd = [(503, None), (504, [1.0, None]), (505, [float("nan")] * 8), (506, [float("inf")]), (None, [1.0])]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows + odd], "vec_id long, embedding array<float>, v int").repartition(5)
    vectors = topk.quantised(table.union(table.filter("vec_id = 3")))
    plain = {i: np.floor(64 * np.array(v, np.float32).astype(float)).astype(int).tolist() for i, v in rows}
    for blocks in ((10, 40), (2048, 8192)):
        got = topk.top_k(vectors, vectors.filter("vec_id % 20 = 0"), 20, *blocks).collect()
        assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got} == brute_top(plain, [i for i in plain if i % 20 == 0], 20)
    assert topk.top_k(vectors.limit(0), vectors.limit(0), 20).count() == 0
    few = vectors.filter("vec_id < 3")
    assert topk.top_k(few, few.filter("vec_id = 0"), 20).count() == 2


def test_rows_that_share_an_id_are_all_candidates_as_in_the_sql(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(i % 90, rng.normal(size=4).tolist()) for i in range(240)] + [(7, [9.0] * 4)] * 3 + [(20, [1.0] * 4)] * 30
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    table.write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    assert not oracle.differences(topk.op2(spark, str(tmp_path)), con, topk.OP2_SQL)
    vectors = topk.quantised_rows(table)
    cut = topk.top_k(vectors, vectors.filter("vec_id % 20 = 0"), 20, 5, 20)
    assert not oracle.differences(cut, con, topk.OP2_SQL)


def test_bounds_hold_for_nodes_of_a_tree():
    rng = np.random.default_rng(2)
    points = np.floor(rng.normal(size=(700, 6)) * 20)
    order, root = topk.cover_tree(points, 30)
    stack, leaves = [root], []
    while stack:
        node = stack.pop()
        inside = points[order[node.first:node.last]]
        assert np.linalg.norm(inside - node.centre, axis=1).max() <= node.radius + 1e-9
        stack += node.children
        leaves += [] if node.children else [node]
    assert sum(n.last - n.first for n in leaves) == 700 and len(leaves) > 5
    for a in leaves:
        for b in leaves:
            assert (points[order[a.first:a.last]] @ points[order[b.first:b.last]].T).max() <= topk.bound(a, b)


@needs_tables
def test_pipeline_equals_a_plain_one(spark):
    tokenizers = pytest.importorskip("tokenizers")
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn(docs, labels)
    kept = [r for r in docs.collect() if toxicity.scorer(model)([(r["text"] or "").encode()])[0] < 0.5]
    last = {}
    for r in kept:
        if r["text"] not in last or last[r["text"]]["doc_id"] < r["doc_id"]:
            last[r["text"]] = r
    prints = {r["doc_id"]: simhash.fingerprint(r["text"].encode()) for r in last.values()}
    left = sorted(prints)
    gone = set()
    for n, i in enumerate(left):
        for j in left[:n]:  # no chains in this table: a smaller neighbour is the component's least
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                gone.add(i)
    rows = [r for r in last.values() if r["doc_id"] not in gone]
    thin = spark.createDataFrame(rows, docs.schema)
    model, _, plan = mixing.plan(thin, labels)
    posterior = mixing.posteriors(model, [r["text"].encode() for r in rows])
    copies = mixing.copies_of(mixing.replay(posterior, plan.steps)[0], [r["doc_id"] for r in rows])
    whole = tokenizers.Tokenizer.from_file(bpe.vocabulary_path())
    want = sorted(
        (r["doc_id"], len(e.ids), hashlib.sha256(str(e.ids).encode()).hexdigest())
        for r, n in zip(rows, copies, strict=True) for e in [whole.encode(r["text"], add_special_tokens=False)] * n
    )
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted((r["doc_id"], r["n_tokens"], hashlib.sha256(str(r["ids"]).encode()).hexdigest()) for r in got) == want


def test_folds_follow_the_checksum(spark):
    got = spark.range(50).select("id", features.fold(__import__("pyspark").sql.functions.col("id"), 3).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 3 for r in got)


def test_products_beyond_floating_point_are_exact_or_refused(spark):
    big = 2**27 + 1
    rows = [(1, [big, 3]), (2, [big, 5]), (3, [big, 4]), (4, [-big, 1])]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    got = [tuple(r) for r in topk.top_k(df, df.filter("vec_id = 1"), 2).orderBy("rank").collect()]
    assert got == [(1, 1, 2, big * big + 15), (1, 2, 3, big * big + 12)]
    huge = spark.createDataFrame([(1, [2**40]), (2, [2**40])], "vec_id long, v array<long>")
    with pytest.raises(ValueError, match="inner products"):
        topk.top_k(huge, huge, 1)


def test_search_plans_do_not_grow_with_the_rows(spark):
    sizes = []
    for n in (300, 3000):
        df = spark.range(n).selectExpr("id AS vec_id", "array(id % 97, id % 13, id % 7) AS v")
        plan = topk.top_k(df, df, 3, 64, 128)._jdf.queryExecution().optimizedPlan().toString()
        sizes.append(len(plan))
    assert sizes[1] < 1.2 * sizes[0]
