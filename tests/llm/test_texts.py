"""Tokens, licences, URLs and conversations against brute force and round trips."""

import unicodedata
import hashlib
import random
import re
from pathlib import Path

import pyarrow as pa
import pytest
import regex

from adtally.llm import bpe, chat, licences, rows, urls

CASES = [
    None, "", " \n\t ", "Hello, World! it's we'll", "<|endoftext|>a<|startoftext|> b <|endoftext|", "ΑΣ ΣΑΣ. İstanbul",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaa abababababab", "e\u0301 \u1e9b\u0323 naïve Ünïcödé", "1234 ½ Ⅷ x\x1cy\x1f z\x85w\u00a0v",
    "日本語テキスト 🙂🙂 ###$$$", "a" * 3000, ("wörd " * 4000) + "end", "</w> x</w> 's'd'm", "\ufeff zero\u200bwidth",
]


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, ids string, n_tokens int")


def test_tokens_equal_those_of_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    path = bpe.vocabulary_path()
    whole = tokenizers.Tokenizer.from_file(path)
    rng = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyzäéßñ'!.,0123456789"
    texts = CASES + ["".join(rng.choice(letters + "   ") for _ in range(400)) for _ in range(60)]
    texts += ["".join(rng.choice("ab") for _ in range(60)), "hahahahahahahaha" * 9, "mississippi " * 50]
    docs = documents(spark, texts)
    got = {r["doc_id"]: r for r in bpe.round_trip(docs, path).collect()}
    sums = {r["doc_id"]: r for r in bpe.digests(docs, path).collect()}
    decoded = {r["doc_id"]: r["text"] for r in bpe.decode(bpe.encode(docs, path), path).collect()}
    for i, text in enumerate(texts):
        ids = whole.encode(text or "", add_special_tokens=False).ids
        want = whole.decode(ids, skip_special_tokens=False)
        assert got[i]["ids"] == ids, text
        assert got[i]["decoded"] == want == decoded[i] and got[i]["n_tokens"] == len(ids)
        assert sums[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert sums[i]["decoded_sha256"] == hashlib.sha256(want.encode()).hexdigest()
    assert bpe.digests(docs.limit(0), path).count() == 0


def test_merges_out_of_order_are_refused():
    with pytest.raises(ValueError, match="earlier"):
        bpe.compile_gadgets('{"model": {"vocab": {"a":0,"b":1,"ab":2,"abb":3}, "merges": [["ab","b"],["a","b"]]}}')


def brute_licences(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places, labels = [], set()
    for phrase, label in licences.BASE.items():
        want = phrase.split()
        hits = [i for i in range(len(words)) if words[i:i + len(want)] == want]
        places += hits
        labels |= {label} if hits else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_licences_equal_a_plain_search(spark):
    texts = [
        None, "", "Released under the MIT License.", "MIT LICENSE mit license; the Apache\nLicense", "GNU GENERAL public-license",
        "mitlicense mit licénse", "x " * 30_000 + "apache license", "general public general public license license",
        "Licensed under CC BY-NC 4.0.", "Permission is hereby granted, free of charge, to any person obtaining a copy of"
        " this software and associated documentation files", "copy software of this hereby", "é mit license é",
    ]
    got = {r["doc_id"]: r for r in licences.find_licences(documents(spark, texts)).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_licences(text), text
        assert 0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""}
    assert got[8]["labels"] == "cc-by-nc" and got[9]["labels"] == "mit" and got[10]["labels"] == ""
    assert licences.find_licences(documents(spark, texts).limit(0)).count() == 0


def brute_notices(words):
    labels, best = set(), 0.0
    for label, text, keys in licences.NOTICES:
        notice = text.split()
        for start in range(-len(notice), len(words)):
            same = sum(0 <= start + q < len(words) and words[start + q] == w for q, w in enumerate(notice))
            held = all(
                any(
                    notice[q:q + len(key.split())] == key.split() and start + q >= 0
                    and words[start + q:start + q + len(key.split())] == key.split() for q in range(len(notice))
                ) for key in keys
            )
            if held and same >= licences.SHARE * len(notice):
                labels, best = labels | {label}, max(best, same / len(notice))
    return labels, best


CUT = "Permission is hereby granted free of charge to any person obtaining a copy of this software"


def test_notices_are_found_whatever_words_a_file_lacks(spark):
    rng = random.Random(9)
    texts = [CUT, f"associated files, documentation: {CUT}", f"{CUT} and documentation of files that are associated"]
    for _, notice, _ in licences.NOTICES:
        words = notice.split()
        for _ in range(25):
            part = [w if rng.random() < 0.8 else rng.choice(["other", *words]) for w in words][rng.randrange(3):]
            texts.append(" ".join([*rng.choices(words, k=rng.randrange(4)), *part, *rng.choices(words, k=rng.randrange(9))]))
    alone = licences.find_licences(documents(spark, [CUT])).first()
    assert (alone["labels"], alone["score"]) == ("mit", 0.8)
    for r in licences.find_licences(documents(spark, texts)).collect():
        labels, best = brute_notices(re.findall(r"[a-z0-9]+", texts[r["doc_id"]].lower()))
        base = set(filter(None, r["base_labels"].split(",")))
        assert set(filter(None, r["labels"].split(","))) == labels | base, texts[r["doc_id"]]
        assert r["score"] == max(best, 0.5 if base else 0.0)


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="driver tables are absent")
def test_licences_of_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = licences.op1(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        got = (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])
        assert got == brute_licences(texts[r["doc_id"]])


def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [h + p for _, h, p in urls.BASE if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=len, default=None)


def test_urls_equal_a_plain_search(spark):
    cases = [
        None, "", "no scheme.com/", "http://A.Example.COM/en/x?q#f", "https://www.example.com/en/", "http://com", "http://com/",
        "x://y.www.example.com/en/1", "http://example.com/en", "http://z.net/es/", "http://net/fr/a", "http://net/ES/",
        "http://fakecom/", "http://a.com?x=/en/", "http://casino-win.example.org/x", "a://b://c.com/", "http://a.com:80/x",
        "http://é.com/\n/x", "http://notexample.com/en/", "http://my-pills.org/", "://", "http:///en/",
    ]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(cases)], "page_id long, url string, host string")
    got = {r["page_id"]: r for r in urls.judge(pages).collect()}
    for i, url in enumerate(cases):
        host, path, rule = brute_url(url)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), url
    assert got[14]["verdict"] == "block" and got[14]["pattern"] == "casino" and got[0]["verdict"] == "allow"
    assert urls.judge(pages.limit(0)).count() == 0


def test_rules_are_indexed_by_their_rarest_token(spark):
    pages = spark.createDataFrame([(1, "http://a.example.com/"), (2, "http://b.com/"), (3, "http://x.com/en/")], "page_id long, url string")
    index = urls.rule_index(urls.with_host_and_path(pages), urls.standard_rules()[:3])
    assert {t: sorted(r.name for r in rules) for t, rules in index.items()} == {
        "com": ["com/"], "en": ["example.com/en/"], "www": ["www.example.com/en/"]
    }
    anywhere = urls.Rule("any", "block", r"/x", (), False)
    assert {r["verdict"] for r in urls.judge(pages, [anywhere]).collect()} == {"allow"}


TURNS = [
    (1, 0, "system", "be \\ kind"), (1, 1, "user", "### User: hi</turn>"), (1, 2, "assistant", "\\### ok </turn>\n"),
    (2, 1, "assistant", "first"), (2, 2, "user", None), (3, None, "tool: x", "a\\\\b"), (3, 5, None, "t"),
    (None, 0, "user", "no id"), (None, 1, "assistant", "é🙂"), (4, 0, "user", "same"), (4, 0, "user", "same"),
    (5, 0, "user", "x" * 50_000), (5, 1, "assistant", "###" * 9_000),
]


def test_conversations_survive_the_round_trip(spark):
    schema = "conv_id long, turn long, role string, text string, segment string"
    talk = spark.createDataFrame([(*t, "s") for t in TURNS], schema).repartition(4)
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_segments(talk)).collect()}
    assert set(got) == {1, 2, 3, 4, 5, None}
    for conv, r in got.items():
        turns = [(role or "", text or "") for c, _, role, text in TURNS if c == conv]
        loss = "".join(text for role, text in turns if role == "assistant")
        assert r["n_turns"] == len(turns) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert {c: r["in_order"] for c, r in got.items()} == {1: True, 2: False, 3: False, 4: False, 5: True, None: True}
    assert chat.read_back(chat.format_segments(talk.limit(0))).count() == 0


def test_escapes_can_be_read_back():
    rng = random.Random(4)
    for _ in range(500):
        text = "".join(rng.choice(["\\", "#", "###", "</turn>", "\n", ": ", "a", "<", "### User: "]) for _ in range(8))
        for role in ("user", "other", "x: y", text):
            assert chat.read_turn(chat.header(role) + chat.escape(text) + chat.CLOSE) == (role, text)


def test_every_character_splits_as_in_the_library():
    from tokenizers import Tokenizer

    path = bpe.vocabulary_path()
    library = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        tables = bpe.compile_gadgets(file.read())
    # Every assigned character, by whichever of two Unicode versions, and some of those that none has assigned.
    def assigned(c):
        return unicodedata.category(chr(c)) not in ("Cn", "Co") or regex.match(r"[^\p{Cn}\p{Co}]", chr(c))

    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c % 64 == 0 or assigned(c))]
    texts = ["a" + chr(c) + "'s 1" + chr(c) + "\u00e9" for c in points]
    differ = []
    for start in range(0, len(texts), 50_000):
        part = texts[start:start + 50_000]
        for text, known in zip(part, library.encode_batch_fast(part, add_special_tokens=False), strict=True):
            if known.ids != [i for p in bpe._parts(tables, text) for i in p[0]]:
                differ.append(text)
    assert differ == []


def test_words_of_an_older_generation_are_remembered(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    with open(bpe.vocabulary_path(), encoding="utf-8") as file:
        tables = bpe.compile_gadgets(file.read())
    text = "some words, more words; don't forget any word of these 12 words"
    first = [p[0] for p in bpe._parts(tables, text)]
    assert [p[0] for p in bpe._parts(tables, text)] == first
    assert len(tables["words"]) <= 4 and len(tables["older"]) <= 4


def test_only_ids_are_remembered_unless_texts_are_asked_for():
    with open(bpe.vocabulary_path(), encoding="utf-8") as file:
        tables = bpe.compile_gadgets(file.read())
    bpe._parts(tables, "some words, don't 12\u00e9")
    assert tables["words"] and all(len(found) == 1 for found in tables["words"].values())
    tables |= {"texts": True, "words": {}}
    bpe._parts(tables, "some words, don't 12\u00e9")
    assert tables["words"] and all(len(found) == 3 for found in tables["words"].values())


def test_whole_texts_reach_python_in_small_batches(spark):
    docs = spark.range(0, 4000, 1, 1).selectExpr("id AS doc_id", "repeat('a', 3000) AS text")
    spark.conf.unset(rows.BATCH_SETTING)
    rows.per_text(docs, lambda texts: [pa.array([1] * len(texts), pa.int64())], "n long")
    sizes = docs.mapInArrow(lambda bs: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"]) for b in bs), "n long")
    held = [r["n"] for r in sizes.collect()]
    assert sum(held) == 4000 and max(held) * 3000 <= rows.BATCH_BYTES + 3000
    spark.conf.set(rows.BATCH_SETTING, str(9 << 20))
    rows.repeat_rows(docs, lambda batch, texts: [1] * len(texts))
    assert spark.conf.get(rows.BATCH_SETTING) == str(9 << 20)
    spark.conf.unset(rows.BATCH_SETTING)
