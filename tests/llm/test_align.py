"""Token alignment against whole-text encoding by both libraries and a walk over bytes."""

import hashlib
import json
import os
import random
from collections import Counter, defaultdict

import pytest

from adtally.llm import align
from adtally.llm.bpe import byte_symbols

public_tokenizers = pytest.importorskip("public_tokenizers")
FIRST, SECOND = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string"
ODD = [
    *"abcé\u2019\u00a0\u3000\n\t\r .,'s1234x\u2581<>|ß\u4e2d\u6587\U0001f642-", " the", " and", "don't ", "  ", "   ", " <s>",
    "<|endoftext|>", "<0x41>", "</s>", " \n ", "\u0085 ",
]


@pytest.fixture(scope="module")
def tools():
    import sentencepiece
    import tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    first = tokenizers.Tokenizer.from_file(FIRST)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=SECOND)
    back = {s: b for b, s in enumerate(byte_symbols())}
    with open(FIRST, encoding="utf-8") as file:
        vocab = json.load(file)["model"]["vocab"]
    bytes_a = {i: bytes(back[c] for c in t) for t, i in vocab.items() if all(c in back for c in t)}

    def bytes_b(i):
        piece = second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("\u2581", " ").encode()

    return lambda text: (
        [(i, bytes_a[i]) for i in first.encode(" " + text, add_special_tokens=False).ids],
        [(i, bytes_b(i)) for i in second.encode(text)],
    )


def walked(tools, text):
    """n_a, n_b, n_groups, hash, linked pairs; None for a text without tokens."""
    if not text:
        return None
    sides = tools(text)
    if any(b"".join(t for _, t in side) != b" " + text.encode() for side in sides):
        return None
    spans = []
    for side in sides:
        end, held = 0, []
        for i, token in side:
            held.append((i, end, end + len(token)))
            end += len(token)
        spans.append(held)
    links, groups, now, at = [], [], ([], []), [0, 0]
    while at[0] < len(spans[0]):
        (a, _, end_a), (b, _, end_b) = spans[0][at[0]], spans[1][at[1]]
        links.append((a, b))
        if end_a <= end_b:
            now[0].append(str(a))
            at[0] += 1
        if end_b <= end_a:
            now[1].append(str(b))
            at[1] += 1
        if end_a == end_b:
            groups.append(",".join(now[0]) + "|" + ",".join(now[1]))
            now = ([], [])
    return len(spans[0]), len(spans[1]), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest(), links


def expected(tools, rows):
    found = [walked(tools, text) for _, text in rows]
    docs = Counter(pair for f in found if f for pair in set(f[4]))
    most = defaultdict(int)
    for (a, _), n in docs.items():
        most[a] = max(most[a], n)
    out = []
    for (doc_id, _), f in zip(rows, found, strict=True):
        if f is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
        else:
            best = sum(docs[p] == most[p[0]] for p in f[4])
            out.append((doc_id, *f[:3], len(f[4]), best, sum(docs[p] for p in f[4]), f[3]))
    return sorted(out, key=str)


@pytest.mark.parametrize("known", [0, 40, align.KNOWN])
def test_whatever_number_of_counts_is_sent_out(spark, tools, known):
    rng = random.Random(9)
    rows = [(i, "".join(rng.choices(ODD, k=rng.choice([1, 2, 6, 30])))) for i in range(150)]
    rows += [(None, "the cat and the dog"), (7, "the cat and the dog"), (7, "the cat and the dog"), (8, ""), (9, None), (8, " ")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", a int, row string").repartition(3)
    got = sorted((tuple(r) for r in align.align(df, FIRST, SECOND, known).collect()), key=str)
    assert got == expected(tools, rows)


def test_long_texts_are_cut_between_words(spark, tools):
    rng = random.Random(10)
    words = ["".join(rng.choices("abcdefg\u00e9\u00fc,.'1", k=rng.randrange(1, 9))) for _ in range(3000)]
    rows = [(1, " ".join(rng.choices(words, k=700_000))), (2, "x" * 100_000), (3, " " * 5000 + "end ")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert len(rows[0][1].encode()) > align.PIECE
    assert sorted((tuple(r) for r in align.align(df, FIRST, SECOND).collect()), key=str) == expected(tools, rows)


def test_pieces_join_to_the_text_with_a_blank():
    rng = random.Random(11)
    for _ in range(300):
        text = "".join(rng.choices(ODD, k=60)).encode()
        pieces = list(align.cut_pieces(text, 10))
        assert b"".join(pieces) == b" " + text and all(p[:1] == b" " and p != b" " for p in pieces)


def test_no_rows(spark):
    assert align.align(spark.createDataFrame([], SCHEMA), FIRST, SECOND).collect() == []


def test_only_texts_without_tokens(spark):
    df = spark.createDataFrame([(1, None), (2, "\u2581"), (3, "")], SCHEMA)
    assert {tuple(r)[1:] for r in align.align(df, FIRST, SECOND).collect()} == {(0, 0, 0, 0, 0, 0, "")}


def test_counts_sent_out_are_bounded(spark):
    df = spark.createDataFrame([(i, 1 + i % 9) for i in range(90)], "pair long, docs long")
    least = align._known(df, 30)
    assert df.filter(df.docs >= least).count() <= 30
    assert align._known(df, 90) == 1 and df.filter(df.docs >= align._known(df, 0)).count() == 0


def test_a_worker_encodes_without_threads_of_the_library(monkeypatch):
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    monkeypatch.setattr(align, "_WORDS", {})
    with open(FIRST, encoding="utf-8") as one, open(SECOND, "rb") as two:
        align._words(b"pair", (one.read(), two.read()))
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
