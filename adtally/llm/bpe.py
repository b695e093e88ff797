"""BPE by a tokenization automaton, compiled from the merges by one gadget after the other.

The automaton reads token sequences. It starts with one state that every base symbol loops on. The gadget of
merge (u, v) -> w acts where an arc u leads to a state with an arc v: it adds an arc w past both, and sends the
arc u to a copy of its target that has no arc v. What is left accepts, for any word, just the sequence that
merging gives. All arcs of a token end in one state, so a state is known by the token read last; a new token
shares the state that its right part has at that time, and copies it once it is itself the left part of a merge.

A state is kept as what it lost: the arcs that gadgets cut, each with the gadget's number, and the state it was
copied from, with the number at that time. An arc's fate is looked up there once and then stays in the transition
table that encoding runs on.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterable

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.llm.rows import per_text

WORD_END = "</w>"
#: Words whose encoding a worker remembers in each of two generations: what the older one knows is taken over when used.
REMEMBERED = 150_000
#: Symbols by which the longest arc that may follow is looked up.
HEAD = 3
#: Arcs whose fate a worker remembers.
ARCS = 500_000


def byte_symbols() -> list[str]:
    """The printable symbol of each byte: itself where it prints, else the next code point from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    symbols, extra = {b: chr(b) for b in prints}, 256
    for b in range(256):
        if b not in symbols:
            symbols[b] = chr(extra)
            extra += 1
    return [symbols[b] for b in range(256)]


def compile_gadgets(model: str) -> dict:
    """The automaton of a tokenizer file's JSON text: plain tables, fit to be broadcast.

    ``cuts`` has, by the token read last, the arcs that its state lost and the gadget that cut each. ``made`` has
    the left part, right part and gadget of every merged token: its state is a copy of the right part's state just
    before that gadget, its arcs were added where its left part had an arc then.
    """
    spec = json.loads(model)
    vocab: dict[str, int] = spec["model"]["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    built = {left + right for left, right in merges}
    ready = {token for text, token in vocab.items() if text not in built}
    cuts: dict[int, dict[int, int]] = {}
    made: dict[int, tuple[int, int, int]] = {}
    for gadget, (left, right) in enumerate(merges):
        u, v, w = vocab[left], vocab[right], vocab[left + right]
        if u not in ready or v not in ready or w in ready:
            raise ValueError(f"merge {gadget} doesn't make a new token of earlier ones")
        made[w] = (u, v, gadget)
        cuts.setdefault(u, {})[v] = gadget
        ready.add(w)
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    return {
        "vocab": vocab, "cuts": cuts, "made": made, "special": special,
        "labels": {i: t for t, i in (vocab | special).items()}, "reach": _reach(vocab),
        "numbers": {i: str(i) for i in (vocab | special).values()},
        "arcs": {}, "words": {}, "older": {}, "texts": False,
        **(unicode_tables(model) if spec.get("pre_tokenizer") else {}),
    }


def _reach(vocab: dict[str, int]) -> dict[str, int]:
    """The length of the longest token, without the word's end, that begins with each ``HEAD`` symbols."""
    longest: dict[str, int] = {}
    for token in vocab:
        symbols = token.removesuffix(WORD_END)
        if len(symbols) >= HEAD:
            longest[symbols[:HEAD]] = max(len(symbols), longest.get(symbols[:HEAD], 0))
    return longest


def arc_open(tables: dict, last: int, token: int) -> bool:
    """Whether the state after ``last`` has an arc ``token``."""
    cuts, made, never = tables["cuts"], tables["made"], len(tables["made"]) + 1
    added = never
    while True:
        state, copied = last, never
        while True:
            cut = cuts[state].get(token) if state in cuts else None
            if cut is not None and cut <= added and cut < copied:
                return False
            if state not in made:
                break
            _, state, copied = made[state]
        if token not in made:
            return True
        token, _, added = made[token]


def encode_word(tables: dict, word: str) -> list[int]:
    """The token path of a pre-split word in byte symbols; each of its prefixes has just one.

    Longer arcs are tried first. As a prefix has one path only, a place that leads nowhere is given up for good.
    """
    get, arcs, reach, size, whole = tables["vocab"].get, tables["arcs"], tables["reach"], len(word), word + WORD_END
    path, starts, lost = [], [], set()
    at, last, end = 0, -1, min(size, reach.get(word[:HEAD], HEAD - 1))
    while at < size:
        while end > at:
            token = get(word[at:end] if end < size else whole[at:])
            if token is not None and end not in lost:
                if not at:
                    break
                key = last << 32 | token
                go = arcs.get(key)
                if go is None:
                    if len(arcs) >= ARCS:
                        arcs.clear()
                    go = arcs[key] = arc_open(tables, last, token)
                if go:
                    break
            end -= 1
        if end > at:
            path.append(token)
            starts.append(at)
            last, at = token, end
            end = min(size, at + reach.get(word[at:at + HEAD], HEAD - 1))
        else:
            lost.add(at)
            path.pop()
            at, end = starts.pop(), at - 1
            last = path[-1] if path else -1
    return path


#: Fixed value: how the tokenizer file splits normalised text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\s{letters}{numbers}]+"
#: For chunks of ASCII characters.
ASCII_PIECES = regex.compile(SPLIT.format(letters="a-zA-Z", numbers="0-9"))


def _class(points: Iterable[int]) -> str:
    """The inside of a character class of some code points."""
    runs: list[list[int]] = []
    for point in sorted(points):
        if runs and runs[-1][1] == point - 1:
            runs[-1][1] = point
        else:
            runs.append([point, point])
    return "".join(rf"\U{first:08x}-\U{last:08x}" for first, last in runs)


def unicode_tables(model: str) -> dict:
    """What the tokenizer's parts make of characters that Python's unicodedata doesn't know yet.

    ``pieces`` splits a chunk. Letters and numbers are those of unicodedata, and of the newer characters those that the
    tokenizer's own splitter takes for such; ``newer`` has what its normaliser makes of newer characters, where that is
    something else. The parts are asked once, on the driver, about each character that is new.
    """
    from tokenizers import Tokenizer

    parts = Tokenizer.from_str(model)
    kinds = [unicodedata.category(chr(point)) for point in range(0x110000)]
    known = regex.compile(r"\P{Cn}")
    fresh = [p for p, kind in enumerate(kinds) if kind == "Cn" and known.match(chr(p))]
    newer = {p: made for p in fresh if (made := parts.normalizer.normalize_str(chr(p))) != chr(p)}

    def pieces(text: str) -> int:
        return len(parts.pre_tokenizer.pre_tokenize_str(text))

    letters = {p for p, kind in enumerate(kinds) if kind[0] == "L"} | {p for p in fresh if pieces(f"a{chr(p)}") == 1}
    numbers = {p for p, kind in enumerate(kinds) if kind[0] == "N"} | {p for p in fresh if pieces(chr(p) * 2) == 2}
    split = SPLIT.format(letters=_class(letters), numbers=_class(numbers))
    return {"pieces": regex.compile(split), "newer": newer}


SYMBOLS = byte_symbols()
#: Python's split() takes these for blanks, Unicode doesn't.
SEPARATORS = regex.compile(r"[\x1c-\x1f]")
BLANKS = regex.compile(r"\p{White_Space}+")


def _chunk(tables: dict, chunk: str) -> tuple:
    """Tokens of a run without blanks: ids and, where ``texts`` asks for them, ids as text, labels as text."""
    words, texts = tables["words"], tables["texts"]
    if len(words) >= REMEMBERED:
        tables["older"], tables["words"] = words, {}
        words = tables["words"]
    found = words.get(chunk) or tables["older"].get(chunk)
    if found is None:
        ascii = chunk.isascii()
        if ascii and chunk.isalpha():
            pieces = [chunk]
        else:
            pieces = ASCII_PIECES.findall(chunk) if ascii else tables["pieces"].findall(chunk.translate(tables["newer"]))
        if len(pieces) > 1:
            parts = [part for piece in pieces if (part := words.get(piece) or _chunk(tables, piece))[0]]
            found = (tuple([i for part in parts for i in part[0]]),)
            if texts:
                found += " ".join([part[1] for part in parts]), " ".join([part[2] for part in parts])
        else:
            ids: list[int] = []
            for piece in pieces:
                plain = ascii and piece.isprintable()
                ids = encode_word(tables, piece if plain else "".join([SYMBOLS[b] for b in piece.encode()]))
            found = (tuple(ids),)
            if texts:
                labels, numbers = tables["labels"], tables["numbers"]
                found += " ".join([numbers[i] for i in ids]), " ".join([labels[i] for i in ids])
    tables["words"][chunk] = found
    return found


def _parts(tables: dict, text: str) -> list[tuple]:
    """The tokens of a whole text, chunk by chunk. Special tokens are found before the text is normalised."""
    parts = []
    special = tables["special"]
    pieces = regex.split("(" + "|".join(map(regex.escape, special)) + ")", text) if "<|" in text else [text]
    words = tables["words"]
    for piece in pieces:
        if piece in special:
            parts.append(((special[piece],), str(special[piece]), piece))
            continue
        # One capital sigma at a time: lower() would look at its neighbours.
        plain = unicodedata.normalize("NFC", piece).replace("\u03a3", "\u03c3").lower()
        for chunk in BLANKS.split(plain) if SEPARATORS.search(plain) else plain.split():
            if chunk and (part := words.get(chunk) or _chunk(tables, chunk))[0]:
                parts.append(part)
    return parts


def _ids(tables: dict, raw: bytes) -> list[int]:
    return [i for part in _parts(tables, raw.decode("utf-8", "replace")) for i in part[0]]


def _load(spark: SparkSession, path: str, texts: bool = False):
    """The compiled tables for all executors; they have the size of the vocabulary, whatever the corpus.

    With ``texts`` a worker remembers the text of a word's tokens too, which takes more than twice the memory.
    """
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(compile_gadgets(file.read()) | {"texts": texts})


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids of every whole text, as the tokenizer file at ``path`` encodes it.

    A null or empty text has no ids. Rows that repeat give rows that repeat; an empty table gives none. ``path``
    is read on the driver only.
    """
    shared = _load(docs.sparkSession, path)

    def score(texts: list[bytes]) -> list[pa.Array]:
        ids = [_ids(shared.value, t) for t in texts]
        return [pa.array(list(map(len, ids)), pa.int64()), pa.array(ids, pa.list_(pa.int32()))]

    return per_text(docs, score, "n_tokens long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text: the labels of the arcs that ``ids`` name, joined by blanks as the file has no decoder."""
    shared = _load(encoded.sparkSession, path)
    narrow = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        labels = shared.value["labels"]
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                texts = [" ".join([labels[i] for i in ids]) for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    id_type = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {id_type}, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids, and decoded (their labels) of every whole text, in one pass."""
    shared = _load(docs.sparkSession, path)

    def score(texts: list[bytes]) -> list[pa.Array]:
        ids, labels = [_ids(shared.value, t) for t in texts], shared.value["labels"]
        return [
            pa.array(list(map(len, ids)), pa.int64()), pa.array(ids, pa.list_(pa.int32())),
            pa.array([" ".join([labels[i] for i in held]) for held in ids], pa.string()),
        ]

    return per_text(docs, score, "n_tokens long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text, encoded and decoded in one pass."""
    shared = _load(docs.sparkSession, path, texts=True)

    def score(texts: list[bytes]) -> list[pa.Array]:
        counts, ids, decoded = [], [], []
        for text in texts:
            parts = _parts(shared.value, text.decode("utf-8", "replace"))
            counts.append(sum(len(p[0]) for p in parts))
            ids.append(hashlib.sha256(" ".join([p[1] for p in parts]).encode()).hexdigest())
            decoded.append(hashlib.sha256(" ".join([p[2] for p in parts]).encode()).hexdigest())
        return [pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]

    return per_text(docs, score, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary_path())
