"""Aligning the tokens of two tokenizers, as Arrow columns.

Both tokenizers break a text at its words, so words (with the blank before them) are the unit that is encoded: each
different word once in a while. Token lists are flattened with their parents; segmented cumulative sums of token lengths
give the byte at which each token ends in its document. A hash join of both sides on (document, end) has a row for every
stretch of bytes that no token end interrupts, which is just one linked pair of tokens, and tells where both sides end.

How many documents hold a pair is counted by Arrow group-bys within tasks, which Spark sums up. The most frequent pairs
go back to all workers, a bounded number whatever the corpus; links of other pairs meet their counts in a shuffle.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtally.llm.bpe import byte_symbols
from adtally.llm.rows import give_back, in_slices, stage, text_or_empty

#: Bytes of text that are aligned at a time; longer texts are cut between words.
PIECE = 1 << 19
#: Words whose tokens a worker remembers, about 60 MB; then it starts anew with those at hand.
REMEMBERED = 300_000
#: Words that are encoded at a time.
LEARNED = 8192
#: Pairs whose counts go to every worker, at most: 16 MB.
KNOWN = 1 << 20
#: Different pairs that a task counts before it hands them on.
COUNTED = 1 << 19
#: Bits below the document number in a document-end key.
END_BITS = 32


def _open(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each place is surely no blank. A few blocks that hold any are left out whole."""
    one, two, three = (data[np.maximum(at - k, 0)] for k in (1, 2, 3))
    return (one > 32) & (two != 0xC2) & ((three < 0xE1) | (three > 0xE3))


def word_starts(data: np.ndarray, fine: bool = False) -> np.ndarray:
    """Places at which both tokenizers surely begin a token: blanks behind a character that is none.

    With ``fine`` also marks behind letters, and single line feeds and what follows them.
    """
    at = np.flatnonzero(data == 32)
    at = at[at > 0]
    starts = [at[_open(data, at)]]
    if fine:
        letter = ((data | 32) >= 97) & ((data | 32) <= 122)
        mark = (data > 32) & (data < 127) & ~letter & ~((data >= 48) & (data <= 57))
        starts.append(np.flatnonzero(letter[:-1] & mark[1:]) + 1)
        at = np.flatnonzero(data[:-1] == 10)
        at = at[(at > 0) & (data[at + 1] > 32) & (data[at + 1] < 127)]
        at = at[_open(data, at)]
        starts += [at, at + 1]
    return np.concatenate(starts)


class Words:
    """Token ids of words by both tokenizers; a word, mostly with a blank in front, is encoded once while it is remembered."""

    def __init__(self, first: str, second: bytes):
        import sentencepiece
        import tokenizers

        self.first = tokenizers.Tokenizer.from_str(first)
        self.first.no_truncation()
        self.first.no_padding()
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_proto=second)
        back = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        entries = self.first.get_vocab(with_added_tokens=False)
        named = {i: bytes([back[c] for c in token]) for token, i in entries.items() if all(c in back for c in token)}
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        texts = [p for i, p in enumerate(pieces) if not self.second.is_byte(i) and not self.second.is_control(i)]
        if any("▁" in p.lstrip("▁") or "\n" in p for p in texts):
            raise ValueError("a piece reaches over the beginning of a word")
        # Words are cut before marks unless a piece joins a letter to one.
        self.fine = not any(re.search(r"[A-Za-z][!-/:-@\[-`{-~]", p) for p in texts)
        self.bytes = (
            pa.array([named.get(i, b"") for i in range(1 + max(named))], pa.binary()),
            pa.array([
                bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else p.replace("▁", " ").encode()
                for i, p in enumerate(pieces)
            ], pa.binary()),
        )
        self.lengths = tuple(pc.binary_length(b).cast(pa.int64()) for b in self.bytes)
        self._forget()

    def _forget(self) -> None:
        self.places: dict[bytes, int] = {}
        self.held = [pa.array([], pa.list_(pa.int32()))] * 2
        self.wrong = np.zeros(0, bool)
        self.new: tuple[list, list, list] = [], [], []

    def _learn(self, words: list[bytes]) -> None:
        texts = [w.decode() for w in words]
        ones = [one.ids for one in self.first.encode_batch_fast(texts, add_special_tokens=False)]
        # The second tokenizer puts a blank in front itself. Where there's none, a line feed keeps it off the word, and
        # the tokens of both go.
        twos = self.second.encode([t[1:] if t[0] == " " else "\n" + t for t in texts], num_threads=1)
        twos = [ids if t[0] == " " else ids[2:] for t, ids in zip(texts, twos, strict=True)]
        wrong, given = np.zeros(len(words), bool), pa.array(words, pa.binary())
        for side, ids in enumerate((ones, twos)):
            ends = np.cumsum([0, *map(len, ids)])
            lists = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(np.fromiter(chain.from_iterable(ids), np.int32, ends[-1]))
            )
            back = pc.binary_join(pa.ListArray.from_arrays(lists.offsets, self.bytes[side].take(lists.values)), b"")
            wrong |= pc.not_equal(back, given).to_numpy(zero_copy_only=False)
            self.new[side].append(lists)
        self.new[2].append(wrong)
        self.places.update(zip(words, range(len(self.places), len(self.places) + len(words)), strict=True))

    def find(self, words: list[bytes]) -> np.ndarray:
        """Where the tokens of different words are in ``held``, and in ``wrong`` whether they stand for other bytes."""
        new = [w for w in words if w not in self.places]
        if len(self.places) + len(new) > REMEMBERED:
            self._forget()
            new = words
        if new:
            for start in range(0, len(new), LEARNED):
                self._learn(new[start:start + LEARNED])
            self.held = [pa.concat_arrays([h, *n]) for h, n in zip(self.held, self.new, strict=False)]
            self.wrong = np.concatenate([self.wrong, *self.new[2]])
            self.new = [], [], []
        return np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))


_WORDS: dict[bytes, Words] = {}


def _words(name: bytes, files: tuple[str, bytes]) -> Words:
    """One per worker and tokenizer pair."""
    # Tasks keep the cores busy; the library's own threads would only spin beside them.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if name not in _WORDS:
        _WORDS.clear()
        _WORDS[name] = Words(*files)
    return _WORDS[name]


def _ends(ids: pa.Array, parent: pa.Array, lengths: pa.Array) -> pa.Array:
    """Document-end key of each token: its document, and the sum of lengths from there to its end."""
    sums = pc.cumulative_sum(lengths.take(ids))
    totals = sums.to_numpy(zero_copy_only=False)
    documents = parent.to_numpy(zero_copy_only=False)
    first = np.flatnonzero(np.diff(documents, prepend=-1))
    before = np.repeat(np.where(first > 0, totals[first - 1], 0), np.diff(np.append(first, len(documents))))
    return pc.add(pc.shift_left(parent, pa.scalar(END_BITS, pa.int64())), pc.subtract(sums, pa.array(before)))


def align_pieces(words: Words, pieces: list[bytes]) -> tuple[list[int], dict[str, np.ndarray], list[str], pa.Table]:
    """Of texts with a blank in front: which of them a tokenizer changes, counts by piece, groups as text, pairs.

    Pairs have piece, a, b and times. What is changed has no tokens here.
    """
    data = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    begins = np.cumsum(sizes) - sizes
    first = np.zeros(len(data), bool)
    first[word_starts(data, words.fine)] = True
    first[begins + sizes - 1] = False  # the last byte of a piece is no word, even if it's a blank
    first[begins] = True
    starts = np.flatnonzero(first)
    piece_of = np.cumsum(np.bincount(begins, minlength=len(data))[starts]) - 1
    cut = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data)).astype(np.int32)), pa.py_buffer(data)]
    ).dictionary_encode()
    places = words.find(cut.dictionary.to_pylist())[cut.indices.to_numpy()]
    bad = np.unique(piece_of[words.wrong[places]])
    if len(bad):
        keep = ~np.isin(piece_of, bad)
        places, piece_of = places[keep], piece_of[keep]
    taken, piece = pa.array(places), pa.array(piece_of)
    sides = []
    for held, lengths in zip(words.held, words.lengths, strict=True):
        lists = held.take(taken)
        ids, parent = lists.flatten(), piece.take(pc.list_parent_indices(lists))
        sides.append((ids, parent, _ends(ids, parent, lengths)))
    (a, in_a, ends_a), (b, in_b, ends_b) = sides
    number = lambda array: pa.array(np.arange(len(array), dtype=np.int32))
    left = pa.table({"end": ends_a, "at_a": number(a)})
    right = pa.table({"end": ends_b, "at_b": number(b)})
    met = left.join(right, "end", join_type="full outer", use_threads=False).sort_by("end").combine_chunks()
    shut = met.filter(pc.and_(met["at_a"].is_valid(), met["at_b"].is_valid()))
    # A stretch lies in the tokens that end next; every document ends with both sides.
    links = pa.table({
        "piece": pc.shift_right(met["end"], pa.scalar(END_BITS, pa.int64())),
        "a": a.take(pc.fill_null_backward(met["at_a"])), "b": b.take(pc.fill_null_backward(met["at_b"])),
    })
    pairs = links.group_by(["piece", "a", "b"], use_threads=False).aggregate([([], "count_all")])
    pairs = pairs.rename_columns(["piece", "a", "b", "times"])
    joined = []
    for ids, column in ((a, "at_a"), (b, "at_b")):
        ends = np.append(0, shut[column].to_numpy() + 1)
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids.cast(pa.string()))
        joined.append(pc.binary_join(lists, ","))
    groups = pc.binary_join_element_wise(*joined, "|")
    group_piece = pc.shift_right(shut["end"], pa.scalar(END_BITS, pa.int64())).to_numpy()
    count = lambda parent: np.bincount(parent, minlength=len(pieces))
    n_groups = count(group_piece)
    texts = pc.binary_join(
        pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n_groups)), pa.int32()), groups), ";"
    ).to_pylist()
    counts = {
        "n_a": count(in_a.to_numpy()), "n_b": count(in_b.to_numpy()), "n_groups": n_groups,
        "n_links": count(links["piece"].to_numpy()),
    }
    return bad.tolist(), counts, texts, pairs


def cut_pieces(raw: bytes, most: int = PIECE) -> Iterator[bytes]:
    """A text with a blank in front, in runs of whole words of about ``most`` bytes."""
    raw, start = b" " + raw, 0
    while len(raw) - start > most:
        cut, at = 0, start + most
        while not cut and at < len(raw):
            window = np.frombuffer(raw, np.uint8, min(len(raw) - at, 1 << 16), at)
            cuts = word_starts(window)
            cuts = cuts[(cuts >= 3) & (cuts + at < len(raw) - 1)]
            cut = at + int(cuts[0]) if len(cuts) else 0
            at += (1 << 16) - 4
        if not cut:
            break
        yield raw[start:cut]
        start = cut
    yield raw[start:]


FOUND = (
    "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a array<int>, b array<int>, times array<int>"
)


class _Texts:
    """Pieces of texts until there are enough of them, and what came of earlier pieces of the same text."""

    def __init__(self, words: Words, n: int):
        self.words, self.waiting, self.size, self.last = words, [], 0, -1
        self.counts = {c: np.zeros(n, np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
        self.hashes: list = [None] * n
        self.bad: set[int] = set()
        self.pairs: list[pa.Table] = []

    def add(self, text: int, piece: bytes) -> None:
        if self.waiting and self.size + len(piece) > PIECE:
            self.run()
        self.waiting.append((text, piece))
        self.size += len(piece)

    def run(self) -> None:
        if not self.waiting:
            return
        of = np.array([t for t, _ in self.waiting])
        bad, counts, groups, pairs = align_pieces(self.words, [p for _, p in self.waiting])
        self.bad.update(of[bad].tolist())
        for name, n in counts.items():
            np.add.at(self.counts[name], of, n)
        for text, group in zip(of.tolist(), groups, strict=True):
            if group:
                known = self.hashes[text]
                if known is None:
                    self.hashes[text] = known = hashlib.sha256()
                else:
                    known.update(b";")
                known.update(group.encode())
        texts = pa.array(of).take(pairs["piece"].combine_chunks() if pairs.num_rows else pa.array([], pa.int64()))
        self.pairs.append(pairs.set_column(0, "text", texts))
        if len(set(of.tolist())) < len(of) or of[0] == self.last:
            self.fold()  # a long text: its pairs are in several pieces
        self.last = int(of[-1])
        self.waiting, self.size = [], 0

    def fold(self) -> None:
        whole = pa.concat_tables(self.pairs).group_by(["text", "a", "b"], use_threads=False).aggregate([("times", "sum")])
        self.pairs = [whole.rename_columns(["text", "a", "b", "times"])]

    def done(self) -> list[pa.Array]:
        self.run()
        good = np.ones(len(self.hashes), bool)
        good[list(self.bad)] = False
        columns = [pa.array(np.where(good, n, 0)) for n in self.counts.values()]
        hashes = [h.hexdigest() if h and ok else "" for h, ok in zip(self.hashes, good.tolist(), strict=True)]
        if not self.pairs:
            self.pairs = [pa.table({c: pa.array([], pa.int64()) for c in ("text", "a", "b", "times")})]
        pairs = pa.concat_tables(self.pairs).combine_chunks()
        pairs = pairs.filter(pa.array(good).take(pairs["text"])).sort_by("text")
        ends = np.append(0, np.cumsum(np.bincount(pairs["text"].to_numpy(), minlength=len(good))))
        lists = [
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(pairs[c].to_numpy(), pa.int32()))
            for c in ("a", "b", "times")
        ]
        return [*columns, pa.array(hashes, pa.string()), *lists]


def tokenise(docs: DataFrame, first: str, second: str) -> DataFrame:
    """row (a number), doc_id and the columns of FOUND: token counts, groups, and linked pairs a, b with their times.

    ``first`` and ``second`` are paths that only the driver reads; the files go to the workers, as large as they are.
    A text is cut where both tokenizers begin a word, so one of any length is worked through piece by piece.
    """
    with open(first, encoding="utf-8") as one, open(second, "rb") as two:
        files = one.read(), two.read()
    shared = docs.sparkSession.sparkContext.broadcast(files)
    name = hashlib.sha256(files[0].encode() + files[1]).digest()
    narrow = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", text_or_empty().cast("binary").alias("text")
    )
    schema = T.StructType([narrow.schema["row"], narrow.schema["doc_id"], *T.StructType.fromDDL(FOUND).fields])
    names = schema.names

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(name, shared.value)
        for batch in batches:
            for part in in_slices(batch, 2, PIECE):
                texts = _Texts(words, part.num_rows)
                for i, raw in enumerate(part.column(2).to_pylist()):
                    if raw:
                        for piece in cut_pieces(raw):
                            texts.add(i, piece)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *texts.done()], names=names)
                texts = None
                give_back()

    return narrow.mapInArrow(run, schema)


def _pair_of(table: pa.RecordBatch, a: int, b: int) -> pa.Array:
    one, two = (table.column(i).flatten().cast(pa.int64()) for i in (a, b))
    return pc.add(pc.shift_left(one, pa.scalar(32, pa.int64())), two)


def pair_counts(tokens: DataFrame) -> DataFrame:
    """pair (a's id above 32 bits, b's below) and docs, the number of documents that hold it linked."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def counted() -> pa.Table:
            sums = pa.concat_tables(held).group_by("pair", use_threads=False).aggregate([("docs", "sum")])
            return sums.rename_columns(["pair", "docs"])

        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                pairs = _pair_of(batch.slice(start, 500), 0, 1)
                once = pa.table({"pair": pairs, "docs": pa.array(np.ones(len(pairs), np.int64))})
                held.append(once)
                if sum(t.num_rows for t in held) >= 2 * COUNTED:
                    held = [counted()]
                    if held[0].num_rows >= COUNTED:
                        yield from held[0].to_batches()
                        held = []
        if held:
            yield from counted().to_batches()
        held = []
        give_back()

    partial = tokens.select("a", "b").mapInArrow(run, "pair long, docs long")
    return partial.groupBy("pair").agg(F.sum("docs").alias("docs"))


def _known(counts: DataFrame, most: int) -> int:
    """The least count so that no more than ``most`` pairs have as many documents: a power of two, or 1 for all pairs."""
    by_size = counts.groupBy(F.floor(F.log2("docs")).cast("int").alias("size")).count().collect()
    least, held = 64, 0
    for size, n in sorted(((r["size"], r["count"]) for r in by_size), reverse=True):
        held += n
        if held > most:
            break
        least = size
    return 1 << least if least < 63 else 1 << 62


def align(docs: DataFrame, first: str, second: str, known: int = KNOWN) -> DataFrame:
    """For every row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Tokens of ``first`` (a byte-level BPE file) and ``second`` (a sentencepiece model) are linked where their bytes
    overlap. A pair's count is the number of rows that hold it; ``n_best`` counts links whose count is the highest of
    their first token's. A text that is null, empty, or that a tokenizer does not give back unchanged has zeros and an
    empty hash. Rows that repeat count each; an empty table gives no rows. The result doesn't depend on ``known``, the
    number of pairs whose counts are sent to all workers.
    """
    context = docs.sparkSession.sparkContext
    tokens = stage(tokenise(docs, first, second), "align-tokens")
    counts = stage(pair_counts(tokens), "align-counts")
    highest = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("docs").alias("most"))
    best = highest.toArrow()  # a row for each id of the first vocabulary at most
    hot = counts.filter(F.col("docs") >= _known(counts, known)).toArrow()
    order = np.argsort(hot["pair"].to_numpy())
    top = np.zeros(1 + max(best["a"].to_pylist(), default=0), np.int64)
    top[best["a"].to_numpy()] = best["most"].to_numpy()
    shared = context.broadcast((hot["pair"].to_numpy()[order], hot["docs"].to_numpy()[order], top))
    kept = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    schema = T.StructType([
        *[tokens.schema[c] for c in kept],
        *T.StructType.fromDDL("n_best long, count_sum long, rest array<struct<pair: bigint, times: int>>").fields,
    ])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, docs, top = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                n = batch.num_rows
                own = _pair_of(batch, 7, 8).to_numpy()
                row = pc.list_parent_indices(batch.column(7)).to_numpy()
                times = batch.column(9).flatten().to_numpy().astype(np.int64)
                at = np.minimum(np.searchsorted(pairs, own), max(0, len(pairs) - 1))
                there = pairs[at] == own if len(pairs) else np.zeros(len(own), bool)
                count = np.where(there, docs[at] if len(pairs) else 0, 0)
                sums, is_best = np.zeros(n, np.int64), np.zeros(n, np.int64)
                np.add.at(sums, row, count * times)
                np.add.at(is_best, row, np.where(there & (count == top[own >> 32]), times, 0))
                left = np.flatnonzero(~there)
                rest = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(np.bincount(row[left], minlength=n))), pa.int32()),
                    pa.StructArray.from_arrays([pa.array(own[left]), pa.array(times[left].astype(np.int32))], ["pair", "times"]),
                )
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:7], pa.array(is_best), pa.array(sums), rest], names=schema.names
                )

    found = stage(tokens.select(*kept, "a", "b", "times").mapInArrow(run, schema), "align-found")
    left = found.select("row", F.inline("rest")).join(counts, "pair").join(
        F.broadcast(highest), F.shiftright("pair", 32) == F.col("a")
    )
    sums = left.groupBy("row").agg(
        F.sum(F.col("docs") * F.col("times")).alias("more"),
        F.sum(F.when(F.col("docs") == F.col("most"), F.col("times")).otherwise(0)).alias("more_best"),
    )
    whole = found.join(sums, "row", "left")
    return whole.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"), "groups_sha256",
    )


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
