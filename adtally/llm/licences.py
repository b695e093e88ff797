"""Licence scan by a positional index of the notices, asked for each file's rarest words.

The corpus tells how rare the words of the notices are. The index holds the postings (notice, position) of all words
of the dozen notices. A file looks up its own rarest ones: of each notice that it has enough words of, so many that a
start which most of the notice's words fit has to meet some of them. A posting at position q met at word p of the file
proposes that the notice starts at p - q, and starts that enough rare words agree on are verified: the notice's key
phrases must stand there in full, and most of its words.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.llm.rows import in_slices, per_text, text_or_empty

#: Phrases whose places are counted, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Label, notice, key phrases it must hold, as the licences word them.
NOTICES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
     " documentation files", ("hereby granted free of charge", "copy of this software")),
    ("apache", "licensed under the apache license version 2 0", ("apache license",)),
    ("gpl", "this work is licensed under the gnu general public license version 3", ("general public license",)),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license",
     ("general public license",)),
    ("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    ("agpl", "gnu affero general public license", ("affero general public license",)),
    ("cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     ("source and binary forms",)),
    ("mpl", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
)
#: How many of a file's rare words must agree on a start, and the share of a notice's words that must match there.
AGREE, SHARE = 2, 0.6

#: A-Z in lower case; whatever is no digit, letter or byte of a longer UTF-8 character becomes a blank.
_TABLE = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_TABLE).split()


def patterns() -> list[tuple[str, tuple[bytes, ...], tuple[tuple[bytes, ...], ...], bool]]:
    """label, words, key phrases, whether it is a base phrase, of everything that is searched."""
    split = lambda text: tuple(text.encode().split())
    base = [(label, split(phrase), (split(phrase),), True) for phrase, label in BASE.items()]
    return base + [(label, split(text), tuple(map(split, keys)), False) for label, text, keys in NOTICES]


def document_frequencies(docs: DataFrame) -> dict[bytes, int]:
    """In how many texts each word of the notices occurs; as many numbers as the notices have words."""
    vocabulary = frozenset(w for _, words, _, _ in patterns() for w in words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for part in in_slices(batch, 0):
                for raw in part.column(0).to_pylist():
                    found.update(vocabulary.intersection(words_of(raw)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "n"]
        )

    texts = docs.select(text_or_empty().cast("binary").alias("text"))
    counted = texts.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in counted.collect()}


class Entry(NamedTuple):
    """A pattern in the index: its words with their positions, rarest first, those it can't do without, and how many
    words must match at a start, and how many of the words looked up must agree on it."""

    places: dict[bytes, list[int]]
    required: frozenset[bytes]
    need: int
    votes: int


def word_index(frequency: dict[bytes, int]) -> list[Entry]:
    """An entry for each pattern; words that no text has are rarest of all."""
    entries = []
    for _, words, keys, base in patterns():
        ranked = sorted(set(words), key=lambda w: (frequency.get(w, 0), w))
        places = {word: [q for q, w in enumerate(words) if w == word] for word in ranked}
        need = len(words) if base else math.ceil(SHARE * len(words))
        entries.append(Entry(places, frozenset(w for key in keys for w in key), need, 1 if base else min(AGREE, need)))
    return entries


def rarest_of(words: set[bytes], entries: list[Entry]) -> dict[bytes, list[tuple[int, int]]]:
    """Postings (pattern, position) of the rarest words that a file with these words has, for each pattern it may hold.

    At a start that is verified, at least ``need`` positions match, so at most ``have - need`` of those whose word the
    file has don't; with ``votes`` positions more than that looked up, no start is missed.
    """
    index = defaultdict(list)
    for number, entry in enumerate(entries):
        if not entry.required <= words:
            continue
        own = [w for w in entry.places if w in words]
        left = sum(len(entry.places[w]) for w in own) - entry.need
        if left < 0:
            continue
        left += entry.votes
        for word in own:
            if left <= 0:
                break
            index[word] += [(number, q) for q in entry.places[word]]
            left -= len(entry.places[word])
    return dict(index)


def _holds(words: list[bytes], phrase: tuple[bytes, ...], at: int) -> bool:
    return at >= 0 and tuple(words[at:at + len(phrase)]) == phrase


def scan(words: list[bytes], entries: list[Entry], searched: list) -> tuple[list[int], set[str], set[str], float]:
    """Starts of base phrases, base labels, all labels, and the best share of a verified notice."""
    agreed: Counter[tuple[int, int]] = Counter()
    index = rarest_of(set(words), entries)
    for p, word in enumerate(words) if index else ():
        for number, q in index.get(word, ()):
            agreed[number, p - q] += 1
    starts, base, labels, best = [], set(), set(), 0.0
    for (number, start), votes in agreed.items():
        label, pattern, keys, is_base = searched[number]
        if is_base:
            if _holds(words, pattern, start):
                starts.append(start)
                base.add(label)
            continue
        if votes < entries[number].votes:
            continue
        if all(any(_holds(words, key, start + q) for q in range(len(pattern)) if pattern[q:q + len(key)] == key) for key in keys):
            same = sum(0 <= start + q < len(words) and words[start + q] == w for q, w in enumerate(pattern))
            if same >= SHARE * len(pattern):
                labels.add(label)
                best = max(best, same / len(pattern))
    return starts, base, labels | base, max(best, 0.5 if base else 0.0)


def find_licences(docs: DataFrame) -> DataFrame:
    """For every row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    score is the share of words matched by the best verified notice, and at least 0.5 where a base phrase stands.
    Texts are whole; a null or empty one has no words, nulls for the places, '' for the labels and score 0. Rows
    that repeat give rows that repeat; an empty table gives none. Two passes over the texts, nothing shuffled but
    the word counts.
    """
    entries, searched = word_index(document_frequencies(docs)), patterns()

    def score(texts: list[bytes]) -> list[pa.Array]:
        rows = []
        for raw in texts:
            words = words_of(raw)
            starts, base, labels, best = scan(words, entries, searched)
            rows.append((
                len(words), len(starts), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(base)), ",".join(sorted(labels)), best,
            ))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        return [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]

    return per_text(
        docs, score,
        "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double",
    )


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licences(spark.read.parquet(f"{sf_dir}/documents.parquet"))
