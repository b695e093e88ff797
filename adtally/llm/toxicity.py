"""Toxicity by a counterfactual-regularised sentence classifier.

A text is as toxic as its most toxic sentence. The sentences' logistic model over words is trained on labelled texts
through that sentence, and on counterfactual ones: each identity term of a labelled sentence is swapped for the
other terms of its kind, and the squared change of the score is penalised. So the label sticks to what is said, not
to the group that is mentioned.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.llm.features import fold, joined, labelled_sample, scored, word_hashes, word_spans
from adtally.llm.rows import repeat_rows

#: Labelled rows that training uses at most.
SAMPLE = 4000
#: Identity terms, by kind and language.
IDENTITY = (
    "muslims christians jews hindus buddhists atheists catholics",
    "muslim christian jewish hindu buddhist atheist catholic",
    "women men girls boys",
    "woman man girl boy",
    "gay lesbian straight bisexual transgender",
    "black white asian latino arab african european",
    "immigrants refugees foreigners natives citizens",
    "americans mexicans germans french spaniards turks chinese indians poles",
    "disabled blind deaf elderly young",
    "muslime christen juden hindus buddhisten atheisten katholiken",
    "frauen männer mädchen jungen",
    "schwarze weiße asiaten araber afrikaner europäer",
    "flüchtlinge ausländer einwanderer einheimische",
    "musulmans chrétiens juifs hindous bouddhistes athées catholiques",
    "femmes hommes filles garçons",
    "noirs blancs asiatiques arabes africains européens",
    "réfugiés étrangers immigrés citoyens",
    "musulmanes cristianos judíos hindúes budistas ateos católicos",
    "mujeres hombres niñas niños",
    "negros blancos asiáticos árabes africanos europeos",
    "refugiados extranjeros inmigrantes ciudadanos",
)
#: Weight of the counterfactual penalty, of absolute and squared weights, steps and their size, least texts of a word.
BALANCE, SHRINK, RIDGE, STEPS, RATE, LEAST = 1.0, 0.5, 0.05, 150, 0.05, 3
#: Lengths of the word beginnings that are features besides whole words, in bytes.
PREFIXES = (5, 7)
#: Features of less weight are left out of the trained model.
NEGLIGIBLE = 0.2

_LOWER = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))
_WORD = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
_STOP = np.array([chr(b) in ".!?" for b in range(256)])


class Model(NamedTuple):
    """Hashes of features in ascending order, their weights, and the bias."""

    words: np.ndarray
    weights: np.ndarray
    bias: float


class Words(NamedTuple):
    """The words of some texts: features (a row of hashes, 0 for none), sentence, and text of each."""

    features: np.ndarray
    sentence: np.ndarray
    text: np.ndarray


def read_words(texts: list[bytes]) -> Words:
    """Words are runs of digits, letters and longer characters, A-Z in lower case; full stops and lines end sentences.

    A word's features are itself and, if it is longer, its first bytes in each of the lengths PREFIXES.
    """
    data, begin, _ = joined([t.translate(_LOWER) for t in texts])
    ends_line = data == 10
    stop = _STOP[data]
    stop[:-1] &= (data[1:] == 32) | ends_line[1:]
    sentence_of = np.cumsum(stop | ends_line)
    starts, ends = word_spans(np.where(_WORD[data], data, np.uint8(32)))
    features = np.zeros((len(starts), 1 + len(PREFIXES)), np.uint64)
    features[:, 0] = word_hashes(data, starts, ends)
    for column, size in enumerate(PREFIXES, 1):
        longer = np.flatnonzero(ends - starts > size)
        features[longer, column] = word_hashes(data, starts[longer], starts[longer] + size) ^ np.uint64(column)
    return Words(features, sentence_of[starts], np.searchsorted(begin, starts, "right") - 1)


def read_many(texts: list[bytes], together: int = 100) -> Words:
    """As read_words, some texts at a time, so that what is held besides the result stays small."""
    parts, sentences = [], 0
    for start in range(0, len(texts), together):
        found = read_words(texts[start:start + together])
        parts.append(Words(found.features, found.sentence + sentences, found.text + start))
        sentences += int(found.sentence[-1]) + 1 if len(found.sentence) else 0
    return Words(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def _features_of(words: list[str]) -> np.ndarray:
    return np.concatenate([read_words([w.encode()]).features[:1] for w in words])


def counterfactuals(found: Words, sentence: np.ndarray, terms: list[np.ndarray]) -> tuple[np.ndarray, Words]:
    """Swapped sentences: for each identity term in a sentence and each other term of its kind.

    Gives the number of the sentence each copy is of, and the words of the copies, numbered as sentences.
    """
    origin, copies, of_copy = [], [np.zeros((0, found.features.shape[1]), np.uint64)], [np.zeros(0, np.int64)]
    for kind in terms:
        for place in np.flatnonzero(np.isin(found.features[:, 0], kind[:, 0])).tolist():
            term = found.features[place, 0]
            here = found.features[sentence == sentence[place]]
            for other in kind[kind[:, 0] != term]:
                copies.append(np.where((here[:, 0] == term)[:, None], other, here))
                of_copy.append(np.full(len(here), len(origin)))
                origin.append(sentence[place])
    numbers = np.concatenate(of_copy)
    return np.array(origin, np.int64), Words(np.concatenate(copies), numbers, numbers)


def _look_up(vocabulary: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the sorted vocabulary, and which of the hashes are there."""
    place = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return place, vocabulary[place] == hashes


def train(sample: list[tuple[bytes, int]], balance: float = BALANCE) -> Model:
    """The model of labelled texts. Without texts of both labels there are no words, and the bias has their share."""
    label = np.array([y for _, y in sample], float)
    if not 0 < label.sum() < len(label):
        share = (label.sum() + 1) / (len(label) + 2)
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(share / (1 - share))))
    found = read_many([t for t, _ in sample])
    if not len(found.text):
        return Model(np.zeros(0, np.uint64), np.zeros(0), 0.0)
    columns = found.features.shape[1]
    terms = [_features_of(kind.split()) for kind in IDENTITY]
    bounds = np.searchsorted(found.text, np.arange(len(sample) + 1))
    each = [np.unique(found.features[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    known, in_text = np.concatenate(each), np.repeat(np.arange(len(sample)), list(map(len, each)))
    del each
    vocabulary, count = np.unique(known, return_counts=True)
    vocabulary = np.setdiff1d(
        np.union1d(vocabulary[count >= LEAST], np.concatenate(terms)[:, 0]), np.zeros(1, np.uint64)
    )
    # Every text also has a sentence without words, so that it has one at all.
    sentences, sentence = np.unique(found.sentence, return_inverse=True)
    text_of = np.zeros(len(sentences), np.int64)
    text_of[sentence] = found.text
    text_of = np.concatenate([text_of, np.arange(len(sample))])
    origin, swapped = counterfactuals(found, sentence, terms)
    n, made = len(text_of), len(origin)
    cells = []
    for part, of_sentence in ((found.features, sentence), (swapped.features, n + swapped.sentence)):
        for column in range(columns):
            place, hit = _look_up(vocabulary, part[:, column])
            cells.append(of_sentence[hit] * len(vocabulary) + place[hit])
    del found, swapped
    cells = np.unique(np.concatenate(cells))  # a feature counts once in a sentence
    rows, place = cells // len(vocabulary), cells % len(vocabulary)
    del cells, hit

    # Start from how much likelier a feature is in texts with label 1.
    at, held = _look_up(vocabulary, known)
    toxic = label[in_text]
    with_one = np.bincount(at[held], toxic[held], len(vocabulary))
    with_any = np.bincount(at[held], minlength=len(vocabulary))
    odds = np.log((with_one + 0.5) / (label.sum() + 1)) - np.log(
        (with_any - with_one + 0.5) / (len(label) - label.sum() + 1)
    )
    theta = np.concatenate([np.where(with_any > 0, odds * with_any / (with_any + 5), 0.0), [-2.0]])

    order = np.lexsort((np.arange(n), text_of))
    firsts = np.flatnonzero(np.r_[True, np.diff(text_of[order]) > 0])
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        logits = theta[-1] + np.bincount(rows, theta[place], n + made)
        ordered = logits[:n][order]
        top = np.maximum.reduceat(ordered, firsts)
        best = np.zeros(len(sample), np.int64)
        at_top = np.flatnonzero(ordered == np.repeat(top, np.diff(np.r_[firsts, n])))[::-1]
        best[text_of[order[at_top]]] = order[at_top]
        slope = np.zeros(n + made)
        slope[best] = (1 / (1 + np.exp(-np.clip(top, -60, 60))) - label) / len(sample)
        if made:
            change = balance * (logits[origin] - logits[n:]) / made
            np.add.at(slope, origin, change)
            slope[n:] -= change
        gradient = np.concatenate([np.bincount(place, slope[rows], len(vocabulary)), [slope[:n].sum()]])
        gradient[:-1] += (SHRINK * np.sign(theta[:-1]) + RIDGE * theta[:-1]) / len(sample)
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        theta -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    heavy = np.abs(theta[:-1]) >= NEGLIGIBLE
    return Model(vocabulary[heavy], theta[:-1][heavy], float(theta[-1]))


def scorer(model: Model):
    """A function from whole texts to scores from 0 to 1; a text without known words gets what the bias says."""

    def score(texts: list[bytes]) -> np.ndarray:
        logits = np.full(len(texts), model.bias)
        if len(model.words):
            found = read_words(texts)
            columns = found.features.shape[1]
            place, known = _look_up(model.words, found.features.ravel())
            hit = np.flatnonzero(known)
            if len(hit):
                word = hit // columns
                cells = np.unique(np.stack([found.sentence[word], place[hit], found.text[word]]), axis=1)
                first = np.flatnonzero(np.r_[True, np.diff(cells[0]) > 0])
                sums = model.bias + np.add.reduceat(model.weights[cells[1]], first)
                np.maximum.at(logits, cells[2][first], sums)
        return 1 / (1 + np.exp(-np.clip(logits, -60, 60)))

    return score


def learn(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> Model:
    """The model of a bounded sample of labelled rows outside the held-out fold, crc32(doc_id as text) mod 5 = 0."""
    return train(labelled_sample(docs, labels.filter(fold(F.col("doc_id"), 5) != 0), "toxic", limit))


def assess(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """For every row of ``docs``: doc_id, held_out, score, predicted.

    Labels (``toxic``) of the held-out fold are never learned. Texts are whole; a null one is empty and gets the bias
    alone. A null id is not held out. Rows that repeat give rows that repeat; an empty table gives none; without usable
    labels every score is 0.5.
    """
    return scored(docs, scorer(learn(docs, labels, limit)), fold(F.col("doc_id"), 5) == 0)


def reject(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """The rows of ``docs``, all columns, with a score below 0.5. Without usable labels all rows stay."""
    model = learn(docs, labels, limit)
    if not len(model.words):
        return docs
    score = scorer(model)
    return repeat_rows(docs, lambda _, texts: (score(texts) < 0.5).astype(int).tolist())


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assess(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
