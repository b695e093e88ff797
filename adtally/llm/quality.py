"""Quality classifier: hashed word and character n-gram vectors, averaged per text, with a softmax output.

Vectors and output weights are learned by stochastic gradient descent in numpy, on a bounded sample of labelled
texts. With two classes the trained model is a number per bucket (its vector times the difference of the output
weights), so scoring averages numbers over all n-grams of the whole text.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.llm.features import GAP, bucket, fold, joined, labelled_sample, scored, word_hashes, word_spans

#: Labelled rows that training uses at most.
SAMPLE = 3000
BITS, SIZE, EPOCHS, RATE, SEED = 16, 8, 8, 0.5, 7
GRAMS = (3, 4)
#: Hash of a word bigram whose words are the same, whatever the word.
TWICE = np.uint64(0xD6E8FEB86659FD93)


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """A bucket for the ``size`` bytes from each place on; places in the last GAP bytes have none."""
    n = len(data) - GAP
    hashes = np.full(n, size, np.uint64)
    for i in range(size):
        hashes *= np.uint64(0x100000001B3)
        hashes ^= data[i:i + n]
    return bucket(hashes, BITS)


def _words(data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of words and of word bigrams, each with the number of its text."""
    starts, ends = word_spans(data)
    hashes = word_hashes(data, starts, ends)
    text = np.searchsorted(begin, starts, "right") - 1
    near = text[1:] == text[:-1]
    pairs = hashes[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[1:]
    pairs = np.where(hashes[1:] == hashes[:-1], TWICE, pairs)[near]
    return bucket(hashes, BITS), text, bucket(pairs, BITS), text[1:][near]


def _bag(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and the share of its features that each has."""
    data, begin, lengths = joined([raw])
    inside = slice(begin[0], begin[0] + lengths[0])
    words, _, pairs, _ = _words(data, begin)
    found = np.concatenate([words, pairs, *(_grams(data, n)[inside] for n in GRAMS)])
    buckets, counts = np.unique(found, return_counts=True)
    return buckets, (counts / max(1, len(found))).astype(np.float32)


def train(sample: list[tuple[bytes, int]]) -> tuple[np.ndarray, float]:
    """A number per bucket and the bias. Without rows of both labels the bias alone tells how often 1 is."""
    ones = sum(label for _, label in sample)
    if not 0 < ones < len(sample):
        share = (ones + 1) / (len(sample) + 2)
        return np.zeros(1 << BITS, np.float32), float(np.log(share / (1 - share)))
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / SIZE, 1 / SIZE, (1 << BITS, SIZE)).astype(np.float32)
    output, bias = np.zeros((2, SIZE), np.float32), np.zeros(2, np.float32)
    bags = [(*_bag(text), label) for text, label in sample]
    steps = EPOCHS * len(bags)
    for step, i in enumerate(np.concatenate([rng.permutation(len(bags)) for _ in range(EPOCHS)]).tolist()):
        buckets, share, label = bags[i]
        hidden = share @ vectors[buckets] if len(buckets) else np.zeros(SIZE, np.float32)
        logits = output @ hidden + bias
        chance = np.exp(logits - logits.max())
        chance /= chance.sum()
        chance[label] -= 1  # the gradient by the logits
        rate = RATE * (1 - step / steps)
        back = chance @ output
        output -= rate * np.outer(chance, hidden)
        bias -= rate * chance
        if len(buckets):
            # One step per average feature: each vector moves by its share, scaled to the number of vectors.
            vectors[buckets] -= (rate * len(buckets) * 0.5) * share[:, None] * back
    return vectors @ (output[1] - output[0]), float(bias[1] - bias[0])


def scorer(model: tuple[np.ndarray, float]):
    """A function from whole texts to scores from 0 to 1; a text without features gets what the bias says."""
    weights, bias = model

    def score(texts: list[bytes]) -> np.ndarray:
        data, begin, lengths = joined(texts)
        n = len(data) - GAP
        outside = np.ones(n, bool)
        for start, length in zip(begin.tolist(), lengths.tolist(), strict=True):
            outside[start:start + length] = False
        total, count = np.zeros(len(texts)), len(GRAMS) * lengths.astype(float)
        ends = np.minimum(begin, n - 1)
        for size in GRAMS:
            values = weights[_grams(data, size)]
            values[outside] = 0
            total += np.add.reduceat(values, ends, dtype=np.float64)
        words, of_word, pairs, of_pair = _words(data, begin)
        for buckets, text in ((words, of_word), (pairs, of_pair)):
            total += np.bincount(text, weights[buckets], len(texts))
            count += np.bincount(text, minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + bias, -60, 60)))

    return score


def assess(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """For every row of ``docs``: doc_id, held_out, score, predicted.

    Labels (``quality``) of rows with crc32(doc_id as text) mod 3 = 1 are never learned; those are held out. Texts are
    whole; a null one is empty and gets the bias alone. A null id is not held out. Rows that repeat give rows that
    repeat; an empty table gives none; without usable labels every score is 0.5.
    """
    out = fold(F.col("doc_id"), 3) == 1
    return scored(docs, scorer(train(labelled_sample(docs, labels.filter(~out), "quality", limit))), out)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assess(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
