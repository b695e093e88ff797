"""Mixing to target weights with soft membership in domains.

A classifier that is trained on a labelled table gives each text's posterior over domains. Document rates r >= 0 (how
often a text is to be seen) are then fitted so that the expected tokens of each domain, the sum of rate x tokens x
posterior, meet the targets: least squares by projected gradient, distributed over the documents. The gradient of a
document needs only its posterior and the residual of each domain, so a round sends one vector of residuals out and
gets one vector of sums back, and a rate is a function of the posterior and the steps so far.
"""

from __future__ import annotations

import warnings
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.llm.features import GAP, bucket, joined, labelled_sample
from adtally.llm.rows import per_text, repeat_rows, stage

#: Labelled rows that training uses at most.
SAMPLE = 2000
#: Weights of the domains (language and quality) in the mix.
TARGETS = {
    "en/high": 0.50, "de/high": 0.18, "fr/high": 0.18, "es/high": 0.10,
    "en/low": 0.01, "de/low": 0.01, "fr/low": 0.01, "es/low": 0.01,
}
#: Of these domains nothing has to be given up: the mix is as large as the scarcest of them in relation asks, and more.
COVERED, MARGIN = "/high", 1.05
BITS, STEPS, RATE = 12, 150, 0.05
#: The largest residual, as a share of all tokens, that ends the fit, and rounds without a gain that end it otherwise.
TOLERANCE, STALL = 1e-4, 60
#: What the largest residual has to fall to, as a share of the least so far, to be a gain.
GAIN = 0.99


class Model(NamedTuple):
    """Domains, and the weights and biases of their logits."""

    domains: list[str]
    weights: np.ndarray
    bias: np.ndarray


class Plan(NamedTuple):
    """Steps of the fit (size, residual of each domain), and targets and totals as shares of all tokens."""

    steps: list[tuple[float, np.ndarray]]
    targets: np.ndarray
    reached: np.ndarray


def histograms(texts: list[bytes]) -> np.ndarray:
    """Square roots of the shares of hashed three-byte windows, a row per text."""
    data, begin, lengths = joined(texts)
    n = len(data) - GAP
    hashes = np.zeros(n, np.uint64)
    for i in range(3):
        hashes = hashes * np.uint64(0x100000001B3) ^ data[i:i + n]
    buckets = bucket(hashes, BITS)
    out = np.zeros((len(texts), 1 << BITS), np.float32)
    for row, (start, length) in enumerate(zip(begin.tolist(), lengths.tolist(), strict=True)):
        if length:
            out[row] = np.sqrt(np.bincount(buckets[start:start + length], minlength=1 << BITS) / length)
    return out


def train(sample: list[tuple[bytes, str]]) -> Model:
    """A multinomial logistic model; one domain has posterior 1, none at all gives an empty model."""
    domains = sorted({d for _, d in sample})
    weights, bias = np.zeros((1 << BITS, len(domains)), np.float32), np.zeros(len(domains), np.float32)
    if len(domains) > 1:
        x = np.concatenate([histograms([t for t, _ in sample[i:i + 50]]) for i in range(0, len(sample), 50)])
        y = np.zeros((len(sample), len(domains)), np.float32)
        y[np.arange(len(sample)), [domains.index(d) for _, d in sample]] = 1
        moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(bias), np.zeros_like(bias)]
        for step in range(1, STEPS + 1):
            slope = (_softmax(x @ weights + bias) - y) / len(sample)
            for value, gradient, at in ((weights, x.T @ slope + 1e-6 * weights, 0), (bias, slope.sum(0), 2)):
                moments[at] += 0.1 * (gradient - moments[at])
                moments[at + 1] += 0.001 * (gradient**2 - moments[at + 1])
                size = np.sqrt(moments[at + 1] / (1 - 0.999**step)) + 1e-8
                value -= RATE * moments[at] / (1 - 0.9**step) / size
    return Model(domains, weights, bias)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def posteriors(model: Model, texts: list[bytes]) -> np.ndarray:
    parts = [histograms(texts[i:i + 200]) @ model.weights + model.bias for i in range(0, len(texts), 200)]
    return _softmax(np.concatenate(parts).astype(float))


def domain_sample(docs: DataFrame, labels: DataFrame, limit: int) -> list[tuple[bytes, str]]:
    """Texts and domains (language and quality) of a bounded sample of the labelled table; no language, no domain."""
    rows = labelled_sample(docs, labels, "quality", limit, ("lang",))
    return [(text, f"{lang}/{'high' if good else 'low'}") for text, good, lang in rows if lang]


def membership(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, tokens (words between blanks) and posterior of every whole text."""

    def score(texts: list[bytes]) -> list[pa.Array]:
        shares = posteriors(model, texts)
        return [pa.array([len(t.split()) for t in texts], pa.int64()), pa.array(list(shares), pa.list_(pa.float64()))]

    return per_text(docs, score, "tokens long, posterior array<double>")


def replay(posterior: np.ndarray, steps: list[tuple[float, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Rates after all steps, and before the last; they start from 1."""
    before = rates = np.ones(len(posterior))
    for size, residual in steps:
        before, rates = rates, np.maximum(0.0, rates - size * (posterior @ residual))
    return rates, before


def _sums(members: DataFrame, steps: list[tuple[float, np.ndarray]], domains: int) -> np.ndarray:
    """Over all documents: tokens, squared change of the rates (by tokens), and expected tokens of each domain."""
    names = ["tokens", "change", *(f"d{i}" for i in range(domains))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 + domains)
        for batch in batches:
            if batch.num_rows:
                tokens = batch.column(0).to_numpy(zero_copy_only=False).astype(float)
                posterior = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, domains)
                rates, before = replay(posterior, steps)
                total[0] += tokens.sum()
                total[1] += tokens @ (rates - before) ** 2
                total[2:] += (tokens * rates) @ posterior
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in total], names=names)

    partial = members.select("tokens", "posterior").mapInArrow(run, ", ".join(f"{n} double" for n in names))
    return np.array([x or 0.0 for x in partial.agg(*(F.sum(n).alias(n) for n in names)).first()])


def fit(members: DataFrame, domains: list[str], targets: dict[str, float] | None = None) -> Plan:
    """Steps of a projected gradient with Barzilai-Borwein sizes; residuals are shares of all tokens.

    Targets of domains that the model doesn't know are left out and the others scaled up; a domain without a target
    keeps its present share of the tokens, and the others divide the rest. The fit goes on until the tolerance is met
    or no round of ``STALL`` brings the residual down; then the best round counts, and a warning tells what is missed.
    The driver holds numbers per domain only.
    """
    wanted = TARGETS if targets is None else targets
    weight = np.array([wanted.get(d, 0.0) for d in domains])
    free = np.array([d not in wanted for d in domains])
    first = _sums(members, [], len(domains))
    if not first[0]:
        return Plan([], weight, first[2:])
    have = first[2:] / first[0]
    if not weight.sum():
        return Plan([], have, have)
    weight = np.where(free, have, weight / weight.sum() * (1 - have[free].sum()))
    kept = [d.endswith(COVERED) or f for d, f in zip(domains, free.tolist(), strict=True)]
    covered = [h / w for h, w, k in zip(have, weight, kept, strict=True) if k and w > 0]
    goal = weight * (MARGIN * max(covered) if covered else 1.0)
    steps, residual, size = [], have - goal, 1.0
    best, gained = (np.abs(residual).max(), 0, residual), 0
    mark = best[0]
    while best[0] > TOLERANCE and len(steps) - gained < STALL:
        steps.append((size, residual))
        sums = _sums(members, steps, len(domains))
        now = sums[2:] / sums[0] - goal
        moved = float(((now - residual) ** 2).sum())
        size = float(sums[1] / sums[0] / moved) if moved > 1e-18 else 1.0
        residual, largest = now, np.abs(now).max()
        if largest < best[0]:
            best = largest, len(steps), now
        if largest <= GAIN * mark:
            mark, gained = largest, len(steps)
    if best[0] > TOLERANCE:
        missed = ", ".join(f"{d} {r:+.4g}" for d, r in zip(domains, best[2], strict=True) if abs(r) > TOLERANCE)
        warnings.warn(f"mixing misses its targets after {len(steps)} rounds, as shares of all tokens: {missed}", stacklevel=2)
    return Plan(steps[:best[1]], goal, best[2] + goal)


def copies_of(rates: np.ndarray, ids: list) -> list[int]:
    """Whole numbers that average to the rates: the fraction is rounded up by a hash of the id."""
    chance = np.array([zlib.crc32(b"mix:" + str(i).encode()) / 2**32 for i in ids])
    return np.floor(rates + chance).astype(int).tolist()


def plan(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, limit: int = SAMPLE):
    """The model, the staged posteriors and the fitted plan for ``docs``."""
    model = train(domain_sample(docs, labels, limit))
    if not model.domains:
        return model, None, Plan([], np.zeros(0), np.zeros(0))
    members = stage(membership(docs, model), "mixing-members")
    return model, members, fit(members, model.domains, targets)


def rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, limit: int = SAMPLE) -> DataFrame:
    """For every row of ``docs``: doc_id, tokens, domain (the likeliest), rate, copies.

    A null text is empty: it has no tokens and the posterior that the biases give. Rows that repeat have the same
    rate. Without labelled texts the domain is null and every rate 1; an empty table gives no rows.
    """
    model, members, plan_ = plan(docs, labels, targets, limit)
    if members is None:
        none = per_text(docs, lambda texts: [pa.array([len(t.split()) for t in texts], pa.int64())], "tokens long")
        return none.select(
            "doc_id", "tokens", F.lit(None).cast("string").alias("domain"), F.lit(1.0).alias("rate"),
            F.lit(1).cast("long").alias("copies"),
        )
    domains, steps = model.domains, plan_.steps

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            posterior = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(domains))
            rate, _ = replay(posterior, steps)
            likeliest = [domains[i] for i in posterior.argmax(1)] if len(posterior) else []
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(likeliest, pa.string()), pa.array(rate),
                    pa.array(copies_of(rate, batch.column(0).to_pylist()), pa.int64()),
                ],
                names=["doc_id", "tokens", "domain", "rate", "copies"],
            )

    id_type = members.schema["doc_id"].dataType.simpleString()
    return members.mapInArrow(run, f"doc_id {id_type}, tokens long, domain string, rate double, copies long")


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, limit: int = SAMPLE) -> DataFrame:
    """``docs`` with every row as often as its copies say, all columns; nothing is shuffled or joined for it."""
    model, members, plan_ = plan(docs, labels, targets, limit)
    if members is None:
        return docs
    at, steps = docs.columns.index("doc_id"), plan_.steps

    def copies(batch: pa.RecordBatch, texts: list[bytes]) -> list[int]:
        if not texts:
            return []
        return copies_of(replay(posteriors(model, texts), steps)[0], batch.column(at).to_pylist())

    return repeat_rows(docs, copies)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
