"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(b + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j), x_i = 1 where a text holds term i. The pair
part lets an insult weigh more (or less) next to the mention of a group than both do alone.

Terms are words in lower case without punctuation around them, their beginnings of 4 to 7 letters (inflected and
compound forms share one), each with how often a text holds it: at least 1, 2, 3 or 5 times, or twice and in 0.5, 1, 2
or 4 of 100 words. A term is the 64-bit hash of both.
The machine is fitted on a bounded sample of the labelled documents (`SAMPLE_ROWS` rows, those with the smallest
hash of their id, texts of at most `SAMPLE_CHARS` characters) and on the terms of that sample that separate the
labels best; a term outside them weighs nothing. Scoring reads whole texts in one pass without a shuffle; the
fitted machine has a fixed size and is sent with the tasks.

Edge cases: null or empty text is scored by the bias; without any labelled row, or with one label only, the score is
that label's share (0.5 without rows); a null id is not held out; repeated rows give a row each and count once as a
label; other columns are ignored; labels that contradict each other for one document are left out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, id_and_text, map_batches

SAMPLE_ROWS = 4_000
SAMPLE_CHARS = 20_000
TERMS = 1_024
FACTORS = 4
BEGINNINGS = (4, 5, 6, 7)
COUNTS = (1, 2, 3, 5)
RATES = (0.005, 0.01, 0.02, 0.04)
_AROUND = re.compile(r"^\W+|\W+$")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """At most `rows` labelled documents outside the held-out fifth, by the hash of their ids."""
    known = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(label).alias("label"), F.max(label).alias("other"))
        .where((F.col("label") == F.col("other")) & ~held_out())
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select("doc_id", "label")
    texts = id_and_text(docs).join(F.broadcast(chosen), "doc_id").where(F.length("text") <= chars)
    return texts.dropDuplicates(["doc_id"])


def stems(word: str) -> tuple[int, ...]:
    """Hashes of a word and its beginnings; none for mere punctuation."""
    plain = _AROUND.sub("", word).lower()
    if not plain:
        return ()
    parts = [plain, *[plain[:n] + "~" for n in BEGINNINGS if len(plain) >= n]]
    return tuple([xxhash.xxh64_intdigest(p) for p in parts])


def levels(stem: np.ndarray, count: np.ndarray, n_words: int) -> np.ndarray:
    """Hashed terms of a text from its stems and how often it holds each."""
    out = []
    for number, reached in enumerate([*[count >= c for c in COUNTS], *[(count >= 2) & (count >= r * n_words) for r in RATES]]):
        mixed = (stem[reached] ^ np.uint64(number)) * np.uint64(0x9E3779B97F4A7C15)
        out.append(mixed ^ (mixed >> np.uint64(31)))
    return np.concatenate(out)


def stem_of(terms: np.ndarray, number: int) -> np.ndarray:
    """The stems that terms are made of, were they of this level; undoes the mixing in `levels`."""
    mixed = terms ^ (terms >> np.uint64(31)) ^ (terms >> np.uint64(62))
    return (mixed * np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))) ^ np.uint64(number)


def terms_of(text: str, known: dict[str, tuple[int, ...]]) -> np.ndarray:
    """All hashed terms of a text; `known` keeps the stems of words."""
    words = text.split()
    found = [known.get(w) or known.setdefault(w, stems(w)) for w in words]
    stem, count = np.unique(np.array([h for hashes in found for h in hashes], np.uint64), return_counts=True)
    return levels(stem, count, len(words))


@dataclass
class FactorizationMachine:
    terms: np.ndarray  # sorted hashes
    stems: np.ndarray  # sorted hashes of the stems that any of the terms are made of
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, found: list[np.ndarray]) -> np.ndarray:
        """Probability of the label for each text, given its distinct terms (others than the machine's are ignored)."""
        sizes = np.array([len(f) for f in found], np.int64)
        terms = np.concatenate([*found, np.empty(0, np.uint64)])
        rows = np.repeat(np.arange(len(found)), sizes)
        at = np.minimum(np.searchsorted(self.terms, terms), max(0, len(self.terms) - 1))
        hit = self.terms[at] == terms if len(self.terms) else np.zeros(len(terms), bool)
        rows, at = rows[hit], at[hit]
        raw = np.full(len(found), self.bias)
        np.add.at(raw, rows, self.weights[at])
        sums, squares = np.zeros((2, len(found), self.factors.shape[1]))
        np.add.at(sums, rows, self.factors[at])
        np.add.at(squares, rows, self.factors[at] ** 2)
        raw += 0.5 * (sums**2 - squares).sum(1)
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


class Reader:
    """Terms of texts as far as a machine knows their stems; most words have none, which is kept for the next text."""

    def __init__(self, machine: FactorizationMachine, kept: int = 500_000):
        self.wanted = set(machine.stems.tolist())
        self.known: dict[str, tuple[int, ...]] = {}
        self.kept = kept

    def _stems(self, word: str) -> tuple[int, ...]:
        found = tuple([h for h in stems(word) if h in self.wanted])
        if len(self.known) < self.kept:
            self.known[word] = found
        return found

    def of(self, text: str) -> np.ndarray:
        known = self.known
        words = text.split()
        found = [h for w in words for h in (known[w] if w in known else self._stems(w))]
        stem, count = np.unique(np.array(found, np.uint64), return_counts=True)
        return levels(stem, count, len(words))


def select_terms(found: list[np.ndarray], label: np.ndarray, terms: int) -> np.ndarray:
    """Fifteen of sixteen: the terms whose shares in the two labels differ most, in standard errors; the rest: the most
    frequent others, which may tell something only next to another term. All in at least three texts."""
    sides = [np.unique(np.concatenate([f for f, y in zip(found, label) if y == side]), return_counts=True) for side in (1, 0)]
    every = np.union1d(sides[0][0], sides[1][0])
    one, zero = np.zeros((2, len(every)))
    one[np.searchsorted(every, sides[0][0])] = sides[0][1]
    zero[np.searchsorted(every, sides[1][0])] = sides[1][1]
    n, n_one = len(label), label.sum()
    share = (one + zero) / n
    error = np.sqrt(np.maximum(share * (1 - share), 1 / n) * (1 / n_one + 1 / (n - n_one)))
    z = np.where(one + zero >= 3, np.abs(one / n_one - zero / (n - n_one)) / error, 0)
    best = np.lexsort((every, -z))[: terms * 15 // 16]
    best = best[z[best] > 2]
    other = np.lexsort((every, -(one + zero)))
    other = other[(one + zero)[other] >= 3]
    other = other[~np.isin(other, best)][: terms // 16]
    return np.sort(every[np.concatenate([best, other])])


def fit(found: list[np.ndarray], label: np.ndarray, terms: int = TERMS, factors: int = FACTORS, steps: int = 250) -> FactorizationMachine:
    """Adam on the logistic loss with squared penalties, all rows in each step; the same input gives the same machine."""
    share = float(label.mean()) if len(label) else 0.5
    if share in (0.0, 1.0) or not len(label):
        none = np.empty(0, np.uint64)
        return FactorizationMachine(none, none, float(np.clip(np.log((share + 1e-6) / (1 - share + 1e-6)), -14, 14)),
                                    np.empty(0), np.empty((0, factors)))
    chosen = select_terms(found, label, terms)
    x = np.array([np.isin(chosen, f, assume_unique=True) for f in found], np.float32)
    draw = np.random.default_rng(0)
    values = [np.float32(np.log(share / (1 - share))), np.zeros(len(chosen), np.float32),
              draw.normal(0, 0.02, (len(chosen), factors)).astype(np.float32)]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for step in range(1, steps + 1):
        bias, weights, vectors = values
        sums = x @ vectors
        raw = bias + x @ weights + 0.5 * (sums**2 - x @ vectors**2).sum(1)
        off = ((1 / (1 + np.exp(-np.clip(raw, -30, 30))) - label) / len(label)).astype(np.float32)
        weighted = off @ x
        gradients = [off.sum(), weighted + 1e-4 * weights,
                     x.T @ (off[:, None] * sums) - weighted[:, None] * vectors + 1e-3 * vectors]
        for i, g in enumerate(gradients):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g**2
            rate = 0.05 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            values[i] = (values[i] - rate * first[i] / (np.sqrt(second[i]) + 1e-8)).astype(np.float32)
    used = np.unique(np.concatenate([stem_of(chosen, number) for number in range(len(COUNTS) + len(RATES))]))
    return FactorizationMachine(chosen, used, float(values[0]), values[1].astype(float), values[2].astype(float))


def sample_terms(sample: DataFrame) -> tuple[list[np.ndarray], np.ndarray]:
    """Terms and labels of the (bounded) sample, on the driver."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        known: dict[str, tuple[int, ...]] = {}
        found = [terms_of(t, known).astype(np.int64) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_pydict(
            {"doc_id": batch.column("doc_id"), "label": batch.column("label").cast(pa.int32()),
             "terms": pa.array(found, pa.list_(pa.int64()))}
        )

    rows = map_batches(sample, work, "doc_id long, label int, terms array<long>").toArrow().sort_by("doc_id")
    found = [t.values.to_numpy().astype(np.uint64) for t in rows.column("terms")]
    return found, rows.column("label").to_numpy().astype(float)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> FactorizationMachine:
    return fit(*sample_terms(labelled_sample(docs, labels, label)))


def score_toxicity(docs: DataFrame, machine: FactorizationMachine) -> DataFrame:
    """`doc_id` and `score` of every text."""
    held: list[Reader] = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append(Reader(machine))
        scores = machine.score([held[0].of(t) for t in batch.column("text").to_pylist()])
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(scores, pa.float64())})

    return map_batches(id_and_text(docs), work, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """`doc_id`, `held_out`, `score` and `predicted`, learned from the labels outside the held-out fifth."""
    scored = score_toxicity(docs, train(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
