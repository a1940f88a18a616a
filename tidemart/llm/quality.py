"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own features and those of its neighbours; the forward-backward marginals
of a document, weighted by the lengths of its lines, make its quality, which a logistic curve fitted with the field
turns into a score from 0 to 1.

Features of a line come from its characters and words only: length, shares of letters in upper case, digits, signs
and blanks, mean length of words, share of distinct words, of words that end in a sign and of words that repeat the one before, whether it ends in a
full stop, whether it equals a neighbour; then the differences to the line before and the line after. Numbers are
cut into bins, so the field can learn any shape.

The field is fitted on a bounded sample of the labelled documents (`SAMPLE_ROWS` rows, those with the smallest hash of
their id, texts of at most `SAMPLE_CHARS` characters), every line taking the label of its document. Scoring reads
whole texts in one pass without a shuffle; the field has a fixed size and is sent with the tasks.

Edge cases: null or empty text is one empty line and is scored like it; without any labelled row, or with one label
only, the score is that label's share (0.5 without rows); a null id is not held out; repeated rows give a row each and
count once as a label; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, id_and_text, keep_rows, map_batches
from .toxicity import labelled_sample

SAMPLE_ROWS = 3_000
SAMPLE_CHARS = 20_000
THRESHOLD = 0.3
BINS = 10

_UPPER, _LOWER, _DIGIT, _BLANK, _SIGN = range(5)
_KIND = np.full(256, _LOWER, np.uint8)
_KIND[[c for c in range(128) if not chr(c).isalnum()]] = _SIGN
_KIND[ord("A") : ord("Z") + 1] = _UPPER
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_KIND[[9, 10, 11, 12, 13, 32]] = _BLANK
_CLOSING = _KIND == _SIGN
_CLOSING[list(b".,;:?'\")")] = False
# Bin borders of the features, in the order of `raw_features`; shares that are 0 in ordinary lines start very low.
_SHARE = (0.001, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9)
_BORDERS = (
    (1, 10, 25, 50, 100, 200, 400, 800, 2000), _SHARE, _SHARE, _SHARE, (0.001, 0.05, 0.1, 0.13, 0.15, 0.18, 0.22, 0.3, 0.5),
    (1, 2, 3, 4, 5, 6, 8, 11, 16), (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.7, 0.85, 0.95), _SHARE, _SHARE, (0.5,), (0.5,),
)
_CHANGES = (-0.5, -0.2, -0.05, -0.01, 0.01, 0.05, 0.2, 0.5)
N_RAW = len(_BORDERS)
# Each of the features, the changes to both neighbours, and one column for the first and last lines.
N_COLUMNS = 3 * N_RAW + 1
N_FEATURES = N_COLUMNS * BINS


def raw_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all lines of the texts (lines x `N_RAW`) and the number of lines of each text."""
    lines = [text.split(b"\n") for text in texts]
    counts = np.array([len(x) for x in lines])
    flat = [line for x in lines for line in x]
    size = np.array([len(line) for line in flat], np.int64)
    starts = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    joined = b"\n".join(flat) + b"\n"
    kinds = _KIND[np.frombuffer(joined, np.uint8)]
    shares = [np.add.reduceat(kinds == k, starts, dtype=np.int64) for k in (_UPPER, _DIGIT, _SIGN, _BLANK)]
    shares[3] = shares[3] - 1  # the line feed
    words = [line.split() for line in flat]
    n_words = np.array([len(w) for w in words])
    distinct = np.array([len(set(w)) for w in words])
    closing = _CLOSING[np.frombuffer(joined, np.uint8)]
    closing[:-1] &= kinds[1:] == _BLANK  # a sign with a blank or the end of the line behind it
    signs = np.add.reduceat(closing, starts, dtype=np.int64)
    again = np.array([sum(map(eq, w, w[1:])) for w in words])
    some, many = np.maximum(size, 1), np.maximum(n_words, 1)
    ends = np.array([line.rstrip()[-1:] in (b".", b"?") for line in flat], float)
    same = np.zeros(len(flat))
    if len(flat) > 1:
        hashes = np.array([hash(line) for line in flat])
        equal = (hashes[1:] == hashes[:-1]) & (size[1:] > 0)
        equal[np.cumsum(counts)[:-1] - 1] = False  # lines of two texts are no neighbours
        same[1:] += equal
        same[:-1] += equal
    out = [size, *[s / some for s in shares], (size - shares[3]) / many, distinct / many, signs / many, again / many, ends, same]
    return np.stack(out, 1), counts


def field_input(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Columns of active features for each line, the number of lines of each text, and lengths of lines as weights."""
    raw, counts = raw_features(texts)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    last = first + counts - 1
    scaled = raw.copy()
    scaled[:, 0] = np.log1p(raw[:, 0]) / 8
    scaled[:, 5] = np.log1p(raw[:, 5]) / 4
    before = np.zeros_like(scaled)
    before[1:] = scaled[1:] - scaled[:-1]
    before[first] = 0
    after = np.zeros_like(scaled)
    after[:-1] = scaled[:-1] - scaled[1:]
    after[last] = 0
    place = np.zeros(len(raw), np.int64)
    place[first] += 1
    place[last] += 2
    columns = [np.searchsorted(_BORDERS[i], raw[:, i], "right") for i in range(N_RAW)]
    columns += [np.searchsorted(_CHANGES, side[:, i], "right") for side in (before, after) for i in range(N_RAW)]
    columns.append(place)
    active = np.stack(columns, 1) + np.arange(N_COLUMNS) * BINS
    return active.astype(np.int16), counts, np.maximum(raw[:, 0], 1)


def forward_backward(emission: np.ndarray, move: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of the lines, expected moves between labels, and the sum of the log partition functions.

    All documents advance together, longest first, so that step t works on those with more than t lines.
    """
    order = np.argsort(-counts, kind="stable")
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])[order]
    sizes = counts[order]
    longest = int(sizes[0]) if len(sizes) else 0
    running = [int(np.searchsorted(-sizes, -t, "left")) for t in range(longest)]  # documents with more than t lines
    scale = emission.max(1, keepdims=True)
    local = np.exp(emission - scale)
    step = np.exp(move)
    forward, norm = np.zeros_like(local), np.zeros(len(local))
    now = None
    for t, n in enumerate(running):
        at = first[:n] + t
        now = local[at] if t == 0 else (now[:n] @ step) * local[at]
        total = now.sum(1)
        now = now / total[:, None]
        forward[at], norm[at] = now, total
    backward = np.ones_like(local)
    moves = np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        n = running[t + 1]
        at = first[:n] + t
        ahead = local[at + 1] * backward[at + 1] / norm[at + 1][:, None]
        backward[at] = ahead @ step.T
        moves += (forward[at].T @ ahead) * step
    marginal = forward * backward
    return marginal / marginal.sum(1, keepdims=True), moves, float(np.log(norm).sum() + scale.sum())


@dataclass
class LineField:
    weights: np.ndarray  # features x 2 labels
    move: np.ndarray  # 2 x 2
    slope: float
    base: float

    def marginals(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chance of each line to be good, lines of each text, weights of the lines."""
        active, counts, weight = field_input(texts)
        emission = self.weights[active].sum(1)
        return forward_backward(emission, self.move, counts)[0][:, 1], counts, weight

    def score(self, texts: list[bytes]) -> np.ndarray:
        good, counts, weight = self.marginals(texts)
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        quality = np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first)
        return 1 / (1 + np.exp(-np.clip(self.base + self.slope * (2 * quality - 1), -30, 30)))


def fit(active: np.ndarray, counts: np.ndarray, weight: np.ndarray, label: np.ndarray, steps: int = 120) -> LineField:
    """Adam on the penalised log likelihood of the labelled lines; the same input gives the same field."""
    weights, move = np.zeros((N_FEATURES, 2)), np.zeros((2, 2))
    share = float(label.mean()) if len(label) else 0.5
    if share in (0.0, 1.0) or not len(label):
        return LineField(weights, move, 0.0, float(np.clip(np.log((share + 1e-6) / (1 - share + 1e-6)), -14, 14)))
    lines = np.repeat(label, counts).astype(int)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    inside = np.ones(len(lines), bool)
    inside[first] = False
    pairs = np.flatnonzero(inside)
    seen = np.zeros((2, 2))
    np.add.at(seen, (lines[pairs - 1], lines[pairs]), 1)
    truth = np.eye(2)[lines]
    flat = active.astype(np.int64).ravel()
    state = [np.zeros_like(p) for p in (weights, weights, move, move)]
    for step in range(1, steps + 1):
        found, moves, _ = forward_backward(weights[active].sum(1), move, counts)
        off = found - truth
        by_feature = np.stack([np.bincount(flat, np.repeat(off[:, y], N_COLUMNS), N_FEATURES) for y in (0, 1)], 1)
        for i, (value, g) in enumerate([(weights, by_feature / len(lines) + 1e-5 * weights), (move, (moves - seen) / len(lines) + 1e-4 * move)]):
            state[2 * i] = 0.9 * state[2 * i] + 0.1 * g
            state[2 * i + 1] = 0.999 * state[2 * i + 1] + 0.001 * g**2
            value -= 0.1 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step) * state[2 * i] / (np.sqrt(state[2 * i + 1]) + 1e-9)
    field = LineField(weights, move, 1.0, 0.0)
    good = forward_backward(weights[active].sum(1), move, counts)[0][:, 1]
    quality = 2 * np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first) - 1
    for _ in range(400):  # logistic curve over the quality of the sample's documents
        p = 1 / (1 + np.exp(-(field.base + field.slope * quality)))
        field.base -= 2.0 * float((p - label).mean())
        field.slope -= 2.0 * float(((p - label) * quality).mean() + 1e-3 * field.slope)
    field.slope = max(field.slope, 0.0)
    return field


def sample_lines(sample: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Line features and labels of the (bounded) sample, on the driver."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t.encode() for t in batch.column("text").to_pylist()]
        active, counts, weight = field_input(texts)
        ends = np.cumsum(counts)
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"), "label": batch.column("label").cast(pa.int32()),
                "n_lines": pa.array(counts, pa.int32()),
                "active": pa.array([active[e - c : e].tobytes() for e, c in zip(ends, counts)], pa.binary()),
                "weight": pa.array([weight[e - c : e].tobytes() for e, c in zip(ends, counts)], pa.binary()),
            }
        )

    rows = map_batches(sample, work, "doc_id long, label int, n_lines int, active binary, weight binary").toArrow().sort_by("doc_id")
    active = np.frombuffer(b"".join(rows.column("active").to_pylist()), np.int16).reshape(-1, N_COLUMNS)
    weight = np.frombuffer(b"".join(rows.column("weight").to_pylist()), float)
    return active, rows.column("n_lines").to_numpy().astype(np.int64), weight, rows.column("label").to_numpy().astype(float)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> LineField:
    return fit(*sample_lines(labelled_sample(docs, labels, label, SAMPLE_ROWS, SAMPLE_CHARS)))


def score_quality(docs: DataFrame, field: LineField) -> DataFrame:
    """`doc_id` and `score` of every text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = field.score([t.encode() for t in batch.column("text").to_pylist()])
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(scores, pa.float64())})

    return map_batches(id_and_text(docs), work, "doc_id long, score double")


def label_lines(docs: DataFrame, field: LineField) -> DataFrame:
    """`doc_id`, `line_no`, `good` (the marginal) of every line."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        good, counts, _ = field.marginals([t.encode() for t in batch.column("text").to_pylist()])
        ends = np.cumsum(counts)
        return pa.RecordBatch.from_pydict(
            {"doc_id": batch.column("doc_id"), "good": pa.array([good[e - c : e] for e, c in zip(ends, counts)], pa.list_(pa.float64()))}
        )

    return map_batches(id_and_text(docs), work, "doc_id long, good array<double>").select(
        "doc_id", F.posexplode("good").alias("line_no", "good")
    )


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`doc_id`, `held_out`, `score` and `predicted`, learned from the labels outside the held-out fifth."""
    scored = score_quality(docs, train(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, field: LineField, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, whose text scores at least the threshold."""
    return keep_rows(docs, lambda texts: (field.score([t.encode() for t in texts]) >= threshold).tolist())
