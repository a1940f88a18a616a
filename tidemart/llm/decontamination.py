"""Benchmark decontamination: n-gram seeds, a bound by common words, then Smith-Waterman alignment.

1. All n-grams of the test items (`GRAM` words) are seeds, so an edited copy needs only one of them intact to be looked at.
2. Around the seeds of an item that a document holds lie the regions where the item may be; those that touch are one.
   A region whose words, each giving its full points, cannot reach the threshold is left out. That bound is exact, and
   it is what n-grams that occur in many documents cost.
3. The other regions are aligned with the item: Smith-Waterman over words (match 2, mismatch -1, gap -1). The score is
   the share of the best possible one, 2 for each word of the item. Edited and paraphrased copies lose points, but align on.

Items are taken in blocks of at most `BLOCK_ITEMS` items and `BLOCK_ITEMS` times `ITEM_WORDS` words (a longer item is a
block of its own) in the tables sent to the tasks; the documents are read once for each block, without a shuffle. Items
are aligned whole. A match of an item over `ITEM_WORDS` words has a row for each of its parts of even length that occurs
in the aligned passage, with the place of the part and the score of the whole item.

Words are runs of letters and digits in lower case. Items with fewer words than an n-gram match nothing. Edge cases: null or empty texts match nothing, on either side; null ids are kept in matches; repeated rows of
documents give a match each, repeated items (equal id and text) one; an empty table gives no matches; other columns
are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, keep_rows, map_batches

GRAM = 3
THRESHOLD = 0.5
BLOCK_ITEMS = 2_000
ITEM_WORDS = 400
MATCH, MISMATCH, GAP = 2, -1, -1
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams_of(words: list[str]) -> list[tuple[str, ...]]:
    return list(zip(*[words[i:] for i in range(GRAM)]))


@dataclass
class Items:
    """A block of test items."""

    ids: list[int | None]
    words: list[list[str]]

    def seeds(self) -> dict[tuple[str, ...], list[tuple[int, int]]]:
        """The items and places of every n-gram."""
        seeds: dict[tuple[str, ...], list[tuple[int, int]]] = defaultdict(list)
        for item, words in enumerate(self.words):
            for place, gram in enumerate(grams_of(words)):
                seeds[gram].append((item, place))
        return dict(seeds)


def align(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two sequences of word numbers: score, and its bounds in the region (end exclusive).

    Row by row; the gaps along a row are a running maximum. Ties take the earliest end, then the latest start.
    """
    n = len(region)
    score, start = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best = (0, 0, 0)
    steps = np.arange(n + 1)
    for word in item:
        diagonal = score[:-1] + np.where(region == word, MATCH, MISMATCH)
        above = score[1:] + GAP
        new, origin = np.zeros(n + 1, np.int64), np.arange(n + 1)
        take = np.maximum(diagonal, above)
        from_diagonal = diagonal >= above
        new[1:] = np.maximum(take, 0)
        origin[1:] = np.where(take > 0, np.where(from_diagonal, start[:-1], start[1:]), steps[1:])
        shifted = new - GAP * steps
        reach = np.maximum.accumulate(shifted)
        source = np.maximum.accumulate(np.where(shifted == reach, steps, 0))
        score = reach + GAP * steps
        start = origin[source]
        end = int(score.argmax())
        if score[end] > best[0]:
            best = (int(score[end]), int(start[end]), end)
    return best


class Matcher:
    """Matches of texts with a block of items."""

    def __init__(self, items: Items):
        self.items = items
        self.part_words = ITEM_WORDS
        self.number: dict[str, int] = {}
        self.coded = [np.array([self.number.setdefault(w, len(self.number)) for w in words]) for words in items.words]
        self.seeds = items.seeds()
        self.first = {g[0] for g in self.seeds}

    def matches(self, text: str, threshold: float) -> list[dict]:
        words = words_of(text)
        hits: dict[int, list[int]] = defaultdict(list)
        first, seeds = self.first, self.seeds
        for at in [i for i, w in enumerate(words) if w in first]:
            for item, place in seeds.get(tuple(words[at : at + GRAM]), ()):
                hits[item].append(at - place)
        found = []
        for item, begins in hits.items():
            sequence = self.coded[item]
            margin = len(sequence) // 2 + 2
            best = (0, 0, 0)
            for low, high in _regions(sorted(begins), len(sequence), margin):
                low, high = max(0, low), min(len(words), high)
                common = sum(map(set(words[low:high]).__contains__, self.items.words[item]))
                if common / len(sequence) < threshold or MATCH * common <= best[0]:
                    continue
                region = np.array([self.number.get(w, -1) for w in words[low:high]])
                score, start, end = align(sequence, region)
                if score > best[0]:
                    best = (score, low + start, low + end)
            share = best[0] / (MATCH * len(sequence))
            if share >= threshold:
                places = self._places(sequence, words, *best[1:])
                found += [{"item_id": self.items.ids[item], "score": share, "first_word": low, "last_word": high} for low, high in places]
        return found

    def _places(self, sequence: np.ndarray, words: list[str], low: int, high: int) -> list[tuple[int, int]]:
        """Where the parts of an item lie in the passage aligned with it."""
        parts = -(-len(sequence) // self.part_words)
        if parts == 1:
            return [(low, high)]
        region = np.array([self.number.get(w, -1) for w in words[low:high]])
        aligned = [align(part, region) for part in np.array_split(sequence, parts)]
        return [(low + start, low + end) for score, start, end in aligned if score]


def _regions(begins: list[int], length: int, margin: int) -> list[tuple[int, int]]:
    """Where an item that begins about there would lie, with a margin for edits; touching regions are one."""
    out: list[list[int]] = []
    for begin in begins:
        low, high = begin - margin, begin + length + margin
        if out and low <= out[-1][1]:
            out[-1][1] = high
        else:
            out.append([low, high])
    return [(low, high) for low, high in out]


def _blocks(benchmark: DataFrame) -> list[Items]:
    """The items in blocks of bounded size. Test sets are lists written by people; they pass through the driver."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    blocks: list[Items] = []
    room = 0
    for row in rows.where("text is not null").distinct().orderBy("item_id", "text").toLocalIterator():
        words = words_of(row["text"])
        if not words:
            continue
        if not blocks or len(blocks[-1].ids) == BLOCK_ITEMS or len(words) > room:
            blocks.append(Items([], []))
            room = BLOCK_ITEMS * ITEM_WORDS
        blocks[-1].ids.append(row["item_id"])
        blocks[-1].words.append(words)
        room -= len(words)
    return blocks


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`doc_id`, `item_id`, `score`, `first_word` and `last_word` (end exclusive) of every match, the best of each pair.

    Items over `ITEM_WORDS` words have a row for each part, with the score of the whole item.
    """
    texts = id_and_text(docs)
    schema = "doc_id long, item_id long, score double, first_word int, last_word int"
    fields = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int32()), ("last_word", pa.int32())])
    found = docs.sparkSession.createDataFrame([], schema)
    for items in _blocks(benchmark):

        def work(batch: pa.RecordBatch, matcher: Matcher = Matcher(items)) -> pa.RecordBatch:
            rows = [
                {"doc_id": i, **match}
                for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
                for match in matcher.matches(text, threshold)
            ]
            return pa.RecordBatch.from_pylist(rows, fields)

        found = found.unionAll(map_batches(texts, work, schema))
    return found


def uncontaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, that match no item."""
    rest = docs
    for items in _blocks(benchmark):
        matcher = Matcher(items)
        rest = keep_rows(rest, lambda found, matcher=matcher: [not matcher.matches(t, threshold) for t in found])
    return rest
