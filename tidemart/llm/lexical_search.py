"""Ranked lexical search by bit-sliced Bloom signatures, with exact scores.

Index. Documents with about the same number of distinct terms stand together in blocks. Each document has a Bloom filter
of its terms (`BITS_PER_TERM` bits or more a term, `PROBES` bits set for each), and a block keeps the filters sliced: for
each bit position one bitmap over the block's documents. Besides them a block holds ids, lengths, the largest term
frequency of each document, and the exact postings (64-bit hash and frequency of each term).

Search. For a term the AND of its slices is a bitmap that holds at least the documents with the term. The weights of an
item's terms summed over these bitmaps, times the largest factor that any term frequency of the document allows, is an
upper bound of its score. Documents whose bound is below the `k`-th best exact score met so far in the task are provably
excluded; all others are scored exactly from their postings. What a task emits is its own best `k` of each item, and the
best of these are the answer.

A score is the sum, over the distinct terms of an item, of w * ((10^9 tf) div (1000 tf + 20 m)), with
w = floor(1000 ln((2 N + 2) / (2 df + 1))) and m = 50 + (50 n N) div L (N documents with a term, L their terms, n those
of the document). N, L and df count all documents; equal scores go by ascending id.

Blocks are built by the task that reads the documents, and searched by the task that reads the block: documents are never
shuffled or compared with each other, and a text that a third of the documents hold is just rows of many blocks. Items go
to the tasks in blocks of at most `ITEMS` items and `ITEM_TERMS` terms (a longer item is a block of its own); the index is
written to the shared scratch folder once and read twice for each block of items, as are the answers of each block.

Terms are runs of ASCII letters, digits and anything beyond ASCII, A-Z in lower case. Terms are compared by 64-bit hashes.
Edge cases: null or empty texts have no terms and are found for nothing, on either side; rows of documents are ranked each
for itself, repeated ones too, a null id behind all others of its score; repeated items (equal id and text) are one, an id
with several texts has ranks for each; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_folder
from .common import begin, id_and_text, map_batches, stored

BITS_PER_TERM = 10
PROBES = 5
BLOCK_ROWS = 1_024
BLOCK_POSTINGS = 20_000
ITEMS = 2_000
ITEM_TERMS = 200_000
# Terms whose bitmaps are unpacked at once.
UNPACKED = 2_048
_SEPARATORS = bytes(c for c in range(128) if not chr(c).isalnum())
_TERMS = bytes.maketrans(_SEPARATORS + bytes(range(65, 91)), b" " * len(_SEPARATORS) + bytes(range(97, 123)))
INDEX = pa.schema([
    ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("most", pa.list_(pa.int64())), ("held", pa.list_(pa.int64())),
    ("width", pa.int64()), ("slices", pa.binary()), ("hashes", pa.binary()), ("counts", pa.binary()),
])
INDEX_DDL = ("ids array<long>, lengths array<long>, most array<long>, held array<long>, width long, slices binary, "
             "hashes binary, counts binary")


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERMS).split()


def hashes_of(terms) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, terms), np.uint64, len(terms))


def width_for(distinct: int) -> int:
    """Bits of a filter for so many terms, a power of two."""
    return 1 << max(6, (BITS_PER_TERM * distinct - 1).bit_length())


def probes(hashes: np.ndarray, width: int) -> np.ndarray:
    """The bit positions of each term in a filter of a width."""
    low, step = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    return ((low[:, None] + step[:, None] * np.arange(PROBES, dtype=np.uint64)) & np.uint64(width - 1)).astype(np.int64)


@dataclass
class Pile:
    """Documents of one width that wait for their block."""

    width: int
    rows: list[tuple] = field(default_factory=list)
    postings: int = 0

    def full(self) -> bool:
        return len(self.rows) >= BLOCK_ROWS or self.postings >= BLOCK_POSTINGS

    def block(self) -> dict:
        ids, lengths, most, hashes, counts = zip(*self.rows)
        held = [len(h) for h in hashes]
        packed = np.zeros((self.width, -(-len(ids) // 8)), np.uint8)
        for row, h in enumerate(hashes):
            packed[np.unique(probes(h, self.width)), row // 8] |= np.uint8(128 >> row % 8)
        return {
            "ids": list(ids), "lengths": list(lengths), "most": list(most), "held": held, "width": self.width,
            "slices": packed.tobytes(), "hashes": np.concatenate(hashes).tobytes(), "counts": np.concatenate(counts).tobytes(),
        }


def build_index(docs: DataFrame) -> DataFrame:
    """A row for each block of documents (see `INDEX`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(__name__)
        piles: dict[int, Pile] = {}
        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())):
                found = Counter(terms_of(text.as_py()))
                if not found:
                    continue
                counts = np.fromiter(found.values(), np.uint32, len(found))
                pile = piles.setdefault(width := width_for(len(found)), Pile(width))
                pile.rows.append((i, int(counts.sum()), int(counts.max()), hashes_of(found), counts))
                pile.postings += len(found)
                if pile.full():
                    yield pa.RecordBatch.from_pylist([piles.pop(width).block()], INDEX)
        for pile in piles.values():
            yield pa.RecordBatch.from_pylist([pile.block()], INDEX)

    return id_and_text(docs).mapInArrow(run, INDEX_DDL)


@dataclass
class Items:
    """A block of items with the statistics of their terms."""

    ids: list[int | None]
    terms: list[np.ndarray]
    documents: int = 0
    total: int = 1

    def __post_init__(self):
        self.vocabulary = np.unique(np.concatenate(self.terms))
        self.places = [np.searchsorted(self.vocabulary, t) for t in self.terms]
        self.weights = np.zeros(len(self.vocabulary), np.int64)

    def weigh(self, held: dict[int, int], documents: int, total: int) -> None:
        """Weights from the number of documents that hold each term (by its place in the vocabulary)."""
        self.documents, self.total = documents, total
        for place, df in held.items():
            self.weights[place] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))

    def places_of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are in the vocabulary, and their places."""
        places = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        hits = np.flatnonzero(self.vocabulary[places] == hashes)
        return hits, places[hits]

    def portions(self) -> list[tuple[int, int]]:
        """Ranges of items with at most `UNPACKED` terms in all, or one item."""
        out, low, room = [], 0, UNPACKED
        for i, terms in enumerate(self.terms):
            if i > low and len(terms) > room:
                out.append((low, i))
                low, room = i, UNPACKED
            room -= len(terms)
        return [*out, (low, len(self.terms))]


class Searcher:
    """The best documents of each item among the blocks it is shown."""

    def __init__(self, items: Items, k: int):
        self.items, self.k = items, k
        self.best = [[] for _ in items.ids]
        self.least = np.ones(len(items.ids), np.int64)  # scores below it are out
        self.bounded = self.scored = 0
        self.portions = []
        for low, high in items.portions():
            places = np.concatenate(items.places[low:high])
            owner = np.repeat(np.arange(high - low), [len(t) for t in items.terms[low:high]])
            # Whole numbers, so sums below 2^24 are exact in single precision and all others in double.
            sums = np.bincount(owner, items.weights[places], high - low)
            matrix = np.zeros((high - low, len(places)), np.float32 if sums.max() < 1 << 24 else np.float64)
            matrix[owner, np.arange(len(places))] = items.weights[places]
            self.portions.append((low, high, places, matrix, items.vocabulary[places]))

    def show(self, block: dict) -> None:
        items, width, ids = self.items, block["width"], block["ids"]
        slices = np.frombuffer(block["slices"], np.uint8).reshape(width, -1)
        m = np.array([50 + 50 * n * items.documents // items.total for n in block["lengths"]], np.int64)
        most = np.array(block["most"], np.int64)
        ceiling = 1_000_000_000 * most // (1000 * most + 20 * m)
        postings = None
        for low, high, places, matrix, hashes in self.portions:
            maybe = np.bitwise_and.reduce(slices[probes(hashes, width)], axis=1)
            present = np.unpackbits(maybe, axis=1, count=len(ids)).astype(matrix.dtype)
            bounds = np.rint(matrix @ present).astype(np.int64) * ceiling
            open_ = bounds >= self.least[low:high, None]
            self.bounded += open_.size
            rows = np.flatnonzero(open_.any(0))
            if not len(rows):
                continue
            postings = postings or self._postings(block, m)
            begins = np.concatenate([[0], np.cumsum([len(p) for p in items.places[low:high]])])
            for row in rows.tolist():
                at, gains = postings(row)
                gained = np.zeros(len(items.vocabulary), np.int64)
                gained[at] = gains
                sums = np.concatenate([[0], np.cumsum(gained[places])])
                scores = sums[begins[1:]] - sums[begins[:-1]]
                for item in np.flatnonzero(open_[:, row] & (scores >= self.least[low:high])).tolist():
                    self.best[low + item].append((-int(scores[item]), ids[row] is None, ids[row] or 0))
                self.scored += int(open_[:, row].sum())
            for item in range(low, high):
                if len(self.best[item]) > self.k:
                    self._settle(item)

    def _postings(self, block: dict, m: np.ndarray):
        """Places and contributions of the vocabulary's terms in a document of the block."""
        items, ends = self.items, np.cumsum(block["held"])
        hits, places = items.places_of(np.frombuffer(block["hashes"], np.uint64))
        tf = np.frombuffer(block["counts"], np.uint32)[hits].astype(np.int64)
        owner = np.searchsorted(ends, hits, "right")
        gains = items.weights[places] * (1_000_000_000 * tf // (1000 * tf + 20 * m[owner]))
        cuts = np.searchsorted(owner, np.arange(len(ends) + 1))
        return lambda row: (places[cuts[row] : cuts[row + 1]], gains[cuts[row] : cuts[row + 1]])

    def _settle(self, item: int) -> None:
        self.best[item] = sorted(self.best[item])[: self.k]
        if len(self.best[item]) == self.k:
            self.least[item] = max(1, -self.best[item][-1][0])

    def answers(self) -> Iterator[tuple[int, int | None, int]]:
        """(item number, document, score), at most k of each item."""
        for number, best in enumerate(self.best):
            for score, missing, i in sorted(best)[: self.k]:
                yield number, None if missing else i, -score


def _item_blocks(items: DataFrame) -> Iterator[Items]:
    """The items in blocks of bounded size, one at a time on the driver."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        terms = [hashes_of(set(terms_of(t.as_py()))).astype(np.int64) for t in batch.column("text").cast(pa.binary())]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(terms, pa.list_(pa.int64()))], names=["item_id", "terms"])

    found = map_batches(items, work, "item_id long, terms array<long>").where("size(terms) > 0")
    ids, terms, room = [], [], ITEM_TERMS
    for row in found.toLocalIterator():
        if ids and (len(ids) == ITEMS or len(row["terms"]) > room):
            yield Items(ids, terms)
            ids, terms, room = [], [], ITEM_TERMS
        ids.append(row["item_id"])
        terms.append(np.array(row["terms"], np.int64).astype(np.uint64))
        room -= len(row["terms"])
    if ids:
        yield Items(ids, terms)


def _held_by(index: DataFrame, items: Items) -> dict[int, int]:
    """Number of documents that hold each term of the items."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(len(items.vocabulary), np.int64)
        for batch in batches:
            for hashes in batch.column("hashes"):
                held += np.bincount(items.places_of(np.frombuffer(hashes.as_buffer(), np.uint64))[1], minlength=len(held))
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(held[some], pa.int64())], names=["place", "held"])

    counted = index.select("hashes").mapInArrow(count, "place long, held long").groupBy("place").agg(F.sum("held").alias("held"))
    return {r["place"]: r["held"] for r in counted.collect()}  # a row for each term of the block of items


def _answers(index: DataFrame, items: Items, k: int) -> DataFrame:
    """`number`, `item_id`, `doc_id`, `score`: the best k of each task."""
    schema = pa.schema([("number", pa.int64()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(items, k)
        for batch in batches:
            for at in range(batch.num_rows):
                searcher.show(batch.slice(at, 1).to_pylist()[0])
        found = list(zip(*searcher.answers())) or [(), (), ()]
        numbers, docs, scores = found
        yield pa.RecordBatch.from_pydict({"number": numbers, "item_id": [items.ids[n] for n in numbers], "doc_id": docs, "score": scores}, schema)

    return index.mapInArrow(search, "number long, item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 50, item_id: str = "item_id") -> DataFrame:
    """`item_id`, `rank` (from 1), `doc_id`, `score`: the k best documents with a score above 0 for each item."""
    return search_index(stored(build_index(docs), "lexical-index"), id_and_text(items, item_id).distinct(), k)


def search_index(index: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """The same for an index that is stored already; `items`: `doc_id`, `text`."""
    spark: SparkSession = index.sparkSession
    documents, total = index.select(F.size("ids").alias("n"), F.expr("aggregate(lengths, 0L, (a, b) -> a + b)").alias("l")).agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("l"), F.lit(0))).first()
    folder = scratch_folder(spark, "lexical-answers")
    spark.createDataFrame([], "item_id long, rank int, doc_id long, score long").write.parquet(folder)
    best = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    for block in _item_blocks(items) if documents else ():
        block.weigh(_held_by(index, block), documents, total)
        ranked = _answers(index, block, k).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        ranked.select("item_id", "rank", "doc_id", "score").write.mode("append").parquet(folder)
    return spark.read.schema("item_id long, rank int, doc_id long, score long").parquet(folder)
