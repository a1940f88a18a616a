"""Removal of repeated strings by common-prefix intervals of enhanced suffix arrays.

A byte goes if a string of `LENGTH` bytes that covers it also starts earlier: in a document with a smaller id, or
before in the same one. Sorting all suffixes of the corpus is out of reach, so it is cut into small, independent
suffix arrays that together see every repeated string:

1. Every window of `LENGTH` bytes has an anchor, its smallest `GRAM`-byte string by hash (the leftmost of equals), which
   depends on nothing but the window. Equal windows have equal anchors, so only anchors met twice can matter. About
   one position in 35 is an anchor; cells of documents send the distinct hashes of theirs to buckets by hash, which
   answer with those met twice.
2. For each such anchor the piece of text that its windows cover is sent to a bucket by the anchor's hash. The bucket
   sorts the suffixes of its pieces, computes common prefixes of neighbours, and a scan with a stack builds the tree of
   common-prefix intervals. Intervals of at least `LENGTH` whose occurrences differ in the byte to the left (or have
   none) are maximal repeats within their pieces; each is put out with all its occurrences. Where an anchor has more
   than `TOGETHER` distinct pieces, their suffixes are sorted apart by the distance from the anchor.
3. Anchors met more than `FREQUENT` times would be too much for one bucket. Equal pieces of theirs count once, by an
   aggregate; the windows of the rest are grouped by 128-bit hash, again by an aggregate, so that no group is gathered.
4. All occurrences of a repeat but the earliest are spans; the spans of a document, joined, are what goes.

Documents equal to an earlier one are found by hash beforehand; they go as a whole and stand for no others.

Matches never cross documents, as texts are never joined. Documents are dealt into cells by hash of the id once, and
Spark reuses that exchange for each of the passes over the texts.

Edge cases: a null text is empty; texts below `LENGTH` bytes stay; a null id counts as the smallest; rows that share an
id are documents of their own, in the order of their bytes, and go to one task; other columns are ignored; an empty table
gives an empty result. Inside, such rows lie one after the other, a byte apart, in the positions of their id.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, input_bytes

LENGTH = 100
GRAM = 32
FREQUENT = 200_000
TOGETHER = 4_000
CELL_BYTES = 8 << 20
BUCKETS_PER_CELL = 4
_NULL_ID = -(1 << 63)
_BLOCK = 1 << 19
_TABLE = np.random.default_rng(7).integers(0, 1 << 63, 256, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = [np.uint64(f) for f in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x94D049BB133111EB)]
_PLACE = np.uint64(20)
_PLACES = np.uint64((1 << 20) - 1)

Anchors = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def anchors_of(text: np.ndarray) -> Anchors:
    """Hash, position, first and last window of every anchor of a text (bytes), in order."""
    parts = [_anchors(text[i : i + _BLOCK + LENGTH - 1], i) for i in range(0, max(1, len(text) - LENGTH + 1), _BLOCK)]
    return tuple(map(np.concatenate, zip(*parts)))


def _anchors(text: np.ndarray, offset: int) -> Anchors:
    if len(text) < LENGTH:
        return np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 3
    hashes, width = _TABLE[text], 1
    for factor in _FACTORS:  # strings of 2, 4, ... 32 bytes from two of half the width
        hashes = hashes[:-width] * factor + hashes[width:]
        width *= 2
    hashes ^= hashes >> np.uint64(29)
    hashes *= _FACTORS[0]
    least = ((hashes >> _PLACE) << _PLACE) | np.arange(len(hashes), dtype=np.uint64)
    span, wanted = 1, LENGTH - GRAM + 1
    while 2 * span <= wanted:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < wanted:
        least = np.minimum(least[: len(least) - (wanted - span)], least[wanted - span :])
    place = (least & _PLACES).astype(np.int64)  # the anchor of each window
    last = np.append(np.flatnonzero(place[1:] != place[:-1]), len(place) - 1)
    first = np.append(0, last[:-1] + 1)
    at = place[last]
    return hashes[at], at + offset, first + offset, last + offset


def intervals(prefix: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """Length and bounds (of suffixes, the end exclusive) of the common-prefix intervals of at least `least`.

    `prefix[i]` is the common prefix of suffixes i and i + 1. An interval is open while it is on the stack.
    """
    for low, high in _runs(prefix >= least):
        stack: list[tuple[int, int]] = []
        for i, length in enumerate([*prefix[low:high].tolist(), 0], low):
            begin = i
            while stack and stack[-1][0] > length:
                inner, begin = stack.pop()
                yield inner, begin, i + 1
            if length >= least and (not stack or stack[-1][0] < length):
                stack.append((length, begin))


def _runs(mask: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return zip(edges[::2].tolist(), edges[1::2].tolist())


def maximal_repeats(
    pieces: list[bytes], length: int = LENGTH, starts: np.ndarray | None = None
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, pieces and starts in them of every repeat that is maximal within the pieces.

    Suffixes with at least `length` bytes are sorted; intervals whose occurrences all have the same byte to the left
    are left out, as the repeat that begins with that byte holds them. With `starts` (one for each piece, or -1) only
    those suffixes are sorted.
    """
    sizes = np.array([len(p) for p in pieces], np.int64)
    begins = np.cumsum(sizes) - sizes
    if starts is None:
        windows = sizes - length + 1
        owner = np.repeat(np.arange(len(pieces)), windows)
        start = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    else:
        owner = np.flatnonzero((starts >= 0) & (starts + length <= sizes))
        start = starts[owner]
    left_over = sizes[owner] - start
    depth = int(sizes.max(initial=0))
    text = np.frombuffer(b"".join(pieces) + bytes(depth), np.uint8)
    suffixes = sliding_window_view(text, depth)[begins[owner] + start].copy()
    suffixes[np.arange(depth) >= left_over[:, None]] = 0
    order = np.argsort(left_over, kind="stable")  # a suffix that ends goes before one that has zero bytes there
    order = order[np.argsort(np.ascontiguousarray(suffixes[order]).view(f"S{depth}").ravel(), kind="stable")]
    suffixes, owner, start, left_over = suffixes[order], owner[order], start[order], left_over[order]
    differs = suffixes[1:] != suffixes[:-1]
    shared = np.where(differs.any(1), differs.argmax(1), depth)
    shared = np.minimum(shared, np.minimum(left_over[1:], left_over[:-1]))
    before = np.where(start > 0, text[begins[owner] + start - 1].astype(np.int64), -1)
    for common, low, high in intervals(shared, length):
        left = before[low:high]
        if left[0] < 0 or (left != left[0]).any():
            yield common, owner[low:high], start[low:high]


def _groups_of_bucket(rows: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, ids and starts (earliest first) of the repeats among the pieces of a bucket.

    Equal pieces of an anchor are a group of their own; the suffix arrays hold the earliest of them only.
    """
    rows = rows.sort_by([("anchor", "ascending"), ("doc_id", "ascending"), ("start", "ascending")])
    ids, starts = rows.column("doc_id").to_numpy(), rows.column("start").to_numpy()
    offs = rows.column("off").to_numpy()
    groups: dict[int, dict[bytes, list[int]]] = {}
    for i, (anchor, piece) in enumerate(zip(rows.column("anchor").to_pylist(), rows.column("piece").to_pylist())):
        groups.setdefault(anchor, {}).setdefault(piece, []).append(i)
    many: list[bytes] = []
    earliest: list[int] = []
    for pieces in groups.values():
        for piece, at in pieces.items():
            if len(at) > 1:
                yield len(piece), ids[at], starts[at]
        if len(pieces) > 1:
            many += pieces
            earliest += [at[0] for at in pieces.values()]
    for some in _slices(groups):
        chosen, first = many[some.start : some.stop], np.array(earliest[some.start : some.stop])
        if len(chosen) <= TOGETHER:
            arrays = [maximal_repeats(chosen)]
        else:  # equal windows are equally far before their anchor, so each distance has a suffix array of its own
            arrays = [maximal_repeats(chosen, starts=offs[first] - far) for far in range(int(offs[first].max()) + 1)]
        for length, owner, start in chain.from_iterable(arrays):
            at = first[owner]
            place = np.lexsort((starts[at] + start, ids[at]))
            yield length, ids[at][place], (starts[at] + start)[place]


def _slices(groups: dict[int, dict[bytes, list[int]]]) -> Iterator[range]:
    """Consecutive groups of pieces together, so that one suffix array stays small; a group is never cut."""
    begin = end = 0
    for pieces in groups.values():
        if len(pieces) > 1:
            if end > begin and end - begin + len(pieces) > TOGETHER:
                yield range(begin, end)
                begin = end
            end += len(pieces)
    if end > begin:
        yield range(begin, end)


def _groups_of_distinct(
    anchors: list[int], offs: np.ndarray, pieces: list[bytes], held: list[int]
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, pieces and starts in them of the repeats among the distinct pieces of a bucket.

    A piece that is `held` more than once is a group by itself, unless a group of several pieces holds it whole.
    """
    groups: dict[int, dict[bytes, list[int]]] = {}
    for i in sorted(range(len(pieces)), key=lambda i: (anchors[i], pieces[i])):
        groups.setdefault(anchors[i], {}).setdefault(pieces[i], []).append(i)
    among = np.array([at[0] for same in groups.values() if len(same) > 1 for at in same.values()], np.int64)
    sizes = np.array([len(p) for p in pieces], np.int64)
    whole: set[int] = set()
    for some in _slices(groups):
        first = among[some.start : some.stop]
        chosen = [pieces[i] for i in first]
        if len(chosen) <= TOGETHER:
            arrays = [maximal_repeats(chosen)]
        else:
            arrays = (maximal_repeats(chosen, starts=offs[first] - far) for far in range(int(offs[first].max()) + 1))
        for length, owner, start in chain.from_iterable(arrays):
            owner = first[owner]
            whole.update(owner[(start == 0) & (sizes[owner] == length)].tolist())
            yield length, owner, start
    for i, count in enumerate(held):
        if count > 1 and i not in whole:
            yield len(pieces[i]), np.array([i]), np.array([0])


Row = tuple[int, int, bytes]  # id, where the text begins in the positions of its id, text


def _rows(texts: pa.Table) -> list[Row]:
    """The texts of a cell; those of one id in the order of their bytes, so that they never touch."""
    of: dict[int, list[bytes]] = {}
    for i, text in zip(texts.column("doc_id").to_pylist(), texts.column("text").to_pylist()):
        of.setdefault(_NULL_ID if i is None else i, []).append(text)
    rows = []
    for i, held in of.items():
        begin = 0
        for text in sorted(held):
            rows.append((i, begin, text))
            begin += len(text) + 1
    return rows


def _noted(notes: pa.Table, kind: str) -> np.ndarray:
    packed = [d for k, d in zip(notes.column("kind").to_pylist(), notes.column("data").to_pylist()) if k == kind]
    return np.frombuffer(b"".join(packed), np.int64)


def _copies_among(notes: pa.Table) -> set[tuple[int, int]]:
    return set(map(tuple, _noted(notes, "copy").reshape(-1, 2).tolist()))


_NOTE = "cell int, kind string, data binary"


def _note_of_group(kind: str, *columns: str):
    """One note for each (cell) group of rows, with whole numbers from some columns."""

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        data = np.stack([rows.column(c).to_numpy() for c in columns], 1).astype(np.int64).tobytes()
        return pa.table({"cell": pa.array([key[0].as_py()], pa.int32()), "kind": [kind], "data": pa.array([data], pa.binary())})

    return pack


class Corpus:
    """The cells of a table of documents and the passes over them."""

    def __init__(self, docs: DataFrame, cell_bytes: int = CELL_BYTES, frequent: int = FREQUENT):
        spark = docs.sparkSession
        self.frequent = frequent
        self.cells = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes(docs) // cell_bytes))
        self.buckets = self.cells * BUCKETS_PER_CELL
        texts = id_and_text(docs).select("doc_id", F.col("text").cast("binary").alias("text"))
        self.texts = texts.withColumn("cell", F.pmod(F.xxhash64("doc_id"), F.lit(self.cells)).cast("int"))
        self.copies = self._copies()

    def _cell_of(self, column: str) -> F.Column:
        plain = F.expr(f"nullif({column}, {_NULL_ID})")
        return F.pmod(F.xxhash64(plain), F.lit(self.cells)).cast("int")

    def _copies(self) -> DataFrame:
        """The documents whose text an earlier one has, as notes to their cells."""

        def digest(rows: pa.Table) -> pa.Table:
            found = _rows(rows)
            return pa.table(
                {
                    "doc_id": pa.array([i for i, _, _ in found], pa.int64()), "begin": pa.array([b for _, b, _ in found], pa.int64()),
                    "digest": pa.array([xxhash.xxh128_digest(t) for _, _, t in found], pa.binary()),
                }
            )

        place = F.struct("doc_id", "begin")
        known = self.texts.groupBy("cell").applyInArrow(digest, "doc_id long, begin long, digest binary")
        first = known.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("held")).where("held > 1")
        later = known.join(first, "digest").where(place > F.col("first")).withColumn("cell", self._cell_of("doc_id"))
        return later.groupBy("cell").applyInArrow(_note_of_group("copy", "doc_id", "begin"), _NOTE)

    def _pass(self, notes: DataFrame, work, schema: str) -> DataFrame:
        """`work(cell, rows of texts, notes)` on every cell; it returns an Arrow table."""

        def run(key: tuple, texts: pa.Table, noted: pa.Table) -> pa.Table:
            return work(key[0].as_py(), _rows(texts), noted)

        return self.texts.groupBy("cell").cogroup(notes.groupBy("cell")).applyInArrow(run, schema)

    def _repeated_anchors(self) -> DataFrame:
        """Hashes of anchors met twice, as notes (`twice`, or `often` above the limit) to the cells that have them."""
        buckets, frequent = self.buckets, self.frequent

        def send(cell: int, texts: list[Row], notes: pa.Table) -> pa.Table:
            copies = _copies_among(notes)
            found = [anchors_of(np.frombuffer(t, np.uint8))[0] for i, b, t in texts if (i, b) not in copies]
            hashes, counts = np.unique(np.concatenate([*found, np.empty(0, np.uint64)]), return_counts=True)
            bucket = (hashes % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            hashes, counts, bucket = hashes[order], counts[order], bucket[order]
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            filled = np.flatnonzero(np.diff(cuts))
            parts = [slice(cuts[b], cuts[b + 1]) for b in filled]
            # Beside the distinct hashes, the counts of those met twice in this cell alone.
            more = [np.stack([hashes[p], counts[p].astype(np.uint64)], 1)[counts[p] > 1].tobytes() for p in parts]
            return pa.table(
                {
                    "bucket": pa.array(filled, pa.int32()), "cell": pa.array([cell] * len(parts), pa.int32()),
                    "hashes": pa.array([hashes[p].tobytes() for p in parts], pa.binary()), "more": pa.array(more, pa.binary()),
                }
            )

        def answer(rows: pa.Table) -> pa.Table:
            parts = [np.frombuffer(h, np.uint64) for h in rows.column("hashes").to_pylist()]
            every, counts = np.unique(np.concatenate(parts), return_counts=True)
            more = np.frombuffer(b"".join(rows.column("more").to_pylist()), np.uint64).reshape(-1, 2)
            np.add.at(counts, np.searchsorted(every, more[:, 0]), more[:, 1].astype(np.int64) - 1)
            out: dict[str, list] = {"cell": [], "kind": [], "data": []}
            for cell, hashes in zip(rows.column("cell").to_pylist(), parts):
                held = counts[np.searchsorted(every, hashes)]
                for kind, chosen in (("twice", (held > 1) & (held <= frequent)), ("often", held > frequent)):
                    if chosen.any():
                        out["cell"].append(cell)
                        out["kind"].append(kind)
                        out["data"].append(hashes[chosen].tobytes())
            return pa.table({"cell": pa.array(out["cell"], pa.int32()), "kind": pa.array(out["kind"], pa.string()),
                             "data": pa.array(out["data"], pa.binary())})

        sent = self._pass(self.copies, send, "bucket int, cell int, hashes binary, more binary")
        return sent.groupBy("bucket").applyInArrow(answer, _NOTE)

    def _pieces(self, kind: str) -> DataFrame:
        """The text around every anchor met `twice` (or `often`): `bucket`, `anchor`, `doc_id`, `start`, `off`, `piece`."""
        buckets = self.buckets

        def cut(cell: int, texts: list[Row], notes: pa.Table) -> pa.Table:
            copies = _copies_among(notes)
            wanted = np.unique(_noted(notes, kind).view(np.uint64))
            out: list[list] = [[], [], [], [], []]
            for i, begin, text in texts if len(wanted) else ():
                if (i, begin) in copies:
                    continue
                found, at, first, last = anchors_of(np.frombuffer(text, np.uint8))
                hit = wanted[np.minimum(np.searchsorted(wanted, found), len(wanted) - 1)] == found
                at, first, last = at[hit].tolist(), first[hit].tolist(), last[hit].tolist()
                out[0].append(found[hit])
                out[1] += [i] * len(at)
                out[2] += [begin + f for f in first]
                out[3] += [a - f for a, f in zip(at, first)]
                out[4] += [text[f : e + LENGTH] for f, e in zip(first, last)]
            hashes = np.concatenate([*out[0], np.empty(0, np.uint64)])
            return pa.table(
                {
                    "bucket": pa.array((hashes % np.uint64(buckets)).astype(np.int32), pa.int32()),
                    "anchor": pa.array(hashes.astype(np.int64), pa.int64()), "doc_id": pa.array(out[1], pa.int64()),
                    "start": pa.array(out[2], pa.int64()), "off": pa.array(out[3], pa.int32()), "piece": pa.array(out[4], pa.binary()),
                }
            )

        schema = "bucket int, anchor long, doc_id long, start long, off int, piece binary"
        return self._pass(self.copies.unionByName(self._repeated_anchors()), cut, schema)

    def groups(self) -> DataFrame:
        """Every maximal repeat of the pieces around ordinary anchors: `length`, `doc_ids` and `starts`, earliest first."""

        def scan(rows: pa.Table) -> pa.Table:
            found = list(_groups_of_bucket(rows))
            return pa.table(
                {
                    "length": pa.array([g[0] for g in found], pa.int32()),
                    "doc_ids": pa.array([g[1] for g in found], pa.list_(pa.int64())),
                    "starts": pa.array([g[2] for g in found], pa.list_(pa.int64())),
                }
            )

        return self._pieces("twice").groupBy("bucket").applyInArrow(scan, "length int, doc_ids array<long>, starts array<long>")

    def occurrences(self) -> DataFrame:
        """`group_id`, `length`, `doc_id`, `start`: every maximal repeat of the pieces, a row for each of its occurrences.

        Anchors of any frequency take part. Suffix arrays hold distinct pieces only, with their numbers, and the places of
        the pieces are joined to the groups afterwards, so a passage that a third of all documents share is one row in a
        task. A task grows with the distinct pieces of an anchor. Documents with the text of an earlier one (of at least
        `LENGTH` bytes) are in a group of whole texts and not again in the groups of the strings in them.
        """

        def scan(rows: pa.Table) -> pa.Table:
            anchors, pieces, held = [rows.column(c).to_pylist() for c in ("anchor", "piece", "held")]
            found = list(_groups_of_distinct(anchors, rows.column("off").to_numpy(), pieces, held))
            sizes = [len(g[1]) for g in found]
            owner = np.concatenate([*[g[1] for g in found], np.empty(0, np.int64)]).astype(np.int64)
            bucket = rows.column("bucket")[0].as_py()
            group_ids = np.repeat(np.array([f"{bucket}:{n}" for n in range(len(found))], object), sizes)
            return pa.table(
                {
                    **{c: rows.column(c).take(pa.array(owner)) for c in ("anchor", "off", "piece_id")},
                    "group_id": pa.array(group_ids, pa.string()),
                    "length": pa.array(np.repeat(np.array([g[0] for g in found], np.int64), sizes), pa.int64()),
                    "at": pa.array(np.concatenate([*[g[2] for g in found], np.empty(0, np.int64)]).astype(np.int64), pa.int64()),
                }
            )

        def whole(rows: pa.Table) -> pa.Table:
            found = [(i, b, t) for i, b, t in _rows(rows) if len(t) >= LENGTH]
            return pa.table(
                {
                    "group_id": pa.array([xxhash.xxh128_hexdigest(t) for _, _, t in found], pa.string()),
                    "length": pa.array([len(t) for _, _, t in found], pa.int64()),
                    "doc_id": pa.array([i for i, _, _ in found], pa.int64()), "start": pa.array([b for _, b, _ in found], pa.int64()),
                }
            )

        pieces = self._pieces("twice").unionAll(self._pieces("often")).withColumn("piece_id", F.md5("piece"))
        key = ["anchor", "off", "piece_id"]
        distinct = pieces.groupBy("bucket", *key, "piece").agg(F.count("*").alias("held"))
        groups = distinct.groupBy("bucket").applyInArrow(scan, "anchor long, off int, piece_id string, group_id string, length long, at long")
        placed = groups.join(pieces.select(*key, "doc_id", "start"), key)
        inside = placed.select("group_id", "length", "doc_id", (F.col("start") + F.col("at")).alias("start"))
        texts = self.texts.groupBy("cell").applyInArrow(whole, "group_id string, length long, doc_id long, start long")
        copied = texts.groupBy("group_id").agg(F.count("*").alias("held")).where("held > 1").select("group_id")
        same = texts.join(copied, "group_id").select("group_id", "length", "doc_id", "start")
        return inside.unionAll(same).withColumn("doc_id", F.expr(f"nullif(doc_id, {_NULL_ID})"))

    def _spans_of_ordinary(self) -> DataFrame:
        def scan(rows: pa.Table) -> pa.Table:
            ids, starts, ends = [], [], []
            for length, of, at in _groups_of_bucket(rows):
                ids.append(of[1:])
                starts.append(at[1:])
                ends.append(at[1:] + length)
            none = [np.empty(0, np.int64)]
            spans = pa.table({"doc_id": np.concatenate(ids + none), "start": np.concatenate(starts + none), "end": np.concatenate(ends + none)})
            return joined_spans(spans)

        return self._pieces("twice").groupBy("bucket").applyInArrow(scan, "doc_id long, start long, end long")

    def _spans_of_frequent(self) -> DataFrame:
        """Spans around anchors too frequent for one bucket, by aggregates over equal pieces, then equal windows."""

        def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out: list[list] = [[], [], []]
                for i, start, piece in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "start", "piece")]):
                    n = len(piece) - LENGTH + 1
                    out[0] += [xxhash.xxh128_digest(piece[w : w + LENGTH]) for w in range(n)]
                    out[1] += [i] * n
                    out[2] += range(start, start + n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())], names=["window", "doc_id", "start"]
                )

        place = F.struct("doc_id", "start")
        often = self._pieces("often").select("anchor", "doc_id", "start", "off", "piece")
        first = often.groupBy("anchor", "off", "piece").agg(F.min(place).alias("first"))
        whole = often.join(first, ["anchor", "off", "piece"]).where(place != F.col("first"))
        spans = whole.select("doc_id", "start", (F.col("start") + F.length("piece")).alias("end"))
        single = first.select("first.doc_id", "first.start", "piece").mapInArrow(windows, "window binary, doc_id long, start long")
        least = single.groupBy("window").agg(F.min(place).alias("first"), F.count("*").alias("held")).where("held > 1")
        later = single.join(least, "window").where(place != F.col("first"))
        return spans.unionAll(later.select("doc_id", "start", (F.col("start") + LENGTH).alias("end")))

    def spans(self) -> DataFrame:
        """`doc_id`, `start`, `end` of repeated strings that are not the earliest; they may overlap. Copies are not listed."""
        return self._spans_of_ordinary().unionAll(self._spans_of_frequent())

    def without_repeats(self, digest: bool = False) -> DataFrame:
        """`doc_id`, `kept` (the bytes that stay) and `spans` (start, end of what goes) of every document.

        With `digest`: `n_bytes`, `n_removed`, `n_spans`, `kept_sha256` instead of the last two.
        """

        def cut(cell: int, texts: list[Row], notes: pa.Table) -> pa.Table:
            copies = _copies_among(notes)
            packed = _noted(notes, "span").reshape(-1, 3)
            spans = joined_spans(pa.table({"doc_id": packed[:, 0], "start": packed[:, 1], "end": packed[:, 2]}))
            of: dict[int, list[tuple[int, int]]] = {}
            for i, start, end in zip(*[spans.column(c).to_pylist() for c in ("doc_id", "start", "end")]):
                of.setdefault(i, []).append((start, end))
            ids, rows = [], []
            for i, begin, text in texts:
                gone = [(a - begin, e - begin) for a, e in of.get(i, ()) if begin <= a <= begin + len(text)]
                if (i, begin) in copies and len(text) >= LENGTH:
                    gone = [(0, len(text))]
                edges = [0, *[e for span in gone for e in span], len(text)]
                kept = b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2])])
                ids.append(None if i == _NULL_ID else i)
                if digest:
                    rows.append({"n_bytes": len(text), "n_removed": len(text) - len(kept), "n_spans": len(gone),
                                 "kept_sha256": sha256(kept).hexdigest()})
                else:
                    rows.append({"kept": kept, "spans": [{"start": a, "end": b} for a, b in gone]})
            schema = pa.schema([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
            if not digest:
                span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
                schema = pa.schema([("kept", pa.binary()), ("spans", pa.list_(span))])
            made = pa.Table.from_pylist(rows, schema)
            return made.add_column(0, "doc_id", pa.array(ids, pa.int64()))

        spans = self.spans().withColumn("cell", self._cell_of("doc_id")).groupBy("cell").applyInArrow(_note_of_group("span", "doc_id", "start", "end"), _NOTE)
        fields = "n_bytes long, n_removed long, n_spans long, kept_sha256 string" if digest else "kept binary, spans array<struct<start:long,end:long>>"
        return self._pass(self.copies.unionByName(spans), cut, f"doc_id long, {fields}")


def joined_spans(spans: pa.Table) -> pa.Table:
    """Overlapping and touching spans of a document as one, in order."""
    ids, starts, ends = [spans.column(c).to_numpy() for c in ("doc_id", "start", "end")]
    if not len(ids):
        return spans
    order = np.lexsort((starts, ids))
    ids, starts, ends = ids[order], starts[order], ends[order]
    # Ends so far, within a document: documents are set apart by more than any end.
    number = np.concatenate([[0], np.cumsum(ids[1:] != ids[:-1])])
    reach = np.maximum.accumulate(ends + number * (int(ends.max()) + 1)) - number * (int(ends.max()) + 1)
    new = np.concatenate([[True], (ids[1:] != ids[:-1]) | (starts[1:] > reach[:-1])])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(ids)) - 1
    return pa.table({"doc_id": ids[first], "start": starts[first], "end": reach[last]})
