"""Near-duplicates by a chosen-path similarity join over sets of word shingles.

In each of `TREES` independent trees every document follows the path of its minwise tokens: at each level a hash
function of its own picks one shingle of the set. All start at depth `FIRST_DEPTH`; nodes that still hold more than
`CROWDED` documents branch once more, down to `LAST_DEPTH`. Two sets of similarity s share a node of depth d in one
tree with chance s^d, so at 0.8 a pair is missed by all 20 trees with chance 1e-9 at depth 2 and 3e-5 at depth 4.

Within a node pairs are compared exhaustively, but for two shortcuts that lose no component: documents with equal
sets are one beforehand, and pairs that are connected already are not compared.

1. Every document of a node is compared with the node's pivot (its smallest document) by 80 one-bit minwise sketches,
   those far from the pivot with all others. What passes (4.5 standard deviations below 0.8) is a candidate.
2. Each document's smallest pivot, and the candidates of those far from a pivot, are confirmed on the full sets. These
   links give a first partition into components.
3. Documents of one pivot but in different components are compared with each other as they differ from the pivot: the
   shingles in which a set and its pivot's differ are few, and they tell the similarity of two sets exactly. The
   documents of a pivot are dealt into chunks, and those outside the pivot's component into chunks of their own; each
   pair of chunks is a group, so a group has a bounded number of rows however many documents a pivot has.
4. All other candidates whose ends are in different components, in any node, are confirmed on the full sets.

All steps are aggregates and joins keyed by node or document, so a node with a third of all documents is spread over
tasks by Spark's skew handling; tables between the steps are written to the shared scratch folder.

Words are runs of anything but ASCII white space, A-Z in lower case. A set holds the distinct shingles; a text with
fewer words than a shingle has one, all its words. Shingles are compared by 64-bit hashes.

Edge cases: null or empty text, or one without words, has an empty set and links with nothing; a null id links with
nothing either, its component is null and it is kept; equal rows give one row; one id with different texts gives a
row for each, linked by its own text; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_folder
from .common import Bounded, id_and_text, kept, map_batches
from .components import connected_components

TREES = 20
FIRST_DEPTH, LAST_DEPTH = 2, 4
CROWDED = 100
SIMILARITY_PERCENT = 80
# Of 80 bits, 8 differ on average at similarity 0.8, with a standard deviation of 2.7.
SKETCH_LIMIT = 20
CHUNK = 2_000
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(31)
KEPT_BYTES = 48 << 20


class Words(Bounded):
    """Hashes of words."""

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word)
        self.keep(word, found)
        return found


def words() -> Words:
    """Kept by the Python worker until its task ends."""
    return kept(__name__, "words", lambda: Words(KEPT_BYTES))


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> _SHIFT)) * _GOLDEN
    return values ^ (values >> _SHIFT)


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text."""
    found = text.lower().split()  # both for ASCII only, as these are bytes
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(words().__getitem__, found), np.uint64, len(found))
    length = min(size, len(found))
    out = np.full(len(found) - length + 1, length, np.uint64)
    for i in range(length):
        out = mixed(out) + hashes[i : len(hashes) - length + 1 + i]
    return np.unique(mixed(out))


def multipliers() -> np.ndarray:
    """Odd factors, one for each tree and level; fixed, so that runs agree."""
    draw = np.random.default_rng(20240601)
    return draw.integers(0, 1 << 63, TREES * LAST_DEPTH, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def minwise(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Smallest image of the set under each factor, in blocks so that memory does not grow with the text."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 2048):
        np.minimum(least, (factors[:, None] * shingles[None, i : i + 2048]).min(1), out=least)
    return least


def _tokens(docs: DataFrame, size: int) -> DataFrame:
    """For each document: size and 128-bit hash of its set, path hashes at each depth, sketch."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        factors = multipliers()
        sizes, first, second, low, high = [], [], [], [], []
        paths: list[list] = [[] for _ in range(FIRST_DEPTH, LAST_DEPTH + 1)]
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            found = shingle_set(text, size)
            sizes.append(len(found))
            digest = xxhash.xxh128_digest(found.tobytes())
            first.append(int.from_bytes(digest[:8], "little", signed=True))
            second.append(int.from_bytes(digest[8:], "little", signed=True))
            tokens = mixed(minwise(found, factors)).reshape(LAST_DEPTH, TREES)
            bits = ((tokens.ravel() >> np.uint64(40)) & np.uint64(1)) << (np.arange(tokens.size, dtype=np.uint64) % np.uint64(40))
            low.append(int(bits[:40].sum()))
            high.append(int(bits[40:].sum()))
            path = np.arange(TREES, dtype=np.uint64)
            for depth in range(1, LAST_DEPTH + 1):
                path = mixed(path * _GOLDEN + tokens[depth - 1])
                if depth >= FIRST_DEPTH:
                    paths[depth - FIRST_DEPTH].append(path.astype(np.int64))
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"), "n": pa.array(sizes, pa.int64()), "h1": pa.array(first, pa.int64()),
                "h2": pa.array(second, pa.int64()), "s1": pa.array(low, pa.int64()), "s2": pa.array(high, pa.int64()),
                **{f"path{FIRST_DEPTH + i}": pa.array(p, pa.list_(pa.int64())) for i, p in enumerate(paths)},
            }
        )

    depths = ", ".join(f"path{d} array<long>" for d in range(FIRST_DEPTH, LAST_DEPTH + 1))
    return map_batches(id_and_text(docs), work, f"doc_id long, n long, h1 long, h2 long, s1 long, s2 long, {depths}")


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    spark = df.sparkSession
    folder = scratch_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.parquet(folder)


def _close(a: str, b: str) -> F.Column:
    """Whether sizes and sketches of two sides allow the similarity."""
    differing = F.expr(f"bit_count({a}.s1 ^ {b}.s1) + bit_count({a}.s2 ^ {b}.s2)")
    sizes = F.expr(f"100 * least({a}.n, {b}.n) >= {SIMILARITY_PERCENT} * greatest({a}.n, {b}.n)")
    return sizes & (differing <= SKETCH_LIMIT)


def _nodes(classes: DataFrame) -> DataFrame:
    """`rep` and `node` of every node with at least two documents, at the depth where it stops branching.

    Each level is written, as several reads of it follow: its counts, what is settled, and what branches on.
    """
    settled, rows = None, classes.select("rep", F.posexplode(f"path{FIRST_DEPTH}").alias("tree", "node"))
    for depth in range(FIRST_DEPTH, LAST_DEPTH + 1):
        held = rows.groupBy("node").agg(F.count("*").alias("held")).where("held > 1")
        level = _stored(rows.join(held, "node"), f"level-{depth}")
        done = level
        if depth < LAST_DEPTH:
            done, crowded = level.where(F.col("held") <= CROWDED), level.where(F.col("held") > CROWDED)
            deeper = classes.select("rep", F.col(f"path{depth + 1}").alias("path"))
            rows = crowded.drop("held", "node").join(deeper, "rep").select("rep", "tree", F.expr("path[tree]").alias("node"))
            rows = _stored(rows, f"branches-{depth}")
        done = done.select("rep", "node")
        settled = done if settled is None else settled.unionAll(done)
    return settled


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """`rep` and the full set (packed, sorted) of the wanted documents."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingle_set(t, size).tobytes() for t in batch.column("text").cast(pa.binary()).to_pylist()]
        return pa.RecordBatch.from_pydict({"rep": batch.column("doc_id"), "shingles": pa.array(found, pa.binary())})

    return map_batches(id_and_text(docs).join(wanted, "doc_id", "left_semi"), work, "rep long, shingles binary").distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            both = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum()) if len(a) and len(b) else 0
            keep.append(similar(len(a), len(b), len(a) + len(b) - 2 * both))
        return pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("rep").alias("u"), F.col("shingles").alias("a"))
    right = sets.select(F.col("rep").alias("v"), F.col("shingles").alias("b"))
    return map_batches(pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b"), work, "u long, v long")


def _stars(edges: DataFrame, sets: DataFrame) -> DataFrame:
    """For each document and its pivot: size of its set, whether they are linked, and where their sets differ."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, linked, differing = [], [], []
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            off = np.setxor1d(a, b, assume_unique=True)
            sizes.append(len(a))
            differing.append(off.tobytes())
            linked.append(similar(len(a), len(b), len(off)))
        return pa.RecordBatch.from_arrays(
            [batch.column("rep"), batch.column("pivot"), pa.array(sizes, pa.int64()), pa.array(linked, pa.bool_()), pa.array(differing, pa.binary())],
            names=["rep", "pivot", "n", "linked", "differing"],
        )

    left = sets.select("rep", F.col("shingles").alias("a"))
    right = sets.select(F.col("rep").alias("pivot"), F.col("shingles").alias("b"))
    joined = edges.join(left, "rep").join(right, "pivot").select("rep", "pivot", "a", "b")
    return map_batches(joined, work, "rep long, pivot long, n long, linked boolean, differing binary")


def similar(a: int, b: int, differing: int) -> bool:
    """Whether sets of sizes a and b that differ in so many elements are similar enough."""
    both = (a + b - differing) // 2
    return both > 0 and 100 * both >= SIMILARITY_PERCENT * (both + differing)


def _dealt(stars: DataFrame, placed: DataFrame) -> DataFrame:
    """The documents of open pivots in groups of about two `CHUNK` rows at most: (pivot, chunk of askers, chunk of members)."""
    roots = placed.select(F.col("node").alias("rep"), "root")
    marked = stars.join(roots, "rep", "left").withColumn("part", F.coalesce("root", "rep")).drop("root")
    main = placed.select(F.col("node").alias("pivot"), F.col("root").alias("main"))
    marked = marked.join(main, "pivot", "left").withColumn("outside", F.col("part") != F.coalesce("main", "pivot"))
    held = marked.groupBy("pivot").agg(F.count("*").alias("held"), F.count_if("outside").alias("asking")).where("asking > 0 and held > 1")
    chunks = [F.expr(f"cast(ceil({n} / {CHUNK}) as int)").alias(c) for n, c in (("held", "chunks"), ("asking", "ask_chunks"))]
    rows = marked.select("pivot", "rep", "part", "n", "differing", "outside").join(held.select("pivot", *chunks), "pivot")
    own = lambda n: F.expr(f"cast(pmod(xxhash64(rep), {n}) as int)")
    every = lambda n: F.explode(F.expr(f"sequence(0, {n} - 1)"))
    members = rows.withColumn("chunk", own("chunks")).withColumn("ask_chunk", every("ask_chunks")).withColumn("asks", F.lit(False))
    asking = rows.where("outside").withColumn("ask_chunk", own("ask_chunks")).withColumn("chunk", every("chunks")).withColumn("asks", F.lit(True))
    columns = ["pivot", "ask_chunk", "chunk", "rep", "part", "n", "differing", "asks"]
    return members.select(columns).unionAll(asking.select(columns))


def _links_of_pivots(stars: DataFrame, placed: DataFrame) -> DataFrame:
    """Links (u, v) between documents of one pivot that are in different components."""

    def compare(rows: pa.Table) -> pa.Table:
        asks = np.array(rows.column("asks").to_pylist(), bool)
        ids, parts, sizes = [rows.column(c).to_numpy() for c in ("rep", "part", "n")]
        sets = [np.frombuffer(d, np.uint64) for d in rows.column("differing").to_pylist()]
        members = np.flatnonzero(~asks)
        lengths = np.array([len(sets[i]) for i in members])
        flat = np.concatenate([sets[i] for i in members] + [np.empty(0, np.uint64)])
        owner = np.repeat(np.arange(len(members)), lengths)
        u, v = [], []
        for i in np.flatnonzero(asks):
            at = np.minimum(np.searchsorted(sets[i], flat), max(0, len(sets[i]) - 1))
            hit = sets[i][at] == flat if len(sets[i]) else np.zeros(len(flat), bool)
            shared = np.bincount(owner[hit], minlength=len(members))
            differing = lengths + len(sets[i]) - 2 * shared
            both = (sizes[members] + sizes[i] - differing) // 2
            linked = (both > 0) & (100 * both >= SIMILARITY_PERCENT * (both + differing)) & (parts[members] != parts[i])
            u += [ids[i]] * int(linked.sum())
            v += ids[members[linked]].tolist()
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return _dealt(stars, placed).groupBy("pivot", "ask_chunk", "chunk").applyInArrow(compare, "u long, v long")


def near_duplicates(docs: DataFrame, size: int = 5) -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id` and `kept` (the smallest id of its component) of every document."""
    tokens = _stored(_tokens(docs, size), "tokens")
    known = tokens.where("doc_id is not null and n > 0")
    classes = known.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"))
    paths = [f"path{d}" for d in range(FIRST_DEPTH, LAST_DEPTH + 1)]
    first = known.join(classes.withColumnRenamed("rep", "doc_id"), ["h1", "h2", "doc_id"]).dropDuplicates(["h1", "h2"])
    first = _stored(first.select(F.col("doc_id").alias("rep"), "n", "s1", "s2", *paths), "classes")
    sketches = first.select("rep", "n", "s1", "s2")

    nodes = _stored(_nodes(first).join(sketches, "rep"), "nodes")
    pivots = nodes.groupBy("node").agg(F.min(F.struct("rep", "n", "s1", "s2")).alias("p"))
    seen = nodes.alias("m").join(pivots, "node").withColumn("near", _close("m", "p") & F.expr("m.rep <> p.rep"))
    edges = seen.where("near").groupBy("rep").agg(F.min("p.rep").alias("pivot"))
    flagged = seen.withColumn("stray", F.expr("not near and m.rep <> p.rep")).select("node", "rep", "n", "s1", "s2", "stray")
    edges = _stored(edges, "edges")
    strays = _stored(_pairs(flagged, F.lit(True)), "strays")
    ends = [edges.select("rep"), edges.select("pivot"), strays.select("u"), strays.select("v")]
    # The ends of all later candidates are among these: such a pair is near a pivot or one of them is far from it.
    wanted = reduce(DataFrame.unionAll, [*ends, seen.where("near").select("p.rep")]).toDF("doc_id").distinct()
    sets = _stored(_sets(docs, wanted, size), "sets")

    stars = _stored(_stars(edges, sets), "stars")
    links = stars.where("linked").select(F.col("rep").alias("u"), F.col("pivot").alias("v"))
    placed = connected_components(links.unionAll(_confirmed(strays, sets)))
    marked = nodes.join(placed.withColumnRenamed("node", "rep"), "rep", "left").withColumn("part", F.coalesce("root", "rep")).drop("root")
    mixed_nodes = marked.groupBy("node").agg(F.min("part").alias("main"), F.max("part").alias("last")).where("main <> last")
    open_rows = marked.join(mixed_nodes.select("node", "main"), "node").join(stars.select("rep", "pivot"), "rep", "left")
    apart = F.expr("a.part <> b.part and not coalesce(a.pivot = b.pivot or a.pivot = b.rep or b.pivot = a.rep, false)")
    across = _pairs(open_rows.withColumn("stray", F.expr("part <> main")), apart).join(strays, ["u", "v"], "left_anti")
    more = _confirmed(across, sets).unionAll(_links_of_pivots(stars, placed))
    joined = connected_components(placed.select(F.col("node").alias("u"), F.col("root").alias("v")).unionAll(more))

    member = tokens.select("doc_id", "n", "h1", "h2").distinct()
    member = member.join(classes, ["h1", "h2"], "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.expr("case when doc_id is null or n = 0 then doc_id else coalesce(root, rep) end")
    return member.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _pairs(rows: DataFrame, rule: F.Column) -> DataFrame:
    """Distinct pairs (u < v) of a stray row and any other of its node that a rule and their sketches allow."""
    once = F.expr("a.node = b.node and a.rep <> b.rep and not (b.stray and b.rep < a.rep)")
    both = rows.where("stray").alias("a").join(rows.alias("b"), once & rule & _close("a", "b"))
    return both.select(F.expr("least(a.rep, b.rep)").alias("u"), F.expr("greatest(a.rep, b.rep)").alias("v")).distinct()

