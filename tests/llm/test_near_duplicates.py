import random

import numpy as np
import pytest

from tidemart.llm import near_duplicates as nd
from tidemart.llm.components import connected_components


def shingles(text, size):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def plain(rows, size):
    """Components by comparing all pairs."""
    sets = {i: shingles(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def corpus(draw, groups=12, copies=12, words=60):
    """Groups of copies with few to many edits, chains of edits among them, and texts that share common passages."""
    names = [f"w{i}" for i in range(400)]
    common = [draw.choice(names) for _ in range(25)]
    rows, i = [], 0
    for _ in range(groups):
        base = [draw.choice(names) for _ in range(draw.choice([1, 3, 8, words]))] + common * draw.randint(0, 1)
        for _ in range(copies):
            new = list(base)
            for _ in range(draw.randint(0, max(1, len(new) // 9))):
                new[draw.randrange(len(new))] = draw.choice(names)
            rows.append((i, " ".join(new)))
            i += 1
            if draw.random() < 0.3:
                base = new
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, size, crowded", [(1, 2, 100), (2, 5, 2)])
def test_components_equal_all_pairs(spark, monkeypatch, seed, size, crowded):
    monkeypatch.setattr(nd, "CROWDED", crowded)
    monkeypatch.setattr(nd, "CHUNK", crowded)
    rows = corpus(random.Random(seed))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in nd.near_duplicates(docs, size).collect()}
    assert found == plain(rows, size)


def test_documents_of_a_pivot_meet_in_bounded_groups(spark, monkeypatch):
    """A pivot with many documents outside its component: no group is large, and all links among them are found."""
    monkeypatch.setattr(nd, "CHUNK", 20)
    draw = random.Random(3)
    base = set(range(40))
    off = {i: set(draw.sample(range(40), 6)) | set(draw.sample(range(100, 112), 6)) for i in range(1, 241)}
    sets = {i: base ^ d for i, d in off.items()}
    packed = {i: bytearray(np.array(sorted(d), np.uint64).tobytes()) for i, d in off.items()}
    stars = spark.createDataFrame([(i, 0, len(sets[i]), False, packed[i]) for i in off], "rep long, pivot long, n long, linked boolean, differing binary")
    placed = spark.createDataFrame([], "node long, root long")
    found = {(min(r.u, r.v), max(r.u, r.v)) for r in nd._links_of_pivots(stars, placed).collect()}
    near = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert found == near and near
    groups = nd._dealt(stars, placed).groupBy("pivot", "ask_chunk", "chunk").count().collect()
    assert max(r["count"] for r in groups) <= 4 * 20  # two chunks, dealt by hash


def test_awkward_rows(awkward, no_documents, spark):
    found = sorted(map(tuple, nd.near_duplicates(awkward, 2).collect()), key=str)
    rows = {(r.doc_id, len(shingles(r.text, 2))) for r in awkward.collect()}
    assert found == sorted([(i, n, i, True) for i, n in rows], key=str)
    assert nd.near_duplicates(no_documents, 2).count() == 0
    same_id = spark.createDataFrame([(7, "a b c"), (7, "x y z"), (8, "x y z"), (3, "a b c")], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in nd.near_duplicates(same_id, 2).collect()} == {(7, 3), (7, 7), (8, 7), (3, 3)}


def test_long_chains_are_one_component(spark):
    draw = random.Random(5)
    ids = list(range(60))
    draw.shuffle(ids)
    links = list(zip(ids, ids[1:])) + [(100, 101), (101, 100), (7, 7), (None, 3)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(1, 60)} | {101: 100}
