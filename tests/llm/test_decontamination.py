import random

import numpy as np
import pytest

from tidemart.llm import decontamination as dc
from tidemart.llm.queries import op4_decontamination


def plain_score(a, b):
    """Smith-Waterman cell by cell."""
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            pair = dc.MATCH if x == y else dc.MISMATCH
            table[i][j] = max(0, table[i - 1][j - 1] + pair, table[i - 1][j] + dc.GAP, table[i][j - 1] + dc.GAP)
    return max(map(max, table))


@pytest.mark.parametrize("seed", range(40))
def test_alignment_equals_cell_by_cell(seed):
    draw = np.random.default_rng(seed)
    a, b = draw.integers(0, 4, draw.integers(1, 14)), draw.integers(0, 4, draw.integers(0, 25))
    score, start, end = dc.align(a, b)
    assert score == plain_score(a, b)
    assert plain_score(a, b[start:end]) == score  # the bounds hold the whole alignment


def test_edited_copies_are_found_and_others_are_not(spark):
    draw = random.Random(1)
    names = [f"{a}{b}" for a in "bcdfgklm" for b in ("ara", "eno", "ilu", "oke", "umi")]
    item = [draw.choice(names) for _ in range(40)]
    edited = [w if draw.random() > 0.2 else draw.choice(names) for w in item]
    shorter = [w for i, w in enumerate(item) if i % 7]
    fill = lambda n: [draw.choice(names) for _ in range(n)]
    docs = [(1, " ".join(fill(50) + item + fill(50))), (2, " ".join(fill(9) + edited).upper()), (3, ", ".join(shorter + fill(30))),
            (4, " ".join(fill(300))), (5, " ".join(item[:12] + fill(100)))]
    docs += [(10 + i, " ".join(item)) for i in range(30)]  # a passage that is frequent in the corpus
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r for r in dc.contaminated(frame, spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).collect()}
    assert set(found) == {1, 2, 3, *range(10, 40)}
    assert (found[1].score, found[1].first_word, found[1].last_word, found[1].item_id) == (1.0, 50, 90, 7)


@pytest.mark.parametrize("length", [16, 24, 32, 48, 64])
def test_a_single_edited_copy_is_found(spark, length):
    """Nothing else in the corpus holds n-grams of the item; every fourth word of the copy is another one."""
    item = [f"w{i}" for i in range(length)]
    copy = [f"x{i}" if i % 4 == 2 else w for i, w in enumerate(item)]
    docs = [(1, " ".join(["before"] * 9 + copy + ["after"] * 9)), (2, " ".join(item[::3]))]
    found = dc.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, " ".join(item))], "item_id long, text string"))
    assert [(r.doc_id, r.item_id, r.score) for r in found.collect()] == [(1, 7, pytest.approx(plain_score(item, copy) / (2 * length)))]


def test_blocks_and_long_items(spark, monkeypatch):
    monkeypatch.setattr(dc, "BLOCK_ITEMS", 2)
    monkeypatch.setattr(dc, "ITEM_WORDS", 30)
    long_item = " ".join(f"w{i}" for i in range(75))
    items = [(1, long_item), (2, "some other words that are here"), (3, "yet another five word item"), (3, "yet another five word item")]
    docs = [(1, "x y " + long_item), (2, "say some other words that are here now"), (3, "yet another five word item")]
    found = dc.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id, r.score) for r in found.collect()) == [(1, 1, 1.0)] * 3 + [(2, 2, 1.0), (3, 3, 1.0)]


def test_long_items_are_scored_whole(spark):
    item = [f"w{i}" for i in range(405)]
    docs = [(1, " ".join(item[401:404]) + " and other words"), (2, " ".join(item[:200])), (3, "x " + " ".join(item[100:343])), (4, " ".join(item))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = dc.contaminated(frame, items).collect()
    assert {(r.doc_id, r.item_id, r.score) for r in found} == {(3, 1, 243 / 405), (4, 1, 1.0)}
    assert sorted((r.first_word, r.last_word) for r in found if r.doc_id == 4) == [(0, 203), (203, 405)]
    assert sorted(r.doc_id for r in dc.uncontaminated(frame, items).collect()) == [1, 2]


def test_query_against_alignment_of_all_pairs(spark):
    """Every pair that shares half of the words of an item in any order is aligned in full."""
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: dc.words_of(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: dc.words_of(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    expected = {}
    for i, words in docs.items():
        held = set(words)
        for k, item in items.items():
            if 2 * sum(w in held for w in item) >= len(item):
                number = {w: n for n, w in enumerate(dict.fromkeys(item))}
                score = dc.align(np.array([number[w] for w in item]), np.array([number.get(w, -1) for w in words]))[0]
                if score / (2 * len(item)) >= dc.THRESHOLD:
                    expected[i, k] = score / (2 * len(item))
    found = {(r.doc_id, r.item_id): r.score for r in op4_decontamination(spark, sf).collect()}
    assert found == pytest.approx(expected) and found


def test_awkward_rows(spark, awkward, no_documents):
    schema = "item_id long, text string, doc_id long, score string"
    items = spark.createDataFrame([(1, None, 1, "x"), (2, "", 1, None), (None, "no id here", None, None), (3, "of", 1, "x"),
                                   (4, "a line of plain words another line", 1, "x"), (4, "a line of plain words another line", 1, "x")], schema)
    found = sorted(((r.doc_id, r.item_id) for r in dc.contaminated(awkward, items).collect()), key=str)
    assert found == sorted([(1, 4), (1, 4), (None, None)], key=str)
    assert dc.contaminated(no_documents, items).count() == 0
    assert dc.contaminated(awkward, spark.createDataFrame([], schema)).count() == 0
