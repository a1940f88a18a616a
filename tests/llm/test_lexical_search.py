import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemart.llm import lexical_search as ls

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def plain(docs, items, k):
    """Every document scored for every item."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    big_n, total = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for i, c in held:
            m = 50 + 50 * c.total() * big_n // total
            score = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                        for t in set(terms(text)) if c[t])
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, n + 1, None if missing else i, -s) for n, (s, missing, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
            spark.createDataFrame(items, "item_id long, text string"))


@pytest.fixture
def corpus():
    draw = random.Random(12)
    vocabulary = [f"w{int(draw.paretovariate(0.6))}" for _ in range(4000)]
    docs = [(i, " ".join(draw.choices(vocabulary, k=draw.choice([1, 5, 30, 200])))) for i in range(300)]
    docs += [(1000 + i, "a Copied text of W1 and w2") for i in range(90)]
    docs += [(2000, None), (2001, ""), (2002, "... !!"), (None, "a copied text of w1"), (2003, "x " * 5000 + "w3"), (7, "Äpfel und äpfel-W9"), (7, "Äpfel und äpfel-W9")]
    items = [(n, " ".join(draw.choices(vocabulary, k=draw.randint(1, 40)))) for n in range(25)]
    return docs, items + [(25, "COPIED copied w2?"), (26, None), (27, "never met"), (28, "äpfel w9"), (28, "w9"), (3, items[3][1])]


@pytest.mark.parametrize("limits", [{}, {"BLOCK_ROWS": 7, "ITEMS": 4, "UNPACKED": 30, "BITS_PER_TERM": 2}])
def test_equal_to_scoring_everything(spark, corpus, limits, monkeypatch):
    for name, value in limits.items():
        monkeypatch.setattr(ls, name, value)
    docs, items = corpus
    found = ls.search(*frames(spark, docs, items), k=10)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(docs, items, 10)


def test_bounds_exclude_most_documents_and_never_one_that_counts(spark, corpus):
    docs, _ = corpus
    items = ls.Items([1, 2], [ls.hashes_of({b"w900", b"w17"}), ls.hashes_of({b"copied", b"w2"})])
    pile, blocks = {}, []
    for i, text in docs:
        c = Counter(ls.terms_of((text or "").encode()))
        if c:
            counts = np.fromiter(c.values(), np.uint32, len(c))
            w = ls.width_for(len(c))
            p = pile.setdefault(w, ls.Pile(w))
            p.rows.append((i, c.total(), max(c.values()), ls.hashes_of(c), counts))
            if len(p.rows) == 20:
                blocks.append(pile.pop(w).block())
    blocks += [p.block() for p in pile.values()]
    items.weigh({k: 5 for k in range(len(items.vocabulary))}, 390, 30_000)
    searcher = ls.Searcher(items, 5)
    for b in blocks:
        searcher.show(b)
    assert 0 < searcher.scored < searcher.bounded / 2
    everything = ls.Searcher(items, 10**6)
    for b in blocks:
        everything.show(b)
    for few, all_ in zip(searcher.best, everything.best):
        assert sorted(few)[:5] == sorted(all_)[:5]


def test_slices_hold_every_term():
    sets = [{f"{n}-{j}".encode() for j in range(9)} for n in range(21)]
    pile = ls.Pile(ls.width_for(9))
    pile.rows = [(n, 9, 1, ls.hashes_of(s), np.ones(9, np.uint32)) for n, s in enumerate(sets)]
    block = pile.block()
    slices = np.frombuffer(block["slices"], np.uint8).reshape(block["width"], -1)
    for n, s in enumerate(sets):
        maybe = np.unpackbits(np.bitwise_and.reduce(slices[ls.probes(ls.hashes_of(s), block["width"])], axis=1), axis=1, count=21)
        assert maybe[:, n].all() and maybe.sum() < 9 * 21 / 2


def test_awkward_rows(spark, awkward, no_documents):
    items = spark.createDataFrame([(1, "plain words someone", 3), (None, "no id", 1)], "item_id long, text string, rank int")
    found = sorted((tuple(r)[:3] for r in ls.search(awkward, items).collect()), key=repr)
    assert found == [(1, 1, 4), (1, 2, 1), (1, 3, 1), (None, 1, None)]
    assert ls.search(no_documents, items).count() == 0
    assert ls.search(awkward, items.limit(0)).count() == 0
