import hashlib
import random
from collections import defaultdict

import pytest

from tidemart.llm import exact_duplicates as ed

UPPER = str.maketrans(ed._UPPER, ed._LOWER)


def plain(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[(text or "").translate(UPPER)].append(i)
    out = []
    for text, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is not None, i or 0))
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, ids[-1], len(ids), n == len(ids) - 1, digest) for n, i in enumerate(ids)]
    return sorted(out, key=repr)


@pytest.fixture
def corpus(spark):
    draw = random.Random(3)
    begin = "x" * ed.PREFIX
    texts = ["", None, "A b", "a B", "É", "é", "ÀB", "àb", begin + "one", begin + "two", begin + "ONE", begin.upper() + "Two", "K", "k", "K"]
    texts += [" ".join(draw.choices(["alpha", "Beta", "gamma"], k=draw.randint(0, 4))) for _ in range(150)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, "the hot text") for i in range(120)] + [(5000, "z" * 300_000), (5001, "Z" * 300_000)]
    draw.shuffle(rows)
    return rows


def test_equal_to_comparing_whole_texts(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string").repartition(5)
    found = ed.exact_duplicates(docs, text_digest=True)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(corpus)


def test_a_full_bitmap_changes_nothing(spark, corpus, monkeypatch):
    monkeypatch.setattr(ed, "BITS", 2)
    docs = spark.createDataFrame(corpus, "doc_id long, text string")
    found = ed.exact_duplicates(docs, text_digest=True)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(corpus)


def test_only_survivors_are_hashed_whole(spark):
    texts = ["same length a", "same length b", "same beginning" + "." * 300 + "a", "same beginning" + "." * 300 + "b", "copy", "copy", "one of a length!!"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    keyed = docs.selectExpr("cast(octet_length(text) as long) as n_bytes", f"xxhash64(substring(text, 1, {ed.PREFIX})) as beginning")
    bits = sum(int.from_bytes(r.bits).bit_count() for r in ed.survivors(keyed, "n_bytes", "beginning").collect())
    assert bits == 2  # the shared beginning and the copies


def test_awkward_rows(spark, awkward, no_documents):
    found = [tuple(r) for r in ed.exact_duplicates(awkward).collect()]
    assert len(found) == 7
    assert sorted(r[3] for r in found if r[0] == 1) == [False, True]
    assert {r for r in found if r[0] in (2, 3)} == {(2, 3, 2, False), (3, 3, 2, True)}
    assert (None, None, 1, True) in found
    nameless = spark.createDataFrame([(None, "a"), (None, "A"), (4, "a")], "doc_id long, text string")
    assert sorted((tuple(r) for r in ed.exact_duplicates(nameless).collect()), key=repr) == [(4, 4, 3, True), (None, 4, 3, False), (None, 4, 3, False)]
    assert ed.exact_duplicates(no_documents).count() == 0
