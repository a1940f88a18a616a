import random
import zlib
from hashlib import sha256

import numpy as np
import pytest

from tidemart.llm import periodic_runs as pr
from tidemart.llm.queries import op13_periodic_runs, with_planted_period


def plain(words):
    """All runs, by trying every period at every place."""
    n, found = len(words), []
    has = lambda s, e, q: all(words[i] == words[i + q] for i in range(s, e - q))
    for q in range(1, n // 4 + 1):
        s = 0
        while s < n - q:
            e = s + q
            while e < n and words[e] == words[e - q]:
                e += 1
            if e - s >= max(6, 4 * q) and not any(has(s, e, d) for d in range(1, q)):
                found.append((s, e - s, q))
            s = max(s + 1, e - q + 1) if e > s + q else s + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("prime, generator", pr.PRIMES)
@pytest.mark.parametrize("size", [2, 8, 64])
def test_transform_convolves_exactly(prime, generator, size):
    draw = np.random.default_rng(size)
    a, b = draw.integers(0, prime, (2, size, 3)).astype(np.uint64)
    back = pr.transform_back(pr.transform(a, prime, generator), prime, generator)
    assert (back == a).all()
    product = pr.transform(a, prime, generator) * pr.transform(b, prime, generator) % np.uint64(prime)
    got = pr.transform_back(product, prime, generator)
    for c in range(3):
        for k in range(size):
            assert int(got[k, c]) == sum(int(a[i, c]) * int(b[(k - i) % size, c]) for i in range(size)) % prime


@pytest.mark.parametrize("length", [1, 4, 16])
def test_occurrences_of_blocks(length):
    draw = random.Random(length)
    words = np.array([draw.randint(0, 1) for _ in range(12 * length)] + [7] * 4 * length, np.uint64)
    blocks = np.array([0, 2, 3, 7])
    for prime in pr.PRIMES:
        zero = pr.zero_mismatches(words, blocks, length, *prime)
        for row, k in zip(zero, blocks):
            for j, hit in enumerate(row):
                x, y = k * length, k * length + length + j
                assert hit == (words[x : x + length] == words[y : y + length]).all()


@pytest.mark.parametrize("seed", range(30))
def test_equal_to_trying_every_period(seed):
    draw = random.Random(seed)
    documents = []
    for _ in range(12):
        words, letters = [], [b"a", b"b", b"c", b"d"][: draw.randint(1, 4)]
        while len(words) < draw.randint(0, 150):
            unit = draw.choices(letters, k=draw.randint(1, 12))
            words += (unit * draw.randint(1, 7))[: draw.randint(1, 90)]
        documents.append(words)
    documents.insert(5, [])
    assert pr.runs_of(documents) == [plain(d) for d in documents]


def test_long_periods_and_runs_that_touch():
    draw = random.Random(8)
    unit = [str(draw.random()).encode() for _ in range(97)]
    words = [b"x"] * 9 + unit * 5 + unit[:40] + [b"y"] * 6 + [b"y", b"z"] * 50 + unit * 3
    assert pr.runs_of([words, words[:30], words * 4]) == [plain(words), plain(words[:30]), plain(words * 4)]
    assert (0, 9, 1) in pr.runs_of([words])[0] and (9, 525, 97) in pr.runs_of([words])[0]


def test_one_word_many_times_is_quick():
    assert pr.runs_of([[b"again"] * 300_000]) == [[(0, 300_000, 1)]]
    assert pr.runs_of([[b"again"] * 3000] * 40) == [[(0, 3000, 1)]] * 40
    assert pr.collapsed([b"a"] * 7 + [b"b"], [(0, 7, 1)]) == b"a b"


def test_query_against_every_period(spark):
    folder = "/root/testdata/sf0.001"
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = {r.doc_id: r for r in op13_periodic_runs(spark, folder).collect()}
    assert set(found) == set(docs)
    some = 0
    for i, text in docs.items():
        words = with_planted_period(i, (text or "").encode().split())
        if len(words) > 800:
            continue
        runs = plain(words)
        some += len(runs)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
        r = found[i]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (best[1] * 1000 // best[2] if runs else None)
        assert r.runs_sha256 == sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        drop = {j for s, n, q in runs for j in range(s + q, s + n)}
        assert r.collapsed_sha256 == sha256(b" ".join(w for j, w in enumerate(words) if j not in drop)).hexdigest()
    assert some > 5


def test_planted_period():
    i = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    g = zlib.crc32(str(i).encode()) // 10
    words = [str(k).encode() for k in range(50)]
    a = g % 50
    p = 1 + (50 - a) // (3 + g % 8)
    assert with_planted_period(i, words) == [words[k if k < a else a + (k - a) % p] for k in range(50)]
    assert with_planted_period(None, words) == words and with_planted_period(i, []) == []


def test_awkward_rows(spark, awkward, no_documents):
    found = pr.periodic_runs(awkward).collect()
    assert len(found) == 7
    assert {(r.doc_id, len(r.runs), r.text) for r in found if r.doc_id in (2, 3, 5)} == {(2, 0, ""), (3, 0, ""), (5, 0, "")}
    long_one = next(r for r in found if r.doc_id == 4)
    words = "reach me at someone@mail.example.com or idle words go on and on".split()
    assert [tuple(r) for r in long_one.runs] == [(0, 4000 * len(words), len(words))]
    assert long_one.text == " ".join(words)
    assert pr.periodic_runs(no_documents, digest=True).count() == 0
