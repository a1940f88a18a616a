import hashlib
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from tidemart.llm import repeats

NULL = -(1 << 63)


def plain(rows, length=repeats.LENGTH):
    """What stays of every document, window by window; rows of one id follow each other in the order of their bytes."""
    texts = sorted((NULL if i is None else i, (text or "").encode()) for i, text in rows)
    seen, out = set(), []
    for i, text in texts:
        gone = np.zeros(len(text), bool)
        for s in range(len(text) - length + 1):
            window = text[s : s + length]
            if window in seen:
                gone[s : s + length] = True
            seen.add(window)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        out.append((None if i == NULL else i, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def corpus(seed):
    draw = random.Random(seed)
    new = lambda n: "".join(draw.choice("abcé \x00") for _ in range(n))
    shared = [new(draw.choice([90, 99, 100, 101, 140, 400])) for _ in range(8)]
    rows = [(i, "".join(draw.choice([new(draw.randint(0, 60)), draw.choice(shared), draw.choice(shared)[draw.randint(0, 30) :]])
                        for _ in range(draw.randint(1, 6)))) for i in range(80)]
    rows += [(100 + i, rows[i][1]) for i in range(0, 20, 3)]
    return [*rows, (200, "ab" * 400), (201, "x" + "ab" * 90), (202, "q" * 150), (None, shared[2] + "tail"), (203, None), (204, ""),
            (205, shared[5]), (205, "a" + shared[5]), (0, rows[0][1]),
            (0, "z" + rows[3][1]), (0, rows[3][1]), (None, shared[2] + "other"), (None, None), (206, shared[5] + "abc"), (206, shared[5] + "abc")]


@pytest.mark.parametrize("seed, frequent", [(1, repeats.FREQUENT), (2, 3)])
def test_equal_to_window_by_window(spark, seed, frequent):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = repeats.Corpus(docs, frequent=frequent).without_repeats(digest=True).collect()
    assert Counter(map(tuple, found)) == plain(rows)


def test_real_outputs(spark):
    rows = corpus(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = Counter()
    for r in repeats.Corpus(docs).without_repeats().collect():
        removed = sum(s.end - s.start for s in r.spans)
        found[(r.doc_id, len(r.kept) + removed, removed, len(r.spans), hashlib.sha256(r.kept).hexdigest())] += 1
    assert found == plain(rows)


def test_groups_hold_all_occurrences_of_maximal_strings(spark):
    passage = "".join(random.Random(4).choices("abcdefgh ", k=130))
    docs = spark.createDataFrame([(i, f"{i} begin {passage} end {i}") for i in range(5)], "doc_id long, text string")
    found = [(r.length, r.doc_ids, r.starts) for r in repeats.Corpus(docs).groups().collect()]
    # The passage and the words around it; each anchor's piece of it is a group with all five occurrences.
    assert found and all(ids == [0, 1, 2, 3, 4] and len(set(starts)) == 1 for _, ids, starts in found)
    covered = set().union(*[range(starts[0], starts[0] + n) for n, _, starts in found])
    assert covered == set(range(1, len(f" begin {passage} end ") + 1))


@pytest.mark.parametrize("frequent", [repeats.FREQUENT, 3])
def test_occurrences_hold_every_equal_window(spark, frequent):
    """Equal strings only, none twice in a group, and all places of each repeated window in one group."""
    draw = random.Random(11)
    new = lambda n: "".join(draw.choice("abc ") for _ in range(n))
    shared = [new(n) for n in (100, 101, 180, 400)]
    rows = [(i, "".join(draw.choice([new(30), draw.choice(shared), shared[3][draw.randint(1, 200) :]]) for _ in range(3))) for i in range(40)]
    rows += [(100, rows[4][1]), (101, rows[4][1]), (102, "ab" * 120), (103, new(300)), (104, "x"), (105, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    groups = {}
    for r in repeats.Corpus(docs, frequent=frequent).occurrences().collect():
        groups.setdefault((r.group_id, r.length), []).append((r.doc_id, r.start))
    texts, first, copies = dict(rows), {}, {}
    for i, text in sorted(rows):
        copies.setdefault(text, []).append(i)
        first.setdefault(text, i)
    around = {}
    for (name, length), at in groups.items():
        assert len({texts[i][s : s + length] for i, s in at}) == 1 and len(set(at)) == len(at) > 1
        if ":" not in name:
            assert [i for i, _ in sorted(at)] == copies[texts[at[0][0]]] and length == len(texts[at[0][0]])
            continue
        for shift in range(length - repeats.LENGTH + 1):
            i, s = at[0]
            around.setdefault(texts[i][s + shift : s + shift + repeats.LENGTH], []).append({(j, t + shift) for j, t in at})
    windows = {}
    for text, i in first.items():
        for s in range(len(text) - repeats.LENGTH + 1):
            windows.setdefault(text[s : s + repeats.LENGTH], set()).add((i, s))
    repeated = {w: at for w, at in windows.items() if len(at) > 1}
    assert repeated and set(around) == set(repeated)
    assert all(at in around[w] for w, at in repeated.items())
    assert any(len(at) >= 3 and ":" not in name for (name, _), at in groups.items())


def test_distinct_pieces_apart_by_distance_give_the_same_groups(monkeypatch):
    held = {}
    for _, text in corpus(6):
        text = (text or "").encode()
        for a, p, f, e in zip(*[x.tolist() for x in repeats.anchors_of(np.frombuffer(text, np.uint8))]):
            key = (int(np.uint64(a).view(np.int64)), p - f, text[f : e + repeats.LENGTH])
            held[key] = held.get(key, 0) + 1
    anchors, offs, pieces = map(list, zip(*held))

    def places():
        found = repeats._groups_of_distinct(anchors, np.array(offs), pieces, list(held.values()))
        return {frozenset((int(i), int(s) + k) for i, s in zip(of, at)) for n, of, at in found for k in range(n - repeats.LENGTH + 1)}

    together = places()
    monkeypatch.setattr(repeats, "TOGETHER", 1)
    apart = places()
    largest = lambda sets: {max((s for s in sets if w in s), key=len) for w in set().union(*sets)}
    assert together and largest(apart) == largest(together)


@pytest.mark.parametrize("seed", range(8))
def test_maximal_repeats_equal_all_pairs(seed):
    draw = random.Random(seed)
    pieces = ["".join(draw.choice("ab\x00") for _ in range(draw.randint(4, 20))).encode() for _ in range(6)]
    length = 4
    expected = set()
    windows = [(p, s) for p in range(6) for s in range(len(pieces[p]) - length + 1)]
    for (p, s), (q, t) in combinations(windows, 2):
        n = 0
        while s + n < len(pieces[p]) and t + n < len(pieces[q]) and pieces[p][s + n] == pieces[q][t + n]:
            n += 1
        if n >= length:
            string = pieces[p][s : s + n]
            at = tuple((o, b) for o in range(6) for b in range(len(pieces[o]) - n + 1) if pieces[o][b : b + n] == string)
            left = {pieces[o][b - 1] if b else None for o, b in at}
            if len(left) > 1 or None in left:
                expected.add((n, at))
    found = [(n, tuple(sorted(zip(o.tolist(), s.tolist())))) for n, o, s in repeats.maximal_repeats(pieces, length)]
    assert len(found) == len(set(found)) and set(found) == expected


def test_equal_windows_have_equal_anchors():
    draw = np.random.default_rng(0)
    window = draw.integers(0, 256, 300).astype(np.uint8)
    sides = [np.concatenate([draw.integers(0, 256, n).astype(np.uint8), window]) for n in (0, 77, 5000)]
    found = []
    for n, text in zip((0, 77, 5000), sides):
        hashes, at, first, last = repeats.anchors_of(text)
        assert (first[1:] == last[:-1] + 1).all() and first[0] == 0 and last[-1] == len(text) - repeats.LENGTH
        owner = np.repeat(np.arange(len(at)), last - first + 1)[n:]
        found.append([(int(hashes[o]), int(at[o]) - n) for o in owner])
    assert found[0] == found[1] == found[2]


def test_blocks_change_nothing(monkeypatch):
    text = np.frombuffer(random.Random(1).randbytes(5000), np.uint8)
    whole = repeats.anchors_of(text)
    monkeypatch.setattr(repeats, "_BLOCK", 700)
    cut = repeats.anchors_of(text)
    assert set(zip(*[x.tolist() for x in whole[:2]])) == set(zip(*[x.tolist() for x in cut[:2]]))


def test_suffix_arrays_apart_by_distance_cover_the_same(monkeypatch):
    rows = []
    for i, text in corpus(5):
        text = (text or "").encode()
        found, at, first, last = repeats.anchors_of(np.frombuffer(text, np.uint8))
        rows += [{"anchor": int(a.view(np.int64)), "doc_id": i or 0, "start": int(f), "off": int(p - f), "piece": text[f : e + repeats.LENGTH]}
                 for a, p, f, e in zip(found, at, first, last)]
    bucket = pa.Table.from_pylist(rows)

    def covered():
        return {(i, b) for n, ids, starts in repeats._groups_of_bucket(bucket) for i, s in zip(ids[1:], starts[1:]) for b in range(s, s + n)}

    together = covered()
    monkeypatch.setattr(repeats, "TOGETHER", 1)
    assert together and covered() == together


def test_spans_join():
    spans = pa.table({"doc_id": [2, 1, 1, 1, 2], "start": [5, 0, 4, 20, 0], "end": [9, 5, 12, 30, 3]})
    assert list(zip(*repeats.joined_spans(spans).to_pydict().values())) == [(1, 0, 12), (1, 20, 30), (2, 0, 3), (2, 5, 9)]


def test_awkward_rows(spark, awkward, no_documents):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    found = repeats.Corpus(awkward).without_repeats(digest=True).collect()
    assert Counter(map(tuple, found)) == plain(rows) and len(found) == len(rows)
    assert repeats.Corpus(no_documents).without_repeats(digest=True).count() == 0
