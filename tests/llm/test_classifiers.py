import zlib
from itertools import product

import numpy as np
import pytest

from tidemart.llm import quality, toxicity
from tidemart.llm.queries import op1_quality, op8_toxicity

SF = "/root/testdata/sf0.01"


def test_marginals_equal_the_sum_over_all_labellings():
    draw = np.random.default_rng(1)
    counts = np.array([3, 1, 4, 2])
    emission, move = draw.normal(0, 2, (counts.sum(), 2)), draw.normal(0, 1, (2, 2))
    found, moves, log_norm = quality.forward_backward(emission, move, counts)
    at, total, expected_moves, logs = 0, [], np.zeros((2, 2)), 0.0
    for n in counts:
        weight = {
            path: np.exp(sum(emission[at + i, y] for i, y in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:])))
            for path in product((0, 1), repeat=int(n))
        }
        norm = sum(weight.values())
        logs += np.log(norm)
        for i in range(n):
            total.append([sum(w for p, w in weight.items() if p[i] == y) / norm for y in (0, 1)])
        for p, w in weight.items():
            for a, b in zip(p, p[1:]):
                expected_moves[a, b] += w / norm
        at += n
    assert np.allclose(found, total) and np.allclose(moves, expected_moves) and np.isclose(log_norm, logs)


def test_line_features_equal_plain_counting():
    text = "Ab 12!! x\n\nAb 12!! x\n| | a a a."
    raw, counts = quality.raw_features([text.encode(), b"", b"Q"])
    assert counts.tolist() == [4, 1, 1]
    assert raw[0].tolist()[:5] == [9, 1 / 9, 2 / 9, 2 / 9, 2 / 9] and raw[1, 0] == 0
    assert raw[3, 6:9].tolist() == [3 / 5, 2 / 5, 2 / 5] and raw[3, 9] == 1


def test_a_text_scores_the_same_alone_and_between_its_copies():
    texts = [b"One line of words.", b"Same line.\nAnother one.\nSame line.", b"Same line.\nSame line.\nOther", b""]
    field = quality.LineField(np.random.default_rng(3).normal(0, 1, (quality.N_FEATURES, 2)), np.zeros((2, 2)), 1.0, 0.0)
    for text in texts:
        alone, together = quality.field_input([text])[0], quality.field_input([text] * 3)[0]
        assert (together == np.concatenate([alone] * 3)).all()
        assert np.allclose(field.score([text] * 3), field.score([text]))
    assert np.allclose(field.score(texts), [field.score([t])[0] for t in texts])


def test_machine_equals_the_sum_over_pairs():
    draw = np.random.default_rng(2)
    terms = np.sort(draw.integers(1, 1 << 60, 9).astype(np.uint64))
    machine = toxicity.FactorizationMachine(terms, terms, 0.3, draw.normal(0, 1, 9), draw.normal(0, 1, (9, 3)))
    chosen = [0, 3, 7, 8]
    raw = 0.3 + sum(machine.weights[i] for i in chosen)
    raw += sum(machine.factors[a] @ machine.factors[b] for a in chosen for b in chosen if a < b)
    found = machine.score([terms[chosen], np.array([5], np.uint64)])
    assert np.allclose(found, [1 / (1 + np.exp(-raw)), 1 / (1 + np.exp(-0.3))])


def test_machine_learns_an_interaction_that_sums_miss():
    texts = ["alphas plain words", "betas plain words", "alphas betas plain words", "plain words"] * 30
    found = [toxicity.terms_of(t, {}) for t in texts]
    label = np.array([0, 0, 1, 1] * 30, float)
    machine = toxicity.fit(found, label, steps=600)
    reader = toxicity.Reader(machine)
    score = machine.score([reader.of(t) for t in texts[:4]])
    assert ((score > 0.5) == (label[:4] == 1)).all()


def test_reader_finds_the_terms_of_the_machine():
    text = "Idiot! the idiots, and an idiotic thing " * 3 + "fine day"
    every = toxicity.terms_of(text, {})
    machine = toxicity.FactorizationMachine(every, np.unique(np.concatenate([toxicity.stem_of(every, k) for k in range(8)])), 0.0,
                                            np.ones(len(every)), np.zeros((len(every), 1)))
    assert set(toxicity.Reader(machine).of(text)) == set(every)


@pytest.mark.parametrize("query, column, threshold, least", [(op1_quality, "quality", 0.3, 0.95), (op8_toxicity, "toxic", 0.5, 0.93)])
def test_held_out_accuracy(spark, query, column, threshold, least):
    found = query(spark, SF).collect()
    labels = {r.doc_id: r[column] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(found) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= threshold)
    held = [(r.predicted, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b in held]) >= least


@pytest.mark.parametrize("work, column", [(quality.quality, "quality"), (toxicity.toxicity, "toxic")])
def test_awkward_rows(spark, awkward, no_documents, work, column):
    schema = f"doc_id long, {column} int, text string, score double"
    labels = spark.createDataFrame([(1, 1, "x", 0.1), (1, 1, "x", 0.1), (2, None, None, None), (None, 1, "x", 0.1), (4, 0, "x", None),
                                    (4, 1, "x", None), (3, 0, None, None), (5, 0, None, None)], schema)
    found = work(awkward, labels).collect()
    assert len(found) == 7 and all(0 <= r.score <= 1 for r in found)
    assert [r.held_out for r in found if r.doc_id is None] == [False]
    assert work(no_documents, labels).count() == 0
    none = work(awkward, spark.createDataFrame([], schema)).collect()
    assert {r.score for r in none} == {0.5}


def test_lines_are_labelled(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    field = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    lines = quality.label_lines(spark.createDataFrame([(1, "Is and of the, to with.\nA# $$$ b%%% c### d&&&")], "doc_id long, text string"), field)
    assert [(r.line_no, 0 <= r.good <= 1) for r in lines.orderBy("line_no").collect()] == [(0, True), (1, True)]
