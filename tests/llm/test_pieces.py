import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from tidemart.llm import pieces
from tidemart.llm.queries import op5_pieces, vocabulary

MODEL = vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def machine():
    return pieces.Transducer(MODEL, limit=5000)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_random_texts_equal_the_library(machine, library):
    draw = random.Random(7)
    for _ in range(3000):
        text = "".join(draw.choice("  ▁aethxéß\n\t𝒳中'.,!AB0129-") for _ in range(draw.randint(0, 40)))
        text = text.replace("e", " " * draw.randint(1, 20)) if draw.random() < 0.3 else text
        ids = np.frombuffer(machine.encode(text), machine.width).tolist()
        assert ids == library.encode(text), text
        assert machine.decode(np.array(ids, int)) == library.decode(ids), text
    assert len(machine.spaced) <= 50


def test_every_piece_pair_rule_equals_merging(machine):
    draw = random.Random(3)
    names = [p for p in machine.pieces if machine.steps[p]]

    def merged(text):
        parts = list(text)
        while True:
            found = [(machine.scores.get(a + b, -9e18), -i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            if not found or max(found)[0] == -9e18:
                return parts
            at = -max(found)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    for _ in range(3000):
        a, b = draw.choice(names), draw.choice(names)
        assert machine._follows(a, b) == (merged(a + b) == [a, b]), (a, b)


def test_query_against_the_library(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    found = {r.doc_id: r for r in op5_pieces(spark, "/root/testdata/sf0.001").collect()}
    assert len(found) == len(docs)
    for d in docs:
        ids = library.encode(d.text)
        row = found[d.doc_id]
        assert (row.n_pieces, row.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest() and row.lossless


def test_awkward_rows(awkward, no_documents):
    found = {r.doc_id: r for r in pieces.encode_texts(awkward, MODEL).collect()}
    assert found[2].ids == [] and found[3].text == "" and found[None].text == "no id here" and found[5].text == "\n\n \t\n"
    assert pieces.encode_texts(awkward, MODEL).count() == 7
    assert pieces.encode_texts(no_documents, MODEL, digest=True).count() == 0


def test_python_workers_keep_no_words_between_tasks(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(4)
    first = {r.doc_id: r.ids for r in pieces.encode_texts(docs, MODEL).collect()}
    assert {r.doc_id: r.ids for r in pieces.encode_texts(docs, MODEL).collect()} == first

    def look(batches):
        from tidemart.llm import common

        for batch in batches:
            for machine in common._KEPT.get("tidemart.llm.pieces", {}).values():
                yield pa.RecordBatch.from_pydict({"kept": [len(machine.spaced) + len(machine.inner) + len(machine.apart)]})

    found = [r.kept for r in spark.range(0, 16, 1, 16).mapInArrow(look, "kept long").collect()]
    assert found and not any(found)  # the machines stay, what they learned from texts does not


def test_words_are_composed_once_whatever_stands_behind_them(library):
    machine = pieces.Transducer(MODEL)
    words, behind = ["heart", "nation", "Über", "élan", "речка"], [".", ",", "!!", ".\nIs", ";", "123", "?)", "中", "$$$"]
    text = " ".join(w + b for w in words for b in behind)
    assert np.frombuffer(machine.encode(text), machine.width).tolist() == library.encode(text)
    # ".\nIs" is three chunks, of which one is met by itself
    assert len(machine.spaced) + len(machine.inner) == len(words) + len(behind) + 1


def test_runs_without_a_blank_equal_the_library(machine, library):
    draw = random.Random(11)
    for _ in range(500):
        n = draw.choice([3, 31, 32, 33, 200])
        text = "".join(draw.choice(["the", "ção", "речка", "ёж", "获取", "据", "ال", "══", "...", "}$.", "_", "9", "\r\n", "²", "Ж1", "🙂", " ▁"]) for _ in range(n))
        ids = np.frombuffer(machine.encode(text), machine.width).tolist()
        assert ids == library.encode(text), text
        assert machine.decode(np.array(ids, int)) == library.decode(ids), text


@pytest.mark.parametrize("prefix", [True, False])
def test_unigram_model_equals_the_library(tmp_path, prefix):
    from sentencepiece import sentencepiece_model_pb2

    draw = random.Random(5)
    model = sentencepiece_model_pb2.ModelProto()
    model.trainer_spec.model_type, model.trainer_spec.byte_fallback = model.trainer_spec.UNIGRAM, True
    model.normalizer_spec.name, model.normalizer_spec.add_dummy_prefix = "identity", prefix
    model.normalizer_spec.remove_extra_whitespaces = False
    kinds = model.SentencePiece
    for name, kind in [("<unk>", kinds.UNKNOWN), ("<s>", kinds.CONTROL), ("</s>", kinds.CONTROL)]:
        model.pieces.add(piece=name, score=0, type=kind)
    for value in range(256):
        model.pieces.add(piece=f"<0x{value:02X}>", score=0, type=kinds.BYTE)
    names = {draw.choice(["", "▁"]) + "".join(draw.choice("abcd") for _ in range(draw.randint(1, 4))) for _ in range(120)}
    for name in sorted(names | set("abc.▁") | {"..", "▁▁", ".,"}):
        model.pieces.add(piece=name, score=-draw.randint(8, 96) / 8, type=kinds.NORMAL)
    file = tmp_path / "unigram.model"
    file.write_bytes(model.SerializeToString())
    machine, library = pieces.Transducer(str(file)), sentencepiece.SentencePieceProcessor(model_file=str(file))
    for _ in range(1000):
        text = "".join(draw.choice("aabbccdd  .,é") for _ in range(draw.randint(0, 60)))
        assert np.frombuffer(machine.encode(text), machine.width).tolist() == library.encode(text), text
