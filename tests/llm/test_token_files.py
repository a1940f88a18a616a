import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemart.llm import token_files
from tidemart.llm.queries import op3_token_files, vocabulary

PATH = vocabulary("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_words_equal_whole_texts(tokenizer):
    texts = ["Hello  world's\tfine day\x1cx", "", " ", "É́ é ́a ÅΣ ς12.5%%% a<|endoftext|>b", "中文 été x\n\n''s 're"]
    encoder = token_files.WordEncoder(PATH, limit=500)
    for _ in range(2):
        assert [np.frombuffer(p, "<u2").tolist() for p in encoder.encode(texts)] == [
            tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_query_against_the_tokenizer(spark, tokenizer):
    docs = sorted(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect())
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in op3_token_files(spark, "/root/testdata/sf0.001").collect()}
    start = 0
    for d in docs:
        ids = [*tokenizer.encode(d.text, add_special_tokens=False).ids, 1]
        assert found[d.doc_id] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(found) == len(docs)


def test_shuffled_reads_and_damage(spark, tokenizer, tmp_path):
    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(50)], "doc_id long, text string")
    folder = token_files.write_token_files(docs, str(tmp_path / "out"), PATH)
    index = token_files.index_of(spark, folder)
    read = token_files.read_records(index.orderBy("n_tokens", "offset"), folder, lambda i: {"ids": i.astype(np.int32)}, "ids array<int>")
    for r in read.collect():
        assert r.ids == tokenizer.encode(f"some words {r.doc_id}", add_special_tokens=False).ids
    first = index.orderBy("file", "offset").first()
    path = tmp_path / "out" / "data" / first.file
    data = bytearray(path.read_bytes())
    data[13] ^= 1
    path.write_bytes(bytes(data))
    with open(path, "rb") as file, pytest.raises(ValueError, match="damaged record"):
        token_files.unframed(file, 0)


def test_awkward_rows(spark, awkward, no_documents, tmp_path):
    folder = token_files.write_token_files(awkward, str(tmp_path / "a"), PATH, end_id=1)
    found = sorted(token_files.read_sequences(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [None, 1, 1, 2, 3, 4, 5]
    assert [r.ids for r in found if r.doc_id in (2, 3, 5)] == [[1], [1], [1]]
    assert [r.start for r in found][1:] == list(np.cumsum([len(r.ids) for r in found]))[:-1]
    folder = token_files.write_token_files(no_documents, str(tmp_path / "b"), PATH)
    assert token_files.sequence_digests(spark, folder).count() == 0
