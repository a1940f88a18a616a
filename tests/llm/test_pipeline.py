import numpy as np
import sentencepiece

import corpus_pipeline as cp
from tidemart.llm import decontamination as dc
from tidemart.llm import personal_data as private
from tidemart.llm import quality
from tidemart.llm.queries import vocabulary

SF = "/root/testdata/sf0.001"


def shingles(text, size=5):
    words = text.encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} - {()}


def first_of_groups(docs):
    """Ids that stay, by comparing all pairs."""
    sets, root = {i: shingles(d.text or "") for i, d in docs.items()}, {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(docs)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i for i in ids if find(i) == i}


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, benchmark = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    field = quality.train(docs, labels)
    rows = {d.doc_id: d for d in docs.collect()}
    rows = {i: d for i, d in rows.items() if field.score([d.text.encode()])[0] >= quality.THRESHOLD}
    assert 0 < len(rows) < docs.count()
    rows = {i: rows[i] for i in first_of_groups(rows)}

    items = [dc.words_of(r.text) for r in benchmark.collect()]

    def leaked(text):
        words = dc.words_of(text)
        held = set(words)
        for item in items:
            if 2 * sum(w in held for w in item) >= len(item):
                number = {w: n for n, w in enumerate(dict.fromkeys(item))}
                score = dc.align(np.array([number[w] for w in item]), np.array([number.get(w, -1) for w in words]))[0]
                if score >= dc.THRESHOLD * 2 * len(item):
                    return True
        return False

    rows = {i: d for i, d in rows.items() if not leaked(d.text)}
    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    expected = {}
    for i, d in rows.items():
        text = private.masked(d.text, private.spans_of(d.text, private.anchors()))
        expected[i] = (library.encode(text), text)
    assert {r.doc_id: (r.ids, r.text) for r in cp.run(spark, SF).collect()} == expected


def test_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema], name
        assert 0.6 * docs.count() < out.count() <= docs.count(), name


def test_awkward_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, node long"
    rows = [(1, "Plain words to be kept here.", "en", "s", 27, 1.0, 2), (1, "Plain words to be kept here.", "en", "s", 27, 1.0, 2),
            (2, None, None, None, None, None, None), (None, "mail a@b.com now.", None, None, None, None, None), (3, "", "en", "s", 0, None, None)]
    docs = spark.createDataFrame(rows, schema)
    assert cp.one_of_each_group(spark, docs, SF).count() == 5
    assert cp.without_benchmark(spark, docs, SF).count() == 5
    masked = cp.without_personal_data(spark, docs, SF).collect()
    assert {(r.doc_id, r.text, r.n_chars) for r in masked if r.doc_id != 1} == {(2, None, None), (None, "mail <EMAIL> now.", 17), (3, "", 0)}
    assert cp.encoded(spark, docs, SF).count() == 5
    for _, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
