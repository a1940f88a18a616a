"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

import zlib
from importlib.util import find_spec
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_folder
from . import chat, decontamination, exact_duplicates, hamming, lexical_search, near_duplicates, periodic_runs, personal_data, pieces, quality, repeats, token_files, toxicity
from .common import read_table


def vocabulary(name: str) -> str:
    """Place of a vocabulary file of the `public_tokenizers` package."""
    return str(Path(find_spec("public_tokenizers").origin).parent / name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.Corpus(read_table(spark, sf_dir, "documents")).without_repeats(digest=True)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "token-files")
    token_files.write_token_files(read_table(spark, sf_dir, "documents"), folder, vocabulary("word_bpe_49k.json"), end_id=1)
    return token_files.sequence_digests(spark, folder)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_texts(read_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), digest=True)


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_data_digest(read_table(spark, sf_dir, "documents"))


def op7_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return hamming.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=10, dims=64)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", planted), (-7, 1, "assistant", planted)], "conv_id long, turn long, role string, text string"
    )
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_conversations(rows.unionByName(extra)))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(read_table(spark, sf_dir, "documents"), size=2)


def op11_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates.exact_duplicates(read_table(spark, sf_dir, "documents"), text_digest=True)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=50)


def with_planted_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents repeat a stretch of their words to the end; which one depends on the id."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * -(-(n - a) // p))[: n - a]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(read_table(spark, sf_dir, "documents"), rewrite=with_planted_period, digest=True)


QUERIES = {
    "op1_quality": op1_quality,
    "op2_repeats": op2_repeats,
    "op3_token_files": op3_token_files,
    "op4_decontamination": op4_decontamination,
    "op5_pieces": op5_pieces,
    "op6_personal_data": op6_personal_data,
    "op7_hamming": op7_hamming,
    "op8_toxicity": op8_toxicity,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_exact_duplicates": op11_exact_duplicates,
    "op12_lexical_search": op12_lexical_search,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE = {
    # Texts as hexadecimal digits, two for a byte; a window is 200 of them.
    "op2_repeats": r"""
        with coded as (
            select doc_id, hex(encode(coalesce(text, ''))) as h from documents
        ), windows as (
            select doc_id, s, substring(h, 2 * s + 1, 200) as w
            from (select doc_id, h, unnest(range(0, cast(length(h) // 2 - 99 as bigint))) as s from coded where length(h) >= 200)
        ), later as (
            select doc_id, s from (select doc_id, s, row_number() over (partition by md5(w) order by doc_id, s) as k from windows) where k > 1
        ), marked as (
            select *, case when s <= lag(s) over (partition by doc_id order by s) + 100 then 0 else 1 end as fresh from later
        ), islands as (
            select doc_id, min(s) as a, max(s) + 100 as b
            from (select *, sum(fresh) over (partition by doc_id order by s) as island from marked) group by doc_id, island
        ), kept as (
            select doc_id, b as low, lead(a) over (partition by doc_id order by a) as high from islands
            union all select doc_id, 0, min(a) from islands group by doc_id
        ), rest as (
            select k.doc_id, string_agg(substring(h, 2 * low + 1, 2 * (coalesce(high, length(h) // 2) - low)), '' order by low) as r
            from kept k join coded using (doc_id) group by k.doc_id
        ), counts as (
            select doc_id, sum(b - a) as n_removed, count(*) as n_spans from islands group by doc_id
        )
        select doc_id, length(h) // 2 as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
            cast(coalesce(n_spans, 0) as bigint) as n_spans, sha256(unhex(coalesce(r, h))) as kept_sha256
        from coded left join counts using (doc_id) left join rest using (doc_id)""",
    "op10_near_duplicates": r"""
        with recursive worded as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
            from documents
        ), sets as (
            select doc_id, case when len(w) = 1 then w
                else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end as s
            from worded
        ), rows as (
            select doc_id, len(s) as n, unnest(s) as shingle from sets
        ), links as (
            select a.doc_id as u, b.doc_id as v
            from rows a join rows b on a.shingle = b.shingle and a.doc_id <> b.doc_id and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
            group by a.doc_id, b.doc_id, a.n, b.n
            having 100 * count(*) >= 80 * (a.n + b.n - count(*))
        ), reached(doc_id, other) as (
            select doc_id, doc_id from sets union select r.doc_id, l.v from reached r join links l on r.other = l.u
        )
        select doc_id, cast(len(any_value(s)) as bigint) as n_shingles, min(other) as component_id, min(other) = doc_id as kept
        from reached join sets using (doc_id) group by doc_id""",
    "op7_hamming": r"""
        with signs as (
            select vec_id, list_transform(embedding, lambda x: x > 0) as code from embeddings
        ), pairs as (
            select q.vec_id as query_id, v.vec_id as neighbor_id,
                cast(len(list_filter(list_zip(q.code, v.code), lambda p: p[1] <> p[2])) as integer) as distance
            from signs q cross join signs v where q.vec_id % 50 = 0
        )
        select query_id, cast(row_number() over (partition by query_id order by distance, neighbor_id) as integer) as rank,
            neighbor_id, distance
        from pairs qualify rank <= 10""",
    "op9_chat_formatting": r"""
        with messages as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all values (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
        ), escaped as (
            select *, length(replace(replace(replace(role, '\', '\\'), '|', '\|'), chr(10), '\n'))
                + length(replace(replace(text, '\', '\\'), '|', '\|')) as body
            from messages
        )
        select conv_id, count(*) as n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
            cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
            sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn nulls first, role, text), ''))
                as loss_sha256,
            cast(sum(length('<|role|>') + 1 + body + length('<|end|>') + 1) as bigint) as formatted_chars
        from escaped group by conv_id""",
    "op11_exact_duplicates": r"""
        with normalised as (
            select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
        ), digested as (
            select doc_id, sha256(t) as text_sha256 from normalised
        )
        select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size, doc_id = max(doc_id) over same as kept,
            text_sha256
        from digested window same as (partition by text_sha256)""",
    "op12_lexical_search": r"""
        with words as (
            select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from documents
        ), asked as (
            select distinct item_id, term
            from (select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark)
        ), held as (
            select doc_id, term, count(*) as tf from words group by doc_id, term
        ), lengths as (
            select doc_id, cast(sum(tf) as bigint) as n from held group by doc_id
        ), totals as (
            select count(*) as docs, cast(sum(n) as bigint) as l from lengths
        ), weights as (
            select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) as bigint) as w
            from (select term, count(*) as df from held group by term) cross join totals
        ), scores as (
            select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // l)))) as bigint) as score
            from asked join weights using (term) join held using (term) join lengths using (doc_id) cross join totals
            group by item_id, doc_id
        )
        select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score
        from scores where score > 0 qualify rank <= 50""",
}
