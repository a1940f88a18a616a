"""The corpus pipeline: raw documents to pieces of training text.

Each stage takes (spark, docs, sf_dir) and works on all rows of docs, which the stage before has written as Parquet;
all but the last return the columns of `documents`.

| stage | takes effect as |
|---|---|
| quality | documents that the line field rejects go |
| near_duplicates | of documents linked by five-word shingles (similarity 0.8 or more) the smallest id stays |
| decontamination | documents that align with a benchmark item go |
| personal_data | spans of personal data become their kind in angle brackets; `n_chars` follows |
| pieces | texts become piece ids, with what they decode to |

Rows without an id take part in every stage and are kept by the three filters, except that quality judges their text.
Rows that repeat an id and text pass as they are; near_duplicates keeps them or drops them together. Empty tables give
empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import decontamination, near_duplicates, pieces, quality
from tidemart.llm import personal_data as private
from tidemart.llm.common import read_table
from tidemart.llm.queries import vocabulary
from tidemart.session import scratch_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field, learned from the labels of this stage's documents, accepts."""
    field = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.accepted(docs.select(*COLUMNS), field)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    found = near_duplicates.near_duplicates(docs, size=5)
    dropped = found.where("not kept").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(dropped, "doc_id", "left_anti").select(*COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that align with no benchmark item."""
    return decontamination.uncontaminated(docs.select(*COLUMNS), read_table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with their personal data masked."""
    return private.mask_texts(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id`, `ids` and the decoded `text`."""
    return pieces.encode_texts(docs, vocabulary("piece_bpe_32k.model"))


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("pieces", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each is written to the shared scratch folder and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = scratch_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
