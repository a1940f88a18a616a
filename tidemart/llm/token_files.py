"""Token ids in length-delimited binary files with a separate offset index.

A data file is a row of records, each `length (8 bytes) | checksum of the length (4) | ids | checksum of the ids (4)`,
all little-endian; ids are unsigned 16-bit integers where the vocabulary fits, else 32-bit. A checksum is the CRC-32
of the bytes, rotated right by 15 bits and shifted by a constant (masked), so that data which itself holds
checksums stays safe. The index is a parquet table with file, offset, document, token count and width of each
record; with it records can be read in any order.

Files follow ascending document ids (null first; repeated ids by the hash of their text): Spark deals out the
documents by ranges of ids, and each task writes one file. A file has a name of its own for each attempt, and the
index, which Spark commits with the task, names only files that were finished, so a lost executor or a second
attempt leaves at most a file that nothing points to.

Edge cases: null or empty text is a record with the end id only; an empty table gives no records; other columns are
ignored.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from itertools import accumulate, chain, pairwise
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Bounded, begin, id_and_text, input_bytes, kept

MASK_DELTA = 0xA282EAD8
_HEAD = struct.Struct("<QI")
_TAIL = struct.Struct("<I")
FILE_BYTES = 64 << 20
KEPT_BYTES = 80 << 20
_LETTERS_AND_SIGNS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)[.,;:!?%*)]*")


def masked_checksum(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + _TAIL.pack(masked_checksum(length)) + payload + _TAIL.pack(masked_checksum(payload))


def unframed(stream, offset: int) -> bytes:
    """The payload of the record at an offset; a checksum that does not fit raises."""
    stream.seek(offset)
    head = stream.read(_HEAD.size)
    length, check = _HEAD.unpack(head)
    if masked_checksum(head[:8]) != check:
        raise ValueError(f"damaged length at {offset}")
    payload = stream.read(length)
    if masked_checksum(payload) != _TAIL.unpack(stream.read(_TAIL.size))[0]:
        raise ValueError(f"damaged record at {offset}")
    return payload


class WordEncoder:
    """Ids of texts by a tokenizer that drops white space and never looks across it.

    Each word (between blanks and line feeds) is encoded by the tokenizer once and kept, up to `limit` bytes;
    later ones are encoded each time. Other tokenizers encode whole texts: `words=False`.
    """

    def __init__(self, path: str, words: bool = True, limit: int = KEPT_BYTES):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core already
        self.tokenizer = Tokenizer.from_file(path)
        self.words, vocabulary = words, self.tokenizer.get_vocab()
        self.dtype = np.dtype("<u2" if len(vocabulary) <= 1 << 16 else "<u4")
        self.known = Bounded(limit)
        # Ids that close a run of letters or of signs, where the vocabulary marks them and the tokenizer splits words so.
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.closing = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        if suffix:
            self.closing[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.closes = [int(self.closing[self._ids(word)].sum()) for word in ("a", "é.", "Ab,;", "b!%)")] == [1, 2, 2, 2]

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)

    def _packed_words(self, words: list[str]) -> dict[str, bytes]:
        found = self._packed_by_closing(words) if self.closes else {}
        return {**found, **self._packed_by_place([w for w in words if w not in found])}

    def _packed_by_closing(self, words: list[str]) -> dict[str, bytes]:
        """The words of letters with or without signs behind them, cut behind the ids that close a run; none if that does not fit."""
        shapes = list(map(_LETTERS_AND_SIGNS.fullmatch, words))
        words = [w for w, shape in zip(words, shapes) if shape]
        runs = np.array([2 if shape.end(1) < shape.end() else 1 for shape in shapes if shape], np.int64)
        ids = self._ids(" ".join(words))
        ends = np.flatnonzero(self.closing[ids]) + 1
        if not words or len(ends) != runs.sum() or ends[-1] != len(ids):
            return {}
        return self._cut(words, ids, [0, *ends[np.cumsum(runs) - 1].tolist()])

    def _packed_by_place(self, words: list[str]) -> dict[str, bytes]:
        """Any words in one call of the tokenizer; the place of a token says whose it is."""
        if not words:
            return {}
        found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        ids = np.array(found.ids, self.dtype)
        begins = np.cumsum([0] + [len(w) + 1 for w in words])
        places = np.fromiter(map(itemgetter(0), found.offsets), np.int64, len(ids))
        return self._cut(words, ids, np.searchsorted(places, begins).tolist())

    def _cut(self, words: list[str], ids: np.ndarray, cuts: list[int]) -> dict[str, bytes]:
        raw, width = ids.tobytes(), self.dtype.itemsize
        return {w: raw[a * width : b * width] for w, (a, b) in zip(words, pairwise(cuts))}

    def _packed(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.words:
            return self._packed(texts)
        split = [text.replace("\n", " ").split(" ") for text in texts]
        words = list(chain.from_iterable(split))
        found = list(map(self.known.get, words))
        if None in found:
            fresh = self._packed_words(list({w for w, ids in zip(words, found) if ids is None}))
            for word, ids in fresh.items():
                self.known.keep(word, ids)
            found = [fresh[w] if ids is None else ids for w, ids in zip(words, found)]
        ends = accumulate(map(len, split))
        return [b"".join(found[end - len(part) : end]) for part, end in zip(split, ends)]


def word_encoder(path: str, words: bool) -> WordEncoder:
    """Kept by the Python worker from task to task, with the words it knows."""
    return kept(__name__, (path, words), lambda: WordEncoder(path, words))


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = None, words: bool = True, file_bytes: int = FILE_BYTES
) -> str:
    """Encode all texts and write data files and the index below `folder` (a path or address all executors share)."""
    spark = docs.sparkSession
    n_files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes(docs) // file_bytes))
    ordered = (
        id_and_text(docs)
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(n_files, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    data = f"{folder.rstrip('/')}/data"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer, words)
        end = b"" if end_id is None else np.array([end_id], encoder.dtype).tobytes()
        number, name = TaskContext.get().partitionId(), f"{uuid.uuid4().hex}.rec"
        stream, offset, start = None, 0, 0
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                if stream is None:
                    system, root = shared_folder(data)
                    system.create_dir(root, recursive=True)
                    stream = system.open_output_stream(f"{root}/{name}")
                offsets, starts, counts = [], [], []
                for payload in encoder.encode(part.column("text").to_pylist()):
                    record = framed(payload + end)
                    stream.write(record)
                    offsets.append(offset)
                    starts.append(start)
                    counts.append((len(payload) + len(end)) // encoder.dtype.itemsize)
                    offset += len(record)
                    start += counts[-1]
                n = part.num_rows
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"), "file_no": pa.array([number] * n, pa.int32()),
                        "file": pa.array([name] * n), "offset": pa.array(offsets, pa.int64()),
                        "start_in_file": pa.array(starts, pa.int64()), "n_tokens": pa.array(counts, pa.int64()),
                        "width": pa.array([encoder.dtype.itemsize] * n, pa.int32()),
                    }
                )
        if stream is not None:
            stream.close()

    schema = "doc_id long, file_no int, file string, offset long, start_in_file long, n_tokens long, width int"
    ordered.mapInArrow(write, schema).write.mode("overwrite").parquet(f"{folder}/index")
    return folder


def shared_folder(address: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder; an address without a scheme is a local path."""
    return fs.FileSystem.from_uri(address if "://" in address or address.startswith("file:") else f"file://{os.path.abspath(address)}")


def index_of(spark: SparkSession, folder: str) -> DataFrame:
    """The offset index with `start`, the number of ids before each record in all files together."""
    index = spark.read.parquet(f"{folder}/index")
    # One row for each file, so the running total over them is small and so is its broadcast.
    totals = index.groupBy("file_no").agg(F.sum("n_tokens").alias("total"))
    before = F.coalesce(F.sum("total").over(Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = totals.select("file_no", before.alias("before"))
    return index.join(F.broadcast(files), "file_no").withColumn("start", F.col("before") + F.col("start_in_file"))


def read_records(
    index: DataFrame, folder: str, work: Callable[[np.ndarray], dict], fields: str
) -> DataFrame:
    """`doc_id`, `start` and what `work` makes of the ids of each indexed record (`fields`: its schema)."""
    data = f"{folder.rstrip('/')}/data"
    wanted = index.select("doc_id", "start", "file", "offset", "width")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(__name__)
        system, root = shared_folder(data)
        name, stream = None, None
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                rows = []
                for r in part.select(["file", "offset", "width"]).to_pylist():
                    if r["file"] != name:
                        name, stream = r["file"], system.open_input_file(f"{root}/{r['file']}")
                    rows.append(work(np.frombuffer(unframed(stream, r["offset"]), f"<u{r['width']}")))
                made = pa.RecordBatch.from_pylist(rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("start"), *made.columns], names=["doc_id", "start", *made.schema.names]
                )

    return wanted.mapInArrow(read, f"doc_id long, start long, {fields}")


def read_sequences(spark: SparkSession, folder: str) -> DataFrame:
    """`doc_id`, `start` and `ids` of every record."""
    return read_records(index_of(spark, folder), folder, lambda ids: {"ids": ids.astype(np.int32)}, "ids array<int>")


def sequence_digests(spark: SparkSession, folder: str) -> DataFrame:
    """`doc_id`, `start`, `n_tokens` and `ids_crc32` of every record, read from the files."""

    def digest(ids: np.ndarray) -> dict:
        return {"n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())}

    return read_records(index_of(spark, folder), folder, digest, "n_tokens long, ids_crc32 long")
