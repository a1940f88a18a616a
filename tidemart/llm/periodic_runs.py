"""Periodic runs of words by block convolution at dyadic scales, and texts without their repetitions.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that no neighbouring word
extends, at least `EXPONENT` periods and `LEAST` words long.

For each block length B = 1, 2, 4, ... the words are cut into blocks of B, and each block is compared with all B windows
that begin B to 2B - 1 words behind it. The squared differences of word numbers, summed over a window, are
sum(P^2) + sum(T^2) - 2 sum(P T); the last part comes from number-theoretic transforms of size 2B, exact integers modulo
a prime. A window is an occurrence of the block where the sum is 0 modulo two primes, whose product is above any sum of
texts of up to two million words (in longer ones a false occurrence is possible and found out by the next step). A run of
period q from B to 2B - 1 has a whole block in all but its last period, and that block occurs again q words later; so
every run gives a seed (block, distance). A seed is extended word by word over its document; what is long enough is a run,
of the smallest of the distances that give the same stretch.

Two exact rules spare transforms. A word of a run occurs again within q words, so only blocks in a stretch of 3B words
that all occur again within 2B - 1 words are transformed; ordinary prose has next to none. And a block whose three block
lengths lie in a run that a smaller scale has found meets itself at multiples of that run's period only.

Documents of an Arrow batch are worked on together, a number of its own between two of them, so no run crosses documents.
Nothing is shuffled; memory is bounded by `TOGETHER` words or by one longer text, and time grows with n log^2 n for it.

Words are runs of anything but ASCII white space. Edge cases: null or empty text, or one without words, has no runs and
collapses to the empty text; repeated rows give a row each; null ids are kept; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_and_text, map_batches

EXPONENT = 4
LEAST = 6
TOGETHER = 200_000
TRANSFORMED = 1 << 19
# Primes k 2^m + 1 below 2^31 with a generator of their numbers.
PRIMES = ((2013265921, 31), (1811939329, 13))
Run = tuple[int, int, int]
Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


@lru_cache(maxsize=64)
def _roots(size: int, prime: int, generator: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a root of unity and of its inverse, half a circle of each."""
    found = []
    for root in (pow(generator, (prime - 1) // size, prime), pow(generator, prime - 1 - (prime - 1) // size, prime)):
        powers = np.ones(max(1, size // 2), np.uint64)
        filled, step = 1, root
        while filled < len(powers):  # doubles what is there
            powers[filled : 2 * filled] = powers[:filled] * np.uint64(step) % np.uint64(prime)
            filled, step = 2 * filled, step * step % prime
        found.append(powers)
    return found[0], found[1]


def _turned(powers: np.ndarray, stage: int) -> np.ndarray:
    """The factors of a stage: every power rounded down to a multiple of 2^stage."""
    return np.repeat(powers[:: 1 << stage], 1 << stage)[:, None] if stage else powers[:, None]


def transform(x: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Number-theoretic transform of each column; frequencies come in bit-reversed order."""
    p, size = np.uint64(prime), len(x)
    powers, half = _roots(size, prime, generator)[0], size // 2
    for stage in range(size.bit_length() - 1):
        low, high, out = x[:half], x[half:], np.empty_like(x)
        total = low + high
        out[0::2] = np.minimum(total, total - p)
        out[1::2] = (low + (p - high)) * _turned(powers, stage) % p
        x = out
    return x


def transform_back(x: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """From frequencies in bit-reversed order to each column."""
    p, size = np.uint64(prime), len(x)
    powers, half = _roots(size, prime, generator)[1], size // 2
    for stage in reversed(range(size.bit_length() - 1)):
        even, odd, out = x[0::2], x[1::2] * _turned(powers, stage) % p, np.empty_like(x)
        total, rest = even + odd, even + (p - odd)
        out[:half] = np.minimum(total, total - p)
        out[half:] = np.minimum(rest, rest - p)
        x = out
    return x * np.uint64(pow(size, prime - 2, prime)) % p


@lru_cache(maxsize=64)
def _mirrored(size: int) -> np.ndarray:
    """Where the opposite of each frequency stands, both in bit-reversed order."""
    bits = size.bit_length() - 1
    reverse = np.zeros(size, np.int64)
    for b in range(bits):
        reverse |= ((np.arange(size) >> b) & 1) << (bits - 1 - b)
    return reverse[-reverse % size]


def zero_mismatches(words: np.ndarray, blocks: np.ndarray, length: int, prime: int, generator: int) -> np.ndarray:
    """For each block number, whether the block occurs at distance length, ..., 2 length - 1 (columns), modulo a prime."""
    p = np.uint64(prime)
    needed = np.unique(np.concatenate([blocks, blocks + 1, blocks + 2]))
    values = np.zeros((2 * length, len(needed)), np.uint64)
    values[:length] = (words[needed[:, None] * length + np.arange(length)] % p).T
    squares = np.zeros((length + 1, len(needed)), np.uint64)
    np.cumsum(values[:length] * values[:length] % p, 0, out=squares[1:])
    spectrum = transform(values, prime, generator)
    at = [np.searchsorted(needed, blocks + i) for i in range(3)]
    # The window is the two blocks behind: a shift by half the size changes the sign of every odd frequency.
    behind = np.empty((2 * length, len(blocks)), np.uint64)
    first, second = spectrum[:, at[1]], spectrum[:, at[2]]
    behind[:length] = (first[:length] + second[:length]) % p
    behind[length:] = (first[length:] + (p - second[length:])) % p
    products = transform_back(spectrum[_mirrored(2 * length)][:, at[0]] * behind % p, prime, generator)[:length]
    own = squares[length, at[0]]
    window = squares[length, at[1]] - squares[:length, at[1]] + squares[:length, at[2]]
    return ((own + window) % p == 2 * products % p).T


def _occurrences(words: np.ndarray, blocks: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and distance of every occurrence of the blocks in the windows behind them."""
    starts, distances = [], []
    step = max(1, TRANSFORMED // (2 * length))
    for low in range(0, len(blocks), step):
        part = blocks[low : low + step]
        zero = zero_mismatches(words, part, length, *PRIMES[0])
        some = np.flatnonzero(zero.any(1))
        if len(some):
            rows, columns = np.nonzero(zero[some] & zero_mismatches(words, part[some], length, *PRIMES[1]))
            starts.append(part[some][rows] * length)
            distances.append(columns + length)
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(starts), np.concatenate(distances)


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every stretch of true flags."""
    edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    return edges[0::2], edges[1::2]


def _blocks_to_compare(again: np.ndarray, known_end: np.ndarray, length: int) -> np.ndarray:
    """Numbers of the blocks that may lie in a run of this scale (see the module's two rules)."""
    begins, ends = _stretches(again < 2 * length)
    keep = ends - begins >= max(LEAST - 1 if length == 1 else 0, (EXPONENT - 1) * length)
    firsts, lasts = -(-begins[keep] // length), ends[keep] // length
    counts = np.maximum(lasts - firsts, 0)
    blocks = np.repeat(firsts, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return blocks[known_end[blocks * length] < (blocks + 3) * length]


def find_runs(words: np.ndarray, borders: np.ndarray) -> dict[tuple[int, int], int]:
    """Period by (first word, length) of all runs; document i holds words[borders[i] : borders[i + 1] - 1], a number of its own behind it."""
    order = np.argsort(words, kind="stable")
    again = np.full(len(words), len(words) + 1)
    same = words[order[1:]] == words[order[:-1]]
    again[order[:-1][same]] = np.diff(order)[same]
    known_end = np.zeros(len(words), np.int64)
    runs: dict[tuple[int, int], int] = {}
    longest, length = int(np.diff(borders).max(initial=1)) - 1, 1
    while EXPONENT * length <= longest and LEAST <= longest:
        blocks = _blocks_to_compare(again, known_end, length)
        if len(blocks):
            padded = np.concatenate([words, np.zeros(4 * length, words.dtype)])
            starts, distances = _occurrences(padded, blocks, length)
            documents, ends = np.searchsorted(borders, starts, "right") - 1, starts + length + distances
            # What ends in the same document, and not inside a run that is known.
            fresh = (ends < borders[documents + 1]) & (ends > known_end[starts])
            for distance, document in sorted(set(zip(distances[fresh].tolist(), documents[fresh].tolist()))):
                low, high = borders[document], borders[document + 1] - 1
                if high - low >= max(LEAST, EXPONENT * distance):
                    begins, ends = _stretches(words[low : high - distance] == words[low + distance : high])
                    for begin, end in zip((begins + low).tolist(), (ends + low + distance).tolist()):
                        if end - begin >= max(LEAST, EXPONENT * distance):
                            runs.setdefault((begin, end - begin), distance)
                            np.maximum(known_end[begin:end], end, out=known_end[begin:end])
        length *= 2
    return runs


def runs_of(documents: list[list[bytes]]) -> list[list[Run]]:
    """(start, length, period) of the runs of each document's words, by start and period."""
    distinct = set().union(*documents)
    numbers = dict(zip(distinct, range(len(distinct))))
    words = np.empty(sum(map(len, documents)) + len(documents), np.int64)
    borders = np.zeros(len(documents) + 1, np.int64)
    at = 0
    for i, document in enumerate(documents):
        words[at : at + len(document)] = list(map(numbers.__getitem__, document))
        at += len(document) + 1
        words[at - 1] = -1 - i
        borders[i + 1] = at
    words[words < 0] = len(numbers) - 1 - words[words < 0]
    found: list[list[Run]] = [[] for _ in documents]
    for (begin, length), period in find_runs(words.astype(np.uint64), borders).items():
        i = int(np.searchsorted(borders, begin, "right")) - 1
        found[i].append((begin - int(borders[i]), length, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without those that a run repeats (all of it after its first period), joined by blanks."""
    if runs:
        keep = np.ones(len(words), bool)
        for start, length, period in runs:
            keep[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(keep).tolist()]
    return b" ".join(words)


def _digest(words: list[bytes], runs: list[Run]) -> dict:
    start, length, period = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    return {
        "n_runs": len(runs), "start": start, "length": length, "period": period,
        "exponent_milli": None if start is None else 1000 * length // period,
        "runs_sha256": sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
        "collapsed_sha256": sha256(collapsed(words, runs)).hexdigest(),
    }


def _whole(words: list[bytes], runs: list[Run]) -> dict:
    return {"runs": [{"start": s, "length": n, "period": q} for s, n, q in runs], "text": collapsed(words, runs).decode()}


def periodic_runs(docs: DataFrame, rewrite: Rewrite | None = None, digest: bool = False) -> DataFrame:
    """`doc_id`, `runs` (start, length and period in words) and the collapsed `text` of every document.

    `rewrite` may change the words of a document before. With `digest`: `n_runs`, the longest run (`start`, `length`,
    `period`, `exponent_milli`) and checksums of all runs and of the collapsed text instead.
    """
    numbers = pa.int64()
    if digest:
        fields = [(c, numbers) for c in ("n_runs", "start", "length", "period", "exponent_milli")]
        fields += [("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]
        columns = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    else:
        run = pa.struct([("start", numbers), ("length", numbers), ("period", numbers)])
        fields, columns = [("runs", pa.list_(run)), ("text", pa.string())], "runs array<struct<start long, length long, period long>>, text string"
    schema, made = pa.schema(fields), _digest if digest else _whole

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, rows, together, held = batch.column("doc_id").to_pylist(), [], [], 0
        for i, text in zip(ids, batch.column("text").cast(pa.binary())):
            words = text.as_py().split()  # at ASCII white space, as these are bytes
            together.append(rewrite(i, words) if rewrite else words)
            held += len(words)
            if held >= TOGETHER or len(rows) + len(together) == len(ids):
                rows += map(made, together, runs_of(together))
                together, held = [], 0
        found = pa.RecordBatch.from_pylist(rows, schema)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *found.columns], names=["doc_id", *schema.names])

    return map_batches(id_and_text(docs), work, f"doc_id long, {columns}")
