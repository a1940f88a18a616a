"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three machines are compiled from a model's vocabulary: the normaliser (blanks become the mark U+2581, one is put
before the text), the pieces (a trie whose closing arcs emit a piece) and the byte fallback (a character without a
piece emits its UTF-8 bytes). Composed with an input they form a lattice of positions; its shortest path in the
tropical semiring (min, +) is the encoding.

Arc weights. In a model of unigram kind the weight is the negated score. In a model of byte-pair kind scores are
the ranks of merges, and the cheapest sum of them is not what merging gives. There the state of the pieces' machine
also holds the last piece, and an arc exists only between pieces that merging keeps apart when it sees just the two;
merging gives the one segmentation whose neighbours are all of that sort, so one path is left and every arc weighs 1.

Only models without a character map (identity normalisation) are compiled; others raise.

The input is cut where no path can cross: before a run of marks, and between two characters that no piece holds
side by side. One regular expression makes most of these cuts: characters side by side in some piece, directly or by way
of others, are an alphabet, and a chunk is a run of one alphabet with the marks before it. A word and the punctuation
behind it are two chunks, so fewer different ones are met. Their paths are kept in dictionaries of at most `KEPT_BYTES`
(and a fifth of that), so frequent words are composed once for each task; between tasks a Python worker keeps only the machines.

Edge cases: null or empty text has no ids and decodes to the empty text; repeated rows give a row each; other columns
are ignored; an empty table gives an empty result. Work is linear in the text's length.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import defaultdict
from collections.abc import Callable
from hashlib import sha256
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Bounded, id_and_text, kept, map_batches

MARK = "▁"
KEPT_BYTES = 40 << 20
KEPT_PAIRS = 100_000
ALPHABETS = 8  # so many have a run of their own, all other characters share one
SHORT = 32  # characters of a chunk that is not cut further


class Chunks(Bounded):
    """Packed ids by chunk, with blanks for its marks (a string of Latin letters is half as long then)."""

    def __init__(self, encode: Callable[[str], bytes], limit: int):
        super().__init__(limit)
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes:
        found = self.encode(chunk.replace(" ", MARK))
        self.keep(chunk, found)
        return found


class Transducer:
    def __init__(self, path: str, limit: int = KEPT_BYTES):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules = model.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models with identity normalisation and escaped blanks are supported")
        self.prefix = rules.add_dummy_prefix
        self.merging = model.trainer_spec.model_type == model.trainer_spec.BPE
        kinds = model.SentencePiece
        self.pieces = {p.piece: i for i, p in enumerate(model.pieces) if p.type in (kinds.NORMAL, kinds.USER_DEFINED)}
        self.scores = {p.piece: p.score for p in model.pieces if p.piece in self.pieces}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN)
        self.fallback_weight = 10 - min(self.scores.values(), default=0)
        self.width = np.dtype("<u2" if len(model.pieces) <= 1 << 16 else "<u4")
        self.emitted = [b""] * len(model.pieces)  # what decoding makes of an id
        for piece, i in self.pieces.items():
            self.emitted[i] = piece.replace(MARK, " ").encode()
        for value, i in self.bytes.items():
            self.emitted[i] = bytes([value])
        self.emitted[self.unknown] = " ⁇ ".encode()
        self.beside = {pair for piece in self.pieces for pair in pairwise(piece)}
        self.steps = {piece: self._steps(piece) for piece in self.pieces} if self.merging else {}
        self.trie = self._trie()
        self.longest = max(map(len, self.pieces), default=0)
        self.apart: dict[tuple[str, str], bool] = {}
        self.runs = self._runs()
        self.spaced = Chunks(self.packed, limit)  # runs of one alphabet with the marks before them
        self.inner = Chunks(self.shortest_path, limit // 5)  # parts of long ones

    def _runs(self) -> re.Pattern:
        """Cuts a text with blanks for marks into runs of one alphabet, each with the blanks before it."""
        names: dict[str, str] = {}

        def name(c: str) -> str:
            while names.setdefault(c, c) != c:
                c = names[c]
            return c

        for a, b in self.beside:
            if MARK not in (a, b):
                names[name(a)] = name(b)
        alphabets = defaultdict(list)
        for c in sorted(names):
            alphabets[name(c)].append(re.escape(c))
        classes = ["".join(a) for a in sorted(alphabets.values(), key=len, reverse=True)[:ALPHABETS]]
        runs = [*(f"[{c}]+" for c in classes), f"[^ {''.join(classes)}]+"]
        return re.compile(f" *(?:{'|'.join(runs)})| +")

    def _trie(self) -> dict:
        """Pieces by their characters; those that merging itself never makes have no arc.

        Every node holds the arcs of all pieces on the way to it, longest first: characters, piece, weight, packed ids.
        """
        root: dict = {}
        for piece, i in self.pieces.items():
            if not self.merging or self.steps[piece] is not None:
                node = root
                for c in piece:
                    node = node.setdefault(c, {})
                node[""] = ((len(piece), piece, 1.0 if self.merging else -self.scores[piece], self._pack([i])),)
        root[""] = ()
        nodes = [(c, node, ()) for c, node in root.items() if c]
        while nodes:
            c, node, before = nodes.pop()
            if not before and c not in self.pieces:
                before = (self._fallback(c),)
            found = node[""] = node.get("", ()) + before
            nodes += [(c, below, found) for c, below in node.items() if c]
        return root

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.width).tobytes()

    def _fallback(self, c: str) -> tuple[int, str, float, bytes]:
        """The arc of a character without a piece."""
        return 1, c, self.fallback_weight, self._pack([self.bytes[b] for b in c.encode()] if self.bytes else [self.unknown])

    def _steps(self, piece: str) -> list[tuple[float, str, str]] | None:
        """Merges that build a piece, in order: score, then first and last part afterwards; None if they do not."""
        scores, parts, steps = self.scores, list(piece), [(0.0, piece[0], piece[-1])]
        while len(parts) > 1:
            found = [scores.get(a + b) for a, b in pairwise(parts)]
            best = max((s for s in found if s is not None), default=None)
            if best is None:
                return None
            at = found.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            steps.append((best, sys.intern(parts[0]), sys.intern(parts[-1])))
        return steps

    def _follows(self, left: str, right: str) -> bool:
        """Whether the machine of pieces has an arc from the state `left` for `right`."""
        if not left:
            return True
        known = self.apart.get((left, right))
        if known is None:
            if len(self.apart) >= KEPT_PAIRS:
                self.apart.clear()
            known = self.apart[left, right] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: str, right: str) -> bool:
        """Whether merging the two texts side by side leaves them apart.

        Both sides merge as if alone while their own best pair goes before the pair across the border.
        """
        if (left[-1], right[0]) not in self.beside or left not in self.steps or right not in self.steps:
            return True
        a, b, i, j, scores = self.steps[left], self.steps[right], 0, 0, self.scores
        while True:
            across = scores.get(a[i][2] + b[j][1])
            next_a = a[i + 1][0] if i + 1 < len(a) else None
            next_b = b[j + 1][0] if j + 1 < len(b) else None
            if across is not None and (next_a is None or across > next_a) and (next_b is None or across >= next_b):
                return False
            if next_a is not None and (next_b is None or next_a >= next_b):
                i += 1
            elif next_b is not None:
                j += 1
            else:
                return True

    def _arcs(self, chunk: str, i: int) -> tuple[tuple[int, str, float, bytes], ...]:
        """Arcs of the lattice that leave a position, longest first: characters, piece, weight and packed ids."""
        node = self.trie
        for c in chunk[i : i + self.longest]:
            below = node.get(c)
            if below is None:
                break
            node = below
        return node[""] or (self._fallback(chunk[i]),)

    def shortest_path(self, chunk: str) -> bytes:
        """Packed ids on the cheapest path of the lattice of one chunk (already normalised)."""
        return self._only_path(chunk) if self.merging else self._cheapest_path(chunk)

    def _only_path(self, chunk: str) -> bytes:
        """The path through the states (position, last piece) of a model of byte-pair kind.

        One path reaches the end, so the first that does is the shortest: states are tried depth first, long pieces
        before short ones, and a state that led nowhere is not tried again.
        """
        length, apart, arcs_of = len(chunk), self.apart, self._arcs
        path, i, last, dead, arcs = [], 0, "", set(), iter(arcs_of(chunk, 0))
        while True:
            for size, piece, _, ids in arcs:
                known = apart.get((last, piece)) if last else True
                if (self._follows(last, piece) if known is None else known) and (not dead or (i + size, piece) not in dead):
                    break
            else:
                dead.add((i, last))
                ids, i, last, arcs = path.pop()
                continue
            path.append((ids, i, last, arcs))
            i += size
            if i == length:
                return b"".join([step[0] for step in path])
            last, arcs = piece, iter(arcs_of(chunk, i))

    def _cheapest_path(self, chunk: str) -> bytes:
        """The path of least weight in a model of unigram kind, position by position."""
        best: list[tuple | None] = [(0.0, 0, b"")] + [None] * len(chunk)
        for i in range(len(chunk)):
            if best[i] is not None:
                for size, _, weight, ids in self._arcs(chunk, i):
                    cost = best[i][0] + weight
                    if best[i + size] is None or cost < best[i + size][0]:
                        best[i + size] = (cost, i, ids)
        i, arcs = len(chunk), []
        while i:
            _, i, ids = best[i]
            arcs.append(ids)
        return b"".join(reversed(arcs))

    def packed(self, chunk: str) -> bytes:
        """Packed ids of one chunk; a long one is cut further where no piece can cross."""
        cuts = [i for i, pair in enumerate(pairwise(chunk), 1) if pair not in self.beside] if len(chunk) > SHORT else []
        if not cuts:
            return self.shortest_path(chunk)
        known = self.inner
        return b"".join([known[chunk[a:b].replace(MARK, " ")] for a, b in pairwise([0, *cuts, len(chunk)])])

    def encode(self, text: str) -> bytes:
        """Packed ids of a text."""
        if not text:
            return b""
        return b"".join(map(self.spaced.__getitem__, self.runs.findall(" " * self.prefix + text.replace(MARK, " "))))

    def forget(self) -> None:
        """Drop all that was learned from texts; the machines stay."""
        self.inner.forget()
        self.spaced.forget()
        self.apart.clear()

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.emitted.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def compiled(model: str) -> Transducer:
    """The transducer of a model, kept by the Python worker from task to task."""
    return kept(__name__, model, lambda: Transducer(model))


def encode_texts(docs: DataFrame, model: str, digest: bool = False) -> DataFrame:
    """`doc_id`, `ids` and the decoded `text` of every document.

    With `digest` the counts and checksums of both instead: `n_pieces`, `n_bytes` (byte pieces), `ids_crc32` (of the
    ids as little-endian unsigned 32-bit integers), `decoded_sha256` and `lossless`.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        machine = compiled(model)
        is_byte = np.zeros(len(machine.emitted), bool)
        is_byte[list(machine.bytes.values())] = True
        rows = []
        for text in batch.column("text").to_pylist():
            ids = np.frombuffer(machine.encode(text), machine.width)
            back = machine.decode(ids)
            if digest:
                rows.append(
                    {
                        "n_pieces": len(ids), "n_bytes": int(is_byte[ids].sum()),
                        "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes()),
                        "decoded_sha256": sha256(back.encode()).hexdigest(), "lossless": back == text,
                    }
                )
            else:
                rows.append({"ids": ids.astype(np.int32), "text": back})
        made = pa.RecordBatch.from_pylist(rows)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *made.columns], names=["doc_id", *made.schema.names])

    if digest:
        fields = "n_pieces long, n_bytes long, ids_crc32 long, decoded_sha256 string, lossless boolean"
    else:
        fields = "ids array<int>, text string"
    return map_batches(id_and_text(docs), work, f"doc_id long, {fields}")
