"""Personal data by anchor expansion.

One Aho-Corasick automaton finds the anchors (at-signs, plus signs, digits, scheme marks and identifier cues) in
one pass over a text. At each anchor a local parser, whose result depends only on the characters around it,
expands to the boundaries and validates what it found. Kinds:

=========  ====================================================================================
email      local part, at-sign, host name with a dot
ip         four numbers of at most 255
card       16 to 19 digits, single blanks or hyphens between them, Luhn check digit
phone      a plus sign and 8 to 15 digits
account    an account number (country code, check digits, groups) after its cue, remainder 1 modulo 97
secret     the value after `token =`, `password:` and the like, 16 characters at least
url        an address with a user and password before its host
=========  ====================================================================================

Within one kind matches are leftmost and do not overlap; an invalid match is dropped and not retried shorter.
Offsets are code points, the end exclusive.

Edge cases: null or empty text gives no spans; a null id is kept; repeated rows give a row each; other columns
are ignored; an empty table gives an empty result. Work and memory per text are linear in its length.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import change_texts, id_and_text, map_batches

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "account", "secret", "url")
SECRET_CUES = ("token", "secret", "password", "passwd", "api_key", "apikey", "api-key")

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_VALUE = re.compile(r"""[ \t]*[=:][ \t]*["']?([A-Za-z0-9_/+.-]{16,})""")
_ACCOUNT = re.compile(r"[ \t]*:?[ \t]*([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
_USER_HOST = re.compile(r"[^\s/@:]+:[^\s/@]+@[^\s/@]+")
_SCHEME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+.-")
_LUHN_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)

Span = tuple[str, int, int]


def luhn_valid(digits: str) -> bool:
    plain = sum(map(int, digits[-1::-2]))
    return (plain + sum(_LUHN_DOUBLED[int(d)] for d in digits[-2::-2])) % 10 == 0


def account_valid(number: str) -> bool:
    plain = number.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


@lru_cache(maxsize=1)
def anchors() -> ahocorasick.Automaton:
    """The automaton, built once for each Python worker; the value of an anchor is the parser it calls and the length of the anchor."""
    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    found.add_word("://", ("scheme", 3))
    for name, cues in (("secret", SECRET_CUES), ("account", ("iban",))):
        for cue in cues:
            for form in {cue, cue.upper(), cue.capitalize()}:
                found.add_word(form, (name, len(form)))
    found.make_automaton()
    return found


def _back(text: str, at: int, floor: int, allowed: frozenset[str]) -> int:
    while at > floor and text[at - 1] in allowed:
        at -= 1
    return at


def spans_of(text: str, automaton: ahocorasick.Automaton) -> list[Span]:
    """All spans of one text, by kind as listed in `KINDS`, then by start."""
    found: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    after = dict.fromkeys(KINDS, 0)  # where the last match of a kind, valid or not, has ended

    def keep(kind: str, start: int, end: int, valid: bool) -> None:
        after[kind] = end
        if valid:
            found[kind].append((kind, start, end))

    for last, (parser, length) in automaton.iter(text):
        begin, behind = last - length + 1, last + 1
        if parser == "digit":
            if begin >= after["ip"]:
                chain = _NUMBERS.match(text, begin)
                after["ip"] = chain.end()
                parts, start = chain[0].split("."), begin
                for i in range(0, len(parts) - 3, 4):
                    four = parts[i : i + 4]
                    end = start + sum(map(len, four)) + 3
                    if all(len(p.lstrip("0")) < 4 and int(p[-3:]) < 256 for p in four):
                        found["ip"].append(("ip", start, end))
                    start = end + 1
            if begin >= after["card"]:
                if chain := _DIGITS.match(text, begin):
                    digits = chain[0].replace(" ", "").replace("-", "")
                    keep("card", begin, chain.end(), 16 <= len(digits) <= 19 and luhn_valid(digits))
                else:
                    after["card"] = behind
        elif parser == "at":
            start = _back(text, begin, after["email"], _LOCAL)
            if start < begin and (host := _HOST.match(text, behind)):
                keep("email", start, host.end(), True)
        elif parser == "plus":
            if begin >= after["phone"] and (number := _PHONE.match(text, begin)):
                keep("phone", begin, number.end(), 8 <= sum(c.isdigit() for c in number[0]) <= 15)
        elif parser == "scheme":
            start = _back(text, begin, after["url"], _SCHEME)
            if start < begin and (rest := _USER_HOST.match(text, behind)):
                keep("url", start, rest.end(), True)
        elif parser == "secret":
            if begin >= after["secret"] and (value := _VALUE.match(text, behind)):
                keep("secret", value.start(1), value.end(1), True)
        elif begin >= after["account"] and (number := _ACCOUNT.match(text, behind)):
            keep("account", number.start(1), number.end(1), account_valid(number[1]))
    return [span for kind in KINDS for span in found[kind]]


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in angle brackets; overlapping spans take the first one's."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += (text[at:start], f"<{kind.upper()}>")
        at = max(at, end)
    return "".join([*out, text[at:]])


def find_personal_data(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """`doc_id` and `spans` (kind, start, end); with_text adds the masked text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        spans = [spans_of(text, anchors()) for text in texts]
        columns = {
            "doc_id": batch.column("doc_id"),
            "spans": pa.array(
                [[{"kind": k, "start": s, "end": e} for k, s, e in row] for row in spans],
                pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])),
            ),
        }
        if with_text:
            columns["text"] = pa.array(map(masked, texts, spans), pa.string())
        return pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, spans array<struct<kind:string,start:long,end:long>>" + ", text string" * with_text
    return map_batches(id_and_text(docs), work, schema)


def mask_texts(docs: DataFrame) -> DataFrame:
    """The rows, with all their columns, and their texts masked."""
    return change_texts(docs, lambda texts: [masked(t, spans_of(t, anchors())) for t in texts])


def personal_data_digest(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans as text."""
    written = "transform({}, s -> concat_ws(':', s.kind, s.start, s.end))"
    base = f"filter(spans, s -> s.kind in {BASE_KINDS})"
    return find_personal_data(docs).select(
        "doc_id",
        *[F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in BASE_KINDS],
        F.expr(f"sha2(array_join({written.format(base)}, ','), 256)").alias("base_sha256"),
        F.expr(f"array_join({written.format('spans')}, ',')").alias("spans"),
    )
