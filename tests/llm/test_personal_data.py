import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tidemart.llm import personal_data as pd_
from tidemart.llm.queries import op6_personal_data

AUTOMATON = pd_.anchors()
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    """The four base kinds by the patterns as they are written."""

    def valid(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        if kind == "card":
            doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            return 16 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0
        return kind == "email" or 8 <= len(digits) <= 15

    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if valid(k, m[0])]


def base(text):
    return [s for s in pd_.spans_of(text, AUTOMATON) if s[0] in pd_.BASE_KINDS]


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="0129.@+- ()aZé%|\n", max_size=60))
def test_base_kinds_equal_the_patterns(text):
    assert base(text) == plain(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    ["4111111111111111", "4111 1111-1111 1111", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "a.b@c.de.", "x@y@z.com", "@", "+",
     "+1 (017) 555-7713", "+12", "é", " ", ".", "-", "00000000001.0.0.255", "a@b.c@d.e"]), max_size=8).map("".join))
def test_base_kinds_equal_the_patterns_on_typical_pieces(text):
    assert base(text) == plain(text)


def kinds(text):
    return [(k, text[s:e]) for k, s, e in pd_.spans_of(text, AUTOMATON)]


def test_cues_and_schemes():
    assert kinds('TOKEN = "24be64439e3e49cf46b2d7c90f3602a3"') == [("secret", "24be64439e3e49cf46b2d7c90f3602a3")]
    assert kinds("a token of thanks, password: short") == []
    assert kinds("IBAN: GB82 WEST 1234 5698 7654 32 and IBAN GB82 WEST 1234 5698 7654 33") == [("account", "GB82 WEST 1234 5698 7654 32")]
    assert kinds("see https://bob:pw@host.org/x or https://host.org") == [("email", "pw@host.org"), ("url", "https://bob:pw@host.org")]


def test_masking_merges_overlaps():
    text = "to bob:pw at https://bob:pw@host.org/x, 1.2.3.4"
    assert pd_.masked(text, pd_.spans_of(text, AUTOMATON)) == "to bob:pw at <URL>/x, <IP>"


def test_awkward_rows(awkward, no_documents):
    found = pd_.personal_data_digest(awkward).collect()
    assert len(found) == 7
    none = hashlib.sha256(b"").hexdigest()
    assert {r.doc_id: (r.n_email, r.base_sha256 == none) for r in found} == {
        1: (0, True), 2: (0, True), 3: (0, True), None: (0, True), 4: (4000, False), 5: (0, True)}
    assert pd_.personal_data_digest(no_documents).count() == 0


def test_query_against_the_patterns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    expected = {}
    for d in docs:
        spans = plain(d.text or "")
        digest = hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
        expected[d.doc_id] = (*[sum(s[0] == k for s in spans) for k in PATTERNS], digest)
    found = op6_personal_data(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in found} == expected
    assert all(set(r.spans.split(",")) >= {f"{k}:{s}:{e}" for k, s, e in plain(d.text)}
               for r, d in zip(sorted(found), sorted(docs)) if r.doc_id == d.doc_id and plain(d.text))
