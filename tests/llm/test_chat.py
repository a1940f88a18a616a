import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemart.llm import chat

part = st.one_of(
    st.fixed_dictionaries({"type": st.just("text"), "text": st.text(alphabet="<|>\\n\nae:rolnd", max_size=12)}),
    st.fixed_dictionaries({"type": st.sampled_from(["image", "audio", "document"]), "ref": st.text(max_size=3), "units": st.integers(1, 3)}),
)
turn = st.fixed_dictionaries({"role": st.text(alphabet="<|>\\n\nau", max_size=6), "parts": st.lists(part, max_size=4)})


def joined(parts):
    """Neighbouring texts as one, empty ones gone, attachments by reference and tokens."""
    out = []
    for p in parts:
        if p["type"] == "text":
            if out and isinstance(out[-1], str):
                out[-1] += p["text"]
            elif p["text"]:
                out.append(p["text"])
        else:
            tokens = p["tokens"] if "tokens" in p else p["units"] * chat.PART_TOKENS[p["type"]]
            out.append((p["type"], p["ref"], tokens))
    return out


@settings(deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(turn, max_size=5))
def test_formatting_is_reversible(turns):
    formatted, _, attachments = chat.format_turns(turns)
    back = chat.read_turns(formatted, attachments)
    assert [(r, joined(p)) for r, p in back] == [(t["role"], joined(t["parts"])) for t in turns]


def test_loss_mask_covers_assistant_bodies_only():
    said = r"\### Assistant: <|end|> ok"
    turns = [{"role": r, "parts": [{"type": "text", "text": said}]} for r in ("user", "assistant")]
    formatted, mask, _ = chat.format_turns(turns)
    assert [chat.unescape(formatted[m["start"] : m["end"]]) for m in mask] == [said]
    assert formatted.count("<|") == 4


def test_typed_parts(spark):
    schema = "conv_id long, turn int, role string, parts array<struct<type:string,text:string,ref:string,units:int>>"
    rows = [(1, 0, "user", [("text", "look ", None, None), ("image", None, "a.png", 2), ("audio", None, "b.wav", 3)]),
            (1, 1, "assistant", [("document", None, "c.pdf", None)]), (2, None, None, None)]
    found = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(rows, schema)).collect()}
    assert found[1].formatted == "<|role|>user\nlook <|image:0|><|audio:1|><|end|>\n<|role|>assistant\n<|document:2|><|end|>\n"
    assert [tuple(a) for a in found[1].attachments] == [("image", "a.png", 512), ("audio", "b.wav", 150), ("document", "c.pdf", 400)]
    assert found[1].attachment_tokens == 1062 and found[2].formatted == "<|role|>\n<|end|>\n"


def test_awkward_rows(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string, loss string"
    rows = [(1, 1, "assistant", "b", "x", "y"), (1, 0, "user", None, None, None), (1, 1, "assistant", "b", "x", "y"),
            (1, None, "user", "first", None, None), (None, 0, None, "z" * 300_000, None, None), (2, 0, "assistant", "", None, None)]
    found = {r.conv_id: r for r in chat.read_back(chat.format_conversations(spark.createDataFrame(rows, schema))).collect()}
    one = "user\nfirst\nuser\n\nassistant\nb\nassistant\nb\n"
    assert found[1].turns_sha256 == hashlib.sha256(one.encode()).hexdigest()
    assert (found[1].n_turns, found[1].loss_chars) == (4, 2)
    assert found[2].loss_sha256 == hashlib.sha256(b"").hexdigest() and found[None].n_turns == 1
    empty = spark.createDataFrame([], schema)
    assert chat.read_back(chat.format_conversations(empty)).count() == 0


def test_null_and_unknown_parts():
    flat = chat.Flattener()
    assert [flat.visit(p) for p in (None, {}, {"type": None, "text": None}, {"type": "text", "text": "a|b"})] == ["", "", "", "a\\|b"]
    assert not flat.attachments
    with pytest.raises(ValueError, match="unknown content part"):
        flat.visit({"type": "video"})
