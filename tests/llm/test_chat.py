import hashlib
import json

import pytest
from hypothesis import given
from hypothesis import strategies as st

from cartograin.llm import chat

turns = st.lists(st.tuples(st.sampled_from(["user", "assistant", "sys\ntem", "a\\n<|im_end|>", ""]), st.text(alphabet="a<|\\im_end>start \n é", max_size=40)), max_size=6)


@given(turns)
def test_rendering_is_read_back_exactly(said):
    text, mask = chat.render(said)
    assert chat.read_back(text) == said
    assert [chat.unescape(text[b:e]) for b, e in mask] == [t for r, t in said if r == "assistant"]


@given(st.text(alphabet="<|\\x", max_size=12))
def test_escaping_hides_control_strings_and_is_reversible(text):
    assert "<|" not in chat.escape(text) and chat.unescape(chat.escape(text)) == text


RECORDS = {
    "messages": ({"id": 5, "messages": [{"role": "human", "content": "q"}, {"role": "assistant", "content": None}]}, [("user", "q"), ("assistant", "")]),
    "message parts": (
        {"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]},
        [("user", "ab")],
    ),
    "no messages": ({"messages": []}, []),
    "spoken": ({"conversations": [{"from": "gpt", "value": "hi"}], "source": "x"}, [("assistant", "hi")]),
    "instruction": ({"instruction": "do", "input": "", "output": "done", "system": "be"}, [("system", "be"), ("user", "do"), ("assistant", "done")]),
    "instruction and response": ({"instruction": "i", "context": "c", "response": "r", "category": "k"}, [("user", "i\n\nc"), ("assistant", "r")]),
    "prompt and response": ({"prompt": "p", "response": "r"}, [("user", "p"), ("assistant", "r")]),
    "question and answer": ({"question": "p", "answer": 3}, [("user", "p"), ("assistant", "3")]),
}


def test_fingerprints_select_mappings(spark):
    rows = [(i, json.dumps(record)) for i, (record, _) in enumerate(RECORDS.values())]
    rows += [(90, '{"unknown": {"deep": [1]}}'), (91, "not json"), (92, None), (93, "[1]"), (None, rows[0][1])]
    frame = spark.createDataFrame([(i, r, "x", 1) for i, r in rows], "conv_id bigint, record string, layout string, n_turns int")
    got = {r.conv_id: r for r in chat.format_chats(frame).collect()}
    for i, (name, (_, want)) in enumerate(RECORDS.items()):
        assert got[i].layout == name and chat.read_back(got[i].formatted) == want and got[i].n_turns == len(want)
    assert got[90].layout is None and got[90].fingerprint and got[90].formatted is None
    assert all(got[i].fingerprint is None and got[i].n_turns == 0 for i in (91, 92, 93))
    assert got[None].layout == "messages"


def test_field_order_and_metadata_do_not_matter():
    a = chat.fingerprint(chat.field_paths({"prompt": 1, "response": 2}))
    assert a == chat.fingerprint(chat.field_paths({"response": None, "prompt": "x"}))
    assert a != chat.fingerprint(chat.field_paths({"prompt": {"deep": 1}, "response": 2}))


def test_no_two_layouts_share_a_fingerprint():
    seen = {}
    for layout in chat.LAYOUTS:
        for key in chat.mappings((layout,)):
            assert seen.setdefault(key, layout.name) == layout.name


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_turn_rows_to_digests(spark):
    rows = [(1, 1, "assistant", "b<|im_end|>é"), (1, 0, "user", None), (1, 2, "assistant", ""), (2, 0, None, "x"), (2, 0, None, "x"), (None, 5, "user", "u" * 100_000)]
    frame = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id bigint, turn bigint, role string, text string, messages string")
    got = {r.conv_id: r for r in chat.chat_digests(chat.format_chats(chat.turn_records(frame))).collect()}
    assert (got[1].n_turns, got[1].loss_chars, got[1].loss_sha256) == (3, 12, sha("b<|im_end|>é"))
    assert got[1].turns_sha256 == sha("user\n\nassistant\nb<|im_end|>é\nassistant\n\n")
    assert got[2].turns_sha256 == sha("\nx\n\nx\n") and got[2].loss_sha256 == sha("")
    assert got[None].formatted_chars == 100_000 + 12 + 4 + 1 + 11
    assert chat.format_chats(chat.turn_records(frame.limit(0))).count() == 0


@pytest.mark.parametrize("value, paths", [({"a": [{"b": 1}, {"c": []}]}, {"a[].b", "a[].c[]"}), ({"a": {}}, {"a"}), ({}, {""})])
def test_field_paths(value, paths):
    assert chat.field_paths(value) == paths
