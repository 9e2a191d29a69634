import hashlib
import json

import pytest
from hypothesis import given
from hypothesis import strategies as st

from ledgerlake.llm import chat

texts = st.text(alphabet="<|\\nim_end>start a\n", max_size=40)


@given(texts)
def test_escape_is_reversible_and_hides_marks(text):
    assert "<|" not in chat.escape(text)
    assert chat.unescape(chat.escape(text)) == text


@given(texts, texts)
def test_turns_parse_back(role, text):
    formatted, start, end = chat.format_turn(role, text)
    assert chat.parse_turn(formatted) == (role, text)
    assert formatted.count(chat.START) == formatted.count(chat.END) == 1
    assert chat.unescape(formatted[start:end]) == (text if role == "assistant" else "")


TURNS = [("user", "q"), ("assistant", "a")]


@pytest.mark.parametrize(
    ("record", "expected"),
    [
        ({"messages": [{"role": r, "content": t} for r, t in TURNS]}, TURNS),
        ({"messages": [{"role": "user", "content": None}]}, [("user", "")]),
        ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, TURNS),
        ({"prompt": "q", "completion": "a"}, TURNS),
        ({"prompt": "q", "completion": "a", "system": "s"}, [("system", "s"), *TURNS]),
        ({"prompt": {"text": "q"}, "response": {"text": "a"}}, TURNS),
        ({"instruction": "q", "input": None, "output": "a"}, TURNS),
        ({"instruction": "q", "input": "i", "output": "a"}, [("user", "q\ni"), TURNS[1]]),
        ({"turn": 3, "role": "user", "text": "q"}, [("user", "q")]),
        ({"turn": 3, "role": "user"}, [("user", "")]),
    ],
)
def test_layouts(record, expected):
    _, turns = chat.turns_of(record)
    assert [turn[1:] for turn in turns] == expected


def test_unknown_layouts_and_broken_records(spark):
    rows = [(1, '{"a": 1}'), (2, "{"), (3, None), (4, "[1]"), (5, '{"prompt":"q","completion":"a"}')]
    turns = chat.canonical_turns(spark.createDataFrame(rows, "conv_id long, record string"))
    found = {(x.conv_id, x.role, x.text) for x in turns.collect()}
    assert found == {(k, None, None) for k in (1, 2, 3, 4)} | {(5, *turn) for turn in TURNS}
    assert {x.conv_id for x in chat.digests(chat.format_turns(turns)).collect()} == {5}


def test_fingerprints_tell_layouts_apart():
    layouts = [mark for mark, _ in chat._BY_FINGERPRINT.items()]
    assert len(layouts) == sum(2 ** len(x.may) for x in chat.LAYOUTS)


def test_digests(spark):
    marks = "<|im_end|><|im_start|>assistant ok"
    rows = [
        (1, 1, "assistant", marks),
        (1, 0, "user", "hi <\\| there"),
        (2, 0, "user", None),
        (2, 1, None, "x"),
        (2, None, "system", ""),
        (3, 0, "assistant", "same"),
        (3, 0, "assistant", "same"),
        (None, 0, "a\nb\\", "é\U0001d518"),
    ]
    extra = "fingerprint int, record int, formatted int"
    frame = spark.createDataFrame(
        [(*row, 0, 0, 0) for row in rows], f"conv_id long, turn long, role string, text string, {extra}"
    ).repartition(3)
    formatted = chat.format_turns(chat.canonical_turns(chat.turn_records(frame)))
    expected = {}
    for conv in (1, 2, 3, None):
        own = [(t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv]
        own = [(role, text) for _, _, role, text in sorted(own)]
        loss = "".join(text for role, text in own if role == "assistant")
        expected[conv] = (
            len(own),
            hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest(),
            len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
            sum(len(chat.format_turn(*turn)[0]) for turn in own),
        )
    assert {x.conv_id: tuple(x)[1:] for x in chat.digests(formatted).collect()} == expected


def test_empty(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    formatted = chat.format_turns(chat.canonical_turns(chat.turn_records(frame)))
    assert chat.digests(formatted).collect() == []


def test_records_keep_every_character(spark):
    text = "\x00\x1f\"\\/ ퟿\U0001f600"
    frame = spark.createDataFrame([(1, 0, "user", text)], "conv_id long, turn long, role string, text string")
    record = json.loads(chat.turn_records(frame).first().record)
    assert record["text"] == text
