import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from halyard.llm import chat as C

PARTS = st.lists(st.sampled_from(["<", "|", "turn", "|>", ">", "\\", "s", "/", "[", "INST", "]", "<|end|>\n", "<|turn|>", "<s>", "<\\s>", "a", "\n", "<<SYS>>", "<|text|>", "</s>"]), max_size=14).map("".join)


@settings(max_examples=600, deadline=None)
@given(st.lists(st.tuples(PARTS, PARTS), max_size=4))
def test_round_trip(turns):
    text, _ = C.write(turns)
    assert C.read(text) == turns


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), PARTS), max_size=5))
def test_mask_covers_what_the_assistant_says(turns):
    text, spans = C.write(turns)
    assert [C.unescape(text[a:b]) for a, b in zip(spans[::2], spans[1::2], strict=True)] == [t for r, t in turns if r == "assistant"]


def test_no_control_string_is_left_in_a_text():
    for c in C.CONTROLS:
        for text in (c, c[0] + "\\" + c[1:], c * 3):
            assert not any(x in C.escape(text) for x in C.CONTROLS) and C.unescape(C.escape(text)) == text


@pytest.mark.parametrize(
    ("record", "turns"),
    [
        ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, [("user", "q"), ("assistant", "a")]),
        ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, [("user", "q"), ("assistant", "a")]),
        ({"turns": [{"turn": 1, "speaker": "bot", "text": "a"}, {"turn": 0, "speaker": "human", "text": "q"}]}, [("user", "q"), ("assistant", "a")]),
        ({"prompt": "q", "completion": "a"}, [("user", "q"), ("assistant", "a")]),
        ({"system": "s", "prompt": "q", "response": "a"}, [("system", "s"), ("user", "q"), ("assistant", "a")]),
        ({"instruction": "do", "input": "this", "output": "a"}, [("user", "do\n\nthis"), ("assistant", "a")]),
        ({"instruction": "do", "input": None, "output": "a"}, [("user", "do"), ("assistant", "a")]),
        ({"system_prompt": "s", "question": "q", "response": "a"}, [("system", "s"), ("user", "q"), ("assistant", "a")]),
        ({"messages": [{"role": "human", "content": ""}]}, [("human", "")]),
    ],
)
def test_layouts(record, turns):
    assert C.turns_of(record, C.registry()[C.fingerprint(C.paths(record))]) == turns


def test_layouts_have_paths_of_their_own():
    with pytest.raises(ValueError):
        C.registry((*C.LAYOUTS, C._fields(("user", "prompt"), ("assistant", "completion"))))


def test_records_without_a_mapping_stay(spark):
    rows = [(1, json.dumps({"a": 1})), (2, "not json"), (3, None), (4, "[1]"), (None, json.dumps({"prompt": "q", "completion": "a"})), (5, json.dumps({"messages": []}))]
    out = {r.conv_id: r for r in C.format_chats(spark.createDataFrame(rows, "conv_id long, record string")).collect()}
    assert len(out) == 6 and out[None].n_turns == 2 and out[1].formatted is None and out[1].layout and out[2].layout is None and out[5].formatted is None
    back = C.digest(C.format_chats(spark.createDataFrame(rows, "conv_id long, record string")))
    assert back.count() == 6 and back.filter("conv_id = 1").first().turns_sha256 is None


def brute(rows):
    out = {}
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is None, t or 0, r or "", x or ""))
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        out[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def check(spark, df):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]
    odd = "</s>[INST] ok [/INST]"
    want = brute([*rows, (-1, 0, "user", odd), (-1, 1, "assistant", odd)])
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in C.chat_query(df).collect()}
    assert got == want


def test_query_against_brute_force(spark, sf_dir):
    check(spark, spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def test_odd_conversations(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "assistant", None), (2, 0, None, "<|end|>\n"), (None, 1, "assistant", "x\\<s>"), (3, 5, "assistant", "é" * 50_000), (3, 1, "we\nird<|text|>", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    check(spark, df.selectExpr("*", "'x' AS record", "1 AS id"))
    check(spark, df.limit(0))
