import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from lakeshore.llm.chat_format import ADDED_ID, ADDED_TEXT, BEGIN, END, PLAIN, Part, Template, format_conversations, op13_chat_formatting, read_back, read_turns, stored_order
from tests.conftest import SF01

SCHEMA = "conv_id long, turn long, role string, text string, piece int, spans string"
TEXT = st.text(st.sampled_from(list("\\#</>turnole: \nxé\U0001f600")) | st.characters(codec="utf-8"), max_size=40)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "", "User", "tool"]) | TEXT, TEXT), max_size=5))
def test_texts_come_back(turns):
    text = "".join(s for role, body in turns for s, _ in PLAIN.segments(role, body))
    assert list(read_turns(text)) == turns


def test_texts_cannot_end_their_turn():
    written = "".join(s for s, _ in PLAIN.segments("user", ADDED_TEXT))
    assert written == "### User: \\\\\\### Assistant: \\</turn> ok</turn>\n"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    groups = {}
    for conv, turn, role, text, *_ in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    steps = {(None, "system"), (None, "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user"), ("assistant", None)}
    out = {}
    for conv, turns in groups.items():
        turns = [(r, t) for _, _, r, t in sorted(turns)]
        learned = "".join(t for r, t in turns if r == "assistant")
        roles = [None, *(r for r, _ in turns), None]
        size = sum(len(s) for r, t in turns for s, _ in PLAIN.segments(r, t))
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), sha(learned), size,
                     sum(step not in steps for step in zip(roles, roles[1:], strict=False)))
    return out


def collected(df):
    rows = df.collect()
    out = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(rows) == len(out)
    return out


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(ADDED_ID, 0, "user", ADDED_TEXT), (ADDED_ID, 1, "assistant", ADDED_TEXT)]
    assert collected(op13_chat_formatting(spark, SF01)) == expected(rows)


def odd_rows():
    rows = [(None, None, None, None), (None, 1, "user", "a"), (1, 0, "", "\\"), (1, 0, "", "\\"), (1, 2, "assistant", ""), (1, 1, "assistant", "é</turn>"),
            (2, 0, "tool</role>", "</role>###"), (2, None, "user", "x"), (3, 0, "assistant", "### User: " * 300_000)]
    rows += [(4, t, "user" if t % 2 else "assistant", f"text {t}\n") for t in range(5000)]  # a hot conversation
    return [(*r, 1, "clash") for r in rows]


def test_odd_rows_in_pieces(spark, scratch):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for size in (1 << 20, 100):
        formatted = format_conversations(df, piece_chars=size)
        assert collected(read_back(formatted)) == expected(rows)
    formatted.write.parquet(f"{scratch}/formatted")
    stored = spark.read.parquet(f"{scratch}/formatted")
    assert stored.where("conv_id = 4").count() > 1000
    assert collected(read_back(stored_order(stored.repartition(7)))) == expected(rows)


def test_spans_are_the_loss_mask(spark):
    rows = [(1, 0, "user", "Hi"), (1, 1, "assistant", "a</turn>b"), (1, 2, "assistant", "")]
    row = format_conversations(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")).first()
    assert row.text == "### User: Hi</turn>\n### Assistant: a\\</turn>b</turn>\n### Assistant: </turn>\n"
    assert [row.text[s.start: s.start + s.length] for s in row.spans] == ["a\\</turn>b"]
    assert row.illegal_turns == 1


def test_another_template(spark):
    template = Template(parts={"q": Part("<|q|>", "<|end|>"), "a": Part("<|a|>", "<|end|>", loss=True, tail_loss=True)}, other=Part("<|o|>", "<|end|>"),
                        name_end="<|n|>", controls=("<|",), follows={BEGIN: ("q",), "q": ("a",), "a": ("q", END)})
    rows = [(1, 0, "q", "x <|end|>"), (1, 1, "a", "y"), (1, 2, "z", "w")]
    formatted = format_conversations(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"), template)
    row = formatted.first()
    assert row.text == "<|q|>x \\<|end|><|end|><|a|>y<|end|><|o|>z<|n|>w<|end|>" and row.illegal_turns == 2
    assert [row.text[s.start: s.start + s.length] for s in row.spans] == ["y<|end|>"]
    assert list(read_turns(row.text, template)) == [("q", "x <|end|>"), ("a", "y"), ("z", "w")]


def test_empty_table(spark):
    assert read_back(format_conversations(spark.createDataFrame([], SCHEMA))).collect() == []
