import json
import re
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pairloom.functions import text as T

GOLDEN = [
    json.loads(line)
    for line in (Path(__file__).parent / "golden_conversations.jsonl").read_text().splitlines()
]


def parsed(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    m = T.parse_conversation(F.col("t"))
    rows = (
        df.select(
            "i",
            m.alias("m"),
            T.format_conversation(F.col("t")).alias("direct"),
            T.format_messages(m).alias("by_messages"),
            T.last_response(F.col("t")).alias("last"),
        )
        .orderBy("i")
        .collect()
    )
    return rows


def test_golden(spark):
    rows = parsed(spark, [g["text"] for g in GOLDEN])
    for g, row in zip(GOLDEN, rows, strict=True):
        assert [[m.role, m.content] for m in row.m] == g["messages"], g["id"]
        assert tuple(row.direct) == (g["prompt"], g["response"]), g["id"]
        assert tuple(row.by_messages) == (g["prompt"], g["response"]), g["id"]
        assert row["last"] == g["response"], g["id"]


def by_scanning(text):
    """Independent model: walk the markers, then cut the text between them."""
    text = text.strip()
    marks = list(re.finditer(r"(?:\A|\n\n)(Human|Assistant):", text))
    if not marks:
        return []
    ends = [m.start() for m in marks[1:]] + [len(text)]
    return [
        ("user" if m[1] == "Human" else "assistant", text[m.end() : end].strip())
        for m, end in zip(marks, ends, strict=True)
    ]


def prompt_and_response(messages):
    last = max((i for i, m in enumerate(messages) if m[0] == "assistant"), default=None)
    label = {"user": "Human", "assistant": "Assistant"}
    prompt = "\n\n".join(f"{label[r]}: {c}" for r, c in messages[:last])
    return prompt, "" if last is None else messages[last][1]


PIECES = st.sampled_from(
    ["Human:", "Assistant:", "human:", "\n", "\n\n", "\r\n", " ", "a", "b:", "　", " ",
     "\u001c", "\u0085", "​", "😀", "é", "Human", ":", "\t", "\x00"]
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(PIECES, max_size=14).map("".join), min_size=200, max_size=300))
def test_against_model(spark, texts):
    for text, row in zip(texts, parsed(spark, texts), strict=True):
        expected = by_scanning(text)
        assert [tuple(m) for m in row.m] == expected, repr(text)
        assert tuple(row.direct) == prompt_and_response(expected), repr(text)
        assert tuple(row.by_messages) == prompt_and_response(expected), repr(text)
        assert row["last"] == prompt_and_response(expected)[1], repr(text)


CONTENT = st.text(st.sampled_from("ab \n:é😀"), max_size=8).map(str.strip)
MESSAGES = st.lists(st.tuples(st.sampled_from(["user", "assistant"]), CONTENT), max_size=5)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(MESSAGES, min_size=100, max_size=200))
def test_parse_undoes_reconstruct(spark, conversations):
    schema = f"i int, m {T.MESSAGES_TYPE}"
    df = spark.createDataFrame(list(enumerate(conversations)), schema)
    text = T.reconstruct_conversation(F.col("m"))
    for row in df.select("m", T.parse_conversation(text).alias("again")).collect():
        assert row.again == row.m


def test_reconstruct_labels(spark):
    df = spark.createDataFrame(
        [([("system", "s"), ("user", "u"), ("tool", "t")],), ([],)], f"m {T.MESSAGES_TYPE}"
    )
    rows = df.select(T.reconstruct_conversation(F.col("m")).alias("t")).collect()
    assert [r.t for r in rows] == ["Assistant: s\n\nHuman: u\n\nAssistant: t", ""]


def test_strip_is_unicode(spark):
    every_blank = "".join(c for c in map(chr, range(0x110000)) if c.isspace())
    assert set(every_blank) == set(T.WHITESPACE) and len(T.WHITESPACE) == 29
    df = spark.createDataFrame([(every_blank + "x ​" + every_blank,)], "t string")
    assert df.select(T.strip(F.col("t"))).first()[0] == "x ​"


def test_extract_takes_the_chosen_prompt(spark):
    df = spark.createDataFrame(
        [("Human: a\n\nAssistant: b", "Human: z\n\nAssistant: c"), ("", "Assistant: c")],
        "chosen string, rejected string",
    )
    both = T.extract_prompt_and_responses(F.col("chosen"), F.col("rejected"))
    rows = df.select(both.alias("x")).collect()
    assert [tuple(r.x) for r in rows] == [("Human: a", "b", "c"), ("", "", "c")]


def test_null_text_stays_null(spark):
    row = parsed(spark, [None])[0]
    assert row.m is None and row["last"] is None
    assert tuple(row.direct) == tuple(row.by_messages) == (None, None)


@pytest.mark.parametrize("policy", ["fail", "drop"])
def test_null_policy(spark, policy):
    from pairloom import prepare_for_dpo, prepare_for_sft

    df = spark.createDataFrame(
        [(1, "Human: a\n\nAssistant: b", None), (2, None, "x"), (3, "Assistant: b", "Assistant: c")],
        "row_id bigint, chosen string, rejected string",
    )
    if policy == "drop":
        assert [r.row_id for r in prepare_for_dpo(df, on_null="drop").collect()] == [3]
        assert [r.row_id for r in prepare_for_sft(df, on_null="drop").collect()] == [1, 3]
    else:
        for prepare in (prepare_for_dpo, prepare_for_sft):
            with pytest.raises(PySparkException, match="holds a null"):
                prepare(df).collect()
        # SFT never looks at the rejected side.
        assert prepare_for_sft(df.where("row_id <> 2")).count() == 2
    with pytest.raises(ValueError):
        prepare_for_sft(df, on_null="ignore")
