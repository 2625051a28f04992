"""The tokenizer hook: how operators count tokens and render chat text."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from pairloom.functions.template import CHATML, ChatTemplate

# Fixed value: a native token is a run of anything but ASCII blanks.
BLANKS = " \t\n\r\f\v"


@dataclass(frozen=True)
class Tokenizer:
    """How texts are counted and conversations rendered.

    `count_all` turns named texts into a struct of bigint counts by the same
    names, NULL for NULL. `render(messages, generation)` gives a string column.
    `most(text)`, if known, is a cheap column that no count can exceed; texts
    that fit a limit by it are not counted at all.
    """

    count_all: Callable[[Mapping[str, Column]], Column]
    render: Callable[[Column, bool], Column]
    most: Callable[[Column], Column] | None = None

    def count(self, text: Column) -> Column:
        return self.count_all({"tokens": text})["tokens"]


def native_tokenizer(template: ChatTemplate = CHATML, special_per_call: int = 0) -> Tokenizer:
    """Blank-separated tokens and a declarative template; stays in the JVM.

    `special_per_call` stands for the marker tokens that a sub-word tokenizer
    adds to each text it is given.
    """

    # A token with the blanks after it, up to the next token.
    step = f"[^{BLANKS}]++[{BLANKS}]*+"

    def count(text: Column) -> Column:
        # One letter stands for each step, so that no list of tokens is made.
        steps = F.regexp_replace(F.ltrim(text, F.lit(BLANKS)), step, "x")
        return (F.octet_length(steps) + special_per_call).cast("bigint")

    def count_all(texts: Mapping[str, Column]) -> Column:
        return F.struct(*[count(text).alias(name) for name, text in texts.items()])

    def most(text: Column) -> Column:
        # n tokens take n bytes and n - 1 blanks between them, at least. The size
        # in bytes is known; characters would have to be counted.
        return F.floor((F.octet_length(text) + 1) / 2) + special_per_call

    return Tokenizer(count_all, template.render, most)


def python_tokenizer(
    load: Callable[[], Any], most: Callable[[Column], Column] | None = None
) -> Tokenizer:
    """Wrap a Python tokenizer object.

    `load` runs inside the task and returns an object with the usual interface:
    `tok(list_of_texts, truncation=False)["input_ids"]` and
    `tok.apply_chat_template(messages, tokenize=False, add_generation_prompt=...)`.
    Make `load` an importable function under `functools.cache` to load the
    tokenizer once per Python worker, not once per task. Texts cross to Python
    in Arrow batches, all the columns to count in one pass.

    `most` is the caller's promise about the tokenizer; with it, the length
    filters leave short texts in the JVM. A byte-level vocabulary that adds two
    marker tokens, for example, allows `lambda text: F.octet_length(text) + 2`.
    """

    def counted(tokenizer: Any, texts: pd.Series) -> pd.Series:
        known = texts.dropna()
        counts = pd.Series(None, index=texts.index, dtype="Int64")
        if len(known):
            ids = tokenizer(known.tolist(), truncation=False)["input_ids"]
            counts[known.index] = [len(x) for x in ids]
        return counts

    def count_all(texts: Mapping[str, Column]) -> Column:
        names = list(texts)

        def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
            tokenizer = load()
            for columns in batches:
                # A single column comes as it is, several come as a tuple.
                columns = columns if isinstance(columns, tuple) else (columns,)
                yield pd.DataFrame(
                    {n: counted(tokenizer, c) for n, c in zip(names, columns, strict=True)}
                )

        counts = StructType([StructField(name, LongType()) for name in names])
        return F.pandas_udf(run, counts)(*texts.values())

    def render(messages: Column, add_generation_prompt: bool = False) -> Column:
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            tokenizer = load()
            for conversations in batches:
                texts = [
                    tokenizer.apply_chat_template(
                        [{"role": m["role"], "content": m["content"]} for m in conversation],
                        tokenize=False,
                        add_generation_prompt=add_generation_prompt,
                    )
                    for conversation in conversations
                ]
                yield pd.Series(texts, dtype="object")

        return F.pandas_udf(run, StringType())(messages)

    return Tokenizer(count_all, render, most)
