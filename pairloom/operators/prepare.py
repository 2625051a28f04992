"""Raw pairs to the two training tables.

Every operator here is one narrow stage: a scan of the columns it needs, one
evaluation of each parse, and filters. Nothing is shuffled, so a skewed source
or key has no effect. The same functions serve batch and streaming tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions import text as T
from pairloom.functions.binding import bind_columns, let
from pairloom.functions.tokens import Tokenizer
from pairloom.operators.funnel import Funnel
from pairloom.operators.lengths import within_limits

REPLY_LABEL = "\n\nAssistant: "

# Both responses are there; null where one is missing.
ANSWERED = "chosen <> '' AND rejected <> ''"

# The columns of each training table, and those of both in one.
FORMATS = {"sft": ("text", "messages"), "dpo": ("prompt", "chosen", "rejected")}
BOTH_TYPES = {
    "text": "string",
    "messages": T.MESSAGES_TYPE,
    "prompt": "string",
    "chosen": "string",
    "rejected": "string",
}

# Columns that identify a row; carried along where the input has them.
KEY_COLUMNS = ("row_id", "split")


def key_columns(df: DataFrame, keep: Sequence[str] | None) -> list[str]:
    return [c for c in KEY_COLUMNS if c in df.columns] if keep is None else list(keep)


def non_null(df: DataFrame, columns: Sequence[str], on_null: str) -> tuple[DataFrame, list[Column]]:
    """Apply the null policy to the text columns that an operator reads."""
    if on_null == "drop":
        return df.where(" AND ".join(f"{c} IS NOT NULL" for c in columns)), [F.col(c) for c in columns]
    if on_null == "fail":
        return df, [
            F.coalesce(F.col(c), F.raise_error(F.lit(f"column {c} holds a null")).cast("string"))
            for c in columns
        ]
    raise ValueError(f"on_null must be 'fail' or 'drop', not {on_null!r}")


def _read(
    pairs: DataFrame, columns: Sequence[str], on_null: str, funnel: Funnel | None
) -> tuple[DataFrame, list[Column]]:
    """The null policy, with rows counted before and after it."""
    if funnel is None:
        return non_null(pairs, columns, on_null)
    pairs, values = non_null(funnel.count(pairs, "in"), columns, on_null)
    return funnel.count(pairs, "read"), values


def pair_limits(max_length: int, max_prompt_length: int | None) -> list[tuple[list[str], int]]:
    limits = [(["prompt", "chosen"], max_length), (["prompt", "rejected"], max_length)]
    return limits if max_prompt_length is None else [*limits, (["prompt"], max_prompt_length)]


def plain_text(prompt: Column, response: Column) -> Column:
    return F.concat(prompt, F.lit(REPLY_LABEL), response)


def prepare_for_sft(
    pairs: DataFrame,
    tokenizer: Tokenizer | None = None,
    max_length: int | None = 2048,
    use_chat_template: bool = True,
    *,
    keep: Sequence[str] | None = None,
    on_null: str = "fail",
    funnel: Funnel | None = None,
) -> DataFrame:
    """`chosen` to `text` and `messages`; reads no other text column.

    Without a tokenizer (or with `use_chat_template=False`) `text` ends at the
    last assistant reply while `messages` keeps any turn after it. With a
    tokenizer, rows of more than `max_length` tokens leave; None keeps all. A
    `funnel` counts the rows at each step.
    """
    keys = key_columns(pairs, keep)
    pairs, (chosen,) = _read(pairs, ["chosen"], on_null, funnel)
    if use_chat_template and tokenizer is not None:
        parsed = bind_columns(pairs, keys, messages=T.parse_conversation(chosen))
        # Bound once more, so that the length filter does not render again.
        prepared = bind_columns(
            parsed, [*keys, "messages"], text=tokenizer.render(F.col("messages"), False)
        )
    else:

        def both(messages: Column) -> Column:
            parts = T.format_messages(messages)
            text = let(parts, lambda p: plain_text(p["prompt"], p["response"]))
            return F.struct(text.alias("text"), messages.alias("messages"))

        row = let(T.parse_conversation(chosen), both)
        prepared = bind_columns(pairs, keys, row=row).select(*keys, "row.text", "row.messages")
    prepared = prepared.select(*keys, "text", "messages")
    if funnel is not None:
        prepared = funnel.count(prepared, "parsed", unparsed=F.count_if(F.size("messages") == 0))
    if tokenizer is not None and max_length is not None:
        prepared = within_limits(prepared, tokenizer, [(["text"], max_length)])
    return prepared if funnel is None else funnel.count(prepared, "kept")


def prepare_for_dpo(
    pairs: DataFrame,
    tokenizer: Tokenizer | None = None,
    max_length: int | None = 2048,
    max_prompt_length: int | None = 1024,
    *,
    keep: Sequence[str] | None = None,
    on_null: str = "fail",
    funnel: Funnel | None = None,
) -> DataFrame:
    """Pairs to `prompt`, `chosen`, `rejected`, without empty responses.

    With a tokenizer and a `max_length`, the prompt with either response must
    fit in `max_length`, and the prompt alone in `max_prompt_length` unless
    that is None. All limits are inclusive. A `funnel` counts the rows at each step.
    """
    keys = key_columns(pairs, keep)
    pairs, (chosen, rejected) = _read(pairs, ["chosen", "rejected"], on_null, funnel)
    parsed = {"left": T.format_conversation(chosen), "rejected": T.last_response(rejected)}
    if funnel is not None:
        parsed["turns"] = T.has_turns(chosen)
    prepared = bind_columns(pairs, keys, **parsed)
    if funnel is not None:
        prepared = funnel.count(prepared, "parsed", unparsed=F.count_if(~F.col("turns")))
    prepared = prepared.select(
        *keys, "left.prompt", F.col("left.response").alias("chosen"), "rejected"
    ).where(ANSWERED)
    if funnel is not None:
        prepared = funnel.count(prepared, "filled")
    if tokenizer is not None and max_length is not None:
        prepared = within_limits(prepared, tokenizer, pair_limits(max_length, max_prompt_length))
    return prepared if funnel is None else funnel.count(prepared, "kept")


def prepare_both(
    pairs: DataFrame,
    tokenizer: Tokenizer | None = None,
    max_length: int | None = 2048,
    max_prompt_length: int | None = 1024,
    use_chat_template: bool = True,
    *,
    keep: Sequence[str] | None = None,
    on_null: str = "fail",
) -> DataFrame:
    """Both training tables as one, keyed by `format`, from one read and one parse.

    A row of format `sft` has `text` and `messages`, one of `dpo` has `prompt`, `chosen`
    and `rejected`; the other columns are null. Rows are those of `prepare_for_sft`
    and `prepare_for_dpo`. With `on_null="drop"` a pair without `rejected` still gives
    supervised text.
    """
    keys = key_columns(pairs, keep)
    needed = ["chosen"] if on_null == "drop" else ["chosen", "rejected"]
    pairs, values = non_null(pairs, needed, on_null)
    rejected = values[1] if len(values) > 1 else F.col("rejected")
    parsed = bind_columns(
        pairs, keys, messages=T.parse_conversation(values[0]), reply=T.last_response(rejected)
    )
    chat = use_chat_template and tokenizer is not None
    formed = {"parts": T.format_messages(F.col("messages"))}
    if chat:
        formed["chat"] = tokenizer.render(F.col("messages"), False)
    formed = bind_columns(parsed, [*keys, "messages", "reply"], **formed)
    plain = plain_text(F.col("parts.prompt"), F.col("parts.response"))

    def row(kind: str, **values: Column) -> Column:
        columns = [values.get(c, F.lit(None).cast(t)).alias(c) for c, t in BOTH_TYPES.items()]
        return F.struct(F.lit(kind).alias("format"), *columns)

    rows = F.array(
        row("sft", text=F.col("chat") if chat else plain, messages=F.col("messages")),
        row("dpo", prompt=F.col("parts.prompt"), chosen=F.col("parts.response"), rejected=F.col("reply")),
    )
    prepared = formed.select(*keys, F.inline(rows)).where(f"format = 'sft' OR ({ANSWERED})")
    if tokenizer is None or max_length is None:
        return prepared
    limits = [(["text"], max_length), *pair_limits(max_length, max_prompt_length)]
    return within_limits(prepared, tokenizer, limits)


def only(both: DataFrame, kind: str) -> DataFrame:
    """The rows and columns of one format of `prepare_both`."""
    keys = key_columns(both, None)
    return both.where(F.col("format") == kind).select(*keys, *FORMATS[kind])


def sft_text_from_pairs(prepared: DataFrame, *, keep: Sequence[str] | None = None) -> DataFrame:
    """Prepared pairs to `text`: prompt plus chosen response."""
    keys = key_columns(prepared, keep)
    return prepared.select(*keys, plain_text(F.col("prompt"), F.col("chosen")).alias("text"))
