"""Conversation text to messages and back, as native column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairloom.functions.binding import let

# The code points that count as blank when text is stripped.
WHITESPACE = "".join(
    map(
        chr,
        [
            *range(0x09, 0x0E),
            *range(0x1C, 0x21),
            0x85,
            0xA0,
            0x1680,
            *range(0x2000, 0x200B),
            0x2028,
            0x2029,
            0x202F,
            0x205F,
            0x3000,
        ],
    )
)

# The speaker markers, and the blank line that separates turns.
HUMAN = "Human:"
ASSISTANT = "Assistant:"
BLANK_LINE = "\n\n"
TURN_BREAK = r"\n\n(?=Human:|Assistant:)"

_TO_THE_END = 2_147_483_647

MESSAGES_TYPE = "array<struct<role:string,content:string>>"


def strip(text: Column) -> Column:
    """Remove blank code points, not just U+0020, from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def _bytes(text: Column, start: int, size: Column | None = None) -> Column:
    """Part of a text by bytes; cut only next to ASCII, so characters stay whole.

    Positions in characters would make Spark walk the text from its start, which
    costs more than the rest of the parse.
    """
    raw = text.cast("binary")
    return F.substr(raw, F.lit(start), F.lit(_TO_THE_END) if size is None else size).cast("string")


def _after(turn: Column, marker: str) -> Column:
    return strip(_bytes(turn, len(marker) + 1))


def _marked_turns(text: Column) -> Column:
    # Only the piece before the first break can lack a marker. A right strip of
    # the whole text is not needed: the last content is stripped on its own.
    pieces = F.split(F.ltrim(text, F.lit(WHITESPACE)), TURN_BREAK, -1)
    return F.filter(pieces, lambda p: F.startswith(p, F.lit(HUMAN)) | F.startswith(p, F.lit(ASSISTANT)))


def parse_conversation(text: Column) -> Column:
    """Text to an array of (role, content); unmarked leading text is dropped."""

    def message(turn: Column) -> Column:
        human = F.startswith(turn, F.lit(HUMAN))
        return F.struct(
            F.when(human, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
            F.when(human, _after(turn, HUMAN)).otherwise(_after(turn, ASSISTANT)).alias("content"),
        )

    return F.transform(_marked_turns(text), message)


def reconstruct_conversation(messages: Column) -> Column:
    """Messages to text; every role but `user` is labelled as the assistant."""

    def line(message: Column) -> Column:
        label = F.when(message["role"] == "user", F.lit(HUMAN)).otherwise(F.lit(ASSISTANT))
        return F.concat(label, F.lit(" "), message["content"])

    return F.array_join(F.transform(messages, line), BLANK_LINE)


def _at_last_reply(messages: Column, body: Callable[[Column, Column], Column]) -> Column:
    """`body(m, p)`: messages, and the place of the last reply from the end, or 0."""

    def cut(m: Column) -> Column:
        roles = F.transform(m, lambda x: x["role"])
        return let(F.array_position(F.reverse(roles), "assistant").cast("int"), lambda p: body(m, p))

    return let(messages, cut)


def _before(m: Column, p: Column) -> Column:
    return F.slice(m, F.lit(1), F.when(p == 0, F.size(m)).otherwise(F.size(m) - p))


def prompt_messages(messages: Column) -> Column:
    """The messages before the last reply, or all where there is none."""
    return _at_last_reply(messages, _before)


def format_messages(messages: Column) -> Column:
    """Messages to (prompt, response), split at the last assistant message."""

    def cut(m: Column, p: Column) -> Column:
        response = F.when(p == 0, F.lit("")).otherwise(F.get(m, F.size(m) - p)["content"])
        prompt = reconstruct_conversation(_before(m, p))
        return F.struct(prompt.alias("prompt"), response.alias("response"))

    return _at_last_reply(messages, cut)


# The table-level operators need no messages to find the last reply. Every turn
# break before an assistant turn is the literal "\n\nAssistant:", so the last
# such literal ends the prompt; plain substring search is enough.

_REPLY = BLANK_LINE + ASSISTANT
_QUESTION = BLANK_LINE + HUMAN


def _around_last_reply(text: Column, body: Callable[[Column, Column], Column]) -> Column:
    """`body(opened, tail)`: text that opens with a break, and what follows its last reply mark."""
    opened = F.concat(F.lit(BLANK_LINE), F.ltrim(text, F.lit(WHITESPACE)))
    return let(opened, lambda o: let(F.substring_index(o, _REPLY, -1), lambda tail: body(o, tail)))


def _has_reply(opened: Column, tail: Column) -> Column:
    # Without a mark, the tail is the whole text.
    return F.octet_length(tail) < F.octet_length(opened)


def _reply_in(opened: Column, tail: Column) -> Column:
    reply = strip(F.substring_index(tail, _QUESTION, 1))
    return F.when(_has_reply(opened, tail), reply).when(opened.isNotNull(), F.lit(""))


def _context_in(opened: Column, tail: Column) -> Column:
    size = F.octet_length(opened) - F.octet_length(tail) - len(_REPLY)
    head = F.when(_has_reply(opened, tail), _bytes(opened, 1, size)).otherwise(opened)

    def line(turn: Column) -> Column:
        return F.when(
            F.startswith(turn, F.lit(HUMAN)), F.concat(F.lit(HUMAN + " "), _after(turn, HUMAN))
        ).otherwise(F.concat(F.lit(ASSISTANT + " "), _after(turn, ASSISTANT)))

    return F.array_join(F.transform(_marked_turns(head), line), BLANK_LINE)


def has_turns(text: Column) -> Column:
    """Whether a text has any marked turn, so that parsing it gives a message."""
    opened = F.concat(F.lit(BLANK_LINE), F.ltrim(text, F.lit(WHITESPACE)))
    return let(opened, lambda o: F.contains(o, F.lit(_QUESTION)) | F.contains(o, F.lit(_REPLY)))


def last_response(text: Column) -> Column:
    """Content of the last assistant message, or the empty string."""
    return _around_last_reply(text, _reply_in)


def format_conversation(text: Column) -> Column:
    """Text to (prompt, response); turns after the last reply are dropped."""

    def both(opened: Column, tail: Column) -> Column:
        prompt, response = _context_in(opened, tail), _reply_in(opened, tail)
        return F.struct(prompt.alias("prompt"), response.alias("response"))

    return _around_last_reply(text, both)


def extract_prompt_and_responses(chosen: Column, rejected: Column) -> Column:
    """Prompt of `chosen` and the last reply of each side."""
    return let(
        format_conversation(chosen),
        lambda c: F.struct(
            c["prompt"].alias("prompt"),
            c["response"].alias("chosen_response"),
            last_response(rejected).alias("rejected_response"),
        ),
    )
