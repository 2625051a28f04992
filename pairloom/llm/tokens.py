"""Token ids of whole texts by a public tokenizer, with ids of known words kept.

The vocabulary splits texts into words before it merges, so the ids of a text are
those of its words in order. For texts of Latin-1 characters a word never spans
white space and its split is one regular expression, so ids are kept per word and
per run between spaces; any other text, and one that holds the name of a special
token or a control character that Python takes for space, is encoded whole.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable

from .workers import kept

# The split pattern of word_bpe_49k.json, its classes within Latin-1.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
_NUMBERS = "0-9²³¹¼-¾"
_SPACES = "\\t-\\r \\x85\\xa0"
_WORD = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+"
)
# Kept per worker, each some 150 bytes; others are encoded each time.
_MOST_RUNS, _MOST_WORDS = 300_000, 80_000
_ODD_SPACES = re.compile("[\x1c-\x1f]")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others for what follows 255.
    """
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(256 + k) for k, b in enumerate(hidden)}


class _Kept(dict):
    """Packed ids by text; those of missing texts are made."""

    def __init__(self, encode: Callable[[str], bytes], most: int) -> None:
        self.encode, self.most = encode, most

    def __missing__(self, word: str) -> bytes:
        packed = self.encode(word)
        if len(self) < self.most:
            self[word] = packed
        return packed


_loaded: dict[str, Callable[[str | None], bytes]] = kept("tokens")


def encoder(path: str) -> Callable[[str | None], bytes]:
    """A function from text to its ids as little-endian unsigned 32-bit values.

    path: a tokenizer file with the split of word_bpe_49k.json. Null is empty.
    """
    if path in _loaded:
        return _loaded[path]
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    merge, letters = whole.model.tokenize, _byte_letters()

    def pack(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def word(text: str) -> bytes:
        if not text.isascii():
            text = text.encode().decode("latin-1")
        return pack([t.id for t in merge(text.translate(letters))])

    words = _Kept(word, _MOST_WORDS)
    runs = _Kept(lambda text: b"".join(map(words.__getitem__, _WORD.findall(text))), _MOST_RUNS)
    specials = [t.content for t in whole.get_added_tokens_decoder().values()]

    def encode(text: str | None) -> bytes:
        if not text:
            return b""
        if (
            (not text.isascii() and max(text) > "ÿ")
            or any(s in text for s in specials)
            or _ODD_SPACES.search(text)
        ):
            return pack(whole.encode(text, add_special_tokens=False).ids)
        return b"".join(map(runs.__getitem__, text.lower().split()))

    _loaded[path] = encode
    return encode


def tokenizer_file() -> str:
    """The public vocabulary that the queries use; operators take any such path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
