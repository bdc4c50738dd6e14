"""Pre-tokens of byte-level BPE tokenizer files, each merged once per worker.

Byte-level BPE merges inside pre-tokens only, so a text's tokens are its
pre-tokens' tokens one after the other.  The pattern, the normalizer and the
merges are the tokenizer file's own.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import regex
from tokenizers import Tokenizer

#: Split pattern of a ByteLevel pre-tokenizer that brings none of its own (fixed value).
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_LATE = re.compile("[\U00020000-\U0010FFFF]").search
#: Letters that every version of Unicode and every library knows; texts of
#: these, ASCII and its white space are split by a pattern without look-ups.
_LATIN = "A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F"
_OTHER = re.compile(f"[^\\t\\n\\r\\x20-\\x7E{_LATIN[6:]}]").search
_QUICK = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LATIN}]+| ?[0-9]+| ?[^\\s{_LATIN}0-9]+|\\s+(?!\\S)|\\s+").findall


def byte_letters() -> dict[int, str]:
    """The character that byte-level BPE writes for each byte: itself where
    printable in Latin-1, else the next free one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Pieces:
    """Splits texts as a tokenizer file does."""

    def __init__(self, path: str):
        self.tok = Tokenizer.from_file(path)
        spec = json.loads(self.tok.to_str())
        pre = spec["pre_tokenizer"]
        steps = pre["pretokenizers"] if pre["type"] == "Sequence" else [pre]
        split = [s["pattern"]["Regex"] for s in steps if s["type"] == "Split"]
        if steps[-1]["type"] != "ByteLevel" or steps[-1]["add_prefix_space"] or len(split) > 1:
            raise ValueError("not a byte-level tokenizer file of a known form")
        self.pattern: Callable[[str], list[str]] = regex.compile(split[0] if split else BYTE_LEVEL).findall
        self.normalize = self.tok.normalizer.normalize_str if self.tok.normalizer else str
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, names)) + ")").split if names else None
        self.letters = byte_letters()
        self.blank = self.letters[0x20]
        self.quick = not split or split[0] == BYTE_LEVEL

    def find(self, text: str) -> list[str]:
        """Pre-tokens of normalized text.  From U+20000 on, letters are still
        being assigned and libraries disagree: there the tokenizer's own
        splitter decides."""
        if self.quick and not _OTHER(text):
            return _QUICK(text)
        if text.isascii() or not _LATE(text):
            return self.pattern(text)
        return [text[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]

    def parts(self, text: str) -> Iterator[tuple[list[str], str | None]]:
        """(pre-tokens, the special string that follows or None) along the text."""
        if not any(name in text for name in self.special):
            yield self.find(self.normalize(text)), None
            return
        cut = self.cut(text)
        for i in range(0, len(cut), 2):
            yield self.find(self.normalize(cut[i])), cut[i + 1] if i + 1 < len(cut) else None

    def merged(self, piece: str) -> list[int]:
        """Token ids of one pre-token, merged by the library."""
        if piece.isascii() and piece.isprintable():  # of those bytes only the blank has another letter
            piece = piece.replace(" ", self.blank)
        else:
            piece = piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters)
        return [t.id for t in self.tok.model.tokenize(piece)]
