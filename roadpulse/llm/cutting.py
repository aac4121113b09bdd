"""Cutting text into pre-tokens as the tokenizer libraries do."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import regex


@lru_cache(maxsize=1)
def newer_letters() -> regex.Pattern:
    """Letters and numbers that the regular-expression module knows, but the libraries' older Unicode tables do not."""
    from tokenizers.pre_tokenizers import ByteLevel

    library = ByteLevel(add_prefix_space=False, use_regex=True)
    every = "".join(chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000)
    found = [c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn"]
    runs: list[list[int]] = []
    for c in map(ord, (c for c in found if library.pre_tokenize_str(f"a{c}!")[-1][1] == (1, 3))):
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return regex.compile("[" + "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in runs) + "]" if runs else r"(?!)")


def early(text: str) -> bool:
    """Whether all characters are among the first 256, where the tables agree."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Cutter:
    """Finds all pre-tokens of a pattern; newer letters count as symbols, as they do in the libraries."""

    def __init__(self, pattern: str) -> None:
        self.pattern = regex.compile(pattern)

    def __call__(self, text: str) -> list[str]:
        if text.isascii() or early(text) or not newer_letters().search(text):
            return self.pattern.findall(text)
        plain = newer_letters().sub("", text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(plain)]
