"""Access to public tokenizer files inside tasks, and units a text may safely be cut into."""

from __future__ import annotations

import hashlib
import re
from pathlib import Path

from tokenizers import Tokenizer

# Units a worker remembers before it starts again (some 150 bytes each).
MEMO_UNITS = 250_000


def load(path: str) -> Tokenizer:
    """The tokenizer without truncation or padding."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def version(path: str) -> str:
    """A digest of the tokenizer file, which names its version."""
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


_DOUBTFUL = re.compile(r"[ ](?=\s|\Z)")


def space_led(text: str) -> list[str]:
    """Cut before each space that a non-space follows.

    A byte-level tokenizer begins a piece at every such space, whatever stands before it, so
    the units are encoded alone as they are in the text.
    """
    words = text.split(" ")
    if _DOUBTFUL.search(text) is None:
        return [words[0], *[" " + w for w in words[1:]]] if words[0] else [" " + w for w in words[1:]]
    units = [words[0]]
    for word in words[1:]:
        if word and not word[0].isspace():
            units.append(" " + word)
        else:
            units[-1] += " " + word
    return units if units[0] else units[1:]
