"""Words of a printed or spoken sentence as tokens, for readers that go by words rather than by patterns of letters."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

_TOKEN = re.compile(r"\d+/\d+|\w+(?:[-/.]\w+)*|[^\w\s]")
_DOCUMENT = re.compile(r"\d{1,2}/\d{1,6}")


@dataclass(frozen=True)
class Token:
    text: str
    start: int
    end: int

    @property
    def low(self) -> str:
        return self.text.lower()

    @property
    def is_document(self) -> bool:
        return bool(_DOCUMENT.fullmatch(self.text))


def tokens(text: str) -> list[Token]:
    return [Token(m[0], m.start(), m.end()) for m in _TOKEN.finditer(text)]


def words(text: str) -> list[str]:
    """Lower-cased tokens."""
    return [t.low for t in tokens(text)]


def has(said: list[str], *sequence: str, within: int = 0) -> bool:
    """Whether the words of ``sequence`` are said in this order, with at most ``within`` others between two; ``x*`` is any word that begins so."""
    return at(said, *sequence, within=within) is not None


def at(said: list[str], *sequence: str, within: int = 0) -> int | None:
    """Where ``sequence`` begins."""
    for first in range(len(said)):
        k = first
        for n, wanted in enumerate(sequence):
            reach = range(k, min(len(said), k + 1 + (within if n else 0)))
            found = next((i for i in reach if fits(said[i], wanted)), None)
            if found is None:
                break
            k = found + 1
        else:
            return first
    return None


def fits(word: str, wanted: str) -> bool:
    return word.startswith(wanted[:-1]) if wanted.endswith("*") else word == wanted


def any_of(said: list[str], wanted: Iterable[str]) -> bool:
    """Whether any of the words or, written with blanks between, sequences is said."""
    return any(has(said, *w.split()) for w in wanted)


def documents(text: str) -> list[str]:
    """Document numbers in order."""
    return [t.text for t in tokens(text) if t.is_document]
