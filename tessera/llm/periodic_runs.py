"""Periodic runs of words by bit-parallel lags.

The ids of a text's words are laid out as bit planes, one big integer for each bit of an
id. At lag p, the planes XORed with themselves shifted by p, ORed together, have a one
wherever words p apart differ; a long stretch of zeros is a stretch of words with period p. ANDs of
the matches with themselves, shifted by doubling steps, leave only the places from which enough
matches follow.

Lags are taken in octaves, [2**k, 2**(k + 1)). A word whose next occurrence is further away
than an octave's largest lag matches at none of its lags, so planes are only made for the
stretches between such words that are long enough, which are few and short in prose. The inside of a run that
has been found can be in no run of a longer period (two runs of periods p and q share fewer
than p + q words) and is left out of the octaves that follow.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from fractions import Fraction
from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame

from tessera.llm.common import arrow_map

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_ONES = re.compile("1+")

#: A run has this many periods at least, and as many words.
PERIODS, LEAST_WORDS = 4, 6
#: Planes of a lag that are looked at before the others: most lags end there.
FIRST_PLANES = 4

Run = tuple[int, int, int]  # start, end, period


def rewritten(words: list[str], doc_id: int | None) -> list[str]:
    """In a tenth of the documents, chosen by the id's crc32, the words from some place on become a repetition of the first of them."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    times = -(-(n - a) // p)
    return words[:a] + (words[a : a + p] * times)[: n - a]


def numbered(words: list[str]) -> np.ndarray:
    """Ids from 0 in the order of first occurrence."""
    ids: dict[str, int] = {}
    return np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)


def next_distances(ids: np.ndarray) -> np.ndarray:
    """How far the next occurrence of each word is; the text's length where there is none."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    out = np.full(n, n, np.int64)
    again = ids[order[1:]] == ids[order[:-1]]
    out[order[:-1][again]] = np.diff(order)[again]
    return out


def planes(ids: np.ndarray) -> list[int]:
    """Bit k of every id as a big integer, the first word lowest."""
    bits = int(ids.max(initial=0)).bit_length()
    return [int.from_bytes(np.packbits((ids >> k & 1).astype(np.uint8), bitorder="little").tobytes(), "little") for k in range(bits)]


def matches_from(matches: int, least: int) -> int:
    """The bits from which at least ``least`` ones follow, themselves included."""
    have = 1
    while have < least and matches:
        step = min(have, least - have)
        matches &= matches >> step
        have += step
    return matches


def stretches(bit_planes: list[int], lag: int, places: int, least: int) -> list[tuple[int, int]]:
    """(start, end) of the maximal stretches of at least ``least`` of the first ``places`` words that equal those ``lag`` later."""
    full, differ, starts = (1 << places) - 1, 0, 0
    for some in (bit_planes[:FIRST_PLANES], bit_planes[FIRST_PLANES:]):
        for plane in some:
            differ |= plane ^ (plane >> lag)
        starts = matches_from(full & ~differ, least)
        if not starts:
            return []
    return [(m.start(), m.end() + least - 1) for m in _ONES.finditer(bin(starts)[:1:-1])]


def needed(lag: int) -> int:
    """Matches in a row at ``lag`` that make a run."""
    return max(PERIODS * lag, LEAST_WORDS) - lag


def _segments(open_: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """(start, end) of the stretches of at least ``least`` true places."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], open_, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return zip(starts[long].tolist(), ends[long].tolist(), strict=True)


def runs(ids: np.ndarray) -> list[Run]:
    """All runs of a text, by start, then period."""
    n = len(ids)
    if n < LEAST_WORDS:
        return []
    distance = next_distances(ids)
    found: dict[tuple[int, int], int] = {}
    first = 1
    while PERIODS * first <= n:
        last = 2 * first - 1
        inside = distance <= last
        least = min(needed(p) for p in (first, last))
        if np.count_nonzero(inside) >= least:
            for (s, e), q in found.items():
                inside[s + last + q : max(e - last - q, 0)] = False
            for a, b in _segments(inside, least):
                longest = min(last, max((b - a) // (PERIODS - 1), first))
                bit_planes = planes(ids[a : min(n, b + longest)])
                for p in range(first, longest + 1):
                    for s, e in stretches(bit_planes, p, min(b, n - p) - a, needed(p)):
                        found.setdefault((a + s, a + e + p), p)  # a stretch found before has that, smaller, period
        first *= 2
    return sorted((s, e, p) for (s, e), p in found.items())


def strongest(found: list[Run]) -> Run | None:
    """The run with the most periods, exactly compared; ties go to the smallest start, then period."""
    if not found:
        return None
    near = max((e - s) / p for s, e, p in found) * (1 - 1e-12)
    return min((r for r in found if (r[1] - r[0]) / r[2] >= near), key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]))


def collapsed(words: list[str], found: list[Run]) -> list[str]:
    """The words without what repeats a run's first period."""
    if not found:
        return words
    gone = np.zeros(len(words), bool)
    for s, e, p in found:
        gone[s + p : e] = True
    return [words[k] for k in np.flatnonzero(~gone)]


def detect(docs: DataFrame) -> DataFrame:
    """Periodic runs of each row of ``docs`` (doc_id, text), and a digest of the text without repetitions.

    Gives doc_id, n_runs, the strongest run's start, length, period and exponent_milli
    (nulls without a run), runs_sha256, collapsed_sha256, n_words and n_dropped. Null and
    empty texts have no words. A null doc_id is never rewritten (see ``rewritten``).
    Repeated rows stay, each with its own result; other columns are not looked at. Time is
    about linear for prose; a text of n words from a handful of different ones takes n * n / 3 bits of work.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"""doc_id {kind}, n_runs long, start long, length long, period long, exponent_milli long,
              runs_sha256 string, collapsed_sha256 string, n_words long, n_dropped long"""
    digest = lambda s: sha256(s.encode()).hexdigest()

    def of(doc_id: int | None, text: str | None) -> tuple:
        words = rewritten(_WORD.findall(text or ""), doc_id)
        found = runs(numbered(words))
        kept = collapsed(words, found)
        best = strongest(found)
        s, e, p = best or (None, None, None)
        figures = (s, e - s, p, 1000 * (e - s) // p) if best else (None,) * 4
        listed = "".join(f"{s},{e - s},{p}\n" for s, e, p in found)
        return doc_id, len(found), *figures, digest(listed), digest(" ".join(kept)), len(words), len(words) - len(kept)

    names = [x.split()[0] for x in ddl.split(",")]

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            each = [of(i, t) for i, t in zip(b["doc_id"], b["text"], strict=True)]
            yield dict(zip(names, zip(*each, strict=True), strict=True)) if each else {n: [] for n in names}

    return arrow_map(docs.select("doc_id", "text"), rows, ddl)
