"""Secret scans: fixed patterns, and values in credential context that are dear to guess.

A value's guess cost is the cheapest way to put it together, in bits, found by dynamic
programming over its segmentations into dictionary words, dates, repeats, keyboard
walks, sequences and brute-force spans. A value next to a credential word that costs at
least ``MIN_BITS`` is a secret that the fixed patterns need not know.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map

#: Kinds in the order in which spans with the same start are listed.
KINDS = ("assign", "access", "hex", "guess")
MIN_BITS = 45.0

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
# Runs shorter than the least length are never part of a longer match, so the length can stand in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
CONTEXT = re.compile(
    r"""(?:(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|auth(?:entication|orization)?|bearer|credentials?"""
    r"""|(?:api|access|private|client|account|secret)[_-]?(?:key|secret|token))(?![A-Za-z])"""
    r"""["']?(?:\x20*(?:[:=]|=>|:=)|\x20+is\x20)\x20*["'(]?(?:(?:bearer|basic)\x20+["']?)?"""
    r"""|(?<![A-Za-z])(?:bearer|basic)\x20+["']?)([!#-&*-;=?-~]{6,})""",
    re.ASCII | re.IGNORECASE,
)
#: One of these is in every text that ASSIGN or CONTEXT can match.
_HINTS = ("pass", "pwd", "secret", "token", "key", "auth", "bearer", "basic", "credential")


# ---------------------------------------------------------------- guess cost

#: Passwords and words that every guesser tries first, most common first (fixed values).
COMMON = (
    "password passwd qwerty letmein welcome admin login master dragon monkey shadow sunshine princess football "
    "baseball iloveyou superman batman trustno starwars hello freedom whatever secret test changeme default guest "
    "root user example sample token null none true false undefined unknown required hidden redacted removed"
).split()

#: Rows of a keyboard, each shifted half a key against the one above (fixed values).
KEYBOARD = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")

_LEET = str.maketrans("013457@$", "oleastas")
_DATE = re.compile(
    r"(?:(?:19|20)\d\d([-/._]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01])"
    r"|(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d)"
)
_LONGEST_WORD = 24
_SEGMENT = 1.0  # bits for the choice of what comes next


@lru_cache(1)
def dictionary() -> dict[str, float]:
    """Bits of each word: common passwords by rank, then the words of a public vocabulary by rank."""
    import base64

    import public_tokenizers

    out = {w: math.log2(k + 2) for k, w in enumerate(COMMON)}
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        for line in f:
            raw, rank = line.split()
            w = base64.b64decode(raw).decode("latin-1").strip().lower()
            if w.isascii() and w.isalpha() and len(w) >= 3:
                out.setdefault(w, math.log2(int(rank) + len(COMMON) + 2))
    return out


@lru_cache(1)
def _beginnings() -> frozenset[str]:
    """What a word of the dictionary, read either way, can begin with, from three characters on."""
    return frozenset(x[:k] for w in dictionary() for x in (w, w[::-1]) for k in range(3, min(len(w), _LONGEST_WORD) + 1))


@lru_cache(1)
def _neighbours() -> dict[str, str]:
    out: dict[str, set[str]] = {}
    for r, row in enumerate(KEYBOARD):
        for c, key in enumerate(row):
            near = [(r, c - 1), (r, c + 1), (r - 1, c), (r - 1, c + 1), (r + 1, c - 1), (r + 1, c)]
            out[key] = {KEYBOARD[y][x] for y, x in near if 0 <= y < len(KEYBOARD) and 0 <= x < len(KEYBOARD[y])}
    return {k: "".join(sorted(v)) for k, v in out.items()}


def _alphabet(c: str) -> float:
    return math.log2(10 if c.isdigit() else 26 if c.isalpha() else 33)


class _Starts:
    """Starts of one stretch, of which the cheapest for an end is asked for, ends going up.

    A start costs its own price and the logarithm of its distance to the end. A later
    start is nearer, so its logarithm is smaller, but it grows faster: once an earlier
    start of a lower price has caught up, it stays ahead. So starts form a stack: the
    latest is on top until the one below it catches up.
    """

    __slots__ = ("price", "start", "until")

    def __init__(self) -> None:
        self.price: list[float] = []
        self.start: list[int] = []
        self.until: list[float] = []  # the end at which the start below catches up

    def clear(self) -> None:
        if self.price:
            self.price, self.start, self.until = [], [], []

    def add(self, price: float, start: int) -> None:
        while self.price:
            less = price - self.price[-1]
            if less <= 0:  # never dearer than the one before
                self._pop()
                continue
            # (end - before) / (end - start) falls to 2 ** less where the one before catches up
            ratio = 2.0**less - 1
            until = start + (start - self.start[-1]) / ratio if ratio else math.inf
            if until >= self.until[-1]:  # when that one is ahead again, one below it already is
                self._pop()
                continue
            break
        else:
            until = math.inf
        self.price.append(price)
        self.start.append(start)
        self.until.append(until)

    def _pop(self) -> None:
        self.price.pop()
        self.start.pop()
        self.until.pop()

    def cheapest(self, end: int) -> float:
        while end > self.until[-1]:
            self._pop()
        return self.price[-1] + math.log2(end - self.start[-1])


def guess_bits(value: str) -> float:
    """The least bits of any segmentation of ``value``; 0 for an empty one.

    Time grows with the length of the value: repeats, walks and sequences, which may be
    as long as the value, keep their starts in ``_Starts`` instead of trying each with each end.
    """
    n, low = len(value), value.lower()
    if len(low) != n:  # letters of other scripts whose lower case is longer
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in value)
    leet = low.translate(_LEET)
    words, begins = dictionary(), _beginnings()
    best = [0.0] + [math.inf] * n
    plain = [0.0]
    for c in value:
        plain.append(plain[-1] + _alphabet(c))
    upper = [0, *accumulate(map(str.isupper, value))]
    spelled = leet != low
    walks, sequences, repeats = _Walks(low), _Sequences(low), _Repeats(value, low, plain)
    # Brute force goes on from where it began: cheapest start so far, less what its characters up to there cost.
    brute = math.inf
    for i in range(n):
        if i >= 2:
            best[i] = min(best[i], walks.cost(i, best), sequences.cost(i, best), repeats.cost(i, best))
        brute = min(brute, best[i] + _SEGMENT - plain[i])
        best[i + 1] = min(best[i + 1], brute + plain[i + 1])
        here = best[i] + _SEGMENT
        straight, reads = True, spelled
        for j in range(i + 3, min(n, i + _LONGEST_WORD) + 1):
            part = low[i:j]
            straight = straight and part in begins
            reads = reads and leet[i:j] in begins
            if not (straight or reads):
                break
            bits, more = words.get(part) if straight else None, 0.0
            if bits is None and straight:
                bits, more = words.get(part[::-1]), 1.0
            if bits is None and reads and not part.isalpha():
                bits, more = words.get(leet[i:j]), 2.0
            if bits is not None:
                best[j] = min(best[j], here + bits + more + (_capitals(value[i:j]) if upper[j] > upper[i] else 0.0))
        if value[i].isdigit() and (m := _DATE.match(value, i)):
            best[m.end()] = min(best[m.end()], here + (math.log2(150) if m.end() - i == 4 else math.log2(150 * 365)) + 1)
    return min(best[n], walks.cost(n, best), sequences.cost(n, best), repeats.cost(n, best)) if n else 0.0


def _capitals(part: str) -> float:
    upper = sum(c.isupper() for c in part)
    if not upper:
        return 0.0
    if upper == len(part) or (upper == 1 and part[0].isupper()):
        return 1.0
    return math.log2(sum(math.comb(len(part), k) for k in range(1, min(upper, len(part) - upper) + 1)))


class _Walks:
    """Keyboard walks of three or more characters; a turn costs the choice of a neighbour."""

    def __init__(self, low: str):
        near = _neighbours()
        # The step to each character from the one before, -1 for none, and the turns up to it.
        self.step = [-1, *(near.get(a, "").find(b) for a, b in zip(low, low[1:], strict=False))]
        self.turns = [0] * len(low)
        for k in range(1, len(low)):
            self.turns[k] = self.turns[k - 1] + (self.step[k] != self.step[k - 1])
        self.starts = _Starts()

    def cost(self, end: int, best: list[float]) -> float:
        i = end - 3
        if i < 0 or self.step[end - 1] < 0 or self.step[end - 2] < 0:
            self.starts.clear()
            return math.inf
        turn = math.log2(6)
        self.starts.add(best[i] + _SEGMENT + math.log2(47) + turn * (1 - self.turns[i + 1]), i)
        return self.starts.cheapest(end) + turn * self.turns[end - 1]


class _Sequences:
    """Sequences of three or more characters (abc, 97531): steps of one or two, or none."""

    def __init__(self, low: str):
        self.low = low
        self.starts = _Starts()

    def cost(self, end: int, best: list[float]) -> float:
        i = end - 3
        if i < 0:
            return math.inf
        a, b, c = map(ord, self.low[i:end])
        if c - b != b - a or abs(b - a) > 2:
            self.starts.clear()
            return math.inf
        self.starts.add(best[i] + _SEGMENT + _alphabet(self.low[i]) + 2, i)
        return self.starts.cheapest(end)


class _Repeats:
    """Units of up to eight characters, repeated at least once."""

    #: For each size of unit, the largest sizes that divide it.
    INNER = {1: (), 2: (1,), 3: (1,), 4: (2,), 5: (1,), 6: (2, 3), 7: (1,), 8: (4,)}

    def __init__(self, value: str, low: str, plain: list[float]):
        self.low, self.plain = low, plain
        n = len(value)
        #: For each size of unit: up to which end the value repeats itself so far back.
        self.since = []
        for k in range(1, 9):
            since, at = [0] * (n + 1), 0
            for j in range(k, n):
                if value[j] != value[j - k]:
                    at = j + 1 - k
                since[j + 1] = at
            self.since.append(since)
        self.starts = [[_Starts() for _ in range(k)] for k in range(1, 9)]

    def cost(self, end: int, best: list[float]) -> float:
        found, words = math.inf, dictionary()
        for k in range(1, 9):
            i = end - 2 * k
            if i < 0:
                break
            starts = self.starts[k - 1][end % k]
            if self.since[k - 1][end] > i:
                starts.clear()
                continue
            unit, word = self.plain[i + k] - self.plain[i], words.get(self.low[i : i + k], math.inf) if k >= 3 else math.inf
            if word == math.inf and any(self.since[p - 1][i + k] <= i for p in self.INNER[k]):
                continue  # a unit that itself repeats a smaller one, which is cheaper to repeat
            unit = min(unit, word)
            starts.add(best[i] + _SEGMENT + unit, i)
            found = min(found, starts.cheapest(end) - math.log2(k) + 1)
        return found


# ---------------------------------------------------------------- spans


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns."""
    low = text.lower()
    out = []
    if any(h in low for h in _HINTS):
        out += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in ACCESS.finditer(text)]
    out += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def guess_spans(text: str, base: list[tuple[int, int, str]], min_bits: float) -> list[tuple[int, int, str]]:
    """Values in credential context that cost at least ``min_bits`` and that no span of ``base`` covers whole."""
    return [(a, b, "guess") for a, b, _ in dear_values(text, base, min_bits)]


def dear_values(text: str, base: list[tuple[int, int, str]], min_bits: float) -> list[tuple[int, int, float]]:
    """(start, end, bits) of ``guess_spans``; ``base`` is in the order of starts."""
    low = text.lower()
    if not any(h in low for h in _HINTS):
        return []
    starts = [a for a, _, _ in base]
    reach = list(accumulate((b for _, b, _ in base), max))
    out = []
    for m in CONTEXT.finditer(text):
        start, value = m.start(1), m[1].rstrip(").,;:!?")
        end = start + len(value)
        before = bisect_right(starts, start)
        if len(value) >= 6 and not (before and reach[before - 1] >= end) and (bits := guess_bits(value)) >= min_bits:
            out.append((start, end, bits))
    return out


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scan(docs: DataFrame, min_bits: float = MIN_BITS) -> DataFrame:
    """Secrets of each row of ``docs`` (doc_id, text), places in code points, ends exclusive.

    doc_id, n_assign, n_access, n_hex, base_sha256 (of the fixed patterns' spans, as
    ``kind:start:end`` by start, comma-joined), spans (all spans, likewise), n_guess, and
    max_guess_bits (the dearest value of an assignment or context; null without one).
    A null text is empty and has no spans. Repeated rows stay. Other columns are not looked at.
    """

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            out: dict[str, list] = {k: [] for k in names}
            for doc_id, text in zip(b["doc_id"], b["text"], strict=True):
                text = text or ""
                base = base_spans(text)
                dear = dear_values(text, base, min_bits)
                guess = [(a, z, "guess") for a, z, _ in dear]
                kinds = [k for _, _, k in base]
                bits = [guess_bits(ASSIGN.match(text, a)[2]) for a, _, k in base if k == "assign"] + [x for *_, x in dear]
                row = (
                    doc_id,
                    *(kinds.count(k) for k in KINDS[:3]),
                    hashlib.sha256(listed(base).encode()).hexdigest(),
                    listed(sorted(base + guess, key=lambda s: (s[0], KINDS.index(s[2])))),
                    len(guess),
                    max(bits, default=None),
                )
                for c, v in zip(names, row, strict=True):
                    out[c].append(v)
            yield out

    names = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess", "max_guess_bits")
    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long, max_guess_bits double"
    return arrow_map(docs.select("doc_id", "text"), rows, ddl)


def redacted(text: str, min_bits: float = MIN_BITS, mark: str = "[SECRET]") -> str:
    """``text`` with each secret, overlapping ones as one, replaced by ``mark``; the word that names an assignment stays."""
    base = base_spans(text)
    spans = []
    for a, b, k in base + guess_spans(text, base, min_bits):
        spans.append((ASSIGN.match(text, a).start(2) if k == "assign" else a, b))
    out, at = [], 0
    for a, b in sorted(spans):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, min_bits: float = MIN_BITS, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with secrets in ``text`` replaced by ``mark``; a column n_chars follows the text.

    Null stays null and an empty text empty; repeated rows stay; an empty table gives no
    rows; all other columns, whatever their names, go through as they are.
    """

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            yield b | {"text": [t if t is None else redacted(t, min_bits, mark) for t in b["text"]]}

    done = arrow_map(docs, rows, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        done = done.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(kind))
    return done
