"""Secret scan: fixed patterns, and a lexer for assignments in source and configuration text.

The lexer looks for the head of a pair, a name and an assigning sign, and then reads the value in the state that
its first characters call for: a quoted string on one line, a string in back quotes or in three quotes
over several, a bare word, an indented block below ``name: |``, the text of an element or the ``value`` of an
attribute pair. Strings and names joined by a plus sign are one value. Comments are read like the rest, as secrets are
left behind in them.

Constants are carried from name to name in the order of the text (``b = a``). A value is known by the
counts of its characters, which add up where values are joined, so each is scored once, when it is bound, and a name
that refers to it costs the same however long it is. Its literals are marked once. A literal is reported if
a name that it reaches is sensitive enough for its shape.
"""

import hashlib
import math
import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from ridemetrics.llm.common import id_and_text, slices

# The three base patterns and the least length of a match.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_LEAST = 6
# Runs are maximal, so a least length in the pattern finds what dropping the shorter ones would.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "lexed")

# Words of a target name and what they say about the value.
NAME_SCORES = {
    "password": 3, "passwd": 3, "pwd": 3, "passphrase": 3, "secret": 3, "token": 2, "apikey": 3,
    "credential": 3, "credentials": 3, "private": 2, "auth": 1, "access": 1, "key": 1, "bearer": 2,
    "signing": 1, "encryption": 1, "salt": 1, "license": -1, "public": -2, "example": -2, "sample": -2,
    "placeholder": -3, "count": -3, "length": -3, "size": -3, "name": -2, "file": -2, "path": -2, "url": -1,
    "max": -2, "min": -2, "type": -2, "hint": -2, "label": -2, "field": -2,
}
LEAST_SCORE = 3.0

_NAME = r"[A-Za-z_$][A-Za-z0-9_$]*(?:[.\-][A-Za-z_$][A-Za-z0-9_$]*)*"
_ASSIGNS = r"(?::=|=>|=(?![=~>])|:(?![:/]))"
# A name and a sign that assigns; a name with a type in between (``name: str = ``) is one head.
_HEAD = re.compile(
    rf"""(?<![A-Za-z0-9_$.\-])(?P<quote>["']?)(?P<name>{_NAME})(?P=quote)[\x20\t]*{_ASSIGNS}"""
    rf"""(?:[\x20\t]*{_NAME}[\x20\t]*=(?![=~>]))?[\x20\t]*|<(?P<element>{_NAME})>"""
)
_QUOTED = r'"(?:[^"\\\n]|\\[^\n])*"|' + r"'(?:[^'\\\n]|\\[^\n])*'"
_THREE = r'"""(?:[^"\\]|\\.|"(?!""))*"""|' + r"'''(?:[^'\\]|\\.|'(?!''))*'''"
_TERM = re.compile(
    rf"(?:[rRbBfFuU]{{1,2}}(?=[\"']))?(?:(?P<three>{_THREE})|(?P<back>`[^`\\]*(?:\\.[^`\\]*)*`)|"
    rf"(?P<quoted>{_QUOTED})|(?P<bare>[A-Za-z0-9+/_.$=\-]+))",
    re.DOTALL,
)
# Between the terms of a sum; strings also stand side by side.
_PLUS = re.compile(r"[\x20\t]*\+\s*")
_SIDE = re.compile(r"[\x20\t]*(?=[\"'])")
_BLOCK = re.compile(r"[|>][+\-0-9]*[\x20\t]*\n(?P<indent>[\x20]+)(?=\S)")
_BLOCK_LINE = re.compile(r"(?P<indent>[\x20]*)(?P<line>[^\n]*)(?:\n|\Z)")
_ELEMENT = re.compile(r"(?P<text>[^<\n]+)</")
# Attributes whose value names what the next attribute holds.
_NAMING = frozenset(["key", "name", "id", "property"])
_HOLDING = re.compile(rf"""[\x20\t\n]+(?:value|content|default)[\x20\t]*=[\x20\t]*(?P<string>{_QUOTED})""")
_NAME_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_REFERENCE = re.compile(_NAME)
# Characters beyond ASCII are counted in so many classes.
_OTHER_CLASSES = 64


@lru_cache(4096)
def name_score(name: str) -> float:
    """How strongly a name announces a secret."""
    found = [w.lower() for w in _NAME_WORD.findall(name)]
    joined = [a + b for a, b in zip(found, found[1:])]
    return float(sum(NAME_SCORES.get(w, 0) for w in found + joined))


def _counts(value: str) -> Counter:
    found = Counter(value)
    if not value.isascii():
        for c in [c for c in found if c > "\x7f"]:
            found[chr(128 + ord(c) % _OTHER_CLASSES)] += found.pop(c)
    return found


def _shape_score(counts: Counter) -> float:
    n = sum(counts.values())
    if n < 6 or " " in counts or len(counts) < 4:
        return -3.0
    bits = -sum(c / n * math.log2(c / n) for c in counts.values())
    kinds = {"a" if "a" <= c <= "z" else "A" if "A" <= c <= "Z" else "0" if "0" <= c <= "9" else "-" for c in counts}
    return min(3.0, bits - 3.0 + 0.5 * (len(kinds) - 1))


def literal_score(value: str) -> float:
    """-3 to 3: bits per character and mixed classes speak for a secret, prose and placeholders against."""
    return _shape_score(_counts(value))


class _Value:
    """What a name is bound to: counts of its characters, its score, and the literals it is made of."""

    __slots__ = ("counts", "score", "pieces", "parts", "marked")

    def __init__(self, counts: Counter, pieces: list[tuple[int, int]], parts: tuple = ()):
        self.counts, self.pieces, self.parts = counts, pieces, parts
        self.score, self.marked = _shape_score(counts), False

    def mark(self, found: list) -> None:
        """Reports the literals, each once."""
        waiting = [self]
        while waiting:
            value = waiting.pop()
            if not value.marked:
                value.marked = True
                found.extend((a, 3, b) for a, b in value.pieces if b > a)
                waiting.extend(value.parts)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def lexed_spans(text: str) -> list[tuple[int, int, int]]:
    """Literals that reach a sensitive name; the span is the literal without its quotes.

    A sum is one value, and each of its literals is reported. A name may be assigned before or after it
    is used elsewhere; a reference takes the value its name has at that place. Takes time in proportion to the text.
    """
    if "=" not in text and ":" not in text and "</" not in text:
        return []
    constants: dict[str, _Value] = {}
    found: list[tuple[int, int, int]] = []
    at = 0
    while head := _HEAD.search(text, at):
        name, value, at = _read(text, head, constants)
        if value is None:
            continue
        constants[name] = value
        score = name_score(name)
        if score > 0 and score + value.score >= LEAST_SCORE:
            value.mark(found)
    return sorted(set(found))


def _read(text: str, head: re.Match, constants: dict[str, _Value]) -> tuple[str, _Value | None, int]:
    """Name, value and end of the pair that ``head`` begins; without a value it ends behind the head."""
    at = head.end()
    if head["element"] is not None:
        inside = _ELEMENT.match(text, at)
        if inside is None:
            return head["element"], None, at
        return head["element"], _Value(_counts(inside["text"]), [inside.span("text")]), inside.end("text")
    name = head["name"]
    if block := _BLOCK.match(text, at):
        return name, *_block(text, block)
    values, end = _sum(text, at, constants)
    if not values:
        return name, None, at
    if name.lower() in _NAMING and len(values) == 1 and (holding := _HOLDING.match(text, end)):
        a, b = values[0].pieces[0] if values[0].pieces else (at, end)
        start, stop = holding.span("string")
        return text[a:b], _Value(_counts(text[start + 1 : stop - 1]), [(start + 1, stop - 1)]), stop
    if len(values) == 1:
        return name, values[0], end
    return name, _Value(sum((v.counts for v in values), Counter()), [], tuple(values)), end


def _sum(text: str, at: int, constants: dict[str, _Value]) -> tuple[list[_Value], int]:
    """Literals and values of names from ``at`` on, up to where no sign or string goes on, and their end."""
    values = []
    while term := _TERM.match(text, at):
        at = term.end()
        kind = term.lastgroup
        if kind == "bare":
            word = term["bare"]
            # A name and the plus sign right behind it.
            if word.endswith("+") and text[at : at + 1] in ("'", '"', "`") and _REFERENCE.fullmatch(word[:-1]):
                word, at = word[:-1], at - 1
            plain = word.rstrip(".=-")
            known = constants.get(plain if _REFERENCE.fullmatch(plain) else word)
            values.append(known or _Value(_counts(word), [(term.start("bare"), term.start("bare") + len(word))]))
        else:
            quotes = 3 if kind == "three" else 1
            a, b = term.start(kind) + quotes, term.end(kind) - quotes
            values.append(_Value(_counts(text[a:b]), [(a, b)]))
        if plus := _PLUS.match(text, at):
            if not _TERM.match(text, plus.end()):
                break
            at = plus.end()
        elif kind != "bare" and (side := _SIDE.match(text, at)):
            at = side.end()
        else:
            break
    return values, at


def _block(text: str, block: re.Match) -> tuple[_Value, int]:
    """The indented lines below a block sign, joined; each line is a literal."""
    least, at = len(block["indent"]), block.start("indent")
    pieces, counts = [], Counter()
    while at < len(text) and (line := _BLOCK_LINE.match(text, at)):
        if line["line"].strip() and len(line["indent"]) < least:
            break
        if line["line"].strip():
            a = line.start("indent") + least
            b = a + len(text[a : line.end("line")].rstrip())
            pieces.append((a, b))
            counts.update(_counts(text[a:b]))
        at = line.end()
    return _Value(counts, pieces), at


def render(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


_COLUMNS = "doc_id long, n_assign long, n_access long, n_hex long, n_lexed long, base_sha256 string, spans string"


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: counts by kind, SHA-256 of the rendered base spans, and all spans.

    ``spans`` lists ``kind:start:end`` in code points, end exclusive, by start and then kind
    (assign, access, hex, lexed); ``base_sha256`` covers the first three. A span of a pattern is the
    whole match. The lexer only adds spans. Null text counts as empty; repeated rows and null ids
    are answered one by one; other columns are not read. A text is scanned as a whole, in time in
    proportion to it.
    """

    def scan(batches):
        for batch in slices(batches):
            rows = []
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                text = raw.decode()
                base = base_spans(text)
                lexed = lexed_spans(text)
                kinds = Counter(kind for _, kind, _ in base)
                digest = hashlib.sha256(render(base).encode()).hexdigest()
                rows.append((doc_id, kinds[0], kinds[1], kinds[2], len(lexed), digest, render(sorted(base + lexed))))
            types = [pa.int64()] * 5 + [pa.string()] * 2
            names = ["doc_id", "n_assign", "n_access", "n_hex", "n_lexed", "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return id_and_text(docs, id_col, text_col).mapInArrow(scan, _COLUMNS)
