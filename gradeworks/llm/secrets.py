"""Secret scan: plain patterns, and literals that reach names which speak of secrets.

The lexer reads assignments of source and configuration syntax (``name = "x"``, ``name: x``,
``"name": "x"``, ``name => x``, ``export NAME=x``), follows names that stand for literals,
joins of literals with ``+`` and ``${NAME}`` references, and scores each literal by the words of
the name that it reaches and by its own strength.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeworks.llm.common import arrow_schema, as_batch, map_batches

# The kinds and patterns that every scan reports.
KINDS = ("assign", "access", "hex", "literal")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Weights of the words of a target name; "key" counts only next to one of KEY_OWNERS.
NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.7, "secret": 1.0, "secrets": 0.9,
    "token": 0.9, "credential": 0.9, "credentials": 0.9, "auth": 0.6, "bearer": 0.8, "apikey": 1.0,
    "privatekey": 1.0, "secretkey": 1.0, "accesskey": 0.9,
}
KEY_OWNERS = {"api", "access", "private", "secret", "signing", "encryption", "master", "account"}
# Words in a name which say that the value is about a secret, not one.
HARMLESS = {"name", "type", "length", "len", "count", "url", "uri", "path", "file", "policy", "hint", "field", "expires", "expiry", "ttl", "id"}
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|<.*>|your[_-].*|change[_-]?me|example.*|placeholder|none|null|true|false|todo|redacted)$")
HINTS = ("pass", "pwd", "secret", "token", "key", "cred", "auth", "bearer")

# A name that does not start inside a longer one, an operator, and what follows on the line.
PAIR = re.compile(r"""(?<![\w.$-])["']?([A-Za-z_][\w.-]*+)["']?[ \t]*+(?::=|=>|=(?![=>])|:(?![:/]))[ \t]*+(?=\S)""")
TERM = re.compile(
    r'''"(?P<double>[^"\\\n]*(?:\\.[^"\\\n]*)*)"|'(?P<single>[^'\\\n]*(?:\\.[^'\\\n]*)*)'|\$\{?(?P<ref>[A-Za-z_]\w*)\}?|(?P<bare>[A-Za-z0-9_+/.=~!@%^&*-]+)'''
)
JOIN = re.compile(r"\s*+\+\s*+(?=[\"'$A-Za-z_])")
WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
IDENTIFIER = re.compile(r"[A-Za-z_]\w*\Z")
MIN_LITERAL, MIN_SCORE = 8, 1.5
BEGIN = 64  # characters kept of a value
LONGEST = 1 << 50
LONG_PLACEHOLDER = re.compile(r"(?i)(?:your[_-]|example)")

SCHEMA = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"

Span = tuple[int, str, int]


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind, as (start, kind, end) in code points."""
    found: list[Span] = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS) or not text.isascii():
        # every match is taken before short values go, since a short one still covers its text
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return found


def name_weight(name: str) -> float:
    """How strongly a target name says that its value is a secret, 0 to 1."""
    words = [w.lower() for w in WORDS.findall(name)]
    if not words or words[-1] in HARMLESS:
        return 0.0
    weight = max((NAME_WEIGHTS.get(w, 0.0) for w in words), default=0.0)
    if "key" in words and KEY_OWNERS & set(words):
        weight = max(weight, 1.0)
    return weight


class Tally:
    """Length, character counts and beginning of a text, as it grows; entropy is read off without the text.

    Characters are counted by their last 12 bits, so that a tally is of bounded size.
    """

    __slots__ = ("begin", "counts", "kinds", "last", "length", "weighted")

    def __init__(self) -> None:
        self.counts: dict[int, int] = {}
        self.length, self.weighted = 0, 0.0  # weighted: the sum of n * log2(n) over the counts
        self.begin, self.last = "", ""
        self.kinds = [False] * 4  # lower, upper, digit, none of letters and digits

    def copy(self) -> Tally:
        out = Tally()
        out.counts, out.kinds = dict(self.counts), list(self.kinds)
        out.length, out.weighted, out.begin, out.last = self.length, self.weighted, self.begin, self.last
        return out

    def _count(self, code: int, more: int) -> None:
        n = self.counts.get(code, 0)
        self.counts[code] = n + more
        self.weighted += (n + more) * math.log2(n + more) - (n * math.log2(n) if n else 0.0)

    def add_text(self, text: str) -> None:
        for char, more in Counter(text).items():
            self._count(ord(char) & 4095, more)
            for i, test in enumerate((str.islower, str.isupper, str.isdigit)):
                self.kinds[i] |= test(char)
            self.kinds[3] |= not char.isalnum()
        self._join(len(text), text[:BEGIN], text[-1:])

    def add(self, other: Tally) -> None:
        if self.length >= LONGEST:
            # a value that doubles at every step; its score has long stood still
            return
        for code, more in other.counts.items():
            self._count(code, more)
        self.kinds = [a or b for a, b in zip(self.kinds, other.kinds, strict=True)]
        self._join(other.length, other.begin, other.last)

    def _join(self, length: int, begin: str, last: str) -> None:
        if len(self.begin) == self.length:
            self.begin = (self.begin + begin)[:BEGIN]
        self.length += length
        self.last = last or self.last

    def is_placeholder(self) -> bool:
        if self.length <= BEGIN:
            return bool(PLACEHOLDER.match(self.begin))
        # longer ones are runs of one mark, or told by their ends
        run = self.counts.keys() <= {ord("x"), ord("X")} or self.counts.keys() in ({ord("*")}, {ord(".")})
        return run or bool(LONG_PLACEHOLDER.match(self.begin)) or (self.begin[0] == "<" and self.last == ">")

    def strength(self) -> float:
        """Entropy in bits per character, up to 4, scaled to 0..1, plus shares for length and kinds of characters."""
        if self.length < MIN_LITERAL or self.is_placeholder():
            return 0.0
        entropy = math.log2(self.length) - self.weighted / self.length
        return min(entropy, 4.0) / 4.0 + min(self.length, 32) / 64.0 + 0.1 * (sum(self.kinds) - 1)


class Value:
    """What a name stands for: spans of literals and values of names, in order.

    ``holds`` tells that a secret is somewhere in it; whoever uses a value learns of it through ``users``.
    """

    __slots__ = ("holds", "parts", "secret", "tally", "users")

    def __init__(self, parts: list[tuple[int, int] | Value], tally: Tally):
        self.parts, self.tally = parts, tally
        self.users: list[Value] = []
        self.secret = False
        self.holds = False
        for part in parts:
            if isinstance(part, Value):
                part.users.append(self)
                self.holds |= part.secret or part.holds

    def reveal(self) -> list[tuple[int, int]]:
        """Mark the value and all in it as secret, and give the spans that were not so before."""
        spans, stack = [], [self]
        self.secret = True
        while stack:
            value = stack.pop()
            value._tell()
            for part in value.parts:
                if not isinstance(part, Value):
                    spans.append(part)
                elif not part.secret:
                    part.secret = True
                    stack.append(part)
        return spans

    def _tell(self) -> None:
        stack = [self]
        while stack:
            for user in stack.pop().users:
                if not user.holds:
                    user.holds = True
                    stack.append(user)


def assigned_literals(text: str) -> Iterator[tuple[str, Value]]:
    """(target name, its value), in text order.

    A name is known by its last assignment before its use. A value joined from literals and
    names holds all of them; a join may go on over line breaks, but not into another assignment.
    """
    known: dict[str, Value] = {}
    at = 0
    while m := PAIR.search(text, at):
        at = m.end()
        parts: list[tuple[int, int] | Value] = []
        place, broken = m.end(), False
        while t := TERM.match(text, place):
            place = t.end()
            kind = t.lastgroup
            if kind in ("double", "single"):
                parts.append(t.span(kind))
            elif kind == "ref":
                if t["ref"] in known:
                    parts.append(known[t["ref"]])
            elif IDENTIFIER.match(t["bare"]) and t["bare"] in known:
                parts.append(known[t["bare"]])
            elif not broken:
                # after a line break a bare word is a name, not a literal
                parts.append(t.span("bare"))
            if not (j := JOIN.match(text, place)):
                break
            place, broken = j.end(), "\n" in j[0] or "\r" in j[0]
            if broken and PAIR.match(text, place):
                break
        # a value may itself begin an assignment (a: b=c), so the search goes on right after the operator
        if parts:
            known[m[1]] = Value(parts, _tally(text, parts, known.get(m[1])))
            yield m[1], known[m[1]]


def _tally(text: str, parts: list[tuple[int, int] | Value], replaced: Value | None) -> Tally:
    """The tally of all parts on end; that of the value which the new one replaces is taken over, not copied."""
    first = parts[0]
    if isinstance(first, Value):
        own = first is replaced and sum(part is first for part in parts) == 1
        out, rest = first.tally if own else first.tally.copy(), parts[1:]
    else:
        out, rest = Tally(), parts
    for part in rest:
        if isinstance(part, Value):
            out.add(part.tally)
        else:
            out.add_text(text[part[0] : part[1]])
    return out


def literal_spans(text: str) -> list[Span]:
    """Spans of literals that reach a sensitive name and are strong enough together, or hold such a value.

    Takes time in proportion to the text, however values build on each other.
    """
    if not ("=" in text or ":" in text):
        return []
    low = text.lower()
    if not any(h in low for h in HINTS):
        return []
    found: set[Span] = set()
    for name, value in assigned_literals(text):
        weight = name_weight(name)
        if weight and (value.holds or weight + value.tally.strength() >= MIN_SCORE):
            found.update((s, "literal", e) for s, e in value.reveal() if e > s)
    return sorted(found)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]), s[2])))


def scan_text(text: str | None) -> tuple[int, int, int, str, str]:
    text = text or ""
    base = base_spans(text)
    n = Counter(kind for _, kind, _ in base)
    digest = hashlib.sha256(joined(base).encode()).hexdigest()
    return n["assign"], n["access"], n["hex"], digest, joined(base + literal_spans(text))


def find_secrets(docs: DataFrame) -> DataFrame:
    """Spans of secrets in every whole text of ``docs`` (doc_id, text), one row per row.

    A null text is empty; a null id is kept; repeated rows give repeated rows; other columns are
    left out. A text without secrets has zero counts and an empty list. Narrow: no row moves.
    """
    schema = arrow_schema(SCHEMA)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            yield as_batch(((i, *scan_text(t)) for i, t in zip(ids, texts, strict=True)), schema)

    return map_batches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), scan, SCHEMA)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every found span of its text replaced by ``[SECRET]``, all columns kept.

    Overlapping spans are replaced as one. ``n_chars``, where there is one, follows the new text.
    Texts without secrets, null texts and every other column stay as they are.
    """

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = [None if t is None else redacted(t) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    out = map_batches(docs, clean, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return out


def redacted(text: str, mark: str = "[SECRET]") -> str:
    parts, at, until = [], 0, 0
    spans = sorted((s, e) for s, _, e in base_spans(text) + literal_spans(text))
    while at < len(spans):
        start, end = spans[at]
        while at + 1 < len(spans) and spans[at + 1][0] < end:
            at += 1
            end = max(end, spans[at][1])
        parts += [text[until:start], mark]
        until, at = end, at + 1
    return "".join([*parts, text[until:]])
