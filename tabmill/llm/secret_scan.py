"""Secrets in texts: fixed patterns, and literals that reach a sensitive name by assignment.

Texts that hold an assignment mark are lexed into strings (also of three quotes
or backticks), names, bare values, brackets and marks. Each `name = expression` (also `:`, `:=`, `=>`; an
expression is strings, bare values, names, lists and calls joined by `+`, or an
indented block, and may go on over lines) becomes a pair of a name and its
literals. A subscript stands for the name inside of it. A name on the right stands for the literals last given to it in the
same text, so constants are propagated. A literal is scored by how sensitive
the names are that it reaches and by how much it looks like a key.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.llm.shared import for_workers

KINDS = ("assign", "access", "hex", "literal")
MASK = "[secret]"
LEAST_LITERAL = 8
THRESHOLD = 0.5

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")

# How surely a part of a name tells of a secret. A name's score is that of its strongest part or run of parts.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "bearer": 0.9, "privatekey": 1.0, "secretkey": 1.0, "accesskey": 1.0,
    "signingkey": 0.9, "encryptionkey": 0.9, "authkey": 0.9, "authorization": 0.8, "auth": 0.7, "pass": 0.7, "signature": 0.5,
}
#: Whole values that are made of such words only.
_PLACEHOLDER = re.compile(
    r"(?i)(?:(?:change.?me|example|placeholder|please|your|here|my|the|insert|replace|enter|password|passwd|secret|token|api|key|value|test|dummy|sample|todo|x{3,}|\*{3,})[-_. ]*[0-9]{0,3}[-_. ]*)+"
    r"|<.*>|\$\{.*\}|\{\{.*\}\}|(.)\1*", re.S)  # fmt: skip
_LEX = re.compile(
    r"(?P<block>\"\"\"(?s:[^\\]|\\.)*?\"\"\"|'''(?s:[^\\]|\\.)*?''')"
    r"""|(?P<string>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)"""
    r"|(?P<word>[A-Za-z0-9_$][A-Za-z0-9_$+/.=-]*)"
    r"|(?P<mark>:=|=>|==|!=|<=|>=|[=:+])"
    r"|(?P<next>\\\n)|(?P<line>\n)"
    # An escaped quote outside of a string opens none.
    r"|(?P<other>\\.|[^\x20\t])", re.A)  # fmt: skip
_NAME = re.compile(r"[A-Za-z_$][A-Za-z0-9_$]*(?:[.-][A-Za-z0-9_$]+)*", re.A)
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+", re.A)
_BLANKS = re.compile(r"[\x20\t]*")
_SCHEMES = {"bearer", "basic", "token"}


@dataclass(frozen=True)
class Span:
    """Code points start to end; value_start to value_end is the part to hide."""

    start: int
    end: int
    kind: str
    value_start: int
    value_end: int


def name_score(name: str) -> float:
    parts = [p.lower() for p in _PARTS.findall(name)]
    best = 0.0
    for at, part in enumerate(parts):
        joined = part + parts[at + 1] if at + 1 < len(parts) else part
        best = max(best, SENSITIVE.get(part, 0), SENSITIVE.get(joined, 0))
    return best


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, leftmost first and without overlap within a kind."""
    out = []
    if ":" in text or "=" in text:
        out += [Span(m.start(), m.end(), "assign", *m.span(2)) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_LITERAL]
    if "AKIA" in text:
        out += [Span(*m.span(), "access", *m.span()) for m in _ACCESS.finditer(text)]
    return out + [Span(*m.span(), "hex", *m.span()) for m in _HEX.finditer(text)]


def _lexed(text: str) -> list[tuple[str, str, int, int]]:
    """Tokens (kind, text, start, end) of the text, with a mark for each end of a line; start and end leave quotes out.

    A backslash before the end of a line continues it.
    """
    tokens = []
    for m in _LEX.finditer(text):
        kind, start, end = m.lastgroup, m.start(), m.end()
        if kind in ("string", "block"):
            quote = 3 if kind == "block" else 1
            tokens.append(("string", m[0][quote:-quote], start + quote, end - quote))
        elif kind == "word":
            tokens += _split_word(m[0], start)
        elif kind == "line":
            tokens.append((kind, "", start, start))
        elif kind != "next":
            tokens.append((kind, m[0], start, end))
    tokens.append(("line", "", len(text), len(text)))
    return tokens


def _closings(tokens: list[tuple[str, str, int, int]]) -> dict[int, int]:
    """Place of each opening bracket to that of its closing one."""
    out, open_ = {}, []
    for i, (kind, mark, _, _) in enumerate(tokens):
        if kind == "other" and mark in "([{":
            open_.append(i)
        elif kind == "other" and mark in ")]}" and open_ and tokens[open_[-1]][1] + mark in ("()", "[]", "{}"):
            out[open_.pop()] = i
    return out


def _split_word(word: str, start: int) -> list[tuple[str, str, int, int]]:
    """`name=value` without blanks is a name, a mark and a bare value; else the word is a name or a bare value."""
    name = _NAME.match(word)
    if name and name.end() < len(word) and word[name.end()] == "=" and name.end() + 1 < len(word):
        cut, value = start + name.end(), word[name.end() + 1 :]
        return [("name", name[0], start, cut), ("mark", "=", cut, cut + 1), ("name" if _NAME.fullmatch(value) else "bare", value, cut + 1, start + len(word))]
    if name and name.end() == len(word) - 1 and word[-1] == "=":
        return [("name", name[0], start, start + name.end()), ("mark", "=", start + name.end(), start + len(word))]
    return [("name" if name and name.end() == len(word) else "bare", word, start, start + len(word))]


_PAIR = ("=", ":", ":=", "=>")
_SHORT = 256  # characters up to which a joined string is kept as such

_DIGIT, _LOWER, _UPPER, _OTHER, _SPACE_IN, _MARK_IN = (1 << i for i in range(6))
_FLAGS = [(_DIGIT, re.compile("[0-9]")), (_LOWER, re.compile("[a-z]")), (_UPPER, re.compile("[A-Z]")), (_OTHER, re.compile("[^0-9A-Za-z]")), (_SPACE_IN, re.compile(r"\s")), (_MARK_IN, re.compile(r"[^0-9A-Za-z\s.,:!?'()-]"))]


@dataclass(frozen=True)
class Shape:
    """What a string's score depends on. Shapes of joined strings follow from those of their parts, however long they are."""

    length: int
    counts: Counter
    flags: int
    placeholder: bool
    text: str | None  # of short strings

    @staticmethod
    def of(text: str) -> Shape:
        flags = sum(flag for flag, pattern in _FLAGS if pattern.search(text))
        return Shape(len(text), Counter(text), flags, bool(_PLACEHOLDER.fullmatch(text)), text if len(text) <= _SHORT else None)

    @staticmethod
    def joined(parts: list[Shape]) -> Shape:
        """A joined string is a placeholder if all its parts are, or, where it is short, if it is one itself."""
        if len(parts) == 1:
            return parts[0]
        length, counts, flags = sum(p.length for p in parts), Counter(), 0
        for p in parts:
            counts.update(p.counts)
            flags |= p.flags
        text = "".join(p.text for p in parts) if length <= _SHORT and all(p.text is not None for p in parts) else None
        return Shape(length, counts, flags, all(p.placeholder for p in parts) or (text is not None and bool(_PLACEHOLDER.fullmatch(text))), text)

    def score(self, phrase: bool = False) -> float:
        """0 to 1: short values and placeholders score 0, varied ones with several kinds of characters 1.

        Words with blanks are prose, unless the name asks for a phrase or they
        hold digits and other marks as connection strings do.
        """
        if self.length < LEAST_LITERAL or self.placeholder:
            return 0.0
        if not phrase and self.flags & _SPACE_IN and not (self.flags & _DIGIT and self.flags & _MARK_IN):
            return 0.0
        if bin(self.flags & (_DIGIT | _LOWER | _UPPER | _OTHER)).count("1") < 2:
            return 0.0
        shares = [n / self.length for n in self.counts.values()]
        entropy = -sum(x * math.log2(x) for x in shares if x)
        return min(1.0, entropy / 3) * (1.0 if self.flags & _DIGIT else 0.6)


def literal_score(value: str, phrase: bool = False) -> float:
    return Shape.of(value).score(phrase)


class _Reader:
    """Values behind assignment marks, as nodes of a graph.

    A node is a place in the text, a string joined from nodes, or a list of
    strings. A name stands for the node that it got last: nodes are shared,
    never copied, so a text takes as many as it has tokens, however its names
    refer to each other. Nodes come after those they are made of.
    """

    def __init__(self, text: str) -> None:
        self.text, self.tokens = text, _lexed(text)
        self.closing = _closings(self.tokens)
        self.known: dict[str, int] = {}
        self.nodes: list[tuple[str, list[int] | tuple[int, int]]] = []
        self.starts = [0, *(m.end() for m in re.finditer("\n", text))]

    def node(self, kind: str, of) -> int:
        self.nodes.append((kind, of))
        return len(self.nodes) - 1

    def place(self, start: int, end: int) -> int:
        return self.node("place", (start, end))

    def list_of(self, elements: list[list[int]]) -> int | None:
        """A list node of joined strings, or none for an empty list."""
        strings = [e[0] if len(e) == 1 and self.nodes[e[0]][0] != "list" else self.node("string", e) for e in elements if e]
        return self.node("list", strings) if strings else None

    def is_(self, j: int, kind: str, *marks: str) -> bool:
        return j < len(self.tokens) and self.tokens[j][0] == kind and (not marks or self.tokens[j][1] in marks)

    def indent(self, at: int) -> int:
        """Column of the first name of a line: behind its blanks, and behind the dash of an item that comes before the place."""
        start = self.starts[bisect_right(self.starts, at) - 1]
        column = _BLANKS.match(self.text, start).end()
        while column < at and self.text[column] == "-":
            column = _BLANKS.match(self.text, column + 1).end()
        return column - start

    def after_lines(self, j: int) -> int:
        while self.is_(j, "line"):
            j += 1
        return j

    def elements(self, first: int, last: int) -> int | None:
        """Elements between brackets, without those that are pairs themselves or names of settings."""
        out, element, pair, j = [], [], False, first
        while j <= last:
            kind, value, start, end = self.tokens[j]
            if kind == "other" and j in self.closing and (pair or value == "{"):
                j = self.closing[j]
            elif kind == "other" and value in ",;()[]":
                if element and not pair:
                    out.append(element)
                element, pair = [], False
            elif kind == "mark" and value in _PAIR:
                pair = True
            elif kind == "name" and value in self.known:
                element.append(self.known[value])
            elif kind in ("string", "bare") and not (_NAME.fullmatch(value) and name_score(value)):
                element.append(self.place(start, end))
            j += 1
        return self.list_of(out)

    def block(self, j: int, indent: int, items: bool) -> int | None:
        """Lines (or items behind `-`) that are indented deeper than their key, or as deep for items."""
        out, j = [], self.after_lines(j)
        while j < len(self.tokens):
            end = j
            while not self.is_(end, "line"):
                end += 1
            deep = self.indent(self.tokens[j][2])
            if deep < indent + (not items) or (items and not self.is_(j, "other", "-")):
                break
            j += items
            if end > j and not any(self.is_(k, "mark", *_PAIR) for k in range(j, end)):
                out.append([self.place(self.tokens[j][2], self.tokens[end - 1][3])])
            j = self.after_lines(end)
        return self.list_of(out)

    def value(self, j: int, indent: int) -> int | None:
        """List node of the value from token j on."""
        if self.is_(j, "other", "|", ">"):
            while not self.is_(j, "line"):
                j += 1
            return self.block(j, indent, False)
        if self.is_(j, "line"):
            k = self.after_lines(j)
            if self.is_(k, "other", "-"):
                return self.block(j, indent, True)
            # On a line of its own, the value is deeper than its name.
            if k >= len(self.tokens) or self.indent(self.tokens[k][2]) <= indent or self.is_(k + 1, "mark", *_PAIR):
                return None
            j = k
        if self.is_(j, "name") and self.tokens[j][1].lower() in _SCHEMES and j + 1 < len(self.tokens) and self.tokens[j + 1][0] in ("name", "bare"):
            j += 1
        parts: list[int | None] = []
        while j < len(self.tokens):
            kind, value, start, end = self.tokens[j]
            opened = j + 1 if kind == "name" and self.is_(j + 1, "other", "(", "[") else j
            if opened in self.closing and self.is_(opened, "other", "(", "["):
                parts.append(self.elements(opened + 1, self.closing[opened]))
                j = self.closing[opened]
            elif kind == "name" and value in self.known:
                parts.append(self.known[value])
            elif kind in ("string", "bare", "name"):
                parts.append(self.place(start, end))
            else:
                break
            j += 1
            # Strings side by side are one, unless the second is the name of a pair.
            if kind == "string" and self.is_(j, "string") and not self.is_(j + 1, "mark", *_PAIR):
                continue
            plus = self.after_lines(j)
            if not self.is_(plus, "mark", "+"):
                break
            j = self.after_lines(plus + 1)
        found = [p for p in parts if p is not None]
        if len(parts) == 1 and found and self.nodes[found[0]][0] == "list":
            return found[0]
        return self.list_of([found])

    def named_value(self, i: int, mark: int) -> tuple[str, int] | None:
        """(name, token of its value) of `name = "NAME", value = ...`, as in settings of XML, JSON and YAML."""
        if self.tokens[i][1].lower() not in ("key", "name") or mark + 1 >= len(self.tokens) or self.tokens[mark + 1][0] not in ("string", "name"):
            return None
        j = mark + 2
        while self.is_(j, "line") or self.is_(j, "other", ","):
            j += 1
        if j + 2 < len(self.tokens) and self.tokens[j][0] in ("string", "name") and self.tokens[j][1].lower() == "value" and self.is_(j + 1, "mark", *_PAIR):
            return self.tokens[mark + 1][1], j + 2
        return None


def assignments(reader: _Reader) -> Iterator[tuple[str, int]]:
    """(name, node of what it gets) for each assignment of a text, with names on the right resolved."""
    tokens, i = reader.tokens, 0
    while i + 2 < len(tokens):
        kind, name, start, _ = tokens[i]
        # A subscript gives its string or name to the pair.
        mark = i + 2 if i and reader.is_(i - 1, "other", "[") and reader.is_(i + 1, "other", "]") else i + 1
        if kind not in ("name", "string") or not reader.is_(mark, "mark", *_PAIR):
            i += 1
            continue
        j = mark + 1
        # `name: type = value`
        if tokens[mark][1] == ":" and reader.is_(j, "name") and reader.is_(j + 1, "mark", "="):
            j += 2
        found = reader.value(j, reader.indent(start))
        if found is not None:
            reader.known[name] = found
            yield name, found
        if (other := reader.named_value(i, mark)) is not None and (found := reader.value(other[1], reader.indent(start))) is not None:
            yield other[0], found
        # The value may itself be the name of the next pair, or hold pairs.
        i = mark + 1


def literals(text: str) -> dict[tuple[int, int], float]:
    """Places of literals that reach a sensitive name, and their scores.

    Weights of names go down the graph once, from the last node to the first:
    from lists to their strings, and the score of a string to all places that it
    is joined from. A place that is reached by several ways is one place and
    has the largest of its scores.
    """
    reader = _Reader(text)
    weight: dict[int, list[float]] = {}  # node: of names, and of names that ask for a phrase

    def raised(at: dict, node: int, values: list[float]) -> None:
        at[node] = list(map(max, at[node], values)) if node in at else values

    for name, node in assignments(reader):
        if w := name_score(name):
            raised(weight, node, [0.0, w] if "phrase" in name.lower() else [w, 0.0])
    if not weight:
        return {}
    # Only what sensitive names reach has to be known.
    needed, todo = set(weight), list(weight)
    while todo:
        kind, of = reader.nodes[todo.pop()]
        for child in of if kind != "place" else ():
            if child not in needed:
                needed.add(child)
                todo.append(child)
    shape: dict[int, Shape] = {}
    for node in sorted(needed):
        kind, of = reader.nodes[node]
        shape[node] = Shape.of(text[of[0] : of[1]]) if kind == "place" else Shape.joined([shape[c] for c in of])
    score: dict[int, float] = {}
    out: dict[tuple[int, int], float] = {}
    for node in sorted(needed, reverse=True):
        kind, of = reader.nodes[node]
        own = score.get(node, 0.0)
        if node in weight:
            plain, phrase = weight[node]
            if kind == "list":
                for child in of:
                    raised(weight, child, [plain, phrase])
            else:
                own = max(own, plain * shape[node].score(), phrase * shape[node].score(True))
        if kind == "place":
            out[of] = max(out.get(of, 0.0), own)
        elif own:
            for child in of:
                score[child] = max(score.get(child, 0.0), own)
    return out


def spans(text: str) -> list[Span]:
    """All spans by start, then kind. Literals inside a base span are not repeated."""
    base = base_spans(text)
    found = literals(text) if ":" in text or "=" in text else {}
    taken = [(b.start, b.end) for b in base]
    added = [Span(s, e, "literal", s, e) for (s, e), score in found.items() if score >= THRESHOLD and e > s and not any(a <= s and e <= b for a, b in taken)]
    return sorted(base + added, key=lambda x: (x.start, KINDS.index(x.kind), x.end))


def digest(found: list[Span]) -> str:
    return ",".join(f"{x.kind}:{x.start}:{x.end}" for x in found)


def masked(text: str, found: list[Span]) -> str:
    """The text with every value replaced by a mark; values that overlap are one."""
    out, at = [], 0
    for start, end in sorted((x.value_start, x.value_end) for x in found):
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join(out) + text[at:]


def scan(docs: DataFrame) -> DataFrame:
    """One row for each row of `docs` (doc_id, text): counts and places of secrets.

    Cases: null and empty texts have none (the digest of no spans is that of
    the empty string); repeated rows give repeated rows; texts of any length
    are read whole; an empty table gives no rows; further columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                found = spans(text.as_py() or "")
                base = [x for x in found if x.kind != "literal"]
                n = Counter(x.kind for x in found)
                rows.append((n["assign"], n["access"], n["hex"], hashlib.sha256(digest(base).encode()).hexdigest(), digest(found)))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.record_batch(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in columns[:3]], *[pa.array(c, pa.string()) for c in columns[3:]]],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return for_workers(slim).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def hide_secrets(docs: DataFrame) -> DataFrame:
    """`docs` with secret values masked; n_chars, where there is one, follows the text. Null texts stay null."""
    names = docs.columns
    at, length = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(k, 500) for whole in batches for k in range(0, whole.num_rows, 500)):
            texts, lengths = batch.column(at).to_pylist(), batch.column(length).to_pylist() if length is not None else None
            for k, text in enumerate(texts):
                if text and (found := spans(text)):
                    texts[k] = masked(text, found)
                    if lengths is not None:
                        lengths[k] = len(texts[k])
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if length is not None:
                columns[length] = pa.array(lengths, batch.schema.field(length).type)
            yield pa.record_batch(columns, schema=batch.schema)

    return for_workers(docs).mapInArrow(run, docs.schema)
