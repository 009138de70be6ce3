"""Secret scan by assignment-aware lexing of source code and configuration.

A text is lexed into assignments ``name <op> value`` (``=``, ``:=``, ``:``, ``=>``; quoted keys as in JSON or YAML and
in brackets; a type between name and ``=`` is skipped; ``export``, ``set`` and XML-like attributes come out the same
way) and XML elements with text.  A value is a string literal (with a prefix or three quotes too), a bare word, a name
seen earlier, or a sum of these, also in parentheses; of a call, every string among the arguments is a value by itself.
Constants are propagated, so ``a = "s3cr..."; password = a`` reports the literal behind ``a``.  A literal scores by how
sensitive its target name is and how much it looks like a secret.  Beside these, three plain patterns are always
reported: ``assign``, ``access`` and ``hex``.

Values are nodes that share their parts, so a text of n literals and assignments takes memory of the order of n, however
often its names are added up.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import body, bound_batches

KINDS = ("assign", "access", "hex", "literal")
BASE = KINDS[:3]
FINDINGS = "array<struct<kind:string,start:long,end:long,name:string,score:double>>"

_LETTERS = {c: f"[{c.upper()}{c}]" for c in "abcdefghijklmnopqrstuvwxyz"}  # either case of ASCII letters, no others
_NAMES = "|".join("".join(_LETTERS.get(c, c) for c in n) for n in ("password", "passwd", "secret", "token"))
_NAMES += "|" + "".join(_LETTERS[c] for c in "api") + "_?" + "".join(_LETTERS[c] for c in "key")
_ASSIGN = re.compile(rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # a run that is too short fails as a whole
_HEX = re.compile(r"[0-9a-f]{16,}")

# A name is taken from its first character only and without backtracking, so long words cost linear time.
_TYPE = (r"""&?(?:'static[ \t]+)?[A-Za-z_][A-Za-z_.]*+(?:8|16|32|64|128)?(?:<[^<>\n=]{0,60}(?:<[^<>\n=]{0,60}>)?>|\[[^\[\]\n=]{0,60}(?:\[[^\[\]\n=]{0,60}\])?\])?"""
         r"""(?:[ \t]*\|[ \t]*[A-Za-z_][A-Za-z_.]*+)*+""")
_LEX = re.compile(r"""(?<![\w.-])(?P<name>[A-Za-z_][\w.-]*+)["'`]?\]?\??[ \t]*"""
                  rf"""(?::[ \t]*{_TYPE}(?:[ \t]+=(?![=>~])|=(?=[bBrRfFuU]{{0,2}}["'`]))|:=|=>|=(?!=)|:(?!//))[ \t]*""")
_STRING = r"""(?:[bBrRfFuU]{1,2}(?=["'`]))?(?:(?P<three>\"{3}|'{3})(?P<long>(?:\\.|(?!(?P=three))[^\\])*+)(?P=three)|(?P<quote>["'`])(?P<text>(?:\\.|(?!(?P=quote))[^\\\n])*+)(?P=quote))"""
_TERM = re.compile(_STRING + r"""|(?P<bare>[^\s"'`,;+(){}\[\]<>]++)""", re.DOTALL)
_INNER = re.compile(_STRING + r"""|(?P<open>[(\[{])|(?P<close>[)\]}])""", re.DOTALL)
_BETWEEN = re.compile(r"\s*(?:\+\s*)?")
_LINE = re.compile(r"[^\n]*+")
_ELEMENT = re.compile(r"<(?P<name>[A-Za-z_][\w.:-]*+)(?:\s[^<>]*+)?>\s*(?:<!\[CDATA\[)?(?P<text>[^<>\s\]]++)(?:\]\]>)?\s*</(?P=name)\s*>")
_PLUS = re.compile(r"[ \t]*\+[ \t]*")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

#: Sensitive parts of names and their weights.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
             "credential": 0.8, "credentials": 0.8, "private": 0.6, "auth": 0.6, "key": 0.6, "bearer": 0.8, "salt": 0.6}
_PLACEHOLDER = re.compile(r"(?i)^(?:x{3,}|\*{3,}|<.*>|\$\{.*\}|%.*%|your[-_ ].*|change[-_]?me.*|example.*|none|null|true|false|todo.*)$")
THRESHOLD = 0.5
#: Characters kept of either end of a value, for placeholders.
ENDS = 64


def name_weight(name: str) -> float:
    """How sensitive a target name is: its strongest part, in snake, kebab, dotted or camel case."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    pairs = [a + b for a, b in zip(parts, parts[1:], strict=False)]
    return max((SENSITIVE.get(p, 0.0) for p in (*parts, *pairs)), default=0.0)


class Value:
    """What is known of a joined text without the text: its characters, its ends, and the node of its literals."""

    __slots__ = ("counts", "head", "tail", "node", "size")

    def __init__(self, counts: Counter, head: str, tail: str, size: int, node: int):
        self.counts, self.head, self.tail, self.size, self.node = counts, head, tail, size, node

    def joined(self, other: Value, node: int) -> Value:
        head = self.head + other.head if self.size == len(self.head) else self.head
        tail = other.tail if other.size >= ENDS else self.tail + other.tail
        return Value(self.counts + other.counts, head[:ENDS], tail[-ENDS:], self.size + other.size, node)

    def weight(self) -> float:
        """How much it looks like a secret: long, of many different characters, no placeholder, no phrase."""
        n = self.size
        if n < 8 or " " in self.counts:
            return 0.0
        if n <= ENDS:
            text = self.head
        elif n <= 2 * ENDS:
            text = self.head + self.tail[2 * ENDS - n:]
        else:
            text = self.head + "".join(sorted(self.counts.keys() - set(self.head + self.tail))) + self.tail
        if _PLACEHOLDER.match(text):
            return 0.0
        shares = [p for c in self.counts.values() if (p := c / n)]
        bits = -sum(p * math.log2(p) for p in shares)
        kinds = "".join(self.counts)
        classes = sum(bool(re.search(p, kinds)) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9]"))
        return min(1.0, bits / 3.0) * (1.0 if classes > 1 or n >= 20 else 0.5)


class Lexer:
    """Assignments of one text and the scores of their literals.

    Node k has ``parts[k]`` (nodes of a sum) and ``args[k]`` (nodes that are values by themselves); parts come before
    sums, so one walk from the last node back hands every literal the best score of all that holds it.
    """

    def __init__(self, text: str):
        self.text = text
        self.spans: list[tuple[int, int] | None] = []
        self.parts: list[tuple[int, ...]] = []
        self.args: list = []
        self.known: dict[str, Value] = {}
        self.scores: dict[int, tuple[float, int, str]] = {}   # of a sum as a whole
        self.weights: dict[int, tuple[float, int, str]] = {}  # of the names, for arguments
        self.closed: dict[int, tuple[int, list[int], int, int]] = {}

    def node(self, span: tuple[int, int] | None = None, parts: tuple[int, ...] = (), args=()) -> int:
        self.spans.append(span)
        self.parts.append(parts)
        self.args.append(args)
        return len(self.spans) - 1

    def literal(self, start: int, end: int) -> Value:
        t = self.text[start:end]
        return Value(Counter(t), t[:ENDS], t[-ENDS:], len(t), self.node((start, end)))

    def add(self, a: Value | None, b: Value) -> Value:
        if a is None or (not a.size and not self.parts[a.node] and not self.args[a.node]):
            return b
        if not b.size and not self.parts[b.node] and not self.args[b.node]:
            return a
        return a.joined(b, self.node(parts=(a.node,) if a.node == b.node else (a.node, b.node)))

    def inside(self, at: int) -> tuple[int, list[int], int, int]:
        """End of the bracket that opens at ``at``, and the strings in it: nodes[lo:hi]; an open one ends with its line."""
        if at not in self.closed:
            nodes: list[int] = []
            stack: list[tuple[int, int]] = []
            for m in _INNER.finditer(self.text, at):
                if m["open"]:
                    stack.append((m.start(), len(nodes)))
                elif m["close"]:
                    start, lo = stack.pop()
                    self.closed[start] = (m.end(), nodes, lo, len(nodes))
                    if not stack:
                        break
                else:
                    nodes.append(self.node(m.span("long" if m["three"] else "text")))
            for start, lo in stack:
                end = _LINE.match(self.text, start).end()
                hi = lo
                while hi < len(nodes) and self.spans[nodes[hi]][1] < end:
                    hi += 1
                self.closed[start] = (end, nodes, lo, hi)
        return self.closed[at]

    def arguments(self, at: int) -> tuple[Value, int]:
        end, nodes, lo, hi = self.inside(at)
        return Value(Counter(), "", "", 0, self.node(args=(nodes, lo, hi))), end

    def term(self, at: int) -> tuple[Value, int] | None:
        m = _TERM.match(self.text, at)
        if not m:
            return None
        if m["bare"] is None:
            return self.literal(*m.span("long" if m["three"] else "text")), m.end()
        if self.text.startswith("(", m.end()):
            return self.arguments(m.end())
        return self.known.get(m["bare"]) or self.literal(*m.span("bare")), m.end()

    def sum(self, at: int, plus: re.Pattern) -> tuple[Value | None, int]:
        value = None
        while t := self.term(at):
            value, at = self.add(value, t[0]), t[1]
            p = plus.match(self.text, at)
            if not p:
                break
            at = p.end()
        return value, at

    def value(self, at: int) -> Value | None:
        total = None
        while True:
            if self.text.startswith("(", at):
                first = _BETWEEN.match(self.text, at + 1).end()
                value, end = self.sum(first, _BETWEEN)
                if value is not None and self.text.startswith(")", end):
                    end += 1
                else:
                    value, end = self.arguments(at)
                total = self.add(total, value)
            else:
                value, end = self.sum(at, _PLUS)
                if value is None:
                    return total
                total = self.add(total, value)
                if not self.text.startswith("(", end):
                    return total
                at = end
                continue
            p = _PLUS.match(self.text, end)
            if not p:
                return total
            at = p.end()

    def assign(self, name: str, value: Value) -> None:
        if not (w := name_weight(name)):
            return
        k = len(self.text) - len(self.spans)  # falls: of equal scores the first assignment stays
        score = w * value.weight()
        if score >= THRESHOLD:
            self.scores[value.node] = max(self.scores.get(value.node, (0.0, 0, "")), (score, k, name), key=lambda x: x[0])
        self.weights[value.node] = max(self.weights.get(value.node, (0.0, 0, "")), (w, k, name), key=lambda x: x[0])

    def run(self) -> dict[tuple[int, int], tuple[str, float]]:
        """Target name and score of every literal that looks like a secret, by its span."""
        for m in _LEX.finditer(self.text):
            value = self.value(m.end())
            if value is not None:
                self.known[m["name"]] = value
                self.assign(m["name"], value)
        if "</" in self.text:
            for m in _ELEMENT.finditer(self.text):
                self.assign(m["name"], self.literal(*m.span("text")))
        found: dict[tuple[int, int], tuple[float, int, str]] = {}
        single: dict[int, tuple[float, int, str]] = {}

        def raise_to(table: dict, key, to: tuple[float, int, str]) -> None:
            if key not in table or to[:2] > table[key][:2]:
                table[key] = to
        for k in range(len(self.spans) - 1, -1, -1):
            score, weight = self.scores.pop(k, None), self.weights.pop(k, None)
            if score and self.spans[k]:
                raise_to(found, self.spans[k], score)
            for p in self.parts[k]:
                if score:
                    raise_to(self.scores, p, score)
                if weight:
                    raise_to(self.weights, p, weight)
            if weight and self.args[k]:
                nodes, lo, hi = self.args[k]
                for p in nodes[lo:hi]:
                    raise_to(single, p, weight)
        for k, (w, order, name) in single.items():
            start, end = self.spans[k]
            score = w * literal_weight(self.text[start:end])
            if score >= THRESHOLD:
                raise_to(found, (start, end), (score, order, name))
        return {span: (name, score) for span, (score, _, name) in found.items()}


def literal_weight(text: str) -> float:
    return Value(Counter(text), text[:ENDS], text[-ENDS:], len(text), -1).weight()


def scan_text(text: str) -> list[tuple[str, int, int, str | None, float | None]]:
    """All findings of a text: (kind, start, end, target name, score), by start, then kind; end is exclusive."""
    found = {("assign", m.start(), m.end()): (m[1], None) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12}
    for kind, pattern in (("access", _ACCESS), ("hex", _HEX)):
        found |= {(kind, m.start(), m.end()): (None, None) for m in pattern.finditer(text)}
    if ":" in text or "=" in text or "</" in text:
        found |= {("literal", *span): x for span, x in Lexer(text).run().items()}
    return [(k, s, e, *found[k, s, e]) for k, s, e in sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))]


def findings(text: Column) -> Column:
    """Column of findings of whole texts (NULL: empty); no finding gives an empty list."""
    @F.pandas_udf(FINDINGS)
    def secrets(t: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("kind", "start", "end", "name", "score"), f, strict=True)) for f in scan_text(x or "")] for x in t], dtype=object)
    return secrets(text)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and findings for every row."""
    bound_batches(docs.sparkSession)
    return docs.select("doc_id", findings(body()).alias("findings"))


def mask_secrets(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """The documents with every finding replaced; overlapping findings count as one."""
    bound_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def masked(t: pd.Series) -> pd.Series:
        def one(x):
            if x is None:
                return None
            out, at = [], 0
            for _, s, e, _, _ in scan_text(x):
                if s >= at:
                    out += [x[at:s], mask]
                at = max(at, e)
            return "".join([*out, x[at:]])
        return pd.Series([one(x) for x in t], dtype=object)
    return docs.withColumn("text", masked(F.col("text")))
