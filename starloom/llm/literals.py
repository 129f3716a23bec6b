"""Name-literal pairs of source code and configuration: a lexer and what assigns a literal to a name.

One pass cuts a text into strings (prefixes, triple quotes, back ticks, escaped quotes),
operators, brackets and separators; what is between two of them is bare text. Pairs are
read around the tokens:

* ``name = x``, ``name := x``, ``"name": x``, ``'name' => x``, ``name: type = x``, ``table["name"] = x``, ``a, name = x, y``;
* ``x`` may be strings in a row, sums of strings and constants, in parentheses and over several
  lines, a template, a default (``f(...) or x``, ``a ?? x``, ``a || x``), bare text, an indented block;
* ``f("name", "x")``, ``#define NAME x``, ``${NAME:-x}``, ``<name>x</name>``, and a ``name`` or ``key`` that
  names the next ``value``.

A name that gets a name takes over that one's literal, looked up whole, then by its last part.
Bare text ends at white space, quotes, brackets, ``, ; & |`` and the next operator; an
identifier in front of a bracket, or dotted words, are code and no literal.

Time and memory are linear in the text's length: every token is read a bounded number of times,
a quote known to have no partner is not searched again, pairs refer to places in the text, and sums
longer than ``LONGEST_SUM`` are not put together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

LONGEST_SUM = 1024
LONGEST_NAME = 200

_MARK = re.compile(
    r"""\"{3}|'{3}|\\?["'`]|:=|=>|->|::|:-|[=!]==?|[<>]=|[+?.]=|\?\?|\|\||://|[=:(){}\[\],;&|+\n]"""
)
_ASSIGNS = {"=", ":", ":=", "=>", "+=", "?=", ".="}
_PARTNER = {")": "(", "]": "[", "}": "{"}
_PREFIX = re.compile(r"(?:(?<![A-Za-z0-9_])[rRbBuUfF]{1,2}|[@$]{1,2})$")
_NAME_SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-"
_IDENTIFIER = re.compile(r"[A-Za-z0-9_.-]*[A-Za-z_][A-Za-z0-9_.-]*")
_REFERENCE = re.compile(
    r"[\x20\t]*+(\$?\{?)([A-Za-z_](?:[A-Za-z0-9_]|-(?!>))*+(?:(?:\.|::|->)[A-Za-z_](?:[A-Za-z0-9_]|-(?!>))*+)*+)\}?[\x20\t\f\v]*+(?=[;,)\]}\r\n#+&|]|//|/\*|<!--|(?<=[\x20\t])--|$)"
)
_CALL = re.compile(r"[\x20\t]*+[A-Za-z_$][A-Za-z0-9_.$>:-]*+(?=[(\[])")
_DEFAULT = re.compile(r"[\x20\t]*+(?:[A-Za-z_$][A-Za-z0-9_.$-]*+[\x20\t]*+)?(?:\bor\b|\|\||\?\?|\+(?=\s*+[\"'`]))")
# Up to the next operator; equals signs at the very end belong to it, as base64 has them.
_BARE = re.compile(r"""[\x20\t]*+([^\s"'`,;&|(){}\[\]<>:=]++(?:={1,2}(?=[\s"'`,;&|(){}\[\]<>]|$))?+)""")
_TEMPLATE_PART = re.compile(r"\$?\{([A-Za-z_][A-Za-z0-9_.]*+)\}")
_CODE = re.compile(r"[A-Za-z_$][A-Za-z0-9_$]*+(?:(?:\.|::|->)[A-Za-z_][A-Za-z0-9_]*+)++")
_LAST_PART = re.compile(r"\.|::|->")
_NAME_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_DEFINE = re.compile(r"#[\x20\t]*+define[\x20\t]++([A-Za-z_][A-Za-z0-9_]*+)[\x20\t]++([^\s\"'(]++(?=[\x20\t]*+$)|\"[^\"\n]*+\")", re.MULTILINE)
_SHELL_DEFAULT = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_]*+):?[-=]([^${}\s]++)\}")
_ELEMENT = re.compile(r"<([A-Za-z_][A-Za-z0-9_.:-]*+)(?:\s[^<>]*+)?>\s*+([^<>\s][^<>]*+)</\1", re.DOTALL)
_BLOCK = re.compile(r"[\x20\t]*+[|>][+-]?[\x20\t]*+\r?\n")
_LINE_END = re.compile(r"[\x20\t]*+\r?\n")
_INDENT = re.compile(r"[\x20\t]*+")


@dataclass(slots=True)
class Pair:
    """A name and the literal that it gets, with the literal's place."""

    name: str
    value: str
    start: int
    end: int


class Tokens:
    """Kinds and places of the tokens of a text; a string's kind is ``"``, and its place that of what it says."""

    def __init__(self, text: str):
        self.text = text
        self.kind: list[str] = []
        self.start: list[int] = []  # prefix and quote included
        self.end: list[int] = []
        self.inner: dict[int, tuple[int, int]] = {}  # of strings, by token
        self.partner: dict[int, int] = {}  # of closing brackets
        dead = {}  # by quote: up to where none has a partner
        open_: dict[str, list[int]] = {"(": [], "[": [], "{": []}
        at = 0
        while m := _MARK.search(text, at):
            kind, start, at = m[0], m.start(), m.end()
            if kind[-1] in "\"'`":
                inner = self._string(kind, start, at, dead)
                if inner is None:
                    # Not a string: a sign of its own, and of three quotes an empty string and the third.
                    at = start + len(kind) if len(kind) < 3 else self._add('"', start, start + 2, (start + 1, start + 1))
                    continue
                if prefix := _PREFIX.search(text, max(0, start - 3), start):
                    start = prefix.start()
                at = self._add('"', start, inner[2], inner[:2])
                continue
            number = len(self.kind)
            self._add(kind, start, at)
            if kind in open_:
                open_[kind].append(number)
            elif kind in _PARTNER and open_[_PARTNER[kind]]:
                self.partner[number] = open_[_PARTNER[kind]].pop()

    def _add(self, kind: str, start: int, end: int, inner: tuple[int, int] | None = None) -> int:
        if inner is not None:
            self.inner[len(self.kind)] = inner
        self.kind.append(kind)
        self.start.append(start)
        self.end.append(end)
        return end

    def _string(self, quote: str, start: int, begin: int, dead: dict[str, int]) -> tuple[int, int, int] | None:
        """Begin and end of what the string says, and its own end; None if it has no partner."""
        text = self.text
        if start < dead.get(quote, 0):
            return None
        if len(quote) != 1:
            # Three quotes up to the next three; escaped ones up to the next, on one line.
            end = text.find(quote, begin)
            line = text.find("\n", begin) if len(quote) == 2 else -1
            if end < 0 or 0 <= line < end:
                dead[quote] = len(text) if end < 0 else line
                return None
            return begin, end, end + len(quote)
        stop = text.find("\n", begin)
        stop = len(text) if stop < 0 else stop
        at = begin
        while True:
            end = text.find(quote, at, stop)
            if end < 0:
                dead[quote] = stop
                return None
            back = end
            while quote != "`" and back > at and text[back - 1] == "\\":
                back -= 1
            if (end - back) % 2 == 0:
                return begin, end, end + 1
            at = end + 1

    def says(self, number: int) -> str:
        a, b = self.inner[number]
        return self.text[a:b]

    def before(self, number: int) -> int:
        """Where the bare text in front of a token begins."""
        return self.end[number - 1] if number else 0


def is_code(value: str) -> bool:
    """Whether bare text is dotted words rather than a literal."""
    if not _CODE.fullmatch(value):
        return False
    words = _NAME_WORD.findall(value)
    letters = [len(w) for w in words if not w.isdigit()]
    return sum(len(w) for w in words if w.isdigit()) <= 2 and sum(letters) >= 3 * len(letters)


class _Reader:
    def __init__(self, text: str, sensitive):
        self.text, self.sensitive = text, sensitive
        self.tokens = Tokens(text)
        # By the whole name, and by its last part.
        self.constants: dict[str, Pair] = {}
        self.by_last: dict[str, Pair] = {}

    def known(self, name: str) -> Pair | None:
        return self.constants.get(name) or self.by_last.get(_LAST_PART.split(name)[-1])

    def bind(self, pair: Pair) -> Pair:
        self.constants[pair.name] = self.by_last[pair.name.rpartition(".")[2]] = pair
        return pair

    # -- names ------------------------------------------------------------------

    def bare_name(self, number: int) -> str:
        """The name that the bare text in front of a token ends with."""
        t = self.tokens
        text = self.text[t.before(number) : t.start[number]].rstrip(" \t?")
        name = text[len(text.rstrip(_NAME_SIGNS)) :].lstrip("-.")
        return name if len(name) <= 4 * LONGEST_NAME and _IDENTIFIER.fullmatch(name) else ""

    def blank_before(self, number: int) -> bool:
        t = self.tokens
        return not self.text[t.before(number) : t.start[number]].strip(" \t?")

    def name_before(self, number: int) -> str:
        """The name that the operator of this number assigns to; empty if there is none."""
        t = self.tokens
        if not self.blank_before(number):
            # ``name: type = x`` names what is in front of the colon.
            if t.kind[number] == "=" and number and t.kind[number - 1] == ":":
                return self.bare_name(number - 1) or self.bare_name(number)
            return self.bare_name(number)
        if not number:
            return ""
        last = number - 1
        if t.kind[last] == '"':
            name = t.says(last) if t.inner[last][1] - t.inner[last][0] <= LONGEST_NAME else ""
            return name if _IDENTIFIER.fullmatch(name) else ""
        if t.kind[last] == "]" and last in t.partner:
            opening = t.partner[last]
            if opening == last - 2 and t.kind[last - 1] == '"':
                return t.says(last - 1) if t.inner[last - 1][1] - t.inner[last - 1][0] <= LONGEST_NAME else ""
            if opening and t.kind[opening - 1] == ":" and t.kind[number] == "=":
                return self.bare_name(opening - 1)
            return self.bare_name(opening)
        return ""

    # -- literals ---------------------------------------------------------------

    def value(self, number: int) -> list[tuple[str, int, int]]:
        """``value, start, end`` of the literals behind an operator; of a sum each place with the whole value."""
        t, text = self.tokens, self.text
        at, now, opened = t.end[number], number + 1, 0
        places: list[tuple[int, int]] = []
        total: list[str] = []
        length = 0

        def skip_blank() -> None:
            nonlocal at, now, opened
            while now < len(t.kind) and not text[at : t.start[now]].strip(" \t\r\\"):
                if t.kind[now] == "(" and not total:
                    opened += 1
                elif not (t.kind[now] == "\n" and (opened or text[t.start[now] - 1 : t.start[now]] == "\\" or plus)):
                    return
                at, now = t.end[now], now + 1

        plus = False
        while True:
            skip_blank()
            gap = text[at : t.start[now]] if now < len(t.kind) else text[at:]
            if now < len(t.kind) and t.kind[now] == '"' and not gap.strip(" \t\r\\."):
                if total and not plus and "." not in gap and not opened and text[t.end[now - 1] : t.start[now]].strip(" \t"):
                    break
                says = t.says(now)
                refs = [p for p in map(self.known, _TEMPLATE_PART.findall(says)) if p] if len(says) <= LONGEST_SUM and "{" in says else []
                if refs:
                    # A template hands on what it is made of.
                    return [(p.value, p.start, p.end) for p in refs]
                if length > LONGEST_SUM:
                    break
                places.append(t.inner[now])
                total.append(says)
                length += len(says)
                at, now, plus = t.end[now], now + 1, False
            elif (ref := _REFERENCE.match(text, at)) and (known := self.known(ref[2])) and (plus or not total):
                if length + len(known.value) > LONGEST_SUM and total:
                    break
                places.append((known.start, known.end))
                total.append(known.value)
                length += len(known.value)
                at, plus = ref.end(), False
                while now < len(t.kind) and t.start[now] < at:
                    now += 1
            elif total:
                break
            elif default := _DEFAULT.match(text, at):
                at = default.end()
                while now < len(t.kind) and t.start[now] < at:
                    now += 1
                continue
            elif call := _CALL.match(text, at):
                # Code, unless a default follows its last bracket.
                close = self.closing(now, call.end())
                if close is None or not (default := _DEFAULT.match(text, t.end[close])):
                    return []
                at, now = default.end(), close + 1
                while now < len(t.kind) and t.start[now] < at:
                    now += 1
                continue
            else:
                return self.bare(number, at, opened)
            skip_blank()
            if now < len(t.kind) and t.kind[now] == "+" and not text[at : t.start[now]].strip(" \t\r\n"):
                at, now, plus = t.end[now], now + 1, True
            elif not (now < len(t.kind) and t.kind[now] == '"' and text[at : t.start[now]].strip(" \t\r\\") in ("", ".")):
                break
        value = "".join(total)
        if len(places) > 1 and all(a[1] <= b[0] and b[0] - a[1] < LONGEST_NAME for a, b in zip(places, places[1:])) and len(total) == len(places):
            own = [p for p in places if p[0] >= t.end[number]]
            if len(own) == len(places):
                return [(value, places[0][0], places[-1][1])]
        return [(value, *place) for place in dict.fromkeys(places)]

    def closing(self, now: int, at: int) -> int | None:
        """The token that closes the bracket at ``at``; no further than 16 tokens or the line."""
        t = self.tokens
        while now < len(t.kind) and t.start[now] < at:
            now += 1
        opening, depth = now, 0
        while now < len(t.kind) and now - opening < 16 and t.kind[now] != "\n":
            depth += t.kind[now] in "([{"
            depth -= t.kind[now] in ")]}"
            if depth == 0:
                return now
            now += 1
        return None

    def bare(self, number: int, at: int, opened: int) -> list[tuple[str, int, int]]:
        text = self.text
        if self.tokens.kind[number] == ":" and not opened:
            if block := _BLOCK.match(text, at):
                return self.block(number, block.end())
            if line := _LINE_END.match(text, at):
                found = self.block(number, line.end(), lines=1)
                return found if found and not re.search(r"\s|[:=](?!=*$)", found[0][0]) else []
        m = _BARE.match(text, at)
        if not m:
            return []
        (start, end), value = m.span(1), m[1]
        if text[end : end + 1] in ("(", "[") or is_code(value):
            return []
        return [(value, start, end)]

    def block(self, number: int, at: int, lines: int | None = None) -> list[tuple[str, int, int]]:
        """The lines from ``at`` on that are indented deeper than the operator's line; for sensitive names alone."""
        text = self.text
        if not self.sensitive(self.name_before(number)):
            return []
        line = text.rfind("\n", 0, self.tokens.start[number]) + 1
        deep = len(_INDENT.match(text, line)[0])
        start = end = None
        while at < len(text) and lines != 0:
            stop = text.find("\n", at)
            stop = len(text) if stop < 0 else stop
            first = _INDENT.match(text, at).end()
            said = text[first:stop].rstrip()
            if said and first - at <= deep:
                break
            if said:
                start, end = first if start is None else start, first + len(said)
            at = stop + 1
            lines = lines - 1 if lines else lines
        return [] if start is None else [(text[start:end], start, end)]

    # -- pairs ------------------------------------------------------------------

    def tuple_targets(self, number: int) -> list[Pair]:
        """``a, b = "x", "y"``: as many strings behind the sign as names before it."""
        t = self.tokens
        values, now = [], number + 1
        while now < len(t.kind) and t.kind[now] == '"' and self.blank_before(now):
            values.append(now)
            now += 1
            if now >= len(t.kind) or t.kind[now] != "," or not self.blank_before(now):
                break
            now += 1
        if len(values) < 2 or number < len(values) - 1:
            return []
        names, at = [], number
        for _ in values:
            names.append(self.bare_name(at))
            at -= 1
            if at < 0 or t.kind[at] != ",":
                break
        if len(names) != len(values) or not all(names) or (at >= 0 and t.kind[at] == ","):
            return []
        return [Pair(n, t.says(v), *t.inner[v]) for n, v in zip(reversed(names), values)]

    def pairs(self) -> Iterator[Pair]:
        t, skip = self.tokens, 0
        asked = None  # the name that a ``name`` or ``key`` has said, for the next ``value``
        for number, kind in enumerate(t.kind):
            if t.start[number] < skip:
                continue
            if kind == "(":
                yield from self.arguments(number)
            if kind not in _ASSIGNS:
                continue
            name = self.name_before(number)
            if kind == "=" and (several := self.tuple_targets(number)):
                yield from map(self.bind, several)
                continue
            if not name:
                continue
            found = self.value(number)
            for value, start, end in found:
                pair = Pair(name, value, start, end)
                yield pair
            if not found:
                continue
            self.bind(pair)
            last = _LAST_PART.split(name)[-1].lower()
            if last in ("name", "key") and len(found[0][0]) <= LONGEST_NAME and _IDENTIFIER.fullmatch(found[0][0]):
                asked = found[0][0]
            elif last == "value" and asked:
                yield self.bind(Pair(asked, *found[0]))
                asked = None
            # A block is one literal; what is taken is not read again.
            if "\n" in found[0][0] and found[0][1] > t.start[number]:
                skip = found[0][2]

    def arguments(self, number: int) -> Iterator[Pair]:
        """``f("name", "x")``"""
        t = self.tokens
        if t.kind[number + 1 : number + 4] == ['"', ",", '"'] and all(map(self.blank_before, range(number + 1, number + 4))):
            name = t.says(number + 1) if t.inner[number + 1][1] - t.inner[number + 1][0] <= LONGEST_NAME else ""
            if _IDENTIFIER.fullmatch(name):
                yield self.bind(Pair(name, t.says(number + 3), *t.inner[number + 3]))


def pairs(text: str, sensitive=lambda name: True) -> Iterator[Pair]:
    """Name-literal pairs, those of operators in order; indented blocks are literals of ``sensitive`` names only."""
    reader = _Reader(text, sensitive)
    yield from reader.pairs()
    for number, (start, end) in reader.tokens.inner.items():
        # Source code within a string, its quotes escaped.
        if end - start > 8 and '\\"' in (inside := text[start:end]) and (":" in inside or "=" in inside):
            yield from (Pair(p.name, p.value, p.start + start, p.end + start) for p in _Reader(inside, sensitive).pairs())
    for pattern in (_DEFINE, _SHELL_DEFAULT, _ELEMENT):
        for m in pattern.finditer(text):
            start, end = m.span(2)
            if text[start] == '"':
                start, end = start + 1, end - 1
            value = text[start:end].rstrip()
            yield Pair(m[1], value, start, start + len(value))
