"""Secrets in texts: fixed patterns, and literals by the names that they are assigned to.

The patterns are keyword assignments, access keys and long hexadecimal runs. Beyond
them, each text is lexed into pairs of a name and a literal as source code and configuration files have
them (``literals.py`` lists the forms); constants are handed on, so that a literal is judged by every
name it flows to. The score adds up how sensitive the name's words are and how random the literal
looks. Time and memory are linear in a text's length.

Spans count code points, the end excluded. A null text is empty. Rows with equal
or null ``doc_id`` are scanned each by itself. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starloom.llm.literals import pairs
from starloom.llm.tables import documents, slices

# The patterns, and their kinds in the order of results.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run shorter than that fails, and takes nothing from a longer one
KINDS = ("assign", "access", "hex", "literal")
LEAST_VALUE, LEAST_ACCESS = 8, 16

# Words of names: what makes a name sensitive, how much, and what tells that it is about something else.
STRONG = {"password", "passwd", "pwd", "secret", "token", "apikey", "credential", "credentials", "passphrase"}
WEAK = {"key", "auth", "pass", "pin", "salt", "bearer", "private", "access", "api", "signature"}
HARMLESS = {"name", "id", "count", "max", "min", "length", "len", "file", "path", "url", "uri", "type", "field", "label", "ttl", "hint", "prompt", "limit"}
PHRASE = {"passphrase"}  # names whose literals may be words with gaps
PLACEHOLDER = re.compile(r"(?i)change.?me|example|placeholder|your[_-]|x{4,}|\*{3,}|\.{3,}|^(none|null|true|false|todo)$")
# Literals that are nothing but places to be filled: <...>, {...}, ${...}, $(...), %s, %(name)s, %NAME%, and signs between them.
FILLED_IN = re.compile(
    r"(?:[^A-Za-z0-9<>{}%$]*+(?:<[^<>]*+>|\$?\{++[^{}]*+\}++|\$\([^()]*+\)|%(?:\([A-Za-z0-9_]*+\))?[sdr](?![A-Za-z0-9])|%[A-Za-z_][A-Za-z0-9_]*+%))++[^A-Za-z0-9<>{}%$]*+"
)
# Words of prose: in one case but for the first letter, or a number.
_PLAIN_WORD = re.compile(r"[^A-Za-z0-9]*(?:[A-Za-z]?[a-z'’-]*|[A-Z]+|[0-9]+)[^A-Za-z0-9]*")

_NAME_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def name_score(name: str) -> int:
    found = {w.lower() for w in _NAME_WORD.findall(name)}
    score = 3 if found & STRONG else min(2, len(found & WEAK))
    return score - 2 * bool(found & HARMLESS)


def gap_malus(value: str, phrase: bool) -> int:
    """What white space takes from a literal's score: most from prose, little from groups of random signs."""
    words = value.split()
    if len(words) == 1 and len(words[0]) == len(value):
        return 0
    if phrase:
        return 0 if len(words) > 1 else 2
    mixed = sum(len(w) for w in words if not _PLAIN_WORD.fullmatch(w))
    return 2 if 2 * mixed >= sum(map(len, words)) > 0 else 4


def literal_score(value: str, phrase: bool = False) -> int:
    """How much a literal looks like a key rather than a word, a number or a placeholder; ``phrase`` if its name asks for words."""
    if len(value) < LEAST_VALUE or PLACEHOLDER.search(value) or FILLED_IN.fullmatch(value):
        return -9
    n = len(value)
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(value).values())
    kinds = sum(map(bool, (re.search("[a-z]", value), re.search("[A-Z]", value), re.search("[0-9]", value), re.search("[^A-Za-z0-9]", value))))
    spoken = bool({w.lower() for w in _NAME_WORD.findall(value)} & STRONG)
    return (kinds > 1) + (kinds > 2) + (entropy >= 3) + (n >= 16) - 2 * spoken - gap_malus(value, phrase)


def wants_phrase(name: str) -> bool:
    """Whether a name asks for words."""
    words = {w.lower() for w in _NAME_WORD.findall(name)}
    return bool(words & PHRASE) and not words & HARMLESS


def find(text: str, least_score: int = 4) -> list[tuple[int, int, int, int]]:
    """``start, kind, end, start of the secret itself`` of all spans, in the order of results."""
    spans = []
    if any(sign in text for sign in (":", "=", "(", "</", "#define")):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST_VALUE:
                spans.append((m.start(), 0, m.end(), m.start(2)))
        seen: set[tuple[int, int]] = set()
        names: dict[str, tuple[int, bool]] = {}
        looks: dict[tuple[int, int, int, bool], int] = {}
        for p in pairs(text, lambda name: name_score(name) > 0):
            if p.name not in names:
                names[p.name] = name_score(p.name), wants_phrase(p.name)
            own, phrase = names[p.name]
            if own <= 0 or (p.start, p.end) in seen:
                continue
            # A constant may flow to many names; its looks are judged once.
            place = (p.start, p.end, len(p.value), phrase)
            if place not in looks:
                looks[place] = literal_score(p.value, phrase)
            if own + looks[place] >= least_score:
                seen.add((p.start, p.end))
                spans.append((p.start, 3, p.end, p.start))
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    spans += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    spans.sort()
    return spans


def as_digest(spans: list[tuple[int, int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end, _ in spans)


def secret_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, spans``, the latter an array of ``kind, start, end`` with an entry for each secret."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for part in slices(batches, "text"):
            found = [
                [{"kind": KINDS[k], "start": a, "end": b} for a, k, b, _ in find(t)] for t in part.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, kind)], ["doc_id", "spans"])

    return documents(docs).mapInArrow(run, "doc_id long, spans array<struct<kind: string, start: long, end: long>>")


def secret_digest(docs: DataFrame) -> DataFrame:
    """Numbers of base spans, the digest of those, and all spans as text, for every row of ``docs``."""
    spans = F.col("spans")
    as_text = lambda own: F.array_join(
        F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    number = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return secret_spans(docs).select(
        "doc_id",
        *(number(kind).alias(f"n_{kind}") for kind in KINDS[:3]),
        F.sha2(as_text(F.filter(spans, lambda s: s["kind"] != KINDS[3])), 256).alias("base_sha256"),
        as_text(spans).alias("spans"),
    )


def mask(text: str, sign: str) -> str:
    """``text`` with each secret replaced by ``sign``; of an assignment the value alone."""
    out, at = [], 0
    for start, end in sorted((begin, end) for _, _, end, begin in find(text)):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], sign]
        at = end
    return "".join(out) + text[at:]


def mask_secrets(docs: DataFrame, sign: str = "<secret>") -> DataFrame:
    """``docs`` with secrets in ``text`` replaced; a column ``n_chars`` follows the new text. All rows stay."""
    names = [f.name for f in docs.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            old = part.column("text").to_pylist()
            new = [t if t is None else mask(t, sign) for t in old]
            columns = []
            for name in names:
                column = part.column(name)
                if name == "text":
                    column = pa.array(new, column.type)
                elif name == "n_chars":
                    kept = column.to_pylist()
                    column = pa.array([k if a == b else len(b) for k, a, b in zip(kept, old, new)], column.type)
                columns.append(column)
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, docs.schema)
