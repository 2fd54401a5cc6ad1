"""Secret scans: fixed patterns, and strings whose sliding-window entropy is too high for prose.

Everything is SQL over the text column. A split by the same pattern gives the stretches between the
matches, so the lengths of stretches and matches add up to the places of the matches, in code points.
A string is cut into its characters once, so time grows with the length of texts and strings.

The entropy of a candidate string is that of every window of its characters. The counts of a window's
characters and the sum of c * log2(c) over them pass from one window to the next by the one character
that comes in and the one that goes out; the entropy is log2(width) - sum / width.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
# A match of the bare patterns AKIA[A-Z0-9]+ and [0-9a-f]+ is a whole run of its characters from its
# start on, and no later start in a run is longer; so the least length can be part of the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
BASE = ("assign", "access", "hex")
PIECE = 512  # matches whose places are summed up at once


@dataclass(frozen=True)
class CharClass:
    """Candidate strings are runs of ``alphabet`` of ``width`` or more that match all of ``needs``."""

    alphabet: str
    pattern: str
    needs: tuple[str, ...]
    width: int
    bits: float


_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CLASSES = (
    CharClass(_DIGITS + "abcdefABCDEF", "[0-9A-Fa-f]", ("[0-9]", "[A-Fa-f]"), 20, 3.0),
    CharClass(_DIGITS + _LOWER + _UPPER + "+/=_-", r"[0-9A-Za-z+/=_-]", ("[0-9]", "[a-z]", "[A-Z]"), 20, 3.9),
)
# Strings that look random and are no secrets.
ALLOWED = (
    r"^(?:[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12})$",  # UUID
    r"(?i)(?:example|sample|placeholder|changeme|dummy|xxxx)",
    r"^(?:sha(?:1|256|384|512)-)",                                 # integrity attribute
    r"^(?!.*[^/]{20})(?:/|[^/]*/[^/]*/[^/]*/)",                     # path of short names
)
# A candidate of this shape may be a path: its pieces between slashes are judged, each as a candidate of its own.
PATH = r"^(?:/|[^/]*/[^/]*/[^/]*/)"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _with(name: str, value: str, body: str) -> str:
    """SQL: the body, in which ``name`` is a value that is worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


_SPAN = "struct<start: int, end: int, value: string>"


def matches(text: str, pattern: str) -> str:
    """SQL: the (start, end, value) of all matches of a pattern, leftmost and non-overlapping, in code points.

    Places are summed up within pieces of the list first, then over the pieces: a list that grows by one match at a
    time is copied as often.
    """
    p = _quoted(pattern)
    # The stretch before each match, and one more without a match at the end.
    found = (f"zip_with(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0),"
             " (gap, hit) -> struct(length(gap) AS gap, hit AS hit))")
    within = (f"aggregate(slice(x, b * {PIECE} + 1, least({PIECE}, size(x) - 1 - b * {PIECE})),"
              f" named_struct('end', 0, 'spans', cast(array() AS array<{_SPAN}>)),"
              " (a, m) -> named_struct('end', a.end + m.gap + length(m.hit), 'spans', concat(a.spans, array(named_struct("
              "'start', a.end + m.gap, 'end', a.end + m.gap + length(m.hit), 'value', m.hit)))))")
    pieces = f"transform(sequence(0, (size(x) - 2) div {PIECE}), b -> {within})"
    begins = ("aggregate(k, named_struct('at', 0, 'all', cast(array() AS array<int>)),"
              " (a, m) -> named_struct('at', a.at + m.end, 'all', concat(a.all, array(a.at))), a -> a.all)")
    moved = (f"flatten(zip_with(k, {begins}, (m, o) -> transform(m.spans,"
             " s -> named_struct('start', s.start + o, 'end', s.end + o, 'value', s.value))))")
    return (f"if(rlike({text}, {p}), {_with('x', found, _with('k', pieces, moved))}, cast(array() AS array<{_SPAN}>))")


def max_entropy(value: str, kind: CharClass) -> str:
    """SQL: the highest Shannon entropy of a window of ``kind.width`` characters in a string of the class."""
    alphabet, w = _quoted(kind.alphabet), kind.width
    f = lambda c: f"if(({c}) > 1, ({c}) * log2({c}), 0D)"
    # The place in the alphabet of each character, which comes in, and of the one that goes out (0: none yet).
    codes = f"transform(filter(split({value}, ''), c -> c <> ''), c -> locate(c, {alphabet}))"
    steps = f"zip_with(v, slice(concat(array_repeat(0, {w}), v), 1, size(v)), (came, went) -> struct(came, went))"
    plus = "element_at(s.counts, x.came)"
    minus = "element_at(s.counts, x.went)"
    moved = (f"s.sum + if(x.came = x.went, 0D, {f(plus + ' + 1')} - {f(plus)}"
             f" + if(x.went = 0, 0D, {f(minus + ' - 1')} - {f(minus)}))")
    step = ("named_struct('counts', transform(s.counts, (c, j) -> c + if(j + 1 = x.came, 1D, 0D) - if(j + 1 = x.went, 1D, 0D)),"
            f" 'sum', {moved}, 'least', if(s.n + 1 < {w}, s.least, least(s.least, {moved})), 'n', s.n + 1)")
    lowest = (f"aggregate({steps}, named_struct('counts', array_repeat(0D, {len(kind.alphabet)}), 'sum', 0D, 'least', 1e9D, 'n', 0),"
              f" (s, x) -> {step}, s -> s.least)")
    return _with("v", codes, f"log2({w}) - {lowest} / {w}")


def entropy_spans(text: str, classes: tuple[CharClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED) -> str:
    """SQL: the (start, end, value) of candidate strings of high entropy that the allow-list does not name.

    A string like a path counts if one of its pieces would count alone; the span is that of the whole string.
    """
    parts = []
    for kind in classes:
        pattern = f"(?<!{kind.pattern}){kind.pattern}{{{kind.width},}}"

        def random(value: str) -> str:
            needs = " AND ".join(f"rlike({value}, {_quoted(n)})" for n in kind.needs)
            known = " OR ".join(f"rlike({value}, {_quoted(a)})" for a in allowed) or "false"
            return f"{needs} AND NOT ({known}) AND {max_entropy(value, kind)} >= {kind.bits}"

        piece = f"exists(split(m.value, '/'), p -> length(p) >= {kind.width} AND {random('p')})"
        parts.append(f"filter({matches(text, pattern)}, m -> if(rlike(m.value, {_quoted(PATH)}), NOT"
                     f" ({' OR '.join(f'rlike(m.value, {_quoted(a)})' for a in allowed) or 'false'}) AND {piece}, {random('m.value')}))")
    return parts[0] if len(parts) == 1 else f"array_union({', '.join(parts)})"


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 classes: tuple[CharClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """One row per document row: (doc_id, found), found an array of (start, rank, kind, end) in order.

    Kinds: assign (a key word with its value of 6 characters or more), access, hex, and entropy for strings that
    lie in none of the others. Places are code points, ends exclusive. A null text is empty and has none;
    repeated rows each get theirs; an empty table gives an empty result; other columns are not read.
    """
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    # The value of an assignment ends the match, so its length is that of the second group.
    assign = (f"filter(zip_with({matches('t', ASSIGN)}, if(rlike(t, {_quoted(ASSIGN)}),"
              f" regexp_extract_all(t, {_quoted(ASSIGN)}, 2), cast(array() AS array<string>)),"
              " (m, v) -> struct(m.start AS start, m.end AS end, v AS value)), m -> length(m.value) >= 6)")
    kinds = {"assign": assign, "access": matches("t", ACCESS), "hex": matches("t", HEX)}
    named = ", ".join(f"transform({sql}, m -> struct(m.start AS start, {i} AS rank, '{kind}' AS kind, m.end AS end))"
                      for i, (kind, sql) in enumerate(kinds.items()))
    base = picked.withColumns({"base": F.expr(f"concat({named})"), "high": F.expr(entropy_spans("t", classes, allowed))})
    return base.select("doc_id", F.expr(
        "array_sort(concat(base, transform(filter(high, h -> NOT exists(base, b -> b.start <= h.start AND h.end <= b.end)),"
        f" h -> struct(h.start AS start, {len(kinds)} AS rank, 'entropy' AS kind, h.end AS end))))").alias("found"))


def span_text(found: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(found, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")
