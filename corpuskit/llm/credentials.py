"""Secrets in texts, with credentials that are linked from several parts.

Strong parts are reported wherever they occur:

* ``assign``: a key word (password, secret, token, api key ...), ``:`` or ``=``, and a value of six characters;
* ``access``: ``AKIA`` and capitals or digits, 20 characters at least;
* ``hex``: 24 lower-case hexadecimal digits or more.

Weak parts say nothing alone:

* ``account``: a user, login or client id with its value;
* ``opaque``: 20 characters or more of letters, digits and ``+/_-`` with a small letter, a capital and a digit;
* ``endpoint``: a URL, or a host, server or endpoint with its value.

``access`` and ``account`` identify, ``assign``, ``hex`` and ``opaque`` are secrets. Parts are joined as
intervals: two are together when no empty line lies between them (their scope) and their gap is at most
``reach`` characters. A weak part is reported when it and the parts together with it hold an identifier and
a secret, and one of these is strong or an endpoint is among them. An ``account`` that overlaps a strong
part is no part of its own, nor is an ``opaque`` one that overlaps any other part.

The join is within a document: the intervals of a kind don't overlap, so both their starts and their ends
are sorted, and two binary searches a kind tell whether any lies together with a part. Nothing is shuffled,
and no part is held against all others. Patterns are linear in the text. Null and empty texts have no
spans; repeated rows and ids are rows of their own; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REACH = 300
KINDS = ("assign", "access", "hex", "account", "opaque", "endpoint")
STRONG = ("assign", "access", "hex")
ROLES = {"assign": "secret", "access": "identifier", "hex": "secret", "account": "identifier",
         "opaque": "secret", "endpoint": "endpoint"}
SCOPE_BORDER = "\n\n"

SPANS = "array<struct<kind:string,start:int,end:int>>"


def either_case(word: str) -> str:
    """A pattern for ``word`` in ASCII letters of either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _any_of(words: str) -> str:
    return "|".join(either_case(w) for w in words.split())


_IS = r"""["']?\x20*[:=]\x20*["']?"""
#: What Python's re and RE2 read alike: no flags, no look-around.
PATTERNS = {
    "assign": f"({_any_of('password passwd secret token api_?key')}){_IS}([A-Za-z0-9+/_.=-]+)",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
    "account": rf"\b({_any_of('username user_name user login account client_?id access_?key_?id')}){_IS}([A-Za-z0-9@._+-]+)",
    "opaque": r"[A-Za-z0-9+/_-]+",
    "endpoint": rf"\b(?:({_any_of('https? ftp ssh postgres postgresql mysql mongodb redis amqps?')})://[^\x00-\x20\"'<>]+"
                rf"|({_any_of('hostname host server endpoint url')}){_IS}([A-Za-z0-9._:/-]+))",
}
#: Shortest match, and shortest value (the last group that took part) of a kind.
MIN_LENGTH = {"access": 20, "hex": 24, "opaque": 20}
MIN_VALUE = {"assign": 6, "account": 3, "endpoint": 4}
_HINT = (f"{_any_of('password passwd secret token apikey api_key')}"
         r"|AKIA[A-Z0-9]|[0-9a-f]{24}|[A-Za-z0-9+/_-]{20}")


def _longer(pattern: str, length: int) -> str:
    """The pattern of a class's maximal runs, for runs of ``length`` at least."""
    return pattern[:-1] + "{%d,}" % length


def parts(text: str) -> dict[str, list[tuple[int, int]]]:
    """Per kind, the parts of ``text`` as (start, end), in order."""
    found = {k: [] for k in KINDS}
    for kind, find in _compiled().items():
        for m in find(text):
            if kind in MIN_VALUE and m.lastindex and len(m.group(m.lastindex)) < MIN_VALUE[kind] and "://" not in m.group():
                continue
            if kind == "access" and m.end() - m.start() < MIN_LENGTH[kind]:
                continue
            if kind == "opaque" and not _mixed(m.group()):
                continue
            found[kind].append(m.span())
    found["account"] = _apart(found["account"], [found[k] for k in STRONG])
    found["opaque"] = _apart(found["opaque"], [found[k] for k in KINDS if k != "opaque"])
    return found


def _mixed(run: str) -> bool:
    return any("a" <= c <= "z" for c in run) and any("A" <= c <= "Z" for c in run) and any("0" <= c <= "9" for c in run)


_FINDERS: dict = {}


def _compiled() -> dict:
    import re

    if not _FINDERS:
        for kind, pattern in PATTERNS.items():
            if kind in ("hex", "opaque"):
                pattern = _longer(pattern, MIN_LENGTH[kind])
            _FINDERS[kind] = re.compile(pattern, re.ASCII).finditer
    return _FINDERS


def _apart(spans: list[tuple[int, int]], others: list[list[tuple[int, int]]]) -> list[tuple[int, int]]:
    """``spans`` that overlap none of the others."""
    for other in others:
        spans = [s for s, hit in zip(spans, _meets(spans, other, [(a + 1, b - 1) for a, b in spans])) if not hit]
    return spans


def _meets(spans, others, windows, scopes=None):
    """Whether any of the sorted, disjoint ``others`` touches each span's window inside its scope."""
    import numpy as np

    if not spans or not others:
        return [False] * len(spans)
    starts, ends = np.array(others).T
    low, high = np.array(windows).T
    first = np.searchsorted(ends, low, side="left")
    stop = np.searchsorted(starts, high, side="right")
    if scopes is not None:
        top, bottom = np.array(scopes).T
        first = np.maximum(first, np.searchsorted(starts, top, side="left"))
        stop = np.minimum(stop, np.searchsorted(ends, bottom, side="right"))
    return (stop > first).tolist()


def linked(text: str, reach: int = REACH) -> list[tuple[str, int, int]]:
    """All reported spans of ``text``: strong parts, and weak ones that others complete."""
    import bisect

    found = parts(text)
    out = [(kind, a, b) for kind in STRONG for a, b in found[kind]]
    weak = [(kind, a, b) for kind in KINDS if kind not in STRONG for a, b in found[kind]]
    if weak:
        spans = [(a, b) for _, a, b in weak]
        windows = [(a - reach, b + reach) for a, b in spans]
        border = [0]
        at = text.find(SCOPE_BORDER)
        while at >= 0:
            border.append(at + len(SCOPE_BORDER))
            at = text.find(SCOPE_BORDER, border[-1])
        border.append(len(text) + len(SCOPE_BORDER))
        scopes = []
        for a, _ in spans:
            i = bisect.bisect_right(border, a)
            scopes.append((border[i - 1], border[i] - len(SCOPE_BORDER)))
        near = {kind: _meets(spans, found[kind], windows, scopes) for kind in KINDS}
        for i, part in enumerate(weak):
            here = [kind for kind in KINDS if near[kind][i]]
            roles = {ROLES[kind] for kind in here}
            if {"secret", "identifier"} <= roles and ("endpoint" in roles or any(k in STRONG for k in here)):
                out.append(part)
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def find_secrets(docs: DataFrame, text: str = "text", out: str = "spans", reach: int = REACH) -> DataFrame:
    """``docs`` with ``out``: the reported spans ``(kind, start, end)`` in code points, end exclusive, by start.

    A column of that name is replaced.
    """
    @F.arrow_udf(SPANS)
    def spans(texts):
        import pyarrow as pa
        import pyarrow.compute as pc

        likely = pc.fill_null(pc.match_substring_regex(texts, _HINT), False).to_pylist()
        rows = [[{"kind": k, "start": a, "end": b} for k, a, b in linked(texts[i].as_py(), reach)] if hit else []
                for i, hit in enumerate(likely)]
        return pa.array(rows, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))

    return docs.withColumn(out, spans(F.col(text)))


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kinds(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
