"""PII: replace detected entities by keyed surrogates of the same type and format.

An entity's characters are read as a number in a mixed radix (digits, vowels, consonants,
letters of its script), and a keyed permutation of all numbers of that pattern gives the
surrogate: digits stay digits, case and punctuation stay, card numbers keep their checksum's
state, addresses their network class, names their gender (names on a list become others of
the same list; the rest keep their last letter). A permutation keeps different entities
apart, and equal ones are replaced alike in every document. No entity maps to itself.

The corpus-wide check then looks for surrogates that some document really holds, or that
two entities share; those entities take the next key, until none collides. Where a pattern is used up,
surrogates grow by a character per further key, so that every entity gets one in the end.

Detected kinds, by their form only; what has another form stays in clear:

* ``email``; ``ip`` (IPv4); ``iban``; ``ssn`` (ddd-dd-dddd);
* ``card``: 13 to 19 digits in a row, or grouped by blanks or hyphens 4-4-4-4, 4-6-5 or 4-6-4;
* ``phone``: international with ``+``; (ddd) ddd-dddd and ddd-ddd-dddd with an optional 1 before it
  (blanks or dots too; three numbers in a longer row of numbers parted by blanks are none); an area
  code with trunk 0, in brackets or set off by blank, slash or hyphen, and five digits or more; five
  pairs of digits from 0. A national number without separators is taken for a plain number;
* ``secret``: lower-case hexadecimal runs of 24 to 128 with letters and digits, keys that start as ``sk pk ghp
  xoxb AKIA`` do, and values of six characters or more with a digit after one of ``SECRET_KEYS`` (any
  case) and ``=`` or ``:``;
* ``name``: up to three words after one of ``TITLES``, with a Latin, Greek or Cyrillic capital, or a
  run of up to four Chinese characters (of a longer run, three), and their other mentions in the same
  text. Names without a title, native Greek, Cyrillic or Chinese titles and other scripts are not found.

Defined results: null stays null and empty empty; a text without entities is unchanged;
repeated rows are replaced alike; other columns pass through; ``n_found`` and ``kinds`` of
the result replace columns of those names.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.common import drop_written, within, written

#: Re-keyed entities up to this many go to the tasks with the function; more are joined.
CLOSURE_ROWS = 10_000
#: From this attempt on, surrogates grow by a character per attempt (their pattern is used up).
LONGER_FROM = 4
#: Attempts that one round after the first makes for each entity that waits.
ATTEMPTS_A_ROUND = 8
#: A surrogate that is still taken this many characters beyond its pattern is an error.
MOST_ATTEMPTS = 1000
RESULT = "struct<text:string,n_found:int,kinds:array<string>>"

# --- fixed values: titles, first names by gender, letters ---------------------
TITLES = {"Mr": "m", "Mr.": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr.": "m", "Herrn": "m",
          "Mrs": "f", "Mrs.": "f", "Ms": "f", "Ms.": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f",
          "Señora": "f", "Sra.": "f", "Dr": "", "Dr.": "", "Prof.": ""}
FIRST_NAMES = {
    "f": "Alice Anna Barbara Carmen Charlotte Clara Elena Emma Eva Frances Grace Hannah Helen Ida Irene Isabel Jane "
         "Julia Karin Laura Lucia Maria Martha Nora Olivia Paula Rosa Sarah Sofia Teresa Ursula Vera".split(),
    "m": "Adam Albert Arthur Bruno Carlos Daniel David Edward Emil Felix Frank George Henry Hugo Ivan James Jan John "
         "Karl Leo Louis Martin Max Michael Oscar Paul Pedro Peter Robert Samuel Thomas Victor".split()}
ALPHABETS = ("0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "áéíóúàèìòùâêîôûäëïöü", "çñśźčšžřýß",
             "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "αεηιουω", "βγδζθκλμνξπρστφχψ", "άέήίόύώ")
HEX = "0123456789abcdef"
PREFIXES = "sk|pk|ghp|xoxb"
SECRET_KEYS = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey")

WORD = r"[^\W\d_][\w'’-]*"
#: Latin, Greek and Cyrillic capitals; the ideographs that have surrogates.
CAPITALS = "".join(c for c in map(chr, (*range(0x530), *range(0x1E00, 0x2000))) if c.isupper())
HAN = "[\u4e00-\u9fa5]"
PHONES = (
    r"\+[0-9]{1,3}[ .-]?(?:\(0\)[ .-]?)?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])",
    r"(?<![0-9])\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    r"(?<![0-9A-Za-z])(?<![0-9][.-])(?:1[ .-])?[2-9][0-9]{2}(?:[ .-][2-9][0-9]{2}-|\.[2-9][0-9]{2}\.)[0-9]{4}(?![0-9]|[.-][0-9])",
    r"(?<![0-9A-Za-z])(?<![0-9][ .-])(?:1 )?[2-9][0-9]{2} [2-9][0-9]{2} [0-9]{4}(?![0-9]|[ .-][0-9])",
    r"(?<![0-9A-Za-z])(?<![0-9][.-])(?:\(0[1-9][0-9]{1,4}\) ?|0[1-9][0-9]{1,4}(?: ?[/-] ?| ))"
    r"(?:[0-9]{5,8}(?:-[0-9]{1,4})?|[0-9]{3,4}[ -][0-9]{3,4}(?:[ -][0-9]{2,4})?|[0-9]{2,3}(?:[ -][0-9]{2,3}){2,3})(?![0-9])",
    r"(?<![0-9A-Za-z])(?<![0-9][ .-])0[1-9](?:[ .-][0-9]{2}){4}(?![0-9]|[ .-][0-9])",
)
#: Addresses are found apart from the rest, so that a run of characters without "@" is read once.
EMAIL = re.compile(r"(?<![\w.%+-])[\w.%+-]++(?=(@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+))")
PATTERN = re.compile("|".join((
    rf"(?P<secret>(?<![0-9A-Za-z])(?:(?=[0-9a-f]*[a-f])(?=[0-9a-f]*[0-9])[0-9a-f]{{24,128}}|(?:{PREFIXES})[-_][0-9A-Za-z]{{16,}}|AKIA[0-9A-Z]{{16}})(?![0-9A-Za-z]))",
    rf"(?P<keyed>(?i:{'|'.join(SECRET_KEYS)})[\"']?(?: ?= ?| ?: ?)[\"']?(?P<value>(?=[A-Za-z+/_-]*[0-9])[0-9A-Za-z+/_-]{{6,}}))",
    r"(?P<iban>(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z]))",
    r"(?P<ip>(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9]))",
    rf"(?P<phone>{'|'.join(PHONES)})",
    r"(?P<card>(?<![0-9])(?:[0-9]{13,19}|(?:[0-9]{4}[ -]){3}[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})(?![0-9]))",
    r"(?P<ssn>(?<![0-9])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]))",
    rf"(?P<person>(?<!\w)(?:{'|'.join(re.escape(t) for t in sorted(TITLES, key=len, reverse=True))}) (?:(?:[{CAPITALS}]{WORD[WORD.index(']') + 1:]}(?: |\b)){{1,3}}|{HAN}{{1,4}}(?!{HAN})|{HAN}{{3}}))",
)))
STARTS, RUN, HAN_RUN, WORD_CHAR = (re.compile(x) for x in (rf"(?<!\w)[^\W\d_]|{HAN}", WORD, HAN + "{1,4}", r"\w"))
#: Names up to this length are followed through their text.
FOLLOWED = 100
#: What every entity but a name has; prefixed keys may be letters only.
HINT = re.compile(rf"[0-9@=:]|(?:{PREFIXES})[-_]|AKIA")
TITLE_HINTS = ("Mr", "Ms", "Miss", "Herr", "Frau", "Monsieur", "Madame", "Mme", "Señor", "Sr.", "Sra.", "Dr", "Prof.")


def _round(key: bytes, label: bytes, n: int, value: int, span: int) -> int:
    size = max(8, (span.bit_length() + 71) // 8)
    out = b""
    while len(out) < size:
        out += hashlib.blake2b(label + bytes([n, len(out) & 255]) + value.to_bytes((value.bit_length() + 8) // 8, "big"),
                               key=key).digest()
    return int.from_bytes(out[:size], "big") % span


def permute(key: bytes, label: bytes, x: int, span: int, back: bool = False) -> int:
    """A keyed permutation of 0 .. span-1 (a Feistel network, walked until it lands inside)."""
    if span == 1:
        return 0
    half = 1
    while half * half < span:
        half *= 2
    while True:
        a, b = divmod(x, half)
        for n in range(6):
            if back:
                a, b = (b - _round(key, label, 5 - n, a, half)) % half, a
            else:
                a, b = b, (a + _round(key, label, n, b, half)) % half
        x = a * half + b
        if x < span:
            return x


def other(key: bytes, label: str, x: int, span: int) -> int:
    """A keyed permutation of 0 .. span-1 that moves every number (if there are two)."""
    if span < 2:
        return x
    name = label.encode()
    shift = 1 + _round(key, b"shift" + name, 0, span, span - 1)
    return permute(key, name, (permute(key, name, x, span) + shift) % span, span, back=True)


def respell(key: bytes, label: str, text: str, sets: list[str | None]) -> str:
    """``text`` with each character replaced from its set (None: kept), as one permutation of the pattern."""
    lower, x, span = text.lower(), 0, 1
    if len(lower) != len(text):
        lower = text
    sets = [s if s and c in s else None for c, s in zip(lower, sets)]
    for c, s in zip(lower, sets):
        if s:
            x, span = x * len(s) + s.index(c), span * len(s)
    fixed = "".join("?" if s else c for c, s in zip(lower, sets))
    shape = ",".join(str(s) for s in sets if s)
    y = other(key, f"{label}|{fixed}|{shape}", x, span)
    out = []
    for c, low, s in zip(reversed(text), reversed(lower), reversed(sets)):
        if s:
            y, at = divmod(y, len(s))
            low = s[at]
            c = low.upper() if c.isupper() and len(low.upper()) == 1 else low
        out.append(c)
    return "".join(reversed(out))


@lru_cache(maxsize=1)
def _letters() -> dict[str, str]:
    return {c: a for a in ALPHABETS for c in a}


def _sets(text: str) -> list[str | None]:
    low = text.lower()
    out: list[str | None] = [_letters().get(c) for c in (low if len(low) == len(text) else text)]
    for i, c in enumerate(text):
        if out[i] is None and "一" <= c <= "鿿":
            out[i] = _ideographs()
    return out


@lru_cache(maxsize=1)
def _ideographs() -> str:
    return "".join(map(chr, range(0x4E00, 0x9FA6)))


def _luhn(digits: str) -> int:
    """The check digit that belongs after ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 * (d > 9)
    return -total % 10


def _card(key: bytes, text: str) -> str:
    digits = "".join(c for c in text if c.isdigit())
    n, head, off = len(digits), digits[:-1], (int(digits[-1]) - _luhn(digits[:-1])) % 10
    lead = head[0] != "0"  # a number keeps its first digit's kind
    low, span = (10 ** (n - 2), 9 * 10 ** (n - 2)) if lead else (0, 10 ** (n - 2))
    if off == 0:
        head = str(other(key, f"card{n}{lead}", int(head) - low, span) + low).zfill(n - 1)
    else:
        x = other(key, f"id{n}{lead}", (int(head) - low) * 9 + off - 1, span * 9)
        head, off = str(x // 9 + low).zfill(n - 1), x % 9 + 1
    new = iter(head + str((_luhn(head) + off) % 10))
    return "".join(next(new) if c.isdigit() else c for c in text)


def _network(x: int) -> int:
    a, b = x >> 24, x >> 16 & 255
    return 1 if a == 10 or a == 172 and 16 <= b < 32 or a == 192 and b == 168 else 2 if a == 127 else 3 if a >= 224 or a == 0 else 0


def _address(key: bytes, text: str, attempt: int) -> str:
    parts = [int(p) for p in text.split(".")]
    if max(parts) > 255 or text != ".".join(map(str, parts)):
        return respell(key, "number", text, _sets(text))
    x = int.from_bytes(bytes(parts), "big")
    y = other(key, "ip", x, 1 << 32)
    while _network(y) != _network(x) and attempt < LONGER_FROM:  # a network may be used up
        y = other(key, "ip", y, 1 << 32)
    return ".".join(map(str, y.to_bytes(4, "big")))


def _longer(key: bytes, text: str, sets: list[str | None], attempt: int, letters: str = "") -> str:
    """Letters of the text's script (or ``letters``) to lengthen a surrogate whose pattern is used up."""
    letters = letters or next((x for x in sets if x and x != ALPHABETS[0]), ALPHABETS[2])
    return "".join(letters[_round(key, b"longer" + text.lower().encode(), i, i, len(letters))]
                   for i in range(max(0, attempt - LONGER_FROM + 1)))


def _name(key: bytes, text: str, gender: str, attempt: int) -> str:
    plain = text.capitalize()
    for names in (FIRST_NAMES.values() if attempt < LONGER_FROM else ()):
        if plain in names:
            new = names[other(key, "name" + names[0], names.index(plain), len(names))]
            return new.upper() if text.isupper() and len(text) > 1 else new
    sets = _sets(text)
    if len(text) > 3 and sets[-1] is not _ideographs():
        sets[-1] = None  # endings carry gender
    longer = _longer(key, text, sets, attempt)
    got = respell(key, "name", text, sets)
    return got[:-1] + (longer.upper() if text.isupper() else longer) + got[-1:]


def _dialled(text: str, sets: list[str | None]) -> None:
    """Keep what makes a phone number one of its form: country code, trunk 0, the range of first digits."""
    code = re.match(r"(?:\+\d{1,3}(?=\D)|\+\d)(?:[ .-]?\(0\))?|1[ .-]|", text).end()
    sets[:code] = [None] * code
    if text[0] == "+":
        return
    digits = [i for i in range(code, len(text)) if text[i].isdigit()]
    if text[digits[0]] == "0":
        sets[digits[0]], sets[digits[1]] = None, "123456789"
    elif text[code] == "(":
        sets[digits[0]] = "123456789"
    else:
        sets[digits[0]] = sets[digits[3]] = "23456789"


def surrogate(secret: str, kind: str, text: str, attempt: int = 0, gender: str = "") -> str:
    """The replacement of one entity; ``attempt`` counts the keys tried before."""
    key = hashlib.blake2b(f"{secret}/{kind}/{attempt}".encode(), digest_size=32).digest()
    if kind == "name":
        return _name(key, text, gender, attempt)
    sets = _sets(text)
    numbers = _longer(key, text, sets, attempt, ALPHABETS[0])
    if kind == "card":
        return _card(key, text) + numbers
    if kind == "ip":
        return _address(key, text, attempt)
    if kind == "email":
        domain = text.rindex("@") + 1
        keep = len(".".join(text[domain:].split(".")[-2:]))  # the registered domain
        for i in [domain - 1, *range(len(text) - keep, len(text))]:
            sets[i] = None
        got = respell(key, kind, text, sets)
        return got[: domain - 1] + _longer(key, text, sets, attempt) + got[domain - 1:]
    if kind == "phone":
        _dialled(text, sets)
    elif kind == "secret":
        start = re.match(rf"(?:{PREFIXES})[-_]|AKIA|", text).end()
        sets[:start] = [None] * start
        if not start and all(c in HEX for c in text):
            sets = [HEX] * len(text)
    elif kind == "iban":
        sets[:2] = [None, None]
    if kind == "iban" and len(text) > 4:
        letters = {d: "abcdefghijklmnopqrstuvwxyz" for d in (ALPHABETS[1], ALPHABETS[2])}
        sets = [letters.get(s, s) if s else s for s in sets]
    if kind == "secret":
        return respell(key, kind, text, sets) + _longer(key, text, sets, attempt, HEX if HEX in sets else "")
    return respell(key, kind, text, sets) + numbers


def canonical(kind: str, text: str) -> str:
    """What two mentions of one entity have in common."""
    return text.lower() if kind in ("email", "name") else text


def entities(text: str) -> list[tuple[int, int, str, str, str]]:
    """``(start, end, kind, mention, gender)`` in order; names found once are followed through the text."""
    if not text or not (HINT.search(text) or any(t in text for t in TITLE_HINTS)):
        return []
    found, names = [], {}
    for start, end, m in _matches(text):
        kind = "email" if m is None else m.lastgroup
        if m is None:
            found.append((start, end, kind, text[start:end], ""))
        elif kind == "person":
            title, rest = m.group().split(" ", 1)
            gender = TITLES[title]
            for w in re.finditer(WORD, rest):
                at = m.start() + len(title) + 1
                found.append((at + w.start(), at + w.end(), "name", w.group(), gender))
                names.setdefault(w.group().lower(), (w.group(), gender))
        elif kind == "keyed":
            found.append((*m.span("value"), "secret", m.group("value"), ""))
        elif kind == "ip" and max(map(int, m.group().split("."))) > 255:
            continue
        else:
            found.append((m.start(), m.end(), kind, m.group(), ""))
    if names:
        taken = sorted((a, b) for a, b, *_ in found)
        starts = [a for a, _ in taken]
        for a, b in _mentions(text, names):
            i = bisect_right(starts, a)
            apart = (i == 0 or taken[i - 1][1] <= a) and (i == len(taken) or b <= taken[i][0])
            if apart and not text[a].islower():
                mention = text[a:b]
                found.append((a, b, "name", mention, names[mention.lower()][1]))
        found.sort()
    return found


def _matches(text: str):
    """``(start, end, match)`` from left to right, without overlap; the match is None for an e-mail address."""
    at, m = 0, PATTERN.search(text)
    for e in EMAIL.finditer(text):
        while m and m.start() < max(e.start(), at):
            yield m.start(), m.end(), m
            at = m.end()
            m = PATTERN.search(text, at)
        start = max(e.start(), at)
        if start < e.end():
            yield start, e.end(1), None
            at = e.end(1)
            if m and m.start() < at:
                m = PATTERN.search(text, at)
    while m:
        yield m.start(), m.end(), m
        m = PATTERN.search(text, m.end())


def _mentions(text: str, names: dict):
    """Spans of the names in a text, in any case of letters; of names that start at one place the longest.

    A name stands between characters that are no letters or digits; a Chinese one of two characters or more
    stands in running text without a border.
    """
    names = {n for n in names if len(n) <= FOLLOWED}
    longest, at = max(map(len, names), default=0), 0
    for m in STARTS.finditer(text):
        p = m.start()
        if p < at or not names:
            continue
        end = 0
        if HAN_RUN.match(text, p):
            end = next((p + k for k in (4, 3, 2) if text[p:p + k] in names and HAN_RUN.match(text, p).end() >= p + k), 0)
        if not end and (p == 0 or not WORD_CHAR.match(text, p - 1)):
            run = RUN.match(text, p, p + longest).group()
            k = len(run)
            while k > 0:
                if not WORD_CHAR.match(text, p + k) and run[:k].lower() in names:
                    end = p + k
                    break
                k = max(run.rfind(c, 0, k) for c in "'’-")
        if end:
            yield p, end
            at = end


def replace(text: str, secret: str, attempts: dict[tuple[str, str], int]) -> tuple[str, int, list[str]]:
    """The text with its entities replaced, their number and kinds."""
    found = entities(text)
    if not found:
        return text, 0, []
    out, at = [], 0
    for start, end, kind, mention, gender in found:
        again = attempts.get((kind, canonical(kind, mention)), 0) if attempts else 0
        out += [text[at:start], surrogate(secret, kind, mention, again, gender)]
        at = end
    return "".join([*out, text[at:]]), len(found), [f[2] for f in found]


def found_entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(__text_key, kind, value, gender)``, one row per text and distinct entity in it."""

    def find(column: pa.Array) -> pa.Array:
        rows = [[{"kind": k, "value": v, "gender": g} for k, v, g in
                 sorted({(f[2], canonical(f[2], f[3]), f[4]) for f in entities(t.as_py() or "")})] for t in column]
        return pa.array(rows, pa.list_(pa.struct([("kind", pa.string()), ("value", pa.string()), ("gender", pa.string())])))

    udf = F.arrow_udf(find, "array<struct<kind:string,value:string,gender:string>>")
    return docs.select(F.col(text).alias("__text")).select(
        F.md5(F.col("__text").cast("binary")).alias("__text_key"), F.explode(udf("__text")).alias("e")).select(
        "__text_key", "e.*")


def rekeyed(found: DataFrame, secret: str) -> DataFrame:
    """``(kind, value, attempt)`` of the entities whose first surrogate collides; checks the whole corpus."""
    # the surrogate of a name doesn't depend on its title, so the gender is no part of the entity
    known = written(found.groupBy("kind", "value").agg(F.min("gender").alias("gender")), "entities")

    @F.arrow_udf("array<struct<attempt:int,new:string>>")
    def tried(kinds, values, genders, first, last):
        rows = zip(*[c.to_pylist() for c in (kinds, values, genders, first, last)])
        return pa.array([[{"attempt": n, "new": canonical(k, surrogate(secret, k, v, n, g))} for n in range(a, z)]
                         for k, v, g, a, z in rows], pa.list_(pa.struct([("attempt", pa.int32()), ("new", pa.string())])))

    real = known.select(F.col("kind").alias("k"), F.col("value").alias("v"))
    settled, waiting, first, last = [], known, 0, 1
    while True:
        if first > MOST_ATTEMPTS:
            raise ValueError(f"no free surrogate after {MOST_ATTEMPTS} attempts")
        now = waiting.select("kind", "value", "gender", F.explode(tried(
            "kind", "value", "gender", F.lit(first), F.lit(last))).alias("t")).select("kind", "value", "gender", "t.*")
        used = reduce(DataFrame.unionAll, [real, *[s.select("kind", "new") for s in settled]]).distinct()
        free = now.join(used, (F.col("kind") == F.col("k")) & (F.col("new") == F.col("v")), "left_anti")
        # each takes its first free surrogate; of several that take the same one, the smallest keeps it
        taken = free.groupBy("kind", "value").agg(F.min(F.struct("attempt", "new")).alias("t")).select("kind", "value", "t.*")
        keeps = taken.groupBy("kind", "new").agg(F.min("value").alias("value"))
        judged = written(taken.join(keeps, ["kind", "new", "value"]).select("kind", "value", "attempt", "new"), "rekeyed")
        settled.append(judged)
        waiting = written(waiting.join(judged, ["kind", "value"], "left_anti"), "waiting")
        if waiting.isEmpty():
            return reduce(DataFrame.unionAll, settled).where("attempt > 0").select("kind", "value", "attempt")
        first, last = last, last + ATTEMPTS_A_ROUND


def pseudonymize(docs: DataFrame, secret: str, text: str = "text") -> DataFrame:
    """``docs`` with replaced texts, ``n_found`` and ``kinds``."""
    found = written(found_entities(docs, text), "found")
    again = written(rekeyed(found, secret), "again")
    small = within(again, CLOSURE_ROWS)
    attempts = {(r.kind, r.value): r.attempt for r in again.collect()} if small else {}

    def one(column: pa.Array, more: pa.Array | None = None) -> pa.Array:
        texts, counts, kinds = [], [], []
        for i, t in enumerate(column):
            own = attempts
            if more is not None:
                own = {(x["kind"], x["value"]): x["attempt"] for x in (more[i].as_py() or ())}
            got = (None, 0, []) if not t.is_valid else replace(t.as_py(), secret, own)
            for col, x in zip((texts, counts, kinds), got):
                col.append(x)
        return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(counts, pa.int32()),
                                           pa.array(kinds, pa.list_(pa.string()))], names=["text", "n_found", "kinds"])

    if small:
        drop_written(found)
        done = docs.withColumn("__new", F.arrow_udf(lambda t: one(t), RESULT)(F.col(text)))
    else:
        per_text = found.join(again, ["kind", "value"]).groupBy("__text_key").agg(
            F.collect_set(F.struct("kind", "value", "attempt")).alias("__more"))  # the entities of one text
        keyed = docs.withColumn("__key", F.md5(F.col(text).cast("binary")))
        done = (keyed.join(per_text, F.col("__key") == F.col("__text_key"), "left").drop("__key", "__text_key")
                .withColumn("__new", F.arrow_udf(lambda t, m: one(t, m), RESULT)(F.col(text), F.col("__more"))).drop("__more"))
    return (done.withColumn(text, F.col("__new.text")).withColumn("n_found", F.col("__new.n_found"))
            .withColumn("kinds", F.col("__new.kinds")).drop("__new"))
