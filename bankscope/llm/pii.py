"""Personal data replaced by pseudonyms of the same format.

A value that passes its kind's check (check digits, calendar, octets, area
codes) is taken as a number in the set of all valid values of its format, and
a keyed Feistel network permutes that set: equal values get equal pseudonyms
in every document, different values different ones, and whoever holds the key
can undo it.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import without

ROUNDS = 10
#: Only for tests and trial runs: a deployment passes its own secret key.
DEMO_KEY = b"not a secret"


def _mix(key: bytes, tweak: bytes, rnd: int, half: int, bits: int) -> int:
    n = (bits + 7) // 8
    data = tweak + bytes([rnd]) + half.to_bytes(n, "big")
    out = b"".join(hashlib.blake2b(data, digest_size=64, key=key, salt=bytes([i])).digest() for i in range((n + 63) // 64))
    return int.from_bytes(out[:n], "big") & ((1 << bits) - 1)


def permute(x: int, size: int, key: bytes, tweak: str, undo: bool = False) -> int:
    """The image of x in 0..size-1 under the keyed permutation (its inverse
    with ``undo``): a balanced Feistel network over the next even number of
    bits, walked on while it leads outside."""
    if size < 2:
        return x
    bits = max(1, ((size - 1).bit_length() + 1) // 2)
    low, t, k = (1 << bits) - 1, tweak.encode(), hashlib.sha256(key).digest()
    while True:
        a, b = x >> bits, x & low
        for r in range(ROUNDS):
            if undo:
                a, b = b ^ _mix(k, t, ROUNDS - 1 - r, a, bits), a
            else:
                a, b = b, a ^ _mix(k, t, r, b, bits)
        x = (a << bits) | b
        if x < size:
            return x


def _luhn(digits: str) -> int:
    """The check digit that belongs after ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _into(shape: str, new: str) -> str:
    """``shape`` with its letters and digits replaced in order by ``new``."""
    it = iter(new)
    return "".join(next(it) if c.isalnum() else c for c in shape)


@cache
def _days(over_12: bool) -> range | list[int]:
    """Ordinals of the days of 1900 to 2099.  What reads as d/m/y because
    its day is over 12 must read so afterwards: then only such days."""
    days = range(dt.date(1900, 1, 1).toordinal(), dt.date(2100, 1, 1).toordinal())
    return [n for n in days if dt.date.fromordinal(n).day > 12] if over_12 else days


class Pseudonyms:
    """Pseudonyms under one key; each method takes a match and gives its
    pseudonym, or None if the value is not valid."""

    def __init__(self, key: bytes, undo: bool = False):
        self.key, self.undo = key, undo

    def _p(self, x: int, size: int, tweak: str) -> int:
        return permute(x, size, self.key, tweak, self.undo)

    def chars(self, s: str, tweak: str) -> str:
        """Digits stay digits, small and capital ASCII letters such; all else stays."""
        x, size, sets = 0, 1, []
        for c in s:
            base = "0" if "0" <= c <= "9" else "a" if "a" <= c <= "z" else "A" if "A" <= c <= "Z" else ""
            n = {"0": 10, "a": 26, "A": 26, "": 1}[base]
            sets.append((base, n))
            x, size = x * n + (ord(c) - ord(base) if base else 0), size * n
        shape = "".join(b or c for c, (b, _) in zip(s, sets, strict=True))
        x, out = self._p(x, size, f"{tweak}:{shape}"), []
        for c, (base, n) in zip(reversed(s), reversed(sets), strict=True):
            x, r = divmod(x, n)
            out.append(chr(ord(base) + r) if base else c)
        return "".join(reversed(out))

    def card(self, s: str) -> str | None:
        d = re.sub(r"\D", "", s)
        if not 13 <= len(d) <= 19 or _luhn(d[:-1]) != int(d[-1]) or len(set(d)) == 1:
            return None
        body = f"{self._p(int(d[:-1]), 10 ** (len(d) - 1), f'card:{len(d)}'):0{len(d) - 1}d}"
        return _into(s, body + str(_luhn(body)))

    def iban(self, s: str) -> str | None:
        v = re.sub(r"\s", "", s)
        number = lambda t: int("".join(str(int(c, 36)) for c in t))
        if not 15 <= len(v) <= 34 or number(v[4:] + v[:4]) % 97 != 1:
            return None
        body = self.chars(v[4:], f"iban:{v[:2]}")
        return _into(s, f"{v[:2]}{98 - number(f'{body}{v[:2]}00') % 97:02d}{body}")

    def ssn(self, s: str) -> str | None:
        area, group, serial = map(int, s.split("-"))
        if not (0 < area < 900 and area != 666 and group and serial):
            return None
        areas = [a for a in range(1, 900) if a != 666]
        x = self._p((areas.index(area) * 99 + group - 1) * 9999 + serial - 1, len(areas) * 99 * 9999, "ssn")
        x, n = divmod(x, 9999)
        a, g = divmod(x, 99)
        return f"{areas[a]:03d}-{g + 1:02d}-{n + 1:04d}"

    def phone(self, s: str) -> str | None:
        """North American numbers: area and exchange begin with 2 to 9."""
        d = re.sub(r"\D", "", s)
        lead, d = d[:-10], d[-10:]
        if len(d) < 10 or lead not in ("", "1") or d[0] < "2" or d[3] < "2":
            return None
        x = ((int(d[:3]) - 200) * 800 + int(d[3:6]) - 200) * 10_000 + int(d[6:])
        x, line = divmod(self._p(x, 800 * 800 * 10_000, "phone"), 10_000)
        area, exchange = divmod(x, 800)
        return _into(s, f"{lead}{area + 200}{exchange + 200}{line:04d}")

    def abroad(self, s: str) -> str | None:
        """Other international numbers: the first group of digits stays."""
        d = re.sub(r"\D", "", s)
        if not 8 <= len(d) <= 15:
            return None
        head = re.match(r"\+\d{1,3}(?=\D)|\+\d{2}", s)[0]
        return head + self.chars(s[len(head):], f"abroad:{head}")

    def ip(self, s: str) -> str | None:
        o = [int(x) for x in s.split(".")]
        if max(o) > 255 or any(len(x) > 1 and x[0] == "0" for x in s.split(".")):
            return None
        x = self._p(int.from_bytes(bytes(o), "big"), 1 << 32, "ip")
        return ".".join(map(str, x.to_bytes(4, "big")))

    def date(self, s: str) -> str | None:
        """Days of 1900 to 2099; the order of day and month stays as it is,
        and parts without a leading zero are written so."""
        m = re.fullmatch(r"(\d{1,4})([-/.])(\d{1,2})\2(\d{1,4})", s)
        first, sep, mid, last = m.groups()
        try:
            if len(first) == 4:
                order, day = "ymd", dt.date(int(first), int(mid), int(last))
            elif len(last) != 4:
                return None
            elif sep == "/" and int(first) <= 12:
                order, day = "mdy", dt.date(int(last), int(first), int(mid))
            else:
                order, day = "dmy", dt.date(int(last), int(mid), int(first))
        except ValueError:
            return None
        days = _days(order == "dmy" and sep == "/")
        if day.toordinal() not in days:
            return None
        kind = "date" if isinstance(days, range) else "date:dmy"
        new = dt.date.fromordinal(days[self._p(days.index(day.toordinal()), len(days), kind)])
        wide = 2 if min(len(x) for x in (first, mid, last)) > 1 else 1
        parts = {"y": f"{new.year:04d}", "m": f"{new.month:0{wide}d}", "d": f"{new.day:0{wide}d}"}
        return sep.join(parts[c] for c in order)

    def email(self, s: str) -> str:
        local, _, host = s.rpartition("@")
        labels = host.split(".")
        if len(labels) > 2:  # the last two labels, the registered name, stay
            return f"{self.chars(local + '@' + '.'.join(labels[:-2]), 'email')}.{'.'.join(labels[-2:])}"
        return f"{self.chars(local, 'email')}@{host}"

    def secret(self, s: str) -> str:
        """Hexadecimal values stay so; others keep the kind of each character."""
        if re.fullmatch(r"[0-9a-f]+", s):
            return f"{self._p(int(s, 16), 16 ** len(s), f'hex:{len(s)}'):0{len(s)}x}"
        return self.chars(s, "secret")

    def access(self, s: str) -> str:
        return s[:4] + self.chars(s[4:], "access")


#: Kind and pattern; the first that matches at a place and is valid wins.
PATTERNS = (
    ("email", r"(?<![\w.+-])[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    ("access", r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])"),
    ("secret", r"(?<=[=:\x22' ])[0-9a-f]{32,}(?![A-Za-z0-9])|(?:(?<=password=)|(?<=passwd=)|(?<=pwd=)|(?<=secret=)|(?<=token=)"
               r"|(?<=api_key=)|(?<=apikey=)|(?<=password:)|(?<=password: )|(?<=password = )|(?<=secret: )|(?<=secret = )"
               r"|(?<=token: )|(?<=token = \x22)|(?<=token=\x22)|(?<=secret = \x22)|(?<=key = \x22))[A-Za-z0-9_./+-]{6,}"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    ("ip", r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)"),
    ("date", r"(?<![\w./-])\d{4}([-/.])\d{1,2}\1\d{1,2}(?![\w]|[./-]\d)|(?<![\w./-])\d{1,2}([-/.])\d{1,2}\2\d{4}(?![\w]|[./-]\d)"),
    ("ssn", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w]|-\d)"),
    ("phone", r"(?<![\w+(-])(?:\+?1[ .-]?)?(?:\([2-9]\d{2}\)[ .-]?|[2-9]\d{2}[ .-])[2-9]\d{2}[ .-]\d{4}(?![\w]|[.-]\d)"),
    ("abroad", r"(?<![\w+])\+[2-9]\d{0,2}(?:[ .-]?\(?\d{2,4}\)?){2,5}(?![\w]|[.-]\d)"),
    ("card", r"(?<!\d)(?:\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}([ -])\d{6}\2\d{5}|\d{13,19})(?!\d)"),
)
KINDS = tuple(k for k, _ in PATTERNS)


def replacer(key: bytes, undo: bool = False) -> Callable[[str], tuple[str, list[tuple[str, int, int, str]]]]:
    """A function of a text that gives the new text and (kind, start, end,
    pseudonym) for each value, in code points of the given text."""
    p = Pseudonyms(key, undo)
    compiled = [(k, re.compile(x)) for k, x in PATTERNS]

    def replace(text: str) -> tuple[str, list[tuple[str, int, int, str]]]:
        found: list[tuple[str, int, int, str]] = []
        taken: list[tuple[int, int]] = []
        for kind, pattern in compiled:
            for m in pattern.finditer(text):
                a, b = m.span()
                new = None if any(a < y and x < b for x, y in taken) else getattr(p, kind)(m[0])
                if new is not None:
                    found.append((kind, a, b, new))
                    taken.append((a, b))
        found.sort(key=lambda x: x[1])
        out, at = [], 0
        for _, a, b, new in found:
            out += [text[at:a], new]
            at = b
        return "".join([*out, text[at:]]), found

    return replace


def pseudonymise(docs: DataFrame, key: bytes = DEMO_KEY, text: str = "text", undo: bool = False) -> DataFrame:
    """``docs`` with the personal data of its text replaced, and
    ``pii_spans``: (kind, start, end, pseudonym) of each value, in code points
    of the given text.  A null text stays null with no spans, an empty one
    empty.  A column pii_spans (any letter case) is replaced.  Every text
    is searched: some values have neither a digit nor an @."""

    @F.arrow_udf("text string, spans array<struct<kind:string,start:int,end:int,pseudonym:string>>")
    def change(texts: pa.Array) -> pa.Array:
        replace = replacer(key, undo)
        new = [(None, None) if t is None else replace(t) for t in texts.to_pylist()]
        pa.default_memory_pool().release_unused()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("pseudonym", pa.string())]))
        spans = [s and [dict(zip(("kind", "start", "end", "pseudonym"), x, strict=True)) for x in s] for _, s in new]
        return pa.StructArray.from_arrays([pa.array([t for t, _ in new], pa.string()), pa.array(spans, kind)], names=["text", "spans"])

    d = without(docs, "pii_spans").withColumn("_llm_pii", change(text))
    none = F.array().cast("array<struct<kind:string,start:int,end:int,pseudonym:string>>")
    return d.select(*[F.coalesce(F.col("_llm_pii.text"), F.col(text)).alias(c) if c == text else F.col(f"`{c}`") for c in d.columns
                      if c != "_llm_pii"], F.coalesce(F.col("_llm_pii.spans"), none).alias("pii_spans"))


def summary(docs: DataFrame, key: bytes = DEMO_KEY) -> DataFrame:
    """Query op10: the new text of each document and how many values of it
    were replaced, in all and by kind."""
    d = pseudonymise(docs.select("doc_id", "text"), key)

    def count(kind: str) -> F.Column:
        return F.size(F.filter("pii_spans", lambda s: s["kind"] == kind)).cast("long")

    by = [count(k).alias(f"n_{k}") for k in KINDS]
    return d.select("doc_id", "text", F.size("pii_spans").cast("long").alias("n_private"), *by)
