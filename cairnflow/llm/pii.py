"""Format-preserving pseudonyms: a keyed Feistel permutation of each value's own format.

Card numbers (Luhn), IPv4 addresses, calendar dates, telephone and social security numbers
and the local parts of e-mail addresses are found, validated, and replaced by another value
of the same format. The permutation depends on the key and the kind alone, so equal values
stay equal in all documents, whatever separators they are written with, and different ones
stay different. The places of what was replaced are part of the result: with them the holder
of the key turns pseudonyms back, however the digits around them could be read.
"""

from __future__ import annotations

import bisect
import datetime
import hashlib
import math
import re
import secrets
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import session_of, table, worker_store
from .registry import query

ROUNDS = 10
REMEMBER = 100_000
#: Places of a local part that are permuted as one number; longer ones are permuted block by block.
BLOCK = 48
#: Groups that cards are printed in, besides a single one; such readings go before others.
PRINTED = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4)}
#: First digits of issued cards, lowest and highest, and their lengths; such readings go before the rest.
ISSUED = (("4", "4", (13, 16, 19)), ("51", "55", (16,)), ("2221", "2720", (16,)), ("34", "34", (15,)), ("37", "37", (15,)), ("300", "305", (14,)), ("36", "36", (14,)), ("38", "39", (14,)), ("6011", "6011", (16, 19)), ("644", "659", (16, 19)), ("3528", "3589", (16, 19)))
#: Dates of these years are permuted among themselves, and all others among themselves; so are days that may stand in a month's place, and later ones.
YEARS = range(1900, 2100)
LAST_EITHER_WAY = 12


class Feistel:
    """Permutations of numbers below a bound, chosen by a key and a kind."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key).digest()  # a key of any length counts whole

    def _round(self, kind: str, size: int, k: int, half: int) -> int:
        of = lambda n: n.to_bytes(n.bit_length() // 8 + 1, "little")
        data = b"|".join((kind.encode(), of(size), bytes([k]), of(half)))
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=16).digest(), "little")

    def _once(self, kind: str, size: int, a: int, b: int, value: int, back: bool) -> int:
        left, right = divmod(value, b)
        steps = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
        for k in steps:  # in turn, one half is shifted by a function of the other
            sign = -1 if back else 1
            if k % 2:
                right = (right + sign * self._round(kind, size, k, left)) % b
            else:
                left = (left + sign * self._round(kind, size, k, right)) % a
        return left * b + right

    def permute(self, kind: str, size: int, value: int, back: bool = False, allowed: Callable[[int], bool] | None = None) -> int:
        """Another number below ``size``, among the ``allowed`` if the value is; one to one. Cycle walking leaves what is none."""
        b = math.isqrt(size - 1) + 1
        while True:
            value = self._once(kind, size, b, b, value, back)
            if value < size and (allowed is None or allowed(value)):
                return value


def luhn_digit(digits: str) -> str:
    """The check digit that follows ``digits``."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (2 if k % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return str(-total % 10)


def _refill(shape: str, digits: str) -> str:
    """``digits`` in the places that ``shape`` has digits in."""
    new = iter(digits)
    return "".join(next(new) if c.isdigit() else c for c in shape)


def _digits(value: str) -> str:
    return "".join(c for c in value if c.isdigit())


def _is_date(year: int, month: int, day: int) -> bool:
    try:
        datetime.date(year, month, day)
    except ValueError:
        return False
    return True


class Pseudonyms:
    """Finds, validates and replaces; ``back`` turns pseudonyms into the values they stand for."""

    #: In order of trial at one place: kind, pattern.
    PATTERNS = (
        ("ip", r"(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)"),
        ("iso_date", r"\d{4}-\d{2}-\d{2}(?!-?\d)"),
        ("date", r"\d{1,2}[./]\d{1,2}[./]\d{4}(?![./]?\d)"),
        ("ssn", r"\d{3}-\d{2}-\d{4}(?!-?\d)"),
        ("card", r"\d(?:[ -]?\d){12,18}(?!\d)"),
        ("phone", r"\+?\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]\d{3,4}[ .-]\d{3,4}(?!\d)|\(?\d{3}\)?[ .-]\d{3}[.-]\d{4}(?!\d)|\d{3}-\d{4}(?![-\d])"),
    )
    EMAIL = r"[A-Za-z0-9._%+-]+(?=@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})"

    def __init__(self, key: bytes, back: bool = False):
        self.feistel, self.back = Feistel(key), back
        self.numbers = re.compile(r"(?<![\w.-])(?:" + "|".join(f"(?P<{k}>{p})" for k, p in self.PATTERNS) + ")", re.ASCII)
        self.group = re.compile(r"\d+", re.ASCII)
        self.email = re.compile(r"(?<![A-Za-z0-9._%+-])" + self.EMAIL)
        self.written = re.compile(r"\d{3}([.-])\d{3}\1\d{4}", re.ASCII).fullmatch
        self.known: dict[tuple[str, str], str | None] = {}

    def _permute(self, kind: str, digits: str) -> str:
        n = len(digits)
        return str(self.feistel.permute(f"{kind}{n}", 10**n, int(digits), self.back)).zfill(n)

    def ip(self, value: str) -> str | None:
        parts = value.split(".")
        if any(int(p) > 255 or str(int(p)) != p for p in parts):
            return None
        n = self.feistel.permute("ip", 1 << 32, int.from_bytes(bytes(map(int, parts)), "big"), self.back)
        return ".".join(map(str, n.to_bytes(4, "big")))

    def _date(self, year: int, month: int, day: int) -> tuple[int, int, int] | None:
        """Another date; days that could be months stay so, so that no form of a date is read in another way after."""
        if not _is_date(year, month, day):
            return None
        usual, late = year in YEARS, day > LAST_EITHER_WAY
        first, days = (LAST_EITHER_WAY + 1, 31 - LAST_EITHER_WAY) if late else (1, LAST_EITHER_WAY)
        years = len(YEARS) if usual else datetime.MAXYEAR - len(YEARS)
        nth = year - YEARS[0] if usual else year - 1 - (len(YEARS) if year > YEARS[-1] else 0)

        def of(n: int) -> tuple[int, int, int]:
            n, d = divmod(n, days)
            y, m = divmod(n, 12)
            y = y + YEARS[0] if usual else y + 1 + (len(YEARS) if y + 1 >= YEARS[0] else 0)
            return y, m + 1, d + first

        at = (nth * 12 + month - 1) * days + day - first
        return of(self.feistel.permute(f"date{usual}{late}", years * 12 * days, at, self.back, lambda n: _is_date(*of(n))))

    def iso_date(self, value: str) -> str | None:
        new = self._date(*map(int, value.split("-")))
        return None if new is None else "{:04}-{:02}-{:02}".format(*new)

    def date(self, value: str) -> str | None:
        """Day first, or month first where only that is a date; always written with two digits for both."""
        mark = "/" if "/" in value else "."
        if len(parts := value.split(mark)) != 3:
            return None
        first, second, year = map(int, parts)
        if (new := self._date(year, second, first)) is not None:
            return f"{new[2]:02}{mark}{new[1]:02}{mark}{new[0]:04}"
        new = self._date(year, first, second)
        return None if new is None else f"{new[1]:02}{mark}{new[2]:02}{mark}{new[0]:04}"

    def ssn(self, value: str) -> str | None:
        """Area 001 to 899 but 666, group and serial not all zeros."""
        area, group, serial = map(int, value.split("-"))
        if not 0 < area < 900 or area == 666 or not group or not serial:
            return None
        number = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
        number, serial = divmod(self.feistel.permute("ssn", 898 * 99 * 9999, number, self.back), 9999)
        area, group = divmod(number, 99)
        area += 1
        return f"{area + (area >= 666):03}-{group + 1:02}-{serial + 1:04}"

    def card(self, value: str) -> str | None:
        digits = _digits(value)
        if luhn_digit(digits[:-1]) != digits[-1] or set(digits) == {"0"}:
            return None
        body = self._permute("card", digits[:-1])
        return _refill(value, body + luhn_digit(body))

    @staticmethod
    def _national(digits: str) -> bool:
        """Ten digits of the North American plan: area and exchange start with 2 to 9."""
        return len(digits) == 10 and digits[0] > "1" and digits[3] > "1"

    def phone(self, value: str) -> str | None:
        """Numbers of the North American plan, with or without 1 before and in every form; local ones of its seven
        digits; others, of 8 to 15 digits, only with +, an area in brackets, a trunk 0 or as 123-456-7890."""
        digits = _digits(value)
        lead, own = ("1", digits[1:]) if len(digits) == 11 and digits[0] == "1" else ("", digits)
        if self._national(own):
            return _refill(value, lead + self._walk("national", own, self._national))
        if len(digits) == 7 and "(" not in value and "+" not in value:
            exchange = lambda d: d[0] > "1"
            return _refill(value, self._walk("local", digits, exchange)) if exchange(digits) else None
        trunk = digits[0] == "0" and 9 <= len(digits) <= 11
        if not 8 <= len(digits) <= 15 or not (trunk or ("+" in value and digits[0] != "0") or "(" in value or self.written(value)):
            return None
        zero = digits[0] == "0"
        same = lambda d: (d[0] == "0") == zero and not self._national(d[1:] if len(d) == 11 and d[0] == "1" else d)
        return _refill(value, self._walk("abroad", digits, same))

    def _walk(self, kind: str, digits: str, allowed: Callable[[str], bool]) -> str:
        """``digits`` permuted among those of their number that are allowed."""
        n = len(digits)
        return str(self.feistel.permute(f"{kind}{n}", 10**n, int(digits), self.back, lambda v: allowed(str(v).zfill(n)))).zfill(n)

    def local_part(self, value: str) -> str:
        """Letters among letters of their case, digits among digits, all else in place."""
        out = list(value)
        for kind, first, size, has in (("low", "a", 26, str.islower), ("up", "A", 26, str.isupper), ("digit", "0", 10, str.isdigit)):
            every = [k for k, c in enumerate(value) if has(c)]
            for block in range(0, len(every), BLOCK):
                places, n = every[block : block + BLOCK], 0
                for k in places:
                    n = n * size + ord(value[k]) - ord(first)
                n = self.feistel.permute(f"{kind}{len(every)}-{block}", size ** len(places), n, self.back)
                for k in reversed(places):
                    n, c = divmod(n, size)
                    out[k] = chr(ord(first) + c)
        return "".join(out)

    def _of(self, kind: str, value: str, make: Callable[[str], str | None]) -> str | None:
        key = (kind, value)
        if key not in self.known:
            if len(self.known) > REMEMBER:
                self.known.clear()
            self.known[key] = make(value)
        return self.known[key]

    def _readings(self, text: str, start: int, end: int) -> list[tuple[bool, int, int]]:
        """(printed, start, end) of what may be a card and starts in a match of the card pattern.

        Best first: groups that cards are printed in, then numbers that issuers give, then the longer, then the earlier.
        """
        groups: list[tuple[int, int]] = []
        for g in self.group.finditer(text, start):
            if groups and (g.start() != groups[-1][1] + 1 or text[g.start() - 1] not in " -" or g.start() > end + 38):
                break
            groups.append(g.span())
        found = []
        for k, (first, _) in enumerate(groups):
            if first >= end:
                break
            sizes: tuple[int, ...] = ()
            for s, e in groups[k:]:
                sizes += (e - s,)
                n = sum(sizes)
                if n > 19:
                    break
                if n >= 13:
                    marks = {c for c in text[first:e] if not c.isdigit()}
                    digits = _digits(text[first:e])
                    issued = any(low <= digits[: len(low)] <= high and n in lengths for low, high, lengths in ISSUED)
                    found.append((len(sizes) == 1 or (sizes in PRINTED and len(marks) == 1), issued, n, first, e))
        found.sort(key=lambda r: (not r[0], not r[1], -r[2], r[3]))
        return [(printed, s, e) for printed, _, _, s, e in found]

    def _scan(self, text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int, str, str]]:
        """(start, end, kind, new value) of the numbers outside ``taken``."""
        found: list[tuple[int, int, str, str]] = []
        ends = [b for _, b in taken]  # in order, as they do not overlap

        def free(s: int, e: int) -> bool:
            k = bisect.bisect_right(ends, s)
            return k == len(taken) or taken[k][0] >= e

        at = 0
        while m := self.numbers.search(text, at):
            kind, start, at = m.lastgroup, m.start(), m.end()
            if kind != "card":
                new = self._of(kind, m[0], getattr(self, kind)) if free(start, at) else None
                if new is not None:
                    found.append((start, at, kind, new))
                continue
            readings = self._readings(text, start, at)
            for _, s, e in readings:
                if free(s, e) and (new := self._of("card", text[s:e], self.card)) is not None:
                    found.append((s, e, "card", new))
                    at = e
                    break
            else:
                if (True, start, at) not in readings:  # no card: other values may start at the next group
                    at = self.group.match(text, start).end()
        return found

    def replace(self, text: str) -> tuple[str, list[str], list[int], list[int]]:
        """(new text, kinds found, their places in it, their lengths)."""
        emails = []
        if "@" in text:
            emails = [(m.start(), m.end(), "email", self._of("email", m[0], self.local_part)) for m in self.email.finditer(text)]
        found = sorted(emails + self._scan(text, [(s, e) for s, e, *_ in emails]))
        return self._put(text, found)

    def restore(self, text: str, kinds: list[str], starts: list[int], lengths: list[int]) -> tuple[str, list[str], list[int], list[int]]:
        """The same of the values at the places that ``replace`` named."""
        make = {"email": self.local_part}
        spans = zip(starts, lengths, kinds, strict=True)
        return self._put(text, [(s, s + n, k, self._of(k, text[s : s + n], make.get(k) or getattr(self, k))) for s, n, k in spans])

    @staticmethod
    def _put(text: str, found: list[tuple[int, int, str, str]]) -> tuple[str, list[str], list[int], list[int]]:
        out, places, at, size = [], [], 0, 0
        for start, end, _, new in found:
            out += [text[at:start], new]
            size += start - at
            places.append(size)
            size += len(new)
            at = end
        return "".join([*out, text[at:]]), [f[2] for f in found], places, [len(f[3]) for f in found]


def pseudonymise(df: DataFrame, key: bytes, text: str = "text", back: bool = False) -> DataFrame:
    """``df`` with ``text`` replaced, and n_values, kinds, starts and lengths of what was replaced.

    A value's pseudonym depends on the key and the value alone. Null texts stay null with no
    values; empty ones stay empty. Columns named n_values, kinds, starts or lengths are replaced;
    all others and repeated rows pass as they are. With ``back`` a result under the same key, these
    columns included, is turned back (a one-digit day or month comes back with two).
    """
    session_of(df)
    places = ("kinds", "starts", "lengths")
    rows = df if back else df.drop("n_values", *places)
    others = [f for f in rows.schema if f.name not in ("n_values", *places)]
    schema = T.StructType(list(others)).add("n_values", T.LongType()).add("kinds", T.ArrayType(T.StringType())).add("starts", T.ArrayType(T.IntegerType())).add("lengths", T.ArrayType(T.IntegerType()))

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = worker_store("pii")
        if (key, back) not in store:
            store[key, back] = Pseudonyms(key, back)
        own = store[key, back]
        for batch in batches:
            texts = batch.column(text).to_pylist()
            if back:
                given = zip(texts, *(batch.column(n).to_pylist() for n in places), strict=True)
                done = [(None, [], [], []) if t is None else own.restore(t, k or [], s or [], n or []) for t, k, s, n in given]
            else:
                done = [(None, [], [], []) if t is None else own.replace(t) for t in texts]
            columns = [pa.array([d[0] for d in done], pa.string()) if f.name == text else batch.column(f.name) for f in others]
            more = [pa.array([len(d[1]) for d in done], pa.int64()), pa.array([d[1] for d in done], pa.list_(pa.string())), *(pa.array([d[k] for d in done], pa.list_(pa.int32())) for k in (2, 3))]
            yield pa.RecordBatch.from_arrays([*columns, *more], names=[*(f.name for f in others), "n_values", *places])

    return rows.mapInArrow(replace, schema)


@query("op1_pseudonyms")
def op1_pseudonyms(spark, sf_dir):
    """Under the session's key, whose name makes Spark keep it out of logs and pages; without one a key of this run
    alone, so that nobody can turn its pseudonyms back and two runs differ."""
    key = spark.conf.get("spark.cairnflow.pseudonymSecret", None)
    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key.encode() if key else secrets.token_bytes(32))
