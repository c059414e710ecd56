"""Personal data: format-preserving pseudonyms by a keyed Feistel permutation.

Found values are validated (checksums, calendar, ranges) and mapped within their own format by a keyed permutation,
so equal values get equal pseudonyms in every document and unequal ones stay apart. Nothing is looked up or shuffled.
"""

from __future__ import annotations

import datetime
import hashlib
import ipaddress
import re
import warnings
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROUNDS = 8
KINDS = ("email", "phone", "card", "iban", "ssn", "ip", "date")
#: A public key, for tests and for queries of a session that names none in KEY_SETTING.
PUBLIC_KEY = "public test key"
KEY_SETTING = "spark.hydrolake.pseudonym.key"

#: Names of the months.
MONTHS = {
    "en": "january february march april may june july august september october november december".split(),
    "short": "jan feb mar apr may jun jul aug sep oct nov dec".split(),
    "de": "januar februar märz april mai juni juli august september oktober november dezember".split(),
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre".split(),
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre".split(),
}
_NAME = "|".join(sorted({m for names in MONTHS.values() for m in names}, key=len, reverse=True))

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
_EMAIL_OR_IBAN = re.compile(f"{_EMAIL.pattern}|{_IBAN.pattern}")
_IP6 = re.compile(r"(?<![\w:.])(?=[0-9A-Fa-f:]*[0-9])(?:[0-9A-Fa-f]{1,4}:|::)[0-9A-Fa-f:]*(?:::|[0-9A-Fa-f])(?![\w:])")
_WRITTEN = re.compile(rf"(?<![\w.])(?:(?P<d>\d{{1,2}})(?P<o>st|nd|rd|th|)(?P<s1>\. | of | | de )(?P<m>{_NAME})(?P<s2>,? | de )|(?P<m2>{_NAME})(?P<s3>\.? )(?P<d2>\d{{1,2}})(?P<o2>st|nd|rd|th|)(?P<s4>, | ))(?P<y>\d{{4}})(?!\w)", re.IGNORECASE)
_BEFORE_YEAR = re.compile(r" \d{4}(?!\w)")


#: Country codes of one and of two digits; all others have three.
ONE_DIGIT = {"1", "7"}
TWO_DIGITS = set("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())


def country_code(digits: str) -> str:
    """The code that international digits begin with; no code is the beginning of another."""
    return digits[:1] if digits[:1] in ONE_DIGIT else digits[:2] if digits[:2] in TWO_DIGITS else digits[:3]


def ordinal(day: int) -> str:
    return "th" if 10 < day < 14 else {1: "st", 2: "nd", 3: "rd"}.get(day % 10, "th")


def _number(*kinds: str) -> re.Pattern:
    return re.compile(rf"(?<![\w.])(?:{'|'.join(kinds)})(?!\w)(?!\.\d)", re.VERBOSE)


_KINDS_OF_NUMBER = (
    r"""(?P<phone>(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}|\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}|\d{3}[.-]\d{3}[.-]\d{4}
      |0\d(?:[ .]\d\d){4}|0\d{1,4}[ /-]\d{5,8}|[2-9]\d{9})""",
    r"(?P<date>\d{4}(?P<by>[-/.])\d{2}(?P=by)\d{2}|\d{1,2}(?P<sep>[-/.])\d{1,2}(?P=sep)\d{4})",
    r"(?P<ssn>\d{3}-\d{2}-\d{4})",
    r"(?P<ip>\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})",
    r"(?P<card>\d(?:[ -]?\d){12,18})",
)
_NUMBER, _NO_CARD = _number(_KINDS_OF_NUMBER[-1], *_KINDS_OF_NUMBER[:-1]), _number(*_KINDS_OF_NUMBER[:-1])
LAST = datetime.date.max.toordinal()
USUAL = range(datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal() + 1)


class Feistel:
    """Keyed permutations of 0..n-1 for any n >= 1: balanced Feistel rounds on the next even number of bits, walked
    along the cycle until the value is in range again (a quarter of the values at least are)."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, tweak: bytes, i: int, half: int, n_bytes: int) -> int:
        data = tweak + bytes([i]) + half.to_bytes(n_bytes, "big")
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=min(64, n_bytes + 8)).digest(), "big")

    def permute(self, x: int, n: int, tweak: str, fits: Callable[[int], bool] = lambda _: True, back: bool = False) -> int:
        """The image of x among the values that fit (``back``: whose image x is); x itself must fit."""
        if n < 2:
            return x
        half_bits = max(1, ((n - 1).bit_length() + 1) // 2)
        mask, n_bytes, name = (1 << half_bits) - 1, (half_bits + 7) // 8, f"{tweak}:{n}:".encode()
        while True:
            left, right = x >> half_bits, x & mask
            for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
                if back:
                    left, right = right ^ (self._round(name, i, left, n_bytes) & mask), left
                else:
                    left, right = right, left ^ (self._round(name, i, right, n_bytes) & mask)
            x = left << half_bits | right
            if x < n and fits(x):
                return x


def luhn_digit(digits: str) -> str:
    """The check digit that follows ``digits``."""
    total = sum(sum(divmod(2 * int(c), 10)) if i % 2 == 0 else int(c) for i, c in enumerate(reversed(digits)))
    return str(-total % 10)


def iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


class Pseudonyms:
    """Replacements of one value of each kind; None: it isn't valid, so it stays. ``back``: from pseudonyms to values."""

    def __init__(self, key: bytes, back: bool = False):
        self._permute = partial(Feistel(key).permute, back=back)
        for kind in (*KINDS, "ip6", "written"):
            setattr(self, kind, lru_cache(maxsize=20_000)(getattr(self, f"_{kind}")))

    def _refill(self, text: str, fresh: str) -> str:
        """``text`` with its letters and digits replaced in turn."""
        it = iter(fresh)
        return "".join(next(it) if c.isalnum() else c for c in text)

    def _mixed(self, text: str, tweak: str) -> str:
        """Letters within their case, digits as digits, other characters stay."""
        radix = [(10, "0") if c.isdigit() else (26, "a") if c.islower() else (26, "A") for c in text if c.isascii() and c.isalnum()]
        own = [c for c in text if c.isascii() and c.isalnum()]
        x = n = 0
        for c, (r, zero) in zip(own, radix, strict=True):
            x, n = x * r + ord(c) - ord(zero), (n or 1) * r
        x = self._permute(x, n, f"{tweak}:{''.join(z for _, z in radix)}")
        out = []
        for r, zero in reversed(radix):
            x, d = divmod(x, r)
            out.append(chr(ord(zero) + d))
        return self._refill(text, "".join(reversed(out)))

    def _email(self, text: str) -> str | None:
        name, _, host = text.partition("@")
        return f"{self._mixed(name, 'email@' + host.lower())}@{host}" if re.search("[A-Za-z0-9]", name) else None

    def _phone(self, text: str) -> str | None:
        """Country code (or a national number's leading 0) stays; a number without either counts as one of +1.

        The code is told by its digits alone, so a number has one pseudonym however it is spaced or bracketed.
        """
        digits = re.sub(r"\D", "", text)
        head = country_code(digits) if text.startswith("+") else "0" if digits[0] == "0" else ""
        own = digits[len(head) :]
        if not 6 <= len(own) <= 15:
            return None
        code = head if text.startswith("+") else head or "1"
        fits = self._ten_digits(own) if code == "1" and len(own) == 10 else lambda v: (v < 10 ** (len(own) - 1)) == (own[0] == "0")
        fresh = self._permute(int(own), 10 ** len(own), f"phone{code}:{len(own)}", fits)
        return self._refill(text, f"{head}{fresh:0{len(own)}d}")

    @staticmethod
    def _ten_digits(digits: str) -> Callable[[int], bool]:
        """Whether another number of ten digits is of the same kind: its first and fourth digit both 2 to 9 or not."""
        kind = lambda d: (d[0] >= "2", d[3] >= "2")
        own = kind(digits)
        return lambda v: kind(f"{v:010d}") == own

    def _card(self, text: str) -> str | None:
        digits = re.sub(r"\D", "", text)
        if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
            return None
        fresh = f"{self._permute(int(digits[:-1]), 10 ** (len(digits) - 1), 'card'):0{len(digits) - 1}d}"
        return self._refill(text, fresh + luhn_digit(fresh))

    def _iban(self, text: str) -> str | None:
        own = text.replace(" ", "")
        if not 15 <= len(own) <= 34 or iban_rest(own) != 1:
            return None
        body = self._mixed(own[4:], "iban" + own[:2])
        check = 98 - iban_rest(own[:2] + "00" + body)
        return self._refill(text, f"{own[:2]}{check:02d}{body}")

    def _ssn(self, text: str) -> str | None:
        good = re.compile(r"(?!000|666|9)\d{3}(?!00)\d{2}(?!0000)\d{4}")
        digits = text.replace("-", "")
        if not good.fullmatch(digits):
            return None
        fresh = self._permute(int(digits), 10**9, "ssn", lambda v: good.fullmatch(f"{v:09d}") is not None)
        return self._refill(text, f"{fresh:09d}")

    def _ip(self, text: str) -> str | None:
        parts = [int(p) for p in text.split(".")]
        if max(parts) > 255 or any(len(p) > 1 and p[0] == "0" for p in text.split(".")):
            return None
        fresh = self._permute(int.from_bytes(bytes(parts), "big"), 2**32, "ip")
        return ".".join(map(str, fresh.to_bytes(4, "big")))

    def _ip6(self, text: str) -> str | None:
        """Any spelling of an address gives the usual spelling of its pseudonym."""
        try:
            address = int(ipaddress.IPv6Address(text))
        except ValueError:
            return None
        return str(ipaddress.IPv6Address(self._permute(address, 2**128, "ip6"))) if address > 1 else None

    def _day(self, year: int, month: int, day: int) -> datetime.date | None:
        """The pseudonym of a date: 1900 to 2099 among themselves, other years too; days up to the 12th among themselves.

        So a date written month first, which is one only if its day is after the 12th, stays such a date.
        """
        try:
            own = datetime.date(year, month, day)
        except ValueError:
            return None
        usual, late = own.toordinal() in USUAL, day > 12
        fits = lambda v: v > 0 and (v in USUAL) == usual and (datetime.date.fromordinal(v).day > 12) == late
        # most walks stay short: usual dates are permuted within their own range
        first, n = (USUAL.start, len(USUAL)) if usual else (0, LAST + 1)
        return datetime.date.fromordinal(first + self._permute(own.toordinal() - first, n, f"date{usual}{late}", lambda v: fits(v + first)))

    def _date(self, text: str) -> str | None:
        parts = re.split(r"[-/.]", text)
        # year first, or day first; month first if only that is a date
        for order in ((0, 1, 2),) if len(parts[0]) == 4 else ((2, 1, 0), (2, 0, 1)):
            fresh = self._day(*(int(parts[i]) for i in order))
            if fresh:
                values = dict(zip(order, (fresh.year, fresh.month, fresh.day), strict=True))
                said = [f"{values[i]:0{len(parts[i])}d}" for i in range(3)]
                return re.sub(r"\d+", lambda _, it=iter(said): next(it), text)
        return None

    def _written(self, text: str) -> str | None:
        m = _WRITTEN.fullmatch(text)
        name, day = m["m"] or m["m2"], m["d"] or m["d2"]
        first = "es" if m["s1"] == " de " else "de" if m["s1"] == ". " else "en"
        names = next(MONTHS[lang] for lang in (first, "en", "fr", "es", "de", "short") if name.lower() in MONTHS[lang])
        suffix = m["o"] or m["o2"] or ""
        fresh = self._day(int(m["y"]), names.index(name.lower()) + 1, int(day)) if suffix.lower() in ("", ordinal(int(day))) else None
        if fresh is None:
            return None
        said = names[fresh.month - 1]
        said = said.upper() if name.isupper() else said.capitalize() if name[0].isupper() else said
        after = ordinal(fresh.day) if suffix else ""
        at = f"{fresh.day:0{len(day)}d}{after.upper() if suffix.isupper() else after}"
        return f"{at}{m['s1']}{said}{m['s2']}{fresh.year:04d}" if m["d"] else f"{said}{m['s3']}{at}{m['s4']}{fresh.year:04d}"

    def replace(self, text: str) -> tuple[str, list[int]]:
        """The text with pseudonyms, and how many of each kind."""
        counts = dict.fromkeys(KINDS, 0)

        def put(kind: str, old: str, counted: str | None = None) -> str:
            new = getattr(self, kind)(old)
            if new is None:
                return old
            counts[counted or kind] += 1
            return new

        def number(m: re.Match) -> str:
            own = m[0]
            new = put("date" if m.lastgroup in ("sep", "by") else m.lastgroup, own)
            # digits that are no card may be several numbers in a row
            return _NO_CARD.sub(number, own) if m.lastgroup == "card" and new is own else new

        def numbers(part: str) -> str:
            part = _NUMBER.sub(number, part)
            if _BEFORE_YEAR.search(part):
                part = _WRITTEN.sub(lambda m: put("written", m[0], "date"), part)
            return _IP6.sub(lambda m: put("ip6", m[0], "ip"), part) if "::" in part or part.count(":") > 6 else part

        out, done = [], 0
        for m in (_EMAIL_OR_IBAN if "@" in text else _IBAN).finditer(text):
            own = m[0]
            new = put("email" if "@" in own else "iban", own)
            if new is not own:  # numbers within it are its own
                out += [numbers(text[done : m.start()]), new]
                done = m.end()
        text = "".join(out) + numbers(text[done:])
        return text, [counts[k] for k in KINDS]


def pseudonymise(docs: DataFrame, key: str, columns: Sequence[str] | None = None, text: str = "text") -> DataFrame:
    """``columns`` (all by default) with ``text`` pseudonymised, and n_<kind> per kind (long), a row for each row.

    Null text stays null with counts 0; empty text stays empty. Whole texts are read; rows keep their place, so this
    is one pass without a shuffle. Columns whose name clashes with a count are replaced by the count.
    """
    counts = [f"n_{k}" for k in KINDS]
    columns = [c for c in (docs.columns if columns is None else columns) if c not in counts]
    kept = docs.select(*[F.col(f"`{c}`") for c in columns])
    at = columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(key.encode())
        for batch in batches:
            texts, numbers = [], []
            for t in batch.column(at).to_pylist():
                new, n = (None, [0] * len(KINDS)) if t is None else names.replace(t)
                texts.append(new)
                numbers.append(n)
            arrays = list(batch.columns)
            arrays[at] = pa.array(texts, pa.string())
            per_kind = list(zip(*numbers, strict=True)) if numbers else [()] * len(KINDS)
            yield pa.RecordBatch.from_arrays([*arrays, *[pa.array(c, pa.int64()) for c in per_kind]], names=[*columns, *counts])

    schema = T.StructType([*kept.schema.fields, *[T.StructField(c, T.LongType()) for c in counts]])
    return kept.mapInArrow(run, schema)


def session_key(spark: SparkSession) -> str:
    """The key that the session names; without one the public key, with a warning: anybody can undo its pseudonyms."""
    key = spark.conf.get(KEY_SETTING, None)
    if key is None:
        warnings.warn(f"{KEY_SETTING} is unset: pseudonyms use the public key", stacklevel=2)
    return key or PUBLIC_KEY


def pseudonymised_documents(docs: DataFrame, key: str) -> DataFrame:
    """The documents themselves with pseudonyms; n_chars follows the new text."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("_row")
    found = pseudonymise(docs.select(rest, "text"), key).select("_row.*", "text").select([f"`{c}`" for c in docs.columns])
    return found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else found
