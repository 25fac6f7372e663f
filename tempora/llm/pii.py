"""Personal data to keyed pseudonyms of the same format.

Values are found by pattern, validated (check digits, number ranges, calendar), and mapped to their
place in a finite domain: the numbers of that format.  A keyed Feistel network permutes the domain;
a result that is no valid value of the format is permuted again until it is one (cycle walking), so
the map is a bijection on the valid values: equal values get equal pseudonyms in every document and
different values different ones, and whoever has the key can go back.

Kinds: e-mail addresses (the local part, letter for letter and digit for digit; the domain stays),
phone numbers of the North American plan and international ones (+ and country code stay), payment
cards (first digit stays, the Luhn digit is computed anew), social security numbers, IBANs (country
stays, check digits computed anew), IPv4 addresses and calendar dates (three orders).  Separators and
widths stay as written.  Numbers that don't validate are left alone; a North American number with +1 or
its area code in parentheses is one by its shape, bare groups of digits are if the plan has such numbers.

Defined results: a null text stays null and an empty one empty, with no findings; overlapping
candidates go to the kind listed first; repeated rows are treated alike; whole texts are read, however long, and
positions count code points of the input; an empty table gives no rows; further columns aren't looked at.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tempora.llm.common import documents

KEY = b"replace with a secret of the deployment"
ROUNDS = 8

_CANDIDATE = re.compile(r"""
    (?P<email>(?<![\w.+%-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![\w-]))
  | (?P<iban>(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9]))
  | (?P<ipv4>(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9]|[A-Za-z_]))
  | (?P<date>(?<![\w./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}(?=T[0-9]{2})|(?:[0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{4})(?![\w/-]|\.[0-9])))
  | (?P<ssn>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))
  | (?P<phone>(?<![\w+])(?:\+?1[\x20.-]?)?(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?!\w))
  | (?P<abroad>(?<![\w+])\+(?!1[\x20.(-])[1-9][0-9]{0,2}(?:[\x20-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})){2,6}(?![\w]|\.[0-9]))
  | (?P<card>(?<![\w.-])[2-6][0-9]{3}(?:[\x20-]?[0-9]{1,6}){2,4}(?![\w-]|\.[0-9]))
""", re.VERBOSE | re.ASCII)


def feistel(value: int, left: int, right: int, key: bytes, tweak: bytes, back: bool = False) -> int:
    """Keyed permutation of ``0 <= value < left * right`` (an unbalanced generalised Feistel network)."""
    a, b = divmod(value, right)

    def f(i: int, half: int) -> int:
        h = blake2b(b"%d:%d" % (i, half), key=key[:64], person=tweak[:16], digest_size=24)
        return int.from_bytes(h.digest(), "big")

    for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
        sign = -1 if back else 1
        if i % 2:
            b = (b + sign * f(i, a)) % right
        else:
            a = (a + sign * f(i, b)) % left
    return a * right + b


class Domain:
    """The values ``0 .. size-1`` of which ``valid`` tells those of the format."""

    def __init__(self, sizes: list[int], key: bytes, tweak: str):
        half = len(sizes) // 2
        self.left, self.right = 1, 1
        for s in sizes[:half]:
            self.left *= s
        for s in sizes[half:]:
            self.right *= s
        self.key, self.tweak = key, blake2b(tweak.encode(), digest_size=16).digest()

    def permuted(self, value: int, valid: Callable[[int], bool], back: bool = False) -> int:
        """Cycle walking: the next valid value on the permutation's cycle, which ``value`` is on."""
        while True:
            value = feistel(value, self.left, self.right, self.key, self.tweak, back)
            if valid(value):
                return value


def luhn(digits: str) -> bool:
    total = sum(int(c) for c in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])) % 10 == 0


def _refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in turn."""
    it = iter(digits)
    return "".join(next(it) if "0" <= c <= "9" else c for c in shape)


def _number(shape: str, digits: str, head: int, key: bytes, kind: str, back: bool,
            valid: Callable[[str], bool]) -> str:
    """Permute all digits after the first ``head``, among the valid numbers."""
    lead, n = digits[:head], len(digits) - head
    domain = Domain([10] * n, key, f"{kind}{n}{lead}")
    got = domain.permuted(int(digits[head:]), lambda v: valid(lead + str(v).zfill(n)), back)
    return _refill(shape, lead + str(got).zfill(n))


def _email(text: str, key: bytes, back: bool) -> str:
    local, _, host = text.rpartition("@")
    sizes = {"a": (26, 97), "A": (26, 65), "0": (10, 48)}
    kinds = [("0" if c.isdigit() else "a" if c.islower() else "A") if c.isalnum() else None for c in local]
    used = [k for k in kinds if k]
    value = 0
    for c, k in zip(local, kinds):
        if k:
            value = value * sizes[k][0] + ord(c) - sizes[k][1]
    radix = [sizes[k][0] for k in used]
    value = Domain(radix, key, "email" + "".join(k or "." for k in kinds)).permuted(
        value, lambda _: True, back)
    out: list[str] = []
    for c, k in zip(reversed(local), reversed(kinds)):
        if k:
            value, d = divmod(value, sizes[k][0])
            c = chr(sizes[k][1] + d)
        out.append(c)
    return "".join(reversed(out)) + "@" + host


def _iban_check(country: str, body: str) -> str:
    number = "".join(str(int(c, 36)) for c in body + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _iban(text: str, key: bytes, back: bool) -> str | None:
    flat = text.replace(" ", "")
    country, body = flat[:2], flat[4:]
    if not 15 <= len(flat) <= 34 or _iban_check(country, body) != flat[2:4]:
        return None
    kinds = [c.isdigit() for c in body]
    value = 0
    for c, digit in zip(body, kinds):
        value = value * 10 + int(c) if digit else value * 26 + ord(c) - 65
    value = Domain([10 if d else 26 for d in kinds], key, "iban" + country + str(kinds)).permuted(
        value, lambda _: True, back)
    out = []
    for digit in reversed(kinds):
        value, d = divmod(value, 10 if digit else 26)
        out.append(str(d) if digit else chr(65 + d))
    body = "".join(reversed(out))
    it = iter(country + _iban_check(country, body) + body)
    return "".join(c if c == " " else next(it) for c in text)


def _ipv4(text: str, key: bytes, back: bool) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    # a pseudonym has as many digits in each part
    low = [(10 ** (len(p) - 1) if len(p) > 1 else 0) for p in parts]
    size = [min(10 ** len(p), 256) - a for p, a in zip(parts, low)]
    value = 0
    for p, a, s in zip(parts, low, size):
        value = value * s + int(p) - a
    value = Domain(size, key, "ipv4" + ".".join(str(len(p)) for p in parts)).permuted(
        value, lambda _: True, back)
    out = []
    for a, s in zip(reversed(low), reversed(size)):
        value, d = divmod(value, s)
        out.append(str(a + d))
    return ".".join(reversed(out))


_FIRST, _DAYS = dt.date(1900, 1, 1).toordinal(), (dt.date(2100, 1, 1) - dt.date(1900, 1, 1)).days


def _date(text: str, key: bytes, back: bool) -> str | None:
    """Year first; else day first after points or when the first field is over 12; else month first."""
    parts, sep = re.split(r"[-/.]", text), re.findall(r"[-/.]", text)
    if sep[0] != sep[1]:
        return None
    late = len(parts[0]) < 4 and sep[0] != "." and int(parts[0]) > 12  # then the day is over 12
    order = (0, 1, 2) if len(parts[0]) == 4 else (2, 1, 0) if sep[0] == "." or late else (2, 0, 1)
    year, month, day = (int(parts[i]) for i in order)
    try:
        number = dt.date(year, month, day).toordinal() - _FIRST
    except ValueError:
        return None
    if not 0 <= number < _DAYS:
        return None

    def written(v: int) -> str:
        """In the same order and widths, or empty if the date can't be written so."""
        d = dt.date.fromordinal(v + _FIRST)
        new = [""] * 3
        for at, field in zip(order, (d.year, d.month, d.day)):
            new[at] = str(field).zfill(len(parts[at]))
        fits = all(len(x) == len(p) for x, p in zip(new, parts)) and (d.day > 12 or not late)
        return sep[0].join(new) if fits else ""

    # 289 * 253 = 73,117: the 73,049 days and a few numbers that are walked over
    domain = Domain([289, 253], key, f"date{sep[0]}{[len(p) for p in parts]}{late}")
    return written(domain.permuted(number, lambda v: v < _DAYS and bool(written(v)), back))


@lru_cache(maxsize=100_000)
def pseudonym(kind: str, text: str, key: bytes = KEY, back: bool = False) -> str | None:
    """The pseudonym of a candidate, or None if it is no valid value; ``back`` inverts."""
    digits = "".join(c for c in text if "0" <= c <= "9")
    if kind == "email":
        return _email(text, key, back)
    if kind == "iban":
        return _iban(text, key, back)
    if kind == "ipv4":
        return _ipv4(text, key, back)
    if kind == "date":
        return _date(text, key, back)
    if kind == "ssn":
        def ssn(d: str) -> bool:
            return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"
        return _number(text, digits, 0, key, kind, back, ssn) if ssn(digits) else None
    if kind == "phone":
        head = len(digits) - 10
        def nanp(d: str) -> bool:
            return d[head] >= "2" and d[head + 3] >= "2" and d[head + 1:head + 3] != "11"
        if nanp(digits):
            return _number(text, digits, head, key, kind, back, nanp)
        # written out in full it is a phone number by its shape; those out of the plan keep among themselves
        if text[0] == "+" or "(" in text:
            return _number(text, digits, head, key, kind, back, lambda d: not nanp(d))
        return None
    if kind == "abroad":
        if not 8 <= len(digits) <= 15:
            return None
        return _number(text, digits, 3, key, kind, back, lambda d: True)
    def issued(d: str) -> bool:  # of the cards that start with 2 only a series of 16 digits
        return d[0] != "2" or len(digits) == 16 and "2221" <= d[:4] <= "2720"
    if not (13 <= len(digits) <= 19 and luhn(digits) and issued(digits)):
        return None
    body, n = digits[1:-1], len(digits) - 2
    got = Domain([10] * n, key, f"card{n}{digits[0]}").permuted(
        int(body), lambda v: issued(digits[0] + str(v).zfill(n)), back)
    new = digits[0] + str(got).zfill(n)
    return _refill(text, new + next(c for c in "0123456789" if luhn(new + c)))


_SEED = re.compile(r"[0-9@]")
_LEAD = re.compile(r"[A-Za-z0-9._%+(-]*", re.ASCII)
_REST = re.compile(r"[0-9@]+")


def _value(text: str, seed: int, low: int, key: bytes, back: bool) -> tuple[int, int, str, str] | None:
    """The first valid value that starts at or before ``seed``: (start, end, kind, pseudonym)."""
    first = seed
    while first > low and seed - first < 66 and _LEAD.fullmatch(text, first - 1, first):
        first -= 1
    for start in range(first, seed + 1):
        m = _CANDIDATE.match(text, start)
        while m:
            if (new := pseudonym(m.lastgroup, m.group(), key, back)) is not None:
                return start, m.end(), m.lastgroup, new
            # a grouped number may have run into the next one: leave out its last group
            cut = max(m.group().rfind(" "), m.group().rfind("-"))
            m = _CANDIDATE.match(text, start, start + cut) if cut > 0 else None
    return None


def pseudonymised(text: str, key: bytes = KEY, back: bool = False) -> tuple[str, list[tuple[int, int, str]]]:
    """(the text with pseudonyms, (start, end, kind) of each value).

    Every value holds a digit or an @, so only the surroundings of those are matched."""
    out, found, at, pos = [], [], 0, 0
    while seed := _SEED.search(text, pos):
        hit = _value(text, seed.start(), at, key, back)
        if hit is None:
            pos = _REST.match(text, seed.start()).end()
            continue
        start, end, kind, new = hit
        out += [text[at:start], new]
        found.append((start, end, "phone" if kind == "abroad" else kind))
        at = pos = end
    return ("".join(out) + text[at:], found) if found else (text, found)


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))


def pseudonymise(docs: DataFrame, key: bytes = KEY, id_col: str = "doc_id", text_col: str = "text",
                 back: bool = False) -> DataFrame:
    """``<id_col>, text, spans, n_found`` per row: the new text and where its values stood."""
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    schema = T.StructType([
        T.StructField(id_col, rows.schema["id"].dataType), T.StructField("text", T.StringType()),
        T.StructField("spans", T.ArrayType(T.StructType([
            T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
            T.StructField("kind", T.StringType())]))),
        T.StructField("n_found", T.IntegerType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = [], []
            for text in batch.column("text").to_pylist():
                found: list = []
                if text:
                    text, found = pseudonymised(text, key, back)
                texts.append(text)
                spans.append([{"start": a, "end": b, "kind": k} for a, b, k in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(texts, pa.string()), pa.array(spans, _SPANS),
                 pa.array([len(s) for s in spans], pa.int32())], names=names)

    return rows.mapInArrow(run, schema)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(documents(spark, sf_dir))
