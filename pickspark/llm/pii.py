"""Format-preserving pseudonyms for personal data.

Validated values are found by pattern and check (Luhn sum, octets, calendar, IBAN remainder); each is
permuted within its own format by a keyed Feistel network: digits stay digits, letters letters, separators
stay, check digits are computed anew, dates stay dates. The permutation depends on the key and the kind
alone, so equal values stay equal across documents, different ones stay different, and no table of values
is kept or shuffled. Letters of an e-mail address change regardless of case. Whoever has the key can undo it
(``restore``, by the places found). Values written in several ways share a pseudonym: cards with different separators,
phone numbers with and without country code and leading zeros, dates with and without zeros, IPv6 addresses.

The pattern of a card, IBAN or phone number may take in a short token that follows. Shorter matches that end at a
separator are tried too: cards grouped as on cards first, IBANs of their country's length first, then the longest. Dates
with slashes are read month first where day first is no date.

Edge cases: a null text stays null, an empty one empty; numbers that fail validation stay as they are; whole
texts of any length are read; repeated rows and other columns pass through; an empty table gives no rows.
Where values overlap, the leftmost wins, then the order of ``KINDS``.
"""

from __future__ import annotations

import datetime
import functools
import hashlib
import ipaddress
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import chunks, lean

ROUNDS = 8
#: Dates are permuted within these years.
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What each kind of value looks like before it is validated.
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "date": r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\d/-])",
    "ip6": r"(?<![\w:.])(?=[0-9A-Fa-f]*:[0-9A-Fa-f]*:)[0-9A-Fa-f:]{6,39}(?![\w:])",
    "ip": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)",
    "phone": r"(?<![\d+])(?:(?:\+\d{1,3}[ .-]?|00\d{1,3}[ .-])(?:\(\d{1,4}\)[ .-]?)?\d{1,8}(?:[ ./-]\d{2,8}){0,5}|\+\d{8,15}|\(\d{3}\) ?\d{3}-\d{4}|\d{3}([.-])\d{3}\1\d{4}|0\d{1,4}(?: \d{2,4}){2,4}|0\d{1,4}(?:-\d{2,4}){2,4}|0\d{1,4}[ /-]\d{5,8})(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)",
}
#: IBAN lengths of countries, and how digits are grouped on cards.
IBAN_LENGTHS = {15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
LENGTH_OF = {country: n for n, countries in IBAN_LENGTHS.items() for country in countries.split()}
#: The country codes of one and of two digits; all others have three.
COUNTRY_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
CARD_FORM = re.compile(r"\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}(?:\1\d{1,3})?|\d{4}([ -])\d{6}\2\d{4,5}", re.ASCII)
CARD = re.compile(KINDS["card"], re.ASCII)
FIND = re.compile("|".join(f"(?P<{k}>{p})" for k, p in KINDS.items()).replace(r"([.-])\d{3}\1", r"(?P<_sep>[.-])\d{3}(?P=_sep)"), re.ASCII)
MAY = re.compile(r"\d|@|::", re.ASCII)


def permute(value: int, size: int, key: bytes, kind: str, back: bool = False) -> int:
    """A keyed permutation of range(size): a Feistel network over the next even number of bits, walked
    until it is back in the range."""
    if size < 2:
        return value
    half = ((size - 1).bit_length() + 1) // 2
    mask = (1 << half) - 1
    while True:
        left, right = value >> half, value & mask
        for r in range(ROUNDS - 1, -1, -1) if back else range(ROUNDS):
            if back:
                left, right = right ^ _round(left, r, size, key, kind) & mask, left
            else:
                left, right = right, left ^ _round(right, r, size, key, kind) & mask
        value = left << half | right
        if value < size:
            return value


def _round(half: int, r: int, size: int, key: bytes, kind: str) -> int:
    """As many bits as half of a value of ``range(size)`` has, and some more."""
    head = hashlib.blake2b(f"{kind}|{size:x}|{r}|{half:x}".encode(), key=key, digest_size=64).digest()
    blocks = (size.bit_length() // 2 + 1) // 512 + 1
    return int.from_bytes(head + b"".join(hashlib.blake2b(head + i.to_bytes(4, "little"), key=key, digest_size=64).digest() for i in range(1, blocks)), "little")


def spelled(text: str, key: bytes, kind: str, back: bool = False) -> str:
    """Every digit, lower and upper letter permuted together within its class; all else stays."""
    sets = [next((s for s in (DIGITS, LOWER, UPPER) if c in s), "") for c in text]
    size = value = 0
    size = functools.reduce(lambda n, s: n * (len(s) or 1), sets, 1)
    for c, s in zip(text, sets):
        value = value * (len(s) or 1) + (s.index(c) if s else 0)
    value = permute(value, size, key, kind + "".join(s[0] if s else "-" for s in sets), back)
    out = []
    for c, s in zip(reversed(text), reversed(sets)):
        value, at = divmod(value, len(s) or 1)
        out.append(s[at] if s else c)
    return "".join(reversed(out))


def luhn(digits: str) -> int:
    """The check digit that belongs after ``digits``."""
    total = sum(int(c) if i % 2 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
    return -total % 10


def _put(digits: str, form: str) -> str:
    """``digits`` in the places of the digits of ``form``."""
    it = iter(digits)
    return "".join(next(it) if c in DIGITS else c for c in form)


def card(text: str, key: bytes, back: bool) -> str | None:
    digits = re.sub(r"[ -]", "", text)
    if luhn(digits[:-1]) != int(digits[-1]) or len(set(digits)) == 1:
        return None
    body = spelled(digits[:-1], key, "card", back)
    return _put(body + str(luhn(body)), text)


def phone(text: str, key: bytes, back: bool) -> str | None:
    """The number in its country is permuted, the same however it is written: with a country code after + or 00, with
    zeros before it, or alone. Country code, zeros and separators stay, and it does not begin with a zero after."""
    digits = re.sub(r"\D", "", text)
    abroad = "" if text[0] != "+" and text[:2] != "00" else "+" if text[0] == "+" else "00"
    head = 2 if abroad == "00" else 0
    if abroad:
        head += next((len(c) for c in COUNTRY_CODES if digits.startswith(c, head)), 3)
    own = digits[head:].lstrip("0")
    total = len(digits) - (2 if abroad == "00" else 0)
    if digits[:head].endswith("1") and len(digits[:head].lstrip("0")) == 1:
        valid = len(digits) == head + 10
    elif not abroad and text[0] == "0":
        valid = 10 <= total <= 12 and len(own) == total - 1
    else:
        valid = 8 <= total <= 15 if abroad else len(digits) == 10
    if not valid or len(own) < 5:
        return None
    least = 10 ** (len(own) - 1)
    new = least + permute(int(own) - least, 9 * least, key, "phone", back)
    return _put(digits[: len(digits) - len(own)] + str(new), text)


def ssn(text: str, key: bytes, back: bool) -> str | None:
    area, group, serial = map(int, text.split("-"))
    valid = lambda a, g, s: 0 < a < 900 and a != 666 and g and s
    if not valid(area, group, serial):
        return None
    value = int(text.replace("-", ""))
    while True:
        value = permute(value, 10**9, key, "ssn", back)
        out = f"{value:09d}"
        if valid(int(out[:3]), int(out[3:5]), int(out[5:])):
            return f"{out[:3]}-{out[3:5]}-{out[5:]}"


def ip(text: str, key: bytes, back: bool) -> str | None:
    try:
        value = int(ipaddress.IPv4Address(text))
    except ValueError:
        return None
    return str(ipaddress.IPv4Address(permute(value, 1 << 32, key, "ip", back)))


def ip6(text: str, key: bytes, back: bool) -> str | None:
    """In canonical spelling. Addresses without a prefix, such as ::1, say nothing of a person and stay."""
    try:
        value = int(ipaddress.IPv6Address(text))
    except ValueError:
        return None
    if value >> 96 == 0:
        return None
    while (value := permute(value, 1 << 128, key, "ip6", back)) >> 96 == 0:
        pass
    return str(ipaddress.IPv6Address(value))


def short(day: datetime.date) -> bool:
    """Whether a day or month of one digit tells if a date is written with zeros before them."""
    return day.day < 10 or day.month < 10


def date(text: str, key: bytes, back: bool) -> str | None:
    """Dates with a short day or month stay such, so that one written without zeros is read that way again; others stay
    without, so that all spellings of a date go the same way."""
    first, middle, last = re.split(r"[./-]", text)
    if any(len(p) == 1 for p in (first, middle)) and any(p[0] == "0" for p in (first, middle)):
        return None
    bare = len(first) == 1 or len(middle) == 1
    mark = text[len(first)]
    for order in ("ymd",) if len(first) == 4 else ("dmy", "mdy") if mark == "/" else ("dmy",):
        part = dict(zip(order, map(int, (first, middle, last))))
        try:
            day = datetime.date(part["y"], part["m"], part["d"])
        except ValueError:
            continue
        at = day.toordinal()
        if not FIRST_DAY <= at <= LAST_DAY:
            return None
        while True:
            at = FIRST_DAY + permute(at - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, key, "date", back)
            moved = datetime.date.fromordinal(at)
            # What is read month first has a day over 12, and keeps one: else it would be read day first.
            if short(moved) == short(day) and (order != "mdy" or moved.day > 12):
                break
        wide = {"y": f"{moved.year}", "m": f"{moved.month}" if bare else f"{moved.month:02d}", "d": f"{moved.day}" if bare else f"{moved.day:02d}"}
        return mark.join(wide[c] for c in order)
    return None


def iban(text: str, key: bytes, back: bool) -> str | None:
    plain = text.replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(plain) <= 34 or number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body = spelled(plain[4:], key, "iban" + plain[:2], back)
    new = iter(f"{plain[:2]}{98 - number(body + plain[:2] + '00') % 97:02d}{body}")
    return "".join(c if c == " " else next(new) for c in text)


def email(text: str, key: bytes, back: bool) -> str | None:
    """Letters change regardless of case, which stays in its places, so one mailbox has one pseudonym."""
    local, _, domain = text.rpartition("@")
    new = spelled(local.lower(), key, "email@" + domain.lower(), back)
    return "".join(n.upper() if c.isupper() else n for c, n in zip(local, new)) + f"@{domain}"


MAKERS: dict[str, Callable[[str, bytes, bool], str | None]] = {"email": email, "iban": iban, "date": date, "ip6": ip6, "ip": ip, "phone": phone, "ssn": ssn, "card": card}


def readings(kind: str, text: str) -> list[str]:
    """``text`` and its beginnings that end at a separator, in the order in which they are tried."""
    if kind not in ("card", "iban", "phone"):
        return [text]
    parts = [text[:i] for i in range(len(text), 0, -1) if i == len(text) or text[i] in " -" or kind == "phone" and text[i] in "./"]
    if kind == "phone":
        return parts
    if kind == "card":
        return sorted((p for p in parts if sum(c in DIGITS for c in p) >= 13), key=lambda p: not CARD_FORM.fullmatch(p))
    return sorted(parts, key=lambda p: len(p.replace(" ", "")) != LENGTH_OF.get(p[:2]))


def read(m: re.Match, key: bytes, back: bool) -> tuple[str, str] | None:
    """The valid value that begins where ``m`` does, and its pseudonym."""
    kind = m.lastgroup
    for part in readings(kind, m[0]):
        if (new := MAKERS[kind](part, key, back)) is not None:
            # Digits not grouped as on cards give way to a card that begins among them.
            later = kind == "card" and not CARD_FORM.fullmatch(part) and any(_card_at(m.string, m.start() + i + 1, key, back) for i, c in enumerate(m[0]) if c in " -")
            return None if later else (part, new)
    return None


def _card_at(text: str, at: int, key: bytes, back: bool) -> bool:
    m = CARD.match(text, at)
    return bool(m) and any(CARD_FORM.fullmatch(p) and card(p, key, back) for p in readings("card", m[0]))


def undone(text: str, spans: list[tuple[str, int, int]], key: bytes, kinds: frozenset[str] = frozenset(KINDS)) -> tuple[str, list[tuple[str, int, int]]]:
    """Undo ``replace`` at the places that it gave: the new text, and the places in it."""
    out, places, done, size = [], [], 0, 0
    for kind, begin, end in spans:
        if kind in kinds:
            new = MAKERS[kind](text[begin:end], key, True) or text[begin:end]
            out += [text[done:begin], new]
            size += begin - done
            places.append((kind, size, size + len(new)))
            size += len(new)
            done = end
    return "".join([*out, text[done:]]), places


def replace(text: str, key: bytes, back: bool = False, kinds: frozenset[str] = frozenset(KINDS)) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and (kind, begin, end) of each in the new text, in code points."""
    if not MAY.search(text):
        return text, []
    out, spans, done, size = [], [], 0, 0
    at = 0
    while m := FIND.search(text, at):
        found = read(m, key, back) if m.lastgroup in kinds else None
        if found is None:
            # What fails validation as one kind may hold another: look again one character on.
            at = m.start() + 1
            continue
        old, new = found
        out += [text[done : m.start()], new]
        size += m.start() - done
        spans.append((m.lastgroup, size, size + len(new)))
        size += len(new)
        done = at = m.start() + len(old)
    return ("".join([*out, text[done:]]), spans) if spans else (text, [])


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def pseudonymise(df: DataFrame, key: bytes, text_col: str = "text", spans_col: str = "pii", back: bool = False, kinds: frozenset[str] = frozenset(KINDS)) -> DataFrame:
    """``df`` with pseudonyms in ``text_col`` and their places in ``spans_col``. ``back`` undoes the places that
    ``spans_col`` has; without them values are found anew, which may differ where digits follow a value."""
    base = [f for f in df.schema.fields if f.name != spans_col]
    names = [f.name for f in base]
    placed = back and any(f.name == spans_col and f.dataType.simpleString() == SPANS.simpleString() for f in df.schema.fields)
    span = pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text_col):
                places = part.column(spans_col).to_pylist() if placed else [None] * part.num_rows
                rows = [
                    (None, []) if t is None else replace(t, key, back, kinds) if at is None else undone(t, [(x["kind"], x["begin"], x["end"]) for x in at], key, kinds)
                    for t, at in zip(part.column(text_col).to_pylist(), places)
                ]
                columns = {n: part.column(n) for n in names} | {text_col: pa.array([r[0] for r in rows], pa.string())}
                found = pa.array([[{"kind": k, "begin": b, "end": e} for k, b, e in r[1]] for r in rows], pa.list_(span))
                yield pa.RecordBatch.from_arrays([*columns.values(), found], names=[*names, spans_col])

    return df.select(*names, *([spans_col] if placed else [])).mapInArrow(lean(run), T.StructType([*base, T.StructField(spans_col, SPANS)]))


def restore(df: DataFrame, key: bytes, text_col: str = "text", spans_col: str = "pii") -> DataFrame:
    """Undo ``pseudonymise``, at the places in ``spans_col``."""
    return pseudonymise(df, key, text_col, spans_col, back=True)
