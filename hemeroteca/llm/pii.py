"""Personal data: format-preserving pseudonyms from a keyed Feistel network.

Found values are validated (check digits, number plans, the calendar), then permuted by a keyed bijection over
all values of their format, so a pseudonym is valid in the same format, and equal values keep equal pseudonyms
wherever they stand and however they are punctuated. Letters of addresses and credentials are permuted the same
way within their alphabet.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemeroteca.llm.batches import with_columns

ROUNDS = 8
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
FOUND = "array<struct<kind:string,start:int,length:int,pseudonym:string>>"


def feistel(number: int, size: int, key: bytes, label: str) -> int:
    """A keyed bijection of 0..size-1. Values that leave the range go round again until they are back in it."""
    side = isqrt(size - 1) + 1

    def mixed(step: int, half: int) -> int:
        data = f"{label}/{size}/{step}/{half}".encode()
        return int.from_bytes(hashlib.blake2b(data, key=key, digest_size=16).digest()) % side

    while True:
        left, right = divmod(number, side)
        for step in range(ROUNDS):
            left, right = right, (left + mixed(step, right)) % side
        number = left * side + right
        if number < size:
            return number


def permuted(text: str, alphabet: str, key: bytes, label: str) -> str:
    """Another text of that length over the alphabet."""
    base, number = len(alphabet), 0
    for c in text:
        number = number * base + alphabet.index(c)
    number = feistel(number, base ** len(text), key, f"{label}/{len(text)}")
    out = []
    for _ in text:
        number, at = divmod(number, base)
        out.append(alphabet[at])
    return "".join(reversed(out))


def refill(shape: str, digits: str) -> str:
    """The digits in the places that digits have in ``shape``."""
    own = iter(digits)
    return "".join(next(own) if c in DIGITS else c for c in shape)


def luhn_digit(body: str) -> str:
    total = 0
    for i, c in enumerate(reversed(body)):
        n = int(c) * (2 - i % 2)
        total += n - 9 * (n > 9)
    return str(-total % 10)


def iban_checks(country: str, body: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in body + country + '00')) % 97:02d}"


def walk(digits: str, valid, key: bytes, label: str) -> str:
    """Permute digits among the valid ones of that length."""
    while True:
        digits = permuted(digits, DIGITS, key, label)
        if valid(digits):
            return digits


# What a pattern found becomes its pseudonym, or None if it isn't valid.


def card(text: str, key: bytes) -> str | None:
    digits = re.sub("[^0-9]", "", text)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    body = permuted(digits[:-1], DIGITS, key, "card")
    return refill(text, body + luhn_digit(body))


def phone(text: str, key: bytes) -> str | None:
    """A number of the North American plan, where area and office codes start with 2 to 9.

    One that is written out with its ``+1`` is a phone number even outside the plan; such ones stay outside it.
    """
    digits = re.sub("[^0-9]", "", text)
    own = digits[-10:]

    def planned(d: str) -> bool:
        return d[0] not in "01" and d[3] not in "01"

    if not planned(own) and not text.startswith("+"):
        return None
    return refill(text, digits[:-10] + walk(own, lambda d: planned(d) == planned(own), key, "phone"))


def world_phone(text: str, key: bytes) -> str | None:
    """A number with another country code: all digits but the first two are permuted."""
    digits = re.sub("[^0-9]", "", text)
    return refill(text, digits[:2] + permuted(digits[2:], DIGITS, key, "phone")) if 8 <= len(digits) <= 15 else None


def social(text: str, key: bytes) -> str | None:
    digits = text.replace("-", "")

    def valid(d: str) -> bool:
        return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"

    return refill(text, walk(digits, valid, key, "social")) if valid(digits) else None


def iban(text: str, key: bytes) -> str | None:
    plain = text.replace(" ", "")
    country, body = plain[:2], plain[4:]
    if not 15 <= len(plain) <= 34 or iban_checks(country, body) != plain[2:4]:
        return None
    digits = permuted(re.sub("[^0-9]", "", body), DIGITS, key, "iban")
    body = refill(body, digits)
    new = iter(country + iban_checks(country, body) + body)
    return "".join(c if c == " " else next(new) for c in text)


def ip_address(text: str, key: bytes) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or (p[0] == "0" and p != "0") for p in parts):
        return None
    number = feistel(int.from_bytes(bytes(map(int, parts))), 1 << 32, key, "ip")
    return ".".join(map(str, number.to_bytes(4)))


def _date(text: str, key: bytes, order: str) -> str | None:
    parts = re.split(r"[-/.]", text)
    try:
        day = datetime.date(*(int(parts[order.index(c)]) for c in "ymd")).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= day <= LAST_DAY:
        return None
    new = datetime.date.fromordinal(FIRST_DAY + feistel(day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, key, "date"))
    width = min(len(parts[order.index(c)]) for c in "md")
    values = {"y": f"{new.year:04d}", "m": f"{new.month:0{width}d}", "d": f"{new.day:0{width}d}"}
    marks = re.findall(r"[-/.]", text)
    return f"{values[order[0]]}{marks[0]}{values[order[1]]}{marks[1]}{values[order[2]]}"


def date(text: str, key: bytes) -> str | None:
    """Year first, or day before month, or month before day if only that is in the calendar.

    Days and months without leading zeros stay so.
    """
    if re.match("[0-9]{4}", text):
        return _date(text, key, "ymd")
    return _date(text, key, "dmy") or _date(text, key, "mdy")


@lru_cache(400)
def _letters(block: int, paired: bool = True) -> str:
    """The letters of a block of 128 code points: small ones that have one capital each, or all that have no such pair."""
    own = [chr(n) for n in range(128 * block, 128 * block + 128) if chr(n).isalpha()]
    small = [c for c in own if _small(c.upper()) == c != c.upper()]
    return "".join(small if paired else [c for c in own if c not in small and _small(c) == c])


def _small(c: str) -> str:
    """The small letter of a capital that it alone belongs to; else the character itself."""
    low = c.lower()
    return low if len(c) == len(low) == 1 and low.upper() == c else c


def email(text: str, key: bytes) -> str | None:
    """The part before the ``@``, punctuation in place. Digits, and the letters of each block of Unicode, are permuted
    among their like. Capitals count as small letters and are put back where they stood, so spellings of one address
    stay linked."""
    local, _, domain = text.rpartition("@")
    small, places = [_small(c) for c in local], {}
    for i, c in enumerate(small):
        if c in DIGITS:
            places.setdefault((DIGITS, "digits"), []).append(i)
        elif c.isalpha():
            block, paired = ord(c) // 128, c in _letters(ord(c) // 128)
            name = "lower" if block == 0 else f"block {block}" if paired else f"block {block}, no pairs"
            places.setdefault((_letters(block, paired), name), []).append(i)
    for (alphabet, name), own in places.items():
        for i, c in zip(own, permuted("".join(small[i] for i in own), alphabet, key, f"mail {name}"), strict=True):
            small[i] = c.upper() if local[i] != small[i] else c
    return f"{''.join(small)}@{domain}"


def credential(text: str, key: bytes) -> str | None:
    """A cloud key or a long hexadecimal token."""
    if text.startswith("AKIA"):
        return "AKIA" + permuted(text[4:], UPPER + DIGITS, key, "cloud key")
    return permuted(text, DIGITS + "abcdef", key, "token")


# Formats, the first one that fits and is valid decides.
FORMATS = (
    ("email", r"(?<![\w.%+-])[\w.%+-]++@[^\W_](?:[^\W_]|-(?=[^\W_]|-))*+(?:\.[^\W_](?:[^\W_]|-(?=[^\W_]|-))*+)*\.[^\W\d_]{2,}", email),
    ("credential", r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}|[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})(?![A-Za-z0-9])", credential),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", iban),
    ("ip", r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])", ip_address),
    ("date", r"(?<![0-9])(?:[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4})(?![0-9])", date),
    ("social", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", social),
    ("phone", r"(?<![0-9+])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])", phone),
    ("phone", r"(?<![0-9+])\+1[0-9]{10}(?![0-9])", phone),
    ("card", r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,}(?![0-9])", card),
    ("phone", r"(?<![0-9+])\+[2-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{1,5}\)?){2,5}(?![0-9])", world_phone),
)
_COMPILED = [(kind, re.compile(pattern), make) for kind, pattern, make in FORMATS]
_LIKELY = re.compile("[0-9@]")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])")
#: How cards are grouped, and how a number inside a longer run may be.
_CARD_GROUPS = re.compile("[0-9]{13,19}|([0-9]{4}[ -]){3}[0-9]{1,4}|([0-9]{4}[ -]){4}[0-9]{1,3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}")
_LONG_GROUPS = re.compile("([0-9]{4,}[ -])*[0-9]+")
#: Characters of an IBAN by country.
IBAN_LENGTHS = dict(re.findall("([A-Z]{2})([0-9]{2})", (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 "
    "ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 "
    "LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 "
    "PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30"
)))


@lru_cache(20_000)
def _pseudonym(form: int, text: str, key: bytes) -> str | None:
    return _COMPILED[form][2](text, key)


def _ends(hit: re.Match) -> list[tuple[int, int]]:
    """The spans that fit the pattern from the hit's start on and end with a group, the longest first."""
    text, start = hit.string, hit.start()
    ends = [e for e in range(hit.end() - 1, start, -1) if text[e] in " .-("]
    return [hit.span(), *((start, e) for e in ends if hit.re.fullmatch(text, start, e))]


def _iban_spans(hit: re.Match) -> list[tuple[int, int]]:
    """Those of the country's length first."""
    length = int(IBAN_LENGTHS.get(hit[0][:2], 0))
    return sorted(_ends(hit), key=lambda s: len(hit.string[slice(*s)].replace(" ", "")) != length)


def _card_spans(hit: re.Match) -> list[tuple[int, int]]:
    """Spans of 13 to 19 digits in a run: grouped like a card, then the longest from the left, then in long groups."""
    text, groups = hit.string, [m.span() for m in re.compile("[0-9]+").finditer(hit.string, *hit.span())]
    inner = []
    for i, (start, _) in enumerate(groups):
        digits, here = 0, []
        for own_start, end in groups[i : i + 20]:
            digits += end - own_start
            if digits > 19:
                break
            if digits >= 13:
                here.append((start, end))
        inner += reversed(here)
    grouped = [s for s in inner if _CARD_GROUPS.fullmatch(text, *s)]
    long = [s for s in inner if _LONG_GROUPS.fullmatch(text, *s)]
    return [*grouped, *(m.span() for m in _CARD.finditer(text, *hit.span())), *long]


def find(text: str, key: bytes) -> list[tuple[str, int, int, str]]:
    """(kind, start, length, pseudonym) of every value, from left to right; none overlap.

    Where a hit isn't valid as a whole, the spans inside that end, or start, with a group are tried.
    """
    if not _LIKELY.search(text):
        return []
    found: list[tuple[str, int, int, str]] = []
    covered = bytearray(len(text))

    def taken(form: int, start: int, end: int) -> bool:
        if covered.find(1, start, end) >= 0:
            return False
        if (new := _pseudonym(form, text[start:end], key)) is not None:
            found.append((_COMPILED[form][0], start, end - start, new))
            covered[start:end] = b"\1" * (end - start)
        return new is not None

    for form, (kind, pattern, _) in enumerate(_COMPILED):
        at = 0
        while hit := pattern.search(text, at):
            at = hit.end()
            if kind == "card":
                for span in _card_spans(hit):
                    taken(form, *span)
            elif (end := next((e for s, e in _SPANS.get(kind, _whole)(hit) if taken(form, s, e)), None)) is not None:
                at = end
            elif kind != "email":
                at = hit.start() + 1
    return sorted(found, key=lambda f: f[1])


def _whole(hit: re.Match) -> list[tuple[int, int]]:
    return [hit.span()]


def _address(hit: re.Match) -> list[tuple[int, int]]:
    """An address starts with a letter or digit."""
    start = hit.end() - len(hit[0].lstrip("._%+-"))
    return [(start, hit.end())] if hit.string[start] != "@" else []


_SPANS = {"email": _address, "iban": _iban_spans, "phone": _ends}


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text", found: str = "pii") -> DataFrame:
    """Replace the values in ``text`` and add ``found``: kind, start and length in the old text, and pseudonym.

    A null text stays null and has none. Other columns and repeated rows pass unchanged; a column named like
    ``found`` is replaced. An empty table stays one. ``key`` is 1 to 64 bytes.
    """

    def work(texts: pa.Array) -> dict[str, pa.Array]:
        new_texts, lists = [], []
        for old in texts.to_pylist():
            hits = find(old, key) if old else []
            if hits:
                parts, at = [], 0
                for _, start, length, new in hits:
                    parts += [old[at:start], new]
                    at = start + length
                old = "".join([*parts, old[at:]])
            new_texts.append(old)
            lists.append([dict(zip(("kind", "start", "length", "pseudonym"), h, strict=True)) for h in hits])
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("length", pa.int32()), ("pseudonym", pa.string())]))
        return {text: pa.array(new_texts, pa.string()), found: pa.array(lists, kind)}

    order = [c for c in docs.columns if c.lower() != found.lower()]
    made = with_columns(docs, text, {text: "string", found: FOUND}, work, caches=(_pseudonym, _letters))
    return made.select(*[F.col(f"`{c}`") for c in order], found)
