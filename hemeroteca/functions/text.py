"""Text repair: mojibake, entities, glued words, white space."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable
from functools import reduce
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from hemeroteca.functions import fixed_values as fv

# The table that puts mis-decoded characters back, generated from the rule that made
# the damage: their UTF-8 bytes were read as Windows-1252.
_PUNCTUATION = "‘’“”–—…•€™«»"


def _misread(char: str) -> str:
    """The text that results when ``char``'s UTF-8 bytes are read as Windows-1252."""
    return "".join(
        bytes([b]).decode("cp1252") if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b)
        for b in char.encode("utf-8")
    )


REPAIR_TABLE: dict[str, str] = {
    _misread(c): c for c in [chr(n) for n in range(0xA0, 0x100)] + list(_PUNCTUATION)
}


def _any_char(chars) -> str:
    return "[" + "".join(f"\\x{{{ord(c):X}}}" for c in sorted(set(chars))) + "]"


def _shape(length: int) -> str:
    """One character class per position: a single look per character, however long the table."""
    keys = [k for k in REPAIR_TABLE if len(k) == length]
    return "".join(_any_char(k[i] for k in keys) for i in range(length))


_REPAIR_PATTERN = f"{_shape(3)}|{_shape(2)}"


def squeeze(col: Column) -> Column:
    """Collapse every white-space run to one blank and strip the ends."""
    # A lone blank, which is most of the white space there is, matches nothing.
    return F.trim(F.regexp_replace(col, f"{fv.WS}(?:{fv.WS}+|(?<! ))", " "))


def is_blank(col: Column) -> Column:
    """Missing, empty or white space only."""
    return F.coalesce(col.rlike(f"^{fv.WS}*$"), F.lit(True))


def _looks_damaged(col: Column) -> Column:
    # Plain byte searches: far cheaper than running the replacements on clean text.
    return reduce(lambda a, b: a | b, [F.contains(col, F.lit(lead)) for lead in fv.MOJIBAKE_LEADS])


def fix_mojibake(col: Column, table: str = "B") -> Column:
    """Apply one of the ordered replacement tables, or ``table='repair'``.

    ``'A'`` and ``'B'`` rewrite in table order, each entry over the previous
    result.  ``'repair'`` puts back what the damage rule says was there, reading
    left to right once, so no entry can shadow another.
    """
    if table == "repair":
        fixed = _repair_once(col)
    else:
        fixed = reduce(
            lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), fv.MOJIBAKE[table], col
        )
    return F.when(_looks_damaged(col), fixed).otherwise(col)


def _repair_once(col: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in REPAIR_TABLE.items() for x in pair])
    pieces = F.split(col, _REPAIR_PATTERN, -1)
    hits = F.regexp_extract_all(col, F.lit(_REPAIR_PATTERN), F.lit(0))
    return F.array_join(
        F.zip_with(
            pieces,
            hits,
            lambda piece, hit: F.concat(
                piece, F.coalesce(F.try_element_at(known, hit), hit, F.lit(""))
            ),
        ),
        "",
    )


#: So many texts at a time are Python objects in a worker.
_AT_ONCE = 64


def _changed(texts: pa.Array, change: Callable[[str], str]) -> pa.Array:
    """``change`` for each text. Only a few are Python objects at a time; the rest stay in their Arrow batch."""
    parts = [
        pa.array([None if t is None else change(t) for t in texts.slice(at, _AT_ONCE).to_pylist()], texts.type)
        for at in range(0, len(texts), _AT_ONCE)
    ]
    return pa.concat_arrays(parts) if parts else texts


@F.arrow_udf(StringType())
def _nfc(texts: pa.Array) -> pa.Array:
    return _changed(texts, lambda t: unicodedata.normalize("NFC", t))


@F.arrow_udf(StringType())
def _unescape_nfc(texts: pa.Array) -> pa.Array:
    return _changed(texts, lambda t: unicodedata.normalize("NFC", html.unescape(t)))


def _only_where(udf, col: Column, needed: Column) -> Column:
    """Ship a text to Python only where it can change; the rest travels as NULL."""
    return F.coalesce(udf(F.when(needed, col)), col)


def _has_entity(col: Column) -> Column:
    return F.contains(col, F.lit("&"))


def _may_denormalise(col: Column) -> Column:
    # All characters below U+0300 are already in composed form.
    return col.rlike(r"[\x{300}-\x{10FFFF}]")


#: A character reference as HTML has it; a name may lack its semicolon.
_REFERENCE = "&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\\t\\n\\f <&#;]{1,32};?)"


def _numbered_characters() -> dict[int, str]:
    """Numbers that stand for another character than their own: Windows text, and what is no character."""
    odd = {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}
    none = [*range(0x01, 0x09), 0x0B, *range(0x0E, 0x20), 0x7F, *range(0xFDD0, 0xFDF0)]
    none += [plane << 16 | last for plane in range(17) for last in (0xFFFE, 0xFFFF)]
    return {0: "\ufffd", **odd, **dict.fromkeys(none, "")}


def _literal_map(entries: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def decode_entities(col: Column) -> Column:
    """Decode named and numeric HTML entities, all in the JVM.

    The names are the standard library's HTML5 table. One without its semicolon counts as far as
    its longest beginning that is such a name.
    """
    names, numbers = _literal_map(html5), _literal_map(_numbered_characters())
    # Names that count without a semicolon are short.
    bare = {name: text for name, text in html5.items() if not name.endswith(";")}
    shorter, lengths = _literal_map(bare), range(max(map(len, bare)), 1, -1)

    def numeric(hit: Column, digits: str, base: int, most: int) -> Column:
        own = F.regexp_extract(hit, f"^&#[xX]?0*({digits}*);?$", 1)
        code = F.conv(F.when(own == "", "0").otherwise(own), base, 10).cast("long")
        text = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        known = F.coalesce(F.try_element_at(numbers, code.cast("int")), text)
        return F.when((F.length(own) > most) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF), "\ufffd").otherwise(known)

    def named(hit: Column) -> Column:
        own = F.substr(hit, F.lit(2))
        tries = [
            F.when(
                F.length(own) > n,
                F.concat(F.try_element_at(shorter, F.left(own, F.lit(n))), F.substr(own, F.lit(n + 1))),
            )
            for n in lengths
        ]
        return F.coalesce(F.try_element_at(names, own), *tries, hit)

    def decoded(hit: Column) -> Column:
        hexed = numeric(hit, "[0-9a-fA-F]", 16, 6)
        return F.when(hit.rlike("^&#[xX]"), hexed).when(F.startswith(hit, F.lit("&#")), numeric(hit, "[0-9]", 10, 7)).otherwise(named(hit))

    def joined(piece: Column, hit: Column) -> Column:
        return F.concat(piece, F.when(hit.isNull(), "").otherwise(decoded(hit)))

    parts = F.zip_with(F.split(col, _REFERENCE, -1), F.regexp_extract_all(col, F.lit(_REFERENCE), F.lit(0)), joined)
    return F.when(_has_entity(col), F.array_join(parts, "")).otherwise(col)


def compose(col: Column) -> Column:
    """Unicode NFC."""
    return _only_where(_nfc, col, _may_denormalise(col))


def decode_and_compose(col: Column) -> Column:
    """Entity decoding, then NFC, in one trip to Python."""
    return _only_where(_unescape_nfc, col, _has_entity(col) | _may_denormalise(col))


def _from_run_start(pattern: str) -> str:
    """Let a rule that opens with a run of letters or digits start at the run's first one only.

    It cannot match from further inside a run unless it matches from the start, and
    what it leaves of a run cannot match again, so results stay the same.  But a run
    that does not match is then given up after one try instead of one per character.
    """
    run = re.match(r"\((\[[^\]]+\]|\\p\{Nd\})(\{\d,\}|\+)\)", pattern)
    return f"(?<!{run.group(1)}){pattern}" if run else pattern


def unglue(col: Column, rules: str = "final") -> Column:
    """Separate glued words with one of the rule sets, then squeeze.

    The aggressive set lacks the two rules for a short word before a capital:
    its first rule has already split every such place, so they cannot match.
    """
    split = reduce(
        lambda c, rule: F.regexp_replace(c, _from_run_start(rule[0]), rule[1]), fv.GLUE_RULES[rules], col
    )
    return squeeze(split)


#: What each cleaning profile is made of: mojibake table, NFC and squeezing, glue rules.
PROFILES = {
    "final": ("B", True, "final"),
    "conservative": ("A", False, "conservative"),
    "repair": ("repair", True, "final"),
}


def decode_step(col: Column, profile: str = "final") -> Column:
    """The entity half of a profile's encoding repair."""
    normalise = PROFILES[profile][1]
    return squeeze(decode_and_compose(col)) if normalise else decode_entities(col)


def fix_encoding(col: Column, profile: str = "final") -> Column:
    """The encoding half of a cleaning profile."""
    return decode_step(fix_mojibake(col, PROFILES[profile][0]), profile)


def clean(col: Column, profile: str = "final") -> Column:
    """A whole cleaning profile for one column; ``clean_articles`` does the same for
    records, in stages that each run once."""
    return unglue(fix_encoding(col, profile), PROFILES[profile][2])


def glued_suspects(col: Column) -> Column:
    """Words that look glued: very long ones first, then lower-UPPER-lower ones."""
    return F.concat(
        F.regexp_extract_all(F.lower(col), F.lit(fv.LONG_WORD), F.lit(0)),
        F.regexp_extract_all(col, F.lit(fv.CAMEL_WORD), F.lit(0)),
    )


def preview(col: Column, size: int, default: str = "") -> Column:
    """The first ``size`` characters, with a default for a missing value."""
    return F.coalesce(F.substring(col, 1, size), F.lit(default))


def any_of(words: tuple[str, ...]) -> str:
    """A case-insensitive pattern for "contains any of these words"."""
    return "(?i)" + "|".join(words)


def metadata_like(col: Column) -> Column:
    """Short, with a digit and at most one comma: a date line rather than prose."""
    return (
        (F.regexp_count(col, F.lit(",")) <= 1) & (F.length(col) < 50) & col.rlike(fv.DIGIT)
    )
