"""Text cleaning expressions.

Everything that can be said with regular expressions is a native
expression.  The two rules that need Unicode normalisation (NFKD) or
transliteration, which Spark has no built-in for, run in an Arrow-batched
pandas UDF, and only for values that actually contain non-ASCII
characters: ASCII values take a native fast path and the UDF receives NULL
for them, so the Python side sees (almost) nothing for typical data.

Character classes follow Python's ``re`` semantics for ``str`` patterns,
because the warehouse contract was defined that way: ``\\w`` is any letter
or number (in the Unicode sense) or ``_``; ``\\s`` is any Unicode blank.
Java's ``\\w``/``\\s`` are ASCII-only, so the classes are spelled out.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from dimforge.functions import _py
from dimforge.functions._py import LATIN_EXTRA  # noqa: F401  (re-exported fixed table)
from dimforge.functions._util import as_col

# Python-compatible character classes (Java regex syntax).
WORD_CHARS = r"\p{L}\p{N}_"
SPACE_CHARS = r"\s\x1c-\x1f\x85\p{Z}"
# The blanks str.strip() removes from an ASCII-only string, and
# the ASCII part of both classes with every character named: Java tests such a
# class with one table look-up, a class of ranges and properties member by member.
ASCII_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
ASCII_SPACE_CHARS = "".join(f"\\x{ord(x):02x}" for x in ASCII_SPACE)
ASCII_WORD_CHARS = string.ascii_letters + string.digits + "_"
# Fixed value: a source URL is kept only when it starts like this.
URL_PATTERN = r"^(http|https)://.*"



def _strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"^[{SPACE_CHARS}]+|[{SPACE_CHARS}]+\z", "")


def _strip_ascii(c: Column) -> Column:
    """``_strip`` of an ASCII-only value, without a regular expression."""
    return F.btrim(c, F.lit(ASCII_SPACE))


def _is_ascii(c: Column) -> Column:
    """As many characters as bytes, counted without decoding the value (broken bytes are no characters)."""
    return (F.length(c) == F.octet_length(c)) & F.is_valid_utf8(c)


def repair_mojibake(c) -> Column:
    """Undo UTF-8 text that was decoded as Latin-1 (``'CafÃ©'`` -> ``'Café'``).

    Applies only when every character fits in one Latin-1 byte and those
    bytes form valid UTF-8; otherwise the value is returned unchanged.
    """
    c = as_col(c)
    fixed = F.try_validate_utf8(F.encode(c, "ISO-8859-1").cast("string"))
    return F.when(c.rlike(r"^[\x00-\xFF]*\z"), F.coalesce(fixed, c)).otherwise(c)


_nfkd_ascii = F.pandas_udf(_py.nfkd_ascii, StringType())
_transliterate = F.pandas_udf(_py.transliterate, StringType())


def clean_text(c) -> Column:
    """Repair mojibake, fold to ASCII (NFKD, non-ASCII dropped), strip.

    NULL and ``''`` pass through unchanged; other values may become ``''``.
    """
    c = as_col(c)
    ascii_ = _is_ascii(c)  # a repair neither changes an ASCII value nor makes one
    slow = _nfkd_ascii(F.when(~ascii_, repair_mojibake(c)))
    return (F.when(c.isNull() | (c == ""), c)
             .when(ascii_, _strip_ascii(c))
             .otherwise(slow))


def fix_encoding(c) -> Column:
    """Transliterate to ASCII: decomposable letters lose their accents, fixed
    tables cover Latin letters without a decomposition and the Greek and
    Cyrillic alphabets, other non-ASCII characters are dropped.  ASCII input
    is returned unchanged."""
    c = as_col(c)
    return F.when(_is_ascii(c), c).otherwise(_transliterate(F.when(~_is_ascii(c), c)))


def normalize_text(c) -> Column:
    """Lower-case; keep word chars, blanks and ``, & /``; turn ``, & /`` into
    blanks; collapse blank runs; strip.  NULL or all-blank input -> NULL."""
    c = as_col(c)

    def norm(word: str, space: str) -> Column:
        kept = F.regexp_replace(F.lower(c), f"[^{word}{space},&/]+", "")
        return F.trim(F.regexp_replace(kept, f"[{space},&/]+", " "))

    return (F.when(_is_ascii(c), F.when(F.ltrim(c, F.lit(ASCII_SPACE)) != "", norm(ASCII_WORD_CHARS, ASCII_SPACE_CHARS)))
             .when(~c.rlike(rf"^[{SPACE_CHARS}]*\z"), norm(WORD_CHARS, SPACE_CHARS)))


def clean_alpha_text(c) -> Column:
    """Keep only word chars and blanks, then strip.  NULL or ``''`` -> NULL."""
    c = as_col(c)
    return F.when(c.isNotNull() & (c != ""),
                  F.when(_is_ascii(c), _strip_ascii(F.regexp_replace(c, f"[^{ASCII_WORD_CHARS}{ASCII_SPACE_CHARS}]+", "")))
                   .otherwise(_strip(F.regexp_replace(c, f"[^{WORD_CHARS}{SPACE_CHARS}]+", ""))))


def full_name(first, last) -> Column:
    """First and last name joined by one blank, NULL parts skipped
    (both NULL -> ``''``)."""
    return F.concat_ws(" ", as_col(first), as_col(last))


def normalize_entity_type(c, allowed=("c", "p"), default: str = "c") -> Column:
    """Keep an allowed entity type, map anything else (NULL included) to ``default``."""
    c = as_col(c)
    return F.when(c.isin(*allowed), c).otherwise(F.lit(default))


def url_or_default(c, default: str = "Unknown") -> Column:
    """Keep values that look like an http(s) URL; anything else -> ``default``."""
    c = as_col(c)
    return F.when(c.rlike(URL_PATTERN), c).otherwise(F.lit(default))
