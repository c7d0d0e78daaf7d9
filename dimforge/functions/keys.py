"""Parsing of prefixed entity keys and ticker strings.

Staged keys look like ``"c:123"``: an entity-type prefix, a colon and a
numeric id.  Every function here is a native Catalyst expression, so it
stays inside whole-stage codegen and can be pushed below joins.

Rules (fixed semantics, kept equal to the warehouse contract):

* prefix    – text before the first ``:``; NULL when there is no ``:``.
* id        – the text between the first and second ``:`` read as a
              32-bit integer (surrounding Unicode blanks and a sign allowed);
              NULL when there is no ``:`` or the part is not an integer.
* ticker    – market = text before the first ``:``, symbol = text between
              the first and second ``:``; both NULL without a ``:``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dimforge.functions._util import as_col

# Fixed value: what a valid numeric id part looks like.
INT_PART_PATTERN = r"^[\s\x1c-\x1f\x85\p{Z}]*([+-]?[0-9]+)[\s\x1c-\x1f\x85\p{Z}]*\z"


def _has_colon(c: Column) -> Column:
    return c.contains(":")


def _part(c: Column, n: int) -> Column:
    return F.split_part(c, F.lit(":"), F.lit(n))


def entity_prefix(c) -> Column:
    """``'c:12'`` -> ``'c'``; ``':7'`` -> ``''``; ``'7'`` -> NULL."""
    c = as_col(c)
    return F.when(_has_colon(c), F.substring_index(c, ":", 1))


def entity_id(c) -> Column:
    """``'c:12'`` -> 12; ``'c:1:2'`` -> 1; ``'c: 3 '`` -> 3; ``'c:4.0'`` -> NULL."""
    c = as_col(c)
    part = F.substring_index(F.substring_index(c, ":", 2), ":", -1)
    plain = part.try_cast("int")
    other = F.when(part.rlike(INT_PART_PATTERN), F.regexp_extract(part, INT_PART_PATTERN, 1).try_cast("int"))
    # an id as Spark itself would write it needs no regular expression
    return F.when(_has_colon(c), F.when(plain.cast("string") == part, plain).otherwise(other))


def stock_market(c) -> Column:
    """``'NYSE:JNPR'`` -> ``'NYSE'``; a bare ticker -> NULL."""
    return entity_prefix(c)


def stock_symbol(c) -> Column:
    """``'NYSE:JNPR'`` -> ``'JNPR'``; ``'OTC:A:B'`` -> ``'A'``; a bare ticker -> NULL."""
    c = as_col(c)
    return F.when(_has_colon(c), _part(c, 2))


def clean_integer(c, data_type: str | None = None) -> Column:
    """Integer ids pass through; strings of the form ``'<letter>:<digits>'``
    give the digits as int, any other string gives NULL.

    ``data_type`` is the Spark simple type name of ``c`` when it is known
    (``'string'`` selects the parsing branch); integer input is the usual
    case and is returned unchanged.
    """
    c = as_col(c)
    if data_type == "string":
        digits = F.regexp_extract(c, r"^[a-zA-Z]:([0-9]+)", 1)
        return F.when(digits != "", digits.try_cast("int"))
    return c


def entity_key(prefix_col, id_col) -> Column:
    """Typed entity key ``'<prefix>:<id>'`` for reporting (NULL when the id is NULL)."""
    return F.when(as_col(id_col).isNotNull(),
                  F.concat(F.coalesce(as_col(prefix_col), F.lit("")), F.lit(":"),
                           as_col(id_col).cast("string")))
