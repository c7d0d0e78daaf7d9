"""Column -> Column functions (all native except NFKD/transliteration)."""

from dimforge.functions.casts import parse_date, parse_timestamp, to_decimal, to_int, to_string
from dimforge.functions.keys import (clean_integer, entity_id, entity_key, entity_prefix,
                                     stock_market, stock_symbol)
from dimforge.functions.text import (clean_alpha_text, clean_text, fix_encoding, full_name,
                                     normalize_entity_type, normalize_text, repair_mojibake,
                                     url_or_default)

__all__ = [
    "clean_alpha_text", "clean_integer", "clean_text", "entity_id", "entity_key",
    "entity_prefix", "fix_encoding", "full_name", "normalize_entity_type", "normalize_text",
    "parse_date", "parse_timestamp", "repair_mojibake", "stock_market", "stock_symbol",
    "to_decimal", "to_int", "to_string", "url_or_default",
]
