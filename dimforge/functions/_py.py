"""Per-value Python helpers behind the two Arrow (pandas) UDFs.

Kept in their own small module, which is shipped to the Python workers by
value, so executors need no installed copy of this package.
"""

from __future__ import annotations

import unicodedata

import pandas as pd

# Transliterations for Latin letters that have no Unicode
# decomposition (NFKD leaves them intact), plus common typographic marks.
LATIN_EXTRA = {
    "ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE",
    "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D",
    "ð": "d", "Ð": "D", "þ": "th", "Þ": "Th", "ı": "i", "ħ": "h", "Ħ": "H",
    " ": " ", "‘": "'", "’": "'", "“": '"', "”": '"',
    "–": "-", "—": "--", "…": "...",
}
# Romanised Greek and Cyrillic letters (capitals follow by rule).
GREEK = {
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l", "μ": "m",
    "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "ς": "s", "σ": "s", "τ": "t", "υ": "u", "φ": "ph", "χ": "kh", "ψ": "ps",
    "ω": "o",
}
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "io", "ж": "zh", "з": "z", "и": "i", "й": "i", "к": "k",
    "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts",
    "ч": "ch", "ш": "sh", "щ": "shch", "ъ": '"', "ы": "y", "ь": "'", "э": "e", "ю": "iu", "я": "ia",
    "є": "ie", "і": "i", "ї": "yi", "ґ": "g",
}


def _with_capitals(table: dict[str, str]) -> dict[str, str]:
    return {**table, **{k.upper(): v.capitalize() for k, v in table.items() if len(k.upper()) == 1 and k != "ς"}}


_TABLE = str.maketrans({**_with_capitals(GREEK), **_with_capitals(CYRILLIC), **LATIN_EXTRA})


def nfkd_ascii(s: pd.Series) -> pd.Series:
    """Compatibility decomposition, drop what is not ASCII, strip blanks."""
    return s.map(lambda v: unicodedata.normalize("NFKD", v)
                 .encode("ascii", "ignore").decode("ascii").strip(),
                 na_action="ignore")


def transliterate(s: pd.Series) -> pd.Series:
    """Fixed tables, then decomposition, the tables again for base letters
    that lost an accent, and what is not ASCII dropped."""
    return s.map(lambda v: unicodedata.normalize("NFKD", v.translate(_TABLE)).translate(_TABLE)
                 .encode("ascii", "ignore").decode("ascii"),
                 na_action="ignore")


def _ship_by_value() -> None:
    import sys
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # pragma: no cover
        pass


_ship_by_value()
