"""Text columns: stripping, null tokens, name conformance and match keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a text strip removes (all Unicode white space).
ASCII_WHITESPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
WHITESPACE = ASCII_WHITESPACE + (
    "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Cells a CSV scan turns into null, compared before any stripping.
SCAN_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Stripped cells that Silver cleaning turns into null, exact case.
CLEAN_NULL_TOKENS = ("NA", "NULL", "None", "", "nan")

# Spellings conformed in Silver, exact case after stripping.
SILVER_NAMES = {
    "D.I. Yogyakarta": "DI Yogyakarta",
    "D.I Yogyakarta": "DI Yogyakarta",
    "Daerah Istimewa Yogyakarta": "DI Yogyakarta",
    "D.K.I. Jakarta": "DKI Jakarta",
    "D.K.I Jakarta": "DKI Jakarta",
    "Daerah Khusus Ibukota Jakarta": "DKI Jakarta",
    "Bangka Belitung": "Kepulauan Bangka Belitung",
}

# Upper-case labels conformed while landing statistics.
LANDING_NAMES = {
    "DKI JAKARTA": "DKI Jakarta",
    "D.K.I. JAKARTA": "DKI Jakarta",
    "DI YOGYAKARTA": "DI Yogyakarta",
    "D.I. YOGYAKARTA": "DI Yogyakarta",
    "KEP. BANGKA BELITUNG": "Kepulauan Bangka Belitung",
    "KEPULAUAN BANGKA BELITUNG": "Kepulauan Bangka Belitung",
    "KEP. RIAU": "Kepulauan Riau",
    "NANGGROE ACEH DARUSSALAM": "Aceh",
}


def strip(text: Column) -> Column:
    """Remove white space of every kind from both ends (plain ``trim`` removes blanks only).

    Text of one byte per character, the usual case, is searched for the short list only.
    """
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.trim(text, F.lit(ASCII_WHITESPACE))).otherwise(F.trim(text, F.lit(WHITESPACE)))


def null_tokens(text: Column, tokens: tuple[str, ...]) -> Column:
    """Null where the cell is one of ``tokens``."""
    return F.when(~text.isin(*tokens), text)


def null_placeholders(text: Column) -> Column:
    """Null the placeholder words in stripped text."""
    return null_tokens(text, CLEAN_NULL_TOKENS)


def clean_text(text: Column) -> Column:
    """Strip, then null the placeholder words."""
    return null_placeholders(strip(text))


def _lookup(key: Column, names: dict[str, str]) -> Column:
    pairs = [F.lit(part) for pair in names.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def conform_exact(name: Column, names: dict[str, str] = SILVER_NAMES) -> Column:
    """Strip and replace the listed spellings; other names pass through stripped."""
    name = strip(name)
    return F.coalesce(_lookup(name, names), name)


def title_case(text: Column) -> Column:
    """Capitalise every run of letters, so ``D.I. ACEH`` gives ``D.I. Aceh``.

    ``initcap`` only starts a word after a blank and would give ``D.i. Aceh``.
    """
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    cased = F.transform(
        runs, lambda run: F.concat(F.upper(F.substring(run, 1, 1)), F.lower(F.substr(run, F.lit(2))))
    )
    return F.array_join(cased, "")


def conform_title(name: Column, names: dict[str, str] = LANDING_NAMES) -> Column:
    """Strip, replace labels listed in upper case, title-case the others."""
    name = strip(name)
    return F.coalesce(_lookup(F.upper(name), names), title_case(name))


def match_key(name: Column) -> Column:
    """The form in which names are compared across sources; null stays null."""
    return F.lower(strip(name))


def captured(text: Column, regex: str, group: int = 1) -> Column:
    """The first match's group, null where nothing matches.

    A plain ``regexp_extract`` gives an empty text then, and casting that costs an exception per
    row inside the cast.
    """
    return F.get(F.regexp_extract_all(text, F.lit(regex), F.lit(group)), F.lit(0))


def text_after(text: Column, prefix: str) -> Column:
    """The part after the first ``prefix``, or the empty string where it does not occur."""
    at = F.locate(prefix, text)
    return F.when(at > 0, F.substr(text, at + F.lit(len(prefix)))).when(text.isNotNull(), F.lit(""))
