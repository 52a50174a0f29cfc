"""Free text to canonical values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Text that means "missing" in mapped columns, and in city/state/term columns.
MAPPED_NULLS = ("", "nan", "none", "n/a", "na", "-")
PLAIN_NULLS = ("", "nan", "none")

NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def strip(text: Column) -> Column:
    # trimming a set of characters is slow, so text that begins and ends visibly is left alone
    def visible(position: int) -> Column:
        return F.substring(text, position, 1).between("!", "~")

    return F.when(visible(1) & visible(-1), text).otherwise(F.trim(text, F.lit(WHITESPACE)))


def strip_lower(text: Column) -> Column:
    return F.lower(strip(text))


def null_tokens(text: Column, tokens: Sequence[str] = PLAIN_NULLS) -> Column:
    """NULL where `text` is one of `tokens`."""
    return F.when(~text.isin(*tokens), text)


def literal_map(mapping: Mapping) -> Column:
    """A constant map column; entries whose value is None are left out, as a miss is NULL too."""
    entries = [F.lit(x) for k, v in mapping.items() if v is not None for x in (k, v)]
    return F.create_map(*entries)


def normalize(text: Column, mapping: Mapping, tokens: Sequence[str] = MAPPED_NULLS) -> Column:
    """Look up the stripped lower-case text; missing and unmapped text gives NULL."""
    lookup = literal_map(mapping)
    if any(t in mapping for t in tokens):
        return F.element_at(lookup, null_tokens(strip_lower(text), tokens))
    # nearly all text is found with its spaces trimmed; the full strip runs for the rest
    return F.coalesce(
        F.element_at(lookup, F.lower(F.trim(text))), F.element_at(lookup, strip_lower(text))
    )


def replace_exact(text: Column, typos: Mapping[str, str], tokens: Sequence[str] = PLAIN_NULLS) -> Column:
    """Stripped lower-case text with whole-value typos fixed; other values pass through."""
    key = null_tokens(strip_lower(text), tokens)
    return F.coalesce(F.element_at(literal_map(typos), key), key)


def keep_matching(text: Column, pattern: str) -> Column:
    """The stripped text where it matches `pattern`, else NULL."""
    trimmed = strip(text)
    return F.when(trimmed.rlike(pattern), trimmed)


def strip_suffix_and_pad(text: Column, suffix_pattern: str, width: int, fill: str = "0") -> Column:
    bare = F.regexp_replace(text, suffix_pattern, "")
    return F.lpad(bare, F.greatest(F.length(bare), F.lit(width)), F.lit(fill))


def to_number(text: Column) -> Column:
    """Number text as double, anything else NULL.

    A plain cast also takes `12d` or `1.5f`, so the text is tested first.
    """
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))
