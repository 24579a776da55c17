"""Text predicates: Unicode-aware blanks, sentinels and symbol-only flair."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space when text is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
    "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Characters a flair may consist of and still carry no meaning.
FLAIR_SYMBOLS = "!@#$%^&*()[]{}<>?/\\|~`"

# The bodies that stand for withdrawn text, and the withdrawn author.
DELETED = "[deleted]"
REMOVED = "[removed]"


def strip(text: Column) -> Column:
    """Trim all Unicode white space, not only spaces, from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    """True for NULL, empty and white-space-only text; never NULL."""
    return text.isNull() | (strip(text) == "")


def is_empty(text: Column) -> Column:
    """True for NULL and the empty string only; never NULL."""
    return text.isNull() | (text == "")


def has_text(text: Column) -> Column:
    """True when the text is neither NULL nor empty; never NULL."""
    return text.isNotNull() & (text != "")


def only_symbols(text: Column) -> Column:
    """True for non-empty text that holds nothing but flair symbols once stripped."""
    return has_text(text) & (F.btrim(strip(text), F.lit(FLAIR_SYMBOLS)) == "")


def is_sentinel(text: Column) -> Column:
    """The body is exactly a withdrawn-text marker."""
    return text.isin(DELETED, REMOVED)


def mentions_sentinel(text: Column) -> Column:
    """The body contains a withdrawn-text marker in any letter case."""
    return is_sentinel(text) | text.ilike("%[deleted]%") | text.ilike("%[removed]%")
