"""Text expressions shared by rules, profiling and standardization."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts that a CSV reader turns into NULL.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Every character Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# What a word is made of, as the body of a regex character class.
ALNUM = r"\p{L}\p{N}"
CASED = r"\p{Lu}\p{Ll}\p{Lt}"

LEADING_LETTERS = "^[A-Za-z]+"


def null_if_token(name: str) -> str:
    """SQL text: a column with NA-like cells as NULL. Nothing is trimmed first: ``' '`` stays."""
    tokens = ", ".join(f"'{t}'" for t in NULL_TOKENS)
    return f"CASE WHEN `{name}` NOT IN ({tokens}) THEN `{name}` END AS `{name}`"


def strip(c: Column) -> Column:
    """Remove all whitespace at both ends. ``F.trim`` removes spaces only."""
    return F.btrim(c, F.lit(WHITESPACE))


# A character that Unicode reserves and no text holds, before a space that starts a word.
_WORD_START = "\uffff "


def _not_capitalized(c: Column, word: str) -> Column:
    """A word starts in lower case or goes on in upper case. One regex search per value."""
    return c.rlike(rf"(?<![{word}])\p{{Ll}}|(?<=[{word}])[\p{{Lu}}\p{{Lt}}]")


def _capitalize(c: Column, word: str) -> Column:
    """``F.initcap`` with words of our own: it starts a word after a space, so mark each start.

    Most values are canonical already and are passed on as they are. A value that holds the mark
    itself is taken apart and put together again, so that no character of it is lost.
    """
    marked = F.regexp_replace(c, f"(?<![{word}])(?=[{word}])", _WORD_START)
    rebuilt = F.replace(F.initcap(marked), F.lit(_WORD_START), F.lit(""))
    runs = F.regexp_extract_all(c, F.lit(f"[{word}]+|[^{word}]+"), F.lit(0))
    pieced = F.array_join(
        F.transform(runs, lambda w: F.when(w.rlike(f"^[{word}]"), F.initcap(w)).otherwise(w)), "")
    rebuilt = F.when(F.contains(c, F.lit(_WORD_START[0])), pieced).otherwise(rebuilt)
    return F.when(_not_capitalized(c, word), rebuilt).otherwise(c)


def initcap(c: Column) -> Column:
    """Capitalize words made of letters and digits: ``in-transit 3d`` → ``In-Transit 3d``."""
    return _capitalize(c, ALNUM)


def title(c: Column) -> Column:
    """Capitalize words made of cased letters only: ``in-transit 3d`` → ``In-Transit 3D``."""
    return _capitalize(c, CASED)


def differs_from_initcap(c: Column) -> Column:
    """``c <> initcap(trim(c))``; NULL in, NULL out."""
    return (c != F.trim(c)) | _not_capitalized(c, ALNUM)


def differs_from_title(c: Column) -> Column:
    """``c <> title(strip(c))``; NULL in, NULL out."""
    return (c != strip(c)) | _not_capitalized(c, CASED)


def leading_letters(c: Column) -> Column:
    """The alphabetic key prefix, NULL when the key does not start with a letter."""
    return F.regexp_substr(c, F.lit(LEADING_LETTERS))


def without_prefix(c: Column) -> Column:
    return F.regexp_replace(c, LEADING_LETTERS, "")


def replace_prefix(c: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), without_prefix(c))
