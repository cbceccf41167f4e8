"""Text rules of the catalogs and the news feed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spellings that stand for null, compared in lower case after trimming.
NULL_SPELLINGS = ("", "none", ".", "null")
BLANKS = " \t"


def bare(c: Column | str) -> Column:
    """Without blanks and tabs around it."""
    return F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(BLANKS))


def canonical(c: Column | str) -> Column:
    """Lower case, trimmed; null for every spelling of null."""
    t = F.lower(bare(c))
    return F.when(~t.isin(*NULL_SPELLINGS), t)


def spelled(c: Column | str) -> Column:
    """Trimmed as written; null for every spelling of null."""
    t = bare(c)
    return F.when(~F.lower(t).isin(*NULL_SPELLINGS), t)


def canonical_symbol(c: Column | str) -> Column:
    """Trimmed, upper case; null for every spelling of null."""
    return F.upper(spelled(c))


def canonical_url(c: Column | str) -> Column:
    """Equal for urls that differ in letter case, http or https, and one slash at the end.

    Null stays null; a blank url counts as missing.
    """
    u = F.lower(F.trim(F.col(c) if isinstance(c, str) else c))
    u = F.regexp_replace(F.regexp_replace(u, "^https?://", ""), "/$", "")
    return F.when(u != "", u)


def fingerprint(*cols: Column) -> Column:
    """128-bit hash of a row as a binary of 16 bytes, nulls told from empty texts.

    Every column becomes text, a null its own mark, and the parts are set apart by
    a separator, so that moving a value to a neighbouring column changes the hash.
    """
    marked = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("~")) for c in cols]
    return F.unhex(F.md5(F.concat_ws("\u0001", *marked)))
