"""Text expressions. Everything here is a native column expression."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as Unicode defines it (trim() alone only knows U+0020).
SPACES = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
          "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
TAG = r"<[^>]+>"
TERM_BREAK = r"[^\p{L}\p{N}_]+"
NUMBER_MARK = r"[,:]([0-9])"
SEPARATORS = SPACES + ';@#$%&?!"()[]{}<>,:'
TOKEN = r"^[a-zà-ü]+$"
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüæð÷ø"
UNACCENTED = "aaaaaaceeeeiiiinooooouuuu"


def strip_html(col: Column) -> Column:
    """Delete tags; entities stay as they are."""
    return F.regexp_replace(F.coalesce(col, F.lit("")), TAG, "")


def strip(col: Column) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.trim(col, F.lit(SPACES))


def normalize_text(col: Column) -> Column:
    """NULL becomes the empty string; lower case; stripped."""
    return strip(F.lower(F.coalesce(col.cast("string"), F.lit(""))))


def full_text(titulo: Column, resumo: Column) -> Column:
    """Title, one blank, summary; the blank stays when the title is empty."""
    return F.concat(titulo, F.lit(" "), resumo)


def is_blank(col: Column) -> Column:
    """NULL, empty or nothing but whitespace."""
    return strip(F.coalesce(col.cast("string"), F.lit(""))) == ""


def fold_accents(col: Column) -> Column:
    """Drop accents from a token of the alphabet a-z, à-ü."""
    return F.translate(col, ACCENTED, UNACCENTED)


def tokenize(col: Column) -> Column:
    """Lower-case chunks between separators, without their closing periods.

    A comma or colon before a digit does not separate, so such a chunk stays whole.
    """
    marked = F.regexp_replace(F.lower(F.coalesce(col, F.lit(""))), NUMBER_MARK, "\u0001$1")
    spaced = F.replace(F.replace(F.translate(marked, SEPARATORS, " " * len(SEPARATORS)),
                                 F.lit("--"), F.lit(" ")), F.lit("..."), F.lit(" "))
    return F.transform(F.split(spaced, " "), lambda t: F.rtrim(t, F.lit(".")))


def filter_tokens(tokens: Column, stopwords: Iterable[str], fold: bool = False) -> Column:
    """Keep whole-letter tokens of three or more characters that are not stopwords.

    The token is compared without accents. With ``fold`` the stopwords are too.
    """
    words = sorted(set(stopwords))
    if fold:
        table = str.maketrans(ACCENTED, UNACCENTED.ljust(len(ACCENTED), "\0"))
        words = sorted({w.translate(table).replace("\0", "") for w in words})

    def keep(t: Column) -> Column:
        ok = (F.length(t) > 2) & t.rlike(TOKEN)
        return ok & ~fold_accents(t).isin(words) if words else ok

    return F.filter(tokens, keep)


def vocabulary_terms(col: Column) -> Column:
    """Lower-case runs of two or more letters, digits or underscores."""
    return F.filter(F.split(F.lower(F.coalesce(col, F.lit(""))), TERM_BREAK),
                    lambda t: F.length(t) >= 2)


def capitalize(col: Column) -> Column:
    """First character upper case, the rest lower (not per word)."""
    return F.concat(F.upper(F.substring(col, 1, 1)),
                    F.lower(F.substring(col, F.lit(2), F.length(col))))


def display_label(termo: Column, tema: Column) -> Column:
    return F.concat(termo, F.lit(" ["), capitalize(tema), F.lit("]"))


def csv_items(col: Column) -> Column:
    """Items of a comma-joined string, trimmed, without blanks."""
    return F.filter(F.transform(F.split(col, ","), strip), lambda s: s != "")
