"""Text expressions. White space means Unicode white space plus the four separator controls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space, as a list and as a regular expression.
WHITE_SPACE = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPACE = r"[\s\x1c-\x1f]"  # under (?U)
NOT_PLAIN = r"[^\x20-\x7e]"  # plain texts have the blank as their only white space


def strip(text: Column) -> Column:
    first, last = F.substring(text, 1, 1), F.substring(text, -1, 1)
    visible = first.between("!", "~") & last.between("!", "~")  # most texts; looking through the list takes longer
    return F.when(visible, text).otherwise(F.btrim(text, F.lit(WHITE_SPACE)))


def is_blank(text: Column) -> Column:
    """True for text without any visible character; NULL for NULL."""
    return strip(text) == ""


def single_spaced(text: Column) -> Column:
    """Stripped text with every run of white space as one blank."""
    return F.regexp_replace(strip(text), rf"(?U){SPACE}+", " ")


def tokenize(text: Column) -> Column:
    """Lower-cased white-space tokens; punctuation stays attached."""
    lowered = F.lower(text)
    # Spark compiles a pattern for every row that it splits, but for a single character
    parts = F.when(lowered.rlike(NOT_PLAIN), F.split(lowered, rf"(?U){SPACE}+")).otherwise(F.split(lowered, " "))
    return F.array_remove(parts, "")


def split_sentences(text: Column) -> Column:
    """Sentences of the stripped text, cut at white space behind a full stop, ! or ?."""
    return F.split(strip(text), rf"(?U)(?<=[.!?]){SPACE}+")
