"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters that count as whitespace when a text is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove leading and trailing whitespace of any kind in one pass over the text.

    A pattern such as ``\\s+$`` would retry at every blank and take quadratic time on long blank runs.
    """
    return F.btrim(text, F.lit(WHITESPACE))


def title_label(name: Column) -> Column:
    """``model_output`` as ``Model Output``."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def tokens(text: Column) -> Column:
    """Lower-case words: maximal runs of letters and digits of any script."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
