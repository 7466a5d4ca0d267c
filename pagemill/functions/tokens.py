"""Sentences and words of a text."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# A sentence ends with . ! or ? and keeps the white space after it, so the sentences
# of a text concatenate to the text itself.
SENTENCE = r"(?s)(.*?[.!?][\t-\r ]+|.+)"
BETWEEN_WORDS = r"[^\p{L}\p{N}]+"
# Stands for a full stop that ends nothing; a code point that no text may hold.
HELD = "\uffff"


def sentences(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(1))


def words(text: Column) -> Column:
    """Lower-case words; the first and the last may be empty."""
    return F.split(F.lower(text), BETWEEN_WORDS)


def sentences_with(text: Column, abbreviations: Sequence[str]) -> Column:
    """Sentences, where a full stop behind one of the abbreviations ends none.

    Abbreviations are written without their last stop, in any case: ``dr``, ``z``, ``e.g``.
    """
    if not abbreviations:
        return sentences(text)
    known = "|".join(re.escape(a) for a in sorted(abbreviations, key=lambda a: (-len(a), a)))
    held = F.regexp_replace(text, rf"(?iu)(?<![\p{{L}}\p{{N}}.])({known})\.(?=[\t-\r ])", f"$1{HELD}")
    return F.transform(sentences(held), lambda s: F.replace(s, F.lit(HELD), F.lit(".")))
