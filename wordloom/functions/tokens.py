"""Column functions that turn text into arrays of tokens, and small string helpers.

All of them are built-in expressions and run in the JVM; all but ``without``, which takes
a lambda and is interpreted, are part of whole-stage codegen.
Splitting and dropping the empty ends is measurably faster in Spark than collecting
the matches of the complementary pattern.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# What separates tokens and lines.
NOT_WORD = r"[^\w']+"
NOT_LETTER = r"[^a-z]+"
NOT_ALNUM = r"[^a-z0-9]+"
LINE_END = r"\r\n|\n|\r"
CONTROL_ENDS = r"^[\x00-\x20]+|[\x00-\x20]+$"


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _split(text: Column, separator: str) -> Column:
    return F.array_remove(F.split(text, separator), "")


def word_tokens(text: Column | str, case_sensitive: bool = False) -> Column:
    """Runs of ASCII letters, digits, ``_`` and ``'``, lowercased unless told otherwise."""
    text = _column(text)
    return _split(text if case_sensitive else F.lower(text), NOT_WORD)


def letter_tokens(text: Column | str) -> Column:
    """Lowercased runs of ASCII letters; digits and apostrophes split."""
    return _split(F.lower(_column(text)), NOT_LETTER)


def alnum_tokens(text: Column | str) -> Column:
    """Lowercased runs of ASCII letters and digits."""
    return _split(F.lower(_column(text)), NOT_ALNUM)


def lines_of(text: Column | str) -> Column:
    """The lines of a text as a line reader sees them.

    LF, CRLF or CR ends a line, and the end of the last line opens no further one.
    """
    text = _column(text)
    body = (
        F.when(text.endswith("\r\n"), F.substring(text, F.lit(1), F.length(text) - 2))
        .when(
            text.endswith("\n") | text.endswith("\r"),
            F.substring(text, F.lit(1), F.length(text) - 1),
        )
        .otherwise(text)
    )
    return F.split(body, LINE_END)


def trim_control(value: Column | str) -> Column:
    """Cut blanks and control characters off both ends."""
    return F.regexp_replace(_column(value), CONTROL_ENDS, "")


def document_id(path: Column | str) -> Column:
    """The base name of a path without its last extension; a leading dot starts none."""
    name = F.substring_index(_column(path), "/", -1)
    return F.regexp_replace(name, r"(?s)^(.+)\.[^.]*$", "$1")


def without(tokens: Column, words: Sequence[str]) -> Column:
    """The tokens that are not in a short constant list, repeats kept."""
    words = list(words)
    return F.filter(tokens, lambda token: ~token.isin(words)) if words else tokens
