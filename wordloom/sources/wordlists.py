"""Stop lists, ranked vocabularies and term counts, parsed from text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.tokens import trim_control


def word_list(lines: DataFrame) -> DataFrame:
    """``word``: every line, trimmed and lowercased, is one literal word."""
    return lines.select(F.lower(trim_control("value")).alias("word")).distinct()


def small_word_list(lines: DataFrame, max_words: int = 10_000) -> list[str]:
    """The same words as a Python list, for a list that is known to be short.

    A longer one raises an error; pass ``word_list(lines)`` to the operators instead,
    which then join with it.
    """
    rows = word_list(lines).limit(max_words + 1).collect()
    if len(rows) > max_words:
        raise ValueError(f"more than {max_words} words: use word_list() and a join")
    return sorted(row.word for row in rows)


def vocabulary(lines: DataFrame, normalise: bool = False) -> DataFrame:
    """``word``: the distinct first fields of tab-separated lines.

    Raw by default; ``normalise`` trims and lowercases. Lines of nothing but tabs have
    no first field.
    """
    word = F.substring_index("value", "\t", 1)
    if normalise:
        word = F.lower(trim_control(word))
    return lines.filter(~F.col("value").rlike(r"^\t+$")).select(word.alias("word")).distinct()


def term_counts(lines: DataFrame, digits_only: bool = False) -> DataFrame:
    """``term, df`` from the lines with exactly two tab fields (empty ones at the end
    do not count).

    A count that is no number raises an error, unless ``digits_only`` says to keep only
    the lines whose count is a row of digits. A term given twice with different counts
    raises an error, too, since lines of a table have no order in which one could win.
    """
    fields = F.split(F.regexp_replace("value", r"\t+$", ""), "\t")
    parsed = lines.select(fields.alias("fields")).filter(F.size("fields") == 2)
    term, count = F.col("fields")[0], F.col("fields")[1]
    if digits_only:
        number = F.when(count.rlike(r"^[0-9]+$"), count.try_cast("bigint"))
        rows = parsed.select(term.alias("term"), number.alias("df")).filter("df is not null")
    else:
        rows = parsed.select(term.alias("term"), count.cast("bigint").alias("df"))
    conflict = F.concat(F.lit("different counts for "), F.col("term"))
    df = F.when(F.min("df") == F.max("df"), F.max("df")).otherwise(F.raise_error(conflict))
    return rows.groupBy("term").agg(df.alias("df"))
