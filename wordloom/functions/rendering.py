"""Text forms of result rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pair_text(word: Column | str, coword: Column | str) -> Column:
    """``{word,coword}``"""
    return F.format_string("{%s,%s}", word, coword)


def stripe_text(stripe: Column | str) -> Column:
    """A map of counts as ``{a=1, b=2}``, in the order of the words."""
    entries = F.array_sort(F.map_entries(stripe))
    parts = F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return F.concat(F.lit("{"), F.array_join(parts, ", "), F.lit("}"))


def score_line(doc_id: Column | str, term: Column | str, score: Column | str) -> Column:
    """``doc TAB term TAB score`` with six decimals."""
    doc_id, term = (F.col(c) if isinstance(c, str) else c for c in (doc_id, term))
    parts = (F.coalesce(c.cast("string"), F.lit("")) for c in (doc_id, term))
    return F.concat_ws("\t", *parts, score_text(score))


def score_text(score: Column | str) -> Column:
    """Six decimals."""
    return F.format_string("%.6f", score)
