"""Co-occurrence of vocabulary words within a line.

Positions count all words of the line, in the vocabulary or not. The count of (a, b) is
symmetric by definition, so only the words after the centre are looked at, and the
result is mirrored at the end, when it has at most |vocabulary|² rows.

The vocabulary test is written after the counting. The optimizer moves both semi joins
below the count, and the first one below the unfolding of the windows, exactly when the
vocabulary is small enough to be broadcast; then one pass over the corpus needs no
shuffle but that of the partial counts. A vocabulary too large for that is joined with
the counted pairs instead of with every occurrence. One whose size the optimizer cannot
tell is stored and measured first, so that this never rests on a guess.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.tokens import NOT_WORD
from wordloom.operators.selection import keep_vocabulary, of_known_size
from wordloom.ordering import range_bounds, range_of
from wordloom.storage import stored

WHOLE_ARRAY = 2**31 - 1


def _following(lines: DataFrame, distance: int, mode: str) -> DataFrame:
    """``word, coword``: every word with those that follow it at the distance."""
    tokens = lines.select(F.split(F.lower("value"), NOT_WORD).alias("tokens"))
    # Empty strings at the ends of the array shift all positions alike. The slice of the
    # whole array keeps the optimizer from inferring a filter on it, which would repeat
    # the split for every line.
    words = tokens.select(
        "tokens", F.posexplode(F.slice("tokens", 1, WHOLE_ARRAY)).alias("pos", "word")
    )
    if mode == "exact":
        coword = F.get("tokens", F.col("pos") + distance)
        return words.select("word", coword.alias("coword")).filter("coword is not null")
    window = F.slice("tokens", F.col("pos") + 2, distance)
    return words.select("word", F.explode(window).alias("coword"))


def cooccurrence_pairs(
    lines: DataFrame,
    vocabulary: DataFrame,
    distance: int,
    mode: str = "within",
    large_vocabulary: bool = False,
) -> DataFrame:
    """``word, coword, cnt`` for both words in the vocabulary.

    ``exact`` pairs the words whose positions differ by the distance; at distance 0 every
    word is paired with itself twice. ``within`` pairs all positions that differ by 1 up
    to the distance. The order within a pair matters: (a, b) and (b, a) are two rows.

    ``large_vocabulary`` is for one that holds most words of the corpus: unordered pairs
    are counted in one aggregation, then tested, then mirrored.
    """
    if mode not in ("exact", "within"):
        raise ValueError(f"unknown mode {mode!r}")
    if distance < 0 and mode == "exact":
        raise ValueError("the distance must not be negative")
    following = _following(lines, max(distance, 0), mode)
    if large_vocabulary:
        following = following.select(
            F.least("word", "coword").alias("word"), F.greatest("word", "coword").alias("coword")
        )
    forward = following.groupBy("word", "coword").agg(F.count(F.lit(1)).alias("cnt"))
    key = vocabulary.columns[0]
    vocabulary = vocabulary.select(key).filter(F.col(key) != "")
    if not large_vocabulary:
        vocabulary = of_known_size(vocabulary)
    forward = keep_vocabulary(forward, vocabulary, "word")
    forward = keep_vocabulary(forward, vocabulary, "coword")
    if large_vocabulary:
        twice = F.array(F.struct("word", "coword", (F.col("cnt") * 2).alias("cnt")))
        sides = F.array(
            F.struct("word", "coword", "cnt"),
            F.struct(F.col("coword").alias("word"), F.col("word").alias("coword"), "cnt"),
        )
        return forward.select(F.inline(F.when(F.col("word") == F.col("coword"), twice).otherwise(sides)))
    directions = F.array(
        F.struct("word", "coword", "cnt"),
        F.struct(F.col("coword").alias("word"), F.col("word").alias("coword"), "cnt"),
    )
    both = forward.select(F.inline(directions))
    return both.groupBy("word", "coword").agg(F.sum("cnt").alias("cnt"))


def cooccurrence_stripes(
    lines: DataFrame, vocabulary: DataFrame, distance: int, mode: str = "within"
) -> DataFrame:
    """``word, stripe``: per word a map of its cowords and counts, in their order.

    The maps are built last, from pairs already counted, so a word contributes at most
    |vocabulary| rows. Words without a neighbour have no row.
    """
    pairs = cooccurrence_pairs(lines, vocabulary, distance, mode)
    entries = F.array_sort(F.collect_list(F.struct("coword", "cnt")))
    return pairs.groupBy("word").agg(F.map_from_entries(entries).alias("stripe"))


def cooccurrence_stripe_pieces(
    lines: DataFrame,
    vocabulary: DataFrame,
    distance: int,
    mode: str = "within",
    entries: int = 100_000,
    large_vocabulary: bool = False,
) -> DataFrame:
    """``word, part, stripe``: stripes in pieces of about ``entries`` cowords at most.

    For large vocabularies, where one map per word would grow with the vocabulary. The
    parts are the same ranges of cowords for all words, found from the counted pairs, which
    are stored; so the pieces of a word, by part, follow each other in the order of their
    cowords and together are its stripe. A piece without a coword has no row.
    """
    pairs = stored(cooccurrence_pairs(lines, vocabulary, distance, mode, large_vocabulary))
    cowords = stored(pairs.select("coword").distinct())
    parts = max(1, -(-cowords.count() // entries))
    part = range_of(["coword"], range_bounds(cowords, ["coword"], parts), pairs.schema)
    found = F.array_sort(F.collect_list(F.struct("coword", "cnt")))
    return pairs.groupBy("word", part.alias("part")).agg(F.map_from_entries(found).alias("stripe"))
