"""Porter's suffix stripping (M. F. Porter, 1980, with his later ``bli`` and ``logi``).

Spark has no stemmer, so this is the one place where Python runs in a task. Tokens
travel as Arrow arrays and are dictionary encoded first: each distinct token of a task is
stemmed once, and the occurrences are filled in or counted as whole arrays. A batch of
lists is counted in slices of some 200,000 tokens, and each slice goes back by itself, so
that what a worker holds besides the batch does not grow with the texts in it.

The functions are marked non-deterministic although they are not. Without the mark the
optimizer copies the call into filters and moves those below earlier steps, which runs
the stemmer again, and on more rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Executors need not have this package installed: ship the functions by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The suffixes of steps 2, 3 and 4 with their replacements.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
    "logi": "log",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic",
    "ful": "", "ness": "",
}
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)

LETTER_KINDS = str.maketrans(
    "abcdefghijklmnopqrstuvwxyz", "vcccvcccvcccccvcccccvcccyc"
)


def _by_last_letters(suffixes) -> dict[str, list[str]]:
    """The suffixes by their last two letters, the longest first."""
    groups: dict[str, list[str]] = {}
    for suffix in sorted(suffixes, key=len, reverse=True):
        groups.setdefault(suffix[-2:], []).append(suffix)
    return groups


ENDINGS_2, ENDINGS_3, ENDINGS_4 = map(_by_last_letters, (STEP_2, STEP_3, STEP_4))


def _shape(word: str) -> str:
    """The word with every vowel as ``v`` and every consonant as ``c``.

    A ``y`` is a vowel exactly after a consonant. The shape of a prefix is a prefix of
    the shape, and the measure m of the paper is the number of ``vc`` in it.
    """
    shape = word.translate(LETTER_KINDS)
    while "y" in shape:
        at = shape.index("y")
        kind = "v" if shape[at - 1 : at] == "c" else "c"
        shape = shape[:at] + kind + shape[at + 1 :]
    return shape


def _ends_short(word: str, shape: str) -> bool:
    """Consonant, vowel, consonant at the end, the last one not w, x or y."""
    return shape.endswith("cvc") and word[-1] not in "wxy"


def _longest_suffix(word: str, endings: dict[str, list[str]]) -> str | None:
    for suffix in endings.get(word[-2:], ()):
        if word.endswith(suffix):
            return suffix
    return None


def _without_participle(word: str, shape: str) -> str:
    """Step 1b: ``eed``, ``ed`` and ``ing``, and the repair of what they leave."""
    if word.endswith("eed"):
        return word[:-1] if "vc" in shape[:-3] else word
    size = 2 if word.endswith("ed") else 3
    shape = shape[:-size]
    if "v" not in shape:
        return word
    word = word[:-size]
    if word.endswith(("at", "bl", "iz")):
        return word + "e"
    if shape[-1] == "c" and word[-1] == word[-2:-1]:
        return word if word[-1] in "lsz" else word[:-1]
    if shape.count("vc") == 1 and _ends_short(word, shape):
        return word + "e"
    return word


def porter_stem(word: str) -> str:
    """The stem of one lowercase word; words of one or two letters stay."""
    if len(word) < 3:
        return word
    if word.endswith("s"):
        if word.endswith(("sses", "ies")):
            word = word[:-2]
        elif not word.endswith("ss"):
            word = word[:-1]
    shape = _shape(word)
    if word.endswith(("ed", "ing")):
        word = _without_participle(word, shape)
        shape = _shape(word)
    if word.endswith("y") and "v" in shape[:-1]:
        word, shape = word[:-1] + "i", shape[:-1] + "v"
    for rules, endings in ((STEP_2, ENDINGS_2), (STEP_3, ENDINGS_3)):
        suffix = _longest_suffix(word, endings)
        if suffix and "vc" in shape[: -len(suffix)]:
            word = word[: -len(suffix)] + rules[suffix]
            shape = _shape(word)
    suffix = _longest_suffix(word, ENDINGS_4)
    if suffix and shape[: -len(suffix)].count("vc") > 1:
        stem = word[: -len(suffix)]
        if suffix != "ion" or stem.endswith(("s", "t")):
            word, shape = stem, shape[: -len(suffix)]
    if word.endswith("e"):
        stem, stem_shape = word[:-1], shape[:-1]
        measure = stem_shape.count("vc")
        if measure > 1 or (measure == 1 and not _ends_short(stem, stem_shape)):
            word, shape = stem, stem_shape
    if word.endswith("ll") and shape.count("vc") > 1:
        word = word[:-1]
    return word


#: Stems of the tokens that the running task has seen.
_seen: dict[str, str] = {}
MAX_SEEN = 100_000


def _remembered_stem(token: str) -> str:
    stem = _seen.get(token)
    if stem is None:
        if len(_seen) >= MAX_SEEN:
            _seen.clear()
        stem = _seen[token] = porter_stem(token)
    return stem


def _stem_strings(tokens: pa.Array) -> pa.Array:
    encoded = tokens.dictionary_encode()
    stems = [_remembered_stem(token) for token in encoded.dictionary.to_pylist()]
    return pa.array(stems, pa.string()).take(encoded.indices)


def _count_stems(lists: pa.Array, stemmed: bool = True, known: pa.Array | None = None) -> pa.Array:
    encoded = lists.flatten().dictionary_encode()
    stems = encoded.dictionary
    if stemmed:
        stems = pa.array([_remembered_stem(token) for token in stems.to_pylist()], pa.string())
    stems = stems.dictionary_encode()
    names = stems.dictionary
    # Numbered in the order of the stems, so that the entries of a row come out in it.
    order = pc.array_sort_indices(names)
    rank = np.empty(len(names), dtype=np.int64)
    rank[order.to_numpy()] = np.arange(len(names))
    names = names.take(order)
    # one number per occurrence, for its row and its stem
    codes = rank[stems.indices.to_numpy()][encoded.indices.to_numpy()]
    rows = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy())
    if known is not None:
        listed = pc.is_in(names, value_set=known).to_numpy(zero_copy_only=False)[codes]
        codes, rows = codes[listed], rows[listed]
    size = max(len(names), 1)
    numbers, counts = np.unique(rows * size + codes, return_counts=True)
    rows, codes = np.divmod(numbers, size)
    entries = pa.StructArray.from_arrays(
        [names.take(pa.array(codes)), pa.array(counts, pa.int64())], ["term", "tf"]
    )
    offsets = np.searchsorted(rows, np.arange(len(lists) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), entries)


#: Tokens of lists that are counted at once; a longer list is counted alone.
SLICE_TOKENS = 200_000


def _sliced_counts(
    batches: Iterator[pa.Array], stemmed: bool = True, known: pa.Array | None = None
) -> Iterator[pa.Array]:
    for lists in batches:
        ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy().astype(np.int64))
        begin = done = 0
        while begin < len(lists):
            # As many whole lists as fit, one at least.
            end = max(begin + 1, int(np.searchsorted(ends, done + SLICE_TOKENS, side="right")))
            yield _count_stems(lists.slice(begin, end - begin), stemmed, known)
            begin, done = end, ends[end - 1]


@F.arrow_udf(T.StringType())
def _stem(tokens: pa.Array) -> pa.Array:
    return _stem_strings(tokens)


_COUNTED = T.ArrayType(T.StructType().add("term", T.StringType()).add("tf", T.LongType()))


@F.arrow_udf(_COUNTED)
def _counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    return _sliced_counts(batches)


def counts_within(known: Broadcast[pa.Array], stemmed: bool):
    """From an array of tokens to an array of its distinct terms (``term``, the stems or
    the tokens themselves) with their counts (``tf``), in the order of the terms; only of
    those that are ``known``."""

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _sliced_counts(batches, stemmed, known.value)

    return F.arrow_udf(count, _COUNTED).asNondeterministic()


@F.arrow_udf(_COUNTED)
def _plain_counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    return _sliced_counts(batches, stemmed=False)


#: Stem of a token column.
stem_token = _stem.asNondeterministic()
#: From an array of tokens to an array of its distinct stems (``term``) with their
#: counts (``tf``).
stem_counts = _counts.asNondeterministic()
#: The same for the tokens as they are.
token_counts = _plain_counts.asNondeterministic()
