"""Benchmark decontamination: windows of test items looked up in training texts."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.common import membership, stored, text_slices
from wordloom.llm.shingles import shingle_hashes, word_hashes

#: Bytes outside words become blanks: words are ASCII digits and letters, A-Z in lower
#: case, and everything that is not ASCII.
_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_SPANS = "array<struct<first:int,last:int>>"
#: Parts over which the rows of a window are dealt when windows are joined.
_PARTS = 16


def words_of(text: str) -> list[bytes]:
    """Runs of digits, letters and characters that are not ASCII; A-Z in lower case."""
    return text.encode().translate(_BYTES).split()


def item_windows(
    benchmark: DataFrame, size: int, id_column: str = "item_id", text_column: str = "text"
) -> DataFrame:
    """``hash, words, item``: the distinct windows of each item, words joined by blanks.

    An item of fewer words than ``size`` is one window. Rows that repeat an id are one
    item with the windows of all; items without an id are one with an empty id.
    """
    rows = benchmark.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("item"),
        F.col(text_column).alias("text"),
    )

    def cut(batches):
        for batch, texts in text_slices(batches):
            for item, text in zip(batch.column("item").to_pylist(), texts):
                words = words_of(text)
                hashes = shingle_hashes(word_hashes(words), size).view(np.int64)
                length = min(size, len(words))
                # However long an item is, a batch has a bounded number of its windows.
                for begin in range(0, len(hashes), 10_000):
                    places = range(begin, min(begin + 10_000, len(hashes)))
                    said = [b" ".join(words[p : p + length]) for p in places]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(hashes[begin : begin + 10_000]),
                            pa.array(said, pa.binary()),
                            pa.array([item] * len(said), pa.string()),
                        ],
                        names=["hash", "words", "item"],
                    )

    return rows.mapInArrow(cut, "hash long, words binary, item string").distinct()


@dataclass
class WindowSet:
    """The windows of a benchmark as sorted hashes, with what each says and whose it is."""

    hashes: np.ndarray
    words: list[bytes]
    items: list[list[str]]
    lengths: list[int]  # of windows, in words

    @classmethod
    def of(cls, windows: pa.Table) -> WindowSet:
        held: dict[tuple[int, bytes], list[str]] = {}
        for hash_, words, item in zip(*(windows[c].to_pylist() for c in ("hash", "words", "item"))):
            held.setdefault((hash_, words), []).append(item)
        keys = sorted(held)
        return cls(
            np.array([hash_ for hash_, _ in keys], dtype=np.int64),
            [words for _, words in keys],
            [held[key] for key in keys],
            sorted({words.count(b" ") + 1 for _, words in keys}),
        )

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[str]]:
        """The runs of words (first and last place) inside windows of items, and the items."""
        marks = np.zeros(len(words) + 1, dtype=np.int64)
        met: set[int] = set()
        hashed = word_hashes(words)
        for length in self.lengths:
            if length > len(words):
                break
            found = shingle_hashes(hashed, length).view(np.int64)
            at = np.searchsorted(self.hashes, found)
            at[at == len(self.hashes)] = 0
            for place in np.flatnonzero(self.hashes[at] == found):
                said = b" ".join(words[place : place + length])
                entry = at[place]
                # Equal hashes are no proof: the words decide.
                while entry < len(self.hashes) and self.hashes[entry] == found[place]:
                    if self.words[entry] == said:
                        met.add(int(entry))
                        marks[place] += 1
                        marks[place + length] -= 1
                    entry += 1
        return _runs(marks), sorted({item for entry in met for item in self.items[entry]})


def _runs(marks: np.ndarray) -> list[tuple[int, int]]:
    """The runs of places that are open, where marks open (+1) and close (-1) windows."""
    inside = np.concatenate([[False], np.cumsum(marks)[:-1] > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return [(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2])]


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    size: int = 10,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    carried: list[str] | None = None,
    result: str = "leaks",
    broadcast_windows: int = 400_000,
) -> DataFrame:
    """The rows of ``documents`` with ``leaks``: ``n_words``, ``spans`` and ``items``.

    Words are runs of digits, letters and characters that are not ASCII, A-Z in lower case.
    A span is a run of words, from ``first`` to ``last`` counted from 0, every one of which
    lies in a window of ``size`` consecutive words of an item; an item of fewer words is
    one window, one without words has none. ``items`` has the ids of all items with a
    window in the text, as sorted strings.

    The windows of the benchmark are counted. Up to ``broadcast_windows`` of them (some
    40 MB) are sent to all tasks as a set of hashes; every hit is verified by its words.
    A larger benchmark stays a table: a bitmap of fixed size keeps most windows of the
    documents out, the others are joined with it, on hash and words, each window dealt over
    16 parts. Both ways give the same rows.

    A null or empty text has no words and no spans. Rows that repeat an id are documents of
    their own, ids may be null. ``carried`` names the columns to return (all if not given);
    one that is called like ``result`` is replaced.
    """
    names = [c for c in (carried or documents.columns) if c != result]
    rows = documents.select(
        F.struct(*(F.col(f"`{c}`") for c in names)).alias("row") if names else F.lit(0).alias("row"),
        F.col(f"`{text_column}`").alias("text"),
    )
    windows = stored(item_windows(benchmark, size, item_column, item_text_column))
    if windows.count() <= broadcast_windows:
        found = _by_broadcast(rows, windows)
    else:
        found = _by_join(rows, windows)
    columns = [F.col("row").getField(c).alias(c) for c in names]
    return found.select(*columns, F.struct("n_words", "spans", "items").alias(result))


def _result(rows: DataFrame, **more: str) -> T.StructType:
    fields = {"n_words": "long", "spans": _SPANS, "items": "array<string>"} | more
    return T.StructType(
        [T.StructField("row", rows.schema["row"].dataType)]
        + [T.StructField(n, T._parse_datatype_string(t)) for n, t in fields.items()]
    )


def _span_array(spans: list[list[tuple[int, int]]]) -> pa.Array:
    entries = [[{"first": a, "last": b} for a, b in some] for some in spans]
    return pa.array(entries, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])))


def _by_broadcast(rows: DataFrame, windows: DataFrame) -> DataFrame:
    held = rows.sparkSession.sparkContext.broadcast(WindowSet.of(windows.toArrow()))

    def scan(batches):
        known = held.value
        for batch, texts in text_slices(batches):
            sizes, spans, items = [], [], []
            for text in texts:
                words = words_of(text)
                some, whose = known.hits(words)
                sizes.append(len(words))
                spans.append(some)
                items.append(whose)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(sizes, pa.int64()),
                    _span_array(spans),
                    pa.array(items, pa.list_(pa.string())),
                ],
                names=["row", "n_words", "spans", "items"],
            )

    return rows.mapInArrow(scan, _result(rows))


def _by_join(rows: DataFrame, windows: DataFrame) -> DataFrame:
    lengths = [
        r["length"]  # at most as many as a window has words
        for r in windows.select((F.size(F.split(F.col("words").cast("string"), " "))).alias("length"))
        .distinct()
        .collect()
    ]
    place_of = _bitmap(windows)

    # The windows of a text that may be an item's, each with its place.
    def cut(batches):
        bits = place_of.value
        for batch, texts in text_slices(batches):
            sizes, kept = [], []
            for text in texts:
                words = words_of(text)
                hashed = word_hashes(words)
                some = []
                for length in sorted(lengths):
                    if length > len(words):
                        break
                    found = shingle_hashes(hashed, length).view(np.int64)
                    at = found & (len(bits) * 64 - 1)
                    for place in np.flatnonzero((bits[at >> 6] >> (at & 63)) & 1 == 1):
                        said = b" ".join(words[place : place + length])
                        some.append((int(found[place]), said, int(place), length))
                sizes.append(len(words))
                kept.append([dict(zip(("hash", "words", "place", "length"), x)) for x in some])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(sizes, pa.int64()), pa.array(kept, candidate)],
                names=["row", "n_words", "candidates"],
            )

    candidate = pa.list_(
        pa.struct(
            [("hash", pa.int64()), ("words", pa.binary()), ("place", pa.int32()), ("length", pa.int32())]
        )
    )
    schema = _result(rows, candidates="array<struct<hash:long,words:binary,place:int,length:int>>")
    schema = T.StructType([f for f in schema.fields if f.name not in ("spans", "items")])
    # Equal rows have equal candidates, so a hash of both identifies what is joined back.
    looked = rows.mapInArrow(cut, schema)
    key = F.sha2(F.to_json(F.struct("row", "candidates")), 256)
    looked = stored(looked.withColumn("key", F.when(F.size("candidates") > 0, key)))
    clean = looked.filter("key is null").select(
        "row",
        "n_words",
        F.array().cast(_SPANS).alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    met = looked.filter("key is not null")
    cand = met.select("key", F.inline("candidates"))
    dealt = F.pmod(F.xxhash64("key"), F.lit(_PARTS)).cast("int")
    parts = F.explode(F.sequence(F.lit(0), F.lit(_PARTS - 1))).alias("part")
    texts = windows.select("hash", "words").distinct().select("hash", "words", parts)
    hits = stored(cand.withColumn("part", dealt).join(texts, ["hash", "words", "part"]))
    # A text has no more hits than windows; copies of a hit come from repeated rows.
    ends = F.collect_set(F.struct("place", "length"))
    spans = hits.groupBy("key").agg(ends.alias("hits"))
    owners = windows.select("hash", "words", "item", parts)
    whose = hits.select("key", "hash", "words", "part").distinct().join(owners, ["hash", "words", "part"])
    whose = whose.groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    merged = F.udf(_merged, _SPANS, useArrow=True)
    spans = spans.join(whose, "key").select("key", merged("hits").alias("spans"), "items")
    joined = met.join(spans, "key", "left").select(
        "row",
        "n_words",
        F.coalesce("spans", F.array().cast(_SPANS)).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
    return clean.unionByName(joined)


def _bitmap(windows: DataFrame, bits: int = 26):
    """Hash places of all windows, 8 MB however many there are, sent to the executors."""
    place = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1))
    words = (
        windows.select(place.alias("place"))
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(place & 63 as int)))").alias("mask"))
        .toArrow()
    )
    bitmap = np.zeros(1 << (bits - 6), dtype=np.int64)
    bitmap[words["word"].to_numpy()] = words["mask"].to_numpy()
    return windows.sparkSession.sparkContext.broadcast(bitmap)


def _merged(hits):
    """Runs of words from the windows ``(place, length)`` that cover them."""
    runs: list[list[int]] = []
    for place, length in sorted((h["place"], h["length"]) for h in hits):
        if runs and place <= runs[-1][1] + 1:
            runs[-1][1] = max(runs[-1][1], place + length - 1)
        else:
            runs.append([place, place + length - 1])
    return [{"first": a, "last": b} for a, b in runs]


def remove_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    whole_documents: bool = False,
    text_column: str = "text",
    **options,
) -> DataFrame:
    """``documents`` without the passages that are in the benchmark.

    The words of a span and what stands between them are cut out; with ``whole_documents``
    rows with a span go altogether. Other rows and columns stay as they are. Further
    options are those of :func:`find_leaks`.
    """
    found = find_leaks(
        documents.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("kept"), F.col(f"`{text_column}`").alias("text")),
        benchmark,
        **options,
    )
    found = found.withColumnRenamed(options.get("result", "leaks"), "leaks")
    if whole_documents:
        return found.filter(F.size("leaks.spans") == 0).select("kept.*")

    @F.udf("string", useArrow=True)
    def without(text, spans):
        if not spans:
            return text
        places = [m.span() for m in _WORD.finditer(text)]
        left, begin = [], 0
        for span in spans:
            left.append(text[begin : places[span["first"]][0]])
            begin = places[span["last"]][1]
        return "".join(left + [text[begin:]])

    text: Column = without("text", "leaks.spans")
    return found.select(
        *((text if c == text_column else F.col("kept").getField(c)).alias(c) for c in documents.columns)
    )


def leak_report(documents: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` per document: the
    words in spans, the items, and a hash of their ids, sorted and joined by commas."""
    found = find_leaks(documents, benchmark, carried=[id_column], result="leaks", **options)
    n_hit = F.aggregate("leaks.spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return found.select(
        id_column,
        "leaks.n_words",
        n_hit.alias("n_hit"),
        F.size("leaks.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("leaks.items", ","), 256).alias("items_sha256"),
        (F.size("leaks.spans") > 0).alias("contaminated"),
    )


#: The same for the tables ``documents`` and ``benchmark`` and windows of ten words.
CHECK_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS MATERIALIZED (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS MATERIALIZED (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[p : p + 9], ' ') AS said
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS p FROM b WHERE len(w) > 0)),
hits AS MATERIALIZED (
  SELECT row, p, t.n, item
  FROM (SELECT row, n, p, array_to_string(w[p : p + n - 1], ' ') AS said
        FROM (SELECT row, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p
              FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)) t
  JOIN windows USING (n, said)),
counts AS (
  SELECT row, count(DISTINCT place) AS n_hit
  FROM (SELECT row, unnest(generate_series(p, p + n - 1)) AS place FROM (SELECT DISTINCT row, p, n FROM hits))
  GROUP BY row),
items AS (
  SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT row, item FROM hits) GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN counts USING (row) LEFT JOIN items USING (row)
"""
