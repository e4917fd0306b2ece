"""Ranges from key summaries, ordered files, and stripes in pieces."""

import random

import pytest
from pyspark.sql import functions as F

from wordloom import operators as O
from wordloom import ordering, sinks, storage
from wordloom.ordering import range_bounds, range_of


@pytest.fixture
def keys(spark):
    def make(pairs, partitions=5):
        return spark.createDataFrame(pairs, "k string, n int").repartition(partitions)

    return make


def in_order(key):
    return tuple((value is not None, value.encode() if isinstance(value, str) else value) for value in key)


def test_bounds_are_exact_for_few_keys(keys):
    pairs = [(w, n) for w in ("b", "ä", "a", "Z", "", None) for n in (2, 1, None, 3)]
    ranked = sorted(pairs, key=in_order)
    for parts in (1, 2, 5, 24, 100):
        bounds = range_bounds(keys(pairs), ["k", "n"], parts)
        wanted = sorted({-(-i * 24 // parts) for i in range(1, parts)} - {0})
        assert [tuple(b) for b in bounds] == [ranked[i] for i in wanted if i < 24]


def test_a_range_begins_with_a_whole_key(keys):
    frame = keys([("hot", 1)] * 90 + [("a", 1)] * 5 + [("z", 1)] * 5)
    bounds = range_bounds(frame, ["k"], 4)
    assert [b[0] for b in bounds] == ["hot"]
    number = range_of(["k"], bounds, frame.schema)
    assert sorted(map(tuple, frame.groupBy(number).count().collect())) == [(0, 5), (1, 95)]
    assert range_bounds(frame.limit(0), ["k"], 4) == []


def test_many_keys_are_summarised(spark, monkeypatch):
    """A summary that drops keys still cuts into ranges of about equal size."""
    monkeypatch.setattr(ordering, "SUMMARY", 200)
    n = 100_000
    frame = spark.range(0, n, 1, 40).select(F.col("id").cast("string").alias("k"))
    bounds = range_bounds(frame, ["k"], 10)
    number = range_of(["k"], bounds, frame.schema).alias("part")
    found = frame.groupBy(number).agg(F.count("k"), F.min("k"), F.max("k")).orderBy("part").collect()
    assert len(found) == 10
    assert all(0.8 * n / 10 < r[1] < 1.2 * n / 10 for r in found)
    assert all(x[3] < y[2] for x, y in zip(found, found[1:]))


@pytest.mark.parametrize("size", [3, 50, 5000])
def test_weights_of_a_summary_add_up(size):
    import pyarrow as pa

    rng = random.Random(1)
    words = [str(rng.randint(0, 999)) for _ in range(3000)]
    table = pa.table({"k0": words, "weight": pa.array([1] * 3000, pa.int64())})
    found = ordering._summary([table], ["k0"], size)
    assert found.num_rows <= max(size, 3) and sum(found["weight"].to_pylist()) == 3000
    below, step = 0, 3000 / max(size - 1, 1)
    for key, weight in zip(found["k0"].to_pylist(), found["weight"].to_pylist()):
        below += weight
        assert abs(sum(w <= key for w in words) - below) <= step


def test_files_in_order_from_one_reading(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.choice(["hot"] * 5 + list("abäZz")), rng.randint(0, 999), None if i % 9 else "x") for i in range(3000)]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    frame = spark.createDataFrame(rows, "k string, n int, rest string").repartition(6)
    frame = frame.mapInArrow(counted, frame.schema)
    path = f"{tmp_path}/out"
    sinks.write_tsv(frame, path, order_by=["k", "n"], files=7)
    assert read.value == 3000
    found = sorted(map(tuple, sinks.read_numbered_lines(spark, path).collect()))
    lines = [tuple(line.split("\t")) for _, _, line in found]
    assert [(k, int(n)) for k, n, _ in lines] == sorted(((k, n) for k, n, _ in rows), key=in_order)
    sizes = {}
    for number, line, _ in found:
        assert sizes.setdefault(number, 0) == line
        sizes[number] += 1
    # One first key has half of all rows and is spread over files by the second.
    assert sorted(sizes) == list(range(7)) and max(sizes.values()) < 460
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.write_tsv(frame, path, order_by=["k", "n"], files=7)
    sinks.write_tsv(frame.limit(0), path, overwrite=True, order_by=["k", "n"])
    assert sinks.read_numbered_lines(spark, path).count() == 0


@pytest.mark.parametrize("entries", [1, 3, 100])
def test_pieces_make_up_the_stripes(lines, words, entries):
    frame = lines("a b c d e f g", "c a f a", "g g", "", "b x a")
    vocabulary = words(*"abcdefg")
    whole = {r["word"]: r["stripe"] for r in O.cooccurrence_stripes(frame, vocabulary, 2).collect()}
    pieces = {}
    for row in O.cooccurrence_stripe_pieces(frame, vocabulary, 2, entries=entries).orderBy("part").collect():
        assert 0 < len(row["stripe"]) <= entries
        assert max(pieces.get(row["word"], {"": 0})) < min(row["stripe"])
        pieces.setdefault(row["word"], {}).update(row["stripe"])
    assert pieces == whole


def test_a_word_with_very_many_neighbours(spark):
    n = 1_000_000
    frame = spark.range(n).select(F.concat(F.lit("hub w"), "id").alias("value"))
    vocabulary = spark.range(n).select(F.concat(F.lit("w"), "id").alias("word")).union(spark.sql("select 'hub'"))
    rows = O.cooccurrence_stripe_pieces(frame, vocabulary, 1, large_vocabulary=True)
    hub = rows.filter("word = 'hub'").select("part", F.size("stripe").alias("n")).collect()
    assert len(hub) == 11 and sum(r["n"] for r in hub) == n and max(r["n"] for r in hub) < 110_000


def test_a_shared_folder_is_needed_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "yarn"
        _jsc = spark.sparkContext._jsc

    class Unset:
        def get(self, name, default):
            return default

    class Nothing:
        def sc(self):
            return self

        getCheckpointDir = sc

        def isDefined(self):
            return False

    Context._jsc = Nothing()
    session = type("Session", (), {"conf": Unset(), "sparkContext": Context()})()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_folder(session)
