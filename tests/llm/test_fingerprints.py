"""SimHash and its radius search against brute force."""

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD
from wordloom.llm.fingerprints import count_near, fingerprint_edited, fingerprint_report, likeness, simhash


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    rows = [(i, t or "") for i, t in rows]
    found = []
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        one, two, three = simhash(text), simhash(edited), simhash(following)
        found.append((i, len(text), sha256(edited.encode()).hexdigest(), f"{one:016x}", f"{two:016x}",
                      likeness(one, two), likeness(one, three)))
    return found


def sort(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_edited_texts_of_odd_rows(docs):
    assert sort(map(tuple, fingerprint_edited(docs(*ODD)).collect())) == sort(expected(ODD))
    assert fingerprint_edited(docs(*ODD).limit(0)).count() == 0


def test_edited_texts_over_many_ranges(spark, docs):
    pick = random.Random(3)
    rows = [(pick.randrange(10**9), " ".join(pick.choices("abcdefgh", k=pick.randint(0, 40)))) for _ in range(300)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        found = fingerprint_edited(docs(*rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sort(map(tuple, found)) == sort(expected(rows))


@pytest.mark.parametrize("start", [2**53 - 3, 2**63 - 41, -(2**63)])
def test_large_ids_and_null_ids_between_them(spark, docs, start):
    rows = [(start + i, f"text {i} of some words " * (i % 4)) for i in range(40)]
    rows += [(None, f"no id {i}") for i in range(3)]
    random.Random(5).shuffle(rows)
    assert sort(map(tuple, fingerprint_edited(docs(*rows)).collect())) == sort(expected(rows))


def test_many_null_ids_are_spread_over_ranges(spark, docs):
    pick = random.Random(6)
    rows = [(None, " ".join(pick.choices("abcdefgh", k=pick.randint(0, 6)))) for _ in range(10_000)]
    rows += [(i % 7, f"same {i % 50}") for i in range(700)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        frame = fingerprint_edited(docs(*rows))
        found = frame.collect()
        sizes = [r["count"] for r in frame.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sort(map(tuple, found)) == sort(expected(rows))
    assert max(sizes) < 0.25 * len(rows)


def test_radius_search_finds_all(spark):
    pick = random.Random(1)
    centres = [pick.getrandbits(64) for _ in range(20)]
    prints = []
    for _ in range(600):
        value = pick.choice(centres)
        for bit in pick.sample(range(64), pick.randint(0, 5)):
            value ^= 1 << bit
        prints.append(value)
    frame = spark.createDataFrame([(f"{p:016x}",) for p in prints], "fingerprint string")
    for radius, blocks in ((3, 5), (2, 6), (0, 4)):
        found = {r[0]: r[1] for r in count_near(frame, frame, radius, blocks).collect()}
        wanted = {f"{p:016x}": sum((p ^ q).bit_count() <= radius for q in prints) for p in prints}
        assert found == wanted


def test_report_counts_other_documents(docs):
    text = "the same long text of more than five words"
    rows = [(20, text), (21, text), (40, "another text that has nothing to do with it"), (60, None)]
    found = {r["doc_id"]: r["n_near"] for r in fingerprint_report(docs(*rows)).collect()}
    assert found == {20: 1, 21: None, 40: 0, 60: 0}
