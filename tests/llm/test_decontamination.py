"""Benchmark decontamination against a search of every window in every text."""

import hashlib
import random
import re

import pytest

from tests.llm.conftest import ODD
from wordloom.llm.decontamination import find_leaks, leak_report, remove_leaks

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(WORD, lower)


def brute(documents, items, size=10):
    found = []
    for doc_id, text in documents:
        words, hit, met = words_of(text), set(), set()
        for item, passage in items:
            own = words_of(passage)
            length = min(size, len(own))
            windows = {tuple(own[p : p + length]) for p in range(len(own) - length + 1)} if own else set()
            for p in range(len(words) - length + 1):
                if length and tuple(words[p : p + length]) in windows:
                    hit |= set(range(p, p + length))
                    met.add("" if item is None else str(item))
        digest = hashlib.sha256(",".join(sorted(met)).encode()).hexdigest()
        found.append((doc_id, len(words), len(hit), len(met), digest, bool(hit)))
    return sorted(found, key=repr)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(4)
    vocabulary = [*"abcdefghij", "été", "Ünï", "x1", "don't", "中文"]
    say = lambda n: rng.choice([" ", "-", ", "]).join(rng.choices(vocabulary, k=n))
    items = [(i, say(rng.randint(1, 40))) for i in range(12)]
    items += [(3, say(15)), (None, say(12)), (20, ""), (21, None), (22, "!?"), (23, "Solo"), (9, items[9][1])]
    common = say(14)  # a passage of many items in many documents
    items += [(100 + i, f"{say(3)} {common} {say(2)}") for i in range(9)]
    documents = list(ODD)
    for i in range(60):
        parts = [say(rng.randint(0, 60)), rng.choice(items)[1] or "", say(5), rng.choice([common, ""])]
        documents.append((100 + i, " ".join(parts).upper() if i % 3 else "\n".join(parts)))
    documents += [documents[-1], (None, documents[-2][1]), (500, "x " * 40_000 + (items[0][1] or ""))]
    return documents, items


@pytest.mark.parametrize("bound", [400_000, 5])
@pytest.mark.parametrize("size", [10, 3])
def test_report_equals_brute_force(spark, docs, tables, bound, size):
    documents, items = tables
    benchmark = spark.createDataFrame(
        [(i, t, "x", 1) for i, t in items], "item_id long, text string, hash string, words int"
    )
    found = leak_report(docs(*documents), benchmark, size=size, broadcast_windows=bound)
    assert sorted(map(tuple, found.collect()), key=repr) == brute(documents, items, size)


def test_empty_tables(spark, docs, tables):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r["contaminated"] for r in leak_report(docs(*ODD), none).collect())
    benchmark = spark.createDataFrame(tables[1], "item_id long, text string")
    for bound in (400_000, 5):
        assert leak_report(docs(*ODD).limit(0), benchmark, broadcast_windows=bound).collect() == []


@pytest.mark.parametrize("bound", [400_000, 1])
def test_spans_or_documents_are_removed(spark, docs, bound):
    benchmark = spark.createDataFrame(
        [(1, "one two, three FOUR five six seven eight nine ten eleven")], "item_id long, text string"
    )
    leaky = "Before. One two three; four five-six seven eight nine\nten! After, été."
    rows = docs((1, leaky), (2, "Nothing of it."), (None, None)).selectExpr("*", "9 as leaks", "8 as row")
    left = remove_leaks(rows, benchmark, broadcast_windows=bound)
    assert left.columns == rows.columns
    found = {r["doc_id"]: r for r in left.collect()}
    assert found[1]["text"] == "Before. ! After, été." and found[1]["leaks"] == 9 and found[1]["row"] == 8
    assert found[2]["text"] == "Nothing of it." and found[None]["text"] is None
    whole = remove_leaks(rows, benchmark, whole_documents=True, broadcast_windows=bound)
    assert {r["doc_id"] for r in whole.collect()} == {2, None}
    kept = find_leaks(rows, benchmark, carried=["doc_id", "text"], broadcast_windows=bound)
    assert {r["doc_id"]: len(r["leaks"]["spans"]) for r in kept.collect()} == {1: 1, 2: 0, None: 0}
