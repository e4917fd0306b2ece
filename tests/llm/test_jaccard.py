"""The n-gram Jaccard join against all pairs."""

import random

import pytest

from tests.llm.conftest import ODD
from wordloom.llm import jaccard
from wordloom.llm.components import components
from wordloom.llm.jaccard import jaccard_components, one_of_each


def shingles(text, size):
    words = (text or "").lower().split()
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if size else set()


def expected(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                root[find(a)] = find(b)
    groups = {}
    for a in range(len(rows)):
        groups.setdefault(find(a), []).append(rows[a][0])
    smallest = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return [(i, len(sets[a]), smallest[find(a)]) for a, (i, _) in enumerate(rows)]


def sort(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def family(pick, base, changes):
    words = list(base)
    for _ in range(changes):
        words[pick.randrange(len(words))] = f"new{pick.randrange(10**6)}"
    return " ".join(words)


def test_common_passages_and_lines_make_no_candidates(spark, docs, monkeypatch):
    """What many documents share is never among the rarest n-grams of a text that has
    others; short texts that are made of it are still linked."""
    pick = random.Random(9)
    passage = [f"p{n}" for n in range(60)]
    rows = [(i, " ".join([f"d{i}w{n}" for n in range(100)] + passage)) for i in range(300)]
    rows += [(1000 + i, " ".join(passage[: 50 + i % 3])) for i in range(30)]
    rows += [(2000 + i, f"all rights reserved by the owner of page {pick.randint(0, 9)}") for i in range(60)]
    verified = []
    keep = jaccard._verified

    def counted(pairs, *rest):
        verified.append(pairs.count())
        return keep(pairs, *rest)

    monkeypatch.setattr(jaccard, "_verified", counted)
    found = jaccard_components(docs(*rows), 5, 80)
    assert sort(map(tuple, found.collect())) == sort(expected(rows, 5, 80))
    assert sum(verified) < 200  # not 300 * 300


def test_blocks_and_partitions_give_the_same_prefixes(docs):
    """However documents are dealt, an n-gram has one rank: that of its whole frequency."""
    pick = random.Random(2)
    rows = [(i, " ".join(pick.choices("abcdefgh", k=pick.randint(0, 40)))) for i in range(200)] + ODD
    frame = docs(*rows).selectExpr("doc_id as _id", "coalesce(text, '') as text")
    columns = ["_id", "key", "n", "prefix", "places"]
    one = jaccard.signatures(frame, 2, 80).select(columns).collect()
    many = jaccard.signatures(frame, 2, 80, block_chars=300, part_grams=40).select(columns).collect()
    assert sorted(one, key=repr) == sorted(many, key=repr)
    frequency = {}
    for _, text in rows:
        for gram in jaccard.shingle_set(text or "", 2).view("int64").tolist():
            frequency[gram] = frequency.get(gram, 0) + 1
    for row in one:
        counts = [frequency[gram] for gram in row["prefix"]]
        assert counts == sorted(counts) and all(n > 1 for n in counts)


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (1, 50)])
def test_components_equal_all_pairs(docs, size, percent):
    pick = random.Random(size)
    passage = [f"p{n}" for n in range(40)]
    rows = []
    for group in range(6):
        base = [f"g{group}w{pick.randrange(300)}" for _ in range(pick.choice([12, 60, 200]))]
        rows += [family(pick, base, pick.choice([0, 0, 1, 2, 4])) for _ in range(14)]
    # Long texts on both sides of the threshold, and unrelated ones with a passage of it.
    base = [f"long{n}" for n in range(1500)]
    rows += [family(pick, base, changes) for changes in (5, 20, 40, 60, 90, 150)]
    rows += [" ".join([*base[:60], *(f"v{pick.randrange(10**6)}" for _ in range(1400))]) for _ in range(3)]
    # A chain of small steps, and texts that share only a passage.
    chain = [f"c{n}" for n in range(100)]
    for step in range(12):
        chain[step * 2] = f"step{step}"
        rows.append(" ".join(chain))
    rows += [" ".join([*passage, *(f"u{pick.randrange(10**6)}" for _ in range(30))]) for _ in range(20)]
    pick.shuffle(rows)
    rows = list(enumerate(rows))
    found = jaccard_components(docs(*rows), size, percent).collect()
    assert sort(map(tuple, found)) == sort(expected(rows, size, percent))


def test_members_near_some_of_a_large_group_need_few_checks(docs, monkeypatch):
    """In a group in which a member is linked with a part of the others only, and as many are
    just below the threshold, checks grow with the members and not with their pairs."""
    pick = random.Random(4)
    base = [f"w{n}" for n in range(150)]
    rows = [(i, family(pick, base, pick.choice([1, 2, 2, 3]))) for i in range(700)]
    verified = []
    keep = jaccard._verified

    def counted(pairs, *rest):
        verified.append(pairs.count())
        return keep(pairs, *rest)

    monkeypatch.setattr(jaccard, "_verified", counted)
    found = jaccard_components(docs(*rows), 5, 80)
    assert sort(map(tuple, found.collect())) == sort(expected(rows, 5, 80))
    assert sum(verified) < 5 * len(rows)


def test_odd_rows(docs):
    found = jaccard_components(docs(*ODD), 3, 90).collect()
    assert sort(map(tuple, found)) == sort(expected(ODD, 3, 90))
    assert jaccard_components(docs(*ODD).limit(0), 3, 90).count() == 0


def test_one_of_each_keeps_columns_and_one_row(docs):
    text = "one two three four five six seven"
    rows = [(4, text), (2, text), (2, text), (9, "something else altogether that is not linked"), (5, None), (6, ""), (6, "")]
    frame = docs(*rows)
    found = one_of_each(frame)
    assert found.columns == frame.columns
    assert sorted((r["doc_id"], r["text"] or "") for r in found.collect()) == [
        (2, text), (5, ""), (6, ""), (9, rows[3][1])]


def test_one_of_each_looks_at_rows_with_null_or_repeated_ids(docs):
    base = [f"w{n}" for n in range(60)]
    near = " ".join([*base[:59], "other"])
    rows = [(1, " ".join(base)), (None, near), (None, "a clean text without any copy at all"), (7, near),
            (7, "another clean text that has the same id"), (None, None), (None, None), (None, "")]
    # Near copies that all have null ids.
    second = [f"v{n}" for n in range(60)]
    rows += [(None, " ".join(second)), (None, " ".join([*second[:59], "other"]))]
    found = sorted((r["doc_id"] or 0, r["text"] or "") for r in one_of_each(docs(*rows)).collect())
    assert found[:-1] == [(0, ""), (0, ""), (0, rows[2][1]), found[3], (1, rows[0][1])]
    assert found[3][1] in (rows[8][1], rows[9][1]) and found[-1] == (7, rows[4][1])


def test_components_of_paths_and_rings(spark):
    links = [(n, n + 1) for n in range(40)] + [(100 + n, 100 + (n + 1) % 7) for n in range(7)] + [(5, 5)]
    found = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert found == {**{n: 0 for n in range(41)}, **{100 + n: 100 for n in range(7)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
