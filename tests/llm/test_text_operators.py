"""Quality rules, toxicity, HTML, mixing, language model scores, fixity, and the pipeline,
against brute force, SQL and cases written out."""

import math
import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import ODD
from wordloom.llm import fixity, grammar, queries
from wordloom.llm.grammar import HIT, NEGATION, OTHER, REPORT, TARGET, clause_grammar
from wordloom.llm.html_pages import extract_pages, main_text, read_page
from wordloom.llm.mixing import rake, sample_mix
from wordloom.llm.ngram_scores import backoff_scores
from wordloom.llm.packing import Capacity
from wordloom.llm.quality import clean_lines
from wordloom.llm.toxicity import Model, Scanner, remove_toxic, score_toxicity, train


@pytest.fixture(scope="module")
def database(sample):
    connection = duckdb.connect()
    for name in ("documents", "pages", "embeddings", "benchmark"):
        connection.execute(f"create view {name} as select * from '{sample}/{name}.parquet'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(queries.check_sql()))
def test_query_equals_sql(spark, sample, database, name):
    frame = queries.registered()[name](spark, sample)
    columns = sorted(frame.columns)
    found = database.execute(queries.check_sql()[name])
    names = [c[0] for c in found.description]
    wanted = sorted((tuple(r[names.index(c)] for c in columns) for r in found.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr) == wanted


# Quality


def test_quality_of_odd_rows(docs):
    rows = {}
    for row in clean_lines(docs(*ODD)).collect():
        rows[row["doc_id"], row["text"]] = row["quality"]
    assert len(rows) == 7
    for (_, text), found in rows.items():
        words = (text or "").split()
        windows = Counter(zip(words, words[1:], words[2:]))
        covered = {p + k for p in range(len(words) - 2) for k in range(3) if windows[tuple(words[p : p + 3])] > 1}
        assert (found["n_words"], found["n_repeat_words"]) == (len(words), len(covered))
        assert found["base_failed"] and not found["kept"]
    assert clean_lines(docs(*ODD).limit(0)).count() == 0


def test_failing_lines_go_and_documents_that_lose_too_much(docs):
    prose = " ".join(f"word{n}" for n in range(80)) + "."
    mostly = "\n".join([prose, "Home", "All rights reserved.", "| a | b | c |"])
    little = "\n".join(["| a12345 | b12345 |" * 20, " ".join(f"x{n}" for n in range(40)) + "."])
    rows = {r["doc_id"]: r["quality"] for r in clean_lines(docs((1, mostly), (2, little))).collect()}
    assert rows[1]["kept"] and rows[1]["cleaned"] == prose
    assert not rows[2]["kept"]


def test_quality_runs_no_python(docs):
    plan = clean_lines(docs(*ODD))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# Toxicity


def factor(*symbols):
    state, machine, last = 0, clause_grammar().steps, 1.0
    for symbol in symbols:
        state, _, last = machine[state, symbol]
    return last


def test_composed_transducers():
    assert factor(HIT) == 1.0
    assert factor(NEGATION, OTHER, HIT) == pytest.approx(0.4)
    assert factor(NEGATION, OTHER, OTHER, OTHER, HIT) == 1.0
    assert factor(REPORT, OTHER, HIT) == pytest.approx(0.6)
    assert factor(TARGET, OTHER, HIT) == pytest.approx(1.5)
    assert factor(REPORT, TARGET, NEGATION, HIT) == pytest.approx(0.4 * 0.6 * 1.5)


def test_the_composition_equals_the_machines_one_after_the_other():
    machines = [
        grammar.threats(2.0),
        grammar.insults(1.5),
        grammar._window(NEGATION, 3, 0.4),
        grammar._rest((REPORT,), 0.6),
        grammar._rest((TARGET, grammar.AFTER, grammar.PATTERN), 1.5),
    ]
    pick = random.Random(11)
    for _ in range(400):
        state, states = 0, [0] * len(machines)
        for symbol in pick.choices(grammar.SYMBOLS, k=pick.randint(1, 25)):
            state, passed, factor_ = clause_grammar().steps[state, symbol]
            weight = 1.0
            for n, machine in enumerate(machines):
                states[n], symbol, more = machine.steps[states[n], symbol]
                weight *= more
            assert passed == symbol and factor_ == pytest.approx(weight)


def test_ordinary_sentences_have_no_pattern():
    scanner = Scanner({}, 0.0)
    for text in (
        "Sie werden die Tür öffnen", "Ihr werdet die Antwort finden", "du wirst die Rechnung bezahlen",
        "vous allez payer le billet", "tu vas trouver la réponse", "ils sont à la maison",
        "vas a pagar la cuenta", "ellos van a comer", "you will find the answer", "they are at home",
    ):
        assert scanner.clauses(text) == [], text


def test_clauses_and_scores_of_odd_rows(docs):
    model = Model({"fool": 3.0, "fool-": 2.0, "foolproof": -1.0}, (-3.0, 2.0, 1.0, 0.0))
    rows = [*ODD, (8, "All is well. You are a fool! Fine"), (9, "a foolproof plan, not foolish")]
    found = {(r["doc_id"], r["n"]): r for r in score_toxicity(docs(*rows), model).withColumn("n", F.size("clauses")).collect()}
    assert found[8, 1]["predicted"] == 1
    clause = found[8, 1]["clauses"][0]
    assert (clause["begin"], clause["end"], clause["weight"]) == (13, 27, pytest.approx(4.5))
    assert found[9, 1]["clauses"][0]["weight"] == pytest.approx(2.0 * 0.4)
    assert found[1, 0]["score"] == pytest.approx(1 / (1 + math.exp(3)))
    kept = remove_toxic(docs(*rows), model)
    assert kept.columns == docs(*rows).columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 3, 5, 5, 6, 7, 9]
    assert score_toxicity(docs(*ODD).limit(0), model).count() == 0


def test_insults_and_threats_are_patterns_of_clauses():
    def weight(text, lone=1.0):
        return sum(w for _, _, w in Scanner({"fool": 3.0, "fool-": 2.0}, lone).clauses(text))

    # Words that are harmless alone.
    for text in ("You will pay for this", "I will make you suffer", "We are going to find you",
                 "They are a waste of space", "you're nothing", "Trash is what you are",
                 "Ihr seid wertlos", "tu vas le regretter", "vas a morir, tú vas a sufrir"):
        assert weight(text) > 0 and weight(text, lone=0.0) > 0, text
    for text in ("Will the firm pay", "a waste of space", "We will find a way", "You pay", "nothing will do"):
        assert weight(text) == 0, text
    # A target after the hit counts as one before it.
    assert weight("fools, all of you") == weight("you fools") == pytest.approx(3.0)
    assert weight("fools, all of you", lone=0.0) == pytest.approx(3.0)
    assert weight("those plain fools of yours") == pytest.approx(3.0)
    assert weight("a fool") == 3.0 and weight("a fool", lone=0.0) == 0
    assert weight("kill") == 1.0 and weight("kill you") == pytest.approx(2.0)
    assert weight("he said fools, all of you") == pytest.approx(0.6 * 1.5 * 2.0)
    assert weight("You are not worthless") == pytest.approx(0.4 * 1.5 * 2.0)
    assert weight("a fool. You are well") == 3.0


def test_training_finds_words_and_stems(spark, docs):
    pick = random.Random(5)
    texts, labels = [], []
    for n in range(600):
        words = [f"w{pick.randrange(400)}x" for _ in range(60)]
        toxic = n % 8 == 0
        if toxic:
            words[pick.randrange(60)] = pick.choice(["nasty", f"blegh{pick.choice('abcdefgh')}er"])
        texts.append((n, " ".join(words)))
        labels.append((n, int(toxic)))
    table = spark.createDataFrame(labels + [(None, 1), (10**6, None)], "doc_id long, toxic int")
    model = train(docs(*texts), table.filter("doc_id is null or doc_id % 3 > 0"))
    found = {r["doc_id"]: r["predicted"] for r in score_toxicity(docs(*texts), model).collect()}
    assert all(found[n] == label for n, label in labels if n % 3 == 0)
    none = train(docs(*texts), table.limit(0))
    assert none.lexicon == {} and score_toxicity(docs(*ODD), none).filter("predicted = 1").count() == 0


# HTML

PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style><script>x="</p>"</script></head><body class="page12">
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav><div class="ad">Buy</div>
<div id="cookie-notice">Cookies</div><div class="sidebar-left">Side</div>
<article class="post-77"><header><h1>A &amp; B</h1></header><p>One <b>two</b>&nbsp;&nbsp;three<br>four<p>Five &lt;six&gt;
<form><input name=q> Search</form><ul><li>item 1<li>item 2</ul><table><tr><td>c1</td><td>c2</td></tr></table>
<section class="comments"><p>I disagree</p></section><div class="share">Share</div></article>
<footer>&copy; all</footer><!-- no --></body>"""


def test_page_written_out():
    wanted = "A & B\nOne two three four\nFive <six>\nitem 1\nitem 2\nc1\nc2"
    assert main_text(read_page(PAGE), []) == wanted
    plain = '<div class="story"><p>Long running text of the story here.</p><p>More of it.</p></div><div class="menu">x</div>'
    assert main_text(read_page(plain), []) == "Long running text of the story here.\nMore of it."
    assert main_text(read_page("bare text &am"), []) == "bare text &am"
    for broken in ("", "<", "<p", "<p>a<", "</p></div>", "<div", "<script>never closed", "<!-- open", "<a href='x>y"):
        main_text(read_page(broken), [])
    for end in range(0, len(PAGE), 7):
        main_text(read_page(PAGE[:end]), [])


def test_pages_of_a_host_agree(spark):
    body = "<div class='x{0}'><p>{1}</p></div><div class='box'><p>{2}</p></div>"
    rows = [(n, f"http://a.org/{n}", body.format(n, "the story goes on and on " * 5, "short")) for n in range(6)]
    # A page whose box is longer than its story still follows its host.
    rows += [(9, "http://a.org/9", body.format(9, "brief story", "a very long text in the box " * 9))]
    rows += [(10, None, None), (11, "", ""), (11, "", ""), (12, "http://b.org", "<p>x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as winners")
    found = {r["page_id"]: r for r in extract_pages(frame).collect()}
    assert found[9]["text"] == "brief story" and found[9]["n_chars"] == 11
    assert found[0]["text"].startswith("the story") and "short" not in found[0]["text"]
    assert found[10]["text"] == "" and found[11]["text"] == "" and found[12]["text"] == "x"
    assert extract_pages(frame).count() == len(rows) and extract_pages(frame.limit(0)).count() == 0


def test_no_part_of_an_article_is_lost(spark):
    story = "the story goes on and on " * 20
    # Pages of template B have the path of template A as a teaser.
    one, two = "<div class='a'><p>{}</p></div>", "<div class='a'><p>teaser</p></div><section class='b'><p>{}</p></section>"
    rows = [(n, f"http://a.org/{n}", (one if n < 6 else two).format(f"{n} {story}")) for n in range(10)]
    parts = "<div class=page><div class=lead><p>{}</p></div><div class=body><p>{}</p></div><div class=x>no</div></div>"
    rows += [(20 + n, f"http://c.org/{n}", parts.format(f"lead {n} " * 30, story * 2)) for n in range(4)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in extract_pages(frame).collect()}
    for n in range(10):
        assert found[n] == f"{n} {story}".strip()
    for n in range(4):
        assert found[20 + n] == f"{f'lead {n} ' * 30}".strip() + "\n" + (story * 2).strip()
    # A short lead, and a heading and a paragraph without a container, with a notice beside.
    short = (
        "<div class=page><h1>Title {0}</h1><p>By author {0}</p><div class=lead>The lead of page {0}</div>"
        "<div class=body><p>{1} {0}</p></div><div class=note>Our site is under repair.</div></div>"
    )
    rows = [(n, f"http://d.org/{n}", short.format(n, story * 3)) for n in range(12)]
    rows += rows[:1] * 20  # copies of a page are no evidence of a notice
    rows += [(50, "http://e.org/1", short.format(50, story))]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in extract_pages(frame).collect()}
    for n in range(12):
        assert found[n] == f"Title {n}\nBy author {n}\nThe lead of page {n}\n{(story * 3).strip()} {n}"
    assert found[50].startswith("Title 50\nBy author 50\nThe lead of page 50\n")
    named = (
        "<article><div class='entry-header'><p>Heading</p></div><h2 id='related-work'>Related work</h2>"
        "<h3 id='login'>Login</h3><p>Text of it.</p><div class='related-posts'><a href=/>Another one</a></div>"
        "<div class='related'>More</div></article>"
    )
    assert main_text(read_page(named), []) == "Heading\nRelated work\nLogin\nText of it."


def written_page(pick, kind, n):
    """A page of one of three layouts, and the text of its article."""
    words = lambda k: " ".join(f"w{pick.randrange(5000)}" for _ in range(k))
    paragraphs = [words(pick.randint(3, 60)) for _ in range(pick.randint(1, 9))]
    title, lead = f"Title {n} {words(3)}", words(pick.randint(2, 12))
    filled = "".join(f"<p>{p.replace(' ', pick.choice([' ', chr(10), '  ']))}" for p in paragraphs)
    menu = "<nav><ul>" + "".join(f"<li><a href=/{k}>{words(1)}</a>" for k in range(6)) + "</ul></nav>"
    advert, comment = f"<div class='ad'>{words(9)}</div>", f"<div class=comments><p>{words(30)}</p></div>"
    notice = "<div class=strip>This site is read by many people.</div>"
    parts = {
        0: f"<article><h1>{title}</h1><p>{lead}</p>{filled}{advert}</article>{comment}",
        1: f"<div class=page><h1>{title}</h1><div class=lead>{lead}</div>"
        f"<div class='body n{n}'>{filled}</div>{notice}{comment}</div>",
        2: f"<main><header><h1>{title}</h1></header><p>{lead}</p><form><p>Search</form>{filled}</main>",
    }
    html = f"<html><head><title>x</title></head><body>{menu}{advert}{parts[kind]}<footer>© n</footer></body>"
    return html, "\n".join([title, lead, *paragraphs])


def test_extraction_equals_what_pages_were_written_from(spark):
    pick = random.Random(8)
    rows, wanted = [], {}
    for n in range(90):
        html, wanted[n] = written_page(pick, n % 3, n)
        rows.append((n, f"http://host{n % 3}.org/{n}", html))
    long_ = "word " * 400_000
    rows.append((500, "http://long.org/", f"<article><p>{long_}</p></article>"))
    wanted[500] = long_.strip()
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in extract_pages(frame).collect()}
    assert found == wanted


# Mixing


def test_raked_margins_meet_their_targets(spark):
    pick = random.Random(2)
    cells = [(f"s{a}", b, pick.randint(1, 500)) for a in range(5) for b in (None, "en", "de")]
    frame = spark.createDataFrame(cells, "source string, lang string, tokens long")
    one = {f"s{a}": a + 1 for a in range(5)}
    two = {None: 1.0, "en": 2.0, "de": 3.0}
    targets = {
        "source": spark.createDataFrame(
            [(k, float(v)) for k, v in one.items()] + [("absent", 4.0)], "value string, target double"
        ),
        "lang": spark.createDataFrame(list(two.items()), "value string, target double"),
    }
    rows = rake(frame, targets, rounds=12).collect()
    for column, wanted in (("source", one), ("lang", two)):
        sums = Counter()
        for row in rows:
            sums[row[column]] += row["fitted"]
        for value, target in wanted.items():
            assert sums[value] == pytest.approx(target / sum(wanted.values()), abs=1e-4)


def test_sampling_of_odd_rows(docs):
    frame = docs(*ODD)
    mixed = sample_mix(frame, {"source": 1.0, "lang": 0.5}, queries.words_in(), share=1.0, rounds=2)
    rows = mixed.collect()
    assert mixed.columns == [*frame.columns, "mixing"] and len(rows) == len(ODD)
    for row in rows:
        assert row["mixing"]["sampled"] == (row["mixing"]["tokens"] > 0)
    assert sample_mix(frame.limit(0), {"source": 1.0}, queries.words_in()).count() == 0


# Language model


@pytest.mark.parametrize("order", [1, 2, 3])
def test_backoff_scores_equal_brute_force(docs, order):
    pick = random.Random(order)
    texts = [(n, " ".join(pick.choices("abcdefg", k=pick.randint(0, 30)))) for n in range(60)] + ODD
    texts += [(77, "a b c a b")] * 40 + [(None, "c d e")] * 40  # dealt over blocks all the same
    found = backoff_scores(docs(*texts), order, block_chars=400, part_words=50).collect()
    words = [(i, (t or "").lower().split()) for i, t in texts]
    counts = [Counter() for _ in range(order + 1)]
    for _, w in words:
        for size in range(1, order + 1):
            counts[size].update(zip(*(w[k:] for k in range(size))))
    total = sum(counts[1].values())
    wanted = []
    for i, w in words:
        own = [Counter(zip(*(w[k:] for k in range(size)))) if size else None for size in range(order + 1)]
        others = lambda g: counts[len(g)][g] - own[len(g)][g]
        score, backed = 0.0, 0
        for p in range(len(w)):
            size, penalty = min(order, p + 1), 0.0
            reached = size
            while size > 1 and others(tuple(w[p - size + 1 : p + 1])) == 0:
                size, penalty = size - 1, penalty + math.log(0.4)
            gram = tuple(w[p - size + 1 : p + 1])
            if size == 1:
                score += penalty + math.log(max(others(gram), 0.5) / max(total - len(w), 1))
            else:
                score += penalty + math.log(others(gram) / max(others(gram[:-1]), others(gram)))
            backed += size < reached
        wanted.append((i, len(w), round(score, 6), backed))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r[0], r[1], round(r[2], 6), r[4]) for r in found), key=key) == sorted(wanted, key=key)
    assert backoff_scores(docs(*ODD).limit(0)).count() == 0


def test_registered_scores_tell_shuffled_words(spark, tmp_path):
    texts = [(1, "a b c"), (2, "a b c"), (3, "x b d"), (4, "x b d"), (5, "a b d")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.lm_scoring(spark, str(tmp_path)).collect()
    # Both bigrams of the last text are known, its trigram is not.
    assert {r["doc_id"]: r["n_backed_off"] for r in found} == {1: 0, 2: 0, 3: 0, 4: 0, 5: 1}


# Fixity


def test_archives_on_disk(spark, tmp_path):
    rows = [(n, f"http://h/{n}", f"<p>{n}é</p>" * (n % 5 + 1)) for n in range(50)] + [(7, None, None), (None, "u", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as file", "2 as node")
    places = fixity.lay_out(pages, ids_per_file=20)
    fixity.write_warc(pages, str(tmp_path / "a"), ids_per_file=20)
    read = fixity.read_digests(spark, str(tmp_path / "a"), places)
    assert fixity.audit(places, read).count() == 0
    damaged = read.filter("not (file = 1 and offset = 0)").withColumn(
        "digest", F.when(F.col("file") == 2, F.reverse("digest")).otherwise(F.col("digest")))
    found = fixity.audit(places, damaged).collect()
    assert sorted({(r["file"], r["status"]) for r in found}) == [(1, "missing"), (2, "changed")]
    assert len(found) == 11
    assert fixity.audit(fixity.lay_out(pages.limit(0)), read.limit(0)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_damage_at_random_places_is_found_exactly(spark, seed):
    pick = random.Random(seed)
    rows = [(n, "u", "x" * pick.randint(0, 30)) for n in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    places = fixity.stored(fixity.lay_out(pages, ids_per_file=30))
    held = [(r["file"], r["offset"], r["digest"]) for r in places.collect()]
    lost, changed = set(pick.sample(range(400), 7)), set(pick.sample(range(400), 9))
    copy = [
        (file, offset, f"{digest[1:]}0" if n in changed else digest)
        for n, (file, offset, digest) in enumerate(held)
        if n not in lost
    ]
    replica = spark.createDataFrame(copy, places.select("file", "offset", "digest").schema)
    found = {(r["file"], r["offset"]): r["status"] for r in fixity.audit(places, replica, fan_out=4).collect()}
    wanted = {held[n][:2]: "changed" for n in changed - lost} | {held[n][:2]: "missing" for n in lost}
    assert found == wanted


def test_audit_of_null_and_repeated_ids_and_of_extra_records(spark, tmp_path):
    rows = [(n, "u", f"<p>{n}") for n in range(1, 9)] + [(3, "u", "<p>again"), (None, "u", "x"), (None, "u", "y"), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    found = queries.warc_fixity(spark, str(tmp_path)).collect()
    assert sorted((r["page_id"], r["status"]) for r in found) == [(5, "changed"), (6, "missing")]
    places = fixity.lay_out(pages, ids_per_file=2)
    files = {r["file"]: r["count"] for r in places.filter("page_id is null").groupBy("file").count().collect()}
    assert sum(files.values()) == 3 and set(files) <= {fixity.NO_ID, fixity.NO_ID + 1}
    copy = places.select("file", "offset", "digest")
    more = [(0, 10**6, "a"), (99, 0, "b"), (1, 0, "0")]
    extra = spark.createDataFrame(more, copy.schema)
    found = fixity.audit(places, copy.unionByName(extra)).collect()
    assert sorted((r["file"], r["offset"], r["found"]) for r in found) == sorted(more)
    assert {r["status"] for r in found} == {"extra"}


# Pipeline


def test_pipeline_stages(spark, sample):
    documents = spark.read.parquet(f"{sample}/documents.parquet")
    docs, ids = documents, {r["doc_id"] for r in documents.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, docs, sample).collect()
        docs = spark.createDataFrame(rows, documents.schema)
        left = {r["doc_id"] for r in rows}
        assert docs.columns == documents.columns and left <= ids and left, name
        ids = left
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sample).collect()
    assert {r["doc_id"] for r in packed} == ids
    filled = Counter()
    for row in packed:
        filled[row["sequence_id"]] += row["length"]
    assert max(filled.values()) <= Capacity(2048).tokens
    assert corpus_pipeline.run(spark, sample).columns == list(packed[0].asDict())
