import pytest
from pyspark.sql import functions as F

from wordloom import functions as W


def one(spark, text, function):
    return spark.createDataFrame([(text,)], "text string").select(function("text")).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("'Twas a don't x_y--B2", ["'twas", "a", "don't", "x_y", "b2"]),
        ("(leading, trailing) ", ["leading", "trailing"]),
        ("süß", ["s"]),
        ("...", []),
        ("", []),
    ],
)
def test_word_tokens(spark, text, expected):
    assert one(spark, text, W.word_tokens) == expected


def test_word_tokens_with_case(spark):
    assert one(spark, "Ab aB", lambda c: W.word_tokens(c, case_sensitive=True)) == ["Ab", "aB"]


def test_letter_tokens(spark):
    assert one(spark, "Don't a1b", W.letter_tokens) == ["don", "t", "a", "b"]


def test_alnum_tokens(spark):
    assert one(spark, "A1-b_c", W.alnum_tokens) == ["a1", "b", "c"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("a\nb", ["a", "b"]),
        ("a\r\nb\rc\n", ["a", "b", "c"]),
        ("a\n\nb\r\n", ["a", "", "b"]),
        ("a\n\r", ["a", ""]),
        ("\n", [""]),
        ("a", ["a"]),
    ],
)
def test_lines_of(spark, text, expected):
    assert one(spark, text, W.lines_of) == expected


@pytest.mark.parametrize(
    "path, expected",
    [
        ("x/a.b.txt", "a.b"),
        (".x", ".x"),
        ("d/.x", ".x"),
        ("plain", "plain"),
        ("a.", "a"),
        ("..x", "."),
        ("v1.2/plain", "plain"),
    ],
)
def test_document_id(spark, path, expected):
    assert one(spark, path, W.document_id) == expected


def test_trim_control(spark):
    assert one(spark, "\t\x00 a b \x1f\n", W.trim_control) == "a b"
    assert one(spark, " a", W.trim_control) == " a"


# Word and stem pairs of the published paper, and some edge cases.
STEMS = """
category categori  this thi  history histori  day dai  july juli  caresses caress
ponies poni  ties ti  caress caress  cats cat  feed feed  agreed agre
plastered plaster  bled bled  motoring motor  sing sing  conflated conflat
troubled troubl  sized size  hopping hop  tanned tan  falling fall  hissing hiss
fizzed fizz  failing fail  filing file  happy happi  sky sky  relational relat
conditional condit  rational ration  valenci valenc  hesitanci hesit  digitizer digit
conformabli conform  radicalli radic  differentli differ  vileli vile
analogousli analog  vietnamization vietnam  predication predic  operator oper
feudalism feudal  decisiveness decis  hopefulness hope  callousness callous
formaliti formal  sensitiviti sensit  sensibiliti sensibl  triplicate triplic
formative form  formalize formal  electriciti electr  electrical electr  hopeful hope
goodness good  revival reviv  allowance allow  inference infer  airliner airlin
gyroscopic gyroscop  adjustable adjust  defensible defens  irritant irrit
replacement replac  adjustment adjust  dependent depend  adoption adopt
homologou homolog  communism commun  activate activ  angulariti angular
homologous homolog  effective effect  bowdlerize bowdler  probate probat  rate rate
cease ceas  controll control  roll roll  archaeology archaeolog  national nation
yboll yboll  yed yed  sayyd sayyd  s s  is is  ies i  ing ing  eed eed
""".split()


@pytest.mark.parametrize("word, stem", list(zip(STEMS[::2], STEMS[1::2])))
def test_porter_stem(word, stem):
    assert W.porter_stem(word) == stem


def test_stem_columns(spark):
    rows = spark.createDataFrame(
        [(["cats", "running", "cat"],), ([],), (None,), (["ponies"],)], "tokens array<string>"
    )
    counts = rows.coalesce(1).select(W.stem_counts("tokens").alias("found"))
    found = [sorted((e.term, e.tf) for e in row.found) for row in counts.collect()]
    assert found == [[("cat", 2), ("run", 1)], [], [], [("poni", 1)]]
    empty = rows.filter("size(tokens) = 0").select(W.stem_counts("tokens").alias("found"))
    assert [row.found for row in empty.collect()] == [[]]
    single = rows.select(F.explode("tokens").alias("token")).select(W.stem_token("token"))
    assert sorted(r[0] for r in single.collect()) == ["cat", "cat", "poni", "run"]


def test_renderings(spark):
    row = spark.sql("select 'a' w, 'b' c, map('b', 2L, 'a', 1L) m, 0.1234567d s")
    pair, stripe, score = row.select(
        W.pair_text("w", "c"), W.stripe_text("m"), W.score_text("s")
    ).first()
    assert (pair, stripe, score) == ("{a,b}", "{a=1, b=2}", "0.123457")
    assert spark.sql("select map() m").select(
        W.stripe_text(F.col("m").cast("map<string,bigint>"))
    ).first()[0] == "{}"


def test_lists_of_tokens_are_counted_in_slices(monkeypatch):
    import pyarrow as pa

    from wordloom.functions import stemming

    rows = [["cats", "cat"], None, [], ["a"] * 7, ["dog"], ["dogs", "dog", "x"]]
    monkeypatch.setattr(stemming, "SLICE_TOKENS", 4)
    found = list(stemming._sliced_counts(iter([pa.array(rows), pa.array(rows[:0], pa.list_(pa.string()))])))
    # Whole rows of at most four tokens; a longer row is alone.
    assert [len(x) for x in found] == [3, 1, 2]
    counts = [[(e["term"], e["tf"]) for e in row] for x in found for row in x.to_pylist()]
    assert counts == [[("cat", 2)], [], [], [("a", 7)], [("dog", 1)], [("dog", 2), ("x", 1)]]
