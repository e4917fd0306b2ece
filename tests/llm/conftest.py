import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (id, text) pairs, with the columns of the table and others whose
    names operators use themselves."""

    def make(*rows, extra=True):
        frame = spark.createDataFrame(
            [(i, t, "en", "src0", len(t or "")) for i, t in rows], SCHEMA
        )
        if not extra:
            return frame
        return frame.selectExpr(
            "*", "'x' as key", "1 as n", "2 as n_tokens", "3 as score", "null as quality", "4 as block"
        )

    return make


#: Null, empty and blank texts, a null id, a repeated row, and ties.
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (None, "one two three four five six"),
    (5, "one two three four five six"),
    (5, "one two three four five six"),
    (6, "a" * 3000 + " <|endoftext|> end's 'll été\n\n中文 🎉"),
    (7, "word " * 2500),
]
