"""Line-first cleaning: lines are judged one by one, then the document by what is lost.

Everything is built-in SQL functions on the row: no shuffle, no Python. ``_bind`` gives an
array a name inside an expression, so that it is computed once and then read by position.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import free_names

BLANKS = " \t\n\x0b\f\r"
_WORD = r"[^\x20\x09-\x0D]"
_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class LineRules:
    """The limits of the line rules and of the verdict.

    A line fails if more than ``symbol_percent`` of its characters (without blanks) are
    symbols or separators; if it is longer than ``unpunctuated_chars`` and has no
    punctuation; if it is longer than ``capital_chars`` and all its letters are capitals;
    if it is a navigation line or has a boilerplate phrase and is no longer than
    ``short_chars``. A document is rejected if failing lines hold more than
    ``lost_percent`` of the characters of its words.
    """

    separators: str = SYMBOLS + "»›•·"
    symbol_percent: int = 5
    unpunctuated_chars: int = 400
    capital_chars: int = 20
    short_chars: int = 200
    navigation: str = (
        r"^\W*(home|menu|log ?in|sign (in|up)|search|next|previous|back to top|"
        r"skip to content|read more|share this|contact( us)?|about us|site ?map|"
        r"accueil|connexion|rechercher|suivant|précédent|haut de page|lire la suite|"
        r"partager|contactez-nous|plan du site|startseite|anmelden|suche|weiter|zurück|"
        r"nach oben|weiterlesen|teilen|kontakt|impressum|inicio|iniciar sesión|buscar|"
        r"siguiente|anterior|volver arriba|leer más|compartir|contacto|mapa del sitio)\W*$"
    )
    boilerplate: str = (
        r"all rights reserved|terms of (use|service)|privacy policy|cookie policy|"
        r"(use|accept)s? cookies|enable javascript|licensed under the|"
        r"copyright (©|\(c\)|[0-9]{4})|tous droits réservés|conditions d.utilisation|"
        r"politique de confidentialité|utilise des cookies|alle rechte vorbehalten|"
        r"nutzungsbedingungen|datenschutzerklärung|verwendet cookies|"
        r"todos los derechos reservados|términos (de uso|y condiciones)|"
        r"política de (privacidad|cookies)|utiliza cookies"
    )
    lost_percent: int = 50


def _bind(value: Column, use) -> Column:
    return F.transform(F.array(value), use)[0]


def _fails(line: Column, rules: LineRules) -> Column:
    """The cheap tests come first, and what is left undecided is looked at more closely."""
    chars = F.char_length(line)
    size = F.char_length(F.translate(line, BLANKS, ""))
    signs = chars - F.char_length(F.translate(line, rules.separators, ""))
    phrase = F.lower(line).rlike(f"{rules.navigation}|{rules.boilerplate}")
    return (
        ((signs > 0) & (signs * 100 > size * rules.symbol_percent))
        | ((chars > rules.unpunctuated_chars) & ~line.rlike(r"\p{P}") & (size > rules.unpunctuated_chars))
        | (
            (chars > rules.capital_chars)
            & ~line.rlike(r"\p{Ll}")
            & line.rlike(r"\p{Lu}")
            & (size > rules.capital_chars)
        )
        | ((chars <= rules.short_chars) & phrase)
    )


def _repeated_words(windows: Column) -> Column:
    """Words covered by windows that occur twice or more; ``windows`` holds a hash for
    every position a window of three words begins at."""

    def repeated(pairs: Column) -> Column:
        near = lambda i: F.get(pairs, i)["hash"]
        return F.filter(
            pairs,
            lambda x, i: x["hash"].eqNullSafe(near(i + 1)) | x["hash"].eqNullSafe(near(i - 1)),
        )

    def covered(places: Column) -> Column:
        steps = F.transform(
            places, lambda p, i: F.coalesce(F.least(F.get(places, i + 1) - p, F.lit(3)), F.lit(3))
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, n: total + n)

    pairs = F.sort_array(
        F.transform(windows, lambda h, i: F.struct(h.alias("hash"), i.alias("place")))
    )
    places = F.sort_array(F.transform(_bind(pairs, repeated), lambda x: x["place"]))
    return F.when(
        F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")
    ).otherwise(_bind(places, covered))


def clean_lines(
    documents: DataFrame,
    rules: LineRules | None = None,
    min_words: int = 50,
    repeat_percent: int = 50,
    text_column: str = "text",
) -> DataFrame:
    """All rows and columns of ``documents`` and the struct ``quality`` after them.

    Its fields: ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of the
    whole text, ``lost_chars`` (characters of words in failing lines), ``base_failed`` (too
    few words or too many repeated ones), ``kept``, and ``cleaned``, the text without its
    failing lines. A column named ``quality`` is replaced; others may have any names.

    A null text counts as an empty one: no words, so the base rule rejects it. Windows of
    one text are compared by 64-bit hashes. The work grows with n log n words of
    a text, a row is never split.
    """
    rules = rules or LineRules()
    # Names that the caller's columns do not have.
    text, words, lines, windows, judged, repeated = free_names(
        documents.columns, "text", "words", "lines", "windows", "judged", "repeated"
    )
    rows = documents.withColumn(text, F.coalesce(F.col(f"`{text_column}`"), F.lit("")))
    inner = F.btrim(F.col(text), F.lit(BLANKS))
    none = F.array().cast("array<string>")
    rows = rows.withColumns(
        {
            words: F.when(inner == "", none).otherwise(F.split(inner, _BREAK)),
            lines: F.split(text, "\n"),
        }
    )
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    windows_of = lambda a: F.transform(
        F.slice(a, F.lit(1), F.greatest(F.size(a) - 2, F.lit(0))),
        lambda h, i: F.xxhash64(h, F.get(a, i + 1), F.get(a, i + 2)),
    )
    rows = rows.withColumns(
        {
            windows: _bind(hashes, windows_of),
            # Lines are judged once, whether they are counted or kept or both.
            judged: F.transform(lines, lambda x: F.struct(x.alias("line"), _fails(x, rules).alias("fails"))),
        }
    )
    rows = rows.withColumn(repeated, _repeated_words(F.col(windows)))
    # A line without a word is blank; blank lines are no copies of each other.
    exact = F.filter(lines, lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    failing = F.filter(judged, lambda x: x["fails"])["line"]
    passing = F.filter(judged, lambda x: ~x["fails"])["line"]
    n_words = F.size(words)
    word_chars = F.char_length(F.array_join(words, ""))
    lost = F.char_length(F.translate(F.array_join(failing, ""), BLANKS, ""))
    base_failed = (n_words < min_words) | (F.col(repeated) * 100 > n_words * repeat_percent)
    too_much = lost * 100 > word_chars * rules.lost_percent
    quality = F.struct(
        n_words.cast("long").alias("n_words"),
        word_chars.cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        (F.size(exact) - F.size(F.array_distinct(exact))).cast("long").alias("n_dup_lines"),
        F.col(repeated).cast("long").alias("n_repeat_words"),
        lost.cast("long").alias("lost_chars"),
        base_failed.alias("base_failed"),
        (~base_failed & ~too_much).alias("kept"),
        F.array_join(passing, "\n").alias("cleaned"),
    )
    columns = [F.col(f"`{c}`") for c in documents.columns if c != "quality"]
    # Unfolded from an array of one, so that a filter on it does not compute it again.
    return rows.select(*columns, F.explode(F.array(quality)).alias("quality"))


CHECK_SQL = r"""
with texts as (select doc_id, coalesce(text, '') as text from documents),
words as (select doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w from texts),
lines as (
  select doc_id, line, regexp_replace(line, '[\x20\x09-\x0D]', '', 'g') as solid
  from (select doc_id, unnest(string_split(text, chr(10))) as line from texts)),
by_line as (
  select doc_id, count(*) - count(distinct line) as n_dup_lines from lines
  where solid <> '' group by doc_id),
lost as (
  select doc_id, sum(length(solid)) as lost_chars from lines
  where 100 * length(regexp_replace(solid, '[^#*$%&|<>»›•·]', '', 'g')) > 5 * length(solid)
    or (length(solid) > 400 and not regexp_matches(line, '\p{P}'))
    or (length(solid) > 20 and regexp_matches(line, '\p{Lu}') and not regexp_matches(line, '\p{Ll}'))
    or (length(line) <= 200 and regexp_matches(lower(line), '^\W*(home|menu|log ?in|sign (in|up)|search|next|previous|back to top|skip to content|read more|share this|contact( us)?|about us|site ?map|accueil|connexion|rechercher|suivant|précédent|haut de page|lire la suite|partager|contactez-nous|plan du site|startseite|anmelden|suche|weiter|zurück|nach oben|weiterlesen|teilen|kontakt|impressum|inicio|iniciar sesión|buscar|siguiente|anterior|volver arriba|leer más|compartir|contacto|mapa del sitio)\W*$'))
    or (length(line) <= 200 and regexp_matches(lower(line), 'all rights reserved|terms of (use|service)|privacy policy|cookie policy|(use|accept)s? cookies|enable javascript|licensed under the|copyright (©|\(c\)|[0-9]{4})|tous droits réservés|conditions d.utilisation|politique de confidentialité|utilise des cookies|alle rechte vorbehalten|nutzungsbedingungen|datenschutzerklärung|verwendet cookies|todos los derechos reservados|términos (de uso|y condiciones)|política de (privacidad|cookies)|utiliza cookies'))
  group by doc_id),
positions as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as p from words),
windows as (
  select doc_id, p, word || ' ' || lead(word) over one || ' ' || lead(word, 2) over one as g
  from positions window one as (partition by doc_id order by p)),
repeated as (
  select doc_id, g from windows where g is not null group by doc_id, g having count(*) > 1),
covered as (
  select doc_id, p + k as p from windows join repeated using (doc_id, g), (values (0), (1), (2)) as t(k)
  group by all),
by_window as (select doc_id, count(*) as n_repeat_words from covered group by doc_id),
facts as (
  select doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
    coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
    coalesce(lost_chars, 0) as lost_chars
  from words join texts using (doc_id) left join by_line using (doc_id)
  left join by_window using (doc_id) left join lost using (doc_id)),
judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from facts)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars,
  cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
  cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
  not base_failed and 100 * lost_chars <= 50 * word_chars as kept
from judged
"""
