"""SQL for DuckDB that computes every registered query in another way.

Tokens are found with the complementary pattern, co-occurrence is a self join on
positions, and stemming is a row of regular-expression steps. The stop list is the
engine's own.
"""

from __future__ import annotations

from wordloom.functions.stopwords import STOP_WORDS

_STOP = "(" + ", ".join(f"'{word}'" for word in STOP_WORDS) + ")"

_TOKENS = {
    "word": r"regexp_extract_all(lower({0}), '[\w'']+')",
    "cased": r"regexp_extract_all({0}, '[\w'']+')",
    "letter": r"regexp_extract_all(lower({0}), '[a-z]+')",
    "alnum": r"regexp_extract_all(lower({0}), '[a-z0-9]+')",
}

# The grammar of consonants and vowels in Porter's paper.
_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
_HAS_VOWEL = f"^({_C}[aeiouy]|[aeiou])"  # a leading y is a consonant
_M_ABOVE_0 = f"{_HAS_VOWEL}[aeiou]*{_C}"
_M_IS_1 = f"{_M_ABOVE_0}({_V})?$"
_M_ABOVE_1 = f"{_M_ABOVE_0}{_V}{_C}"
_SHORT_END = f"^{_C}[aeiouy][^aeiouwxy]$"

# The rules of steps 2, 3 and 4 as the paper lists them, with its author's
# later bli and logi; in step 4 "ion" stays unless s or t is before it.
_STEP_2 = (
    "ational ate, tional tion, enci ence, anci ance, izer ize, bli ble, alli al, entli ent, "
    "eli e, ousli ous, ization ize, ation ate, ator ate, alism al, iveness ive, fulness ful, "
    "ousness ous, aliti al, iviti ive, biliti ble, logi log"
)
_STEP_3 = "icate ic, ative, alize al, iciti ic, ical ic, ful, ness"
_STEP_4 = (
    "al, ance, ence, er, ic, able, ible, ant, ement, ment, ent, ion, ou, ism, ate, iti, ous, "
    "ive, ize"
)


def _rules(step: str) -> dict[str, str]:
    return {suffix: new for suffix, _, new in (rule.partition(" ") for rule in step.split(", "))}


def _tokens(kind: str, text: str = "text") -> str:
    return _TOKENS[kind].format(text)


def _is(word: str, pattern: str) -> str:
    return f"regexp_matches({word}, '{pattern}')"


def _cut(word: str, size: int) -> str:
    return f"left({word}, length({word}) - {size})"


def _suffix_step(rules: dict[str, str], condition: str) -> str:
    """The rule of the longest suffix applies or none does."""
    branches = []
    for suffix in sorted(rules, key=len, reverse=True):
        stem = _cut("w", len(suffix))
        test = _is(stem, condition)
        if suffix == "ion":
            test += f" and {_is(stem, '[st]$')}"
        branches.append(
            f"when ends_with(w, '{suffix}') then "
            f"case when {test} then {stem} || '{rules[suffix]}' else w end"
        )
    return "case when length(token) < 3 then w " + " ".join(branches) + " else w end"


def _stem_steps(tokens: str) -> str:
    """CTEs from ``tokens`` (token) to ``stems`` (token, term), one per step."""
    keep = "length(token) < 3 then w"
    ed, ing = _cut("w", 2), _cut("w", 3)
    steps = [
        f"""case when {keep} when ends_with(w, 'sses') or ends_with(w, 'ies') then {_cut('w', 2)}
            when ends_with(w, 'ss') then w when ends_with(w, 's') then {_cut('w', 1)} else w end""",
        # 1b marks what it cut with a # so that the repair knows
        f"""case when {keep}
            when ends_with(w, 'eed') then case when {_is(_cut('w', 3), _M_ABOVE_0)} then {_cut('w', 1)} else w end
            when ends_with(w, 'ed') and {_is(ed, _HAS_VOWEL)} then {ed} || '#'
            when ends_with(w, 'ing') and {_is(ing, _HAS_VOWEL)} then {ing} || '#' else w end""",
        f"""case when not ends_with(w, '#') then w
            when {_is('w', '(at|bl|iz)#$')} then {_cut('w', 1)} || 'e'
            when left(right(w, 3), 1) = left(right(w, 2), 1) and {_is('w', '[^aeiou]#$')}
              then case when {_is('w', '[lsz]#$')} then {_cut('w', 1)} else {_cut('w', 2)} end
            when {_is(_cut('w', 1), _M_IS_1)} and {_is(_cut('w', 1), _SHORT_END)} then {_cut('w', 1)} || 'e'
            else {_cut('w', 1)} end""",
        f"""case when {keep} when ends_with(w, 'y') and {_is(_cut('w', 1), _HAS_VOWEL)}
            then {_cut('w', 1)} || 'i' else w end""",
        _suffix_step(_rules(_STEP_2), _M_ABOVE_0),
        _suffix_step(_rules(_STEP_3), _M_ABOVE_0),
        _suffix_step(_rules(_STEP_4), _M_ABOVE_1),
        f"""case when {keep} when ends_with(w, 'e') and ({_is(_cut('w', 1), _M_ABOVE_1)}
              or ({_is(_cut('w', 1), _M_IS_1)} and not {_is(_cut('w', 1), _SHORT_END)}))
            then {_cut('w', 1)} else w end""",
        f"""case when {keep} when ends_with(w, 'll') and {_is('w', _M_ABOVE_1)}
            then {_cut('w', 1)} else w end""",
    ]
    ctes = [f"step0 as materialized (select token, token as w from {tokens})"]
    for n, step in enumerate(steps, 1):
        ctes.append(f"step{n} as materialized (select token, {step} as w from step{n - 1})")
    ctes.append(f"stems as materialized (select token, w as term from step{len(steps)})")
    return ",\n".join(ctes)


def _word_counts(kind: str = "word", stop: str = _STOP) -> str:
    return f"""select word, count(*) as cnt
from (select unnest({_tokens(kind)}) as word from documents) where word not in {stop} group by word"""


_TOP_50 = f"{_word_counts()} order by cnt desc, word limit 50"

_LANGUAGES = "(select distinct lang from documents)"

_LINES = r"""lines as (
  select doc_id, row_number() over () as line_id, line from (
    select doc_id, unnest(regexp_split_to_array(regexp_replace(text, '(\r\n|\n|\r)$', ''), '\r\n|\n|\r')) as line
    from documents where text <> ''))"""


def _pairs(condition: str | list[str], vocabulary: str = _TOP_50) -> str:
    conditions = [condition] if isinstance(condition, str) else condition
    joins = " union all ".join(
        f"select x.word, y.word as coword from hits x join hits y on x.line_id = y.line_id and {c}"
        for c in conditions
    )
    return f"""with {_LINES},
vocabulary as materialized ({vocabulary}),
tokens as (select line_id, {_tokens('word', 'line')} as t from lines),
positions as (select line_id, unnest(t) as word, generate_subscripts(t, 1) as p from tokens),
hits as materialized (select * from positions where word in (select word from vocabulary)),
pairs as (select word, coword, count(*) as cnt from ({joins}) group by word, coword)
"""


def _exact(d: int) -> list[str]:
    return [f"y.p = x.p + {d}", f"y.p = x.p - {d}"]


def _within(d: int) -> str:
    return f"y.p <> x.p and y.p between x.p - {d} and x.p + {d}"


def _terms(stop: str = _STOP) -> str:
    return f"""with tokens as materialized (
  select doc_id, token, count(*) as n
  from (select doc_id, unnest({_tokens('letter')}) as token from documents)
  where token not in {stop} group by doc_id, token),
distinct_tokens as materialized (select distinct token from tokens),
{_stem_steps('distinct_tokens')},
terms as materialized (
  select doc_id, term, cast(sum(n) as bigint) as tf from tokens join stems using (token) group by doc_id, term),
frequencies as materialized (select term, count(distinct doc_id) as df from terms group by term),
top as materialized (
  select term, df from frequencies where length(term) > 2 order by df desc, term limit 100),
dense as (
  select d.doc_id, top.term, top.df, coalesce(terms.tf, 0) as tf
  from (select doc_id from documents where text <> '') d cross join top
  left join terms on terms.doc_id = d.doc_id and terms.term = top.term)
"""


def _token_counts(kind: str) -> str:
    return f"""select doc_id, token, count(*) as cnt
from (select doc_id, unnest({_tokens(kind)}) as token from documents) group by doc_id, token"""


_COUNTED_WORDS = f"""counted as (select case when length(word) % 2 = 0 then ' ' || upper(word) else word end as word, cnt
  from ({_word_counts()}))"""


def check_sql() -> dict[str, str]:
    pair_columns = "select word, coword, cnt from pairs"
    keyed = f"""with {_LINES},
tokens as (select doc_id, line_id, unnest({_tokens('alnum', 'line')}) as term from lines),
vocabulary as materialized ({_TOP_50}),
hits as materialized (select * from tokens where term in (select word from vocabulary))
"""
    checks = {
        "top50_words": _TOP_50,
        "word_counts": _word_counts(),
        "word_counts_with_case": _word_counts("cased"),
        "word_counts_joined": _word_counts(stop=_LANGUAGES),
        "word_tokens": _token_counts("word"),
        "letter_tokens": _token_counts("letter"),
        "alnum_tokens": _token_counts("alnum"),
        "cooc_pairs_exact_d0": _pairs(_exact(0)) + pair_columns,
        "cooc_pair_lines_d2": _pairs(_within(2))
        + r"select '{' || word || ',' || coword || '}' || chr(9) || cnt as value from pairs",
        "cooc_pairs_all_words_d1": _pairs(_exact(1), _word_counts()) + pair_columns,
    }
    for d in (1, 2, 3, 4):
        checks[f"cooc_pairs_exact_d{d}"] = _pairs(_exact(d)) + pair_columns
        checks[f"cooc_pairs_within_d{d}"] = _pairs(_within(d)) + pair_columns
        checks[f"cooc_stripes_d{d}"] = _pairs(_within(d)) + (
            "select word, '{' || string_agg(coword || '=' || cnt, ', ' order by coword) || '}' as stripe\n"
            "from pairs group by word"
        )
    document_frequency = _terms() + "select term, df from frequencies"
    sparse = _terms() + "select doc_id, term, tf from terms where term in (select term from top)"
    dense = _terms() + "select doc_id, term, tf from dense"
    checks |= {
        "stemmed_vocabulary": _terms() + "select token, term from stems",
        "document_frequency": document_frequency,
        "document_frequency_by_line": document_frequency,
        "document_frequency_joined": _terms(_LANGUAGES) + "select term, df from frequencies",
        "top100_terms": _terms() + "select term, df from top",
        "term_frequency": sparse,
        "term_frequency_by_line": sparse,
        "term_frequency_dense": dense,
        "term_frequency_dense_by_line": dense,
        "tfidf": _terms()
        + "select doc_id, term, round(tf * log10(10000.0 / (df + 1)), 6) + 0.0 as tfidf from dense",
        "term_frequency_dense_joined": _terms(_LANGUAGES) + "select doc_id, term, tf from dense",
        "tfidf_corpus_size": _terms()
        + "select doc_id, term, round(tf * log10((select count(*) from documents where text <> '')"
        " / cast(df + 1 as double)), 6) + 0.0 as tfidf from dense",
        "tfidf_from_lists": _terms()
        + """, lists as (
  select case when length(term) % 2 = 0 then ' ' || upper(term) else term end as raw, df,
    length(term) % 3 = 0 as three from top),
scored as (select lower(trim(raw)) as term from lists union select raw from lists where not three)
select d.doc_id, scored.term,
  round(coalesce(terms.tf, 0) * log10(10000.0 / (coalesce(lists.df, 1) + 1)), 6) + 0.0 as tfidf
from (select doc_id from documents where text <> '') d cross join scored
left join terms on terms.doc_id = d.doc_id and terms.term = scored.term
left join lists on lists.raw = scored.term and not lists.three""",
        "tfidf_sparse": _terms()
        + "select doc_id, term, round(terms.tf * log10(10000.0 / (df + 1)), 6) + 0.0 as tfidf"
        " from terms join frequencies using (term) where length(term) > 0",
        "tfidf_tsv_lines": _terms()
        + "select doc_id || chr(9) || term || chr(9) || printf('%.6f', tf * log10(cast(10000 as double) / (df + 1)))"
        " as value from dense",
        "stripe_lines": _pairs(_within(2))
        + "select word || chr(9) || '{' || string_agg(coword || '=' || cnt, ', ' order by coword) || '}' as value\n"
        "from pairs group by word",
        # Ranges of ranks: the i-th of n parts begins at the rank ceil(i * rows / n).
        "cooc_stripe_pieces_d2": _pairs(_within(2))
        + """, cowords as (
  select coword, row_number() over (order by coword) - 1 as r, count(*) over () as n
  from (select distinct coword from pairs)),
parts as (select coword, cast(r * ((n + 6) // 7) // n as integer) as part from cowords)
select word, part, '{' || string_agg(coword || '=' || cnt, ', ' order by coword) || '}' as stripe
from pairs join parts using (coword) group by word, part""",
        "cooc_pair_files": _pairs(_within(2))
        + """, ranked as (
  select word, coword, cnt, row_number() over (order by word, coword) - 1 as r, count(*) over () as n from pairs),
placed as (select *, r * 4 // n as file from ranked)
select cast(file as integer) as file_number, cast(r - (file * n + 3) // 4 as integer) as line_number,
  word || chr(9) || coword || chr(9) || cnt as value from placed""",
        "tfidf_files": _terms()
        + "select row_number() over (order by doc_id, term) - 1 as line_number, doc_id || chr(9) || term"
        " || chr(9) || printf('%.6f', tf * log10(cast(10000 as double) / (df + 1))) as value from dense",
        "document_files": _terms()
        + "select term, count(distinct doc_id) as df, count(distinct doc_id) filter (doc_id % 2 = 0) as first_df"
        " from terms group by term",
        "tfidf_lines": _terms()
        + "select doc_id, term, printf('%.6f', tf * log10(cast(10000 as double) / (df + 1))) as score from dense",
        "keyed_term_frequency": keyed
        + "select cast(doc_id as varchar) as doc_id, term, count(*) as tf from hits group by all",
        "keyed_term_maps": keyed
        + """, counts as (select line_id, term, count(*) as n from hits group by all),
maps as (select line_id, string_agg(term || '=' || n, ', ' order by term) as entries from counts group by line_id),
split_lines as (select doc_id, line_id from lines)
select cast(doc_id as varchar) as doc_id, '{' || coalesce(entries, '') || '}' as tf, count(*) as n
from split_lines left join maps using (line_id) group by all""",
        "text_lines": f"with {_LINES} select line as value, count(*) as cnt from lines group by line",
        "word_list": f"""with {_LINES}
select distinct regexp_replace(lower(line), '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g') as word from lines""",
        "document_ids": "select doc_id, lang || '.v1.' || doc_id as file_id from documents",
        "vocabulary_raw": f"with {_COUNTED_WORDS} select distinct word from counted",
        "vocabulary_normalised": f"with {_COUNTED_WORDS} select distinct lower(trim(word)) as word from counted",
        "term_counts": f"with {_COUNTED_WORDS} select word as term, max(cnt) as df from counted group by word",
        "term_counts_guarded": f"select word as term, cnt as df from ({_word_counts()}) where length(word) % 4 = 0",
        "scored_terms": f"with {_COUNTED_WORDS} select word as term from counted union select lower(trim(word)) from counted",
        "vocabulary_lines": _terms() + "select term || chr(9) || df as value from top",
    }
    return checks
