"""Readers of corpora and word lists.

A corpus is a DataFrame with ``text`` and, where documents matter, ``doc_id``. A row may
hold a whole document or one line of it; ids may repeat across rows. Readers of files
return one row per line. The parsers take any DataFrame with a ``value`` column, such as
``spark.read.text`` gives, so they work on tables as well as on files.
"""

from wordloom.sources.corpora import (
    document_table,
    documents_from_files,
    keyed_documents,
    read_lines,
    text_lines,
)
from wordloom.sources.wordlists import small_word_list, term_counts, vocabulary, word_list

__all__ = [
    "document_table", "documents_from_files", "keyed_documents", "read_lines",
    "small_word_list", "term_counts", "text_lines", "vocabulary", "word_list",
]
