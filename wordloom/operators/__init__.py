"""The operators: DataFrame in, DataFrame out. What some need to know of a word list or of
keys before they can plan is computed at the call; everything else when an action asks."""

from wordloom.operators.cooccurrence import (
    cooccurrence_pairs,
    cooccurrence_stripe_pieces,
    cooccurrence_stripes,
)
from wordloom.operators.documents import (
    dense_scores,
    document_frequency,
    keyed_term_frequency,
    keyed_term_maps,
    stem_vocabulary,
    term_frequency,
    term_frequency_dense,
)
from wordloom.operators.frequency import top_terms, top_words, word_count
from wordloom.operators.scoring import scored_terms, tfidf
from wordloom.operators.selection import keep_vocabulary, remove_stop_words

__all__ = [
    "cooccurrence_pairs", "cooccurrence_stripe_pieces", "cooccurrence_stripes", "dense_scores",
    "document_frequency", "keep_vocabulary",
    "keyed_term_frequency", "keyed_term_maps", "remove_stop_words", "scored_terms", "stem_vocabulary",
    "term_frequency", "term_frequency_dense", "tfidf", "top_terms", "top_words",
    "word_count",
]
