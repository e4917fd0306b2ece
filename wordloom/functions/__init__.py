from wordloom.functions.rendering import pair_text, score_line, score_text, stripe_text
from wordloom.functions.stemming import porter_stem, stem_counts, stem_token
from wordloom.functions.stopwords import STOP_WORDS
from wordloom.functions.tokens import (
    alnum_tokens,
    document_id,
    letter_tokens,
    lines_of,
    trim_control,
    word_tokens,
)

__all__ = [
    "STOP_WORDS", "alnum_tokens", "document_id", "letter_tokens", "lines_of", "pair_text",
    "porter_stem", "score_line", "score_text", "stem_counts", "stem_token", "stripe_text",
    "trim_control", "word_tokens",
]
