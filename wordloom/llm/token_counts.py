"""Token counts by rank-synchronous merging of ragged arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wordloom.llm.byte_bpe import load
from wordloom.llm.common import schema_of, text_slices


def count_tokens(
    documents: DataFrame,
    vocabulary: str,
    limit: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit``: one row per row of ``documents``.

    ``vocabulary`` is a ``tokenizers`` file of byte-level BPE whose place is the same on
    every executor. Tokens are counted as that library counts them, without tokens added
    at the ends; a special token spelled out in a text is that one token.
    ``over_limit`` tells whether there are more than ``limit`` tokens.

    A null text counts as an empty one (0 tokens); repeated rows give repeated results, a
    null id stays null, other columns are not read. There is no shuffle; memory is bounded
    by 1.5 million characters of text at a time, or one text if it is longer.
    """

    def count(batches):
        bpe = load(vocabulary)
        for batch, texts in text_slices(batches, text_column):
            tokens = bpe.counts(texts)
            sizes = np.array([len(text.encode()) for text in texts], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_column), pa.array(sizes), pa.array(tokens), pa.array(tokens > limit)],
                names=[id_column, "n_bytes", "n_tokens", "over_limit"],
            )

    rows = documents.select(id_column, text_column)
    schema = schema_of(rows, [id_column], n_bytes="long", n_tokens="long", over_limit="boolean")
    return rows.mapInArrow(count, schema)
