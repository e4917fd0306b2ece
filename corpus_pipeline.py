"""A pipeline from raw documents to packed training sequences.

Every stage takes the session, the documents that are left and the folder of tables. The
results of all but the last are written to the shared folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.common import stored, table
from wordloom.llm.jaccard import one_of_each
from wordloom.llm.mixing import sample_mix, topic_of
from wordloom.llm.packing import Capacity, pack_documents
from wordloom.llm.quality import clean_lines
from wordloom.llm.queries import words_in
from wordloom.llm.toxicity import held_out, remove_toxic, train


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents predicted to be toxic; learns from those labelled ones that are
    still there and not in the held-out fold."""
    labels = table(spark, sf_dir, "labels").filter(~held_out())
    return remove_toxic(docs, train(docs, labels))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes failing lines, and documents that are mostly such lines or fail the base
    rules; ``n_chars`` follows the text."""
    kept = clean_lines(docs).filter("quality.kept")
    return kept.select(
        *(
            {
                "text": F.col("quality.cleaned").alias("text"),
                "n_chars": F.char_length("quality.cleaned").cast("long").alias("n_chars"),
            }.get(c, F.col(c))
            for c in docs.columns
        )
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by a Jaccard similarity of 0.8 on 5-grams."""
    return one_of_each(docs, size=5, percent=80)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents so that sources, languages and topics are flattened."""
    mixed = sample_mix(
        docs,
        {"source": 0.7, "lang": 0.8, "topic": 0.8},
        tokens=words_in(),
        topic=topic_of(F.col("text")),
        share=0.7,
        rounds=6,
    )
    return mixed.filter("mixing.sampled").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the tokens of all documents into sequences of 2048."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return pack_documents(docs, path, Capacity(tokens=2048))


STAGES = [
    ("toxicity", toxicity),
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", source_mixing),
    ("best-fit packing", packing),
]

#: SQL can express neither the learned grammar nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over the ``documents`` of a folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
