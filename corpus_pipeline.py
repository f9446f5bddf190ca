"""From raw documents to packed training sequences: five stages over whole tables.

Each stage takes the documents its predecessor kept, as a table read from files, and returns those that it keeps
with all their columns; the last returns the packed pieces with their token ids. Rows are told apart by their
place in the table, so null or repeated ids are judged row by row. Stages with nothing to keep give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.llm import decontaminate, exact_dedup, language_id, near_dedup, packing
from marquee.llm.common import addressable, read_table, without_rows
from marquee.llm.queries import vocabulary
from marquee.session import materialise


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the labelled languages; text in none of them, or without letters, goes."""
    policy, docs = language_id.LanguagePolicy(), addressable(docs)
    model = language_id.learn_text_model(language_id.labelled_documents(docs), policy)
    return without_rows(docs, language_id.identify(docs, None, model, policy).where("not kept"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text."""
    docs = addressable(docs)
    return without_rows(docs, exact_dedup.exact_groups(docs).where("not kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more."""
    docs = addressable(docs)
    return without_rows(docs, near_dedup.near_components(docs, near_dedup.NearPolicy()).where("not kept"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, copied or edited."""
    docs = addressable(docs)
    found = decontaminate.contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return without_rows(docs, found.where("contaminated"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, with ids, placed in sequences of at most 2048 tokens."""
    # Fewer words are kept than by default: the JVM of an executor has grown by then.
    policy = packing.PackPolicy(kept_pieces=150_000)
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), policy, with_ids=True)


STAGES = [
    ("language", keep_known_languages),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: Rolling hashes, sketches, alignments and tokenizers have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
