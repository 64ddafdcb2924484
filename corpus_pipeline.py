"""The corpus pipeline: documents through a chain of the document operators.

`STAGES` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame,
which is written as Parquet and read again as the next one's docs. All but the last keep the
columns of the documents table. Every stage works on all rows that its predecessor kept.
"""

import public_tokenizers

from orderloom.llm import bpe, decontamination, language, repetition, simhash
from orderloom.llm.text import table
from orderloom.session import cut_lineage


def language_id(spark, docs, sf_dir):
    """Drops documents without letters, and those whose language is unclear."""
    return language.drop_unclear(docs, language.fit(docs))


def quality_rules(spark, docs, sf_dir):
    """Drops documents that are too short or repeat themselves."""
    return repetition.drop_repetitive(docs)


def simhash_dedup(spark, docs, sf_dir):
    """Keeps the document with the smallest id of each group of near-duplicates."""
    return simhash.keep_one(docs)


def decontaminate(spark, docs, sf_dir):
    """Drops documents of which a twentieth or more is benchmark passages, and cuts such
    passages out of the others."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark, docs, sf_dir):
    """Token counts and digests of the ids and of the text they decode to."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", language_id), ("quality_rules", quality_rules),
          ("simhash_dedup", simhash_dedup), ("decontaminate", decontaminate),
          ("encode", encode)]

#: The stages learn models and run iterations, which SQL cannot express.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
