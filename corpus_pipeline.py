"""Corpus preparation: quality, near duplicates, personal data, source mix, packing.

Every stage takes all documents its predecessor kept and is stored before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tickforge.llm import bbit_minhash, mixing, packing, pii_tagger, quality_ftrl
from tickforge.llm.common import prepare, table
from tickforge.session import stage


def quality(spark, docs, sf_dir):
    """Documents that the quality classifier, trained on their labels, accepts."""
    weights = quality_ftrl.fit(docs, table(prepare(spark), sf_dir, "labels"))
    return docs.where(quality_ftrl.scorer(weights)("text") >= 0.5)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group linked by 80 % of their five-word shingles."""
    prepare(spark)
    return bbit_minhash.deduplicated(docs)


def personal_data(spark, docs, sf_dir):
    """Personal data replaced by its kind."""
    prepare(spark)
    clean = docs.withColumn("text", pii_tagger.redactor(pii_tagger.fit(docs))("text"))
    return clean.withColumn("n_chars", F.char_length("text").cast(dict(docs.dtypes)["n_chars"]))


def source_mix(spark, docs, sf_dir):
    """Every document as often as the mix of sources takes it."""
    prepare(spark)
    return mixing.copies(docs)


def packed(spark, docs, sf_dir):
    """Token sequences of the documents."""
    import public_tokenizers

    prepare(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("source_mix", source_mix), ("packing", packed)]

#: Three stages decide by trained models or hashes, which SQL cannot express.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(prepare(spark), sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
