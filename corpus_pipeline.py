"""Training-data pipeline: documents -> packed sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor
kept. All but the last return the columns of ``documents`` (doc_id, text, lang,
source, n_chars); the last returns the pieces of the packed sequences with their
ids (``packing.sequences`` joins them to whole sequences). Between
stages the rows are written to the shared folder and read again.

1. toxicity: documents predicted toxic go.
2. near_dedup: of each near-duplicate group the document of the smallest doc_id stays.
3. suffix_dedup: bytes of strings of 100 bytes that start earlier are cut from the text.
4. secrets: secret spans become ``[secret]``.
5. packing: first-fit decreasing into sequences of 2048 ids.

Stages 3 and 4 change ``text`` and set ``n_chars`` anew; documents that keep no
text stay as empty texts. A null text passes stages 1, 2 and 4 as it is and
becomes empty in stage 3. SQL can't express stages 1 and 5, so there is no
ORACLE_SQL; the tests hold ``run`` against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from flightmart.llm import near_dedup, packing, secrets, suffix_dedup, toxicity
from flightmart.llm.common import materialize, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark, docs, sf_dir):
    """Documents that the classifier, trained on ``labels``, predicts clean."""
    return toxicity.kept(docs.select(*COLUMNS), table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each near-duplicate group (rows of one doc_id with other texts are told apart)."""
    kept = near_dedup.grouped(docs).where("kept").select(F.col("doc_id").alias("_id"), F.col("content").alias("_content"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("_content"))
    return docs.select(*COLUMNS).join(kept.distinct(), same, "left_semi")


def cut_repeats(spark, docs, sf_dir):
    """Texts without the strings that start earlier in the corpus."""
    return suffix_dedup.without_repeats(docs.select(*COLUMNS)).select(*COLUMNS)


def redact_secrets(spark, docs, sf_dir):
    """Texts whose secret spans are replaced."""
    out = secrets.redacted(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark, docs, sf_dir):
    """One row per piece of a document in its sequence, with its ids."""
    return packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("secrets", redact_secrets),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
