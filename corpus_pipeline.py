"""The training-data pipeline: five stages from the documents to packed sequences.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns the
columns of ``documents``, the last one the pieces of the sequences. Its result is written below
the shared folder and read again, so no stage is computed twice and lost executors cost only the
tasks they ran. A null text goes through as the empty text.
"""

import public_tokenizers
from pyspark.sql import functions as F

from tagloom.llm.common import read_table, stage
from tagloom.llm.exact_dedup import mark_duplicates
from tagloom.llm.minhash import SENT_IDS, near_duplicates
from tagloom.llm.packing import pack
from tagloom.llm.pii import mask
from tagloom.llm.quality_classifier import fit, score

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
END_OF_DOCUMENT = 2


def quality(spark, docs, sf_dir):
    """Documents that the quality classifier does not reject."""
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, model, "text", "lang", "source", "n_chars").filter("score >= 0.5").select(*COLUMNS)


def exact_dedup(spark, docs, sf_dir):
    """Of equal texts, the document with the largest id."""
    return mark_duplicates(docs, "text", "lang", "source", "n_chars").filter("kept").select(*COLUMNS)


def near_dedup(spark, docs, sf_dir):
    """Of each group of near-duplicates, the document with the smallest id."""
    gone = stage(near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct(), "near-copies")
    if gone.count() <= SENT_IDS:  # else documents and ids are dealt out by id
        gone = F.broadcast(gone)
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def pii(spark, docs, sf_dir):
    """All documents with personal data replaced by its kind; n_chars is the new length."""
    return mask(docs, "lang", "source").withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packing(spark, docs, sf_dir):
    """Pieces of the documents, packed into sequences."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=END_OF_DOCUMENT)


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("pii", pii), ("packing", packing)]

#: Tokenisers and trained models are beyond SQL; tests hold each stage against plain Python.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The packed sequences of ``documents``: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
