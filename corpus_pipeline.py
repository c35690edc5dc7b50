"""A training corpus from raw documents: each stage reads what the stage before it has written.

Each stage takes (spark, docs, sf_dir) and works on all rows that it is given; all but the last return the columns that
they were given.  Null and empty texts leave with the first stage.  Rows without an id are never dropped as copies.  Rows
that repeat an id stay or go together.  An empty table passes through all stages as one.  Further columns stay as they
are; a stage's own columns take names that aren't there yet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm.exact_dedup import find_copies
from lodestrata.llm.language_id import UNKNOWN, fit, predictor
from lodestrata.llm.minhash_dedup import near_copies
from lodestrata.llm.mixing import mixed_rows
from lodestrata.llm.sentence_pieces import model_bytes, piece_columns
from lodestrata.llm.shared import keep

#: A table of ids of so many rows at most (about 16 MB) may be broadcast.
SMALL_ROWS = 400_000


def _joined(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Join on doc_id, by broadcast if the ids are few; the documents' columns come first."""
    ids = keep(ids, "ids")
    return docs.join(F.broadcast(ids) if ids.count() <= SMALL_ROWS else ids, "doc_id", how)


def _unused(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go: those without text or letters, or with no n-gram of a known one."""
    judge, own = predictor(docs, fit(docs)), _unused(docs, "_language")
    return docs.withColumn(own, judge("text")).filter((F.col(own)["lang_pred"] != UNKNOWN) & (F.col(own)["score"] > 0)).select(*docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    dropped = find_copies(docs).filter("not kept").select("doc_id").distinct()
    return _joined(docs, dropped, "left_anti").select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates the document with the smallest id stays."""
    dropped = near_copies(docs).filter("not kept").select("doc_id").distinct()
    return _joined(docs, dropped, "left_anti").select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as all its words are taken, and the parts of it that are taken besides."""
    return mixed_rows(docs, length="n_chars").select(*docs.columns)


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    import public_tokenizers

    pieces = piece_columns(spark, model_bytes(public_tokenizers.path("piece_bpe_32k.model")))
    rows = docs.select("doc_id", "lang", "source", "text", pieces("text").alias("p"))
    return rows.select("doc_id", "lang", "source", "p.n_tokens", "p.ids", (F.col("p.decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("minhash_dedup", near_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", piece_stage),
]
#: The stages fit models, draw at random and use a tokenizer: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
