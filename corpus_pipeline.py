"""A corpus in five stages: language, near copies, benchmark passages, mix, token files.

Each stage takes the documents its predecessor kept and returns them with the columns of ``documents``; the last
returns what it reads back from its files. Null texts, and texts without a letter, go in the first
stage. An empty table passes through all of them. Texts are taken whole, however long. Ids and sources may be
null. Columns beyond those read (``doc_id``, ``text``, ``lang``, ``source``) pass through under any name,
also under a name that a stage uses inside. Equal rows and ties are settled in the stage that meets them, see there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardline.llm import language, mixing, simhash, templates, token_files
from wardline.llm.common import read
from wardline.llm.queries import tokenizer_path
from wardline.sources.tables import materialise

# Rows that a Python worker is handed at once. Workers live through all stages and keep what their largest batch took.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model of operator 4 names; repeated rows share their fate."""
    small_batches(spark)
    return language.keep_identified(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each component of operator 1: 3-word shingles, two bits; one of repeated rows."""
    small_batches(spark)
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which operator 8 finds no benchmark item; repeated rows share their fate."""
    small_batches(spark)
    return templates.without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as operator 6 takes them; a null source is a source, repeated rows share their copies."""
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Offsets, counts and sums of the token files of operator 3; every row has an entry, rows of one id in any order."""
    small_batches(spark)
    place = token_files.token_folder(spark)
    token_files.write_token_files(docs, place, tokenizer_path("word_bpe_49k.json"))
    return token_files.with_ids_crc32(token_files.read_token_files(spark, place))


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_tokens),
]
# Models, fingerprints and tokenizers have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``, each written before the next reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
