"""A training-data pipeline: quality classifier, near duplicates, repeated passages, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again
as the next one's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scread.llm import automaton_dedup, jaccard_join, mixing, packing, quality
from scread.llm.common import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
NEAR_WORDS, NEAR_THRESHOLD = 5, (8, 10)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. The verdict travels with the text's row through one scan.

    Null and empty texts are scored as texts without words. Rows that repeat get one verdict and stay or go
    together; a null id and null columns are kept as they are. Without labels every score is 0.5 and all stay. Columns
    beyond those of ``documents`` are left out; an empty table gives no rows.
    """
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of texts with 0.8 or more of their five-word shingles in common: that of the smallest id.

    Null and wordless texts link with nothing and stay. A null id comes after all others. Of rows that repeat one
    stays; of one id's different texts each stays unless another row of its own component does. An empty table
    gives no rows.
    """
    return jaccard_join.one_of_each(docs.select(COLUMNS), ngram=NEAR_WORDS, threshold=NEAR_THRESHOLD)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of windows that start earlier elsewhere; ``n_chars`` follows the text.

    Null, empty and short texts stay as they are. A null id comes before all others. Rows that repeat with equal id
    and text are one document and keep the same words. Whole texts are judged, however long; an empty table gives
    no rows.
    """
    return automaton_dedup.without_repeats(docs.select(COLUMNS)).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once or twice.

    Null and empty texts have no words and stay once. A null source is a source of its own. Rows with equal id, source
    and size share what is taken of them; ties are broken by a seeded hash, so reruns agree. An empty table gives no
    rows.
    """
    return mixing.mixed_documents(docs.select(COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequences and offsets.

    Null and empty texts are one piece with the end id; rows that repeat, which mixing makes, are packed as often
    as they occur; a null id stays null. An empty table gives no rows.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# The first stage is a trained model and the last a tokenizer's, neither of which SQL can express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
