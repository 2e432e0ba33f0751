"""From raw documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir) and returns what it keeps of ``docs``;
all but the last return the columns of ``documents``. A stage can be run alone:
its result is written as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm import jaccard, linededup, mixing, packing, quality
from lexloom.llm.common import cut_lineage, given_back, others, quoted, table, unused

#: A document of a lower quality score goes.
LEAST_QUALITY = 0.3
#: Near copies have sets of 5-word shingles of a Jaccard similarity of at least 0.8; fingerprints that differ in at most RADIUS bits are candidates.
SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 3


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects go.

    A null text is scored as an empty one; equal texts, in rows of whatever ids,
    get equal scores; without labels (or documents that bear them) every score is
    a half and all stay; no documents give no rows.
    """
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    score = unused("quality", docs.columns)
    return quality.score_quality(docs, model, score_col=score).where(F.col(score) >= LEAST_QUALITY).select(*map(quoted, docs.columns))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: chunks of lines that an earlier place holds go from the text; no document goes.

    A null text stays null, and an empty one empty; rows that repeat id and text
    are one document and keep the same lines; texts of any length are read whole.
    """
    row, names = others(docs, (), ["text"])
    found = linededup.line_dedup(docs.select(row, F.col("doc_id"), "text"))
    out = found.select(*given_back(names, {"text": F.col("text")}))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-dedup: the document with the smallest id of each group stays.

    SimHash fingerprints in vantage-point trees give candidates, MinHash those
    beyond their radius, and exact shingle sets decide.
    Null texts and texts without words are one group; of rows that repeat an id
    one stays; rows whose id is null can't be named and stay.
    """
    return jaccard.keep_one_per_group(docs, SHINGLE, SIMILARITY, RADIUS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: each source's documents, as often as its share of the words asks for.

    Null and empty texts are taken by no mix; a null source is one of its own;
    rows with null or repeated ids are rows of their own.
    """
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: the place of every piece of every document in sequences of 1024 tokens.

    A null text is an empty one, of one token; every row is packed, whatever its id.
    """
    return packing.packed(packing.pieces(docs, packing.vocabulary_path())).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", keep_one_of_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
#: The classifier is learned, so SQL can't give the rows; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is cut off from its plan in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut_lineage(docs)
    return docs
