"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's documents. All but the last return the
columns of ``documents``.

1. quality classifier: documents it rejects go;
2. MinHash near-dedup: one document of each group of near copies stays;
3. suffix-array dedup: repeats of 200 bytes or more are cut out of texts;
4. mixing: documents are repeated or dropped until sources meet their weights;
5. best-fit packing: texts become token pieces, with their ids and a place in a sequence.

Cases: null and empty texts are scored by the classifier's intercept; where they stay,
one of them is kept as a document without words, which mixing takes nothing of. Rows
with equal or null ids are separate documents throughout; equal texts are copies, of
which one stays. A null source is a source of its own. An empty table gives no rows.
Further columns, whatever their names, pass through to the last stage, which returns
pieces (doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetlens.llm import minhash, mixing, packing, quality, suffixes
from fleetlens.llm._spark import forget, materialize, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicated(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.sample(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("minhash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("mixing to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Models, digests and tokenizers can't be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        before, docs = docs, materialize(stage(spark, docs, sf_dir), f"pipeline-{k}")
        if k:
            forget(before)
    return docs
