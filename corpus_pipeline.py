"""The corpus pipeline: from documents to token identifiers in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; run() writes each stage's result as
Parquet into the shared folder and reads it again as the next one's docs. Where rows must be told apart they are numbered once
and stored with their numbers, so repeated or missing identifiers do no harm, and neither do executors that come and go.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platelake.llm.byte_bpe import encode_decode
from platelake.llm.components import joined_with_sums
from platelake.llm.exact_dedup import exact_dedup
from platelake.llm.jaccard import jaccard_components
from platelake.llm.mixing import mix_sources
from platelake.llm.shared import staged, table
from platelake.llm.simhash import simhash_components
from platelake.llm.toxicity import score_toxicity, train_model


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that docs does not have, in either case."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs stored with a number for each row, and the number's name."""
    row = _unused(docs, "_row")
    return staged(docs.withColumn(row, F.monotonically_increasing_id()), "pipeline-numbered"), row


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    model = train_model(docs, table(spark, sf_dir, "labels"))
    all_ = _unused(docs, "_all")
    whole = docs.withColumn(all_, F.struct(*(F.col(f"`{c}`") for c in docs.columns)))
    return score_toxicity(whole, model, carry=(all_,)).filter("predicted = 0").select(f"{all_}.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    rows, row = _numbered(docs)
    kept = exact_dedup(rows, row_col=row).filter("kept").select(row)
    return rows.join(kept, row, "left_semi").drop(row)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least identifier of each group of near-duplicates: texts joined by steps of five-word Jaccard similarity 0.8
    or more.

    SimHash fingerprints of five-word shingles within 2 bits, by covering hashing, and MinHash bands give the candidates; an
    exact comparison of shingle sets decides. Null identifiers rank last. Texts without words form one group."""
    rows, row = _numbered(docs)
    found = staged(simhash_components(rows, carry=(row,), shingle=5).select(F.col(row).alias("u"), "root"), "pipeline-simhash")
    first = found.groupBy("root").agg(F.min("u").alias("v"))
    candidates = joined_with_sums(found, first, ["root"]).select("u", "v")
    groups = jaccard_components(rows, row, candidates).withColumnsRenamed({"node": row, "root": f"{row}_r"})
    named = rows.select("doc_id", row).join(groups, row)
    kept = named.groupBy(f"{row}_r").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", row)).alias("first")).select(f"first.{row}")
    gone = named.select(row).join(kept, row, "left_anti")
    return rows.join(gone, row, "left_anti").drop(row)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, in whole copies: its taken words over its size, rounded. Documents of which the
    mix takes less than half a copy go, and so do those without words, which add nothing to a mix of words."""
    rows, row = _numbered(docs)
    times = F.round(F.col("taken") / F.col("size")).cast("int")
    taken = mix_sources(rows, carry=(row,)).filter("taken > 0").select(row, F.sequence(F.lit(1), times).alias(f"{row}_n"), times.alias(f"{row}_t")).filter(f"{row}_t > 0")
    met = rows.join(taken, row).withColumn(f"{row}_c", F.explode(f"{row}_n"))
    return met.select(*(f"`{c}`" for c in docs.columns))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and ids, the token identifiers of every document's whole text, with their number and digests."""
    return encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), with_ids=True).drop("decoded")


STAGES = [("toxicity", toxicity), ("exact_dedup", exact), ("simhash_dedup", near), ("mixing", mixing), ("byte_bpe", tokens)]

#: SQL cannot say the classifier or the fingerprints; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a data folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
