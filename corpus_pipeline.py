"""From raw documents to packed sequences, in stages of the training-data operators.

Each stage gets what its predecessor kept and, but for the last, returns the
columns of documents, whatever other columns there are. ``doc_id`` names a
document; rows without one, or with that of another row, are judged by their
own text. An empty table stays empty in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesflow.llm import block_names, complement_packing, language, line_quality, near_duplicates
from salesflow.llm.encoding import vocabulary
from salesflow.session import scratch_dir, scratch_scope

#: Posterior below which a language is not told, and score from which a document is good.
LEAST_POSTERIOR, LEAST_QUALITY = 0.5, 0.3


def _free(docs: DataFrame, *names: str) -> list[str]:
    """The names, longer where the documents have a column of that name."""
    taken, found = {c.lower() for c in docs.columns}, []
    for name in names:
        while name in taken:
            name += "_"
        found.append(name)
    return found


def _columns(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or of no language that is likelier than not, go.

    Null and empty texts have no letter. Rows that repeat stay or go together.
    """
    guess, posterior = _free(docs, "_guess_of", "_posterior_of")
    told = language.with_language(docs, language.fit(docs), into=guess, score=posterior)
    return told.where((F.col(guess) != language.UNDETERMINED) & (F.col(posterior) >= LEAST_POSTERIOR)).select(_columns(docs))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line labels find bad go; null and empty texts are scored as a document of no lines."""
    (score,) = _free(docs, "_quality_of")
    field = line_quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return line_quality.with_quality(docs, field, into=score).where(F.col(score) >= LEAST_QUALITY).select(_columns(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space one row stays: the longest, then that of the smallest id; of equal rows any one."""
    kept = (
        block_names.exact_duplicates(docs)
        .where("kept")
        .select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_body"), F.col("chars").alias("_size"))
    )
    body, size, repeat = _free(docs, "_body_of", "_size_of", "_repeat_of")
    marked = docs.withColumns(
        {
            body: F.sha2(block_names.normalised(F.col("text")).cast("binary"), 256),
            size: F.length(F.coalesce("text", F.lit(""))).cast("long"),
        }
    )
    same = marked["doc_id"].eqNullSafe(kept["_id"]) & (marked[body] == kept["_body"]) & (marked[size] == kept["_size"])
    first = F.row_number().over(Window.partitionBy("doc_id", body, size).orderBy(size))
    return marked.join(kept, same, "left_semi").withColumn(repeat, first).where(F.col(repeat) == 1).select(_columns(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links connect, one stays, as the operator chooses; rows that repeat id and text are one document.

    Texts without words (null, empty, blank) are linked with nothing and stay.
    """
    kept = near_duplicates.decisions(docs).where("kept").select(F.col("doc_id").alias("_id"), F.col("body").alias("_body"))
    (body,) = _free(docs, "_body_of")
    marked = docs.withColumn(body, near_duplicates.body(F.col("text")))
    same = marked["doc_id"].eqNullSafe(kept["_id"]) & (marked[body] == kept["_body"])
    return marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", body]).select(_columns(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 4096 tokens; a null text is empty, and a document without tokens is one id long."""
    return complement_packing.pack_documents(docs, vocabulary())


STAGES = [
    ("language ID", identify_language),
    ("quality classifier", keep_quality),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("best-fit packing", pack),
]

#: The classifiers and the tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written and read again as the next one's input.

    What a stage wrote on its way is removed once its result is written.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        path = scratch_dir(spark, name.replace(" ", "-"))
        with scratch_scope(spark):
            result = function(spark, docs, sf_dir)
            result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
    return docs
