"""The registered queries of this subpackage and their SQL.

Each query applies one operator to its whole table and derives the columns of its contract from what the
operator returns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.ann import nearest_neighbours
from quillspark.llm.language_id import identify_languages
from quillspark.llm.line_dedup import dedup_lines
from quillspark.llm.mixing import mix_sources
from quillspark.llm.ngram_join import ngram_jaccard_join
from quillspark.llm.packing import pack_documents
from quillspark.llm.quality import score_quality
from quillspark.llm.secret_scan import scan_secrets
from quillspark.llm.toxicity import score_toxicity
from quillspark.llm.vector_dedup import embedding_near_dedup


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str, n: int) -> Column:
    """crc32 of an id as text, modulo n."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def public_tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and dropped lines of each document, and the digest of what stays."""
    docs = dedup_lines(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.col("n_dropped").cast("long").alias("n_dropped"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; a quarter of the ids is never learned from."""
    learn = table(spark, sf_dir, "labels").where(fold("doc_id", 4) != 2).select("doc_id", "toxic")
    out = score_toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), learn)
    return out.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; a fifth of the ids is never learned from."""
    learn = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0).select("doc_id", "quality")
    out = score_quality(table(spark, sf_dir, "documents").select("doc_id", "text"), learn)
    return out.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "attention")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that a mix of the sources takes."""
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return scan_secrets(table(spark, sf_dir, "documents")).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all vectors for every vector whose id is divisible by 20."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0, 20)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens in sequences of 4096."""
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizer("word_bpe_49k.json"))


def op8_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of vectors of cosine 0.9 or more."""
    return embedding_near_dedup(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; a quarter of the ids is never learned from."""
    out = identify_languages(table(spark, sf_dir, "documents"), fold("doc_id", 4) != 2)
    return out.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have a Jaccard similarity of 0.9 or more."""
    docs = table(spark, sf_dir, "documents")
    out = ngram_jaccard_join(docs, k=3, percent=90)
    return out.select("doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), "component_id")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five stages of corpus_pipeline.py over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    own = (op1_line_dedup, op2_toxicity, op3_quality, op4_mixing, op5_secret_scan, op6_nearest_neighbours, op7_packing, op8_vector_dedup, op9_language_id, op10_ngram_jaccard_join, pipeline)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    """None of these operators has SQL that runs over whole tables; tests hold them against brute force."""
    return {}
