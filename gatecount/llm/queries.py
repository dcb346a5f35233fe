"""The registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram import quality

    return quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html import extract

    return extract(_table(spark, sf_dir, "pages"))


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import similar_documents

    return similar_documents(_table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import fit, held_out, predict

    docs = _table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import taken_words

    return taken_words(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "slot")


def op6_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .multiindex import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "embeddings"))


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .audio import ALAW, IMA_ADPCM, MULAW, describe_audio, store_text_audio

    # telephone files of all three formats are stored with every sample of their PCM; corpora use 16 kHz, so what is read back is resampled
    stored = store_text_audio(_table(spark, sf_dir, "documents"), pcm_rate=8000, kinds=(MULAW, ALAW, IMA_ADPCM))
    return describe_audio(stored, pcm_rate=16000, held_rate=8000)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard

    return shard(_table(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        F.crc32(F.coalesce(F.col("row.text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import read_archive, write_archive

    records = read_archive(spark, *write_archive(_table(spark, sf_dir, "pages")), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    from .packing import pack_documents

    packed = pack_documents(_table(spark, sf_dir, "documents"), path("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_group")


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan_licenses

    return scan_licenses(_table(spark, sf_dir, "documents"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .dualtree import mine, shifted_label

    return mine(_table(spark, sf_dir, "embeddings"), shifted_label(F.col("vec_id"), F.col("label")))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .phrases import collocations

    return collocations(_table(spark, sf_dir, "documents"))


_ALL = (op1_quality, op2_html, op3_jaccard, op4_language, op5_mixing, op6_vectors, op7_media, op8_sharding, op9_warc, op10_packing, op11_licenses, op12_negatives, op13_phrases)
QUERIES = {f.__name__: f for f in _ALL}
