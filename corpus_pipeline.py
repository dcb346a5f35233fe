"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. Between
stages the documents are written as Parquet to the shared folder and read again. Decisions
are tables of ids; they are broadcast up to ``BROADCAST_IDS`` rows, and joined by shuffle beyond.

Every row is decided on by itself: rows that share an id, or have none, get keys of their own above all
ids for the stages that decide by id, and their ids back after. Of equal or near rows the one with the smallest key stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatecount.llm import jaccard, langid, mixing, ngram, packing
from gatecount.llm.scratch import saved

BROADCAST_IDS = 1_000_000
LEAST_LANGUAGE_SCORE = 0.5
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: SQL can't express the stages; tests hold them against brute force.
ORACLE_SQL = None


def _sized(table: DataFrame) -> DataFrame:
    """A written table of ids, marked for broadcast if it is small."""
    return F.broadcast(table) if table.count() <= BROADCAST_IDS else table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: ``lang`` is what the text shows; letterless and doubtful texts go."""
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))))
    known = langid.predict(docs.select(*COLUMNS), model).filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE_SCORE))
    return known.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def _own_keys(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(``docs`` with a key of its own for each row in doc_id, and its id in own_id; the rows whose key isn't their id, if there are any).

    Rows whose id occurs once keep it. The others are written once with numbers above all ids, so that all readers see the same.
    """
    docs = docs.withColumn("own_id", F.col("doc_id"))
    repeated = saved(docs.groupBy("doc_id").count().filter("count > 1 or doc_id is null").select("doc_id"), "repeated", narrow=True)
    if repeated.isEmpty():
        return docs, None
    again = F.broadcast(repeated) if repeated.count() <= BROADCAST_IDS else repeated
    same = docs["doc_id"].eqNullSafe(again["doc_id"])
    top = docs.agg(F.greatest(F.coalesce(F.max("doc_id"), F.lit(0)), F.lit(0))).first()[0]
    if top >= 1 << 62:
        raise ValueError("ids leave no room for keys above them")
    others = saved(docs.join(again, same, "left_semi").withColumn("doc_id", F.lit(top + 1) + F.monotonically_increasing_id()), "own-keys")
    return docs.join(again, same, "left_anti").unionByName(others), others


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under a model of trusted text is not above their language's quantile.

    Rows that share an id share its label, and each has a perplexity of its own.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    keyed, others = _own_keys(docs)
    if others is not None:
        labels = labels.unionByName(others.select("doc_id", "own_id").join(labels.withColumnRenamed("doc_id", "own_id"), "own_id").select("doc_id", "quality", "toxic"))
    rejected = saved(ngram.quality(keyed, labels).filter("not kept").select("doc_id").distinct(), "rejected", narrow=True)
    kept = keyed.join(_sized(rejected), "doc_id", "left_anti")
    return kept.withColumn("doc_id", F.col("own_id")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies: that with the smallest id among those whose id is their own, or else any one row."""
    keyed, _ = _own_keys(docs)
    found = jaccard.similar_documents(keyed)
    dropped = saved(found.filter("doc_id != component_id").select("doc_id"), "dropped", narrow=True)
    return keyed.join(_sized(dropped), "doc_id", "left_anti").withColumn("doc_id", F.col("own_id")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, nought to two times, as the mix takes half of their words or more, each part in the order of the mix.

    Texts move once, by id, and each part is sorted by slot: a thinned copy of the mix. Documents without words
    take no part in the mix; they stay once.
    """
    own = F.struct("doc_id", F.xxhash64("text").alias("h"))  # rows that share an id are told apart by their texts
    placed, _ = mixing.placements(docs.withColumn("doc_id", own))
    once = placed.select(F.col("doc_id").alias("own"), "turn", "slot").dropDuplicates(["own", "turn"])
    blank = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    mixed = docs.withColumn("own", own).join(once, "own", "left").filter(F.col("slot").isNotNull() | blank)
    return mixed.sortWithinPartitions("slot", "doc_id").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens, with their ids."""
    from public_tokenizers import path

    packed = packing.pack_documents(docs, path("word_bpe_49k.json"))
    return packed.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("language", language), ("quality", quality), ("near_duplicates", near_duplicates), ("mixing", mix), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
