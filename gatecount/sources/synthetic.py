"""Deterministic made-up members of any number: each row follows from its id and the seed, in any order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import hash_number
from ..plans.roles import CITIES, FIRST, LAST


def members(spark: SparkSession, n: int, seed: int = 0) -> DataFrame:
    """member_id, names, email, phone, city, with noise in one contact of ten."""
    pick = lambda words, salt: F.element_at(F.array(*map(F.lit, words.split(","))), (hash_number(F.concat(F.lit(f"{salt}{seed}:"), F.col("id").cast("string")), len(words.split(","))) + 1).cast("int"))
    out = spark.range(n).select("id", pick(FIRST, "f").alias("first_name"), pick(LAST, "l").alias("last_name"), pick(CITIES, "c").alias("city"), hash_number(F.concat(F.lit(f"n{seed}:"), F.col("id").cast("string")), 10).alias("noise"))
    email = F.concat(F.lower("first_name"), F.lit("."), F.lower("last_name"), F.col("id").cast("string"), F.when(F.col("noise") == 0, "@gmial.com").otherwise("@mail.com"))
    phone = F.concat(F.lit("3"), F.lpad(((F.col("id") * 7919 + seed) % 1_000_000_000).cast("string"), 9, "0"))
    return out.select(F.col("id").alias("member_id"), "first_name", "last_name", "city", F.when(F.col("noise") == 1, F.upper(email)).otherwise(email).alias("email"), F.when(F.col("noise") == 2, F.concat(F.lit("+57 "), phone)).otherwise(phone).alias("phone"))
