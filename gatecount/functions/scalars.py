"""Scalar functions as pure Column builders: text keys, contacts, dates, numbers, links.

Nulls give nulls unless a docstring says otherwise. Everything but ``composed`` stays inside Spark's code generation:
accents are folded by a translation of each letter that Unicode takes apart into a base and marks, and marks are left out.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import NO_DATA

#: Mistyped mail domains and the domains that are meant.
DOMAIN_TYPOS = {"gmial.com": "gmail.com", "hotmial.com": "hotmail.com", "outlok.com": "outlook.com"}
EMAIL_PATTERN = r"^[a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,}$"


def text(c: Column) -> Column:
    """No-break spaces become spaces, runs of white space one space, ends trimmed; null becomes empty."""
    return F.trim(F.regexp_replace(F.translate(F.coalesce(c, F.lit("")), " ", " "), r"\s+", " "))


def composed(c: Column) -> Column:
    """The text in Unicode's composed form (NFC). Only texts with a letter from U+0300 on reach Python: what lies below is composed."""

    def compose(texts: pa.Array) -> pa.Array:  # Arrow's own function decomposes only
        if texts.null_count == len(texts):
            return texts
        return pa.array([None if t is None else unicodedata.normalize("NFC", t) for t in texts.to_pylist()], pa.string())

    beyond = c.rlike(r"[^\x00-\u02FF]")
    return F.coalesce(F.arrow_udf(compose, "string")(F.when(beyond, c)), c)


@cache
def _letters() -> tuple[str, str]:
    """Letters that are a base with marks, and the bases: what decomposition (NFD) without marks makes of each."""
    pairs = {}
    for k in range(0xC0, 0x3000):
        base = [x for x in unicodedata.normalize("NFD", chr(k)) if unicodedata.category(x) != "Mn"]
        if len(base) == 1 and base[0] != chr(k):
            pairs[chr(k)] = base[0]
    return "".join(pairs), "".join(pairs.values())


def fold(c: Column) -> Column:
    """Capitals without accents or other marks, composed or not; sharp s becomes SS. ASCII has none of these and is spared the translation."""
    capitals = F.translate(F.upper(F.replace(c, F.lit("ß"), F.lit("SS"))), *_letters())
    return F.when(c.rlike(r"[^\x00-\x7F]"), F.regexp_replace(capitals, r"\p{Mn}+", "")).otherwise(F.upper(c))


def match_key(c: Column) -> Column:
    return F.regexp_replace(fold(c), "[^A-Z0-9]", "")


def tokens(c: Column) -> Column:
    """Words of A-Z and 0-9 of the folded text, in their order."""
    return F.regexp_extract_all(fold(c), F.lit("[A-Z0-9]+"), F.lit(0))


def token_key(c: Column) -> Column:
    return F.array_join(F.array_sort(tokens(c)), " ")


def email(c: Column) -> Column:
    """struct(value, upper_case, plus_alias, domain_typo, invalid); value is the no-data word where it is not an address."""
    raw = F.trim(F.coalesce(c, F.lit("")))
    low = F.regexp_replace(F.regexp_replace(F.lower(raw), r"\s+", ""), "^mailto:", "")
    user, domain = F.split_part(low, F.lit("@"), F.lit(1)), F.split_part(low, F.lit("@"), F.lit(2))
    one_at = F.length(low) - F.length(F.replace(low, F.lit("@"), F.lit(""))) == 1
    plain = F.split_part(user, F.lit("+"), F.lit(1))
    fixes = F.create_map(*[F.lit(x) for pair in DOMAIN_TYPOS.items() for x in pair])
    right = F.coalesce(fixes[domain], domain)
    value = F.concat(plain, F.lit("@"), right)
    valid = one_at & value.rlike(EMAIL_PATTERN)
    return F.struct(
        F.when(valid, value).otherwise(F.lit(NO_DATA)).alias("value"),
        (raw != F.lower(raw)).alias("upper_case"),
        (one_at & (plain != user)).alias("plus_alias"),
        (one_at & (right != domain)).alias("domain_typo"),
        (~valid).alias("invalid"),
    )


def phone(c: Column) -> Column:
    """struct(value, formatted, missing, invalid): ten digits that begin with 3, without the country code 57."""
    raw = F.trim(F.coalesce(c, F.lit("")))
    digits = F.regexp_replace(raw, r"\D", "")
    own = F.when((F.length(digits) == 12) & digits.startswith("57"), F.substring(digits, 3, 10)).otherwise(digits)
    valid = own.rlike("^3[0-9]{9}$")
    return F.struct(F.when(valid, own).otherwise(F.lit(NO_DATA)).alias("value"), (valid & (own != raw)).alias("formatted"), (raw == "").alias("missing"), ((raw != "") & ~valid).alias("invalid"))


def boolean(c: Column) -> Column:
    """Words for yes and no; anything else is null."""
    low = F.lower(F.trim(c))
    return F.when(low.isin("true", "1", "si", "sí", "yes"), True).when(low.isin("false", "0", "no"), False)


def utc_text(c: Column) -> Column:
    """A timestamp text as ISO in UTC; what does not parse is null."""
    return F.date_format(F.try_to_timestamp(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def number(c: Column, default: float = 0.0, low: float | None = None, high: float | None = None) -> Column:
    """A double from text, with a default, rounded half to even and clipped."""
    out = F.rint(F.coalesce(c.try_cast("double"), F.lit(default)))
    out = F.greatest(out, F.lit(low)) if low is not None else out
    return F.least(out, F.lit(high)) if high is not None else out


def identity_score(*present: Column) -> Column:
    """How many of the conditions hold."""
    return sum((F.coalesce(p, F.lit(False)).cast("int") for p in present), F.lit(0))


def handle(c: Column) -> Column:
    return F.substring(F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9._-]", ""), 1, 40)


def csv_field(c: Column) -> Column:
    """A field quoted where it has a quote, comma or line end; null becomes empty."""
    value = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(value.rlike('[",\n\r]'), F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(value)


def csv_line(*columns: Column) -> Column:
    return F.concat_ws(",", *[csv_field(c) for c in columns])


def share_link(event_id: Column, courtesy: Column, membership: Column, consumption: Column, converted: Column) -> Column:
    """Path of a projection; levers of zero are left out."""
    parts = [F.when(v > 0, F.concat(F.lit(f"{k}="), v.cast("string"))) for k, v in (("c", courtesy), ("m", membership), ("k", consumption), ("v", converted))]
    query = F.concat_ws("&", *parts)
    return F.concat(F.lit("/e/"), event_id.cast("string"), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def parse_share_link(link: Column) -> Column:
    """struct(event_id, c, m, k, v) of a path; absent levers are 0."""
    lever = lambda k: F.coalesce(F.regexp_extract(link, rf"[?&]{k}=([0-9]+)", 1).try_cast("int"), F.lit(0)).alias(k)
    return F.struct(F.regexp_extract(link, "^/e/([^?]+)", 1).alias("event_id"), *[lever(k) for k in "cmkv"])


def rounded(c: Column, places: int) -> Column:
    """Half up on the decimal grid, the same on every engine."""
    scale = float(10**places)
    return F.floor(c * scale + 0.5) / F.lit(scale)


def hours_between(later: Column, earlier: Column) -> Column:
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    return (micros(later) - micros(earlier)) / F.lit(3.6e9)


def clip_probability(p: Column, edge: float = 1e-6) -> Column:
    return F.least(F.greatest(p, F.lit(edge)), F.lit(1 - edge))


def normal_cdf(z: Column) -> Column:
    """Abramowitz and Stegun's polynomial for the normal distribution."""
    #: The polynomial's coefficients.
    t = 1 / (1 + 0.2316419 * F.abs(z))
    tail = 0.3989423 * F.exp(-z * z / 2) * t * (0.3193815 + t * (-0.356538 + t * (1.781478 + t * (-1.821256 + t * 1.330274))))
    return F.when(z > 0, 1 - tail).otherwise(tail)


def arrival_bucket(minutes: Column, width: int = 15, edge: int = 120) -> Column:
    return F.greatest(F.lit(-edge), F.least(F.lit(edge), (F.floor(minutes / width) * width).cast("int")))


def hash_number(c: Column, modulus: int) -> Column:
    """A portable number below ``modulus`` from the first 32 bits of md5."""
    return F.conv(F.substring(F.md5(c.cast("string")), 1, 8), 16, 10).cast("long") % modulus
