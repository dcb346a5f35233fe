"""Whole-table cleaning: rules compiled to one marked table that holds clean rows, quarantine and counters.

A ``Cleaner`` says how a raw table of strings becomes one of ``schema.TABLES``: columns computed in steps, flags to count,
and rules that reject a row. ``mark`` compiles it to one plan in which each distinct raw row stands once with its copies, its
first reason to be rejected, and its flags. Clean rows and quarantine are filters of that table, and counters are sums of its
flags: no accumulators, which count twice when a task runs again. ``write`` takes rows and counters from one scan.

Of rows that share a key the first in the order of all columns stays. Null and blank are one thing. Exact copies are counted before
anything is shuffled by key, and a key's first row is a minimum, so that a key of a third of all rows is no task's burden.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import scalars as S
from ..schema import CHANNELS, MEMBER_TICKET_SOURCES, MEMBER_TICKET_TYPES, NEXT_MONTH, NO, NO_DATA, NOT_APPLICABLE, NOT_OBSERVED, TABLES, TICKET_TYPES, YES, is_number, key_of

MISSING_KEY, DUPLICATE_KEY = "MISSING_PRIMARY_KEY", "DUPLICATE_PRIMARY_KEY"


@dataclass(frozen=True)
class Cleaner:
    """How one raw table is cleaned; later steps see the columns of earlier ones, rules and flags those of all."""

    table: str
    steps: tuple[dict[str, Column], ...]
    rules: tuple[tuple[str, Column], ...] = ()
    flags: dict[str, Column] = field(default_factory=dict)

    @property
    def key(self) -> str:
        return key_of(self.table)

    @property
    def reasons(self) -> list[str]:
        return [MISSING_KEY, DUPLICATE_KEY, *dict.fromkeys(reason for reason, _ in self.rules)]


# --- the compiler ------------------------------------------------------------------------------------


def _named(raw: DataFrame, key: str) -> DataFrame:
    raw = raw.toDF(*[" ".join(c.split()) for c in raw.columns])
    if key not in raw.columns:
        raise ValueError(f"no key column {key}")
    return raw


def first_rows(raw: DataFrame, key: str) -> DataFrame:
    """Trimmed column names, the first row of each key that isn't missing: the rows of ``distinct_rows`` without an issue, moved once and not three times."""
    raw = _named(raw, key)
    rows = raw.select(S.text(F.col(key)).alias("_key"), F.struct(*raw.columns).alias("_row")).filter(F.col("_key") != "")
    firsts = rows.groupBy("_key").agg(F.min("_row").alias("_first"))
    return firsts.select(*[(F.col("_key") if c == key else F.col("_first")[c]).alias(c) for c in raw.columns])


def distinct_rows(raw: DataFrame, key: str) -> DataFrame:
    """Trimmed column names, each distinct row once with ``copies``, and base_issue: a missing key, or not the first row of its key."""
    raw = _named(raw, key)
    columns = raw.columns
    rows = raw.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).withColumn("_key", S.text(F.col(key)))
    blank, whole = F.col("_key") == "", F.struct(*columns)
    firsts = rows.filter(~blank).groupBy("_key").agg(F.min(whole).alias("_first"))
    issue = F.when(blank, MISSING_KEY).when(~whole.eqNullSafe(F.col("_first")), DUPLICATE_KEY)
    return rows.join(firsts, "_key", "left").withColumn("base_issue", issue).withColumn(key, F.col("_key")).drop("_key", "_first")


def mark(raw: DataFrame, cleaner: Cleaner) -> DataFrame:
    """The table's columns, copies, quality_issue (null for clean rows) and flags, a struct of counts of 0 or 1.

    Rows that the key rejects have no flags, and no other reason.
    """
    return _compiled(distinct_rows(raw, cleaner.key), cleaner)


def clean(raw: DataFrame, cleaner: Cleaner) -> DataFrame:
    """The clean rows alone, as ``clean_rows`` has them of the marked table."""
    rows = first_rows(raw, cleaner.key).withColumns({"copies": F.lit(1), "base_issue": F.lit(None).cast("string")})
    return clean_rows(_compiled(rows, cleaner), cleaner.table)


def _compiled(rows: DataFrame, cleaner: Cleaner) -> DataFrame:
    rows = rows.withColumns({c: S.composed(F.col(c)) for c, kind in rows.dtypes if kind == "string" and c not in (cleaner.key, "base_issue")})
    for step in cleaner.steps:
        rows = rows.withColumns(step)
    reason = F.col("base_issue")
    for name, broken in cleaner.rules:
        reason = F.coalesce(reason, F.when(F.coalesce(broken, F.lit(True)), name))
    counted = [F.when(F.col("base_issue").isNull() & F.coalesce(c, F.lit(False)), 1).otherwise(0).alias(n) for n, c in cleaner.flags.items()]
    schema = TABLES[cleaner.table]
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema], "copies", reason.alias("quality_issue"), F.struct(*counted or [F.lit(0).alias("none")]).alias("flags"))


def clean_rows(marked: DataFrame, table: str) -> DataFrame:
    return fill_blanks(marked.filter(F.col("quality_issue").isNull()).select(*TABLES[table].fieldNames()), TABLES[table])


def quarantined(marked: DataFrame, table: str) -> DataFrame:
    """table, key, quality_issue, copies of rejected rows."""
    return marked.filter(F.col("quality_issue").isNotNull()).select(F.lit(table).alias("table"), F.col(key_of(table)).alias("key"), "quality_issue", "copies")


def _sums(cleaner: Cleaner) -> dict[str, Column]:
    own = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    out = {"rows_raw": own(F.col("copies")), "exact_duplicates": own(F.col("copies") - 1), "rows_clean": own(F.when(F.col("quality_issue").isNull(), 1).otherwise(0))}
    out |= {r: own(F.when(F.col("quality_issue") == r, 1).otherwise(0)) for r in cleaner.reasons}
    return out | {n: own(F.col(f"flags.{n}")) for n in cleaner.flags}


def counters(marked: DataFrame, cleaner: Cleaner) -> DataFrame:
    """table, counter, n: raw, duplicate and clean rows, rows by reason, and flags; one aggregation."""
    sums = _sums(cleaner)
    return marked.agg(*[c.alias(n) for n, c in sums.items()]).unpivot([], list(sums), "counter", "n").select(F.lit(cleaner.table).alias("table"), "counter", "n")


def write(marked: DataFrame, cleaner: Cleaner, path: str) -> dict[str, int]:
    """Writes clean rows and quarantine under ``part=clean`` and ``part=quarantine``, and returns the counters of that very scan."""
    seen = Observation(f"clean_{cleaner.table}")
    part = F.when(F.col("quality_issue").isNull(), "clean").otherwise("quarantine")
    observed = marked.observe(seen, *[c.alias(n) for n, c in _sums(cleaner).items()])
    observed.drop("flags").withColumn("part", part).write.mode("overwrite").partitionBy("part").parquet(path)
    return {k: int(v) for k, v in seen.get.items()}


# --- sentinels and blanks ----------------------------------------------------------------------------


def sentinel(column: Column, *cases: tuple[Column, str]) -> Column:
    """A text with the no-data word where blank; of blank ones, the word of the first case that holds."""
    out = F.lit(NO_DATA)
    for holds, word in reversed(cases):
        out = F.when(F.coalesce(holds, F.lit(False)), word).otherwise(out)
    blank = F.trim(F.coalesce(column.cast("string"), F.lit(""))) == ""
    return F.when(blank | (column == NO_DATA), out).otherwise(column)


def fill_blanks(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` without nulls or blanks: numbers become 0, text the no-data word. Other columns stay as they are."""
    fills = {}
    for f in schema:
        if f.name not in df.columns:
            continue
        if is_number(f):
            fills[f.name] = F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType))
        else:
            fills[f.name] = sentinel(F.col(f.name))
    return df.withColumns(fills) if fills else df


# --- the tables --------------------------------------------------------------------------------------


def _yes(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit(False)), YES).otherwise(NO)


def _bool(c: Column, missing: str = NO_DATA) -> Column:
    value = S.boolean(S.text(c))
    return F.when(value, YES).when(~value, NO).otherwise(missing)


def _upper(c: Column) -> Column:
    return F.upper(S.text(c))


def _time(c: Column, missing: str = NO_DATA) -> Column:
    return F.coalesce(S.utc_text(S.text(c)), F.lit(missing))


def _whole(c: Column, low: int | None = 0) -> Column:
    """A whole number, half to even; with ``low`` 0 where it is none, and held to it."""
    value = F.rint(S.text(c).try_cast("double")).cast("long")
    return value if low is None else F.greatest(F.coalesce(value, F.lit(0)), F.lit(low))


def _contacts(email: str = "email", phone: str = "phone") -> tuple[dict[str, Column], dict[str, Column], dict[str, Column]]:
    """(parsed structs, columns, flags) of an address and a number."""
    e, p = F.col("_email"), F.col("_phone")
    columns = {"email": e["value"], "email_valid": _yes(~e["invalid"]), "phone": p["value"], "phone_valid": _yes(~p["invalid"] & ~p["missing"])}
    flags = {f"email_{k}": e[k] for k in ("upper_case", "plus_alias", "domain_typo", "invalid")} | {f"phone_{k}": p[k] for k in ("formatted", "missing", "invalid")}
    return {"_email": S.email(F.col(email)), "_phone": S.phone(F.col(phone))}, columns, flags


def _name_keys(name: str) -> dict[str, Column]:
    known = F.when(F.col(name) != NO_DATA, F.col(name)).otherwise("")
    return {"name_match_key": sentinel(S.match_key(known)), "name_tokens_key": sentinel(S.token_key(known))}


def member() -> Cleaner:
    """Members: names in capitals, contacts, one key a name, membership dates; two identity fields at least."""
    parsed, contacts, flags = _contacts()
    present = lambda c: (F.col(c) != NO_DATA).cast("long")
    steps = (
        {**parsed, "_first": S.text(F.col("first_name")), "_last": S.text(F.col("last_name"))},
        {**contacts, "first_name": sentinel(F.upper("_first")), "last_name": sentinel(F.upper("_last")), "city": sentinel(_upper(F.col("city"))), "full_name": sentinel(S.text(F.concat_ws(" ", F.upper("_first"), F.upper("_last"))))},
        {**_name_keys("full_name"), "created_at": _time(F.col("created_at")), "has_membership": _bool(F.col("has_membership")), "membership_since": _time(F.col("membership_since")), "points": _whole(F.col("points"))},
        {"membership_since": sentinel(F.col("membership_since"), (F.col("has_membership") == NO, NOT_APPLICABLE)), "identity_fields": present("full_name") + present("email") + present("phone") + present("city")},
    )
    flags = {"names_uppercased": F.col("_first") != F.col("first_name"), "last_names_uppercased": F.col("_last") != F.col("last_name"), **flags}
    return Cleaner("member", steps, (("INSUFFICIENT_IDENTITY", F.col("identity_fields") < 2),), flags)


def history(as_of: str, mature_until: str) -> Cleaner:
    """Members' own tickets: required fields, and what must not be learned from: uses after ``as_of``, tickets after ``mature_until``. Both as ISO."""
    steps = (
        {"member_id": S.text(F.col("member_id")), "type": _upper(F.col("type")), "source": _upper(F.col("source")), "created_at": _time(F.col("created_at")), "used": _bool(F.col("used")), "date_used": _time(F.col("date_used"))},
        {"date_used": sentinel(F.col("date_used"), (F.col("used") == NO, NOT_APPLICABLE))},
        {"future_use": _yes((F.col("used") == YES) & ~F.col("date_used").isin(NO_DATA, NOT_APPLICABLE) & (F.col("date_used") > as_of))},
        {"eligible": _yes((F.col("created_at") != NO_DATA) & (F.col("created_at") <= mature_until) & (F.col("future_use") == NO))},
    )
    missing = F.lit(False)
    for c in ("member_id", "type", "source", "created_at", "used"):
        missing = missing | F.col(c).isin("", NO_DATA)
    broken = missing | ((F.col("used") == YES) & (F.col("date_used") == NO_DATA)) | ~F.col("type").isin(*MEMBER_TICKET_TYPES) | ~F.col("source").isin(*MEMBER_TICKET_SOURCES)
    return Cleaner("history", steps, (("INVALID_REQUIRED_FIELD", broken),), {"future_use_flagged": (F.col("future_use") == YES) & ~broken, "mature_rows": (F.col("eligible") == YES) & ~broken})


def social() -> Cleaner:
    return Cleaner("social", ({"friends_count": _whole(F.col("friends_count"))},))


def artist() -> Cleaner:
    """Artists; without a residency its venue and weekday don't apply."""
    none = F.col("has_residency") == NO
    steps = (
        {"name": sentinel(_upper(F.col("name"))), "home_city": sentinel(_upper(F.col("home_city"))), "has_residency": _bool(F.col("has_residency")), "tickets_sold": _whole(F.col("tickets_sold")),
         "attendance_rate": F.least(F.greatest(F.coalesce(S.text(F.col("attendance_rate")).try_cast("double"), F.lit(0.0)), F.lit(0.0)), F.lit(1.0))},
        {c: F.when(none, NOT_APPLICABLE).otherwise(sentinel(_upper(F.col(c)))) for c in ("residency_venue", "residency_weekday")},
    )
    return Cleaner("artist", steps, (), {"no_residency": none})


def event() -> Cleaner:
    """Events; what a coming month will show is not observed, without a residency its venue doesn't apply."""
    upcoming, count = F.col("month") == NEXT_MONTH, _whole(F.col("checked_in_count"), None)
    steps = (
        {c: sentinel(_upper(F.col(c))) for c in ("title", "city", "venue", "weekday", "month")} | {"artist_id": S.text(F.col("artist_id")), "is_residency": _bool(F.col("is_residency")), "starts_at": _time(F.col("starts_at")), "capacity": _whole(F.col("capacity"))},
        {"residency_venue": F.when(F.col("is_residency") == NO, NOT_APPLICABLE).otherwise(sentinel(_upper(F.col("residency_venue")))), "checked_in_count": F.when(upcoming, NOT_OBSERVED).otherwise(F.coalesce(count, F.lit(0)).cast("string"))},
    )
    return Cleaner("event", steps, (), {"unobserved": upcoming})


def sale() -> Cleaner:
    """Sales: contacts, name keys, and the first of eight rules that a sale breaks."""
    parsed, contacts, flags = _contacts()
    present = lambda c: (F.col(c) != NO_DATA).cast("long")
    steps = (
        {**parsed, "_name": S.text(F.col("buyer_name"))},
        {**contacts, "buyer_name": sentinel(F.upper("_name")), "event_id": S.text(F.col("event_id")), "qty": _whole(F.col("qty"), None), "subtotal": _whole(F.col("subtotal"), None), "channel": _upper(F.col("channel")), "purchased_at": _time(F.col("purchased_at"))},
        {**_name_keys("buyer_name"), "identity_fields": present("buyer_name") + present("email") + present("phone")},
    )
    rules = (
        ("INSUFFICIENT_IDENTITY", F.col("identity_fields") == 0), ("MISSING_QUANTITY", F.col("qty").isNull()), ("BAD_QUANTITY", F.col("qty") < 1), ("MISSING_SUBTOTAL", F.col("subtotal").isNull()),
        ("BAD_SUBTOTAL", F.col("subtotal") < 0), ("BAD_CHANNEL", ~F.col("channel").isin(*CHANNELS)), ("MISSING_EVENT", F.col("event_id") == ""), ("MISSING_DATE", F.col("purchased_at") == NO_DATA),
    )
    return Cleaner("sale", steps, rules, {"names_uppercased": F.col("_name") != F.col("buyer_name"), **flags})


def ticket() -> Cleaner:
    """Tickets: a label of yes, no or not observed; an entry needs a time."""
    steps = (
        {"sale_id": S.text(F.col("sale_id")), "event_id": S.text(F.col("event_id")), "ticket_type": _upper(F.col("ticket_type")), "price": _whole(F.col("price"), None), "checked_in": _bool(F.col("checked_in"), NOT_OBSERVED), "checked_in_at": _time(F.col("checked_in_at"))},
        {"checked_in_at": sentinel(F.col("checked_in_at"), (F.col("checked_in") == NOT_OBSERVED, NOT_OBSERVED), (F.col("checked_in") == NO, NOT_APPLICABLE))},
    )
    rules = (
        ("MISSING_PARENT", (F.col("sale_id") == "") | (F.col("event_id") == "")), ("BAD_TYPE", ~F.col("ticket_type").isin(*TICKET_TYPES)), ("MISSING_PRICE", F.col("price").isNull()), ("BAD_PRICE", F.col("price") < 0),
        ("ENTRY_WITHOUT_TIME", (F.col("checked_in") == YES) & F.col("checked_in_at").isin(NO_DATA, NOT_APPLICABLE, NOT_OBSERVED)),
    )
    return Cleaner("ticket", steps, rules, {"unobserved": F.col("checked_in") == NOT_OBSERVED})


# --- integrity ---------------------------------------------------------------------------------------

#: References in the order in which they are enforced: a row has the first that it breaks.
CASCADE = (
    ("social", "member_id", "member", "ORPHAN_MEMBER"), ("history", "member_id", "member", "ORPHAN_MEMBER"), ("event", "artist_id", "artist", "ORPHAN_ARTIST"), ("sale", "event_id", "event", "ORPHAN_EVENT"),
    ("ticket", "event_id", "event", "ORPHAN_EVENT"), ("ticket", "sale_id", "sale", "ORPHAN_SALE"),
)


def cascade_columns(table: str, rules: tuple[tuple[str, str, str, str], ...] = CASCADE) -> list[str]:
    """The columns of a table that the cascade reads: its key, its references, and the event of tickets and sales."""
    own = [key_of(table), *[column for t, column, *_ in rules if t == table], *(["event_id"] if table in ("ticket", "sale") else [])]
    return list(dict.fromkeys(own))


def integrity_cascade(frames: dict[str, DataFrame], rules: tuple[tuple[str, str, str, str], ...] = CASCADE) -> dict[str, DataFrame]:
    """Tables with quality_issue, the first reference that a row breaks; last, tickets whose event isn't that of their sale.

    Parents are those before the first rule: an event that loses its artist still keeps its sales. The rule on events of
    sales sees only sales that kept their place, so a ticket of an orphaned sale isn't held against it. Each table is one
    plan: a left join for each reference, on keys that occur once.
    """
    parents = {t: frames[t].select(F.col(key_of(t)).alias("_parent")).distinct() for t in {r[2] for r in rules}}
    out = {}
    for name, df in frames.items():
        issue = F.lit(None).cast("string")
        for k, (_, column, parent, reason) in enumerate(r for r in rules if r[0] == name):
            known = parents[parent].select(F.col("_parent").alias(f"_p{k}"))
            df = df.join(known, F.col(column) == F.col(f"_p{k}"), "left")
            issue = F.coalesce(issue, F.when(F.col(f"_p{k}").isNull(), reason))
        out[name] = df.withColumn("quality_issue", issue).drop(*[c for c in df.columns if c.startswith("_p") and c[2:].isdigit()])
    if "ticket" in out and "sale" in out:
        of_sale = out["sale"].filter("quality_issue is null").groupBy(F.col("sale_id").alias("_sale")).agg(F.min("event_id").alias("_event"))
        marked = out["ticket"].join(of_sale, F.col("sale_id") == F.col("_sale"), "left")
        mismatch = F.when(F.col("_event") != F.col("event_id"), "SALE_EVENT_MISMATCH")
        out["ticket"] = marked.withColumn("quality_issue", F.coalesce("quality_issue", mismatch)).drop("_sale", "_event")
    return out


def quarantine_of(marked: dict[str, DataFrame]) -> DataFrame:
    """table, key, quality_issue of all rows that have one."""
    out = None
    for name, df in marked.items():
        one = df.filter("quality_issue is not null").select(F.lit(name).alias("table"), F.col(key_of(name)).cast("string").alias("key"), "quality_issue")
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no tables")
    return out
