"""The registered queries: each applies operators of the library to the roles over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import similarity as M
from ..operators import analytics, cleaning, features, matching, modeling, quality, simulate, summaries, verify
from ..operators.merges import shuffled
from ..operators.resource import resource, search
from ..schema import CHANNELS, TABLES, TICKET_TYPES, WEEKDAYS
from ..stored import once
from .roles import role, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
AS_OF, MATURE = "2024-01-28 12:00:00", "2024-01-20 23:59:59"


def query(f: Callable) -> Callable:
    QUERIES[f.__name__] = f
    return f


class Roles:
    """The roles of one session and folder, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return role(self.spark, self.sf_dir, name)

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def profile(self) -> DataFrame:
        return summaries.member_profile(self.member, self.history, self.social)

    def summary(self) -> DataFrame:
        return summaries.event_summary(self.event, self.artist, self.ticket)

    def past_events(self) -> DataFrame:
        return self.event.filter(~F.col("is_upcoming"))

    def past_tickets(self) -> DataFrame:
        return self.ticket.join(self.past_events().select("event_id"), "event_id", "left_semi")

    def rows(self) -> DataFrame:
        past = self.past_tickets()
        return analytics.event_rows(self.past_events(), past, analytics.rate_by_type(past))

    def labelled(self) -> DataFrame:
        return self.ticket.filter(F.col("checked_in").isNotNull()).select("ticket_id", "event_id", "ticket_type", "price", F.col("checked_in").cast("int").alias("label"))

    def named_sales(self) -> DataFrame:
        return self.sale.withColumn("name_key", S.token_key(F.col("buyer_name")))


# --- resources -------------------------------------------------------------------------------------


@query
def res_eq_filter(spark, d):
    r = Roles(spark, d)
    return resource("members", "tickets").where(r.history, type="MEMBRESIA", used=True).select("member_ticket_id", "member_id")


@query
def res_ilike(spark, d):
    return resource("members", "profile").where(Roles(spark, d).member, name="ana*").select("member_id", "full_name")


@query
def res_gte(spark, d):
    return resource("members", "profile").where(Roles(spark, d).profile(), min_use_rate=0.5, min_tickets=2).select("member_id", "tickets_total", "use_rate")


@query
def res_page_ordered(spark, d):
    r = Roles(spark, d)
    return resource("sales", "sales").query(r.sale, columns="sale_id,event_id,subtotal", order="subtotal.desc", limit=50, offset=20, channel="WEB")


@query
def res_count(spark, d):
    return resource("sales", "tickets").count(Roles(spark, d).ticket, ticket_type="VIP")


@query
def res_csv_lines(spark, d):
    return resource("sales", "events").csv(Roles(spark, d).event.select("event_id", "title", "city", "venue"))


@query
def search_fold(spark, d):
    return search(Roles(spark, d).event, "bogotA", ["title", "city", "venue"]).select("event_id", "city")


@query
def search_city(spark, d):
    r = Roles(spark, d)
    named = r.event.join(r.artist.select("artist_id", "name"), "artist_id")
    return search(named, "supplier", ["title", "city", "venue", "name"], city="Cali").filter(F.col("capacity").between(30, 120)).select("event_id", "title", "city", "name", "capacity")


# --- summaries -------------------------------------------------------------------------------------


@query
def view_member_profile(spark, d):
    return Roles(spark, d).profile().select("member_id", "city", "tickets_total", "tickets_used", "use_rate", "last_used_at", "friends_count")


@query
def view_event_summary(spark, d):
    return Roles(spark, d).summary()


@query
def view_artist_summary(spark, d):
    r = Roles(spark, d)
    return summaries.artist_summary(r.artist, r.summary())


@query
def union_counts(spark, d):
    r = Roles(spark, d)
    one = lambda n: getattr(r, n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("relation"), "n")
    return one("member").unionByName(one("sale")).unionByName(one("ticket"))


# --- scalar functions ------------------------------------------------------------------------------


@query
def clean_text(spark, d):
    return Roles(spark, d).table("documents").select("doc_id", F.md5(S.text(S.composed(F.col("text")))).alias("text_md5"))


@query
def match_key(spark, d):
    return Roles(spark, d).table("documents").select("doc_id", F.md5(S.match_key(F.col("text"))).alias("key_md5"))


@query
def token_key(spark, d):
    return Roles(spark, d).table("conversations").select("conv_id", "turn", F.md5(S.token_key(F.col("text"))).alias("key_md5"))


def _dirty(r: Roles) -> DataFrame:
    e, k = F.col("email"), F.col("member_id") % 6
    dirty = F.when(k == 0, F.upper(e)).when(k == 1, F.concat(F.lit(" mailto:"), e)).when(k == 2, F.replace(e, F.lit("@"), F.lit("+club@"))).when(k == 3, F.replace(e, F.lit("mail.com"), F.lit("gmial.com"))).when(k == 4, F.replace(e, F.lit("@"), F.lit("@@"))).otherwise(e)
    p = F.col("phone")
    dialled = F.when(k == 0, F.concat(F.lit("+57 "), p)).when(k == 1, F.concat_ws("-", F.substring(p, 1, 3), F.substring(p, 4, 7))).when(k == 2, F.lit("")).when(k == 3, F.substring(p, 2, 9)).otherwise(p)
    return r.member.select("member_id", dirty.alias("email"), dialled.alias("phone"))


@query
def email_normalize(spark, d):
    return _dirty(Roles(spark, d)).select("member_id", S.email(F.col("email")).alias("e")).select("member_id", "e.*")


@query
def phone_normalize(spark, d):
    return _dirty(Roles(spark, d)).select("member_id", S.phone(F.col("phone")).alias("p")).select("member_id", "p.*")


@query
def bool_normalize(spark, d):
    word = F.element_at(F.array(*map(F.lit, ("Sí", "true", "0", "no", "x", " YES "))), (F.col("member_id") % 6 + 1).cast("int"))
    return Roles(spark, d).member.select("member_id", S.boolean(word).alias("flag"))


@query
def ts_normalize(spark, d):
    t = F.date_format("starts_at", "yyyy-MM-dd HH:mm:ss")
    return Roles(spark, d).event.select("event_id", S.utc_text(F.when(F.col("event_id") % 4 == 0, "soon").otherwise(t)).alias("iso"))


@query
def identity_score(spark, d):
    return Roles(spark, d).sale.select("sale_id", S.identity_score(F.col("buyer_name").isNotNull(), F.col("email").isNotNull(), F.col("phone").isNotNull()).alias("score"))


@query
def handle_normalize(spark, d):
    return Roles(spark, d).member.select("member_id", S.handle(F.concat(F.lit("  @"), F.col("full_name"), F.lit("_"), F.col("email"))).alias("handle"))


@query
def share_link(spark, d):
    e = F.col("event_id")
    link = S.share_link(e, e % 5, e % 3, e % 2, F.lit(0))
    return Roles(spark, d).event.select("event_id", link.alias("link"), S.parse_share_link(link).alias("x")).select("event_id", "link", F.col("x.c").alias("c"), F.col("x.m").alias("m"), F.col("x.k").alias("k"))


@query
def lead_time(spark, d):
    r = Roles(spark, d)
    own = r.ticket.join(r.sale.select("sale_id", "purchased_at"), "sale_id")
    lead = features.lead_features(F.col("purchased_at"), F.col("starts_at"))
    return own.select("ticket_id", *[lead[c].alias(c) for c in ("lead_hours", "lead_days", "start_hour", "day_of_month", "week_of_month", "weekday_number", "is_weekend")])


# --- quality ---------------------------------------------------------------------------------------


@query
def profile_numeric(spark, d):
    out = quality.numeric_profile(Roles(spark, d).table("lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return out.select("column_name", "n", "n_distinct", "outliers", *[S.rounded(F.col(c), 3).alias(c) for c in ("low", "q1", "median", "q3", "high")])


@query
def profile_blanks(spark, d):
    return quality.blanks(Roles(spark, d).sale.select("buyer_name", "email", "phone", "channel"))


@query
def category_counts(spark, d):
    return quality.categories(Roles(spark, d).ticket, ["ticket_type", "checked_in", "sale_id"])


@query
def exact_dedup(spark, d):
    return quality.exact_duplicates(Roles(spark, d).ticket.select("sale_id", "ticket_type", "checked_in"))


@query
def dup_pk_quarantine(spark, d):
    t = Roles(spark, d).ticket
    order = [F.col(c).asc() for c in ("event_id", "price", "ticket_type", "minutes_from_start", "starts_at")]
    return quality.key_quarantine(t, ["ticket_id"], order).groupBy("ticket_id").agg(F.count(F.lit(1)).alias("n"), F.count("quality_issue").alias("quarantined"), F.min(F.when(F.col("quality_issue").isNull(), F.col("event_id"))).alias("kept_event"))


@query
def orphan_quarantine(spark, d):
    r = Roles(spark, d)
    out = quality.orphans(r.ticket.select("ticket_id", "sale_id"), "sale_id", r.sale.filter("sale_id % 7 <> 0"), "sale_id")
    return out.filter("quality_issue is not null")


@query
def key_mismatch(spark, d):
    r = Roles(spark, d)
    return quality.key_mismatch(r.ticket.select("ticket_id", "sale_id", "event_id"), r.sale)


@query
def reconcile_sales(spark, d):
    r = Roles(spark, d)
    return quality.reconcile_sales(r.sale, r.ticket)


@query
def reconcile_events(spark, d):
    r = Roles(spark, d)
    return quality.reconcile_events(r.event, r.ticket)


@query
def reconcile_artists(spark, d):
    r = Roles(spark, d)
    events = quality.reconcile_events(r.event, r.ticket).join(r.event.select("event_id", "artist_id"), "event_id")
    return quality.reconcile_artists(r.artist, events)


def _flagged(r: Roles) -> DataFrame:
    return quality.leak_flags(r.history, AS_OF, MATURE)


@query
def leak_flags(spark, d):
    return _flagged(Roles(spark, d)).select("member_ticket_id", "future_use", "mature", "eligible")


@query
def leak_report(spark, d):
    return quality.leak_report(_flagged(Roles(spark, d)))


@query
def leak_examples(spark, d):
    return quality.leak_examples(_flagged(Roles(spark, d)), "member_ticket_id").select("member_ticket_id", "member_id", "date_used")


@query
def safe_history(spark, d):
    return quality.safe_history(_flagged(Roles(spark, d)))


@query
def train_score_split(spark, d):
    train, score = quality.train_score_split(Roles(spark, d).ticket)
    tag = lambda df, name: df.groupBy("ticket_type").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("revenue")).withColumn("part", F.lit(name))
    return tag(train, "train").unionByName(tag(score, "score"))


@query
def sale_validity(spark, d):
    return Roles(spark, d).sale.withColumn("issue", quality.sale_issue(CHANNELS)).groupBy("issue").agg(F.count(F.lit(1)).alias("n"))


@query
def ticket_validity(spark, d):
    t = Roles(spark, d).ticket.withColumn("checked_in_at", F.when(F.col("sale_id") % 3 == 0, F.col("starts_at")))
    return t.withColumn("issue", quality.ticket_issue(TICKET_TYPES)).groupBy("issue").agg(F.count(F.lit(1)).alias("n"))


@query
def verify_checks(spark, d):
    r = Roles(spark, d)
    lost = r.ticket.join(r.sale, "sale_id", "left_anti")
    groups = r.member.groupBy("member_id").agg(F.count(F.lit(1)).alias("n"))
    return quality.checks(
        member_key_unique=(groups, F.col("n") == 1), ticket_has_sale=(lost, F.lit(False)), price_not_negative=(r.ticket, F.col("price") >= 0), upcoming_unlabelled=(r.ticket.join(r.event, "event_id"), ~F.col("is_upcoming") | F.col("checked_in").isNull()), channel_known=(r.sale, F.col("channel").isin(*CHANNELS))
    )


# --- cleaning --------------------------------------------------------------------------------------

AS_OF_ISO, MATURE_ISO = "2024-01-28T12:00:00Z", "2024-01-20T23:59:59Z"


def _cleaners() -> dict[str, cleaning.Cleaner]:
    own = (cleaning.member(), cleaning.history(AS_OF_ISO, MATURE_ISO), cleaning.social(), cleaning.artist(), cleaning.event(), cleaning.sale(), cleaning.ticket())
    return {c.table: c for c in own}


def _marked(r: Roles, table: str) -> DataFrame:
    return cleaning.mark(getattr(r, f"raw_{table}"), _cleaners()[table])


def _cleaned(r: Roles, table: str) -> DataFrame:
    return cleaning.clean(getattr(r, f"raw_{table}"), _cleaners()[table])


def _clean(r: Roles) -> dict[str, DataFrame]:
    """Every table cleaned, each computed once."""
    return {t: once(_cleaned(r, t)) for t in TABLES}


def _register_cleaners() -> None:
    for name in TABLES:
        QUERIES[f"clean_{name}"] = lambda spark, d, name=name: _marked(Roles(spark, d), name).drop("flags")


_register_cleaners()


@query
def clean_counters(spark, d):
    r, out = Roles(spark, d), None
    for name, cleaner in _cleaners().items():
        one = cleaning.counters(_marked(r, name), cleaner)
        out = one if out is None else out.unionByName(one)
    return out


@query
def clean_quarantine(spark, d):
    r, out = Roles(spark, d), None
    for name in TABLES:
        one = cleaning.quarantined(_marked(r, name), name)
        out = one if out is None else out.unionByName(one)
    return out.groupBy("table", "quality_issue").agg(F.count(F.lit(1)).alias("rows"), F.sum("copies").alias("copies"), F.min("key").alias("first_key"), F.max("key").alias("last_key"))


@query
def sentinel_fill(spark, d):
    """Events whose blanks a schema fills: coming counts are not observed, venues without residency don't apply."""
    e = Roles(spark, d).raw_event
    counted = cleaning.sentinel(F.col("checked_in_count"), (F.upper("month") == "AGOSTO", "NO_OBSERVADO"))
    venue = cleaning.sentinel(F.col("residency_venue"), (F.col("is_residency") == "false", "NO_APLICA"))
    filled = cleaning.fill_blanks(e.withColumns({"checked_in_count": counted, "residency_venue": venue, "capacity": F.col("capacity").try_cast("long")}), TABLES["event"])
    return filled.select("event_id", "city", "weekday", "starts_at", "capacity", "checked_in_count", "residency_venue")


@query
def integrity_cascade(spark, d):
    r = Roles(spark, d)
    keys = {t: once(_cleaned(r, t).select(*cleaning.cascade_columns(t))) for t in TABLES}
    return cleaning.quarantine_of(cleaning.integrity_cascade(keys))


def _intact(r: Roles) -> dict[str, DataFrame]:
    """Tables after cleaning and the cascade, each computed once."""
    marked = cleaning.integrity_cascade(_clean(r))
    return {t: once(df.filter("quality_issue is null").drop("quality_issue")) for t, df in marked.items()}


def _domain_checks() -> list[verify.Check]:
    """Rules over rows and groups that no single field's metadata can say."""
    c = F.col
    consistent = lambda name, table, keys, of: verify.GroupCheck(table, name, keys, F.count_distinct(of) <= 1)
    return [
        verify.GroupCheck("history", "two tickets at most for a member and day", ("member_id", "created_at"), F.count(F.lit(1)) <= 2),
        consistent("a contact has one name", "sale", ("email", "phone"), "name_tokens_key"),
        consistent("a name of a contact has one channel", "sale", ("email", "phone", "name_tokens_key"), "channel"),
        consistent("a sale's tickets are of one event", "ticket", ("sale_id",), "event_id"),
        verify.GroupCheck("ticket", "four tickets at most for a sale", ("sale_id",), F.count(F.lit(1)) <= 4),
        verify.RowCheck("ticket", "an entry has a time", (c("checked_in") != "TRUE") | ~c("checked_in_at").isin("SIN_DATO", "NO_APLICA", "NO_OBSERVADO")),
        verify.RowCheck("event", "a coming event is not observed", (c("month") != "AGOSTO") | (c("checked_in_count") == "NO_OBSERVADO")),
        verify.RowCheck("history", "no use in the future is learned from", (c("eligible") != "TRUE") | (c("future_use") == "FALSE")),
        verify.RowCheck("history", "only mature tickets are learned from", (c("eligible") != "TRUE") | (c("created_at") <= MATURE_ISO)),
        verify.RowCheck("member", "a valid address is one", (c("email_valid") == "TRUE") == (c("email") != "SIN_DATO")),
        verify.RowCheck("sale", "a valid number is one", (c("phone_valid") == "TRUE") == (c("phone") != "SIN_DATO")),
    ]


@query
def verify_clean(spark, d):
    """All checks over tables that are cleaned but not yet cut by the cascade: references fail where parents are missing."""
    return verify.run(_clean(Roles(spark, d)), [*verify.schema_checks(), *_domain_checks()])


@query
def verify_intact(spark, d):
    """The same checks after the cascade, by kind: what a release of the tables rests on."""
    out = verify.run(_intact(Roles(spark, d)), [*verify.schema_checks(), *_domain_checks()])
    kind = F.element_at(F.split("check", " "), -1)
    return out.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("checks"), F.sum(F.col("passed").cast("int")).alias("passed"), F.sum("failing").alias("failing"))


# --- matching --------------------------------------------------------------------------------------


@query
def sig_explode(spark, d):
    # a row's signatures are counted in it: texts have no place in a hash aggregation's buffer, so all of them exploded would be sorted
    own = Roles(spark, d).member.filter(F.length("email") > 0).select("member_id", M.deletion_signatures(F.col("email")).alias("s"))  # others have none
    own = own.select("member_id", F.size("s").cast("long").alias("n"), F.array_min("s").alias("first"), F.array_max("s").alias("last"))
    return own.groupBy("member_id").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"))


@query
def osa_join(spark, d):
    r = Roles(spark, d)
    return matching.email_candidates(r.sale, r.member)


@query
def swap_join(spark, d):
    r = Roles(spark, d)
    return matching.phone_candidates(r.sale, r.member)


@query
def er_candidates(spark, d):
    r = Roles(spark, d)
    return matching.score_candidates(r.sale, r.member, ratio=False)


@query
def er_candidates_ratio(spark, d):
    r = Roles(spark, d)
    return matching.score_candidates(r.sale, r.member)


@query
def er_confidence(spark, d):
    """How often candidates have each triple of scores, and what the decision table makes of it."""
    r = Roles(spark, d)
    e, p, n = F.col("email_score"), F.col("phone_score"), F.col("name_score")
    kinds = matching.score_candidates(r.sale, r.member, ratio=False).groupBy("email_score", "phone_score", "name_score").agg(F.count(F.lit(1)).alias("pairs"))
    return kinds.select("email_score", "phone_score", "name_score", "pairs", matching.confidence(e, p, n).alias("confidence"), matching.method(e, p, n).alias("method"))


def _decided(r: Roles, ratio: bool) -> tuple[DataFrame, DataFrame]:
    scored = once(matching.score_candidates(r.sale, r.member, ratio))
    return scored, matching.decide(r.sale, scored)


def _resolved(r: Roles, ratio: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(diagnoses before aliases, diagnoses after, all candidates), each computed once."""
    scored = once(matching.score_candidates(r.sale, r.member, ratio))
    diagnosed = once(matching.diagnose(r.sale, scored))
    after, candidates = matching.apply_aliases(r.named_sales(), diagnosed, scored)
    return diagnosed, once(after), candidates


def matched(f: Callable[[Roles, bool], DataFrame]) -> Callable[[Roles, bool], DataFrame]:
    """Registers a query on decisions by the whole name score, and as ``_rules`` by its rules alone, which SQL can express."""
    QUERIES[f.__name__] = lambda spark, d: f(Roles(spark, d), True)
    QUERIES[f"{f.__name__}_rules"] = lambda spark, d: f(Roles(spark, d), False)
    return f


@matched
def er_decision(r, ratio):
    return _decided(r, ratio)[1]


@matched
def match_report(r, ratio):
    return matching.match_report(_decided(r, ratio)[1])


@matched
def unmatched_buyers(r, ratio):
    return matching.unmatched(r.sale, _decided(r, ratio)[1])


@matched
def alias_unique(r, ratio):
    scored, decided = _decided(r, ratio)
    return matching.learn_aliases(r.named_sales(), scored, decided, "email")


@matched
def alias_vote(r, ratio):
    scored, decided = _decided(r, ratio)
    sales = r.named_sales()
    learn = lambda contact: matching.learn_aliases(sales, scored, decided, contact)
    return matching.vote_aliases(sales, decided, learn("email"), learn("phone"), scored)


@matched
def candidate_probability(r, ratio):
    scored, decided = _decided(r, ratio)
    rows = scored.select("sale_id", "member_id", "evidence_confidence", F.lit(1.0).alias("source_reliability"), F.lit("DIRECT_IDENTITY").alias("candidate_source"))
    return matching.probabilities(r.sale, rows, decided)


@matched
def match_diagnostics(r, ratio):
    scored = matching.score_candidates(r.sale, r.member, ratio)
    return matching.diagnose(r.sale, scored)


@matched
def alias_applied(r, ratio):
    return _resolved(r, ratio)[1]


@matched
def alias_report(r, ratio):
    before, after, _ = _resolved(r, ratio)
    return matching.alias_report(after, matching.alias_seeds(r.named_sales(), before))


@matched
def candidate_probability_all(r, ratio):
    _, after, candidates = _resolved(r, ratio)
    return matching.ranked_candidates(r.sale, candidates, after)


@matched
def unmatched_detail(r, ratio):
    _, after, candidates = _resolved(r, ratio)
    return matching.unmatched_detail(r.sale, after, matching.ranked_candidates(r.sale, candidates, after))


@matched
def method_report(r, ratio):
    return matching.method_report(_resolved(r, ratio)[1])


@query
def set_symdiff(spark, d):
    r = Roles(spark, d)
    a, b = r.sale.select("event_id").distinct(), r.ticket.select("event_id").distinct()
    return a.exceptAll(b).withColumn("side", F.lit("sale")).unionByName(b.exceptAll(a).withColumn("side", F.lit("ticket")))


@query
def distinct_sources(spark, d):
    r = Roles(spark, d)
    own = r.ticket.join(r.sale.select("sale_id", "channel"), "sale_id").groupBy("event_id").agg(F.array_join(F.array_sort(F.collect_set("channel")), "+").alias("sources"))
    return own


# --- features --------------------------------------------------------------------------------------


@query
def event_mix_pivot(spark, d):
    return features.event_mix(Roles(spark, d).ticket)


@query
def star_features(spark, d):
    r = Roles(spark, d)
    return features.star(r.ticket.drop("starts_at"), r.sale, r.event, features.event_mix(r.ticket))


@query
def star_guard(spark, d):
    r = Roles(spark, d)
    return features.missing_dimensions(r.ticket, r.sale.filter("sale_id % 7 <> 0"), r.event)


@matched
def weighted_profile(r, ratio):
    scored, decided = _decided(r, ratio)
    rows = scored.select("sale_id", "member_id", "evidence_confidence", F.lit(1.0).alias("source_reliability"), F.lit("DIRECT_IDENTITY").alias("candidate_source"))
    weights = matching.probabilities(r.sale, rows, decided).select("sale_id", F.col("member_id").try_cast("bigint").alias("member_id"), "model_history_weight").filter("member_id is not null")
    profile = r.profile().select("member_id", "use_rate", "tickets_total")
    return features.weighted_profile(weights, profile, features.profile_priors(profile))


def _profile(r: Roles) -> DataFrame:
    return r.profile().select("member_id", "use_rate", "tickets_total", "tickets_used", "friends_count", "has_membership", (F.col("member_id") % 500).alias("points"))


def _identity(r: Roles, ratio: bool) -> DataFrame:
    _, after, candidates = _resolved(r, ratio)
    ranked = once(matching.ranked_candidates(r.sale, candidates, after))
    return features.identity_features(r.sale, ranked, after, _profile(r))


@matched
def identity_features(r, ratio):
    return _identity(r, ratio)


def _training(r: Roles, ratio: bool, tickets: DataFrame) -> DataFrame:
    priors = features.measure_priors(features.measures(_profile(r)))
    return features.training_rows(tickets.drop("starts_at"), r.sale, r.event, features.event_mix(r.ticket), once(_identity(r, ratio)), priors)


@matched
def training_rows(r, ratio):
    return _training(r, ratio, r.ticket)


@query
def companion_shrink(spark, d):
    x = features.companion_shrink(F.col("subtotal") / 1000, F.lit(200.0), F.col("qty"))
    return Roles(spark, d).sale.select("sale_id", (F.rint(x * 1e6) / 1e6).alias("shrunk"))


@matched
def match_status(r, ratio):
    out = _decided(r, ratio)[1]
    return out.select("sale_id", features.match_status(F.col("decision") == "MATCH", F.col("match_weight")).alias("status"))


# --- models ----------------------------------------------------------------------------------------


@query
def smoothed_rate(spark, d):
    return modeling.smoothed_rates(Roles(spark, d).labelled(), ["ticket_type"]).withColumn("rate", F.rint(F.col("rate") * 1e6) / 1e6)


@query
def group_kfold(spark, d):
    return modeling.group_folds(Roles(spark, d).labelled(), "event_id")


def _oof(r: Roles) -> DataFrame:
    rows = r.labelled()
    by_type = modeling.oof_baseline(rows, modeling.group_folds(rows, "event_id"), "event_id", "ticket_type").withColumn("model", F.lit("type_rate"))
    flat = rows.withColumn("all", F.lit("x"))
    overall = modeling.oof_baseline(flat, modeling.group_folds(rows, "event_id"), "event_id", "all").drop("all").withColumn("model", F.lit("global_rate"))
    return by_type.unionByName(overall)


@query
def oof_baseline(spark, d):
    out = _oof(Roles(spark, d)).groupBy("model", "fold", "ticket_type").agg(F.count(F.lit(1)).alias("n"), F.max("p").alias("p"))
    return out.withColumn("p", F.rint(F.col("p") * 1e6) / 1e6)


@query
def metrics_ticket(spark, d):
    return modeling.ticket_metrics(_oof(Roles(spark, d)))


@query
def auc_rank(spark, d):
    return modeling.auc(_oof(Roles(spark, d)))


@query
def metrics_event(spark, d):
    return modeling.event_metrics(modeling.event_predictions(_oof(Roles(spark, d))))


@query
def model_rank(spark, d):
    scored = _oof(Roles(spark, d))
    events = modeling.event_metrics(modeling.event_predictions(scored)).select("model", "mae", "wape")
    return modeling.rank_models(events.join(modeling.ticket_metrics(scored).select("model", "brier"), "model"))


@query
def residual_interval(spark, d):
    return modeling.residual_interval(modeling.event_predictions(_oof(Roles(spark, d))))


def _forecast(r: Roles) -> DataFrame:
    rates = modeling.smoothed_rates(r.labelled(), ["ticket_type"]).select("ticket_type", F.col("rate").alias("p"))
    upcoming = r.ticket.filter(F.col("checked_in").isNull()).join(F.broadcast(rates), "ticket_type")
    interval = modeling.residual_interval(modeling.event_predictions(_oof(r).filter("model = 'type_rate'"))).drop("model")
    return modeling.forecast(upcoming, interval)


@query
def forecast_interval(spark, d):
    return _forecast(Roles(spark, d))


@query
def web_model(spark, d):
    return simulate.web_model(_forecast(Roles(spark, d))).withColumn("sd", F.rint(F.col("sd") * 1e6) / 1e6)


@query
def bootstrap_interval(spark, d):
    p = modeling.event_predictions(_oof(Roles(spark, d)))
    own = p.groupBy("event_id").agg((F.max(F.when(F.col("model") == "type_rate", F.abs("residual"))) - F.max(F.when(F.col("model") == "global_rate", F.abs("residual")))).alias("d"))
    return modeling.bootstrap(own.select(F.col("event_id").alias("id"), "d"))


@query
def paired_wins(spark, d):
    return modeling.paired_wins(modeling.event_predictions(_oof(Roles(spark, d))), "type_rate", "global_rate")


#: What the models learn from: the star of a ticket, and what is expected of its buyer.
CATEGORICAL = ["ticket_type", "channel", "match_status"]
NUMERIC = [
    "price", "qty", "issued", "share_3", "price_ratio", "remaining_capacity", "lead_hours", "weekday_number", "is_weekend", "is_residency", "top_probability", "no_match_probability",
    "ticket_identity_weight", "ticket_history_weight", *[f"expected_{m}" for m in features.MEASURES],
]


def _model_table(r: Roles) -> tuple[DataFrame, DataFrame]:
    """(labelled rows, rows to score), with all features; the rules alone decide on names."""
    every = once(_training(r, False, r.ticket).select("ticket_id", "event_id", *CATEGORICAL, *NUMERIC).join(shuffled(r.ticket.select("ticket_id", "event_id", "checked_in").distinct()), ["ticket_id", "event_id"]))
    label = F.col("checked_in").cast("int").alias("label")
    return every.filter("checked_in is not null").select(*every.drop("checked_in").columns, label), every.filter("checked_in is null").drop("checked_in")


def _folds(r: Roles, kind: str) -> modeling.Folds:
    rows = _model_table(r)[0]
    return modeling.fit_folds(rows, modeling.group_folds(rows, "event_id"), "event_id", kind, CATEGORICAL, NUMERIC)


@query
def ml_logistic_oof(spark, d):
    return _folds(Roles(spark, d), "logistic").scored


@query
def ml_boosted_oof(spark, d):
    return _folds(Roles(spark, d), "boosted").scored


def _final(r: Roles) -> tuple[modeling.PipelineModel, DataFrame, DataFrame, list[int]]:
    """(boosted model of all labelled rows with the folds' median of rounds, those rows, rows to score, the folds' rounds)."""
    rows, upcoming = _model_table(r)
    folds = modeling.fit_folds(rows, modeling.group_folds(rows, "event_id"), "event_id", "boosted", CATEGORICAL, NUMERIC)
    return modeling.final_fit(rows, "boosted", CATEGORICAL, NUMERIC, folds.final_rounds), rows, upcoming, folds.rounds


@query
def ml_final_fit(spark, d):
    """Upcoming events with the attendance that the final model expects, and the rounds that the folds chose."""
    fitted, _, upcoming, rounds = _final(Roles(spark, d))
    scored = modeling.score(fitted, upcoming, CATEGORICAL, NUMERIC)
    trees = F.lit(fitted.stages[-1].getNumTrees)
    return scored.groupBy("event_id").agg(F.count(F.lit(1)).alias("tickets"), F.sum("p").alias("expected")).withColumns({"trees": trees, "fold_rounds": F.lit("+".join(map(str, rounds)))})


@query
def feature_importance(spark, d):
    fitted, rows, _, _ = _final(Roles(spark, d))
    return modeling.feature_importance(fitted, rows, CATEGORICAL, NUMERIC)


# --- analytics -------------------------------------------------------------------------------------


@query
def rate_by_type(spark, d):
    return analytics.rate_by_type(Roles(spark, d).past_tickets())


@query
def member_rate(spark, d):
    return analytics.rate_by(Roles(spark, d).history, "type", F.col("used"))


@query
def event_rows(spark, d):
    out = Roles(spark, d).rows()
    return out.select("event_id", "issued", "attended", "courtesy", "mix_expected", "attendance_rate", "courtesy_share", "lift", S.rounded(F.col("variance"), 4).alias("variance"))


@query
def lift_shrunk(spark, d):
    return analytics.lift_by(Roles(spark, d).rows(), ["artist_id", "venue", "weekday"])


@query
def overdispersion(spark, d):
    return analytics.overdispersion(Roles(spark, d).rows())


@query
def ols_dilution(spark, d):
    rows = Roles(spark, d).rows()
    return analytics.dilution(rows, "attendance_rate").withColumn("y", F.lit("rate")).unionByName(analytics.dilution(rows, "lift").withColumn("y", F.lit("lift")))


@query
def cube_cuts(spark, d):
    return analytics.cuts(Roles(spark, d).rows(), ["city", "venue", "weekday", "is_residency"])


@query
def top_venues(spark, d):
    own = analytics.cuts(Roles(spark, d).rows(), ["venue"])
    return analytics.top(own, 12, "issued", "key").select("key", "issued", "rate")


@query
def weekday_order(spark, d):
    """Cuts by weekday in the order of the week."""
    day = F.element_at(F.array(*map(F.lit, WEEKDAYS)), F.col("weekday") + 1)
    own = analytics.cuts(Roles(spark, d).rows().withColumn("weekday", day), ["weekday"])
    return analytics.in_word_order(own, "key", WEEKDAYS).select("place", "key", "events", "issued", "rate")


@query
def fullest_events(spark, d):
    r = Roles(spark, d)
    return analytics.fullest(r.summary().join(r.event.select("event_id", "starts_at"), "event_id"), 15).select("event_id", "fill_rate", "starts_at")


@query
def channel_cut(spark, d):
    r = Roles(spark, d)
    return analytics.channel_cut(r.past_tickets(), r.sale)


@query
def arrival_curve(spark, d):
    return analytics.arrival_curve(Roles(spark, d).past_tickets().filter("checked_in"))


@query
def hist10(spark, d):
    return analytics.histogram(Roles(spark, d).rows(), "attendance_rate")


@query
def totals(spark, d):
    return analytics.totals(Roles(spark, d).rows())


@query
def no_shows(spark, d):
    r = Roles(spark, d)
    return analytics.no_shows(r.past_events(), r.past_tickets())


@query
def pearson(spark, d):
    return analytics.correlation(Roles(spark, d).rows(), "courtesy_share", "attendance_rate")


# --- simulation ------------------------------------------------------------------------------------


def _plans(r: Roles) -> DataFrame:
    """Upcoming events with mix, rates, lift, dispersion and levers that follow from the event's number."""
    mix = features.event_mix(r.ticket).select("event_id", "issued", "n_0", "n_1", "n_2", "n_3")
    rate = analytics.rate_by_type(r.past_tickets()).agg(*[F.max(F.when(F.col("ticket_type") == t, F.col("rate"))).alias(f"rate_{k}") for k, t in enumerate(TICKET_TYPES)])
    past = r.rows()
    lifts = analytics.lift_by(past, ["artist_id", "venue"])
    lift = lambda key: lifts.filter(F.col("dimension") == key).select(F.col("key").alias(f"k_{key}"), F.col("lift").alias(f"l_{key}"))
    e = r.event.filter("is_upcoming").join(mix, "event_id").join(F.broadcast(rate)).join(F.broadcast(analytics.overdispersion(past).select("phi")))
    e = e.join(lift("artist_id"), F.col("artist_id").cast("string") == F.col("k_artist_id"), "left").join(lift("venue"), F.col("venue") == F.col("k_venue"), "left")
    n = F.col("l_artist_id").isNotNull().cast("int") + F.col("l_venue").isNotNull().cast("int")
    e = e.withColumn("lift", F.when(n > 0, (F.coalesce("l_artist_id", F.lit(0.0)) + F.coalesce("l_venue", F.lit(0.0))) / n).otherwise(1.0))
    i = F.col("event_id")
    return e.withColumns(
        {"rate_membership": F.lit(0.5), "rate_consumption": F.lit(0.75), "courtesy": i % 10, "membership": i % 4, "consumption": i % 6, "converted": i % 3,
         "baseline": F.when(i % 4 == 1, F.col("issued") * 0.8), "baseline_sd": F.when(i % 4 == 1, F.lit(3.5))}
    ).select("event_id", "capacity", "issued", *[f"n_{k}" for k in range(4)], *[f"rate_{k}" for k in range(4)], "rate_membership", "rate_consumption", "lift", "phi", *simulate.LEVERS, "baseline", "baseline_sd")


@query
def project_levers(spark, d):
    return simulate.project(_plans(Roles(spark, d))).select("event_id", *simulate.PROJECTION)


@query
def sweep_volume(spark, d):
    return simulate.sweep_volume(_plans(Roles(spark, d))).select("event_id", "step", "x", "expected", "p10", "p90", "overflow_risk", "emitted")


@query
def sweep_split(spark, d):
    return simulate.sweep_split(_plans(Roles(spark, d))).select("event_id", "step", "expected", "p10", "p90", "overflow_risk", "emitted")


@query
def recommend(spark, d):
    return simulate.recommend(_plans(Roles(spark, d)))


@query
def override_coalesce(spark, d):
    r = Roles(spark, d)
    local = r.event.select("event_id", F.col("capacity").cast("double").alias("expected"))
    remote = r.event.filter("event_id % 3 = 0").select("event_id", F.lit(12.5).alias("expected"))
    return simulate.override(local, remote, "event_id", ["expected"])


@query
def risk_classes(spark, d):
    return simulate.project(_plans(Roles(spark, d))).groupBy("risk_class").agg(F.count(F.lit(1)).alias("n"), F.sum("turned_away").alias("turned_away"))
