"""Cleaners, counters, the integrity cascade, sentinels and the compiled verifier on small frames."""

import pytest
from pyspark.sql import functions as F

from gatecount.operators import cleaning, verify
from gatecount.schema import TABLES, key_of


def _strings(spark, columns, rows):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns.split(",")))


SALE = "sale_id,event_id,buyer_name,email,phone,qty,subtotal,channel,purchased_at"
GOOD = ("1", "7", "Ana Ruiz", "Ana+x@GMIAL.com", "+57 3001234567", "2", "10", "web", "2024-01-02 03:04:05")


def _sale(**changes):
    return tuple({**dict(zip(SALE.split(","), GOOD, strict=True)), **changes}.values())


def test_every_sale_rule_has_its_row(spark):
    rows = [
        _sale(), _sale(), _sale(sale_id="2", buyer_name=None, email="x", phone="1"), _sale(sale_id="3", qty="many"), _sale(sale_id="4", qty="0"), _sale(sale_id="5", subtotal=""), _sale(sale_id="6", subtotal="-1"),
        _sale(sale_id="7", channel="fax"), _sale(sale_id="8", event_id=" "), _sale(sale_id="9", purchased_at="soon"), _sale(sale_id=" "), _sale(sale_id=None), _sale(sale_id=" 1 ", qty="9"), _sale(sale_id="10", qty="x", channel="fax"),
    ]
    cleaner = cleaning.sale()
    marked = cleaning.mark(_strings(spark, SALE, rows), cleaner)
    got = sorted((r.sale_id, r.quality_issue, r.copies) for r in marked.collect() if r.quality_issue)
    assert got == sorted(
        [
            ("2", "INSUFFICIENT_IDENTITY", 1), ("3", "MISSING_QUANTITY", 1), ("4", "BAD_QUANTITY", 1), ("5", "MISSING_SUBTOTAL", 1), ("6", "BAD_SUBTOTAL", 1), ("7", "BAD_CHANNEL", 1), ("8", "MISSING_EVENT", 1),
            ("9", "MISSING_DATE", 1), ("", "MISSING_PRIMARY_KEY", 1), ("", "MISSING_PRIMARY_KEY", 1), ("1", "DUPLICATE_PRIMARY_KEY", 2), ("10", "MISSING_QUANTITY", 1),
        ]
    )  # fmt: skip  " 1 " comes before "1" in the order of all columns, so it stays
    clean = cleaning.clean_rows(marked, "sale").first()
    assert (clean.email, clean.phone, clean.channel, clean.purchased_at, clean.buyer_name, clean.identity_fields) == ("ana@gmail.com", "3001234567", "WEB", "2024-01-02T03:04:05Z", "ANA RUIZ", 3)
    n = {r.counter: r.n for r in cleaning.counters(marked, cleaner).collect()}
    assert (n["rows_raw"], n["exact_duplicates"], n["rows_clean"], n["DUPLICATE_PRIMARY_KEY"]) == (14, 1, 1, 1)
    assert n["email_domain_typo"] == 9 and n["email_invalid"] == 1, "rows that the key rejects have no flags"
    assert n["rows_raw"] - n["exact_duplicates"] == n["rows_clean"] + sum(n[r] for r in cleaner.reasons)


def test_counters_of_a_write_are_those_of_the_table(spark, tmp_path):
    cleaner = cleaning.sale()
    marked = cleaning.mark(_strings(spark, SALE, [_sale(), _sale(), _sale(sale_id="4", qty="0")]), cleaner)
    seen = cleaning.write(marked, cleaner, str(tmp_path / "sale"))
    assert seen == {r.counter: r.n for r in cleaning.counters(marked, cleaner).collect()}
    back = spark.read.parquet(str(tmp_path / "sale"))
    assert {(r.sale_id, r.part) for r in back.collect()} == {("1", "clean"), ("4", "quarantine")}


def test_copies_come_before_keys(spark):
    rows = cleaning.distinct_rows(_strings(spark, "id,v", [("1", "a")] * 5 + [("1", "b"), (None, "c"), (None, "c"), ("", "d")]), "id").collect()
    assert {(r.id, r.v, r.copies, r.base_issue) for r in rows} == {("", "c", 2, "MISSING_PRIMARY_KEY"), ("", "d", 1, "MISSING_PRIMARY_KEY"), ("1", "a", 5, None), ("1", "b", 1, "DUPLICATE_PRIMARY_KEY")}
    with pytest.raises(ValueError, match="no key"):
        cleaning.distinct_rows(_strings(spark, "a", [("1",)]), "id")
    assert cleaning.distinct_rows(_strings(spark, " id ,v", []), "id").count() == 0


def test_members_and_sentinels(spark):
    columns = "member_id,first_name,last_name,email,phone,city,created_at,has_membership,membership_since,points"
    rows = [("1", "josé", None, "", "", "cali", "2024-01-01", "no", "", "-4"), ("2", "", "", "", "", "", "", "", "", ""), ("3", "Ñandú", "Ruiz", "A@b.co", "1", "", "x", "sí", None, "2.5")]
    marked = {r.member_id: r for r in cleaning.mark(_strings(spark, columns, rows), cleaning.member()).collect()}
    a, b, c = marked["1"], marked["2"], marked["3"]
    assert (a.full_name, a.last_name, a.name_match_key, a.membership_since, a.points, a.quality_issue) == ("JOSÉ", "SIN_DATO", "JOSE", "NO_APLICA", 0, None)
    assert b.quality_issue == "INSUFFICIENT_IDENTITY" and b.identity_fields == 0
    assert (c.name_tokens_key, c.email, c.phone, c.membership_since, c.created_at, c.points) == ("NANDU RUIZ", "a@b.co", "SIN_DATO", "SIN_DATO", "SIN_DATO", 2)


def test_blanks_are_filled_by_the_schema(spark):
    df = spark.createDataFrame([(None, " ", None, "x")], "event_id string, city string, capacity long, other string")
    assert tuple(cleaning.fill_blanks(df, TABLES["event"]).first()) == ("SIN_DATO", "SIN_DATO", 0, "x")


def _tables(spark, **rows):
    """Frames with keys and references alone."""
    columns = {"member": "member_id", "social": "member_id", "history": "member_ticket_id,member_id", "artist": "artist_id", "event": "event_id,artist_id", "sale": "sale_id,event_id", "ticket": "ticket_id,sale_id,event_id"}
    return {t: _strings(spark, c, rows.get(t, [])) for t, c in columns.items()}


def test_cascade_gives_the_first_reason(spark):
    frames = _tables(
        spark, member=[("m",)], social=[("m",), ("gone",)], history=[("h1", "m"), ("h2", None)], artist=[("a",)], event=[("e1", "a"), ("e2", "gone"), ("e3", "a")], sale=[("s1", "e1"), ("s2", "e2"), ("s3", "gone")],
        ticket=[("t1", "s1", "e1"), ("t2", "gone", "gone"), ("t3", "gone", "e1"), ("t4", "s1", "e3"), ("t5", "s2", "e2"), ("t6", "s3", "e1")],
    )
    got = {(r.table, r.key): r.quality_issue for r in cleaning.quarantine_of(cleaning.integrity_cascade(frames)).collect()}
    assert got == {
        ("social", "gone"): "ORPHAN_MEMBER", ("history", "h2"): "ORPHAN_MEMBER", ("event", "e2"): "ORPHAN_ARTIST", ("sale", "s3"): "ORPHAN_EVENT",
        ("ticket", "t2"): "ORPHAN_EVENT", ("ticket", "t3"): "ORPHAN_SALE", ("ticket", "t4"): "SALE_EVENT_MISMATCH",
    }
    # e2 lost its artist, yet its sale and ticket stay; s3 is orphaned, so t6 isn't held against it
    turned = tuple(cleaning.CASCADE[k] for k in (0, 1, 2, 3, 5, 4))
    other = {(r.table, r.key): r.quality_issue for r in cleaning.quarantine_of(cleaning.integrity_cascade(frames, turned)).collect()}
    assert other[("ticket", "t2")] == "ORPHAN_SALE" and {k: v for k, v in other.items() if k[1] != "t2"} == {k: v for k, v in got.items() if k[1] != "t2"}


def test_cascade_of_empty_tables(spark):
    assert cleaning.quarantine_of(cleaning.integrity_cascade(_tables(spark))).count() == 0


def test_verifier_counts_failures(spark):
    frames = {
        "a": spark.createDataFrame([(1, "x", 1), (2, "y", 1), (2, None, 5), (3, "z", None)], "id long, word string, n int"),
        "b": spark.createDataFrame([(1,), (1,), (3,)], "id long"),
    }
    c = F.col
    checks = [
        verify.RowCheck("a", "n small", c("n") < 3), verify.RowCheck("a", "word known", c("word").isin("x", "y", "z")), verify.ReferenceCheck("a", "a refers", "id", "b", "id"),
        verify.GroupCheck("a", "a unique", ("id",), F.count(F.lit(1)) <= 1), verify.GroupCheck("a", "one word", ("id",), F.count_distinct("word") <= 1), verify.GroupCheck("b", "two at most", ("id",), F.count(F.lit(1)) <= 2),
    ]
    got = {r.check: (r.passed, r.failing) for r in verify.run(frames, checks).collect()}
    assert got == {"n small": (False, 2), "word known": (False, 1), "a refers": (False, 2), "a unique": (False, 1), "one word": (True, 0), "two at most": (True, 0)}
    empty = {t: df.limit(0) for t, df in frames.items()}
    assert all(r.passed for r in verify.run(empty, checks).collect())
    with pytest.raises(ValueError, match="names"):
        verify.run(frames, [checks[0], checks[0]])


def test_verifier_moves_no_whole_rows(spark):
    """References and copies: a row's other columns don't leave their scan."""
    rows = [("1", "9", "GENERAL"), ("2", None, "VIP"), ("2", None, "VIP"), ("3", None, None), ("3", "", None), ("4", "7", "VIP")]
    fill = [f for f in TABLES["ticket"] if f.name not in ("ticket_id", "event_id", "ticket_type")]
    ticket = spark.createDataFrame(rows, "ticket_id string, event_id string, ticket_type string").withColumns({f.name: F.lit(None).cast(f.dataType) for f in fill})
    frames = {"ticket": ticket, "event": spark.createDataFrame([("9",), ("9",)], "event_id string")}
    checks = [verify.ReferenceCheck("ticket", "refers", "event_id", "event", "event_id"), verify.CopiesCheck("ticket", "copies"), verify.RowCheck("ticket", "typed", F.col("ticket_type").isNotNull())]
    out = verify.run(frames, checks)
    assert {r.check: r.failing for r in out.collect()} == {"refers": 5, "copies": 1, "typed": 2}
    plan = out._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert moved and not any("ticket_type" in line or "ticket_id" in line for line in moved)


def test_aggregations_follow_tables_not_checks(spark):
    checks = verify.schema_checks()
    assert len(checks) > 140 and {c.table for c in checks} == set(TABLES)
    frames = {t: spark.createDataFrame([], s) for t, s in TABLES.items()}
    plans = list(verify._aggregations(frames, checks))
    assert len(plans) == len(TABLES) * 3, "rows, keys and copies of each table"
    assert sum(len(names) for _, names in plans) == len(checks)
    assert all(key_of(t) for t in TABLES)


def test_clean_rows_alone_are_those_of_the_marked_table_and_move_once(spark):
    rows = [_sale(), _sale(), _sale(sale_id=" 1 ", qty="9"), _sale(sale_id="2", qty=None), _sale(sale_id="2"), _sale(sale_id="3", buyer_name=None), _sale(sale_id=" "), _sale(sale_id=None), _sale(sale_id="4", channel="fax")]
    raw, cleaner = _strings(spark, f" {SALE}", rows), cleaning.sale()
    alone = cleaning.clean(raw, cleaner)
    want = cleaning.clean_rows(cleaning.mark(raw, cleaner), "sale")
    assert alone.schema == want.schema and sorted(alone.collect()) == sorted(want.collect())
    assert sorted(r.sale_id for r in want.collect()) == ["1", "3"]
    assert alone._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1


def test_the_cascade_stores_keys_and_references_alone(spark, monkeypatch):
    from gatecount.plans import queries

    stored = []
    monkeypatch.setattr(queries, "once", lambda df: stored.append(df.columns) or df)
    queries.QUERIES["integrity_cascade"](spark, "/root/testdata/sf0.001")
    assert sorted(stored) == sorted([["member_id"], ["member_ticket_id", "member_id"], ["member_id"], ["artist_id"], ["event_id", "artist_id"], ["sale_id", "event_id"], ["ticket_id", "event_id", "sale_id"]])
