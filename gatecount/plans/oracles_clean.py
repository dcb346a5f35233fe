"""DuckDB SQL for cleaning, the integrity cascade and the verifier, added to that of ``oracles``."""

from __future__ import annotations

from ..functions.scalars import DOMAIN_TYPOS, EMAIL_PATTERN
from ..schema import CHANNELS, MEMBER_TICKET_SOURCES, MEMBER_TICKET_TYPES, TABLES, TICKET_TYPES, is_number, key_of
from .oracles import ORACLE_SQL as ORACLE_SQL
from .oracles import big, fold, put, token_key

RAW_COLUMNS = {
    "member": "member_id first_name last_name email phone city created_at has_membership membership_since points",
    "history": "member_ticket_id member_id type source created_at used date_used",
    "social": "member_id friends_count",
    "artist": "artist_id name home_city has_residency residency_venue residency_weekday tickets_sold attendance_rate",
    "event": "event_id title artist_id city venue weekday month is_residency residency_venue starts_at capacity checked_in_count",
    "sale": "sale_id event_id buyer_name email phone qty subtotal channel purchased_at",
    "ticket": "ticket_id sale_id event_id ticket_type price checked_in checked_in_at",
}


def text(x: str) -> str:
    return rf"trim(regexp_replace(replace(coalesce({x}, ''), chr(160), ' '), '[ \t\n\x0B\f\r]+', ' ', 'g'))"


def up(x: str) -> str:
    return f"upper({text(x)})"


def sentinel(x: str, *cases: tuple[str, str]) -> str:
    out = "'SIN_DATO'"
    for holds, word in reversed(cases):
        out = f"case when {holds} then '{word}' else {out} end"
    return f"case when trim(coalesce({x}, '')) = '' or {x} = 'SIN_DATO' then {out} else {x} end"


def time(x: str) -> str:
    return f"coalesce(strftime(try_cast({text(x)} as timestamp), '%Y-%m-%dT%H:%M:%SZ'), 'SIN_DATO')"


def flag(x: str, missing: str = "SIN_DATO") -> str:
    low = f"lower({text(x)})"
    return f"case when {low} in ('true', '1', 'si', 'sí', 'yes') then 'TRUE' when {low} in ('false', '0', 'no') then 'FALSE' else '{missing}' end"


def whole(x: str) -> str:
    return f"cast(round_even(try_cast({text(x)} as double), 0) as bigint)"


def held(x: str) -> str:
    return f"greatest(coalesce({whole(x)}, 0), 0)"


def yes(x: str) -> str:
    return f"case when {x} then 'TRUE' else 'FALSE' end"


def words(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def based(table: str) -> str:
    """Distinct raw rows with copies and base_issue."""
    key, columns = key_of(table), RAW_COLUMNS[table].split()
    order = ", ".join(f"{c} nulls first" for c in columns)
    return f"""select * exclude (kk) replace ({text(key)} as {key}), case when {text(key)} = '' then 'MISSING_PRIMARY_KEY' when kk > 1 then 'DUPLICATE_PRIMARY_KEY' end as base_issue
        from (select *, row_number() over (partition by {text(key)} order by {order}) as kk from (select {", ".join(columns)}, count(*) as copies from raw_{table} group by all))"""


def contacts(source: str) -> str:
    """``source`` with the parsed address and number in place of the raw ones, and their flags."""
    typos = " ".join(f"when '{a}' then '{b}'" for a, b in DOMAIN_TYPOS.items())
    return rf"""select * exclude (email, phone, low, usr, domain, one, plain, fixed, digits, own), case when one and regexp_matches(plain || '@' || fixed, '{EMAIL_PATTERN}') then plain || '@' || fixed else 'SIN_DATO' end as email,
        trim(coalesce(email, '')) <> lower(trim(coalesce(email, ''))) as email_upper_case, one and plain <> usr as email_plus_alias, one and fixed <> domain as email_domain_typo, not (one and regexp_matches(plain || '@' || fixed, '{EMAIL_PATTERN}')) as email_invalid,
        case when regexp_matches(own, '^3[0-9]{{9}}$') then own else 'SIN_DATO' end as phone, regexp_matches(own, '^3[0-9]{{9}}$') and own <> trim(coalesce(phone, '')) as phone_formatted, trim(coalesce(phone, '')) = '' as phone_missing,
        trim(coalesce(phone, '')) <> '' and not regexp_matches(own, '^3[0-9]{{9}}$') as phone_invalid
        from (select *, split_part(usr, '+', 1) as plain, case domain {typos} else domain end as fixed, case when len(digits) = 12 and starts_with(digits, '57') then substring(digits, 3, 10) else digits end as own
        from (select *, split_part(low, '@', 1) as usr, split_part(low, '@', 2) as domain, len(low) - len(replace(low, '@', '')) = 1 as one
        from (select *, regexp_replace(regexp_replace(lower(trim(coalesce(email, ''))), '\s+', '', 'g'), '^mailto:', '') as low, regexp_replace(trim(coalesce(phone, '')), '\D', '', 'g') as digits from {source})))"""


CONTACT_FLAGS = ["email_upper_case", "email_plus_alias", "email_domain_typo", "email_invalid", "phone_formatted", "phone_missing", "phone_invalid"]
VALID = f"{yes('not email_invalid')} as email_valid, {yes('not phone_invalid and not phone_missing')} as phone_valid"


def keys(name: str) -> str:
    known = f"case when {name} = 'SIN_DATO' then '' else {name} end"
    match = f"regexp_replace({fold(known)}, '[^A-Z0-9]', '', 'g')"
    return f"{sentinel(match)} as name_match_key, {sentinel(token_key(known))} as name_tokens_key"


def present(*columns: str) -> str:
    return " + ".join(f"cast({c} <> 'SIN_DATO' as bigint)" for c in columns)


def marked(table: str, body: str, rules: list[tuple[str, str]]) -> str:
    reasons = " ".join(f"when coalesce({broken}, true) then '{reason}'" for reason, broken in rules)
    issue = f"case when base_issue is not null then base_issue {reasons} end"
    return f"select *, {issue} as quality_issue from ({body})"


MEMBER = f"""select *, {present("full_name", "email", "phone", "city")} as identity_fields from (select * replace ({sentinel("membership_since", ("has_membership = 'FALSE'", "NO_APLICA"))} as membership_since), {keys("full_name")}, {VALID}
    from (select * replace ({sentinel("upper(f0)")} as first_name, {sentinel("upper(l0)")} as last_name, {sentinel(up("city"))} as city, {time("created_at")} as created_at, {flag("has_membership")} as has_membership, {time("membership_since")} as membership_since, {held("points")} as points),
    {sentinel("trim(concat_ws(' ', upper(f0), upper(l0)))")} as full_name from (select *, {text("first_name")} as f0, {text("last_name")} as l0 from ({contacts("base_member")}))))"""
HISTORY = f"""select *, {yes("created_at <> 'SIN_DATO' and created_at <= '2024-01-20T23:59:59Z' and future_use = 'FALSE'")} as eligible from (select *, {yes("used = 'TRUE' and date_used not in ('SIN_DATO', 'NO_APLICA') and date_used > '2024-01-28T12:00:00Z'")} as future_use
    from (select * replace ({sentinel("date_used", ("used = 'FALSE'", "NO_APLICA"))} as date_used) from (select * replace ({text("member_id")} as member_id, {up("type")} as type, {up("source")} as source, {time("created_at")} as created_at, {flag("used")} as used, {time("date_used")} as date_used) from base_history)))"""
BROKEN = f"""(member_id in ('', 'SIN_DATO') or type in ('', 'SIN_DATO') or source in ('', 'SIN_DATO') or created_at in ('', 'SIN_DATO') or used in ('', 'SIN_DATO') or (used = 'TRUE' and date_used = 'SIN_DATO')
    or type not in ({words(MEMBER_TICKET_TYPES)}) or source not in ({words(MEMBER_TICKET_SOURCES)}))"""
SOCIAL = f"select * replace ({held('friends_count')} as friends_count) from base_social"
ARTIST = f"""select * replace (case when has_residency = 'FALSE' then 'NO_APLICA' else {sentinel(up("residency_venue"))} end as residency_venue, case when has_residency = 'FALSE' then 'NO_APLICA' else {sentinel(up("residency_weekday"))} end as residency_weekday)
    from (select * replace ({sentinel(up("name"))} as name, {sentinel(up("home_city"))} as home_city, {flag("has_residency")} as has_residency, {held("tickets_sold")} as tickets_sold, least(greatest(coalesce(try_cast({text("attendance_rate")} as double), 0e0), 0e0), 1e0) as attendance_rate) from base_artist)"""
EVENT = f"""select * replace (case when is_residency = 'FALSE' then 'NO_APLICA' else {sentinel(up("residency_venue"))} end as residency_venue, case when month = 'AGOSTO' then 'NO_OBSERVADO' else cast(coalesce({whole("checked_in_count")}, 0) as varchar) end as checked_in_count)
    from (select * replace ({", ".join(f"{sentinel(up(c))} as {c}" for c in ("title", "city", "venue", "weekday", "month"))}, {text("artist_id")} as artist_id, {flag("is_residency")} as is_residency, {time("starts_at")} as starts_at, {held("capacity")} as capacity) from base_event)"""
SALE = f"""select *, {present("buyer_name", "email", "phone")} as identity_fields, {keys("buyer_name")}, {VALID} from (select * replace ({sentinel("upper(b0)")} as buyer_name, {text("event_id")} as event_id, {whole("qty")} as qty, {whole("subtotal")} as subtotal, {up("channel")} as channel, {time("purchased_at")} as purchased_at)
    from (select *, {text("buyer_name")} as b0 from ({contacts("base_sale")})))"""
TICKET = f"""select * replace ({sentinel("checked_in_at", ("checked_in = 'NO_OBSERVADO'", "NO_OBSERVADO"), ("checked_in = 'FALSE'", "NO_APLICA"))} as checked_in_at) from (select * replace ({text("sale_id")} as sale_id, {text("event_id")} as event_id, {up("ticket_type")} as ticket_type, {whole("price")} as price,
    {flag("checked_in", "NO_OBSERVADO")} as checked_in, {time("checked_in_at")} as checked_in_at) from base_ticket)"""

RULES = {
    "member": [("INSUFFICIENT_IDENTITY", "identity_fields < 2")],
    "history": [("INVALID_REQUIRED_FIELD", BROKEN)],
    "social": [], "artist": [], "event": [],
    "sale": [("INSUFFICIENT_IDENTITY", "identity_fields = 0"), ("MISSING_QUANTITY", "qty is null"), ("BAD_QUANTITY", "qty < 1"), ("MISSING_SUBTOTAL", "subtotal is null"), ("BAD_SUBTOTAL", "subtotal < 0"), ("BAD_CHANNEL", f"channel not in ({words(CHANNELS)})"), ("MISSING_EVENT", "event_id = ''"), ("MISSING_DATE", "purchased_at = 'SIN_DATO'")],
    "ticket": [("MISSING_PARENT", "sale_id = '' or event_id = ''"), ("BAD_TYPE", f"ticket_type not in ({words(TICKET_TYPES)})"), ("MISSING_PRICE", "price is null"), ("BAD_PRICE", "price < 0"), ("ENTRY_WITHOUT_TIME", "checked_in = 'TRUE' and checked_in_at in ('SIN_DATO', 'NO_APLICA', 'NO_OBSERVADO')")],
}
BODIES = {"member": MEMBER, "history": HISTORY, "social": SOCIAL, "artist": ARTIST, "event": EVENT, "sale": SALE, "ticket": TICKET}
FLAGS = {
    "member": {"names_uppercased": "f0 <> first_name", "last_names_uppercased": "l0 <> last_name", **{c: c for c in CONTACT_FLAGS}},
    "history": {"future_use_flagged": f"future_use = 'TRUE' and not {BROKEN}", "mature_rows": f"eligible = 'TRUE' and not {BROKEN}"},
    "social": {},
    "artist": {"no_residency": "has_residency = 'FALSE'"},
    "event": {"unobserved": "month = 'AGOSTO'"},
    "sale": {"names_uppercased": "b0 <> buyer_name", **{c: c for c in CONTACT_FLAGS}},
    "ticket": {"unobserved": "checked_in = 'NO_OBSERVADO'"},
}
NAMES = {t: TABLES[t].fieldNames() for t in TABLES}
CTES = {f"base_{t}": based(t) for t in TABLES} | {f"marked_{t}": marked(t, BODIES[t], RULES[t]) for t in TABLES}
ROLES_OF = {t: f"raw_{t}" for t in TABLES}
ALL = " ".join(ROLES_OF.values())

for t in TABLES:
    put(f"clean_{t}", ROLES_OF[t], f"select {', '.join(NAMES[t])}, copies, quality_issue from marked_{t}", **{k: v for k, v in CTES.items() if k.endswith(f"_{t}")})


def _counted(t: str) -> str:
    reasons = ["MISSING_PRIMARY_KEY", "DUPLICATE_PRIMARY_KEY", *[r for r, _ in RULES[t]]]
    sums = {"rows_raw": "sum(copies)", "exact_duplicates": "sum(copies - 1)", "rows_clean": "count(*) filter (where quality_issue is null)", **{r: f"count(*) filter (where quality_issue = '{r}')" for r in reasons}, **{f: f"count(*) filter (where base_issue is null and {c})" for f, c in FLAGS[t].items()}}
    return " union all ".join(f"select '{t}' as \"table\", '{n}' as counter, {big(s)} as n from marked_{t}" for n, s in sums.items())


put("clean_counters", ALL, " union all ".join(map(_counted, TABLES)), **CTES)
put("clean_quarantine", ALL, " union all ".join(f"select '{t}' as \"table\", quality_issue, count(*) as rows, {big('sum(copies)')} as copies, min({key_of(t)}) as first_key, max({key_of(t)}) as last_key from marked_{t} where quality_issue is not null group by quality_issue" for t in TABLES), **CTES)
put("sentinel_fill", "raw_event", f"""select coalesce(nullif(trim(event_id), ''), 'SIN_DATO') as event_id, {sentinel("city")} as city, {sentinel("weekday")} as weekday, {sentinel("starts_at")} as starts_at, coalesce(try_cast(capacity as bigint), 0) as capacity,
    {sentinel("checked_in_count", ("upper(month) = 'AGOSTO'", "NO_OBSERVADO"))} as checked_in_count, {sentinel("residency_venue", ("is_residency = 'false'", "NO_APLICA"))} as residency_venue from raw_event""")


def _filled(t: str) -> str:
    columns = [f"coalesce({f.name}, 0) as {f.name}" if is_number(f) else f"{sentinel(f.name)} as {f.name}" for f in TABLES[t]]
    return f"select {', '.join(columns)} from marked_{t} where quality_issue is null"


CLEAN = CTES | {f"clean_{t}": _filled(t) for t in TABLES}


def _orphan(column: str, parent: str) -> str:
    return f"{column} not in (select {key_of(parent)} from clean_{parent})"


CASCADE = CLEAN | {
    "cut_member": "select *, null as quality_issue from clean_member",
    "cut_artist": "select *, null as quality_issue from clean_artist",
    "cut_social": f"select *, case when {_orphan('member_id', 'member')} then 'ORPHAN_MEMBER' end as quality_issue from clean_social",
    "cut_history": f"select *, case when {_orphan('member_id', 'member')} then 'ORPHAN_MEMBER' end as quality_issue from clean_history",
    "cut_event": f"select *, case when {_orphan('artist_id', 'artist')} then 'ORPHAN_ARTIST' end as quality_issue from clean_event",
    "cut_sale": f"select *, case when {_orphan('event_id', 'event')} then 'ORPHAN_EVENT' end as quality_issue from clean_sale",
    "cut_ticket": f"""select t.*, case when {_orphan("t.event_id", "event")} then 'ORPHAN_EVENT' when {_orphan("t.sale_id", "sale")} then 'ORPHAN_SALE' when s.event_id <> t.event_id then 'SALE_EVENT_MISMATCH' end as quality_issue
        from clean_ticket t left join (select sale_id, event_id from cut_sale where quality_issue is null) s on t.sale_id = s.sale_id""",
}
put("integrity_cascade", ALL, " union all ".join(f"select '{t}' as \"table\", {key_of(t)} as key, quality_issue from cut_{t} where quality_issue is not null" for t in TABLES), **CASCADE)


def _checks(prefix: str) -> str:
    """One select a check, against tables of the given prefix."""
    out: list[tuple[str, str, str]] = []

    def row(t: str, name: str, holds: str) -> None:
        out.append((name, f"{prefix}_{t}", f"count(*) filter (where not coalesce({holds}, false))"))

    def group(t: str, name: str, by: str, holds: str) -> None:
        out.append((name, f"(select {holds} as ok from {prefix}_{t} group by {by})", "count(*) filter (where not ok)"))

    for t, schema in TABLES.items():
        for f in schema:
            c, m, at = f.name, f.metadata, f"{t}.{f.name}"
            missing = f"{c} in ({words(m['sentinels'])})" if m.get("sentinels") else "false"
            row(t, f"{at} filled", f"{c} is not null" if is_number(f) else f"trim(coalesce({c}, '')) <> ''")
            if "values" in m:
                row(t, f"{at} known", f"{c} in ({words(m['values'])})")
            if "low" in m:
                row(t, f"{at} in range", f"{c} >= {m['low']}" + (f" and {c} <= {m['high']}" if "high" in m else ""))
            if "pattern" in m:
                row(t, f"{at} shaped", f"({missing} or regexp_matches({c}, '{m['pattern']}'))")
            if m.get("upper"):
                row(t, f"{at} in capitals", f"({missing} or {c} = upper({c}))")
            if "refers" in m:
                row(t, f"{at} refers", f"{c} in (select {key_of(m['refers'])} from {prefix}_{m['refers']})")
            if m.get("key"):
                group(t, f"{at} unique", c, "count(*) <= 1")
        group(t, f"{t} without copies", ", ".join(schema.fieldNames()), "count(*) <= 1")
    group("history", "two tickets at most for a member and day", "member_id, created_at", "count(*) <= 2")
    group("sale", "a contact has one name", "email, phone", "count(distinct name_tokens_key) <= 1")
    group("sale", "a name of a contact has one channel", "email, phone, name_tokens_key", "count(distinct channel) <= 1")
    group("ticket", "a sale's tickets are of one event", "sale_id", "count(distinct event_id) <= 1")
    group("ticket", "four tickets at most for a sale", "sale_id", "count(*) <= 4")
    row("ticket", "an entry has a time", "checked_in <> 'TRUE' or checked_in_at not in ('SIN_DATO', 'NO_APLICA', 'NO_OBSERVADO')")
    row("event", "a coming event is not observed", "month <> 'AGOSTO' or checked_in_count = 'NO_OBSERVADO'")
    row("history", "no use in the future is learned from", "eligible <> 'TRUE' or future_use = 'FALSE'")
    row("history", "only mature tickets are learned from", "eligible <> 'TRUE' or created_at <= '2024-01-20T23:59:59Z'")
    row("member", "a valid address is one", "(email_valid = 'TRUE') = (email <> 'SIN_DATO')")
    row("sale", "a valid number is one", "(phone_valid = 'TRUE') = (phone <> 'SIN_DATO')")
    return " union all ".join(f"select '{name.replace(chr(39), chr(39) * 2)}' as \"check\", {big(failing)} as failing from {source}" for name, source, failing in out)


put("verify_clean", ALL, f'select "check", failing = 0 as passed, failing from ({_checks("clean")})', **CLEAN)
INTACT = CASCADE | {f"intact_{t}": f"select * exclude (quality_issue) from cut_{t} where quality_issue is null" for t in TABLES}
put("verify_intact", ALL, f"""select split_part("check", ' ', -1) as kind, count(*) as checks, {big("count(*) filter (where failing = 0)")} as passed, {big("sum(failing)")} as failing from ({_checks("intact")}) group by all""", **INTACT)
