"""DuckDB SQL for the registered queries, written against the same roles.

Queries that fit MLlib models or use the Ratcliff-Obershelp ratio have none.
"""

from __future__ import annotations

from math import e, factorial

from ..functions.scalars import EMAIL_PATTERN
from ..schema import TICKET_TYPES, WEEKDAYS
from .roles import ctes

ORACLE_SQL: dict[str, str] = {}


def r4(x: str) -> str:
    return f"floor(({x}) * 1e4 + 0.5e0) / 1e4"


def grid(x: str) -> str:
    return f"round_even(cast({x} as double) * 1e6, 0) / 1e6"


def big(x: str) -> str:
    return f"cast({x} as bigint)"


def fold(x: str) -> str:
    return f"strip_accents(upper(replace({x}, 'ß', 'SS')))"


def token_key(x: str) -> str:
    return f"array_to_string(list_sort(regexp_extract_all({fold(x)}, '[A-Z0-9]+')), ' ')"


def put(name: str, roles: str, body: str, **more: str) -> None:
    ORACLE_SQL[name] = (ctes(*roles.split(), **more) if roles or more else "") + body


COUNT_USED = "cast(count(*) filter (where used) as bigint)"
PROFILE = f"""select m.*, coalesce(h.total, 0) as tickets_total, coalesce(h.used_n, 0) as tickets_used,
    {r4("coalesce(h.used_n, 0) * 1e0 / nullif(coalesce(h.total, 0), 0)")} as use_rate, h.last_used_at, coalesce(s.friends_count, 0) as friends_count
    from member m left join (select member_id, count(*) as total, {COUNT_USED} as used_n, max(case when used then date_used end) as last_used_at from history group by member_id) h on m.member_id = h.member_id
    left join social s on m.member_id = s.member_id"""
SUMMARY = f"""select e.event_id, e.artist_id, a.name as artist_name, e.city, e.venue, e.weekday, e.is_residency, e.is_upcoming, e.month, e.capacity,
    coalesce(sold, 0) as tickets_sold, case when not is_upcoming and labelled > 0 then entered end as checked_in_count,
    case when not is_upcoming and labelled > 0 then {r4("entered * 1e0 / sold")} end as attendance_rate,
    {r4("coalesce(sold, 0) * 1e0 / nullif(capacity, 0)")} as fill_rate, coalesce(revenue, 0) as gross_revenue
    from event e join artist a on e.artist_id = a.artist_id left join (select event_id, count(*) as sold, count(checked_in) as labelled,
    cast(count(*) filter (where checked_in) as bigint) as entered, cast(sum(price) as bigint) as revenue from ticket group by event_id) t on e.event_id = t.event_id"""

put("res_eq_filter", "history", "select member_ticket_id, member_id from history where type = 'MEMBRESIA' and used")
put("res_ilike", "member", "select member_id, full_name from member where full_name ilike 'ana%'")
put("res_gte", "member history social", "select member_id, tickets_total, use_rate from profile where use_rate >= 0.5 and tickets_total >= 2", profile=PROFILE)
put("res_page_ordered", "sale", "select sale_id, event_id, subtotal from sale where channel = 'WEB' order by subtotal desc, sale_id limit 50 offset 20")
put("res_count", "ticket", "select count(*) as total from ticket where ticket_type = 'VIP'")
put("res_csv_lines", "event", """select event_id, concat_ws(',', cast(event_id as varchar), case when regexp_matches(title, '[",\\n\\r]') then '"' || replace(title, '"', '""') || '"' else title end,
    case when regexp_matches(city, '[",\\n\\r]') then '"' || replace(city, '"', '""') || '"' else city end, case when regexp_matches(venue, '[",\\n\\r]') then '"' || replace(venue, '"', '""') || '"' else venue end) as line from event""")
put("search_fold", "event", f"select event_id, city from event where contains({fold("concat_ws(' ', title, city, venue)")}, 'BOGOTA')")
put("search_city", "event artist", f"""select event_id, title, city, name, capacity from event e join artist a on e.artist_id = a.artist_id where contains({fold("concat_ws(' ', title, city, venue, name)")}, 'SUPPLIER') and city = 'Cali' and capacity between 30 and 120""")
put("view_member_profile", "member history social", "select member_id, city, tickets_total, tickets_used, use_rate, last_used_at, friends_count from profile", profile=PROFILE)
put("view_event_summary", "event artist ticket", SUMMARY)
put("view_artist_summary", "event artist ticket", f"""select a.artist_id, a.name, coalesce(past_n, 0) as past_events, coalesce(upcoming_n, 0) as upcoming_events, {r4("entered * 1e0 / nullif(sold, 0)")} as attendance_rate
    from artist a left join (select artist_id, cast(count(*) filter (where not is_upcoming) as bigint) as past_n, cast(count(*) filter (where is_upcoming) as bigint) as upcoming_n,
    sum(checked_in_count) filter (where not is_upcoming) as entered, sum(tickets_sold) filter (where not is_upcoming and checked_in_count is not null) as sold from summary group by artist_id) s on a.artist_id = s.artist_id""", summary=SUMMARY)
put("union_counts", "member sale ticket", "select 'member' as relation, count(*) as n from member union all select 'sale', count(*) from sale union all select 'ticket', count(*) from ticket")
WHITE = r"regexp_replace(replace(coalesce(text, ''), chr(160), ' '), '[ \t\n\x0B\f\r]+', ' ', 'g')"
put("clean_text", "", f"select doc_id, md5(nfc_normalize(trim({WHITE}))) as text_md5 from documents")
put("match_key", "", f"select doc_id, md5(regexp_replace({fold('text')}, '[^A-Z0-9]', '', 'g')) as key_md5 from documents")
put("token_key", "", f"select conv_id, turn, md5({token_key('text')}) as key_md5 from conversations")
DIRTY = """select member_id, case member_id % 6 when 0 then upper(email) when 1 then ' mailto:' || email when 2 then replace(email, '@', '+club@') when 3 then replace(email, 'mail.com', 'gmial.com') when 4 then replace(email, '@', '@@') else email end as email,
    case member_id % 6 when 0 then '+57 ' || phone when 1 then substring(phone, 1, 3) || '-' || substring(phone, 4, 7) when 2 then '' when 3 then substring(phone, 2, 9) else phone end as phone from member"""
put("email_normalize", "member", f"""select member_id, case when one and regexp_matches(joined, '{EMAIL_PATTERN}') then joined else 'SIN_DATO' end as value, upper_case, one and plain <> usr as plus_alias, one and fixed <> domain as domain_typo,
    not (one and regexp_matches(joined, '{EMAIL_PATTERN}')) as invalid from (select *, plain || '@' || fixed as joined from (select *, split_part(usr, '+', 1) as plain,
    case domain when 'gmial.com' then 'gmail.com' when 'hotmial.com' then 'hotmail.com' when 'outlok.com' then 'outlook.com' else domain end as fixed from
    (select member_id, trim(email) <> lower(trim(email)) as upper_case, split_part(low, '@', 1) as usr, split_part(low, '@', 2) as domain, len(low) - len(replace(low, '@', '')) = 1 as one from
    (select *, regexp_replace(regexp_replace(lower(trim(email)), '\\s+', '', 'g'), '^mailto:', '') as low from dirty))))""", dirty=DIRTY)
put("phone_normalize", "member", """select member_id, case when ok then own else 'SIN_DATO' end as value, ok and own <> phone as formatted, phone = '' as missing, phone <> '' and not ok as invalid from (select *, regexp_matches(own, '^3[0-9]{9}$') as ok from
    (select *, case when len(digits) = 12 and starts_with(digits, '57') then substring(digits, 3, 10) else digits end as own from (select *, regexp_replace(phone, '\\D', '', 'g') as digits from dirty)))""", dirty=DIRTY)
put("bool_normalize", "member", "select member_id, case member_id % 6 when 0 then true when 1 then true when 2 then false when 3 then false when 5 then true end as flag from member")
put("ts_normalize", "event", "select event_id, case when event_id % 4 <> 0 then strftime(starts_at, '%Y-%m-%dT%H:%M:%SZ') end as iso from event")
put("identity_score", "sale", "select sale_id, cast(buyer_name is not null as int) + cast(email is not null as int) + cast(phone is not null as int) as score from sale")
put("handle_normalize", "member", "select member_id, substring(regexp_replace(lower(trim('  @' || full_name || '_' || email)), '[^a-z0-9._-]', '', 'g'), 1, 40) as handle from member")
put("share_link", "event", """select event_id, '/e/' || event_id || case when q = '' then '' else '?' || q end as link, cast(event_id % 5 as int) as c, cast(event_id % 3 as int) as m, cast(event_id % 2 as int) as k from
    (select event_id, concat_ws('&', case when event_id % 5 > 0 then 'c=' || event_id % 5 end, case when event_id % 3 > 0 then 'm=' || event_id % 3 end, case when event_id % 2 > 0 then 'k=' || event_id % 2 end) as q from event)""")
put("lead_time", "ticket sale", f"""select ticket_id, {grid("h")} as lead_hours, {grid("h / 24")} as lead_days, hour(t.starts_at) + minute(t.starts_at) / 60e0 as start_hour, cast(day(t.starts_at) as int) as day_of_month,
    cast(floor((day(t.starts_at) - 1) / 7) + 1 as int) as week_of_month, cast(isodow(t.starts_at) - 1 as int) as weekday_number, isodow(t.starts_at) >= 6 as is_weekend
    from (select t.*, (epoch_us(t.starts_at) - epoch_us(s.purchased_at)) / 3.6e9 as h from ticket t join sale s on t.sale_id = s.sale_id) t""")

LONG = "select 'l_quantity' as column_name, l_quantity as value from lineitem union all select 'l_extendedprice', l_extendedprice from lineitem union all select 'l_discount', l_discount from lineitem"
STATS = "select column_name, count(*) as n, count(distinct value) as n_distinct, min(value) as low, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as median, quantile_cont(value, 0.75) as q3, max(value) as high from long where value is not null group by column_name"
put("profile_numeric", "", f"""select s.column_name, s.n, s.n_distinct, count(v.value) filter (where v.value < q1 - 1.5e0 * (q3 - q1) or v.value > q3 + 1.5e0 * (q3 - q1)) as outliers, {", ".join(f"floor(any_value({c}) * 1e3 + 0.5e0) / 1e3 as {c}" for c in ("low", "q1", "median", "q3", "high"))}
    from stats s join long v on s.column_name = v.column_name group by s.column_name, s.n, s.n_distinct""", long=LONG, stats=STATS)
put("profile_blanks", "sale", " union all ".join(f"select '{c}' as column_name, {big(f"count(*) filter (where trim(coalesce({c}, '')) = '')")} as blanks from sale" for c in ("buyer_name", "email", "phone", "channel")))
put("category_counts", "ticket", "select column_name, value, n from (select *, count(*) over (partition by column_name) as k from (select column_name, value, count(*) as n from (select 'ticket_type' as column_name, ticket_type as value from ticket union all select 'checked_in', cast(checked_in as varchar) from ticket union all select 'sale_id', cast(sale_id as varchar) from ticket) group by column_name, value)) where k between 2 and 20")
put("exact_dedup", "ticket", "select distinct sale_id, ticket_type, checked_in from ticket")
put("dup_pk_quarantine", "ticket", "select ticket_id, count(*) as n, count(*) - 1 as quarantined, min(event_id) as kept_event from ticket group by ticket_id")
put("orphan_quarantine", "ticket sale", "select ticket_id, sale_id, 'ORPHAN_SALE_ID' as quality_issue from ticket where sale_id not in (select sale_id from sale where sale_id % 7 <> 0)")
put("key_mismatch", "ticket sale", "select t.ticket_id, t.sale_id, t.event_id, s.event_id as sale_event_id from ticket t join sale s on t.sale_id = s.sale_id where t.event_id <> s.event_id")
put("reconcile_sales", "ticket sale", "select s.sale_id, coalesce(n, 0) as qty, coalesce(total, 0) as subtotal, s.qty <> coalesce(n, 0) as qty_corrected, s.subtotal <> coalesce(total, 0) as subtotal_corrected from sale s left join (select sale_id, count(*) as n, cast(sum(price) as bigint) as total from ticket group by sale_id) t on s.sale_id = t.sale_id")
RECONCILED = f"""select e.event_id, e.artist_id, coalesce(sold, 0) as tickets_sold, coalesce(revenue, 0) as gross_revenue, {r4("coalesce(sold, 0) * 1e0 / nullif(capacity, 0)")} as fill_rate, coalesce(whole, false) as fully_labelled,
    case when whole then entered end as checked_in_count, case when whole then {r4("entered * 1e0 / sold")} end as attendance_rate from event e left join (select event_id, count(*) as sold, cast(sum(price) as bigint) as revenue,
    cast(count(*) filter (where checked_in) as bigint) as entered, bool_and(checked_in is not null) as whole from ticket group by event_id) t on e.event_id = t.event_id"""
put("reconcile_events", "event ticket", "select * exclude (artist_id) from reconciled", reconciled=RECONCILED)
put("reconcile_artists", "event ticket artist", "select a.artist_id, coalesce(n, 0) as events, coalesce(labelled, 0) as labelled_events, coalesce(sold, 0) as tickets_sold from artist a left join (select artist_id, count(*) as n, count(checked_in_count) as labelled, cast(sum(tickets_sold) as bigint) as sold from reconciled group by artist_id) r on a.artist_id = r.artist_id", reconciled=RECONCILED)
FLAGGED = "select *, mature and not future_use as eligible from (select *, coalesce(date_used > timestamp '2024-01-28 12:00:00', false) as future_use, coalesce(created_at <= timestamp '2024-01-20 23:59:59', false) as mature from history)"
put("leak_flags", "history", "select member_ticket_id, future_use, mature, eligible from flagged", flagged=FLAGGED)
put("leak_report", "history", "select count(*) as rows, count(distinct member_id) as members, min(date_used) as first_use, max(date_used) as last_use from flagged where future_use", flagged=FLAGGED)
put("leak_examples", "history", "select member_ticket_id, member_id, date_used from flagged where future_use order by member_ticket_id limit 10", flagged=FLAGGED)
put("safe_history", "history", f"""select *, coalesce({r4("tickets_used * 1e0 / nullif(tickets_total, 0)")}, 0e0) as use_rate, tickets_total > 0 as history_available from (select member_id, {big("count(*) filter (where eligible)")} as tickets_total,
    {big("count(*) filter (where eligible and used)")} as tickets_used, max(date_used) filter (where eligible and used) as last_used_at, {big("count(*) filter (where future_use)")} as leaks from flagged group by member_id)""", flagged=FLAGGED)
put("train_score_split", "ticket", "select ticket_type, count(*) as n, cast(sum(price) as bigint) as revenue, case when checked_in is null then 'score' else 'train' end as part from ticket group by ticket_type, checked_in is null")
put("sale_validity", "sale", "select case when channel not in ('WEB', 'BOX_OFFICE', 'ADMIN', 'RRPP') then 'BAD_CHANNEL' end as issue, count(*) as n from sale group by 1")
put("ticket_validity", "ticket", "select case when sale_id % 3 = 0 and not coalesce(checked_in, false) then 'ENTRY_WITHOUT_LABEL' end as issue, count(*) as n from ticket group by 1")
put("verify_checks", "member ticket sale event", """select "check", failing = 0 as passed, failing from (select 'member_key_unique' as "check", count(*) filter (where n > 1) as failing from (select count(*) as n from member group by member_id)
    union all select 'ticket_has_sale', count(*) from ticket where sale_id not in (select sale_id from sale) union all select 'price_not_negative', count(*) filter (where price < 0) from ticket
    union all select 'upcoming_unlabelled', count(*) filter (where is_upcoming and checked_in is not null) from ticket t join event e on t.event_id = e.event_id union all select 'channel_known', count(*) filter (where channel = 'OTRO') from sale)""")

SIGNED = "list_distinct(list_concat([email], list_transform(range(1, len(email) + 1), lambda i: concat(substring(email, 1, i - 1), substring(email, i + 1)))))"
put("sig_explode", "member", f"select member_id, count(*) as n, min(s) as first, max(s) as last from (select member_id, unnest({SIGNED}) as s from member) group by member_id")
EMAILS = f"""select sale_id, member_id, max(email_score) as email_score from (select s.sale_id, o.member_id, 1e0 as email_score from sale s join (select email, max(member_id) as member_id from member group by email) o on s.email = o.email
    union all select sale_id, member_id, 0.9e0 from (select distinct a.sale_id, b.member_id, a.email as e1, b.email as e2 from (select sale_id, email, unnest({SIGNED}) as g from sale where email is not null) a join (select member_id, email, unnest({SIGNED}) as g from member) b on a.g = b.g)
    where damerau_levenshtein(e1, e2) <= 1) group by sale_id, member_id"""
SWAPS = """select sale_id, concat(substring(phone, 1, i - 1), substring(phone, j, 1), substring(phone, i + 1, j - i - 1), substring(phone, i, 1), substring(phone, j + 1)) as phone from sale, range(1, 10) a(i), range(2, 11) b(j) where i < j and phone is not null and substring(phone, i, 1) <> substring(phone, j, 1)"""
PHONES = f"""select sale_id, member_id, max(phone_score) as phone_score from (select s.sale_id, o.member_id, 1e0 as phone_score from sale s join (select phone, max(member_id) as member_id from member group by phone) o on s.phone = o.phone
    union all select s.sale_id, o.member_id, 0.9e0 from ({SWAPS}) s join (select phone, max(member_id) as member_id from member group by phone) o on s.phone = o.phone) group by sale_id, member_id"""
put("osa_join", "sale", EMAILS)
put("swap_join", "sale", PHONES)


def ladder(*steps: tuple[float, float], floor: float) -> str:
    return "case " + " ".join(f"when n >= {a}e0 then {b}e0" for a, b in steps) + f" else {floor}e0 end"


CONFIDENCE = f"""case when e >= 1 and p >= 1 then {ladder((0.9, 0.995), (0.75, 0.97), (0.5, 0.9), floor=0.78)} when e > 0 and p > 0 then {ladder((0.9, 0.97), (0.75, 0.94), (0.5, 0.86), floor=0.72)}
    when e >= 1 or p >= 1 then {ladder((0.95, 0.96), (0.82, 0.91), (0.65, 0.8), floor=0.58)} when e > 0 or p > 0 then {ladder((0.95, 0.92), (0.82, 0.86), (0.65, 0.74), floor=0.45)} else 0e0 end"""
METHOD = """concat_ws('+', case when e >= 1 then 'EMAIL_EXACTO' when e >= 0.89 then 'EMAIL_APROX_1_EDICION' end, case when p >= 1 then 'TELEFONO_EXACTO' when p >= 0.89 then 'TELEFONO_APROX_1_EDICION' end,
    case when n >= 0.9e0 then 'NOMBRE_FUERTE' when n >= 0.65e0 then 'NOMBRE_PARCIAL' else 'NOMBRE_CONTRADICE' end)"""
SCORED = f"""select sale_id, member_id, e as email_score, p as phone_score, n as name_score, {CONFIDENCE} as evidence_confidence, {METHOD} as match_method from (select sale_id, member_id, e, p,
    case when list_contains(given, first_name) and list_contains(given, last_name) then 1e0 else round_even(least(1e0, greatest(case when list_contains(given, last_name) and len(list_filter(given, lambda t: len(t) = 1 and starts_with(first_name, t))) > 0 then 0.84e0 else 0e0 end,
    case when damerau_levenshtein(regexp_replace(buyer_name, '[^A-Z0-9]', '', 'g'), first_name || last_name) <= 1 then 0.95e0 else 0e0 end,
    case when list_contains(given, last_name) then 0.55e0 + 0.4e0 * (len(list_intersect(given, [first_name, last_name])) / 2e0) else 0e0 end)) * 1e4, 0) / 1e4 end as n
    from (select c.*, s.buyer_name, m.first_name, m.last_name, regexp_extract_all(s.buyer_name, '[A-Z0-9]+') as given from (select coalesce(a.sale_id, b.sale_id) as sale_id, coalesce(a.member_id, b.member_id) as member_id, coalesce(email_score, 0e0) as e, coalesce(phone_score, 0e0) as p
    from emails a full join phones b on a.sale_id = b.sale_id and a.member_id = b.member_id) c join sale s on c.sale_id = s.sale_id join member m on c.member_id = m.member_id))"""
DECIDED = """select s.sale_id, case when accepted then cast(t.member_id as varchar) else 'SIN_MATCH' end as member_id, case when accepted then evidence_confidence else 0e0 end as confidence,
    case when accepted then 'MATCH' when t.member_id is null then 'SIN_CANDIDATO_DE_CONTACTO' when evidence_confidence < 0.7 then 'EVIDENCIA_INSUFICIENTE' else 'AMBIGUO' end as decision,
    case when not coalesce(accepted, false) then 0e0 when evidence_confidence >= 0.95 then 1e0 when evidence_confidence >= 0.9 then 0.8e0 else 0.6e0 end as match_weight, coalesce(margin, 0e0) as margin, coalesce(x.conflict, false) as exact_conflict
    from sale s left join (select *, evidence_confidence >= 0.7 and (runner is null or margin >= 0.08 or (evidence_confidence >= 0.95 and name_score >= 0.9 and exact > runner_exact)) as accepted from
    (select *, round_even((evidence_confidence - coalesce(runner, 0e0)) * 1e9, 0) / 1e9 as margin from (select *, row_number() over w as k, lead(evidence_confidence) over w as runner, lead(exact) over w as runner_exact from
    (select *, cast(email_score >= 1 as int) + cast(phone_score >= 1 as int) as exact from scored) window w as (partition by sale_id order by evidence_confidence desc, name_score desc, email_score + phone_score desc, member_id))) where k = 1) t on s.sale_id = t.sale_id
    left join (select sale_id, min(member_id) filter (where email_score >= 1) <> min(member_id) filter (where phone_score >= 1) as conflict from scored group by sale_id) x on s.sale_id = x.sale_id"""
ER = {"emails": EMAILS, "phones": PHONES, "scored": SCORED}
FULL = {**ER, "decided": DECIDED}
put("er_candidates", "sale", "select * from scored", **ER)
put("er_confidence", "sale", f"select e as email_score, p as phone_score, n as name_score, pairs, {CONFIDENCE} as confidence, {METHOD} as method from (select email_score as e, phone_score as p, name_score as n, count(*) as pairs from scored group by all)", **ER)
put("er_decision_rules", "sale", "select * from decided", **FULL)
put("match_report_rules", "sale", f"""select count(*) as sales, {big("count(*) filter (where member_id <> 'SIN_MATCH')")} as matched, {big("count(*) filter (where member_id <> 'SIN_MATCH' and confidence >= 0.9)")} as high,
    {big("count(*) filter (where member_id <> 'SIN_MATCH' and confidence < 0.9)")} as probable, {big("count(*) filter (where exact_conflict)")} as conflicts, {big("count(*) filter (where decision = 'AMBIGUO')")} as ambiguous, count(distinct member_id) filter (where member_id <> 'SIN_MATCH') as members from decided""", **FULL)
put("unmatched_buyers_rules", "sale", "select s.sale_id, s.buyer_name, s.email, s.phone, d.decision, case when d.decision = 'SIN_CANDIDATO_DE_CONTACTO' then 'NUEVO' else 'EN_DUDA' end as status from decided d join sale s on d.sale_id = s.sale_id where d.member_id = 'SIN_MATCH'", **FULL)


def aliases(contact: str) -> str:
    return f"""select name_key, {contact}, min(member_id) as member_id from (select {token_key("s.buyer_name")} as name_key, s.{contact}, c.member_id from decided d join scored c on d.sale_id = c.sale_id and d.member_id = cast(c.member_id as varchar)
        join sale s on s.sale_id = d.sale_id where d.decision = 'MATCH' and d.confidence >= 0.95 and c.name_score >= 0.95 and s.{contact} is not null) group by name_key, {contact} having count(distinct member_id) = 1"""


put("alias_unique_rules", "sale", aliases("email"), **FULL)
put("alias_vote_rules", "sale", """select t.sale_id, case when members = 1 then t.member_id end as member_id, signals, sources, case when signals >= 2 then 0.9e0 else 0.82e0 end as evidence_confidence, case when signals >= 2 then 0.55e0 else 0.35e0 end as source_reliability,
    case when members > 1 then 'ALIAS_CONTRADICTORIOS' when decision <> 'SIN_CANDIDATO_DE_CONTACTO' and c.sale_id is null then 'ALIAS_NO_COMPATIBLE_CON_CANDIDATOS' else 'MATCH_ALIAS' end as status
    from (select sale_id, decision, count(distinct member_id) as members, min(member_id) as member_id, count(*) as signals, array_to_string(list_sort(list(distinct source)), '+') as sources from (select o.sale_id, o.decision, e.member_id, 'NOMBRE+EMAIL_ALIAS' as source from open o join ea e on o.name_key = e.name_key and o.email = e.email
    union all select o.sale_id, o.decision, e.member_id, 'NOMBRE+TELEFONO_ALIAS' from open o join pa e on o.name_key = e.name_key and o.phone = e.phone) group by sale_id, decision) t left join scored c on t.sale_id = c.sale_id and t.member_id = c.member_id""",
    **FULL, ea=aliases("email"), pa=aliases("phone"), open=f"select d.sale_id, d.decision, {token_key('s.buyer_name')} as name_key, s.email, s.phone from decided d join sale s on d.sale_id = s.sale_id where d.member_id = 'SIN_MATCH'")
PROBABLE = f"""select sale_id, row_number() over (partition by sale_id order by strength desc, member_id = 'SIN_MATCH', member_id) as candidate_rank, member_id, {grid("p")} as candidate_probability, evidence_confidence,
    case when member_id = 'SIN_MATCH' then 0e0 else {grid("p * cap")} end as model_history_weight, candidate_source from (select c.*, strength / sum(strength) over (partition by c.sale_id) as p,
    case when d.member_id <> 'SIN_MATCH' then match_weight when decision = 'AMBIGUO' then 0.2e0 when decision = 'EVIDENCIA_INSUFICIENTE' then 0.1e0 else 0e0 end as cap from
    (select sale_id, cast(member_id as varchar) as member_id, exp(12e0 * (evidence_confidence - 0.75e0)) as strength, evidence_confidence, 'DIRECT_IDENTITY' as candidate_source from scored union all select sale_id, 'SIN_MATCH', 1e0, 0e0, 'NO_MATCH_PRIOR' from sale) c join decided d on c.sale_id = d.sale_id)"""
put("candidate_probability_rules", "sale", "select sale_id, cast(candidate_rank as int) as candidate_rank, * exclude (sale_id, candidate_rank) from probable", **FULL, probable=PROBABLE)
RUNNER = {"confidence": "evidence_confidence", "email_score": "email_score", "phone_score": "phone_score", "name_score": "name_score"}
DIAGNOSED = f"""select s.sale_id, d.member_id, d.confidence, case when d.decision = 'MATCH' then t.match_method else d.decision end as match_method, d.match_weight, d.decision, coalesce(x.n, 0) as candidate_count,
    coalesce(cast(x.by_email as varchar), 'SIN_MATCH') as exact_email_candidate, coalesce(cast(x.by_phone as varchar), 'SIN_MATCH') as exact_phone_candidate, coalesce(x.by_email <> x.by_phone, false) as exact_contact_conflict,
    coalesce(cast(t.member_id as varchar), 'SIN_MATCH') as top_candidate, coalesce(t.evidence_confidence, 0e0) as top_raw_confidence, coalesce(cast(u.member_id as varchar), 'SIN_MATCH') as runner_up_candidate,
    {", ".join(f"coalesce(u.{c}, 0e0) as runner_up_{name}" for name, c in RUNNER.items())}, d.margin as confidence_margin, {", ".join(f"coalesce(t.{c}, 0e0) as {c}" for c in ("email_score", "phone_score", "name_score"))}
    from sale s join decided d on s.sale_id = d.sale_id left join ordered t on t.sale_id = s.sale_id and t.k = 1 left join ordered u on u.sale_id = s.sale_id and u.k = 2
    left join (select sale_id, count(*) as n, min(member_id) filter (where email_score >= 1) as by_email, min(member_id) filter (where phone_score >= 1) as by_phone from scored group by sale_id) x on x.sale_id = s.sale_id"""
SECOND = {
    **FULL,
    "ordered": "select *, row_number() over (partition by sale_id order by evidence_confidence desc, name_score desc, email_score + phone_score desc, member_id) as k from scored",
    "diagnosed": DIAGNOSED,
    "keyed": f"select *, {token_key('buyer_name')} as name_key from sale",
    "seeds": "select k.*, cast(d.member_id as bigint) as member_id from diagnosed d join keyed k on d.sale_id = k.sale_id where d.decision = 'MATCH' and d.confidence >= 0.95 and d.name_score >= 0.95 and k.name_key <> ''",
    "by_email": "select name_key, email, min(member_id) as member_id from seeds where email is not null group by name_key, email having count(distinct member_id) = 1",
    "by_phone": "select name_key, phone, min(member_id) as member_id from seeds where phone is not null group by name_key, phone having count(distinct member_id) = 1",
    "votes": """select k.sale_id, d.decision, a.member_id as m1, b.member_id as m2 from diagnosed d join keyed k on d.sale_id = k.sale_id left join by_email a on a.name_key = k.name_key and a.email = k.email left join by_phone b on b.name_key = k.name_key and b.phone = k.phone
        where d.member_id = 'SIN_MATCH' and (a.member_id is not null or b.member_id is not null)""",
    "judged": """select v.sale_id, coalesce(m1, m2) as alias_member, coalesce(m1 <> m2, false) as contradictory, case when m1 is null or m2 is null then 1 else 2 end as signals, concat_ws('+', case when m1 is not null then 'NOMBRE+EMAIL_ALIAS' end, case when m2 is not null then 'NOMBRE+TELEFONO_ALIAS' end) as sources,
        not coalesce(m1 <> m2, false) and (decision = 'SIN_CANDIDATO_DE_CONTACTO' or c.sale_id is not null) as fits from votes v left join scored c on c.sale_id = v.sale_id and c.member_id = coalesce(m1, m2)""",
    "after_alias": """select d.sale_id, case when fits then cast(alias_member as varchar) else d.member_id end as member_id, case when fits then case when signals >= 2 then 0.9e0 else 0.82e0 end else d.confidence end as confidence, case when fits then sources else d.match_method end as match_method,
        case when fits then case when signals >= 2 then 0.55e0 else 0.35e0 end else d.match_weight end as match_weight, case when fits then 'MATCH_ALIAS' else d.decision end as decision, case when fits then cast(alias_member as varchar) else d.top_candidate end as top_candidate,
        case when fits then case when signals >= 2 then 0.9e0 else 0.82e0 end else d.top_raw_confidence end as top_raw_confidence, d.* exclude (sale_id, member_id, confidence, match_method, match_weight, decision, top_candidate, top_raw_confidence), cast(coalesce(signals, 0) as int) as alias_signals,
        case when signals is null then 'NO_APLICA' when contradictory then 'ALIAS_CONTRADICTORIOS' when not fits then 'ALIAS_NO_COMPATIBLE_CON_CANDIDATOS' else sources end as alias_source from diagnosed d left join judged j on d.sale_id = j.sale_id""",
    "every_candidate": """select sale_id, cast(member_id as varchar) as member_id, evidence_confidence, 1e0 as source_reliability, 'DIRECT_IDENTITY' as candidate_source, match_method, email_score, phone_score, name_score from scored
        union all select sale_id, cast(alias_member as varchar), case when signals >= 2 then 0.9e0 else 0.82e0 end, case when signals >= 2 then 0.55e0 else 0.35e0 end, 'LEARNED_ALIAS', sources, 0e0, 0e0, 1e0 from judged where not contradictory""",
    "collapsed": """select sale_id, member_id, sum(exp(12e0 * (evidence_confidence - 0.75e0)) * source_reliability) as strength, array_to_string(list_sort(list(distinct candidate_source)), '+') as candidate_source,
        max({'evidence_confidence': evidence_confidence, 'source_reliability': source_reliability, 'match_method': match_method, 'email_score': email_score, 'phone_score': phone_score, 'name_score': name_score}) as best from every_candidate group by sale_id, member_id""",
    "ranked_all": f"""select c.sale_id, cast(row_number() over (partition by c.sale_id order by strength desc, c.member_id = 'SIN_MATCH', c.member_id) as int) as candidate_rank, c.member_id, {grid("strength / sum(strength) over (partition by c.sale_id)")} as candidate_probability, evidence_confidence,
        case when c.member_id = 'SIN_MATCH' then 0e0 else {grid("strength / sum(strength) over (partition by c.sale_id) * case when d.member_id <> 'SIN_MATCH' then d.match_weight when decision = 'AMBIGUO' then 0.2e0 when decision = 'EVIDENCIA_INSUFICIENTE' then 0.1e0 else 0e0 end")} end as model_history_weight,
        candidate_source, c.match_method, c.email_score, c.phone_score, c.name_score from (select sale_id, member_id, strength, best.evidence_confidence, candidate_source, best.match_method, best.email_score, best.phone_score, best.name_score from collapsed
        union all select sale_id, 'SIN_MATCH', 1e0, 0e0, 'NO_MATCH_PRIOR', 'NUEVO_O_NO_IDENTIFICADO', 0e0, 0e0, 0e0 from sale) c join after_alias d on c.sale_id = d.sale_id""",
}
put("match_diagnostics_rules", "sale", "select * from diagnosed", **SECOND)
put("alias_applied_rules", "sale", "select * from after_alias", **SECOND)
put("alias_report_rules", "sale", f"""select (select count(*) from seeds) as seeds, (select count(*) from by_email) as learned_email_aliases, (select count(*) from by_phone) as learned_phone_aliases, {big("count(*) filter (where decision = 'MATCH_ALIAS')")} as recovered,
    {big("count(*) filter (where alias_source = 'ALIAS_CONTRADICTORIOS')")} as contradictory, {big("count(*) filter (where alias_source = 'ALIAS_NO_COMPATIBLE_CON_CANDIDATOS')")} as rejected from after_alias""", **SECOND)
put("candidate_probability_all_rules", "sale", "select * from ranked_all", **SECOND)
put("unmatched_detail_rules", "sale", """select a.sale_id, s.buyer_name, s.email, s.phone, case when a.decision = 'SIN_CANDIDATO_DE_CONTACTO' then 'NEW_OR_UNKNOWN' else 'UNRESOLVED_IDENTITY' end as buyer_status, a.member_id, a.confidence, r.candidate_probability as no_match_probability, a.top_candidate, a.top_raw_confidence, a.decision
    from after_alias a join sale s on a.sale_id = s.sale_id join ranked_all r on r.sale_id = a.sale_id and r.member_id = 'SIN_MATCH' where a.member_id = 'SIN_MATCH'""", **SECOND)
put("method_report_rules", "sale", f"""select decision, match_method, count(*) as sales, {big("count(*) filter (where exact_contact_conflict)")} as conflicts, {big("count(*) filter (where exact_contact_conflict and member_id <> 'SIN_MATCH')")} as resolved from after_alias group by decision, match_method""", **SECOND)
KNOWN = "select member_id, use_rate, tickets_total * 1e0 as tickets_total, tickets_used * 1e0 as tickets_used, cast(has_membership as double) as membership, (member_id % 500) * 1e0 as points, friends_count * 1e0 as friends_count, cast(coalesce(tickets_total, 0) > 0 as double) as past from profile"
KNOWN = KNOWN.replace("use_rate,", "coalesce(use_rate, 0e0) as use_rate,", 1)
MEASURES = ("use_rate", "tickets_total", "tickets_used", "membership", "points", "friends_count")
MEASURED = {
    **SECOND,
    "profile": PROFILE,
    "known": KNOWN,
    "priors": "select coalesce(avg(use_rate) filter (where past = 1), 0e0) as prior_use_rate, " + ", ".join(f"coalesce(avg({m}), 0e0) as prior_{m}" for m in MEASURES[1:]) + " from known",
    "blended": f"""select sale_id, count(distinct c.member_id) as candidates, max(candidate_probability) as top_probability, sum(model_history_weight) as iw, sum(model_history_weight * past) as hw, sum(model_history_weight * past * use_rate) as s_use_rate,
        {", ".join(f"sum(model_history_weight * {m}) as s_{m}" for m in MEASURES[1:])} from ranked_all c join known k on cast(k.member_id as varchar) = c.member_id group by sale_id""",
    "identity": f"""select s.sale_id, a.member_id, a.confidence, case when a.member_id = 'SIN_MATCH' then case when coalesce(candidates, 0) = 0 then 'NEW_OR_UNKNOWN' else 'UNRESOLVED_IDENTITY' end when contains(m.candidate_source, 'LEARNED_ALIAS') then 'ALIAS_PROBABLE'
        when a.confidence >= 0.9 then 'DIRECT_HIGH' else 'DIRECT_PROBABLE' end as match_status, case when a.member_id <> 'SIN_MATCH' then m.candidate_source end as match_source, coalesce(candidates, 0) as candidates, coalesce(top_probability, 0e0) as top_probability, n.candidate_probability as no_match_probability,
        {grid("least(greatest(coalesce(iw, 0e0), 0e0), 1e0)")} as identity_weight, {grid("least(greatest(coalesce(hw, 0e0), 0e0), 1e0)")} as history_weight, {", ".join(grid(f"coalesce(s_{m}, 0e0) + (1 - least(greatest(coalesce({'hw' if m == 'use_rate' else 'iw'}, 0e0), 0e0), 1e0)) * prior_{m}") + f" as expected_{m}" for m in MEASURES)}
        from sale s join after_alias a on a.sale_id = s.sale_id left join blended b on b.sale_id = s.sale_id join ranked_all n on n.sale_id = s.sale_id and n.member_id = 'SIN_MATCH' left join ranked_all m on m.sale_id = s.sale_id and m.member_id = a.member_id, priors""",
}
put("identity_features_rules", "sale history social", "select * from identity", **MEASURED)
put("set_symdiff", "sale ticket", "(select event_id, 'sale' as side from (select event_id from sale except select event_id from ticket)) union all (select event_id, 'ticket' from (select event_id from ticket except select event_id from sale))")
put("distinct_sources", "sale ticket", "select t.event_id, array_to_string(list_sort(list(distinct channel)), '+') as sources from ticket t join sale s on t.sale_id = s.sale_id group by t.event_id")

N = ", ".join(f"{big(f"count(*) filter (where ticket_type = '{t}')")} as n_{k}" for k, t in enumerate(TICKET_TYPES))
MIX = f"select event_id, issued, n_0, n_1, n_2, n_3, {', '.join(f'{grid(f"n_{k} * 1e0 / issued")} as share_{k}' for k in range(4))}, {grid('m')} as mean_price from (select event_id, count(*) as issued, {N}, avg(price) as m from ticket group by event_id)"
put("event_mix_pivot", "ticket", MIX)
STAR = f"""select ticket_id, t.event_id, t.sale_id, ticket_type, channel, price, qty, is_residency, issued, share_3, {grid("case when mean_price > 0 then price / mean_price else 0e0 end")} as price_ratio, capacity - issued as remaining_capacity,
    {grid("(epoch_us(e.starts_at) - epoch_us(purchased_at)) / 3.6e9")} as lead_hours, cast(isodow(e.starts_at) - 1 as int) as weekday_number, isodow(e.starts_at) >= 6 as is_weekend
    from ticket t left join sale s on t.sale_id = s.sale_id left join event e on t.event_id = e.event_id left join mix m on t.event_id = m.event_id"""
put("star_features", "ticket sale event", STAR, mix=MIX)
put("training_rows_rules", "ticket sale event history social", f"""select s.*, confidence, match_status, candidates, top_probability, no_match_probability, identity_weight, history_weight,
    {", ".join(grid(f"prior_{m} + (expected_{m} - prior_{m}) / greatest(coalesce(qty, 1), 1)") + f" as expected_{m}" for m in MEASURES)}, {", ".join(grid(f"{w} / greatest(coalesce(qty, 1), 1)") + f" as ticket_{w}" for w in ("identity_weight", "history_weight"))}
    from star s left join identity i on s.sale_id = i.sale_id, priors""", **MEASURED, mix=MIX, star=STAR)
put("star_guard", "ticket sale event", "select 'sale_id' as dimension, count(*) as rows from ticket where sale_id not in (select sale_id from sale where sale_id % 7 <> 0) union all select 'event_id', count(*) from ticket where event_id not in (select event_id from event)")
put("weighted_profile_rules", "sale history social", f"""select sale_id, {grid("w1")} as history_weight, {grid("x1 + (1 - w1) * prior_use_rate")} as use_rate, {grid("x2 + (1 - w1) * prior_tickets")} as tickets_total, members, {grid("top")} as top_weight from
    (select sale_id, least(greatest(sum(w), 0e0), 1e0) as w1, sum(w * coalesce(use_rate, 0e0)) as x1, sum(w * tickets_total) as x2, count(distinct c.member_id) as members, max(w) as top from
    (select sale_id, try_cast(member_id as bigint) as member_id, model_history_weight as w from probable where member_id <> 'SIN_MATCH' and model_history_weight > 0) c join profile f on c.member_id = f.member_id group by sale_id),
    (select coalesce(avg(use_rate), 0e0) as prior_use_rate, coalesce(avg(tickets_total), 0e0) as prior_tickets from profile)""", **FULL, probable=PROBABLE, profile=PROFILE)
put("companion_shrink", "sale", f"select sale_id, {grid('200e0 + (subtotal / 1000e0 - 200e0) / greatest(qty, 1)')} as shrunk from sale")
put("match_status_rules", "sale", "select sale_id, case when decision = 'MATCH' and match_weight >= 0.95 then 'FIRME' when decision = 'MATCH' then 'PROBABLE' when match_weight > 0 then 'INCIERTO' else 'SIN_HISTORIAL' end as status from decided", **FULL)

LABELLED = "select ticket_id, event_id, ticket_type, price, cast(checked_in as int) as label from ticket where checked_in is not null"
put("smoothed_rate", "ticket", f"select ticket_type, count(*) as n, {grid('(sum(label) + 30e0 * any_value(g)) / (count(*) + 30e0)')} as rate from labelled, (select avg(label) as g from labelled) group by ticket_type", labelled=LABELLED)
HASH = "cast(concat('0x', substr(md5(cast(event_id as varchar)), 1, 8)) as bigint) % 2147483648"
FOLDS = f"select event_id, cast((row_number() over (order by floor({HASH} / 33554432), {HASH}, event_id) - 1) % 5 as int) as fold from (select distinct event_id from labelled)"
put("group_kfold", "ticket", FOLDS, labelled=LABELLED)


def oof(by: str) -> str:
    return f"""select '{"type_rate" if by == "ticket_type" else "global_rate"}' as model, r.*, c.p from rows r join (select c.fold, c.k, (t.y - c.y + 30e0 * (a.y - f.y) / (a.n - f.n)) / (t.n - c.n + 30e0) as p from (select fold, {by} as k, count(*) as n, sum(label) as y from rows group by 1, 2) c
        join (select {by} as k, count(*) as n, sum(label) as y from rows group by 1) t on c.k = t.k join (select fold, count(*) as n, sum(label) as y from rows group by fold) f on c.fold = f.fold, (select count(*) as n, sum(label) as y from rows) a) c on r.fold = c.fold and {"r.ticket_type" if by == "ticket_type" else by} = c.k"""


OOF = {"labelled": LABELLED, "folds": FOLDS, "rows": "select l.*, f.fold from labelled l join folds f on l.event_id = f.event_id", "oof": f"{oof('ticket_type')} union all {oof("'x'")}"}
EVENTS = {**OOF, "events_p": "select model, event_id, count(*) as tickets, cast(sum(label) as bigint) as actual, sum(p) as predicted, sum(label) - sum(p) as residual from oof group by model, event_id"}
put("oof_baseline", "ticket", f"select model, fold, ticket_type, count(*) as n, {grid('max(p)')} as p from oof group by model, fold, ticket_type", **OOF)
CLIP = "least(greatest(p, 1e-6), 1 - 1e-6)"
put("metrics_ticket", "ticket", f"select model, count(*) as n, {grid('avg((p - label) ** 2)')} as brier, {grid(f'avg(-(label * ln({CLIP}) + (1 - label) * ln(1 - {CLIP})))')} as log_loss from oof group by model", **OOF)
put("auc_rank", "ticket", f"select model, {grid('sum(pos * (below + neg / 2e0)) / nullif(sum(pos) * sum(neg), 0)')} as auc from (select *, coalesce(sum(neg) over (partition by model order by p rows between unbounded preceding and 1 preceding), 0) as below from (select model, p, sum(label) as pos, sum(1 - label) as neg from oof group by model, p)) group by model", **OOF)
METRICS = f"select model, count(*) as events, {grid('avg(abs(residual))')} as mae, {grid('sqrt(avg(residual * residual))')} as rmse, {grid('100 * sum(abs(residual)) / sum(actual)')} as wape, {grid('avg(-residual)')} as bias, {big('sum(actual)')} as actual_total, {grid('sum(predicted)')} as predicted_total from events_p group by model"
put("metrics_event", "ticket", METRICS, **EVENTS)
put("model_rank", "ticket", f"select m.model, mae, wape, brier, cast(row_number() over (order by mae, wape, brier, m.model) as int) as rank from metrics m join (select model, {grid('avg((p - label) ** 2)')} as brier from oof group by model) b on m.model = b.model", **EVENTS, metrics=METRICS)
INTERVAL = f"select model, {grid('quantile_cont(c, 0.1)')} as q10, {grid('quantile_cont(c, 0.9)')} as q90, {grid('stddev_samp(c)')} as sd from (select model, residual - avg(residual) over (partition by model) as c from events_p) group by model"
put("residual_interval", "ticket", INTERVAL, **EVENTS)
ONE = "floor(({}) * 10 + 0.5e0) / 10e0"
HELD = "least(greatest({}, 0e0), tickets * 1e0)"
FORECAST = f"""select event_id, {ONE.format(HELD.format("expected"))} as expected_attendance, {ONE.format(HELD.format(f"least({HELD.format('expected')}, expected + q10)"))} as p10, {ONE.format(HELD.format(f"greatest({HELD.format('expected')}, expected + q90)"))} as p90
    from (select event_id, count(*) as tickets, sum(p) as expected from ticket t join (select ticket_type, (sum(label) + 30e0 * any_value(g)) / (count(*) + 30e0) as p from labelled, (select avg(label) as g from labelled) group by ticket_type) r on t.ticket_type = r.ticket_type where checked_in is null group by event_id), (select * from spread where model = 'type_rate')"""
put("forecast_interval", "ticket", FORECAST, **EVENTS, spread=INTERVAL)
put("web_model", "ticket", f"select event_id, expected_attendance as baseline, {grid('greatest((p90 - p10) / (2 * 1.2816e0), 0.1e0)')} as sd from forecast", **EVENTS, spread=INTERVAL, forecast=FORECAST)
DIFF = "select event_id, max(abs(residual)) filter (where model = 'type_rate') - max(abs(residual)) filter (where model = 'global_rate') as d from events_p p group by event_id"
POISSON = "case " + " ".join(f"when u < {round(65536 * sum(1 / factorial(j) for j in range(k + 1)) / e)} then {k}" for k in range(9)) + " else 9 end"
put("bootstrap_interval", "ticket", f"""select count(*) as draws, {grid("avg(m)")} as mean, {grid("quantile_cont(m, 0.025)")} as low, {grid("quantile_cont(m, 0.975)")} as high from (select b, sum(w * d) / sum(w) as m from (select 8 * j + k as b, d, {POISSON} as w from
    (select j, k, d, cast(concat('0x', substr(h, 4 * k + 1, 4)) as int) as u from (select j, d, md5(concat(event_id, ':', j)) as h from diffs, range(1250) x(j)), range(8) y(k))) group by b having sum(w) > 0)""", **EVENTS, diffs=DIFF)
put("paired_wins", "ticket", f"select {big('count(*) filter (where a < b)')} as wins, count(*) as events from (select event_id, max(abs(residual)) filter (where model = 'type_rate') as a, max(abs(residual)) filter (where model = 'global_rate') as b from events_p group by event_id)", **EVENTS)

RATES = f"select t.ticket_type, coalesce(issued, 0) as issued, coalesce(attended, 0) as attended, {r4('coalesce(attended, 0) * 1e0 / greatest(coalesce(issued, 0), 1)')} as rate from (select unnest({list(TICKET_TYPES)}) as ticket_type) t left join (select ticket_type, count(*) as issued, {big('count(*) filter (where checked_in)')} as attended from past group by ticket_type) p on t.ticket_type = p.ticket_type"
ROWS = f"""select e.*, issued, attended, courtesy, variance, mix_expected, {r4("attended * 1e0 / greatest(issued, 1)")} as attendance_rate, {r4("courtesy * 1e0 / greatest(issued, 1)")} as courtesy_share, case when mix_expected > 0 then {r4("attended / mix_expected")} end as lift
    from event e join (select event_id, {big("sum(n)")} as issued, {big("sum(entered)")} as attended, {big("sum(case when t.ticket_type = 'CORTESÍA' then n else 0 end)")} as courtesy, {r4("sum(n * rate)")} as mix_expected, sum(n * rate * (1 - rate)) as variance
    from (select event_id, ticket_type, count(*) as n, count(*) filter (where checked_in) as entered from past group by event_id, ticket_type) t join rates r on t.ticket_type = r.ticket_type group by event_id) x on e.event_id = x.event_id"""
PAST = {"past": "select t.* from ticket t join event e on t.event_id = e.event_id where not is_upcoming"}
CUBE = {**PAST, "rates": RATES, "rows": ROWS}
put("rate_by_type", "ticket event", RATES, **PAST)
put("member_rate", "history", f"select type, count(*) as n, {COUNT_USED} as hits, {r4(f'{COUNT_USED} * 1e0 / greatest(count(*), 1)')} as rate from history group by type")
put("event_rows", "ticket event", f"select event_id, issued, attended, courtesy, mix_expected, attendance_rate, courtesy_share, lift, {r4('variance')} as variance from rows", **CUBE)


def over_keys(body: str, *keys: str) -> str:
    return " union all ".join(body.replace("KEY", f"cast({k} as varchar)").replace("NAME", f"'{k}'") for k in keys)


LIFT = f"select NAME as dimension, KEY as key, count(*) as events, {r4('sum(attended) / greatest(sum(mix_expected), 1)')} as raw, {r4('(sum(attended) + 120e0) / (sum(mix_expected) + 120e0)')} as lift from rows where KEY is not null group by KEY"
put("lift_shrunk", "ticket event", over_keys(LIFT, "artist_id", "venue", "weekday"), **CUBE)
PHI = f"select count(*) as events, {r4('greatest(1e0, coalesce(avg(case when variance > 0 then (attended - mix_expected) ** 2 / variance else 1e0 end), 0e0))')} as phi from rows where issued >= 20"
put("overdispersion", "ticket event", PHI, **CUBE)
FIT = f"select count(*) as n, {grid('coalesce(regr_slope(Y, courtesy_share), 0)')} as slope, {grid('coalesce(regr_intercept(Y, courtesy_share), avg(Y), 0)')} as intercept, {grid('coalesce(regr_r2(Y, courtesy_share), 0)')} as r2, 'NAME' as y from rows where issued >= 20 and Y is not null"
put("ols_dilution", "ticket event", FIT.replace("Y", "attendance_rate").replace("NAME", "rate") + " union all " + FIT.replace("Y", "lift").replace("NAME", "lift"), **CUBE)
CUT = f"select NAME as dimension, KEY as key, count(*) as events, {', '.join(f'{big(f"sum({m})")} as {m}' for m in ('issued', 'attended', 'capacity', 'courtesy'))}, {r4('sum(attended) * 1e0 / greatest(sum(issued), 1)')} as rate, {r4('sum(issued) * 1e0 / greatest(sum(capacity), 1)')} as fill, {r4('sum(courtesy) * 1e0 / greatest(sum(issued), 1)')} as courtesy_share from rows group by KEY"
put("cube_cuts", "ticket event", over_keys(CUT, "city", "venue", "weekday", "is_residency"), **CUBE)
put("top_venues", "ticket event", f"select key, issued, rate from ({over_keys(CUT, 'venue')}) order by issued desc, key limit 12", **CUBE)
DAYS = f"{list(WEEKDAYS)}"
put("weekday_order", "ticket event", f"select cast(weekday + 1 as int) as place, {DAYS}[weekday + 1] as key, count(*) as events, {big('sum(issued)')} as issued, {r4('sum(attended) * 1e0 / greatest(sum(issued), 1)')} as rate from rows group by weekday", **CUBE)
put("fullest_events", "event artist ticket", "select s.event_id, fill_rate, starts_at from summary s join event e on s.event_id = e.event_id order by fill_rate desc nulls last, starts_at nulls last, s.event_id limit 15", summary=SUMMARY)
put("channel_cut", "ticket event sale", f"select channel, count(*) as n, {big('count(*) filter (where checked_in)')} as hits, {r4('count(*) filter (where checked_in) * 1e0 / greatest(count(*), 1)')} as rate from past p join sale s on p.sale_id = s.sale_id group by channel", **PAST)
put("arrival_curve", "ticket event", f"select minutes, n, {r4('n * 1e0 / greatest(sum(n) over (), 1)')} as share from (select cast(greatest(-120, least(120, floor(minutes_from_start / 15e0) * 15)) as int) as minutes, count(*) as n from past where checked_in group by 1)", **PAST)
put("hist10", "ticket event", "select b.i as bin, coalesce(n, 0) as n from range(10) b(i) left join (select cast(least(floor(attendance_rate * 10), 9) as bigint) as bin, count(*) as n from rows where attendance_rate is not null group by 1) h on b.i = h.bin", **CUBE)
put("totals", "ticket event", f"select count(*) as events, {', '.join(f'{big(f"coalesce(sum({m}), 0)")} as {m}' for m in ('issued', 'attended', 'capacity', 'courtesy'))} from rows", **CUBE)
put("no_shows", "ticket event", f"""select absent, {r4("free_absent * 1e0 / nullif(absent, 0)")} as courtesy_part, {r4("((paid - absent + free_absent) * 1e0 / nullif(paid, 0)) / nullif((free - free_absent) * 1e0 / nullif(free, 0), 0)")} as rate_ratio from (select {big("count(*) filter (where not coalesce(checked_in, false))")} as absent,
    {big("count(*) filter (where not coalesce(checked_in, false) and ticket_type = 'CORTESÍA')")} as free_absent, {big("count(*) filter (where ticket_type = 'CORTESÍA')")} as free, {big("count(*) filter (where ticket_type <> 'CORTESÍA')")} as paid from past)""", **PAST)
put("pearson", "ticket event", f"select {grid('corr(courtesy_share, attendance_rate)')} as r, count(*) as n from rows", **CUBE)

PLANS = {
    **CUBE, "mix": MIX, "lifts": over_keys(LIFT, "artist_id", "venue"), "dispersion": PHI,
    "plans": f"""select e.event_id, capacity, issued, n_0, n_1, n_2, n_3, {", ".join(f"(select rate from rates where ticket_type = '{t}') as rate_{k}" for k, t in enumerate(TICKET_TYPES))}, 0.5e0 as rate_membership, 0.75e0 as rate_consumption,
    case when a.lift is null and v.lift is null then 1e0 else (coalesce(a.lift, 0e0) + coalesce(v.lift, 0e0)) / (cast(a.lift is not null as int) + cast(v.lift is not null as int)) end as lift, (select phi from dispersion) as phi,
    e.event_id % 10 as courtesy, e.event_id % 4 as membership, e.event_id % 6 as consumption, e.event_id % 3 as converted, case when e.event_id % 4 = 1 then issued * 0.8e0 end as baseline, case when e.event_id % 4 = 1 then 3.5e0 end as baseline_sd
    from event e join mix m on e.event_id = m.event_id left join lifts a on a.dimension = 'artist_id' and a.key = cast(e.artist_id as varchar) left join lifts v on v.dimension = 'venue' and v.key = e.venue where is_upcoming""",
}
Z = "((capacity - demand_x) / sd_x)"
T = f"(1 / (1 + 0.2316419e0 * abs({Z})))"
TAIL = f"(0.3989423e0 * exp(-{Z} * {Z} / 2) * {T} * (0.3193815e0 + {T} * (-0.356538e0 + {T} * (1.781478e0 + {T} * (-1.821256e0 + {T} * 1.330274e0)))))"


def half_up(x: str) -> str:
    return big(f"floor({x} + 0.5e0)")


def projected(source: str) -> str:
    """The projection of a table of plans, every input column kept."""
    free = "(courtesy * rate_3 * F3 + membership * rate_membership * F5 + consumption * rate_consumption * F7)"
    plain = free.replace("F3", "1").replace("F5", "1").replace("F7", "1")
    spread = free.replace("F3", "(1 - rate_3)").replace("F5", "(1 - rate_membership)").replace("F7", "(1 - rate_consumption)")
    own = "(n_0 * rate_0 + n_1 * rate_1 + n_2 * rate_2 + (n_3 - conv) * rate_3 + conv * paid)"
    own_spread = "(n_0 * rate_0 * (1 - rate_0) + n_1 * rate_1 * (1 - rate_1) + n_2 * rate_2 * (1 - rate_2) + (n_3 - conv) * rate_3 * (1 - rate_3) + conv * paid * (1 - paid))"
    return f"""select *, {half_up("expected_x")} as expected, {half_up("demand_x")} as demand, {grid("sd_x")} as sd, {half_up("greatest(0e0, least(demand_x - 1.2816e0 * sd_x, capacity))")} as p10, {half_up("least(demand_x + 1.2816e0 * sd_x, capacity)")} as p90,
        {grid("expected_x / greatest(1, capacity)")} as fill_rate, {grid("emitted / greatest(1e0, expected_x)")} as tickets_per_head, {half_up("expected_x * 0.25e0")} as peak_quarter, {big(f"greatest(2, ceil({half_up('expected_x * 0.25e0')} / 60e0))")} as scanners, {big("greatest(1, ceil(expected_x / 120))")} as security,
        case when overflow_risk > 0.35 then 'critical' when overflow_risk > 0.15 then 'warning' else 'good' end as risk_class, {half_up("greatest(demand_x - capacity, 0e0)")} as turned_away from (select *, least(demand_x, capacity * 1e0) as expected_x,
        {grid(f"case when {Z} > 0 then 1 - (1 - {TAIL}) else 1 - {TAIL} end")} as overflow_risk from (select *, coalesce(baseline, {own} * lift) + {plain} * lift as demand_x, {big("n_0 + n_1 + n_2 + n_3 + courtesy + membership + consumption")} as emitted,
        case when baseline_sd is not null then sqrt(baseline_sd ** 2 + {spread} * phi) else sqrt(greatest({own_spread} + {spread}, 1e0) * phi) end as sd_x from (select *, least(converted, n_3) as conv,
        case when n_0 + n_1 + n_2 > 0 then (n_0 * rate_0 + n_1 * rate_1 + n_2 * rate_2) / (n_0 + n_1 + n_2) else rate_0 end as paid from {source})))"""


put("project_levers", "ticket event", "select event_id, expected, demand, p10, p90, sd, overflow_risk, emitted, fill_rate, tickets_per_head, scanners, security, peak_quarter, risk_class, turned_away from projection", **PLANS, projection=projected("plans"))
put("risk_classes", "ticket event", f"select risk_class, count(*) as n, {big('sum(turned_away)')} as turned_away from projection group by risk_class", **PLANS, projection=projected("plans"))
VOLUME = f"""select p.* exclude (courtesy, membership, consumption), x, {half_up("x * case when free > 0 then courtesy * 1e0 / free else 1e0 end")} as courtesy, {half_up("x * case when free > 0 then membership * 1e0 / free else 0e0 end")} as membership, {half_up("x * case when free > 0 then consumption * 1e0 / free else 0e0 end")} as consumption
    from (select *, {half_up("greatest(20, ceil((capacity - issued) * 1.4e0), free + 20) * step / 28e0")} as x from (select *, courtesy + membership + consumption as free from plans), (select cast(i as int) as step from range(29) r(i))) p"""
put("sweep_volume", "ticket event", "select event_id, step, x, expected, p10, p90, overflow_risk, emitted from projection", **PLANS, volumes=VOLUME, projection=projected("volumes"))
SPLIT = f"""select * exclude (courtesy, membership, consumption), c as courtesy, f as membership, budget - c - f as consumption from (select *, {half_up("(budget - c) * case when membership + consumption > 0 then membership * 1e0 / (membership + consumption) else 0.5e0 end")} as f
    from (select *, {half_up("budget * step / 20e0")} as c from (select *, courtesy + membership + consumption as budget from plans), (select cast(i as int) as step from range(21) r(i)) where budget > 0))"""
put("sweep_split", "ticket event", "select event_id, step, expected, p10, p90, overflow_risk, emitted from projection", **PLANS, splits=SPLIT, projection=projected("splits"))
TRIES = """select * exclude (courtesy, membership, consumption), case when best = 'courtesy' then n else 0 end as courtesy, case when best = 'membership' then n else 0 end as membership, case when best = 'consumption' then n else 0 end as consumption from
    (select *, case when rate_3 >= rate_membership and rate_3 >= rate_consumption then 'courtesy' when rate_membership >= rate_consumption then 'membership' else 'consumption' end as best, unnest(range(0, greatest(capacity, 0) + 1, 2)) as n from plans)"""
put("recommend", "ticket event", f"""select g.event_id, best as best_lever, s as suggested_free, greatest(0, any_value(capacity) - max(p90) filter (where n = 0)) as headroom, max(expected) filter (where n = s) - max(expected) filter (where n = 0) as gain, max(overflow_risk) filter (where n = s) as risk_at
    from projection g join (select event_id, {big("coalesce(greatest(min(n) filter (where overflow_risk > 0.15) - 2, 0), max(n))")} as s from projection group by event_id) k on g.event_id = k.event_id group by g.event_id, best, s""", **PLANS, tries=TRIES, projection=projected("tries"))
put("override_coalesce", "event", "select event_id, case when event_id % 3 = 0 then 12.5e0 else capacity * 1e0 end as expected, case when event_id % 3 = 0 then 'model' else 'local' end as origin from event")
