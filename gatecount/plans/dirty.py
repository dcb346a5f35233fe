"""Raw tables of strings as they come before cleaning: the roles with blanks, other spellings, bad values and repeated rows.

Every rule follows from a row's number over the whole table, so that each cleaning rule meets rows, and is SQL that Spark and
DuckDB read alike. ``{role}`` names another role.
"""

from __future__ import annotations

from ..schema import MEMBER_TICKET_SOURCES, WEEKDAYS


def _at(words: tuple[str, ...], number: str) -> str:
    return f"split_part('{','.join(words)}', ',', cast({number} % {len(words)} + 1 as int))"


def _dirty_email(n: str, email: str) -> str:
    return f"case {n} % 6 when 0 then upper({email}) when 1 then ' mailto:' || {email} when 2 then replace({email}, '@', '+club@') when 3 then replace({email}, 'mail.com', 'gmial.com') else {email} end"


def _dirty_phone(n: str, phone: str) -> str:
    return f"case {n} % 5 when 0 then '+57 ' || {phone} when 1 then substring({phone}, 1, 3) || '-' || substring({phone}, 4, 7) when 2 then '(' || {phone} || ') ' else {phone} end"


RAW = {
    "raw_member": f"""with b as (select c_custkey as n, case when c_custkey % 151 = 7 then '' else cast(member_id as string) end as member_id, case when c_custkey % 37 = 0 then null when c_custkey % 3 = 0 then lower(first_name) else ' ' || first_name || '  ' end as first_name,
        case when c_custkey % 37 = 0 then '' when c_custkey % 4 = 0 then lower(last_name) else last_name end as last_name, case when c_custkey % 37 = 0 then 'none' else {_dirty_email("c_custkey", "email")} end as email, case when c_custkey % 37 = 0 then '555' else {_dirty_phone("c_custkey", "phone")} end as phone,
        case when c_custkey % 29 = 1 then ' ' else city end as city, case when c_custkey % 23 = 4 then 'yesterday' else concat('2024-01-', lpad(cast(c_custkey % 28 + 1 as string), 2, '0'), ' 10:00:00') end as created_at,
        case when c_custkey % 19 = 2 then '' when has_membership then 'Sí' else 'no' end as has_membership, case when c_custkey % 2 = 0 then '2023-05-06 07:08:09' end as membership_since,
        case c_custkey % 9 when 0 then '-3' when 1 then 'many' when 2 then '12.5' else cast(c_custkey % 500 as string) end as points from {{member}} m join {{customer}} c on m.member_id = c.c_custkey)
        select member_id, first_name, last_name, email, phone, city, created_at, has_membership, membership_since, points from b union all select member_id, first_name, last_name, email, phone, city, created_at, has_membership, membership_since, points from b where n % 50 = 0
        union all select member_id, first_name, last_name, email, phone, 'Zipaquirá', created_at, has_membership, membership_since, points from b where n % 70 = 0""",
    "raw_history": f"""select cast(member_ticket_id as string) as member_ticket_id, case when member_ticket_id % 83 = 1 then null else cast(member_id as string) end as member_id, case when member_ticket_id % 71 = 2 then 'OTHER' else lower(type) end as type,
        case when member_ticket_id % 73 = 3 then '' else concat(' ', lower({_at(MEMBER_TICKET_SOURCES, "member_ticket_id")})) end as source, case when member_ticket_id % 79 = 4 then 'never' else cast(created_at as string) end as created_at,
        case when member_ticket_id % 67 = 5 then '?' when used then 'yes' else '0' end as used, case when member_ticket_id % 61 = 6 then '' else cast(date_used as string) end as date_used from {{history}}""",
    "raw_social": """select cast(member_id as string) as member_id, case member_id % 8 when 0 then '-2' when 1 then '' when 2 then '3.5' else cast(friends_count as string) end as friends_count from {social}
        union all select cast(member_id as string), '9' from {social} where member_id % 40 = 0 union all select '  ', '1' from {social} where member_id % 100 = 1""",
    "raw_artist": f"""select cast(artist_id as string) as artist_id, lower(name) as name, case when artist_id % 9 = 0 then null else home_city end as home_city, case artist_id % 3 when 0 then 'si' when 1 then 'no' else '' end as has_residency,
        case when artist_id % 2 = 0 then 'Sala Uno' end as residency_venue, case when artist_id % 4 < 3 then lower({_at(WEEKDAYS, "artist_id")}) end as residency_weekday, case when artist_id % 7 = 0 then 'x' else cast(artist_id * 3 as string) end as tickets_sold,
        case artist_id % 5 when 0 then '1.7' when 1 then '-0.2' when 2 then '' else '0.25' end as attendance_rate from {{artist}}""",
    "raw_event": f"""select cast(event_id as string) as event_id, concat(lower(title), ' ') as title, case when event_id % 101 = 3 then '0' else cast(artist_id as string) end as artist_id, case when event_id % 17 = 2 then '' else city end as city, lower(venue) as venue,
        case when event_id % 23 = 1 then null else lower({_at(WEEKDAYS, "event_id")}) end as weekday, month, case when is_residency then 'true' else 'false' end as is_residency, case when event_id % 5 > 0 then 'la sala' end as residency_venue, cast(starts_at as string) as starts_at,
        case event_id % 13 when 0 then '-1' when 1 then 'big' else cast(capacity as string) end as capacity, case when event_id % 4 = 0 then '7.0' end as checked_in_count from {{event}}
        union all select cast(event_id as string), 'again', '1', 'Cali', 'x', 'lunes', 'julio', 'true', '', '', '1', '' from {{event}} where event_id % 60 = 0""",
    "raw_sale": f"""with b as (select sale_id as n, case when sale_id % 97 = 5 then ' ' else cast(sale_id as string) end as sale_id, case when sale_id % 89 = 3 then '' when sale_id % 103 = 4 then '0' else cast(event_id as string) end as event_id,
        case when sale_id % 31 = 7 then null when sale_id % 2 = 0 then lower(buyer_name) else '  ' || buyer_name || ' ' end as buyer_name, case when sale_id % 31 = 7 then 'a@@b' else {_dirty_email("sale_id", "email")} end as email,
        case when sale_id % 31 = 7 then '12' else {_dirty_phone("sale_id", "phone")} end as phone, case when sale_id % 41 = 1 then 'x' when sale_id % 43 = 1 then '0' else concat(cast(qty as string), '.0') end as qty,
        case when sale_id % 47 = 1 then null when sale_id % 53 = 1 then '-5' else cast(subtotal as string) end as subtotal, lower(channel) as channel, case when sale_id % 59 = 1 then 'soon' else cast(purchased_at as string) end as purchased_at from {{sale}})
        select sale_id, event_id, buyer_name, email, phone, qty, subtotal, channel, purchased_at from b union all select sale_id, event_id, buyer_name, email, phone, qty, subtotal, channel, purchased_at from b where n % 50 = 0
        union all select sale_id, event_id, buyer_name, email, phone, '9', subtotal, channel, purchased_at from b where n % 70 = 0""",
    "raw_ticket": """select cast(ticket_id as string) as ticket_id, case when ticket_id % 61 = 2 then '' else cast(sale_id as string) end as sale_id, case when sale_id % 200 = 0 then cast(sale_id % 200 + 1 as string) else cast(event_id as string) end as event_id,
        case when ticket_id % 73 = 1 then 'free' else concat(lower(ticket_type), ' ') end as ticket_type, case when ticket_id % 79 = 1 then '-1' when ticket_id % 83 = 1 then 'abc' else cast(price as string) end as price,
        case when checked_in is null then '' when checked_in then 'sí' else 'NO' end as checked_in, case when checked_in and ticket_id % 67 > 0 then cast(starts_at as string) end as checked_in_at from {ticket}""",
}
NEEDS = {"raw_member": ["member"], "raw_history": ["history"], "raw_social": ["social"], "raw_artist": ["artist"], "raw_event": ["event"], "raw_sale": ["member", "sale"], "raw_ticket": ["ticket"]}
