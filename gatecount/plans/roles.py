"""The attendance model's tables as roles of the driver's tables.

Each role is SQL that Spark and DuckDB read alike, so a query and its oracle start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.merges import shuffled
from .dirty import NEEDS, RAW

#: Names and places for made-up members.
FIRST = "ANA,LUIS,MARTA,JOSE,ELENA,PABLO,LUCIA,DIEGO,SOFIA,MARIO,CLARA,BRUNO"
LAST = "GOMEZ,CASTRO,PEREZ,ROJAS,DIAZ,MORA,VEGA,LUNA,RIOS,SOTO,LEON"
CITIES = "Bogotá,Medellín,Cali,Barranquilla,Pereira"


def _pick(words: str, number: str) -> str:
    return f"split_part('{words}', ',', cast({number} % {len(words.split(','))} + 1 as int))"


ROLES = {
    "member": f"""select c_custkey as member_id, {_pick(FIRST, "c_custkey")} as first_name, {_pick(LAST, "(c_custkey * 7)")} as last_name,
        concat({_pick(FIRST, "c_custkey")}, ' ', {_pick(LAST, "(c_custkey * 7)")}) as full_name,
        concat(lower({_pick(FIRST, "c_custkey")}), '.', lower({_pick(LAST, "(c_custkey * 7)")}), cast(c_custkey as string), '@mail.com') as email,
        concat('3', lpad(cast((c_custkey * 7919 + 104729) % 1000000000 as string), 9, '0')) as phone,
        {_pick(CITIES, "c_nationkey")} as city, c_acctbal > 5000e0 as has_membership from {{customer}}""",
    "history": """select event_id as member_ticket_id, user_id as member_id, case when event_type in ('view', 'click') then 'CONSUMO_MINIMO' else 'MEMBRESIA' end as type,
        event_type in ('purchase', 'signup', 'click') as used, ts as created_at,
        case when event_type in ('purchase', 'signup', 'click') then ts + interval 36 hour end as date_used from {events}""",
    "social": "select c_custkey as member_id, cast(c_custkey % 7 as bigint) as friends_count from {customer} where c_custkey % 3 <> 0",
    "artist": f"select s_suppkey as artist_id, s_name as name, {_pick(CITIES, 's_nationkey')} as home_city from {{supplier}}",
    "event": f"""select p_partkey as event_id, p_name as title, p_partkey % 10 + 1 as artist_id, {_pick(CITIES, "p_partkey")} as city, p_type as venue,
        cast(p_partkey % 7 as int) as weekday, p_partkey % 3 = 0 as is_residency, p_partkey % 2 = 1 as is_upcoming,
        case when p_partkey % 2 = 1 then 'agosto' else 'julio' end as month, cast(p_size * 3 as bigint) as capacity, starts_at
        from {{part}} left join (select l_partkey, max(l_shipdate) as starts_at from {{lineitem}} group by l_partkey) s on p_partkey = l_partkey""",
    "ticket": """select l_orderkey * 10 + l_linenumber as ticket_id, l_orderkey as sale_id, l_partkey as event_id,
        case when l_discount < 0.02e0 then 'CORTESÍA' when l_returnflag = 'A' then 'GENERAL' when l_returnflag = 'N' then 'PREFERENCIAL' else 'VIP' end as ticket_type,
        cast(floor(l_extendedprice) as bigint) as price,
        case when l_partkey % 2 = 1 then null when l_discount < 0.02e0 then (l_orderkey + l_linenumber) % 5 < 2 else (l_orderkey + l_linenumber) % 10 < 9 end as checked_in,
        (l_suppkey * 7 + l_linenumber * 13 + l_orderkey) % 300 - 150 as minutes_from_start, l_shipdate as starts_at from {lineitem}""",
    "sale": """select o_orderkey as sale_id, o_orderkey % 200 + 1 as event_id, cast(o_orderkey % 4 + 1 as bigint) as qty, cast(floor(o_totalprice) as bigint) as subtotal,
        case substring(o_orderpriority, 1, 1) when '1' then 'WEB' when '2' then 'BOX_OFFICE' when '3' then 'ADMIN' when '4' then 'RRPP' else 'OTRO' end as channel, o_orderdate as purchased_at,
        case when o_orderkey % 3 = 0 then m.full_name when o_orderkey % 3 = 1 then concat(m.last_name, ' ', m.first_name) else concat(substring(m.first_name, 1, 1), '. ', m.last_name) end as buyer_name,
        case when o_orderkey % 5 = 1 then concat(substring(m.email, 1, 2), substring(m.email, 4, 100)) when o_orderkey % 5 = 2 then concat(substring(m.email, 1, 4), 'x', substring(m.email, 5, 100)) when o_orderkey % 5 = 3 then null else m.email end as email,
        case when o_orderkey % 7 = 0 then null when o_orderkey % 7 = 1 then concat(substring(m.phone, 1, 3), substring(m.phone, 8, 1), substring(m.phone, 5, 3), substring(m.phone, 4, 1), substring(m.phone, 9, 2)) when o_orderkey % 7 = 2 then '3999999999' else m.phone end as phone
        from {orders} join member m on o_custkey = m.member_id""",
}
ROLES |= RAW
_NEEDS = {"sale": ["member"], **NEEDS}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels", "conversations", "pages")


def _with_needs(names: tuple[str, ...]) -> list[str]:
    out: list[str] = []
    for name in names:
        out += [x for x in [*_NEEDS.get(name, []), name] if x not in out]
    return out


def ctes(*names: str, **more: str) -> str:
    """``with`` clause of the roles for the oracle, and of more named queries."""
    parts = [f"{n} as ({ROLES[n].format(**{t: t for t in (*TABLES, *ROLES)})})" for n in _with_needs(names)] + [f"{n} as ({q})" for n, q in more.items()]
    return "with " + ",\n".join(parts) + "\n"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text, frames = ROLES[name], {}
    for t in TABLES:
        if f"{{{t}}}" in text:
            frames[t] = table(spark, sf_dir, t)
    for other in _NEEDS.get(name, []):
        text = text.replace(f"join {other} ", f"join {{{other}}} ")
        if f"{{{other}}}" in text:
            frames[other] = role(spark, sf_dir, other)
    if " join " in text:  # of tables that grow with each other
        frames = {name: shuffled(df) for name, df in frames.items()}
    return spark.sql(text, **frames)
