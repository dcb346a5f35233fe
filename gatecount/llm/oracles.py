"""DuckDB SQL for the queries of this subpackage that SQL can express.

The other queries fit models, pack, shard by hashes that DuckDB lacks, or return digests of
files; tests hold them against brute force, round trips or held-out accuracy.
"""

from __future__ import annotations

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op3_jaccard": f"""with recursive d as (select doc_id, {_WORDS.format(_LOWER)} as w from documents),
        s as (select doc_id, case when len(w) >= 5 then list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], chr(31)))) when len(w) > 0 then [array_to_string(w, chr(31))] else [] end as s from d),
        u as (select doc_id, len(s) as n, unnest(s) as x from s),
        links as (select a.doc_id as a, b.doc_id as b from u a join u b on a.x = b.x and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
        reach as (select doc_id, doc_id as root from s union select l.b, r.root from reach r join links l on r.doc_id = l.a)
        select s.doc_id, cast(len(s.s) as bigint) as n_shingles, r.component_id from s join (select doc_id, min(root) as component_id from reach group by doc_id) r on s.doc_id = r.doc_id""",
    "op5_mixing": f"""with d as (select doc_id, source, coalesce(len({_WORDS.format("text")}), 0) as size from documents),
        ranked as (select source, sum(size)::double as s, [5e0, 2e0, 1e0][(row_number() over (order by source nulls last) - 1) % 3 + 1] as w from d group by source),
        rising as (select *, 2 * s as cap, sum(s) over () * 1.5e0 as total, sum(2 * s) over up - 2 * s as before, sum(w) over () - sum(w) over up + w as w_left from ranked
            window up as (order by 2 * s / w, source nulls last rows between unbounded preceding and current row)),
        capped as (select *, cap * w_left <= (total - before) * w as full_ from rising),
        targets as (select source, s, case when full_ then cap else w * ((total - coalesce(sum(case when full_ then cap end) over (), 0e0)) / sum(case when not full_ then w end) over ()) end as target from capped),
        keyed as (select *, md5(concat('0:', coalesce(cast(doc_id as varchar), ''))) as k from d),
        placed as (select *, sum(size) over (partition by source order by cast(concat('0x', substr(k, 1, 5)) as bigint) % 1024, k, doc_id, size rows between unbounded preceding and current row) - size as pos from keyed),
        quotas as (select source, cast(ceil(round(target) / 1024) as bigint) as quota from targets where round(target) > 0),
        arcs as (select source, quota, cast(floor((sum(quota) over up - quota) * 2147483648e0 / sum(quota) over ()) as bigint) as low, cast(floor(sum(quota) over up * 2147483648e0 / sum(quota) over ()) as bigint) as high from quotas window up as (order by source nulls last rows between unbounded preceding and current row)),
        points as (select k as slot, ((k + 1) % 2147483648) * 1327217885 % 2147483648 as point from range(cast(3 * (select sum(quota) from quotas) as bigint)) r(k)),
        slots as (select slot, source, row_number() over (partition by source order by slot) - 1 as block from points join arcs on point >= low and point < high)
        select p.doc_id, cast(size as bigint) as size, cast(s as bigint) as source_size, target, cast(least(greatest(round(target) - pos, 0), size) + least(greatest(round(target) - s - pos, 0), size) as bigint) as taken, case when size > 0 and pos < round(target) then slots.slot end as slot
        from placed p join targets t on p.source is not distinct from t.source left join slots on slots.source is not distinct from p.source and slots.block = cast(pos as bigint) // 1024""",
    "op9_warc": """with p as (select page_id, cast(strlen(coalesce(html, '')) as bigint) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
        k as (select payload_digest, max(page_id) as kept from p where payload_bytes >= 1000 group by payload_digest)
        select p.page_id, payload_bytes, p.payload_digest, case when kept > page_id then 'revisit' else 'response' end as record_type, case when kept > page_id then kept end as refers_to from p left join k on p.payload_digest = k.payload_digest""",
    "op12_negatives": """with v as (select vec_id, cast(case when vec_id % 7 = 0 then (label + 1) % 10 else label end as bigint) as label, list_transform(embedding, lambda x: floor(256e0 * cast(x as double))) as q from embeddings
        where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (select a.vec_id as a, v.vec_id as c, v.label = a.label as same, cast(list_inner_product(a.q, v.q) as bigint) as score from v a join v on a.vec_id <> v.vec_id where a.vec_id % 100 = 0),
        p as (select a, c as p, score as ps from s where same qualify row_number() over (partition by a order by score desc, c) <= 5),
        n as (select p.a, p.p, p.ps, s.c, s.score, row_number() over (partition by p.a, p.p order by s.score desc, s.c) as k from p join s on p.a = s.a and not s.same and 80 * p.ps <= 100 * s.score and 100 * s.score <= 100 * p.ps)
        select a as anchor_id, p as positive_id, cast(k as int) as rank, c as negative_id, ps as positive_score, score as negative_score from n where k <= 5""",
    "op13_phrases": r"""with d as (select coalesce(lang, 'und') as lang, regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') as pieces from documents),
        w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from (select lang, unnest(pieces) as piece from d)),
        f as (select lang, array_to_string(g, ' ') as phrase, len(g) as k, count(*) as a from (select lang, unnest(list_transform(range(1, len(w) - size + 2), lambda i: w[i:i + size - 1])) as g from w, (select unnest(range(1, 6)) as size) where len(w) >= size) group by all having count(*) >= 100),
        t as (select lang, sum(len(w)) as n from w group by lang),
        whole as (select distinct lang, unnest([array_to_string(x[:k - 1], ' '), array_to_string(x[2:], ' ')]) as phrase, a from (select lang, string_split(phrase, ' ') as x, k, a from f where k > 2)),
        c as (select f.* from f anti join whole on f.lang = whole.lang and f.phrase = whole.phrase and f.a = whole.a where k > 1),
        cuts as (select c.lang, c.phrase, c.a, l.a as l, r.a as r, t.n, i, cast(1000::hugeint * c.a * t.n // (l.a::hugeint * r.a) as bigint) as score from (select *, unnest(range(1, k)) as i, string_split(phrase, ' ') as x from c) c join t on c.lang = t.lang
            join f l on l.lang = c.lang and l.phrase = array_to_string(x[:i], ' ') join f r on r.lang = c.lang and r.phrase = array_to_string(x[i + 1:], ' ')),
        low as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, i) = 1)
        select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, cast(l as bigint) as l, cast(r as bigint) as r, cast(n as bigint) as n, score from low qualify rank <= 2000""",
}
