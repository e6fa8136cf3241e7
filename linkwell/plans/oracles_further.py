"""DuckDB SQL for the queries of :mod:`linkwell.plans.further`, from their definitions and without their shortcuts."""

from __future__ import annotations

from collections.abc import Callable

WORDS = "list_sort(list_distinct(list_filter(string_split({}, ' '), lambda w: w <> '')))"


def _classes(column: str) -> str:
    words = WORDS.format(column)
    return f"""ours as materialized (select entity_id, {words} as c from s1 where len({words}) > 0),
theirs as materialized (select entity_id, {words} as c from tg where len({words}) > 0),
links as materialized (
  select *, len(list_intersect(a, b)) as overlap
  from (select distinct c as a from ours) x, (select distinct c as b from theirs) y where list_has_any(a, b))"""


def _similar(percent: int) -> str:
    return f"100 * overlap >= {percent} * (len(a) + len(b) - overlap)"


def _pairs(column: str, percent: int) -> str:
    return f"""{_classes(column)}
select o.entity_id as source1_entity_id, t.entity_id as candidate_entity_id
from links join ours o on o.c = a join theirs t on t.c = b where {_similar(percent)}"""


def _profiles(rule: str, dialect: str, pairs_sql: Callable[..., str]) -> str:
    side = "(select *, min(entity_id) over (partition by {}name_norm, country_norm) as p from {})"
    return f"""{pairs_sql(rule, dialect)}
select a.p as source1_entity_id, b.p as candidate_entity_id, count(distinct a.entity_id) as n_s1, count(distinct b.entity_id) as n_targets
from pairs join {side.format('', 's1')} a on a.entity_id = source1_entity_id
join {side.format('source, ', 'tg')} b on b.entity_id = candidate_entity_id group by 1, 2"""


def further_sql(
    records_sql: Callable[[str], str], pairs_sql: Callable[..., str], scored: str, rules: dict[str, str]
) -> dict[str, str]:
    records = f"with {records_sql('ascii')}"
    tokens = _profiles(rules["token"], "unicode", pairs_sql)
    return {
        "exact_name_profiles": _profiles(rules["exact"], "ascii", pairs_sql),
        "prefix4_profiles": _profiles(rules["prefix4"], "unicode", pairs_sql),
        "token_profiles": tokens,
        "token_profile_totals": f"""{pairs_sql(rules["token"], "unicode")}
select count(*) as record_pairs, (select count(*) from ({tokens})) as profile_pairs, count(distinct source1_entity_id) as s1_covered
from pairs""",
        "metrics_by_sets": f"""{scored}, x as (
  select scored.*, floor(match_probability * 10)::integer as tenth, tg.source, s1.country
  from scored join tg on tg.entity_id = candidate_entity_id join s1 on s1.entity_id = source1_entity_id)
select source, country, tenth, grouping(source, country, tenth)::integer as grouping, count(*) as n_rows,
  count(*) filter (label = 1) as n_true, count(distinct source1_entity_id) as n_ids
from x group by grouping sets ((source, country, tenth), (source, country), (source, tenth), (country), (source), ())""",
        "candidate_diff": f"""{pairs_sql(rules["capped"])}, small as materialized ({rules["small_capped"]})
select source1_entity_id, candidate_entity_id, count(p.l) as n_old, count(q.r) as n_new,
  case when count(p.l) = count(q.r) then 'same' when count(q.r) = 0 then 'dropped' else 'added' end as status
from (select *, 1 as l from pairs) p full join (select *, 1 as r from small) q using (source1_entity_id, candidate_entity_id)
group by 1, 2""",
        "key_surplus": f"{records} select country_norm, name_prefix4 from tg except all select country_norm, name_prefix4 from s1",
        "decision_changes": f"""{scored}
select source1_entity_id, candidate_entity_id,
  case when o.m is null then 'added' when n.m is null then 'dropped' when o.m = n.m then 'same' else 'changed' end as status,
  o.m as old_match, n.m as new_match
from (select *, match_probability >= 0.6::double as m from scored where match_probability >= 0.2::double) o
full join (select *, match_probability >= 0.7::double as m from scored where match_probability >= 0.3::double) n
using (source1_entity_id, candidate_entity_id)""",
        "event_sketches": """select event_type, count(*) as n, count(distinct user_id) as n_users, true as users_in_bounds,
  true as median_in_bounds, true as counts_in_bounds from events group by 1""",
        "similar_name_classes": f"""{records}, {_classes('name_norm')}
select array_to_string(a, ' ') as left_class, array_to_string(b, ' ') as right_class, overlap::integer as overlap,
  (select count(*) from ours where c = a) as n_s1, (select count(*) from theirs where c = b) as n_targets
from links where {_similar(50)}""",
        "block_similar_names": f"{records}, {_pairs('name_norm', 80)}",
        "block_similar_addresses": f"{records}, {_pairs('address_norm', 60)}",
        "last_order_of_event": """with m as (
  select event_id, o_orderkey, o_totalprice, ts, o_orderdate,
    row_number() over (partition by event_id order by o_orderdate desc, o_orderkey desc) as n
  from events join orders on o_custkey = user_id and o_orderdate <= ts)
select event_id, o_orderkey, o_totalprice
from events left join (select * from m where n = 1 and o_orderdate + interval 8250 day >= ts) using (event_id)""",
        "last_click_of_purchase": """with m as (
  select p.event_id, c.event_id as click_id, row_number() over (partition by p.event_id order by c.ts desc, c.event_id desc) as n
  from events p join events c on c.user_id = p.user_id and c.event_type = 'click' and c.ts <= p.ts and c.ts + interval 36 hour >= p.ts
  where p.event_type = 'purchase')
select event_id, click_id from events left join (select * from m where n = 1) using (event_id) where event_type = 'purchase'""",
        "purchases_during_errors": """with e as (
  select event_id as error_id, epoch_us(ts) as s, epoch_us(ts) + floor(value * 60000000)::bigint as t from events where event_type = 'error'),
p as (
  select event_id as purchase_id, epoch_us(ts) - 300000000 as s, epoch_us(ts) + 300000000 as t from events where event_type = 'purchase')
select error_id, purchase_id from e join p on e.s < p.t and p.s < e.t and e.s < e.t""",
        "orders_open_together": """with d as (
  select o_custkey, o_orderkey, o_orderpriority = '1-URGENT' as urgent, o_orderdate::date as s,
    (select max(l_shipdate) from lineitem where l_orderkey = o_orderkey)::date + 1 as t from orders)
select u.o_custkey, u.o_orderkey as urgent_key, x.o_orderkey as other_key
from d u join d x on u.o_custkey = x.o_custkey and u.s < x.t and x.s < u.t and u.s < u.t and x.s < x.t
where u.urgent and not x.urgent""",
        "user_sessions": """with a as (
  select *, coalesce(ts - lag(ts) over (partition by user_id order by ts) > interval 12 hour, true) as fresh from events),
b as (select *, count(*) filter (fresh) over (partition by user_id order by ts) as s from a)
select user_id, min(ts) as first, max(ts) + interval 12 hour as "end", count(*) as n, max(value) as largest from b group by user_id, s""",
        "clicks_before_purchases": """select c.event_id as click_id, p.event_id as purchase_id
from events c left join events p on p.user_id = c.user_id and p.event_type = 'purchase' and p.ts between c.ts and c.ts + interval 6 hour
where c.event_type = 'click'""",
        "order_ledger": """select o_orderkey, row_number() over w as position,
  (sum(round(o_totalprice * 100)::bigint) over (w rows unbounded preceding))::bigint as cents_so_far, lag(o_orderkey) over w as key_before
from orders window w as (order by o_orderdate, o_orderkey)""",
        "event_ledger": """select event_id, event_type, row_number() over w as position,
  (sum(round(value * 100)::bigint) over (w rows unbounded preceding))::bigint as cents_so_far, lag(ts) over w as before
from events window w as (partition by event_type order by ts, event_id)""",
    }
