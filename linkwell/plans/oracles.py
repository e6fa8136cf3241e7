"""DuckDB SQL that computes what the registered queries compute.

Written from the definitions, set by set, without the shortcuts the Spark jobs
take: rules are united with ``distinct``, ranks are taken over whole groups,
thresholds are counted one by one.
"""

from __future__ import annotations

from linkwell.plans.oracles_further import further_sql

CAP4, CAP6, TOKENS, LIMIT = 10, 20, 5, 0.6

# --- derived records ---------------------------------------------------------------------------

ENTITIES = r"""
doc_words as materialized (
  select doc_id, lang, n_chars, cast(doc_id % 3 + 1 as integer) as src,
    list_filter(string_split(regexp_replace(lower(text), '[^\p{L}]+', ' ', 'g'), ' '), lambda x: x <> '') as t
  from documents),
doc_top as materialized (
  select *, list_transform(list_sort(list_transform(list_distinct(t),
      lambda x: {'l': -length(x), 'w': x})), lambda s: s.w) as d
  from doc_words),
ent as materialized (
  select 'S' || src || '-' || doc_id as entity_id,
    array_to_string(d[1:3], ' ') || (['', ' Pvt. Ltd.', ', Inc.', ' Company', ' & Co.'])[doc_id % 5 + 1]
      as business_name,
    (len(t) % 900 + 1) || ' ' || coalesce(d[4], '')
      || ([' Street, Suite ', ' St., Suite ', ' Street, Ste '])[src] || (n_chars % 9) as business_address,
    case when n_chars % 17 <> 0 then upper(lang) end as country,
    'S' || src as source, md5(array_to_string(t, ' ')) as truth_key
  from doc_top)"""


def text_sql(x: str, dialect: str) -> str:
    if dialect == "unicode":
        spaced = rf"regexp_replace(replace(lower(coalesce({x}, '')), '&', ' and '), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g')"
    else:
        spaced = rf"regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9\s]', ' ', 'g')"
    return rf"trim(regexp_replace({spaced}, '\s+', ' ', 'g'))"


def name_sql(x: str, dialect: str) -> str:
    tidy = text_sql(x, dialect)
    if dialect == "unicode":
        # Two spaces between words, so that neighbouring suffixes do not share one.
        padded = f"' ' || replace({tidy}, ' ', '  ') || ' '"
        rule = (
            " (private  limited|private  ltd|pvt  limited|pvt  ltd|pvt|limited|ltd|llc|incorporated|inc|corp"
            "|corporation|company|co|plc) "
        )
        return f"trim(regexp_replace(regexp_replace({padded}, '{rule}', ' ', 'g'), ' +', ' ', 'g'))"
    rule = (
        " (private limited|pvt limited|pvt ltd|private ltd|limited|ltd|incorporated|inc|corporation|corp|llc|llp"
        "|plc|co|company)$"
    )
    return f"regexp_replace({tidy}, '{rule}', '')"


_COMMON_WORDS = (
    "when 'street' then 'st' when 'road' then 'rd' when 'avenue' then 'ave' when 'boulevard' then 'blvd' "
    "when 'highway' then 'hwy' when 'lane' then 'ln' when 'drive' then 'dr' when 'apartment' then 'apt' "
    "when 'suite' then 'ste' when 'building' then 'bldg' when 'floor' then 'fl' "
)
_ASCII_WORDS = (
    "when 'av' then 'ave' when 'parkway' then 'pkwy' when 'circle' then 'cir' when 'court' then 'ct' "
    "when 'place' then 'pl' when 'terrace' then 'ter' "
)


def address_sql(x: str, dialect: str) -> str:
    cases = _COMMON_WORDS + (_ASCII_WORDS if dialect == "ascii" else "")
    return (
        f"array_to_string(list_transform(string_split({text_sql(x, dialect)}, ' '), "
        f"lambda w: case w {cases} else w end), ' ')"
    )


def records_sql(dialect: str) -> str:
    return f"""{ENTITIES},
normed as materialized (
  select *, {name_sql('business_name', dialect)} as name_norm,
    {address_sql('business_address', dialect)} as address_norm, {text_sql('country', dialect)} as country_norm
  from ent),
rec as materialized (
  select *, substr(name_norm, 1, 4) as name_prefix4, substr(name_norm, 1, 6) as name_prefix6 from normed),
s1 as materialized (select * from rec where source = 'S1'),
tg as materialized (select * from rec where source <> 'S1')"""


def truth_sql() -> str:
    return """
truth as materialized (
  select e.entity_id as source1_entity_id, p.entity_id as candidate_entity_id
  from ent e join ent p using (truth_key) where e.source = 'S1' and p.source <> 'S1')"""


# --- candidate pairs ---------------------------------------------------------------------------

PAIR = "s1.entity_id as source1_entity_id, tg.entity_id as candidate_entity_id"
EXACT = f"select {PAIR} from s1 join tg on s1.name_norm = tg.name_norm where s1.name_norm <> ''"


def keys_sql(n: int, cap: int) -> str:
    return (
        f"select source, country_norm, name_prefix{n}, count(*) as frequency from tg where name_prefix{n} <> '' "
        f"group by all having count(*) <= {cap}"
    )


def prefix_sql(n: int, cap: int | None = None) -> str:
    keys = "" if cap is None else (
        f" join ({keys_sql(n, cap)}) k on k.source = tg.source and k.country_norm = tg.country_norm "
        f"and k.name_prefix{n} = tg.name_prefix{n}"
    )
    return (
        f"select {PAIR} from s1 join tg on s1.country_norm = tg.country_norm "
        f"and s1.name_prefix{n} = tg.name_prefix{n}{keys} where s1.name_prefix{n} <> ''"
    )


def _postings(side: str) -> str:
    return (
        f"select entity_id, source, unnest(list_filter(string_split(name_norm, ' '), lambda w: length(w) >= 3)) as tok "
        f"from {side}"
    )


TOKEN = (
    f"select distinct a.entity_id as source1_entity_id, b.entity_id as candidate_entity_id "
    f"from ({_postings('s1')}) a join ({_postings('tg')}) b using (tok)"
)
TOKEN_RANKED = f"""
select source1_entity_id, candidate_entity_id from (
  select *, row_number() over (partition by source1_entity_id order by source, pos, candidate_entity_id) as rn
  from (
    select a.entity_id as source1_entity_id, b.entity_id as candidate_entity_id, b.source,
      min(list_position(string_split(a.name_norm, ' '), b.tok)) as pos
    from s1 a join ({_postings('tg')}) b on list_contains(string_split(a.name_norm, ' '), b.tok)
    group by 1, 2, 3))
where rn <= """


def capped_sql(cap4: int, cap6: int) -> str:
    return f"select distinct * from ({EXACT} union all {prefix_sql(4, cap4)} union all {prefix_sql(6, cap6)})"


# The default caps.
CAPPED, TOKEN_CAPPED = capped_sql(500, 1000), TOKEN_RANKED + "200"
INDEX = f"select distinct * from ({EXACT} union all {prefix_sql(4)} union all {TOKEN_CAPPED})"
# Smaller caps, which the test tables reach, for the queries of the caps themselves.
SMALL_CAPPED, SMALL_TOKEN_CAPPED = capped_sql(CAP4, CAP6), f"{TOKEN_RANKED}{TOKENS}"


def pairs_sql(rule: str, dialect: str = "ascii") -> str:
    return f"with {records_sql(dialect)}, pairs as materialized ({rule})"


LISTS = """lists as materialized (
  select s1.entity_id as source1_entity_id,
    coalesce(string_agg(candidate_entity_id, ',' order by candidate_entity_id), '') as candidate_entity_ids
  from s1 left join pairs on s1.entity_id = pairs.source1_entity_id group by s1.entity_id)"""

COUNTS = "counts as (select source1_entity_id, count(*) as n from pairs group by 1)"

# --- features ----------------------------------------------------------------------------------

ATTRIBUTES = """attr as materialized (
  select p.source1_entity_id, p.candidate_entity_id, a.name_norm as name_a, a.address_norm as address_a,
    a.country_norm as country_a, b.name_norm as name_b, b.address_norm as address_b, b.country_norm as country_b
  from pairs p join s1 a on a.entity_id = p.source1_entity_id join tg b on b.entity_id = p.candidate_entity_id)"""


def _words(x: str) -> str:
    return f"list_distinct(list_filter(string_split({x}, ' '), lambda w: w <> ''))"


def _shared_over_all(a: str, b: str, empty: str) -> str:
    return (
        f"case {empty} else len(list_intersect({a}, {b}))::double / len(list_distinct(list_concat({a}, {b}))) end"
    )


def jaccard_sql(f: str) -> str:
    a, b = _words(f"{f}_a"), _words(f"{f}_b")
    return _shared_over_all(a, b, f"when len({a}) = 0 and len({b}) = 0 then 1.0::double")


def numeric_sql() -> str:
    a, b = (f"list_distinct(regexp_extract_all(address_{s}, '[0-9]+'))" for s in "ab")
    return _shared_over_all(a, b, f"when len({a}) = 0 or len({b}) = 0 then 0.0::double")


COUNTRY_MATCH = "case when country_a <> '' and country_a = country_b then 1 else 0 end"


def length_sql(f: str) -> str:
    return f"cast(abs(length({f}_a) - length({f}_b)) as integer)"


def lcs_sql(a: str, b: str) -> str:
    """Longest common subsequence by the textbook recurrence, one row of the table per character."""
    return f"""(list_reduce(list_transform(string_split({a}, ''), lambda z: [unicode(z)::bigint]),
    lambda prev, ca: list_reduce(list_transform(range(1, length({b}) + 1), lambda k: [k::bigint]),
      lambda cur, k: list_append(cur, case when unicode(substr({b}, k[1]::int, 1)) = ca[1]
        then prev[k[1]] + 1 else greatest(prev[k[1] + 1], cur[k[1]]) end), [0::bigint]),
    list_transform(range(0, length({b}) + 1), lambda z: 0::bigint)))[-1]"""


def _distinct_texts(f: str) -> str:
    return f"select distinct {f}_a as a, {f}_b as b from attr"


def ratio_sql(f: str) -> str:
    return f"""{f}_r as materialized (
  select a, b, case when length(a) + length(b) = 0 then 1.0
    when a = '' or b = '' then 0.0
    else 2.0::double * {lcs_sql('a', 'b')} / (length(a) + length(b)) end::double as score
  from ({_distinct_texts(f)}))"""


def partial_sql(f: str) -> str:
    """Every window, prefix and suffix of the longer text spelled out and scored on its own."""
    return f"""{f}_o as materialized (
  select a, b, case when length(a) <= length(b) then a else b end as s,
    case when length(a) <= length(b) then b else a end as l from ({_distinct_texts(f)}) where a <> b and a <> '' and b <> ''
  union all select a, b, b, a from ({_distinct_texts(f)}) where a <> b and a <> '' and length(a) = length(b)),
{f}_v as materialized (
  select distinct s, substr(l, greatest(k, 1)::int, (least(k + length(s), length(l) + 1) - greatest(k, 1))::int) as w
  from {f}_o, unnest(range(2 - length(s), length(l) + 1)) r(k)),
{f}_m as materialized (
  select s, w, 2.0::double * {lcs_sql('s', 'w')} / (length(s) + length(w)) as score from {f}_v),
{f}_b as materialized (
  select o.a, o.b, max(m.score) as score
  from {f}_o o, unnest(range(2 - length(o.s), length(o.l) + 1)) r(k)
  join {f}_m m on m.s = o.s and m.w = substr(o.l, greatest(k, 1)::int,
    (least(k + length(o.s), length(o.l) + 1) - greatest(k, 1))::int)
  group by all
  union all
  select a, b, case when a = b then 1.0 else 0.0 end from ({_distinct_texts(f)}) where a = b or a = '' or b = '')"""


def token_set_sql(f: str) -> str:
    joined = lambda e: f"array_to_string(list_sort(list_filter({e[0]}, lambda w: {e[1]} list_contains({e[2]}, w))), ' ')"
    return f"""{f}_w as materialized (
  select a, b, {_words('a')} as ta, {_words('b')} as tb from ({_distinct_texts(f)})),
{f}_p as materialized (
  select *, length({joined(('ta', '', 'tb'))}) as i, {joined(('ta', 'not', 'tb'))} as x,
    {joined(('tb', 'not', 'ta'))} as y from {f}_w),
{f}_l as materialized (
  select *, case when i > 0 then 1 else 0 end as g,
    case when x = '' or y = '' then 0 else {lcs_sql('x', 'y')} end as m from {f}_p),
{f}_s as materialized (
  select a, b, case when len(ta) = 0 or len(tb) = 0 then 0.0
    when i > 0 and (x = '' or y = '') then 1.0
    else greatest(
      1.0::double - (length(x) + length(y) - 2 * m)::double / (2 * (i + g) + length(x) + length(y)),
      case when i = 0 then 0.0 else 1.0::double - (g + length(x))::double / (2 * i + g + length(x)) end,
      case when i = 0 then 0.0 else 1.0::double - (g + length(y))::double / (2 * i + g + length(y)) end) end::double
    as score
  from {f}_l)"""


def fuzzy_sql(kind: str, make, part: str) -> str:
    return f"""{pairs_sql(CAPPED)}, {ATTRIBUTES}, {make('name')}, {make('address')}
select source1_entity_id, candidate_entity_id, n.score as name_{kind}, d.score as address_{kind}
from attr join name_{part} n on n.a = name_a and n.b = name_b
  join address_{part} d on d.a = address_a and d.b = address_b"""


def all_features_sql(extra: str = "", label: str = "") -> str:
    made = [make(f) for make in (ratio_sql, partial_sql, token_set_sql) for f in ("name", "address")]
    kinds = {"ratio": "r", "partial_ratio": "b", "token_set_ratio": "s"}
    scores = [f"{f}_{t}.score as {f}_{k}" for f in ("name", "address") for k, t in kinds.items()]
    native = [f"{jaccard_sql(f)} as {f}_jaccard, {length_sql(f)} as {f}_length_diff" for f in ("name", "address")]
    joins = " ".join(
        f"join {f}_{t} on {f}_{t}.a = pair.{f}_a and {f}_{t}.b = pair.{f}_b"
        for f in ("name", "address") for t in kinds.values()
    )
    columns = ", ".join([*scores, *native, f"{numeric_sql()} as numeric_overlap", f"{COUNTRY_MATCH} as country_match"])
    return f"""{pairs_sql(CAPPED)}{extra}, {ATTRIBUTES}, {", ".join(made)}
select source1_entity_id, candidate_entity_id, {label}{columns}
from attr pair {joins}{" join labelled using (source1_entity_id, candidate_entity_id)" if label else ""}"""


# --- scored pairs ------------------------------------------------------------------------------

LABELLED = """labelled as materialized (
  select p.*, cast(t.candidate_entity_id is not null as integer) as label
  from pairs p left join truth t using (source1_entity_id, candidate_entity_id))"""


def scored_sql() -> str:
    mean = f"({jaccard_sql('name')} + {jaccard_sql('address')} + {numeric_sql()} + {COUNTRY_MATCH}::double) / 4"
    return f"""{pairs_sql(CAPPED)}, {truth_sql()}, {LABELLED}, {ATTRIBUTES},
scored as materialized (
  select source1_entity_id, candidate_entity_id, label, {mean} as match_probability
  from attr join labelled using (source1_entity_id, candidate_entity_id))"""


RATES = """
  case when tp + fp > 0 then tp::double / (tp + fp) else 0.0::double end as precision,
  case when tp + fn > 0 then tp::double / (tp + fn) else 0.0::double end as recall"""


def f_sql(beta: str = "0.5") -> str:
    b2 = f"({beta}::double * {beta}::double)"
    return (
        f"case when precision + recall > 0 then ((1.0::double + {b2}) * precision * recall) "
        f"/ ({b2} * precision + recall) else 0.0::double end"
    )


GRID = "grid as (select 0.5::double + i * (0.51::double - 0.5::double) as threshold from range(46) r(i))"
SWEEP = f"""{GRID},
swept as (
  select threshold, count(*) filter (label = 1 and match_probability >= threshold) as tp,
    count(*) filter (label = 0 and match_probability >= threshold) as fp,
    count(*) filter (label = 1 and match_probability < threshold) as fn
  from grid cross join scored group by threshold),
rated as (select *, {RATES} from swept),
sweep as materialized (select *, {f_sql()} as f05 from rated)"""


def entity_sql(limit: str) -> str:
    return f"""ent_counts as (
  select source1_entity_id, count(*) filter (label = 1 and match_probability >= {limit}) as tp,
    count(*) filter (label = 0 and match_probability >= {limit}) as fp,
    count(*) filter (label = 1 and match_probability < {limit}) as fn
  from scored group by 1),
ent_rates as (select *, {RATES} from ent_counts),
ent_f as (select *, case when tp + fp + fn = 0 then 1.0::double else {f_sql()} end as f05 from ent_rates)"""


def _recall_sql() -> str:
    return """
per as (
  select t.source1_entity_id, count(*) as n, count(p.candidate_entity_id) as found
  from truth t left join pairs p using (source1_entity_id, candidate_entity_id) group by 1)
select cast(coalesce(sum(n), 0) as bigint) as true_pairs, cast(coalesce(sum(found), 0) as bigint) as found_pairs,
  count(*) as entities_with_truth, count(*) filter (n = found) as entities_all_found,
  coalesce(sum(found)::double / sum(n), 0.0) as pair_recall,
  coalesce((count(*) filter (n = found))::double / nullif(count(*), 0), 0.0) as entity_recall
from per"""


SPLIT = f"""groups as (
  select source1_entity_id, md5('42:' || source1_entity_id) as h from pairs group by all),
ranked as materialized (
  select source1_entity_id, row_number() over (order by h, source1_entity_id)
      <= ceil(0.2::double * count(*) over ()) as in_validation, count(*) over () as n from groups),
sides as materialized (select source1_entity_id, in_validation, not in_validation or n = 1 as in_train from ranked)"""


def all_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    ascii_records, unicode_records = (f"with {records_sql(d)}" for d in ("ascii", "unicode"))
    for d in ("unicode", "ascii"):
        out[f"normalize_text_{d}"] = f"select doc_id, {text_sql('text', d)} as text_norm from documents"
        out[f"normalize_name_{d}"] = f"with {ENTITIES} select entity_id, {name_sql('business_name', d)} as name_norm from ent"
        out[f"normalize_address_{d}"] = (
            f"with {ENTITIES} select entity_id, {address_sql('business_address', d)} as address_norm from ent"
        )
    out["normalize_country"] = (
        f"with {ENTITIES} select entity_id, {text_sql('country', 'unicode')} as country_unicode, "
        f"{text_sql('country', 'ascii')} as country_ascii from ent"
    )
    normed = "name_norm, address_norm, country_norm, name_prefix4, name_prefix6"
    out["normalize_entities"] = (
        f"{ascii_records} select entity_id, business_name, business_address, country, {normed} from rec"
    )
    out["parquet_roundtrip"] = out["normalize_entities"]
    out["normalize_incremental"] = f"{unicode_records} select entity_id, {normed} from rec"
    out["name_prefixes"] = f"{unicode_records} select entity_id, name_prefix4, name_prefix6 from rec"
    out["name_tokens"] = (
        f"{ascii_records} select entity_id, array_to_string(list_filter(string_split(name_norm, ' '), "
        "lambda w: length(w) >= 3), ' ') as tokens from rec"
    )
    out["address_numbers"] = (
        "select doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '\\p{Nd}+'))), ' ') as numbers "
        "from documents"
    )
    out["parse_id_list"] = (
        "with parts as (select doc_id, unnest(string_split(text, ',')) as part, "
        "generate_subscripts(string_split(text, ','), 1) as pos from documents), "
        "tidy as (select doc_id, trim(part, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as id, pos from parts), "
        "first as (select doc_id, id, min(pos) as pos from tidy where id <> '' group by all) "
        "select d.doc_id, cast(count(f.id) as integer) as n_ids, "
        "md5(coalesce(string_agg(f.id, '|' order by f.pos), '')) as ids_digest "
        "from documents d left join first f on f.doc_id = d.doc_id group by d.doc_id"
    )
    out["quality_stats"] = (
        f"{ascii_records} select count(*) as total_rows, count(*) filter (name_norm = '') as empty_names, "
        "count(*) filter (address_norm = '') as empty_addresses, count(*) filter (country_norm = '') as empty_countries "
        "from rec"
    )
    out["sample_rows"] = (
        f"{ascii_records} select entity_id, business_name, name_norm, business_address, address_norm, country, "
        "country_norm from rec order by entity_id limit 10"
    )
    out["source_row_counts"] = f"{ascii_records} select source, count(*) as row_count from rec group by 1"
    out["route_candidate_ids"] = (
        f"with {ENTITIES} select truth_key as source1_entity_id, entity_id as candidate_entity_id, source from ent "
        "where entity_id like 'S2-%' or entity_id like 'S3-%'"
    )

    rules = {
        "block_exact_name": (EXACT, "ascii"),
        "block_prefix4": (prefix_sql(4), "unicode"),
        "block_token": (TOKEN, "unicode"),
        "token_cap": (SMALL_TOKEN_CAPPED, "unicode"),
        "block_index": (INDEX, "unicode"),
        "link_incrementally": (f"select distinct * from ({EXACT} union all {prefix_sql(4)})", "ascii"),
        "block_prefix4_capped": (prefix_sql(4, CAP4), "ascii"),
        "block_prefix6_capped": (prefix_sql(6, CAP6), "ascii"),
        "block_capped": (SMALL_CAPPED, "ascii"),
    }
    for name, (rule, d) in rules.items():
        out[name] = f"{pairs_sql(rule, d)} select * from pairs"
    out["eligible_keys_prefix4"] = f"{ascii_records} {keys_sql(4, CAP4)}"
    out["eligible_keys_prefix6"] = f"{ascii_records} {keys_sql(6, CAP6)}"
    stats = " union all ".join(
        f"select source, {n} as prefix_length, count(*) as total_keys, avg(c) as avg_frequency, max(c) as max_frequency, "
        f"count(*) filter (c <= {cap}) as eligible_keys from (select source, country_norm, name_prefix{n}, count(*) as c "
        f"from tg where name_prefix{n} <> '' group by all) group by source"
        for n, cap in ((4, CAP4), (6, CAP6))
    )
    out["blocking_key_stats"] = f"{ascii_records} {stats}"
    out["candidate_lists"] = f"{pairs_sql(CAPPED)}, {LISTS} select * from lists"
    out["tsv_roundtrip"] = (
        f"{pairs_sql(CAPPED)}, {LISTS} select source1_entity_id, nullif(candidate_entity_ids, '') as candidate_entity_ids "
        "from lists"
    )
    out["blocking_job"] = f"{pairs_sql(INDEX, 'unicode')}, {LISTS} select * from lists"
    out["explode_candidates"] = f"{pairs_sql(CAPPED)} select * from pairs"

    out["candidate_coverage"] = f"""{pairs_sql(CAPPED)}, {COUNTS}
select cast(sum(n) as bigint) as total_pairs, count(*) as s1_covered, (select count(*) from s1) as total_s1,
  count(*)::double / (select count(*) from s1) * 100 as coverage_percent from counts"""
    out["candidate_distribution"] = f"""{pairs_sql(CAPPED)}, {COUNTS}
select round(avg(n), 6) as avg_candidates,
  round(quantile_cont(n::double, 0.5), 6) as p50_candidates, round(quantile_cont(n::double, 0.95), 6) as p95_candidates,
  round(quantile_cont(n::double, 0.99), 6) as p99_candidates, max(n) as max_candidates from counts"""
    out["blocking_size_report"] = f"""{pairs_sql(TOKEN_CAPPED, 'unicode')}, {COUNTS}
select (select count(*) from s1) as entities, sum(n)::double / (select count(*) from s1) as avg_candidates,
  max(n) as max_candidates, (select count(*) from s1) - count(*) as zero_candidates from counts"""
    out["blocking_recall"] = f"{pairs_sql(SMALL_TOKEN_CAPPED, 'unicode')}, {truth_sql()}, {_recall_sql()}"
    out["blocking_recall_by_keys"] = f"{pairs_sql(CAPPED)}, {truth_sql()}, {_recall_sql()}"

    base = f"{pairs_sql(CAPPED)}, {ATTRIBUTES}"
    ids = "source1_entity_id, candidate_entity_id"
    out["pair_attributes"] = f"{base} select * from attr"
    out["pair_labels"] = f"{pairs_sql(CAPPED)}, {truth_sql()}, {LABELLED} select * from labelled"
    out["feature_ratio"] = fuzzy_sql("ratio", ratio_sql, "r")
    out["feature_partial_ratio"] = fuzzy_sql("partial_ratio", partial_sql, "b")
    out["feature_token_set_ratio"] = fuzzy_sql("token_set_ratio", token_set_sql, "s")
    out["feature_jaccard"] = (
        f"{base} select {ids}, {jaccard_sql('name')} as name_jaccard, {jaccard_sql('address')} as address_jaccard from attr"
    )
    out["feature_length_diff"] = (
        f"{base} select {ids}, {length_sql('name')} as name_length_diff, {length_sql('address')} as address_length_diff "
        "from attr"
    )
    out["feature_numeric_overlap"] = f"{base} select {ids}, {numeric_sql()} as numeric_overlap from attr"
    out["feature_country_match"] = f"{base} select {ids}, {COUNTRY_MATCH} as country_match from attr"

    out["pair_features"] = all_features_sql()
    out["feature_table"] = all_features_sql(f", {truth_sql()}, {LABELLED}", "label, ")

    out["group_split"] = f"{pairs_sql(CAPPED)}, {SPLIT} select * from pairs join sides using (source1_entity_id)"
    out["split_counts"] = f"""{pairs_sql(CAPPED)}, {SPLIT}
select side as split, count(distinct source1_entity_id) as entities, count(*) as pairs
from (select source1_entity_id, 'train' as side from pairs join sides using (source1_entity_id) where in_train
  union all select source1_entity_id, 'validation' from pairs join sides using (source1_entity_id) where in_validation)
group by 1"""
    out["class_weight"] = f"""{pairs_sql(CAPPED)}, {truth_sql()}, {LABELLED}
select count(*) filter (label = 1) as positive, count(*) filter (label = 0) as negative,
  case when count(*) filter (label = 1) > 0
    then (count(*) filter (label = 0))::double / (count(*) filter (label = 1)) else 1.0 end as positive_weight
from labelled"""

    # A model's probabilities have no twin here; that each pair has one, and how the model was fitted, has.
    out["train_gbt"] = f"""{pairs_sql(CAPPED)}, {truth_sql()}, {LABELLED}
select 500::bigint as n_trees, 12::bigint as n_features, count(*) as n_rows, cast(coalesce(sum(label), 0) as bigint) as n_positive,
  1.0::double as importances from labelled"""
    out["score_model"] = f"{pairs_sql(CAPPED)} select {ids}, true as in_range, true as ranks_well from pairs"
    out["validation_predictions"] = f"""{pairs_sql(CAPPED)}, {truth_sql()}, {LABELLED}, {SPLIT}
select {ids}, label, true as in_range from labelled join sides using (source1_entity_id) where in_validation"""
    out["resolve_end_to_end"] = f"""with {records_sql('ascii')}
select entity_id as source1_entity_id, true as all_candidates, true as in_order from s1"""

    limit = f"{LIMIT}::double"
    out["fbeta_grid"] = f"""{scored_sql()}, {entity_sql(limit)}
select source1_entity_id, tp, fp, fn, precision, recall, {f_sql('0.5')} as f05, {f_sql('1')} as f1, {f_sql('2')} as f2
from ent_rates"""
    out["micro_metrics"] = f"""{scored_sql()}, c as (
  select count(*) filter (label = 1 and match_probability >= {limit}) as tp,
    count(*) filter (label = 0 and match_probability >= {limit}) as fp,
    count(*) filter (label = 1 and match_probability < {limit}) as fn from scored),
r as (select *, {RATES} from c)
select *, {f_sql()} as f05 from r"""
    out["entity_macro_f05"] = (
        f"{scored_sql()}, {entity_sql(limit)} select round(coalesce(avg(f05), 0.0), 9) as entity_macro_f05 from ent_f"
    )
    out["threshold_sweep"] = f"{scored_sql()}, {SWEEP} select * from sweep"
    out["select_threshold"] = f"""{scored_sql()}, {SWEEP},
best as materialized (select * from sweep order by f05 desc, threshold limit 1), {entity_sql('(select threshold from best)')}
select round(threshold, 2) as threshold, precision, recall, f05,
  (select round(avg(f05), 9) from ent_f) as entity_macro_f05 from best"""
    out["match_lists"] = f"""{scored_sql()}
select s1.entity_id as source1_entity_id,
  coalesce(string_agg(candidate_entity_id, ',' order by candidate_entity_id), '') as matched_entity_ids
from s1 left join scored on source1_entity_id = s1.entity_id and match_probability >= {limit} group by 1"""
    out["validate_output"] = f"""{pairs_sql(TOKEN_CAPPED, 'unicode')}, {truth_sql()},
bad as (select entity_id as id from ent where source = 'S1' and country is null),
m as (select source1_entity_id as id from truth group by 1 union all select id from bad),
single as (select source1_entity_id as id, candidate_entity_id as c from truth
  union all select id, id from bad union all select id, 'S2-none' from bad)
select 'V3' as rule, null::varchar as source1_entity_id, 'matching_results: ' || count(*) as detail
from m having count(*) <> (select count(*) from s1)
union all
select 'V4', null, 'candidate_pairs: ' || ((select count(*) from s1) + count(*)) from bad having count(*) > 0
union all
select 'V5', id, 'matching_results' from m group by id having count(*) > 1
union all
select 'V5', id, 'candidate_pairs' from bad
union all
select 'V6', id, id || ',S2-none,S2-none' from bad
union all
select 'V7', id, c from single where c not like 'S2-%' and c not like 'S3-%'
union all
select 'V8', id, c from single where c not in (select entity_id from ent where source <> 'S1')
union all
select 'V9', id, c from single where (id, c) not in (select source1_entity_id, candidate_entity_id from pairs)"""
    mean = f"({jaccard_sql('name')} + {jaccard_sql('address')} + {numeric_sql()} + {COUNTRY_MATCH}::double) / 4"
    out["resolve_by_index"] = f"""{pairs_sql(INDEX, 'unicode')}, {ATTRIBUTES}, good as (
  select source1_entity_id, candidate_entity_id from attr where {mean} >= {limit})
select s1.entity_id as source1_entity_id, coalesce(string_agg(candidate_entity_id, ',' order by candidate_entity_id), '') as matched_entity_ids
from s1 left join good on source1_entity_id = s1.entity_id group by 1"""
    out["match_alignments"] = f"""{scored_sql()}, {partial_sql('name')}
select distinct n.a, n.b, n.score::double as score
from scored join attr t using (source1_entity_id, candidate_entity_id) join name_b n on t.name_a = n.a and t.name_b = n.b
where match_probability >= {limit}"""
    rules = {"exact": EXACT, "prefix4": prefix_sql(4), "token": TOKEN, "capped": CAPPED, "small_capped": SMALL_CAPPED}
    out.update(further_sql(records_sql, pairs_sql, scored_sql(), rules))
    return out
