"""What each query must return, as SQL over the driver tables for DuckDB.

For pages rendered from rows the SQL states the expected fields from those rows directly; it never
looks at markup.
"""

from __future__ import annotations

from dwellframe.functions.scalars import WHITESPACE
from dwellframe.plans import driver_views as dv
from dwellframe.plans.catalog import (
    BATCH, CRAWLED_SINCE, HOST_SUFFIX, MAX_PARALLEL, NOW, RUN_TS, SECURE_VENDOR,
)


def _view(sql: str) -> str:
    for name in ("lineitem", "orders", "events", "conversations", "supplier", "part"):
        sql = sql.replace("{" + name + "}", name)
    return f"({sql})"


def _number(x: str) -> str:
    return (
        f"try_cast(nullif(replace(array_to_string(regexp_extract_all({x}, '\\d*\\.?,?\\d+'), ''), ',', '.'), '')"
        " as double)"
    )


def _unit(x: str) -> str:
    return f"case when {x} <> '' then regexp_replace({x}, '[0-9]+', '', 'g') end"


def _pid(link: str) -> str:
    return f"nullif(regexp_extract(regexp_replace({link}, '\\.htm\\z', ''), '-(?:pr|ad)?([0-9]+)\\z', 1), '')"


HITS, RENTAL, INDEX, VISITS = _view(dv.HITS), _view(dv.RENTAL), _view(dv.INDEX), _view(dv.VISITS)
CHECKS, JOBS, HOSTS = _view(dv.CHECKS), _view(dv.JOBS), _view(dv.HOSTS)

PARSED_HITS = f"""(select vendor, type, {_pid('link')} as property_id, link, created_date,
  price_raw as property_price_raw, {_number('price_raw')} as property_price,
  {_unit('price_raw')} as property_price_unit, size_raw as property_size_raw,
  {_number('size_raw')} as property_size, {_unit('size_raw')} as property_size_unit from {HITS} h)"""

SURVIVORS = f"""(select property_id, seq, property_area, ep, sk from (
 select *, row_number() over (partition by property_id order by pr, rn) as k from (
  select *, case
     when rn = 1 and coalesce(cast(property_area as varchar), property_size_unit, property_price_unit) is not null then 0
     when rn > 1 and property_area is not null then 1
     when rn = 1 then 2 else 3 end as pr
  from (select *, row_number() over (partition by property_id order by seq, ep, sk) as rn from {RENTAL} r) a) b) c
 where k = 1)"""

RANKED = f"""(select *, row_number() over (partition by vendor, type order by created_date, property_id, link) as rn
 from {INDEX} i where last_crawled_date is null)"""
BATCHED = f"(select *, (rn - 1) // {BATCH} as batch from {RANKED} r)"
TASK_TYPES = f"""(select vendor, t.type, t.pos from {_view(dv.TASK_PAIRS)} v,
 (values ('rent', 0), ('sell', 1), ('auction', 2), ('lease', 3)) t(type, pos))"""
SLOTS = f"""(select host, unnest(range(cast(upto - free as bigint), cast(upto as bigint))) as slot from (
 select host, free, sum(free) over (order by host) as upto from (
  select host, greatest({MAX_PARALLEL} - running, 0) as free from {HOSTS} h) a where free > 0) b)"""
ASSIGNED = f"""(with counts as (select vendor, type, batch, count(*) as n from {BATCHED} b group by all),
 wanted as (select c.*, t.pos from counts c join {TASK_TYPES} t on c.vendor = t.vendor and c.type = t.type),
 pairs as (select vendor, type, pos, max(batch) + 1 as nb from wanted group by all),
 offs as (select vendor, type, coalesce(sum(nb) over (order by vendor, pos
   rows between unbounded preceding and 1 preceding), 0) as off from pairs)
 select s.host, s.slot, w.vendor, w.type, w.batch, w.n from wanted w
 join offs o on w.vendor = o.vendor and w.type = o.type join {SLOTS} s on s.slot = w.batch + o.off)"""


def _unescaped(x: str) -> str:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{char}')"
    return x


LINKS = "list_transform(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1), lambda v: " + _unescaped("v") + ")"
SPACES = "'" + WHITESPACE + "'"

# expected hits of the rendered search pages
SITE = "case {k} % 3 when 0 then 'bds' when 1 then 'mbnd' else 'tbds' end"
ORDER_SITE, PART_SITE = SITE.format(k="o_orderkey"), SITE.format(k="p_partkey")
EXPECTED_HITS = f"""(select page_id, hit_no, vendor, type, property_id, link, 'nha-dat' as listing_type,
  size_raw as property_size_raw, case when parsed then cast(hit_no * 10 as double) end as property_size,
  case when parsed then ' m²' end as property_size_unit,
  price || ' ty' as property_price_raw, case when parsed then cast(price as double) end as property_price,
  case when parsed then '. ty' end as property_price_unit,
  case when site = 'tbds' then '' else 'a, ' end || o_custkey as property_area,
  case when site <> 'tbds' then 'today' end as posted_date
 from (select *, 'http://' || site || '.example.com' as vendor, page_id || '' || hit_no as property_id,
   'http://' || site || '.example.com/ban-nha-pr' || page_id || hit_no || '.htm' as link,
   hit_no || '0 m²' as size_raw, site <> 'bds' or type <> 'lease' as parsed
  from (select o_orderkey as page_id, i.hit_no, o_custkey, {ORDER_SITE} as site,
    case o_orderstatus when 'F' then 'sell' when 'O' then 'rent' else 'lease' end as type,
    cast(cast(o_totalprice as decimal(12,2)) as varchar) as price
   from orders, (values (0), (1), (2)) i(hit_no) where o_orderpriority <> '5-LOW') a) b
 where not (hit_no = 1 and o_custkey % 7 = 0))"""

# expected listings of the rendered detail pages
EXPECTED_PAGES = f"""(select page_id, vendor || ':' || coalesce(property_id, 'FAILURE') || ':' || type as key,
  vendor, type, property_id, link,
  case site when 'tbds' then '0' || s || '-01/x' else '0' || s || '-01' end as posted_date,
  case when site = 'bds' then '0' || s || '-02' end as expire_date, p_name as title,
  p_type || ' ' || p_brand as description, case when site = 'bds' or two then p_brand || ' street' end as address,
  case when site = 'bds' then '/area-' || s || '?a=1&b=2' end as area,
  case when site = 'mbnd' then 'ward ' || s end as ward, cast(null as varchar) as district, cast(null as varchar) as city,
  price || ' ty' as price_raw, cast(price as double) as price, '. ty' as price_unit,
  case when sized then cast(price as double) / s end as price_per_sqm,
  case when sized then s || ' m²' end as property_size_raw, case when sized then cast(s as double) end as property_size,
  case when sized then ' m²' end as property_size_unit,
  cast(null as double) as distance_to_road, cast(null as double) as frontage,
  cast(null as varchar) as ownership_certificate, cast(null as varchar) as road_width,
  case when site <> 'tbds' then cast(s as double) end as num_floors, cast(page_id as double) as num_bedrooms,
  cast(null as double) as num_bathrooms, case when site <> 'bds' then p_brand end as house_orientation,
  cast(null as varchar) as balcony_orientation,
  case site when 'bds' then 'full' when 'mbnd' then ' bed,table,' end as furniture,
  '/a' || page_id || '.jpg /b.jpg' as images, cast(null as varchar) as videos,
  case when site = 'bds' then 'Vip' else type end as listing_type, 'Mr ' || s as contact_name,
  case when site = 'bds' and two then p_type || ' office' end as contact_address,
  case when site = 'tbds' then cast(page_id as varchar) end as contact_phone, cast(null as varchar) as contact_mobile,
  cast(null as varchar) as contact_email,
  case when site = 'mbnd' then vendor || '/doanh-nghiep/detail/' || s end as contact_link,
  case when site <> 'tbds' then p_brand end as project_name, cast(null as varchar) as project_owner,
  cast(null as varchar) as project_scale, case when site <> 'tbds' then '/project' end as project_link
 from (select *, {PART_SITE} as site, p_partkey as page_id, p_size as s, p_size % 2 = 0 as two, p_size % 10 <> 0 as sized,
   cast(cast(p_retailprice as decimal(12,2)) as varchar) as price,
   'http://' || {PART_SITE} || '.example.com' as vendor,
   case when p_size % 3 = 0 then 'sell' else 'rent' end as type,
   case when p_size % 5 <> 0 then cast(p_partkey as varchar) end as property_id,
   'https://x.example.com/nha-pr' || p_partkey || case when p_size % 5 = 0 then '.html' else '.htm' end as link
  from part) p where site <> 'bds' or sized)"""

ORACLES: dict[str, str] = {
    "number_unit": f"""select l_orderkey, l_linenumber, price_raw, size_raw, {_number('price_raw')} as price,
        {_unit('price_raw')} as price_unit, {_number('size_raw')} as size, {_unit('size_raw')} as size_unit from {HITS} h""",
    "typed_parse": f"""select l_orderkey, l_linenumber, type, price_raw,
        case when type in ('sell', 'rent') then {_number('price_raw')} end as price,
        case when type in ('sell', 'rent') then {_unit('price_raw')} end as price_unit from {HITS} h""",
    "property_key": f"""select link, {_pid('link')} as property_id,
        vendor || ':' || coalesce({_pid('link')}, 'FAILURE') || ':' || type as key from {HITS} h""",
    "price_per_sqm": f"""select l_orderkey, l_linenumber, price_raw, size_raw,
        case when p <> 0 and z <> 0 then p / z end as price_per_sqm
        from (select *, {_number('price_raw')} as p, {_number('size_raw')} as z from {HITS} h) x""",
    "abs_link": f"select vendor, link, vendor || link as abs_link from {HITS} h",
    "listing_type": """select page_id, url, split_part(split_part(url, '/', -1), '.', 1) as listing_type from pages""",
    "strip": f"""select doc_id, md5(s) as digest, strlen(s) as n_bytes, case when lang <> 'en' then lang end as lang
        from (select *, trim(text, {SPACES}) as s from documents) d""",
    "host_name": f"""select distinct host, replace(replace(host, 'http://', ''), '{HOST_SUFFIX}', '') as name
        from {JOBS} j""",
    "elapsed_parts": """select event_id, s // 86400 as days, s % 86400 // 3600 as hours, s % 3600 // 60 as minutes
        from (select event_id, (epoch_us(timestamp '2024-01-31 00:00:00') - epoch_us(ts)) // 1000000 as s from events) e""",
    "pages_scan": "select page_id, url, strlen(html) as n_bytes from pages",
    "index_first_write": f"""select * exclude (k) from (select *, row_number() over (partition by vendor, type, property_id
        order by created_date, property_size_raw, property_size nulls first, property_size_unit, property_price_raw,
        property_price nulls first, property_price_unit, link) as k from {PARSED_HITS} h) x where k = 1""",
    "first_status": f"""select ip, date, status, event_id from (select *, row_number() over (partition by ip
        order by date, event_id) as k from {CHECKS} c) x where k = 1""",
    "listing_last_write": f"""select key, link, property_price_raw, created_date as crawled_date from (
        select *, row_number() over (partition by key order by created_date desc, link, property_price_raw) as k from (
        select *, vendor || ':' || coalesce(property_id, 'FAILURE') || ':' || type as key from {PARSED_HITS} h) x) y
        where k = 1""",
    "mark_crawled": f"""select vendor, type, property_id, case when last_crawled_date is null and property_price > 300000
        then timestamp '{RUN_TS}' else last_crawled_date end as last_crawled_date from {INDEX} i""",
    "recode_type": f"""select l_orderkey, l_linenumber, link, case type when 'rent' then 'lease' else type end as type
        from {HITS} h""",
    "recrawl_reset": f"""select vendor, property_id, case when vendor = '{SECURE_VENDOR}'
        and last_crawled_date > timestamp '{CRAWLED_SINCE}' then null else last_crawled_date end as last_crawled_date
        from {INDEX} i""",
    "kv_encode": """select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, strftime(ts, '%Y-%m-%d') as day,
        cast(cast(value as varchar) as decimal(38,18)) as value, cast(null as varchar) as value_text,
        case when event_type = 'error' then ' ' else event_type end as event_type, user_id from events""",
    "require_fields": f"""select vendor, type, property_id, created_date, property_price from {PARSED_HITS} h
        where property_id is not null and property_price is not null""",
    "merge_rental": f"""select vendor, type, property_id, case when vendor = '{SECURE_VENDOR}'
        and last_crawled_date > timestamp '{CRAWLED_SINCE}' then null else last_crawled_date end as last_crawled_date,
        property_area from (
        select vendor, case type when 'rent' then 'lease' else type end as type, property_id, last_crawled_date,
          null as property_area from {INDEX} i
        union all select concat('http://v', cast(sk % 3 as varchar), '.example.com'), 'lease',
          cast(property_id as varchar), null, property_area from {SURVIVORS} s) m""",
    "dup_groups": f"select property_id, count(*) as n from {RENTAL} r group by property_id having count(*) > 1",
    "dup_members": f"""select * from (select property_id, seq, ep, sk, count(*) over (partition by property_id) as n,
        row_number() over (partition by property_id order by seq, ep, sk) as pos from {RENTAL} r) x where n > 1""",
    "dedupe_survivor": f"select property_id, seq, property_area, ep from {SURVIVORS} s",
    "seed_rows": f"""select spider, vendor, e.k as type, unnest(e.v) as crawl_url, max_depth, start_index from (
        select *, unnest([{{'k': 'sell', 'v': ['/ban-' || s_suppkey || '.htm', '/ban']}},
          {{'k': 'rent', 'v': ['/thue-' || s_suppkey || '.htm']}}]) as e from {_view(dv.SEED_ROWS)} s) x""",
    "page_urls": f"""select vendor, type, crawl_url, idx, vendor || crawl_url ||
        case when spider = 'search_1' then '?p=' else '/p' end || idx as url from (
        select *, unnest(range(start_index, greatest(start_index, max_depth) + 1)) as idx from (
        select *, e.k as type, unnest(e.v) as crawl_url from (
        select *, unnest([{{'k': 'sell', 'v': ['/ban-' || s_suppkey || '.htm', '/ban']}},
          {{'k': 'rent', 'v': ['/thue-' || s_suppkey || '.htm']}}]) as e from {_view(dv.SEED_ROWS)} s) x) y) z""",
    "page_prefix": f"""select seed, idx, n_results from (select *, min(case when n_results = 0 then idx end)
        over (partition by seed) as stop from {VISITS} v where idx <= 20) z where idx <= coalesce(stop, idx)""",
    "next_page": f"""select seed, i + 1 as next_idx from (select seed, max(idx) as i, arg_max(n_results, idx) as n
        from {VISITS} v group by seed) z where n > 0 and i < 5""",
    "frontier_topk": f"select vendor, type, property_id, link, created_date, rn from {RANKED} r where rn <= 100",
    "frontier_pair": f"""select property_id, link from {INDEX} i where last_crawled_date is null
        and vendor = '{SECURE_VENDOR}' and type = 'sell' order by created_date, property_id, link limit 100""",
    "crawl_batches": f"""select vendor, type, batch, count(*) as n, string_agg(link, ',' order by rn) as links,
        string_agg(property_id, ',' order by rn) as ids from {BATCHED} b group by all""",
    "assign_batches": f"select * from {ASSIGNED} a",
    "exhausted_types": f"""select vendor, type from {TASK_TYPES} t where not exists (select 1 from {INDEX} i
        where i.vendor = t.vendor and i.type = t.type and last_crawled_date is null)""",
    "split_links": f"""select l_orderkey, l_linenumber, vendor, unnest([case when vendor = '{SECURE_VENDOR}'
        then replace(u, 'http://', 'https://') else u end, case when vendor = '{SECURE_VENDOR}'
        then replace(u || '?from=' || vendor, 'http://', 'https://') else u || '?from=' || vendor end]) as url
        from (select *, vendor || link as u from {HITS} h) x""",
    "claim_cycle": f"""select i.vendor, i.type, i.property_id,
        case when a.host is not null then timestamp '{RUN_TS}' else i.last_crawled_date end as last_crawled_date
        from {INDEX} i left join {BATCHED} b on i.property_id = b.property_id
        left join {ASSIGNED} a on b.vendor = a.vendor and b.type = a.type and b.batch = a.batch""",
    "claim_dispatch": f"""select a.host, a.slot, a.vendor, a.type, a.batch, a.n, string_agg(b.link, ',' order by b.rn) as links,
        string_agg(b.property_id, ',' order by b.rn) as ids from {ASSIGNED} a join {BATCHED} b
        on b.vendor = a.vendor and b.type = a.type and b.batch = a.batch group by all""",
    "job_stats": f"""select host, count(*) filter (state = 'running') as running,
        count(*) filter (state = 'finished') as finished,
        avg(secs // 60) filter (state = 'finished') as avg_minutes from {JOBS} j group by host""",
    "job_stats_compat": f"""select host, count(*) filter (state = 'running') as running,
        count(*) filter (state = 'finished') as finished,
        avg(secs % 86400 // 60 % 60) filter (state = 'finished') as avg_minutes from {JOBS} j group by host""",
    "fleet_summary": f"""select alive_hosts, spawned, s // 86400 as days, s % 86400 // 3600 as hours,
        s % 3600 // 60 as minutes from (select count(*) filter (running > 280) as alive_hosts,
        cast(sum(n) as bigint) as spawned, (epoch_us(timestamp '{NOW}') - epoch_us(min(since))) // 1000000 as s
        from (select host, count(*) as n, count(*) filter (state = 'running') as running, min(start_time) as since
          from {JOBS} j group by host) h) x""",
    "node_counts": """select page_id, tag, count(*) as n from (select page_id, unnest(regexp_extract_all(
        regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?s)(<script>|<style>).*?</(script|style)>', '\\1', 'g'),
        '<([a-zA-Z][a-zA-Z0-9]*)', 1)) as tag from pages) t group by all""",
    "blocks": f"""select o_orderkey as page_id, {ORDER_SITE} as site,
        case when o_orderpriority = '5-LOW' then 0 else 3 end as n_hits from orders""",
    "page_title": f"""select page_id, trim({_unescaped("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")}, {SPACES}) as title
        from pages""",
    "page_links": f"""select page_id, len(v) as n_links, array_to_string(v, ' ') as links
        from (select page_id, {LINKS} as v from pages) p""",
    "label_value": f"""select page_id, {_unescaped(
        "regexp_replace(regexp_extract(html, '(?s)</h1>\\s*<p>(.*?)<(?:p>|/p>|/article>)', 1), '<[^>]*>', '', 'g')")}
        as value from pages""",
    "page_text": f"""select page_id,
        trim({_unescaped("regexp_extract(html, '(?s)<div class=\"ad\">(.*?)</div>', 1)")}, {SPACES}) as ad,
        array_to_string(list_transform(regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '>([^<]+)<', 1),
          lambda v: trim({_unescaped('v')}, {SPACES})), ', ') as menu from pages""",
    "pick_pos": f"""select page_id, v[1] as first, v[2] as second, case when len(v) >= 3 then v[-3] end as third_last,
        v[-1] as last, case when len(v) > 4 then v[2] end as second_of_five,
        case when len(v) = 5 then v[2] end as second_of_exactly_five from (select page_id, {LINKS} as v from pages) p""",
    "li_value": f"""select p_partkey as page_id, case when site = 'tbds' then cast(p_partkey as varchar) end as rooms,
        cast(null as varchar) as floors, case when site = 'tbds' then p_brand end as facing
        from (select *, {PART_SITE} as site from part) p""",
    "extract_hits": f"select * from {EXPECTED_HITS} h",
    "extract_pages": f"select * from {EXPECTED_PAGES} p",
    "quarantine": f"""select 'hit' as kind, o_orderkey as page_id, 'missing link' as reasons from orders
        where o_orderpriority <> '5-LOW' and o_custkey % 7 = 0
        union all select 'page', p_partkey, 'missing property_size' from part where p_partkey % 3 = 0 and p_size % 10 = 0""",
    "search_to_index": f"""select vendor, type, property_id, link, property_price, property_area from {EXPECTED_HITS} h""",
    "search_visits": """select o_orderkey as page_id, case when o_orderpriority = '5-LOW' then 0 else 3 end as n_results
        from orders""",
    "pages_to_listings": f"""select key, link, '2024-01-01 00:00:00' as crawled_date, title,
        cast(cast(price as varchar) as decimal(38,18)) as price, address from (select *, row_number() over (
        partition by key order by link) as k from {EXPECTED_PAGES} p) x where k = 1""",
}

ORACLES["stream_index"] = ORACLES["index_first_write"]
ORACLES["stream_checks"] = ORACLES["first_status"]
ORACLES["stream_listings"] = f"""select key, link, property_price_raw, crawled_date from (
    select *, row_number() over (partition by key order by crawled_date desc, slice desc, link, property_price_raw) as k from (
    select vendor || ':' || coalesce(property_id, 'FAILURE') || ':' || type as key, link, property_price_raw,
      cast(date_trunc('month', created_date) as timestamp) as crawled_date,
      case when day(created_date) <= 10 then 0 when day(created_date) <= 20 then 1 else 2 end as slice from {PARSED_HITS} h) x) y
    where k = 1"""
ORACLES["stream_routed"] = f"""
    select 'index' as kind, vendor || ':' || type || ':' || coalesce(property_id, '') as id, link as value from (
      select *, row_number() over (partition by vendor, type, property_id order by created_date, link) as k from {PARSED_HITS} h) x where k = 1
    union all
    select 'check', ip, cast(status as varchar) from (
      select *, row_number() over (partition by ip order by date, status) as k from {CHECKS} c where status <> 500) x where k = 1
    union all
    select 'listing', key, link from (
      select *, row_number() over (partition by key order by created_date desc, link) as k from (
      select *, vendor || ':' || coalesce(property_id, 'FAILURE') || ':' || type as key from {PARSED_HITS} h) x) y where k = 1
    union all
    select 'raw', ip, cast(status as varchar) from {CHECKS} c where status = 500"""
ORACLES["survivor_merge"] = ORACLES["dedupe_survivor"]
ORACLES["claim_repeat"] = ORACLES["claim_dispatch"]
ORACLES["snapshot_reset"] = ORACLES["recrawl_reset"]
ORACLES["pages_due"] = f"""select seed, idx, vendor || crawl_url || case site when 'mbnd' then '?p=' else '/p' end || idx as url,
    case when idx <= filled then 3 else 0 end as n_results
  from (select *, unnest(range(first, greatest(first, least(coalesce(max_depth, 2), filled + 1)) + 1)) as idx
    from (select *, coalesce(start_index, case site when 'mbnd' then 0 else 1 end) as first from {_view(dv.PAGED_SEEDS)} v) a) b
  where not (seed % 7 = 0 and idx >= 4 and first <= 4)"""
ORACLES["work_insert"] = ORACLES["index_first_write"]
ORACLES["index_refill"] = f"""select vendor, type, property_id, link, case when page_id % 2 = 0 then property_price
    else cast(cast(property_price as decimal(12,2)) + 1 as double) end as property_price from {EXPECTED_HITS} h"""
ORACLES["listings_refill"] = f"""select key, link, price, crawled_date from (
  select *, row_number() over (partition by key order by crawled_date desc, fresh desc, link) as k from (
    select key, link, price, timestamp '2024-01-01 00:00:00' as crawled_date, 0 as fresh from {EXPECTED_PAGES} p
    union all
    select key, link, cast(cast(price as decimal(12,2)) + 1 as double),
      case when page_id % 2 = 0 then timestamp '2024-02-01 00:00:00' else timestamp '2023-12-01 00:00:00' end, 1 from {EXPECTED_PAGES} q) a) b
  where k = 1"""
ORACLES["jobs_read"] = ORACLES["job_stats"]
ORACLES["lines_read"] = f"""select md5(line) as digest, count(*) as n from (
    select trim(unnest(regexp_split_to_array(text, '\\r\\n|\\n|\\r')), {SPACES}) as line from documents) d where line <> '' group by 1"""
ORACLES["append_twice"] = f"""select l_orderkey, l_linenumber, vendor, type, link from {HITS} h
    union all select l_orderkey, l_linenumber, vendor, type, link from {HITS} h where type = 'rent'"""
ORACLES["url_stem"] = "select page_id, case when ends_with(url, '.html') then left(url, length(url) - 5) else url end as stem from pages"
ORACLES["rental_deleted"] = f"""select property_id, seq, ep, sk from {_view(dv.RENTAL)} r
    except all select property_id, seq, ep, sk from {SURVIVORS} s"""
ORACLES["wanted_pairs"] = f"""select vendor, type, property_id from {INDEX} i where exists (
    select 1 from {TASK_TYPES} t where t.vendor = i.vendor and t.type = i.type)"""
