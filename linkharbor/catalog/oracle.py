"""DuckDB SQL for the registered queries, written independently of the Spark plans.

`VIEWS` holds the shared building blocks; `oracle(sql)` puts the ones a statement names in front.
"""

from __future__ import annotations

import re

from linkharbor.catalog.inputs import (
    ANCHORS,
    BRANDS,
    COMPANIES,
    CUSTOMER_NODE_BASE,
    LOADED_AT,
    SECOND_RELEASE_FROM,
    SUFFIX_RULES,
)
from linkharbor.config import ScoreSettings
from linkharbor.functions.text import TRUE_WORDS, WHITESPACE

SCORE = ScoreSettings()
LOADED = f"timestamp '{LOADED_AT}'"
WS = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)
TRUE_LIST = ", ".join(f"'{w}'" for w in TRUE_WORDS)


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join("null" if v is None else f"'{v}'" for v in r) + ")" for r in rows)


def _words(words: tuple[str, ...]) -> str:
    return "(" + "|".join(words) + ")"


def _host(x: str) -> str:
    """SQL of the host of a name or URL."""
    low = f"lower(trim({x}, {WS}))"
    url = f"translate(case when contains({low}, '://') then {low} else 'https://' || {low} end, chr(9) || chr(10) || chr(13), '')"
    server = f"regexp_replace(regexp_extract({url}, '^[a-z][a-z0-9+.-]*://([^/?#]*)', 1), '^.*@', '')"
    plain = f"regexp_extract({server}, '^([^:\\[\\]]*)(:|$)', 1)"
    return f"nullif(case when {server} like '[%' then regexp_extract({server}, '^\\[([^\\]]*)\\]', 1) else {plain} end, '')"


def _url(x: str) -> str:
    t = f"trim({x}, {WS})"
    return f"case when regexp_matches({t}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]') then {t} end"


def _registered(source: str, column: str) -> str:
    """SQL of a table (value, registered) over the distinct values of a column."""
    return f"""(
  with hosts as (
    select v, string_split(rtrim(h, '.'), '.') as parts
    from (select distinct {column} as v, {_host(column)} as h from {source}) where h is not null
  ), tails as (
    select v, parts, n, array_to_string(parts[len(parts) - n + 1:], '.') as tail,
           array_to_string(parts[len(parts) - n + 2:], '.') as above
    from hosts, unnest(range(1, len(parts) + 1)) as r(n)
  ), hits as (
    select v, parts,
           max(case when x.rule is not null then n - 1 end) as exception_len,
           max(case when p.rule is not null or w.rule is not null then n end) as rule_len
    from tails
    left join suffix_rules p on p.rule = tail
    left join suffix_rules w on n > 1 and w.rule = '*.' || above
    left join suffix_rules x on x.rule = '!' || tail
    group by all
  )
  select v as value, case when len(parts) > k then array_to_string(parts[len(parts) - k:], '.') end as registered
  from (select v, parts, coalesce(exception_len, rule_len) as k from hits) where k > 0
)"""


ORDERED_BUCKETS = "(select * from (values ('top_10k', 1), ('top_100k', 2), ('top_1m', 3), ('long_tail', 4)) b(bucket, pos))"
BUCKET_OF = "case when {0} <= 10000 then 'top_10k' when {0} <= 100000 then 'top_100k' when {0} <= 1000000 then 'top_1m' when {0} is not null then 'long_tail' end"
BUCKET_POS = "list_position(['top_10k', 'top_100k', 'top_1m', 'long_tail'], {0})"
BUCKET_AT = "['top_10k', 'top_100k', 'top_1m', 'long_tail'][{0}]"

_links = [(c.company, COMPANIES.link_column(c.company)) for c in COMPANIES.companies]
_any = lambda names: " or ".join(COMPANIES.link_column(n) for n in names)

VIEWS: dict[str, str] = {
    # --- inputs ---------------------------------------------------------------------------------
    "fx_companies": "select * from (values "
    + _values([(c.company, c.role, c.segment, c.priority, d) for c in COMPANIES.companies for d in c.domains])
    + ") t(company, role, segment, priority, domain)",
    "suffix_rules": f"select * from (values {_values([(r,) for r in SUFFIX_RULES])}) t(rule)",
    "fx_company_rows": """
select s_name as company, if(s_suppkey = 0, 'target', 'competitor') as role,
       'segment-' || s_nationkey as segment,
       unnest(list_filter(['supp' || s_suppkey || '.com', if(s_acctbal > 5000, 'shop-' || s_suppkey || '.net', null)],
                          lambda d: d is not null)) as domain
from supplier""",
    "fx_company_rows_raw": """
select s_name as company,
       case when s_acctbal > 9000 then 'partner' when s_acctbal > 8500 then 'target' else 'competitor' end as role,
       'segment-' || s_nationkey as segment,
       unnest(case when s_acctbal < 500 then ['nation' || s_nationkey || '.com']
                   when s_acctbal < 1000 then ['https://www.SUPP' || s_suppkey || '.com/about', 'supp' || s_suppkey || '.com']
                   when s_acctbal < 1500 then ['localhost']
                   when s_acctbal < 2000 then [cast(null as varchar)]
                   else ['https://www.SUPP' || s_suppkey || '.com/about'] end) as domain
from supplier""",
    "fx_wanted": """
select lower(replace(p_brand, '#', '')) || '.com' as domain from part
union
select lower(replace(n_name, ' ', '-')) || '.com' from nation""",
    "fx_vertices": f"""
select p_partkey + 1000 as node_id, 'com.site' || p_partkey as reversed_domain,
       cast(1 + p_size % 5 as int) as num_hosts, 'site' || p_partkey || '.com' as domain
from part
union all
select c_custkey + {CUSTOMER_NODE_BASE}, 'com.cust' || c_custkey, cast(1 + c_nationkey % 3 as int), 'cust' || c_custkey || '.com' from customer
union all
select k, 'com.brand' || k, 9, 'brand' || k || '.com'
from (select 1 + s_suppkey % {BRANDS} as k from supplier union select cast(split_part(p_brand, '#', 2) as bigint) from part)""",
    "fx_edges": f"""
select l_partkey + 1000 as source_node_id, 1 + l_suppkey % {BRANDS} as target_node_id from lineitem
union all select o_custkey + {CUSTOMER_NODE_BASE}, 1 + o_orderkey % {BRANDS} from orders""",
    "fx_site_ranks": """
select p_partkey, p_type, cast(1 + (x * x * 6) // 10000 as int) as rank_position
from (select *, (p_size - 1) * 1000 + cast(round(p_retailprice * 10 - 9000) as bigint) as x
      from part)""",
    "fx_graph_edges": f"""
select if(l_shipdate < timestamp '{SECOND_RELEASE_FROM}', 'rel-a', 'rel-b') as graph_release_id,
       if(l_linenumber = 1, 'SITE', 'site') || l_partkey || '.com' as source_domain,
       'brand' || (1 + l_suppkey % {BRANDS}) || '.com' as target_domain,
       nullif(l_linenumber, 7) as edge_weight,
       {BUCKET_OF.format('rank_position')} as source_domain_rank_bucket
from lineitem left join fx_site_ranks on p_partkey = l_partkey
union all
select if(o_orderdate < timestamp '{SECOND_RELEASE_FROM}', 'rel-a', 'rel-b'), 'cust' || o_custkey || '.com',
       'brand' || (1 + o_orderkey % {BRANDS}) || '.com', cast(1 + o_orderkey % 4 as int), ''
from orders""",
    "fx_delivered_edges": """
select graph_release_id,
       if(edge_weight is null, 'localhost', 'https://www.' || source_domain || '/post?id=1') as source_domain,
       ' WWW.' || target_domain || ':443/ ' as target_domain,
       case edge_weight when 6 then -1 when 5 then null else edge_weight end as edge_weight,
       if(source_domain_rank_bucket = '', 'unlisted', source_domain_rank_bucket) as source_domain_rank_bucket
from fx_graph_edges""",
    "fx_ranks": f"""
with r as (select *, 'site' || p_partkey || '.com' as name, {BUCKET_OF.format('rank_position')} as bucket from fx_site_ranks)
select unnest(['rel-a', 'rel-b']) as graph_release_id, 'domain' as rank_entity_type, name as domain_or_host,
       rank_position, 1e6 / rank_position as harmonic_centrality, 1e0 / rank_position as pagerank,
       bucket as rank_bucket, {LOADED} as loaded_at
from r
union all
select 'rel-a', 'domain', upper(name), cast(rank_position + 5 as int), 1e0, 0.5e0, 'long_tail', timestamp '2026-01-02 00:00:00'
from r where p_type = 'PROMO'
union all
select 'rel-a', 'domain', name, null, null, null, null, timestamp '2026-01-03 00:00:00' from r where p_type = 'ECONOMY'
union all
select 'rel-a', 'host', 'blog.' || name, rank_position, 2e0, 0.25e0, bucket, {LOADED} from r where p_type = 'LARGE'""",
    "fx_delivered_ranks": """
select graph_release_id,
       if(rank_position between 200000 and 300000, 'page', rank_entity_type) as rank_entity_type,
       'HTTPS://user@' || domain_or_host || ':8080/x#y' as domain_or_host,
       if(rank_position between 1000 and 20000, 0, rank_position) as rank_position,
       if(rank_position between 1000 and 20000, -1e0, harmonic_centrality) as harmonic_centrality,
       pagerank, rank_bucket
from fx_ranks""",
    "fx_rank_text": """
select graph_release_id, rank_entity_type, domain_or_host,
       if(rank_position < 1000, 'n/a', cast(rank_position as varchar)) as rank_position,
       cast(harmonic_centrality as varchar) as harmonic_centrality,
       if(rank_position > 1000000, '-', cast(pagerank as varchar)) as pagerank,
       coalesce(rank_bucket, '') as rank_bucket
from fx_ranks""",
    "fx_wat": f"""
with hrefs as (
  select page_id, url, regexp_extract(html, 'lang="([a-z]+)"', 1) as lang,
         regexp_extract(html, '<title>([^<]*)</title>', 1) as title,
         regexp_extract_all(html, '<a href="([^"]*)">[^<]*</a>', 1) as links
  from pages
), rows_ as (
  select *, page_id + i - 1 as number, links[i] as href,
         if(page_id % 2 = 0, 'www', 'blog') || '.site' || (page_id // 2) || '.com' as host
  from hrefs, unnest(range(1, len(links) + 1)) as r(i)
)
select 'crawl-a' as crawl_id, 'crawl-data/part-' || (page_id % 16) || '.wat.gz' as wat_file_path,
       if(lang <> 'es', 'record-' || page_id, null) as warc_record_id,
       'https://' || host || regexp_extract(url, '^[a-z]+://[^/]*(.*)$', 1) as source_url,
       'SITE' || (page_id // 2) || '.com' as source_domain, host as source_host,
       'https://brand' || (1 + number % 12) || '.com' || href as target_url,
       'brand' || (1 + number % 12) || '.com' as target_domain, 'B' || (1 + number % 12) as target_company,
       case when lang = 'en' then [{", ".join("null" if a is None else f"'{a}'" for a in ANCHORS)}][1 + number % {len(ANCHORS)}]
                                  || ' ' || split_part(href, '/', -1)
            when lang <> 'de' then 'more words' end as anchor_text,
       case number % 5 when 0 then 'noopener NoFollow' when 1 then 'noopener' end as rel,
       false as is_nofollow, if(lang <> 'fr', title, null) as page_title, lang as page_language,
       cast(if(number % 10 = 9, 404, 200) as int) as http_status, 'text/html' as content_type,
       {LOADED} as extracted_at
from rows_""",
    "fx_delivered_wat": """
select crawl_id, wat_file_path, warc_record_id,
       if(page_language = 'es', '/' || source_host, '  ' || source_url || chr(10)) as source_url,
       source_domain, upper(source_host) as source_host, target_url,
       if(page_language = 'de', 'other.com', target_domain) as target_domain, target_company,
       ' ' || anchor_text || chr(9) as anchor_text, rel, is_nofollow, page_title, page_language,
       cast(if(http_status = 404, 99, http_status) as int) as http_status, content_type
from fx_wat""",
    "fx_names": """
with h as (select page_id, url, regexp_extract(url, '^[a-z]+://([^/]*)', 1) as host from pages),
l as (
  select page_id, [
    url, ' ' || chr(9) || upper(host) || chr(10), 'ftp://user:pw@' || host || ':8080?q=http://x.org',
    host || '/see?next=https://brand1.com',
    regexp_replace(host, 'example\\.com$', 'co.uk'), regexp_replace(host, 'example\\.net$', 'kawasaki.jp'),
    regexp_replace(host, 'example\\.org$', 'city.kawasaki.jp'), regexp_replace(host, 'example\\.[a-z]+$', 'internal'),
    'https://' || regexp_extract(host, '([^.]*\\.)?[^.]*$', 0) || '.', regexp_extract(host, '[^.]*$', 0),
    '/pages/' || page_id, '10.0.0.' || (page_id % 256), 'www.brand' || (1 + page_id % 20) || '.com',
    'my_shop.' || host, '  '] as names
  from h
)
select page_id, cast(i - 1 as int) as spelling, names[i] as name from l, unnest(range(1, 16)) as r(i)""",
    "names_registered": f"select * from {_registered('fx_names', 'name')}",
    # --- graph cut ------------------------------------------------------------------------------
    "targets": "select v.* from fx_vertices v where v.domain in (select domain from fx_companies)",
    "kept_edges": """
select source_node_id, target_node_id, domain as target_domain
from fx_edges join targets on node_id = target_node_id""",
    "linking": "select * from fx_vertices where node_id in (select source_node_id from kept_edges)",
    "linking_ranks": f"""
select 'domain' as rank_entity_type, 'site' || p_partkey || '.com' as domain_or_host, rank_position,
       1e6 / rank_position as harmonic_centrality, 1e0 / rank_position as pagerank,
       {BUCKET_OF.format('rank_position')} as rank_bucket
from fx_site_ranks where p_partkey + 1000 in (select node_id from linking)""",
    "named_edges": """
select s.domain as source_domain, target_domain, 1 as edge_weight, rank_bucket as source_domain_rank_bucket
from kept_edges join linking s on s.node_id = source_node_id
left join linking_ranks on domain_or_host = s.domain""",
    # --- raw and staging ------------------------------------------------------------------------
    "raw_edges": f"""
with g as (
  select graph_release_id, lower(source_domain) as source_domain, t.domain as target_domain,
         company as target_company, segment as target_segment,
         cast(sum(ifnull(edge_weight, 1)) as bigint) as edge_weight,
         min({BUCKET_POS.format('source_domain_rank_bucket')}) as pos
  from fx_graph_edges e, fx_companies t where lower(e.target_domain) = t.domain
  group by all
)
select * exclude (pos), {BUCKET_AT.format('pos')} as source_domain_rank_bucket,
       coalesce(pos <= 2, false) as source_high_authority_flag, {LOADED} as loaded_at
from g""",
    "staged_edges": f"""
select graph_release_id, lower(source_domain) as source_domain, target_company, target_segment,
       array_to_string(list_sort(list_distinct(list(lower(target_domain)))), ', ') as target_domains,
       count(*) as raw_edge_rows, cast(sum(ifnull(edge_weight, 1)) as bigint) as total_edge_weight,
       {BUCKET_AT.format('min(' + BUCKET_POS.format('source_domain_rank_bucket') + ')')} as source_domain_rank_bucket,
       bool_or(ifnull(source_high_authority_flag, false)) as source_high_authority_flag, max(loaded_at) as loaded_at
from raw_edges group by all""",
    "staged_ranks": """
select distinct on (graph_release_id, rank_entity_type, lower(domain_or_host))
       graph_release_id, rank_entity_type, lower(domain_or_host) as domain_or_host, rank_position,
       harmonic_centrality, pagerank, rank_bucket, loaded_at
from fx_ranks
order by graph_release_id, rank_entity_type, lower(domain_or_host), rank_position asc nulls last, loaded_at desc nulls last,
         harmonic_centrality desc nulls last, pagerank desc nulls last, rank_bucket asc nulls last""",
    "staged_wat": """
select * replace (lower(source_domain) as source_domain, lower(source_host) as source_host, lower(target_domain) as target_domain),
       lower(concat(source_url, ' ', target_url, ' ', page_title, ' ', anchor_text)) as evidence_text
from fx_wat""",
    # --- intermediate ---------------------------------------------------------------------------
    "rollup": f"""
select graph_release_id, domain_or_host as source_domain, min(rank_position) as best_rank_position,
       max(harmonic_centrality) as harmonic_centrality, max(pagerank) as pagerank,
       {BUCKET_AT.format('min(' + BUCKET_POS.format('rank_bucket') + ')')} as best_rank_bucket,
       min(rank_position) <= 100000 as high_authority_rank_flag
from staged_ranks where rank_entity_type = 'domain' group by all""",
    "links": """
select e.graph_release_id, e.source_domain, target_company, target_segment, target_domains, raw_edge_rows,
       total_edge_weight, ifnull(source_domain_rank_bucket, best_rank_bucket) as source_domain_rank_bucket,
       source_high_authority_flag, best_rank_position as source_domain_rank_position,
       harmonic_centrality as source_domain_harmonic_centrality, pagerank as source_domain_pagerank, loaded_at
from staged_edges e left join rollup using (graph_release_id, source_domain)""",
    "matrix": f"""
select graph_release_id, source_domain,
       {", ".join(f"bool_or(target_company = '{c}') as {col}" for c, col in _links)},
       count_if(target_company <> 'B1') as competitor_count,
       count_if(target_company <> 'B1' and target_segment = 'direct_modern_bi') as direct_competitor_count,
       {", ".join(f"count_if(target_segment = '{s}') as {col}" for s, col in SCORE.segment_columns[1:])},
       nullif(array_to_string(list_sort(list(target_company) filter (target_company <> 'B1')), ', '), '') as linked_competitors,
       nullif(array_to_string(list_sort(list(distinct target_segment) filter (target_company <> 'B1')), ', '), '') as competitor_segments,
       cast(sum(total_edge_weight) as bigint) as total_edge_weight,
       {BUCKET_AT.format('min(' + BUCKET_POS.format('source_domain_rank_bucket') + ')')} as best_rank_bucket,
       bool_or(source_high_authority_flag) as source_high_authority_flag,
       min(source_domain_rank_position) as source_domain_rank_position,
       max(source_domain_harmonic_centrality) as source_domain_harmonic_centrality,
       max(source_domain_pagerank) as source_domain_pagerank
from links group by graph_release_id, source_domain""",
    "overlap": """
with own as (select distinct graph_release_id, source_domain from links where target_company = 'B1'),
pairs as (
  select distinct l.graph_release_id, target_company, l.source_domain, o.source_domain is not null as shared
  from links l left join own o using (graph_release_id, source_domain)
),
sizes as (select graph_release_id, target_company, count(*) as n, count_if(shared) as s from pairs group by all),
grid as (
  select r.graph_release_id, c.company, c.segment
  from (select distinct graph_release_id from links) r, (select distinct company, segment from fx_companies where role = 'competitor') c
)
select g.graph_release_id, g.company as competitor_company, g.segment as competitor_segment,
       ifnull(z.n, 0) as competitor_referring_domain_count, ifnull(t.n, 0) as b1_referring_domain_count,
       ifnull(z.s, 0) as overlap_domain_count, ifnull(z.n - z.s, 0) as competitor_only_domain_count,
       ifnull(t.n, 0) - ifnull(z.s, 0) as b1_only_domain_count,
       ifnull(z.n, 0) + ifnull(t.n, 0) - ifnull(z.s, 0) as union_domain_count,
       case when ifnull(z.n, 0) + ifnull(t.n, 0) > 0
            then cast(ifnull(z.s, 0) as double) / (ifnull(z.n, 0) + ifnull(t.n, 0) - ifnull(z.s, 0)) else 0e0 end as jaccard_overlap
from grid g
left join sizes z on z.graph_release_id = g.graph_release_id and z.target_company = g.company
left join sizes t on t.graph_release_id = g.graph_release_id and t.target_company = 'B1'""",
    "examples": f"""
with e as (select *, regexp_matches(evidence_text, '{_words(SCORE.category_words)}') as term from staged_wat),
best as (
  select distinct on (source_domain) * from e
  order by source_domain, term desc, page_title is null, anchor_text is null, source_url nulls first, target_url nulls first,
           target_company nulls first, page_title nulls first, anchor_text nulls first
)
select source_domain, n as evidence_record_count, k as category_match_count, has_page_title, has_anchor_text, has_example_url,
       source_url as example_url, target_url as example_target_url, target_company as example_target_company,
       page_title as example_page_title, anchor_text as example_anchor_text, evidence_text as example_evidence_text
from best join (
  select source_domain, count(*) as n, count_if(term) as k, bool_or(page_title is not null) as has_page_title,
         bool_or(anchor_text is not null) as has_anchor_text, bool_or(source_url is not null) as has_example_url
  from e group by source_domain) using (source_domain)""",
    # --- marts ----------------------------------------------------------------------------------
    "dim": """
select company, role, segment, array_to_string(list_sort(list(domain)), ', ') as domains
from fx_companies group by all""",
    "chosen": "select * from matrix where not links_to_b1 and competitor_count >= 1",
    "enriched": """
select c.*, ifnull(evidence_record_count, 0) as evidence_record_count, ifnull(category_match_count, 0) as category_match_count,
       ifnull(has_page_title, false) as has_page_title, ifnull(has_anchor_text, false) as has_anchor_text,
       ifnull(has_example_url, false) as has_example_url, example_url, example_target_url, example_target_company,
       example_page_title, example_anchor_text, example_evidence_text
from chosen c left join examples using (source_domain)""",
    "signals": f"""
select e.*, cast(if(competitor_count > 4, 4, competitor_count) as double) / 4 as competitor_coverage_signal,
       cast(ifnull(map {{'top_10k': 1.0, 'top_100k': 0.85, 'top_1m': 0.45, 'long_tail': 0.15}}[best_rank_bucket], 0) as double) as authority_signal,
       cast(case when {_any(COMPANIES.prioritized('strong'))} then 1
                 when ({_any(COMPANIES.prioritized('secondary'))}) and direct_competitor_count >= 1 then 0.85
                 when direct_competitor_count + analytics_workspace_competitor_count + semantic_layer_competitor_count >= 1 then 0.75
                 when oss_self_serve_competitor_count + data_app_competitor_count >= 1 then 0.5
                 when incumbent_competitor_count + legacy_acquired_competitor_count >= 1 then 0.25 else 0 end as double) as segment_relevance_signal,
       cast(if(category_match_count > 2, 2, category_match_count) as double) / 2 as category_relevance_signal,
       if(evidence_record_count = 0, 0e0,
          cast(4 + 2 * (has_example_url::int + has_page_title::int + has_anchor_text::int) as double) / 10) as evidence_quality_signal,
       case when source_domain in ({", ".join(f"'{s}'" for s in SCORE.shorteners)})
              or regexp_matches(source_domain, '{_words(SCORE.spam_words)}') then 0e0
            when length(source_domain) > 80 then 0.4e0 else 1e0 end as clean_domain_signal
from enriched e""",
    "scored": """
select *, round(competitor_coverage_signal * 30 + authority_signal * 25 + segment_relevance_signal * 15
                + category_relevance_signal * 15 + evidence_quality_signal * 10 + clean_domain_signal * 5, 2) as opportunity_score
from signals""",
    "opportunities": f"""
select graph_release_id, source_domain as opportunity_domain, false as links_to_b1, linked_competitors, competitor_segments,
       competitor_count, {", ".join(col for _, col in SCORE.segment_columns)}, best_rank_bucket as source_domain_rank_bucket,
       source_high_authority_flag, source_domain_rank_position, source_domain_harmonic_centrality, source_domain_pagerank,
       total_edge_weight, competitor_coverage_signal, authority_signal, segment_relevance_signal, category_relevance_signal,
       evidence_quality_signal, clean_domain_signal, opportunity_score,
       if(opportunity_score < 25, 'monitor', if(opportunity_score < 50, 'tier_3', if(opportunity_score < 75, 'tier_2', 'tier_1'))) as opportunity_tier,
       example_url, example_target_url, example_target_company, example_page_title, example_anchor_text,
       case when regexp_matches(example_evidence_text, '{_words(SCORE.comparison_words)}') then 'Create comparison content'
            when regexp_matches(example_evidence_text, '{_words(SCORE.partner_words)}') then 'Partner/integration outreach'
            when regexp_matches(example_evidence_text, '{_words(SCORE.community_words)}') then 'Community/content outreach'
            when evidence_record_count = 0 and source_high_authority_flag then 'Validate with SEO tool'
            else 'Review manually' end as recommended_action,
       printf('Links to %d competitor(s): %s. Rank bucket: %s. WAT evidence rows: %d.', competitor_count,
              ifnull(linked_competitors, 'none'), ifnull(best_rank_bucket, 'unknown'), evidence_record_count) as score_explanation
from scored""",
    "facts": "select * rename (source_domain as referring_domain) from links",
    "summary": """
with grid as (select r.graph_release_id, d.* from (select distinct graph_release_id from links) r, dim d),
n as (
  select g.graph_release_id, g.company as target_company, g.role, g.segment as target_segment,
         count(distinct l.source_domain) as r,
         count(distinct l.source_domain) filter (l.source_high_authority_flag) as h,
         cast(coalesce(sum(l.total_edge_weight), 0) as bigint) as w
  from grid g left join links l on l.graph_release_id = g.graph_release_id and l.target_company = g.company
  group by all
), top as (select graph_release_id, max(r) as mr, max(h) as mh, max(w) as mw from n group by all),
s as (
  select n.*, if(mr > 0, r::double / mr, 0) as sr, if(mh > 0, h::double / mh, 0) as sh, if(mw > 0, w::double / mw, 0) as sw
  from n join top using (graph_release_id)
)
select graph_release_id, target_company, role, target_segment, r as referring_domain_count,
       h as high_authority_referring_domain_count, w as total_edge_weight, sr as normalized_referring_domain_count,
       sh as normalized_high_authority_referring_domain_count, sw as normalized_edge_depth,
       round(sr * 45 + sh * 35 + sw * 20, 2) as backlink_strength_proxy
from s""",
    "overlap_mart": "select * replace (round(jaccard_overlap, 4) as jaccard_overlap) from overlap",
}


# Links after a change of the configuration: two companies are no longer listed, one has another segment.
VIEWS["changed_links"] = """
select * replace (if(target_company in ('B4', 'B12'), 'Old ' || target_company, target_company) as target_company,
                  if(target_company = 'B9', 'direct_modern_bi', target_segment) as target_segment)
from links"""
VIEWS["changed_matrix"] = VIEWS["matrix"].replace("from links", "from changed_links")
VIEWS["loaded_edges"] = f"""
with n as (
  select graph_release_id, s.registered as source_domain, t.registered as target_domain, edge_weight, source_domain_rank_bucket as b
  from fx_delivered_edges e join {_registered('fx_delivered_edges', 'source_domain')} s on s.value = e.source_domain
  join {_registered('fx_delivered_edges', 'target_domain')} t on t.value = e.target_domain
  where s.registered is not null and ifnull(edge_weight, 0) >= 0
), g as (
  select graph_release_id, source_domain, target_domain, company as target_company, segment as target_segment,
         cast(sum(edge_weight) as bigint) as edge_weight, min({BUCKET_POS.format('b')}) as pos,
         min(b) filter ({BUCKET_POS.format('b')} is null) as other, bool_or(b in ('top_10k', 'top_100k')) as source_high_authority_flag
  from n join fx_companies c on c.domain = target_domain group by all
)
select * exclude (pos, other), ifnull({BUCKET_AT.format('pos')}, other) as source_domain_rank_bucket, {LOADED} as loaded_at from g"""


# Views that several others read: worked out once, and never mixed into the join order of what reads them.
MATERIALIZED = ("targets", "kept_edges", "linking", "linking_ranks")


def oracle(sql: str) -> str:
    """The statement with every view it names, directly or through others, put in front."""
    needed: dict[str, None] = {}

    def visit(text: str) -> None:
        for name, body in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(body)
                needed[name] = None

    visit(sql)
    body = sql.strip()
    if not needed:
        return body
    kind = {n: "as materialized" if n in MATERIALIZED else "as" for n in needed}
    views = "with " + ",\n".join(f"{n} {kind[n]} ({VIEWS[n].strip()})" for n in needed)
    return f"{views},\n{body.removeprefix('with ')}" if body.startswith("with ") else f"{views}\n{body}"
