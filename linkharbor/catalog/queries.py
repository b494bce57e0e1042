"""The registered queries: one per operator, over the whole of the given tables.

A query is a function of `Inputs`; the decorator keeps the SQL it is compared with next to it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkharbor.catalog.inputs import COMPANIES, RELEASES, Inputs
from linkharbor.catalog.oracle import (
    BUCKET_AT,
    BUCKET_OF,
    BUCKET_POS,
    LOADED,
    TRUE_LIST,
    WS,
    _host,
    _registered,
    _url,
    oracle,
)
from linkharbor.config import RANK_BUCKETS, ReleaseSettings, literal_rows, slug, sql_list, sql_text
from linkharbor.functions import hosts, ranks, suffixes, text
from linkharbor.operators import (
    extract,
    intermediate,
    load,
    marts,
    measures,
    quality,
    sinks,
    staging,
    validate,
)
from linkharbor.plans.build_marts import (
    links_plan,
    opportunities_plan,
    quality_report,
    read_mart,
    staged_tables,
    write_marts,
)
from linkharbor.plans.extract_release import STAGES, extract_release
from linkharbor.plans.load_release import EDGES, EVIDENCE, RANKS, load_delivered, load_extracted
from linkharbor.session import broadcast_if_small, materialize, new_run_folder
from linkharbor.sources import companies as company_sources
from linkharbor.sources import records, webgraph

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(function: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(Inputs(spark, folder))

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = oracle(sql)
        return function

    return register


def _write_lines(df: DataFrame, name: str, header: str | None = None) -> str:
    """Tab-separated gzip files of a frame, in the format of the web-graph downloads."""
    path = new_run_folder(df.sparkSession, name)
    cells = ", ".join(f"coalesce(string({c}), '')" for c in df.columns)
    df.selectExpr(f"concat_ws('\t', {cells}) as value").write.option("compression", "gzip").text(path)
    if header:
        first = df.sparkSession.range(1).select(F.lit(header).alias("value"))
        first.write.mode("append").option("compression", "gzip").text(path)
    return path


def _write_csv(df: DataFrame, name: str) -> str:
    path = new_run_folder(df.sparkSession, name)
    (
        df.write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def _named_rows(spark: SparkSession, items: Mapping[str, int], key: str, value: str) -> DataFrame:
    schema = T.StructType([T.StructField(key, T.StringType()), T.StructField(value, T.LongType())])
    return literal_rows(spark, list(items.items()), schema)


# --- A. scans ------------------------------------------------------------------------------------


@query("scan_vertices", "select node_id, reversed_domain, num_hosts, domain from fx_vertices")
def _(i: Inputs) -> DataFrame:
    return webgraph.scan_vertices(i.spark, _write_lines(i.vertices, "vertices")).rows


@query("scan_edges", "select source_node_id, target_node_id from fx_edges")
def _(i: Inputs) -> DataFrame:
    return webgraph.scan_edges(i.spark, _write_lines(i.edges, "edges")).rows


# Fixed value: the first line of a rank file.
RANK_HEADER = "#harmonicc_pos\t#harmonicc_val\t#pr_pos\t#pr_val\t#host_rev\t#n_hosts"


@query(
    "scan_ranks",
    """
select rank_position as harmonic_position, 1e6 / rank_position as harmonic_value, rank_position as pagerank_position,
       1e0 / rank_position as pagerank, 'com.site' || p_partkey as reversed_domain, cast(3 as int) as num_hosts,
       'site' || p_partkey || '.com' as domain
from fx_site_ranks""",
)
def _(i: Inputs) -> DataFrame:
    return webgraph.scan_ranks(i.spark, _write_lines(i.rank_lines, "ranks", RANK_HEADER)).rows


@query(
    "scan_malformed",
    """
select case p_type when 'SMALL' then (p_partkey || chr(9) || 'com.site')
                   when 'LARGE' then (p_partkey || chr(9) || 'com.site' || chr(9) || 1 || chr(9) || 'more')
                   when 'PROMO' then ('x' || p_partkey || chr(9) || 'com.site' || chr(9) || 1)
                   else (-p_partkey || chr(9) || 'com.site' || chr(9) || 1) end as bad_line
from part where p_type in ('SMALL', 'LARGE', 'PROMO') or (p_type = 'MEDIUM' and p_partkey > 0)""",
)
def _(i: Inputs) -> DataFrame:
    lines = i.table("part").selectExpr(
        """case p_type when 'SMALL' then concat_ws('\t', p_partkey, 'com.site')
                        when 'LARGE' then concat_ws('\t', p_partkey, 'com.site', '1', 'more')
                        when 'PROMO' then concat_ws('\t', concat('x', p_partkey), 'com.site', '1')
                        when 'MEDIUM' then concat_ws('\t', -p_partkey, 'com.site', '1')
                        else concat_ws('\t', p_partkey, 'com.site', '1') end as value"""
    )
    path = new_run_folder(i.spark, "malformed")
    lines.write.option("compression", "gzip").text(path)
    return webgraph.scan_vertices(i.spark, path).rejected


@query(
    "scan_sample",
    "select node_id, reversed_domain, num_hosts, domain from fx_vertices order by node_id limit 100",
)
def _(i: Inputs) -> DataFrame:
    rows = webgraph.scan_vertices(i.spark, _write_lines(i.vertices, "vertices")).rows
    return webgraph.sample_rows(rows, 100, "node_id")


@query(
    "scan_graph_edges_csv",
    """
select source_domain, target_domain, edge_weight, nullif(source_domain_rank_bucket, '') as source_domain_rank_bucket
from fx_graph_edges""",
)
def _(i: Inputs) -> DataFrame:
    path = _write_csv(i.graph_edges.select(*records.EDGE_COLUMNS), "graph-edges")
    return records.read_graph_edges(i.spark, path)


@query(
    "scan_ranks_csv",
    """
select 'rel-x' as graph_release_id, rank_entity_type, domain_or_host, rank_position, harmonic_centrality, pagerank, rank_bucket
from fx_ranks""",
)
def _(i: Inputs) -> DataFrame:
    path = _write_csv(i.ranks.select(*records.RANK_COLUMNS), "domain-ranks")
    return records.read_domain_ranks(i.spark, path, "rel-x")


@query(
    "scan_wat_csv",
    """
select 'crawl-x' as crawl_id, wat_file_path, warc_record_id, source_url, source_domain, source_host, target_url, target_domain,
       target_company, anchor_text, rel, is_nofollow, nullif(trim(page_title), '') as page_title, page_language, http_status, content_type
from fx_wat""",
)
def _(i: Inputs) -> DataFrame:
    path = _write_csv(i.evidence.select(*records.EVIDENCE_COLUMNS), "evidence")
    return records.read_evidence(i.spark, path, "crawl-x")


@query(
    "scan_csv_inferred",
    """
select lower(source_domain) as source_domain, target_domain,
       cast(case when edge_weight = 6 then 1 else ifnull(edge_weight, 1) end as int) as edge_weight,
       nullif(source_domain_rank_bucket, '') as source_domain_rank_bucket
from fx_graph_edges""",
)
def _(i: Inputs) -> DataFrame:
    weight = F.expr("if(edge_weight = 6, 'many', string(edge_weight))")
    edges = i.graph_edges.select(*records.EDGE_COLUMNS).withColumn("edge_weight", weight)
    return records.read_loose_edges(i.spark, _write_csv(edges, "loose-edges"))


@query("scan_companies", "select company, role, segment, domain from fx_company_rows")
def _(i: Inputs) -> DataFrame:
    nested = i.company_rows.groupBy("company", "role", "segment").agg(
        F.sort_array(F.collect_list("domain")).alias("domains")
    )
    path = new_run_folder(i.spark, "companies")
    nested.write.json(path)
    return company_sources.read_companies_json(i.spark, path)


# --- B. sinks ------------------------------------------------------------------------------------


def _extraction(i: Inputs, root: str):
    return extract_release(
        i.spark, "rel-x", i.named_vertices, i.edges, i.named_ranks, i.companies, root=root
    )


@query("sink_checkpoint", "select * from named_edges")
def _(i: Inputs) -> DataFrame:
    return _extraction(i, new_run_folder(i.spark, "extract")).frame("graph_edges")


STAGE_COUNTS = """
select 'target_vertices' as stage, (select count(*) from targets) as n
union all select 'filtered_edges', (select count(*) from kept_edges)
union all select 'source_vertices', (select count(*) from linking)
union all select 'domain_ranks', (select count(*) from linking_ranks)
union all select 'graph_edges', (select count(*) from named_edges)"""


@query(
    "checkpoint_reuse",
    "select *, true as reused, (select count(*) from named_edges) as rows from named_edges",
)
def _(i: Inputs) -> DataFrame:
    root = new_run_folder(i.spark, "extract")
    _extraction(i, root)
    again = _extraction(i, root)
    stage = again.stages["graph_edges"]
    reused = all(again.stages[name].reused for name in STAGES)
    return stage.frame.selectExpr("*", f"{sql_text(reused)} as reused", f"{stage.rows}L as rows")


@query("sink_raw_append", "select * from raw_edges")
def _(i: Inputs) -> DataFrame:
    path = new_run_folder(i.spark, "raw-append")
    rows = materialize(i.raw_edges, "raw-edges")
    for release in ("rel-a", "rel-b"):
        sinks.append_raw(rows.filter(F.col("graph_release_id") == release), path)
    return sinks.read_raw(i.spark, path, sinks.RAW_EDGES)


@query(
    "sink_replace_release",
    "select * replace (if(graph_release_id = 'rel-a', 2 * edge_weight, edge_weight) as edge_weight) from raw_edges",
)
def _(i: Inputs) -> DataFrame:
    path = new_run_folder(i.spark, "raw-replace")
    rows = materialize(i.raw_edges, "raw-edges")
    sinks.append_raw(rows, path)
    of_release = rows.filter(F.col("graph_release_id") == "rel-a")
    sinks.replace_release(of_release.withColumn("edge_weight", F.col("edge_weight") * 2), path, "rel-a")
    return sinks.read_raw(i.spark, path, sinks.RAW_EDGES)


def _written_mart(key: str, table: str, sql: str) -> None:
    """A mart as read back from the written tables."""

    @query(key, sql)
    def _(i: Inputs) -> DataFrame:
        root = new_run_folder(i.spark, "marts")
        write_marts(i.spark, _staged(i), i.settings, root)
        return read_mart(i.spark, root, table)


_written_mart("sink_marts", "fct_backlink_opportunities", "select * from opportunities")
_written_mart("sink_marts_summary", "mart_company_backlink_summary", "select * from summary")
_written_mart("sink_marts_overlap", "mart_competitor_overlap", "select * from overlap_mart")


@query(
    "load_counts",
    f"""
select stage, n as rows from ({STAGE_COUNTS})
union all select 'scanned_edges', (select count(*) from fx_edges)
union all select 'raw_domain_edges', (select count(*) from (
    select distinct source_domain, target_domain from named_edges))
union all select 'raw_domain_ranks', (select count(*) from linking_ranks)""",
)
def _(i: Inputs) -> DataFrame:
    found = _extraction(i, new_run_folder(i.spark, "extract"))
    settings = replace(i.settings, release=ReleaseSettings("rel-x", "crawl-x"))
    loaded = load_extracted(
        i.spark,
        found.frame("graph_edges"),
        found.frame("domain_ranks"),
        settings,
        new_run_folder(i.spark, "raw"),
        i.loaded_at,
    )
    counts = found.counts() | {EDGES: loaded.domain_edges, RANKS: loaded.domain_ranks}
    return _named_rows(i.spark, counts, "stage", "rows")


# --- C. graph cut --------------------------------------------------------------------------------


def _targets(i: Inputs) -> DataFrame:
    return extract.target_vertices(i.named_vertices, i.company_frame)


def _small_targets(i: Inputs) -> DataFrame:
    """The targets as a written stage, broadcast once their number is known to be small."""
    return broadcast_if_small(materialize(_targets(i), "targets"))


def _kept(i: Inputs) -> DataFrame:
    """The tracked edges as a written stage, since several steps read them."""
    return materialize(extract.edges_to_targets(i.edges, _small_targets(i)), "kept-edges")


def _sources(i: Inputs, kept: DataFrame) -> DataFrame:
    return extract.source_vertices(i.named_vertices, kept)


@query("target_vertices", "select node_id, reversed_domain, domain, num_hosts from targets")
def _(i: Inputs) -> DataFrame:
    return _targets(i)


@query(
    "missing_targets",
    "select domain from fx_wanted where domain not in (select domain from fx_vertices)",
)
def _(i: Inputs) -> DataFrame:
    wanted = i.wanted_domains
    return extract.missing_targets(extract.target_vertices(i.named_vertices, wanted), wanted)


@query("edges_to_targets", "select source_node_id, target_node_id, target_domain from kept_edges")
def _(i: Inputs) -> DataFrame:
    return extract.edges_to_targets(i.edges, _small_targets(i))


@query("source_vertices", "select node_id, reversed_domain, domain, num_hosts from linking")
def _(i: Inputs) -> DataFrame:
    return _sources(i, _kept(i))


@query("source_ranks", "select * from linking_ranks")
def _(i: Inputs) -> DataFrame:
    return extract.source_ranks(i.named_ranks, _sources(i, _kept(i)))


@query("assemble_graph_edges", "select * from named_edges")
def _(i: Inputs) -> DataFrame:
    kept = _kept(i)
    sources = materialize(_sources(i, kept), "sources")
    return extract.graph_edges(kept, sources, extract.source_ranks(i.named_ranks, sources))


@query("edges_to_inputs", "select source_domain, target_domain, edge_weight from named_edges")
def _(i: Inputs) -> DataFrame:
    kept = _kept(i)
    return extract.edge_inputs(kept, _sources(i, kept), _small_targets(i))


# --- D. scalar rules -----------------------------------------------------------------------------


@query(
    "rank_bucket",
    f"""
select p_partkey, rank_position, {BUCKET_OF.format('rank_position')} as rank_bucket
from (select p_partkey, if(p_type = 'SMALL', null, rank_position) as rank_position from fx_site_ranks)""",
)
def _(i: Inputs) -> DataFrame:
    known = i.site_ranks.selectExpr("p_partkey", "if(p_type = 'SMALL', null, rank_position) as rank_position")
    return known.selectExpr("*", f"{ranks.rank_bucket('rank_position')} as rank_bucket")


@query(
    "reverse_domain",
    """
select page_id, spelling, array_to_string(list_reverse(string_split(name, '.')), '.') as reversed from fx_names""",
)
def _(i: Inputs) -> DataFrame:
    return i.names.selectExpr("page_id", "spelling", f"{hosts.reverse_labels('name')} as reversed")


@query("normalize_host", f"select page_id, spelling, {_host('name')} as host from fx_names")
def _(i: Inputs) -> DataFrame:
    return i.names.selectExpr("page_id", "spelling", f"{hosts.normalize_host('name')} as host")


@query(
    "normalize_domain",
    """
select page_id, spelling, registered as registered_domain from fx_names left join names_registered on value = name""",
)
def _(i: Inputs) -> DataFrame:
    return suffixes.registered_domain(i.names, "name", "registered_domain", i.rules).drop("name")


@query("absolute_url", f"select page_id, spelling, {_url('name')} as url from fx_names")
def _(i: Inputs) -> DataFrame:
    return i.names.selectExpr("page_id", "spelling", f"{hosts.absolute_url('name')} as url")


@query(
    "clean_text",
    f"""
select conv_id, turn, nullif(trim(chr(9) || ' ' || if(role = 'system', ' ', text) || chr(160) || chr(10), {WS}), '') as text
from conversations""",
)
def _(i: Inputs) -> DataFrame:
    padded = "concat('\t ', if(role = 'system', ' ', text), '\xa0\n')"
    return i.table("conversations").selectExpr(
        "conv_id", "turn", f"{text.clean_text(padded)} as text"
    )


@query(
    "infer_nofollow",
    f"""
select source_url, target_url, list_contains(string_split(translate(lower(ifnull(rel, '')), {WS}, repeat(' ', 29)), ' '), 'nofollow')
       or http_status = 404 as is_nofollow
from fx_wat""",
)
def _(i: Inputs) -> DataFrame:
    flag = text.infer_nofollow("http_status = 404", "rel")
    return i.evidence.selectExpr("source_url", "target_url", f"{flag} as is_nofollow")


FLAG_WORDS = ("TRUE", " yes ", "t", "", "0", "Y\n")


@query(
    "parse_bool",
    f"""
select l_orderkey, l_partkey, l_linenumber, ifnull(lower(trim(w, {WS})) in ({TRUE_LIST}), false) as flag
from (select *, ['TRUE', ' yes ', 't', '', '0', 'Y' || chr(10)][l_linenumber] as w from lineitem)""",
)
def _(i: Inputs) -> DataFrame:
    word = f"get(array({sql_list(FLAG_WORDS)}), l_linenumber - 1)"
    return i.table("lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_linenumber", f"{text.parse_bool(word)} as flag"
    )


@query(
    "optional_number",
    """
select graph_release_id, rank_entity_type, domain_or_host, try_cast(rank_position as int) as rank_position,
       try_cast(pagerank as double) as pagerank, ifnull(rank_position = 'n/a', false) as bad_position,
       ifnull(pagerank = '-', false) as bad_pagerank
from fx_rank_text""",
)
def _(i: Inputs) -> DataFrame:
    return i.rank_text.selectExpr(
        "graph_release_id",
        "rank_entity_type",
        "domain_or_host",
        f"{text.optional_number('rank_position', 'int')} as rank_position",
        f"{text.optional_number('pagerank', 'double')} as pagerank",
        f"{text.is_bad_number('rank_position', 'int')} as bad_position",
        f"{text.is_bad_number('pagerank', 'double')} as bad_pagerank",
    )


@query(
    "rank_entity",
    f"""
select graph_release_id, rank_entity_type, rank_position,
       if(rank_entity_type = 'host', {_host('domain_or_host')}, registered) as entity
from fx_delivered_ranks left join {_registered('fx_delivered_ranks', 'domain_or_host')} on value = domain_or_host""",
)
def _(i: Inputs) -> DataFrame:
    return validate.rank_entity(i.delivered_ranks, i.rules, "entity").select(
        "graph_release_id", "rank_entity_type", "rank_position", "entity"
    )


# --- E. record rules -----------------------------------------------------------------------------


def _with_rules(checked: validate.Checked) -> DataFrame:
    return checked.rows.withColumn(validate.FAILED, F.array_join(validate.FAILED, ","))


def _edge_records(i: Inputs) -> DataFrame:
    """Delivered edges with a company name for the brands 1 to 12 and none for the others."""
    number = "int(regexp_extract(target_domain, 'brand([0-9]+)', 1))"
    return i.delivered_edges.selectExpr(
        "*",
        f"if({number} <= 12, concat('B', {number}), '') as target_company",
        f"if({number} <= 30, 'known', null) as target_segment",
    )


@query(
    "validate_edges",
    f"""
with e as (
  select *, cast(regexp_extract(target_domain, 'brand([0-9]+)', 1) as int) as k from fx_delivered_edges
), r as (
  select graph_release_id, ifnull(s.registered, e.source_domain) as source_domain, ifnull(t.registered, e.target_domain) as target_domain,
         edge_weight, source_domain_rank_bucket, if(k <= 12, 'B' || k, '') as target_company, if(k <= 30, 'known', null) as target_segment,
         s.registered is null as bad_source
  from e left join {_registered('fx_delivered_edges', 'source_domain')} s on s.value = e.source_domain
  left join {_registered('fx_delivered_edges', 'target_domain')} t on t.value = e.target_domain
)
select * exclude (bad_source), array_to_string(list_filter(
         [if(bad_source, 'source_domain', null), if(target_company = '', 'target_company', null),
          if(target_segment is null, 'target_segment', null), if(edge_weight < 0, 'edge_weight', null)], lambda x: x is not null), ',') as failed_rules
from r""",
)
def _(i: Inputs) -> DataFrame:
    return _with_rules(validate.validate_edges(_edge_records(i), i.rules))


@query(
    "validate_ranks",
    f"""
with r as (
  select d.*, if(rank_entity_type = 'host', {_host('domain_or_host')}, registered) as entity
  from fx_delivered_ranks d left join {_registered('fx_delivered_ranks', 'domain_or_host')} on value = domain_or_host
)
select * exclude (entity) replace (ifnull(entity, domain_or_host) as domain_or_host),
       array_to_string(list_filter(
         [if(rank_entity_type not in ('domain', 'host'), 'rank_entity_type', null), if(entity is null, 'domain_or_host', null),
          if(rank_position < 1, 'rank_position', null), if(harmonic_centrality < 0, 'harmonic_centrality', null),
          if(pagerank < 0, 'pagerank', null)], lambda x: x is not null), ',') as failed_rules
from r""",
)
def _(i: Inputs) -> DataFrame:
    return _with_rules(validate.validate_ranks(i.delivered_ranks, i.rules))


@query(
    "validate_evidence",
    f"""
with r as (
  select w.*, sd.registered as rsd, td.registered as rtd, su.registered as rsu, tu.registered as rtu
  from fx_delivered_wat w
  left join {_registered('fx_delivered_wat', 'source_domain')} sd on sd.value = w.source_domain
  left join {_registered('fx_delivered_wat', 'target_domain')} td on td.value = w.target_domain
  left join {_registered('fx_delivered_wat', 'source_url')} su on su.value = w.source_url
  left join {_registered('fx_delivered_wat', 'target_url')} tu on tu.value = w.target_url
)
select crawl_id, wat_file_path, warc_record_id, ifnull({_url('source_url')}, source_url) as source_url,
       rsd as source_domain, lower(source_host) as source_host, target_url, ifnull(rtd, target_domain) as target_domain,
       target_company, nullif(trim(anchor_text, {WS}), '') as anchor_text, rel, ifnull(lower(rel) like '%nofollow%', false) as is_nofollow,
       nullif(trim(page_title, {WS}), '') as page_title, page_language, http_status, content_type,
       array_to_string(list_filter(
         [if({_url('source_url')} is null, 'source_url', null),
          if({_host('source_url')} is distinct from {_host('source_host')}, 'source_host', null),
          if(rsu is distinct from rsd, 'source_domain', null), if(rtu is distinct from rtd, 'target_domain', null),
          if(http_status not between 100 and 599, 'http_status', null)], lambda x: x is not null), ',') as failed_rules
from r""",
)
def _(i: Inputs) -> DataFrame:
    return _with_rules(validate.validate_evidence(i.delivered_evidence, i.rules))


@query(
    "validate_companies",
    f"""
with c as (
  select f.*, registered as name from fx_company_rows_raw f
  left join {_registered('fx_company_rows_raw', 'domain')} on value = domain
), per as (
  select company, bool_or(role not in ('target', 'competitor')) as bad_role, count(domain) as n,
         bool_or(domain is not null and name is null) as bad_name
  from c group by company
)
select 'role_valid' as rule, company, null as detail from per where bad_role
union all select 'has_domain', company, null from per where n = 0
union all select 'domain_resolves', company, null from per where bad_name
union all select 'unique_in_company', company, name from c where name is not null group by company, name having count(*) > 1
union all select 'unique_across_companies', null, name from c where name is not null group by name having count(distinct company) > 1
union all select 'exactly_one_target', null, cast(count(distinct company) filter (role = 'target') as varchar) from c
          having count(distinct company) filter (role = 'target') <> 1""",
)
def _(i: Inputs) -> DataFrame:
    return validate.validate_companies(i.company_rows_raw, i.rules)


@query(
    "company_for_domain",
    """
select page_id, spelling, name, registered as registered_domain, company as target_company, segment as target_segment
from fx_names left join names_registered on value = name left join fx_companies on domain = registered""",
)
def _(i: Inputs) -> DataFrame:
    return validate.company_for_domain(i.names, "name", i.company_frame, i.rules)


# --- F. raw load ---------------------------------------------------------------------------------

HIGH = ("top_10k", "top_100k")


@query(
    "build_domain_edges",
    f"""
with n as (
  select graph_release_id, s.registered as source_domain, t.registered as target_domain, edge_weight, source_domain_rank_bucket as b
  from fx_delivered_edges e join {_registered('fx_delivered_edges', 'source_domain')} s on s.value = e.source_domain
  join {_registered('fx_delivered_edges', 'target_domain')} t on t.value = e.target_domain
  where s.registered is not null
), g as (
  select graph_release_id, source_domain, target_domain, company as target_company, segment as target_segment,
         cast(sum(edge_weight) as bigint) as edge_weight, min({BUCKET_POS.format('b')}) as pos,
         min(b) filter ({BUCKET_POS.format('b')} is null) as other, bool_or(b in ('top_10k', 'top_100k')) as source_high_authority_flag
  from n join fx_companies c on c.domain = target_domain group by all
)
select * exclude (pos, other), ifnull({BUCKET_AT.format('pos')}, other) as source_domain_rank_bucket, {LOADED} as loaded_at from g""",
)
def _(i: Inputs) -> DataFrame:
    return load.build_domain_edges(i.delivered_edges, i.company_frame, i.rules, HIGH, i.loaded_at)


@query("load_graph_edges", "select * from raw_edges")
def _(i: Inputs) -> DataFrame:
    return i.raw_edges


@query(
    "load_domain_ranks",
    f"""
select graph_release_id, rank_entity_type, lower(domain_or_host) as domain_or_host, try_cast(rank_position as int) as rank_position,
       try_cast(harmonic_centrality as double) as harmonic_centrality, try_cast(pagerank as double) as pagerank,
       nullif(rank_bucket, '') as rank_bucket, {LOADED} as loaded_at
from fx_rank_text""",
)
def _(i: Inputs) -> DataFrame:
    return load.load_domain_ranks(i.rank_text, i.loaded_at)


def _delivered(i: Inputs, evidence: bool = False) -> str:
    """Both releases loaded one after the other, or the first with the evidence of the crawl."""
    root = new_run_folder(i.spark, "raw-delivered")
    for release in RELEASES[:1] if evidence else RELEASES:
        of_release = F.col("graph_release_id") == release
        load_delivered(
            i.spark,
            i.delivered_edges.filter(of_release),
            replace(i.settings, release=ReleaseSettings(release, "crawl-a")),
            i.rules,
            root,
            i.loaded_at,
            domain_ranks=i.delivered_ranks.filter(of_release),
            link_evidence=i.delivered_evidence if evidence else None,
            strict=False,
            load_id=f"delivery-{release}",
        )
    return root


@query("load_raw_inputs", "select * from loaded_edges")
def _(i: Inputs) -> DataFrame:
    return sinks.read_raw(i.spark, f"{_delivered(i)}/{EDGES}", sinks.RAW_EDGES)


@query(
    "load_raw_ranks",
    f"""
select rank_entity_type, if(rank_entity_type = 'host', {_host('domain_or_host')}, registered) as domain_or_host, rank_position,
       harmonic_centrality, pagerank, rank_bucket, {LOADED} as loaded_at, graph_release_id
from fx_delivered_ranks left join {_registered('fx_delivered_ranks', 'domain_or_host')} on value = domain_or_host
where rank_entity_type <> 'page' and ifnull(rank_position, 1) >= 1 and (rank_entity_type = 'host' or registered is not null)""",
)
def _(i: Inputs) -> DataFrame:
    return sinks.read_raw(i.spark, f"{_delivered(i)}/{RANKS}", sinks.RAW_RANKS)


def _blank_is_null(column: str) -> str:
    return f"nullif(trim({column}, {WS}), '') as {column}"


@query(
    "load_raw_evidence",
    f"""
select wat_file_path, {_blank_is_null('warc_record_id')}, {_url('source_url')} as source_url, lower(source_domain) as source_domain,
       lower(source_host) as source_host, target_url, target_domain, target_company, {_blank_is_null('anchor_text')},
       {_blank_is_null('rel')},
       ifnull(is_nofollow, false) or list_contains(string_split(translate(lower(ifnull(rel, '')), {WS}, repeat(' ', 29)), ' '), 'nofollow')
         as is_nofollow,
       {_blank_is_null('page_title')}, {_blank_is_null('page_language')}, http_status, {_blank_is_null('content_type')},
       {LOADED} as extracted_at, crawl_id
from fx_delivered_wat where page_language not in ('es', 'de') and http_status <> 99""",
)
def _(i: Inputs) -> DataFrame:
    return sinks.read_raw(i.spark, f"{_delivered(i, evidence=True)}/{EVIDENCE}", sinks.RAW_EVIDENCE)


# --- G. staging ----------------------------------------------------------------------------------


def _staged(i: Inputs) -> dict[str, DataFrame]:
    return staged_tables(
        i.company_frame, i.raw_edges, i.raw_ranks, i.evidence, lower_edge_names=False
    )


@query("stg_domain_edges", "select * from staged_edges")
def _(i: Inputs) -> DataFrame:
    return staging.stage_domain_edges(i.raw_edges)


@query("stg_domain_ranks", "select * from staged_ranks")
def _(i: Inputs) -> DataFrame:
    return staging.stage_domain_ranks(i.raw_ranks)


@query("stg_wat_link_evidence", "select * from staged_wat")
def _(i: Inputs) -> DataFrame:
    return staging.stage_link_evidence(i.evidence)


@query("stg_companies", "select company, role, segment, domain from fx_company_rows")
def _(i: Inputs) -> DataFrame:
    return staging.stage_companies(i.company_rows)


# --- H. intermediate -----------------------------------------------------------------------------


@query("int_domain_rank_rollup", "select * from rollup")
def _(i: Inputs) -> DataFrame:
    return intermediate.domain_rank_rollup(staging.stage_domain_ranks(i.raw_ranks), i.score)


def _links(i: Inputs) -> DataFrame:
    return links_plan(_staged(i), i.settings)


@query("int_referring_domain_company", "select * from links")
def _(i: Inputs) -> DataFrame:
    return _links(i)


def _matrix(i: Inputs) -> DataFrame:
    return intermediate.company_matrix(_links(i), i.companies, i.score)


@query("int_matrix", "select * from matrix")
def _(i: Inputs) -> DataFrame:
    return _matrix(i)


@query("int_matrix_changed_companies", "select * from changed_matrix")
def _(i: Inputs) -> DataFrame:
    """Links to companies that the configuration does not list, or lists in another segment."""
    links = _links(i).withColumns(
        {
            "target_company": F.expr("if(target_company in ('B4', 'B12'), concat('Old ', target_company), target_company)"),
            "target_segment": F.expr("if(target_company = 'B9', 'direct_modern_bi', target_segment)"),
        }
    )
    return intermediate.company_matrix(materialize(links, "changed-links"), i.companies, i.score)


@query(
    "int_referring_domain_company_by_rank",
    """
select l.* replace (l.source_high_authority_flag or ifnull(r.high_authority_rank_flag, false) as source_high_authority_flag)
from links l left join rollup r using (graph_release_id, source_domain)""",
)
def _(i: Inputs) -> DataFrame:
    return links_plan(_staged(i), replace(i.settings, flag_from_rank=True))


@query("int_competitor_overlap", "select * from overlap")
def _(i: Inputs) -> DataFrame:
    return intermediate.competitor_overlap(_links(i), i.companies)


def _examples(i: Inputs) -> DataFrame:
    return intermediate.evidence_examples(staging.stage_link_evidence(i.evidence), i.score)


@query("int_evidence_examples", "select * from examples")
def _(i: Inputs) -> DataFrame:
    return _examples(i)


# --- I. marts ------------------------------------------------------------------------------------


@query(
    "dim_companies",
    """
select company, role, segment, array_to_string(list_sort(list(domain)), ', ') as domains
from fx_company_rows group by all""",
)
def _(i: Inputs) -> DataFrame:
    return marts.company_dimension(i.company_rows)


@query("fct_backlinks", "select * from facts")
def _(i: Inputs) -> DataFrame:
    return marts.backlink_facts(_links(i))


@query("opp_select", "select * from chosen")
def _(i: Inputs) -> DataFrame:
    return marts.select_opportunities(_matrix(i), i.companies)


def _enriched(i: Inputs) -> DataFrame:
    return marts.enrich_opportunities(marts.select_opportunities(_matrix(i), i.companies), _examples(i))


ENRICHED = """graph_release_id, source_domain, evidence_record_count, category_match_count, has_page_title, has_anchor_text,
 has_example_url, example_url, example_target_url, example_target_company, example_page_title, example_anchor_text"""


@query("opp_enrich", f"select {ENRICHED} from enriched")
def _(i: Inputs) -> DataFrame:
    return _enriched(i).select(*[c.strip() for c in ENRICHED.split(",")])


def _signal(key: str, column: str, value: Callable[[Inputs], str]) -> None:
    @query(key, f"select graph_release_id, source_domain, {column} from signals")
    def _(i: Inputs) -> DataFrame:
        return _enriched(i).selectExpr("graph_release_id", "source_domain", f"{value(i)} as {column}")


_signal("sig_coverage", "competitor_coverage_signal", lambda i: marts.coverage_signal(i.score))
_signal("sig_authority", "authority_signal", lambda i: marts.authority_signal(i.score))
_signal("sig_segment", "segment_relevance_signal", lambda i: marts.segment_signal(i.companies, i.score))
_signal("sig_category", "category_relevance_signal", lambda i: marts.category_signal(i.score))
_signal("sig_evidence", "evidence_quality_signal", lambda i: marts.evidence_signal())


@query(
    "sig_clean",
    """
with n as (
  select url, h.name || case when page_id % 3 = 0 then '' when page_id % 3 = 1 then '-' || 'crack' else repeat('.long', 15) end as name
  from (select page_id, url, regexp_extract(url, '^[a-z]+://([^/]*)', 1) as name from pages) h
  union all
  select url, ['bit.ly', 't.co', 'tinyurl.com', 'goo.gl', 'ow.ly'][1 + page_id % 5] from pages
)
select url, name, if(list_contains(['bit.ly', 't.co', 'tinyurl.com', 'goo.gl', 'ow.ly'], name)
         or len(list_filter(['casino', 'coupon', 'viagra', 'porn', 'xxx', 'apk', 'crack', 'warez', 'torrent'], lambda w: contains(name, w))) > 0, 0e0,
       if(length(name) > 80, 0.4e0, 1e0)) as clean_domain_signal
from n""",
)
def _(i: Inputs) -> DataFrame:
    host = "regexp_extract(url, '^[a-z]+://([^/]*)', 1)"
    end = "case page_id % 3 when 0 then '' when 1 then '-crack' else repeat('.long', 15) end"
    short = f"get(array({sql_list(i.score.shorteners)}), int(page_id % 5))"
    names = i.table("pages").selectExpr("url", f"explode(array(concat({host}, {end}), {short})) as name")
    return names.selectExpr("*", f"{marts.clean_signal(i.score, 'name')} as clean_domain_signal")


@query("opp_score", "select graph_release_id, source_domain, opportunity_score from scored")
def _(i: Inputs) -> DataFrame:
    signals = marts.add_signals(_enriched(i), i.companies, i.score)
    return signals.selectExpr(
        "graph_release_id", "source_domain", f"{marts.opportunity_score(i.score)} as opportunity_score"
    )


def _opportunities(i: Inputs) -> DataFrame:
    return opportunities_plan(_staged(i), i.settings)


def _opportunity_part(key: str, *columns: str) -> None:
    names = ", ".join(("graph_release_id", "opportunity_domain", *columns))

    @query(key, f"select {names} from opportunities")
    def _(i: Inputs) -> DataFrame:
        return _opportunities(i).select("graph_release_id", "opportunity_domain", *columns)


_opportunity_part("opp_tier", "opportunity_score", "opportunity_tier")
_opportunity_part("opp_action", "recommended_action")
_opportunity_part("opp_explain", "score_explanation")


@query("fct_opportunities", "select * from opportunities")
def fct_opportunities(i: Inputs) -> DataFrame:
    return _opportunities(i)


@query("company_summary", "select * from summary")
def _(i: Inputs) -> DataFrame:
    return marts.company_summary(_links(i), i.companies, i.score)


@query("competitor_overlap", "select * from overlap_mart")
def _(i: Inputs) -> DataFrame:
    return marts.competitor_overlap_report(_links(i), i.companies)


@query(
    "enrichment_candidates",
    """
select graph_release_id, opportunity_domain, opportunity_score from opportunities
qualify row_number() over (partition by graph_release_id order by opportunity_score desc, opportunity_domain) <= 500""",
)
def _(i: Inputs) -> DataFrame:
    return marts.enrichment_candidates(_opportunities(i), i.settings.release.max_enrichment_domains)


# --- J. data tests -------------------------------------------------------------------------------


@query(
    "dq_unique_combination",
    """
select graph_release_id, source_domain, target_domain from fx_graph_edges group by all having count(*) >= 2""",
)
def _(i: Inputs) -> DataFrame:
    return quality.failing_unique_combination(
        i.graph_edges, ("graph_release_id", "source_domain", "target_domain")
    )


@query("dq_expression", "select * from fx_graph_edges where edge_weight > 4")
def _(i: Inputs) -> DataFrame:
    return quality.failing_expression(i.graph_edges, "edge_weight <= 4")


@query("dq_not_null", "select * from fx_ranks where rank_position is null")
def _(i: Inputs) -> DataFrame:
    return quality.failing_not_null(i.ranks, "rank_position")


@query(
    "dq_unique",
    """
select domain_or_host, count(*) as n_records from fx_ranks where domain_or_host is not null
group by domain_or_host having count(*) > 1""",
)
def _(i: Inputs) -> DataFrame:
    return quality.failing_unique(i.ranks, "domain_or_host")


@query(
    "dq_accepted_values",
    """
select rank_bucket as value, count(*) as n_records from fx_ranks
where rank_bucket not in ('top_10k', 'top_100k') group by all""",
)
def _(i: Inputs) -> DataFrame:
    return quality.failing_accepted_values(i.ranks, "rank_bucket", RANK_BUCKETS[:2])


@query(
    "dq_relationships",
    """
select distinct target_domain as value from fx_graph_edges
where target_domain not in (select domain from fx_companies)""",
)
def _(i: Inputs) -> DataFrame:
    return quality.failing_relationships(i.graph_edges, "target_domain", i.company_frame, "domain")


ORACLE_TABLES = {
    "raw_domain_edges": "raw_edges",
    "raw_domain_ranks": "fx_ranks",
    "stg_companies": "fx_companies",
    "stg_domain_edges": "staged_edges",
    "stg_domain_ranks": "staged_ranks",
    "int_domain_rank_rollup": "rollup",
    "int_referring_domain_company": "links",
    "int_referring_domain_company_matrix": "matrix",
    "int_competitor_overlap": "overlap",
    "dim_companies": "dim",
    "fct_backlinks": "facts",
    "fct_backlink_opportunities": "opportunities",
    "mart_company_backlink_summary": "summary",
    "mart_competitor_overlap": "overlap_mart",
}


def _suite_sql() -> str:
    """One counting statement per check; tables of the suite under their names in the oracle."""

    def failing(table: str, check: quality.Check) -> str:
        match check:
            case quality.NotNull(column):
                return f"(select count(*) from {table} where {column} is null)"
            case quality.AcceptedValues(column, values):
                listed = ", ".join(f"'{v}'" for v in values)
                return f"(select count(*) from {table} where {column} not in ({listed}))"
            case quality.Between(column, low, high):
                tests = [f"{column} < {low}"] * (low is not None) + [f"{column} > {high}"] * (high is not None)
                return f"(select count(*) from {table} where {' or '.join(tests)})"
            case quality.IsFalse(column):
                return f"(select count(*) from {table} where {column})"
            case quality.Unique(columns):
                keys = ", ".join(columns)
                return f"(select count(*) from (select {keys} from {table} group by {keys} having count(*) > 1))"
            case quality.References(column, parent, parent_column):
                known = f"select {parent_column} from {ORACLE_TABLES[parent]}"
                return f"(select count(distinct {column}) from {table} where {column} not in ({known}))"
        raise TypeError(check)

    checks = quality.standard_checks(COMPANIES.target_link_column)
    return "\nunion all ".join(
        f"select '{t}' as table_name, '{c.name}' as check_name, {failing(ORACLE_TABLES[t], c)} as failures"
        for t, cs in checks.items()
        for c in cs
    )


@query("dq_suite", _suite_sql())
def _(i: Inputs) -> DataFrame:
    """All checks over written tables, so that no table is computed once per check."""
    raw_edges, raw_ranks = materialize(i.raw_edges, "raw-edges"), materialize(i.raw_ranks, "raw-ranks")
    staged = staged_tables(i.company_frame, raw_edges, raw_ranks, i.evidence)
    staged |= {
        name: materialize(staged[name], name) for name in ("stg_domain_edges", "stg_domain_ranks")
    }
    root = new_run_folder(i.spark, "marts")
    counts = write_marts(i.spark, staged, i.settings, root)
    written = {name: read_mart(i.spark, root, name) for name in counts}
    tables = {"raw_domain_edges": raw_edges, "raw_domain_ranks": raw_ranks} | staged | written
    return quality_report(tables, i.settings)


# --- K. measures and topics ----------------------------------------------------------------------


def _mart(i: Inputs, name: str) -> DataFrame:
    match name:
        case "dim_companies":
            return marts.company_dimension(staging.stage_companies(i.company_frame))
        case "fct_backlinks":
            return marts.backlink_facts(_links(i))
        case "fct_backlink_opportunities":
            return _opportunities(i)
        case "mart_company_backlink_summary":
            return marts.company_summary(_links(i), i.companies, i.score)
        case "mart_competitor_overlap":
            return marts.competitor_overlap_report(_links(i), i.companies)
    raise KeyError(name)


class _Marts(dict):
    """Marts by name, planned when asked for."""

    def __init__(self, inputs: Inputs) -> None:
        super().__init__()
        self.inputs = inputs

    def __missing__(self, name: str) -> DataFrame:
        self[name] = _mart(self.inputs, name)
        return self[name]


@query(
    "measure_count",
    """
select o.graph_release_id, opportunity_count, backlink_rows, company_rows, competitor_rows
from (select graph_release_id, count(*) as opportunity_count from opportunities group by 1) o
join (select graph_release_id, count(*) as backlink_rows from facts group by 1) b using (graph_release_id)
join (select graph_release_id, count(*) as company_rows from summary group by 1) s using (graph_release_id)
join (select graph_release_id, count(*) as competitor_rows from overlap_mart group by 1) c using (graph_release_id)""",
)
def _(i: Inputs) -> DataFrame:
    by = ("graph_release_id",)
    found = measures.measure(
        _mart(i, "fct_backlink_opportunities"), "fct_backlink_opportunities", "opportunity_count", by=by
    )
    for table, name in (
        ("fct_backlinks", "backlink_rows"),
        ("mart_company_backlink_summary", "company_rows"),
        ("mart_competitor_overlap", "competitor_rows"),
    ):
        found = found.join(measures.measure(_mart(i, table), table, name, by=by), list(by))
    return found


@query(
    "measure_filtered_count",
    """
select graph_release_id, count_if(opportunity_tier = 'tier_1') as tier_1_opportunities,
       count_if(opportunity_tier = 'tier_2') as tier_2_opportunities, count_if(opportunity_tier = 'tier_3') as tier_3_opportunities,
       count_if(opportunity_tier = 'monitor') as monitor_opportunities, count_if(source_high_authority_flag) as high_authority_opportunities
from opportunities group by 1""",
)
def _(i: Inputs) -> DataFrame:
    return measures.measure(
        _opportunities(i),
        "fct_backlink_opportunities",
        "tier_1_opportunities",
        "tier_2_opportunities",
        "tier_3_opportunities",
        "monitor_opportunities",
        "high_authority_opportunities",
        by=("graph_release_id",),
    )


@query(
    "measure_count_distinct",
    """
select target_company, count(distinct referring_domain) as referring_domains from facts group by 1
union all select 'companies', count(distinct company) from fx_company_rows""",
)
def _(i: Inputs) -> DataFrame:
    domains = measures.measure(
        _mart(i, "fct_backlinks"), "fct_backlinks", "referring_domains", by=("target_company",)
    )
    companies = measures.measure(
        marts.company_dimension(i.company_rows), "dim_companies", "company_count"
    ).selectExpr("'companies' as target_company", "company_count as referring_domains")
    return domains.unionByName(companies)


@query(
    "measure_filtered_distinct",
    """
select target_company, count(distinct if(source_high_authority_flag, referring_domain, null)) as high_authority_referring_domains
from facts group by 1""",
)
def _(i: Inputs) -> DataFrame:
    return measures.measure(
        _mart(i, "fct_backlinks"),
        "fct_backlinks",
        "high_authority_referring_domains",
        by=("target_company",),
    )


@query(
    "measure_sum",
    """
select graph_release_id, total_edge_weight, referring_domains, high_authority_referring_domains,
       competitor_referring_domains, overlap_domains, competitor_only_domains
from (select graph_release_id, cast(sum(total_edge_weight) as bigint) as total_edge_weight from facts group by 1)
join (select graph_release_id, cast(sum(referring_domain_count) as bigint) as referring_domains,
             cast(sum(high_authority_referring_domain_count) as bigint) as high_authority_referring_domains
      from summary group by 1) using (graph_release_id)
join (select graph_release_id, cast(sum(competitor_referring_domain_count) as bigint) as competitor_referring_domains,
             cast(sum(overlap_domain_count) as bigint) as overlap_domains,
             cast(sum(competitor_only_domain_count) as bigint) as competitor_only_domains
      from overlap_mart group by 1) using (graph_release_id)""",
)
def _(i: Inputs) -> DataFrame:
    by = ("graph_release_id",)
    weight = measures.measure(_mart(i, "fct_backlinks"), "fct_backlinks", "total_edge_weight", by=by)
    summary = measures.measure(
        _mart(i, "mart_company_backlink_summary"),
        "mart_company_backlink_summary",
        "referring_domains",
        "high_authority_referring_domains",
        by=by,
    )
    overlap = measures.measure(
        _mart(i, "mart_competitor_overlap"),
        "mart_competitor_overlap",
        "competitor_referring_domains",
        "overlap_domains",
        "competitor_only_domains",
        by=by,
    )
    return weight.join(summary, list(by)).join(overlap, list(by))


@query(
    "measure_avg",
    """
select graph_release_id, round(average_opportunity_score, 6) as average_opportunity_score,
       round(average_backlink_strength_proxy, 6) as average_backlink_strength_proxy, round(average_jaccard_overlap, 6) as average_jaccard_overlap
from (select graph_release_id, avg(opportunity_score) as average_opportunity_score from opportunities group by 1)
join (select graph_release_id, avg(backlink_strength_proxy) as average_backlink_strength_proxy from summary group by 1) using (graph_release_id)
join (select graph_release_id, avg(jaccard_overlap) as average_jaccard_overlap from overlap_mart group by 1) using (graph_release_id)""",
)
def _(i: Inputs) -> DataFrame:
    by = ("graph_release_id",)
    found = None
    for table, name in (
        ("fct_backlink_opportunities", "average_opportunity_score"),
        ("mart_company_backlink_summary", "average_backlink_strength_proxy"),
        ("mart_competitor_overlap", "average_jaccard_overlap"),
    ):
        # Averages of doubles depend on the order of the rows in the last bits.
        part = measures.measure(_mart(i, table), table, name, by=by).withColumn(name, F.round(name, 6))
        found = part if found is None else found.join(part, list(by))
    return found


@query(
    "measure_max",
    """
select graph_release_id, max_opportunity_score, max_backlink_strength_proxy
from (select graph_release_id, max(opportunity_score) as max_opportunity_score from opportunities group by 1)
join (select graph_release_id, max(backlink_strength_proxy) as max_backlink_strength_proxy from summary group by 1) using (graph_release_id)""",
)
def _(i: Inputs) -> DataFrame:
    by = ("graph_release_id",)
    score = measures.measure(
        _opportunities(i), "fct_backlink_opportunities", "max_opportunity_score", by=by
    )
    strength = measures.measure(
        _mart(i, "mart_company_backlink_summary"),
        "mart_company_backlink_summary",
        "max_backlink_strength_proxy",
        by=by,
    )
    return score.join(strength, list(by))


@query(
    "join_companies",
    """
select f.*, d.role as company_role, d.segment as company_segment, d.domains as company_domains
from facts f left join dim d on d.company = f.target_company""",
)
def _(i: Inputs) -> DataFrame:
    return measures.join_companies(
        _mart(i, "fct_backlinks"), "fct_backlinks", _mart(i, "dim_companies")
    )


@query(
    "topic_query",
    """
select segment as dim_companies_segment, cast(sum(competitor_only_domain_count) as bigint) as competitor_only_domains,
       cast(sum(overlap_domain_count) as bigint) as overlap_domains
from overlap_mart left join dim on company = competitor_company
where role = 'competitor'
group by 1 order by 2 desc, 1 limit 100""",
)
def _(i: Inputs) -> DataFrame:
    return measures.topic_query(
        _Marts(i),
        measures.Query(
            "competitor_overlap",
            ("dim_companies.segment", "competitor_only_domains", "overlap_domains"),
            filters=(("dim_companies.role", "competitor"),),
            sorts=(("competitor_only_domains", True),),
            tie_break=("dim_companies.segment",),
        ),
    )


STORED_SQL = {
    "q_top_opportunities": """
select opportunity_domain, opportunity_score, opportunity_tier, linked_competitors, competitor_count, source_high_authority_flag,
       source_domain_rank_bucket, recommended_action
from opportunities order by opportunity_score desc, opportunity_domain, graph_release_id limit 100""",
    "q_high_authority": """
select opportunity_domain, opportunity_score, opportunity_tier, linked_competitors, competitor_count, source_domain_rank_bucket
from opportunities where source_high_authority_flag order by opportunity_score desc, opportunity_domain, graph_release_id limit 100""",
    "q_tier_summary": """
select opportunity_tier, count(*) as opportunity_count, avg(opportunity_score) as average_opportunity_score
from opportunities group by 1 order by 2 desc, 1 limit 100""",
    "q_company_footprint": """
select target_company, target_segment, referring_domain_count, high_authority_referring_domain_count, backlink_strength_proxy
from summary order by referring_domain_count desc, target_company, graph_release_id limit 100""",
    "q_overlap": """
select competitor_company, competitor_segment, overlap_domain_count, competitor_only_domain_count, b1_only_domain_count, jaccard_overlap
from overlap_mart order by competitor_only_domain_count desc, competitor_company, graph_release_id limit 100""",
}


def _stored(key: str) -> None:
    @query(key, STORED_SQL[key])
    def _(i: Inputs) -> DataFrame:
        asked = measures.stored_query(key, slug(i.companies.target.company))
        return measures.topic_query(_Marts(i), asked)


for _key in STORED_SQL:
    _stored(_key)
