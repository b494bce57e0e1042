"""Link-graph inputs read off the given tables.

parts are linking sites (`site<n>.com`), customers linking sites without a rank (`cust<n>.com`),
suppliers stand for linked brands (`brand<n>.com`), every line item and every order is a link, and
every `<a>` of a page is one row of link evidence. All rows of the tables are used.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkharbor.config import CompanySet, ReleaseSettings, Settings, sql_list
from linkharbor.functions.hosts import reverse_labels
from linkharbor.functions.ranks import rank_bucket
from linkharbor.functions.suffixes import SuffixRules, rules_from_list
from linkharbor.operators import load
from linkharbor.sources.records import EVIDENCE_COLUMNS

# Suffix rules that the names of the given tables need. A real run reads the published list.
SUFFIX_RULES = (
    "com", "net", "org", "io", "co", "uk", "co.uk", "jp", "co.jp", "*.kawasaki.jp", "!city.kawasaki.jp", "*.ck", "!www.ck",
)

RELEASES = ("rel-a", "rel-b")
SECOND_RELEASE_FROM = "1999-01-01"
LOADED_AT = "2026-01-01 00:00:00"
BRANDS = 60
SITE_NODE_BASE = 1000
CUSTOMER_NODE_BASE = 10_000_000_000_000

COMPANIES = CompanySet.from_items(
    [
        {"company": "B1", "role": "target", "segment": "target", "domains": ["brand1.com"]},
        {
            "company": "B2",
            "role": "competitor",
            "segment": "direct_modern_bi",
            "priority": "strong",
            "domains": ["brand2.com", "brand13.com"],
        },
        {
            "company": "B3",
            "role": "competitor",
            "segment": "direct_modern_bi",
            "priority": "secondary",
            "domains": ["brand3.com"],
        },
        {"company": "B4", "role": "competitor", "segment": "direct_modern_bi", "domains": ["brand4.com"]},
        {"company": "B5", "role": "competitor", "segment": "analytics_workspace", "domains": ["brand5.com"]},
        {
            "company": "B6",
            "role": "competitor",
            "segment": "semantic_layer_adjacent",
            "priority": "strong",
            "domains": ["brand6.com"],
        },
        {"company": "B7", "role": "competitor", "segment": "semantic_layer_adjacent", "domains": ["brand7.com"]},
        {"company": "B8", "role": "competitor", "segment": "oss_self_serve_bi", "domains": ["brand8.com"]},
        {"company": "B9", "role": "competitor", "segment": "data_app_adjacent", "domains": ["brand9.com"]},
        {"company": "B10", "role": "competitor", "segment": "data_app_adjacent", "domains": ["brand10.com"]},
        {"company": "B11", "role": "competitor", "segment": "enterprise_incumbent", "domains": ["brand11.com"]},
        {"company": "B12", "role": "competitor", "segment": "legacy_acquired", "domains": ["brand12.com"]},
    ]
)

# Anchor texts of the made-up links, by number of the link on its page; null leaves it out.
ANCHORS = (
    "looker alternative, compare",
    "partner integration",
    "community newsletter post",
    "embedded analytics partner",
    "semantic layer and dbt",
    "us vs them",
    "more words",
    None,
)

# Columns of the given tables that are read; naming them saves a look into the files first.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "part": "p_partkey bigint, p_brand string, p_type string, p_size int, p_retailprice double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_shipdate timestamp_ntz",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


class Inputs:
    """The inputs of one data folder, each a lazy DataFrame."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self.settings = Settings(COMPANIES, ReleaseSettings("rel-a", "crawl-a"))
        self.companies = COMPANIES
        self.score = self.settings.score

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def rules(self) -> SuffixRules:
        return rules_from_list(self.spark, SUFFIX_RULES)

    @property
    def loaded_at(self) -> Column:
        return F.expr(f"timestamp '{LOADED_AT}'")

    # --- companies --------------------------------------------------------------------------

    @cached_property
    def company_frame(self) -> DataFrame:
        return self.companies.frame(self.spark)

    @property
    def company_rows(self) -> DataFrame:
        """A long company list from the suppliers, with a second domain for some."""
        own = "concat('supp', s_suppkey, '.com')"
        shop = "if(s_acctbal > 5000, concat('shop-', s_suppkey, '.net'), null)"
        return self.table("supplier").selectExpr(
            "s_name as company",
            "if(s_suppkey = 0, 'target', 'competitor') as role",
            "concat('segment-', s_nationkey) as segment",
            f"explode(array_compact(array({own}, {shop}))) as domain",
        )

    @property
    def company_rows_raw(self) -> DataFrame:
        """The list as delivered: unknown roles, shared, repeated, missing and unusable domains."""
        own = "concat('https://www.SUPP', s_suppkey, '.com/about')"
        return self.table("supplier").selectExpr(
            "s_name as company",
            "case when s_acctbal > 9000 then 'partner' when s_acctbal > 8500 then 'target' "
            "else 'competitor' end as role",
            "concat('segment-', s_nationkey) as segment",
            f"""explode(case when s_acctbal < 500 then array(concat('nation', s_nationkey, '.com'))
                             when s_acctbal < 1000 then array({own}, concat('supp', s_suppkey, '.com'))
                             when s_acctbal < 1500 then array('localhost')
                             when s_acctbal < 2000 then array(string(null))
                             else array({own}) end) as domain""",
        )

    @property
    def wanted_domains(self) -> DataFrame:
        """Names to look up among the vertices: the parts' brands, and nations nobody has."""
        brands = self.table("part").selectExpr(
            "concat(lower(translate(p_brand, '#', '')), '.com') as domain"
        )
        nations = self.table("nation").selectExpr(
            "concat(lower(translate(n_name, ' ', '-')), '.com') as domain"
        )
        return brands.distinct().unionByName(nations).distinct()

    # --- graph ------------------------------------------------------------------------------

    @property
    def vertices(self) -> DataFrame:
        sites = self.table("part").selectExpr(
            f"p_partkey + {SITE_NODE_BASE} as node_id",
            "concat('com.site', p_partkey) as reversed_domain",
            "int(1 + p_size % 5) as num_hosts",
        )
        unranked = self.table("customer").selectExpr(
            f"c_custkey + {CUSTOMER_NODE_BASE} as node_id",
            "concat('com.cust', c_custkey) as reversed_domain",
            "int(1 + c_nationkey % 3) as num_hosts",
        )
        linked = self.table("supplier").selectExpr(f"1 + s_suppkey % {BRANDS} as node_id")
        named = self.table("part").selectExpr("bigint(substring_index(p_brand, '#', -1)) as node_id")
        brands = (
            linked.distinct()
            .unionByName(named.distinct())
            .distinct()
            .selectExpr("node_id", "concat('com.brand', node_id) as reversed_domain", "9 as num_hosts")
        )
        return sites.unionByName(unranked).unionByName(brands)

    @property
    def named_vertices(self) -> DataFrame:
        return self.vertices.selectExpr("*", f"{reverse_labels('reversed_domain')} as domain")

    @property
    def edges(self) -> DataFrame:
        of_sites = self.table("lineitem").selectExpr(
            f"l_partkey + {SITE_NODE_BASE} as source_node_id",
            f"1 + l_suppkey % {BRANDS} as target_node_id",
        )
        of_customers = self.table("orders").selectExpr(
            f"o_custkey + {CUSTOMER_NODE_BASE} as source_node_id",
            f"1 + o_orderkey % {BRANDS} as target_node_id",
        )
        return of_sites.unionByName(of_customers)

    @property
    def site_ranks(self) -> DataFrame:
        """Rank of every part's site, 1 to 1.5 million and skewed to the front, from its size and price."""
        return (
            self.table("part")
            .selectExpr(
                "p_partkey",
                "p_type",
                "(p_size - 1) * 1000 + bigint(round(p_retailprice * 10 - 9000)) as x",
            )
            .selectExpr("p_partkey", "p_type", "int(1 + (x * x * 6) div 10000) as rank_position")
        )

    @property
    def rank_lines(self) -> DataFrame:
        return self.site_ranks.selectExpr(
            "rank_position as harmonic_position",
            "1000000D / rank_position as harmonic_value",
            "rank_position as pagerank_position",
            "1D / rank_position as pagerank",
            "concat('com.site', p_partkey) as reversed_domain",
            "3 as num_hosts",
        )

    @property
    def named_ranks(self) -> DataFrame:
        return self.rank_lines.selectExpr("*", f"{reverse_labels('reversed_domain')} as domain")

    @property
    def graph_edges(self) -> DataFrame:
        """Named links with release: mixed-case names, missing weights, bucket '' when unranked."""
        ranks = self.site_ranks.selectExpr(
            "p_partkey as l_partkey", f"{rank_bucket('rank_position')} as bucket"
        )
        release = "if({} < timestamp_ntz '" + SECOND_RELEASE_FROM + "', '{}', '{}') as graph_release_id"
        of_sites = self.table("lineitem").join(ranks, "l_partkey", "left").selectExpr(
            release.format("l_shipdate", *RELEASES),
            "concat(if(l_linenumber = 1, 'SITE', 'site'), l_partkey, '.com') as source_domain",
            f"concat('brand', 1 + l_suppkey % {BRANDS}, '.com') as target_domain",
            "nullif(l_linenumber, 7) as edge_weight",
            "bucket as source_domain_rank_bucket",
        )
        of_customers = self.table("orders").selectExpr(
            release.format("o_orderdate", *RELEASES),
            "concat('cust', o_custkey, '.com') as source_domain",
            f"concat('brand', 1 + o_orderkey % {BRANDS}, '.com') as target_domain",
            "int(1 + o_orderkey % 4) as edge_weight",
            "'' as source_domain_rank_bucket",
        )
        return of_sites.unionByName(of_customers)

    @property
    def delivered_edges(self) -> DataFrame:
        """The same links as URLs, with names nobody can resolve and weights out of range."""
        return self.graph_edges.selectExpr(
            "graph_release_id",
            "if(edge_weight is null, 'localhost', concat('https://www.', source_domain, '/post?id=1')) as source_domain",
            "concat(' WWW.', target_domain, ':443/ ') as target_domain",
            "case edge_weight when 6 then -1 when 5 then null else edge_weight end as edge_weight",
            "if(source_domain_rank_bucket = '', 'unlisted', source_domain_rank_bucket) as source_domain_rank_bucket",
        )

    @property
    def ranks(self) -> DataFrame:
        """Rank records of both releases, with copies in other case, empty ones and hosts."""
        bucket, name = rank_bucket("rank_position"), "concat('site', p_partkey, '.com')"

        def record(release, kind, entity, position, centrality, pagerank, bucket, loaded) -> str:
            return (
                f"named_struct('graph_release_id', '{release}', 'rank_entity_type', '{kind}', "
                f"'domain_or_host', {entity}, 'rank_position', int({position}), "
                f"'harmonic_centrality', double({centrality}), 'pagerank', double({pagerank}), "
                f"'rank_bucket', string({bucket}), 'loaded_at', timestamp '{loaded}')"
            )

        def only(kind: str, record: str) -> str:
            return f"if(p_type = '{kind}', {record}, null)"

        values = ("rank_position", "1000000D / rank_position", "1D / rank_position", bucket)
        records = [record(r, "domain", name, *values, LOADED_AT) for r in RELEASES]
        copy = ("rank_position + 5", "1", "0.5", "'long_tail'", "2026-01-02 00:00:00")
        records.append(only("PROMO", record("rel-a", "domain", f"upper({name})", *copy)))
        empty = ("null", "null", "null", "null", "2026-01-03 00:00:00")
        records.append(only("ECONOMY", record("rel-a", "domain", name, *empty)))
        of_host = ("rank_position", "2", "0.25", bucket, LOADED_AT)
        records.append(only("LARGE", record("rel-a", "host", f"concat('blog.', {name})", *of_host)))
        return self.site_ranks.selectExpr(f"inline(array_compact(array({', '.join(records)})))")

    @property
    def delivered_ranks(self) -> DataFrame:
        """Rank records with names as URLs and values out of range for some."""
        broken = "rank_position between 1000 and 20000"
        return self.ranks.selectExpr(
            "graph_release_id",
            "if(rank_position between 200000 and 300000, 'page', rank_entity_type) as rank_entity_type",
            "concat('HTTPS://user@', domain_or_host, ':8080/x#y') as domain_or_host",
            f"if({broken}, 0, rank_position) as rank_position",
            f"if({broken}, -1D, harmonic_centrality) as harmonic_centrality",
            "pagerank",
            "rank_bucket",
        )

    # --- evidence ---------------------------------------------------------------------------

    @property
    def evidence(self) -> DataFrame:
        """One row per `<a>` of a page; two pages belong to one site."""
        page = self.table("pages").selectExpr(
            "page_id",
            "page_id div 2 as site",
            "regexp_extract(url, '^[a-z]+://[^/]*(.*)$', 1) as path",
            "regexp_extract(html, 'lang=\"([a-z]+)\"', 1) as lang",
            "regexp_extract(html, '<title>([^<]*)</title>', 1) as title",
            "posexplode(regexp_extract_all(html, '<a href=\"([^\"]*)\">[^<]*</a>', 1)) as (i, href)",
        )
        row = page.selectExpr(
            "*",
            "page_id + i as number",
            "concat(if(page_id % 2 = 0, 'www', 'blog'), '.site', site, '.com') as host",
            "1 + (page_id + i) % 12 as brand",
        )
        phrase = f"get(array({sql_list(ANCHORS)}), int(number % {len(ANCHORS)}))"
        return row.selectExpr(
            "'crawl-a' as crawl_id",
            "concat('crawl-data/part-', page_id % 16, '.wat.gz') as wat_file_path",
            "if(lang <> 'es', concat('record-', page_id), null) as warc_record_id",
            "concat('https://', host, path) as source_url",
            "concat('SITE', site, '.com') as source_domain",
            "host as source_host",
            "concat('https://brand', brand, '.com', href) as target_url",
            "concat('brand', brand, '.com') as target_domain",
            "concat('B', brand) as target_company",
            f"case when lang = 'en' then concat({phrase}, ' ', substring_index(href, '/', -1)) "
            "when lang <> 'de' then 'more words' end as anchor_text",
            "case number % 5 when 0 then 'noopener NoFollow' when 1 then 'noopener' end as rel",
            "false as is_nofollow",
            "if(lang <> 'fr', title, null) as page_title",
            "lang as page_language",
            "if(number % 10 = 9, 404, 200) as http_status",
            "'text/html' as content_type",
            f"timestamp '{LOADED_AT}' as extracted_at",
        )

    @property
    def delivered_evidence(self) -> DataFrame:
        """Evidence as delivered: some rows disagree with their URLs or are out of range."""
        changed = {
            "source_url": "if(page_language = 'es', concat('/', source_host), concat('  ', source_url, '\n'))",
            "source_host": "upper(source_host)",
            "target_domain": "if(page_language = 'de', 'other.com', target_domain)",
            "http_status": "if(http_status = 404, 99, http_status)",
            "anchor_text": "concat(' ', anchor_text, '\t')",
        }
        return self.evidence.selectExpr(
            "crawl_id", *[f"{changed.get(c, c)} as {c}" for c in EVIDENCE_COLUMNS]
        )

    # --- loaded and staged ------------------------------------------------------------------

    @property
    def raw_edges(self) -> DataFrame:
        return load.load_graph_edges(
            self.graph_edges,
            self.company_frame,
            self.settings.release.high_authority_buckets,
            self.loaded_at,
        )

    @property
    def raw_ranks(self) -> DataFrame:
        return self.ranks

    @property
    def rank_text(self) -> DataFrame:
        """Rank records as text, with marks instead of numbers for some and '' for no bucket."""
        return self.ranks.selectExpr(
            "graph_release_id",
            "rank_entity_type",
            "domain_or_host",
            "if(rank_position < 1000, 'n/a', string(rank_position)) as rank_position",
            "string(harmonic_centrality) as harmonic_centrality",
            "if(rank_position > 1000000, '-', string(pagerank)) as pagerank",
            "coalesce(rank_bucket, '') as rank_bucket",
        )

    # --- names ------------------------------------------------------------------------------

    @property
    def names(self) -> DataFrame:
        """Every page URL in several spellings, some of which have no host or no owner."""
        spellings = (
            "url",
            "concat(' \t', upper(host), '\n')",
            "concat('ftp://user:pw@', host, ':8080?q=http://x.org')",
            "concat(host, '/see?next=https://brand1.com')",
            r"regexp_replace(host, r'example\.com$', 'co.uk')",
            r"regexp_replace(host, r'example\.net$', 'kawasaki.jp')",
            r"regexp_replace(host, r'example\.org$', 'city.kawasaki.jp')",
            r"regexp_replace(host, r'example\.[a-z]+$', 'internal')",
            "concat('https://', substring_index(host, '.', -2), '.')",
            "substring_index(host, '.', -1)",
            "concat('/pages/', page_id)",
            "concat('10.0.0.', page_id % 256)",
            "concat('www.brand', 1 + page_id % 20, '.com')",
            "concat('my_shop.', host)",
            "'  '",
        )
        hosts = self.table("pages").selectExpr(
            "page_id", "url", "regexp_extract(url, '^[a-z]+://([^/]*)', 1) as host"
        )
        return hosts.selectExpr(
            "page_id", f"posexplode(array({', '.join(spellings)})) as (spelling, name)"
        )
