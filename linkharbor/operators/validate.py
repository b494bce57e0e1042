"""Record rules. Every row gets the list of rules it breaks, then splits into valid and rejected."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkharbor.config import ROLES, sql_list, sql_text
from linkharbor.functions.hosts import absolute_url, normalize_host
from linkharbor.functions.suffixes import SuffixRules, registered_domain
from linkharbor.functions.text import clean_text, infer_nofollow
from linkharbor.sources.records import ENTITY_TYPES, OPTIONAL_EVIDENCE_TEXT

FAILED = "failed_rules"


@dataclass(frozen=True)
class Checked:
    """Rows with their broken rules; `valid` and `rejected` are two filters over the same plan."""

    rows: DataFrame

    @property
    def valid(self) -> DataFrame:
        return self.rows.filter(f"size({FAILED}) = 0").drop(FAILED)

    @property
    def rejected(self) -> DataFrame:
        return self.rows.filter(f"size({FAILED}) > 0")

    def strict(self) -> DataFrame:
        """All rows, or an error at the first row that breaks a rule."""
        problem = f"raise_error(concat('record breaks: ', array_join({FAILED}, ', ')))"
        return self.rows.filter(f"if(size({FAILED}) = 0, true, {problem})").drop(FAILED)


def validate_edge_inputs(edges: DataFrame, rules: SuffixRules) -> Checked:
    """Delivered edges before they are mapped to companies."""
    return _checked(
        _both_registered(edges, rules),
        {
            "source_domain": "__source is not null",
            "target_domain": "__target is not null",
            "edge_weight": "edge_weight is null or edge_weight >= 0",
        },
        {"source_domain": "__source", "target_domain": "__target"},
        edges.columns,
    )


def validate_edges(edges: DataFrame, rules: SuffixRules) -> Checked:
    """Raw edges; both domains become registered domains."""
    return _checked(
        _both_registered(edges, rules),
        {
            "graph_release_id": "length(graph_release_id) > 0",
            "source_domain": "__source is not null",
            "target_domain": "__target is not null",
            "target_company": "length(target_company) > 0",
            "target_segment": "length(target_segment) > 0",
            "edge_weight": "edge_weight is null or edge_weight >= 0",
        },
        {"source_domain": "__source", "target_domain": "__target"},
        edges.columns,
    )


def _both_registered(edges: DataFrame, rules: SuffixRules) -> DataFrame:
    out = registered_domain(edges, "source_domain", "__source", rules)
    return registered_domain(out, "target_domain", "__target", rules)


def validate_ranks(ranks: DataFrame, rules: SuffixRules) -> Checked:
    """Raw ranks; the name becomes a host for host rows and a registered domain for others."""
    return _checked(
        rank_entity(ranks, rules, "__entity"),
        {
            "graph_release_id": "length(graph_release_id) > 0",
            "rank_entity_type": f"rank_entity_type in ({sql_list(ENTITY_TYPES)})",
            "domain_or_host": "__entity is not null",
            "rank_position": "rank_position is null or rank_position >= 1",
            "harmonic_centrality": "harmonic_centrality is null or harmonic_centrality >= 0",
            "pagerank": "pagerank is null or pagerank >= 0",
        },
        {"domain_or_host": "__entity"},
        ranks.columns,
    )


def rank_entity(ranks: DataFrame, rules: SuffixRules, output: str) -> DataFrame:
    out = registered_domain(ranks, "domain_or_host", "__registered", rules)
    host = normalize_host("domain_or_host")
    name = F.expr(f"if(rank_entity_type = 'host', {host}, __registered)")
    return out.withColumn(output, name).drop("__registered")


def validate_evidence(evidence: DataFrame, rules: SuffixRules) -> Checked:
    """Page link evidence; names are normalized and must agree with the URLs they come from."""
    out = evidence
    for value in ("source_domain", "target_domain", "source_url", "target_url"):
        out = registered_domain(out, value, f"__{value}", rules)
    host = normalize_host("source_host")
    values = {
        "source_url": absolute_url("source_url"),
        "target_url": absolute_url("target_url"),
        "source_domain": "__source_domain",
        "target_domain": "__target_domain",
        "source_host": host,
        "is_nofollow": infer_nofollow("is_nofollow", "rel"),
    }
    return _checked(
        out,
        {
            "crawl_id": "length(crawl_id) > 0",
            "wat_file_path": "length(wat_file_path) > 0",
            "source_url": f"{absolute_url('source_url')} is not null",
            "target_url": f"{absolute_url('target_url')} is not null",
            "source_host": f"{host} = {normalize_host('source_url')}",
            "source_domain": "__source_domain = __source_url",
            "target_domain": "__target_domain = __target_url",
            "target_company": "length(target_company) > 0",
            "http_status": "http_status is null or http_status between 100 and 599",
        },
        values,
        evidence.columns,
        OPTIONAL_EVIDENCE_TEXT,
    )


def validate_companies(companies: DataFrame, rules: SuffixRules) -> DataFrame:
    """Broken rules of a company list as rows (rule, company, detail); empty when it is sound.

    Takes one row per company and domain, with a null domain for a company without any.
    """
    out = registered_domain(companies, "domain", "__name", rules)
    broken = ", ".join(
        f"if({test}, {sql_text(rule)}, null)"
        for rule, test in (
            ("role_valid", f"bool_or(coalesce(role not in ({sql_list(ROLES)}), true))"),
            ("has_domain", "count(domain) = 0"),
            ("domain_resolves", "count_if(domain is not null and __name is null) > 0"),
        )
    )
    per_company = out.groupBy("company").agg(F.expr(f"array_compact(array({broken})) as rules"))
    company_rules = per_company.selectExpr(
        "explode(rules) as rule", "company", "string(null) as detail"
    )
    # One row per (domain, company) first: a domain held by many companies then counts cheaply.
    holders = out.filter("__name is not null").groupBy("__name", "company").agg(
        F.expr("count(*) as times")
    )
    within = holders.filter("times > 1").selectExpr(
        "'unique_in_company' as rule", "company", "__name as detail"
    )
    across = (
        holders.groupBy("__name")
        .agg(F.expr("count(*) as holders"))
        .filter("holders > 1")
        .selectExpr(
            "'unique_across_companies' as rule", "string(null) as company", "__name as detail"
        )
    )
    targets = (
        companies.filter("role = 'target'")
        .agg(F.expr("count(distinct company) as n"))
        .filter("n <> 1")
        .selectExpr(
            "'exactly_one_target' as rule", "string(null) as company", "string(n) as detail"
        )
    )
    return company_rules.unionByName(within).unionByName(across).unionByName(targets)


def company_for_domain(
    names: DataFrame, value: str, companies: DataFrame, rules: SuffixRules
) -> DataFrame:
    """Add company and segment of a name's registered domain; null where nobody owns it."""
    owners = companies.selectExpr(
        "domain as registered_domain", "company as target_company", "segment as target_segment"
    )
    out = registered_domain(names, value, "registered_domain", rules)
    joined = out.join(owners, "registered_domain", "left")
    return joined.select(*out.columns, "target_company", "target_segment")


def _checked(
    df: DataFrame,
    rules: dict[str, str],
    values: dict[str, str],
    columns: list[str],
    cleaned: tuple[str, ...] = (),
) -> Checked:
    """Normalized values, raw where that failed, and the names of the rules that do not hold."""
    broken = ", ".join(
        f"if(coalesce({test}, false), null, {sql_text(name)})" for name, test in rules.items()
    )
    out = {c: f"coalesce({values[c]}, {c})" if c in values else c for c in columns}
    out |= {c: clean_text(c) for c in cleaned}
    return Checked(
        df.selectExpr(
            *[f"{value} as {c}" for c, value in out.items()],
            f"array_compact(array({broken})) as {FAILED}",
        )
    )
