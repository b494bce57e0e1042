"""Companies, release settings and scoring settings.

Everything a run decides by configuration lives here: who the target is, which competitors are
tracked, how segments and rank buckets weigh in the score, and which words mark a page.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkharbor.session import MAX_BROADCAST_ROWS

TARGET, COMPETITOR = "target", "competitor"
ROLES = (TARGET, COMPETITOR)

COMPANY_SCHEMA = T.StructType(
    [
        T.StructField("company", T.StringType()),
        T.StructField("role", T.StringType()),
        T.StructField("segment", T.StringType()),
        T.StructField("priority", T.StringType()),
        T.StructField("domain", T.StringType()),
    ]
)

# Rank buckets from best to worst, with the last position of each.
RANK_BUCKETS = ("top_10k", "top_100k", "top_1m", "long_tail")
RANK_BUCKET_LIMITS = (10_000, 100_000, 1_000_000)


@dataclass(frozen=True)
class Company:
    company: str
    role: str
    segment: str
    domains: tuple[str, ...]
    priority: str = "none"  # strong | secondary | none, used by the segment signal


@dataclass(frozen=True)
class CompanySet:
    companies: tuple[Company, ...]

    def __post_init__(self) -> None:
        problems = self.problems()
        if problems:
            raise ValueError("; ".join(problems))

    def problems(self) -> list[str]:
        found = [f"unknown role {c.role!r} of {c.company}" for c in self.companies if c.role not in ROLES]
        found += [f"{c.company} has no domain" for c in self.companies if not c.domains]
        if sum(c.role == TARGET for c in self.companies) != 1:
            found.append("exactly one target company is needed")
        domains = [d for c in self.companies for d in c.domains]
        found += [f"domain {d} is used twice" for d in sorted({d for d in domains if domains.count(d) > 1})]
        plain = re.compile(r"[^\s/:?#@A-Z]+\.[^\s/:?#@A-Z]+")
        found += [f"{d!r} is no plain domain; resolve the list first" for d in domains if not plain.fullmatch(d) or d.startswith("www.")]
        slugs = [slug(c.company) for c in self.companies]
        found += [f"companies share the column name {s}" for s in sorted({s for s in slugs if slugs.count(s) > 1})]
        return found

    @property
    def target(self) -> Company:
        return next(c for c in self.companies if c.role == TARGET)

    @property
    def competitors(self) -> tuple[Company, ...]:
        return tuple(c for c in self.companies if c.role == COMPETITOR)

    @property
    def domains(self) -> list[str]:
        return [d for c in self.companies for d in c.domains]

    def prioritized(self, priority: str) -> list[str]:
        return [c.company for c in self.companies if c.priority == priority]

    def link_column(self, company: str) -> str:
        return f"links_to_{slug(company)}"

    @property
    def target_link_column(self) -> str:
        return self.link_column(self.target.company)

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row per company domain; broadcast while the configured list is short."""
        rows = [(c.company, c.role, c.segment, c.priority, d) for c in self.companies for d in c.domains]
        df = literal_rows(spark, rows, COMPANY_SCHEMA)
        return F.broadcast(df) if len(rows) <= MAX_BROADCAST_ROWS else df

    @classmethod
    def from_items(cls, items: Iterable[Mapping[str, object]]) -> CompanySet:
        return cls(
            tuple(
                Company(
                    company=str(i["company"]),
                    role=str(i["role"]),
                    segment=str(i["segment"]),
                    domains=tuple(str(d).strip().lower() for d in i["domains"]),
                    priority=str(i.get("priority", "none")),
                )
                for i in items
            )
        )

    @classmethod
    def load(cls, path: str) -> CompanySet:
        """Read `{"companies": [...]}`, with registered domains, from a JSON or YAML file.

        Where URLs or host names may be listed, use `sources.companies.load_companies`.
        """
        return cls.from_items(load_mapping(path)["companies"])


@dataclass(frozen=True)
class ReleaseSettings:
    graph_release_id: str
    crawl_id: str
    high_authority_buckets: tuple[str, ...] = ("top_10k", "top_100k")
    max_enrichment_domains: int = 500

    def __post_init__(self) -> None:
        if not self.graph_release_id or not self.crawl_id:
            raise ValueError("graph_release_id and crawl_id must not be empty")
        if not self.high_authority_buckets:
            raise ValueError("at least one high-authority bucket is needed")
        if len(set(self.high_authority_buckets)) != len(self.high_authority_buckets):
            raise ValueError("high-authority buckets must be unique")
        if self.max_enrichment_domains <= 0:
            raise ValueError("max_enrichment_domains must be positive")

    @classmethod
    def load(cls, path: str) -> ReleaseSettings:
        raw = load_mapping(path)
        return cls(
            graph_release_id=str(raw["graph_release_id"]),
            crawl_id=str(raw["crawl_id"]),
            high_authority_buckets=tuple(str(b) for b in raw["high_authority_rank_buckets"]),
            max_enrichment_domains=int(raw["max_wat_enrichment_domains"]),
        )


@dataclass(frozen=True)
class ScoreSettings:
    """Fixed values of the opportunity score; they must stay as they are for equal scores."""

    # Points of each signal, 100 in all.
    coverage_points: int = 30
    authority_points: int = 25
    segment_points: int = 15
    category_points: int = 15
    evidence_points: int = 10
    clean_points: int = 5

    # Competitors, and category matches, at which a signal is full.
    full_coverage: float = 4.0
    full_category: float = 2.0

    # Signal value of the best rank bucket.
    authority: tuple[tuple[str, float], ...] = (
        ("top_10k", 1.0),
        ("top_100k", 0.85),
        ("top_1m", 0.45),
        ("long_tail", 0.15),
    )

    # Segment names, by the part they play in the segment signal.
    direct_segment: str = "direct_modern_bi"
    near_segments: tuple[str, ...] = ("analytics_workspace", "semantic_layer_adjacent")
    side_segments: tuple[str, ...] = ("oss_self_serve_bi", "data_app_adjacent")
    far_segments: tuple[str, ...] = ("enterprise_incumbent", "legacy_acquired")

    # Count columns of the matrix: segment -> column.
    segment_columns: tuple[tuple[str, str], ...] = (
        ("direct_modern_bi", "direct_competitor_count"),
        ("analytics_workspace", "analytics_workspace_competitor_count"),
        ("semantic_layer_adjacent", "semantic_layer_competitor_count"),
        ("oss_self_serve_bi", "oss_self_serve_competitor_count"),
        ("data_app_adjacent", "data_app_competitor_count"),
        ("enterprise_incumbent", "incumbent_competitor_count"),
        ("legacy_acquired", "legacy_acquired_competitor_count"),
    )

    # Link shorteners, spam words and the longest name that still counts as clean.
    shorteners: tuple[str, ...] = ("bit.ly", "t.co", "tinyurl.com", "goo.gl", "ow.ly")
    spam_words: tuple[str, ...] = (
        "casino", "coupon", "viagra", "porn", "xxx", "apk", "crack", "warez", "torrent",
    )
    longest_clean_name: int = 80

    # Words searched, unanchored, in the evidence text.
    category_words: tuple[str, ...] = (
        "bi", "analytics", "dashboard", "semantic layer", "dbt", "business intelligence",
        "embedded analytics", "data app", "looker alternative",
    )
    comparison_words: tuple[str, ...] = ("alternative", "vs", "compare", "comparison")
    partner_words: tuple[str, ...] = ("partner", "integration", "marketplace", "ecosystem")
    community_words: tuple[str, ...] = ("blog", "newsletter", "article", "post", "community")

    # Lowest score of each tier; anything lower is "monitor".
    tiers: tuple[tuple[str, float], ...] = (("tier_1", 75.0), ("tier_2", 50.0), ("tier_3", 25.0))
    lowest_tier: str = "monitor"

    # Company strength: points for referring domains, high-authority domains and link weight.
    strength_points: tuple[int, int, int] = (45, 35, 20)
    high_authority_position: int = 100_000

    def segment_column(self, segment: str) -> str:
        return dict(self.segment_columns)[segment]


@dataclass(frozen=True)
class Settings:
    companies: CompanySet
    release: ReleaseSettings = field(
        default_factory=lambda: ReleaseSettings("rel-a", "crawl-a")
    )
    score: ScoreSettings = field(default_factory=ScoreSettings)
    # The staged flag is never null, so the rank fallback of the flag is off unless asked for.
    flag_from_rank: bool = False


def slug(company: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", company.lower()).strip("_")


def sql_text(value: object) -> str:
    """A value as a SQL literal."""
    if value is None:
        return "null"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value).lower() if isinstance(value, bool) else repr(value)


def sql_list(values: Iterable[object]) -> str:
    return ", ".join(sql_text(v) for v in values)


def any_word(text: str, words: Iterable[str]) -> str:
    """True when one of the words occurs anywhere in the text.

    `contains` is a plain byte search inside generated code; no regular expression runs per row.
    """
    return "(" + " or ".join(f"contains({text}, {sql_text(w)})" for w in words) + ")"


def literal_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A small configured table as a local relation: no file, no task, and a size Spark knows."""
    if not rows:
        return spark.createDataFrame([], schema)
    cells = ", ".join(f"({sql_list(row)})" for row in rows)
    names = ", ".join(schema.names)
    typed = ", ".join(f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}" for f in schema.fields)
    return spark.sql(f"select {typed} from values {cells} as t({names})")


def load_mapping(path: str) -> Mapping:
    with open(path, encoding="utf-8") as handle:
        if path.endswith(".json"):
            return json.load(handle)
        try:
            import yaml
        except ImportError as error:
            raise RuntimeError("reading YAML settings needs pyyaml; use JSON instead") from error
        return yaml.safe_load(handle)
