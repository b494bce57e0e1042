"""Company lists as tables: one row per company and domain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkharbor.config import CompanySet, load_mapping
from linkharbor.functions.suffixes import SuffixRules, resolved_companies


def load_companies(spark: SparkSession, path: str, rules: SuffixRules) -> CompanySet:
    """The configured companies of a file, their domains resolved to registered domains."""
    return resolved_companies(spark, load_mapping(path)["companies"], rules)


def read_companies_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(
        "company string, role string, segment string, domain string"
    ).csv(path)


def read_companies_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of `{company, role, segment, domains: [...]}`, domains flattened to rows."""
    nested = spark.read.schema(
        "company string, role string, segment string, domains array<string>"
    ).json(path)
    return flatten_domains(nested)


def flatten_domains(nested: DataFrame) -> DataFrame:
    return nested.select(
        "company", "role", "segment", F.explode("domains").alias("domain")
    )
