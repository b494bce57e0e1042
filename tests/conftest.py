from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from linkharbor.config import CompanySet, ReleaseSettings, Settings  # noqa: E402
from linkharbor.functions.suffixes import rules_from_list  # noqa: E402
from linkharbor.session import build_session, delete_run_folders  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    delete_run_folders(session)
    session.stop()


SUFFIXES = ("com", "org", "net", "io", "co", "tech", "uk", "co.uk", "jp", "*.kawasaki.jp", "!city.kawasaki.jp", "*.ck", "!www.ck")


@pytest.fixture(scope="session")
def rules(spark):
    return rules_from_list(spark, SUFFIXES)


@pytest.fixture(scope="session")
def companies() -> CompanySet:
    return CompanySet.from_items(
        [
            {"company": "Own", "role": "target", "segment": "target", "domains": ["own.co"]},
            {
                "company": "Near",
                "role": "competitor",
                "segment": "direct_modern_bi",
                "priority": "strong",
                "domains": ["near.com", "near.io"],
            },
            {
                "company": "Side One",
                "role": "competitor",
                "segment": "direct_modern_bi",
                "priority": "secondary",
                "domains": ["side.com"],
            },
            {"company": "Far", "role": "competitor", "segment": "enterprise_incumbent", "domains": ["far.com"]},
        ]
    )


@pytest.fixture(scope="session")
def settings(companies) -> Settings:
    return Settings(companies, ReleaseSettings("rel-1", "crawl-1"))


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def write_lines(path: Path, *lines: str) -> str:
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)
