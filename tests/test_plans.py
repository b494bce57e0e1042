"""Plans, not results: what is shuffled, broadcast and pushed down."""

from __future__ import annotations

import re

import pytest

from conftest import write_lines
from linkharbor.catalog.inputs import COMPANIES, Inputs
from linkharbor.catalog.queries import QUERIES
from linkharbor.config import CompanySet, ScoreSettings
from linkharbor.functions.suffixes import rules_from_file
from linkharbor.operators import extract, intermediate, load, marts, staging
from linkharbor.operators.validate import validate_evidence
from linkharbor.plans.extract_release import extract_release
from linkharbor.session import broadcast_if_small, materialize, shared_folder
from linkharbor.sources.records import OPTIONAL_EVIDENCE_TEXT

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def plan_of(spark):
    """Physical plan as chosen for large inputs: nothing is broadcast for being small on disk."""
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield lambda df: df._jdf.queryExecution().executedPlan().toString()
    for k, v in before.items():
        spark.conf.set(k, v)


LAZY = [
    k
    for k in QUERIES
    if not k.startswith(("scan_", "sink_", "load_counts", "load_raw", "checkpoint", "dq_suite"))
]


@pytest.mark.parametrize("key", LAZY)
def test_no_cross_join_no_python_no_unpartitioned_window(spark, plan_of, key):
    plan = plan_of(QUERIES[key](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan, operator
    if "Window " in plan:
        assert not re.search(r"Window \[.*\], \[\], ", plan)
    # one partition only for whole-table aggregates and sorted results
    assert plan.count("SinglePartition") <= 1 or key == "validate_companies"


def test_edges_are_filtered_where_they_are_read(spark, plan_of):
    i = Inputs(spark, FOLDER)
    targets = broadcast_if_small(
        materialize(extract.target_vertices(i.named_vertices, i.company_frame), "targets")
    )
    plan = plan_of(extract.edges_to_targets(i.edges, targets))
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in plan


def test_a_side_above_the_bound_is_not_broadcast(spark, plan_of):
    many = spark.range(50).selectExpr("id as node_id", "string(id) as domain")
    edges = spark.range(10).selectExpr("id as source_node_id", "id as target_node_id")
    assert "BroadcastHashJoin" in plan_of(extract.edges_to_targets(edges, broadcast_if_small(many)))
    large = plan_of(extract.edges_to_targets(edges, broadcast_if_small(many, max_rows=49)))
    assert "SortMergeJoin" in large


def test_links_are_shuffled_twice_and_never_again(spark, plan_of):
    """By link, to merge copies; by release and source, for the rank join and the matrix."""
    plan = plan_of(QUERIES["int_referring_domain_company"](spark, FOLDER))
    after_load = [
        line for line in plan.split("\n") if "Exchange hashpartitioning" in line and "l_partkey" not in line and "p_partkey" not in line
    ]
    assert len(after_load) == 3  # the third one brings the ranks
    assert plan.count("REPARTITION_BY_COL") == 1


def test_matrix_overlap_and_summary_read_one_row_of_numbers_per_domain(spark, plan_of):
    links = materialize(QUERIES["int_referring_domain_company"](spark, FOLDER), "links")
    sources = plan_of(intermediate.source_rows(links, COMPANIES))
    assert "SortAggregate" not in sources and "ObjectHashAggregate" not in sources
    assert sources.count("Exchange") == 1
    rows = materialize(intermediate.source_rows(links, COMPANIES), "sources")
    for df in (intermediate.overlap_from(rows, COMPANIES), marts.summary_from(rows, COMPANIES, ScoreSettings())):
        plan = plan_of(df)
        assert plan.count("Exchange") == 1 and "SortAggregate" not in plan


def test_few_buckets_of_the_stored_edges_are_read(spark, tmp_path):
    i = Inputs(spark, FOLDER)
    extract.store_edges(i.edges, str(tmp_path / "stored"))
    stored = spark.read.parquet(str(tmp_path / "stored"))
    targets = broadcast_if_small(materialize(extract.target_vertices(i.named_vertices, i.company_frame), "targets"))
    found = extract.edges_to_targets(stored, targets)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression(target_bucket" in plan.replace(" ", "")
    assert found.count() == extract.edges_to_targets(i.edges, targets).count()


def test_an_extraction_prunes_and_counts(spark, tmp_path, monkeypatch):
    i = Inputs(spark, FOLDER)
    extract.store_edges(i.edges, str(tmp_path / "stored"))
    stored = extract.stored_edges(spark, str(tmp_path / "stored"))
    plans, cut = [], extract.edges_to_targets

    def watched(edges, targets):
        plans.append(cut(edges, targets))
        return plans[-1]

    monkeypatch.setattr(extract, "edges_to_targets", watched)
    few = CompanySet.from_items(
        [
            {"company": "One", "role": "target", "segment": "target", "domains": ["brand1.com"]},
            {"company": "Two", "role": "competitor", "segment": "x", "domains": ["brand2.com"]},
        ]
    )
    for n, edges in enumerate((stored, stored.rows)):
        found = extract_release(spark, "r", i.named_vertices, edges, i.named_ranks, few, root=str(tmp_path / f"run{n}"))
        plan = plans[-1]._jdf.queryExecution().executedPlan().toString().replace(" ", "")
        assert "dynamicpruningexpression(target_bucket" in plan
        assert "CollectMetrics" not in plan
        read = stored.rows.where(f"{extract.BUCKET} in (select int({extract.bucket_of('x')}) from values (1L), (2L) t(x))").count()
        assert found.scanned_edges == read < i.edges.count()
        assert found.counts()["filtered_edges"] == i.edges.where("target_node_id in (1, 2)").count()


def test_delivered_links_merge_as_numbers_first(spark, plan_of):
    plan = plan_of(QUERIES["build_domain_edges"](spark, FOLDER))
    lowest = [line for line in plan.split("\n") if "Aggregate(" in line][-1]
    assert "HashAggregate" in lowest and "source_domain_rank_bucket" in lowest


def longest_method(df) -> int:
    """Bytes of the longest method generated for a plan."""
    stages = df._jdf.queryExecution().debug().codegenToSeq()
    return max(stages.apply(n)._3().maxMethodCodeSize() for n in range(stages.length()))


# Fixed value: a longer method stays interpreted by the JVM.
LONGEST_COMPILED = 8000


def test_names_of_delivered_links_resolve_in_loops_that_are_compiled(spark, plan_of, tmp_path):
    i = Inputs(spark, FOLDER)
    listed = write_lines(tmp_path / "list.dat", "com", "co.uk", "*.ck", "!www.ck", "x.c.zz", "a.b.c.zz", "*.f.a.b.c.zz")
    for rules in (i.rules, rules_from_file(spark, listed)):
        built = load.build_domain_edges(i.delivered_edges, i.company_frame, rules, ("top_10k",), i.loaded_at)
        assert longest_method(built) < LONGEST_COMPILED
        # One lookup a length and name, however often the name is filtered, joined and grouped by.
        assert plan_of(built).count("crc32(") == 2 * len(rules.kinds_of_length)


def test_copies_of_a_rank_are_dropped_before_the_shuffle(spark, plan_of):
    plan = plan_of(staging.stage_domain_ranks(Inputs(spark, FOLDER).raw_ranks))
    assert plan.count("WindowGroupLimit") == 2


def test_overlap_and_summary_need_no_self_join(spark, plan_of):
    for key in ("competitor_overlap", "company_summary"):
        plan = plan_of(QUERIES[key](spark, FOLDER))
        assert plan.count("FileScan") == 4, key  # line items, orders, and parts for buckets and ranks, each once


def test_filters_reach_the_scan(spark, plan_of):
    i = Inputs(spark, FOLDER)
    plan = plan_of(i.ranks.filter("rank_entity_type = 'host'"))
    assert "FileScan" in plan and "p_type" in plan
    plan = plan_of(i.graph_edges.filter("graph_release_id = 'rel-a' and edge_weight = 3"))
    assert re.search(r"PushedFilters: \[.*l_linenumber", plan)


def test_shared_folder_is_the_one_the_cluster_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_one_rule_table_serves_all_names_of_a_record(spark, plan_of, tmp_path):
    listed = write_lines(tmp_path / "list.dat", "com", "co.uk", "*.ck", "!www.ck", "a.b.c.zz")
    rules = rules_from_file(spark, listed)
    df = spark.read.parquet(f"{FOLDER}/nation.parquet").selectExpr(
        "'c' as crawl_id", "'f' as wat_file_path", "n_name as source_url", "string(n_nationkey) as target_url", "n_name as source_host",
        "n_name as source_domain", "string(n_nationkey) as target_domain", "'t' as target_company", "200 as http_status",
        "false as is_nofollow", "'' as rel", *[f"'' as {c}" for c in OPTIONAL_EVIDENCE_TEXT if c != "rel"],
    )
    plan = plan_of(validate_evidence(df, rules).rows)
    assert plan.count("BroadcastHashJoin") == 4  # one a name, whatever the lengths of the rules
    assert plan.count("- BroadcastExchange") == 1
    assert plan.count("ReusedExchange") == 3
    assert "Exchange hashpartitioning" not in plan
