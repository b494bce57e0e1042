from __future__ import annotations

import dataclasses
import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from conftest import rows, write_lines
from linkharbor.config import CompanySet, ReleaseSettings
from linkharbor.operators import extract, load, sinks, snapshots, validate
from linkharbor.plans.extract_release import extract_release
from linkharbor.plans.load_release import EDGES, EVIDENCE, RANKS, load_delivered, load_extracted
from linkharbor.sources import records, webgraph

HIGH = ("top_10k", "top_100k")

TWO = CompanySet.from_items(
    [
        {"company": "Lakes", "role": "target", "segment": "target", "domains": ["lakes.org"]},
        {"company": "River", "role": "competitor", "segment": "enterprise_incumbent", "domains": ["river.io", "river.co.uk"]},
    ]
)


@pytest.fixture
def loaded(spark):
    return F.expr("timestamp '2026-01-01 00:00:00'")


@pytest.fixture
def graph(spark, tmp_path):
    """Three tracked nodes, four linkers: one without rank, one that links to two tracked nodes, one
    that has no vertex, and one whose rank comes twice."""
    vertices = write_lines(
        tmp_path / "vertices.txt",
        "500\torg.lakes\t44",
        "501\tio.river\t3",
        "502\tuk.co.river\t3",
        "7\tnet.delta\t1",
        "8\tnet.coast.north\t6",
        "9\tnet.harbour\t2",
        "10\tnet.silent\t2",
    )
    edges = write_lines(
        tmp_path / "edges.txt", "7\t500", "7\t502", "8\t501", "9\t501", "9\t10", "10\t9", "77\t500", "500\t501"
    )
    ranks = write_lines(
        tmp_path / "ranks.txt",
        "#harmonicc_pos\t#harmonicc_val\t#pr_pos\t#pr_val\t#host_rev\t#n_hosts",  # fixed value: the file's first line
        "100001\t5.5\t12\t0.5\tnet.delta\t1",
        "10000\t9.25\t13\t0.25\tnet.coast.north\t6",
        "2000000\t0.5\t14\t0.125\tnet.coast.north\t6",
        "1\t99.0\t1\t0.75\tnet.silent\t2",
    )
    return (
        webgraph.scan_vertices(spark, vertices).rows,
        webgraph.scan_edges(spark, edges).rows,
        webgraph.scan_ranks(spark, ranks).rows,
    )


NAMED = [
    ("delta.net", "lakes.org", 1, "top_1m"),
    ("delta.net", "river.co.uk", 1, "top_1m"),
    ("harbour.net", "river.io", 1, None),
    ("lakes.org", "river.io", 1, None),
    ("north.coast.net", "river.io", 1, "top_10k"),
]


def test_extract_release(spark, graph, tmp_path):
    root = str(tmp_path / "stages")
    found = extract_release(spark, "rel-1", *graph, TWO, root=root)
    assert found.counts() == {
        "scanned_edges": 8,
        "target_vertices": 3,
        "filtered_edges": 6,
        "source_vertices": 4,
        "domain_ranks": 3,
        "graph_edges": 5,
    }
    assert rows(found.frame("graph_edges")) == NAMED
    assert not any(s.reused for s in found.stages.values())
    again = extract_release(spark, "rel-1", *graph, TWO, root=root)
    assert all(s.reused for s in again.stages.values())
    assert again.counts() == found.counts()
    assert rows(again.frame("graph_edges")) == NAMED


def test_changed_inputs_do_not_reuse_stages(spark, graph, tmp_path):
    root = str(tmp_path / "stages")
    extract_release(spark, "rel-1", *graph, TWO, root=root)
    with (tmp_path / "edges.txt").open("a") as file:
        file.write("10\t500\n")
    vertices, _, ranks = graph
    edges = webgraph.scan_edges(spark, str(tmp_path / "edges.txt")).rows
    more = extract_release(spark, "rel-1", vertices, edges, ranks, TWO, root=root)
    assert not any(s.reused for s in more.stages.values())
    assert more.counts()["graph_edges"] == 6


def test_input_marks_follow_the_files_that_are_read(spark, tmp_path):
    folder = tmp_path / "odd name%20"
    folder.mkdir()
    for name in ("a b[1].txt", "c{d}.txt", "100%.txt", "q?.txt"):
        (folder / name).write_text("1\n")

    whole = lambda: sinks.input_mark(spark.read.text(str(folder)))
    first = whole()
    assert first.startswith("4 8 ") and whole() == first
    beside = tmp_path / "beside.txt"
    beside.write_text("2\n")  # a file that the frame does not read
    assert whole() == first
    (folder / "q?.txt").write_text("2\n")
    stat = (folder / "q?.txt").stat()
    os.utime(folder / "q?.txt", (stat.st_atime, stat.st_mtime + 5))
    replaced = whole()
    assert replaced != first and replaced.startswith("4 8 ")
    (folder / "q?.txt").unlink()
    assert whole() not in (first, replaced)
    assert sinks.input_mark(spark.range(3)) == ""


def test_marks_of_many_files_take_one_listing(spark, tmp_path):
    for n in range(10_000):
        (tmp_path / f"part-{n}").write_text(str(n))
    df = spark.read.text(str(tmp_path))
    started = time.perf_counter()
    assert sinks.input_mark(df).startswith("10000 ")
    assert time.perf_counter() - started < 60


def test_a_rebuilt_stage_invalidates_the_later_ones(spark, tmp_path):
    def run(second):
        folder = sinks.StageFolder(spark, str(tmp_path), "rel", "config")
        one = folder.stage("one", lambda: spark.range(2).toDF("n"))
        return folder, one, folder.stage("two", lambda: spark.range(second).toDF("n"))

    folder, _, _ = run(3)
    assert [s.reused for s in run(4)[1:]] == [True, True]
    shutil.rmtree(f"{folder.path}/one/manifest")
    _, one, two = run(4)
    assert (one.reused, two.reused, two.rows) == (False, False, 4)


def test_stored_edges_give_the_same(spark, graph, tmp_path):
    vertices, edges, _ = graph
    extract.store_edges(edges, str(tmp_path / "stored"))
    targets = extract.target_vertices(vertices, TWO.frame(spark))
    stored = spark.read.parquet(str(tmp_path / "stored"))
    assert rows(extract.edges_to_targets(stored, targets)) == rows(extract.edges_to_targets(edges, targets))


def test_a_changed_configuration_does_not_reuse_stages(spark, graph, tmp_path):
    root = str(tmp_path / "stages")
    extract_release(spark, "rel-1", *graph, TWO, root=root)
    only_own = CompanySet(TWO.companies[:1])
    other = extract_release(spark, "rel-1", *graph, only_own, root=root)
    assert not any(s.reused for s in other.stages.values())
    assert other.stages["filtered_edges"].rows == 2  # one linker has no vertex


def test_a_stage_without_manifest_is_built_again(spark, tmp_path):
    folder = sinks.StageFolder(spark, str(tmp_path), "rel", "config")
    spark.range(3).write.parquet(f"{folder.path}/numbers/data")  # what a killed run leaves behind
    stage = folder.stage("numbers", lambda: spark.range(5).toDF("n"))
    assert (stage.reused, stage.rows) == (False, 5)
    assert folder.stage("numbers", lambda: spark.range(9).toDF("n")).rows == 5


def test_missing_targets_stop_the_extraction(spark, graph, tmp_path):
    """All of them are named, however many."""
    names = [f"gone{n:02d}.org" for n in range(30)]
    gone = dataclasses.replace(TWO.companies[1], company="Gone", domains=tuple(reversed(names)))
    with pytest.raises(ValueError, match="30 target domains missing from the vertices") as error:
        extract_release(spark, "rel-1", *graph, CompanySet((*TWO.companies, gone)), root=str(tmp_path / "s"))
    assert str(names) in str(error.value)


def test_edge_inputs_drop_unknown_ends(spark, graph):
    vertices, edges, _ = graph
    targets = extract.target_vertices(vertices, TWO.frame(spark))
    kept = extract.edges_to_targets(edges, targets)
    assert kept.count() == 6
    named = extract.edge_inputs(kept, extract.source_vertices(vertices, kept), targets)
    assert rows(named) == [r[:3] for r in NAMED]


def delivered(spark, *rows):
    return spark.createDataFrame(
        [("rel-1", *r) for r in rows],
        "graph_release_id string, source_domain string, target_domain string, edge_weight int, "
        "source_domain_rank_bucket string",
    )


def test_build_domain_edges(spark, companies, rules, loaded):
    edges = delivered(
        spark,
        ("ftp://north.harbour.net:21/", "shop.side.com", 10, "long_tail"),
        ("HARBOUR.net", "side.com", None, "top_1m"),
        ("harbour.net.", "www.side.com", 7, None),
        ("harbour.net", "far.com", 1, "top_100k"),
        ("river.io", "near.io", None, "novel"),
        ("river.io", "near.io", None, "newer"),
        ("delta.net", "near.com", None, "novel"),
        ("delta.net", "https://near.com/#x", 4, "long_tail"),
        ("delta.net", "lakes.org", 900, "top_10k"),
        ("intranet", "near.com", 8, "top_10k"),
    )
    found = load.build_domain_edges(edges, companies.frame(spark), rules, HIGH, loaded, ordered=True)
    assert [tuple(r)[1:8] for r in found.collect()] == [
        ("delta.net", "near.com", "Near", "direct_modern_bi", 4, "long_tail", False),
        ("harbour.net", "far.com", "Far", "enterprise_incumbent", 1, "top_100k", True),
        ("harbour.net", "side.com", "Side One", "direct_modern_bi", 17, "top_1m", False),
        ("river.io", "near.io", "Near", "direct_modern_bi", None, "newer", False),
    ]


def test_load_graph_edges(spark, companies, loaded):
    edges = delivered(
        spark,
        ("North.River.io", "SIDE.com", None, "long_tail"),
        ("north.river.io", "side.com", 6, "novel"),
        ("north.river.io", "far.com", 2, "top_10k"),
        ("river.io", "near.io", 1, None),
        ("river.io", "lakes.org", 1, "top_10k"),
    )
    found = load.load_graph_edges(edges, companies.frame(spark), HIGH, loaded)
    assert [r[1:8] for r in rows(found)] == [
        ("north.river.io", "far.com", "Far", "enterprise_incumbent", 2, "top_10k", True),
        ("north.river.io", "side.com", "Side One", "direct_modern_bi", 7, "long_tail", False),
        ("river.io", "near.io", "Near", "direct_modern_bi", 1, None, False),
    ]


def test_replace_release_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "raw")

    def ranks(release, *positions):
        return spark.createDataFrame(
            [("domain", f"d{p}.com", p, 1.0, 1.0, "top_10k", None, release) for p in positions],
            sinks.RAW_RANKS,
        )

    assert rows(sinks.read_raw(spark, path, sinks.RAW_RANKS, missing_ok=True)) == []
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sinks.read_raw(spark, path, sinks.RAW_RANKS).count()
    assert sinks.append_raw(ranks("2026", 1, 2), path) == 2
    assert sinks.append_raw(ranks("b", 3), path) == 1
    assert sinks.append_raw(ranks("b").limit(0), path) == 0
    assert sinks.replace_release(ranks("2026", 9), path, "2026") == 1

    def held():
        back = sinks.read_raw(spark, path, sinks.RAW_RANKS)
        return rows(back.select("graph_release_id", "rank_position"))

    assert held() == [("2026", 9), ("b", 3)]
    # a release with nothing in it any more ends up empty
    assert sinks.replace_release(ranks("2026", 9).limit(0), path, "2026") == 0
    assert held() == [("b", 3)]
    with pytest.raises(ValueError, match="unsupported release"):
        sinks.replace_release(ranks("x", 1), path, "../x")
    # rows of another release, or of none, change nothing
    for stray in (ranks("b", 4), ranks("b", 4).withColumn("graph_release_id", F.lit(None).cast("string"))):
        for handed in (stray, ranks("b", 5).unionByName(stray)):
            with pytest.raises(Exception, match="is not of c"):
                sinks.replace_release(handed, path, "c")
    sinks.append_raw(ranks("c", 8), path)
    with pytest.raises(Exception, match="a row of release b is not of c"):
        sinks.replace_release(ranks("b", 4), path, "c")
    assert held() == [("b", 3), ("c", 8)]


def test_load_extracted(spark, graph, tmp_path, settings, loaded):
    found = extract_release(spark, "rel-1", *graph, TWO, root=str(tmp_path / "s"))
    loading = dataclasses.replace(settings, companies=TWO)
    root = str(tmp_path / "raw")
    for _ in range(2):  # the second load replaces the first
        counts = load_extracted(
            spark, found.frame("graph_edges"), found.frame("domain_ranks"), loading, root, loaded
        )
        assert (counts.domain_edges, counts.domain_ranks) == (5, 3)
    edges = sinks.read_raw(spark, f"{root}/{EDGES}", sinks.RAW_EDGES)
    assert rows(edges.select("source_domain", "target_domain", "target_company", "source_high_authority_flag")) == [
        ("delta.net", "lakes.org", "Lakes", False),
        ("delta.net", "river.co.uk", "River", False),
        ("harbour.net", "river.io", "River", False),
        ("lakes.org", "river.io", "River", False),
        ("north.coast.net", "river.io", "River", True),
    ]


def test_a_replacement_that_is_broken_off_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "raw")

    def ranks(release, *positions):
        return spark.createDataFrame(
            [("domain", f"d{p}.com", p, 1.0, 1.0, "top_10k", None, release) for p in positions], sinks.RAW_RANKS
        )

    def held():
        return rows(sinks.read_raw(spark, path, sinks.RAW_RANKS).select("graph_release_id", "rank_position"))

    sinks.append_raw(ranks("a", 1, 2).unionByName(ranks("b", 3)), path)
    before = sinks.read_raw(spark, path, sinks.RAW_RANKS)
    written = sinks.prepare_release(ranks("a", 7), path, "a")  # the job stops here
    assert held() == [("a", 1), ("a", 2), ("b", 3)]
    # two writers prepared at the same time: both commits count, in turn
    other = sinks.prepare_release(ranks("b", 8), path, "b")
    assert snapshots.commit(spark, written, ["a"]) == snapshots.commit(spark, other, ["b"]) == 1
    assert held() == [("a", 7), ("b", 8)]
    assert before.count() == 3  # a reader keeps what it has found
    sinks.prepare_release(ranks("b", 9), path, "b")
    assert snapshots.vacuum(spark, path) == 2  # the first write and the one never committed
    assert held() == [("a", 7), ("b", 8)]
    assert not snapshots._create(spark, path, snapshots.Snapshot(1))  # a number is given once
    nothing = spark.createDataFrame([("domain", "x.com", 1, 1.0, 1.0, "b", None, None)], sinks.RAW_RANKS)
    sinks.append_raw(nothing, path)
    assert held() == [("a", 7), ("b", 8), (None, 1)]


def evidence_rows(spark, tmp_path, *lines):
    path = write_lines(tmp_path / "evidence.csv", ",".join(records.EVIDENCE_COLUMNS), *lines)
    return records.read_evidence(spark, path, "crawl-1")


GOOD = (
    "p3.gz,,http://Tides.delta.net:8080/chart?d=1,delta.net,tides.DELTA.net,https://side.com/prices,SIDE.com,Side One,"
    " tide prices ,ugc NOFOLLOW,no,Tide charts,pt,301,text/html"
)
MISMATCH = GOOD.replace(",delta.net,", ",coast.net,")
BAD_STATUS = GOOD.replace(",301,", ",600,")
RELATIVE = GOOD.replace("http://Tides.delta.net:8080/chart?d=1", "chart?d=1")


def test_load_delivered_end_to_end(spark, settings, rules, tmp_path, loaded):
    edges = delivered(
        spark,
        ("tides.delta.net", "http://www.side.com", 11, "top_1m"),
        ("DELTA.NET", "side.com", 4, None),
        ("delta.net", "near.io", 1, "top_100k"),
        ("delta.net", "lakes.org", 1, "top_10k"),
    ).drop("graph_release_id")
    ranks = spark.createDataFrame(
        [
            ("rel-1", "domain", "ftp://tides.Delta.net", 431, 2.5, 0.75, "top_10k"),
            ("rel-1", "host", "tides.Delta.net:99", None, None, None, None),
        ],
        "graph_release_id string, rank_entity_type string, domain_or_host string, rank_position int, "
        "harmonic_centrality double, pagerank double, rank_bucket string",
    )
    root = str(tmp_path / "raw")
    counts = load_delivered(
        spark, edges, settings, rules, root, loaded, ranks, evidence_rows(spark, tmp_path, GOOD)
    )
    assert counts == type(counts)(2, 2, 1)
    loaded = sinks.read_raw(spark, f"{root}/{EDGES}", sinks.RAW_EDGES)
    assert rows(loaded.select("source_domain", "target_domain", "edge_weight", "source_domain_rank_bucket")) == [
        ("delta.net", "near.io", 1, "top_100k"),
        ("delta.net", "side.com", 15, "top_1m"),
    ]
    assert rows(
        sinks.read_raw(spark, f"{root}/{RANKS}", sinks.RAW_RANKS).select("domain_or_host", "rank_position")
    ) == [("delta.net", 431), ("tides.delta.net", None)]
    seen = sinks.read_raw(spark, f"{root}/{EVIDENCE}", sinks.RAW_EVIDENCE).first()
    assert (seen["source_host"], seen["anchor_text"], seen["is_nofollow"]) == ("tides.delta.net", "tide prices", True)


def test_a_load_is_checked_whole_and_added_once(spark, settings, rules, tmp_path, loaded, monkeypatch):
    edges = delivered(spark, ("coast.net", "near.io", 2, None), ("intranet", "near.io", 1, None)).drop("graph_release_id")
    ranks = spark.createDataFrame(
        [("rel-1", "domain", "coast.net", 0, 2.5, 0.75, "top_10k"), ("rel-1", "domain", "delta.net", 5, 2.5, 0.75, "top_10k")],
        "graph_release_id string, rank_entity_type string, domain_or_host string, rank_position int, "
        "harmonic_centrality double, pagerank double, rank_bucket string",
    )
    good = edges.where("source_domain = 'coast.net'")
    root = str(tmp_path / "strict")
    with pytest.raises(Exception, match="record breaks"):
        load_delivered(spark, good, settings, rules, root, loaded, ranks, load_id="one")
    assert snapshots.current(spark, f"{root}/{EDGES}") is None  # the ranks were bad, so no edge was added
    fine = ranks.where("rank_position > 0")
    for _ in range(2):
        assert load_delivered(spark, good, settings, rules, root, loaded, fine, load_id="one").domain_edges == 1
        assert sinks.read_raw(spark, f"{root}/{EDGES}", sinks.RAW_EDGES).count() == 1
        assert sinks.read_raw(spark, f"{root}/{RANKS}", sinks.RAW_RANKS).count() == 1
    assert load_delivered(spark, good, settings, rules, root, loaded, fine, load_id="two").domain_ranks == 1
    assert sinks.read_raw(spark, f"{root}/{EDGES}", sinks.RAW_EDGES).count() == 2

    # Broken off between two commits, then run again: nothing is doubled, nothing is missing.
    root, whole, left = str(tmp_path / "loose"), snapshots.commit, [3]

    def until(*args):
        if not left[0]:
            raise RuntimeError("lost driver")
        left[0] -= 1
        return whole(*args)

    monkeypatch.setattr(snapshots, "commit", until)
    with pytest.raises(RuntimeError, match="lost driver"):
        load_delivered(spark, edges, settings, rules, root, loaded, ranks, strict=False, load_id="one")
    monkeypatch.setattr(snapshots, "commit", whole)
    for _ in range(2):
        counts = load_delivered(spark, edges, settings, rules, root, loaded, ranks, strict=False, load_id="one")
        assert (counts.domain_edges, counts.domain_ranks) == (1, 1)
        assert sinks.read_raw(spark, f"{root}/{EDGES}", sinks.RAW_EDGES).count() == 1
        assert sinks.read_raw(spark, f"{root}/{RANKS}", sinks.RAW_RANKS).count() == 1
        for table in (EDGES, RANKS):
            rejected = sinks.read_raw(spark, f"{root}/{table}_rejected", "failed_rules array<string>, graph_release_id string")
            assert rejected.count() == 1


def test_delivered_records_stop_or_go_to_the_rejected_table(spark, settings, rules, tmp_path, loaded):
    edges = delivered(spark, ("coast.net", "near.io", 2, None), ("intranet", "near.io", -2, None)).drop(
        "graph_release_id"
    )
    with pytest.raises(Exception, match="record breaks: source_domain, edge_weight"):
        load_delivered(spark, edges, settings, rules, str(tmp_path / "strict"), loaded)
    root = str(tmp_path / "loose")
    counts = load_delivered(spark, edges, settings, rules, root, loaded, strict=False)
    assert counts.domain_edges == 1
    rejected = spark.read.parquet(f"{root}/{EDGES}_rejected")
    assert rows(rejected.select("source_domain", "failed_rules")) == [
        ("intranet", ["source_domain", "edge_weight"])
    ]


def test_validate_evidence(spark, rules, tmp_path):
    df = evidence_rows(spark, tmp_path, GOOD, MISMATCH, BAD_STATUS, RELATIVE)
    checked = validate.validate_evidence(df, rules)
    assert checked.valid.count() == 1
    failed = sorted(r["failed_rules"] for r in checked.rejected.collect())
    assert failed == [["http_status"], ["source_domain"], ["source_url", "source_host", "source_domain"]]
    with pytest.raises(Exception, match="record breaks"):
        checked.strict().collect()


def test_validate_ranks(spark, rules):
    df = spark.createDataFrame(
        [
            ("r", "host", "ws://A.Coast.net:7", 12, 0.0, 3.5, "ok"),
            ("r", "domain", "a.b.coast.net", None, None, None, "ok"),
            ("", "zone", "coast.net", -3, -2.5, -0.25, "all"),
            ("r", "domain", "intranet", 2, 0.0, 0.0, "name"),
        ],
        "graph_release_id string, rank_entity_type string, domain_or_host string, rank_position int, "
        "harmonic_centrality double, pagerank double, rank_bucket string",
    )
    checked = validate.validate_ranks(df, rules)
    assert rows(checked.valid.select("domain_or_host")) == [("a.coast.net",), ("coast.net",)]
    assert {r["rank_bucket"]: r["failed_rules"] for r in checked.rejected.collect()} == {
        "all": ["graph_release_id", "rank_entity_type", "rank_position", "harmonic_centrality", "pagerank"],
        "name": ["domain_or_host"],
    }


def test_validate_companies(spark, rules):
    schema = "company string, role string, segment string, domain string"
    sound = spark.createDataFrame([("A", "target", "s", "a.com"), ("B", "competitor", "s", "b.com")], schema)
    assert rows(validate.validate_companies(sound, rules)) == []
    broken = spark.createDataFrame(
        [
            ("A", "owner", "s", "a.com"),
            ("B", "competitor", "s", "www.b.com"),
            ("B", "competitor", "s", "b.com"),
            ("C", "competitor", "s", "https://a.com/x"),
            ("D", "competitor", "s", None),
            ("E", "competitor", "s", "localhost"),
        ],
        schema,
    )
    assert rows(validate.validate_companies(broken, rules)) == [
        ("domain_resolves", "E", None),
        ("exactly_one_target", None, "0"),
        ("has_domain", "D", None),
        ("role_valid", "A", None),
        ("unique_across_companies", None, "a.com"),
        ("unique_in_company", "B", "b.com"),
    ]


def test_company_for_domain(spark, companies, rules):
    names = spark.createDataFrame([("http://docs.near.io:81/a",), ("lakes.org",), (" ",)], "n string")
    found = validate.company_for_domain(names, "n", companies.frame(spark), rules)
    assert {r["n"]: r["target_company"] for r in found.collect()} == {
        "http://docs.near.io:81/a": "Near",
        "lakes.org": None,
        " ": None,
    }
