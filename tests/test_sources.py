from __future__ import annotations

import gzip

import pytest

from conftest import rows, write_lines
from linkharbor.config import CompanySet
from linkharbor.functions import suffixes
from linkharbor.operators import extract, validate
from linkharbor.sources import companies as company_sources
from linkharbor.sources import records, webgraph


def test_vertices(spark, tmp_path):
    """Ids beyond 32 bits, a quote inside a name, a name of one label."""
    path = write_lines(tmp_path / "v.txt", "5000000001\torg.lakes.shop\t44", '3\tio."odd\t0', "8\tmuseum\t2")
    scan = webgraph.scan_vertices(spark, path)
    assert rows(scan.rows) == [
        (3, 'io."odd', 0, '"odd.io'),
        (5000000001, "org.lakes.shop", 44, "shop.lakes.org"),
        (8, "museum", 2, "museum"),
    ]
    assert rows(scan.rejected) == []


def test_gzip_edges(spark, tmp_path):
    path = tmp_path / "edges.txt.gz"
    with gzip.open(path, "wt") as file:
        file.write("71\t5000000001\n71\t71\n0\t8\n")
    assert rows(webgraph.scan_edges(spark, str(path)).rows) == [(0, 8), (71, 5000000001), (71, 71)]


def test_ranks_skip_comments(spark, tmp_path):
    path = write_lines(
        tmp_path / "r.txt",
        "#harmonicc_pos\t#harmonicc_val\t#pr_pos\t#pr_val\t#host_rev\t#n_hosts",  # fixed value: the file's first line
        "4\t1.75e7\t9\t2.5e-3\torg.lakes.shop\t44",
        "#trailing remark",
    )
    assert rows(webgraph.scan_ranks(spark, path).rows) == [
        (4, 1.75e7, 9, 0.0025, "org.lakes.shop", 44, "shop.lakes.org")
    ]


def test_bad_lines_are_kept_apart_or_raise(spark, tmp_path):
    bad = ["6\torg.short", "7\torg.long\t3\tmore", "six\torg.word\t3", "-6\torg.minus\t3", "9\t\t3"]
    path = write_lines(tmp_path / "v.txt", "31\torg.sound\t3", *bad)
    scan = webgraph.scan_vertices(spark, path)
    assert rows(scan.rows.select("node_id")) == [(31,)]
    assert rows(scan.rejected) == sorted((line,) for line in bad)
    # also when the query needs one column only
    assert scan.rows.select("reversed_domain").count() == 1
    with pytest.raises(Exception, match="cannot read the web-graph line"):
        webgraph.scan_vertices(spark, path, strict=True).rows.collect()
    for line in ("0\t8.5\t3\t0.25\torg.lakes\t1", "3\t-8.5\t3\t0.25\torg.lakes\t1", "3\t8.5\t3\t0.25\t\t1"):
        ranks = webgraph.scan_ranks(spark, write_lines(tmp_path / "bad-rank.txt", line))
        assert rows(ranks.rejected.selectExpr("count(*)")) == [(1,)]


def test_sample(spark, tmp_path):
    path = write_lines(tmp_path / "v.txt", *[f"{n}\tcom.d{n}\t1" for n in (3, 1, 2)])
    scan = webgraph.scan_vertices(spark, path).rows
    assert rows(webgraph.sample_rows(scan, 2, "node_id").select("node_id")) == [(1,), (2,)]
    with pytest.raises(ValueError, match="at least 1"):
        webgraph.sample_rows(scan, 0, "node_id")


def test_parquet_copy_is_sorted_by_range(spark, tmp_path):
    df = spark.range(1000).selectExpr("1000 - id as node_id", "id as x")
    webgraph.to_parquet(df, str(tmp_path / "copy"), "node_id")
    back = spark.read.parquet(str(tmp_path / "copy"))
    assert back.count() == 1000
    spans = back.selectExpr("input_file_name() as f", "node_id").groupBy("f").agg({"node_id": "min"}).count()
    assert spans >= 1


def test_graph_edges_csv(spark, tmp_path):
    path = write_lines(
        tmp_path / "e.csv",
        "edge_weight,target_domain,note,source_domain",
        "12,http://shop.lakes.org:80/a?b,kept out,RIVER.IO",
        " ,lakes.org,,delta.net",
    )
    assert rows(records.read_graph_edges(spark, path)) == [
        ("RIVER.IO", "http://shop.lakes.org:80/a?b", 12, None),
        ("delta.net", "lakes.org", None, None),
    ]
    bad = write_lines(tmp_path / "bad.csv", ",".join(records.EDGE_COLUMNS), "river.io,lakes.org,twelve,")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        records.read_graph_edges(spark, bad).collect()
    assert rows(records.read_graph_edges(spark, bad, strict=False)) == [("river.io", "lakes.org", None, None)]
    assert rows(records.read_loose_edges(spark, bad)) == [("river.io", "lakes.org", 1, None)]


def test_files_of_a_folder_may_order_their_columns_differently(spark, tmp_path):
    folder = tmp_path / "edges"
    folder.mkdir()
    write_lines(folder / "1.csv", "source_domain,target_domain", "river.io,lakes.org")
    write_lines(folder / "2.csv", "target_domain,edge_weight,source_domain", "lakes.org,3,delta.net")
    write_lines(folder / "3.csv", "source_domain,target_domain", "coast.net,lakes.org")
    (folder / "4.csv").write_text("")
    found = records.read_graph_edges(spark, str(folder))
    assert rows(found.select("source_domain", "target_domain", "edge_weight")) == [
        ("coast.net", "lakes.org", None),
        ("delta.net", "lakes.org", 3),
        ("river.io", "lakes.org", None),
    ]


def test_a_required_column_must_be_there(spark, tmp_path):
    path = write_lines(tmp_path / "e.csv", "source_domain,edge_weight", "river.io,3")
    with pytest.raises(ValueError, match="no column target_domain in"):
        records.read_graph_edges(spark, path)
    twice = write_lines(tmp_path / "t.csv", "source_domain,target_domain,source_domain", "a.io,b.io,c.io")
    with pytest.raises(ValueError, match="no column source_domain|is repeated"):
        records.read_graph_edges(spark, twice)


def test_records_of_another_length_are_kept_apart_or_raise(spark, tmp_path):
    lines = ["river.io,lakes.org,3,top_1m", "delta.net,lakes.org", "coast.net,lakes.org,1,top_1m,more"]
    path = write_lines(tmp_path / "e.csv", ",".join(records.EDGE_COLUMNS), *lines)
    scan = records.scan_csv(spark, path, records.EDGE_COLUMNS, records.REQUIRED_EDGE, strict=False)
    assert rows(scan.rows.select("source_domain")) == [("river.io",)]
    assert scan.rows.count() == 1
    assert rows(scan.rejected) == [(lines[2],), (lines[1],)]
    with pytest.raises(Exception, match="does not fit its header: delta.net,lakes.org"):
        records.read_graph_edges(spark, path).select("source_domain").collect()


def test_domain_ranks_csv(spark, tmp_path):
    header = ",".join(records.RANK_COLUMNS)
    path = write_lines(tmp_path / "r.csv", header, "domain,LAKES.org,77,3.5,,long_tail", "host,a.river.io,,,0.125,")
    assert rows(records.read_domain_ranks(spark, path, "007")) == [
        ("007", "domain", "LAKES.org", 77, 3.5, None, "long_tail"),
        ("007", "host", "a.river.io", None, None, 0.125, None),
    ]
    bad = write_lines(tmp_path / "bad.csv", header, "zone,lakes.org,77,3.5,,long_tail")
    with pytest.raises(Exception, match="of a domain or of a host, not of zone"):
        records.read_domain_ranks(spark, bad, "007").collect()


def test_evidence_copy(spark, tmp_path):
    path = write_lines(
        tmp_path / "w.csv",
        ",".join(records.REQUIRED_EVIDENCE),
        "p.gz,https://river.io/x,river.io,river.io,https://lakes.org/,lakes.org,Lakes",
    )
    records.evidence_to_parquet(spark, path, str(tmp_path / "copy"))
    back = records.typed_evidence(spark.read.parquet(str(tmp_path / "copy")), "crawl")
    assert rows(back) == rows(records.read_evidence(spark, path, "crawl", multiline=False))
    assert back.first()["is_nofollow"] is False


def test_evidence_csv_with_quotes_and_line_breaks(spark, tmp_path):
    path = write_lines(
        tmp_path / "w.csv",
        ",".join(records.EVIDENCE_COLUMNS),
        'p7.gz,,https://delta.net/x,delta.net,delta.net,https://lakes.org/,lakes.org,Lakes,"say ""hi"",\nthere",'
        "ugc,YES,Fish & boats,pt,301,application/xhtml+xml",
    )
    row = records.read_evidence(spark, path, "crawl").first()
    assert row["anchor_text"] == 'say "hi",\nthere'
    assert row["warc_record_id"] is None
    assert row["is_nofollow"] is True
    assert row["http_status"] == 301
    assert row["crawl_id"] == "crawl"


def test_companies(spark, tmp_path):
    csv = write_lines(tmp_path / "c.csv", "company,role,segment,domain", "Own,target,target,own.co")
    assert rows(company_sources.read_companies_csv(spark, csv)) == [("Own", "target", "target", "own.co")]
    json = write_lines(
        tmp_path / "c.json", '{"company":"N","role":"competitor","segment":"s","domains":["n.com","n.io"]}'
    )
    assert rows(company_sources.read_companies_json(spark, json)) == [
        ("N", "competitor", "s", "n.com"),
        ("N", "competitor", "s", "n.io"),
    ]


def test_configured_domains_are_resolved(spark, rules, tmp_path):
    json = write_lines(
        tmp_path / "companies.json",
        '{"companies": [{"company": "Lakes", "role": "target", "segment": "target",',
        '  "domains": ["https://www.Lakes.org/about?x=1"]},',
        ' {"company": "River", "role": "competitor", "segment": "s", "domains": ["shop.river.co.uk", "river.io"]}]}',
    )
    found = company_sources.load_companies(spark, json, rules)
    assert found.domains == ["lakes.org", "river.co.uk", "river.io"]
    # found in vertices, edges and by name
    vertices = spark.createDataFrame([(5, "org.lakes", 1, "lakes.org")], "node_id long, reversed_domain string, num_hosts int, domain string")
    targets = extract.target_vertices(vertices, found.frame(spark))
    assert rows(extract.edges_to_targets(spark.createDataFrame([(9, 5), (9, 6)], "source_node_id long, target_node_id long"), targets)) == [
        (9, 5, "lakes.org")
    ]
    named = validate.company_for_domain(spark.createDataFrame([("www.lakes.org",)], "n string"), "n", found.frame(spark), rules)
    assert rows(named.select("target_company")) == [("Lakes",)]


@pytest.mark.parametrize(
    ("domains", "problem"),
    [(["lakes.org", "http://www.lakes.org/"], "used twice"), (["localhost"], "no registered domain in .*localhost")],
)
def test_configured_domains_that_cannot_stand(spark, rules, domains, problem):
    items = [{"company": "Lakes", "role": "target", "segment": "target", "domains": domains}]
    with pytest.raises(ValueError, match=problem):
        suffixes.resolved_companies(spark, items, rules)
    with pytest.raises(ValueError, match="resolve the list first"):
        CompanySet.from_items([items[0] | {"domains": ["https://lakes.org/"]}])
