from __future__ import annotations

import itertools
from dataclasses import replace
from decimal import ROUND_HALF_UP, Decimal

import pytest

from conftest import rows, write_lines
from linkharbor.config import RANK_BUCKETS, Company, CompanySet, ReleaseSettings, ScoreSettings
from linkharbor.functions import hosts, ranks, suffixes, text
from linkharbor.operators import marts


def column(spark, values, expression, to_type="string"):
    """Value -> result of the expression over the column `v`."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {to_type}")
    found = {r["i"]: r["x"] for r in df.selectExpr("i", f"{expression} as x").collect()}
    return [found[i] for i in range(len(values))]


def test_rank_bucket_bounds(spark):
    positions = [None, 1, 10_000, 10_001, 100_000, 100_001, 1_000_000, 1_000_001]
    expected = [None, "top_10k", "top_10k", "top_100k", "top_100k", "top_1m", "top_1m", "long_tail"]
    assert column(spark, positions, ranks.rank_bucket("v"), "int") == expected


def test_bucket_order_keeps_null_and_unknown_apart(spark):
    values = [*RANK_BUCKETS, "other", "", None]
    expected = [1, 2, 3, 4, None, None, None]
    assert column(spark, values, ranks.bucket_order("v")) == expected
    names = column(spark, values, ranks.bucket_name(ranks.bucket_order("v")))
    assert names == [*RANK_BUCKETS, None, None, None]


def test_best_bucket(spark):
    df = spark.createDataFrame(
        [(1, "long_tail"), (1, "top_100k"), (1, None), (2, "odd"), (2, None), (3, "top_1m")],
        "k int, b string",
    )
    df.createOrReplaceTempView("buckets")
    found = spark.sql(f"select k, {ranks.best_bucket('b')} as b from buckets group by k")
    assert rows(found) == [(1, "top_100k"), (2, None), (3, "top_1m")]


@pytest.mark.parametrize(
    ("value", "host"),
    [
        ("gopher://tides.delta.net/1/maps", "tides.delta.net"),
        ("Lakes.ORG#boats", "lakes.org"),
        (" \thttps://Lakes.org:8080/x#y\n", "lakes.org"),
        ("ftp://user:pw@lakes.org?q=a@b", "lakes.org"),
        ("http://a@b@lakes.org/", "lakes.org"),
        ("my_shop.delta.net", "my_shop.delta.net"),
        ("http://[2001:db8::1]:80/", "2001:db8::1"),
        ("lakes.org.", "lakes.org."),
        ("lakes.org/see?next=https://delta.net", None),
        ("1x://lakes.org", None),
        ("https://user@:80/", None),
        ("http://a:x@b[c", None),
        ("", None),
        ("   ", None),
        ("?only=query", None),
        ("//lakes.org/x", None),
        (None, None),
    ],
)
def test_normalize_host(spark, value, host):
    assert column(spark, [value], hosts.normalize_host("v")) == [host]


def test_simple_hosts_are_those_of_the_full_rule(spark):
    before = ("", " \t", "\n", "http://", "HTTPS://", "a+b://", "a_b://", "1x://", "u@", "ftp://u:p@", "//", "[")
    names = ("lakes.org", "WWW.My_shop.delta.net", "10.0.0.1", "intranet", "a..b", ".org", "lakes。org", "\u212aelp.org", "caf\xe9.org", "")
    after = ("", ".", ":", ":80", ":8x", ":80@b.org", "@b.org", "/", "/x y", "/x\ty", "?n=http://b.org", "?n=:", "://b", "#f", " ", "/ \r\n", "\n", "\x85", "\u2028x", "/\u2028://", "]")
    values = ["".join(v) for v in itertools.product(before, names, after)] + [None]
    simple, full = (column(spark, values, f("v")) for f in (hosts.simple_host_or_empty, hosts.host_or_empty))
    assert [(v, s) for v, s, f in zip(values, simple, full) if s not in ("", f)] == []
    usual = ("http://lakes.org", "HTTPS://WWW.My_shop.delta.net:80", " \tlakes.org/x y", "10.0.0.1#f", "\nlakes.org\n", "intranet/")
    assert all(simple[values.index(v)] for v in usual)


def test_absolute_url(spark):
    values = ["\tftp://lakes.org:21?x\n", "../up", "lakes.org", "mailto:me@lakes.org", "http:///x", "HTTP://A"]
    expected = ["ftp://lakes.org:21?x", None, None, None, None, "HTTP://A"]
    assert column(spark, values, hosts.absolute_url("v")) == expected


def test_reverse_labels(spark):
    assert column(spark, ["net.delta.tides", "museum", ""], hosts.reverse_labels("v")) == [
        "tides.delta.net",
        "museum",
        "",
    ]


def test_registered_domain(spark, rules):
    cases = {
        "wss://a.b.Lakes.org:444#c": "lakes.org",
        "RIVER.io": "river.io",
        "tides.delta.net?d=1": "delta.net",
        "a.b.harbour.co.uk": "harbour.co.uk",
        "co.uk": None,
        "com": None,
        "kawasaki.jp": "kawasaki.jp",
        "x.kawasaki.jp": None,
        "a.x.kawasaki.jp": "a.x.kawasaki.jp",
        "b.a.x.kawasaki.jp": "a.x.kawasaki.jp",
        "city.kawasaki.jp": "city.kawasaki.jp",
        "a.city.kawasaki.jp": "city.kawasaki.jp",
        "www.ck": "www.ck",
        "shop.www.ck": "www.ck",
        "a.b.ck": "a.b.ck",
        "lakes.org.": "lakes.org",
        "www。lakes。org": "lakes.org",
        ".com": None,
        "intranet": None,
        "192.168.7.1": None,
        "\t": None,
    }
    df = spark.createDataFrame([(v,) for v in cases], "v string")
    found = suffixes.registered_domain(df, "v", "d", rules).collect()
    assert {r["v"]: r["d"] for r in found} == cases


def test_line_break_after_a_plain_name(spark, rules):
    df = spark.createDataFrame([(f"a.lakes.org{end}",) for end in ("", "\n", "\r\n", "\x85", "\u2028")], "v string")
    assert {r["d"] for r in suffixes.registered_domain(df, "v", "d", rules).collect()} == {"lakes.org"}


def test_a_label_alone_needs_no_lookup(spark):
    rules = suffixes.rules_from_list(spark, ["com", "*.ck", "uk", "co.uk", "x.zz", "!only.not"])
    assert {r["top"]: r["alone"] for r in rules.table.collect()} == {
        "com": True, "ck": False, "uk": False, "zz": False, "not": False,
    }
    assert {r["top"] for r in rules.table.where("buckets is null").collect()} == {"com"}
    cases = {"a.b.com": "b.com", "com": None, "b.a.ck": "b.a.ck", "a.ck": None, "a.b.uk": "b.uk", "a.b.co.uk": "b.co.uk"}
    cases |= {"b.x.zz": "b.x.zz", "b.zz": None, "zz": None, "a.only.not": "only.not", "a.none": None}
    df = spark.createDataFrame([(v,) for v in cases], "v string")
    assert {r["v"]: r["d"] for r in suffixes.registered_domain(df, "v", "d", rules).collect()} == cases


def test_many_rules_below_one_label(spark):
    names = [f"n{n}.x{n % 7}.zz" for n in range(600)] + [f"x{n}.zz" for n in range(0, 7, 2)] + ["zz", "*.x1.zz", "!n1.x1.zz"]
    rules = suffixes.rules_from_list(spark, [n for n in names if n != "n1.x1.zz"])
    cases = {f"a.b.n{n}.x{n % 7}.zz": f"b.n{n}.x{n % 7}.zz" for n in range(600) if n != 1}
    cases |= {"a.n1.x1.zz": "n1.x1.zz", "c.b.a.new.x1.zz": "a.new.x1.zz", "b.a.new.x2.zz": "new.x2.zz", "a.new.x4.zz": "new.x4.zz"}
    cases |= {"b.a.new.x3.zz": "x3.zz", "x2.zz": None, "zz": None, "a.yy": None}
    df = spark.createDataFrame([(v,) for v in cases], "v string")
    assert {r["v"]: r["d"] for r in suffixes.registered_domain(df, "v", "d", rules).collect()} == cases
    # A rule list beyond the bound of a broadcast is joined by shuffle.
    beyond = replace(rules, rows=suffixes.MAX_BROADCAST_ROWS + 1)
    assert {r["v"]: r["d"] for r in suffixes.registered_domain(df, "v", "d", beyond).collect()} == cases


def test_rules_from_file_reads_the_icann_part(spark, tmp_path):
    path = write_lines(
        tmp_path / "list.dat",
        "// a comment",
        "// ===BEGIN ICANN DOMAINS===",
        "",
        "com",
        "uk",
        "co.uk  // trailing text",
        "*.ck",
        "!www.ck",
        "рф",
        "// ===END ICANN DOMAINS===",
        "// ===BEGIN PRIVATE DOMAINS===",
        "github.io",
        "blogspot.com",
        "// ===END PRIVATE DOMAINS===",
    )
    found = suffixes.rules_from_file(spark, path)
    assert found.rows == 7  # com, uk, co.uk, ck (wildcard), www.ck (exception), рф and its ASCII form
    cases = {
        "x.blogspot.com": "blogspot.com",
        "a.b.co.uk": "b.co.uk",
        "shop.www.ck": "www.ck",
        "a.пример.рф": "пример.рф",
        "a.xn--e1afmkfd.xn--p1ai": "xn--e1afmkfd.xn--p1ai",
        "x.github.io": None,
    }
    df = spark.createDataFrame([(v,) for v in cases], "v string")
    named = suffixes.registered_domain(df, "v", "d", found).collect()
    assert {r["v"]: r["d"] for r in named} == cases


def test_text_rules(spark):
    assert column(spark, [" a\xa0", "\t\n", "", None, "a b"], text.clean_text("v")) == ["a", None, None, None, "a b"]
    assert column(spark, ["1", " TRUE", "t", "Yes\n", "y", "no", "", None], text.parse_bool("v")) == (
        [True] * 5 + [False] * 3
    )
    rels = ["nofollow", "noopener\tNoFollow", "nofollower", "no follow", "", None]
    assert column(spark, rels, text.infer_nofollow("false", "v")) == [True, True, False, False, False, False]
    assert column(spark, rels, text.infer_nofollow("true", "v")) == [True] * 6
    assert column(spark, [" 5 ", "", "x", None], text.optional_number("v", "int")) == [5, None, None, None]
    assert column(spark, [" 5 ", "", "x", None], text.is_bad_number("v", "int")) == [False, False, True, False]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        column(spark, ["x"], text.optional_number("v", "int", strict=True))


def test_company_set_rules():
    own = Company("Own", "target", "target", ("own.co",))
    with pytest.raises(ValueError, match="exactly one target"):
        CompanySet((own, Company("B", "target", "s", ("b.com",))))
    with pytest.raises(ValueError, match="used twice"):
        CompanySet((own, Company("B", "competitor", "s", ("own.co",))))
    with pytest.raises(ValueError, match="no domain"):
        CompanySet((own, Company("B", "competitor", "s", ())))
    with pytest.raises(ValueError, match="unknown role"):
        CompanySet((own, Company("B", "partner", "s", ("b.com",))))
    with pytest.raises(ValueError, match="unique"):
        ReleaseSettings("r", "c", ("top_10k", "top_10k"))
    with pytest.raises(ValueError, match="positive"):
        ReleaseSettings("r", "c", max_enrichment_domains=0)


def test_score_is_exact_for_every_combination_of_signals(spark):
    """All signal values there are, against decimal arithmetic: no score may miss its tier."""
    score = ScoreSettings()
    values = (
        ("0.25", "0.5", "0.75", "1"),
        ("1", "0.85", "0.45", "0.15", "0"),
        ("1", "0.85", "0.75", "0.5", "0.25", "0"),
        ("0", "0.5", "1"),
        ("0", "0.4", "0.6", "0.8", "1"),
        ("0", "0.4", "1"),
    )
    combinations = list(itertools.product(*values))
    points = (30, 25, 15, 15, 10, 5)
    df = spark.createDataFrame(
        [tuple(float(v) for v in c) for c in combinations],
        ", ".join(f"{s} double" for s in marts.SIGNALS),
    ).selectExpr("*", f"{marts.opportunity_score(score)} as opportunity_score")
    found = df.selectExpr("*", f"{marts.opportunity_tier(score)} as tier").collect()
    for row in found:
        exact = sum(p * Decimal(str(row[s])) for p, s in zip(points, marts.SIGNALS))
        expected = exact.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert Decimal(str(row["opportunity_score"])) == expected
        tier = next((n for n, low in score.tiers if expected >= Decimal(low)), "monitor")
        assert row["tier"] == tier


def test_evidence_signal_is_in_tenths(spark):
    df = spark.createDataFrame(
        [(n, *flags) for n in (0, 2) for flags in itertools.product([True, False], repeat=3)],
        "evidence_record_count long, has_example_url boolean, has_page_title boolean, has_anchor_text boolean",
    )
    for row in df.selectExpr("*", f"{marts.evidence_signal()} as s").collect():
        flags = row["has_example_url"] + row["has_page_title"] + row["has_anchor_text"]
        assert row["s"] == (0.0 if row["evidence_record_count"] == 0 else (4 + 2 * flags) / 10)


def test_clean_signal(spark):
    score = ScoreSettings()
    values = ["bit.ly", "t.co", "mycasino.com", "crackers.net", "a" * 81, "a" * 80, "example.com", "xt.co"]
    expected = [0.0, 0.0, 0.0, 0.0, 0.4, 1.0, 1.0, 1.0]
    assert column(spark, values, marts.clean_signal(score, "v")) == expected


def test_recommended_action_takes_the_first_kind_that_fits(spark):
    score = ScoreSettings()
    df = spark.createDataFrame(
        [
            ("this vs that, partner blog", True, 1, "Create comparison content"),
            ("partner blog", True, 1, "Partner/integration outreach"),
            ("a blog", True, 1, "Community/content outreach"),
            ("plain", True, 1, "Review manually"),
            (None, True, 0, "Validate with SEO tool"),
            (None, False, 0, "Review manually"),
        ],
        "example_evidence_text string, source_high_authority_flag boolean, evidence_record_count long, expected string",
    )
    for row in df.selectExpr("*", f"{marts.recommended_action(score)} as action").collect():
        assert row["action"] == row["expected"]
