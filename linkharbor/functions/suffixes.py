"""Registered domains under public-suffix rules, by one map-side join with a small rule table.

The table has a row per top label. It holds the rules below that label, of every length, as a hash
table: an array of small maps, in which a suffix is found by its checksum. A host meets the row of its
top label in one broadcast join and looks its last 1, 2, ... labels up there; the longest rule wins and
an exception rule beats a wildcard. A top label that is itself the only rule needs no lookup. No row is
multiplied, no host is sent anywhere, and the broadcast table is the same for every lookup, so Spark
builds it once and reuses it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkharbor.config import CompanySet, literal_rows
from linkharbor.functions.hosts import host_or_empty, simple_host_or_empty
from linkharbor.session import MAX_BROADCAST_ROWS, materialize

RULE, WILDCARD, EXCEPTION = 1, 2, 4
# Rules in one map of the hash table, on average: maps are searched entry by entry.
MAP_RULES = 2


@dataclass(frozen=True)
class SuffixRules:
    """Rule table (top, alone, buckets) with the number of rules and the kinds found at each length.

    `buckets` maps suffixes to kinds, a bit set: a rule itself, a wildcard below it, an exception.
    It is null where the top label is `alone`: a rule with none below it, as most are.
    """

    table: DataFrame
    rows: int
    kinds_of_length: dict[int, int]

    def lookup(self) -> DataFrame:
        side = self.table.selectExpr("top as __top", "alone as __alone", "buckets as __buckets")
        return F.broadcast(side) if self.rows <= MAX_BROADCAST_ROWS else side


def _bucket(suffix: str, buckets: str) -> str:
    return f"int(crc32(cast({suffix} as binary)) % {buckets})"


def _as_buckets(by_top: DataFrame) -> DataFrame:
    """From rows (top, rules: array<struct<suffix,kinds>>). Runs once a rule list, not once a host."""
    n = f"int(1 + size(rules) div {MAP_RULES})"
    alone = f"(size(rules) = 1 and rules[0].suffix = top and rules[0].kinds = {RULE})"
    return by_top.selectExpr(
        "top",
        f"{alone} as alone",
        f"if({alone}, null, transform(sequence(0, {n} - 1), "
        f"b -> map_from_entries(filter(rules, r -> {_bucket('r.suffix', n)} = b)))) as buckets",
    )


def rules_from_list(spark: SparkSession, rules: Iterable[str]) -> SuffixRules:
    """A short list as a local relation; the published list is read by `rules_from_file`."""
    kinds: dict[str, int] = {}
    for rule in rules:
        kind = EXCEPTION if rule.startswith("!") else WILDCARD if rule.startswith("*.") else RULE
        suffix = rule.removeprefix("!").removeprefix("*.")
        kinds[suffix] = kinds.get(suffix, 0) | kind
    by_top: dict[str, list[tuple[str, int]]] = {}
    of_length: dict[int, int] = {}
    for suffix, kind in kinds.items():
        labels = suffix.split(".")
        by_top.setdefault(labels[-1], []).append((suffix, kind))
        of_length[len(labels)] = of_length.get(len(labels), 0) | kind
    schema = T.StructType([T.StructField("top", T.StringType()), T.StructField("listed", T.StringType())])
    rows = [(top, " ".join(f"{suffix}={kind}" for suffix, kind in found)) for top, found in by_top.items()]
    listed = literal_rows(spark, rows, schema).selectExpr(
        "top",
        "transform(split(listed, ' '), r -> struct(substring_index(r, '=', 1) as suffix, "
        "int(substring_index(r, '=', -1)) as kinds)) as rules",
    )
    return SuffixRules(_as_buckets(listed), len(kinds), of_length)


def rules_from_file(spark: SparkSession, path: str) -> SuffixRules:
    """Read a list in the public suffix list's text format; only its ICANN section counts."""
    begin, end = "===BEGIN ICANN DOMAINS===", "===END ICANN DOMAINS==="
    text = spark.read.text(path, wholetext=True)
    lines = text.selectExpr(
        f"explode(split(substring_index(substring_index(value, '{end}', 1), '{begin}', -1), r'\r?\n')) as line"
    )
    rules = lines.selectExpr(r"split(trim(line), r'\s+')[0] as rule").filter(
        "rule <> '' and not startswith(rule, '//') and not startswith(rule, '=')"
    )
    kind = (
        f"case when startswith(rule, '!') then {EXCEPTION} "
        f"when startswith(rule, '*.') then {WILDCARD} else {RULE} end"
    )
    table = (
        rules.mapInPandas(_with_ascii_form, rules.schema)
        .groupBy(F.expr(r"regexp_replace(rule, r'^(!|\*\.)', '')").alias("suffix"))
        .agg(F.expr(f"bit_or({kind})").alias("kinds"))
        .selectExpr("suffix", "length(suffix) - length(replace(suffix, '.')) + 1 as labels", "kinds")
    )
    # Written once, since every lookup reads it. The facts are a handful of rows, one per length.
    table = materialize(table.coalesce(1), "suffix-rules")
    facts = table.groupBy("labels").agg(F.expr("bit_or(kinds) as kinds"), F.expr("count(*) as n"))
    lengths = facts.collect()
    by_top = table.groupBy(F.expr("substring_index(suffix, '.', -1) as top")).agg(
        F.expr("collect_list(struct(suffix, kinds)) as rules")
    )
    return SuffixRules(
        materialize(_as_buckets(by_top).coalesce(1), "suffix-buckets"),
        sum(r["n"] for r in lengths),
        {r["labels"]: r["kinds"] for r in lengths},
    )


def registered_domain(df: DataFrame, value: str, output: str, rules: SuffixRules) -> DataFrame:
    """Add the registered domain of a host, URL or bare name; null means it has none.

    Addresses and names under no known suffix get null, and so do the suffixes themselves.
    """
    simple, host, length = f"__{output}_simple", f"__{output}_host", f"__{output}_length"
    # One regular expression finds the host of the usual name or URL. The rest goes through a lambda: its
    # long expression is then called from the generated code instead of being written out in it, which
    # keeps the stage's loop short enough for the JVM to compile.
    # Ideographic full stops separate labels too; trailing dots mean nothing.
    cleaned = host_or_empty("v")
    for stop in "。．｡":
        cleaned = f"replace({cleaned}, '{stop}', '.')"
    cleaned = f"get(transform(array({value}), v -> trim(trailing '.' from {cleaned})), 0)"
    out = df.withColumn(simple, F.expr(simple_host_or_empty(value)))
    out = out.withColumn(host, F.expr(f"if({simple} <> '', {simple}, {cleaned})"))
    out = out.join(rules.lookup(), F.expr(f"substring_index({host}, '.', -1) = __top"), "left")
    found, lengths, exceptions = [], ["0", "0"], []
    for n, have in sorted(rules.kinds_of_length.items()):
        kinds, tail = f"__{output}_kinds{n}", f"substring_index({host}, '.', -{n})"
        kind = f"try_element_at(get(__buckets, {_bucket(tail, 'size(__buckets)')}), {tail})"
        found.append(f"if(__buckets is null, null, {kind}) as {kinds}")
        if have & RULE:
            lengths.append(f"if({kinds} & {RULE} <> 0, {n}, 0)")
        if have & WILDCARD:
            lengths.append(f"if({kinds} & {WILDCARD} <> 0 and {host} <> {tail}, {n + 1}, 0)")
        if have & EXCEPTION:
            exceptions.append(f"if({kinds} & {EXCEPTION} <> 0, {n - 1}, null)")
    out = out.selectExpr(*[f"`{c}`" for c in df.columns], host, "__alone", *found)
    longest = f"coalesce({', '.join([*exceptions, f'greatest({", ".join(lengths)})'])})"
    longest = f"if(__alone, 1, {longest})"
    out = out.select(*df.columns, host, F.expr(longest).alias(length))
    # One label more than the suffix; a host that is the suffix itself has no such label.
    name = f"substring_index({host}, '.', -1 - {length})"
    resolved = (
        f"if({length} > 0 and {host} <> substring_index({host}, '.', -{length}) "
        f"and not startswith({name}, '.'), {name}, null)"
    )
    # An array of one, exploded, adds no row. It stops a filter on the name, such as a join puts on its key,
    # from being pushed down as the whole expression, with every lookup written out at each of its uses.
    return out.select(*df.columns, F.explode(F.array(F.expr(resolved))).alias(output))


def _with_ascii_form(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Hosts occur in both spellings, so every non-ASCII rule is listed in both."""
    for batch in batches:
        yield batch
        extra = [r for r in map(_to_ascii, batch["rule"][~batch["rule"].map(str.isascii)]) if r]
        if extra:  # an empty frame has no type that Arrow could take for text
            yield pd.DataFrame({"rule": extra})


def _to_ascii(rule: str) -> str | None:
    try:
        return ".".join(
            label if label.isascii() else "xn--" + label.encode("punycode").decode("ascii")
            for label in rule.split(".")
        )
    except UnicodeError:
        return None


def resolved_companies(spark: SparkSession, companies: Iterable[Mapping[str, object]], rules: SuffixRules) -> CompanySet:
    """A configured list whose domains may be URLs or host names, as registered domains.

    A domain that does not resolve, or two that resolve to the same, are errors.
    """
    items = [dict(c) for c in companies]
    given = sorted({str(d) for c in items for d in c["domains"]})
    named = registered_domain(spark.createDataFrame([(d,) for d in given], "given string"), "given", "name", rules)
    names = {r["given"]: r["name"] for r in named.collect()}  # as long as the configured list
    unknown = [d for d in given if names.get(d) is None]
    if unknown:
        raise ValueError(f"no registered domain in {unknown}")
    return CompanySet.from_items([c | {"domains": [names[str(d)] for d in c["domains"]]} for c in items])
