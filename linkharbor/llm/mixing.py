"""Mixes overlapping sources to target weights by a min-cost flow over membership patterns.

A document belongs to a set of sources, its pattern. Only the sizes of the patterns reach the driver.
There a flow goes from the patterns, each with its size as capacity for every repetition and a cost
that rises with the repetition, to the sources with their quotas: as much as the quotas ask for, at the
least cost. The words a pattern has to give are so many whole repetitions and a rest. The rest (or
what is not of the rest, if that is less) is drawn from documents in the order of a seeded hash, as many
as fit, and what is then left is filled with documents of falling size. A document is taken whole or not
at all in a repetition, so a source may stay off its quota by less than a short document.

Targets: each source has a weight and the sources share all words by weight, but no target is above
REPEATS times the size of its source; what is above is shared by weight among the others.

Scale: sizes are merged before each shuffle, by pattern, by hash bucket (BUCKETS a pattern) and by size;
only the documents of one bucket a pattern are ordered, so a pattern may hold a third of all rows. The
driver holds one row a pattern, and there are no more than the recipe's sources combine to.

Nulls: a null text has size 0; a null among the sources is a source like any other, after all named ones;
null or empty membership belongs to no source and is not taken. Repeated rows are documents of their own.
Rows of size 0 are taken 0. An empty table gives empty tables; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Callable, Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from linkharbor.llm.common import staged

REPEATS = 3
# What a word costs in its first, second and third repetition.
REPEAT_COSTS = (0, 1, 3)
SEED = 11
BUCKETS = 1 << 16
# Above this many patterns their plan is joined by shuffle.
MAX_BROADCAST_PATTERNS = 100_000

Source = str | None


def words(text: Column) -> Column:
    """Number of runs of characters that are no ASCII blank."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def in_order(sources: Sequence[Source]) -> list[Source]:
    """By code point, null last."""
    return sorted(sources, key=lambda s: (s is None, s or ""))


def targets(sizes: Sequence[int], weights: Sequence[float], total: int, repeats: int = REPEATS) -> list[float]:
    """Shares of the total by weight, none above `repeats` times its size while others have room."""
    out = [0.0] * len(sizes)
    open_ones, left = list(range(len(sizes))), float(total)
    while open_ones:
        weight = sum(weights[i] for i in open_ones)
        shares = {i: left * weights[i] / weight for i in open_ones}
        above = [i for i in open_ones if shares[i] > repeats * sizes[i]]
        for i in above or open_ones:
            out[i] = float(repeats * sizes[i]) if above else shares[i]
        if not above:
            break
        left -= sum(repeats * sizes[i] for i in above)
        open_ones = [i for i in open_ones if i not in set(above)]
    return out


def quotas(wanted: Sequence[float]) -> list[int]:
    """Whole numbers with the rounded sum, each within one of its target."""
    floors = [math.floor(w) for w in wanted]
    short = round(math.fsum(wanted)) - sum(floors)
    by_rest = sorted(range(len(wanted)), key=lambda i: (floors[i] - wanted[i], i))
    for i in by_rest[: max(short, 0)]:
        floors[i] += 1
    return floors


def min_cost_flow(n: int, arcs: Sequence[tuple[int, int, int, int]], start: int, end: int) -> list[int]:
    """Flow on each (from, to, capacity, cost) arc, costs >= 0: the largest flow, and the cheapest of these.

    Primal-dual: shortest distances by reduced costs, then a blocking flow on the arcs that lie on
    shortest ways, until the end is out of reach. There are as many rounds as there are distances and
    lengths of ways, not as there are arcs.
    """
    to, room, cost = [], [], []
    out: list[list[int]] = [[] for _ in range(n)]
    for a, b, capacity, price in arcs:
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to += [b, a]
        room += [capacity, 0]
        cost += [price, -price]
    height = [0] * n  # potentials, which keep reduced costs at 0 or above
    while True:
        far: list[float] = [math.inf] * n
        far[start], waiting = 0, [(0, start)]
        while waiting:
            d, a = heapq.heappop(waiting)
            if d > far[a]:
                continue
            for e in out[a]:
                if room[e]:
                    step = d + cost[e] + height[a] - height[to[e]]
                    if step < far[to[e]]:
                        far[to[e]] = step
                        heapq.heappush(waiting, (step, to[e]))
        if far[end] == math.inf:
            return room[1::2]
        reach = far[end]
        height = [h + min(d, reach) for h, d in zip(height, far)]
        while _block(out, to, room, cost, height, start, end):
            pass


def _block(out, to, room, cost, height, start, end) -> bool:
    """Fills all shortest ways by number of arcs within those of reduced cost 0; False if there is none."""
    n = len(out)

    def free(a: int, e: int) -> bool:
        return room[e] > 0 and cost[e] + height[a] == height[to[e]]

    level = [-1] * n
    level[start], queue = 0, [start]
    for a in queue:
        for e in out[a]:
            if level[to[e]] < 0 and free(a, e):
                level[to[e]] = level[a] + 1
                queue.append(to[e])
    if level[end] < 0:
        return False
    at, way = [0] * n, []
    a = start
    while True:
        if a == end:
            most = min(room[e] for e in way)
            for e in way:
                room[e] -= most
                room[e ^ 1] += most
            a, way = start, []
            continue
        while at[a] < len(out[a]):
            e = out[a][at[a]]
            if level[to[e]] == level[a] + 1 and free(a, e):
                break
            at[a] += 1
        if at[a] < len(out[a]):
            way.append(e)
            a = to[e]
        elif way:
            a = to[way.pop() ^ 1]
            at[a] += 1
        else:
            return True


def route(
    patterns: Sequence[tuple[Sequence[Source], int]], asked: dict[Source, int], costs: Sequence[int] = REPEAT_COSTS
) -> list[dict[Source, int]]:
    """Words each (sources, size) pattern gives to each of its sources."""
    names = in_order(list(asked))
    node = {s: 2 + len(patterns) + i for i, s in enumerate(names)}
    arcs = [(0, 2 + p, size, price) for p, (_, size) in enumerate(patterns) for price in costs]
    first = len(arcs)
    pairs = [(p, s) for p, (own, _) in enumerate(patterns) for s in own]
    arcs += [(2 + p, node[s], len(costs) * patterns[p][1], 0) for p, s in pairs]
    arcs += [(node[s], 1, asked[s], 0) for s in names]
    flow = min_cost_flow(2 + len(patterns) + len(names), arcs, 0, 1)
    given: list[dict[Source, int]] = [{} for _ in patterns]
    for (p, s), words in zip(pairs, flow[first:]):
        given[p][s] = words
    return given


class SourcePlan(NamedTuple):
    source: Source
    size: int
    target: float
    quota: int
    routed: int


class Mix(NamedTuple):
    """`documents`: doc_id, size, sources (array), taken; `sources`: what each has, should and will give."""

    documents: DataFrame
    sources: list[SourcePlan]


def mix(
    df: DataFrame,
    sources: Column,
    size: Column,
    weight: Callable[[int, Source], float],
    id_col: str = "doc_id",
    seed: int = SEED,
) -> Mix:
    """How often each document is taken. `weight` gets a source and its place in the order of all."""
    own = F.array_sort(F.array_distinct(F.coalesce(sources, F.array().cast("array<string>"))))
    sized = staged(
        df.select(F.col(id_col).cast("long").alias("doc_id"), size.alias("size"), own.alias("sources"))
        .withColumn("pattern", F.to_json("sources"))
        .withColumn("draw", F.xxhash64(F.lit(seed), "doc_id", "size"))
        .withColumn("row", F.monotonically_increasing_id()),
        "mix-sizes",
    )
    rows = sized.groupBy("pattern").agg(F.sum("size").alias("size")).orderBy("pattern").collect()
    patterns = [(json.loads(r["pattern"]), r["size"]) for r in rows]
    names = in_order({s for own, _ in patterns for s in own})
    sizes = dict.fromkeys(names, 0)
    for members, words_in in patterns:
        for s in members:
            sizes[s] += words_in
    wanted = targets([sizes[s] for s in names], [weight(i, s) for i, s in enumerate(names)], sum(n for _, n in patterns))
    asked = dict(zip(names, quotas(wanted)))
    given = route(patterns, asked)
    routed = {s: sum(g.get(s, 0) for g in given) for s in names}
    plan = _plan(sized, {r["pattern"]: sum(g.values()) for r, g in zip(rows, given)})
    taken = _select(sized, plan)
    report = [SourcePlan(s, sizes[s], t, asked[s], routed[s]) for s, t in zip(names, wanted)]
    return Mix(taken.select("doc_id", "size", "sources", "taken"), report)


def _plan(sized: DataFrame, words: dict[str, int]) -> list[tuple[str, int, int, int, bool]]:
    """For each pattern: longest document to take, whole repetitions, rest to draw, whether the rest is left out."""
    spark = sized.sparkSession
    asked = spark.createDataFrame(list(words.items()), "pattern string, words long")
    fits = F.col("size") <= F.col("words")
    rows = (
        sized.join(F.broadcast(asked) if len(words) <= MAX_BROADCAST_PATTERNS else asked, "pattern")
        .groupBy("pattern")
        .agg(F.sum(F.when(fits, F.col("size"))).alias("fitting"), F.min(F.when(~fits, F.col("size"))).alias("longer"))
        .collect()
    )
    plan = []
    for pattern, fitting, longer in rows:
        fitting, wanted, limit = fitting or 0, words[pattern], words[pattern]
        # Documents longer than all that is wanted are passed over, but for the shortest if that comes nearer.
        if longer and abs(fitting + longer - wanted) < wanted - REPEATS * fitting:
            fitting, limit = fitting + longer, longer
        times, rest = divmod(min(wanted, REPEATS * fitting), max(fitting, 1))
        # The smaller side is drawn, so that there are documents left of all sizes to fill a gap with.
        left_out = rest > fitting - rest > 0
        plan.append((pattern, limit, times, fitting - rest if left_out else rest, left_out))
    return plan


def _select(sized: DataFrame, plan: list[tuple[str, int, int, int, bool]]) -> DataFrame:
    """Adds `taken`: the whole repetitions of the pattern, and one more for the documents drawn, or for all others."""
    spark = sized.sparkSession

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if len(plan) <= MAX_BROADCAST_PATTERNS else df

    plans = spark.createDataFrame(plan, "pattern string, limit long, times long, rest long, left_out boolean")
    bucket = F.shiftrightunsigned(F.col("draw"), 64 - int(math.log2(BUCKETS)))
    drawn = sized.withColumn("bucket", bucket).join(small(plans), "pattern")
    drawn = drawn.withColumn("words", F.when(F.col("size") <= F.col("limit"), F.col("size")).otherwise(0))
    # The bucket in which the rest ends, and what the buckets before it hold.
    until = F.sum("n").over(W.partitionBy("pattern").orderBy("bucket"))
    edges = staged(
        drawn.groupBy("pattern", "bucket", "rest")
        .agg(F.sum("words").alias("n"))
        .withColumn("until", until)
        .where("until > rest")
        .groupBy("pattern", "rest")
        .agg(F.min("bucket").alias("edge"), F.min(F.col("until") - F.col("n")).alias("before")),
        "mix-edges",
    )
    placed = drawn.join(small(edges.drop("rest")), "pattern", "left")
    # Only one bucket a pattern is ordered.
    running = F.sum("words").over(W.partitionBy("pattern").orderBy("draw", "doc_id", "size", "row"))
    within = placed.where("bucket = edge").withColumn("fits", F.col("before") + running <= F.col("rest"))
    chosen = staged(within.where("fits").select("pattern", "row", "words"), "mix-edge-rows")
    filled = chosen.groupBy("pattern").agg(F.sum("words").alias("more"))
    gaps = staged(
        edges.join(filled, "pattern", "left").selectExpr("pattern", "edge", "rest - before - coalesce(more, 0) as gap").where("gap > 0"),
        "mix-gaps",
    )
    # One document of each size that may help; there are at most twice as many as the longest document has words.
    spare = (
        drawn.join(small(gaps), "pattern")
        .where("bucket >= edge and words > 0 and words < 2 * gap")
        .join(chosen.select("pattern", "row"), ["pattern", "row"], "left_anti")
        .groupBy("pattern", "words", "gap")
        .agg(F.min(F.struct("draw", "doc_id", "row")).alias("first"))
        .select("pattern", "words", "gap", F.col("first.row").alias("row"))
    )
    extra = staged(
        spare.groupBy("pattern").applyInPandas(_largest_first, "pattern string, row long").unionByName(chosen.drop("words")),
        "mix-extra",
    )
    before_edge = F.col("bucket") < F.coalesce("edge", F.lit(BUCKETS))
    drawn_rows = (F.col("rest") > 0) & (before_edge | F.coalesce("picked", F.lit(False)))
    return (
        placed.join(extra.withColumn("picked", F.lit(True)), ["pattern", "row"], "left")
        .withColumn("one_more", drawn_rows != F.col("left_out"))
        .withColumn("taken", F.col("words") * (F.col("times") + F.col("one_more").cast("long")))
    )


def _largest_first(rows: pd.DataFrame) -> pd.DataFrame:
    """Fills the gap with documents of falling size, and with one that does not fit if that comes nearer."""
    rows = rows.sort_values("words", ascending=False)
    gap, picked, over = int(rows["gap"].iloc[0]), [], []
    for i, size in enumerate(rows["words"].tolist()):
        if size <= gap:
            gap -= size
            picked.append(i)
        else:
            over.append((size, i))
    if over and min(over)[0] - gap < gap:
        picked.append(min(over)[1])
    return rows.iloc[picked][["pattern", "row"]]
