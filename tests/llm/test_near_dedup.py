from __future__ import annotations

import random

import numpy as np
import pytest
from cases import frame, prose, shingle_set, word_list
from pyspark.sql import functions as F

from linkharbor.llm import near_dedup
from linkharbor.llm.queries import QUERIES


def by_hand(rows):
    """Smallest id reachable over pairs of Jaccard 0.8 or more, all pairs tried; rows of one id are one."""
    ids = sorted({d for d, _ in rows if d is not None})
    parent = {d: d for d in ids}

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    sets = [(d, shingle_set(t or "")) for d, t in rows if d is not None and word_list(t or "")]
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if len(x & y) >= 0.8 * len(x | y) and top(a) != top(b):
                low, high = sorted((top(a), top(b)))
                parent[high] = low
    return {d: top(d) for d in ids}


def changed(text: str, seed: int, places: int) -> str:
    make, words = random.Random(seed), text.split(" ")
    for i in make.sample(range(len(words)), places):
        words[i] = f"w{make.randint(0, 9**9)}"
    return " ".join(words)


def cases():
    rows = []
    for g in range(6):
        base = prose(g, 260 + 20 * g)
        rows += [(100 * g + 50, base)] + [(100 * g + n, changed(base, 10 * g + n, n % 5)) for n in range(12)]
    hub = prose(90, 400)  # each copy is near the hub, few are near each other
    rows += [(5000, hub)] + [(4900 + n, changed(hub, 300 + n, 8)) for n in range(40)]
    chain = prose(91, 300)
    for n in range(8):
        rows.append((6000 + n, chain))
        chain = changed(chain, 700 + n, 4)
    rows += [(7000, prose(92, 200)), (7001, prose(92, 200).upper().replace(" ", "\n")), (7002, prose(93, 30_000))]
    rows += [(8000, None), (8001, ""), (8002, "?!"), (8003, "one two"), (8004, "One, two."), (8005, "two one"), (None, prose(92, 200))]
    rows += [(9000, "twice the same row here and there"), (9000, "twice the same row here and there")]
    return rows


@pytest.fixture(scope="module")
def found(spark):
    return near_dedup.near_classes(frame(spark, cases())).collect()


def test_classes_against_all_pairs(found):
    rows = cases()
    assert len(found) == len(rows)
    want = by_hand(rows)
    assert {r["doc_id"]: r["class_id"] for r in found if r["doc_id"] is not None} == want
    assert [r["class_id"] for r in found if r["doc_id"] is None] == [None]
    assert len({want[d] for d in range(4900, 4940)}) == 1  # the hub holds its copies together


def repeating(n: int) -> list[tuple[int, str]]:
    """Pairs of near copies of which one repeats a third or a half of its text 10 to 20 times, and has an end of its own."""
    rows = []
    for g in range(n):
        words = prose(200 + g, 200).split(" ")
        part = 60 + 10 * (g % 5)
        again = [*words[:40], *words[40 : 40 + part] * (20 - g % 11), *words[40 + part :], *prose(900 + g, 20).split(" ")]
        rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join(again))]
    return rows


def test_near_copies_that_repeat_their_lines(spark):
    rows = repeating(40)
    want = by_hand(rows)
    assert all(want[d] == d - d % 2 for d in want)
    assert {r["doc_id"]: r["class_id"] for r in near_dedup.near_classes(frame(spark, rows)).collect()} == want


def test_one_of_each_class_stays(spark, found):
    df = frame(spark, cases())
    kept = near_dedup.drop_near_copies(df)
    assert kept.columns == df.columns
    want = sorted(r["doc_id"] for r in found if r["doc_id"] is not None and r["doc_id"] == r["class_id"])
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == want
    assert kept.where("doc_id is null").count() == 1
    assert near_dedup.near_classes(df.limit(0)).count() == 0
    assert near_dedup.near_classes(df.where("doc_id in (8000, 8001)")).count() == 2


def test_registers_estimate_the_probability_jaccard_similarity():
    make = np.random.default_rng(3)
    items = make.integers(1, 2**63, 300, dtype=np.uint64)
    weights = make.uniform(0.2, 5, 300)
    a = (items[:240], weights[:240])
    b = (items[60:], weights[60:] * make.uniform(0.7, 1.5, 240))
    rows = near_dedup.prob_min_hash([a, b, (items[:1], weights[:1])], 4096)
    left, right = dict(zip(*a)), dict(zip(*b))
    exact = sum(
        1 / sum(max(left.get(j, 0) / left[i], right.get(j, 0) / right[i]) for j in items) for i in left if i in right
    )
    assert abs((rows[0] == rows[1]).mean() - exact) < 0.03
    assert (rows[2] == items[0]).all()
    # the weights' scale does not matter, nor what else is in the batch
    again = near_dedup.prob_min_hash([(a[0], a[1] * 8)], 4096)
    assert (again[0] == rows[0]).all()


def linked_pairs(texts: dict[int, str]) -> list[tuple[int, int]]:
    """All pairs of different texts that are 0.8 alike by weight, every pair that shares a shingle tried."""
    hashes = near_dedup.WordHashes()
    sets, seen, holders = {}, set(), {}
    for doc, text in sorted(texts.items()):
        words = hashes.of(text or "")
        if len(words) and words.tobytes() not in seen:
            seen.add(words.tobytes())
            sets[doc] = near_dedup.weighted(words)
            for shingle in sets[doc]["shingle"].tolist():
                holders.setdefault(shingle, []).append(doc)
    pairs = {(a, b) for held in holders.values() for i, a in enumerate(held) for b in held[:i]}
    return [p for p in sorted(pairs) if near_dedup.weighted_jaccard(sets[p[0]], sets[p[1]]) >= 0.8]


def test_recall_against_all_pairs(spark):
    folder = "/root/testdata/sf0.1"  # sf0.01 has five links
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    links = linked_pairs({r["doc_id"]: r["text"] for r in rows})
    found = {r["doc_id"]: r["class_id"] for r in QUERIES["op9_near_dedup"](spark, folder).collect()}
    held = sum(found[a] == found[b] for a, b in links)
    print(f"recall at sf0.1: {held} of {len(links)} links of different texts")
    assert len(links) > 20 and held >= 0.99 * len(links)


def test_a_crowd_round_one_text(spark):
    """Copies with so many edits that few are near each other: links are found, and no class is made up."""
    base = prose(400, 150)
    rows = [(0, base)] + [(n, changed(base, 2000 + n, 1 + n % 9)) for n in range(1, 260)]
    links = linked_pairs(dict(rows))
    found = {r["doc_id"]: r["class_id"] for r in near_dedup.near_classes(frame(spark, rows)).collect()}
    assert sum(found[a] == found[b] for a, b in links) >= 0.99 * len(links)
    linked = {d for p in links for d in p}
    assert all(found[d] == d for d, _ in rows if d not in linked)


def test_no_link_of_a_bucket_is_left_to_chance(spark, monkeypatch):
    """Copies too far from their base, each with a near copy of its own, all in one bucket with one hub, and no long band."""
    base = prose(430, 150)
    rows = [(0, base)]
    for g in range(150):
        far = changed(base, 6000 + g, 4 + g % 3)
        rows += [(2 * g + 1, far), (2 * g + 2, changed(far, 8000 + g, 3))]
    links = linked_pairs(dict(rows))
    hubs = near_dedup.with_hubs
    monkeypatch.setattr(near_dedup, "with_hubs", lambda buckets: hubs(buckets.select(F.lit(1).alias("band"), "node").distinct()))
    monkeypatch.setattr(near_dedup, "MOST_APART", -1)
    monkeypatch.setattr(near_dedup, "BLOCK_NODES", 40, raising=False)
    found = {r["doc_id"]: r["class_id"] for r in near_dedup.near_classes(frame(spark, rows)).collect()}
    assert [p for p in links if found[p[0]] != found[p[1]]] == []
    linked = {d for p in links for d in p}
    assert all(found[d] == d for d, _ in rows if d not in linked)


def test_block_products_agree_with_single_pairs(monkeypatch):
    monkeypatch.setattr(near_dedup, "_COLUMNS", 7)
    base, hashes = prose(440, 120), near_dedup.WordHashes()
    texts = [near_dedup.weighted(hashes.of(changed(base, 20 + n, 1 + n % 6))) for n in range(24)]
    texts += [near_dedup.weighted(hashes.of(prose(441, 60))), texts[0][:0]]
    a, b = texts[:15], texts[11:]
    both = near_dedup.common_weights(a, b)
    weight = np.array([[np.intersect1d(x["shingle"], y["shingle"]).size and x["weight"][np.isin(x["shingle"], y["shingle"])].sum(dtype=float) for y in b] for x in a])
    assert np.allclose(both, weight)
    labels_a, labels_b = np.arange(15), np.arange(11, 11 + len(b))
    pairs = near_dedup.joining_pairs(a, b, labels_a, labels_b)
    every = [(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if i != j + 11 and near_dedup.weighted_jaccard(x, y) >= 0.8]
    assert every and set(pairs) <= set(every) and len(pairs) < len(texts)
    top = dict(zip(range(len(texts)), range(len(texts))))
    for i, j in pairs:
        old, new = top[i], top[j + 11]
        top = {k: new if v == old else v for k, v in top.items()}
    assert all(top[i] == top[j + 11] for i, j in every)


def test_long_bands_agree_with_the_registers():
    make = np.random.default_rng(2)
    signatures = make.integers(0, 2**63, (6, near_dedup.REGISTERS), dtype=np.uint64)
    signatures[1, :40] = signatures[0, :40]
    signatures[2] = signatures[0]
    keys = near_dedup.long_band_keys(near_dedup.sketches(signatures))
    assert keys.shape == (6, near_dedup.LONG_BANDS) and (keys[0] == keys[2]).all()
    assert len(np.unique(keys)) == 5 * near_dedup.LONG_BANDS


def test_shingles_weigh_by_their_letters():
    words = near_dedup.WordHashes().of("aa bbb c dddd ee aa bbb c dddd ee")
    found = near_dedup.weighted(words)
    assert len(found) == 5 and np.allclose(found["weight"], 1 + np.log2(12))
    other = near_dedup.weighted(near_dedup.WordHashes().of("aa bbb c dddd ee aa bbb c dddd longerword"))
    both, new = 5 * (1 + np.log2(12)), 1 + np.log2(20)
    assert abs(near_dedup.weighted_jaccard(found, other) - both / (both + new)) < 1e-6


def test_columns_that_clash(spark):
    text = prose(410, 100)
    df = spark.createDataFrame(
        [(1, text, 5, "x", 7, "k"), (2, text + " more", 6, None, 8, "k"), (3, None, 7, "x", 9, "k"), (None, text, 8, "x", 9, "k")],
        "doc_id long, text string, __gone long, node string, class_id long, gone string",
    )
    kept = near_dedup.drop_near_copies(df)
    assert kept.columns == df.columns
    assert sorted(r["__gone"] for r in kept.collect()) == [5, 7, 8]


def test_registered(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: r["class_id"] for r in QUERIES["op9_near_dedup"](spark, "/root/testdata/sf0.001").collect()}
    assert found == by_hand([tuple(r) for r in rows])
