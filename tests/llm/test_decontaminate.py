from __future__ import annotations

from collections import Counter

import numpy as np
from cases import frame, prose, word_list

from linkharbor.llm import decontaminate as de
from linkharbor.llm.queries import QUERIES

ITEMS = "item_id long, text string, doc_id long"


def by_hand(docs, items):
    """Weighted containment of the item's shingles in the best stretch of a document, all stretches tried."""
    out = {}
    for item, text, *_ in items:
        words = word_list(text or "")
        wanted = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        if not wanted:
            continue
        for doc, body, *_ in docs:
            held = word_list(body or "")
            grams = [tuple(held[i : i + 5]) for i in range(len(held) - 4)]
            width = len(words) + 2 * (len(words) // 4) - 4
            best = 0.0
            for start in range(max(len(grams) - width, 0) + 1):
                have = Counter(g for g in grams[start : start + width] if g in wanted)
                best = max(best, sum((have & wanted).values()) / sum(wanted.values()))
            if best >= 0.8:
                out[doc, item] = best
    return out


def leaks(documents, benchmark, **more):
    found = de.find_leaks(documents, benchmark, **more).collect()
    return {(r["doc_id"], r["item_id"]): r["similarity"] for r in found}


def cases():
    items = [(n, prose(500 + n, n), 9) for n in (5, 6, 7, 9, 11, 14, 20, 28, 29, 33, 36, 47, 59, 90)]
    items += [(201, None, 9), (202, "", 9), (203, "too few words", 9), (204, items[5][1], 9)]
    docs = []
    for n, text, _ in items[:14]:
        words = text.split(" ")
        docs.append((n, f"{prose(n, 37)} {text} {prose(n + 1, 23)}"))
        docs.append((1000 + n, text.upper().replace(" ", "\n")))
        if n > 28:  # one word changed in the middle, one near the start
            changed = [*words[: n // 2], "other", *words[n // 2 + 1 :]]
            docs.append((2000 + n, f"{prose(n + 2, 11)} {' '.join(changed)}"))
        docs.append((3000 + n, " ".join(words[: max(n // 2, 1)])))  # half an item is none
    long = prose(77, 40_000).split(" ")
    long[39_000:39_000] = items[10][1].split(" ")
    docs += [(4000, " ".join(long)), (4001, None), (4002, ""), (4003, "...!!! ???"), (4000, items[9][1]), (None, items[8][1])]
    return docs, items


def test_every_leak_and_nothing_else(spark):
    docs, items = cases()
    got = leaks(frame(spark, docs), spark.createDataFrame(items, ITEMS))
    want = by_hand([d for d in docs if d[0] != 4000], items)
    assert {k: round(v, 9) for k, v in got.items() if k[0] != 4000} == {k: round(v, 9) for k, v in want.items()}
    assert {k[1] for k in got if k[0] == 4000} == {33, 36}  # the long text holds one item, its namesake another
    assert (14, 204) in got and (2059, 59) in got and (2036, 36) in got


def spread(words, places, edit):
    """The words with an edit at that many evenly spread places."""
    out, before = [], 0
    for k in range(places):
        at = (k + 1) * len(words) // (places + 1)
        out += [*words[before:at], *edit(words, at, k)]
        before = at + (edit is replaced)
    return " ".join(out + words[before:])


def replaced(words, at, k):
    return [f"other{k}"]


def inserted(words, at, k):
    return [f"other{k}"]


def doubled(words, at, k):  # the copy says the last word twice: three shingles less
    return [words[at - 1]]


def test_edits_spread_evenly_up_to_the_bound(spark):
    items, docs, wanted = [], [], set()
    for n in (29, 45, 54, 59, 79, 100, 104, 110, 150, 200, 300, 400):
        words = prose(n, n).split(" ")
        items.append((n, " ".join(words), 9))
        lost = (n - 4) // 5
        for e, (edit, cost) in enumerate(((replaced, 5), (inserted, 4), (doubled, 4))):
            doc = 10 * n + e
            docs.append((doc, f"{prose(n + 1, 31)} {spread(words, lost // cost, edit)} {prose(n + 2, 17)}"))
            wanted.add((doc, n))
    assert wanted <= set(by_hand(docs, items))
    assert set(leaks(frame(spark, docs), spark.createDataFrame(items, ITEMS))) >= wanted


def test_windows_of_items_that_repeat_words():
    words = np.arange(1, 201, dtype=np.uint64)
    assert de.window_size(words) == 9
    assert de.window_size(np.concatenate([words, words[50:51]])) == 7
    assert de.window_size(np.concatenate([words, words[50:54]])) == 5
    assert [de.window_size(words[:n]) for n in range(5, 10)] == [5, 5, 7, 5, 5]  # of 7 words, all must be there


def test_blocks_of_items_and_empty_tables(spark):
    docs, items = cases()
    few = [d for d in docs if d[0] in (14, 2036, 59, 4002)]
    documents, benchmark = frame(spark, few), spark.createDataFrame(items, ITEMS)
    assert leaks(documents, benchmark, block_words=40) == leaks(documents, benchmark)
    assert leaks(documents.limit(0), benchmark) == {}
    assert leaks(documents, benchmark.limit(0)) == {}


def test_kept_rows_have_their_columns(spark):
    docs, items = cases()
    documents = frame(spark, docs)
    kept = de.drop_leaked(documents, spark.createDataFrame(items, ITEMS))
    assert kept.columns == documents.columns
    leaked = {d for d, _ in by_hand([d for d in docs if d[0] != 4000], items)}
    assert {r["doc_id"] for r in kept.collect()} == {d[0] for d in docs} - leaked - {4000}


def test_a_task_holds_one_block_of_items(spark, monkeypatch):
    docs, items = cases()
    documents, benchmark = frame(spark, [d for d in docs if d[0] != 4000]), spark.createDataFrame(items, ITEMS)
    want = sorted(r["doc_id"] or 0 for r in de.drop_leaked(documents, benchmark).collect())
    monkeypatch.setattr(de, "BLOCK_WORDS", 150)
    assert len(list(de.item_blocks(benchmark, "item_id", "text", 150))) > 2
    kept = de.drop_leaked(documents, benchmark)
    assert kept.columns == documents.columns
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == want


def test_all_fingerprints_within_the_radius_are_found():
    make = np.random.default_rng(5)
    marks = make.integers(0, 2**63, 400, dtype=np.uint64)
    asked = np.concatenate([marks, make.integers(0, 2**63, 400, dtype=np.uint64)])
    for row in range(300):
        for bit in make.choice(64, make.integers(0, 6), replace=False):
            asked[row] ^= np.uint64(1) << np.uint64(bit)
    left, right = de.BlockIndex(marks).within(asked)
    want = {(i, j) for i in range(800) for j in range(400) if int(asked[i] ^ marks[j]).bit_count() <= de.RADIUS}
    assert set(zip(left.tolist(), right.tolist())) == want and len(want) > 100


def test_prints_are_majorities():
    make = np.random.default_rng(6)
    shingles = make.integers(0, 2**64, 300, dtype=np.uint64)
    sizes = [1, 3, 5, 8, 12, 16, 24, 32, 48, 96, 256, 384]
    for size, prints in de.window_prints(shingles, sizes).items():
        assert len(prints) == max(300 - size + 1, 0)
        for start in range(0, len(prints), 17):
            bits = np.unpackbits(shingles[start : start + size].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            want = np.packbits(bits.sum(axis=0) * 2 > size, bitorder="little").view(np.uint64)[0]
            assert prints[start] == want, (size, start)
    assert [de.long_window(n) for n in (1, 7, 8, 11, 12, 15, 16, 23, 25, 50, 100)] == [0, 0, 8, 8, 12, 12, 16, 16, 24, 48, 96]


def test_items_are_indexed_by_windows_of_their_size():
    words = np.random.default_rng(7).integers(1, 2**63, 60, dtype=np.uint64)
    items = de.Items([1], [words])
    assert items.sizes == [5, 48]
    # An unedited copy is found by the long windows alone.
    alone = de.Items([1], [words])
    alone.sizes = [48]
    text = np.concatenate([words[:7], words, words[:5]])
    assert [found[:3] for found in alone.leaks([text])] == [(0, 0, 1.0)]


def test_items_of_few_words(spark):
    items = [(1, "Zyx", 9), (2, "two words.", 9), (3, "and, then three", 9), (4, "one two three four", 9), (5, None, 9)]
    docs = [(1, "a zyx b ZYX"), (2, "two, (words) and then three"), (3, "zy x two w ords"), (4, "One two three... four"), (5, "one two three"), (6, "zyx")]
    benchmark = spark.createDataFrame(items, ITEMS)
    assert leaks(frame(spark, docs), benchmark) == {(1, 1): 1.0, (2, 2): 1.0, (2, 3): 1.0, (4, 4): 1.0, (6, 1): 1.0}
    assert {r["doc_id"] for r in de.drop_leaked(frame(spark, docs), benchmark).collect()} == {3, 5}


def test_copies_drawn_out_by_other_words(spark):
    words = prose(40, 80).split(" ")
    drawn = []
    for part in range(4):  # 12 of the 76 shingles are lost
        drawn += [*words[20 * part : 20 * part + 20], *prose(60 + part, 70).split(" ")]
    docs = [(1, " ".join(drawn)), (2, " ".join(drawn[:200])), (3, prose(41, 400))]
    assert leaks(frame(spark, docs), spark.createDataFrame([(7, " ".join(words), 9)], ITEMS)) == {(1, 7): 64 / 76}


def test_registered(spark):
    assert QUERIES["op1_decontamination"](spark, "/root/testdata/sf0.001").columns == [
        "doc_id", "item_id", "similarity", "start_word",
    ]
