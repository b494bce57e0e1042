from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np

from linkharbor.llm import ranked_search as rs
from tests.llm.cases import frame, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def expected(docs, items, top=10):
    counted = [(doc, Counter(terms(text))) for doc, text in docs]
    counted = [(doc, c, sum(c.values())) for doc, c in counted if c]
    total, length = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = set()
    for item, own in asked.items():
        found = []
        for row, (doc, c, n) in enumerate(counted):
            m = 100 - 90 + (90 * n * total) // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in own
                if t in c
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0, row, doc))
        out |= {(item, rank, f[4], -f[0]) for rank, f in enumerate(sorted(found)[:top], 1)}
    return out


def test_terms():
    for text in ("", "Ab9_cÉ-Éa \x00\x7f x", "KK ①②, ABC", " a　b", "a'b"):
        assert [t.decode() for t in rs.terms_of(text.encode())] == terms(text)


def corpus():
    make = random.Random(8)
    words = [f"w{int(make.paretovariate(0.7)) % 3000}" for _ in range(6000)]
    docs = [(i, " ".join(make.choices(words, k=make.randint(0, 30)))) for i in range(6000)]
    copy = "The w1 w2 w3 passage, many times over."
    docs += [(10_000 + make.randrange(10**6), copy) for _ in range(3000)]  # ties, more than the ten of a list
    docs += [(7, docs[7][1]), (None, copy), (None, "w1 w1 w1"), (5, None), (6, ""), (8, "…!"), (9, prose(1, 60_000))]
    make.shuffle(docs)
    items = [(i, " ".join(make.choices(words, k=make.randint(1, 40)))) for i in range(25)]
    items += [(100, copy), (101, None), (102, ""), (103, "unseen"), (None, "w1 w5"), (104, "W1 w1"), (105, "w2"), (105, "w9")]
    return docs, items


def found(df):
    return {(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()}


def test_all_scores(spark):
    docs, items = corpus()
    index = rs.build_index(frame(spark, docs, 2))
    asked = spark.createDataFrame([(*i, 1, "x") for i in items], "item_id long, text string, doc_id int, term string")
    assert index.count() > 2
    assert found(rs.search(index, asked)) == expected(docs, items)


def test_sets_of_items(spark, monkeypatch):
    docs, items = corpus()
    docs, items = docs[:500], items[:9]
    asked = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(rs, "ITEM_TERMS", 20)  # read by the driver only
    assert found(rs.search(rs.build_index(frame(spark, docs)), asked, top=3)) == expected(docs, items, 3)


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    for docs, items in ((none, some), (some, none), (none, none)):
        assert rs.search(rs.build_index(docs), items, id_col="doc_id").count() == 0


def test_intervals():
    """Impacts that rise, fall or are all alike in document order: nothing is lost to a bound."""
    make = random.Random(2)
    for shape in range(30):
        size = make.choice((1, 64, 65, 700))
        lists = []
        for _ in range(make.randint(1, 6)):
            own = sorted(make.sample(range(size), make.randint(0, size)))
            impact = (lambda d: 1 + d, lambda d: 1 + size - d, lambda d: 5, lambda d: make.randint(1, 9))[shape % 4]
            lists.append([(d, impact(d)) for d in own])
        starts = np.cumsum([0] + [len(p) for p in lists])
        flat = [p for own in lists for p in own]
        ids = make.sample(range(10**6), size)
        block = rs.SearchBlock(
            ids, starts, np.array([d for d, _ in flat], np.int64), np.array([v for _, v in flat], np.int64)
        )
        weights = [make.randint(1, 4) for _ in lists]
        scores = Counter()
        for own, w in zip(lists, weights):
            for d, v in own:
                scores[d] += w * v
        best = sorted((-s, ids[d]) for d, s in scores.items())[:10]
        hits = block.best(np.arange(len(lists)), np.array(weights), [], 10)
        assert sorted((-s, doc) for s, _, doc in hits) == best
