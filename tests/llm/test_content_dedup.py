from __future__ import annotations

import hashlib
import string
from collections import defaultdict

from cases import frame, prose

from linkharbor.llm import content_dedup
from linkharbor.llm.queries import ORACLES, QUERIES

FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def by_hand(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[(text or "").translate(FOLD)].append(doc)
    out = []
    for text, docs in groups.items():
        keep = max((d for d in docs if d is not None), default=None)
        mark = hashlib.sha256(text.encode()).hexdigest()
        stays = False
        for doc in docs:
            out.append((doc, keep, len(docs), doc == keep and not stays, mark))
            stays |= doc == keep
    return sorted(out, key=repr)


def marked(df):
    found = content_dedup.mark_copies(df).select("id", "keep_id", "group_size", "kept", "text_sha256")
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_all_cases_against_plain_python(spark):
    long = prose(1, 60_000)
    rows = [
        (1, "Same"), (2, "same"), (3, "SAME"), (4, "Été"), (5, "été"), (6, ""), (7, None), (None, ""),
        (8, long), (9, long.upper()), (10, long + "x"), (11, "twice"), (11, "twice"), (None, "lost"), (None, "lost"),
        (-5, " same"), (12, "İ"), (13, "i̇"),
    ]
    assert marked(frame(spark, rows)) == by_hand(rows)


def test_a_text_that_fills_many_ranges(spark):
    rows = [(n, "Hot text" if n % 3 else f"cold {n}") for n in range(900)] + [(5, "Hot text")]
    assert marked(frame(spark, rows, 6)) == by_hand(rows)


def test_kept_rows_have_their_columns_and_an_empty_table_stays_empty(spark):
    df = frame(spark, [(1, "a"), (2, "A"), (3, None)])
    kept = content_dedup.drop_copies(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3]
    assert {r["text"] for r in kept.collect()} == {"A", None}
    assert content_dedup.drop_copies(df.limit(0)).count() == 0


def test_only_built_in_operators(spark):
    plan = content_dedup.mark_copies(frame(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "rangepartitioning" in plan


def test_registered(spark):
    assert QUERIES["op2_exact_dedup"](spark, "/root/testdata/sf0.001").count() == 200
    assert "op2_exact_dedup" in ORACLES
