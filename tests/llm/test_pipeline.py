"""The pipeline on a small corpus, stage by stage and as a whole, against plain Python."""

from __future__ import annotations

import pytest
from cases import prose, shingle_set, word_list

import corpus_pipeline
from linkharbor.llm.common import staged

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean texts in two languages, exact and near copies, leaks, and texts in no language."""
    letters = ("abcdefghi", "nopqrstuv")
    rows = [(i, prose(i, 80 + i, letters[i % 2]), ("aa", "bb")[i % 2]) for i in range(40)]
    rows += [(100 + i, rows[i][1].upper() if i % 2 else rows[i][1], rows[i][2]) for i in range(5)]
    for i in range(10, 14):
        words = rows[i][1].split(" ")
        words[40] = "changed"
        rows.append((200 + i, " ".join(words), rows[i][2]))
    items = [(n, prose(900 + n, 30 + n, letters[n % 2])) for n in range(4)]
    rows += [(300 + n, f"{prose(700 + n, 50, letters[n % 2])} {text} {prose(800 + n, 20, letters[n % 2])}", ("aa", "bb")[n % 2]) for n, text in items]
    rows += [(400, None, "aa"), (401, "", None), (402, "12 34 !!", "bb"), (None, prose(77, 90, letters[0]), None)]
    path = str(tmp_path_factory.mktemp("corpus"))
    table = [(d, t, g, "s", None if t is None else len(t)) for d, t, g in rows]
    spark.createDataFrame(table, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def by_hand(rows, items):
    """Ids left after each of the first four stages."""
    rows = [(d, t) for d, t in rows if t and any(c.isalpha() for c in t)]
    left = [{d for d, _ in rows}]
    last = {}
    for d, t in rows:
        key = "".join(c.lower() if c.isascii() else c for c in t)
        last[key] = max((d, last.get(key)), key=lambda x: -1 if x is None else x)
    rows = [(d, t) for d, t in rows if d in last.values()]
    left.append({d for d, _ in rows})
    sets = [(d, shingle_set(t)) for d, t in rows if d is not None]
    gone = {max(a, b) for a, x in sets for b, y in sets if a != b and len(x & y) >= 0.8 * len(x | y)}
    rows = [(d, t) for d, t in rows if d not in gone]
    left.append({d for d, _ in rows})
    wanted = [shingle_set(t) for _, t in items]
    rows = [(d, t) for d, t in rows if not any(len(w & shingle_set(t)) >= 0.8 * len(w) for w in wanted)]
    left.append({d for d, _ in rows})
    return left


def test_each_stage_does_what_plain_python_does(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    expected = by_hand(rows, items)
    assert [len(e) for e in expected] == sorted({len(e) for e in expected}, reverse=True)  # every stage drops some
    columns = docs.columns
    for (name, stage), want in zip(corpus_pipeline.STAGES, expected):
        docs = staged(stage(spark, docs, folder), name)
        assert docs.columns == columns
        assert {r["doc_id"] for r in docs.collect()} == want, name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r["doc_id"] for r in packed.collect()} == expected[-1]
    whole = corpus_pipeline.run(spark, folder)
    key = lambda r: (str(r["doc_id"]), r["start"], r["ids_crc32"])
    assert sorted(map(key, whole.collect())) == sorted(map(key, packed.collect()))
    assert all(word_list(t) for d, t in rows if d in expected[-1])


def test_stages_and_their_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "decontamination", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_no_documents(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
