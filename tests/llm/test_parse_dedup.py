from __future__ import annotations

import hashlib

import numpy as np
import pytest
from cases import frame, prose

from linkharbor.llm import parse_dedup
from linkharbor.llm.queries import QUERIES


def by_hand(rows):
    """Every 100-byte string in corpus order; rows that repeat id and text are one document."""
    seen: set[bytes] = set()
    results = {}
    distinct = {(d, t or "") for d, t in rows}
    mark = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for doc, text in sorted(distinct, key=lambda r: (r[0] is not None, r[0] or 0, mark(r[1]))):
        data = text.encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            string = data[i : i + 100]
            if string in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(string)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = len([s for s in bytes(gone).split(b"\0") if s])
        results[doc, text] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return sorted(((d, *results[d, t or ""]) for d, t in rows), key=repr)


def removed(df):
    return sorted((tuple(r)[:5] for r in parse_dedup.find_repeats(df).collect()), key=repr)


def cases():
    passage, other = prose(1, 90), prose(2, 40)
    rows = [(n, f"{prose(10 + n, n * 3)} {passage} {prose(60 + n, 20)}") for n in range(25)]
    rows += [(30 + n, passage[n : n + 99 + n % 3]) for n in range(8)]
    rows += [(50, "a" * 700), (51, "ab" * 300), (52, "b" * 99), (53, "a" * 101), (54, other * 5), (55, "é" * 200), (56, other)]
    rows += [(57, None), (58, ""), (59, prose(1, 90)), (60, passage[:150] + "#" + passage[151:])]
    return rows


def test_all_cases_against_every_string(spark):
    rows = cases()
    assert removed(frame(spark, rows, 5)) == by_hand(rows)


def test_repeated_and_missing_ids(spark):
    rows = [*cases()[:6], (3, prose(1, 90)), (None, prose(1, 90)), (None, prose(1, 90)), (2, cases()[2][1])]
    assert removed(frame(spark, rows)) == by_hand(rows)
    assert removed(frame(spark, rows).limit(0)) == []


def test_crowded_grams_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(parse_dedup, "CROWD", 3)
    rows = cases()
    assert removed(frame(spark, rows, 5)) == by_hand(rows)


def test_strings_of_one_hash_are_told_apart_by_their_bytes(spark, monkeypatch):
    """A hash of three values for strings: nearly all collide, and the result stays exact."""
    whole = parse_dedup._Strings.at

    def weak(self, distance, which=1):
        rows, hashed = whole(self, distance, which)
        return rows, hashed % np.uint64(3)

    rng = np.random.default_rng(7)
    texts = [rng.integers(97, 99, parse_dedup.LENGTH + 20).astype(np.uint8).tobytes() for _ in range(40)]
    around = [texts[n % 23] for n in range(60)]
    strings = parse_dedup._Strings(np.full(60, 30), around)
    salt = (np.arange(60) % 2).astype(np.uint64)
    expected = [strings.repeated(d, salt).tolist() for d in range(31)]
    monkeypatch.setattr(parse_dedup._Strings, "at", weak)
    assert [sorted(strings.repeated(d, salt).tolist()) for d in range(31)] == [sorted(e) for e in expected]
    assert any(expected)


def test_a_text_longer_than_a_part(spark):
    long = prose(5, 130_000)
    assert len(long.encode()) > parse_dedup.CHUNK
    rows = [(1, long), (2, long[300_000:300_500] + "x" + long[parse_dedup.CHUNK - 60 : parse_dedup.CHUNK + 140]), (3, long + long[:200])]
    assert removed(frame(spark, rows)) == by_hand(rows)


@pytest.mark.parametrize("chunk", [150, 400, 10_000])
def test_triggers_do_not_depend_on_the_parts(monkeypatch, chunk):
    texts = [prose(n, 5 * n).encode() for n in range(1, 30)] + [b"ab" * 500, b"", b"x" * 99]
    whole = parse_dedup.places_of(texts)
    monkeypatch.setattr(parse_dedup, "CHUNK", chunk)
    parted = parse_dedup.places_of(texts)
    for a, b in zip(whole, parted):
        assert (a == b).all()
    # each string holds a trigger, and none is further from the start of its string than REACH
    for i, text in enumerate(texts):
        at = np.sort(whole[3][whole[2] == i])
        for start in range(len(text) - parse_dedup.LENGTH + 1):
            j = np.searchsorted(at, start)
            assert j < len(at) and at[j] <= start + parse_dedup.REACH


def test_registered(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op8_substring_dedup"](spark, "/root/testdata/sf0.001")
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == by_hand([tuple(r) for r in rows])
