"""Encoders, counts, files and packing against the libraries themselves."""

from __future__ import annotations

import zlib
from array import array
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from cases import frame, prose
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from linkharbor.llm import packing, pieces, token_count, token_files
from linkharbor.llm.pieces import Encoder
from linkharbor.llm.queries import QUERIES

BYTES, WORDS, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
ENCODERS = {p: Encoder(p) for p in (BYTES, WORDS)}
LIBRARY = {p: Tokenizer.from_file(p) for p in (BYTES, WORDS)}
SPM = sentencepiece.SentencePieceProcessor(model_file=PIECES)

EDGE = st.text(alphabet=" \n\t.,'!|ab'sReéßÉĳŉ日ł<|>▁_09\x1c  ", max_size=40)
PLAIN = st.lists(st.sampled_from(["Thing", "don't", "a.b", "x\n", "\ny", "", "été,", "$$$", "1234", "it's"]), max_size=12).map(" ".join)
TEXTS = [None, "", " ", "\n", prose(3, 9000), "a" * 50_000, "<|endoftext|> x <|startoftext|>", "x  y ", " lead", "日本語 text", "\x00"]


def crc(ids) -> int:
    return zlib.crc32(array("I", ids).tobytes())


def library_ids(path: str, text: str | None) -> list[int]:
    return LIBRARY[path].encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.one_of(EDGE, PLAIN, st.text(max_size=30)))
def test_ids_are_those_of_the_library(text):
    for path, encoder in ENCODERS.items():
        assert list(array("I", encoder.ids(text))) == library_ids(path, text)


@settings(max_examples=300, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(EDGE, PLAIN, st.text(max_size=30)), max_size=8), st.integers(1, 12))
def test_ids_of_many_texts_are_those_of_the_library(texts, entries):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pieces, "TABLE_ENTRIES", entries)
        patch.setattr(pieces, "TABLE_IDS", 4 * entries)
        patch.setattr(pieces, "BLOCK_WORDS", 3)
        patch.setattr(pieces, "COLUMN_LETTERS", 0)
        for path, encoder in ENCODERS.items():
            found = [list(array("I", ids)) for ids in encoder.ids_of_texts(texts)]
            assert found == [library_ids(path, text) for text in texts]
            assert len(encoder.table.words) <= entries and len(encoder.table.ids) <= 4 * entries


@pytest.mark.parametrize("letters", [0, 1 << 20])
@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_odd_texts_at_once(path, letters, monkeypatch):
    monkeypatch.setattr(pieces, "COLUMN_LETTERS", letters)
    texts = [t or "" for t in TEXTS] + ["a, b. c., d.. .e ., x9, 9. été, é. '. 's, it's. ab\n, ab.\n c", ", .", "one", " a,"]
    encoder = Encoder(path)
    for _ in range(2):  # the second time from the table
        assert [list(array("I", ids)) for ids in encoder.ids_of_texts(texts)] == [library_ids(path, t) for t in texts]
    assert encoder.ids_of_texts([]) == [] and encoder.ids_of_texts([""]) == [b""]


def test_frequent_words_outlast_a_flood_of_others(monkeypatch):
    monkeypatch.setattr(pieces, "TABLE_ENTRIES", 100)
    monkeypatch.setattr(pieces, "COLUMN_LETTERS", 0)
    encoder, asked = Encoder(BYTES), []
    inner = encoder.table.encode
    monkeypatch.setattr(encoder.table, "encode", lambda words: asked.extend(words.to_pylist()) or inner(words))
    for i in range(50):
        rare = [f"rare{i}x{j}" for j in range(40)]
        encoder.ids_of_texts([f"the often, {w} often." for w in rare])
    assert asked.count("often") == 1  # with a stop or comma behind it or not
    assert len(asked) == len(set(asked)) == 50 * 40 + 3
    assert len(encoder.table.words) <= 100


@settings(max_examples=300, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.one_of(EDGE, PLAIN, st.text(max_size=30)))
def test_counts_are_those_of_the_library(text):
    counts = token_count._Counts(PIECES, token_count.whole_tokens(PIECES))
    assert counts.of(text) == len(SPM.encode(text))


def test_counts_of_a_table(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "x"), (3, "\n")]
    found = [tuple(r) for r in token_count.count_tokens(frame(spark, rows), PIECES, limit=100).collect()]
    want = [(d, len((t or "").encode()), n := len(SPM.encode(t or "")), n > 100) for d, t in rows]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert token_count.count_tokens(frame(spark, rows).limit(0), PIECES).count() == 0


def test_files_give_every_document_back(spark, tmp_path):
    rows = [(i * 7 % 11, t) for i, t in enumerate(TEXTS)] + [(None, "x"), (20, "twice"), (20, "twice")]
    manifest = token_files.write_token_files(frame(spark, rows), BYTES, 0, str(tmp_path / "out"))
    want, at = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*library_ids(BYTES, text), 0]
        want.append((doc, at, len(ids), crc(ids)))
        at += len(ids)
    found = [tuple(r) for r in token_files.read_token_files(manifest).collect()]
    assert sorted(found, key=lambda r: r[1]) == want
    assert len(list((tmp_path / "out").glob("*.zst"))) == manifest.select("file").distinct().count()
    empty = token_files.write_token_files(frame(spark, rows).limit(0), BYTES, 0)
    assert token_files.read_token_files(empty).count() == 0


def test_files_of_texts_looked_up_by_the_column(spark, tmp_path):
    texts = [prose(i, 500) for i in range(50)] + [t or "" for t in TEXTS]
    encoded = {t: [*library_ids(BYTES, t), 0] for t in texts}
    rows = [(i, texts[i * 7 % len(texts)]) for i in range(6000)]
    assert sum(len(t) for _, t in rows) > 9 * pieces.COLUMN_LETTERS  # more than one a task
    manifest = token_files.write_token_files(frame(spark, rows), BYTES, 0, str(tmp_path / "out"))
    at = 0
    for row, (doc, text) in zip(sorted(token_files.read_token_files(manifest).collect()), rows, strict=True):
        ids = encoded[text]
        assert tuple(row) == (doc, at, len(ids), crc(ids))
        at += len(ids)


def test_a_reader_opens_only_the_frames_it_needs_and_sees_damage(tmp_path):
    import zstandard

    path = tmp_path / "t.zst"
    writer = token_files.TokenWriter(f"file://{path}")
    texts = [array("I", range(n, n + size)).tobytes() for n, size in ((0, 10), (5, 200_000), (9, 1), (3, 70_000))]
    places = [(writer.append(t), len(t) // 4) for t in texts]
    writer.close()
    reader = token_files.TokenReader(f"file://{path}")
    opened = []
    inner = reader._frame
    reader._frame = lambda i: opened.append(i) or inner(i)
    assert [reader.ids(*p) for p in reversed(places)] == texts[::-1]
    opened.clear()
    reader.ids(*places[0])
    assert opened == [0]
    # any zstandard tool reads the frames; the seek table is skipped
    data = path.read_bytes()
    assert zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read() == b"".join(texts)
    broken = bytearray(data)
    broken[60] ^= 1
    path.write_bytes(broken)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        token_files.TokenReader(f"file://{path}").ids(*places[0])


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 200), max_size=20))
def test_patterns_hold_every_length_once(histogram):
    patterns = packing.shortest_pack_first(histogram, 64)
    held: Counter = Counter()
    for pattern, count in patterns:
        assert sum(pattern) <= 64 and count > 0
        for length in pattern:
            held[length] += count
    assert held == Counter(histogram)
    total = sum(length * n for length, n in histogram.items())
    if total:
        assert sum(c for _, c in patterns) <= 2 * -(-total // 64)


def test_packed_sequences(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, prose(i, i % 50)) for i in range(200)] + [(None, "x"), (100, "y"), (100, "y")]
    found = packing.pack(frame(spark, rows), WORDS, 2, limit=512).collect()
    want = Counter()
    for doc, text in rows:
        ids = [*library_ids(WORDS, text), 2]
        for start in range(0, len(ids), 512):
            piece = ids[start : start + 512]
            want[doc, start, len(piece), crc(piece), len(ids)] += 1
    assert Counter(tuple(r)[:5] for r in found) == want
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 512
    assert sum(r["length"] for r in found) / len(sequences) / 512 > 0.9
    assert packing.pack(frame(spark, rows).limit(0), WORDS, 2).count() == 0


def test_registered(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op5_token_counts"](spark, folder).collect():
        assert r["n_tokens"] == len(SPM.encode(texts[r["doc_id"]]))
    at = 0
    for r in sorted(QUERIES["op7_token_files"](spark, folder).collect(), key=lambda r: r["doc_id"]):
        ids = [*library_ids(BYTES, texts[r["doc_id"]]), 0]
        assert tuple(r) == (r["doc_id"], at, len(ids), crc(ids))
        at += len(ids)
    for r in QUERIES["op4_packing"](spark, folder).collect():
        ids = [*library_ids(WORDS, texts[r["doc_id"]]), 2]
        assert r["ids_crc32"] == crc(ids[r["start"] : r["start"] + r["length"]])
