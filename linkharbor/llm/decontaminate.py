"""Benchmark decontamination: SimHash over windows sized by the item, verified by weighted shingles.

Both sides are cut into windows at every word; a window's fingerprint is the SimHash of its five-word
shingles, the majority of each bit, counted for all windows of a length at once on whole 64-bit words.
Four 16-bit blocks index the items' fingerprints: two that differ in up to three bits agree in one
block, so all within the radius are found. An item has windows of two lengths:

- as long as the item, but for what is above the next of 8, 12, 16, 24, 32, ... shingles;
- the largest of 5, 7 and 9 words that fits whole into the longest piece that any stretch within the
  similarity bound must share with the item, however its edits are spread.

What is found is verified by the weight of the item's shingles, each counted as often as it occurs, that
the stretch of the document holds, first round each hit, then from the first hit of the item to the
last. Items of under five words have no shingle; they match where the document has their words in a row.

The benchmark goes to the tasks in blocks of a bounded number of words; the documents are read once
for each block, and never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkharbor.llm.common import batch_of, id_and_text, small_batches, staged, texts_of
from linkharbor.llm.shingles import SHINGLE, WordHashes, shingle_hashes

SIMILARITY = 0.8
RADIUS = 3
BLOCKS = 4
# Words of benchmark items that are sent to the tasks at a time.
BLOCK_WORDS = 1_000_000
# Words whose fingerprints are made at a time.
CHUNK = 1 << 14
# Words of a short window: odd numbers of shingles, so that no bit of a fingerprint is a tie.
SIZES = (5, 7, 9)
# Shingles of the shortest window that is sized by the item as a whole.
LEAST_LONG = 8

_LEAKS = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("similarity", pa.float64()), ("start_word", pa.int64())]
)


def window_size(words: np.ndarray) -> int:
    """Words of a window for an item, no more than the longest piece that any of its copies must keep.

    A verified stretch has half as many words again as the item and keeps SIMILARITY of its shingles.
    Where two pieces of the item meet in it, the shingles across are none of the item's: four, or fewer
    by the words that the item itself repeats in a row. That bounds the number of the pieces.
    """
    shingles = len(words) - SHINGLE + 1
    kept = math.ceil(SIMILARITY * shingles - 1e-9)
    held = len(words) + 2 * (len(words) // 4) - SHINGLE + 1
    across = SHINGLE - 1
    while across and len(np.unique(grams := shingle_hashes(words, SHINGLE - across))) < len(grams):
        across -= 1
    pieces = 1 + (held - kept) // across if across else kept
    clean = -(-kept // pieces) + SHINGLE - 1
    return max(s for s in SIZES if s <= clean)


def long_window(shingles: int) -> int:
    """Shingles of the window for the whole of an item: two leading binary digits, the rest zeros; 0 for a short item."""
    if shingles < LEAST_LONG:
        return 0
    step = 1 << shingles.bit_length() - 2
    return shingles // step * step


def _added(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    """Sum of two counters of all 64 bits, kept as binary digits: one array a digit, lowest first."""
    n = len(b[0])
    zero, carry, out = np.zeros(n, np.uint64), np.zeros(n, np.uint64), []
    for i in range(max(len(a), len(b))):
        x, y = (a[i][:n] if i < len(a) else zero), (b[i] if i < len(b) else zero)
        both = x ^ y
        out.append(both ^ carry)
        carry = (x & y) | (both & carry)
    return [*out, carry]


def _above(counter: list[np.ndarray], bound: int) -> np.ndarray:
    """The bits whose count is above the bound."""
    above = np.zeros_like(counter[0])
    equal = ~above
    for i in range(len(counter) - 1, -1, -1):
        if not bound >> i & 1:
            above |= equal & counter[i]
            equal &= ~counter[i]
        else:
            equal &= counter[i]
    return above


def window_prints(shingles: np.ndarray, sizes: list[int]) -> dict[int, np.ndarray]:
    """SimHash of the windows of each of the sizes, in shingles of at most two binary ones, at every start.

    A bit is set if more than half of the window's shingles have it. Counters of 1, 2, 4, ... shingles come
    of adding those of half the length; a window of two ones is one more addition.
    """
    out, counter, held = {}, [shingles], {}
    for k in range(max(sizes, default=0).bit_length()):
        step = 1 << k
        if k:
            if len(counter[0]) <= step // 2:
                break
            counter = _added(counter, [digit[step // 2 :] for digit in counter])
        held[step] = counter
    for size in sizes:
        high = 1 << size.bit_length() - 1
        if len(shingles) < size:
            out[size] = np.empty(0, np.uint64)
            continue
        total = held[high]
        if size - high:
            total = _added(total, [digit[high:] for digit in held[size - high]])
        out[size] = _above([digit[: len(shingles) - size + 1] for digit in total], size // 2)
    return out


class BlockIndex:
    """Fingerprints found by any of four 16-bit blocks, then compared in full."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.tables = []
        for b in range(BLOCKS):
            values = self._block(marks, b)
            order = np.argsort(values, kind="stable")
            count = np.bincount(values, minlength=1 << 16)
            self.tables.append((order, np.concatenate([[0], np.cumsum(count)]), count > 0))

    @staticmethod
    def _block(marks: np.ndarray, b: int) -> np.ndarray:
        return ((marks >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)

    def within(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (position in asked, position in marks) within the radius, each once."""
        left, right = [], []
        for b, (order, at, present) in enumerate(self.tables):
            values = self._block(asked, b)
            hit = np.flatnonzero(present[values])
            lengths = at[values[hit] + 1] - at[values[hit]]
            who = np.repeat(hit, lengths)
            inner = np.arange(len(who)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            mark = order[np.repeat(at[values[hit]], lengths) + inner]
            near = np.bitwise_count(asked[who] ^ self.marks[mark]) <= RADIUS
            left.append(who[near])
            right.append(mark[near])
        pairs = np.unique(np.concatenate(left) * len(self.marks) + np.concatenate(right))
        return pairs // max(len(self.marks), 1), pairs % max(len(self.marks), 1)


@dataclass
class Items:
    """A block of benchmark items, ready to be searched for."""

    ids: list[int | None]
    words: list[np.ndarray]

    def __post_init__(self) -> None:
        self.shingles = [shingle_hashes(w) for w in self.words]
        self.weights = [np.unique(s, return_counts=True) for s in self.shingles]
        owner: dict[int, list[np.ndarray]] = {}
        marks: dict[int, list[np.ndarray]] = {}
        self.short: dict[int, dict[int, list[int]]] = {}
        for i, shingles in enumerate(self.shingles):
            if len(shingles):
                sizes = {window_size(self.words[i]) - SHINGLE + 1, long_window(len(shingles))} - {0}
                for size, found in window_prints(shingles, sorted(sizes)).items():
                    owner.setdefault(size, []).append(np.stack([np.full(len(found), i), np.arange(len(found))], 1))
                    marks.setdefault(size, []).append(found)
            elif n := len(self.words[i]):
                own = self.short.setdefault(n, {})
                own.setdefault(int(shingle_hashes(self.words[i], n)[0]), []).append(i)
        self.sizes = sorted(marks)
        self.owner = {s: np.concatenate(owner[s]) for s in self.sizes}
        self.index = {s: BlockIndex(np.concatenate(marks[s])) for s in self.sizes}
        self.short_marks = {n: np.array(sorted(own), np.uint64) for n, own in self.short.items()}

    def similarity(self, item: int, shingles: np.ndarray) -> float:
        """Share of the weight of the item's shingles that is in the stretch."""
        wanted, counts = self.weights[item]
        at = np.minimum(np.searchsorted(wanted, shingles), len(wanted) - 1)
        have = np.bincount(at[wanted[at] == shingles], minlength=len(wanted))
        return int(np.minimum(have, counts).sum()) / int(counts.sum())

    def hits(self, texts: list[np.ndarray]) -> np.ndarray:
        """Rows (text, item, word of the text at which the item would begin), sorted, each once."""
        begins = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        shingles = shingle_hashes(np.concatenate(texts))
        longest = self.sizes[-1]
        sizes = [s for s in self.sizes if s + SHINGLE - 1 <= max(map(len, texts))]
        chunk, found = max(CHUNK, 2 * longest), [np.empty((0, 3), np.int64)]
        for at in range(0, len(shingles), chunk):
            prints = window_prints(shingles[at : at + chunk + longest - 1], sizes)
            for size in sizes:
                starts = np.arange(at, at + min(len(prints[size]), chunk))
                text = np.searchsorted(begins, starts, "right") - 1
                fits = starts + size + SHINGLE - 1 <= begins[text + 1]
                who, mark = self.index[size].within(prints[size][: len(starts)][fits])
                if len(who):
                    item, inner = self.owner[size][mark].T
                    text, starts = text[fits][who], starts[fits][who]
                    found.append(np.stack([text, item, starts - begins[text] - inner], axis=1))
        return np.unique(np.concatenate(found), axis=0)

    def leaks(self, texts: list[np.ndarray]) -> Iterator[tuple[int, int, float, int]]:
        """(text, item, similarity, first word) of the best stretch of each leaked item."""
        for n, own in self.short.items():
            for t, words in enumerate(texts):
                grams = shingle_hashes(words, n)
                here, first = np.unique(grams[np.isin(grams, self.short_marks[n])], return_index=True)
                where = np.flatnonzero(np.isin(grams, self.short_marks[n]))
                for gram, at in zip(here.tolist(), where[first].tolist() if len(here) else []):
                    yield from ((t, i, 1.0, at) for i in own[gram])
        if not self.sizes or not texts:
            return
        grouped: dict[tuple[int, int], list[int]] = {}
        for text, item, first in self.hits(texts).tolist():
            grouped.setdefault((text, item), []).append(first)
        for (text, item), firsts in grouped.items():
            n = len(self.words[item])
            margin = n // 4
            best, where = 0.0, 0
            for first in firsts:
                similar = self.similarity(item, shingle_hashes(texts[text][max(first - margin, 0) : max(first, 0) + n + margin]))
                if similar > best:
                    best, where = similar, max(first, 0)
            if best < SIMILARITY and len(firsts) > 1:
                # A copy that is drawn out by other words between its parts.
                where = max(firsts[0], 0)
                best = self.similarity(item, shingle_hashes(texts[text][max(firsts[0] - margin, 0) : max(firsts[-1], 0) + n + margin]))
            if best >= SIMILARITY:
                yield text, item, best, where


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int) -> Iterator[Items]:
    """Blocks of items in the order of their id, one at a time on the driver."""
    hashes, ids, words, total = WordHashes(), [], [], 0
    rows = id_and_text(benchmark, item_col, text_col).where("text <> ''").orderBy("id", "text")
    for row in rows.toLocalIterator():
        found = hashes.of(row["text"])
        if ids and total + len(found) > block_words:
            yield Items(ids, words)
            ids, words, total = [], [], 0
        ids.append(row["id"])
        words.append(found)
        total += len(found)
    if ids:
        yield Items(ids, words)


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """doc_id, item_id, similarity, start_word for each item that a document holds, at its best stretch.

    Case and everything but letters and digits is ignored. Null and empty texts hold nothing, null and empty
    items are not held. Rows with one id, or none, are searched one by one; so are repeated items. Empty
    tables give no rows; columns other than those named are not looked at.
    """
    rows = small_batches(id_and_text(documents, id_col, text_col))
    found = None
    for items in item_blocks(benchmark, item_col, text_col, block_words):
        part = rows.mapInArrow(_searcher(items), "doc_id long, item_id long, similarity double, start_word long")
        if found is not None:
            part = staged(part, "leaks")  # no more than two blocks are held at a time
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.selectExpr(
            "id as doc_id", "id as item_id", "cast(0 as double) as similarity", "id as start_word"
        ).where("false")
    return found


def _searcher(items: Items):
    def run(batches):
        hashes = WordHashes()
        for ids, texts in texts_of(batches):
            leaks = list(items.leaks([hashes.of(t) for t in texts]))
            yield batch_of(
                _LEAKS, [[ids[x[0]] for x in leaks], [items.ids[x[1]] for x in leaks], [x[2] for x in leaks], [x[3] for x in leaks]]
            )

    return run


def drop_leaked(
    documents: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id"
) -> DataFrame:
    """The rows, with all their columns, whatever their names, that hold no item; no shuffle.

    Null and empty texts stay, as do rows without an id; repeated rows stay or go together.
    """
    small_batches(documents)
    kept = None
    for items in item_blocks(benchmark, item_col, "text", BLOCK_WORDS):
        if kept is not None:
            kept = staged(kept, "kept")  # no more than two blocks are held at a time
        kept = (documents if kept is None else kept).mapInArrow(_keeper(items, text_col), documents.schema)
    return documents if kept is None else kept


def _keeper(items: Items, text_col: str):
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            words = [hashes.of(t or "") for t in batch.column(text_col).to_pylist()]
            leaked = {x[0] for x in items.leaks(words)}
            yield batch.filter(pa.array([i not in leaked for i in range(batch.num_rows)], pa.bool_()))

    return run
