"""Ranked lexical search: the highest-scoring documents of each item, found best interval first.

`build_index` reads the texts once and writes posting lists in blocks of documents; `search` answers a
set of items from it. A term is a maximal run of ASCII letters and digits and of all other characters
beyond ASCII, A-Z lower-cased. With N documents that hold a term, L terms in them all, n terms in one
document, df documents with a term and tf occurrences in one:

    w = floor(1000 ln((2 N + 2) / (2 df + 1)))      m = 10 + (90 n N) div L
    score = sum over the item's terms of w ((10^9 tf) div (1000 tf + 8 m)), in whole numbers

In a block each posting list gets a sparse table of range maxima over its impacts. The search of an
item starts from the interval of all documents of the block; an interval's bound is the sum of its
terms' range maxima. The interval of the highest bound is taken next and split at the document of its
largest term share, which is scored; intervals of at most LEAF documents are scored whole. Intervals
bounded below the tenth score found so far, in this or an earlier block of the task, are left. Results
are exact, and only the ten best of each item leave a task.

Memory: a block holds at most BLOCK_DOCS documents and, but for its last document, BLOCK_POSTINGS
postings. Items are asked in sets of about ITEM_TERMS terms, which are broadcast; the index is read once a set.

Nulls: a null or empty text has no term and is never found, a null item text finds nothing. A null
doc_id ranks after all others of its score; repeated rows are documents of their own. Rows with one
item_id are one item with the terms of all. Empty tables give no rows; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import math
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import from_arrow_schema

from linkharbor.llm.common import small_batches, staged
from linkharbor.session import broadcast_if_small

BLOCK_DOCS = 4096
BLOCK_POSTINGS = 1 << 19
LEAF = 64
ITEM_TERMS = 1 << 18

# Byte -> the byte a term has for it: A-Z lower-cased, blanks for the rest of ASCII but letters and digits.
_FOLD = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()

_INDEX = pa.schema(
    [("doc_ids", pa.list_(pa.int64())), ("lengths", pa.binary()), ("n_docs", pa.int64()), ("n_terms", pa.int64())]
    + [("terms", pa.list_(pa.string())), ("counts", pa.list_(pa.int32())), ("places", pa.binary()), ("tfs", pa.binary())]
)
_FOUND = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class _Block:
    """Collects the postings of a run of documents."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.doc_ids: list[int | None] = []
        self.lengths, self.term, self.place, self.tf = array("q"), array("i"), array("H"), array("I")

    def add(self, doc_id: int | None, terms: list[bytes]) -> None:
        counted, numbers = Counter(terms), self.numbers
        self.term.extend([numbers.setdefault(t, len(numbers)) for t in counted])
        self.tf.extend(counted.values())
        self.place.extend([len(self.doc_ids)] * len(counted))
        self.doc_ids.append(doc_id)
        self.lengths.append(len(terms))

    def full(self) -> bool:
        return len(self.doc_ids) >= BLOCK_DOCS or len(self.term) >= BLOCK_POSTINGS

    def row(self) -> pa.RecordBatch:
        term = np.frombuffer(self.term, np.int32)
        order = np.argsort(term, kind="stable")
        values = [
            self.doc_ids,
            self.lengths.tobytes(),
            len(self.doc_ids),
            sum(self.lengths),
            pa.array(list(self.numbers), pa.binary()).cast(pa.string()),
            pa.array(np.bincount(term, minlength=len(self.numbers)).astype(np.int32)),
            np.frombuffer(self.place, np.uint16)[order].tobytes(),
            np.frombuffer(self.tf, np.uint32)[order].tobytes(),
        ]
        columns = [
            pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) if isinstance(v, pa.Array) else pa.array([v], f.type)
            for v, f in zip(values, _INDEX)
        ]
        return pa.RecordBatch.from_arrays(columns, schema=_INDEX)


def build_index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per block of documents: ids, lengths, terms and their postings. Written to the shared folder."""

    def run(batches):
        block = _Block()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                terms = terms_of(text)
                if terms:
                    block.add(doc, terms)
                    if block.full():
                        yield block.row()
                        block = _Block()
        if block.doc_ids:
            yield block.row()

    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text is not null")
    return staged(small_batches(texts).mapInArrow(run, from_arrow_schema(_INDEX)), "lexical-index")


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, term), each once."""

    def run(batches):
        for batch in batches:
            found = [
                (item, term.decode())
                for item, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist())
                for term in set(terms_of(text))
            ]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["item", "term"])

    texts = items.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).alias("text")).where("text is not null")
    return texts.mapInArrow(run, "item long, term string").distinct()


def search(index: DataFrame, items: DataFrame, top: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score of the `top` documents of each item with a score above 0."""
    spark = index.sparkSession
    asked = staged(item_terms(items, id_col, text_col), "asked-terms")
    n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    listed = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).select(
        F.col("t.terms").alias("term"), F.col("t.counts").alias("n")
    )
    frequency = (
        listed.join(broadcast_if_small(asked.select("term").distinct()), "term").groupBy("term").agg(F.sum("n").alias("df"))
    )
    weighed = staged(asked.join(frequency, "term"), "asked-weights")
    sets = max(1, math.ceil(weighed.count() / ITEM_TERMS))
    own_set = F.pmod(F.xxhash64("item"), F.lit(sets))
    found = None
    for number in range(sets):
        rows = weighed.where(own_set == number).toArrow()
        part = _search_set(index, rows, n_docs or 0, n_terms or 0, top)
        part = part if sets == 1 else staged(part, "found")
        found = part if found is None else found.unionByName(part)
    best = W.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= top)
        .select(F.col("item").alias(id_col), "rank", "doc_id", "score")
    )


def _search_set(index: DataFrame, rows: pa.Table, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """The `top` best of each task for one set of items, given as (item, term, df)."""
    terms = pc.unique(rows["term"])
    number = pc.index_in(rows["term"], terms).to_numpy()
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in rows["df"].to_pylist()], np.int64)
    asked: dict[int | None, tuple[list[int], list[int]]] = {}
    for item, t, w in zip(rows["item"].to_pylist(), number.tolist(), weight.tolist()):
        if w > 0:
            own = asked.setdefault(item, ([], []))
            own[0].append(t)
            own[1].append(w)
    queries = {item: (np.array(t), np.array(w, np.int64)) for item, (t, w) in asked.items()}
    sent = index.sparkSession.sparkContext.broadcast((terms.combine_chunks() if isinstance(terms, pa.ChunkedArray) else terms, queries))

    def run(batches):
        terms, queries = sent.value
        best: dict[int | None, list] = {item: [] for item in queries}
        for batch in batches:
            for i in range(batch.num_rows):
                block = SearchBlock.of(batch.slice(i, 1), terms, n_docs, n_terms)
                for item, (numbers, weights) in queries.items():
                    best[item] = block.best(numbers, weights, best[item], top)
        found = [(item, doc, score) for item, hits in best.items() for score, _, doc in hits]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), _FOUND)], schema=_FOUND)

    columns = ("doc_ids", "lengths", "terms", "counts", "places", "tfs")
    return small_batches(index.select(*columns)).mapInArrow(run, from_arrow_schema(_FOUND))


class SearchBlock:
    """The posting lists of the asked terms in one block, with sparse tables of range maxima."""

    def __init__(self, doc_ids: list[int | None], starts: np.ndarray, places: np.ndarray, impacts: np.ndarray) -> None:
        """`starts` has where the list of each asked term begins, and the end of the last."""
        self.doc_ids, self.starts, self.places, self.impacts = doc_ids, starts, places, impacts
        self.size = len(doc_ids)
        sizes = np.diff(starts)
        self.keys = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes) * self.size + places
        # Row k: the place of the largest impact among 2^k postings from here. Lists lie one behind the
        # other; a range is asked within one list only, so ranges across borders do no harm.
        table = [np.arange(len(places), dtype=np.int32)]
        while 2 << len(table) - 1 <= sizes.max(initial=0):
            last, step = table[-1], 1 << len(table) - 1
            left, right = last[:-step], last[step:]
            row = last.copy()
            row[:-step] = np.where(impacts[left] >= impacts[right], left, right)
            table.append(row)
        self.table = np.stack(table)

    @classmethod
    def of(cls, row: pa.RecordBatch, terms: pa.Array, n_docs: int, n_terms: int) -> SearchBlock:
        column = {name: row.column(i) for i, name in enumerate(row.schema.names)}
        lengths = np.frombuffer(column["lengths"][0].as_py(), np.int64)
        counts = column["counts"].flatten().to_numpy().astype(np.int64)
        ends = np.cumsum(counts)
        number = pc.index_in(terms, value_set=column["terms"].flatten()).to_numpy(zero_copy_only=False)
        here = ~np.isnan(number)
        own = number[here].astype(np.int64)
        sizes = np.zeros(len(terms), np.int64)
        sizes[here] = counts[own]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        taken = _ranges(ends[own] - counts[own], ends[own])
        places = np.frombuffer(column["places"][0].as_py(), np.uint16)[taken].astype(np.int64)
        tf = np.frombuffer(column["tfs"][0].as_py(), np.uint32)[taken].astype(np.int64)
        m = 10 + 90 * lengths * n_docs // n_terms
        return cls(column["doc_ids"].flatten().to_pylist(), starts, places, 10**9 * tf // (1000 * tf + 8 * m[places]))

    def best(self, terms: np.ndarray, weights: np.ndarray, hits: list, top: int) -> list:
        """The `top` best of `hits` and this block, as a heap of (score, order by id, doc_id)."""
        first, last = self.starts[terms], self.starts[terms + 1]
        here = first < last
        terms, weights, first, last = terms[here], weights[here], first[here], last[here]
        if not len(terms):
            return hits
        hits = list(hits)
        impacts, places, table, base = self.impacts, self.places, self.table, terms * self.size
        waiting: list[tuple] = []
        made = 0

        def offer(score: int, place: int) -> None:
            doc = self.doc_ids[place]
            hit = (score, (-math.inf if doc is None else -doc), doc)
            if len(hits) < top:
                heapq.heappush(hits, hit)
            elif hit[:2] > hits[0][:2]:
                heapq.heapreplace(hits, hit)

        def wait(low: int, high: int, a: np.ndarray, b: np.ndarray) -> None:
            nonlocal made
            some = np.flatnonzero(a < b)
            if not len(some):
                return
            left, right = a[some], b[some]
            k = np.frexp(right - left)[1] - 1  # the largest power of two within the range
            one, other = table[k, left], table[k, right - (1 << k)]
            peak = np.where(impacts[one] >= impacts[other], one, other)
            share = weights[some] * impacts[peak]
            bound = int(share.sum())
            # Of equal scores the smaller id stays, so only a bound below the last score rules out.
            if len(hits) < top or bound >= hits[0][0]:
                made += 1
                heapq.heappush(waiting, (-bound, made, low, high, a, b, int(places[peak[share.argmax()]])))

        wait(0, self.size, first, last)
        while waiting:
            bound, _, low, high, a, b, place = heapq.heappop(waiting)
            if len(hits) >= top and -bound < hits[0][0]:
                break
            if high - low <= LEAF:
                scores = np.zeros(high - low, np.int64)
                taken = _ranges(a, b)
                np.add.at(scores, places[taken] - low, np.repeat(weights, b - a) * impacts[taken])
                least = hits[0][0] if len(hits) >= top else 1
                for i in np.flatnonzero(scores >= least).tolist():
                    offer(int(scores[i]), low + i)
                continue
            at = np.searchsorted(self.keys, base + place)
            at = np.clip(at, a, b)
            same = at < b
            same[same] = places[at[same]] == place
            offer(int((weights[same] * impacts[at[same]]).sum()), place)
            wait(low, place, a, at)
            wait(place + 1, high, at + same, b)
        return hits


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [first, last), one range behind the other."""
    sizes = last - first
    before = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(first - before, sizes)
