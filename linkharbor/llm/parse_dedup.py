"""Removal of repeated substrings by prefix-free parsing, over the whole corpus.

Every byte is removed that a LENGTH-byte string covers which also starts earlier (smaller id, or same
document and earlier start). Strings are judged on the input and never cross documents.

Parsing. A rolling hash runs over GRAM bytes; its smallest value in each LENGTH-byte string triggers
there. Triggers depend on the string alone, so equal strings trigger at the same place, and they cut
the corpus into phrases of bounded length. A trigger's entry is the text around it that strings which
trigger there can reach: REACH bytes before it and LENGTH after it. The dictionary holds each distinct
entry with its first place; the parse is the list of all places.

Corpus order. Strings that trigger with different grams differ, so only entries of one gram need
comparing. A place that is not its entry's first repeats the whole entry; entries agree by two 64-bit
hashes (gram and surroundings). For first places of a gram with several entries, hashes replace the suffix
arrays of dictionary and parse: for each distance to the trigger, the hashes of their strings are sorted,
and of equal ones all but the first place are compared with it byte by byte; equal bytes repeat. Work and
memory follow the number of distinct entries, not of their repetitions.

Skew. Entries are merged within each task before they are shuffled, so a passage in a third of all
texts sends one row per task. A gram with more than CROWD different surroundings (what one task holds at a time), such as the last
bytes of that passage, is spread by the hashes of its strings instead. The strings of one gram do not meet
there, so these hashes have 128 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from linkharbor.llm.common import batch_of, id_and_text, small_batches, staged, texts_of
from linkharbor.llm.shingles import mixed

LENGTH = 100
GRAM = 32
REACH = LENGTH - GRAM  # bytes of a string before its trigger, at most
CROWD = 1 << 15
# Bytes that are hashed at a time.
CHUNK = 1 << 19

_PARSE = pa.schema([("gram", pa.int64()), ("entry", pa.int64()), ("doc", pa.int64()), ("at", pa.int64()), ("reach", pa.int64())])
_AROUND = pa.schema(
    [("gram", pa.int64()), ("doc", pa.int64()), ("at", pa.int64()), ("before", pa.int64()), ("bytes", pa.binary()), ("crowded", pa.bool_())]
)
_SPANS = pa.schema([("doc", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
_WINDOWS = pa.schema([("string", pa.int64()), ("check", pa.int64()), ("doc", pa.int64()), ("at", pa.int64())])
_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()),
        ("starts", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int64())),
    ]
)

_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # odd, so powers have inverses modulo 2**64
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_LETTERS = [mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(b)) for b in _BASES]


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse."""
    if which not in _POWERS or len(_POWERS[which][0]) < n:
        base = _BASES[which]
        size = max(n, 2 * CHUNK + 4 * LENGTH)
        both = []
        for factor in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, np.uint64(factor))
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        _POWERS[which] = (both[0], both[1])
    return _POWERS[which]


class Rolling:
    """Hashes of any substring of a byte array."""

    def __init__(self, data: np.ndarray, which: int):
        powers, self.inverse = _powers(which, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_LETTERS[which][data] * powers[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.inverse[start])


def triggers(data: np.ndarray, rolling: Rolling, begins: np.ndarray) -> np.ndarray:
    """Places where a LENGTH-byte string within one document has the smallest gram hash, the last of equals."""
    n = len(data) - GRAM + 1
    if len(data) < LENGTH:
        return np.empty(0, dtype=np.int64)
    places = np.arange(n, dtype=np.uint64)
    low = np.uint64((1 << 22) - 1)
    grams = mixed((rolling.sums[GRAM:] - rolling.sums[:-GRAM]) * rolling.inverse[:n])
    least = (grams & ~low) | (low - places)
    width, want = 1, REACH + 1
    while width * 2 <= want:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < want:
        least = np.minimum(least[: len(least) - (want - width)], least[want - width :])
    starts = np.arange(len(least))
    inside = np.searchsorted(begins, starts, "right") == np.searchsorted(begins, starts + LENGTH - 1, "right")
    least = least[inside]
    if not len(least):
        return np.empty(0, dtype=np.int64)
    least = least[np.concatenate([[True], least[1:] != least[:-1]])]
    return np.unique((low - (least & low)).astype(np.int64))


def parts(texts: list[bytes]):
    """Groups of whole texts of about CHUNK bytes, and overlapping parts of longer ones.

    Yields (data, begins, first text, offset in it, from, to): places in [from, to) belong to this part.
    """
    group: list[bytes] = []
    first = 0
    for i, text in enumerate(texts):
        if len(text) > CHUNK:
            if group:
                yield _joined(group, first)
            margin = 2 * LENGTH
            for at in range(0, len(text), CHUNK):
                lo, hi = max(at - margin, 0), min(at + CHUNK + margin, len(text))
                data = np.frombuffer(text, np.uint8, hi - lo, lo)
                yield data, np.array([0]), i, lo, at - lo, min(at + CHUNK, len(text)) - lo
            group, first = [], i + 1
            continue
        group.append(text)
        if sum(map(len, group)) > CHUNK:
            yield _joined(group, first)
            group, first = [], i + 1
    if group:
        yield _joined(group, first)


def _joined(group: list[bytes], first: int):
    data = np.frombuffer(b"".join(group), np.uint8)
    begins = np.cumsum([0, *map(len, group[:-1])])
    return data, begins, first, 0, 0, len(data)


def places_of(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(gram, entry, text, place, bytes before, bytes from it on) of every trigger; the last two are clipped."""
    found = []
    for data, begins, first, offset, lo, hi in parts(texts):
        rolling = [Rolling(data, w) for w in (0, 1)]
        at = triggers(data, rolling[0], begins)
        at = at[(at >= lo) & (at < hi)]
        text = np.searchsorted(begins, at, "right") - 1
        ends = np.append(begins[1:], len(data))
        before = np.minimum(at - begins[text], REACH)
        after = np.minimum(ends[text] - at, LENGTH)
        gram = rolling[0].of(at, at + GRAM)
        entry = rolling[1].of(at - before, at + after) ^ mixed((before * 256 + after).astype(np.uint64))
        found.append((gram.view(np.int64), entry.view(np.int64), first + text, at - begins[text] + offset, before, after))
    if not found:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(6))
    return tuple(np.concatenate(c) for c in zip(*found))


def merge_spans(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of the spans of each document."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    new = np.concatenate([[True], doc[1:] != doc[:-1]])
    segment = np.cumsum(new) - 1
    # The furthest end so far, within each document.
    stretch = int(end.max()) + 1
    furthest = np.maximum.accumulate(end + segment * stretch) - segment * stretch
    opens = new.copy()
    opens[1:] |= start[1:] > furthest[:-1]
    at = np.flatnonzero(opens)
    return doc[at], start[at], furthest[np.append(at[1:], len(doc)) - 1]


def _parse(batches):
    """The parse, merged within the task.

    A row with a gram is the first place of its entry in this task; `reach` is 256 x bytes before it + bytes
    from it on. A row without is a span (`at`, length `reach`) that repeats an entry within the task.
    """
    kept: list[tuple[np.ndarray, ...]] = []
    size = 0
    for ids, texts in texts_of(batches):
        gram, entry, text, at, before, after = places_of([t.encode() for t in texts])
        doc = np.array(ids, dtype=np.int64)[text]
        kept.append((gram, entry, doc, at, before, after))
        size += len(gram)
        if size > 1_000_000:
            yield from _first_places(kept)
            kept, size = [], 0
    if size:
        yield from _first_places(kept)


def _first_places(kept):
    gram, entry, doc, at, before, after = (np.concatenate(c) for c in zip(*kept))
    order = np.lexsort((at, doc, entry, gram))
    gram, entry, doc, at, before, after = (c[order] for c in (gram, entry, doc, at, before, after))
    again = np.zeros(len(gram), dtype=bool)
    again[1:] = (gram[1:] == gram[:-1]) & (entry[1:] == entry[:-1])
    first = ~again
    yield batch_of(_PARSE, [gram[first], entry[first], doc[first], at[first], (before * 256 + after)[first]])
    doc, start, end = merge_spans(doc[again], (at - before)[again], (at + after)[again])
    empty = pa.nulls(len(doc), pa.int64())
    yield batch_of(_PARSE, [empty, empty, doc, start, end - start])


def _surroundings(batches):
    """The bytes around the open triggers of each document (doc, text, places, crowded places)."""
    for batch in batches:
        out = [], [], [], [], [], []
        for doc, text, *places in zip(*(batch.column(i).to_pylist() for i in range(4))):
            data = text.encode()
            for crowded in (False, True):
                for at in places[crowded]:
                    before = min(at, REACH)
                    gram = int.from_bytes(
                        hashlib.blake2b(data[at : at + GRAM], digest_size=8).digest(), "little", signed=True
                    )
                    row = (gram, doc, at, before, data[at - before : at + LENGTH], crowded)
                    for column, value in zip(out, row):
                        column.append(value)
        yield batch_of(_AROUND, list(out))


class _Strings:
    """Hashes of the strings of many surroundings, one column of places for each distance to the trigger."""

    def __init__(self, before: np.ndarray, around: list[bytes]):
        n, width = len(around), REACH + LENGTH
        self.block = block = np.zeros((n, width), dtype=np.uint8)
        self.before, self.after = before, np.array([len(a) for a in around], dtype=np.int64) - before
        flat = np.frombuffer(b"".join(around), np.uint8)
        row = np.repeat(np.arange(n), self.before + self.after)
        begins = np.cumsum(self.before + self.after) - (self.before + self.after)
        column = np.arange(len(flat)) - begins[row] + REACH - self.before[row]
        block[row, column] = flat
        self.sums: dict[int, np.ndarray] = {}

    def at(self, distance: int, which: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """(rows that have the string, their hashes) of strings that start so many bytes before the trigger."""
        rows = np.flatnonzero((self.before >= distance) & (self.after >= LENGTH - distance))
        start = REACH - distance
        if which not in self.sums:
            n, width = self.block.shape
            powers, _ = _powers(which, width + 1)
            sums = self.sums[which] = np.zeros((n, width + 1), dtype=np.uint64)
            np.cumsum(_LETTERS[which][self.block] * powers[None, :width], axis=1, out=sums[:, 1:])
        sums = self.sums[which]
        return rows, mixed(sums[rows, start + LENGTH] - sums[rows, start])

    def repeated(self, distance: int, salt: np.ndarray) -> np.ndarray:
        """Rows whose string so many bytes before the trigger an earlier row of the same salt has too."""
        rows, hashed = self.at(distance)
        hashed = hashed ^ salt[rows]
        order = np.argsort(hashed, kind="stable")  # rows of equal hash stay in their order
        ranked, sorted_hash = rows[order], hashed[order]
        again = np.zeros(len(rows), dtype=bool)
        again[1:] = sorted_hash[1:] == sorted_hash[:-1]
        head = np.maximum.accumulate(np.where(again, 0, np.arange(len(rows))))
        later, first = ranked[again], ranked[head[again]]
        start = REACH - distance
        strings = self.block[:, start : start + LENGTH]
        differ = (salt[later] != salt[first]) | (strings[later] != strings[first]).any(axis=1)
        if not differ.any():
            return later
        # Different strings of one hash: the rows concerned are told apart by their bytes.
        mixed_up = np.isin(hashed, sorted_hash[again][differ])
        seen: set[tuple[int, bytes]] = set()
        found = [r for r in later.tolist() if r not in set(rows[mixed_up].tolist())]
        for r in rows[mixed_up].tolist():
            key = (int(salt[r]), strings[r].tobytes())
            if key in seen:
                found.append(r)
            seen.add(key)
        return np.array(sorted(found), dtype=np.int64)


def _compare(batches):
    """Spans of repeated strings. Rows come sorted by gram, doc, at; grams never mix."""
    carry: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if carry is not None:
            table = pa.concat_tables([carry, table])
        grams = table.column("gram").to_numpy()
        cut = int(np.flatnonzero(grams != grams[-1])[-1]) + 1 if (grams != grams[-1]).any() else 0
        if cut:
            yield _repeats(table.slice(0, cut))
        carry = table.slice(cut)
    if carry is not None and carry.num_rows:
        yield _repeats(carry)


def _repeats(table: pa.Table) -> pa.RecordBatch:
    gram, doc, at = (table.column(c).to_numpy() for c in ("gram", "doc", "at"))
    strings = _Strings(table.column("before").to_numpy(), table.column("bytes").to_pylist())
    salt = mixed(gram.view(np.uint64))
    least, most = np.full(len(gram), LENGTH), np.full(len(gram), -1)
    for distance in range(REACH + 1):
        repeated = strings.repeated(distance, salt)  # rows are in corpus order
        least[repeated] = np.minimum(least[repeated], distance)
        most[repeated] = np.maximum(most[repeated], distance)
    # Strings at two distances overlap, so what they cover is one span.
    found = np.flatnonzero(most >= 0)
    return batch_of(_SPANS, [*merge_spans(doc[found], (at - most)[found], (at - least + LENGTH)[found])])


def _explode(batches):
    """The strings of crowded triggers under two hashes."""
    for batch in batches:
        doc, at = batch.column("doc").to_numpy(), batch.column("at").to_numpy()
        gram = mixed(batch.column("gram").to_numpy().view(np.uint64))
        strings = _Strings(batch.column("before").to_numpy(), batch.column("bytes").to_pylist())
        for distance in range(REACH + 1):
            rows, hashed = strings.at(distance)
            string = mixed(hashed ^ gram[rows] ^ np.uint64(distance)).view(np.int64)
            check = strings.at(distance, 0)[1].view(np.int64)
            yield batch_of(_WINDOWS, [string, check, doc[rows], at[rows] - distance])


def _remove(batches):
    for batch in batches:
        rows = []
        for doc, text, spans in zip(*(batch.column(i).to_pylist() for i in range(3))):
            data = text.encode()
            pairs = np.array([(s["start"], s["end"]) for s in spans or ()], dtype=np.int64).reshape(-1, 2)
            _, starts, ends = merge_spans(np.zeros(len(pairs), np.int64), pairs[:, 0], pairs[:, 1])
            kept, last = hashlib.sha256(), 0
            for s, e in zip(starts.tolist(), ends.tolist()):
                kept.update(data[last:s])
                last = e
            kept.update(data[last:])
            rows.append(
                (doc, len(data), int((ends - starts).sum()), len(starts), kept.hexdigest(), starts.tolist(), ends.tolist())
            )
        yield batch_of(_RESULT, list(zip(*rows)) if rows else [[]] * 7)


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(doc, start, end): all repeats, in bytes, of rows (doc, text) with distinct doc; spans may overlap."""
    conf = rows.sparkSession.conf
    parse = staged(small_batches(rows).mapInArrow(_parse, "gram long, entry long, doc long, at long, reach long"), "parse")
    within_task = parse.where("gram is null").selectExpr("doc", "at as start", "at + reach as end")

    by_gram = W.partitionBy("gram").orderBy("entry", "doc", "at")
    whole = by_gram.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    judged = staged(
        parse.where("gram is not null")
        .select(
            "doc",
            "at",
            "reach",
            F.coalesce(F.lag("entry").over(by_gram) == F.col("entry"), F.lit(False)).alias("again"),
            (F.min("entry").over(whole) != F.max("entry").over(whole)).alias("several"),
            (F.count("*").over(whole) > CROWD).alias("crowded"),
        )
        .where("again or several"),
        "judged",
    )
    copies = judged.where("again").selectExpr("doc", "at - reach div 256 as start", "at + reach % 256 as end")

    # The triggers of one document: as many as its length allows.
    opened = (
        judged.where("not again")
        .groupBy("doc")
        .agg(F.expr("collect_list(at) filter (where not crowded) as places"), F.expr("collect_list(at) filter (where crowded) as crowds"))
    )
    around = staged(
        rows.join(opened, "doc")
        .select("doc", "text", "places", "crowds")
        .mapInArrow(_surroundings, "gram long, doc long, at long, before long, bytes binary, crowded boolean"),
        "around",
    )
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")  # rows are short here
    compared = staged(
        around.where("not crowded")
        .repartition("gram")
        .sortWithinPartitions("gram", "doc", "at")
        .mapInArrow(_compare, "doc long, start long, end long"),
        "compared",
    )
    strings = staged(
        around.where("crowded").mapInArrow(_explode, "string long, check long, doc long, at long"), "strings"
    )
    first = strings.groupBy("string", "check").agg(F.min(F.struct("doc", "at")).alias("first"))
    crowded = (
        strings.join(first, ["string", "check"])
        .where(F.struct("doc", "at") != F.col("first"))
        .selectExpr("doc", "at as start", f"at + {LENGTH} as end")
    )
    small_batches(rows)
    return within_task.unionByName(copies).unionByName(compared).unionByName(crowded)


def _numbered(rows: DataFrame) -> tuple[DataFrame, bool]:
    """Rows with `doc`: the id itself, or a number in the order (id, digest) if any id is null or repeats."""
    odd = rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 or id is null")
    if odd.isEmpty():
        return rows.withColumn("doc", F.col("id")), False
    marked = rows.withColumn("mark", F.sha2("text", 256))
    keys = staged(
        marked.select("id", "mark").distinct().repartitionByRange("id", "mark").withColumn("part", F.spark_partition_id()),
        "keys",
    )
    sizes = keys.groupBy("part").agg(F.count("*").alias("n"))  # one row per task
    before = sizes.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    order = W.partitionBy("part").orderBy("id", "mark")
    numbers = keys.join(F.broadcast(before), "part").select(
        F.col("id").alias("key"), "mark", (F.col("before") + F.row_number().over(order)).alias("doc")
    )
    found = marked.join(numbers, "mark").where(F.col("id").eqNullSafe(F.col("key"))).select("id", "text", "doc")
    return staged(found, "numbered"), True


def find_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, starts, ends (byte spans removed) of every row.

    A null text is empty. Rows with one id and one text are one document, and each of them gets its result;
    texts that share an id, or have none, are documents in the order of id (null first) and digest.
    """
    rows, repeated = _numbered(id_and_text(df, id_col, text_col))
    spans = repeated_spans(rows.select("doc", "text").dropDuplicates(["doc"]) if repeated else rows.select("doc", "text"))
    by_doc = spans.groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return small_batches(
        rows.join(by_doc, "doc", "left").select("id", "text", "spans")
    ).mapInArrow(
        _remove,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, starts array<long>, ends array<long>",
    )
