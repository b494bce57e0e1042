"""Near duplicates by ProbMinHash over weighted five-word shingles, banding and exact verification.

1. Texts with the same words are one node, named by their smallest id; copies go no further.
2. ProbMinHash: each shingle is a Poisson process whose rate is its weight; its arrivals fall on random
   registers, and each register keeps the shingle that came first. Arrivals end early, at a time by which
   all registers of the text have been hit. Registers agree with the probability Jaccard similarity.
   A shingle weighs 1 + log2 of its letters, so that a run of long words counts for more than one of
   short ones. The weight is that of the shingle in any text, however often it occurs there, so the
   probability Jaccard similarity is the weight of the common shingles over the weight of all.
3. Nodes that agree in a band of registers share a bucket. Each is verified against the hub of its
   bucket: as many pairs as members, however large the bucket. Links make classes.
4. The nodes of buckets that then hold several classes are banded anew, by longer bands. There each node
   is verified against one member, the hub, of every other class of its bucket, unless the sketches of
   the registers rule the pair out. Nodes of one class are not compared again, whatever their number.
5. What hubs leave open is tried in full: of buckets that hold several classes besides their hub, every
   pair of nodes of different classes is verified. Those nodes are dealt into blocks, each two blocks that
   share a bucket meet once in a task, and one matrix product gives the common weight of all their pairs.
6. Links of a similarity of 0.8 or more, found by label propagation with pointer jumps, are the classes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkharbor.llm.common import batch_of, id_and_text, small_batches, staged, texts_of
from linkharbor.llm.shingles import SHINGLE, WordHashes, mixed, shingle_hashes, shingle_letters
from linkharbor.session import broadcast_if_small

SIMILARITY = 0.8
BANDS, ROWS = 40, 8  # a pair at 0.8 shares a band with probability 0.9994, one at 0.3 with 0.003
REGISTERS = BANDS * ROWS
# Four bits of each register make a sketch. At 0.8 a fifth of the registers differ, in two bits on
# average: 128 bits with a deviation of 16.4. More than 185, 3.5 deviations above, differ with a
# probability of 2e-4; of texts at 0.65 nine in ten and more differ in more.
SKETCH_BITS = 4
SKETCH_LONGS = REGISTERS * SKETCH_BITS // 64
MOST_APART = 185
# Long bands: as many registers as their four bits fill a long. A pair at 0.8 shares one with probability
# 0.90 (at 0.82 0.97, at 0.85 0.996), if it has not been found by the hubs of the short bands before.
LONG_BANDS, LONG_ROWS = 64, 64 // SKETCH_BITS
# Texts of a block, and bytes of their shingles; a class of as many texts has blocks of its own.
BLOCK_NODES, BLOCK_BYTES = 512, 4 << 20
BLOCK_BATCH_BYTES = 8 << 20
_COLUMNS = 2048  # shingles that a matrix holds at once
_LONG_REGISTERS = np.argsort(np.random.default_rng(9).random((LONG_BANDS, REGISTERS)), axis=1)[:, :LONG_ROWS]

_SIGNED = pa.schema(
    [("doc_id", pa.int64()), ("words_a", pa.int64()), ("words_b", pa.int64()), ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))]
)
_SHINGLES = pa.schema([("id", pa.int64()), ("shingles", pa.binary())])


_WEIGHTED = np.dtype([("shingle", "<u8"), ("weight", "<f4")])


def weighted(words: np.ndarray) -> np.ndarray:
    """Distinct shingles in order, with their weights; a text of under five words is one shingle of them all."""
    size = min(SHINGLE, max(len(words), 1))
    found, first = np.unique(shingle_hashes(words, size), return_index=True)
    out = np.empty(len(found), _WEIGHTED)
    out["shingle"], out["weight"] = found, 1 + np.log2(shingle_letters(words, size)[first])
    return out


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Probability Jaccard similarity of two arrays made by `weighted`."""
    _, i, _ = np.intersect1d(a["shingle"], b["shingle"], assume_unique=True, return_indices=True)
    both = a["weight"][i].sum(dtype=np.float64)
    total = a["weight"].sum(dtype=np.float64) + b["weight"].sum(dtype=np.float64) - both
    return float(both / total) if total else 0.0


def prob_min_hash(sets: list[tuple[np.ndarray, np.ndarray]], registers: int = REGISTERS) -> np.ndarray:
    """Rows of `registers` shingle hashes, one row for each non-empty weighted set."""
    out = np.zeros((len(sets), registers), dtype=np.uint64)
    todo, factor = np.arange(len(sets)), 4.0
    while len(todo):
        arrivals = registers * (np.log(registers) + factor)
        rows, full = _race([sets[i] for i in todo], registers, arrivals)
        out[todo[full]] = rows[full]
        todo, factor = todo[~full], factor * 2
    return out


def _race(sets, registers: int, arrivals: float) -> tuple[np.ndarray, np.ndarray]:
    """First shingle of each register among the first `arrivals` expected arrivals; rows without a gap."""
    sizes = [len(s[0]) for s in sets]
    element = np.concatenate([s[0] for s in sets])
    rate = np.concatenate([s[1] for s in sets])
    row = np.repeat(np.arange(len(sets)), sizes)
    end = arrivals / np.bincount(row, rate, minlength=len(sets))
    first = np.full(len(sets) * registers, np.inf)
    winner = np.zeros(len(sets) * registers, dtype=np.uint64)
    time = np.zeros(len(element))
    # As many draws at a time as a shingle needs on average; most need no second round.
    step, width = 0, min(16, int(arrivals * len(sets) / max(len(element), 1)) + 2)
    while len(element):
        draws = mixed(element[:, None] + np.arange(step + 1, step + width + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
        gaps = -np.log(((draws >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52)
        times = time[:, None] + np.cumsum(gaps / rate[:, None], axis=1)
        slot = row[:, None] * registers + (mixed(draws) % np.uint64(registers)).astype(np.int64)
        early = times < end[row][:, None]
        at, when = slot[early], times[early]
        np.minimum.at(first, at, when)
        won = when == first[at]
        winner[at[won]] = np.broadcast_to(element[:, None], times.shape)[early][won]
        alive = early[:, -1]
        element, rate, row, time = element[alive], rate[alive], row[alive], times[alive, -1]
        step, width = step + width, 8
    full = np.isfinite(first).reshape(len(sets), registers).all(axis=1)
    return winner.reshape(len(sets), registers), full


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; the number of the band is part of it."""
    grouped = signatures.reshape(len(signatures), BANDS, ROWS)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    for r in range(ROWS):
        keys = mixed(keys + grouped[:, :, r])
    return keys.view(np.int64)


def sketches(signatures: np.ndarray) -> np.ndarray:
    """A few bits of every register, as longs: a cheap estimate of how many registers agree."""
    spread = mixed(signatures) >> np.uint64(17)
    bits = [(spread >> np.uint64(b)).astype(np.uint8) & 1 for b in range(SKETCH_BITS)]
    return np.packbits(np.concatenate(bits, axis=1), axis=1).view(np.int64)


def _sign(batches):
    import xxhash

    hashes = WordHashes()
    for ids, texts in texts_of(batches):
        words = [hashes.of(t) for t in texts]
        marks = [xxhash.xxh3_128_intdigest(w.tobytes()) for w in words]
        filled = [i for i, w in enumerate(words) if len(w)]
        bands: list[list[int]] = [[] for _ in words]
        sketch: list[list[int]] = [[] for _ in words]
        if filled:
            sets = [weighted(words[i]) for i in filled]
            signatures = prob_min_hash([(x["shingle"], x["weight"].astype(np.float64)) for x in sets])
            for i, keys, bits in zip(filled, band_keys(signatures).tolist(), sketches(signatures).tolist()):
                bands[i], sketch[i] = keys, bits
        signed = np.array([[m >> 64, m & (2**64 - 1)] for m in marks], dtype=np.uint64).view(np.int64)
        yield batch_of(_SIGNED, [ids, signed[:, 0], signed[:, 1], bands, sketch])


def long_band_keys(sketch: np.ndarray) -> np.ndarray:
    """LONG_BANDS keys of rows made by `sketches`: four bits of each register of the band, and its number."""
    planes = np.unpackbits(sketch.view(np.uint8), axis=1).reshape(len(sketch), SKETCH_BITS, REGISTERS)
    nibbles = planes[:, :, _LONG_REGISTERS]  # row, bit, band, register of the band
    packed = np.packbits(nibbles.transpose(0, 2, 1, 3).reshape(len(sketch), LONG_BANDS, 64), axis=2).view(np.uint64)[:, :, 0]
    return mixed(packed + np.arange(1, LONG_BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def _long_bands(batches):
    for batch in batches:
        columns = [batch.column(i).to_numpy() for i in range(2, 2 + SKETCH_LONGS)]
        keys = long_band_keys(np.stack(columns, axis=1)) if batch.num_rows else np.empty((0, LONG_BANDS), np.int64)
        at = np.repeat(np.arange(batch.num_rows), LONG_BANDS)
        yield pa.RecordBatch.from_arrays([*batch.take(pa.array(at)).columns, pa.array(keys.ravel())], names=[*batch.schema.names, "band"])


def _shingle_rows(batches):
    hashes = WordHashes()
    for ids, texts in texts_of(batches):
        yield batch_of(_SHINGLES, [ids, [weighted(hashes.of(t)).tobytes() for t in texts]])


def _similar(batches):
    for batch in batches:
        pairs = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())
        found = [weighted_jaccard(np.frombuffer(a, _WEIGHTED), np.frombuffer(b, _WEIGHTED)) for a, b in pairs]
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), batch.column("other"), pa.array(found, pa.float64())],
            names=["node", "other", "similarity"],
        )


def similarities(pairs: DataFrame, shingles: DataFrame) -> DataFrame:
    """Exact similarity of each pair (node, other); `shingles` has (id, shingles)."""
    left = shingles.select(F.col("id").alias("node"), F.col("shingles").alias("a"))
    right = shingles.select(F.col("id").alias("other"), F.col("shingles").alias("b"))
    return (
        pairs.join(left, "node")
        .join(right, "other")
        .select("node", "other", "a", "b")
        .mapInArrow(_similar, "node long, other long, similarity double")
    )


def common_weights(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Weight of the common shingles of each two arrays made by `weighted`, one row for each of `a`."""
    out = np.zeros((len(a), len(b)))
    held = np.intersect1d(np.concatenate(a)["shingle"], np.concatenate(b)["shingle"])
    sides = []
    for arrays in (a, b):
        every = np.concatenate(arrays)
        row = np.repeat(np.arange(len(arrays)), [len(x) for x in arrays])
        at = np.searchsorted(held, every["shingle"])
        shared = np.flatnonzero(held[np.minimum(at, len(held) - 1)] == every["shingle"]) if len(held) else np.empty(0, np.int64)
        shared = shared[np.argsort(at[shared], kind="stable")]
        sides.append((len(arrays), row[shared], at[shared], every["weight"][shared].astype(np.float64)))
    for start in range(0, len(held), _COLUMNS):
        width = min(_COLUMNS, len(held) - start)
        weights, present = (np.zeros((n, width)) for n in (len(a), len(b)))
        for matrix, (_, row, at, weight), valued in ((weights, sides[0], True), (present, sides[1], False)):
            low, high = np.searchsorted(at, [start, start + width])
            matrix[row[low:high], at[low:high] - start] = weight[low:high] if valued else 1
        out += weights @ present.T
    return out


def joining_pairs(a: list[np.ndarray], b: list[np.ndarray], labels_a: np.ndarray, labels_b: np.ndarray) -> list[tuple[int, int]]:
    """Places (in `a`, in `b`) of links between different labels, as many as join all labels that links join."""
    both = common_weights(a, b)
    weight_a, weight_b = (np.array([x["weight"].sum(dtype=np.float64) for x in arrays]) for arrays in (a, b))
    total = np.maximum(weight_a[:, None] + weight_b[None, :] - both, 1e-300)
    close = (both / total >= SIMILARITY - 1e-9) & (labels_a[:, None] != labels_b[None, :])
    top: dict[int, int] = {}

    def end(label: int) -> int:
        while label in top:
            top[label] = label = top.get(top[label], top[label])
        return label

    out = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(close))):
        x, y = end(int(labels_a[i])), end(int(labels_b[j]))
        if x != y:
            top[x] = y
            out.append((i, j))
    return out


_JOINING = pa.schema([("node", pa.int64()), ("other", pa.int64())])


def _joining(batches):
    def side(nodes):
        ids, labels = (np.array([x[k] for x in nodes], np.int64) for k in ("node", "label"))
        return ids, labels, [np.frombuffer(x["shingles"], _WEIGHTED) for x in nodes]

    for batch in batches:
        for a, b in zip(batch.column("a"), batch.column("b")):
            ids_a, labels_a, texts_a = side(a.as_py())
            ids_b, labels_b, texts_b = side(b.as_py())
            pairs = joining_pairs(texts_a, texts_b, labels_a, labels_b)
            yield batch_of(_JOINING, [[int(ids_a[i]) for i, _ in pairs], [int(ids_b[j]) for _, j in pairs]])


def with_hubs(buckets: DataFrame) -> DataFrame:
    """(band, node, other): members of the buckets that hold several, with the hub of the bucket.

    The hub is the node that shares most buckets with others, counted by their sizes. The text that
    others are copies of agrees with each of them, so it is the hub of nearly all their buckets, where
    the copies among themselves may be too far apart.
    """
    sizes = (
        buckets.groupBy("band")
        .agg(F.count("*").alias("size"), F.min("node").alias("low"), F.max("node").alias("high"))
        .where("low < high")
        .select("band", "size")
    )
    shared = staged(buckets.join(sizes, "band"), "shared")
    rank = shared.groupBy("node").agg(F.sum("size").alias("reach"))
    ranked = shared.join(rank, "node")
    hubs = ranked.groupBy("band").agg(F.max(F.struct("reach", (-F.col("node")).alias("late"))).alias("hub"))
    return staged(
        shared.join(hubs.select("band", (-F.col("hub.late")).alias("other")), "band").select("band", "node", "other"),
        "hubs",
    )


def classes_of(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over the links (node, other), for all nodes on a link.

    Nodes are not null; repeated links count once; no links give no rows.
    """
    both = staged(
        links.select("node", "other").union(links.select("other", "node")).distinct(), "links"
    )
    labels = staged(
        both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label")), "labels"
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("other"), "label"), "other")
            .groupBy("node")
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node").select("node", F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = staged(
            lower.join(jump, "label").select("node", F.least("label", "further").alias("label")), "labels"
        )
        changed = moved.join(labels.withColumnRenamed("label", "before"), "node").where("label <> before")
        done = changed.isEmpty()
        labels = moved
        if done:
            return labels


def _further_pairs(shared: DataFrame, labels: DataFrame, signed: DataFrame, verified: DataFrame) -> DataFrame:
    """Pairs of different classes to verify: nodes of mixed buckets, with the hubs of their long bands."""
    placed = shared.join(labels, "node", "left").select("band", "node", F.coalesce("label", "node").alias("label"))
    crowded = placed.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    bits = [f"s{i}" for i in range(SKETCH_LONGS)]
    open_nodes = placed.join(crowded.select("band"), "band", "left_semi").select("node", "label").distinct()
    sketched = signed.select(F.col("doc_id").alias("node"), *[F.col("sketch")[i].alias(b) for i, b in enumerate(bits)])
    schema = f"node long, label long, {', '.join(f'{b} long' for b in bits)}, band long"
    banded = staged(open_nodes.join(sketched, "node").mapInArrow(_long_bands, schema), "long-bands")
    mixed_bands = banded.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    members = staged(banded.join(mixed_bands.select("band"), "band", "left_semi"), "long-members")
    draw = F.struct(F.xxhash64("band", "node").alias("draw"), "node", *bits)
    hubs = members.groupBy("band", F.col("label").alias("that_label")).agg(F.min(draw).alias("hub"))
    hubs = hubs.select(
        "band", "that_label", F.col("hub.node").alias("other"), *[F.col(f"hub.{b}").alias(f"that_{b}") for b in bits]
    )
    apart = sum((F.bit_count(F.col(b).bitwiseXOR(F.col(f"that_{b}"))) for b in bits), F.lit(0))
    return (
        members.join(hubs, "band")
        .where((F.col("label") != F.col("that_label")) & (apart <= MOST_APART))
        .select(F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other"))
        .distinct()
        .join(verified.select(F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other")), ["node", "other"], "left_anti")
    )


def _open_buckets(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """(band, node, label, crowd, size) of buckets that hold several classes besides their hub, which has met all of them.

    crowd is the hub, size the number of nodes.
    """
    members = shared.where("node <> other").join(labels, "node", "left")
    placed = members.select("band", "node", F.coalesce("label", "node").alias("label"), F.col("other").alias("crowd")).distinct()
    several = placed.groupBy("band").agg(F.count("*").alias("size"), F.min("label").alias("low"), F.max("label").alias("high"))
    return placed.join(several.where("low < high").select("band", "size"), "band")


def _rest(opened: DataFrame, shingles: DataFrame) -> DataFrame:
    """Links (node, other) that join all classes of `opened` which a pair of one bucket joins; every pair is tried.

    Nodes are dealt into blocks by the hub of their largest bucket, a class of many nodes apart from the
    others. Two blocks meet if a bucket has nodes of both, but not those of one class.
    """
    spark = opened.sparkSession
    homes = opened.groupBy("node").agg(F.min("label").alias("label"), F.max(F.struct("size", "crowd")).alias("home"))
    homes = homes.select("node", "label", F.col("home.crowd").alias("crowd"))
    classes = homes.groupBy("crowd", "label").agg((F.count("*") >= BLOCK_NODES).alias("large"))
    named = homes.join(classes, ["crowd", "label"]).select("node", "label", "crowd", F.when(F.col("large"), F.col("label")).alias("alone"))
    held = staged(shingles.withColumnRenamed("id", "node").join(named, "node"), "open-nodes")
    number = F.greatest(F.count("*") / BLOCK_NODES, F.sum(F.length("shingles")) / BLOCK_BYTES)
    numbers = held.groupBy("crowd", "alone").agg(F.ceil(number).alias("blocks"))
    block = F.xxhash64("crowd", "alone", F.pmod(F.xxhash64("node"), "blocks"))
    numbered = numbers.select(F.col("crowd").alias("of"), F.col("alone").alias("only"), "blocks")
    dealt = held.join(numbered, (F.col("crowd") == F.col("of")) & F.col("alone").eqNullSafe(F.col("only")))
    dealt = staged(dealt.select("node", "label", "alone", "shingles", block.alias("block")), "dealt-nodes")
    blocks = dealt.groupBy("block").agg(F.collect_list(F.struct("node", "label", "shingles")).alias("nodes"))
    blocks = staged(blocks, "blocks")

    places = opened.select("band", "node").join(dealt.select("node", "block", "alone").distinct(), "node")
    places = staged(places.groupBy("band", "block", "alone").agg(F.count("*").alias("n")), "block-buckets")
    left, right = (places.select("band", F.col("block").alias(k), F.col("alone").alias(f"{k}_alone"), F.col("n").alias(f"{k}_n")) for k in "xy")
    one = (F.col("x") == F.col("y")) & (F.col("x_n") < 2)
    same = F.coalesce(F.col("x_alone") == F.col("y_alone"), F.lit(False))
    meetings = staged(left.join(right, "band").where((F.col("x") <= F.col("y")) & ~one & ~same).select("x", "y").distinct(), "meetings")
    met = meetings.join(blocks.select(F.col("block").alias("x"), F.col("nodes").alias("a")), "x")
    met = met.join(blocks.select(F.col("block").alias("y"), F.col("nodes").alias("b")), "y").select("a", "b")
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, str(BLOCK_BATCH_BYTES))
    try:
        return staged(met.mapInArrow(_joining, "node long, other long"), "rest")
    finally:
        spark.conf.set(size, before)


def near_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id (the smallest id of the class) of every row.

    Case and everything but letters and digits is ignored. A text without any word (null, empty) is alone
    in its class, as is a row without an id, whose class is null. Rows with one id are one document.
    An empty table gives no rows; columns other than the two are not looked at.
    """
    rows = small_batches(id_and_text(df, id_col, text_col))
    signed = staged(
        rows.mapInArrow(_sign, "doc_id long, words_a long, words_b long, bands array<long>, sketch array<long>"), "signatures"
    )
    worded = signed.where("doc_id is not null and size(bands) > 0")
    nodes = worded.groupBy("words_a", "words_b").agg(F.min("doc_id").alias("node"))
    members = worded.select("doc_id", "words_a", "words_b").join(nodes, ["words_a", "words_b"]).select("doc_id", "node")

    first = worded.join(nodes.select(F.col("node").alias("doc_id"), "words_a", "words_b"), ["doc_id", "words_a", "words_b"], "left_semi")
    buckets = first.select(F.explode("bands").alias("band"), F.col("doc_id").alias("node"))
    shared = with_hubs(buckets)

    pairs = shared.where("node <> other").select("node", "other").distinct()
    # Rows that share an id are one document; any of its texts may stand for it.
    asked = broadcast_if_small(staged(shared.select(F.col("node").alias("id")).distinct(), "asked"))
    shingles = staged(
        rows.join(asked, "id", "left_semi").mapInArrow(_shingle_rows, "id long, shingles binary"),
        "shingles",
    )
    verified = staged(similarities(pairs, shingles), "verified")
    close = F.col("similarity") >= SIMILARITY - 1e-9
    links = verified.where(close).select("node", "other")
    labels = classes_of(links)

    further = staged(_further_pairs(shared, labels, first, verified), "further")
    more = staged(similarities(further, shingles), "verified-further")
    links = links.union(more.where(close).select("node", "other"))
    final = classes_of(links)

    opened = staged(_open_buckets(shared, final), "open-buckets")
    if not opened.isEmpty():
        final = classes_of(links.union(_rest(opened, shingles)))

    known = members.join(final, "node", "left").select("doc_id", F.coalesce("label", "node").alias("class_id"))
    alone = signed.where("doc_id is null or size(bands) = 0").select("doc_id", F.col("doc_id").alias("class_id"))
    return known.unionByName(alone)


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose id names their class, and those without id, with all their columns, whatever their names."""
    classes = near_classes(df, id_col, text_col).where("doc_id <> class_id")
    gone = staged(classes.select("doc_id").distinct(), "near-copies").alias("gone")
    kept = F.col(f"kept.`{id_col}`").cast("long") == F.col("gone.doc_id")
    return df.alias("kept").join(broadcast_if_small(gone), kept, "left_anti")
