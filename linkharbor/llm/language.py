"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three characters, word edges marked by a blank, are hashed to FEATURES buckets.
Document frequencies come from all training rows; the weights are fitted on a bounded sample of them,
by follow-the-regularised-leader with an elastic-net penalty, which leaves most weights at zero. A
part of the sample not trained on sets the temperature that calibrates the scores.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from linkharbor.llm.common import batch_of, remainder, small_batches, staged, texts_of

UNKNOWN = "und"
FEATURES = 1 << 16
# The weights are fitted on at most this many rows of each language, chosen by a hash of their id.
SAMPLE_PER_LANGUAGE = 1000
# In all at most this many rows: where there are so many languages, fewer of each. A column with more
# labels than that is not one of languages.
MOST_SAMPLED = 200_000
# So many times the rows wanted are drawn by a threshold on the hash before any are ranked.
SPARE = 1.5
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.1
# Characters that are counted at a time.
PART = 1 << 20

_has_letter = re.compile(r"[^\W\d_]").search
_DF = pa.schema([("bucket", pa.int32()), ("df", pa.int64())])
_VECTOR = pa.schema([("lang", pa.string()), ("held", pa.bool_()), ("buckets", pa.binary()), ("counts", pa.binary())])
_PREDICTED = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def _letter_table() -> np.ndarray:
    """Code point -> its lower-case letter, or a blank; characters beyond the table are kept."""
    table = np.full(1 << 16, 32, dtype=np.uint32)
    for cp in range(1 << 16):
        if chr(cp).isalpha():
            lower = chr(cp).lower()
            table[cp] = ord(lower) if len(lower) == 1 else cp
    return table


_LETTERS: list[np.ndarray] = []


def ngram_counts(text: str, part: int = PART) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the hashed n-grams of a whole text, blanks squeezed.

    A long text is counted in parts; each goes on from the last two characters of the one before, and
    counts the n-grams that end in it, so that the parts add up to the whole.
    """
    if not _LETTERS:
        _LETTERS.append(_letter_table())
    total, last = np.zeros(FEATURES, np.int64), np.empty(0, np.uint64)
    for at in range(0, max(len(text), 1), part):
        piece = (" " if not at else "") + text[at : at + part] + (" " if at + part >= len(text) else "")
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), "<u4")
        codes = np.where(codes < 1 << 16, _LETTERS[0][np.minimum(codes, (1 << 16) - 1)], codes)
        kept = np.ones(len(codes), dtype=bool)
        kept[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
        kept[0] = codes[0] != 32 or not len(last) or last[-1] != 32
        c = np.concatenate([last, codes[kept].astype(np.uint64)])
        grams = [c]
        for _ in range(2):
            shorter = grams[-1]
            grams.append(shorter[:-1] * np.uint64(0x9E3779B97F4A7C15) + c[len(c) - len(shorter) + 1 :])
        hashed = np.concatenate([_mix(g[max(len(last) - n, 0) :] + np.uint64(n)) for n, g in enumerate(grams)])
        total += np.bincount((hashed >> np.uint64(48)).astype(np.int64), minlength=FEATURES)
        last = c[-2:]
    buckets = np.flatnonzero(total)
    return buckets, total[buckets]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x << np.uint64(17))


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    idf: np.ndarray  # FEATURES
    weights: np.ndarray  # FEATURES x languages
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = vector(buckets, counts, self.idf)
        return x @ self.weights[buckets] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not _has_letter(text):
            return UNKNOWN, 0.0
        p = softmax(self.logits(*ngram_counts(text)) / self.temperature)
        best = int(np.argmax(p))
        return self.languages[best], float(p[best])


def vector(buckets: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit-length TF-IDF values of the given buckets."""
    x = np.log1p(counts) * idf[buckets]
    return x / max(float(np.sqrt(x @ x)), 1e-12)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def learn(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE,
) -> Model:
    """Model of the rows given; rows without text, letter or language teach nothing.

    Without any such row there is no language to predict and every text is `und`.
    """
    small_batches(df)
    rows = df.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).where("text is not null and lang is not null")
    idf = _document_frequencies(rows.select("id", "text"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_SAMPLED + 1).collect()}
    if len(counts) > MOST_SAMPLED:
        raise ValueError(f"more than {MOST_SAMPLED} labels: is {lang_col!r} a column of languages?")
    wanted = min(per_language, MOST_SAMPLED // max(len(counts), 1))
    # Few rows of any language pass its threshold, whatever the number of rows or tasks, and are then ranked.
    # The thresholds are as many as the labels, MOST_SAMPLED at most.
    bounds = [(g, int(2**64 * min(1.0, (SPARE * wanted + 100) / n)) - 2**63) for g, n in counts.items()]
    bounds = rows.sparkSession.createDataFrame([(g, min(b, 2**63 - 1)) for g, b in bounds], "lang string, bound long")
    drawn = rows.select("id", "lang").withColumn("draw", F.xxhash64("id")).join(F.broadcast(bounds), "lang")
    order = W.partitionBy("lang").orderBy("draw", "id")
    chosen = drawn.where("draw <= bound").withColumn("n", F.row_number().over(order)).where(F.col("n") <= wanted)
    chosen = staged(chosen.select("id").distinct(), "language-sample")
    sample = rows.join(F.broadcast(chosen), "id").select("id", "text", "lang")

    def run(batches):
        for batch in batches:
            found = [], [], [], []
            for doc, text, lang in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if _has_letter(text):
                    buckets, counts = ngram_counts(text)
                    held = (doc or 0) * 2654435761 % 2**32 < 2**32 // 5
                    values = (lang, held, buckets.astype("<u4").tobytes(), counts.astype("<u4").tobytes())
                    for column, value in zip(found, values):
                        column.append(value)
            yield batch_of(_VECTOR, list(found))

    vectors = sample.mapInArrow(run, "lang string, held boolean, buckets binary, counts binary").collect()
    rows_ = sorted(
        (r["lang"], r["held"], bytes(r["buckets"]), bytes(r["counts"])) for r in vectors
    )
    return fit([(g, h, np.frombuffer(b, "<u4"), np.frombuffer(c, "<u4")) for g, h, b, c in rows_], idf)


def _document_frequencies(rows: DataFrame) -> np.ndarray:
    """IDF over all training rows; each task sends its counts once."""

    def run(batches):
        seen, n = np.zeros(FEATURES, dtype=np.int64), 0
        for _, texts in texts_of(batches):
            for text in texts:
                seen[ngram_counts(text)[0]] += 1
                n += 1
        buckets = np.flatnonzero(seen)
        yield batch_of(_DF, [np.append(buckets, -1).astype(np.int32), np.append(seen[buckets], n)])

    counts = rows.mapInArrow(run, "bucket int, df long").groupBy("bucket").agg(F.sum("df").alias("df")).collect()
    df, total = np.zeros(FEATURES), 0
    for r in counts:  # at most one row per bucket
        if r["bucket"] < 0:
            total = r["df"]
        else:
            df[r["bucket"]] = r["df"]
    return np.log((1 + total) / (1 + df)) + 1


def fit(rows: list[tuple[str, bool, np.ndarray, np.ndarray]], idf: np.ndarray) -> Model:
    """Follow-the-regularised-leader, one row at a time; rows marked held set the temperature."""
    languages = tuple(sorted({r[0] for r in rows}))
    k = len(languages)
    index = {g: i for i, g in enumerate(languages)}
    z, n = np.zeros((FEATURES, k)), np.zeros((FEATURES, k))
    zb, nb = np.zeros(k), np.zeros(k)
    taught = [r for r in rows if not r[1]] or rows
    data = [(index[g], b, vector(b, c, idf)) for g, _, b, c in taught]

    def proximal(z, n, l1, l2):
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + l2)

    order = np.random.default_rng(7)
    for _ in range(EPOCHS if k > 1 else 0):
        for i in order.permutation(len(data)):
            y, b, x = data[i]
            zs, ns = z[b], n[b]
            w = proximal(zs, ns, L1, L2)
            wb = proximal(zb, nb, 0, L2)
            error = softmax(x @ w + wb)
            error[y] -= 1
            g = x[:, None] * error
            g2 = g * g
            z[b] = zs + g - (np.sqrt(ns + g2) - np.sqrt(ns)) / ALPHA * w
            n[b] = ns + g2
            zb += error - (np.sqrt(nb + error**2) - np.sqrt(nb)) / ALPHA * wb
            nb += error**2
    model = Model(languages, idf, proximal(z, n, L1, L2).astype(np.float32), proximal(zb, nb, 0, L2))
    held = [r for r in rows if r[1]]
    if not held or k < 2:
        return model
    logits = np.stack([model.logits(b, c) for _, _, b, c in held])
    truth = np.array([index[r[0]] for r in held])

    def loss(t: float) -> float:
        return float(-np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean())

    best = min((math.exp(s) for s in np.linspace(-3, 3, 121)), key=loss)
    return Model(languages, idf, model.weights, model.bias, best)


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row: `und` with score 0 if the text is null or has no letter."""

    def run(batches):
        for ids, texts in texts_of(batches):
            found = [model.predict(t) for t in texts]
            yield batch_of(_PREDICTED, [ids, [f[0] for f in found], [f[1] for f in found]])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return small_batches(rows).mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_identified(df: DataFrame, model: Model, least: float, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whatever their names, whose language is known with at least this score.

    No shuffle. Null and empty texts go; ids are not looked at, and repeated rows stay or go together.
    """

    def run(batches):
        for batch in batches:
            found = [model.predict(t) for t in batch.column(text_col).to_pylist()]
            yield batch.filter(pa.array([g != UNKNOWN and s >= least for g, s in found], pa.bool_()))

    return small_batches(df).mapInArrow(run, df.schema)


def training_rows(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return df.where(remainder(F.col(id_col), 5) != 0)
