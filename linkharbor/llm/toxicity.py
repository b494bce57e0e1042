"""Toxicity by a weighted lexicon, matched by Aho-Corasick.

The lexicon is learned from labelled rows: word beginnings that mark toxic texts beyond chance, each
with its log odds. Words that stand next to a lexicon word in harmless texts only make exception
phrases, which take the weight back. Texts are folded first: case, look-alike letters of other
scripts, digits and signs that stand for letters. The summed weight is normalised by length and mapped
to a score by a logistic curve fitted on the training rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkharbor.llm.common import batch_of, id_and_text, remainder, small_batches, staged, texts_of
from linkharbor.llm.near_dedup import _shingle_rows, similarities, weighted
from linkharbor.llm.shingles import WordHashes, mixed

# The lexicon is learned from at most this many labelled rows of each class, chosen by a hash of their id.
SAMPLE_PER_CLASS = 10_000
SHORTEST, LONGEST = 4, 12  # letters of a word beginning; shorter words are terms as a whole
MIN_SHARE = 0.004  # of the toxic training rows that a beginning must occur in
LEAST_ODDS = 3.0  # log odds of a lexicon term, at least
COPY = 0.8  # Jaccard similarity of the shingles of a training row and its copy
CHANCE = 0.01  # expected number of beginnings that pass by chance
THRESHOLD = 0.7
_BIN = 0.05

# Letters that look like Latin ones beyond what Unicode says of them, and digits and signs read as letters.
_LOOKALIKES = dict(zip("аеорсухіѕјԁһкмтвнαορντικυıɑɡⅼᴀᴇɪᴏᴜʟɴʀᴛ", "aeopcyxisjdhkmtbhaopvtikuiaglaeioulnrt"))
_LEET = dict(zip("013457@$", "oieastas"))
_TABLE = str.maketrans(_LOOKALIKES)
_foreign = re.compile("[ıɐ-ʯͰ-ԯᴀ-ᶿⅰ-ⅿ]").search
_hidden = re.compile("[\u00ad\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u200b-\u200f\u2060-\u2064\u20d0-\u20ff\ufe00-\ufe0f\ufeff]+")
_SIGNS = str.maketrans(_LEET)
_spelled = re.compile(r"(?<![^\W_])[a-z](?:([.\-_*])[a-z])(?:\1[a-z]){2,}(?![^\W_])")  # four letters or more, one by one
_numbered = re.compile(r"(?<![^\W_])([a-z]+)(\d{2,})(?![^\W_])")
# Most texts have nothing to fold, which these tell at a fraction of the cost.
_may_be_spelled = re.compile(r"[.\-_*][a-z][.\-_*]").search
_sign = re.compile(r"[0-9@$!]").search
_leet = re.compile(r"(?<=[a-zà-ž])[013457@$]+|[013457@$]+(?=[a-zà-ž])")  # each run that touches a letter
_bang = re.compile(r"(?<=[a-z])!(?=[a-z])")
_eight = re.compile(r"(?<![^\W_])8(?=[a-z])")
_words = re.compile(r"[^\W\d_]+").findall
_ACCENTED = range(ord("à"), ord("ž") + 1)
_PLAIN = np.array([ord(unicodedata.normalize("NFD", chr(cp))[0]) for cp in _ACCENTED], dtype="<u4")

_DF = pa.schema([("prefix", pa.string()), ("df", pa.int64())])
_NEAR = pa.schema([("phrase", pa.string()), ("term", pa.string()), ("toxic", pa.int64()), ("harmless", pa.int64())])
_MARKS = pa.schema([("id", pa.int64()), ("toxic", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("c", pa.int64())])
_RAW = pa.schema([("doc_id", pa.int64()), ("x", pa.float64())])


def fold(text: str) -> str:
    """Lower case without hidden characters, and with disguised letters as plain ones.

    A word with a number of two or more digits at its end is kept, beside its other reading if it has one.
    """
    if text.isascii():
        text = text.lower()
    else:
        text = _hidden.sub("", unicodedata.normalize("NFKC", text).lower())
        if _foreign(text):
            text = text.translate(_TABLE)
    if _may_be_spelled(text):
        text = _spelled.sub(lambda m: m.group().replace(m[1], ""), text)
    if not _sign(text):
        return text
    kept: list[str] = []

    def number(m: re.Match) -> str:
        read = m[2].translate(_SIGNS)
        kept.append(f"{m.group()} {m[1]}{read}" if read.isalpha() else m.group())
        return "\0"

    text = _numbered.sub(number, text)
    text = _leet.sub(lambda m: m.group().translate(_SIGNS), _bang.sub("i", _eight.sub("b", text)))
    return re.sub("\0", lambda _: kept.pop(0), text) if kept else text


def without_accents(text: str) -> str:
    """Latin letters without their accents, place by place."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").copy()
    accented = (codes >= _ACCENTED.start) & (codes < _ACCENTED.stop)
    codes[accented] = _PLAIN[codes[accented] - _ACCENTED.start]
    return codes.tobytes().decode("utf-32-le", "surrogatepass")


def _beginnings(words: set[str]) -> set[str]:
    """Beginnings of words; a word shorter than those counts as a whole."""
    short = {w for w in words if 1 < len(w) < SHORTEST}
    return short | {w[:n] for w in words for n in range(SHORTEST, min(len(w), LONGEST) + 1)}


@dataclass(frozen=True)
class Lexicon:
    """Weights of word beginnings and of exception phrases (negative); slope and intercept of the score."""

    terms: dict[str, float]
    exceptions: dict[str, float]
    slope: float = 1.0
    intercept: float = 0.0

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for pattern, weight in {**self.terms, **self.exceptions}.items():
            found.add_word(pattern, (len(pattern), weight))
        if len(found):
            found.make_automaton()
        return found

    def raw(self, folded: str, automaton) -> float:
        """log(1 + weight per thousand words), never below 0."""
        if not len(automaton) or not folded:
            return 0.0
        total = self._weight(folded, automaton)
        if not folded.isascii():
            # Accents tell words apart, so they are kept; terms that appear without them count as well.
            total += self._weight(without_accents(folded), automaton, folded)
        return math.log1p(1000 * max(total, 0.0) / (folded.count(" ") + 50))

    @staticmethod
    def _weight(folded: str, automaton, seen: str | None = None) -> float:
        """Sum of the weights of all matches; given another reading of equal length, of the terms new to it."""
        total = 0.0
        for end, (length, weight) in automaton.iter(folded):
            start = end - length + 1
            if start and folded[start - 1].isalpha():
                continue
            if seen is not None and (weight < 0 or seen[start : end + 1] == folded[start : end + 1]):
                continue
            if (weight < 0 or length < SHORTEST) and end + 1 < len(folded) and folded[end + 1].isalpha():
                continue  # an exception phrase ends with a whole word, a short term is one
            total += weight
        return total

    def probability(self, x):
        return 1 / (1 + np.exp(-(self.slope * x + self.intercept)))


def _sample(labels: DataFrame, id_col: str, label_col: str, per_class: int) -> DataFrame:
    """(id, toxic) of at most per_class rows of each class; an id labelled twice is toxic if any label says so."""
    rows = (
        labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("toxic"))
        .where("id is not null and toxic is not null")
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
    )
    order = F.xxhash64("id"), F.col("id")
    sides = [rows.where(c).orderBy(*order).limit(per_class) for c in ("toxic >= 1", "toxic < 1")]
    return sides[0].unionByName(sides[1])


def learn(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    per_class: int = SAMPLE_PER_CLASS,
) -> Lexicon:
    """Lexicon from the labelled documents given. Without both classes it is empty and scores are 0.5 or less."""
    chosen = F.broadcast(_sample(labels, id_col, label_col, per_class))  # at most 2 x per_class rows
    train = small_batches(staged(id_and_text(documents, id_col, text_col).join(chosen, "id"), "toxicity-sample"))
    train = staged(_without_copies(train), "toxicity-rows")
    sizes = {r["y"]: r["n"] for r in train.groupBy((F.col("toxic") >= 1).alias("y")).agg(F.count("*").alias("n")).collect()}
    toxic_rows, other_rows = sizes.get(True, 0), sizes.get(False, 0)
    if not toxic_rows or not other_rows:
        return Lexicon({}, {}, 1.0, -2.0)
    toxic, other = train.where("toxic >= 1").drop("toxic"), train.where("toxic < 1").drop("toxic")

    least = max(3, math.ceil(MIN_SHARE * toxic_rows))
    hits = {r["prefix"]: r["df"] for r in _frequencies(toxic, None).where(F.col("df") >= least).collect()}
    misses = {r["prefix"]: r["df"] for r in _frequencies(other, frozenset(hits)).collect()}
    terms = choose_terms(hits, misses, toxic_rows, other_rows)
    exceptions = _exceptions(train, terms)
    lexicon = Lexicon(terms, exceptions)

    bins = (
        _raw(train.drop("toxic"), lexicon)
        .join(F.broadcast(train.select("id", "toxic")), F.col("doc_id") == F.col("id"))
        .groupBy(F.round(F.col("x") / _BIN).cast("int").alias("bin"))
        .agg(F.count("*").alias("n"), F.sum((F.col("toxic") >= 1).cast("int")).alias("toxic"))
        .collect()
    )
    slope, intercept = fit_curve([(r["bin"] * _BIN, r["n"], r["toxic"]) for r in bins])
    return Lexicon(terms, exceptions, slope, intercept)


def _without_copies(train: DataFrame) -> DataFrame:
    """One row of each group of copies of a label, or every word of a text that is often copied would be evidence.

    Near copies share the smallest of their shingle hashes, under one of three mixes, almost surely. A row
    goes only if it is COPY alike, by its shingles, to the first row of its label that shares one.
    """

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            marks = []
            for text in batch.column("text").to_pylist():
                found = weighted(hashes.of(text))["shingle"]
                marks.append([int(mixed(found + np.uint64(m)).min()) >> 1 if len(found) else 0 for m in range(3)])
            yield batch_of(_MARKS, [batch.column("id"), batch.column("toxic"), *zip(*marks)] if marks else [[]] * 5)

    marked = staged(train.mapInArrow(run, "id long, toxic int, a long, b long, c long"), "toxicity-marks")
    same = "toxic", "mix", "mark"
    marks = marked.select("id", "toxic", F.posexplode(F.array("a", "b", "c")).alias("mix", "mark"))
    pairs = (
        marks.join(marks.groupBy(*same).agg(F.min("id").alias("other")), list(same))
        .where("id <> other")
        .select(F.col("id").alias("node"), "other", (F.col("mark") == 0).alias("empty"))
        .distinct()
    )
    pairs = staged(pairs, "toxicity-pairs")
    shingles = staged(train.select("id", "text").mapInArrow(_shingle_rows, "id long, shingles binary"), "toxicity-shingles")
    # Of rows that share an id, all must be copies.
    copies = (
        similarities(pairs.where("not empty").select("node", "other"), shingles)
        .groupBy("node", "other")
        .agg(F.min("similarity").alias("similarity"))
        .where(F.col("similarity") >= COPY)
        .select("node")
    )
    gone = copies.union(pairs.where("empty").select("node")).distinct()
    return train.join(F.broadcast(gone), F.col("id") == F.col("node"), "left_anti")  # no more rows than the sample


def _frequencies(rows: DataFrame, among: frozenset[str] | None) -> DataFrame:
    """Number of texts each word beginning occurs in; counted per task first."""

    def run(batches):
        seen: Counter = Counter()
        for _, texts in texts_of(batches):
            for text in texts:
                found = _beginnings(set(_words(fold(text))))
                seen.update(found if among is None else found & among)
            if len(seen) > 200_000:
                yield batch_of(_DF, [list(seen), list(seen.values())])
                seen = Counter()
        yield batch_of(_DF, [list(seen), list(seen.values())])

    return rows.mapInArrow(run, "prefix string, df long").groupBy("prefix").agg(F.sum("df").alias("df"))


def choose_terms(hits: dict[str, int], misses: dict[str, int], toxic_rows: int, other_rows: int) -> dict[str, float]:
    """Beginnings that mark toxic texts beyond chance, none inside another; the value is the log odds."""
    share = toxic_rows / (toxic_rows + other_rows)
    need = math.log(max(len(hits), 1) / CHANCE)
    passed = {}
    for prefix, n in hits.items():
        m = misses.get(prefix, 0)
        p = n / (n + m)
        odds = math.log((n + 0.5) / (toxic_rows + 1)) - math.log((m + 0.5) / (other_rows + 1))
        evidence = n * math.log(p / share) + (m * math.log((1 - p) / (1 - share)) if m else 0)
        if p > share and odds >= LEAST_ODDS and evidence >= need:
            passed[prefix] = odds
    # A beginning that is nearly always followed by the same letter stands for the longer one.
    longer = Counter()
    for prefix in passed:
        longer[prefix[:-1]] = max(longer[prefix[:-1]], hits[prefix])
    closed = {p: w for p, w in passed.items() if len(p) < SHORTEST or longer[p] < 0.95 * hits[p]}
    return {p: w for p, w in closed.items() if not any(p[:n] in closed for n in range(SHORTEST, len(p)))}


def _exceptions(train: DataFrame, terms: dict[str, float]) -> dict[str, float]:
    """Two-word phrases around a term that occur in at least three harmless texts and hardly in toxic ones."""

    def run(batches):
        seen: dict[tuple[str, str], list[int]] = {}
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                words, phrases = _words(fold(text)), set()
                for i, word in enumerate(words):
                    term = next((word[:n] for n in (len(word), *range(SHORTEST, len(word))) if word[:n] in terms), None)
                    if term and i:
                        phrases.add((f"{words[i - 1]} {word}", term))
                    if term and i + 1 < len(words):
                        phrases.add((f"{word} {words[i + 1]}", term))
                for key in phrases:
                    seen.setdefault(key, [0, 0])[toxic < 1] += 1
        counts = list(seen.values())
        yield batch_of(_NEAR, [[k[0] for k in seen], [k[1] for k in seen], [c[0] for c in counts], [c[1] for c in counts]])

    if not terms:
        return {}
    near = (
        train.mapInArrow(run, "phrase string, term string, toxic long, harmless long")
        .groupBy("phrase", "term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("harmless").alias("harmless"))
        .where("harmless >= 3 and toxic * 20 <= harmless")
    )
    return {r["phrase"]: -terms[r["term"]] for r in near.collect()}


def fit_curve(bins: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Logistic curve through (x, rows, toxic rows) by Newton steps, with a small ridge."""
    x, n, y = (np.array(c, dtype=float) for c in zip(*bins))
    design = np.stack([x, np.ones_like(x)], 1)
    w = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (n * p - y) + 0.1 * w
        hessian = (design * (n * p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w -= step / max(1.0, np.abs(step).max() / 2)
    return float(w[0]), float(w[1])


def _raw(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    def run(batches):
        automaton = lexicon.automaton()
        for ids, texts in texts_of(batches):
            yield batch_of(_RAW, [ids, [lexicon.raw(fold(t), automaton) for t in texts]])

    return rows.mapInArrow(run, "doc_id long, x double")


def score(df: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 from THRESHOLD on) of every row; a null text is empty."""
    raw = _raw(small_batches(id_and_text(df, id_col, text_col)), lexicon)
    value = 1 / (1 + F.exp(-(F.col("x") * lexicon.slope + lexicon.intercept)))
    return raw.select("doc_id", value.alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )


def training_rows(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return df.where(remainder(F.col(id_col), 3) != 1)
