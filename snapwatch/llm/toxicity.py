"""Toxicity by a weighted lexicon, learned from labels and matched by Aho-Corasick on folded texts."""

from __future__ import annotations

import math
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapwatch.llm.tables import cut, slices

# The lexicon and the curve are fitted on so many labelled documents at most, chosen by a hash of doc_id.
LABEL_SAMPLE = 20_000
# A term is listed if so many toxic documents hold it, and its odds among them are so many times those elsewhere.
LEAST_DOCUMENTS, LEAST_ODDS = 3, 20.0
# A word counts as itself and by its beginnings of these lengths.
STEMS = range(4, 8)
THRESHOLD = 0.7
# A phrase of two or three words with a listed one means no harm if so many clean documents hold it and no toxic one.
LEAST_CLEAN, PHRASE_WORDS = 3, (2, 3)

# Letters of other scripts that look like Latin ones, and digits and signs that stand for letters.
CYRILLIC = "абвеікмнорстухѕјҫԁһ", "abbeikmhopctyxsjcdh"
GREEK = "αβεικνορτυχωηγ", "abeiknoptyxwny"
DIGITS = "0134578@$", "oieastbas"


def _table() -> dict[int, str | None]:
    table: dict[int, str | None] = {}
    for point in range(0x80, 0x2000):  # a letter with an accent is a letter of its own
        if len(small := chr(point).lower()) == 1:
            table[point] = small
    for point in range(0xFF01, 0xFF5F):  # full width
        table[point] = unicodedata.normalize("NFKC", chr(point)).lower()
    for letters, latin in (CYRILLIC, GREEK):
        for letter, as_latin in zip(letters, latin):
            table[ord(letter)] = table[ord(letter.upper())] = as_latin
    for point in [*range(0x300, 0x370), 0xAD, *range(0x200B, 0x2010), 0x2060, 0xFEFF]:  # marks, zero width
        table[point] = None
    for point in range(0x80):
        if not chr(point).isalnum():
            table[point] = " "
        elif chr(point).isupper():
            table[point] = chr(point).lower()
    table |= {ord(a): b for a, b in zip(*DIGITS)}
    # l and 1 are written for each other and 1 for i, so the three are one letter.
    return {p: "i" if c == "l" else c for p, c in (table | {ord("l"): "i", ord("L"): "i"}).items()}


def fold(text: str, table: dict[int, str | None]) -> str:
    """The words of a text in folded letters, with one space before and after each."""
    return f" {' '.join(text.translate(table).split())} "


def terms(folded: str) -> set[str]:
    """Every word as `` word `` and its beginnings as `` begin``."""
    words = set(folded.split())
    return {f" {w} " for w in words} | {f" {w[:n]}" for w in words for n in STEMS if len(w) > n}


def automaton(lexicon: dict[str, float], exceptions: tuple[str, ...], table: dict) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for term, weight in lexicon.items():
        found.add_word(term, (len(term), weight))
    for phrase in exceptions:
        phrase = fold(phrase, table)
        found.add_word(phrase, (len(phrase), -1.0))
    if len(found):
        found.make_automaton()
    return found


def measures(folded: str, lexicon: ahocorasick.Automaton) -> tuple[float, float]:
    """Summed weight of the listed words outside of exception phrases, and the same per hundred words, as logarithms."""
    if not len(lexicon):
        return 0.0, 0.0
    best: dict[int, float] = {}
    spared = []
    for end, (length, weight) in lexicon.iter(folded):
        start = end - length + 1
        if weight < 0:
            spared.append((start, end))
        elif weight > best.get(start, 0.0):
            best[start] = weight  # a word counts once, by its best term
    if spared:
        until, reach = [], -1  # phrases come by their ends: of those that begin by a place, the farthest end
        spared.sort()
        for _, end in spared:
            reach = max(reach, end)
            until.append(reach)
        starts = [s for s, _ in spared]
        best = {at: w for at, w in best.items() if not ((i := bisect_right(starts, at)) and at < until[i - 1])}
    total = math.fsum(best.values())
    return math.log1p(total), math.log1p(100 * total / max(1, folded.count(" ") - 1))


def held_out(key: str = "doc_id"):
    """Rows that labels may not be learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Terms and weights (logarithms of odds) from (text, toxic) rows; what the sample's toxic texts hold bounds them."""
    table = _table()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            clean, toxic = Counter(), Counter()
            for text, label in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                (toxic if label else clean).update(terms(fold(text.as_py() or "", table)))
            names = list(clean.keys() | toxic.keys())
            columns = [pa.array(names, pa.string()), *(pa.array([c[n] for n in names], pa.int64()) for c in (toxic, clean))]
            yield pa.RecordBatch.from_arrays(columns, names=["term", "toxic", "clean"])

    bad, good = sample.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    if not bad or not good:
        return {}
    counts = sample.select("text", "toxic").mapInArrow(count, "term string, toxic long, clean long")
    counts = counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = ((F.col("toxic") + 0.5) / (bad + 1)) / ((F.col("clean") + 0.5) / (good + 1))
    listed = counts.where((F.col("toxic") >= LEAST_DOCUMENTS) & (odds >= LEAST_ODDS)).select("term", F.log(odds).alias("weight"))
    return {r["term"]: r["weight"] for r in listed.collect()}


def learn_exceptions(sample: DataFrame, lexicon: dict[str, float]) -> tuple[str, ...]:
    """Folded phrases around listed words that only clean documents hold; what the sample's clean texts hold bounds them."""
    table = _table()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = automaton(lexicon, (), table)
        for batch in slices(batches):
            clean, toxic = Counter(), Counter()
            for text, label in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                folded = fold(text.as_py() or "", table)
                (toxic if label else clean).update(phrases(folded, matcher))
            names = list(clean.keys() | toxic.keys())
            columns = [pa.array(names, pa.string()), *(pa.array([c[n] for n in names], pa.int64()) for c in (toxic, clean))]
            yield pa.RecordBatch.from_arrays(columns, names=["phrase", "toxic", "clean"])

    counts = sample.select("text", "toxic").mapInArrow(count, "phrase string, toxic long, clean long")
    counts = counts.groupBy("phrase").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    return tuple(sorted(r["phrase"] for r in counts.where((F.col("toxic") == 0) & (F.col("clean") >= LEAST_CLEAN)).collect()))


def phrases(folded: str, matcher: ahocorasick.Automaton) -> set[str]:
    """The phrases of PHRASE_WORDS words of a folded text that hold a listed word."""
    starts = {end - length + 1 for end, (length, _) in matcher.iter(folded)}
    if not starts:
        return set()
    words, found, at = folded.split(), set(), 0
    for place, word in enumerate(words):
        if at in starts:
            for many in PHRASE_WORDS:
                for first in range(max(0, place - many + 1), min(place, len(words) - many) + 1):
                    found.add(f" {' '.join(words[first : first + many])} ")
        at += len(word) + 1
    return found


def fit_curve(rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Coefficients of a logistic curve over the two measures and a constant, by Newton's method with a small ridge."""
    x, beta = np.column_stack([rows, np.ones(len(rows))]), np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (labels - p) - 0.01 * beta
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 0.01 * np.eye(3), gradient)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return beta


def toxicity(docs: DataFrame, labels: DataFrame, exceptions: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per input row; whole texts are matched.

    The lexicon, the phrases in which a listed word means no harm (``exceptions`` are added to them) and the curve are
    learned from the labelled documents outside of the held-out ones, from LABEL_SAMPLE
    of them at most; a document with several labels is toxic if one says so, labels of NULL don't count. Without
    labels of both kinds every score is 0. NULL and empty texts score like a text without listed words. Repeated
    rows score alike; a NULL doc_id is not held out; an empty table gives no rows. Other columns are not looked at.
    """
    table = _table()
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out())
    few = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABEL_SAMPLE)
    # Of the rows of one doc_id the one of the smallest text, so that the sample has as many rows as labelled ids.
    sample = cut(chosen.join(F.broadcast(few), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")).select("text", "toxic"))
    lexicon = learn_lexicon(sample)
    exceptions = (*exceptions, *(learn_exceptions(sample, lexicon) if lexicon else ()))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = automaton(lexicon, exceptions, table)
        for batch in slices(batches):
            found = [measures(fold(t.as_py() or "", table), matcher) for t in batch.column("text")]
            columns = [batch.column(c) for c in batch.schema.names if c != "text"]
            columns += [pa.array([f[i] for f in found], pa.float64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=[*(c for c in batch.schema.names if c != "text"), "x", "y"])

    beta = None
    if lexicon:
        rows = np.array([tuple(r) for r in sample.mapInArrow(measure, "toxic int, x double, y double").collect()])
        beta = fit_curve(rows[:, 1:], rows[:, 0])
    logit = F.lit(0.0) if beta is None else F.col("x") * float(beta[0]) + F.col("y") * float(beta[1]) + float(beta[2])
    score = F.lit(0.0) if beta is None else 1 / (1 + F.exp(-logit))
    scored = chosen.mapInArrow(measure, "doc_id long, x double, y double").select("doc_id", held_out().alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
