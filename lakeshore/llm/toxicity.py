"""Toxicity by a weighted lexicon, matched by Aho-Corasick over folded text.

Folding maps look-alike letters, accents and digit substitutions to one plain letter, so
that a disguised word matches the plain one.  The lexicon holds whole words and beginnings
of words with their log-odds; exception phrases void the matches that they contain.  A
text's score is a logistic function of the matched weight, by itself and per word.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshore.llm.common import saved, work_folder
from lakeshore.sources.tables import read_table

#: Letters of other scripts that look like Latin ones, and digits read as letters.
LOOKALIKES = dict(zip("аеорсхуіѕјԁһкмтвнαοινρτκυεηχ", "aeopcxyisjdhkmtbhaoivptkuenx", strict=True))
DIGITS = dict(zip("0134578", "oieastb", strict=True))
#: Beginnings of words of these lengths are lexicon candidates besides whole words.
PREFIXES = (4, 5, 6)
#: Bound of the training sample (rows of each label), and so of the lexicon.
SAMPLE_ROWS = 20_000
#: A lexicon entry occurs in so many toxic texts, and its odds ratio, at the lower end of a
#: one-sided 95 % interval, reaches so much.
MIN_SUPPORT = 4
MIN_ODDS = 8.0
INTERVAL = 1.645
#: An exception phrase occurs in so many texts that are not toxic, and in fewer toxic ones.
MIN_EXCEPTION = 3
RIDGE = 0.05

_HIDDEN = re.compile(r"[\xad\u200b-\u200d\u2060\ufeff]")
_WORD = re.compile(r"\S+")
_INSIDE = re.compile(r"(?<=[A-Za-z0-9])[$@](?=[A-Za-z0-9])")


def _plain(char: str) -> str:
    """One folded character: a letter's plain form, or a blank for what is no letter."""
    low = char.lower()[:1]
    if low in DIGITS:
        return DIGITS[low]
    base = LOOKALIKES.get(low) or unicodedata.normalize("NFKD", low)[:1].lower()
    base = LOOKALIKES.get(base, base)
    if not base.isalpha():
        return DIGITS.get(base, " ")
    return "i" if base in "lı" else base  # l, 1 and i are one letter


class _Table(dict):
    def __missing__(self, code: int) -> str:
        value = self[code] = _plain(chr(code))
        return value


_TABLE = _Table()
_LATIN = bytes(ord(c) if (c := _plain(chr(b))).isascii() else 32 for b in range(256))


def fold(text: str) -> str:
    """The text in folded letters and blanks, with a blank at either end."""
    if "$" in text or "@" in text:
        text = _INSIDE.sub(lambda m: "s" if m[0] == "$" else "a", text)
    try:
        folded = text.encode("latin-1").replace(b"\xad", b"").translate(_LATIN).decode("ascii")
    except UnicodeEncodeError:
        folded = _HIDDEN.sub("", text).translate(_TABLE)
    return f" {folded} "


@dataclass(frozen=True)
class Model:
    """Weights of folded words (" word ") and beginnings (" begin"), exception phrases
    (" some words "), and the coefficients of the score."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    coefficients: tuple[float, float, float] = (-4.0, 1.0, 1.0)

    def matcher(self) -> Matcher:
        return Matcher(self)


class Matcher:
    def __init__(self, model: Model):
        self.model = model
        self.automaton = ahocorasick.Automaton()
        for pattern, weight in model.weights.items():
            self.automaton.add_word(pattern, (len(pattern), weight))
        for phrase in model.exceptions:
            self.automaton.add_word(phrase, (len(phrase), None))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, float]]:
        """(start, weight) of each matched word, that of its longest match; words inside an
        exception phrase are left out."""
        if not len(self.automaton):
            return []
        found: dict[int, tuple[int, float]] = {}
        void = []
        for end, (size, weight) in self.automaton.iter(folded):
            start = end - size + 1
            if weight is None:
                void.append((start, end))
            elif start not in found or size > found[start][0]:
                found[start] = (size, weight)
        out, void, at, reach = [], sorted(void), 0, -1
        for start, (_, weight) in sorted(found.items()):
            while at < len(void) and void[at][0] <= start:
                reach = max(reach, void[at][1])
                at += 1
            if start >= reach:
                out.append((start, weight))
        return out

    def features(self, text: str) -> tuple[float, float]:
        """Matched weight, and matched weight per hundred words, both as log(1 + x)."""
        total = sum(w for _, w in self.hits(fold(text)))
        return math.log1p(total), math.log1p(100 * total / max(1, len(text.split())))

    def score(self, text: str) -> float:
        a, b, c = self.model.coefficients
        x, y = self.features(text)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * x + c * y))))


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``text, toxic`` of labelled rows outside the held-out fold, at most ``rows`` of each
    label, in the order of a hash of doc_id.  The sample's ids are few enough to broadcast."""
    usable = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
              .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out()).distinct())
    some = [usable.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for k in (0, 1)]
    ids = F.broadcast(some[0].unionByName(some[1]))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id").select("text", "toxic")


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def _counted(sample: DataFrame, features) -> DataFrame:
    """``feature, pos, neg``: texts of either label with the feature; counts are summed in
    each task before they are shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = features()
        for batch in batches:
            seen = (Counter(), Counter())
            for text, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                seen[toxic].update(find(fold(text or "")))
            names = list(seen[0] | seen[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *(pa.array([seen[k][n] for n in names], pa.int64()) for k in (1, 0))],
                names=["feature", "pos", "neg"])

    counts = sample.mapInArrow(run, "feature string, pos long, neg long")
    return counts.groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _words_and_beginnings():
    def find(folded: str) -> set[str]:
        words = set(folded.split())
        return {f" {w} " for w in words} | {f" {w[:n]}" for w in words for n in PREFIXES if len(w) > n}
    return find


def _lexicon(counts: DataFrame, toxic: int, clean: int) -> dict[str, float]:
    """The entries by log-odds; of an entry and longer ones that begin with it, the first.
    All that begin with an entry share its first letters, so they are compared in a group."""
    odds = ((F.col("pos") + 0.5) / F.lit(toxic + 1.0)) / ((F.col("neg") + 0.5) / F.lit(clean + 1.0))
    spread = INTERVAL * F.sqrt(1 / (F.col("pos") + 0.5) + 1 / (F.col("neg") + 0.5))
    alike = (counts.where(F.col("pos") >= MIN_SUPPORT).withColumn("odds", odds)
             .where(F.log("odds") - spread >= math.log(MIN_ODDS))
             .groupBy(F.substring("feature", 1, 1 + min(PREFIXES))).agg(F.collect_list(F.struct("feature", "odds")).alias("entries")))
    first = F.filter("entries", lambda e: ~F.exists("entries", lambda o: (
        F.length(o["feature"]) < F.length(e["feature"])) & e["feature"].startswith(o["feature"])))
    kept = alike.select(F.inline(first)).orderBy("feature").collect()
    return {row["feature"]: math.log(row["odds"]) for row in kept}


def _contexts(model: Model):
    """The phrases around a text's matches: the word, with the one before, with the one after."""
    def build():
        matcher = model.matcher()

        def find(folded: str) -> set[str]:
            out = set()
            if hits := matcher.hits(folded):
                words = folded.split()
                place = {m.start(): k for k, m in enumerate(_WORD.finditer(folded))}
                for start, _ in hits:
                    k = place[start + 1]  # an entry begins with the blank before its word
                    out |= {f" {' '.join(words[a:b])} " for a, b in ((k, k + 1), (max(0, k - 1), k + 1), (k, k + 2))}
            return out
        return find
    return build


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression with a small ridge, by Newton's method; classes weigh alike."""
    x = np.column_stack([np.ones(len(x)), x])
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    beta = np.zeros(3)
    ridge = np.diag([1e-6, RIDGE, RIDGE]) / 10
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + ridge @ beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(3)
        step = np.linalg.solve(hessian, gradient)
        beta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled rows outside the held-out fold.

    Without a labelled toxic row the lexicon is empty and every score is low.
    """
    spark = docs.sparkSession
    sample = saved(training_sample(docs, labels), work_folder(spark, "toxicity-sample"))
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic:
        return Model({})
    model = Model(_lexicon(_counted(sample, _words_and_beginnings), toxic, clean))
    phrases = (_counted(sample, _contexts(model)).where((F.col("neg") >= MIN_EXCEPTION) & (F.col("neg") * toxic > 3 * F.col("pos") * clean))
               .orderBy(F.desc("neg"), "feature").collect())
    model = Model(model.weights, tuple(r["feature"] for r in phrases))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = model.matcher()
        for batch in batches:
            found = [matcher.features(t or "") for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[k] for f in found], pa.float64()) for k in (0, 1)] + [batch.column(1)], names=["x", "y", "toxic"])

    points = sample.mapInArrow(run, "x double, y double, toxic int").toPandas()  # the sample's bound holds
    return Model(model.weights, model.exceptions, _fit(points[["x", "y"]].to_numpy(), points["toxic"].to_numpy()))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with a ``score`` of its text (0 to 1); a null text scores as an empty one.
    Texts that fold alike have equal scores.  A column ``score`` of ``docs`` is replaced."""
    kept = [f for f in docs.schema if f.name != "score"]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = model.matcher()
        for batch in batches:
            values = pa.array([matcher.score(t or "") for t in batch.column(text).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), values], names=[*names, "score"])

    return docs.select(*[docs[n] for n in names]).mapInArrow(run, T.StructType([*kept, T.StructField("score", T.DoubleType())]))


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents; rows of the held-out fold take no part in training."""
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs, read_table(spark, sf_dir, "labels"))
    scored = score(docs.select("doc_id", "text"), model).drop("text")
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
