"""Toxicity by a weighted lexicon, matched with Aho-Corasick automata.

Texts are folded first: compatibility forms and accents go, homoglyphs of other scripts become
Latin letters, digits and signs inside a word become the letters they stand for, and words spelt
with separators or spaced letters are joined. The lexicon holds whole words and word beginnings
(stems) with log-odds weights, learnt from the labelled rows of the training folds on top of a
short list of insults. A match counts once per word, by its heaviest entry; words covered by an
exception phrase don't count. The sums, normalised by length, go through a calibrated logistic.

Training takes at most ``TRAIN_ROWS`` labelled rows per class, picked by a hash of the id. Term
counts are one aggregation; at most ``LEXICON`` entries reach the driver. All documents are scored
where they lie, whole, with the automata built once per worker from the bounded lexicon.

Defined results: null and empty texts score as a text without matches; without labels the seed
list alone, with fixed coefficients, gives the score; null labels and ids are skipped in training;
repeated rows score alike; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tripsight.llm.common import batch, held_out_remainder, rows_of

#: Most labelled rows of each class that training takes, and most entries of the lexicon.
TRAIN_ROWS, LEXICON = 6000, 4000
#: Stem lengths that may become entries, and the fewest toxic training texts that hold an entry.
STEMS, LEAST_TEXTS = (4, 5, 6, 7), 4
#: Least share of toxic texts (by class rates) among those that hold an entry.
LEAST_PURITY = 0.9
#: Weight of an entry of the seed list that training has not seen.
SEED_WEIGHT = 3.0

#: Insults known without training, and phrases in which such words are harmless.
SEED_WORDS = ["idiot", "moron", "imbecile", "scum", "loser", "stupid", "dumbass", "retard", "worthless", "pathetic",
              "disgusting", "bastard", "asshole", "bitch", "shithead", "dickhead", "trash", "clown", "subhuman"]
EXCEPTIONS = ["trash can", "trash bin", "trash bag", "take out the trash", "trash collection", "class clown",
              "circus clown", "clown fish", "clown car", "sore loser", "pond scum", "soap scum", "weight loser"]
#: Letters of other scripts and signs that look like Latin letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ɡ": "g", "ɩ": "i",
    "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "u", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ð": "d", "ħ": "h", "ß": "ss",
    "æ": "ae", "œ": "oe", "þ": "th"}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a",
          "$": "s", "!": "i", "|": "i", "+": "t", "€": "e", "£": "l"}

_HOMOGLYPHS = str.maketrans(HOMOGLYPHS)
_MIXED = re.compile(r"(?<![a-z0-9@$!|+€£])(?=[a-z0-9@$!|+€£]*[a-z])[0-9@$!|+€£]*[a-z][a-z0-9@$!|+€£]*"
                    r"[0-9@$!|+€£]+[a-z][a-z0-9@$!|+€£]*|(?<![a-z0-9@$!|+€£])[0-9@$]+[a-z][a-z]+")
_DIGITS = str.maketrans(DIGITS)
_SIGNS = re.compile(r"[0-9@$!|+€£]")
_SPACED = re.compile(r"(?<![a-z])[a-z](?:[ .\-_*][a-z]){3,}(?![a-z])")
_JOINED = re.compile(r"(?<=[a-z])[­​-‏⁠﻿*_]+(?=[a-z])")
_GAPS = re.compile(r"[^a-z]+")


def fold(text: str) -> str:
    """Folded words of a text, each with one space before and behind."""
    t = text.lower()
    if not t.isascii():
        t = unicodedata.normalize("NFKD", t)
        t = "".join(c for c in t if not unicodedata.combining(c)) if not t.isascii() else t
        if not t.isascii():
            t = t.translate(_HOMOGLYPHS)
    if _SIGNS.search(t):
        t = _MIXED.sub(lambda m: m[0].translate(_DIGITS), t)
    t = _JOINED.sub("", t)
    t = _SPACED.sub(lambda m: re.sub(r"[^a-z]", "", m[0]), t)
    return " " + _GAPS.sub(" ", t).strip() + " "


@dataclass
class Lexicon:
    """Entries (a trailing ``*`` marks a stem) with weights, exception phrases, and the logistic."""

    weights: dict[str, float]
    exceptions: list[str]
    coef: list[float] = field(default_factory=lambda: [-4.0, 2.0, 6.0, 0.5])
    prior: float | None = None
    name: str = ""

    def __post_init__(self):
        self.name = hashlib.sha256(repr((sorted(self.weights.items()), self.exceptions)).encode()).hexdigest()


_automata: dict[str, tuple] = {}


def _automaton(lex: Lexicon):
    k = lex.name
    if k not in _automata:
        a, x = ahocorasick.Automaton(), ahocorasick.Automaton()
        for w, v in lex.weights.items():
            pattern = " " + w[:-1] if w.endswith("*") else f" {w} "
            a.add_word(pattern, (len(pattern), v))
        for p in lex.exceptions:
            x.add_word(f" {p} ", len(p) + 2)
        for m in (a, x):
            if len(m):
                m.make_automaton()
        _automata.clear()
        _automata[k] = a, x
    return _automata[k]


def measure(folded: str, lex: Lexicon) -> tuple[int, float, int, float]:
    """Matched words, their weight, all words and the heaviest match of a folded text."""
    a, x = _automaton(lex)
    n = folded.count(" ") - 1 if len(folded) > 2 else 0
    best: dict[int, float] = {}  # by the place of the word
    if len(a):
        for end, (size, v) in a.iter(folded):
            at = end - size + 1
            if v > best.get(at, 0.0):
                best[at] = v
    if best and len(x):
        for end, size in x.iter(folded):
            for at in [p for p in best if end - size + 1 <= p < end]:
                del best[at]
    return len(best), sum(best.values()), n, max(best.values(), default=0.0)


def inputs(text: str | None, lex: Lexicon) -> list[float]:
    """Constant, matches (log), weight per word (square root) and heaviest match of a text."""
    hits, weight, n, top = measure(fold(text or ""), lex)
    return [1.0, math.log1p(hits), math.sqrt(weight / (n + 20)), top]


def score_of(x: np.ndarray, lex: Lexicon) -> np.ndarray:
    if lex.prior is not None:
        return np.full(len(x), lex.prior)
    return 1 / (1 + np.exp(-np.clip(x @ np.array(lex.coef), -30, 30)))


_TERMS = pa.schema([("term", pa.string()), ("y", pa.int32())])


def _terms(batches):
    """Each distinct word and stem of a text, once."""
    for texts, ys in rows_of(batches, "text", "y"):
        for t, y in zip(texts, ys):
            words = set(fold(t).split())
            terms = {w for w in words if 3 <= len(w) <= 40}
            for k in STEMS:
                terms.update(w[:k] + "*" for w in words if len(w) > k)
            if terms:
                yield batch(_TERMS, term=list(terms), y=[y] * len(terms))


_INPUTS = pa.schema([("y", pa.int32()), ("x", pa.list_(pa.float64()))])


def _measured(lex: Lexicon):
    def run(batches):
        for texts, ys in rows_of(batches, "text", "y"):
            yield batch(_INPUTS, y=ys, x=[inputs(t, lex) for t in texts])

    return run


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 0.5) -> np.ndarray:
    b = np.zeros(x.shape[1])
    t = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))  # smoothed targets
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (w * (p - t)) + ridge * np.r_[0, b[1:]]
        h = (x * (w * p * (1 - p))[:, None]).T @ x + np.diag(np.r_[1e-6, np.full(len(b) - 1, ridge)])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 1.0 / (abs(step).max() + 1e-12))
        b -= step
        if abs(step).max() < 1e-7:
            break
    return b


def train_toxicity(docs: DataFrame, labels: DataFrame, mod: int = 5, held_out: int = 0,
                   train_rows: int = TRAIN_ROWS) -> Lexicon:
    """Learn lexicon and logistic from at most ``train_rows`` labelled rows per class."""
    base = {w: SEED_WEIGHT for w in SEED_WORDS}
    lab = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
           .where(held_out_remainder("doc_id", mod) != held_out)
           .select("doc_id", (F.col("toxic") > 0).cast("int").alias("y"),
                   F.xxhash64(F.lit("toxicity"), "doc_id").alias("key")))
    totals = {r["y"]: r["n"] for r in lab.groupBy("y").agg(F.count("*").alias("n")).collect()}  # two rows at most
    if not totals.get(1) or not totals.get(0):
        return Lexicon(base, EXCEPTIONS)
    picked = [lab.where(F.col("y") == c).orderBy("key", "doc_id").limit(train_rows) for c in (0, 1)]
    sample = F.broadcast(picked[0].unionByName(picked[1]))  # at most 2 * train_rows rows of numbers
    texts = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(sample, "doc_id")
             .select("text", "y"))
    n1, n0 = min(totals[1], train_rows), min(totals[0], train_rows)
    counts = (texts.mapInArrow(_terms, "term string, y int").groupBy("term")
              .agg(F.sum("y").alias("pos"), F.count("*").alias("all"))
              .where(F.col("pos") >= LEAST_TEXTS)
              .withColumn("p1", (F.col("pos") + 0.05) / n1).withColumn("p0", (F.col("all") - F.col("pos") + 0.05) / n0)
              .where(F.col("p1") / (F.col("p1") + F.col("p0")) >= LEAST_PURITY)
              .withColumn("weight", F.log(F.col("p1") / F.col("p0")))
              .orderBy(F.desc(F.col("weight") * F.sqrt("pos")), "term").limit(LEXICON))
    learnt = {r["term"]: float(r["weight"]) for r in counts.select("term", "weight").collect()}
    lex = Lexicon({**base, **learnt}, EXCEPTIONS)
    rows = texts.mapInArrow(_measured(lex), "y int, x array<double>").limit(4 * train_rows).toArrow()
    y = np.array(rows.column("y").to_pylist(), dtype=float)
    x = np.array(rows.column("x").to_pylist(), dtype=float)
    share = totals[1] / (totals[0] + totals[1])
    w = np.where(y > 0, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    lex.coef = _logistic(x, y, w).tolist()
    return lex


def _scorer(lex: Lexicon, schema: pa.Schema, names: list[str]):
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            texts = b.column(b.schema.get_field_index("text")).to_pylist()
            x = np.array([inputs(t, lex) for t in texts])
            hits = pa.array(np.round(np.expm1(x[:, 1])).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(n)) for n in names),
                                              pa.array(score_of(x, lex)), hits], names=schema.names)

    return run


def score_toxicity(docs: DataFrame, lex: Lexicon, keep: list[str]) -> DataFrame:
    """The ``keep`` columns, ``_toxicity`` (the score) and ``_toxic_words`` (matches); no shuffle."""
    out = StructType([docs.schema[c] for c in keep]
                     + [StructField("_toxicity", DoubleType()), StructField("_toxic_words", LongType())])
    src = docs.select(*dict.fromkeys([*keep, "text"]))
    return src.mapInArrow(_scorer(lex, to_arrow_schema(out), keep), out)
