"""Quality classifier: a factorisation machine over hashed words and structure statistics.

Inputs of a score are the text alone: hashed words (sub-linear term weights, unit norm), the
structure of the text (repetition, symbols, case, line and word shape) and its size. The
machine's second-order part, sum over pairs <v_i, v_j> x_i x_j, is evaluated in linear time as
half of (sum v x)^2 - sum (v x)^2 per factor. The score is calibrated on held-back training rows
(a logistic of the raw output), so it reads as the chance of a good label.

Training uses at most ``TRAIN_ROWS`` labelled rows per class, picked by a hash of the id; all
documents are scored where they lie, with the fixed-size model in the closure.

Defined results: null text scores as the empty text; an empty or one-class training set gives
its (smoothed) share of good labels as every score; null labels are skipped; a null id takes the
remainder of crc32('') and keeps its null; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from tripsight.llm.common import batch, freeing, held_out_remainder, mix64, rows_of

#: Hash buckets of the word features.
BUCKETS = 2048
#: Rank of the pairwise interactions.
FACTORS = 6
#: Most labelled rows of each class that training takes.
TRAIN_ROWS = 3000
#: Passes of the full-batch optimiser.
STEPS = 250
#: Bytes of text whose features are made at a time.
STRIP = 1 << 19

STATS = ["log_bytes", "log_lines", "word_len", "word_len_sd", "distinct_words", "top_word", "adjacent_repeats",
         "upper", "upper_words", "digits", "symbols", "symbol_runs", "pipes", "bangs", "stops", "repeated_lines",
         "words_per_line", "long_words", "non_ascii", "one_char_words"]
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[np.frombuffer(b"#$%&*+/<=>@[\\]^_`{|}~!?.,;:", dtype=np.uint8)] = True
_RARE_SYMBOL = _SYMBOL.copy()
_RARE_SYMBOL[np.frombuffer(b"!?.,;:", dtype=np.uint8)] = False
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POS = np.random.default_rng(11).integers(1, 1 << 63, 1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_LOWER = np.arange(1, 257, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)


@dataclass
class Features:
    """Structure statistics of each text, and its hashed words as (row, bucket, weight)."""

    stats: np.ndarray
    row: np.ndarray
    idx: np.ndarray
    val: np.ndarray

    def take(self, at: np.ndarray) -> "Features":
        place = np.full(len(self.stats), -1)
        place[at] = np.arange(len(at))
        keep = place[self.row] >= 0
        return Features(self.stats[at], place[self.row[keep]], self.idx[keep], self.val[keep])


def _strip_features(texts: list[bytes], buckets: int) -> Features:
    n = len(texts)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    ends = np.cumsum(sizes + 1)  # each text with one closing space
    by = lambda x: np.add.reduceat(x.view(np.uint8), ends - sizes - 1, dtype=np.int64)
    space = _SPACE[raw]
    edge = np.diff(np.r_[True, space].astype(np.int8))
    w0, w1 = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)  # word starts and ends
    size = np.maximum(sizes, 1)
    upper = (raw >= 65) & (raw <= 90)
    symbol = _SYMBOL[raw]
    run = symbol[1:-1] & symbol[2:] & ~symbol[:-2] if len(raw) > 2 else np.zeros(0, dtype=bool)
    run = np.r_[False, run, False][:len(raw)]
    lens = (w1 - w0).astype(np.float64)
    doc = np.searchsorted(ends, w0, side="right")
    m = np.bincount(doc, minlength=n)
    m1 = np.maximum(m, 1)
    low = _LOWER[raw]
    if len(w0):
        inside = np.arange(len(raw), dtype=np.int32)  # place in the word
        inside[w0[0]:] -= np.repeat(w0.astype(np.int32), np.diff(np.r_[w0, len(raw)]))
        low = low * _POS[inside & 1023]
        low[space] = 0
        h = mix64(np.add.reduceat(low, w0) + (w1 - w0).astype(np.uint64))
    else:
        h = np.zeros(0, dtype=np.uint64)
    word = lambda x: np.add.reduceat(x.view(np.uint8), w0, dtype=np.int64) if len(w0) else w0
    shouted = (word(upper) > 0) & (word((raw >= 97) & (raw <= 122)) == 0)
    again = np.r_[False, (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])][:len(h)]
    mean = np.bincount(doc, weights=lens, minlength=n) / m1
    sd = np.sqrt(np.maximum(np.bincount(doc, weights=lens * lens, minlength=n) / m1 - mean ** 2, 0))
    # distinct words and how often the commonest comes
    key = np.sort((doc.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24)))
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][:len(key)])
    count = np.diff(np.r_[first, len(key)])
    wdoc, whash = (key[first] >> np.uint64(40)).astype(np.int64), key[first]
    distinct = np.bincount(wdoc, minlength=n)
    top = np.zeros(n)
    if len(wdoc):
        d0 = np.flatnonzero(np.r_[True, wdoc[1:] != wdoc[:-1]])
        top[wdoc[d0]] = np.maximum.reduceat(count, d0)
    # lines: the words between line feeds
    line = np.searchsorted(np.flatnonzero(raw == 10), w0) + doc
    l0 = np.flatnonzero(np.r_[True, line[1:] != line[:-1]][:len(line)])
    at = np.arange(len(line)) - np.repeat(l0, np.diff(np.r_[l0, len(line)]))
    lh = mix64(np.add.reduceat(h * _POS[at & 1023], l0)) if len(l0) else h
    ld = doc[l0]
    lines = np.bincount(ld, minlength=n)
    pairs = (np.unique((ld.astype(np.uint64) << np.uint64(40)) | (lh >> np.uint64(24))) >> np.uint64(40)).astype(np.int64)
    share = lambda x, by_: np.bincount(doc, weights=x, minlength=n) / by_
    stats = np.stack([
        np.log1p(sizes), np.log1p(lines), np.minimum(mean, 40), np.minimum(sd, 40), distinct / m1, top / m1,
        share(again, m1), by(upper) / size, share(shouted, m1), by((raw >= 48) & (raw <= 57)) / size,
        by(_RARE_SYMBOL[raw]) / size, np.minimum(by(run) / m1, 2), by(raw == 124) / m1, by(raw == 33) / m1,
        by(raw == 46) / m1, 1 - np.bincount(pairs, minlength=n) / np.maximum(lines, 1) * (lines > 0) - (lines == 0),
        np.log1p(m / np.maximum(lines, 1)), share(lens > 25, m1), by(raw >= 128) / size, share(lens == 1, m1)], axis=1)
    # hashed words: sub-linear weights added up by bucket, each row to unit norm
    key = wdoc * buckets + (whash % np.uint64(buckets)).astype(np.int64)
    o = np.argsort(key, kind="stable")
    k, tf = key[o], np.log1p(count[o])
    f = np.flatnonzero(np.r_[True, k[1:] != k[:-1]][:len(k)])
    val = np.add.reduceat(tf, f) if len(f) else tf
    row, idx = k[f] // buckets, k[f] % buckets
    norm = np.sqrt(np.bincount(row, weights=val * val, minlength=n))
    return Features(stats, row, idx, val / norm[row])


def features(texts: list[str], buckets: int = BUCKETS) -> Features:
    """Features of a list of texts, made a few megabytes at a time."""
    parts_, held, size = [], [], 0
    for t in texts:
        held.append(t.encode("utf-8"))
        size += len(held[-1])
        if size > STRIP:
            parts_.append(_strip_features(held, buckets))
            held, size = [], 0
    if held or not parts_:
        parts_.append(_strip_features(held, buckets) if held else
                      Features(np.zeros((0, len(STATS))), *(np.zeros(0, dtype=np.int64),) * 2, np.zeros(0)))
    base = np.cumsum([0] + [len(p.stats) for p in parts_])
    return Features(np.concatenate([p.stats for p in parts_]), np.concatenate([p.row + b for p, b in zip(parts_, base)]),
                    np.concatenate([p.idx for p in parts_]), np.concatenate([p.val for p in parts_]))


@dataclass
class Machine:
    """Fitted factorisation machine: intercept, linear weights, factors, scaling, calibration."""

    w0: float
    w: np.ndarray
    v: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    prior: float | None = None

    def raw(self, x: Features) -> np.ndarray:
        """Raw outputs: the linear part and half of (sum v x)^2 - sum (v x)^2 per factor."""
        z = np.clip((x.stats - self.mean) / self.scale, -6, 6)
        k, n = z.shape[1], len(z)
        s = z @ self.v[:k]
        q = (z * z) @ (self.v[:k] ** 2)
        at = x.idx + k
        out = self.w0 + z @ self.w[:k] + np.bincount(x.row, weights=self.w[at] * x.val, minlength=n)
        for f in range(self.v.shape[1]):
            vx = self.v[at, f] * x.val
            s[:, f] += np.bincount(x.row, weights=vx, minlength=n)
            q[:, f] += np.bincount(x.row, weights=vx * vx, minlength=n)
        return out + 0.5 * (s * s - q).sum(axis=1)

    def score(self, x: Features) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(x.stats), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(x) + self.shift, -30, 30)))


def _calibrate(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic of the raw output (smoothed targets, damped Newton steps)."""
    mid, sd = raw.mean(), raw.std() + 1e-9
    z = (raw - mid) / sd
    t = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        g = np.array([((p - t) * z).sum() + 0.01 * a, (p - t).sum()])
        r = p * (1 - p)
        h = np.array([[(r * z * z).sum() + 0.01, (r * z).sum()], [(r * z).sum(), r.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 0.5 / (abs(step).max() + 1e-12))
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-7:
            break
    return float(a / sd), float(b - a * mid / sd)


def fit_machine(x: Features, y: np.ndarray, share: float, buckets: int = BUCKETS, factors: int = FACTORS,
                steps: int = STEPS, l2: float = 2e-4, seed: int = 7) -> Machine:
    """Fit on a bounded sample. ``share``: the share of good labels among all training labels."""
    k = x.stats.shape[1]
    if len(y) < 10 or y.min() == y.max():
        p = (share * len(y) + 1) / (len(y) + 2)
        return Machine(0, np.zeros(k + buckets), np.zeros((k + buckets, factors)), np.zeros(k), np.ones(k), prior=p)
    rng = np.random.default_rng(seed)
    mean, scale = x.stats.mean(axis=0), x.stats.std(axis=0) + 1e-6
    full = np.zeros((len(y), k + buckets), dtype=np.float32)
    full[:, :k] = np.clip((x.stats - mean) / scale, -6, 6)
    full[x.row, k + x.idx] = x.val
    held = np.arange(len(y)) % 5 == 4  # held back for the calibration
    xt, yt = full[~held], y[~held].astype(np.float32)
    weight = np.where(yt > 0, share / max(yt.mean(), 1e-6), (1 - share) / max(1 - yt.mean(), 1e-6)).astype(np.float32)
    weight /= weight.mean()
    xt2 = xt * xt
    p = {"w0": np.zeros(1, np.float32), "w": np.zeros(k + buckets, np.float32),
         "v": rng.normal(0, 0.02, (k + buckets, factors)).astype(np.float32)}
    m = {n: np.zeros_like(a) for n, a in p.items()}
    u = {n: np.zeros_like(a) for n, a in p.items()}
    for step in range(1, steps + 1):
        s = xt @ p["v"]
        out = p["w0"] + xt @ p["w"] + 0.5 * ((s * s).sum(1) - (xt2 @ (p["v"] ** 2)).sum(1))
        e = weight * (1 / (1 + np.exp(-np.clip(out, -30, 30))) - yt) / len(yt)
        g = {"w0": e.sum(keepdims=True), "w": xt.T @ e + l2 * p["w"],
             "v": xt.T @ (e[:, None] * s) - (xt2.T @ e)[:, None] * p["v"] + l2 * p["v"]}
        for n in p:
            m[n] = 0.9 * m[n] + 0.1 * g[n]
            u[n] = 0.999 * u[n] + 0.001 * g[n] ** 2
            p[n] = p[n] - 0.03 * (m[n] / (1 - 0.9 ** step)) / (np.sqrt(u[n] / (1 - 0.999 ** step)) + 1e-8)
    fm = Machine(float(p["w0"][0]), p["w"].astype(float), p["v"].astype(float), mean, scale)
    at = np.flatnonzero(held)
    if y[at].min() != y[at].max():
        fm.slope, fm.shift = _calibrate(fm.raw(x.take(at)), y[at])
    return fm


_SAMPLE = pa.schema([("y", pa.int32()), ("key", pa.int64()), ("stats", pa.list_(pa.float64())),
                     ("idx", pa.list_(pa.int32())), ("val", pa.list_(pa.float32()))])


@freeing
def _sampled(batches):
    for texts, ys, keys in rows_of(batches, "text", "y", "key"):
        x = features(texts)
        cut = np.searchsorted(x.row, np.arange(1, len(texts)))
        yield batch(_SAMPLE, y=ys, key=keys, stats=list(x.stats), idx=np.split(x.idx.astype(np.int32), cut),
                    val=np.split(x.val.astype(np.float32), cut))


def train_quality(docs: DataFrame, labels: DataFrame, mod: int = 4, held_out: int = 2,
                  train_rows: int = TRAIN_ROWS) -> Machine:
    """Fit on at most ``train_rows`` labelled rows per class outside the held-out fold."""
    lab = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
           .where(held_out_remainder("doc_id", mod) != held_out)
           .select("doc_id", (F.col("quality") > 0).cast("int").alias("y"),
                   F.xxhash64(F.lit("quality"), "doc_id").alias("key")))
    totals = {r["y"]: r["n"] for r in lab.groupBy("y").agg(F.count("*").alias("n")).collect()}  # two rows at most
    picked = [lab.where(F.col("y") == c).orderBy("key", "doc_id").limit(train_rows) for c in (0, 1)]
    sample = F.broadcast(picked[0].unionByName(picked[1]))  # at most 2 * train_rows rows of numbers
    src = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(sample, "doc_id")
           .select("text", "y", "key"))
    rows = (src.mapInArrow(_sampled, "y int, key long, stats array<double>, idx array<int>, val array<float>")
            .limit(4 * train_rows).toArrow())  # a bounded sample; the limit only holds off repeated ids
    y = np.array(rows.column("y").to_pylist(), dtype=float)
    if not len(y):
        return fit_machine(features([]), y, 0.5)
    order = np.lexsort((y, np.array(rows.column("key").to_pylist())))  # the same order on every run
    idx, val = rows.column("idx").to_pylist(), rows.column("val").to_pylist()
    x = Features(np.array(rows.column("stats").to_pylist())[order],
                 np.repeat(np.arange(len(y)), [len(idx[i]) for i in order]),
                 np.concatenate([np.array(idx[i], dtype=np.int64) for i in order]),
                 np.concatenate([np.array(val[i], dtype=float) for i in order]))
    return fit_machine(x, y[order], totals.get(1, 0) / sum(totals.values()))


def _scorer(fm: Machine, schema: pa.Schema):
    @freeing
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            texts = [t or "" for t in b.column(b.schema.get_field_index("text")).to_pylist()]
            keep = [b.column(b.schema.get_field_index(n)) for n in schema.names[:-1]]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(fm.score(features(texts)))], names=[*schema.names])

    return run


def score_quality(docs: DataFrame, fm: Machine, keep: list[str], score_col: str = "_quality_score") -> DataFrame:
    """The ``keep`` columns and ``score_col``, for every row of ``docs``; no shuffle."""
    out = StructType([docs.schema[c] for c in keep] + [StructField(score_col, DoubleType())])
    src = docs.select(*dict.fromkeys([*keep, "text"]))
    return src.mapInArrow(_scorer(fm, to_arrow_schema(out)), out)
