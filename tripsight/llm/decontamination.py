"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

1. Items and documents are lower-cased, stripped of ASCII punctuation and split into words. Every
   run of ``SEED`` words of an item is a possible seed (a shorter item is its own seed).
2. One scan of the documents looks their runs up in a Bloom filter of fixed size over the items'
   seeds, so only runs that an item very likely holds leave the scan, as (hash, document, place).
   Each task first joins the hits of one document and seed into one row.
3. A join with the seed table makes them exact and gives (document, item, diagonal) candidates.
   Every pair that shares a seed is a candidate, with all its diagonals: how many documents hold a
   seed says nothing about the one pair at hand, so no seed is dropped for being frequent.
4. A stretch of the document around each diagonal is passed over if it holds too few words of the
   item for any alignment to reach the score (a bound, so nothing is lost). Word-level
   Smith-Waterman aligns the item with the others, and a document is contaminated if the best local
   alignment scores at least ``MIN_SCORE`` of a perfect one.

Only the bounded filter is broadcast. The item side of every join is a shuffled (or measured)
side; an item that a third of all documents hold has its pairs dealt by (item, document salt).

Defined results: null and empty texts and items give no pairs; repeated rows give one pair per
(doc_id, item_id); null ids are left out; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripsight.llm.common import as_long, batch, freeing, handover, ngram_hashes, rows_of, word_hashes

#: Words of a seed.
SEED = 4
#: Part of a perfect alignment's score that makes a document contaminated, and its fewest matches
#: (items with fewer words need all of theirs).
MIN_SCORE = 0.5
MIN_MATCHES = 8
#: Alignment scores.
MATCH, MISMATCH, GAP = 2, -1, -1
#: Bits of the seed filter (bounded, whatever the number of items), probes per seed.
FILTER_BITS, PROBES = 1 << 23, 4
#: Cells of one batch of alignments.
CELLS = 1 << 20
#: Salts over which the pairs of one item are dealt.
SALTS = 64

#: The punctuation that is dropped from words.
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8").lower().translate(None, PUNCTUATION).split()


def seed_hashes(h: np.ndarray, n: int) -> np.ndarray:
    return ngram_hashes(h, n) ^ np.uint64(n)


def _probes(h: np.ndarray) -> np.ndarray:
    """Bit numbers of each hash in the filter, one row per probe."""
    a, b = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([(a + b * np.uint64(i)) % np.uint64(FILTER_BITS) for i in range(PROBES)]).astype(np.int64)


_SEEDS = pa.schema([("item_id", pa.int64()), ("seed", pa.int64()), ("at", pa.int32()), ("n", pa.int32()),
                    ("item_words", pa.int32())])


@freeing
def _item_seeds(batches):
    for ids, texts in rows_of(batches, "item_id", "text"):
        rows = []
        for i, t in zip(ids, texts):
            h = word_hashes(words_of(t))
            n = min(SEED, len(h))
            if n:
                rows += [(i, int(s), at, n, len(h)) for at, s in enumerate(as_long(seed_hashes(h, n)))]
        if rows:
            yield batch(_SEEDS, **dict(zip(_SEEDS.names, map(list, zip(*rows)))))


_BITS = pa.schema([("word", pa.int64()), ("bits", pa.int64())])


@freeing
def _filter_words(batches):
    """The filter as 64-bit words with at least one bit set."""
    bits = np.zeros(FILTER_BITS, dtype=bool)
    for (seeds,) in rows_of(batches, "seed"):
        bits[_probes(np.array(seeds, dtype=np.int64).view(np.uint64)).ravel()] = True
    words = np.packbits(bits, bitorder="little").view(np.int64)
    at = np.flatnonzero(words)
    if len(at):
        yield batch(_BITS, word=at, bits=words[at])


_HITS = pa.schema([("seed", pa.int64()), ("doc_id", pa.int64()), ("places", pa.list_(pa.int32()))])


def _scan(bits: np.ndarray, sizes: list[int]):
    def run(batches):
        for ids, texts in rows_of(batches, "doc_id", "text"):
            out_s, out_d, out_p = [], [], []
            for d, t in zip(ids, texts):
                h = word_hashes(words_of(t))
                for n in sizes:
                    s = seed_hashes(h, n)
                    if not len(s):
                        continue
                    at = np.arange(len(s))
                    for p in range(PROBES):  # few survive the first probe
                        x = s[at]
                        bit = ((x & np.uint64(0xFFFFFFFF)) + ((x >> np.uint64(32)) | np.uint64(1)) * np.uint64(p)) \
                            % np.uint64(FILTER_BITS)
                        at = at[bits[bit.astype(np.int64)]]
                        if not len(at):
                            break
                    if len(at):
                        found = as_long(s[at])
                        o = np.argsort(found, kind="stable")
                        found, at = found[o], at[o]
                        cut = np.flatnonzero(found[1:] != found[:-1]) + 1
                        out_s += found[np.r_[0, cut]].tolist()
                        out_p += [x.astype(np.int32) for x in np.split(at, cut)]
                        out_d += [d] * (len(cut) + 1)
            if out_s:
                yield batch(_HITS, seed=out_s, doc_id=out_d, places=out_p)

    return run


def align(item: np.ndarray, stretches: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of one item with each padded stretch (rows; -1 pads).

    Returns the score, the matched words on its path and its last column, by row. Gaps along the
    stretch come from a running maximum; matches travel with the cell they score in.
    """
    n, width = stretches.shape
    j = np.arange(width)
    h = np.zeros((n, width + 1), dtype=np.int32)
    m = np.zeros((n, width + 1), dtype=np.int32)
    best, hits, end = (np.zeros(n, dtype=np.int32) for _ in range(3))
    rows = np.arange(n)
    for w in item:
        eq = stretches == w
        diag = h[:, :-1] + np.where(eq, MATCH, MISMATCH)
        up = h[:, 1:] + GAP
        take = diag >= up
        cell = np.maximum(np.where(take, diag, up), 0)
        got = np.where(take, m[:, :-1] + eq, m[:, 1:]) * (cell > 0)
        # gap along the row: the best earlier cell, less one per step
        key = (cell - GAP * j).astype(np.int64) * (width + 1) + (width - j)
        lead = np.maximum.accumulate(key, axis=1)
        src = width - lead % (width + 1)
        cell2 = (lead // (width + 1) + GAP * j).astype(np.int32)
        h = np.concatenate([np.zeros((n, 1), np.int32), np.maximum(cell2, 0)], axis=1)
        m = np.concatenate([np.zeros((n, 1), np.int32), np.take_along_axis(got, src, axis=1) * (cell2 > 0)],
                           axis=1).astype(np.int32)
        top = h.argmax(axis=1)
        better = h[rows, top] > best
        best = np.where(better, h[rows, top], best)
        hits = np.where(better, m[rows, top], hits)
        end = np.where(better, top, end)
    return best, hits, end


def most_matches(item: np.ndarray, stretches: np.ndarray) -> np.ndarray:
    """No alignment of the item with a stretch (rows; -1 pads) has more matches than this.

    Words of the item that the stretch holds, each at most as often as it stands in either.
    """
    own = np.bincount(item)
    row, col = np.nonzero(stretches >= 0)
    held = np.bincount(row * len(own) + stretches[row, col], minlength=len(stretches) * len(own))
    return np.minimum(held.reshape(len(stretches), len(own)), own).sum(axis=1)


_FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("matches", pa.int64()),
                    ("item_words", pa.int64()), ("doc_start", pa.int64()), ("doc_end", pa.int64())])
_FOUND_DDL = "doc_id long, item_id long, score double, matches long, item_words long, doc_start long, doc_end long"


def _align_rows(min_score: float, min_matches: int):
    def best_of(item: list[bytes], doc: list[bytes], diagonals: list[int]):
        ids = {w: i for i, w in enumerate(dict.fromkeys(item))}
        own = np.array([ids[w] for w in item])
        k = len(item)
        spans, last = [], None
        for d in sorted(set(diagonals)):  # diagonals near one another share a stretch
            if last is not None and d - last <= k // 2:
                spans[-1][1] = max(spans[-1][1], d + 2 * k)
            else:
                spans.append([d - k, d + 2 * k])
            last = d
        spans = [(max(0, a), min(len(doc), b)) for a, b in spans]
        best = (0, 0, 0)
        at = 0
        while at < len(spans):
            width = max(b - a for a, b in spans[at:at + 64])
            some = spans[at:at + max(1, min(64, CELLS // max(1, width)))]
            grid = np.full((len(some), max(b - a for a, b in some)), -1)
            for r, (a, b) in enumerate(some):
                grid[r, :b - a] = [ids.get(w, -1) for w in doc[a:b]]
            at += len(some)
            most = most_matches(own, grid)
            able = np.flatnonzero((most >= min_score * k) & (most >= min(min_matches, k)))
            if not len(able):
                continue
            score, hits, end = align(own, grid[able])
            r = int(score.argmax())
            best = max(best, (int(score[r]), int(hits[r]), some[able[r]][0] + int(end[r])))
        return best

    @freeing
    def run(batches):
        now, doc = None, []
        for ids, items, texts, item_texts, diags in rows_of(batches, "doc_id", "item_id", "text", "item", "diagonals"):
            rows = []
            for d, i, t, it, diag in zip(ids, items, texts, item_texts, diags):
                if d != now:
                    now, doc = d, words_of(t)
                item = words_of(it)
                score, hits, end = best_of(item, doc, diag)
                part = score / (MATCH * len(item))
                if part >= min_score and hits >= min(min_matches, len(item)):
                    rows.append((d, i, part, hits, len(item), max(0, end - len(item)), end))
            if rows:
                yield batch(_FOUND, **dict(zip(_FOUND.names, map(list, zip(*rows)))))

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE,
                  min_matches: int = MIN_MATCHES) -> DataFrame:
    """One row per contaminated pair: doc_id, item_id, score, matches, item_words, doc_start, doc_end.

    ``doc_start`` and ``doc_end`` bound the aligned words of the document (the start assumes an
    alignment as long as the item).
    """
    src = docs.where(F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = (benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull())
             .select(F.col("item_id").cast("long").alias("item_id"), "text").dropDuplicates(["item_id"]))
    seeds = handover(items.mapInArrow(_item_seeds, "item_id long, seed long, at int, n int, item_words int"), "seeds")
    sizes = [r["n"] for r in seeds.select("n").distinct().orderBy("n").collect()]  # at most SEED values
    # the filter: at most FILTER_BITS / 64 words, however many items there are
    words = (seeds.mapInArrow(_filter_words, "word long, bits long")
             .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())
    packed = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    if words.num_rows:
        packed[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    hits = src.mapInArrow(_scan_with(packed, sizes), "seed long, doc_id long, places array<int>")
    hits = handover(hits, "seed-hits")
    places = (hits.join(seeds.select("item_id", "seed", "at"), "seed").select("doc_id", "item_id", F.explode("places").alias("p"), "at")
              .select("doc_id", "item_id", (F.col("p") - F.col("at")).alias("diagonal")))
    pairs = handover(places.groupBy("doc_id", "item_id").agg(F.collect_set("diagonal").alias("diagonals")),
                     "seed-pairs")
    texts = src.join(pairs.select("doc_id").distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    heads = salted.select("item_id", "salt").distinct().join(items.withColumnRenamed("text", "item"), "item_id")
    rows = (salted.join(heads, ["item_id", "salt"]).join(texts, "doc_id")
            .select("doc_id", "item_id", "text", "item", "diagonals"))
    return rows.mapInArrow(_align_rows(min_score, min_matches), _FOUND_DDL)


def _scan_with(packed: np.ndarray, sizes: list[int]):
    """The scan with its filter: a megabyte in the closure, whatever the benchmark's size."""
    @freeing
    def run(batches):
        yield from _scan(np.unpackbits(packed.view(np.uint8), bitorder="little").view(bool), sizes)(batches)

    return run
