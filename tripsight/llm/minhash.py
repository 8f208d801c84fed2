"""MinHash near-duplicates with sequential Bayesian verification.

1. One scan gives each document its set of five-word shingles, a 128-bit digest of the set and a
   128-value MinHash signature. Equal sets collapse to one representative.
2. 32 bands of 4 values put representatives into buckets. In each bucket the smallest id is the
   hub, and every member is a candidate pair with it (links, not all pairs). Confirmed links give
   first components.
3. Buckets whose other members still lie in different components are compared further, in blocks:
   only pairs across components, each pair in the first band that it shares. Full sets travel with
   a block's rows, so survivors are confirmed there and only links leave the task.
4. Candidates are verified sequentially: signatures are compared batch by batch, and after each batch
   a pair is dropped if the posterior chance (uniform prior) that its similarity reaches the
   threshold is below ``MISS``. Survivors are confirmed by intersecting the full shingle sets.

No pair is emitted for members already connected, and no bucket is capped: a large bucket is cut
into blocks, and pairs of blocks are separate groups of rows.

Misses: a pair at similarity s shares no band with chance (1 - s^4)^32, 5e-6 at 0.75 and less
above; the sequential test adds at most ``MISS`` per look.

Defined results: null and empty texts have an empty set (n_shingles 0) and are linked with
nothing; a text of one to four words has its whole sequence as its only shingle; rows that repeat
a ``doc_id`` are equal rows of one document; rows with a null id are left alone (component null);
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripsight.llm.common import (as_long, batch, freeing, handover, mix64, ngram_hashes, only_ids, parts,
                                  rows_of, word_hashes)
from tripsight.llm.components import components

#: Words of a shingle; similarity threshold as a ratio of whole numbers.
SHINGLE = 5
THRESHOLD = (75, 100)
BANDS, ROWS = 32, 4
PERMS = BANDS * ROWS
#: Signature values per look of the sequential test, and its chance of a wrong drop.
LOOK = 32
MISS = 1e-5
#: Members of one block of a bucket, and partners of a document confirmed in one go.
BLOCK = 512
CONFIRM = 128
#: Shingles hashed at a time when signatures are made.
STRIP = 1 << 15

_rng = np.random.default_rng(20250)
_A = (_rng.integers(0, 1 << 31, PERMS, dtype=np.uint64).astype(np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, PERMS, dtype=np.uint64).astype(np.uint32)


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    h = word_hashes(text.encode("utf-8").lower().split())
    if not len(h):
        return np.empty(0, dtype=np.uint64)
    return np.unique(ngram_hashes(h, min(SHINGLE, len(h))) ^ np.uint64(min(SHINGLE, len(h))))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values, one row of ``PERMS`` per non-empty set."""
    lens = np.array([len(s) for s in sets], dtype=np.int64)
    out = np.full((len(sets), PERMS), 0xFFFFFFFF, dtype=np.uint32)
    if not len(sets):
        return out
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    ends = np.cumsum(lens)
    i = 0
    while i < len(sets):
        start = int(ends[i] - lens[i])
        j = max(i + 1, int(np.searchsorted(ends, start + STRIP, side="right")))
        for lo in range(start, int(ends[j - 1]), 4 * STRIP):  # one very long set is done in strips
            x = flat[lo:min(lo + 4 * STRIP, int(ends[j - 1]))]
            at = (ends[i:j] - lens[i:j] - lo).clip(0) if j > i + 1 else np.zeros(1, dtype=np.int64)
            for p in range(PERMS):
                got = np.minimum.reduceat(x * _A[p] + _B[p], at)
                np.minimum(out[i:j, p], got, out=out[i:j, p])
        i = j
    return out


_SIG = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
                  ("sig", pa.binary())])
_SIG_DDL = "doc_id long, n_shingles long, d1 long, d2 long, sig binary"


@freeing
def _sign(batches):
    for ids, texts in rows_of(batches, "doc_id", "text"):
        for lo in range(0, len(texts), 1024):
            sets = [shingles(t) for t in texts[lo:lo + 1024]]
            full = [s for s in sets if len(s)]
            sig = iter(signatures(full))
            d1 = np.array([s.sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
            d2 = np.array([mix64(s).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
            yield batch(_SIG, doc_id=ids[lo:lo + 1024], n_shingles=[len(s) for s in sets], d1=as_long(d1),
                        d2=as_long(d2), sig=[next(sig).tobytes() if len(s) else None for s in sets])


def least_matches(n: int, t: float = THRESHOLD[0] / THRESHOLD[1], miss: float = MISS) -> int:
    """Fewest matches among ``n`` values at which P(similarity >= t | matches) reaches ``miss``.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1), whose tail is a binomial sum.
    """
    tail = 0.0
    for m in range(n + 1):
        tail += math.comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
        if tail >= miss:
            return m
    return n


_LEAST = {n: least_matches(n) for n in range(LOOK, PERMS + 1, LOOK)}


def sequential(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of signature pairs survive the looks at successive batches of values."""
    alive = np.arange(len(a))
    m = np.zeros(len(a), dtype=np.int32)
    for n in range(LOOK, PERMS + 1, LOOK):
        m = m + (a[alive, n - LOOK:n] == b[alive, n - LOOK:n]).sum(axis=1)
        keep = m >= _LEAST[n]
        alive, m = alive[keep], m[keep]
    return alive


def _as_sig(raws: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raws), dtype=np.uint32).reshape(len(raws), PERMS)


_KEYS = pa.schema([("band", pa.int64()), ("key", pa.int64()), ("id", pa.int64())])


@freeing
def _bands(batches):
    mult = mix64(np.arange(1, ROWS + 1, dtype=np.uint64)) | np.uint64(1)
    for ids, raws in rows_of(batches, "id", "sig"):
        sig = _as_sig(raws).astype(np.uint64).reshape(len(ids), BANDS, ROWS)
        key = mix64((sig * mult).sum(axis=2, dtype=np.uint64))
        yield batch(_KEYS, band=np.tile(np.arange(BANDS), len(ids)), key=as_long(key.ravel()),
                    id=np.repeat(np.array(ids, dtype=np.int64), BANDS))


_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


@freeing
def _survivors(batches):
    """Candidate pairs (with both signatures) that pass the sequential test."""
    for a, b, sa, sb in rows_of(batches, "a", "b", "sa", "sb"):
        at = sequential(_as_sig(sa), _as_sig(sb))
        yield batch(_PAIRS, a=np.array(a, dtype=np.int64)[at], b=np.array(b, dtype=np.int64)[at])


def _runs(batches, keys: list[str], names: list[str]) -> Iterator[tuple[list, ...]]:
    """Rows of each key, from batches sorted by the key."""
    now, held = None, None
    for cols in rows_of(batches, *keys, *names):
        ks = list(zip(*cols[:len(keys)]))
        lo = 0
        for i in range(len(ks) + 1):
            if i < len(ks) and ks[i] == ks[lo]:
                continue
            part = [c[lo:i] for c in cols[len(keys):]]
            if ks[lo] == now:
                for h, x in zip(held, part):
                    h.extend(x)
            else:
                if held:
                    yield now, held
                now, held = ks[lo], part
            lo = i
            if i == len(ks):
                break
    if held:
        yield now, held


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets reach the threshold, by exact counts."""
    t, of = THRESHOLD
    if of * min(len(x), len(y)) < t * max(len(x), len(y)):
        return False
    n = len(np.intersect1d(x, y, assume_unique=True))
    return of * n >= t * (len(x) + len(y) - n)


_SETS = pa.schema([("id", pa.int64()), ("set", pa.binary())])


@freeing
def _sets(batches):
    for ids, texts in rows_of(batches, "doc_id", "text"):
        for lo in range(0, len(ids), 1024):
            yield batch(_SETS, id=ids[lo:lo + 1024], set=[shingles(t).tobytes() for t in texts[lo:lo + 1024]])


@freeing
def _across(batches):
    """Links between components within a block, or across two blocks, of one bucket.

    A pair is looked at in the first band that it shares, if its components still differ, by the
    sequential test and then by the full sets. Links found here merge components at once.
    """
    for (band, _, i, j), (ids, comps, side, raws) in _runs(batches, ["band", "key", "i", "j"],
                                                          ["id", "comp", "side", "set"]):
        comp, ident, sd = np.array(comps), np.array(ids, dtype=np.int64), np.array(side)
        if (comp == comp[0]).all():
            continue
        sets = [np.frombuffer(r, dtype=np.uint64) for r in raws]
        sig = signatures(sets)
        n = len(ident)
        bands = sig.view([("", np.uint32)] * ROWS).reshape(n, BANDS)
        ok_a, ok_b = [], []
        for x in range(n):
            if i == j:
                other = np.flatnonzero(comp[x + 1:] != comp[x]) + x + 1
            else:
                other = np.flatnonzero((comp != comp[x]) & (sd == 1)) if sd[x] == 0 else ()
            if len(other) and band:
                other = other[~(bands[other, :band] == bands[x, :band]).any(axis=1)]
            if not len(other):
                continue
            for y in other[sequential(np.broadcast_to(sig[x], (len(other), PERMS)), sig[other])]:
                if comp[x] != comp[y] and linked(sets[x], sets[y]):
                    ok_a.append(min(ident[x], ident[y]))
                    ok_b.append(max(ident[x], ident[y]))
                    comp[comp == comp[y]] = comp[x]
        if ok_a:
            yield batch(_PAIRS, a=ok_a, b=ok_b)


@freeing
def _confirm(batches):
    """Pairs whose full sets reach the threshold; rows of one first document mostly come together."""
    now, own = None, None
    for a, b, ta, tb in rows_of(batches, "a", "b", "ta", "tb"):
        ok_a, ok_b = [], []
        for x, y, t, u in zip(a, b, ta, tb):
            if x != now:
                now, own = x, shingles(t)
            if linked(own, shingles(u)):
                ok_a.append(x)
                ok_b.append(y)
        if ok_a:
            yield batch(_PAIRS, a=ok_a, b=ok_b)


def _confirmed(pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """The pairs that link, confirmed on whole texts.

    The second text of a pair is shipped with the pair. The first, which may be a hub of very
    many, meets them by (hub, salt): its text is shipped once per salt in use, and no more than
    1/``CONFIRM`` of a hub's pairs share a task key.
    """
    salted = pairs.withColumn("s", F.pmod(F.xxhash64("b"), F.lit(CONFIRM)))
    heads = (salted.select("a", "s").distinct()
             .join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a"))
    tails = salted.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
    both = tails.join(heads, ["a", "s"]).select("a", "b", "ta", "tb")
    return handover(both.mapInArrow(_confirm, "a long, b long"), name)


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    spark = docs.sparkSession
    n = parts(spark)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    signed = handover(src.mapInArrow(_sign, _SIG_DDL), "signatures")
    full = signed.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    reps = handover(full.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("id")), "representatives")
    rep_sig = handover(full.join(reps.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
                       .select(F.col("doc_id").alias("id"), "sig").dropDuplicates(["id"]), "rep-signatures")
    keys = rep_sig.mapInArrow(_bands, "band long, key long, id long")
    hubs = keys.groupBy("band", "key").agg(F.min("id").alias("hub"), F.count("*").alias("size")).where("size > 1")
    buckets = handover(keys.join(hubs, ["band", "key"]).where(F.col("id") != F.col("hub")), "buckets")
    stars = buckets.select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    sa = rep_sig.select(F.col("id").alias("a"), F.col("sig").alias("sa"))
    sb = rep_sig.select(F.col("id").alias("b"), F.col("sig").alias("sb"))
    tested = handover(stars.join(sb, "b").join(sa, "a").mapInArrow(_survivors, "a long, b long"), "star-survivors")
    used = tested.select(F.col("a").alias("id")).unionByName(tested.select(F.col("b").alias("id"))).distinct()
    near = handover(only_ids(src, "doc_id", used).dropDuplicates(["doc_id"]), "star-texts")
    links = _confirmed(tested, near, "star-links")
    comp = handover(components(links), "star-components")
    # buckets with members, besides the hub, in more than one component
    labelled = (buckets.join(comp.select("id", F.col("component_id").alias("c")), "id", "left")
                .select("band", "key", "id", F.coalesce("c", "id").alias("comp")))
    mixed = (labelled.groupBy("band", "key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                                 F.count("*").alias("size"))
             .where(F.col("lo") != F.col("hi")).select("band", "key", "size"))
    open_ = handover(labelled.join(mixed, ["band", "key"]), "open-buckets")
    if not open_.isEmpty():
        rare = only_ids(src, "doc_id", open_.select("id").distinct()).dropDuplicates(["doc_id"])
        sets = handover(rare.mapInArrow(_sets, "id long, set binary"), "open-sets")
        blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
        dealt = (open_.withColumn("nb", blocks).withColumn("own", F.pmod(F.xxhash64("id"), F.col("nb")).cast("int"))
                 .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
                 .select("band", "key", "id", "comp", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"),
                         F.when(F.col("own") <= F.col("o"), 0).otherwise(1).alias("side")))
        rows = (dealt.join(sets, "id").repartition(n, "band", "key", "i", "j")
                .sortWithinPartitions("band", "key", "i", "j", "id")
                .select("band", "key", "i", "j", "id", "comp", "side", "set"))
        more = handover(rows.mapInArrow(_across, "a long, b long"), "cross-links")
        if not more.isEmpty():
            links = links.unionByName(more)
            comp = handover(components(links), "all-components")
    named = (reps.join(comp, "id", "left")
             .select("d1", "d2", "n_shingles", F.coalesce("component_id", "id").alias("c")))
    out = signed.select("doc_id", "n_shingles", "d1", "d2").join(named, ["d1", "d2", "n_shingles"], "left")
    lone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    return (out.select("doc_id", "n_shingles", F.when(lone, F.col("doc_id")).otherwise(F.col("c")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
