"""Hard negatives under score windows, with spanning-tree bounds over the anchors.

A row's score for an anchor is the integer inner product of their quantised vectors. For an anchor q
with parent p in a tree, Cauchy-Schwarz gives |<q, c> - <p, c>| <= |q - p| |c|: what is known of a
candidate's score at the parent bounds its score at the child, and only candidates whose bounds
overlap a window that the child still asks for are scored again. Bounds of a candidate that isn't
scored again pass on to the next level, widened by the next edge.

1. Rows that take part are quantised and written as packed vectors of a group (groups are bounded in
   rows; memory of a task is a group and a block of anchors).
2. Anchors are ordered by the signs of their first components, cut into blocks, and each block gets its
   minimum spanning tree, once.
3. First pass: every group meets every block, and keeps the first positives of each anchor. The window
   of a search is what still beats the group's own last one.
4. Second pass: every group meets every block again, with the windows that the positives give.
   Each (anchor, positive) keeps the group's first rows inside its window.
5. After each pass the groups' short lists meet by anchor; ranks follow.

The anchors are a query set against all rows, in blocks: candidates are shuffled once a pass, the
anchors once per group, and the number of groups is bounded by what the rows need (``GROUP_ROWS``) or by
``SPREAD``, so that the anchors' copies stay below the rows themselves. No row is left out: bounds
only skip scores that can't matter.

Exactness: partial sums of a product are bounded by the product of the vectors' lengths; blocks with
that below 2^24 are multiplied in 32-bit floats, below 2^53 in 64-bit floats, others in integers.

Defined results: rows with a null id, label or vector, or with any null or non-finite component take no
part. Components beyond +-2^26 after scaling count as that bound. Shorter vectors are filled up
with zeros; an empty vector scores 0. An anchor's own id is never its positive, so rows that repeat an id
never serve each other; each repeated anchor row gives its own results, and repeated other rows are rows
of their own. An anchor without positives or with empty windows gives no rows; so does an empty table.
Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripsight.llm.common import batch, handover, parts, rows_of

#: Rows of a candidate group at most, and rows that a group should hold before there is another.
GROUP_ROWS, LEAST_ROWS = 262_144, 1_024
#: Groups, unless ``GROUP_ROWS`` asks for more (an anchor is one row in 100 of the contract's table).
SPREAD = 96
#: Anchors of a block, and candidates scored at a time.
BLOCK, SLICE = 512, 4_096
#: Components after scaling are held within this.
LIMIT = 1 << 26
#: Share of a level's (anchor, candidate) scores from which a whole product is cheaper than a chosen few.
DENSE = 0.05

#: Score of an empty place, below every score (and its negative fits as well).
NOTHING = -(1 << 63) + 1
#: Leading components whose signs order the anchors.
SIGNS = 24

_ROWS = pa.schema([("id", pa.int64()), ("label", pa.int64()), ("signs", pa.int64()), ("vec", pa.binary())])
_ROWS_DDL = "id long, label long, signs long, vec binary"


def _quantised(scale: float):
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            ids, labels, vec = b.column("id"), b.column("label"), b.column("vec")
            off = vec.offsets.to_numpy()
            x = vec.values.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls come as NaN
            bad = ~np.isfinite(x)
            faults = np.concatenate([[0], np.cumsum(bad)])
            ok = faults[off[1:]] == faults[off[:-1]]
            for c in (ids, labels, vec):
                ok &= c.is_valid().to_numpy(zero_copy_only=False)
            q = np.clip(np.floor(np.where(bad, 0, x) * scale), -LIMIT, LIMIT).astype("<i4")
            small = np.abs(q).max(initial=0) < 1 << 15
            mark, code = (b"2", q.astype("<i2")) if small else (b"4", q)
            keep = np.flatnonzero(ok)
            lo, hi = off[:-1][keep], off[1:][keep]
            signs = np.zeros(len(keep), dtype=np.int64)
            for k in range(SIGNS):
                has = lo + k < hi
                signs[has] |= (q[(lo + k)[has]] >= 0).astype(np.int64) << (SIGNS - 1 - k)
            at = pa.array(keep)
            yield batch(_ROWS, id=ids.take(at), label=labels.take(at), signs=signs,
                        vec=[mark + code[i:j].tobytes() for i, j in zip(lo.tolist(), hi.tolist())])

    return run


def unpack(raw: list[bytes], dim: int = 0) -> np.ndarray:
    """Rows of packed vectors as integers, filled up with zeros to the longest (``dim`` at least)."""
    width = [2 if r[:1] == b"2" else 4 for r in raw]
    dims = [(len(r) - 1) // w for r, w in zip(raw, width)]
    most = max([dim, *dims])
    if raw and len(set(width)) == 1 and len(set(dims)) == 1 and dims[0] == most:
        code = "<i2" if width[0] == 2 else "<i4"
        return np.frombuffer(b"".join(r[1:] for r in raw), dtype=code).reshape(len(raw), most).astype(np.int64)
    out = np.zeros((len(raw), most), dtype=np.int64)
    for i, (r, w, d) in enumerate(zip(raw, width, dims)):
        out[i, :d] = np.frombuffer(r[1:], dtype="<i2" if w == 2 else "<i4")
    return out


def spanning_tree(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order, parent (-1 for the root) and edge length of the minimum spanning tree of the rows of ``v``."""
    x = v.astype(np.float64)
    n = len(x)
    sq = (x * x).sum(axis=1)
    best, parent = np.full(n, np.inf), np.full(n, -1)
    order, out = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool)
    at = 0
    for k in range(n):
        order[k], out[at] = at, True
        d = np.maximum(sq + sq[at] - 2 * (x @ x[at]), 0)
        nearer = ~out & (d < best)
        best[nearer], parent[nearer] = d[nearer], at
        at = int(np.argmin(np.where(out, np.inf, best)))
    # lengths anew from the differences, without the cancellation of the products
    edge = np.array([np.sqrt(((x[i] - x[p]) ** 2).sum()) if p >= 0 else 0.0 for i, p in enumerate(parent)])
    return order, parent, edge


class Tree:
    """Anchors of a block in the levels of their spanning tree."""

    def __init__(self, vec: np.ndarray, parent: np.ndarray, edge: np.ndarray):
        self.vec, self.parent, self.edge = vec, parent, edge
        self.length = float(np.sqrt((vec.astype(np.float64) ** 2).sum(axis=1)).max(initial=0))
        depth = np.full(len(parent), -1)
        depth[parent < 0] = 0
        while (depth < 0).any():
            known = depth[parent]
            depth = np.where((depth < 0) & (known >= 0), known + 1, depth)
        self.levels = [np.flatnonzero(depth == k) for k in range(depth.max() + 1)]


class Group:
    """Candidates of a group, with the number types in which their products are exact."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vec: np.ndarray):
        self.ids, self.labels, self.vec = ids, labels, vec
        self.norm = np.sqrt((vec.astype(np.float64) ** 2).sum(axis=1))
        self.length = float(self.norm.max(initial=0))
        self._as: dict = {}

    def kind(self, tree: Tree):
        most = (tree.length + 1) * (self.length + 1)
        return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64

    def typed(self, kind) -> np.ndarray:
        if kind not in self._as:
            self._as[kind] = self.vec.astype(kind)
        return self._as[kind]


def _padded(v: np.ndarray, dim: int) -> np.ndarray:
    return v if v.shape[1] == dim else np.pad(v, ((0, 0), (0, dim - v.shape[1])))


def scored(tree: Tree, group: Group, lo: int, hi: int, asked):
    """Level by level: (anchors, exact score or NaN-free mask) of candidates ``lo:hi``.

    ``asked(anchors, least, most)`` gives the mask of scores that matter, from bounds of the scores.
    Yields (anchors, scores, mask): scores are exact where the mask is set.
    """
    kind = group.kind(tree)
    dim = max(tree.vec.shape[1], group.vec.shape[1])
    q = _padded(tree.vec, dim).astype(kind)
    c = _padded(group.typed(kind)[lo:hi], dim)
    real = np.float32 if kind is np.float32 else np.float64
    # rounding of the bounds themselves: a few units in the last place of the largest score
    slack = real((tree.length + 1) * (group.length + 1) * np.finfo(real).eps * 8 + 1e-3)
    norm = group.norm[lo:hi].astype(real) * real(1 + 1e-6)
    least = np.empty((len(q), hi - lo), dtype=real)
    most = np.empty_like(least)
    for level in tree.levels:
        if tree.parent[level[0]] < 0:
            scores = q[level] @ c.T
            mask = np.ones(scores.shape, dtype=bool)
        else:
            p = tree.parent[level]
            wide = tree.edge[level].astype(real)[:, None] * norm[None, :] + slack
            below, above = least[p] - wide, most[p] + wide
            mask = asked(level, below, above)
            if np.count_nonzero(mask) > DENSE * mask.size:
                scores = q[level] @ c.T
                least[level] = most[level] = scores
                yield level, scores, mask
                continue
            i, j = np.nonzero(mask)
            scores = np.zeros(mask.shape, dtype=kind)
            scores[i, j] = (q[level][i] * c[j]).sum(axis=1)
            below[i, j] = above[i, j] = scores[i, j]
            least[level], most[level] = below, above
            yield level, scores, mask
            continue
        least[level] = most[level] = scores
        yield level, scores, mask


class Best:
    """The first ``k`` (score down, id up) of each slot, held while candidates pass."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.score = np.full((slots, k), NOTHING)
        self.id = np.full((slots, k), np.iinfo(np.int64).max)

    def beats(self, slots: np.ndarray, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Which candidates come before the last one held (arrays of equal length)."""
        s, i = self.score[slots, -1], self.id[slots, -1]
        return (score > s) | (score == s) & (ids < i)

    def take(self, slots: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slots):
            return
        touched = np.unique(slots)
        slots = np.concatenate([np.repeat(touched, self.k), slots])
        score = np.concatenate([self.score[touched].ravel(), score])
        ids = np.concatenate([self.id[touched].ravel(), ids])
        o = np.lexsort((ids, -score, slots))
        slots, score, ids = slots[o], score[o], ids[o]
        rank = np.arange(len(slots)) - np.searchsorted(slots, slots)
        first = rank < self.k
        self.score[slots[first], rank[first]] = score[first]
        self.id[slots[first], rank[first]] = ids[first]

    def rows(self):
        """(slot, score, id) of all that is held."""
        held = self.score != NOTHING
        slot, _ = np.nonzero(held)
        return slot, self.score[held], self.id[held]


def _real_floor(x: np.ndarray) -> np.ndarray:
    """Last held scores as bounds to compare with; nothing held asks for everything."""
    return np.where(x == NOTHING, -np.inf, x.astype(np.float64))


def positives_of(tree: Tree, ids: np.ndarray, labels: np.ndarray, group: Group, k: int) -> Best:
    """First ``k`` candidates of each anchor's label, the anchor's own id left out."""
    held = Best(len(ids), k)
    for lo in range(0, len(group.ids), SLICE):
        hi = min(lo + SLICE, len(group.ids))
        cid, clabel = group.ids[lo:hi], group.labels[lo:hi]

        def asked(level, least, most):
            return ((labels[level][:, None] == clabel[None, :]) & (ids[level][:, None] != cid[None, :])
                    & (most >= _real_floor(held.score[level, -1])[:, None]))

        for level, scores, mask in scored(tree, group, lo, hi, asked):
            # the root asks after it is scored
            i, j = np.nonzero(mask & asked(level, scores, scores))
            s, slot, c = scores[i, j].astype(np.int64), level[i], cid[j]
            new = held.beats(slot, s, c)
            held.take(slot[new], s[new], c[new])
    return held


def negatives_of(tree: Tree, labels: np.ndarray, low: np.ndarray, high: np.ndarray, group: Group, k: int) -> Best:
    """First ``k`` candidates of other labels inside each window ``low..high`` (anchors x windows).

    A window with ``low`` above ``high`` is empty.
    """
    n, w = low.shape
    held = Best(n * w, k)
    for lo in range(0, len(group.ids), SLICE):
        hi = min(lo + SLICE, len(group.ids))
        cid, clabel = group.ids[lo:hi], group.labels[lo:hi]

        def asked(level, least, most):
            out = np.zeros(least.shape, dtype=bool)
            for x in range(w):
                floor = np.maximum(low[level, x], _real_floor(held.score[level * w + x, -1]))
                some = low[level, x] <= high[level, x]
                out |= some[:, None] & (most >= floor[:, None]) & (least <= high[level, x][:, None])
            return out & (labels[level][:, None] != clabel[None, :])

        for level, scores, mask in scored(tree, group, lo, hi, asked):
            i, j = np.nonzero(mask & asked(level, scores, scores))
            s, anchor, c = scores[i, j].astype(np.int64), level[i], cid[j]
            for x in range(w):
                at = (s >= low[anchor, x]) & (s <= high[anchor, x])
                slot = anchor[at] * w + x
                new = held.beats(slot, s[at], c[at])
                held.take(slot[new], s[at][new], c[at][new])
    return held


_BLOCKS = pa.schema([("block", pa.int64()), ("keys", pa.binary()), ("ids", pa.binary()), ("labels", pa.binary()),
                     ("parent", pa.binary()), ("edge", pa.binary()), ("vecs", pa.list_(pa.binary()))])
_BLOCKS_DDL = ("block long, keys binary, ids binary, labels binary, parent binary, edge binary, vecs array<binary>")


def _anchor_blocks(batches):
    """Rows come ordered; neighbours share a block. The first key names the block."""
    def made(rows):
        keys, ids, labels, vecs = zip(*rows)
        _, parent, edge = spanning_tree(unpack(list(vecs)))
        return batch(_BLOCKS, block=[keys[0]], keys=[np.array(keys, "<i8").tobytes()],
                     ids=[np.array(ids, "<i8").tobytes()], labels=[np.array(labels, "<i8").tobytes()],
                     parent=[parent.astype("<i8").tobytes()], edge=[edge.astype("<f8").tobytes()], vecs=[list(vecs)])

    held: list = []
    for keys, ids, labels, vecs in rows_of(batches, "key", "id", "label", "vec"):
        held += zip(keys, ids, labels, vecs)
        while len(held) >= BLOCK:
            yield made(held[:BLOCK])
            held = held[BLOCK:]
    if held:
        yield made(held)


def _long(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype="<i8")


_FOUND = pa.schema([("key", pa.int64()), ("anchor_id", pa.int64()), ("slot", pa.int64()), ("score", pa.int64()),
                    ("id", pa.int64())])
_FOUND_DDL = "key long, anchor_id long, slot long, score long, id long"


def _meet(k: int, windows: bool):
    """Rows of one group: candidates first (held), then blocks of anchors, one at a time."""
    def run(batches):
        current, ids, labels, vecs, group = None, [], [], [], None
        names = ["group", "id", "label", "vec", "block", "keys", "ids", "labels", "parent", "edge", "vecs"]
        for columns in rows_of(batches, *names, *(("low", "high") if windows else ())):
            for g, i, label, vec, block, keys, aid, alabel, parent, edge, avecs, *asked in zip(*columns):
                if g != current:
                    current, ids, labels, vecs, group = g, [], [], [], None
                if block is None:
                    ids.append(i)
                    labels.append(label)
                    vecs.append(vec)
                    continue
                if group is None:
                    group = Group(np.array(ids, dtype=np.int64), np.array(labels, dtype=np.int64), unpack(vecs))
                    vecs = []
                keys, aid, alabel = _long(keys), _long(aid), _long(alabel)
                tree = Tree(unpack(avecs), _long(parent), np.frombuffer(edge, dtype="<f8"))
                if windows:
                    low, high = (_long(x).reshape(len(keys), -1) for x in asked)
                    slot, score, cid = negatives_of(tree, alabel, low, high, group, k).rows()
                    w = low.shape[1]
                    at, slot = slot // w, slot % w
                else:
                    at, score, cid = positives_of(tree, aid, alabel, group, k).rows()
                    slot = np.zeros(len(at), dtype=np.int64)
                if len(at):
                    yield batch(_FOUND, key=keys[at], anchor_id=aid[at], slot=slot, score=score, id=cid)

    return run


def _passed(rows: DataFrame, blocks: DataFrame, groups: int, n: int, k: int, windows: bool) -> DataFrame:
    """Every group meets every block; the groups' lists of each (key, slot) meet and keep the first ``k``."""
    here = [c for c in blocks.columns if c != "block"]
    of_rows = rows.select("group", "id", "label", "vec", F.lit(None).cast("long").alias("block"),
                          *[F.lit(None).cast(blocks.schema[c].dataType).alias(c) for c in here])
    of_blocks = (blocks.withColumn("group", F.explode(F.expr(f"sequence(0L, {groups - 1}L)")))
                 .select("group", *[F.lit(None).cast(t).alias(c) for c, t in
                                    (("id", "long"), ("label", "long"), ("vec", "binary"))], "block", *here))
    dealt = (of_rows.unionByName(of_blocks).repartition(n, "group")
             .sortWithinPartitions("group", F.col("block").isNotNull(), "block"))
    found = dealt.mapInArrow(_meet(k, windows), _FOUND_DDL)
    order = Window.partitionBy("key", "slot").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


_WINDOWED = pa.schema([*_BLOCKS, ("low", pa.binary()), ("high", pa.binary())])


def _windows(k: int, percent: int):
    """Blocks meet their anchors' positive scores and get their windows; rows come sorted, scores first."""
    def run(batches):
        current, got = None, {}
        for b in batches:
            for row in b.to_pylist():
                if row["block"] != current:
                    current, got = row["block"], {}
                if row["keys"] is None:
                    got.setdefault(row["key"], []).append((row["rank"], row["score"]))
                    continue
                keys = _long(row["keys"])
                low, high = np.ones((len(keys), k), dtype=np.int64), np.zeros((len(keys), k), dtype=np.int64)
                for i, key in enumerate(keys.tolist()):
                    for rank, s in got.get(key, ()):
                        # percent * s <= 100 * x <= 100 * s
                        low[i, rank - 1], high[i, rank - 1] = -(-percent * s // 100), s
                yield batch(_WINDOWED, low=[low.astype("<i8").tobytes()], high=[high.astype("<i8").tobytes()],
                            **{c: [row[c]] for c in _BLOCKS.names})

    return run


def mine(rows: DataFrame, is_anchor, scale: float = 256.0, positives: int = 5, negatives: int = 5,
         percent: int = 80) -> DataFrame:
    """anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score.

    ``rows`` has id, label and vec; ``is_anchor`` is a condition on these. A negative's score lies between
    ``percent`` % of the positive's score and that score.
    """
    spark = rows.sparkSession
    n = parts(spark)
    src = rows.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
                      F.col("vec").cast("array<double>").alias("vec"))
    packed = handover(src.mapInArrow(_quantised(scale), _ROWS_DDL)
                      .withColumn("deal", F.monotonically_increasing_id()), "negatives-rows")
    total = packed.count()
    if not total:
        return spark.createDataFrame([], "anchor_id long, positive_id long, positive_rank int, rank int, "
                                         "negative_id long, positive_score long, negative_score long")
    groups = max(-(-total // GROUP_ROWS), min(n, SPREAD, -(-total // LEAST_ROWS)))
    # rows of a scan task are dealt round the groups, so groups are even
    packed = packed.withColumn("group", F.pmod(F.col("deal"), F.lit(groups)))
    anchors = packed.where(is_anchor).select(F.col("deal").alias("key"), "id", "label", "signs", "vec")
    # one partition per so many blocks; neighbours by their leading components share a block
    many = max(1, min(n, -(-anchors.count() // (4 * BLOCK))))
    blocks = handover(anchors.repartitionByRange(many, "signs", "id", "key").sortWithinPartitions("signs", "id", "key")
                      .mapInArrow(_anchor_blocks, _BLOCKS_DDL), "negatives-anchors")
    first = handover(_passed(packed, blocks, groups, n, positives, False), "negatives-positives")
    # windows travel with the blocks
    member = blocks.select("block", "keys").mapInArrow(_members, "block long, key long")
    scores = member.join(first, "key").select("block", "key", "rank", "score")
    both = (scores.select("*", *[F.lit(None).cast(blocks.schema[c].dataType).alias(c) for c in _BLOCKS.names[1:]])
            .unionByName(blocks.select("block", *[F.lit(None).cast("long").alias(c) for c in ("key", "score")],
                                       F.lit(None).cast("int").alias("rank"), *_BLOCKS.names[1:])))
    windowed = handover(both.repartition(many, "block").sortWithinPartitions("block", F.col("keys").isNotNull())
                        .mapInArrow(_windows(positives, percent), f"{_BLOCKS_DDL}, low binary, high binary"),
                        "negatives-windows")
    second = _passed(packed, windowed, groups, n, negatives, True)
    of = first.select("key", F.col("rank").alias("positive_rank"), F.col("id").alias("positive_id"),
                      F.col("score").alias("positive_score"))
    return (second.select("key", "anchor_id", (F.col("slot") + 1).cast("int").alias("positive_rank"), "rank",
                          F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(of, ["key", "positive_rank"])
            .select("anchor_id", "positive_id", "positive_rank", "rank", "negative_id", "positive_score",
                    "negative_score"))


_MEMBERS = pa.schema([("block", pa.int64()), ("key", pa.int64())])


def _members(batches):
    for blocks, keys in rows_of(batches, "block", "keys"):
        for b, k in zip(blocks, keys):
            k = _long(k)
            yield batch(_MEMBERS, block=np.full(len(k), b), key=k)
