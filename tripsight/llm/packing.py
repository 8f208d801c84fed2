"""Mixture-controlled packing of token sequences by deficit round-robin.

Every source is a queue of tokens. In each round a queue earns credit in proportion to its
target weight and serves as many whole granules (``GRANULE`` tokens) as its credit allows; what
is left of the credit, the deficit, is carried to the next round. The rounds form one stream,
cut into windows of ``window`` tokens, so every window holds the target proportions up to one
granule per queue, and every window but the last is full.

The schedule has a closed form: queue s has served floor(r * quantum_s + carry_s) granules after
r rounds of a phase (a phase ends when a queue runs dry and the rest share its credit). A task
therefore places its own tokens knowing only each queue's total and where its block starts in
each queue; no task sees a queue, and deficits carry across windows and partitions alike.

Steps: one scan tokenises and writes ids with running per-queue offsets of its block; block
totals (one row per block and queue) give the blocks' bases by a running sum; the ids then meet
their base and are cut into pieces.

The number of queues is bounded whatever the number of sources: a source has a queue of its own
if it holds 1/``OWN_SHARE`` of all tokens, and the others share ``SHARED_QUEUES`` queues by hash.

Defined results: null and empty texts are documents of the end token alone; null sources are a
source of their own; repeated ids are packed as separate documents; an empty table gives no
pieces; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripsight.llm.common import batch, freeing, handover, rows_of

#: Tokens of one granule, the unit that a queue serves. Divides the window.
GRANULE = 64
WINDOW = 2048
#: A source with this part of all tokens has a queue of its own (so at most so many queues).
OWN_SHARE = 256
#: Queues that all smaller sources share.
SHARED_QUEUES = 64
#: Credit is counted in these parts of a granule.
CREDIT = 1 << 16
#: Entries of a worker's word cache before it starts again, and the longest word it keeps.
CACHE, CACHED_WORD = 700_000, 40
#: Entries that a worker may keep from one task to the next.
KEPT_WORDS = 150_000
#: Texts encoded at a time.
CHUNK = 512
#: Bytes of ids beyond which an Arrow batch leaves the task.
OUT_BYTES = 8 << 20
#: Separators str.split() takes that the vocabulary's pattern does not call space.
_ODD_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")
#: Marks that close a word and are pre-tokens of their own.
CLOSING = ",.;:!?"
#: The special strings of the vocabulary.
SPECIALS = ("<|startoftext|>", "<|endoftext|>")

_tokenizers: dict[str, object] = {}
_letters: dict[str, dict[int, str]] = {}
_words: dict[str, dict[str, bytes]] = {}


def load_tokenizer(path: str):
    if path not in _tokenizers:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tk = _tokenizers[path] = Tokenizer.from_file(path)
        # how the vocabulary writes the bytes of each Latin-1 letter
        _letters[path] = {c: tk.pre_tokenizer.pre_tokenize_str(chr(c))[0][0] for c in range(128, 256) if chr(c).isalpha()}
    return _tokenizers[path]


def encode_texts(texts: list[str], path: str) -> list[np.ndarray]:
    """Ids of whole texts, as the library's ``encode(text, add_special_tokens=False)`` gives them.

    The vocabulary lower-cases, drops white space and never joins pieces across it, so a text's
    ids are those of its words in turn; words already met come from a bounded cache. Texts with
    a special string or a separator on which Python and the vocabulary differ go to the library
    whole.
    """
    tk, cache = load_tokenizer(path), _words.setdefault(path, {})
    if len(cache) > CACHE:
        cache.clear()
    split: list[list[str] | None] = []
    missing: set[str] = set()
    for t in texts:
        if any(s in t for s in SPECIALS) or any(c in t for c in _ODD_SPACE):
            split.append(None)
            continue
        try:  # among these characters lower-casing first changes nothing, and words meet more often
            t.encode("latin-1")
            t = t.lower()
        except UnicodeEncodeError:
            pass
        ws = t.split()
        split.append(ws)
        missing.update(set(ws).difference(cache))
    width = "<u2" if tk.get_vocab_size() <= 1 << 16 else "<u4"

    # a word of letters and its closing mark are always separate pre-tokens
    marked = [w for w in missing if w[-1] in CLOSING and w[:-1].isalpha() and w == w.lower()]
    plain = list(missing.difference(marked).union([w[:-1] for w in marked], CLOSING).difference(cache))
    # lower-case words of Latin-1 letters are one pre-token; the model takes them without the rest
    letters, pieces, code = _letters[path], tk.model.tokenize, "H" if width == "<u2" else "I"  # little-endian hosts
    rest = []
    for w in plain:
        if w.isalpha() and max(w) <= "\xff" and w == w.lower():
            cache[w] = array(code, [x.id for x in pieces(w if w.isascii() else w.translate(letters))]).tobytes()
        else:
            rest.append(w)
    plain = rest
    for at in range(0, len(plain), 20_000):
        some = plain[at:at + 20_000]
        for w, e in zip(some, tk.encode_batch_fast(some, add_special_tokens=False)):
            cache[w] = np.array(e.ids, dtype=width).tobytes()
    for w in marked:
        cache[w] = cache[w[:-1]] + cache[w[-1]]
    out = []
    for t, ws in zip(texts, split):
        if ws is None:
            out.append(np.array(tk.encode(t, add_special_tokens=False).ids, dtype=width))
        else:
            out.append(np.frombuffer(b"".join(map(cache.__getitem__, ws)), dtype=width))
    for w in missing:
        if len(w) > CACHED_WORD:
            cache.pop(w, None)
    return out


_IDS = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("block", pa.int64()), ("at", pa.int64()),
                  ("n", pa.int64()), ("ids", pa.binary())])
_IDS_DDL = "doc_id long, source string, block long, at long, n long, ids binary"


def _tokenised(path: str, end_id: int):
    @freeing
    def run(batches):
        block = TaskContext.get().partitionId()
        at: dict = {}
        for doc_ids, sources, texts in rows_of(batches, "doc_id", "source", "text"):
            for lo in range(0, len(texts), CHUNK):
                rows, size = [], 0
                got = encode_texts(texts[lo:lo + CHUNK], path)
                for d, s, ids in zip(doc_ids[lo:lo + CHUNK], sources[lo:lo + CHUNK], got):
                    ids = np.append(ids.astype(np.uint32), np.uint32(end_id))
                    raw = ids.astype("<u2" if ids.max() < 65536 else "<u4")
                    start = at.get(s, 0)
                    at[s] = start + len(ids)
                    # the ids' width shows in the length: 2 or 4 bytes each
                    rows.append((d, s, block, start, len(ids), raw.tobytes()))
                    size += raw.nbytes
                    if size > OUT_BYTES:
                        yield batch(_IDS, **dict(zip(_IDS.names, map(list, zip(*rows)))))
                        rows, size = [], 0
                if rows:
                    yield batch(_IDS, **dict(zip(_IDS.names, map(list, zip(*rows)))))
        if len(_words.get(path, ())) > KEPT_WORDS:  # workers outlive the task
            _words.pop(path)

    return run


@dataclass
class Phase:
    """Rounds in which the same queues are active. ``quantum`` and ``carry`` in 1/CREDIT granules."""

    first_round: int
    position: int  # granules served by all queues before
    served: np.ndarray  # granules of each queue served before
    quantum: np.ndarray
    carry: np.ndarray
    rounds: int


def schedule(granules: np.ndarray, weights: np.ndarray, per_round: int) -> list[Phase]:
    """Phases of a deficit round-robin that serves all ``granules`` of every queue.

    ``per_round`` granules of credit are shared by the active queues in proportion to their
    weights. In a last round a queue serves what it has and leaves; its unused credit lapses.
    """
    left = [int(x) for x in granules]
    carry = [0] * len(left)
    served = [0] * len(left)
    out, rounds, position = [], 0, 0
    while any(left):
        active = [s for s, n in enumerate(left) if n]
        total = sum(int(weights[s]) for s in active) or len(active)
        quantum, cum = [0] * len(left), 0
        for s in active:  # shares that add up exactly
            w = int(weights[s]) if total != len(active) or weights[s] else 1
            quantum[s] = (cum + w) * per_round * CREDIT // total - cum * per_round * CREDIT // total
            cum += w
        quantum = [max(q, 1) if left[s] else 0 for s, q in enumerate(quantum)]
        # whole rounds that no queue runs dry in
        n = min(((left[s] + 1) * CREDIT - 1 - carry[s]) // quantum[s] for s in active)
        last = n == 0
        n = max(n, 1)
        out.append(Phase(rounds, position, np.array(served, dtype=np.int64), np.array(quantum, dtype=np.int64),
                         np.array(carry, dtype=np.int64), n))
        for s in active:
            credit = n * quantum[s] + carry[s]
            take = min(credit // CREDIT, left[s])
            carry[s] = credit - take * CREDIT if take < left[s] or not last else 0
            served[s] += take
            left[s] -= take
            position += take
            if not left[s]:
                carry[s] = 0
        rounds += n
    return out


class Placer:
    """Places granules of the queues in the stream, from the schedule alone."""

    def __init__(self, granules: np.ndarray, phases: list[Phase]):
        self.total = np.asarray(granules, dtype=np.int64)
        self.phases = phases
        self.starts = np.stack([p.served for p in phases]) if phases else np.zeros((0, len(granules)), np.int64)

    def place(self, queue: int, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Stream position of granules ``j`` (ascending) of a queue."""
        pos = np.empty(len(j), dtype=np.int64)
        phase = np.searchsorted(self.starts[:, queue], j, side="right") - 1
        for p in np.unique(phase):
            at = phase == p
            ph = self.phases[p]
            i = j[at] - ph.served[queue]
            q, c = int(ph.quantum[queue]), int(ph.carry[queue])
            # served in the first round r (from 1) with r*q + c >= (i+1)*CREDIT
            r = np.maximum(-((c - (i + 1) * CREDIT) // q), 1)
            rounds, back = np.unique(r, return_inverse=True)
            before = self._served(ph, rounds - 1)
            done = self._served(ph, rounds) if queue else before
            base = ph.position + before.sum(axis=1) + (done[:, :queue] - before[:, :queue]).sum(axis=1)
            pos[at] = base[back] + i - before[back, queue]
        return pos

    def _served(self, ph: Phase, r: np.ndarray) -> np.ndarray:
        """Granules of each queue served in the first ``r`` rounds of a phase."""
        out = (r[:, None] * ph.quantum[None, :] + ph.carry[None, :]) // CREDIT
        return np.minimum(out, (self.total - ph.served)[None, :])


_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
                     ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])
PIECES_DDL = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def cut(start: np.ndarray, n: np.ndarray, queue: np.ndarray, placer: Placer, tails: np.ndarray, granule: int,
        window: int) -> tuple[np.ndarray, ...]:
    """Pieces of documents that hold tokens [start, start + n) of their queues.

    Returns document, start in document, length, sequence and offset, ordered by document and start.
    """
    docs, los, his, places = [], [], [], []
    end = start + n
    for q in np.unique(queue):
        whole = int(placer.total[q]) * granule  # tokens of the queue in whole granules
        d = np.flatnonzero((queue == q) & (start < whole))
        if len(d):
            first = start[d] // granule
            count = (np.minimum(end[d], whole) - 1) // granule - first + 1
            at = np.repeat(d, count)
            j = np.arange(len(at)) - np.repeat(np.cumsum(count) - count - first, count)
            lo = np.maximum(j * granule, start[at])
            docs.append(at)
            los.append(lo)
            his.append(np.minimum((j + 1) * granule, np.minimum(end[at], whole)))
            places.append(placer.place(int(q), j) * granule + lo - j * granule)
        d = np.flatnonzero((queue == q) & (end > whole))
        if len(d):  # the queue's last, partial granule lies behind all whole ones
            lo = np.maximum(start[d], whole)
            docs.append(d)
            los.append(lo)
            his.append(end[d])
            places.append(tails[q] + lo - whole)
    doc, lo, hi, pos = (np.concatenate(x) for x in (docs, los, his, places))
    # a granule lies in one window, but a tail (shorter than one) may cross an edge
    room = (pos // window + 1) * window - pos
    over = np.flatnonzero(hi - lo > room)
    if len(over):
        cross = lo[over] + room[over]
        doc, lo, hi, pos = (np.concatenate(x) for x in (
            (doc, doc[over]), (lo, cross), (hi, hi[over]), (pos, pos[over] + room[over])))
        hi[over] = cross
    o = np.lexsort((lo, doc))
    doc, lo, hi, pos = doc[o], lo[o], hi[o], pos[o]
    seq = pos // window
    # neighbours that follow each other in the same sequence are one piece
    new = np.r_[True, (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1] + hi[:-1] - lo[:-1]) | (seq[1:] != seq[:-1])]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(lo)] - 1
    doc = doc[first]
    return doc, lo[first] - start[doc], hi[last] - lo[first], seq[first], pos[first] % window


def _pieces(totals: np.ndarray, granule: int, window: int, weights: np.ndarray):
    @freeing
    def run(batches):
        phases = schedule(totals // granule, weights, window // granule)
        placer = Placer(totals // granule, phases)
        rest = totals % granule
        tails = int((totals // granule).sum()) * granule + np.r_[0, np.cumsum(rest)[:-1]]
        for b in batches:
            names = ("queue", "begin", "n")
            queue, begin, n = (b.column(b.schema.get_field_index(c)).to_numpy() for c in names)
            doc_ids, raws = (b.column(b.schema.get_field_index(c)) for c in ("doc_id", "ids"))
            edges = np.r_[0, np.cumsum(4 * n + 60)]
            lo = 0
            while lo < b.num_rows:  # as many documents as fit an Arrow batch, one at least
                hi = max(lo + 1, int(np.searchsorted(edges, edges[lo] + OUT_BYTES, side="right")) - 1)
                doc, at, length, seq, off = cut(begin[lo:hi], n[lo:hi], queue[lo:hi], placer, tails, granule, window)
                # a document's pieces cover its ids in order, so all ids of the batch are one buffer
                ids = b"".join(np.frombuffer(raw, dtype="<u2" if len(raw) == 2 * k else "<u4").astype("<u4").tobytes()
                               for raw, k in zip(raws.slice(lo, hi - lo).to_pylist(), n[lo:hi].tolist()))
                bounds = np.r_[0, np.cumsum(4 * length)].astype(np.int32)
                yield batch(_PIECES, doc_id=doc_ids.slice(lo, hi - lo).take(pa.array(doc)), start=at, length=length,
                            doc_tokens=n[lo:hi][doc], sequence_id=seq, offset=off,
                            ids=pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(bounds),
                                                                                pa.py_buffer(ids)]))
                lo = hi

    return run


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, window: int = WINDOW, granule: int = GRANULE,
         weights: dict[str | None, float] | None = None) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers. ``weights`` gives
    target proportions by source (default: the corpus's own, so that all queues run dry
    together); they hold until a queue is empty, then the rest share its part.
    """
    if window % granule:
        raise ValueError("the granule must divide the window")
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                      F.coalesce("text", F.lit("")).alias("text"))
    ids = handover(src.mapInArrow(_tokenised(tokenizer_path, end_id), _IDS_DDL), "token-ids")
    # totals by block and source, then by source
    by_block = handover(ids.groupBy("block", "source").agg(F.sum("n").alias("n")), "token-totals")
    total = by_block.agg(F.sum("n")).first()[0]
    if not total:
        return ids.sparkSession.createDataFrame([], PIECES_DDL)
    asked = sorted(weights or {}, key=lambda s: (s is not None, s or ""))
    per_source = by_block.groupBy("source").agg(F.sum("n").alias("n"))
    # at most OWN_SHARE sources hold so large a part (and those asked for by name)
    own = [r["source"] for r in per_source.where((F.col("n") * OWN_SHARE >= total)).orderBy("source").collect()]
    own = list(dict.fromkeys([*own, *asked]))
    queue = F.lit(len(own)) + F.pmod(F.xxhash64("source"), F.lit(SHARED_QUEUES))
    for i, s in enumerate(own):
        queue = F.when(F.col("source").eqNullSafe(F.lit(s)), F.lit(i)).otherwise(queue)
    queue = queue.cast("long").alias("queue")
    by_queue = by_block.select("block", "source", "n", queue)
    sums = {r["queue"]: r["n"] for r in by_queue.groupBy("queue").agg(F.sum("n").alias("n")).collect()}
    totals = np.array([sums.get(i, 0) for i in range(len(own) + SHARED_QUEUES)], dtype=np.int64)
    if weights is None:
        share = totals // granule
    else:
        rest = max(0.0, 1.0 - sum(weights.values()))
        other = sum(int(n) for i, n in enumerate(totals) if not (i < len(own) and own[i] in weights)) or 1
        share = np.array([round(1e9 * (weights[own[i]] if i < len(own) and own[i] in weights
                                       else rest * int(totals[i]) / other)) for i in range(len(totals))])
    # where each block's part of a queue begins: a running sum over (block, source) totals
    order = Window.partitionBy("queue").orderBy("block", F.col("source").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1)
    base = by_queue.select("block", "source", "queue", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    placed = (ids.withColumnRenamed("source", "s").withColumnRenamed("block", "b")
              .join(base, (F.col("b") == F.col("block")) & F.col("s").eqNullSafe(F.col("source")))
              .select("doc_id", "queue", (F.col("base") + F.col("at")).alias("begin"), "n", "ids"))
    return placed.mapInArrow(_pieces(totals, granule, window, share), PIECES_DDL)


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The contract's columns: the piece and the unsigned crc32 of its ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def crc32_of(ids: np.ndarray) -> int:
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())
