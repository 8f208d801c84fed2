"""Substring deduplication with automata of repeated phrases.

A window is 20 consecutive words of one document. A window whose word sequence also starts
earlier (smaller id, or same document and earlier start) is removed, word by word.

1. One scan reduces each document to its anchors: in every window the leftmost smallest hash of its
   8-word phrases. Equal windows have equal anchors, and about one word in seven starts one. Equal
   documents collapse to the smallest id; the others' windows all start earlier there.
2. Anchors that occur once anywhere are dropped by a count; the rest go back to their documents.
3. Each document's stretches around recurring anchors are cut out. A task first runs its own
   stretches through step 4, so a passage that very many documents hold leaves it once; then the
   stretches are dealt by anchor (by window for anchors above ``HOT`` occurrences).
4. In each shard, batch by batch, recurring passages are confirmed and their windows compiled to an
   Aho-Corasick automaton over runs of five words that carries each window's first place; all stretches
   are streamed through it, which finds every occurrence by its words, not by a hash.
5. The places found meet the documents, which drop the covered words.

Defined results: null and empty texts have no words; documents under 20 words keep all; rows that
repeat a ``doc_id`` are one document with one result each; rows with a null id
keep all words and count for no other row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripsight.llm.common import (as_long, batch, handover, mix64, ngram_hashes, only_ids, parts, rows_of,
                                  word_hashes)

#: Words of a window and of an anchor phrase.
WINDOW, PHRASE = 20, 8
#: Words of a symbol of the automata; a window is ``WINDOW / SYMBOL`` symbols.
SYMBOL = 5
SPAN = WINDOW - PHRASE + 1
#: Occurrences above which an anchor's windows are dealt one by one.
HOT = 20_000
#: Bytes of stretches in one automaton's batch, and of an Arrow batch.
SHARD_BYTES, OUT_BYTES = 6 << 20, 8 << 20


def anchors(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrase hashes, and for each window the place of its anchor (ascending)."""
    g = ngram_hashes(h, PHRASE)
    if len(h) < WINDOW:
        return g, np.empty(0, dtype=np.int64)
    n = len(g) - SPAN + 1
    least, at = g, np.arange(len(g))
    for step in (1, 2, 4):  # leftmost smallest of 2, 4, 8 phrases, then of SPAN
        later = least[step:] < least[:-step]
        at, least = np.where(later, at[step:], at[:-step]), np.where(later, least[step:], least[:-step])
    later = least[SPAN - 8:SPAN - 8 + n] < least[:n]
    return g, np.where(later, at[SPAN - 8:SPAN - 8 + n], at[:n])


_DOCS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("sha", pa.binary()), ("anchors", pa.binary())])


def _digest(batches):
    """Words, digest of the word sequence, and (hash, place) of each anchor."""
    for ids, texts in rows_of(batches, "doc_id", "text"):
        rows, size = [], 0
        for i, t in zip(ids, texts):
            words = t.encode("utf-8").split()
            sha = hashlib.sha256(b" ".join(words)).digest()
            raw = b""
            if len(words) >= WINDOW:
                g, at = anchors(word_hashes(words))
                at = np.unique(at)
                raw = np.stack([as_long(g[at]), at], axis=1).astype("<i8").tobytes()
            rows.append((i, len(words), sha, raw))
            size += len(raw) + 60
            if size > OUT_BYTES:
                yield batch(_DOCS, **dict(zip(_DOCS.names, map(list, zip(*rows)))))
                rows, size = [], 0
        if rows:
            yield batch(_DOCS, **dict(zip(_DOCS.names, map(list, zip(*rows)))))


_ANCHORS = pa.schema([("h", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int32())])


def _spread(batches):
    for ids, raws in rows_of(batches, "doc_id", "anchors"):
        for lo in range(0, len(ids), 500):
            sub = raws[lo:lo + 500]
            x = np.frombuffer(b"".join(sub), dtype="<i8").reshape(-1, 2)
            if len(x):
                yield batch(_ANCHORS, h=x[:, 0].copy(), at=x[:, 1].astype(np.int32),
                            doc_id=np.repeat(np.array(ids[lo:lo + 500], dtype=np.int64), [len(r) // 16 for r in sub]))


def _pairs(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Numbers of the distinct pairs of two numberings (exact: a pair is one whole number)."""
    return np.unique(x * (int(y.max(initial=0)) + 1) + y, return_inverse=True)[1]


def symbols(seq: np.ndarray) -> np.ndarray:
    """For each place the number of the distinct run of ``SYMBOL`` words that begins there."""
    two = _pairs(seq[:-1], seq[1:])
    return _pairs(_pairs(two[:-2], two[2:])[:-1], seq[4:])


def repeated(stretches: list[tuple[int, int, list[bytes]]]) -> list[np.ndarray]:
    """For each stretch (id, start, words), in order of id and start: the offsets of its windows
    whose words also stand earlier in the list.

    The automaton reads runs of five words as one symbol, numbered exactly by their words, so a window
    is four symbols; a stretch is streamed once from each of its first five places. A number is read as
    two digits (of different kinds), since a node's children are searched one by one.
    """
    out = [np.empty(0, dtype=np.int64)] * len(stretches)
    sizes = np.array([len(words) for _, _, words in stretches], dtype=np.int64)
    if not len(sizes) or sizes.sum() < WINDOW:
        return out
    words = list(chain.from_iterable(w for _, _, w in stretches))
    ids = {w: i for i, w in enumerate(dict.fromkeys(words), 1)}
    seq = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    begin = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    windows = ngram_hashes(mix64(seq.view(np.uint64)), WINDOW)
    valid = np.flatnonzero(owner[:len(windows)] == owner[WINDOW - 1:WINDOW - 1 + len(windows)])
    if len(valid) < 2:
        return out
    # candidates for recurring passages; the automaton confirms them word by word
    _, first, inverse, count = np.unique(windows[valid], return_index=True, return_inverse=True, return_counts=True)
    again = np.flatnonzero(count > 1)
    if not len(again):
        return out
    coded = symbols(seq)
    base = int(np.sqrt(len(coded))) + 1
    digits = np.stack([coded // base, coded % base + base + 1], axis=1)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    places = valid[first[again]]
    keys = np.concatenate([digits[places + k] for k in range(0, WINDOW, SYMBOL)], axis=1)
    for p, key in zip((places + 1).tolist(), map(tuple, keys.tolist())):
        automaton.add_word(key, p)
    automaton.make_automaton()
    for s in np.unique(owner[valid[count[inverse] > 1]]).tolist():
        b, n = int(begin[s]), int(sizes[s])
        hits = []
        for o in range(SYMBOL):
            for end, p in automaton.iter(tuple(digits[b + o:b + n - SYMBOL + 1:SYMBOL].ravel().tolist())):
                at = o + SYMBOL * (end // 2 + 1) - WINDOW
                if p - 1 != b + at:
                    hits.append(at)
        if hits:
            out[s] = np.sort(np.array(hits, dtype=np.int64))
    return out


_CUT = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int32()), ("words", pa.binary()),
                  ("removed", pa.binary())])
_CUT_DDL = "key long, doc_id long, start int, words binary, removed binary"


def _starts(x: np.ndarray) -> bytes:
    return x.astype("<i4").tobytes()


def _cut(batches):
    """Stretches around recurring anchors, less what repeats within the task's own batch.

    The task's batch is judged on whole runs of windows with recurring anchors; what is left is cut
    by anchor, since anchors decide the shard.
    """
    def flush(held: list[tuple]):
        held.sort(key=lambda x: x[:2])
        rows, size = [], 0
        for (doc, start, words, at, key, hot), bad in zip(held, repeated([x[:3] for x in held])):
            good = np.ones(len(at), dtype=bool)
            if len(bad):
                rows.append((None, doc, None, None, _starts(start + bad)))
                good[bad] = False
            w = np.flatnonzero(good)
            if not len(w):
                continue
            if hot[w].any():
                single = as_long(ngram_hashes(word_hashes(words), WINDOW))
                new = [(int(single[o]), doc, start + o, b" ".join(words[o:o + WINDOW]), None)
                       for o in w[hot[w]].tolist()]
                w = w[~hot[w]]
            else:
                new = []
            if len(w):
                first = np.flatnonzero(np.r_[True, (np.diff(w) > 1) | (np.diff(at[w]) != 0)])
                last = np.r_[first[1:], len(w)] - 1
                new += [(int(key[x]), doc, start + x, b" ".join(words[x:y + WINDOW]), None)
                        for x, y in zip(w[first].tolist(), w[last].tolist())]
            rows += new
            size += sum(len(r[3]) + 40 for r in new)
            if size > OUT_BYTES:
                yield batch(_CUT, **dict(zip(_CUT.names, map(list, zip(*rows)))))
                rows, size = [], 0
        if rows:
            yield batch(_CUT, **dict(zip(_CUT.names, map(list, zip(*rows)))))

    held, size = [], 0
    for ids, texts, places in rows_of(batches, "doc_id", "text", "places"):
        for doc, t, at in zip(ids, texts, places):
            words = t.encode("utf-8").split()
            g, a = anchors(word_hashes(words))
            mark = np.zeros(len(words), dtype=np.int8)
            at = np.array(at, dtype=np.int64)
            mark[at >> 1] = 1 + (at & 1)
            w = np.flatnonzero(mark[a] > 0)
            if not len(w):
                continue
            for run in np.split(w, np.flatnonzero(np.diff(w) > 1) + 1):
                x, y = int(run[0]), int(run[-1])
                own = a[x:y + 1]
                held.append((doc, x, words[x:y + WINDOW], own, as_long(g[own]), mark[own] == 2))
                size += 8 * (y + WINDOW - x) + 100
            if size > SHARD_BYTES:
                yield from flush(held)
                held, size = [], 0
    if held:
        yield from flush(held)


_REMOVED = pa.schema([("doc_id", pa.int64()), ("removed", pa.binary())])


def _shard(batches):
    """Automata over batches of whole keys; rows come sorted by key, document and start."""
    def flush(held, new: int) -> Iterator[pa.RecordBatch]:
        got = [(doc, start + bad) for (doc, start, _), bad in list(zip(held, repeated(held)))[new:] if len(bad)]
        if got:
            yield batch(_REMOVED, doc_id=[d for d, _ in got], removed=[_starts(x) for _, x in got])

    held, size, now, carried = [], 0, None, 0
    for keys, docs, starts, texts in rows_of(batches, "key", "doc_id", "start", "words"):
        for k, d, s, t in zip(keys, docs, starts, texts):
            if size > SHARD_BYTES:
                yield from flush(held, carried)
                if k != now:
                    held, size, carried = [], 0, 0
                else:  # a key larger than a batch: its distinct stretches go on to the next one
                    seen: dict[bytes, tuple] = {}
                    for row, key in zip(held, held_keys):
                        if key == now:
                            seen.setdefault(b" ".join(row[2]), row)
                    held = list(seen.values())
                    size, carried = 0, len(held)
                held_keys = [now] * len(held)
            if not held:
                held_keys = []
            now = k
            held.append((d, s, t.split()))
            held_keys.append(k)
            size += len(t) + 60
    if held:
        yield from flush(held, carried)


_KEPT = pa.schema([("doc_id", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])


def _drop(batches):
    for ids, texts, lists in rows_of(batches, "doc_id", "text", "removed"):
        rows, size = [], 0
        for doc, t, parts_ in zip(ids, texts, lists):
            words = t.encode("utf-8").split()
            at = np.unique(np.frombuffer(b"".join(parts_), dtype="<i4"))
            edge = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + WINDOW, -1)
            gone = np.cumsum(edge)[:-1] > 0
            kept = b" ".join([w for w, x in zip(words, gone.tolist()) if not x])
            rows.append((doc, int(gone.sum()), kept.decode("utf-8")))
            size += len(kept) + 40
            if size > OUT_BYTES:
                yield batch(_KEPT, **dict(zip(_KEPT.names, map(list, zip(*rows)))))
                rows, size = [], 0
        if rows:
            yield batch(_KEPT, **dict(zip(_KEPT.names, map(list, zip(*rows)))))


def substring_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text, kept_sha.

    ``kept_text`` is null where nothing is removed (the words are the document's own) and for
    copies of an earlier document; ``kept_sha`` digests the kept words in every case.
    """
    n = parts(docs.sparkSession)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    seen = handover(src.mapInArrow(_digest, "doc_id long, n_words long, sha binary, anchors binary"), "anchors")
    own = seen.groupBy("sha", "n_words").agg(F.min("doc_id").alias("owner"))
    owners = handover(own.where((F.col("n_words") >= WINDOW) & F.col("owner").isNotNull()).select("owner"), "owners")
    firsts = (seen.join(owners.withColumnRenamed("owner", "doc_id"), "doc_id", "left_semi")
              .select("doc_id", "anchors").dropDuplicates(["doc_id"]))
    places = firsts.mapInArrow(_spread, "h long, doc_id long, at int")
    # counts are combined in the scan tasks; written, so that the join can split a very common anchor's rows
    again = handover(places.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "anchor-counts")
    marked = (places.join(again, "h")
              .select("doc_id", (F.col("at") * 2 + (F.col("n") > HOT).cast("int")).alias("place"))
              .groupBy("doc_id").agg(F.collect_list("place").alias("places")))
    marked = handover(marked, "recurring-anchors")
    texts = (only_ids(src, "doc_id", marked.select(F.col("doc_id").alias("id"))).dropDuplicates(["doc_id"])
             .join(marked, "doc_id"))
    cut = handover(texts.mapInArrow(_cut, _CUT_DDL), "stretches")
    dealt = (cut.where(F.col("key").isNotNull()).select("key", "doc_id", "start", "words")
             .repartition(n, "key").sortWithinPartitions("key", "doc_id", "start"))
    removed = handover(dealt.mapInArrow(_shard, "doc_id long, removed binary")
                       .unionByName(cut.where(F.col("removed").isNotNull()).select("doc_id", "removed"))
                       .groupBy("doc_id").agg(F.collect_list("removed").alias("removed")), "removed-windows")
    changed = (only_ids(src, "doc_id", removed.select(F.col("doc_id").alias("id"))).dropDuplicates(["doc_id"])
               .join(removed, "doc_id")
               .mapInArrow(_drop, "doc_id long, n_removed long, kept_text string"))
    all_ = seen.select("doc_id", "n_words", "sha").join(own, ["sha", "n_words"])
    copy = (F.col("n_words") >= WINDOW) & (F.col("doc_id") != F.col("owner"))
    out = all_.join(changed, "doc_id", "left")
    whole = F.lower(F.hex("sha"))
    return out.select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
        F.when(copy, F.sha2(F.lit(""), 256)).when(F.col("kept_text").isNull(), whole)
        .otherwise(F.sha2("kept_text", 256)).alias("kept_sha"))
