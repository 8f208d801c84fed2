"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes.

Both tokenizers cut the same bytes, so each gives a list of end offsets. The shorter list drives a
galloping search (exponential steps, then a binary search) into the longer: the offsets found in both
slice the text into groups, and the differences of the ranks give each token's overlap range.

1. Every text is cut at single spaces between other characters, where both vocabularies always end a
   token (checked against the vocabularies at hand by ``load``). Each distinct piece of a block of
   documents is encoded and aligned once; a text without such a space is one piece.
2. The scan writes blocks: the documents' figures, how often each document holds each piece, the pieces'
   links and, for each pair of ids linked in the block, how many of its documents hold it linked.
3. Pair counts are summed over the blocks; the highest count of each A id follows from them.
4. Each block asks for the counts of its own pairs. A pair is one row per block, however many documents
   hold it, so no pair is hot; the answers meet the block's piece counts, which gives the documents' sums.

Texts are never shuffled, and neither are tokens; no count table is broadcast or collected.

Defined results: null and empty texts, and texts whose joined token bytes differ from the space and
the text (by either vocabulary), have no tokens: zeros and an empty string. Repeated rows count as
documents of their own and null ids are kept; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections import Counter
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripsight.llm.common import batch, freeing, handover, parts, rows_of

#: (document, piece) entries, distinct pieces and documents of a block.
BLOCK_ENTRIES, BLOCK_PIECES, BLOCK_DOCS = 1_000_000, 200_000, 60_000
#: Texts of which the new pieces are encoded together, and (document, pair) entries expanded at a time.
CHUNK, EXPAND = 256, 1_000_000
#: Bits of the B id in a pair's code.
B_BITS = 24

#: Pieces encoded as one text, which saves the libraries' overhead for each text.
TOGETHER = 24

#: White space beside a space, as the pre-token pattern or Python sees it: no cut there.
_before, _after = re.compile(r"[^\S ] "), re.compile(r" [^\S ]")
_cut = re.compile(r"(?<=\S) (?=\S)")


class Vocabularies:
    """The two tokenizers with the bytes of each of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        # the byte-level alphabet: printable bytes stand for themselves, the others follow from 256
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(c): c for c in shown}
        letters.update({chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in shown)})
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            # an added token stands in plain text
            self.bytes_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.bytes_b.append(bytes([int(piece[3:5], 16)]))
            else:
                self.bytes_b.append(piece.replace("▁", " ").encode())
                if re.search("[^▁]▁", piece):
                    raise ValueError(f"pieces such as {piece!r} join words; this vocabulary can't be cut at spaces")

        self.size_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        # an id with the mark behind it in a group string: another follows, or its side of the group ends
        self.marks = [f"{i}{m}" for i in range(len(self.bytes_a)) for m in ",|"]
        self.marks += [f"{i}{m}" for i in range(len(self.bytes_b)) for m in ",;"]

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of each text, a space before it: A gets the space, B adds it."""
        got = self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return [e.ids for e in got], self.b.encode(texts, num_threads=1)

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, ...]:
        """Ids of all pieces in turn and their numbers by piece, for A and B; None in place of both if any bytes differ.

        Pieces stand between single spaces, so joined by spaces they give the tokens of each in turn.
        """
        joined = [" ".join(pieces[i:i + TOGETHER]) for i in range(0, len(pieces), TOGETHER)]
        raw = "".join([" " + p for p in pieces]).encode()
        to = np.cumsum(np.fromiter((len(p.encode()) + 1 for p in pieces), np.int64, len(pieces)))
        out: list[np.ndarray] = []
        for got, sizes, tokens in zip(self.encode(joined), (self.size_a, self.size_b), (self.bytes_a, self.bytes_b)):
            flat = list(chain.from_iterable(got))
            if b"".join(map(tokens.__getitem__, flat)) != raw:
                return ()
            ids = np.array(flat, dtype=np.int64)
            cuts = np.searchsorted(np.cumsum(sizes[ids]), to) + 1
            out += [ids, np.diff(cuts, prepend=0)]
        return tuple(out)


_loaded: dict[tuple[str, str], Vocabularies] = {}


def load(path_a: str, path_b: str) -> Vocabularies:
    key = (path_a, path_b)
    if key not in _loaded:
        _loaded[key] = Vocabularies(path_a, path_b)
    return _loaded[key]


def gallop(short: np.ndarray, long: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rank of each value of ``short`` in ``long`` (first index not below it), searched from ``start`` to ``end``.

    Exponential steps from the start, then a binary search inside the last step; all values advance together.
    """
    lo, hi = start.copy(), start.copy()
    step, far = 1, np.flatnonzero(lo < end)
    far = far[long[hi[far]] < short[far]]
    while len(far):
        lo[far] = hi[far] + 1
        hi[far] = np.minimum(hi[far] + step, end[far])
        step *= 2
        far = far[hi[far] < end[far]]
        far = far[long[hi[far]] < short[far]]
    near = np.flatnonzero(lo < hi)
    while len(near):
        mid = (lo[near] + hi[near]) >> 1
        below = long[mid] < short[near]
        lo[near[below]] = mid[below] + 1
        hi[near[~below]] = mid[~below]
        near = near[lo[near] < hi[near]]
    return lo


def expand(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first, first + 1, ... (``count`` of them) for each element, in turn."""
    total = np.cumsum(count)
    return np.arange(total[-1] if len(total) else 0) - np.repeat(total - count - first, count)


class Aligned(NamedTuple):
    """Alignments of several texts: figures and group strings by text, links (A id, B id) in the texts' order."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    text: list[str]


def align_tokens(a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, voc: Vocabularies) -> Aligned:
    """Align texts whose ids follow one another in ``a`` and ``b``, ``n_a`` and ``n_b`` to a text.

    The tokens of a text cover the same bytes in both. Each text's shorter list drives the search.
    """
    n = len(n_a)
    end_a, end_b = np.cumsum(voc.size_a[a]), np.cumsum(voc.size_b[b])
    to_a, to_b = np.cumsum(n_a), np.cumsum(n_b)
    of_link, link_a, link_b, cut_a, cut_b = [], [], [], [], []
    for by_b in (False, True):
        texts = np.flatnonzero((n_b < n_a) == by_b)
        count, to, long_n, long_to = (n_b, to_b, n_a, to_a) if by_b else (n_a, to_a, n_b, to_b)
        ends, long = (end_b, end_a) if by_b else (end_a, end_b)
        at = expand(to[texts] - count[texts], count[texts])  # driving tokens
        text = np.repeat(texts, count[texts])
        start = (long_to - long_n)[text]
        rank = gallop(ends[at], long, start, long_to[text])
        same = long[rank] == ends[at]
        # a token overlaps from where the one before it ended to its own rank
        first = np.empty(len(at), dtype=np.int64)
        if len(at):
            first[1:] = (rank + same)[:-1]
            opens = np.r_[True, text[1:] != text[:-1]]
            first[opens] = start[opens]
        width = rank - first + 1
        driving, other = np.repeat(at, width), expand(first, width)
        of_link.append(np.repeat(text, width))
        link_a.append(other if by_b else driving)
        link_b.append(driving if by_b else other)
        cut_a.append(rank[same] if by_b else at[same])
        cut_b.append(at[same] if by_b else rank[same])
    of_link = np.concatenate(of_link)
    order = np.argsort(of_link, kind="stable")
    link_a, link_b = np.concatenate(link_a)[order], np.concatenate(link_b)[order]
    cut_a, cut_b = np.sort(np.concatenate(cut_a)), np.sort(np.concatenate(cut_b))
    # group strings: each id with the mark behind it, A ids of a group before its B ids
    group_a, group_b = np.searchsorted(cut_a, np.arange(len(a))), np.searchsorted(cut_b, np.arange(len(b)))
    before_b = np.r_[0, cut_b + 1]
    marks = np.empty(len(a) + len(b), dtype=np.int64)
    marks[np.arange(len(a)) + before_b[group_a]] = 2 * a + (cut_a[group_a] == np.arange(len(a)))
    marks[np.arange(len(b)) + cut_a[group_b] + 1] = 2 * (b + len(voc.size_a)) + (cut_b[group_b] == np.arange(len(b)))
    said = list(map(voc.marks.__getitem__, marks.tolist()))
    edges = np.r_[0, to_a + to_b].tolist()
    text = ["".join(said[i:j])[:-1] for i, j in zip(edges, edges[1:])]
    n_groups = np.searchsorted(cut_a, to_a) - np.searchsorted(cut_a, to_a - n_a)
    return Aligned(n_a, n_b, n_groups, np.bincount(of_link, minlength=n), a[link_a], b[link_b], text)


def pieces_of(text: str) -> list[str]:
    """The text cut at single spaces between other characters (the space belongs to what follows)."""
    pieces = text.split(" ")
    if "" in pieces or _before.search(text) or _after.search(text):
        return _cut.split(text)
    return pieces


def packed(*arrays: np.ndarray) -> bytes:
    """Lists of whole numbers from 0 below 2^32, each in the fewest bytes that hold all of it (1, 2 or 4).

    Spark sorts blocks whole and holds them more than once, and most of a block are such lists.
    """
    out = []
    for x in arrays:
        top = int(x.max(initial=0))
        width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4
        out += [np.array([len(x), width], dtype="<u4").tobytes(), x.astype(f"<u{width}").tobytes()]
    return b"".join(out)


def unpacked(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        n, width = np.frombuffer(data, "<u4", 2, at).tolist()
        out.append(np.frombuffer(data, f"<u{width}", n, at + 8).astype(np.int64))
        at += 8 + n * width
    return out


_BLOCKS = pa.schema([("block", pa.int64()), ("docs", pa.binary()), ("shas", pa.binary()), ("entries", pa.binary()),
                     ("links", pa.binary()), ("pairs", pa.binary()), ("pair_docs", pa.binary()),
                     ("groups", pa.list_(pa.string()))])
_BLOCKS_DDL = ("block long, docs binary, shas binary, entries binary, links binary, pairs binary, pair_docs binary, "
               "groups array<string>")


class _Block:
    """Documents of a block, its distinct pieces and their alignments."""

    def __init__(self, number: int, voc: Vocabularies, with_groups: bool):
        self.number, self.voc, self.with_groups = number, voc, with_groups
        self.at: dict[str, int] = {}
        self.figures: list[np.ndarray] = []  # n_a, n_b, n_groups, n_links by piece
        self.codes: list[np.ndarray] = []
        self.text: dict[str, str | None] = {}  # group string by piece; None: the bytes differ
        self.ids, self.shas, self.groups = [], [], []
        self.sizes, self.units, self.times = [], [], []
        self.entries = 0

    def learn(self, new: list[str]) -> None:
        """Encode and align pieces that the block hasn't met."""
        voc = self.voc
        got = voc.encode_pieces(new)
        good = np.ones(len(new), dtype=bool)
        if got:
            a, n_a, b, n_b = got
        else:  # some piece's bytes differ: one by one
            ids_a, ids_b = voc.encode(new)
            for i, p in enumerate(new):
                raw = (" " + p).encode()
                good[i] = (b"".join(map(voc.bytes_a.__getitem__, ids_a[i])) == raw
                           == b"".join(map(voc.bytes_b.__getitem__, ids_b[i])))
            ids_a, ids_b = ([x if g else [] for x, g in zip(ids, good)] for ids in (ids_a, ids_b))
            n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (ids_a, ids_b))
            a, b = (np.array(list(chain.from_iterable(x)), dtype=np.int64) for x in (ids_a, ids_b))
        done = align_tokens(a, n_a, b, n_b, voc)
        first = len(self.at)
        self.at.update(zip(new, range(first, first + len(new))))
        self.text.update(zip(new, done.text if good.all() else [t if g else None for t, g in zip(done.text, good)]))
        self.figures.append(np.stack([done.n_a, done.n_b, done.n_groups, done.n_links]))
        self.codes.append(done.link_a << B_BITS | done.link_b)

    def add(self, ids: list, texts: list[str]) -> None:
        cut = [pieces_of(t) if t else [] for t in texts]
        counts = [Counter(ps) for ps in cut]
        new = set()
        for c in counts:
            new.update(c)
        new = list(new.difference(self.at))
        if new:
            self.learn(new)
        at, text = self.at.__getitem__, self.text.__getitem__
        for i, ps, c in zip(ids, cut, counts):
            said = list(map(text, ps))
            self.ids.append(i)
            if not ps or None in said:
                self.shas.append(b"")
                self.sizes.append(0)
                if self.with_groups:
                    self.groups.append("")
                continue
            whole = ";".join(said)
            self.shas.append(hashlib.sha256(whole.encode()).digest())
            if self.with_groups:
                self.groups.append(whole)
            self.sizes.append(len(c))
            self.units.append(np.fromiter(map(at, c), np.int64, len(c)))
            self.times.append(np.fromiter(c.values(), np.int64, len(c)))
            self.entries += len(c)

    def full(self) -> bool:
        return self.entries >= BLOCK_ENTRIES or len(self.at) >= BLOCK_PIECES or len(self.ids) >= BLOCK_DOCS

    def row(self) -> pa.RecordBatch:
        none = np.zeros(0, dtype=np.int64)
        pairs, local = np.unique(np.concatenate([none, *self.codes]), return_inverse=True)
        by_piece = np.concatenate([np.zeros((4, 0), dtype=np.int64), *self.figures], axis=1)
        n_links = by_piece[3]
        bounds = np.concatenate([[0], np.cumsum(n_links)])
        units, times = np.concatenate([none, *self.units]), np.concatenate([none, *self.times])
        sizes = np.array(self.sizes, dtype=np.int64)
        docs = np.repeat(np.arange(len(sizes)), sizes)
        figures = [np.bincount(docs, weights=times * f[units], minlength=len(sizes)).astype(np.int64) for f in by_piece]
        # documents that hold each pair linked; a document's entries are expanded together
        held = np.zeros(len(pairs), dtype=np.int64)
        load_ = np.cumsum(bounds[units + 1] - bounds[units]) if len(units) else units
        last = np.cumsum(sizes)
        lo = 0
        while lo < len(units):
            done = load_[lo - 1] if lo else 0
            k = np.searchsorted(load_, done + EXPAND, side="right")
            cuts = last[last <= k]
            hi = int(cuts[-1]) if len(cuts) and cuts[-1] > lo else int(last[last > lo][0])
            u, d = units[lo:hi], docs[lo:hi]
            n = bounds[u + 1] - bounds[u]
            key = np.unique((np.repeat(d, n) - d[0]) * len(pairs) + local[expand(bounds[u], n)])
            held += np.bincount(key % len(pairs), minlength=len(pairs))
            lo = hi
        keep = held > 0  # pieces of documents without tokens leave pairs that no document holds
        null = np.array([i is None for i in self.ids], dtype=np.int64)
        figures = np.stack([np.array([i or 0 for i in self.ids], dtype=np.int64), null, sizes, *figures]).astype("<i8")
        return batch(
            _BLOCKS, block=[self.number], docs=[figures.tobytes()],
            shas=[b"".join(s or bytes(32) for s in self.shas)],
            entries=[packed(units, times)], links=[packed(n_links, local)],
            pairs=[pairs.astype("<i8").tobytes()], pair_docs=[np.where(keep, held, 0).astype("<i8").tobytes()],
            groups=[self.groups if self.with_groups else None])


def _blocks(path_a: str, path_b: str, with_groups: bool):
    @freeing
    def run(batches):
        voc = load(path_a, path_b)
        task, n = TaskContext.get().partitionId(), 0
        block = _Block(task << 24, voc, with_groups)
        for b in batches:
            for lo in range(0, b.num_rows, CHUNK):
                block.add(*(b.column(c).slice(lo, CHUNK).to_pylist() for c in ("doc_id", "text")))
                if block.full():
                    yield block.row()
                    n += 1
                    block = _Block((task << 24) + n, voc, with_groups)
        if block.ids:
            yield block.row()

    return run


_ASKED = pa.schema([("block", pa.int64()), ("pair", pa.int64()), ("n", pa.int64())])


@freeing
def _asked(batches):
    for blocks, pairs, docs in rows_of(batches, "block", "pairs", "pair_docs"):
        for b, p, n in zip(blocks, pairs, docs):
            p, n = np.frombuffer(p, dtype="<i8"), np.frombuffer(n, dtype="<i8")
            p, n = p[n > 0], n[n > 0]
            for lo in range(0, len(p), 100_000):
                yield batch(_ASKED, block=np.full(len(p[lo:lo + 100_000]), b), pair=p[lo:lo + 100_000],
                            n=n[lo:lo + 100_000])


_OUT = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                  ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()),
                  ("groups_sha256", pa.string()), ("groups", pa.string())])
_OUT_DDL = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
            "groups_sha256 string, groups string")


@freeing
def _met(batches):
    """Answers of a block (sorted before it) meet the block."""
    block, pair, n, best = None, [], [], []
    for b in batches:
        if not b.num_rows:
            continue
        blocks = b.column("block").to_numpy()
        whole = [i for i, x in enumerate(b.column("docs").is_valid().to_pylist()) if x]
        lo = 0
        for i in [*whole, b.num_rows]:
            if i > lo:  # answers before the next whole block
                got = b.slice(lo, i - lo)
                if blocks[lo] != block:
                    block, pair, n, best = blocks[lo], [], [], []
                pair.append(got.column("pair").to_numpy())
                n.append(got.column("n").to_numpy())
                best.append(got.column("best").to_numpy())
            if i < b.num_rows:
                here = block == blocks[i]
                yield _finish(b.slice(i, 1).to_pylist()[0], *(np.concatenate(x) if here and x else np.zeros(0, np.int64)
                                                             for x in (pair, n, best)))
                block, pair, n, best = None, [], [], []
            lo = i + 1


def _finish(row: dict, pair: np.ndarray, n: np.ndarray, best: np.ndarray) -> pa.RecordBatch:
    ids, null, sizes, n_a, n_b, n_groups, n_links = np.frombuffer(row["docs"], dtype="<i8").reshape(7, -1)
    pairs = np.frombuffer(row["pairs"], dtype="<i8")
    per, local = unpacked(row["links"])
    units, times = unpacked(row["entries"])
    at = np.searchsorted(pairs, pair)
    count, top = np.zeros(len(pairs), dtype=np.int64), np.zeros(len(pairs), dtype=np.int64)
    count[at], top[at] = n, best
    first = np.concatenate([[0], np.cumsum(per)])

    def by_doc(of_pair: np.ndarray) -> np.ndarray:
        run = np.concatenate([[0], np.cumsum(of_pair[local])])
        of_unit = run[first[1:]] - run[first[:-1]]
        run = np.concatenate([[0], np.cumsum(times * of_unit[units])])
        ends_ = np.cumsum(sizes)
        return run[ends_] - run[ends_ - sizes]

    shas = [row["shas"][i:i + 32].hex() if t else "" for i, t in zip(range(0, 32 * len(ids), 32), n_a.tolist())]
    return batch(_OUT, doc_id=pa.array(ids, mask=null.astype(bool)), n_a=n_a, n_b=n_b, n_groups=n_groups,
                 n_links=n_links, n_best=by_doc(top), count_sum=by_doc(count), groups_sha256=shas,
                 groups=row["groups"] if row["groups"] is not None else [None] * len(ids))


def pair_counts(asked: DataFrame) -> DataFrame:
    """Pair, documents that hold it linked, and whether that is the highest count of its A id (1 or 0)."""
    counts = asked.groupBy("pair").agg(F.sum("n").alias("n"))
    # an A id has at most as many rows here as the other vocabulary has pieces
    of_a = Window.partitionBy(F.shiftright("pair", B_BITS))
    return counts.select("pair", "n", (F.col("n") == F.max("n").over(of_a)).cast("long").alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = False) -> DataFrame:
    """One row per document: its tokens, groups and links, with corpus-wide pair counts summed over the links.

    ``path_a`` is a byte-level vocabulary of the library tokenizers, ``path_b`` one of sentencepiece.
    ``groups`` holds the alignment itself (``a1,a2|b1;a3|b2,b3``) if ``with_groups``, else null.
    """
    n = parts(docs.sparkSession)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    blocks = handover(src.mapInArrow(_blocks(path_a, path_b, with_groups), _BLOCKS_DDL), "alignment-blocks")
    asked = handover(blocks.select("block", "pairs", "pair_docs").mapInArrow(_asked, "block long, pair long, n long"),
                     "alignment-pairs")
    counts = pair_counts(asked)
    answers = asked.select("block", "pair").join(counts, "pair")
    held = [F.col(c) for c in ("docs", "shas", "entries", "links", "pairs", "groups")]
    none = [F.lit(None).cast(blocks.schema[c].dataType).alias(c) for c in
            ("docs", "shas", "entries", "links", "pairs", "groups")]
    both = answers.select("block", "pair", "n", "best", *none).unionByName(
        blocks.select("block", *[F.lit(None).cast("long").alias(c) for c in ("pair", "n", "best")], *held))
    met = both.repartition(n, "block").sortWithinPartitions("block", F.col("docs").isNotNull())
    return met.mapInArrow(_met, _OUT_DDL)
