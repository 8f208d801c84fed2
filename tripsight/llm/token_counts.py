"""Token counts without ids: pieces are counted once per distinct pre-token.

1. The scan splits texts into pre-tokens (the vocabulary's own pattern) and turns each block of
   documents into an inverted table: for every distinct pre-token of the block, the documents that
   hold it and how often. One row per (block, pre-token), so a pre-token that every document holds
   is as many rows as there are blocks.
2. The rows are dealt by pre-token; each partition runs the tokenizer once per distinct pre-token
   and meets its frequencies, which adds up pieces by document of each block (sparse).
3. The sums are dealt by block and meet the block's list of documents.

No ids are kept anywhere. Only pre-tokens, frequencies and sums are shuffled, never texts.

Defined results: null and empty texts have 0 bytes and 0 tokens; special strings inside texts
count as the library counts them by default (one token); repeated rows give one row each; null
ids are kept; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import os
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripsight.llm.common import batch, parts, rows_of

#: Fixed value: the pre-token pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Fixed value: its special string, which counts as one token.
SPECIAL = "<|endoftext|>"
#: (document, pre-token) pairs and documents of a block.
BLOCK_PAIRS, BLOCK_DOCS = 1_500_000, 60_000
#: Rows of an Arrow batch, and entries of a partition's piece counts before they start again.
OUT_ROWS, CACHE = 50_000, 400_000
#: (block, document) sums that a partition holds before they leave the task.
HELD_SUMS = 2_000_000
#: Pre-tokens that the tokenizer gets at a time.
ENCODE = 20_000

_pattern = regex.compile(PATTERN)
#: Characters on which the pattern's classes agree in all Unicode versions at hand.
_plain = regex.compile(r"[\t\n\r\x20-\x7e -ɏ‐-‧€]*")
_tokenizers: dict[str, object] = {}


def load_tokenizer(path: str):
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


def pre_tokens(text: str, path: str) -> list[str]:
    """A text's pre-tokens; a special string is one of its own."""
    out: list[str] = []
    for i, part in enumerate(text.split(SPECIAL)):
        if i:
            out.append(SPECIAL)
        if not part:
            continue
        if _plain.fullmatch(part):
            out += _pattern.findall(part)
        else:  # the library's own splitter, whose spans give back the text
            out += [part[a:b] for _, (a, b) in load_tokenizer(path).pre_tokenizer.pre_tokenize_str(part)]
    return out


_INV = pa.schema([("block", pa.int64()), ("token", pa.string()), ("posts", pa.binary())])
_INV_DDL = "block long, token string, posts binary"


def _pack(doc: np.ndarray, freq: np.ndarray) -> np.ndarray:
    """(document, frequency) as pairs of 16 bits; larger frequencies take several pairs."""
    if len(freq) and freq.max() > 65535:
        times = (freq + 65534) // 65535
        at = np.repeat(np.arange(len(freq)), times)
        last = np.cumsum(times) - 1
        f = np.full(len(at), 65535)
        f[last] = freq - (times - 1) * 65535
        return doc[at], f, times
    return doc, freq, np.ones(len(freq), dtype=np.int64)


def _invert(path: str):
    def run(batches):
        task = TaskContext.get().partitionId()
        tokens: dict[str, int] = {}
        tok, doc, freq = [], [], []
        ids, sizes, pairs, n = [], [], 0, 0

        def flush():
            # the block number leaves room for as many blocks in a task as it could need
            block = (task << 24) + n
            t, d, f = np.concatenate(tok or [np.zeros(0, np.int64)]), np.concatenate(doc or [np.zeros(0, np.int64)]), \
                np.concatenate(freq or [np.zeros(0, np.int64)])
            o = np.argsort(t, kind="stable")
            t, d, f = t[o], d[o], f[o]
            d2, f2, times = _pack(d, f)
            t2 = np.repeat(t, times)
            raw = np.stack([d2.astype("<u2"), f2.astype("<u2")], axis=1).tobytes()
            cut = np.searchsorted(t2, np.arange(len(tokens) + 1)).tolist()
            names = list(tokens)
            for lo in range(0, len(names), OUT_ROWS):
                hi = min(lo + OUT_ROWS, len(names))
                yield batch(_INV, block=[block] * (hi - lo), token=names[lo:hi],
                            posts=[raw[4 * cut[i]:4 * cut[i + 1]] for i in range(lo, hi)])
            # the block's documents, under no token
            for lo in range(0, len(ids), OUT_ROWS):
                hi = min(lo + OUT_ROWS, len(ids))
                head = np.array([[lo, hi]], dtype="<i8").tobytes()
                mark = np.array([i is None for i in ids[lo:hi]], dtype=np.uint8).tobytes()
                body = np.array([[i or 0 for i in ids[lo:hi]], sizes[lo:hi]], dtype="<i8").tobytes()
                yield batch(_INV, block=[block], token=[None], posts=[head + mark + body])

        for doc_ids, texts in rows_of(batches, "doc_id", "text"):
            for i, t in zip(doc_ids, texts):
                c = Counter(pre_tokens(t, path))
                if c:
                    tok.append(np.fromiter((tokens.setdefault(w, len(tokens)) for w in c), np.int64, len(c)))
                    freq.append(np.fromiter(c.values(), np.int64, len(c)))
                    doc.append(np.full(len(c), len(ids), dtype=np.int64))
                    pairs += len(c)
                ids.append(i)
                sizes.append(len(t.encode("utf-8")))
                if pairs >= BLOCK_PAIRS or len(ids) >= BLOCK_DOCS:
                    yield from flush()
                    tokens.clear()
                    for x in (tok, doc, freq, ids, sizes):
                        x.clear()
                    pairs, n = 0, n + 1
        if ids:
            yield from flush()

    return run


_SUMS = pa.schema([("block", pa.int64()), ("docs", pa.binary()), ("sums", pa.binary()), ("posts", pa.binary())])
_SUMS_DDL = "block long, docs binary, sums binary, posts binary"


def _count(path: str):
    """Pieces once per distinct pre-token, times its frequencies, added up by document."""
    def run(batches):
        tk = load_tokenizer(path)
        pieces: dict[str, int] = {}
        held: dict[int, list] = {}
        size = 0

        def flush():
            for block, got in held.items():
                d = np.concatenate([x[0] for x in got])
                s = np.concatenate([x[1] for x in got])
                total = np.bincount(d, weights=s)
                at = np.flatnonzero(total)
                yield batch(_SUMS, block=[block], docs=[at.astype("<u2").tobytes()],
                            sums=[total[at].astype("<i8").tobytes()], posts=[None])

        for blocks, tokens, posts in rows_of(batches, "block", "token", "posts"):
            lists = [i for i, t in enumerate(tokens) if t is None]  # lists of documents pass through
            if lists:
                yield batch(_SUMS, block=[blocks[i] for i in lists], docs=[None] * len(lists),
                            sums=[None] * len(lists), posts=[posts[i] for i in lists])
            new = list(set(tokens).difference(pieces, (None,)))
            for lo in range(0, len(new), ENCODE):
                some = new[lo:lo + ENCODE]
                pieces.update(zip(some, (len(e) for e in tk.encode_batch_fast(some, add_special_tokens=False))))
            by: dict[int, list] = {}
            for i, b in enumerate(blocks):
                if tokens[i] is not None:
                    by.setdefault(b, []).append(i)
            for b, rows in by.items():
                raw = np.frombuffer(b"".join([posts[i] for i in rows]), dtype="<u2").reshape(-1, 2).astype(np.int64)
                n = np.repeat([pieces[tokens[i]] for i in rows], [len(posts[i]) // 4 for i in rows])
                # one sum per document, so what is held shrinks with every batch
                total = np.bincount(raw[:, 0], weights=raw[:, 1] * n)
                at = np.flatnonzero(total)
                held.setdefault(b, []).append((at, total[at]))
                size += len(at)
            if len(pieces) > CACHE:
                pieces.clear()
            if size > HELD_SUMS:
                yield from flush()
                held, size = {}, 0
        yield from flush()

    return run


_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def _total(batches):
    """Sums of a block meet its documents; rows come sorted by block, sums before documents."""
    block, total = None, np.zeros(0, dtype=np.int64)
    for blocks, docs, sums, lists in rows_of(batches, "block", "docs", "sums", "posts"):
        for b, d, s, p in zip(blocks, docs, sums, lists):
            if b != block:
                block, total = b, np.zeros(BLOCK_DOCS, dtype=np.int64)
            if p is None:
                total[np.frombuffer(d, dtype="<u2")] += np.frombuffer(s, dtype="<i8")
                continue
            lo, hi = (int(x) for x in np.frombuffer(p[:16], dtype="<i8"))
            null = np.frombuffer(p[16:16 + hi - lo], dtype=np.uint8).astype(bool)
            ids, sizes = np.frombuffer(p[16 + hi - lo:], dtype="<i8").reshape(2, -1)
            yield batch(_OUT, doc_id=pa.array(ids, mask=null), n_bytes=sizes, n_tokens=total[lo:hi].copy())


def count_tokens(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens (without added special tokens)."""
    n = parts(docs.sparkSession)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    inverted = src.mapInArrow(_invert(tokenizer_path), _INV_DDL)
    dealt = inverted.repartition(n, F.coalesce("token", F.col("block").cast("string")))
    met = (dealt.mapInArrow(_count(tokenizer_path), _SUMS_DDL).repartition(n, "block")
           .sortWithinPartitions("block", F.col("posts").isNotNull()))
    return met.mapInArrow(_total, "doc_id long, n_bytes long, n_tokens long")
