"""Exact deduplication with Patricia tries.

Texts are equal when they are identical after every run of white space is one space. Each
scan task first puts the texts it reads into a trie of its own, so a group of copies, however
large, leaves a task as one owner row. The owners are then partitioned by length and content
hash; every partition inserts their full byte strings into a compressed radix trie whose
terminal nodes hold the smallest identifier and the number of copies. A trie that outgrows its
budget spills by subtree to the task's own temporary file and finishes one subtree at a time.

Defined results: null text counts as the empty text; empty texts are copies of each other;
rows that repeat a ``doc_id`` each keep their own output row; an empty table gives no rows;
extra columns are ignored. Null ids are grouped like other rows and own a group only when it
has no other id.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripsight.llm.common import SPACE_CLASS, batch, freeing, handover, parts, rows_of

#: Bytes of text that one trie holds before it spills (reduce side) or is flushed (scan side).
TRIE_BYTES = 48 << 20
#: Bytes beyond which owners leave the scan task in another Arrow batch.
OUT_BYTES = 8 << 20

#: Memory that a node takes besides its label.
NODE_BYTES = 160

_NO_ID = 1 << 63  # sorts after every long


def _common(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of ``a`` and ``b[at:]``."""
    n = min(len(a), len(b) - at)
    if a[:n] == b[at:at + n]:
        return n
    lo, hi = 0, n  # a[:lo] agrees, a[:hi] does not
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[at + lo:at + mid]:
            lo = mid
        else:
            hi = mid
    return lo


class PatriciaTrie:
    """Compressed radix trie from byte strings to ``[smallest id, copies]``.

    A node is ``[label, children by first byte, value]``. With ``spill`` set, a trie above
    ``budget`` bytes moves the largest subtree below its topmost fork to a temporary file and
    leaves a stub (children ``None``, value the file) there; strings that reach the stub later
    follow into the file, and ``items`` reads each file back into a trie of its own.
    """

    def __init__(self, budget: int = TRIE_BYTES, spill: bool = False):
        self.root: list = [b"", {}, None]
        self.budget, self.spilling, self.bytes = budget, spill, 0

    def insert(self, key: bytes, ident: int, copies: int = 1) -> None:
        self._insert(key, ident, copies)
        if self.spilling and self.bytes > self.budget:  # between inserts, never within one
            self._spill()

    def _insert(self, key: bytes, ident: int, copies: int) -> None:
        at, node = 0, self.root
        while at < len(key):
            child = node[1].get(key[at])
            if child is None:
                node[1][key[at]] = [key[at:], {}, [ident, copies]]
                self.bytes += len(key) - at + NODE_BYTES
                return
            if child[1] is None:
                pickle.dump((key, ident, copies), child[2])
                return
            n = _common(child[0], key, at)
            if n < len(child[0]):  # split the edge
                lower = [child[0][n:], child[1], child[2]]
                child[0], child[1], child[2] = child[0][:n], {lower[0][0]: lower}, None
                self.bytes += NODE_BYTES
            at += n
            node = child
        if node[2] is None:
            node[2] = [ident, copies]
        else:
            node[2] = [min(ident, node[2][0]), copies + node[2][1]]

    def _spill(self) -> None:
        node, prefix = self.root, b""
        while len(node[1]) == 1 and node[2] is None:  # down to the topmost fork
            child = next(iter(node[1].values()))
            if child[1] is None:
                return
            node, prefix = child, prefix + child[0]
        held = {b: sum(len(x[0]) + NODE_BYTES for x in _nodes(c)) for b, c in node[1].items() if c[1] is not None}
        if not held:
            return
        top = max(held, key=held.get)
        f = tempfile.TemporaryFile()
        for item in _strings(node[1][top], prefix):
            pickle.dump(item, f)
        for stub in [x for x in _nodes(node[1][top]) if x[1] is None]:  # spilled before, further down
            for item in _records(stub[2]):
                pickle.dump(item, f)
        node[1][top] = [bytes([top]), None, f]
        self.bytes -= held[top]

    def items(self) -> Iterator[tuple[bytes, int, int]]:
        """Every (string, smallest id, copies); spilled subtrees one at a time. Empties the trie."""
        root, self.root = self.root, [b"", {}, None]
        yield from _strings(root, b"")
        for f in [x[2] for x in _nodes(root) if x[1] is None]:
            sub = PatriciaTrie(self.budget, True)
            for item in _records(f):
                sub.insert(*item)
            yield from sub.items()


def _records(f) -> Iterator[tuple[bytes, int, int]]:
    """The strings of a spill file, which is closed after the last."""
    f.seek(0)
    try:
        while True:
            yield pickle.load(f)
    except EOFError:
        f.close()


def _nodes(node: list) -> Iterator[list]:
    stack = [node]
    while stack:
        yield (node := stack.pop())
        stack.extend((node[1] or {}).values())


def _strings(node: list, prefix: bytes) -> Iterator[tuple[bytes, int, int]]:
    stack = [(node, prefix)]
    while stack:
        node, prefix = stack.pop()
        if node[1] is None:
            continue
        key = prefix + node[0]
        if node[2] is not None:
            yield key, node[2][0], node[2][1]
        stack.extend((c, key) for c in node[1].values())


#: Rows of a run at most (a run of copies adds no bytes to its trie).
RUN_ROWS = 200_000

_OWNED = pa.schema([("doc_id", pa.int64()), ("owner_id", pa.int64()), ("block", pa.string()), ("sha", pa.binary()),
                    ("norm", pa.string()), ("copies", pa.int64())])


def _local_owners(budget: int):
    """Scan side: one trie per run of rows; every row gets its owner within the run."""

    def flush(run: list, trie: PatriciaTrie, block: str):
        own = {key: (ident, copies) for key, ident, copies in trie.items()}
        seen: set[bytes] = set()
        out: list[tuple] = []
        size = 0
        for ident, key, sha in run:
            owner, copies = own[key]
            first = key not in seen
            seen.add(key)
            out.append((None if ident == _NO_ID else ident, None if owner == _NO_ID else owner, block, sha,
                        key.decode("utf-8") if first else None, copies if first else 0))
            size += len(key) if first else 40
            if size > OUT_BYTES:
                yield batch(_OWNED, **dict(zip(_OWNED.names, map(list, zip(*out)))))
                out, size = [], 0
        if out:
            yield batch(_OWNED, **dict(zip(_OWNED.names, map(list, zip(*out)))))

    @freeing
    def run_task(batches):
        task, n = TaskContext.get().partitionId(), 0
        run, trie, interned = [], PatriciaTrie(budget), {}
        for ids, norms, shas in rows_of(batches, "doc_id", "norm", "sha"):
            for ident, text, sha in zip(ids, norms, shas):
                key = text.encode("utf-8")
                key = interned.setdefault(key, key)  # copies in one run share their bytes
                ident = _NO_ID if ident is None else ident
                trie.insert(key, ident)
                run.append((ident, key, sha))
                if trie.bytes > budget or len(run) >= RUN_ROWS:
                    yield from flush(run, trie, f"{task}-{n}")
                    run, trie, interned, n = [], PatriciaTrie(budget), {}, n + 1
        if run:
            yield from flush(run, trie, f"{task}-{n}")

    return run_task


_GROUPS = pa.schema([("sha", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64())])


def _global_owners(budget: int):
    """Reduce side: full strings of one length-and-hash partition into one spilling trie."""

    @freeing
    def run_task(batches):
        trie = PatriciaTrie(budget, spill=True)
        for ids, norms, copies in rows_of(batches, "owner_id", "norm", "copies"):
            for ident, text, n in zip(ids, norms, copies):
                trie.insert(text.encode("utf-8"), _NO_ID if ident is None else ident, n)
        out: list[tuple] = []
        for key, ident, n in trie.items():
            out.append((hashlib.sha256(key).digest(), None if ident == _NO_ID else ident, n))
            if len(out) == 20_000:
                yield batch(_GROUPS, **dict(zip(_GROUPS.names, map(list, zip(*out)))))
                out = []
        if out:
            yield batch(_GROUPS, **dict(zip(_GROUPS.names, map(list, zip(*out)))))

    return run_task


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                budget: int = TRIE_BYTES) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Two shuffles: the distinct texts of each scan task go once to their length-and-hash
    partition, and the narrow memberships (no text) meet the group results by (block, owner),
    a key that no more rows share than one scan task holds.
    """
    spark = docs.sparkSession
    norm = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACE_CLASS, " ")
    src = (docs.select(F.col(id_col).cast("long").alias("doc_id"), norm.alias("norm"))
           .withColumn("sha", F.unhex(F.sha2(F.col("norm"), 256))))
    owned = handover(src.mapInArrow(_local_owners(budget), "doc_id long, owner_id long, block string, sha binary, "
                                                           "norm string, copies long"), "exact-owners")
    owners = owned.where(F.col("norm").isNotNull())
    n = parts(spark)
    dealt = (owners.select("owner_id", "norm", "copies")
             .repartition(n, F.length("norm"), F.xxhash64("norm")))
    groups = dealt.mapInArrow(_global_owners(budget), "sha binary, keep_id long, group_size long")
    # a block's owners learn their group, then the block's rows learn it from their owner
    per_block = (owners.select("block", "sha").join(groups, "sha"))
    rows = owned.select("doc_id", "block", "sha")
    return (rows.join(per_block, ["block", "sha"])
            .select("doc_id", "keep_id", "group_size",
                    F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
                    F.lower(F.hex("sha")).alias("text_sha256")))
