"""Curriculum mixing, cross-tokenizer alignment and hard negatives against brute force."""

import hashlib
import os
import random
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tripsight.llm import alignment as AL
from tripsight.llm import curriculum as CU
from tripsight.llm import hard_negatives as HN

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# ---- alignment -----------------------------------------------------------------------------------

def brute_alignment(texts):
    """Whole texts by the libraries, groups by sets, links by comparing all byte ranges."""
    voc = AL.load(A, B)
    docs, held = [], Counter()
    for t in texts:
        raw = (" " + (t or "")).encode()
        a = voc.a.encode(" " + t, add_special_tokens=False).ids if t else []
        b = voc.b.encode(t) if t else []
        ea, eb = (list(accumulate(len(v[i]) for i in x)) for x, v in ((a, voc.bytes_a), (b, voc.bytes_b)))
        if b"".join(voc.bytes_a[i] for i in a) != raw or b"".join(voc.bytes_b[i] for i in b) != raw:
            docs.append(None)
            continue
        links = [(x, y) for x, s, e in zip(a, [0, *ea], ea) for y, u, v in zip(b, [0, *eb], eb) if s < v and u < e]
        groups, i, j = [], 0, 0
        for cut in sorted(set(ea) & set(eb)):
            p, q = ea.index(cut) + 1, eb.index(cut) + 1
            groups.append((a[i:p], b[j:q]))
            i, j = p, q
        held.update(set(links))
        docs.append((a, b, groups, links))
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = d
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((len(a), len(b), len(groups), len(links), sum(held[k] == top[k[0]] for k in links),
                    sum(held[k] for k in links), hashlib.sha256(text.encode()).hexdigest()))
    return out


ODD = ["", None, " ", "a", "  two  spaces ", "tab\there\nline \n end", "<|endoftext|> and </s> <unk> <0x41>", "▁bar▁",
       "naïve 中文字 😀 é", "\x1c sep\x1fs", "x" * 3000, "word " * 4000, "don't we'll 1,234.5 (a)\r\n{}"]


def test_gallop_ranks():
    rng = random.Random(5)
    for _ in range(300):
        long = sorted(rng.sample(range(200), rng.randint(1, 60)))
        short = sorted(rng.sample(range(long[-1] + 1), rng.randint(0, min(20, long[-1] + 1))))
        start = np.array([rng.randint(0, sum(y < x for y in long)) for x in short], dtype=np.int64)
        got = AL.gallop(np.array(short, dtype=np.int64), np.array(long), start, np.full(len(short), len(long)))
        assert got.tolist() == [sum(y < x for y in long) for x in short]


def test_alignment_against_all_ranges(spark):
    rng = random.Random(3)
    letters = " \n\tab'sé▁中😀.,1２ the"
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(120)]
    texts += ["the cat sat on the mat", "the cat sat on the mat"]
    rows = [(i if i != 7 else None, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block string").repartition(5)
    got = {r["doc_id"]: tuple(r)[1:8] for r in AL.align(docs, A, B).collect()}
    want = brute_alignment(texts)
    assert len(got) == len(texts)
    for i, w in enumerate(want):
        assert got[i if i != 7 else None] == w, texts[i]


def test_alignment_small_blocks_and_groups(spark, monkeypatch):
    """Blocks of few entries on the driver's side of the code: the same figures, block by block."""
    voc = AL.load(A, B)
    texts = ["one two three two", "two three", "", "no  cut", "two"]
    block = AL._Block(1, voc, True)
    block.add(list(range(5)), texts)
    monkeypatch.setattr(AL, "EXPAND", 1)
    row = block.row()
    pairs = np.frombuffer(row.column("pairs")[0].as_py(), "<i8")
    held = np.frombuffer(row.column("pair_docs")[0].as_py(), "<i8")
    want = Counter()
    for t in texts:
        if t:
            a, b = voc.encode([t])
            got = AL.align_tokens(*(np.array(x) for x in (a[0], [len(a[0])], b[0], [len(b[0])])), voc)
            want.update(set(zip(got.link_a.tolist(), got.link_b.tolist())))
    assert {(int(p) >> AL.B_BITS, int(p) & (1 << AL.B_BITS) - 1): int(n) for p, n in zip(pairs, held)} == dict(want)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in AL.align(docs, A, B, with_groups=True).collect():
        assert hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"] or r["groups"] == ""


def test_block_lists_take_the_fewest_bytes():
    rng = np.random.default_rng(3)
    for lists in ([rng.integers(0, 200_000, 5000), rng.integers(1, 200, 5000)], [np.arange(70_000), np.arange(65_536)],
                  [np.zeros(0, np.int64), np.array([255, 0]), np.array([256]), np.array([(1 << 32) - 1])],
                  [np.array([7]), np.zeros(0, np.int64)]):
        got = AL.unpacked(AL.packed(*lists))
        assert [x.tolist() for x in got] == [x.tolist() for x in lists]
    # a block's links and times are small numbers: a row of it is less than 4 bytes an entry and link
    block = AL._Block(0, AL.load(A, B), False)
    words = [f"word{i}" for i in range(3000)]
    block.add(list(range(20)), [" ".join(words)] * 20)
    row = block.row().to_pylist()[0]
    per, local = AL.unpacked(row["links"])
    assert len(row["links"]) < 3 * (len(per) + len(local)) and len(row["entries"]) < 4 * 20 * 3000


def test_alignment_of_a_piece_repeated_beyond_two_bytes(spark):
    docs = spark.createDataFrame([(0, "again " * 70_000 + "end"), (1, "again"), (2, "end")], "doc_id long, text string")
    got = {r["doc_id"]: np.array(tuple(r)[1:7]) for r in AL.align(docs, A, B).collect()}
    assert (got[0] == 70_000 * got[1] + got[2]).all()


_AFTER_A_SCAN = """
import re
import pyarrow as pa
from tripsight.llm import alignment as AL
import public_tokenizers as P

def held():
    return int(re.search(r"RssAnon:\\s+(\\d+)", open("/proc/self/status").read())[1]) >> 10

AL.TaskContext = type("Task", (), {"get": staticmethod(lambda: type("T", (), {"partitionId": lambda s: 0})())})
step = AL._blocks(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"), False)

def texts(n):
    for lo in range(0, n, 500):
        yield pa.RecordBatch.from_pydict({"doc_id": list(range(lo, lo + 500)), "text": [
            " ".join(f"w{(i * 7919 + k * 104729) % 60000}" for k in range(300)) for i in range(lo, lo + 500)]})

for _ in step(texts(500)):
    pass
before = held()
n = sum(b.num_rows for b in step(texts(3000)))
print(n, held() - before)
"""


def test_alignment_scan_gives_its_memory_back():
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    got = subprocess.run([sys.executable, "-c", _AFTER_A_SCAN], env=os.environ | {"PYTHONPATH": os.pathsep.join(
        [root, *sys.path])}, check=True, capture_output=True, text=True, timeout=300).stdout.split()
    assert int(got[0]) >= 1 and int(got[1]) < 25  # MB


def test_alignment_empty_and_repeated(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert AL.align(none, A, B).count() == 0
    docs = spark.createDataFrame([(1, "same text")] * 40 + [(2, "same")], "doc_id long, text string")
    got = AL.align(docs, A, B).collect()
    want = brute_alignment(["same text"] * 40 + ["same"])
    assert sorted(tuple(r)[1:8] for r in got) == sorted(want)


# ---- curriculum ----------------------------------------------------------------------------------

def brute_targets(sizes, weights, passes=3):
    """Reshare by weight until no target is above its cap."""
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = total - sum(fixed.values())
        open_ = {s for s in sizes if s not in fixed}
        w = sum(weights[s] for s in open_)
        share = {s: weights[s] * rest / w for s in open_}
        over = {s for s in open_ if share[s] > passes * sizes[s]}
        if not over:
            return {**fixed, **share}
        fixed.update({s: float(passes * sizes[s]) for s in over})


@pytest.mark.parametrize("n_sources,skew", [(7, False), (40, True)])
def test_curriculum_targets_and_words(spark, n_sources, skew):
    rng = random.Random(n_sources)
    rows = []
    for i in range(900):
        s = "hot" if skew and rng.random() < 0.4 else f"s{rng.randrange(n_sources)}"
        rows.append((i, s, " ".join(["w"] * rng.choice([0, 1, 5, 40]))))
    rows += [(900, None, "of no source"), (901, "silent", ""), (902, "silent", None), (None, "s1", "a b"), (5, "s1", "c"),
             (5, "s1", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("size", F.lit("clash"))
    mix = CU.curriculum(docs.repartition(7))
    got = mix.collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, s, t in rows:
        sizes[s] += len((t or "").split())
    names = sorted((s for s in sizes if s is not None)) + [None]
    want = brute_targets(sizes, {s: i % 3 + 1 for i, s in enumerate(names)})
    taken = defaultdict(int)
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert r["taken"] == sum(r["words"]) <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in names:
        assert 0 <= want[s] - taken[s] < 1.0 + 1e-6
    first = [r["positions"][0] for r in got if r["positions"]]
    assert first == sorted(first)  # range-sorted, documents not taken last
    again = CU.curriculum(docs.repartition(3).select("text", "source", "doc_id")).collect()
    key = lambda r: (r["source"] or "", r["doc_id"] or -1, r["size"], r["taken"], r["positions"])
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_curriculum_follows_the_schedules(spark):
    """At every time the words given so far are the integrals of the schedules."""
    rows = [(i, f"s{i % 3}", "w " * (1 + i % 4)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    flow = CU.training_order(CU.curriculum(docs)).toPandas()
    assert flow.position.is_monotonic_increasing
    total = flow.groupby("source").words.sum()
    for t in (0.1, 0.37, 0.5, 0.81):
        done = flow[flow.position < t].groupby("source").words.sum() / total
        for i, knots in enumerate(CU.SCHEDULES):
            x = np.linspace(0, 1, 100_001)
            w = np.interp(x, *zip(*knots))
            share = w[x < t].sum() / w.sum()
            assert done[f"s{i}"] == pytest.approx(share, abs=0.01)


def test_time_inverts_integral(spark):
    knots = [(0.0, 0.0), (0.25, 4.0), (0.5, 0.0), (0.75, 0.0), (1.0, 1.0)]
    cum = CU.integral(knots)
    df = spark.range(0, 101).select((F.col("id") / 100.0).alias("y"))
    got = df.select("y", CU.time_of(F.col("y"), F.lit(0), [knots]).alias("t")).collect()
    x = np.linspace(0, 1, 200_001)
    w = np.interp(x, *zip(*knots))
    run = np.concatenate([[0], np.cumsum((w[1:] + w[:-1]) / 2 * np.diff(x))])
    for r in got:
        assert np.interp(r["t"], x, run) == pytest.approx(r["y"] * cum[-1], abs=1e-6)


def test_curriculum_empty_and_wordless(spark):
    none = spark.createDataFrame([], "doc_id long, source string, text string")
    assert CU.curriculum(none).count() == 0
    silent = spark.createDataFrame([(1, "a", ""), (2, None, None)], "doc_id long, source string, text string")
    assert [(r["target"], r["taken"], r["positions"]) for r in CU.curriculum(silent).collect()] == [(0.0, 0, [])] * 2
    with pytest.raises(ValueError):
        CU.check_schedules([[(0.0, 1.0), (0.5, 1.0)]])


# ---- hard negatives ------------------------------------------------------------------------------

def brute_negatives(rows, every=100, k=5):
    out = []
    vecs = {}
    for i, (vid, label, v) in enumerate(rows):
        if vid is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        vecs[i] = [int(x) for x in np.clip(np.floor(256 * np.array(v, dtype=np.float64)), -HN.LIMIT, HN.LIMIT)]
    for a in vecs:
        if rows[a][0] % every:
            continue
        score = {c: sum(x * y for x, y in zip(vecs[a], vecs[c])) for c in vecs if rows[c][0] != rows[a][0]}
        order = sorted(score, key=lambda c: (-score[c], rows[c][0]))
        for p in [c for c in order if rows[c][1] == rows[a][1]][:k]:
            near = [c for c in order if rows[c][1] != rows[a][1] and 80 * score[p] <= 100 * score[c] <= 100 * score[p]]
            out += [(rows[a][0], rows[p][0], r + 1, rows[c][0], score[p], score[c]) for r, c in enumerate(near[:k])]
    return sorted(out)


def mined(spark, rows, every=100):
    df = spark.createDataFrame(rows, "id long, label int, vec array<float>").withColumn("group", F.lit("clash"))
    got = HN.mine(df.repartition(4), F.col("id") % every == 0)
    return sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                               "negative_score").collect())


def clustered(seed, n, copies):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(4, 12))
    v = centre[rng.integers(0, 4, n)] + 0.2 * rng.normal(size=(n, 12))
    v[:copies] = v[0]  # a third of all rows is one vector: ties by id, edges of length 0
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    return [(i, int(x), [float(np.float32(y)) for y in r]) for i, (x, r) in enumerate(zip(rng.integers(0, 3, n), v))]


def test_negatives_against_all_scores(spark, monkeypatch):
    rows = clustered(1, 900, 300)
    rows += [(None, 1, [0.1] * 12), (2000, None, [0.1] * 12), (2100, 1, None), (2200, 1, [0.1, None]),
             (2300, 1, [float("nan")] * 12), (2400, 1, [float("inf")] * 12), (2500, 1, [0.5, 0.5]), (2600, 2, [])]
    assert mined(spark, rows, 20) == brute_negatives(rows, 20)


def test_negatives_in_small_slices_and_sparse_scores(spark):
    """Blocks and slices of few rows, with and without whole products, give the same lists."""
    rows = clustered(2, 400, 100)
    ids, labels = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    vec = np.floor(256 * np.array([r[2] for r in rows])).astype(np.int64)
    at = np.arange(0, 400, 10)
    _, parent, edge = HN.spanning_tree(vec[at])
    tree, group = HN.Tree(vec[at], parent, edge), HN.Group(ids, labels, vec)
    score = vec[at] @ vec.T
    for dense, slice_ in ((2.0, 7), (0.0, 50), (0.05, 4096)):
        HN.DENSE, HN.SLICE, old = dense, slice_, (HN.DENSE, HN.SLICE)
        try:
            best = HN.positives_of(tree, ids[at], labels[at], group, 5)
            low = -(-80 * best.score // 100)
            near = HN.negatives_of(tree, labels[at], low, best.score, group, 5)
        finally:
            HN.DENSE, HN.SLICE = old
        for i, a in enumerate(at):
            same = [c for c in range(400) if labels[c] == labels[a] and c != a]
            assert best.id[i].tolist() == sorted(same, key=lambda c: (-score[i, c], c))[:5]
            for w in range(5):
                s = best.score[i, w]
                want = [c for c in range(400) if labels[c] != labels[a] and 80 * s <= 100 * score[i, c] <= 100 * s]
                want = sorted(want, key=lambda c: (-score[i, c], c))[:5]
                held = near.id[i * 5 + w][near.score[i * 5 + w] != HN.NOTHING].tolist()
                assert held == want


def test_tree_is_minimal():
    rng = np.random.default_rng(7)
    v = rng.integers(-50, 50, size=(40, 3))
    order, parent, edge = HN.spanning_tree(v)
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1))
    assert sorted(order) == list(range(40)) and (parent < 0).sum() == 1
    # Kruskal
    of = list(range(40))
    total = 0.0
    for x, i, j in sorted((d[i, j], i, j) for i in range(40) for j in range(i)):
        if of[i] != of[j]:
            old = of[i]
            of = [of[j] if k == old else k for k in of]
            total += x
    assert edge.sum() == pytest.approx(total)


def test_negatives_large_numbers_and_empty(spark):
    """Products beyond the exact range of floats are taken in integers."""
    rng = np.random.default_rng(3)
    rows = [(i, int(i % 2), [float(np.float32(x)) for x in rng.normal(size=6) * 10.0 ** rng.integers(0, 7)])
            for i in range(200)]
    assert mined(spark, rows, 20) == brute_negatives(rows, 20)
    assert mined(spark, []) == []
    assert mined(spark, [(100, 1, [1.0]), (1, 2, [1.0])]) == []  # no positive


def test_negatives_repeated_ids(spark):
    rows = [(i % 150, int(i % 3), r[2]) for i, r in enumerate(clustered(4, 300, 50))]
    # every id twice: an anchor never serves itself, each anchor row gives its own rows
    assert mined(spark, rows, 50) == brute_negatives(rows, 50)
