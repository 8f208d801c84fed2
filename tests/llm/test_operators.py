"""Training-data operators against brute force, with nulls, empties, ties, repeats and extra columns."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, owner string, id long"


def frame(spark, texts, sources=None):
    rows = [(i, t, "en", (sources or {}).get(i, f"s{i % 3}"), len(t or ""), 0.5, "x", -i) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def sample(seed=0, n=60):
    """Texts with copies, near copies, a shared passage, nulls, empties and one long text."""
    rng = np.random.default_rng(seed)
    word = lambda k: [f"w{rng.integers(0, 400)}" for _ in range(k)]
    passage = word(30)
    out = [(0, None), (1, ""), (2, " \n\t"), (3, "one two"), (4, "one  two")]
    base = word(120)
    for i in range(5, n):
        kind = i % 6
        if kind == 0:
            out.append((i, " ".join(base)))
        elif kind == 1:
            x = list(base)
            for p in rng.integers(0, 120, rng.integers(1, 8)):
                x[p] = f"e{rng.integers(0, 9999)}"
            out.append((i, "  ".join(x)))
        elif kind == 2:
            out.append((i, " ".join(word(25) + passage + word(10))))
        else:
            out.append((i, " ".join(word(int(rng.integers(1, 80))))))
    out.append((n, " ".join(word(9000))))
    return out


# --- exact dedup

def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_exact_dedup_of_many_equal_rows(spark, monkeypatch):
    """A run of copies is flushed by its rows, although its trie stays small."""
    from tripsight.llm import exact_dedup as X
    taken = []
    real = X.PatriciaTrie
    monkeypatch.setattr(X, "RUN_ROWS", 500)
    monkeypatch.setattr(X, "PatriciaTrie", lambda *a, **k: taken.append(1) or real(*a, **k))
    rows = X.pa.RecordBatch.from_pylist([{"doc_id": i, "norm": "", "sha": b"s"} for i in range(2_100)])
    monkeypatch.setattr(X.TaskContext, "get", staticmethod(lambda: type("T", (), {"partitionId": lambda self: 3})()))
    out = [r for b in X._local_owners(1 << 20)([rows]) for r in b.to_pylist()]
    assert len(out) == 2_100 and len({r["block"] for r in out}) == 5
    assert [r["owner_id"] for r in out] == [i // 500 * 500 for i in range(2_100)]
    docs = spark.range(300_000).selectExpr("id as doc_id", "'' as text").coalesce(1)
    got = X.exact_dedup(docs)
    assert got.where("kept").count() == 1 and got.where("group_size = 300000 and keep_id = 0").count() == 300_000


@pytest.mark.parametrize("budget", [1 << 20, 2000])
def test_exact_dedup(spark, budget):
    from tripsight.llm.exact_dedup import exact_dedup
    texts = sample(1) + [(7, sample(1)[7][1])]
    keep, size = {}, defaultdict(int)
    for i, t in texts:
        keep[norm(t)] = min(i, keep.get(norm(t), i))
        size[norm(t)] += 1
    got = sorted(exact_dedup(frame(spark, texts).repartition(3), budget=budget).collect())
    assert got == sorted((i, keep[norm(t)], size[norm(t)], i == keep[norm(t)],
                          hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in texts)


def test_trie_spills_by_subtree():
    from tripsight.llm.exact_dedup import PatriciaTrie
    rng = np.random.default_rng(3)
    keys = [bytes(rng.integers(97, 100, rng.integers(0, 9)).tolist()) for _ in range(4000)]
    keys += [b"common prefix " * 20 + k for k in keys[:500]]
    want = defaultdict(lambda: [1 << 62, 0])
    trie = PatriciaTrie(3000, spill=True)
    for i, k in enumerate(keys):
        trie.insert(k, 5000 - i)
        want[k] = [min(want[k][0], 5000 - i), want[k][1] + 1]
    got = list(trie.items())
    assert len(got) == len(want) and {k: [a, b] for k, a, b in got} == want


# --- near dedup

def test_near_dedup(spark):
    from tripsight.llm.minhash import near_dedup
    texts = sample(2, 90)
    sets = {}
    for i, t in texts:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    comp = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) \
                        and comp[a] != comp[b]:
                    comp[a] = comp[b] = min(comp[a], comp[b])
                    changed = True
    got = sorted(near_dedup(frame(spark, texts)).collect())
    assert got == sorted((i, len(sets[i]), comp[i], i == comp[i]) for i in sets)
    assert sum(not r.kept for r in got) > 10


def test_sequential_bounds():
    from tripsight.llm.minhash import MISS, least_matches
    for n in (32, 128):
        m = least_matches(n)
        x = (np.arange(200_000) + 0.5) / 200_000
        tail = lambda k: (lambda d: d[x >= 0.75].sum() / d.sum())(x ** k * (1 - x) ** (n - k))
        assert tail(m) >= MISS > tail(m - 1)


def test_components_of_a_chain(spark):
    from tripsight.llm.components import components
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 400), (400, 500), (7, 7)], "a long, b long")
    got = {r.id: r.component_id for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 400: 400, 500: 400}


# --- substring dedup

def test_substring_dedup(spark, monkeypatch):
    from tripsight.llm import substring_dedup as S
    texts = sample(4, 80)
    seen, want = set(), []
    for i, t in sorted(texts):
        w = (t or "").split()
        gone = set()
        for j in range(len(w) - 19):
            k = tuple(w[j:j + 20])
            if k in seen:
                gone.update(range(j, j + 20))
            seen.add(k)
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        want.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    for hot in (S.HOT, 1):
        monkeypatch.setattr(S, "HOT", hot)
        monkeypatch.setattr(S, "SHARD_BYTES", 3000)
        got = S.substring_dedup(frame(spark, texts)).select("doc_id", "n_words", "n_removed", "kept_sha").collect()
        assert sorted(map(tuple, got)) == want
    assert sum(x[2] for x in want) > 1000


# --- token counts and packing

SPECIAL = ["a<|endoftext|>b", "<|startoftext|> x", "naïve — 漢字 😀    \x1c end", "don't 'S'll 1234 !!\n\n x"]


def test_token_counts(spark, monkeypatch):
    from tokenizers import Tokenizer
    from tripsight.llm import token_counts as T
    path = public_tokenizers.path("byte_bpe_50k.json")
    tk = Tokenizer.from_file(path)
    texts = sample(5, 40) + list(enumerate(SPECIAL, 200)) + [(200, SPECIAL[0]), (300, "the " * 70_000)]
    monkeypatch.setattr(T, "BLOCK_PAIRS", 500)
    got = sorted(T.count_tokens(frame(spark, texts).repartition(2), path).collect())
    assert got == sorted((i, len((t or "").encode()), len(tk.encode(t or "", add_special_tokens=False).ids))
                         for i, t in texts)


@pytest.mark.parametrize("weights", [None, {"s0": 0.5, "s1": 0.4}])
def test_packing(spark, weights):
    from tokenizers import Tokenizer
    from tripsight.llm.packing import pack, piece_digests
    path = public_tokenizers.path("word_bpe_49k.json")
    tk = Tokenizer.from_file(path)
    texts = dict(sample(6, 50) + list(enumerate(SPECIAL, 200)))
    pieces = piece_digests(pack(frame(spark, texts.items(), {5: None}).repartition(3), path, weights=weights)).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append((p.offset, p.length))
    assert set(by_doc) == set(texts)
    for i, t in texts.items():
        ids = np.array(tk.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4")
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    ends = []
    for s in sorted(by_seq):
        at = 0
        for off, length in sorted(by_seq[s]):
            assert off == at
            at += length
        ends.append(at)
    assert ends[:-1] == [2048] * (len(ends) - 1) and ends[-1] <= 2048


def test_mixture_holds_in_every_window():
    from tripsight.llm.packing import Placer, schedule
    granules = np.array([4000, 1000, 3000, 37])
    placer = Placer(granules, schedule(granules, granules, 32))
    owner = np.full(granules.sum(), -1)
    for q, n in enumerate(granules):
        owner[placer.place(q, np.arange(n))] = q
    assert (owner >= 0).all()
    for w in range(0, len(owner) - 64, 32):
        share = np.bincount(owner[w:w + 32], minlength=4)
        assert (abs(share - 32 * granules / granules.sum()) < 3).all()  # one carried granule, and the edge's shift


# --- classifiers

def heldout(rows, labels, column, mod, fold):
    lab = {r.doc_id: r[column] for r in labels}
    h = [(lab[r.doc_id], r.score) for r in rows if r.held_out and r.doc_id in lab]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % mod == fold) for r in rows)
    return sum((s >= 0.5) == (y > 0) for y, s in h) / len(h)


def test_quality_and_toxicity_on_held_out_rows(spark):
    from tripsight.llm.queries import op5_toxicity_lexicon, op6_quality_fm
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    assert heldout(op6_quality_fm(spark, sf).collect(), labels, "quality", 4, 2) >= 0.95
    assert heldout(op5_toxicity_lexicon(spark, sf).collect(), labels, "toxic", 5, 0) >= 0.9


def test_classifiers_without_labels_and_with_odd_rows(spark):
    from tripsight.llm.quality import score_quality, train_quality
    from tripsight.llm.toxicity import score_toxicity, train_toxicity
    docs = frame(spark, sample(7, 20) + [(3, "one two"), (99, "You are an 1d10t and a m0r0n, you lоser!")])
    none = spark.createDataFrame([(1, None, None)], "doc_id long, quality int, toxic int")
    q = score_quality(docs, train_quality(docs, none), ["doc_id", "score"]).collect()
    assert len(q) == 23 and len({r._quality_score for r in q}) == 1
    t = {r.doc_id: r for r in score_toxicity(docs, train_toxicity(docs, none), ["doc_id"]).collect()}
    assert t[99]._toxicity > 0.5 > t[1]._toxicity == t[0]._toxicity and t[99]._toxic_words == 3


def test_folding_and_exceptions():
    from tripsight.llm.toxicity import EXCEPTIONS, SEED_WORDS, Lexicon, fold, measure
    assert fold("1d10t ѕcum s.t.u.p.i.d, l o s e r THE!! 2024 of%%%") == " idiot scum stupid loser the of "
    lex = Lexicon({w: 3.0 for w in SEED_WORDS}, EXCEPTIONS)
    assert measure(fold("Put it in the trash can."), lex)[0] == 0
    assert measure(fold("trash, you trash"), lex)[0] == 2


def test_factorisation_machine_identity():
    from tripsight.llm.quality import BUCKETS, Machine, STATS, features
    rng = np.random.default_rng(0)
    k = len(STATS)
    fm = Machine(0.3, rng.normal(size=k + BUCKETS), rng.normal(size=(k + BUCKETS, 3)), np.zeros(k), np.ones(k))
    x = features(["a b c a", "", "x y z and more words"])
    full = np.zeros((3, k + BUCKETS))
    full[:, :k] = np.clip(x.stats, -6, 6)
    full[x.row, k + x.idx] = x.val
    for r, got in zip(full, fm.raw(x)):
        at = np.flatnonzero(r)
        pairs = sum(fm.v[i] @ fm.v[j] * r[i] * r[j] for n, i in enumerate(at) for j in at[n + 1:])
        assert got == pytest.approx(0.3 + fm.w @ r + pairs)


# --- decontamination

def test_alignment_against_the_full_table():
    from tripsight.llm.decontamination import align
    rng = np.random.default_rng(0)
    for _ in range(60):
        a, g = rng.integers(0, 5, rng.integers(1, 12)), rng.integers(-1, 5, (3, rng.integers(1, 20)))
        for row, got in zip(g, align(a, g)[0]):
            h = np.zeros((len(a) + 1, len(row) + 1), int)
            for i in range(1, len(a) + 1):
                for j in range(1, len(row) + 1):
                    h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == row[j - 1] else -1), h[i - 1, j] - 1,
                                  h[i, j - 1] - 1)
            assert h.max() == got


def test_contamination(spark):
    from tripsight.llm.decontamination import contamination
    rng = np.random.default_rng(8)
    word = lambda k: [f"w{rng.integers(0, 900)}" for _ in range(k)]
    items = [word(30), word(45), ["only", "two"], []]
    edited = list(items[1])
    for p in (5, 17, 30):
        edited[p] = "changed"
    del edited[22]
    texts = [(0, None), (1, ""), (2, " ".join(word(300))), (3, " ".join(word(50) + items[0] + word(50))),
             (4, "X, " + " ".join(word(20) + edited + word(9))), (5, " ".join(items[0][:6] + word(40))),
             (6, "so Only; two here"), (7, " ".join(word(5000) + items[0] + word(4000))), (3, " ".join(items[0]))]
    bench = spark.createDataFrame([(i, " ".join(w), "e") for i, w in enumerate(items)] + [(9, None, "e")],
                                  "item_id long, text string, source string")
    got = contamination(frame(spark, texts), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(3, 0), (7, 0), (4, 1), (6, 2)}
    assert contamination(frame(spark, []), bench).count() == 0
    assert contamination(frame(spark, texts), bench.limit(0)).count() == 0


@pytest.mark.parametrize("verbatim", [1, 5])
def test_contamination_of_a_frequent_edited_copy(spark, verbatim):
    from tripsight.llm.decontamination import contamination
    rng = np.random.default_rng(9)
    word = lambda k: [f"w{rng.integers(0, 900)}" for _ in range(k)]
    item = [f"t{i}" for i in range(37)]
    edited = ["changed" if i % 5 == 4 else w for i, w in enumerate(item)]
    texts = [(i, " ".join(word(20) + edited + word(20))) for i in range(30)]  # 7 of 34 seeds, score 53/74
    texts += [(100 + i, " ".join(word(20) + item + word(20))) for i in range(verbatim)]
    texts += [(200 + i, " ".join(word(20) + edited[:4] + word(20))) for i in range(30)]
    # a verbatim seed at one place and the edited copy at another, in a longer text
    texts += [(300, " ".join(item[7:13] + word(400) + edited + word(90)))]
    bench = spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: r.score for r in contamination(frame(spark, texts), bench).collect()}
    assert set(got) == {*range(30), *range(100, 100 + verbatim), 300}
    assert {round(got[i] * 74) for i in (*range(30), 300)} == {53}


def test_bound_on_matches():
    from tripsight.llm.decontamination import align, most_matches
    rng = np.random.default_rng(1)
    for _ in range(60):
        a, g = rng.integers(0, 6, rng.integers(1, 12)), rng.integers(-1, 6, (4, rng.integers(1, 20)))
        a = np.unique(a, return_inverse=True)[1]
        g = np.where(g > a.max(), -1, g)
        score, hits, _ = align(a, g)
        most = most_matches(a, g)
        assert (hits <= most).all() and (score <= 2 * most).all()


# --- html

@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("<p></p>", ""), ("plain  &amp;\n text", "plain & text"),
    ("<html><body><nav><a href=1>Home</a></nav><article><h1>T &lt;1&gt;</h1><p>One <b>two<br>three<p>Four</article>"
     "<footer>f</footer>", "T <1>\n\nOne two three\n\nFour"),
    ("<body><div class='ad'>Buy</div><main><div><p>First part, long enough.</p></div><div><p>Second part.</p></div>"
     "<section id=comments><p>Nice article, thank you very much for it.</p></section></main><script>var t='</p>'"
     "</script></body>", "First part, long enough.\n\nSecond part."),
    ("<nav><ul><li><a href=1>x</a><article><p>Menu left open</p></article>", "Menu left open"),
    ("<body><article><p>Body text</p><aside>side</aside><form><p>mail</p></form><!-- note --></article></body>",
     "Body text")])
def test_html(html, text):
    from tripsight.llm.html_extract import extract_text
    assert extract_text(html) == text


PARAGRAPHS = [f"Paragraph {i} tells at some length how the harbour of the small town was rebuilt after the storm, who paid "
              f"for the stones and why the work took {i + 3} years." for i in range(5)]
STORY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)


@pytest.mark.parametrize("html,text", [
    ("<body><div class='banner'>Buy two, get one</div><article><h1>T</h1>%s</article><div class='legal'>All rights "
     "reserved</div><div class='tags'>sea harbour storm</div></body>", ["T", *PARAGRAPHS]),
    ("<body><div id='wrap'><div class='banner'>Buy two</div><h1>Title</h1><div class='c1'>%s</div><div class='c2'><p>"
     + PARAGRAPHS[0] * 2 + "</p></div>Printed on paper<div class='x9'><p>Call us</p><p>Visit us</p></div></div></body>",
     ["Title", *PARAGRAPHS, PARAGRAPHS[0] * 2]),
    ("<body><app-root><div class='strip'>Hot deals</div><app-page><section>%s</section></app-page></app-root></body>",
     PARAGRAPHS),
    ("<body><article><div class='lead'><p>Short lead.</p></div><div>%s</div><p>End.</p></article></body>",
     ["Short lead.", *PARAGRAPHS, "End."]),
    ("<body><p>Hi</p></body><div>%s</div>", PARAGRAPHS)])
def test_html_of_unlisted_classes(html, text):
    from tripsight.llm.html_extract import extract_text
    assert extract_text(html % STORY) == "\n\n".join(text)


@pytest.mark.parametrize("html", [
    "<body><div class='content has-sidebar'>%s<div class='sidebar'><p>Side note</p></div></div></body>",
    "<body><div id='page' class='no-sidebar'><div class='nav'><p>Go</p></div><article>%s</article></div></body>",
    "<body><article class='post comments-open'>%s<section class='comments'><p>Nice.</p></section></article></body>",
    "<body><main class='nav-fixed'>%s</main><div class='cookie'>We use them</div></body>",
    "<body><form id='aspnet'><div class='menu'>Menu</div><div>%s</div><form><p>Mail</p></form></form></body>",
    "<body><div role='dialog' class='ad-free'>%s</div></body>",
    "<body><div class='no-sidebar'><article>%s</article></div><div>" + "<p>Short line here.</p>" * 60 + "</div></body>",
    "<body><article>%s<article class='comment'><p>Well said.</p></article></article></body>"])
def test_html_of_wrappers(html):
    from tripsight.llm.html_extract import extract_text
    assert extract_text(html % STORY).split("\n\n")[:5] == PARAGRAPHS
    assert not re.search("Side note|Go$|Nice|We use|Menu|Mail|Well said", extract_text(html % STORY))


def test_html_of_nothing_but_doubt():
    from tripsight.llm.html_extract import extract_text
    parts = [f"<div class='content sidebar-{i}'><p>{p}</p></div>" for i, p in enumerate(PARAGRAPHS[:2])]
    assert extract_text(f"<body>{''.join(parts)}</body>") == "\n\n".join(PARAGRAPHS[:2])


def test_html_of_all_pages(spark):
    import html as H
    from tripsight.llm.queries import op10_text_density
    got = {r.page_id: r for r in op10_text_density(spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        main = re.search(r"<article>(.*?)(</article>|<footer>)", p.html, re.S)[1].replace("<br>", " ")
        blocks = (" ".join(H.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:h1|p)>", main))
        want = "\n\n".join(b for b in blocks if b)
        assert got[p.page_id].text == want and got[p.page_id].n_chars == len(want)


# --- licences

def test_licenses(spark):
    from tripsight.llm.licenses import scan_licenses, train_licenses
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    clf = train_licenses(docs)
    texts = [(0, None), (1, ""), (2, "Some text.\nLicensed under the Apache License, Version 2.0.\nMore."),
             (3, "Released under the MIT License."), (3, "Released under the MIT License."),
             (4, "He lost his driver's license on the way to work."), (5, "x\n\nAll rights reserved.")]
    got = sorted((r.doc_id, r.n_paragraphs, r.license) for r in scan_licenses(frame(spark, texts), clf).collect())
    assert got == [(0, 0, "none"), (1, 0, "none"), (2, 3, "apache-2.0"), (3, 1, "mit"), (3, 1, "mit"), (4, 1, "none"),
                   (5, 2, "proprietary")]


BROKEN = ["<![foo[ bar ]]><p>a</p>", "<![ x", "<p>a</p><!", "<p>a</p><!-- b", "<p>a</p><b", "<p>a</p></", "<", "</", "<!-", "&#x;",
          "<a href=\"", "<p a='>b", "<?", "<?x <p>a</p>", "<![CDATA[ x <p>a</p>", "<!DOCTYPE [ <!ELEMENT ", "<\x00", "&#99999999;"]


def test_broken_markup_never_stops(spark):
    """Random cuts and marks in pages, and as one Spark job with the known broken ones."""
    import random
    from tripsight.llm.html_extract import extract_pages, extract_text
    pages = [r.html or "" for r in spark.read.parquet(f"{SF}/pages.parquet").limit(60).collect()]
    rng = random.Random(8)
    marks = ["<", ">", '"', "<![foo[", "<!--", "]]>", "</p>", "<div>", "&", "<script>", "<![", "\x00", "<article>", "</b>"]
    cut = list(BROKEN)
    for _ in range(400):
        h = rng.choice(pages)
        for _ in range(rng.randint(1, 8)):
            i = rng.randrange(len(h) + 1)
            h = h[:i] + (rng.choice(marks) if rng.random() < 0.6 else "") + h[i + rng.randint(0, 30):]
        cut.append(h)
    for h in cut:
        assert isinstance(extract_text(h), str)
    df = spark.createDataFrame([(i, None, h) for i, h in enumerate(cut)], "page_id long, url string, html string")
    assert extract_pages(df).count() == len(cut)
    assert extract_text("<p>before</p><!-- open <p>after</p>").startswith("before")


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "x", "<b>" * 100_000 + "x" + "</a>" * 100_000,
                                  "<section>" + "<i>" * 20_000 + "<p>x</p>" * 20_000 + "</section>" * 20_000,
                                  "<!--x>" * 100_000 + "x", "<a " * 50_000, "<a><div>" + "<b>" * 50_000 + "</a>" * 50_000],
                         ids=["divs", "inline", "mixed", "comments", "open tag", "unmatched"])
def test_deep_and_broken_pages_take_linear_time(page):
    import time
    from tripsight.llm.html_extract import extract_text
    began = time.process_time()
    extract_text(page)
    assert time.process_time() - began < 20


# --- empty tables, oracles, pipeline

def test_empty_tables(spark):
    from tripsight.llm import exact_dedup, html_extract, minhash, packing, substring_dedup, token_counts
    none = frame(spark, [])
    assert exact_dedup.exact_dedup(none).count() == 0
    assert minhash.near_dedup(none).count() == 0
    assert substring_dedup.substring_dedup(none).count() == 0
    assert token_counts.count_tokens(none, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
    assert packing.pack(none, public_tokenizers.path("word_bpe_49k.json")).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_extract.extract_pages(pages).count() == 0


@pytest.mark.parametrize("name", ["op2_minhash_bayes", "op4_phrase_automata", "op7_patricia_dedup"])
def test_oracles(spark, name):
    import duckdb
    from tripsight.llm.oracle import SQL
    from tripsight.llm.queries import QUERIES
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(SQL[name]).df().sort_values("doc_id").reset_index(drop=True)
    got = QUERIES[name](spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)[list(want.columns)]
    assert (got.astype(str) == want.astype(str)).all().all()


def test_pipeline(spark):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        assert docs.columns == P.COLUMNS and after <= before and len(after) > 0.5 * len(before)
        before = after
    texts = [norm(r.text) for r in docs.collect()]
    assert len(set(texts)) == len(texts)
    got = P.run(spark, SF).select("doc_id", F.lit(1)).distinct().collect()
    assert {r.doc_id for r in got} == before


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    """Each filtering stage on its own input: what stays, by comparing all texts with each other."""
    import shutil
    import corpus_pipeline as P
    from tripsight.llm.decontamination import contamination
    for name in ("labels", "benchmark"):
        shutil.copy(f"{SF}/{name}.parquet", tmp_path)
    spark.read.parquet(f"{SF}/documents.parquet").withColumns(  # clashing names
        {"_row": F.lit("x"), "id": F.lit(1), "_file": F.lit(2.0), "group": F.lit(None).cast("int"), "_maybe": F.lit(True)}
    ).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    first: dict[str, int] = {}
    for i in sorted(rows):
        first.setdefault(norm(rows[i]), i)
    assert sorted(r.doc_id for r in P.exact(spark, docs, str(tmp_path)).collect()) == sorted(first.values())
    sets = {}
    for i, t in rows.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(rows)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    got = sorted(r.doc_id for r in P.near(spark, docs, str(tmp_path)).collect())
    assert got == [i for i in ids if find(i) == i]
    bad = {r.doc_id for r in contamination(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    got = sorted(r.doc_id for r in P.decontaminate(spark, docs, str(tmp_path)).collect())
    assert bad and got == [i for i in ids if i not in bad]


def test_pipeline_deletes_what_is_no_longer_needed(spark, tmp_path):
    import corpus_pipeline as P
    from tripsight.llm.common import handovers
    before = len(handovers(spark))
    n = P.run(spark, SF).count()
    left = len(handovers(spark)) - before
    assert n > 0 and left < 12  # the last stages' tables


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import shutil
    import corpus_pipeline as P
    for name in ("labels", "benchmark"):
        shutil.copy(f"{SF}/{name}.parquet", tmp_path)
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_pipeline_of_null_and_repeated_ids(spark, tmp_path):
    import shutil
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*P.COLUMNS)
    item = max((r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()), key=lambda t: len(t.split()))
    rows = docs.where("n_chars between 800 and 3000").dropDuplicates(["text"]).orderBy("doc_id").limit(60).collect()
    texts = [(10 ** 9 + k, " ".join(r.text.split()[::-1] + [item] * (k % 2))) for k, r in enumerate(rows)]  # new texts
    put = lambda some: docs.unionByName(
        spark.createDataFrame([(i, t, "en", "s0", len(t)) for i, t in some], docs.schema))
    good = {r.doc_id: r.text for r in P.quality(spark, put(texts), SF).where("doc_id >= 1000000000").collect()}
    a, b, c, d = [t for i, t in sorted(good.items()) if i % 2 == 0][:4]
    leak, leak2 = [t for i, t in sorted(good.items()) if i % 2][:2]
    odd = [(None, a), (None, a), (10 ** 9 + 2, a), (None, b), (None, b + " afterword"), (None, b), (None, leak),
           (10 ** 9 + 1, c), (10 ** 9 + 1, c), (10 ** 9 + 1, d), (10 ** 9 + 1, leak2), (10 ** 9 + 1, c.replace(" ", "  "))]
    for name in ("labels", "benchmark"):
        shutil.copy(f"{SF}/{name}.parquet", tmp_path)
    put(odd).write.parquet(f"{tmp_path}/documents.parquet")
    new = F.col("doc_id").isNull() | (F.col("doc_id") >= 10 ** 9)
    kept = P.read_table(spark, str(tmp_path), "documents")
    for _, stage in P.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path)).cache()
    got = sorted((str(r.doc_id), " ".join(r.text.split()).replace(" afterword", "")) for r in kept.where(new).collect())
    assert got == sorted([("1000000002", a), ("None", b), ("1000000001", c), ("1000000001", d)])
    first = P.run(spark, str(tmp_path)).where("start = 0")
    assert first.count() == kept.count()
    count = {r.doc_id: r["count"] for r in first.where(new).groupBy("doc_id").count().collect()}
    assert count == {None: 1, 10 ** 9 + 1: 2, 10 ** 9 + 2: 1}


def test_pipeline_stages_bound_the_bytes_of_a_python_batch(spark):
    import corpus_pipeline as P
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    docs = spark.createDataFrame([(1, "Some words.", "en", "a", 11)], "doc_id long, text string, lang string, source string, n_chars long")
    P.packing(spark, docs, "")
    big = spark.range(300, numPartitions=1).select(F.repeat(F.lit("x"), 100_000).alias("text"))

    def sizes(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})

    try:
        got = [r.n for r in big.mapInArrow(sizes, "n long").collect()]
    finally:
        spark.conf.unset(key)
    assert sum(got) > 300 * 100_000 and max(got) <= P.BATCH_BYTES + 200_000


_AFTER_A_TASK = """
import re, sys
import numpy as np, pyarrow as pa
from tripsight.llm import decontamination, exact_dedup

def held():
    return int(re.search(r"RssAnon:\\s+(\\d+)", open("/proc/self/status").read())[1]) >> 10

def texts():
    rng = np.random.default_rng(1)
    for lo in range(0, 10_000, 1000):
        norm = [" ".join(map(str, rng.integers(0, 1 << 40, 250))) for _ in range(1000)]
        ids = list(range(lo, lo + 1000))
        yield pa.RecordBatch.from_pydict({"doc_id": ids, "norm": norm, "text": norm, "sha": [b"%032d" % i for i in ids]})

exact_dedup.TaskContext = type("Task", (), {"get": staticmethod(lambda: type("T", (), {"partitionId": lambda s: 0})())})
step = {"owners": exact_dedup._local_owners(exact_dedup.TRIE_BYTES),
        "scan": decontamination._scan_with(np.full(decontamination.FILTER_BITS // 64, -1), [10])}[sys.argv[1]]
rows = list(texts())
for _ in step(iter(rows[:1])):
    pass
before = held()
n = sum(b.num_rows for b in step(iter(rows)))
print(n, held() - before)
"""


@pytest.mark.parametrize("step", ["owners", "scan"])
def test_python_steps_of_the_pipeline_give_their_memory_back(step):
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    got = subprocess.run([sys.executable, "-c", _AFTER_A_TASK, step], env=os.environ | {"PYTHONPATH": root}, check=True,
                         capture_output=True, text=True, timeout=300).stdout.split()
    assert int(got[0]) >= 10_000 and int(got[1]) < 20  # MB


def test_quality_stage_does_not_depend_on_batches(spark, monkeypatch):
    import corpus_pipeline as P
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = []
    for size in (1 << 14, 64 << 20):
        monkeypatch.setattr(P, "BATCH_BYTES", size)
        kept.append(sorted(r.doc_id for r in P.quality(spark, docs, "/root/testdata/sf0.01").collect()))
    spark.conf.unset(key)
    assert kept[0] == kept[1] and kept[0]


def test_license_training_counts_every_ordinary_paragraph(spark):
    from tripsight.llm.licenses import ordinary_counts
    texts = [(i, f"The general plan x{i}\n\nsome free words\nNo license here") for i in range(6000)]
    got = {}
    for r in ordinary_counts(frame(spark, texts)).collect():
        got[tuple(r.grams)] = got.get(tuple(r.grams), 0) + r.n
    # two lines of a document are ordinary, the last has a cue; only words of notices are kept
    assert sum(got.values()) == 12_000 and len(got) == 2
    assert {k for k in got if "plan" in k} == {("general", "plan", "the", "the general")}


def test_license_grams_are_those_of_the_words(spark):
    from tripsight.llm import licenses as N
    rows = spark.createDataFrame(N._known_rows(), "paragraph string, label double").select(
        N.words_col(F.col("paragraph")).alias("w"))
    words = [r.w for r in rows.collect()]
    assert sorted({g for w in words for g in [*w, *map(" ".join, zip(w, w[1:]))]}) == N.GRAMS
    got = [r.g for r in rows.select(N.grams_col(F.col("w")).alias("g")).collect()]
    assert got == [sorted({*w, *map(" ".join, zip(w, w[1:]))}) for w in words]
    odd = spark.createDataFrame([([],), (["zzz"],), (["zzz", "the", "zzz"],)], "w array<string>")
    assert [r.g for r in odd.select(N.grams_col(F.col("w")).alias("g")).collect()] == [[], [], ["the"]]


def test_license_threshold_counts_all_held_back(spark):
    from tripsight.llm.licenses import ALPHA, FLOOR, _threshold
    rows = [(0.01, 10_000), (0.7, 9), (0.9, 3), (0.99, 2)]
    got = _threshold(spark.createDataFrame(rows, "p double, n long"))
    above = sum(n for p, n in rows if p > got)
    assert above <= ALPHA * sum(n for _, n in rows) and 0.7 <= got < 0.71
    assert _threshold(spark.createDataFrame([], "p double, n long")) == 0.0 < FLOOR
    assert _threshold(spark.createDataFrame([(1.0, 5)], "p double, n long")) == pytest.approx(1.0)
