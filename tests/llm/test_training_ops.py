"""Each operator on small tables with nulls, empty and long texts, ties, repeats and clashing columns, by brute force."""

import hashlib
import math
import random
import struct
import time
import tracemalloc
import zlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pytest
import public_tokenizers
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from martmill.llm import html, jaccard, langid, mix, mixlm, pack, shard, syncmers, topk
from martmill.llm.components import components
from martmill.llm.queries import op2_html_extraction
from martmill.llm.ship import shipped

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(6000))
NEAR = [f"alpha{i}" for i in range(60)]
ROWS = [
    (1, "The cat sat on the mat and the dog ran away from it", "en", "a"), (2, None, "en", "a"), (3, "", None, None), (4, "  \t\n ", "de", None), (5, "Hund und Katze und der Mann", "de", "b"),
    (6, "The cat sat on the mat and the dog ran away from it", "en", "a"), (7, LONG, "en", "c"), (8, " ".join(NEAR), "en", "c"), (9, " ".join([*NEAR[:58], "x", "y"]), "en", "c"), (10, "7 8 9 !!", "en", "b"),
    (None, "ein kleiner Hund lief", "de", "b"), (None, None, None, None), (5, "Hund und Katze und der Mann", "de", "b"), (12, "É à ß 漢字テスト 😀 ok", None, "b"), (13, "one two", "en", "a"), (14, "One TWO", "en", "a"),
]


def documents(spark, rows=ROWS):
    spark = shipped(spark)
    return spark.createDataFrame([(*r, r[0], "t", i, 0.5, 3) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, shard string, size long, score double, h int").repartition(3)


def words(text):
    return (text or "").encode().lower().split()


def test_top_k(spark):
    r = random.Random(3)
    rows = [(i, [r.choice([-0.5, 0.0, 0.25, 0.3]) for _ in range(6)]) for i in range(140)] + [(150, None), (200, [1.0, None]), (201, [float("nan")]), (202, [float("inf"), 1.0]), (250, []), (300, [0.1]), (77, [0.25] * 6), (None, [1.0])]
    df = shipped(spark).createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, score int, uid int")
    vectors = topk.integer_vectors(df, "vec_id", "embedding")
    got = sorted(map(tuple, topk.top_k(vectors.where("id % 50 = 0"), vectors, block=2, tile=16, width=2).collect()))
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, a in kept:
        if q % 50 == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in kept if c != q)[:5]
            want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(found)]
    assert got == sorted(want)
    assert topk.top_k(vectors.where("id < 0"), vectors).count() == 0


def test_top_k_beyond_32_bits():
    a = np.array([[2**31, -3], [2**40, 5]])
    assert topk.accumulate(a[:, :], a).tolist() == [[2**62 + 9, 2**63 - 1], [2**63 - 1, 2**63 - 1]]


def test_html_blocks():
    page = "<!DOCTYPE html><title>T</title><nav><ul><li><a href='x'>Menu</a></ul></nav><article><h1>A &amp; B</h1><p>One  <b>two</b><br>three<p>Four < five<script>var t='</p>';</script></article><footer>F"
    assert [b.text for b in html.blocks(page)] == ["Menu", "A & B", "One two three", "Four < five", "F"]
    assert html.blocks("") == [] and html.blocks("<p") == [] and [b.text for b in html.blocks("x<!-- y")] == ["x"]
    assert [b.text for b in html.blocks("<div>" * 3000 + "deep")] == ["deep"]


def test_html_labels_and_gradients(spark):
    texts = [" ".join(f"w{(i * j) % 97}" for j in range(60)) for i in range(1, 30)]
    net = html.train(texts, layouts=500, epochs=3)
    r, right, total = random.Random(77), 0, 0
    for _ in range(120):
        page, labels = html.layout(r, texts)
        found = html.label(net, [html.blocks(page)])[0]
        assert len(found) == len(labels)
        right, total = right + int((found == np.array(labels, bool)).sum()), total + len(labels)
    assert right / total > 0.93  # layouts not seen in training
    df = shipped(spark).createDataFrame([(1, "u", "<body><nav><a>M</a></nav><article><h1>T</h1><p>Some words of a text.</article>", "x"), (2, None, None, "x"), (None, "v", "", "x"), (2, None, None, "x")], "page_id long, url string, html string, text string")
    rows = sorted(map(tuple, html.extract(df, net).collect()), key=repr)
    assert rows == sorted([(1, "u", "T\nSome words of a text.", 23), (2, None, "", 0), (2, None, "", 0), (None, "v", "", 0)], key=repr)
    small = html.initial()
    args = html._padded([html.features(html.blocks(html.layout(r, texts)[0])) for _ in range(2)])
    labels = (np.arange(args[3].size).reshape(args[3].shape) % 2).astype(np.float32)
    grad = html.gradients(small, *args, labels)

    def loss(net):
        p, _ = html.forward(net, *args)
        return -float((args[3] * (labels * np.log(p) + (1 - labels) * np.log(1 - p))).sum() / args[3].sum())

    for name, at in (("re_f", (3, 7)), ("in_b", (2, 20)), ("bias", (5,))):
        moved = {k: v.astype(np.float64) for k, v in small.items()}
        moved[name][at] += 1e-3
        up = loss(moved)
        moved[name][at] -= 2e-3
        assert (up - loss(moved)) / 2e-3 == pytest.approx(float(grad[name][at]), abs=2e-3)


def test_html_below_many_ancestors():
    for n in (1, 17, 40, 3000):
        for above in ("article", "aside"):
            block, nest = html.blocks(f"<body><{above} class='story'>" + "<div>" * n + "<p>Some words.")[0], "<div>" * n
            assert set(html._path_ids(above, " class='story'")) <= {int(i) for i in np.flatnonzero(html.features([block])[0][0])}, (above, nest[:20])
    texts = [" ".join(f"w{(i * j) % 97}" for j in range(60)) for i in range(1, 30)]
    net, r, right, total = html.train(texts, layouts=700, epochs=3), random.Random(78), 0, 0
    for _ in range(150):
        n, parts, labels = r.randint(20, 40), [], []
        for opened, label in r.sample([("<article>", 1), ("<aside class='sidebar'>", 0), ("<section class='comments'>", 0), ("<div class='advert'>", 0)], 4):
            k = r.randint(1, 4)
            parts.append(opened + "<div>" * n + "".join(f"<p>{' '.join(r.choice(texts).split()[: r.randint(5, 40)])}</p>" for _ in range(k)) + "</div>" * n + html._close(opened))
            labels += [label] * k
        found = html.label(net, [html.blocks("<html><body>" + "".join(parts))])[0]
        right, total = right + int((found == np.array(labels, bool)).sum()), total + len(labels)
    assert right / total > 0.93


def test_long_and_deep_pages():
    net, r = html.initial(), random.Random(8)
    whole = [html.blocks(html.layout(r, [LONG])[0]) for _ in range(5)]
    by_slices = html.label(net, whole, block=7)
    p, _ = html.forward(net, *html._padded([html.features(page) for page in whole]))
    for i, page in enumerate(whole):  # blocks too close to the bound for another order of summing are left out
        sure = np.abs(p[: len(page), i] - 0.5) > 1e-5
        assert (by_slices[i] == (p[: len(page), i] > 0.5))[sure].all() and sure.any()
    page = html.blocks("<body><article>" + "<p>one two three" * 60_000)
    tracemalloc.start()
    assert len(html.label(net, [page])[0]) == len(page) == 60_000
    assert tracemalloc.get_traced_memory()[1] < 200e6
    tracemalloc.stop()
    for opened in ("<h1>", "<table><tr><td><p>", "<div>"):  # each time twice as deep: about twice, not four times as long
        took = []
        for n in (8000, 32000):
            start = time.process_time()
            assert len(html.blocks("<p><button>" + f"{opened}x" * n)) == n
            took.append(time.process_time() - start)
        assert took[1] < 9 * took[0] + 0.2


class ArticleReader(HTMLParser):
    """The lines of a page's article element, by the standard library's reader and the element's own tags."""

    def __init__(self):
        super().__init__()
        self.inside, self.lines = False, []

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.inside = True
        if tag == "br":
            self.handle_data(" ")
        elif tag != "b":
            self.lines.append("")

    def handle_endtag(self, tag):
        if tag == "article":
            self.inside = False
        if tag != "b":
            self.lines.append("")

    def handle_data(self, data):
        if self.inside:
            self.lines[-1] += data


def test_given_pages_give_their_articles(spark):
    root = "/root/testdata/sf0.1"
    got = {r["page_id"]: r for r in op2_html_extraction(spark, root).collect()}
    pages = spark.read.parquet(f"{root}/pages.parquet").collect()
    assert len(got) == len(pages) > 2000
    for page in pages:
        reader = ArticleReader()
        reader.feed(page["html"] or "")
        reader.close()
        expected = "\n".join(x for x in (" ".join(line.split()) for line in reader.lines) if x)
        assert (got[page["page_id"]]["text"], got[page["page_id"]]["n_chars"]) == (expected, len(expected))


def test_shards(spark):
    rows = [tuple(r) for r in shard.shard_rows(documents(spark, ROWS * 20 + [(i, "x", "en", "a") for i in range(3000)])).collect()]
    assert len(rows) == 20 * len(ROWS) + 3000
    by = {}
    for doc_id, size, crc, law, s, slot, more in rows:
        assert law == "key" and 0 <= s < 24 and more in (s, 24)
        by.setdefault(s, []).append(slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert sorted(Counter(r[:3] for r in rows).items(), key=repr) == sorted(Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in ROWS * 20 + [(i, "x") for i in range(3000)]).items(), key=repr)
    moved = sum(r[6] == 24 for r in rows if r[0] is not None and r[2] == zlib.crc32(b"x"))
    assert 60 < moved < 190  # about one in 25
    assert shard.shard_rows(documents(spark, ROWS[:0])).count() == 0

    def drawn(doc_id, node):  # a node's draw by hand, and its shard
        name, weight, below = node
        if not isinstance(below, int):
            return max(drawn(doc_id, child) for child in below)
        # a long is hashed as 8 bytes, then the name with that hash as its seed
        first = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), seed=42)
        h = xxhash.xxh64_intdigest(name.encode(), seed=first)
        return math.log(((h >> 12) + 0.5) / 2**52) / weight, below

    tree = shard.balanced_tree()
    some = {r[0]: (r[4], r[6]) for r in rows if r[0] is not None and r[0] < 60}
    assert {d: tuple(max(drawn(d, node) for node in shard.balanced_tree(n))[1] for n in (24, 25)) for d in some} == some
    assert [len(region[2]) for region in tree] == [2, 2, 2] and all(rack[1] == 4.0 for region in tree for rack in region[2])


def test_shards_grow_alike_at_every_number(spark):
    ids = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    placed = ids.select(*[shard.descend(F.col("doc_id"), shard.balanced_tree(n)).alias(f"s{n}") for n in range(1, 52)]).collect()
    for n in range(1, 51):
        assert all(r[f"s{n + 1}"] in (r[f"s{n}"], n) for r in placed)
        counts = Counter(r[f"s{n + 1}"] for r in placed)
        assert len(counts) == n + 1 and max(abs(c - 6000 / (n + 1)) for c in counts.values()) < 6 * (6000 / (n + 1)) ** 0.5
    for n in (1, 5, 23, 24):
        now = {r["doc_id"]: r["grown_shard"] for r in shard.shard_rows(ids, shards=n).collect()}
        assert now == {r["doc_id"]: r["shard"] for r in shard.shard_rows(ids, shards=n + 1).collect()}


def test_a_changed_weight_moves_rows_in_its_subtree_only(spark):
    tree = shard.balanced_tree()
    heavier = [(name, weight * (3 if name == "region1" else 1), below) for name, weight, below in tree]
    at = lambda t: shard.descend(F.col("id"), t)
    got = spark.range(20000).select(at(tree).alias("a"), at(heavier).alias("b")).collect()
    inside = lambda s: s % 3 == 1
    assert all(r["a"] == r["b"] or (inside(r["b"]) and not inside(r["a"])) for r in got)
    assert abs(sum(inside(r["b"]) for r in got) - 20000 * 0.6) < 400


def test_languages(spark):
    r = random.Random(5)
    vocabulary = {"xx": "the of and that with have from they which their".split(), "yy": "der die und nicht werden sich auch nach haben".split()}
    rows = [(i, " ".join(r.choice(vocabulary[l]) for _ in range(r.randint(5, 40))), l, "s") for i in range(120) for l in ("xx", "yy")]
    langs, vectors = langid.prototypes(documents(spark, rows[:160] + [(900, None, "yy", "s"), (901, "text", None, "s")]))
    assert langs == ["xx", "yy"]
    brute = np.zeros(langid.DIM)
    for _, text, lang, _ in rows[:160]:
        if lang == "xx":
            for a, b, c in zip(*(f" {text} "[k:] for k in range(3))):
                v = [langid.letter_vectors(np.array([ord(x)]))[0].astype(int) for x in (a, b, c)]
                brute += np.roll(v[0], 2) * np.roll(v[1], 1) * v[2]
    assert (brute == vectors[0]).all()
    got = langid.predict(documents(spark, rows[160:] + ROWS), langs, vectors).select("row.doc_id", "row.text", "row.lang", "lang_pred", "score").collect()
    assert all(g["lang_pred"] == g["lang"] for g in got if g["lang"] in vocabulary)
    assert {g["lang_pred"] for g in got if g["text"] in (None, "", "  \t\n ", "7 8 9 !!")} == {"und"}
    assert all(0 <= g["score"] <= 1 for g in got) and len(got) == 80 + len(ROWS)
    assert {g["lang_pred"] for g in langid.predict(documents(spark), *langid.prototypes(documents(spark, ROWS[:0]))).collect()} == {"und"}


def test_languages_of_long_texts_without_blanks():
    r = np.random.default_rng(3)
    texts = ["".join(map(chr, r.integers(0x4E00, 0x9FA0, 20000))) for _ in range(128)]
    tracemalloc.start()
    got = np.concatenate(list(langid.bundles(texts, 64)))
    assert tracemalloc.get_traced_memory()[1] < 500e6
    tracemalloc.stop()
    for i in (0, 77, 127):  # each text alone, one trigram after the other
        v = langid.letter_vectors(langid.letters_of(texts[i]), 64).astype(int)
        assert (got[i] == (np.roll(v[:-2], 2, axis=1) * np.roll(v[1:-1], 1, axis=1) * v[2:]).sum(axis=0)).all()
    assert [(s.start, s.stop) for s in langid.runs(["a" * 5, None, "", "b" * 30, "c", "d"], 3, 10)] == [(0, 3), (3, 4), (4, 6)]
    assert list(langid.runs([], 3)) == []


def test_syncmers(spark):
    got = [r.asDict() for r in syncmers.fingerprints(documents(spark)).collect()]
    order = sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0))
    assert len(got) == len(ROWS)
    by_text = {}
    for doc_id, text, *_ in ROWS:
        by_text.setdefault(text or "", set()).update(g["fingerprint"] for g in got if g["doc_id"] == doc_id and g["n_chars"] == len(text or ""))
    assert len(by_text["The cat sat on the mat and the dog ran away from it"]) == 1 and by_text[""] == {""}
    texts = [r[1] or "" for r in order]
    want = set()
    for i, text in enumerate(texts):
        m = len(text) // 4
        ids = list(dict.fromkeys(x[0] for x in order))
        after = ids[(ids.index(order[i][0]) + 1) % len(ids)]
        for j in range(len(texts)):  # rows of one id may stand in either order
            if order[j][0] == after or j != i and order[j][0] == order[i][0]:
                want.add((order[i][0], hashlib.sha256((text[: len(text) - m] + texts[j][:m]).encode()).hexdigest()))
    assert {(g["doc_id"], g["edited_sha256"]) for g in got} <= want
    assert all(0 <= g["near_edited"] <= 1 and 0 <= g["near_next"] <= 1 for g in got)
    assert next(g for g in got if g["doc_id"] == 7)["near_edited"] > 0.4
    lone = syncmers.fingerprints(documents(spark, ROWS[:1])).collect()[0]
    assert lone["near_next"] == 1.0 and syncmers.fingerprints(documents(spark, ROWS[:0])).count() == 0
    anchors = syncmers.with_anchors(documents(spark, [(1, "q " + LONG, "", ""), (2, LONG, "", "")]), "text", "anchors").orderBy("doc_id").select("anchors").collect()
    first, second = ([(a["position"], a["hash"]) for a in r["anchors"]] for r in anchors)
    assert {(p + 1, h) for p, h in second} <= set(first)  # context-free: the same anchors one place on


def spark_hash(*longs):
    """Spark's xxhash64 of several longs, signed."""
    seed = 42
    for x in longs:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", x), seed)
        seed = seed - 2**64 if seed >= 2**63 else seed
    return seed


def brute_anchors(tokens):
    """(position, hash) of the closed 5-mers, by the 2-mers at their ends; the whole text if there is none."""
    h = [xxhash.xxh64_intdigest(t.encode(), 42) for t in tokens]
    h = [x - 2**64 if x >= 2**63 else x for x in h]
    g = [xxhash.xxh64_intdigest(struct.pack("<q", h[i + 1]), xxhash.xxh64_intdigest(struct.pack("<q", x), 42)) for i, x in enumerate(h[:-1])]
    g = [x - 2**64 if x >= 2**63 else x for x in g]
    found = [(i, spark_hash(g[i], g[i + 2], h[i + 4]) >> 32) for i in range(len(h) - 4) if min(g[i : i + 4]) in (g[i], g[i + 3])]
    return found or [(0, spark_hash(*h) >> 32)] * (len(h) > 0)


def test_syncmers_of_short_texts(spark):
    r = random.Random(4)
    texts = [[f"w{r.randrange(10**6)}" for _ in range(n)] for n in (1, 4, *[5, 6, 7] * 20, 30)]
    got = syncmers.with_anchors(documents(spark, [(i, " ".join(t), "", "") for i, t in enumerate(texts)]), "text", "anchors").orderBy("doc_id").select("anchors").collect()
    want = [brute_anchors(t) for t in texts]
    assert [[(a["position"], a["hash"]) for a in x["anchors"]] for x in got] == want
    assert any(len(t) == 5 and w == [(0, spark_hash(*[(lambda v: v - 2**64 if v >= 2**63 else v)(xxhash.xxh64_intdigest(x.encode(), 42)) for x in t]) >> 32)] for t, w in zip(texts, want))


def test_syncmers_without_blanks(spark):
    r = random.Random(5)
    passages = ["".join(chr(r.randrange(a, b)) for _ in range(120)) for a, b in ((0x4E00, 0x5E00), (0x3041, 0x3090), (0x0E01, 0x0E2F), (0x41, 0x5B), (0x20000, 0x20100))]
    rows = [(10 * i + n, "z" * n + p, "", "") for i, p in enumerate(passages) for n in range(8)]
    got = {x["doc_id"]: [(a["position"], a["hash"]) for a in x["anchors"]] for x in syncmers.with_anchors(documents(spark, rows), "text", "anchors").collect()}
    for i, p in enumerate(passages):
        assert got[10 * i] == brute_anchors(list(p)) and len(got[10 * i]) > 20
        for n in range(1, 8):
            ahead = n if p[0].isascii() else 1  # letters before another script are a word
            assert {(a + ahead, h) for a, h in got[10 * i]} <= set(got[10 * i + n])


def brute_nearness(a, b):
    """Longest common subsequence of the distinct hashes over all distinct hashes of both."""
    a, b = list(dict.fromkeys(a)), list(dict.fromkeys(b))
    best = [0] * (len(b) + 1)
    for x in a:
        before = best[:]
        for j, y in enumerate(b):
            best[j + 1] = before[j] + 1 if x == y else max(before[j + 1], best[j])
    return best[-1] / (len(a) + len(b) - best[-1]) if a or b else 1.0


def test_syncmers_match_in_order(spark):
    r = random.Random(6)
    new = lambda n: [f"w{r.randrange(10**6)}" for _ in range(n)]
    base, shared = new(300), new(80)
    texts = [base, base[150:] + base[:150], [x for i in range(0, 300, 30) for x in base[270 - i : 300 - i]], base[:40] * 3 + new(9), base[100:140], [], [], new(5), new(6),
             new(3000) + shared + new(3000), shared, new(2000) + shared + new(900)]
    text = [" ".join(t) for t in texts]
    rows = sorted(map(tuple, syncmers.fingerprints(documents(spark, [(i, t, "", "") for i, t in enumerate(text)])).select("doc_id", "near_edited", "near_next").collect()))
    edited = [t[: len(t) - len(t) // 4] + text[(i + 1) % len(text)][: len(t) // 4] for i, t in enumerate(text)]
    hashes = [[h for _, h in brute_anchors(t.split())] for t in text + edited]
    n = len(text)
    want = [(i, brute_nearness(hashes[i], hashes[n + i]), brute_nearness(hashes[i], hashes[(i + 1) % n])) for i in range(n)]
    assert [x[0] for x in rows] == list(range(n)) and np.allclose([x[1:] for x in rows], [x[1:] for x in want])
    assert 0 < want[9][2] < 0.05 and 0 < want[10][2] and want[5][2] == 1 and want[6][2] == 0  # a long text holds the short one


def shingle_sets(rows):
    out = []
    for doc_id, text, *_ in rows:
        w = words(text)
        out.append((doc_id, {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    return out


def brute_components(rows):
    sets, label = shingle_sets(rows), list(range(len(rows)))
    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (doc_id, _), x in zip(sets, label):
        if doc_id is not None:
            least[x] = min(doc_id, least.get(x, doc_id))
    return sorted(((d, len(s), least.get(x)) for (d, s), x in zip(sets, label)), key=repr)


def test_jaccard_join(spark):
    r = random.Random(11)
    base, rows = [f"b{i}" for i in range(90)], list(ROWS)
    for i in range(120):  # a cloud of near copies with links between some of them only
        text = list(base)
        for _ in range(r.randint(0, 4)):
            text[r.randrange(90)] = f"n{r.randrange(10**6)}"
        rows.append((100 + i, " ".join(text), "en", "a"))
    passage = " ".join(f"p{i}" for i in range(50))
    rows += [(300 + i, f"{' '.join(f'u{i}v{j}' for j in range(r.randint(10, 120)))} {passage}", "en", "a") for i in range(60)]
    got = sorted(map(tuple, jaccard.join_components(documents(spark, rows)).collect()), key=repr)
    assert got == brute_components(rows)
    assert jaccard.join_components(documents(spark, ROWS[:0])).count() == 0


def test_needed_matches_is_a_lower_bound():
    r = np.random.default_rng(2)
    for _ in range(400):
        n = int(r.integers(4, 60))
        a = set(r.choice(200, n, replace=False).tolist())
        b = set(list(a)[int(r.integers(0, 5)) :]) | set(r.choice(200, int(r.integers(0, 6)), replace=False).tolist())
        if b and 100 * len(a & b) >= 75 * len(a | b):
            first = [set(sorted(s)[: len(s) - -(-75 * len(s) // 100) + 1]) for s in (a, b)]
            assert len(first[0] & first[1]) >= jaccard.needed_matches(np.array(len(a)), np.array(len(b)))


def test_components(spark):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(50)] + [(r.randrange(1000, 1100), r.randrange(1000, 1100)) for _ in range(60)] + [(7, 7)]
    label = {x: x for e in edges for x in e}
    for _ in range(len(label)):
        for u, v in edges:
            label[u] = label[v] = min(label[u], label[v])
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    linked = {x for u, v in edges if u != v for x in (u, v)}
    assert got == {x: label[x] for x in linked}


def test_language_model(spark):
    r = random.Random(8)
    rows = ROWS + [(100 + i, " ".join(f"{'xyz'[i % 3]}{int(r.paretovariate(0.7))}" for _ in range(r.randint(30, 120))), ("en", "de", None)[i % 3], "a") for i in range(200)]
    from pyspark.sql import functions as F

    got = [x.asDict() for x in mixlm.scores(documents(spark, rows), F.col("doc_id") % 10 == 0).collect()]
    held = lambda d: d is not None and d % 10 == 0
    counts = Counter(w for d, t, *_ in rows if not held(d) for w in [*words(t), b""])
    n, v = sum(counts.values()), len(counts)
    want = []
    for d, t, *_ in rows:
        own = [*words(t), b""]
        want.append((d, held(d), len(own), sum(counts[w] > 0 for w in own), n, round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own), 8)))
    assert sorted(((x["doc_id"], x["held_out"], x["n_tokens"], x["n_known"], x["train_tokens"], round(x["base_score"], 8)) for x in got), key=repr) == sorted(want, key=repr)
    assert all(math.isfinite(x["score"]) and x["score"] < 0 and x["bits_per_byte"] > 0 for x in got)
    assert mixlm.scores(documents(spark, ROWS[:0]), F.lit(False)).count() == 0
    assert mixlm.scores(documents(spark, ROWS[:3]), F.lit(True)).count() == 3


def test_language_model_on_prose(spark):
    from martmill.llm.queries import op8_lm_scoring

    own = op8_lm_scoring(spark, "/root/testdata/sf0.01").where("held_out").select("score", "base_score").collect()
    assert sum(x["score"] for x in own) > sum(x["base_score"] for x in own)


def test_all_training_texts_teach_where_texts_start(spark, monkeypatch):
    """Long texts do, too, and each of many: the sums are those of the parts."""
    starts, point = [], mixlm.starting_point
    monkeypatch.setattr(mixlm, "starting_point", lambda *a: starts.append((a, point(*a))) or starts[-1][1])
    r = random.Random(3)
    rows = [(i, " ".join(r.choice(["stone", "stones", "tree", "river", f"w{r.randint(0, 500)}"]) for _ in range(2500)), "en", "a") for i in range(1, 5)]
    assert all(len(t) > 8000 for _, t, *_ in rows)
    got = mixlm.scores(documents(spark, rows), F.lit(False)).collect()
    (_, (weights, fix, named)), = starts
    assert len(got) == 4 and abs(weights - mixlm.start_weights()).max() > 0.01 and abs(fix).max() > 0
    words = sorted({w for _, t, *_ in rows for w in mixlm.text_words(t)})
    number = {w: i for i, w in enumerate(words)}
    texts = [np.array([number[w] for w in mixlm.text_words(t)]) for _, t, *_ in rows]
    once = np.array([np.bincount(t, minlength=len(words)) for t in texts])
    counts, code = np.stack([once.sum(axis=0)] * 2), mixlm.Code(np.ones(257))
    spelling, tables = mixlm.Spelling(words, code), np.zeros((2, 2 * mixlm.SLOTS), np.float32)
    mixlm.add_bits(tables, spelling, counts)
    even = np.zeros(0, np.float32), np.zeros(0, np.int8)
    mixer = mixlm.Mixer(spelling, np.zeros((0, 2)), even, even, mixlm.first_start(1))
    taught = lambda some: mixlm.evidence(mixer, mixlm.Own(counts, counts.sum(axis=1), tables), [texts[i] for i in some], np.ones(len(some), int))
    every = taught([0, 1, 2, 3])
    assert np.allclose(every, taught([0, 2]) + taught([1, 3]), rtol=1e-3, atol=1e-2) and every[mixlm.EVIDENCE :].sum() == pytest.approx(sum(map(len, texts)))


def test_a_text_is_judged_without_its_own_words():
    """A word that only one text has is unknown to it, one that two texts have is known by half."""
    words = [b"", b"alone", b"both"]
    texts = [np.array([1, 1, 2, 0]), np.array([2, 0])]
    counts = np.array([[2, 2, 2], [2, 2, 2]])
    spelling, tables = mixlm.Spelling(words, mixlm.Code(np.ones(257))), np.zeros((2, 2 * mixlm.SLOTS), np.float32)
    mixlm.add_bits(tables, spelling, counts)
    own = mixlm.Own(counts, counts.sum(axis=1), tables)
    own.begin(texts, np.array([1, 0]))
    pair = np.array([0, 1, 2, 3, 5])  # text * 3 + word
    assert own.often(pair).tolist() == [1, 2, 1, 1, 1]
    share = own.share(pair // 3, pair % 3, pair)
    assert share[:, 0].tolist() == [0.5, 0, 0.5, 0.25, 0.25] and share[:3, 1].tolist() == [0.5, 0, 0.5] and share[3:, 1].tolist() == [2 / 6, 2 / 6]
    bits = slice(spelling.first[1], spelling.first[1] + spelling.count[1])
    ones = np.ones(spelling.count[1], np.float32)
    _, seen, _, _ = own.odds(spelling.slot[bits], mixlm.recent_slot(spelling.recent[bits], 0), spelling.bit[bits], 2 * ones, np.array([True, True]), np.zeros(len(ones), int))
    assert seen[-1] == 0 and (seen >= 0).all()


def test_spelling_is_a_probability():
    """Over all short words of two letters, the bits' probabilities add up to at most 1."""
    counts = np.zeros(257)
    counts[[97, 98, 256]] = 50, 30, 40
    code = mixlm.Code(counts)
    assert sum(2.0 ** -code.length) == pytest.approx(1)
    spelled = [b""] + [bytes(p) for k in range(1, 4) for p in __import__("itertools").product(b"ab", repeat=k)]
    s = mixlm.Spelling(spelled, code)
    even = (np.zeros(len(s.bit), np.float32), np.zeros(len(s.bit), np.int8)), (np.zeros(mixlm.SLOTS, np.float32), np.zeros(mixlm.SLOTS, np.int8))
    mixer = mixlm.Mixer(s, np.zeros((len(spelled), 1)), *even, (mixlm.start_weights(), np.zeros(mixlm.BUCKETS), np.array([[0.0, 0.0, 1.0]])))
    total = float(np.exp(mixer.score([np.array([i]) for i in range(len(spelled))])).sum())
    assert 0 < total <= 1 + 1e-6


def test_frequent_words_are_spelled():
    """With all weight on spelling, a word's share of the corpus changes nothing."""
    words = [b"", b"the", b"then"]
    s = mixlm.Spelling(words, mixlm.Code(np.ones(257)))
    even = (np.zeros(len(s.bit), np.float32), np.zeros(len(s.bit), np.int8)), (np.zeros(mixlm.SLOTS, np.float32), np.zeros(mixlm.SLOTS, np.int8))
    start = mixlm.start_weights(), np.zeros(mixlm.BUCKETS), np.array([[0.0, 0.0, 1.0]])
    texts = [np.array([1, 2, 1, 0]), np.array([0])]
    rare, often = (mixlm.Mixer(s, np.full((3, 1), share), *even, start).score(texts) for share in (0.0, 0.3))
    assert (rare == often).all() and (often > -500).all()


def plain_scores(words, texts, code, share, tables, start, rate=mixlm.RATE):
    """The mixer's scores, bit by bit and text by text, without groups, packed bits or narrowed tables."""
    s, out = mixlm.Spelling(words, code), []
    (one, seen_one), (two, seen_two) = (mixlm.odds(t[0::2], t[1::2]) for t in tables)
    for text in texts:
        weights, fix, named = start[0].astype(np.float32).copy(), start[1].astype(np.float32).copy(), start[2][0].copy()
        power, fix_power = np.full(weights.shape, mixlm.PACE, np.float32), np.full(fix.shape, mixlm.PACE, np.float32)
        own, came, total, at, block = np.zeros((mixlm.LOCAL, 2)), Counter(), 0.0, 0, mixlm.FIRST_BLOCK
        while at < len(text):
            held, times = named / named.sum(), Counter(text[at : at + block].tolist())
            group = int(held[1:-2].argmax()) + 1 if len(held) > 3 and held[1:-2].max() > 0.3 else 0
            slope, fix_slope, bits, gain = np.zeros(weights.shape), np.zeros(fix.shape), [], np.zeros(len(named))
            for w, n in times.items():
                spelled = 0.0
                for i in range(s.first[w], s.first[w] + s.count[w]):
                    bit, slot = int(s.bit[i]), int(mixlm.recent_slot(s.recent[i], group))
                    zeros, ones = own[s.local[i]]
                    gate = seen_one[s.slot[i]] * 20 + seen_two[slot] * 4 + (zeros + ones > 0) + (zeros + ones >= 3) + (zeros > 0 and ones > 0)
                    x = np.array([one[s.slot[i]], two[slot], math.log((ones + 0.2) / (zeros + 0.2))])
                    mixed = min(11.0, max(-11.0, float(weights[gate] @ x)))
                    bucket = int(mixed + 11.5)
                    p = 1 / (1 + math.exp(-(mixed + fix[bucket])))
                    spelled += math.log(max(1e-12, p if bit else 1 - p))
                    slope[gate] += (bit - p) * n * x
                    fix_slope[bucket] += (bit - p) * n
                    bits.append((s.local[i], bit, n))
                ways = held * np.array([*share[w], came[w] / max(1, at), math.exp(spelled)])
                total += math.log(ways.sum()) * n
                gain += ways / ways.sum() * n
            named += gain
            came.update(times)
            for place, bit, n in bits:
                own[place, bit] += n
            power += slope * slope
            weights += rate * slope / np.sqrt(power)
            fix_power += fix_slope * fix_slope
            fix += rate * fix_slope / np.sqrt(fix_power)
            at, block = at + block, min(2 * block, mixlm.LAST_BLOCK)
        out.append(total)
    return out


def test_mixer_against_single_bits(monkeypatch):
    """Many bits of many texts in one step score as one bit after the other, and however many go in a step."""
    r = random.Random(12)
    words = [b"", *sorted({bytes(r.choice(b"abcde") for _ in range(r.randint(1, 6))) for _ in range(60)})]
    texts = [np.array([*(min(int(r.paretovariate(0.6)), len(words) - 1) for _ in range(n)), 0]) for n in (0, 1, 7, 8, 30, 30, 31, 90, 200)]
    counts = np.array([[r.choice([0, 1, 5, 70]) for _ in words] for _ in range(3)])
    counts[0] = counts[1] + counts[2]
    code, tables = mixlm.Code(np.arange(257)), np.zeros((2, 2 * mixlm.SLOTS), np.float32)
    spelling = mixlm.Spelling(words, code)
    mixlm.add_bits(tables, spelling, counts)
    share = (counts / counts.sum(axis=1)[:, None]).T
    start = mixlm.start_weights(), np.linspace(-0.1, 0.1, mixlm.BUCKETS), np.array([[1.0, 1.5, 0.2, 1.0, 2.0]])
    by_slot = [mixlm.odds(t[0::2], t[1::2]) for t in tables]
    score = lambda: mixlm.Mixer(spelling, share, tuple(x[spelling.slot] for x in by_slot[0]), by_slot[1], start).score(texts)
    got = score()
    assert np.allclose(got, plain_scores(words, texts, code, share, tables, start), rtol=1e-5)
    own = lambda: mixlm.evidence(mixlm.Mixer(spelling, share, (np.zeros(0), np.zeros(0)), (np.zeros(0), np.zeros(0)), mixlm.first_start(2)), mixlm.Own(counts, counts.sum(axis=1), tables), texts, np.arange(len(texts)) % 3)
    taught = own()
    monkeypatch.setattr(mixlm, "BITS_AT_ONCE", 300)
    assert (score() == got).all() and np.allclose(own(), taught, rtol=1e-5, atol=1e-4)


def test_numbered_pairs():
    r = np.random.default_rng(3)
    texts = [r.integers(0, 50, n) for n in (0, 3, 40, 200)]
    for words in (50, 2**60):  # numbers too large to be packed with their places, too
        pairs, number = mixlm.numbered(texts, words)
        want = np.unique(np.repeat(np.arange(4), [len(t) for t in texts]) * words + np.concatenate(texts), return_inverse=True)
        assert (pairs == want[0]).all() and (number == want[1]).all()


def test_mix(spark):
    r = random.Random(9)
    rows = ROWS + [(1000 + i, " ".join("w" for _ in range(r.randint(1, 30))), "en", r.choice(["a", "b", "c", "d", None, "big", "big"])) for i in range(900)]
    got = [x.asDict() for x in mix.mix(documents(spark, rows)).collect()]
    assert len(got) == len(rows)
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len(words(t))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        level = (total - sum(3 * sizes[s] for s in full)) / max(1, sum(weight[s] for s in names if s not in full))
        more = {s for s in names if s not in full and level * weight[s] > 3 * sizes[s]}
        if not more:
            break
        full |= more
    target = {s: 3 * sizes[s] if s in full else level * weight[s] for s in names}
    for s in names:
        own = [x for x in got if x["source"] == s]
        assert all(x["source_size"] == sizes[s] and x["target"] == pytest.approx(target[s], rel=1e-12) and 0 <= x["taken"] <= 3 * x["size"] and (not x["size"] or x["taken"] % x["size"] == 0) for x in own)
        if s in ("b", "d", "big", None):
            assert sum(x["taken"] for x in own) == pytest.approx(target[s], abs=15)  # half of the longest document
    again = {(x["doc_id"], x["hash"], x["taken"]) for x in mix.mix(documents(spark, rows[::-1])).collect()}
    assert again == {(x["doc_id"], x["hash"], x["taken"]) for x in got}
    assert mix.mix(documents(spark, ROWS[:0])).count() == 0


def test_pack(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    rows = ROWS * 3 + [(500 + i, " ".join(f"token{i * j % 50}" for j in range(i * 7 % 900)), "en", "a") for i in range(150)] + [(900, "a<|endoftext|>B É<|ENDOFTEXT|> \x1c'S", "en", "a")]
    got = [x.asDict() for x in pack.pack(pack.cut(documents(spark, rows), path)).collect()]
    encode, want = Tokenizer.from_file(path), Counter()
    for d, t, *_ in rows:
        ids = np.array([*encode.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for a in range(0, len(ids), 2048):
            want[(d, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes()), len(ids))] += 1
    assert Counter((x["doc_id"], x["start"], x["length"], x["ids_crc32"], x["doc_tokens"]) for x in got) == want
    by = {}
    for x in got:
        by.setdefault(x["sequence_id"], []).append((x["offset"], x["length"]))
    for pieces in by.values():
        ends = 0
        for offset, length in sorted(pieces):
            assert offset == ends
            ends += length
        assert ends <= 2048
    assert sum(x["length"] for x in got) / (2048 * len(by)) > 0.97
    assert pack.pack(pack.cut(documents(spark, ROWS[:0]), path)).count() == 0


def test_column_generation_meets_the_bound():
    sizes, demand = np.array([3, 5, 7, 16]), np.array([400, 300, 200, 11])
    plan = pack.plan_patterns(sizes, demand, 16)
    assert sum(p * t for p, t in plan).tolist() == demand.tolist()
    patterns, use = pack.column_generation(sizes, demand, 16)
    assert (patterns @ sizes <= 16).all() and (use @ patterns >= demand - 1e-6).all()
    prices = np.array([3, 5, 7, 16]) / 16  # a feasible dual gives a lower bound, rounding an upper one
    assert float(prices @ demand) - 1e-6 <= use.sum() <= sum(t for _, t in plan) <= math.ceil(use.sum()) + len(sizes)


def test_pipeline(spark, tmp_path):
    docs = documents(spark, ROWS + [(60, "a near copy " + " ".join(NEAR), "en", "a")])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    kept = corpus_pipeline.language_id(spark, docs, "")
    assert kept.columns == docs.columns and {r["text"] for r in kept.collect()} == {t for _, t, *_ in ROWS + [(60, "a near copy " + " ".join(NEAR))] if t and any(c.isalpha() for c in t)}
    single = corpus_pipeline.near_duplicates(spark, docs, "")
    rows = ROWS + [(60, "a near copy " + " ".join(NEAR), "en", "a")]
    groups = {c for _, n, c in brute_components(rows) if n}
    assert single.columns == docs.columns and single.where("text rlike '[^ \\\\s]'").count() == len(groups)
    mixed = corpus_pipeline.source_mix(spark, single, "")
    assert mixed.columns == docs.columns and mixed.count() > 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "source_mix", "packing"]
