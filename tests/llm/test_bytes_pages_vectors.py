"""Suffix arrays, the n-gram trie, pages, embeddings."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapfold.llm import buckets, embeddings, ngrams, pages, suffixes
from tests.llm import corpus


def test_suffix_array():
    rng = random.Random(0)
    for _ in range(1500):
        s = [rng.randint(1, rng.choice((2, 3, 6))) for _ in range(rng.randint(1, 40))] + [0]
        assert suffixes.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])
    assert suffixes.suffix_array([0]) == [0]


def test_rows_are_sorted_from_few_symbols(monkeypatch):
    rng = np.random.default_rng(4)
    lengths = []
    plain = suffixes.suffix_array
    monkeypatch.setattr(suffixes, "suffix_array", lambda symbols: lengths.append(len(symbols)) or plain(symbols))
    left, right = (rng.choice(np.array([0, 97, 98], np.uint8), (60, width)) for width in (336, 400))
    for side in (left, right):
        side[20:40, 100:] = side[:20, 100:]
        side[30:50, :330] = side[0, :330]
        side[50:] = side[:10]
    for side, order in zip((left, right), suffixes._sorted_rows(left, right)):
        assert sorted(order.tolist()) == list(range(60))
        assert [side[k].tobytes() for k in order] == sorted(row.tobytes() for row in side)
    # 6 and 7 cells and a separator for each different row, not 21 and 25 for every row.
    assert lengths == [50 * (6 + 1 + 7 + 1) + 1]


def test_anchors_in_blocks(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abé") for _ in range(n)) for n in (900, 0, 12, 40, 500)] + [None]
    data = suffixes.Bytes(texts)
    whole = data.hashes(16)
    for block in (1, 50, 64):
        for module in (buckets, suffixes):
            monkeypatch.setattr(module, "BLOCK", block)
        assert np.array_equal(data.hashes(16), whole) and len(whole) == len(data.raw) - 15
        inside = data.inside(40)
        assert inside.tolist() == [any(b <= i and i + 40 <= e for b, e in zip(data.begins, data.ends)) for i in range(len(data.raw))]
        want = set()
        for i in np.flatnonzero(inside):
            stretch = whole[i : i + 25]
            want |= {int(i) + k for k in np.flatnonzero(stretch == stretch.min()).tolist()}
        assert buckets.minimizers(whole, 25, inside).tolist() == sorted(want)


@pytest.mark.parametrize("hot_anchor", [2_000, 3])
def test_repeated_bytes(spark, hot_anchor):
    rng = random.Random(5)
    shared = corpus.sentence(rng, 150)
    rows = corpus.documents(2) + [(700 + i, corpus.sentence(rng, 9)[: 5 * i] + shared[3 * i :] + "é" * i, "s") for i in range(12)]
    rows += [(800, "q" * 399, "short"), (801, "q" * 400, "run"), (802, "q" * 405, "run")]
    docs = spark.createDataFrame(rows, corpus.SCHEMA).repartition(3).withColumn("N_BYTES", F.lit("old"))
    found = suffixes.remove_repeats(docs, hot_anchor=hot_anchor).collect()
    texts = [(r["text"] or "").encode() for r in found]
    counts = Counter(t[i : i + 400] for t in texts for i in range(len(t) - 399))
    assert len(found) == len(rows)
    for r, t in zip(found, texts):
        gone = np.zeros(len(t) + 1, dtype=int)
        for i in range(len(t) - 399):
            if counts[t[i : i + 400]] > 1:
                gone[i] += 1
                gone[i + 400] -= 1
        mask = np.cumsum(gone[:-1]) > 0
        spans = int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())
        kept = np.frombuffer(t, np.uint8)[~mask].tobytes()
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept_bytes"])) == (len(t), int(mask.sum()), spans, kept), r["doc_id"]
    assert sum(r["n_removed"] for r in found) > 10_000
    assert suffixes.remove_repeats(docs.limit(0)).count() == 0


def test_offset_ranges():
    for reach in (0, 1, 2, 3, 7, 336):
        ranges = suffixes.offset_ranges(reach)
        assert sorted(k for low, high in ranges for k in range(low, high + 1)) == list(range(reach + 1))


def test_no_unit_of_a_hot_anchor_is_large(spark):
    rng = random.Random(9)
    passage = corpus.sentence(rng, 200).encode()[:420]
    rows = []
    for i in range(60):  # a passage around an anchor at its place 50 or so, in different surroundings, some cut short
        before, after = (bytes(rng.choice(b"abc") for _ in range(500)) for _ in range(2))
        left, right = (before + passage[:50])[::-1][: 336 if i % 5 else 55], (passage[50:] + after)[: 400 if i % 7 else 355]
        rows.append((1, i, 0, bytearray(left), bytearray(right)))
    frame = spark.createDataFrame(rows, "a long, c1 long, c2 long, left binary, right binary")
    settled, units, _ = suffixes.hot_units(frame, 400, 336, 5)
    assert units.groupBy(*suffixes.UNIT).count().where("count > 5").count() == 0
    found = {(r["c1"], k) for r in settled.collect() for k in range(r["low"][0], r["high"][0])}
    for _, i, _, left, right in rows:
        fits = {r for r in range(337) if len(left) >= r and len(right) >= 400 - r}
        assert {r for r in fits if r <= 50 and 400 - r <= 370} <= {r for c, r in found if c == i} <= fits


def test_elias_fano():
    rng = np.random.default_rng(0)
    for n, universe in ((1, 1), (300, 900), (300, 10**9), (64, 64), (0, 5)):
        values = np.sort(rng.integers(0, universe, n))
        sequence = ngrams.EliasFano.build(values, universe)
        assert sequence.access(np.arange(n)).tolist() == values.tolist() if n else True
        wanted = rng.integers(0, universe, 200)
        begin, end = np.zeros(200, int), np.full(200, n)
        for v, i in zip(wanted.tolist(), sequence.find(begin, end, wanted).tolist()):
            assert (i == -1 and v not in values) or values[i] == v


def test_trie_is_a_distribution():
    rng = np.random.default_rng(1)
    k = 7
    z = rng.integers(0, k, 4000) ** 2 % k
    unigram = (np.bincount(z, minlength=k) + 1) / (len(z) + k)
    grams = {}
    for order, keys in ((2, z[:-1] * k + z[1:]), (3, (z[:-2] * k + z[1:-1]) * k + z[2:])):
        key, n = np.unique(keys, return_counts=True)
        context = key // k
        total = np.bincount(context, weights=n)[context]
        few = n > 2
        grams[order] = (key[few], n[few], total[few])
    built = ngrams.Trie.build(unigram, grams)
    trie = ngrams.Trie.load(built.dump())
    for u in range(-1, k):
        for v in range(k):
            scores = trie.scores(np.full(k, u), np.full(k, v), np.arange(k))
            assert abs(sum(10**scores) - 1) < 1e-4
    assert np.array_equal(built.scores(np.array([1]), np.array([2]), np.array([3])), trie.scores(np.array([1]), np.array([2]), np.array([3])))


def test_scores(spark):
    rows = corpus.documents(3)
    docs = spark.createDataFrame(rows, corpus.SCHEMA).repartition(3).withColumn("score", F.lit("old"))
    found = ngrams.score_documents(docs).collect()
    assert len(found) == len(rows)
    tokens = {}
    counts = Counter()
    for r in rows:
        own = (r[1] or "").encode().lower().split() + [None]
        tokens.setdefault(r[0], []).append(own)
        if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 != 2:
            counts.update(own)
    total, types = sum(counts.values()), len(counts)
    for r in found:
        fits = [
            t
            for t in tokens[r["doc_id"]]
            if len(t) == r["n_tokens"] and abs(sum(math.log10((counts[x] + 1) / (total + types + 1)) for x in t) - r["base_score"]) < 1e-6
        ]
        assert fits and r["n_known"] == sum(counts[x] > 0 for x in fits[0]) and r["train_tokens"] == total and r["score"] < 0
    unseen = [r for r in found if r["held_out"] and r["n_tokens"] > 5]
    assert unseen
    nothing = ngrams.score_documents(docs.where("doc_id = 301").limit(1)).collect()
    assert len(nothing) == 1 and math.isfinite(nothing[0]["score"])
    assert ngrams.score_documents(docs.limit(0)).count() == 0


def test_scores_are_those_of_a_plain_class_model(spark):
    """Few classes, so that every level has at most 256 values and its code book is exact."""
    rng = random.Random(11)
    rows = [(i, " ".join(rng.choice(["a", "b", "a", "c", f"r{rng.randint(0, 30)}"]) for _ in range(rng.randint(0, 40)))) for i in range(80)]
    found = ngrams.score_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), head_share=10).collect()
    texts = {i: [*t.split(), None] for i, t in rows}
    train = [t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(x for t in train for x in t)
    total, types = sum(counts.values()), len(counts)
    heads = {x for x, c in counts.items() if 10 * c >= total} | {None}
    rare = sum(c + 1 for x, c in counts.items() if x not in heads) + 1

    def grams(t):
        z = [None, *(x if x in heads else "rare" for x in t)]
        return [(z[k - 2] if k > 1 else "nothing", z[k - 1], z[k]) for k in range(1, len(z))]

    three = Counter(g for t in train for g in grams(t) if g[0] != "nothing")
    two = Counter(g[1:] for t in train for g in grams(t))

    def interpolated(n, context, z, below):
        followers = [c for g, c in n.items() if g[:-1] == context]
        if not followers:
            return below
        return max(n[(*context, z)] - 0.75, 0) / sum(followers) + 0.75 * len(followers) / sum(followers) * below

    def share(u, v, z):
        below = (rare if z == "rare" else counts[z] + 1) / (total + types + 1)
        return interpolated(three, (u, v), z, interpolated(two, (v,), z, below))

    for r in found:
        t = texts[r["doc_id"]]
        want = sum(math.log10(share(*g)) for g in grams(t)) + sum(math.log10((counts[x] + 1) / rare) for x in t if x not in heads)
        assert abs(r["score"] - want) < 1e-4, r["doc_id"]
    assert len(found) == len(rows) and len(heads) == 4 and len(three) > 50


def test_scores_are_those_of_a_plain_model_of_all_words(spark):
    """Words far rarer than one in 5,000, contexts spread over several shards, copies, and words and n-grams of held-out texts only."""
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["the", "of", "The", f"w{rng.randint(0, 40)}", f"r{rng.randint(0, 3000)}"]) for _ in range(rng.randint(0, 90)))) for i in range(400)]
    rows += [rows[7], rows[7], (None, "of the null"), (401, None)]
    found = ngrams.score_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    texts = [(i, [None, *(t or "").lower().split(), None]) for i, t in rows]
    train = [t for i, t in texts if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    n = [Counter(tuple(t[i : i + k]) for t in train for i in range(k == 1, len(t) - k + 1)) for k in (1, 2, 3)]
    total, whole = sum(n[0].values()), sum(n[0].values()) + len(n[0]) + 1
    assert min(n[0].values()) * 5000 < total
    contexts = [Counter(g[:-1] for g in c.elements()) for c in n]
    followers = [Counter(g[:-1] for g in c) for c in n]

    def share(gram):
        if len(gram) == 1:
            return (n[0][gram] + 1) / whole
        k, context, below = len(gram) - 1, gram[:-1], share(gram[1:])
        if not contexts[k][context]:
            return below
        return (max(n[k][gram] - 0.75, 0) + 0.75 * followers[k][context] * below) / contexts[k][context]

    expected = sorted((str(i), sum(math.log10(share(tuple(t[max(0, k - 2) : k + 1]))) for k in range(1, len(t)))) for i, t in texts)
    assert abs(sum(10 ** math.log10(share(("the", "of", w))) for (w,) in n[0]) + share(("the", "of", "never")) - 1) < 1e-9
    for (i, score), (j, wanted) in zip(sorted((str(r["doc_id"]), r["score"]) for r in found), expected, strict=True):
        assert i == j and abs(score - wanted) < 1e-6


PAGE = (
    "<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t='</p>';</script></head><body class='has-sidebar'>"
    "<header><h1>Site</h1></header><nav><ul><li><a href=/a>menu</a></ul></nav><div class='cookie-notice'>we use</div>"
    "<div id=main-{0}><article class='post-{0}'><h1>Title &amp; {0}</h1><p><b>one&nbsp; two<br>three<p>four <a href=x>link</a> five"
    "<ul><li>a<li>b</ul><form><p>send</form><div class='comments'><p>first!</div></article></div>{1}<aside>side</aside><footer>&copy; all</footer></body></html>"
)
TEXT = "Title & {0}\none two three\nfour link five\na\nb"


def test_pages(spark):
    rows = [(i, f"http://h.example/{i}", PAGE.format(i, "")) for i in range(5)]
    rows.append((5, "http://h.example/long", PAGE.format(5, f"<div class=extra><p>{'junk ' * 300}</div>")))
    rows += [(6, "http://other.example/", "<p>only <i>this</i>"), (7, None, None), (8, "odd", ""), (9, "odd", "<nav>menu</nav>"), (10, None, "a < b <!-- x")]
    rows += [(11, "http://h.example/x", "<main><p>another kind</main>"), (11, "http://h.example/x", "<main><p>another kind</main>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"blocks": F.lit(1), "_host": F.lit(2), "text": F.lit("old")})
    found = pages.extract(frame)
    assert found.columns == ["page_id", "url", "blocks", "_host", "text"]
    texts = {r["page_id"]: r["text"] for r in found.collect()}
    # Page 5 alone would choose its junk; its host's other pages outvote it.
    assert [texts[i] for i in range(6)] == [TEXT.format(i) for i in range(6)]
    assert [texts[i] for i in range(6, 12)] == ["only this", "", "", "", "a < b", "another kind"]
    assert found.count() == len(rows) and pages.extract(frame, broadcast_hosts=0).where("page_id < 6").count() == 6
    assert pages.extract(frame.limit(0)).count() == 0


def test_pages_keep_titles_leads_and_second_templates(spark):
    body = "<p>" + "body text " * 40
    whole = "<body><article><h1>Title</h1><p>lead</p><div class=body>" + body + "</div><p>end</p></article></body>"
    plain = "<body><div class=top><h1>Title</h1></div><div class=body>" + body + "</div><div class=links><a href=/x>more</a></div></body>"
    other = "<body><article><p>teaser</p></article><div class=story>" + body + "</div></body>"
    made = [("a.example", whole)] * 3 + [("b.example", plain)] * 3 + [("c.example", whole)] * 5 + [("c.example", other)] * 2
    frame = spark.createDataFrame([(i, f"http://{h}/{i}", t) for i, (h, t) in enumerate(made)], "page_id long, url string, html string")
    for hosts in (100, 0):
        texts = [r["text"].split("\n") for r in pages.extract(frame, broadcast_hosts=hosts).orderBy("page_id").collect()]
        text = ("body text " * 40).strip()
        assert texts[:3] == [["Title", "lead", text, "end"]] * 3
        assert texts[3:6] == [["Title", text, "more"]] * 3
        assert texts[6:11] == texts[:5][:3] + texts[:2] and texts[11:] == [["teaser", text]] * 2


ARTICLE = "<h1>Title</h1><p>" + "body text of the article " * 20 + "</p><p>last words</p>"
WORDS = ["Title", ("body text of the article " * 20).strip(), "last words"]


@pytest.mark.parametrize(
    "around",
    ["class='wp-sidebar-layout'", "id='no-sidebar'", "class='content-with-sidebar'", "class='share-story'", "class='related-work'", "class='post comments-open'", "class='widget'"],
)
def test_an_article_is_one_whatever_it_is_called(spark, around):
    page = f"<body><nav>menu</nav><div {around}>{ARTICLE}</div><div class='site-footer'>imprint</div><div id=comments><p>{'a reader says ' * 90}</div></body>"
    rows = [(i, f"http://h.example/{i}", page) for i in range(3)]
    found = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert [r["text"].split("\n") for r in found.collect()] == [WORDS] * 3


def test_names_leave_out_what_is_not_most_of_the_text():
    def texts(html):
        return [t for _, t, _ in pages.blocks_of(html)]

    form = f"<form id=aspnetForm><div class=top-menu>menu</div><div>{ARTICLE}</div><p><input> <button>send</button></form>"
    assert texts(form) == WORDS  # a form around the page
    assert texts(f"<div>{ARTICLE}</div><form><p>Your name <input></form>") == WORDS
    for name in ("class=main-nav", "class=sidebar", "id=cookie-notice", "class='post related'", "role=navigation", "class=comment-list", "class=siteFooter"):
        assert texts(f"<div>{ARTICLE}</div><div {name}><p>{'other words ' * 15}</div>") == WORDS
    # Long comments are no article, and a short one stays beside a longer footer.
    assert texts(f"<div>{ARTICLE}</div><div class=post-comments><p>{'a reader says ' * 900}</div>") == WORDS
    assert texts(f"<p>short text<div class=site-footer>{'imprint and more ' * 5}</div>") == ["short text"]
    assert texts("<p>before <span class=share-box>Share this</span> after") == ["before", "after"]
    assert texts("<div class=comments>all there is</div>") == []


def test_teasers_beside_the_text_are_outvoted(spark):
    teaser = "<div><a href=/x>Another story of the day</a> in short</div>"
    plain = f"<body>{teaser}<div class=story>{ARTICLE}</div>{teaser}</body>"
    lead = f"<body><div><b>Lead</b> of the story</div><div class=story>{ARTICLE}</div></body>"
    made = [("a.example", plain)] * 3 + [("b.example", lead)] * 3
    frame = spark.createDataFrame([(i, f"http://{h}/{i}", t) for i, (h, t) in enumerate(made)], "page_id long, url string, html string")
    texts = [r["text"].split("\n") for r in pages.extract(frame).orderBy("page_id").collect()]
    assert texts == [WORDS] * 3 + [["Lead of the story", *WORDS]] * 3


def test_long_attribute_values_are_no_text():
    for quote, other in ("\"'", "'\""):
        value = f"<b> > {other} " * 2000
        assert [b[1] for b in pages.blocks_of(f"<p>one <i data-props={quote}{value}{quote}>two</i> three")] == ["one two three"]
    for piece in ("<a x='", "<a x=\"' ", "<a x='\"' "):
        pages.blocks_of(piece * 5000 + "\"")


def test_bad_markup_is_read_in_linear_time():
    for piece in ('<a href="x ', "<div>", "<p>x<b>", "</q>", "<a <a ", "<!-", "<td><tr>"):
        pages.blocks_of(piece * 5000)


def vectors(seed=0, dims=24):
    rng = np.random.default_rng(seed)
    rows = []
    for label in (0, 1):
        for c in range(25):
            centre = rng.normal(size=dims)
            rows += [(label, (centre + rng.normal(size=dims) * rng.choice([0.02, 0.25, 0.45])).tolist()) for _ in range(rng.integers(1, 9))]
    rows += [(1, rows[3][1]), (0, rows[3][1]), (0, rows[3][1]), (0, [2 * x for x in rows[3][1]]), (None, rows[3][1])]
    rows += [(0, None), (0, []), (0, [0.0] * dims), (0, [float("nan")] * dims), (0, [float("inf")] * dims), (0, [None] + [1.0] * (dims - 1)), (0, [1.0, 2.0]), (0, [2.0, 4.0])]
    return [(i, list(v) if v is not None else None, l) for i, (l, v) in enumerate(rows)]


def test_embeddings(spark):
    rows = vectors()
    rows.append((None, rows[3][1], 0))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3).withColumns({"class": F.lit(1), "KEPT": F.lit("old")})
    units = []
    for _, v, label in rows:
        good = v and label is not None and None not in v and np.isfinite(v).all() and np.any(v)
        units.append(np.array(v) / np.linalg.norm(v) if good else None)
    pairs = [
        (i, j)
        for i in range(len(rows))
        for j in range(len(rows))
        if i != j and units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.93
    ]
    links = Counter(i for i, _ in pairs)
    root = corpus.roots(len(rows), pairs)
    assert len(pairs) > 100
    for block in (2048, 16):
        found = embeddings.embedding_links(frame, block_rows=block)
        assert found.columns == ["vec_id", "embedding", "label", "class", "n_links", "component_id", "kept"]
        got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found.collect()}
        for i, row in enumerate(rows):
            best = min((rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None), default=None)
            assert got[row[0]][:2] == (links[i], best), (block, i)
            assert row[0] is None or got[row[0]][2] == (best == row[0])
    assert embeddings.embedding_links(frame.limit(0)).count() == 0


def test_large_labels_without_centres_are_cut(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "MAX_CENTRES", 1)  # so one class in 100 would be drawn, and none of these is
    numbers = [r[0] for r in spark.range(200).where("pmod(xxhash64(id), 100) <> 0").limit(100).collect()]
    points = np.random.default_rng(4).normal(size=(100, 3))
    points /= np.linalg.norm(points, axis=1)[:, None]
    made = [(i, 1, v.tolist(), "one") for i, v in zip(numbers, points)]
    cells = embeddings._cells(spark.createDataFrame(made, "class long, n long, v array<double>, part string"), 0.93, 10)
    assert cells.groupBy("unit").count().agg(F.max("count")).first()[0] <= 50
    near = points @ points.T >= 0.93
    np.fill_diagonal(near, False)
    links = {r["class"]: r["n"] for r in embeddings._work(cells, 0.93).groupBy("class").agg(F.sum("n_links").alias("n")).collect()}
    assert [links.get(i, 0) for i in numbers] == near.sum(axis=1).tolist()


def test_cover_tree_links_whole_nodes():
    rng = np.random.default_rng(3)
    points = np.concatenate([c + rng.normal(size=(200, 8)) * 0.01 for c in rng.normal(size=(3, 8))])
    points /= np.linalg.norm(points, axis=1)[:, None]
    weights = rng.integers(1, 4, len(points))
    near = points @ points.T >= 0.93
    np.fill_diagonal(near, False)
    links, parent = embeddings.unit_links(points, weights, None, None, 0.93)
    assert np.array_equal(links, near @ weights)
    half = len(points) // 2
    both, parent = embeddings.unit_links(points[:half], weights[:half], points[half:], weights[half:], 0.93)
    assert np.array_equal(both, np.concatenate([near[:half, half:] @ weights[half:], near[half:, :half] @ weights[:half]]))


def test_levels_are_asked_as_they_are(monkeypatch):
    """Counts and followers come from the Elias-Fano sequences themselves, which are never unpacked."""
    rng = np.random.default_rng(5)
    monkeypatch.setattr(ngrams.EliasFano, "decode", None, raising=False)
    for contexts, most, n in ((50, 40, 600), (3, 5000, 900), (7, 1, 5), (4, 9, 0)):
        grams = np.unique(np.stack([rng.integers(0, contexts, n), rng.integers(0, most, n)]), axis=1) if n else np.zeros((2, 0), np.int64)
        counts = rng.integers(1, 9, grams.shape[1])
        level = ngrams.Level(*grams, counts, contexts)
        # Followers beyond the largest one, and contexts that nothing follows, are asked for too.
        context, follower = (x.ravel() for x in np.meshgrid(np.arange(contexts), np.arange(most + 70)))
        known = dict(zip(zip(*grams.tolist()), counts.tolist()))
        found, many = level.lookup(context, follower)
        assert found.tolist() == [known.get(k, 0) for k in zip(context.tolist(), follower.tolist())]
        assert many.tolist() == [sum(c == k for c, _ in known) for k in context.tolist()]
        assert level.pointers().tolist() == [sum(c < k for c, _ in known) for k in range(contexts + 1)]
