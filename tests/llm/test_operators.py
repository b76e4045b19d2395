"""Operators against brute force, round trips and held-out accuracy, and the
defined results for nulls, empty tables, repeated rows and clashing columns."""

from __future__ import annotations

import hashlib
import html
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

import corpus_pipeline as pipeline
from strata.llm import exact_dedup, graph, html_text, langid, licences, mixing, quality, sharding, simhash, spm, topk
from strata.llm import queries as registered

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty, blank, long, repeated and tied texts."""
    rows = [(1, "a b c", "s"), (2, " a\tb\nc ", None), (3, None, "s"), (4, "", "t"), (5, " \n", "t"), (6, "x" * 50_000, "s"), (7, "word " * 20_000, "u"),
            (8, "a b c", "s"), (8, "a b c", "s"), (None, "a b c", "s"), (None, None, None), (9, "Ünï ▁ 日本 \x00", "s")]
    return docs_of(spark, rows)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def model():
    return spm.read_model(pipeline.SENTENCEPIECE_MODEL)


# --- SentencePiece ---------------------------------------------------------

def test_ids_are_the_models_own(model):
    import sentencepiece

    sp, encoder = sentencepiece.SentencePieceProcessor(model_proto=model), spm.Encoder(spm.Vocabulary(model))
    rng = random.Random(1)
    texts = ["Hello  world", " a", "", "a b ", "x\ty\nz\x00q", "ﬁ Å é ½", "日本語 emoji😀", "\r\n", "a" * 3000, "日本" * 500, " " * 700 + "x", "▁▁ x"]
    texts += ["".join(rng.choice("abcdeféßñ日本 \n\t.,!0129  ABCtheing") for _ in range(rng.randint(1, 150))) for _ in range(400)]
    for text in texts:
        ids = np.frombuffer(encoder.encode(text), "<i4").tolist()
        assert ids == sp.encode(text)
        assert spm.decode_ids(ids, encoder.v.values) == sp.decode(ids) == text.replace("▁", " ")


def test_unigram_scores_are_summed(model):
    vocabulary = spm.Vocabulary(model)
    vocabulary.bpe = False  # the same pieces and scores, read as a unigram model
    encoder = spm.Encoder(vocabulary)
    for text in ("the quick brown fox", "anstther ingthe", "z" * 400, "thething" * 40):
        line, best = "▁" + text.replace(" ", "▁"), [0.0]
        for j in range(1, len(line) + 1):
            best.append(max(best[i] + vocabulary.scores[line[i:j]] for i in range(max(0, j - vocabulary.longest), j) if line[i:j] in vocabulary.scores))
        ids = np.frombuffer(encoder.encode(text), "<i4").tolist()
        assert "".join(vocabulary.pieces[i] for i in ids) == line and sum(vocabulary.weights[i] for i in ids) == best[-1]


def test_stream_commits_in_a_bounded_window(model):
    viterbi, whole = spm.Viterbi(spm.Vocabulary(model)), spm.Encoder(spm.Vocabulary(model))
    text, out, held = "▁" + "thething" * 2000, [], 0
    for i in range(0, len(text), 50):
        out += viterbi.feed(text[i:i + 50])
        held = max(held, len(viterbi.text))
    assert out + viterbi.finish() == np.frombuffer(whole.encode(text[1:]), "<i4").tolist()
    assert held <= 8 * viterbi.v.longest


def test_encode_and_decode_frames(awkward, nothing, model):
    back = spm.decode(spm.encode(awkward, model), model).collect()
    assert len(back) == awkward.count()
    assert all(r.decoded == (r.text or "").replace("▁", " ") and r.n_ids == len(r.ids) for r in back)
    trip = {r.doc_id: r.round_trip for r in spm.round_trip(awkward, model).collect()}
    assert trip[7] and trip[3] and not trip[9]  # U+2581 stands for a blank
    assert spm.round_trip(nothing, model).collect() == []


# --- exact dedup -----------------------------------------------------------

def brute_dedup(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t or "").encode()).hexdigest()].append((i, t or ""))
    return {h: (min(g, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))[0], len(g)) for h, g in groups.items()}


def test_exact_dedup_matches_brute_force(awkward, nothing):
    expected = brute_dedup([(r.doc_id, r.text) for r in awkward.collect()])
    got = exact_dedup.dedup(awkward.withColumnRenamed("lang", "digest"), exact_dedup.new_index(awkward)).collect()
    assert len(got) == awkward.count()
    assert all((r.keep_id, r.group_size) == expected[r.text_sha256] and r.kept == (r.doc_id == r.keep_id) for r in got)
    assert exact_dedup.dedup(nothing, exact_dedup.new_index(nothing)).count() == 0


def test_index_goes_on_with_later_batches(spark, tmp):
    index = exact_dedup.DigestIndex(spark, f"{tmp}/index", buckets=4)
    first = docs_of(spark, [(1, "a", "s"), (2, "b", "s")])
    exact_dedup.dedup(first, index).collect()
    again = {r.doc_id: r.kept for r in exact_dedup.dedup(first, index).collect()}
    later = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.dedup(docs_of(spark, [(3, " a ", "s"), (4, "c", "s")]), index).collect()}
    assert again == {1: True, 2: True} and later == {3: (1, False), 4: (4, True)}
    assert index.read().count() == 3
    spark.sql(f"DROP TABLE {index.name}")
    assert exact_dedup.DigestIndex(spark, f"{tmp}/index", buckets=4).read().count() == 3  # a later session


def test_dedup_stages_keep_one_row(awkward):
    kept = exact_dedup.keep_first(awkward, exact_dedup.new_index(awkward)).collect()
    texts = [re.sub(r"\s", "", r.text or "") for r in kept]
    assert len(texts) == len(set(texts)) == 5 and awkward.columns == list(kept[0].asDict())
    assert {r.doc_id for r in kept} >= {2, 6, 7, 9}


# --- sharding --------------------------------------------------------------

def test_shards_have_exact_sizes_and_whole_rows(spark, awkward, nothing):
    df = awkward.repartition(5)
    got = sharding.shard(df, 8, 3).collect()
    sizes = Counter(r.shard for r in got)
    assert sorted(sizes.values()) == [1] * 4 + [2] * 4
    for k, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == k) == list(range(n))
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r.doc_id, r.text) for r in awkward.collect())
    assert sharding.shard(nothing, 8).collect() == []
    assert {r.shard for r in sharding.shard(spark.range(3), 8).collect()} == {0, 1, 2}


def test_matrix_is_hypergeometric():
    draws = np.array([sharding.communication_matrix([6, 4], [5, 5], seed) for seed in range(3000)])
    assert (draws.sum(axis=1) == [5, 5]).all() and (draws.sum(axis=2) == [6, 4]).all()
    share = np.bincount(draws[:, 0, 0], minlength=6)[1:6] / 3000  # C(6,k) C(4,5-k) / C(10,5)
    assert np.abs(share - np.array([6, 60, 120, 60, 6]) / 252).max() < 0.03


def test_matrix_of_billions_of_rows():
    """Sizes beyond numpy's own limit of 10^9."""
    sizes, shards = [1_900_000_000, 40, 1_500_000_000, 1_800_000_000], [1_300_000_010] * 4
    draws = np.array([sharding.communication_matrix(sizes, shards, seed) for seed in range(60)])
    assert (draws.sum(axis=1) == shards).all() and (draws.sum(axis=2) == sizes).all() and (draws >= 0).all()
    rng, total = np.random.default_rng(5), 3_000_000_000
    for good, n in ((1_200_000_000, 50), (70, 900_000_000), (2_500_000_000, 400_000)):
        got = np.array([sharding.hypergeometric(rng, good, total - good, n) for _ in range(800)], dtype=float)
        mean, var = n * good / total, n * good / total * (1 - good / total) * (total - n) / (total - 1)
        assert abs(got.mean() - mean) < 5 * (var / 800) ** 0.5 and 0.75 < got.var() / var < 1.25


def test_every_place_is_as_likely(spark):
    df, seen = spark.range(0, 16, 1, 4), np.zeros((16, 2))
    for seed in range(30):
        for r in sharding.shard(df, 2, seed).collect():
            seen[r.id, r.shard] += 1
    assert (seen.sum(axis=0) == 240).all() and (np.abs(seen[:, 0] - 15) < 12).all()


def test_shards_are_written(spark, tmp):
    sharding.write_shards(spark.range(100), 3, f"{tmp}/shards", rows_per_file=10)
    back = spark.read.parquet(f"{tmp}/shards")
    assert back.count() == 100 and sorted(r["count"] for r in back.groupBy("shard").count().collect()) == [33, 33, 34]


# --- language ID -----------------------------------------------------------

def test_language_held_out_accuracy(spark):
    rows = registered.op4_language_id(spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_copies_take_no_share_of_the_training_texts(spark):
    """A language of a few texts with many copies, and rare texts beside hot ones, are learned whole."""
    once = [(f"le chat et le chien {i}", "fr") for i in range(5)] + [(f"the cat and the dog ran {'up' * i}", "en") for i in range(60)] + [("der hund und die katze", "de")]
    copies = once[:5] * 400 + once[5:6] * 3000 + once[6:]
    few, many = (langid.fit(spark.createDataFrame(rows, "text string, lang string"), sample_per_lang=60) for rows in (once, copies))
    whole = langid.fit(spark.createDataFrame(once, "text string, lang string"), sample_per_lang=1 << 20)
    for model in (few, many):
        assert model.langs == whole.langs and np.allclose(model.centroids, whole.centroids, atol=1e-5)


def test_language_edges(spark, awkward, nothing):
    empty = langid.fit(nothing)
    assert {r.lang_pred for r in langid.identify(awkward, empty).collect()} == {"und"}
    two = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de"), ("x", None), (None, "fr")], "text string, lang string")
    m = langid.fit(two)
    got = {r.text: r for r in langid.identify(spark.createDataFrame([("the dog",), ("die katze",), ("12 !",), ("",), (None,)], "text string"), m).collect()}
    assert got["the dog"].lang_pred == "en" and got["die katze"].lang_pred == "de"
    assert all(got[t].lang_pred == "und" and got[t].score == 0 and got[t].rejected for t in ("12 !", "", None))
    assert langid.identify(nothing, m).count() == 0


# --- SimHash ---------------------------------------------------------------

def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    ones = Counter(b for g in grams for b in range(64) if xxhash.xxh64(g, seed=42).intdigest() >> b & 1)
    return sum(1 << b for b, n in ones.items() if 2 * n > len(grams))


def test_fingerprints_match_brute_force(spark, awkward):
    got = simhash.near_dedup(awkward).collect()
    assert all(int(r.fingerprint, 16) in {brute_fingerprint(t.text) for t in awkward.collect()} and len(r.fingerprint) == 16 for r in got)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    own = {r.doc_id: r.fingerprint for r in registered.op5_simhash(spark, SF).collect()}
    assert all(own[r.doc_id] == f"{brute_fingerprint(r.text):016x}" for r in docs.collect())


def test_multi_index_finds_every_pair(spark):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(40)}
    for f in list(fps):
        for _ in range(6):
            g = f
            for b in rng.sample(range(64), rng.randint(1, 3)):
                g ^= 1 << b
            fps.add(g)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    for limit in (0, 1, 2):
        found = {frozenset((r.a, r.b)) for r in simhash.near_pairs(frame, limit).collect()}
        assert found == {frozenset((a, b)) for a in signed for b in signed if a != b and ((a ^ b) & (1 << 64) - 1).bit_count() <= limit}


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(200, 200), (7, 7)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_near_dedup_edges(awkward, nothing):
    rows = simhash.near_dedup(awkward).collect()
    assert len(rows) == awkward.count()
    by = defaultdict(set)
    for r in rows:
        by[r.component_id].add(r.doc_id)
    assert by[1] == {1, 2, 8, None} and {3, 4, 5, None} <= by[3]
    kept = simhash.keep_one(awkward).collect()
    assert len(kept) == len(by) and simhash.near_dedup(nothing).count() == 0


# --- quality ---------------------------------------------------------------

def test_quality_held_out(spark):
    rows = {r.doc_id: r for r in registered.op6_quality(spark, "/root/testdata/sf0.01").collect()}
    labels = [r for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect() if rows[r.doc_id].held_out]
    good = [rows[r.doc_id].predicted for r in labels if r.quality == 1]
    bad = [rows[r.doc_id].predicted for r in labels if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.2
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    x, starts, y = rng.normal(size=(7, 5)), np.array([0, 3]), np.array([1.0, 0.0])
    p = {"W": rng.normal(size=(5, 4)), "b": rng.normal(size=4), "V": rng.normal(size=(4, 3)), "U": rng.normal(size=(4, 3)), "w": rng.normal(size=3), "c": rng.normal(size=4), "d": np.array(0.1)}

    def loss(q):
        s = quality._forward(q, x, starts)["y"]
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).sum()

    f = quality._forward(p, x, starts)
    for name, g in quality._gradients(p, x, f, starts, f["y"] - y).items():
        for at in np.ndindex(p[name].shape):
            step = np.zeros_like(p[name])
            step[at] = 1e-6
            assert abs((loss(p | {name: p[name] + step}) - loss(p | {name: p[name] - step})) / 2e-6 - np.asarray(g)[at]) < 1e-5


def test_quality_edges(spark, awkward, nothing):
    none = quality.fit(nothing, spark.createDataFrame([], "doc_id long, quality int"))
    scored = quality.score(awkward, none).collect()
    assert len(scored) == awkward.count() and {r.score for r in scored} == {1.0}
    assert quality.passages(None).shape == (1, quality.N_FEATURES) and len(quality.passages("w " * 1000)) == 16
    clash = awkward.withColumnRenamed("lang", "score")
    assert quality.keep_good(clash, none).columns == clash.columns
    assert quality.score(nothing, none).count() == 0


# --- HTML ------------------------------------------------------------------

def test_pages_give_their_article(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    got = {r.page_id: r for r in registered.op7_html_text(spark, "/root/testdata/sf0.01").collect()}
    for p in pages:
        body = re.search(r"<article>(.*?)(</article>|$)", p.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)\b[^>]*>", body))
        assert got[p.page_id].text == "\n".join(b for b in blocks if b) and got[p.page_id].n_chars == len(got[p.page_id].text)


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1><a href=/>Home</a></header>
<nav><ul><li><a href=/a>A menu of things, long, long, long, long</a></ul></nav><div class="cookie-notice"><p>We use cookies, as all do, to track, to sell, to please.</p></div>
<div id=page><aside class=x><p>Side, side, side, side, side.</p></aside><div class="post"><h2>Title &amp; more</h2><p>First  paragraph, with <b>bold</b> &lt;words&gt;,
and commas, many.<p>Second one<br>goes on, and on, after a break.<ul><li>one</li><li>two</li></ul><div class="ad-box"><p>Buy, buy, buy, buy, buy!</p></div>
<form><p>Your name, please, and more, and more</p><input></form><script>var a = "<p>no</p>";</script></div>
<section id="comments"><h3>Comments</h3><p>I, a reader, think, that this is, well, long, and great.</p></section></div><footer><p>Imprint, terms, privacy, all, rights, reserved.</p></footer>"""


def test_tree_scoring_leaves_furniture_out():
    assert html_text.main_text(PAGE).split("\n") == [
        "Title & more", "First paragraph, with bold <words>, and commas, many.", "Second one goes on, and on, after a break.", "one", "two"]


def test_articles_are_taken_whole():
    """Unequal sections, headings, lists and bare text of one article."""
    long, words = "A long sentence, with commas, and more, and so on, and on. " * 60, "x " * 150
    first, second = f"<section><p>{long}</p><p>{long}</p></section>", f"<section><p>{words}, and, more</p></section>"
    inner = f"<h1>Title</h1>{first}<h2>Part two</h2>{second}<ul><li>one</li><li>two</li></ul><table><tr><td>cell</td></tr></table>bare text here<p>End</p>"
    want = ["Title", long.strip(), long.strip(), "Part two", f"{words.strip()} , and, more", "one", "two", "cell", "bare text here", "End"]
    for box in ("article", "main", "div"):
        page = f"<html><body><nav>menu</nav><{box}>{inner}</{box}><footer>imprint</footer></body></html>"
        assert html_text.main_text(page).split("\n") == want, box
    links = "<div>" + "<a href=/x>other story, told, here</a> " * 9 + "</div>"
    assert html_text.main_text(f"<body><div>{first}{links}<p>Tail.</p></div></body>").split("\n") == [long.strip()] * 2 + ["Tail."]


def test_furniture_ends_where_html_says():
    for page in ("<div><p class=byline>By <b>X<p>Para 1<p>Para 2</div><p>Para 3</p>", "<ul><li class=share>Share<li>Para 1<li>Para 2</ul><p>Para 3</p>",
                 "<div><div><span class=ad>Buy</div><p>Para 1</p><p>Para 2</p></div><p>Para 3</p>", "<article><table><tr class=ads><td>Buy<tr><td>Para 1<td>Para 2</table><p>Para 3",
                 "<p>Para 1<svg class=i /><p>Para 2</p><iframe src=\"/x\"/><p>Para 3</p>", "<svg/><title-bar><p>Para 1</p></title-bar><p>Para 2</p><p>Para 3",
                 "<div class='site has-sidebar'><div class='content with-comments' id=page_no-sidebar><p>Para 1</p><p>Para 2</p><p>Para 3</p></div><div class=sidebar>Side</div></div>",
                 "<div class=content-sidebar-wrap><p>Para 1</p><p>Para 2</p><p>Para 3</p><div class='left-sidebar'>Side</div><div class=post-share-buttons>Tell</div></div>"):
        assert html_text.main_text(page).split("\n") == ["Para 1", "Para 2", "Para 3"], page
    for box in ("class=ad-box", "class='x cookie-notice'", "id=comments", "class=site-header", "class=widget_area", "role=navigation"):
        assert html_text.main_text(f"<div {box}><p>Buy, now.<p>More</div><p>Text.</p>") == "Text.", box
    assert html_text.main_text("<div><nav><table><tr><td>Menu</div>still menu</td></tr></table></nav><p>Text.</p></div>") == "Text."


def test_no_article_is_lost_to_a_name():
    one, two = "A first paragraph, with commas, and quite some words in it, as text has.", "A second paragraph, which goes on, and ends the text."
    art, want = f"<p>{one}</p><p>{two}</p>", [one, two]
    around = ('div style="overflow: hidden"', 'div data-note="a hidden thing"', 'div data-x="my class=menu"', "div data-x='role=navigation id=menu'", 'form id="aspnetForm" action="/x"',
              'div class="bg-navy"', 'div class="social-history"', 'div class="navy-theme share-prices"', 'div class="overlay"', 'section id="tags"', "div title='a > b hidden'")
    for box in around:
        name = box.split()[0]
        for inner in (art, f"<article>{art}</article>", f"<div class=c>{art}</div>"):
            for page in (f"<{box}>{inner}</{name}>", f"<body><nav><a href=/>Menu</a></nav><{box}><div class=sidebar>Side.</div>{inner}<input value=x></{name}><footer>Imprint</footer>"):
                assert html_text.main_text(page).split("\n") == want, page
    for box in ("class=share-prices", "class='social-history'", "id=notice-board-history"):
        assert html_text.main_text(f"<article>{art}<section {box}><p>Prices rose.</p></section></article>").split("\n") == [*want, "Prices rose."], box
    assert html_text.main_text(f"<div><div class=post><header><h1>Title</h1></header>{art}</div></div>").split("\n") == ["Title", *want]
    stories = "<h2>More stories</h2><ul>" + "".join(f"<li><a href=/{i}>Another story, number {i}, is here</a></li>" for i in range(6)) + "</ul>"
    for main in (f"<main>{art}{stories}</main>", f"<main><div>{art}</div><div>{stories}</div></main>", f"<main><h1>Title</h1>{art}<section>{stories}</section><p>End.</p></main>"):
        got = html_text.main_text(f"<body><nav>x</nav>{main}<footer>y</footer>").split("\n")
        assert got in ([*want], ["Title", *want, "End."]), main
    long = "I, a reader, think, that this is, well, long, and great, and so on, and on. " * 30
    for box in ("id=comments", "class='post-comments'", "class=comment-list", "class='cookie-consent'"):  # however long
        assert html_text.main_text(f"<div class=post>{art}<div {box}><p>{long}</p></div></div>").split("\n") == want, box
    assert html_text.main_text(f"<div>{art}<form><p>Your name, please, and your address, and what you think.</p><input></form></div>").split("\n") == want


def test_html_edges(spark):
    for page in (None, "", "<", "<p", "&", "<html><body></body></html>", "<!-- <p>x</p>", "</div></p>"):
        assert html_text.main_text(page) in ("", "<", "&")
    assert html_text.main_text("<p>a &amp;lt; b") == "a &lt; b"
    assert html_text.main_text("<div>" * 3000 + "deep, deep") == "deep, deep"
    assert html_text.main_text("plain text, no tags") == "plain text, no tags"
    frame = spark.createDataFrame([(1, "<p>x</p>", "m"), (1, None, None)], "page_id long, html string, main_text string")
    assert [r.main_text for r in html_text.extract(frame).collect()] == ["x", ""] and html_text.extract(frame.limit(0)).count() == 0


# --- top-k -----------------------------------------------------------------

def brute_top(rows, asked, k):
    out = []
    for qi, qv in asked:
        best = sorted((-(np.dot(qv, v)), i) for i, v in rows if i != qi and len(v) == len(qv))[:k]
        out += [(qi, n + 1, i, -int(s)) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("rows_per_shard", [10_000, 60])
def test_search_is_exact_with_ties(spark, rows_per_shard):
    rng = np.random.default_rng(2)
    vectors = [[int(x) for x in rng.integers(-9, 9, 6)] for _ in range(300)] + [[3, 1, 4, 1, 5, 9]] * 200 + [[1, 2]] * 3 + [[]]
    rows = list(enumerate(vectors))
    frame = spark.createDataFrame(rows, "id long, v array<long>")
    asked = [r for r in rows if r[0] % 7 == 0 or r[0] > 498]
    got = topk.search(frame, spark.createDataFrame(asked, "id long, v array<long>"), 5, rows_per_shard).collect()
    assert sorted(tuple(r) for r in got) == brute_top(rows, asked, 5)


def test_search_edges(spark):
    frame = spark.createDataFrame([(1, [0.5, float("nan")]), (2, None), (3, [None, 1.0]), (4, [0.25, -0.001])], "id long, e array<float>")
    assert [r.v for r in frame.select(topk.quantise("e" and frame.e).alias("v")).collect()] == [None, None, None, [64, -1]]
    none = spark.createDataFrame([], "id long, v array<long>")
    one = spark.createDataFrame([(1, [1, 2]), (1, [5, 5])], "id long, v array<long>")
    assert topk.search(none, none, 5).collect() == [] and topk.search(one, one, 5).collect() == []
    assert topk.search(none, one, 5).collect() == []
    big = spark.createDataFrame([(1, [1 << 30, 1]), (2, [1 << 30, 2]), (3, [1 << 30, 3])], "id long, v array<long>")
    assert [(r.vec_id, r.score) for r in topk.search(big, big.where("id = 1"), 2).collect()] == [(3, (1 << 60) + 3), (2, (1 << 60) + 2)]


# --- licences --------------------------------------------------------------

def test_licences_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    marks = {"gpl": "GNU General Public License", "cc-by-nc": "CC BY-NC", "mit": "MIT License", "apache": "Apache License"}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in registered.op9_licences(spark, "/root/testdata/sf0.01").collect():
        assert r.licences == sorted(f for f, m in marks.items() if m in texts[r.doc_id])
        assert all(marks[s.family] in texts[r.doc_id][s.start:s.end] for s in r.spans)


def test_licence_texts_and_strangers(awkward, nothing, spark):
    m = licences.train([])
    for family, texts in licences.TEMPLATES.items():
        assert family in {s["family"] for t in texts for s in m.scan("Some words.\n" + t)}
    for text in (*licences.OTHER, "the the the", "MIT is a university in Cambridge where many people study all day", None, ""):
        assert m.scan(text) == []
    buried = "lorem ipsum dolor " * 40 + "Licensed under the Apache License, Version 2.0. " + "sit amet " * 40
    assert {s["family"] for s in m.scan(buried)} <= {"apache"}
    assert all(r.licences == [] and r.spans == [] for r in licences.scan(awkward, m).collect())
    assert licences.scan(nothing, licences.fit(nothing)).count() == 0


def test_statements_amid_prose_are_found(spark):
    """One sentence of a long line, and of a line of under 48 words."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    m = licences.fit(docs)
    prose = [w for r in docs.where("lang = 'en'").orderBy("doc_id").limit(40).collect() for w in (r.text or "").replace("\n", " ").split()]
    cases = {"Released under the MIT License.": "mit", "Licensed under the Apache License, Version 2.0.": "apache", "This work is licensed under CC BY-NC 4.0.": "cc-by-nc",
             "This project is made available under the GNU Affero General Public License.": "agpl", "released under the GNU Lesser General Public License, version 2.1": "lgpl"}
    for k, (statement, family) in enumerate(cases.items()):
        for size in (200, 40):
            for shift in range(0, 60, 7):
                words = prose[500 * k + shift:500 * k + shift + size]
                cut = size // 2 - 6 + shift % 13
                text = " ".join([*words[:cut], statement, *words[cut:]])
                got = m.scan(text)
                assert [s["family"] for s in got] == [family] and statement.rstrip(".") in text[got[0]["start"]:got[0]["end"]], (text, got)
    both = " ".join([*prose[:70], "Released under the MIT License.", *prose[70:74], "Licensed under the Apache License, Version 2.0.", *prose[74:150]])
    assert {s["family"] for s in m.scan(both)} == {"mit", "apache"}
    assert m.scan("The guide said that a prisoner was released under the supervision of a manager, and you may use it under the roof of the hall for free today.") == []


# --- mixing ----------------------------------------------------------------

def brute_windows(weights, blocks):
    """Lag of each class after each slot of the first phase stays below one."""
    phases = mixing.schedule(weights, blocks)
    first, order = phases[0], mixing.period(phases[0]["weights"])
    length, total = max(sum(first["took"].values()), 1), first["total"]
    seen = Counter()
    for t in range(length):
        seen[order[t % total]] += 1
        for c, w in first["weights"].items():
            assert abs(seen[c] - w * (t + 1) / total) < 1
    return phases


def test_pfair_lag_and_whole_blocks():
    rng = random.Random(4)
    for _ in range(60):
        weights = {f"s{i}": rng.randint(1, 30) for i in range(rng.randint(1, 7))} | {mixing.OTHER: rng.randint(1, 9)}
        blocks = {c: rng.randint(0, 90) for c in weights}
        phases = brute_windows(weights, blocks) if any(blocks.values()) else mixing.schedule(weights, blocks)
        assert {c: sum(p["took"].get(c, 0) for p in phases) for c in blocks} == blocks
    assert mixing.schedule({mixing.OTHER: 1}, {}) == []


def test_mix_places_every_row_once(spark, awkward, nothing):
    weights = {"s": 3, "u": 1, mixing.OTHER: 2}
    got = mixing.mix(awkward, weights, block_rows=2).collect()
    assert len(got) == awkward.count() and len({(r.slot, r.place) for r in got}) == len(got)
    assert {r["class"] for r in got} == {"s", "u", mixing.OTHER} and all(r.release <= r.slot < r.deadline for r in got)
    slots = defaultdict(set)
    for r in got:
        slots[r.slot].add(r["class"])
    assert all(len(c) == 1 for c in slots.values()) and sorted(slots) == list(range(len(slots)))
    assert mixing.mix(nothing, weights).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(awkward, {"s": 1})


def test_mixed_order_keeps_all_rows(awkward):
    weights = {"s": 3, mixing.OTHER: 1}
    out = mixing.in_mixed_order(awkward, weights, block_rows=1)
    assert out.columns == awkward.columns
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter((r.doc_id, r.text) for r in awkward.collect())


# --- pipeline --------------------------------------------------------------

def test_pipeline_matches_its_parts(spark, model):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = [r for r in docs.collect() if good.scores([quality.passages(r.text)])[0] >= 0.3]
    keep = {k for k, _ in brute_dedup([(r.doc_id, r.text) for r in rows]).values()}
    rows = sorted((r for r in rows if r.doc_id in keep), key=lambda r: r.doc_id)
    prints, kept, root = [brute_fingerprint(r.text) for r in rows], [], list(range(len(rows)))
    for _ in rows:
        root = [min(root[j] for j in range(len(rows)) if (prints[i] ^ prints[j]).bit_count() <= 2) for i in range(len(rows))]
    kept = {r.doc_id: r.text for i, r in enumerate(rows) if root[i] == i}
    got = pipeline.run(spark, SF).collect()
    assert {r.doc_id: r.ids for r in got} == {i: sp.encode(t) for i, t in kept.items()} and all(r.round_trip for r in got)


def test_pipeline_rows_tell_the_mix(spark):
    """Sorted by slot and place, run()'s own rows interleave the sources by the weights, less than one block off."""
    got = sorted(pipeline.run(spark, "/root/testdata/sf0.01").collect(), key=lambda r: (r.slot, r.place))
    assert len({(r.slot, r.place) for r in got}) == len(got) > 16
    rows, of = Counter(), {}
    for r in got:
        c = r.source if r.source in pipeline.TARGET_WEIGHTS else mixing.OTHER
        rows[c] += 1
        assert of.setdefault(r.slot, c) == c
    assert sorted(of) == list(range(len(of)))
    blocks = {c: -(-n // 16) for c, n in rows.items()}
    weights = {c: w for c, w in pipeline.TARGET_WEIGHTS.items() if c in blocks}
    seen, total = Counter(), sum(weights.values())
    for t in range(len(of)):
        seen[of[t]] += 1
        assert all(abs(seen[c] - w * (t + 1) / total) < 1 for c, w in weights.items())
        if any(seen[c] == blocks[c] for c in weights):  # from here on, fewer sources share the channel
            break
    assert seen.total() > 1 and Counter(of.values()) == blocks


def test_pipeline_stages_keep_columns(spark, awkward):
    extra = awkward.withColumnRenamed("n_chars", "rid")
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, extra, SF)
        assert out.columns == extra.columns, name
        assert out.count() > 0
        assert stage(spark, extra.limit(0), SF).count() == 0


def test_html_text_cost_grows_with_the_page():
    """Many siblings, deep nesting and stray end tags: no step walks the page once per element."""
    pages = ["<div>" + "<p>word word, word.</p>" * 30_000 + "</div>", "<div>" * 30_000 + "x, y" + "</div>" * 30_000,
             "<div>" * 30_000 + "</section>" * 30_000, "<nav>" + "<p>" * 30_000 + "</q>" * 30_000]
    start = time.monotonic()
    texts = [html_text.main_text(p) for p in pages]
    assert time.monotonic() - start < 20
    assert texts[0].count("\n") == 29_999 and texts[1:] == ["x, y", "", ""]


def test_training_samples_count_copies_once(spark):
    """A text with copies in a third of the rows doesn't swell the sample that the driver holds."""
    words = {"en": "the cat and the dog ran over the hill", "fr": "le chat et le chien dans la rue"}
    rows = [(f"{words[lang]} {i}", lang) for lang in words for i in range(60)]
    copies = [("the same text again and again", "en")] * 400
    once = langid.fit(spark.createDataFrame(rows + copies[:1], "text string, lang string"), sample_per_lang=1 << 20)
    many = langid.fit(spark.createDataFrame(rows + copies, "text string, lang string"), sample_per_lang=1 << 20)
    assert once.langs == many.langs and np.allclose(once.centroids, many.centroids, atol=1e-5)
