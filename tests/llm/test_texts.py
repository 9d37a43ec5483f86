"""Language ID, quality classifier, packing, HTML extraction, chat formatting."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairforge.llm import chat_formatting, language_id, packing, quality_rules_model, queries, site_style_tree

SF = "/root/testdata/sf0.001"


def test_language_id_held_out_accuracy(spark):
    out = queries.op2_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = out.filter("held_out").agg(F.count("*"), F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert held[0] > 100 and held[1] >= 0.98


def test_language_id_statistics_cover_all_rows(spark):
    rows = [(i, f"common words and {'zqx' if i % 10 == 0 else 'more'}", "en") for i in range(400)] + [(1000 + i, "mots communs", "fr") for i in range(400)] + [(2000, None, "fr"), (2001, "12", "fr"), (None, "lost", "fr")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    few, all_ = language_id.fit(df, sample=8, centroids=1), language_id.fit(df, sample=10000, centroids=1)
    assert np.array_equal(few["idf"], all_["idf"])
    counts = np.concatenate([c for _, c, _ in language_id._groups([t for i, t, _ in rows if i is not None and t not in (None, "12")])])
    assert np.allclose(few["idf"], np.log(801 / (1 + (counts > 0).sum(axis=0))) + 1)
    x = language_id._unit(language_id._weights(np.concatenate([c for _, c, _ in language_id._groups([t for _, t, k in rows if k == "en"])])) * few["idf"])
    ids, values = few["c"][few["langs"].index("en")]
    cos = np.sort(x[:, ids] @ values)
    assert abs(few["least"][few["langs"].index("en")] - language_id.REJECT * cos[3]) < 1e-4


def test_language_id_learns_every_label(spark):
    """More labels than any bound of the sample: a label with a script of its own is predicted for its texts."""
    rows = [(i, " ".join(chr(0x4E00 + 3 * (i % 700) + j) * 3 for j in range(3)), f"lang{i % 700}") for i in range(2800)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(df, sample=50)
    assert len(model["langs"]) == 700 and len(model["c"]) > language_id.BLOCK
    got = language_id.predict(df, model).join(df.select("doc_id", "lang"), "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert got > 0.95


def test_language_id_odd_rows(odd, none, spark):
    model = language_id.fit(odd.select("doc_id", "text", "lang"))
    got = language_id.predict(odd, model).collect()
    assert len(got) == odd.count()
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (3, 4, 5))
    assert all(0 <= r.score <= 1 and r.lang_pred in ("en", "fr", "de", "und") for r in got)
    blank = language_id.predict(odd, language_id.fit(none.select("doc_id", "text", "lang")))
    assert {r.lang_pred for r in blank.collect()} == {"und"}
    assert language_id.predict(none, model).count() == 0


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.op4_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out")
    n, right = out.agg(F.count("*"), F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()
    assert n > 50 and right >= 0.95


def test_quality_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (6, None), (7, 0)], "doc_id long, quality int")
    model = quality_rules_model.fit(odd, labels)
    got = quality_rules_model.score(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    one = quality_rules_model.fit(odd, labels.filter("quality = 1"))
    assert all(r.score > 0.5 for r in quality_rules_model.score(odd, one).collect())
    empty = quality_rules_model.fit(none, labels)
    assert [round(r.score, 6) for r in quality_rules_model.score(odd, empty).limit(1).collect()] == [0.5]
    assert quality_rules_model.score(none, model).count() == 0


def test_quality_rules_are_found():
    rng = np.random.default_rng(0)
    s = rng.random((2000, len(quality_rules_model.STATISTICS)))
    y = ((s[:, 2] > 0.6) | ((s[:, 5] < 0.3) & (s[:, 9] > 0.5))).astype(float)
    model = quality_rules_model.fit_arrays(s, y)
    assert model.rules and len(model.describe()) == len(model.rules)


def test_packing_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path("word_bpe_49k.json"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pieces = packing.pack(docs, path, most=256).toPandas()
    assert pieces.sequence_id.is_unique and set(pieces.offset) == {0}
    assert all(n & (n - 1) == 0 and n <= 256 for n in pieces.length)
    tokenizer = Tokenizer.from_file(path)
    texts = dict(docs.select("doc_id", "text").collect())
    for doc_id, g in pieces.groupby("doc_id"):
        g = g.sort_values("start")
        want = np.array([*tokenizer.encode(texts[doc_id], add_special_tokens=False).ids, packing.END_ID], dtype="<u4").tobytes()
        assert b"".join(g.ids) == want and list(g.start) == [0, *g.length.cumsum()[:-1]]
        assert set(g.doc_tokens) == {len(want) // 4}


def test_packing_odd_rows(odd, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path("word_bpe_49k.json"))
    got = packing.pack(odd, path).collect()
    assert {r.doc_tokens for r in got if r.doc_id in (3, 4, 5)} == {1}
    seven = b"".join(bytes(r.ids) for r in sorted((r for r in got if r.doc_id == 7), key=lambda r: r.start))
    text = odd.filter("doc_id = 7").first().text
    assert seven == np.array([*Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, 2], dtype="<u4").tobytes()
    assert sum(r.length for r in got if r.doc_id == 1) == 2 * next(r.doc_tokens for r in got if r.doc_id == 1)
    assert packing.pack(none, path).count() == 0
    with pytest.raises(ValueError):
        packing.pack(odd, path, most=100)


def test_packing_lengths():
    assert packing.lengths(9000) == [4096, 4096, 512, 256, 32, 8] and packing.lengths(1) == [1]


def test_packing_buckets(odd, spark, tmp_path):
    import public_tokenizers

    pieces = packing.pack(odd, str(public_tokenizers.path("word_bpe_49k.json")))
    packing.write_buckets(pieces, str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert back.filter("bucket <> length").count() == 0 and back.count() == pieces.count()


PAGE = (
    "<html><head><title>T</title><style>p{{}}</style></head><body><header>Site</header><nav><ul><li>Menu</li></ul></nav><div class='cookie-banner'>We use cookies</div>"
    "<div class=promo-x>Same for all</div><div class=story><h1>Head {i}</h1><p>First &amp; {i}<br>line<p>Second\n  &eacute; {i}</div>"
    "<div id=comments><p>nice {i}</p></div><form><input>Sign up</form><script>var t='</p>'; {i}</script><aside>Side</aside><footer>Foot</footer></body></html>"
)


def test_html_template_goes_and_content_stays(spark):
    rows = [(i, "https://u:p@Host.example:8080/x", PAGE.format(i=i)) for i in range(12)] + [(50, None, None), (51, "::bad", ""), (52, "https://host.example/y", "<p>only <b>this</b>"), (None, "https://host.example/z", "plain text")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("host", F.lit("clash"))
    got = {r.page_id: r.text for r in site_style_tree.extract(df).collect()}
    for i in range(12):
        assert got[i] == f"Head {i}\n\nFirst & {i} line\n\nSecond é {i}"
    assert got[50] == got[51] == "" and got[52] == "only this" and got[None] == "plain text"
    assert site_style_tree.extract(df.limit(0)).count() == 0


def test_html_articles_of_the_fixture(spark):
    import html
    import re

    out = queries.op5_html_extraction(spark, SF).toPandas()
    pages = dict(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect())
    for i, text, n in zip(out.page_id, out.text, out.n_chars, strict=True):
        body = re.search(r"<article>(.*)</article>", pages[i], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert text == "\n\n".join(b for b in blocks if b) and n == len(text)


def test_html_markup_is_weighed_against_the_tree(spark):
    article = (
        "<div class=ad-x>Buy {i}</div><article><h1>Head {i}</h1><p>Body {i}</p><section id='related-work'><p>Others {i}</p></section><p class='notice-period'>Until {i}</p>"
        "<div class=author><p>We write</p></div><section class='share-box'>Tell all</section><aside>Side {i}</aside></article><main><div class=licence>Free</div><p>More {i}</p></main>"
    )
    rows = [(i, "https://a.example/x", article.format(i=i)) for i in range(20)]
    rows += [(100 + i, "https://a.example/copy", article.format(i=7).replace("Buy 7", f"Buy {i}")) for i in range(200)]
    rows += [(500 + i, "https://b.example/copy", article.format(i=7).replace("Side 7", f"Side {i}")) for i in range(20)]
    got = {r.page_id: r.text for r in site_style_tree.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in [*range(20), *range(100, 300)]:
        k = i if i < 20 else 7
        assert got[i] == f"Head {k}\n\nBody {k}\n\nOthers {k}\n\nUntil {k}\n\nMore {k}"
    assert all("Head 7\n\nBody 7\n\nOthers 7\n\nUntil 7" in got[500 + i] for i in range(20))


@pytest.mark.parametrize("attrs", ['style="overflow:hidden"', 'title="hidden gems"', 'data-hidden="false"', "data-id='share-1'", 'data-x="a" data-class=ad', "x=class=ad", 'aria-hidden="false"'])
def test_html_attributes_are_compared_whole(attrs):
    blocks, _ = site_style_tree._Parser().parse(f"<div {attrs}><article><p>Text</p></article></div><div title='a' hidden>Not</div><div CLASS = 'x ad'>Nor</div>")
    assert [(text, bool(noise)) for _, text, noise, _ in blocks] == [("Text", False), ("Not", True), ("Nor", True)]


def test_html_hosts_of_few_pages(spark):
    page = "<div class=top>Our shop</div><article><h1>News</h1><p>Body {0}</p></article><div class=text>Story {0}</div>"
    rows = [(10 * n + i, f"https://h{n}.example/", page.format(i)) for n in (1, 2, 3, 4) for i in range(n)]
    for r in site_style_tree.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect():
        i = r.page_id % 10
        assert r.text == ("Our shop\n\n" if r.page_id < 20 else "") + f"News\n\nBody {i}\n\nStory {i}"


def _kept(page, low=None):
    p, s = site_style_tree._Parser(), site_style_tree
    blocks, _ = p.parse(page)
    return [t for path, t, noise, content in blocks if (low or {}).get(path, 1.0) + noise + s.CONTENT * (content and noise > s.DECLARED) >= s.LEAST]


def test_html_deep_elements_keep_their_ancestors():
    for n in (10, 450, 1000):
        assert _kept("<div>" * n + "<nav>menu</nav><p>text</p>" + "</div>" * n + "<p>after</p><nav>no</nav>") == ["text", "after"], n
    assert _kept("<article>" + "<b>" * 2000 + "deep" + "</b>" * 2000 + "</article><footer>f</footer>") == ["deep"]
    assert _kept("<div>" * 500 + "</nav>" * 50_000 + "<p>x") == ["x"]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ('<article><p style="overflow:hidden">A</p></article>', ["A"]),
        ('<article><p title="a hidden gem">A</p></article>', ["A"]),
        ('<article><p data-id="ad-3">A</p></article>', ["A"]),
        ('<body><div class="entry-header"><h1>A</h1></div><p>b</p></body>', ["A", "b"]),
        ('<body><div class="content has-sidebar"><p>A</p></div><div class="sidebar">s</div></body>', ["A"]),
        ('<body><div class="comment-list"><p>c</p></div><div id="site-footer">f</div><p>A</p></body>', ["A"]),
        ('<body><p hidden>h</p><p aria-hidden="true">h</p><p role="search">h</p><p>A</p></body>', ["A"]),
    ],
)
def test_html_names_of_states_and_titles_are_no_noise(page, want):
    assert _kept(page) == want


def test_html_repeated_title_bars_go_by_the_tree(spark):
    pages = [(i, f"http://t.example/{i}", f'<body><div class="page-header">Shop of the year</div><div class="entry-header"><h1>Title {i}</h1></div><p>Text {i}</p></body>') for i in range(12)]
    got = site_style_tree.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {i: f"Title {i}\n\nText {i}" for i, _, _ in pages}


def test_very_long_texts(spark):
    """One text of 400,000 words beside a short one, through every operator that reads texts whole."""
    import public_tokenizers

    from pairforge.llm import mcd_quality, simhash

    text = " ".join(f"w{i % 5000}" for i in range(400_000))
    docs = spark.createDataFrame([(1, text, "en", "s"), (2, "one short text", "en", "s"), (3, None, None, None)], "doc_id long, text string, lang string, source string")
    model = language_id.fit(docs)
    assert {r.doc_id: r.lang_pred for r in language_id.predict(docs, model).collect()} == {1: "en", 2: "en", 3: "und"}
    s = {r.doc_id: r for r in quality_rules_model.with_statistics(docs.select("doc_id", "text")).drop("text").collect()}
    assert round(np.expm1(s[1].s_words)) == 400_000 and round(s[1].s_distinct * 400_000) == 5000 and s[3].s_words == 0
    m = {r.doc_id: r for r in mcd_quality.judge(docs).collect()}
    assert (m[1].n_words, m[1].word_chars, m[1].n_repeat_words, m[1].base_failed) == (400_000, len(text) - 399_999, 400_000, True)
    p = packing.pack(docs, str(public_tokenizers.path("word_bpe_49k.json"))).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()
    assert all(r.n == r.t for r in p) and {r.doc_id for r in p} == {1, 2, 3} and max(r.n for r in p) > 400_000
    near = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs.union(docs.selectExpr("doc_id + 10", "text", "lang", "source"))).collect()}
    assert near == {1: 1, 2: 2, 3: 3, 11: 1, 12: 2, 13: 3}
    page = spark.createDataFrame([(1, "http://h.example/", f"<body><nav>menu</nav><article><p>{text}</p></article></body>")], "page_id long, url string, html string")
    assert site_style_tree.extract(page).first().text == text


def test_chat_collapse(spark):
    rows = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", "yo"), (3, 0, "user", "hi"), (3, 1, "assistant", "yo"), (3, 2, "user", "more"), (4, 0, "user", "hi"), (4, 1, "assistant", "no <|im_end|>")]
    rows += [(5, 0, "user", "hi"), (5, 1, "assistant", "yo"), (5, 2, "user", "more"), (6, None, None, None), (6, None, None, None), (None, 0, "user", "lost"), (7, 1, "user", "b"), (7, 0, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit("clash")).withColumn("whole", F.lit("clash"))
    got = {r.conv_id: (r.n_turns, r.rendered) for r in chat_formatting.format_conversations(df).collect()}
    assert set(got) == {3, 4, 6, 7}
    assert got[3] == (3, "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n<|im_start|>user\nmore<|im_end|>\n")
    assert got[4][1].count("<|im_end|>") == 2 and got[6][0] == 1 and got[7][1].index("a") < got[7][1].index("\nb")
    assert chat_formatting.format_conversations(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page, want",
    [
        ('<form id="aspnetForm"><div><article><p>whole page</p></article></div></form>', ["whole page"]),
        ("<form id=f><h1>Title</h1><p>" + "main text " * 20 + "</p><button>Go</button></form><p>x</p>", ["Title", "main text " * 19 + "main text", "x"]),
        ("<p>the text of the page</p><form><p>sign up</p></form>", ["the text of the page"]),
        ('<div class="content-with-sidebar"><p>main text</p></div>', ["main text"]),
        ('<div class="banner-image-article"><article><p>t</p></article></div>', ["t"]),
        ("<button>Subscribe</button><label>Name</label>", []),
        ('<p>Body <span class="ad">Buy now</span> end</p>', ["Body end"]),
        ('<p class="x"">Hello</p>', ["Hello"]),
        ("<p title=it's>one</p><p>two it's three</p><p>four</p>", ["one", "two it's three", "four"]),
        ('<p title="open>one</p><p>two</p>', ["one", "two"]),
        ("a < b <p>c</p> d <", ["a < b", "c", "d <"]),
        ("x<a href=1", ["x"]),
        ("<p>a<!-- b -->c</p><!-- never", ["ac"]),
        ("<script>x</script ><p>k</p><script>rest", ["k"]),
        ("<article><div id=comments><article class='comment'><p>no</p></article></div><p>yes</p></article>", ["yes"]),
        ("<aside><article><p>no</p></article></aside><p>yes</p>", ["yes"]),
    ],
)
def test_html_odd_markup(page, want):
    blocks, _ = site_style_tree._Parser().parse(page)
    assert [text for _, text, noise, _ in blocks if noise > site_style_tree.DECLARED] == want


def test_html_takes_a_time_that_grows_with_the_page():
    import time

    parser = site_style_tree._Parser()
    began = time.process_time()
    for part in ("<a ", '<a title="', '<a b=">"', '<p title="x>', "</script ", "<!--", "<", "<!x", "<a b='", "</a "):
        parser.parse(part * (300_000 // len(part)))
        parser.parse("<script>" + part * (300_000 // len(part)) + ">")
    assert time.process_time() - began < 20


def test_html_the_tree_alone_removes_a_template(spark):
    """Pages without a telling name: what repeats on a host goes, by the tree, from every page."""
    rows = [(k, f"http://h{k % 2}.example/{k}", f"<body><div><p>menu of the host {k % 2}</p></div><section><p>text {k} of its own {k * k}</p></section></body>") for k in range(40)]
    got = {r.page_id: r.text for r in site_style_tree.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: f"text {k} of its own {k * k}" for k in range(40)}
