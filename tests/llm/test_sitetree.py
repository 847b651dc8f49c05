from pyspark.sql import functions as F

from gapwise.llm import sitetree

PAGES = "page_id bigint, url string, html string"


def _text(html):
    return sitetree.main_text(sitetree.parse(html)[0], set())


def test_article_without_the_rest():
    html = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head>
    <body class="has-sidebar"><header><a href="/">Site</a></header><nav><ul><li>Menu</ul></nav>
    <div class="cookie-notice">We use cookies</div><div id="top-ad">Buy</div>
    <article class="post"><header><h1>Title &amp; more</h1></header><p><b>Bold
      start<br>next<p>Second &eacute;&#233; <i>word</i><span class="ad">buy</span>.</p>
    <!-- <p>hidden</p> --><form><label>Mail</label><input><button>Go</button></form>
    <ul><li>One<li>Two</ul><table><tr><td>A<td>B</table><blockquote>Quote</blockquote><pre>a
      b</pre><aside>More</aside><section id="comments"><article class="comment"><p>First!</p></article></section>
    </article><div class="sidebar">Side</div><footer>&copy; me</footer></body></html>"""
    assert _text(html) == "\n\n".join(["Title & more", "Bold start next", "Second éé word.", "One", "Two", "A", "B",
                                       "Quote", "a b"])


def test_markup_that_is_broken_or_missing():
    assert _text("plain text &lt;b&gt;") == "plain text <b>"
    assert _text("<div>one<div>two</div>three</div>") == "one\n\ntwo\n\nthree"
    assert _text("<p>a <b>b</p> c</b> <!-- open <p>x") == "a b\n\nc"
    assert _text("<p>a<script>never closed <p>b") == "a"
    assert _text("<p title='a>b' class=x>1 < 2 > 1 <unknown>y</unknown></p></p></div>") == "1 < 2 > 1 y"
    assert _text("<p class=\"a>text<p>more") != ""
    assert _text("") == _text("   ") == _text("<html></html>") == ""
    assert _text("<a" * 3000) is not None and _text("<" * 50_000) is not None
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert _text(deep) == "x"
    assert _text("<main><p>in</p></main><p>out</p>") == "in"


def test_names_of_noise():
    for name in ("siteNav", "user-comments", "usercomments", "CookieBar", "right_sidebar", "ADS", "adBox", "adslot", "top-ad2",
                 "site-header", "pageFooter"):
        assert _text(f"<p>in</p><div class='{name}'><p>out</p></div>") == "in", name
    for name in ("article-header", "shadow", "lead", "badge", "gradient", "download", "maintext"):
        assert _text(f"<p>in</p><div class='{name}'><p>also</p></div>") == "in\n\nalso", name


def test_noise_words_on_a_wrapper_do_not_take_the_article():
    body = "<h1>Title</h1><p>A first paragraph of text.</p><p>And a second one.</p>"
    want = "Title\n\nA first paragraph of text.\n\nAnd a second one."
    for html in (f"<div class='content-sidebar-wrap'><main>{body}</main><div class='sidebar'>Side</div></div>",
                 f"<div class='overflow-hidden'><article>{body}</article></div><div class='cookie-bar'>Cookies</div>",
                 f"<div class='elementor-widget-container'>{body}</div><div class='menu'>Menu</div>",
                 f"<article class='post comments-open'>{body}</article>",
                 f"<main><article class='post comments-open'>{body}</article></main><div id='comments'>First!</div>",
                 f"<form id='aspnetForm'>{body}<div class='sidebar'>Side</div></form>",
                 "<div class='elementor-widget elementor-widget-heading'><h1>Title</h1></div>"
                 "<div class='elementor-widget elementor-widget-text'><p>A first paragraph of text.</p>"
                 "<p>And a second one.</p></div><div class='sidebar elementor-widget'>Side</div>"):
        assert _text(html) == want, html
    assert _text("<div class='hidden-xs'><p>all there is</p></div>") == "all there is"
    assert _text("<p><span class='widget'>all there is</span></p>") == "all there is"


def test_an_article_is_evidence_not_a_verdict():
    body = "".join(f"<p>Paragraph number {i} of the story.</p>" for i in range(20))
    text = "\n\n".join(f"Paragraph number {i} of the story." for i in range(20))
    more = "<div class='more'><article><h3>Other story</h3></article></div>"
    assert _text(f"<main><h1>T</h1>{body}{more}</main><div>Imprint</div>") == f"T\n\n{text}\n\nOther story"
    assert _text(f"<div><h1>T</h1>{body}</div>{more}") == f"T\n\n{text}\n\nOther story"
    assert _text(f"<main><h1>T</h1><p>Intro</p><article>{body}</article></main>") == f"T\n\nIntro\n\n{text}"
    assert _text(f"<main>{body}</main>{more}") == text
    assert _text(f"<div class='sidebar-left'>{body}</div>{more}") == f"{text}\n\nOther story"
    assert _text("<div class='ad'>Buy five of these now</div><article><h1>T</h1><p>T</p></article>") == "T\n\nT"
    assert _text(f"<article>{body}</article><article><p>Short</p></article><div>x</div>") == f"{text}\n\nShort"


def _site(n, host="h"):
    return [(i, f"http://{host}/p/{i}", f"""<body><div class="box">Welcome to our site</div>
      <div class="body"><p>Own text number {i}.</p><p>And {i * 7} more words.</p><div class="tagline">Always fresh</div>
      </div></body>""") for i in range(n)]


def test_site_wide_branches_go(spark):
    rows = _site(12) + [(100 + i, u.replace("/h/", "/small/"), h) for i, u, h in _site(2)]
    rows += [(200, None, _site(1)[0][2]), (201, "http://h/x", None), (202, "http://h/y", ""), (None, None, None),
             (3, *_site(12)[3][1:]), (300, "http://[bad", "<p>x</p>")]
    pages = spark.createDataFrame(rows, PAGES).withColumn("host", F.lit("z")).withColumn("path", F.lit(1))
    got = {r.page_id: r for r in sitetree.extract(pages).collect()}
    assert sitetree.extract(pages).count() == len(rows)
    for i in range(12):
        assert got[i].text == f"Own text number {i}.\n\nAnd {i * 7} more words."
        assert got[i].n_chars == len(got[i].text)
    assert got[100].text.startswith("Welcome to our site") and got[100].text.endswith("Always fresh")
    assert got[200].text.startswith("Welcome") and got[300].text == "x"
    assert got[201].text == got[202].text == got[None].text == ""


def test_join_instead_of_broadcast_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(sitetree, "BROADCAST_PATHS", 0)
    pages = spark.createDataFrame(_site(8), PAGES)
    assert {r.text for r in sitetree.extract(pages).collect()} == {
        f"Own text number {i}.\n\nAnd {i * 7} more words." for i in range(8)}


def test_copies_of_an_article_keep_their_text(spark):
    one = "<body><article><h1>Head</h1><p>Same text</p></article></body>"
    rows = [(i, f"http://h/{i}", one) for i in range(9)] + [(50 + i, f"http://g/{i}", "<p>all alike</p>") for i in range(9)]
    got = {r.page_id: r.text for r in sitetree.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[0] == "Head\n\nSame text" and got[50] == "all alike"


def test_copies_keep_a_body_in_any_element(spark):
    one = "<div>Our site</div><article><h1 class='entry-title'>T</h1><div class='text'>body</div></article>"
    rows = [(i, f"http://h/{i}", one) for i in range(9)]
    # distinct pages whose article has the same lead on each: it is the article's
    rows += [(400 + i, f"http://f/{i}", f"<div class='top'>Our site</div><article><p class='lead'>Our lead</p>"
              f"<section>Story {i} of this host</section></article>") for i in range(9)]
    got = {r.page_id: r.text for r in sitetree.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert {got[i] for i in range(9)} == {"T\n\nbody"}
    for i in range(9):
        assert got[400 + i] == f"Our lead\n\nStory {i} of this host"


def test_groups_of_copies_without_an_article_are_no_template(spark):
    pages = spark.range(10_000).select(
        F.col("id").alias("page_id"), F.format_string("http://g/%d", "id").alias("url"),
        F.format_string("<nav>Menu %d</nav><div class='top'>Our site</div><div><p>Group %d of a text</p>"
                        "<p class='lead'>Lead %d of it</p></div>", "id", F.col("id") % 5, F.col("id") % 5).alias("html"))
    got = {(r.text, r["count"]) for r in sitetree.extract(pages).groupBy("text").count().collect()}
    assert got == {(f"Group {i} of a text\n\nLead {i} of it", 2000) for i in range(5)}


def test_importance_against_a_direct_computation(spark):
    import math
    rows = _site(10)
    features = sitetree.count_features(spark.createDataFrame(rows, PAGES))
    marked = {(r.host, r.path) for r in sitetree.noise_paths(features).collect()}
    texts = {}
    for _, _, html in rows:
        for b in sitetree.parse(html)[0]:
            texts.setdefault(b.path, []).append(b.text)
    for path, all_texts in texts.items():
        counts = [all_texts.count(t) for t in set(all_texts)]
        content = 1 - sum(math.log(c, 10) for c in counts) / len(counts)
        assert (("h", path) in marked) == (content < sitetree.THRESHOLD)


def test_words_and_links_take_nothing_from_an_article():
    first, last = "A first paragraph of the story here.", "And more of the story follows."
    for middle, text in (("<div id='related-work'><p>Related work is discussed.</p></div>", "Related work is discussed."),
                         ("<section class='social-history'><p>History.</p></section>", "History."),
                         ("<p class='notice'>Note this.</p>", "Note this."),
                         ("<div class='comment-on-results'><p>On them.</p></div>", "On them."),
                         ("<p><a href='x'>All of it a link</a></p>", "All of it a link"),
                         ("<h2><a href='#'>Linked</a></h2>", "Linked")):
        for tag in ("article", "main"):
            assert _text(f"<{tag}><h1>T</h1><p>{first}</p>{middle}<p>{last}</p></{tag}><div>Foot</div>") == "\n\n".join(
                ["T", first, text, last]), (tag, middle)
    for name in ("ad", "topAd", "comments", "comment-list", "user-comments", "share-buttons", "cookie-notice"):
        assert _text(f"<article><h1>T</h1><p>{first}</p><div class='{name}'><p>Out</p></div><p>{last}</p></article>"
                     ) == "\n\n".join(["T", first, last]), name


def test_links_outside_an_article():
    body = "<h1><a href='x'>Linked title</a></h1><p>Some text of the page, a few words.</p><p><a href='y'>A linked one</a></p>"
    menu = "<ul><li><a href='1'>One</a><li><a href='2'>Two</a><li><a href='3'>Three</a></ul>"
    want = "Linked title\n\nSome text of the page, a few words.\n\nA linked one"
    assert _text(f"<div>{body}</div>") == want
    assert _text(f"{menu}<div>Text before.</div><div>{body}</div>") == "Text before.\n\n" + want
    assert _text("<h1>Title</h1><main><p>The text of main.</p></main>") == "Title\n\nThe text of main."
    assert _text("<h1>Site</h1><main><h1>T</h1><p>The text of main.</p></main>") == "T\n\nThe text of main."


def test_comments_under_neutral_names():
    for head in ("12 Responses", "Comments (3)", "Kommentare", "2 commentaires:"):
        assert _text(f"<div><p>The text of the page.</p></div><section><h2>{head}</h2><ol><li>Bob says hi and "
                     f"more than that</li></ol></section>") == "The text of the page."
    assert _text("<div><h2>Comments on a book</h2><p>Text.</p></div>") == "Comments on a book\n\nText."


def test_hosts_are_read_alike(spark):
    urls = ["http://[2001:db8::1]/a", "https://u@v@Host.example:80/x?a@b", "//h/p", "http://h:1", "HTTP://ÄB.de#x", "x", "",
            None, "http://[bad", "http://a/b//c", "mailto:x@y"]
    got = spark.createDataFrame([(u,) for u in urls], "url string").select(
        F.coalesce(sitetree.ascii_lower(F.regexp_extract("url", sitetree.HOST, 1)), F.lit(""))).collect()
    assert [r[0] for r in got] == [sitetree.host_of(u) for u in urls]
    assert sitetree.host_of(urls[0]) == "[2001:db8::1]" and sitetree.host_of(urls[1]) == "host.example"


def test_sites_under_an_address_lose_their_template(spark):
    rows = [(i, u.replace("//h/", "//u@v@[2001:db8::1]:8080/"), h) for i, u, h in _site(9)]
    got = {r.page_id: r.text for r in sitetree.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[3] == "Own text number 3.\n\nAnd 21 more words."


def test_parsing_is_linear_in_depth():
    import time
    pages = ["<div>" * 20_000 + "x" + "</div>" * 20_000, "<div>" * 3000 + "</p>" * 20_000, "<ul><li>" * 10_000,
             "<div class='ad'>" * 10_000 + "x", "<b>" * 20_000 + "x" + "</b>" * 20_000,
             "".join(f"<div class='ad-{i}'>" for i in range(5000)) + "x"]
    for html in pages:
        begin = time.process_time()
        _text(html)
        assert time.process_time() - begin < 2, html[:20]


def _direct(pages):
    """Texts of well-formed pages, from trees in memory: entropies node by node, then what is left."""
    import math
    from collections import Counter
    from html.parser import HTMLParser

    class Tree(HTMLParser):
        def __init__(self):
            super().__init__()
            self.at, self.laid, self.noise, self.blocks = [("", [])], [], 0, []

        def handle_starttag(self, tag, attrs):
            key = ".".join([tag, *sorted(x for k, v in attrs if k == "class" for x in v.split())])
            path, kids = self.at[-1]
            if kids[-1:] != [key]:
                kids.append(key)
            self.at.append((path + "/" + key, []))
            self.noise += tag == "nav"

        def handle_endtag(self, tag):
            path, kids = self.at.pop()
            self.laid += [(path, tuple(kids))] * bool(kids)
            self.noise -= tag == "nav"

        def handle_data(self, data):
            if data.strip():
                self.blocks.append((self.at[-1][0], " ".join(data.split()), self.noise > 0))

    trees = {}
    for page_id, host, html in pages:
        trees[page_id] = t = Tree()
        t.host = host
        t.feed(html)
    out = {}
    for host in {t.host for t in trees.values()}:
        own = [t for t in trees.values() if t.host == host]
        noise = set()
        for path in {p for t in own for p, _, _ in t.blocks}:
            having = [{x for p, x, _ in t.blocks if p == path} for t in own]
            m = sum(map(bool, having))
            times = Counter(x for some in having for x in some)
            content = 1 - sum(math.log(c, m) for c in times.values()) / len(times) if m > 1 else 1
            laid = Counter(k for t in own for k in {k for p, k in t.laid if p == path})
            shares = [n / laid.total() for n in laid.values()]
            if m >= 5 and content < 0.2 and -sum(x * math.log(x, m) for x in shares) < 0.2:
                noise.add(path)
        for page_id, t in trees.items():
            if t.host == host:
                some = [(p, x) for p, x, menu in t.blocks if not menu]
                out[page_id] = "\n\n".join([x for p, x in some if p not in noise] or [x for _, x in some])
    return out


def test_generated_sites_against_a_second_implementation(spark):
    import random
    rng = random.Random(21)

    def words(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))

    pages = []
    for h in range(6):
        slots = [f"s{rng.choice('klmnopq')}{k}x"[:2] + "abcdef"[k] for k in range(4)]
        fixed = {s: words(rng.randint(1, 5)) for s in slots if rng.random() < 0.7}
        few = [words(3) for _ in range(3)]
        for i in range(rng.choice([3, 7, 14])):
            parts = []
            for s in slots:
                text = fixed.get(s) or (rng.choice(few) if s == slots[0] else words(rng.randint(2, 9)))
                # some texts stand in a changing number of child blocks, which makes their layout differ
                more = "".join(f"<h6>{words(1)}</h6><pre>{words(1)}</pre>" * rng.randint(0, 1) for _ in range(s == slots[3]))
                parts.append(f'<div class="{s}">{text}{more}</div>')
            paragraphs = "".join(f"<p>{words(rng.randint(8, 20))}</p>" for _ in range(rng.randint(2, 5)))
            menu = "<nav><ul>" + "".join(f"<li>{words(1)}</li>" for _ in range(rng.randint(1, 4))) + "</ul></nav>"
            pages.append((len(pages), f"host{h}", f"<html><body>{menu}{parts[0]}{parts[1]}<section>{paragraphs}</section>"
                                                  f"{parts[2]}{parts[3]}</body></html>"))
    want = _direct(pages)
    got = sitetree.extract(spark.createDataFrame([(i, f"http://{h}/{i}", x) for i, h, x in pages], PAGES)).collect()
    assert {r.page_id: r.text for r in got} == want


def test_empty_table(spark):
    assert sitetree.extract(spark.createDataFrame([], PAGES)).count() == 0
