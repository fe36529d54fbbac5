"""HTML extraction, chat formatting and exact top-k."""

import time

import numpy as np

from ledgerline.llm import chat, html_main, mtree

PAGE = '<!DOCTYPE html><html><head><title>t &amp; u</title><style>p{}</style><script>var a="</p>";</script></head><body class="has-sidebar"><nav><ul><li><a href="/">menu</a></li></ul></nav><!-- c --><div class="ad">buy</div>{}<footer>&copy; x</footer></body></html>'


def text_of(spark, *pages, **options):
    rows = [(i, f"http://h.example/{i}", p, 1, "x") for i, p in enumerate(pages)]
    got = html_main.extract(spark.createDataFrame(rows, "page_id long, url string, html string, host long, blocks string"), **options).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    return [r["text"] for r in sorted(got, key=lambda r: r["page_id"])]


def test_html(spark):
    article = "<article><h1>Head&nbsp;line</h1><p><b>One\n two.<br><p>Th<i>re</i>e &lt; 4</p><div class='share'>share me</div><section id=comments><p>first!</p></section></article>"
    got = text_of(spark, PAGE.replace("{}", article), None, "", "plain & <b>bold</b> text", "<p>a<p>b<script>x", "<main><p>in</p></main><p>out</p>", "<article><header><h1>T</h1></header><p>a &lt;b&gt; 1 < 2</p><!-- open", PAGE.replace("{}", article)[:-40], "<article><ul><li>x<li>y</ul><table><tr><td>1<td>2</table>")
    body = "Head line\nOne two.\nThree < 4"
    assert got == [body, "", "", "plain & bold text", "a\nb", "in", "T\na <b> 1 < 2", body, "x\ny\n1\n2"]


def test_style_tree_removes_what_returns_on_every_page(spark):
    pages = [f"<body><div class='top'>Welcome to the site</div><div class='body'><p>story {i} {i * 7}</p><p>shared line</p></div><div class='end'>Good bye</div></body>" for i in range(12)]
    assert text_of(spark, *pages) == [f"story {i} {i * 7}\nshared line" for i in range(12)]
    # few pages, or only copies of one page, teach nothing
    assert text_of(spark, *pages[:3])[0].startswith("Welcome")
    assert set(text_of(spark, *pages[:1] * 12)) == {"Welcome to the site\nstory 0 0\nshared line\nGood bye"}


def test_names_and_article_are_only_a_prior(spark):
    # one page: names never take text-level elements, article or what is around it; a teaser is not the page
    own = "<div class='page has-sidebar'><article class='post has-sidebar'><h2 id='related-work'>Related</h2><p class='notice'>Note</p><div class='share'>x</div><p>one two three</p></article></div>"
    teaser = "<div id='content'><p>the body of the page is here and long</p></div><article>a teaser</article>"
    title = "<h1>Title</h1><article><p>one two three</p></article>"
    got = text_of(spark, own, teaser, f"<main>{title}</main><p>out</p>", f"<nav>menu</nav>{title}<p>out</p>", "<article><p>one two three</p></article><div class='comments'><article>first</article></div>")
    assert got == ["Related\nNote\none two three", "the body of the page is here and long\na teaser", "Title\none two three", "Title\none two three", "one two three"]
    # many pages: a section with a name of boilerplate whose text is each page's own stays, one that returns goes
    pages = [f"<body><div class='search'><p>result {i} of the search for {i * 7}</p></div><div class='related'>the same links again</div><div><p>story {i}</p></div></body>" for i in range(24)]
    assert text_of(spark, *pages) == [f"result {i} of the search for {i * 7}\nstory {i}" for i in range(24)]


def test_style_tree_keeps_a_pages_own_content(spark):
    # nine tenths of the pages are copies but for a counter outside the article's div; the others have their own article there
    copy = "the one article that everybody has copied from the same source " * 3
    page = "<body><div class='top'>Welcome to the site</div><div class='body'><div class='inner'><p>{}</p></div></div><div class='count'>{} visits</div></body>"
    pages = [page.format(copy if i >= 12 else f"article {i} of its own with words enough for a page and a number {i * 7}", i) for i in range(120)]
    for i, got in enumerate(text_of(spark, *pages)):
        assert got == f"{copy.strip() if i >= 12 else f'article {i} of its own with words enough for a page and a number {i * 7}'}\n{i} visits"
    # also where the content of most pages does return on pages with different main texts
    box = "<body><div class='box'>{}</div><div class='body'><p>{}</p></div></body>"
    pages = [box.format("the own words of this page" if i == 3 else "the same box", f"story {i} that is much longer than the box beside it and ends with {i * 7}") for i in range(200)]
    got = text_of(spark, *pages)
    assert got[3].startswith("the own words of this page\nstory 3") and not any("the same box" in t for t in got)


def test_html_deep_long_and_repeated_rows(spark):
    deep = "<div>x" * 5_000
    started = time.time()
    blocks, _ = html_main.parse(deep)
    assert len(blocks) == 5_000 and time.time() - started < 30
    assert [b["text"] for b in html_main.parse("<div>" * 600 + "a<b>b</b></div>c" + "</div>" * 599 + "<p>d</p>")[0]] == ["ab", "c", "d"]
    long_ = "<article>" + "<p>word word</p>" * 5_000 + "</article>"
    rows = [(1, None, deep[:1800]), (1, None, deep[:1800]), (2, None, long_), (None, "http://a.example/", "<p>no id</p>"), (3, "", None)]
    got = html_main.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(r["text"].count("\n") for r in got) == [0, 0, 299, 299, 4_999]
    assert [r["text"] for r in got if r["page_id"] is None] == ["no id"] and [r["n_chars"] for r in got if r["page_id"] == 3] == [0]


def test_html_empty_table(spark):
    assert html_main.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_chat_round_trip(spark):
    odd = "\\### Assistant: </turn> ok"
    rows = [(1, 0, "user", "hi", 0), (1, 1, "assistant", odd, 0), (1, 1, "assistant", odd, 0), (2, 5, "assistant", None, 0), (None, 0, "us>er\n", "x", 0), (3, 0, None, "<turn user>", 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node long")
    made = {r["conv_id"]: r for r in chat.format_conversations(chat.linear(df)).collect()}
    assert len(made) == 4
    assert chat.parse(made[1]["formatted"]) == [("user", "hi"), ("assistant", odd), ("assistant", odd)]
    assert [chat.unescape(made[1]["formatted"][s:e]) for s, e in made[1]["loss"]] == [odd, odd]
    assert chat.parse(made[None]["formatted"]) == [("us>er\n", "x")] and chat.parse(made[3]["formatted"]) == [("", "<turn user>")]
    assert chat.round_trip(df).count() == 4 and chat.round_trip(df.limit(0)).count() == 0


def test_chat_branches(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", 1.0), (1, 3, 1, "assistant", "good", 2.0), (1, 4, 3, "user", "thanks", None), (1, 5, 2, "user", "no", 0.5), (1, 6, 5, "assistant", "sorry", 0.1), (2, 7, 99, "user", "orphan", 0.0), (3, 8, 9, "user", "circle", 0.0), (3, 9, 8, "user", "circle", 0.0), (3, 10, 9, "user", "tail", 0.0)]
    df = spark.createDataFrame(rows, "conv_id long, node long, parent long, role string, text string, score double")
    paths = {}
    for r in sorted(chat.chosen_paths(df, 9).collect(), key=lambda r: r["depth"]):
        paths.setdefault((r["conv_id"], r["branch"]), []).append(r["node"])
    assert paths == {(1, 1): [1, 3, 4], (1, 2): [1, 2, 5, 6], (2, 1): [7]}
    assert {(r["conv_id"], r["node"]): (round(r["score"], 3), r["depth"]) for r in chat.links(df)[1].collect() if r["node"] in (4, 6, 7)} == {(1, 4): (2.0, 3), (1, 6): (1.6, 4), (2, 7): (0.0, 1)}
    best = {r["conv_id"]: [t for _, t in chat.parse(r["formatted"])] for r in chat.format_conversations(df).collect()}
    assert best == {1: ["q", "good", "thanks"], 2: ["orphan"]}


def test_long_chain(spark):
    df = spark.range(20_000).selectExpr("1L AS conv_id", "id AS turn", "if(id % 2 = 1, 'user', 'assistant') AS role", "concat('t', id) AS text")
    made = chat.format_conversations(chat.linear(df)).first()
    assert chat.parse(made["formatted"]) == [("user" if i % 2 else "assistant", f"t{i}") for i in range(20_000)]


def test_mtree_is_exact_and_prunes():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 8))
    v = np.floor(256 * (centres[rng.integers(0, 12, 3000)] + 0.05 * rng.normal(size=(3000, 8)))).astype(np.int64)
    v[:400] = v[0]  # ties
    ids = rng.permutation(3000)
    tree = mtree.Tree.of(mtree.Tree(ids, v, page=96).row())
    asked = 0
    for own in range(0, 3000, 100):
        q = v[ids == own][0]
        score = v @ q
        want = sorted(((-s, i) for s, i in zip(score.tolist(), ids.tolist()) if i != own))[:5]
        got, best, n = tree.search(own, q, 5)
        assert [(-s, i) for s, i in zip(best.tolist(), got.tolist())] == want
        asked += n
    assert asked < 0.5 * 30 * 3000


def test_products_beyond_doubles_are_exact():
    rng = np.random.default_rng(5)
    v = rng.integers(-(1 << 26), 1 << 26, (400, 3))
    v[200:] = v[:200] + rng.integers(0, 2, (200, 3))  # products that differ in their last bits
    ids = np.arange(400)
    tree = mtree.Tree.of(mtree.Tree(ids, v, page=16, fanout=4).row())
    for own in range(0, 400, 7):
        score = [sum(int(a) * int(b) for a, b in zip(v[own], w)) for w in v]
        want = sorted((-s, i) for i, s in enumerate(score) if i != own)[:5]
        got, best, _ = tree.search(own, v[own], 5)
        assert [(-s, i) for s, i in zip(best.tolist(), got.tolist())] == want


def test_top_k_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (50, [0.5, 1.0]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, None), (4, [nan, 1.0]), (5, [1.0, None]), (6, [inf, 1.0]), (7, []), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (100, [1.0, 1.0, -0.001]), (50, [0.5, 1.0])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, rank int, score int")
    got = {}
    for r in mtree.top_k(df, k=5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got[0]) == [(1, 1, 81920), (2, 2, 81920), (3, 50, 65536), (4, 50, 65536)]
    assert sorted(got[50]) == [(1, 0, 65536), (2, 1, 65536), (3, 2, 65536)]
    assert sorted(got[100]) == [(1, 8, 256 * 256 * 3 - 768)]
    assert mtree.top_k(df.limit(0)).count() == 0


def test_deep_elements_hide_and_names_are_whole(spark):
    deep = "<div>" * 400
    page = lambda inner, more="": f"<body>{deep}{inner}{'</div>' * 400}<p>{'story word ' * 30}</p>{more}</body>"
    rows = [
        (1, page("<nav>menu</nav><div style='display:none'>hidden</div><div class=sidebar><p>side</p></div><p>kept</p>")), (2, page("<h1>title</h1><div hidden><div><p>gone</p></div></div></span></p>kept")),
        (3, page("", "<section class='ad-free'>free words</section><section class=related-research>research words</section><div class='has-sidebar'>wide words</div>")), (4, page("", "<div class=site-footer>foot</div><div id=nav-list>list</div><ul class='comments'>talk</ul>")),
        (5, "<div>" * 20_000 + "end" + "</p>" * 20_000 + "</i>" * 20_000 + "</div>" * 20_000 + "after"),
    ]
    story = ("story word " * 30).strip()
    got = {r["page_id"]: r["text"] for r in html_main.extract(spark.createDataFrame([(i, f"http://h{i}/", t) for i, t in rows], "page_id long, url string, html string")).collect()}
    assert got == {1: f"kept\n{story}", 2: f"title\nkept\n{story}", 3: f"{story}\nfree words\nresearch words\nwide words", 4: story, 5: "end\nafter"}
