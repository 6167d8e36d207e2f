import json

from tablespoon.llm import wrappers as w

PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{{a:b}}</style><script>var t="</p>";</script></head>
<body><header><h2>Site</h2></header><nav><ul><li><a href="/">Home</a></li><li><a href="/b">Blog</a></li></ul></nav>
<div class="ad">Buy now</div><div id="cookie-notice">We use cookies</div>
<{tag}><h1>{title}</h1>{body}</{tag}>
<div class="sidebar"><p>Read also</p></div><form><label>Mail</label><input name="m"></form>
<section class="comments"><p>{comment}</p></section><footer>&copy; us</footer></body></html>"""


def page(tag="article", title="Title", body="<p>One <b>two</b> three</p>", comment="First!"):
    return PAGE.format(tag=tag, title=title, body=body, comment=comment)


def texts(spark, pages):
    rows = [(i, url, html) for i, (url, html) in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: (r.text, r.n_chars) for r in w.extracted(df).collect()}


def test_article(spark):
    got = texts(spark, [("http://a.org/1", page()), ("http://a.org/2", page(title="Other", body="<p>x</p><p>y &lt; &eacute;&#33;</p>"))])
    assert got == {0: ("Title One two three", 19), 1: ("Other x y < é!", 14)}


def test_region_without_a_name(spark):
    """No article element: the varying text says where the article is, constant text is the template."""
    pages = [(f"http://b.org/{i}", page("div", f"Title {i}", f"<p>{'long text ' * 20}{i}</p><p>end {i}</p>", f"comment {i}")) for i in range(6)]
    got = texts(spark, pages)
    for i in range(6):
        assert got[i][0] == f"Title {i} {'long text ' * 20}{i} end {i}"


def test_broken_markup():
    plan = w.decide(w.expression(w.parse(page())))
    for body, want in [
        ("<p><b>a<br><p>b</p>", "Title a b"),
        ("<p>a<p>b<ul><li>c<li>d</ul>", "Title a b c d"),
        ("<p>a &amp b &am c &#x41;</p>", "Title a & b &am c A"),
        ("a < b <!-- x <p> --> c", "Title a < b c"),
        ("<p>a  b\n\tc</p></div></span>", "Title a b c"),
        ('<p title="a > b">x</p>', "Title x"),
    ]:
        html = page(body=body)
        assert w.main_text(html, w.decide(w.expression(w.parse(html)))) == want
    deep = page(body="<div>" * 5000 + "x" + "</div>" * 5000)
    assert w.main_text(deep, w.decide(json.loads(json.dumps(w.expression(w.parse(deep)))))) == "Title x"
    cut = page(body="<p>one</p><p>two").split("</article>")[0]
    assert w.main_text(cut, plan) == "Title one two"
    assert w.main_text("", plan) == "" and w.main_text("<", plan) == ""


def test_layout_names_on_what_holds_the_title():
    html = page().replace("<body>", '<body class="has-sidebar"><div class="menu-open wrap">').replace("</body>", "</div></body>")
    assert w.main_text(html, w.decide(w.expression(w.parse(html)))) == "Title One two three"


def test_repeats_within_a_page_are_no_template(spark):
    table = "".join(f"<tr><th>name {i}</th><td>yes</td></tr>" for i in range(9))
    listed = "".join(f"<dt>key {i}</dt><dd>same</dd>" for i in range(4))
    rows = [("http://c.org/1", page(body=f"<p>{'words ' * 30}</p><table>{table}</table>"))]
    rows += [(f"http://d.org/{j}", page(body=f"<p>{'words ' * 30}{j}</p><table>{table}</table>")) for j in range(2)]
    rows += [("http://e.org/1", page("div", body=f"<p>{'words ' * 30}</p><dl>{listed}</dl>"))]
    got = texts(spark, rows)
    assert [got[i][0].count("yes") for i in range(3)] == [9, 9, 9] and got[3][0].count("same") == 4


def test_eight_pages_keep_article_text(spark):
    """What an article says on every page of its host is still the article's."""
    body = "<p>{}</p><table><tr><td>Population</td><td>{}</td></tr></table><div>Conclusion</div>"
    pages = [(f"http://f.org/{j}", page(body=body.format(f"{'words ' * 30}{j}", j))) for j in range(20)]
    got = texts(spark, pages)
    assert [got[j][0] for j in range(20)] == [f"Title {'words ' * 30}{j} Population {j} Conclusion" for j in range(20)]


def test_texts_on_many_pages_are_template_where_no_article_is_named(spark):
    body = "<p>{}</p><div>Tell us</div>"
    pages = [(f"http://g.org/{j}", page("div", f"Title {j}", body.format(f"{'words ' * 30}{j}"))) for j in range(w.SAME)]
    assert not any("Tell us" in text for text, _ in texts(spark, pages).values())


def test_expressions_fold_and_align():
    def of(html):
        return w.expression(w.parse(html))

    repeated = of("<ul><li>a</li><li>b</li><li>c</li></ul>")["c"][0]["c"]
    assert len(repeated) == 1 and repeated[0]["r"] == 1 and repeated[0]["n"] == 3
    group = of("<dl><dt>a</dt><dd>b</dd><dt>c</dt><dd>d</dd></dl>")["c"][0]["c"]
    assert [p["l"] for p in group] == ["()"] and [p["l"] for p in group[0]["c"]] == ["dt", "dd"]
    merged = w._merge(of("<div><h1>a</h1><p>x</p></div>"), of("<div><h1>b</h1><h2>s</h2><p>x</p></div>"))["c"][0]["c"]
    assert [(p["l"], p["o"]) for p in merged] == [("h1", 0), ("h2", 1), ("p", 0)]
    assert merged[0]["c"][0]["h"] is None and merged[2]["c"][0]["h"] is not None
    # the order of merging doesn't change what is seen
    pages = [of(page(body="<p>x</p>" * n)) for n in range(1, 5)]
    one, two = pages[0], pages[3]
    for p in pages[1:]:
        one = w._merge(one, p)
    for p in pages[2::-1]:
        two = w._merge(two, p)
    assert json.dumps(one, sort_keys=True) == json.dumps(two, sort_keys=True)


def test_tree_of_groupings(spark, monkeypatch):
    monkeypatch.setattr(w, "FAN_IN", 2)
    pages = [("http://c.org/x", page(title=f"T{i}", body=f"<p>{i}</p>" * (i % 4 + 1))) for i in range(40)]
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string").repartition(13)
    got = {r.page_id: r.text for r in w.extracted(df).collect()}
    assert got == {i: f"T{i} " + " ".join([str(i)] * (i % 4 + 1)) for i in range(40)}


def test_odd_rows(spark):
    long_page = page(body="<p>word</p>" * 20_000)
    got = texts(spark, [(None, page()), ("http://d.org/", None), ("http://d.org/", ""), ("no url", page()), ("http://d.org/x", long_page), (None, "just text"), ("http://e.org", "<<<>>>")])
    assert got[0][0] == "Title One two three" and got[1] == got[2] == ("", 0) and got[3] == got[0]
    assert got[4][0] == "Title " + " ".join(["word"] * 20_000)
    df = spark.createDataFrame([], "page_id long, url string, html string, host string, plan string")
    assert w.extracted(df).count() == 0
    twice = spark.createDataFrame([(1, "http://f.org", page(), "x", "y")] * 2, df.schema)
    assert [r.text for r in w.extracted(twice).collect()] == ["Title One two three"] * 2
