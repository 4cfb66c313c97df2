"""Main text: inferred expressions, pages with and without marks, whole tables, and the defined edge cases."""

import html
import random
import re

import pytest

from hourgrid.llm import wrappers

SF = "/root/testdata/sf0.01"


def shape(nodes):
    """An expression in words, slots as #."""
    out = []
    for tag, flags, content in nodes:
        body = "#" if tag == wrappers.TEXT else shape(content) if tag == wrappers.GROUP else f"{tag}[{shape(content)}]"
        mark = ("", "?", "+", "+?")[flags]
        out.append(f"({body}){mark}" if mark and tag == wrappers.GROUP else body + mark)
    return " ".join(out)


def inferred(*pages):
    found = [wrappers.expression(p)[0] for p in pages]
    whole = found[0]
    for nodes in found[1:]:
        whole = wrappers.aligned(whole, nodes, wrappers._both_lists)
    return shape(whole)


def test_expressions():
    assert inferred("<ul><li>a<li>b<li>c</ul>") == "ul[li[#]+]"
    assert inferred("<dl><dt>a<dd>b<dt>c<dd>d</dl>") == "dl[(dt[#] dd[#])+]"
    assert inferred("<h1>a</h1><p>x<p>y", "<h1>b</h1><p>x") == "h1[#] p[#]+"
    assert inferred("<h1>a</h1><p>x", "<h1>b</h1><div class=ad>z</div><p>x") == "h1[#] div.ad[#]? p[#]"
    assert inferred("<div><p>x</div>", "<div><p></div>") == "div[p[#?]]"
    # one turn on one page, several on another
    assert inferred("<h2>a</h2><p>x</p>", "<h2>a</h2><p>x</p><h2>b</h2><p>y</p>") == "(h2[#] p[#])+"


@pytest.mark.parametrize("page, text", [
    ("<article>a &amp; b&nbsp;&#233;<br>c<!-- no --></article>", "a & b é c"),
    ("<nav>menu</nav><article><h1>T</h1><p>one <b>two</b>three<p>four</article><footer>end</footer>", "T one twothree four"),
    ("<article><p>x</p><div class='comments'><p>reader</p></div><form>send</form><aside>side</aside></article>", "x"),
    ("<main><p>body</p><div id=cookie-notice>we use</div></main><div class=sidebar>s</div>", "body"),
    ("<article><header><h1>Title</h1><p>menu</p></header><p>x</p></article>", "Title x"),
    ("<div class='page has-sidebar'><article><p>x</p></article></div>", "x"),
    ("<form id=aspnet><article><p>x</p></article></form>", "x"),
    ("<article><p>x <span class=ad>buy</span> y</p><script>if (a < b) '</p>'</script><style>p{}</style></article>", "x y"),
    ("<article>a<table><tr><td>1<td>2<tr><td>3</table>b", "a 1 2 3 b"),
    ("<article><p hidden>no</p><p style='display: none'>no</p>yes</article>", "yes"),
    ("<p title='a > b' data-x=\"<p>\">1 &lt; 2 < 3</p>", "1 < 2 < 3"),
    ("<script>never ends <p>x</p>", ""), ("", ""), ("  \n ", ""), ("plain", "plain"), ("<p>a", "a"), ("</p></div>a", "a"),
])
def test_single_pages(page, text):
    assert wrappers.main_text(page, None) == text


def test_pages_without_marks(spark):
    """Template text, menus and links go by what the wrapper knows of its slots."""
    rng = random.Random(2)

    def words(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))

    pages, want = [], {}
    for i in range(30):
        body = [words(rng.randint(20, 60)) for _ in range(rng.randint(1, 6))]
        title = words(4)
        related = "".join(f"<li><a href=/{j}>{words(5)}</a>" for j in range(rng.randint(1, 5)))
        extra = "<div class=x2>Now in print</div>" if i % 3 else ""
        pages.append((i, "https://plain.example/p", f"<div class=a1><a href=/>Home</a><a href=/b>News</a></div><div class=b2><h1>{title}</h1>"
                      f"<div class=c3>{''.join(f'<p>{b}</p>' for b in body)}<div class=d4>All rights kept</div>{extra}<ul>{related}</ul></div></div>"
                      "<div class=e5>Imprint and contact</div>"))
        want[i] = " ".join([title, *body])
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    for parts, fan in ((1, 2), (7, 256)):
        got = {r.id: r.text for r in wrappers.extract(frame.repartition(parts), fan=fan).collect()}
        assert got == want


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r.id: r for r in wrappers.extract(spark.read.parquet(f"{SF}/pages.parquet").repartition(5)).collect()}
    assert len(got) == len(rows)
    for r in rows:
        inside = re.sub(r"</?b>", "", re.search(r"<article>(.*)</article>", r.html, re.S)[1])
        text = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inside)).split())
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (text, len(text), r.url)


def test_edge_cases(spark):
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000
    page = "<article><p>" + "long text " * 200_000 + "</p></article>"
    many = "<article>" + "".join(f"<p>{i}</p><h{i % 6 + 1}>t{i}</h{i % 6 + 1}>" for i in range(3000)) + "</article>"
    data = [(1, None, "<article>no url</article>"), (2, "http://h.x/a", None), (None, "http://h.x/a", "<article>null id</article>"),
            (3, "http://h.x/a", ""), (4, "nonsense", "<article>𝒳y</article>"), (4, "nonsense", "<article>𝒳y</article>"),
            (5, "http://deep.x/", deep), (6, "http://long.x/", page), (7, "http://many.x/", many), (8, "HTTP://H.X:80/", "\x00<article>z\x00</article>")]
    frame = spark.createDataFrame(data, "page_id long, url string, html string").selectExpr(
        "*", "'t' as text", "1 as host", "2 as slice", "3 as n_chars", "'w' as wrapper", "5 as id")
    got = wrappers.extract(frame)
    assert got.columns == ["id", "url", "text", "n_chars"]
    texts = sorted(((r.id or 0, r.text, r.n_chars) for r in got.collect()))
    plain = re.sub(r"<[^>]*>", " ", many).split()
    assert texts == sorted([(1, "no url", 6), (2, "", 0), (0, "null id", 7), (3, "", 0), (4, "𝒳y", 2), (4, "𝒳y", 2), (5, "deep", 4),
                            (6, ("long text " * 200_000).strip(), 1_999_999), (7, " ".join(plain), len(" ".join(plain))), (8, "z\x00", 2)])
    assert wrappers.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
