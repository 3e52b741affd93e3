"""Main text of built pages, whose article is known, and the alignment against plain tree matching."""

import random
import time
from html import escape

from folkmoot.llm import extraction


def site(rng, n, notice=""):
    """Pages of one template; what each one's text must be."""
    words = [f"word{i}" for i in range(400)]
    say = lambda k: " ".join(rng.choices(words, k=k))
    for i in range(n):
        title, paragraphs = say(5) + " & é", [say(rng.randint(5, 40)) + ' <"x">' for _ in range(rng.randint(1, 7))]
        body = f"<h1>{escape(title)}</h1>{notice}" + "".join(f"<p><b>{escape(p)}<br>" if k == 0 else f"<p>{escape(p)}</p>" for k, p in enumerate(paragraphs))
        html = (
            f'<!DOCTYPE html><html><head><title>{title}</title><script>var t="</p><article>";</script></head><body><header><h2>{say(2)}</h2></header><nav><ul><li><a href="/">{say(1)}</a><li>{say(1)}</ul></nav><!-- <p>no</p> -->'
            f'<div class="cookie-notice">{say(4)}</div><main><article>{body}</article><section id="comments"><p>{say(9)}</p></section></main><aside class=x>{say(5)}</aside><form><p>{say(2)}</form><footer>&copy; {say(3)}</footer></body></html>'
        )
        yield html, " ".join(" ".join(x.split()) for x in [title, *paragraphs])


def test_articles_and_induced_template(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for host, notice in (("a.example", ""), ("b.example", "<p>Subscribers read this first every single day.</p>")):
        for html, text in site(rng, 40, notice):
            want[len(rows)] = text
            rows.append((len(rows), f"https://{host}/x?{len(rows)}", html))
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, node string").repartition(3)
    out = {r.page_id: r for r in extraction.extract(pages).collect()}
    assert {i: r.text for i, r in out.items()} == want
    assert all(r.n_chars == len(r.text) and r.url == rows[i][1] for i, r in out.items())


def test_copies_are_no_template(spark):
    html = next(site(random.Random(1), 1))
    pages = spark.createDataFrame([(i, f"http://c/{i}", html[0]) for i in range(50)], "page_id long, url string, html string")
    assert {r.text for r in extraction.extract(pages).collect()} == {html[1]}


def test_edge_cases(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    rows = [
        (1, None, None), (2, None, ""), (None, "u", "plain &amp text &#233;"), (3, "http://h/", "<p>a<p>b <i>c</i>d<br>e"), (4, "http://h/2", "<article><p>cut off <b>here</b> &am"), (5, "x", deep), (5, "x", deep),
        (6, "y", "<table><tr><td>1<td>2<tr><td>3</table><ul><li>x<li>y</ul><p>tail <a href='>'>z</a><p clas"), (7, "z", "<article>" + "<p>long words</p>" * 20_000 + "</article>"), (8, "w", "<div class=ad>no</div><p hidden>no</p><div role=navigation>no</div>yes"),
    ]
    out = [(r.page_id, r.text) for r in extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()]
    want = [(1, ""), (2, ""), (None, "plain & text é"), (3, "a b cd e"), (4, "cut off here &am"), (5, "deep"), (5, "deep"), (6, "1 2 3 x y tail z"), (7, " ".join(["long words"] * 20_000)), (8, "yes")]
    assert sorted(out, key=str) == sorted(want, key=str)
    assert extraction.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_alignment_is_simple_tree_matching():
    rng = random.Random(9)

    def tree(depth):
        tag = rng.choice(["div", "section", "p"] if depth else ["p"])
        return f"<{tag}>" + ("".join(tree(depth - 1) for _ in range(rng.randint(0, 3))) if tag != "p" else "t") + f"</{tag}>"

    def plain(a, b, x, y):
        if a.tags[x] != b.tags[y]:
            return 0
        xs, ys = a.children[x], b.children[y]
        best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
        for i, u in enumerate(xs):
            for j, v in enumerate(ys):
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + plain(a, b, u, v))
        return best[-1][-1] + 1

    for _ in range(60):
        a, b = (extraction.Page("".join(tree(3) for _ in range(3))) for _ in range(2))
        found = extraction.align(a, b)
        assert len(set(found.values())) == len(found) and all(a.tags[x] == b.tags[y] for y, x in found.items())
        assert len(found) == plain(a, b, 0, 0)


def plain_pages(rng, n, layout):
    """Pages of one host that no tag, role or class tells apart: constant lines, one of a few that take turns, and own text."""
    words = [f"word{i}" for i in range(400)]
    say = lambda k: " ".join(rng.choices(words, k=k))
    turns = [f"Buy {say(4)} today." for _ in range(4)]
    for i in range(n):
        own = [say(rng.randint(6, 30)) for _ in range(rng.randint(2, 6))]
        body = "".join(f"<p>{x}</p>" for x in own)
        if layout:
            yield f"<body><div><div>Our town daily, since 1901.</div><div>{rng.choice(turns)}</div></div><div>{body}</div><div>All rights reserved by us.</div></body>", " ".join(own)
        else:
            yield f"<body><section><ul><li>Start page</li><li>All topics</li></ul></section><div><div><p>{rng.choice(turns)}</p></div><div>{body}</div></div></body>", " ".join(own)


def test_induction_decides_where_structure_tells_nothing(spark):
    rng = random.Random(21)
    rows, want = [], {}
    for layout in (0, 1):  # two layouts of one host
        for html, text in plain_pages(rng, 60, layout):
            want[len(rows)] = text
            rows.append((len(rows), "https://plain.example/", html))
    by_structure = {i: " ".join(t for t, *_ in extraction.blocks(h, None)) for i, _, h in rows}
    assert not any(by_structure[i] == want[i] for i in want)
    out = {r.page_id: r.text for r in extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert out == want


def test_near_copies_are_no_evidence(spark):
    rng = random.Random(5)
    words = [f"word{i}" for i in range(400)]
    base = [" ".join(rng.choices(words, k=rng.randint(6, 30))) for _ in range(8)]
    rows, want = [], {}
    for i in range(60):
        own = list(base)
        own[rng.randrange(8)] += f" edited{i}"
        want[i] = " ".join(own)
        rows.append((i, "https://copies.example/", "<body><div>" + "".join(f"<p>{x}</p>" for x in own) + "</div></body>"))
    out = {r.page_id: r.text for r in extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out == want


def test_several_articles_and_class_words_stay():
    html = '<body><article><p>one</p><p class="social">two</p></article><article class="post ad"><p class="share-prices">three</p><div class="notice">four</div></article><section class="comments"><article><p>no</p></article></section></body>'
    assert [t for t, *_ in extraction.blocks(html, None)] == ["one", "two", "three", "four"]


def test_wide_pages_align_in_seconds():
    rng = random.Random(1)

    def page(n):
        return extraction.Page("<body>" + "".join(rng.choice(["<div><p>x</p></div>", "<div>" + "<p>y</p>" * rng.randint(0, 40) + "</div>", "<section>z</section>", "<ul><li>a<li>b</ul>"]) for _ in range(n)) + "</body>")

    began = time.monotonic()
    assert len(extraction.align(page(10_000), page(9_000))) > 5_000
    assert time.monotonic() - began < 20
    unlike = lambda: extraction.Page("<body>" + "".join("<div>" + "".join(rng.choice(["<p>x</p>", "<ul><li>a</ul>", "<div>y</div>"]) for _ in range(12)) + "</div>" for _ in range(4_000)) + "</body>")
    began = time.monotonic()
    assert len(extraction.align(unlike(), unlike())) > 4_000
    assert time.monotonic() - began < 20


def test_hostile_markup_is_read_in_linear_time():
    pages = {
        "unclosed tags": "<a " * 100_000,
        "unclosed quotes": '<a "' * 100_000,
        "quotes that cross": "<a '\"" * 60_000 + ">",
        "one end for all": "<a " * 100_000 + "\">",
        "nested blocks": "<div>" * 100_000 + "x",
        "unclosed inline": "<b>x" * 100_000,
        "blocks in inline": "<b><div>x</div>" * 50_000,
        "ends of nothing": "<x><td>" + "<b>" * 100_000 + "</x>" * 100_000,
        "comments": "<!-- x -->" * 60_000 + "<!-- x " * 60_000,
        "rows": "<table>" + "<tr><td>x" * 50_000,
    }
    for name, html in pages.items():
        began = time.time()
        extraction.Page(html)
        assert time.time() - began < 8, name  # a second or two each; quadratic ones took minutes


def test_tags_that_do_not_end():
    said = lambda html: [t for _, t in extraction.Page(html).blocks]
    assert said('<p>a <b "c</p>d') == ['a <b "c', "d"] and said("x <a href='y") == ["x"] and said("x <a <p>y") == ["x y"]
    assert said("<p>1 < 2 <i>and</i> 3<4</p>") == ["1 < 2 and 3<4"] and said("a<!-- b <p>c") == ["a"] and said("a</ b>c") == ["ac"]
    assert said("<p>a<script>if (a < b) '</p>'</script>b") == ["a", "b"] and said("<p>a<script>b</p>") == ["a"]
