import pytest

from tallyweek.llm.html_text import extract, main_text

LONG = "This is a sentence of the article that goes on for a while, with commas and all. " * 3
MORE = "Another paragraph of the same article follows, and it is about as long as the first. " * 3
BODY = " ".join(f"{LONG} {MORE}".split())


def page(article, before="", after=""):
    return f"<!DOCTYPE html><html><head><title>Title &amp; more</title><style>p{{}}</style></head><body>{before}{article}{after}</body></html>"


MENU = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>'
ARTICLE = f"<article><h1>The headline</h1><p>{LONG}</p><p>{MORE}</p></article>"
PARTS = f"<div><h1>The headline</h1><p>{LONG}</p><p>{MORE}</p></div>"
FURNITURE = [
    MENU,
    '<header class="site"><a href="/">Site name</a> slogan of the site</header>',
    "<footer>&copy; 2024 Somebody. All rights reserved.</footer>",
    '<aside class="sidebar"><p>Something about the author that is of some length.</p></aside>',
    '<div class="sidebar"><h3>Popular</h3><ul><li><a href="/x">One</a></li><li><a href="/y">Two</a></li></ul></div>',
    '<div id="cookie-notice">We use cookies to make this site better for everyone. <button>Accept</button></div>',
    '<div class="ad">Buy this now, it is cheap.</div>',
    '<form action="/s"><label>Search</label><input name="q"><select><option>All</option></select></form>',
    '<script>var t = "</p>"; if (a < b) track(1);</script>',
    "<style>.a > .b { color: red }</style>",
    '<section class="comments"><h2>Comments</h2><div class="comment"><p>I think that this is wrong, and here is why, at length.</p></div></section>',
    '<ul class="related-posts"><li><a href="/1">Read this too</a></li></ul>',
    '<div hidden>not shown</div><div style="display: none">nor this</div>',
    "<!-- a comment with <p>tags</p> -->",
]


@pytest.mark.parametrize("furniture", FURNITURE)
@pytest.mark.parametrize("article", [ARTICLE, PARTS], ids=["article", "div"])
def test_furniture_goes(article, furniture):
    expected = f"The headline {BODY}"
    assert main_text(page(article, before=furniture)) == expected
    assert main_text(page(article, after=furniture)) == expected
    assert main_text(page(article.replace("</p><p>", f"</p>{furniture}<p>"))) == expected


def test_all_at_once():
    assert main_text(page(ARTICLE, "".join(FURNITURE[:7]), "".join(FURNITURE[7:]))) == f"The headline {BODY}"


def test_references_blanks_and_blocks():
    article = f"<article><h1> A\n  <b>bo</b>ld&nbsp;&eacute;&#x41;&#66; &lt;tag&gt; </h1><p>one<br>two</p><p>{LONG}</p><ul><li>x<li>y</ul>tail</article>"
    assert main_text(page(article)) == " ".join(f"A bold éAB <tag> one two {LONG} x y tail".split())


def test_unclosed_and_stray_tags():
    broken = f"<article><h1>Head</h1><p><b>bold start.<br><p>{LONG}<p>{MORE}</div></b></article><footer>foot</footer>"
    assert main_text(f"<html><body>{MENU}{broken}") == f"Head bold start. {BODY}"


def test_short_paragraphs_stay():
    article = f"<div class='content'><h1>Head</h1><p>{LONG}</p><p>Yes.</p><blockquote>Quote.</blockquote><p>{MORE}</p></div>"
    assert main_text(page(article, MENU)) == " ".join(f"Head {LONG} Yes. Quote. {MORE}".split())


def test_links_inside_the_article_stay():
    article = f'<article><p>{LONG}<a href="/l">a link</a> goes on.</p><p>{MORE}</p></article>'
    assert "a link goes on." in main_text(page(article, MENU))


def test_link_lists_without_names_go():
    links = "<div>" + "".join(f'<a href="/{n}">Link number {n}</a> ' for n in range(30)) + "</div>"
    assert main_text(page(PARTS, links, links)) == f"The headline {BODY}"


def test_plain_empty_and_odd():
    assert main_text("") == "" and main_text("<html><body></body></html>") == ""
    assert main_text("just text") == "just text"
    assert main_text("<p>a < b & c</p>") == "a < b & c"
    assert main_text("<div>" * 5000 + LONG + "</div>" * 5000) == LONG.strip()
    assert main_text("<br>".join(["line of text"] * 50)) == " ".join(["line of text"] * 50)
    for broken in ["<", "<p", "<!--", "<script>", "&", "&#", "&#xFFFFFFF;", "</", "<![CDATA[x", "<a href='", "\x00<p>\x00"]:
        main_text(f"<p>{LONG}</p>{broken}")


def paragraphs(name, count):
    return "".join(f"<p>{name} {number}: {LONG}</p>" for number in range(count))


def plain(*parts):
    return " ".join(" ".join(parts).replace("<p>", " ").replace("</p>", " ").split())


def test_sibling_articles_stay():
    first, second = paragraphs("first", 5), paragraphs("second", 4)
    found = main_text(page(f"<h1>Head</h1><article>{first}</article><article>{second}</article>", MENU))
    assert plain(first) in found and plain(second) in found


def test_articles_around_an_article_stay():
    lead, inner, tail = paragraphs("lead", 1), paragraphs("inner", 6), "<p>Short tail.</p>"
    assert main_text(page(f"<article>{lead}<article>{inner}</article>{tail}</article>", MENU)) == plain(lead, inner, tail)
    comment = '<article class="comment"><p>I think that this is wrong.</p></article>'
    assert main_text(page(f"<article>{inner}{comment}</article>", MENU)) == plain(inner)


def test_text_of_main_beside_the_article_stays():
    lead, inner, tail = "<p>A lead.</p>", paragraphs("inner", 6), paragraphs("tail", 1)
    assert main_text(page(f"<main>{lead}<article>{inner}</article>{tail}</main>", MENU)) == plain(lead, inner, tail)


@pytest.mark.parametrize("wrapper", ['div class="article-body share-enabled"', 'div class="content has-sidebar"', 'section id="legal-history"', 'form action="/"', 'div class="no-comments"'])
def test_names_do_not_remove_most_of_the_text(wrapper):
    inner = f"<{wrapper}>{FURNITURE[4]}<p>{LONG}</p><p>{MORE}</p></{wrapper.split()[0]}>"
    assert main_text(page(inner, MENU)) == BODY
    assert main_text(page(f"<article><h1>The headline</h1>{inner}</article>", MENU)) == f"The headline {BODY}"


def test_long_comments_go():
    comments = f'<div class="comments"><p>{"A comment that goes on. " * 60}</p></div>'
    assert main_text(page(PARTS, MENU, comments)) == f"The headline {BODY}"


def test_table(spark):
    rows = [(1, "u", page(ARTICLE, MENU), "x"), (1, "u", page(ARTICLE, MENU), "x"), (None, None, None, "y"), (3, "v", "", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = sorted((tuple(r) for r in extract(pages).collect()), key=repr)
    text = f"The headline {BODY}"
    assert out == sorted([(1, "u", text, len(text))] * 2 + [(None, None, "", 0), (3, "v", "", 0)], key=repr)
    assert extract(pages.limit(0)).count() == 0


STORY = "<p>One sentence of the story here.</p><p>Two sentences it has in all.</p>"
SIDE = "<p>First line of the bar, and long.</p><p>Second line, longer than the rest of it.</p><p>Third line.</p><p>Fourth line.</p>" * 3


@pytest.mark.parametrize(
    "name", ["sidebar", "cookie-notice", "newsletter", "comments", "related-posts", "ad", "promo", "footer", "breadcrumbs", "popup", "consent"]
)
@pytest.mark.parametrize("times", [1, 20])
def test_furniture_goes_however_long_it_is(name, times):
    text = "Head One sentence of the story here. Two sentences it has in all."
    for kind in ("class", "id"):
        furniture = f'<div {kind}="{name}">{SIDE * times}</div>'
        for story in (f"<article><h1>Head</h1>{STORY}</article>", f"<div><h1>Head</h1>{STORY}</div>", f"<main><h1>Head</h1>{STORY}</main>"):
            assert main_text(page(story, before=furniture)) == text
            assert main_text(page(story, after=furniture)) == text
            assert main_text(page(story.replace("</p><p>", f"</p>{furniture}<p>"))) == text


def test_a_name_that_tells_of_another_part_is_none():
    for name in ("has-sidebar", "noComments", "with_newsletter", "content without-cookie"):
        assert main_text(page(f"<p>Lead.</p><div class='{name}'>{STORY}</div>")).endswith("in all.")


def test_furniture_that_is_all_there_is_stays_once():
    both = f'<div class="promo">{STORY}</div><div class="sidebar"><p>Less.</p></div>'
    assert main_text(page(both)) == "One sentence of the story here. Two sentences it has in all."


@pytest.mark.parametrize("broken", ["<div>", "</div>", "</span>", "<p>", "<!-- ", '<a href="', "<a href='x ", "<a ", "<?", "</", "<td>", "<span></div>", "<b>", "<", "<li>"])
def test_broken_pages_take_linear_time(broken):
    import time

    start = time.perf_counter()
    found = main_text(f"<p>{LONG}</p><p>{MORE}</p>" + broken * (1_000_000 // len(broken)))
    assert found.startswith(BODY) or broken == "<td>"
    took = time.perf_counter() - start
    assert took < 20, took


def test_half_open_markup():
    assert main_text("<p>a</p><!-- b <p>c</p>") == "a b c"
    assert main_text("<p>a <!-- b --> c <!-- d --> e</p>") == "a c e"
    assert main_text("<p>a</p><script><!-- x</script><p>b</p>") == "a b"
    assert main_text("<p class=x id='y' hidden>a</p><p data-x=\"<b>\">b</p>") == "b"
    assert main_text("<p>a<p class=\"ad\"\n>b</p><p>c</p ><P>d</P>") == "a c d"
    assert main_text("<title>x</title><p>1 < 2 &lt; 3 <3</p><?php x ?><!DOCTYPE y>") == "1 < 2 < 3 <3"


class Node:
    def __init__(self, tag, children=(), text=""):
        self.tag, self.children, self.text = tag, [], text
        for child in children:
            # text beside text is one text
            if not child.tag and self.children and not self.children[-1].tag:
                self.children[-1].text += child.text
            else:
                self.children.append(child)

    def html(self):
        return self.text if not self.tag else f"<{self.tag}>{''.join(c.html() for c in self.children)}</{self.tag}>"

    def all(self):
        yield self
        for child in self.children:
            yield from child.all()

    def words(self):
        return [w for node in self.all() for w in node.text.split()]

    def counts(self, linked=False):
        """Characters, tags below, characters in links, links below."""
        linked = linked or self.tag == "a"
        out = [len("".join(self.text.split())), 0, len("".join(self.text.split())) if linked else 0, 0]
        for child in self.children:
            c = child.counts(linked)
            out = [out[0] + c[0], out[1] + c[1] + bool(child.tag), out[2] + c[2], out[3] + c[3] + (child.tag == "a")]
        return out


def brute_force(body):
    """Composite text density written down as it is defined, every subtree walked anew."""
    import math

    above = {id(child): node for node in body.all() for child in node.children}
    in_link = lambda n: n.tag == "a" or id(n) in above and in_link(above[id(n)])
    chars, _, of_links, _ = body.counts()

    def density(node):
        c, t, lc, lt = node.counts(id(node) in above and in_link(above[id(node)]))
        if not c:
            return 0.0
        other, t, lc_, lt = max(1, c - lc), max(1, t), max(1, lc), max(1, lt)
        scale = math.log(c / other * lc_ + of_links / max(1, chars) * c + math.e)
        return c / t * max(0.0, math.log(c / lc_ * t / lt)) / math.log(scale)

    total = lambda node: sum(density(child) for child in node.children)
    nodes = list(body.all())

    def richest(node):
        return max(node.all(), key=lambda n: (total(n), -nodes.index(n)))

    centre = richest(body)
    path = [centre]
    while id(path[-1]) in above:
        path.append(above[id(path[-1])])
    threshold = min(map(density, path))
    chosen = {id(n) for node in nodes if density(node) >= threshold for n in richest(node).all()}
    return [w for node in nodes if id(node) in chosen for w in node.text.split()]


def test_density_against_brute_force():
    import random

    draw = random.Random(4)

    def grow(depth):
        if depth == 0 or draw.random() < 0.3:
            return Node("", text=" " + " ".join(f"w{draw.randrange(99)}" for _ in range(draw.choice([0, 1, 3, 30, 120]))) + " ")
        tag = draw.choice(["div", "div", "section", "span", "a", "ul", "blockquote"]) if depth > 1 else draw.choice(["span", "a", "b"])
        return Node(tag, [grow(depth - 1) for _ in range(draw.randrange(0, 5))])

    partial = 0
    for _ in range(300):
        body = Node("body", [grow(4) for _ in range(draw.randrange(1, 6))])
        expected = brute_force(body)
        assert main_text("<html>" + body.html() + "</html>").split() == expected, body.html()
        partial += 0 < len(expected) < len(body.words())
    assert partial > 20
