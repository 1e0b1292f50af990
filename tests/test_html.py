"""HTML lines against a tree built with the standard library's parser."""

import html as stdlib_html
import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from textrec.functions import html as H
from textrec.sources import readers as RD


class Tree(HTMLParser):
    """Elements as [name, children, place]; texts, comments and declarations as str."""

    def __init__(self, page):
        super().__init__(convert_charrefs=False)
        self.root = ["", [], -1]
        self.open, self.data, self.place = [self.root], "", 0
        self.feed(page)
        self.close()
        self.flush()

    def flush(self):
        if self.data:
            self.open[-1][1].append(self.data)
            self.data = ""

    def handle_starttag(self, tag, attrs):
        self.flush()
        element = [tag, [], self.place]
        self.place += 1
        self.open[-1][1].append(element)
        if tag not in H.VOID:
            self.open.append(element)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in H.VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.flush()
        if any(e[0] == tag for e in self.open[1:]):
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        self.data += data

    def handle_entityref(self, name):
        known = name in H.NAMED or name in H.LATIN1
        self.data += stdlib_html.unescape(f"&{name};") if known else f"&{name};"

    def handle_charref(self, name):
        self.data += stdlib_html.unescape(f"&#{name};")

    def handle_comment(self, data):
        self.flush()
        self.open[-1][1].append(data)

    handle_decl = handle_pi = handle_comment


def string(e):
    if isinstance(e, str):
        return e
    return string(e[1][0]) if len(e[1]) == 1 else None


def walk(e, above=()):
    yield e, above
    for c in e[1]:
        if not isinstance(c, str):
            yield from walk(c, (*above, e))


def brute(page, heading="h2", text="Lyrics", container="div", least=2):
    tree = Tree(page).root
    head = next(((e, a) for e, a in walk(tree) if e[0] == heading), None)
    if head is None or (text is not None and string(head[0]) != text):
        return []
    box = next((e for e in reversed(head[1]) if e[0] == container), None)
    if container is None:
        box = tree
    if box is None:
        return []
    found = [string(e) for e, _ in walk(box) if e[0] == "p" and e is not box]
    return sorted(s for s in found if s is not None and s.count(" ") > least)


GOLDEN = [
    ("<div><h2>Lyrics</h2><p>a b c d</p></div><p>x y z w out</p>", ["a b c d"]),
    ("<div><p>be fore the head</p><div><h2>Lyrics</h2><p>in n e r</p></div></div>", ["in n e r"]),
    ("<div><h2><b>Lyrics</b></h2><p><i><b>one two three four</b></i></p></div>", ["one two three four"]),
    ("<div><h2>Lyrics</h2><p>a b c <b>d</b> e f g</p><p>a b c<br>d e f g</p></div>", []),
    ("<div><h2>About</h2><h2>Lyrics</h2><p>a b c d</p></div>", []),
    ("<div><h2>Lyrics</h2><p>rock &amp; roll &#39;n&#x27; soul &eacute; &unknown; x</p></div>",
     ["rock & roll 'n' soul é &unknown; x"]),
    ("<h2>Lyrics</h2><p>no div a round</p>", []),
    ("<div><h2>Lyrics</h2><p>a b c d<p>e f g h</div>", ["e f g h"]),
    ('<div title="a>b"><h2>Lyrics</h2><script>var p = "<p>s c r i pt</p>";</script><p class=\'>\'>a b c < d</p></div>',
     ["a b c < d"]),
    ("<div><h2>Lyrics</h2><p><!-- a com ment here --></p><p>x <!-- a b c d --> y z w</p></div>", [" a com ment here "]),
    ("<div><h2>Lyrics</h2><p>a b c</p><p>a  b c</p></div>", ["a  b c"]),
    ("<div><h2>Lyrics</h2><div></div></p><p>one two</b> three four</p></div>", []),
    (None, []), ("", []), ("no tags at all", []),
]


def lines(spark, pages, **more):
    df = spark.createDataFrame(list(enumerate(pages)), "id int, html string")
    out = {}
    for r in RD.html_lines(df, **more).collect():
        out.setdefault(r.id, []).append(r.lyric_line)
    return [sorted(out.get(i, [])) for i in range(len(pages))]


def test_golden_pages(spark):
    assert lines(spark, [p for p, _ in GOLDEN]) == [want for _, want in GOLDEN]
    assert [brute(p or "") for p, _ in GOLDEN] == [want for _, want in GOLDEN]


def made(rnd):
    names = ["div", "p", "p", "b", "i", "h2", "span", "br", "DIV"]
    texts = ["Lyrics", "a b c d", "e f", " ", "x &amp; y z w", "one < two < three four", "&copy; m n o", "\n", "é 😀 u v &#8211; &#150; w"]
    out = []
    for _ in range(rnd.randint(1, 30)):
        out.append(rnd.choice([lambda: f"<{rnd.choice(names)}>", lambda: f"</{rnd.choice(names)}>", lambda: rnd.choice(texts),
                               lambda: "<h2>Lyrics</h2>", lambda: f"<p>{rnd.choice(texts)}</p>", lambda: "<!--c o m m-->",
                               lambda: "<span/>", lambda: f'<p id="{rnd.randint(0, 9)}" t=\'>\'>'])())
    return "<div>" * rnd.randint(0, 1) + "".join(out)


@pytest.mark.parametrize("more", [{}, {"heading_text": None}, {"container": None, "heading_tag": "span", "heading_text": None}])
def test_random_pages(spark, more):
    rnd = random.Random(11)
    pages = [made(rnd) for _ in range(400)]
    keys = {"heading_tag": "heading", "heading_text": "text"}
    assert lines(spark, pages, **more) == [brute(p, **{keys.get(k, k): v for k, v in more.items()}) for p in pages]


def test_references(spark):
    cases = ["&amp;&lt;&gt;", "&amp;amp;", "a & b", "&", "&;", "&#65;&#x42;", "&#0;", "&#xD800;", "&#1114112;", "&#128512;", "&#150;", "&copy 1",
             "&nosuch;", "&yuml;&nbsp;"]
    want = ["&<>", "&amp;", "a & b", "&", "&;", "AB", "�", "�", "�", "😀", "–", "© 1", "&nosuch;", "ÿ\xa0"]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, s string")
    assert [r.s for r in df.select("i", H.decode_references(F.col("s")).alias("s")).orderBy("i").collect()] == want


def test_a_long_page(spark):
    page = "<div><h2>Lyrics</h2>" + "".join(f"<p>line {i} of it all</p><b>x</b>" for i in range(3000)) + "</div>"
    assert len(lines(spark, [page])[0]) == 3000
