import random
import re
import time
from html import escape, unescape
from html.parser import HTMLParser

import pytest

from lodestrata.llm import layout


def lines(html):
    return layout.render(html).split("\n")


def test_blocks_and_implied_ends():
    assert lines("<p>One<p>Two <b>bold</b>\n text<br>next<div>block</div>tail") == ["One", "", "Two bold text", "next", "", "block", "tail"]
    assert lines("text<title>t</title><h1>A<h2>B</h1>c") == ["text", "", "A", "", "B", "", "c"]
    assert lines("<table><tr><td>a<td>b<tr><td>c</table>d") == ["a  b", "c", "", "d"]
    assert lines("<dl><dt>T<dd>D<dt>U<dd>E</dl>") == ["T", "  D", "U", "  E"]
    assert lines("<select><option>a<option>b</select>") == ["a", "b"]


def test_lists_nest_and_count():
    assert lines("<ul><li>a<ul><li>b</ul><li>c</ul><ol start=9><li>x<li>y<br>z</ol>") == ["- a", "  - b", "- c", "", "9. x", "10. y", "    z"]
    assert lines("<ol start=bad><li><p>p<p>q</ol>") == ["1. p", "", "   q"]


def test_tables_align_by_width():
    assert lines("<table><tr><th>Name<th>N<tr><td>日本<td>1<tr><td>é<td>22</table>") == ["Name  N", "日本  1", "é     22"]
    assert lines("<table><tr><td colspan=2>wide<td>x<tr><td>a<td rowspan=2>b<td>c<tr><td>d<td>e</table>") == ["wide     x", "a     b  c", "d        e"]
    assert lines("<table><caption>Cap</caption><tr><td>a<br>b<td>c</table>") == ["Cap", "a  c", "b"]
    assert lines("<table><tr><td>o<table><tr><td>i<td>j</table></table>") == ["o", "", "i  j"]


def test_visibility():
    html = '<style>.x, #y {display:none} p.z{visibility: hidden}</style><div class="a x">1</div><p id=y>2</p><p class=z>3</p><div class=z>4</div><i hidden>5</i><b style="DISPLAY : none">6</b><script>7</script><noscript>8</noscript><template>9</template><details><summary>S</summary>10</details><details open>11</details><dialog>12</dialog><input value=13><!-- 14 --><textarea> t </textarea><img alt="pic">'
    assert layout.render(html).split() == ["4", "S", "11", "t", "pic"]


def test_white_space_and_entities():
    assert layout.render("<p>a\n  b&nbsp;&amp;&lt;c&gt; <i> d </i> e</p>") == "a b\xa0&<c> d e"
    assert layout.render("<pre>  keep\n\n   this\n</pre>after") == "  keep\n\n   this\n\nafter"
    assert layout.render("a<wbr>b<span>c</span> <q>d</q>") == 'abc "d"'


def test_broken_and_empty_pages():
    assert layout.render(None) is None and layout.render("") == "" and layout.render("<p></p><div> </div>") == ""
    assert layout.render("a < b <c d='>'>e</c> </nope> <p") == "a < b e"
    assert layout.render("<script>never closed <p>x") == "" and layout.render("<!-- never closed") == ""
    assert layout.render("<div>" * 3000 + "deep" + "</div>" * 10) == "deep"
    assert len(layout.render("<td>x" * 2000).split()) == 2000
    assert len(layout.render("<p>word " * 50_000)) > 200_000


def test_operator(spark):
    df = spark.createDataFrame([(1, "<p>a", "k"), (1, "<p>a", "k"), (None, None, "k"), (2, "", "k")], "page_id long, html string, text string")
    got = sorted((str(r["page_id"]), str(r["text"])) for r in layout.extract(df).collect())
    assert got == [("1", "a"), ("1", "a"), ("2", ""), ("None", "None")]
    assert layout.extract(df.limit(0)).count() == 0


class Plain(HTMLParser):
    """An independent reader of tame pages: (words, lines without their marks and indents)."""

    BREAKS = set("p div h1 h2 h3 ul ol li nav article section header footer main aside br body table tr".split())

    def __init__(self, html):
        super().__init__()
        self.out, self.off = [], 0
        self.feed(html)
        self.close()
        self.lines = [x for x in (" ".join(line.split()) for line in "".join(self.out).split("\n")) if x]

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("script", "style", "title", "template")
        self.out.append("\n" if tag in self.BREAKS else " " if tag in ("td", "th") else "")

    def handle_endtag(self, tag):
        self.off -= tag in ("script", "style", "title", "template")
        self.out.append("\n" if tag in self.BREAKS else "")

    def handle_data(self, data):
        if not self.off:
            self.out.append(re.sub(r"\s+", " ", data))


def test_fixture_pages_against_a_plain_reader(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    assert len(rows) >= 200
    for r in rows:
        body = re.sub(r"(?s)<(script|style|title)\b.*?</\1>|<!--.*?-->|<!DOCTYPE[^>]*>", " ", r["html"])
        got = layout.render(r["html"])
        assert unescape(re.sub(r"<[^>]+>", " ", body)).split() == re.sub(r"(?m)^ *- ", "", got).split()
        if "<table" not in r["html"]:
            assert [" ".join(re.sub(r"^ *(- )+", "", x).split()) for x in got.split("\n") if x.strip()] == Plain(r["html"]).lines


def test_random_pages_against_a_plain_reader():
    rng = random.Random(7)

    def some(depth):
        kind = rng.random()
        if depth > 5 or kind < 0.4:
            return escape(rng.choice(["alpha", "beta  gamma", " d & e ", "<x>", "\n z"]))
        tag = rng.choice(["div", "section", "b", "i", "span", "main", "article"] if kind < 0.9 else ["br"])
        return "<br>" if tag == "br" else f"<{tag}>" + "".join(some(depth + 1) for _ in range(rng.randint(0, 4))) + f"</{tag}>"

    for _ in range(300):
        html = "<body>" + "".join(some(0) for _ in range(5))
        assert [" ".join(x.split()) for x in layout.render(html).split("\n") if x.strip()] == Plain(html).lines, html


def test_styles_for_other_media_hide_nothing():
    html = "<style>@media print{.m{display:none}} @media screen and (min-width:400px){.s{display:none}} @media (max-width: 600px){.n{display:none}} @font-face{src:x} @supports (a:b){@media all{.q{display:none}}}</style><style media=print>.p{display:none}</style>"
    assert layout.render(html + "<i class=m>1</i> <i class=s>2</i> <i class=n>3</i> <i class=q>4</i> <i class=p>5</i>") == "1 3 5"


def test_visibility_is_inherited_and_overridden():
    assert layout.render('<div style="visibility:hidden">a <b style="visibility:visible">b</b> <i>c</i><table><tr><td>d<td style="visibility:visible">e</table></div>f').split() == ["b", "e", "f"]
    assert layout.render('<style>.x{display:none} .y{display:block!important} #z{display:block}</style><p class=x id=z>1</p><p class="x y">2</p><p class=x style="display:block">3</p><p class=x>4</p><p hidden style="display:block">5</p>').split() == ["1", "2", "3", "5"]


def test_text_that_a_table_cannot_hold_stands_before_it():
    assert lines("a<table>b<tr>c<td>d</td>e<td>f</tr><b>g</b></table>h") == ["abceg", "", "d  f", "", "h"]
    assert lines("<table><tr><table><tr><td>in</table>") == ["in"]
    assert lines("<table><tbody><td>x<tr><td>y</table>") == ["x", "y"]


def test_drawings_and_formulas():
    assert layout.render("<svg><title>t</title><desc>d</desc><style>s</style><text>shown <tspan>too</tspan></text>not</svg> <math><mi>x</mi><mo>=</mo><annotation>n</annotation></math>") == "shown too x="


def test_depth_changes_nothing_but_indents():
    deep = "<div>" * 1000
    assert lines(f'{deep}<ul><li>a<li>b</ul><p>x<p>y<img alt="pic"><table><tr><td>1<td>2<tr><td>333<td>4</table>') == ["- a", "- b", "", "x", "", "ypic", "", "1    2", "333  4"]
    nested = "<table><tr><td>k<td>" * 30 + "x"
    assert layout.render(nested).split() == ["k"] * 30 + ["x"]


MB = 1 << 20


@pytest.mark.parametrize("unit, end", [("<div>", "deep"), ("<a ", '"'), ("<a b='", ""), ("<", ""), ("<!---->", ""), ("<!--", ""), ("<ul><li>x", ""), ("<table><tr><td>x<td>y", ""), ("<b>", "x"), ("<td colspan=1000 rowspan=65534>x", "</table>"), ("<p><table><td><span><div>", ""), ("<table>x<td>y<tr>", ""), ("<blockquote>x", ""), ("<q>", ""), ("&", ""), ("<style>/*", ""), ("</p>", "")])
def test_a_megabyte_of_any_markup_takes_time_in_proportion(unit, end):
    began = time.process_time()
    layout.render(unit * (MB // len(unit)) + end)
    assert time.process_time() - began < 6  # 1 to 2 seconds by itself
