"""Tags, nested tables and links by a stack of open elements."""

import time
from html.parser import HTMLParser

import pytest

from cropweave.functions import markup


class Plain(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.found = []

    def handle_starttag(self, tag, attrs):
        self.found.append(("open", tag))

    handle_startendtag = handle_starttag

    def handle_endtag(self, tag):
        self.found.append(("close", tag))


@pytest.mark.parametrize("text", [
    "<p>a<b x='>' y=\">\">c</b><br/>d", "<!-- <i> --><a href=x>t</a >", "a < b <c", "<script>if (a<b) '<p>'</script><q>", "<STYLE>p{}</Style><I>", "<!doctype html><td\n x>"])
def test_tags_as_a_parser_sees_them(text):
    parser = Plain()
    parser.feed(text + " ")
    parser.close()
    assert [(k, n) for k, n, _ in markup.tags(text + " ") if k != "text"] == parser.found


def test_nested_tables():
    text = "<table><tr><td>a<table><tr><td>b<td>c</table>d</td><td>e</tr><td>f</table><td>none<table><td>g &amp; h<br>i"
    assert markup.table_rows(text) == [(0, -1, 0, ["ad", "e", "f"]), (1, 0, 0, ["b", "c"]), (2, -1, 0, ["g & h\ni"])]
    assert markup.table_rows("<table><tr><th>h<tr><td>1</td><td></td></tr></table>") == [(0, -1, 0, []), (0, -1, 1, ["1", ""])]
    assert markup.table_rows("") == [] and markup.table_rows("</table></tr><td>x") == []


def test_nested_links():
    assert markup.links("<div onclick=a> x <div> y </div> z</div><a href=b title='t&lt;'>u<a href=c>v") == [
        ("onclick", "a", "xyz", ""), ("href", "b", "u", "t<"), ("href", "c", "v", "")]
    assert markup.links("<a href=p onclick=q>r</a><a name=n>s</a></a></div>") == [("href", "p", "r", ""), ("onclick", "q", "r", "")]


@pytest.mark.parametrize("unit", ["<a href='x", "<", "<td ", '<a title="', "<div onclick=x>", "<table><tr><td>", "</a>", "<!--", "<script>", "<a href=x>y"])
def test_time_grows_with_the_length(unit):
    def seconds(n):
        text = unit * n
        start = time.perf_counter()
        markup.table_rows(text)
        list(markup.tags(text))
        if "onclick" not in unit:
            markup.links(text)
        return time.perf_counter() - start

    assert seconds(40_000) < 12 * seconds(10_000) + 0.3
