"""Plain listing pages read without the tolerant parser give what the parser gives."""

import random

import pytest

from sievework.sources.listing import _RowReader

PARTS = ["<table>", "</table>", "<tr class='row'>", "<tr>", "</tr>", "<td>", "</td>", "<th>", "<thead>", "</thead>", "<tbody>", "</tbody>", "<br>", "<img src='a.png'>",
         '<a href="#">', "</a>", "text", " a > b ", "\n", " x", "&amp;", "&nbsp", "<br/>", "<TD>", "<!-- c -->", "<script>", "</script>", "<title>", "</title >", "< td", "<td", "\0"]


def parsed(source):
    reader = _RowReader()
    reader.feed(source)
    return reader.finish()


@pytest.mark.parametrize("n", [20, len(PARTS)])
def test_both_ways_read_the_same(n):
    rng = random.Random(n)
    for _ in range(4000):
        source = "".join(rng.choice(PARTS[:n]) for _ in range(rng.randrange(40)))
        assert _RowReader().read(source) == parsed(source), source


def test_plain_pages_do_not_meet_the_parser(monkeypatch):
    def refuse(self, data):
        raise AssertionError("parsed")

    monkeypatch.setattr(_RowReader, "feed", refuse)
    page = "<table><tbody>\n<tr class='row'><td></td><td><a href='#'>t</a> </td><td><img src='p.png'></td></tr>\n</tbody></table>"
    assert _RowReader().read(page) == [[("", ""), ("t", "<a href='#'>t</a>"), ("", "<img src='p.png'>")]]
    with pytest.raises(AssertionError):
        _RowReader().read(page + "&amp;")
