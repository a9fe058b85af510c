"""What may stand within an article's blocks, and pages of great depth."""

import time

import pytest

from hopscope.llm.html_extract import main_text

PAGE = "<nav><a href=/>Menu, of links.</a></nav><article><h1>Title</h1><p>First, a sentence of some length; it goes on.</p>%s</article><footer>Foot.</footer>"
FIRST = "Title\nFirst, a sentence of some length; it goes on."


@pytest.mark.parametrize(
    "body, want",
    [
        ("<p>Pass <a class='share' href=x>this</a> on, please.</p>", "Pass this on, please."),
        ("<p>An <nobr>unbroken</nobr> and <custom-x>unknown</custom-x> word.</p>", "An unbroken and unknown word."),
        ("<p>Before<script>x = '<p>';</script>, and <button>Buy</button>after.</p>", "Before, and after."),
        ("<p>Before <noscript><div>No script.</div></noscript>after.</p>", "Before after."),
        ("<p>A <select><option>one<option>two</select> choice.</p>", "A choice."),
        ("<blockquote class='comment'>As they said, then.</blockquote>", "As they said, then."),
        ("<header><p>The lead, in short.</p><div>Menu</div></header>", "The lead, in short."),
        ("<p>One<i>, <b>two</p><p>three</b></i>, four.</p>", "One, two\nthree, four."),
        ("<ul><li>a<ul><li>b</ul><li>c</ul><table><tr><td>d<td>e<tr><th>f</table>", "a\nb\nc\nd\ne\nf"),
        ("</i></b></p><p>Ends of nothing.</p></x-y>", "Ends of nothing."),
    ],
)
def test_blocks_of_articles(body, want):
    assert main_text(PAGE % body) == FIRST + "\n" + want


@pytest.mark.parametrize("tag", ["div", "b", "li", "blockquote", "x-y", "div class='ad'"])
def test_deep_pages(tag):
    n = 100_000
    began = time.perf_counter()
    text = main_text("".join(f"<{tag}>w{i}, x. </i>" for i in range(n)))
    assert time.perf_counter() - began < 30
    assert "ad" in tag or text.split()[::2] == [f"w{i}," for i in range(n)]
