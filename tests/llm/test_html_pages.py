"""Main text of hand-made pages that the training pages don't hold: shapes, wrappers, and the precision and recall of blocks."""

import pytest

from lakeops.llm import html_text

P = "This paragraph has more than enough words to be taken for the content of a page by any rule."
Q = "A second one tells a little more about it, again in words and not in links, so that nobody takes it for a menu."


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<form><article><h1>Title</h1><p>{P}</p><p>Yes.</p></article></form>", f"Title\n{P}\nYes."),
        (f"<form id=aspnetForm><div id=menu><a>Home</a> <a>News</a></div><div id=body><h1>Title</h1><p>{P}</p><p>Yes.</p><p>{Q}</p></div></form>", f"Title\n{P}\nYes.\n{Q}"),
        (f'<div class="social"><div id="content"><h1>Title</h1><p>{P}</p></div></div>', f"Title\n{P}"),
        (f'<div class="post-header-wrap content"><p>{P}</p><p>{Q}</p></div>', f"{P}\n{Q}"),
        (f'<article><p>{P}</p><section id="side-effects"><p>Nausea.</p></section><section class="legal-analysis"><p>{Q}</p></section></article>', f"{P}\nNausea.\n{Q}"),
        (f"<h1>Title</h1><p>{P}</p><p>Yes.</p><p>{Q}</p>", f"Title\n{P}\nYes.\n{Q}"),
        (f"<article><p>{P}</p><button>Buy</button><label>Amount</label><p>{Q}</p></article>", f"{P}\n{Q}"),
        (f"<article><p>{P}</p><p>{Q}</p><ul><li><a href=/>One other story</a></li><li><a href=/>Second other story</a></li><li><a href=/>Third one</a></li></ul></article>", f"{P}\n{Q}"),
        (f"<article><p>{P}</p><p><a href=/>Only a link</a></p><p>{Q}</p></article>", f"{P}\nOnly a link\n{Q}"),
        ("<nav><a href=/>Home</a></nav><footer>All rights reserved by somebody or other</footer>", ""),
        ("<article>One</article>", "One"),
        ("<div class=ad>Buy this now, it is the very best of all that you could buy</div><article><p>No.</p></article><footer>A long line of words at the end of the page</footer>", "No."),
    ],
)
def test_shapes(page, text):
    assert html_text.main_text(page) == text


#: Labelled like the training pages; none of them is one of those.
HELD_OUT = [
    "<header class=site-header><a>-2</a> -3</header><div role=main><article class=post><h1>+7</h1><p>+35</p><h2>+2</h2><p>+55</p><p>+1</p></article></div><div id=sidebar><p>-25</p><ul><li><a>-3</a><li><a>-4</a></ul></div>",
    "<body><form method=post><table><tr><td><a>-1</a><td><a>-1</a></table><div class=page><h1>+4</h1><p>+28</p><p>+5</p><p>+70</p></div><p class=copyright>-6</p></form>",
    "<div class='layout with-sidebar'><main><h1>+5</h1><p>+44</p><ul><li>+7<li>+9<li>+4</ul><p>+31</p><div class='share links'><a>-1</a> <a>-1</a></div></main><aside><p>-40</p></aside></div>",
    "<div id=header-wrapper><div class=content><h1>+6</h1><div>+50</div><div>+41</div></div></div><div id=site-footer>-18</div>",
    "<article><h1>+5</h1><p>+30</p><div class='newsletter box'><p>-14</p><button>-2</button></div><p>+42</p></article><section id=reader-comments><p>-3</p><p>-33</p><p>-48</p></section>",
    "<article><p>+25</p></article><div class=comments-list><article><p>-45</p></article><article><p>-35</p></article><form><label>-2</label></form></div>",
    "<h1>+3</h1><p>+40</p><h2>+4</h2><p>+33</p><p>+2</p><p>+52</p><div class='pager'><a>-1</a> <a>-1</a></div>",
    "<ul class=topnav><li><a>-1</a><li><a>-2</a><li><a>-1</a></ul><div>+37</div><div>+6</div><div>+45</div><div class=footer-links><a>-2</a> <a>-2</a></div>",
    "<main><h1>+6</h1><div class=alert>-12</div><p>+51</p><pre>+14</pre><blockquote>+22</blockquote><p>+8 <a>+2</a></p></main><div class=cookie-bar>-22</div>",
    "<div class=widget-wrap><article><header><h1>+5</h1><p>+3</p></header><p>+61</p><figure><figcaption>+6</figcaption></figure><p>+20</p></article></div><div class=related-posts><h3>-2</h3><a>-6</a></div>",
    "<nav><a>-1</a> <a>-2</a></nav><section><h2>+4</h2><p>+48</p><table><tr><td>+3<td>+2<tr><td>+5<td>+1</table><p>+39</p></section><footer><p>-35</p><p>-12</p></footer>",
    "<fieldset><legend>-1</legend><label>-2</label></fieldset><article><h1>+4</h1><p>+1</p><p>+77</p><div class=sponsored><p>-9</p></div></article>",
    "<div><a>-1</a> <a>-1</a> <a>-2</a></div><h1>+8</h1><p>+46</p><p>+58</p><div><a>-4</a></div><div><a>-5</a></div><div><a>-3</a></div>",
    "<article><h1>+5</h1><p>+64</p><p><a>+5</a></p><p>+20</p><ul><li><a>-5</a><li><a>-6</a><li><a>-4</a></ul></article>",
]


def test_blocks_of_pages_not_trained_on():
    table = html_text.training_table(HELD_OUT, times=10, seed=99)
    label, found = table[:, 0] == 1, html_text.predict(html_text.trained(), table[:, 1:]) >= 0.5
    precision, recall = (label & found).sum() / found.sum(), (label & found).sum() / label.sum()
    print(f"precision {precision:.3f} recall {recall:.3f} of {len(table)} blocks")
    assert precision > 0.95 and recall > 0.97


def test_training_pages_are_learnt():
    table = html_text.training_table()
    found = html_text.predict(html_text.trained(), table[:, 1:]) >= 0.5
    assert (found == (table[:, 0] == 1)).mean() > 0.99
    # names and elements alone decide nothing: with them taken away most blocks are still told apart
    plain = table.copy()
    at = [1 + html_text.FEATURES.index(f) for f in ("strict", "listed", "control", "article")]
    plain[:, at] = 0
    tree = html_text.fit_tree(plain[:, 1:], plain[:, 0])
    assert ((html_text.predict(tree, plain[:, 1:]) >= 0.5) == (plain[:, 0] == 1)).mean() > 0.85


@pytest.mark.parametrize("name", ["side-effects", "legal-analysis", "advance", "ad-hoc", "menu-of-the-day", "shareholders", "notice-period-law"])
def test_names_that_only_begin_like_others(name):
    assert not html_text.OUTSIDE_NAMES.search(name)


@pytest.mark.parametrize("name", ["ad", "ad-slot", "site-footer", "main_nav", "sidebar-left 2", "cookie-bar", "share links", "footer-links", "page-header"])
def test_names_of_no_content(name):
    assert html_text.OUTSIDE_NAMES.search(name)


@pytest.mark.parametrize("page", ["", "<", "<a", "</p>", "<p", "<!--", "<![CDATA[", "<script>", "<p>&#0;&#xD800;&bogus;</p>", "<div " + "x" * 5000, "<p>" * 3000 + "deep"])
def test_broken_pages_do_not_crash(page):
    assert isinstance(html_text.main_text(page), str)
