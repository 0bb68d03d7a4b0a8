"""Pages whose article stands in a wrapper with a telling name."""

import pytest

from lakeops.llm import html_text

PROSE = "This paragraph has more than enough words to be taken for the content of a page by any rule."


@pytest.mark.parametrize(
    "wrapper",
    ["class='layout has-sidebar'", "id='page' class='no-sidebar'", "class='with-menu'", "class=page-header", "id=main-menu-layout", "class='share side'", "role=social", "class=has_footer"],
)
@pytest.mark.parametrize("tag", ["article", "main"])
def test_article_in_a_named_wrapper_is_kept(wrapper, tag):
    page = f"<body><nav>Home</nav><div {wrapper}><div class=x><{tag}><h1>Title</h1><p>{PROSE}<div class='share'>Send this on</div></{tag}></div><p>Beside it</p></div></body>"
    assert html_text.main_text(page) == f"Title\n{PROSE}"


@pytest.mark.parametrize("wrapper", ["aside", "nav", "footer", "form", "div class=comments", "section id='post-comments'", "div class='related posts'", "div hidden"])
def test_articles_that_are_no_content_stay_outside(wrapper):
    page = f"<article><p>{PROSE}</article><{wrapper}><article><p>Another {PROSE}</article></{wrapper.split()[0]}>"
    assert html_text.main_text(page) == PROSE


def test_state_names_without_an_article():
    assert html_text.main_text(f"<div class='layout has-sidebar'><p>{PROSE}</p><div class=sidebar><p>{PROSE}</p></div></div>") == PROSE
    inside = f"<article><p>{PROSE}<div class='sidebar'><article>{PROSE}</article></div></article>"
    assert html_text.main_text(inside) == PROSE
