"""Class words of articles and of what is in them."""

from __future__ import annotations

import pytest

from haltwerk.llm.html_text import blocks_of


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><header class='entry-header'><h1>T</h1></header><p>x</p></article>", ["T", "x"]),
        ("<article class='post category-legal'><p>x</p></article><div class='legal-text'>no</div>", ["x"]),
        ("<article class='tag-search'>x</article><main class='comment-form-open'><p>y</p></main>", ["x"]),
        ("<main class='comment-form-open'><p>y</p></main><div class='share-bar'>no</div>", ["y"]),
        ("<article><p class='side-note'>a</p><p class='legal-text'>b</p><p id='notice-board'>c</p><p class='share-price'>d</p></article>", ["a", "b", "c", "d"]),
        ("<article><p>a</p><div class='share'>no</div><div class='x search-form'>no</div><div class='cookie-bar'>no</div><div class='sidebar-left'>no</div></article>", ["a"]),
        ("<div class='comments'><article class='post'>no</article></div><article>a</article><article role='complementary'>no</article>", ["a"]),
    ],
)
def test_class_words_inside_an_article(page, text):
    assert [b.text for b in blocks_of(page) if b.role == 2] == text
