"""The tag reader on malformed pages: no markup in the text, no text lost, time in proportion to the page."""

import time

import pytest

from riskweave.llm import html_text

OPEN, ARTICLE = html_text.OPEN, html_text.ARTICLE


@pytest.mark.parametrize("html, want", [
    ('<p class="a"">Hello</p>', ["Hello"]),
    ("<p title=it's>Hello <b>you</b></p>", ["Hello you"]),
    ('<p>one <a href="x>two</a> three</p><p>four</p>', ["one two three", "four"]),
    ("<p a='1' b=\"2>3\" c=4 d>x</p>", ["x"]),
    ("<p>a < b and 3<4</p>", ["a < b and 3<4"]),
    ("<p>1<br/>2<p>3", ["1", "2", "3"]),
    ("x</div></div>y<div>z", ["x", "y", "z"]),
    ("a<!-- <p>b</p> -->c<!-- never closed <p>d", ["ac"]),
    ("a<script>if (a<b) '</p>'</script >b<style>p{}", ["a", "b"]),
    ("<p>cut off <a href='x' ", ["cut off"]),
    ("<>a</ >b<!doctype html>c", ["<>abc"]),
    ("", []),
])
def test_malformed_markup(html, want):
    assert [t for _, t in html_text.blocks(html)] == want


def test_labels_of_articles_stay_and_those_of_forms_go():
    found = html_text.blocks("<article>a <label>b</label><form><label>c</label></form></article><label>d</label>")
    assert [t for kind, t in found if kind == ARTICLE] == ["a", "b"]
    assert [t for kind, t in found if kind == OPEN] == []


@pytest.mark.parametrize("html", [
    "<a " * 350_000, '<a href="' * 120_000, "<a href='x " * 100_000, "<div>" * 100_000 + "</x>" * 100_000,
    "<p>" + "<b>" * 60_000 + "<div></div>" * 60_000, "<b>" * 60_000 + "<div></div>" * 60_000, "<ul>" + "<li>x" * 100_000,
    "<" * 1_000_000, "<script>" + "</script " * 100_000, "<!--" * 250_000, "<p " + "x" * 1_000_000, "&" * 1_000_000,
])
def test_a_megabyte_takes_seconds(html):
    start = time.process_time()
    html_text.blocks(html)
    assert time.process_time() - start < 5
