"""What attributes declare, and what only looks like it."""

import pytest

from cadastra.llm import html

KEPT = [
    '<p title="the hidden gem">T</p>',
    '<p data-hidden="false">T</p>',
    '<p data-state="hidden">T</p>',
    '<div data-role="banner">T</div>',
    '<div data-class="ad">T</div>',
    '<p><a href="/p?a=1&id=ad">T</a></p>',
    "<p><a href=/p?a=1&id=ad>T</a></p>",
    '<p><a title="hidden">T</a></p>',
    "<p title='class=\"ad\"'>T</p>",
    '<div class="a" class="ad">T</div>',
    "<div id=x class=has-sidebar>T</div>",
    '<div class="post-17 post">T</div>',
]
LEFT_OUT = [
    '<p alt="x" hidden>N</p>',
    "<div class=ad id=x>N</div>",
    '<div CLASS="Ad">N</div>',
    '<div class="user-comment">N</div>',
    '<div class="reader-comments">N</div>',
    '<div class="ad-300x250">N</div>',
    '<div class="google-ad">N</div>',
    '<div class="cookie-law-info-bar">N</div>',
    '<div class="related-posts">N</div>',
    '<div class="newsletter-cta">N</div>',
    '<p style="color: red; display: none">N</p>',
    '<p><span aria-hidden="TRUE">N</span></p>',
]


@pytest.mark.parametrize("part", KEPT)
def test_text_stays(part):
    assert html.extract(f"<body><article><p>x</p>{part}<p>y</p></article></body>") == "x\n\nT\n\ny"


@pytest.mark.parametrize("part", LEFT_OUT)
def test_text_goes(part):
    assert html.extract(f"<body><article><p>x</p>{part}<p>y</p></article></body>") == "x\n\ny"


def test_numbers_in_classes_do_not_part_a_layout():
    pages = [f'<article class="post post-{k}"><p>own text {k}</p><p>Share this story now</p></article>' for k in range(6)]
    template = frozenset(html.induce(pages))
    assert len(template) == 1
    assert [html.extract(p, template) for p in pages] == [f"own text {k}" for k in range(6)]
