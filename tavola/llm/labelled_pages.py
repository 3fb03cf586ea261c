"""Labelled pages to train the extractor on: made layouts whose parts are known.

A page puts an article among menus, headers, footers, sidebars, notices, adverts, forms and
reader comments, in semantic elements or in plain ones that only their class names tell apart.
Elements of the article carry ``data-main``; the words are made up, so that a model can learn
structure alone. ``PAGES`` layouts are drawn with a fixed seed.
"""

from __future__ import annotations

import random

PAGES = 400

#: How each part may be marked up (fixed values): opening tags.
ARTICLE = (
    "<article>", "<main>", "<article class='post'>", "<div class='post-content'>", "<div id='content'>",
    "<section class='entry'>", "<div class='article-body'>", "<div class='story text'>", "<div class='main'>",
    "<div role='main'>", "<section class='article'>", "<div class='entry-content'>", "<div>",
)
MENU = ("<nav>", "<div class='nav'>", "<div id='menu'>", "<ul class='menu'>", "<div class='breadcrumb'>", "<div role='navigation'>", "<div class='navbar'>", "<div class='pagination'>")
HEADER = ("<header>", "<div class='header'>", "<div id='top-banner'>", "<div id='masthead'>", "<div class='site-header'>")
FOOTER = ("<footer>", "<div class='footer'>", "<div id='footer'>", "<div class='copyright'>", "<div class='site-footer'>")
SIDE = ("<aside>", "<div class='sidebar'>", "<div id='side'>", "<div class='related'>", "<div class='widget'>", "<div class='share social'>")
NOTICE = ("<div class='cookie-notice'>", "<div class='notice'>", "<div id='consent'>", "<div class='popup newsletter'>", "<div class='banner cookie'>", "<div class='alert'>", "<div role='alert'>")
ADVERT = ("<div class='ad'>", "<div class='ads'>", "<div class='advert'>", "<div class='sponsored'>", "<div class='promo'>", "<aside class='ad'>", "<div class='advertisement'>")
COMMENTS = ("<section class='comments'>", "<div id='comments'>", "<div class='comment-list'>", "<div class='discussion'>", "<div class='replies'>")


def _close(opening: str) -> str:
    return f"</{opening[1:].split(' ')[0].rstrip('>')}>"


def _words(rng: random.Random, low: int, high: int) -> str:
    made = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(low, high))]
    return " ".join(made).capitalize() + rng.choice((".", ".", "!", ""))


def _links(rng: random.Random) -> str:
    one = [f"<li><a href='/x'>{_words(rng, 1, 3)}</a></li>" for _ in range(rng.randint(2, 8))]
    return f"<ul>{''.join(one)}</ul>"


def _boxed(rng: random.Random, openings: tuple[str, ...], inner: str) -> str:
    opening = rng.choice(openings)
    return opening + inner + _close(opening)


def _article(rng: random.Random) -> str:
    def main(tag: str, text: str) -> str:
        return f"<{tag} data-main>{text}</{tag}>"

    parts = [main("h1", _words(rng, 2, 12))] if rng.random() < 0.9 else []
    many = rng.random() < 0.1
    longest = rng.choice((3, 20, 90, 90))
    for _ in range(rng.randint(20, 60) if many else rng.randint(1, 9)):
        kind = rng.random()
        if kind < 0.7:
            text = _words(rng, 1, longest)
            parts.append(main("p", text if rng.random() < 0.7 else f"<b>{text}</b> <a href='/y'>{_words(rng, 1, 4)}</a>"))
        elif kind < 0.78:
            parts.append(main(rng.choice(("h2", "h3")), _words(rng, 1, 8)))
        elif kind < 0.84:
            items = "".join(main("li", _words(rng, 2, 20)) for _ in range(rng.randint(2, 6)))
            parts.append(main(rng.choice(("ul", "ol")), items))
        elif kind < 0.88:
            parts.append(main("blockquote", main("p", _words(rng, 5, 40))))
        elif kind < 0.91:
            cells = "".join(main("tr", main("td", _words(rng, 1, 5)) * 3) for _ in range(3))
            parts.append(main("table", cells))
        elif kind < 0.95:
            parts.append(main("div", _words(rng, 10, 60)))
        elif kind < 0.98:
            parts.append(_boxed(rng, ADVERT, _words(rng, 2, 25)))
        else:
            parts.append(_boxed(rng, SIDE, _links(rng)))
    opening = rng.choice(ARTICLE)
    return opening[:-1] + " data-main>" + "".join(parts) + _close(opening)


def _form(rng: random.Random) -> str:
    return f"<form><p>{_words(rng, 2, 8)}</p><label>{_words(rng, 1, 2)}</label><input name='q'></form>"


def _comments(rng: random.Random) -> str:
    one = [
        rng.choice(("<div class='comment'>", "<div class='reply'>")) + f"<p>{_words(rng, 3, 60)}</p></div>"
        for _ in range(rng.randint(1, 5))
    ]
    return _boxed(rng, COMMENTS, f"<h3>{_words(rng, 1, 2)}</h3>" + "".join(one) + (_form(rng) if rng.random() < 0.5 else ""))


def labelled_page(rng: random.Random) -> str:
    before = [
        _boxed(rng, HEADER, rng.choice((_links(rng), f"<p>{_words(rng, 2, 12)}</p>", f"<h2>{_words(rng, 1, 4)}</h2>"))),
        _boxed(rng, MENU, _links(rng)),
        _boxed(rng, NOTICE, rng.choice((_words(rng, 4, 30), f"<p>{_words(rng, 4, 30)}</p>"))),
        _boxed(rng, ADVERT, rng.choice((_words(rng, 2, 30), f"<p>{_words(rng, 2, 30)}</p>"))),
        _form(rng),
    ]
    after = [
        _boxed(rng, SIDE, rng.choice((_links(rng), f"<h3>{_words(rng, 1, 3)}</h3><p>{_words(rng, 4, 40)}</p>"))),
        _comments(rng),
        _boxed(rng, ADVERT, _words(rng, 2, 30)),
        _boxed(rng, FOOTER, rng.choice((_words(rng, 3, 25), f"<p>{_words(rng, 3, 25)}</p>{_links(rng)}"))),
    ]
    body = "".join(x for x in before if rng.random() < 0.6) + _article(rng) + "".join(x for x in after if rng.random() < 0.6)
    if rng.random() < 0.3:
        body = f"<div class='{rng.choice(('page', 'wrapper', 'container'))}'>{body}</div>"
    return f"<!DOCTYPE html><html><head><title>{_words(rng, 2, 6)}</title></head><body>{body}</body></html>"


def labelled_pages(count: int = PAGES, seed: int = 17) -> list[str]:
    rng = random.Random(seed)
    return [labelled_page(rng) for _ in range(count)]
