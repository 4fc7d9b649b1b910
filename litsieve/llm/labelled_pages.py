"""Labelled pages that the page model is trained on, put together by rule.

Each page combines a container, a set of page parts and a run of article parts; a part is
labelled by the attribute ``data-label``, which the model does not see. Texts are filler of
drawn length, so that the model learns from structure, names and lengths, not from words.

A share of the pages is loose: the article lies in the body itself or in an element whose tag
and names say nothing or something foreign, as bare lines, in a cell of a layout table beside
the menu's, or is the whole page.
"""

from __future__ import annotations

import random

_FILLER = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor magna aliqua".split()

_CONTAINERS = (
    "<article{}>", "<main{}>", '<div class="post-content"{}>', '<div id="content"{}>', '<div class="entry"{}>',
    '<section class="story"{}>', '<div class="article-body"{}>', "<div{}>", '<div role="main"{}>',
    '<article class="post"{}>', "<section{}>",
)

# names that tell nothing about what an element holds
_FOREIGN = (
    'class="prose"', 'id="right"', 'id="left"', 'class="col-8"', 'class="inner"', 'class="c-1x"', 'class="comment-guide"',
    'id="wrap"', 'class="blk"', 'class="header-free text"', 'style="width:60%"', "",
)

# page parts that are no content: opening, inner element, closing, least and most words
_PARTS = (
    ("<nav>", "links", "</nav>"), ('<div class="menu">', "links", "</div>"), ('<ul class="breadcrumb">', "items", "</ul>"),
    ("<header>", "head", "</header>"), ('<div id="masthead">', "head", "</div>"), ('<div class="header">', "head", "</div>"),
    ("<footer>", "foot", "</footer>"), ('<div id="footer">', "foot", "</div>"), ('<div class="footer">', "text", "</div>"),
    ("<aside>", "text", "</aside>"), ('<div class="sidebar">', "links", "</div>"), ('<div class="sidebar">', "text", "</div>"),
    ('<div class="related">', "links", "</div>"), ('<div class="widget">', "text", "</div>"),
    ('<div class="ad">', "bare", "</div>"), ('<div class="advert">', "text", "</div>"),
    ('<div id="banner">', "bare", "</div>"), ('<p class="sponsored">', "bare", "</p>"), ('<div class="promo">', "text", "</div>"),
    ('<div class="cookie-notice">', "text", "</div>"), ('<div class="notice">', "bare", "</div>"),
    ('<div id="consent">', "text", "</div>"), ('<div class="newsletter">', "form", "</div>"), ('<div class="popup">', "text", "</div>"),
    ("<form>", "form", "</form>"), ('<form class="search">', "form", "</form>"), ('<div class="login">', "form", "</div>"),
    ('<div id="comments">', "talk", "</div>"), ('<section class="comments">', "talk", "</section>"),
    ('<ol class="commentlist">', "talk", "</ol>"), ('<div class="comment">', "text", "</div>"),
    ('<div class="reader-comments">', "talk", "</div>"), ('<div class="share">', "links", "</div>"),
    ('<div class="social">', "items", "</div>"), ('<div class="pagination">', "links", "</div>"),
)


class _Writer:
    def __init__(self, seed: int):
        self.draw = random.Random(seed)

    def text(self, least: int, most: int) -> str:
        words = [self.draw.choice(_FILLER) for _ in range(self.draw.randint(least, most))]
        return " ".join(words).capitalize() + self.draw.choice([".", ".", ".", ""])

    def link(self) -> str:
        return f'<a href="/x">{self.text(1, 4)}</a>'

    def inner(self, kind: str) -> str:
        if kind == "links":
            return "<ul>" + "".join(f"<li>{self.link()}</li>" for _ in range(self.draw.randint(2, 7))) + "</ul>"
        if kind == "items":
            return "".join(f"<li>{self.link()}</li>" for _ in range(self.draw.randint(2, 5)))
        if kind == "head":
            return f"<h1>{self.link()}</h1><p>{self.text(2, 9)}</p>"
        if kind == "foot":
            return f"<p>{self.text(3, 25)}</p>{self.link()}"
        if kind == "bare":
            return self.text(3, 30)
        if kind == "form":
            return f"<label>{self.text(1, 5)}</label><input><button>{self.text(1, 2)}</button><p>{self.text(3, 15)}</p>"
        if kind == "talk":
            one = lambda: f"<div><b>{self.text(1, 2)}</b><p>{self.text(4, 50)}</p></div>"
            return f"<h3>{self.text(1, 3)}</h3>" + "".join(one() for _ in range(self.draw.randint(1, 12)))
        return f"<h3>{self.text(1, 4)}</h3><p>{self.text(4, 40)}</p>"

    def part(self) -> str:
        start, kind, end = self.draw.choice(_PARTS)
        return start[:-1] + ' data-label="drop">' + self.inner(kind) + end

    def passage(self) -> str:
        return self.draw.choice(
            [
                lambda: f"<p>{self.text(10, 120)}</p>",
                lambda: f"<p>{self.text(10, 120)}</p>",
                lambda: f"<p>{self.text(1, 8)}</p>",
                lambda: "".join(f"<p>{self.text(1, 3)}</p>" for _ in range(self.draw.randint(2, 40))),
                lambda: "".join(f"<p><b>{self.text(1, 4)}</b><br>" for _ in range(self.draw.randint(1, 12))),
                lambda: "".join(f"<p>{self.link()}</p>" for _ in range(self.draw.randint(1, 3))),
                lambda: f"<p>{self.text(5, 40)} {self.link()} {self.text(5, 40)}</p>",
                lambda: f"<p><b>{self.text(2, 10)}</b> {self.text(5, 30)}<br><em>{self.text(2, 9)}</em>",
                lambda: f"<h2>{self.text(2, 8)}</h2>",
                lambda: f"<ul><li>{self.text(2, 15)}</li><li>{self.text(2, 15)}</li></ul>",
                lambda: f"<blockquote><p>{self.text(8, 40)}</p></blockquote>",
                lambda: f"<pre><code>{self.text(4, 20)}</code></pre>",
                lambda: f"<table><tr><td>{self.text(1, 5)}</td><td>{self.text(1, 5)}</td></tr></table>",
                lambda: f"<figure><img src=x><figcaption>{self.text(3, 12)}</figcaption></figure>",
                lambda: f"<div>{self.text(15, 80)}</div>",
                lambda: f"<section><h3>{self.text(2, 6)}</h3><p>{self.text(10, 70)}</p></section>",
            ]
        )()

    def article(self) -> str:
        title = f"<h1>{self.text(3, 12)}</h1>"
        if self.draw.random() < 0.2:
            title = f"<header>{title}</header>"
        rows = [title] if self.draw.random() < 0.85 else []
        for _ in range(self.draw.randint(1, 9)):
            rows.append(self.passage())
            if self.draw.random() < 0.12:
                rows.append(self.part())
        return "".join(rows)

    def page(self) -> str:
        container = self.draw.choice(_CONTAINERS)
        close = "</" + container[1:].split("{")[0].split()[0] + ">"
        main = container.format(' data-label="keep"') + self.article() + close
        if self.draw.random() < 0.3:
            main = f'<div class="{self.draw.choice(["wrapper", "container", "page", "row"])}">{main}</div>'
        before = "".join(self.part() for _ in range(self.draw.randint(0, 3)))
        after = "".join(self.part() for _ in range(self.draw.randint(0, 3)))
        return f"<html><head><title>t</title></head><body>{before}{main}{after}</body></html>"


    def lines(self) -> str:
        """Bare text with line breaks."""
        return "".join(f"{self.text(8, 60)}<br>" * self.draw.randint(1, 2) for _ in range(self.draw.randint(1, 8)))

    def loose_page(self) -> str:
        draw = self.draw
        body = "".join(f"<p>{self.text(10, 60)}</p>" for _ in range(draw.randint(1, 8)))
        body = draw.choice([body, body, self.lines(), self.article(), self.text(15, 200)])
        kind = draw.randrange(6)
        if kind == 0:
            main = body
        elif kind == 1:
            main = f"<center><font>{body}</font></center>"
        elif kind == 2:
            menu = "".join(f"{self.link()}<br>" for _ in range(draw.randint(2, 8)))
            cells = [f'<td data-label="drop">{menu}</td>', f"<td>{body}</td>"]
            main = f"<table><tr>{''.join(cells if draw.random() < 0.7 else cells[::-1])}</tr></table>"
        elif kind == 3:
            main = f"<div><div {draw.choice(_FOREIGN)}>{body}</div></div>"
        else:
            main = f"<div {draw.choice(_FOREIGN)}>{body}</div>"
        before = "".join(self.part() for _ in range(draw.choice([0, 0, 1, 2])))
        after = "".join(self.part() for _ in range(draw.choice([0, 0, 1, 2])))
        return f'<html><body data-label="keep">{before}{main}{after}</body></html>'


def pages(count: int = 400, loose: int = 320, seed: int = 11) -> list[str]:
    """``count`` labelled pages and ``loose`` loose ones, the same for the same seed."""
    plain = [_Writer(seed * 100_003 + i).page() for i in range(count)]
    return plain + [_Writer(seed * 300_007 + i).loose_page() for i in range(loose)]
