"""The small labelled table for main-text extraction: ``PAGES`` pages in eight
hand-made layouts, filled with paragraphs of many lengths. A block whose text
starts with "+" belongs to the article; the sign is only the label. What the
words say is never a feature, so they are all alike.

Three layouts use sectioning elements, two whole names of parts, and three
neither, so that a tree has to tell article and rest by lengths and links.
"""

from __future__ import annotations

import random

PAGES = 320
SEED = 17
# paragraphs from one word to a few hundred, short ones as common as long ones
LENGTHS = (1, 2, 3, 5, 8, 12, 20, 30, 45, 60, 90, 150, 300)


class Writer:
    """Parts of pages; ``self.of(...)`` draws one of its arguments."""

    def __init__(self, seed: int):
        self.random = random.Random(seed)

    def of(self, *choices):
        return self.random.choice(choices)

    def words(self, least: int, most: int) -> str:
        return " ".join(["word"] * self.random.randint(least, most))

    def link(self, least: int = 1, most: int = 3) -> str:
        return f'<a href="/x">{self.words(least, most)}</a>'

    def menu(self) -> str:
        n = self.random.randint(3, 9)
        return self.of(
            "<ul>" + "".join(f"<li>{self.link()}</li>" for _ in range(n)) + "</ul>",
            "<p>" + " ".join(self.link() for _ in range(n)) + "</p>",
            "".join(f"<div>{self.link(1, 4)}</div>" for _ in range(n)))

    def paragraph(self, linked: bool = False) -> str:
        n = self.of(*LENGTHS)
        text = "+" + self.words(n, n + n // 3)
        if linked:
            return f'<p><a href="/x">{text}</a></p>'
        if n > 8 and self.of(True, False, False):
            text += f" {self.link()} {self.words(1, 4)}"
        return self.of(f"<p>{text}</p>", f"<p>{text}", f"<p>{text}</p>", f"<blockquote><p>{text}</p></blockquote>")

    def article(self, least: int = 1, long: bool = False, links: bool = True) -> str:
        """Heading, paragraphs, now and then a list or a subheading; with
        ``long`` at least every third paragraph has some length."""
        out = [f"<h1>+{self.words(1, 14)}</h1>"] if long or self.of(True, True, False) else []
        for i in range(self.random.randint(least, 9)):
            if long and i % 3 == 0:
                out.append(f"<p>+{self.words(30, 160)}</p>")
            elif self.random.random() < 0.12:
                out.append(f"<h2>+{self.words(1, 5)}</h2>")
            elif self.random.random() < 0.1:
                out.append("<ul>" + "".join(f"<li>+{self.words(1, 9)}</li>" for _ in range(3)) + "</ul>")
            else:
                out.append(self.paragraph(linked=links and self.random.random() < 0.1))
        if long:
            out.append(f"<p>+{self.words(25, 120)}</p>")
        return "".join(out) or f"<p>+{self.words(1, 30)}</p>"

    def notice(self) -> str:
        """An advert, notice or imprint: some words, few links."""
        return self.words(1, 14) + self.of("", f" {self.link()}")

    def prose(self) -> str:
        """Text of a sidebar, comment or long footer: reads like a paragraph."""
        return "".join(f"<p>{self.words(n, n + 9)}</p>" for n in (self.of(2, 8, 25, 60), self.of(3, 14, 40)))


def sections(w: Writer) -> str:
    top = w.of("", f"<header><p>{w.notice()}</p></header>") + f"<nav>{w.menu()}</nav>" + w.of("", f"<div>{w.notice()}</div>")
    end = w.of("", f"<aside>{w.prose()}</aside>", f"<div>{w.prose()}</div>") + f"<footer>{w.of(w.notice(), w.prose())}</footer>"
    tag = w.of("article", "main")
    return f"{top}<{tag}>{w.article()}</{tag}>{end}"


def sections_with_insets(w: Writer) -> str:
    inset = w.of(f"<aside>{w.prose()}</aside>", f"<form><p>{w.notice()}</p><button>{w.words(1, 2)}</button></form>",
                 f'<div class="{w.of("ad", "promo")}">{w.notice()}</div>')
    after = w.of("", f'<section id="comments">{w.prose()}</section>')
    return (f'<div class="notice"><p>{w.notice()}</p></div><nav>{w.menu()}</nav><main>{w.article()}{inset}'
            f"{w.article()}{after}</main>{w.of('', f'<div>{w.prose()}</div>')}<footer>{w.notice()}</footer>")


def named(w: Writer) -> str:
    return (f'<div id="menu">{w.menu()}</div><div>{w.article(2, long=True, links=False)}</div><div class="sidebar">{w.prose()}</div>'
            f'<div id="footer">{w.of(w.notice(), w.prose())}</div>')


def named_comments(w: Writer) -> str:
    return (f'<div class="nav">{w.menu()}</div><div>{w.article(2, long=True, links=False)}</div><div class="comments">{w.prose()}{w.prose()}</div>'
            f"<div>{w.menu()}</div>")


def plain(w: Writer) -> str:
    end = w.of(f"<div>{w.notice()}</div>", f"<div>{w.menu()}</div>", f"<div>{w.menu()}</div><div>{w.notice()}</div>", "")
    return f"<div>{w.menu()}</div>{w.of('', f'<div>{w.notice()}</div>')}<div>{w.article(2, long=True, links=False)}</div>{end}"


def table_layout(w: Writer) -> str:
    return (f"<table><tr><td>{w.menu()}</td></tr><tr><td>{w.article(2, long=True, links=False)}</td></tr>"
            f"<tr><td>{w.menu()}{w.of('', w.notice())}</td></tr></table>")


def teasers(w: Writer) -> str:
    """Lists of linked teasers around an article; their lines are longer than those of a menu."""
    lines = "".join(f"<p>{w.link(4, 16)}{w.of('', ' ' + w.words(1, 3))}</p>" for _ in range(4))
    alone = f"<p>{w.link(3, 12)}</p>"  # a link with nothing else, between paragraphs
    return f"{lines}{w.article(2, long=True, links=False)}{w.of('', alone)}{w.article(2, long=True, links=False)}{lines}"


def cut_off(w: Writer) -> str:
    """The page ends within its article, or has nothing else."""
    few = f"<p>+{w.words(1, 12)}" * w.of(1, 1, 2, 4)
    return w.of("", f"<nav>{w.menu()}</nav><div>{w.notice()}</div>") + f"<{w.of('article', 'main')}>{w.of(few, w.article())}"


LAYOUTS = (sections, sections_with_insets, cut_off, named, named_comments, plain, table_layout, teasers)


def pages() -> list[str]:
    """The labelled pages, the layouts in turn."""
    w = Writer(SEED)
    return [LAYOUTS[i % len(LAYOUTS)](w) for i in range(PAGES)]
