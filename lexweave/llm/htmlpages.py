"""Labelled pages for the HTML extraction: small made-up layouts whose main text carries the attribute data-main.

The layouts are written by hand after common kinds of pages; the lengths of their blocks are drawn from a seeded stream,
so one seed gives the pages the tree learns from and any other seed pages to test it on. The text is filler: extraction
looks at word counts, link density and containers, never at words.
"""

from __future__ import annotations

import random

ROUNDS, SEED = 24, 20240301
_LATIN = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor".split()
_HAN = "法律条文规定国家机关工作人员应当依照程序办理事项"


class _Filler:
    def __init__(self, rng: random.Random, han: bool):
        self.rng, self.han = rng, han

    def text(self, low: int, high: int) -> str:
        n = self.rng.randint(low, high)
        return "".join(self.rng.choices(_HAN, k=2 * n)) + "。" if self.han else " ".join(self.rng.choices(_LATIN, k=n))

    def link(self, low: int = 1, high: int = 3) -> str:
        return f'<a href="/{self.rng.randrange(99)}">{self.text(low, high)}</a>'

    def links(self, n: int, low: int = 1, high: int = 3, tag: str = "li") -> str:
        return "".join(f"<{tag}>{self.link(low, high)}</{tag}>" for _ in range(n))

    def main(self, low: int, high: int, tag: str = "p", extra: str = "") -> str:
        return f"<{tag} data-main>{self.text(low, high)}{extra}</{tag}>"

    def linked(self, low: int, high: int, share: float, tag: str = "p") -> str:
        """A paragraph of main text in which about `share` of the words are links."""
        n = self.rng.randint(low, high)
        at, out = 0, []
        while at < n:
            k = min(self.rng.randint(1, 4), n - at)
            out.append(self.link(k, k) if self.rng.random() < share else self.text(k, k))
            at += k
        return f"<{tag} data-main>{' '.join(out)}</{tag}>"

    def story(self) -> str:
        """Paragraphs of all lengths, a heading, a quote, a list, paragraphs and sources full of links."""
        parts = [self.main(25, 120), self.main(2, 8, "h2"), self.main(30, 90, extra=" " + self.link()), self.main(1, 3), self.main(1, 2), self.main(40, 200), self.main(8, 20, "blockquote"), self.main(3, 12, "li"),
                 self.main(2, 10, "li"), "".join(self.linked(15, 110, self.rng.uniform(0.15, 0.55)) for _ in range(4)),
                 "".join(self.linked(9, 25, self.rng.uniform(0.3, 0.6), "li") for _ in range(3)), f"<p data-main>{self.link(5, 12)}</p>{self.main(5, 40)}", f"<h3 data-main>{self.link(1, 4)}</h3>{self.main(2, 60)}", self.main(15, 60)]
        self.rng.shuffle(parts)
        return self.main(3, 10, "h1") + "".join(parts)


def _article(f: _Filler, r: random.Random) -> str:
    """An article element with the usual frame, and boilerplate inside it."""
    inside = [f'<div class="ad">{f.text(3, 25)}</div>', f'<div class="share-buttons"><ul>{f.links(4, 1, 1)}</ul></div>', f'<aside>{f.text(10, 60)}</aside>', f'<div class="related-posts"><h3>{f.text(1, 2)}</h3>{f.links(3, 4, 9)}</div>',
              f"<form>{f.text(2, 12)}</form>", f'<div class="newsletter-signup"><p>{f.text(8, 30)}</p></div>', f"<ul>{f.links(5, 1, 2)}</ul>"]
    outside = lambda: f"<div><p>{f.text(2, 90)}</p><p>{f.text(1, 40)}</p></div><div>{f.text(1, 12)}</div>"
    return (f"<nav><ul>{f.links(r.randint(3, 9))}</ul></nav>{outside()}<header>{f.text(1, 5)}</header><div class='ad banner'>{f.text(4, 30)}</div><article>{f.story()}{''.join(r.sample(inside, 4))}{f.story()}</article>"
            f'{outside()}<section id="comments">{"".join(f"<p>{f.text(2, 80)}</p>" for _ in range(4))}</section><aside class="sidebar"><p>{f.text(5, 90)}</p>{f.links(4, 2, 8)}</aside><footer><p>{f.text(4, 40)}</p>{f.links(3)}</footer>')


def _named_content(f: _Filler, r: random.Random) -> str:
    """Containers whose names only sound like boilerplate, around main text, in an article or not."""
    name = lambda: r.choice(["share-price", "related-work", "alert-level-history", "search-results", "header-image-story", "nav-theory", "comment-culture", "ad-law", "notice-of-motion", "signup-economy"])
    body = "".join(f'<div class="{name()}">{f.main(12, 120)}{f.main(20, 90)}{f.main(14, 60)}</div>' for _ in range(3))
    small = "".join(f'<div class="{r.choice(["share-now", "related-stuff", "ad-x", "nav-extra", "social-proof"])}">{f.links(3, 1, 2)}<p>{f.text(1, 4)}</p></div>' for _ in range(3))
    return f'<div class="top">{f.links(4)}</div>' + (f"<article>{f.story()}{body}{small}</article>" if r.random() < 0.5 else f"{f.main(3, 9, 'h1')}{body}{small}{f.main(30, 80)}") + f"<footer>{f.text(3, 20)}</footer>"


def _plain(f: _Filler, r: random.Random) -> str:
    """No article and hardly a name: divs and tables around long text."""
    return (f"<table><tr>{f.links(r.randint(4, 8), 1, 2, 'td')}</tr></table><div>{f.story()}{f.story()}</div><div>{f.links(r.randint(3, 6), 2, 6, 'p')}</div>"
            f"<div><p>{f.text(2, 7)} {f.link()} {f.link()}</p></div><div>{f.links(4, 1, 2, 'span')}</div>")


def _short_lines(f: _Filler, r: random.Random) -> str:
    """A poem or a dialogue, in an article or not: one-word lines beside one-word lines."""
    lines = "".join(f.main(1, 4) for _ in range(r.randint(8, 20)))
    if r.random() < 0.5:
        return f"<nav>{f.links(4)}</nav><article>{f.main(2, 6, 'h1')}{lines}{f.main(5, 12)}{lines}</article><footer>{f.text(2, 9)}</footer>"
    return f"<div>{f.links(r.randint(5, 8), 1, 2, 'p')}</div><div>{f.main(2, 6, 'h1')}{lines}{f.main(10, 30)}{lines[: len(lines) // 2].rsplit('<p', 1)[0]}</div><div>{f.links(4, 1, 3, 'p')}</div>"


def _main_only(f: _Filler, r: random.Random) -> str:
    """A main element in a framed page, with a notice and a pager."""
    return (f'<div id="cookie-notice"><p>{f.text(10, 45)}</p></div><ul class="menu">{f.links(6)}</ul><main>{f.story()}<ul class="pagination">{f.links(4, 1, 1)}</ul></main>'
            f'<div class="comments"><div class="comment"><p>{f.text(3, 60)}</p></div><div class="comment"><p>{f.text(3, 60)}</p></div></div><div class="copyright">{f.text(3, 12)}</div>')


LAYOUTS = (_article, _article, _named_content, _plain, _short_lines, _main_only)


def labelled_pages(seed: int = SEED, rounds: int = ROUNDS) -> list[str]:
    """`rounds` pages of every layout; every third one is written in a script without spaces."""
    rng = random.Random(seed)
    return [f"<html><head><title>x</title></head><body>{layout(_Filler(rng, k % 3 == 2), rng)}</body></html>" for k in range(rounds) for layout in LAYOUTS]
