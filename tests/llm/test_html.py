"""HTML extraction beside a second implementation on html.parser, on held-out labelled pages, and on odd pages."""

import random
from html.parser import HTMLParser

import pytest

from lexweave.llm import htmltext
from lexweave.llm.htmlpages import labelled_pages


def text_of(page):
    return htmltext.main_text(page, htmltext.default_tree())


class Second(HTMLParser):
    """Flat blocks of well-formed pages, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks, self.open, self.words, self.linked = [], [("", False, 0, "")], "", ""
        self.silent = self.links = 0

    def cut(self):
        text = " ".join(self.words.split())
        if text:
            n = max(htmltext.count_words(text), 1)
            self.blocks.append((text, n, min(1.0, htmltext.count_words(self.linked) / n), *self.open[-1][1:3]))
        self.words = self.linked = ""

    def handle_starttag(self, tag, attrs):
        if tag in htmltext.SILENT | htmltext.RAW | {"head", "title"}:
            self.silent += 1
            return
        if tag in htmltext.BLOCKS:
            self.cut()
        if tag == "br":
            self.words += " "
        elif tag == "a":
            self.links += 1
        elif tag not in htmltext.VOID:
            _, article, container, cause = self.open[-1]
            if tag in ("article", "main") and cause in ("nav", "header", "form"):
                container, cause = 0, ""
            mark = htmltext.boilerplate_mark(tag, " ".join(f'{k}="{v}"' for k, v in attrs), article)
            self.open.append((tag, article or tag in ("article", "main"), max(container, mark), tag if mark > container else cause))

    def handle_endtag(self, tag):
        if tag in htmltext.SILENT | htmltext.RAW | {"head", "title"}:
            self.silent -= 1
            return
        if tag in htmltext.BLOCKS:
            self.cut()
        if tag == "a":
            self.links -= 1
        elif tag not in htmltext.VOID:
            assert self.open.pop()[0] == tag

    def handle_data(self, data):
        if not self.silent:
            self.words += data
            if self.links:
                self.linked += data + " "


def second_text(page, tree):
    p = Second()
    p.feed(page)
    p.close()
    p.cut()
    b, out, has = p.blocks, [], int(any(x[3] for x in p.blocks))
    for i, (text, words, density, article, container) in enumerate(b):
        prev, nxt = (b[i - 1][1:3] if i else (0, 0.0)), (b[i + 1][1:3] if i + 1 < len(b) else (0, 0.0))
        near = (0, 0.0)
        for j in range(max(i - htmltext.NEAR, 0), min(i + htmltext.NEAR + 1, len(b))):
            if j != i and b[j][1] > near[0]:
                near = b[j][1:3]
        if tree.decide((words, density, *prev, *nxt, *near, max(prev[1], nxt[1]), int(article), container, has)):
            out.append(text)
    return "\n\n".join(out)


def random_page(r):
    word = lambda: r.choice(["alpha", "beta&amp;", "gamma", "&lt;x&gt;", "法律", "δ", "a&nbsp;b", "e&#233;"])
    words = lambda n: " ".join(word() for _ in range(r.randint(1, n)))
    names = ["ad", "share-price", "post", "comments", "siteNav", "story", "related-work", "cookie-notice"]

    def inner(depth):
        kind = r.randrange(9)
        if kind < 4 or depth == 0:
            return f"<p>{words(30)}{r.choice(['', f' <a href=x>{words(4)}</a>', '<br>', ' <b>', ' <em>'])}" + "</p>"
        if kind == 4:
            return f"<ul>{''.join(f'<li><a href=y>{words(3)}</a></li>' for _ in range(r.randint(1, 5)))}</ul>"
        if kind == 5:
            return r.choice([f"<script>var x='<p>{words(3)}</p>'</script>", f"<style>{words(3)}</style>", f"<select><option>{words(2)}</option></select>", "<!-- <p>no</p> -->", f"<svg><text>{words(2)}</text></svg>", f"<button>{words(2)}</button>"])
        tag = r.choice(["div", "section", "aside", "nav", "header", "footer", "article", "blockquote", "main", "figure"])
        return f'<{tag} class="{r.choice(names)}">{"".join(inner(depth - 1) for _ in range(r.randint(1, 4)))}</{tag}>'

    return f"<!DOCTYPE html><html><head><title>{words(4)}</title></head><body>{''.join(inner(3) for _ in range(6))}</body></html>".replace(" <b>", " <b>x</b>").replace(" <em>", " <em>y</em>")


def test_beside_second_implementation():
    tree, r = htmltext.default_tree(), random.Random(3)
    pages = [random_page(r) for _ in range(400)] + labelled_pages(5, 4)
    assert [htmltext.main_text(p, tree) for p in pages] == [second_text(p, tree) for p in pages]
    assert sum(bool(second_text(p, tree)) for p in pages) > 200


@pytest.mark.parametrize("seed", [1, 2, 77])
def test_held_out_pages(seed):
    tree, rows = htmltext.default_tree(), htmltext.labelled_table(labelled_pages(seed, 10))
    wrong = sum(tree.decide(x) != x[-1] for x in rows)
    assert wrong <= 0.005 * len(rows), (wrong, len(rows))


def test_words_and_links_decide():
    used, todo = set(), [htmltext.default_tree()]
    while todo:
        node = todo.pop()
        if node.feature >= 0:
            used.add(htmltext.FEATURES[node.feature])
            todo += [node.low, node.high]
    assert {"words", "link_density", "beside_density"} <= used
    long, short = "word " * 60, "w w"
    assert text_of(f'<div class="search-results">{long}</div>') == long.strip()
    inside = "".join(f'<div class="{c}"><p>{long}</p></div>' for c in ("share-price", "alert-level-history")) + f'<div id="related-work"><p>{long}</p></div>'
    assert text_of(f"<article><p>{short}</p>{inside}<p>{long}</p></article>").count("word") == 240
    assert text_of(f'<article><p>{long}</p><div class="share-now"><p>{short}</p></div><p>{long}</p></article>').count("w w") == 0
    menu = "".join(f"<li><a href=/{k}>item</a></li>" for k in range(6))
    assert "item" not in text_of(f"<article><p>{long}</p><ul>{menu}</ul><p>{long}</p></article>")
    rich = "".join("<p>" + " ".join(f"{'plain ' * 4}<a href=/>link</a>" for _ in range(12)) + "</p>" for _ in range(3))
    assert text_of(f"<article>{rich}</article>").count("link") == 36
    assert text_of(f"<article><h2><a href=/t>Linked title</a></h2><p>{long}</p></article>").startswith("Linked title")


def test_unclosed_elements():
    body = "<article><p>One two three four five.</p><p>Six seven eight nine ten.</p></article>"
    want = "One two three four five.\n\nSix seven eight nine ten."
    assert text_of(f"<html><head><meta charset=utf-8><title>T</title>{body}") == want
    for tag in ("select", "button", "svg", "canvas", "textarea", "iframe", "template", "video"):
        assert text_of(body.replace("<p>Six", f"<{tag}>gone<p>Six")) == want, tag
        assert text_of(body.replace("<p>Six", f"<{tag}>gone<p>Six") + f"<{tag}>more</{tag}>") == want, tag
        assert text_of(body.replace("<p>Six", f"<{tag}>gone</{tag}<p>Six".replace("<p", "><p", 1))) == want, tag
    assert text_of(body.replace("<p>Six", "<script>if (a < b) <p>Six")) == "One two three four five."
    assert text_of(f"<nav><a href=/>Home</a><a href=/>About</a>{body}") == want
    assert text_of(f"<form action=/x><input>{body}</form>") == want
    assert text_of(body.replace("five.", "<math><mi>x</mi>=1</math> <object>fallback</object> <noscript>plain</noscript>")).split("\n")[0] == "One two three four x=1 fallback plain"
    assert text_of("") == "" and text_of("<") == "<" and text_of("just text without tags at all") == "just text without tags at all"


def test_scripts_without_spaces():
    lines = ["国家机关工作人员应当依照法律规定办理。" * 4, "第一条", "应当依照程序。", "办理事项规定如下。" * 6]
    page = "<html><body><div>" + "".join(f"<p><a href=/{k}>首页</a></p>" for k in range(5)) + "</div><div>" + "".join(f"<p>{x}</p>" for x in lines) + "</div></body></html>"
    assert text_of(page) == "\n\n".join(lines)
    assert htmltext.count_words("应当依照程序") == 3 and htmltext.count_words("สวัสดีครับ x") == 6 and htmltext.count_words("two words") == 2
