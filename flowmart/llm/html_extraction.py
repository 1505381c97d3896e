"""Main text of web pages: a linear-chain CRF over the leaf blocks of the DOM.

A page is parsed leniently into leaf blocks: runs of text between borders of block-level
elements. Each block has features from its ancestors (tags, words of class, id and role) and
from its text (length, share of links, punctuation, place). A two-state chain, trained on
labelled pages, is decoded by Viterbi; blocks in the content state are the main text.

The labelled pages are made by ``labelled_pages``: ``TRAINING_PAGES`` pages (the bound of the
training sample) of invented words in varied layouts whose parts are known by construction.
Training takes about two seconds on the driver; the model is a few hundred numbers.

Extraction is one narrow pass, page by page. Edge cases: null and empty html give an
empty text; unclosed or stray tags, missing ends and plain text are parsed as far as they go;
scripts, styles, templates, comments and hidden elements are never text; repeated rows
give equal rows; extra columns are ignored.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import escape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from flowmart.llm.common import arrow_rows, table
from flowmart.llm.crf import ChainCRF, train

TRAINING_PAGES = 400

BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary "
    "table tbody td textarea tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED_TAGS = frozenset("script style template".split())
#: A start of the first closes an open element of the second kind (searched up to a border).
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BORDERS = frozenset("ul ol dl table select menu body".split())
#: Containers that set a block apart from the text around it.
APART = frozenset(f"tag:{t}" for t in ("aside", "button", "footer", "form", "head", "header", "nav"))
#: What the search for an element to close can meet.
MARKS = BORDERS.union(*CLOSES.values())
LETTERS = re.compile(r"[a-z]+")


class Leaves(HTMLParser):
    """Collects leaf blocks: (text, characters inside links, ancestor features). Open elements are
    counted by name, so a page may nest as deep as it likes and no look-up walks the stack."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, list[str]]] = []
        self.open: Counter[str] = Counter()
        self.near: list[str] = []  # open elements of BLOCK_TAGS
        self.marks: list[str] = []  # and of MARKS
        self.above: Counter[str] = Counter()
        self.hidden = 0
        self.links = 0
        self.parts: list[str] = []
        self.linked = 0
        self.blocks: list[tuple[str, int, list[str]]] = []

    def _end_block(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append((text, self.linked, [*self.above, f"in:{self.near[-1] if self.near else '-'}"]))
        self.parts, self.linked = [], 0

    def _pop(self) -> None:
        tag, features = self.stack.pop()
        self.open[tag] -= 1
        if tag in BLOCK_TAGS:
            self.near.pop()
        if tag in MARKS:
            self.marks.pop()
        for f in features:
            self.above[f] -= 1
            if not self.above[f]:
                del self.above[f]
        self.hidden -= "hidden" in features
        self.links -= tag == "a"

    def _close(self, tag: str) -> None:
        while self.stack:
            last = self.stack[-1][0]
            self._pop()
            if last == tag:
                break

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br":
            self.parts.append(" ")
        if tag in BLOCK_TAGS:
            self._end_block()
            if self.open["p"] and tag not in ("html", "body"):
                self._close("p")
        if tag in CLOSES:
            for t in reversed(self.marks):
                if t in CLOSES[tag]:
                    self._close(t)
                    break
                if t in BORDERS:
                    break
        if tag in VOID_TAGS:
            return
        features = [f"tag:{tag}"] if tag in BLOCK_TAGS else []
        for name, value in attrs:
            value = (value or "").lower()
            if name in ("class", "id", "role"):
                features += {f"word:{w}" for w in LETTERS.findall(value)}
            elif name == "hidden" or (name == "style" and "display:none" in value.replace(" ", "")):
                features.append("hidden")
        if tag in DROPPED_TAGS:
            features.append("hidden")
        features = list(dict.fromkeys(features))
        self.stack.append((tag, features))
        self.open[tag] += 1
        if tag in BLOCK_TAGS:
            self.near.append(tag)
        if tag in MARKS:
            self.marks.append(tag)
        self.above.update(features)
        self.hidden += "hidden" in features
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS and tag not in BLOCK_TAGS and self.stack and self.stack[-1][0] == tag:
            self._pop()

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK_TAGS:
            self._end_block()
        if self.open[tag]:
            self._close(tag)

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.parts.append(data)
            if self.links:
                self.linked += len(data)


def leaf_blocks(html: str) -> list[tuple[str, int, list[str]]]:
    leaves = Leaves()
    leaves.feed(html)
    leaves.close()
    leaves._end_block()
    return leaves.blocks


def _band(x: float, cuts: tuple) -> int:
    return sum(x >= c for c in cuts)


def features(blocks: list[tuple[str, int, list[str]]]) -> list[list[str]]:
    out = []
    for i, (text, linked, above) in enumerate(blocks):
        words = text.count(" ") + 1
        inner = next((t for t in ("tag:article", "tag:main") if t in above), "outside")
        marked = any(f.startswith("word:") for f in above) or not APART.isdisjoint(above)
        out.append(
            [
                *above,
                f"{inner}:{'marked' if marked else 'plain'}",
                f"{inner}:{above[-1]}",
                f"words:{_band(words, (2, 4, 8, 16, 32, 64))}",
                f"links:{_band(linked / len(text), (0.01, 0.3, 0.7, 0.95))}",
                f"ends:{'.' if text[-1] in '.!?…。”\"' else 'other'}",
                f"commas:{min(text.count(','), 2)}",
                f"mark:{'c' if '©' in text[:40] else '|' if ' | ' in text else '-'}",
                f"place:{_band(i / len(blocks), (0.1, 0.3, 0.7, 0.9))}",
                "bias",
            ]
        )
    return out


# --- labelled pages ---------------------------------------------------------------------------


def labelled_pages(count: int, seed: int = 7) -> list[tuple[str, list[tuple[str, int]]]]:
    """(html, [(block text, 1 if main text)]) of invented pages."""
    rng = random.Random(seed)
    syllables = "an be cor da el fi gra ho in ju ka lo mer no ou pre qui ra sen ti ul ver wa xe yo za".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    words = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))

    def sentence(a: int = 1, b: int = 18) -> str:
        s = words(a, b)
        if rng.random() < 0.3:
            s = s.replace(" ", ", ", 1)
        return s.capitalize() + "."

    paragraph = lambda: " ".join(sentence() for _ in range(rng.choice((1, 1, 1, 2, 3, 5, 9))))
    pages = []
    for _ in range(count):
        out: list[str] = []
        gold: list[tuple[str, int]] = []

        def put(text: str, keep: int, tag: str = "p", attrs: str = "", link: bool = False, end: bool = True) -> None:
            gold.append((text, keep))
            inner = f'<a href="/{word()}">{escape(text)}</a>' if link else escape(text)
            out.append(f"<{tag}{attrs}>{inner}" + (f"</{tag}>" if end else ""))

        def box(tag: str, attrs: str, *fill) -> None:
            out.append(f"<{tag}{attrs}>")
            for f in fill:
                f()
            out.append(f"</{tag}>")

        def named(*names: str) -> str:
            style = rng.random()
            return "" if style < 0.15 else f' class="{rng.choice(names)}"' if style < 0.75 else f' id="{rng.choice(names)}"'

        def menu() -> None:
            items = lambda: [put(words(1, 3).capitalize() if rng.random() < 0.5 else word(), 0, "li", link=rng.random() < 0.95) for _ in range(rng.randint(2, 7))]
            inner = lambda: box("ul", "", items)
            box(*rng.choice((("nav", ""), ("nav", named("menu", "topnav")), ("div", f' class="{rng.choice(("menu", "nav", "navigation", "breadcrumb"))}"'))), inner)

        def site_header() -> None:
            box(*rng.choice((("header", ""), ("div", ' class="header"'), ("div", ' id="masthead"'))), lambda: put(words(1, 4), 0, rng.choice(("div", "span", "p", "h2"))), *([menu] if rng.random() < 0.4 else []))

        def ad() -> None:
            text = rng.choice((sentence(3, 12), paragraph(), words(2, 6)))
            kind = rng.choice(("ad", "ads", "advert", "ad-box", "sponsor", "sponsored", "promo", "banner", "advertisement"))
            if rng.random() < 0.6:
                put(text, 0, rng.choice(("div", "aside", "section")), f' class="{kind}"')
            else:
                box("div", f' class="{kind}"', lambda: put(text, 0, "p", link=rng.random() < 0.4))

        def notice() -> None:
            kind = rng.choice(("cookie", "cookie-notice", "consent", "notice", "alert", "gdpr", "popup", "subscribe", "paywall"))
            box(rng.choice(("div", "section", "aside")), f' {rng.choice(("class", "id"))}="{kind}"', lambda: put(sentence(5, 20), 0, rng.choice(("p", "div"))), lambda: put(words(1, 2), 0, "button"))

        def sidebar() -> None:
            fill = [lambda: put(words(1, 3), 0, rng.choice(("h3", "h4")))]
            fill += [rng.choice((lambda: put(words(2, 8), 0, "li", link=True), lambda: put(paragraph(), 0), lambda: put(sentence(), 0, "p", link=True))) for _ in range(rng.randint(1, 5))]
            box(*rng.choice((("aside", ""), ("aside", named("sidebar", "related")), ("div", f' class="{rng.choice(("sidebar", "related", "widget", "recommended"))}"'))), *fill)

        def form() -> None:
            box("form", named("search", "login", "newsletter"), lambda: put(words(1, 5), 0, rng.choice(("label", "p", "div"))), lambda: put(words(1, 2), 0, "button"))

        def comments() -> None:
            one = lambda: box("div", f' class="{rng.choice(("comment", "reply", "comment-body"))}"', lambda: put(words(1, 2), 0, rng.choice(("h4", "div", "p"))), lambda: put(paragraph(), 0))
            box(rng.choice(("section", "div")), f' {rng.choice(("class", "id"))}="{rng.choice(("comments", "comment-list", "discussion", "responses"))}"', lambda: put(words(1, 3), 0, "h3"), *[one] * rng.randint(1, 4))

        def footer() -> None:
            text = rng.choice((f"© {word()}.example.com · {sentence(3, 15)}", f"© {words(1, 4)}", sentence(2, 12)))
            box(*rng.choice((("footer", ""), ("footer", named("footer", "bottom")), ("div", ' class="footer"'))), lambda: put(text, 0, rng.choice(("p", "div", "span"))), *([menu] if rng.random() < 0.3 else []))

        def share() -> None:
            box("div", f' class="{rng.choice(("share", "social", "byline", "meta", "tags"))}"', lambda: put(words(1, 3), 0, rng.choice(("span", "a", "div"))))

        def article() -> None:
            inside = []
            for _ in range(rng.randint(1, 12)):
                roll = rng.random()
                if roll < 0.72:
                    inside.append(lambda: put(paragraph(), 1, "p", end=rng.random() < 0.8))
                elif roll < 0.77:
                    inside.append(lambda: put(words(1, 8).capitalize(), 1, rng.choice(("h2", "h3"))))
                elif roll < 0.81:
                    inside.append(lambda: box(rng.choice(("ul", "ol")), "", *[lambda: put(rng.choice((sentence(), words(1, 6))), 1, "li")] * rng.randint(1, 4)))
                elif roll < 0.84:
                    inside.append(lambda: put(paragraph(), 1, rng.choice(("blockquote", "pre"))))
                elif roll < 0.86:
                    inside.append(lambda: box("figure", "", lambda: put(sentence(), 1, "figcaption")))
                elif roll < 0.88:
                    inside.append(lambda: box("table", "", lambda: box("tr", "", *[lambda: put(words(1, 4), 1, "td")] * 3)))
                else:
                    inside.append(rng.choice((ad, ad, share, notice, sidebar, form)))
            title = lambda: put(words(1, 12).capitalize() + rng.choice(("", ".")), 1, rng.choice(("h1", "h1", "h2")))
            head = [] if rng.random() < 0.1 else [title]
            if head and rng.random() < 0.15:
                head = [lambda: box("header", "", title)]
            tail = [comments] if rng.random() < 0.2 else []
            kind = rng.random()
            if kind < 0.55:
                box("article", named("post", "story", "entry"), *head, *inside, *tail)
            elif kind < 0.8:
                box("main", named("content", "main"), *head, *inside, *tail)
            else:
                box("div", f' class="{rng.choice(("content", "article", "post", "entry-content", "story", "main", "article-body"))}"', *head, *inside, *tail)

        title = words(1, 10)
        gold.append((title, 0))
        out.append(f"<!DOCTYPE html><html><head><title>{title}</title><script>var x = 1;</script></head><body>")
        before = [f for f, p in ((site_header, 0.5), (menu, 0.7), (notice, 0.25), (ad, 0.5), (form, 0.15), (sidebar, 0.15)) if rng.random() < p]
        after = [f for f, p in ((share, 0.15), (comments, 0.3), (sidebar, 0.4), (ad, 0.3), (form, 0.25), (notice, 0.2), (footer, 0.85)) if rng.random() < p]
        for f in before:
            f()
        if rng.random() < 0.97:
            wrap = rng.random() < 0.25
            out.append("<main>" if wrap else "")
            article()
            out.append("</main>" if wrap else "")
        for f in after:
            f()
        if rng.random() < 0.9:
            out.append("</body></html>")
        pages.append(("".join(out), gold))
    return pages


@lru_cache(maxsize=1)
def trained_model(pages: int = TRAINING_PAGES) -> ChainCRF:
    examples = []
    for html, gold in labelled_pages(pages):
        blocks = leaf_blocks(html)
        if [b[0] for b in blocks] == [" ".join(t.split()) for t, _ in gold]:
            examples.append((features(blocks), [k for _, k in gold]))
    if len(examples) < 0.9 * pages:
        raise AssertionError("the parser and the labelled pages disagree on blocks")
    return train(examples)


def main_text(model: ChainCRF, html: str | None) -> str:
    blocks = leaf_blocks(html or "")
    return "\n".join(b[0] for b, keep in zip(blocks, model.decode(features(blocks))) if keep)


PAGE = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    model = pages.sparkSession.sparkContext.broadcast(trained_model())  # some hundred features: fixed size

    def rows(batches: Iterator[dict]) -> Iterator[tuple]:
        for b in batches:
            for page_id, url, html in zip(b["page_id"].to_pylist(), b["url"].to_pylist(), b["html"]):
                text = main_text(model.value, html.as_py())
                yield page_id, url, text, len(text)

    return pages.select("page_id", "url", "html").mapInArrow(arrow_rows(rows, PAGE, 500), "page_id long, url string, text string, n_chars long")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
