"""Main text of web pages by a tree-structured graphical model.

The block elements of a page and the text runs between their borders form a tree. Each
node is content or not; unary potentials look at the tag, at words in class, id and role,
and at the text, pairwise potentials tie a node to its parent. Sum-product messages
up and down the tree give exact marginals, and the text runs that are content with
probability one half or more are the main text.

The potentials are trained by maximum likelihood on labelled pages: those below, and at
most ``SAMPLE`` pages of the table whose ``<article>`` or ``<main>`` tells their content.

Edge cases: null and empty pages, and pages without markup or content, give what text the
model keeps, an empty one at least; broken markup (unclosed tags, quotes, comments) is
read to the end of the page; formulas, preformatted text and fallback text are text like any
other; equal rows give equal results. Only the named columns are read.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 80
SEED_WEIGHT = 15  # the labelled pages below are few and short
SAMPLE_CHARS = 100_000  # longer pages are not trained on

# Elements of HTML by their role in parsing.
BLOCKS = frozenset(
    "html body div p ul ol li dl dt dd table caption thead tbody tfoot tr td th section article main aside header footer nav form "
    "fieldset figure figcaption blockquote pre h1 h2 h3 h4 h5 h6 hr address details summary dialog menu center search hgroup xmp".split()
)
RAW = frozenset("script style title textarea xmp".split())
FALLBACK = frozenset("noscript object canvas template select datalist iframe noembed noframes".split())  # parts of a paragraph, if it is open
SPACED = frozenset("br option optgroup text mtd".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "thead": {"thead", "tbody", "tfoot", "tr", "td", "th"}, "tbody": {"thead", "tbody", "tfoot", "tr", "td", "th"},
    "tfoot": {"thead", "tbody", "tfoot", "tr", "td", "th"},
}
BORDERS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}}

# Words in class, id and role by what they tell of an element.
HINTS = {
    "nav": "nav navigation navbar menu menubar breadcrumb breadcrumbs pagination pager toc tabs toolbar skip",
    "head": "header masthead topbar logo branding banner",
    "foot": "footer copyright legal colophon contentinfo bottom",
    "side": "sidebar aside related widget recommended recommendations complementary rail trending popular teaser tags share social",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion adsense dfp",
    "note": "cookie cookies consent notice alert popup modal overlay newsletter subscribe subscription gdpr paywall warning toast disclaimer",
    "talk": "comment comments discussion reply replies disqus respond thread",
    "form": "form search login signup register feedback contact",
    "main": "content article post entry main body story text page articlebody maincontent prose",
    "hidden": "hidden invisible offscreen",
}
HINT_OF = {w: k for k, words in HINTS.items() for w in words.split()}
OPEN_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|style|data-y)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?(?=[\s/>]|$)""", re.I)
TAG_REST = re.compile(r"""(?:[\s/]+|[^\s/>][^\s/>=]*+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*+))?+)*+>""")  # attributes up to the end of the tag
SPLIT = re.compile(r"[^a-z0-9]+")
SPACES = re.compile(r"\s+")


class Page:
    """Nodes of a page in document order: parent, features, label (given by ``data-y``) and, for text runs, the text."""

    def __init__(self, source: str):
        self.parent: list[int] = []
        self.features: list[tuple[str, ...]] = []
        self.text: list[str | None] = []
        self.given: list[int | None] = []
        self.tags: list[str] = []
        self.open: Counter[str] = Counter()  # open elements by name
        self._read(source)

    def _add(self, parent: int, features: tuple[str, ...], text: str | None, given: int | None, tag: str) -> int:
        self.parent.append(parent)
        self.features.append(features)
        self.text.append(text)
        self.given.append(given)
        self.tags.append(tag)
        return len(self.parent) - 1

    def _read(self, s: str) -> None:
        stack = [self._add(-1, ("root",), None, None, "#root")]
        pieces: list[str] = []
        linked = in_link = 0
        at, n = 0, len(s)
        quoted = True
        last_end: dict[str, int] = {}  # where the last end tag of an element stands

        def ended(name: str, at: int) -> bool:
            if name not in last_end:
                last_end[name] = max((m.start() for m in re.finditer(rf"</{name}(?=[\s/>])", s, re.I)), default=-1)
            return last_end[name] >= at

        def flush() -> None:
            nonlocal linked
            if pieces:
                text = SPACES.sub(" ", "".join(pieces)).strip()
                if text:
                    node = stack[-1]
                    self._add(node, run_features(text, linked, self.tags[node]), text, self.given[node], "#text")
                pieces.clear()
            linked = 0

        def say(raw: str) -> None:
            nonlocal linked
            if raw:
                text = entities.unescape(raw) if "&" in raw else raw
                pieces.append(text)
                if in_link:
                    linked += len(text.strip())

        while at < n:
            lt = s.find("<", at)
            if lt < 0:
                say(s[at:])
                break
            say(s[at:lt])
            if s.startswith("<!--", lt):
                end = s.find("-->", lt + 4)
                at = n if end < 0 else end + 3
                continue
            if s.startswith(("<!", "<?"), lt):
                end = s.find(">", lt)
                at = n if end < 0 else end + 1
                continue
            tag = OPEN_TAG.match(s, lt)
            if not tag:
                say("<")
                at = lt + 1
                continue
            rest = TAG_REST.match(s, tag.end()) if quoted else None
            if not rest:  # no > outside of quotes up to the end of the page: from here on the first > ends a tag
                quoted = False
            end = rest.end() - 1 if rest else s.find(">", tag.end())
            if end < 0:
                break
            name, closing, attributes = tag[1].lower(), s[lt + 1] == "/", s[tag.end() : end]
            at = end + 1
            if name in RAW and not closing:
                stop = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|$)", re.I).search(s, at) if ended(name, at) else None
                if stop and name == "xmp":
                    self._open(stack, name, attributes, flush)
                    pieces.append(s[at : stop.start()])
                    flush()
                    self._leave(stack)
                if stop:
                    at = stop.end()
                    continue
                if name in ("script", "style"):  # without an end tag they go on to the end of the page
                    at = n
                    continue
            if name in SPACED:
                pieces.append(" ")
                continue
            if name == "a":
                in_link = 0 if closing else 1
                continue
            if name not in BLOCKS and name not in FALLBACK:
                continue
            if name in FALLBACK and not closing:
                if not ended(name, at):
                    continue
                empty = re.compile(rf"(?:\s|<(?!/?{name}\b)[^<>]*>)*+</{name}(?=[\s/>])[^<>]*>", re.I).match(s, at)
                if empty:  # without text it does not part a text run
                    at = empty.end()
                    continue
            if closing:
                flush()
                if self.open[name]:  # else a stray end tag: no look through the open elements
                    while self._leave(stack) != name:
                        pass
                    in_link = in_link if name in FALLBACK else 0
                continue
            if name in VOID:
                flush()
                continue
            self._open(stack, name, attributes, flush)
        flush()

    def _open(self, stack: list[int], name: str, attributes: str, flush: Callable[[], None]) -> None:
        """A new node of an element, below those that it leaves open."""
        flush()
        if name not in FALLBACK:
            while len(stack) > 1 and self.tags[stack[-1]] == "p":  # a block ends an open paragraph
                self._leave(stack)
        if name in CLOSES and any(self.open[c] for c in CLOSES[name]):
            for depth in range(len(stack) - 1, 0, -1):
                above = self.tags[stack[depth]]
                if above in CLOSES[name]:
                    while len(stack) > depth:
                        self._leave(stack)
                    break
                if above in BORDERS.get(name, {"table"}):
                    break
        stack.append(self._add(stack[-1], *self._element(name, attributes, self.given[stack[-1]])))
        self.open[name] += 1

    def _leave(self, stack: list[int]) -> str:
        """Close the innermost open element."""
        name = self.tags[stack.pop()]
        self.open[name] -= 1
        return name

    def _element(self, name: str, attributes: str, given: int | None) -> tuple:
        found = [f"tag {name}"]
        if attributes.strip():
            for key, value in ATTRIBUTE.findall(attributes):
                key, value = key.lower(), value.strip("\"'").lower()
                if key == "data-y":
                    given = int(value)
                elif key == "hidden" or key == "style" and "display:none" in value.replace(" ", ""):
                    found.append("hint hidden")
                elif key != "style":
                    found += [f"hint {HINT_OF[w]}" for w in SPLIT.split(value) if w in HINT_OF]
        return tuple(dict.fromkeys(found)), None, given, name


def run_features(text: str, linked: int, tag: str) -> tuple[str, ...]:
    words = text.count(" ") + 1
    return (
        "text", f"in {tag if tag in ('p', 'li', 'td') or tag[:1] == 'h' and tag[1:].isdigit() else 'other'}",
        "words 1-3" if words <= 3 else "words 4-15" if words <= 15 else "words 16+",
        "linked" if 2 * linked > len(text) else "plain", "sentence" if text[-1] in ".!?…" else "no sentence",
        *(("rights",) if "©" in text or "copyright" in text.lower() else ()),
    )


def marginals(page: Page, unary: dict[str, float], pair: dict[str, list[float]]) -> tuple[list[float], list[tuple]]:
    """Probability of content for every node, and of every joint state (00, 01, 10, 11) of a node and its parent."""
    n, parent = len(page.parent), page.parent
    own = [sum(map(unary.get, f, (0.0,) * len(f))) for f in page.features]
    up = own[:]  # log odds of a node from itself and below
    sent = [0.0] * n
    for i in range(n - 1, 0, -1):
        t00, t01, t10, t11 = pair["run" if page.text[i] is not None else "element"]
        b = up[i]
        sent[i] = _sum(t10, t11 + b) - _sum(t00, t01 + b)
        up[parent[i]] += sent[i]
    full = up[:]
    joint: list[tuple] = [(0.0, 0.0, 0.0, 0.0)] * n
    for i in range(1, n):
        t00, t01, t10, t11 = pair["run" if page.text[i] is not None else "element"]
        rest, b = full[parent[i]] - sent[i], up[i]  # the parent without this child
        logs = (t00, t01 + b, rest + t10, rest + t11 + b)
        top = max(logs)
        e = [math.exp(x - top) for x in logs]
        z = sum(e)
        joint[i] = (e[0] / z, e[1] / z, e[2] / z, e[3] / z)
        p = min(1 - 1e-15, max(1e-15, joint[i][1] + joint[i][3]))
        full[i] = math.log(p / (1 - p))
    return [1 / (1 + math.exp(-max(-700.0, min(700.0, x)))) for x in full], joint


def _sum(a: float, b: float) -> float:
    top = max(a, b)
    return top + math.log(math.exp(a - top) + math.exp(b - top))


# Labelled pages; data-y marks content (1) and the rest (0), inherited by what is inside.
WORDS = "the river rose over night and the town woke to water in its streets"
LABELLED = [
    f'<body data-y="0"><header><h1>Daily</h1><nav><ul><li><a>Home</a></li><li><a>World</a></li></ul></nav></header><main data-y="1"><h1>Flood</h1>'
    f'<p>{WORDS}.</p><p>{WORDS}, {WORDS}.</p><p>Yes.</p><aside data-y="0"><h3>Related</h3><p>{WORDS}.</p></aside><ul><li>{WORDS}</li></ul></main>'
    f'<section class="comments" data-y="0"><h2>Comments</h2><p>{WORDS}!</p><p>Nice.</p></section><footer><p>© 2024 Daily. All rights reserved.</p></footer></body>',
    f'<body data-y="0"><div class="cookie-notice"><p>We use cookies. {WORDS}.</p><button>OK</button></div><div id="menu"><a>One</a> <a>Two</a></div>'
    f'<div class="content" data-y="1"><h2>Heading</h2><p>{WORDS}.</p><div class="ad" data-y="0"><p>Buy now. {WORDS}.</p></div><p>{WORDS}.</p>'
    f'<blockquote><p>{WORDS}</p></blockquote></div><div class="sidebar"><h3>Popular</h3><ul><li><a>{WORDS}</a></li></ul></div><div id="footer">Contact us</div></body>',
    f'<body data-y="0"><nav><a>A</a></nav><article data-y="1"><header data-y="0"><p>Share this</p></header><h1>Title of it</h1><p>{WORDS}.</p><p>{WORDS}</p>'
    f'<table><tr><td>{WORDS}</td><td>12</td></tr></table><form data-y="0"><p>Your mail: {WORDS}.</p></form><footer data-y="0"><p>Posted in news</p></footer></article>'
    f'<div class="related posts"><p>{WORDS}.</p></div><div id="comments"><div class="comment"><p>{WORDS}. {WORDS}.</p></div></div><footer>© Site</footer></body>',
    f'<body data-y="0"><div class="header">Site name</div><div id="main" data-y="1"><h1>Report</h1><p>{WORDS}.</p><p>{WORDS}. {WORDS}.</p><pre>{WORDS}</pre>'
    f'<div class="newsletter" data-y="0"><p>Subscribe: {WORDS}.</p></div><p>Short.</p><ol><li>First</li><li>Second {WORDS}.</li></ol></div>'
    f'<form class="search"><p>Search</p></form><div class="legal"><p>{WORDS}. Copyright.</p></div></body>',
    f'<body data-y="0"><div class="post" data-y="1"><p>{WORDS}.</p><p>{WORDS}.</p><figure><figcaption>{WORDS}</figcaption></figure></div>'
    f'<div class="promo"><p>{WORDS}.</p></div><aside><p>{WORDS}.</p></aside><div role="alert"><p>{WORDS}.</p></div><dialog><p>{WORDS}.</p></dialog></body>',
    f'<body><p data-y="1">{WORDS}.</p><p data-y="1">{WORDS}. {WORDS}.</p><h2 data-y="1">More</h2><p data-y="1">{WORDS}.</p><footer data-y="0"><p>{WORDS}.</p></footer></body>',
    f'<body data-y="0"><noscript><p>{WORDS}.</p></noscript><iframe>{WORDS}.</iframe><select><option>One</option><option>Two</option></select><div class="text" data-y="1">'
    f'<p>{WORDS}.</p><xmp>{WORDS}</xmp><object>{WORDS}.</object><noscript><p>{WORDS}.</p></noscript><p>{WORDS} <canvas>{WORDS}</canvas></p><template><p>{WORDS}.</p></template>'
    f'<svg><text>{WORDS}</text></svg><select data-y="0"><option>One</option><option>Two</option></select></div><datalist><option>{WORDS}</option></datalist></body>',
    f'<body><div data-y="1"><p>{WORDS}.</p><p>{WORDS}.</p></div><div hidden data-y="0"><p>{WORDS}.</p></div><div data-y="0"><a>Terms</a> <a>Privacy</a></div></body>',
]


def _labels(page: Page) -> list[int | None]:
    """Labels of all nodes: of runs as given, of elements by what most of their text is."""
    weight = [[0, 0] for _ in page.parent]
    out: list[int | None] = [None] * len(page.parent)
    for i in range(len(page.parent) - 1, 0, -1):
        if page.text[i] is not None and page.given[i] is not None:
            weight[i][page.given[i]] += len(page.text[i])
        up = weight[page.parent[i]]
        up[0] += weight[i][0]
        up[1] += weight[i][1]
    for i, (bad, good) in enumerate(weight):
        if bad or good:
            out[i] = int(good >= bad)
        elif page.given[i] is not None:
            out[i] = page.given[i]
    return out


OUTSIDE = frozenset("nav aside footer header form dialog menu search select datalist".split())


def mark_semantic(page: Page) -> bool:
    """Labels a page by its ``<article>`` or ``<main>``; False if it has none."""
    if not {"article", "main"} & set(page.tags):
        return False
    for i in range(len(page.parent)):
        p = page.parent[i]
        given = page.given[p] if p >= 0 else 0
        if page.tags[i] in ("article", "main"):
            given = 1
        elif page.tags[i] in OUTSIDE or any(f.startswith("hint") and f not in ("hint main", "hint head") for f in page.features[i]):
            given = 0
        page.given[i] = given
    return True


def fit(pages: list[Page], steps: int = 150) -> dict:
    """Potentials by maximum likelihood of the labels; nodes without a label are left out of the gradient."""
    labels = [_labels(p) for p in pages]
    unary: dict[str, float] = {f: 0.0 for p in pages for fs in p.features for f in fs}
    pair = {"element": [0.5, 0.0, 0.0, 0.5], "run": [0.5, 0.0, 0.0, 0.5]}
    rate = {f: 1e-8 for f in unary}
    slow = {k: [1e-8] * 4 for k in pair}
    total = sum(y is not None for ys in labels for y in ys) or 1
    for _ in range(steps):
        g, h = dict.fromkeys(unary, 0.0), {k: [0.0] * 4 for k in pair}
        for page, ys in zip(pages, labels, strict=True):
            p, joint = marginals(page, unary, pair)
            for i, y in enumerate(ys):
                if y is None:
                    continue
                for f in page.features[i]:
                    g[f] += y - p[i]
                up = page.parent[i]
                if up >= 0 and ys[up] is not None:
                    k = h["run" if page.text[i] is not None else "element"]
                    for s in range(4):
                        k[s] += (2 * ys[up] + y == s) - joint[i][s]
        for f in unary:  # AdaGrad with a small pull towards 0
            d = g[f] / total - 1e-4 * unary[f]
            rate[f] += d * d
            unary[f] += 0.3 * d / math.sqrt(rate[f])
        for k in pair:
            for s in range(4):
                d = h[k][s] / total - 1e-4 * pair[k][s]
                slow[k][s] += d * d
                pair[k][s] += 0.3 * d / math.sqrt(slow[k][s])
    return {"unary": unary, "pair": pair}


def train(pages: DataFrame | None = None, id_col: str = "page_id", html_col: str = "html") -> dict:
    """Model from the labelled pages here and, if given, at most ``SAMPLE`` pages of a table."""
    known = [Page(s) for s in LABELLED] * SEED_WEIGHT
    if pages is not None:
        body = F.col(html_col).cast("string")
        some = pages.select(F.col(id_col).alias("id"), body.alias("html")).filter(F.length("html") <= SAMPLE_CHARS)
        some = some.withColumn("pick", F.xxhash64("id", "html"))
        picks = [r.pick for r in some.select("pick").orderBy("pick").limit(SAMPLE).collect()]
        some = some.filter(F.col("pick") <= max(picks)).dropDuplicates(["pick"]).collect() if picks else []  # SAMPLE rows
        for r in sorted(some, key=lambda r: r.pick):
            page = Page(r.html)
            if mark_semantic(page):
                known.append(page)
    return fit(known)


def main_text(html: Column, model: dict) -> Column:
    """The content blocks of a page, joined by two line ends."""
    unary, pair = model["unary"], model["pair"]

    @F.arrow_udf("string")
    def extracted(column: pa.Array) -> pa.Array:
        out = []
        for s in column:
            page = Page(s.as_py() or "")
            p, _ = marginals(page, unary, pair)
            out.append("\n\n".join(t for t, q in zip(page.text, p, strict=True) if t is not None and q >= 0.5))
        return pa.array(out, pa.string())

    return extracted(html.cast("string"))


def extract(pages: DataFrame, model: dict, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id, url, text, n_chars)`` of every page."""
    done = pages.select(id_col, url_col, main_text(F.col(html_col), model).alias("text"))
    return done.withColumn("n_chars", F.length("text").cast("long"))
