"""Main text of web pages by gradient-boosted trees over DOM nodes.

A page is read into its block elements. Each has features of its subtree (text, links,
tags, density), its attribute tokens and those above it, its depth, and how it stands
among its siblings. Boosted trees give the log-odds that a block holds main text. The
decoding keeps a set of blocks that holds the parent of each of its members and whose
log-odds sum to the most, so nothing is kept inside what is dropped.

Training: a bounded sample of the given pages (``SAMPLE_PAGES``) is laid out anew, with known
truth, in containers and beside menus, notices, adverts, forms and comments of many names; the trees are
fitted with Spark's own. Every page is then read whole.

Nulls: a null or empty page has the empty text, a null url stays null. Pages without
main text give the empty text. Repeated rows stay. White space in a block, <br> included, becomes one space;
inline tags add none.
"""

from __future__ import annotations

import html as entities
import math
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_PAGES = 200
LAYOUTS = 3
TREES = 20
DEPTH = 5

# HTML element names by kind.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Scripts, styles, form fields, and what stands for embedded content that a browser shows in its place.
SKIPPED = frozenset("script style textarea title template select noscript iframe object canvas audio video".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = frozenset("ul ol dl table article section main body html div nav aside header footer form".split())
KINDS = ["article", "main", "section", "div", "p", "ul", "li", "nav", "header", "footer", "aside", "form", "h", "table", "head", "blockquote"]
MAIN_WORDS = frozenset("article content main post entry body story text blog page".split())
OTHER_WORDS = frozenset(
    "nav navigation menu sidebar side widget footer foot header head masthead banner ad ads advert advertisement sponsor sponsored promo "
    "cookie cookies consent notice alert popup modal newsletter subscribe signup login form search comment comments "
    "reply replies disqus respond discussion share social related recommended breadcrumb breadcrumbs pagination copyright legal tags meta toolbar complementary".split()
)

_PART = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")
_SPLIT = re.compile(r"([a-z])([A-Z])")


class Page:
    """Blocks of a page in document order, parents first, and its text with the block it is in."""

    def __init__(self, source: str | None):
        self.tags, self.parents, self.depths, self.names, self.truth = ["html"], [-1], [0], [frozenset()], [False]
        self.texts: list[tuple[int, int, str, bool]] = []  # block, line, text, inside a link
        self._read(source or "")

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("html", 0)]
        at = line = links = 0
        skip = None
        while at < len(source):
            m = _PART.search(source, at)
            end = m.start() if m else len(source)
            if end > at and skip is None:
                self.texts.append((stack[-1][1], line, entities.unescape(source[at:end]), links > 0))
            if m is None:
                break
            at = m.end()
            if m[2] is None:
                continue
            tag, closing = m[2].lower(), bool(m[1])
            if skip is not None:
                skip = None if closing and tag == skip else skip
                continue
            if closing:
                if tag == "a":
                    links = max(0, links - 1)
                if tag in BLOCKS:
                    line += 1
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        break
                continue
            if tag in SKIPPED:
                if not m[3].endswith("/"):
                    close = re.compile(f"</{tag}[\\s/>]", re.IGNORECASE).search(source, at)
                    if close is None and tag in ("script", "style", "textarea", "title"):
                        break
                    if close is not None:
                        at = close.start()
                        skip = tag
                continue
            if tag == "br":
                self.texts.append((stack[-1][1], line, " ", False))
            if tag in VOID:
                line += tag == "hr"
                continue
            if tag == "a":
                links += 1
            if tag not in BLOCKS:
                continue
            line += 1
            if tag in ("html", "body") and len(stack) > 1 and tag == "html":
                continue
            self._close(stack, tag)
            if tag == "html":
                continue
            names = frozenset(w for v in _NAMES.findall(m[3]) for w in _WORD.findall(_SPLIT.sub(r"\1 \2", v).lower()))
            above = stack[-1][1]
            self.tags.append(tag)
            self.parents.append(above)
            self.depths.append(self.depths[above] + 1)
            self.names.append(names)
            self.truth.append(self.truth[above] or "data-main" in m[3])
            stack.append((tag, len(self.tags) - 1))

    @staticmethod
    def _close(stack: list, tag: str) -> None:
        """Ends the elements that a new block ends: an open paragraph, or the item before."""
        if tag == "body":
            del stack[1:]
        if stack[-1][0] == "p":
            stack.pop()
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in CLOSES.get(tag, ()):
                del stack[i:]
            elif stack[i][0] in SCOPES and not (tag in CLOSES and stack[i][0] == "div"):
                break

    def features(self) -> np.ndarray:
        """One row per block."""
        n = len(self.tags)
        own, linked, stops, words = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
        for block, _, text, link in self.texts:
            size = len(text.strip())
            own[block] += size
            words[block] += text.count(" ")
            stops[block] += text.count(".") + text.count(",")
            if link:
                linked[block] += size
        total, blocks, p, li, longest = own.copy(), np.ones(n), np.zeros(n), np.zeros(n), own.copy()
        heads = np.zeros(n)
        children = np.zeros(n)
        place = np.zeros(n)
        for i in range(1, n):
            place[i] = children[self.parents[i]]
            children[self.parents[i]] += 1
        for i in range(n - 1, 0, -1):
            up, tag = self.parents[i], self.tags[i]
            p[i] += tag == "p"
            li[i] += tag == "li"
            heads[i] += tag[0] == "h" and tag[1:].isdigit()
            for sums in (total, linked, stops, words, blocks, p, li, heads):
                sums[up] += sums[i]
            longest[up] = max(longest[up], longest[i])
        up = np.array([max(0, x) for x in self.parents])
        siblings = np.maximum(1, children[up])
        most = np.zeros(n)
        np.maximum.at(most, up[1:], total[1:])
        all_text = max(1.0, total[0])
        mains = np.array([len(x & MAIN_WORDS) for x in self.names], dtype=float)
        others = np.array([len(x & OTHER_WORDS) for x in self.names], dtype=float)
        kinds = np.zeros((n, len(KINDS)))
        for i, tag in enumerate(self.tags):
            kind = "h" if tag[0] == "h" and tag[1:].isdigit() else "ul" if tag in ("ol", "menu") else tag
            if kind in KINDS:
                kinds[i, KINDS.index(kind)] = 1
        odd = [KINDS.index(k) for k in ("nav", "header", "footer", "aside", "form", "head")]
        good = [KINDS.index(k) for k in ("article", "main")]
        below_other, below_main = np.zeros(n), np.zeros(n)
        for i in range(1, n):
            u = self.parents[i]
            below_other[i] = below_other[u] + others[u] + kinds[u, odd].sum()
            below_main[i] = below_main[u] + mains[u] + kinds[u, good].sum()
        safe = np.maximum(1.0, total)
        columns = [
            np.array(self.depths), np.log1p(children), place / siblings, np.log1p(siblings), np.log1p(total), total / all_text,
            linked / safe, stops / safe, words / safe, np.log1p(total / blocks), np.log1p(longest), np.log1p(p), np.log1p(li),
            np.log1p(heads), np.log1p(own), total / np.maximum(1.0, total[up]), total / np.maximum(1.0, most[up]),
            mains, others, below_main, below_other,
        ]
        return np.column_stack([*columns, kinds])

    def kept(self, odds: np.ndarray) -> np.ndarray:
        """The blocks of the best set that holds the parents of its members; ``odds``: log-odds per block."""
        best = np.array(odds, dtype=float)
        best[0] = 0.0
        for i in range(len(best) - 1, 0, -1):
            if best[i] > 0 and self.parents[i] >= 0:
                best[self.parents[i]] += best[i]
        keep = np.zeros(len(best), dtype=bool)
        keep[0] = True
        for i in range(1, len(best)):
            keep[i] = keep[self.parents[i]] and best[i] > 0
        return keep

    def text(self, keep: np.ndarray) -> str:
        lines: dict[tuple[int, int], list[str]] = {}
        for block, line, text, _ in self.texts:
            if keep[block]:
                lines.setdefault((line, block), []).append(text)
        return "\n".join(x for x in (" ".join("".join(v).split()) for v in lines.values()) if x)

    def labels(self) -> np.ndarray:
        """Blocks that hold main text, by the truth that the layout marked."""
        out = np.zeros(len(self.tags), dtype=bool)
        for block, _, text, _ in self.texts:
            out[block] |= self.truth[block] and bool(text.strip())
        for i in range(len(out) - 1, 0, -1):
            out[self.parents[i]] |= out[i]
        return out


# Names that pages give to their parts, for layouts.
CONTAINERS = ["article", "main", "article class='post'", "div class='content'", "div id='main-content'", "div class='post-body'", "div class='entry-content'", "section class='story'", "div class='article-text'", "div", "section", "td"]
PARTS = {
    "list": ["nav", "ul class='menu'", "div class='navigation'", "header", "div class='header'", "aside", "div class='sidebar'", "div class='related'", "ul class='breadcrumb'", "footer", "div class='share'", "div id='nav'", "div class='tags'"],
    "prose": ["div class='ad'", "div class='cookie-notice'", "div class='banner'", "aside", "aside class='sidebar'", "div class='sidebar'", "div class='newsletter'", "div class='notice'", "footer", "div class='footer'", "header", "div class='promo'", "section class='comments'", "div class='comment'", "div id='comments'", "div class='popup'", "div role='alert'", "div class='sponsored'", "div class='advert'"],
    "form": ["form", "form class='search'", "div class='login'", "form class='signup'", "div class='subscribe'"],
}


def layout(rng: random.Random, lines: list[str], spare: list[str]) -> str:
    """A page of ``lines`` as its main text, marked, among parts filled with ``spare``."""
    esc = entities.escape

    def wrapped(opening: str, inner: str, mark: str = "") -> str:
        return f"<{opening}{mark}>{inner}</{opening.split()[0]}>"

    def part() -> str:
        kind = rng.choice(["list", "prose", "prose", "form"])
        names = rng.choice(PARTS[kind])
        some = [esc(rng.choice(spare)) for _ in range(rng.randint(1, 8 if kind == "list" else 3))]
        if kind == "list":
            inner = "".join(f"<li><a href='#'>{' '.join(s.split()[:3])}</a></li>" for s in some)
            inner = inner if "ul" in names else f"<ul>{inner}</ul>" if rng.random() < 0.8 else inner.replace("li>", "span>")
        elif kind == "form":
            inner = f"<p>{' '.join(some[0].split()[:8])}</p><label>{' '.join(some[0].split()[:2])}</label><input name=q><button>Go</button>"
        elif "comment" in names:
            inner = "".join(f"<div class='{rng.choice(['comment', 'reply', 'c'])}'><p>{s}</p></div>" for s in some)
        else:
            inner = rng.choice([" ".join(some[0].split()[:20]), "".join(f"<p>{s}</p>" for s in some), f"&copy; {' '.join(some[0].split()[:12])}"])
        return wrapped(names, inner)

    body = []
    for i, line in enumerate(lines):
        tag = "h1" if i == 0 else rng.choice(["p"] * 12 + ["h2", "blockquote", "li", "div"])
        text = esc(line)
        if rng.random() < 0.1:
            text = f"<b>{text}</b>"
        one = f"<{tag}>{text}</{tag}>"
        body.append(f"<ul>{one}</ul>" if tag == "li" else one)
    groups, i = "", 0
    while i < len(body):
        size = rng.randint(1, 6)
        inner = "".join(body[i : i + size])
        groups += wrapped("div data-main", inner) if rng.random() < 0.15 else re.sub(r"<(h1|p|h2|blockquote|ul|div)>", r"<\1 data-main>", inner)
        if rng.random() < 0.12:
            groups += part()
        i += size
    container = rng.choice(CONTAINERS)
    main = wrapped(container, groups)
    if container == "td":
        main = f"<table><tr>{main}</tr></table>"
    for _ in range(rng.randint(0, 2)):
        main = wrapped(rng.choice(["div", "div class='wrapper'", "div id='page'", "section", "div class='row'"]), main + (part() if rng.random() < 0.3 else ""))
    before = "".join(part() for _ in range(rng.randint(0, 4)))
    after = "".join(part() for _ in range(rng.randint(0, 4)))
    return f"<html><head><title>{esc(lines[0])}</title></head><body>{before}{main}{after}</body></html>"


def training_rows(sources: list[str], seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of blocks of pages laid out anew from the lines of given ones."""
    rng = random.Random(seed)
    pages = [Page(s) for s in sources]
    texts = [p.text(np.array([t != "head" for t in p.tags])).split("\n") for p in pages]
    texts = [[line for line in t if line] for t in texts]
    spare = [line for t in texts for line in t]
    x, y = [], []
    for lines in texts:
        for _ in range(LAYOUTS if lines else 0):
            some = lines[: rng.randint(1, len(lines))] if rng.random() < 0.5 else rng.sample(lines, rng.randint(1, len(lines)))
            page = Page(layout(rng, some, spare))
            x.append(page.features()[1:])
            y.append(page.labels()[1:])
    return (np.vstack(x), np.concatenate(y)) if x else (np.zeros((0, 0)), np.zeros(0))


def _flat(node) -> list[tuple[int, float, int, int, float]]:
    """(feature, threshold, left, right, prediction) of a tree's nodes; feature -1 is a leaf."""
    rows: list = [None]

    def put(at: int, node) -> None:
        if node.subtreeDepth() == 0:
            rows[at] = (-1, 0.0, at, at, node.prediction())
            return
        left, right = len(rows), len(rows) + 1
        rows.extend([None, None])
        rows[at] = (node.split().featureIndex(), node.split().threshold(), left, right, 0.0)
        put(left, node.leftChild())
        put(right, node.rightChild())

    put(0, node)
    return rows


def train(pages: DataFrame) -> list | None:
    """Boosted trees as (weight, nodes), learnt from a sample of about SAMPLE_PAGES pages."""
    n = pages.count()
    chance = F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 30)) < int(min(1.0, SAMPLE_PAGES / max(1, n)) * (1 << 30))
    sample = pages.where(chance & F.col("html").isNotNull()).select("page_id", "html").limit(4 * SAMPLE_PAGES).collect()
    x, y = training_rows([r.html for r in sorted(sample, key=lambda r: (r.page_id is None, r.page_id, r.html))])
    if not 0 < y.sum() < len(y):
        return None
    rows = pages.sparkSession.createDataFrame(
        pa.table({"x": pa.array(x.tolist(), pa.list_(pa.float64())), "label": pa.array(y.astype(float))})
    )
    rows = rows.select(array_to_vector("x").alias("features"), "label").coalesce(2)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=3).fit(rows)
    return [(w, _flat(tree._call_java("rootNode"))) for w, tree in zip(model.treeWeights, model.trees)]


def log_odds(model: list, x: np.ndarray) -> np.ndarray:
    total = np.zeros(len(x))
    rows = np.arange(len(x))
    for weight, nodes in model:
        feature, threshold, left, right, value = (np.array(c) for c in zip(*nodes))
        at = np.zeros(len(x), dtype=np.int64)
        while (feature[at] >= 0).any():
            go_left = x[rows, np.maximum(0, feature[at])] <= threshold[at]
            at = np.where(feature[at] < 0, at, np.where(go_left, left[at], right[at]))
        total += weight * value[at]
    return 2 * total


def extract(pages: DataFrame, model: list | None) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page. Without a model, all text outside the head."""
    shipped = pages.sparkSession.sparkContext.broadcast(model)
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches):
        trees = shipped.value
        for batch in batches:
            texts = []
            for start in range(0, batch.num_rows, 500):
                read = [Page(s) for s in batch.column("html").slice(start, 500).to_pylist()]
                x = np.vstack([p.features() for p in read])
                odds = log_odds(trees, x) if trees else np.ones(len(x))
                at = 0
                for page in read:
                    own = odds[at : at + len(page.tags)]
                    at += len(page.tags)
                    own = np.where([t == "head" for t in page.tags], -math.inf, own)
                    texts.append(page.text(page.kept(own)))
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text"])

    out = pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string")
    return out.withColumn("n_chars", F.char_length("text").cast("bigint"))
