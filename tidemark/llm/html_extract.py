"""HTML extraction: gradient-boosted trees over DOM nodes, hierarchical decoding.

A page is parsed into a tree of block elements; inline markup belongs to its
block. Trees score each block by its tag, attribute tokens (its own and its
ancestors'), depth, siblings, and its subtree's text: length, link share, words
and tags. Decoding then takes the likeliest consistent choice for the whole tree:
a dropped block drops all below it, a kept one leaves its children their own
choice (one pass up, one down), so no kept node has a dropped ancestor.

There are no labelled pages, so labels come with the layout: a bounded sample of
`SAMPLE_PAGES` pages gives texts, and each is laid out anew (`layouts`) with
menus, notices, adverts, forms, sidebars, comments and footers around or inside
the article in usual markup, whose blocks are known to be article or not.

Defined results: null or empty html, or html without an article, gives the empty
text; broken and cut-off markup is closed where it ends; rows with the same id
are extracted apart; an empty table gives no rows; with no page with text to learn
from every block is kept. Pages of any length are learned from (`train`). Only page_id, url and html are read.
"""

from __future__ import annotations

import html
import random
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import gbdt
from tidemark.llm.common import map_batches, sf_table, text_chunks

SAMPLE_PAGES, MAX_CHARS = 400, 30_000
# Element names of the markup language by what they do.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("head script style noscript template svg iframe object select textarea button title audio video canvas".split())
RAW = set("script style textarea title".split())
BLOCK = set("html body address article aside blockquote dd details dialog div dl dt fieldset figcaption figure footer form "
            "h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"html", "body"}
KINDS = [{"p"}, {"h1", "h2", "h3", "h4", "h5", "h6"}, {"ul", "ol", "menu", "dl"}, {"li", "dt", "dd"},
         {"table", "tbody", "thead", "tr", "td", "th"}, {"article", "main"}, {"section", "div"},
         {"nav", "menu"}, {"aside"}, {"header"}, {"footer"}, {"form", "fieldset", "legend"}, {"blockquote", "pre", "figure"},
         {"html", "body"}, {"dialog", "details", "summary"}]
GOOD = re.compile(r"article|content|post(?!s|er)|entry|story|main|body|text|prose", re.I)
BAD = re.compile(r"nav|menu|foot|header|masthead|side|aside|widget|banner|cookie|consent|notice|gdpr|popup|modal|alert|"
                 r"\bads?\b|\bad[-_]|[-_]ad\b|advert|sponsor|promo|comment|repl(y|ies)|respond|disqus|discussion|form|search|login|"
                 r"subscribe|newsletter|signup|share|social|related|recommend|breadcrumb|pagination|copyright|tool|hidden", re.I)
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|"
                    r"<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(>|$)|<(?=[a-zA-Z/])[^>]*(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|aria-label|data-[a-z-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)


class Node:
    __slots__ = ("tag", "names", "parent", "children", "parts", "links", "tags", "at")

    def __init__(self, tag: str, names: str, parent):
        self.tag, self.names, self.parent = tag, names, parent
        self.children: list[Node] = []
        self.parts: list = []  # texts and child nodes, in page order
        self.links = self.tags = 0
        self.at = 0  # place in `walk`


def parse(page: str | None) -> Node:
    """Tree of block elements. Inline elements give their text to their block."""
    root = Node("html", "", None)
    stack: list[tuple[str, Node | None]] = []  # open elements; None for inline ones
    at, block, hidden, in_link = 0, root, 0, 0
    text = page or ""
    end = len(text)

    def say(piece: str) -> None:
        if not hidden and piece:
            block.parts.append(piece)
            if in_link:
                block.links += len(piece.strip())

    def close(to: int) -> None:
        nonlocal block, hidden, in_link
        while len(stack) > to:
            tag, node = stack.pop()
            if node is not None:
                block = node.parent
            hidden -= tag in HIDDEN
            in_link -= tag == "a"

    while at < end:
        m = _TOKEN.search(text, at)
        if not m:
            say(text[at:])
            break
        say(text[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
            continue
        block.tags += 1
        if tag in VOID:
            say(" ")
            continue
        if tag in CLOSES_P or tag == "li":
            # A block ends an open paragraph, an item the item before it in the same list.
            stops = {"li"} if tag == "li" else {"dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th") else {"p"}
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in stops or stack[i][0] == "p":
                    close(i)
                    break
                if stack[i][1] is not None:
                    break
        if tag in BLOCK and not hidden:
            names = " ".join(v.strip("\"'") for _, v in _ATTRIBUTE.findall(m[3] or "")) if m[3] else ""
            node = Node(tag, names, block)
            block.children.append(node)
            block.parts.append(node)
            stack.append((tag, node))
            block = node
        else:
            stack.append((tag, None))
        hidden += tag in HIDDEN
        in_link += tag == "a"
        if tag in RAW:
            stop = re.compile(rf"</{tag}\b", re.I).search(text, at)
            at = stop.start() if stop else end
    return root


def walk(root: Node) -> list[Node]:
    """Nodes, parents before children, in page order."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        node.at = len(out)
        out.append(node)
        todo.extend(reversed(node.children))
    return out


def own_text(node: Node) -> str:
    return "".join(p for p in node.parts if isinstance(p, str))


_KIND_OF = {t: [float(t in k) for k in KINDS] for t in BLOCK}
_NO_KIND = [0.0] * len(KINDS)


def features(nodes: list[Node]) -> np.ndarray:
    """One row of features for each node of `walk`."""
    n = len(nodes)
    chars, words, links, tags = [0] * n, [0] * n, [0] * n, [0] * n
    blocks, ps = [1] * n, [0] * n
    for i, x in enumerate(nodes):
        t = own_text(x).split()
        words[i], chars[i], links[i], tags[i], ps[i] = len(t), len("".join(t)), x.links, x.tags, x.tag == "p"
    own = list(chars)
    for i in range(n - 1, 0, -1):
        up = nodes[i].parent.at
        chars[up] += chars[i]
        words[up] += words[i]
        links[up] += links[i]
        tags[up] += tags[i]
        blocks[up] += blocks[i]
        ps[up] += ps[i]
    rows, kinds, above = [], [], []
    whole = max(chars[0], 1)
    counts: dict[int, dict[str, int]] = {}
    for i, x in enumerate(nodes):
        bad = good = 0
        if x.names:
            bad, good = len(BAD.findall(x.names)), len(GOOD.findall(x.names))
        depth = bad_above = good_above = kin = alike = share = 0
        kinds.append(_KIND_OF.get(x.tag, _NO_KIND))
        if i:
            u = x.parent.at
            up = rows[u]
            depth, bad_above, good_above = up[0] + 1, max(up[4], up[2]), max(up[5], up[3])
            if u not in counts:
                counts[u] = {}
                for k in nodes[u].children:
                    counts[u][k.tag] = counts[u].get(k.tag, 0) + 1
            kin, alike, share = len(nodes[u].children), counts[u][x.tag], chars[i] / max(chars[u], 1)
            above.append([a or b for a, b in zip(above[u], kinds[u])])
        else:
            above.append(_NO_KIND)
        c = max(chars[i], 1)
        rows.append([depth, bool(x.names), bad, good, bad_above, good_above, kin, alike, share,
                     chars[i], own[i], links[i] / c, chars[i] / (tags[i] + 1), words[i] / blocks[i],
                     blocks[i], ps[i] / blocks[i], chars[i] / whole, i / n, links[i] > 0, x.tags])
    return np.concatenate([np.array(rows, float), np.array(kinds), np.array(above)], 1)


def decode(nodes: list[Node], p: np.ndarray) -> list[bool]:
    """The likeliest choice of kept nodes in which a kept node's ancestors are kept."""
    p = np.clip(p, 1e-6, 1 - 1e-6)
    drop, keep = np.log(1 - p).tolist(), np.log(p).tolist()
    for i in range(len(nodes) - 1, 0, -1):
        up = nodes[i].parent.at
        keep[up] += max(drop[i], keep[i])
        drop[up] += drop[i]
    kept: list[bool] = []
    for i, x in enumerate(nodes):
        kept.append((x.parent is None or kept[x.parent.at]) and keep[i] > drop[i])
    return kept


def blocks_of(root: Node, kept: list[bool]) -> list[str]:
    """Texts of the kept nodes' blocks, in page order; white space as one space."""
    out: list[str] = []
    todo: list = [(root, iter(root.parts), [])]
    while todo:
        node, parts, said = todo[-1]
        for part in parts:
            if isinstance(part, str):
                if kept[node.at]:
                    said.append(part)
            else:
                out.append("".join(said))
                said.clear()
                todo.append((part, iter(part.parts), []))
                break
        else:
            out.append("".join(said))
            todo.pop()
    clean = (" ".join(html.unescape(t).split()) for t in out)
    return [t for t in clean if t]


def extract_all(pages: list[str | None], model: gbdt.Trees | None) -> list[str]:
    """Texts of some pages; their nodes are scored together."""
    trees = [walk(parse(p)) for p in pages]
    if model is None:
        choices = [[True] * len(t) for t in trees]
    elif trees:
        p = model.probabilities(np.concatenate([features(t) for t in trees]))
        ends = np.cumsum([len(t) for t in trees])
        choices = [decode(t, p[e - len(t):e]) for t, e in zip(trees, ends)]
    else:
        choices = []
    return ["\n".join(blocks_of(t[0], c)) for t, c in zip(trees, choices)]


def extract(page: str | None, model: gbdt.Trees | None) -> str:
    return extract_all([page], model)[0]


# Usual markup that training pages are laid out in; "{}" holds the blocks.
ARTICLES = ['<article>{}</article>', '<main><article>{}</article></main>', '<div class="post-content">{}</div>',
            '<div id="content"><div class="entry">{}</div></div>', '<main>{}</main>', '<section class="article-body">{}</section>',
            '<div class="story" itemprop="articleBody">{}</div>', '<article class="post">{}</article>', '<div>{}</div>']
LINKS = ['<nav><ul>{}</ul></nav>', '<div class="menu"><ul>{}</ul></div>', '<div class="related-posts"><ul>{}</ul></div>',
         '<ul class="breadcrumb">{}</ul>', '<div id="sidebar"><ul>{}</ul></div>', '<aside><ul>{}</ul></aside>',
         '<header><ul>{}</ul></header>', '<footer><ul>{}</ul></footer>', '<div><ul>{}</ul></div>']
OTHERS = ['<div class="ad">{}</div>', '<div class="advertisement"><p>{}</p></div>', '<aside><p>{}</p></aside>',
          '<div class="cookie-notice"><p>{}</p></div>', '<div id="cookie-banner">{}</div>', '<div class="sidebar"><p>{}</p></div>',
          '<aside class="widget"><h3>{}</h3><p>{}</p></aside>', '<footer>{}</footer>', '<footer><p>{}</p></footer>',
          '<header><p>{}</p></header>', '<div class="header">{}</div>', '<form action="/s"><label>{}</label><input name="q"></form>',
          '<div class="newsletter"><form><p>{}</p></form></div>', '<section id="comments"><h2>{}</h2><div class="comment"><p>{}</p></div></section>',
          '<div class="comments"><ol><li class="comment-body"><p>{}</p></li></ol></div>', '<div class="comment-list"><p>{}</p><p>{}</p></div>',
          '<div class="popup" role="dialog">{}</div>', '<div class="share">{}</div>', '<div class="footer">{}</div>', '<div role="banner">{}</div>']
BLOCKS = ['<p>{}</p>'] * 12 + ['<p>{}', '<p><b>{}<br></p>', '<h2>{}</h2>', '<blockquote>{}</blockquote>', '<ul><li>{}</li></ul>',
                               '<div>{}</div>', '<p>{} <a href="/x">link</a></p>', '<pre>{}</pre>', '<blockquote><p>{}</p></blockquote>']


def layouts(texts: list[str], rng: random.Random) -> str:
    """A page whose article's blocks end in \\x01 and whose other blocks end in \\x02."""
    fill = lambda form, mark: re.sub(r"\{\}", lambda _: rng.choice(texts) + mark, form)
    links = lambda: rng.choice(LINKS).format("".join(
        f'<li><a href="/{i}">{" ".join(rng.choice(texts).split()[:rng.randint(1, 4)])}\x02</a></li>' for i in range(rng.randint(2, 9))))
    other = lambda: fill(rng.choice(OTHERS), "\x02")
    body = [fill(rng.choice(["<h1>{}</h1>", "<h1>{}</h1>", "<header><h1>{}</h1></header>"]), "\x01")] if rng.random() < 0.8 else []
    for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 12])):
        body.append(fill(rng.choice(BLOCKS), "\x01"))
        if rng.random() < 0.08:
            body.append(rng.choice([links, other])())
    before = [rng.choice([links, other])() for _ in range(rng.randint(0, 4))]
    after = [rng.choice([links, other])() for _ in range(rng.randint(0, 4))]
    page = "".join(before) + rng.choice(ARTICLES).replace("{}", "".join(body)) + "".join(after)
    if rng.random() < 0.3:
        page = f'<div class="{rng.choice(["wrapper", "container", "page", "site-main"])}">{page}</div>'
    return f"<!DOCTYPE html><html><head><title>x</title></head><body>{page}</body></html>"


def labelled(page: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a laid-out page: a node is article if any block below it is."""
    nodes = walk(parse(page))
    good = ["\x01" in own_text(x) for x in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        good[nodes[i].parent.at] |= good[i]
    for x in nodes:
        x.parts = [p.replace("\x01", "").replace("\x02", "") if isinstance(p, str) else p for p in x.parts]
    return features(nodes), np.array(good, float)


def fit(pages: list[str], layouts_each: int = 3, seed: int = 11) -> gbdt.Trees | None:
    """Trees from the texts of some pages, laid out anew."""
    rng = random.Random(seed)
    x, y = [], []
    for page in pages:
        nodes = walk(parse(page))
        texts = [html.escape(t) for t in blocks_of(nodes[0], [True] * len(nodes))]
        for _ in range(layouts_each if texts else 0):
            a, b = labelled(layouts(texts, rng))
            x.append(a)
            y.append(b)
    return gbdt.fit(np.concatenate(x), np.concatenate(y), rounds=40, depth=4) if x else None


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, max_chars: int = MAX_CHARS) -> gbdt.Trees | None:
    """Fit on a bounded sample: the pages of smallest hash among those of at most `max_chars` characters.

    Where all pages are longer, the shortest ones: one, and more up to `sample_pages` times `max_chars` characters.
    """
    every = pages.select("html").where(F.col("html").isNotNull())
    rows = every.where(F.length("html") <= max_chars)
    least = rows.select(F.xxhash64("html").alias("h")).orderBy("h").limit(sample_pages).agg(F.max("h")).first()[0]
    if least is not None:
        chosen = rows.where(F.xxhash64("html") <= least).orderBy(F.xxhash64("html")).limit(sample_pages).collect()
        return fit([r["html"] for r in chosen])
    sizes = every.select(F.length("html").alias("n"), F.xxhash64("html").alias("h")).distinct().orderBy("n", "h").limit(sample_pages).collect()
    upto = np.cumsum([r["n"] for r in sizes]) <= sample_pages * max_chars
    names = [(r["n"], r["h"]) for i, (r, fits) in enumerate(zip(sizes, upto)) if fits or i == 0]
    if not names:
        return None
    chosen = every.where(F.length("html") <= names[-1][0]).select("html", F.length("html").alias("n"), F.xxhash64("html").alias("h"))
    chosen = chosen.where(F.struct("n", "h") <= F.struct(F.lit(names[-1][0]).alias("n"), F.lit(names[-1][1]).alias("h")))
    return fit([r["html"] for r in chosen.dropDuplicates(["n", "h"]).orderBy("n", "h").limit(len(names)).collect()])


def extract_pages(pages: DataFrame, model: gbdt.Trees | None) -> DataFrame:
    """(page_id, url, text) for every row."""
    def make():
        def batch(b):
            texts = b.column(2).to_pylist()
            out = [t for lo, hi in text_chunks(texts) for t in extract_all(texts[lo:hi], model)]
            yield {"page_id": b.column(0), "url": b.column(1), "text": out}
        return batch

    return map_batches(pages.select("page_id", "url", "html"), make, "page_id bigint, url string, text string")


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = sf_table(spark, sf_dir, "pages")
    return extract_pages(pages, train(pages)).withColumn("n_chars", F.length("text").cast("bigint"))
