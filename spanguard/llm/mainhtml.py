"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks of text in page order, each with its open elements. Over the whole table it is counted on how
many unlike pages of its host a block stands, as what a site repeats isn't an article's. A logistic
classifier of the text's own figures, that count and what the markup says, fitted to the blocks of a bounded sample of pages, gives each block a log-odds of being content; the positive part is the capacity of
its edge from the source, the negative part that of its edge to the sink. Neighbouring blocks
are joined by a smoothness edge that is weaker the more elements lie between them, and so are
consecutive blocks under one parent. The blocks on the source's side of a minimum cut are the
main text. Blocks whose own log-odds outweigh all their edges are settled before the flow is
computed, which changes no cut.

Blocks keep all text with character references decoded; white space is one space, blocks are
joined by one newline. Scripts, styles, forms' controls, head, comments and hidden elements
have no blocks. A class, id or role names boilerplate if all its parts are names of boilerplate or of layout; one
that only holds such a word (``share-prices``) is a weak hint among the others.

Defined results: null or empty html gives empty text; markup that is cut off, badly nested or
unclosed is read as far as it goes; repeated rows and ids are rows of their own; other columns
are ignored; very long pages take memory in proportion to their blocks.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, map_batches, rows_of

# Element names and words of class, id and role attributes.
BLOCK_TAGS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT_TAGS = frozenset("applet audio button canvas datalist head iframe map noembed noframes object option optgroup select svg template textarea title video".split())
RAW_TAGS = frozenset("script style".split())
BAD_TAGS = frozenset("nav footer aside menu dialog".split())
BAD_WORDS = frozenset(
    "ad ads adv advert advertisement advertising adverts alert banner breadcrumb breadcrumbs cart comment comments commentlist complementary consent contentinfo cookie cookies copyright disclaimer discuss discussion dialog disqus feedback foot footer form gdpr guestbook header "
    "legal links login masthead menu meta modal nav navbar navigation newsletter notice notices notification outbrain overlay pager pagination paywall popup privacy promo promoted promotion rail recommended register related replies reply respond search share sharing shop sidebar signin signup "
    "skip skyscraper social sponsor sponsored subscribe subscription taboola tags talkback teaser thread toolbar topbar tracking warning widget widgets".split()
)
GOOD_WORDS = frozenset("article articlebody content entry main post prose story text".split())
LAYOUT_WORDS = frozenset("area bar block bottom box btn button buttons container entries first global group holder icon icons inner item items last left list menu outer page panel primary right row secondary section site top unit wrap wrapper zone".split())
NEGATED = frozenset("has no with without".split())
SAME = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

#: Weights to begin with, in log-odds, in the order of ``features``.
PLAIN = (-0.6, 3.2, -5.0, 0.8, 2.0, 0.0, 0.0, -1.0, -3.0, 5.0, -9.0, -7.0, -1.0)
#: Repeated blocks of all hosts up to which their counts (16 bytes each) are sent to all executors; more are joined to their pages.
REPEATS = 1_000_000
#: Pages that the classifier is fitted to, at most: those of least id hash.
TRAIN_PAGES = 400
#: Smoothness of neighbours in page order, and of consecutive blocks of one parent.
S_NEXT, S_PARENT = 0.5, 0.4

#: A tag's name and attributes up to its end; no part is given back, so a tag that never ends is read once.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_OPENS = re.compile(r"<(?=[a-zA-Z!?]|/[a-zA-Z])")
#: A whole attribute: its name, and its value if it has one. Matches follow each other, so none begins inside a name or a value.
_ATTR = re.compile(r"""([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_END = {t: re.compile(f"</{t}(?=[\\s/>])[^>]*>?|\\Z", re.I) for t in RAW_TAGS | {"textarea", "title"}}


class Node:
    """An open element: what it and its ancestors say about the text inside."""

    __slots__ = ("tag", "parent", "depth", "block", "good", "bad", "hint", "form", "silent", "link")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.block = self if tag in BLOCK_TAGS or not parent else parent.block
        self.good, self.bad, self.hint, self.form, self.silent, self.link = (parent.good, parent.bad, parent.hint, parent.form, parent.silent, parent.link) if parent else (False,) * 6
        if tag in SILENT_TAGS:
            self.silent = True
        elif tag in ("article", "main"):
            self.good, self.form = True, False
        elif tag in BAD_TAGS or (tag == "header" and not self.good):
            self.bad = True
        elif tag == "form":
            self.form = True
        elif tag == "noscript":
            self.hint = True
        elif tag == "a":
            self.link = True
        if attrs and tag not in ("html", "body"):
            self._read(attrs)

    def _read(self, attrs: str) -> None:
        for m in _ATTR.finditer(attrs):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
                self.silent = True
            elif name in ("class", "id", "role"):
                for word in value.split():
                    parts = [p.lower() for p in _PART.findall(word)]
                    said = [p for i, p in enumerate(parts) if p in BAD_WORDS and not (i and parts[i - 1] in NEGATED)]
                    if said and not (self.tag == "article" and len(parts) > 1 and parts[0] in GOOD_WORDS):
                        if all(p in BAD_WORDS or p in LAYOUT_WORDS or p in GOOD_WORDS for p in parts):
                            self.bad = True
                        else:
                            self.hint = True
                    elif any(p in GOOD_WORDS for p in parts):
                        self.good = True


class Block:
    __slots__ = ("text", "node", "linked", "at", "pages")

    def __init__(self, text: str, node: Node, linked: int, at: int):
        self.text, self.node, self.linked, self.at, self.pages = text, node, linked, at, 1


class _Open:
    """The stack of open elements, which knows where the last one of each tag stands."""

    def __init__(self):
        self.stack = [Node("#", "", None)]
        self.places: dict[str, list[int]] = {}

    @property
    def top(self) -> Node:
        return self.stack[-1]

    def push(self, tag: str, attrs: str) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append(Node(tag, attrs, self.stack[-1]))

    def _last(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def close(self, tags, within=()) -> None:
        """Close the innermost element of ``tags`` and what is open in it, unless one of ``within`` is in between."""
        at = self._last(tags)
        if at and at > self._last(within):
            while len(self.stack) > at:
                self.places[self.stack.pop().tag].pop()


def _markup(page: str):
    """Start and end of each piece of markup, with its match if it is a tag. Every character is read a bounded number of times.

    A quote that is never closed ends at the next ``>``, and what is cut off ends with the page.
    """
    at, n = 0, len(page)
    while m := _OPENS.search(page, at):
        start = m.start()
        tag = None
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            end = n if end < 0 else end + 3
        elif page[start + 1] in "!?":
            end = page.find(">", start) + 1 or n
        else:
            tag = _TAG.match(page, start)
            if tag:
                end = tag.end()
            else:
                end = page.find(">", start) + 1 or n
                tag = _TAG.match(re.sub("[\"']", " ", page[start:end]))
        at = yield start, end, tag
        at = end if at is None else at


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page, in page order."""
    opened, out, parts, at = _Open(), [], [], 0
    linked = 0

    def flush():
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, opened.top.block, linked, at))
            parts, linked = [], 0

    def add(raw: str):
        nonlocal linked
        if raw and not opened.top.silent:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if opened.top.link:
                linked += len(text)

    pieces, skip = _markup(page), None
    while True:
        try:
            start, end, m = pieces.send(skip)
        except StopIteration:
            break
        skip = None
        add(page[at:start])
        at = end
        if m is None:
            continue
        tag = m[2].lower()
        if tag == "br":
            parts.append(" ")
            continue
        block = tag in BLOCK_TAGS
        if block:
            flush()
        if m[1]:
            opened.close((tag,), ("table",) if tag in ("p", "li") else ())
            continue
        if tag == "body":
            opened.close(("head",))
        if block:
            if opened.top.tag == "head":
                opened.close(("head",))
            opened.close(("p",), ("table", "li", "td", "div", "article", "section", "aside", "blockquote"))
        if tag in SAME:
            opened.close(SAME[tag], ("ul", "ol", "dl", "table"))
        if tag in _END:
            at = skip = _END[tag].search(page, at).end()
            continue
        if tag not in VOID_TAGS and not m[3].endswith("/"):
            opened.push(tag, m[3])
    add(page[at:])
    flush()
    return out


#: What ``features`` says, in order; the last four come from the markup's words.
FEATURES = ("constant", "length", "linked", "sentence", "title", "commas", "capitals", "odd", "again", "good", "bad", "form", "hint")
MARKUP = 4


def again(b: Block) -> float:
    """How much a host repeats a block. What markup calls the article's, without a doubt, may be on many pages: articles quote and copy."""
    return 0.0 if b.node.good and not b.node.hint else min(math.log2(b.pages), 3.0)


def features(b: Block) -> tuple[float, ...]:
    """Figures of a block's text and place, and what the markup around it says."""
    node, text, words = b.node, b.text, b.text.count(" ") + 1
    sentence = text[-1] in ".!?…。" or (words > 8 and ". " in text)
    capitals = sum(w[0].isupper() for w in text.split(" ")) / words
    odd = sum(map(text.count, "©|»›•#@")) / words
    return (
        1.0, min(words, 40) / 40, b.linked / len(text), float(sentence), float(node.tag == "h1"),
        min(text.count(",") / words, 0.5), capitals, min(odd, 1.0), again(b), float(node.good), float(node.bad), float(node.form), float(node.hint),
    )


def log_odds(b: Block, weights: tuple[float, ...] = PLAIN) -> float:
    return sum(w * f for w, f in zip(weights, features(b)))


#: Words from which on a block tells by itself whether other pages have it too, and how many such pages tell.
TELLING, PAGES = 3, 3
#: How often a block of many pages is shown to the classifier, so that a site's own lines don't outweigh the articles.
SHOWN = 8


def telling(blocks: list[Block]) -> list[Block]:
    """Blocks that tell by themselves whether other pages have them too."""
    return [b for b in blocks if b.text.count(" ") + 1 >= TELLING]


def main_part(blocks: list[Block]) -> str:
    """What pages are told apart by: copies of a page are one."""
    return max((b.text for b in blocks), key=len, default="")


def labelled(pages: list[list[Block]]) -> tuple[list[tuple[float, ...]], list[float]]:
    """Features and labels of the blocks that are known to be content or not.

    Outside articles, what stands on several unlike pages of its host is the site's; of the
    rest, blocks in articles are content, those in menus, forms and the like aren't.
    """
    rows, labels, shown = [], [], Counter()
    for blocks in pages:
        for b in blocks:
            site = b.pages >= PAGES and again(b) > 0
            if site and shown[b.text] == SHOWN:
                continue
            shown[b.text] += 1
            if site or b.node.good or b.node.bad or b.node.form:
                rows.append(features(b))
                labels.append(float(b.node.good and not site and not b.node.bad and not b.node.form))
    return rows, labels


def counted(pages: list[str]) -> list[list[Block]]:
    """Blocks of pages that are all there are of one host, with their counts."""
    found, on = [blocks_of(page or "") for page in pages], {}
    for blocks in found:
        for b in telling(blocks):
            on.setdefault(b.text, set()).add(main_part(blocks))
    for blocks in found:
        for b in telling(blocks):
            b.pages = len(on[b.text])
    return found


def fit(pages: list[list[Block]], steps: int = 400, rate: float = 0.1, decay: float = 1e-3) -> tuple[float, ...]:
    """Weights by logistic regression on the blocks of known kind (``labelled``).

    Every such block is shown twice, once without what the markup's words say, so that the text's
    own features are learned for pages that say nothing. Pages that tell no two kinds give ``PLAIN``.
    """
    rows, labels = labelled(pages)
    if len(set(labels)) < 2:
        return PLAIN
    x, y = np.array(rows), np.array(labels)
    hidden = x * np.array([1.0] * (len(FEATURES) - MARKUP) + [0.0] * MARKUP)
    x, y = np.concatenate([x, hidden]), np.concatenate([y, y])
    w, m, s = np.array(PLAIN), np.zeros(len(PLAIN)), np.zeros(len(PLAIN))
    for t in range(1, steps + 1):
        g = x.T @ (1 / (1 + np.exp(-np.clip(x @ w, -30, 30))) - y) / len(y) + decay * (w - np.array(PLAIN))
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-6)
    return tuple(w.tolist())


def _distance(a: Node, b: Node) -> int:
    """Elements between two nodes of the tree."""
    n = 0
    while a is not b:
        n += 1
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
    return n


def smoothness(blocks: list[Block]) -> list[tuple[int, int, float]]:
    edges, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, S_NEXT / (1 + _distance(blocks[i - 1].node, b.node))))
        above = id(b.node.parent)
        if above in last:
            edges.append((last[above], i, S_PARENT))
        last[above] = i
    return edges


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stand on the source's side of a minimum cut (the largest such side)."""
    n = len(odds)
    own = list(odds)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    side: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:  # settle what its edges can't move, and pass its pull on to its neighbours
        i = todo.popleft()
        if side[i] is None and abs(own[i]) > sum(near[i].values()):
            side[i] = own[i] > 0
            for j, w in near[i].items():
                del near[j][i]
                own[j] += w if side[i] else -w
                todo.append(j)
            near[i] = {}
    rest = [i for i in range(n) if side[i] is None]
    if rest:
        for i in _max_flow_side(rest, own, near):
            side[i] = True
    return [bool(s) for s in side]


def _max_flow_side(rest, own, near) -> list[int]:
    """Flow by levels (Dinic); afterwards all that can't reach the sink is on the source's side."""
    s, t = -1, -2
    cap: dict[int, dict[int, float]] = {i: dict(near[i]) for i in rest}
    cap[s], cap[t] = {}, {}
    for i in rest:
        if own[i] > 0:
            cap[s][i], cap[i][s] = own[i], 0.0
        elif own[i] < 0:
            cap[i][t], cap[t][i] = -own[i], 0.0
    while True:
        level, queue = {s: 0}, deque([s])
        while queue:
            a = queue.popleft()
            for b, c in cap[a].items():
                if c > 1e-12 and b not in level:
                    level[b] = level[a] + 1
                    queue.append(b)
        if t not in level:
            break
        ahead = {a: [b for b, c in cap[a].items() if c > 1e-12 and level.get(b, 0) == level[a] + 1] for a in level}
        path = [s]
        while path:
            a = path[-1]
            if a == t:
                flow = min(cap[x][y] for x, y in zip(path, path[1:]))
                keep = len(path)
                for k in range(len(path) - 2, -1, -1):
                    x, y = path[k], path[k + 1]
                    cap[x][y] -= flow
                    cap[y][x] = cap[y].get(x, 0.0) + flow
                    if cap[x][y] <= 1e-12:
                        keep = k + 1
                del path[keep:]
                continue
            while ahead[a] and cap[a][ahead[a][-1]] <= 1e-12:
                ahead[a].pop()
            if ahead[a]:
                path.append(ahead[a][-1])
            else:
                path.pop()
                if path:
                    ahead[path[-1]].pop()
    reach, queue = {t}, deque([t])
    while queue:
        b = queue.popleft()
        for a in cap[b]:
            if a not in reach and cap[a].get(b, 0.0) > 1e-12:
                reach.add(a)
                queue.append(a)
    return [i for i in rest if i not in reach]


def chosen(blocks: list[Block], weights: tuple[float, ...]) -> str:
    if not blocks:
        return ""
    content = minimum_cut([log_odds(b, weights) for b in blocks], smoothness(blocks))
    return "\n".join(b.text for b, c in zip(blocks, content) if c)


def main_text(page: str | None, weights: tuple[float, ...] = PLAIN) -> str:
    """Of a page by itself, without its site's."""
    return chosen(blocks_of(page), weights) if page else ""


def _key(host: int, text: str) -> int:
    """A block of a host as a signed 64-bit number."""
    return xxhash.xxh3_64_intdigest(b"%d " % host + text.encode()) - 2**63


def _host(url: Column) -> Column:
    return F.xxhash64(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][^:/?#]*://([^/?#]*)", 1)))


def repeated_blocks(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(page, key, n of each block that stands on several unlike pages of its host, as key and n) from rows page, host, html."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for page, host, text in zip(*(batch.column(c).to_pylist() for c in ("page", "host", "html"))):
                blocks = blocks_of(text or "")
                main = xxhash.xxh3_64_intdigest(main_part(blocks).encode()) - 2**63
                out += {(page, _key(host, b.text), main) for b in telling(blocks)}
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], names=["page", "key", "main"])

        return step

    found = scratch.save(map_batches(rows, make, "page long, key long, main long"), "blocks")
    counts = found.select("key", "main").distinct().groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return found.select("page", "key").distinct(), scratch.save(counts, "repeated")


def training_blocks(rows: DataFrame, counts: DataFrame) -> list[list[Block]]:
    """The bounded sample of pages as blocks with their counts; a threshold leaves about twice as many rows to sort."""
    spark = rows.sparkSession
    some = rows.where(F.length("html") > 0)
    u = F.shiftrightunsigned(F.xxhash64("page", F.lit(31)), 11) / F.lit(float(2**53))
    held = some.where(u < 2 * TRAIN_PAGES / max(1, some.count())).select("host", "html", "page").orderBy(F.xxhash64("page", F.lit(31)), "html").limit(TRAIN_PAGES).collect()
    pages = [(r.host, blocks_of(r.html)) for r in held]
    keys = {_key(host, b.text) for host, blocks in pages for b in telling(blocks)}
    wanted = spark.createDataFrame([(k,) for k in keys], "key long")
    n = {r.key: r.n for r in counts.join(wanted, "key").collect()}  # blocks of the sample
    for host, blocks in pages:
        for b in telling(blocks):
            b.pages = n.get(_key(host, b.text), 1)
    return [blocks for _, blocks in pages]


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", weights: tuple[float, ...] | None = None) -> DataFrame:
    """Rows page_id, url, text, n_chars; without ``weights`` they are fitted to a sample of the pages."""
    spark, scratch = pages.sparkSession, Scratch(pages.sparkSession, "pages")
    url, body = pages[url_col], pages[html_col]
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), url.alias("url"), _host(url).alias("host"), F.xxhash64(url, body).alias("page"), body.alias("html"))
    on_pages, counts = repeated_blocks(rows.select("page", "host", "html"), scratch)
    weights = weights or fit(training_blocks(rows, counts))
    known = None
    if rows_of(counts) <= REPEATS:
        table = counts.orderBy("key").toArrow()
        known = spark.sparkContext.broadcast((table["key"].to_numpy(), table["n"].to_numpy()))
        rows = rows.withColumn("repeats", F.lit(None).cast("map<bigint,bigint>"))
    else:
        own = on_pages.join(counts, "key").groupBy("page").agg(F.map_from_entries(F.collect_list(F.struct("key", "n"))).alias("repeats"))
        rows = rows.join(own, "page", "left")

    def make():
        keys, times = known.value if known else (None, None)

        def pages_of(key: int, repeats: dict) -> int:
            if keys is None:
                return repeats.get(key, 1)
            i = int(np.searchsorted(keys, key))
            return int(times[i]) if i < len(keys) and keys[i] == key else 1

        def one(host: int, page: str | None, repeats) -> str:
            blocks, of = blocks_of(page or ""), dict(repeats or ())
            for b in telling(blocks):
                b.pages = pages_of(_key(host, b.text), of)
            return chosen(blocks, weights)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [one(*x) for x in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "repeats")))]
            return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

        return step

    return map_batches(rows.select("page_id", "url", "host", "html", "repeats"), make, "page_id long, url string, text string, n_chars long")
