"""Main text of web pages by a site style tree (operator 4).

Method: the DOMs of one host are merged by the style of their nodes (path of tag names and classes). For every merged
node two things are measured over the pages that have it: presentation importance, the entropy of the child sequences
found there (a template repeats one; articles vary), and content importance, one minus the mean entropy of the texts
below it over pages (a notice stands on every page; an article on one). A node whose composite importance is low, and
whose texts repeat, is noise, and its branch is removed from each page of the host. Elements that say what they are
(navigation, forms, adverts, comments ...) are noise whatever their importance, but a name on a paragraph or a heading
inside an article says nothing yet (`<p class="promotion">He got his promotion</p>`): that is judged by the tree.

An element that is marked as the article is evidence, not a verdict: importance inside it is raised, and what counts
there is not how many pages a text is on but beside how many different texts it stands. A site may publish one article
at many addresses, and copies have the same siblings; a notice has different ones in each article. Texts inside an
article are also judged one by one, as a notice may be a paragraph like the others.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latticeframe.llm.common import cut, map_rows, stored

# HTML element names by behaviour, and names that pages give to parts that aren't the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
CLOSES_P = BLOCK - {"body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "summary"}
NEVER = frozenset(
    "nav aside footer form script style noscript template iframe object embed svg canvas audio video button select option "
    "input textarea label fieldset dialog menu head title map".split()
)
NAMES = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice pagination pager "
    "popup promo promotion search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar "
    "widget".split()
)
#: Words that may stand behind one of the names in a class or id without changing what it says
LAYOUT = frozenset(
    "area bar block body bottom box button buttons container content footer form global header holder icon icons inner "
    "item items left link links list main outer page panel primary right secondary section site slot top unit wrap wrapper".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
IMPLIED_END = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

#: Elements that hold a text of their own: a name on one of them inside an article is left to the tree
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
#: Weight of content against presentation falls with the number of children, as in site style trees
DECAY = 0.9
#: Less composite importance than this is noise
NOISE = 0.35
#: Share of the way to full importance by which standing in an article raises a node
ARTICLE = 0.2
#: Hosts and nodes seen on fewer pages aren't judged
LEAST_PAGES = 8
BROADCAST_NOISE = 200_000

_tag = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*'|"(?![^"]*")|'(?![^']*'))*)(?:>|\Z))""", re.DOTALL)
_attr = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.IGNORECASE)
_name = re.compile(r"[a-z]+")


class Node:
    """An element. `key` is a hash of its style and its parent's key, and so of its path, whatever the depth."""

    __slots__ = ("tag", "key", "up", "never", "article", "children")

    def __init__(self, tag: str, style: str, up: Node | None, never: bool):
        self.tag, self.up = tag, up
        self.key = _key(str(up.key), style) if up else 0
        self.never = never or bool(up and up.never)
        self.article = (up and up.article) or (self if tag in ("article", "main") and not self.never else None)
        self.children: list[str] = []


def _says(value: str) -> bool:
    """Whether a class or an id names a part that isn't the article: its last word but for words of layout is a name."""
    for token in value.split():
        words = _name.findall(token)
        while len(words) > 1 and words[-1] in LAYOUT:
            words.pop()
        if words and words[-1] in NAMES:
            return True
    return False


def _judge(tag: str, attrs: str, inside: bool) -> tuple[str, bool]:
    """(style of an element, whether it is never part of an article)."""
    if tag in NEVER or (tag == "header" and not inside):
        return tag, True
    if not attrs.strip():
        return tag, False
    style, never = tag, False
    named = tag not in ("html", "body", "article", "main") and not (inside and tag in TEXTUAL)
    for m in _attr.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id"):
            style += ("." if name == "class" else "#") + value
            never |= named and _says(value)
            never |= tag == "article" and "comment" in value
        elif name == "role":
            never |= value in ROLES
        elif name == "hidden":
            never = True
        elif value == "true":
            never = True
    return style, never


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str]]]:
    """All elements of a page, and its blocks of text in order with the element that each stands in."""
    root = Node("", "", None, False)
    nodes, blocks, stack = [], [], [root]
    open_tags: Counter[str] = Counter()  # so that a search of the stack only begins where it succeeds
    parts: list[str] = []
    at = 0

    def flush(owner: Node) -> None:
        if parts:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            parts.clear()
            if text:
                blocks.append((owner, text))

    def close(k: int) -> None:
        """Close stack[k] and all that is open inside."""
        if any(x.tag in BLOCK for x in stack[k:]):
            flush(stack[-1])
        open_tags.subtract(x.tag for x in stack[k:])
        del stack[k:]

    def innermost(tag: str) -> int:
        return next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag) if open_tags[tag] else 0

    n = len(page)
    while at < n:
        m = _tag.search(page, at)
        if m is None:
            if not stack[-1].never:
                parts.append(page[at:])
            break
        if m.start() > at and not stack[-1].never:
            parts.append(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if k := innermost(tag):
                close(k)
            continue
        if tag in CLOSES_P:
            if k := innermost("p"):
                close(k)
        if tag in IMPLIED_END and any(open_tags[x] for x in IMPLIED_END[tag]):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in IMPLIED_END[tag]:
                    close(i)
                    break
                if stack[i].tag in ("ul", "ol", "dl", "table", "tbody", "select", "menu"):
                    break
        up = stack[-1]
        style, never = _judge(tag, m[3], up.article is not None)
        if tag in BLOCK:
            flush(up)
        elif tag == "br" and not up.never:
            parts.append(" ")
        up.children.append(style)
        if tag in VOID:
            continue
        node = Node(tag, style, up, never)
        nodes.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else n
            continue
        if m[3].endswith("/"):
            continue
        stack.append(node)
        open_tags[tag] += 1
    flush(stack[-1])
    return nodes, blocks


def _key(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def host_of(url: Column) -> Column:
    """Lower-cased host of a url, user names removed; empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"//(?:[^/?#\s]*@)?([^/?#\s]*)", 1)), F.lit(""))


def _facts(page: str) -> list[tuple[int, int, int, int, bool, int | None]]:
    """(node, kind, feature, children, own, beside): kind 0 is a child sequence of a node, 1 a text below it.

    `own` is a text that stands in the node itself, `beside` what an article holds besides the text: its longest other
    text, and its two longest ones for a child sequence. It is None outside of articles.
    """
    nodes, blocks = parse(page)
    texts: dict[Node, set[str]] = {}
    for owner, text in blocks:
        if owner.article:
            texts.setdefault(owner.article, set()).add(text)
    longest = {a: sorted(t, key=lambda x: (-len(x), x))[:2] for a, t in texts.items()}
    mark = {a: _key(*t) for a, t in longest.items()}
    out = {
        (x.key, 0, _key(*x.children), len(x.children), False, mark.get(x.article, 0) if x.article else None)
        for x in nodes
        if not x.never
    }
    for owner, text in blocks:
        feature, beside, node = _key(text), None, owner
        if owner.article:
            beside = _key(*[x for x in longest[owner.article] if x != text][:1])
        while node.up:
            out.add((node.key, 1, feature, 0, beside is not None and node is owner, beside))
            if node is owner.article:
                beside = None  # what stands around the article isn't inside it
            node = node.up
    return list(out)


def _seen(pages: DataFrame) -> DataFrame:
    """`host, node, kind, feature, c, children, own, inside`: on how many pages, or in how many articles, a feature is."""

    def make():
        def rows(hosts, htmls):
            return [(host, *x) for host, h in zip(hosts, htmls, strict=True) for x in _facts(h or "")]

        return rows

    facts = map_rows(
        pages.select(host_of(F.col("url").cast("string")), F.col("html").cast("string")),
        "host string, node long, kind int, feature long, children int, own boolean, beside long",
        make,
        chunk=64,
    )
    # A feature counts once a page, and once for equal surroundings in articles; partial sums make both small rows.
    key = ("host", "node", "kind", "feature")
    once = facts.groupBy(*key, "beside").agg(
        F.count(F.lit(1)).alias("n"), F.max("children").alias("children"), F.max("own").alias("own")
    )
    return once.groupBy(*key).agg(
        F.sum(F.when(F.col("beside").isNull(), F.col("n")).otherwise(1)).alias("c"),
        F.max("children").alias("children"),
        F.max("own").alias("own"),
        F.max(F.col("beside").isNotNull()).alias("inside"),
    )


def _raised(importance: Column) -> Column:
    return importance + ARTICLE * (1 - importance)


def style_tree(pages: DataFrame) -> DataFrame:
    """`host, node, pages, presentation, content, importance` of every merged node; in articles, `pages` are different ones."""
    return _tree(_seen(pages)).drop("inside")


def _tree(seen: DataFrame) -> DataFrame:
    own, text = F.col("kind") == 0, F.col("kind") == 1
    c = F.col("c")
    told = seen.groupBy("host", "node").agg(
        F.sum(F.when(own, c)).alias("pages"),
        F.sum(F.when(own, c * F.log(c))).alias("clogc"),
        F.sum(F.when(own, c * F.col("children"))).alias("children"),
        F.avg(F.when(text, F.log(c))).alias("spread"),
        F.max("inside").alias("inside"),
    )
    m = F.greatest(F.col("pages"), F.lit(2))
    # -sum p log_m p with p = c / pages, and 1 - mean log_m c
    presentation = F.coalesce((F.log(m) - F.col("clogc") / m) / F.log(m), F.lit(0.0))
    content = F.coalesce(1 - F.col("spread") / F.log(m), F.lit(0.0))
    raised = lambda x: F.when(F.col("inside"), _raised(x)).otherwise(x)
    keep = F.pow(F.lit(DECAY), F.col("children") / m)
    return told.filter("pages is not null").select(
        "host",
        "node",
        "pages",
        presentation.alias("presentation"),
        raised(content).alias("content"),
        raised((1 - keep) * presentation + keep * content).alias("importance"),
        "inside",
    )


def noise_of(pages: DataFrame) -> DataFrame:
    """`host, node`: noisy nodes of each host, and noisy texts inside articles as the node's key xor the text's."""
    seen = stored(_seen(pages), "style")
    told = _tree(seen).filter(F.col("pages") >= LEAST_PAGES)
    # One fixed sequence of children says nothing against a node whose texts differ.
    nodes = told.filter((F.col("importance") < NOISE) & (F.col("content") < NOISE)).select("host", "node")
    # _raised(1 - log_m c) < NOISE, which fewer than LEAST_PAGES ** power articles can't reach
    power = (1 - NOISE) / (1 - ARTICLE)
    often = seen.filter((F.col("kind") == 1) & F.col("own") & (F.log("c") > power * math.log(LEAST_PAGES)))
    texts = often.select("host", "node", "feature", "c").join(told.filter("inside").select("host", "node", "pages"), ["host", "node"])
    texts = texts.filter(F.log("c") > power * F.log("pages"))
    return nodes.unionByName(texts.select("host", F.col("node").bitwiseXOR(F.col("feature")).alias("node")))


def main_text(page: str, noise: frozenset[int] = frozenset()) -> str:
    """The blocks that stay, one line each."""
    nodes, blocks = parse(page)
    bad: set[Node] = set()
    for x in nodes if noise else ():  # parents come before their children
        if x.up in bad or (x.key in noise and x.tag not in ("html", "body")):
            bad.add(x)

    def noisy(owner: Node, text: str) -> bool:
        return owner in bad or (bool(noise) and owner.article is not None and owner.key ^ _key(text) in noise)

    return "\n".join(text for owner, text in blocks if not noisy(owner, text))


def extract(pages: DataFrame) -> DataFrame:
    """`page_id, url, text, n_chars` of every row of `pages`.

    Null html is empty and gives an empty text; a page without a url belongs to a nameless host; repeated rows and null
    or repeated ids stay rows of their own; extra columns are ignored; an empty table gives an empty one. Text is cut
    nowhere, and pages of any length and depth are parsed in one pass. A tag with a quote that is never closed ends at
    its first `>`, so no text is lost to it.
    """
    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    lists = noise_of(pages).groupBy("host").agg(F.collect_list("node").alias("noise")).withColumnRenamed("host", "__host")

    lists = cut(lists)
    small = lists.select(F.coalesce(F.sum(F.size("noise")), F.lit(0)).alias("n")).first()["n"] <= BROADCAST_NOISE
    hosted = pages.withColumn("__host", host_of(F.col("url")))
    rows = hosted.join(F.broadcast(lists) if small else lists, "__host", "left").select("page_id", "url", "html", "noise")

    def make():
        kept: dict[tuple, frozenset] = {}

        def rows_of(ids, urls, htmls, noises):
            out = []
            for i, u, h, x in zip(ids, urls, htmls, noises, strict=True):
                key = tuple(x or ())
                if key not in kept:
                    kept.clear() if len(kept) > 64 else None
                    kept[key] = frozenset(key)
                text = main_text(h or "", kept[key])
                out.append((i, u, text, len(text)))
            return out

        return rows_of

    return map_rows(rows, "page_id long, url string, text string, n_chars long", make, chunk=64)
