"""Main text of web pages by site style trees.

The pages of a host are merged into one tree.  A node is a place: the path from the root, where each step names the
presentation of the parent (its children's tags and classes, runs of equal ones taken as one) and the child's
place in it.  A node's presentation importance is the entropy of the presentations that pages have there, its content
importance that of the texts that stand there, both over the logarithm of their number: 1 where every page differs, 0 where
all agree, and 1 where fewer than ``SUPPORT`` were seen.  A branch is removed from a page if nothing in it, neither itself
nor any node below, reaches ``LEAST``.  Equal pages of a host count once, so copies of an article do not make it noise.

Entropy cannot tell menus whose entries change from page to page, nor anything on a host with few pages; there the
markup is the prior: elements, roles and class words that name page furniture (``FURNITURE``, ``ROLES``, ``HINTS``) have importance 0, lists of links
outside the article too, and text blocks inside ``article`` or ``main`` are never removed.  A page whose ``article`` or ``main`` holds a fair part
(``SHARE``) of its remaining text is that part alone.

The tree is never gathered: nodes are 64-bit hashes of host and path, counted by two aggregations with partial sums.  Each
page is parsed once, into runs of text and the hashes of their nodes; the low nodes come back to it by the set of its nodes
(its template), of which a site has few.

Defined cases: null html is empty; a page without text has an empty one; a page without a host in its url (or without
url) takes no part in any tree and keeps what the prior keeps; repeated rows and ids are pages of their own; unclosed and misplaced tags are mended as
browsers do for paragraphs, lists and tables; a tag that the text breaks off is markup; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
import struct
from itertools import groupby

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import by_batch, stored

SUPPORT, LEAST, SHARE = 8, 0.2, 0.3
LINKS, LINK_SHARE = 3, 0.8   # a list of links has at least so many, which hold so much of its characters

# Elements, roles and class words by what they say about a branch.
UNREAD = {"script", "style", "title", "textarea", "iframe", "noembed", "noframes", "xmp"}
HIDDEN = {"head", "noscript", "template", "svg", "math", "canvas", "object", "audio", "video", "select", "button", "datalist", "map", "dialog"} | UNREAD
FURNITURE = {"nav", "footer", "aside", "menu", "form", "header"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar", "tablist"}
HINTS = {"nav", "navbar", "navigation", "menu", "menubar", "topbar", "footer", "header", "masthead", "banner", "ad", "ads", "promo", "promotion", "consent", "gdpr",
         "notice", "notification", "alert", "popup", "modal", "overlay", "toolbar", "signup", "login", "share", "sharing", "social", "related", "recommended",
         "recommendations", "disqus", "respond", "replies", "reply", "pagination", "pager", "copyright", "skip", "outbrain", "taboola"}
BEGINNINGS = ("comment", "advert", "breadcrumb", "cookie", "sponsor", "subscri", "sidebar", "newsletter")
BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption",
          "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol",
          "optgroup", "option", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
TEXT_BLOCKS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "li", "dd", "dt", "td", "th", "caption", "figcaption", "summary"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# An element that a start tag closes, and the elements beyond which it does not look.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot"}, {"table"})}
P_SCOPE = {"table", "td", "th", "caption", "button", "body", "html"}

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>(?:"[^"<]*"|'[^'<]*'|[^"'>])*)>|[^>]*(?:>|\Z))""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))|([^\s=/>"']+)""")
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
DIGITS = re.compile(r"\d+")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
HOST = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
CONTENT = 0x9E3779B97F4A7C15
PARSED = ("page_id long, url string, template long, keys array<long>, features array<long>, parents array<int>, shapes array<long>, said array<long>,"
          " run_blocks array<int>, run_nodes array<int>, run_texts array<string>")


class Page:
    """Elements in document order (a parent before its children) and runs of text."""

    def __init__(self, source: str):
        self.tags, self.parents, self.attributes = ["#root"], [-1], [{}]
        self.runs: list[tuple[int, int, str]] = []   # block, element, text
        self.read(source)

    def read(self, source: str) -> None:
        stack, block, at = [0], 0, 0

        def say(raw: str) -> None:
            if raw:
                self.runs.append((block, stack[-1], html.unescape(raw) if "&" in raw else raw))

        def pop_to(names: set, scope: set) -> None:
            for depth in range(len(stack) - 1, 0, -1):
                tag = self.tags[stack[depth]]
                if tag in names:
                    del stack[depth:]
                    return
                if tag in scope:
                    return

        while True:
            token = TOKEN.search(source, at)
            if token is None:
                say(source[at:])
                return
            say(source[at: token.start()])
            at = token.end()
            if token[2] is None:
                continue
            tag = token[2].lower()
            is_block = tag in BLOCKS
            block += is_block
            if token[1]:
                self.close(tag, is_block, stack)
            elif tag == "br":
                self.runs.append((block, stack[-1], " "))
            elif tag not in ("hr", "wbr"):
                if is_block:
                    pop_to({"p"}, P_SCOPE)
                if tag in CLOSES:
                    pop_to(*CLOSES[tag])
                self.tags.append(tag)
                self.parents.append(stack[-1])
                rest = token[3]
                self.attributes.append({(m[1] or m[5]).lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(rest.rstrip(">"))} if len(rest) > 2 else {})
                if tag in UNREAD:
                    end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
                    at = end.end() if end else len(source)
                elif tag not in VOID:
                    stack.append(len(self.tags) - 1)

    def close(self, tag: str, is_block: bool, stack: list[int]) -> None:
        """An end tag closes the nearest such element, but an inline one closes no block on its way."""
        for depth in range(len(stack) - 1, 0, -1):
            own = self.tags[stack[depth]]
            if own == tag:
                del stack[depth:]
                return
            if not is_block and own in BLOCKS or is_block and own in ("td", "th", "table") and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html"):
                return


def words_of(attributes: dict) -> list[str]:
    return [w.lower() for w in WORD.findall(f"{attributes.get('class', '')} {attributes.get('id', '')}")]


def is_named(attributes: dict) -> bool:
    """Whether role, class or id names a part of the page that is not its article."""
    return (attributes.get("role", "").lower() in ROLES
            or any(w in HINTS or w.startswith(BEGINNINGS) for w in words_of(attributes)))


def is_comment(attributes: dict) -> bool:
    return any(w.startswith("comment") or w in ("reply", "replies") for w in words_of(attributes))


def priors(page: Page) -> tuple[list[bool], list[bool]]:
    """By element: is it noise by its markup, does it lie in the article."""
    tags, parents, attributes = page.tags, page.parents, page.attributes
    size = len(tags)
    core = [t == "main" or a.get("role", "").lower() == "main" or t == "article" and not is_comment(a) for t, a in zip(tags, attributes)]
    holds, titled = core[:], [t == "h1" for t in tags]
    chars, linked, links = [0] * size, [0] * size, [int(t == "a") for t in tags]
    for _, node, text in page.runs:
        chars[node] += len("".join(text.split()))
    for node in range(size - 1, 0, -1):
        up = parents[node]
        if tags[node] == "a":
            linked[node] = chars[node]
        holds[up] |= holds[node]
        titled[up] |= titled[node]
        chars[up] += chars[node]
        linked[up] += linked[node]
        links[up] += links[node]
    noise, inside = [False] * size, [False] * size
    for node in range(1, size):
        tag, own, up = tags[node], attributes[node], parents[node]
        inside[node] = inside[up] or core[node]
        if noise[up] or tag in HIDDEN or "hidden" in own or own.get("aria-hidden", "").lower() == "true" or UNSEEN.search(own.get("style", "")):
            noise[node] = True
        elif tag in ("html", "body") or core[node]:
            continue
        elif tag in FURNITURE or is_named(own):
            wraps = holds[node] or tag == "form" and titled[node]
            is_title = inside[up] and (tag == "header" or titled[node] and tag not in FURNITURE)
            noise[node] = not wraps and not is_title
        elif tag in ("ul", "ol", "div", "table", "p", "section", "dl") and not inside[node] and not holds[node]:
            noise[node] = links[node] >= LINKS and linked[node] >= LINK_SHARE * chars[node]
    return noise, inside


def hashed(*values: int) -> int:
    return xxhash.xxh64_intdigest(struct.pack(f"<{len(values)}Q", *values))


def signed(values: list[int]) -> list[int]:
    return [v - (1 << 64) if v >> 63 else v for v in values]


def style_nodes(page: Page, noise: list[bool], host: str, told: dict[int, str]) -> tuple[list[int], list[int], list[int], list[int]]:
    """By element: the hashes of its presentation node, its presentation, its content node and its text; 0 where it has none."""
    size = len(page.tags)
    children: list[list[int]] = [[] for _ in range(size)]
    for node in range(1, size):
        if not noise[node]:
            children[page.parents[node]].append(node)
    places, shapes, styles, said, contents = ([0] * size for _ in range(5))
    places[0] = xxhash.xxh64_intdigest(host)
    label = lambda n: page.tags[n] + "." + DIGITS.sub("0", page.attributes[n].get("class", ""))
    for node in range(size):
        if noise[node]:
            continue
        if children[node]:
            runs = [(name, list(members)) for name, members in groupby(children[node], label)]
            shapes[node], styles[node] = places[node], xxhash.xxh64_intdigest("|".join(name for name, _ in runs))
            for at, (_, members) in enumerate(runs):
                place = hashed(places[node], styles[node], at)
                for child in members:
                    places[child] = place
        if node in told:
            said[node], contents[node] = places[node] ^ CONTENT, xxhash.xxh64_intdigest(DIGITS.sub("0", told[node]))
    return shapes, styles, said, contents


def parsed_page(source: str, host: str | None) -> tuple:
    """What is kept of one page: its nodes for the tree of its host, and runs of text with the element they depend on (-1: on none)."""
    page = Page(source)
    noise, inside = priors(page)
    size = lambda some: sum(len(t.strip()) for _, n, t in page.runs if some(n))
    within = size(lambda n: inside[n] and not noise[n])
    if within and within >= SHARE * size(lambda n: not noise[n]):
        dropped = [n or not i for n, i in zip(noise, inside)]
    else:
        dropped = noise
    runs = [r for r in page.runs if not dropped[r[1]]]
    if not host:
        return (0, [], [], [], [], [], [b for b, *_ in runs], [-1] * len(runs), [t for *_, t in runs])
    held = [False] * len(page.tags)
    for node in range(1, len(held)):
        held[node] = held[page.parents[node]] or inside[node] and page.tags[node] in TEXT_BLOCKS
    told: dict[int, str] = {}
    for _, node, text in runs:
        if not held[node] and text.strip():
            told[node] = told.get(node, "") + " ".join(text.split())
    shapes, styles, said, contents = style_nodes(page, noise, host, told)
    places = sorted({n for n in range(len(held)) if not held[n] and (shapes[n] or said[n])})
    keys = [k for n in places for k in (shapes[n], said[n]) if k]
    features = [f for n in places for k, f in ((shapes[n], styles[n]), (said[n], contents[n])) if k]
    nodes = [-1 if held[n] else n for _, n, _ in runs]
    tree = max(nodes, default=-1) >= 0   # the tree of a page whose text is all held decides nothing
    return (hashed(*keys), signed(keys), signed(features), page.parents if tree else [],
            signed([0 if h else s for s, h in zip(shapes, held)]) if tree else [], signed(said) if tree else [],
            [b for b, *_ in runs], nodes, [t for *_, t in runs])


def parsed(pages: DataFrame) -> DataFrame:
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), HOST, 1)).alias("host"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    fields = [f.split(" ") for f in PARSED.split(", ")]
    inner = {"array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [parsed_page(source, host) for host, source in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        template = pa.array([m[0] - (1 << 64) if m[0] >> 63 else m[0] for m in made], pa.int64())
        columns = [pa.array([m[at] for m in made], inner[kind]) for at, (_, kind) in enumerate(fields[3:], 1)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), template, *columns], names=[n for n, _ in fields])

    return by_batch(rows, PARSED, work)


def low_nodes(pages: DataFrame) -> DataFrame:
    """``low``: nodes whose importance stays below the threshold; pages with the same nodes and features count once."""
    own = pages.select("template", "keys", "features").where(F.size("keys") > 0)
    once = own.groupBy("template", F.xxhash64("features").alias("content")).agg(F.first("keys").alias("keys"), F.first("features").alias("features"))
    rows = once.select(F.explode(F.arrays_zip("keys", "features")).alias("x")).select("x.keys", "x.features")
    counts = rows.groupBy("keys", "features").agg(F.count("*").alias("n"))
    nodes = counts.groupBy("keys").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("weighted")).where(F.col("m") >= SUPPORT)
    entropy = F.log("m") - F.col("weighted") / F.col("m")
    return nodes.where(entropy / F.log("m") < LEAST).select(F.col("keys").alias("low"))


def low_by_template(pages: DataFrame) -> DataFrame:
    """``of_template, lows``: the low nodes of each set of nodes."""
    templates = pages.where(F.size("parents") > 0).groupBy(F.col("template").alias("of_template")).agg(F.first("keys").alias("keys"))
    rows = templates.select("of_template", F.explode(F.array_distinct("keys")).alias("key"))
    return rows.join(low_nodes(pages), F.col("key") == F.col("low")).groupBy("of_template").agg(F.collect_list("low").alias("lows"))


def written(lows: list[int] | None, parents: list[int], shapes: list[int], said: list[int], blocks: list[int], nodes: list[int], texts: list[str]) -> str:
    """The page's text without branches that are low throughout."""
    low = set(lows or ())
    alone = [(not s or s in low) and (not t or t in low) for s, t in zip(shapes, said)]
    for node in range(len(alone) - 1, 0, -1):
        if not alone[node]:
            alone[parents[node]] = False
    kept = ((b, t) for b, n, t in zip(blocks, nodes, texts) if n < 0 or not alone[n])
    lines = (" ".join("".join(t for _, t in runs).split()) for _, runs in groupby(kept, lambda r: r[0]))
    return "\n".join(line for line in lines if line)


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    rows = stored(parsed(pages), "pages-parsed")
    lows = stored(low_by_template(rows), "pages-low")
    rest = ["parents", "shapes", "said", "run_blocks", "run_nodes", "run_texts"]
    none = rows.where(F.size("parents") == 0).select("page_id", "url", F.lit(None).cast("array<long>").alias("lows"), *rest)
    some = rows.where(F.size("parents") > 0).join(lows, F.col("template") == F.col("of_template"), "left")
    joined = none.unionByName(some.select("page_id", "url", "lows", *rest))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [written(*row) for row in zip(*[batch.column(c).to_pylist() for c in range(2, 9)])]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])

    return by_batch(joined, "page_id long, url string, text string, n_chars long", work)
