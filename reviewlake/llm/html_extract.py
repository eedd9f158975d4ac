"""Main text of web pages by consensus of a host's pages.

Each page is read into a light tree. Its containers are scored by the prose they hold; the best one votes with its path of
generalised tags and classes (digits and repeats fall away). Spark sums the votes by host and path. The path that wins on
a host is then used on all of that host's pages; a page without it, or with little at it against its own best container,
falls back to that container. All work on a page is linear in its length but for stray tags of lists and tables.
"""

from __future__ import annotations

import html as htmllib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.arrow_text import arrow_map
from reviewlake.session import checkpointed

# The HTML standard's elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
#: A start tag of the key ends an open element of these names, within the nearest of the scope.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"})}
CLOSES_P = BLOCKS - {"html", "body", "caption", "legend", "td", "th", "tr", "tbody", "thead", "tfoot"}
#: Never part of an article.
DROPPED = frozenset("script style noscript template nav header footer aside form iframe object embed svg canvas button select input textarea label fieldset menu dialog head title video audio map noembed noframes".split())
CONTAINERS = frozenset("article main section div td body blockquote".split())
#: Words of class, id and role that mark other things than the article.
MARKED = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead topbar footer foot sidebar side aside rail widget related recommended recommendations share sharing social cookie cookies consent notice notices alert popup modal overlay subscribe subscription newsletter signup login search comment comments respond reply replies disqus discussion feedback tags pagination pager copyright legal disclaimer toolbar contentinfo complementary hidden print skip gdpr paywall toc".split()
)
#: Before or behind a marked word of the same name, these say that the element itself is something else.
UNMARKED_BEHIND = frozenset("no not has have with without overflow before after".split())
UNMARKED_BEFORE = frozenset("open closed off none disabled enabled friendly".split())
#: Never dropped for a word.
WHOLE = frozenset("html body article main".split())
#: A container with this part of a page's prose is not dropped for a word, unless the word says that readers wrote it.
MOST = 0.75
READERS = frozenset("comment comments respond reply replies disqus discussion feedback".split())
#: The winning path is left for a page's own best container if it holds less than this part of that one's prose.
LEAST = 0.2
#: Quotes count only behind an equals sign; a stray one is part of a name.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)(?:>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "step", "dropped", "children", "parent", "marked")

    def __init__(self, tag, step, dropped, parent, marked=0):
        self.tag, self.step, self.dropped, self.parent, self.marked = tag, step, dropped, parent, marked
        self.children = []


def unescape(s: str) -> str:
    """Character references decoded; the frequent &amp; without a search for others."""
    if "&" not in s:
        return s
    return "&".join(htmllib.unescape(p) if "&" in p else p for p in s.split("&amp;"))


def _marks(name: str) -> int:
    """Whether a single class, id or role marks its element: 2 if as what readers wrote, 1 if as anything else."""
    found = WORD.findall(CAMEL.sub("-", name).lower())
    for i, w in enumerate(found):
        if w in MARKED and not UNMARKED_BEHIND.intersection(found[:i]) and not (i + 1 < len(found) and found[i + 1] in UNMARKED_BEFORE):
            return 2 if w in READERS else 1
    return 0


def _described(tag: str, attributes: str) -> tuple[str, int, bool]:
    """(path step, whether a word marks the element as no part of an article, whether it is hidden)."""
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return tag, 0, False
    words, marked, hidden = [], 0, False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), unescape(m[2] or m[3] or m[4] or "")
        if name in ("class", "id", "role"):
            found = WORD.findall(CAMEL.sub("-", value).lower())
            if any(w in MARKED for w in found):
                marked = max([marked, *map(_marks, value.split())])
            if name == "class":
                words += found
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            hidden = True
        elif name == "style":
            hidden |= "display:none" in value.replace(" ", "").lower()
    return tag + "".join("." + w for w in sorted(set(words))), marked, hidden


def _keep_most(root: Node) -> None:
    """Takes back the drop of elements that were marked but hold what the page is about.

    That is MOST of the page's prose outside links (for a form, MOST beside what nothing marks), or the article (or main)
    that has more prose than any other one. What a word marks as written by readers stays dropped.
    """
    prose: dict[int, int] = {}
    order, stack, top = [], [root], []
    while stack:
        node = stack.pop()
        order.append(node)
        prose[id(node)] = 0 if node.tag == "a" else sum(len(c) for c in node.children if isinstance(c, str) and not c.isspace())
        if node.tag != "a":
            stack.extend(c for c in node.children if not isinstance(c, str) and (not c.dropped or c.marked == 1))
    for node in reversed(order):
        if node is not root:
            prose[id(node.parent)] += prose[id(node)]
    stack = [root]
    while stack:
        node = stack.pop()
        if node.dropped:
            top.append(node)
        else:
            stack.extend(c for c in node.children if not isinstance(c, str) and id(c) in prose)
    plain = prose[id(root)] - sum(prose[id(node)] for node in top)
    articles = [node for node in order if node.tag in ("article", "main") and prose[id(node)] > 0]

    def free(node):
        while node is not root:
            if node.dropped:
                return False
            node = node.parent
        return True

    # With an article outside of all that is marked there is nothing to take back for its size.
    for node in [] if any(map(free, articles)) else order:
        n = prose[id(node)]
        if node.marked == 1 and n > 0 and (node.tag in CONTAINERS and n >= MOST * prose[id(root)] or node.tag == "form" and n >= MOST * (plain + n)):
            node.dropped = False
    if articles:
        node = max(articles, key=lambda x: prose[id(x)])
        while node is not root:
            node.dropped, node = node.dropped and node.marked != 1, node.parent


def parse(page: str, words: bool = True) -> Node:
    """A light tree: nodes and texts. Mends left-out end tags of p, li, dt, dd and table parts; a stray end tag is ignored.

    Without `words` no element is dropped for its class, id or role. The header of an article or main is part of it. A
    form is dropped, as an element that a word marks, unless it holds what the page is about.
    """
    root, some = Node("#root", "", False, None), False
    at, pos, lower = root, 0, None
    end = len(page)
    # How many elements of each name are open, so that no search for one goes up in vain.
    names: dict[str, int] = {}

    def close_to(node: Node) -> Node:
        up = at
        while up is not node:
            names[up.tag] -= 1
            up = up.parent
        return node

    while pos < end:
        m = TOKEN.search(page, pos)
        if m is None:
            at.children.append(page[pos:])
            break
        if m.start() > pos:
            at.children.append(page[pos : m.start()])
        pos = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if names.get(tag) and tag not in VOID:
                up = at
                while up.tag != tag:
                    # An inline end tag does not reach across a block.
                    if tag not in BLOCKS and tag not in DROPPED and up.tag in BLOCKS:
                        up = root
                        break
                    up = up.parent
                if up is not root:
                    at = close_to(up.parent)
            continue
        if tag in CLOSES_P and names.get("p"):
            up = at
            while up is not root and up.tag != "p" and up.tag not in BLOCKS:
                up = up.parent
            if up.tag == "p":
                at = close_to(up.parent)
        if tag in ENDS and any(names.get(x) for x in ENDS[tag][0]):
            ends, scope = ENDS[tag]
            up, ended = at, None
            while up is not root and up.tag not in scope:
                if up.tag in ends:
                    ended = up
                up = up.parent
            if ended is not None:
                at = close_to(ended.parent)
        step, marked, hidden = _described(tag, m[3])
        own_header = tag == "header" and (names.get("article") or names.get("main"))
        gone = hidden and tag not in ("html", "body") or tag in DROPPED and tag != "form" and not own_header
        # Marked: dropped for a word alone, or as a form.
        if not words or tag in WHOLE or gone or own_header:
            marked = 0
        if tag == "form" and not gone:
            marked = max(marked, 1)
        some = some or marked == 1
        node = Node(tag, step, gone or marked > 0, at, marked)
        at.children.append(node)
        if tag in VOID or m[3].endswith("/") and tag in ("svg", "path"):
            continue
        if tag in RAW:
            if lower is None:
                lower = page.lower() if len(page.lower()) == len(page) else page
            stop = lower.find("</" + tag, pos)
            if stop < 0:
                pos = end
            else:
                close = page.find(">", stop)
                pos = end if close < 0 else close + 1
            continue
        names[tag] = names.get(tag, 0) + 1
        at = node
    if some:
        _keep_most(root)
    return root


def blocks(node: Node) -> list[str]:
    """The texts of a node's blocks in page order, white space made single; empty ones left out."""
    out, run = [], []

    def flush():
        if run:
            text = " ".join(unescape("".join(run)).split())
            if text:
                out.append(text)
            run.clear()

    # Kept on a stack of its own, as pages may nest deeper than Python calls can.
    stack = [iter(node.children)]
    kinds = [True]
    flush()
    while stack:
        for child in stack[-1]:
            if isinstance(child, str):
                run.append(child)
            elif child.dropped:
                if child.tag in BLOCKS or child.tag in DROPPED:
                    flush()
            elif child.tag == "br":
                run.append("\n")
            else:
                block = child.tag in BLOCKS
                if block:
                    flush()
                stack.append(iter(child.children))
                kinds.append(block)
                break
        else:
            stack.pop()
            if kinds.pop():
                flush()
    flush()
    return out


def path_of(node: Node) -> str:
    steps = []
    while node is not None and node.tag != "#root":
        if node.tag not in ("html", "body") or not steps:
            steps.append(node.step)
        node = node.parent
    return ">".join(reversed(steps))


def containers(root: Node) -> list[tuple[Node, float]]:
    """(container, score) of all containers outside dropped elements.

    A text counts its characters, negative if they are in a link, for its nearest container in full and for each of the
    three above by half as much as for the one below; article and main count half more.
    """
    chars: dict[int, float] = {id(root): 0.0}
    above: dict[int, Node | None] = {id(root): None}
    order = [root]
    stack = [(iter(root.children), False, root)]
    while stack:
        rest, linked, own = stack[-1]
        for child in rest:
            if isinstance(child, str):
                if not child.isspace():
                    chars[id(own)] += -len(child) if linked else len(child)
            elif not child.dropped and child.tag != "br":
                inner = own
                if child.tag in CONTAINERS:
                    inner = child
                    chars[id(child)], above[id(child)] = 0.0, own
                    order.append(child)
                stack.append((iter(child.children), linked or child.tag == "a", inner))
                break
        else:
            stack.pop()
    scores: dict[int, float] = {}
    for node in order:
        n, weight, up = chars[id(node)], 1.0, node
        if n:
            for _ in range(4):
                if up is None:
                    break
                scores[id(up)] = scores.get(id(up), 0.0) + n * weight
                weight, up = weight / 2, above[id(up)]
    factor = {"article": 1.5, "main": 1.5, "body": 0.8, "#root": 0.8}
    return [(node, scores[id(node)] * factor.get(node.tag, 1.0)) for node in order if id(node) in scores]


def best_container(root: Node) -> Node:
    found = containers(root)
    if not found:
        return root
    return max(found, key=lambda x: x[1])[0]


def find_path(root: Node, path: str) -> list[Node]:
    """The outermost nodes with a generalised path, in page order, dropped elements left out."""
    steps = path.split(">")
    out, stack = [], [(root, 0)]
    while stack:
        node, k = stack.pop()
        for child in reversed(node.children):
            if isinstance(child, str) or child.dropped or child.tag == "br":
                continue
            if child.tag in ("html", "body"):
                # No step of what is below them, and a path of their own.
                stack.append((child, -1 if k == len(steps) - 1 and steps[k] == child.step else k))
            elif k < len(steps) and steps[k] == child.step:
                stack.append((child, -1 if k + 1 == len(steps) and child.tag in CONTAINERS else k + 1))
        while stack and stack[-1][1] == -1:
            out.append(stack.pop()[0])
    return out


def extract(page: str | None, path: str | None) -> str:
    """The main text of one page, by its host's winning path or else its own best container.

    The own container also stands in where the path holds less than LEAST of its prose. If nothing is left, the page is read
    again and no element dropped for a word.
    """
    if not page:
        return ""
    for words in (True, False):
        root = parse(page, words)
        texts = [b for node in (find_path(root, path) if path else []) for b in blocks(node)]
        own = blocks(best_container(root))
        if sum(map(len, texts)) < LEAST * sum(map(len, own)) or not texts:
            texts = own
        if texts:
            break
    return "\n\n".join(texts)


def vote(page: str | None) -> tuple[str | None, int]:
    """(path, characters of prose) of a page's best container; no path for a page without text."""
    if not page:
        return None, 0
    for words in (True, False):
        node = best_container(parse(page, words))
        n = sum(map(len, blocks(node)))
        if n:
            break
    return (path_of(node) if n and node.tag != "#root" else None), n


def host_of(url):
    """The lower-cased host of a URL without user, port and a leading www; null for a null URL."""
    host = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.regexp_replace(host, r"^www\.", "")


def winning_paths(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, path): the path with most votes of each host; ties go to more prose, then to the first path by letters."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = [vote(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int64())], names=["host", "path", "n"]
            )

    votes = arrow_map(pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html")), run, "host string, path string, n long")
    sums = votes.filter("path is not null and host is not null and host <> ''").groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum("n").alias("n"))
    return sums.groupBy("host").agg(F.min_by("path", F.struct(-F.col("votes"), -F.col("n"), "path")).alias("path"))


def extract_pages(pages: DataFrame, keep: tuple[str, ...], url: str = "url", html: str = "html", broadcast_rows: int = 20_000) -> DataFrame:
    """pages[keep] with text, the main text of each whole page, and n_chars, its code points.

    A null or empty page gives an empty text. A page whose URL has no host uses its own best container. Repeated rows are
    read each and vote each; an empty table gives an empty one; columns of pages that are named as the results are not
    read. The table of winning paths is broadcast only if it has at most `broadcast_rows` rows; else both sides are joined
    by host, which Spark splits where one host has a large part of all pages.
    """
    winners = checkpointed(winning_paths(pages, url, html))
    few = winners.limit(broadcast_rows + 1).count() <= broadcast_rows
    rows = pages.select(*keep, F.col(html).alias("_html"), host_of(F.col(url)).alias("_host"))
    side = winners.select(F.col("host").alias("_host"), F.col("path").alias("_path"))
    joined = rows.join(F.broadcast(side) if few else side, "_host", "left").select(*keep, "_html", "_path")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema.fields]
    k = len(keep)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [extract(h.as_py(), p) for h, p in zip(batch.column(k), batch.column(k + 1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(k)), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "text", "n_chars"])

    return arrow_map(joined, run, ", ".join([*fields, "text string", "n_chars long"]))


def op8_consensus_paths(spark, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"), ("page_id", "url"))
