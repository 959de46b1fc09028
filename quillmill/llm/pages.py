"""Main text of web pages, with site templates removed.

Every element subtree outside the articles (inside them, only containers such as div and ul) is
hashed. Spark counts for each host in how many different pages a subtree occurs; those in many
are the site's template and are deleted. Elements whose name, role or class says what they are
(menus, notices, adverts, forms, comments, ...) go too, whether they recur or not.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import materialize, read
from quillmill.llm.registry import query

#: A subtree is template if it occurs in so many different pages of a host and in this share of them.
LEAST_PAGES, LEAST_SHARE = 5, 0.2
#: Template hashes are sent to all workers up to so many (8 bytes each), joined by host beyond.
BROADCAST_HASHES = 1_000_000

# Fixed names of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot"
    " th thead tr ul".split()
)
ENDS_PARAGRAPH = BLOCK - frozenset("html body caption td th tr tbody thead tfoot legend summary".split())
IMPLIED_END = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
}
SCOPE = frozenset("ul ol dl table select article section div body html main".split())
DROPPED = frozenset(
    "aside audio button canvas dialog embed footer form head iframe input link menu meta nav noscript object script select"
    " style svg template textarea title video".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("div section ul ol dl table figure details".split())
# What classes, ids and roles call the parts of a page that aren't its article.
NOISE = frozenset(
    "ad ads adbox adsense advert advertisement adverts advertising alert banner breadcrumb breadcrumbs comment commentlist"
    " comments consent contentinfo complementary cookie cookies disqus footer gdpr header login masthead menu menubar modal"
    " nav navbar navigation newsletter notice notices notification pager paginate pagination popup promo promotion"
    " recommended related replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe"
    " subscription toolbar topbar widget widgets".split()
)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?>\"[^\"<]*\"|'[^'<]*'|[^'\"><])*+(?=>)|[^>]*)>",
    re.S,
)
_ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "attrs", "children", "hash", "holds")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.children, self.hash, self.holds = tag, attrs, [], 0, False


def parse(page: str) -> Node:
    """A forgiving tree of elements and texts; any input gives one."""
    root = Node("#", {})
    stack = [root]
    at = 0
    length = len(page)
    last = page.rfind(">")
    while at < length:
        m = _TAG.search(page, at) if at <= last else None
        if m is None:
            stack[-1].children.append(page[at:])
            break
        if m.start() > at:
            stack[-1].children.append(page[at : m.start()])
        at = m.end()
        name = m.group("name")
        if name is None:
            continue
        name = name.lower()
        if m.group("end"):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == name:
                    del stack[i:]
                    break
                if stack[i].tag == "article" and name in ("div", "p", "span", "b", "i", "li", "ul", "section"):
                    break  # a stray end tag doesn't close what holds the article
            continue
        if name in ENDS_PARAGRAPH:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag in SCOPE or stack[i].tag in ("td", "th", "li", "button"):
                    break
        ended = IMPLIED_END.get(name)
        if ended:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ended:
                    del stack[i:]
                    if name != "tr":
                        break
                elif stack[i].tag in SCOPE:
                    break
        raw = m.group("attrs") or ""
        node = Node(name, {k.lower(): (v or "").strip("\"'") for k, v in _ATTR.findall(raw)} if "=" in raw or raw.strip(" /") else {})
        stack[-1].children.append(node)
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            stop = end.start() if end else length
            node.children.append(page[at:stop])
            at = end.end() if end else length
        elif name not in VOID and not raw.rstrip().endswith("/"):
            stack.append(node)
        elif name not in VOID and name in ("p", "div", "span", "b", "i", "li", "article", "section"):
            stack.append(node)  # a slash doesn't close these
    return root


def _walk(root: Node) -> list[Node]:
    """All elements, parents first."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [c for c in reversed(node.children) if isinstance(c, Node)]
    return order


def _hashed(root: Node) -> list[Node]:
    """Elements, parents first, with ``hash`` of their subtree and ``holds``: an article or main lies in it."""
    order = _walk(root)
    for node in reversed(order):
        h = xxhash.xxh3_64(node.tag)
        for c in node.children:
            if isinstance(c, Node):
                node.holds = node.holds or c.holds or c.tag in ("article", "main")
                h.update(c.hash.to_bytes(8, "little", signed=True))
            else:
                text = " ".join(c.split())
                if text:
                    h.update(b"\0" + text.encode("utf-8", "surrogatepass"))
        h.update("\0".join(node.attrs.get(k, "") for k in ("class", "id", "role")).encode("utf-8", "surrogatepass"))
        node.hash = int.from_bytes(h.digest(), "little", signed=True)
    return order


def _noise(node: Node, inside: bool) -> bool:
    """Whether an element is by its own name no part of an article."""
    tag, attrs = node.tag, node.attrs
    if tag in DROPPED:
        return True
    if tag == "header" and not inside:
        return not node.holds
    if not attrs or tag in HEADINGS or tag in ("#", "html", "body", "main") or node.holds:
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return True
    named = " ".join(attrs.get(k, "") for k in ("class", "id", "role")).lower()
    return bool(named.strip()) and not NOISE.isdisjoint(_NAME.findall(named))


def candidates(page: str) -> set[int]:
    """Hashes of the subtrees that may be template; long paragraphs of a page without article aren't."""
    root = parse(page)
    _hashed(root)
    found: set[int] = set()
    todo = [(root, False)]
    while todo:
        node, inside = todo.pop()
        if node.tag not in ("#", "html", "body", "head", "article", "main") and not node.holds and (not inside or node.tag in CONTAINERS):
            found.add(node.hash)
        todo += [(c, inside or node.tag == "article") for c in node.children if isinstance(c, Node) and c.tag not in RAW]
    return found


def main_text(page: str | None, template: frozenset[int] | set[int] = frozenset()) -> str:
    """The blocks of the article, one a line. Without an article element: of main, else of the body."""
    root = parse(page or "")
    order = _hashed(root)

    def gone(node: Node, inside: bool) -> bool:
        if _noise(node, inside):
            return True
        may = node.tag not in ("#", "html", "body", "head", "article", "main") and not node.holds
        return may and (not inside or node.tag in CONTAINERS) and node.hash in template

    roots: list[Node] = []
    for wanted in ("article", "main"):
        todo = [root]
        while todo:
            node = todo.pop()
            if gone(node, False):
                continue
            if node.tag == wanted or (wanted == "main" and node.attrs.get("role") == "main"):
                roots.append(node)
            else:
                todo += [c for c in reversed(node.children) if isinstance(c, Node)]
        if roots:
            break
    inside = bool(roots) and roots[0].tag == "article"
    if not roots:
        roots = [n for n in order if n.tag == "body"][:1] or [root]
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        if text:
            blocks.append(text)
        line.clear()

    for top in roots:
        todo: list = [top]
        while todo:
            item = todo.pop()
            if item is None:
                flush()
            elif isinstance(item, str):
                line.append(entities.unescape(item))  # references don't reach over tags
            elif item is not top and gone(item, inside):
                if item.tag in BLOCK:
                    flush()
            elif item.tag == "br":
                line.append(" ")
            elif item.tag == "header" and inside and item is not top:
                flush()
                todo += [None, *[n for n in reversed(_walk(item)) if n.tag in HEADINGS]]
            elif item.tag in BLOCK:
                flush()
                todo += [None, *reversed(item.children)]
            else:
                todo += reversed(item.children)
        flush()
    return "\n".join(blocks)


def host_of(url: str) -> Column:
    """The host of a URL in small letters, also without a scheme (``//host``); empty if it has none."""
    host = F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/?#:\s]*)", 1)
    return F.lower(F.coalesce(host, F.lit("")))


def templates(pages: DataFrame) -> DataFrame:
    """(host, template array<bigint>) from (host, html): subtrees in many different pages of a host.

    Equal pages count once, so copies of one page don't make it a template.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, pages_, subtrees = [], [], []
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                here = xxhash.xxh3_64_intdigest(page or "") - (1 << 63)
                for h in [*candidates(page or ""), None]:  # None: the page itself
                    hosts.append(host)
                    pages_.append(here)
                    subtrees.append(h)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(pages_, pa.int64()), pa.array(subtrees, pa.int64())], ["host", "page", "subtree"]
            )

    seen = pages.select("host", "html").mapInArrow(run, "host string, page bigint, subtree bigint").distinct()
    counts = materialize(seen.groupBy("host", "subtree").agg(F.count("*").alias("n")), "subtrees")
    sizes = counts.where("subtree is null").select("host", F.col("n").alias("pages"))
    often = counts.where(F.col("subtree").isNotNull() & (F.col("n") >= LEAST_PAGES)).join(sizes, "host")
    often = often.where(F.col("n") >= F.col("pages") * LEAST_SHARE)
    # at most (subtrees of a page) / LEAST_SHARE hashes for a host
    return often.groupBy("host").agg(F.collect_set("subtree").alias("template"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text) of every page. Null or empty pages give an empty text; pages without a host
    count as one site; repeated rows stay; other columns aren't read."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    rows = rows.withColumn("host", host_of("url"))
    found = materialize(templates(rows), "templates")
    id_type = rows.schema["id"].dataType.simpleString()
    hashes = found.agg(F.coalesce(F.sum(F.size("template")), F.lit(0))).first()[0]
    near = F.broadcast(found) if hashes <= BROADCAST_HASHES else found
    joined = rows.join(near, "host", "left").select("id", "url", "html", "template")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                main_text(page.as_py(), frozenset(t.as_py() or ())) for page, t in zip(batch.column("html"), batch.column("template"))
            ]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string())], ["id", "url", "text"])

    return joined.mapInArrow(run, f"id {id_type}, url string, text string")


@query("op9_pages")
def op9_pages(spark, sf_dir):
    found = extract(read(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars"))
