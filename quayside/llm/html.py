"""Main text of web pages: the templates of a site are found by counting and removed.

Every element of a page outside its running text gets a hash of its tag and everything in it. Spark counts, for each
host, on how many different pages a hash occurs; elements that recur on many pages of their host are template, and are deleted
from all of them. Pages with the same content count once, so mirrored pages do not make their own text a template.
What says of itself that it is a menu, a form, an advert and so on (by its tag, role, class or id) goes too.

Inside an article only containers are candidates for deletion, never paragraphs or headings: passages that
many articles quote stay.

Counting sends four numbers per candidate. Hashes depend on the host, so a hot host is many keys, never one group. Candidates
are written to the shared folder, so pages are parsed twice and not three times. The hashes of the templates are counted before they
are broadcast; more than ``MOST_TEMPLATES`` come back to the pages by joins.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.buckets import written
from quayside.llm.frames import col
from quayside.llm.registry import query
from quayside.llm.words import slices
from quayside.operators.lookup import lookup
from quayside.session import scratch_path

#: On so many different pages of a host an element is template, and on this part of all of them where that is more.
MIN_PAGES = 5
MIN_SHARE = 0.001
#: Hashes that may be broadcast, 32 MB.
MOST_TEMPLATES = 1 << 22

# Names of elements in HTML, by what they mean here.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("aside center details dir div dl fieldset figure footer form header hgroup menu nav ol search section table ul".split())
NOT_TEXT = frozenset(
    "head nav footer aside form search menu dialog script style noscript template iframe object embed applet svg math canvas audio video map button select "
    "datalist input textarea progress meter title noembed noframes".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices disclaimer popup "
    "modal overlay newsletter subscribe subscription signup login sidebar sidebars aside rail nav navbar navigation menu menus submenu breadcrumb breadcrumbs "
    "pagination pager toolbar masthead topbar header footer footnav copyright comment comments commentlist respond replies reply disqus share sharing social related "
    "recommended recommendations widget widgets skip".split()
)
#: An open element of the key ends when one of these begins.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}, "p": BLOCKS - {"option", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "body", "html"},
}
#: What each element ends.
ENDED_BY = {tag: [key for key, tags in ENDS.items() if tag in tags] for tag in set().union(*ENDS.values())}
#: Beyond these an end tag or an implied end does not reach.
WALLS = frozenset("article aside body details dialog div dl fieldset figure footer form header html main menu nav ol section table td th ul".split())

TAG = re.compile(r"""<(?:!--(?:-?>|.*?(?:--!?>|\Z))|[!?][^>]*+(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z))""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Element:
    __slots__ = ("tag", "attributes", "parts", "parent")

    def __init__(self, tag: str, attributes: str, parent: Element | None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.parts: list[Element | str] = []

    def marked(self) -> bool:
        """Whether it says of itself that it is no running text."""
        if self.tag in NOT_TEXT:
            return True
        if not self.attributes or self.tag in ("html", "body", "main", "article") or self.tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            return False
        for name, *values in ATTRIBUTE.findall(self.attributes):
            name, value = name.lower(), "".join(values)
            if name == "role" and value.strip().lower() in ROLES or name == "aria-hidden" and value.strip().lower() == "true":
                return True
            if name in ("class", "id") and any(part.lower() in NAMES for part in (*NAME_PART.findall(value), *re.split("[^A-Za-z]+", value))):
                return True
            if name == "style" and "display:none" in value.replace(" ", "").lower():
                return True
        return re.search(r"(?:^|\s)hidden(?:\s|$)", ATTRIBUTE.sub(" ", self.attributes)) is not None


def parse(page: str) -> Element:
    """The elements of a page. End tags may lack, tags may be cut off; nothing fails."""
    root = here = Element("#root", "", None)
    opened: Counter[str] = Counter()
    at = 0

    def leave(node: Element) -> Element:
        """The parent of an open element, which ends with all that is open in it."""
        last = here
        while last is not node:
            opened[last.tag] -= 1
            last = last.parent
        opened[node.tag] -= 1
        return node.parent

    while True:
        found = TAG.search(page, at)
        if found is None:
            if at < len(page):
                here.parts.append(page[at:])
            return root
        if found.start() > at:
            here.parts.append(page[at : found.start()])
        at = found.end()
        closing, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            if opened[tag]:
                node = here
                while node.tag != tag and node.parent is not None and (node.tag not in WALLS or tag in WALLS):
                    node = node.parent
                if node.tag == tag:
                    here = leave(node)
            continue
        if any(opened[t] for t in ENDED_BY.get(tag, ())):
            node, ended = here, None
            while node.parent is not None:
                if tag in ENDS.get(node.tag, ()):
                    ended = node
                elif node.tag in WALLS:
                    break
                node = node.parent
            if ended is not None:
                here = leave(ended)
        element = Element(tag, attributes, here)
        here.parts.append(element)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*+(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID:
            here = element
            opened[tag] += 1


def _walk(top: Element) -> Iterator[tuple[Element | str, bool]]:
    """Elements (on the way in: False, on the way out: True) and texts, in page order, without recursion."""
    stack: list[tuple[Element | str, bool]] = [(top, False)]
    while stack:
        node, out = stack.pop()
        yield node, out
        if not out and isinstance(node, Element):
            stack.append((node, True))
            stack += [(part, False) for part in reversed(node.parts)]


def hashes(top: Element, host: str) -> dict[int, int]:
    """A hash of each element of a host, its tag and everything in it, by the element's id(); white space does not matter."""
    key = hashlib.blake2b(host.encode("utf-8", "surrogatepass"), digest_size=16).digest()
    found: dict[int, int] = {}
    open_parts: list[list[str]] = [[]]
    for node, out in _walk(top):
        if isinstance(node, str):
            if text := " ".join(node.split()):
                open_parts[-1].append(text)
        elif not out:
            open_parts.append([])
        else:
            content = "\x1f".join(open_parts.pop())
            digest = hashlib.blake2b(f"{node.tag}\x1e{content}".encode("utf-8", "surrogatepass"), digest_size=8, key=key).digest()
            found[id(node)] = int.from_bytes(digest, "big", signed=True)
            open_parts[-1].append(digest.hex())
    return found


def articles(top: Element) -> tuple[list[Element], bool]:
    """The elements with the page's own text, in page order, and whether the page names them.

    All articles that are in no other and in nothing that says it is a menu, an advert, comments and so on; if all are, the longest of them. Without
    an article the main part, the longest if there are several, else the whole page.
    """
    free, found, mains = [], [], []
    inside = marked = 0
    for node, out in _walk(top):
        if not isinstance(node, Element):
            continue
        step = -1 if out else 1
        if node.tag == "article":
            if not out and not inside:
                found.append(node)
                if not marked and not node.marked():
                    free.append(node)
            inside += step
        elif not out and (node.tag == "main" or "role" in node.attributes and re.search(r"""role\s*=\s*["']?main\b""", node.attributes)):
            mains.append(node)
        if node.marked():
            marked += step
    if free:
        return free, True
    chosen = found or mains
    if len(chosen) < 2:
        return chosen or [top], bool(chosen)
    return [max(chosen, key=lambda e: sum(len(b) for b in blocks(e, frozenset(), {})))], True


def candidates(top: Element, own: list[Element], named: bool, digests: dict[int, int]) -> set[int]:
    """Hashes of the elements that may be template: containers, and outside the articles also blocks of text."""
    found, inside = set(), 0
    texts = {id(e) for e in own} if named else set()
    for node, out in _walk(top):
        if not isinstance(node, Element):
            continue
        if id(node) in texts:
            inside += -1 if out else 1
        elif not out and node.tag in (CONTAINERS if inside else BLOCKS) and node.tag not in ("html", "body", "main", "article") and node.parts:
            found.add(digests[id(node)])
    return found


def blocks(top: Element, doomed: frozenset[int], digests: dict[int, int]) -> list[str]:
    """Texts of the blocks of an element, in page order, without what is template or no running text."""
    made: list[str] = []
    run: list[str] = []
    stack: list[tuple[Element | str, bool]] = [(top, False)]

    def end() -> None:
        if run:
            text = "".join(run)
            if text := " ".join((entities.unescape(text) if "&" in text else text).split()):
                made.append(text)
            run.clear()

    while stack:
        node, out = stack.pop()
        if isinstance(node, str):
            run.append(node)
            continue
        if node.tag in BLOCKS:
            end()
        elif node.tag == "br":
            run.append(" ")
        if out:
            continue
        if node is not top and (node.marked() and not _titled(node, top) or node.tag == "article" and top.tag == "article" or digests.get(id(node)) in doomed and node.tag not in ("html", "body", "main", "article")):
            continue
        stack.append((node, True))
        stack += [(part, False) for part in reversed(node.parts)]
    end()
    return made


def _titled(node: Element, top: Element) -> bool:
    """Whether it is the head of an article, with its title."""
    return top.tag == "article" and node.tag in ("header", "hgroup", "div") and any(isinstance(x, Element) and x.tag == "h1" for x, _ in _walk(node))


def main_text(page: str, host: str, doomed: Callable[[set[int]], frozenset[int]]) -> str:
    """The text of a page. ``doomed`` says which of its candidates are template."""
    top = parse(page)
    own, named = articles(top)
    digests = hashes(top, host)
    gone = doomed(candidates(top, own, named, digests))
    if gone and named:  # in an article only containers can be template
        digests = {id(n): digests[id(n)] for e in own for n, out in _walk(e) if not out and isinstance(n, Element) and n.tag in CONTAINERS}
    return "\n\n".join(block for e in own for block in blocks(e, gone, digests))


def host(url: Column) -> Column:
    """The host of an address in lower case; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _candidate_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each different candidate of a page; body is a hash of the page's own text."""
    for whole in batches:
        for batch in slices(whole, "html"):
            rows, found, bodies = [], [], []
            for row, (name, page) in enumerate(zip(batch.column("host").to_pylist(), batch.column("html").to_pylist())):
                top = parse(page or "")
                main, named = articles(top)
                own = candidates(top, main, named, hashes(top, name))
                if not own:
                    continue
                text = "\n".join(block for e in main for block in blocks(e, frozenset(), {}))
                body = int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)
                rows += [row] * len(own)
                bodies += [body] * len(own)
                found += sorted(own)
            sites = [int.from_bytes(hashlib.blake2b((name or "").encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True) for name in batch.column("host").to_pylist()]
            of_pages = pa.array(rows, pa.int64())
            columns = [batch.column("k").take(of_pages), pa.array(found, pa.int64()), pa.array(bodies, pa.int64()), pa.array(sites, pa.int64()).take(of_pages)]
            yield pa.RecordBatch.from_arrays(columns, ["k", "element", "body", "site"])


def _among(own: set[int], table: np.ndarray) -> frozenset[int]:
    """Which hashes are in a table that is in order."""
    hashed = np.fromiter(own, np.int64, len(own))
    at = np.searchsorted(table, hashed)
    at[at == len(table)] = 0
    return frozenset(hashed[table[at] == hashed].tolist()) if len(table) else frozenset()


def extract(pages: DataFrame, url: str = "url", html: str = "html", min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, to: str = "main_text", most_templates: int = MOST_TEMPLATES) -> DataFrame:
    """Add the main text of each page.

    A null or empty page has empty text. Pages without an address or with a broken one count as pages of one nameless host. Markup that is cut
    off, unbalanced or nested without end is read as far as it goes. Repeated pages get equal texts and
    count once. A column already called ``to`` is replaced; an empty table stays empty.
    """
    spark = pages.sparkSession
    kept = [c for c in pages.columns if c != to]
    names = [f"c{i}" for i in range(len(kept))]
    rows = pages.select(*(col(c).alias(n) for c, n in zip(kept, names)), host(col(url)).alias("host"), col(html).alias("html"), F.xxhash64(host(col(url)), col(html)).alias("k"))
    path = scratch_path(spark, "elements")
    rows.select("host", "k", "html").mapInArrow(_candidate_rows, "k bigint, element bigint, body bigint, site bigint").write.parquet(path)
    found = spark.read.parquet(path)
    # an element's hash tells its host, so one host is many keys; hosts are few rows beside their pages
    on_pages = found.select("element", "site", "body").distinct().groupBy("element", "site").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    sites = written(found.select("site", "body").distinct().groupBy("site").agg(F.count("*").alias("pages")), "sites")
    often = lookup(on_pages, sites, ["site"], salt=F.col("element")).where(F.col("n") >= min_share * F.col("pages"))
    template = written(often.select("element"), "templates")
    schema = T.StructType([*(rows.schema[n] for n in names), T.StructField("text", T.StringType())])
    if template.count() <= most_templates:
        known = spark.sparkContext.broadcast(np.sort(np.asarray(template.toArrow()["element"])))
        marked = rows.withColumn("doomed", F.lit(None).cast("array<bigint>"))
    else:
        # pages that share a key by chance would share elements to delete, and an element is deleted only where it is
        known = spark.sparkContext.broadcast(np.zeros(0, np.int64))
        marked = rows.join(found.select("k", "element").distinct().join(template, "element").groupBy("k").agg(F.collect_set("element").alias("doomed")), "k", "left")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        everywhere = known.value
        for whole in batches:
            for batch in slices(whole, "html"):
                made = [
                    main_text(page or "", name, lambda own, doomed=doomed: frozenset(own.intersection(doomed)) if doomed else _among(own, everywhere))
                    for name, page, doomed in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "doomed")))
                ]
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(made, pa.string())], schema.names)

    out = marked.select(*names, "host", "html", "doomed").mapInArrow(texts, schema)
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, kept)), F.col("text").alias(to))


@query()
def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    text = extract(pages, to="text")
    return text.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
