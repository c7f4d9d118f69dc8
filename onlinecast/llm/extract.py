"""Main text of pages, with a style tree of each site.

Elements that are by their kind no part of an article (menus, footers, forms, hidden ones and so on) are left out
first, and those whose class names say so (adverts, comments), unless they hold an article or most of a page. What the pages of one host have in common is then seen in their merged style tree: a
node is the way of tags and classes that leads to an element. A node that holds text is as important as its
texts differ between pages (their entropy, from 0 for one text to 1), a node that holds others as the way its
children are laid out and what they hold differ. Text in ``article`` or ``main`` is a little more important than
other text. Branches of little importance are taken out of each page, unless nothing would be left of it.

The tree is never built in one place: its nodes are rows, their entropies are aggregates, and only the
unimportant nodes travel back to the pages.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onlinecast.llm.common import Scratch, append, column, small_side

MIN_PAGES = 4
LOW = 0.15
LAYOUT = 0.1
MARKED = 0.1
HIGH = 0.5
MOST = 0.5
MOST_NAMED = 2 / 3

# fixed values: elements and words of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object xmp noembed".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section select summary table tbody td tfoot th thead tr ul".split()
)
OUTSIDE = frozenset("head nav footer aside form button select dialog menu search".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
WORDS = frozenset(
    "ad ads advert advertisement advertising adsense banner breadcrumb breadcrumbs byline comment comments consent cookie "
    "cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notification overlay "
    "pager pagination paywall popup promo promoted promotion related replies reply respond share sharing sidebar signup "
    "skip social sponsor sponsored subscribe subscription toolbar widget".split()
)
FOREIGN = frozenset("ad ads advert advertisement advertising adsense comment comments disqus replies reply respond".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th")}
HOLDS = frozenset("ul ol dl table tr tbody thead select article section div body main".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Branch:
    """An element that its class names call no article, and what speaks for it."""

    __slots__ = ("named", "foreign", "held", "article")

    def __init__(self, named: bool, foreign: bool):
        self.named, self.foreign = named, foreign
        self.held = 0
        self.article = False

    def goes(self, total: int, elsewhere: bool) -> bool:
        """Whether it is left out of a page of ``total`` characters.

        One that holds an article or most of the text stays. Adverts and comments can be longer than an article and
        hold articles of others, so they go if an article stands ``elsewhere``, outside of all such branches.
        """
        if self.foreign and elsewhere:
            return True
        return not self.article and self.held <= (MOST_NAMED if self.named else MOST) * total


class Element:
    __slots__ = ("tag", "path", "out", "main", "branches", "children", "kept")

    def __init__(self, tag: str, path: int, out: bool, main: bool, branches: tuple[Branch, ...] = ()):
        self.tag, self.path, self.out, self.main, self.branches = tag, path, out, main, branches
        self.children: list[int] = []
        self.kept = False


def name_of(*parts: object) -> int:
    return xxhash.xxh3_64_intdigest("\x1f".join(map(str, parts))) - (1 << 63)


def unwanted(tag: str, attributes: dict[str, str], inside: bool) -> bool:
    """Whether an element is by its kind no part of an article; ``inside`` an article headers and headlines are."""
    if tag in OUTSIDE or (tag == "header" and not inside):
        return True
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or HIDDEN.search(attributes.get("style", "")):
        return True
    return attributes.get("role", "").lower() in ROLES


def named(tag: str, attributes: dict[str, str], inside: bool) -> Branch | None:
    """The branch an element opens if its class names or its id call it no part of an article.

    A whole name (``sidebar``) says more than a part of one (``has-sidebar``).
    """
    if tag in ("html", "body", "main"):
        return None
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split()
    words = WORDS if inside else WORDS | {"header"}
    if words.isdisjoint(re.findall(r"[a-z]+", " ".join(names))):
        return None
    return Branch(not words.isdisjoint(names), not FOREIGN.isdisjoint(names))


class Page:
    """Blocks of text of a page, and the elements they stand in."""

    def __init__(self, source: str):
        self.blocks: list[tuple[str, bool, tuple[int, ...]]] = []
        self.layout: list[tuple[int, tuple[int, ...]]] = []
        self.stack = [Element("", 0, False, False)]
        self.pieces: list[tuple[str, tuple[Branch, ...]]] = []
        self._found: list[tuple[list[tuple[str, tuple[Branch, ...]]], bool, tuple[Element, ...]]] = []
        self._laid: list[Element] = []
        self._total, self._elsewhere = 0, False
        self._read(source)
        self._judge()

    def _add(self, text: str) -> None:
        at = self.stack[-1]
        if at.out:
            return
        self.pieces.append((text, at.branches))
        size = len(text.strip())
        self._total += size
        for branch in at.branches:
            branch.held += size
        if size and at.main and not at.branches:
            self._elsewhere = True

    def _flush(self) -> None:
        if any(not text.isspace() for text, _ in self.pieces):
            self._found.append((self.pieces, self.stack[-1].main, tuple(self.stack)))
        self.pieces = []

    def _judge(self) -> None:
        """Blocks without the branches that go; those are only left out as long as something else stays."""
        gone = {b for pieces, _, _ in self._found for _, above in pieces for b in above if b.goes(self._total, self._elsewhere)}
        if gone and not any(text.strip() and gone.isdisjoint(above) for pieces, _, _ in self._found for text, above in pieces):
            gone = set()
        for pieces, main, way in self._found:
            text = " ".join("".join(text for text, above in pieces if gone.isdisjoint(above)).split())
            if text:
                for element in way:
                    element.kept = True
                self.blocks.append((text, main, tuple(e.path for e in way[1:])))
        for element in self._laid:
            if element.kept:
                runs = [c for k, c in enumerate(element.children) if not k or c != element.children[k - 1]]
                self.layout.append((element.path, tuple(runs)))

    def _pop(self) -> None:
        element = self.stack.pop()
        if element.children:
            self._laid.append(element)

    def _close(self, tag: str) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag == tag:
                while len(self.stack) > depth:
                    self._pop()
                return

    def _open(self, tag: str, rest: str) -> None:
        if tag in BLOCK and any(e.tag == "p" for e in self.stack[1:]):
            at = max(k for k, e in enumerate(self.stack) if e.tag == "p")
            if not any(e.tag in HOLDS for e in self.stack[at + 1 :]):
                self._close("p")
        for other in CLOSES.get(tag, ()):
            at = max((k for k, e in enumerate(self.stack) if e.tag == other), default=0)
            if at and not any(e.tag in ("ul", "ol", "dl", "table", "select") for e in self.stack[at + 1 :]):
                self._close(other)
        if tag == "body":
            while len(self.stack) > 1 and self.stack[-1].tag != "html":
                self._pop()
        attributes = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(rest)} if rest.strip(" /") else {}
        above = self.stack[-1]
        style = re.sub(r"\d+", "#", attributes.get("class", ""))
        path = name_of(above.path, tag, style)
        above.children.append(path)
        main = above.main or tag in ("article", "main") or attributes.get("role", "") in ("main", "article")
        branch = named(tag, attributes, above.main) if attributes else None
        branches = (*above.branches, branch) if branch else above.branches
        if tag in ("article", "main") or attributes.get("role", "") in ("main", "article"):
            for other in branches:
                other.article = True
        self.stack.append(Element(tag, path, above.out or unwanted(tag, attributes, above.main), main, branches))

    def _read(self, source: str) -> None:
        at = 0
        while (found := TOKEN.search(source, at)) is not None:
            if found.start() > at:
                self._add(html.unescape(source[at : found.start()]))
            at = found.end()
            if found[0].startswith("<![CDATA["):
                self._add(found[0][9:].removesuffix("]]>"))
            tag = (found[2] or found[5] or "").lower()
            if not tag:
                continue
            rest, closing = found[3] or found[6] or "", bool(found[1] or found[4])
            if tag in RAW:
                if not closing and not rest.endswith("/"):
                    end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                    at = end.end() if end else len(source)
                continue
            if tag == "br":
                self._add(" ")
                continue
            if tag in BLOCK:
                self._flush()
            if closing:
                self._close(tag)
            elif tag not in VOID:
                self._open(tag, rest)
        if at < len(source):
            self._add(html.unescape(source[at:]))
        self._flush()
        while len(self.stack) > 1:
            self._pop()

    def text_blocks(self) -> list[tuple[str, tuple[int, ...]]]:
        """Blocks of the article, or of the whole page if none is marked, with the way to each.

        This is what the marks of one page say; ``main_text`` takes all blocks and asks the tree of the site.
        """
        marked = any(main for _, main, _ in self.blocks)
        return [(text, way) for text, main, way in self.blocks if main or not marked]


def nodes(pages: DataFrame, source: str) -> DataFrame:
    """Nodes of the style trees: host, node, its parts above, what it shows on a page, and the page's content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for host, value in zip(column(batch, "__host").to_pylist(), column(batch, source), strict=True):
                page = Page(value.as_py() or "")
                content = name_of(*(text for text, _, _ in page.blocks))
                inside = {step for _, _, way in page.blocks for step in way}
                rows += [
                    (host, way[-1] if way else 0, True, main, name_of(text), content, list(way[:-1]))
                    for text, main, way in page.blocks
                ]
                rows += [(host, path, False, False, name_of(*shown), content, []) for path, shown in page.layout if path in inside]
                if len(rows) > 50_000:
                    yield _node_batch(rows)
                    rows = []
            if rows:
                yield _node_batch(rows)

    return pages.select("__host", source).mapInArrow(
        run, "host string, node long, leaf boolean, main boolean, shown long, content long, above array<long>"
    )


def _node_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
    names = ["host", "node", "leaf", "main", "shown", "content", "above"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def unimportant(pages: DataFrame, source: str, scratch: Scratch, min_pages: int = MIN_PAGES, low: float = LOW) -> DataFrame:
    """``host``, ``node`` and ``importance`` of the unimportant branches on hosts with enough different pages.

    Pages of a host with equal content count once. The importance of a text is its entropy, ``MARKED`` more in
    ``article`` or ``main``; that of a node is ``LAYOUT`` parts the entropy of how its children are laid out, the rest
    the mean importance of the texts below it. A node with a text of ``HIGH`` importance or one too rare to be judged
    below it stays, whatever its mean is; the unimportant texts below it go one by one.
    """
    once = nodes(pages.where("__host <> ''"), source).groupBy("host", "node", "leaf", "shown", "content").agg(
        F.first("above").alias("above"), F.max("main").alias("main")
    )
    shown = once.groupBy("host", "node", "leaf", "shown").agg(
        F.count("*").alias("n"), F.first("above").alias("above"), F.max("main").alias("main")
    )
    # entropy of what is shown, in units of the logarithm of the number of occurrences
    sums = shown.groupBy("host", "node", "leaf").agg(
        F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("s"), F.first("above").alias("above"),
        F.max("main").alias("main"),
    )
    entropy = F.when(F.col("m") > 1, (F.log("m") - F.col("s") / F.col("m")) / F.log("m")).otherwise(1.0)
    raised = F.least(F.lit(1.0), entropy + F.when(F.col("main"), MARKED).otherwise(0.0))
    sums = scratch.write(sums.withColumn("entropy", F.when(F.col("m") >= min_pages, raised)), "entropy")
    judged = sums.where(F.col("entropy").isNotNull())
    leaves = judged.where("leaf").select("host", "entropy", "node")
    below = (
        sums.where("leaf").join(leaves.select("host").distinct(), "host", "left_semi")
        .select("host", "entropy", F.explode("above").alias("node")).groupBy("host", "node").agg(
            F.avg("entropy").alias("held"), F.max(F.coalesce("entropy", F.lit(1.0))).alias("most")
        )
    )
    layout = judged.where("not leaf").select("host", "node", F.col("entropy").alias("laid"))
    inner = below.where(F.col("most") < HIGH).join(layout, ["host", "node"], "left").select(
        "host", "node", (LAYOUT * F.coalesce("laid", F.lit(1.0)) + (1 - LAYOUT) * F.col("held")).alias("importance")
    )
    every = leaves.select("host", "node", F.col("entropy").alias("importance")).union(inner)
    weak = every.where(F.col("importance") < low).groupBy("host", "node").agg(F.min("importance").alias("importance"))
    return scratch.write(weak, "low")


def main_text(
    pages: DataFrame, url: str = "url", source: str = "html", keep: list[str] | None = None,
    min_pages: int = MIN_PAGES, low: float = LOW,
) -> DataFrame:
    """Add ``text`` and ``n_chars`` (its code points) to every page.

    Blocks of text stand in page order with an empty line between; white space in a block is one space. A null or
    empty page, and one without any text, gives an empty text. Pages whose address is null or has no host are
    not merged with others. A page of which the style tree would leave nothing keeps its most important branches: it
    is then the repeated content itself. Repeated pages count once in the tree and get equal texts. ``keep`` names the
    columns to carry on (all when None); columns called ``text`` and ``n_chars`` are replaced.
    """
    keep = list(pages.columns) if keep is None else keep
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    hosted = pages.select(*{*keep, source}, host.alias("__host"))
    scratch = Scratch(pages.sparkSession, "extract")
    weak = unimportant(hosted, source, scratch, min_pages, low)
    weak = weak.groupBy(F.col("host").alias("__host")).agg(
        F.map_from_entries(F.collect_list(F.struct("node", "importance"))).alias("__low")
    )
    joined = hosted.join(small_side(weak), "__host", "left").drop("__host")

    def add(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        out = []
        for value, nodes in zip(column(batch, source), column(batch, "__low"), strict=True):
            blocks = Page(value.as_py() or "").blocks
            low_nodes = dict(nodes.as_py() or ())
            worth = [min((low_nodes[n] for n in way or (0,) if n in low_nodes), default=1.0) for _, _, way in blocks]
            # blocks outside all low branches are worth 1, which no low branch is
            best = max(worth, default=1.0)
            out.append("\n\n".join(text for (text, _, _), w in zip(blocks, worth, strict=True) if w == best))
        return {"text": pa.array(out, pa.string()), "n_chars": pa.array(np.array([len(t) for t in out], np.int64))}

    return append(joined, "text string, n_chars long", add, [c for c in keep if c not in ("text", "n_chars")], source)
