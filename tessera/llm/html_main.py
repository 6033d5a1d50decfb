"""Main text of web pages by site style trees (operator 1).

The pages of a host are merged into one style tree: elements at the same path
of styles (tag and classes, from the root) are one node, named by a 64-bit hash
of its parent's name and its style.  A node's
presentation importance is the entropy, over the host's pages, of the
sequence of its children's styles; its content importance is the entropy of
its own text; both are divided by their largest possible value.  A branch
whose nodes all stay below ``LOW`` repeats itself on the site and is removed
from each of its pages.

Copies of a page count once.  Hosts with fewer than ``MIN_PAGES`` distinct
pages say nothing about entropy.  Styles also carry a prior: navigation,
headers, footers, forms and the like have importance 0 by their tag, role or
class.  Low branches inside ``article`` and ``main`` are removed too, but for
headings, so titles that many pages share stay.  ``article`` and ``main`` are
the page's content unless, on a host with known entropies, more of the page's
text that is left (links aside) is beside them: then all that is left is.

Counts per (host, path, value) are aggregated before they are shuffled, so a
host with a third of all pages is no hot task.  A null, empty or broken html
gives what text it holds (an empty string if none): comments, declarations and
tags that are not closed are markup up to the end of the page, as in a browser;
time and memory grow with a page's length, however deep it nests; a null url is a host of
its own; repeated rows are extracted each; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.scratch import Scratch
from tessera.llm.words import slices

LOW, MIN_PAGES = 0.2, 8
#: A model of up to this many bytes is broadcast, a larger one joined.
BROADCAST_BYTES = 8 << 20

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rp rt s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
NOISE_TAGS = frozenset("nav header footer aside form script style noscript template head title svg iframe button select "
                       "textarea menu dialog object canvas audio video map".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
NOISE_WORDS = frozenset("ad ads advert adverts advertisement advertising adbox sponsor sponsored promo promotion banner sidebar "
                        "sidenav menu nav navbar navigation breadcrumb breadcrumbs header masthead topbar footer cookie cookies "
                        "consent gdpr notice notices alert popup modal overlay comment comments reply replies respond disqus share "
                        "sharing social related recommended newsletter subscribe signup login pagination pager widget "
                        "toolbar skip".split())
MODIFIERS = frozenset("has with no without is js hide show".split())
MAIN_TAGS = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
          "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}


@functools.lru_cache(1 << 14)
def style(tag: str, classes: str, role: str, ident: str) -> tuple[str, bool]:
    """The style's name, and whether it is noise by its tag, role or names."""
    parts = [re.findall(r"[a-z0-9]+", x) for x in f"{classes} {ident}".lower().split()]
    names = [n for p in parts if p and p[0] not in MODIFIERS for n in p]  # "has-sidebar" is no sidebar
    key = tag + "".join("." + c for c in sorted(set(re.findall(r"[a-z_-]+", classes.lower()))))
    noise = (tag in NOISE_TAGS or role.lower() in NOISE_ROLES
             or tag not in ("html", "body", "article", "main") and not NOISE_WORDS.isdisjoint(names)
             or tag in MAIN_TAGS and not NOISE_WORDS.isdisjoint(set(names) & {"comment", "comments", "ad", "ads", "related", "reply"}))
    return key, noise


@functools.lru_cache(1 << 16)
def node_id(parent: int, key: str) -> int:
    """The 64-bit name of a style node, from its parent's."""
    return number(f"{parent}/{key}")


#: A declaration with its internal subset, and the end of a comment.
DECLARATION = re.compile(r"[^>\[]*(?:\[[^\]]*\]\s*)?>")
COMMENT_END = re.compile(r"--!?>")
TAG_BEGINS = re.compile(r"<[A-Za-z/!?]")


class Page(HTMLParser):
    """One pass over a page: its kept text, and the style nodes it has."""

    def __init__(self, low: frozenset[str] | None = None):
        """``low``: the low branches of the page's host, None if not known."""
        super().__init__(convert_charrefs=True)
        self.low, self.known = low or frozenset(), low is not None
        self.inside = self.beside = 0  # characters of kept text in and beside article and main, without links
        # tag, style node, dropped, inside main, inside a header of main, children, own text
        self.stack: list[tuple] = [("", 0, False, False, False, [], [])]
        self.at: dict[str, list[int]] = {}  # places of the open elements of each tag
        self.blocks: list[int] = []         # places of those that are not inline
        self.nodes: dict[int, tuple[int, int, list, list]] = {}  # parent, depth, children, own text
        self.all: list[str] = []
        self.main: list[str] = []
        self.has_main = False

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self._break()
            if self.blocks and self.stack[self.blocks[-1]][0] == "p":  # a block ends an open paragraph
                self._pop(self.blocks[-1])
        if tag in CLOSES:
            ends, stop = CLOSES[tag]
            k = self._last(ends)
            if k > self._last(stop):
                self._pop(k)
        a = dict(attrs)
        key, noise = style(tag, a.get("class") or "", a.get("role") or "", a.get("id") or "")
        _, path, dropped, main, head, children, _ = self.stack[-1]
        if not children or children[-1] != key:
            children.append(key)
        if tag in VOID:
            return
        path = node_id(path, key)
        if main and tag == "header":  # the article's own header: its headings stay
            noise, head = False, True
        low = path in self.low and not head and not (main and tag in HEADINGS)
        is_main = tag in MAIN_TAGS and not noise and not dropped and not low
        self.has_main |= is_main
        main = main or is_main
        drop = dropped or noise or low or (head and tag not in HEADINGS and tag != "header"
                                                                        and tag not in INLINE and tag not in ("div", "hgroup"))
        self.at.setdefault(tag, []).append(len(self.stack))
        if tag not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append((tag, path, drop, main, head, [], []))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack[-1][0] == tag and tag in ("svg", "path", "use"):
            self._pop(len(self.stack) - 1)

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self._break()
        k = self._last(tag)
        if k:
            self._pop(k)

    def handle_data(self, data):
        tag, _, dropped, main, head, _, own = self.stack[-1]
        if tag not in ("script", "style"):
            own.append(data)
        if dropped or (head and not any(self.at.get(h) for h in HEADINGS)):
            return
        self.all.append(data)
        if main:
            self.main.append(data)
        if not self.at.get("a"):
            size = sum(map(len, data.split()))
            self.inside, self.beside = self.inside + size * main, self.beside + size * (not main)

    def _break(self):
        self.all.append(" ")
        self.main.append(" ")

    def _last(self, tags: str) -> int:
        """Place of the innermost open element of ``tags``, 0 if there is none."""
        return max((self.at[t][-1] for t in tags.split() if self.at.get(t)), default=0)

    def _pop(self, k: int) -> None:
        while len(self.stack) > k:
            tag, path, _, _, _, children, own = self.stack.pop()
            self.at[tag].pop()
            if tag not in INLINE:
                self.blocks.pop()
            seen = self.nodes.get(path)
            if seen is None:
                seen = self.nodes[path] = (self.stack[-1][1], len(self.stack), [], [])
            seen[2].extend(children)
            seen[3].extend(own)

    # Comments, declarations, marked sections and instructions are markup,
    # closed or not; what is never closed ends with the page.

    def parse_comment(self, i, report=True):
        if self.rawdata.startswith(("<!-->", "<!--->"), i):
            return self.rawdata.index(">", i) + 1
        end = COMMENT_END.search(self.rawdata, i + 4)
        return end.end() if end else len(self.rawdata)

    def parse_html_declaration(self, i):
        raw = self.rawdata
        if raw.startswith("<!--", i):
            return self.parse_comment(i)
        end = raw.find("]]>", i) + 2 if raw.startswith("<![", i) and "]]>" in raw[i:] else -1
        if end < 0:
            whole = DECLARATION.match(raw, i + 2)
            end = whole.end() - 1 if whole else raw.find(">", i)
        return end + 1 if end >= 0 else len(raw)

    def parse_pi(self, i):
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else len(self.rawdata)

    def close(self):
        super().close()
        self._pop(1)

    def text(self) -> str:
        only_main = self.has_main and not (self.known and self.beside > self.inside)
        return " ".join("".join(self.main if only_main else self.all).split())


def read(html: str | None, low: frozenset[str] | None = None) -> Page:
    page = Page(low)
    page.feed(html or "")
    if TAG_BEGINS.match(page.rawdata):  # a tag that the page breaks off in
        page.rawdata = ""
    page.close()
    return page


def number(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def host(url: str = "url") -> F.Column:
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def style_nodes(pages: DataFrame) -> DataFrame:
    """Per page and style node: its parent and depth, its children's styles and
    its own text as hashes (null if it has none), and the whole page's hash."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "html"):
                out = [[], [], [], [], [], [], []]
                for site, html in zip(part.column("host").to_pylist(), part.column("html").to_pylist()):
                    whole = number(html or "")
                    for path, (parent, depth, children, own) in read(html).nodes.items():
                        text = " ".join("".join(own).split())
                        for col, v in zip(out, (site, path, parent, depth, number(" ".join(children)) if children else None,
                                                number(text) if text else None, whole)):
                            col.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), *(pa.array(c, pa.int64()) for c in out[1:])],
                                                 ["host", "path", "parent", "depth", "children", "content", "page"])

    return pages.mapInArrow(run, "host string, path long, parent long, depth long, children long, content long, page long")


def importance(nodes: DataFrame) -> DataFrame:
    """host, path, parent, depth, n (pages) and h, the node's own importance:
    the greater of its presentation's and its content's."""
    node = ["host", "path", "parent", "depth"]
    once = nodes.groupBy(*node, "children", "content", "page").agg(F.lit(1).alias("one"))
    value = F.explode(F.array(F.struct(F.lit("p").alias("kind"), F.col("children").alias("v")),
                              F.struct(F.lit("c").alias("kind"), F.col("content").alias("v"))))
    counts = (once.withColumn("x", value).where("x.v is not null")
              .groupBy(*node, F.col("x.kind").alias("kind"), F.col("x.v").alias("v")).agg(F.count(F.lit(1)).alias("c")))
    n = F.sum("c")
    entropy = F.log2(n) - F.sum(F.col("c") * F.log2("c")) / n
    return (counts.groupBy(*node, "kind").agg(n.alias("n"), F.when(n > 1, entropy / F.log2(n)).otherwise(1.0).alias("h"))
            .groupBy(*node).agg(F.max("n").alias("n"), F.max("h").alias("h")))


def branches(own: DataFrame, scratch: Scratch) -> DataFrame:
    """host, path, n and whether the node's branch is low: neither it nor a
    node below it is important.

    Important nodes mark all nodes above them.  After the step with links of
    2^k levels all are marked that lie fewer than 2^(k + 1) levels above, so a
    tree of any depth takes as many joins as its depth has binary digits."""
    own = scratch.save(own, "nodes")
    deepest = own.agg(F.max("depth")).first()[0] or 0
    marks = own.where(F.col("h") >= LOW).select("host", "path")
    up = own.where("parent != 0").select("host", "path", F.col("parent").alias("up"))
    for k in range(int(deepest).bit_length()):
        if k:  # links twice as long
            higher = up.select(F.col("host").alias("site"), F.col("path").alias("mid"), F.col("up").alias("top"))
            up = scratch.save(up.join(higher, (up["host"] == higher["site"]) & (up["up"] == higher["mid"]))
                              .select("host", "path", F.col("top").alias("up")), "up")
        above = marks.join(up, ["host", "path"]).select("host", F.col("up").alias("path"))
        marks = scratch.save(marks.union(above).distinct(), "marks")
    return own.join(marks.withColumn("marked", F.lit(True)), ["host", "path"], "left").select(
        "host", "path", "n", F.col("marked").isNull().alias("low"))


def main_text(pages: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """page_id, url, text, n_chars and the number of removed style branches."""
    scratch = scratch or Scratch(pages.sparkSession, "html")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html")).withColumn("host", host())
    tree = branches(importance(style_nodes(pages.select("host", "html"))), scratch)
    # One row per host with known entropies, even if it has no low branches.
    low = scratch.save(tree.where(F.col("n") >= MIN_PAGES).groupBy("host").agg(
        F.collect_list(F.when(F.col("low"), F.col("path"))).alias("low")), "low")
    size = low.agg(F.sum(8 * F.size("low") + F.octet_length("host"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        low = F.broadcast(low)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "html"):
                lows = [None if x is None else frozenset(x) for x in part.column("low").to_pylist()]
                text = [read(h, x).text() for h, x in zip(part.column("html").to_pylist(), lows)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(text, pa.string()),
                     pa.array(list(map(len, text)), pa.int64()), pa.array([len(x or ()) for x in lows], pa.int64())],
                    ["page_id", "url", "text", "n_chars", "low_branches"])

    return (pages.join(low, "host", "left").select("page_id", "url", "html", "low")
            .mapInArrow(run, "page_id long, url string, text string, n_chars long, low_branches long"))


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
