"""Main-text extraction with site style trees.

Every page is parsed into blocks, each with the path of its elements (tag, class, id: its presentation) and a hash of its
content. The pages of a host are merged into one style tree: for each path the number of different pages m that have it,
and for each content under it the number k of them that show it. The importance of content is 1 - log k / log m, that is,
one less the normalised entropy of its spread over the host's pages: 0 where all show the same, 1 where no other page
does. A path's importance is the mean of its contents'. Branches of low importance are removed from each page.

Besides, branches whose presentation names what they are (nav, footer, class "ad", ...) have no importance on any host,
and where a page has an article or main element its text comes from there alone, with a stricter limit for content.
Copies and near copies of a page's content on a host count as one page of the tree, so many editions of an article don't make
it a menu: pages that agree in one of BANDS groups of min-hashes over runs of words are linked, and linked pages are one. Runs of
RUN words that two pages share to 90 % link them with 99.99 %, to 80 % with 95 %, to 50 % with 6 %.

Defined results: null or empty html gives an empty text; a null or odd url is a host of its own name (empty); pages with the
same page_id are each extracted; hosts with few pages lose nothing by entropy.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, column_list, prepare, small
from tessera.llm.components import components

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""", re.S)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[a-z0-9]+")
_WORD = re.compile(r"\w+")
RUN, BANDS, ROWS = 4, 16, 8
_FACTORS = np.random.default_rng(11).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ORDER = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)  # of the words in a run

# Element names of the HTML standard by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter output progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
DROPPED = frozenset("script style textarea title noscript template iframe xmp noembed noframes nav footer aside form button select option menu dialog svg math canvas object audio video map head".split())
MAIN = frozenset(["article", "main"])
# Words in class, id or role that name boilerplate.
NOISE = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar side aside footer foot masthead topbar toolbar "
    "cookie cookies consent notice notices gdpr popup modal overlay newsletter subscribe subscription signup login share sharing social comment comments reply replies respond disqus related recommended recommendations "
    "widget widgets pager pagination skip search copyright legal contentinfo complementary form".split()
)
CLOSED_BY = {  # an open element of the key ends where one of these starts
    "p": frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"]),
}


def host_of(url: str | None) -> str:
    return re.sub(r"^[a-z][a-z0-9+.\-]*://", "", url or "", flags=re.I).split("/")[0].split("?")[0].split("#")[0].split("@")[-1].lower()


class Block:
    __slots__ = ("inside", "path", "text")

    def __init__(self, path: str, text: str, inside: bool) -> None:
        self.path, self.text, self.inside = path, text, inside

    def key(self) -> int:
        """Signed 64-bit code of presentation and content together."""
        return xxhash.xxh3_64_intdigest(f"{self.path}\x00{self.text}".encode("utf-8", "surrogatepass")) - (1 << 63)


def blocks_of(page: str) -> list[Block]:
    """Blocks with text in page order, without branches that name themselves as noise. One pass over the tags."""
    out: list[Block] = []
    stack: list[tuple[str, str, bool, bool]] = []  # tag, path, dropped, inside an article
    parts: list[str] = []

    def flush() -> None:
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            parts.clear()
            if text and not (stack and stack[-1][2]):
                out.append(Block(stack[-1][1] if stack else "", text, bool(stack) and stack[-1][3]))

    at, end = 0, len(page)
    inline_open: list[str] = []
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            tail = page[at:]
            cut = re.search(r"<[a-zA-Z/!?]", tail)  # an unfinished tag at the very end is no text
            parts.append(tail[: cut.start()] if cut else tail)
            break
        if m.start() > at:
            parts.append(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag in RAW and not closing:
            stop = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            if stop is None:
                at = end
            else:
                close = page.find(">", stop.start())
                at = end if close < 0 else close + 1
            continue
        if tag in INLINE:
            if tag == "label" or tag == "img":
                parts.append(" ")
            if not closing and attributes and tag not in VOID and _noise(attributes):
                flush()
                stack.append((tag, (stack[-1][1] if stack else "") + "/" + tag, True, bool(stack) and stack[-1][3]))
                inline_open.append(tag)
            elif closing and inline_open and inline_open[-1] == tag and stack and stack[-1][0] == tag:
                flush()
                stack.pop()
                inline_open.pop()
            continue
        if tag == "br":
            parts.append(" ")
            continue
        flush()
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        while stack and tag in CLOSED_BY.get(stack[-1][0], ()):
            stack.pop()
        if tag in VOID:
            continue
        above = stack[-1] if stack else ("", "", False, False)
        if tag in ("html", "body"):
            if above[0] == "head":
                stack.pop()
            if any(s[0] == tag for s in stack):
                continue
            above = stack[-1] if stack else ("", "", False, False)
        names = _names(attributes) if attributes else ""
        main = tag in MAIN or "role=main" in names
        dropped = above[2] or tag in DROPPED or (tag == "header" and not above[3]) or (bool(names) and not main and tag not in ("html", "body") and _noise(attributes))
        stack.append((tag, f"{above[1]}/{tag}{names}", dropped, (above[3] or main) and not dropped))
        if attributes.rstrip().endswith("/") and tag in ("svg", "math"):
            stack.pop()
    flush()
    return out


def _names(attributes: str) -> str:
    return "".join(sorted(f".{k.lower()}={' '.join(sorted((a or b or c).lower().split()))}" for k, a, b, c in _NAMED.findall(attributes)))


def _noise(attributes: str) -> bool:
    return any(NOISE & set(_PARTS.findall((a or b or c).lower())) for _, a, b, c in _NAMED.findall(attributes))


def _parsed(text: str | None) -> list[Block]:
    return blocks_of(text) if text else []


def bands_of(text: str) -> list[int]:
    """Signed 64-bit codes of the groups of min-hashes of a page's content; none without words."""
    words = [xxhash.xxh3_64_intdigest(w) for w in _WORD.findall(text.lower())]
    if not words:
        return []
    coded = np.array(words + [0] * (RUN - len(words)), np.uint64)
    runs = sum((coded[k : len(coded) - RUN + 1 + k] * _ORDER[k] for k in range(RUN)), np.zeros(len(coded) - RUN + 1, np.uint64))
    runs ^= runs >> np.uint64(32)
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for k in range(0, len(runs), 4096):
        np.minimum(least, (runs[None, k : k + 4096] * _FACTORS[:, None]).min(axis=1), out=least)
    return [xxhash.xxh3_64_intdigest(band.tobytes()) - (1 << 63) for band in least.reshape(BANDS, ROWS)]


def style_tree(pages: DataFrame) -> DataFrame:
    """The merged trees: host, path_hash, key (presentation and content), inside (an article), k and m, both in different pages."""
    prepare(pages.sparkSession)
    scratch = Scratch(pages.sparkSession, "nearpages")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths, keys, inside, whole = [], [], [], [], []
            for url, text in zip(column_list(batch, "url"), column_list(batch, "html"), strict=True):
                blocks = _parsed(text)
                host = host_of(url)
                content = "\x00".join(b.text for b in blocks if b.inside) or "\x00".join(b.text for b in blocks)
                page = xxhash.xxh3_64_intdigest(f"{host}\x00\x00{content}".encode("utf-8", "surrogatepass")) - (1 << 63)
                rows = [(xxhash.xxh3_64_intdigest(b.path) - (1 << 63), key, b.inside) for key, b in {b.key(): b for b in blocks}.items()]
                rows += [(k, band, None) for k, band in enumerate(bands_of(content))]  # the bands: neither inside nor outside
                for path, key, place in rows:
                    hosts.append(host)
                    paths.append(path)
                    keys.append(key)
                    inside.append(place)
                    whole.append(page)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.int64()), pa.array(keys, pa.int64()), pa.array(inside, pa.bool_()), pa.array(whole, pa.int64())], names=["host", "path_hash", "key", "inside", "page"])

    rows = scratch.keep(pages.select("url", "html").mapInArrow(run, "host string, path_hash long, key long, inside boolean, page long").distinct(), "rows")
    bands = rows.where("inside is null")
    # A band's pages are linked to the least one, which is a partial aggregate joined back: no group is gathered.
    least = bands.groupBy("host", "path_hash", "key").agg(F.min("page").alias("least"), F.max("page").alias("most")).where("least <> most")
    edges = bands.join(least, ["host", "path_hash", "key"]).where("page <> least").select(F.col("page").alias("a"), F.col("least").alias("b"))
    one = components(edges, scratch, "near").select(F.col("id").alias("page"), "component")
    blocks = rows.where("inside is not null")
    seen = blocks.join(small(one), "page", "left").select("host", "path_hash", "key", "inside", F.coalesce("component", "page").alias("page")).distinct()
    # Distinct rows are counted by key first; a path's pages are then at most the sum over its keys, counted apart.
    by_key = seen.groupBy("host", "path_hash", "key", "inside").agg(F.count(F.lit(1)).alias("k"))
    by_path = seen.select("host", "path_hash", "page").distinct().groupBy("host", "path_hash").agg(F.count(F.lit(1)).alias("m"))
    return by_key.where("k > 1").join(by_path, ["host", "path_hash"])


def low_importance(tree: DataFrame, limit: float = 0.3, limit_inside: float = 0.05, least_pages: int = 8, least_pages_inside: int = 20) -> DataFrame:
    """host, keys: contents (with their presentation) whose importance on the host is below the limit.

    A key of such a host is on m ** (1 - limit) of a path's m pages at least, so a host's list has at most a page's mean
    number of blocks times m ** limit entries.
    """
    importance = 1 - F.log("k") / F.log("m")
    low = tree.where(F.when(F.col("inside"), (F.col("m") >= least_pages_inside) & (importance < limit_inside)).otherwise((F.col("m") >= least_pages) & (importance < limit)))
    return low.groupBy("host").agg(F.collect_set("key").alias("low"))


def main_text(blocks: list[Block], low: frozenset[int] | set[int] = frozenset()) -> str:
    """Text of the page's important branches, blocks joined by a blank."""
    chosen = [b for b in blocks if b.inside] or blocks
    return " ".join(b.text for b in chosen if not low or b.key() not in low)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, host, text, n_chars of every row of pages (page_id, url, html)."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "styletree")
    low = scratch.keep(low_importance(style_tree(pages)), "low").select(F.col("host").alias("_host"), "low")
    host = F.lower(F.element_at(F.split(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*://)?([^/?#]*)", 1), "@"), -1))
    joined = pages.select("page_id", "url", "html", host.alias("host")).join(small(low), F.col("host") == F.col("_host"), "left").select("page_id", "url", "host", "html", "low")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(_parsed(text), set(low or ())) for text, low in zip(column_list(batch, "html"), column_list(batch, "low"), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "host", "text", "n_chars"])

    return joined.mapInArrow(run, "page_id long, url string, host string, text string, n_chars long")
