"""Main text of web pages, with a style tree per site.

The elements of all pages of a host are merged into one tree by their tags, classes and ids. An element node's
importance mixes how much its presentation (the sequence of its children) varies between pages with how much
the texts below it do: a text on every page has entropy 1 and importance 0, one on a single page importance 1.
Branches of low importance are the site's template and are removed from each page, together with parts whose
tag, role or class says that they are no article: menus, headers, footers, side bars, notices, adverts, forms
and reader comments. What the page marks as its article is kept as a whole unless a branch in it is template.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.session import materialize

#: Branches below this importance are template, on hosts of at least so many pages.
LEAST_IMPORTANCE, LEAST_PAGES = 0.2, 5
#: How fast the weight of the children falls with the number of presentations.
DAMPING = 0.9
#: Parts that the pages of a host are spread over.
SLICES = 64
#: Elements nested deeper belong to the node at this depth.
DEPTH = 64

# fixed values of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math object canvas audio video select".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul caption".split()
)
SPACED = frozenset(("br", "td", "th"))
#: An opening tag of these ends an open element of the tag itself, up to the container named.
CLOSES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",)}
BY_TAG = frozenset("nav footer aside form button dialog header menu head".split())
BY_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
BY_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|notification|popup|modal|"
    r"overlay|nav|navbar|navigation|menu|menubar|breadcrumbs?|sidebar|side|footer|header|masthead|topbar|comments?|commentlist|"
    r"respond|repl(?:y|ies)|disqus|share|sharing|social|related|recommend\w*|newsletter|subscribe|signup|login|search|"
    r"widgets?|toolbar|pagination|pager|skip-?link|legal|copyright)(?:$|[\s_-])"
)
#: Of an article itself, only these names count.
OTHER_ARTICLES = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|comments?|repl(?:y|ies)|related|recommend\w*)(?:$|[\s_-])")
#: Names that speak of the layout around an element, not of the element.
LAYOUT = re.compile(r"(?:^|\s)(?:has|no|with|without|is)[-_]\S*")
HEADERS = re.compile(r"(?:^|[\s_-])header(?:$|[\s_-])")

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]{0,5000}\"|'[^']{0,5000}')*|[^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


@dataclass
class Page:
    """Elements in page order, parents before children, and texts with their element and block."""

    parents: list[int] = field(default_factory=lambda: [-1])
    tags: list[str] = field(default_factory=lambda: [""])
    paths: list[int] = field(default_factory=lambda: [0])
    depths: list[int] = field(default_factory=lambda: [0])
    dropped: list[bool] = field(default_factory=lambda: [False])
    texts: list[tuple[int, int, str]] = field(default_factory=list)


def _signed(text: str, seed: int) -> int:
    value = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), seed=seed & 0xFFFFFFFF)
    return value - (1 << 64) if value >> 63 else value


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), html.unescape(a or b or c))
    return found


def _unwanted(tag: str, own: dict[str, str], in_article: bool) -> bool:
    """Whether tag, role or names say that the element is no part of an article."""
    names = LAYOUT.sub(" ", f"{own.get('class', '')} {own.get('id', '')}".lower())
    if tag in ("html", "body", "main"):
        return False
    if "hidden" in own or own.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", own.get("style", ""), re.I):
        return True
    if in_article and (tag == "header" or HEADERS.search(names)):
        return False
    if tag == "article":
        return bool(OTHER_ARTICLES.search(names))
    return tag in BY_TAG or own.get("role", "").lower() in BY_ROLE or bool(BY_NAME.search(names))


def parse(source: str) -> Page:
    """The page's tree; unclosed, stray and misnested tags are taken as browsers do, in the main."""
    page, stack, block, at = Page(), [0], 0, 0

    def say(text: str) -> None:
        if text:
            page.texts.append((stack[-1], block, text))

    def close(tag: str, within: tuple[str, ...] = ()) -> None:
        for i in range(len(stack) - 1, 0, -1):
            name = page.tags[stack[i]]
            if name == tag:
                del stack[i:]
                return
            if name in within:
                return

    size = len(source)
    while at < size:
        found = _TAG.search(source, at)
        say(html.unescape(source[at : found.start() if found else size]))
        if not found:
            break
        at = found.end()
        if not found[2]:
            if found[0].startswith("<![CDATA["):
                say(found[0][9:].removesuffix("]]>"))
            continue
        tag = found[2].lower()
        block += tag in BLOCKS
        if tag in SPACED:
            say(" ")
        if found[1]:
            close(tag)
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(source, at)
            at = end.end() if end else size
            continue
        if tag in VOID:
            continue
        if tag in BLOCKS:
            close("p", ("button", "table", "td", "th", "caption", "li"))
        if tag in CLOSES:
            close(tag, CLOSES[tag])
            if tag in ("dt", "dd", "td", "th"):
                close({"dt": "dd", "dd": "dt", "td": "th", "th": "td"}[tag], CLOSES[tag])
        own = _attributes(found[3]) if found[3].strip(" /") else {}
        parent = stack[-1]
        label = f"{tag}.{own.get('class', '')}#{re.sub(r'[0-9]+', '0', own.get('id', ''))}"
        deep = page.depths[parent] >= DEPTH
        page.paths.append(page.paths[parent] if deep else _signed(label, page.paths[parent]))
        page.depths.append(page.depths[parent] if deep else page.depths[parent] + 1)
        page.parents.append(parent)
        page.tags.append(tag)
        page.dropped.append(_unwanted(tag, own, any(page.tags[i] == "article" for i in stack)))
        stack.append(len(page.tags) - 1)
    return page


def _articles(page: Page) -> list[int]:
    """Elements that hold the page's article: unwanted ones are left out, articles go before main."""
    unwanted = [False] * len(page.tags)
    for i in range(1, len(page.tags)):
        # a form or box around a whole page is no reason to drop its article
        own = page.dropped[i] and page.tags[i] != "form"
        unwanted[i] = unwanted[page.parents[i]] or own
    for tag in ("article", "main"):
        if found := [i for i, t in enumerate(page.tags) if t == tag and not unwanted[i]]:
            return found
    return []


def main_text(page: Page, template: frozenset[int] = frozenset()) -> str:
    """Blocks of the article in page order, less unwanted parts and branches of ``template``."""
    articles = set(_articles(page))
    holds = [False] * len(page.tags)
    inside = [False] * len(page.tags)
    # an article that is the same on most pages is no template of itself
    shared = [False] * len(page.tags)
    for i in articles:
        while i >= 0 and not holds[i]:
            holds[i] = True
            i = page.parents[i]
    gone = [False] * len(page.tags)
    for i in range(1, len(page.tags)):
        parent = page.parents[i]
        inside[i] = inside[parent] or i in articles
        shared[i] = shared[parent] or i in articles and page.paths[i] in template
        weak = page.paths[i] in template and not shared[i] and page.tags[i] not in ("html", "body")
        gone[i] = gone[parent] or ((page.dropped[i] or weak) and not holds[i])
    blocks: dict[int, list[str]] = {}
    for element, block, text in page.texts:
        if not gone[element] and (inside[element] or not articles):
            blocks.setdefault(block, []).append(text)
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def host_of(url: str | None) -> int:
    found = _HOST.match(url or "")
    return _signed(found[1].lower() if found else "", 0)


# kinds of counted rows
PAGES, TEXT, CHILDREN, ABOVE = 0, 1, 2, 3


def _features(page: Page) -> Iterator[tuple[int, int, int]]:
    """(kind, path, what) of one page, each once."""
    children: dict[int, list[str]] = {}
    for i in range(1, len(page.tags)):
        children.setdefault(page.parents[i], []).append(str(page.paths[i]))
    own: dict[int, list[str]] = {}
    for element, _, text in page.texts:
        own.setdefault(element, []).append(text)
    seen = set()
    for i in range(1, len(page.tags)):
        if line := " ".join("".join(own.get(i, ())).split()):
            seen.add((TEXT, page.paths[i], _signed(line, 1)))
        seen.add((CHILDREN, page.paths[i], _signed(" ".join(dict.fromkeys(children.get(i, ()))), 2)))
        above = i
        while above > 0:
            seen.add((ABOVE, page.paths[i], page.paths[above]))
            above = page.parents[above]
    yield (PAGES, 0, 0)
    yield from seen


def _count_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts: Counter = Counter()
        for url, source in zip(batch["url"], batch["html"], strict=True):
            host = host_of(url)
            counts.update((host, *f) for f in _features(parse(source or "")))
        yield pd.DataFrame(
            [(*k, n) for k, n in counts.items()], columns=["host", "kind", "path", "what", "n"]
        )


def templates(pages: DataFrame) -> DataFrame:
    """(host, paths): per host the nodes of low importance. Hosts without one are left out."""
    rows = pages.select("url", "html").mapInPandas(_count_rows, "host long, kind int, path long, what long, n long")
    counts = materialize(rows.groupBy("host", "kind", "path", "what").agg(F.sum("n").alias("n")), "features")
    sites = counts.filter(F.col("kind") == PAGES).select("host", F.col("n").alias("m"))
    sites = sites.filter(F.col("m") >= LEAST_PAGES)
    known = counts.join(sites, "host")
    spread = F.log("n") / F.log("m")
    texts = known.filter(F.col("kind") == TEXT).groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("texts"), F.sum(1 - spread).alias("varied")
    )
    shapes = known.filter(F.col("kind") == CHILDREN)
    totals = shapes.groupBy("host", "path").agg(F.sum("n").alias("total"))
    share = F.col("n") / F.col("total")
    forms = shapes.join(totals, ["host", "path"]).groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("forms"), F.sum(-share * F.log(share) / F.log("m")).alias("form_spread")
    )
    above = counts.filter(F.col("kind") == ABOVE).select("host", "path", F.col("what").alias("node"))
    below = (
        texts.join(above, ["host", "path"])
        .groupBy("host", "node")
        .agg((F.sum("varied") / F.sum("texts")).alias("content"))
        .withColumnRenamed("node", "path")
    )
    weight = F.pow(F.lit(DAMPING), F.col("forms"))
    importance = (1 - weight) * F.col("form_spread") + weight * F.col("content")
    weak = below.join(forms, ["host", "path"]).filter(importance < LEAST_IMPORTANCE)
    return weak.groupBy("host").agg(F.collect_set("path").alias("paths"))


def _host(url: Column) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(host_of, na_action=None)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "long")(url)


def _text_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [
            main_text(parse(source or ""), frozenset(() if paths is None else (int(p) for p in paths)))
            for source, paths in zip(batch["html"], batch["paths"], strict=True)
        ]
        yield pd.DataFrame(
            {"page_id": batch["page_id"].astype("Int64"), "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]}
        )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html).

    Blocks are trimmed, have single spaces inside, and are joined by line feeds; a line break or table cell
    inside a block is a space. A null or empty html has an empty text. Pages without a host in their url
    belong to one host without name. Rows that repeat are separate pages. Other columns are dropped.
    """
    own = pages.select("page_id", "url", "html")
    found = templates(own)
    # a host may have a third of all pages: it is cut into slices, each meeting a copy of the host's row
    sliced = own.withColumn("host", _host(F.col("url"))).withColumn("slice", F.pmod(F.xxhash64("page_id", "html"), F.lit(SLICES)))
    copies = found.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SLICES - 1).cast("long"))))
    joined = sliced.join(copies, ["host", "slice"], "left")
    return joined.select("page_id", "url", "html", "paths").mapInPandas(
        _text_rows, "page_id long, url string, text string, n_chars long"
    )
