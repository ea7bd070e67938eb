"""Main text of web pages by removal of site templates.

A page is read into blocks of text, each with the hashes of the elements around
it that could be template. Hashes of container subtrees are counted per host, by
different pages; a container that recurs on a share of the pages of its host is
the site's template, and its blocks go, whether or not they lie in a marked
article. Pages of equal content count once, and a container in a marked article
counts once for each article that it is in, so copies of a text don't make it a
template.
Class names are hints: text that differs from page to page in an element named
like an advert or a comment list goes only if such an element is on different
pages of the host or on other hosts too, or if the host has too few pages to tell.
What the elements themselves tell counts as well: menus, scripts, hidden parts
and the like never hold the article; a form does if it is around the page's
prose. Of what is left, marked articles are taken if they are not dwarfed by the
rest of the page. The marked element itself is template only if it holds mostly
links, since an article may be published more than once.

Reading takes one pass over the page and time in proportion to its length.

Defined results: null or empty html gives an empty text; a page whose url has no
host is told by itself; unclosed, misnested or cut off markup is read as far as it goes, a tag
ending at the next < outside quotes; elements more than 512 deep belong to those
around them; a host of one or two different pages has no recurring containers; no
block is dropped for its length; repeated rows are pages of their own. Extra
columns are ignored.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialize, row_keyed

#: A container is template if it is on so many different pages of its host, or on all of them where there are fewer but three at least, ...
MIN_PAGES = 5
#: ... and on this share of them; an element with a telling name needs the share, and two pages at least.
SHARE = 0.01
#: Hosts on which such an element counts everywhere.
HOSTS = 3
DEEPEST = 512
# How elements are treated.
DROPPED = frozenset("script style noscript template iframe object svg canvas head nav footer aside button select option textarea input menu dialog audio video map".split())
RAW = frozenset("script style textarea title noscript iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("div section ul ol dl table header footer nav aside form figure details article main fieldset".split())
BLOCKS = CONTAINERS | frozenset("html body p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption blockquote pre address hr figcaption summary center hgroup".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li article main".split())
CLOSES_P = BLOCKS - frozenset("html body td th tr li dt dd thead tbody tfoot caption".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table article main section div body html nav footer aside header form".split())
#: Names that hint at template, and words that may stand beside them in a name.
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsored sponsor promo promotion banner sidebar sidenav menu nav navbar navigation breadcrumb breadcrumbs masthead footer "
    "comment comments commentlist disqus respond replies notice notices cookie cookies consent gdpr popup modal newsletter subscribe subscription social share sharing related recommended "
    "recommendations widget widgets toolbar pagination pager login signup search skip disclaimer copyright topbar".split()
)
BESIDE = frozenset(
    "box block list wrapper wrap container section area bar inner outer left right top bottom main site page primary secondary global form links link item items title header head slot unit "
    "space post posts article articles story stories thread reader user us on buttons button icons icon menu panel group policy col column row".split()
)
#: Words of names of a site's header, which hint outside articles.
HEADER = frozenset("header site top global main wrapper wrap container bar outer inner".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar".split())
NAME = re.compile(r"</?([a-zA-Z][^\s/><]*)")
MARK = re.compile("[\"'<>]")
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
SPACE = re.compile(r"[\x20\x09-\x0D\xa0]+")
CLOSE = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}


class Element:
    __slots__ = ("article", "dropped", "form", "hinted", "holds_root", "linked", "name", "parts", "pending", "root", "shell", "size", "start")

    def __init__(self, name: str, above: Element | None, start: int):
        self.name, self.start = name, start
        self.dropped = above.dropped if above else False
        self.article = above.article if above else 0  # number of the marked article around, 0 for none
        self.form = above.form if above else 0
        self.hinted = above.hinted if above else False
        self.root = self.holds_root = False
        self.shell: int | None = None
        self.parts: list[str] = []  # text and hashes of children in order, of which the subtree's hash is taken
        self.pending: list[tuple[int, bool]] = []  # hashes that count for this article or page, and whether of shells
        self.size = self.linked = 0


def signed(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def hint(value: str, in_article: bool = False) -> str | None:
    """The first of the names of a class or id that hints at template."""
    for name in value.lower().split():
        words = [w for w in re.split(r"[-_0-9]+", name) if w]
        if any(w in HINTS for w in words) and all(w in HINTS or w in BESIDE for w in words):
            return name
        if not in_article and "header" in words and HEADER.issuperset(words):
            return name
    return None


def told(name: str, attributes: str, in_article: bool) -> tuple[bool, str | None]:
    """(whether an element never holds the article, the name that hints at template)."""
    if name in DROPPED or (name == "header" and not in_article):
        return True, None
    found = None
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), a or b or c
        if key in ("class", "id"):
            found = found or (hint(value, in_article) if name not in ("html", "body", "article", "main") else None)
        elif (key == "role" and value.lower() in ROLES) or key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none", value)):
            return True, None
    return False, found


class Scanner:
    """The tags of a page. What is not there any more is remembered, so that no search is made twice over the rest."""

    def __init__(self, page: str):
        self.page, self.absent = page, set()

    def find(self, what: str, at: int) -> int:
        if what in self.absent:
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.absent.add(what)
        return found

    def tag_end(self, at: int) -> tuple[int, int]:
        """(end of the attributes, end of the tag) of the tag whose name ends at at."""
        page = self.page
        while mark := MARK.search(page, at):
            at = mark.start()
            if mark[0] == ">":
                return at, at + 1
            if mark[0] == "<":
                return at, at
            if page[max(0, at - 8) : at].rstrip()[-1:] == "=":
                close = self.find(mark[0], at + 1)
                at = close + 1 if close >= 0 else at + 1
            else:
                at += 1
        return len(page), len(page)


def read(page: str | None) -> tuple[list[str], list[list[int]], list[int], list[tuple[int | None, int, bool]]]:
    """(blocks, hashes around each, number of the article that each is in, (hash, hash of the content that it counts for, whether of a shell) of the page).

    Outside marked articles the number is 0, or -1 in an element with a telling
    name. A container counts for the innermost marked article around it, else for the
    page; the page itself is told by a hash of None. A shell is the element name
    and the telling name of an element.
    """
    blocks: list[str] = []
    around: list[list[int]] = []
    inside: list[int] = []
    forms: list[tuple[int, bool]] = []  # the form that each block is in, and whether it is prose
    wrapping: set[int] = set()  # forms that hold a marked article
    every: list[tuple[int | None, int, bool]] = []
    if not page:
        return blocks, around, inside, every
    scan, stack, held = Scanner(page), [Element("", None, 0)], []
    opened: dict[str, int] = {}
    links = articles = in_forms = at = 0
    size = len(page)

    def flush() -> None:
        if held:
            text = SPACE.sub(" ", entities.unescape("".join(held))).strip(" ")
            held.clear()
            if text and not stack[-1].dropped:
                blocks.append(text)
                around.append([])
                inside.append(stack[-1].article or -stack[-1].hinted)
                forms.append((stack[-1].form, stack[-1].name in PROSE))

    def pop() -> None:
        element = stack.pop()
        opened[element.name] -= 1
        above = stack[-1]
        above.size += element.size
        above.linked += element.linked
        above.holds_root |= element.holds_root
        value = signed("\0".join([element.name, *element.parts]))
        above.parts.append(f"<{value}")
        if element.name in CONTAINERS and element.size:
            every.extend((x, value, shell) for x, shell in element.pending)
            if not element.root or 2 * element.linked >= element.size:
                outer = next((e for e in reversed(stack) if e.root), stack[0]) if element.article and not element.root else stack[0]
                outer.pending.append((value, False))
                for i in range(element.start, len(blocks)):
                    around[i].append(value)
        if element.shell is not None and not element.holds_root:
            stack[0].pending.append((element.shell, True))
            for i in range(element.start, len(blocks)):
                around[i].append(element.shell)

    def close_to(i: int) -> None:
        while len(stack) > i:
            pop()

    while at < size:
        found = page.find("<", at)
        end = found if found >= 0 else size
        name = NAME.match(page, end) if found >= 0 else None
        if found >= 0 and not name and page[end + 1 : end + 2] not in ("!", "?", "/"):
            end += 1  # a lone <
        if end > at:
            text = page[at:end]
            held.append(text)
            if not text.isspace():
                stack[-1].parts.append(text)
                stack[-1].size += len(text)
                stack[-1].linked += len(text) if links else 0
        if found < 0:
            break
        if end > found:
            at = end
            continue
        if not name:
            close = scan.find("-->", end + 4) if page.startswith("<!--", end) else scan.find(">", end)
            at = size if close < 0 else close + (3 if page.startswith("<!--", end) else 1)
            continue
        stop, at = scan.tag_end(name.end())
        closing, name, attributes = page[end + 1] == "/", name[1].lower(), page[name.end() : stop]
        if closing:
            if name == "a":
                links = max(0, links - 1)
            if opened.get(name):
                flush()
                close_to(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name))
            continue
        if name == "br":
            held.append(" ")
            continue
        if name == "a":
            links += 1
        if name in VOID:
            if name == "hr":
                flush()
            continue
        if name in RAW:
            close = CLOSE[name].search(page, at)
            at = close.end() if close else size
            continue
        drop, named = told(name, attributes, bool(stack[-1].article)) if attributes or name in DROPPED or name == "header" else (False, None)
        if (name not in BLOCKS and not drop and not named) or len(stack) > DEEPEST:
            continue
        flush()
        if name in CLOSES_P and opened.get("p"):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == "p":
                    close_to(i)
                    break
                if stack[i].name in SCOPES:
                    break
        if name in SIBLINGS and any(opened.get(x) for x in SIBLINGS[name]):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in SIBLINGS[name]:
                    close_to(i)
                    break
                if stack[i].name in SCOPES:
                    break
        if attributes.rstrip().endswith("/") and name not in BLOCKS:
            stack[-1].parts.append(f"<{name}")
            continue
        element = Element(name, stack[-1], len(blocks))
        element.dropped |= drop
        if name in ("article", "main") and not element.dropped:
            if not stack[-1].article:
                articles += 1
                element.article = articles
            element.root = element.holds_root = True
            wrapping.add(element.form)
        if name == "form":
            in_forms += 1
            element.form = in_forms
        if named and not element.dropped:
            element.shell, element.hinted = signed(f"{name} {named}"), True
        stack.append(element)
        opened[name] = opened.get(name, 0) + 1
        links = links if name not in CONTAINERS else 0
    flush()
    close_to(1)
    content = signed("\0".join(stack[0].parts))
    every.extend((x, content, shell) for x, shell in [(None, False), *stack[0].pending])
    if in_forms:
        prose = sum(len(t) for t, (_, p) in zip(blocks, forms, strict=True) if p)
        sums = dict.fromkeys(range(1, in_forms + 1), 0)
        for t, (f, p) in zip(blocks, forms, strict=True):
            if f and p:
                sums[f] += len(t)
        kept = [i for i, (f, _) in enumerate(forms) if not f or f in wrapping or 2 * sums[f] > prose]
        blocks, around, inside = [blocks[i] for i in kept], [around[i] for i in kept], [inside[i] for i in kept]
    return blocks, around, inside, every


def main_blocks(texts: list[str], articles: list[int]) -> list[str]:
    """The blocks of marked articles if the largest is not dwarfed by the rest of the page without what has a telling name, else all blocks."""
    sizes: dict[int, int] = {}
    for text, number in zip(texts, articles, strict=True):
        sizes[number] = sizes.get(number, 0) + len(text)
    rest, _ = sizes.pop(0, 0), sizes.pop(-1, 0)
    if sizes and 2 * max(sizes.values()) >= rest:
        return [t for t, a in zip(texts, articles, strict=True) if a > 0]
    return texts


def host_of(url: str = "url") -> Column:
    return F.coalesce(F.lower(F.regexp_extract(F.col(url).cast("string"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def counted(pages: DataFrame) -> DataFrame:
    """(row_id, host, hash, content, shell) of the containers and shells of pages (row_id, host, html); each page has a row without hash."""

    def run(table: pa.Table) -> pa.Table:
        rows = [(r, h, *x) for r, h, t in zip(*(table.column(c).to_pylist() for c in ("row_id", "host", "html")), strict=True) for x in dict.fromkeys(read(t)[3] or [(None, 0, False)])]
        row, host, value, content, shell = zip(*rows, strict=True)
        return pa.table({"row_id": pa.array(row, pa.int64()), "host": pa.array(host, pa.string()), "hash": pa.array(value, pa.int64()), "content": pa.array(content, pa.int64()), "shell": pa.array(shell, pa.bool_())})

    return map_batches(pages, run, "row_id long, host string, hash long, content long, shell boolean")


def templates(found: DataFrame, *, min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """(host, hash) of containers and shells on enough different pages of a host."""
    seen = found.select("host", "hash", "shell", "content").distinct()
    counts = materialize(seen.groupBy("host", "hash", "shell").agg(F.count(F.lit(1)).alias("n")), "html-counts")
    pages = counts.where("hash is null").select("host", F.col("n").alias("pages"))
    known = F.col("host") != ""
    enough = known & (F.col("n") >= F.greatest(F.least(F.lit(min_pages), F.greatest("pages", F.lit(3))), F.lit(share) * F.col("pages")))
    named = ~known | (F.col("pages") < 3) | (F.col("n") >= F.greatest(F.lit(2.0), F.lit(share) * F.col("pages"))) | F.col("wide").isNotNull()
    wide = counts.where("shell and host <> ''").groupBy("hash").agg(F.count(F.lit(1)).alias("wide")).where(F.col("wide") >= HOSTS)
    found = counts.where("hash is not null").join(pages, "host").join(wide, "hash", "left")
    return found.where(F.when(F.col("shell"), named).otherwise(enough)).select("host", "hash")


def extract(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """page_id, url and text of every row of pages, and how many blocks were template."""
    rows, row = row_keyed(pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).cast("string").alias("html")), "page_id", "html-input")
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    found = materialize(counted(rows.select(F.col(row).alias("row_id"), host_of().alias("host"), "html")), "html-counted")
    site = materialize(templates(found, min_pages=min_pages, share=share), "html-templates")
    hits = found.where("hash is not null").join(site, ["host", "hash"]).groupBy("row_id").agg(F.collect_set("hash").alias("site"))

    def split(table: pa.Table) -> pa.Table:
        read_pages = [read(t)[:3] for t in table.column("html").to_pylist()]
        blocks = [[{"text": t, "article": i, "hashes": list(dict.fromkeys(a))} for t, a, i in zip(*found, strict=True)] for found in read_pages]
        kind = pa.list_(pa.struct([("text", pa.string()), ("article", pa.int32()), ("hashes", pa.list_(pa.int64()))]))
        return table.drop_columns(["html"]).append_column("blocks", pa.array(blocks, kind))

    def join(table: pa.Table) -> pa.Table:
        texts, gone = [], []
        for blocks, site in zip(table.column("blocks").to_pylist(), table.column("site").to_pylist(), strict=True):
            kept = [b for b in blocks if not site or not set(site).intersection(b["hashes"])]
            texts.append("\n".join(main_blocks([b["text"] for b in kept], [b["article"] for b in kept])))
            gone.append(len(blocks) - len(kept))
        return pa.table({"page_id": table.column("page_id"), "url": table.column("url"), "text": pa.array(texts, pa.string()), "n_template_blocks": pa.array(gone, pa.int32())})

    blocks = map_batches(rows.select(F.col(row).alias("row_id"), "page_id", "url", "html"), split, f"row_id long, page_id {kinds['page_id']}, url {kinds['url']}, blocks array<struct<text: string, article: int, hashes: array<long>>>")
    told_pages = blocks.join(hits.hint("merge"), "row_id", "left").select("page_id", "url", "blocks", "site")
    return map_batches(told_pages, join, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_template_blocks int")
