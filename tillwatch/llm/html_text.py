"""Main text of HTML pages, by markup and by differencing against the nearest URL.

Parsing cuts a page into text blocks and drops what markup names as something else than the
article (menus, page headers and footers, sidebars, notices, adverts, forms, scripts, styles,
reader comments). Pages are then put in order of host and path, and a page's blocks are
aligned with those of the neighbour whose path shares the longer prefix: blocks in a longest
common subsequence of both are the site's template and go, if there is further evidence, as
revised, print or parameter versions of one article share its paragraphs too. Evidence is that
the block is also on another of the two pages before and after, whose path is not that of a
version, or that the page itself repeats it. Blocks inside an ``article`` or
``main`` element are protected from that, because neighbours do repeat article paragraphs, and
where a page has such blocks they are its main text. Several versions under paths of their own
are not told from pages of one template. Differencing alone cannot give right
results here: menus, adverts and footers differ from page to page.

The order comes from one range-partitioned sort of narrow rows (URL and block hashes). A
neighbour across a partition's edge is found through a table of one row per partition, so a
host with a third of all pages spreads over many tasks.

Defined results: a null or empty page has no text; white space of any kind inside a block is
one blank; a page of which differencing would leave nothing is a mirror of its neighbour and
keeps its blocks; a host's only page is compared with none; pages without a host (null URL or
no ``://``) are compared with none; repeated pages are pages of their own; other columns are
ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.llm.common import small
from tillwatch.llm.url_filter import parts
from tillwatch.session import written

BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu"
    " nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
# Elements that hold no article text, and those that hold none outside an article.
DROPPED_TAGS = frozenset(
    "script style noscript template head title nav aside footer form button select textarea input"
    " iframe object svg canvas dialog menu datalist audio video map".split())
DROPPED_OUTSIDE = frozenset({"header"})
# Words of class and id values, and roles, that mark such elements.
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie"
    " cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription"
    " signup login paywall comment comments commentlist disqus respond reply replies share sharing social"
    " related recommended recommendations widget widgets pagination pager breadcrumb breadcrumbs".split())
DROPPED_WORDS_OUTSIDE = frozenset(
    "nav navbar navigation menu menubar header masthead footer sidebar side aside toolbar topbar".split())
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
# Elements that a new one of the same kind ends, up to the nearest of the second kind.
ENDED_BY_OWN_KIND = {
    "li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
    "th": {"tr", "table"}, "option": {"select"},
}
_name_words = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])").findall


class _Page(HTMLParser):
    """Collects (text, protected) blocks."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, bool]] = []  # tag, dropped, inside an article
        self.blocks: list[tuple[str, bool]] = []
        self.text: list[str] = []

    def _end_block(self) -> None:
        if self.text:
            words = " ".join("".join(self.text).split())
            if words:
                self.blocks.append((words, bool(self.open) and self.open[-1][2]))
            self.text = []

    def _close(self, at: int) -> None:
        if any(tag in BLOCK_TAGS for tag, _, _ in self.open[at:]):
            self._end_block()
        del self.open[at:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.handle_data("\n")
        if tag in BLOCK_TAGS:
            for at in range(len(self.open) - 1, -1, -1):
                if self.open[at][0] == "p":
                    self._close(at)
                    break
                if self.open[at][0] in BLOCK_TAGS:
                    break
            self._end_block()
        if tag in ENDED_BY_OWN_KIND:
            for at in range(len(self.open) - 1, -1, -1):
                if self.open[at][0] == tag:
                    self._close(at)
                    break
                if self.open[at][0] in ENDED_BY_OWN_KIND[tag]:
                    break
        if tag in VOID_TAGS:
            return
        given = {k: v or "" for k, v in attrs}
        dropped, inside = self.open[-1][1:] if self.open else (False, False)
        inside = inside or tag in ("article", "main") or given.get("role", "").lower() in ("article", "main")
        names = {w.lower() for key in ("class", "id") for w in _name_words(given.get(key, ""))}
        dropped = dropped or (
            tag in DROPPED_TAGS or bool(names & DROPPED_WORDS) and tag not in ("html", "body", "article", "main")
            or given.get("role", "").lower() in DROPPED_ROLES
            or "hidden" in given or given.get("aria-hidden", "").lower() == "true"
            or "display:none" in given.get("style", "").replace(" ", "").lower()
            or not inside and (tag in DROPPED_OUTSIDE or bool(names & DROPPED_WORDS_OUTSIDE)
                               and tag not in ("html", "body")))
        self.open.append((tag, dropped, inside))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_data("\n")
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                self._close(at)
                return
        if tag in BLOCK_TAGS:
            self._end_block()

    def handle_data(self, data: str) -> None:
        if not (self.open and self.open[-1][1]):
            self.text.append(data)

    def finish(self) -> list[tuple[str, bool]]:
        self.close()
        self._end_block()
        return self.blocks


def blocks_of(html: str | None) -> list[tuple[str, bool]]:
    """(text, protected) of every block that markup does not drop, in page order."""
    page = _Page()
    page.feed(html or "")
    return page.finish()


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts, protected, hashes = [], [], []
        for html in batch["html"]:
            blocks = blocks_of(html)
            own = [t for t, inside in blocks if inside]
            texts.append(own or [t for t, _ in blocks])
            protected.append(bool(own))
            hashes.append([] if own else [
                int.from_bytes(blake2b(t.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)
                for t, _ in blocks])
        yield batch.drop(columns="html").assign(blocks=texts, protected=protected, hashes=hashes)


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``: the longest run of rising
    partners, taking each line's partners from the last to the first."""
    where: dict[int, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        where.setdefault(b[j], []).append(j)
    ends: list[int] = []
    last: list[tuple | None] = []
    for i, line in enumerate(a):
        for j in where.get(line, ()):
            at = bisect_left(ends, j)
            link = (i, last[at - 1] if at else None)
            if at == len(ends):
                ends.append(j)
                last.append(link)
            else:
                ends[at], last[at] = j, link
    out, link = [], last[-1] if last else None
    while link:
        out.append(link[0])
        link = link[1]
    return out[::-1]


def with_neighbours(pages: DataFrame) -> DataFrame:
    """row, path, hashes and the two pages before and after in order of host, path, URL and row,
    where they are of the same host."""
    order = ["host", "path", "url", "row"]
    sorted_ = written(
        pages.select(*order, "hashes").repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id()), "ordered")
    page = F.struct("host", "path", "hashes")
    steps = {"before": -1, "before2": -2, "after": 1, "after2": 2}
    inside = Window.partitionBy("part").orderBy(*order)
    # The two pages at either end of each partition, four rows of it at most.
    ends = sorted_.withColumn("_first", F.row_number().over(inside)).withColumn("_last", F.row_number().over(
        Window.partitionBy("part").orderBy(*[F.col(c).desc() for c in order]))).filter("_first <= 2 or _last <= 2")
    across = Window.orderBy(*order)
    edges = written(ends.select("row", *[
        F.lead(page, n).over(across).alias(f"part_{name}") for name, n in steps.items()]), "edges")
    near = sorted_.select("*", *[F.lead(page, n).over(inside).alias(name) for name, n in steps.items()]).join(
        small(edges), "row", "left")

    def same_host(candidate: Column) -> Column:
        return F.when((candidate["host"] == F.col("host")) & (F.col("host") != ""), candidate)

    return near.select("row", "path", "hashes", *[
        same_host(F.coalesce(name, f"part_{name}")).alias(name) for name in steps])


def _shared_prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _versions(a: str, b: str) -> bool:
    """Whether two paths are the same but for parameters, or one goes on from the other."""
    a, b = sorted((re.split("[?#;]", path)[0].rstrip("/") for path in (a, b)), key=len)
    return a == b or a != "" and b.startswith(a) and not b[len(a)].isalnum()


def _shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows, cut = [], []
        for row, path, hashes, *around in batch.itertuples(index=False):
            before, before2, after, after2 = around
            near = [p for p in (before, after) if p is not None]
            if not near:
                continue
            nearest = max(near, key=lambda p: _shared_prefix(path, p["path"]))
            common = common_lines(list(hashes), list(nearest["hashes"]))
            if common and len(common) < len(hashes):
                template = {h for h, n in Counter(hashes).items() if n > 1}
                for other in (before, before2, after, after2):
                    if other is not None and other is not nearest and not _versions(path, other["path"]):
                        template.update(other["hashes"])
                common = [i for i in common if hashes[i] in template]
            else:
                common = []
            if common:
                rows.append(row)
                cut.append(common)
        yield pd.DataFrame({"row": rows, "cut": cut}).astype({"row": "int64", "cut": object})


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url and text of every page."""
    kind = pages.schema["page_id"].dataType.simpleString()
    parsed = written(pages.select(
        "page_id", "url", "html", F.monotonically_increasing_id().alias("row")).mapInPandas(
        _parsed, f"page_id {kind}, url string, row long, blocks array<string>, protected boolean,"
        " hashes array<long>"), "parsed")
    split = parts(parsed.withColumn("page_id", F.struct("row", "hashes"))).select(
        "page_id.*", "url", "host", "path")
    cut = written(
        with_neighbours(split).filter("size(hashes) > 0 and (before is not null or after is not null)")
        .mapInPandas(_shared, "row long, cut array<int>"), "shared")
    kept = F.filter("blocks", lambda b, i: F.col("cut").isNull() | ~F.array_contains("cut", i))
    return parsed.join(small(cut), "row", "left").select(
        "page_id", "url", F.array_join(kept, "\n\n").alias("text"))


def digest(texts: DataFrame) -> DataFrame:
    return texts.withColumn("n_chars", F.length("text").cast("long"))
