"""Main text of web pages, without what a site repeats on many of its pages."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .html import parse
from .tables import Scratch

# An element is a site's template if it stands on so many different pages of a host,
# and on such a share of them or on so many that the share doesn't matter: a large
# host has several designs. Pages with the same article count as one.
LEAST_PAGES = 8
LEAST_SHARE = 0.3
MANY_PAGES = 100
JOINT = "\n\n"

_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def extracted(html: str) -> tuple[list[tuple[str, int]], list[int], list[int]]:
    """(blocks as (text, element), parent of every element, digest or 0 if none).

    Elements are numbered anew: only those are left that hold a block and may be
    part of a template; number 0 stands for the page itself.
    """
    page = parse(html).article()
    may = page.candidates()
    numbers, parents, digests = {0: 0}, [0], [0]

    def number_of(element: int) -> int:
        chain = []
        while element not in numbers:
            chain.append(element)
            element = page.elements[element].parent
        number = numbers[element]
        for inner in reversed(chain):
            if may[inner]:
                parents.append(number)
                digests.append(page.elements[inner].digest)
                number = len(parents) - 1
            numbers[inner] = number
        return number

    return [(text, number_of(element)) for text, element in page.blocks], parents, digests


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, articles, hashes, packed = [], [], [], []
        for url, html in zip(batch.column("url"), batch.column("html")):
            host = _HOST.match(url.as_py() or "")
            blocks, parents, digests = extracted(html.as_py() or "")
            text = JOINT.join(t for t, _ in blocks)
            hosts.append(host[1].lower() if host else None)
            articles.append(_signed(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))))
            hashes.append(sorted(set(digests[1:])) if host else [])
            page = json.dumps([blocks, parents, digests], ensure_ascii=False)
            packed.append(zlib.compress(page.encode("utf-8", "surrogatepass")))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                batch.column("page_id"),
                batch.column("url"),
                pa.array(hosts, pa.string()),
                pa.array(articles, pa.int64()),
                pa.array(hashes, pa.list_(pa.int64())),
                pa.array(packed, pa.binary()),
            ],
            names=["row", "page_id", "url", "host", "article", "hashes", "packed"],
        )


def remaining(packed: bytes, removed: set[int]) -> str:
    """The text of a page without the blocks inside of removed elements."""
    blocks, parents, digests = json.loads(zlib.decompress(packed).decode("utf-8", "surrogatepass"))
    gone = [False] * len(parents)
    for number in range(1, len(parents)):
        gone[number] = gone[parents[number]] or digests[number] in removed
    return JOINT.join(text for text, element in blocks if not gone[element])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [
            remaining(packed.as_py(), set(removed.as_py() or ()))
            for packed, removed in zip(batch.column("packed"), batch.column("removed"))
        ]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ],
            names=["page_id", "url", "text", "n_chars"],
        )


def templates(pages: DataFrame) -> DataFrame:
    """(host, hash) of the elements that recur across a host's pages."""
    seen = pages.select("host", "article", F.explode("hashes").alias("hash")).distinct()
    spread = seen.groupBy("host", "hash").agg(F.count("*").alias("pages"))
    # Distinct articles are counted in two steps, as one host may have most pages.
    sizes = (
        pages.filter("host is not null")
        .select("host", "article")
        .distinct()
        .groupBy("host")
        .agg(F.count("*").alias("of"))
    )
    often = spread.filter(F.col("pages") >= LEAST_PAGES).join(sizes, "host")
    bar = F.least(LEAST_SHARE * F.col("of"), F.lit(MANY_PAGES))
    return often.filter(F.col("pages") >= bar).select("host", "hash")


def main_texts(
    df: DataFrame, html: str = "html", url: str = "url", key: str = "page_id"
) -> DataFrame:
    """Key, ``url``, ``text`` and ``n_chars`` (code points) of every page.

    The text is the article's blocks in page order, white space within a block made
    one space, joined by an empty line. It lacks menus, headers, footers, sidebars,
    notices, adverts, forms, scripts, styles and readers' comments, told by element
    and by whole tokens of class, id or role, and element subtrees that recur across
    the host's pages. An element that holds the article is never left out for its
    class, id or role. A null or empty page has an empty text; pages without a host keep all
    blocks, as there is nothing to compare them with. Repeated rows each give a row.
    """
    scratch = Scratch(df.sparkSession, "pages")
    rows = df.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).cast("bigint").alias("page_id"),
        F.col(url).alias("url"),
        F.col(html).alias("html"),
    )
    pages = scratch.put(
        rows.mapInArrow(
            _pages,
            "row bigint, page_id bigint, url string, host string, article bigint, "
            "hashes array<bigint>, packed binary",
        ),
        "pages",
    )
    held = pages.select("row", "host", F.explode("hashes").alias("hash"))
    removed = (
        held.join(templates(pages), ["host", "hash"])
        .groupBy("row")
        .agg(F.collect_set("hash").alias("removed"))
    )
    # A page without any element that may be a template loses none.
    some = F.size("hashes") > 0
    joined = pages.filter(some).join(removed, "row", "left")
    alone = pages.filter(~some).withColumn("removed", F.lit(None).cast("array<bigint>"))
    kept = ["page_id", "url", "packed", "removed"]
    return (
        joined.select(kept)
        .union(alone.select(kept))
        .mapInArrow(_texts, "page_id bigint, url string, text string, n_chars bigint")
    )
