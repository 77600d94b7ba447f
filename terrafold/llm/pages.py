"""Main text of web pages by differencing pages whose URLs are nearest.

1. A page is read as lines: one per block of text, with white space and character references resolved. Each
   line knows where it stands: inside an article, inside an element that HTML or its class, id or role names as
   something else (menus, headers, footers, sidebars, notices, adverts, forms, reader comments), or outside both.
2. Only line digests, sizes and places are moved. Pages are numbered in order of host and path, so a host with most of
   the pages is spread over tasks, and each is paired with the one before and the one behind it on its host.
3. The lines of a pair are aligned by a longest common subsequence. Shared lines are the template of that part of the
   host and are deleted. A pair of copies, most of whose text is shared, says nothing about templates and is left out.
4. The few pages that lose lines this way get the places of these lines back; the others need no join.

Differencing cannot see a menu that no neighbour repeats, nor tell a template from a passage that two articles quote. So
elements that are marked as not being the article go whether shared or not, lines inside an article stay
although shared, and where a page marks its article, nothing outside it is kept.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.operators.tables import surrogate_ids
from terrafold.session import lookup_side

OPEN, ARTICLE, OTHER = 0, 1, 2  # where a line stands

BLOCKS = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "select summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = set("script style title textarea noscript iframe noembed noframes xmp template svg math object canvas audio video".split())
MARKED = set("nav aside footer form menu dialog button select head search".split())  # never part of an article
HINTS = set(
    "ad ads advert advertisement advertising adverts sponsor sponsored promo promotion banner sidebar menu menubar nav navbar "
    "navigation breadcrumb breadcrumbs footer header masthead topbar comment comments replies disqus notice notices cookie cookies "
    "consent alert popup modal overlay newsletter subscribe signup share sharing social related recommended widget contentinfo "
    "complementary".split()
)
#: Those of them that an article element itself may carry without being the article.
NO_ARTICLE = set("ad ads advert advertisement sponsored promo comment comments replies related recommended".split())
CLOSES = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"},
          "option": {"select"}}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>\"[^\"]*\"|'[^']*'|[^>\"'])*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)", re.S,
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I | re.S)
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_WORD = re.compile(r"[a-z]+")


def page_lines(page: str) -> list[tuple[str, int]]:
    """(text, place) of every block that has text, in page order."""
    out: list[tuple[str, int]] = []
    stack: list[tuple[str, int]] = []
    parts: list[str] = []
    at, place, end = 0, OPEN, len(page)

    def close() -> None:
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip(" ")
            parts.clear()
            if text:
                out.append((text, place))

    def text(value: str) -> None:
        if value:
            parts.append(html.unescape(value) if "&" in value else value)

    while at < end:
        found = _TAG.search(page, at)
        if not found:
            text(page[at:])
            break
        text(page[at : found.start()])
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        block = name in BLOCKS
        if name == "br":
            parts.append(" ")
        if block:
            close()
        if found[1] or found[4]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if not block and any(t in BLOCKS for t, _ in stack[k + 1 :]):
                        break  # an inline element does not end the blocks inside it
                    del stack[k:]
                    break
        elif name in UNREAD:
            rest = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = rest.end() if rest else end
            continue
        elif name not in VOID:
            if block:
                _imply_ends(stack, name)
            now = stack[-1][1] if stack else OPEN
            stack.append((name, _place(name, found[3] if found[2] else found[6], now)))
        now = stack[-1][1] if stack else OPEN
        if now != place:
            close()  # text of another place is another line
            place = now
    close()
    return out


def _imply_ends(stack: list[tuple[str, int]], name: str) -> None:
    """A block ends an open paragraph or head; an item, cell or row ends the one before it."""
    if stack and stack[-1][0] == "head":
        stack.pop()
    for k in range(len(stack) - 1, -1, -1):
        if stack[k][0] == "p":
            del stack[k:]
            break
        if stack[k][0] in BLOCKS:
            break
    if name in CLOSES:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == name or name in ("dt", "dd") and stack[k][0] in ("dt", "dd") or name in ("td", "th") and stack[k][0] in ("td", "th"):
                del stack[k:]
                break
            if stack[k][0] in CLOSES[name]:
                break


def _place(name: str, attributes: str, now: int) -> int:
    if now == OTHER or name in MARKED or name == "header" and now != ARTICLE:
        return OTHER
    said = {k.lower(): (a or b or c).lower() for k, a, b, c in _ATTRIBUTE.findall(attributes)} if "=" in attributes else {}
    hints = HINTS.intersection(_WORD.findall(" ".join(said.get(k, "") for k in ("class", "id", "role"))))
    if name == "article":
        hints &= NO_ARTICLE
    if hints and name not in ("html", "body", "main"):
        return OTHER
    if name in ("article", "main") or said.get("role") == "main" or said.get("itemprop") == "articlebody":
        return ARTICLE
    return now


def common_lines(one: list, two: list) -> list[tuple[int, int]]:
    """Places of a longest common subsequence, in order."""
    pre = 0
    while pre < min(len(one), len(two)) and one[pre] == two[pre]:
        pre += 1
    post = 0
    while post < min(len(one), len(two)) - pre and one[-1 - post] == two[-1 - post]:
        post += 1
    both = set(one[pre : len(one) - post]) & set(two[pre : len(two) - post])
    a = [i for i in range(pre, len(one) - post) if one[i] in both]
    b = [j for j in range(pre, len(two) - post) if two[j] in both]
    middle = _align([one[i] for i in a], [two[j] for j in b]) if both else []
    return (
        [(k, k) for k in range(pre)] + [(a[i], b[j]) for i, j in middle]
        + [(len(one) - k, len(two) - k) for k in range(post, 0, -1)]
    )


_MOST_BITS = 1 << 30  # of the stored table; longer pages are aligned in halves


def _rows(one: list, two: list) -> Iterator[int]:
    """Per line of ``one``: a bit for each line of ``two``, 0 where the common length grows there."""
    at: dict = {}
    for j, x in enumerate(two):
        at[x] = at.get(x, 0) | 1 << j
    every = (1 << len(two)) - 1
    row = every
    for x in one:
        use = row & at.get(x, 0)
        row = ((row + use) | (row - use)) & every
        yield row


def _align(one: list, two: list, most: int = _MOST_BITS) -> list[tuple[int, int]]:
    if not one or not two:
        return []
    if len(one) > 1 and len(one) * len(two) > most:
        half = len(one) // 2
        front, back = _lengths(one[:half], two), _lengths(one[half:][::-1], two[::-1])[::-1]
        cut = int(np.argmax(front + back))
        return _align(one[:half], two[:cut], most) + [(half + i, cut + j) for i, j in _align(one[half:], two[cut:], most)]
    rows, out, i, j = list(_rows(one, two)), [], len(one), len(two)
    while i and j:
        if one[i - 1] == two[j - 1]:
            i, j = i - 1, j - 1
            out.append((i, j))
        elif rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
    return out[::-1]


def _lengths(one: list, two: list) -> np.ndarray:
    """Common length of ``one`` with each beginning of ``two``."""
    *_, row = _rows(one, two)
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(two) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(two)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


# ---------------------------------------------------------------- Spark


def extract_pages(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """One row per row: id, url, text, n_chars, n_lines, n_shared (lines outside articles that a neighbour shares).

    Null html is empty and gives an empty text. Pages without a host (null url, no ``://``) have no neighbours. Rows that
    repeat url and html are one page, so they are not each other's neighbours, and each gets that page's text. Ids
    may repeat or be null. Pages of any length are read whole; a tag or comment that never ends goes up to the end.
    Lines are compared by 64-bit digest. Other columns are ignored whatever their names; an empty table
    gives no rows.
    """
    source = pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"), F.coalesce(html_column, F.lit("")).alias("html"))
    source = source.withColumn("page", F.unhex(F.sha2(F.concat_ws("\n", "url", "html"), 256)))
    gone = lookup_side(_template_lines(source))
    kind = source.schema["id"].dataType.simpleString()
    return source.join(gone, "page", "left").select("id", "url", "html", "gone").mapInArrow(
        _texts, f"id {kind}, url string, text string, n_chars long, n_lines long, n_shared long"
    ).withColumnRenamed("id", id_column).withColumnRenamed("url", url_column)


def _template_lines(source: DataFrame) -> DataFrame:
    """page, gone: the numbers of lines outside articles that a page shares with a neighbour."""
    rest = F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)^.*?://(.*)$", 1)
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), capitals, capitals.lower())
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lines = source.select("page", host.alias("host"), path.alias("path"), "html").filter("host != ''").mapInArrow(
        _digests, "page binary, host string, path string, lines array<long>, sizes array<int>, places binary"
    )
    numbered = surrogate_ids(lines.dropDuplicates(["page"]), ["host", "path", "page"], id_col="n")
    columns = ["page", "lines", "sizes", "places"]
    one = numbered.select("n", "host", *columns)
    two = numbered.select((F.col("n") - 1).alias("n"), "host", *[F.col(c).alias(f"{c}_2") for c in columns])
    found = one.join(two, ["n", "host"]).select(*columns, *[f"{c}_2" for c in columns]).mapInArrow(_shared, "page binary, gone array<int>")
    return found.groupBy("page").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))  # two rows at most


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines, sizes, places = [], [], []
        for page in batch.column(3).to_pylist():
            read = page_lines(page)
            held = b"".join(hashlib.blake2b(t.encode(errors="replace"), digest_size=8).digest() for t, _ in read)
            lines.append(np.frombuffer(held, np.int64))
            sizes.append(np.array([len(t) for t, _ in read], np.int32))
            places.append(bytes(p for _, p in read))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(lines, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int32())), pa.array(places, pa.binary())],
            names=["page", "host", "path", "lines", "sizes", "places"],
        )


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        page, gone = [], []
        for p, lines, sizes, places, p2, lines2, sizes2, places2 in zip(*(c.to_pylist() for c in batch.columns)):
            common = common_lines(lines, lines2)
            # Sizes of what may be text of the page; copies share most of it.
            total = min(sum(s for s, x in zip(sizes, places) if x != OTHER), sum(s for s, x in zip(sizes2, places2) if x != OTHER))
            if 2 * sum(sizes[i] for i, _ in common if places[i] != OTHER) > total:
                continue
            for key, own in ((p, [i for i, _ in common if places[i] == OPEN]), (p2, [j for _, j in common if places2[j] == OPEN])):
                if own:
                    page.append(key)
                    gone.append(own)
        yield pa.RecordBatch.from_arrays([pa.array(page, pa.binary()), pa.array(gone, pa.list_(pa.int32()))], names=["page", "gone"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, lines, shared = [], [], []
        for page, gone in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            read, drop = page_lines(page), set(gone or ())
            use = ARTICLE if any(p == ARTICLE for _, p in read) else OPEN
            texts.append("\n".join(t for i, (t, p) in enumerate(read) if p == use and i not in drop))
            lines.append(len(read))
            shared.append(len(drop))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
             pa.array(lines, pa.int64()), pa.array(shared, pa.int64())],
            names=["id", "url", "text", "n_chars", "n_lines", "n_shared"],
        )
