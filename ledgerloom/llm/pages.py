"""Main text of web pages by differencing each page with the page of the nearest URL.

Pages of a host are sorted by URL path, and each is paired with the neighbour
whose path has the longer prefix in common. The lines of both, one for each block of
text, are aligned by their longest common subsequence, and what they share is
what the host puts on its pages: it is deleted. Pages may also share what they
are about, as mirrors do, and a page may have navigation of its own. So the
page's own marks decide first: if a page has an ``article`` or ``main`` element,
its text is in these, and menus, footers, adverts and the like are left out by
their element, role, class or id wherever they are. Where a page has both, the
difference tells what belongs to the text: lines of ``main`` that are shared are
not, and articles that are shared as a whole are teasers if ``main`` has more text
of its own. If most of the article is shared otherwise, the nearest page is a
mirror, which tells nothing.

Pairing shuffles hashes of lines; the pages themselves are read twice instead.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.words import list_array, map_rows
from ledgerloom.session import shared_table

#: Rows of deleted lines, and places in them, of 4 bytes each, that may be broadcast to the pages.
BROADCAST_ROWS = 200_000
BROADCAST_PLACES = 8_000_000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|iframe|svg|textarea|select|object|canvas|title)\b[^>]*>.*?"
    r"(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([a-z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
#: Elements that begin and end a block.
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option"
    " p pre section summary table tbody tfoot thead tr ul".split()
)
_CELLS = frozenset(["td", "th", "tr"])
_TABLE = _CELLS | {"table", "caption", "thead", "tbody", "tfoot"}
#: Elements that are white space within a block.
_SPACES = frozenset(["br", "td", "th", "wbr", "img", "input", "embed"])
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that the start of others ends, and the elements that they are looked for within.
_GROUPS = (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"]))
_LISTS = frozenset(["ul", "ol", "menu", "table"])
_ENDED_BY = {
    "li": (frozenset(["li"]), _LISTS),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["datalist"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "tbody": _GROUPS,
    "tfoot": _GROUPS,
    "body": (frozenset(["head"]), frozenset()),
}
_PARAGRAPH = (frozenset(["p"]), frozenset(["button", "caption", "td", "th", "table"]))
_CHROME = frozenset(["head", "nav", "footer", "aside", "form", "dialog", "menu", "button", "fieldset", "label"])
_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split()
)
#: Words in a class or id that tell what is not the article.
_MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored promo promotion"
    " cookie cookies consent gdpr notice notices notification alert popup modal overlay disclaimer"
    " nav navbar navigation menu menus submenu breadcrumb breadcrumbs pagination pager toolbar topbar"
    " sidebar sidebars aside widget widgets rail footer foot masthead"
    " share sharing social follow related recommended recommendations trending newsletter subscribe subscription"
    " signup signin login register search"
    " comment comments commentlist commentary disqus respond replies reply discussion hidden".split()
)
#: Parts of a name that make it tell how an element looks, and not what it is, as in has-sidebar.
_LOOKS = frozenset(["has", "no", "with", "without", "layout", "overflow"])
#: Marks that count only as a whole name: hidden-xs and overflow-hidden hide no text.
_WHOLE = frozenset(["hidden"])
_HIDDEN = frozenset(["is-hidden", "visually-hidden"])
#: Elements whose ids are marks within an article; ids of others are there for links to headings and passages.
_CONTAINERS = frozenset(["div", "ul", "ol", "dl", "table"])
_HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
_HEADER = frozenset(["header"])
_COMMENT = frozenset(["comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "discussion"])
#: Names of what holds articles other than that of the page, if one came before.
_OTHERS = _COMMENT | {"related", "recommended", "recommendations", "trending"}
_ROOTS = frozenset(["html", "body"])
_HIDES = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)

#: Where a line stands.
PLAIN, CHROME, MAIN, ARTICLE, TAIL = range(5)  # TAIL: in main, after an article in it


def _words(names: list[str]) -> set[str]:
    """Words in names of a class or id that may be marks."""
    words: set[str] = set()
    for name in names:
        parts = {part.lower() for part in _NAME.findall(name)}
        if not parts & _LOOKS:
            words |= parts - _WHOLE
        if name.lower() in _WHOLE | _HIDDEN:
            words.add("hidden")
    return words


def _left_out(tag: str, rest: str, inside: bool, holds: bool = False, later: bool = False) -> bool:
    """Whether an element is not the article; ``inside`` says that it is within one.

    One that ``holds`` an article or main element is not left out for its class
    or id, unless that names other articles, and one came before (``later``).
    """
    if tag in _ROOTS:
        return False
    if tag in _CHROME and not (holds and tag == "form") or tag == "header" and not inside:
        return True
    if not rest or rest.isspace():
        return False
    classes: list[str] = []
    ids: list[str] = []
    for found in _ATTRIBUTE.finditer(rest):
        name = found[1].lower()
        value = found[2] or found[3] or found[4] or ""
        if name == "class":
            classes += value.split()
        elif name == "id":
            ids += value.split()
        elif name == "role" and value.lower() in _ROLES:
            return True
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        elif name == "style" and _HIDES.search(value):
            return True
    if tag in ("article", "main"):
        # The id of an article is most often made from its title.
        return bool(_words(classes) & _COMMENT) or any(name.lower() in _COMMENT for name in ids)
    if holds:
        return later and any(name.lower() in _OTHERS for name in classes + ids)
    if tag in _HEADINGS or inside and (tag not in _CONTAINERS or "section" in classes):
        ids = []
    words = _words(classes + ids)
    return bool(words & _MARKS or not inside and words & _HEADER)


def page_lines(page: str) -> list[tuple[str, int]]:
    """Blocks of text in page order, each with where it stands."""
    tokens = list(_TOKEN.finditer(page))
    holding: set[int] = set()
    while True:
        lines, wrong = _lines(tokens, holding)
        if not wrong:
            return lines
        holding |= wrong


def _lines(tokens: list[re.Match], holding: set[int]) -> tuple[list[tuple[str, int]], set[int]]:
    """Lines, and elements that were left out by a mark and hold an article or main, which ``holding`` does not tell."""
    lines: list[tuple[str, int]] = []
    pieces: list[str] = []
    stack: list[tuple[str, bool, int]] = []  # open elements: tag, whether left out, place of the token
    opened: Counter[str] = Counter()
    within = {"article": 0, "main": 0}
    out: list[int] = []  # places of those that are left out
    met = False  # an article or main
    after = False  # whether the open main has had an article
    wrong: set[int] = set()

    def flush() -> None:
        text = " ".join("".join(pieces).split())
        pieces.clear()
        if text:
            main = TAIL if after else MAIN
            where = CHROME if out else ARTICLE if within["article"] else main if within["main"] else PLAIN
            lines.append((text, where))

    def close(depth: int) -> None:
        nonlocal after
        if any(left or tag in _BLOCKS for tag, left, _ in stack[depth:]):
            flush()
        while len(stack) > depth:
            tag, left, _ = stack.pop()
            opened[tag] -= 1
            if left:
                out.pop()
            elif tag in within:
                within[tag] -= 1
                after = after and within["main"] > 0

    def ended(names: frozenset[str], barriers: frozenset[str]) -> None:
        """Ends the innermost open element of ``names`` that is not outside a barrier."""
        if not any(opened[name] for name in names):
            return
        for depth in range(len(stack) - 1, -1, -1):
            tag, left, _ = stack[depth]
            if tag in names:
                close(depth)
                return
            if tag in barriers or tag in within and not left:
                return

    for place, token in enumerate(tokens):
        text = token["text"]
        if text is not None:
            pieces.append(html.unescape(text))
            continue
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _SPACES:
            pieces.append(" ")
        block = tag in _BLOCKS
        if block:
            flush()
        if token["end"]:
            if not opened[tag]:
                continue
            for depth in range(len(stack) - 1, -1, -1):
                above, left, _ = stack[depth]
                if above == tag:
                    close(depth)
                    break
                # An article is ended by nothing else, nor what is around a table by what is in a cell.
                if tag not in within and tag not in _ROOTS and (
                    above in within and not left
                    or tag in _CELLS and above == "table"
                    or above in ("td", "th", "caption") and tag not in _TABLE
                    or not block and tag not in _CELLS and above in _BLOCKS
                ):
                    break
            continue
        if tag in _ENDED_BY:
            ended(*_ENDED_BY[tag])
        if block:
            ended(*_PARAGRAPH)
        if tag in _VOID:
            continue
        rest = token["rest"]
        inside = bool(within["article"] or within["main"])
        if tag in within:
            left = _left_out(tag, rest, True)
            if not left and out:
                # What holds this one is judged anew. If it stays left out, so does this one.
                wrong.update(at for at in out if at not in holding)
                left = True
            elif not left:
                met = True
        else:
            left = _left_out(tag, rest, inside, place in holding, met)
        if left:
            flush()
            out.append(place)
        elif tag in within:
            within[tag] += 1
            after = after or tag == "article" and within["main"] > 0
        stack.append((tag, left, place))
        opened[tag] += 1
    flush()
    return lines, wrong


def common_lines(first: list[int], second: list[int]) -> list[int]:
    """Places in ``first`` of a longest common subsequence, found bit by bit in parallel.

    Of ``n`` rows of bits, one for each line, every ``sqrt(n)``-th is kept, and
    those between are found again on the way back. The bits of a line are kept
    only if it occurs as often. So memory grows with ``n * sqrt(n)`` bits.
    """
    known = set(second)
    places = [place for place, line in enumerate(first) if line in known]
    own = set(first)
    other = [line for line in second if line in own]
    spots: dict[int, list[int]] = {}
    for place, line in enumerate(other):
        spots.setdefault(line, []).append(place)
    often = math.isqrt(len(other)) + 1
    stride = math.isqrt(len(places)) + 1
    everything = (1 << len(other)) - 1

    def bits(line: int) -> int:
        found = bytearray(len(other) // 8 + 1)
        for place in spots[line]:
            found[place >> 3] |= 1 << (place & 7)
        return int.from_bytes(found, "little")

    masks = {line: bits(line) for line, found in spots.items() if len(found) >= often}

    def after(state: int, line: int) -> int:
        mask = masks.get(line)
        matched = state & (bits(line) if mask is None else mask)
        return ((state + matched) | (state - matched)) & everything

    state, kept = everything, []
    for row, place in enumerate(places):
        if row % stride == 0:
            kept.append(state)
        state = after(state, first[place])
    shared, row, column = [], len(places), len(other)
    # `block` holds the state before row `begin` and those after it and the next ones.
    begin, block = len(places), [state]
    while row and column:
        if row == begin:
            begin = (row - 1) // stride * stride
            block = [kept[begin // stride]]
            for place in places[begin:row]:
                block.append(after(block[-1], first[place]))
        if block[row - begin] >> (column - 1) & 1:
            column -= 1
            continue
        row -= 1
        if not row or block[row - begin] >> (column - 1) & 1:
            shared.append(places[row])
            column -= 1
    return shared[::-1]


def main_text(lines: list[tuple[str, int]], shared: list[int], compared: bool = False) -> str:
    """The lines of the article: not left out, and not ``shared`` unless the page marks them as its article.

    ``compared`` says that there is a nearest page. Of a page with articles, lines
    of main are kept too, unless the nearest page, if it is no mirror, has them.
    Where it tells nothing, lines of main after its last article are
    kept only if they are more text than all articles.
    """
    gone = set(shared)

    def chars(places: list[int]) -> int:
        return sum(len(lines[at][0]) for at in places)

    articles = [at for at, (_, place) in enumerate(lines) if place == ARTICLE]
    main = [at for at, (_, place) in enumerate(lines) if place in (MAIN, TAIL)]
    kept = articles + main
    if articles and main:
        both = [at for at in articles if at in gone]
        own = [at for at in main if at not in gone]
        if compared and len(both) == len(articles) and chars(own) > chars(articles):
            kept = own
        elif compared and 2 * chars(both) < chars(articles):
            kept = articles + own
        else:
            tail = [at for at in main if lines[at][1] == TAIL and at > articles[-1]]
            if chars(tail) <= chars(articles):
                after = set(tail)
                kept = [at for at in kept if at not in after]
    elif not kept:
        kept = [at for at, (_, place) in enumerate(lines) if place == PLAIN and at not in gone]
    return "\n".join(lines[at][0] for at in sorted(kept))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; query and fragment do not count. Null and odd URLs have an empty host."""
    whole = F.coalesce(url, F.lit(""))
    host = F.lower(F.regexp_extract(whole, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract(whole, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)
    return host, path


def row_key() -> Column:
    return F.xxhash64("page_id", "url", "html")


def line_hashes(pages: DataFrame) -> DataFrame:
    """``host, path, page_id, row_key, lines`` with a hash for each block of text."""

    def rows(batch: dict[str, list]):
        hashes = [
            np.array([xxhash.xxh3_64_intdigest(text) for text, _ in page_lines(page or "")], np.uint64)
            for page in batch.pop("html")
        ]
        flat = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        yield batch | {"lines": list_array(flat, map(len, hashes))}

    host, path = url_parts(F.col("url"))
    frame = pages.select(host.alias("host"), path.alias("path"), "page_id", row_key().alias("row_key"), "html")
    return map_rows(frame, rows, "host string, path string, page_id bigint, row_key bigint, lines array<bigint>")


def with_neighbours(hashed: DataFrame) -> DataFrame:
    """``hashed`` with ``before`` and ``after``, structs of the pages next to it by host and path.

    Pages are ranged, so that a large host, or many equal rows, are dealt out to
    many tasks. The two pages at the ends of a range meet those of the ranges
    beside it.
    """
    order = ["host", "path", "page_id", "row_key"]
    numbered = hashed.withColumn("row", F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(*order, "row").sortWithinPartitions(*order, "row").drop("row")
    state = {"place": 0}

    def number(batch: dict[str, list]):
        size = len(batch["host"])
        place = np.arange(state["place"], state["place"] + size)
        state["place"] += size
        yield batch | {"part": np.full(size, TaskContext.get().partitionId()), "place": place}

    schema = "host string, path string, page_id bigint, row_key bigint, lines array<bigint>, part int, place bigint"
    placed = shared_table(map_rows(ranged, number, schema))
    page = F.struct("host", "path", "lines")
    within = Window.partitionBy("part").orderBy("place")
    near = placed.withColumns({"before": F.lag(page).over(within), "after": F.lead(page).over(within)})
    last = placed.groupBy("part").agg(F.max("place").alias("last"))
    # Two rows for each range.
    ends = placed.join(F.broadcast(last), "part").where("place = 0 or place = last")
    across = Window.orderBy("part", "place")
    edges = ends.select(
        F.col("part").alias("at"),
        F.col("place").alias("spot"),
        F.lag(page).over(across).alias("edge_before"),
        F.lead(page).over(across).alias("edge_after"),
    )
    joined = near.join(edges, (F.col("part") == F.col("at")) & (F.col("place") == F.col("spot")), "left")
    return joined.select(
        *order,
        "lines",
        F.coalesce("before", F.when(F.col("place") == 0, F.col("edge_before"))).alias("before"),
        F.coalesce("after", "edge_after").alias("after"),
    )


def _in_common(first: str, second: str) -> int:
    length = 0
    for a, b in zip(first, second, strict=False):
        if a != b:
            break
        length += 1
    return length


def shared_lines(pages: DataFrame) -> DataFrame:
    """``page_id, row_key, shared``: places of the lines that a page shares with its nearest neighbour, if it has one."""

    def rows(batch: dict[str, list]):
        found = {"page_id": [], "row_key": [], "shared": []}
        for at, (host, path, lines) in enumerate(zip(batch["host"], batch["path"], batch["lines"], strict=True)):
            beside = [page for page in (batch["before"][at], batch["after"][at]) if page and page["host"] == host]
            if not beside or not lines:
                continue
            nearest = max(beside, key=lambda page: _in_common(path, page["path"]))
            found["page_id"].append(batch["page_id"][at])
            found["row_key"].append(batch["row_key"][at])
            found["shared"].append(common_lines(lines, nearest["lines"]))
        yield found

    # Ranging reads its rows twice, and a page is parsed once.
    near = with_neighbours(shared_table(line_hashes(pages)))
    return map_rows(near, rows, "page_id bigint, row_key bigint, shared array<int>")


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars``: the main text of every page.

    Character references are decoded, white space within a block becomes one
    space, and blocks are joined by a line feed. A null or empty page, and one
    without a main text, gives an empty text. A page whose host has no other page
    is read by its marks alone. Repeated rows are each other's nearest page and
    each give a row; of neighbours equally near the one before counts; page ids
    may be null or repeated; an empty table gives no row; other columns are not read.
    """
    shared = shared_table(shared_lines(pages))
    once = shared.dropDuplicates(["page_id", "row_key"]).select(
        F.col("page_id").alias("at_id"), F.col("row_key").alias("at_key"), "shared"
    )
    size = shared.select(F.count("*").alias("n"), F.sum(F.size("shared")).alias("places")).first()
    if size["n"] <= BROADCAST_ROWS and (size["places"] or 0) <= BROADCAST_PLACES:
        once = F.broadcast(once)
    frame = pages.select("page_id", "url", "html", row_key().alias("row_key"))
    here = F.col("page_id").eqNullSafe(F.col("at_id")) & (F.col("row_key") == F.col("at_key"))
    joined = frame.join(once, here, "left").select("page_id", "url", "html", "shared")

    def rows(batch: dict[str, list]):
        texts = [
            main_text(page_lines(page or ""), shared or [], shared is not None)
            for page, shared in zip(batch["html"], batch["shared"], strict=True)
        ]
        yield {
            "page_id": batch["page_id"],
            "url": batch["url"],
            "text": pa.array(texts, pa.string()),
            "n_chars": [len(text) for text in texts],
        }

    return map_rows(joined, rows, "page_id bigint, url string, text string, n_chars bigint")
