"""Main text of web pages: markup that says what it is, and page differencing for the rest.

A page is cut into lines, the texts of its blocks. Lines inside navigation, headers, footers,
asides, forms, scripts, styles and elements named as adverts, notices, menus or comments go.
An element that is named so, or a form, stays if it is a wrapper: if it holds an article or main, unless
it is a list of other articles (comments, related or sponsored pages, widgets, a sidebar) beside one.
Lines inside <article> or <main> are the main text where a page has one. Of all other pages
the remaining lines are undecided: pages of a host stand in the order of their paths, each is
aligned with its nearest neighbours by a longest common subsequence of lines, and
the lines they share are template and are deleted.

Inside <article> or <main> an element goes by its name only if a whole class or id says so ("ad", "share-buttons",
"comment-list"), never if a part of it does ("share-price", "related-work", "ad-free"). Blocks with
such a part and the lines of headers are undecided too: the neighbours' lines tell whether they are
template. Headings and inline elements stay, whatever their names.

Differencing alone can't be right here: articles repeat lines of other articles of their host,
which it would delete, and menus and adverts differ from page to page, which it would keep. So it
decides only where the markup doesn't.

Null html is empty and gives an empty text; a null url has the empty host and path. Pages that are copies
of each other tell nothing about the template and are passed over. Repeated rows are separate
pages; an empty table gives none. Pages of any length are parsed whole. Other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import bounded_batches
from pulse.session import cut

# Comments, raw text elements with all they hold, declarations, and tags; an unclosed raw element or comment runs to the end.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|template|noscript|iframe|textarea|svg|math|title|object|canvas|select)\b(?:[^'\">]|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^'\">]|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_MAIN = frozenset(("article", "main"))
_DROP = frozenset("nav header footer aside dialog menu button fieldset".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|adsense|sponsor(?:ed|s)?|promo(?:tion)?s?|banners?|cookies?|consent|gdpr"
    r"|notices?|newsletters?|subscribe|subscription|popups?|modals?|overlays?|sidebars?|side-bar|nav|navbar|navigation|menus?|breadcrumbs?"
    r"|footers?|headers?|masthead|topbar|comments?|commentlist|replies|disqus|respond|share|sharing|social|related|recommended|widgets?"
    r"|pagination|pager|login|signup|search)(?:$|[\s_-])",
    re.I,
)
# A class or id that as a whole names a part of a page and no text: the thing, maybe behind its place and before its form.
_THING = re.compile(
    r"(?:(?:site|page|main|top|left|right|post|blog|google|mobile|sticky)[_-])?"
    r"(?:ads?|adverts?|advertisements?|advertising|adsense|sponsor(?:ed|s)?|promo(?:tion)?s?|banners?|cookies?|consent|gdpr"
    r"|notices?|newsletters?|subscribe|subscription|popups?|modals?|overlays?|sidebars?|side-bar|nav|navbar|navigation|menus?|breadcrumbs?"
    r"|footers?|masthead|topbar|comments?|commentlist|replies|disqus|respond|share|sharing|social|related|recommended|widgets?"
    r"|pagination|pager|login|signup|search)"
    r"(?:[_-](?:list|slot|container|wrapper|wrap|box|block|unit|bar|banner|notice|area|section|thread|buttons?|links?|icons?|posts?|articles?|stories|form|left|right|top|bottom))?"
    r"(?:[_-]?\d+)?",
    re.I,
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Names of what holds articles of its own beside the page's: "layout has-sidebar" and "comments-open" are none.
_LISTS = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|adsense|sponsor(?:ed|s)?|promo(?:tion)?s?|comments?(?!-(?:open|closed))|commentlist"
    r"|replies|disqus|respond|related|recommended|widgets?|(?<!has-)(?<!with-)(?<!no-)(?:sidebars?|side-bar))(?:$|[\s_-])",
    re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
# A container named like this holds the page, not a part of it.
_WHOLE = frozenset(("html", "body"))


_DROPPED, _NAMED, _LIST, _PART = 1, 2, 3, 4


def _drops(tag: str, attributes: str, in_main: bool) -> int:
    """Whether an element goes: not (0), always, unless it is a wrapper, unless it is one without articles beside it,
    or if the neighbours have its lines too."""
    if tag in _DROP and not (in_main and tag == "header"):
        return _DROPPED
    found = _NAMED if tag == "form" else _PART if tag == "header" else 0
    if not attributes or tag in _WHOLE or tag in _MAIN:
        return found
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id") and _NAMES.search(value) and not (in_main and (tag in _INLINE or tag in _HEADINGS)):
            if in_main and not any(_THING.fullmatch(word) for word in value.split()):
                found = found or _PART
            elif found in (0, _PART) or _LISTS.search(value):
                found = _LIST if _LISTS.search(value) else _NAMED
        if name == "role" and value.lower() in _ROLES:
            return _DROPPED
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return _DROPPED
        if name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return _DROPPED
    return found


def _wrappers(tokens: list[tuple[str, str, str]], closed: set[int], kinds: dict[int, int]) -> set[int]:
    """Places of the start tags of named elements that hold the page's text.

    Articles and mains inside elements that always go don't count. A list is a wrapper if it holds a main, or if no
    article or main stands outside it that is in no other list.
    """
    stack: list[tuple[str, int, int]] = []  # tag, place, kind
    named: list[int] = []  # open named elements, outermost first
    lists = [-1]  # open lists
    holds: dict[int, bool] = {}  # named element: whether it holds a main, not articles alone
    around: dict[int, int] = {}  # list: the list around it
    beside: set[int] = set()  # lists that hold an article or main in no list within
    dropped = 0
    for i, (tag, kind, _) in enumerate(tokens):
        if not tag or tag in _VOID:
            continue
        if kind:
            if not any(s[0] == tag for s in stack):
                continue
            while stack:
                name, _, what = stack.pop()
                if what == _DROPPED:
                    dropped -= 1
                elif what:
                    named.pop()
                    if what == _LIST:
                        lists.pop()
                if name == tag:
                    break
        elif i in closed or tag in _MAIN:
            what = kinds.get(i, 0) % _PART
            if tag in _MAIN and not dropped:
                beside.add(lists[-1])
                for at in reversed(named):
                    if holds.get(at, False) or (at in holds and tag != "main"):
                        break  # those around it are known as well
                    holds[at] = tag == "main"
            if tag not in _INLINE or what:
                stack.append((tag, i, what))
            if what == _DROPPED:
                dropped += 1
            elif what:
                named.append(i)
                if what == _LIST:
                    around[i] = lists[-1]
                    lists.append(i)
    found = set()
    # Lists come before those within: an article beside the outer one is beside the inner one.
    has_beside = {-1: False}
    for i, outer in around.items():
        has_beside[i] = has_beside[outer] or outer in beside
    for i, has_main in holds.items():
        if kinds[i] == _NAMED or has_main or not has_beside[i]:
            found.add(i)
    return found


def lines(html: str) -> tuple[list[str], list[str], bool]:
    """Lines of the article, undecided lines outside it, and whether there is an article."""
    inside, _, outside, has_main = marked_lines(html)
    return inside, outside, has_main


def _inside(tokens: list[tuple[str, str, str]], closed: set[int]) -> set[int]:
    """Places of the start tags inside an article or main: behind its start tag and before its end tag."""
    found: set[int] = set()
    mains: list[bool] = []  # open articles and mains: whether they are closed somewhere
    for i, (tag, kind, _) in enumerate(tokens):
        if tag in _MAIN:
            if not kind:
                mains.append(i in closed)
            elif mains and mains[-1]:
                mains.pop()
        elif tag and not kind and mains:
            found.add(i)
    return found


def marked_lines(html: str) -> tuple[list[str], list[bool], list[str], bool]:
    """Lines of the article, which of them are undecided, undecided lines outside it, and whether there is an article."""
    tokens = []
    at = 0
    for m in _TOKEN.finditer(html):
        if m.start() > at:
            tokens.append(("", html[at : m.start()], ""))
        at = m.end()
        tag = (m[3] or m[6] or "").lower()
        if tag:
            tokens.append((tag, "/" if m[2] or m[5] else "", m[4] or m[7] or ""))
        else:
            # A comment is nothing, a raw element is the end of a line.
            tokens.append(("", "" if html.startswith("<!--", m.start()) else "\n", ""))
    if at < len(html):
        tokens.append(("", html[at:], ""))
    # Which start tags have an end tag of their own.
    closed, open_tags = set(), defaultdict(list)
    for i, (tag, kind, _) in enumerate(tokens):
        if tag and not kind:
            open_tags[tag].append(i)
        elif tag and open_tags[tag]:
            closed.add(open_tags[tag].pop())
    within = _inside(tokens, closed)
    kinds = {i: k for i in closed if tokens[i][0] not in _VOID and (k := _drops(tokens[i][0], tokens[i][2], i in within))}
    may_wrap = any(k in (_NAMED, _LIST) for k in kinds.values()) and (open_tags.keys() & _MAIN)
    wrappers = _wrappers(tokens, closed, kinds) if may_wrap else set()
    inside: list[str] = []
    open_lines: list[bool] = []
    outside: list[str] = []
    text: list[str] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # tag, drops, is main, leaves its lines undecided
    drop = main = part = heading = 0
    has_main = False

    def flush() -> None:
        line = " ".join(entities.unescape("".join(text)).split())
        text.clear()
        if line:
            (inside if main else outside).append(line)
            if main:
                open_lines.append(part > 0 and not heading)

    for i, (tag, kind, _) in enumerate(tokens):
        if not tag:
            if not drop:
                text.append(kind)
            continue
        if tag not in _INLINE:
            flush()
        if kind:
            if tag in _VOID or not any(s[0] == tag for s in stack):
                continue
            while stack:
                name, dropped, was_main, was_part = stack.pop()
                drop, main, part, heading = drop - dropped, main - was_main, part - was_part, heading - (name in _HEADINGS)
                if name == tag:
                    break
        elif tag not in _VOID and i in closed:
            named, is_main, is_part = i in kinds, tag in _MAIN, kinds.get(i) == _PART
            dropped = named and not is_part and i not in wrappers
            if tag not in _INLINE or named:
                if named:
                    flush()
                has_main |= is_main and not drop
                stack.append((tag, dropped, is_main, is_part))
                drop, main, part, heading = drop + dropped, main + is_main, part + is_part, heading + (tag in _HEADINGS)
        elif tag in _MAIN and not drop:
            # Never closed: the rest of the page is the article.
            has_main = True
            stack.append((tag, False, True, False))
            main += 1
    flush()
    return inside, open_lines, outside, has_main


def common(a: list[str], b: list[str]) -> set[int]:
    """Places in `a` of a longest common subsequence (Hunt and Szymanski's algorithm)."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    found = set(range(start)) | set(range(len(a) - end, len(a)))
    places = defaultdict(list)
    for j in range(len(b) - end - 1, start - 1, -1):
        places[b[j]].append(j)
    ends: list[int] = []
    links: list[tuple] = []
    for i in range(start, len(a) - end):
        for j in places.get(a[i], ()):
            k = bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k] = j
                links[k] = link
    link = links[-1] if links else None
    while link:
        found.add(link[0])
        link = link[1]
    return found


# Before a line that is compared with the neighbours' but never goes. Lines have no white space but blanks.
_FIXED = "\t"


def _parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The text, if markup decides all of it, and the lines to be compared: undecided ones, and around them those that stay."""
    for frame in frames:
        rows = []
        for html in frame["html"]:
            inside, undecided, outside, has_main = marked_lines(html or "")
            if any(undecided):
                rows.append((None, [line if u else _FIXED + line for line, u in zip(inside, undecided, strict=True)]))
            else:
                rows.append((" ".join(inside) if has_main else None, outside))
        yield frame.drop(columns="html").assign(text=[r[0] for r in rows], lines=[r[1] for r in rows])


_COMPARED = (
    "page_id long, url string, text string, range int, starts boolean, ends boolean, edge string, host string, "
    "lines array<string>, previous array<string>, after array<string>"
)
_FIELDS = [f.split()[0] for f in _COMPARED.split(", ")]


def _settled(own: list[str], *others: list[str] | None) -> str:
    """What is left of a page without the lines that it shares with its neighbours."""
    shared: set[int] = set()
    for other in others:
        if other is not None and other != own:
            shared |= common(own, other)
    return " ".join(line.removeprefix(_FIXED) for i, line in enumerate(own) if i not in shared or line.startswith(_FIXED))


def _difference(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pages of one range in order; each but those with an article loses what it shares with the nearest pages of its host.

    Pages that have a neighbour in another range, if any, are given unsettled, with a null text: those equal to the
    first page of the range (`starts`) or to the last (`ends`). Rows with an `edge` are no pages but the lines that
    other ranges need: of the first page and the next of its host that differs ("first", "second"), and of
    the last page and the one of its host before that differs ("last", "but last").
    """
    waiting: list[tuple] = []  # pages of equal lines in a row
    host = own = before = None
    number, groups, first_host = 0, 0, True

    def edge(name: str, lines: list[str]) -> tuple:
        return 0, None, None, number, False, False, name, host, lines, None, None

    def done(page_id: int, url: str | None, text: str) -> tuple:
        return page_id, url, text, -1, False, False, None, None, None, None, None

    def close(after: list[str] | None, ends: bool = False) -> list[tuple]:
        starts = first_host and groups == 1
        if starts or ends:
            return [(i, u, None, number, starts, ends, None, host, own, before, after) for i, u in waiting]
        return [done(i, u, _settled(own, before, after)) for i, u in waiting]

    for frame in frames:
        out = []
        for page_id, url, page_host, text, lines_, number in zip(*[frame[c] for c in ("page_id", "url", "host", "text", "lines", "range")], strict=True):
            lines_ = list(lines_)
            if page_host != host:
                if host is not None:
                    out += close(None)
                    first_host = False
                waiting, host, own, before, groups = [], page_host, lines_, None, 1
                if first_host:
                    out.append(edge("first", own))
            elif lines_ != own:
                out += close(lines_)
                waiting, own, before, groups = [], lines_, own, groups + 1
                if first_host and groups == 2:
                    out.append(edge("second", own))
            if text is None:
                waiting.append((page_id, url))
            else:
                out.append(done(page_id, url, text))
        yield pd.DataFrame(out, columns=_FIELDS)
    if host is not None:
        out = [*close(None, ends=True), edge("last", own)]
        if before is not None:
            out.append(edge("but last", before))
        yield pd.DataFrame(out, columns=_FIELDS)


def _neighbours(edges: list[tuple[int, str, str, int]]) -> list[tuple[int, str, int, str]]:
    """(range, side, range and edge of the page meant) from (range, edge, host, hash of the lines) of all ranges.

    The page before the first of a range is the last of the range before, or if that is its copy, the next that
    differs, through as many ranges of copies as there are.
    """
    ranges: dict[int, dict[str, tuple[str, int]]] = defaultdict(dict)
    for number, edge, host, mark in edges:
        ranges[number][edge] = host, mark
    found = []
    for side, near, last, but_last in (("previous", "first", "last", "but last"), ("after", "last", "first", "second")):
        host = mark = page = differs = None
        for number in sorted(ranges, reverse=side == "after"):
            here = ranges[number]
            meant = None
            if page is not None and here[near][0] == host:
                meant = page if here[near][1] != mark else differs
            if meant:
                found.append((number, side, *meant))
            # Of a range of copies of one page, what differs from them lies where it did for the first of them.
            copies = here["first"][0] == here["last"][0] and but_last not in here
            differs = (number, but_last) if but_last in here else meant if copies else None
            page, (host, mark) = (number, last), here[last]
    return found


def _settle(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Unsettled pages with the neighbours from their own range and from others."""
    for frame in frames:
        columns = [[None if x is None else list(x) for x in frame[c]] for c in ("lines", "previous", "after", "far_previous", "far_after")]
        yield frame[["page_id", "url"]].assign(text=[_settled(*row) for row in zip(*columns, strict=True)])


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", pages_per_task: int = 20_000
) -> DataFrame:
    """(page_id, url, text) of every row.

    Pages are parsed where they lie. Only pages with undecided lines are moved, as lines, into ranges
    of (host, path): a host with a third of all pages is spread over many tasks. Pages at the edge of a range
    get the neighbours that lie in other ranges, so the texts are the same for any number of ranges.
    """
    bounded_batches(pages.sparkSession)
    url = F.col(url_col).cast("string")
    given = pages.select(
        F.col(id_col).cast("long").alias("page_id"), url.alias("url"), F.col(html_col).cast("string").alias("html")
    )
    parsed = cut(given.mapInPandas(_parse, "page_id long, url string, text string, lines array<string>"))
    undecided = F.size("lines") > 0
    ready = parsed.where(~undecided).select("page_id", "url", F.coalesce("text", F.lit("")).alias("text"))
    rest = F.coalesce(F.regexp_extract("url", r"://(.*)", 1), F.lit(""))
    placed = parsed.where(undecided).select(
        "page_id", "url", F.lower(F.regexp_extract(rest, r"^[^/?#]*", 0)).alias("host"),
        F.regexp_extract(rest, r"^[^/?#]*(.*)", 1).alias("path"), "text", "lines",
    )
    count = placed.count()
    if not count:
        return ready
    # Rows equal but for their lines have an order too.
    order = ["host", "path", "page_id", F.xxhash64("lines")]
    ranged = placed.repartitionByRange(-(-count // pages_per_task), *order).sortWithinPartitions(*order)
    numbered = ranged.select("page_id", "url", "host", "text", "lines", F.spark_partition_id().alias("range"))
    compared = cut(numbered.mapInPandas(_difference, _COMPARED))
    result = ready.unionByName(compared.where("text IS NOT NULL").select("page_id", "url", "text"))
    edges = compared.where("edge IS NOT NULL").select("range", "edge", "host", "lines")
    # At most four rows of a few words for each range.
    needed = _neighbours([tuple(r) for r in edges.select("range", "edge", "host", F.xxhash64("lines")).collect()])
    meant = pages.sparkSession.createDataFrame(needed, "to int, side string, range int, edge string")
    side = lambda name: F.first(F.when(F.col("side") == name, F.col("lines")), ignorenulls=True)
    far = meant.join(edges, ["range", "edge"]).groupBy(F.col("to").alias("range")).agg(
        side("previous").alias("far_previous"), side("after").alias("far_after")
    )
    waiting = compared.where("text IS NULL AND edge IS NULL").join(far, "range", "left").select(
        "page_id", "url", "lines", "previous", "after",
        F.expr("CASE WHEN starts THEN far_previous END").alias("far_previous"),
        F.expr("CASE WHEN ends THEN far_after END").alias("far_after"),
    )
    return result.unionByName(waiting.mapInPandas(_settle, "page_id long, url string, text string"))
