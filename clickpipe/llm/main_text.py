"""Main text of web pages by tag-path ratios.

A page is read as a sequence of text nodes, each with its root-to-leaf path of
tags (a tag with the letters of its first class; ids and numbers set single nodes
apart, not kinds of them).  For every path the text length and
the punctuation of its nodes are averaged; the two ratios are fused to
``length * (1 + punctuation) * (1 - share of link text)``, smoothed over
neighbouring paths (Gaussian weight of the number of steps between them in the
tree up to ``REACH``, times the number of nodes; sums kept at each prefix, so the work is
linear in the paths) and held against ``LAMBDA`` standard
deviations of the smoothed ratios over the page's nodes.  A path that passes
makes its container (the path without its closing text-level tags) content, so
that a title or a short paragraph beside long ones stays; so does an ``h1`` in a
wrapper inside the best container.  An ``article`` or ``main``
element doubles the ratios inside and decides nothing else.  List items and
loose blocks of links only are left out, unless there is nothing else.  Paths
through elements that never hold an article (navigation, footers, forms ...)
or that are hidden take no part; a form, fieldset, label or dialog that holds an ``article``,
``main`` or half of the page's prose is a frame and no such element.  Where the best
container lies in an ``article`` or ``main``, containers outside every one of them
that follow its end are what readers and editors add, and left out; elsewhere that
holds for repeated items after the best container that each carry a byline (a time,
a reply link, a name before the text).  A class, role or wrapper's id that as a whole
names a menu, an advert, a notice, comments ... lowers the ratio of the paths
below, up to the next ``article`` or ``main``; names on headings don't count.

Narrow map over the pages, state of one page at a time; character references
are decoded, white space inside a block becomes one space, blocks are joined
in page order by a line feed; nothing is capped.

Defined cases: null or empty html gives an empty text; a page without tags is
one block; unclosed elements are closed as HTML does for paragraphs, list items
and table cells, others at the end of their parent; a tag cut off by the end
of the page is dropped; repeated rows and extra columns pass through (an input
column named ``text`` or ``n_chars`` is replaced).
"""

from __future__ import annotations

import html as html_lib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpipe.llm.common import read_table, workers_import

LAMBDA = 0.5
SIGMA = 1.0
REACH = 6

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|textarea|iframe|svg|math|object|select"
#: Elements that never hold the article.
OUTSIDE = frozenset("head title nav footer aside button menu".split())
#: Elements that hold it only as the page's frame.
FRAMES = frozenset("form fieldset label dialog".split())
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr br img".split())
#: Text-level blocks: they end a path, their container is what is above.
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table thead tbody tfoot tr td th figure figcaption hr".split())
ARTICLE = frozenset(("article", "main"))
#: Words of a class, id or role that name other parts of a page.
NAMED = frozenset("ad ads adv advert adverts advertisement advertising adsense adbox sponsor sponsors sponsored promo promos promotion banner banners "
                  "cookie cookies consent gdpr notice notices alert alerts popup popups modal overlay nav navbar navigation menu menus "
                  "breadcrumb breadcrumbs sidebar sidebars rail widget widgets related recommended recommendations share sharing sharebar social "
                  "comment comments disqus reply replies respond footer masthead topbar toolbar header siteheader newsletter subscribe signup "
                  "login search pagination pager tags tagcloud copyright legal complementary contentinfo skip".split())
#: Words that may stand beside them; any other word makes a name of its own (``entry-header``, ``related-work``, ``has-sidebar``).
BESIDE = frozenset("site page main top bottom left right side primary secondary global mobile bar box block area wrap wrapper container outer inner "
                   "section list item items message messages links link posts articles stories buttons icons form text content sticky fixed inline".split())
#: Words that name readers' comments, and what may stand beside those alone.
REPLIES = frozenset("comment comments disqus reply replies respond response responses discussion discussions".split())
OF_REPLIES = frozenset("body post posts user users reader readers thread threads view meta count".split())
#: ``more-stories``, ``more-links``: teasers.
TEASED = frozenset("story stories article articles post posts news links reading".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What a name takes from a path's ratio, and what an ``article`` or ``main`` element adds.
NAMED_WEIGHT, ARTICLE_WEIGHT = 0.01, 2.0

TOKEN = re.compile(
    rf"""(?P<skip><!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b(?:[^>"']++|"[^"]*+"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*(?:>|\Z))"""
    r"""|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*)>"""
    r"""|(?P<cut></?[a-z][^>]*\Z)|(?P<text>[^<]+|<)""", re.I | re.S)
ATTR = re.compile(r"""(?:^|\s)(class|id|role|hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")
SPACE = re.compile(r"\s+")
#: A start tag here closes an open element of the second kind, up to one of the third.
CLOSES = ({t: (("p",), ()) for t in "p div ul ol dl table h1 h2 h3 h4 h5 h6 blockquote pre section article main aside nav header footer form hr figure address".split()}
          | {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "option": (("option",), ("select",)),
             "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table"))})
SCOPE = frozenset("body article main section div td th li table aside nav header footer form blockquote figure button".split())


def _names_other_part(token: str) -> bool:
    """Whether a whole class, id or role names another part of the page."""
    words = re.findall(r"[a-z0-9]+", token)
    if not NAMED.isdisjoint(words) and all(w in NAMED or w in BESIDE for w in words):
        return True
    return _names_replies(token) or len(words) == 2 and words[0] == "more" and words[1] in TEASED


def _names_replies(token: str) -> bool:
    words = re.findall(r"[a-z0-9]+", token)
    return not REPLIES.isdisjoint(words) and all(w in REPLIES or w in NAMED or w in BESIDE or w in OF_REPLIES for w in words)


class Page:
    """A page's text nodes and paths.

    ``nodes``: block, path number, text and innermost container (an instance) of each;
    ``paths``, and by path whether it takes no part, is ``named`` as another part, and
    lies in a form or the like that may be a frame (``frames``, instance numbers)."""

    def __init__(self):
        self.nodes: list[tuple[int, int, str, int]] = []
        self.paths: list[tuple[str, ...]] = []
        self.outside: list[bool] = []
        self.named: list[bool] = []
        self.frames: list[tuple[int, ...]] = []
        self.framed: dict[int, bool] = {}  # forms and the like: whether an article or main lies inside


def _attributes(tag: str, attrs: str) -> tuple[str, bool, bool]:
    """A tag's own name part (letters of its first class), whether it is hidden, and whether it names another part of the page."""
    label, hidden, named = "", False, False
    for key, value in ATTR.findall(attrs):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or (key == "style" and "display:none" in value.replace(" ", "")):
            hidden = True
        elif key != "style":
            words = re.findall(r"[a-z]+", value) if key == "class" else ()
            label = label or (words[0] if words else "")
            if tag not in HEADING and not (key == "id" and tag in LEAF | INLINE):
                named |= any(map(_names_other_part, value.split()))
    return label, hidden, named


def read_page(page: str) -> Page:
    """The text nodes of a page."""
    out, numbers, block, instance = Page(), {}, 0, 0
    nodes = out.nodes
    stack: list[tuple] = []  # tag, name in a path, outside, named, frames, container instance
    for m in TOKEN.finditer(page):
        if m["text"] is not None:
            if not m["text"].isspace():
                off, other, frames, item = stack[-1][2:] if stack else (False, False, (), 0)
                key = (tuple(x[1] for x in stack), off, other, frames)
                if key not in numbers:
                    numbers[key] = len(out.paths)
                    for held, value in zip((out.paths, out.outside, out.named, out.frames), key, strict=True):
                        held.append(value)
                nodes.append((block, numbers[key], m["text"], item))
            elif nodes and nodes[-1][0] == block:
                nodes[-1] = (*nodes[-1][:2], nodes[-1][2] + " ", nodes[-1][3])
        elif m["tag"]:
            tag = m["tag"].lower()
            if tag not in INLINE:
                block += 1
            if m["end"]:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        break
                    if tag in INLINE and stack[i][0] not in INLINE or tag == "p" and stack[i][0] in SCOPE:
                        break
                continue
            ends, until = CLOSES.get(tag, ((), ()))
            for i in range(len(stack) - 1, -1, -1) if ends else ():
                if stack[i][0] in ends:
                    del stack[i:]
                    break
                if stack[i][0] in (until or SCOPE):
                    break
            if tag == "br" and nodes and nodes[-1][0] == block:
                nodes[-1] = (*nodes[-1][:2], nodes[-1][2] + " ", nodes[-1][3])
            if tag in VOID or m["attrs"].endswith("/") and tag not in SCOPE:
                continue
            label, off, other = _attributes(tag, m["attrs"]) if m["attrs"] else ("", False, False)
            in_article = any(x[0] in ARTICLE for x in stack)
            # a page may name its whole frame oddly; the frame itself is never outside, and no name reaches into it
            off = off and tag not in ("html", "body", *ARTICLE) or tag in OUTSIDE or tag == "header" and not in_article
            if tag == "body":  # whatever a broken head left open ends here
                stack = [x for x in stack if x[0] == "html"]
            above = stack[-1] if stack else (None, None, False, False, (), 0)
            frame = tag in ("html", "body") or tag in ARTICLE and not (other and _said_replies(m["attrs"]))
            other = not frame and (other and not (tag == "header" and in_article) or above[3])
            frames, instance = above[4], instance + 1
            if tag in FRAMES:
                out.framed[instance] = False
                frames = (*frames, instance)
            elif tag in ARTICLE:
                out.framed.update(dict.fromkeys(frames, True))
            item = above[5] if tag in LEAF - {"li"} | INLINE else instance
            stack.append((tag, f"{tag}.{label}" if label else tag, off or above[2], other, frames, item))
    return out


def _said_replies(attrs: str) -> bool:
    """Whether a class says that the element is a comment."""
    return any(_names_replies(t) for key, value in ATTR.findall(attrs) if key.lower() == "class" for t in value.strip("\"'").lower().split())


def _settle_frames(page: Page) -> None:
    """Marks the paths in forms and the like as outside, unless those are the page's frame."""
    def prose(p: int, text: str) -> int:
        return len(text) if len(text) >= 80 and PUNCTUATION.search(text) and "a" not in _tags(page.paths[p]) else 0

    inside, whole = dict.fromkeys(page.framed, 0), 0
    for _, p, text, _ in page.nodes:
        if not page.outside[p] and (n := prose(p, text)):
            whole += n
            for f in page.frames[p]:
                inside[f] += n
    closed = {f for f, article in page.framed.items() if not article and not (inside[f] and 2 * inside[f] >= whole)}
    page.outside = [off or not closed.isdisjoint(f) for off, f in zip(page.outside, page.frames, strict=True)]


def _tags(path: tuple[str, ...]) -> list[str]:
    return [x.partition(".")[0] for x in path]


def _container(path: tuple[str, ...]) -> tuple[str, ...]:
    n = len(path)
    while n and path[n - 1].partition(".")[0] in LEAF | INLINE | {"header", "hgroup"}:  # a header that takes part is an article's
        n -= 1
    return path[:n]


def smoothed(paths: list[tuple[str, ...]], count: list[int], fused: dict[int, float]) -> dict[int, float]:
    """Each path's mean over its neighbours up to ``REACH`` steps away, Gaussian weights times nodes.

    A prefix holds the sums of the paths below it by depth; a path meets every other one
    at their last common prefix, so it asks its nearest prefixes only."""
    sums: dict[tuple, list] = {}  # (prefix, steps below it) -> nodes, nodes times ratio
    for p in fused:
        path = paths[p]
        for d in range(min(REACH, len(path)) + 1):
            held = sums.setdefault((path[:len(path) - d], d), [0.0, 0.0])
            held[0] += count[p]
            held[1] += count[p] * fused[p]
    weight = [math.exp(-d * d / (2 * SIGMA ** 2)) for d in range(REACH + 1)]
    out, none = {}, (0.0, 0.0)
    known: dict[tuple, float] = {}
    for p in fused:
        path = paths[p]
        if path not in known:
            total, mean = 0.0, 0.0
            for up in range(min(REACH, len(path)) + 1):
                prefix, child = path[:len(path) - up], path[:len(path) - up + 1]
                for down in range(REACH - up + 1):
                    n, f = sums.get((prefix, down), none)
                    if up and down:  # those below the same child were met nearer by
                        n, f = n - sums.get((child, down - 1), none)[0], f - sums.get((child, down - 1), none)[1]
                    total += n * weight[up + down]
                    mean += f * weight[up + down]
            known[path] = mean / total
        out[p] = known[path]
    return out


def content_nodes(page: Page) -> list[tuple[int, int, str, int]]:
    """The nodes that are content, in page order."""
    paths = page.paths
    length, marks, count = [0] * len(paths), [0] * len(paths), [0] * len(paths)
    for _, p, text, _ in page.nodes:
        length[p] += len(text.strip())
        marks[p] += len(PUNCTUATION.findall(text))
        count[p] += 1
    inside = [p for p in range(len(paths)) if not page.outside[p]]
    if not inside:
        return []
    linked = [0.9 if "a" in _tags(path) else 0.0 for path in paths]
    fused = {p: length[p] / count[p] * (1 + marks[p] / count[p]) * (1 - linked[p]) for p in inside}
    smooth = smoothed(paths, count, fused)
    for p in inside:
        smooth[p] *= NAMED_WEIGHT if page.named[p] else 1
        smooth[p] *= ARTICLE_WEIGHT if ARTICLE & set(_tags(paths[p])) else 1
    n = sum(count[p] for p in inside)
    mean = sum(count[p] * smooth[p] for p in inside) / n
    threshold = LAMBDA * math.sqrt(sum(count[p] * (smooth[p] - mean) ** 2 for p in inside) / n)
    passed = [p for p in inside if smooth[p] >= threshold and smooth[p] > 0]
    place = {p: (_container(paths[p]), page.named[p]) for p in inside}
    held = {place[p] for p in passed}
    chosen = {p for p in inside if place[p] in held}
    return _without_additions(page, chosen, place, length)


def _without_additions(page: Page, chosen: set[int], place: dict[int, tuple], length: list[int]) -> list[tuple[int, int, str, int]]:
    """The chosen nodes without what follows the best container and isn't the article's."""
    mass: dict[tuple, int] = {}
    for p in chosen:
        mass[place[p]] = mass.get(place[p], 0) + (0 if "a" in _tags(page.paths[p]) else length[p])
    if not mass:
        return []
    best = max(mass, key=lambda c: (not c[1], mass[c]))
    end = max(i for i, x in enumerate(page.nodes) if x[1] in chosen and place[x[1]] == best)
    # The title may stand in a wrapper of its own inside the best container.
    chosen = chosen | {p for p in place if not page.named[p] and page.paths[p][:len(best[0])] == best[0] and "h1" in _tags(page.paths[p]) and "a" not in _tags(page.paths[p])}
    in_article = bool(ARTICLE & set(_tags(best[0])))
    late = [(i, x) for i, x in enumerate(page.nodes) if i > end and x[1] in chosen]
    if in_article:
        dropped = {i for i, x in late if not ARTICLE & set(_tags(page.paths[x[1]]))}
    else:
        items: dict[int, list[tuple[int, tuple]]] = {}
        for i, x in late:
            items.setdefault(x[3], []).append((i, x))
        signed: dict[tuple, list[int]] = {}
        for item, found in items.items():
            if _has_byline(page, [x for _, x in found]):
                signed.setdefault(place[found[0][1][1]], []).append(item)
        dropped = {i for group in signed.values() if len(group) > 1 for item in group for i, _ in items[item]}
    return [x for i, x in enumerate(page.nodes) if x[1] in chosen and i not in dropped]


def _has_byline(page: Page, nodes: list[tuple[int, int, str, int]]) -> bool:
    """Whether an item starts with a short name or time, or a reply link follows its text."""
    tags = [set(_tags(page.paths[x[1]])) for x in nodes]
    short = len(nodes) > 1 and len(nodes[0][2].strip()) <= 40 and not tags[0] & HEADING and bool(tags[0] & {"a", "b", "strong", "span", "cite", "time", "small"})
    return short or any("time" in t for t in tags) or len(nodes) > 1 and "a" in tags[-1] and len(nodes[-1][2].strip()) <= 20


def _link_lists(nodes: list[tuple[int, int, str, int]], paths: list[tuple[str, ...]]) -> set[int]:
    """Blocks outside paragraphs and headings that hold no letter or digit but in links."""
    linked, free = set(), set()
    for block, p, text, _ in nodes:
        tags = set(_tags(paths[p]))
        if "a" in tags and tags.isdisjoint(HEADING | {"p"}):
            linked.add(block)
        elif any(map(str.isalnum, text)):
            free.add(block)
    return linked - free


def main_text(page: str | None) -> str:
    """The text of the content nodes of a page, one block a line."""
    if not page:
        return ""
    read = read_page(page)
    _settle_frames(read)
    nodes = content_nodes(read)
    blocks: dict[int, list[str]] = {}
    for block, _, text, _ in nodes:
        blocks.setdefault(block, []).append(text)
    lists = _link_lists(nodes, read.paths)
    if lists != blocks.keys():
        blocks = {k: x for k, x in blocks.items() if k not in lists}
    lines = (SPACE.sub(" ", html_lib.unescape("".join(x))).strip() for x in blocks.values())
    return "\n".join(x for x in lines if x)


def extract(df: DataFrame, html: str = "html") -> DataFrame:
    """Replaces the column ``html`` by ``text``."""
    workers_import(df.sparkSession)
    rest = [c for c in df.columns if c not in (html, "text")]
    schema = T.StructType([df.schema[c] for c in rest] + [T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pa.array([main_text(x.as_py()) for x in batch.column(html)], pa.string())
            yield pa.RecordBatch.from_arrays([*map(batch.column, rest), text], names=[*rest, "text"])

    return df.mapInArrow(run, schema)


def op7_main_text(spark, sf_dir: str) -> DataFrame:
    """Main text of every page and its number of code points."""
    pages = read_table(spark, sf_dir, "pages", "page_id", "url", "html")
    return extract(pages).withColumn("n_chars", F.length("text").cast("long"))
