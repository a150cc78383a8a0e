"""Main-text extraction with wrappers inferred per host (union-free regular expressions).

A page becomes a stream of tokens: opening and closing container tags (with
their class, id and role), block tags, and text slots. ``fold`` resolves
neighbouring repeats into repeated groups. ``align`` generalises a wrapper so
that it also covers another page's stream: equal tokens stay, a group that
repeats in one of the two repeats in the result, and every other mismatch
becomes optional. No unions arise, so a wrapper is a regular expression of
tokens, text slots, ``( )?`` and ``( )+`` (``as_expression`` prints it).

A host's wrapper is inferred in a tree of bounded fan-in: tasks reduce pages to
distinct streams, groups of about ``FAN_IN`` streams of a host are aligned, their
wrappers are aligned in the next round, and so on to one; the number of groups
grows with the host's distinct streams, so a host with a third of all pages is
spread. Each page is then aligned with its host's wrapper, which gives every text
a place: the position in the wrapper and the open containers. Spark sums per
place whether the text is the same on all pages, its share of links and how many
pages have it.

The places decide which text is the article. Fixed places and places of links
are not. Names are a prior: places apart by name (navigation, headers, footers,
asides, forms, notices, adverts, comments, at any depth) are left out, and an
``article`` or ``main`` container, else one named like one, is believed if it
holds at least ``NAMED_SHARE`` of the text that varies. Otherwise the wrapper
alone decides: the places that vary between pages, without optional parts that
most pages lack, unless these stand in the main container, the deepest one with
``MAIN_SHARE`` of the text that varies. A page that would lose most of its varying
text this way (another template of its host) is judged by its own places.
Scripts, styles, comments and the head never enter the stream.

Defined results: null html counts as empty and gives an empty text; a url that
is null or has no host belongs to the host ''. Repeated rows are pages each.
Cut-off pages are read as far as they go: a head without its closing tag ends at
the first text or tag that cannot stand in it, and of skipped elements left open
only script, style and textarea run to the end. Character references are decoded,
white space inside a block (line breaks too) becomes one space, blocks are
joined by one line end. An empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

import html as entities
import json
import re
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartstreak.llm.common import Generations, quoted, table, text_of
from chartstreak.session import materialise, workers_import_package

FAN_IN = 64
LONGEST_PERIOD = 12
OUTSIDE = -1
# Shares of the text that varies: what a named article must hold to be believed, and what a main container holds.
NAMED_SHARE, MAIN_SHARE = 0.25, 0.6
BROADCAST_BYTES = 8 << 20

# Fixed values of HTML: how tags take part in a stream.
CONTAINERS = set("article aside body dialog div dl fieldset figure footer form header html main menu nav ol section "
                 "select table ul".split())
BLOCKS = set("address blockquote caption center dd details dt figcaption h1 h2 h3 h4 h5 h6 hr legend li option p pre "
             "summary tbody td tfoot th thead tr".split())
RAW = set("head script style noscript template svg math iframe object canvas audio video textarea button title".split())
# Elements whose text runs to the end of the page if their closing tag is missing.
UNENDING = set("script style textarea".split())
# Elements whose own text is no page text: without a closing tag a title ends at the next tag, others at the next block.
LABELS = set("title button svg math template".split())
# Tags that can stand in the head; the first other one ends a head that is left open.
HEAD_TAGS = set("base basefont bgsound link meta noframes noscript script style template title".split())
# Names of what is not the article, and of what is.
APART_TAGS = set("nav footer aside form menu select dialog".split())
APART_NAMES = set(
    "ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs byline comment comments "
    "complementary consent contentinfo cookie cookies copyright dialog disclaimer discussion disqus footer gdpr header "
    "login masthead menu menubar modal nav navbar navigation newsletter notice notices notification overlay pager "
    "pagination popup promo promoted promotion recommended related replies reply respond response responses search "
    "share sharing sidebar signup skip social sponsor sponsored subscribe subscription toc toolbar topbar tracking "
    "widget widgets".split())
LAYOUT_NAMES = set("has no with without".split())  # as in has-sidebar: the layout around, not the thing itself
ARTICLE_TAGS = set("article main".split())
ARTICLE_NAMES = set("article articlebody content entry main post story".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs2>[^>]*)(?:>|\Z)", re.S)
NAMED = re.compile(r"""(?:^|\s)(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PARTS = re.compile(r"[a-z]+")
TEXT = "#"


def signature(name: str, attrs: str) -> str:
    """Tag with the words of its class, id and role, as ``div.ad``."""
    if "=" not in attrs:
        return name
    words = [w for m in NAMED.finditer(attrs) for w in PARTS.findall((m[1] or m[2] or m[3] or "").lower())]
    return ".".join([name, *dict.fromkeys(words)])


def _tag(m) -> tuple[str, bool, str]:
    """Name, whether it closes, and attributes of a ``TOKEN`` match."""
    return (m["name"] or m["name2"] or "").lower(), bool(m["close"] or m["close2"]), m["attrs"] or m["attrs2"] or ""


def after_raw(name: str, source: str, at: int, unclosed: set) -> int:
    """Where the page goes on after a ``RAW`` element whose opening tag ends at ``at``.

    ``unclosed`` collects the names that have no closing tag in the rest of the page.
    """
    if name == "head":
        return _after_head(source, at, unclosed)
    if name not in unclosed:
        if end := re.compile(rf"</{name}\s*>", re.I).search(source, at):
            return end.end()
        unclosed.add(name)
    if name in UNENDING:
        return len(source)
    if name not in LABELS:
        return at
    while m := TOKEN.search(source, at):
        tag, _, _ = _tag(m)
        if tag and name == "title" or tag in CONTAINERS or tag in BLOCKS or tag == "body":
            return m.start()
        at = m.end()
    return len(source)


def _after_head(source: str, at: int, unclosed: set) -> int:
    """The end of a head: its closing tag, or what cannot stand in a head if that comes first."""
    stray = None
    while m := TOKEN.search(source, at):
        if stray is None and source[at:m.start()].strip():
            stray = at
        tag, closing, attrs = _tag(m)
        if closing and tag == "head":
            return m.end()
        if tag and (tag in ("body", "html") if closing else tag not in HEAD_TAGS and tag not in ("head", "html")):
            return m.start() if stray is None else stray
        at = m.end()
        if tag in RAW and tag != "head" and not closing and not attrs.endswith("/"):
            at = after_raw(tag, source, at, unclosed)
    return at if stray is None else stray


class Page:
    """Stream of a page: ``keys`` (tokens), ``texts`` and ``slots`` (by position of the text tokens)."""

    def __init__(self, source: str):
        self.keys: list = []
        self.texts: dict = {}
        self.slots: dict = {}
        self.links: dict = {}
        open_tags: list = []
        block = ""
        parts: list = []
        linked = 0
        in_link = False
        unclosed: set = set()

        def flush():
            nonlocal linked
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                at = len(self.keys)
                self.texts[at], self.links[at] = text, min(linked, len(text))
                self.slots[at] = "/".join([*open_tags, block])
                self.keys.append(TEXT)
            linked = 0

        def add_text(raw):
            nonlocal linked
            if raw:
                raw = entities.unescape(raw)
                parts.append(raw)
                if in_link:
                    linked += len(raw.strip())
        at = 0
        while m := TOKEN.search(source, at):
            add_text(source[at:m.start()])
            at = m.end()
            name, closing, attrs = _tag(m)
            if not name:
                continue
            if name in RAW:
                if not closing and not attrs.endswith("/"):
                    at = after_raw(name, source, at, unclosed)
                    if name != "head" and name not in ("script", "style"):
                        parts.append(" ")
            elif name in CONTAINERS:
                flush()
                block = ""
                if not closing:
                    open_tags.append(signature(name, attrs))
                    self.keys.append("<" + open_tags[-1])
                elif any(t.partition(".")[0] == name for t in open_tags):
                    while open_tags.pop().partition(".")[0] != name:
                        pass
                    self.keys.append("</" + name)
            elif name in BLOCKS:
                flush()
                block = "" if closing or name == "hr" else signature(name, attrs)
                if block:
                    self.keys.append("<" + block)
            elif name == "br":
                parts.append(" ")
            elif name == "a":
                in_link = not closing
        add_text(source[at:])
        flush()


def fold(keys: list) -> list:
    """(key, begin, end) items; a run of repeats becomes one item whose key is ``("+", body)``.

    A body of several tokens starts with a tag, so that a block keeps its text.
    """
    items = [(k, i, i + 1) for i, k in enumerate(keys)]
    for _ in range(3):
        out: list = []
        i, n = 0, len(items)
        names = [x[0] for x in items]
        while i < n:
            longest = 1 if names[i] == TEXT else LONGEST_PERIOD
            for period in range(1, min(longest, (n - i) // 2) + 1):
                if names[i] == names[i + period] and names[i:i + period] == names[i + period:i + 2 * period]:
                    end = i + 2 * period
                    while names[end:end + period] == names[i:i + period]:
                        end += period
                    body = names[i] if period == 1 and names[i][0] == "+" else ("+", tuple(names[i:i + period]))
                    out.append((body, items[i][1], items[end - 1][2]))
                    i = end
                    break
            else:
                out.append(items[i])
                i += 1
        if len(out) == n:
            break
        items = out
    return items


def absorb(items: list, groups: list) -> list:
    """Occurrences of a known repeated group's body, once or next to the group, become the group."""
    for body in sorted(groups, key=len, reverse=True):
        key, n, out, i = ("+", body), len(body), [], 0
        names = [x[0] for x in items]
        while i < len(items):
            if names[i] == key or tuple(names[i:i + n]) == body:
                end = i + (1 if names[i] == key else n)
                if out and out[-1][0] == key:
                    out[-1] = (key, out[-1][1], items[end - 1][2])
                else:
                    out.append((key, items[i][1], items[end - 1][2]))
                i = end
            else:
                out.append(items[i])
                i += 1
        items = out
    return items


def _groups(names) -> list:
    return list(dict.fromkeys(k[1] for k in names if k[0] == "+"))


def _matched(left: list, right: list) -> list:
    """Opcodes between two key lists; equal ends are matched first."""
    a, z, n = 0, 0, min(len(left), len(right))
    while a < n and left[a] == right[a]:
        a += 1
    while z < n - a and left[-1 - z] == right[-1 - z]:
        z += 1
    inner = SequenceMatcher(None, left[a:len(left) - z], right[a:len(right) - z], autojunk=False).get_opcodes()
    ops = [("equal", 0, a, 0, a)] if a else []
    ops += [(op, i + a, j + a, k + a, m + a) for op, i, j, k, m in inner]
    return ops + ([("equal", len(left) - z, len(left), len(right) - z, len(right))] if z else [])


def align(wrapper: list, other: list) -> list:
    """The wrapper [(key, optional)] that covers both wrappers; a page's stream is a wrapper without options."""
    def grown(items, groups):
        spans = absorb([(k, i, i + 1) for i, (k, _) in enumerate(items)], groups)
        return [(k, all(o for _, o in items[a:b])) for k, a, b in spans]
    groups = list(dict.fromkeys(_groups([k for k, _ in wrapper]) + _groups([k for k, _ in other])))
    wrapper, other = grown(wrapper, groups), grown(other, groups)
    out: list = []
    for op, i, j, k, m in _matched([x[0] for x in wrapper], [x[0] for x in other]):
        if op == "equal":
            out += [(x[0], x[1] or y[1]) for x, y in zip(wrapper[i:j], other[k:m])]
        else:
            out += [(key, True) for key, _ in wrapper[i:j] + other[k:m]]
    return out


def infer(wrappers: list) -> list:
    """One wrapper for all; longest first, so that shorter ones mostly make parts optional."""
    ordered = sorted(wrappers, key=lambda w: (-len(w), json.dumps(w)))
    whole = align(ordered[0], ordered[0])  # its own groups, everywhere
    for other in ordered[1:]:
        whole = align(whole, other)
    return whole


def as_expression(wrapper: list) -> str:
    def one(key):
        return "(" + " ".join(map(one, key[1])) + ")+" if key[0] == "+" else key + ("" if key == TEXT else ">")
    out: list = []
    for key, optional in wrapper:
        out.append(f"({one(key)})?" if optional else one(key))
    return " ".join(out)


def _named(part: str, names: set) -> bool:
    words = part.split(".")[1:]
    return not names.isdisjoint(words) and LAYOUT_NAMES.isdisjoint(words)


@lru_cache(100_000)
def apart(slot: str) -> bool:
    """Whether a slot lies in something that is not the article."""
    inside = False
    for part in slot.split("/"):
        tag = part.partition(".")[0]
        if tag == "main" or tag == "article" and not _named(part, APART_NAMES):
            inside = True
        elif tag in APART_TAGS or (tag == "header" and not inside):
            return True
        elif tag not in ("html", "body") and _named(part, APART_NAMES) and tag not in ("header", "h1"):
            return True
    return False


def _within(slot: str, tags: set, names: set) -> bool:
    return any(p.partition(".")[0] in tags or _named(p, names) for p in slot.split("/")[:-1])


def varies(seen: tuple) -> bool:
    """Whether a place holds text that differs between pages and is mostly not links."""
    constant, links, _, _ = seen
    return not constant and links < 0.5


def _weight(places, stats: dict) -> int:
    return sum(stats[p][2] for p in places if varies(stats[p]))


def main_container(stats: dict) -> list:
    """The open tags of the deepest container that holds most (``MAIN_SHARE``) of the text that varies."""
    inside: list = []
    total = _weight(stats, stats)
    while total:
        deeper: dict = {}
        for place in stats:
            path = place[1].split("/")[:-1]
            if varies(stats[place]) and len(path) > len(inside) and path[:len(inside)] == inside:
                deeper[path[len(inside)]] = deeper.get(path[len(inside)], 0) + stats[place][2]
        best = max(deeper, key=lambda t: (deeper[t], t), default=None)
        if best is None or deeper[best] < MAIN_SHARE * total:
            break
        inside.append(best)
    return inside


def article(stats: dict, options: bool = True) -> set:
    """The places of a wrapper that hold the article.

    ``stats``: (wrapper position, slot) -> (same text on all pages, share of
    link text, characters, whether it is an optional part that most pages lack).
    ``options=False`` keeps such parts wherever they stand.
    """
    stats = {p: v for p, v in stats.items() if not apart(p[1])}
    total = _weight(stats, stats)
    for tags, names in ((ARTICLE_TAGS, set()), (set(), ARTICLE_NAMES)):
        named = {p for p in stats if _within(p[1], tags, names)}
        if named and _weight(named, stats) >= NAMED_SHARE * total:
            return named
    main = main_container(stats)
    held = {p for p, v in stats.items() if varies(v) and (
        not options or not v[3] or p[1].split("/")[:-1][:len(main)] == main)}
    return held or {p for p, v in stats.items() if v[1] < 0.5}


def _plain(key):
    return tuple(_plain(x) for x in key) if isinstance(key, list) else key


def load(text: str) -> list:
    return [(_plain(k), bool(o)) for k, o in json.loads(text)]


def aligned(page: Page, wrapper: list, keys: list | None = None, groups: list | None = None):
    """(wrapper position, token) of each text token in page order; -1 for a token that the wrapper does not have."""
    keys = [k for k, _ in wrapper] if keys is None else keys
    items = absorb(fold(page.keys), _groups(keys) if groups is None else groups)
    for op, i, _, k, m in _matched(keys, [x[0] for x in items]):
        for n, (_, begin, end) in enumerate(items[k:m]):
            for token in range(begin, end):
                if token in page.texts:
                    yield (i + n if op == "equal" else OUTSIDE), token


def chosen(blocks: list, stats: dict, held: set) -> list:
    """The texts of a page's blocks (place, text) that lie in the places ``held``.

    A page that would lose most of its text that varies (another template of
    its host) is judged by its own places.
    """
    own = {place: stats[place] for place, _ in blocks}
    candidates = article(own, options=False)
    size = {True: 0, False: 0}
    for place, text in blocks:
        if place in held or place in candidates:
            size[place in held] += len(text)
    if size[True] < size[False]:
        held = candidates
    return [text for place, text in blocks if place in held]


STREAM = "host string, code long, stream string"
BLOCK = "struct<at:int,slot:string,text:string,links:long,optional:boolean,first:boolean>"


def _streams(batches):
    for frame in batches:
        seen = dict.fromkeys((host, json.dumps([(k, False) for k, _, _ in fold(Page(source).keys)]))
                             for host, source in zip(frame["host"], frame["html"]))
        yield pd.DataFrame([(h, xxhash.xxh3_64_intdigest(s) >> 1, s) for h, s in seen],
                           columns=["host", "code", "stream"])


def _inferred(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    wrapper = json.dumps(infer([load(s) for s in sorted(set(frame["stream"]))]))
    return pd.DataFrame({"host": [key[0]], "code": [xxhash.xxh3_64_intdigest(wrapper) >> 1], "stream": [wrapper]})


def host_of(url: str):
    return F.lower(F.regexp_extract(text_of(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html", fan_in: int = FAN_IN) -> DataFrame:
    """(host, code, stream): the wrapper of every host as JSON, merged in rounds of about ``fan_in`` wrappers a group."""
    workers_import_package(pages.sparkSession)
    src = pages.select(host_of(url_col).alias("host"), text_of(html_col).alias("html"))
    level = materialise(src.mapInPandas(_streams, STREAM).groupBy("host", "code").agg(F.min("stream").alias("stream")),
                        "streams")
    turn = 0
    while True:
        sizes = level.groupBy("host").agg(F.count("*").alias("n"))
        if (sizes.agg(F.max("n")).first()[0] or 0) <= 1:
            return level
        part = F.pmod(F.xxhash64("code", F.lit(turn)), F.ceil(F.col("n") / fan_in)).alias("part")
        dealt = level.join(sizes, "host").select("host", part, "code", "stream")
        level = materialise(dealt.groupBy("host", "part").applyInPandas(_inferred, STREAM), "wrappers")
        turn += 1


_wrappers, _articles = Generations(2_000), Generations(2_000)


def _aligned_blocks(batches):
    for frame in batches:
        out = []
        for source, stream in zip(frame["html"], frame["stream"]):
            known = _wrappers.get(stream)
            if known is None:
                wrapper = infer([load(stream)])
                keys = [k for k, _ in wrapper]
                known = wrapper, keys, _groups(keys)
                _wrappers.keep(stream, known)
            page, seen, blocks = Page(source), set(), []
            for at, token in aligned(page, *known):
                place = at, page.slots[token]
                blocks.append({"at": at, "slot": place[1], "text": page.texts[token], "links": page.links[token],
                               "optional": at == OUTSIDE or known[0][at][1], "first": place not in seen})
                seen.add(place)
            out.append(blocks)
        rows = frame[["page_id", "url", "host"]].copy()
        rows["page_id"] = rows["page_id"].astype("Int64")
        rows["blocks"] = out
        yield rows


def _with_hosts(pages: DataFrame, hosts: DataFrame, column: str) -> DataFrame:
    """``pages`` with the column of their host; broadcast only below ``BROADCAST_BYTES``."""
    size = hosts.agg(F.sum(F.octet_length(column))).first()[0] or 0
    hosts = hosts.select("host", column)
    joined = pages.join(F.broadcast(hosts) if size <= BROADCAST_BYTES else hosts.hint("merge"), "host", "left")
    return joined.withColumn(column, F.coalesce(column, F.lit("[]")))


def place_stats(blocks: DataFrame) -> DataFrame:
    """(host, stats): per place of the host's wrapper what ``article`` asks for, as JSON."""
    places = blocks.select("host", F.inline("blocks")).groupBy("host", "at", "slot").agg(
        F.min(F.xxhash64("text")).alias("low"), F.max(F.xxhash64("text")).alias("high"),
        F.sum(F.length("text")).alias("chars"), F.sum("links").alias("links"), F.count_if("first").alias("pages"),
        F.max("optional").alias("optional"))
    hosts = blocks.groupBy("host").agg(F.count("*").alias("all_pages"))
    rare = F.col("optional") & (F.col("pages") * 2 < F.col("all_pages"))
    constant = (F.col("low") == F.col("high")) & (F.col("pages") >= 3)
    return places.join(hosts, "host").groupBy("host").agg(F.to_json(F.collect_list(F.struct(
        "at", "slot", constant.alias("constant"), (F.col("links") / F.col("chars")).alias("links"), "chars",
        rare.alias("rare")))).alias("stats"))


def _extract(batches):
    for frame in batches:
        out = []
        for page, url, blocks, stats in zip(*(frame[c] for c in ("page_id", "url", "blocks", "stats"))):
            known = _articles.get(stats)
            if known is None:
                found = {(x["at"], x["slot"]): (x["constant"], x["links"], x["chars"], x["rare"])
                         for x in json.loads(stats)}
                known = found, article(found)
                _articles.keep(stats, known)
            text = "\n".join(chosen([((x["at"], x["slot"]), x["text"]) for x in blocks], *known))
            out.append((page, url, text, len(text)))
        rows = pd.DataFrame(out, columns=["page_id", "url", "text", "n_chars"])
        rows["page_id"] = rows["page_id"].astype("Int64")
        yield rows


def aligned_pages(pages: DataFrame, wrappers: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """(page_id, url, host, blocks): the text of every page by its place in the host's wrapper."""
    src = pages.select(F.col(quoted(id_col)).cast("long").alias("page_id"), F.col(quoted(url_col)).alias("url"),
                       host_of(url_col).alias("host"), text_of(html_col).alias("html"))
    return _with_hosts(src, wrappers, "stream").select("page_id", "url", "host", "html", "stream").mapInPandas(
        _aligned_blocks, f"page_id long, url string, host string, blocks array<{BLOCK}>")


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  wrappers: DataFrame | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page, by its host's wrapper (inferred from ``pages`` unless given)."""
    workers_import_package(pages.sparkSession)
    wrappers = infer_wrappers(pages, url_col, html_col) if wrappers is None else wrappers
    blocks = materialise(aligned_pages(pages, wrappers, id_col, url_col, html_col), "page-blocks")
    stats = materialise(place_stats(blocks), "place-stats")
    # a page without any block has no place to look at
    none = blocks.where(F.size("blocks") == 0).select("page_id", "url", F.lit("").alias("text"),
                                                      F.lit(0).cast("long").alias("n_chars"))
    some = _with_hosts(blocks.where(F.size("blocks") > 0), stats, "stats").select("page_id", "url", "blocks", "stats")
    return some.mapInPandas(_extract, "page_id long, url string, text string, n_chars long").union(none)


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
