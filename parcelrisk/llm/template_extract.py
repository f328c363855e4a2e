"""Main text of web pages by equivalence-class template deduction.

A page's tokens are its block elements, each named by its path of tags with their class and id, and the texts that
stand in them, each named by its words and its element's path. Over the pages of a host, tokens that occur equally
often on every page share an occurrence vector and form an equivalence class. Classes on most pages, once on each and
in one order, are valid: nested by their paths they are the host's template. Every text lies in the slot of its
innermost template token, or is a template token and no main text. Slots are told apart by what fills them on all
pages of the host, by their elements' names and by their share of link text, and the article's slots are read out of
each page.

Occurrence vectors are compared through an order-free sum of hashes of (page, count), so they are aggregated per
task before the shuffle, however many pages a host has. What is gathered per host are tokens on half of its
pages at least, no more than a page has.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelrisk.llm.common import map_rows, stored, text_or_empty, type_of

SMALL_HOSTS = 20_000       # as many templates are broadcast; more of them are joined by a shuffle
COMMON = 0.5               # share of a host's pages that a template token is on
ORDERED = 0.9              # share of its pages on which the tokens of a class come in one order
TEXT_PAGES = 3             # pages of different content that a constant text is on at least; a repeated page has no template
LINK_SHARE = 0.6           # of a slot's text; a menu has more

_TAG = re.compile(r"<(?:!--(?:.*?-->|.*$)|(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(>|$)|[!?/][^>]*(?:>|$))", re.S)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby s samp small span strike strong sub sup time tt u var wbr".split())
_RAW = frozenset("script style template noscript textarea iframe svg math object select title xmp".split())
_IMPLIED_END = {"p": frozenset(["p"]), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
                "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"])}
_SCOPE = frozenset("article section div main aside nav header footer form body ul ol table td blockquote details figure fieldset".split())
_BOILER_TAGS = frozenset("nav footer aside form button menu dialog head title script style template noscript textarea iframe select svg math object label input".split())
_BOILER_NAMES = frozenset(
    "ad ads adv advert advertisement adverts advertising alert banner breadcrumb breadcrumbs byline comment comments commentlist consent "
    "cookie cookies copyright disclaimer discussion disqus feedback footer form gdpr header legal login masthead menu modal nav navbar "
    "navigation newsletter notice notices notification overlay pagination pager popup promo promotion recommended related replies reply "
    "respond responses search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar topbar "
    "widget widgets".split())
_READERS = frozenset("comment comments commentlist discussion disqus replies reply respond responses".split())   # differ from page to page
_STRUCTURED = frozenset("template noscript svg math object select".split())   # of _RAW, those whose content is tags
_ARTICLE = frozenset(["article", "main"])
_P = frozenset(["p"])
_NAME_PART = re.compile(r"[a-z]+")


class Element:
    """An open block element. Its token is the hash of its path, so that no path is ever spelled out."""

    __slots__ = ("boiler", "depth", "inside", "key", "parent", "soft", "step", "tag")

    def __init__(self, parent: Element | None, tag: str, names: list[str]):
        self.parent, self.tag, self.step = parent, tag, ".".join([tag, *names])
        self.depth = parent.depth + 1 if parent else 0
        self.key = xxhash.xxh64_intdigest(self.step, parent.key if parent else 0) >> 1
        self.inside = tag in _ARTICLE or bool(parent and parent.inside)   # of an article
        sure, named = is_boiler(tag, names, bool(parent and parent.inside))
        self.boiler = bool(parent and parent.boiler) or sure or named
        self.soft = self.boiler and not sure and (parent is None or not parent.boiler or parent.soft)   # by names alone


def is_boiler(tag: str, names: list[str], inside: bool) -> tuple[bool, bool]:
    """Whether an element surely holds no main text, by its tag or as readers' words, and whether its class or id says so; a
    header within an article may."""
    if tag in _BOILER_TAGS or (tag == "header" and not inside):
        return True, False
    if tag in _ARTICLE or tag in ("body", "html"):
        return False, False
    parts = {p for n in names for p in _NAME_PART.findall(n)}
    return not parts.isdisjoint(_READERS), not parts.isdisjoint(_BOILER_NAMES)


def raw_end(html: str, at: int, tag: str, path: list[Element]) -> int:
    """Where an element without main text ends whose start tag ends at ``at``: at its end tag or, if that is missing or comes
    later, at the end of the element around it; a script without one goes to the page's end."""
    m = re.compile(rf"</{tag}\b[^>]*(?:>|$)", re.I).search(html, at)
    if m and tag not in _STRUCTURED:
        return m.end()
    outer = next((e.tag for e in reversed(path) if e.tag in _SCOPE), None)
    if outer and tag not in ("script", "style"):
        depth = 1
        for x in re.compile(rf"<(/?){outer}\b", re.I).finditer(html, at, m.start() if m else len(html)):
            depth += -1 if x[1] else 1
            if not depth:
                return x.start()
    return m.end() if m else len(html)


def read_blocks(html: str) -> Iterator[tuple[str, Element | None, str, bool]]:
    """("open", element, "", False) for each block element, ("text", element, text, in a link) for each piece of text
    and ("break", element, "", False) where a block ends or a line breaks; the element is the innermost open one."""
    path: list[Element] = []
    links = 0
    at, size = 0, len(html)

    def inner() -> Element | None:
        return path[-1] if path else None

    while at < size:
        m = _TAG.search(html, at)
        if m is None:
            rest = html[at:]
            cut = rest.rfind("<")
            if cut >= 0 and re.match(r"</?[a-zA-Z!]|</?$", rest[cut:]):  # a tag that the page's end cuts off
                rest = rest[:cut]
            if rest:
                yield "text", inner(), rest, links > 0
            return
        if m.start() > at:
            yield "text", inner(), html[at:m.start()], links > 0
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag not in _INLINE and tag not in _VOID:
                for k in range(len(path) - 1, -1, -1):
                    if path[k].tag == tag:
                        del path[k:]
                        break
                links = 0 if tag in _SCOPE else links
                yield "break", inner(), "", False
        elif tag in _RAW:
            yield "break", inner(), "", False
            if tag not in ("svg", "math") or not m[3].endswith("/"):
                at = raw_end(html, at, tag, path)
        elif tag == "a":
            links += 1
        elif tag in _VOID:
            if tag not in ("wbr", "img"):
                yield "break", inner(), "", False
        elif tag not in _INLINE:
            ends = _IMPLIED_END.get(tag, _P)
            for k in range(len(path) - 1, -1, -1):
                if path[k].tag in ends:
                    del path[k:]
                    break
                if path[k].tag in _SCOPE:
                    break
            path.append(Element(inner(), tag, sorted({x.lower() for a in _ATTR.finditer(m[3]) for x in (a[2] or a[3] or a[4] or "").split()})))
            yield "open", path[-1], "", False
            yield "break", path[-1], "", False


TEXT = "#text"               # the tag of a text's token


def read_units(html: str) -> Iterator[tuple[Element | None, int | None, list[tuple[str, bool]]]]:
    """(element, its key, []) for each block element, and (innermost element, key, [(piece, in a link)]) for each text between
    blocks; the key is None if there are no words. Line breaks are spaces."""
    owner: Element | None = None
    pieces: list[tuple[str, bool]] = []

    def run() -> tuple[Element | None, int | None, list[tuple[str, bool]]]:
        words = " ".join(unescape("".join(t for t, _ in pieces)).split())
        return owner, xxhash.xxh64_intdigest(f"{TEXT} {words}".encode("utf-8", "surrogatepass"), owner.key if owner else 0) >> 1 if words else None, pieces

    for kind, e, text, linked in read_blocks(html):
        if kind == "break":
            pieces.append((" ", False))
            continue
        if pieces and (kind == "open" or e is not owner):
            yield run()
            pieces = []
        owner = e
        if kind == "open":
            yield e, e.key, []
        else:
            pieces.append((text, linked))
    if pieces:
        yield run()


def page_tokens(html: str) -> list[tuple]:
    """(key, parent, tag, boiler, depth, n, text, linked, soft) of each token: its count, and an element's text and link text that
    lies in no inner element."""
    out: dict[int, list] = {}
    for e, key, pieces in read_units(html):
        if e is not None:
            cell = out.setdefault(e.key, [e.key, e.parent.key if e.parent else -1, e.tag, e.boiler, e.depth, 0, 0, 0, e.soft])
            cell[5] += not pieces
            for text, linked in pieces:
                n = len(text.strip())
                cell[6] += n
                cell[7] += n * linked
        if pieces and key is not None:
            place = (e.key, e.boiler, e.depth + 1) if e else (-1, False, 0)
            out.setdefault(key, [key, place[0], TEXT, place[1], place[2], 0, 0, 0, False])[5] += 1
    return list(map(tuple, out.values()))


def class_orders(html: str, vectors: dict[int, int]) -> dict[int, int]:
    """For each class that the page has, a hash of its tokens in the page's order; ``vectors`` has the tokens' classes."""
    out: dict[int, int] = {}
    for _, key, _ in read_units(html):
        if key in vectors:
            out[vectors[key]] = xxhash.xxh64_intdigest(key.to_bytes(8, "little"), out.get(vectors[key], 0)) >> 1
    return out


def deduce_template(tokens: list[dict], size: int, unordered: set[int] = frozenset()) -> dict[int, bool]:
    """For each template token of a host whether its slot is main text; a constant text is none.

    ``tokens`` have key, parent (-1 for none), tag, boiler, depth, vector, pages, n, text and linked; those on fewer
    than a share of the host's ``size`` pages are left out, so an element's parent is there if the element is.
    ``soft`` ones are boilerplate by their names alone, and hold main text within the main slot unless most of it is links.
    ``unordered`` are the vectors of classes whose tokens come in no one order.
    """
    classes: dict[int, list[dict]] = {}
    for t in tokens:
        classes.setdefault(t["vector"], []).append(t)
    valid = [t for v, c in classes.items() if v not in unordered for t in c if t["pages"] >= COMMON * size and t["n"] == t["pages"]]
    constant = {t["key"] for t in valid if t["tag"] == TEXT}
    of = {t["key"]: t for t in tokens if t["tag"] != TEXT}
    names = {t["key"] for t in valid if t["tag"] != TEXT}
    outer_first = sorted(of, key=lambda k: (of[k]["depth"], k))
    slot: dict[int, int] = {-1: -1}   # the innermost template token that a token lies in
    filled = {k: [0, 0] for k in names}
    for k in outer_first:
        slot[k] = k if k in names else slot.get(of[k]["parent"], -1)
        if slot[k] != -1 and of[k]["boiler"] == of[slot[k]]["boiler"]:
            filled[slot[k]][0] += of[k]["text"]
            filled[slot[k]][1] += of[k]["linked"]
    good = {k for k in names if not of[k]["boiler"] and filled[k][1] <= LINK_SHARE * filled[k][0]}
    under = {k: filled[k][0] if k in good else 0 for k in names}   # text in and below
    nested = [k for k in outer_first if k in names]
    for k in reversed(nested):
        outer = slot.get(of[k]["parent"], -1)
        if outer != -1:
            under[outer] += under[k]
    pool = [k for k in nested if of[k]["tag"] in _ARTICLE and not of[k]["boiler"]]
    articles = bool(pool)
    pool = pool or [k for k in nested if of[k]["tag"] not in ("html", "body") and not of[k]["boiler"]] or nested
    if not pool:
        return dict.fromkeys(constant, False)
    most = max(under[k] for k in pool)
    root = next(k for k in pool if under[k] == most) if articles else [k for k in pool if under[k] >= 0.9 * most][-1]
    outer = root
    while of[outer]["tag"] not in _SCOPE and slot.get(of[outer]["parent"], -1) != -1:   # a paragraph is no slot, what holds it is
        outer = slot[of[outer]["parent"]]
    if outer in pool and of[outer]["tag"] in _SCOPE:
        root = outer
    below: set[int] = set()
    for k in nested:
        if k == root or slot.get(of[k]["parent"], -1) in below:
            below.add(k)
    within = {k: list(filled[k]) for k in names}
    for k in reversed(nested):
        outer = slot.get(of[k]["parent"], -1)
        if outer != -1:
            within[outer] = [a + b for a, b in zip(within[outer], within[k], strict=True)]
    dropped: set[int] = set()
    for k in nested:
        if k in below and of[k].get("soft"):
            if slot.get(of[k]["parent"], -1) in dropped or within[k][1] > LINK_SHARE * within[k][0]:
                dropped.add(k)
            else:
                good.add(k)
    return {k: k in good and k in below for k in names} | dict.fromkeys(constant, False)


def main_text(html: str, template: dict[int, bool]) -> str:
    """The text of the page's main slots, blocks joined by a space."""
    out: list[str] = []
    known: dict[int, bool] = {}
    by_names: bool | None = None
    usable = any(template.values())

    def wanted(e: Element | None) -> bool:
        nonlocal by_names
        above, main = [], None
        while e is not None and main is None:
            above.append(e)
            main = known.get(e.key)
            if main is None and usable and e.key in template:
                main = template[e.key]
            e = e.parent
        if main is None:  # outside of the template, or a page unlike its host's others: by the elements' names
            if by_names is None:
                by_names = re.search(r"<(article|main)\b", html, re.I) is not None
            return (not by_names or bool(above and above[0].inside)) and not (above and above[0].boiler and not (by_names and above[0].soft))
        for x in reversed(above):
            main = known[x.key] = main and (not x.boiler or x.soft)
        return main

    for e, key, pieces in read_units(html):
        main = key is not None and bool(pieces) and key not in template and wanted(e)   # a text in the template is constant
        out += [text for text, _ in pieces] if main else " "
    return " ".join(unescape("".join(out)).split())


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Id, url, text and n_chars of every page.

    Null html counts as empty and gives an empty text. Pages without a host in their url, null urls too, form one
    group. Repeated rows give repeated results, and count as often for their host; other columns are ignored; an
    empty table gives an empty one.
    """
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url_col), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)", 1), F.lit("")))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"), text_or_empty(F.col(html_col)).alias("html"))

    def tokens(it: Iterator[tuple]) -> Iterator[dict]:
        names = ("host", "page", "content", "key", "parent", "tag", "boiler", "depth", "n", "text", "linked", "soft")
        out: dict[str, list] = {n: [] for n in names}
        for page, host_name, html in it:
            content = 1 << xxhash.xxh64_intdigest(html.encode("utf-8", "surrogatepass")) % 63
            for token in page_tokens(html):
                for name, v in zip(names, (host_name, page, content, *token), strict=True):
                    out[name].append(v)
            if len(out["n"]) > 20_000:
                yield out
                out = {n: [] for n in names}
        yield out

    kind = type_of(rows, "id")
    seen = map_rows(rows.select("id", "host", "html"), tokens,
                    f"host string, page {kind}, content long, key long, parent long, tag string, boiler boolean, depth int, n long, text long, linked long, soft boolean")
    own = ["key", "parent", "tag", "boiler", "depth", "soft"]
    vectors = seen.groupBy("host", *own).agg(
        F.sum(F.pmod(F.xxhash64("page", "n"), F.lit(1 << 40))).alias("vector"), F.count("*").alias("pages"),
        F.bit_count(F.bit_or("content")).alias("contents"), F.sum("n").alias("n"), F.sum("text").alias("text"), F.sum("linked").alias("linked"))
    sizes = rows.groupBy("host").agg(F.count("*").alias("size"))
    common = (F.col("pages") >= COMMON * F.col("size")) & ((F.col("tag") != TEXT) | (F.col("contents") >= TEXT_PAGES))
    hosts = stored(vectors.join(sizes, "host").filter(common)
                   .groupBy("host", "size").agg(F.collect_list(F.struct(*own, "vector", "pages", "n", "text", "linked")).alias("tokens")), "tokens")
    few = sizes.count() <= SMALL_HOSTS

    def orders(it: Iterator[tuple]) -> Iterator[dict]:
        known: dict[str, dict[int, int]] = {}
        for host_name, html, keys, of in it:
            if host_name not in known:
                if len(known) > 1000:
                    known.clear()
                known[host_name] = dict(zip(keys, of, strict=True))
            found = class_orders(html, known[host_name])
            yield {"host": [host_name] * len(found), "vector": list(found), "order": list(found.values())}

    once = F.filter("tokens", lambda t: t["n"] == t["pages"])
    classes = hosts.select("host", once["key"].alias("keys"), once["vector"].alias("of"))
    ordered = map_rows(rows.join(F.broadcast(classes) if few else classes, "host").select("host", "html", "keys", "of"), orders,
                       "host string, vector long, order long").groupBy("host", "vector", "order").agg(F.count("*").alias("n"))
    unordered = (ordered.groupBy("host", "vector").agg(F.max("n").alias("most"), F.sum("n").alias("all"))
                 .filter(F.col("most") < ORDERED * F.col("all")).groupBy("host").agg(F.collect_list("vector").alias("unordered")))

    def deduce(it: Iterator[tuple]) -> Iterator[dict]:
        for host_name, size, found, bad in it:
            template = deduce_template(found, size, set(bad or ()))
            yield {"host": [host_name], "keys": [list(template)], "main": [list(template.values())]}

    templates = map_rows(hosts.join(unordered, "host", "left").select("host", "size", "tokens", "unordered"), deduce,
                         "host string, keys array<long>, main array<boolean>")
    joined = rows.join(F.broadcast(templates) if few else templates, "host", "left")

    def extract(it: Iterator[tuple]) -> Iterator[dict]:
        known: dict[str, dict[int, bool]] = {}
        out: dict[str, list] = {"id": [], "url": [], "text": [], "n_chars": []}
        for page, url, host_name, html, keys, main in it:
            if host_name not in known:
                if len(known) > 1000:
                    known.clear()
                known[host_name] = dict(zip(keys or (), main or (), strict=True))
            text = main_text(html, known[host_name])
            for name, v in zip(out, (page, url, text, len(text)), strict=True):
                out[name].append(v)
            if len(out["id"]) >= 1000:
                yield out
                out = {n: [] for n in out}
        yield out

    found = map_rows(joined.select("id", "url", "host", "html", "keys", "main"), extract, f"id {kind}, url string, text string, n_chars long")
    return found.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
