"""Main text of HTML pages through wrappers inferred per host.

A page is a tree of block elements with runs of text between them. Its union-free regular expression
has one part per child: runs of alike children fold into a repeated part, tandem runs into a
repeated group. Two expressions of a host are aligned; parts that only one side has become optional,
repeats spread, texts that differ become slots. Alignment is iterated over all pages of a host:
every task folds its own pages into one expression per host, and a tree of groupings folds those.
Expressions also add up how often a slot occurs and on how many pages, its characters and its linked
characters, and whether its text is always the same, so the finished wrapper decides slot by slot what belongs to
the article, for all pages of its host. A second pass over the pages reads the kept slots out.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher
from operator import add
from zlib import crc32

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, stored, table

#: Expressions of a host that one task of the tree folds, and hosts that a task holds at once.
FAN_IN = 64
HOSTS_HELD = 2_000
#: A text that is the same on so many pages is part of the template, on hosts whose pages don't name their article.
#: Where they do, nothing that is in it goes for being the same.
SAME = 3
#: Elements within each other that a tree holds, as in browsers, which have such a bound too.
DEEPEST = 200

# Names of HTML elements and common words of class names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
LEFT_OUT = frozenset(
    "head script style title noscript template textarea xmp iframe noembed noframes nav footer aside form button select "
    "option label fieldset legend menu dialog svg math object applet canvas audio video map datalist output progress meter".split()
)
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense sponsor sponsored promo promotion banner "
    "sidebar aside widget widgets menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar "
    "comment comments commentlist disqus reply replies respond discussion notice notices notification cookie cookies "
    "consent gdpr alert popup modal overlay newsletter subscribe subscription signup login search share sharing social "
    "related recommended recommendations pagination pager copyright disclaimer contentinfo complementary skip".split()
)
HEADER = frozenset(["header", "head"])
REGION = frozenset(["article", "main"])
HEADING = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
#: Opening the first closes an open one of the second, up to the nearest of the third.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"""|<([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|<([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# ---- pages as trees: a node is [tag, label, noise, children]; a text is [text, linked characters]
#: Noise: none, by an element's class names, by its tag or as it is hidden.
NONE, NAMED, SURE = 0, 1, 2


def _traits(tag: str, attributes: str) -> tuple[str, int]:
    """Label of an element for alignment, and whether it says that it is no main text."""
    if not attributes or ("=" not in attributes and "hidden" not in attributes.lower()):
        return tag, SURE if tag in LEFT_OUT else NONE
    named = {}
    for name, *values in _ATTRIBUTE.findall(attributes):
        named.setdefault(name.lower(), next(filter(None, values), ""))
    names = [w.lower() for key in ("class", "id", "role") for w in _WORDS.findall(html.unescape(named.get(key, "")))]
    hidden = "hidden" in named or named.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", named.get("style", ""), re.I)
    noise = SURE if tag in LEFT_OUT or hidden else NONE if NOISE.isdisjoint(names) or tag in ("html", "body") else NAMED
    if "header" in names or "head" in names:
        names.append("header")
    if named.get("role") == "main":
        names.append("main")
    return ".".join([tag, *sorted(set(names))]), noise


def parse(page: str) -> list:
    """The tree of a page. Any text makes one; what isn't closed ends with its parent or the page.

    Elements nested deeper than ``DEEPEST`` become siblings; their texts stay.
    """
    root = ["#root", "#root", NONE, []]
    stack, links, pos = [root], 0, 0
    run: list | None = None

    def add(text: str) -> None:
        nonlocal run
        if run is None:
            if not text.strip():
                return
            run = ["", 0]
            stack[-1][3].append(run)
        run[0] += text
        if links:
            run[1] += len(text)

    size = len(page)
    while pos < size:
        at = page.find("<", pos)
        if at < 0:
            at = size
        if at > pos:
            add(html.unescape(page[pos:at]))
            pos = at
            continue
        token = _TOKEN.match(page, pos)
        if token is None:
            add("<")
            pos += 1
            continue
        pos = token.end()
        closed = token[1]
        if closed:
            tag = closed.lower()
            if tag == "a":
                links = max(0, links - 1)
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    del stack[depth:]
                    run = None
                    break
                if tag in INLINE and stack[depth][0] not in INLINE:
                    break  # an inline element's end closes no block
            continue
        opened = token[2] or token[4]
        if not opened:
            continue
        tag, attributes = opened.lower(), token[3] or token[5] or ""
        if tag in VOID:
            if tag in ("br", "hr"):
                add(" ")
            continue
        label, noise = _traits(tag, attributes)
        if tag in INLINE and not noise:
            links += tag == "a"
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, pos)
            pos = end.end() if end else size
            run = None
            continue
        if tag not in INLINE:
            links = 0  # a link doesn't go beyond its block
            own, until = CLOSES.get(tag, (("p",), ("table", "article", "section", "div", "li", "td", "blockquote", "body")))
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in own:
                    del stack[depth:]
                    break
                if stack[depth][0] in until:
                    break
        node = [tag, label, noise, []]
        stack[-1][3].append(node)
        run = None
        if len(stack) < DEEPEST and (not attributes.rstrip().endswith("/") or tag in INLINE):
            stack.append(node)
    return root


# ---- expressions: {"l" label, "g" noise, "o" optional, "r" repeated, "n" times seen, "c" parts} or,
# for texts, {"l" "#", "o", "r", "n", "p" pages it is on, at least, "s" characters, "a" linked characters, "h" hash or None if they differ}


def _key(part: dict) -> object:
    return part["l"] if part["l"] != "()" else ("()", *map(_key, part["c"]))


def _fold(parts: list[dict]) -> list[dict]:
    """Runs of alike parts as one repeated part, tandem runs of 2 to 4 parts as one repeated group."""
    for period in (1, 2, 3, 4):
        keys, out, i = [_key(p) for p in parts], [], 0
        while i < len(parts):
            times = 1
            while keys[i : i + period] == keys[i + times * period : i + (times + 1) * period] and len(keys[i : i + period]) == period:
                times += 1
            if times == 1:
                out.append(parts[i])
                i += 1
                continue
            first = parts[i : i + period]
            for t in range(1, times):
                first = [_merge(a, b, max) for a, b in zip(first, parts[i + t * period : i + (t + 1) * period])]
            if period == 1:
                out.append(first[0] | {"r": 1})
            else:
                out.append({"l": "()", "g": NONE, "o": 0, "r": 1, "n": times, "c": first})
            i += times * period
        parts = out
    return parts


def expression(node: list) -> dict:
    """The union-free regular expression of a page's tree."""
    if len(node) == 2:
        return {"l": "#", "o": 0, "r": 0, "n": 1, "p": 1, "s": len(node[0]), "a": node[1], "h": crc32(node[0].strip().encode("utf-8", "replace"))}
    parts = _fold([expression(c) for c in node[3]])
    # class names such as "with-sidebar" on what holds the page's title are about its layout
    noise = NONE if node[2] == NAMED and any(map(_titled, parts)) else node[2]
    return {"l": node[1], "g": noise, "o": 0, "r": 0, "n": 1, "c": parts}


def _titled(part: dict) -> bool:
    if part["l"] == "#":
        return False
    return _tag(part) in ("h1", "main") or any(map(_titled, part["c"]))


def _merge(a: dict, b: dict, pages: Callable[[int, int], int] = add) -> dict:
    """One expression for both; they have the same key.

    ``pages`` counts the pages of both: their sum if no page is in both, and ``max`` where some may be.
    """
    out = {"l": a["l"], "o": a["o"] | b["o"], "r": a["r"] | b["r"], "n": a["n"] + b["n"]}
    if a["l"] == "#":
        return out | {"p": pages(a["p"], b["p"]), "s": a["s"] + b["s"], "a": a["a"] + b["a"], "h": a["h"] if a["h"] == b["h"] else None}
    noise = SURE if SURE in (a["g"], b["g"]) else min(a["g"], b["g"])
    return out | {"g": noise, "c": _align(a["c"], b["c"], pages)}


def _align(a: list[dict], b: list[dict], pages: Callable[[int, int], int]) -> list[dict]:
    """Parts that both sides have in the same order are merged, the others become optional."""
    left, right = [_key(p) for p in a], [_key(p) for p in b]
    if left == right:
        return [_merge(x, y, pages) for x, y in zip(a, b)]
    out = []
    for kind, i, j, k, m in SequenceMatcher(None, left, right, autojunk=False).get_opcodes():
        if kind == "equal":
            out += [_merge(x, y, pages) for x, y in zip(a[i:j], b[k:m])]
        else:
            out += [p | {"o": 1} for p in (*a[i:j], *b[k:m])]
    return _fold(out)


# ---- what a wrapper keeps


def _weigh(part: dict) -> tuple[int, int]:
    """Characters outside of links that vary, and all characters, of what isn't noise."""
    if part["l"] == "#":
        fixed = part["h"] is not None and part["p"] >= SAME
        return (0 if fixed else part["s"] - part["a"]), part["s"]
    if part.get("g"):
        return 0, 0
    each = [_weigh(p) for p in part["c"]]
    return sum(x for x, _ in each), sum(x for _, x in each)


def _tag(part: dict) -> str:
    return part["l"].split(".")[0]


def _is_region(part: dict) -> bool:
    return not part.get("g") and (_tag(part) in REGION or "main" in part["l"].split(".")[1:])


def _regions(part: dict) -> list[dict]:
    """Outermost parts that call themselves the article."""
    if part["l"] == "#" or part.get("g"):
        return []
    if _is_region(part):
        inner = [r for p in part["c"] for r in _regions(p)] if _tag(part) == "main" else []
        return inner or [part]
    return [r for p in part["c"] for r in _regions(p)]


def decide(wrapper: dict) -> dict:
    """The wrapper with "k" on every text: 1 if it belongs to the article."""
    regions = _regions(wrapper)
    named = bool(regions)
    if not named:
        region = wrapper
        while True:  # down to where the varying text is spread over several parts
            most = max((p for p in region["c"] if p["l"] != "#" and not p.get("g")), key=_weigh, default=None)
            if most is None or _tag(most) in ("p", *HEADING) or most["r"] or _weigh(most)[0] < 0.8 * max(1, _weigh(region)[0]):
                break
            region = most
        regions = [region]
    chosen = {id(r) for r in regions}

    def mark(part: dict, inside: bool, noise: bool, mostly_fixed: bool, tag: str) -> dict:
        if part["l"] == "#":
            fixed = not named and part["h"] is not None and part["p"] >= SAME and tag not in HEADING
            linked = not named and part["a"] * 2 > part["s"]
            return {"l": "#", "k": int(inside and not noise and not (fixed and not mostly_fixed) and not linked)}
        names = part["l"].split(".")
        noise = noise or bool(part["g"]) or (not HEADER.isdisjoint(names) and not inside)
        if id(part) in chosen:
            inside, noise = True, False
            vary, every = _weigh(part)
            mostly_fixed = vary * 2 < every
        kind = tag if part["l"] == "()" else names[0]
        return {"l": part["l"], "c": [mark(p, inside, noise, mostly_fixed, kind) for p in part["c"]]}

    return mark(wrapper, False, False, False, "")


def read(node: list, wrapper: dict, out: list[str]) -> None:
    """Add the texts of ``node`` that ``wrapper`` keeps to ``out``, in page order."""
    slots = _slots([c[1] if len(c) > 2 else "#" for c in node[3]], wrapper["c"])
    for child, slot in zip(node[3], slots):
        if slot is None:
            continue
        if len(child) == 2:
            if slot["k"]:
                out.append(child[0])
        else:
            read(child, slot, out)


def _slots(labels: list[str], parts: list[dict]) -> list[dict | None]:
    """The wrapper's part for each child, by the children's labels in order.

    The next place at or after the last one that has the label is taken; groups are entered and
    repeated at will, so whatever the wrapper was made from finds its place.
    """
    flat = []

    def flatten(some: list[dict]) -> None:
        for p in some:
            if p["l"] == "()":
                flatten(p["c"])
            else:
                flat.append(p)

    flatten(parts)
    places: dict[str, list[int]] = {}
    for i, p in enumerate(flat):
        places.setdefault(p["l"], []).append(i)
    out, now = [], 0
    for label in labels:
        own = places.get(label)
        if own is None:
            out.append(None)
            continue
        at = next((i for i in own if i >= now), own[-1])
        now = at
        out.append(flat[at])
    return out


# ---- Spark


def _wrap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``host, html`` -> ``host, wrapper``: this task's expression of each host."""
    held: dict[str, dict] = {}

    def out() -> pa.RecordBatch:
        return pa.record_batch([pa.array(list(held), pa.string()), pa.array([json.dumps(w) for w in held.values()], pa.string())], ["host", "wrapper"])

    for batch in batches:
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
            page = expression(parse(page.as_py() or ""))
            held[host] = _merge(held[host], page) if host in held else page
        if len(held) > HOSTS_HELD:
            yield out()
            held.clear()
    if held:
        yield out()


def _join_wrappers(rows: pd.DataFrame) -> pd.DataFrame:
    joined: dict | None = None
    for text in sorted(rows["wrapper"]):
        joined = json.loads(text) if joined is None else _merge(joined, json.loads(text))
    return pd.DataFrame({"host": rows["host"].iloc[:1], "wrapper": [json.dumps(joined)]})


def _decide_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        plans = [json.dumps(decide(json.loads(w))) for w in batch.column(1).to_pylist()]
        yield pa.record_batch([batch.column(0), pa.array(plans, pa.string())], ["host", "plan"])


def wrappers(pages: DataFrame) -> DataFrame:
    """``host, plan``: what to keep of the pages of each host in ``pages(host, html)``."""
    found = stored(pages.mapInArrow(_wrap, "host string, wrapper string"))
    while (found.groupBy("host").count().agg(F.max("count")).first()[0] or 0) > 1:
        counts = found.groupBy("host").agg(F.ceil(F.count("*") / FAN_IN).alias("groups"))
        dealt = found.join(counts, "host").withColumn("place", F.pmod(F.xxhash64("wrapper"), F.col("groups")))
        found = stored(dealt.groupBy("host", "place").applyInPandas(_join_wrappers, "host string, wrapper string"))
    return stored(found.mapInArrow(_decide_rows, "host string, plan string"))


def main_text(page: str | None, plan: dict) -> str:
    """A page's main text: kept slots in page order, white space as single spaces."""
    out: list[str] = []
    read(parse(page or ""), plan, out)
    return " ".join(" ".join(out).split())


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages(page_id, url, html)``.

    A null or empty page has an empty text. Pages without a host, null urls among them, share one
    wrapper. A host's only page is judged by its own structure. Repeated rows come out as often as
    they went in; an empty table gives an empty result. Whole pages are read, however long.
    """
    ship(pages.sparkSession)  # before any Python function is made
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[^/?#]*//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    rows = pages.select("page_id", "url", "html", host.alias("host"))
    plans = wrappers(rows.select("host", "html"))

    def read_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan_of: dict[str, dict] = {}
        for batch in batches:
            hosts, texts = batch.column("host").to_pylist(), []
            written = batch.column("plan")
            for i, host in enumerate(hosts):
                if host not in plan_of:
                    if len(plan_of) >= HOSTS_HELD:
                        plan_of.clear()
                    plan_of[host] = json.loads(written[i].as_py())
                texts.append(main_text(batch.column("html")[i].as_py(), plan_of[host]))
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])

    kind = dict(pages.dtypes)["page_id"]
    return rows.join(plans, "host").mapInArrow(read_out, f"page_id {kind}, url string, text string, n_chars long")


def op1_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


#: For pages whose article is an element of that name with headings, paragraphs and bold text in it.
OP1_SQL = r"""
WITH cut AS (
  SELECT page_id, url,
         regexp_replace(regexp_extract(html, '<article>(.*?)(</article>|$)', 1, 's'), '</?b>', '', 'g') AS a
  FROM pages
), plain AS (
  SELECT page_id, url, regexp_replace(regexp_replace(a, '<[^>]*>', ' ', 'g'), '&quot;?', '"', 'g') AS a FROM cut
), decoded AS (
  SELECT page_id, url, trim(regexp_replace(regexp_replace(a, '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS text FROM plain
)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM decoded
"""
