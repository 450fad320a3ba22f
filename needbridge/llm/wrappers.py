"""HTML main text by wrappers inferred from same-host pages.

A page's tokens (tags and text slots) are read into a skeleton; runs of equal
siblings become one repeated group.  Skeletons of a host are aligned one after
another: what both have is merged, what one lacks becomes optional, what
repeats becomes a repeated group, differing text a slot.  The result is a
union-free wrapper of the host.  Each of its paths carries how many pages
have it, how much of its text is links, and whether its text is the same on
all of them; from this the host's own paths are marked.  Extraction takes each
page's article, else its main, else its blocks that are not marked.

Distinct skeletons and path statistics are aggregated before any host's rows
meet; what varies in class and id values is taken out first, and a host's
skeletons are merged in rounds of bounded groups.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from needbridge.llm.common import materialize

#: Elements whose text is never shown as such, void elements, blocks, and boilerplate by name or mark.
_RAW = ("script", "style", "textarea", "iframe", "title")
_SILENT = frozenset("noscript template svg math object select button head".split())
_HEAD = frozenset("base link meta noscript template script style title basefont bgsound noframes".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
_BOILER = frozenset("nav aside form footer dialog menu fieldset".split())
_MARKS = frozenset("""ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie
cookies disqus footer header masthead menu modal nav navbar navigation newsletter notice notices notification outbrain pagination pager
popup promo promotion related share sharing sidebar signup skip social sponsor sponsored subscribe taboola toolbar widget contentinfo
complementary navigation search alert reply replies discussion respond""".split())
_HEADERS = frozenset(("header", "masthead", "banner"))
#: Elements that the next start tag of a kind closes.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>%s)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>" % "|".join(_RAW),
    re.S | re.I)
_MARK = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SILENT_TAG = re.compile(r"<(/?)(%s)\b(?!(?:[^>\"']|\"[^\"]*\"|'[^']*')*/>)" % "|".join(sorted(_SILENT - {"head"})), re.I)
#: A path whose text is the same on so many pages or more, outside an article, is the host's own.
SAME_ON = 3
#: Skeletons of a host that one call merges.
MERGE = 64


def _general(mark: str) -> str:
    """A class or id without what varies from page to page: digits, hexadecimal parts, long names."""
    return re.sub(r"[0-9a-f]*[0-9][0-9a-f]*", "0", re.sub(r"[/.]", "-", mark)) if len(mark) <= 40 else "~"


def _unclosed(html: str) -> set[int]:
    """Places of the silent elements' start tags that no end tag answers."""
    open_: dict[str, list[int]] = {}
    out: set[int] = set()
    for m in _SILENT_TAG.finditer(html):
        name = m[2].lower()
        if m[1]:
            if open_.get(name):
                open_[name].pop()
        else:
            if name in ("button", "select", "noscript"):  # these hold none of their kind
                out.update(open_.pop(name, ()))
            open_.setdefault(name, []).append(m.start())
    return out.union(*open_.values())


def blocks_of(html: str) -> Iterator[tuple[str, str, int]]:
    """(path, text, characters in links) of each text block in page order.

    A path names the open block elements with their class, id and role marks,
    e.g. ``/html/body/div.ad``, digits in marks as one 0.  Text in silent elements is left out: until their
    end tag or the end of the block around them, without an end tag until the
    next block tag, and in a head until the first tag or text that cannot be in one.
    """
    silent: list[tuple[str, int, bool]] = []  # open silent elements: name, blocks open around it, closed
    unclosed: set[int] | None = None
    stack: list[str] = []  # labels of open block elements
    held: list[str] = []
    linked = depth = last = 0

    def flush() -> Iterator[tuple[str, str, int]]:
        nonlocal linked
        text = " ".join(entities.unescape("".join(held)).split())
        if text:
            yield "/" + "/".join(stack), text, min(linked, len(text))
        held.clear()
        linked = 0

    def text_until(stop: int) -> None:
        nonlocal linked
        if stop > last and silent and silent[-1][0] == "head" and html[last:stop].strip():
            silent.pop()
        if stop > last and not silent:
            held.append(html[last:stop])
            linked += (stop - last) if depth else 0

    for m in _TOKEN.finditer(html):
        text_until(m.start())
        last = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if silent and silent[-1][0] == "head" and tag not in _HEAD:
            silent.pop()
        if tag in _SILENT:
            if m["end"]:
                names = [name for name, _, _ in silent]
                if tag in names:
                    del silent[len(names) - 1 - names[::-1].index(tag):]
            elif tag == "head":
                silent.append((tag, len(stack), True))
            elif not (tag in ("svg", "math") and m["attrs"].rstrip().endswith("/")):
                unclosed = _unclosed(html) if unclosed is None else unclosed
                silent.append((tag, len(stack), m.start() not in unclosed))
            continue
        if tag in _BLOCK:
            while silent and not silent[-1][2]:
                silent.pop()
        if tag == "a":
            depth = 0 if m["end"] else 1
        elif tag == "br":
            held.append(" " if not silent else "")
        elif tag in _BLOCK:
            if not silent or (m["end"] and any(x.partition(".")[0] == tag for x in stack[:silent[0][1]])
                              and not any(x.partition(".")[0] == tag for x in stack[silent[0][1]:])):
                yield from flush()
            if m["end"]:
                names = [label.partition(".")[0] for label in stack]
                if tag in names:
                    del stack[len(names) - 1 - names[::-1].index(tag):]
                    while silent and silent[-1][1] > len(stack):
                        silent.pop()
            elif tag not in _VOID:
                top = stack[-1].partition(".")[0] if stack else ""
                if len(stack) > (silent[-1][1] if silent else 0) and (top == "p" or top in _CLOSES.get(tag, ())):
                    stack.pop()
                if tag == "tr" and stack and stack[-1].partition(".")[0] == "tr":
                    stack.pop()
                marks = sorted({w.lower() for g in _MARK.findall(m["attrs"] or "") for w in "".join(g).split()})
                stack.append(".".join([tag, *dict.fromkeys(_general(w) for w in marks)]))
                depth = 0
    text_until(len(html))
    yield from flush()


# --- wrappers: nested [label, quantifier, children], quantifier one of "1 ? + *"

def skeleton(paths: list[str]) -> list:
    """Tree of the paths in page order, equal neighbours as one repeated group."""
    root: list = ["", "1", []]
    previous: list[str] = []
    for path in paths:
        labels = [x for x in path.split("/") if x]
        node, same = root, True
        for k, label in enumerate(labels):
            same = same and k < len(previous) and previous[k] == label
            children = node[2]
            if children and children[-1][0] == label:
                if k == len(labels) - 1 and same and len(previous) == len(labels):
                    children[-1][1] = "+"
            else:
                children.append([label, "1", []])
            node = children[-1]
        previous = labels
    return root


def _quantifier(a: str, b: str) -> str:
    return {(False, False): "1", (True, False): "?", (False, True): "+", (True, True): "*"}[
        a in "?*" or b in "?*", a in "+*" or b in "+*"]


def _optional(node: list) -> list:
    return [node[0], _quantifier(node[1], "?"), node[2]]


def align(a: list, b: list) -> list:
    """One wrapper for what both wrappers match: mismatches become optional, runs repeated groups."""
    x, y = a[2], b[2]
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + 1 if x[i][0] == y[j][0] else 0)
    out, i, j = [], 0, 0
    while i < len(x) or j < len(y):
        if i < len(x) and j < len(y) and x[i][0] == y[j][0] and best[i][j] == best[i + 1][j + 1] + 1:
            out.append(align(x[i], y[j]))
            i, j = i + 1, j + 1
        elif j == len(y) or (i < len(x) and best[i + 1][j] >= best[i][j + 1]):
            out.append(_optional(x[i]))
            i += 1
        else:
            out.append(_optional(y[j]))
            j += 1
    merged: list = []
    for node in out:  # neighbours of one label are a repeated group
        if merged and merged[-1][0] == node[0]:
            again = align(merged[-1], node)
            merged[-1] = [node[0], _quantifier(again[1], "+"), again[2]]
        else:
            merged.append(node)
    return [a[0], _quantifier(a[1], b[1]), merged]


def paths_of(wrapper: list, above: str = "") -> Iterator[str]:
    for child in wrapper[2]:
        path = f"{above}/{child[0]}"
        yield path
        yield from paths_of(child, path)


def _boiler(path: str, sizes: dict[str, int], holds: set[str], inner: bool = False) -> bool:
    """A label of the path names boilerplate.

    A mark that is a whole class or id decides; one that is a part of it only
    where the element holds no article or main and not most of the page's text.
    Inside an article headers are part of it.  With ``inner`` nothing above an
    article or main counts.
    """
    inside, above = False, ""
    for label in path.split("/")[1:]:
        above += f"/{label}"
        name, *marks = label.split(".")
        if name in ("article", "main"):
            inside = True
        if name in ("html", "body", "article", "main") or (inner and not inside):
            continue
        if name in _BOILER or (name == "header" and not inside):
            return True
        if inside and name in ("h1", "h2", "header"):
            continue
        words = _MARKS - _HEADERS if inside else _MARKS
        if words.intersection(marks):
            return True
        if any(words.intersection(re.split(r"[-_]+", m)) for m in marks) and not (
                above in holds or sizes[above] * 2 > sizes[""]):
            return True
    return False


def content_texts(found: list[tuple[str, str, int]], own: frozenset) -> list[str]:
    """Texts of a page's content blocks: its article, else its main, else what is not in ``own``, the host's paths.

    Articles below boilerplate are taken where they hold no less text than the rest.
    """
    size: dict[str, int] = {}
    for path, text, _ in found:
        size[path] = size.get(path, 0) + len(text)
    sizes, holds = {"": sum(size.values())}, set()
    for path in size:
        above = [""]
        for label in path.split("/")[1:]:
            above.append(f"{above[-1]}/{label}")
            sizes[above[-1]] = sizes.get(above[-1], 0) + size[path]
            if label.partition(".")[0] in ("article", "main"):
                holds.update(above[1:])
    open_ = {p for p in size if not _boiler(p, sizes, holds)}
    chosen = open_ - own
    inner = {p for p in size if re.search(r"/(article|main)(\.|/|$)", p) and not _boiler(p, sizes, holds, inner=True)}
    if not inner & open_ and sum(size[p] for p in inner) >= sum(size[p] for p in chosen):
        open_ = open_ | inner
    for name in ("main", "article"):
        inside = {p for p in open_ if re.search(rf"/{name}(\.|/|$)", p)}
        chosen = inside or chosen
    return [t for p, t, _ in found if p in chosen]


def _host() -> F.Column:
    return F.lower(F.coalesce(F.regexp_extract("url", r"^[a-zA-Z]+://([^/?#]*)", 1), F.lit("")))


def infer(pages: DataFrame) -> DataFrame:
    """(w_host, wrapper, marks): each host's wrapper and its own paths, both as JSON.

    A path is the host's own if its text is the same on all its pages, SAME_ON
    or more of different content, or mostly links.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            skeletons: dict[tuple[str, str], int] = {}
            paths: dict[tuple[str, str], list] = {}
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = list(blocks_of(page.as_py() or ""))
                key = (host, json.dumps(skeleton([p for p, _, _ in found])))
                skeletons[key] = skeletons.get(key, 0) + 1
                own: dict[str, list] = {}
                for path, text, linked in found:
                    s = own.setdefault(path, [0, 0, []])
                    s[0], s[1] = s[0] + len(text), s[1] + linked
                    s[2].append(text)
                content = xxhash.xxh64_intdigest(page.as_py() or "") >> 1
                for path, (size, linked, texts) in own.items():
                    h = xxhash.xxh64_intdigest("\n".join(texts)) >> 1
                    s = paths.setdefault((host, path), [0, 0, 0, h, h, set()])
                    s[0], s[1], s[2], s[3], s[4] = s[0] + 1, s[1] + size, s[2] + linked, min(s[3], h), max(s[4], h)
                    if len(s[5]) < SAME_ON:
                        s[5].add(content)
            rows = [(host, s, "", n, 0, 0, 0, 0, []) for (host, s), n in skeletons.items()]
            rows += [(host, "", path, *s[:5], sorted(s[5])) for (host, path), s in paths.items()]
            cols = list(zip(*rows)) or [[]] * 9
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string()) for c in cols[:3]] + [pa.array(c, pa.int64()) for c in cols[3:8]]
                + [pa.array(cols[8], pa.list_(pa.int64()))],
                names=["host", "skeleton", "path", "pages", "size", "linked", "lo", "hi", "contents"])

    seen = pages.select(_host().alias("host"), "html").mapInArrow(
        read, "host string, skeleton string, path string, pages long, size long, linked long, lo long, hi long, contents array<long>")
    seen = materialize(seen.groupBy("host", "skeleton", "path").agg(
        *[F.sum(c).alias(c) for c in ("pages", "size", "linked")], F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.size(F.array_distinct(F.flatten(F.collect_set("contents")))).alias("contents")), "seen")

    def partial(rows: pd.DataFrame) -> pd.DataFrame:
        trees = [json.loads(s) for s in sorted(rows["skeleton"])]
        out = trees[0]
        for tree in trees[1:]:
            out = align(out, tree)
        return pd.DataFrame({"host": [rows["host"].iloc[0]], "skeleton": [json.dumps(out)]})

    trees = seen.where("path = ''").select("host", "skeleton")
    while True:  # merge in rounds of bounded groups until each host has one
        sizes = trees.groupBy(F.col("host").alias("s_host")).agg(F.count("*").alias("n")).where("n > 1")
        if sizes.isEmpty():
            break
        part = F.pmod(F.xxhash64("skeleton"), F.ceil(F.coalesce("n", F.lit(1)) / MERGE))
        trees = materialize(trees.join(sizes, F.col("host") == F.col("s_host"), "left").select(
            "host", "skeleton", part.alias("part")).groupBy("host", "part").applyInPandas(
            partial, "host string, skeleton string"), "trees")
    own = seen.where("path <> ''").where(
        ((F.col("lo") == F.col("hi")) & (F.col("contents") >= SAME_ON)) | (F.col("linked") * 2 > F.col("size")))
    marks = own.groupBy(F.col("host").alias("m_host")).agg(F.to_json(F.sort_array(F.collect_list("path"))).alias("marks"))
    return trees.join(marks, F.col("host") == F.col("m_host"), "left").select(
        F.col("host").alias("w_host"), F.col("skeleton").alias("wrapper"), F.coalesce("marks", F.lit("[]")).alias("marks"))


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Null html is empty; pages without a host share a wrapper.  Repeated rows
    give a row each; empty table: no rows.
    """
    wrappers = materialize(infer(pages), "wrappers").select("w_host", "marks")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", _host().alias("host"))
    rows = rows.join(wrappers, F.col("host") == F.col("w_host"), "left").select("page_id", "url", "html", "marks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, frozenset] = {}
        for batch in batches:
            texts = []
            for page, marks in zip(batch.column(2), batch.column(3).to_pylist()):
                if marks not in known:
                    known[marks] = frozenset(json.loads(marks or "[]"))
                texts.append("\n".join(content_texts(list(blocks_of(page.as_py() or "")), known[marks])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
