"""Main-text extraction by wrapper induction.

All pages of a host are parsed to block trees, and those of one layout are aligned with one of them by
simple tree matching (Yang, 1991). Text blocks that stay the same at aligned places form the host's
template; the varying slots are content. Only a block that all pages of its layout hold can be constant,
so these are counted first, and pages are aligned where there are any. What an element, role or class
name declares to be no article (menus, adverts, forms and so on) is left out on every page, as its text
varies too.
"""

from __future__ import annotations

import html as entities
import re
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.llm.common import discard, stored

#: How many different pages of one layout tell constants from chance.
LEAST = 3
#: Trees that a task keeps to align further pages of their layouts with.
TREES = 64
#: Bytes of templates up to which they are broadcast; beyond, they join by a shuffle.
BROADCAST_BYTES = 32 << 20
#: Cells of one alignment table; longer lists of children are halved first, which keeps the result exact.
TABLE = 1 << 22

#: Names of elements, roles and class words.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
NEVER = frozenset("head nav footer aside form button menu dialog fieldset map audio video canvas noscript template object select svg".split())
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist".split())
NEVER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense banner banners sponsor sponsored sponsors promo promos promoted "
    "promotion sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs cookie cookies consent gdpr notice notices "
    "alert alerts popup modal overlay newsletter subscribe subscription signup share sharing social related recommended "
    "recommendations comment comments respond disqus replies reply footer masthead widget widgets toolbar pagination pager "
    "login search skip paywall disclaimer copyright".split()
)
HEADER_WORDS = frozenset("header topbar".split())
#: Words that say only where or in what shape a region stands.
NEUTRAL_WORDS = frozenset(
    "area article bar block body bottom box col column container cta entry form global google group holder info inner item law left links list "
    "main module outer page panel post posts primary reader region right row secondary section site slot thread top unit user users wrap wrapper zone".split()
)
_BREAKS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre section summary table ul li dt dd".split()
)
#: Elements that start a block; all others, unknown ones too, are part of the running text.
BLOCK = (_BREAKS_P | NEVER | frozenset("body caption center colgroup frameset html legend optgroup option tbody td tfoot th thead tr".split())) - frozenset("button svg".split())
_SCOPE = frozenset("article aside body button div footer header html li main nav section table td th tr ul ol dl dd dt form blockquote figure".split())
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_QUOTE_OR_END = re.compile("[\"'>]")
#: A name and its value, if any: matched in order, so nothing inside a value is taken for a name.
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_READ = frozenset("class id role hidden aria-hidden style".split())
_DIGITS = re.compile("[0-9]+")
_WORDS = re.compile(r"[a-z]+")
_SIZE = re.compile("[0-9]+x[0-9]+")


class Node:
    """A block element (or the text between blocks, with tag #text). ``p``: the open paragraph that holds it."""

    __slots__ = ("children", "label", "p", "parent", "skip", "tag", "text")

    def __init__(self, tag: str, label: str, parent: Node | None, skip: bool = False):
        self.tag, self.label, self.parent, self.skip = tag, label, parent, skip
        self.children: list[Node] = []
        self.text: list[str] = []
        self.p = self if tag == "p" else None if parent is None or tag in _SCOPE else parent.p


def _attributes(raw: str) -> dict[str, str]:
    """The attributes that are read, by name, in small letters; of a repeated one the first counts."""
    found: dict[str, str] = {}
    for m in _ATTR.finditer(raw) if raw and not raw.isspace() else ():
        if (name := m[1].lower()) in _READ:
            found.setdefault(name, (m[2] or m[3] or m[4] or "").lower())
    return found


def _declares(names: str, words: frozenset[str]) -> bool:
    """Whether a class or id is one of the words, besides words of place or shape: cookie-notice, but not has-sidebar."""
    for name in names.split():
        # sizes like 300x250 are no words
        parts = _WORDS.findall(_SIZE.sub("", name))
        if any(w in words for w in parts) and all(w in words or w in NEUTRAL_WORDS for w in parts):
            return True
    return False


def _never(tag: str, attrs: dict[str, str], inside: bool) -> bool:
    """True for regions that hold no main text; ``inside``: within an article or main element."""
    if tag in NEVER or (tag == "header" and not inside):
        return True
    if not attrs:
        return False
    if attrs.get("role") in NEVER_ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", ""):
        return True
    if tag in ("html", "body", "main", "h1"):
        return False
    # an id is often a mere anchor on paragraphs and headings
    names = attrs.get("class", "") + ("" if tag in ("p", "h2", "h3", "h4", "h5", "h6", "li") else " " + attrs.get("id", ""))
    return _declares(names, NEVER_WORDS) or (not inside and _declares(names, HEADER_WORDS))


def _tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes) with kind text, start or end, in one pass over the page.

    Comments, declarations and the contents of script-like elements are left out. A quote that is never
    closed turns off quotes for the rest of the page.
    """
    at, n, quotes = 0, len(page), True
    while at < n:
        low = page.find("<", at)
        if low < 0:
            yield "text", page[at:], ""
            return
        if low > at:
            yield "text", page[at:low], ""
        if page.startswith("<!--", low):
            end = page.find("-->", low + 4)
            at = n if end < 0 else end + 3
            continue
        closing = page.startswith("</", low)
        name = _NAME.match(page, low + 1 + closing)
        if name is None:
            if page.startswith(("<!", "<?", "</"), low):
                end = page.find(">", low)
                at = n if end < 0 else end + 1
            else:
                yield "text", "<", ""
                at = low + 1
            continue
        end = name.end()
        while quotes:
            mark = _QUOTE_OR_END.search(page, end)
            if mark is None:
                quotes = False
            elif mark[0] == ">":
                end = mark.start()
                break
            else:
                shut = page.find(mark[0], mark.end())
                quotes = shut >= 0
                end = shut + 1
        if not quotes:
            end = page.find(">", name.end())
            if end < 0:
                return
        tag = name[0].lower()
        at = end + 1
        yield "end" if closing else "start", tag, page[name.end() : end]
        if tag in RAW and not closing:
            shut = re.compile(f"</{tag}", re.I).search(page, at)
            at = n if shut is None else shut.start()


def parse(page: str) -> Node:
    """The page's block tree; unclosed and stray tags are tolerated, whatever their depth."""
    root = Node("#root", "#root", None)
    node, inside = root, 0
    open_tags: dict[str, int] = {}
    inline_skip: list[str] = []
    leaf: Node | None = None
    raw = None
    forms: list[Node] = []

    def close_to(up: Node) -> None:
        nonlocal node, inside
        while node is not up:
            inside -= node.tag in ("article", "main")
            open_tags[node.tag] -= 1
            node = node.parent

    for kind, tag, attrs_text in _tokens(page):
        if kind == "text":
            if inline_skip or raw:
                continue
            if leaf is None:
                if tag.isspace():
                    continue
                leaf = Node("#text", "#text", node, node.skip)
                node.children.append(leaf)
            leaf.text.append(tag)
            continue
        if tag in RAW:
            raw = None if kind == "end" else tag
            if tag != "script":
                leaf = leaf if inline_skip else None
            continue
        if tag not in BLOCK:
            if tag == "br":
                if leaf is not None and not inline_skip:
                    leaf.text.append(" ")
            elif kind == "end":
                if inline_skip and tag in inline_skip:
                    del inline_skip[inline_skip.index(tag) :]
            elif tag not in VOID and not attrs_text.endswith("/") and (inline_skip or _never(tag, _attributes(attrs_text), inside > 0)):
                # an advert or notice in running text, up to its end tag or the end of the block
                inline_skip.append(tag)
            continue
        leaf = None
        inline_skip.clear()
        if kind == "end":
            if open_tags.get(tag, 0):
                up = node
                while up.tag != tag and not (tag == "p" and up.tag in _SCOPE):
                    up = up.parent
                if up.tag == tag:
                    close_to(up.parent)
            continue
        if tag in _BREAKS_P and node.p is not None:
            close_to(node.p.parent)
        if tag in ("li", "td", "th", "tr", "dt", "dd", "option"):
            closes = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th")}.get(tag, (tag,))
            up = node
            while up.tag in closes or up.tag in ("p", "h1", "h2", "h3"):
                up = up.parent
                if up.tag not in closes:
                    close_to(up)
                    break
        attrs = _attributes(attrs_text)
        # a form may wrap the whole page, so it is judged by what it holds
        never = tag != "form" and _never(tag, attrs, inside > 0)
        # a number in a class (post-17) is the page's own
        new = Node(tag, f"{tag}.{_DIGITS.sub('', attrs.get('class', ''))}", node, node.skip or never)
        node.children.append(new)
        if tag == "form":
            forms.append(new)
        if tag not in VOID and (not attrs_text.endswith("/") or tag in ("div", "p", "article", "section", "main")):
            node = new
            open_tags[tag] = open_tags.get(tag, 0) + 1
            inside += tag in ("article", "main")
    for form in forms:
        if not form.skip and not _find([form], ("main", "article", "h1")):
            stack = [form]
            while stack:
                x = stack.pop()
                x.skip = True
                stack.extend(x.children)
    return root


def _text(leaf: Node) -> str:
    return " ".join(entities.unescape("".join(leaf.text)).split())


def _step(path: int, label: str) -> int:
    return xxhash.xxh64_intdigest(label, path)


def _leaves(nodes: list[Node], paths: list[int]) -> Iterator[tuple[int, str]]:
    """(path, text) of the text blocks below the nodes that are not in a skipped region, in page order."""
    stack = list(zip(reversed(nodes), reversed(paths)))
    while stack:
        x, path = stack.pop()
        if x.skip:
            continue
        if x.tag == "#text":
            if text := _text(x):
                yield path, text
            continue
        here = _step(path, x.label)
        stack.extend((c, here) for c in reversed(x.children))


def _path(node: Node) -> int:
    """A hash of the labels above a node."""
    labels = []
    while (node := node.parent) is not None:
        labels.append(node.label)
    path = 0
    for label in reversed(labels):
        path = _step(path, label)
    return path


def _find(nodes: list[Node], tags: tuple[str, ...]) -> list[Node]:
    """Outermost kept elements with one of the tags, in page order."""
    out, stack = [], list(reversed(nodes))
    while stack:
        x = stack.pop()
        if x.skip:
            continue
        if x.tag in tags:
            out.append(x)
        else:
            stack.extend(reversed(x.children))
    return out


def _has_text(node: Node) -> bool:
    return next(_leaves([node], [0]), None) is not None


def main_nodes(root: Node) -> list[Node]:
    """The elements that hold the main text: the articles (of the main element, if any), else the main one, else the page.

    A first-level heading in front of them belongs to them if they have none of their own.
    """
    found = [x for x in _find([root], ("main",)) if _has_text(x)] or [root]
    found = [x for x in _find(found, ("article",)) if _has_text(x)] or found
    if found != [root] and not _find(found, ("h1",)):
        before = []
        for x in _find([root], ("h1", found[0].tag)):
            if x.tag != "h1":
                break
            before.append(x)
        found = before + found
    return found


def _shapes(trees: list[Node]) -> dict[int, tuple[int, int]]:
    """By id of a node: the number of its tree's labels, and a hash of labels and texts."""
    numbers: dict[tuple, int] = {}
    out: dict[int, tuple[int, int]] = {}
    for tree in trees:
        order, stack = [], [tree]
        while stack:
            x = stack.pop()
            order.append(x)
            stack.extend(c for c in x.children if not c.skip)
        for x in reversed(order):
            own = [out[id(c)] for c in x.children if not c.skip]
            shape = numbers.setdefault((x.label, *(o[0] for o in own)), len(numbers))
            whole = xxhash.xxh64_intdigest(x.label + "\0" + (_text(x) if x.tag == "#text" else ""))
            for o in own:
                whole = xxhash.xxh64_intdigest(o[1].to_bytes(8, "big"), whole)
            out[id(x)] = shape, whole
    return out


def align(score, n: int, m: int) -> list[tuple[int, int]]:
    """Pairs (i, j) of the best order-keeping alignment of n rows and m columns.

    ``score(i)`` gives the scores of row i with all columns, 0 for pairs that cannot meet. Beyond TABLE
    cells the rows are halved where a best alignment crosses (Hirschberg, 1975): memory stays bounded.
    """
    out: list[tuple[int, int]] = []
    stack = [(0, n, 0, m)]
    while stack:
        top, bottom, left, right = stack.pop()
        rows, columns = bottom - top, right - left
        if not rows or not columns:
            continue

        def sweep(order, flip: bool, left=left, right=right, columns=columns, keep=None) -> np.ndarray:
            best = np.zeros(columns + 1, dtype=np.int64)
            for k, i in enumerate(order):
                own = score(i)[left:right]
                own = own[::-1] if flip else own
                step = np.where(own > 0, best[:-1] + own, 0)
                best[1:] = np.maximum.accumulate(np.maximum(best[1:], step))
                if keep is not None:
                    keep[k + 1] = best
            return best

        if rows * columns > TABLE and rows > 1:
            middle = (top + bottom) // 2
            ahead, behind = sweep(range(top, middle), False), sweep(range(bottom - 1, middle - 1, -1), True)
            at = left + int((ahead + behind[::-1]).argmax())
            stack += [(top, middle, left, at), (middle, bottom, at, right)]
            continue
        table = np.zeros((rows + 1, columns + 1), dtype=np.int64)
        sweep(range(top, bottom), False, keep=table)
        i, j = rows, columns
        while i and j:
            own = int(score(top + i - 1)[left + j - 1])
            if own > 0 and table[i, j] == table[i - 1, j - 1] + own:
                out.append((top + i - 1, left + j - 1))
                i, j = i - 1, j - 1
            elif table[i, j] == table[i - 1, j]:
                i -= 1
            else:
                j -= 1
    return sorted(out)


def match(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Simple tree matching: pairs of nodes of a largest common tree from the roots down, order kept.

    Among equally large ones trees that agree in all texts meet. How much two subtrees share depends
    only on their shapes, so it is computed once for each pair of shapes, children before parents.
    """
    if a.label != b.label:
        return []
    shapes = _shapes([a, b])
    kept = lambda x: [c for c in x.children if not c.skip]
    shared: dict[tuple[int, int], int] = {}

    def scores(xs: list[Node], ys: list[Node]):
        kinds = np.array([shapes[id(y)][0] for y in ys])
        wholes = np.array([shapes[id(y)][1] for y in ys], dtype=np.uint64)
        rows: dict[int, np.ndarray] = {}

        def row(i: int) -> np.ndarray:
            kind, whole = shapes[id(xs[i])]
            if kind not in rows:
                distinct = {k: shared.get((kind, k), 0) for k in set(kinds.tolist())}
                rows[kind] = np.array([2 * distinct[k] for k in kinds.tolist()], dtype=np.int64)
            own = rows[kind]
            return np.where((wholes == np.uint64(whole)) & (own > 0), own + 1, own)

        return row

    stack = [(a, b, False)]
    while stack:
        x, y, ready = stack.pop()
        key = shapes[id(x)][0], shapes[id(y)][0]
        if key in shared:
            continue
        xs, ys = kept(x), kept(y)
        if not ready:
            stack.append((x, y, True))
            first: dict[tuple[int, int], tuple[Node, Node]] = {}
            by_x = {shapes[id(c)][0]: c for c in reversed(xs)}
            by_y = {shapes[id(c)][0]: c for c in reversed(ys)}
            for i, c in by_x.items():
                for j, d in by_y.items():
                    if c.label == d.label:
                        first[i, j] = c, d
            stack.extend((c, d, False) for k, (c, d) in first.items() if k not in shared)
            continue
        row = scores(xs, ys)
        shared[key] = 1 + sum(int(row(i)[j]) // 2 for i, j in align(row, len(xs), len(ys)))
    out, todo = [], [(a, b)]
    while todo:
        x, y = todo.pop()
        out.append((x, y))
        xs, ys = kept(x), kept(y)
        todo += [(xs[i], ys[j]) for i, j in align(scores(xs, ys), len(xs), len(ys))]
    return out


def layout(found: list[Node]) -> int:
    """A hash of the way down to the main text; pages with the same one are of one layout."""
    key = 0
    for x in found:
        key = _step(_step(key, f"{_path(x):x}"), x.label)
    return key


def constants(first: Node, other: Node, wanted: frozenset[str] | None = None) -> list[tuple[int, str]]:
    """(place, path and text) of the blocks of ``first`` that ``other`` has at aligned places, of those ``wanted``."""
    met = {id(x): y for x, y in match(first, other) if x.tag == "#text"}
    out, stack, place = [], [first], 0
    while stack:
        x = stack.pop()
        if x.tag != "#text":
            stack.extend(c for c in reversed(x.children) if not c.skip)
            continue
        place += 1
        if id(x) in met and (text := _text(x)) and text == _text(met[id(x)]):
            block = f"{_path(x):x}\n{text}"
            if wanted is None or block in wanted:
                out.append((place, block))
    return out


def induce(pages: list[str]) -> list[str]:
    """The templates of a few different pages: path and text of the blocks that pages of one layout have at aligned places.

    ``templates`` does the same for tables. A layout of fewer than LEAST pages has no template.
    """
    layouts: dict[int, list[Node]] = {}
    for page in pages:
        tree = parse(page)
        layouts.setdefault(layout(main_nodes(tree)), []).append(tree)
    out: set[str] = set()
    for first, *others in layouts.values():
        if len(others) + 1 >= LEAST:
            out |= {block for _, block in set.intersection(*(set(constants(first, x)) for x in others))}
    return sorted(out)


def blocks(page: str) -> tuple[int, list[str]]:
    """The page's layout, and path and text of the blocks of its main text, in order."""
    found = main_nodes(parse(page))
    return layout(found), [f"{p:x}\n{t}" for p, t in _leaves(found, [_path(x) for x in found])]


def extract(page: str | None, template: frozenset[str] = frozenset()) -> str:
    """The main text: blocks of the main elements that are not part of the template."""
    if not page:
        return ""
    return "\n\n".join(x.partition("\n")[2] for x in blocks(page)[1] if x not in template)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


def _parsed(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, body, layout, blocks) of every row; body is a hash of the html, null as that is."""
    columns = [pages.schema["page_id"], *(T.StructField(c, T.StringType()) for c in ("url", "host")), T.StructField("body", T.LongType())]
    schema = T.StructType([*columns, T.StructField("layout", T.LongType()), T.StructField("blocks", T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [blocks(page.as_py()) if page.as_py() else (0, []) for page in batch.column(4)]
            layouts = pa.array(np.array([x for x, _ in found], dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], layouts, pa.array([x for _, x in found], pa.list_(pa.string()))], schema.names)

    body = F.when(F.col("html").isNotNull(), F.xxhash64("html"))
    return pages.select("page_id", F.col("url").cast("string"), host(F.col("url")).alias("host"), body.alias("body"), "html").mapInArrow(run, schema)


def _aside(df: DataFrame, column: str) -> DataFrame:
    """``df``, to be broadcast if its ``column``, a text or an array of texts, is no larger than BROADCAST_BYTES."""
    text = F.array_join(column, "") if isinstance(df.schema[column].dataType, T.ArrayType) else F.col(column)
    return F.broadcast(df) if (df.agg(F.sum(F.octet_length(text))).first()[0] or 0) <= BROADCAST_BYTES else df


def templates(pages: DataFrame, parsed: DataFrame) -> DataFrame:
    """(host, template) of each host that has one, from all of its pages; ``parsed`` is ``_parsed(pages)``.

    A block is constant if all different pages of its layout have it at the place that is aligned with its
    place in one of them, the one with the least hash; LEAST such pages are needed. First the blocks are
    counted that all pages of a layout hold, by hashes; only pages of layouts with such blocks are aligned,
    each in a row of its own, so that no task holds the pages of a host.
    """
    rows = parsed.where("host <> '' and body is not null").select(
        "host", "layout", "body", F.array_distinct(F.transform("blocks", lambda x: F.xxhash64(x))).alias("held"), "blocks"
    )
    # rows with the same contents count once
    kinds = rows.groupBy("host", "layout", "body").agg(F.count("*").alias("copies"))
    layouts = kinds.groupBy("host", "layout").agg(F.count("*").alias("n"), F.min("body").alias("first"), F.sum("copies").alias("n_rows")).where(F.col("n") >= LEAST)
    layouts = stored(layouts)
    counted = rows.select("host", "layout", F.explode("held").alias("block")).groupBy("host", "layout", "block").agg(F.count("*").alias("n_rows"))
    common = counted.join(layouts, ["host", "layout", "n_rows"]).groupBy("host", "layout", "first", "n").agg(F.collect_list("block").alias("common"))
    open_ = stored(common)
    if open_.isEmpty():
        discard(layouts)
        return open_.select("host", F.array().cast("array<string>").alias("template"))
    own = pages.select(host(F.col("url")).alias("host"), F.xxhash64("html").alias("body"), "html").where("html is not null")
    named = open_.select("host", "layout", F.col("first").alias("body"), "n")
    texts = own.join(named, ["host", "body"]).groupBy("host", "layout", "n").agg(F.min("html").alias("html_first"))
    chosen = rows.join(open_.select("host", "layout", F.col("first").alias("body"), "common"), ["host", "layout", "body"])
    wanted = chosen.groupBy("host", "layout").agg(F.first(F.filter("blocks", lambda x: F.array_contains("common", F.xxhash64(x)))).alias("wanted"))
    firsts = stored(texts.join(wanted, ["host", "layout"]))
    schema = "host string, layout long, body long, place int, block string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: OrderedDict[tuple[str, int], Node] = OrderedDict()
        for batch in batches:
            for row in zip(*batch.columns):
                name, key, body, page = (x.as_py() for x in row[:4])
                if (name, key) not in trees:
                    trees[name, key] = parse(row[4].as_py())
                    if len(trees) > TREES:
                        trees.popitem(last=False)
                trees.move_to_end((name, key))
                found = constants(trees[name, key], parse(page), frozenset(row[5].as_py()))
                if found:
                    n = len(found)
                    columns = [[name] * n, [key] * n, [body] * n, [x for x, _ in found], [x for _, x in found]]
                    kinds_ = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds_)], ["host", "layout", "body", "place", "block"])

    kept = kinds.join(open_.select("host", "layout"), ["host", "layout"]).select("host", "layout", "body")
    members = own.join(kept, ["host", "body"])
    met = members.join(_aside(firsts, "html_first"), ["host", "layout"]).select("host", "layout", "body", "html", "html_first", "wanted")
    votes = met.mapInArrow(run, schema).distinct()
    agreed = votes.groupBy("host", "layout", "place", "block").agg(F.count("*").alias("votes")).join(open_.select("host", "layout", "n"), ["host", "layout"])
    found = stored(agreed.where("votes = n").groupBy("host").agg(F.collect_set("block").alias("template")))
    discard(layouts, firsts)
    return found


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every row of ``pages`` (page_id, url, html); null html gives an empty text.

    Pages without a usable host get no template. Extra columns are ignored, repeated rows kept. Pages
    of any length and depth are parsed whole.
    """
    parsed = stored(_parsed(pages))
    known = _aside(templates(pages, parsed), "template")
    left = F.filter("blocks", lambda x: ~F.array_contains(F.coalesce("template", F.array().cast("array<string>")), x))
    text = F.array_join(F.transform(left, lambda x: F.substring_index(x, "\n", -1)), "\n\n")
    return parsed.join(known, "host", "left").select("page_id", "url", text.alias("text"))
