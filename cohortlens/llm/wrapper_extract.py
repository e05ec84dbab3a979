"""Main text of web pages by wrapper induction per host.

1. Every page becomes a tree of block elements and its shape (``page_tree``).
2. The shapes of a host's pages are aligned by simple tree matching and united
   into the host's wrapper, ``FAN`` at a time, level by level: no task meets
   all shapes of a host.
3. Every page's texts are laid on the wrapper's nodes.  A node whose text is
   the same on nearly all pages is template; so is, outside a marked article, a
   node whose texts come from a small pool (rotating adverts, menus).  Pages
   with the same unmarked text count once, so copies of one page do not make
   its text look constant, and a node that holds a good part of all the
   host's different texts is never template.
4. Each page is laid on its host's wrapper again: blocks in varying nodes are
   its content; elements that markup names as boilerplate (navigation, footer,
   advert, form, reader comments ..) never are.  Where elements are marked as
   the article, content lies in them.  A host's only page has a wrapper
   without evidence, so there the marks alone decide.

Counting is a Spark aggregate over (host, node, text) with partial sums; hosts
of any size are spread over it.

Defined results: null or empty html, or no text, gives '' and 0.  A null or
hostless url gives a page on its own.  Repeated page_ids are rows of their own.
Markup may be unclosed or cut off.  An element head, script, style, title,
form control, svg or embedded object gives no text; a header inside an article
gives its headings only; <br> counts as white space.  An empty table gives an
empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import page_tree as pt
from cohortlens.llm import storage, textkit

FAN = 32
SAME_SHARE, SAME_PAGES = 0.9, 5    # constant: on 9 of 10 different pages, 5 at least
POOL_SHARE, POOL_PAGES = 0.5, 6    # rotating: each text on two different pages on average
MAIN_SHARE = 0.1                   # of the characters of the host's different texts: such a node is never template
PIECE = 2 << 20
_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/@?#]*@)?([^/:?#]+)"


def host_of(url: str) -> F.Column:
    """Lower-case host of a URL, null where there is none."""
    return F.nullif(F.lower(F.regexp_extract(F.col(url), _HOST, 1)), F.lit(""))


def page(html: str | None) -> tuple[pt.Node, list]:
    """(tree with settled marks, its blocks)"""
    root = pt.parse(html)
    found = pt.blocks(root)
    pt.mark(root, found)
    pt.shape(root)
    pt.places(root)
    return root, found


def _hash(text: str) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _sane(root: pt.Node) -> set[int]:
    """Identities of nodes that are not boilerplate by their own or an outer mark."""
    out, todo = set(), [root]
    while todo:
        node = todo.pop()
        if not node.bad:
            out.add(id(node))
            todo += pt.children(node)
    return out


def page_facts(pages: DataFrame, host: str, html: str) -> DataFrame:
    """(host, shape, kind, texts, chars) of each page with a host: the hash of its unmarked text, and the hash (null:
    none) and length of the text of each node of its shape."""
    def run(batches):
        for batch in batches:
            for part in textkit.row_blocks(batch, "html", PIECE):
                rows = []
                for h, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    root, found = page(text)
                    own: dict[int, list] = {}
                    sane = _sane(root)
                    for node, t in found:
                        own.setdefault(node.index, []).append(t)
                    kind = _hash("\n".join(t for node, t in found if id(node) in sane))
                    texts = ["\n".join(own.get(i, ())) for i in range(len(pt.number(root.shape)))]
                    rows.append((h, json.dumps(root.shape, separators=(",", ":")), kind, [_hash(t) if t else None for t in texts],
                                 [len(t) for t in texts]))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())))],
                        names=["host", "shape", "kind", "texts", "chars"])

    rows = pages.where(F.col(host).isNotNull()).select(F.col(host).alias("host"), F.col(html).alias("html"))
    return rows.mapInArrow(run, "host string, shape string, kind long, texts array<long>, chars array<int>")


def _fold(shapes: list[str]) -> str:
    whole = None
    for s in sorted(shapes):
        one = json.loads(s)
        whole = one if whole is None else pt.merge(whole, one)
    return json.dumps(whole, separators=(",", ":"))


def wrappers(facts: DataFrame, folder: str) -> DataFrame:
    """(host, wrapper): the union of the host's shapes, ``FAN`` of them a step."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_fold(s) for s in batch.column(1).to_pylist()], pa.string())],
                                             names=["host", "shape"])

    now, level = storage.stage(facts.select("host", "shape").distinct(), folder, "wrappers_0"), 0
    while (now.groupBy("host").count().agg(F.max("count")).first()[0] or 0) > 1:
        size = now.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
        dealt = now.join(size, "host").withColumn("bucket", F.pmod(F.xxhash64("shape"), F.ceil(F.col("n") / FAN).cast("long")))
        level += 1
        now = storage.stage(dealt.groupBy("host", "bucket").agg(F.collect_list("shape").alias("shapes")).select("host", "shapes")
                            .mapInArrow(run, "host string, shape string").distinct(), folder, f"wrappers_{level}")
    return now.withColumnRenamed("shape", "wrapper")


def _laid(shapes: DataFrame) -> DataFrame:
    """(host, shape, nodes): for each shape's nodes in preorder their wrapper nodes, by simple tree matching."""
    def run(batches):
        for batch in batches:
            h, s, w = (batch.column(i).to_pylist() for i in range(3))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1),
                                              pa.array([pt.onto(json.loads(a), json.loads(b)) for a, b in zip(s, w)], pa.list_(pa.int32()))],
                                             names=["host", "shape", "nodes"])

    return shapes.select("host", "shape", "wrapper").mapInArrow(run, "host string, shape string, nodes array<int>")


def template_nodes(facts: DataFrame, known: DataFrame) -> DataFrame:
    """(host, same, pool): the wrapper nodes whose text is constant, and those whose texts rotate."""
    laid = _laid(facts.select("host", "shape").distinct().join(known, "host"))
    cells = (facts.join(laid, ["host", "shape"])
             .select("host", "kind", F.inline(F.arrays_zip(F.col("nodes").alias("node"), F.col("texts").alias("text"), F.col("chars").alias("chars"))))
             .where("text is not null and node >= 0"))
    seen = cells.groupBy("host", "node", "text", "kind").agg(F.max("chars").alias("chars"))
    texts = seen.groupBy("host", "node", "text").agg(F.count(F.lit(1)).alias("kinds"), F.max("chars").alias("chars"))
    nodes = texts.groupBy("host", "node").agg(F.sum("kinds").alias("kinds"), F.count(F.lit(1)).alias("texts"), F.max("kinds").alias("top"),
                                              F.sum("chars").alias("chars"))
    nodes = nodes.join(nodes.groupBy("host").agg(F.sum("chars").alias("all_chars")), "host")
    same = (F.col("top") >= SAME_PAGES) & (F.col("top") >= SAME_SHARE * F.col("kinds"))
    pool = (F.col("kinds") >= POOL_PAGES) & (F.col("texts") <= POOL_SHARE * F.col("kinds"))
    return (nodes.where((F.col("chars") < MAIN_SHARE * F.col("all_chars")) & (same | pool))
            .groupBy("host").agg(F.collect_list(F.when(same, F.col("node"))).alias("same"), F.collect_list("node").alias("pool")))


def content(root: pt.Node, found: list, nodes: list[int] | None, same: set[int], pool: set[int]) -> str:
    """The page's content blocks joined by line feeds."""
    def slot(node):
        return nodes[node.index] if nodes is not None and node.index >= 0 else -1

    kept: dict[int, tuple[bool, bool]] = {}  # node -> (content inside an article?, content anywhere?)
    todo = [(root, False, False)]  # (node, in the article, headings only)
    while todo:
        node, inside, heading = todo.pop()
        if node.bad and not (inside and node.label[1:].split(".")[0] == "header") and not (inside and _is_header(node)):
            continue
        heading = heading or (node.bad and inside)
        inside = inside or bool(node.rank)
        is_heading = node.tag in pt.HEADINGS
        s = slot(node)
        constant = s in same
        kept[id(node)] = (inside and (is_heading or not (constant or heading)), not heading and not constant and (is_heading or s not in pool))
        todo += [(k, inside, heading) for k in pt.children(node)]
    none = (False, False)
    article = [t for node, t in found if kept.get(id(node), none)[0]]
    return "\n".join(article or [t for node, t in found if kept.get(id(node), none)[1]])


def _is_header(node: pt.Node) -> bool:
    """A block named as a header, such as "entry-header"."""
    return "header" in {w.lower() for w in pt._WORD.findall(node.label)}


def extract(pages: DataFrame, folder: str, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row; wrappers and counts go below ``folder``."""
    pages = pages.select(F.col(id_col).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), host_of(url).alias("host"))
    facts = storage.stage(page_facts(pages, "host", "html"), folder, "facts")
    known = wrappers(facts, folder)
    known = storage.stage(known.join(template_nodes(facts, known), "host", "left"), folder, "known")

    def run(batches):
        wrapper_of: dict = {}
        laid: dict = {}
        for batch in batches:
            for part in textkit.row_blocks(batch, "html", PIECE):
                out = []
                for text, host, wrapper, same, pool in zip(*(part.column(i).to_pylist() for i in range(2, 7))):
                    root, found = page(text)
                    if wrapper is None:
                        out.append(content(root, found, None, set(), set()))
                        continue
                    if len(wrapper_of) > 256 or len(laid) > 4096:
                        wrapper_of, laid = {}, {}
                    if host not in wrapper_of:
                        wrapper_of[host] = json.loads(wrapper)
                    key = (host, json.dumps(root.shape, separators=(",", ":")))
                    if key not in laid:
                        laid[key] = pt.onto(root.shape, wrapper_of[host])
                    out.append(content(root, found, laid[key], set(same or ()), set(pool or ())))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.string()),
                                                  pa.array([len(t) for t in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    id_type = pages.schema["page_id"].dataType.simpleString()
    return (pages.join(known, "host", "left").select("page_id", "url", "html", "host", "wrapper", "same", "pool")
            .mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars long"))
