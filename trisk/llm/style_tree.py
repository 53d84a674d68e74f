"""Main-text extraction with a site style tree.

Pages of one host are merged into a style tree. Outside the main part a node is a place: its
parent's node, its tag with its classes, and its number among the siblings of that sign, once
counted from the first and once from the last, so that a menu before and a footer after text
of any length keep theirs. Inside an article or main element, where the number of blocks is the
author's, children of one sign are one node. A node counts, over the host's pages of different
text, which sequences of children it has (presentation) and which text stands below it
(content). Both give an entropy:

* presentation importance: -sum p_i log_m p_i over the child sequences, m pages;
* content importance: 1 - mean over pages of log_m(pages with the same text), so text that
  is the same on every page has 0 and text that differs on every page has 1;
* measured importance: (1 - g^l) * presentation + g^l * content, l child sequences, g = 0.9.

What is measured on m pages weighs m - 1 against a prior: 1 with weight 2 in the main part, 0.5
with weight 1 elsewhere. A node whose mean of both is under ``MIN_IMPORTANCE`` is cut, with all
that is below it, from the pages whose text there stands on at least two pages and on
``MIN_SHARE`` of the node's: text of a page's own is never cut. So the same text in the same
place goes from three pages on, in the main part from ten on; two pages alone may be near copies
and tell nothing.

Elements that can hold no main
text by their kind (menus, headers, footers, sidebars, forms, scripts, adverts, notices,
reader comments) have importance 0 from the start; a class or id tells that by its whole name
or its last part (not ``no-sidebar`` or ``has-menu``), never for html, body and main, and for an
article by its whole name alone. If no article or main element is left on a page, such names
do not count for what encloses one (whole names only do not for main). Where a page has an article or main
element, the main text is inside it.

Character references are decoded, white space inside a block becomes one space, blocks are
joined in page order by one space.

Defined cases: null or empty html gives empty text; broken markup is read the way browsers
do (unclosed elements end with their parent, stray end tags are ignored, an unclosed comment
or script runs to the end); a null url is a host of its own; pages of the same text count once
as evidence, but each row gets its text; repeated ids and rows stay; an empty table gives none.

Scale: features are one row per page and node and are counted by their value with partial
aggregation, so a host with a third of all pages is spread; texts and sequences of one page
alone are one row a node when they are written. The cuts of a host (at most 1 / ``MIN_SHARE``
texts a node) are joined to its pages, by broadcast only where Spark sees that the table is small.
"""

from __future__ import annotations

import html as html_lib
import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trisk.llm.store import columns, id_field, materialize, text_batches

MIN_IMPORTANCE = 0.2
MIN_SHARE = 0.05
DECAY = 0.9
#: (importance, weight in pages) of a node before any evidence, in the main part and elsewhere.
PRIOR_MAIN, PRIOR = (1.0, 2.0), (0.5, 1.0)

# Fixed values of HTML: elements without content, elements that end a paragraph, and which
# open elements a start tag closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary
table tbody td tfoot th thead title tr ul""".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th")}
SCOPE = frozenset("html body table td th ul ol dl article section div main aside nav form".split())
RAW = frozenset("script style textarea title noscript iframe template svg".split())
NOISE_TAGS = frozenset("""head nav footer aside form script style noscript template iframe svg button select textarea
object menu dialog input label canvas audio video map title""".split())
NOISE_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo sidebar
menu nav navbar navigation breadcrumb breadcrumbs footer header masthead cookie cookies notice consent gdpr popup modal
newsletter subscribe share sharing social related comment comments commentlist disqus reply replies login search
pagination pager widget toolbar skip""".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
MAIN_TAGS = frozenset(("article", "main"))
PAGE_TAGS = frozenset(("html", "body", "main"))
#: First parts of names that tell what a page has, not what an element is.
STATES = frozenset("no not has have with without is".split())
#: Why an element is noise: by the last part of a name, by a whole name, by its tag or attributes.
BY_PART, BY_NAME, BY_KIND = 1, 2, 3

_TOKEN = re.compile(r"""<!--(?s:.*?)(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>""")
_ATTR = re.compile(r"""(class|id|role|hidden|style|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""", re.I)
_NAME = re.compile(r"[a-z0-9]+")
HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]+)"


def host_of(url: Column) -> Column:
    """Hash of an address's lower-cased host; of the empty text if there is none."""
    return F.xxhash64(F.lower(F.regexp_extract(F.trim(F.coalesce(url, F.lit(""))), HOST, 1)))


def _named(value: str) -> int:
    """Whether class or id names tell noise: 0, ``BY_PART`` or ``BY_NAME``."""
    kind = 0
    for parts in map(_NAME.findall, value.split()):
        if parts and parts[-1] in NOISE_WORDS and parts[0] not in STATES:
            kind = max(kind, BY_NAME if len(parts) == 1 else BY_PART)
    return kind


def _sign(tag: str, attrs: str) -> tuple[str, int]:
    """(tag with its classes, why the element is noise; 0 if it is not)."""
    if not attrs or attrs.isspace():
        return tag, BY_KIND if tag in NOISE_TAGS else 0
    kind, named, classes = BY_KIND if tag in NOISE_TAGS else 0, 0, ""
    for name, value in _ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            named = max(named, _named(value))
            if name == "class":
                classes = "." + ".".join(sorted(value.split()))
        elif name == "role":
            kind = BY_KIND if value in NOISE_ROLES else kind
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            kind = BY_KIND
        elif name == "style":
            kind = BY_KIND if "display:none" in value.replace(" ", "") else kind
    if tag in PAGE_TAGS or (tag == "article" and named == BY_PART):
        named = 0
    return tag + classes, max(kind, named)


class Page:
    """One page as nodes in page order: sign, parent, noise, main; and text by node."""

    def __init__(self, source: str):
        self.signs: list[str] = [""]
        self.parents: list[int] = [-1]
        self.kinds: list[int] = [0]  # why an element itself is noise
        self.noise: list[bool] = [False]
        self.main: list[bool] = [False]
        self.texts: list[tuple[int, str]] = []  # (node, text); a block's edge is a space
        self.tags: list[str] = [""]
        self._read(source)
        self._judge()
        if not any(m and not x for m, x in zip(self.main, self.noise)) and self._cleared():
            self._judge()

    def _judge(self) -> None:
        """Noise and main of every node from its own kind and its parent's."""
        self.noise, self.main = [False], [False]
        for tag, kind, up in zip(self.tags[1:], self.kinds[1:], self.parents[1:]):
            # A header inside the article is its heading; elsewhere it is the site's.
            self.main.append(self.main[up] or (tag in MAIN_TAGS and not kind and not self.noise[up]))
            self.noise.append(self.noise[up] or kind > 0 or (tag == "header" and not self.main[up]))

    def _cleared(self) -> bool:
        """Clear noise by names from what encloses a main or article element; whether there was any."""
        found = False
        for k, tag in enumerate(self.tags):
            if tag in MAIN_TAGS and not self.kinds[k]:
                above, up = [], self.parents[k]
                while up > 0:
                    above.append(up)
                    up = self.parents[up]
                if all(self.kinds[a] <= (BY_NAME if tag == "main" else BY_PART) and self.tags[a] != "header" for a in above):
                    found = True
                    for a in above:
                        self.kinds[a] = 0
        return found

    def _read(self, source: str) -> None:
        stack, at, n = [0], 0, len(source)
        for m in iter(lambda: _TOKEN.search(source, at), None):
            if m.start() > at:
                self.texts.append((stack[-1], source[at:m.start()]))
            at = m.end()
            tag = m[2] or m[5]
            if not tag:
                continue
            tag, closing = tag.lower(), m[1] or m[4]
            if tag in BLOCK:
                self.texts.append((stack[-1], " "))
            if closing:
                for k in range(len(stack) - 1, 0, -1):
                    if self.tags[stack[k]] == tag:
                        del stack[k:]
                        break
                continue
            closes = CLOSES.get(tag, ("p",) if tag in BLOCK and tag != "br" else ())
            if closes:
                for k in range(len(stack) - 1, 0, -1):
                    open_tag = self.tags[stack[k]]
                    if open_tag in closes:
                        del stack[k:]
                        break
                    if open_tag in SCOPE:
                        break
            attrs = m[3] if m[2] else m[6]
            signed, kind = _sign(tag, attrs or "")
            up = stack[-1]
            node = len(self.signs)
            self.signs.append(signed)
            self.parents.append(up)
            self.tags.append(tag)
            self.kinds.append(kind)
            if tag in VOID or (attrs or "").rstrip().endswith("/"):
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                if tag not in ("script", "style") and end is None:
                    stack.append(node)
                    continue
                at = end.end() if end else n
                continue
            stack.append(node)
        if at < n:
            self.texts.append((stack[-1], source[at:]))

    def _places(self, told: list[str]) -> tuple[list[int], list[int]]:
        """Style tree nodes of the elements with a text value: by the place from the first sibling, and the last."""
        size = len(self.signs)
        firsts, lasts, number = [0] * size, [0] * size, [0] * size
        seen: dict[tuple[int, str], int] = {}
        for k in range(1, size):
            if not (self.noise[k] or self.main[k]):
                key = self.parents[k], self.signs[k]
                number[k] = seen[key] = seen.get(key, 0) + 1
        for k in range(1, size):
            if told[k]:
                up, sign = self.parents[k], self.signs[k]
                if self.main[k]:
                    # The main part starts a tree of its own, wherever it stands.
                    firsts[k] = lasts[k] = node_hash(firsts[up] if self.main[up] else 0, sign, 0)
                else:
                    firsts[k] = node_hash(firsts[up], sign, number[k])
                    lasts[k] = node_hash(lasts[up], sign, number[k] - seen[up, sign] - 1)
        return firsts, lasts

    def _nodes(self) -> tuple[list[tuple[int, bool, int, int, list[int]]], int]:
        """(node, main, child sequence, text value, elements) of every style tree node with text below, and
        the value of the page's text without noise."""
        size, noise, parents, signs = len(self.signs), self.noise, self.parents, self.signs
        parts: dict[int, list[str]] = {}
        for k, t in self.texts:
            if t != " " and not noise[k]:
                words = t.split()
                if words:
                    parts.setdefault(k, []).append(" ".join(words))
        told = [""] * size
        below: dict[int, list[str]] = {}
        sequences: dict[int, list[str]] = {}
        for k in range(size - 1, 0, -1):
            if noise[k]:
                continue
            if k in parts or k in below:
                told[k] = f"{_hash(chr(10).join(parts.get(k, []) + below.get(k, [])[::-1]))}"
                below.setdefault(parents[k], []).append(told[k])
            sequence = sequences.setdefault(parents[k], [])
            if not sequence or sequence[-1] != signs[k]:
                sequence.append(signs[k])
        found: dict[int, tuple[bool, list[str], list[str], list[int]]] = {}
        firsts, lasts = self._places(told)
        for k in range(1, size):
            if told[k]:
                style = ">".join(sequences[k][::-1]) if k in sequences else ""
                for node in (firsts[k],) if firsts[k] == lasts[k] else (firsts[k], lasts[k]):
                    entry = found.get(node)
                    if entry is None:
                        entry = found[node] = (self.main[k], [], [], [])
                    entry[1].append(style)
                    entry[2].append(told[k])
                    entry[3].append(k)
        return [(node, main, _hash("|".join(dict.fromkeys(styles))), _hash(f"{node}:{' '.join(texts)}"), elements)
                for node, (main, styles, texts, elements) in found.items()], _hash(
                    chr(10).join(parts.get(0, []) + below.get(0, [])[::-1]))

    def text(self, cut: frozenset | set = frozenset()) -> str:
        """The main text without the nodes whose text value is in ``cut``."""
        in_main = any(m and not x for m, x in zip(self.main, self.noise))
        gone = self.noise
        if cut:
            gone = list(self.noise)
            for _, _, _, value, elements in self._nodes()[0]:
                if value in cut:
                    for k in elements:
                        gone[k] = True
            for k in range(1, len(gone)):
                gone[k] = gone[k] or gone[self.parents[k]]
        raw = "".join(t if t == " " or not (gone[k] or (in_main and not self.main[k])) else ""
                      for k, t in self.texts)
        return " ".join((html_lib.unescape(raw) if "&" in raw else raw).split())

    def features(self) -> list[tuple[int, int, int, int, int]]:
        """(page, node, main, kind, value) of every style tree node with text: kind 0 is the sequence of
        children without repeats in a row, kind 1 the text below, its value told apart by node. A page
        counts as its text without noise."""
        nodes, page = self._nodes()
        out = []
        for node, main, style, text, _ in nodes:
            out.append((page, node, int(main), 0, style))
            out.append((page, node, int(main), 1, text))
        return out


def _hash(text: str) -> int:
    """A signed 64-bit hash."""
    value = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


_NODES: dict[tuple[int, str, int], int] = {}


def node_hash(parent: int, sign: str, place: int) -> int:
    """Hash of a style tree node, remembered for the worker's recent ones."""
    key = (parent, sign, place)
    value = _NODES.get(key)
    if value is None:
        if len(_NODES) > 100_000:
            _NODES.clear()
        value = _NODES[key] = _hash(f"{parent}/{sign}[{place}]")
    return value


def page_features(pages: DataFrame) -> DataFrame:
    """(host, page, node, main, kind, value) hashes of (host, html) rows."""
    names = ["host", "page", "node", "main", "kind", "value"]

    def run(batches):
        for batch, sources in text_batches(batches, "html"):
            hosts = batch.column(batch.schema.get_field_index("host")).to_pylist()
            rows = [(h, *f) for h, s in zip(hosts, sources) if s for f in Page(s).features()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(6)], names=names)

    return pages.select("host", "html").mapInArrow(run, ", ".join(f"{c} long" for c in names))


def value_counts(features: DataFrame) -> DataFrame:
    """(host, node, main, kind, value, n, n_values): pages by value; the values of one page alone
    are one row with a null value."""
    counts = (features.distinct().groupBy("host", "node", "main", "kind", "value").agg(F.count(F.lit(1)).alias("n")))
    return (counts.groupBy("host", "node", "main", "kind", F.when(F.col("n") > 1, F.col("value")).alias("value"))
            .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_values")))


def node_importance(counts: DataFrame, decay: float = DECAY) -> DataFrame:
    """(host, node, main, n_pages, measured, importance) of every style tree node."""
    n, shared = F.col("n").cast("double"), F.col("value").isNotNull()
    nodes = counts.groupBy("host", "node", "main").agg(
        F.sum(F.when(F.col("kind") == 0, n)).alias("m"),
        F.sum(F.when(F.col("kind") == 0, F.col("n_values"))).alias("styles"),
        F.sum(F.when((F.col("kind") == 0) & shared, n * F.log(n)).otherwise(0.0)).alias("style_sum"),
        F.sum(F.when((F.col("kind") == 1) & shared, n * F.log(n)).otherwise(0.0)).alias("text_sum"))
    m, weight = F.col("m"), F.pow(F.lit(decay), F.col("styles"))
    # -sum p log_m p = 1 - (sum n log n) / (m log m)
    presentation = 1 - F.col("style_sum") / (m * F.log(m))
    content = 1 - F.col("text_sum") / (m * F.log(m))
    measured = F.when(m > 1, (1 - weight) * presentation + weight * content).otherwise(F.lit(1.0))

    def mean(prior):
        return (prior[0] * prior[1] + (m - 1) * F.col("measured")) / (prior[1] + m - 1)

    return (nodes.withColumn("measured", measured)
            .select("host", "node", "main", m.cast("bigint").alias("n_pages"), "measured",
                    F.when(F.col("main") == 1, mean(PRIOR_MAIN)).otherwise(mean(PRIOR)).alias("importance")))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            min_importance: float = MIN_IMPORTANCE, min_share: float = MIN_SHARE) -> DataFrame:
    """(page_id, url, text, n_chars, n_cut): the main text of every page."""
    rows = columns(pages, page_id=id_col, url=url_col, html=html_col).withColumn("host", host_of(F.col("url")))
    counts = materialize(value_counts(page_features(rows)), "style-tree")
    low = node_importance(counts).filter(F.col("importance") < min_importance).select("host", "node", "n_pages")
    cut = materialize(counts.filter((F.col("kind") == 1) & F.col("value").isNotNull())
                      .join(low, ["host", "node"]).filter(F.col("n") >= min_share * F.col("n_pages"))
                      .groupBy("host").agg(F.collect_set("value").alias("cut")), "style-cuts")
    schema = T.StructType([id_field(rows, "page_id"), T.StructField("url", T.StringType()),
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()),
                           T.StructField("n_cut", T.LongType())])
    def run(batches):
        for batch, sources in text_batches(batches, "html"):
            cuts = [frozenset(c or ()) for c in batch.column(batch.schema.get_field_index("cut")).to_pylist()]
            texts = [Page(s).text(c) if s else "" for s, c in zip(sources, cuts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64()), pa.array([len(c) for c in cuts], pa.int64())],
                names=schema.names)

    return (rows.join(cut, "host", "left").select("page_id", "url", "html", "cut").mapInArrow(run, schema))
