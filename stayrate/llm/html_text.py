"""HTML extraction: a tree-structured graphical model over the page's DOM.

Every element and every piece of text is a node that is content or not. A node has evidence of its
own (tag, class and id words, share of its text in links, number of words) and a potential with its
parent that depends on the kind of tag. Both are log-odds counted on labelled pages, with smoothing.
Sum-product message passing, leaves to root and back, gives each node's exact marginal; text whose
marginal reaches one half is content. Scripts, styles and other elements whose text is never shown
are dropped when the page is parsed.

Character references are decoded; white space inside a block (``<br>`` included) becomes one space;
blocks are trimmed, empty ones dropped, and the others joined in page order by a line feed. A NULL
page counts as empty and has an empty text.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from stayrate.llm.scratch import without

# HTML's elements without content, elements whose content is text or not shown, and
# elements that begin a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())
UNSEEN = frozenset("annotation annotation-xml audio button canvas head iframe map noscript object select svg template video".split())
FOREIGN = frozenset(("svg", "math"))
#: Start tags that leave an open head open; any other one, and text, ends it.
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
#: A start tag of the first kind ends an open element of the second, up to the nearest of the third.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)(?:>|\Z)",
    re.S,
)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")
TEXT = "#text"
#: Without a name these say nothing; pages nest them at will.
NEUTRAL = frozenset("div span section".split())
CONTAINERS = frozenset("aside div dl footer form header main menu nav ol section table ul".split())
SMOOTH = 0.5
DATA_LABEL = re.compile(r"\bdata-content\s*=\s*\"([01])\"")


@dataclass
class Page:
    """Nodes in page order, parents before children; texts lie in nodes of their own."""

    tags: list[str] = field(default_factory=list)
    names: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    blocks: list[int] = field(default_factory=list)
    labels: list[int | None] = field(default_factory=list)

    def add(self, tag: str, names: str, parent: int, text: str = "", block: int = 0, label: int | None = None) -> int:
        for column, value in zip((self.tags, self.names, self.parents, self.texts, self.blocks, self.labels), (tag, names, parent, text, block, label)):
            column.append(value)
        return len(self.tags) - 1


def parse(source: str) -> Page:
    page, at, block = Page(), 0, 0
    stack = [page.add("html", "", -1)]
    unseen = 0  # open elements whose text is not shown

    def text(part: str) -> None:
        if page.tags[stack[-1]] == "head" and part.strip(" \t\n\f\r"):
            close({"head"}, set())
        if part and not unseen:
            page.add(TEXT, "", stack[-1], html.unescape(part), block)

    def close(kinds: set[str], until: set[str]) -> None:
        nonlocal unseen
        for i in range(len(stack) - 1, 0, -1):
            tag = page.tags[stack[i]]
            if tag in kinds:
                unseen -= sum(page.tags[s] in UNSEEN for s in stack[i:])
                del stack[i:]
                return
            if tag in until:
                return

    while at < len(source):
        tag = TAG.search(source, at)
        if tag is None:
            text(source[at:])
            break
        text(source[at : tag.start()])
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        if name in BLOCKS:
            block += 1
        if tag[1]:
            if name == "p" or name not in BLOCKS:
                close({name}, {"article", "body", "div", "section", "td", "th", "li", "main", "aside", "nav", "footer", "header"})
            else:
                close({name}, set())
            continue
        # A head may lack its end tag.
        if name == "body" or (page.tags[stack[-1]] == "head" and name not in IN_HEAD):
            close({"head"}, set())
        if name in RAW:
            # Its text goes on to its end tag, whatever stands in it.
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(source, at)
            at = end.end() if end else len(source)
            continue
        if name in ("html", "body"):
            continue
        if name == "br":
            text("\n")
            continue
        # Only foreign elements close themselves; in HTML a slash is void, or the end of an unquoted value.
        if name in VOID or (tag[3].endswith("/") and any(page.tags[s] in FOREIGN for s in stack)):
            continue
        if name in BLOCKS:
            close({"p"}, {"article", "div", "section", "td", "th", "li", "main", "aside", "nav", "footer", "header", "button"})
        if name in ENDS:
            close(*ENDS[name])
        names = " ".join(x or y or z for x, y, z in NAMES.findall(tag[3])) if tag[3] else ""
        label = DATA_LABEL.search(tag[3]) if tag[3] else None
        stack.append(page.add(name, names, stack[-1], "", block, int(label[1]) if label else None))
        unseen += name in UNSEEN
    return page


def measures(page: Page) -> tuple[list[int], list[int]]:
    """(words, words in links) below each node."""
    words, linked = [0] * len(page.tags), [0] * len(page.tags)
    for i in range(len(page.tags) - 1, -1, -1):
        if page.tags[i] == TEXT:
            words[i] = len(page.texts[i].split())
        elif page.tags[i] == "a":
            linked[i] = words[i]
        if (up := page.parents[i]) >= 0:
            words[up] += words[i]
            linked[up] += linked[i]
    return words, linked


def name_words(tag: str, names: str, known: frozenset[str] | None) -> frozenset[str]:
    """Words of an element's names that tell something: those met on labelled pages. Names of a container
    may add to them (``nav-left``); a paragraph's name with an unknown word means something else."""
    found: set[str] = set()
    for name in names.split():
        words = {w.lower() for w in WORDS.findall(name)}
        if known is None or tag in CONTAINERS or words <= known:
            found |= words
    return frozenset(found if known is None else found & known)


def evidence(tag: str, named: frozenset[str], words: int, linked: int) -> tuple[str, ...]:
    """Features of a node."""
    if tag == TEXT:
        return ("text", f"words {min(5, words.bit_length())}")
    if tag in NEUTRAL and not named:
        return ()
    share = 0 if not words else 1 + (4 * linked) // words
    return (f"tag {tag}", f"links {share}", *[f"name {w}" for w in sorted(named)])


def kind_of(tag: str, named: frozenset[str]) -> str:
    """Which potential a node has with its parent: an element that is named may begin something else."""
    return TEXT if tag == TEXT else (tag if tag in BLOCKS else "inline") + ("." if named else "")


@dataclass
class Model:
    """Log-odds of content by feature, and of a child's label by kind and parent's label."""

    odds: dict[str, float]
    child: dict[str, tuple[float, float, float, float]]
    rest: tuple[float, float, float, float]
    known: dict = field(default_factory=dict)

    def named(self, tag: str, names: str) -> frozenset[str]:
        """An element's words that were met on labelled pages; without one it counts as unnamed."""
        if not names:
            return frozenset()
        if "" not in self.known:
            self.known[""] = frozenset(f[5:] for f in self.odds if f.startswith("name "))
        return name_words(tag, names, self.known[""])

    def own(self, tag: str, named: frozenset[str], words: int, linked: int) -> float:
        """How much likelier content is, from the node's own evidence."""
        key = (tag, named, min(words, 64), linked if words < 64 else (4 * linked) // words * 1000)
        if key not in self.known:
            if len(self.known) > 50_000:
                self.known.clear()
            total = sum(self.odds.get(f, 0.0) for f in evidence(tag, named, words, linked))
            self.known[key] = math.exp(max(-30.0, min(30.0, total)))
        return self.known[key]

    def marginals(self, page: Page) -> list[float]:
        """P(content) of every node; the root is content."""
        words, linked = measures(page)
        size = len(page.tags)
        # Belief of each node from below, as the pair (not content, content).
        low, high = [1.0] * size, [1.0] * size
        up: list[tuple[float, float]] = [(1.0, 1.0)] * size
        named = [self.named(t, n) for t, n in zip(page.tags, page.names)]
        pairs = [self.child.get(kind_of(t, n), self.rest) for t, n in zip(page.tags, named)]
        for i in range(size - 1, 0, -1):
            high[i] *= self.own(page.tags[i], named[i], words[i], linked[i])
            scale = low[i] + high[i]
            low[i] /= scale
            high[i] /= scale
            p00, p01, p10, p11 = pairs[i]
            a, b = p00 * low[i] + p01 * high[i], p10 * low[i] + p11 * high[i]
            up[i] = (a, b)
            parent = page.parents[i]
            low[parent] *= a
            high[parent] *= b
            if low[parent] + high[parent] < 1e-200:
                low[parent], high[parent] = low[parent] * 1e200, high[parent] * 1e200
        out = [1.0] * size
        for i in range(1, size):
            # The parent's marginal without what this node told it, then through the potential.
            parent = page.parents[i]
            a, b = (1 - out[parent]) / max(up[i][0], 1e-300), out[parent] / max(up[i][1], 1e-300)
            p00, p01, p10, p11 = pairs[i]
            x, y = (a * p00 + b * p10) * low[i], (a * p01 + b * p11) * high[i]
            out[i] = y / (x + y) if x + y > 0 else 0.5
        return out


def main_text(model: Model, source: str) -> str:
    page = parse(source)
    if len(page.tags) < 2:
        return ""
    chosen: dict[int, list[str]] = {}
    for tag, text, block, content in zip(page.tags, page.texts, page.blocks, model.marginals(page)):
        if tag == TEXT and content >= 0.5:
            chosen.setdefault(block, []).append(text)
    blocks = (" ".join("".join(parts).split()) for parts in chosen.values())
    return "\n".join(b for b in blocks if b)


def counted(source: str) -> Counter:
    """Feature and transition counts of a labelled page: elements with ``data-content`` pass their
    label on to what they hold, down to the next one that has it."""
    page, counts = parse(source), Counter()
    words, linked = measures(page)
    label = [1] * len(page.tags)
    for i in range(1, len(page.tags)):
        up = label[page.parents[i]]
        label[i] = up if page.labels[i] is None else page.labels[i]
        # Inside a container the label is the parent's; evidence is counted where it is decided.
        named = name_words(page.tags[i], page.names[i], None)
        counts[f"pair {kind_of(page.tags[i], named)} {up}{label[i]}"] += 1
        for feature in evidence(page.tags[i], named, words[i], linked[i]):
            counts[f"{feature} {label[i]}"] += 1
        counts[f"all {label[i]}"] += 1
    return counts


def train(labelled: DataFrame, column: str = "html") -> Model:
    """A model from pages whose elements are labelled by ``data-content="0"`` or ``"1"``. Pages are
    counted where they lie; the model, a number per feature, comes to the driver."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for source in batch.column(column).to_pylist():
                total += counted(source or "")
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["name", "n"])

    rows = labelled.select(column).mapInArrow(run, "name string, n long").groupBy("name").agg(F.sum("n").alias("n")).collect()
    counts = {r["name"]: r["n"] for r in rows}
    both = [counts.get(f"all {y}", 0) + 1.0 for y in (0, 1)]
    features = {n[:-2] for n in counts if not n.startswith(("pair ", "all "))}
    odds = {
        f: math.log((counts.get(f"{f} 1", 0) + SMOOTH) / both[1]) - math.log((counts.get(f"{f} 0", 0) + SMOOTH) / both[0])
        for f in features
    }

    def potential(kinds: Iterable[str]) -> tuple[float, float, float, float]:
        out: list[float] = []
        for up in "01":
            n = [sum(counts.get(f"pair {k} {up}{own}", 0) for k in kinds) + SMOOTH for own in "01"]
            out += [x / sum(n) for x in n]
        return tuple(out)

    kinds = {n.split()[1] for n in counts if n.startswith("pair ")}
    return Model(odds, {k: potential([k]) for k in kinds}, potential(kinds))


# Labelled example pages: containers of content and of everything else, and what they hold.
CONTENT = ["article", "main", "div.content", "div.post body", "section.entry content", "div.article text", "div.story", "div.main", "section", "div"]
OTHER = [
    "nav", "ul.menu", "div.menu", "div.nav", "header", "div.header", "div.top bar", "footer", "div.footer", "aside", "div.sidebar", "div.ad",
    "div.ads", "div.advert", "div.advertisement", "div.banner", "div.sponsored", "div.promo", "div.cookie notice", "div.cookie consent",
    "div.notice", "div.alert", "div.gdpr", "form", "form.search", "div.login", "section.comments", "div.comment", "div.comments", "ol.comment list",
    "div.reply", "div.discussion", "div.related", "div.share", "div.social", "div.newsletter", "div.subscribe", "div.breadcrumb", "div.pagination",
    "div.popup", "div.modal", "div.toolbar", "div.widget", "p.copyright", "div.legal", "div.disclaimer", "section.related", "aside.ad",
]
PROSE = "words of a sentence that goes on for a while and then comes to its end as sentences of an article do"
INSIDE = ["<h1>{s}</h1><p>{p}</p>", "<p>{p}</p><p><b>{s}</b> {p}</p>", "<h2>{s}</h2><p>{p} <a>{s}</a> {p}</p>", "<ul><li>{p}</li><li>{p}</li></ul>",
          "<blockquote><p>{p}</p></blockquote>", "<p>{p}<br>{p}</p>", "<table><tr><td>{s}</td><td>{p}</td></tr></table>", "<figure><figcaption>{s}</figcaption></figure>",
          "<pre>{p}</pre>", "<p><i>{s}</i> <em>{p}</em> <span>{p}</span></p>", "<div><p>{p}</p></div>", "<section><h3>{s}</h3><p>{p}</p></section>", "{p}"]
AROUND = ["<ul><li><a>{s}</a></li><li><a>{s}</a></li><li><a>{s}</a></li></ul>", "<p>{p}</p>", "{p}", "<a>{s}</a> <a>{s}</a>", "<h3>{s}</h3><p>{p}</p>",
          "<span>{s}</span>", "<div><p>{p}</p></div>", "<label>{s}</label>", "<p>{p} <a>{s}</a></p>", "{s}", "<h1>{s}</h1>", "<h2>{s}</h2><p>{p}</p>",
          "<div><p>{p}</p><span>{s}</span></div>", "<p>{p}</p><p>{p}</p>"]
WRAPPERS = ["div", "div.wrapper", "div.page", "div.container", "div.site", "div.row", "div.layout", "section"]


def example_pages() -> list[str]:
    """Pages with every container, each with several fillings; boilerplate also stands inside of
    articles."""

    def box(spec: str, label: int, inner: str) -> str:
        tag, _, names = spec.partition(".")
        names = f' class="{names}"' if names else ""
        return f'<{tag}{names} data-content="{label}">{inner.format(s="two words", p=PROSE)}</{tag}>'

    pages = []
    for i, other in enumerate(OTHER):
        for j in range(4):
            wrap = CONTENT[(i + 3 * j) % len(CONTENT)]
            inner = "".join(INSIDE[(i + j + k) % len(INSIDE)] for k in range(4))
            around = AROUND[(i + 2 * j) % len(AROUND)]
            nested = box(other, 0, around) if j == 1 else ""
            # Braces of what is already filled in are not met again: fillings hold none.
            page = box(OTHER[(i + 7 * j) % len(OTHER)], 0, AROUND[(i + j) % len(AROUND)]) + box(wrap, 1, inner + nested) + box(other, 0, around)
            pages.append(box(WRAPPERS[(i + j) % len(WRAPPERS)], 1, page) if j > 1 else page)
    # Without any container the blocks of a page are its content.
    pages += ["".join(INSIDE[(i + k) % len(INSIDE)].format(s="two words", p=PROSE) for k in range(3)) for i in range(10)]
    return pages


def labelled_examples(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(p,) for p in example_pages()], "html string")


def extracted(pages: DataFrame, model: Model, column: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars``; one pass, nothing is shuffled."""
    rows = without(pages, "text", "n_chars").withColumn("_html", F.col(column))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(model, h) if h else "" for h in batch.column("_html").to_pylist()]
            kept = [i for i, n in enumerate(batch.schema.names) if n != "_html"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in kept], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*[batch.schema.names[i] for i in kept], "text", "n_chars"],
            )

    fields = [f for f in rows.schema.fields if f.name != "_html"]
    return rows.mapInArrow(run, StructType([*fields, StructField("text", StringType()), StructField("n_chars", LongType())]))
