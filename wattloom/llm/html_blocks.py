"""Main text of web pages from flat text blocks and a decision tree.

A page is cut into blocks of text at every tag that is not inline. A block is described
by its words and link density, those of the blocks before and after it, and where it
stands (article, marked boilerplate, heading, list). A mark by tag or role holds for all
inside the element, one by a class or id name up to an article or main element inside it.
Blocks of a few dozen small pages, labelled one by one, train a decision tree, which
keeps or drops each block of every page. Where a page has an article element the tree
goes by it; elsewhere, also inside a wrapper that is only named like an article, it goes
by words and link density of a block and its neighbours.

Rows: a null or empty page has empty text; so has a page without a kept block. Broken
markup is read as far as it goes: an unfinished tag at the end is dropped, stray end
tags are ignored, an unclosed comment, script, style, template, textarea or title
reaches to the end. Buttons, options, drawings and embedded objects are hidden up to
their end tag or that of an element around them; one without an end tag of its own only
up to the next tag that is not inline. Time grows with the length of a page, however
deep its elements and however many end tags are stray. Repeated pages keep their rows.
Other columns are ignored.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from wattloom.llm import common

# Fixed values of the markup language.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr".split()
)
SPACING = frozenset(["br", "wbr"])
SKIPPED = frozenset("script style template textarea title".split())
HIDING = frozenset("noscript svg math iframe object select option button canvas audio video".split())
#: Tags that end a hiding element which has no end tag.
FLOW = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2"
    " h3 h4 h5 h6 header hr html li main menu nav ol p pre section table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE_TAGS = frozenset("nav footer aside header form dialog menu fieldset".split())
MAIN_TAGS = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
#: Words of class and id names that mark what is not the main text.
BOILERPLATE_NAMES = frozenset(
    "ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies"
    " disclaimer footer form gdpr header login menu modal nav navbar navigation newsletter notice notices overlay pager"
    " pagination popup privacy promo promoted related reply replies respond search share sharing sidebar signup skip"
    " social sponsor sponsored subscribe subscription tags toolbar topbar widget".split()
)
#: Those that mark single articles beside the main one, not a whole layout.
BESIDE_NAMES = frozenset("comment comments promo promoted related reply replies respond sponsored".split())
MAIN_NAMES = frozenset("article content entry main post story body".split())

_HIDING_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|template|textarea|title)(?=[\s/>]).*?(?:</\1\b|\Z)"
    r"|<(/?)(noscript|svg|math|iframe|object|select|button|canvas|audio|video)(?=[\s/>])([^>]*)",
    re.I | re.S,
)
_ATTRIBUTES = re.compile(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>")
_NAME = re.compile(r"/?([A-Za-z][^\s/>]*)")
_MARKED = re.compile(r"\b(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_PARTS = re.compile(r"[a-z]+|[0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

FEATURES = [
    "words",
    "link_density",
    "words_before",
    "density_before",
    "words_after",
    "density_after",
    "mark",
    "in_named",
    "heading",
    "list_item",
]
#: Values of ``mark``: inside the article; marked boilerplate, or outside the article of a
#: page that has one; neither.
IN_ARTICLE, BESIDE, UNMARKED = 1.0, -1.0, 0.0
#: Weight of a marked block when the tree is fitted, so that marks are asked first.
MARKED_WEIGHT = 10.0


@dataclass
class Block:
    text: str
    words: int
    linked: int
    article: bool
    named: bool
    boilerplate: bool
    heading: bool
    item: bool

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


def _standing(tag: str, attributes: str) -> tuple[bool, bool, bool, frozenset[str], bool]:
    """(article, named like one, boilerplate, names of boilerplate, hidden) that an opening
    tag brings about."""
    article, named, boilerplate, names, hidden = tag in MAIN_TAGS, False, tag in BOILERPLATE_TAGS, frozenset(), False
    if attributes:
        for name, *values in _MARKED.findall(attributes):
            name, value = name.lower(), "".join(values)
            if name == "role":
                boilerplate |= value.lower() in BOILERPLATE_ROLES
                article |= value.lower() in ("main", "article")
            elif name in ("class", "id"):
                parts = set(_PARTS.findall(_CAMEL.sub(" ", value).lower()))
                names |= BOILERPLATE_NAMES & parts if tag != "body" else names
                named |= not parts.isdisjoint(MAIN_NAMES) and tag != "body"
            elif name == "style":
                plain = value.replace(" ", "").lower()
                hidden |= "display:none" in plain or "visibility:hidden" in plain
            elif name == "hidden":
                hidden = True
            elif name == "aria-hidden":
                hidden |= value.lower() == "true"
    return article, named, boilerplate, names, hidden


def _ended(page: str) -> set[int]:
    """Where those hiding elements begin that have an end tag; option needs none."""
    ended: set[int] = set()
    begun: dict[str, list[int]] = {}
    for found in _HIDING_TAG.finditer(page):
        tag = (found[3] or "").lower()
        if not tag:
            continue
        if found[2]:
            if begun.get(tag):
                ended.add(begun[tag].pop())
        elif not found[4].endswith("/"):
            begun.setdefault(tag, []).append(found.start())
    return ended


def blocks_of(page: str | None) -> list[Block]:
    """The text blocks of a page in order, empty ones left out."""
    page = page or ""
    blocks: list[Block] = []
    parts: list[tuple[str, bool]] = []
    # Open elements: (tag, article, named like one, boilerplate by tag or role, names of
    # boilerplate, hidden, depth of the hiding element without an end tag), each with what
    # holds inside it; and how many are open of each tag.
    opened: list[tuple[str, bool, bool, bool, frozenset[str], bool, int]] = [("", False, False, False, frozenset(), False, 0)]
    still_open: Counter[str] = Counter()
    ended: set[int] | None = None
    links = 0
    heading = item = False

    def leave(depth: int) -> None:
        still_open.subtract(o[0] for o in opened[depth:])
        del opened[depth:]

    def flush() -> None:
        if not parts:
            return
        text = " ".join("".join(p for p, _ in parts).split())
        if text:
            linked = sum(len(p.split()) for p, inside in parts if inside)
            words = len(text.split(" "))
            _, article, named, boilerplate, names, *_ = opened[-1]
            blocks.append(Block(text, words, min(linked, words), article, named, boilerplate or bool(names), heading, item))
        parts.clear()

    at, last = 0, page.rfind(">")
    while at < len(page):
        begin = page.find("<", at)
        text = page[at:begin] if begin >= 0 else page[at:]
        if text and not opened[-1][5]:
            parts.append((references.unescape(text) if "&" in text else text, links > 0))
        if begin < 0:
            break
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = len(page) if end < 0 else end + 3
            continue
        name = _NAME.match(page, begin + 1)
        if name is None:
            if page[begin + 1 : begin + 2] in ("!", "?"):
                end = page.find(">", begin)
                at = len(page) if end < 0 else end + 1
            else:
                if not opened[-1][5]:
                    parts.append(("<", links > 0))
                at = begin + 1
            continue
        end_tag = page[begin + 1] == "/"
        tag = name[1].lower()
        closing = _ATTRIBUTES.match(page, name.end()) if begin < last else None
        if closing is None:
            plain = page.find(">", name.end())
            if plain < 0:
                break
            stop = plain + 1
        else:
            stop = closing.end()
        attributes = page[name.end() : stop - 1]
        at = stop
        if tag in INLINE:
            if tag == "a":
                links = max(0, links - 1) if end_tag else 1
            elif tag in SPACING and parts:
                parts.append((" ", links > 0))
            continue
        flush()
        links = 0
        if tag in SKIPPED and not end_tag:
            if not attributes.endswith("/"):
                close = re.compile(f"</{re.escape(tag)}\\b", re.I).search(page, at)
                gt = page.find(">", close.end()) if close else -1
                at = len(page) if gt < 0 else gt + 1
            continue
        if tag in FLOW:
            while opened[-1][6]:
                leave(opened[-1][6])
        elif tag in ("option", "optgroup") and opened[opened[-1][6]][0] == "option":
            leave(opened[-1][6])
        if tag not in HIDING and not opened[-1][5]:
            heading = tag in HEADINGS and not end_tag
            item = tag in ("li", "dt", "dd") and not end_tag
        if end_tag:
            if still_open[tag] > 0:
                depth = len(opened) - 1
                while opened[depth][0] != tag:
                    depth -= 1
                leave(depth)
        elif tag in HIDING:
            if not attributes.endswith("/"):
                if ended is None:
                    ended = _ended(page)
                opened.append((tag, *opened[-1][1:5], True, 0 if begin in ended else len(opened)))
                still_open[tag] += 1
        elif tag not in VOID and tag not in HEADINGS and tag not in ("p", "li", "dt", "dd", "html", "head"):
            article, named, boilerplate, names, hidden = _standing(tag, attributes)
            _, in_article, in_named, in_boilerplate, in_names, in_hidden, unended = opened[-1]
            if tag in MAIN_TAGS:
                # Ends what outer names mark, as these may be of the layout, except for
                # articles beside the main one (comments, related ones).
                beside = tag == "article" and not in_names.isdisjoint(BESIDE_NAMES)
                if not (beside and (not names.isdisjoint(BESIDE_NAMES) or still_open["article"] > 0)):
                    in_names = frozenset()
                names = frozenset()
            clean = not boilerplate and not names
            article, named = (in_article or article) and clean, (in_named or named) and clean
            opened.append((tag, article, named, in_boilerplate or boilerplate, in_names | names, in_hidden or hidden, unended))
            still_open[tag] += 1
    flush()
    return blocks


def describe(blocks: list[Block]) -> list[tuple[float, ...]]:
    """The features of each block."""
    has_article = any(b.article and not b.boilerplate for b in blocks)
    none = Block("", 0, 0, False, False, False, False, False)
    out = []
    for before, block, after in zip([none, *blocks], blocks, [*blocks[1:], none]):
        out.append(
            (
                float(block.words),
                block.density,
                float(before.words),
                before.density,
                float(after.words),
                after.density,
                BESIDE if block.boilerplate or has_article and not block.article else IN_ARTICLE if has_article else UNMARKED,
                float(block.named),
                float(block.heading),
                float(block.item),
            )
        )
    return out


# Small labelled pages: for each block in order + for main text or - for the rest, and the
# page, in which ~n stands for n words.
LABELLED = [
    # Pages with an article element and marks around it.
    (
        "-- + +++ + -",
        "<nav><li><a>~1</a><li><a>~1</a></nav><article><h1>~9</h1><p>~84</p><p>~120</p><p>~3</p><p>~45</p></article><footer>~14</footer>",
    ),
    (
        "--- - +++++ -",
        "<nav><li><a>~1</a><li><a>~1</a><li><a>~1</a></nav><div class=ad>~9</div><article><h1>~4</h1><p>~2</p><p>~17</p><p>~55</p>"
        "<p>~4</p></article><footer>~7</footer>",
    ),
    (
        "- +++++++ --",
        "<header><a>~2</a></header><main><h1>~6</h1><p>~33 <a>~5</a></p><ul><li>~18<li>~6<li><a>~4</a></ul><p><a>~12</a></p><p>~1</p></main>"
        "<aside><h2>~2</h2><a>~5</a></aside>",
    ),
    (
        "-- ++ - ++ -- -",
        "<p>~6</p><p><a>~3</a></p><article><h2>~5</h2><p>~60</p><div class=advert>~25</div><p>~8</p><p>~70 <a>~20</a></p>"
        "<section id=comments><h3>~2</h3><p>~90</p></section></article><p>~28</p>",
    ),
    (
        "- ++++ ---",
        "<div class=cookie-notice>~30</div><article><p>~140</p><h2>~3</h2><table><tr><td>~2<td>~2</table></article>"
        "<div><p>~40</p><p>~75</p><p><a>~9</a></p></div>",
    ),
    (
        "- +++ -- -",
        "<form>~4</form><article><li><a>~7</a></li><li><a>~9</a></li><li><a>~2</a></li></article><div class=related><p>~22</p><p><a>~6</a></p></div>"
        "<footer><p>~18</p></footer>",
    ),
    # A wrapper named like an article beside one: the article is meant.
    ("- - +++ - -", "<div class=content><h3>~3</h3><p>~35</p><article><h1>~7</h1><p>~50</p><p>~5</p></article><p>~44</p><p><a>~3</a></p></div>"),
    ("-- ++ --", "<div id=main><li><a>~1</a></li><li><a>~2</a></li><article><p>~26</p><p>~31</p></article><p>~12</p><p>~64 <a>~4</a></p></div>"),
    # Only a wrapper named like an article, menus and other links unmarked inside it.
    (
        "--- ++++++ ---",
        "<div class=content><ul><li><a>~1</a><li><a>~1</a><li><a>~1</a></ul><h1>~8</h1><p>~62</p><p>~3</p><p>~41</p><p>~18 <a>~4</a></p><p>~52</p>"
        "<ul><li><a>~2</a><li><a>~3</a><li><a>~1</a></ul></div>",
    ),
    (
        "-- +++++ -",
        "<div id=post><p><a>~2</a></p><p><a>~1</a></p><h1>~5</h1><p>~24</p><p>~90</p><p>~6</p><p>~33</p></div><div class=sidebar>~15</div>",
    ),
    ("++++ ----", "<div class=story><h2>~4</h2><p>~30</p><p>~2</p><p>~11</p><p><a>~9</a></p><p><a>~7</a></p><p><a>~8</a></p><p><a>~3</a></p></div>"),
    ("- +++++", "<p><a>~4</a></p><div class=entry><h1>~6</h1><p>~15</p><ul><li>~6<li>~9<li>~4</ul></div>"),
    ("++ - +++ --", "<div class=post-body><p>~48</p><p>~20</p><p><a>~6</a></p><p>~39</p><p>~1</p><p>~72</p><p><a>~2</a> | <a>~2</a></p><p><a>~5</a></p></div>"),
    ("+++++", "<div class=article><h1>~10</h1><p>~5</p><p>~7</p><p>~4</p><p>~9</p></div>"),
    # Pages without a mark: text between menus, adverts and footers.
    (
        "----- - +++++ -",
        "<ul><li><a>~1</a><li><a>~1</a><li><a>~1</a><li><a>~1</a><li><a>~1</a></ul><div>~9</div><h1>~10</h1><p>~33</p><p>~20</p><p>~40</p><p>~110</p>"
        "<div>~12</div>",
    ),
    (
        "--- - ++++++ -",
        "<div><a>~1</a></div><div><a>~1</a></div><div><a>~2</a></div><div>~6</div><h1>~4</h1><p>~13</p><p>~55</p><p>~17</p><p>~4</p><p>~44</p><div>~7</div>",
    ),
    (
        "-- +++++++ ---",
        "<div><a>~2</a></div><div><a>~1</a></div><h1>~7</h1><p>~64</p><p>~80 <a>~4</a></p><p>~2</p><p>~60</p><p>~22 <a>~2</a></p><p>~35</p>"
        "<div><a>~3</a></div><div><a>~12</a></div><div>~4</div>",
    ),
    (
        "---- ++++",
        "<p><a>~3</a></p><p><a>~5</a></p><p><a>~8</a> ~1</p><p>~4</p><h2>~3</h2><p>~48 <a>~12</a></p><p>~26</p><p>~140 <a>~15</a></p>",
    ),
    ("+", "<div>~140 <a>~14</a></div>"),
    ("+++", "<p>~30</p><p>~30</p><p>~30</p>"),
    ("++++ ----", "<h1>~5</h1><p>~40</p><p>~52</p><p>~31 <a>~3</a></p><p><a>~10</a></p><p><a>~25</a> ~3</p><p><a>~30</a> ~8</p><p><a>~9</a></p>"),
    (
        "-- - +++++ --",
        "<li><a>~2</a></li><li><a>~1</a></li><p>~5</p><h1>~12</h1><p>~75</p><p>~21</p><p>~12</p><p>~33</p><div><a>~4</a> ~4</div><div>~6</div>",
    ),
    (
        "---- ++ - ++ -",
        "<li><a>~1</a></li><li><a>~2</a></li><li><a>~1</a></li><p>~8</p><h1>~8</h1><p>~58</p><p><a>~6</a></p><p>~64</p><p>~102</p><p>~11</p>",
    ),
    (
        "--- - +++++++ -",
        "<a>~1</a><hr><a>~1</a><hr><a>~1</a><div>~14</div><h1>~11</h1><p>~18</p><ul><li>~15<li>~19<li>~23</ul><p>~49</p><p>~143</p><div>~9</div>",
    ),
    ("--- ++++ ----", "<li><a>~1</a></li><li><a>~1</a></li><p>~11</p><h1>~14</h1><p>~35</p><p>~17</p><p>~49</p><p>~8</p><li><a>~2</a></li><li><a>~2</a></li><p>~3</p>"),
    ("------", "<p><a>~5</a></p><p><a>~7</a></p><p>~2 <a>~6</a></p><p><a>~4</a></p><p>~3</p><p><a>~2</a></p>"),
    ("----", "<h2>~2</h2><li><a>~6</a></li><li><a>~8</a></li><li><a>~5</a></li>"),
    # Pages without an article element whose other parts are marked.
    ("- +++ --", "<header>~6</header><h1>~9</h1><p>~44</p><p>~16</p><footer><p>~55 <a>~5</a></p><p><a>~4</a></p></footer>"),
    ("-- ++++ --", "<nav><a>~2</a><hr>~1</nav><p>~27</p><p>~3</p><p>~84</p><p>~19</p><div class=comments><p>~22</p><p>~90</p></div>"),
    ("- +++ -", "<div class=banner>~70</div><h1>~3</h1><p>~25</p><p>~38</p><div id=newsletter>~8</div>"),
]
_FILLER = re.compile(r"~([0-9]+)")
MAX_DEPTH = 10

#: A tree: the decision of a leaf, or (feature, threshold, tree at or below, tree above).
Tree = bool | tuple


def labelled_blocks(pages: list[tuple[str, str]] = LABELLED) -> list[tuple[tuple[float, ...], int]]:
    """The features and the label of each block of labelled pages, cut as all pages are."""
    out = []
    for marks, page in pages:
        found = describe(blocks_of(_FILLER.sub(lambda n: "word " * int(n[1]), page)))
        labels = [int(mark == "+") for mark in marks if mark in "+-"]
        if len(found) != len(labels):
            raise ValueError(f"{len(found)} blocks but {len(labels)} labels: {page[:60]}")
        out.extend(zip(found, labels))
    return out


def train(spark: SparkSession, pages: list[tuple[str, str]] = LABELLED, depth: int = MAX_DEPTH) -> Tree:
    """Fit a decision tree on the blocks of labelled pages."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.linalg import Vectors

    mark = FEATURES.index("mark")
    rows = [
        (Vectors.dense(features), float(label), 1.0 if features[mark] == UNMARKED else MARKED_WEIGHT)
        for features, label in labelled_blocks(pages)
    ]
    table = spark.createDataFrame(rows, ["features", "label", "weight"])
    learner = DecisionTreeClassifier(maxDepth=depth, maxBins=64, minInstancesPerNode=1, weightCol="weight", seed=0)
    fitted = learner.fit(table.coalesce(1))

    def walk(node) -> Tree:
        if node.subtreeDepth() == 0:
            return node.prediction() > 0.5
        split = node.split()
        return (split.featureIndex(), split.threshold(), walk(node.leftChild()), walk(node.rightChild()))

    return walk(fitted._java_obj.rootNode())


def keeps(tree: Tree, features: tuple[float, ...]) -> bool:
    while isinstance(tree, tuple):
        feature, threshold, below, above = tree
        tree = below if features[feature] <= threshold else above
    return tree


def extract(page: str | None, tree: Tree) -> str:
    """The main text of a page: kept blocks, an empty line between them."""
    blocks = blocks_of(page)
    return "\n\n".join(b.text for b, f in zip(blocks, describe(blocks)) if keeps(tree, f))


def main_text(pages: DataFrame, kept: list[str], html: str = "html") -> DataFrame:
    """The kept columns of every page and ``_text``."""
    tree = train(pages.sparkSession)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [extract(p, tree) for p in batch.column(html).to_pylist()]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.string())], names=[*kept, "_text"])

    fields = [*(common.renamed(pages.schema[c], c) for c in kept), T.StructField("_text", T.StringType())]
    return common.map_batches(pages.select(*dict.fromkeys([*kept, html])), run, fields)
