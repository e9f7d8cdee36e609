"""Main text of HTML pages: flat text blocks, classified by a decision tree.

A page is cut into flat blocks of text; each has its number of words and its link density,
those of the blocks before and after it, and flags of what it stands in.  A decision tree
that Spark ML trains on the labelled blocks of `labelled_pages` says which belong to the
article.  Pages are independent rows: no shuffle, one block of pages at a time in memory.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from examloom.llm.common import blocks
from examloom.llm.labelled_pages import PAGES

BLOCK_BYTES = 1 << 20
MAX_DEPTH = 8
SEED = 7
SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

# Elements of HTML by their kind.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
    "p pre section summary table tbody td tfoot th thead tr ul".split())
RAW_TAGS = frozenset("script style noscript template iframe noembed noframes textarea title xmp svg "
                     "select button object canvas audio video".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
AROUND_TAGS = frozenset("nav footer aside form dialog menu".split())
MAIN_TAGS = frozenset("article main".split())
# Names of classes, ids and roles of what stands around an article.
AROUND_NAMES = frozenset(
    "ad ads adsense adslot advert advertisement alert aside banner breadcrumb breadcrumbs complementary "
    "contentinfo cookie cookies consent copyright disclaimer disqus footer form header hidden legal login "
    "masthead menu modal nav navbar navigation newsletter notice notification pager pagination popup promo "
    "promotion recommended related reply respond search share sharing sidebar signup skip social sponsor "
    "sponsored subscribe teaser toolbar widget".split())
AROUND_STEMS = ("comment", "advert", "sponsor", "breadcrumb", "cookie", "newsletter", "sidebar")
# Words of layout that a compound name may hold beside those: `cookie-bar` and `related-posts` stand around
# an article, `social-science` and `content-with-sidebar` do not.
LAYOUT_NAMES = frozenset(
    "area aside bar block body bottom box buttons column container content fixed global group holder icons inner item "
    "items left link links list main page panel post posts primary right row secondary section site slot top unit "
    "wrap wrapper".split())
COMMENTS = re.compile(r"\W*(?:\d+\s+)?(?:reader\s+|user\s+)?(?:comments?|responses?|replies)\b.{0,20}", re.I | re.S)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
NAMED = re.compile(r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after",
            "in_around_tag", "in_around_class", "in_main_tag", "is_heading")


def _around(attributes: str) -> bool:
    """Whether class, id or role say that an element stands around an article."""
    for m in NAMED.finditer(attributes):
        for name in (m[2] or m[3] or m[4] or "").lower().split():
            parts = [p for p in re.split(r"[-_:]+", name) if p and not p.isdigit()]
            told = [p in AROUND_NAMES or p.startswith(AROUND_STEMS) for p in parts]
            # A compound name counts as a whole: it holds nothing but such words and words of layout.
            if any(told) and all(t or p in LAYOUT_NAMES for t, p in zip(told, parts)):
                return True
    return HIDDEN.search(attributes) is not None


def flat_blocks(html: str) -> list[tuple[str, list[float], bool]]:
    """(text, own and context features, labelled as main) of each block, in page order."""
    found: list[list] = []
    open_tags: list[tuple[str, int, int, int, bool]] = []
    around = classes = main = links = 0
    heading = label = False
    parts: list[str] = []
    linked = 0

    def close() -> None:
        nonlocal parts, linked, classes
        if parts:
            text = "".join(parts)
            words = text.split()
            if heading and len(words) <= 8 and COMMENTS.fullmatch(" ".join(words)):
                # What follows in the heading's parent is said by readers.
                classes += 1
                if len(open_tags) > 1:
                    tag, is_around, named, in_main, marked = open_tags[-2]
                    open_tags[-2] = (tag, is_around, named + 1, in_main, marked)
            if words:
                density = min(1.0, linked / max(1, len(text)))
                found.append([" ".join(words), float(len(words)), density, float(around > 0),
                              float(classes > 0), float(main > 0), float(heading), label])
        parts, linked = [], 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            text = unescape(text) if "&" in text else text
            parts.append(text)
            if links:
                linked += len(text)

    at, end = 0, len(html)
    while at < end:
        m = TOKEN.search(html, at)
        if not m:
            add(html[at:])
            break
        add(html[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing = bool(m[1] or m[4])
        attributes = m[3] or m[6] or ""
        if tag in RAW_TAGS:
            if not closing:
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, at)
                at = stop.end() if stop else end
        elif tag == "a":
            links = 0 if closing else 1
        elif tag == "br":
            parts.append("\n")
        elif tag in BLOCK_TAGS:
            close()
            if closing:
                if any(t[0] == tag for t in open_tags):
                    while True:
                        t = open_tags.pop()
                        around, classes, main = around - t[1], classes - t[2], main - t[3]
                        if t[0] == tag:
                            break
                heading, label = False, any(t[4] for t in open_tags)
            else:
                heading = tag in HEADINGS
                marked = "data-main" in attributes
                if tag == "li" or tag in ("p", "dt", "dd", "td", "th", "tr") or heading:
                    # These end where the next of their kind or their parent's end stands.
                    if open_tags and open_tags[-1][0] in ("p", "li", "dt", "dd", "td", "th", *HEADINGS) \
                            and (open_tags[-1][0] == tag or open_tags[-1][0] == "p"):
                        t = open_tags.pop()
                        around, classes, main = around - t[1], classes - t[2], main - t[3]
                elif open_tags and open_tags[-1][0] == "p":
                    t = open_tags.pop()
                    around, classes, main = around - t[1], classes - t[2], main - t[3]
                if tag != "hr":
                    in_main = int(tag in MAIN_TAGS)
                    is_around = int(tag in AROUND_TAGS or tag == "header" and not main)
                    named = int(tag not in ("html", "body", "article", "main") and _around(attributes)) if attributes else 0
                    open_tags.append((tag, is_around, named, in_main, marked))
                    around, classes, main = around + is_around, classes + named, main + in_main
                label = any(t[4] for t in open_tags)
    close()
    out = []
    for i, b in enumerate(found):
        before = found[i - 1] if i else None
        after = found[i + 1] if i + 1 < len(found) else None
        out.append((b[0], [b[1], b[2], before[1] if before else 0.0, before[2] if before else 0.0,
                           after[1] if after else 0.0, after[2] if after else 0.0, *b[3:7]], b[7]))
    return out


def train_tree(spark: SparkSession, pages=PAGES, max_depth: int = MAX_DEPTH):
    """Decision tree on the labelled blocks, as nested (feature, threshold, left, right) or a bool.

    The labelled table is a parameter and small; Spark ML trains on all of it.
    """
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.linalg import Vectors

    rows = [(Vectors.dense(features), float(main)) for page in pages
            for _, features, main in flat_blocks(page)]
    table = spark.createDataFrame(rows, ["features", "label"]).coalesce(1)
    model = DecisionTreeClassifier(maxDepth=max_depth, seed=SEED, maxBins=64).fit(table)

    def nested(node):
        if node.numDescendants() == 0:
            return node.prediction() == 1.0
        split = node.split()
        return split.featureIndex(), split.threshold(), nested(node.leftChild()), nested(node.rightChild())

    return nested(model._java_obj.rootNode())


def is_main(tree, features: list[float]) -> bool:
    while not isinstance(tree, bool):
        feature, threshold, left, right = tree
        tree = left if features[feature] <= threshold else right
    return tree


def main_text(html: str | None, tree) -> str:
    return " ".join(text for text, features, _ in flat_blocks(html or "") if is_main(tree, features))


def extract(pages: DataFrame, tree=None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    Null pages and pages without main text give an empty text; ids and urls are passed on, so
    null and repeated ones are fine.  An empty table gives no rows.
    """
    tree = train_tree(pages.sparkSession) if tree is None else tree
    names = SCHEMA.fieldNames()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in blocks(batch.column(2), BLOCK_BYTES):
                part = batch.slice(start, stop - start)
                texts = [main_text(html, tree) for html in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array(texts, pa.string()),
                    pa.array(list(map(len, texts)), pa.int64())], names)

    rows = pages.select(F.col("`page_id`").cast("long").alias("page_id"),
                        F.col("`url`").cast("string").alias("url"), F.col("`html`").cast("string").alias("html"))
    return rows.mapInArrow(work, SCHEMA)
