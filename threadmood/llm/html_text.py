"""Main text of web pages: flat blocks with their neighbours' measures, judged by a decision tree."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from threadmood.llm.html_labels import PAGES

#: Elements that begin and end a block; all others run on in the text around them.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select "
    "summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements whose content is no text of the page.
HIDDEN = frozenset("script style noscript template svg math iframe object head title textarea select button canvas audio video".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements around a block, and words in their class, id or role, that speak for or against it.
ARTICLE_TAGS, FRAME_TAGS = frozenset({"article", "main"}), frozenset({"nav", "footer", "aside", "form", "header", "dialog", "menu"})
FRAME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent "
    "disclaimer footer form header masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup "
    "promo promotion related replies respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
#: Names with such a word tell how a page is laid out (no-sidebar, comments-open), not what the element is.
STATE_WORDS = frozenset("no not has have with without open opened closed fixed sticky enabled disabled".split())
#: Frames that lay out whole pages too: an article inside one is weighed for itself. Inside any other it stays in the frame.
LAYOUT_TAGS = frozenset({"form"})
LAYOUT_WORDS = frozenset(
    "banner footer form header masthead menu modal nav navbar navigation notice notices sidebar toolbar widget".split()
)

#: What a start tag ends of the elements left open, and the elements beyond which it does not reach.
_ITEMS, _CELLS = frozenset("address div p".split()), frozenset({"td", "th"})
_BODIES, _CAPTIONS = frozenset("tbody thead tfoot".split()), frozenset({"caption", "colgroup"})
_IN_P = frozenset("body caption dd dt head html legend li optgroup option select tbody td tfoot th thead title tr".split())
_AROUND_P = HIDDEN | {"html", "table", "caption", "td", "th"}
IMPLIED = {
    **dict.fromkeys(BLOCKS - _IN_P, (frozenset({"p"}), _AROUND_P)),
    "li": (frozenset({"li", "p"}), (BLOCKS | HIDDEN) - _ITEMS),
    **dict.fromkeys(("dt", "dd"), (frozenset({"dt", "dd", "p"}), (BLOCKS | HIDDEN) - _ITEMS)),
    **dict.fromkeys(_CELLS, (_CELLS, HIDDEN | {"table", "tr"})),
    "tr": (_CELLS | _CAPTIONS | {"tr"}, HIDDEN | _BODIES | {"table"}),
    **dict.fromkeys(_BODIES | _CAPTIONS, (_CELLS | _CAPTIONS | _BODIES | {"tr"}, HIDDEN | {"table"})),
    "option": (frozenset({"option"}), frozenset({"select", "optgroup"})),
    "optgroup": (frozenset({"option", "optgroup"}), frozenset({"select"})),
    "body": (frozenset({"head"}), frozenset()),
}
NOTHING = (frozenset(), frozenset())
#: Elements that may stand in a head; any other, or a text, ends it.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title head html".split())

#: One page's markup, in order: comment, declaration, tag, or text. A text runs to the next "<".
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?|[^<]+|<", re.S)
_MARKS = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")

MEASURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "article", "frame")
#: Words beyond this count alike in the measures (the text itself is never cut).
MANY = 40


def _frame_words(attributes: str) -> set[str]:
    """Words of FRAME_WORDS in the class, id or role, but for those that tell a state of the page."""
    if "=" not in attributes:
        return set()
    names = " ".join(a or b or c for a, b, c in _MARKS.findall(attributes)).lower().split()
    words = (set(_WORD.findall(name)) for name in names)
    return {word for own in words if own.isdisjoint(STATE_WORDS) for word in own & FRAME_WORDS}


def _frame(tag: str, attributes: str) -> tuple[int, int]:
    """Whether the element is a frame, and whether one that an article inside does not leave."""
    if tag in ("body", "html", "main"):
        return 0, 0
    words = _frame_words(attributes)
    if tag == "article":  # a comment or a teaser, say, as an article of its own
        words -= LAYOUT_WORDS
    framed = tag in FRAME_TAGS or bool(words)
    return int(framed), int(framed and (tag in FRAME_TAGS - LAYOUT_TAGS or not words <= LAYOUT_WORDS))


def flat_blocks(page: str) -> list[tuple[str, int, float, int, float]]:
    """(text, words, share of words in links, depth in articles, depth in frames) of each block with text.

    Frames count from the nearest article on; half a frame is one around that article that may be a
    layout of the page (LAYOUT_WORDS). Frames around a ``main`` do not count inside it. A header inside an article is part of it. Character references are decoded, and white
    space inside a block is one space. End tags that HTML lets a page omit are taken as given
    (IMPLIED, IN_HEAD); what a broken page leaves open besides ends with the page.
    """
    out = []
    parts: list[str] = []
    linked = 0
    open_: list[tuple] = []  # tag; articles, frames and hidden before it
    left = Counter()  # of each tag, how many are open
    articles = links = 0
    frames = (0, 0, False)  # those that count, those of them that an article does not leave, any around the article
    hidden = False

    def close() -> None:
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip()
            if text:
                words = text.count(" ") + 1
                out.append((text, words, min(1.0, linked / words), articles, frames[0] or 0.5 * frames[2]))
            parts.clear()
        linked = 0

    def reopen(i: int) -> None:
        """As it was before the open element ``i``, which ends with all inside it."""
        nonlocal articles, frames, links, hidden
        if i < len(open_):
            for name, *_ in open_[i:]:
                left[name] -= 1
            links, (_, articles, frames, hidden) = left["a"], open_[i]
            del open_[i:]

    at, end = 0, len(page)
    while at < end:
        token = _TOKEN.match(page, at)
        at = token.end()
        tag = token[2]
        if tag is None:
            text = token[0]
            if open_ and open_[-1][0] == "head" and text.strip() and not text.startswith(("<!", "<?")):
                reopen(len(open_) - 1)
            if not hidden and not (text.startswith(("<!", "<?"))):
                text = html.unescape(text)
                parts.append(text)
                if links:
                    linked += len(text.split())
            continue
        tag = tag.lower()
        if token[1]:
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] == tag:
                    if tag in BLOCKS:
                        close()
                    reopen(i)
                    break
            else:
                if tag in BLOCKS and not hidden:
                    close()
            continue
        if tag in BLOCKS and not hidden:
            close()
        if open_ and open_[-1][0] == "head" and tag not in IN_HEAD:
            reopen(len(open_) - 1)
        ended, beyond = IMPLIED.get(tag, NOTHING)
        if any(map(left.get, ended)):
            first = len(open_)
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] in ended:
                    first = i
                elif open_[i][0] in beyond:
                    break
            reopen(first)
        if tag == "br":
            parts.append(" ")
        if tag in EMPTY or token[3].endswith("/"):
            continue
        if tag in ("script", "style", "textarea", "title"):  # raw text up to their own end
            stop = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            if tag != "textarea" and not hidden:
                close()
            at = stop.end() if stop else end
            continue
        open_.append((tag, articles, frames, hidden))
        left[tag] += 1
        links = left["a"]
        articles += tag in ARTICLE_TAGS
        if tag == "main":
            frames = (0, 0, False)
        elif tag == "article" and not frames[1]:
            frames = (0, 0, frames[2] or frames[0] > 0)
        if not (tag == "header" and articles):
            framed, stays = _frame(tag, token[3])
            frames = (frames[0] + framed, frames[1] + stays, frames[2])
        hidden = hidden or tag in HIDDEN
    close()
    return out


def measures(blocks: list[tuple[str, int, float, int, float]]) -> list[tuple[float, ...]]:
    """MEASURES of each block: its own words and links, its neighbours', and what it stands in."""
    flat = [(0, 0.0)] + [(min(words, MANY), links) for _, words, links, _, _ in blocks] + [(0, 0.0)]
    return [
        (*map(float, flat[i + 1]), *map(float, flat[i]), *map(float, flat[i + 2]), float(min(block[3], 1)), float(min(block[4], 1)))
        for i, block in enumerate(blocks)
    ]


def labelled_blocks() -> list[tuple[float, list[float]]]:
    """(label, measures) of the labelled table."""
    rows = []
    for page in PAGES:
        blocks = flat_blocks("".join(piece for _, piece in page))
        if len(blocks) != len(page):
            raise ValueError("a piece of the labelled table is not one block")
        rows += [(float(mark == "+"), list(own)) for (mark, _), own in zip(page, measures(blocks), strict=True)]
    return rows


@cache
def trained_tree(spark: SparkSession, depth: int = 5) -> tuple:
    """The tree as nested tuples (measure, threshold, left, right), and a truth at each leaf."""
    table = spark.createDataFrame(labelled_blocks(), "label double, own array<double>")
    model = DecisionTreeClassifier(maxDepth=depth, seed=1).fit(table.select("label", array_to_vector("own").alias("features")))

    def node(at):
        if at.numDescendants() == 0:
            return at.prediction() == 1.0
        split = at.split()
        return (split.featureIndex(), split.threshold(), node(at.leftChild()), node(at.rightChild()))

    return (node(model._java_obj.rootNode()),)


def is_main(tree, own: tuple[float, ...]) -> bool:
    while isinstance(tree, tuple):
        measure, threshold, left, right = tree
        tree = left if own[measure] <= threshold else right
    return tree


def main_text(page: str, tree) -> str:
    blocks = flat_blocks(page)
    return "\n".join(block[0] for block, own in zip(blocks, measures(blocks), strict=True) if is_main(tree, own))


def extract(df: DataFrame, html_col: str = "html") -> DataFrame:
    """The rows of ``df`` without ``html``, with ``text`` (an earlier column of that name gives way).

    The text of a page is its main blocks in page order, one per line; empty if it has none. The
    tree is trained here on the labelled table of a few pages that comes with the package, a
    size that no data changes. Pages stay where they are: no shuffle, one page at a time. NULL
    and empty pages give an empty text; repeated rows are extracted each; an empty table gives
    an empty result.
    """
    [tree] = trained_tree(df.sparkSession)
    kept = [f for f in df.schema.fields if f.name not in (html_col, "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                own = batch.slice(start, 500)
                texts = [main_text(page or "", tree) for page in own.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*own.columns[1:], pa.array(texts, pa.string())], names=[*(f.name for f in kept), "text"]
                )

    schema = T.StructType([*kept, T.StructField("text", T.StringType())])
    return df.select(html_col, *(f.name for f in kept)).mapInArrow(run, schema)
