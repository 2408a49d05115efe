"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into text blocks at block-level tags. A block is described by
its own words and link density, those of its neighbours, whether it is a
heading, and where it stands: inside an article or main element, or inside a
menu, footer, sidebar, notice, advert, form or comment section. A decision
tree, trained on the small table of labelled blocks below, keeps or drops it.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- blocks --------------------------------------------------------------------------------------------------------

BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page.
DROPPED_TAGS = frozenset("head script style template noscript iframe svg canvas object audio video select textarea button title".split())
#: Dropped elements whose content is not markup.
RAW_TAGS = frozenset("script style iframe textarea title noscript".split())
#: Tags that a tag of the same kind closes.
SELF_CLOSING = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th")}
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

CHROME_TAGS = frozenset(("nav", "aside", "footer", "menu", "dialog"))
#: Chrome unless an article inside it, or around it, says otherwise.
SOFT_TAGS = frozenset(("header", "form"))
ROLES = {"navigation", "complementary", "contentinfo", "search", "dialog", "alertdialog", "menu", "menubar", "form", "toolbar"}
CHROME_WORDS = frozenset(
    "nav navbar navigation menu sidebar footer masthead banner ad ads advert advertisement advertising adsense sponsor sponsored promo "
    "promotion cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login share "
    "sharing social breadcrumb breadcrumbs pagination pager toolbar widget skip copyright legal disclaimer".split())
#: Chrome also in an article, or where an article is inside it.
HARD_WORDS = frozenset("comment comments disqus respond replies related recommended recommendations".split())
SOFT_WORDS = frozenset(("header", "form", "search"))
MAIN_WORDS = frozenset("article content main post entry story articlebody".split())
#: A class such as "has-sidebar" describes a layout, not the element.
LAYOUT_WORDS = frozenset("has with no without open closed".split())

_TAG = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"""
    r"""|<([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.S)
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
#: Whole tag names, searched in the page itself: lower-casing may change the length of a text.
_CLOSING = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I | re.A) for tag in DROPPED_TAGS}
_EITHER = {tag: re.compile(rf"<(/?){tag}(?=[\s/>]|\Z)", re.I | re.A) for tag in DROPPED_TAGS}
#: What matters inside a head: its end, a body, and elements and comments whose content is no markup.
_IN_HEAD = re.compile(rf"<!--.*?(?:--!?>|\Z)|<({'|'.join(sorted(RAW_TAGS))})(?=[\s/>])[^>]*+>|(</head|<body)(?=[\s/>]|\Z)", re.I | re.A | re.S)
#: Dropped elements that may hold elements of their own name.
NESTING_TAGS = frozenset(("svg", "object", "template"))
#: The slash at the end of a tag belongs to an attribute value without quotes.
_VALUE_SLASH = re.compile(r"""=\s*[^\s"'=<>`]*/\Z""")


@dataclass
class Block:
    text: str
    words: int
    link_words: int
    level: int  # 3 in an article, 2 in main, 1 in an element that is called so, 0 elsewhere
    chrome: bool
    heading: bool


def _place(tag: str, attributes: str, level: int, chrome: int) -> tuple[int, int]:
    """(level, chrome) inside an element that opens where these hold.

    Chrome 3 stays chrome, 2 ends at an article or main element, 1 at anything called so.
    """
    found = {}
    if attributes.strip(" /"):
        for name, value in _ATTRIBUTE.findall(attributes):
            found.setdefault(name.lower(), value.strip("\"'"))
    role = found.get("role", "").lower()
    names: set[str] = set()
    if tag not in ("html", "body"):
        for name in f"{found.get('class', '')} {found.get('id', '')}".split():
            parts = {p.lower() for p in _PARTS.findall(name)}
            if not parts & LAYOUT_WORDS:
                names |= parts
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
    own = 3 if tag == "article" or found.get("itemprop", "").lower() == "articlebody" else 2 if tag == "main" or role == "main" else 0
    if hidden or tag in CHROME_TAGS or role in ROLES or names & HARD_WORDS:
        return level, 3
    if own:
        return max(level, own), chrome if chrome == 3 else 0
    if names & CHROME_WORDS and not names & (MAIN_WORDS - {"post"}):
        return level, max(chrome, 2)
    if names & MAIN_WORDS:
        return max(level, 1), chrome if chrome >= 2 else 0
    if (tag in SOFT_TAGS or role == "banner" or names & SOFT_WORDS) and not level:
        return level, max(chrome, 1)
    return level, chrome


def blocks(html: str) -> list[Block]:
    """The text blocks of a page in order. Anything may be unclosed, misnested or cut off."""
    out: list[Block] = []
    stack: list[tuple[str, int, int]] = []  # open elements with (level, chrome) inside them
    text: list[str] = []
    level = chrome = links = link_words = 0
    at, end = 0, len(html)
    unclosed: set[str] = set()  # dropped tags that nothing closes any more

    def flush() -> None:
        nonlocal link_words
        whole = _SPACE.sub(" ", "".join(text)).strip(" ")
        text.clear()
        if whole:
            heading = any(t in HEADINGS for t, _, _ in stack[-4:])
            out.append(Block(whole, whole.count(" ") + 1, link_words, level, chrome > 0, heading))
        link_words = 0

    def close(names: tuple[str, ...], stop: tuple[str, ...] = ()) -> None:
        """Close the innermost of ``names`` and what is open inside it."""
        nonlocal level, chrome, links
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                if any(t == "a" for t, _, _ in stack[i:]):
                    links = 0
                del stack[i:]
                level, chrome = stack[-1][1:] if stack else (0, 0)
                return
            if stack[i][0] in stop:
                return

    while at < end:
        m = _TAG.search(html, at)
        piece = html[at:m.start() if m else end]
        if piece:
            piece = unescape(piece)
            text.append(piece)
            if links:
                link_words += len(_WORD.findall(piece))
        if not m:
            break
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            if tag in BLOCK_TAGS:
                flush()
            close((tag,))
        elif m[2]:
            tag = m[2].lower()
            empty = m[3].endswith("/") and not _VALUE_SLASH.search(m[3])
            if tag in DROPPED_TAGS:
                if empty and (tag == "svg" or tag not in unclosed and _reopened(html, tag, at)):
                    continue
                after = -1 if tag in unclosed else _skip(html, tag, at)
                if after >= 0:
                    at = after
                    continue
                unclosed.add(tag)
                if empty:
                    continue
                if tag in RAW_TAGS:
                    break
            if tag in BLOCK_TAGS:
                flush()
                if tag in SELF_CLOSING:
                    close(SELF_CLOSING[tag], ("ul", "ol", "dl", "table", "div", "article", "section", "blockquote", "td", "body")
                          if tag != "td" and tag != "th" else ("tr", "table"))
            elif tag == "br":
                text.append(" ")
            if tag in VOID_TAGS or empty and tag not in BLOCK_TAGS:
                continue
            level, chrome = _place(tag, m[3], level, chrome)
            stack.append((tag, level, chrome))
            if tag == "a":
                links = 1
    flush()
    return out


def _reopened(html: str, tag: str, at: int) -> bool:
    """A tag with a slash at its end stands for an empty element: the next tag of its name opens another one.

    Browsers ignore the slash and take what follows as content, up to the
    closing tag; so does this where a closing tag comes next. In pages written
    as XML that would drop all the text up to the next such element.
    """
    following = _EITHER[tag].search(html, at)
    return following is not None and not following[1]


def _skip(html: str, tag: str, at: int) -> int:
    """Where the text goes on behind the element that opened before ``at``; -1 if nothing closes it."""
    if tag == "head":
        return _skip_head(html, at)
    closed = first = _CLOSING[tag].search(html, at)
    if tag in NESTING_TAGS and first:
        depth, closed = 1, None
        for m in _EITHER[tag].finditer(html, at):
            inner = _TAG.match(html, m.start())
            depth += -1 if m[1] else 0 if inner and inner[3] and inner[3].endswith("/") and not _VALUE_SLASH.search(inner[3]) else 1
            if not depth:
                closed = m
                break
        closed = closed or first  # not balanced: the first closing tag
    if not closed:
        return -1
    end = html.find(">", closed.start())
    return len(html) if end < 0 else end + 1


def _skip_head(html: str, at: int) -> int:
    """Behind the head's closing tag, or at the body if that comes first; tags inside scripts and comments do not count."""
    while m := _IN_HEAD.search(html, at):
        at = m.end()
        if m[2]:
            if m[2].lower() == "<body":
                return m.start()
            end = html.find(">", at)
            return len(html) if end < 0 else end + 1
        if m[1] and (closed := _CLOSING[m[1].lower()].search(html, at)):
            at = closed.end()
    return -1


FEATURES = ("words", "link_density", "words_before", "links_before", "words_after", "links_after", "level", "gap", "chrome", "heading")


def features(found: list[Block]) -> list[tuple[float, ...]]:
    """A row of FEATURES per block; gap: how far its level is below the page's highest outside chrome."""
    top = max((b.level for b in found if not b.chrome), default=0)
    size = [(float(b.words), b.link_words / b.words) for b in found]
    edge = (0.0, 0.0)
    return [(*size[i], *(size[i - 1] if i else edge), *(size[i + 1] if i + 1 < len(found) else edge),
             float(b.level), float(top - b.level), float(b.chrome), float(b.heading)) for i, b in enumerate(found)]


# --- the labelled table and the tree -------------------------------------------------------------------------------

#: Labelled pages. +12 is a block of twelve words that belongs to the main text, -3 one of three words that does not.
LABELLED = (
    "<body><nav><ul><li><a>-1</a><li><a>-1</a><li><a>-2</a></ul></nav><div class='ad'>-9</div><article><h1>+9</h1><p>+40<p>+1</p><p>+2<p>+120</article><footer>-14</footer>",
    "<body><nav><a>-2</a></nav><div class='ad'>-30</div><article><h1>+4</h1><p>+1</p></article><footer>-30</footer>",
    "<body><header><div>-3</div><nav><a>-2</a></nav></header><main><h1>+5</h1><p>+60</p><ul><li>+4<li>+12</ul><p>+3</p></main><aside><h3>-2</h3><a>-6</a><p>-25</p></aside><footer><p>-11</p></footer>",
    "<body><header><h1>-3</h1></header><main><article><header><h1>+7</h1><p>+4</p></header><p>+80</p><aside><p>-30</p></aside><p>+33</p><footer><a>-3</a></footer></article><div>-20</div></main>",
    "<body><div id='menu'><a>-3</a></div><div id='content'><h2>+6</h2><p>+55</p><p>+2</p><blockquote>+18</blockquote></div><div class='sidebar'><p>-22</p><a>-4</a></div><div id='footer'>-16</div>",
    "<body><article><h1>+6</h1><p>+45</p></article><section id='comments'><h2>-2</h2><article class='comment'><p>-35</p></article><div class='comment'>-60</div></section>",
    "<body><form><input><div>-2</div><article><h1>+3</h1><p>+70</p><form><label>-4</label></form></article></form>",
    "<body><div class='cookie-notice'><p>-28</p><a>-2</a></div><main><p>+34</p><p>+5</p></main><div class='newsletter'><p>-17</p></div>",
    "<body><div><a>-4</a></div><div><h1>+6</h1><p>+50</p><p>+42</p><p>+9</p><p>+37</p></div><div><a>-7</a></div><div>-8</div>",
    "<body><table><tr><td><a>-2</a><td><h2>+5</h2><p>+64</p><p>+48</p></td><td><a>-3</a></td></table><center>-6</center>",
    "<body><h1>+4</h1><p>+30</p><p>+26</p><p>+44</p>",
    "<body><p>+25</p>",
    "<body><div>+18</div><div>+40</div>",
    "<body><ul><li><a>-1</a><li><a>-1</a><li><a>-1</a></ul><p>+38</p><p>+21</p><p>+7</p><p>+30</p><ul><li><a>-5</a><li><a>-6</a></ul><p>-5</p>",
    "<body><a>-2</a><div><a>-7</a></div><div><a>-8</a></div><div><a>-6</a></div><div>-3</div>",
    "<body><div role='navigation'>-6</div><div role='main'><h1>+3</h1><p>+16</p><pre>+22</pre></div><div role='contentinfo'>-24</div>",
    "<body><div class='header'>-5</div><div class='post'><h2>+5</h2><div class='entry-content'><p>+90</p><p>+3</p><div class='share'><a>-2</a></div></div></div><div class='related'><a>-7</a><p>-15</p></div>",
    "<body><article><p>+8</p><div class='advert'>-12</div><p>+6</p><figure><figcaption>+5</figcaption></figure><table><tr><td>+1<td>+2</table></article><p>-40</p>",
    "<body><p>-13</p><article><p>+2</p></article><p>-3</p><div>-70</div>",
    "<body><div>-44</div><main><p><a>+3</a></p><p>+20</p><p><a>+6</a></p></main><div><a>-9</a></div>",
    "<body><article><h1>+9</h1><p>+40<p>+1",
    "<body><nav><a>-6</a></nav><article><p>+1",
    "<article>+2</article>",
    "<body><nav><a>-6</a></nav><article><h1>+9</h1><p>+60</p><p>+50</p>",
    "<body><main><p>+50</p><p>+60</p><p>+8</p></main>",
    "<body><div class='content'><p>+70</p><p>+60</p><p>+8</p></div>",
    "<body><article><p>+90</p><p>+60</p><p>+80</p></article>",
    "<body><article><p>+30</p><p>+3</p></article>",
    "<body><div class='ad'>-8</div><main><p>+12</p><p>+4</p></main>",
    "<body><article><p>+5</p></article><div class='comments'>-3</div>",
    "<body><main><p>+5</p></main><footer>-60</footer>",
    "<body><div class='entry'><p>+5</p><p>+60",
    "<body><p>+300</p>",
    "<body><article><h2>+3</h2><ul><li><a>+4</a><li><a>+3</a></ul><p>+15</p></article><nav><a>-4</a></nav>",
)


#: Each labelled page enters the table so many times, with other block sizes.
VARIANTS = 12


def labelled_rows() -> list[tuple[float, ...]]:
    """FEATURES and the label (1 main text, 0 not) of every block of the labelled pages.

    Where elements tell main text from the rest, blocks of any size occur in
    both, so sizes are drawn anew; where only sizes and links tell, they vary
    by a third.
    """
    rng = random.Random(7)
    rows = []
    for page in LABELLED:
        labels = [float(s == "+") for s in re.findall(r">([+-])\d", page)]
        marked = any(b.level for b in blocks(re.sub(r">[+-](\d+)", ">word", page)))
        for k in range(VARIANTS):
            def size(n: int) -> int:
                return n if not k else rng.choice((1, 2, 5, 12, 30, 80, n)) if marked else max(1, round(n * rng.uniform(0.67, 1.33)))
            found = blocks(re.sub(r">[+-](\d+)", lambda m: ">" + "word " * size(int(m[1])), page))
            rows += [(*f, y) for f, y in zip(features(found), labels, strict=True)]
    return rows


@dataclass(frozen=True)
class Split:
    feature: int
    threshold: float
    low: object  # Split or the class
    high: object


def train(spark: SparkSession, max_depth: int = 8):
    """The decision tree fitted to the labelled table: nested Splits with classes 0.0 and 1.0 as leaves."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler
    table = spark.createDataFrame(labelled_rows(), [*FEATURES, "label"]).coalesce(1)
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(table)
    model = DecisionTreeClassifier(maxDepth=max_depth, minInstancesPerNode=2, seed=1).fit(rows)

    def read(node):
        if node.numDescendants() == 0:
            return node.prediction()
        split = node.split()
        return Split(split.featureIndex(), split.threshold(), read(node.leftChild()), read(node.rightChild()))
    return read(model._java_obj.rootNode())


def decide(tree, row: tuple[float, ...]) -> bool:
    while isinstance(tree, Split):
        tree = tree.low if row[tree.feature] <= tree.threshold else tree.high
    return tree == 1.0


def main_text(html: str, tree) -> str:
    """The kept blocks of a page in order, one per line."""
    found = blocks(html)
    return "\n".join(b.text for b, row in zip(found, features(found)) if decide(tree, row))


def extract(pages: DataFrame, tree=None) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page.

    Character references are decoded; white space inside a block is one
    blank; kept blocks are joined by line ends. Null or empty html gives the
    empty text; null ids and urls, repeated rows and pages of any length are
    pages like others; extra columns are not read. ``tree`` defaults to one
    trained here.
    """
    tree = tree or train(pages.sparkSession)
    rows = pages.select("page_id", "url", "html")
    schema = pages.select("page_id", "url", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema

    def run(batches):
        for batch in batches:
            texts = [main_text(h, tree) if h else "" for h in (v.as_py() for v in batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, schema)
