"""HTML extraction with site style trees.

The pages of a host are merged into one tree of element paths (tag and first class).  For each path
the tree knows how its children are laid out on each page (presentation) and what its text is
(content).  A node whose presentation and content are the same all over the host has entropy near
zero: it belongs to the template.  Importance is

    GAMMA * (content entropy) + (1 - GAMMA) * (presentation entropy of the branch above)

with entropies normalised to [0, 1] by the number of pages that have the node, and drawn towards 1
where these are few (``SMALL``): a block that two pages share can go, one in an article only if six do.
Pages of a host with
the same text apart from declared noise count once, so that copies of a page are not mistaken for
the template.

What the markup declares is a weight added to a block's importance: ``DECLARED`` for elements whose
tag, role or whole class or id name says that they are navigation, adverts, forms, comments and the
like, or whose name has such a word outside ``article`` and ``main``; ``WORD`` where a longer name
only has the word within them (``related-work``), and for the word header in a longer name, which titles
of articles bear too; names of states (``has-sidebar``) declare nothing; ``CONTENT`` for the blocks of
``article`` and ``main``.  Blocks with a sum below ``LEAST`` are removed from each page: in an article a template box
goes and distinctive text with a listed word stays.

An ``article`` or ``main`` speaks for itself inside a form, or inside an element that only a longer name declares; a form without one that
holds most of the page's text is the page's frame.  Inline elements that are declared noise (a button, ``span class=ad``) are taken out of their
block.

The tree is made by a group-by over (host, path, hash) with partial aggregation; a page gets back only those of its own paths that have low
importance, by a join on (host, path), so no list grows with a host.  Elements deeper than ``MOST_DEPTH`` share the tree's path of the one
above; what their markup declares counts for each.

Defined cases: null html is empty, and so is its text; a null or odd url is a host of its own
(the empty one); repeated rows are judged alike and come out as often as they went in; very long pages
and very deep ones are read whole, in a time that grows with their length whatever their
markup; an empty table gives no row.  Columns other than ``page_id``, ``url`` and
``html`` are not carried.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.llm.common import stage

GAMMA = 0.9
LEAST = 0.3
DECLARED, WORD, CONTENT = -1.0, -0.4, 0.2
#: Pages of full entropy that every node is taken to have besides its own.
SMALL = 0.6
MOST_DEPTH = 400

# Element names and words that declare what an element is.
_SILENT = "title script style noscript template svg math iframe object canvas head textarea select"
_CHROME = "nav footer aside form menu dialog button fieldset label legend"
_FORMS = "form fieldset"
_BLOCKS = (
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul"
)
_VOID = "area base br col embed hr img input link meta param source track wbr"
_NAMED = (
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr header masthead menu menubar modal nav navbar navigation "
    "newsletter notice notices notification pagination popup promo promoted promotion related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget"
)
_STATES = "has is no not with without"
_ARTICLES = "article main story"
_ROLES = "banner navigation complementary contentinfo search form menu menubar dialog alert"


class _Parser:
    """Blocks of a page.  Compiled patterns are made in the worker."""

    def __init__(self) -> None:
        self.silent = frozenset(_SILENT.split())
        self.chrome = frozenset(_CHROME.split())
        self.blocks = frozenset(_BLOCKS.split())
        self.void = frozenset(_VOID.split())
        self.named = frozenset(_NAMED.split())
        self.roles = frozenset(_ROLES.split())
        self.name = re.compile(r"</?([a-zA-Z][^\s/>]*+)")
        # one attribute, or the end of the tag; a quote that isn't closed is a part of the value
        self.attr = re.compile(r"[\s/]*+(?:(>)|([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?+)")
        self.raw_end = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in self.silent - {"head"}}
        self.forms = frozenset(_FORMS.split())
        self.articles = frozenset(_ARTICLES.split())
        self.telling = frozenset("class id role hidden aria-hidden".split())
        self.words = re.compile(r"[a-z]+")
        self.states = frozenset(_STATES.split())

    def _said(self, name: str) -> list[str]:
        """The words of a longer name that say what an element is; what follows a word of states (``has-sidebar``,
        ``content-with-sidebar``) says nothing of it."""
        words = self.words.findall(name)
        return words[: next((k for k, w in enumerate(words) if w in self.states), len(words))]

    def tags(self, text: str) -> Iterator[tuple[int, int, bool, str, list[tuple[str, str]], bool]]:
        """(start, end, whether it closes, name, attributes, whether it is empty) of each tag, the name blank for what is no text and no tag
        (comments, scripts).  One scan: a tag ends at the first ``>`` outside a value; where a tag would never end, this and all later ones
        end at the next ``>``."""
        at, plain = 0, False
        last = text.rfind(">")
        while (start := text.find("<", at)) >= 0:
            if text.startswith("<!--", start):
                end = text.find("-->", start + 2)  # <!--> is a whole comment
                at = len(text) if end < 0 else end + 3
                yield start, at, False, "", [], False
                continue
            if start > last:
                return
            if text.startswith(("<!", "<?"), start):
                at = text.find(">", start) + 1
                yield start, at, False, "", [], False
                continue
            if not (m := self.name.match(text, start)):
                at = start + 1
                continue
            tag, closes, attributes = m[1].lower(), text[start + 1] == "/", []
            pos, end = m.end(), -1
            if plain:
                end = text.find(">", pos)
            while (end < 0 or pos < end) and (a := self.attr.match(text, pos, end + 1 if end >= 0 else len(text))):
                pos = a.end()
                if a[1]:
                    end = pos - 1
                    break
                attributes.append((a[2].lower(), a[3] or a[4] or a[5] or ""))
            if end < 0:  # it never ends
                plain, end = True, text.find(">", m.end())
                attributes = []
            at = end + 1
            empty = text[end - 1] == "/"
            if not closes and not empty and tag in self.raw_end:
                close = self.raw_end[tag].search(text, at)
                at = (text.find(">", close.start()) + 1 or len(text)) if close else len(text)
                tag = ""
            yield start, at, closes, tag, attributes, empty

    def parse(self, text: str) -> tuple[list[tuple[str, str, float, bool]], dict[str, list[str]]]:
        """((path, text, weight of declared noise, declared content) of each block in page order; the tags of
        the children of each path).  Text of an inline element that is declared noise is no part of its block."""
        out: list[tuple[str, str, float, bool, str]] = []
        children: dict[str, list[str]] = {}
        # tag, path, noise, content, why: "form" where nothing but forms is the reason, "name" where a longer name is
        stack: list[tuple[str, str, float, bool, str]] = [("", "", 0.0, False, "")]
        open_: dict[str, int] = {}  # how many elements of each tag are on the stack
        held: list[tuple[str, float, str]] = []
        at = 0

        def leave(k: int) -> None:
            for s in stack[k:]:
                open_[s[0]] -= 1
            del stack[k:]

        def close_block() -> None:
            if held:
                _, path, noise, content, why = next(s for s in reversed(stack) if s[0] in self.blocks or not s[0])
                words = _html.unescape("".join(x for x, own, because in held if own > DECLARED or noise <= DECLARED and because == why)).split()
                held.clear()
                if words:
                    out.append((path, " ".join(words), noise, content, why))

        for start, end, closes, tag, attributes, empty in self.tags(text):
            if start > at:
                held.append((text[at:start], stack[-1][2], stack[-1][4]))
            at = end
            if not tag:
                continue
            if tag == "br":
                held.append((" ", 0.0, ""))
            if tag in self.blocks:
                close_block()
            if closes:
                for k in range(len(stack) - 1, 0, -1) if open_.get(tag) else ():
                    if stack[k][0] == tag:
                        if any(s[0] in self.blocks for s in stack[k:]):
                            close_block()
                        leave(k)
                        break
                continue
            if tag == "p" or tag == "li":  # these end an open one of their kind
                for k in range(len(stack) - 1, 0, -1) if open_.get(tag) else ():
                    if stack[k][0] == tag:
                        leave(k)
                        break
                    if stack[k][0] in self.blocks:
                        break
            if tag == "body":
                while len(stack) > 1 and stack[-1][0] != "html":
                    leave(len(stack) - 1)
            _, path, noise, content, why = stack[-1]
            own, reason = 0.0, ""
            first = ""
            for name, value in attributes:
                if name not in self.telling:
                    continue
                value = value.lower()
                if name in ("class", "id"):
                    parts = value.split()
                    if name == "class" and parts:
                        first = "." + parts[0]
                    if tag not in ("html", "body", "article", "main"):
                        if any(p in self.named for p in parts):
                            own, reason = DECLARED, "word"
                        elif words := self.named.intersection(*[[w for p in parts for w in self._said(p)]]):
                            titled = any(said and said[-1] in self.articles for said in map(self._said, parts))
                            weak = content or words == {"header"} or titled
                            own, reason = min((own, reason), (WORD if weak else DECLARED, "name"))
                elif (value in self.roles) if name == "role" else (name == "hidden" or value == "true"):
                    own, reason = DECLARED, "word"
            if tag in self.chrome or tag in self.silent or (tag == "header" and not content):
                own, reason = DECLARED, "form" if tag in self.forms and own > DECLARED else "word"
            # an article speaks for itself where only a form, or a longer name, says otherwise
            if tag in ("article", "main") and why in ("form", "name"):
                noise, why = 0.0, ""
            if own < noise or own == noise < 0 and reason == "word":
                noise, why = own, reason
            content = content or tag in ("article", "main")
            children.setdefault(path, []).append(tag)
            if len(stack) <= MOST_DEPTH:  # deeper than any real page: the tree is cut there, its elements are not
                path = f"{path}/{tag}{first}"
            if tag not in self.void and not empty:
                stack.append((tag, path, noise, content, why))
                open_[tag] = open_.get(tag, 0) + 1
        if at < len(text) and text.rfind("<", at) <= text.rfind(">"):
            held.append((text[at:], stack[-1][2], stack[-1][4]))
        elif at < len(text):  # a tag that the page ends in is no text
            cut = next((k for k in range(text.find("<", max(at, text.rfind(">") + 1)), len(text)) if text[k] == "<" and self.name.match(text, k)), len(text))
            held.append((text[at:cut], stack[-1][2], stack[-1][4]))
        close_block()
        # a form around most of the page's text is the page's frame
        free, framed = (sum(len(b[1]) for b in out if x(b)) for x in (lambda b: b[2] > DECLARED, lambda b: b[4] == "form"))
        return [(path, t, 0.0 if why == "form" and framed > free else noise, content) for path, t, noise, content, why in out], children


def _host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    html = F.coalesce("html", F.lit(""))
    return pages.select("page_id", "url", html.alias("html"), host.alias("host"), F.md5(F.concat_ws("\n", host, html).cast("binary")).alias("page"))


def nodes(pages: DataFrame) -> DataFrame:
    """(host, page, path, kind, h, copy): for each page (by a digest) its paths with the hash of their texts (kind ``c``) and of the layout around
    them (``p``); ``copy`` is the hash of the page's text apart from declared noise."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest as xxh

        parser = _Parser()
        for batch in batches:
            seen: set[tuple[str, str, str, str, int, int]] = set()
            for host, page, html in zip(*(batch.column(k) for k in range(3)), strict=True):
                host, page = host.as_py(), page.as_py()
                blocks, children = parser.parse(html.as_py())
                copy = xxh("\n".join(text for _, text, noise, _ in blocks if noise > DECLARED)) >> 1
                by_path: dict[str, list[str]] = {}
                for path, text, _, _ in blocks:
                    by_path.setdefault(path, []).append(text)
                for path, texts in by_path.items():
                    above = path.rpartition("/")[0]
                    seen.add((host, page, path, "c", xxh("\n".join(texts)) >> 1, copy))
                    seen.add((host, page, path, "p", xxh(" ".join(children.get(above, []))) >> 1, copy))
            if seen:
                host, page, path, kind, h, copy = zip(*seen, strict=True)
                yield pa.RecordBatch.from_arrays([*map(pa.array, (host, page, path, kind)), pa.array(h, pa.int64()), pa.array(copy, pa.int64())], names=["host", "page", "path", "kind", "h", "copy"])

    return _host(pages).select("host", "page", "html").mapInArrow(scan, "host string, page string, path string, kind string, h long, copy long")


def tree(nodes: DataFrame) -> DataFrame:
    """(host, path, kind, pages, entropy): the nodes of each host's style tree."""
    # copies differ in declared noise only: of such a path one text and one layout count
    once = nodes.groupBy("host", "path", "kind", "copy").agg(F.min("h").alias("h"))
    same = once.groupBy("host", "path", "kind", "h").agg(F.count("*").alias("n"))
    total = same.groupBy("host", "path", "kind").agg(F.sum("n").alias("pages"), F.sum(F.col("n") * F.log("n")).alias("s"))
    entropy = F.when(F.col("pages") > 1, (F.log("pages") - F.col("s") / F.col("pages")) / F.log("pages")).otherwise(1.0)
    return total.select("host", "path", "kind", "pages", entropy.alias("entropy"))


def low_paths(nodes: DataFrame, least: float = LEAST) -> DataFrame:
    """(page, low): for each page those of its own paths whose blocks may go though not ``DECLARED``, and their importance."""
    entropy = (F.col("pages") * F.col("entropy") + SMALL) / (F.col("pages") + SMALL)
    node = tree(nodes).groupBy("host", "path").agg(F.sum(F.when(F.col("kind") == "c", GAMMA).otherwise(1 - GAMMA) * entropy).alias("importance"))
    low = stage(node.filter(F.col("importance") < least - WORD), "low")  # staged, so that the pages of a hot host can be split
    own = nodes.filter("kind = 'c'").select("host", "path", "page").join(low, ["host", "path"])
    return own.groupBy("page").agg(F.collect_set(F.struct("path", "importance")).alias("low"))


def extract(pages: DataFrame, least: float = LEAST) -> DataFrame:
    """(page_id, url, text): the main text of every page, its blocks joined by an empty line."""
    low = stage(low_paths(stage(nodes(pages), "nodes"), least), "low-of-page")
    joined = _host(pages).join(low, "page", "left").select("page_id", "url", "html", "low")
    schema = T.StructType([pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _Parser()
        for batch in batches:
            texts = []
            for page, paths in zip(batch.column(2), batch.column(3).to_pylist(), strict=True):
                low = {x["path"]: x["importance"] for x in paths or ()}
                blocks, _ = parser.parse(page.as_py())
                texts.append("\n\n".join(text for path, text, noise, content in blocks if low.get(path, 1.0) + noise + CONTENT * (content and noise > DECLARED) >= least))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return joined.mapInArrow(scan, schema)
