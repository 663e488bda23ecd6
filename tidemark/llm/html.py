"""Main text of web pages by consensus of the paths on a host.

Each page scores its containers by the plain text they hold and votes for the generalised
tag-class path of the best one. Spark counts the votes per host. Pages are then read again: the
text comes from the elements on the host's winning path, on the next path when a page lacks it,
and from the page's own best container when it has none of them.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import slices, small_batches, unused, written

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What is inside is not text of the page. Never closed, those of _TO_END reach to its end; the tags of the others are ignored.
_TO_END = frozenset("script style textarea title".split())
_RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in "script style noscript template iframe textarea select title object svg canvas audio video".split()}
_BLOCKS = frozenset(
    "html body address article aside blockquote button caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr legend li main menu nav ol optgroup option p pre search section summary table tbody td "
    "tfoot th thead tr ul".split()
)
#: Opening the key closes an open element of the value, up to a list or table around it.
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
_KEEPS_P = frozenset("button td th caption".split())
_SCOPE = frozenset("ul ol dl table select".split())
#: Elements and roles of what isn't the article, and words in class or id that speak for it.
_ASIDE_TAGS = frozenset("nav header footer aside form menu dialog button search head fieldset label".split())
_ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
_ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar sidebars aside footer header masthead topbar cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup login toolbar".split()
)
#: Readers' comments are no article however long they are.
_COMMENT_WORDS = frozenset("comment comments disqus respond commentlist".split())
#: Words of articles too: what they name is left out if it is mostly links.
_WEAK_WORDS = frozenset("widget widgets register reply replies share sharing social related recommended pagination pager form search".split())
#: Elements that may hold a whole page.
_WRAPPING_TAGS = frozenset("form fieldset label".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_MAIN = frozenset(("article", "main"))
_ROOTS = frozenset(("#", "html", "body"))
#: Below the body, these are parts of the page; anything else is text of the body itself.
_PARTS = frozenset("div section center".split())
_DIGITS = re.compile(r"\d+")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_LEAST_SHARE = 0.7
_NONE, _WEAK, _DOUBTFUL, _OWN_HEADER, _FIRM = range(5)


class Page:
    """Elements in page order, and blocks of text with the element that holds each."""

    def __init__(self, source: str):
        self.parent, self.tag, self.path = [-1], ["#"], [""]
        self.sign = [_NONE]  # how sure it is that an element isn't the article
        self.aside = [False]
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters outside links
        self._read(source)
        self._settle()

    def _read(self, source: str) -> None:
        stack, buffer, links, plain = [0], [], 0, 0
        at, end = 0, len(source)

        def close_block() -> None:
            nonlocal buffer, plain
            if buffer:
                text = "".join(buffer)
                text = " ".join((entities.unescape(text) if "&" in text else text).split())
                if text:
                    self.blocks.append((stack[-1], text, plain))
                buffer, plain = [], 0

        while at < end:
            found = _TAG.search(source, at)
            stop = found.start() if found else end
            if stop > at:
                buffer.append(source[at:stop])
                if not links:
                    plain += stop - at
            if not found:
                break
            at = found.end()
            name = found[2] or found[5]
            if name is None:
                continue
            name, closing, attributes = name.lower(), found[1] or found[4], found[3] or found[6] or ""
            if name in _BLOCKS:
                close_block()
            elif name in ("br", "img"):
                buffer.append(" ")
            if closing:
                if name == "a":
                    links = max(0, links - 1)
                for k in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[k]] == name:
                        if name not in _BLOCKS and any(self.tag[x] in _BLOCKS for x in stack[k + 1 :]):
                            break  # an inline end tag doesn't close blocks
                        del stack[k:]
                        break
                    if self.tag[stack[k]] in _SCOPE and name in _CLOSES:
                        break
                continue
            if name in _RAW:
                if not attributes.endswith("/"):
                    over = _RAW[name].search(source, at)
                    at = over.end() if over else end if name in _TO_END else at
                continue
            if name in _VOID:
                continue
            self._close_implied(stack, name)
            self._open(stack, name, attributes)
            if name == "a":
                links += 1
            if attributes.endswith("/") and name not in _BLOCKS:
                stack.pop()
                links -= name == "a"
        close_block()

    def _close_implied(self, stack: list[int], name: str) -> None:
        if name in _BLOCKS:
            for k in range(len(stack) - 1, 0, -1):
                tag = self.tag[stack[k]]
                if tag == "p":
                    del stack[k:]
                    break
                if tag in _KEEPS_P or (tag in _BLOCKS and tag != "p"):
                    break
        for k in range(len(stack) - 1, 0, -1):
            tag = self.tag[stack[k]]
            if tag in _CLOSES.get(name, ()):
                del stack[k:]
                if name not in ("tr", "tbody", "tfoot"):
                    break
            elif tag in _SCOPE:
                break

    def _open(self, stack: list[int], name: str, attributes: str) -> None:
        if name not in _BLOCKS:
            # inline elements matter only for the stack; they share the place of the block around them
            self.parent.append(stack[-1])
            self.tag.append(name)
            self.path.append(self.path[stack[-1]])
            self.sign.append(_NONE)
            stack.append(len(self.tag) - 1)
            return
        own = {}
        if attributes.strip(" /"):
            for key, *values in _ATTRIBUTE.findall(attributes):
                own.setdefault(key.lower(), next((v for v in values if v), ""))
        sign = _FIRM if own.get("role", "").lower() in _ASIDE_ROLES or (name in _ASIDE_TAGS and name not in _WRAPPING_TAGS) else _NONE
        if sign == _NONE and name not in ("html", "body"):
            sign = max([_DOUBTFUL if name in _WRAPPING_TAGS else _NONE, *(self._said(n) for key in ("class", "id") for n in own.get(key, "").split())])
        classes = sorted({_DIGITS.sub("#", c) for c in own.get("class", "").split()})
        self.parent.append(stack[-1])
        self.tag.append(name)
        self.path.append(self.path[stack[-1]] + ">" + ".".join([name, *classes]))
        self.sign.append(_NONE if name in _MAIN else sign)
        stack.append(len(self.tag) - 1)

    @staticmethod
    def _said(name: str) -> int:
        """What a class or id says: its words count if they are half of it at least."""
        words = [w.lower() for w in _WORDS.findall(name)]
        for known, sign in ((_COMMENT_WORDS, _FIRM), (_ASIDE_WORDS, _DOUBTFUL), (_WEAK_WORDS, _WEAK)):
            if words and 2 * sum(w in known for w in words) >= len(words):
                return sign
        return _NONE

    def _settle(self) -> None:
        """Decide what isn't the article.

        What holds an article or the main part is a wrapper, whatever it is called. On a page with
        neither, what holds most of the plain text is no aside, unless an element or a role says so.
        Weak words count only where most of the text is links. Of an article's own header the headings stay.
        """
        inside = [False] * len(self.tag)
        for k, tag in enumerate(self.tag):
            inside[k] = tag in _MAIN or (k > 0 and inside[self.parent[k]])
            if tag in _MAIN:
                up = self.parent[k]
                while up > 0 and not (self.tag[up] in _ASIDE_TAGS and self.tag[up] != "form"):
                    self.sign[up] = _NONE
                    up = self.parent[up]
        plain, total = [0] * len(self.tag), [0] * len(self.tag)
        for element, text, own in self.blocks:
            plain[element] += min(own, len(text))
            total[element] += len(text)
        for k in range(len(self.tag) - 1, 0, -1):
            plain[self.parent[k]] += plain[k]
            total[self.parent[k]] += total[k]
        whole = not any(inside)
        state = [_NONE] * len(self.tag)
        for k in range(1, len(self.tag)):
            sign, above = self.sign[k], state[self.parent[k]]
            if sign == _WEAK:
                sign = _NONE if 2 * plain[k] >= total[k] else _FIRM
            elif sign == _DOUBTFUL:
                sign = _NONE if whole and 2 * plain[k] > plain[0] else _FIRM
            elif self.tag[k] == "header" and inside[k]:
                sign = _OWN_HEADER
            state[k] = _NONE if above == _OWN_HEADER and sign == _NONE and self.tag[k] in _HEADINGS else max(sign, above)
        self.aside = [s != _NONE for s in state]

    def best(self) -> int:
        """The article or main part, else the outermost container, around the deepest element with most of the plain text.

        The body itself is taken if it has headings, paragraphs, lists or bare text beside the container.
        """
        held = [0] * len(self.tag)
        for element, _, plain in self.blocks:
            if not self.aside[element]:
                held[element] += plain
        for k in range(len(held) - 1, 0, -1):
            held[self.parent[k]] += held[k]
        if not held[0]:
            return 0
        # elements come in page order, so the last one with enough text is the deepest
        chosen = max(k for k, n in enumerate(held) if n >= _LEAST_SHARE * held[0] and self._holds(k))
        around = [chosen]
        while around[-1] > 0:
            around.append(self.parent[around[-1]])
        mains = [k for k in around if self.tag[k] in _MAIN]
        if mains:
            return mains[-1]
        # headings and sibling sections stand beside the dense element, so what holds them is its container
        inner = [k for k in around if self.tag[k] in _BLOCKS and self.tag[k] not in _ROOTS]
        if not inner:
            return chosen
        top = next(k for k in around[around.index(inner[-1]) :] if self.tag[k] in _ROOTS)
        return top if any(not self.aside[k] and self._own(k, top) for k, _, _ in self.blocks) else inner[-1]

    def _own(self, k: int, top: int) -> bool:
        """Whether the text of ``k`` is in ``top`` and in no part of it."""
        while k > top:
            if self.tag[k] in _PARTS:
                return False
            k = self.parent[k]
        return k == top

    def _holds(self, k: int) -> bool:
        return k == 0 or (self.tag[k] in _BLOCKS and self.tag[k] not in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "pre", "blockquote"))

    def text(self, paths: list[str]) -> str:
        """The blocks on the first of ``paths`` that the page has text on, else those of its best element."""
        for path in paths:
            found = self._inside({k for k, own in enumerate(self.path) if own == path and self.tag[k] in _BLOCKS})
            if found:
                return found
        return self._inside({self.best()})

    def _inside(self, roots: set[int]) -> str:
        inside = [False] * len(self.tag)
        for k in range(len(self.tag)):
            inside[k] = k in roots or (k > 0 and inside[self.parent[k]])
        return "\n".join(text for element, text, _ in self.blocks if inside[element] and not self.aside[element])


def host(url: Column) -> Column:
    """Lower-case host of a URL; empty for null or none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "html"):
            paths = []
            for source in batch.column("html").to_pylist():
                page = Page(source or "")
                paths.append(page.path[page.best()] if page.blocks else "")
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(paths, pa.string())], ["host", "path"])


def host_paths(pages: DataFrame) -> DataFrame:
    """``(host, paths)`` from ``(host, html)``: the paths that win a hundredth of a host's votes, best first.

    Votes are counted per task before the shuffle, so a host with a third of all pages is no load.
    """
    votes = written(pages.mapInArrow(_votes, "host string, path string").where("path <> ''").groupBy("host", "path").agg(F.count("*").alias("n")), "votes")
    total = votes.groupBy("host").agg(F.sum("n").alias("total"))
    won = votes.join(total, "host").where("100 * n >= total")
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("less"), "path")))
    return written(won.groupBy("host").agg(F.transform(ranked, lambda r: r["path"]).alias("paths")), "host-paths")


def extract(pages: DataFrame, html_col: str = "html", url_col: str = "url", out: str = "text") -> DataFrame:
    """``pages`` with the main text, in column ``out``.

    Blocks have their character references decoded and their white space (that of Unicode) turned
    into one blank; they are joined by a newline. A line break in a block is white space. Null or
    empty HTML, and a page of nothing but asides, give an empty text. Unclosed, crossing and
    unknown tags are read as a browser roughly would. Repeated rows each get the same text; null
    URLs count as one host. An empty table gives no rows.
    """
    small_batches(pages.sparkSession)
    names = pages.columns
    at, paths, out = unused(names, "_host"), unused(names, "_paths"), unused(names, out)
    rows = pages.withColumn(at, host(F.col(url_col)))
    winners = host_paths(rows.select(F.col(at).alias("host"), F.col(html_col).alias("html")))
    w = winners.select(F.col("host").alias(unused([*names, at], "_w")), F.col("paths").alias(paths))
    joined = rows.join(w, F.col(at) == F.col(w.columns[0]), "left").select(*names, paths)
    schema = pages.withColumn(out, F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, html_col):
                pairs = zip(batch.column(html_col).to_pylist(), batch.column(paths).to_pylist(), strict=True)
                texts = [Page(source or "").text(own or []) for source, own in pairs]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(texts, pa.string())], [*names, out])

    return joined.mapInArrow(run, schema)
