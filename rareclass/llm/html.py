"""Main-text extraction with consensus host paths."""

from __future__ import annotations

import re
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, hinted, rename_clashes

# Element kinds and class words.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe template svg select option datalist object canvas audio video math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split())
NOISE_TAGS = frozenset("nav footer aside form button menu dialog".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsbygoogle adbox adslot banner sponsor sponsored sponsors promo promotion "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside widget widgets rail footer foot masthead topbar "
    "toolbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup "
    "login share sharing social related recommended recommendations comment comments commentlist disqus respond replies reply "
    "pagination pager search copyright legal header skip hidden teasers".split())
GOOD_WORDS = frozenset("article articlebody post entry content story main body text page".split())
# Words for what is never a page's text, however long, unless a good word stands beside them; replies only if other text is left.
NOTICE_WORDS = frozenset("cookie cookies consent gdpr notice notices alert popup modal overlay".split())
REPLY_WORDS = frozenset("comment comments commentlist disqus respond replies reply".split())
# Inside an article a class counts as noise only if these words, and good ones, are all that stands beside the noise word.
BOX_WORDS = frozenset(
    "area bar block box button buttons container inner item items link links list module outer panel posts results section slot "
    "unit wrap wrapper".split())
# What an article's own header says about the article, other than its text.
BYLINE_WORDS = frozenset("author authors byline category categories date dateline meta metadata tag tags time timestamp".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# A start tag closes these open elements first, up to the scope that follows.
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
          "td": ("td th", "tr table"), "th": ("td th", "tr table")}

# A path wins on a host if it has this share of the host's votes (so 256 paths at most); a page that has no winning path uses its
# own best container.
VOTE_SHARE = 1 / 256

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTR = re.compile(r"([^\s=\"'/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([^\s=\"'/>]+)", re.S)
_CLASS_WORD = re.compile(r"[a-z]+|[A-Z][a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_CUT_TAG = re.compile(r"<[a-zA-Z/!?][^>]*\Z", re.S)


class Page:
    """Blocks of text and the containers around them, from one tolerant walk over the tags.

    ``parent``, ``tag``, ``label`` and ``noise`` are per element; ``blocks`` holds ``(element, text, linked characters)``
    in page order, without what is noise whatever the container.
    """

    def __init__(self, source: str):
        self.parent, self.tag, self.label, self.noise, self.classed = [-1], ["html"], ["html"], [False], [False]
        self.words: list[set[str]] = [set()]
        self.in_article, self.header = [False], [False]
        self.blocks: list[tuple[int, str, int]] = []
        self._text: list[str] = []
        self._linked = 0
        self._paths: dict[int, str] = {}
        self._walk(source)
        self._settle()

    def _walk(self, source: str) -> None:
        stack, at, links = [0], 0, 0
        tail = _CUT_TAG.search(source, max(source.rfind("<"), 0))
        end = tail.start() if tail else len(source)
        while at < end:
            m = _TOKEN.search(source, at)
            if m is None or m.start() >= end:
                self._add(source[at:end], links)
                break
            if m.start() > at:
                self._add(source[at:m.start()], links)
            at = m.end()
            close, name = m[1], m[2] or m[4]
            if close:
                close = close.lower()
                if close == "br":
                    self._add(" ", links)
                    continue
                for i in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[i]] == close:
                        if close not in INLINE or any(self.tag[e] not in INLINE for e in stack[i:]):
                            self._flush(stack)
                        links -= sum(self.tag[e] == "a" for e in stack[i:])
                        del stack[i:]
                        break
                    if close in INLINE and self.tag[stack[i]] not in INLINE:
                        break  # a stray inline end does not close blocks
                continue
            if not name:
                continue
            name, rest = name.lower(), (m[3] if m[2] else m[5]) or ""
            if name == "br":
                self._add(" ", links)
                continue
            if name not in INLINE:
                self._flush(stack)
                stack = self._implied(name, stack)
                links = sum(self.tag[e] == "a" for e in stack)
            if name in VOID:
                continue
            if name in RAW:
                if not rest.rstrip().endswith("/"):
                    over = re.compile(rf"</{name}\b[^>]*>", re.I).search(source, at)
                    at = over.end() if over else end
                continue
            if name in ("html", "body") and name in (self.tag[e] for e in stack[1:] + [0] * (name == "html")):
                continue
            stack.append(self._element(name, rest, stack[-1]))
            links += name == "a"
        self._flush(stack)

    def _implied(self, name: str, stack: list[int]) -> list[int]:
        """The stack after the elements that a block's start tag ends: an open paragraph, the last list item or cell."""
        ends, scope = CLOSES.get(name, ("", ""))
        for i in range(len(stack) - 1, 0, -1):
            tag = self.tag[stack[i]]
            if tag == "p" or tag in ends.split():
                stack = stack[:i]
                if tag != "p":
                    break
            elif tag in scope.split() or (tag not in INLINE and not ends):
                break
        return stack

    def _element(self, name: str, rest: str, parent: int) -> int:
        noise, classed, label, words = name in NOISE_TAGS, False, name, set()
        within, header = self.in_article[parent], name == "header"
        if rest:
            got = {(k or bare).lower(): unescape(a or b or c or "") for k, a, b, c, bare in _ATTR.findall(rest)}
            classes = got.get("class", "")
            if classes:
                label += "." + _DIGITS.sub("#", ".".join(classes.lower().split()))
            words = {w.lower() for w in _CLASS_WORD.findall(f"{classes} {got.get('id', '')}")}
            classed = bool(words & NOISE_WORDS)
            if within and classed:
                names = [{w.lower() for w in _CLASS_WORD.findall(c)} for c in (*classes.split(), got.get("id", ""))]
                known = NOISE_WORDS | BOX_WORDS | GOOD_WORDS
                telling = [n & NOISE_WORDS for n in names if n <= known and n & NOISE_WORDS]
                classed = any(n != {"header"} for n in telling)
                header = header or (bool(telling) and not classed)
            noise = noise or got.get("role", "").lower() in NOISE_ROLES or "hidden" in got or got.get("aria-hidden") == "true" \
                or bool(_HIDDEN.search(got.get("style", "")))
        self.parent.append(parent)
        self.tag.append(name)
        self.label.append(label)
        self.noise.append(noise)
        self.words.append(words)
        self.classed.append(classed and name not in ("html", "body", "main"))
        self.in_article.append(within or name in ("article", "main"))
        self.header.append(self.header[parent] or header)
        return len(self.tag) - 1

    def _add(self, text: str, links: int) -> None:
        self._text.append(text)
        if links:
            self._linked += len(text)

    def _flush(self, stack: list[int]) -> None:
        if self._text:
            text = " ".join(unescape("".join(self._text)).split())
            if text:
                self.blocks.append((stack[-1], text, self._linked))
            self._text, self._linked = [], 0

    def _settle(self) -> None:
        """Spreads noise downwards.  A class word alone does not condemn what holds an article or most of the page's plain
        text; of a header only headings and paragraphs inside an article stay."""
        holds = [False] * len(self.tag)
        for e in range(len(self.tag) - 1, 0, -1):
            if holds[e] or self.tag[e] == "main" or (self.tag[e] == "article" and not self.classed[e]):
                holds[self.parent[e]] = True
        own, blocks = self.noise, self.blocks
        for always, share in ((NOTICE_WORDS | REPLY_WORDS, 0.5), (NOTICE_WORDS, 0.5), (NOTICE_WORDS, 0.0)):
            self.noise = self._spread(own, holds, blocks, always, share)
            self.blocks = [b for b in blocks if self._kept(b[0])]
            if any(len(text) > linked for _, text, linked in self.blocks):
                break

    def _spread(self, own: list[bool], holds: list[bool], blocks: list[tuple[int, str, int]], always: frozenset[str], share: float) -> list[bool]:
        """Noise with all below it.  Class words, other than ``always``, are ignored for an element that holds more than
        ``share`` of the plain text."""
        noise, firm = list(own), [False] * len(own)
        for e in range(1, len(own)):
            words = self.words[e]
            firm[e] = self.classed[e] and not holds[e] and bool(words & always) and not words & GOOD_WORDS
            noise[e] = noise[self.parent[e]] or own[e] or firm[e]
        plain = [0] * len(own)
        for e, text, linked in blocks:
            if not noise[e]:
                plain[e] += max(0, len(text) - linked)
        for e in range(len(own) - 1, 0, -1):
            plain[self.parent[e]] += plain[e]
        for e in range(1, len(own)):
            noise[e] = noise[self.parent[e]] or noise[e] or (self.classed[e] and not holds[e] and plain[e] <= share * plain[0])
        return noise

    def _kept(self, e: int) -> bool:
        if self.noise[e]:
            return False
        if not self.header[e]:
            return True
        while e and self.tag[e] in INLINE:
            e = self.parent[e]
        if not self.in_article[e] or not (self.tag[e] in HEADINGS or self.tag[e] in ("p", "blockquote")):
            return False
        while self.header[e]:
            if self.words[e] & BYLINE_WORDS:
                return False
            e = self.parent[e]
        return True

    def path(self, e: int) -> str:
        """Tags and generalised classes from the root to the element."""
        if e not in self._paths:
            labels, at = [], e
            while at >= 0:
                labels.append(self.label[at])
                at = self.parent[at]
            self._paths[e] = "/".join(reversed(labels))
        return self._paths[e]

    def container(self, e: int) -> int:
        """The element around the block that holds the text: the parent of a paragraph, heading or item."""
        while e and (self.tag[e] in INLINE or self.tag[e] in HEADINGS or self.tag[e] in ("p", "li", "blockquote", "pre", "td", "th", "dt", "dd", "tr",
                                                                                        "tbody", "thead", "table", "ul", "ol", "dl", "figure", "figcaption")):
            e = self.parent[e]
        return e

    def scores(self) -> dict[str, float]:
        """Score by container path: plain (unlinked) text of the blocks right inside, half for the container around it,
        more for article elements and telling classes."""
        by: dict[int, float] = {}
        for e, text, linked in self.blocks:
            plain = max(0, len(text) - linked)
            c = self.container(e)
            by[c] = by.get(c, 0.0) + plain
            if c:
                by[self.parent[c]] = by.get(self.parent[c], 0.0) + plain / 2
        out: dict[str, float] = {}
        for e, s in by.items():
            top = e  # the article that holds the container stands for it
            while top and self.tag[top] not in ("article", "main"):
                top = self.parent[top]
            e = top or e
            words = set(re.findall(r"[a-z]+", self.label[e].partition(".")[2]))
            bonus = 2.0 if self.tag[e] in ("article", "main") else 1.5 if words & GOOD_WORDS else 1.0
            out[self.path(e)] = max(out.get(self.path(e), 0.0), 0.0) + s * bonus
        return {p: s for p, s in out.items() if s > 0}

    def text_under(self, path: str) -> str:
        """The blocks inside all containers of that path, and what belongs to them, in page order.

        Text beside the containers belongs to them unless a class word marks it or most of it is links.  It is looked for
        in the whole page, for an article in the main element around it, and not at all if a class word marks the
        container.  An article without a first heading takes those outside any article.  A body that is a container itself
        gives its blocks by the same rule.
        """
        # parents come first; ``done`` counts the characters of ``path`` that the element's own path is, -1 if it is no start of it
        n = len(self.tag)
        done, inside = [-1] * n, [False] * n
        for e in range(n):
            p, label = self.parent[e], self.label[e] if e == 0 else f"/{self.label[e]}"
            at = 0 if e == 0 else done[p]
            if at >= 0 and path.startswith(label, at):
                done[e] = at + len(label)
            inside[e] = (e > 0 and inside[p]) or (done[e] == len(path) and self.tag[e] not in ("html", "body"))
        chosen = [e for e in range(n) if done[e] == len(path) and not self.noise[e]]
        if all(self.classed[e] for e in chosen):
            return "\n".join(t for e, t, _ in self.blocks if inside[e])
        article = any(self.in_article[e] for e in chosen)
        around = [False] * n  # holds a container
        for e in chosen:
            while e >= 0 and not around[e]:
                around[e], e = True, self.parent[e]
        main, marked, side = [False] * n, [False] * n, list(range(n))
        for e in range(1, n):
            p = self.parent[e]
            main[e] = main[p] or (self.tag[e] == "main" and around[e])
            if not around[e]:
                marked[e] = marked[p] or self.classed[e]
                side[e] = e if around[p] else side[p]
        size: dict[int, list[int]] = {}
        for e, text, linked in self.blocks:
            if not around[e]:
                both = size.setdefault(side[e], [0, 0])
                both[0] += len(text)
                both[1] += min(linked, len(text))
        titled = any(inside[e] and "h1" in self._line(e) for e, _, _ in self.blocks)

        def belongs(e: int, text: str, linked: int) -> bool:
            if inside[e]:
                return True
            if marked[e] or (article and not main[e] and (titled or self.in_article[e] or "h1" not in self._line(e))):
                return False
            line = self._line(e)[-1]
            chars, links = (len(text), linked) if around[e] else size[side[e]]
            return 2 * links < chars or (e != 0 and line in ("p", "blockquote", *HEADINGS) and around[self.parent[side[e]]] and self.tag[side[e]] == line)

        return "\n".join(t for e, t, linked in self.blocks if belongs(e, t, linked))

    def _line(self, e: int) -> list[str]:
        """The tags from inline markup up to the block's own element."""
        tags = [self.tag[e]]
        while e and self.tag[e] in INLINE:
            e = self.parent[e]
            tags.append(self.tag[e])
        return tags


def page_votes(source: str | None) -> list[tuple[str, float]]:
    """The page's containers with their share of the best score."""
    scores = Page(source or "").scores()
    best = max(scores.values(), default=0.0)
    return [(p, s / best) for p, s in sorted(scores.items()) if s >= best / 4]


def page_text(source: str | None, paths: list[str]) -> str:
    """Text under the first of the host's paths that carries at least half of what the page's own best container
    scores; under that container if none does."""
    page = Page(source or "")
    scores = page.scores()
    if not scores:
        return ""
    best = max(scores.values())
    for p in paths:
        if scores.get(p, 0.0) >= best / 2:
            return page.text_under(p)
    return page.text_under(min(p for p, s in scores.items() if s == best))


def extract_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, path_votes`` for every page.

    First walk: each page scores its containers, and its paths vote in its host's election (votes are summed by Spark,
    combined map-side, so a host with a third of all pages is no hot spot).  Second walk: each page is read again with
    its host's winning paths.  Null and empty pages, and pages of notices only, give an empty text; a null or odd url
    is a host of its own; repeated rows come back as often; an empty table gives no row; other columns are not read.
    """
    base = rename_clashes(pages, [key, url, html]).toDF("page_id", "url", "html")
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))

    @F.pandas_udf("array<struct<path:string,share:double>>")
    def votes(sources: pd.Series) -> pd.Series:
        return pd.Series([[{"path": p, "share": s} for p, s in page_votes(x)] for x in sources])

    @F.pandas_udf("string")
    def text(sources: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([page_text(x, [] if p is None else list(p)) for x, p in zip(sources, paths)], dtype="object")

    ballots = base.select(host.alias("host"), F.explode(votes("html")).alias("v")).select("host", "v.*")
    counted = ballots.groupBy("host", "path").agg(F.round(F.sum("share"), 6).alias("votes"))
    totals = counted.groupBy("host").agg(F.sum("votes").alias("host_votes")).withColumnRenamed("host", "all_of")
    elected = counted.join(totals, F.col("host") == F.col("all_of")).where(F.col("votes") >= F.col("host_votes") * VOTE_SHARE)
    place = F.row_number().over(Window.partitionBy("host").orderBy(F.col("votes").desc(), "path"))
    winners = cut_lineage(
        elected.withColumn("place", place)
        .groupBy("host").agg(F.sort_array(F.collect_list(F.struct("place", "path", "votes"))).alias("w"))
        .select(F.col("host").alias("won_host"), F.col("w.path").alias("paths"), F.col("w.votes").alias("path_votes"))
    )
    size = winners.agg(F.count(F.lit(1)).alias("n"), F.max(F.length(F.array_join("paths", ""))).alias("w")).first()
    with_paths = base.withColumn("host", host).join(hinted(winners, size["n"], (size["w"] or 0) * 3 + 100), F.col("host") == F.col("won_host"), "left")
    return with_paths.select("page_id", "url", text("html", "paths").alias("text"), "path_votes")


def extract_digest(pages: DataFrame) -> DataFrame:
    """The contract's columns."""
    return extract_pages(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
