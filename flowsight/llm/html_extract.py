"""HTML extraction by consensus paths of a host.

Every page is parsed once into blocks of text, each with the generalised tag-class path of the container
it stands in, and votes for the path of its best container. The votes are counted for each host in Spark,
and the pages are extracted again with the path that won: the blocks at or below it, in page order.
A page without such a container, or with much less text in it, falls back to its own best one. The pages of
hosts with more than a task's share are salted for the join, so that a host with a third of all pages fills no task.

Menus, footers and hidden elements go by their tag. Containers that only a class word or a form tag speaks against
are judged when the page is read: where no article or main stands outside of them, they stay if most of the page's
text is in them, or a fair part of it with an article's sign (main, article, h1), so a layout with such a word
in its name keeps its article.

Defined results: null or empty html, and pages without text, give an empty text; a null url is a host of
its own; repeated rows give equal results; other columns play no part. Of paths with equal
votes the one with more text wins, then the smaller string. A `<br>` is white space. Pages of any length and of broken markup are read in one forward scan; elements
nested deeper than `DEEPEST` open no level of their own, paths have at most `LONGEST_PATH` steps.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, shuffle_partitions, written

_SKIPPED = (
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|title|textarea|noscript|template|iframe|svg|math|select|button|object)\b[^>]*>"
    r".*?(?:</\1\s*>|\Z)"
)
_QUOTED = r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
_PLAIN = r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
TOKEN = re.compile(_SKIPPED + _QUOTED + _PLAIN + r"|<[!?/][^>]*>", re.S | re.I)
UNQUOTED = re.compile(_SKIPPED + _PLAIN + r"|<[!?/][^>]*>", re.S | re.I)
CLOSED = re.compile(r"</[a-zA-Z]+\s*>\Z|-->\Z")
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
CONTAINERS = frozenset("div section article main td center blockquote figure".split())
BLOCKS = CONTAINERS | frozenset(
    """address aside body caption dd details dialog dl dt fieldset figcaption footer form h1 h2 h3 h4 h5 h6
    head header hgroup hr html legend li menu nav ol p pre summary table tbody tfoot th thead tr ul""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "abbr acronym b bdi bdo big cite code dfn em font i ins kbd mark q s samp small strike strong sub sup tt u var".split()
)
DROPPED_TAGS = frozenset("nav footer aside form menu dialog".split())
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
)
DROPPED_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner
    sidebar sidebars aside menu menus nav navbar navigation topbar breadcrumb breadcrumbs masthead
    footer foot comment comments disqus respond replies notice notices cookie cookies consent gdpr
    popup modal overlay newsletter subscribe subscription signup login share sharing social related
    recommended recommendations pagination pager widget widgets toolbar copyright disclaimer form search""".split()
)
HEADER_WORDS = frozenset(["header", "head"])
# Readers' words: a container of these is no article however long it is.
READER_WORDS = frozenset("comment comments disqus respond replies".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLE_SIGNS = frozenset("main article h1".split())
# A container that its name rules out stays if it holds this share of the page's text, or with an article's sign this one.
MOST, WITH_SIGN = 0.6, 0.25
# The host's path gives way to the page's own vote where it holds less than this share of the vote's text.
MUCH_LESS = 0.25
DEEPEST = 512
LONGEST_PATH = 48
KEPT_TAGS = frozenset("article main body html".split())
WORDS = re.compile("[a-z]+")
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("ul ol dl table body div section article main".split())
HOST = re.compile(r"^[^:/?#]*:?//(?:[^/?#@]*@)?([^/?#:]*)")


def _label(tag: str, classes: str) -> str:
    """The tag with its classes, digits generalised."""
    names = sorted({re.sub(r"\d+", "#", c) for c in classes.lower().split()})
    return ".".join([tag, *names])


class _Suspect:
    """A container that its name or tag rules out unless the article stands in it."""

    def __init__(self, readers: bool) -> None:
        self.readers, self.sign, self.size = readers, False, 0

    def meets(self, tag: str) -> None:
        self.sign = self.sign or tag != "article" or not self.readers  # readers' words may be articles of theirs

    def stays(self, total: int) -> bool:
        return self.size >= WITH_SIGN * total if self.sign else not self.readers and self.size >= MOST * total


class _Page:
    """The blocks of a page, as (container path, text, characters outside links)."""

    def __init__(self) -> None:
        self.found: list[tuple[str, str, int, tuple[_Suspect, ...], bool]] = []
        # tag, path, steps of the path, hidden for good, suspects around
        self.stack: list[tuple[str, str, int, bool, tuple[_Suspect, ...]]] = []
        self.text: list[str] = []
        self.linked = 0
        self.in_link = False
        self.outside = False  # whether an article or main stands outside of all suspects

    def _top(self) -> tuple[str, str, int, bool, tuple[_Suspect, ...]]:
        return self.stack[-1] if self.stack else ("", "body", 1, False, ())

    def flush(self) -> None:
        if self.text:
            text = " ".join(entities.unescape("".join(self.text)).split())
            _, path, _, hidden, suspects = self._top()
            if text and not hidden:
                size = max(0, len(text) - self.linked)
                for s in suspects:
                    s.size += size
                title = any(tag in ("h1", "h2") for tag, *_ in self.stack[-2:])
                self.found.append((path, text, size, suspects, title))
            self.text, self.linked = [], 0
        self.in_link = False

    def blocks(self) -> tuple[list[tuple[str, str, int]], set[str]]:
        """The blocks of containers that stay, and the paths with a title in them."""
        total = sum(size for _, _, size, _, _ in self.found)
        kept = [b for b in self.found if not b[3] or not self.outside and all(s.stays(total) for s in b[3])]
        return [(path, text, size) for path, text, size, _, _ in kept], {b[0] for b in kept if b[4]}

    def add(self, text: str) -> None:
        if not self._top()[3]:
            self.text.append(text)
            if self.in_link:
                self.linked += len(text)

    def open(self, tag: str, attributes: str) -> None:
        if tag in INLINE:
            return
        if tag in BLOCKS:
            self.flush()
            self._imply(("p",), BLOCKS - {"p"})
            if tag in CLOSES:
                self._imply(CLOSES[tag], SCOPE)
        if tag == "br":
            self.text.append(" ")
        if tag in VOID or tag in ("html", "body") or len(self.stack) >= DEEPEST:
            return
        if tag == "a":
            self.in_link = True
        found = dict((k.lower(), (v or "").strip("\"'")) for k, v in ATTRIBUTE.findall(attributes)) if attributes else {}
        _, path, steps, hidden, suspects = self._top()
        if tag in ARTICLE_SIGNS:
            for s in suspects:
                s.meets(tag)
            self.outside = self.outside or not (hidden or suspects or tag == "h1")
        if not hidden and tag not in KEPT_TAGS:
            names = set(WORDS.findall(f"{found.get('class', '')} {found.get('id', '')}".lower()))
            hidden = (
                (tag in DROPPED_TAGS and tag != "form")
                or found.get("role", "").lower() in DROPPED_ROLES - {"form"}
                or "hidden" in found
                or "display:none" in found.get("style", "").replace(" ", "").lower()
                or (tag == "header" and not self._in_article())
            )
            head = tag not in HEADINGS and not names.isdisjoint(HEADER_WORDS) and not self._in_article()
            suspect = tag == "form" or found.get("role", "").lower() == "form" or not names.isdisjoint(DROPPED_WORDS) or head
            if suspect and not hidden:
                if tag in BLOCKS:
                    suspects = (*suspects, _Suspect(not names.isdisjoint(READER_WORDS)))
                else:
                    hidden = True
            if hidden and tag not in BLOCKS:
                self.text.append(" ")
        if tag in CONTAINERS and steps < LONGEST_PATH:
            path, steps = f"{path}>{_label(tag, found.get('class', ''))}", steps + 1
        self.stack.append((tag, path, steps, hidden, suspects))

    def _in_article(self) -> bool:
        return any(tag in ("article", "main") for tag, *_ in self.stack)

    def _imply(self, tags: tuple[str, ...], scope: frozenset) -> None:
        """Closes an open element of `tags` unless one of `scope` was opened inside it."""
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] in tags:
                del self.stack[k:]
                return
            if self.stack[k][0] in scope:
                return

    def close(self, tag: str) -> None:
        if tag in INLINE or tag in VOID:
            return
        if tag in BLOCKS:
            self.flush()
        if tag == "a":
            self.in_link = False
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                del self.stack[k:]
                return
            if tag not in BLOCKS and self.stack[k][0] in BLOCKS:
                return


def _tokens(source: str) -> Iterator[re.Match]:
    """Comments and tags in one forward scan; each ends at or before the page's last `>`.

    When a tag's quotes leave it without an end, no later tag's quotes are read.
    """
    end, at, pattern = source.rfind(">") + 1, 0, TOKEN
    while found := pattern.search(source, at, end):
        yield found
        at = found.end()
        if pattern is TOKEN and found[6]:
            pattern = UNQUOTED


def parsed_page(source: str) -> tuple[list[tuple[str, str, int]], set[str]]:
    """(blocks, paths with a title)."""
    page, at = _Page(), 0
    for m in _tokens(source):
        if m.start() > at:
            page.add(source[at : m.start()])
        at = m.end()
        if m.re is UNQUOTED:
            slash, tag, rest = m[2], m[3], m[4]
        else:
            slash, tag, rest = (m[2], m[3], m[4]) if m[3] else (m[5], m[6], m[7])
        if not tag:
            if m[1] and m[1].lower() in ("title", "button", "select"):
                page.text.append(" ")
            if (m[1] or m[0].startswith("<!--")) and not CLOSED.search(m[0]):
                at = len(source)  # never closed: nothing of the page is left
            continue
        if slash:
            page.close(tag.lower())
        else:
            page.open(tag.lower(), rest)
            if rest.endswith("/") and tag.lower() not in BLOCKS:
                page.close(tag.lower())
    page.add(source[at:].split("<!--", 1)[0])
    page.flush()
    return page.blocks()


def page_blocks(source: str) -> list[tuple[str, str, int]]:
    return parsed_page(source)[0]


def is_under(path: str, top: str) -> bool:
    return path == top or path.startswith(f"{top}>")


def best_container(
    blocks: list[tuple[str, str, int]], titles: set[str] = frozenset()
) -> tuple[str | None, int]:
    """The path with most direct text outside links, raised to where the article is whole.

    It climbs to an enclosing article or main, past parents that add at least a tenth of its text, and to
    a parent that adds the title it lacks.
    """
    direct: dict[str, int] = {}
    for path, _, size in blocks:
        direct[path] = direct.get(path, 0) + size
    if not direct:
        return None, 0
    top = max(direct, key=lambda p: (direct[p], -len(p)))
    size = direct[top]
    steps = top.split(">")
    for k, step in enumerate(steps):
        if step.split(".")[0] in ("article", "main"):
            return ">".join(steps[: k + 1]), size
    while ">" in top:
        parent = top.rpartition(">")[0]
        titled = any(is_under(t, top) for t in titles)
        adds_title = not titled and any(is_under(t, parent) for t in titles)
        if parent == "body" or not (adds_title or direct.get(parent, 0) * 10 >= size):
            break
        top = parent
    return top, size


def host_of(url: str | None) -> str:
    found = HOST.match(url or "")
    return found[1].lower() if found else ""


def parsed_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, host, vote, size, blocks array<struct<path, text>>."""
    rows = pages.select(
        pages["page_id"].cast("long").alias("page_id"),
        pages["url"].cast("string").alias("url"),
        F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html"),
    )

    def work(batch: pa.RecordBatch):
        votes, sizes, blocks = [], [], []
        for source in batch.column(2).to_pylist():
            found, titles = parsed_page(source)
            vote, size = best_container(found, titles)
            votes.append(vote)
            sizes.append(size)
            blocks.append([{"path": path, "text": text} for path, text, _ in found])
        yield {
            "page_id": batch.column(0),
            "url": batch.column(1),
            "host": [host_of(url) for url in batch.column(1).to_pylist()],
            "vote": votes,
            "size": sizes,
            "blocks": blocks,
        }

    return arrow_map(
        rows,
        work,
        "page_id long, url string, host string, vote string, size long, "
        "blocks array<struct<path: string, text: string>>",
    )


def winning_paths(parsed: DataFrame) -> DataFrame:
    """(host, winner, voters): the container path that most pages of the host voted for."""
    votes = parsed.filter(F.col("vote").isNotNull()).groupBy("host", "vote")
    counted = votes.agg(F.count("*").alias("pages"), F.sum("size").alias("size"))
    rank = F.struct(F.col("pages"), F.col("size"), F.col("vote"))
    same = counted.groupBy("host", "pages", "size").agg(F.min("vote").alias("vote"), F.count("*").alias("ties"))
    return same.groupBy("host").agg(
        F.max_by("vote", rank).alias("winner"), F.sum(F.col("pages") * F.col("ties")).alias("voters")
    )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars. Parses twice rather than keep the blocks of all pages on disk."""
    parsed = parsed_pages(pages)
    hosts = written(winning_paths(parsed), "host-paths")
    n = shuffle_partitions(pages.sparkSession)
    # hosts with more pages than a task's share: fewer than n of them
    total = hosts.agg(F.sum("voters").alias("n")).first()["n"] or 0
    hot = [r["host"] for r in hosts.filter(F.col("voters") * n > total).select("host").collect()]
    salts = F.when(F.col("host").isin(hot), F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(0)))
    winners = hosts.select(F.col("host").alias("of_host"), "winner", F.explode(salts).alias("of_salt"))
    salt = F.when(F.col("host").isin(hot), F.pmod(F.xxhash64("page_id", "url"), F.lit(n)).cast("int")).otherwise(0)
    joined = parsed.withColumn("salt", salt).join(
        winners, (F.col("host") == F.col("of_host")) & (F.col("salt") == F.col("of_salt")), "left"
    )

    def under(path: str):
        top = F.col(path)
        inside = lambda b: (b["path"] == top) | b["path"].startswith(F.concat(top, F.lit(">")))
        return F.coalesce(F.filter("blocks", inside), F.array())

    def amount(column: str):
        return F.aggregate(column, F.lit(0), lambda n, b: n + F.length(b["text"]))

    chosen = joined.withColumns({"voted": under("winner"), "own": under("vote")})
    whole = amount("voted") >= MUCH_LESS * amount("own")
    chosen = chosen.withColumn("voted", F.when((F.size("voted") > 0) & whole, F.col("voted")).otherwise(F.col("own")))
    text = F.array_join(F.transform("voted", lambda b: b["text"]), "\n")
    return chosen.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
