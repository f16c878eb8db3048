"""Main text of web pages by paths that the pages of a host agree on."""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.llm.common import checkpointed, quoted, without

ADDED = ("text", "n_chars")
# A table of at most this many hosts is broadcast; a host has at most a few short paths.
BROADCAST_HOSTS = 50_000

# HTML element names by their part in a page.
CONTAINERS = frozenset("article blockquote body center details div dl fieldset figure html li main ol section table tbody td tr ul".split())
BREAKS = CONTAINERS | frozenset("address caption dd dt figcaption h1 h2 h3 h4 h5 h6 hr p pre summary tfoot th thead".split())
LEFT_OUT = frozenset("aside audio button canvas dialog footer form head header iframe input label legend map menu nav noscript object "
                     "option select svg template textarea title video".split())
RAW = frozenset("script style".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words in class, id and role that mark what is not the article.
ASIDE_WORDS = frozenset("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies "
                        "disqus footer header login masthead menu modal nav navbar navigation newsletter notice notices popup promo "
                        "promotion related replies respond share sharing sidebar signup social sponsor sponsored subscribe toolbar "
                        "widget".split())
# Of these, the ones whose containers often hold articles that are not the page's own.
LIST_WORDS = frozenset("comment comments disqus promo promotion related replies respond sidebar widget".split())
# Words that make a class name tell a state of the page, such as has-sidebar or comment-status-open.
STATE_FIRST = frozenset("has hide is no not show with without".split())
STATE_LATER = frozenset("closed disabled enabled off on open status".split())
# Words that make a header part of the article, such as post-header.
ARTICLE_WORDS = frozenset("article content entry post story".split())
# What wraps a page by mistake or habit gives way to an article inside it.
YIELDING = frozenset("form header nav".split())
# Why an element is left out: it gives way to any article, to the first one, to none.
SOFT, MARKED, FIRM = 1, 2, 3
ROOTS = ("article", "main")
HEADINGS = frozenset("h1 h2 h3".split())
# An opening tag that may stand without the closing tag of the one before it: what it closes, and what stops it.
IMPLIED = {
    "li": (("li",), ("ul", "ol")),
    "td": (("td",), ("tr", "tbody", "table")),
    "tr": (("tr", "td"), ("tbody", "table")),
    "tbody": (("tbody", "tr", "td"), ("table",)),
}
# A path is the last steps to a container, so that deep nesting costs no more than its depth.
PATH_STEPS = 12

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_TAG_END = re.compile(r"""(?:[^>"']|"[^"]*"|'[^']*')*+>""")
_LABEL = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>|\Z", re.IGNORECASE) for name in RAW}
_DIGITS = re.compile(r"\d+")


def tags(source):
    """``(text before, closing, name, attributes)`` of each tag, and last the text behind all, without name.

    Reads on from where it is, never twice: behind the last ``>`` all is text, and once
    quotes have been found not to match up to the end, later tags end at their first ``>``.
    """
    at = text_from = 0
    last, quotes = source.rfind(">"), True
    while True:
        at = source.find("<", at)
        if at < 0 or at > last and not source.startswith("<!--", at):
            break
        if source.startswith("<!--", at):
            end = source.find("-->", at + 4)
            end = len(source) if end < 0 else end + 3
            yield source[text_from:at], False, "", ""
        elif source[at + 1] in "!?":
            end = source.find(">", at) + 1
            yield source[text_from:at], False, "", ""
        else:
            closing = source[at + 1] == "/"
            name = _NAME.match(source, at + 1 + closing)
            if name is None:
                at += 1
                continue
            found = _TAG_END.match(source, name.end()) if quotes else None
            quotes = found is not None
            end = found.end() if found else source.find(">", name.end()) + 1
            tag = name[0].lower()
            yield source[text_from:at], closing, tag, source[name.end():end - 1]
            if tag in RAW and not closing:
                end = _RAW_END[tag].search(source, end).end()
        at = text_from = end
    yield source[text_from:], False, "", ""


def marks(found):
    """The words of class, id and role that mark what is not the article; names of states mark nothing."""
    out = set()
    for token in " ".join(found.values()).lower().split():
        words = [w for w in re.split(r"[^a-z]+", token) if w]
        if not words or words[0] in STATE_FIRST or STATE_LATER.intersection(words[1:]):
            continue
        marking = ASIDE_WORDS.intersection(words)
        out |= marking - {"header"} if ARTICLE_WORDS.intersection(words) else marking
    return out


class Page:
    """Containers and text blocks of one page, in page order.

    Of each container ``parent``, ``label`` (its tag and first class, digits generalised to
    ``#``), ``own`` (the score of its own blocks), ``score`` (with half of its children's)
    and ``headed`` (a heading is among its own blocks); ``blocks`` are (container, text).
    """

    def __init__(self, source):
        # Where class names alone hide all sentences of a page, they are not believed.
        self.read(source, True)
        if self.hidden and not any(self.own):
            self.read(source, False)

    def read(self, source, strict):
        self.parent, self.label, self.own, self.score, self.headed = [-1], [""], [0.0], [0.0], [False]
        self.blocks = []
        # Open elements: tag, container, why left out (0: it is not), where leaving out began.
        self.open = [("", 0, 0, 0)]
        # Open tags by name, per open article or main element; and where these stand.
        self.scopes, self.roots, self.outer = [Counter()], [], Counter()
        self.words, self.linked, self.anchors, self.heading = [], 0, 0, False
        self.strict, self.hidden = strict, False
        for text, closing, tag, labels in tags(source):
            self.add_text(text)
            if not tag or tag in RAW:
                continue
            if closing:
                self.close_tag(tag)
            else:
                self.open_tag(tag, labels)
        self.end_block()

    def add_text(self, text):
        why = self.open[-1][2]
        if text and not why:
            self.words.append(text)
            self.linked += len(text) if self.anchors else 0
        elif why == MARKED and not self.hidden:
            self.hidden = len(text.strip()) >= 25

    def cut(self, at):
        """Close the open elements from position ``at`` on."""
        while len(self.open) > at:
            tag = self.open.pop()[0]
            if tag in ROOTS:
                self.scopes.pop()
                self.roots.pop()
            self.scopes[-1][tag] -= 1
            self.outer[tag] -= 1

    def open_tag(self, tag, labels):
        if tag in BREAKS or tag in LEFT_OUT:
            self.end_block()
            self.heading = tag in HEADINGS
        elif tag == "br":
            self.add_text(" ")
        if tag == "a":
            self.anchors = 1
        if self.open[-1][0] == "head" and tag in BREAKS:
            self.cut(len(self.open) - 1)
        if tag in VOID or tag not in CONTAINERS and tag not in LEFT_OUT:
            return
        if tag in IMPLIED:
            self.imply(*IMPLIED[tag])
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _LABEL.finditer(labels)} if labels else {}
        marked = marks(found) if found and tag not in ("html", "body", "main") else frozenset()
        if tag == "article":
            marked &= LIST_WORDS
        inside, why = bool(self.roots), self.open[-1][2]
        if tag in ROOTS and (why == SOFT or why == MARKED and not inside):
            self.cut(self.open[-1][3])
        _, parent, out, since = self.open[-1]
        reason = 0
        if tag in LEFT_OUT and not (tag == "header" and inside):
            reason = SOFT if tag in YIELDING else FIRM
        if marked & LIST_WORDS:
            reason = FIRM
        elif marked and self.strict:
            reason = max(reason, MARKED)
        if reason and not out:
            since = len(self.open)
        out = max(out, reason)
        if not out:
            first = _DIGITS.sub("#", (found.get("class", "").split() or [""])[0].lower())
            self.parent.append(parent)
            self.label.append(f"{tag}.{first}" if first else tag)
            self.own.append(0.0)
            self.score.append(0.0)
            self.headed.append(False)
            parent = len(self.parent) - 1
        self.scopes[-1][tag] += 1
        self.outer[tag] += 1
        if tag in ROOTS:
            self.roots.append(len(self.open))
            self.scopes.append(Counter())
        self.open.append((tag, parent, out, since))

    def imply(self, closes, stops):
        """Close what the tag about to open ends, inside its list or table."""
        if not any(self.scopes[-1][tag] for tag in closes):
            return
        found = None
        for at in range(len(self.open) - 1, 0, -1):
            tag = self.open[at][0]
            if tag in stops or tag in ROOTS:
                break
            found = at if tag in closes else found
        if found is not None:
            self.cut(found)

    def close_tag(self, tag):
        if tag in BREAKS or tag in LEFT_OUT:
            self.end_block()
        if tag == "a":
            self.anchors = 0
        if tag in ROOTS:
            if self.roots and self.open[self.roots[-1]][0] == tag:
                self.cut(self.roots[-1])
        # A closing tag does not reach out of the article, but for the page's own.
        elif self.scopes[-1][tag] or tag in ("body", "html") and self.outer[tag]:
            at = len(self.open) - 1
            while self.open[at][0] != tag:
                at -= 1
            self.cut(at)

    def end_block(self):
        if self.words:
            text = " ".join(entities.unescape("".join(self.words)).split())
            if text:
                container = self.open[-1][1]
                self.blocks.append((container, text))
                self.rate(container, text)
        self.words, self.linked, self.heading = [], 0, False

    def rate(self, container, text):
        """Long sentences outside links speak for their container, and half for its parent."""
        worth = min(len(text) / 100, 3.0) + (text.count(",") * 0.5 + 1.0 if len(text) >= 25 else 0.0)
        worth *= 1.0 - min(1.0, self.linked / len(text))
        self.own[container] += worth
        self.score[container] += worth
        self.headed[container] |= self.heading and worth > 0
        parent = self.parent[container]
        if parent >= 0:
            self.score[parent] += worth / 2

    def tag(self, container):
        return self.label[container].split(".")[0]

    def best(self, share=0.2):
        """The container with the largest score; an article or main element counts double.

        Below the body it gives way to a container around it that has a heading of its own
        or holds at least ``share`` as much beside it: an article in several parts.
        """
        def worth(c):
            return self.score[c] * (2.0 if self.tag(c) in ROOTS else 1.0)

        best = max(range(len(self.parent)), key=lambda c: (worth(c), -c))
        whole = list(self.own)
        for c in range(len(whole) - 1, 0, -1):
            whole[self.parent[c]] += whole[c]
        around = best
        while self.tag(around) not in ROOTS:
            around = self.parent[around]
            if around <= 0 or self.tag(around) in ("html", "body"):
                break
            if self.headed[around] or whole[around] - whole[best] >= share * whole[best] > 0:
                best = around
        return best

    def path(self, container):
        """The last steps to a container, from the outside in."""
        steps = []
        while container > 0 and len(steps) < PATH_STEPS:
            steps.append(self.label[container])
            container = self.parent[container]
        return "/".join(reversed(steps))

    def text(self, roots):
        """Blocks inside any of the containers, joined by empty lines."""
        inside = []
        for number, parent in enumerate(self.parent):
            inside.append(number in roots or parent >= 0 and inside[parent])
        return "\n\n".join(text for container, text in self.blocks if inside[container])

    def matching(self, paths):
        return {c for c in range(len(self.parent)) if self.path(c) in paths} if paths else set()


def _vote(pages: pa.Array) -> pa.Array:
    out = []
    for page in map(Page, (p.as_py() or "" for p in pages)):
        best = page.best()
        out.append((page.path(best), page.score[best]))
    paths, scores = zip(*out) if out else ((), ())
    return pa.StructArray.from_arrays([pa.array(paths, pa.string()), pa.array(scores, pa.float64())], ["path", "score"])


def _extract(pages: pa.Array, winners: pa.Array) -> pa.Array:
    out = []
    for source, paths in zip(pages, winners.to_pylist()):
        page = Page(source.as_py() or "")
        out.append(page.text(page.matching(set(paths or ()))) or page.text({page.best()}))
    return pa.array(out, pa.string())


def host_paths(votes, share=0.2):
    """Winning paths per host from rows of ``__host``, ``path`` and ``score``.

    Every page votes with one path. A path wins with the most votes of its host (ties to the
    larger score, then to the smaller path) or with at least ``share`` of them. Votes are
    counted in tasks first, so a host with very many pages sends few rows.
    """
    counted = votes.filter("score > 0").groupBy("__host", "path").agg(F.count(F.lit(1)).alias("votes"), F.sum("score").alias("score"))
    host = Window.partitionBy("__host")
    rank = F.row_number().over(host.orderBy(F.desc("votes"), F.desc("score"), "path"))
    return (counted.withColumns({"rank": rank, "all": F.sum("votes").over(host)})
            .filter((F.col("rank") == 1) | (F.col("votes") >= F.col("all") * share))
            .groupBy("__host").agg(F.sort_array(F.collect_list("path")).alias("paths")))


def main_text(pages, html="html", url="url", share=0.2):
    """Add ``text`` (the main text) and ``n_chars`` (its code points) to every page.

    Each page scores its containers and votes for the path of its best one; a host's winning
    paths then decide on all its pages. A page takes all its containers on winning paths, in
    page order; a page with none, or without text in them, takes its own best container.

    Menus, headers, footers, asides, forms, adverts, notices, comments, scripts and styles
    are left out by element and by the words in class, id and role, unless these name a
    state (``has-sidebar``) or leave no sentence on the page. An article element inside
    marked wrappers is kept, but not one among comments or related pages. Character
    references are decoded, white space in a block is one space, blocks are joined by two
    line feeds. Broken markup closes where its parent does; list items and table cells close
    at the next one. Reading takes time and memory in proportion to the page. Null and empty pages give an empty text. A
    url without host votes among such pages. Repeated pages vote each. An empty table
    gives no rows. Columns of ``pages`` named like an added column are replaced.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(f"`{url}`"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))
    # Marked so that the filter on the score is not moved below it, where it would parse every page once more.
    vote = F.arrow_udf(_vote, "struct<path: string, score: double>").asNondeterministic()
    votes = pages.select(host.alias("__host"), vote(F.col(f"`{html}`")).alias("v")).select("__host", "v.path", "v.score")
    winners = checkpointed(host_paths(votes, share).withColumnRenamed("__host", "__of"))
    if winners.count() <= BROADCAST_HOSTS:
        winners = F.broadcast(winners)
    base = without(pages, *ADDED)
    return (base.withColumn("__host", host).join(winners, F.col("__host") == F.col("__of"), "left")
            .withColumn("text", F.arrow_udf(_extract, "string")(F.col(f"`{html}`"), F.col("paths")))
            .select(*quoted(base.columns), "text", F.length("text").cast("long").alias("n_chars")))
