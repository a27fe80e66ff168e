"""Main text of HTML pages by two passes of block rules.

A page is cut into text blocks at block-level tags.  Pass one classifies each block on its own:

* *bad* if it stands in a boilerplate container (``nav``, ``footer``, ``aside``, ``form``, a page
  ``header``, an element that is hidden or whose class, id or role names a menu, advert, notice,
  reader comments, ...), or if links hold most of its text;
* *good* if it stands in the page's article container, or if it is long and dense in stop words;
* otherwise *bad* when long and sparse in stop words, *near good* when middling, *short* when short.

Pass two settles the undecided blocks: a run of short or near-good blocks takes the label of the
nearest decided block on both sides (near-good blocks need one good neighbour, short ones two; the
page's ends count as bad), headings take the label of the next decided block.

Text is decoded once (character references), its white space inside a block collapsed, blocks joined
by a blank line in page order.  Null or empty pages and pages without good blocks give ''.  Pages are
independent of each other: no shuffle, and memory follows the Arrow batch.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("script style noscript template iframe svg math object canvas textarea select button head title "
                    "video audio map datalist".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol "
                   "p pre search section summary table tbody td tfoot th thead tr ul hr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILERPLATE = frozenset("nav footer aside menu dialog search".split())
#: Elements whose end is implied by the start of a block.
ENDS_AT_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6".split())

#: Words of class, id and role that name boilerplate.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adbox adslot sponsor sponsored promo promotion banner billboard "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc sitemap "
    "header masthead topbar footer bottombar colophon copyright sidebar aside complementary contentinfo widget "
    "notice notices alert cookie cookies consent gdpr privacy disclaimer legal popup modal overlay toast "
    "subscribe subscription newsletter signup login paywall form search "
    "comment comments commentlist disqus respond replies reply discussion reactions "
    "share sharing social related recommended recommendations teaser tags".split())
#: Of these, the words that name boilerplate inside longer names too; others only raise a doubt there.
ALWAYS = frozenset(
    "ad ads advert adverts advertisement advertising adbox adslot sponsor sponsored cookie cookies consent gdpr newsletter "
    "comment comments commentlist disqus respond replies reply breadcrumb breadcrumbs pagination".split())
#: Words after which a name says what an element has beside it, or lacks.
BESIDE = frozenset("has with no without not non".split())
ARTICLE_MARKS = frozenset("articlebody article-body entry-content post-content article-content story-body".split())

STOP_WORDS = frozenset(
    "the of and to in a is that it was for on are with as be at this have from or by not but what all were when we "
    "there can an your which their said if do will each about how up out them then she many some so these would "
    "le la les de des du et un une est que qui dans en pour sur pas par avec ce il ne se au plus son sa ses aux ont "
    "der die das und ist von den dem ein eine zu mit auf für im nicht sich auch es als er sie wie bei aus nach oder "
    "el los las del y por con para no su lo como más o pero sus al".split())


@dataclass(frozen=True)
class Rules:
    """Bounds of the block rules (lengths in code points, densities as shares)."""

    short: int = 70
    long: int = 200
    low_stop: float = 0.20
    high_stop: float = 0.30
    link_share: float = 0.50
    overrule: float = 3.0


_TAG = re.compile(
    r"<!--.*?(?:-->|--!>|\Z)|<[!?][^>]*+(?:>|\Z)|</[^a-zA-Z>][^>]*+(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>", re.S)
_TAG_QUICK = re.compile(r"<!--.*?(?:-->|--!>|\Z)|<[!?][^>]*+(?:>|\Z)|</[^a-zA-Z>][^>]*+(?:>|\Z)|"
                        r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_MARK = re.compile(r"[^0-9a-zA-Z_-]+")


def _marks(attributes: str) -> tuple[bool, bool, bool]:
    """Whether an element's attributes name boilerplate, name the article body, or raise a doubt only: a longer name
    with such a word in it (``share-price-news``) may be the article's own."""
    bad = good = doubt = False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id", "role", "itemprop"):
            for word in _MARK.split(value):
                if word in ARTICLE_MARKS:
                    good = True
                elif word in MARKS:
                    bad = True
                else:
                    for part in word.replace("_", "-").split("-"):
                        if part in BESIDE:
                            break
                        bad, doubt = bad or part in ALWAYS, doubt or part in MARKS
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            bad = True
        elif name == "style" and "display:none" in value.replace(" ", ""):
            bad = True
    return bad and not good, good, doubt and not good


class _Page:
    """One page's blocks: (text, link characters, in boilerplate, in articles, is heading, in doubt)."""

    def __init__(self) -> None:
        self.blocks: list[tuple[str, int, bool, tuple[int, ...], bool, bool]] = []
        self.stack: list[tuple[str, bool, bool, bool]] = []
        self.parts: list[str] = []
        self.links = 0
        self.in_link = 0
        self.bad = 0
        self.doubt = 0
        self.article: tuple[int, ...] = ()
        self.articles = 0

    def text(self, raw: str) -> None:
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            self.parts.append(text)
            if self.in_link:
                self.links += len("".join(text.split()))

    def close_block(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                heading = any(x[0] in HEADINGS for x in self.stack[-3:])
                self.blocks.append((text, self.links, self.bad > 0, self.article, heading, self.doubt > 0))
            self.parts = []
        self.links = 0

    def push(self, name: str, bad: bool, article: bool, doubt: bool) -> None:
        self.stack.append((name, bad, article, doubt))
        self.bad += bad
        self.doubt += doubt
        if article:
            self.articles += 1
            self.article += (self.articles,)

    def pop_to(self, name: str) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == name:
                for gone, bad, article, doubt in self.stack[i:]:
                    self.bad -= bad
                    self.doubt -= doubt
                    if article:
                        self.article = self.article[:-1]
                    if gone == "a":
                        self.in_link -= 1
                del self.stack[i:]
                return

    def start(self, name: str, attributes: str) -> None:
        block = name in BLOCKS
        if block:
            self.close_block()
            ended = next((x[0] for x in self.stack if x[0] in ENDS_AT_BLOCK), None)
            if ended:
                self.pop_to(ended)
            if name in ("article", "main"):
                self.pop_to("nav")  # a menu that was never closed ends where the article begins
            if name in ("li", "dt", "dd", "tr", "td", "th") and self.stack and self.stack[-1][0] == name:
                self.pop_to(name)
        elif name == "br":
            self.parts.append(" ")
        if name in VOID:
            return
        bad, good, doubt = _marks(attributes) if attributes and not attributes.isspace() else (False, False, False)
        in_article = bool(self.article)
        if name in BOILERPLATE or name == "header" and not in_article:
            bad = True
        if name == "form" or name == "main" and bad:
            bad, doubt = bad and name != "main", True
        if name in ("html", "body"):
            bad = doubt = False
        if name in ("article", "main"):
            good = not bad
        if name == "a":
            self.in_link += 1
        if block or bad or doubt or name == "a":
            self.push(name, bad, good, doubt)

    def end(self, name: str) -> None:
        if name in BLOCKS:
            self.close_block()
        self.pop_to(name)


def blocks(page: str) -> list[tuple[str, int, bool, tuple[int, ...], bool, bool]]:
    """Text blocks of a page in page order: text, characters in links, in boilerplate, the article containers around
    it (numbered, outermost first), heading, in doubt."""
    out, at, end = _Page(), 0, len(page)
    while at < end:
        m = _TAG_QUICK.search(page, at)
        if m is None:
            out.text(page[at:])
            break
        if m.start() > at:
            out.text(page[at:m.start()])
        at = m.end()
        name = m.group(2)
        if name is None:
            continue
        name = name.lower()
        if m.group(1):
            out.end(name)
        elif name in DROPPED:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*+>", re.I).search(page, at)
            if name == "head":
                close = re.compile(r"</head\s*>|(?=<body[\s>])", re.I).search(page, at)
            if not m.group(3).endswith("/"):
                at = close.end() if close else (at if name == "head" else end)
        else:
            out.start(name, m.group(3))
    out.close_block()
    return out.blocks


GOOD, BAD, NEAR, SHORT = "good", "bad", "near", "short"


def _excluded(block, rules: Rules) -> bool:
    text, links, bad = block[:3]
    return bad or links / max(1, len(text) - text.count(" ")) > rules.link_share


def _by_density(text: str, rules: Rules) -> str:
    if len(text) < rules.short:
        return SHORT
    words = text.lower().split()
    stops = sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words) / len(words)
    if stops >= rules.high_stop:
        return GOOD if len(text) > rules.long else NEAR
    return NEAR if stops >= rules.low_stop else BAD


def first_pass(found, rules: Rules) -> list[str]:
    """Label of each block on its own.

    Elements in doubt (a name with a word of boilerplate in it, a form) count as boilerplate, unless the text in them
    overrules that: where nothing outside is good by its container or its density, or where they hold
    ``rules.overrule`` times as much good text."""
    labels, solid = _judged(found, rules, True)
    if not any(b[5] for b in found):
        return labels
    doubted, sure = _judged(found, rules, False)
    inside = sum(len(b[0]) for b, x in zip(found, doubted) if b[5] and x == GOOD)
    outside = sum(len(b[0]) for b, x in zip(found, labels) if x == GOOD)
    return doubted if sure and (not solid or inside > rules.overrule * outside) else labels


def _judged(found, rules: Rules, doubt: bool) -> tuple[list[str], bool]:
    """Labels, and whether any is good by a voting container or by its density.

    A container votes for its blocks if those without boilerplate and links are longer than ``rules.long`` together;
    the blocks of others are judged as if they stood outside.  Only on a page where no container votes and no block
    outside is good by itself, all containers do: they are all that is known of it."""
    size: dict[int, int] = {}
    out = [_excluded(b, rules) or doubt and b[5] for b in found]
    labels: list[str | None] = []
    for (text, _, _, article, _, _), excluded in zip(found, out):
        if excluded:
            labels.append(BAD)
            continue
        labels.append(None)
        for c in article:
            size[c] = size.get(c, 0) + len(text)
    voting = {c for c, n in size.items() if n > rules.long}
    for i, (text, _, _, article, _, _) in enumerate(found):
        if labels[i] is None and not (article and article[-1] in voting):
            labels[i] = _by_density(text, rules)
    solid = bool(voting) or GOOD in labels
    if not voting and not any(x == GOOD and not b[3] for x, b in zip(labels, found)):
        labels = [GOOD if b[3] and not gone else x for x, b, gone in zip(labels, found, out)]
    return [x or GOOD for x in labels], solid


def second_pass(found, labels: list[str]) -> list[bool]:
    """Settle undecided blocks by their nearest decided neighbours."""
    n = len(labels)
    before, after = [BAD] * n, [BAD] * n
    last = BAD
    for i in range(n):
        before[i] = last
        if labels[i] in (GOOD, BAD):
            last = labels[i]
    last = BAD
    for i in range(n - 1, -1, -1):
        after[i] = last
        if labels[i] in (GOOD, BAD):
            last = labels[i]
    # near-good blocks first: they then count as decided for the short ones
    settled = list(labels)
    for i in range(n):
        if labels[i] == NEAR:
            settled[i] = GOOD if GOOD in (before[i], after[i]) else BAD
    if not any(x == GOOD for x in settled) and any(x == NEAR for x in labels):
        settled = [GOOD if x == NEAR else y for x, y in zip(labels, settled)]
    out = []
    last = BAD
    ahead = [BAD] * n
    for i in range(n - 1, -1, -1):
        ahead[i] = last
        if settled[i] != SHORT:
            last = settled[i]
    last = BAD
    for i in range(n):
        if settled[i] != SHORT:
            last = settled[i]
            out.append(settled[i] == GOOD)
        else:
            heading = found[i][4]
            out.append(ahead[i] == GOOD and (heading or last == GOOD))
    return out


def main_text(page: str | None, rules: Rules = Rules()) -> tuple[str, int, int]:
    """Main text of one page, how many blocks it has, and how many were kept."""
    if not page:
        return "", 0, 0
    found = blocks(page)
    keep = second_pass(found, first_pass(found, rules))
    kept = [b[0] for b, k in zip(found, keep) if k]
    return "\n\n".join(kept), len(found), len(kept)


def extract_main_text(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url"),
                      rules: Rules = Rules(), tasks: int | None = None) -> DataFrame:
    """One row per page: the columns ``keep``, then text, n_chars, n_blocks, n_kept_blocks.

    ``tasks``, if given, deals the pages round-robin over so many tasks first."""
    source = pages.select(*keep, F.col(html_col).alias("_html"))
    if tasks:
        source = source.repartition(tasks)
    schema = ", ".join(f"`{n}` {t}" for n, t in source.drop("_html").dtypes)

    def run(batches):
        for pdf in batches:
            got = [main_text(x if isinstance(x, str) else None, rules) for x in pdf.pop("_html")]
            out = pd.DataFrame(got, columns=["text", "n_blocks", "n_kept_blocks"], index=pdf.index)
            pdf["text"], pdf["n_chars"] = out["text"], out["text"].str.len().astype("int64")
            pdf["n_blocks"], pdf["n_kept_blocks"] = out["n_blocks"], out["n_kept_blocks"]
            yield pdf

    return source.mapInPandas(run, f"{schema}, text string, n_chars bigint, n_blocks bigint, n_kept_blocks bigint")
