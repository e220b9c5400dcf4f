"""Main text of web pages: containers are scored per page, and hosts agree on the paths that hold it."""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replivote.llm.common import chunks, quoted, stored

#: Elements that never belong to the article.
SKIPPED = {
    "aside", "audio", "button", "canvas", "dialog", "footer", "head", "header", "iframe", "input", "menu", "nav",
    "noscript", "object", "option", "select", "svg", "template", "textarea", "video",
}
_WORDS = (
    r"ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|sidebar|side|menu|nav\w*"
    r"|breadcrumbs?|footer|masthead|comments?|replies|disqus|respond|share|sharing|social|related|recommend\w*|newsletter|subscribe|signup|login"
    r"|pagination|pager|toolbar|widget"
)
#: A class or id that names what is not the article; it skips a container.
NAMED = re.compile(_WORDS)
#: A class or id with such a word as a part, as in ``cookie-notice`` and ``side-effects``; it only lowers the score.
HINTED = re.compile(rf"(?:^|[-_])(?:{_WORDS})(?:$|[-_])")
#: Words for what readers write; a part so named is skipped in articles and sections too, by class or id.
SAID = r"comments?|commentlist|replies|reply|respond|disqus"
#: An ``article`` of such a name is none.
OTHERS_ARTICLE = rf"{SAID}|teasers?|related|recommend\w*"
#: Words for a part of a page, whatever is in it; ``content`` only at the end of a name.
STRUCTURE = (
    r"\d*|area|articles?|author|bars?|block|body|bottom|box|buttons?|column|container|desktop|entry|feed|footer|form|google|group|header|icons?|inner"
    r"|items?|left|links?|lists?|main|meta|mobile|outer|page|panel|posts?|respond|right|row|section|site|slot|stor(?:y|ies)|tags|thread|title|top|unit|wp|wrap(?:per)?"
)


@lru_cache(1 << 14)
def _names(words: str, name: str) -> bool:
    """Is a name made of such words and of structure alone? ``comment-list`` and ``post-comments`` are, ``side-effects`` is not."""
    parts = [p for p in re.split("[-_]+", name) if p]
    if parts and parts[-1] == "content":
        parts.pop()
    said = [re.fullmatch(words, p) is not None for p in parts]
    return any(said) and all(w or re.fullmatch(STRUCTURE, p) for w, p in zip(said, parts))


#: Roles of what is beside the article.
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar"}
#: What text in a container of such a name counts.
LOW = 0.1
#: Share of a page's unlinked text with which a container is neither skipped nor lowered, whatever its name.
MOST = 0.7
#: Share of a page's article-like text that counts as nearly all.
NEARLY = 0.9
#: Elements whose place is part of a path.
CONTAINERS = {
    "html", "body", "main", "article", "section", "div", "ul", "ol", "dl", "table", "tbody", "tr", "td", "figure", "blockquote", "center", "details", "form",
} | SKIPPED
#: Elements that do not break a line of text.
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark",
    "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Blocks whose end tag may be missing, and what ends them; a paragraph is ended by any block.
CLOSING = {"p": set(), "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
#: Elements that are the article or hold it, whatever they are called.
WHOLE = {"html", "body", "main", "article"}

_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|title|textarea|xmp|noembed)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?:/?[a-z]|[!?/])[^>]*(?:>|\Z)",
    re.S | re.I,
)
_NAME = re.compile(r"(?<![\w-])(class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_ROLE = re.compile(r"(?<![\w-])role\s*=\s*[\"']?\s*(\w+)", re.I)
_HIDDEN = re.compile(r"(?<![\w=-])hidden(?![\w-]|\s*=\s*[\"']?until-found)|(?<![\w-])style\s*=\s*(?:\"[^\"]*|'[^']*|\S*)\bdisplay\s*:\s*none", re.I)
_MAY_HIDE = re.compile("hidden|none", re.I)
_QUOTED = re.compile(r"(?<![\w-])(?!style\b)([\w-]+\s*=\s*)(?:\"[^\"]*\"|'[^']*')", re.I)
_NUMBER = re.compile(r"\d+")
_MARKS = re.compile("[/.]")  # these part a path


class Path:
    """The way to a container: its own step and the path around it, one object per path of a page.

    The digest is the same on all pages, so paths are counted without being spelt out: a page of nested
    tags takes memory in proportion to its length.
    """

    __slots__ = ("around", "tag", "digest", "depth", "in_article", "inner")

    def __init__(self, around: Path | None, tag: str, step: str):
        self.around, self.tag, self.inner = around, tag, {}
        self.digest = hashlib.blake2b(((around.digest if around else "") + step).encode("utf-8", "replace"), digest_size=16).hexdigest()
        self.depth = around.depth + 1 if around else 0
        self.in_article = around is not None and (around.in_article or around.tag == "article")

    def step(self, tag: str, step: str) -> Path:
        if step not in self.inner:
            self.inner[step] = Path(self, tag, step)
        return self.inner[step]

    def above(self) -> Iterator[Path]:
        """The paths around this one, the nearest first, the page itself last."""
        path = self.around
        while path is not None:
            yield path
            path = path.around

    def inside(self, outer: Path) -> bool:
        path = self
        while path.depth > outer.depth:
            path = path.around
        return path is outer


@dataclass(slots=True, eq=False)
class Node:
    """A container: its path, what it holds in page order, and what counts for its score."""

    tag: str
    path: Path
    skipped: bool
    parts: list = field(default_factory=list)  # texts, None for a break, and containers
    plain: int = 0
    linked: int = 0
    titled: bool = False  # holds a heading of the first order itself
    doubt: int = 0  # 3 if not shown, 2 if by name to be skipped, 1 if its score is to be lowered
    said: bool = False  # by name, what readers wrote
    weight: float = 1.0


def _doubts(node: Node, classes: set[str], ids: set[str], attributes: str) -> None:
    """What the names, the role and the style of a container say against it."""
    inside = node.path.in_article
    named = classes if inside or node.tag in ("article", "section") else classes | ids  # there, ids name headings
    node.said = node.tag not in WHOLE and any(_names(SAID, w) for w in classes | ids)
    if node.tag == "article":
        node.said = any(_names(SAID, w) for w in classes)
        node.doubt = 2 if any(_names(OTHERS_ARTICLE, w) for w in classes) else 0
    elif node.tag not in WHOLE:
        role = _ROLE.search(attributes)
        out = node.tag == "form" or node.said or role is not None and role[1].lower() in ROLES
        if out or any(NAMED.fullmatch(w) or node.tag != "section" and _names(_WORDS, w) for w in named):
            node.doubt = 2
        else:
            node.doubt = int(any(HINTED.search(w) for w in named))
    if node.tag not in ("html", "body") and _MAY_HIDE.search(attributes) and _HIDDEN.search(_QUOTED.sub(r"\1_", attributes)):
        node.doubt = 3


def parse(page: str | None) -> Node:
    """The tree of containers of a page; unclosed, misplaced and cut-off tags are put up with."""
    top = Node("", Path(None, "", ""), False)
    stack, link, at = [top], 0, 0
    opened: Counter[str] = Counter()  # containers on the stack by tag
    text = page or ""

    def put(raw: str) -> None:
        if raw:
            node, said = stack[-1], html.unescape(raw)
            node.parts.append(said)
            size = len(said) - said.count(" ")
            node.plain, node.linked = node.plain + size * (not link), node.linked + size * bool(link)

    for m in _MARK.finditer(text):
        put(text[at : m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag == "h1":
            stack[-1].titled = True
        if tag == "a":
            link = 0 if m["end"] else 1
        if tag not in INLINE:
            stack[-1].parts.append(None)
            if tag in ("p", "article", "section", "div") or m["end"] and tag in CONTAINERS:
                link = 0
            if not m["end"] and tag not in VOID and stack[-1].tag in CLOSING and (stack[-1].tag == "p" or tag in CLOSING[stack[-1].tag]):
                opened[stack.pop().tag] -= 1
        if tag in VOID or tag in INLINE:
            continue
        if m["end"]:
            while opened[tag]:
                last = stack.pop().tag
                opened[last] -= 1
                if last == tag:
                    break
            continue
        attributes = m["attributes"]
        found = _NAME.findall(attributes) if "=" in attributes else []
        classes, ids = ({w for kind, *g in found if kind.lower() == k for w in "".join(g).lower().split()} for k in ("class", "id"))
        around = stack[-1]
        if tag in CONTAINERS:
            if tag in ("html", "body") and opened[tag]:
                continue
            inside = around.path.in_article or around.tag == "article"
            # an id is often a page's own, so that it tells paths apart only where no class does
            names = classes or (set() if inside or tag in ("article", "section") else ids)
            step = f"/{tag}" + "".join("." + _NUMBER.sub("#", _MARKS.sub("_", w)) for w in sorted(names))
            node = Node(tag, around.path.step(tag, step), around.skipped or tag in SKIPPED and not (tag == "header" and inside))
            _doubts(node, classes, ids, attributes)
        else:  # other blocks are containers only where their names or a like one around them ask for it
            node = Node(tag, around.path, around.skipped)
            if attributes:
                _doubts(node, classes, ids, attributes)
            if not (node.doubt >= 2 or opened[tag]):
                continue
            node.path = around.path.step(tag, f"/{tag}")
        around.parts.append(node)
        if not attributes.endswith("/"):
            stack.append(node)
            opened[tag] += 1
    put(text[at:])
    settle(top)
    return top


def settle(top: Node) -> None:
    """Skip or lower containers by name, but none that holds an article, or most of the page's unlinked text.

    What readers wrote is skipped however long it is, if the article or the page's title is elsewhere.
    """
    order = list(nodes(top))
    held = {n: 0 if n.skipped else n.plain for n in order}
    whole = {n: int(n.tag == "main" or n.tag == "article" and n.doubt < 2) for n in order}
    heads = {n: int(n.titled and not n.skipped) + int(n.tag == "article" and n.doubt < 2 and not n.skipped) for n in order}
    for node in reversed(order):  # what is inside comes after
        for part in node.parts:
            if isinstance(part, Node) and not part.skipped:
                held[node] += held[part]
                whole[node] |= whole[part]
                heads[node] += heads[part]
    for node in order:
        beside = node.said and heads[node] < heads[top]
        if node.doubt and (held[node] < MOST * held[top] or beside):
            if node.doubt == 3 or node.doubt == 2 and not whole[node]:
                node.skipped = True
            else:
                node.weight = LOW
        for part in node.parts:
            if isinstance(part, Node):
                part.skipped |= node.skipped
                part.weight = 1.0 if part.tag == "main" or part.tag == "article" and part.doubt < 2 else node.weight


def nodes(top: Node) -> Iterator[Node]:
    todo = [top]
    while todo:
        node = todo.pop()
        yield node
        todo += [p for p in reversed(node.parts) if isinstance(p, Node)]


def credits(top: Node, others: Iterable[Path] = ()) -> dict[Path, float]:
    """Article-like text inside each path of a page: its letters less twice those in links, container by container.

    Every path that is not skipped is in it. What is on paths of ``others`` counts nothing.
    """
    order = [n for n in nodes(top) if not n.skipped]
    held: dict[Node, float] = {}
    without, beside = set(others), set()
    found: dict[Path, float] = {}
    for node in order:
        if node.path in without or node in beside:
            beside.update([node, *(p for p in node.parts if isinstance(p, Node))])
        held[node] = 0.0 if node in beside else max(0.0, node.weight * (node.plain - 2 * node.linked))
    for node in reversed(order):  # what is inside comes after
        held[node] += sum(held[p] for p in node.parts if isinstance(p, Node) and not p.skipped)
        found[node.path] = found.get(node.path, 0.0) + held[node]
    return found


def choice(top: Node, held: dict[Path, float], least: float = 0.4) -> list[Path]:
    """The paths of a page's article: its ``article`` elements, or the smallest container that holds nearly all and the title."""
    total = held[top.path]
    whole = [p for p in held if p.tag == "article" and not p.in_article]
    if total <= 0:
        return whole or [p for p in held if p.tag == "main"]
    if sum(held[p] for p in whole) >= total / 2:
        most = max(held[p] for p in whole)
        return sorted((p for p in whole if held[p] >= least * most), key=lambda p: p.digest)
    best = max((p for p in held if held[p] >= NEARLY * total), key=lambda p: (p.depth, p.digest))
    mains = {p for p in held if p.tag == "main" and held[p] >= total / 2}
    if mains and not (best in mains or any(a in mains for a in best.above())):
        best = min(mains, key=lambda p: (p.depth, p.digest))
    titled: set[Path] = set()  # paths that hold a title
    for path in {n.path for n in nodes(top) if n.titled and not n.skipped}:
        while path is not None and path not in titled:
            titled.add(path)
            path = path.around
    if best not in titled:
        around = next((a for a in best.above() if a in titled), best)
        if held[around] > held[best]:
            best = around
    return [best]


def text_of(top: Node, paths: list[Path]) -> str:
    """Text of all containers on the paths, in page order, blocks joined by one space."""
    wanted, out = set(paths), []
    todo: list = [(top, False)]
    while todo:
        part, taken = todo.pop()
        if isinstance(part, Node):
            if not part.skipped:
                taken = taken or part.path in wanted
                if taken or any(isinstance(p, Node) for p in part.parts):
                    out.append(" ")
                    todo += [(p, taken) for p in reversed(part.parts)]
                    continue
            out.append(" ")
        elif taken:
            out.append(" " if part is None else part)
    return " ".join("".join(out).split())


def extract(page: str | None, paths: list[str] | None, others: list[str] | None = None) -> str:
    """The text on a host's winning paths, wherever a page has them.

    Of winners inside each other the one with more votes counts. A page whose winners are missing, or hold
    less text, links included, than half of what is article-like and not on the host's ``others``, gives the
    text on its own best paths.
    """
    top = parse(page)
    known = {n.path.digest: n.path for n in nodes(top) if not n.skipped}
    won = [known[d] for d in paths or [] if d in known]
    beside = {known[d] for d in others or [] if d in known}
    held = credits(top, {p for p in beside if not any(p.inside(w) for w in won)})
    present: list[Path] = []
    for path in won:
        if not any(path.inside(p) or p.inside(path) for p in present):
            present.append(path)
    text = text_of(top, present)
    if not present or len(text) - text.count(" ") < held[top.path] / 2:
        text = text_of(top, choice(top, held) or present)
    return text


def votes(pages: DataFrame) -> DataFrame:
    """``host, path, above, pages, votes``: how many pages have a path, and how many have their article there.

    Paths go by their digests; of those with votes ``above`` lists the paths around them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks([whole], "html"):
                ballots: dict[tuple[str, str], list] = {}
                for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                    top = parse(page)
                    held = credits(top)
                    chosen = set(choice(top, held))
                    for path in held:
                        count = ballots.setdefault((host, path.digest), [None, 0, 0])
                        count[1] += 1
                        if path in chosen:
                            count[0] = [a.digest for a in path.above()]
                            count[2] += 1
                hosts, paths = zip(*ballots) if ballots else ((), ())
                above, n, votes = zip(*ballots.values()) if ballots else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(above, pa.list_(pa.string())),
                     pa.array(n, pa.int64()), pa.array(votes, pa.int64())],
                    ["host", "path", "above", "pages", "votes"],
                )

    return pages.select("host", "html").mapInArrow(run, "host string, path string, above array<string>, pages long, votes long")


def host(url: str) -> Column:
    """Host of an address in lower case; null or no host gives an empty one."""
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def winners(pages: DataFrame, least: float = 0.4) -> DataFrame:
    """``host, paths, others``: the path with most votes of a host and those with ``least`` times as many, most votes first;
    and the paths beside them that at least half of the host's pages have."""
    sums = [F.max("above").alias("above"), F.sum("pages").alias("pages"), F.sum("votes").alias("votes")]
    counted = stored(votes(pages).groupBy("host", "path").agg(*sums), "votes")
    best = counted.groupBy("host").agg(F.max("votes").alias("best"), F.max("pages").alias("all"))  # every page has the empty path
    joined = counted.join(best, "host")
    # a path of its own on every page wins nothing for the others: at most 20 / least paths per host
    won = (F.col("votes") > 0) & (F.col("votes") >= F.lit(least) * F.col("best")) & (20 * F.col("votes") >= F.col("all"))
    common = 2 * F.col("pages") >= F.col("all")  # as many as two usual pages have
    place = F.struct((-F.col("votes")).alias("n"), F.size("above").alias("depth"), "path", "above")
    named = joined.where(won | common).groupBy("host").agg(
        F.sort_array(F.collect_list(F.when(won, place))).alias("won"),
        F.array_sort(F.collect_list(F.when(common & ~won, F.col("path")))).alias("common"),
    )
    # what is around a winner is not beside it; what is inside one shows on the page
    return named.select("host", F.col("won")["path"].alias("paths"), F.array_except("common", F.flatten(F.col("won")["above"])).alias("others"))


def main_text(pages: DataFrame, least: float = 0.4) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars``, by their hosts' winning paths.

    A name skips a block as a whole class word, or if made of such words and of words for parts of pages (``ad-slot``, not
    ``ad-hoc``; outside an article, also an id), as do a role and a style that hides it; none that holds an article
    or most of the page's unlinked text. Readers' comments, ``article`` elements too, go by class or id wherever they are.

    Null html or a page without article text gives an empty text of 0 characters; pages
    without a host vote together. Every row is returned; input columns ``text`` and
    ``n_chars`` are replaced.
    """
    kept = [c for c in pages.columns if c.lower() not in ("text", "n_chars")]
    row = F.struct(*[F.col(quoted(c)) for c in kept]).alias("row")
    hosted = pages.select(row, F.col("html").alias("html"), host("url").alias("host"))
    chosen = stored(winners(hosted, least), "paths")
    both = hosted.join(chosen, "host", "left").select("row", "html", "paths", "others")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks([whole], "html"):
                texts = [extract(*columns) for columns in zip(*[batch.column(c).to_pylist() for c in ("html", "paths", "others")])]
                sizes = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string()), sizes], ["row", "text", "n_chars"])

    schema = T.StructType([T.StructField("row", both.schema["row"].dataType), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return both.mapInArrow(run, schema).select("row.*", "text", "n_chars")
