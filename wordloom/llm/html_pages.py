"""Main text of web pages: containers are scored per page, agreed on per host.

Every page names the container that holds most of its running text by a generalised path
of tags and classes. Pages of a host vote, weighted by text. Pages that have the same of
the winning paths are of one template; they vote again which of these holds the article.
What lies beside that container is kept, however short, unless its text is the same on the
pages of the template.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import schema_of, stored, text_slices

# Fixed values of HTML: elements without content, with content that is no text, that
# begin a block, that hold running text, and that end an open paragraph.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = "script|style|noscript|template|textarea|svg|math|iframe|object|select|canvas|title"
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup html li main menu nav "
    "ol p pre search section summary table tbody td tfoot th thead tr ul button".split()
)
_LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote figcaption summary tr".split())
_SAME_ENDS = {
    "p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"),
}
_SCOPES = frozenset("ul ol menu dl table article section main div body html nav aside footer form".split())
_DROPPED = frozenset("head nav footer aside form menu button dialog fieldset search".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog".split())
_DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments comentarios kommentare commentaires disqus consent cookie cookies copyright "
    "footer gdpr header login masthead menu modal nav navbar navigation newsletter notice "
    "notices pager pagination popup promo promotion promoted recommend recommended related "
    "replies responses share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription toolbar topbar widget".split()
)
_TOKEN = re.compile(
    rf"(?P<skip><!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})\b[^>]*(?<!/)>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*>)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][\w:.-]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(
    r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?"
)
_SLUGS = frozenset("h1 h2 h3 h4 h5 h6 p".split())
_DENSE = 0.5  # the share of linked text from which a named element is left out
#: What repeats beside a container is left out if it is on so many pages of a hundred.
_REPEATED = 1
_DIGITS = re.compile(r"\d+")


@dataclass
class Node:
    """An open or closed block element."""

    tag: str
    path: str
    parent: Node | None
    dropped: bool
    named: bool = False  # a part of its name says that it is no part of an article
    shadowed: bool = False  # it, or an element around it, is named so
    length: int = 0  # of the text within, if it is shadowed
    linked: int = 0


@dataclass
class Page:
    """The blocks of a page in order: node, text, characters of it in links."""

    blocks: list[tuple[Node, str, int]] = field(default_factory=list)


def _attributes(source: str) -> dict[str, str]:
    return {
        m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(source)
    }


def _is_dropped(tag: str, attributes: dict[str, str], parent: Node | None) -> bool:
    """Whether an element, or one around it, is no part of an article by its kind."""
    if parent is not None and parent.dropped:
        return True
    if tag in _DROPPED:
        return True
    if tag == "header":  # the heading of an article is part of it
        return not any(x.tag in ("article", "main") for x in _ancestors(parent))
    if tag in ("html", "body", "article", "main"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if attributes.get("role", "").lower() in _ROLES:
        return True
    if re.search(r"display:\s*none", attributes.get("style", "")):
        return True
    return not _DROPPED_NAMES.isdisjoint(_names(tag, attributes).lower().split())


def _names(tag: str, attributes: dict[str, str]) -> str:
    """Classes and id; the id of a heading or paragraph is a slug of its text."""
    slug = "" if tag in _SLUGS else attributes.get("id", "")
    return f"{attributes.get('class', '')} {slug}"


def _is_named(tag: str, attributes: dict[str, str]) -> bool:
    """Whether a part of a class or of the id is one of the names."""
    if tag in ("html", "body", "article", "main", "header") or tag in _SLUGS:
        return False
    # Words of camelCase and of names joined by - or _.
    words = re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", _names(tag, attributes)).lower())
    return not _DROPPED_NAMES.isdisjoint(words)


def _ancestors(node: Node | None):
    while node is not None:
        yield node
        node = node.parent


def _step(tag: str, attributes: dict[str, str]) -> str:
    """Tag and classes with every number as #, so that pages of one kind agree."""
    classes = sorted({_DIGITS.sub("#", c) for c in attributes.get("class", "").split()})
    return ".".join([tag, *classes])


def read_page(html: str) -> Page:
    """The blocks of a page; unclosed, misplaced and cut off tags are put up with."""
    page = Page()
    node: Node | None = None
    pieces: list[str] = []
    in_link = linked = 0

    def flush():
        nonlocal pieces, linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                page.blocks.append((node, text, linked))
                if node is not None and node.shadowed:
                    for outer in _ancestors(node):
                        outer.length += len(text)
                        outer.linked += linked
            pieces, linked = [], 0

    for match in _TOKEN.finditer(html):
        text = match["text"]
        if text is not None:
            text = unescape(text)
            pieces.append(text)
            linked += len(text) if in_link else 0
            continue
        if match["skip"] is not None:
            continue
        tag = match["tag"].lower()
        if tag == "br" or tag == "hr":
            pieces.append(" ")
        if tag == "a":
            in_link = 0 if match["close"] else 1
        if tag not in _BLOCKS or tag in _VOID:
            continue
        flush()
        in_link = 0
        if match["close"]:
            if any(x.tag == tag for x in _ancestors(node)):
                while node.tag != tag:
                    node = node.parent
                node = node.parent
            continue
        ends = _SAME_ENDS.get(tag, ("p",))
        for open_ in _ancestors(node):
            if open_.tag in ends:
                node = open_.parent
                if tag != "tr" or open_.tag == "tr":
                    break
            elif open_.tag in _SCOPES:
                break
        attributes = _attributes(match["attributes"])
        if match["attributes"].endswith("/") and tag not in ("p", "div", "section", "article", "li"):
            continue
        path = _step(tag, attributes)
        named = _is_named(tag, attributes)
        node = Node(
            tag,
            f"{node.path}>{path}" if node else path,
            node,
            _is_dropped(tag, attributes, node),
            named,
            named or (node is not None and node.shadowed),
        )
    flush()
    return page


def _running(page: Page) -> list[tuple[Node, float, str]]:
    """Blocks that can be of an article, with the length of their text outside of links,
    and the text.

    Elements named as something else by a part of their names do not count, unless a page
    has no other running text; then those with much linked text do not.
    """
    blocks = [
        (node, float(len(text) - linked), text)
        for node, text, linked in page.blocks
        if node is not None and not node.dropped and len(text) > linked
    ]
    plain = [block for block in blocks if not block[0].shadowed]
    return plain or [block for block in blocks if not any(map(_is_dense, _ancestors(block[0])))]


def _is_dense(node: Node) -> bool:
    return node.named and node.linked >= _DENSE * node.length


def container_scores(page: Page) -> dict[str, float]:
    """Running text per container path: all of it for the container of a block, half for
    the one around that, and so on; text in links and in dropped elements is not counted.

    Within ``article`` or ``main`` that element is the container.
    """
    scores: dict[str, float] = {}
    for node, weight, _ in _running(page):
        semantic = [x for x in _ancestors(node) if x.tag in ("article", "main")]
        if semantic:
            scores[semantic[-1].path] = scores.get(semantic[-1].path, 0.0) + weight
            continue
        holder = node
        while holder.tag in _LEAVES and holder.parent is not None:
            holder = holder.parent
        for outer in _ancestors(holder):
            scores[outer.path] = scores.get(outer.path, 0.0) + weight
            weight /= 2
    return scores


def beside(page: Page, paths: list[str]) -> dict[str, dict[str, int]]:
    """For each of some container paths the paths of elements with the same parent that hold
    running text, with a hash of that, the path itself among them; none beside ``article``
    or ``main``. Under the empty path is the hash of all running text."""
    texts: dict[str, list[str]] = {}
    parents: dict[str, str] = {}
    wanted = set(paths)
    for node, _, text in _running(page):
        # Paths repeat, but a block counts once for each.
        for path, outer in {x.path: x for x in _ancestors(node)}.items():
            texts.setdefault(path, []).append(text)
            if outer.parent is not None:
                parents[path] = outer.parent.path
            if path in wanted and outer.tag in ("article", "main"):
                wanted.discard(path)
    children: dict[str, list[str]] = {}
    for path, parent in parents.items():
        children.setdefault(parent, []).append(path)
    hash_of = lambda said: xxhash.xxh3_64_intdigest("\n".join(said)) >> 1
    whole = hash_of([text for _, _, text in _running(page)])
    return {
        path: {"": whole} | {other: hash_of(texts[other]) for other in children[parents[path]]}
        for path in wanted
        if path in parents
    }


def best_path(scores: dict[str, float]) -> str | None:
    return min(scores, key=lambda path: (-scores[path], path)) if scores else None


def template_of(scores: dict[str, float], winners: list[str]) -> int:
    """The winning paths that a page has, as bits."""
    return sum(1 << n for n, path in enumerate(winners) if scores.get(path))


def main_text(
    page: Page, winners: list[str], templates: dict[int, tuple[str, list[str]]] | None = None
) -> str:
    """The blocks within the container of the page's template, else within the winning path
    with most text, else within the page's own best container, and those beside it; or, on
    a page without any, those outside of any element.

    ``templates`` has for the winning paths of a page (bits) that container and the paths
    beside it that repeat from page to page and are left out. Elements with a part of their names that says they are no part of an article
    are left out within the container if at least half of their text is in links.
    """
    scores = container_scores(page)
    path, repeated = (templates or {}).get(template_of(scores, winners), (None, []))
    if path is None:
        path = best_path({p: scores[p] for p in winners if scores.get(p)}) or best_path(scores)
    read = {path}
    if path is not None:
        read |= beside(page, [path]).get(path, {}).keys() - set(repeated)
    only_named = all(node.shadowed for node, _, _ in _running(page))

    def is_kept(node: Node) -> bool:
        found = False
        for x in _ancestors(node):
            if x.named and (_is_dense(x) or (found and not only_named)):
                return False
            if x.path in read:
                if x.named and not only_named:
                    return False
                found = True
        return found

    kept = [
        text
        for node, text, _ in page.blocks
        if (path is None and node is None) or (node and not node.dropped and is_kept(node))
    ]
    return "\n".join(kept)


def extract_pages(pages: DataFrame, share: float = 0.2) -> DataFrame:
    """``page_id, url, text, n_chars, container`` for every row of ``pages`` (``page_id,
    url, html``).

    ``container`` is the leading path of the page's host; paths with at least ``share`` of
    a host's votes win, at most ``1 / share`` of them, the strongest first. Pages of a host
    with the same winning paths vote which of them is read from these pages. Elements beside
    it are read too, unless they say the same on most of the pages that have them (copies of
    a page are one) and are on a hundredth of all: notices and the like. The votes are
    summed before they are shuffled, one row per task, host and path, so a host with a
    third of the pages is no larger than another; what elements say is counted by hashes. A
    null html gives an empty text, a null url is a host of its own, repeated rows are kept;
    other columns are not read.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.col("url"), r"^[^/]*//([^/?#]*)", 1)), F.lit(""))
    rows = pages.select("page_id", "url", host.alias("_host"), F.col("html").alias("text"))

    def vote(batches):
        for batch, texts in text_slices(batches):
            votes: dict[tuple[str, str], float] = {}
            for name, html in zip(batch.column("_host").to_pylist(), texts):
                scores = container_scores(read_page(html))
                path = best_path(scores)
                if path is not None:
                    votes[name, path] = votes.get((name, path), 0.0) + scores[path]
            if votes:
                names, paths = zip(*votes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names), pa.array(paths), pa.array(votes.values(), pa.float64())],
                    names=["_host", "path", "votes"],
                )

    votes = (
        rows.select("_host", "text")
        .mapInArrow(vote, "_host string, path string, votes double")
        .groupBy("_host", "path")
        .agg(F.sum("votes").alias("votes"))
    )
    votes = stored(votes)
    totals = votes.groupBy("_host").agg(F.sum("votes").alias("total"))
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("v"), "path")))
    winners = stored(
        votes.join(totals, "_host")
        .filter(F.col("votes") >= share * F.col("total"))
        .groupBy("_host")
        .agg(F.transform(ranked, lambda x: x["path"]).alias("winners"))
    )

    def vote_again(batches):
        for batch, texts in text_slices(batches):
            sums: dict[tuple[str, int, str], float] = {}
            said: set[tuple[str, int, str, str, int, int]] = set()
            names = batch.column("_host").to_pylist()
            for name, html, paths in zip(names, texts, batch.column("winners").to_pylist()):
                page = read_page(html)
                scores = container_scores(page)
                template = template_of(scores, paths or [])
                if not template:
                    continue
                present = [p for p in paths if scores.get(p)]
                best = best_path({p: scores[p] for p in present})
                sums[name, template, best] = sums.get((name, template, best), 0.0) + scores[best]
                for path, hashes in beside(page, present).items():
                    whole = hashes.pop("")
                    for other, hash_ in hashes.items():
                        said.add((name, template, path, other, hash_, whole))
            rows_of = [(*key, None, None, None, votes) for key, votes in sums.items()]
            rows_of += [(*key, None) for key in said]
            if rows_of:
                kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*rows_of), kinds)],
                    names=["_host", "template", "path", "other", "said", "page", "votes"],
                )

    again = stored(
        rows.select("_host", "text")
        .join(winners, "_host")
        .mapInArrow(
            vote_again,
            "_host string, template long, path string, other string, said long, page long, votes double",
        )
        .groupBy("_host", "template", "path", "other", "said", "page")
        .agg(F.sum("votes").alias("votes"))
    )
    key = ["_host", "template"]
    leaders = (
        again.filter("other is null")
        .groupBy(*key)
        .agg(F.min(F.struct((-F.col("votes")).alias("v"), "path"))["path"].alias("path"))
    )
    said = again.filter("other is not null").groupBy(*key, "path", "other").agg(
        F.count_distinct("said").alias("texts"), F.count_distinct("page").alias("pages")
    )
    sizes = said.filter("path = other").select(*key, "path", F.col("pages").alias("size"))
    repeated = (
        said.filter("path <> other and 2 * texts <= pages")
        .join(sizes, [*key, "path"])
        .filter(F.col("pages") * 100 >= F.col("size") * _REPEATED)
        .groupBy(*key, "path")
        .agg(F.sort_array(F.collect_list("other")).alias("repeated"))
    )
    templates = leaders.join(repeated, [*key, "path"], "left").groupBy("_host").agg(
        F.collect_list(F.struct("template", "path", "repeated")).alias("templates")
    )
    winners = stored(winners.join(templates, "_host", "left"))

    def extract(batches):
        for batch, texts in text_slices(batches):
            winning = batch.column("winners").to_pylist()
            plans = [
                {t["template"]: (t["path"], t["repeated"] or []) for t in plan or []}
                for plan in batch.column("templates").to_pylist()
            ]
            found = [
                main_text(read_page(html), paths or [], plan)
                for html, paths, plan in zip(texts, winning, plans)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(found, pa.string()),
                    pa.array([len(text) for text in found], pa.int64()),
                    pa.array([paths[0] if paths else None for paths in winning], pa.string()),
                ],
                names=["page_id", "url", "text", "n_chars", "container"],
            )

    schema = schema_of(
        pages, ["page_id", "url"], text="string", n_chars="long", container="string"
    )
    # Spark broadcasts the winners of few hosts and shuffles the pages for many.
    joined = rows.join(winners, "_host", "left").select("page_id", "url", "text", "winners", "templates")
    return joined.mapInArrow(extract, schema)
