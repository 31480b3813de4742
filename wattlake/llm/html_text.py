"""Main text of web pages, without what a site repeats on all its pages.

A page is parsed into a tree, and every element's subtree (tags, attributes that matter, text) is
hashed.  Spark counts per host on how many pages a subtree occurs; one that recurs on many pages of
its host is part of the site's template and is deleted with all below it.  Elements that say what
they are (navigation, forms, adverts, comments, ...) go on every page, also where a host has too few
pages to tell.  What remains of the article, or of the body where a page marks no article, is the
text.  A ``header`` or ``footer`` goes in an article as well, with the headings in it.

Inside an article (or main element) only whole blocks are judged, and counted over articles that
differ: copies and near copies of an article on many pages of a host are not its template, and a
heading, cell, list item, inline element or short paragraph goes only with the block that holds it.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField

from wattlake.llm.frames import with_computed
from wattlake.llm.words import sliced
from wattlake.session import scratch_path

VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Elements whose content is text for the parser, whatever it looks like.
RAW = frozenset("script style noscript template textarea title iframe xmp noembed noframes svg math".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu"
    " nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that are never main text.
BOILERPLATE = frozenset(
    "nav header footer aside form menu button select dialog script style noscript template textarea"
    " title iframe xmp noembed noframes svg math head canvas audio video object embed label input"
    " fieldset datalist".split()
)
#: Blocks that only make sense in the list, table or section that holds them.
_PARTS = frozenset(
    "li dt dd tr td th tbody thead tfoot caption figcaption summary legend option optgroup hr body html"
    " h1 h2 h3 h4 h5 h6 hgroup".split()
)
#: Blocks an author writes; with fewer words than this they may be alike by chance.
_PROSE, _PROSE_WORDS = frozenset("p pre blockquote address center".split()), 8
#: An article of which less than this share of its text is its own may be a near copy of others.
OWN_SHARE = 0.25
#: Words in class, id or role that say the same of any element.
_FRAME = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adbox adslot adunit adsense"
    " adsbygoogle sponsor sponsors sponsored promo promos promotion promotions banner banners"
    " nav navbar navigation menu menus submenu breadcrumb breadcrumbs header masthead footer"
    " sidebar sidebars side aside widget widgets cookie cookies consent gdpr notice notices popup"
    " popups modal newsletter subscribe subscription signup login search searchform share shares"
    " sharing social toolbar pagination pager contentinfo complementary alert alertdialog form".split()
)
#: Words for boxes that hold other articles or readers' comments, never the page's own text.
_OTHERS = frozenset(
    "related recommend recommended recommendation recommendations comment comments commentlist"
    " disqus reply replies respond responses reviews discussion discussions feedback".split()
)
#: Words that may stand beside these in a name without changing what it says.
_BESIDE = frozenset(
    "site page global main primary secondary top bottom left right inner outer box boxes block blocks"
    " wrap wrapper container content list lists item items bar area section region row column group"
    " zone slot unit panel holder inline post posts article articles story stories entry entries"
    " link links button buttons icon icons text title message media reader readers user users"
    " sticky google video image".split()
)
_KNOWN = _FRAME | _OTHERS | _BESIDE
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
#: What ends an open element of the first kind when it begins.
_ENDS = {
    "p": BLOCK - {"html", "body", "td", "th"},
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "tbody", "tfoot", "thead"}),
    "td": frozenset({"td", "th", "tr", "tbody", "tfoot", "thead"}),
    "th": frozenset({"td", "th", "tr", "tbody", "tfoot", "thead"}),
    "option": frozenset({"option", "optgroup"}),
    "head": frozenset({"body"}),
}
#: An end tag of an inline element does not end a block, nor that of a block what holds it.
_WALLS = frozenset("article main section aside nav header footer table td th body html div form ul ol".split())

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.DOTALL,
)
_KEPT = frozenset({"class", "id", "role", "hidden", "aria-hidden", "style"})
_MAY_KEEP = re.compile("class|id|role|hidden|style", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"([^\s\"'=/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?|\"[^\"]*\"|'[^']*'")


class Node:
    __slots__ = ("attributes", "children", "name")

    def __init__(self, name: str, attributes: dict | None = None):
        self.name = name
        self.attributes = attributes or {}
        self.children: list = []


def _attributes(rest: str) -> dict:
    """The attributes that matter; a style that hides its element counts as ``hidden``."""
    if not _MAY_KEEP.search(rest or ""):
        return {}
    found: dict = {}
    for m in _ATTRIBUTE.finditer(rest):
        name = (m[1] or "").lower()
        if name in _KEPT:
            # of attributes given twice, the first counts
            found.setdefault(name, html.unescape(next((v for v in m.groups()[1:] if v is not None), "")))
    if _HIDING.search(found.pop("style", "")):
        found.setdefault("hidden", "")
    return found


def parse(page: str) -> Node:
    """The tree of a page, however badly formed; text below an element is a string child."""
    root = Node("html")
    path = [root]
    at = 0
    while True:
        token = _TOKEN.search(page, at)
        if token is None:
            break
        if token.start() > at:
            path[-1].children.append(page[at : token.start()])
        at = token.end()
        name = token["name"]
        if name is None:
            continue
        name = name.lower()
        if token["end"]:
            _close(path, name)
            continue
        while len(path) > 1 and name in _ENDS.get(path[-1].name, ()):
            path.pop()
        if name in _ENDS.get("p", ()):
            _end_paragraph(path)
        if name == "html":
            continue
        node = Node(name, _attributes(token["rest"]))
        path[-1].children.append(node)
        if name in RAW:
            end = re.compile(rf"</{name}\s*(?:>|\Z)", re.IGNORECASE).search(page, at)
            node.children.append(page[at : end.start()] if end else page[at:])
            at = end.end() if end else len(page)
        elif name not in VOID and not token["rest"].rstrip().endswith("/"):
            path.append(node)
    if at < len(page):
        path[-1].children.append(page[at:])
    return root


def _close(path: list[Node], name: str) -> None:
    for i in range(len(path) - 1, 0, -1):
        if path[i].name == name:
            del path[i:]
            return
        if path[i].name in _WALLS and name not in BLOCK:
            return


def _end_paragraph(path: list[Node]) -> None:
    """A block that begins ends an open paragraph, also below open inline elements."""
    for i in range(len(path) - 1, 0, -1):
        if path[i].name == "p":
            del path[i:]
            return
        if path[i].name in BLOCK:
            return


def is_boilerplate(node: Node) -> bool:
    """Never main text: by its element, because it is hidden, or by what its names say.

    Articles go only if hidden or named as other articles or comments, main elements never.
    """
    if node.name in BOILERPLATE:
        return True
    if not node.attributes or node.name in ("main", "body", "html"):
        return False
    if _hidden(node):
        return True
    return _says(node, _OTHERS) or (node.name != "article" and _says(node, _FRAME))


def _hidden(node: Node) -> bool:
    return "hidden" in node.attributes or node.attributes.get("aria-hidden", "").lower() == "true"


@lru_cache(maxsize=1 << 14)
def _words_of(name: str) -> frozenset:
    """The words a class, id or role is made of, without numbers."""
    parts = re.split(r"[\W\d_]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name))
    return frozenset(p.lower() for p in parts if p)


def _says(node: Node, words: frozenset) -> bool:
    """Whether a name of the element consists of such words and those that may stand beside them:
    ``related-posts`` does, ``notice-board-history`` and ``has-sidebar`` do not."""
    for key in ("class", "id", "role"):
        for name in node.attributes.get(key, "").split():
            # no longer name consists of such words
            if len(name) <= 80:
                parts = _words_of(name)
                if not parts.isdisjoint(words) and parts <= _KNOWN:
                    return True
    return False


def _digests(tops: list[Node], walls: tuple, mark) -> dict[int, bytes]:
    """A digest, beginning with its ``mark``, of every element below ``tops`` that has text and a
    mark, by the element's identity.

    Elements named in ``walls`` are not entered, and what holds one has no digest.  White space in
    texts does not count.  Deep trees are walked without recursion.
    """
    order, pending = [], list(tops)
    while pending:
        node = pending.pop()
        order.append(node)
        pending += [c for c in node.children if isinstance(c, Node) and c.name not in walls]
    heads = {id(top) for top in tops}
    # digest and number of words of all elements, of those without a mark as well
    known: dict[int, tuple[bytes, int]] = {}
    found: dict[int, bytes] = {}
    for node in reversed(order):
        parts = [node.name.encode(), repr(sorted(node.attributes.items())).encode()]
        words = 0
        for child in node.children:
            if isinstance(child, str):
                split = child.split()
                words += len(split)
                parts.append(" ".join(split).encode("utf-8", "surrogatepass"))
            elif id(child) in known:
                digest, n = known[id(child)]
                words += n
                parts.append(b"\x01" + digest)
            else:
                break
        else:
            digest = hashlib.blake2b(b"\x00".join(parts), digest_size=12).digest()
            known[id(node)] = digest, words
            kind = mark(node, words) if words and id(node) not in heads else b""
            if kind:
                found[id(node)] = kind + digest
    return found


#: The marks of whole blocks inside articles, of whole blocks outside, and of all else outside.
_INSIDE, _OUTSIDE, _PIECE = b"i", b"o", b"p"


def _is_block(node: Node, words: int) -> bool:
    if node.name not in BLOCK or node.name in _PARTS:
        return False
    return node.name not in _PROSE or words >= _PROSE_WORDS


def subtree_hashes(root: Node) -> dict[int, bytes]:
    """A digest of every element with text outside articles that holds none."""

    def mark(node: Node, words: int) -> bytes:
        if node.name == "body":
            return b""
        return _OUTSIDE if _is_block(node, words) else _PIECE

    return _digests([root], ("article", "main"), mark)


def article_hashes(articles: list[Node]) -> dict[int, bytes]:
    """A digest of every whole block with text inside the articles, themselves left out."""
    return _digests(articles, (), lambda node, words: _INSIDE if _is_block(node, words) else b"")


def _key(texts: list[str]) -> int:
    joined = "\n".join(texts).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(joined, digest_size=8).digest(), "big", signed=True)


#: In an outline: a block ends, a marked element ends; a number from 0 on begins the latter.
_BREAK, _CLOSE = -2, -1


def outline(tops: list[Node], places: dict[int, int]) -> list:
    """What may remain of the trees below ``tops``, as a flat list that JSON can hold.

    Elements in ``places`` (a number by identity) are those a template may delete: their number
    and ``_CLOSE`` stand around what they hold.  ``_BREAK`` stands where a block begins or ends.  A
    line without such an element in it is its final text; the pieces of any other are lists of one
    string, to be joined when it is known which of them remain.  Boilerplate is left out.
    """
    found: list = []
    line: list = []

    def flush() -> None:
        if any(isinstance(one, int) for one in line):
            found.extend(one if isinstance(one, int) else [one] for one in line)
        elif text := _clean(line):
            found.append(text)
        line.clear()
        if found and found[-1] != _BREAK:
            found.append(_BREAK)

    # a stack of what is still to do: nodes, strings, and for an element that ends whether it is a
    # block and whether it is marked
    pending: list = list(reversed(tops))
    while pending:
        one = pending.pop()
        if isinstance(one, str):
            line.append(one)
        elif isinstance(one, tuple):
            block, marked = one
            if block:
                flush()
            if marked:
                (found if block else line).append(_CLOSE)
        elif is_boilerplate(one):
            if one.name in BLOCK:
                flush()
        elif one.name == "br":
            line.append(" ")
        else:
            block, place = one.name in BLOCK, places.get(id(one))
            if block:
                flush()
            if place is not None:
                (found if block else line).append(place)
            if block or place is not None:
                pending.append((block, place is not None))
            pending += reversed(one.children)
    flush()
    return found


def remaining(parts: list, gone: set | frozenset = frozenset()) -> list[str]:
    """Texts of the blocks that an outline keeps without the elements numbered in ``gone``."""
    blocks: list[str] = []
    line: list[str] = []
    below = 0
    for one in parts:
        if below:
            if isinstance(one, int) and one != _BREAK:
                below += 1 if one != _CLOSE else -1
        elif isinstance(one, str):
            blocks.append(one)
        elif isinstance(one, list):
            line += one
        elif one == _BREAK:
            if text := _clean(line):
                blocks.append(text)
            line.clear()
        elif one in gone:
            below = 1
    if text := _clean(line):
        blocks.append(text)
    return blocks


def _clean(line: list[str]) -> str:
    return " ".join(html.unescape("".join(line)).split())


def _named_only(node: Node) -> bool:
    """Boilerplate by class, id or role, or a form: what may also be a wrapper around a page."""
    return not _hidden(node) if node.name not in BOILERPLATE else node.name == "form"


def _articles(root: Node) -> list[Node]:
    """The outermost articles if any has text, else the main elements if any has; none without text.

    Those outside boilerplate count, and those in wrappers: elements boilerplate by name alone
    (or forms) that hold most of the page's text, and are not made of others' posts.  If these
    have no text, all that lie in no boilerplate but named elements and forms count.
    """
    sizes: dict[int, int] = {}

    def wraps(node: Node) -> bool:
        if not sizes:
            sizes.update(_text_sizes(root))
        return 2 * sizes[id(node)] > sizes[id(root)] and not _says(node, _OTHERS)

    for enter in (wraps, lambda node: True):
        for found in _outermost(root, enter):
            if any(_has_text(one) for one in found):
                return found
    return []


def _outermost(root: Node, enter) -> tuple[list[Node], list[Node]]:
    """The outermost articles, and the main elements, not below boilerplate but for named elements
    to ``enter``."""
    articles: list[Node] = []
    mains: list[Node] = []
    pending = [(root, False)]
    while pending:
        node, inside = pending.pop()
        if node.name == "article":
            if not is_boilerplate(node):
                articles.append(node)
            continue
        if node.name == "main" and not inside:
            mains.append(node)
            inside = True
        if not is_boilerplate(node) or (_named_only(node) and enter(node)):
            pending += [(c, inside) for c in reversed(node.children) if isinstance(c, Node)]
    return articles, mains


def _text_sizes(root: Node) -> dict[int, int]:
    """Characters of text in every element, by its identity, without elements never main text."""
    order, pending = [], [root]
    while pending:
        node = pending.pop()
        order.append(node)
        pending += [c for c in node.children if isinstance(c, Node)]
    sizes: dict[int, int] = {}
    for node in reversed(order):
        size = sum(len("".join(c.split())) if isinstance(c, str) else sizes[id(c)] for c in node.children)
        sizes[id(node)] = size if node.name not in BOILERPLATE or node.name == "form" else 0
    return sizes


def _has_text(top: Node) -> bool:
    """Whether anything of an article is left without boilerplate."""
    pending: list = [top]
    while pending:
        one = pending.pop()
        if isinstance(one, str):
            if html.unescape(one).strip():
                return True
        elif not is_boilerplate(one):
            pending += reversed(one.children)
    return False


def host_of(url_col: str):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[a-zA-Z][\w+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1))


def _pages_of(pages: DataFrame, url_col: str, html_col: str, keep: list[str]) -> DataFrame:
    """The ``keep`` columns and what is needed of each page, from the only time that it is parsed:
    ``__host``, ``__whole`` (a key of the html), ``__article`` (a key of its articles' text, null
    without one), ``__digests`` (of its subtrees) and ``__outline``; a null page has no keys."""

    def compute(part: pa.RecordBatch) -> dict:
        wholes, keys, digests, outlines = [], [], [], []
        for page in part.column(html_col).to_pylist():
            root = parse(page or "")
            articles = _articles(root)
            around, inside = subtree_hashes(root), article_hashes(articles) if articles else {}
            known = sorted({*around.values(), *inside.values()})
            place = {digest: i for i, digest in enumerate(known)}
            marked = inside if articles else around
            parts = outline(articles or [root], {node: place[d] for node, d in marked.items()})
            wholes.append(None if page is None else _key([page]))
            keys.append(_key(remaining(parts)) if articles else None)
            digests.append(known)
            outlines.append(json.dumps(parts, ensure_ascii=False, separators=(",", ":")))
        return {"__whole": wholes, "__article": keys, "__digests": digests, "__outline": outlines}

    fields = [
        StructField("__whole", LongType()),
        StructField("__article", LongType()),
        StructField("__digests", ArrayType(BinaryType(), False), False),
        StructField("__outline", StringType(), False),
    ]
    hosted = pages.withColumn("__host", host_of(url_col))
    return _stored(with_computed(hosted, html_col, fields, compute, [*keep, "__host"]), "site-pages")


def _counted(occurrences: DataFrame) -> DataFrame:
    """(host, digest, n): on how many different keys a digest occurs."""
    return occurrences.distinct().groupBy("host", "digest").agg(F.count(F.lit(1)).alias("n"))


def _template_sets(part: pa.RecordBatch, host_col: str, template_col: str) -> list[frozenset]:
    """The template of each row; rows of a host share one set."""
    column, known = part.column(template_col), {}
    hosts = part.column(host_col).to_pylist()
    for i, host in enumerate(hosts):
        if host not in known:
            known[host] = frozenset(column[i].as_py() or ())
    return [known[host] for host in hosts]


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read again, so that Spark plans joins by its real size."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: In the place of a digest: counts the pages, and the articles, of a host.
_PAGES, _ARTICLES = b"pages", b"articles"


def site_templates(
    pages: DataFrame, share: float, least_pages: int, many_pages: int, least_share: float
) -> DataFrame:
    """(__at, __template): per host of ``_pages_of`` the digests of subtrees on ``least_pages`` of
    its different pages, and on ``share`` of them; of whole blocks, ``many_pages`` are enough
    whatever the share, if they are ``least_share`` of the pages.

    Outside articles, pages with the same html count once; inside, articles with the same text.
    Blocks inside articles, and those outside that only ``many_pages`` speak for, are counted a
    second time, over the articles (or pages without one) which begin differently without such
    blocks and keep ``OWN_SHARE`` of their text: a group of near copies counts little or not at
    all.  An array has at most (subtrees of a page / least_share) digests, so it is bounded by the
    pages' form, not by their number.
    """
    different = pages.filter(F.col("__whole").isNotNull())
    kind = F.substring("digest", 1, 1)
    totals_of = F.array_compact(
        F.array(F.lit(_PAGES), F.when(F.col("__article").isNotNull(), F.lit(_ARTICLES)))
    )
    in_article = (kind == F.lit(_INSIDE)) | (F.col("digest") == F.lit(_ARTICLES))
    occurrences = different.select(
        F.col("__host").alias("host"), "__whole", "__article",
        F.explode(F.concat("__digests", totals_of)).alias("digest"),
    ).select("host", "digest", F.when(in_article, F.col("__article")).otherwise(F.col("__whole")).alias("key"))
    is_total = F.col("digest").isin(_PAGES, _ARTICLES)
    counts = _stored(_counted(occurrences).filter((F.col("n") >= least_pages) | is_total), "site-counts")
    totals = counts.filter(is_total).select(
        F.col("host").alias("__of"), (F.col("digest") == F.lit(_ARTICLES)).alias("__inside"), F.col("n").alias("total")
    )
    often = F.col("n") >= share * F.col("total")
    many = (kind != F.lit(_PIECE)) & (F.col("n") >= F.greatest(F.lit(many_pages), least_share * F.col("total")))

    def enough(counted: DataFrame) -> DataFrame:
        return (
            counted.filter(~is_total & (F.col("n") >= least_pages))
            .join(totals, (F.col("host") == F.col("__of")) & ((kind == F.lit(_INSIDE)) == F.col("__inside")))
            .filter(often | many)
            .select("host", "digest", (often & (kind != F.lit(_INSIDE))).alias("sure"))
        )

    recurring = enough(counts)
    candidates = _stored(
        recurring.groupBy(F.col("host").alias("__at"))
        .agg(
            F.collect_list(F.when(~F.col("sure"), F.col("digest"))).alias("__unsure"),
            F.collect_list(F.when(F.col("sure"), F.col("digest"))).alias("__sure"),
        )
        .filter(F.size("__unsure") > 0),
        "site-candidates",
    )

    def own_occurrences(part: pa.RecordBatch) -> Iterator[tuple[str, bytes, int]]:
        columns = [part.column(name).to_pylist() for name in ("__host", "__whole", "__article", "__digests", "__outline")]
        sets = zip(_template_sets(part, "__host", "__unsure"), _template_sets(part, "__host", "__sure"), strict=True)
        for host, whole, article, digests, parts, (unsure, sure) in zip(*columns, sets, strict=True):
            found = [d for d in digests if d in unsure]
            if article is not None:
                yield from ((host, d, whole) for d in found if d[:1] != _INSIDE)
                found = [d for d in found if d[:1] == _INSIDE]
            if found:
                read = json.loads(parts)
                own = remaining(read, _places(digests, unsure | sure))
                if own and sum(map(len, own)) >= OWN_SHARE * sum(map(len, remaining(read, _places(digests, sure)))):
                    begins = _key(own[:1])
                    yield from ((host, d, begins) for d in found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "__outline"):
                rows = list(own_occurrences(part))
                hosts, digests, keys = zip(*rows, strict=True) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hosts, pa.string()), pa.array(digests, pa.binary()), pa.array(keys, pa.int64())],
                    names=["host", "digest", "key"],
                )

    again = different.join(candidates, F.col("__host") == F.col("__at")).select(
        "__host", "__whole", "__article", "__digests", "__outline", "__unsure", "__sure"
    ).mapInArrow(run, "host string, digest binary, key long")
    return (
        enough(_counted(again)).unionByName(recurring.filter("sure"))
        .groupBy(F.col("host").alias("__at")).agg(F.collect_list("digest").alias("__template"))
    )


def _places(digests: list[bytes], template: frozenset) -> set[int]:
    return {i for i, digest in enumerate(digests) if digest in template}


def extract_text(
    pages: DataFrame,
    url_col: str = "url",
    html_col: str = "html",
    share: float = 0.2,
    least_pages: int = 5,
    many_pages: int = 100,
    least_share: float = 0.001,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The ``keep`` columns of ``pages`` (all by default), ``text`` and ``n_chars`` (its code points).

    The text is that of the page's articles (else of its main element, else of its body) without
    boilerplate and without subtrees of the host's template (``site_templates``).  Character references are decoded,
    white space within a block is one space, blocks are joined by a line feed.  A null or empty
    page has the empty text.  A page whose url is null or has no host belongs to the host ''.
    Repeated rows get the same text; columns of ``pages`` named like results are replaced.

    A page is parsed once; its outline and digests wait in the shared folder, next to the ``keep``
    columns, for the host's template.  To leave the html out of ``keep`` saves writing it again.
    """
    kept = [c for c in pages.columns if keep is None or c in keep]
    parsed = _pages_of(pages, url_col, html_col, kept)
    templates = _stored(site_templates(parsed, share, least_pages, many_pages, least_share), "site-templates")
    marked = parsed.select(*kept, "__host", "__digests", "__outline").join(
        templates, F.col("__host") == F.col("__at"), "left"
    )

    def compute(part: pa.RecordBatch) -> dict:
        texts = []
        sets = _template_sets(part, "__host", "__template")
        rows = zip(part.column("__digests").to_pylist(), part.column("__outline").to_pylist(), sets, strict=True)
        for digests, parts, template in rows:
            texts.append("\n".join(remaining(json.loads(parts), _places(digests, template))))
        return {"text": texts, "n_chars": [len(t) for t in texts]}

    fields = [StructField("text", StringType(), False), StructField("n_chars", LongType(), False)]
    return with_computed(marked, "__outline", fields, compute, keep=kept)
