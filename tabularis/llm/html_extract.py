"""HTML main text by consensus host paths.

1. Each page is read once into blocks of text under containers. Every container gets a score: the text of
   its own blocks less twice their link text, plus half of what its child containers hold.
2. A container votes for its generalised path (tags and class names from the body down, digits
   replaced; what lies above the last step as a hash, so that a path's length does not grow with its depth), with its score as a share of the page's best; Spark adds the votes by host and path and
   takes the winning path of each host.
3. Each page is read again and gives the blocks under the containers on its host's winning path; a page
   without that path gives those of its own best container. So does a page where that path holds less than ``MINOR``
   of the best score, if the best container's path is a further template of the host: best on at least two pages,
   on half of the pages that have it and on a hundredth of the host's pages.
4. From there a page climbs to the highest container whose other parts are text and not links, so that an
   article in several containers is whole. The climb ends at an article or main and below the body, except
   for a body that is made of sections. Other containers right under the body join if their path is a partner of the winning
   one, with a twentieth of the best score at least on half of the host's pages, and they are prose here: ``LEAD``
   characters at least, a quarter of it links at most.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are left out
by tag, role, class and id wherever they stand. Character references are decoded, white space inside a block
becomes one space, blocks are trimmed and joined in page order by a line feed; nothing else is dropped or cut.

The winning paths, one row a host, are broadcast up to ``BROADCAST`` bytes; beyond, pages meet them by host and one of
``SALTS`` salts, so that a host of most pages is many tasks either way.

Cases: null and empty html gives the empty text; broken markup is closed as it goes; containers may be nested to any depth
(work and memory follow the length of the page); a null url or one without a host votes in the host ''; repeated rows each
give a row; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularis.llm.common import lean, pick, small_batches, written

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|iframe|svg|title)\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(?<![\w=-])(hidden)(?![\w-])")
SPACE = re.compile(r"\s+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("body div article main section td center details dd figure".split())
LEAF_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dt ul ol dl table tr th thead tbody tfoot caption figcaption address hr summary fieldset legend".split())
OTHER_BLOCKS = frozenset("html head nav header footer aside form menu dialog select option button".split())
BLOCKS = CONTAINERS | LEAF_BLOCKS | OTHER_BLOCKS
ASIDE_TAGS = frozenset("nav header footer aside form menu dialog select button head object canvas audio video map".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar toolbar".split())
ASIDE_WORDS = frozenset(
    """ad ads advert adverts advertisement advertising adsense adsbygoogle sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices
    alert sidebar side rail aside menu nav navbar navigation breadcrumb breadcrumbs share sharing social comment comments commentlist respond replies reply disqus
    discussion related recommended newsletter subscribe subscription signup login footer foot header masthead topbar popup modal overlay widget widgets toolbar
    pagination pager copyright legal skip hidden paywall teaser""".split()
)
ASIDE_STARTS = ("advert", "adslot", "adunit", "adbox", "sponsor", "comment", "sidebar", "cookie", "newsletter", "breadcrumb", "promo", "subscri", "footer", "navbar", "navlink", "disclaimer", "announcement")
NOT_ASIDE = frozenset("with has no without".split())
NEVER_ASIDE = frozenset("html body article main".split())
#: A start tag closes the open element of these tags, up to the nearest container.
CLOSES = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
SCOPE = frozenset("html body div article main section ul ol dl table aside nav header footer form blockquote".split())
MINOR = 0.25
LEAD = 100
BROADCAST, SALTS = 8 << 20, 32
HOST = r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?(?i:www\.)?([^/?#:]*)"
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


class Node:
    __slots__ = ("tag", "parent", "path", "aside", "link", "box", "depth", "story")

    def __init__(self, tag: str, parent: Node | None, path: str, aside: bool, link: bool, box: Node | None):
        self.tag, self.parent, self.path, self.aside, self.link = tag, parent, path, aside, link
        self.box = box if box is not None else self  # nearest container, itself included
        self.depth = 0 if parent is None else parent.box.depth + (box is None)
        self.story = tag in ("article", "main") or parent is not None and parent.story  # within an article or main


def _names(attributes: str) -> tuple[str, str, bool]:
    """Class names, id and whether the element is put aside by its attributes."""
    classes = ident = ""
    aside = False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = (m[1] or m[5]).lower(), m[2] or m[3] or m[4] or ""
        if name == "class":
            classes = value
        elif name == "id":
            ident = value
        elif name == "role":
            aside = aside or value.strip().lower() in ASIDE_ROLES
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", "").lower():
            aside = True
    return classes, ident, aside


def _set_aside(names: str) -> bool:
    for token in names.split():
        words = {w.lower() for w in WORD.findall(token)}
        if not words & NOT_ASIDE and (words & ASIDE_WORDS or any(w.startswith(ASIDE_STARTS) for w in words)):
            return True
    return False


def _general(tag: str, classes: str) -> str:
    kinds = sorted({re.sub(r"[0-9]+", "#", c.lower()) for c in classes.split()})
    return ".".join([tag, *kinds])


class Page:
    """Blocks (container, text, link characters) of a page in order, and its containers."""

    def __init__(self, html: str):
        self.boxes: list[Node] = []
        self.blocks: list[tuple[Node, str, int]] = []
        self._parts: list[str] = []
        self._links = 0
        root = Node("html", None, "0:", False, False, None)
        self.boxes.append(root)
        self._top = root
        at = 0
        for m in TOKEN.finditer(html):
            if m.start() > at:
                self._text(html[at : m.start()])
            at = m.end()
            tag = (m[3] or m[6] or "").lower()
            if not tag:
                continue
            if m[2] or m[5]:
                self._close(tag)
            else:
                self._open(tag, m[4] if m[3] else m[7])
        if at < len(html):
            self._text(html[at:])
        self._end_block()

    def _text(self, text: str) -> None:
        if not self._top.aside:
            self._parts.append(text)
            if self._top.link:
                self._links += len(text)

    def _end_block(self) -> None:
        if self._parts:
            text = SPACE.sub(" ", entities.unescape("".join(self._parts))).strip()
            if text:
                self.blocks.append((self._top.box, text, min(self._links, len(text))))
            self._parts, self._links = [], 0

    def _open(self, tag: str, attributes: str) -> None:
        if tag in VOID:
            if tag in BLOCKS:
                self._end_block()
            elif tag == "br":
                self._text(" ")
            return
        if tag in BLOCKS:
            self._end_block()
            closes = CLOSES.get(tag, {"p"})
            node, last = self._top, None
            while node.parent is not None and (node.tag not in SCOPE or node.tag in closes):
                if node.tag in closes:
                    last = node
                node = node.parent
            if last is not None:
                self._top = last.parent
        up = self._top
        classes, ident, aside = _names(attributes) if attributes.strip() else ("", "", False)
        if tag not in NEVER_ASIDE:
            inside = tag == "header" and up.story
            aside = aside or tag in ASIDE_TAGS and not inside or bool(classes or ident) and _set_aside(f"{classes} {ident}")
        else:
            aside = False
        is_box = tag in CONTAINERS
        path = f"{up.box.depth + 1}:{xxhash.xxh64_hexdigest(up.box.path)}/{_general(tag, classes)}" if is_box else up.path
        node = Node(tag, up, path, up.aside or aside, up.link or tag == "a", None if is_box else up.box)
        if is_box and not node.aside:
            self.boxes.append(node)
        self._top = node

    def _close(self, tag: str) -> None:
        if tag == "br":
            self._text(" ")
            return
        if tag in BLOCKS:
            self._end_block()
        node = self._top
        while node.parent is not None:
            if node.tag == tag:
                self._top = node.parent
                return
            if node.tag in SCOPE and tag not in SCOPE:
                return  # a stray end tag does not close the container around it
            node = node.parent

    def scores(self) -> dict[int, float]:
        """Score of every container that has text, by its place in ``boxes``."""
        place = {id(b): i for i, b in enumerate(self.boxes)}
        own: dict[int, float] = {}
        for box, text, links in self.blocks:
            own[place[id(box)]] = own.get(place[id(box)], 0.0) + max(0.0, len(text) - 2.0 * links)
        total: dict[int, float] = dict(own)
        for i, s in own.items():
            up = self.boxes[i].parent
            up = up.box if up is not None else None
            if up is not None and id(up) in place:
                total[place[id(up)]] = total.get(place[id(up)], 0.0) + s / 2
        return {i: s for i, s in total.items() if s > 0}

    def votes(self) -> dict[str, float]:
        scores = self.scores()
        best = max(scores.values(), default=0.0)
        out: dict[str, float] = {}
        for i, s in scores.items():
            path = self.boxes[i].path
            out[path] = max(out.get(path, 0.0), s / best)
        return out

    def whole(self, chosen: set[int], partners: Sequence[str] = ()) -> set[int]:
        """Adds the containers above ``chosen`` whose other parts are text and not links, and partners beside them in the body."""
        place = {id(b): i for i, b in enumerate(self.boxes)}
        up = [place.get(id(b.parent.box), -1) if b.parent is not None else -1 for b in self.boxes]
        size, links = [0] * len(up), [0] * len(up)
        for box, text, linked in self.blocks:
            size[place[id(box)]] += len(text)
            links[place[id(box)]] += linked
        linky = lambda i: size[i] > 0 and 2 * links[i] >= size[i]
        bad = [int(linky(i)) for i in range(len(up))]  # parts of a container that are links
        apart = [int(size[i] > 0) for i in range(len(up))]  # parts with text that are not sections
        for i in range(len(up) - 1, 0, -1):  # containers stand after the ones around them
            if up[i] >= 0 and size[i]:
                size[up[i]] += size[i]
                links[up[i]] += links[i]
                bad[up[i]] += linky(i)
                apart[up[i]] += self.boxes[i].tag != "section"
        out, below = set(chosen), set()
        for i in (place[b] for b in chosen):
            while self.boxes[i].tag not in NEVER_ASIDE and (u := up[i]) >= 0 and id(self.boxes[u]) not in out:
                top = self.boxes[u].tag in ("html", "body")
                if bad[u] > linky(i) or top and apart[u]:
                    if top:
                        below.add(u)
                    break
                out.add(id(self.boxes[u]))
                i = u
        for i, u in enumerate(up):
            if u in below and self.boxes[i].path in partners and size[i] >= LEAD and 4 * links[i] <= size[i]:
                out.add(id(self.boxes[i]))
        return out

    def text(self, path: str | None, others: Sequence[str] = (), partners: Sequence[str] = ()) -> str:
        """Blocks under the containers on ``path``, or under the page's own best container."""
        scores = self.scores()
        best = self.boxes[max(scores, key=lambda i: (scores[i], -i))] if scores else None
        chosen = {id(b) for b in self.boxes if b.path == path} if path is not None else set()
        if chosen and best is not None and best.path in others:
            held = max((x for i, x in scores.items() if self.boxes[i].path == path), default=0.0)
            if held < MINOR * max(scores.values()):
                chosen = {id(b) for b in self.boxes if b.path == best.path}
        if not chosen:
            if best is None:
                return ""
            chosen = {id(best)}
        chosen = self.whole(chosen, partners)
        under: dict[int, bool] = {}
        for box in self.boxes:  # containers stand after the ones around them
            under[id(box)] = id(box) in chosen or box.parent is not None and under.get(id(box.parent.box), False)
        return "\n".join(text for box, text, _ in self.blocks if under[id(box)])


def host_of(url: str) -> Column:
    """The host of a url, without www., in lower case; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), HOST, 1))


def _vote_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        hosts, paths, shares = [], [], []
        for host, html in zip(b.column("host").to_pylist(), b.column("html"), strict=True):
            for path, share in Page(html.as_py() or "").votes().items():
                hosts.append(host)
                paths.append(path)
                shares.append(round(share * 1e6))
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(shares, pa.int64())], names=["host", "path", "share"])


def _text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = zip(b.column("html"), b.column("path"), b.column("others"), b.column("partners"), strict=True)
        texts = [Page(html.as_py() or "").text(path.as_py(), others.as_py() or (), partners.as_py() or ()) for html, path, others, partners in found]
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, path, others, partners): the path with the most votes of each host, the paths of its further templates, and
    those that hold text beside the best container on half of its pages.

    Equal votes go to the path nearer to the body, then the smaller one.
    """
    votes = pick(pages, "url", "html").select(host_of("url").alias("host"), "html").mapInArrow(lean(_vote_rows), "host string, path string, share long")
    summed = votes.groupBy("host", "path").agg(F.sum("share").alias("share"), F.count("*").alias("seen"), F.count_if(F.col("share") == 1_000_000).alias("best"), F.count_if(F.col("share") >= 50_000).alias("fair"))
    summed = written(summed, "html-votes")
    rank = F.struct(F.col("share"), -F.split("path", ":")[0].cast("int"), F.col("path"))
    hosts = summed.groupBy("host").agg(F.max_by("path", rank).alias("path"), F.sum("best").alias("pages"))
    strong = summed.where("best >= 2 and 2 * best >= seen").select("host", F.col("path").alias("other"), "best")
    others = strong.join(hosts, "host").where("other <> path and 100 * best >= pages").groupBy("host").agg(F.sort_array(F.collect_list("other")).alias("others"))
    fair = summed.where("fair > 0").select("host", F.col("path").alias("partner"), "fair").join(hosts, "host")
    fair = fair.where("partner <> path and 2 * fair >= pages").groupBy("host").agg(F.sort_array(F.collect_list("partner")).alias("partners"))
    return hosts.join(others, "host", "left").join(fair, "host", "left").select("host", "path", "others", "partners")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page."""
    small_batches(pages.sparkSession)
    p = pick(pages, "page_id", "url", "html")
    types = {f.name: f.dataType.simpleString() for f in p.schema.fields}
    found = written(winning_paths(pages), "html-paths")
    held = found.agg(F.sum(F.length("host") + F.length("path") + sum((F.coalesce(F.length(F.array_join(c, "")), F.lit(0)) for c in ("others", "partners")), F.lit(0)))).first()[0] or 0
    hosts = p.withColumn("host", host_of("url"))
    if held <= BROADCAST:
        joined = hosts.join(F.broadcast(found), "host", "left")
    else:
        salted = hosts.withColumn("salt", F.pmod(F.xxhash64("html"), F.lit(SALTS)))
        joined = salted.join(found.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))), ["host", "salt"], "left")
    joined = joined.select("page_id", "url", "html", "path", "others", "partners")
    return joined.mapInArrow(lean(_text_rows), f"page_id {types['page_id']}, url string, text string")
