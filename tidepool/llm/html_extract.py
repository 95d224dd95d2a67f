"""Main text of pages by template deduction with equivalence classes.

1. A page is a sequence of tokens: tags (told apart by their path from the
   root) and the text runs between them. Over all different pages of a host
   (equal html counts once, under however many ids) every token has an
   occurrence vector: how often it stands in each page. The vector is kept as
   its checksum, a sum over pages, summed up in each task before it is shuffled.
   All copies of a page meet in one task, but of one with very many copies only
   one goes there and the others are spread.
2. Tokens of one host with equal vectors form an equivalence class. Classes
   that occur on enough pages and have enough tokens are candidates.
3. In each page a candidate class is valid if its tokens stand in the host's
   order and the class nests in the others: all of it lies between two
   neighbouring tokens of any class around it. Valid classes are the template;
   what stands between their tokens are the slots.
4. Text runs that belong to the template go, whatever they say, but not those
   in the article's slot (<article>, or <main> that has none in it), not those
   that stand on a part only of the pages with their element, and none in a page
   where nothing would differ from the template. Slots in a part
   of the template that is not the article (menu, header, footer, sidebar,
   notice, advert, form, script, style, comments, told by element and by class,
   id and role) go; the text of the remaining slots is the result. A class
   counts by its whole name or its first or last part ("site-nav", not
   "content-sidebar-wrap" or "has-sidebar"); an id inside an article or on a
   section is a slug and counts whole, on a heading not at all. A mark on a
   wrapper doesn't stand against what it wraps: it is lifted around <main>,
   around the articles of a page whose articles are all marked, and where most
   of the page's slot text outside links stands (there not for comments,
   cookie notices and adverts).

A page whose host has too few pages for classes gets the last rule alone.

Defined results: a null or empty html gives an empty text; a URL without host is
a host of its own ("none"). Repeated rows get equal texts; a null page_id passes
through; extra columns are not read; an empty table gives an empty result.
Markup that is cut off, unclosed or wrongly nested is read as browsers do in
the main: what a tag opens ends with its parent, and an open comment or tag at
the end is dropped.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.llm.common import query, read
from tidepool.llm.url_filter import host_of

#: A class must occur on this many pages, and on this share of its host's pages, and have so many tokens.
MIN_PAGES, MIN_SHARE, MIN_TOKENS = 5, 0.3, 4
#: Text runs are template text only on hosts with so many pages that have them.
MIN_TEXT_PAGES = 10
#: Text runs are template text only if they stand on this share of the pages with their element.
MIN_TEXT_SHARE = 0.9
#: Copies of a page beyond so many are spread over tasks.
MANY_COPIES = 200

# Elements by what they mean (HTML standard).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption"
                   " figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary"
                   " table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCKS - frozenset("html head body td th tr tbody thead tfoot caption".split())
NOT_ARTICLE = frozenset("nav footer aside form script style head title noscript template iframe svg object button select"
                        " textarea dialog menu canvas audio video label option datalist xmp noembed noframes annotation annotation-xml".split())
#: Of these, parts that can wrap an article by mistake; the others hold no text that a page shows as such.
WRAPPERS = frozenset("nav footer aside header form menu dialog".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words in class, id or role that mark a part as no article.
NOT_ARTICLE_WORDS = frozenset("nav navbar navigation menu header footer masthead sidebar aside ad ads adv advert adverts advertisement"
                              " banner cookie cookies consent notice gdpr promo promoted sponsor sponsored comment comments disqus respond"
                              " replies share sharing social related recommended newsletter subscribe signup breadcrumb breadcrumbs"
                              " pagination pager popup modal overlay widget login search skip toolbar alert contentinfo complementary"
                              " dialog form toc legal copyright".split())
#: Of these, parts whose text can outgrow the article's.
NEVER_ARTICLE_WORDS = frozenset("ad ads adv advert adverts advertisement cookie cookies consent gdpr sponsor sponsored"
                                " comment comments disqus respond replies".split())
#: A name with one of these tells what a layout has, not what the part is.
LAYOUT_WORDS = frozenset("has with no without".split())
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("ul ol dl table select article section div body html main nav aside footer header form blockquote td th".split())

_TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[/!?][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)""", re.S)
_MARKS = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


class Node:
    """An open element: its name, its path, the marked elements it is or is in, whether it is in <article> or <main>,
    in <article>, in a link, its outermost <main>; of a marked element, its kind and whether <main> or an outermost
    <article> is in it, the latter of a <main> as well."""
    __slots__ = ("name", "path", "marked", "main", "article", "link", "top_main", "kind", "has_main", "has_article", "lifted")

    def __init__(self, name: str, path: str, top: Node | None = None, kind: str = ""):
        self.name, self.path, self.kind = name, path, kind
        self.marked: tuple = (*(top.marked if top else ()), *((self,) if kind else ()))
        self.article = name == "article" or bool(top and top.article)
        self.main = self.article or name == "main" or bool(top and top.main)
        self.link = name == "a" or bool(top and top.link)
        self.has_main = self.has_article = self.lifted = False
        self.top_main = top and top.top_main or (self if name == "main" else None)
        if name == "main" or name == "article" and not top.article:
            for x in (*top.marked, *([top.top_main] if top.top_main else [])):
                x.has_main |= name == "main"
                x.has_article |= name == "article"

    @property
    def out(self) -> bool:
        """Whether it is outside the article."""
        return any(not x.lifted for x in self.marked)

    @property
    def slot(self) -> bool:
        """Whether it is in the article's slot."""
        return self.article or self.main and not self.top_main.has_article


#: What a task remembers, at most so many entries each. Plain dicts travel with the functions; cached functions would
#: need the package on every executor.
REMEMBERED = 1 << 16
_SAID: dict[tuple, frozenset] = {}
_TAG_IDS: dict[str, int] = {}


def _remember(known: dict, key, value):
    if len(known) >= REMEMBERED:
        known.clear()
    known[key] = value
    return value


def _said(value: str, whole: bool, words: frozenset = NOT_ARTICLE_WORDS) -> frozenset:
    """The words among ``words`` that a class, id or role says."""
    key = (value, whole, words)
    if key in _SAID:
        return _SAID[key]
    found = set()
    for name in value.split():
        parts = _WORD.findall(name)
        if parts and LAYOUT_WORDS.isdisjoint(parts):
            found |= words.intersection([name] if whole else [name, parts[0], parts[-1]])
    return _remember(_SAID, key, frozenset(found))


def _kind(name: str, attributes: list[tuple[str, str]], main: bool) -> str:
    """Why an element is no article: "hidden" or "wrapper" by element, "form", "never" or "name" by what it is called, "" if it isn't so."""
    if name in NOT_ARTICLE or (name == "header" and not main):
        return "form" if name == "form" else "wrapper" if name in WRAPPERS else "hidden"
    if name in ("html", "body", "article", "main"):
        return ""
    said: set[str] = set()
    for kind, value in attributes:
        if kind != "id" or name not in HEADINGS:
            said |= _said(value, kind == "id" and (main or name == "section"))
    if main:
        said -= {"header", "masthead"}  # as <header>
    return "" if not said else "name" if NEVER_ARTICLE_WORDS.isdisjoint(said) else "never"


def tokens(page: str) -> Iterator[tuple]:
    """The page's tokens: ("tag", path, node, name) and ("text", text, node, None)."""
    stack = [Node("#", "")]
    at = 0
    raw = None
    while at <= len(page):
        if raw:  # up to its end tag, nothing is markup
            close = re.compile(rf"</{raw}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else len(page)
            if stack[-1].name == raw:
                stack.pop()
            raw = None
        m = _TOKEN.search(page, at)
        if text := page[at:m.start() if m else len(page)]:
            yield "text", text, stack[-1], None
        if not m:
            return
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            # An end tag closes its element and all inside; one that closes nothing is ignored.
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    del stack[i:]
                    break
                if name not in BLOCKS and stack[i].name in BLOCKS:
                    break
            yield "tag", f"{stack[-1].path}/{name}!", stack[-1], name
            continue
        if name in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == "p":
                    del stack[i:]
                    break
                if stack[i].name in BLOCKS:
                    break
        if same := _SAME.get(name):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in same:
                    del stack[i:]
                    break
                if stack[i].name in _SCOPE:
                    break
        attributes = [(kind.lower(), (a or b or c).lower()) for kind, a, b, c in _MARKS.findall(m[3])] if m[3] else []
        marks = " ".join(value for _, value in attributes)
        top = stack[-1]
        node = Node(name, f"{top.path}/{name}{'.' + marks if marks else ''}", top, _kind(name, attributes, top.main))
        yield "tag", node.path, node, name
        if name not in VOID and not m[3].endswith("/"):
            stack.append(node)
            raw = name if name in RAW else None


def _clean(text: str) -> str:
    return _SPACE.sub(" ", html.unescape(text)).strip()


def _hash(*parts) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(map(str, parts)).encode(errors="replace"), digest_size=8).digest(), "little", signed=True)


def _tag_id(path: str) -> int:
    known = _TAG_IDS.get(path)
    return _remember(_TAG_IDS, path, _hash("tag", path)) if known is None else known


def _text_id(path: str, text: str) -> int | None:
    """The id of a text run, None if it is white space only."""
    text = _SPACE.sub(" ", text).strip()
    return _hash("text", path, text) if text else None


def roles(found: list[tuple]) -> list[int | None]:
    """The ids of a page's tokens; None for white space."""
    return [_tag_id(value) if kind == "tag" else _text_id(node.path, value) for kind, value, node, _ in found]


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch, host and token: pages, the vector's checksum, the sum of relative first places, the parent's token if it is text.

    Equal pages of a host count once; all that are no ``spare`` copy are in this task.
    """
    done: set[tuple] = set()
    for batch in batches:
        seen: dict[tuple, list] = {}
        hosts, pages, digests, spare = (batch.column(i) for i in (2, 3, 4, 5))
        for i in range(batch.num_rows):
            host, digest = hosts[i].as_py(), digests[i].as_py()
            if spare[i].as_py() or (host, digest) in done:
                continue
            done.add((host, digest))
            found = [t for t in tokens(pages[i].as_py() or "") if t[0] == "tag" or not t[1].isspace()]
            ids = roles(found)
            counts = Counter(ids)
            first = {}
            for k, t in enumerate(ids):
                first.setdefault(t, k)
            for t, n in counts.items():
                kind, _, node, _ = found[first[t]]
                x = seen.setdefault((host, t), [0, 0, 0.0, _tag_id(node.path) if kind == "text" else None])
                x[0] += 1
                x[1] = (x[1] + _hash(digest, n)) & 0xFFFFFFFFFFFFFFFF
                x[2] += first[t] / len(ids)
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.int64()), pa.array([v[0] for v in seen.values()], pa.int64()),
             pa.array([signed(v[1]) >> 20 for v in seen.values()], pa.int64()), pa.array([v[1] & 0xFFFFF for v in seen.values()], pa.int64()),
             pa.array([v[2] for v in seen.values()], pa.float64()), pa.array([v[3] for v in seen.values()], pa.int64())],
            names=["host", "token", "pages", "high", "low", "place", "parent"])


def templates(pages: DataFrame, n: DataFrame) -> DataFrame:
    """Per host: the tokens of its large classes, in the host's order, each with its class (host, template).

    ``pages`` as :func:`extract` deals them, ``n`` the number of different pages (host, host_pages).
    """
    found = pages.mapInArrow(_vectors, "host string, token long, pages long, high long, low long, place double, parent long")
    # Both parts of the checksum are summed without overflow.
    found = (found.groupBy("host", "token").agg(F.sum("pages").alias("pages"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"),
                                                F.sum("low").alias("low"), F.sum("place").alias("place"), F.max("parent").alias("parent"))
             .withColumn("is_text", F.col("parent").isNotNull())
             .filter((F.col("pages") >= F.when(F.col("is_text"), MIN_TEXT_PAGES).otherwise(MIN_PAGES))))
    vector = F.xxhash64("pages", "high", "low")
    found = found.join(n, "host").filter(F.col("pages") >= MIN_SHARE * F.col("host_pages"))
    element = Window.partitionBy("host", F.coalesce("parent", "token"))
    found = found.withColumn("parent_pages", F.max(F.when(~F.col("is_text"), F.col("pages"))).over(element))
    # An element without a tag of its own (the root) stands on all pages.
    found = found.filter(~F.col("is_text") | (F.col("pages") >= MIN_TEXT_SHARE * F.coalesce("parent_pages", "host_pages")))
    classes = (found.groupBy("host", vector.alias("class"))
               .agg(F.collect_list(F.struct((F.col("place") / F.col("pages")).alias("place"), "token", "is_text")).alias("members"))
               .filter(F.size("members") >= MIN_TOKENS))
    return classes.groupBy("host").agg(F.array_sort(F.flatten(F.collect_list(F.transform("members", lambda m: F.struct(
        m["place"].alias("place"), m["token"].alias("token"), F.col("class").alias("class"), m["is_text"].alias("is_text")))))).alias("template"))


def valid_classes(ids: list[int | None], order: dict[int, int], of: dict[int, int]) -> set[int]:
    """The classes whose tokens stand in the host's order in this page and which nest in one another.

    A class is ordered if its first occurrences rise with the host's order and
    its occurrences repeat that sequence. Two classes nest if all of one lies in
    one gap of the other.
    """
    places: dict[int, list[int]] = {}
    for i, t in enumerate(ids):
        if t in of:
            places.setdefault(of[t], []).append(i)
    good: dict[int, list[int]] = {}
    for c, at in places.items():
        cycle = list(dict.fromkeys(ids[i] for i in at))
        ranks = [order[t] for t in cycle]
        if ranks == sorted(ranks) and all(ids[i] == cycle[j % len(cycle)] for j, i in enumerate(at)):
            good[c] = at
    out: set[int] = set()
    # The largest first; a class that crosses one that is in stays out.
    for c in sorted(good, key=lambda c: (-len(good[c]), c)):
        lo, hi = good[c][0], good[c][-1]
        if all(sum(lo < i < hi for i in good[d]) == 0 or not any(good[d][0] < i < good[d][-1] for i in good[c]) for d in out) or len(good[c]) == 1:
            out.add(c)
    return out


def lift(found: list[tuple], constant: list[bool]) -> None:
    """Lifts the marks that stand against the article; ``constant`` tells which tokens are template text."""
    nodes = {id(t[2]): t[2] for t in found if t[2].marked}
    marked = {id(x): x for n in nodes.values() for x in n.marked if x.kind != "hidden"}.values()
    if not marked:
        return
    shown = lambda n: all(x.kind != "hidden" for x in n.marked)
    for x in marked:
        x.lifted = x.has_main
    articles = [t[2] for t in found if t[0] == "tag" and t[2].name in ("main", "article")]
    if articles and all(n.out for n in articles):
        for x in marked:
            x.lifted |= x.has_article
    whole, held = 0, Counter()
    runs = [(n, len(value.strip())) for (kind, value, n, _), c in zip(found, constant) if kind == "text" and not c and not n.link
            and all(x.lifted or x.kind in ("form", "name") for x in n.marked) and shown(n)]
    if any(n.main and size for n, size in runs):
        runs = [(n, size) for n, size in runs if n.main]
    for n, size in runs:
        whole += size
        for x in n.marked:
            held[id(x)] += size
    for x in marked:
        x.lifted |= x.kind in ("form", "name") and 2 * held[id(x)] > whole


def main_text(page: str, template: list[tuple] = ()) -> str:
    """The article's text; ``template`` lists (place, token, class, is_text) in the host's order."""
    found = list(tokens(page))
    constant: set[int] = set()
    ids: list[int | None] = []
    if template:
        ids = roles(found)
        of = {t: c for _, t, c, _ in template}
        valid = valid_classes(ids, {t: i for i, (_, t, _, _) in enumerate(template)}, of)
        constant = {t for _, t, c, is_text in template if is_text and c in valid}
    dropped = [t in constant and not node.slot for t, (_, _, node, _) in zip(ids, found)] or [False] * len(found)
    lift(found, dropped)
    text = _text(found, dropped)
    # A template is told by what differs from it; an article's slot that is empty tells enough.
    if text or not any(dropped) or any(node.main for _, _, node, _ in found):
        return text
    return main_text(page)


def _text(found: list[tuple], dropped: list[bool]) -> str:
    blocks: dict[bool, list[str]] = {True: [], False: []}
    parts: list[str] = []
    where = False

    def flush():
        nonlocal parts
        if text := _clean("".join(parts)):
            blocks[where].append(text)
        parts = []

    for i, (kind, value, node, name) in enumerate(found):
        if kind == "tag":
            if name in BLOCKS:
                flush()
            elif name in ("br", "wbr") or name in VOID:
                parts.append(" " if name == "br" else "")
            continue
        if dropped[i] or node.out:
            continue
        if node.main != where:
            flush()
            where = node.main
        parts.append(value)
    flush()
    return "\n\n".join(blocks[True] or blocks[False])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last: tuple = (None, ())
    for batch in batches:
        texts = []
        hosts, pages, found = batch.column(2), batch.column(3), batch.column(4)
        for i in range(batch.num_rows):
            host = hosts[i].as_py()
            if last[0] != host or host is None:
                last = (host, [(x["place"], x["token"], x["class"], x["is_text"]) for x in found[i].as_py() or ()])
            texts.append(main_text(pages[i].as_py() or "", last[1]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(host_of(F.col("url")), F.lit("none")).alias("host"), "html")
    rows = rows.withColumn("digest", F.xxhash64("html"))
    copies = rows.groupBy("host", "digest").agg(F.count("*").alias("copies"), F.min(F.struct("page_id", "url")).alias("one"))
    n = copies.groupBy("host").agg(F.count("*").alias("host_pages"))
    # At most one row in MANY_COPIES.
    many = copies.filter(F.col("copies") > MANY_COPIES).select(F.col("host").alias("h"), F.col("digest").alias("d"), "one")
    rows = rows.join(F.broadcast(many), (F.col("host") == F.col("h")) & (F.col("digest") == F.col("d")), "left")
    spare = F.col("one").isNotNull() & ~F.struct("page_id", "url").eqNullSafe(F.col("one"))
    # The template of a host with many pages goes to many tasks, and the pages with it, copies together.
    salts = 32
    rows = rows.select("page_id", "url", "host", "html", "digest", spare.alias("spare")).withColumn(
        "salt", F.pmod(F.when(F.col("spare"), F.xxhash64("page_id", "url")).otherwise(F.col("digest")), F.lit(salts)).cast("int"))
    # One exchange of all columns serves the vectors and the join.
    rows = rows.repartition("host", "salt")
    found = templates(rows, n).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    joined = rows.join(found, ["host", "salt"], "left")
    return joined.select("page_id", "url", "host", "html", "template", "digest", "spare").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long")


_BLOCK_TAGS = "|".join(sorted(BLOCKS))
ORACLE = rf"""
with a as (
  select page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)(?:</article>|$)', 1, 's') as body from pages),
b as (
  select page_id, url, string_split(regexp_replace(body, '</?(?:{_BLOCK_TAGS})(?:\s[^>]*)?>', chr(1), 'g'), chr(1)) as blocks from a),
c as (
  select page_id, url, list_filter(list_transform(blocks, lambda x: trim(regexp_replace(
    replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(x, '<br[^>]*>', ' ', 'g'), '<[^>]*>', '', 'g'), '<[a-zA-Z/!][^>]*$', ''),
      '&quot;', '"'), '&middot;', '·'), '&copy;', '©'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g'))), lambda x: x <> '') as blocks from b)
select page_id, url, array_to_string(blocks, chr(10) || chr(10)) as text, length(array_to_string(blocks, chr(10) || chr(10)))::bigint as n_chars from c
"""


@query("op1_html_extraction", oracle=ORACLE)
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(read(spark, sf_dir, "pages"))
