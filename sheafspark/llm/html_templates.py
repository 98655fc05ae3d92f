"""Main text of web pages: templates of a host from equivalence classes of tokens, and the slots that remain."""

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafspark.llm.arrow_text import each
from sheafspark.storage import written_table

#: A class counts if it occurs on so many pages of a host, and on this part of them.
LEAST_PAGES = 4
LEAST_SHARE = 0.05
#: Text is template text if its class is valid and stands on this part of the pages of a host that has at least so many;
#: the class that frames the pages stands on the larger part.
TEXT_PAGES = 8
TEXT_SHARE = 0.5
FRAME_SHARE = 0.8

# Names of HTML elements, and words of class, id and role attributes.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
_BOILERPLATE = frozenset(
    "head title nav aside footer form dialog menu button select option textarea fieldset datalist search".split()
)
_WORDS = frozenset(
    "ad ads adsense adslot advert advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices popup modal overlay newsletter subscribe subscription signup sidebar sidebars widget widgets menu "
    "menus nav navbar navigation breadcrumb breadcrumbs pagination pager footer footnav toolbar topbar masthead comment "
    "comments disqus respond replies discussion share sharing social related recommended recommendations login search "
    "copyright disclaimer alert alertdialog dialog contentinfo complementary menubar skip".split()
)
_OUTSIDE = frozenset("header banner masthead".split())
# Inside marked text only whole names of class and role count, and few of id.
_PARTS = _WORDS | frozenset(
    "ad-container ad-slot ad-unit ad-wrapper comment-form comment-list comments-area comments-section cookie-banner "
    "cookie-notice disqus_thread newsletter-signup related-articles related-links related-posts share-buttons share-links "
    "social-share".split()
)
_IDS = frozenset("breadcrumb breadcrumbs comment-list comments cookie-notice disqus_thread newsletter pagination respond sidebar".split())
_CONTAINERS = frozenset("blockquote center details div dl fieldset figure ol section table ul".split())
_NO_ID = frozenset("h1 h2 h3 h4 h5 h6 section".split())
_CODE = frozenset("code kbd samp tt var".split())
_NEGATED = re.compile(r"(?:no|not|non|has|with|without|is|hide|show)[-_]")
_MAIN = frozenset(
    "main content article post story main-content page-content article-body article-content post-body post-content "
    "entry-content story-body articlebody".split()
)
_ARTICLE = 2
_NEUTRAL = frozenset("html body main article".split())
_CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "thead", "tbody", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
_KEEPS_P = frozenset("br option title head html body".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|template|iframe|svg|object|canvas|audio|video)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)(?:>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|([^<]+|<)",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_LETTERS = re.compile(r"[a-z]+")


def _named_boilerplate(tag: str, values: dict[str, str], main: int) -> bool:
    """Whether class, id and role name an element boilerplate; inside marked text only whole names of containers do."""
    named = {n for k in ("class", "role") for n in values.get(k, "").split()}
    ids = set() if tag in _NO_ID else set(values.get("id", "").split())
    if main:
        inline = tag not in _BLOCK
        return (inline or tag in _CONTAINERS) and bool(named & (_PARTS - _OUTSIDE) or (not inline and ids & _IDS))
    if tag not in _BLOCK:
        return bool(named & _PARTS)
    return any(w in _WORDS or w in _OUTSIDE for n in named | ids if not _NEGATED.match(n) for w in _LETTERS.findall(n))


def _hash(text: str) -> int:
    """An even number; tokens of texts are odd."""
    return (xxhash.xxh64_intdigest(text) & ~1) - (1 << 63)


class Element:
    """An open element: its name, path, and whether its text is boilerplate, main text (2 article, 1 marked) or a link."""

    __slots__ = ("tag", "path", "boiler", "main", "named")

    def __init__(self, tag: str, path: int, boiler: bool, main: int, named: bool):
        self.tag, self.path, self.boiler, self.main, self.named = tag, path, boiler, main, named


class Block:
    """A run of text between block borders."""

    __slots__ = ("text", "path", "boiler", "main", "linked", "part")

    def __init__(self, text: str, path: int, boiler: bool, main: int, linked: bool, part: int):
        self.text, self.path, self.boiler, self.main, self.linked = text, path, boiler, main, linked
        self.part = part  # the number of the outermost marked element it lies in

    def token(self) -> int:
        return _hash(f"{self.path} {self.text}") | 1


_ROOT = Element("", 0, False, 0, False)


class PageParser:
    """Reads pages into blocks and their sequence of tokens: start tags of block elements by path, and text by path.

    Start tags below the same path are looked up, as pages of a site repeat them.
    """

    def __init__(self):
        self.memo: dict = {}

    def _opened(self, parent: Element, tag: str, attributes: str, first_main: bool, code: bool = False) -> Element:
        key = (parent.path, parent.boiler, parent.main, parent.named, tag, attributes, first_main, code)
        found = self.memo.get(key)
        if found is None:
            values = {m[0].lower(): (m[1] or m[2] or m[3]).lower() for m in _ATTRIBUTE.findall(attributes)}
            names = " ".join(v for k, v in values.items() if k != "itemprop")
            main, boiler, named = parent.main, parent.boiler, parent.named
            if tag == "article" or (tag not in _BOILERPLATE and values.get("role") == "article"):
                main = 2
            elif tag == "main" or values.get("role") == "main" or values.get("itemprop") == "articlebody":
                main = max(main, 1)
            elif tag in ("div", "section", "td") and set(names.split()) & _MAIN:
                main = max(main, 1)
            sure = "role" in values or "itemprop" in values or values.get("id") in _MAIN
            sure = (main and tag in ("article", "main")) or (main > parent.main and sure)
            if sure and first_main and boiler and named:
                boiler = False  # a wrapper's class does not make the page's first article boilerplate
            elif tag in _BOILERPLATE or (tag == "header" and not main):
                boiler = True
            elif tag not in _NEUTRAL and not code and _named_boilerplate(tag, values, main):
                boiler, named = True, named or not boiler
            names = re.sub(r"\d+", "0", names)
            found = Element(tag, _hash(f"{parent.path} {tag} {names}"), boiler, main, named)
            if len(self.memo) > 100_000:
                self.memo.clear()
            self.memo[key] = found
        return found

    def parse(self, page: str) -> tuple[list[Block], list[int]]:
        stack, blocks, tokens = [_ROOT], [], []
        runs: list[str] = []
        muted: list = []  # name and depth of an inline boilerplate element
        links = linked = chars = part = code = 0
        first_main = True

        def close_block():
            nonlocal linked, chars
            if runs:
                text = " ".join(html.unescape("".join(runs)).split())
                if text:
                    top = stack[-1]
                    blocks.append(Block(text, top.path, top.boiler, top.main, 2 * linked > chars, part if top.main else 0))
                    if not top.boiler:
                        tokens.append(blocks[-1].token())
                runs.clear()
            linked = chars = 0

        def close_to(names, borders):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in names:
                    del stack[i:]
                    return
                if stack[i].tag in borders:
                    return

        for found in _TOKEN.finditer(page):
            text = found[8]
            if text is not None:
                if muted:
                    continue
                runs.append(text)
                chars += len(text)
                linked += len(text) if links else 0
                continue
            end, tag, attributes = (found[2], found[3], found[4]) if found[3] else (found[5], found[6], found[7])
            if tag is None:  # comment, declaration or an element whose content is no text
                continue
            if found.end() == len(page) and page[-1] != ">":
                continue  # cut inside a tag
            tag = tag.lower()
            if tag == "a":
                links = 0 if end else 1
            if tag not in _BLOCK and tag not in _BOILERPLATE:
                # inline elements do not end a block, but their class can make boilerplate of them, except in code
                if tag in _CODE:
                    code = max(0, code + (-1 if end else 1))
                if muted and tag == muted[0]:
                    muted[1:] = [muted[1] + (-1 if end else 1)]
                    if not muted[1]:
                        muted.clear()
                elif not muted and not end and tag not in _VOID and "=" in (attributes or ""):
                    if self._opened(stack[-1], tag, attributes, False).boiler and not stack[-1].boiler:
                        if not code and all(e.tag != "pre" for e in stack):
                            muted[:] = [tag, 1]
                continue
            close_block()
            muted.clear()
            if end:
                code = 0
                if any(e.tag == tag for e in stack):
                    while stack.pop().tag != tag:
                        pass
                continue
            if tag in _CLOSED_BY:
                close_to(*_CLOSED_BY[tag])
            elif tag not in _KEEPS_P and stack[-1].tag == "p":
                stack.pop()
            if tag in _VOID:
                continue
            links = code = 0
            outer = stack[-1].main
            stack.append(self._opened(stack[-1], tag, attributes or "", first_main, any(e.tag == "pre" for e in stack)))
            part += 1 if stack[-1].main and not outer else 0
            if stack[-1].main and not stack[-1].boiler:
                first_main = False
            tokens.append(stack[-1].path)
        close_block()
        return blocks, tokens


def main_text(blocks: list[Block], template: set[int]) -> str:
    """The text of the slots that hold the article.

    The template of the host says which texts are no slot, marks choose among the slots; a marked part that is template
    text only is kept, and so is all text of an article: headings such as "Method" may repeat on a site. Around an article, the rest of the marked part it lies in counts as well. On a page without marks
    mostly linked text is left out, unless there is a template of the host, which then decides.
    """
    free = [b for b in blocks if not b.boiler]
    level = max((b.main for b in free), default=0)
    parts = {b.part for b in free if b.main == level}
    marked = [b for b in free if b.main == level or (b.main and b.part in parts)]
    own = [b for b in marked if b.main == _ARTICLE or b.token() not in template]
    if level:
        return "\n".join(b.text for b in own or marked)
    return "\n".join(b.text for b in own if template or not b.linked)


def host_of(url: Column) -> Column:
    """The host in lower case; null where the url has none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def page_tokens(pages: DataFrame) -> DataFrame:
    """(host, page, sequence, tokens, counts) of pages (host, page, html): all tokens in order, and each with its count."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = PageParser()
        for batch in each(batches):
            sequences = [parser.parse(page.as_py())[1] for page in batch.column(2)]
            counted = [Counter(s) for s in sequences]
            columns = [sequences, [list(c) for c in counted], [list(c.values()) for c in counted]]
            arrays = [pa.array(x, pa.list_(pa.int64())) for x in columns]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], ["host", "page", "sequence", "tokens", "counts"])

    return pages.select("host", "page", "html").mapInArrow(
        parse, "host string, page long, sequence array<long>, tokens array<long>, counts array<long>"
    )


def equivalence_classes(tokens: DataFrame) -> DataFrame:
    """(host, pages, class, support, members) of the large and frequent classes of each host.

    Tokens of a host with the same occurrence vector, their counts by page, make a class. The vector is summed up as
    two numbers over hashes of page and count, so it is gathered with partial sums and never held whole. Members of a
    class stand on the same pages, so there are at most as many as one page has tokens; as a class needs a share of the
    pages, a host has a bounded number of them, too.
    """
    one = tokens.select("host", "page", F.explode(F.arrays_zip("tokens", "counts")).alias("t"))
    exact = "decimal(38,0)"
    vectors = one.groupBy("host", F.col("t.tokens").alias("token")).agg(
        F.count("*").alias("support"),
        F.sum("t.counts").alias("times"),
        F.sum(F.xxhash64("page", "t.counts").cast(exact)).alias("v1"),
        F.sum(F.xxhash64("t.counts", "page", F.lit(1)).cast(exact)).alias("v2"),
    )
    sizes = written_table(tokens.where(F.size("sequence") > 0).groupBy("host").agg(F.count("*").alias("pages")), "host-pages")
    frequent = vectors.where(F.col("support") >= LEAST_PAGES).join(sizes, "host")
    frequent = frequent.where(F.col("support") >= F.col("pages") * LEAST_SHARE)
    return frequent.groupBy("host", "pages", "support", "times", F.xxhash64("v1", "v2").alias("class")).agg(
        F.sort_array(F.collect_list("token")).alias("members")
    )


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page and class: the order of its members, and the slot of the host's frame it lies in, if the page has it."""
    for batch in batches:
        out = []
        for host, sequence, classes in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            of = {m: c["class"] for c in classes for m in c["members"]}
            frames = [c for c in classes if c["support"] == c["times"] >= FRAME_SHARE * c["pages"]]
            root = max(frames, key=lambda c: (c["support"], len(c["members"]), c["class"]), default=None)
            framed = root is None or root["members"][0] in set(sequence)
            seen: dict[int, list[int]] = {}
            slots: dict[int, set[int]] = {}
            slot = 0
            for token in sequence:
                own = of.get(token)
                if own is None:
                    continue
                seen.setdefault(own, []).append(token)
                if root is not None and own == root["class"]:
                    slot = token
                else:
                    slots.setdefault(own, set()).add(slot)
            for own, order in seen.items():
                first = list(dict.fromkeys(order))
                # ordered: the members repeat one and the same order
                regular = order == first * (len(order) // len(first))
                within = slots.get(own, {0})
                out.append((host, own, _hash(repr(first)) if regular else None, min(within) if len(within) == 1 else None, framed))
        columns = list(zip(*out, strict=True)) or [()] * 5
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        names = ["host", "class", "order", "slot", "framed"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def host_templates(tokens: DataFrame) -> DataFrame:
    """(host, pages, nodes): the nested valid classes of each host, for a stored table of :func:`page_tokens`.

    The frame is the class that stands once on most pages, and on FRAME_SHARE of them at least. A class is valid if its
    members keep one order on all pages and, apart from the frame, lie within one slot between two neighbouring members
    of the frame on all pages that have it. A node has its class, support, slot and members.
    """
    classes = written_table(equivalence_classes(tokens), "token-classes")
    by_host = classes.groupBy("host").agg(
        F.collect_list(F.struct("class", "members", "support", "times", "pages")).alias("classes")
    )
    by_host = written_table(by_host, "host-classes")
    checked = tokens.select("host", "sequence").join(by_host, "host").select("host", "sequence", "classes")
    orders = checked.mapInArrow(_orders, "host string, class long, order long, slot long, framed boolean")
    valid = (
        orders.groupBy("host", "class")
        .agg(
            F.min("order").alias("lo"),
            F.max("order").alias("hi"),
            F.min(F.expr("CASE WHEN framed THEN slot END")).alias("slot"),
            F.max(F.expr("CASE WHEN framed THEN slot END")).alias("slot_hi"),
            F.count("order").alias("n"),
            F.count_if(F.col("framed") & F.col("slot").isNull()).alias("n_split"),
            F.count("*").alias("all"),
        )
        .where("lo = hi AND n = all AND slot <=> slot_hi AND n_split = 0")
        .select("host", "class", "slot")
    )
    nodes = classes.join(valid, ["host", "class"])
    return nodes.groupBy("host", "pages").agg(F.collect_list(F.struct("class", "support", "times", "slot", "members")).alias("nodes"))


def template_texts(templates: DataFrame) -> DataFrame:
    """(host, dropped): texts of the valid classes on TEXT_SHARE of the pages, nested ones too, and all members of the
    frame, for hosts with enough pages."""
    node = templates.where(F.col("pages") >= TEXT_PAGES).select("host", "pages", F.explode("nodes").alias("n"))
    frequent = node.where(F.col("n.support") >= F.col("pages") * TEXT_SHARE)
    frame = (F.col("n.support") == F.col("n.times")) & (F.col("n.support") >= F.col("pages") * FRAME_SHARE)
    gone = F.when(frame, F.col("n.members")).otherwise(F.filter("n.members", lambda m: m.bitwiseAND(F.lit(1).cast("long")) == 1))
    return frequent.groupBy("host").agg(F.flatten(F.collect_list(gone)).alias("dropped"))


def extract_main_text(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars): the article of every row of ``pages``, a stored table.

    Text blocks are ended by block elements and line breaks; character references are decoded, white space becomes one
    space, and blocks are joined by one line break. Scripts, styles, menus, headers, footers, sidebars, notices,
    adverts, forms and reader comments are left out, by element and by the words of class, id and role; so is what
    the template of the host shows to be no slot. Null and empty pages give the empty text;
    pages without a host are read without a template. Repeated rows give repeated rows; an empty table an empty table.
    """
    read = pages.select(
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{url}`").alias("url"),
        host_of(F.col(f"`{url}`")).alias("host"),
        F.coalesce(F.col(f"`{body}`"), F.lit("")).alias("html"),
    )
    numbered = read.where(F.col("host").isNotNull()).select("host", F.xxhash64("key", "url").alias("page"), "html")
    tokens = written_table(page_tokens(numbered), "page-tokens")
    dropped = written_table(template_texts(host_templates(tokens)), "host-template-texts")
    joined = read.join(dropped, "host", "left").select("key", "url", "html", "dropped")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = PageParser()
        for batch in each(batches):
            texts = [
                main_text(parser.parse(page.as_py())[0], set(gone.as_py() or ()))
                for page, gone in zip(batch.column(2), batch.column(3), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["key", "url", "text"])

    kind = pages.schema[key].dataType.simpleString()
    out = joined.mapInArrow(extract, f"key {kind}, url string, text string")
    return out.select(F.col("key").alias(key), F.col("url").alias(url), "text", F.length("text").cast("long").alias("n_chars"))
