"""Main text of HTML pages by equivalence-class template deduction.

Pages of one host come from few templates.  A token is an opening tag with its place (the path of open elements and
their classes and ids) or a whole text block with its place.  Tokens whose occurrence vectors over the host's pages are equal
form an equivalence class.  A vector is never built: its fingerprint is a pair of sums over pages of count times a hash
of the page, which Spark adds up from partial sums, so a host with a third of all pages costs no more in one place.

A class is valid if it is large (``MEMBERS`` tokens, a tag among them), is on pages of at least ``CONTENTS`` different
contents, has its tokens in one order wherever it occurs, overlaps no other class partly, and lies in one slot of one
class (or of the page) on all pages: valid classes nest into a template.  A text of a valid class belongs to the template
if the tag that it is anchored to, the nearest landmark or element with a class, is of the same class, that is, if the
text is there whenever its container is.  Texts that merely repeat on many pages (copies of an article) have other vectors
than their container and stay content.

Extraction walks a page again.  What lies between the tokens of the template are slots; their text is kept unless one of
its elements is boilerplate by tag, role or class (menu, header, footer, sidebar, notice, advert, form, script,
comments).  If a page has an article or main element, only slots inside it count.  On a page without any slot text (all of
it is on every page of its template) the texts are kept.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

#: Least number of tokens of a class, and of different contents of the pages that it is on (told apart by 64 bits).
MEMBERS, CONTENTS = 3, 3

# Elements by what they hold.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label map mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset(
    "head script style noscript template title nav header footer aside form button select option textarea input "
    "iframe object embed svg canvas dialog menu map audio video fieldset noembed noframes xmp".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog menu menubar alert".split())
#: Words of a class or id that name boilerplate, and words that may stand beside them; any other word makes a name mean something else.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent "
    "gdpr notice alert sidebar sidenav menu navbar nav navigation breadcrumb breadcrumbs footer header masthead "
    "comment comments reply replies respond disqus social share sharing related recommended widget popup modal "
    "newsletter subscribe subscription signup login search toolbar pagination pager".split()
)
BESIDE = frozenset(
    "area bar block bottom box btn button buttons card col column container count element form global group head holder "
    "icon icons img info inner item items js label layer left line link links list main message mobile module off on "
    "outer overlay page pane panel policy primary right row secondary section site slot sm sticky text the this title top "
    "unit us wrap wrapper you".split()
)
#: Names that end in one of these are boilerplate whatever comes before, as in ``entry-footer`` or ``post-comments``.
LAST = frozenset("ad ads advert sidebar nav navigation menu footer comments share sharing breadcrumbs newsletter pagination".split())
#: Names that begin with one of the first and end in one of the second list other articles.
OTHERS = frozenset("related recommended popular trending more".split())
PIECES = frozenset("posts articles stories links items content topics reading news".split())
LANDMARKS = frozenset(["article", "main"])
#: Elements that end when another of these opens.
CLOSES = {"p": "p", "li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
CLOSES = {k: frozenset(v.split()) for k, v in CLOSES.items()}
#: Elements whose opening ends an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*(?:>|$)|<\?[^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|$)|([^<]+|<)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+", re.I)
_DIGITS = re.compile(r"\d+")

TAG, BAD_TEXT, TEXT = 0, 1, 2


def _marked(name: str) -> bool:
    """Whether one class or id names boilerplate."""
    words = _WORD.findall(name)
    if not words:
        return False
    if words[-1] in LAST or (words[0] in OTHERS and words[-1] in PIECES):
        return True
    return any(w in MARKS for w in words) and all(w in MARKS or w in BESIDE for w in words)


def _signs(attributes: str) -> tuple[str, bool]:
    """Class, id and role of a tag as text, and whether they name boilerplate."""
    if "=" not in attributes:
        return "", False
    named, bad = [], False
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "").lower()
        name = name.lower()
        named.append(f"{name}={value if name != 'id' else _DIGITS.sub('', value)}")  # ids with numbers name one element only
        bad |= value.strip() in ROLES if name == "role" else any(map(_marked, value.split()))
    return " ".join(sorted(named)), bad


class Page:
    """One walk over a page: tokens in page order (hash, kind, hash of the tag that a text is anchored to), and text blocks."""

    def __init__(self, source: str):
        self.tokens: list[tuple[int, int, int]] = []
        self.blocks: list[tuple[str, int, bool, bool]] = []  # text, place among the tokens, in boilerplate, in a landmark
        self.landmark = False
        stack: list[tuple[str, bool, bool, int, int]] = []  # tag, boilerplate, landmark, path, anchor
        inline: list[tuple[str, bool, int]] = []  # tag, boilerplate, open elements when it opened
        muted = 0
        block: list[str] = []
        top = place = (False, False, 0, 0)
        at, raw = 0, None
        size = len(source)

        def end_block() -> None:
            nonlocal block
            text = " ".join(entities.unescape("".join(block)).split()) if block else ""
            block = []
            if text:
                bad, mark, path, anchor = place
                self.blocks.append((text, len(self.tokens), bad, mark))
                self.tokens.append((xxhash.xxh3_64_intdigest(f"{path}\x00{text}"), BAD_TEXT if bad else TEXT, anchor))

        def left() -> None:
            """Inline elements end with the element that they are in."""
            nonlocal muted
            while inline and inline[-1][2] > len(stack):
                muted -= inline.pop()[1]

        while at < size:
            if raw:
                stop = re.compile(rf"</{raw}\b[^>]*(?:>|$)", re.I).search(source, at)
                at, raw = (stop.end() if stop else size), None
                continue
            m = _TOKEN.match(source, at)
            if not m:
                at += 1
                continue
            at = m.end()
            close, tag, attributes, whole, text = m.groups()
            if text is not None:
                if not muted:
                    block.append(text)
                continue
            if tag is None or not whole:
                continue
            tag = tag.lower()
            if tag in INLINE:
                if tag in VOID:
                    if tag == "br" and not muted:
                        block.append(" ")
                elif close:
                    own = next((i for i in range(len(inline) - 1, -1, -1) if inline[i][0] == tag), None)
                    if own is not None:
                        muted -= inline.pop(own)[1]
                else:
                    bad = _signs(attributes)[1]
                    inline.append((tag, bad, len(stack)))
                    muted += bad
                continue
            end_block()
            if close:
                if any(x[0] == tag for x in stack):
                    while stack.pop()[0] != tag:
                        pass
                    left()
                place = stack[-1][1:] if stack else top
                continue
            over = CLOSES.get(tag)
            while stack and ((over and stack[-1][0] in over) or (tag in ENDS_P and stack[-1][0] == "p")):
                stack.pop()
                left()
            bad0, mark0, path0, anchor0 = stack[-1][1:] if stack else top
            named, bad = _signs(attributes)
            path = xxhash.xxh3_64_intdigest(f"{path0}>{tag} {named}")
            self.tokens.append((path, TAG, 0))
            if tag in RAW:
                raw = None if attributes.rstrip().endswith("/") and tag not in ("script", "style", "title", "textarea") else tag
            elif tag not in VOID and not attributes.endswith("/"):
                good = tag in LANDMARKS and not bad0
                self.landmark |= good
                outer = not anchor0 and tag not in ("html", "body")
                anchor = path if good or named or outer else anchor0
                stack.append((tag, bad0 or tag in DROPPED or (bad and tag not in ("html", "body") and not good), mark0 or good, path, anchor))
            place = stack[-1][1:] if stack else top
        end_block()

    def main(self) -> list[tuple[str, int]]:
        """Text blocks, and their places, that are not boilerplate by what they lie in."""
        return [(t, i) for t, i, bad, mark in self.blocks if not bad and (mark or not self.landmark)]

    def text(self, template: frozenset | set = frozenset()) -> str:
        """Main text without the blocks at the places of ``template``."""
        blocks = self.main()
        return "\n".join([t for t, i in blocks if i not in template] or [t for t, _ in blocks])


def host_of(url: Column) -> Column:
    """Host of a url: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z as a-z; null or no ``://``: empty."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring({0}, instr({0}, '://') + 3)".replace("{0}", "`url`")))
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _occurrences(pages: DataFrame) -> DataFrame:
    """For each page and token: host, uid, token, kind, anchor, places, and the hash of the page's content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for host, uid, source in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                page = Page(source.as_py() or "")
                at: dict[int, list[int]] = {}
                for i, (token, _, _) in enumerate(page.tokens):
                    at.setdefault(token, []).append(i)
                content = _signed(xxhash.xxh3_64_intdigest(page.text()))
                n, firsts = len(at), [page.tokens[i[0]] for i in at.values()]
                columns = [pa.array([host.as_py()] * n, pa.string()), pa.array([uid.as_py()] * n, pa.int64()), pa.array(map(_signed, at), pa.int64())]
                columns += [pa.array([k for _, k, _ in firsts], pa.int32()), pa.array([_signed(a) for _, _, a in firsts], pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(list(at.values()), pa.list_(pa.int32())), pa.array([content] * n, pa.int64())], NAMES)

    NAMES = ["host", "uid", "token", "kind", "anchor", "places", "content"]
    return pages.select("host", "uid", "html").mapInArrow(run, "host string, uid long, token long, kind int, anchor long, places array<int>, content long")


_CLASS = ["host", "pages", "total", "one", "two"]


def _members(found: DataFrame) -> DataFrame:
    """(host, class, token, kind, anchor) of the tokens of all classes that are large and on pages of different contents."""
    n, h = F.size("places"), F.xxhash64("uid")
    sums = [F.count("*").alias("pages"), F.sum(n).alias("total"), F.sum(n * F.shiftrightunsigned(h, 32)).alias("one"), F.sum(n * h.bitwiseAND(0xFFFFFFFF)).alias("two")]
    bits = F.bit_count(F.bit_or(F.expr("shiftleft(1L, cast(pmod(content, 64) as int))")))
    all_ = found.groupBy("host", "token").agg(*sums, bits.alias("contents"), F.max("kind").alias("kind"), F.max("anchor").alias("anchor"))
    often = shared.save(all_.filter(F.col("contents") >= CONTENTS).withColumn("class", F.xxhash64(*_CLASS)).drop("contents"), "often")
    large = often.groupBy("host", "class").agg(F.count("*").alias("members"), F.count_if(F.col("kind") == TAG).alias("tags"))
    large = large.filter((F.col("members") >= MEMBERS) & (F.col("tags") > 0)).select("host", "class")
    return often.select("host", "class", "token", "kind", "anchor").join(large, ["host", "class"])


def nested(tokens: list[tuple[int, int, list[int]]], size: dict[int, int]) -> dict[int, tuple[int, bool, int]]:
    """On one page, for each class: a hash of the order of its tokens, whether it crosses another class or comes out of turn,
    and a hash of the slot that it lies in.  ``tokens``: (class, token, places); ``size``: tokens of each class on the page."""
    out: dict[int, tuple[int, bool, int]] = {}
    open_: list[list] = []  # class, tokens seen in this turn, slot
    for _, c, token in sorted((i, c, token) for c, token, places in tokens for i in places):
        at = next((j for j in range(len(open_) - 1, -1, -1) if open_[j][0] == c), None)
        if at is None:
            slot = xxhash.xxh3_64_intdigest(f"{open_[-1][0]} {len(open_[-1][1])}") if open_ else 0
            open_.append([c, [token], slot])
            at = len(open_) - 1
        else:
            for other in open_[at + 1 :]:  # not complete, though a class around it goes on
                out[other[0]] = (0, True, 0)
            del open_[at + 1 :]
            open_[at][1].append(token)
        own = open_[at]
        if len(own[1]) == size[c]:
            now = (xxhash.xxh3_64_intdigest(repr(own[1])), len(set(own[1])) != size[c], own[2])
            was = out.get(c, now)
            out[c] = now if was == now else (0, True, 0)
            open_.pop()
    for c, _, _ in open_:
        out[c] = (0, True, 0)
    return out


def _template(found: DataFrame) -> DataFrame:
    """(host, token) of the text blocks that belong to the template and are not boilerplate by what they lie in."""
    members = shared.save(_members(found), "members")
    tags = members.filter(F.col("kind") == TAG).select("host", "class", F.col("token").alias("anchor"))
    texts = shared.save(members.filter(F.col("kind") == TEXT).join(tags, ["host", "class", "anchor"]).select("host", "class", "token"), "texts")
    hosts = texts.select("host").distinct()
    # order and nesting are looked at where they decide something: on the hosts of such texts
    own = members.join(hosts, "host", "left_semi").select("host", "class", "token")
    lists = found.select("host", "uid", "token", "places").join(own, ["host", "token"])
    lists = lists.groupBy("host", "uid").agg(F.collect_set(F.struct("class", "token", "places")).alias("tokens"))  # of one page

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for host, tokens in zip(batch.column(0), batch.column(1), strict=True):
                rows = [(x["class"], x["token"], x["places"]) for x in tokens.as_py()]
                size: dict[int, int] = {}
                for c, _, _ in rows:
                    size[c] = size.get(c, 0) + 1
                got = nested(rows, size)
                columns = [[host.as_py()] * len(got), list(got), *([_signed(x[0]) for x in got.values()], [x[1] for x in got.values()], [_signed(x[2]) for x in got.values()])]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()), strict=True)], ["host", "class", "order", "crosses", "slot"])

    seen = lists.select("host", "tokens").mapInArrow(check, "host string, class long, order long, crosses boolean, slot long")
    seen = seen.groupBy("host", "class").agg(*(f(c).alias(f"{n}_{c}") for c in ("order", "slot") for n, f in (("lo", F.min), ("hi", F.max))), F.max("crosses").alias("crosses"))
    valid = seen.filter((F.col("lo_order") == F.col("hi_order")) & (F.col("lo_slot") == F.col("hi_slot")) & ~F.col("crosses"))
    return shared.save(texts.join(valid, ["host", "class"], "left_semi").select("host", "token"), "template")


def main_text(pages: DataFrame, template: bool = True) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    Character references are decoded; white space inside a block becomes one space; blocks are joined by a line
    feed in page order.  An unfinished tag or comment at the end of a page is markup.  Without ``template`` nothing is
    deduced: elements alone decide.

    A null or empty html, or one without main text, gives an empty text and 0.  Pages with a null url share the empty
    host.  Repeated rows get equal results and count as one content.  There are no ties: a text belongs to the template or
    not.  A page is walked in one piece, in memory of some 20 times its size.  Other columns are ignored, whatever their
    names; an empty table gives no rows.
    """
    spark = pages.sparkSession
    shared.ship(spark)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    pages = pages.withColumn("host", host_of(F.col("url"))).withColumn("uid", F.xxhash64("page_id", "url", "html"))
    out = "page_id long, url string, text string, n_chars long"

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            more = batch.num_columns > 3
            texts = [Page(source.as_py() or "").text(frozenset(batch.column(3)[i].as_py() or ()) if more else frozenset()) for i, source in enumerate(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    if not template:
        return pages.select("page_id", "url", "html").mapInArrow(extract, out)
    found = shared.save(_occurrences(pages), "occurrences")
    marks = found.join(_template(found), ["host", "token"], "left_semi").select("uid", F.explode("places").alias("place"))
    marks = shared.save(marks.groupBy("uid").agg(F.collect_set("place").alias("places")), "marks")  # of one page
    shared.forget(found)
    # pages without such texts pass as they are; the filter may send some others to the join, which changes nothing
    held = shared.bloom(marks.select(F.col("uid").alias("id")))
    rows = pages.select(F.col("uid").alias("doc_id"), F.col("html").alias("text"), "page_id", "url")
    plain = shared.maybe(rows, held, wanted=False, columns=["page_id", "url"]).select("page_id", "url", F.col("text").alias("html")).mapInArrow(extract, out)
    some = shared.maybe(rows, held, columns=["page_id", "url"]).join(marks.withColumnRenamed("uid", "doc_id"), "doc_id", "left")
    return plain.union(some.select("page_id", "url", F.col("text").alias("html"), "places").mapInArrow(extract, out))
