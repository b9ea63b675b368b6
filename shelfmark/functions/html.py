"""Column expressions that read links out of landed HTML.

A page is taken apart once, into the tags that matter and the text behind each. A fold over these
keeps the elements that are open, so that articles and cells may lie in each other, a cell counts
only in a row of a table, and a score is the text of its whole span. An end tag closes whatever was
left open inside its element; one without an element is passed over. Comments, scripts
and styles are no part of a page.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import strip
from shelfmark.functions.urls import is_project_url

_ATTRIBUTES = r"""(?:[^"'>]++|"[^"]*+"|'[^']*+')*+"""
TAG = rf"(?is)</?(?:article|table|tr|td|th|span|a)(?=[\s/>]){_ATTRIBUTES}>"
HIDDEN = r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>"
# Up to an attribute of a tag, past the values of those before it.
_UP_TO = r"""(?is)^<a(?:[^"'>\s]++|\s(?!{0}[\s=/>])|"[^"]*+"|'[^']*+')*+\s{0}"""
_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]*))"""
ALONE = r"""(?:^<[A-Za-z]+|[\s"'])/>$"""
HAS_HREF = _UP_TO.format("href") + r"(?=[\s=/>])"
HREF = _UP_TO.format("href") + _VALUE
NEXT_PAGE = _UP_TO.format("aria-label") + r"""\s*=\s*["']Next page["']"""
ANY_HREF = r"""(?is)<a\b[^>]*?\shref\s*=\s*["']([^"']*)["']"""
SECTION = r"(?is)<section\b[^>]*>(.*?)</section>"
ARCHIVE_HEADING = r"(?is)<h2\b[^>]*>(?:(?!</h2>).)*archive"

LINKS_TYPE = "array<struct<project_url:string,score:string>>"

# The named entities that occur in links and scores.
ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&", "nbsp": "\xa0"}
LAST_CODE_POINT = 0x10FFFF
#: A character that texts do not have, in place of a tag; a page that has it is split by the pattern itself.
MARK = "\uffff"


def bound(value: Column, use) -> Column:
    """`use(value)`, where `value` is computed once however often `use` reads it."""
    return F.get(F.transform(F.array(value), use), 0)


def _numbered(piece: Column) -> Column:
    """The character that `#39;` or `#x27;` stands for, with what follows; null where there is none."""
    hexadecimal = F.regexp_extract(piece, r"^#[xX]0*([0-9a-fA-F]{1,6});?", 1)
    decimal = F.regexp_extract(piece, r"^#0*([0-9]{1,7});?", 1)
    code = F.when(hexadecimal != "", F.conv(hexadecimal, 16, 10)).when(decimal != "", decimal).cast("long")
    real = code.between(1, LAST_CODE_POINT) & ~code.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(F.when(real, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
    rest = F.regexp_replace(piece, r"^#(?:[xX][0-9a-fA-F]+|[0-9]+);?", "")
    return F.when(code.isNotNull(), F.concat(char, rest))


def unescaped(c: Column) -> Column:
    """Text with its entities, named (as above) and numeric, as the characters they stand for."""
    named = lambda p: F.coalesce(
        *[F.when(p.startswith(f"{name};"), F.concat(F.lit(mark), p.substr(F.lit(len(name) + 2), F.length(p)))) for name, mark in ENTITIES.items()],
        F.when(p.startswith("#"), _numbered(p)),
        F.concat(F.lit("&"), p),
    )
    whole = lambda pieces: F.array_join(F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(named(p))), "")
    return F.when(c.contains("&"), whole(F.split(c, "&"))).otherwise(c)


def page_tags(html: Column) -> Column:
    """The tags that matter, in order, as structs: name, whether it ends or stands alone, its address if it links, the text behind it."""
    # Spark compiles the pattern of a split for every row, that of a replacement once for all.
    between = lambda clean: F.when(clean.contains(MARK), F.split(clean, TAG)).otherwise(F.split(F.regexp_replace(clean, TAG, MARK), MARK))
    parts = lambda clean: F.arrays_zip(
        F.regexp_extract_all(clean, F.lit(TAG), F.lit(0)).alias("tag"), F.slice(between(clean), 2, 1 << 30).alias("text")
    )

    def address(t: Column, first: Column) -> Column:
        others = F.concat(*[F.regexp_extract(t, HREF, k) for k in (2, 3)])
        return F.when(first != "", unescaped(first)).otherwise(bound(others, unescaped))

    def read(part: Column) -> Column:
        t = part["tag"]
        link = t.startswith("<a") | t.startswith("<A")
        return F.struct(
            F.lower(F.regexp_extract(t, r"^</?([A-Za-z]+)", 1)).alias("name"),
            t.startswith("</").alias("ends"),
            (t.endswith("/>") & t.rlike(ALONE)).alias("alone"),
            F.when(link & t.rlike(HAS_HREF), bound(F.regexp_extract(t, HREF, 1), lambda first: address(t, first))).alias("href"),
            F.coalesce(link & t.rlike(NEXT_PAGE), F.lit(False)).alias("next"),
            part["text"].alias("text"),
        )

    clean = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, "<!>")
    return F.transform(bound(clean, parts), read)


_OPEN = "array<struct<at:int,kind:string,nth:int,url:string,span:int,score:string>>"
_DONE = "array<struct<nth:int,kind:string,url:string,score:string>>"
_STATE = f"struct<stack:array<string>,open:{_OPEN},done:{_DONE}>"


def _stripped_pieces(text: Column) -> Column:
    """Pieces of text between tags, each without white space around it, as one."""
    return F.array_join(F.transform(F.split(text, "<[^>]*>"), lambda p: strip(unescaped(p))), "")


def _step(state: Column, tag: Column) -> Column:
    """The open elements after one more tag. `span` is 0 before an item's first span, its depth within, -1 behind."""
    stack, opened, done = state["stack"], state["open"], state["done"]
    item = lambda o, **new: F.struct(*[new.get(c, o[c]).alias(c) for c in ("at", "kind", "nth", "url", "span", "score")])
    depth = F.size(stack)

    # A start tag: one more element, an item if it is an article or a cell in a row of a table.
    last = lambda name: depth - F.array_position(F.reverse(stack), name).cast("int") + 1
    first_table = F.array_position(stack, "table").cast("int")
    in_row = F.array_contains(stack, "tr") & (first_table > 0) & (first_table < last("tr"))
    kind = F.when(tag["name"] == "article", "article").when(tag["name"].isin("td", "th") & in_row, "cell")
    fresh = F.struct(
        (depth + 1).cast("int").alias("at"), kind.alias("kind"), (F.size(opened) + F.size(done)).cast("int").alias("nth"),
        F.lit(None).cast("string").alias("url"), F.lit(0).alias("span"), F.lit("").alias("score"),
    )
    with_item = F.when(kind.isNotNull(), F.array_append(opened, fresh)).otherwise(opened)
    first_span = F.when(tag["alone"], -1).otherwise(depth + 1)
    in_span = F.transform(opened, lambda o: item(o, span=F.when(o["span"] == 0, first_span).otherwise(o["span"])))
    linked = F.transform(opened, lambda o: item(o, url=F.coalesce(o["url"], tag["href"])))
    started = F.when(tag["name"] == "a", F.when(tag["href"].isNotNull(), linked).otherwise(opened)).when(tag["name"] == "span", in_span).when(tag["alone"], opened).otherwise(with_item)
    stack_more = F.when(tag["alone"], stack).otherwise(F.array_append(stack, tag["name"]))

    def shown(items: Column) -> Column:
        add = lambda o: item(o, score=F.when(o["span"] > 0, F.concat(o["score"], _stripped_pieces(tag["text"]))).otherwise(o["score"]))
        return F.when(F.exists(items, lambda o: o["span"] > 0), F.transform(items, add)).otherwise(items)

    def after(stack: Column, items: Column, done: Column) -> Column:
        return F.struct(stack.alias("stack"), bound(items, shown).alias("open"), done.alias("done"))

    def ended(at: Column) -> Column:
        """An end tag: everything from its element on, which is the last of its name, is closed."""
        left = F.transform(F.filter(opened, lambda o: o["at"] < at), lambda o: item(o, span=F.when(o["span"] >= at, -1).otherwise(o["span"])))
        finished = F.concat(done, _finished(F.filter(opened, lambda o: o["at"] >= at)))
        closed = after(F.slice(stack, F.lit(1), at - 1), left, finished)
        return F.when(at <= depth, closed).otherwise(after(stack, opened, done))

    return F.when(tag["ends"], bound(last(tag["name"]), ended)).otherwise(after(stack_more, started, done))


def _finished(items: Column) -> Column:
    return F.transform(items, lambda o: F.struct(o["nth"].alias("nth"), o["kind"].alias("kind"), o["url"].alias("url"), o["score"].alias("score")))


def page_items(tags: Column) -> Column:
    """All articles and cells of a page in order: (nth, kind, url of the first link or null, score)."""
    empty = F.struct(F.array().cast("array<string>").alias("stack"), F.array().cast(_OPEN).alias("open"), F.array().cast(_DONE).alias("done"))
    whole = lambda state: F.array_sort(F.concat(state["done"], _finished(state["open"])))
    folded = lambda them: F.when(F.exists(them, lambda t: t["href"].isNotNull()), F.aggregate(them, empty, _step, whole))
    return F.coalesce(bound(tags, folded), F.array().cast(_DONE))


def projects_of(items: Column) -> Column:
    """Article format; the table format, which has no score, only when a page holds no article project."""

    def listed(them: Column, kind: str, score) -> Column:
        of_kind = F.filter(them, lambda i: (i["kind"] == kind) & is_project_url(i["url"]))
        return F.transform(of_kind, lambda i: F.struct(i["url"].alias("project_url"), score(i).alias("score")))

    def first(them: Column) -> Column:
        cells = listed(them, "cell", lambda i: F.lit(""))
        return bound(listed(them, "article", lambda i: i["score"]), lambda articles: F.when(F.size(articles) > 0, articles).otherwise(cells))

    return bound(items, first).cast(LINKS_TYPE)


def page_projects(html: Column) -> Column:
    return projects_of(page_items(page_tags(html)))


def links_to_next(tags: Column) -> Column:
    return F.exists(tags, lambda t: t["next"])


def has_next_page(html: Column) -> Column:
    return links_to_next(page_tags(html))


def hrefs(html: Column) -> Column:
    return F.transform(F.regexp_extract_all(html, F.lit(ANY_HREF), 1), unescaped)


def archive_hrefs(html: Column) -> Column:
    """Links of the section whose heading names the archive; all links if there is none. No section in a section."""
    sections = F.regexp_extract_all(html, F.lit(SECTION), 1)
    archive = F.get(F.filter(sections, lambda s: s.rlike(ARCHIVE_HEADING)), 0)
    return hrefs(F.coalesce(archive, html))
