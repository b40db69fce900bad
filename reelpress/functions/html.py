"""Column functions that read HTML inside Catalyst.

A page is cut into tags and texts once, and one fold over the tags keeps the open elements (``outline``). Titles,
bodies and links by any selector are read from that. An end tag closes all elements opened since its start tag.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelpress.functions.text import decode_entities

# ---- fixed values -----------------------------------------------------------------------
NO_TITLE = "No title found"
NO_CONTENT = "No content found"
#: body text of this length or less does not count as an article
MIN_BODY = 100
#: where a title is looked for: (selector of an ancestor or None, tag), in this order
TITLE_PLACES = [
    (None, "h1"), ("story-title", "h1"), ("article-title", "h1"), ("post-title", "h1"),
    ("entry-title", "h1"), (None, "title"), ("headline", "h1"), ("*title", "h1"),
]
#: selectors of the body element, in this order: a class, ``*`` and part of a class, or a tag
CONTENT_PLACES = [
    "story-content", "article-content", "post-content", "entry-content", "content",
    "<article>", "story-body", "article-body", "post-body", "entry-body", "*content", "*body",
]
#: selectors of elements whose links are taken besides marked links
LINK_PLACES = ["story-card", "article-card", "<h2>", "<h3>"]
#: parts of a URL that mark an article
ARTICLE_MARKS = ["/202", "/story/", "/article/"]
#: elements without content, which no end tag closes
VOID = "area base br col embed hr img input link meta param source track wbr".split()
# -----------------------------------------------------------------------------------------

SCRIPTS = r"(?is)<(?:script|style)\b[^>]*>.*?</(?:script|style)\s*>"
COMMENTS = r"(?s)<!--.*?-->"
TAGS = r"(?s)<[^>]*>"
_SPACE = r"[\s\x1c-\x1f\x0b\x{85}\x{a0}\p{Z}]+"
OUTER_SPACE = f"^{_SPACE}|{_SPACE}$"
FIRST_HEADING = r"(?is)<h1\b[^>]*>(.*?)</h1\s*>"
PAGE_TITLE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"
FIRST_ARTICLE = r"(?is)<article\b[^>]*>(.*?)</article\s*>"
HREF = r"(?is)<a\s[^>]*?href=\"([^\"]*)\""


# ---- outline of a page -------------------------------------------------------------------

#: one tag; quotes count after an equals sign only, and ``<`` before anything else is text
TAG = (
    r"(?s)<[A-Za-z][^\s/>]*+(?:[^>=]*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])))*+[^>]*+>"
    r"|</[A-Za-z][^>]*+>|<[!?][^>]*+>"
)
#: scripts and styles, whose tags stay, and comments; what opens first counts, and what is not closed goes on
#: to the end of the page
UNREAD = r"(?is)<!--.*?(?:-->|\z)|(<(script|style)\b[^>]*+>).*?(</\2\s*>|\z)"
_TAG_NAME = r"^</?([A-Za-z][^\s/>]*)"
_VALUE = r"(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>][^\s>]*+)"
_PLACES = list(
    dict.fromkeys([above for above, _ in TITLE_PLACES if above] + CONTENT_PLACES + LINK_PLACES)
)
_HIDDEN = len(_PLACES)
_PUSH, _ALONE, _END, _OTHER = 0, 1, 2, 3
#: tags folded at a time: what a fold has put out is copied at each step, so it is kept short
_BLOCK = 256


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is looked into."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _attribute(tag: Column, name: str) -> Column:
    """Value of the first attribute of that name in a start tag, in any quotes; else empty."""
    other = rf"[\s/]*+(?!{name}\s*+=)[^\s/>=]++(?:\s*+=\s*+{_VALUE})?+"
    pattern = (
        rf"(?is)^<[a-z][^\s/>]*+(?:{other})*+[\s/]*+{name}\s*+=\s*+"
        r"(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>][^\s>]*+))"
    )
    return F.concat(*[F.regexp_extract(tag, pattern, n) for n in (1, 2, 3)])


def _bits(tag_name: Column, classes: Column) -> Column:
    """One bit for each selector that names the element; ``classes`` has a space around every class."""
    by_class, by_tag = F.lit(0), F.when(tag_name == "template", 1 << _HIDDEN).otherwise(0)
    for n, place in enumerate(_PLACES):
        bit = F.lit(1 << n)
        if place.startswith("<"):
            by_tag = by_tag + F.when(tag_name == place[1:-1], bit).otherwise(0)
        else:
            held = place[1:] if place.startswith("*") else f" {place} "
            by_class = by_class + F.when(F.contains(classes, F.lit(held)), bit).otherwise(0)
    return by_tag + F.when(classes == "", 0).otherwise(by_class)


def _read_tag(tag: Column) -> Column:
    """Name, kind and selector bits of a tag, and the target of a link."""
    name = F.lower(F.regexp_extract(tag, _TAG_NAME, 1))

    def read(name: Column) -> Column:
        opens = (name != "") & ~F.startswith(tag, F.lit("</"))
        kind = (
            F.when(name == "", _OTHER)
            .when(~opens, _END)
            .when(F.endswith(tag, F.lit("/>")) | name.isin(VOID), _ALONE)
            .otherwise(_PUSH)
        )
        given = F.when(opens & tag.rlike(r"(?i)class\s*="), _attribute(tag, "class")).otherwise("")
        spaced = F.when(given == "", "").otherwise(
            F.concat(F.lit(" "), F.regexp_replace(given, r"\s", " "), F.lit(" "))
        )
        bits = _let(spaced, lambda classes: F.when(opens, _bits(name, classes)).otherwise(0))
        href = F.when(opens & (name == "a"), decode_entities(_attribute(tag, "href")))
        return F.struct(
            name.alias("name"), kind.alias("kind"), bits.alias("own"), href.alias("href")
        )

    return _let(name, read)


def _nesting(tags: Column) -> Column:
    """For each tag how many elements are open after it, and the selector bits of these.

    One fold over the tags keeps the open elements, the innermost first. An end tag closes all that was opened since
    its start tag; without one it is ignored.
    """
    def state(names: Column, above: Column, out: Column) -> Column:
        return F.struct(names.alias("names"), above.alias("above"), out.alias("out"))

    def top(above: Column) -> Column:
        return F.coalesce(F.get(above, F.lit(0)), F.lit(0))

    def step(now: Column, tag: Column) -> Column:
        names, above = now["names"], now["above"]
        inner = tag["own"].bitwiseOR(top(above))
        at = F.array_position(names, tag["name"]).cast("int")

        def after(names: Column, above: Column, depth: Column, bits: Column) -> Column:
            here = F.struct(depth.alias("depth"), bits.alias("bits"))
            return state(names, above, F.concat(now["out"], F.array(here)))

        # no variable for the new state: Spark copies what a lambda variable gets, element by element
        opened = after(
            F.concat(F.array(tag["name"]), names), F.concat(F.array(inner), above), F.size(names) + 1, inner
        )
        closed = after(
            F.slice(names, at + 1, F.size(names)),
            F.slice(above, at + 1, F.size(names)),
            F.size(names) - at,
            F.coalesce(F.get(above, at), F.lit(0)),
        )
        return (
            F.when(tag["kind"] == _PUSH, opened)
            .when((tag["kind"] == _END) & (at > 0), closed)
            .otherwise(after(names, above, F.size(names), top(above)))
        )

    def block(now: Column, part: Column) -> Column:
        none = F.array().cast("array<struct<depth:int,bits:int>>")
        return F.aggregate(
            part,
            state(now["names"], now["above"], none),
            step,
            lambda new: state(
                new["names"], new["above"], F.concat(now["out"], F.array(new["out"]))
            ),
        )

    start = state(
        F.array().cast("array<string>"),
        F.array().cast("array<int>"),
        F.array().cast("array<array<struct<depth:int,bits:int>>>"),
    )
    last = F.floor((F.size(tags) - 1) / _BLOCK).cast("int")
    blocks = F.transform(
        F.when(F.size(tags) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>")),
        lambda n: F.slice(tags, n * _BLOCK + 1, F.lit(_BLOCK)),
    )
    return F.aggregate(blocks, start, block, lambda done: F.flatten(done["out"]))


def outline(html: Column) -> Column:
    """Texts, depths and chosen elements of a page, from one tokenisation and one fold over its tags.

    A struct of ``texts`` (what stands before, between and after the tags), ``depth`` (open elements after each
    tag) and ``found``: elements that a selector may ask for, in document order, with their place ``i`` among the tags,
    ``name``, ``own`` and ``outer`` selector bits (of the element, and of all it lies in) and ``href``. The work grows
    with the tags times the elements open at once. Null is an empty page. Of repeated attributes the first counts.
    """
    read = F.regexp_replace(F.coalesce(html, F.lit("")), UNREAD, "$1$3")

    def of_page(page: Column) -> Column:
        pieces = F.split(page, TAG, -1)
        tags = F.transform(F.regexp_extract_all(page, F.lit(TAG), F.lit(0)), _read_tag)
        return _let(tags, lambda t: _let(_nesting(t), lambda nested: chosen(pieces, t, nested)))

    def chosen(pieces: Column, tags: Column, nested: Column) -> Column:
        def outer(i: Column) -> Column:
            return F.when(i > 0, F.get(nested, i - 1)["bits"]).otherwise(0)

        texts = F.transform(
            pieces,
            lambda piece, i: F.when(
                outer(i).bitwiseAND(F.lit(1 << _HIDDEN)) > 0, ""
            ).otherwise(piece),
        )
        asked = F.filter(
            F.transform(
                tags,
                lambda tag, i: F.when(
                    (tag["own"] > 0) | (tag["kind"] < _END) & tag["name"].isin("a", "h1", "title"),
                    F.struct(
                        i.alias("i"), tag["name"].alias("name"), tag["own"].alias("own"),
                        outer(i).alias("outer"), tag["href"].alias("href"),
                        (tag["kind"] == _PUSH).alias("holds"),
                    ),
                ),
            ),
            lambda element: element.isNotNull(),
        )
        return F.struct(
            texts.alias("texts"), nested["depth"].alias("depth"), asked.alias("found")
        )

    return _let(read, of_page)


def _named(element: Column, bits: str, place: str) -> Column:
    return element[bits].bitwiseAND(F.lit(1 << _PLACES.index(place))) > 0


def _first_text(page: Column, test) -> Column:
    """Text of the first chosen element that passes; null if there is none."""
    def text(element: Column) -> Column:
        i = element["i"]
        after = F.slice(page["depth"], i + 2, F.size(page["depth"]))
        own = F.get(page["depth"], i)
        closed = F.array_position(F.transform(after, lambda d: d < own), F.lit(True)).cast("int")
        pieces = F.when(closed > 0, closed).otherwise(F.size(after) + 1)
        inside = F.array_join(F.slice(page["texts"], i + 2, pieces), "")
        return F.when(
            element["holds"], F.regexp_replace(decode_entities(inside), OUTER_SPACE, "")
        ).otherwise("")

    first = F.slice(F.filter(page["found"], test), 1, 1)
    return F.get(F.transform(first, text), F.lit(0))


def _first(values: Column, test) -> Column:
    return F.get(F.filter(values, test), F.lit(0))


def title_of(page: Column) -> Column:
    """Text of the first title place whose first element has any, else a fixed remark."""
    def found(above: str | None, tag: str) -> Column:
        def test(element: Column) -> Column:
            named = element["name"] == tag
            return named if above is None else named & _named(element, "outer", above)

        return _first(F.array(_first_text(page, test)), lambda t: (t != "") & (t != NO_TITLE))

    return F.coalesce(*(found(above, tag) for above, tag in TITLE_PLACES), F.lit(NO_TITLE))


def article_of(page: Column) -> Column:
    """Text of the first body place whose first element has enough of it, else a fixed remark."""
    def found(place: str) -> Column:
        text = F.array(_first_text(page, lambda element: _named(element, "own", place)))
        return _first(text, lambda t: F.length(t) > MIN_BODY)

    return F.coalesce(*map(found, CONTENT_PLACES), F.lit(NO_CONTENT))


def links_of(page: Column, marks: Sequence[str] = tuple(ARTICLE_MARKS)) -> Column:
    """Link targets with a mark, mark by mark, then those in elements that list articles, place by place."""
    def of_anchors(anchors: Column) -> Column:
        marked = ranked_links(anchors["href"], marks)

        def inside(place: str) -> Column:
            return F.filter(anchors, lambda anchor: _named(anchor, "outer", place))["href"]

        return F.concat(marked, *map(inside, LINK_PLACES))

    return _let(F.filter(page["found"], lambda element: element["name"] == "a"), of_anchors)


def page_parts(html: Column, **parts: Callable[[Column], Column]) -> Column:
    """A struct of what the given functions read from the page's outline, which is made once."""
    return _let(
        outline(html),
        lambda page: F.struct(*[read(page).alias(name) for name, read in parts.items()]),
    )


def page_title(html: Column) -> Column:
    """Text of the first title place that has any, else a fixed remark."""
    return _let(outline(html), title_of)


def absolute_url(link: Column, base: str) -> Column:
    """The link with the base in front, unless it already starts with ``http``."""
    root = base.rstrip("/")
    return (
        F.when(F.startswith(link, F.lit("/")), F.concat(F.lit(root), link))
        .when(~F.startswith(link, F.lit("http")), F.concat(F.lit(root + "/"), link))
        .otherwise(link)
    )


def usable_link(link: Column) -> Column:
    """Neither empty nor a fragment of the same page."""
    return (link != "") & ~F.startswith(link, F.lit("#"))


def is_article_url(url: Column, marks: Sequence[str] = tuple(ARTICLE_MARKS)) -> Column:
    found = F.lit(False)
    for mark in marks:
        found = found | F.contains(F.lower(url), F.lit(mark))
    return found


def article_urls(
    links: Column, base: str, marks: Sequence[str] = tuple(ARTICLE_MARKS)
) -> Column:
    """Absolute article URLs among the links, without repeats, in first-seen order.

    Works inside the row, so no shuffle is needed to drop repeats within a page.
    """
    usable = F.filter(links, usable_link)
    urls = F.transform(usable, lambda link: absolute_url(link, base))
    return F.array_distinct(F.filter(urls, lambda url: is_article_url(url, marks)))


def ranked_links(links: Column, marks: Sequence[str] = tuple(ARTICLE_MARKS)) -> Column:
    """Links that contain the first mark (as written), then the second, and so on."""
    def holding(mark: str) -> Column:
        return F.filter(links, lambda link: F.contains(link, F.lit(mark)))

    return F.flatten(F.array(*(holding(mark) for mark in marks)))
