"""Structured data, photos and dates out of HTML text (Column -> Column).

Tags and attributes are read with native regular expressions, so everything
stays in the JVM: tag and attribute names in any case, attributes in any order,
quoted or bare values. A page is cut into its parts once (`page_parts`): comments,
whole scripts and styles, and start tags; comments and the bodies of scripts and
styles hold no tags. All that reads tags takes these parts, if they are at hand.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from listingflow.functions.text import first_match, parse_date

# The inside of a tag; quoted values may hold a closing bracket.
TAG_PART = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')"""
IN_TAG = TAG_PART + "*+"
ATTRIBUTE_VALUE = r"""("[^"]*"|'[^']*'|[^\s"'>]+)"""

# Types of structured data that describe a property, the tags
# dates and photos are in, and the words in photo addresses.
LD_TYPES = ["Product", "RealEstateListing", "Residence"]
LD_SCRIPT_TYPE = "application/ld+json"
PHOTO_TAG = "og:image"
PUBLISHED_TAG = "article:published_time"
MODIFIED_TAG = "article:modified_time"
IMAGE_URL = r"(?i)https?://.*\.(jpg|jpeg|png|webp)"
PHOTO_WORDS = ["listing", "imovel", "photo", "image"]

# Fixed patterns: data that pages assign in scripts, and dates in running text.
NEXT_DATA = r'(?s)<script id="__NEXT_DATA__"[^>]*>(.*?)</script>'
STATE_PATTERNS = [
    r"(?sU)window\.__INITIAL_STATE__\s*=\s*(\{.*?\});",
    r"(?sU)window\.__DATA__\s*=\s*(\{.*?\});",
    r"(?sU)window\.initialData\s*=\s*(\{.*?\});",
]
PUBLISHED_TEXT = r"(?iU)(?:publicado|criado|anunciado)\s*(?:em|:)?\s*(\d{2}/\d{2}/\d{4})"
DAY_FIRST_DATE = r"[0-9]{2}/[0-9]{2}/[0-9]{4}"
UPDATED_TEXT = r"(?iU)(?:atualizado|modificado)\s*(?:em|:)?\s*(\d{2}/\d{2}/\d{4})"

# Entities decoded in attribute values; the ampersand comes last.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


# The parts of a page that matter: comments, scripts and styles with their ends, and
# start tags. What comes first on the page wins, so no tag is seen within the others.
START_TAG = r"<[a-z][^\s/>]*+(?=[\s/>])" + IN_TAG + ">"
WHOLE = rf"<(?:script(?=[\s/>]){IN_TAG}>.*?</script|style(?=[\s/>]){IN_TAG}>.*?</style)\s*>"
PARTS = rf"(?is)<!--.*?-->|{WHOLE}|{START_TAG}"
# Pages without any of these hold nothing that is looked for in tags.
HINTS = r"(?i)ld\+json|og:image|article:|<img|data-src"


def page_parts(html: Column) -> Column:
    """Scripts, styles and start tags of a page as texts, in order, from one reading."""
    found = F.filter(F.regexp_extract_all(html, F.lit(PARTS), 0), lambda part: ~part.startswith("<!--"))
    return F.when(html.rlike(HINTS), found).otherwise(F.array().cast("array<string>"))


def _once(parts: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of the parts, which are made once however often it looks at them."""
    return F.get(F.transform(F.array(parts), use), F.lit(0))


def tags(parts: Column, name: str, hint: str) -> Column:
    """The start tags of a name among the parts of a page; only those that hold `hint`."""
    wanted = F.filter(parts, lambda part: part.rlike(rf"(?is)^<{name}(?=[\s/>])") & part.rlike(rf"(?i)\Q{hint}\E"))
    return F.transform(wanted, lambda part: F.regexp_extract(part, rf"(?is)^{START_TAG}", 0))


def attribute(tag: Column, name: str) -> Column:
    """Decoded value of an attribute of one start tag; NULL if it has none."""
    raw = first_match(tag, rf"""(?is)[\s"'/]{name}\s*=\s*{ATTRIBUTE_VALUE}""")
    quoted = raw.startswith('"') | raw.startswith("'")
    plain = F.when(quoted, raw.substr(F.lit(2), F.length(raw) - 2)).otherwise(raw)
    return reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), ENTITIES, plain)


def meta_contents(parts: Column, prop: str) -> Column:
    """`content` of every meta tag of a property, in page order (may hold NULLs)."""
    of_property = F.filter(tags(parts, "meta", prop), lambda tag: attribute(tag, "property") == prop)
    return F.transform(of_property, lambda tag: attribute(tag, "content"))


def _describes_property(value: Column) -> Column:
    kind = F.to_json(F.try_variant_get(value, '$["@type"]', "variant"))
    return F.coalesce(kind.isin([f'"{name}"' for name in LD_TYPES]), F.lit(False))


def json_ld(html: Column, parts: Column | None = None) -> Column:
    """First property description among the page's JSON-LD scripts, as VARIANT."""
    start = r"(?is)^<script(?=[\s/>])" + IN_TAG + ">"
    scripts = F.filter(
        page_parts(html) if parts is None else parts,
        lambda part: part.rlike(r"(?is)^<script(?=[\s/>]).*</script\s*>$") & part.contains(LD_SCRIPT_TYPE),
    )
    typed = F.filter(scripts, lambda s: attribute(F.regexp_extract(s, start, 0), "type") == LD_SCRIPT_TYPE)
    bodies = F.transform(typed, lambda s: F.regexp_extract(s, start + r"(.*)</script\s*>$", 1))

    def candidates(body: Column) -> Column:
        value = F.try_parse_json(body)
        return F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.array(value))

    found = F.filter(F.flatten(F.transform(bodies, candidates)), _describes_property)
    return F.when(html.contains(LD_SCRIPT_TYPE), F.get(found, F.lit(0)))


def next_data(html: Column) -> Column:
    """JSON of the first `__NEXT_DATA__` script, as VARIANT."""
    return F.try_parse_json(first_match(html, NEXT_DATA))


def initial_state(html: Column) -> Column:
    """JSON assigned to the first readable state variable, as VARIANT."""
    return F.coalesce(*(F.try_parse_json(first_match(html, p)) for p in STATE_PATTERNS))


def photos(html: Column, parts: Column | None = None) -> Column:
    """Distinct photo addresses joined by `|`, sorted; NULL if there is none."""

    def about_property(url: Column) -> Column:
        return reduce(lambda a, b: a | b, [url.contains(word) for word in PHOTO_WORDS])

    def found(parts: Column) -> Column:
        shared = F.filter(meta_contents(parts, PHOTO_TAG), lambda url: url != "")
        shown = F.filter(
            F.transform(tags(parts, "img", "src"), lambda tag: attribute(tag, "src")),
            lambda url: url.rlike(IMAGE_URL) & about_property(url),
        )
        lazy = F.filter(
            F.transform(tags(parts, r"[a-z][^\s/>]*", "data-src"), lambda tag: attribute(tag, "data-src")),
            lambda url: url.rlike(IMAGE_URL),
        )
        return F.array_sort(F.array_distinct(F.concat(shared, shown, lazy)))

    urls = _once(page_parts(html), found) if parts is None else found(parts)
    return _once(urls, lambda all_: F.when(F.size(all_) > 0, F.array_join(all_, "|")))


def page_dates(html: Column, parts: Column | None = None) -> Column:
    """struct(published, updated): from the meta tag, else from the page text."""

    # Parsed inside `transform`, so that the search for the text runs only once.
    def from_meta(parts: Column, prop: str) -> Column:
        return F.get(F.transform(F.slice(meta_contents(parts, prop), 1, 1), parse_date), F.lit(0))

    def from_text(pattern: str) -> Column:
        # The search in any case is costly; few pages hold such a date at all.
        found = F.transform(F.array(first_match(html, pattern)), parse_date)
        return F.when(html.rlike(DAY_FIRST_DATE), F.get(found, F.lit(0)))

    def dates(parts: Column) -> Column:
        return F.struct(
            F.coalesce(from_meta(parts, PUBLISHED_TAG), from_text(PUBLISHED_TEXT)).alias("published"),
            F.coalesce(from_meta(parts, MODIFIED_TAG), from_text(UPDATED_TEXT)).alias("updated"),
        )

    return _once(page_parts(html), dates) if parts is None else dates(parts)
