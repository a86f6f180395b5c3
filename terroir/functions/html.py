"""HTML by expression: tags, attributes, scripts, entities and urls of a page text."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

# All names of the HTML standard that end with a semicolon.
ENTITIES = {name.removesuffix(";"): letters for name, letters in html5.items() if name.endswith(";")}
_ENTITY = "&(?:#[0-9]{1,8}|#[xX][0-9a-fA-F]{1,7}|[a-zA-Z][a-zA-Z0-9]{1,31});"


def _letter(ref: Column) -> Column:
    """The letters an entity stands for; unknown ones stay as they are. Numbers that are no character give U+FFFD."""
    name = F.regexp_replace(ref, "[&;]", "")
    digits = F.when(F.lower(name).startswith("#x"), F.conv(F.substring(name, 3, 7), 16, 10)).otherwise(F.substring(name, 2, 8))
    point = digits.try_cast("bigint")
    valid = point.between(1, 0xD7FF) | point.between(0xE000, 0x10FFFF)
    letter = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, point).otherwise(F.lit(0xFFFD))), 8, "0")), "UTF-32")
    # One constant of the plan, not an expression per entry.
    named = F.try_element_at(F.from_json(F.lit(json.dumps(ENTITIES)), "map<string,string>"), name)
    return F.when(name.startswith("#"), letter).otherwise(F.coalesce(named, ref))


def unescape(text: Column) -> Column:
    """Decode named and numeric entities; an ampersand is decoded last, so nothing is decoded twice."""
    refs = F.array_distinct(F.regexp_extract_all(text, F.lit(_ENTITY), 0))
    others = F.filter(refs, lambda r: r != "&amp;")
    out = F.aggregate(others, text, lambda acc, ref: F.replace(acc, ref, _letter(ref)))
    return F.when(F.contains(text, F.lit("&")), F.replace(out, F.lit("&amp;"), F.lit("&"))).otherwise(text)


def script_by_id(html: Column, element_id: str) -> Column:
    body = F.regexp_extract(html, rf"(?is)<script(?=[^>]*\bid\s*=\s*[\"']?{element_id}[\"'\s>])[^>]*>(.*?)</script", 1)
    return F.nullif(F.trim(body), F.lit(""))


def script_bodies(html: Column, attributes: str = "[^>]*") -> Column:
    return F.regexp_extract_all(html, F.lit(rf"(?is)<script{attributes}>(.*?)</script"), 1)


def without_hidden_markup(html: Column) -> Column:
    """Page text without comments, scripts and styles, where no links live."""
    return F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", "")


def attribute(tag: Column, name: str) -> Column:
    """Text of an attribute of one tag, quoted or bare, entities not yet decoded; null when absent."""
    found = F.regexp_extract(tag, rf"(?is)\s{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)", 1)
    return F.regexp_replace(F.nullif(found, F.lit("")), "^[\"']|[\"']$", "")


def link_targets(html: Column) -> Column:
    """The href values of all anchors in page order."""
    tags = F.regexp_extract_all(without_hidden_markup(html), F.lit(r"(?is)<a\s[^>]*?href\s*=[^>]*>"), 0)
    values = F.filter(F.transform(tags, lambda t: attribute(t, "href")), lambda h: h.isNotNull())
    return F.transform(values, unescape)


def meta_tags(html: Column) -> Column:
    """All meta tags as (property, name, content)."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<meta\s[^>]*>"), 0)
    return F.transform(tags, lambda t: F.struct(
        attribute(t, "property").alias("property"), attribute(t, "name").alias("name"),
        attribute(t, "content").alias("content"),
    ))


def meta_content(metas: Column, name: str) -> Column:
    """Content of the first meta tag with this property, else with this name (entities not yet decoded)."""
    def first(kind: str) -> Column:
        return F.try_element_at(F.filter(metas, lambda m: m[kind] == name), F.lit(1))["content"]

    return F.coalesce(first("property"), first("name"))


def page_title(html: Column) -> Column:
    """Text of the title element, entities not yet decoded."""
    return F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title", 1)


# --- urls ------------------------------------------------------------------

_ORIGIN = r"^([a-zA-Z][a-zA-Z0-9+.-]*:)//([^/?#]*)"


def url_host(url: Column) -> Column:
    authority = F.regexp_extract(url, _ORIGIN, 2)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, "^[^@]*@", ""), ":[0-9]*$", ""))


def url_origin(url: Column) -> Column:
    scheme = F.lower(F.regexp_extract(url, _ORIGIN, 1))
    authority = F.lower(F.regexp_replace(F.regexp_extract(url, _ORIGIN, 2), "^[^@]*@", ""))
    port = F.when(scheme == "http:", F.regexp_replace(authority, ":(80)?$", "")).otherwise(
        F.regexp_replace(authority, ":(443)?$", "")
    )
    return F.concat(scheme, F.lit("//"), port)


def url_path(url: Column) -> Column:
    path = F.regexp_replace(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1), r"\\", "/")
    return F.when(path == "", F.lit("/")).otherwise(path)


def url_query(url: Column) -> Column:
    """The query with its question mark, or an empty text."""
    query = F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1)
    return F.when(query == "?", F.lit("")).otherwise(query)


def _escape(text: Column, unsafe: str) -> Column:
    def one(char: Column) -> Column:
        return F.when(
            char.rlike(unsafe), F.regexp_replace(F.hex(F.encode(char, "UTF-8")), "(..)", "%$1")
        ).otherwise(char)

    escaped = F.array_join(F.transform(F.split(text, ""), one), "")
    return F.when(text.rlike(unsafe), escaped).otherwise(text)


def escape_path(path: Column) -> Column:
    return _escape(path, r"[^!-~]|[\"<>`{}^]")


def escape_query(query: Column) -> Column:
    return _escape(query, r"[^!-~]|[\"<>']")


def remove_dot_segments(path: Column) -> Column:
    """Resolve . and .. inside an absolute path."""
    def step(acc: Column, part: Column) -> Column:
        up = F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1)))
        return F.when(part == ".", acc).when(part == "..", up).otherwise(F.concat(acc, F.array(part)))

    parts = F.split(F.substr(path, F.lit(2)), "/")
    kept = F.aggregate(parts, F.array(F.lit("")), step)
    trailing = F.when(path.rlike(r"/\.{1,2}$"), F.lit("/")).otherwise(F.lit(""))
    joined = F.concat(F.array_join(kept, "/"), trailing)
    clean = F.when(joined == "", F.lit("/")).otherwise(F.regexp_replace(joined, "^/+$", "/"))
    return F.when(path.rlike(r"/\.{1,2}(/|$)"), clean).otherwise(path)


def url_parts(url: Column) -> Column:
    """What links of a page are resolved against; compute it once per page."""
    path = url_path(url)
    return F.struct(
        F.regexp_extract(url, _ORIGIN, 1).alias("scheme"), url_origin(url).alias("origin"), path.alias("path"),
        F.regexp_replace(path, "[^/]*$", "").alias("folder"), url_query(url).alias("query"),
    )


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute url of a link on the page with the parts ``base``, without fragment; null when not http(s)."""

    def against_base(link: Column) -> Column:
        return (
            F.when(link.rlike(r"^(?i)https?://"), link)
            .when(link.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), F.lit(None).cast("string"))
            .when(link.startswith("//"), F.concat(base["scheme"], link))
            .when(link.startswith("/"), F.concat(base["origin"], link))
            .when(link.startswith("?"), F.concat(base["origin"], base["path"], link))
            .when(link == "", F.concat(base["origin"], base["path"], base["query"]))
            .otherwise(F.concat(base["origin"], base["folder"], link))
        )

    def cleaned(url: Column) -> Column:
        path = let(remove_dot_segments(url_path(url)), escape_path)
        return F.concat(url_origin(url), path, let(url_query(url), escape_query))

    link = F.regexp_replace(F.trim(href), "[\t\n\r]", "")
    return let(let(link, against_base), cleaned)
