"""Stored pages: listing links and listing fields, one row per page and no shuffle."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import html as H
from ..functions.listing import detect_type, energy_grade, strip
from ..functions.numbers import leading_number, parse_number_compact, parse_number_fr
from ..functions.text import amenity_flags, contains_any
from .listings import FIELD_ALIASES, where_computed

# --- links -----------------------------------------------------------------


def discover_links(
    pages: DataFrame,
    patterns: Mapping[str, Sequence[str]] = K.LINK_PATTERNS,
    per_page: int | None = None,
) -> DataFrame:
    """(page columns but html, position, listing_url): distinct listing links in page order.

    All links of a page are kept; ``per_page`` keeps the first so many of each page.
    ``patterns`` maps a part of the page's host name to path patterns. All work is
    inside the page's row: the duplicates of a page meet in one array, not in a shuffle.
    """
    page_host = F.col("_host")
    wanted = F.lit(None).cast("string")
    for name, regexes in reversed(list(patterns.items())):
        wanted = F.when(F.contains(page_host, F.lit(name)), F.lit("(?i)" + "|".join(regexes))).otherwise(wanted)
    base = pages.withColumn("_host", H.url_host(F.col("url")))
    base = base.withColumns({
        "_wanted": wanted, "_site": F.regexp_replace(page_host, r"^www\.", ""), "_base": H.url_parts(F.col("url")),
    }).where(F.col("_wanted").isNotNull())

    def keep(link: Column) -> Column:
        host = H.url_host(link)
        same_site = (host == page_host) | host.endswith(F.col("_site"))
        return link.isNotNull() & same_site & F.regexp_like(H.url_path(link), F.col("_wanted"))

    hrefs = F.filter(
        H.link_targets(F.col("html")),
        lambda h: (h != "") & ~h.startswith("#") & ~h.startswith("javascript:"),
    )
    links = F.filter(F.transform(hrefs, lambda h: H.resolve_url(F.col("_base"), h)), keep)
    kept = F.array_distinct(links)
    if per_page is not None:
        kept = F.slice(kept, 1, per_page)
    columns = [c for c in pages.columns if c != "html"]
    return base.select(*columns, F.posexplode(kept).alias("position", "listing_url"))


# --- titles ----------------------------------------------------------------

_WORD = "[A-ZÀ-Ÿa-zà-ÿ-]"


def title_fields(title: Column) -> dict[str, Column]:
    """Surface, price, rooms, type, city and postal code named in a listing title."""
    surface = F.regexp_extract(title, r"([0-9]+(?:[,.][0-9]+)?)(?U:\s)*[mM][²2]", 1)
    price = F.regexp_replace(F.regexp_extract(title, "([0-9][0-9\u00a0 ]*)(?U:\\s)*€", 1), "[\u00a0 ]", "")
    amount = F.nullif(price, F.lit("")).try_cast("double")
    letter = F.regexp_extract(title, "(?<![A-Za-z0-9_])[TFtf]([0-9])(?![A-Za-z0-9_])", 1)
    pieces = F.regexp_extract(title, r"([0-9]+)(?U:\s)*[pP][iI][èÈ][cC][eE]", 1)
    low = F.lower(title)
    place = rf"({_WORD}+(?:\s{_WORD}+)*+)\s*\(([0-9]{{5}})\)"
    city, postal = F.regexp_extract(title, place, 1), F.regexp_extract(title, place, 2)
    return {
        "surface": F.nullif(F.replace(surface, F.lit(","), F.lit(".")), F.lit("")).try_cast("double"),
        "price": F.when(amount > 0, amount),
        "rooms": F.nullif(F.coalesce(F.nullif(letter, F.lit("")), pieces), F.lit("")).try_cast("double"),
        "type": F.when(low.contains("studio"), "studio").when(low.contains("appartement"), "appartement")
        .when(contains_any(low, ("maison", "villa")), "maison"),
        "city": F.nullif(F.trim(city), F.lit("")),
        "postalCode": F.nullif(postal, F.lit("")),
    }


def parse_titles(df: DataFrame, title: str = "title") -> DataFrame:
    return df.withColumns(title_fields(F.col(title)))


# --- layers ----------------------------------------------------------------
#
# Each JSON text is parsed once into a struct of the fields that are read; the
# stages below are separate columns so that no text is parsed again per field.

_FIELD_TYPES = {
    "title": "string", "type": "string", "price": "double", "surface": "double", "rooms": "double",
    "bedrooms": "double", "address": "string", "city": "string", "postalCode": "string", "lat": "double",
    "lon": "double", "floor": "string", "elevator": "boolean", "parking": "boolean", "cellar": "boolean",
    "balcony": "boolean", "terrace": "boolean", "furnished": "boolean", "dpe": "string", "ges": "string",
    "charges": "double", "deposit": "double", "fees": "double", "photos": "array<string>", "description": "string",
}
_CLEAN: Mapping[str, Callable[[Column], Column]] = {
    **{name: strip for name in ("title", "address", "city", "postalCode", "floor", "description")},
    "type": detect_type, "dpe": energy_grade, "ges": energy_grade,
}


def _layer(fields: Mapping[str, Column], clean: bool = True) -> Column:
    """A struct with every listing field, absent ones null."""
    def value(name: str) -> Column:
        if name not in fields:
            return F.lit(None)
        return _CLEAN[name](fields[name]) if clean and name in _CLEAN else fields[name]

    return F.struct(*[value(name).cast(kind).alias(name) for name, kind in _FIELD_TYPES.items()])


def _schema(texts: str = "", flags: str = "", photos: str = "", **nested: str) -> str:
    """DDL of a JSON object: text and flag names, lists of texts, and nested objects."""
    parts = [f"`{n}`:string" for n in texts.split()] + [f"`{n}`:boolean" for n in flags.split()]
    parts += [f"`{n}`:array<string>" for n in photos.split()] + [f"`{n}`:{kind}" for n, kind in nested.items()]
    return f"struct<{','.join(parts)}>"


def _pick(parent: str, *names: str) -> Column:
    return F.coalesce(*[F.col(f"{parent}.{n}") for n in names])


def _first_number(*texts: Column) -> Column:
    return F.coalesce(*[parse_number_compact(t) for t in texts])


def _cols(parent: str, *names: str) -> list[Column]:
    return [F.col(f"{parent}.{n}") for n in names]


def _photo_urls(items: Column) -> Column:
    """Photo urls from texts or from objects that name one."""
    def url(item: Column) -> Column:
        named = [F.get_json_object(item, f"$.{n}") for n in ("url", "src", "href", "path", "large", "medium")]
        return F.when(item.startswith("{"), F.coalesce(*named)).otherwise(item)

    return F.filter(F.transform(items, url), lambda u: u.startswith("http"))


# Where each site keeps its listing inside the page state.
STATE_PATHS = {
    "seloger": ("listingData.listing", "ad", "listing", "property"),
    "leboncoin": ("ad", "adData", "initialProps.ad"),
    "bienici": ("propertyAd", "ad", "listing"),
    "": ("listing", "ad", "property", "announcement", "offer"),
}
_AMENITIES = ("elevator", "parking", "cellar", "balcony", "terrace", "furnished")
_NUMBERS = ("price", "surface", "rooms", "bedrooms", "lat", "lon", "charges", "deposit", "fees")
_TEXTS = ("title", "address", "city", "postalCode", "floor", "description")

# The fields read from each site's listing object.
_DETAILS = _schema(
    "surface area roomsQuantity nbRooms rooms bedroomsQuantity nbBedrooms bedrooms floor floorNumber etage"
    " energyClassification dpe gasEmission ges charges depositAmount",
    "elevator hasElevator parking hasParking cellar hasCellar balcony hasBalcony terrace hasTerrace isFurnished furnished",
)
_PLACE = _schema("address fullAddress completeAddress city cityLabel locality postalCode zipCode lat latitude lng lon longitude")
_LISTING_SCHEMAS = {
    "seloger": _schema(
        "title publicationTitle price pricePerMonth surface rooms bedrooms floor charges deposit description"
        " propertyType estateType type", "isFurnished", "photos images",
        prices=_schema("displayedPrice pricePerMonth"), characteristics=_DETAILS, features=_DETAILS, details=_DETAILS,
        location=_PLACE, perimeter=_PLACE, address=_PLACE,
    ),
    "leboncoin": _schema(
        "subject title price body description category_name", "", "price_cents",
        attributes=f"array<{_schema('key value', '', 'values')}>",
        location=_schema("address city_label city zipcode lat latitude lng longitude"),
        images=_schema("", "", "urls_large urls thumb_url"),
    ),
    "bienici": _schema(
        "title propertyTitle price monthlyPrice surfaceArea surface roomsCount rooms bedroomsCount bedrooms address"
        " streetAddress city postalCode blurInfo lat lon floor energyClassification dpe gasEmission ges monthlyCharges"
        " charges deposit description propertyType type",
        "hasElevator elevator hasParkingLot parking hasCellar cellar hasBalcony balcony hasTerrace terrace isFurnished furnished",
        "photos images", coordinates=_schema("lat lon lng"), position=_schema("lat lon lng"),
    ),
    "": _schema(
        " ".join(_TEXTS) + " " + " ".join(dict.fromkeys(
            a for n in (*_NUMBERS, "type", "dpe", "ges") for a in FIELD_ALIASES[n]
        )), " ".join(_AMENITIES), "photos",
    ),
}


def _state_schema(site: str) -> str:
    """DDL of the page state around the site's listing paths."""
    listing, inner = _LISTING_SCHEMAS[site], {}
    for path in STATE_PATHS[site]:
        head, _, rest = path.partition(".")
        inner[head] = f"struct<`{rest}`:{listing}>" if rest else listing
    return f"struct<props:struct<pageProps:{_schema(**inner)}>>"


def _seloger(j: str, deep: Column) -> Column:
    """Fields of a listing struct ``j`` and its details; ``deep`` is the listing's JSON text, searched when no path has a number."""
    # Of several objects with details or a place, the first that exists is the only one that is read.
    details = F.coalesce(*_cols(j, "characteristics", "features", "details"))
    where = F.coalesce(*_cols(j, "location", "perimeter", "address"))
    c = lambda *names: F.coalesce(*[details[n] for n in names])
    loc = lambda *names: F.coalesce(*[where[n] for n in names])
    find = lambda key: parse_number_compact(F.nullif(F.regexp_extract(deep, rf'"{key}"\s*:\s*"?([0-9][^",}}\]]*)', 1), F.lit("")))
    return _layer({
        "title": _pick(j, "title", "publicationTitle"),
        "price": F.coalesce(
            _first_number(*_cols(j, "prices.displayedPrice", "prices.pricePerMonth", "price", "pricePerMonth")),
            find("displayedPrice"), find("pricePerMonth"), find("price"),
        ),
        "surface": F.coalesce(_first_number(c("surface"), c("area"), *_cols(j, "surface")), find("surface")),
        "rooms": F.coalesce(
            _first_number(c("roomsQuantity"), c("nbRooms"), c("rooms"), *_cols(j, "rooms")), find("roomsQuantity"), find("nbRooms")
        ),
        "bedrooms": parse_number_compact(F.coalesce(c("bedroomsQuantity", "nbBedrooms", "bedrooms"), *_cols(j, "bedrooms"))),
        "address": loc("address", "fullAddress", "completeAddress"), "city": loc("city", "cityLabel", "locality"),
        "postalCode": loc("postalCode", "zipCode"), "lat": parse_number_compact(loc("lat", "latitude")),
        "lon": parse_number_compact(loc("lng", "lon", "longitude")),
        "floor": F.coalesce(c("floor", "floorNumber", "etage"), *_cols(j, "floor")),
        "elevator": c("elevator", "hasElevator"), "parking": c("parking", "hasParking"), "cellar": c("cellar", "hasCellar"),
        "balcony": c("balcony", "hasBalcony"), "terrace": c("terrace", "hasTerrace"),
        "furnished": F.coalesce(c("isFurnished", "furnished"), *_cols(j, "isFurnished")),
        "dpe": c("energyClassification", "dpe"), "ges": c("gasEmission", "ges"),
        "charges": parse_number_compact(F.coalesce(c("charges"), *_cols(j, "charges"))),
        "deposit": parse_number_compact(F.coalesce(c("depositAmount"), *_cols(j, "deposit"))),
        "description": _pick(j, "description"), "type": _pick(j, "propertyType", "estateType", "type"),
        "photos": _photo_urls(_pick(j, "photos", "images")),
    })


def _leboncoin(j: str) -> Column:
    def last_attribute(name: str) -> Column:
        return F.try_element_at(F.filter(F.col(f"{j}.attributes"), lambda a: a["key"] == name), F.lit(-1))

    def attr(*names: str) -> Column:
        last = [last_attribute(n) for n in names]
        return F.coalesce(*[v for a in last for v in (a["value"], F.get(a["values"], 0))])

    bracket = lambda c: F.regexp_replace(c, r"^\[", "")  # noqa: E731 - a price may be a one-element list
    return _layer({
        "title": _pick(j, "subject", "title"),
        "price": F.coalesce(
            parse_number_compact(bracket(F.col(f"{j}.price"))), parse_number_compact(F.get(F.col(f"{j}.price_cents"), 0)) / 100
        ),
        "surface": parse_number_compact(attr("square", "surface_habitable", "surface")),
        "rooms": parse_number_compact(attr("rooms", "nb_rooms")), "bedrooms": parse_number_compact(attr("rooms_count", "nb_bedrooms")),
        "address": _pick(j, "location.address", "location.city_label"), "city": _pick(j, "location.city"),
        "postalCode": _pick(j, "location.zipcode"), "lat": parse_number_compact(_pick(j, "location.lat", "location.latitude")),
        "lon": parse_number_compact(_pick(j, "location.lng", "location.longitude")),
        "furnished": F.coalesce(attr("furnished").isin("1", "true"), F.lit(False)),
        "dpe": attr("energy_rate"), "ges": attr("ges"), "charges": parse_number_compact(attr("monthly_charges")),
        "deposit": parse_number_compact(attr("security_deposit")), "description": _pick(j, "body", "description"),
        "type": F.coalesce(attr("real_estate_type", "property_type"), *_cols(j, "category_name")),
        "photos": _pick(j, "images.urls_large", "images.urls", "images.thumb_url"),
    })


def _bienici(j: str) -> Column:
    number = lambda *names: parse_number_compact(_pick(j, *names))
    blurred = F.coalesce(~_pick(j, "blurInfo").isin("", "false", "0"), F.lit(False))
    spot = F.coalesce(*_cols(j, "coordinates", "position"))
    place = lambda *names: parse_number_compact(F.coalesce(*[spot[n] for n in names], F.col(f"{j}.{names[0]}")))
    return _layer({
        "title": _pick(j, "title", "propertyTitle"), "price": number("price", "monthlyPrice"),
        "surface": number("surfaceArea", "surface"), "rooms": number("roomsCount", "rooms"),
        "bedrooms": number("bedroomsCount", "bedrooms"), "address": _pick(j, "address", "streetAddress"),
        "city": _pick(j, "city"), "postalCode": _pick(j, "postalCode"),
        "lat": F.when(~blurred, place("lat")), "lon": F.when(~blurred, place("lon", "lng")),
        "floor": _pick(j, "floor"), "elevator": _pick(j, "hasElevator", "elevator"),
        "parking": _pick(j, "hasParkingLot", "parking"), "cellar": _pick(j, "hasCellar", "cellar"),
        "balcony": _pick(j, "hasBalcony", "balcony"), "terrace": _pick(j, "hasTerrace", "terrace"),
        "furnished": _pick(j, "isFurnished", "furnished"), "dpe": _pick(j, "energyClassification", "dpe"),
        "ges": _pick(j, "gasEmission", "ges"), "charges": number("monthlyCharges", "charges"), "deposit": number("deposit"),
        "description": _pick(j, "description"), "type": _pick(j, "propertyType", "type"),
        "photos": _photo_urls(_pick(j, "photos", "images")),
    })


def _generic(j: str) -> Column:
    return _layer({
        **{n: parse_number_fr(_pick(j, *FIELD_ALIASES[n])) for n in _NUMBERS},
        **{n: _pick(j, n) for n in (*_TEXTS, *_AMENITIES)},
        **{n: _pick(j, *FIELD_ALIASES[n]) for n in ("type", "dpe", "ges")},
        "photos": _pick(j, "photos"),
    })


def _on_site(host: Column, site: str) -> Column:
    if site:
        return F.contains(host, F.lit(site))
    return ~contains_any(host, [s for s in STATE_PATHS if s])


# A page state may be in the page data or in a window variable; both are read alike.
_STATE_TEXTS = {"state": "_state_text", "window": "_window_text"}


def _parsed_states() -> dict[str, Column]:
    """Each state text parsed with the schema of the page's site."""
    return {
        f"_s_{layer}_{site}": F.from_json(F.when(_on_site(F.col("_host"), site), F.col(text)), _state_schema(site))
        for layer, text in _STATE_TEXTS.items() for site in STATE_PATHS
    }


def _state_listings() -> dict[str, Column]:
    """The listing object at the first path that holds one."""
    return {
        f"_j_{layer}_{site}": F.coalesce(*[F.col(f"_s_{layer}_{site}.props.pageProps.{p}") for p in paths])
        for layer in _STATE_TEXTS for site, paths in STATE_PATHS.items()
    }


def _listing_text(layer: str, site: str) -> Column:
    """JSON text of the listing alone: the rest of a state may hold other ads."""
    return F.coalesce(*[F.get_json_object(F.col(_STATE_TEXTS[layer]), f"$.props.pageProps.{p}") for p in STATE_PATHS[site]])


def _state_layer(layer: str) -> Column:
    readers = {
        "seloger": lambda j: _seloger(j, _listing_text(layer, "seloger")), "leboncoin": _leboncoin, "bienici": _bienici, "": _generic,
    }
    chosen = F.lit(None)
    for site, read in readers.items():
        j = f"_j_{layer}_{site}"
        chosen = F.when(F.col(j).isNotNull(), read(j)).otherwise(chosen)
    return chosen


def _window_text(html: Column, host: Column) -> Column:
    """The first state text, assigned to a known window variable, that holds a listing of the page's site."""
    scripts = F.filter(H.script_bodies(html), lambda s: F.contains(s, F.lit("window")))
    patterns = []
    for name in K.STATE_VARIABLES:
        core = name.removeprefix("__").removesuffix("__")
        patterns.append(K.STATE_PATTERN.replace("NAME", name).replace("CORE", core))
    texts = F.flatten(F.transform(
        scripts, lambda s: F.array(*[F.nullif(F.regexp_extract(s, p, 1), F.lit("")) for p in patterns])
    ))

    def holds_listing(text: Column) -> Column:
        hit = F.lit(False)
        for site, paths in STATE_PATHS.items():
            found = F.coalesce(*[F.get_json_object(text, f"$.props.pageProps.{p}") for p in paths])
            hit = hit | (_on_site(host, site) & found.isNotNull())
        return text.isNotNull() & hit

    first = F.try_element_at(F.filter(texts, holds_listing), F.lit(1))
    return F.when(html.rlike(r"window(\.__|\[)"), first)


_HYDRATED = _schema(
    hardFacts=_schema("title", facts=f"array<{_schema('type splitValue value')}>", price=_schema("ariaLabel")),
    price=_schema(
        additional=f"array<{_schema('label text')}>",
        components="array<struct<units:array<struct<details:array<struct<prices:array<"
        "struct<label:struct<main:string>,value:struct<main:struct<ariaLabel:string>>>>>>>>>>",
    ),
    energy="struct<certificates:array<struct<scales:array<struct<name:string,efficiencyClass:struct<rating:string>>>>>>",
    features=f"struct<preview:array<{_schema('icon value')}>>",
    location=_schema(address=_schema("city zipCode"), geometry="struct<coordinates:array<double>>"),
    gallery="struct<images:array<struct<url:string>>>",
    mainDescription=_schema("description headline"), description=_schema("description"),
)


def _hydration_text(html: Column) -> Column:
    """The state of pages that hold it as a JSON text inside a JSON text."""
    body = H.script_by_id(html, "__UFRN_LIFECYCLE_SERVERREQUEST__")
    # Pairs of backslashes step aside, so that a quote after a single one is an escaped quote.
    marked = F.replace(body, F.lit("\\\\"), F.lit("\ue000"))
    literal = F.replace(F.regexp_extract(marked, r'(?s)JSON\.parse\((".*?(?<!\\)")\)', 1), F.lit("\ue000"), F.lit("\\\\"))
    return F.from_json(F.concat(F.lit('{"v":'), F.nullif(literal, F.lit("")), F.lit("}")), "v string")["v"]


# A scale is one of the two: those named so are not the other, whatever else the name holds.
_DPE_NAMES = ("dpe", "performance")


def _number_in(text: Column) -> Column:
    """The first number in a label such as "1 415 €"."""
    compact = F.regexp_replace(text, r"(?U)\s", "")
    return leading_number(F.replace(F.regexp_extract(compact, r"([0-9]+(?:[.,][0-9]+)?)", 1), F.lit(","), F.lit(".")))


def _hydration_layer(j: str) -> Column:
    at = lambda path: F.col(f"{j}.{path}")

    def pick(items: Column, test: Callable[[Column], Column], position: int = -1) -> Column:
        return F.try_element_at(F.filter(items, test), F.lit(position))

    def fact(kind: str) -> Column:
        return pick(at("hardFacts.facts"), lambda f: f["type"] == kind)

    scales = F.flatten(F.transform(at("energy.certificates"), lambda c: F.coalesce(c["scales"], F.array())))

    def grade(words: Sequence[str], others: Sequence[str] = ()) -> Column:
        def named(s: Column) -> Column:
            hit = contains_any(F.lower(s["name"]), words)
            return hit & ~contains_any(F.lower(s["name"]), others) if others else hit

        return F.substring(F.trim(pick(scales, named)["efficiencyClass"]["rating"]), 1, 1)

    def feature(*icons: str) -> Column:
        value = F.lower(pick(at("features.preview"), lambda f: F.lower(f["icon"]).isin(*icons))["value"])
        return ~(value.startswith("pas de") | value.startswith("sans"))

    furnished = F.lower(pick(at("features.preview"), lambda f: F.lower(f["icon"]) == "furnished")["value"])
    prices = F.get(F.get(F.get(at("price.components"), 0)["units"], 0)["details"], 0)["prices"]
    charge = pick(prices, lambda p: F.contains(F.lower(p["label"]["main"]), F.lit("charge")), 1)
    deposit = pick(at("price.additional"), lambda p: F.contains(F.lower(p["label"]), F.lit("garantie")), 1)
    title = F.nullif(strip(F.coalesce(at("hardFacts.title"), at("mainDescription.headline"))), F.lit(""))
    low = F.lower(title)
    kind = (
        F.when(low.contains("studio"), "studio")
        .when(contains_any(low, ("appartement", "duplex", "t1", "t2", "t3")), "appartement")
        .when(contains_any(low, ("maison", "villa")), "maison")
    )
    images = F.filter(F.transform(at("gallery.images"), lambda i: i["url"]), lambda u: u.startswith("http"))
    return F.when(F.col(j).isNotNull(), _layer({
        "title": title, "type": kind, "price": _number_in(at("hardFacts.price.ariaLabel")),
        "charges": _number_in(charge["value"]["main"]["ariaLabel"]),
        "surface": parse_number_compact(fact("livingSpace")["splitValue"]),
        "rooms": F.floor(leading_number(fact("numberOfRooms")["splitValue"])),
        "bedrooms": F.floor(leading_number(fact("numberOfBedrooms")["splitValue"])),
        "floor": F.nullif(fact("numberOfFloors")["value"], F.lit("")), "furnished": ~F.contains(furnished, F.lit("non meublé")),
        "deposit": leading_number(F.replace(deposit["text"], F.lit(","), F.lit("."))),
        "dpe": grade(_DPE_NAMES), "ges": grade(("ges", "serre"), _DPE_NAMES),
        "elevator": feature("elevator"), "parking": feature("parking", "parking-lots"), "cellar": feature("cellar"),
        "balcony": feature("balcony"), "terrace": feature("terrace"),
        "description": F.nullif(strip(F.coalesce(at("mainDescription.description"), at("description.description"))), F.lit("")),
        "city": F.nullif(at("location.address.city"), F.lit("")), "postalCode": F.nullif(at("location.address.zipCode"), F.lit("")),
        "lat": F.get(at("location.geometry.coordinates"), 1), "lon": F.get(at("location.geometry.coordinates"), 0),
        "photos": F.when(F.size(images) > 0, images),
    }))


_JSONLD = _schema(
    "@type name headline description price lowPrice floorSize numberOfRooms numberOfBedrooms image",
    offers=_schema("price lowPrice"), geo=_schema("latitude longitude"),
    address=_schema("streetAddress addressLocality postalCode"),
)


def _jsonld_blocks(html: Column) -> Column:
    """Parsed schema.org blocks of the accepted types, in page order; invalid ones are skipped."""
    bodies = H.script_bodies(html, r"[^>]*type\s*=\s*[\"']application/ld\+json[\"'][^>]*")
    texts = F.flatten(F.transform(bodies, lambda b: F.when(
        F.trim(b).rlike(r"^\s*\["), F.coalesce(F.from_json(b, "array<string>"), F.array().cast("array<string>"))
    ).otherwise(F.array(b))))
    blocks = F.transform(texts, lambda t: F.from_json(t, _JSONLD))
    return F.when(F.contains(html, F.lit("ld+json")), F.filter(blocks, lambda b: b["@type"].isin(*K.JSONLD_TYPES)))


def _jsonld_layer(blocks: Column) -> Column:
    """First value per field over the blocks."""
    def first(get: Callable[[Column], Column]) -> Column:
        return F.try_element_at(F.filter(F.transform(blocks, get), lambda x: x.isNotNull()), F.lit(1))

    def offer(b: Column) -> Column:
        own = F.coalesce(b["offers"]["price"], b["offers"]["lowPrice"])
        return F.when(b["offers"].isNull(), F.coalesce(b["price"], b["lowPrice"])).otherwise(own)

    def address(b: Column) -> Column:
        return F.coalesce(b["address"]["streetAddress"], F.trim(b["address"]["addressLocality"]), F.lit(""))

    def size(b: Column) -> Column:
        return F.coalesce(F.get_json_object(b["floorSize"], "$.value"), b["floorSize"])

    def image(b: Column) -> Column:
        return F.when(b["image"].startswith("["), F.from_json(b["image"], "array<string>")).when(
            ~b["image"].startswith("{"), F.array(b["image"])
        )

    number = lambda get: first(lambda b: parse_number_fr(get(b)))
    return F.when(F.size(blocks) > 0, _layer({
        "title": first(lambda b: F.coalesce(b["name"], b["headline"])), "price": number(offer),
        "description": first(lambda b: b["description"]), "address": first(address),
        "city": first(lambda b: b["address"]["addressLocality"]), "postalCode": first(lambda b: b["address"]["postalCode"]),
        "lat": number(lambda b: b["geo"]["latitude"]), "lon": number(lambda b: b["geo"]["longitude"]), "surface": number(size),
        "rooms": number(lambda b: b["numberOfRooms"]), "bedrooms": number(lambda b: b["numberOfBedrooms"]), "photos": first(image),
    }))


def _og_texts() -> dict[str, Column]:
    meta = lambda name: H.meta_content(F.col("_metas"), name)
    return {
        "_title": F.coalesce(H.unescape(meta("og:title")), F.trim(H.unescape(F.col("_html_title")))),
        "_about": H.unescape(F.coalesce(meta("og:description"), meta("description"))),
        "_amount": leading_number(F.coalesce(meta("product:price:amount"), meta("og:price:amount"))),
        "_image": H.unescape(meta("og:image")),
    }


def _og_layer() -> Column:
    """Open Graph values are taken as they are (no trimming, type already canonical)."""
    parsed = title_fields(F.col("_title"))
    return _layer({
        **parsed, "title": F.nullif("_title", F.lit("")), "description": F.nullif("_about", F.lit("")),
        "photos": F.when(F.col("_image") != "", F.array("_image")),
        "price": F.coalesce(F.when(F.col("_amount") != 0, F.col("_amount")), parsed["price"]),
    }, clean=False)


LAYERS = ("state", "window", "jsonld", "html", "og")


def extract_layers(pages: DataFrame) -> DataFrame:
    """Page columns but html, plus one struct of listing fields per layer (null when the page has none)."""
    html, host = F.col("html"), F.col("_host")
    root = f"struct<app_cldp:struct<data:struct<classified:struct<sections:{_HYDRATED}>>>>"
    staged = (
        pages.withColumn("_host", H.url_host(F.col("url")))
        .withColumns({
            "_state_text": H.script_by_id(html, "__NEXT_DATA__"), "_window_text": _window_text(html, host),
            "_ld": _jsonld_blocks(html), "_metas": H.meta_tags(html), "_html_title": H.page_title(html),
            "_hydration": F.when(contains_any(host, ("seloger", "logic-immo")), _hydration_text(html)),
        })
        .withColumns({
            **_parsed_states(), **_og_texts(),
            "_hydrated": F.from_json("_hydration", root)["app_cldp"]["data"]["classified"]["sections"],
        })
        .withColumns(_state_listings())
    )
    columns = [c for c in pages.columns if c != "html"]
    return staged.select(
        *columns, _state_layer("state").alias("state"), _state_layer("window").alias("window"),
        _jsonld_layer(F.col("_ld")).alias("jsonld"), _hydration_layer("_hydrated").alias("html"), _og_layer().alias("og"),
    )


def merge_first_non_null(layers: DataFrame, order: Sequence[str] = LAYERS) -> DataFrame:
    """First non-null value per field in layer order; pages without price, surface and title are dropped."""
    others = [c for c in layers.columns if c not in order]
    merged = layers.select(
        *others, *[F.coalesce(*[F.col(f"{layer}.{name}") for layer in order]).alias(name) for name in _FIELD_TYPES]
    )

    def kept(row: Column) -> Column:
        some = (F.coalesce(row["price"], F.lit(0.0)) != 0) | (F.coalesce(row["surface"], F.lit(0.0)) != 0)
        return some | (F.coalesce(row["title"], F.lit("")) != "")

    return where_computed(merged, others, kept)


def page_listings(pages: DataFrame) -> DataFrame:
    """Raw listings extracted from pages: merged fields with source host and scrape time."""
    merged = merge_first_non_null(extract_layers(pages))
    return merged.withColumn("source", F.regexp_replace(H.url_host(F.col("url")), r"^www\.", "")).withColumn(
        "scrapedAt", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    )


def fill_amenities(raw: DataFrame) -> DataFrame:
    """Amenity columns that are null, from the description."""
    flags = amenity_flags(F.col("description"))
    return raw.withColumns({name: F.coalesce(F.col(name), value) for name, value in flags.items()})
