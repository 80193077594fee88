"""Text functions: URLs, suffixes, labels, and reading of frontend pages and scripts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File suffixes of content types.
CONTENT_SUFFIXES = {
    "image/png": ".png",
    "image/jpeg": ".jpg",
    "image/webp": ".webp",
    "application/json": ".json",
    "application/vnd.mapbox-vector-tile": ".mvt",
    "application/x-protobuf": ".mvt",
}
# Names of WKT geometry types.
WKT_TYPES = {
    "POINT": "Point",
    "MULTIPOINT": "MultiPoint",
    "LINESTRING": "LineString",
    "MULTILINESTRING": "MultiLineString",
    "POLYGON": "Polygon",
    "MULTIPOLYGON": "MultiPolygon",
}
# Tile URLs of the panorama layers.
PANORAMA_OVERLAY = "https://map.pstatic.net/nrb/styles/basic/{version}/{z}/{x}/{y}.png?mt=bg.ol.ts.pr.lko"
PANORAMA_PICKER = "https://map.pstatic.net/nrb/picker/basic/{version}/{z}/{x}/{y}.json?mt=ts.pr.lko&crs=EPSG:4326"
# Patterns of the pages and scripts that are read.
STATE_SCRIPT = r'(?s)<script type="application/json" class="state-view">(.*?)</script>'
JSONP = r"(?s)\(\s*(\{.*\})\s*\)\s*;?\s*$"
URI_TEMPLATE = r'(?s)([A-Z_]+):function\(t,n,a\)\{\s*return"([^"]+)"\+a\+"/"\+n\+"/"\+t\+"\.png"\}'
RESOURCE_BLOCK = r"(?s)e\.RESOURCE_PATH=\{(.*?)\};"
RESOURCE_PAIR = r'([A-Z_]+):"([^"]+)"'
BUNDLE_BLOCK = r'(?s)var c=e\.onloadcallbacks,o=\["v3"\],m=\{(.*?)\},l='
BUNDLE_PAIR = r'(?i)([a-z0-9_]+):r\+"[^"]+/([^/"]+)/[^/"]+"'


def _table(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(v) for pair in values.items() for v in pair])


def _text(value: Column | str) -> Column:
    return F.lit(value) if isinstance(value, str) else value


def fill_template(template: Column | str, **values: Column) -> Column:
    """``{name}`` in the template becomes the value."""
    out = _text(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value.cast("string"))
    return out


def form_encode(value: Column) -> Column:
    """Form encoding in which a tilde stays and an asterisk is escaped."""
    return F.replace(F.replace(F.url_encode(value), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def with_token(url: Column, parameter: Column, token: Column) -> Column:
    """The URL with the token behind ``&`` or ``?``; raises where a parameter is named but no token given."""
    missing = F.raise_error(F.concat(F.lit("an access token is required by parameter "), parameter)).cast("string")
    joined = F.concat(url, F.when(F.contains(url, F.lit("?")), F.lit("&")).otherwise(F.lit("?")), form_encode(parameter), F.lit("="), form_encode(token))
    return F.when(F.coalesce(parameter, F.lit("")) == "", url).when(F.coalesce(token, F.lit("")) == "", missing).otherwise(joined)


def redact_token(url: Column, parameter: Column) -> Column:
    """The value of the token parameter replaced, so that no secret is stored."""
    pattern = F.concat(F.lit(r"([?&]\Q"), form_encode(parameter), F.lit(r"\E=)[^&]*"))
    return F.when(F.coalesce(parameter, F.lit("")) == "", url).otherwise(F.regexp_replace(url, pattern, F.lit("$1REDACTED")))


def overlay_url(version: Column, z: Column, x: Column, y: Column) -> Column:
    return fill_template(PANORAMA_OVERLAY, version=version, z=z, x=x, y=y)


def picker_url(version: Column, z: Column, x: Column, y: Column) -> Column:
    return fill_template(PANORAMA_PICKER, version=version, z=z, x=x, y=y)


def roadview_url(template: Column, z: Column, x: Column, y: Column) -> Column:
    """Standard and high-definition layers alike: level, tile_x and tile_y are names for z, x and y."""
    return fill_template(template, level=z, tile_x=x, tile_y=y, z=z, x=x, y=y)


def normalise_tile_template(template: Column, layer: Column) -> Column:
    """Six literal replacements, in order (fixed values)."""
    for old, new in (
        (F.lit("\\u0026"), F.lit("&")),
        (F.lit("l=stv&"), F.concat(F.lit("l="), layer, F.lit("&"))),
        (F.lit("https://0%d.core-stv-renderer.maps.yandex.net/"), F.lit("https://core-stv-renderer.maps.yandex.net/")),
        (F.lit("%c"), F.lit("x={x}&y={y}&z={z}")),
        (F.lit("%v"), F.lit("{version}")),
        (F.lit("%l"), F.lit("lang=en_US&scale=1")),
    ):
        template = F.replace(template, old, new)
    return template


def with_scheme(url: Column, scheme: str = "https:") -> Column:
    return F.when(F.startswith(url, F.lit("//")), F.concat(F.lit(scheme), url)).when(F.contains(url, F.lit("://")), url).otherwise(F.concat(F.lit(scheme + "//"), url))


def url_path(url: Column) -> Column:
    rest = F.regexp_replace(url, r"^([A-Za-z][A-Za-z0-9+.\-]*:)?(//[^/?#]*)?", "")
    return F.regexp_extract(rest, r"^[^?#]*", 0)


def url_suffix(url: Column, default: str = ".bin") -> Column:
    """The last name's suffix; names that start with their only dot, or end with a dot, have none."""
    name = F.regexp_extract(F.regexp_replace(url_path(url), "/+$", ""), r"[^/]*$", 0)
    return F.coalesce(F.nullif(F.regexp_extract(name, r"[^.].*?(\.[^.]+)$", 1), F.lit("")), F.lit(default))


def content_suffix(content_type: Column, url: Column, default: str = ".bin") -> Column:
    kind = F.trim(F.substring_index(content_type, ";", 1))
    return F.coalesce(F.try_element_at(_table(CONTENT_SUFFIXES), kind), url_suffix(url, default))


def wkt_type(wkt: Column) -> Column:
    prefix = F.upper(F.trim(F.substring_index(F.trim(wkt), "(", 1)))
    known = F.coalesce(F.try_element_at(_table(WKT_TYPES), prefix), F.initcap(F.lower(prefix)))
    return F.when(F.coalesce(wkt, F.lit("")) == "", F.lit("Unknown")).otherwise(known)


def run_label(prefix: Column, index: Column) -> Column:
    return F.format_string("%s_subbox_%02d", prefix, index)


def tile_path(z: Column, x: Column, y: Column) -> Column:
    return F.concat(F.concat_ws("/", z.cast("string"), x.cast("string"), y.cast("string")), F.lit(".bin"))


def iso_utc(moment: Column) -> Column:
    return F.date_format(F.date_trunc("second", moment), "yyyy-MM-dd'T'HH:mm:ssxxx")


def sorted_json(entries: Column) -> Column:
    """JSON of a map with its keys in order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(entries))))


def merge_headers(base: Column, extra: Column) -> Column:
    """Entries of both maps; ``extra`` wins."""
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    base, extra = F.coalesce(base, empty), F.coalesce(extra, empty)
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(extra, k)), extra)


def parse_entries(entries: Column) -> Column:
    """``KEY=VALUE`` strings as a map: split at the first ``=``, trimmed; the last of equal keys wins; an entry without ``=`` raises."""
    pair = lambda e: F.struct(
        F.trim(F.substring_index(e, "=", 1)).alias("key"),
        F.when(F.contains(e, F.lit("=")), F.trim(F.substr(e, F.instr(e, "=") + F.lit(1))))
        .otherwise(F.raise_error(F.concat(F.lit("expected KEY=VALUE, got "), e)).cast("string"))
        .alias("value"),
    )
    pairs = F.transform(entries, pair)
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs), F.lit(1))), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(last)


def unwrap_jsonp(text: Column) -> Column:
    """The JSON object that a call wraps; raises where there is none."""
    found = F.regexp_extract(text, JSONP, 1)
    return F.when(found == "", F.raise_error(F.lit("no JSONP object")).cast("string")).otherwise(found)


def style_config(text: Column) -> Column:
    """``struct<version, base_style, overlay, picker>`` of a wrapped style document."""
    data = unwrap_jsonp(text)
    version = F.get_json_object(data, "$.version")
    return F.struct(
        version.alias("version"),
        F.get_json_object(data, "$.tiles[0]").alias("base_style"),
        fill_template(PANORAMA_OVERLAY, version=version).alias("overlay"),
        fill_template(PANORAMA_PICKER, version=version).alias("picker"),
    )


def page_state(html: Column) -> Column:
    """``struct<tiles_template, version, query_layers>`` of the state that a page embeds; raises where it has none."""
    state = F.regexp_extract(html, STATE_SCRIPT, 1)
    state = F.when(state == "", F.raise_error(F.lit("no embedded state")).cast("string")).otherwise(state)
    return F.struct(
        F.get_json_object(state, "$.config.hosts.stvTiles").alias("tiles_template"),
        F.get_json_object(state, "$.config.layers.stv.version").alias("version"),
        F.coalesce(F.get_json_object(state, "$.query.l"), F.lit("")).alias("query_layers"),
    )


def _pairs(text: Column, pattern: str, value) -> Column:
    keys, values = (F.regexp_extract_all(text, F.lit(pattern), F.lit(i)) for i in (1, 2))
    pairs = F.zip_with(keys, F.transform(values, value), lambda k, v: F.struct(k.alias("key"), v.alias("value")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs), F.lit(1))), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(last)


def uri_templates(script: Column) -> Column:
    """Tile templates by layer of a loader script; raises where it has none."""
    found = _pairs(script, URI_TEMPLATE, lambda v: F.concat(with_scheme(v), F.lit("{level}/{tile_y}/{tile_x}.png")))
    return F.when(F.size(found) == 0, F.raise_error(F.lit("no tile templates in the script")).cast("map<string,string>")).otherwise(found)


def resource_paths(script: Column) -> Column:
    """Resource paths by key of a loader script; empty where it has no such block."""
    return _pairs(F.regexp_extract(script, RESOURCE_BLOCK, 1), RESOURCE_PAIR, lambda v: with_scheme(v))


def bundle_versions(script: Column) -> Column:
    """Versions by bundle of a loader script; empty where it has no such block."""
    return _pairs(F.regexp_extract(script, BUNDLE_BLOCK, 1), BUNDLE_PAIR, lambda v: v)


def roadview_config(script: Column) -> Column:
    """Templates, resources and versions; the standard and the high-definition layer must be there."""
    templates = uri_templates(script)
    need = lambda k: F.coalesce(F.try_element_at(templates, F.lit(k)), F.raise_error(F.lit(f"no {k} template")).cast("string"))
    return F.struct(
        templates.alias("templates"),
        resource_paths(script).alias("resources"),
        bundle_versions(script).alias("versions"),
        need("ROADVIEW").alias("standard"),
        need("ROADVIEW_HD").alias("high_definition"),
    )


def hex_to_rgba(colour: Column, alpha: int = 190) -> Column:
    part = lambda at: F.conv(F.substring(F.ltrim(colour, F.lit("#")), at, 2), 16, 10).cast("int")
    return F.struct(part(1).alias("r"), part(3).alias("g"), part(5).alias("b"), F.lit(alpha).alias("a"))
