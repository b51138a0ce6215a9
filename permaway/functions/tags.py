"""Tag classifiers as column expressions over a map of tags. Missing keys make a test false, never null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Layer numbers and tag values that decide results.
LAYERS = {
    "highways": 0, "railways": 1, "buildings": 2, "water": 3, "industrial": 4, "military": 5, "platforms": 6,
    "forests": 7, "pois": 8, "waterways": 9, "admin": 10, "places": 11, "coastlines": 12,
}
WATERWAYS = ("river", "stream", "canal", "drain", "ditch", "brook")
LIGHT_RAIL = ("tram", "subway", "monorail", "narrow_gauge", "light_rail")
NOT_MAINLINE = ("tram", "narrow_gauge", "light_rail", "monorail", "subway", "construction", "abandoned", "disused", "preserved", "miniature", "funicular")
MAJOR_ROADS = ("motorway", "motorway_link", "trunk", "trunk_link", "primary", "primary_link")
MAIN_ROADS = (*MAJOR_ROADS, "secondary", "secondary_link", "tertiary", "tertiary_link")
HOME_ROADS = (*MAIN_ROADS, "residential", "living_street", "unclassified", "road")
KEPT_KEYS = (
    "highway", "building", "waterway", "natural", "railway", "name", "landuse", "military", "public_transport", "amenity",
    "place", "bridge", "tunnel", "layer", "population", "maxspeed", "gauge", "electrified", "voltage", "frequency", "usage",
    "service", "tracks", "railway:track_ref", "boundary", "admin_level", "ISO3166-1", "ISO3166-2", "name:pl", "name:en", "ref", "int_name",
)
LOGIC_LAYERS = (1, 6, 8, 10, 11, 12)


def tag(tags: Column, key: str) -> Column:
    return F.try_element_at(tags, F.lit(key))


def has(tags: Column, key: str) -> Column:
    return F.coalesce(F.map_contains_key(tags, key), F.lit(False))


def is_in(tags: Column, key: str, *values: str) -> Column:
    return F.coalesce(tag(tags, key).isin(*values), F.lit(False))


def is_admin_boundary(t: Column) -> Column:
    return is_in(t, "boundary", "administrative") & is_in(t, "admin_level", "2", "4")


def is_building(t: Column) -> Column:
    return has(t, "building") | has(t, "building:part")


def is_water(t: Column) -> Column:
    return is_in(t, "natural", "water", "bay") | is_in(t, "place", "sea") | has(t, "water") | is_in(t, "landuse", "reservoir") | is_in(t, "waterway", "riverbank", "dock", "boatyard", "dam")


def is_waterway_line(t: Column) -> Column:
    return is_in(t, "waterway", *WATERWAYS)


def is_industrial(t: Column) -> Column:
    return is_in(t, "landuse", "industrial", "commercial", "retail", "warehouse") | is_in(t, "amenity", "industrial")


def is_military(t: Column) -> Column:
    return has(t, "military") | is_in(t, "landuse", "military", "military:airfield")


def is_platform(t: Column) -> Column:
    return is_in(t, "public_transport", "platform") | is_in(t, "railway", "platform") | is_in(t, "highway", "platform")


def is_highway(t: Column) -> Column:
    return has(t, "highway")


def is_coastline(t: Column) -> Column:
    return is_in(t, "natural", "coastline")


def is_railway(t: Column) -> Column:
    """Rail lines of any kind, but ferries, what is not built, unused light rail and point kinds.
    Unused rail of an unknown former kind counts; the disused key is asked before the abandoned one."""
    former = F.coalesce(tag(t, "disused:railway"), tag(t, "abandoned:railway"))
    unused = is_in(t, "railway", "disused", "abandoned")
    kind_ok = F.when(unused, ~F.coalesce(former.isin(*LIGHT_RAIL), F.lit(False))).otherwise(~is_in(t, "railway", "platform", "station", "halt", "signal"))
    return has(t, "railway") & ~is_in(t, "route", "ferry") & ~has(t, "ferry") & ~is_in(t, "railway", "construction", "proposed", "planned") & kind_ok


def is_forest(t: Column) -> Column:
    return is_in(t, "landuse", "forest") | is_in(t, "natural", "wood")


def is_multipolygon(t: Column) -> Column:
    return is_in(t, "type", "multipolygon") | (is_in(t, "type", "boundary") & is_admin_boundary(t))


def is_waterway_relation(t: Column) -> Column:
    return is_in(t, "waterway", *WATERWAYS)


def is_rail_route(t: Column) -> Column:
    return is_in(t, "type", "route") & is_in(t, "route", "tracks", "railway")


def polygon_layer(t: Column) -> Column:
    """Layer of a closed shape by precedence, null if none."""
    return (
        F.when(is_building(t), 2).when(is_water(t), 3).when(is_forest(t), 7).when(is_industrial(t), 4)
        .when(is_military(t), 5).when(is_platform(t), 6).when(is_admin_boundary(t), 10)
    )


def way_layer(t: Column, closed: Column) -> Column:
    """Layer of a way: closed shapes first (boundaries not among them), then lines, null if neither."""
    shape = F.when(closed & any_polygon(t), polygon_layer(t))
    return F.coalesce(shape, F.when(is_highway(t), 0).when(is_waterway_line(t), 9).when(is_railway(t), 1))


def any_polygon(t: Column) -> Column:
    return is_building(t) | is_water(t) | is_industrial(t) | is_military(t) | is_platform(t) | is_forest(t)


def relation_route(t: Column) -> Column:
    return F.when(is_multipolygon(t), "multipolygon").when(is_waterway_relation(t), "waterway").when(is_rail_route(t), "railway route")


def node_layer(t: Column) -> Column:
    return F.when(is_in(t, "railway", "station", "halt", "signal"), 8).when(is_in(t, "place", "city", "town", "village"), 11)


def is_mainline(t: Column) -> Column:
    return ~is_in(t, "railway", *NOT_MAINLINE) & ~is_in(t, "service", "yard", "spur") & ~is_in(t, "usage", "industrial", "tourism", "military")


def is_mainline_station(t: Column) -> Column:
    """railway=station or halt without signs of another kind of transport."""
    yes = is_in(t, "tram", "yes") | is_in(t, "subway", "yes") | is_in(t, "light_rail", "yes") | is_in(t, "narrow_gauge", "yes")
    return is_in(t, "railway", "station", "halt") & ~is_in(t, "station", "subway", "tram", "light_rail", "monorail", "narrow_gauge") & ~yes


def kept_metadata(t: Column) -> Column:
    def keep(k: Column, _v: Column) -> Column:
        return k.isin(*KEPT_KEYS) | k.startswith("building:") | k.startswith("surface") | k.startswith("industrial") | k.contains("railway")

    return F.map_filter(t, keep)


def in_lod(lod: Column, layer: Column, t: Column, area: Column) -> Column:
    """Whether a feature is shown at a level of detail, 0 (all) to 5."""
    road = F.when(lod == 0, True).when(lod <= 2, is_in(t, "highway", *HOME_ROADS)).when(lod == 3, is_in(t, "highway", *MAIN_ROADS)).when(lod == 4, is_in(t, "highway", *MAJOR_ROADS)).otherwise(False)
    place = F.when(lod <= 2, True).when(lod == 3, is_in(t, "place", "city", "town", "village")).otherwise(is_in(t, "place", "city", "town"))
    return (
        F.when(layer == 0, road)
        .when(layer.isin(1, 3, 7, 8, 10), True)
        .when(layer == 2, (lod <= 1) | ((lod == 2) & (F.abs(area) >= 100.0)))
        .when(layer.isin(4, 6), lod <= 2)
        .when(layer == 5, lod == 0)
        .when(layer == 9, lod.isin(0, 1, 3))
        .when(layer == 11, place)
        .when(layer == 12, lod <= 1)
        .otherwise(False)
    )


def max_speed(raw: Column) -> Column:
    """km/h of a speed tag: the part before a semicolon, 1 to 350; 0 if it says none, depends on
    signals, names a country default or is no number."""
    s = F.lower(F.trim(raw))
    first = F.trim(F.replace(F.replace(F.substring_index(s, ";", 1), F.lit("km/h"), F.lit("")), F.lit("kmh"), F.lit("")))
    n = F.when(first.rlike(r"^[+-]?[0-9]{1,9}$"), first.cast("int"))
    ok = ~s.isin("none", "signals", "variable") & ~first.contains(":") & n.between(1, 350)
    return F.when(F.coalesce(ok, F.lit(False)), n).otherwise(0)


def fallback_speed(service: Column, usage: Column) -> Column:
    return (
        F.when(service.isin("siding", "spur", "crossover"), 40).when(service == "yard", 30)
        .when(usage == "main", 140).when(usage == "branch", 120).when(usage.isin("industrial", "tourism", "military"), 60).otherwise(80)
    )


def resolved_speed(t: Column) -> Column:
    parsed = max_speed(tag(t, "maxspeed"))
    return F.when(F.coalesce(parsed, F.lit(0)) > 0, parsed).otherwise(fallback_speed(tag(t, "service"), tag(t, "usage")))


def highway_half_width(kind: Column) -> Column:
    w = (
        F.when(kind.isin("motorway", "motorway_link", "trunk", "trunk_link"), 6.0).when(kind.isin("primary", "primary_link"), 5.0)
        .when(kind.isin("secondary", "secondary_link"), 4.0).when(kind.isin("tertiary", "tertiary_link"), 3.0)
        .when(kind.isin("residential", "living_street", "unclassified", "road"), 2.5).when(kind == "service", 2.0)
        .when(kind.isin("footway", "path", "cycleway", "pedestrian", "steps", "track", "bridleway"), 1.0)
    )
    return F.coalesce(w, F.lit(1.5))


def waterway_half_width(kind: Column) -> Column:
    w = F.when(kind == "river", 8.0).when(kind == "canal", 6.0).when(kind == "stream", 3.0).when(kind.isin("brook", "drain"), 2.0).when(kind == "ditch", 1.5)
    return F.coalesce(w, F.lit(3.0))


def signal_function(t: Column) -> Column:
    """Function of a signal: the first of two tags whose value is known."""
    one, two = tag(t, "railway:signal:main:function"), tag(t, "railway:signal:combined:function")
    known = ("entry", "exit", "block", "intermediate")
    return F.coalesce(F.when(one.isin(*known), one), F.when(two.isin(*known), two), F.lit("unknown"))


def signal_direction(t: Column) -> Column:
    d = tag(t, "railway:signal:direction")
    return F.when(d.isin("forward", "backward"), d).otherwise("both")


def place_type(t: Column) -> Column:
    p = tag(t, "place")
    return F.when(p.isin("city", "town", "village"), p)


def city_name(name: Column) -> Column:
    return F.nullif(F.substring_index(name, " ", 1), F.lit(""))
