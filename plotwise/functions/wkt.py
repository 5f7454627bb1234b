"""Well-known text of any kind as one nested column.

``parse_wkt`` gives ARRAY<STRUCT<kind, parts ARRAY<ARRAY<STRUCT<lon, lat>>>>>:
one element per simple geometry (POINT, LINESTRING, POLYGON), in text order.
A MULTI geometry gives one element per member, a collection (nested ones
too) those of all its members. A polygon's parts are its rings. Further
ordinates (Z, M) are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUM = r"[-+]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][-+]?[0-9]+)?"
_POINT = rf"({_NUM})\s+({_NUM})(?:\s+{_NUM})*"
# exponents are written as ^ while members are told apart, so that a body holds no letters at all
_EXPONENT = r"(?<=[0-9.])[eE](?=[-+]?[0-9])"
_MEMBER = (r"(?i)(MULTIPOINT|MULTILINESTRING|MULTIPOLYGON|POINT|LINESTRING|POLYGON)(?:\s*(?:ZM|Z|M))?\s*"
           r"(EMPTY|[(][^A-Za-z]*[)])")
_COORDS = "array<array<array<array<string>>>>"      # geometries, parts, vertices, ordinates


def _as_json(kind: Column, body: Column) -> Column:
    nested = F.regexp_replace(F.translate(F.regexp_replace(body, _POINT, '{"$1","$2"}'), "()", "[]"), r"\{([^}]*)\}", "[$1]")
    points = F.regexp_replace(F.translate(body, "()", ""), _POINT, '[[["$1","$2"]]]')
    wrap = lambda text, n: F.concat(F.lit("[" * n), text, F.lit("]" * n))
    return (F.when(F.upper(body) == "EMPTY", F.lit("[]"))
             .when(kind.isin("POINT", "LINESTRING"), wrap(nested, 2))
             .when(kind == "MULTIPOINT", wrap(points, 1))
             .when(kind.isin("POLYGON", "MULTILINESTRING"), wrap(nested, 1))
             .otherwise(nested))


def _once(value: Column, use) -> Column:
    """``use`` of a value that is worked out once (an expression named in a lambda is worked out per element)."""
    return F.transform(F.array(value), use)[0]


def _geometries(kind: Column, body: Column) -> Column:
    # the brackets of enclosing collections that close behind the member
    extra = F.length(F.regexp_replace(body, "[^)]", "")) - F.length(F.regexp_replace(body, "[^(]", ""))
    ends = F.concat(F.lit(r"(?:\s*[)]){"), F.greatest(extra, F.lit(0)).cast("string"), F.lit("}$"))
    own = F.regexp_replace(F.regexp_replace(body, r"[,\s]+$", ""), ends, F.lit(""))
    found = F.from_json(_once(own, lambda text: _as_json(kind, text)), _COORDS)
    vertices = lambda part: F.transform(part, lambda v: F.struct(v[0].cast("double").alias("lon"), v[1].cast("double").alias("lat")))
    parts = F.transform(found, lambda g: F.transform(g, vertices))
    split = F.flatten(F.transform(parts, lambda g: F.transform(g, lambda part: F.array(part))))
    return F.when(kind == "MULTILINESTRING", split).otherwise(parts)


def _member(text: Column) -> Column:
    read = F.struct(F.upper(F.regexp_extract(text, _MEMBER, 1)).alias("kind"),
                    F.translate(F.regexp_extract(text, _MEMBER, 2), "^", "e").alias("body"))

    def simple(m: Column) -> Column:
        kind = F.regexp_replace(m["kind"], "^MULTI", "")
        return _once(kind, lambda k: F.transform(_geometries(m["kind"], m["body"]), lambda g: F.struct(k.alias("kind"), g.alias("parts"))))

    return _once(read, simple)


def parse_wkt(text: Column) -> Column:
    """The simple geometries of a text; [] for EMPTY ones and empty collections, null
    for null and for text that is no well-known text (also in one of its members)."""
    members = F.regexp_extract_all(F.regexp_replace(text, _EXPONENT, "^"), F.lit(_MEMBER), F.lit(0))
    none = F.when(text.rlike(r"(?i)^\s*GEOMETRYCOLLECTION\s*(EMPTY|[(]\s*[)])\s*$"), F.array().cast(
        "array<struct<kind:string,parts:array<array<struct<lon:double,lat:double>>>>>"))
    head = text.rlike(r"(?i)^\s*(SRID=[0-9]+;\s*)?(GEOMETRYCOLLECTION\s*[(]|(MULTI)?(POINT|LINESTRING|POLYGON)\b)")
    return F.when(head & ~text.contains("^") & (F.size(members) > 0), F.flatten(F.transform(members, _member))).otherwise(none)
