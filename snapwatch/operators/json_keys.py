"""Keys of JSON pages that the reader of records does not know, or that hold another kind of value than it takes."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from snapwatch.operators.extract_json import API_PAGE


def kinds_of(schema: DataType, path: str = "$") -> dict[str, str]:
    """The kind of value (OBJECT, ARRAY or TEXT) at every path that a schema names; ``[]`` stands for all elements."""
    if isinstance(schema, StructType):
        parts = [kinds_of(f.dataType, f"{path}.{f.name}") for f in schema.fields if f.name != "_corrupt_record"]
        return {path: "OBJECT"} | {p: kind for part in parts for p, kind in part.items()}
    if isinstance(schema, ArrayType):
        return {path: "ARRAY"} | kinds_of(schema.elementType, f"{path}[]")
    return {path: "TEXT"}


def shape_of(schema: DataType) -> str:
    """A pattern of what ``schema_of_variant`` says of a value in which nothing is unknown: all inside is null or taken.

    An array's elements have one type there, which is VARIANT if they are of several kinds; that is not taken.
    """
    if isinstance(schema, StructType):
        fields = [f"{re.escape(f.name)}: {shape_of(f.dataType)}" for f in schema.fields if f.name != "_corrupt_record"]
        return f"(?:VOID|OBJECT<(?:(?:{'|'.join(fields)})(?:, )?)*>)"
    if isinstance(schema, ArrayType):
        return f"(?:VOID|ARRAY<{shape_of(schema.elementType)}>)"
    return r"(?!OBJECT|ARRAY|VARIANT)[A-Z_]+(?:\(\d+,\d+\))?"


def shapes_of(schema: DataType, path: str = "$") -> list[str]:
    """``path shape``, as patterns, for every path that a schema names."""
    parts: list[list[str]] = []
    if isinstance(schema, StructType):
        parts = [shapes_of(f.dataType, f"{path}.{f.name}") for f in schema.fields if f.name != "_corrupt_record"]
    elif isinstance(schema, ArrayType):
        parts = [shapes_of(schema.elementType, f"{path}[]")]
    return [f"{re.escape(path)} {shape_of(schema)}", *(x for part in parts for x in part)]


def _children(entry: Column) -> Column:
    """(path, value) of every member of an object or element of an array; none of other values."""
    members = F.map_entries(F.try_variant_get(entry["value"], "$", "map<string,variant>"))
    elements = F.try_variant_get(entry["value"], "$", "array<variant>")
    return F.coalesce(
        F.transform(members, lambda m: F.struct(F.concat(entry["path"], F.lit("."), m["key"]).alias("path"), m["value"].alias("value"))),
        F.transform(elements, lambda e: F.struct(F.concat(entry["path"], F.lit("[]")).alias("path"), e.alias("value"))),
    )


def unknown_keys(pages: DataFrame, page: str = "page", body: str = "body", schema: str = API_PAGE) -> DataFrame:
    """``path, type, n, first_page``: values at paths that the schema does not name, or of a kind that it does not take.

    ``type`` is the value's own (OBJECT, ARRAY, STRING, BIGINT, DECIMAL, BOOLEAN and so on), ``n`` how often it was found and
    ``first_page`` the smallest page that has it. Where an unknown key holds an object or a list it is one row; what lies
    inside is not followed. Numbers and the like are taken as text, null by every kind. Bodies that are NULL or no JSON
    have no keys here; ``quarantine`` reports them. A dot in a key is not told apart from a step. Every body is parsed once, in one pass, and only counts are shuffled.
    Values in which nothing is unknown are told by their type as a whole and are not opened; that is the saving on most
    pages, and saves nothing where every part of a page has something unknown.
    """
    named = StructType.fromDDL(schema)
    kinds = kinds_of(named)
    containers = [p for p, kind in kinds.items() if kind != "TEXT"]
    of = {k: [p for p, kind in kinds.items() if kind == k] for k in ("OBJECT", "ARRAY", "TEXT")}
    depth = max(p.count(".") + p.count("[]") for p in kinds)
    shapes = F.lit(f"^(?:{'|'.join(shapes_of(named))})$")

    def unfit(e: Column) -> Column:
        fits = F.rlike(F.concat(e["path"], F.lit(" "), F.schema_of_variant(e["value"])), shapes)
        return ~F.coalesce(fits, F.lit(False))

    def typed(e: Column) -> Column:
        return F.struct(e["path"].alias("path"), F.regexp_extract(F.schema_of_variant(e["value"]), "^[A-Z]+", 0).alias("type"))

    def unknown(e: Column) -> Column:
        taken = e["path"].isin(of["TEXT"]) & ~e["type"].isin("OBJECT", "ARRAY")
        for k in ("OBJECT", "ARRAY"):
            taken = taken | (e["path"].isin(of[k]) & (e["type"] == k))
        return e["type"].isNotNull() & ~taken & ~(e["path"].isin(list(kinds)) & (e["type"] == "VOID"))

    root = F.array(F.struct(F.lit("$").alias("path"), F.try_parse_json(body).alias("value")))
    found = pages.select(F.col(page).alias("_page"), F.filter(root, unfit).alias("_0"))
    for level in range(depth):
        inner = F.filter(f"_{level}", lambda e: e["path"].isin(containers))
        members = F.filter(F.transform(inner, _children), lambda x: x.isNotNull())
        found = found.withColumn(f"_{level + 1}", F.filter(F.flatten(members), unfit))
    # The types are tested before rows are made of them: a condition on the rows would read a type once in each of its terms.
    entries = F.transform(F.concat(*[f"_{level}" for level in range(depth + 1)]), typed)
    return (
        found.select("_page", F.explode(F.filter(entries, unknown)).alias("e"))
        .select("_page", "e.path", "e.type")
        .groupBy("path", "type")
        .agg(F.count("*").alias("n"), F.min("_page").alias("first_page"))
    )
