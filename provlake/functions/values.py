"""Open values kept as JSON text: reading, truthiness, list clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from provlake.functions.text import blank_to_null, col, trim_ws


def json_text(value) -> Column:
    """A JSON value as plain text: strings unquoted, others as written, null stays null."""
    c = col(value)
    return F.get_json_object(F.concat(F.lit('{"v":'), c, F.lit("}")), "$.v")


def prop(props, key: str) -> Column:
    return json_text(F.try_element_at(col(props), F.lit(key)))


def is_list(value) -> Column:
    return F.startswith(F.ltrim(col(value)), F.lit("["))


def is_map(value) -> Column:
    return F.startswith(F.ltrim(col(value)), F.lit("{"))


def present(value) -> Column:
    """Not null, not blank, not an empty list or map."""
    text = json_text(value)
    empty = F.regexp_replace(text, r"\s+", "").isin("[]", "{}") & (is_list(value) | is_map(value))
    return F.coalesce((trim_ws(text) != "") & ~empty, F.lit(False))


def truthy(value) -> Column:
    """``present`` without trimming; false and 0 count as absent."""
    text = json_text(value)
    raw = F.ltrim(col(value))
    empty = F.regexp_replace(text, r"\s+", "").isin("[]", "{}") & (is_list(value) | is_map(value))
    return F.coalesce((text != "") & ~empty & ~raw.isin("false", "0", "0.0"), F.lit(False))


def text_list(value) -> Column:
    """A JSON list or scalar as an array of texts."""
    c = col(value)
    items = F.when(is_list(c), c).when(c.isNotNull() & (json_text(c).isNotNull()), F.concat(F.lit("["), c, F.lit("]")))
    return F.from_json(items, "array<string>")


def list_to_text(value, sep: str = ", ") -> Column:
    parts = F.filter(F.transform(text_list(value), trim_ws), lambda s: s != "")
    return F.coalesce(F.array_join(parts, sep), F.lit(""))


def delimited_list(value) -> Column:
    """A text split on ';' when it has one, else on ','; a list is cleaned item by item."""
    text = json_text(value)
    split = F.split(text, F.when(F.contains(text, F.lit(";")), F.lit(";")).otherwise(F.lit(",")))
    parts = F.when(is_list(value), text_list(value)).otherwise(split)
    return F.filter(F.transform(parts, trim_ws), lambda s: s != "")


def yes_no(value) -> Column:
    return F.when(col(value) == "true", "Yes").when(col(value) == "false", "No").otherwise(json_text(value))


def text_or_map(value) -> Column:
    """Pass a text or a map through, drop anything else."""
    c = col(value)
    return F.when(F.substring(F.ltrim(c), 1, 1).isin('"', "{"), c)


def publications(value) -> Column:
    """Names or ids, first mention kept, in order."""
    c = col(value)
    items = F.when(is_list(c), c).when(c.isNotNull(), F.concat(F.lit("["), c, F.lit("]")))
    raw = F.from_json(items, "array<string>")
    # an item that is an object names itself by name, then id, then identifier
    as_object = lambda s: F.coalesce(blank_to_null(F.get_json_object(s, "$.name")),
                                     blank_to_null(F.get_json_object(s, "$['@id']")),
                                     blank_to_null(F.get_json_object(s, "$.identifier")), F.lit(""))
    names = F.transform(raw, lambda s: trim_ws(
        F.when(F.startswith(s, F.lit("{")), as_object(s)).otherwise(F.coalesce(s, F.lit("")))))
    return F.array_distinct(F.filter(names, lambda s: s != ""))


ADDITIONAL = "array<struct<name:string,value:string>>"


def additional_props(props) -> Column:
    raw = F.try_element_at(col(props), F.lit("additionalProperty"))
    items = F.when(is_list(raw), raw).when(is_map(raw), F.concat(F.lit("["), raw, F.lit("]")))
    return F.from_json(items, ADDITIONAL)


def additional_value(props, names: list[str]) -> Column:
    """Value of the first additional property with one of these names."""
    hits = F.filter(additional_props(props), lambda p: p["name"].isin(names))
    return F.get(hits, F.lit(0))["value"]


def with_additional(value: Column, props, name: str, default: str | None) -> Column:
    """The value; else the named additional property; else a default if any were given."""
    listed = additional_props(props)
    hits = F.filter(listed, lambda p: p["name"] == name)
    fallback = F.when(F.size(hits) > 0, F.coalesce(F.get(hits, F.lit(0))["value"], F.lit(default))) \
        .when(F.try_element_at(col(props), F.lit("additionalProperty")).isNotNull(), F.lit(default))
    return F.coalesce(value, fallback)


def drop_null_values(m) -> Column:
    return F.map_filter(col(m), lambda k, v: v.isNotNull())
