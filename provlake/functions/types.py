"""Entity class readings. The four readings disagree on purpose; keep them apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from provlake.functions.text import col

# Class names and preference orders.
NORMAL_CLASSES = ["Dataset", "Software", "Instrument", "Sample", "Experiment", "Computation", "Schema"]
EDGE_CLASSES = ["Dataset", "Computation", "Sample", "Software", "MLModel", "Experiment", "Activity"]
KNOWN_SHORT = ["Dataset", "Software", "MLModel", "Computation", "Annotation", "Experiment",
               "ROCrate", "CreativeWork", "Schema"]
SHORT_PREFERENCE = ["ROCrate", "Computation", "Software", "MLModel", "Experiment", "Annotation", "Schema"]
AUDIT_CLASSES = ["ROCrate", "Container", "Schema", "Computation", "Software", "Dataset", "Sample",
                 "MLModel", "Experiment", "Activity"]
ENTITY_LIKE = ["Dataset", "Sample", "Instrument", "Software", "MLModel"]
ACTIVITY_LIKE = ["Computation", "Experiment", "Annotation", "Activity"]


def type_joined(types) -> Column:
    return F.array_join(F.coalesce(col(types), F.array().cast("array<string>")), " ")


def is_crate(types) -> Column:
    return F.contains(type_joined(types), F.lit("ROCrate"))


def normal_type(types) -> Column:
    """First class whose name occurs anywhere in the joined type text."""
    joined = type_joined(types)
    out = None
    for name in NORMAL_CLASSES:
        hit = F.contains(joined, F.lit(name))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("Other")


def last_type(types) -> Column:
    return F.coalesce(F.try_element_at(col(types), F.lit(-1)), F.lit(""))


def first_of(preference: list[str], names: Column) -> Column:
    return F.get(F.array_intersect(F.array(*[F.lit(p) for p in preference]), names), F.lit(0))


def edge_type(types) -> Column:
    """Exact match by preference when several types are listed, else the last type."""
    c = col(types)
    return F.when(F.size(c) > 1, F.coalesce(first_of(EDGE_CLASSES, c), last_type(c))).otherwise(last_type(c))


def fragment(t: Column) -> Column:
    return F.when(F.contains(t, F.lit("#")), F.substring_index(t, "#", -1)) \
        .otherwise(F.substring_index(t, ":", -1))


def short_types(types) -> Column:
    return F.filter(F.transform(col(types), fragment), lambda s: s.isin(KNOWN_SHORT))


def evi_type(types) -> Column:
    short = short_types(types)
    return F.coalesce(first_of(SHORT_PREFERENCE, short), F.get(short, F.lit(0)))


def audit_type(types) -> Column:
    """Class used by the audit: suffix after '#' and ':', preference list, else last type."""
    ends = F.transform(col(types), lambda t: F.substring_index(F.substring_index(t, "#", -1), ":", -1))
    return F.coalesce(first_of(AUDIT_CLASSES, ends), last_type(types))


def any_in(text: Column, names: list[str]) -> Column:
    out = F.lit(False)
    for n in names:
        out = out | F.contains(text, F.lit(n))
    return out


def is_entity_like(edge_type_col) -> Column:
    return any_in(col(edge_type_col), ENTITY_LIKE)


def is_activity_like(edge_type_col) -> Column:
    return any_in(col(edge_type_col), ACTIVITY_LIKE) & ~is_entity_like(edge_type_col)


def is_plain_dataset(types) -> Column:
    short = short_types(types)
    return F.array_contains(short, "Dataset") & ~F.array_contains(short, "ROCrate")


def with_types(entities):
    """Add all readings to an entity table that carries ``types``."""
    return entities.select(
        "*", type_joined("types").alias("type_joined"), last_type("types").alias("last_type"),
        edge_type("types").alias("edge_type"), evi_type("types").alias("evi_type"),
        normal_type("types").alias("norm_type"))


def node_label_type(types) -> Column:
    """Display class: an 'evi:' fragment when there is one, else the last fragment."""
    tails = F.transform(col(types), lambda t: F.regexp_extract(t, r"([^#/]*)\z", 1))
    named = F.filter(tails, lambda s: F.startswith(s, F.lit("evi:")))
    return F.coalesce(F.substring(F.get(named, F.lit(0)), 5, 1 << 30),
                      F.nullif(F.try_element_at(tails, F.lit(-1)), F.lit("")), F.lit("Unknown"))
