"""Shapes of the canonical tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENTITY_SCHEMA = """crate_id string, entity_id string, pos bigint, types array<string>, name string,
description string, formats array<string>, content_url string, local_path string, content_size string,
md5 string, has_generated_by boolean, has_provenance boolean, props map<string,string>"""

EDGE_SCHEMA = """crate_id string, src string, predicate string, dst string, ord bigint,
is_object_ref boolean, is_list boolean, src_pos bigint"""

ENTITY_COLUMNS = [c.split()[0] for c in ENTITY_SCHEMA.replace("map<string,string>", "map").split(",")]
EDGE_COLUMNS = [c.split()[0] for c in EDGE_SCHEMA.split(",")]

# Class addresses and document constants of the vocabulary.
EVI = "https://w3id.org/EVI#"
COMPUTATION, DATASET, SOFTWARE = EVI + "Computation", EVI + "Dataset", EVI + "Software"
CRATE, CONTAINER, SCHEMA = EVI + "ROCrate", EVI + "Container", "EVI:Schema"
DESCRIPTOR_ID = "ro-crate-metadata.json"
CRATE_PROFILE = "https://w3id.org/ro/crate/1.2"
ACTIVITY_TYPES = ["prov:Activity", COMPUTATION]
DATASET_TYPES = ["prov:Entity", DATASET]
SOFTWARE_TYPES = ["prov:Entity", SOFTWARE]
CONTAINER_TYPES = ["prov:Entity", CONTAINER]
ROOT_TYPES = ["Dataset", CRATE]

# Positions are section * SECTION + a position inside the section.
SECTION = 10 ** 15
SECTIONS = {"descriptor": 0, "root": 1, "run": 2, "task": 3, "workflow": 4, "process": 5,
            "container": 6, "dataset": 7, "config": 8, "schema": 9}


@dataclass
class Graph:
    """Entities and edges of any number of crates, keyed by ``crate_id``."""

    entities: DataFrame
    edges: DataFrame
    #: crate_id, entity_id, pos, part, key, value: what of a property's list is too long for its entity's row, as further JSON lists.
    more: DataFrame | None = None


@dataclass
class RunLog:
    """Tables of any number of runs, keyed by ``session_id``."""

    runs: DataFrame
    tasks: DataFrame
    task_inputs: DataFrame
    task_outputs: DataFrame
    publishes: DataFrame
    workflow_outputs: DataFrame
    params: DataFrame
    processes: DataFrame
    files: DataFrame


def strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def json_map(**values: Column) -> Column:
    """Named values as map<string, JSON text>; nulls dropped. Strings are quoted."""
    pairs = []
    for key, value in values.items():
        pairs += [F.lit(key), value]
    return F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())


def quote(text) -> Column:
    """A text as JSON text."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'(?s)\A\{"v":(.*)\}\z', 1)


def quote_opt(text) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.when(c.isNotNull(), quote(c))


def entity_frame(df: DataFrame, section: str, **columns: Column) -> DataFrame:
    """Select the entity columns, typed nulls where nothing is given."""
    defaults = {
        "crate_id": F.col("crate_id"),
        "pos": F.lit(0).cast("bigint"), "types": F.lit(None).cast("array<string>"), "name": F.lit(None),
        "description": F.lit(None), "formats": F.array().cast("array<string>"), "content_url": F.lit(None),
        "local_path": F.lit(None), "content_size": F.lit(None), "md5": F.lit(None),
        "has_generated_by": F.lit(False), "has_provenance": F.lit(False),
        "props": F.create_map().cast("map<string,string>"),
    }
    defaults.update(columns)
    defaults["pos"] = F.lit(SECTIONS[section] * SECTION) + defaults["pos"]
    kinds = {"pos": "bigint", "types": "array<string>", "formats": "array<string>",
             "has_generated_by": "boolean", "has_provenance": "boolean", "props": "map<string,string>"}
    return df.select(*[defaults[c].cast(kinds.get(c, "string")).alias(c) for c in ENTITY_COLUMNS])


def edge_frame(df: DataFrame, predicate: str, src: str = "src", dst: str = "dst", ord_col=None) -> DataFrame:
    return df.select(
        "crate_id", F.col(src).alias("src"), F.lit(predicate).alias("predicate"), F.col(dst).alias("dst"),
        (F.lit(0) if ord_col is None else F.col(ord_col)).cast("bigint").alias("ord"),
        F.lit(True).alias("is_object_ref"), F.lit(True).alias("is_list"), F.lit(0).cast("bigint").alias("src_pos"))
