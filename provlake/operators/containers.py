"""Container images: identity behind a tag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provlake.functions import text as X

RECORD = "struct<Id:string,RepoDigests:array<string>>"


def image_identities(log: DataFrame) -> DataFrame:
    """(image, json) -> (image, digest, image_id); unusable records give nulls."""
    v = F.try_parse_json(X.trim_ws("json"))
    first = F.when(F.schema_of_variant(v).startswith("ARRAY"), F.try_variant_get(v, "$[0]", "variant")).otherwise(v)
    got = log.select("image", F.try_variant_get(first, "$.Id", "string").alias("id"),
                     F.try_variant_get(first, "$.RepoDigests", "array<string>").alias("digests"))
    return got.select("image", X.pick_digest("image", "digests").alias("digest"), X.blank_to_null("id").alias("image_id"))


def task_images(tasks: DataFrame, identities: DataFrame) -> DataFrame:
    """Distinct images of each session with what is known about them."""
    return tasks.where(F.col("container") != "").select("session_id", F.col("container").alias("image")).distinct() \
        .join(identities, "image", "left")
