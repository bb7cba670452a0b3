"""Checks of a graph against itself, and of a graph against the run it came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provlake.functions import text as X
from provlake.functions import types as K
from provlake.functions.values import json_text, prop
from provlake.model import CRATE_PROFILE, DESCRIPTOR_ID
from provlake.operators.skew import join_facts

# Properties whose targets must exist, names that are no author, task states
# that count as success, and where a task folder's hash stands in a staged path.
CHECKED_PROPERTIES = ["hasPart", "usedDataset", "usedSoftware", "generated", "generatedBy", "isPartOf", "about"]
SUCCEEDED = ["COMPLETED", "CACHED"]
WORK_FOLDER = r"/work/([0-9a-f]{2})/([0-9a-f]{30,})(?:/|$)"
REMOTE = r"\A[a-z][a-z0-9+.-]*://"


# ---- the graph on its own

def profile_declared(entities: DataFrame, edges: DataFrame) -> DataFrame:
    """(crate_id, has_descriptor, conforms, has_root, about_root)."""
    conforms = prop("props", "conformsTo")
    declared = F.coalesce(F.get_json_object(F.try_element_at("props", F.lit("conformsTo")), "$['@id']"), conforms)
    is_desc = F.col("entity_id") == DESCRIPTOR_ID
    facts = entities.groupBy("crate_id").agg(
        F.bool_or(is_desc).alias("has_descriptor"),
        F.coalesce(F.bool_or(F.when(is_desc, declared == CRATE_PROFILE)), F.lit(False)).alias("conforms"),
        F.min_by("entity_id", F.when(K.is_crate("types"), F.col("pos"))).alias("root_id"))
    about = edges.where((F.col("src") == DESCRIPTOR_ID) & (F.col("predicate") == "about")).groupBy("crate_id").agg(
        F.min_by("dst", "ord").alias("about"))
    return facts.join(about, "crate_id", "left").select(
        "crate_id", "has_descriptor", "conforms", F.col("root_id").isNotNull().alias("has_root"),
        F.coalesce(F.col("about") == F.col("root_id"), F.lit(False)).alias("about_root"))


def dangling_references(entities: DataFrame, edges: DataFrame) -> DataFrame:
    """(crate_id, src, predicate, dst) whose minted target is not in the crate."""
    refs = edges.where(F.col("predicate").isin(CHECKED_PROPERTIES) & F.col("is_object_ref") & F.startswith("dst", F.lit("ark:")))
    known = entities.select("crate_id", F.col("entity_id").alias("dst"))
    return refs.select("crate_id", "src", "predicate", "dst").join(known, ["crate_id", "dst"], "left_anti")


def implausible_authors(crates: DataFrame, user: str | None = None) -> DataFrame:
    """(crate_id, author): nobody, 'Unknown' or the login that ran the job."""
    author = F.coalesce(prop("root_props", "author"), F.lit(""))
    bad = ["", "Unknown"] + ([user] if user else [])
    return crates.select("crate_id", author.alias("author")).where(F.col("author").isin(bad))


def missing_lineage(crates: DataFrame, lineage_nodes: DataFrame) -> DataFrame:
    """Crates that point at a lineage graph which was never written."""
    claimed = crates.where(F.try_element_at("root_props", F.lit("localEvidenceGraph")).isNotNull())
    return claimed.select("crate_id").join(lineage_nodes.select("crate_id").distinct(), "crate_id", "left_anti")


def process_software(entities: DataFrame, edges: DataFrame) -> DataFrame:
    """Software entities that are part of something: one per process."""
    part = edges.where("predicate = 'isPartOf'").select("crate_id", F.col("src").alias("entity_id")).distinct()
    return entities.where(K.audit_type("types") == "Software").join(part, ["crate_id", "entity_id"], "left_semi")


def tool_versions(entities: DataFrame, edges: DataFrame, crates: DataFrame) -> DataFrame:
    """(crate_id, processes, stale, reports, verdict): 'fail' when every process carries the
    crate's version although a versions file exists, 'note' when some do, else 'ok'."""
    low = F.lower(F.coalesce("name", F.lit("")))
    named = F.contains(low, F.lit("versions")) & F.col("name").rlike(r"\.(yml|yaml)\z")
    reports = entities.groupBy("crate_id").agg(F.bool_or((K.audit_type("types") == "Dataset") & F.coalesce(named, F.lit(False))).alias("reports"))
    own = crates.select("crate_id", prop("root_props", "version").alias("crate_version"))
    rows = process_software(entities, edges).select("crate_id", "entity_id", prop("props", "version").alias("version"))
    rows = join_facts(rows, own, ["crate_id"], "entity_id")
    counts = rows.groupBy("crate_id").agg(F.count("*").alias("processes"), F.count_if(F.col("version").eqNullSafe(F.col("crate_version"))).alias("stale"))
    verdict = F.when(F.col("reports") & (F.col("stale") == F.col("processes")), "fail").when(F.col("stale") > 0, "note").otherwise("ok")
    return counts.join(reports, "crate_id").select("crate_id", "processes", "stale", "reports", verdict.alias("verdict"))


def comment_headed(properties: DataFrame) -> DataFrame:
    """(file, name): schemas whose first column is a comment line."""
    first = properties.groupBy("file").agg(F.min_by("name", "position").alias("name"))
    return first.where(F.startswith("name", F.lit("#")))


def stem_collisions(entities: DataFrame, edges: DataFrame) -> DataFrame:
    """(crate_id, stem, n): process identifiers equal up to their hash."""
    stem = F.regexp_replace("entity_id", r"-[^-]*\z", "")
    return process_software(entities, edges).groupBy("crate_id", stem.alias("stem")).agg(F.count("*").alias("n")).where("n > 1")


def duplicate_content(datasets: DataFrame) -> DataFrame:
    """(crate_id, md5, n_files, n_producers): the same bytes, said to be made by different tasks.

    Pairs are made distinct first, so a digest shared by any number of files spreads.
    """
    rows = datasets.where(F.col("md5").isNotNull())
    pairs = rows.groupBy("crate_id", "md5", "producer").agg(F.count("*").alias("n"))
    return pairs.groupBy("crate_id", "md5").agg(F.sum("n").alias("n_files"), F.count("producer").alias("n_producers")) \
        .where("n_producers > 1")


# ---- the graph against the run

def locator_status(datasets: DataFrame, files: DataFrame, crate_dir: str, run_dir: str) -> DataFrame:
    """(crate_id, entity_id, status, path): remote / crate / broken / local / gone / none.

    A relative URL promises the file under the crate folder, a local path only says where it was.
    """
    url, local = X.blank_to_null("content_url"), X.blank_to_null("local_path")
    remote = F.coalesce(url.rlike(REMOTE), F.lit(False))
    under = lambda root, c: F.when(F.startswith(c, F.lit("/")), c).otherwise(F.concat(F.lit(root.rstrip("/") + "/" if root else ""), c))
    path = F.when(~remote, F.coalesce(under(crate_dir, url), under(run_dir, local)))
    rows = datasets.withColumn("remote", remote).withColumn("by_url", url.isNotNull()).withColumn("path", path)
    there = files.select("crate_id", "path", F.lit(True).alias("there"), "length", F.col("md5").alias("file_md5"), "is_dir")
    rows = rows.join(there, ["crate_id", "path"], "left")
    status = F.when(F.col("remote"), "remote").when(F.col("path").isNull(), "none") \
        .when(F.col("there"), F.when(F.col("by_url"), "crate").otherwise("local")).otherwise(F.when(F.col("by_url"), "broken").otherwise("gone"))
    return rows.select("crate_id", "entity_id", status.alias("status"), "path", "length", "file_md5", "is_dir", "md5", "content_size")


def content_mismatches(located: DataFrame, tree: DataFrame | None = None) -> DataFrame:
    """(crate_id, entity_id, problem): digests and sizes the file does not have. A folder's size
    is the sum of its tree (crate_id, path, size)."""
    found = located.where(F.col("status").isin("crate", "local"))
    actual = F.col("length")
    if tree is not None:
        found = found.join(tree.select("crate_id", "path", "size"), ["crate_id", "path"], "left")
        actual = F.when(F.col("is_dir"), F.coalesce("size", F.lit(0))).otherwise(F.col("length"))
    bad_md5 = ~F.col("is_dir") & (X.blank_to_null("md5") != F.col("file_md5"))
    bad_size = X.blank_to_null("content_size") != actual.cast("string")
    return found.select("crate_id", "entity_id", F.explode(F.array_compact(F.array(
        F.when(bad_md5, "md5"), F.when(bad_size, "size")))).alias("problem"))


def task_coverage(trace: DataFrame, computations: DataFrame) -> DataFrame:
    """(crate_id, identifier, side): 'missing' ran but is not in the graph, 'extra' the reverse.
    The computation of the run itself (``is_run``) matches no task and is exempt."""
    left = trace.select("crate_id", "identifier").distinct().withColumn("ran", F.lit(True))
    right = computations.where(~F.col("is_run")).select("crate_id", "identifier").distinct().withColumn("claimed", F.lit(True))
    both = left.join(right, ["crate_id", "identifier"], "full_outer").where("ran is null or claimed is null")
    return both.select("crate_id", "identifier", F.when(F.col("claimed").isNull(), "missing").otherwise("extra").alias("side"))


def command_mismatches(ran: DataFrame, claimed: DataFrame) -> DataFrame:
    """(crate_id, identifier) whose claimed command is no contiguous block of what ran."""
    j = ran.select("crate_id", "identifier", "script").join(claimed.select("crate_id", "identifier", "command"), ["crate_id", "identifier"])
    j = j.where((X.blank_to_null("script").isNotNull()) & (X.blank_to_null("command").isNotNull()))
    return j.where(~X.contains_block(X.script_lines("script"), X.script_lines("command"))).select("crate_id", "identifier")


def image_mismatches(ran: DataFrame, claimed: DataFrame) -> DataFrame:
    """(crate_id, identifier, claimed, ran) where the launch line names another image."""
    from provlake.sources.files import launched_image
    r = ran.select("crate_id", "identifier", launched_image("launch").alias("ran"))
    c = claimed.select("crate_id", "identifier", X.blank_to_null("image").alias("claimed"))
    return r.join(c, ["crate_id", "identifier"]).where(F.col("ran") != F.col("claimed")).select("crate_id", "identifier", "claimed", "ran")


def edge_support(asserted: DataFrame, actual: DataFrame) -> DataFrame:
    """(crate_id, identifier, md5, state) of two sets of (crate_id, identifier, md5):
    'covered', 'fabricated' (asserted only) or 'omitted' (actual only), by distinct content."""
    keys = ["crate_id", "identifier", "md5"]
    mark = lambda df, name: df.where(F.col("md5").isNotNull()).select(*keys).distinct().withColumn(name, F.lit(True))
    both = mark(asserted, "said").join(mark(actual, "did"), keys, "full_outer")
    state = F.when(F.col("did").isNull(), "fabricated").when(F.col("said").isNull(), "omitted").otherwise("covered")
    return both.select(*keys, state.alias("state"))


def coverage(support: DataFrame) -> DataFrame:
    """(crate_id, covered, actual, fabricated, ratio) per crate."""
    c = support.groupBy("crate_id").agg(
        F.count_if(F.col("state") == "covered").alias("covered"), F.count_if(F.col("state") != "fabricated").alias("actual"),
        F.count_if(F.col("state") == "fabricated").alias("fabricated"))
    return c.withColumn("ratio", F.col("covered") / F.nullif(F.col("actual"), F.lit(0)))


def producer_of(path) -> Column:
    """Hash of the task whose folder a staged path lies in."""
    c = X.col(path)
    return X.blank_to_null(F.concat(F.regexp_extract(c, WORK_FOLDER, 1), F.regexp_extract(c, WORK_FOLDER, 2)))


def broken_derivations(staged: DataFrame, computations: DataFrame, datasets: DataFrame, generated_by: DataFrame) -> DataFrame:
    """(crate_id, identifier, source): inputs staged out of another task's folder that the graph
    does not attribute to that task.

    ``staged``: crate_id, identifier, source, md5. ``datasets``: crate_id, entity_id, md5.
    ``generated_by``: crate_id, src, dst. Contents the graph does not carry are passed over.
    """
    comp = computations.select("crate_id", F.col("identifier").alias("producer"), F.col("comp").alias("dst"))
    rows = staged.withColumn("producer", producer_of("source")).where("producer is not null").join(comp, ["crate_id", "producer"])
    rows = rows.join(computations.select("crate_id", "identifier"), ["crate_id", "identifier"], "left_semi")
    carried = datasets.where("md5 is not null").select("crate_id", "md5").distinct()
    rows = rows.join(carried, ["crate_id", "md5"], "left_semi")
    said = generated_by.join(datasets.select("crate_id", F.col("entity_id").alias("src"), "md5"), ["crate_id", "src"]) \
        .select("crate_id", "md5", "dst").distinct()
    return rows.join(said, ["crate_id", "md5", "dst"], "left_anti").select("crate_id", "identifier", "source")


def failed_with_outputs(trace: DataFrame, generated: DataFrame) -> DataFrame:
    """(crate_id, identifier, status, n_generated) of tasks that did not succeed yet claim results."""
    bad = trace.where(~F.col("status").isin(SUCCEEDED)).select("crate_id", "identifier", "status")
    return bad.join(generated.select("crate_id", "identifier"), ["crate_id", "identifier"]).groupBy(
        "crate_id", "identifier", "status").agg(F.count("*").alias("n_generated"))


# ---- one graph against another

def canonical(value) -> Column:
    """JSON text with list order taken out: object keys sorted, items of a list sorted."""
    c = X.col(value)
    v = F.try_parse_json(c)
    items = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda i: F.to_json(i))
    return F.when(F.startswith(F.ltrim(c), F.lit("[")), F.concat(F.lit("["), F.array_join(F.array_sort(items), ","), F.lit("]"))) \
        .otherwise(F.coalesce(F.to_json(v), c))


def graph_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """(crate_id, entity_id, key, problem) between two tables (crate_id, entity_id, props).

    'only left' / 'only right' with a null key are entities of one side; with a key they are
    properties of one side; 'differs' are properties with other values.
    """
    ids = left.select("crate_id", "entity_id").distinct().withColumn("l", F.lit(True)).join(
        right.select("crate_id", "entity_id").distinct().withColumn("r", F.lit(True)), ["crate_id", "entity_id"], "full_outer")
    one = ids.where("l is null or r is null").select(
        "crate_id", "entity_id", F.lit(None).cast("string").alias("key"), F.when(F.col("r").isNull(), "only left").otherwise("only right").alias("problem"))
    rows = lambda df, name: df.select("crate_id", "entity_id", F.explode("props").alias("key", "value")).select(
        "crate_id", "entity_id", "key", F.sha2(canonical("value"), 256).alias(name))
    both = ids.where("l and r").select("crate_id", "entity_id")
    props = rows(left, "lv").join(rows(right, "rv"), ["crate_id", "entity_id", "key"], "full_outer").where("not (lv <=> rv)")
    props = props.join(both, ["crate_id", "entity_id"], "left_semi")
    problem = F.when(F.col("rv").isNull(), "only left").when(F.col("lv").isNull(), "only right").otherwise("differs")
    return one.unionByName(props.select("crate_id", "entity_id", "key", problem.alias("problem")))
