"""From run tables to entities and edges."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provlake import model as M
from provlake.functions import text as X
from provlake.operators import containers, filetree, runs as R
from provlake.operators.skew import join_facts
from provlake.session import cut_packed as cut


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def keys_of(log: M.RunLog, naan: str) -> dict[str, DataFrame]:
    """Identifiers of crates, runs, tasks, processes and engines."""
    r = log.runs.where("success")
    runs = r.select(
        "*", X.mint_ark("rocrate", "run_name", "session_id", naan).alias("root"),
        X.mint_ark("computation", "run_name", F.concat("session_id", F.lit("#run")), naan).alias("run"),
        X.mint_ark("software", "run_name", F.concat("script_file", F.coalesce("version", F.lit(""))), naan).alias("workflow"),
        X.mint_ark("software", "engine_name", F.concat("engine_name", F.lit("-"), "engine_version"), naan).alias("engine"))
    tasks = R.kept_tasks(log.tasks, log.runs).withColumn(
        "comp", X.mint_ark("computation", X.bare_name("task_name"), "task_hash", naan))
    return {"runs": runs, "tasks": tasks}


def software_ark(process, script_path, naan: str = X.DEFAULT_NAAN) -> Column:
    return X.mint_ark("software", X.bare_name(process), F.concat(X.col(script_path), F.lit("#"), X.col(process)), naan)


@dataclass
class Resolved:
    """The tables everything else is derived from."""

    runs: DataFrame
    tasks: DataFrame
    publishes: DataFrame
    alias: DataFrame
    inputs: DataFrame   # session_id, task_hash, comp, path, ark
    outputs: DataFrame  # session_id, task_hash, comp, seq, ord, path, ark


def unwritten(df: DataFrame, label: str) -> DataFrame:
    """In place of ``cut`` where each table is read once: Spark then leaves out what nobody asks for."""
    return df


def resolve(log: M.RunLog, naan: str = X.DEFAULT_NAAN, patterns: list[str] | None = None,
            write: Callable[[DataFrame, str], DataFrame] = cut) -> Resolved:
    """Kept tasks with identifiers, and what they read and wrote with dataset identifiers.

    Inputs and outputs are the big tables; they are joined with tasks and aliases here and
    written, so that no later step joins or scans the log again.
    """
    k = keys_of(log, naan)
    tasks = write(k["tasks"], "tasks")
    pub = write(R.successful_runs(R.latest_publishes(log.publishes, patterns), log.runs, "target"), "publishes")
    alias = R.aliases(pub)
    comp = tasks.select("session_id", "task_hash", "comp", "seq")
    # what a file stands for first: the long identifiers of tasks then go through one shuffle less
    with_comp = lambda df: df.join(alias, ["session_id", "path"], "left").join(comp, ["session_id", "task_hash"]).withColumn(
        "ark", R.dataset_ark(F.coalesce("key", "path"), naan))
    inputs = write(with_comp(log.task_inputs).select("session_id", "task_hash", "comp", "path", "ark"), "inputs")
    outputs = write(with_comp(log.task_outputs).select("session_id", "task_hash", "comp", "seq", "ord", "path", "ark"), "outputs")
    return Resolved(k["runs"], tasks, pub, alias, inputs, outputs)


def uses(z: Resolved, log: M.RunLog, naan: str = X.DEFAULT_NAAN, read_params: bool = False):
    """(session_id, comp, ark) both ways, of tasks and of the run as a whole, each pair once."""
    run = z.runs.select("session_id", F.col("run").alias("comp"))
    staged = z.inputs.select("session_id", "comp", "ark").distinct()
    generated = z.outputs.select("session_id", "comp", "ark").distinct()
    read = R.run_inputs(z.inputs, z.outputs)
    if read_params:
        read = read.unionByName(R.param_files(log.params, log.files).select("session_id", "path")).distinct()
    made = z.publishes.select("session_id", F.col("target").alias("path")).unionByName(
        log.workflow_outputs.where("path is not null").select("session_id", "path")).distinct()
    ark = lambda df: join_facts(R.with_dataset_ark(df, z.alias, naan).select("session_id", "ark").distinct(),
                                run, ["session_id"], "ark").select("session_id", "comp", "ark")
    return staged.unionByName(ark(read)), generated.unionByName(ark(made))


def file_table(z: Resolved, log: M.RunLog, naan: str = X.DEFAULT_NAAN, expanded: DataFrame | None = None,
               read_params: bool = False) -> DataFrame:
    """One row per dataset: (session_id, ark, first_path, target, producer, first_rank, first_seq).

    First path by registration order (published sources, published targets, run inputs, task
    outputs, run outputs, expanded files); described by its published copy when it has one;
    produced by the last task that wrote it. One grouping answers all three.
    """
    none = F.lit(None).cast("string")

    def rows(df, path, rank, seq=None, target=none, producer=none):
        seq = F.lit(0) if seq is None else F.col(seq)
        return df.select("session_id", F.col(path).alias("path"), F.lit(rank).alias("rank"),
                         seq.cast("bigint").alias("seq"), target.alias("target"), producer.alias("producer"))
    pub, inputs = z.publishes, R.run_inputs(z.inputs, z.outputs)
    frames = [rows(pub, "key", 0, "seq"), rows(pub, "target", 1, "seq", target=F.col("target")), rows(inputs, "path", 2),
              rows(z.outputs, "path", 3, "seq", producer=F.col("comp")),
              rows(R.successful_runs(log.workflow_outputs.where("path is not null"), log.runs, "path"), "path", 4)]
    if read_params:
        frames.append(rows(R.successful_runs(R.param_files(log.params, log.files), log.runs, "path"), "path", 2))
    if expanded is not None:
        frames.append(rows(expanded, "path", 5))
    every = R.with_dataset_ark(_union(frames), z.alias, naan)
    return every.groupBy("session_id", "ark").agg(
        F.min_by("path", F.struct("rank", "seq", "path")).alias("first_path"),
        F.max_by("target", F.when(F.col("target").isNotNull(), F.col("seq"))).alias("target"),
        F.max_by("producer", F.when(F.col("producer").isNotNull(), F.struct("seq", "producer"))).alias("producer"),
        F.min("rank").alias("first_rank"), F.min("seq").alias("first_seq"))


def build_provenance(log: M.RunLog, naan: str = X.DEFAULT_NAAN, patterns: list[str] | None = None,
                     media_types: dict[str, str] | None = None, describe_files: bool = False,
                     identities: DataFrame | None = None, keywords: list[str] | None = None, metadata: DataFrame | None = None, versions: DataFrame | None = None,
                     expanded: DataFrame | None = None, schema_docs: DataFrame | None = None,
                     copies: DataFrame | None = None, read_params: bool = False,
                     keep_self_use: bool = False, resolved: Resolved | None = None,
                     write: Callable[[DataFrame, str], DataFrame] = cut, sections: list[str] | None = None) -> M.Graph:
    """Entities and edges of every successful run.

    ``keywords`` go on every described entity (a process may state its own), ``metadata``
    (crate_id, metadata) is laid over the root's properties.
    ``describe_files`` joins sizes and digests from the file listing, ``identities`` adds
    container entities, ``versions`` (session_id, process, version) are reported tool
    versions, ``expanded`` (session_id, path, dir) describes files inside published folders,
    ``schema_docs`` (session_id, path) adds schema entities, ``copies`` (session_id, path,
    copied_to) are workflow files inside the crate, ``resolved`` reuses what ``resolve`` wrote,
    ``sections`` gives the entities of some sections only (references are not changed by it).
    Parameters of a run that are too many for its row go on in the graph's ``more``.
    """
    z = resolved or resolve(log, naan, patterns, write)
    runs, tasks, alias = z.runs, z.tasks, z.alias
    used, made = uses(z, log, naan, read_params)
    if not keep_self_use:
        used = R.self_use_removed(used, made)
    files = write(file_table(z, log, naan, expanded, read_params), "files")

    about = runs.select("session_id", "run_name", "author", "version", "complete_ts", "start_ts", "crate_dir", "workflow", "run")
    procs = tasks.select("session_id", "process").distinct().join(
        log.processes, ["session_id", "process"], "left").join(about.select("session_id", "workflow"), "session_id") \
        .withColumn("software", software_ark("process", "script_path", naan))
    procs = write(procs, "processes")

    # ---- edges
    as_crate = lambda df: df.withColumnRenamed("session_id", "crate_id")
    edges = [
        M.edge_frame(as_crate(used), "usedDataset", "comp", "ark"),
        M.edge_frame(as_crate(made), "generated", "comp", "ark"),
        M.edge_frame(as_crate(files.where("producer is not null")), "generatedBy", "ark", "producer"),
        M.edge_frame(as_crate(join_facts(tasks, procs.select("session_id", "process", "software"), ["session_id", "process"], "comp")),
                     "usedSoftware", "comp", "software"),
        M.edge_frame(as_crate(join_facts(tasks, runs.select("session_id", "run"), ["session_id"], "comp")), "isPartOf", "comp", "run"),
        M.edge_frame(as_crate(runs), "usedSoftware", "run", "workflow"),
        M.edge_frame(as_crate(runs.withColumn("one", F.lit(1))), "usedSoftware", "run", "engine", "one"),
        M.edge_frame(as_crate(procs), "isPartOf", "software", "workflow"),
        M.edge_frame(as_crate(runs.withColumn("d", F.lit(M.DESCRIPTOR_ID))), "about", "d", "root"),
    ]

    # ---- entities
    frame = M.entity_frame
    q = M.quote_opt
    described = R.first_given("description")
    words = F.lit(json.dumps(keywords)) if keywords else F.lit(None).cast("string")
    lists = R.param_lists(log.params)
    # one list a run; grouped, so that Spark knows it and leaves the lists out where nobody asks for them
    given = lists.where("part = 0").groupBy("session_id").agg(F.first("parameter").alias("parameter"))
    r = as_crate(runs.join(given, "session_id", "left"))
    more = as_crate(lists.where("part > 0").join(runs.select("session_id", "run"), "session_id")).select(
        "crate_id", F.col("run").alias("entity_id"), F.lit(M.SECTIONS["run"] * M.SECTION).cast("bigint").alias("pos"), "part",
        F.lit("parameter").alias("key"), F.col("parameter").alias("value"))
    root = frame(r, "root", entity_id=F.col("root"), types=M.strings(M.ROOT_TYPES), name=F.col("run_name"),
                 description=X.ensure_description(described, F.concat(
                     F.lit("Crate of the workflow run '"), "run_name", F.lit("'"))).alias("description"),
                 props=M.json_map(version=q(R.first_given("version", F.lit("1.0"))),
                                  author=q(R.first_given("author", F.lit("Unknown"))),
                                  license=q(R.first_given("license", F.lit(R.DEFAULT_LICENSE))),
                                  datePublished=q("complete_ts"), keywords=words))
    if metadata is not None:
        laid = R.overlay_root(root.withColumnRenamed("props", "root_props"), metadata)
        root = laid.withColumnRenamed("root_props", "props").select(*root.columns)
    descriptor = frame(r, "descriptor", entity_id=F.lit(M.DESCRIPTOR_ID), types=M.strings(["CreativeWork"]),
                       props=M.json_map(conformsTo=F.lit(f'{{"@id":"{M.CRATE_PROFILE}"}}')))
    run_comp = frame(r, "run", entity_id=F.col("run"), types=M.strings(M.ACTIVITY_TYPES),
                     name=F.concat(F.lit("Workflow run of '"), "run_name", F.lit("'")),
                     description=F.concat(F.lit("Execution of the workflow '"), "run_name", F.lit("' (session "),
                                          "crate_id", F.lit(")")),
                     props=M.json_map(command=q("command"), runBy=q("author"), identifier=q("crate_id"),
                                      startTime=q("start_ts"), endTime=q("complete_ts"), dateCreated=q("start_ts"),
                                      parameter=F.col("parameter"), keywords=words))
    known = None if identities is None else identities.select(F.col("image").alias("container"), "digest", "image_id")

    def with_identity(df):
        """Digest and id of the image a row names; images are few and tasks of one image many."""
        if known is None:
            return df.withColumns({"digest": F.lit(None).cast("string"), "image_id": F.lit(None).cast("string")})
        return join_facts(df, known, ["container"], "session_id", "left")
    t = as_crate(with_identity(join_facts(tasks, about, ["session_id"], "comp")))
    task_comp = frame(t, "task", entity_id=F.col("comp"), pos=F.col("seq"), types=M.strings(M.ACTIVITY_TYPES),
                      name=F.col("task_name"), description=F.concat(
                          F.lit("Workflow task '"), "task_name", F.lit("' (process "), "process", F.lit(")")),
                      props=M.json_map(command=q(X.trim_ws("script")), runBy=q("author"), identifier=q("task_hash"),
                                       dateCreated=q("start_ts"), containerImage=q("container"), containerDigest=q("digest"),
                                       containerImageId=q("image_id"), keywords=words))
    w = runs
    if copies is not None:
        own = copies.select("session_id", F.col("path").alias("script_file"), F.col("copied_to").alias("script_copy"))
        w = w.join(own, ["session_id", "script_file"], "left")
    else:
        w = w.withColumn("script_copy", F.lit(None).cast("string"))
    place = X.definition_locator("script_file", "script_copy", "crate_dir")
    workflow = frame(as_crate(w), "workflow", entity_id=F.col("workflow"), types=M.strings(M.SOFTWARE_TYPES), name=F.col("run_name"),
                     description=F.concat(F.lit("Workflow script for the run '"), "run_name", F.lit("'")),
                     formats=M.strings(["workflow"]), content_url=place["content_url"], local_path=place["local_path"],
                     props=M.json_map(author=q("author"), version=q("version")))
    engine = frame(r, "workflow", entity_id=F.col("engine"), pos=F.lit(1), types=M.strings(M.SOFTWARE_TYPES),
                   name=F.col("engine_name"), description=F.lit("Workflow management system"),
                   formats=M.strings(["application/java-archive"]), props=M.json_map(version=q("engine_version")))
    images = R.process_images(tasks)
    p = with_identity(procs.join(about.drop("workflow"), "session_id").join(images, ["session_id", "process"], "left"))
    stated = R.annotation("ext", "softwareKeywords")
    stated = F.when(stated.isNotNull(), F.when(F.startswith(stated, F.lit("[")), stated).otherwise(F.to_json(F.array(stated))))
    if versions is not None:
        p = p.join(versions.withColumnRenamed("version", "reported"), ["session_id", "process"], "left")
    else:
        p = p.withColumn("reported", F.lit(None).cast("string"))
    if copies is not None:
        p = p.join(copies.withColumnRenamed("path", "script_path"), ["session_id", "script_path"], "left")
    else:
        p = p.withColumn("copied_to", F.lit(None).cast("string"))
    away = X.definition_locator("script_path", "copied_to", "crate_dir")
    url = R.annotation("ext", "softwareUrl")
    process = frame(as_crate(p), "process", entity_id=F.col("software"), types=M.strings(M.SOFTWARE_TYPES),
                    name=R.first_given(R.annotation("ext", "softwareName"), "process"),
                    description=X.ensure_description(
                        R.first_given(R.annotation("ext", "softwareDescription"),
                                      X.trim_ws(X.unindent(X.strip_script_delimiters("body")))),
                        F.concat(F.lit("Workflow process '"), "process", F.lit("' defined in "), "script_path")),
                    formats=F.array(R.first_given(R.annotation("ext", "softwareFormat"), F.lit("workflow"))),
                    content_url=F.coalesce(url, away["content_url"]),
                    local_path=F.when(url.isNull(), away["local_path"]),
                    props=M.json_map(author=q(R.first_given(R.annotation("ext", "softwareAuthor"), "author")),
                                     version=q(R.first_given(R.annotation("ext", "softwareVersion"), "reported", "version")),
                                     containerImage=q("container"), containerDigest=q("digest"), containerImageId=q("image_id"),
                                     keywords=F.coalesce(stated, words)))
    f = join_facts(files, about, ["session_id"], "ark").withColumn("shown", F.coalesce("target", "first_path"))
    inherited = None
    if expanded is not None:
        part = R.with_dataset_ark(expanded.select("session_id", "path", "dir"), alias, naan) \
            .select("session_id", F.col("ark").alias("file_ark"), F.col("dir").alias("path"))
        part = R.with_dataset_ark(part, alias, naan).select("session_id", "file_ark", F.col("ark").alias("dir_ark"))
        edges.append(M.edge_frame(as_crate(part), "isPartOf", "file_ark", "dir_ark"))
        inherited = part.join(files.select("session_id", F.col("ark").alias("dir_ark"), F.col("producer").alias("dir_producer")),
                              ["session_id", "dir_ark"]).where("dir_producer is not null")
        own = files.where("producer is not null").select("session_id", F.col("ark").alias("file_ark"))
        inherited = inherited.join(own, ["session_id", "file_ark"], "left_anti")
        edges.append(M.edge_frame(as_crate(inherited), "generatedBy", "file_ark", "dir_producer"))
        f = f.join(inherited.select("session_id", F.col("file_ark").alias("ark"), "dir_producer"), ["session_id", "ark"], "left") \
            .withColumn("producer", F.coalesce("producer", "dir_producer")).drop("dir_producer")
    if describe_files:
        listing = log.files.select("session_id", F.col("path").alias("shown"), "length", "md5")
        f = f.join(listing, ["session_id", "shown"], "left")
    else:
        f = f.withColumn("length", F.lit(None).cast("bigint")).withColumn("md5", F.lit(None).cast("string"))
    where = X.file_locator("shown", "crate_dir")
    made_by = F.col("producer").isNotNull()
    data = frame(as_crate(f), "dataset", entity_id=F.col("ark"),
                 pos=F.col("first_rank") * F.lit(M.SECTION // 10) + F.col("first_seq"),
                 types=M.strings(M.DATASET_TYPES), name=X.basename("shown"),
                 description=F.concat(F.lit("File '"), X.basename("shown"), F.lit("' "), F.when(made_by, "produced")
                                      .otherwise("used"), F.lit(" by the workflow run '"), "run_name", F.lit("'")),
                 formats=F.array(filetree.file_format("shown", media_types)), content_url=where["content_url"],
                 local_path=where["local_path"], content_size=F.col("length").cast("string"), md5=F.col("md5"),
                 has_generated_by=made_by, has_provenance=made_by,
                 props=M.json_map(author=q("author"), datePublished=q("complete_ts"), keywords=words))
    entities = [("descriptor", descriptor), ("root", root), ("run", run_comp), ("task", task_comp), ("workflow", workflow), ("workflow", engine),
                ("process", process), ("dataset", data)]
    if identities is not None:
        img = containers.task_images(tasks, identities).withColumn(
            "container_ark", X.mint_ark("container", "image", F.coalesce("digest", "image"), naan))
        entities.append(("container", frame(as_crate(img.join(about, "session_id")), "container", entity_id=F.col("container_ark"),
                                            types=M.strings(M.CONTAINER_TYPES), name=F.col("image"),
                                            description=F.concat(F.lit("Container image '"), "image", F.lit("' used by the workflow run '"),
                                                                 "run_name", F.lit("'")),
                                            props=M.json_map(containerImage=q("image"), containerDigest=q("digest"), containerImageId=q("image_id")))))
        edges.append(M.edge_frame(as_crate(join_facts(
            tasks, img.select("session_id", F.col("image").alias("container"), "container_ark"), ["session_id", "container"], "comp")),
            "usedContainer", "comp", "container_ark"))
    if schema_docs is not None:
        s = R.with_dataset_ark(schema_docs.select("session_id", "path"), alias, naan).withColumn(
            "schema_ark", X.mint_ark("schema", X.basename("path"), "ark", naan))
        edges.append(M.edge_frame(as_crate(s), "evi:schema", "ark", "schema_ark"))
        entities.append(("schema", frame(as_crate(s), "schema", entity_id=F.col("schema_ark"), types=M.strings([M.SCHEMA]),
                                         name=X.basename("path"))))
    if copies is not None:
        conf = copies.join(runs.select("session_id", "script_file", "workflow"), "session_id") \
            .where(F.col("path") != F.col("script_file")) \
            .withColumn("conf_ark", X.mint_ark("dataset", X.basename("path"), "copied_to", naan))
        edges.append(M.edge_frame(as_crate(conf), "isPartOf", "conf_ark", "workflow"))
        entities.append(("config", frame(as_crate(conf), "config", entity_id=F.col("conf_ark"), types=M.strings(M.DATASET_TYPES),
                                         name=X.basename("path"), formats=M.strings(["workflow-config"]), content_url=F.col("copied_to"))))
    everything = write(_union([e for _, e in entities]), "entities")
    # the root lists everything but itself and the descriptor
    parts = join_facts(everything.where(F.col("pos") >= 2 * M.SECTION).select("crate_id", "entity_id", "pos"),
                       r.select("crate_id", "root"), ["crate_id"], "entity_id")
    edges.append(M.edge_frame(parts, "hasPart", "root", "entity_id", ord_col="pos"))
    asked = everything if sections is None else _union([e for section, e in entities if section in sections])
    return M.Graph(asked, _union(edges), more)
