"""What a graph implies: inverse properties, crate inputs and outputs, entity lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provlake.functions import text as X
from provlake.functions import types as K
from provlake.model import DESCRIPTOR_ID, EDGE_COLUMNS
from provlake.operators.skew import join_facts

# The inverse pairs of the vocabulary.
INVERSE_PAIRS = [
    ("associateFor", "associatedWith"), ("challengedBy", "challenges"), ("containedBy", "contains"),
    ("created", "createdBy"), ("datasetUsedBy", "usedDataset"), ("derivedFrom", "derivedTo"),
    ("describedBy", "describes"), ("directlyChallengedBy", "directlyChallenges"),
    ("directlySupportedBy", "directlySupports"), ("distributedFrom", "hasDistribution"),
    ("generated", "generatedBy"), ("indirectlyChallengedBy", "indirectlyChallenges"),
    ("packagedBy", "packages"), ("representedBy", "represents"), ("serviceUsedBy", "usedService"),
    ("softwareUsedBy", "usedSoftware"), ("supportedBy", "supports"), ("used", "usedBy"),
]
ADDED_ORD = 1 << 60
OUTPUT_KEYS = ["https://w3id.org/EVI#outputs", "EVI:outputs", "outputs"]


def inverse_of(predicate) -> Column:
    """The inverse property, null when there is none: a constant map, not a join."""
    pairs = [F.lit(x) for a, b in INVERSE_PAIRS for x in (a, b, b, a)]
    return F.try_element_at(F.create_map(*pairs), X.col(predicate))


def entity_index(entities: DataFrame, last_wins: bool = False, skip_descriptor: bool = True) -> DataFrame:
    """One row per (crate_id, entity_id): the first or the last claim of an id.

    A grouped min_by/max_by combines before the shuffle, so a much repeated id costs nothing.
    """
    rows = entities.where(F.col("entity_id") != DESCRIPTOR_ID) if skip_descriptor else entities
    pick = F.max_by if last_wins else F.min_by
    whole = F.struct(*[c for c in entities.columns if c not in ("crate_id", "entity_id")])
    return rows.groupBy("crate_id", "entity_id").agg(pick(whole, "pos").alias("e")).select("crate_id", "entity_id", "e.*")


def added_inverses(entities: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges missing from the graph: t -q-> s wherever s -p-> t and (p, q) are inverse.

    The pairs are disjoint, so one pass is the fixpoint. Only object references count, and
    only between two different entities of the crate.
    """
    want = edges.where("is_object_ref").select(
        "crate_id", F.col("dst").alias("src"), inverse_of("predicate").alias("predicate"), F.col("src").alias("dst")) \
        .where(F.col("predicate").isNotNull() & (F.col("src") != F.col("dst"))).distinct()
    # the statement s -p-> t needs both ends in the crate; the source always is
    known = entities.select("crate_id", F.col("entity_id").alias("src"))
    # only statements of a property that has an inverse can be one that is wanted
    have = edges.where(F.col("is_object_ref") & inverse_of("predicate").isNotNull()).select("crate_id", "src", "predicate", "dst")
    return want.join(have, ["crate_id", "src", "predicate", "dst"], "left_anti").join(
        known, ["crate_id", "src"], "left_semi")


def link_inverses(entities: DataFrame, edges: DataFrame) -> DataFrame:
    """The completed edges. New links come after stated ones, in the order of the entities
    that imply them; a bare text where a link belongs gives way to the link."""
    added = added_inverses(entities, edges)
    place = entities.groupBy("crate_id", F.col("entity_id").alias("dst")).agg(F.min("pos").alias("dst_pos"))
    new = added.join(place, ["crate_id", "dst"], "left").select(
        "crate_id", "src", "predicate", "dst", (F.lit(ADDED_ORD) + F.coalesce("dst_pos", F.lit(0))).cast("bigint").alias("ord"),
        F.lit(True).alias("is_object_ref"), F.lit(True).alias("is_list"), F.lit(0).cast("bigint").alias("src_pos"))
    scalars = edges.where(~F.col("is_object_ref") & ~F.col("is_list"))
    replaced = new.select("crate_id", "src", "predicate").distinct()
    kept = edges.where(F.col("is_object_ref") | F.col("is_list")).unionByName(
        scalars.join(replaced, ["crate_id", "src", "predicate"], "left_anti"))
    return kept.select(*EDGE_COLUMNS).unionByName(new)


def crate_io(entities: DataFrame, edges: DataFrame) -> DataFrame:
    """(crate_id, role, entity_id): what a crate reads and what it yields.

    Inputs: samples, used ids nothing generated (ids outside the crate included), never-used
    datasets nothing generated. Outputs: never-used datasets that are not part of another.
    """
    last = K.last_type("types")
    typed = entities.select("crate_id", "entity_id", "pos", "has_generated_by", F.contains(last, F.lit("Dataset")).alias("data"),
                            last.isin("https://w3id.org/EVI#Sample", "EVI:Sample").alias("sample"),
                            last.isin("https://w3id.org/EVI#Computation", "EVI:Computation").alias("comp"))
    comps = typed.where("comp").select("crate_id", F.col("entity_id").alias("src"))
    used = edges.where("predicate = 'usedDataset'").select("crate_id", "src", "dst").join(comps, ["crate_id", "src"], "left_semi")
    part = edges.where("predicate = 'isPartOf'")

    def said(rows: DataFrame, entity_id: str, **known: Column) -> DataFrame:
        facts = {"pos": F.lit(None).cast("bigint"), "made": F.lit(None).cast("boolean"), **{c: F.lit(False) for c in ("data", "sample", "used", "part")}}
        return rows.select("crate_id", F.col(entity_id).alias("entity_id"), *[c.alias(k) for k, c in {**facts, **known}.items()])
    # all that is said of an id meets in one grouping, which combines before it shuffles
    own = lambda c: F.when(F.col("data"), F.col(c))
    whole = said(typed.where("data or sample"), "entity_id", pos=own("pos"), made=own("has_generated_by"), data=F.col("data"), sample=F.col("sample")) \
        .unionByName(said(used, "dst", used=F.lit(True))).unionByName(said(part, "src", part=F.lit(True)))
    state = whole.groupBy("crate_id", "entity_id").agg(
        F.max_by("made", "pos").alias("made"), *[F.bool_or(c).alias(c) for c in ("data", "sample", "used", "part")])
    open_ = (F.col("data") | F.col("used")) & ~F.coalesce("made", F.lit(False))
    roles = [F.when(open_ | F.col("sample"), "input"), F.when(F.col("data") & ~F.col("used") & ~F.col("part"), "output")]
    return state.select("crate_id", F.explode(F.array_compact(F.array(*roles))).alias("role"), "entity_id")


ARK = r"\Aark:/?(\d+)/(.*)\z"
DASH_FREE = r"\Aark:\d+/[^-](?:.*[^-])?\z"


def dash_tolerant(entities: DataFrame, wanted: DataFrame) -> DataFrame:
    """(crate_id, ark) -> (crate_id, ark, entity_id, exact): the id itself, else the first
    entity whose identifier equals it up to single dashes inside."""
    squeeze = lambda c: F.concat(F.regexp_extract(c, ARK, 1), F.lit("/"),
                                 F.replace(F.regexp_extract(c, ARK, 2), F.lit("-"), F.lit("")))
    ids = entities.where(F.col("entity_id") != DESCRIPTOR_ID).groupBy("crate_id", "entity_id").agg(F.min("pos").alias("pos"))
    asked = wanted.select("crate_id", "ark").distinct()
    loose = ids.where(F.col("entity_id").rlike(r"\Aark:\d+/") & F.col("entity_id").rlike(DASH_FREE)
                      & ~F.contains(F.regexp_extract("entity_id", ARK, 2), F.lit("--"))).withColumn("k", squeeze("entity_id")) \
        .groupBy("crate_id", "k").agg(F.min_by("entity_id", F.struct("pos", "entity_id")).alias("entity_id"))
    same = asked.join(ids.select("crate_id", F.col("entity_id").alias("ark"), F.lit(True).alias("exact")), ["crate_id", "ark"], "left")
    # what is not looked up goes by its own text, which no entity's key equals, and so is spread over the tasks as well
    key = F.when(F.col("exact").isNull() & F.col("ark").rlike(ARK), squeeze("ark")).otherwise(F.concat(F.lit(" "), "ark"))
    both = same.withColumn("k", key).join(loose, ["crate_id", "k"], "left")
    return both.select("crate_id", "ark", F.when(F.col("exact"), F.col("ark")).otherwise(F.col("entity_id")).alias("entity_id"),
                       F.when(F.col("exact"), True).when(F.col("entity_id").isNotNull(), False).alias("exact"))


def root_entities(entities: DataFrame, edges: DataFrame) -> DataFrame:
    """(crate_id, root_id): what the descriptor is about, else the first crate-typed entity,
    else the second entity."""
    named = entities.select("crate_id", "entity_id", "pos", K.is_crate("types").alias("crate"))
    descriptor = named.where(F.endswith("entity_id", F.lit(DESCRIPTOR_ID))).groupBy("crate_id").agg(
        F.min_by("entity_id", F.struct(F.col("entity_id") != DESCRIPTOR_ID, "pos")).alias("src"))
    about = edges.where("predicate = 'about'").join(descriptor, ["crate_id", "src"]).groupBy("crate_id", "src").agg(
        F.min_by("dst", "ord").alias("entity_id"))
    by_about = named.join(about.where(F.col("entity_id") != F.col("src")).drop("src"), ["crate_id", "entity_id"], "left_semi") \
        .select("crate_id", "entity_id", F.lit(0).alias("priority"), "pos")
    by_type = named.where("crate").select("crate_id", "entity_id", F.lit(1).alias("priority"), "pos")
    # the second entity: smallest position after the smallest one; two mins, no window
    first = named.groupBy("crate_id").agg(F.min("pos").alias("first_pos"))
    second = join_facts(named, first, ["crate_id"], "entity_id").where(F.col("pos") > F.col("first_pos")).groupBy("crate_id").agg(
        F.min_by("entity_id", "pos").alias("entity_id"), F.min("pos").alias("pos")) \
        .select("crate_id", "entity_id", F.lit(2).alias("priority"), "pos")
    return by_about.unionByName(by_type).unionByName(second).groupBy("crate_id").agg(
        F.min_by("entity_id", F.struct("priority", "pos")).alias("root_id"))


def declared_outputs(edges: DataFrame) -> DataFrame:
    """(crate_id, src, dst, ord): outputs under the first of three key spellings present."""
    rank = F.array_position(F.array(*[F.lit(k) for k in OUTPUT_KEYS]), F.col("predicate"))
    rows = edges.where(F.col("predicate").isin(OUTPUT_KEYS)).withColumn("rank", rank)
    best = rows.groupBy("crate_id", "src").agg(F.min("rank").alias("rank"))
    return rows.join(best, ["crate_id", "src", "rank"], "left_semi").where("is_object_ref").select("crate_id", "src", "dst", "ord")


def outputs_of_crates(entities: DataFrame, edges: DataFrame) -> DataFrame:
    """(crate_id, dst, output): the declared outputs of every entity ``dst`` that is a crate."""
    crates = entities.where(K.is_crate("types")).select("crate_id", F.col("entity_id").alias("dst")).distinct()
    return declared_outputs(edges).select("crate_id", F.col("src").alias("dst"), F.col("dst").alias("output")) \
        .join(crates, ["crate_id", "dst"], "left_semi")


def resolve_used(uses: DataFrame, entities: DataFrame, edges: DataFrame, outs: DataFrame | None = None) -> DataFrame:
    """(crate_id, src, dst): a used dataset that is itself a crate gives way to its outputs (``outs``, if known)."""
    outs = outputs_of_crates(entities, edges) if outs is None else outs
    return uses.join(outs, ["crate_id", "dst"], "left").select(
        "crate_id", "src", F.coalesce("output", "dst").alias("dst")).distinct()
