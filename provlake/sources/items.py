"""Entities of crate documents of any size, one row each.

A document is read in chunks that end at a closing brace, so files split over tasks like lines
do, and every object of ``@graph`` ends where a chunk ends. What a chunk does to the reader's
state is known without the chunks before it: a chunk maps each of two states (inside a text or
not) to the state after it and to a change of depth. Those maps are composed inside blocks of a
file, the blocks' maps one after the other, and that gives every chunk its state and depth.
Escapes never reach over a chunk's border, because no escape ends in a brace.

From depths follow the chunk where ``@graph`` opens, the one where it closes, and the items
between them: commas at the list's own depth count positions. What is left of a document when
its items are taken out is its frame; a document is JSON if its frame and all its items are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from provlake.operators.running import running_sum
from provlake.operators.skew import join_facts
from provlake.session import cut

#: Chunks in a block of a document that is held in a row.
STEP = 100_000
#: Characters above which a text that does not parse is reported as large, not as wrong.
PARSED = 1 << 27

_IN_TEXT = r'(?:[^"\\]++|\\.?)*+(?:"|\z)'
_TEXT = rf'(?s)"{_IN_TEXT}'
_REST_OF_TEXT = rf"(?s)\A{_IN_TEXT}"
_OPEN = r'"@graph"\s*:\s*\['
_TO_OPEN = rf'(?s)\A(?:[^"]++|"(?!@graph"\s*:\s*\[){_IN_TEXT})*+{_OPEN}'
_LEAD = rf'(?s)\A(?:[^"{{]++|"{_IN_TEXT})*+'
_KEY = ["crate_id", "block", "seq"]


@dataclass
class Scan:
    """Items (crate_id, pos, json) of readable documents, and a row (crate_id, problem) for each other one."""

    items: DataFrame
    problems: DataFrame


def file_chunks(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """Chunks of the documents below ``path``; the crate id is the file's address.

    Rows of one split keep their order, splits are ordered by where they begin.
    """
    rows = spark.read.text(path, lineSep="}", recursiveFileLookup=True, pathGlobFilter=glob)
    return rows.select(F.col("_metadata.file_path").alias("crate_id"), F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("seq"), F.col("_metadata.file_size").alias("size"), "value")


def document_chunks(documents: DataFrame) -> DataFrame:
    """Chunks of documents (crate_id, json) held in rows, the last one of each without a brace after it; a null document counts as an empty one."""
    parts = documents.select("crate_id", F.posexplode(F.split(F.coalesce("json", F.lit("")), r"\}", -1)).alias("seq", "value"))
    return parts.select("crate_id", F.floor(F.col("seq") / STEP).alias("block"), F.col("seq").cast("bigint").alias("seq"), F.lit(None).cast("bigint").alias("size"), "value")


def _bare(text: Column) -> Column:
    """What is left without texts."""
    return F.regexp_replace(text, _TEXT, "")


def _change(bare: Column) -> Column:
    return F.regexp_count(bare, F.lit(r"[\[{]")) - F.regexp_count(bare, F.lit("]"))


def _signs(bare: Column) -> Column:
    """Brackets and commas before the first object, short lists without objects left out; a brace at the end stands for the object."""
    signs = F.regexp_replace(F.regexp_extract(bare, r"(?s)\A[^{]*\{?", 0), r"[^\[\],{]", "")
    return F.regexp_replace(F.regexp_replace(signs, r"\[,*+\]", ""), r"\[,*+\]", "")


def _lead(signs: Column, depth: Column) -> Column:
    """Commas at the list's own depth, whether the list closes there, and whether an item begins; ``depth`` counts from the list."""
    start = F.struct(depth.alias("depth"), F.lit(0).alias("commas"), F.lit(False).alias("closes"), F.lit(False).alias("begins"))
    step = lambda s, c: F.when(s["closes"] | s["begins"], s).otherwise(F.struct(
        (s["depth"] + F.when(c == "[", 1).when((c == "]") & (s["depth"] > 0), -1).otherwise(0)).alias("depth"),
        (s["commas"] + F.when((c == ",") & (s["depth"] == 0), 1).otherwise(0)).alias("commas"),
        ((c == "]") & (s["depth"] == 0)).alias("closes"), ((c == "{") & (s["depth"] == 0)).alias("begins")))
    given = lambda commas, begins: F.struct(F.lit(commas).alias("commas"), F.lit(False).alias("closes"), F.lit(begins).alias("begins"))
    folded = F.aggregate(F.split(signs, ""), start, step, lambda s: F.struct(s["commas"].alias("commas"), s["closes"].alias("closes"), s["begins"].alias("begins")))
    return F.when((depth == 0) & (signs == ",{"), given(1, True)).when((depth < 0) | ((depth > 0) & ~F.contains(signs, F.lit("]"))), given(0, False)).otherwise(folded)


def _opening(text: Column, skipped: Column) -> Column:
    """Where a list named ``@graph`` opens: depth before it as seen from the chunk's start, characters up to it, and its lead."""
    before = F.regexp_extract(text, _TO_OPEN, 0)
    lead = _lead(_signs(_bare(F.substring(text, F.length(before) + 1, F.length(text)))), F.lit(0).cast("bigint"))
    found = F.struct((_change(_bare(before)) - 1).alias("depth"), (skipped + F.length(before)).alias("at"), lead.alias("lead"))
    return F.when(F.contains("value", F.lit("@graph")) & (before != ""), found)


def _marked(chunks: DataFrame) -> DataFrame:
    """Chunks with their maps: for each of the two states before them, the change of depth and what opens."""
    v = F.col("value")
    rest = F.regexp_replace(v, _REST_OF_TEXT, "")
    quotes = F.regexp_count(F.regexp_replace(v, r"(?s)\\.", ""), F.lit('"')) % 2
    return chunks.select(*_KEY, "size", "value", quotes.alias("quotes"), (_change(_bare(v)) - F.when(quotes == 0, 1).otherwise(0)).alias("d0"),
                         (_change(_bare(rest)) - F.when(quotes == 1, 1).otherwise(0)).alias("d1"), _signs(_bare(v)).alias("signs0"), _signs(_bare(rest)).alias("signs1"),
                         _opening(v, F.lit(0)).alias("open0"), _opening(rest, F.length(v) - F.length(rest)).alias("open1"))


def _placed(maps: DataFrame) -> DataFrame:
    """Chunks with the state and depth before them."""
    zero = F.lit(0).cast("bigint")
    before = Window.partitionBy("crate_id", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("crate_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sum_of = lambda c, w: F.coalesce(F.sum(c).over(w), zero)
    rows = maps.withColumn("flips", sum_of("quotes", before) % 2)
    for i in (0, 1):  # the block begins outside (0) or inside (1) a text
        rows = rows.withColumn(f"c{i}", F.when(F.col("flips") == i, F.col("d0")).otherwise(F.col("d1"))).withColumn(f"b{i}", sum_of(f"c{i}", before))
    blocks = rows.groupBy("crate_id", "block").agg(F.sum("quotes").alias("quotes"), F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))
    blocks = blocks.withColumn("inside", sum_of("quotes", earlier) % 2)
    blocks = blocks.withColumn("base", sum_of(F.when(F.col("inside") == 0, F.col("c0")).otherwise(F.col("c1")), earlier)).select("crate_id", "block", "inside", "base")
    state = (F.col("inside") + F.col("flips")) % 2
    depth = F.col("base") + F.when(F.col("inside") == 0, F.col("b0")).otherwise(F.col("b1"))
    of_state = lambda name: F.when(state == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))
    return rows.join(blocks, ["crate_id", "block"]).select(*_KEY, (state == 0).alias("outside"), depth.alias("depth"), _lead(of_state("signs"), depth - 2).alias("lead"), of_state("open").alias("open"))


def _after_text(outside: str) -> Column:
    """The chunk without the rest of a text it begins in."""
    return F.when(F.col(outside), F.col("value")).otherwise(F.regexp_replace("value", _REST_OF_TEXT, ""))


def _from_close(text: Column, depth: Column) -> Column:
    """A chunk from the bracket on that closes the list."""
    start = F.struct(depth.alias("depth"), F.lit(0).alias("at"), F.lit(False).alias("done"))
    step = lambda s, w: F.when(s["done"], s).otherwise(F.struct(
        (s["depth"] + F.when(w == "[", 1).when(w == "]", -1).otherwise(0)).alias("depth"), (s["at"] + F.length(w)).alias("at"), ((w == "]") & (s["depth"] == 0)).alias("done")))
    at = F.aggregate(F.regexp_extract_all(text, F.lit(rf'(?s)"{_IN_TEXT}|[^"\[\]]++|[\[\]]'), 0), start, step, lambda s: s["at"])
    return F.substring(text, at, F.length(text))


def scan(chunks: DataFrame) -> Scan:
    """The items of every document, and what is wrong with documents that give none."""
    marked = cut(_marked(chunks), "json-chunks")
    placed = cut(_placed(marked.drop("value", "size")), "json-places")
    here = F.struct("block", "seq")
    opens = placed.where((F.col("open").isNotNull()) & (F.col("depth") + F.col("open.depth") == 1)).groupBy("crate_id").agg(
        F.min(F.struct(here.alias("key"), "open.at", "open.lead.commas", "open.lead.closes", "open.lead.begins")).alias("first"))
    closes = (F.col("lead.closes") & (here > F.col("first.key"))) | (F.col("first.closes") & (here == F.col("first.key")))
    ends = join_facts(placed, opens, ["crate_id"], "seq").where(closes).groupBy("crate_id").agg(F.min(here).alias("last"))
    known = join_facts(placed, opens.join(ends, "crate_id", "left"), ["crate_id"], "seq", how="left")
    first, last = F.col("first.key"), F.col("last")
    at_first = F.coalesce(here == first, F.lit(False))
    commas = F.when(at_first, F.col("first.commas")).otherwise(F.col("lead.commas"))
    begins = F.when(at_first, F.col("first.begins")).otherwise(F.col("lead.begins"))
    listed = known.where((here >= first) & (here < last))
    within = running_sum(listed, ["crate_id"], ["seq"], commas, F.col("block"), "before").select(
        *_KEY, "outside", (F.col("before") + commas).alias("pos"), begins.alias("begins"), F.when(at_first, F.col("first.at")).alias("skip"))
    body = F.when(F.col("skip").isNotNull(), F.expr("substring(value, skip + 1)")).otherwise(_after_text("outside"))
    value = F.when(F.col("begins"), F.regexp_replace(body, _LEAD, "")).otherwise(F.col("value"))
    # an item that is no object has no chunk that begins it
    items = marked.select(*_KEY, "value").join(within, _KEY).groupBy("crate_id", "pos").agg(
        F.array_sort(F.collect_list(F.struct("block", "seq", value.alias("value")))).alias("parts"), F.count_if("begins").alias("n")).where("n > 0")
    items = cut(items.select("crate_id", "pos", F.when(F.col("n") == 1, F.lit("")).alias("one"), F.concat(F.array_join(F.transform("parts", lambda p: p["value"]), "}"), F.lit("}")).alias("json")), "json-items")  # two objects at one place lack a comma
    alone = F.coalesce(here == last, F.lit(False))
    outer = known.where(at_first | F.coalesce(here < first, first.isNull()) | F.coalesce(here >= last, F.lit(False))).select(
        *_KEY, "outside", "depth", F.when(at_first & ~alone, F.col("first.at")).alias("upto"), (alone & ~at_first).alias("closing"))
    said = F.when(F.col("upto").isNotNull(), F.expr("substring(value, 1, upto)")).when(
        F.col("closing"), F.concat(_from_close(_after_text("outside"), F.col("depth") - 2), F.lit("}"))).otherwise(F.concat("value", F.lit("}")))
    frames = marked.select(*_KEY, "value").join(outer, _KEY).groupBy("crate_id").agg(F.array_sort(F.collect_list(F.struct("block", "seq", said.alias("said")))).alias("parts"))
    frames = frames.select("crate_id", F.array_join(F.transform("parts", lambda p: p["said"]), "").alias("frame"))
    # a file may end in a brace, then its last chunk was closed, or in anything else
    whole = marked.groupBy("crate_id").agg((F.sum(F.octet_length("value") + 1) == F.max("size")).alias("closed"))
    frames = frames.join(whole, "crate_id").select("crate_id", F.when(F.coalesce("closed", F.lit(False)), F.col("frame")).otherwise(F.expr("substring(frame, 1, length(frame) - 1)")).alias("frame"))
    return _judged(items, frames)


def _whole(text: Column) -> Column:
    """The value of a text that is one JSON value and nothing else; the parser alone ignores what follows."""
    values = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    return F.when(F.size(values) == 1, F.get(values, F.lit(0)))


def _judged(items: DataFrame, frames: DataFrame) -> Scan:
    v = _whole(F.col("frame"))
    graph = F.schema_of_variant(F.try_variant_get(v, "$['@graph']", "variant"))
    wrong = F.when(v.isNull() & (F.length("frame") > PARSED), "too large outside @graph").when(v.isNull(), "not JSON") \
        .when(graph.isNull(), "no @graph").when(~F.startswith(graph, F.lit("ARRAY")), "@graph is not a list")
    bad = F.when(_whole(F.concat("one", "json")).isNull(), F.when(F.length("json") > PARSED, "an item is too large").otherwise("not JSON"))
    problems = frames.select("crate_id", wrong.alias("problem")).unionByName(items.select("crate_id", bad.alias("problem")))
    problems = cut(problems.where("problem is not null").groupBy("crate_id").agg(F.min("problem").alias("problem")), "json-problems")
    return Scan(items.join(problems, "crate_id", "left_anti").drop("one"), problems)
