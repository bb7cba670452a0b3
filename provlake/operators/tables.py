"""Table profiling over cells(file, row, col, cell): header names, comment preamble, column
type race, wide-table collapse, schema documents.

``row`` and ``col`` are 0-based. Rows may be sparse; a cell missing from a row that is
shorter than the header is a null cell.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provlake.functions import cells as C
from provlake.functions.text import trim_ws
from provlake.operators.skew import join_facts
from provlake.session import cut, short_methods

# Confidence and comment character.
BLOCK_ROWS = 10_000
CONFIDENCE = 0.9
COMMENT_CHAR = "#"


def header_names(header: DataFrame) -> DataFrame:
    """(file, col, label) -> (file, col, name): blanks numbered, repeats suffixed."""
    label = trim_ws(F.replace(F.coalesce("label", F.lit("")), F.lit("\n"), F.lit(" ")))
    named = header.select("file", "col", F.when(label == "", F.concat(F.lit("field"), F.col("col") + 1))
                          .otherwise(label).alias("base"))
    nth = F.row_number().over(Window.partitionBy("file", "base").orderBy("col"))
    return named.select("file", "col", F.when(nth > 1, F.concat("base", nth)).otherwise(F.col("base")).alias("name"))


def first_data_rows(records: DataFrame, comment_char: str = COMMENT_CHAR) -> DataFrame:
    """(file, row, width, first) -> (file, header_row): the row the header is on.

    A marked row counts as header if the row after it is as wide. Rows meet their successor by a
    join on file and row, so a file of any length is many tasks' work. A file of comments only
    has no header row.
    """
    if not comment_char:
        return records.groupBy("file").agg(F.min("row").alias("header_row"))
    marked = F.startswith(F.coalesce("first", F.lit("")), F.lit(comment_char))
    after = records.select("file", (F.col("row") - 1).alias("row"), F.col("width").alias("next_width"))
    bed = records.where(marked & (F.col("width") > 1)).join(after, ["file", "row"]).where("width = next_width").select("file", "row")
    return records.where(~marked).select("file", "row").unionByName(bed).groupBy("file").agg(F.min("row").alias("header_row"))


def drop_preamble(cells: DataFrame, comment_char: str = COMMENT_CHAR) -> DataFrame:
    """Cells without comment rows, rows renumbered so that the header is row 0."""
    records = cells.groupBy("file", "row").agg(
        F.count("*").alias("width"), F.max(F.when(F.col("col") == 0, F.col("cell"))).alias("first"))
    header = first_data_rows(records, comment_char)
    return join_facts(cells, header, ["file"], "row").where(F.col("row") >= F.col("header_row")).select(
        "file", (F.col("row") - F.col("header_row")).alias("row"), "col", "cell")


def scores(cell) -> list[Column]:
    """Per candidate, over prepared cells: 0 for a missing cell, else +1 readable / -1 not."""
    c = F.col(cell)
    missing = c.isNotNull() & (c == "")
    return [F.when(missing, 0).when(C.readable(kind, cell, ready=True), 1).otherwise(-1).cast("tinyint").alias(f"d{i}")
            for i, kind in enumerate(C.CANDIDATES)]


def _winner(n: Column, missing: Column, totals: list[Column], lows: list[Column]) -> Column:
    """First candidate, in race order, that wins at this row."""
    floor = n * F.lit(CONFIDENCE - 1)
    best = n - missing
    wins = [F.when((low >= floor) & (best > 0) & (total >= best * F.lit(CONFIDENCE)), kind)
            for kind, total, low in zip(C.CANDIDATES, totals, lows)]
    return F.coalesce(*wins)


def type_race(values: DataFrame, rows: DataFrame, block_rows: int | None = None) -> DataFrame:
    """Column types of (file, row, col, cell) with (file, n_rows).

    Candidates gain a point per readable cell and lose one otherwise; one that falls below
    the floor is out for good; the first to reach 90 % of the non-missing cells wins, else 'any'.

    ``block_rows``: without it a column is one window, right for sampled files. With it the
    running sums are taken inside blocks of that many rows and joined to the totals of the
    blocks before, so a file of any length spreads over the cluster.
    """
    n_c = len(C.CANDIDATES)
    keys = ["file", "col"]
    cells = values.select(*keys, "row", "cell")
    if block_rows is None:
        block = keys
    else:
        # shuffled as text once: cells are scored where their block is summed, by many tasks
        # even when the input is one file
        block = keys + ["block"]
        cells = cells.withColumn("block", F.floor(F.col("row") / block_rows)).repartition(*block)
    scored = C.prepared(cells).select(*block, "row", F.when(F.col("cell") == "", 1).otherwise(0).alias("miss"), *scores("cell"))
    upto = Window.partitionBy(*block).orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*block).orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    run = scored.select(*block, "row", F.sum("miss").over(upto).alias("miss"),
                        *[F.sum(f"d{i}").over(upto).alias(f"s{i}") for i in range(n_c)])
    # lowest score reached before this row; the start counts as 0
    run = run.select(*block, "row", "miss", *[f"s{i}" for i in range(n_c)],
                     *[F.min(f"s{i}").over(before).alias(f"m{i}") for i in range(n_c)])
    if block_rows is not None:
        # block totals and rows both read the sums: take them once
        with short_methods(values.sparkSession):
            run = cut(run, "block-sums")
        offs = run.groupBy(*block).agg(
            F.max_by("miss", "row").alias("b_miss"), *[F.max_by(f"s{i}", "row").alias(f"t{i}") for i in range(n_c)],
            *[F.min(f"s{i}").alias(f"l{i}") for i in range(n_c)])
        earlier = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        zero = lambda c: F.coalesce(c, F.lit(0))
        offs = offs.select(
            *block, *[f"l{i}" for i in range(n_c)], zero(F.sum("b_miss").over(earlier)).alias("o_miss"),
            *[zero(F.sum(f"t{i}").over(earlier)).alias(f"o{i}") for i in range(n_c)])
        offs = offs.select(*block, "o_miss", *[f"o{i}" for i in range(n_c)],
                           *[F.min(F.col(f"o{i}") + F.col(f"l{i}")).over(earlier).alias(f"p{i}") for i in range(n_c)])
        run = run.join(offs, block).select(
            *keys, "row", (F.col("miss") + F.col("o_miss")).alias("miss"),
            *[(F.col(f"s{i}") + F.col(f"o{i}")).alias(f"s{i}") for i in range(n_c)],
            *[F.least(F.col(f"p{i}"), F.col(f"m{i}") + F.col(f"o{i}"), F.col(f"o{i}")).alias(f"m{i}")
              for i in range(n_c)])
    run = join_facts(run, rows.select("file", "n_rows"), ["file"], "row")
    winner = _winner(F.col("n_rows"), F.col("miss"), [F.col(f"s{i}") for i in range(n_c)],
                     [F.coalesce(F.col(f"m{i}"), F.lit(0)) for i in range(n_c)])
    types = run.select(*keys, "row", winner.alias("won")).groupBy(*keys).agg(
        F.coalesce(F.min_by("won", F.when(F.col("won").isNotNull(), F.col("row"))), F.lit("any")).alias("source_type"))
    if block_rows is None:
        return types
    with short_methods(values.sparkSession):
        return cut(types, "types")


def with_short_rows(cells: DataFrame, names: DataFrame) -> DataFrame:
    """Null cells for the columns a data row is too short to have; extra cells dropped."""
    rows = cells.where(F.col("row") > 0).select("file", "row").distinct()
    grid = rows.join(names.select("file", "col"), "file")
    return grid.join(cells, ["file", "row", "col"], "left")


def property_rows(names: DataFrame, types: DataFrame) -> DataFrame:
    """(file, col, name, type, source_type): the original type kept only when it says more."""
    source = F.coalesce(F.col("source_type"), F.lit("any"))
    canon = C.canonical_type(source)
    return names.join(types, ["file", "col"], "left").select(
        "file", "col", "name", canon.alias("type"), F.when(canon != source, source).alias("source_type"),
        source.alias("detected"))


def infer_schemas(cells: DataFrame, sample_rows: int | None = None, comment_char: str = COMMENT_CHAR) -> DataFrame:
    """Property rows per file from raw cells: preamble, header, race. Every row counts, in blocks;
    with ``sample_rows`` only that many first rows do."""
    body = drop_preamble(cells, comment_char)
    if sample_rows is not None:
        body = body.where(F.col("row") <= sample_rows)
    names = header_names(body.where(F.col("row") == 0).select("file", "col", F.col("cell").alias("label")))
    data = with_short_rows(body, names)
    counts = body.where(F.col("row") > 0).groupBy("file").agg(F.countDistinct("row").alias("n_rows"))
    return property_rows(names, type_race(data, counts, None if sample_rows is not None else BLOCK_ROWS))


def collapse_trailing(props: DataFrame, threshold: int) -> DataFrame:
    """Fold a trailing run of at least ``threshold`` equal types into one array property.

    Output: (file, position, name, index, type, source_type, item_type, span, first_name, last_name).
    The name is 'values', prefixed by '_' until no kept column has it.
    """
    props = cut(props, "properties")
    last = props.groupBy("file").agg(F.max_by("detected", "col").alias("last_type"), F.max("col").alias("last_col"))
    runs = props.join(last, "file").groupBy("file").agg(
        F.first("last_type").alias("last_type"), F.first("last_col").alias("last_col"),
        F.coalesce(F.max(F.when(F.col("detected") != F.col("last_type"), F.col("col"))) + 1, F.lit(0)).alias("start"))
    runs = runs.withColumn("span", F.col("last_col") + 1 - F.col("start")).withColumn(
        "fold", (F.col("span") >= threshold) & (F.col("start") > 0) if threshold > 0 else F.lit(False))
    joined = props.join(runs, "file")
    kept = joined.where(~F.col("fold") | (F.col("col") < F.col("start"))).select(
        "file", F.col("col").alias("position"), "name", F.col("col").cast("string").alias("index"), "type", "source_type",
        F.lit(None).cast("string").alias("item_type"), F.lit(None).cast("int").alias("span"),
        F.lit(None).cast("string").alias("first_name"), F.lit(None).cast("string").alias("last_name"))
    # names that could clash are 'values', '_values', ...: the first free one has as many
    # underscores as there are consecutive taken ones, counted from none
    taken = joined.where(F.col("fold") & (F.col("col") < F.col("start")) & F.col("name").rlike(r"\A_*values\z")) \
        .select("file", (F.length("name") - 6).alias("k")).distinct()
    # the k-th smallest taken count equals k-1 exactly while there is no gap
    run_up = taken.withColumn("rank", F.row_number().over(Window.partitionBy("file").orderBy("k")) - 1) \
        .where(F.col("k") == F.col("rank")).groupBy("file").agg(F.count("*").alias("n_taken"))
    folded = joined.where(F.col("fold") & (F.col("col") >= F.col("start"))).groupBy("file").agg(
        F.first("start").alias("position"), F.first("span").alias("span"), F.first("last_type").alias("last_type"),
        F.min_by("name", "col").alias("first_name"), F.max_by("name", "col").alias("last_name"))
    folded = folded.join(run_up, "file", "left").select(
        "file", "position",
        F.concat(F.repeat(F.lit("_"), F.coalesce("n_taken", F.lit(0)).cast("int")), F.lit("values")).alias("name"),
        F.concat(F.col("position").cast("string"), F.lit("::")).alias("index"), F.lit("array").alias("type"), F.lit(None).cast("string").alias("source_type"),
        C.canonical_type("last_type").alias("item_type"), F.col("span").cast("int"), "first_name", "last_name")
    return kept.unionByName(folded)


def schema_documents(props: DataFrame) -> DataFrame:
    """One JSON-Schema document per file from collapsed property rows.

    The number of properties is bounded by the width of one table, so collecting them per
    file is safe.
    """
    text = F.when(F.col("item_type").isNull(), F.concat(F.lit("Column "), F.col("name"))).otherwise(
        F.concat(F.lit("Columns "), F.col("first_name"), F.lit(".."), F.col("last_name"), F.lit(" ("),
                 F.col("span").cast("string"), F.lit(" "), F.col("item_type"),
                 F.lit(" values) collapsed into one spanning array")))
    entry = F.struct("position", "name", text.alias("description"), "index", "type", "source_type", "item_type", "span")
    docs = props.groupBy("file").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    ext = F.lower(F.regexp_extract("file", r"\.([^./]*)\z", 1))
    return docs.select(
        "file", F.lit("object").alias("type"), F.lit(True).alias("additional_properties"),
        F.transform("entries", lambda e: e["name"]).alias("required"),
        F.when(ext == "tsv", "\t").otherwise(",").alias("separator"), F.lit(True).alias("header"),
        F.lit("tabular").alias("schema_type"),
        F.transform("entries", lambda e: F.struct(
            e["name"].alias("name"), e["description"].alias("description"), e["index"].alias("index"),
            e["type"].alias("type"), e["source_type"].alias("source_type"), e["item_type"].alias("item_type"), e["span"].alias("min_items"),
            e["span"].alias("max_items"), F.when(e["span"].isNotNull(), False).alias("unique_items"))).alias("properties"),
        F.array().cast("array<string>").alias("examples"))


def schema_texts(docs: DataFrame) -> DataFrame:
    """(file, json): the schema documents as JSON text, keys a value has none for left out."""
    q = lambda c: F.to_json(F.struct(c.alias("v")))
    value = lambda c: F.substr(q(c), F.lit(6), F.length(q(c)) - 6)
    field = lambda key, c: F.when(c.isNotNull(), F.concat(F.lit(f'"{key}":'), value(c)))
    items = lambda e: F.when(e["item_type"].isNotNull(), F.concat(F.lit('"items":{"type":'), value(e["item_type"]), F.lit("}")))
    whole = F.col("properties")
    entry = lambda e: F.concat(value(e["name"]), F.lit(":{"), F.array_join(F.array_compact(F.array(
        field("description", e["description"]),
        F.concat(F.lit('"index":'), F.when(e["item_type"].isNull(), e["index"]).otherwise(value(e["index"]))), field("type", e["type"]), field("source-type", e["source_type"]), items(e),
        field("min-items", e["min_items"]), field("max-items", e["max_items"]), field("unique-items", e["unique_items"]))), ","), F.lit("}"))
    return docs.select("file", F.concat(
        F.lit('{"@type":"EVI:Schema","type":"object","additionalProperties":true,"required":'), F.to_json("required"), F.lit(',"separator":'), value(F.col("separator")),
        F.lit(',"header":true,"examples":[],"EVI:schemaType":"tabular","properties":{'), F.array_join(F.transform(whole, entry), ","), F.lit("}}")).alias("json"))
