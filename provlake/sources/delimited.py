"""Delimited files as cells: (file, row, col, cell)."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provlake.operators.filetree import is_tabular

CELLS = "file string, row int, col int, cell string"


def parse_records(text: str, delimiter: str, limit: int | None = None) -> Iterator[list[str]]:
    """Records of a delimited text: quotes open at the start of a field only, doubled quotes
    are one quote, delimiters and line ends count as text inside quotes, a blank line is a
    record of one empty field."""
    text = text.removeprefix("﻿")
    reader = csv.reader(io.StringIO(text, newline=""), delimiter=delimiter)
    for i, record in enumerate(reader):
        if limit is not None and i >= limit:
            return
        yield record or [""]


def read_cells(spark: SparkSession, path: str, max_records: int | None = None) -> DataFrame:
    """Cells of every csv/tsv file below ``path``, one file per task step.

    Quoting makes a file sequential, so the file is the unit of parallelism. With
    ``max_records`` only that many records of a file are parsed, preamble and header included.
    """
    csv.field_size_limit(1 << 30)

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        csv.field_size_limit(1 << 30)
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"]):
                delimiter = "\t" if file.lower().endswith(".tsv") else ","
                rows = []
                for r, record in enumerate(parse_records(bytes(content).decode("utf-8", "replace"), delimiter, max_records)):
                    rows += [(file, r, c, cell) for c, cell in enumerate(record)]
                    if len(rows) > 100_000:
                        yield pd.DataFrame(rows, columns=["file", "row", "col", "cell"])
                        rows = []
                yield pd.DataFrame(rows, columns=["file", "row", "col", "cell"])
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.where(is_tabular("path")).select("path", "content").mapInPandas(cells, CELLS)
