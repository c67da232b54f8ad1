"""Debate XML files as rows, in document order."""

from __future__ import annotations

import io
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import clean_lines, date_from_path
from ..operators.discourse import headings

TAGS = ("major-heading", "minor-heading", "speech")
FIELDS = ("id", "speakername", "speakerid", "person_id")
ROWS = "path string, pos int, tag string, text string, " + ", ".join(f"{f} string" for f in FIELDS)


def element_text(element: ET.Element) -> str:
    """All text below an element; a space follows each line break."""
    parts = [element.text or ""]
    for child in element:
        parts.append(element_text(child))
        parts.append((" " if child.tag == "br" else "") + (child.tail or ""))
    return "".join(parts)


FAULT = "fault"


def elements(path: str, content: bytes | None) -> Iterator[tuple]:
    """Direct children of the root; a fault in the file ends them with a row that tells it, at the place it came."""
    depth, pos, none = 0, 0, (None,) * len(FIELDS)
    if content is None:
        yield (path, pos, FAULT, "no content", *none)
        return
    try:
        for event, element in ET.iterparse(io.BytesIO(content), ("start", "end")):
            depth += 1 if event == "start" else -1
            if event == "end" and depth == 1 and element.tag in TAGS:
                yield (path, pos, element.tag, element_text(element), *(element.get(f, "NA") for f in FIELDS))
                pos += 1
                element.clear()
    except ET.ParseError as fault:
        yield (path, pos, FAULT, str(fault), *none)


def _parsed(files: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in ROWS.split(", ")]
        for batch in batches:
            rows = [r for p, c in zip(batch["path"], batch["content"], strict=True) for r in elements(p, None if c is None else bytes(c))]
            yield pd.DataFrame(rows, columns=names)

    return files.select("path", "content").mapInPandas(run, ROWS)


def parse_files(files: DataFrame) -> DataFrame:
    """(path, pos, tag, text, attributes) from (path, content); rows before a fault are kept."""
    return _parsed(files).filter(F.col("tag") != FAULT)


def faulty_files(files: DataFrame) -> DataFrame:
    """(path, rows_kept, fault) of the files that could not be read to their end; empty files are among them."""
    return _parsed(files).filter(F.col("tag") == FAULT).select("path", F.col("pos").cast("long").alias("rows_kept"), F.col("text").alias("fault"))


def debates(rows: DataFrame, strict: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Speeches with headings, date and year, and the columns of ``keep``."""
    named = rows.withColumn("text", clean_lines(F.col("text")))
    out = headings(named, strict).withColumn("date", date_from_path(F.col("path")))
    return out.select(
        F.col("id").alias("speech_id"), "speakername", F.col("speakerid").alias("speaker_id"), "person_id", F.col("text").alias("speech"),
        "date", F.substring("date", 1, 4).alias("year"), "major_heading", "minor_heading", *keep,
    )


def parse_debates(spark: SparkSession, root: str, strict: bool = False) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xml").load(root)
    return debates(parse_files(files), strict)
