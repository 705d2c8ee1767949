"""JSON files that hold one array of objects, read by many tasks.

A file is cut at every ``{``, as text is at line ends, so its splits go to different
tasks. Whether a brace stands in a string, and how deep it is, depends on all text
before it. A first pass therefore sums up each split for either way it may begin: one
row per split. From these the state at the start of every split follows, and a second
pass puts the objects together. Objects that lie within a split stay in their task;
only those that cross an edge are gathered from their pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What matters to the state: escaped characters, quotes and closing braces.
TOKEN = re.compile(r'\\.|["}]', re.S)
#: The number of an object that crosses the end of the split it begins in, as its last.
CROSSING = 1 << 62


def read_json_array(
    spark: SparkSession, path: str, schema: T.StructType, entry: str | None = None
) -> DataFrame:
    """The objects of all arrays under ``path``; one that doesn't parse fails the job.
    ``entry`` names a column to add, by which they sort as they stand in the files."""
    pieces = (
        spark.read.option("lineSep", "{")
        .text(str(path))
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            "value",
        )
    )
    starts = spark.sparkContext.broadcast(_starts(pieces.mapInPandas(_summed, SUMMARY).collect()))

    def objects(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _objects(batches, starts.value)

    found = pieces.mapInPandas(objects, "file string, origin long, place long, nth long, text string")
    parts = F.array_sort(F.collect_list(F.struct("place", "text")))
    split = (
        found.where(F.col("nth") == CROSSING)
        .groupBy("file", "origin", "nth")
        .agg(F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text"))
    )
    texts = found.where(F.col("nth") < CROSSING).drop("place").unionByName(split)
    parsed = texts.select(
        F.struct("file", "origin", "nth").alias("entry"),
        F.from_json("text", schema, {"mode": "FAILFAST"}).alias("row"),
    )
    return parsed.select("row.*", *([F.col("entry").alias(entry)] if entry else []))


def _splits(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple[str, int], str, bool]]:
    """Split, piece, and whether a brace stands before it (all but a file's first)."""
    last = None
    for batch in batches:
        for file, start, value in zip(batch["file"], batch["start"], batch["value"]):
            yield (file, start), value, start > 0 or (file, start) == last
            last = (file, start)


SUMMARY = "file string, start long, odd boolean, net0 long, low0 long, net1 long, low1 long"


def _summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per split: whether its quotes are odd, and for a start outside (0) and inside (1)
    of a string the change of depth and its lowest value on the way."""
    present, odd, net, low = None, False, [0, 0], [0, 0]
    rows = []
    for split, piece, braced in _splits(batches):
        if split != present:
            if present is not None:
                rows.append((*present, odd, net[0], low[0], net[1], low[1]))
            present, odd, net, low = split, False, [0, 0], [0, 0]
        # of the two ways to begin, one is outside of strings here
        if braced:
            net[odd] += 1
        for token in TOKEN.finditer(piece):
            if token[0] == '"':
                odd = not odd
            elif token[0] == "}":
                net[odd] -= 1
                low[odd] = min(low[odd], net[odd])
    if present is not None:
        rows.append((*present, odd, net[0], low[0], net[1], low[1]))
    yield pd.DataFrame(rows, columns=[c.split()[0] for c in SUMMARY.split(", ")])


def _starts(rows: list) -> dict[tuple[str, int], tuple[bool, int, int]]:
    """Inside a string, depth, and where the open object began, at each split's start."""
    found: dict[tuple[str, int], tuple[bool, int, int]] = {}
    file, inside, depth, origin = None, False, 0, 0
    for r in sorted(rows, key=lambda r: (r.file, r.start)):
        if r.file != file:
            file, inside, depth, origin = r.file, False, 0, 0
        found[r.file, r.start] = (inside, depth, origin)
        net, low = (r.net1, r.low1) if inside else (r.net0, r.low0)
        if depth == 0 or depth + low <= 0:
            origin = r.start  # what is open at the end began here
        inside, depth = inside != r.odd, depth + net
    return found


def _objects(
    batches: Iterator[pd.DataFrame], starts: dict[tuple[str, int], tuple[bool, int, int]]
) -> Iterator[pd.DataFrame]:
    """Whole objects, and the pieces of those that cross the edges of a split."""
    present, inside, depth, origin = None, False, 0, 0
    held: list[str] = []
    rows: list[tuple] = []
    nth = 0

    def close(whole: bool) -> None:
        nonlocal nth
        rows.append((present[0], origin, present[1], nth if whole else CROSSING, "".join(held)))
        held.clear()
        nth += 1

    for split, piece, braced in _splits(batches):
        if split != present:
            if held:
                close(whole=False)
            present = split
            inside, depth, origin = starts[split]
            here = depth == 0
        if braced:
            if not inside:
                depth += 1
                if depth == 1:
                    here, origin = True, split[1]
            if depth:
                held.append("{")
        at = 0
        for token in TOKEN.finditer(piece):
            if token[0] == '"':
                inside = not inside
            elif token[0] == "}" and not inside and depth:
                depth -= 1
                if depth == 0:
                    held.append(piece[at : token.end()])
                    at = token.end()
                    close(whole=here)
        if depth:
            held.append(piece[at:])
        if len(rows) >= 1000:
            yield _frame(rows)
            rows.clear()
    if held:
        close(whole=False)
    yield _frame(rows)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["file", "origin", "place", "nth", "text"])
