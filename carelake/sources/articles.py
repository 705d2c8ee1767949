"""Literature sources: article XML and the JSON corpus."""

from __future__ import annotations

import re
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import ship_package
from ..schemas import ABSTRACT_SCHEMA, ARTICLE_SCHEMA, CORRUPT_RECORD
from .json_array import read_json_array

# Element names of the article format.
ARTICLE_END = "</PubmedArticle>"
ARTICLE_START = re.compile(r"<PubmedArticle[\s>]")
FIELD_OF = {"PMID": "pmid", "ArticleTitle": "title"}
FIELD_INSIDE = {("Journal", "Title"): "journal", ("PubDate", "Year"): "year"}
SECTION, SECTION_LABEL = ("Abstract", "AbstractText"), "Label"
AUTHOR, AUTHOR_NAMES = ("AuthorList", "Author"), ("LastName", "Initials")


def read_article_xml(
    spark: SparkSession, path: str, mode: str = "FAILFAST"
) -> DataFrame:
    """One row per article that has an abstract.

    The end tag serves as the record separator, so files are split like any text
    and a file of any size is read by many tasks. ``PERMISSIVE`` keeps the text
    of a malformed article in ``_corrupt_record`` where ``FAILFAST`` stops.
    """
    if mode not in ("FAILFAST", "PERMISSIVE"):
        raise ValueError(f"mode must be FAILFAST or PERMISSIVE, got {mode!r}")
    ship_package(spark)
    records = spark.read.option("lineSep", ARTICLE_END).text(str(path))
    columns = [*ARTICLE_SCHEMA.names, CORRUPT_RECORD]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["value"]:
                start = ARTICLE_START.search(text)
                if start is None:
                    continue
                fragment = text[start.start() :] + ARTICLE_END
                try:
                    article = parse_article(fragment)
                except ElementTree.ParseError:
                    if mode == "FAILFAST":
                        raise
                    article = {CORRUPT_RECORD: fragment}
                if article is not None:
                    rows.append(dict.fromkeys(columns) | article)
            yield pd.DataFrame(rows, columns=columns, dtype="object")

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ARTICLE_SCHEMA)
    parsed = records.mapInPandas(parse, f"{fields}, {CORRUPT_RECORD} string")
    return parsed.drop(CORRUPT_RECORD) if mode == "FAILFAST" else parsed


def parse_article(xml: str) -> dict | None:
    """Fields of one article, or none if it has no abstract.

    One pass over the elements as they close. A field that occurs more than once
    keeps its first value; text inside nested markup is not part of a field.
    """
    parser = ElementTree.XMLPullParser(("start", "end"))
    parser.feed(xml)
    parser.close()
    found: dict[str, str] = {}
    sections: list[str] = []
    authors: list[str] = []
    open_tags: list[str] = [""]
    for event, element in parser.read_events():
        if event == "start":
            open_tags.append(element.tag)
            continue
        open_tags.pop()
        place = (open_tags[-1], element.tag)
        text = element.text or ""
        field = FIELD_OF.get(element.tag) or FIELD_INSIDE.get(place)
        if field:
            found.setdefault(field, text)
        elif place == SECTION:
            label = element.get(SECTION_LABEL)
            sections.append(f"{label}: {text.strip()}" if label else text.strip())
        elif place == AUTHOR:
            names = {part.tag: part.text or "" for part in reversed(element)}
            authors.append(" ".join(names.get(t, "") for t in AUTHOR_NAMES).strip())
    abstract = " ".join(s for s in sections if s)
    if not abstract:
        return None
    fields = {name: found.get(name, "") for name in ("pmid", "title", "journal", "year")}
    return {**fields, "abstract": abstract, "authors": [a for a in authors if a]}


def write_corpus(abstracts: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines; nulls are written too, so every line has every field."""
    abstracts.select(*ABSTRACT_SCHEMA.names).write.option("ignoreNullFields", "false").mode(
        mode
    ).json(str(path))


def read_corpus(
    spark: SparkSession, path: str, array_file: bool = False, entry: str | None = None
) -> DataFrame:
    """JSON lines, or with ``array_file`` files that hold one array each; both are split.
    ``entry`` names a column to add, by which rows sort as they stand in the files."""
    if array_file:
        ship_package(spark)
        return read_json_array(spark, path, ABSTRACT_SCHEMA, entry)
    lines = spark.read.schema(ABSTRACT_SCHEMA).option("mode", "FAILFAST").json(str(path))
    if entry is None:
        return lines
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("nth"),
    )
    return lines.select("*", place.alias(entry))
