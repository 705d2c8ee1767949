"""Expressions on article and retrieval columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import CITATION_URL_PREFIX


def embedding_text(title: Column, abstract: Column) -> Column:
    """Title, blank line, abstract; nulls count as empty."""
    return F.concat(
        F.coalesce(title, F.lit("")), F.lit("\n\n"), F.coalesce(abstract, F.lit(""))
    )


def citation_url(pmid: Column) -> Column:
    return F.concat(F.lit(CITATION_URL_PREFIX), pmid, F.lit("/"))


def point_id(pmid: Column) -> Column:
    """Numeric id of an article, null when the PMID is not a number."""
    return pmid.try_cast("long")


def fill_payload(found: DataFrame) -> DataFrame:
    """Defaults for payload fields that are missing or null."""
    empty = F.array().cast("array<string>")
    defaults = {
        **dict.fromkeys(["pmid", "title", "abstract", "journal", "year"], F.lit("")),
        "authors": empty,
        "score": F.lit(0.0),
    }
    filled = {
        c: F.coalesce(F.col(c), d) if c in found.columns else d
        for c, d in defaults.items()
    }
    return found.withColumns(filled)
