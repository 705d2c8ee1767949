"""Mixing documents to target shares by iterative proportional fitting.

Token weights are summed per cell (source, language, topic). The cells are raked:
each marginal in turn is scaled to its target share, again and again, until all
three hold. A document is then drawn with the probability of its cell: the raked
weight over the cell's tokens, scaled so that the expected tokens meet a budget,
and never above one. Everything is built-in SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import settle
from .common import attach_small, set_apart, sql_words

DIMENSIONS = ("source", "lang", "topic")
#: Target share of a value: its share of the tokens to this power, normalised.
POWERS = {"source": 0.7, "lang": 0.7, "topic": 0.5}
#: Share of all tokens to keep.
BUDGET = 0.75
CYCLES = 12
SCALINGS = 12
#: Cells of a partition while they are raked.
CELLS = 100_000
NONE = "(none)"


def n_tokens(text: Column) -> Column:
    """Weight of a document: its words."""
    return F.size(sql_words(text)).cast("long")


def topic_of(text: Column, tokens: Column) -> Column:
    """A coarse kind of text, by the first rule that holds."""
    plain = F.coalesce(text, F.lit(""))
    lines = F.length(plain) - F.length(F.replace(plain, F.lit("\n"), F.lit(""))) + 1
    return (
        F.when(plain.contains("icense") | plain.contains("opyright"), "legal")
        .when(plain.contains("@") | plain.contains("://"), "contact")
        .when(tokens < 100, "brief")
        .when(F.length(plain) < 60 * lines, "lines")
        .when(tokens > 1500, "long")
        .otherwise("prose")
    )


def measured(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` beside mix_source, mix_lang, mix_topic and mix_tokens."""
    text = F.col("text").cast("string")
    rows = docs.withColumn("mix_tokens", n_tokens(text))
    return rows.withColumns(
        {
            "mix_source": F.coalesce(F.col("source").cast("string"), F.lit(NONE)),
            "mix_lang": F.coalesce(F.col("lang").cast("string"), F.lit(NONE)),
            "mix_topic": topic_of(text, F.col("mix_tokens")),
        }
    )


def tempered_targets(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """(value, target): shares of the tokens, flattened by a power below one."""
    sums = cells.groupBy(dimension).agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    part = F.pow(F.col("tokens").cast("double"), power)
    whole = sums.agg(F.sum(part)).first()[0]  # one number
    return sums.select(dimension, (part / F.lit(whole)).alias("target"))


def raked(cells: DataFrame, targets: dict[str, DataFrame], cycles: int = CYCLES) -> DataFrame:
    """``cells`` (the dimensions, tokens) with a weight whose marginal shares are
    the targets, as near as they can be.

    Cells without tokens keep the weight zero. A value without a target gets none
    of the weight; a target without cells is spread over the others as shares
    are renormalised by the last dimension raked.
    """
    for dimension, target in targets.items():
        goal = target.select(dimension, F.col("target").alias(f"goal_{dimension}"))
        cells = cells.join(goal, dimension, "left").fillna(0.0, [f"goal_{dimension}"])
    cells = settle(cells.withColumn("weight", F.col("tokens").cast("double")))
    for _ in range(cycles):
        for dimension in targets:
            sums = cells.groupBy(dimension).agg(F.sum("weight").alias("whole"))
            ratio = F.when(F.col("whole") > 0, F.col("weight") * F.col(f"goal_{dimension}") / F.col("whole"))
            cells = cells.join(sums, dimension).withColumn("weight", F.coalesce(ratio, F.lit(0.0))).drop("whole")
        cells = settle(cells)
    return cells


def probabilities(cells: DataFrame, budget: float = BUDGET) -> DataFrame:
    """The cells with the probability of their documents.

    Probabilities stop at one, so the scale is raised until the expected tokens
    meet the budget: a number of rounds over sums of one row each.
    """
    cells = cells.withColumn("per_token", F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")))
    whole = cells.agg(F.sum("tokens").alias("tokens"), F.sum("weight").alias("weight")).first()
    if not whole["tokens"] or not whole["weight"]:
        return cells.withColumn("probability", F.lit(0.0))
    goal = budget * whole["tokens"]
    scale = goal / whole["weight"]
    for _ in range(SCALINGS):
        met = cells.agg(F.sum(F.col("tokens") * F.least(F.lit(1.0), F.col("per_token") * scale))).first()[0]
        scale *= goal / met
    return cells.withColumn("probability", F.least(F.lit(1.0), F.coalesce(F.col("per_token") * scale, F.lit(0.0))))


def cell_probabilities(rows: DataFrame, budget: float = BUDGET, powers: dict[str, float] = POWERS) -> DataFrame:
    """(mix_source, mix_lang, mix_topic, probability) of measured rows."""
    cells = rows.groupBy(*(F.col(f"mix_{d}").alias(d) for d in DIMENSIONS)).agg(F.sum("mix_tokens").alias("tokens"))
    cells = settle(cells)
    # few cells fit one partition, where raking needs no shuffle at all
    cells = cells.coalesce(-(-max(1, cells.count()) // CELLS))
    targets = {d: tempered_targets(cells, d, powers[d]) for d in DIMENSIONS}
    fitted = probabilities(raked(cells, targets), budget)
    return fitted.select(*(F.col(d).alias(f"mix_{d}") for d in DIMENSIONS), "probability")


def draw(doc_id: Column, text: Column) -> Column:
    """A number from 0 to 1 by a digest of the id, or of the text without one."""
    name = F.concat(F.lit("mix|"), F.coalesce(doc_id.cast("string"), F.md5(text.cast("binary")), F.lit("")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 7), 16, 10).cast("double") / float(1 << 28)


def mixed(docs: DataFrame, budget: float = BUDGET) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, probability and selected per row.

    Null sources and languages are a value of their own. Rows without words weigh
    nothing; they are drawn with the probability of their cell (zero if the cell
    has no words at all). Equal ids are drawn alike. An empty table gives no rows.
    """
    rows = measured(docs.select("doc_id", "text", "source", "lang")).withColumn(
        "mix_draw", draw(F.col("doc_id"), F.col("text"))
    )
    rows = settle(rows.drop("text", "source", "lang"))
    judged = attach_small(rows, cell_probabilities(rows, budget), [f"mix_{d}" for d in DIMENSIONS])
    return judged.select(
        "doc_id",
        *(F.col(f"mix_{d}").alias(d) for d in DIMENSIONS),
        F.col("mix_tokens").alias("n_tokens"),
        F.round("probability", 6).alias("probability"),
        (F.col("mix_draw") < F.col("probability")).alias("selected"),
    )


def select_mixed(docs: DataFrame, budget: float = BUDGET) -> DataFrame:
    """The rows of ``docs`` that ``mixed`` selects, unchanged. The cells are joined
    to the texts, broadcast if they measure small."""
    cells = cell_probabilities(settle(measured(docs.select("text", "source", "lang")).drop("text", "source", "lang")), budget)
    names = [f"mix_{d}" for d in DIMENSIONS]
    rows, restored = set_apart(docs, ("doc_id", "text", "source", "lang"))
    judged = attach_small(measured(rows), cells, names)
    return restored(judged.where(draw(F.col("doc_id"), F.col("text")) < F.col("probability")))


def oracle(budget: float = BUDGET, cycles: int = CYCLES, scalings: int = SCALINGS) -> str:
    """The same in DuckDB's SQL: every raking step is one more subquery."""
    steps = []
    last = "goals"
    for i in range(cycles):
        for d in DIMENSIONS:
            name = f"rake_{i}_{d}"
            steps.append(
                f"{name} AS (SELECT * EXCLUDE (weight), coalesce(CASE WHEN sum(weight) OVER (PARTITION BY {d}) > 0 "
                f"THEN weight * goal_{d} / sum(weight) OVER (PARTITION BY {d}) END, 0) AS weight FROM {last})"
            )
            last = name
    for i in range(scalings):
        name = f"scale_{i}"
        start = f"{budget} * sum(tokens) OVER () / sum(weight) OVER ()" if i == 0 else "scale"
        steps.append(
            f"{name} AS (SELECT * REPLACE (scale * {budget} * sum(tokens) OVER () "
            f"/ sum(tokens * least(1.0, per_token * scale)) OVER () AS scale) FROM "
            f"(SELECT * {'' if i == 0 else 'EXCLUDE (scale)'}, {start} AS scale"
            f"{', CASE WHEN tokens > 0 THEN weight / tokens END AS per_token' if i == 0 else ''} FROM {last}))"
        )
        last = name
    targets = ", ".join(
        f"target_{d} AS (SELECT {d}, pow(t, {POWERS[d]}) / sum(pow(t, {POWERS[d]})) OVER () AS goal_{d} "
        f"FROM (SELECT {d}, sum(tokens)::DOUBLE AS t FROM cells GROUP BY {d}) WHERE t > 0)"
        for d in DIMENSIONS
    )
    joins = " ".join(f"LEFT JOIN target_{d} USING ({d})" for d in DIMENSIONS)
    goals = ", ".join(f"coalesce(goal_{d}, 0) AS goal_{d}" for d in DIMENSIONS)
    return rf"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> ''))::BIGINT AS n_tokens,
    ('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, md5(text), '')), 1, 7))::BIGINT / 268435456.0 AS draw
  FROM documents
), measured AS (
  SELECT *, CASE WHEN contains(text, 'icense') OR contains(text, 'opyright') THEN 'legal'
    WHEN contains(text, '@') OR contains(text, '://') THEN 'contact'
    WHEN n_tokens < 100 THEN 'brief'
    WHEN length(text) < 60 * (length(text) - length(replace(text, chr(10), '')) + 1) THEN 'lines'
    WHEN n_tokens > 1500 THEN 'long' ELSE 'prose' END AS topic
  FROM texts
), cells AS (
  SELECT source, lang, topic, sum(n_tokens)::BIGINT AS tokens FROM measured GROUP BY ALL
), {targets}, goals AS (
  SELECT source, lang, topic, tokens, {goals}, tokens::DOUBLE AS weight FROM cells {joins}
), {", ".join(steps)}, chosen AS (
  SELECT source, lang, topic, least(1.0, coalesce(per_token * scale, 0)) AS p FROM {last}
)
SELECT doc_id, source, lang, topic, n_tokens, round(p, 6) AS probability, draw < p AS selected
FROM measured JOIN chosen USING (source, lang, topic)
"""
