"""Merkle manifest of the documents, with a proof for every row.

Leaves are digests of rows. The leaves of a source, by doc_id, are folded in runs
of sixteen until one digest is left, and so are the results of the sources.

Proofs come by pointer jumping. A node holds an ancestor and a segment: the
siblings of every level from the node up to that ancestor. At first the ancestor
is the parent. A self-join replaces it by the ancestor's own ancestor and appends
that one's segment, so the distance doubles with each join until all have reached
the root. Sixteen leaves share a parent, so the lowest nodes that jump are the
parents of leaves; a leaf puts its place in the run in front of their segment.

Places of leaves come without a window over a whole source: rows are range-sorted
by source and doc_id, counted per range and source, and moved up by the counts of
the ranges before. A hot source or doc_id is spread over many ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lookup import broadcast_if_small
from ..runtime import settle
from .common import BROADCAST_BYTES, CRC_TABLE_SQL, attach_small, crc32_sql

RUN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The tree over the sources; sources themselves are numbered from 0.
TOP = -1
ROW_BITS = 33  # of monotonically_increasing_id, for the row within its partition


def field(value: Column) -> Column:
    """``-`` for null, else the length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """doc_id, source, the leaf, and the leaf of the row that ``tampered`` changes."""
    text = F.col("text").cast("string")
    changed = F.when(tampered, F.translate(text, UPPER, LOWER)).otherwise(text)
    rest = [field(F.col(c)) for c in FIELDS[:-1]]
    leaf = digest(*rest, field(text))
    return docs.select(
        "doc_id",
        "source",
        leaf.alias("leaf"),
        F.when(F.coalesce(changed != text, F.lit(False)), digest(*rest, field(changed))).alias("other"),
    )


def placed(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """Adds ``idx``, the place of a row among those of its ``group`` (not null),
    counted from 0 in the given order. Rows equal in all of these are dealt
    arbitrarily, and over several ranges if they are many."""
    named = rows.withColumn("_row", F.monotonically_increasing_id())
    ranges = named.repartitionByRange(group, *order, "_row").sortWithinPartitions(group, *order, "_row")
    ranged = settle(ranges.drop("_row").withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", ROW_BITS).alias("_part")
    counts = ranged.groupBy(group, part).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(group, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_move"))
    found = attach_small(ranged.withColumn("_part", part), starts, [group, "_part"], "inner")
    return found.withColumn("idx", F.col("_at") + F.col("_move")).drop("_at", "_part", "_move")


def runs(nodes: DataFrame, *carried: str) -> DataFrame:
    """Runs of sixteen nodes (s, idx, digest) with their digest, as (s, idx, digest,
    kids): kids are (idx, digest, carried) in order."""
    kids = F.array_sort(F.collect_list(F.struct("idx", "digest", *carried)))
    made = nodes.groupBy("s", F.floor(F.col("idx") / RUN).alias("up")).agg(kids.alias("kids"))
    whole = F.sha2(F.array_join(F.col("kids")["digest"], ""), 256)
    return made.select("s", F.col("up").alias("idx"), whole.alias("digest"), "kids")


def sides(kids: Column, place: Column) -> Column:
    """What stands before and behind a node in its run."""
    digests = kids["digest"]
    return F.struct(
        F.array_join(F.slice(digests, F.lit(1), place), "").alias("l"),
        F.array_join(F.slice(digests, place + 2, F.lit(RUN)), "").alias("r"),
    )


def _upwards(low: DataFrame, most: int, lowest: int) -> tuple[list[DataFrame], DataFrame]:
    """Pointers of all nodes above ``lowest`` in trees whose nodes at that level are
    ``low`` (s, idx, digest, n: nodes of s at this level), and the nodes that end up
    alone, as (s, level, digest). ``most`` is the largest n."""
    pointers, alone, level = [], [], lowest
    while True:
        alone.append(low.where("n = 1").select("s", F.lit(level).alias("level"), "digest"))
        if most <= 1:
            break
        many = low.where("n > 1")
        made = settle(runs(many, "n"))
        kid = made.select("s", F.col("idx").alias("up"), "kids", F.posexplode("kids").alias("place", "kid"))
        pointers.append(
            kid.select(
                "s",
                F.lit(level).alias("level"),
                F.col("kid")["idx"].alias("idx"),
                F.col("s").alias("to_s"),
                F.lit(level + 1).alias("to_level"),
                F.col("up").alias("to_idx"),
                F.array(sides(F.col("kids"), F.col("place"))).alias("segment"),
            )
        )
        up = F.ceil(F.col("kids")[0]["n"] / RUN).alias("n")
        low, most, level = made.select("s", "idx", "digest", up), -(-most // RUN), level + 1
    ends = alone[0]
    for more in alone[1:]:
        ends = ends.unionByName(more)
    return pointers, ends


def jumped(pointers: DataFrame) -> DataFrame:
    """(s, level, idx, segment) where every segment reaches the root: each round
    doubles the distance. Nodes of the far side stand at least that many levels up,
    so they soon are few and broadcast; before that, few nodes share an ancestor."""
    reach = 1
    while True:
        onward = pointers.where("to_s is not null")
        if onward.isEmpty():
            return pointers.drop("to_s", "to_level", "to_idx")
        far = pointers.where((F.col("s") == TOP) | (F.col("level") > reach))
        far = far.select(
            *(F.col(c).alias(f"to_{c}") for c in ("s", "level", "idx")),
            *(F.col(f"to_{c}").alias(f"far_{c}") for c in ("s", "level", "idx")),
            F.col("segment").alias("more"),
        )
        met = pointers.join(broadcast_if_small(far, BROADCAST_BYTES), ["to_s", "to_level", "to_idx"], "left")
        pointers = settle(
            met.select(
                "s",
                "level",
                "idx",
                *(F.col(f"far_{c}").alias(f"to_{c}") for c in ("s", "level", "idx")),
                F.when(F.col("more").isNull(), F.col("segment")).otherwise(F.concat("segment", "more")).alias("segment"),
            )
        )
        reach *= 2


def manifest(docs: DataFrame, tampered: Column) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every
    row; ``tampered`` marks the rows whose text is lower-cased before it is verified.

    Rows without source are a source of their own, before all others. Rows without
    doc_id come first in their source. Rows with equal doc_id are ordered by leaf;
    equal rows have equal leaves, and which of them takes which place is open but
    changes no digest. A row whose tampered text is the same verifies. Null and empty
    texts differ. No rows: no result. Further columns are not read.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    rows = settle(leaves(docs.select(*FIELDS), tampered).withColumn("key", key).drop("source"))
    in_order = placed(rows, "key", "doc_id", "leaf")

    sizes = settle(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    most = sizes.agg(F.max("n")).first()[0]
    if most is None:
        return docs.select("doc_id").limit(0).selectExpr(
            "doc_id", *(f"cast(null as string) as {c}" for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")),
            "cast(null as boolean) as verified",
        )
    one = sizes.withColumn("all", F.lit(0))
    sources = settle(placed(one, "all", "key").select("key", "n", F.col("idx").alias("s")))
    n_sources = sources.count()

    low = attach_small(in_order, sources, "key", "inner").withColumnRenamed("leaf", "digest")
    # a source's only leaf is its subroot and has no run
    lone = low.where("n = 1").select("s", F.lit(0).alias("level"), F.lit(0).cast("long").alias("idx"),
                                     F.array(F.struct("idx", "digest", "doc_id", "other")).alias("kids"))
    bottom = settle(runs(low.where("n > 1"), "doc_id", "other", "n"))
    up = F.ceil(F.col("kids")[0]["n"] / RUN).alias("n")
    pointers, ends = _upwards(bottom.select("s", "idx", "digest", up), -(-most // RUN), 1)
    subroots = settle(ends.unionByName(low.where("n = 1").select("s", F.lit(0).alias("level"), "digest")))

    # the tree over the sources: its leaves are the nodes that the sources ended in
    over = subroots.select(F.lit(TOP).cast("long").alias("s"), F.col("s").alias("idx"), "digest", F.lit(n_sources).cast("long").alias("n"))
    above, last = _upwards(over, n_sources, 0)
    root = last.first()["digest"]
    if above:
        # a subroot goes by its name in its own source
        named = subroots.select(F.col("s").alias("idx"), F.col("s").alias("own"), "level")
        first = above[0].drop("s", "level").join(broadcast_if_small(named, BROADCAST_BYTES), "idx")
        above[0] = first.withColumn("idx", F.lit(0).cast("long")).withColumnRenamed("own", "s")
    steps = pointers + above
    low_runs = bottom.select("s", F.lit(1).alias("level"), "idx", F.transform("kids", _kid).alias("kids"))
    low_runs = low_runs.unionByName(lone.withColumn("kids", F.transform("kids", _kid)))
    if steps:
        linked = steps[0]
        for more in steps[1:]:
            linked = linked.unionByName(more)
        # an ancestor without a pointer of its own is the root: segments end there
        paths = jumped(settle(linked))
        low_runs = low_runs.join(paths.where("level <= 1"), ["s", "level", "idx"], "left")
    else:
        low_runs = low_runs.withColumn("segment", F.lit(None).cast("array<struct<l:string,r:string>>"))

    ready = low_runs.join(
        broadcast_if_small(subroots.select("s", F.col("digest").alias("subroot")), BROADCAST_BYTES), "s"
    )
    empty = F.array().cast("array<struct<l:string,r:string>>")
    single = ready.select("subroot", "level", "kids", F.coalesce("segment", empty).alias("segment"), F.posexplode("kids").alias("place", "kid"))
    own = F.when(F.col("level") == 1, F.array(sides(F.col("kids"), F.col("place")))).otherwise(empty)
    proved = single.select("subroot", "kid.*", F.concat(own, "segment").alias("proof"))
    siblings = F.array_join(F.transform("proof", lambda x: F.concat(x["l"], x["r"])), "")
    start = F.coalesce("other", "digest")
    folded = F.aggregate("proof", start, lambda so_far, x: F.sha2(F.concat(x["l"], so_far, x["r"]), 256))
    # untouched rows are folded as well: that is what their verification means
    return proved.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(root).alias("root"),
        F.sha2(siblings, 256).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == F.lit(root)).alias("verified"),
    )


def _kid(kid: Column) -> Column:
    return F.struct(*(kid[c].alias(c) for c in ("idx", "digest", "doc_id", "other")))


def oracle(levels: int = 8) -> str:
    """The same in DuckDB's SQL, one step per level of either tree."""
    value = lambda c: f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}, '-')"
    lower = f"translate(text, '{UPPER}', '{LOWER}')"
    row = lambda text: "sha256(" + " || ".join([*(value(c) for c in FIELDS[:-1]), value(text)]) + ")"
    steps = [
        CRC_TABLE_SQL,
        f"""leaves AS (
  SELECT doc_id, source, {row("text")} AS leaf, {row(lower)} AS lowered, {crc32_sql("doc_id::VARCHAR")} % 5 = 0 AS tampered
  FROM documents, crc_table
)""",
        """sources AS (
  SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS s FROM (SELECT DISTINCT source FROM leaves)
)""",
        """walk AS (
  SELECT s, doc_id, leaf, CASE WHEN tampered THEN lowered ELSE leaf END AS folded, '' AS proof,
    row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM leaves JOIN sources ON leaves.source IS NOT DISTINCT FROM sources.source
)""",
        "low0 AS (SELECT s, i, leaf AS h FROM walk)",
    ]

    def fold(tree: str, level: int, walk: str) -> str:
        own = "PARTITION BY s, i // 16 ORDER BY i ROWS BETWEEN"
        steps.append(f"""{tree}{level}_sides AS (
  SELECT s, i, count(*) OVER (PARTITION BY s) AS n,
    coalesce(string_agg(h, '') OVER ({own} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER ({own} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {tree}{level}
)""")
        steps.append(f"""{walk}_{tree}{level} AS (
  SELECT w.* REPLACE (CASE WHEN n > 1 THEN sha256(l || folded || r) ELSE folded END AS folded,
    CASE WHEN n > 1 THEN proof || l || r ELSE proof END AS proof, w.i // 16 AS i)
  FROM {walk} w JOIN {tree}{level}_sides x ON x.s = w.s AND x.i = w.i
)""")
        steps.append(f"""{tree}{level + 1} AS (
  SELECT s, i // 16 AS i, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h
  FROM (SELECT *, count(*) OVER (PARTITION BY s) AS n FROM {tree}{level}) GROUP BY s, i // 16
)""")
        return f"{walk}_{tree}{level}"

    walk = "walk"
    for level in range(levels):
        walk = fold("low", level, walk)
    steps.append(f"high0 AS (SELECT -1 AS s, s AS i, h FROM low{levels})")
    steps.append(f"up AS (SELECT w.* REPLACE (-1 AS s, w.s AS i), h AS subroot FROM {walk} w JOIN low{levels} x USING (s))")
    walk = "up"
    for level in range(levels):
        walk = fold("high", level, walk)
    return f"""
WITH {", ".join(steps)}
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = h AS verified
FROM {walk}, high{levels}
"""
