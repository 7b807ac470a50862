"""Merkle manifest of a dataset by lag and lead windows.

Every row is a leaf. Leaves of one group stand in order; runs of ``arity``
consecutive nodes become their parent, level by level, until one node of the
group is left, its subroot. Subroots in order of their groups likewise become
the root. A leaf's path holds, for every level up to the root, what its run has
before and after it, which is all that is needed to compute the root again.

Positions. Leaves are range-partitioned by (group, order) and sorted there, so
that a hot group is spread over many tasks; a leaf's position follows from its
place in its partition and the counts of the partitions before.

Levels. A block is ``arity ** levels`` consecutive nodes of a group. No run
crosses a block's edge, so one shuffle by block serves all levels inside: each
node is kept by the row of its first leaf, ``arity ** level`` rows apart, and
lag and lead columns of that offset, masked by the row's slot in its run and the
run's length, supply siblings; the first row of a run hashes the parent. At last
each row takes over the siblings that the first rows of its nodes hold. The tops
of all blocks are the nodes of the next stage, a thousandth of the rows. Paths of
a stage are joined to those of the blocks' tops, from the last stage down.

Cases: null fields are hashed as ``-``; a null group comes first; a null id
comes first in its group. Rows with one id follow by their digest, and rows that
repeat in full are leaves of their own. A group of one leaf has that leaf as its
subroot, a table of one group the subroot as its root. Columns of any other name
are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import crc32_sql, staged, table

ARITY = 2
LEVELS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
GROUP = "lang"
ORDER = "doc_id"
PART_BITS = 33  # Spark numbers the rows of a partition in the lower bits of its ids.


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts set end to end."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: tuple[str, ...] = FIELDS, **instead: Column) -> Column:
    """The digest of a row's fields, some of them replaced."""
    return digest(*[field(instead.get(c, F.col(c))) for c in fields])


def group_key(group: Column) -> Column:
    """A text that is never null and sorts as the group does, null first."""
    return F.coalesce(F.concat(F.lit("+"), group.cast("string")), F.lit(""))


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``pos``, the place in the group ``g`` from 0, and the group's size ``n``."""
    ranges = rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
    ranges = staged(ranges.withColumn("at", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("at", PART_BITS)
    counts = ranges.groupBy(F.col("g").alias("of"), part.alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("held"))
    group = Window.partitionBy("of")
    before = F.coalesce(F.sum("held").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("of", "part", (before - F.col("first")).alias("shift"), F.sum("held").over(group).alias("n"))
    found = ranges.join(counts, (F.col("g") == F.col("of")) & (part == F.col("part")))
    return found.withColumn("pos", F.col("at") + F.col("shift")).drop("at", "of", "part", "shift")


def climbed(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """One stage: (g, pos, n, digest, …) with ``path`` inside the block and the block's ``top``."""
    span = arity ** levels
    rows = nodes.withColumn("block", F.floor(F.col("pos") / span)).withColumn("d0", F.col("digest"))
    along = Window.partitionBy("g", "block").orderBy("pos")
    for level in range(levels):
        step, node = arity ** level, F.col(f"d{level}")
        count = F.ceil(F.col("n") / step)
        index = F.floor(F.col("pos") / step)
        slot = index % arity
        length = F.least(F.lit(arity), count - index + slot)
        heads = F.col("pos") % step == 0
        rows = rows.withColumns({
            **{f"lag{o}": F.lag(node, o * step).over(along) for o in range(1, arity)},
            **{f"lead{o}": F.lead(node, o * step).over(along) for o in range(1, arity)}})
        lags = [F.when(slot >= o, F.col(f"lag{o}")).otherwise("") for o in range(arity - 1, 0, -1)]
        leads = [F.when(slot + o < length, F.col(f"lead{o}")).otherwise("") for o in range(1, arity)]
        rows = rows.withColumns({
            f"s{level}": F.when(heads & (count > 1), F.struct(F.concat(*lags).alias("before"), F.concat(*leads).alias("after"))),
            f"d{level + 1}": F.when(F.col("pos") % (step * arity) == 0, F.when(count > 1, digest(node, *leads)).otherwise(node)),
        }).drop(*[f"{side}{o}" for side in ("lag", "lead") for o in range(1, arity)])
        if level:  # the leaves' own digest is read once, as d0
            rows = rows.drop(f"d{level}")
    above = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = [F.last(f"s{level}", ignorenulls=True).over(above) for level in range(levels)]
    rows = rows.withColumns({f"p{level}": step for level, step in enumerate(steps)} | {"top": F.last(f"d{levels}", ignorenulls=True).over(above)})
    path = F.array_compact(F.array(*[f"p{level}" for level in range(levels)]))
    return rows.select(*nodes.columns, "block", path.alias("path"), "top")


def trees(nodes: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """(g, …, path, top) for (g, pos, n, digest, …): each node's path to its group's ``top``."""
    span, found = arity ** levels, []
    most = 2
    while most > 1:
        found.append(staged(climbed(nodes, arity, levels), "merkle-stage"))
        tops = found[-1].filter(F.col("pos") % span == 0)
        nodes = tops.select("g", F.col("block").alias("pos"), F.ceil(F.col("n") / span).alias("n"), F.col("top").alias("digest"))
        most = nodes.agg(F.max("n")).first()[0] or 0

    def descend(upper: DataFrame, lower: DataFrame) -> DataFrame:
        above = upper.select(F.col("g").alias("of"), F.col("pos").alias("at"), F.col("path").alias("rest"), F.col("top").alias("summit"))
        rows = lower.join(above, (F.col("g") == F.col("of")) & (F.col("block") == F.col("at")))
        return rows.withColumns({"path": F.concat("path", "rest"), "top": F.col("summit")}).select(*lower.columns)

    return reduce(descend, reversed(found))


def forest(leaves: DataFrame, *order: str, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """(…, path, subroot, root) for (g, digest, …): groups' trees under one root."""
    rows = staged(trees(placed(leaves, *order), arity, levels), "merkle-trees")
    groups = rows.filter(F.col("pos") == 0).select(F.lit("").alias("g"), F.col("g").alias("member"), F.col("top").alias("digest"))
    above = trees(placed(groups, "member"), arity, levels)
    above = above.select("member", F.col("path").alias("rest"), F.col("top").alias("root"))
    rows = rows.withColumnRenamed("top", "subroot").join(above, F.col("g") == F.col("member"))
    return rows.withColumn("path", F.concat("path", "rest")).drop("g", "pos", "n", "block", "member", "rest")


def manifest(docs: DataFrame, carried: dict[str, Column] | None = None, fields: tuple[str, ...] = FIELDS, group: str = GROUP,
             order: str = ORDER, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """(order, leaf, carried …, path, subroot, root) for every row of ``docs``.

    ``carried`` are columns computed from a row. Texts are read once.
    """
    leaves = docs.select(
        group_key(F.col(group)).alias("g"), F.col(order).alias("key"), leaf_digest(fields).alias("digest"),
        *[c.alias(f"carried_{name}") for name, c in (carried or {}).items()])
    # The number parts rows that repeat in full, so that many of them are no hot key.
    leaves = staged(leaves.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    rows = forest(leaves, "key", "digest", "row", arity=arity, levels=levels)
    return rows.select(F.col("key").alias(order), F.col("digest").alias("leaf"), *[F.col(f"carried_{c}").alias(c) for c in carried or {}], "path", "subroot", "root")


def proof_digest(path: Column) -> Column:
    """The digest of all siblings on a path, left to right, level by level."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s.getField("before"), s.getField("after"))), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of a path."""
    return F.aggregate(path, leaf, lambda x, s: digest(s.getField("before"), x, s.getField("after")))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, leaf_digest(n_chars=F.col("n_chars") + 1))
    rows = manifest(table(spark, sf_dir, "documents"), {"tampered": tampered})
    rows = rows.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _field_sql(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field_sql(c) for c in ("CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text")) + ")"


SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS r, doc_id, lang, {_leaf_sql('n_chars')} AS leaf,
         CASE WHEN {crc32_sql('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN {_leaf_sql('n_chars + 1')} END AS tampered FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n FROM leaves
), nodes(lang, level, pos, n, digest) AS (
  SELECT lang, 0, pos, n, leaf FROM placed
  UNION ALL
  SELECT lang, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 2, n
), subroots AS (
  SELECT lang, digest AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1
), tops(level, pos, n, digest) AS (
  SELECT 0, pos, n, subroot FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY level, pos // 2, n
), steps AS (
  SELECT p.r, 0 AS tier, a.level, a.pos % 2 AS slot, coalesce(b.digest, '') AS sibling
  FROM placed p JOIN nodes a ON a.lang IS NOT DISTINCT FROM p.lang AND a.n > 1 AND a.pos = p.pos >> a.level
  LEFT JOIN nodes b ON b.lang IS NOT DISTINCT FROM a.lang AND b.level = a.level AND b.pos = xor(a.pos, 1)
  UNION ALL
  SELECT p.r, 1, a.level, a.pos % 2, coalesce(b.digest, '')
  FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang JOIN tops a ON a.n > 1 AND a.pos = s.pos >> a.level
  LEFT JOIN tops b ON b.level = a.level AND b.pos = xor(a.pos, 1)
), paths AS (
  SELECT r, string_agg(sibling, '' ORDER BY tier, level) AS siblings, list(slot || sibling ORDER BY tier, level) AS path FROM steps GROUP BY r
), folds AS (
  SELECT p.doc_id, leaf, subroot, (SELECT digest FROM tops WHERE n = 1) AS root, sha256(coalesce(siblings, '')) AS proof_sha256,
         list_reduce([coalesce(tampered, leaf)] || coalesce(path, CAST([] AS VARCHAR[])),
           lambda x, s: sha256(CASE WHEN s[1] = '1' THEN s[2:] || x ELSE x || s[2:] END)) AS folded_root
  FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang LEFT JOIN paths USING (r)
)
SELECT *, folded_root = root AS verified FROM folds
"""
