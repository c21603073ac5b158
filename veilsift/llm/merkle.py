"""A Merkle manifest of a table: a tree a group over its rows, one tree over the groups' roots, and proofs.

Nodes are strings, lower-case hex SHA-256 of what they join. A tree grows level by level through
windows: the partition is the run of nodes with one parent, its full frame in order gives the parent's
preimage and every member's siblings, and the first node of each run goes on as the parent. A tier
is several levels: its nodes are dealt once by what they will be in the tier's last level, and every window
within it finds its runs in place. So a tree over N nodes takes log(N) / TIER_LEVELS exchanges, each a
power smaller than the one before. Proofs come down the same way: what lies above a tier is joined to one
row for each of its last nodes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import numbered
from .common import cut

#: Levels between exchanges: with runs of two, a row of a tier holds the digests of 256 leaves and their inner nodes.
TIER_LEVELS = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Up to so many nodes are one task's work, without an exchange.
FEW_NODES = 4_096
NO_LEVELS = "array<array<string>>"
NO_PATH = "array<struct<before:string,after:string>>"


def leaf_digest(*values: Column) -> Column:
    """SHA-256 of the values after one another: ``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def group_key(group: Column) -> Column:
    """A string that is never null and sorts as the group does bytewise, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def tree(nodes: DataFrame, most: int, count: int, groups: int, arity: int = 2, tier_levels: int = TIER_LEVELS) -> tuple[DataFrame, list[DataFrame]]:
    """Roots (g, digest) of nodes (g, i, n, digest), and the tiers (g, chunk, levels) from the leaves up.

    ``i`` counts a group's nodes from 0, ``n`` is how many it has, at most ``most``; in all there are ``count``
    nodes of ``groups`` groups. ``levels`` holds, for each level of the tier from the bottom, the digests of
    all nodes of the chunk, from left to right.
    """
    span, tiers = arity**tier_levels, []
    while most > 1:
        rows = nodes.select("g", F.expr(f"i div {span}").alias("chunk"), "i", "n", "digest", F.array().cast(NO_LEVELS).alias("levels"))
        rows = rows.repartition("g", "chunk") if count > FEW_NODES else rows.coalesce(1)
        count = count // span + groups
        for _ in range(tier_levels):
            if most <= 1:
                break
            run = Window.partitionBy("g", "chunk", "parent").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            rows = rows.withColumn("parent", F.expr(f"i div {arity}")).withColumn("run", F.collect_list(F.struct("digest", "levels")).over(run))
            rows = rows.where(F.col("i") % arity == 0)  # the first of a run is its parent from here on
            below = F.transform("levels", lambda _, j: F.flatten(F.transform("run", lambda m: m["levels"][j])))
            open_ = F.col("n") > 1
            rows = rows.select(
                "g", "chunk", F.col("parent").alias("i"), F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
                F.when(open_, F.sha2(F.array_join("run.digest", ""), 256)).otherwise(F.col("digest")).alias("digest"),
                F.when(open_, F.array_append(below, F.col("run.digest"))).otherwise(F.col("levels")).alias("levels"),
            )
            most = -(-most // arity)
        tiers.append(cut(rows.select("g", "chunk", "n", "digest", "levels")))
        nodes = tiers[-1].select("g", F.col("chunk").alias("i"), "n", "digest")
    return nodes.select("g", "digest"), [t.select("g", "chunk", "levels") for t in tiers]


def steps(place: Column, levels: Column, arity: int = 2, tier_levels: int = TIER_LEVELS) -> Column:
    """(before, after) for each level: what the run holds on both sides of the node over ``place``."""
    size = F.array(*[F.lit(arity**k) for k in range(tier_levels)])

    def step(level: Column, j: Column) -> Column:
        at = F.floor(place / size[j]).cast("int")
        in_run = at % arity
        return F.struct(
            F.array_join(F.slice(level, at - in_run + 1, in_run), "").alias("before"),
            F.array_join(F.slice(level, at + 2, F.lit(arity - 1) - in_run), "").alias("after"),
        )

    return F.transform(levels, step)


def proofs(leaves: DataFrame, tiers: list[DataFrame], tops: DataFrame | None = None, arity: int = 2, tier_levels: int = TIER_LEVELS) -> DataFrame:
    """``leaves`` (g, i, ...) with ``path``: the steps from each leaf to its group's root, then those that ``tops`` (g, path, ...) has.

    Further columns of ``tops`` come along. Without ``tops`` paths end at the roots.
    """
    span = arity**tier_levels
    carried = [c for c in tops.columns if c not in ("g", "path")] if tops is not None else []
    above = None if tops is None else tops.select("g", F.lit(0).cast("long").alias("chunk"), F.col("path").alias("above"), *carried)

    def under(tier: DataFrame) -> DataFrame:
        return tier.withColumn("above", F.array().cast(NO_PATH)) if above is None else tier.join(above, ["g", "chunk"])

    if not tiers:
        return leaves.withColumn("path", F.array().cast(NO_PATH)) if above is None else leaves.join(above.drop("chunk").withColumnRenamed("above", "path"), "g")
    for tier in tiers[:0:-1]:
        rows = under(tier).select("g", "chunk", "levels", "above", *carried, F.posexplode_outer(F.get("levels", F.lit(0))).alias("at", "_"))
        at = F.coalesce("at", F.lit(0))  # a group whose root lies below has no levels here
        path = F.concat(steps(at, F.col("levels"), arity, tier_levels), "above")
        above = rows.select("g", (F.col("chunk") * span + at).alias("chunk"), path.alias("above"), *carried)
    dealt = leaves.withColumn("chunk", F.expr(f"i div {span}"))
    rows = dealt.join(under(tiers[0]), ["g", "chunk"])
    path = F.concat(steps(F.col("i") % span, F.col("levels"), arity, tier_levels), "above")
    return rows.select(*leaves.columns, path.alias("path"), *carried)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def manifest(rows: DataFrame, group: str, order: list[Column], leaf: Column, keep: dict[str, Column], arity: int = 2, tier_levels: int = TIER_LEVELS) -> DataFrame:
    """``keep``, leaf, subroot, root, path of every row: a tree for each ``group``, its leaves by ``order`` and then digest.

    Groups ascend bytewise, null first, and their roots are the leaves of one more tree. Rows are hashed where
    they are read; only what ``keep`` names and the digest go on. Repeated rows are leaves of their own, nulls
    sort first, an empty table gives no rows. ``keep`` may name no g, i, n, digest, chunk or levels.
    """
    own = cut(rows.select(group_key(F.col(group)).alias("g"), F.struct(*order).alias("_order"), leaf.alias("digest"), *[c.alias(k) for k, c in keep.items()]))
    placed = numbered(own, [F.col("_order"), F.col("digest")], "g", "i", "n").drop("_order")
    most, count, groups = placed.agg(F.max("n"), F.count("*"), F.count_if(F.col("i") == 0)).first()
    tops, tiers = tree(placed.select("g", "i", "n", "digest"), most or 0, count, groups, arity, tier_levels)
    # the groups' roots, one row each, in the order of their groups
    named = tops.select(F.lit("").alias("g"), F.col("g").alias("group"), "digest")
    if groups <= FEW_NODES:
        ordered = named.coalesce(1).sortWithinPartitions("group").withColumns({"i": F.monotonically_increasing_id(), "n": F.lit(groups).cast("long")})
    else:
        ordered = numbered(named, [F.col("group")], None, "i", "n")
    upper = cut(ordered)
    root, upper_tiers = tree(upper.select("g", "i", "n", "digest"), groups, groups, 1, arity, tier_levels)
    top = root.first()
    over = proofs(upper, upper_tiers, None, arity, tier_levels).select(F.col("group").alias("g"), F.col("digest").alias("subroot"), "path")
    found = proofs(placed, tiers, over, arity, tier_levels)
    return found.select(*keep, F.col("digest").alias("leaf"), "subroot", F.lit(top["digest"] if top else None).cast("string").alias("root"), "path")


def report(documents: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every document.

    Where 7 divides crc32 of the decimal doc_id, n_chars grows by one before the leaf is made anew; a null
    n_chars stays, the largest long becomes null, and a null doc_id is left alone. Documents of one doc_id are ordered by their leaves.
    """
    values = [F.col(c) for c in FIELDS]
    tampered = leaf_digest(*[F.try_add(v, F.lit(1)) if c == "n_chars" else v for c, v in zip(FIELDS, values, strict=True)])
    bad = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = manifest(documents, "lang", [F.col("doc_id").alias("id")], leaf_digest(*values), {"doc_id": F.col("doc_id"), "tampered": F.when(bad, tampered)})
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), "")
    folded = fold(F.coalesce("tampered", "leaf"), F.col("path"))
    out = rows.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


_CRC = "list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda c, b: " \
    "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384 * (y & 1))))"


def _field(column: str) -> str:
    return f"coalesce(strlen(({column})::VARCHAR)::VARCHAR || ':' || ({column})::VARCHAR, '-')"


def _leaf_sql(chars: str) -> str:
    return "sha256(" + " || ".join(_field(chars if c == "n_chars" else c) for c in FIELDS) + ")"


REPORT_SQL = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT *, coalesce('=' || lang, '-') AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n
  FROM (SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf, CASE WHEN xor({_CRC}, 4294967295) % 7 = 0 THEN {_leaf_sql("n_chars + 1")} END AS tampered FROM documents)
),
nodes AS (
  SELECT 0 AS level, g, i, n, leaf AS digest FROM d
  UNION ALL SELECT level + 1, g, i // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY level, g, n, i // 2
),
tops AS MATERIALIZED (SELECT g, digest AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
upper AS (
  SELECT 0 AS level, i, n, subroot AS digest FROM tops
  UNION ALL SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY i)) FROM upper WHERE n > 1 GROUP BY level, n, i // 2
),
inner_path AS (
  SELECT g, i, string_agg(coalesce(s.digest, ''), '' ORDER BY level) AS siblings, list({{'left': p.place % 2 = 1, 'sibling': coalesce(s.digest, '')}} ORDER BY level) AS path
  FROM (SELECT DISTINCT d.g, d.i, x.level, d.i >> x.level AS place FROM d JOIN (SELECT DISTINCT g, level FROM nodes WHERE n > 1) x ON x.g = d.g) p
  LEFT JOIN (SELECT g AS sg, level AS sl, i AS si, digest FROM nodes) s ON sg = g AND sl = level AND si = xor(place, 1) GROUP BY g, i
),
upper_path AS (
  SELECT g, string_agg(coalesce(s.digest, ''), '' ORDER BY level) AS siblings, list({{'left': p.place % 2 = 1, 'sibling': coalesce(s.digest, '')}} ORDER BY level) AS path
  FROM (SELECT tops.g, x.level, tops.i >> x.level AS place FROM tops, (SELECT DISTINCT level FROM upper WHERE n > 1) x) p
  LEFT JOIN (SELECT level AS sl, i AS si, digest FROM upper) s ON sl = level AND si = xor(place, 1) GROUP BY g
),
whole AS (
  SELECT doc_id, leaf, subroot, (SELECT digest FROM upper WHERE n = 1) AS root, coalesce(a.siblings, '') || coalesce(b.siblings, '') AS siblings,
    list_concat(coalesce(a.path, []), coalesce(b.path, [])) AS path, coalesce(tampered, leaf) AS start
  FROM d JOIN tops USING (g) LEFT JOIN inner_path a ON a.g = d.g AND a.i = d.i LEFT JOIN upper_path b ON b.g = d.g
)
SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256,
  list_reduce(list_prepend(start, list_transform(path, lambda s: CASE WHEN s.left THEN '<' ELSE '>' END || s.sibling)),
    lambda acc, s: sha256(CASE WHEN s[1] = '<' THEN s[2:] || acc ELSE acc || s[2:] END)) AS folded_root, folded_root = root AS verified
FROM whole
"""
