"""A Merkle tree over a table of documents: per source, then over the sources.

Leaves are digests of rows. Within a source they ascend by id; every ``ARITY`` consecutive nodes
become one node of the next level until one is left, the source's subroot. Subroots, ordered by
source, become the root in the same way.

Nodes of all sources are built level by level. A level is joined to itself by equality on (source,
number of the sibling): of a node in slot s the siblings are in slots s + 1, s + 2, ... modulo the
arity of the same run, so every node finds its siblings in arity - 1 joins, and the row in slot
zero, which then holds the whole run, emits the parent. A key of these joins is one node, so a
source of any size is spread over all tasks. Then paths go down again: a node's path is its own
siblings and its parent's path, joined on the parent's number, a few levels per job. Levels are
written to the shared folder; there are as many as the logarithm of the
largest source. Nothing but that size and the root reaches the driver.

Defined cases: a null column is hashed as a mark of its own; rows without an id come first in
their source and those without a source in the first source; rows with the same id ascend by their
digest; equal rows are leaves of their own; a source with one row has its leaf as subroot; an
empty table gives an empty result. Very long texts are hashed as a whole. Columns other than the
hashed ones are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obligo.llm.common import checksum_mod, documents
from obligo.operators.numbering import dense_numbers
from obligo.sinks.tables import stored

ARITY = 3
TOGETHER = 4  # levels whose paths are joined in one job
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
GROUP, NUMBER, NODES = "_group", "_number", "_nodes"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated texts."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as it is hashed: its length in bytes and itself, or the mark of a missing one."""
    spelled = value.cast("string")
    return F.coalesce(
        F.concat(F.octet_length(spelled).cast("string"), F.lit(":"), spelled), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """Digest of a row; ``changed`` columns stand in for the row's own."""
    return digest(*[field(changed.get(c, F.col(c))) for c in FIELDS])


def _slot() -> Column:
    return F.col(NUMBER) % ARITY


def with_siblings(nodes: DataFrame) -> DataFrame:
    """Adds the digests of the siblings ``before`` and ``after`` each node in its run."""
    out, first = nodes, F.col(NUMBER) - _slot()
    before, after = [], []
    for shift in range(1, ARITY):
        sibling = nodes.select(
            F.col(GROUP).alias(f"_g{shift}"), F.col(NUMBER).alias(f"_n{shift}"),
            F.col("digest").alias(f"_s{shift}"))
        out = out.join(
            sibling,
            (F.col(GROUP) == F.col(f"_g{shift}"))
            & (first + (_slot() + shift) % ARITY == F.col(f"_n{shift}")),
            "left")
        wrapped = _slot() + shift >= ARITY
        before.append(F.when(wrapped, F.col(f"_s{shift}")))
        after.append(F.when(~wrapped, F.col(f"_s{shift}")))
    return out.select(*nodes.columns, F.concat_ws("", *before).alias("before"),
                      F.concat_ws("", *after).alias("after"))


def parents(level: DataFrame) -> DataFrame:
    """The next level's nodes, from the rows in slot zero."""
    return level.filter(_slot() == 0).select(
        GROUP, F.floor(F.col(NUMBER) / ARITY).alias(NUMBER),
        F.ceil(F.col(NODES) / ARITY).alias(NODES),
        digest(F.col("digest"), F.col("after")).alias("digest"))


def levels_of(spark: SparkSession, nodes: DataFrame) -> list[DataFrame]:
    """Nodes of every level, with their siblings; groups that are down to one node are at its top."""
    most = nodes.agg(F.max(NODES)).first()[0] or 0
    levels = []
    while most:
        # A group with one node has no sibling to find and emits no parent.
        levels.append(stored(spark, with_siblings(nodes), f"level-{len(levels)}"))
        nodes = parents(levels[-1].filter(F.col(NODES) > 1))
        most = -(-most // ARITY) if most > 1 else 0
    return levels


def tops(levels: list[DataFrame]) -> DataFrame:
    """The one node that is left of each group."""
    out = None
    for level in levels:
        top = level.filter(F.col(NODES) == 1).select(GROUP, "digest")
        out = top if out is None else out.unionByName(top)
    return out


def with_paths(spark: SparkSession, levels: list[DataFrame], top: DataFrame) -> DataFrame:
    """The lowest level with the columns of its group's ``top`` and the path to it.

    ``top`` has one row per group: the group, ``path`` from its last node on, and what else the
    nodes are to carry. A path is an array of (before, after), from the node's own level up.
    """
    carried = [c for c in top.columns if c not in (GROUP, "path")]
    above = None
    for depth in range(len(levels) - 1, -1, -1):
        level = levels[depth]
        own = [c for c in level.columns if c not in ("before", "after")]
        rows = level.filter(F.col(NODES) == 1).join(top, GROUP).select(*own, *carried, "path")
        if above is not None:
            upper = above.select(
                F.col(GROUP).alias("_g"), F.col(NUMBER).alias("_n"), "path", *carried)
            step = F.array(F.struct("before", "after"))
            rows = rows.unionByName(
                level.filter(F.col(NODES) > 1)
                .join(upper, (F.col(GROUP) == F.col("_g"))
                      & (F.floor(F.col(NUMBER) / ARITY) == F.col("_n")))
                .select(*own, *carried, F.concat(step, "path").alias("path")))
        # A job of some levels: with all of them its plan would grow with the tree.
        above = stored(spark, rows, f"paths-{depth}") if depth % TOGETHER == 2 else rows
    return above


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path lead to."""
    return F.aggregate(path, start, lambda node, s: digest(s["before"], node, s["after"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings on a path."""
    return F.sha2(F.array_join(F.transform(
        path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def manifest(spark: SparkSession, leaves: DataFrame) -> DataFrame:
    """Adds number, subroot, root and path to rows of doc_id, source and leaf.

    ``path`` holds, per level from the leaf to the root, the digests before and after the node in
    its run; ``folded`` computes the root from it. Other columns of ``leaves`` are kept.
    """
    group = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))  # a null sorts first, and joins
    rows = leaves.withColumn(GROUP, group).withColumn("digest", F.col("leaf")).drop("leaf")
    numbered = dense_numbers(rows, ["doc_id", "digest"], [GROUP], NUMBER, NODES)
    levels = levels_of(spark, stored(spark, numbered, "leaves"))
    if not levels:
        none = "array<struct<before:string,after:string>>"
        return leaves.limit(0).select(
            *leaves.columns, F.lit(0).cast("long").alias("number"),
            *[F.lit("").alias(c) for c in ("subroot", "root")],
            F.array().cast(none).alias("path"))
    subroots = dense_numbers(
        tops(levels).withColumnRenamed(GROUP, "_source"), ["_source"], None, NUMBER, NODES)
    upper = levels_of(
        spark, stored(spark, subroots.withColumn(GROUP, F.lit("")), "subroots"))
    root = tops(upper).first()["digest"]
    empty = F.array().cast("array<struct<before:string,after:string>>")
    top = tops(upper).select(GROUP, empty.alias("path"))
    sources = stored(spark, with_paths(spark, upper, top).select(
        F.col("_source").alias(GROUP), F.col("digest").alias("subroot"), "path"), "sources")
    kept = [c for c in leaves.columns if c != "leaf"]
    return with_paths(spark, levels, sources).select(
        *kept, F.col("digest").alias("leaf"), F.col(NUMBER).alias("number"), "subroot",
        F.lit(root).alias("root"), "path")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    without = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    rows = documents(spark, sf_dir).select(
        "doc_id", "source", leaf().alias("leaf"),
        F.when(checksum_mod(2) == 0, leaf(text=without)).alias("tampered"))
    found = manifest(spark, rows)
    reached = folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        reached.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql_field(value: str) -> str:
    return (f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' "
            f"|| CAST({value} AS VARCHAR) END")


def _sql_leaf(**changed: str) -> str:
    return f"sha256({' || '.join(_sql_field(changed.get(c, c)) for c in FIELDS)})"


def _sql_tree(name: str, nodes: str) -> str:
    """Levels of a tree over ``nodes`` (grp, num, n, digest), and the siblings of each node."""
    run = f"grp, lvl, num // {ARITY}"

    def side(frame: str) -> str:
        return (f"coalesce(string_agg(digest, '') OVER (PARTITION BY {run} ORDER BY num "
                f"ROWS BETWEEN {frame}), '')")

    return f"""
{name} AS (
    SELECT grp, 0 AS lvl, num, n, digest FROM {nodes}
    UNION ALL
    SELECT grp, lvl + 1, num // {ARITY}, (n + {ARITY - 1}) // {ARITY},
           sha256(string_agg(digest, '' ORDER BY num))
    FROM {name} WHERE n > 1 GROUP BY {run}, n
),
{name}_steps AS (
    SELECT grp, lvl, num, {side('UNBOUNDED PRECEDING AND 1 PRECEDING')} AS before,
           {side('1 FOLLOWING AND UNBOUNDED FOLLOWING')} AS after
    FROM {name} WHERE n > 1
)"""


def _sql_climb(name: str, tree: str, start: str) -> str:
    """From nodes (row, grp, num, node, proof) to the top of their tree."""
    return f"""
{name} AS (
    SELECT row, grp, 0 AS lvl, num, node, proof FROM {start}
    UNION ALL
    SELECT row, c.grp, c.lvl + 1, c.num // {ARITY}, sha256(before || node || after),
           proof || before || after
    FROM {name} c JOIN {tree}_steps s ON c.grp = s.grp AND c.lvl = s.lvl AND c.num = s.num
),
{name}_top AS (SELECT row, arg_max(grp, lvl) AS grp, arg_max(node, lvl) AS node,
                      arg_max(proof, lvl) AS proof FROM {name} GROUP BY row)"""


# CRC-32 of the id as text, bit by bit.
_SQL_CRC = """
xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(
        string_split(coalesce(CAST(doc_id AS VARCHAR), 'null'), ''), lambda c: ascii(c)::BIGINT)),
    lambda r, b: list_reduce(
        list_prepend(xor(r, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))"""

SQL = f"""
WITH RECURSIVE rows AS (
    SELECT row_number() OVER () AS row, doc_id,
           CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS grp,
           {_sql_leaf()} AS leaf,
           CASE WHEN {_SQL_CRC} % 2 = 0
                THEN {_sql_leaf(text="replace(text, chr(10), '')")} END AS tampered
    FROM documents
),
leaves AS (
    SELECT *, leaf AS digest, count(*) OVER (PARTITION BY grp) AS n,
           row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS num
    FROM rows
),
{_sql_tree('tree', 'leaves')},
subroots AS (
    SELECT '' AS grp, grp AS source, digest, count(*) OVER () AS n,
           row_number() OVER (ORDER BY grp) - 1 AS num
    FROM tree WHERE n = 1
),
{_sql_tree('upper', 'subroots')},
start AS (SELECT row, grp, num, coalesce(tampered, leaf) AS node, '' AS proof FROM leaves),
{_sql_climb('climb', 'tree', 'start')},
middle AS (
    SELECT row, '' AS grp, num, node, proof FROM climb_top t JOIN subroots s ON t.grp = s.source
),
{_sql_climb('ascent', 'upper', 'middle')}
SELECT l.doc_id, l.leaf, s.digest AS subroot, r.digest AS root, sha256(a.proof) AS proof_sha256,
       a.node AS folded_root, a.node = r.digest AS verified
FROM leaves l
JOIN subroots s ON l.grp = s.source
JOIN ascent_top a ON a.row = l.row
CROSS JOIN (SELECT digest FROM upper WHERE n = 1) r
"""
