"""Merkle manifest: a hash tree per group of rows, a tree over the groups, and every row's proof.

1. Each row becomes a leaf hash of its fields (and a second one of the fields as
   found now, when some are said to have changed). The rest works on hashes only.
2. Leaves are numbered within their group by their order: dealt by range, numbered
   inside each part, plus what earlier parts hold of the group. A part has one
   group at most that began before it, so the offsets are one row a part.
3. The number's base-``fan`` digits are columns. Leaves are dealt by (group, block),
   a block being ``fan ** digits`` consecutive numbers, and the digits are grouped
   away one after the other inside the block, each time nesting the children's
   structs in their parent's: no exchange between the levels, and one row a block
   comes out. Block roots are the leaves of the next floor until one is left.
4. From the top floor down, a block's row meets the path above it in one grouping;
   ``transform`` and ``explode`` unfold the nested children and add each child's
   siblings to its path. No row is joined to its siblings.

A run of ``fan`` nodes (the last may be shorter) hashes to its parent as long as
its level holds more than one node; a group of one row has that leaf as its root.

Nulls: a null field is ``-``; a null group comes first; null order values come
first in their group. Rows that repeat an order value stand in order of their
leaf hash, and equal rows are interchangeable. Empty and very long texts are
hashed whole. An empty table has no rows. Columns that are no field are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import stored


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_text(fields: list[Column]) -> Column:
    """Each field as ``-`` if null, else its length in bytes, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    return F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts])


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` (stored) with ``rank``: their place from 0 within the group, in ``order``, equal rows in any order."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    told = rows.withColumn("_tie", F.monotonically_increasing_id())  # spreads copies of one row over parts
    dealt = stored(told.repartitionByRange(parts, group, *order, "_tie").withColumn("_part", F.spark_partition_id()), "merkle-ranked")
    before = Window.partitionBy("_group").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
              .select("_group", "_at", F.sum("_n").over(before).alias("_start"))
              .filter("_start > 0"))  # at most one row a part
    inside = Window.partitionBy(group, "_part").orderBy(*order, "_tie")
    return (dealt.join(F.broadcast(starts), F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_at")), "left")
            .select(*rows.columns, (F.row_number().over(inside) - 1 + F.coalesce("_start", F.lit(0))).alias("rank")))


def floor_of(nodes: DataFrame, fan: int, digits: int) -> DataFrame:
    """grp, block, levels, node: one row a block of ``nodes`` (grp, rank, node with a ``hash``), children nested."""
    places = [f"d{k}" for k in range(digits)]
    df = nodes.selectExpr("grp", f"rank div {fan ** digits} as block", "node",
                          *[f"cast(rank div {fan ** k} % {fan} as int) as {d}" for k, d in enumerate(places)]).repartition("grp", "block")
    # levels until one node is left; only block 0 can be the whole of its group, any other goes on to its last level
    needed = " + ".join(f"int(held > {fan ** k})" for k in range(digits))
    df = (df.withColumn("held", F.count(F.lit(1)).over(Window.partitionBy("grp", "block")))
          .selectExpr("grp", "block", f"if(block = 0, {needed}, {digits}) as levels", *places, "node"))
    for k, place in enumerate(places):
        left = ["grp", "block", "levels", *places[k + 1:]]
        up = f"if(levels > {k}, sha2(concat_ws('', transform(kids, x -> x.hash)), 256), kids[0].hash)"
        df = (df.groupBy(*left).agg(F.expr(f"transform(array_sort(collect_list(struct({place}, node))), x -> x.node) as kids"))
              .selectExpr(*left, f"struct({up} as hash, kids) as node"))
    return df


def floors_of(nodes: DataFrame, fan: int, digits: int) -> list[DataFrame]:
    """The stored floors over ``nodes``, the last with one block a group."""
    floors = []
    while True:
        floors.append(stored(floor_of(nodes, fan, digits), "merkle-floor"))
        if not floors[-1].agg(F.max("block")).first()[0]:
            return floors
        nodes = floors[-1].select("grp", F.col("block").alias("rank"), F.struct("node.hash", "block").alias("node"))


def unfold(floor: DataFrame, above: DataFrame, digits: int) -> DataFrame:
    """grp, node, above: the nodes that ``floor`` was built of, with the path of siblings over each.

    ``above`` (grp, block, above) holds the ``path`` over every block's root and the ``tops`` that
    go down with it unchanged; it meets the block in a grouping of two rows.
    """
    both = floor.unionByName(above, allowMissingColumns=True)
    df = both.groupBy("grp", "block").agg(*[F.expr(f"first({c}, true) as {c}") for c in ("levels", "node", "above")])
    for k in reversed(range(digits)):
        sides = "concat_ws('', transform(slice(node.kids, 1, i), y -> y.hash)) as before, " \
                "concat_ws('', transform(slice(node.kids, i + 2, size(node.kids)), y -> y.hash)) as after"
        df = (df.selectExpr("grp", "levels", "above", f"explode(transform(node.kids, (x, i) -> struct(x as node, struct({sides}) as step))) as kid")
              .selectExpr("grp", "levels", "kid.node as node",
                          f"struct(if(levels > {k}, concat(array(kid.step), above.path), above.path) as path, above.tops as tops) as above"))
    return df.select("grp", "node", "above")


def descend(floors: list[DataFrame], above: DataFrame, digits: int) -> DataFrame:
    for floor in floors[:0:-1]:
        above = unfold(floor, above, digits).select("grp", "node.block", "above")
    return unfold(floors[0], above, digits)


def manifest(docs: DataFrame, fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), group: str = "source",
             order: str = "doc_id", changed: dict[str, Column] | None = None, fan: int = 3, digits: int = 6) -> DataFrame:
    """id, leaf, subroot, root, path, proof_sha256, folded_root, verified for every row.

    ``changed`` gives fields as they are found now (a null keeps the field, so nothing can turn into null):
    ``folded_root`` is the root that those fields give with the siblings of the original tree.
    ``path`` lists the hashes before and after the node at each level, from the leaf up.
    """
    now = {c: F.coalesce(v, F.col(c)) for c, v in (changed or {}).items()}
    leaf, seen = (digest(leaf_text([d.get(c, F.col(c)) for c in fields])) for d in ({}, now))
    rows = stored(docs.select(F.col(group).alias("grp"), F.col(order).alias("ord"), leaf.alias("hash"), seen.alias("seen")), "merkle-leaves")
    leaves = numbered(rows, "grp", ["ord", "hash"])
    inner = floors_of(leaves.select("grp", "rank", F.struct("hash", "ord", "seen").alias("node")), fan, digits)

    groups = stored(inner[-1].select(F.lit(0).alias("all"), "grp", F.col("node.hash").alias("hash")), "merkle-groups")
    outer = floors_of(numbered(groups, "all", ["grp"]).select(F.col("all").alias("grp"), "rank", F.struct("hash", F.col("grp").alias("of")).alias("node")),
                      fan, digits)
    top = outer[-1].selectExpr("grp", "block", "struct(cast(array() as array<struct<before:string,after:string>>) as path, node.hash as tops) as above")
    roots = descend(outer, top, digits).selectExpr("node.of as grp", "0L as block",
                                                   "struct(above.path, struct(node.hash as subroot, above.tops as root) as tops) as above")
    found = descend(inner, roots, digits)
    folded = F.aggregate("above.path", F.col("node.seen"), lambda h, s: digest(F.concat(s["before"], h, s["after"])))
    siblings = F.concat_ws("", F.transform("above.path", lambda s: F.concat(s["before"], s["after"])))
    return found.select(F.col("node.ord").alias("id"), F.col("node.hash").alias("leaf"), "above.tops.subroot", "above.tops.root", "above.path",
                        digest(siblings).alias("proof_sha256"), folded.alias("folded_root"),
                        (folded == F.col("above.tops.root")).alias("verified"))
