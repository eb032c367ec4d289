"""A Merkle manifest of a dataset: trees over groups of rows whose nodes are labelled with the leaf ranks they cover.

A node's label is an interval [lo, hi) of leaf ranks, nested in its parent's. A row's ancestors and their siblings are
found by these labels alone: no pointer is stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapwatch.llm.tables import Tables

# So many consecutive nodes make one node of the next level.
FAN_OUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before string, after string>>"


def digest_of(*values: Column) -> Column:
    """SHA-256 in lowercase hex over the values: ``-`` for NULL, else UTF-8 byte count, ``:`` and the value."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path of siblings give."""
    return F.aggregate(path, leaf, lambda own, step: F.sha2(F.concat(step["before"], own, step["after"]), 256))


def siblings(path: Column) -> Column:
    """The path's digests, level by level, left to right, as one text."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), "")


def _ranked(leaves: DataFrame, tables: Tables) -> DataFrame:
    """``leaves`` (tree, place, digest, row) plus ``lo`` and ``hi``, their label, and ``leaves``, their number in the tree.

    Ranges of (tree, place, digest) are numbered each by itself. Each range's and tree's first number and count, which
    are as few as ranges and trees, then give the rank in the tree, so a tree with most of all rows is many tasks.
    """
    order = ["tree", "place", "digest"]
    row = F.monotonically_increasing_id()
    spread = leaves.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = tables.keep(
        spread.select("*", F.shiftright(row, 33).alias("part"), row.bitwiseAND(F.lit((1 << 33) - 1)).alias("i"))
    )
    held = numbered.groupBy("tree", "part").agg(F.min("i").alias("first"), F.count("*").alias("n"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = held.select("tree", "part", F.sum("n").over(tree).alias("leaves"), (before - F.col("first")).alias("shift"))
    # Written, so that its size is known and Spark broadcasts it only if it is small.
    lo = F.col("i") + F.col("shift")
    found = numbered.join(tables.keep(starts), ["tree", "part"])
    return tables.keep(found.select("tree", "leaves", lo.alias("lo"), (lo + 1).alias("hi"), "digest", "row"))


def _levels(leaves: DataFrame, tables: Tables) -> list[DataFrame]:
    """Level 1 and up: (tree, leaves, lo, hi, digest, children), children being (lo, hi, digest, row) by rank.

    A tree of n leaves has the levels up to the first whose nodes may cover n; a tree of one leaf has none.
    """
    levels, below, width = [], leaves, 1
    while True:
        bucket = F.floor(F.col("lo") / F.lit(width * FAN_OUT)).alias("bucket")
        child = F.struct("lo", "hi", "digest", "row")
        runs = below.where(F.col("leaves") > width).groupBy("tree", "leaves", bucket).agg(
            F.sort_array(F.collect_list(child)).alias("children")  # FAN_OUT at most
        )
        level = tables.keep(
            runs.select(
                "tree",
                "leaves",
                F.get("children", F.lit(0))["lo"].alias("lo"),
                F.get("children", F.size("children") - 1)["hi"].alias("hi"),
                F.sha2(F.array_join(F.transform("children", lambda c: c["digest"]), ""), 256).alias("digest"),
                "children",
            )
        )
        if level.isEmpty():
            return levels
        levels.append(level)
        below = level.select("tree", "leaves", "lo", "hi", "digest", F.lit(None).cast("int").alias("row"))
        width *= FAN_OUT


def _step(children: Column, lo: Column, hi: Column) -> Column:
    """What a parent's interval holds besides [lo, hi): the siblings before and after it."""
    kept = lambda test: F.array_join(F.transform(F.filter(children, test), lambda c: c["digest"]), "")
    return F.struct(kept(lambda c: c["hi"] <= lo).alias("before"), kept(lambda c: c["lo"] >= hi).alias("after"))


def _descend(levels: list[DataFrame], leaves: DataFrame, tops: DataFrame) -> DataFrame:
    """(tree, lo, digest, row, path, top) of every leaf, from ``tops`` (tree, path, top) of every tree.

    Level by level from above, a node meets the one node of the next level in the bucket of ranks that its label
    falls into and that contains it, and takes that node's path behind its own step.
    """
    # ``leaves`` of a tree tell at which level its highest node stands.
    alone = leaves.where("leaves = 1").join(tops, "tree").select("tree", "lo", "digest", "row", "path", "top")
    above = None
    for number in range(len(levels), 0, -1):
        width = FAN_OUT**number
        nodes = levels[number - 1]
        highest = nodes.where(F.col("leaves") <= width).join(tops, "tree").select(*nodes.columns, "path", "top")
        if above is None:
            above = highest
            continue
        up = above.select(
            F.col("tree").alias("up_tree"),
            F.floor(F.col("lo") / F.lit(width * FAN_OUT)).alias("up_bucket"),
            F.col("lo").alias("up_lo"),
            F.col("hi").alias("up_hi"),
            F.col("children").alias("up_children"),
            F.col("path").alias("up_path"),
            "top",
        )
        bucket = F.floor(F.col("lo") / F.lit(width * FAN_OUT))
        within = (F.col("up_lo") <= F.col("lo")) & (F.col("hi") <= F.col("up_hi"))
        met = nodes.join(up, (F.col("tree") == F.col("up_tree")) & (bucket == F.col("up_bucket")) & within)
        path = F.concat(F.array(_step(F.col("up_children"), F.col("lo"), F.col("hi"))), F.col("up_path"))
        above = met.select(*nodes.columns, path.alias("path"), "top").unionByName(highest)
    if above is None:
        return alone
    child = F.explode("children").alias("child")
    leaf = above.select("tree", child, "children", "path", "top").select(
        "tree",
        "child.lo",
        "child.digest",
        "child.row",
        F.concat(F.array(_step(F.col("children"), F.col("child.lo"), F.col("child.hi"))), F.col("path")).alias("path"),
        "top",
    )
    return leaf.unionByName(alone)


def _subroots(levels: list[DataFrame], leaves: DataFrame) -> DataFrame:
    """(tree, digest) of every tree's highest node."""
    found = leaves.where("leaves = 1").select("tree", "digest")
    for number, level in enumerate(levels, 1):
        found = found.unionByName(level.where(F.col("leaves") <= FAN_OUT**number).select("tree", "digest"))
    return found


def manifest(leaves: DataFrame, group: str, place: str, digest: str) -> DataFrame:
    """Every row of ``leaves`` with its inclusion proof: ``leaf, rank, subroot, root, path, row``.

    ``row`` holds the given columns. ``path`` lists, level by level from the leaf to the root, the digests before and
    after the own one in its run of FAN_OUT nodes; ``fold(leaf, path)`` is the root, ``siblings(path)`` the proof.

    Within a group leaves ascend by ``place`` (NULL first), equal ones by digest; ``rank`` counts from 0. While a tree
    has several nodes, every FAN_OUT consecutive ones become one; a lone leaf is its group's subroot. The subroots by
    group (NULL first, by bytes) make the last tree in the same way. Repeated rows are leaves each. No rows, no result.
    Column names are free, as all columns of a row travel in ``row``.

    Rows are shuffled twice with their digest and given columns: into ranges that give the ranks, and into runs.
    Every higher level has an eighth of the rows. The joins of labels meet one parent for each node, so no key is
    hotter than FAN_OUT rows. Levels are tables in the shared folder.
    """
    tables = Tables(leaves.sparkSession, "merkle")
    # Leaves are written first: the bounds of the ranges and the ranges then read them, not the texts.
    leaves = tables.keep(leaves)
    key = F.coalesce(F.concat(F.lit("s"), F.col(f"`{group}`").cast("string")), F.lit("n"))
    named = leaves.select(
        key.alias("tree"),
        F.col(f"`{place}`").alias("place"),
        F.col(f"`{digest}`").alias("digest"),
        F.struct(*[F.col(f"`{c}`") for c in leaves.columns]).alias("row"),
    )
    ranked = _ranked(named, tables)
    levels = _levels(ranked, tables)
    subroots = tables.keep(_subroots(levels, ranked))

    of = F.struct(F.col("tree").alias("of")).alias("row")
    crown = _ranked(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("place"), "digest", of), tables)
    crown_levels = _levels(crown, tables)
    top = F.struct(F.col("digest").alias("root")).alias("top")
    root = _subroots(crown_levels, crown).select("tree", F.expr(f"cast(array() AS {PATH})").alias("path"), top)
    tops = _descend(crown_levels, crown, root).select(
        F.col("row.of").alias("tree"), "path", F.struct(F.col("digest").alias("subroot"), F.col("top.root").alias("root")).alias("top")
    )
    rows = _descend(levels, ranked, tables.keep(tops))
    return rows.select(F.col("digest").alias("leaf"), F.col("lo").alias("rank"), "top.subroot", "top.root", "path", "row")


def row_digest(lower_text: bool = False) -> Column:
    """The leaf of a document row over FIELDS; with A-Z of its text in lower case, if told so."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    text = F.translate("text", capitals, capitals.lower()) if lower_text else F.col("text")
    return digest_of(*[text if f == "text" else F.col(f) for f in FIELDS])
