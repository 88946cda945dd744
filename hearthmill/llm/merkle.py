"""Merkle manifest of a table of documents, with a proof and its check per row.

Rows become leaves, ordered by id within their source; runs of ``FAN`` nodes
become their parent until a source has one node, and the sources' nodes are
reduced in the same way to the root. The tree is worked through in superblocks
of ``FAN ** LEVELS`` neighbouring nodes. On the way up a superblock is reduced
to one digest. On the way down superblocks are joined with the nodes they need
from outside, the siblings on the path above them: each superblock is reduced
again, local and outer siblings are put together into each node's path and, for
leaves, the path is folded back to a root. A source may hold most rows:
positions come from a range sort, and the largest group is one superblock. All
steps are native, so executors hold no Python workers beside the scan of texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthmill.sources.shared import settle

FAN = 16
LEVELS = 3  # levels of a superblock, which holds FAN ** LEVELS nodes
DIGEST = 64  # hex digits
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left: string, right: string>>"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(**changed: Column) -> Column:
    """Digest of a row's fields; ``changed`` stands in for fields by name."""
    return F.sha2(F.concat(*[_field(changed.get(name, F.col(name))) for name in FIELDS]), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def leaves(docs: DataFrame) -> DataFrame:
    """Written table of doc_id, source, leaf and ``shown``, the leaf of the row as it is checked.

    A row is tampered with if 5 divides the crc32 of its decimal id: its text
    loses the capitals A-Z. Rows without an id or text are shown as they are.
    """
    text = F.col("text").cast("string")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    own = docs.select(*FIELDS).withColumn("leaf", leaf_digest())
    own = own.withColumn("shown", F.when(tampered, leaf_digest(text=lower_ascii(text))).otherwise(F.col("leaf")))
    # Equal rows are interchangeable; the spread keeps many of them out of one range.
    return settle(own.select("doc_id", "source", "leaf", "shown", F.monotonically_increasing_id().alias("spread")), "leaves")


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Written ``rows`` with ``at``, the place within the ``tree`` (from 0), and ``n``, its number of rows.

    ``order`` is unique but for rows that may change places.
    """
    ranges = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    placed = settle(ranges.withColumn("global", F.monotonically_increasing_id()).withColumn("part", F.shiftright("global", 33)), "ranges")
    pieces = placed.groupBy("tree", "part").agg(F.count("*").alias("rows"), F.min("global").alias("first"))
    # One row per piece of a tree: as many as there are partitions, however many rows they hold.
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("tree")
    pieces = settle(
        pieces.select(
            F.col("tree").alias("t"), F.col("part").alias("p"), (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
            F.sum("rows").over(whole).alias("n"),
        ), "pieces",
    )
    found = placed.join(pieces, (F.col("tree") == F.col("t")) & (F.col("part") == F.col("p")))
    return found.withColumn("at", F.col("global") + F.col("shift")).drop("global", "part", "t", "p", "shift")


def _superblocks(nodes: DataFrame, levels: int, *carried: str) -> DataFrame:
    """One row per superblock: tree, block, n, members (at, digest and ``carried``, in order) and its runs.

    ``runs0``, ``runs1``, ... are the joined digests of each level's runs, empty above the tree's last level.
    """
    blocks = nodes.withColumn("block", F.expr(f"at div {FAN**levels}")).groupBy("tree", "block")
    blocks = blocks.agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("at", "digest", *carried))).alias("members"))
    below, digest = "members", "x.digest"
    for level in range(levels):
        run = f"array_join(transform(slice({below}, i * {FAN} + 1, {FAN}), x -> {digest}), '')"
        joined = f"transform(sequence(0, cast((size({below}) - 1) div {FAN} as int)), i -> {run})"
        blocks = blocks.withColumn(f"runs{level}", F.expr(f"if(n > {FAN**level}, {joined}, cast(array() as array<string>))"))
        below, digest = f"runs{level}", "sha2(x, 256)"
    return blocks


def tops(nodes: DataFrame, levels: int) -> DataFrame:
    """The nodes that superblocks reduce to, as the next table of nodes."""
    digest = F.expr("members[0].digest")
    for level in range(levels):
        digest = F.when(F.col("n") > FAN**level, F.sha2(F.get(f"runs{level}", F.lit(0)), 256)).otherwise(digest)
    n = F.expr(f"(n + {FAN**levels - 1}) div {FAN**levels}")
    return settle(_superblocks(nodes, levels).select("tree", F.col("block").alias("at"), n.alias("n"), digest.alias("digest")), "tops")


def tables_upwards(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The given nodes, their superblocks' tops, and so on until every tree has one node."""
    tables = [nodes]
    while not tables[-1].filter("n > 1").isEmpty():
        tables.append(tops(tables[-1], levels))
    return tables


def _sibling_step(level: int) -> str:
    """Digests left and right of the i-th node's ancestor within its run."""
    run, place = f"get(runs{level}, cast(i div {FAN ** (level + 1)} as int))", f"{DIGEST} * cast(i div {FAN**level} % {FAN} as int)"
    return f"struct(left({run}, {place}) as left, substring({run}, {place} + {DIGEST + 1}) as right)"


def with_paths(nodes: DataFrame, outer: DataFrame, levels: int, *carried: str) -> DataFrame:
    """tree, at, ``carried``, path, subroot and root of each node, from the outer rows of their superblocks.

    A path holds left and right siblings, level by level up to the root.
    """
    above = outer.select(F.col("tree").alias("t"), F.col("at").alias("b"), F.col("path").alias("above"), "subroot", "root")
    blocks = _superblocks(nodes, levels, *carried).join(above, (F.col("tree") == F.col("t")) & (F.col("block") == F.col("b")))
    steps = [f"if(n > {FAN**level}, array({_sibling_step(level)}), cast(array() as {PATH}))" for level in range(levels)]
    local = F.expr(f"transform(members, (m, i) -> struct(m as m, concat({', '.join(steps)}) as path))")
    found = blocks.select("tree", "above", "subroot", "root", F.explode(local).alias("node"))
    path = F.concat("node.path", "above").alias("path")
    return found.select("tree", "node.m.at", *[f"node.m.{name}" for name in carried], path, "subroot", "root")


def expanded(nodes: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """Outer rows for these nodes, from those of the nodes that their superblocks reduce to."""
    return settle(with_paths(nodes, outer, levels), "paths")


def proofs(rows: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """The manifest's rows, from leaves and the outer rows of their superblocks."""
    found = with_paths(rows, outer, levels, "doc_id", "leaf", "shown")
    proof = F.sha2(F.array_join(F.transform("path", lambda step: F.concat(step.left, step.right)), ""), 256)
    folded = F.aggregate("path", F.col("shown"), lambda digest, step: F.sha2(F.concat(step.left, digest, step.right), 256))
    found = found.select(F.col("doc_id").cast("long").alias("doc_id"), "leaf", "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root"))
    return found.withColumn("verified", F.expr("folded_root = root"))


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """One row per row of docs: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Fields may be null and are then marked so in the leaf; rows without a
    source are a source of their own, before the others. Within a source rows
    go by doc_id, nulls first, and where ids repeat by leaf; equal rows take
    neighbouring places in either order. Empty texts are values of length 0.
    Texts of any length are hashed where they are read; only digests move. An
    empty table gives no rows. Other columns of docs are not looked at.
    ``levels`` sets the size of a superblock, not the result.
    """
    source = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    rows = leaves(docs).withColumn("tree", source).withColumn("digest", F.col("leaf"))
    rows = settle(numbered(rows, ["doc_id", "leaf", "spread"]), "numbered")
    by_source = tables_upwards(rows, levels)
    subroots = by_source[-1].select(F.lit("all").alias("tree"), F.col("tree").alias("own"), "digest")
    subroots = settle(numbered(subroots, ["own"]), "subroots")
    upper = tables_upwards(subroots, levels)
    top = upper[-1].select("tree", "at", F.array().cast(PATH).alias("path"), F.lit("").alias("subroot"), F.col("digest").alias("root"))
    for nodes in upper[-2::-1]:
        top = expanded(nodes, top, levels)
    outer = subroots.join(top.drop("tree", "subroot"), "at").select(F.col("own").alias("tree"), F.lit(0).cast("long").alias("at"), "path", F.col("digest").alias("subroot"), "root")
    for nodes in by_source[-2:0:-1]:
        outer = expanded(nodes, outer, levels)
    return proofs(rows, outer, levels)
