"""Prefix trie of conversations, with sums over subtrees by centroid decomposition.

A node of the trie is a sequence of first turns; turns become 128-bit hashes of
their place, role and text, and a prefix is the exact sum of them. Of a node's
conversations the smallest stands for it. The nodes that one conversation stands
for are consecutive turns, a *chain*, so the forest of parent edges is kept by
chains: a conversation of a million turns is one vertex, and where it hangs is
one row. Which chains lie above a conversation is read from its own turns.

Sums over subtrees come from recursive splitting. The centroid of a component is
its deepest chain with half of the component's conversations at or below it. The
component's total at and below the centroid is added along the path from there
to the component's top; then the centroid goes, and what is left are components
of at most half the size. No step follows the tree upwards one by one, so long
and wide tries take as many rounds, the logarithm of their size. Components of
at most ``WHOLE`` conversations are finished inside tasks the same way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmill.session import broadcast_if_small, shared_dir

from .batches import bounded, whole_groups

#: Conversations of the largest component that one task takes whole.
WHOLE = 4096
#: Turns that are summed up together, and ids that are joined together.
BLOCK = 1024
#: Shares of the conversations of one node.
CELLS = 64
#: Turns that may be taken over, and conversations that share those who lend them.
LENT, EVERY = 3, 20
WORD = r"[^\x20\x09-\x0D]+"
SUM = "decimal(38,0)"


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, at, turns, role, said, words) of the rebuilt conversations, and (conv, turns) with the number of their turns.

    Conversations are not gathered: turns are sorted by range and numbered
    within a partition, and each partition gets what lies before it.
    """
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("said"), F.col("row")]
    rows = (
        turns.withColumn("row", F.monotonically_increasing_id())  # equal rows can be parted
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("conv", "role", "said", "words", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"))
        .checkpoint()
    )
    runs = rows.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("part")) - F.col("n")
    runs = runs.select("conv", "part", "first", "n", before.alias("before")).checkpoint()
    lent = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(LENT + 1)).cast("long")
    own = runs.groupBy("conv").agg(F.sum("n").alias("own")).select("conv", "own", lent.alias("h"), F.expr(f"conv - conv % {EVERY}").alias("lender"))
    sizes = own.select(F.col("conv").alias("lender"), F.col("own").alias("theirs"))
    convs = (
        own.join(sizes, "lender", "left")
        .withColumn("taken", F.least("h", F.coalesce("theirs", F.lit(0))))
        .withColumn("turns", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
        .checkpoint()
    )
    # What a conversation is rebuilt by joins its parts first, so that a long one stays dealt out.
    parts = runs.join(convs.select("conv", "h", "taken", "turns"), "conv")
    now = rows.join(parts, ["conv", "part"]).withColumn("at", F.col("before") + F.col("row") - F.col("first") + 1)
    heads = now.where(f"at <= {LENT} and conv % {EVERY} = 0").select(F.col("conv").alias("lender"), "at", "role", "said", "words")
    taken = convs.select("conv", "lender", "taken", "turns").join(heads, "lender").where("at <= taken")
    kept = now.where("at > h").withColumn("at", F.expr("at - h + taken"))
    columns = ["conv", "at", "turns", "role", "said", "words"]
    return taken.select(*columns).unionByName(kept.select(*columns)), convs.select("conv", "turns")


def running(rows: DataFrame, sums: dict[str, str], carry: DataFrame | None = None) -> DataFrame:
    """``rows`` with exact running sums {name: column} along ``at`` per ``conv``, and the columns that ``carry`` has per conv.

    Sums are taken by blocks, and what is carried joins the blocks first, so
    that no conversation is gathered.
    """
    rows = rows.withColumn("_block", F.expr(f"at div {BLOCK}"))
    totals = rows.groupBy("conv", "_block").agg(*[F.sum(F.col(c).cast(SUM)).cast(SUM).alias(f"_{n}") for n, c in sums.items()])
    upto = Window.partitionBy("conv").orderBy("_block")
    before = totals.select("conv", "_block", *[(F.sum(f"_{n}").over(upto) - F.col(f"_{n}")).cast(SUM).alias(f"_{n}") for n in sums])
    if carry is not None:
        before = before.join(carry, "conv")
    inside = Window.partitionBy("conv", "_block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("*", *[F.sum(F.col(c).cast(SUM)).over(inside).alias(n) for n, c in sums.items()])
    out = rows.join(before, ["conv", "_block"])
    return out.withColumns({n: (F.col(n) + F.col(f"_{n}")).cast(SUM) for n in sums}).drop("_block", *[f"_{n}" for n in sums])


def prefixes(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv, at, turns, rep, words, n_convs): every prefix of every conversation and the one that stands for it."""
    first, second = [F.xxhash64(F.lit(seed), "at", "role", "said") for seed in (1, 2)]
    summed = running(rows.select("conv", "at", "turns", "words", first.alias("x"), second.alias("y")), {"px": "x", "py": "y"})
    # Conversations of a node are told apart by cell, so that what it gets back is dealt out however many they are.
    node, part = ["at", "px", "py"], F.pmod(F.xxhash64("conv"), F.lit(CELLS)).cast("int")
    summed = summed.drop("x", "y").withColumn("cell", part).checkpoint()
    cells = summed.groupBy(*node, "cell").agg(F.min("conv").alias("least"), F.count(F.lit(1)).alias("n"))
    nodes = cells.groupBy(*node).agg(F.min("least").alias("rep"), F.sum("n").alias("n_convs"))
    columns = ["conv", "at", "turns", "rep", "words", "n_convs"]
    inner = summed.join(cells.select(*node, "cell").join(nodes, node), [*node, "cell"]).select(*columns)
    low, many = lengths.agg(F.min("conv"), F.count(F.lit(1))).first()
    fixed = [F.lit(v).cast("long").alias(c) for c, v in (("at", 0), ("rep", low), ("words", 0), ("n_convs", many))]
    return inner.unionByName(lengths.select("conv", "turns", *fixed))


def finished(part: DataFrame) -> DataFrame:
    """(conv, leaves, saved): sums over the subtrees inside components (conv, parent, top, leaves, saved) of bounded size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches, ["top"]):
            # Ids grow downwards: a parent comes before its children.
            rows = rows.sort_values(["top", "conv"], kind="stable")
            own = rows[["leaves", "saved"]].to_numpy()
            place = {c: i for i, c in enumerate(rows["conv"].tolist())}
            parent = [place.get(p, -1) if c != t else -1 for c, p, t in zip(rows["conv"].tolist(), rows["parent"].tolist(), rows["top"].tolist())]
            out = np.zeros_like(own)
            tops = rows["top"].to_numpy()
            starts = [0, *(np.flatnonzero(tops[1:] != tops[:-1]) + 1).tolist()]
            work = [list(range(a, b)) for a, b in zip(starts, [*starts[1:], len(rows)])]
            while work:
                members = work.pop()
                below = {i: [1, int(own[i, 0]), int(own[i, 1])] for i in members}
                for i in reversed(members[1:]):
                    up, mine = below[parent[i]], below[i]
                    up[0] += mine[0]
                    up[1] += mine[1]
                    up[2] += mine[2]
                centre = max(i for i in members if 2 * below[i][0] >= len(members))
                total, i = below[centre][1:], centre
                while i in below:
                    out[i] += total
                    i = parent[i]
                parts: dict[int, list[int]] = {}
                new: dict[int, int] = {}
                for i in members:
                    if i != centre:
                        new[i] = new.get(parent[i], i)
                        parts.setdefault(new[i], []).append(i)
                work += parts.values()
            yield pd.DataFrame({"conv": rows["conv"], "leaves": out[:, 0], "saved": out[:, 1]})

    dealt = part.select("top", "conv", F.coalesce("parent", "conv").alias("parent"), "leaves", "saved").repartition("top").sortWithinPartitions("top")
    return dealt.mapInPandas(run, "conv long, leaves long, saved long")


def rolled_up(chains: DataFrame, above: DataFrame, whole: int = WHOLE) -> DataFrame:
    """(conv, leaves, saved): totals of the subtrees of all chains.

    ``chains`` has conv, parent (null at the root), weight, size, leaves and
    saved: weights are positive, ``size`` is their sum over the subtree, the
    others are the chain's own. ``above`` has (conv, up) for every chain and
    each chain from the root down to itself; ids grow downwards.
    """
    spark = chains.sparkSession
    low = chains.agg(F.min("conv")).first()[0]
    now = chains.withColumn("top", F.lit(low).cast("long"))
    added = None
    while True:
        now = now.checkpoint()
        # Components above the bound are fewer than all conversations by that factor.
        large = now.groupBy("top").agg(F.sum("weight").alias("of")).where(F.col("of") > whole).checkpoint()
        if large.isEmpty():
            break
        large = broadcast_if_small(large)
        half = now.join(large, "top").where("2 * size >= of")
        centres = half.groupBy("top").agg(F.max(F.struct("conv", "size")).alias("c"))
        centres = broadcast_if_small(centres.select("top", F.col("c.conv").alias("centre"), F.col("c.size").alias("gone")).checkpoint())
        split = now.join(centres, "top")
        # Whether a chain is below the centroid, and the top of its new component if so.
        under = (
            split.select("conv", "centre").join(above, "conv").where("up >= centre").groupBy("conv", "centre")
            .agg(F.min("up").alias("low"), F.min(F.when(F.col("up") > F.col("centre"), F.col("up"))).alias("child"))
            .where("low = centre").select("conv", "child")
        )
        split = split.join(under.withColumn("below", F.lit(True)), "conv", "left").checkpoint()
        totals = split.where("below").groupBy("centre").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        path = centres.join(above.withColumnRenamed("conv", "centre"), "centre").where("up >= top")
        path = path.join(totals, "centre").select(F.col("up").alias("conv"), "leaves", "saved", F.when(F.col("up") < F.col("centre"), F.col("gone")).alias("gone")).checkpoint()
        adds = path.select("conv", "leaves", "saved")
        added = adds if added is None else added.unionByName(adds)
        rest = (
            split.where("conv <> centre").drop("gone").join(path.select("conv", "gone"), "conv", "left")
            .withColumn("size", F.col("size") - F.coalesce("gone", F.lit(0)))
            .withColumn("top", F.coalesce("child", "top"))
        )
        # Chains of components that stay as they are, and those of the new ones.
        now = now.join(centres.select("top"), "top", "left_anti").select(*chains.columns, "top").unionByName(rest.select(*chains.columns, "top"))
    bounded(spark)
    sums = finished(now)
    sums = sums if added is None else sums.unionByName(added)
    return sums.groupBy("conv").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def ends_digest(ends: DataFrame) -> DataFrame:
    """(rep, at, ends_sha256) of the ascending ids ``conv`` that end at each node, joined by commas.

    Ids are sorted by range and joined in blocks; SHA-256 then reads the blocks
    of a node in order, one batch at a time.
    """
    bounded(ends.sparkSession)

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = rows.groupby(["rep", "at"], sort=False)["conv"]
            yield pd.DataFrame({"first": out.min(), "ids": out.agg(lambda x: ",".join(map(str, x)))}).reset_index()[["rep", "at", "first", "ids"]]

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, state = None, None
        for rows in batches:
            done = []
            for rep, at, ids in zip(rows["rep"].tolist(), rows["at"].tolist(), rows["ids"]):
                if (rep, at) == node:
                    state.update(b"," + ids.encode())
                else:
                    if node:
                        done.append((*node, state.hexdigest()))
                    node, state = (rep, at), hashlib.sha256(ids.encode())
            yield pd.DataFrame(done, columns=["rep", "at", "ends_sha256"])
        if node:
            yield pd.DataFrame([(*node, state.hexdigest())], columns=["rep", "at", "ends_sha256"])

    order = ["rep", "at", "conv"]
    joined = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(blocks, "rep long, at long, first long, ids string")
    dealt = joined.repartition("rep", "at").sortWithinPartitions("rep", "at", "first")
    return dealt.mapInPandas(digests, "rep long, at long, ends_sha256 string")


def trie(
    rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", whole: int = WHOLE
) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by turn, null first, then by role and digest of the text;
    null roles and texts are empty; repeated rows are turns of their own. Rows
    without a conversation id belong to none and are left out. Conversations
    are rebuilt with the first turns of their lender. An empty table gives an
    empty result; other columns are not read.
    """
    shared_dir(rows.sparkSession)
    blank: Column = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    turns = rows.select(
        F.col(f"`{conv}`").cast("long").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.md5(blank.cast("binary")).alias("said"),
        F.regexp_count(blank, F.lit(WORD)).cast("long").alias("words"),
    ).where("conv is not null")
    made, lengths = rebuilt(turns)
    seen = prefixes(made, lengths).checkpoint()
    # Chains from top to bottom, as the conversations see them; a conversation's own chain is its last if it has one.
    above = seen.groupBy("conv", F.col("rep").alias("up")).agg(F.min("at").alias("from")).checkpoint()
    own = above.where("conv = up").select("conv", F.col("from"))
    parents = above.where("up < conv").groupBy("conv").agg(F.max("up").alias("parent"))
    hung = own.join(parents, "conv", "left").checkpoint()  # conv, from, parent
    nodes = seen.where("conv = rep")
    # Chains that hang at a node; those of a node that very many share are counted before they meet it.
    at = hung.where("parent is not null").select(F.col("parent").alias("conv"), (F.col("from") - 1).alias("at"), F.col("conv").alias("chain"))
    count = at.groupBy("conv", "at").agg(F.count(F.lit(1)).alias("hanging"))
    nodes = (
        nodes.join(count, ["conv", "at"], "left")
        .withColumn("n_children", F.coalesce("hanging", F.lit(0)) + (F.col("at") < F.col("turns")).cast("long"))
        .select("conv", "at", "n_convs", "n_children", (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("save"))
        .checkpoint()
    )
    size = nodes.groupBy("conv").agg(F.max("n_convs").alias("size"), F.sum("leaf").alias("leaves"), F.sum("save").alias("saved"))
    chains = hung.join(size, "conv")
    below = chains.where("parent is not null").groupBy(F.col("parent").alias("conv")).agg(F.sum("size").alias("hung"))
    chains = chains.join(below, "conv", "left").withColumn("weight", F.col("size") - F.coalesce("hung", F.lit(0)))
    chains = chains.select("conv", "parent", "weight", "size", "leaves", "saved").checkpoint()
    totals = rolled_up(chains, above.join(own.select("conv"), "conv").select("conv", "up").checkpoint(), whole).checkpoint()
    # A node's subtree is that of its chain without what stands and hangs above the node.
    hanging = at.join(totals.withColumnRenamed("conv", "chain"), "chain").groupBy("conv", "at").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
    along = nodes.join(hanging, ["conv", "at"], "left").withColumns(
        {"l": F.col("leaf") + F.coalesce("l", F.lit(0)), "s": F.col("save") + F.coalesce("s", F.lit(0))}
    )
    along = running(along, {"upto_l": "l", "upto_s": "s"}, totals.join(hung, "conv"))
    ends = seen.where("at = turns").select("rep", "at", "conv")
    digests = ends_digest(ends).withColumnRenamed("rep", "conv")
    return along.join(digests, ["conv", "at"], "left").select(
        F.col("conv").alias("conv_id"),
        F.col("at").alias("depth"),
        F.when(F.col("at") > F.col("from"), F.col("conv")).otherwise(F.col("parent")).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        (F.col("leaves") - F.col("upto_l") + F.col("l")).cast("long").alias("n_leaves"),
        (F.col("saved") - F.col("upto_s") + F.col("s")).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
