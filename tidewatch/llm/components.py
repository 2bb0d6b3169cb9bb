"""Distributed union-find over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import cut_lineage, scratch_scope, sized, spread


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of any one orderable type -> ``(node, component)`` for each
    node that has an edge to another; the component is its smallest node.

    Contraction rounds: every node points to the smallest of itself and its
    neighbours (a map-side combined minimum, so a hub costs one row a task),
    both ends of every edge move along the pointers, loops and repeats go.
    Each round at least halves the nodes of a component. Every round is a saved
    table in the shared folder, which goes when the result is saved; the pointers
    are then composed backwards. Only row counts reach the driver. Nulls and loops
    in ``edges`` are ignored; no edges give no rows.
    """
    with scratch_scope(edges.sparkSession) as scope:
        return scope.save(_contracted(edges), "components")


def _contracted(edges: DataFrame) -> DataFrame:
    live = cut_lineage(
        edges.select("a", "b").where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    levels = []
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = cut_lineage(both.groupBy(F.col("a").alias("node"))
                           .agg(F.least(F.min("a"), F.min("b")).alias("to")), "pointers")
        levels.append(step)
        end = step.select(F.col("node").alias("b"), F.col("to").alias("b2"))
        moved = (live.join(step.select(F.col("node").alias("a"), F.col("to").alias("a2")), "a")
                 .join(end, "b").where("a2 <> b2")
                 .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
                 .distinct())
        live = cut_lineage(moved, "edges")
    if not levels:
        return live.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = levels[-1].withColumnRenamed("to", "component")
    for step in reversed(levels[:-1]):
        nxt = out.select(F.col("node").alias("to"), F.col("component"))
        out = step.join(nxt, "to", "left").select(
            "node", F.coalesce("component", "to").alias("component"))
        out = cut_lineage(out, "components")
    return out


STAR_ROUNDS = 1         # of new pivots, before what is left is compared in blocks


def settle(rows: DataFrame, tested: DataFrame, links: DataFrame, confirm, finish, block: int,
           rounds: int = STAR_ROUNDS) -> DataFrame:
    """Components of the nodes of buckets, when the first star of every bucket
    has been confirmed.

    ``rows(key, node)``: the distinct members of buckets of more than two;
    ``tested(a, b)``, ``links(a, b)``: pairs compared so far and those that hold.
    A bucket in one piece is done, which buckets of copies are at once. In each
    of the others a pivot drawn by hash meets the members outside its component
    (``confirm(pairs) -> links``): a row a member. What stays open after
    ``rounds`` of that is compared exactly by ``finish(rows) -> links`` in pairs
    of blocks, as ``block_pairs`` deals them.
    """
    comp = connected_components(links)
    for r in range(rounds + 1):
        rows = _mixed(rows.select("key", "node"), comp)
        if rows.isEmpty():
            return comp
        if r == rounds:
            links = links.unionByName(cut_lineage(finish(block_pairs(rows, block)), "links"))
        else:
            pivot = rows.groupBy("key").agg(F.min(F.struct(
                F.xxhash64("node", "key", F.lit(r)), "node", "component")).alias("p"))
            pairs = (rows.join(pivot, "key").where("component <> p.component")
                     .select(F.greatest("node", "p.node").alias("a"), F.least("node", "p.node").alias("b"))
                     .distinct())
            pairs = cut_lineage(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
            tested = tested.unionByName(pairs)
            links = links.unionByName(confirm(pairs))
        comp = connected_components(links)
    return comp


def _mixed(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """(key, node, component) of the buckets that hold more than one component."""
    rows = rows.join(comp, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component"))
    open_ = cut_lineage(rows.groupBy("key").agg(F.min("component").alias("c1"), F.max("component").alias("c2"))
                        .where("c1 <> c2").select("key"), "open")
    return cut_lineage(rows.join(sized(open_, 16), "key"), "mixed")


def block_pairs(rows: DataFrame, block: int) -> DataFrame:
    """Deal the members of buckets into pairs of blocks of ``block`` nodes at the
    mean: those outside a bucket's largest component against it and against each
    other. Columns key, i, j (the pair), blk (i or j), node, component, and task:
    pairs are dealt to tasks of some 8 blocks each, since most are tiny. Pairs of
    buckets with the same smallest component share nodes, which a task prepares
    once: they go together, or in as many parts as they fill tasks."""
    sizes = rows.groupBy("key", "component").agg(F.count("*").alias("n"))
    most = (sizes.groupBy("key").agg(F.max(F.struct("n", "component")).alias("big"), F.sum("n").alias("m"),
                                     F.min("component").alias("least"))
            .select("key", "least", F.col("big.component").alias("big"),
                    F.expr(f"cast(ceil(big.n / {block}.0) AS int)").alias("bb"),
                    F.expr(f"cast(ceil((m - big.n) / {block}.0) AS int)").alias("bo")))
    # blocks 0 to bo - 1 are of the others, bo to bo + bb - 1 of the largest component
    dealt = rows.join(most, "key").withColumn("blk", F.expr(
        "cast(if(component = big, bo + pmod(xxhash64(node), bb), pmod(xxhash64(node), bo)) AS int)"))
    pairs = cut_lineage(dealt.withColumn("to", F.explode(F.expr(
                "if(blk >= bo, sequence(0, bo - 1), sequence(0, bo + bb - 1))")))
            .select("key", F.least("blk", "to").alias("i"), F.greatest("blk", "to").alias("j"),
                    "blk", "node", "component", "least"), "blocks")
    tasks = max(1, pairs.count() // (8 * block))
    large = cut_lineage(pairs.groupBy("least").agg(F.expr(f"count(*) div {8 * block}").alias("parts"))
                        .where("parts > 0"), "parts")
    part = F.pmod(F.xxhash64("key", "i", "j"), F.col("parts") + 1)
    return (pairs.join(sized(large, 16), "least", "left")
            .withColumn("task", F.pmod(F.xxhash64("least", F.coalesce(part, F.lit(0))), F.lit(tasks)))
            .drop("least", "parts"))


SLICE = 200_000         # pairs screened at once


def spanning_links(frame, same, near) -> list[tuple[int, int]]:
    """Links that join components in one task of ``block_pairs``. ``frame`` has
    keys (a node's bucket keys); ``near(a, b) -> mask`` screens pairs of row
    numbers in ``frame``, and ``same(a, b) -> mask`` compares them exactly. A
    pair is compared in the first bucket that it shares, and only while its two
    components are still apart."""
    import numpy as np
    keys = np.stack(frame["keys"].to_numpy())
    key, i, j, blk, comp, node = (frame[c].to_numpy() for c in ("key", "i", "j", "blk", "component", "node"))
    band = (keys == key[:, None]).argmax(axis=1)
    order = np.lexsort((blk, j, i, key))        # a group's rows of block i come before those of j
    new = np.ones(len(order), bool)
    new[1:] = ((key[order][1:] != key[order][:-1]) | (i[order][1:] != i[order][:-1])
               | (j[order][1:] != j[order][:-1]))
    group = np.cumsum(new) - 1
    end = np.append(np.flatnonzero(new)[1:], len(order))[group]
    one = (blk == i)[order]
    ones = np.bincount(group, weights=one).astype(np.int64)
    place = np.arange(len(order))
    # rows of one block meet those after them; else rows of i meet those of j
    first = np.where((i == j)[order], place + 1, np.flatnonzero(new)[group] + ones[group])
    count = np.where(one, end - first, 0)
    total = np.cumsum(count)
    up: dict[int, int] = {}

    def find(x):
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    out, at = [], 0
    while at < len(order):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + SLICE, "right")))
        a = order[np.repeat(place[at:to], count[at:to])]
        b = order[spread(first[at:to], count[at:to])]
        at = to
        ok = comp[a] != comp[b]
        a, b = a[ok], b[ok]
        if len(a):
            ok = (keys[a] == keys[b]).argmax(axis=1) == band[a]
            a, b = a[ok], b[ok]
        if len(a):
            ok = near(a, b)
            a, b = a[ok], b[ok]
        for lo in range(0, len(a), 512):
            apart = [k for k in range(lo, min(lo + 512, len(a))) if find(comp[a[k]]) != find(comp[b[k]])]
            if not apart:
                continue
            for k in np.array(apart)[same(a[apart], b[apart])]:
                x, y = find(comp[a[k]]), find(comp[b[k]])
                if x != y:
                    up[x] = y
                    out.append((max(node[a[k]], node[b[k]]), min(node[a[k]], node[b[k]])))
    return out
