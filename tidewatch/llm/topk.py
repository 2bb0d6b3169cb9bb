"""Exact top-k inner products: ball trees over shards of the vectors, searched
by branch and bound with the k-th score shared between waves of shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import cut_lineage, with_row_id

SCALE = 1024
TOP = 10
EVERY = 100             # queries: rows whose id it divides
SHARD_ROWS = 8192       # rows of a shard, queries of a block, at the mean
LEAF = 128
FIRST_WAVE = 8          # one shard in so many is searched first


class BallTree:
    """Centres and radii of a binary tree over integer vectors, leaves in order."""

    def __init__(self, x, leaf=LEAF):
        import numpy as np
        self.centre, self.radius, self.kids, self.leaf = [], [], [], []
        self.order = np.arange(len(x))
        self._split(x, 0, len(x), leaf)
        self.centre, self.radius = np.array(self.centre), np.array(self.radius)

    def _split(self, x, lo, hi, leaf):
        import numpy as np
        me = len(self.kids)
        part = x[self.order[lo:hi]]
        c = part.mean(axis=0)
        away = ((part - c) ** 2).sum(axis=1)
        self.centre.append(c)
        self.radius.append(float(np.sqrt(away.max())) * (1 + 1e-9) + 1e-6)
        self.kids.append(None)
        self.leaf.append((lo, hi))
        if hi - lo > leaf and away.max() > 0:
            a = part[away.argmax()]
            b = part[((part - a) ** 2).sum(axis=1).argmax()]
            mid = lo + (hi - lo) // 2
            rank = np.argsort(part @ (b - a), kind="stable")
            self.order[lo:hi] = self.order[lo:hi][rank]
            self.kids[me] = (self._split(x, lo, mid, leaf), self._split(x, mid, hi, leaf))
        return me


def search(x, ids, rows, q, q_rows, floor, k):
    """Top k of each query among one shard.

    x, q: integer-valued vectors; rows: row numbers (a query skips its own);
    floor: scores that k candidates are known to reach, -inf if none. Nodes go
    by upper bound q.c + |q| r; a node below the current k-th score is cut.
    Returns (query index, candidate index, score) arrays.
    """
    import numpy as np
    exact = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * x.shape[1] < 2 ** 53
    xf, qf = x.astype(np.float64), q.astype(np.float64)
    tree = BallTree(xf)
    norm = np.sqrt((qf ** 2).sum(axis=1)) * (1 + 1e-9)
    bound = qf @ tree.centre.T
    bound += norm[:, None] * tree.radius[None, :]
    bound += 1e-6 * (1 + np.abs(bound))
    leaves = []
    todo = [(0, None)]
    while todo:                      # a leaf's bound is the least on its path
        node, cap = todo.pop()
        mine = bound[:, node] if cap is None else np.minimum(bound[:, node], cap)
        if tree.kids[node] is None:
            leaves.append((node, mine))
        elif (mine >= floor).any():
            todo += [(c, mine) for c in tree.kids[node]]
    if not leaves:
        return (np.empty(0, np.int64),) * 3
    ub = np.stack([b for _, b in leaves], axis=1)
    visit = np.argsort(-ub, axis=1, kind="stable")
    kth = floor.copy()
    best = [[] for _ in range(len(q))]         # per query: (score, candidate) arrays, cut to k
    live = np.arange(len(q))
    for step in range(visit.shape[1]):
        live = live[ub[live, visit[live, step]] >= kth[live]]
        if not len(live):
            break
        at = visit[live, step]
        for leaf in np.unique(at):
            who = live[at == leaf]
            lo, hi = tree.leaf[leaves[leaf][0]]
            mem = tree.order[lo:hi]
            s = (qf[who] @ xf[mem].T).astype(np.int64) if exact else q[who] @ x[mem].T
            for i, scores in zip(who, s):
                ok = (scores >= kth[i]) & (rows[mem] != q_rows[i])
                if not ok.any():
                    continue
                sc, cand = scores[ok], mem[ok]
                if len(best[i]):
                    sc, cand = np.concatenate([best[i][0], sc]), np.concatenate([best[i][1], cand])
                top = np.lexsort((rows[cand], ids[cand], -sc))[:k]
                best[i] = (sc[top], cand[top])
                if len(top) == k:
                    kth[i] = max(kth[i], sc[top[-1]])
    hits = [(i, *b) for i, b in enumerate(best) if len(b)]
    if not hits:
        return (np.empty(0, np.int64),) * 3
    return (np.concatenate([np.full(len(s), i) for i, s, _ in hits]),
            np.concatenate([c for _, _, c in hits]), np.concatenate([s for _, s, _ in hits]))


def _search_group(queries, shard, k):
    import numpy as np
    import pandas as pd
    none = pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_row", "query_id", "row", "vec_id", "score")})
    if not len(queries) or not len(shard):
        return none
    x, q = np.stack(shard["v"].to_numpy()), np.stack(queries["q_v"].to_numpy())
    ids, rows = shard["vec_id"].to_numpy(), shard["row"].to_numpy()
    floor = queries["kth"].to_numpy(dtype=float)
    floor = np.where(np.isnan(floor), -np.inf, floor)
    qi, ci, score = search(x, ids, rows, q, queries["query_row"].to_numpy(), floor, k)
    return pd.DataFrame({"query_row": queries["query_row"].to_numpy()[qi], "query_id": queries["query_id"].to_numpy()[qi],
                         "row": rows[ci], "vec_id": ids[ci], "score": score}, dtype="int64")


_FOUND = "query_row bigint, query_id bigint, row bigint, vec_id bigint, score bigint"


def _wave(queries: DataFrame, shards: DataFrame, q_blocks: int, n_shards: int, wanted, k: int) -> DataFrame:
    """Search the shards that ``wanted`` names; a task is one shard and one
    block of queries."""
    some = shards.where(wanted).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    nums = F.sequence(F.lit(0), F.lit(n_shards - 1))
    asks = queries.withColumn("shard", F.explode(nums)).where(wanted)
    one, two = asks.groupBy("dim", "shard", "qb"), some.groupBy("dim", "shard", "qb")
    return one.cogroup(two).applyInPandas(lambda a, b: _search_group(a, b, k), _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    from pyspark.sql import Window
    w = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, k: int = TOP, every: int = EVERY, scale: int = SCALE,
          shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``vectors(vec_id, embedding, ...)`` -> query_id, rank, vec_id, score.

    Components become floor(scale * x). Queries are the rows whose vec_id is
    divisible by ``every``, candidates all rows but the query's own row, so a
    repeated row is a candidate of its copies. Vectors that are null, empty or
    hold null or non-finite components take no part, nor do null vec_ids; a
    query meets vectors of its own length only. Ties go to the smaller vec_id.
    Shards and query blocks are dealt by a hash of the row, near ``shard_rows``
    rows each. A first wave of shards gives every query a k-th score, which the
    second wave starts from. Scores must fit a long.
    """
    ok = "embedding IS NOT NULL AND vec_id IS NOT NULL AND size(embedding) > 0 AND " \
         "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(double(x)) < double('Infinity'))"
    clean = (vectors.select("vec_id", "embedding").withColumn("row", F.monotonically_increasing_id()).where(ok)
             .select(F.col("vec_id").cast("long").alias("vec_id"), "row", F.size("embedding").alias("dim"),
                     F.expr(f"transform(embedding, x -> cast(floor({scale} * double(x)) as bigint))").alias("v")))
    clean = cut_lineage(clean, "vectors")
    n = clean.count()
    n_shards, q_blocks = max(1, -(-n // shard_rows)), max(1, -(-n // (every * shard_rows)))
    shards = clean.withColumn("shard", F.expr(f"cast(pmod(xxhash64(row, 1), {n_shards}) as int)"))
    asks = (clean.where(F.col("vec_id") % every == 0)
            .select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), "dim",
                    F.col("v").alias("q_v"))
            .withColumn("qb", F.expr(f"cast(pmod(xxhash64(query_row, 2), {q_blocks}) as int)")))
    asks = cut_lineage(asks, "queries")
    first = F.col("shard") % FIRST_WAVE == 0
    start = cut_lineage(_best(_wave(asks.withColumn("kth", F.lit(None).cast("double")), shards, q_blocks,
                                    n_shards, first, k), k).drop("rank"), "wave")
    kth = (start.groupBy("query_row").agg(F.min("score").alias("m"), F.count("*").alias("c"))
           .where(F.col("c") == k).select("query_row", F.col("m").cast("double").alias("kth")))
    found = start
    if n_shards > 1:
        found = start.unionByName(_wave(asks.join(kth, "query_row", "left"), shards, q_blocks, n_shards, ~first, k))
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
