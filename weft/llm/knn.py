"""Operator 7: exact top-k by inner product, as a Voronoi join of queries and data.

Both sides are dealt to the nearest of a few pivots. A summary of each Voronoi cell (rows, largest distance to its
pivot, and for its queries the largest distance and norm) gives each query group a score that its k-th best can't fall
below, and the most that a row can score with any of its queries; a local search among a few rows raises the first. Only
rows that can reach a group's bound are replicated to it; groups are solved locally, in blocks of queries and chunks of
the data whose best k are merged in the end. By the Cauchy-Schwarz inequality, for a query q near pivot p with |q - p| <= R: q x lies within p x - R |x| .. p x + R |x|.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Pivots at most; they and their summaries are all that the driver sees.
PIVOTS = 64
#: Least rows of a chunk of data, about, and queries of a block: a task holds one block's queries and a few thousand rows.
CHUNK_ROWS = 16_384
QUERY_ROWS = 8_192
#: Rows that seed the bounds, picked by the hashes of their ids; they are sent to all executors.
SEED_ROWS = 4_096
NOTHING = -(2**62)


def quantized(embedding: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component as double; null where the vector or a component is null or not finite."""
    whole = F.transform(embedding, lambda x: F.floor(x.cast("double") * scale))
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(embedding.isNotNull() & fine, whole)


def _matrix(column) -> np.ndarray:
    n = len(column)
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(n, -1) if n else flat.reshape(0, 0)


def _nearest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = (x * x).sum(1)[:, None] - 2 * x @ pivots.T + (pivots * pivots).sum(1)[None]
    cell = d.argmin(1)
    return cell, np.sqrt(np.maximum(d[np.arange(len(x)), cell], 0))


def voronoi_topk(vectors: DataFrame, is_query: Column, *, k: int = 20, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k highest inner products; ties go to the smaller vec_id.

    vectors needs vec_id and x, an array of whole numbers; is_query is a condition on its columns. Rows with null vec_id
    or x take no part; other columns aren't read. A vec_id counts once, with its least vector if it has several, and as a
    query if any of its rows is one; a query's own row is the one with its vec_id. Vectors of different lengths have no
    product, so each length is searched by itself. Scores are whole numbers of 64 bits; components for which they could be
    larger are an error. Fewer than k other rows give as many results; empty tables give none.
    """
    spark = vectors.sparkSession
    rows = vectors.where("vec_id is not null and x is not null and size(x) > 0").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("x").cast("array<double>").alias("x"), F.coalesce(is_query, F.lit(False)).alias("query"))
    if not rows.groupBy("vec_id").count().where("count > 1").isEmpty():
        rows = rows.groupBy("vec_id").agg(F.min("x").alias("x"), F.max("query").alias("query"))
    sizes = rows.groupBy(F.size("x").alias("n")).agg(F.count("*").alias("rows"), F.count_if("query").alias("queries"), F.max(F.array_max(F.transform("x", F.abs))).alias("most")).orderBy("n").collect()
    out = None
    for size in sizes:
        if size.queries and size.rows > 1:
            found = _topk(rows.where(F.size("x") == size.n) if len(sizes) > 1 else rows, size.rows, size.queries, size.n * size.most**2, k, pivots)
            out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")


def _kind(most: float):
    """The type in which products up to a size are exact."""
    if most >= 2**62:
        raise ValueError("scores could leave 64 bits")
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64


def _best(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(scores, ids) of each query's k best rows but its own; ids ascend. Places that aren't filled have the least score."""
    got = (q @ x.T).astype(np.int64)
    got[ids[None] == q_ids[:, None]] = NOTHING
    m = min(k, len(ids))
    # The k-th highest score; what ties with it is taken by smaller id.
    least = np.partition(got, len(ids) - m, 1)[:, len(ids) - m]
    above = got > least[:, None]
    tied = got == least[:, None]
    keep = above | (tied & (np.cumsum(tied, 1) <= (m - above.sum(1))[:, None]))
    top = np.nonzero(keep)[1].reshape(len(q), m)
    return np.take_along_axis(got, top, 1), ids[top]


def _topk(rows: DataFrame, n: int, queries: int, most: float, k: int, pivots: int) -> DataFrame:
    spark = rows.sparkSession
    exact = _kind(most)
    wanted = int(min(pivots, max(1, round(queries**0.5 / 4))))
    p = np.array([r.x for r in rows.select("x").distinct().orderBy(F.xxhash64("x")).limit(wanted).collect()])
    # A few rows that all queries are held against first: the k-th best of them is a score that theirs can't fall below.
    some = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SEED_ROWS).select("vec_id", "x").toArrow().sort_by("vec_id")
    seed_ids, seed_x = np.asarray(some.column("vec_id")), _matrix(some.column("x").combine_chunks()).astype(exact)

    def summarise(batches):
        import pyarrow as pa

        count, radius, q_radius, q_norm, q_count = np.zeros(len(p), np.int64), *np.zeros((3, len(p))), np.zeros(len(p), np.int64)
        least = np.full(len(p), np.inf)
        for b in batches:
            if not b.num_rows:
                continue
            x, q = _matrix(b.column("x")), np.asarray(b.column("query"))
            cell, d = _nearest(x, p)
            np.add.at(count, cell, 1)
            np.maximum.at(radius, cell, d)
            np.add.at(q_count, cell[q], 1)
            np.maximum.at(q_radius, cell[q], d[q])
            np.maximum.at(q_norm, cell[q], np.sqrt((x[q] ** 2).sum(1)))
            mine, own = np.flatnonzero(q), np.asarray(b.column("vec_id"))
            for a in range(0, len(mine), 512):
                part = mine[a : a + 512]
                score = _best(own[part], x[part].astype(exact), seed_ids, seed_x, k)[0].min(1) if len(seed_ids) >= k else np.full(len(part), NOTHING)
                np.minimum.at(least, cell[part], np.where(score == NOTHING, -np.inf, score))
        yield pa.RecordBatch.from_pydict({"cell": np.arange(len(p)), "n": count, "r": radius, "qr": q_radius, "qn": q_norm, "q": q_count, "b": least})

    parts = rows.mapInArrow(summarise, "cell long, n long, r double, qr double, qn double, q long, b double")
    s = {r.cell: r for r in parts.groupBy("cell").agg(F.sum("n").alias("n"), F.max("r").alias("r"), F.max("qr").alias("qr"), F.max("qn").alias("qn"), F.sum("q").alias("q"), F.min("b").alias("b")).collect()}
    count, radius, q_radius, q_norm, q_count, seeded = (np.array([s[c][f] for c in range(len(p))], float) for f in ("n", "r", "qr", "qn", "q", "b"))
    norm = np.sqrt((p * p).sum(1))
    # What every row of a cell scores at least with every query of a group; enough cells hold k rows besides the query's own.
    low = p @ p.T - q_radius[:, None] * norm[None] - q_norm[:, None] * radius[None]
    order = np.argsort(-low, 1)
    enough = np.cumsum(count[order], 1) >= k + 1
    bound = np.array([low[i, order[i, np.argmax(enough[i])]] if enough[i].any() else -np.inf for i in range(len(p))])
    bound = np.maximum(bound, seeded)
    bound[q_count == 0] = np.inf
    slack = 1e-6 * (1 + np.abs(bound[np.isfinite(bound)]).max(initial=0))
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, int((q_count > 0).sum()))
    # A group's queries are cut into blocks and its data into chunks: a cell is one block with one chunk.
    blocks = np.maximum(1, -(-q_count.astype(np.int64) // QUERY_ROWS))
    # Each chunk keeps its own best k of a query, so there are no more than keep the tasks busy.
    chunks = max(1, min(-(-n // CHUNK_ROWS), -(-4 * parallel // groups)))

    def deal(batches):
        """Each query to its block with every chunk; each row to its chunk with every block of each group whose bound it can reach."""
        import pyarrow as pa

        for b in batches:
            if not b.num_rows:
                continue
            x, ids, q = _matrix(b.column("x")), np.asarray(b.column("vec_id")), np.asarray(b.column("query"))
            cell, _ = _nearest(x, p)
            length = np.sqrt((x * x).sum(1))[:, None]
            most_of = np.minimum(x @ p.T + q_radius[None] * length, q_norm[None] * length)
            row, group = np.nonzero(most_of >= bound[None] - slack)
            mine = np.flatnonzero(q)
            mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            chunk, block = (mixed % np.uint64(chunks)).astype(np.int32), ((mixed >> np.uint64(3)) % blocks[cell].astype(np.uint64)).astype(np.int32)
            times = blocks[group]
            source = np.concatenate([np.repeat(mine, chunks), np.repeat(row, times)])
            each = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            packed = pa.array([v.tobytes() for v in x.astype(exact)], pa.binary()).take(pa.array(source))
            yield pa.RecordBatch.from_pydict(
                {
                    "grp": np.concatenate([np.repeat(cell[mine], chunks), np.repeat(group, times)]).astype(np.int32),
                    "block": np.concatenate([np.repeat(block[mine], chunks), each]).astype(np.int32),
                    "chunk": np.concatenate([np.tile(np.arange(chunks), len(mine)), np.repeat(chunk[row], times)]).astype(np.int32),
                    "data": np.concatenate([np.zeros(len(mine) * chunks, np.int32), np.ones(int(times.sum()), np.int32)]),
                    "vec_id": ids[source],
                    "x": packed,
                }
            )

    def solve(batches):
        """Best k of each cell's queries; a cell's queries come first, its data in blocks of rows after them."""
        import pyarrow as pa

        here, q_ids, q_rows, d_ids, d_rows, best = None, [], [], [], [], None

        def block():
            nonlocal best, d_ids, d_rows
            if d_rows and q_rows:
                if best is None:
                    q = np.frombuffer(b"".join(q_rows), exact).reshape(len(q_rows), -1)
                    best = {"ids": np.array(q_ids), "q": q, "score": np.full((len(q), k), NOTHING), "id": np.zeros((len(q), k), np.int64)}
                ids, x = np.array(d_ids), np.frombuffer(b"".join(d_rows), exact).reshape(len(d_rows), -1)
                for a in range(0, len(best["q"]), 512):
                    part = slice(a, a + 512)
                    score, found = _best(best["ids"][part], best["q"][part], ids, x, k)
                    best["score"][part], best["id"][part] = _merge(best["score"][part], best["id"][part], score, found, k)
            d_ids, d_rows = [], []

        def done():
            block()
            if best is None:
                return None
            i, j = np.nonzero(best["score"] > NOTHING)
            return pa.RecordBatch.from_pydict({"query_id": best["ids"][i], "vec_id": best["id"][i, j], "score": best["score"][i, j]})

        for b in batches:
            for row in b.to_pylist():
                cell = (row["grp"], row["block"], row["chunk"])
                if cell != here:
                    if here is not None and (out := done()) is not None:
                        yield out
                    here, q_ids, q_rows, d_ids, d_rows, best = cell, [], [], [], [], None
                if not row["data"]:
                    q_ids.append(row["vec_id"])
                    q_rows.append(row["x"])
                    continue
                d_ids.append(row["vec_id"])
                d_rows.append(row["x"])
                if len(d_rows) >= 4096:
                    block()
        if here is not None and (out := done()) is not None:
            yield out

    dealt = rows.mapInArrow(deal, "grp int, block int, chunk int, data int, vec_id long, x binary").repartition(parallel, "grp", "block", "chunk").sortWithinPartitions("grp", "block", "chunk", "data", "vec_id")
    found = dealt.mapInArrow(solve, "query_id long, vec_id long, score long")
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _merge(score, ids, more_score, more_ids, k: int):
    """The k best of two sets of different rows, by score and then smaller id."""
    s, i = np.concatenate([score, more_score], 1), np.concatenate([ids, more_ids], 1)
    order = np.lexsort((i, -s), axis=1)[:, :k]
    return np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)
