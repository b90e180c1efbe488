"""k-NN graph by refinement: neighbours of neighbours are likely neighbours.

The graph starts from blocks of rows that look alike (several sketches, cut into blocks of bounded size) and of
rows picked at random. Then it is improved in rounds. For every row, the links that are new since the last
round meet the row's other links, in both directions; each such pair is compared once, and a pair that
beats a kept link of either end takes its place. Rounds end when few links change. No row is ever
compared with the whole table: a round costs rows x sample^2 comparisons, and rounds grow with the
logarithm of the table.

After Dong, Moses, Li: Efficient k-nearest neighbor graph construction for generic similarity measures (2011).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from vectable.functions.vectors import is_valid, row_nearness, row_norms, to_matrix
from vectable.operators.approx import add_sketch, copies_of, pair_nearness, random_planes, spread_to_copies
from vectable.operators.search import _arrow_type
from vectable.sources.tables import drop_settled, settle
from vectable.table import COSINE, EUCLIDEAN, VectorTable, check_metric, check_range, path_col

START_BLOCK = 64  # rows compared with each other at the start
_NUMBERS = 1_000_000  # vector elements of candidate pairs scored at once, on either side


class Refined(NamedTuple):
    edges: DataFrame
    rounds: int
    compared: int  # pairs of vectors compared, all in all


def knn_graph_refined(
    corpus: DataFrame,
    table: VectorTable,
    max_degree: int = 32,
    *,
    pool: int | None = None,
    sample: int | None = None,
    starts: int = 3,
    max_rounds: int = 12,
    min_change: float = 0.002,
    metric: str | None = None,
    seed: int = 7,
) -> Refined:
    """``src, dst, rank, score`` as ``knn_graph`` gives them, without comparing all pairs.

    ``pool`` links are kept per row while refining (at least ``max_degree``; default twice as many, and 20),
    ``sample`` of them join in a round, new and old ones counted apart (default: the pool, at most 20).
    It ends when under ``min_change`` of all kept links changed in a round. Scores are exact; what may be missing
    is a link. Equal vectors are refined once, as in ``knn_graph``.
    """
    check_range("max_degree", max_degree, 1)
    metric = check_metric(metric or table.metric)
    pool = check_range("pool", max(2 * max_degree, 20) if pool is None else pool, max_degree)
    sample = check_range("sample", min(pool, 20) if sample is None else sample, 1)
    table.check(corpus, need=["id"])
    path = path_col(table.vector_path(corpus))
    rows = corpus.filter(is_valid(path, table.dims)).select(table.row_key().alias("id"), path.alias("v"))
    depth = max_degree + 1
    groups, hashed = copies_of(rows, [], depth)
    vectors = settle(rows.join(groups.select("id"), "id", "left_semi"))
    first = vectors.select(F.size("v")).head(1)
    if not first:
        empty = vectors.select(F.col("id").alias("query_id"), "id", F.lit(0.0).alias("near")).limit(0)
        return Refined(spread_to_copies(empty, groups, hashed, [], max_degree, metric, table, corpus), 0, 0)
    dims, total = first[0][0], vectors.count()

    links, compared = _start(vectors, total, dims, metric, pool, starts, seed)
    rounds = 0
    for rounds in range(1, max_rounds + 1):
        met = settle(_meetings(links, sample, rounds))
        kept, pairs = _round(links, met, vectors, dims, metric, pool)
        compared += pairs
        drop_settled(links)
        drop_settled(met)
        links = kept
        if links.filter("state = 2").count() <= min_change * pool * total:
            break
    own = vectors.select(F.col("id").alias("query_id"), "id", pair_nearness(F.col("v"), F.col("v"), metric).alias("near"))
    near = links.select(F.col("src").alias("query_id"), F.col("dst").alias("id"), "near").unionByName(own)
    return Refined(spread_to_copies(near, groups, hashed, [], max_degree, metric, table, corpus), rounds, compared)


# ---- one round --------------------------------------------------------------------------------------


def _meetings(links: DataFrame, sample: int, salt: int) -> DataFrame:
    """node, other, new, taken: who meets at a row in this round, at most 4 x ``sample``: its links and the
    rows that link to it, new and old ones, picked at random. ``taken``: a link of its own that is now used."""
    new = F.col("state") > 0
    ahead = links.select(F.col("src").alias("node"), F.col("dst").alias("other"), new.alias("new"), F.lit(True).alias("taken"))
    back = links.select(F.col("dst").alias("node"), F.col("src").alias("other"), new.alias("new"), F.lit(False).alias("taken"))

    def some(df: DataFrame) -> DataFrame:
        # The limit is applied before the shuffle too, so a row that very many link to is no hot key.
        place = F.row_number().over(Window.partitionBy("node", "new").orderBy(F.xxhash64(F.lit(salt), "node", "other"), "other"))
        return df.withColumn("place", place).filter(F.col("place") <= sample).drop("place")

    both = some(ahead).unionByName(some(back))
    return both.groupBy("node", "other").agg(F.max("new").alias("new"), F.max("taken").alias("taken"))


def _round(links: DataFrame, met: DataFrame, vectors: DataFrame, dims: int, metric: str, pool: int) -> tuple[DataFrame, int]:
    """The best ``pool`` links of every row after this round's comparisons, and how many those were. State 2 is
    a link found in this round, 1 one that was not used yet, 0 one that was."""
    sizes = met.groupBy("node").agg(F.count_if("new").alias("n"), F.count_if(~F.col("new")).alias("o"))
    pairs = sizes.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2 + F.col("n") * F.col("o"))).first()[0] or 0
    live = met.join(sizes.filter("n > 0").select("node"), "node", "left_semi")
    worst = links.groupBy("src").agg(F.when(F.count("*") >= pool, F.min("near")).alias("worst"))
    known = vectors.join(worst, F.col("id") == F.col("src"), "left").select("id", "v", "worst")
    gathered = live.join(known, F.col("other") == F.col("id")).select("node", "other", "new", "v", "worst")
    dealt = gathered.repartition("node").sortWithinPartitions("node")
    schema = _link_schema(vectors.schema["id"].dataType)
    found = dealt.mapInArrow(_local_join(dims, metric, pool, schema), schema).withColumn("state", F.lit(2))
    used = met.filter("taken").select(F.col("node").alias("src"), F.col("other").alias("dst"), F.lit(True).alias("used"))
    old = links.join(used, ["src", "dst"], "left").select("src", "dst", "near", F.when(F.col("used"), 0).otherwise(F.least("state", F.lit(1))).alias("state"))
    return settle(_best(old.unionByName(found), pool)), int(pairs)


def _best(links: DataFrame, pool: int) -> DataFrame:
    """Each link once, the ``pool`` nearest of each row. A link that was there before is no new one."""
    each = links.repartition("src").groupBy("src", "dst").agg(F.max("near").alias("near"), F.min("state").alias("state"))
    place = F.row_number().over(Window.partitionBy("src").orderBy(F.desc("near"), "dst"))
    return each.withColumn("place", place).filter(F.col("place") <= pool).drop("place")


def _link_schema(key: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("src", key), T.StructField("dst", key), T.StructField("near", T.DoubleType())])


def _start(vectors: DataFrame, total: int, dims: int, metric: str, pool: int, starts: int, seed: int) -> tuple[DataFrame, int]:
    """Links inside blocks: of rows with the same sketch bits, in ``starts`` independent ways, and of random rows."""
    bits = max(0, min(60, int(math.log2(max(1, total / START_BLOCK)))))
    planes = random_planes(vectors.sparkSession, dims, 64 * max(1, starts), seed)
    sketched = add_sketch(vectors, planes, "v") if bits and starts else vectors.withColumn("sketch", F.array())
    code = [F.col("sketch")[i].bitwiseAND(F.lit((1 << bits) - 1)) for i in range(starts if bits else 0)]
    marks = F.array(*[F.struct(F.lit(i).alias("start"), c.alias("code")) for i, c in enumerate([*code, F.lit(0).cast("bigint")])])
    placed = settle(sketched.select("id", F.explode(marks).alias("m")).select("id", "m.start", "m.code"))
    sizes = placed.groupBy("start", "code").agg(F.count("*").alias("n"))  # counted per task first, a crowded code is one row each
    cut = placed.join(F.broadcast(sizes) if (starts + 1) << bits <= 1_000_000 else sizes, ["start", "code"])
    part = F.pmod(F.xxhash64(F.lit(seed), "start", "id"), F.ceil(F.col("n") / START_BLOCK))
    blocks = cut.select("id", F.xxhash64("start", "code", part).alias("node"))
    dealt = blocks.join(vectors, "id").select("node", F.col("id").alias("other"), F.lit(True).alias("new"), "v", F.lit(None).cast("double").alias("worst"))
    sizes = blocks.groupBy("node").agg(F.count("*").alias("n"))
    compared = sizes.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()[0] or 0
    schema = _link_schema(vectors.schema["id"].dataType)
    found = dealt.repartition("node").sortWithinPartitions("node").mapInArrow(_local_join(dims, metric, pool, schema), schema)
    links = settle(_best(found.withColumn("state", F.lit(1)), pool))
    drop_settled(placed)
    return links, int(compared)


# ---- in a task ----------------------------------------------------------------------------------------


def whole_groups(batches: Iterator[pa.RecordBatch], at_least: int = 20_000) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, by the first column, with where each group starts and ends. The rows come
    sorted by it; a table has ``at_least`` rows as long as there are more."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def grouped(table: pa.Table) -> np.ndarray:
        key = table.column(0).combine_chunks()
        change = pc.not_equal(key.slice(1), key.slice(0, max(0, len(key) - 1))).to_numpy(zero_copy_only=False)
        return np.r_[0, np.flatnonzero(change) + 1, len(key)]

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < at_least:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        ends = grouped(table)
        if len(ends) > 2:  # the last group may go on
            yield table.slice(0, int(ends[-2])), ends[:-1]
            table = table.slice(int(ends[-2]))
        held, rows = table.to_batches(), 0
    if held and sum(b.num_rows for b in held):
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, grouped(table)


def _local_join(dims: int, metric: str, pool: int, schema: T.StructType):
    """Compares the members of each group of (node, other, new, v, worst): every pair with a new one in it, once.
    A pair becomes a link of either end that has fewer than ``pool`` links or a worse one."""
    arrow = pa.schema([(f.name, _arrow_type(f.dataType)) for f in schema])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, ends in whole_groups(batches):
            _, rows = to_matrix(table.column("v"), dims)
            new = table.column("new").to_numpy(zero_copy_only=False).astype(bool)
            worst = table.column("worst").fill_null(-np.inf).to_numpy(zero_copy_only=False)
            norms = row_norms(rows)
            scaled = np.divide(rows, norms[:, None], out=np.zeros_like(rows), where=norms[:, None] > 0) if metric == COSINE else rows
            margin = 1e-9 * (1 + (norms**2 if metric == EUCLIDEAN else norms))
            left, right = [], []
            for low, high in zip(ends[:-1], ends[1:]):
                size = high - low
                if size < 2:
                    continue
                x, fresh = scaled[low:high], new[low:high]
                product = x @ x.T
                if metric == EUCLIDEAN:
                    squares = norms[low:high] ** 2
                    product = -np.sqrt(np.maximum(0, squares[:, None] + squares[None, :] - 2 * product))
                usable = fresh[:, None] | fresh[None, :]
                np.fill_diagonal(usable, False)
                product[~usable] = -np.inf
                floor = worst[low:high]
                if size > pool + 1:  # no more than the best of a row can stay
                    floor = np.maximum(floor, np.partition(product, size - pool, axis=1)[:, size - pool])
                slack = margin[low:high] if metric != EUCLIDEAN else np.sqrt(margin[low:high])
                a, b = np.nonzero((product >= (floor - slack)[:, None]) & usable)
                left.append(a + low)
                right.append(b + low)
            if not left:
                continue
            a, b = np.concatenate(left), np.concatenate(right)
            near, step = np.empty(len(a)), max(1, _NUMBERS // dims)
            for at in range(0, len(a), step):
                near[at : at + step] = row_nearness(metric, rows[a[at : at + step]], rows[b[at : at + step]])
            better = near >= worst[a]
            a, b, near = a[better], b[better], near[better]
            ids = table.column("other").combine_chunks()
            out = pa.table({"src": ids.take(pa.array(a)), "dst": ids.take(pa.array(b)), "near": near}, schema=arrow)
            once = out.group_by(["src", "dst"]).aggregate([("near", "max")]).rename_columns(["src", "dst", "near"])  # two rows may meet at many nodes
            yield from once.select(["src", "dst", "near"]).cast(arrow).to_batches(max_chunksize=100_000)

    return join
