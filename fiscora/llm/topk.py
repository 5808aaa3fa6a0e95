"""Exact top-k inner-product search by columnar branch and bound.

The rows are dealt by a hash into parts of bounded bytes, and each query row goes to every part, all by one shuffle: the
driver holds no vector.  A task keeps one part's candidates in vertical layout, one row per dimension, and takes the
queries block by block.  Scores are summed dimension block by dimension block; after each, a pair survives only if its
partial sum plus the Cauchy-Schwarz bound of the remaining mass reaches the query's current k-th score, and survivors
are compacted.  Each part returns k rows a query, from which a window takes the k best.

Sums are floating-point with a margin far above their error, so nothing is lost by the bounds.  Where all sums are exact
in a double they are the scores; beyond that, survivors that the margin cannot tell apart are scored by integers.

Defined cases: a vector that is null, empty, or holds null or non-finite components takes no part, neither as query nor
as candidate, and so do rows of a null id; vectors of other lengths than the query's are no candidates of it; ties go to
the smaller id; rows of a repeated id are candidates each and queries each, and a query leaves out its own row only;
other columns are ignored.  Components and scores beyond a long count as the nearest long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, materialise

#: Bytes of candidates in a part, and the fewest rows that make one.
PART_BYTES, PART_ROWS = 32 << 20, 1024
#: Candidates in a vertical block, queries in a block, dimensions between two prunings.
CANDIDATES, QUERIES, DIMENSIONS = 4096, 128, 16
_EXACT, _MOST, _BEYOND = float(1 << 53), (1 << 63) - 1, float(1 << 63)
#: Share of the vectors' lengths that covers the error of a sum.
MARGIN = 1e-9


def usable(vector: Column) -> Column:
    """The vector as doubles where every component is finite, else null."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when((F.size(vector) > 0) & fine, wide)


class Part:
    """A block of candidates: row keys, ids, and vectors as one row per dimension with the mass left after each cut."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray):
        self.rows, self.ids, self.vectors = rows, ids, vectors
        self.columns = np.ascontiguousarray(vectors.T, np.float64)
        self.largest = float(np.abs(self.columns).max(initial=0))
        self.rest = {c: np.sqrt((self.columns[c:] * self.columns[c:]).sum(axis=0)) for c in range(0, len(self.columns), DIMENSIONS)}

    def reaching(self, q: np.ndarray, low: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, float]]:
        """(query, candidates, sums, margin) of the candidates that may reach low[query]."""
        dims, step = len(self.columns), DIMENSIONS
        first = q[:, :step] @ self.columns[:step]
        for i in range(len(q)):
            part, at = first[i], None
            mass = np.sqrt((q[i] * q[i])[::-1].cumsum()[::-1])
            margin = MARGIN * mass[0] * float(self.rest[0].max(initial=0)) + 1e-6
            for c in range(step, dims, step):
                if np.isfinite(low[i]):
                    rest = self.rest[c] if at is None else self.rest[c][at]
                    stay = np.flatnonzero(part + mass[c] * rest + margin >= low[i])
                    part, at = part[stay], stay if at is None else at[stay]
                    if not len(at):
                        break
                rows = self.columns[c : c + step] if at is None else self.columns[c : c + step, at]
                part = part + q[i, c : c + step] @ rows
            if len(part):
                yield i, np.arange(self.columns.shape[1]) if at is None else at, part, margin


def best_of(query_rows: np.ndarray, queries: np.ndarray, blocks: list[Part], k: int) -> Iterator[tuple[int, int, int]]:
    """(query, id, score) of the k best candidates of each query in the blocks."""
    q = queries.astype(np.float64)
    largest, dims = np.abs(q).max(axis=1, initial=0), q.shape[1]
    found: list[list[tuple[int, int]]] = [[] for _ in q]  # (-score, id), the best first
    low = np.full(len(q), -np.inf)
    for block in blocks:
        for i, at, sums, margin in block.reaching(q, low):
            other = block.rows[at] != query_rows[i]
            at, sums = at[other], np.clip(sums[other], -_BEYOND, _BEYOND)
            if len(sums) > k:
                near = sums >= np.partition(sums, len(sums) - k)[len(sums) - k] - 2 * margin
                at, sums = at[near], sums[near]
            if largest[i] * block.largest * dims < _EXACT:
                scores = sums.astype(np.int64).tolist()
            else:
                exact = block.vectors[at].astype(object) @ queries[i].astype(object)
                scores = [max(-_MOST - 1, min(_MOST, int(s))) for s in exact]
            found[i] = sorted(found[i] + list(zip((-s for s in scores), block.ids[at].tolist())))[:k]
            if len(found[i]) == k:
                low[i] = float(-found[i][-1][0]) - margin
    for i, rows in enumerate(found):
        for score, other in rows:
            yield i, other, -score


def _searcher(k: int):
    """Rows (length, part, is query, row key, id, vector), sorted by these, to (row key, query id, id, score)."""
    names = ["_r", "query_id", "vec_id", "score"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, blocks = None, []
        for batch in batches:
            marks = [np.asarray(batch.column(c)) for c in range(3)]
            cuts = np.flatnonzero(np.any([np.diff(m) != 0 for m in marks], axis=0)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if a == b:
                    continue
                dims = int(marks[0][a])
                if unit != (dims, int(marks[1][a])):
                    unit, blocks = (dims, int(marks[1][a])), []
                step = QUERIES if marks[2][a] else CANDIDATES
                for x in range(a, b, step):
                    piece = batch.slice(x, min(step, b - x))
                    rows, ids = np.asarray(piece.column(3)), np.asarray(piece.column(4))
                    vectors = np.asarray(piece.column(5).flatten()).reshape(len(rows), dims)
                    if not marks[2][a]:
                        blocks.append(Part(rows, ids, vectors))
                        continue
                    made = list(best_of(rows, vectors, blocks, k))
                    at = np.array([m[0] for m in made], np.int64)
                    columns = [rows[at], ids[at], np.array([m[1] for m in made], np.int64), np.array([m[2] for m in made], np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return search


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", part_bytes: int = PART_BYTES, part_rows: int = PART_ROWS
) -> DataFrame:
    """(query_id, rank, id, score): the k largest integer inner products of floor(scale * x) of every query."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = vectors.select(F.col(id_col).cast("long").alias("vec_id"), usable(F.col(vector_col)).alias("_v"), F.coalesce(is_query, F.lit(False)).alias("_q"))
    whole = whole.filter(F.col("_v").isNotNull() & F.col("vec_id").isNotNull())
    ints = whole.select(F.monotonically_increasing_id().alias("_r"), "vec_id", F.transform("_v", lambda x: F.floor(x * scale).cast("long")).alias("_v"), "_q", F.size("_v").alias("_d"))
    rows = materialise(ints, "topk-rows")  # row keys stay the same from here on
    by_length = rows.groupBy(F.col("_d").alias("_length")).agg(F.count("*").alias("_n"), F.max("_q").alias("_any")).filter("_any")
    wanted = F.greatest(F.ceil(F.col("_n") * F.col("_length") * 8 / F.lit(part_bytes)), F.least(F.lit(tasks), F.ceil(F.col("_n") / F.lit(part_rows))))
    parts = materialise(by_length.select("_length", F.greatest(F.lit(1), wanted).cast("int").alias("_parts")), "topk-parts")
    dealt = rows.join(parts, F.col("_d") == F.col("_length"))
    candidates = dealt.select("_d", F.pmod(F.xxhash64("_r"), F.col("_parts")).cast("int").alias("_part"), F.lit(0).alias("_kind"), "_r", "vec_id", "_v")
    queries = dealt.filter("_q").select("_d", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"), F.lit(1).alias("_kind"), "_r", "vec_id", "_v")
    units = candidates.unionByName(queries).repartition(tasks, "_d", "_part").sortWithinPartitions("_d", "_part", "_kind", "_r")
    found = units.mapInArrow(_searcher(k), "_r long, query_id long, vec_id long, score long")
    order = Window.partitionBy("_r").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias(id_col), "score")
