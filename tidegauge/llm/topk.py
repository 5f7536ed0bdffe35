"""Exact top-k search by inner product: distributed histogram selection.

Vectors become whole numbers, so scores are exact. Queries and candidates lie in blocks; every
block of queries is sent to every block of candidates, which so moves once a pass, and meets it
there, one pair of blocks at a time. Nothing is
sorted to find the best: a pass scores everything and counts, for each query, how many scores
fall into each bin of the range that may hold its k-th value; the counts of all blocks are
added, and the bin where the k-th value lies is the next pass's range, until a bin is one score
wide. Scores above the k-th value belong to the result. Of those equal to it, as many as are
missing are taken, from the smallest vec_id on, in the same way: the last passes count the ids
of the tied candidates by bins. So a vector that a third of all rows share costs no more than
any other.

Defined results: vectors that are NULL or hold a NULL or non-finite component take no part, nor
do rows with a NULL id; components and scores beyond 64 bits count as the last whole number within
(of scores 2**63 - 1, either way); an empty vector scores 0; vectors of another length than a
query's are none of its candidates; a query is no candidate of its own, rows with its id included;
rows that repeat a query's id are one query, of their least vector; rows that repeat another id are
candidates each, in no particular order; queries with fewer than k candidates get all; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.frames import stored

SCALE = 256
BINS = 64
QUERY_ROWS = 1024
CANDIDATE_ROWS = 8192
# The least number of 64 bits is no score.
_LEAST, _MOST = -(2**63), 2**63 - 1


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component; NULL if one is NULL or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


# --- A pair of blocks -----------------------------------------------------------------


def _columns(column: pa.Array, row: int) -> dict[str, np.ndarray]:
    """A block's list of structs as arrays; vectors as a matrix."""
    items = column.slice(row, 1).flatten()
    out = {}
    for name, values in zip([f.name for f in items.type], items.flatten(), strict=True):
        if pa.types.is_list(values.type):
            flat = values.flatten().to_numpy(zero_copy_only=False)
            out[name] = flat.reshape(len(items), -1) if len(items) else flat.reshape(0, 0)
        else:
            out[name] = values.to_numpy(zero_copy_only=False)
    return out


def _scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where they hold every sum, else in 64-bit integers, and in
    Python's where a sum may lie beyond these."""
    if not queries.shape[1]:
        return np.zeros((len(queries), len(candidates)), np.int64)
    left, right = queries.astype(float), candidates.T.astype(float)
    size = np.abs(left) @ np.abs(right)
    if size.max(initial=0) < 2.0**53:
        return (left @ right).astype(np.int64)
    # Sums that go round keep their last 64 bits, so those that lie within come out right.
    with np.errstate(over="ignore"):
        exact = queries @ candidates.T
    near = np.abs(left @ right) + size * 2.0**-40 >= 2.0**63
    for row, column in zip(*np.nonzero(near)):
        whole = sum(a * b for a, b in zip(queries[row].tolist(), candidates[column].tolist()))
        exact[row, column] = max(-_MOST, min(_MOST, whole))
    return exact


def _pairs(batches: Iterator[pa.RecordBatch]):
    """Blocks of queries with the block of candidates that comes before them."""
    c = None
    for batch in batches:
        queries, candidates = (batch.column(batch.schema.get_field_index(x)) for x in ("queries", "candidates"))
        for row in range(batch.num_rows):
            if candidates[row].is_valid:
                c = _columns(candidates, row)
                continue
            q = _columns(queries, row)
            scores = _scores(q["vector"], c["vector"])
            yield q, c, scores, c["id"] != q["id"][:, None]


def _far(values: np.ndarray, low: np.ndarray) -> np.ndarray:
    """``values - low`` where that is not negative, as an unsigned number: it may take 64 bits."""
    return values.astype(np.uint64) - low.astype(np.uint64)


def _counted(q: dict, row: np.ndarray, bins: np.ndarray) -> pa.RecordBatch:
    found, n = np.unique(np.stack((row, bins.astype(np.int64))), axis=1, return_counts=True)
    columns = [pa.array(q["id"][found[0]], pa.int64()), pa.array(found[1], pa.int64()), pa.array(n, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["id", "bin", "n"])


def _first(mask: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first ``counts`` true places of each row."""
    return mask & (np.cumsum(mask, axis=1) <= counts[:, None])


def _score_bins(bins: int):
    """Scores in a query's range by bin, from the top. A block's own best are enough: the value
    looked for is no less than that of any one block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for q, _, scores, other in _pairs(batches):
            inside = other & (scores >= q["low"][:, None]) & (scores <= q["high"][:, None])
            wanted = q["need"] + 1
            most = min(int(wanted.max()), scores.shape[1])
            values = np.where(inside, scores, _LEAST)
            best = np.partition(values, scores.shape[1] - most, axis=1)[:, scores.shape[1] - most :]
            best = np.sort(best, axis=1)[:, ::-1]
            kept = (best != _LEAST) & (np.arange(most) < wanted[:, None])
            row, column = np.nonzero(kept)
            width = _width(q["low"], q["high"], bins)
            yield _counted(q, row, _far(best[row, column], q["low"][row]) // width[row])

    return run


def _id_bins(bins: int):
    """Ids of the candidates that tie at a query's k-th value, by bin, from the smallest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for q, c, scores, other in _pairs(batches):
            tied = other & (scores == q["low"][:, None])
            tied &= (c["id"] >= q["id_low"][:, None]) & (c["id"] <= q["id_high"][:, None])
            row, column = np.nonzero(_first(tied, q["need"] + 1))
            width = _width(q["id_low"], q["id_high"], bins)
            yield _counted(q, row, _far(c["id"][column], q["id_low"][row]) // width[row])

    return run


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for q, c, scores, other in _pairs(batches):
        tied = other & (scores == q["low"][:, None]) & (c["id"] <= q["id_high"][:, None])
        row, column = np.nonzero(other & (scores > q["low"][:, None]) | _first(tied, q["k"]))
        arrays = [pa.array(x, pa.int64()) for x in (q["id"][row], c["id"][column], scores[row, column])]
        yield pa.RecordBatch.from_arrays(arrays, ["query_id", "vec_id", "score"])


def _width(low: np.ndarray, high: np.ndarray, bins: int) -> np.ndarray:
    return _far(high, low) // np.uint64(bins) + np.uint64(1)


# --- On Spark -------------------------------------------------------------------------


def top_k(
    df: DataFrame,
    k: int = 5,
    every: int = 50,
    scale: int = SCALE,
    bins: int = BINS,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    query_rows: int = QUERY_ROWS,
    candidate_rows: int = CANDIDATE_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every``, the k
    other rows with the highest inner products, ties to the smaller id.

    Rows that repeat a query's id ask once, with the least of their vectors (by the first entry that
    differs); as candidates each of them counts, but not for a query of their own id."""
    rows = df.select(F.col(vec_id).cast("bigint").alias("id"), quantised(F.col(vector), scale).alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull())
    rows = stored(rows.withColumn("part", F.monotonically_increasing_id()), "vectors")
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    facts = rows.agg(F.count("*"), F.max(F.sqrt(squares)), F.min("id"), F.max("id")).first()
    blocks = -(-facts[0] // candidate_rows) or 1
    asked = rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min("vector").alias("vector"))
    asked = stored(asked.withColumn("dim", F.size("vector")), "queries")
    query_blocks = -(-asked.count() // query_rows) or 1

    part = F.pmod(F.xxhash64("part"), F.lit(blocks)).alias("block")
    item = F.struct("id", "vector").alias("item")
    packed = rows.select(F.size("vector").alias("dim"), part, item).groupBy("dim", "block")
    candidates = stored(packed.agg(F.sort_array(F.collect_list("item")).alias("candidates")), "candidates")

    # The range of a query's scores is known from the lengths of the vectors, but for rounding.
    reach = F.sqrt(squares) * (facts[1] or 0.0) * (1 + 1e-9) + 1
    bound = F.when(reach < 9e18, F.ceil(F.least(reach, F.lit(9e18)))).otherwise(F.lit(_MOST))
    state = asked.select("id", (-bound).alias("low"), bound.alias("high"), F.lit(k).cast("bigint").alias("need"))
    state = stored(state.withColumn("ties", F.lit(0).cast("bigint")), "state")

    def met(state: DataFrame) -> DataFrame:
        """Each block of candidates, and after it every block of queries with what is known of
        them. Of the two, the queries are few, so they are copied."""
        own = F.pmod(F.xxhash64("id"), F.lit(query_blocks)).alias("query_block")
        known = asked.join(state, "id").withColumn("k", F.lit(k).cast("bigint"))
        fields = F.struct(*(c for c in known.columns if c != "dim"))
        grouped = known.select("dim", own, fields.alias("item")).groupBy("dim", "query_block")
        queries = grouped.agg(F.collect_list("item").alias("queries")).drop("query_block")
        theirs = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
        # Vectors of a length that no query has are not needed.
        lengths = queries.select("dim").distinct()
        both = candidates.join(F.broadcast(lengths), "dim", "left_semi").unionByName(
            queries.select("dim", theirs, "queries").join(candidates.select("dim", "block"), ["dim", "block"], "left_semi"),
            allowMissingColumns=True,
        )
        parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), blocks)
        both = both.withColumn("asks", F.col("candidates").isNull())
        return both.repartition(parts, "dim", "block").sortWithinPartitions("dim", "block", "asks").select("queries", "candidates")

    counted = "id bigint, bin bigint, n bigint"
    while state.where("low < high").limit(1).count():
        found = met(state).mapInArrow(_score_bins(bins), counted)
        state = stored(_narrowed(state, found, "low", "high", bins, from_top=True), "state")
    state = state.withColumns({"id_low": F.lit(facts[2] or 0), "id_high": F.lit(facts[3] or 0)})
    clear, tied = state.where(F.col("ties") <= F.col("need")), state.where(F.col("ties") > F.col("need"))
    tied = stored(tied, "tied")
    while tied.where("id_low < id_high").limit(1).count():
        found = met(tied.drop("ties")).mapInArrow(_id_bins(bins), counted)
        tied = stored(_narrowed(tied, found, "id_low", "id_high", bins, from_top=False), "tied")
    final = stored(clear.unionByName(tied).drop("ties"), "state")
    best = stored(met(final).mapInArrow(_chosen, "query_id bigint, vec_id bigint, score bigint"), "best")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _narrowed(state: DataFrame, found: DataFrame, low: str, high: str, bins: int, from_top: bool) -> DataFrame:
    """The state with each query's range cut down to the bin that holds the value looked for,
    and how many are still needed from that bin. Queries that found nothing leave."""
    summed = found.groupBy("id", "bin").agg(F.sum("n").alias("n"))
    order = F.desc("bin") if from_top else F.asc("bin")
    # At most ``bins`` rows of a query.
    reach = F.sum("n").over(Window.partitionBy("id").orderBy(order))
    full = summed.withColumn("reach", reach).join(state.drop("ties"), "id")
    # The first bin that reaches what is needed, or the last if none does.
    enough = F.when(F.col("reach") >= F.col("need"), F.col("reach"))
    place = F.struct(F.coalesce(enough, F.lit(_MOST) - F.col("reach")).alias("key"), "bin", "n", "reach")
    picked = full.groupBy("id").agg(F.min(place).alias("at"))
    # A range may take more than 64 bits.
    wide = {name: F.col(name).cast("decimal(21,0)") for name in (low, high)}
    width = (F.floor((wide[high] - wide[low]) / F.lit(bins)) + 1).cast("decimal(21,0)")
    start = (wide[low] + F.col("at.bin").cast("decimal(4,0)") * width).cast("decimal(21,0)")
    end = F.least(wide[high], (start + width - 1).cast("decimal(21,0)"))
    fresh = {low: start.cast("bigint"), high: end.cast("bigint")}
    kept = [c for c in state.columns if c not in {"id", low, high, "need", "ties"}]
    return state.drop("ties").join(picked, "id").select(
        "id",
        *(c.alias(name) for name, c in fresh.items()),
        (F.col("need") - (F.col("at.reach") - F.col("at.n"))).alias("need"),
        F.col("at.n").alias("ties"),
        *kept,
    )


def top_k_sql(k: int = 5, every: int = 50, scale: int = SCALE) -> str:
    """The same in DuckDB's SQL over ``embeddings``."""
    bad = "len([x for x in embedding if x is null or not isfinite(x)]) = 0"
    return f"""with e as (select vec_id, [floor({scale} * cast(x as double)) for x in embedding] as v
    from embeddings where vec_id is not null and embedding is not null and {bad}),
s as (select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
    from e q join e c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % {every} = 0)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank,
    vec_id, score from s qualify row_number() over (partition by query_id order by score desc, vec_id) <= {k}"""
