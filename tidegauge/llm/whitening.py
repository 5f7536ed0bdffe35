"""Whitened embeddings by block matrices.

The distinct vectors are numbered, centred and dealt into the blocks of a Spark MLlib
``BlockMatrix``. Its product with its own transpose is the scatter matrix, of which numpy takes
the eigenvectors on the driver (its size is the vectors' length squared, whatever the number of
rows). A second product, with the small matrix of scaled eigenvectors, projects the rows.
"""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.frames import stored

#: Rows of a block; at most so many blocks, whose places the driver lists for each product.
BLOCK_ROWS = 1024
MOST_BLOCKS = 1 << 20
#: Rows of the same vector that are joined with their projection in one task.
HOT_ROWS = 20_000
#: An eigenvalue below this share of all variance is none.
NO_VARIANCE = 1e-12
#: Entries are held within these bounds, where doubles still tell whole numbers apart.
_BOUND = float(1 << 46)
_RESULT = (
    "vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, "
    "identity_error double"
)


def whiten(
    df: DataFrame,
    components: int = 16,
    scale: int = 64,
    shift: int = 1_000_000,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of each row's vector
    and each of the first ``components`` principal components.

    An entry c counts as the whole number x = floor(scale * c) + shift. Means and covariance are
    those of the ``n`` distinct vectors, however often each comes. ``deviation`` is the sum of
    (n * x - S)**2 over the dimensions with their sums S, NULL where that is beyond 64 bits;
    ``whitened`` the centred vector's projection on the unit eigenvector over the root of its
    eigenvalue; ``explained`` the eigenvalue's share of all variance; ``identity_error`` the largest
    absolute entry of the covariance of what was whitened minus the identity.

    Rows whose vector is NULL, empty or holds a NULL or an entry that is not finite are left out,
    and so are vectors of another length than most distinct ones have (of several such lengths, the
    greatest counts). Entries are held within 2**46. Rows that repeat, and NULL ids, each have
    their results; of a component without variance (as with fewer distinct vectors than
    components) ``whitened`` is NULL, and where nothing varies ``explained`` and ``identity_error``
    are NULL, too. A table without vectors gives an empty result. Only the two columns are read.
    """
    spark = df.sparkSession
    kind = df.schema[vec_id].dataType.simpleString()
    entries = F.transform(F.col(vector), lambda c: _whole(c, scale, shift))
    rows = df.where(_sound(F.col(vector))).select(F.col(vec_id).alias("vec_id"), entries.alias("x"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fit = rows.groupBy("x").agg(F.count("*").alias("copies"))
    fit = fit.withColumn("part", F.pmod(F.xxhash64("x"), F.lit(parts)))
    in_part = Window.partitionBy("part").orderBy("x")
    fit = stored(fit.withColumn("place", F.row_number().over(in_part) - 1), "fit")
    lengths = fit.groupBy(F.size("x").alias("length")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    if most is None:
        return spark.createDataFrame([], _RESULT.format(kind=kind))
    if lengths.count() > 1:
        other = fit.where(F.size("x") == most.length).withColumn("place", F.row_number().over(in_part) - 1)
        fit = stored(other, "fit")
    n, length = most.n, most.length

    per_entry = fit.select(F.posexplode("x").alias("at", "x")).groupBy("at")
    facts = per_entry.agg(
        F.sum(F.col("x").cast("decimal(38,0)")).alias("sum"), F.min("x").alias("low"), F.max("x").alias("high")
    )
    facts = sorted(facts.collect())
    sums = [int(f["sum"]) for f in facts]
    widest = max(f["high"] - f["low"] for f in facts)

    before = F.sum("rows").over(Window.orderBy("part")) - F.col("rows")
    bases = fit.groupBy("part").agg(F.count("*").alias("rows")).select("part", before.alias("base"))
    # One row for each shuffle partition.
    numbered = fit.join(F.broadcast(bases), "part")
    numbered = numbered.select((F.col("base") + F.col("place")).alias("index"), "x", "copies")
    blocks = max(block_rows, -(-n // MOST_BLOCKS))
    centred = _block_matrix(numbered, [s / n for s in sums], n, blocks)
    # Read by both products; what a lost executor held is made again.
    centred.persist(StorageLevel.MEMORY_AND_DISK)
    splits = max(1, min(parts, n // blocks))
    scatter = _product(centred.transpose(), centred, splits)
    values, vectors = np.linalg.eigh(scatter / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    # Any sign will do; the same one on every run.
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    trace = float(np.trace(scatter) / n)
    good = int((values > NO_VARIANCE * trace).sum()) if trace > 0 else 0

    known = numbered.select("x", "copies", F.lit(None).cast("array<double>").alias("whitened"))
    error = None
    if good:
        matrix = vectors[:, :good] / np.sqrt(values[:good])
        local = spark.sparkContext.parallelize([((0, 0), Matrices.dense(length, good, matrix.ravel("F").tolist()))], 1)
        projected = centred.multiply(BlockMatrix(local, length, good))
        made = stored(_rows(projected, "whitened"), "projected")
        known = numbered.join(made, "index").select("x", "copies", "whitened")
        spread = _product(projected.transpose(), projected, splits) / n
        error = float(np.abs(spread - np.eye(good)).max())
    centred._java_matrix_wrapper._java_model.blocks().unpersist(False)

    deviation = _deviation(F.col("x"), sums, n, widest)
    known = known.select("x", "copies", deviation.alias("deviation"), "whitened")
    each = _joined(rows.where(F.size("x") == length), known, n)
    shares = F.array(*(F.lit(float(v) / trace if trace > 0 else None).cast("double") for v in values))
    return each.select(
        "vec_id", "deviation", "whitened", F.posexplode(shares).alias("at", "explained")
    ).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        F.get("whitened", F.col("at")).alias("whitened"),
        "explained",
        F.lit(error).cast("double").alias("identity_error"),
    )


def _sound(vector: Column) -> Column:
    finite = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite


def _whole(entry: Column, scale: int, shift: int) -> Column:
    held = F.greatest(F.least(F.floor(entry.cast("double") * F.lit(float(scale))), F.lit(_BOUND)), F.lit(-_BOUND))
    return held.cast("bigint") + F.lit(shift)


def _block_matrix(numbered: DataFrame, means: list[float], n: int, block_rows: int) -> BlockMatrix:
    """The centred vectors as rows of a block matrix, in blocks of whole rows."""
    centred = F.zip_with("x", F.array(*map(F.lit, means)), lambda x, mean: x.cast("double") - mean)
    rows = numbered.select("index", array_to_vector(centred).alias("vector"))
    rows = MLUtils.convertVectorColumnsFromML(rows, "vector")
    return IndexedRowMatrix(rows, n, len(means)).toBlockMatrix(block_rows, len(means))


def _product(left: BlockMatrix, right: BlockMatrix, splits: int) -> np.ndarray:
    """A small product, summed up from ``splits`` parts of the long side."""
    made = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(made, left.rowsPerBlock, right.colsPerBlock).toLocalMatrix().toArray()


def _rows(matrix: BlockMatrix, name: str) -> DataFrame:
    """(index, values) of a block matrix."""
    rows = matrix.toIndexedRowMatrix()._java_matrix_wrapper._java_model
    rows = callMLlibFunc("getIndexedRows", rows)
    return rows.select("index", vector_to_array("vector").alias(name))


def _deviation(x: Column, sums: list[int], n: int, widest: int) -> Column:
    """The sum of (n * x - S)**2: in 64 bits where these surely hold it, else in decimals."""
    reach = n * max(widest, 1)
    small = len(sums) * reach * reach < 1 << 63 and n * (max(map(abs, sums)) // n + widest + 1) < 1 << 62
    number = "bigint" if small else "decimal(38,0)"
    total = F.array(*(F.lit(str(s)).cast(number) for s in sums))
    # An entry differs from its dimension's mean by less than the dimension's range.
    far = F.zip_with(x, total, lambda a, s: (a.cast(number) * F.lit(n).cast(number) - s).cast(number))
    squares = F.transform(far, lambda a: F.try_multiply(a, a).cast(number))
    added = F.aggregate(squares, F.lit(0).cast(number), lambda s, a: F.try_add(s, a).cast(number))
    return added.try_cast("bigint")


def _joined(rows: DataFrame, known: DataFrame, n: int) -> DataFrame:
    """``rows`` with what is known of their vector. Rows of a vector with very many copies are
    dealt to several keys; such vectors are few whatever the table's size."""
    total = known.agg(F.sum("copies")).first()[0] or 0
    most = max(HOT_ROWS, total >> 16)
    pieces = F.ceil(F.max("copies") / F.lit(most)).alias("pieces")
    known = known.withColumn("hash", F.xxhash64("x"))
    # Fewer than 2**16 vectors have more than a 2**16th of all rows.
    hot = F.broadcast(known.where(F.col("copies") > most).groupBy("hash").agg(pieces))
    several = F.coalesce(F.col("pieces"), F.lit(1))
    rows = rows.withColumns({"hash": F.xxhash64("x"), "row": F.xxhash64(F.monotonically_increasing_id())})
    rows = rows.join(hot, "hash", "left").withColumn("piece", F.pmod("row", several))
    known = known.join(hot, "hash", "left")
    known = known.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), several - 1)))
    return rows.join(known.drop("copies", "pieces"), ["hash", "piece", "x"])
