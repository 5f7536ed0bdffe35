"""Near-duplicate documents by BagMinHash over multisets of word shingles.

A document is the multiset of its shingles. For each shingle, a Poisson process runs over
time and over its multiplicity, which is discretised to whole numbers and held as a dyadic
tree: the interval from 0 to 1, then 1 to 2, 2 to 4 and so on. A node's process has a rate in
proportion to its width, each point has a place in it, and a document has the points up to its
own multiplicity. Points fall into the signature's slots at random, and a slot keeps its
earliest point. Two documents agree in a slot with a probability equal to their weighted
Jaccard similarity. Only the points up to a time that fills all slots are made, so that a
signature costs about the same for short and long texts.

Slots are banded. Documents that share a band get a longer signature of which one bit of each
slot is kept, and are compared through leaders: first with the one that meets the most others,
then, where a band still holds several components, with some LEADERS of its members, and last
with each other, but only across components. In a band of more than DIRECT texts these last
pairs are found by their rare shingles instead, since texts of one template, say, share a band
without being alike: two texts at the threshold have one of their rarest shingles in common, at
places that leave enough shingles after them, whatever the rest. That loses no pair. So no link
between components is lost to a cap,
and near copies of one text are not expanded into all pairs. A pair is compared only if its
sizes and bits allow a similarity of ``threshold`` (a pair that has it is missed once in 30,000
times), at the first band it shares; it is a link if the exact similarity of the multisets is
at least ``threshold``. Exact copies are one document from the start.

Words are runs of letters and digits without regard to case (ASCII and Latin-1); every
character beyond ASCII counts as a letter.

Defined results: a text with fewer words than a shingle is one shingle of all its words; NULL
and texts without words have no shingles and are like no other document, but exact copies of
each other form one class only if they have words; rows that repeat a doc_id are documents of
their own; a NULL doc_id is the least; an empty table gives an empty table; columns of the
input stay, and a column that has the name of a result is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import bytesops
from tidegauge.llm.bytesops import U64
from tidegauge.llm.components import connected
from tidegauge.llm.frames import free_name, lean, parts_for, stored, text_bytes_total

SIZE = 5
THRESHOLD = 0.8
BANDS, BAND_ROWS = 16, 4
#: Bytes of texts that get long signatures in a task.
MARKED_BYTES = 4 << 20
MARKS = 1024
LEADERS = 32
#: Texts of a band that are compared with each other as they are.
DIRECT = 128
#: Shingles are told from rarer ones by how many texts have one of the same bucket.
BUCKETS = 1 << 20
BROADCAST_NODES = 1_000_000
_SLICE = 1 << 20
_LEAST = -(2**63)
_STEP = U64(0x9E3779B97F4A7C15)


def _shingled(data: np.ndarray, offsets: np.ndarray, size: int):
    """Distinct shingles, their rows and counts, and the number of rows."""
    low = bytesops.lower(data)
    spans = bytesops.words(low, offsets)
    hashes = bytesops.Rolling(low).ranges(spans.starts, spans.ends)
    made, rows, _ = bytesops.shingles(hashes, spans, size)
    return bytesops.counted(made, rows)


def signatures(hashes: np.ndarray, rows: np.ndarray, counts: np.ndarray, total: int, slots: int) -> np.ndarray:
    """The earliest time in each slot, a row of slots for each document; infinite without
    shingles. ``hashes`` are distinct within a row, and ``rows`` ascend."""
    weights = np.bincount(rows, counts, total)
    out = np.full((total, slots), np.inf)
    # By this time all slots are filled for 95 of 100 documents; for the others it is doubled.
    limit = (math.log(slots) + 3.0) / np.maximum(weights, 1)
    undone = weights > 0
    while undone.any():
        chosen = undone[rows]
        own, row, count = hashes[chosen], rows[chosen], counts[chosen]
        level = 0
        while len(own):
            start, width = (0, 1) if level == 0 else (1 << (level - 1), 1 << (level - 1))
            below = count > start
            own, row, count = own[below], row[below], count[below]
            _points(out, own, row, count, start, width, level, limit, slots)
            level += 1
        undone &= ~(out <= limit[:, None]).all(axis=1)
        out[undone] = np.inf
        limit = np.where(undone, limit * 2, limit)
    return out


def _points(out, own, row, count, start, width, level, limit, slots) -> None:
    """Put the points of one interval of the multiplicity into the slots."""
    node = bytesops.seeded(own, 3 * level)
    time = np.zeros(len(own))
    step = 0
    while len(node):
        gap = bytesops.seeded(node, 2 * step + 1)
        # Each slot gets points at the rate ``width``, all slots together at ``slots`` times that.
        time = time - np.log(bytesops.unit(gap)) / (slots * width)
        inside = time <= limit[row]
        node, row, count, time, gap = node[inside], row[inside], count[inside], time[inside], gap[inside]
        where = bytesops.seeded(gap, 2)
        level_at = start + (bytesops.unit(bytesops.seeded(gap, 4)) * width).astype(np.int64)
        held = np.minimum(level_at, start + width - 1) < count
        slot = (where % U64(slots)).astype(np.int64)
        np.minimum.at(out.ravel(), row[held] * slots + slot[held], time[held])
        step += 1


def similarities(left, right, size: int) -> np.ndarray:
    """The weighted Jaccard similarity of each row's two texts (as bytes and offsets)."""
    total = len(left[1]) - 1
    sides = [_shingled(*side, size) for side in (left, right)]
    sums = [np.bincount(r, c, total) for _, r, c in sides]
    hashes = np.concatenate([s[0] for s in sides])
    rows = np.concatenate([s[1] for s in sides])
    counts = np.concatenate([s[2] for s in sides])
    order = np.lexsort((hashes, rows))
    hashes, rows, counts = hashes[order], rows[order], counts[order]
    same = np.nonzero((hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1]))[0]
    shared = np.bincount(rows[same], np.minimum(counts[same], counts[same + 1]), total)
    united = sums[0] + sums[1] - shared
    return np.divide(shared, united, out=np.zeros(total), where=united > 0)


# --- On Spark ----------------------------------------------------------------------


def _signed(size: int):
    """Sizes and bands of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytesops.text_bytes(batch.column(3))
            for low, high in bytesops.slices(offsets, _SLICE):
                own = offsets[low : high + 1]
                hashes, rows, counts = _shingled(data[own[0] : own[-1]], own - own[0], size)
                weights = np.bincount(rows, counts, high - low).astype(np.int64)
                times = signatures(hashes, rows, counts, high - low, BANDS * BAND_ROWS)
                slots = bytesops.mix(times.view(U64))
                bands = np.zeros((high - low, BANDS), U64)
                for k in range(BAND_ROWS):
                    bands = bytesops.mix(bands + slots[:, k::BAND_ROWS])
                bands = bytesops.mix(bands + np.arange(BANDS, dtype=U64))
                part = batch.slice(low, high - low)
                columns = [part.column(0), part.column(1), part.column(2), pa.array(weights), _rows_of(bands)]
                yield pa.RecordBatch.from_arrays(columns, ["node", "number", "digest", "weight", "bands"])

    return run


def _marked(size: int):
    """One bit of each slot of a long signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytesops.text_bytes(batch.column(1))
            for low, high in bytesops.slices(offsets, _SLICE, 1000):
                own = offsets[low : high + 1]
                hashes, rows, counts = _shingled(data[own[0] : own[-1]], own - own[0], size)
                slots = bytesops.mix(signatures(hashes, rows, counts, high - low, MARKS).view(U64))
                bits = (slots >> U64(63)).reshape(high - low, -1, 64) << np.arange(64, dtype=U64)
                columns = [batch.column(0).slice(low, high - low), _rows_of(bits.sum(axis=2, dtype=U64))]
                yield pa.RecordBatch.from_arrays(columns, ["node", "marks"])

    return run


def _rows_of(matrix: np.ndarray) -> pa.Array:
    first = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(first, np.ascontiguousarray(matrix).view(np.int64).ravel())


def _differing(left: str, right: str) -> Column:
    """In how many marks two documents differ."""
    total = F.lit(0)
    for k in range(MARKS // 64):
        total = total + F.bit_count(F.get(left, F.lit(k)).bitwiseXOR(F.get(right, F.lit(k))))
    return total


def _first_shared(left: str, right: str) -> Column:
    """The number of the first band that two documents share."""
    same = (F.when(F.get(left, F.lit(k)) == F.get(right, F.lit(k)), F.lit(k)) for k in range(BANDS))
    return F.coalesce(*same)


def _verified(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = bytesops.text_bytes(batch.column(2)), bytesops.text_bytes(batch.column(3))
            for low, high in bytesops.slices(left[1] + right[1], _SLICE):
                cut = [(d[o[low] : o[high]], o[low : high + 1] - o[low]) for d, o in (left, right)]
                part = batch.slice(low, high - low)
                columns = [part.column(0), part.column(1), pa.array(similarities(*cut, size))]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b", "similarity"])

    return run


def _tokens(data: np.ndarray, offsets: np.ndarray, size: int):
    """The multisets' members, a further copy of a shingle being another one, and their rows."""
    hashes, rows, counts = _shingled(data, offsets, size)
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return bytesops.mix(np.repeat(hashes, counts) + nth.astype(U64) * _STEP), np.repeat(rows, counts)


def _frequencies(size: int):
    """How many texts of a task have a member in each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            data, offsets = bytesops.text_bytes(batch.column(1))
            for low, high in bytesops.slices(offsets, _SLICE):
                own = offsets[low : high + 1]
                made, _ = _tokens(data[own[0] : own[-1]], own - own[0], size)
                np.add.at(total, (made % U64(BUCKETS)).astype(np.int64), 1)
        held = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    return run


def _rarest(size: int, threshold: float, common: np.ndarray):
    """The rarest members of each text: so many that a text at the threshold has one of them, and
    whether that holds for a text of the same weight or more (``first``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytesops.text_bytes(batch.column(1))
            for low, high in bytesops.slices(offsets, _SLICE):
                own = offsets[low : high + 1]
                made, rows = _tokens(data[own[0] : own[-1]], own - own[0], size)
                order = np.lexsort((made, common[(made % U64(BUCKETS)).astype(np.int64)], rows))
                made, rows = made[order], rows[order]
                weight = np.bincount(rows, minlength=high - low)
                place = np.arange(len(rows)) - (np.cumsum(weight) - weight)[rows]
                weight = weight[rows]
                # Rounding may only add members.
                taken = np.nonzero(place <= weight - np.ceil(threshold * weight - 1e-6))[0]
                made, rows, place, weight = made[taken], rows[taken], place[taken], weight[taken]
                first = place <= weight - np.ceil(2 * threshold / (1 + threshold) * weight - 1e-6)
                node = batch.column(0).slice(low, high - low).take(pa.array(rows))
                columns = [node, pa.array(made.view(np.int64)), pa.array(place), pa.array(weight), pa.array(first)]
                yield pa.RecordBatch.from_arrays(columns, ["node", "token", "place", "weight", "first"])

    return run


def _by_rare_shingles(texts: DataFrame, nodes: DataFrame, size: int, threshold: float) -> DataFrame:
    """(a, b) of ``nodes`` (node, root) with different roots, at least all those whose similarity is
    at least ``threshold``. The frequencies are at most ``BUCKETS`` numbers."""
    own = texts.join(nodes.select("node"), "node", "left_semi")
    found = own.mapInArrow(lean(_frequencies(size)), "bucket bigint, n bigint")
    found = found.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    common = np.zeros(BUCKETS, np.int64)
    common[found["bucket"].to_numpy()] = found["n"].to_numpy()
    schema = "node bigint, token bigint, place bigint, weight bigint, first boolean"
    rare = own.mapInArrow(lean(_rarest(size, threshold, common)), schema).join(nodes, "node")
    names = ("node", "place", "weight", "root")
    left = rare.where("first").select("token", *(F.col(c).alias(f"a{c}") for c in names))
    right = rare.select("token", *(F.col(c).alias(f"b{c}") for c in names))
    # The lighter text is on the left. From a first common member on, enough must be left.
    ordered = F.struct("aweight", "anode") < F.struct("bweight", "bnode")
    near = F.col("aweight") >= threshold * F.col("bweight")
    rest = F.least(F.col("aweight") - F.col("aplace"), F.col("bweight") - F.col("bplace"))
    enough = rest + 1e-6 >= threshold / (1 + threshold) * (F.col("aweight") + F.col("bweight"))
    met = left.join(right, "token").where((F.col("aroot") != F.col("broot")) & ordered & near & enough)
    return met.select(F.least("anode", "bnode").alias("a"), F.greatest("anode", "bnode").alias("b")).distinct()


def near_duplicates(
    df: DataFrame,
    size: int = SIZE,
    threshold: float = THRESHOLD,
    doc_id: str = "doc_id",
    text: str = "text",
    names: Sequence[str] = ("class_id", "class_size", "is_first"),
) -> DataFrame:
    """``df`` with the least doc_id of a document's class of linked documents, the class's
    number of documents, and whether it is the class's first (one with that doc_id)."""
    node = free_name([*df.columns, *names], "node")
    # A copy whose rows have numbers of their own: ids may repeat, and copies are told apart.
    rows = stored(df.withColumn(node, F.monotonically_increasing_id()), "rows")
    number = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_LEAST))
    given = rows.select(
        F.col(node).alias("node"), number.alias("number"), F.md5(F.col(text).cast("binary")).alias("digest"), F.col(text).alias("text")
    )
    schema = "node bigint, number bigint, digest string, weight bigint, bands array<bigint>"
    signed = stored(given.mapInArrow(lean(_signed(size)), schema), "signatures")
    worded = signed.where("weight > 0")
    copies = worded.groupBy("digest").agg(F.min("node").alias("rep"))
    reps = worded.join(copies.select(F.col("rep").alias("node")), "node", "left_semi")
    roots = _linked(rows, node, text, reps, size, threshold)

    classed = signed.join(copies, "digest", "left").select("node", "number", F.coalesce("rep", "node").alias("rep"))
    classed = classed.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        "node", "number", F.coalesce("root", "rep").alias("root")
    )
    classed = stored(classed, "classed")
    first = classed.groupBy("root").agg(F.min(F.struct("number", "node")).alias("first"), F.count("*").alias("class_size"))
    result = classed.join(first, "root").select(
        F.col("node").alias(node),
        F.nullif(F.col("first.number"), F.lit(_LEAST)).alias(names[0]),
        F.col("class_size").alias(names[1]),
        (F.col("first.node") == F.col("node")).alias(names[2]),
    )
    kept = [c for c in df.columns if c.lower() not in {x.lower() for x in names}]
    return rows.select(node, *kept).join(result, node).drop(node)


def _linked(rows: DataFrame, node: str, text: str, reps: DataFrame, size: int, threshold: float) -> DataFrame:
    """(node, root) of the distinct texts that have a link."""
    # A pair at the threshold differs in more of the kept marks with a probability of 3e-5.
    chance = (1 - threshold) / 2
    apart = int(MARKS * chance + 4 * math.sqrt(MARKS * chance * (1 - chance)))
    banded = reps.select("node", F.posexplode("bands").alias("nth", "band"))
    # Counts first: only bands with several texts go on.
    bands = banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(banded.join(bands, "band"), "bands")
    # Documents that share bands with many lead: others are likest to them.
    wanted = stored(members.groupBy("node").agg(F.sum("n").alias("met")), "wanted")
    few = wanted.count() <= BROADCAST_NODES
    chosen = F.broadcast(wanted.select("node")) if few else wanted.select("node")
    texts = rows.select(F.col(node).alias("node"), F.col(text).alias("text"))
    texts = stored(texts.join(chosen, "node", "left_semi"), "texts")
    # Long signatures take their time: small tasks, by bytes.
    tasks = parts_for(text_bytes_total(texts), MARKED_BYTES, rows.sparkSession)
    marked = texts.repartition(tasks, "node").mapInArrow(lean(_marked(size)), "node bigint, marks array<bigint>")
    marks = reps.select("node", "weight", "bands").join(wanted, "node").join(marked, "node")
    marks = stored(marks, "marks")
    members = members.join(marks.select("node", "met"), "node")

    def alike(left: str, right: str) -> Column:
        ratio = F.least(f"{left}weight", f"{right}weight") >= threshold * F.greatest(f"{left}weight", f"{right}weight")
        return ratio & (_differing(f"{left}marks", f"{right}marks") <= apart)

    def sides(*columns: str) -> list[DataFrame]:
        return [marks.select(F.col("node").alias(x), *(F.col(c).alias(x + c) for c in columns)) for x in "ab"]

    def checked(pairs: DataFrame) -> DataFrame:
        left, right = (texts.select(F.col("node").alias(x), F.col("text").alias(f"t{x}")) for x in "ab")
        full = pairs.join(right, "b").join(left, "a").select("a", "b", "ta", "tb")
        return stored(full.mapInArrow(lean(_verified(size)), "a bigint, b bigint, similarity double"), "similarities")

    leaders = members.groupBy("band").agg(F.max(F.struct("met", "node"))["node"].alias("leader"))
    pairs = members.join(leaders, "band").where("node != leader")
    pairs = pairs.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    left, right = sides("weight", "marks")
    done = stored(pairs.join(left, "a").join(right, "b").where(alike("a", "b")).select("a", "b"), "pairs")
    roots = connected(checked(done).where(F.col("similarity") >= threshold))
    for share in (LEADERS, None):
        placed = members.join(roots, "node", "left").select("band", "nth", "n", "met", "node", F.coalesce("root", "node").alias("root"))
        several = placed.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
        still = placed.join(several.select("band"), "band", "left_semi")
        still = stored(still.join(marks.select("node", "weight", "marks", "bands"), "node"), "open")
        leads = still
        if share is not None:
            # The documents that meet the most others, by a bound on their share of the band.
            rank = (F.xxhash64("node") / 2.0**64) + 0.5
            leads = still.where(rank * F.col("n") < share)
        else:
            leads = still.where(F.col("n") <= DIRECT)
        left, right = (
            frame.select("band", *(F.col(c).alias(x + c) for c in ("nth", "node", "root", "weight", "marks", "bands")))
            for x, frame in (("a", leads), ("b", still))
        )
        met = (F.col("aroot") != F.col("broot")) & (left["band"] == right["band"])
        if share is None:
            met &= F.col("anode") < F.col("bnode")
        met = left.join(right, met & alike("a", "b") & (_first_shared("abands", "bbands") == F.col("anth")))
        pairs = met.select(F.least("anode", "bnode").alias("a"), F.greatest("anode", "bnode").alias("b")).distinct()
        if share is None:
            crowded = stored(still.where(F.col("n") > DIRECT).select("node", "root").distinct(), "crowded")
            if not crowded.isEmpty():
                rare = _by_rare_shingles(texts, crowded, size, threshold)
                left, right = sides("weight", "marks")
                rare = rare.join(left, "a").join(right, "b").where(alike("a", "b")).select("a", "b")
                pairs = pairs.unionByName(rare).distinct()
        pairs = stored(pairs.join(done, ["a", "b"], "left_anti"), "pairs")
        done = done.unionByName(pairs)
        links = checked(pairs).where(F.col("similarity") >= threshold)
        roots = _merged(roots, links)
    return roots


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` after new links between their components or to nodes without one."""
    ends = links
    for x in "ab":
        own = roots.select(F.col("node").alias(x), F.col("root").alias(f"r{x}"))
        ends = ends.join(own, x, "left").withColumn(f"r{x}", F.coalesce(f"r{x}", x))
    ends = ends.select(F.col("ra").alias("a"), F.col("rb").alias("b")).where("a != b")
    joined = connected(ends)
    above = joined.select(F.col("node").alias("root"), F.col("root").alias("above"))
    fresh = joined.select("node", F.col("node").alias("root")).join(roots.select("node"), "node", "left_anti")
    both = roots.unionByName(fresh).join(above, "root", "left")
    return stored(both.select("node", F.coalesce("above", "root").alias("root")), "roots")
