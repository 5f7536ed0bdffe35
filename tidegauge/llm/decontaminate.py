"""Benchmark passages in a corpus, found by spaced seeds, with DataFrame functions only.

A seed is a hash of some of the tokens in a short stretch: a mask says which count (``1``) and
which may be anything. The seeds of all masks at all places of the benchmark's items are joined
with those of the documents. Around each hit, the item and the document are laid along each
other, and the tokens of all windows of ``window`` places of the item that hold the hit's first
token are compared one by one; the hit is verified if a share of ``share`` or more of a window's
are equal, and has the equal tokens of its best one. So substituted tokens do no harm, neither at
a seed's open places nor elsewhere in the window, and a quoted part of a longer item is found
wherever its seeds hit. Each way of substituting 4 of 20 tokens leaves a seed.

Tokens are runs of letters and digits of any script, in lower case, and are compared by 64-bit
hashes.

Defined results: NULL and texts without tokens have no seeds; items with fewer tokens than the
shortest mask are never found, and in items shorter than the window all tokens are compared;
texts are searched whole; rows that repeat a doc_id or an item_id count as one document or
item; NULL ids are ids like others; empty tables give an empty table; other columns are not
read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.frames import stored

# The masks. Each compares four tokens and leaves one to three open.
MASKS = ("11011", "101101", "1100011")
WINDOW = 20
SHARE = 0.8
BROADCAST_BYTES = 64 << 20


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _hashed(text: Column) -> Column:
    """The tokens as 64-bit hashes: what is cut out around a hit stays small, however long a token,
    and the hits of one long document are held in memory together."""
    return F.transform(tokens(text), lambda token: F.xxhash64(token))


def _seeds(words: Column, place: Column, masks: tuple[str, ...]) -> Column:
    """The seeds of all masks at a place, NULL where a mask goes beyond the end."""
    made = []
    for number, mask in enumerate(masks):
        compared = [F.get(words, place + k) for k, bit in enumerate(mask) if bit == "1"]
        fits = place + len(mask) <= F.size(words)
        made.append(F.when(fits, F.xxhash64(F.lit(number), *compared)))
    return F.array(*made)


def _seeded(df: DataFrame, masks: tuple[str, ...], id_name: str, words: str, place: str) -> DataFrame:
    """A row for each place and mask; the outer form keeps the words from being made twice."""
    placed = df.select(id_name, words, F.posexplode_outer(words).alias(place, "_word"))
    made = placed.select(id_name, words, place, F.explode(_seeds(F.col(words), F.col(place), masks)).alias("seed"))
    return made.where(F.col("seed").isNotNull())


def _verified(hits: DataFrame, window: int, share: float) -> DataFrame:
    """Hits (doc_id, words, pos, item_id, item_words, item_pos) with the number of equal tokens
    in the best window that holds a hit's first token, and whether it suffices.

    The stretches that the windows lie in are cut out first, and moved to where the item's hits in
    the document are counted: the loop over all seeds holds no comparison, and nothing after it a
    whole text.
    """
    length = F.size("item_words")
    first = F.greatest(F.lit(0), F.col("item_pos") - (window - 1))
    stop = F.least(length, F.col("item_pos") + window)
    there = first + F.col("pos") - F.col("item_pos")
    missing = F.greatest(F.lit(0), -there)
    cut = hits.select(
        "doc_id",
        "item_id",
        F.least(F.lit(window), length).alias("width"),
        F.slice("item_words", first + missing + 1, stop - first - missing).alias("theirs"),
        F.slice("words", there + missing + 1, stop - first - missing).alias("ours"),
    )
    cut = cut.repartition("doc_id", "item_id")

    def equal(k: Column) -> Column:
        return F.coalesce(F.get("theirs", k) == F.get("ours", k), F.lit(False)).cast("int")

    def step(state: Column, k: Column) -> Column:
        leaves = F.when(k >= F.col("width"), equal(k - F.col("width"))).otherwise(F.lit(0))
        now = state["now"] + equal(k) - leaves
        return F.struct(now.alias("now"), F.greatest(state["most"], now).alias("most"))

    # A running sum. Sums of fewer places at the ends never exceed those of the whole windows.
    none = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    most = F.aggregate(F.sequence(F.lit(0), F.size("theirs") - 1), none, step, lambda state: state["most"])
    enough = F.col("n_equal") >= F.ceil(F.lit(share) * F.col("width"))
    return cut.withColumn("n_equal", most).select("doc_id", "item_id", "n_equal", enough.alias("enough"))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    masks: tuple[str, ...] = MASKS,
    window: int = WINDOW,
    share: float = SHARE,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(doc_id, item_id, n_hits, n_equal): each item found in each document, the verified hits,
    and the most equal tokens in a hit's window.

    The benchmark's seeds are broadcast if they measure at most ``broadcast_bytes``; the
    documents' seeds are then never shuffled. Else both tables are stored with a number for each
    row, seeds are shuffled without their texts, and the rows with a hit are joined again by
    number to verify. The result is the same.
    """
    if any(m.count("1") < 1 or m[0] != "1" or m[-1] != "1" for m in masks):
        raise ValueError("a mask must begin and end with a token that counts")
    words = docs.select(F.col(doc_id).alias("doc_id"), _hashed(F.col(text)).alias("words"))
    items = benchmark.select(F.col(item_id).alias("item_id"), _hashed(F.col(item_text)).alias("item_words")).distinct()
    theirs = _seeded(items, masks, "item_id", "item_words", "item_pos")
    ours = _seeded(words, masks, "doc_id", "words", "pos")
    # A seed of an item is broadcast with the item's tokens: 8 bytes a token, and the row.
    size = F.sum(F.size("item_words") * len(masks) * (F.size("item_words") * 8 + 64).cast("bigint"))
    if (items.agg(size).first()[0] or 0) <= broadcast_bytes:
        hits = ours.join(F.broadcast(theirs), "seed")
    else:
        # Ids may repeat or be NULL, so rows are found again by numbers that are stored with them.
        numbered = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
        numbered = stored(numbered.withColumn("doc", F.monotonically_increasing_id()), "passages-docs")
        words = numbered.select("doc", "doc_id", _hashed(F.col("text")).alias("words"))
        items = stored(items.withColumn("item", F.monotonically_increasing_id()), "passages-items")
        ours = _seeded(words.drop("doc_id"), masks, "doc", "words", "pos").select("doc", "pos", "seed")
        theirs = _seeded(items.drop("item_id"), masks, "item", "item_words", "item_pos")
        hits = ours.join(theirs.select("item", "item_pos", "seed"), "seed").drop("seed")
        hits = hits.join(words, "doc").join(items, "item")
    found = _verified(hits, window, share)
    # Dropping hits before they are counted would pull the comparison into the loop over seeds.
    counted = found.groupBy("doc_id", "item_id").agg(
        F.count_if("enough").alias("n_hits"), F.max("n_equal").alias("n_equal")
    )
    return counted.where("n_hits > 0")


def _words_sql(text: str) -> str:
    return f"[x for x in regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+') if x <> '']"


def contaminated_sql(masks: tuple[str, ...] = MASKS, window: int = WINDOW, share: float = SHARE) -> str:
    """The same in DuckDB's SQL over ``documents`` and ``benchmark``."""
    sides = {"d": ("documents", "doc_id"), "b": ("benchmark", "item_id")}
    parts = []
    for name, (table, key) in sides.items():
        once = "distinct" if table == "benchmark" else ""
        parts.append(f"{name} as (select {once} {key}, {_words_sql('text')} as w from {table})")
        seeds = " union all ".join(
            f"select {key}, w, i, {n} as mask, [{', '.join(f'w[i + {k}]' for k, c in enumerate(m, 1) if c == '1')}] as seed "
            f"from (select {key}, w, unnest(range(0, len(w) - {len(m) - 1})) as i from {name})"
            for n, m in enumerate(masks)
        )
        parts.append(f"{name}s as ({seeds})")
    ours = "dw[k + shift + 1] end as integer), 0) for k in range(low, high)]"
    equal = f"[coalesce(cast(iw[k + 1] = case when k + shift >= 0 then {ours}"
    best = "list_max([list_sum(e[f + 1 : f + width]) for f in range(0, len(e) - width + 1)])"
    return f"""with {', '.join(parts)},
h as (select ds.doc_id, ds.w as dw, bs.item_id, bs.w as iw, ds.i - bs.i as shift,
        least({window}, len(bs.w)) as width, greatest(0, bs.i - {window - 1}) as low,
        least(len(bs.w), bs.i + {window}) as high
    from ds join bs on ds.mask = bs.mask and ds.seed = bs.seed),
e as (select doc_id, item_id, width, {equal} as e from h),
v as (select doc_id, item_id, width, {best} as n_equal from e)
select doc_id, item_id, count(*) as n_hits, cast(max(n_equal) as integer) as n_equal
from v where n_equal >= ceil({share} * width) group by 1, 2"""
