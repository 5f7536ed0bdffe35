"""The main text of pages: without what the markup sets apart and without what a host prints on
most of its pages.

Markup says where an article stands, and which menus, forms and notices are none of it. What it
doesn't say is found by suffix arrays: the token streams of a host's distinct pages (words, with a
token for the element that a block stands in) are concatenated, sorted to a depth of ``RUN``
tokens, and blocks or parts of blocks that most of the host's distinct pages hold are taken out;
unique runs stay.

A host may hold a third of all pages. Its streams are dealt to pieces of bounded size, each with an
array of its own. A stretch that a share of a host's pages holds is held by that share of the
pages of some piece, so the pieces together propose all stretches; their pages are then counted
over the whole host. Pages of equal content count once, so that copies of an article don't make it
look like a template.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm import markup
from tidegauge.llm.bpe import added
from tidegauge.llm.bytesops import U64, mix
from tidegauge.llm.frames import importable, parts_for, stored

#: Tokens of the stretches that are looked for.
RUN = 6
#: Of a page without an <article>, what more than half of a host's pages hold goes, if the host has
#: three pages or more; of an article, only whole blocks that nearly all of ten pages or more hold.
SHARE, PAGES = 0.5, 3
ARTICLE_SHARE, ARTICLE_PAGES = 0.9, 10
#: Bytes of streams that are sorted at once (or one page).
SLICE_BYTES = 4 << 20
#: Bytes of streams in a partition.
PART_BYTES = 4 << 20

_HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)"


def main_text(pages: DataFrame, url: str = "url", page: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with the main text of each page as ``name``.

    Of a page with an <article> that is the article, of another one its main part or all of its
    blocks, without menus, headers, footers, sidebars, notices, adverts, forms, hidden parts,
    comments and articles within articles, as far as elements, roles, classes and ids say so, and
    without what the host's other pages show to be its template. Character references are decoded,
    white space (Unicode's) within a block becomes one space, blocks are joined by one space.

    Pages without a host in ``url``, NULL ones included, form a group as a host does. A NULL or empty
    page has the text "". Rows that repeat have the same text; an empty table gives an empty
    table. A column that has the result's name is replaced, all others are left alone.
    """
    spark = pages.sparkSession
    importable(spark)
    plain = pages.select(_host(F.col(url)).alias("host"), F.col(page).alias("page"))
    sizes = stored(plain.groupBy("host").agg(F.sum(F.octet_length("page")).alias("bytes")), "hosts")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    # Fewer than 2**16 hosts have more than a 2**16th of all bytes.
    large = sizes.where(F.col("bytes") > max(SLICE_BYTES, total >> 16))
    large = large.select("host", F.ceil(F.col("bytes") / SLICE_BYTES).alias("pieces"))

    streams = plain.mapInArrow(_streams, "host string, content binary, stream string")
    dealt = _dealt(streams, large, F.xxhash64("content"))
    dealt = dealt.repartition(parts_for(total, PART_BYTES, spark), "host", "piece")
    dealt = dealt.sortWithinPartitions("host", "piece", "content")
    proposed = dealt.mapInArrow(_proposals, "host string, mark bigint, pages bigint")
    proposed = stored(proposed, "stretches")
    held = proposed.where(F.col("mark").isNull()).groupBy("host").agg(F.sum("pages").alias("held"))
    marks = proposed.where(F.col("mark").isNotNull()).groupBy("host").agg(F.collect_set("mark").alias("marks"))

    # Which of the proposed stretches a page holds, once for each content.
    asked = _joined(plain, marks, large, "inner").drop("pieces", "piece")
    found = asked.mapInArrow(_held, "host string, content binary, marks array<bigint>")
    found = found.dropDuplicates(["host", "content"]).select("host", F.explode("marks").alias("mark"))
    counted = found.groupBy("host", "mark").agg(F.count("*").alias("pages")).join(held, "host")
    most = F.col("pages") > F.col("held") * SHARE
    nearly_all = (F.col("pages") >= F.col("held") * ARTICLE_SHARE) & (F.col("held") >= ARTICLE_PAGES)
    sets = (F.collect_list("mark").alias("most"), F.collect_list(F.when(nearly_all, F.col("mark"))).alias("all"))
    template = counted.where(most & (F.col("held") >= PAGES)).groupBy("host").agg(F.struct(*sets).alias("sets"))
    template = stored(template, "template")

    packed = pages.select(_host(F.col(url)).alias("host"), F.struct(*pages.columns).alias("given"))
    joined = _joined(packed, template, large, "left").select("sets", "given")
    cut = joined.mapInArrow(_cut(page), added(joined.select("given"), text=T.StringType()))
    names = pages.columns if name.lower() in (c.lower() for c in pages.columns) else [*pages.columns, name]
    text = F.col("text").alias(name)
    return cut.select(*(text if c.lower() == name.lower() else F.col("given").getField(c).alias(c) for c in names))


def _host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, _HOST, 1)), F.lit(""))


def _dealt(rows: DataFrame, large: DataFrame, number: Column) -> DataFrame:
    """``rows`` with the piece of their host that a number deals them to."""
    several = F.coalesce(F.col("pieces"), F.lit(1))
    return rows.join(F.broadcast(large), "host", "left").withColumn("piece", F.pmod(number, several))


def _joined(rows: DataFrame, of_host: DataFrame, large: DataFrame, how: str) -> DataFrame:
    """``rows`` with what is known of their host; a large host's rows are joined in pieces."""
    rows = _dealt(rows, large, F.xxhash64(F.monotonically_increasing_id()))
    last = F.coalesce(F.col("pieces"), F.lit(1)) - 1
    of_host = of_host.join(F.broadcast(large), "host", "left")
    of_host = of_host.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).drop("pieces")
    return rows.join(of_host, ["host", "piece"], how)


# --- In tasks -------------------------------------------------------------------------


def _chosen(page: str | None) -> tuple[bool, list[markup.Block]]:
    """The blocks of the place that says most, and whether that is an article."""
    blocks = markup.visible_blocks(page) if page else []
    place = max((b.place for b in blocks), default=markup.OPEN)
    return place == markup.ARTICLE, [b for b in blocks if b.place == place]


def _tokens(blocks: list[markup.Block]) -> list[str]:
    return [token for b in blocks for token in (b.tag, *b.words)]


def _content(stream: str) -> bytes:
    return hashlib.blake2b(stream.encode(), digest_size=16).digest()


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hosts, digests and token streams; a task gives equal ones of a host once."""
    seen = set()
    for batch in batches:
        out = []
        for host, page in zip(batch.column("host").to_pylist(), batch.column("page").to_pylist()):
            stream = " ".join(_tokens(_chosen(page)[1]))
            key = (host, _content(stream))
            if stream and key not in seen:
                seen.add(key)
                out.append((*key, stream))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.binary(), pa.string()))],
            ["host", "content", "stream"],
        )


def _proposals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stretches of each slice of a host that its share of the slice's pages holds, and (with
    no stretch) the number of those pages. Rows come by host, piece and content."""
    at, last, streams, size, whole = None, None, [], 0, True

    def proposed() -> pa.RecordBatch:
        marks, pages = repeated(streams)
        # Most of the pages of some slice; where the slice is all of its host, of the host.
        kept = pages >= SHARE * len(streams)
        if whole:
            kept &= (pages > SHARE * len(streams)) & (len(streams) >= PAGES)
        marks = [None, *marks[kept].tolist()]
        counts = [len(streams), *pages[kept].tolist()]
        return pa.RecordBatch.from_arrays(
            [pa.array([at[0]] * len(marks), pa.string()), pa.array(marks, pa.int64()), pa.array(counts, pa.int64())],
            ["host", "mark", "pages"],
        )

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("host", "piece", "content", "stream", "pieces"))
        for host, piece, content, stream, pieces in zip(*columns):
            if at == (host, piece) and content == last:
                continue
            more = at == (host, piece) and size + len(stream) > SLICE_BYTES
            if streams and (at != (host, piece) or more):
                whole = whole and not more
                yield proposed()
                streams, size = [], 0
            if at != (host, piece):
                whole = pieces is None
            at, last = (host, piece), content
            streams.append(stream)
            size += len(stream)
    if streams:
        yield proposed()


def repeated(streams: list[str], run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Marks of the stretches of ``run`` tokens, and how many of the streams hold each, by a suffix
    array of the concatenated streams that is sorted to that depth."""
    tokens, first = _numbered(streams)
    names, places = tokens.names, np.arange(len(tokens.names))
    depth, ranks = 1, names
    while depth < run:
        step = min(depth, run - depth)
        ranks = _ranked(ranks, step)
        depth += step
    suffixes = np.argsort(ranks, kind="stable")
    suffixes = suffixes[ranks[suffixes] >= 0]
    own = np.searchsorted(first, places, "right") - 1
    # Neighbours in the array with the same rank share at least ``run`` tokens.
    rank, page = ranks[suffixes], own[suffixes]
    fresh = np.ones(len(suffixes), bool)
    fresh[1:] = rank[1:] != rank[:-1]
    other = fresh.copy()
    other[1:] |= page[1:] != page[:-1]
    starts = np.flatnonzero(fresh)
    pages = np.add.reduceat(other, starts) if len(starts) else np.zeros(0, np.int64)
    return _marks(tokens.hashes, run)[suffixes[starts]], pages.astype(np.int64)


def _ranked(ranks: np.ndarray, step: int) -> np.ndarray:
    """Ranks of suffixes by so many tokens more; -1 where a stream ends before."""
    there = np.full(len(ranks), -1, np.int64)
    there[: len(ranks) - step] = ranks[step:]
    whole = np.flatnonzero((ranks >= 0) & (there >= 0))
    out = np.full(len(ranks), -1, np.int64)
    out[whole] = np.unique(ranks[whole] * (int(there.max(initial=0)) + 1) + there[whole], return_inverse=True)[1]
    return out


class _Numbered:
    def __init__(self, names: np.ndarray, hashes: np.ndarray):
        self.names, self.hashes = names, hashes


def _numbered(streams: list[str]) -> tuple[_Numbered, np.ndarray]:
    """Numbers and hashes of all tokens, with a place that equals nothing after each stream."""
    known: dict[str, int] = {}
    numbers, first, total = [], [], 0
    for stream in streams:
        own = [known.setdefault(x, len(known)) for x in stream.split(" ")]
        numbers += (np.array(own, np.int64), np.array([-1], np.int64))
        first.append(total)
        total += len(own) + 1
    names = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
    return _Numbered(names, _hashes(list(known))[names] if known else np.zeros(0, U64)), np.array(first)


def _hashes(tokens: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(x) for x in tokens), U64, len(tokens))


def _marks(hashes: np.ndarray, run: int = RUN) -> np.ndarray:
    """A 64-bit mark of the stretch of ``run`` tokens from each place that has so many."""
    total = np.zeros(max(len(hashes) - run + 1, 0), U64)
    with np.errstate(over="ignore"):
        for k in range(run):
            total = mix(total * U64(0x9E3779B97F4A7C15) + hashes[k : k + len(total)])
    return total.view(np.int64)


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The proposed stretches that pages hold, once for each content of a task."""
    seen = set()
    for batch in batches:
        out = []
        columns = (batch.column(c).to_pylist() for c in ("host", "page", "marks"))
        for host, page, marks in zip(*columns):
            stream = " ".join(tokens := _tokens(_chosen(page)[1]))
            key = (host, _content(stream))
            if stream and key not in seen:
                seen.add(key)
                own = np.unique(_marks(_hashes(tokens)))
                out.append((*key, np.intersect1d(own, marks, assume_unique=True).tolist()))
        kinds = (pa.string(), pa.binary(), pa.list_(pa.int64()))
        arrays = [pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(arrays, ["host", "content", "marks"])


def _cut(page: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given, texts = batch.column("given"), []
            names = [x.lower() for x in (given.type.field(k).name for k in range(given.type.num_fields))]
            pages = given.field(names.index(page.lower()))
            for html, sets in zip(pages.to_pylist(), batch.column("sets").to_pylist()):
                is_article, blocks = _chosen(html)
                marks = sets and sets["all" if is_article else "most"]
                words = _kept(blocks, marks, is_article) if marks else (w for b in blocks for w in b.words)
                texts.append(" ".join(words))
            yield pa.RecordBatch.from_arrays([given, pa.array(texts, pa.string())], ["given", "text"])

    return run


def _kept(blocks: list[markup.Block], marks: list[int], whole_blocks: bool) -> list[str]:
    """The words of blocks that the template's stretches don't cover whole, and that (but for
    ``whole_blocks``) no stretch within the block covers. The words that a block happens to begin
    with on most pages, next to a block of the template, so stay."""
    tokens = _tokens(blocks)
    hit = np.isin(_marks(_hashes(tokens)), np.array(marks, np.int64))
    free = ~_covered(np.flatnonzero(hit), len(tokens))
    out, at = [], 0
    for block in blocks:
        end = at + 1 + len(block.words)
        if free[at + 1 : end].any():
            within = np.flatnonzero(hit[at : max(end - RUN + 1, at)])
            if whole_blocks or not len(within):
                out += block.words
            else:
                gone = _covered(within, end - at)
                out += (word for word, goes in zip(block.words, gone[1:]) if not goes)
        at = end
    return out


def _covered(starts: np.ndarray, size: int) -> np.ndarray:
    """Which of so many places the stretches from ``starts`` cover."""
    change = np.zeros(size + RUN, np.int64)
    change[starts] += 1
    change[starts + RUN] -= 1
    return np.cumsum(change)[:size] > 0
