"""Fuzzy line deduplication: MinHash bands, exact Jaccard, distributed union-find."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardgrid.llm.common import components, fresh, null_last, saved, text_slices


#: Lines of a tile, and shingles that are compared at a time in a block of two tiles.
TILE, WIDTH = 512, 8192
#: Lines of a block up to which sets are compared one by one.
FEW = 16


def text_lines(text: str) -> list[bytes]:
    """Normalised lines: lower case, runs of white space as one blank, trimmed; some may be empty."""
    return [b" ".join(line.split()) for line in text.lower().encode().split(b"\n")]


def line_key(line: bytes) -> bytes:
    return hashlib.blake2b(line, digest_size=16).digest()


def shingles(line: str, width: int) -> frozenset[str]:
    """Character shingles of a line; a shorter line is one shingle."""
    return frozenset(line[i : i + width] for i in range(max(1, len(line) - width + 1)))


def band_keys(lines: list[bytes], width: int, bands: int, rows: int, seed: int = 7) -> np.ndarray:
    """One 64-bit key for each line and band from ``bands * rows`` MinHash values of its shingles."""
    rng = np.random.default_rng(seed)
    flips, factors = rng.integers(0, 1 << 32, (2, bands * rows), np.uint32)
    joined = (b"\n" + bytes(width - 1)).join(lines) + b"\n" + bytes(width)
    c = np.frombuffer(joined.decode().encode("utf-32-le"), np.uint32)
    ends = np.flatnonzero(c == 10)
    starts = np.r_[0, ends[:-1] + width]
    h = np.zeros(len(c) - width + 1, np.uint32)
    for i in range(width):
        h *= np.uint32(0x01000193)
        h += c[i : len(h) + i]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    n = np.maximum(1, ends - starts - width + 1)
    first = np.cumsum(n) - n
    at = np.repeat(starts - first, n)
    at += np.arange(len(at))
    h = h[at]
    keys = np.empty((len(lines), bands), np.uint64)
    work = np.empty_like(h)
    for band in range(bands):
        key = np.full(len(lines), band + 1, np.uint64)
        for row in range(band * rows, (band + 1) * rows):
            np.bitwise_xor(h, flips[row], out=work)
            np.multiply(work, factors[row] | np.uint32(1), out=work)
            key = (key ^ np.minimum.reduceat(work, first)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        keys[:, band] = key
    return keys


def occurrences(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``line_no`` (from 0) and ``key`` of every line that isn't empty."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "text"):
            owner, number, keys = [], [], []
            for i, text in enumerate(texts.to_pylist()):
                found = [(no, line_key(line)) for no, line in enumerate(text_lines(text)) if line]
                owner += [i] * len(found)
                number += [no for no, _ in found]
                keys += [key for _, key in found]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner, pa.int64())), pa.array(number, pa.int32()), pa.array(keys, pa.binary())], names=["doc_id", "line_no", "key"])

    return docs.select("doc_id", "text").mapInArrow(split, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, line_no int, key binary")


def signatures(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """``key`` and bands ``band0``... of every line, each distinct one once per slice of a task."""
    names = [f"band{i}" for i in range(bands)]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_slices(batches, "text", 4 << 20):
            lines = list(dict.fromkeys(line for text in texts.to_pylist() for line in text_lines(text) if line))
            if lines:
                keys = band_keys(lines, width, bands, rows)
                columns = [pa.array(np.ascontiguousarray(keys[:, i]).view(np.int64)) for i in range(bands)]
                yield pa.RecordBatch.from_arrays([pa.array([line_key(line) for line in lines], pa.binary()), *columns], names=["key", *names])

    return docs.select("text").mapInArrow(sign, "key binary, " + ", ".join(f"{n} long" for n in names))


def wanted_filter(keys: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of ``2 ** bits`` bits in which two bits of every key are set; its size is fixed."""
    digits = F.hex("key")
    places = [F.conv(F.substring(digits, 1 + 8 * i, 8), 16, 10).cast("long").bitwiseAND(F.lit((1 << bits) - 1)) for i in range(2)]
    words = keys.select(F.explode(F.array(*places)).alias("place"))
    words = words.groupBy(F.shiftright("place", 5).alias("word")).agg(F.expr("bit_or(shiftleft(1L, CAST(place & 31 AS INT)))").alias("value")).toArrow()
    out = np.zeros(1 << (bits - 5), np.uint32)
    out[words.column("word").to_numpy()] = words.column("value").to_numpy().astype(np.uint32)
    return out


def line_texts(docs: DataFrame, keys: DataFrame, bits: int = 24) -> DataFrame:
    """``key`` and ``line`` of the lines whose key is in ``keys``, from another scan of the documents.

    Lines pass a bitmap of fixed size (2 MB) before they are shuffled, so few others move; the join
    that follows is exact however full the bitmap is.
    """
    sent = docs.sparkSession.sparkContext.broadcast(wanted_filter(keys, bits))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, mask = sent.value, (1 << bits) - 1
        for _, texts in text_slices(batches, "text"):
            found = {}
            for text in texts.to_pylist():
                for line in text_lines(text):
                    if line:
                        key = line_key(line)
                        a, b = int.from_bytes(key[:4], "big") & mask, int.from_bytes(key[4:8], "big") & mask
                        if bitmap[a >> 5] >> (a & 31) & 1 and bitmap[b >> 5] >> (b & 31) & 1:
                            found[key] = line.decode()
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.string())], names=["key", "line"])

    some = docs.select("text").mapInArrow(look, "key binary, line string")
    return some.join(keys, "key").groupBy(*keys.columns).agg(F.first("line").alias("line"))


def verified(pairs: DataFrame, texts: DataFrame, width: int, least: float) -> DataFrame:
    """The pairs ``a``-``b`` whose lines' shingle sets have a Jaccard similarity of ``least`` or more."""
    lines = pairs.join(texts.select(F.col("id").alias("b"), F.col("line").alias("line_b")), "b")
    lines = lines.join(texts.select(F.col("id").alias("a"), F.col("line").alias("line_a")), "a").select("a", "b", "line_a", "line_b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, frozenset()
        for batch in batches:
            keep = []
            for a, x, y in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3).to_pylist(), strict=True):
                if a != last:
                    last, left = a, shingles(x.as_py(), width)
                right = shingles(y, width)
                both = len(left & right)
                keep.append(both >= least * (len(left) + len(right) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return lines.mapInArrow(compare, "a long, b long")


def tile_pairs(members: DataFrame) -> DataFrame:
    """Members (``band``, ``id``, ``found``, ``tiles``) as rows of every block of two tiles they are in.

    A block is ``band``, ``ta``, ``tb``; ``side`` is 0 or 1 for its tiles, 2 for a tile with itself.
    """
    own = F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int")

    def block(other: Column) -> Column:
        side = F.when(other == F.col("t"), 2).when(other > F.col("t"), 0).otherwise(1)
        return F.struct(F.least(other, F.col("t")).alias("ta"), F.greatest(other, F.col("t")).alias("tb"), side.alias("side"))

    blocks = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), block)
    return members.withColumn("t", own).select("band", "id", "found", F.inline(blocks))


def block_links(sets: list[frozenset[str]], found: list[int], split: int, least: float) -> list[tuple[int, int]]:
    """Pairs of similar lines that link different components; lines up to ``split`` with those behind.

    With ``split`` 0 all with all. The numbers of shared shingles come from products of 0/1 rows over
    the shingles that several lines have.
    """
    n = len(sets)
    labels = np.unique(np.array(found), return_inverse=True)[1]
    if n <= FEW:  # set by set is cheaper there
        out, root = [], labels.tolist()
        for x in range(split or n):
            for y in range(max(split, x + 1), n):
                small, large = sorted((len(sets[x]), len(sets[y])))
                if root[x] == root[y] or small < least * large:
                    continue
                both = len(sets[x] & sets[y])
                if both >= least * (small + large - both):
                    out.append((x, y))
                    gone, stays = root[x], root[y]
                    root = [stays if r == gone else r for r in root]
        return out
    number: dict[str, int] = {}
    for shared in (x for x, k in Counter(x for s in sets for x in s).items() if k > 1):
        number[shared] = len(number)
    sizes = np.array([len(s) for s in sets])
    a, b = np.arange(split or n), np.arange(split, n)
    both = np.zeros((len(a), len(b)), np.float32)
    at = [np.fromiter((number[x] for x in s if x in number), np.int64) for s in sets]
    for start in range(0, len(number), WIDTH):
        x = np.zeros((n, min(WIDTH, len(number) - start)), np.float32)
        for i, places in enumerate(at):
            x[i, places[(places >= start) & (places < start + WIDTH)] - start] = 1
        both += x[a] @ x[b].T
    similar = both >= least * (sizes[a][:, None] + sizes[b][None, :] - both)
    i, j = np.nonzero(similar)
    i, j = a[i], b[j]
    order = (i < j) if not split else slice(None)
    out, root = [], np.arange(labels.max() + 1)
    for x, y in zip(i[order].tolist(), j[order].tolist(), strict=True):
        p, q = root[labels[x]], root[labels[y]]
        if p != q:
            root[root == p] = q
            out.append((x, y))
    return out


def compared(blocks: DataFrame, texts: DataFrame, width: int, least: float) -> DataFrame:
    """Links ``a``-``b`` between the components of each block (the rows of ``tile_pairs``)."""
    lines = blocks.join(texts.select("id", "line"), "id").select("band", "ta", "tb", "side", "id", "found", "line")
    dealt = lines.repartition("band", "ta", "tb").sortWithinPartitions("band", "ta", "tb", "side", "id")

    def links(held: list[tuple]) -> list[tuple[int, int]]:
        split = 0 if held[0][3] == 2 else sum(r[3] == 0 for r in held)
        if held[0][3] != 2 and split in (0, len(held)) or len({r[5] for r in held}) == 1:
            return []
        found = block_links([shingles(r[6], width) for r in held], [r[5] for r in held], split, least)
        return [(held[x][4], held[y][4]) for x, y in found]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            out = []
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and row[:3] != held[0][:3]:
                    out += links(held)
                    held = []
                held.append(row)
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in range(2)], names=["a", "b"])
        out = links(held) if held else []
        yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in range(2)], names=["a", "b"])

    return dealt.mapInArrow(compare, "a long, b long")


def similar_lines(docs: DataFrame, width: int = 8, bands: int = 9, rows: int = 4, least: float = 0.8) -> DataFrame:
    """``key`` and ``component`` (a number) of every distinct line, by links of similar lines.

    Lines that share a band are candidates. In each such group the line with the smallest number
    is compared with the others; where that leaves a group in several components, its lines meet
    in blocks of two tiles, where lines of different components are compared, too. Pairs within a
    component need no comparison, since only components count, and no pair leaves its block
    unless it links two components.
    """
    names = [f"band{i}" for i in range(bands)]
    # Equal lines have equal bands, so any of them will do; a minimum of numbers is the cheapest.
    signed = signatures(docs, width, bands, rows).groupBy("key").agg(*[F.min(n).alias(n) for n in names])
    lines = saved(signed.withColumn("id", F.monotonically_increasing_id()), "lines")
    # One exchange serves the count and the rows it is joined to: rows of a group stream past its count.
    met = lines.select("id", F.explode(F.array(*names)).alias("band")).repartition("band")
    groups = met.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("pivot")).filter("n > 1").drop("n")
    met = saved(met.join(groups, "band"), "met")
    wanted = met.select("id").distinct().join(lines.select("id", "key"), "id").select("key", "id")
    texts = saved(line_texts(docs, saved(wanted, "wanted")), "texts")
    star = met.filter("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
    links = saved(verified(star, texts, width, least), "links")
    grouped = met.select("band", "id").join(components(links).withColumnRenamed("component", "found"), "id", "left").withColumn("found", F.coalesce("found", "id"))
    mark = F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("mark")
    parted = grouped.groupBy("band").agg(F.min("found").alias("low"), F.max("found").alias("high"), F.count(F.lit(1)).alias("n"), mark).filter("low < high")
    parted = saved(parted.withColumn("tiles", F.ceil(F.col("n") / TILE).cast("int")), "parted")
    # Bands often group the same lines: of such groups one is enough.
    alike = parted.groupBy("n", "mark").agg(F.min("band").alias("band"), F.max("tiles").alias("tiles")).select("band", "tiles")
    more = saved(compared(tile_pairs(grouped.join(alike, "band")), texts, width, least), "links")
    found = components(links.unionByName(more)).withColumnRenamed("component", "found")
    return lines.select("key", "id").join(found, "id", "left").select("key", F.coalesce("found", "id").alias("component"))


def line_dedup(docs: DataFrame, **options) -> DataFrame:
    """One row per line that isn't empty: which line stands for its component.

    Lines are compared in lower case with white space squeezed; lines whose sets of character
    shingles have a Jaccard similarity of at least ``least`` are linked, and of each component the
    first line (smallest ``doc_id``, null last, then line number) is kept. Returns ``doc_id``, ``line_no``,
    ``keep_doc_id``, ``keep_line_no``, ``kept``. Null and empty texts have no lines; repeated rows repeat
    their lines, of which all copies of the first are kept; an empty table gives an empty one.
    """
    rows = saved(occurrences(docs), "occurrences")
    # Id and line as one number, whose minimum needs no sort; lines of rows without id are counted apart.
    place = F.col("doc_id").cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(11,0)") + F.col("line_no")
    firsts = rows.groupBy("key").agg(F.min(place).alias("first"), F.min(F.when(F.col("doc_id").isNull(), F.col("line_no"))).alias("unnamed"))
    named = similar_lines(docs, **options).join(firsts, "key")
    chosen = named.groupBy("component").agg(F.min("first").alias("first"), F.min("unnamed").alias("unnamed"))
    keep_id = F.floor(F.col("first") / F.lit(1 << 32)).cast("long")
    keep_line = F.when(F.col("first").isNull(), F.col("unnamed")).otherwise((F.col("first") - keep_id.cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(11,0)")).cast("int"))
    chosen = chosen.select("component", keep_id.alias("keep_doc_id"), keep_line.alias("keep_line_no"))
    named = named.join(chosen, "component").select("key", "keep_doc_id", "keep_line_no")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_doc_id")) & (F.col("line_no") == F.col("keep_line_no"))
    return rows.join(named, "key").select("doc_id", "line_no", "keep_doc_id", "keep_line_no", kept.alias("kept"))


def without_repeated_lines(docs: DataFrame, **options) -> DataFrame:
    """The documents with only the lines ``line_dedup`` keeps and their empty lines, all columns kept."""
    key, drop = fresh(docs, "_id"), fresh(docs, "_drop")
    gone = line_dedup(docs, **options).filter("NOT kept").groupBy(null_last("doc_id").alias(key)).agg(F.collect_set("line_no").alias(drop))
    marked = docs.withColumn(key, null_last("doc_id")).join(gone, key, "left")
    lines = F.filter(F.split("text", "\n", -1), lambda _, i: ~F.coalesce(F.array_contains(drop, i), F.lit(False)))
    return marked.withColumn("text", F.when(F.col(drop).isNull(), F.col("text")).otherwise(F.array_join(lines, "\n"))).select(*docs.columns)
