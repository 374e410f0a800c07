"""Exact deduplication by recipes of content-defined chunks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardgrid.llm.common import null_last, one_row_each, saved, fresh, text_bytes, text_slices, SPACE

#: Random numbers of the rolling hash, one for each byte, from a rule.
_GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, np.uint32)


def squeezed(values: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with every run of blanks and control characters 9 to 13 as one blank."""
    space = (values == 32) | ((values >= 9) & (values <= 13))
    again = np.zeros(len(values), bool)
    again[1:] = space[1:] & space[:-1]
    again[edges[:-1][np.diff(edges) > 0]] = False
    out = np.where(space, np.uint8(32), values)[~again]
    return out, edges - np.r_[0, np.cumsum(again)][edges]


def cuts(values: np.ndarray, bits: int) -> np.ndarray:
    """Places behind which the hash of the last 32 bytes lets a chunk end: one in ``2 ** bits``.

    The sum of shifted random numbers over a window of 32 bytes, built by doubling the window.
    """
    h = _GEAR[values]
    for shift in (1, 2, 4, 8, 16):
        h[shift:] += h[:-shift] << np.uint32(shift)
    return np.flatnonzero(h >> np.uint32(32 - bits) == 0) + 1


def chunk_ends(edges: np.ndarray, places: np.ndarray, least: int, most: int) -> Iterator[list[int]]:
    """Ends of each text's chunks of ``least`` to ``most`` bytes (the last one may be shorter).

    The window never reaches over a text's start since ``least`` is at least as wide.
    """
    for start, stop in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        ends, at = [], start
        while at < stop:
            i = int(np.searchsorted(places, at + least))
            at = min(stop, at + most, int(places[i]) if i < len(places) else stop)
            ends.append(at)
        yield ends


def recipes(docs: DataFrame, bits: int = 11, least: int = 512, most: int = 65536, digest: int = 16) -> DataFrame:
    """``doc_id``, ``text_sha256`` and ``recipe``, the digests of a text's chunks in order."""

    def cook(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "text"):
            values, edges = squeezed(*text_bytes(texts))
            data, shas, lists = values.tobytes(), [], []
            for start, ends in zip(edges.tolist(), chunk_ends(edges, cuts(values, bits), least, most), strict=False):
                shas.append(hashlib.sha256(data[start : ends[-1] if ends else start]).hexdigest())
                lists.append([hashlib.blake2b(data[a:b], digest_size=digest).digest() for a, b in zip([start, *ends], ends, strict=False)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shas, pa.string()), pa.array(lists, pa.list_(pa.binary()))], names=["doc_id", "text_sha256", "recipe"])

    return docs.select("doc_id", "text").mapInArrow(cook, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_sha256 string, recipe array<binary>")


def chunks(docs: DataFrame, bits: int = 11, least: int = 512, most: int = 65536, digest: int = 16, places: bool = False) -> DataFrame:
    """``digest`` and ``content`` of the chunks, each distinct one once per slice of a task.

    With ``places`` every occurrence, with its text's ``text_sha256`` and ``seq``.
    """

    def cook(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_slices(batches, "text"):
            values, edges = squeezed(*text_bytes(texts))
            data, rows, seen = values.tobytes(), [], set()
            for start, ends in zip(edges.tolist(), chunk_ends(edges, cuts(values, bits), least, most), strict=False):
                sha = hashlib.sha256(data[start : ends[-1] if ends else start]).hexdigest() if places else None
                for seq, (a, b) in enumerate(zip([start, *ends], ends, strict=False)):
                    content = data[a:b]
                    if places:
                        rows.append((hashlib.blake2b(content, digest_size=digest).digest(), content, sha, seq))
                    elif content not in seen:
                        seen.add(content)
                        rows.append((hashlib.blake2b(content, digest_size=digest).digest(), content))
            kinds = [("digest", pa.binary()), ("content", pa.binary()), ("text_sha256", pa.string()), ("seq", pa.int32())][: 4 if places else 2]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(kinds)], names=[n for n, _ in kinds])

    return docs.select("text").mapInArrow(cook, "digest binary, content binary" + (", text_sha256 string, seq int" if places else ""))


def verified_recipes(docs: DataFrame, **sizes) -> DataFrame:
    """Recipes whose identifiers stand for one content each, saved, with a ``row`` number.

    Chunks are grouped by their bytes, which move once per distinct chunk and task: a digest found
    with one content only is that content's identifier. Where contents share a digest, their
    places get the content's rank among them as well.
    """
    cooked = saved(recipes(docs, **sizes).withColumn("row", F.monotonically_increasing_id()), "recipes")
    distinct = chunks(docs, **sizes).groupBy("digest", "content").agg(F.lit(1).alias("one"))
    shared = saved(distinct.groupBy("digest").agg(F.count("one").alias("n")).filter("n > 1").select("digest"), "shared-digests")
    if shared.isEmpty():
        return cooked
    rank = F.row_number().over(Window.partitionBy("digest").orderBy("content"))
    known = chunks(docs, **sizes).join(shared, "digest", "left_semi").distinct().withColumn("rank", rank)
    places = chunks(docs, **sizes, places=True).join(known, ["digest", "content"])
    ranks = places.select("text_sha256", "seq", "rank").distinct().groupBy("text_sha256")
    ranks = ranks.agg(F.map_from_entries(F.collect_list(F.struct("seq", "rank"))).alias("ranks"))
    names = F.transform("recipe", lambda d, i: F.concat(d, F.encode(F.coalesce(F.try_element_at("ranks", i).cast("string"), F.lit("")), "UTF-8")))
    return saved(cooked.join(ranks, "text_sha256", "left").withColumn("recipe", names).drop("ranks"), "recipes")


def chunk_dedup(docs: DataFrame, **sizes) -> DataFrame:
    """One row per document with the document that stands for all with an equal text.

    Texts are equal when identical after every run of white space is one blank; null counts as
    empty. Of equal texts the row with the smallest ``doc_id`` stays (a null id behind all others; of
    repeated rows with that id one). Returns ``doc_id``, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256`` of the normalised text. An empty table gives an empty one. Whole texts
    are read in two scans and shuffled once as distinct chunks; comparing them moves recipes only,
    a hundredth of the text. Grouping combines before its shuffle, so a large group of copies is one
    row a task there; the join that hands out its result has one row per group on the other side.
    """
    rows = verified_recipes(docs, **sizes)
    first = F.min(F.struct(null_last("doc_id").alias("id"), "row")).alias("first")
    groups = rows.groupBy("recipe").agg(first, F.count(F.lit(1)).alias("group_size"))
    return rows.join(groups, "recipe").select(
        "doc_id",
        F.col("first.id.value").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256",
    )


def normalised(text: str = "text"):
    """The normalised text as a column."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE, " ")


def without_copies(docs: DataFrame, **sizes) -> DataFrame:
    """The documents that ``chunk_dedup`` keeps, with all their columns."""
    key, sha = fresh(docs, "_id"), fresh(docs, "_sha")
    kept = chunk_dedup(docs, **sizes).filter("kept").select(null_last("doc_id").alias(key), F.col("text_sha256").alias(sha))
    marked = docs.withColumn(key, null_last("doc_id")).withColumn(sha, F.sha2(normalised(), 256))
    return one_row_each(marked.join(kept, [key, sha], "left_semi"), [key, sha]).select(*docs.columns)
