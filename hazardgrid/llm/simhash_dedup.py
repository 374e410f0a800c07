"""SimHash near-duplicates by pigeonhole blocks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardgrid.llm.common import components, fresh, null_last, one_row_each, saved, text_slices


def simhash(text: bytes, words: int, seed: int, block: int = 1 << 16) -> int:
    """64-bit fingerprint of the word shingles, repeats included: a bit is set if over half have it."""
    found = text.lower().split()  # bytes: A-Z and white space are the ASCII ones
    if not found:
        return 0
    if len(found) <= words:
        return xxhash.xxh64_intdigest(b" ".join(found), seed)
    n, counts, hashed = len(found) - words + 1, np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, block):
        part = found[at : at + block + words - 1]
        values = [hashed(b" ".join(s), seed) for s in zip(*[part[i:] for i in range(words)], strict=False)]
        bits = np.unpackbits(np.array(values, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, column: str = "fingerprint", words: int = 3, seed: int = 42) -> DataFrame:
    """The rows with the fingerprint of their whole text as a LONG (null: empty; empty: 0)."""
    rows = docs.withColumn(column, F.lit(0).cast("long"))
    names = rows.columns

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "text"):
            values = np.array([simhash(t, words, seed) for t in texts.cast(pa.binary()).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(values.view(np.int64))], names=names)

    return rows.mapInArrow(mark, rows.schema)


def near_links(prints: DataFrame, bits: int = 2, blocks: int = 4, most: int = 64) -> DataFrame:
    """Links ``a``-``b`` that connect all distinct ``fingerprint`` values within ``bits`` bits of each other.

    The 64 bits are cut into ``blocks`` blocks; a close pair differs in ``bits`` blocks at most, so it
    agrees in one choice of the others. Fingerprints meet on each choice and are verified by their
    Hamming distance. Meeting places with more than ``most`` fingerprints (many variants of one
    text) would pair each with each; there, fingerprints meet on the values one changed bit away
    instead, which two values share exactly if at most two bits differ: as many links as values and
    bits. That holds for two bits and is used for them alone; for others the pairs are made.
    """
    width = 64 // blocks
    masks = [sum(((1 << width) - 1) << (width * b) for b in chosen) for chosen in combinations(range(blocks), blocks - bits)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    keys = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("value")) for i, m in enumerate(signed)])
    met = prints.select("fingerprint", F.inline(keys))
    sizes = met.groupBy("choice", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = saved(met.join(sizes, ["choice", "value"]), "meetings")
    usual = met if bits != 2 else met.filter(F.col("n") <= most)
    left, right = usual.select("choice", "value", F.col("fingerprint").alias("a")), usual.select("choice", "value", F.col("fingerprint").alias("b"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits
    pairs = left.join(right, ["choice", "value"]).filter((F.col("a") < F.col("b")) & close).select("a", "b")
    if bits != 2:
        return pairs.distinct()
    crowded = met.filter(F.col("n") > most).select("fingerprint").distinct()
    flips = F.array(*[F.lit(x) for x in (0, *[(1 << i) - (1 << 64) if i == 63 else 1 << i for i in range(64)])])
    spread = crowded.select(F.col("fingerprint").alias("a"), F.explode(flips).alias("flip")).select("a", F.col("a").bitwiseXOR(F.col("flip")).alias("near"))
    hubs = spread.groupBy("near").agg(F.min("a").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    stars = spread.join(hubs, "near").filter("a <> b").select("a", "b")
    return pairs.unionByName(stars).distinct()


def simhash_dedup(docs: DataFrame, words: int = 3, bits: int = 2, seed: int = 42, prints: DataFrame | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``, ``kept``.

    Texts are lower-cased in A-Z and cut at white space; shingles of ``words`` words count as often as
    they occur (fewer words: the whole sequence; none or null: fingerprint 0, linked like any
    other). Fingerprints within ``bits`` bits link; ``component_id`` is the smallest id reachable (null
    only where no id is). ``kept`` marks the rows with the component's smallest id, null ids last;
    repeated rows share it. An empty table gives an empty one.

    Documents with one fingerprint are one node: groups of copies never meet as pairs. Shuffles hold
    ids and fingerprints, no texts.
    """
    if prints is None:
        prints = saved(fingerprints(docs.select("doc_id", "text"), "fingerprint", words, seed).select("doc_id", "fingerprint"), "fingerprints")
    nodes = saved(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "nodes")
    found = components(near_links(nodes.select("fingerprint"), bits))
    nodes = nodes.join(found.withColumnRenamed("id", "fingerprint"), "fingerprint", "left")
    nodes = nodes.withColumn("component", F.coalesce("component", "fingerprint"))
    roots = nodes.groupBy("component").agg(F.min("first").alias("component_id"), F.min_by("fingerprint", null_last("first")).alias("holder"))
    nodes = saved(nodes.join(roots, "component").select("fingerprint", "component_id", "holder"), "nodes")
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("fingerprint") == F.col("holder"))
    return prints.join(nodes, "fingerprint").select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id", kept.alias("kept"))


def without_near_copies(docs: DataFrame, words: int = 3, bits: int = 2) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest id."""
    key, mark = fresh(docs, "_id"), fresh(docs, "_fingerprint")
    kept = simhash_dedup(docs, words, bits).filter("kept").select(null_last("doc_id").alias(key), F.col("fingerprint").alias(mark)).distinct()
    marked = fingerprints(docs, mark, words).withColumn(key, null_last("doc_id")).withColumn(mark, F.lower(F.lpad(F.hex(mark), 16, "0")))
    return one_row_each(marked.join(kept, [key, mark], "left_semi"), [key, mark]).select(*docs.columns)
