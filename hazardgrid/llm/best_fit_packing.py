"""Best-fit packing of token pieces into sequences under several capacities."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardgrid.llm.common import saved, text_slices
from hazardgrid.llm.token_counts import MergeTable, Tokens

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, path: str, most: int = 2048, end_id: int = 0) -> DataFrame:
    """Every document's ids, with ``end_id`` behind them, cut into pieces of at most ``most`` ids.

    One row per piece: ``doc_id``, ``piece`` from 0, ``start`` (ids before it), ``length`` and the CRC-32 of
    its ids as little-endian unsigned 32-bit numbers. A null or empty text is the end id alone. Rows
    that share a ``doc_id``, null included, each give their pieces.
    """
    merges = MergeTable(path)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(merges)
        last = np.array([end_id], "<u4")
        for batch, texts in text_slices(batches, "text", 16 << 20):
            lengths, crcs = [], []
            for ids in tokens.ids(texts):
                ids = np.concatenate([ids.astype("<u4", copy=False), last])
                lengths.append(len(ids))
                crcs += [zlib.crc32(ids[i : i + most]) for i in range(0, len(ids), most)]
            total = np.array(lengths, np.int64)
            n = -(-total // most)
            owner = np.repeat(np.arange(len(n)), n)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * most
            length = np.minimum(total[owner] - start, most)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(np.array(crcs, np.int64))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def fit(sizes: np.ndarray, capacity: tuple[float, ...], weights: tuple[float, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Bin and position of every item, largest items first.

    An item takes one of each capacity's resources: its tokens, one document, its attention cost
    (tokens squared). Of the open bins that keep every constraint, the one whose weighted residual
    has the smallest norm after the item is in gets it; without one, a new bin opens. Bins that
    cannot take the smallest item left leave the search.
    """
    cap, weight = np.array(capacity, float), np.sqrt(np.array(weights, float)) / np.array(capacity, float)
    order = np.argsort(-sizes, kind="stable")
    needs = np.stack([sizes, np.ones(len(sizes)), sizes.astype(float) ** 2], 1)
    if len(sizes) and (needs[order[0]] > cap).any():
        raise ValueError(f"an item of {sizes[order[0]]} tokens exceeds the capacities {capacity}")
    least = needs[order[-1]] if len(sizes) else cap
    bins, at = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    left, number, used = np.empty((64, 3)), np.empty(64, np.int64), np.empty(64, np.int64)
    n_open = n_bins = 0
    for item in order:
        need = needs[item]
        pick = -1
        if n_open:
            rest = left[:n_open] - need
            possible = np.flatnonzero((rest >= 0).all(1))
            if len(possible):
                norm = ((rest[possible] * weight) ** 2).sum(1)
                pick = possible[np.argmin(norm)]
        if pick < 0:
            if n_open == len(left):
                left, number, used = (np.concatenate([x, np.empty_like(x)]) for x in (left, number, used))
            pick, n_open = n_open, n_open + 1
            left[pick], number[pick], used[pick] = cap, n_bins, 0
            n_bins += 1
        bins[item], at[item] = number[pick], used[pick]
        left[pick] -= need
        used[pick] += sizes[item]
        if (left[pick] < least).any():
            n_open -= 1
            left[pick], number[pick], used[pick] = left[n_open], number[n_open], used[n_open]
    return bins, at


def repetitions(pieces: DataFrame, name: str, block: int = 4096) -> DataFrame:
    """The rows with a number from 0 that tells equal rows apart.

    Equal rows are counted, not gathered: a count is dealt out as blocks of numbers, and a task makes
    the rows of whole blocks.
    """
    keep = pieces.columns
    first = F.col("_block") * block
    counted = pieces.groupBy(*keep).agg(F.count("*").alias("_rows"))
    blocks = counted.select(*keep, "_rows", F.explode(F.expr(f"sequence(0L, (_rows - 1) div {block})")).alias("_block"))
    numbers = F.sequence(first, F.least(first + block, F.col("_rows")) - 1)
    return blocks.repartition(*keep, "_block").select(*keep, F.explode(numbers).alias(name))


def pack(pieces: DataFrame, most: int = 2048, documents: int = 2048, attention: float | None = None, weights: tuple[float, float, float] = (1.0, 1e-6, 1e-6), group: int = 16384) -> DataFrame:
    """Pieces with the sequence that holds them (``sequence_id``) and their place there (``offset``).

    Capacities of a sequence: ``most`` tokens, ``documents`` pieces and ``attention`` cost, the sum of
    squared lengths (by default what one full piece costs, which never binds alone). Pieces are
    dealt at random into groups of about ``group`` pieces, repeated rows like others, and each group is
    packed on its own: a task never holds more, whatever a source or group of copies weighs, and a
    group can leave one sequence part empty beyond what one packing of all would. Piece order within equal lengths is
    by id, so reruns agree. An empty table gives an empty one.
    """
    attention = float(most) ** 2 if attention is None else attention
    groups = max(1, round(pieces.count() / group))
    keep = [f.name for f in pieces.schema.fields]
    # A null adds nothing to the hash, so that rows without repetitions are dealt by their own values.
    again = F.when(F.col("_again") > 0, F.col("_again"))
    dealt = repetitions(pieces, "_again").select(*keep, F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", again), F.lit(groups)).alias("_group"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields) + ", sequence_id long, offset long"

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        number = table.column("_group")[0].as_py()
        bins, at = fit(table.column("length").to_numpy(), (most, documents, attention), weights)
        out = table.select(keep)
        return out.append_column("sequence_id", pa.array(bins + (number << 32))).append_column("offset", pa.array(at))

    return dealt.groupBy("_group").applyInArrow(place, schema)


def best_fit_packing(docs: DataFrame, path: str, most: int = 2048, **options) -> DataFrame:
    """Documents (``doc_id``, ``text``) packed into sequences of at most ``most`` tokens.

    Returns the rows of ``token_pieces`` with ``sequence_id`` and ``offset``; only documents longer than
    a sequence are cut. Only numbers are shuffled, never texts or ids.
    """
    return pack(saved(token_pieces(docs, path, most), "pieces"), most, **options)
