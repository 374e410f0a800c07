"""Phrase collocation mining by direct-address tiles of word pairs.

Words that occur often enough are numbered by frequency. Texts become arrays of these numbers, and a pair of
neighbours is the cell ``first * words + second`` of one large table. A task counts the pairs of a few
million places at a time: tiles of the table's head, where pairs are dense, with ``bincount`` over
their cells, the sparse rest as a sorted coordinate list. Partial counts are summed in a grouped
aggregate, which combines before its shuffle. Frequent pairs are numbered by frequency in turn, and a
phrase of n + 1 words is the pair of a phrase of n words and a word, so each length is one more round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardgrid.llm.common import forget, saved, text_bytes, text_slices
from hazardgrid.llm.mixing import prefix_sums
from hazardgrid.llm.terms import parts, word_array, word_spans

#: Classes of bytes (fixed values): blanks part words, the others pieces.
BLANK = np.isin(np.arange(256), [0x20, 0x09])
BREAK = np.isin(np.arange(256), [*b".,;:!?", *range(0x0A, 0x0E)])
INSIDE = ~(BLANK | BREAK)
#: Bytes of text in a slice; pairs counted at a time (more cost memory, not rows); side of a tile, and tiles along a side of the head.
SLICE, PAIRS, SIDE, HEAD = 4 << 20, 1 << 20, 1024, 8


# -- texts to arrays ----------------------------------------------------------------------------


def coded_words(values: np.ndarray, edges: np.ndarray, langs: pa.Array, begin: int = 0) -> tuple:
    """One slice: symbols (word and language) at every place, -1 between pieces, and what they are.

    Returns codes, the number of leading ones before byte ``begin``, and of each symbol the word, the language and its
    occurrences from ``begin`` on.
    """
    starts, stops = word_spans(values, edges, INSIDE)
    text = np.searchsorted(edges, starts, "right") - 1
    breaks = np.flatnonzero(BREAK[values])
    piece = np.searchsorted(breaks, starts)
    apart = np.r_[True, (piece[1:] != piece[:-1]) | (text[1:] != text[:-1])][: len(starts)]
    words = word_array(values, starts, stops, INSIDE).dictionary_encode()
    names = pc.fill_null(langs, "und").dictionary_encode()
    lang = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n = max(len(names.dictionary), 1)
    symbols, code = np.unique(words.indices.to_numpy(zero_copy_only=False).astype(np.int64) * n + lang[text], return_inverse=True)
    place = np.arange(len(starts)) + np.cumsum(apart)
    codes = np.full(len(starts) + int(apart.sum()), -1, np.int32)
    codes[place] = code
    old = int(np.searchsorted(starts, begin))
    skip = int(place[old]) if old < len(starts) else len(codes)
    seen = np.bincount(code[old:], minlength=len(symbols))
    return codes, skip, words.dictionary.take(pa.array(symbols // n)), names.dictionary.take(pa.array(symbols % n)), seen


def slices(docs: DataFrame, text: str, lang: str, carry: int) -> DataFrame:
    """Texts as slices of symbols.

    A text longer than a slice covers several; each then begins with the last ``carry`` words before it,
    which ``skip`` tells from its own.
    """
    schema = "slice long, skip int, codes binary, words array<string>, langs array<string>, seen array<long>"

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch, texts in text_slices(batches, "_text", SLICE):
            values, edges = text_bytes(texts)
            for values, edges, begin in carried(values, edges, carry):
                codes, skip, *columns = coded_words(values, edges, batch.column(1), begin)
                row = [[number], [skip], [codes.tobytes()], *([c if isinstance(c, pa.Array) else pa.array(c, pa.int64())] for c in columns)]
                kinds = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) if i < 3 else pa.ListArray.from_arrays(pa.array([0, len(x[0])], pa.int32()), x[0]) for i, (x, k) in enumerate(zip(row, kinds, strict=True))], names=["slice", "skip", "codes", "words", "langs", "seen"])
                number += 1

    return docs.select(F.col(text).alias("_text"), F.col(lang).cast("string").alias("_lang")).mapInArrow(code, schema)


def carried(values: np.ndarray, edges: np.ndarray, carry: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """A slice as it is, or one long text in parts that overlap by ``carry`` words."""
    if len(edges) != 2 or len(values) <= SLICE:
        yield values, edges, 0
        return
    back = 0
    for at, stop in parts(values, ~INSIDE, SLICE):
        here = values[back:stop]
        ends = np.array([0, len(here)])
        yield here, ends, at - back
        starts, _ = word_spans(here, ends, INSIDE)
        back = back + int(starts[-carry:][0]) if len(starts) and carry else stop


# -- counting -----------------------------------------------------------------------------------


def tile_counts(keys: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells of a table ``width`` wide and how often each occurs.

    Of the tiles in the table's head, those with many pairs are counted over all their cells at
    once; all other cells are sorted.
    """
    first, second = np.divmod(keys, width)
    edge = HEAD * SIDE
    head = (first < edge) & (second < edge)
    tile = np.where(head, first // SIDE * HEAD + second // SIDE, HEAD * HEAD).astype(np.uint8)
    sizes = np.bincount(tile, minlength=HEAD * HEAD + 1)
    order = np.argsort(tile, kind="stable")
    ends = np.cumsum(sizes)
    cells, counts, rest = [], [], []
    for number in np.flatnonzero(sizes):
        held = order[ends[number] - sizes[number] : ends[number]]
        if number < HEAD * HEAD and sizes[number] * 8 >= SIDE * SIDE:
            a, b = first[held] % SIDE, second[held] % SIDE
            dense = np.bincount(a * SIDE + b, minlength=SIDE * SIDE)
            full = np.flatnonzero(dense)
            cells.append((number // HEAD * SIDE + full // SIDE) * width + number % HEAD * SIDE + full % SIDE)
            counts.append(dense[full])
        else:
            rest.append(keys[held])
    ordered = np.sort(np.concatenate(rest)) if rest else np.zeros(0, np.int64)
    at = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]][: len(ordered)])
    return np.concatenate([*cells, ordered[at]]), np.concatenate([*counts, np.diff(np.r_[at, len(ordered)])]).astype(np.int64)


def pair_places(grams: np.ndarray, words: np.ndarray, skip: int) -> np.ndarray:
    """Places where a phrase ends that is one word longer than ``grams``: its first part, its last
    part and its last word are frequent, and its last word is the slice's own."""
    fits = (grams[:-1] >= 0) & (grams[1:] >= 0) & (words[1:] >= 0)
    at = np.flatnonzero(fits) + 1
    return at[at >= skip]


def unpacked(words: pa.BinaryScalar, grams: pa.BinaryScalar) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of words and of phrases at the places of a slice; the phrases are the words at first."""
    words = np.frombuffer(words.as_buffer(), np.int32)
    return words, words if not grams.is_valid else np.frombuffer(grams.as_buffer(), np.int32 if len(grams.as_buffer()) == 4 * len(words) else np.int64)


def counted(placed: DataFrame, width: int) -> DataFrame:
    """How often every pair of a phrase and the word behind it occurs: ``key``, ``f``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in tile_counts(np.concatenate(held), width)], names=["key", "f"])

        for batch in batches:
            for skip, words, grams in zip(*(batch.column(c) for c in ("skip", "words", "grams")), strict=True):
                words, grams = unpacked(words, grams)
                at = pair_places(grams, words, skip.as_py())
                for block in range(0, len(at), PAIRS):
                    some = at[block : block + PAIRS]
                    held.append(grams[some - 1].astype(np.int64) * width + words[some])
                    size += len(some)
                    if size >= PAIRS:
                        yield done()
                        held, size = [], 0
        if size:
            yield done()

    return placed.mapInArrow(count, "key long, f long").groupBy("key").agg(F.sum("f").alias("f"))


def numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """The rows with a dense number ``id`` from 0 in an order, saved."""
    out = saved(prefix_sums(df.withColumn("_one", F.lit(1)), [], order, "_one", "id").drop("_one"), name)
    return out.withColumn("id", F.col("id").cast("long"))


def key_filter(level: DataFrame, bits: int = 24) -> np.ndarray:
    """Bitmap of fixed size (2 MB) of the hashes of all keys."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(1 << bits - 5, np.uint32)
        for batch in batches:
            place = hashed(batch.column(0).to_numpy(), bits)
            np.bitwise_or.at(own, place >> 5, np.uint32(1) << (place & 31).astype(np.uint32))
        full = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(own[full].astype(np.int64))], names=["place", "bits"])

    found = level.select("key").mapInArrow(look, "place long, bits long").groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << bits - 5, np.uint32)
    out[found.column(0).to_numpy()] = found.column(1).to_numpy().astype(np.uint32)
    return out


def hashed(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


# -- numbers back to the slices -----------------------------------------------------------------


def placed_words(coded: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Slices as numbers of frequent words, -1 elsewhere. Only distinct words of a slice meet the vocabulary."""
    each = coded.select("slice", F.posexplode(F.arrays_zip("words", "langs")).alias("code", "symbol"))
    found = each.select("slice", "code", "symbol.*").withColumnsRenamed({"words": "phrase", "langs": "lang"}).join(vocabulary.select("lang", "phrase", "id"), ["lang", "phrase"]).select(F.col("slice").alias("of"), "code", "id")

    def place(left: pa.Table, right: pa.Table) -> pa.Table:
        codes = np.frombuffer(left.column("codes")[0].as_buffer(), np.int32)
        ids = np.full(codes.max(initial=-1) + 2, -1, np.int32)  # the last one for the place between pieces
        ids[right.column("code").to_numpy()] = right.column("id").to_numpy()
        return pa.table({"slice": left.column("slice"), "skip": left.column("skip"), "words": [ids[codes].tobytes()], "grams": pa.nulls(1, pa.binary())})

    schema = "slice long, skip int, words binary, grams binary"
    return coded.select("slice", "skip", "codes").groupBy("slice").cogroup(found.groupBy("of")).applyInArrow(place, schema)


def placed_phrases(placed: DataFrame, level: DataFrame, width: int) -> DataFrame:
    """Slices with the numbers of frequent phrases that end at each place, one word longer than before.

    A slice's distinct pairs pass a bitmap of fixed size before they are shuffled, so few others move;
    the join that follows is exact however full the bitmap is.
    """
    bitmap = placed.sparkSession.sparkContext.broadcast(key_filter(level))
    kind = np.int32 if level.count() < 1 << 31 else np.int64

    def keys_of(words, grams) -> tuple[np.ndarray, np.ndarray]:
        words, grams = unpacked(words, grams)
        at = pair_places(grams, words, 0)
        return at, grams[at - 1].astype(np.int64) * width + words[at]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = int(np.log2(len(bitmap.value))) + 5
        for batch in batches:
            for number, words, grams in zip(*(batch.column(c) for c in ("slice", "words", "grams")), strict=True):
                _, keys = keys_of(words, grams)
                place = hashed(keys, bits)
                keys = np.unique(keys[(bitmap.value[place >> 5] >> (place & 31).astype(np.uint32) & 1).astype(bool)])
                yield pa.RecordBatch.from_arrays([pa.repeat(number, len(keys)), pa.array(keys)], names=["slice", "key"])

    found = placed.mapInArrow(look, "slice long, key long").join(level.select("key", "id"), "key").select(F.col("slice").alias("of"), "key", "id")

    def place(left: pa.Table, right: pa.Table) -> pa.Table:
        words, grams = left.column("words")[0], left.column("grams")[0]
        at, keys = keys_of(words, grams)
        order = np.argsort(right.column("key").to_numpy())
        known, ids = right.column("key").to_numpy()[order], right.column("id").to_numpy()[order]
        out = np.full(len(words.as_buffer()) // 4, -1, kind)
        if len(known):
            here = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            out[at] = np.where(known[here] == keys, ids[here], -1)
        return pa.table({"slice": left.column("slice"), "skip": left.column("skip"), "words": [words.as_py()], "grams": [out.tobytes()]})

    return placed.groupBy("slice").cogroup(found.groupBy("of")).applyInArrow(place, placed.schema)


# -- phrases and scores -------------------------------------------------------------------------


def described(level: DataFrame, shorter: DataFrame, words: DataFrame, width: int) -> DataFrame:
    """Phrases one word longer than ``shorter``, with the counts of their first parts and rests by cut."""
    split = level.select("id", "f", F.expr(f"key div {width}L").alias("pre"), F.expr(f"key % {width}L").alias("last"))
    first = shorter.select(F.col("id").alias("pre"), "lang", F.col("phrase").alias("_first"), F.col("f").alias("_f"), F.col("lefts").alias("_lefts"), F.col("rest").alias("_rest"))
    last = words.select(F.col("id").alias("last"), F.col("phrase").alias("_last"), F.col("f").alias("_last_f"))
    both = split.join(first, "pre").join(last, "last")
    if "pre" in shorter.columns:
        rest = shorter.select(F.col("pre").alias("_rest"), "last", F.col("id").alias("rest"), F.col("f").alias("_rest_f"), F.col("rights").alias("_rights"))
        both = both.join(rest, ["_rest", "last"])
        rights = F.concat(F.array("_rest_f"), "_rights")
    else:
        both = both.withColumn("rest", F.col("last"))
        rights = F.array("_last_f")
    phrase = F.concat_ws(" ", "_first", "_last")
    return both.select("id", "lang", phrase.alias("phrase"), "f", "pre", "last", "rest", F.concat("_lefts", F.array("_f")).alias("lefts"), rights.alias("rights"))


#: Of all cuts the one with the lowest score, of these the first; exact beyond 64 bits.
CUT = """array_min(transform(arrays_zip(lefts, rights), (x, k) -> struct(
    CAST((CAST(1000000 AS DECIMAL(7,0)) * CAST(f AS DECIMAL(15,0)) * CAST(f AS DECIMAL(15,0))) div
         (CAST(x.lefts AS DECIMAL(19,0)) * CAST(x.rights AS DECIMAL(19,0))) AS BIGINT) AS score, k AS k, x.lefts AS l, x.rights AS r)))"""


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", max_words: int = 3, least: int = 10, cover: int = 50, top: int = 2000) -> DataFrame:
    """The phrases of each language whose words belong together, best first.

    A-Z are lower-cased; full stops, commas, semicolons, colons, exclamation and question marks and line
    ends part a text into pieces, blanks and tabs a piece into words. Candidates are the phrases of 2 to
    ``max_words`` words that occur ``least`` times or more within pieces. Cut after a word, a phrase with a occurrences
    whose parts have l and r scores floor(1000000 a a / (l r)); its lowest cut counts. A candidate is
    dropped if a longer one holds it and has ``cover`` percent of its occurrences or more. Returns
    ``lang``, ``rank`` (from 1), ``phrase``, ``a``, ``l``, ``r``, ``n`` (all words of the language), ``score``: the
    first ``top`` by score, occurrences and phrase.

    A null language is ``und``, null and empty texts have no words, repeated rows count each, an
    empty table or one without candidates gives no rows. Counts cover all texts; a text longer than a slice is cut into
    slices that overlap. Tables of words and phrases are joined and sorted by range, never gathered.
    """
    if max_words < 2 or least < 1:
        raise ValueError("phrases have at least 2 words and 1 occurrence")
    coded = saved(slices(docs, text, lang, max_words - 1), "slices")
    each = coded.select(F.explode(F.arrays_zip("words", "langs", "seen")).alias("symbol")).select("symbol.*")
    counts = saved(each.groupBy(F.col("langs").alias("lang"), F.col("words").alias("phrase")).agg(F.sum("seen").alias("f")), "words")
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    words = numbered(counts.filter(F.col("f") >= least), [F.desc("f"), "lang", "phrase"], "vocabulary")
    width = max(words.count(), 1)
    if width >= 1 << 31:
        raise ValueError(f"{width} words occur {least} times or more; raise the least number")
    placed = saved(placed_words(coded, words), "placed")
    forget(coded)
    shorter = words.select("id", "lang", "phrase", "f", F.array().cast("array<long>").alias("lefts"), F.lit(None).cast("long").alias("rest"))
    kept = []
    for length in range(2, max_words + 1):
        level = saved(counted(placed, width).filter(F.col("f") >= least), "phrases")
        if length < max_words:
            level = numbered(level, [F.desc("f"), "key"], "phrases")
            before, placed = placed, saved(placed_phrases(placed, level, width), "placed")
            forget(before)
        else:
            level = level.withColumn("id", F.lit(None).cast("long"))
        longer = saved(described(level, shorter, words, width), "described")
        if kept:
            inside = longer.select(F.explode(F.array("pre", "rest")).alias("id"), F.col("f").alias("_longer")).groupBy("id").agg(F.max("_longer").alias("_longer"))
            free = F.coalesce(100 * F.col("_longer") < cover * F.col("f"), F.lit(True))
            kept[-1] = kept[-1].join(inside, "id", "left").filter(free).drop("_longer")
        kept.append(longer)
        shorter = longer
    forget(placed)
    scored = None
    for level in kept:
        rows = level.select("lang", "phrase", F.col("f").alias("a"), F.expr(CUT).alias("cut"))
        rows = rows.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
        scored = rows if scored is None else scored.unionByName(rows)
    scored = saved(scored, "scored").withColumn("_one", F.lit(1))
    ranked = prefix_sums(scored, ["lang"], [F.desc("score"), F.desc("a"), "phrase"], "_one", "rank").filter(F.col("rank") < top)
    return ranked.join(totals, "lang").select("lang", (F.col("rank") + 1).cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
