"""BPE encoding and decoding in batched numpy merge rounds.

The distinct chunks (runs without ASCII white space) of a batch of texts are cut into words by
character class. The symbols of all words lie in one flat array. A round looks up neighbouring
pairs by binary search over the sorted keys of the merge list, finds each word's lowest rank and
merges that pair at all its places in all words at once. A word leaves when no pair of it merges. A merge
forms only pairs that rank behind it, so a round gives what merging one by one from the left does.

Chunks that hold a special string, a code point that Python's Unicode tables don't know or a combining
mark younger than Unicode 3.2 are encoded by the tokenizer library, whose Unicode version may be another; no
chunk's tokens depend on another's.
"""

from __future__ import annotations

import hashlib
import json
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardgrid.llm.common import text_bytes, text_slices
from hazardgrid.llm.token_counts import PATTERN, gathered

NEVER = np.int32(1 << 30)
SPACE, LETTER, NUMBER, OTHER, UNKNOWN = range(5)
#: ASCII white space, which separates chunks.
BLANKS = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Bytes of text, and ids, worked on at a time.
SLICE, BLOCK = 4 << 20, 1 << 19


def character_classes() -> np.ndarray:
    """Class of every code point, as the vocabulary's pattern tells them apart.

    ``UNKNOWN`` are those without a class here and the combining marks younger than Unicode 3.2, whose
    order among other marks depends on the version a library was built for.
    """

    def of(c: str) -> int:
        kind = unicodedata.category(c)
        if kind == "Cn" or unicodedata.combining(c) and not unicodedata.ucd_3_2_0.combining(c):
            return UNKNOWN
        if c.isspace() and not "\x1c" <= c <= "\x1f":
            return SPACE
        return {"L": LETTER, "N": NUMBER}.get(kind[0], OTHER)

    return np.array([of(chr(c)) for c in range(sys.maxunicode + 1)], np.int8)


class Codec:
    """A lower-casing word-end BPE vocabulary as arrays that travel with a task."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            self.spec = file.read()
        spec = json.loads(self.spec)
        model, self.end = spec["model"], spec["model"]["end_of_word_suffix"]
        splits = [s["pattern"]["Regex"] for s in spec["pre_tokenizer"]["pretokenizers"] if s["type"] == "Split"]
        steps = [s["type"] for s in spec["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"] or splits != [PATTERN] or model["type"] != "BPE" or not self.end or spec["decoder"]:
            raise ValueError(f"{path} isn't a lower-casing word-end BPE")
        self.special = [t["content"] for t in spec["added_tokens"]]
        vocab = model["vocab"]
        # Bytes that print stand for themselves, the others for the code points from 256 on.
        shown = np.isin(np.arange(256), [*range(33, 127), *range(161, 173), *range(174, 256)])
        letter = [chr(b) if shown[b] else chr(256 + int((~shown[:b]).sum())) for b in range(256)]
        self.inner = np.array([vocab[c] for c in letter], np.int32)
        self.final = np.array([vocab[c + self.end] for c in letter], np.int32)
        self._sort_pairs([(vocab[a], vocab[b], vocab[a + b]) for a, b in model["merges"]], path)
        names = vocab | {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = self._token_bytes(names)
        self.classes = character_classes()
        self._library = None

    def _sort_pairs(self, merges: list[tuple[int, int, int]], path: str) -> None:
        table = np.array(merges, np.int64).reshape(-1, 3)
        made = np.full(table.max(initial=0) + 1, -1)
        made[table[:, 2]] = np.arange(len(table))
        if (np.maximum(made[table[:, 0]], made[table[:, 1]]) >= np.arange(len(table))).any() or len(np.unique(table[:, 2])) < len(table):
            raise ValueError(f"{path}: the merge list uses a symbol before it makes it")
        keys = table[:, 0] << 32 | table[:, 1]
        self.ranks = np.argsort(keys).astype(np.int32)
        self.keys = keys[self.ranks]
        self.merged = table[:, 2].astype(np.int32)

    @staticmethod
    def _token_bytes(names: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of every token with a blank behind, offsets by id, and which ids exist."""
        forms = [b""] * (max(names.values()) + 1)
        for name, at in names.items():
            forms[at] = name.encode() + b" "
        edges = np.r_[0, np.cumsum([len(x) for x in forms])].astype(np.int64)
        return np.frombuffer(b"".join(forms), np.uint8), edges, np.array([bool(x) for x in forms])

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_library": None}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NEVER`` for those that don't merge: binary search over the sorted keys."""
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NEVER)

    def merge(self, values: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words given as UTF-8 bytes and n + 1 offsets (no word empty): ids and n + 1 offsets."""
        n = len(edges) - 1
        symbol = self.inner[values]
        symbol[edges[1:] - 1] = self.final[values[edges[1:] - 1]]
        word = np.repeat(np.arange(n, dtype=np.int32), np.diff(edges))
        inside = np.r_[word[1:] == word[:-1], False][: len(word)]
        rank = np.full(len(symbol), NEVER, np.int32)  # of the pair that begins here
        todo = np.flatnonzero(inside)
        words_out, ids_out = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        while len(symbol):
            rank[todo] = self.rank(symbol[todo], symbol[todo + 1])
            begins = np.flatnonzero(np.r_[True, ~inside[:-1]])
            sizes = np.diff(np.r_[begins, len(symbol)])
            low = np.minimum.reduceat(rank, begins)
            left = np.repeat(low == NEVER, sizes)
            words_out.append(word[left])
            ids_out.append(symbol[left])
            low = np.repeat(low, sizes)[~left]
            symbol, word, inside, rank = symbol[~left], word[~left], inside[~left], rank[~left]
            here = np.flatnonzero(rank == low)
            if not len(here):
                break
            here = alternate(here)
            symbol[here] = self.merged[rank[here]]
            inside[here] = inside[here + 1]
            stays = np.ones(len(symbol), bool)
            stays[here + 1] = False
            # The pairs of a merged symbol with its neighbours are new.
            new = np.zeros(len(symbol), bool)
            new[here] = True
            before = here[(here > 0)] - 1
            before = np.where(stays[before], before, before - 1)
            new[before[before >= 0]] = True
            rank[here] = NEVER
            symbol, word, inside, rank, new = symbol[stays], word[stays], inside[stays], rank[stays], new[stays]
            todo = np.flatnonzero(new & inside)
        words, ids = np.concatenate(words_out), np.concatenate(ids_out)
        order = np.argsort(words, kind="stable")
        return ids[order], np.r_[0, np.cumsum(np.bincount(words, minlength=n))].astype(np.int64)

    def words(self, chunks: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Words of all chunks in a row, and how many each chunk has.

        Runs of letters, single numbers, runs of other characters; an apostrophe that would begin such
        a run begins a contraction instead where one follows.
        """
        rows = pa.ListArray.from_arrays(pa.array([0, len(chunks)], pa.int32()), chunks)
        text = unicodedata.normalize("NFC", pc.binary_join(rows, "\n")[0].as_py()).replace("Σ", "σ").lower() + "\n"
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        kind = self.classes[code]
        before = np.r_[np.int8(SPACE), kind[:-1]]
        starts = (kind != before) | (kind == NUMBER) | (kind == SPACE)
        mark = np.flatnonzero((code == ord("'")) & (before != OTHER))
        if len(mark):
            ahead = np.r_[code, np.zeros(2, np.uint32)]
            one, two = ahead[mark + 1], ahead[mark + 2]
            size = np.where(np.isin(one, [ord(x) for x in "stmd"]), 2, 0)
            for x, y in ("re", "ve", "ll"):
                size[(one == ord(x)) & (two == ord(y))] = 3
            mark, size = mark[size > 0], size[size > 0]
            starts[mark + 1] = False
            starts[mark + size] = True
        first = np.flatnonzero(starts)
        blank = kind[first] == SPACE
        place = np.r_[0, np.cumsum(1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000))]
        edges = np.r_[place[first], place[-1]].astype(np.int32)
        every = pa.StringArray.from_buffers(len(first), pa.py_buffer(edges), pa.py_buffer(text.encode()))
        chunk = np.cumsum(code[first] == ord("\n"))[~blank]
        return every.filter(pa.array(~blank)), np.bincount(chunk, minlength=len(chunks))

    def _odd(self, chunks: pa.Array) -> np.ndarray:
        """Places of the chunks that the library encodes."""
        values, edges = text_bytes(chunks)
        found = np.zeros(len(chunks), bool)
        for special in self.special:
            found |= pc.match_substring(chunks, special).to_numpy(zero_copy_only=False)
        wide = np.flatnonzero(np.add.reduceat(np.r_[values >= 0xCC, False], edges[:-1]) * (np.diff(edges) > 0)) if len(chunks) else []
        for at in wide:
            code = np.frombuffer(chunks[int(at)].as_py().encode("utf-32-le"), np.uint32)
            found[at] |= (self.classes[code] == UNKNOWN).any()
        return np.flatnonzero(found)

    def library(self, chunks: list[str]) -> list[np.ndarray]:
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.spec)
            self._library.no_padding()
            self._library.no_truncation()
        return [np.array(e.ids, np.int32) for e in self._library.encode_batch(chunks, add_special_tokens=False)]

    def of_chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks without white space: ids and n + 1 offsets."""
        if not len(chunks):
            return np.zeros(0, np.int32), np.zeros(1, np.int64)
        odd = self._odd(chunks)
        rest = self.library(chunks.take(pa.array(odd)).to_pylist()) if len(odd) else []
        if rest:
            keep = np.ones(len(chunks), bool)
            keep[odd] = False
            chunks = pc.if_else(pa.array(keep), chunks, "")
        words, n = self.words(chunks)
        distinct = words.dictionary_encode()
        ids, edges = self.merge(*text_bytes(distinct.dictionary))
        ids, edges = gathered(ids, edges, distinct.indices.to_numpy(zero_copy_only=False).astype(np.int64))
        edges = edges[np.r_[0, np.cumsum(n)]]
        if not rest:
            return ids, edges
        pick = np.arange(len(chunks))
        pick[odd] = len(chunks) + np.arange(len(odd))
        longer = np.r_[edges, len(ids) + np.cumsum([len(x) for x in rest])].astype(np.int64)
        return gathered(np.concatenate([ids, *rest]), longer, pick)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without nulls: ids (int32) and n + 1 offsets."""
        if not len(texts):
            return np.zeros(0, np.int32), np.zeros(1, np.int64)
        parts = pc.ascii_split_whitespace(texts)
        of_text = parts.offsets.to_numpy().astype(np.int64)
        chunks = parts.values.slice(of_text[0], of_text[-1] - of_text[0]).dictionary_encode()
        ids, edges = self.of_chunks(chunks.dictionary)
        ids, edges = gathered(ids, edges, chunks.indices.to_numpy(zero_copy_only=False).astype(np.int64))
        return ids, edges[of_text - of_text[0]]

    def decode(self, ids: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts of ragged ids as UTF-8 bytes and n + 1 offsets: the tokens with a blank between two.

        Ids that the vocabulary doesn't have are left out.
        """
        values, token_edges, known = self.tokens
        real = (ids >= 0) & (ids < len(known))
        real[real] = known[ids[real]]
        if not real.all():
            edges = np.r_[0, np.cumsum(real)][edges]
            ids = ids[real]
        blocks = [gathered(values, token_edges, ids[at : at + BLOCK])[0] for at in range(0, len(ids), BLOCK)]
        joined = np.concatenate(blocks) if blocks else np.zeros(0, np.uint8)
        ends = np.r_[0, np.cumsum(np.diff(token_edges)[ids])][edges]
        full = np.diff(ends) > 0
        stays = np.ones(len(joined), bool)
        stays[ends[1:][full] - 1] = False  # the blank behind the last token
        return joined[stays], ends - np.r_[0, np.cumsum(full)]


def alternate(here: np.ndarray) -> np.ndarray:
    """Places to merge; of a run of overlapping ones (a symbol repeated) every second from its start."""
    touch = np.r_[False, np.diff(here) == 1]
    if not touch.any():
        return here
    at = np.arange(len(here))
    return here[(at - np.maximum.accumulate(np.where(touch, 0, at))) % 2 == 0]


def pieces(texts: pa.Array, most: int) -> Iterator[pa.Array]:
    """A text longer than ``most`` bytes as several, cut before white space; others whole."""
    values, _ = text_bytes(texts)
    at = 0
    while at < len(values) or at == 0:
        stop = min(at + most, len(values))
        if stop < len(values):
            blank = np.flatnonzero(BLANKS[values[at + 1 : stop]])
            if len(blank):
                stop = at + 1 + int(blank[-1])
            else:  # one run longer than ``most``
                while stop < len(values) and not BLANKS[values[stop]]:
                    stop += 1
        yield pa.StringArray.from_buffers(1, pa.py_buffer(np.array([0, stop - at], np.int32)), pa.py_buffer(values[at:stop].tobytes()))
        at = max(stop, 1)


def _binary(values: np.ndarray, edges: np.ndarray, kind: pa.DataType) -> pa.Array:
    wide = pa.types.is_large_binary(kind) or pa.types.is_large_string(kind)
    buffers = [None, pa.py_buffer(edges.astype(np.int64 if wide else np.int32)), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.Array.from_buffers(kind, len(edges) - 1, buffers)


def _types(rows: DataFrame, keep: int, name: str, kind: str) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:keep]) + f"`{name}` {kind}"


def bpe_encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Token ids of every whole text, with the columns in ``keep``.

    ``out`` is BINARY, the ids as little-endian unsigned 32-bit numbers in a row. Ids are those of the tokenizer
    library for the vocabulary at ``path``, without added special tokens; special strings inside texts are
    those tokens. A null text counts as empty and has no ids. One row per row, repeated rows and
    an empty table included. One pass without a shuffle; a task holds the symbols of about 4 MB of text at a time, of
    a longer text, too, as that is cut at white space.
    """
    codec = Codec(path)
    names = [f"_k{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)], F.col(text).alias("_text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "_text", SLICE):
            if len(texts) == 1:
                ids = np.concatenate([codec.encode(part)[0] for part in pieces(texts, SLICE)])
                edges = np.array([0, len(ids)])
            else:
                ids, edges = codec.encode(texts)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], _binary(ids.astype("<u4").view(np.uint8), edges * 4, pa.binary())], names=[*names, out])

    done = rows.mapInArrow(encode, _types(rows, len(keep), out, "binary"))
    return done.select(*[F.col(n).alias(c) for n, c in zip(names, keep, strict=True)], out)


def bpe_decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The text of a column of ids as ``bpe_encode`` makes it, behind the frame's other columns.

    The library's decoding without skipped special tokens: this vocabulary has no decoder, so a text is its
    tokens, word ends and byte letters as they are, with a blank between two. Null ids give an empty
    text, ids beyond the vocabulary nothing.
    """
    codec = Codec(path)
    others = [c for c in df.columns if c != out]
    names = [f"_k{i}" for i in range(len(others))]
    rows = df.select(*[F.col(c).alias(n) for c, n in zip(others, names, strict=True)], F.coalesce(F.col(ids), F.lit(b"")).alias("_ids"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, packed in text_slices(batches, "_ids", 2 * SLICE):
            values, edges = text_bytes(packed)
            text, ends = codec.decode(np.ascontiguousarray(values).view("<u4").astype(np.int64), edges // 4)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], _binary(text, ends, pa.string())], names=[*names, out])

    done = rows.mapInArrow(decode, _types(rows, len(others), out, "string"))
    return done.select(*[F.col(n).alias(c) for n, c in zip(names, others, strict=True)], out)


def id_count(ids: str = "ids") -> Column:
    return (F.octet_length(ids) / 4).cast("long")


def digest(ids: np.ndarray) -> str:
    """SHA-256 of ids as the query reports it, for comparisons."""
    return hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
