"""Token counts by rank-synchronous array merging.

A batch of texts is cut at white space, and every distinct chunk is tokenised once. Its pre-tokens
are held as one ragged numpy array of symbols. A round looks up the rank of every neighbouring pair,
takes each pre-token's lowest rank and merges all its places at once; the symbols that survive are
the tokens. A merge can only form pairs that rank behind it, since the merge list makes a symbol
before it uses it, so merging all places of the lowest pair together gives what one-by-one merging
from the left gives.

Chunks whose characters this module doesn't normalise itself (special strings, combining marks,
emoji, scripts beyond Latin, Greek and Cyrillic) go to the tokenizer library, one distinct chunk once. No
chunk's tokens depend on another's: white space separates pre-tokens and never becomes one.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardgrid.llm.common import text_bytes, text_slices

_NONE = np.int64(1 << 40)
#: The vocabulary's word pattern (fixed value), which ``Tokens.pieces`` follows.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Chunks for the library: characters not normalised here, two whose lower case depends on
#: context or is two characters, and two (U+023A, U+023E) whose lower case is beyond the class table.
_ODD = r"[^\x00-\x{2ff}\x{370}-\x{52f}\x{2010}-\x{2027}\x{2030}-\x{205e}\x{20a0}-\x{20bf}]|İ|Σ|Ⱥ|Ⱦ|<\|"
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)


class MergeTable:
    """Merge ranks of a word-end BPE vocabulary in arrays, small enough to travel with a task."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, vocab = spec["model"], spec["model"]["vocab"]
        end = model["end_of_word_suffix"]
        steps = [s["pattern"]["Regex"] for s in spec["pre_tokenizer"]["pretokenizers"] if s["type"] == "Split"]
        kinds = [s["type"] for s in spec["normalizer"]["normalizers"]]
        if len(steps) != 1 or kinds != ["NFC", "Replace", "Lowercase"] or model["type"] != "BPE" or not end:
            raise ValueError(f"{path} isn't a lower-casing word-end BPE")
        self.pattern = steps[0]
        self.special = [t["content"] for t in spec["added_tokens"]]
        if any("<|" not in s or regex.search(r"\s", s) for s in self.special):
            raise ValueError(f"{path}: special strings of an unknown form")
        # Bytes that print stand for themselves, the others for the code points from 256 on.
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        hidden = [b for b in range(256) if b not in set(shown)]
        char = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.first = np.array([vocab[char[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[char[b] + end] for b in range(256)], np.int64)
        self.width = max(vocab.values()) + 1
        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in model["merges"]]
        made = {c: rank for rank, (_, _, c) in enumerate(pairs)}
        if len(made) != len(pairs) or any(max(made.get(a, -1), made.get(b, -1)) >= rank for rank, (a, b, _) in enumerate(pairs)):
            raise ValueError(f"{path}: the merge list uses a symbol before it makes it")
        self.merged = np.array([c for _, _, c in pairs], np.int64)
        self._index(np.array([a * self.width + b for a, b, _ in pairs], np.uint64))

    def _index(self, keys: np.ndarray) -> None:
        """Open-addressed hash table of the pairs."""
        self.bits = int(np.ceil(np.log2(len(keys) * 6 + 16)))
        size = 1 << self.bits
        self.slots, self.ranks = np.full(size, np.iinfo(np.uint64).max, np.uint64), np.full(size, _NONE, np.int64)
        todo, self.probes = np.arange(len(keys)), 0
        while len(todo):
            at = (self._slot(keys[todo]) + self.probes) & (size - 1)
            free = self.ranks[at] == _NONE
            first = np.zeros(len(todo), bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = free & first
            self.slots[at[put]], self.ranks[at[put]] = keys[todo[put]], todo[put]
            todo = todo[~put]
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.uint64) * np.uint64(self.width) + right.astype(np.uint64)
        at = self._slot(keys)
        found = self.slots[at]
        out = np.where(found == keys, self.ranks[at], _NONE)
        todo = np.flatnonzero((found != keys) & (self.ranks[at] != _NONE))
        for probe in range(1, self.probes):
            here = (at[todo] + probe) & (len(self.slots) - 1)
            match = self.slots[here] == keys[todo]
            out[todo[match]] = self.ranks[here[match]]
            todo = todo[~match & (self.ranks[here] != _NONE)]
        return out

    def merge(self, values: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of pre-tokens given as UTF-8 bytes and n + 1 offsets: token ids and n + 1 offsets."""
        n = len(edges) - 1
        lengths = np.diff(edges)
        symbols = self.first[values]
        full = lengths > 0
        symbols[edges[1:][full] - 1] = self.last[values[edges[1:][full] - 1]]
        word = np.repeat(np.arange(n), lengths)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        ranks = np.full(len(symbols), _NONE, np.int64)  # of the pair that starts here
        look = np.flatnonzero(word[:-1] == word[1:])
        while len(symbols):
            ranks[look] = self.rank(symbols[look], symbols[look + 1])
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.repeat(np.minimum.reduceat(ranks, starts), np.diff(np.r_[starts, len(symbols)]))
            over = lowest == _NONE
            if over.any():
                done.append((word[over], symbols[over]))
                symbols, word, ranks, lowest = (x[~over] for x in (symbols, word, ranks, lowest))
                if not len(symbols):
                    break
            hit = ranks == lowest
            if (hit[1:] & hit[:-1]).any():  # a run of one symbol: every second place from its start
                begins = hit & ~np.r_[False, hit[:-1]]
                here = np.arange(len(hit))
                hit &= (here - np.maximum.accumulate(np.where(begins, here, 0))) % 2 == 0
            at = np.flatnonzero(hit)
            symbols[at] = self.merged[ranks[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, word, ranks = symbols[keep], word[keep], ranks[keep]
            at = (np.cumsum(keep) - 1)[at]  # where the merged symbols are now
            ranks[at] = _NONE
            # Only pairs beside a merged symbol are new.
            new = np.zeros(len(symbols), bool)
            new[at] = new[at[at > 0] - 1] = True
            new[:-1] &= word[:-1] == word[1:]
            new[-1] = False
            look = np.flatnonzero(new)
        owner = np.concatenate([w for w, _ in done]) if done else np.zeros(0, np.int64)
        tokens = np.concatenate([s for _, s in done]) if done else np.zeros(0, np.int64)
        order = np.argsort(owner, kind="stable")
        return tokens[order], np.r_[0, np.cumsum(np.bincount(owner, minlength=n))].astype(np.int64)


def gathered(values: np.ndarray, edges: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``pick`` of a ragged array, one behind the other, and their offsets."""
    lengths = np.diff(edges)[pick]
    out = np.r_[0, np.cumsum(lengths)].astype(np.int64)
    if not out[-1]:
        return values[:0], out
    at = np.repeat(edges[:-1][pick] - out[:-1], lengths)
    at += np.arange(out[-1])
    return values[at], out


class Tokens:
    """Token ids of texts, by the merge table and, for unusual chunks, by the library."""

    def __init__(self, merges: MergeTable):
        self.merges, self._library = merges, None
        if merges.pattern != PATTERN:
            raise ValueError(f"{merges.path} cuts words by another pattern")
        chars = [chr(c) for c in range(0x20C0)]
        self.kinds = np.array([_SPACE if regex.match(r"\s", c) else _LETTER if regex.match(r"\p{L}", c) else _NUMBER if regex.match(r"\p{N}", c) else _OTHER for c in chars], np.int8)

    def library(self, chunks: list[str]) -> list[list[int]]:
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.merges.path)
            self._library.no_padding()
            self._library.no_truncation()
        return [e.ids for e in self._library.encode_batch(chunks, add_special_tokens=False)]

    def pieces(self, chunks: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Pre-tokens of all chunks as one array, and the number of pieces of each chunk.

        The pattern as array operations on character classes: runs of letters, single numbers, runs
        of other characters; an apostrophe that begins such a run may begin a contraction instead.
        """
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(chunks)], pa.int32()), chunks), "\n")[0].as_py()
        joined = unicodedata.normalize("NFC", joined).lower() + "\n"
        c = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kind = self.kinds[c]
        before = np.r_[np.int8(_SPACE), kind[:-1]]
        starts = (kind != before) | (kind == _NUMBER) | (kind == _SPACE)
        mark = np.flatnonzero((c == ord("'")) & (before != _OTHER))
        if len(mark):
            after = np.r_[c, np.zeros(2, np.uint32)]
            one, two = after[mark + 1], after[mark + 2]
            long = np.isin(one * np.uint64(1 << 32) + two, [(ord(x) << 32) + ord(y) for x, y in ("re", "ve", "ll")])
            short = np.isin(one, [ord(x) for x in "stmd"])
            size = np.where(short, 2, np.where(long, 3, 0))
            mark, size = mark[size > 0], size[size > 0]
            starts[mark + 1] = False
            starts[mark + size] = True
        first = np.flatnonzero(starts)
        blank = kind[first] == _SPACE
        # Offsets in UTF-8; white space stays as pieces of its own that are taken out behind.
        place = np.r_[0, np.cumsum(1 + (c >= 0x80).astype(np.int64) + (c >= 0x800))]
        edges = np.r_[place[first], place[-1]].astype(np.int32)
        data = pa.py_buffer(joined.encode())
        every = pa.StringArray.from_buffers(len(first), pa.py_buffer(edges), data)
        chunk = np.cumsum(c[first] == ord("\n"))[~blank]
        return every.filter(pa.array(~blank)), np.bincount(chunk, minlength=len(chunks))

    def of_chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks without white space, ragged."""
        if not len(chunks):
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        odd = np.flatnonzero(pc.match_substring_regex(chunks, _ODD).to_numpy(zero_copy_only=False))
        rest = chunks.take(pa.array(odd)).to_pylist()
        if rest:
            chunks = pc.if_else(pc.match_substring_regex(chunks, _ODD), "", chunks)
        pieces, n = self.pieces(chunks)
        encoded = pieces.dictionary_encode()
        of_piece = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        tokens, edges = self.merges.merge(*text_bytes(encoded.dictionary))
        flat, piece_edges = gathered(tokens, edges, of_piece)
        edges = piece_edges[np.r_[0, np.cumsum(n)]]
        if not rest:
            return flat, edges
        slow = self.library(rest)
        values = np.concatenate([flat, *[np.asarray(x, np.int64) for x in slow]])
        edges = np.r_[edges, len(flat) + np.cumsum([len(x) for x in slow])].astype(np.int64)
        pick = np.arange(len(chunks))
        pick[odd] = len(chunks) + np.arange(len(odd))
        return gathered(values, edges, pick)

    def chunked(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Number of the distinct chunk at every place, n + 1 offsets of the texts, the chunks."""
        if not len(texts):
            return np.zeros(0, np.int64), np.zeros(1, np.int64), pa.array([], pa.string())
        parts = pc.ascii_split_whitespace(texts)
        edges = parts.offsets.to_numpy().astype(np.int64)
        encoded = parts.values.slice(edges[0], edges[-1] - edges[0]).dictionary_encode()
        return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), edges - edges[0], encoded.dictionary

    def counts(self, texts: pa.Array) -> np.ndarray:
        at, edges, chunks = self.chunked(texts)
        sizes = np.diff(self.of_chunks(chunks)[1])
        return np.diff(np.r_[0, np.cumsum(sizes[at])][edges])

    def ids(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text, made for one text at a time from the distinct chunks of all."""
        at, edges, chunks = self.chunked(texts)
        tokens, token_edges = self.of_chunks(chunks)
        tokens = tokens.astype(np.uint32)
        for start, stop in zip(edges[:-1], edges[1:], strict=True):
            yield gathered(tokens, token_edges, at[start:stop])[0]


def token_counts(docs: DataFrame, path: str, text: str = "text", bytes_name: str = "n_bytes", tokens_name: str = "n_tokens", keep: tuple[str, ...] = ()) -> DataFrame:
    """Bytes and tokens of every whole text, with the columns in ``keep``.

    Counts are those of the tokenizer library for the vocabulary at ``path``, without added special
    tokens, with special strings inside texts taken as such. A null text counts as empty: 0 bytes, 0
    tokens. Repeated rows give repeated rows, an empty table an empty one. One pass without a
    shuffle; a task holds one slice of about 16 MB of text (or one longer text) at a time.
    """
    merges = MergeTable(path)
    rows = docs.select(*keep, F.col(text).alias("_text"))
    schema = f"{''.join(f'`{f.name}` {f.dataType.simpleString()}, ' for f in rows.schema.fields[:-1])}`{bytes_name}` long, `{tokens_name}` long"
    names = [*keep, bytes_name, tokens_name]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(merges)
        for batch, texts in text_slices(batches, "_text", 16 << 20):
            size = np.diff(text_bytes(texts)[1])
            columns = [*batch.columns[:-1], pa.array(size, pa.int64()), pa.array(tokens.counts(texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(count, schema)
