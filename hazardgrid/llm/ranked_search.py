"""Ranked lexical search with bounds of single terms and of pairs of terms.

The index holds, for every block of documents and every term in it, the documents and the term's
occurrences. For a set of queries, the lists of their terms get impacts (a term's part of a document's
score), and for pairs of terms that stand side by side in a query, ordered by weight, the intersection of
both lists with the sums of their impacts is stored, too. Each list and each intersection keeps its maximum. At query
time the maxima combine to a bound of what the lightest k terms of a query can add up to in one document of a
block: a pair adds its joint maximum where that is less than the sum of two maxima, which it is
wherever the two terms' best documents differ. Blocks, lists and documents that can't reach a query's threshold are
skipped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardgrid.llm.common import forget, saved, text_bytes, text_slices
from hazardgrid.llm.mixing import prefix_sums
from hazardgrid.llm.terms import parts, word_array, word_spans

#: Bytes of a term (fixed values): letters, digits and all beyond ASCII.
INSIDE = ~np.isin(np.arange(256), [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
#: Bytes of text in a block of documents; terms of the queries worked on at a time.
BLOCK, TERMS = 8 << 20, 1 << 18


# -- index --------------------------------------------------------------------------------------


def occurrences(values: np.ndarray, edges: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of texts; by term and text: term's place, text, occurrences; and the number of terms in each text.

    One long text is counted in parts, cut between terms.
    """
    names, places, texts = [], [], []
    sizes = np.zeros(len(edges) - 1, np.int64)
    for at, stop in parts(values, ~INSIDE, BLOCK) if len(edges) == 2 else [(0, len(values))]:
        here, ends = values[at:stop], np.clip(edges, at, stop) - at
        starts, stops = word_spans(here, ends, INSIDE)
        text = np.searchsorted(ends[1:], starts, "right")
        words = word_array(here, starts, stops, INSIDE).dictionary_encode()
        names.append(words.dictionary)
        key, n = np.unique(words.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(sizes) + text, return_counts=True)
        places.append(key)
        texts.append(n)
        sizes += np.bincount(text, minlength=len(sizes))
    if len(names) == 1:
        term, text = np.divmod(places[0], max(len(sizes), 1))
        return names[0], term, text, texts[0], sizes
    joined = pa.chunked_array(names).combine_chunks().dictionary_encode()
    number = joined.indices.to_numpy(zero_copy_only=False)
    start = np.r_[0, np.cumsum([len(x) for x in names])]
    term = np.concatenate([number[start[i] + key] for i, key in enumerate(places)])
    counts = np.bincount(term, np.concatenate(texts), len(joined.dictionary)).astype(np.int64)
    return joined.dictionary, np.arange(len(counts)), np.zeros(len(counts), np.int64), counts, sizes


INDEX = "block long, term string, docs binary, counts binary, size long, total long, ids array<long>"


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The index of all documents, saved.

    A row for each block and term: the documents' places in the block and the term's ``counts`` there, ``size``
    documents. A row without term for each block: ``ids`` of its documents and the numbers of their terms
    (``counts``), ``size`` of them with terms, ``total`` terms.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch, texts in text_slices(batches, "_text", BLOCK):
            terms, term, doc, n, sizes = occurrences(*text_bytes(texts))
            edges = np.r_[0, np.cumsum(np.bincount(term, minlength=len(terms)))]
            order = np.argsort(term, kind="stable")
            packed = [pa.Array.from_buffers(pa.binary(), len(terms), [None, pa.py_buffer((edges * 4).astype(np.int32)), pa.py_buffer(x[order].astype(np.int32))]) for x in (doc, n)]
            rows = len(terms) + 1
            ids = pa.ListArray.from_arrays(pa.array([0] * rows + [len(sizes)], pa.int32()), batch.column(0).cast(pa.int64()))
            yield pa.RecordBatch.from_arrays([
                pa.repeat(pa.scalar(block, pa.int64()), rows),
                pa.concat_arrays([terms.cast(pa.string()), pa.nulls(1, pa.string())]),
                pa.concat_arrays([packed[0], pa.nulls(1, pa.binary())]),
                pa.concat_arrays([packed[1], pa.array([sizes.astype("<i4").tobytes()], pa.binary())]),
                pa.array(np.r_[np.diff(edges), int((sizes > 0).sum())]),
                pa.array(np.r_[np.zeros(len(terms), np.int64), sizes.sum()]),
                ids,
            ], names=["block", "term", "docs", "counts", "size", "total", "ids"])
            block += 1

    return saved(docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_text")).mapInArrow(build, INDEX), "index")


# -- queries ------------------------------------------------------------------------------------


@dataclass
class Plan:
    """A block of queries: terms by number, the terms of each query from light to heavy, thresholds."""

    terms: dict[str, int]
    weights: np.ndarray
    queries: list[np.ndarray]
    documents: int
    total: int
    floors: np.ndarray

    def state(self) -> tuple:
        """Plain values to broadcast, which need no class on the workers."""
        return self.terms, self.weights, self.queries, self.documents, self.total, self.floors

    def pairs(self) -> np.ndarray:
        """Neighbours in the order of weight, each pair once."""
        found = [np.stack([q[:-1], q[1:]], 1) for q in self.queries if len(q) > 1]
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)


def query_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """Each item's distinct terms with a number, and the block of items it is worked on in, saved."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "_text", BLOCK):
            terms, term, doc, _, sizes = occurrences(*text_bytes(texts))
            order = np.argsort(doc, kind="stable")
            edges = np.r_[0, np.cumsum(np.bincount(doc, minlength=len(sizes)))].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(edges), terms.take(pa.array(term[order])).cast(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(np.diff(edges).astype(np.int64))], names=["item", "terms", "n"])

    kind = items.schema[item_id].dataType.simpleString()
    found = items.select(F.col(item_id).alias("item"), F.col(text).alias("_text")).mapInArrow(split, f"item {kind}, terms array<string>, n long")
    found = saved(found.filter("n > 0"), "items").withColumn("_one", F.lit(1))
    found = prefix_sums(found, [], ["item", "terms"], "_one", "number")
    found = prefix_sums(found, [], ["number"], "n", "_before")
    return saved(found.select("number", "item", "terms", F.expr(f"_before div {TERMS}").alias("part")), "items")


def bounds(query: np.ndarray, tops: np.ndarray, joint: dict) -> np.ndarray:
    """Bound of what the first k terms of a query add up to in one document, for each k.

    Either a term's maximum is added to the bound of those before it, or the pair it ends adds the most
    that a document with one or both of its terms has; the lesser of both, by the best choice of pairs.
    """
    out = np.zeros(len(query) + 1, np.int64)
    for k, term in enumerate(query):
        out[k + 1] = out[k] + tops[term]
        if k:
            last = query[k - 1]
            both = max(joint.get((int(last), int(term)), 0), int(tops[last]), int(tops[term]))
            out[k + 1] = min(out[k + 1], out[k - 1] + both)
    return out


def impacts(term_weight: int, counts: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return term_weight * ((1_000_000_000 * counts) // (1000 * counts + 8 * norms))


LISTS = "block long, kind string, a long, b long, docs binary, impacts binary, top long"


def impact_lists(index: DataFrame, plan: Plan, top: int) -> DataFrame:
    """Lists with impacts, intersections of pairs, the bound of each query and scores of some documents.

    ``kind`` is ``term`` (a), ``pair`` (a, b), ``ids`` (the block's ids), ``bound`` (query a, ``top``) or ``seed`` (query a, the
    score ``top`` of one document: of those with the largest joint impacts in the query's best pair).
    """
    spark = index.sparkSession
    names = spark.createDataFrame([(t,) for t in plan.terms] or [], "term string")
    wanted = index.filter("term IS NOT NULL").join(F.broadcast(names), "term").select("block", "term", "docs", "counts", "ids")
    wanted = wanted.unionByName(index.filter("term IS NULL").select("block", "term", "docs", "counts", "ids"))
    sent = spark.sparkContext.broadcast((plan.state(), plan.pairs()))

    def lists(table: pa.Table) -> pa.Table:
        (terms, weights, queries, documents, total, _), pairs = sent.value
        rows = table.column("term").to_pylist()
        if len(rows) == 1:
            return empty(LISTS)
        block, home = table.column("block")[0].as_py(), rows.index(None)
        sizes = np.frombuffer(table.column("counts")[home].as_buffer(), np.int32).astype(np.int64)
        norms = 100 - 90 + (90 * sizes * documents) // total
        held, tops = {}, np.zeros(len(weights), np.int64)
        for name, docs, counts in zip(rows, table.column("docs"), table.column("counts"), strict=True):
            if name is not None:
                at = np.frombuffer(docs.as_buffer(), np.int32)
                part = impacts(int(weights[terms[name]]), np.frombuffer(counts.as_buffer(), np.int32).astype(np.int64), norms[at])
                held[terms[name]], tops[terms[name]] = (at, part), part.max()
        out = [("term", t, None, at.tobytes(), part.tobytes(), int(tops[t])) for t, (at, part) in held.items()]
        joint, best = {}, {}
        own = np.full(len(sizes), -1, np.int64)
        for a, b in pairs.tolist():
            if a in held and b in held:
                own[held[a][0]] = held[a][1]
                at, part = held[b]
                mine = own[at]
                both = mine >= 0
                own[held[a][0]] = -1
                if both.any():
                    at, part = at[both], (part + mine)[both]
                    joint[a, b], best[a, b] = int(part.max()), at[np.argsort(-part)[:top]]
                    out.append(("pair", a, b, at.tobytes(), part.tobytes(), joint[a, b]))
        for number, query in enumerate(queries):
            bound = int(bounds(query, tops, joint)[-1])
            if bound:
                out.append(("bound", number, None, None, None, bound))
            found = [p for p in zip(query[:-1].tolist(), query[1:].tolist(), strict=True) if p in joint]
            if found:
                some = np.sort(best[max(found, key=joint.get)])
                score = np.zeros(len(some), np.int64)
                for t in query.tolist():
                    if t in held:
                        score += looked_up(held[t], some)
                out.extend(("seed", number, None, None, None, s) for s in score.tolist())
        out.append(("ids", len(sizes), None, None, None, 0))
        columns = [pa.array([block] * len(out), pa.int64()), *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64()), strict=True))]
        return pa.Table.from_arrays(columns, names=["block", "kind", "a", "b", "docs", "impacts", "top"])

    return wanted.groupBy("block").applyInArrow(lists, LISTS)


def empty(schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in schema.split(", "))]).empty_table()


def looked_up(held: tuple[np.ndarray, np.ndarray], docs: np.ndarray) -> np.ndarray:
    """Impacts of some documents (in order of place) in a list, 0 where they aren't in it."""
    at = np.minimum(np.searchsorted(held[0], docs), len(held[0]) - 1)
    return np.where(held[0][at] == docs, held[1][at], 0)


def best_of_block(query: np.ndarray, held: dict, tops: np.ndarray, joint: dict, documents: int, floor: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a block that may be among the ``top`` of a query, and their scores, none below ``floor``."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    limit = bounds(query, tops, joint)
    if limit[-1] < floor:
        return none
    # The lightest terms alone reach no place: documents come from the lists of the others.
    light = int(np.flatnonzero(limit < floor)[-1])
    score = np.zeros(documents, np.int64)
    for t in query[light:].tolist():
        if t in held:
            score[held[t][0]] += held[t][1]
    docs = np.flatnonzero(score)
    for k in range(light, 0, -1):
        if len(docs) > top:
            floor = max(floor, int(np.partition(score[docs], -top)[-top]))
        docs = docs[score[docs] + limit[k] >= floor]
        t = int(query[k - 1])
        if t in held:
            score[docs] += looked_up(held[t], docs)
    if len(docs) > top:
        floor = max(floor, int(np.partition(score[docs], -top)[-top]))
    docs = docs[score[docs] >= floor]
    return docs, score[docs]


def searched(lists: DataFrame, plan: Plan, top: int) -> DataFrame:
    """``number`` of the query, ``block``, place and score of each document that may be among the best."""
    floors = lists.sparkSession.createDataFrame([(i, int(f)) for i, f in enumerate(plan.floors)], "a long, floor long")
    alive = lists.filter("kind = 'bound'").join(F.broadcast(floors), "a").filter("top >= floor").select("block").distinct()
    live = lists.filter("kind IN ('term', 'pair', 'ids')").join(alive, "block", "left_semi")
    sent = lists.sparkSession.sparkContext.broadcast(plan.state())

    def search(table: pa.Table) -> pa.Table:
        _, weights, queries, _, _, floors = sent.value
        held, joint, tops, documents = {}, {}, np.zeros(len(weights), np.int64), 0
        for kind, a, b, docs, part, most in zip(*(table.column(c) for c in ("kind", "a", "b", "docs", "impacts", "top")), strict=True):
            if kind.as_py() == "term":
                held[a.as_py()], tops[a.as_py()] = (np.frombuffer(docs.as_buffer(), np.int32), np.frombuffer(part.as_buffer(), np.int64)), most.as_py()
            elif kind.as_py() == "pair":
                joint[a.as_py(), b.as_py()] = most.as_py()
            else:
                documents = a.as_py()
        found = [(n, *best_of_block(q, held, tops, joint, documents, int(floors[n]), top)) for n, q in enumerate(queries)]
        number = np.repeat([n for n, _, _ in found], [len(d) for _, d, _ in found]).astype(np.int64)
        docs, scores = (np.concatenate([np.zeros(0, np.int64), *[f[i] for f in found]]) for i in (1, 2))
        return pa.table({"block": pa.repeat(table.column("block")[0], len(number)), "number": number, "place": docs, "score": scores})

    return live.groupBy("block").applyInArrow(search, "block long, number long, place long, score long")


def planned(index: DataFrame, items: DataFrame, documents: int, total: int, first: int) -> Plan:
    """The queries of one part: a bounded number of terms reaches the driver, or one item's."""
    rows = items.select((F.col("number") - first).alias("number"), "terms").sort("number").collect()
    terms = {t: i for i, t in enumerate(dict.fromkeys(t for r in rows for t in r.terms))}
    names = index.sparkSession.createDataFrame([(t,) for t in terms], "term string")
    held = index.filter("term IS NOT NULL").select("term", "size").join(F.broadcast(names), "term").groupBy("term").agg(F.sum("size").alias("size"))
    weights = np.full(len(terms), -1, np.int64)
    for r in held.toLocalIterator():
        weights[terms[r.term]] = math.floor(1000 * math.log((2 * documents + 2) / (2 * r["size"] + 1)))
    queries = [np.array([terms[t] for t in r.terms if weights[terms[t]] >= 0], np.int64) for r in rows]
    queries = [q[np.lexsort((q, weights[q]))] for q in queries]
    return Plan(terms, weights, queries, documents, total, np.ones(len(rows), np.int64))


def ranked_search(docs: DataFrame, items: DataFrame, top: int = 10, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """The ``top`` documents with a score above 0 for every item: ``item_id``, ``rank``, ``doc_id``, ``score``.

    Terms are runs of letters, digits and characters beyond ASCII, A-Z lower-cased. A term of an item, once
    each, adds its weight floor(1000 ln((2N+2)/(2df+1))) times the whole part of 10^9 tf / (1000 tf + 8 m),
    m = 10 + whole part of 90 n N / L; N documents have terms, L in all, n in the document. Equal scores are in
    order of id, null last. Every document is indexed and every item searched for; results are exact.

    Null and empty texts have no terms: such documents are never found, such items have no rows, as have
    those whose terms no document holds. Repeated documents are found each. Items that share an id are
    searched for each on its own. Empty tables give no rows. Items are worked on some at a time, so that the terms the driver plans with are bounded.
    """
    index = build_index(docs, doc_id, text)
    held = index.filter("term IS NULL").agg(F.sum("size"), F.sum("total")).first()
    documents, total = held[0] or 0, held[1] or 0
    queries = query_terms(items, item_id, text)
    ids = index.filter("term IS NULL").select("block", F.posexplode("ids").alias("place", "doc_id")).withColumn("place", F.col("place").cast("long"))
    found = None
    for part in queries.groupBy("part").agg(F.min("number").alias("first")).sort("part").collect() if documents else []:
        plan = planned(index, queries.filter(F.col("part") == part.part), documents, total, part.first)
        lists = saved(impact_lists(index, plan, top), "lists")
        seeds = Window.partitionBy("a").orderBy(F.desc("top"))
        floors = lists.filter("kind = 'seed'").withColumn("at", F.row_number().over(seeds)).filter(F.col("at") <= top).filter(F.col("at") == top)
        for r in floors.select("a", "top").toLocalIterator():
            plan.floors[r.a] = max(1, r.top)
        some = saved(searched(lists, plan, top).withColumn("number", F.col("number") + part.first), "found")
        forget(lists)
        found = some if found is None else found.unionByName(some)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "block long, number long, place long, score long")
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    best = found.join(ids, ["block", "place"]).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(queries.select("number", "item"), "number").select(F.col("item").alias(item_id), F.col("rank").cast("int").alias("rank"), F.col("doc_id").alias(doc_id), "score")
