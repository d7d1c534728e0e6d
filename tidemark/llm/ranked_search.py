"""Ranked lexical search by NRA: sequential reads of impact-sorted lists, no random access.

Documents are dealt out in shards as Spark reads them. A shard holds, for each query
term, its postings by descending impact. For a query the lists are read downwards in
steps; every document met has a lower bound (what was read of it) and an upper bound
(plus, for each list where it was not met yet, that list's next value). Once the lists'
next values together cannot reach the score of rank `top`, no new document is
taken up; reading goes on until no document that can still reach that score has an open
interval. Then membership, ties and scores are all settled, in integers. A task
carries its best scores over from shard to shard as a bound, and the tasks' lists are merged
by score, then id, first within salts, so that no task sees all of them.

The queries are taken in blocks of `block_bytes` (documents are read once a block); what a
block broadcasts is bounded by it. Postings are kept for terms of the block's queries only.

Null and empty texts and texts without a term are in no count and no ranking. Items without a
term or without a hit give no row. Rows that repeat an item's id are one item, with the
least of their texts. Rows that repeat a document's id are documents of their own and rank one after the other;
null ids come last among equal scores. Empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.text import encoded, prepare
from tidemark.workspace import Workspace

# Fixed values of the ranking formula.
_SCALE, _TF, _NORM, _SLOPE = 1_000_000_000, 1000, 12, 25
# Bytes of terms stand for themselves, A-Z for a-z, all others for a space; bytes from 0x80 on belong to letters.
_TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_POSTINGS = "doc_id long, n long, terms binary, times binary"
_HITS = "item int, doc_id long, score long"


@dataclass(frozen=True)
class SearchParams:
    top: int = 20
    block_bytes: int = 8 << 20
    shard_postings: int = 4_000_000
    first_read: int = 256
    salts: int = 32


def terms(text: str | None) -> list[bytes]:
    return encoded(text).translate(_TERM_BYTES).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Lists:
    """The impact-sorted lists of a shard's documents, which are numbered in the order of their ids, nulls last."""

    def __init__(self, ids: list, lengths: np.ndarray, terms: list[np.ndarray], times: list[np.ndarray],
                 n_docs: int, total: int):
        order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0))
        self.ids = [ids[k] for k in order]
        sizes = np.array([len(terms[k]) for k in order])
        doc = np.repeat(np.arange(len(order)), sizes)
        term = np.concatenate([terms[k] for k in order]).astype(np.int64)
        tf = np.concatenate([times[k] for k in order]).astype(np.int64)
        m = np.array([100 - _SLOPE + _SLOPE * int(lengths[k]) * n_docs // total for k in order], np.int64)
        impact = (_SCALE * tf) // (_TF * tf + _NORM * m[doc])
        by = np.lexsort((-impact, term))
        self.doc, self.impact, term = doc[by].astype(np.int32), impact[by], term[by]
        edges = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1], [True])))
        self.span = {int(term[a]): (int(a), int(b)) for a, b in zip(edges[:-1], edges[1:])}


def nra(lists: Lists, query: list[tuple[int, int]], bound: int, p: SearchParams) -> tuple[np.ndarray, np.ndarray]:
    """The best documents of a shard (numbers, scores) for a query of (term, weight); `bound`: scores below it are
    not needed. Ends when no interval of a document that may be among them is open."""
    query = [(lists.span[t], w) for t, w in query if w > 0 and t in lists.span]
    n = len(lists.ids)
    lower = np.zeros(n, np.int64)
    unseen = np.ones((len(query), n), bool)
    alive, admits = np.zeros(n, bool), True
    depth, step = 0, p.first_read
    while True:
        ahead = np.zeros(len(query), np.int64)  # the next value of each list
        for k, ((start, stop), w) in enumerate(query):
            low, high = min(start + depth, stop), min(start + depth + step, stop)
            if low < high:
                met = lists.doc[low:high]
                values = w * lists.impact[low:high]
                if not admits:
                    wanted = alive[met]
                    met, values = met[wanted], values[wanted]
                lower[met] += values
                unseen[k, met] = False
                if admits:
                    alive[met] = True
            if high < stop:
                ahead[k] = w * lists.impact[high]
        depth, step = depth + step, step * 3
        at = np.flatnonzero(alive)
        if len(at) >= p.top:
            bound = max(bound, int(np.partition(lower[at], len(at) - p.top)[len(at) - p.top]))
        open_lists = np.flatnonzero(ahead)
        missing = np.zeros(len(at), np.int64)
        for k in open_lists:
            missing += np.where(unseen[k, at], ahead[k], 0)
        hopeful = lower[at] + missing >= bound
        if admits and int(ahead.sum()) < bound:
            admits = False
        if not admits:
            alive[at[~hopeful]] = False
        if not len(open_lists) or (not admits and not missing[hopeful].any()):
            at = at[hopeful]
            best = at[np.lexsort((at, -lower[at]))][: p.top]
            best = best[lower[best] > 0]
            return best, lower[best]


def _reader(vocabulary):
    """mapInArrow function: per document its length in terms and the query terms it holds with their counts."""

    def read(batches):
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            for doc_id, text in zip(ids, batch.column(1)):
                found = terms(text.as_py())
                if not found:
                    continue
                held = Counter(found)
                mine = vocabulary.value.keys() & held.keys()
                out.append((
                    doc_id, len(found), np.array([vocabulary.value[t] for t in mine], np.int32).tobytes(),
                    np.array([held[t] for t in mine], np.int64).tobytes()))
            columns = list(zip(*out)) or [[], [], [], []]
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "n", "terms", "times"])

    return read


def _holders(batches):
    """mapInArrow function: in how many documents of the task each term occurs; term -1 and -2 carry the documents
    and their terms."""
    df, docs, total = np.zeros(0, np.int64), 0, 0
    for batch in batches:
        held = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int32)
        count = np.bincount(held, minlength=len(df))
        count[: len(df)] += df
        df, docs, total = count, docs + batch.num_rows, total + sum(batch.column(0).to_pylist())
    some = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate((some, [-1, -2])), pa.int32()), pa.array(np.concatenate((df[some], [docs, total])), pa.int64())],
        ["term", "df"])


def _ranker(queries, n_docs: int, total: int, p: SearchParams):
    """mapInArrow function: the best documents of the task for every query."""

    def shards(batches):
        ids, lengths, held, times, size = [], [], [], [], 0
        for batch in batches:
            for doc_id, n, t, c in zip(*(batch.column(k).to_pylist() for k in range(4))):
                ids.append(doc_id)
                lengths.append(n)
                held.append(np.frombuffer(t, np.int32))
                times.append(np.frombuffer(c, np.int64))
                size += len(held[-1])
                if size >= p.shard_postings:
                    yield Lists(ids, np.array(lengths), held, times, n_docs, total)
                    ids, lengths, held, times, size = [], [], [], [], 0
        if size:
            yield Lists(ids, np.array(lengths), held, times, n_docs, total)

    def rank(batches):
        best: dict[int, list] = {}
        for lists in shards(batches):
            for item, query in queries.value:
                kept = best.get(item, [])
                bound = -kept[p.top - 1][0] if len(kept) >= p.top else 1
                at, scores = nra(lists, query, bound, p)
                new = [(-s, lists.ids[k] is None, lists.ids[k]) for k, s in zip(at.tolist(), scores.tolist())]
                if new:
                    best[item] = sorted(kept + new, key=lambda x: (x[0], x[1], x[2] or 0))[: p.top]
        flat = [(item, x[2], -x[0]) for item, kept in best.items() for x in kept]
        items, ids, scores = zip(*flat) if flat else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(items, pa.int32()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())],
            ["item", "doc_id", "score"])

    return rank


def _ranked(hits: DataFrame, p: SearchParams) -> DataFrame:
    """The `top` best of each item with their rank: first within salts, then of what these leave."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salted = hits.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(p.salts)))
    some = salted.withColumn("place", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order)))
    some = some.where(F.col("place") <= p.top)
    final = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return final.where(F.col("rank") <= p.top).select("item", "rank", "doc_id", "score")


def search(spark: SparkSession, docs: DataFrame, items: DataFrame, p: SearchParams = SearchParams()) -> DataFrame:
    """(item_id, rank, doc_id, score) of the `top` best documents of each item (item_id, text)."""
    prepare(spark)
    workspace = Workspace(spark)
    items = items.where("text is not null").groupBy("item_id").agg(F.min("text").alias("text"))
    items = workspace.stage(items, "items")
    volume = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-volume // p.block_bytes))
    texts = docs.select(F.col("doc_id").cast("long"), "text").where("text is not null")
    found = None
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()
        queries = [(k, Counter(terms(row.text))) for k, row in enumerate(part)]
        vocabulary = {t: k for k, t in enumerate(sorted({t for _, q in queries for t in q}))}
        shared = spark.sparkContext.broadcast(vocabulary)
        postings = workspace.stage(texts.mapInArrow(_reader(shared), _POSTINGS), "postings")
        counts = postings.select("n", "terms").mapInArrow(_holders, "term int, df long")
        df = {r.term: r.df for r in counts.groupBy("term").agg(F.sum("df").alias("df")).collect()}
        n_docs, total = df.pop(-1, 0), df.pop(-2, 0)
        weighted = [
            (k, [(vocabulary[t], times * weight(n_docs, df[vocabulary[t]])) for t, times in sorted(q.items())
                 if vocabulary[t] in df]) for k, q in queries]
        plan = spark.sparkContext.broadcast(weighted)
        hits = postings.mapInArrow(_ranker(plan, n_docs, total, p), _HITS)
        names = spark.createDataFrame([(k, row.item_id) for k, row in enumerate(part)], "item int, item_id long")
        ranked = _ranked(workspace.stage(hits, "hits"), p).join(F.broadcast(names), "item")
        ranked = workspace.stage(ranked.select("item_id", "rank", "doc_id", "score"), "ranked")
        shared.unpersist()
        plan.unpersist()
        found = ranked if found is None else found.unionByName(ranked)
    return found
