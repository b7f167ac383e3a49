"""Ranked lexical search, hybrid TAAT-DAAT over an inverted index in shards.

* The index is built where the documents lie: a task cuts its documents into shards of bounded size, and a shard is one row with its
  posting lists (positions of documents, occurrences), lengths and ids. Only terms that some query has are posted, as only they can be
  asked for; lengths and totals count every term. Nothing is shuffled.
* A query meets every shard in two steps. Its short lists are summed term at a time into accumulators. Those count as one more list with
  a bound from then on, beside the long lists, and documents go by in order: a stretch of STRETCH documents is passed over if the
  accumulators' bound and those of the long lists together stay below the score that the last of the best has by now. A stretch that
  isn't takes the long lists one by one, largest bound first, and is left as soon as the rest can't lift any document to that score.
* Each shard gives its best of each query, and the best of those are ranked: a few rows for each shard and query.

Scores are integers, so bounds are exact: what is passed over can't tie with the last of the best either.

Queries go in blocks of bounded text, one pass over the documents for each, so what is broadcast doesn't grow with their number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from heapq import heappush, heappushpop

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.texts import Shipped, map_documents, write_once

#: Documents and terms of a shard at most (one document may have more terms).
SHARD_DOCS, SHARD_TERMS = 1 << 14, 1 << 22
#: A list with one in so many of a shard's documents is long.
LONG_SHARE = 16
STRETCH = 64
#: Characters of the queries in one block, on average.
BLOCK_CHARS = 1 << 22

_KEPT = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(128, 256))
#: A-Z in lower case, everything that isn't part of a term as a blank.
_TERMS = bytes(b if b in _KEPT else 32 for b in bytes(range(256)).lower())


def terms_of(text: str | None) -> list[bytes]:
    """Runs of letters, digits and everything beyond ASCII, with A-Z in lower case."""
    return (text or "").encode().translate(_TERMS).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def strengths(tf: np.ndarray, n: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """What an occurrence count is worth in documents of ``n`` terms, before the term's weight."""
    m = 100 - 90 + (90 * n * n_docs) // total
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Lists:
    """Posting lists of one shard: documents in order and their strengths, and maxima for stretches of documents."""

    def __init__(self, n_docs: int, terms: np.ndarray, starts: np.ndarray, docs: np.ndarray, worth: np.ndarray):
        self.n_docs, self.docs, self.worth = n_docs, docs, worth
        self.span = dict(zip(terms.tolist(), zip(starts[:-1].tolist(), starts[1:].tolist())))
        self.edges_of: dict[int, tuple] = {}

    def get(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = self.span.get(term, (0, 0))
        return self.docs[lo:hi], self.worth[lo:hi]

    def stretches(self, term: int) -> tuple[list[int], np.ndarray]:
        """Where each stretch begins in the list, and the largest strength in it."""
        if term not in self.edges_of:
            docs, worth = self.get(term)
            edges = np.searchsorted(docs, np.arange(0, self.n_docs + STRETCH, STRETCH))
            most = np.zeros(len(edges) - 1, np.int64)
            filled = edges[:-1] < edges[1:]
            most[filled] = np.maximum.reduceat(worth, edges[:-1][filled])
            self.edges_of[term] = (edges.tolist(), most)
        return self.edges_of[term]


def best_of(lists: Lists, terms: list[int], weights: list[int], k: int, least: int) -> list[tuple[int, int]]:
    """(score, document) of all documents that may be among the ``k`` best of this shard and reach ``least``; ties are all there."""
    n = lists.n_docs
    held = np.zeros(-(-n // STRETCH) * STRETCH, np.int64)
    long = []
    for term, w in zip(terms, weights):
        docs, worth = lists.get(term)
        if len(docs) * LONG_SHARE > n:
            long.append((term, w))
        elif len(docs):
            held[docs] += w * worth  # a document is once in a list
    tops = held.reshape(-1, STRETCH).max(axis=1)
    if len(held) > k and tops.max() >= least:
        # Partial sums are already a floor under the k-th best.
        least = max(least, int(np.partition(held, len(held) - k)[len(held) - k]))
    readers = []
    for term, w in long:
        docs, worth = lists.get(term)
        edges, most = lists.stretches(term)
        readers.append((docs, worth, w, edges, w * most))
    readers.sort(key=lambda r: -int(r[4].max()))
    # bound[j] is what lists j and later can add in each stretch.
    bound = [np.zeros(len(tops), np.int64)]
    for reader in reversed(readers):
        bound.append(bound[-1] + reader[4])
    bound.reverse()
    heap: list[int] = []
    found: list[tuple[int, int]] = []
    for b in np.flatnonzero(tops + bound[0] >= max(least, 1)).tolist():
        if tops[b] + bound[0][b] < least:
            continue
        score = held[b * STRETCH:(b + 1) * STRETCH].copy()
        for j, (docs, worth, w, edges, _) in enumerate(readers):
            if score.max() + bound[j][b] < least:
                break
            lo, hi = edges[b], edges[b + 1]
            score[docs[lo:hi] - b * STRETCH] += w * worth[lo:hi]
        else:
            for at in np.flatnonzero(score >= max(least, 1)).tolist():
                value = int(score[at])
                if value < least:
                    continue
                found.append((value, b * STRETCH + at))
                if len(heap) < k:
                    heappush(heap, value)
                else:
                    heappushpop(heap, value)
                if len(heap) == k:
                    least = max(least, heap[0])
    return [f for f in found if f[0] >= least]


def build_index(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per shard: ids of its documents, lengths, and the posting lists of the vocabulary's terms, as packed integers.

    Columns: ids array, n binary (int32), terms, starts, posted, tf binary (int32), held long (documents with a term), total long
    (terms). Null texts have no term; repeated rows and null ids are documents like any other.
    """
    shared = Shipped(docs.sparkSession, vocabulary)

    def run(rows: Iterator[tuple]):
        known = shared.value

        def shard(ids, lengths, coded):
            n = np.array(lengths, np.int64)
            term = np.concatenate(coded) if coded else np.zeros(0, np.int64)
            at = np.repeat(np.arange(len(coded)), [len(c) for c in coded])
            keys, tf = np.unique(term * len(ids) + at, return_counts=True)
            terms, starts = np.unique(keys // len(ids), return_index=True)
            pack = lambda a: np.asarray(a, "<i4").tobytes()
            return {"ids": [ids], "n": [pack(n)], "terms": [pack(terms)], "starts": [pack(np.append(starts, len(keys)))],
                    "posted": [pack(keys % len(ids))], "tf": [pack(tf)], "held": [int((n > 0).sum())], "total": [int(n.sum())]}

        ids, lengths, coded, size = [], [], [], 0
        for key, text in rows:
            words = terms_of(text)
            ids.append(key)
            lengths.append(len(words))
            coded.append(np.array([known[w] for w in words if w in known], np.int64))
            size += len(words)
            if len(ids) >= SHARD_DOCS or size >= SHARD_TERMS:
                yield shard(ids, lengths, coded)
                ids, lengths, coded, size = [], [], [], 0
        if ids:
            yield shard(ids, lengths, coded)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"ids array<{kind}>, n binary, terms binary, starts binary, posted binary, tf binary, held long, total long"
    return map_documents(docs, [id_col, text_col], schema, run)


def document_frequencies(index: DataFrame, size: int) -> dict[int, int]:
    """How many documents have each term of the vocabulary, of ``size`` terms; summed in each task first."""
    def run(rows: Iterator[tuple]):
        df = np.zeros(size, np.int64)
        for terms, starts in rows:
            df[np.frombuffer(terms, "<i4")] += np.diff(np.frombuffer(starts, "<i4"))
        yield {"term": np.flatnonzero(df), "df": df[df > 0]}

    sums = map_documents(index, ["terms", "starts"], "term int, df long", run).groupBy("term").agg(F.sum("df").alias("df"))
    return dict(map(tuple, sums.collect()))


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text") -> DataFrame:
    """The ``k`` documents with the highest scores for each item: ``item_col``, rank int, ``id_col``, score long.

    Only scores above 0 count; equal scores rank by ascending ``id_col``, null ids last. An item has the terms of all rows with its id,
    each once; one without a term (null text, no letters) has no rows. A document that repeats an id is a document of its own. Empty
    tables give no rows, and further columns don't matter.
    """
    spark = docs.sparkSession
    wanted = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("words"))
    chars = wanted.agg(F.sum(F.length("words"))).first()[0] or 0
    blocks = -(-chars // BLOCK_CHARS) or 1
    key = F.coalesce(F.col("item").cast("string"), F.lit(""))
    results = [_search_block(spark, docs, wanted.filter(F.pmod(F.xxhash64(key), F.lit(blocks)) == b), k, id_col, text_col, item_col)
               for b in range(blocks)]
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def _search_block(spark, docs: DataFrame, wanted: DataFrame, k: int, id_col: str, text_col: str, item_col: str) -> DataFrame:
    asked: dict = {}
    for row in wanted.collect():  # one block: its size is bounded
        asked.setdefault(row[0], set()).update(terms_of(row[1]))
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*asked.values())))} if asked else {}
    index = write_once(build_index(docs, vocabulary, id_col, text_col), "index")
    n_docs, total = (x or 0 for x in index.agg(F.sum("held"), F.sum("total")).first())
    df = document_frequencies(index, len(vocabulary))
    queries = []
    for item, terms in asked.items():
        known = [(vocabulary[t], weight(n_docs, df[vocabulary[t]])) for t in sorted(terms) if vocabulary[t] in df]
        queries.append((item, [t for t, w in known if w > 0], [w for _, w in known if w > 0]))
    shared = Shipped(spark, queries)

    def run(rows: Iterator[tuple]):
        # The k best scores so far in this task, for each query.
        so_far: list[list[int]] = [[] for _ in shared.value]
        for ids, *packed in rows:
            n, terms, starts, posted, tf = (np.frombuffer(p, "<i4").astype(np.int64) for p in packed)
            lists = Lists(len(ids), terms, starts, posted, strengths(tf, n[posted], n_docs, total))
            out: dict[str, list] = {"item": [], "doc": [], "score": []}
            for (item, own, weights), heap in zip(shared.value, so_far):
                found = best_of(lists, own, weights, k, heap[0] if len(heap) == k else 1)
                found.sort(key=lambda f: (-f[0], ids[f[1]] is None, ids[f[1]], f[1]))
                for score, at in found[:k]:
                    out["item"].append(item)
                    out["doc"].append(ids[at])
                    out["score"].append(score)
                    if len(heap) < k:
                        heappush(heap, score)
                    else:
                        heappushpop(heap, score)
            yield out

    kinds = wanted.schema["item"].dataType.simpleString(), docs.schema[id_col].dataType.simpleString()
    found = map_documents(index.filter("total > 0"), ["ids", "n", "terms", "starts", "posted", "tf"],
                          f"item {kinds[0]}, doc {kinds[1]}, score long", run)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item_col), "rank", F.col("doc").alias(id_col), "score")
