"""SimHash fingerprints of word shingles, and near-duplicate groups over them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.graph import components
from riskloom.llm.texts import in_chunks, map_documents, write_once
from riskloom.llm.vptree import near_links, open_pairs

SEED = 42
PART = 1 << 15

#: Fixed values for near duplicates: words in a shingle and the Jaccard similarity from which documents are near.
NEAR_WIDTH, NEAR_SIMILARITY = 5, 0.8
#: Three words of fingerprint over distinct pairs of words, each with trees: documents at the similarity that differ in one connected
#: stretch differ in about 28 of 192 bits, unrelated ones in about 90.
NEAR_WORDS, NEAR_BITS, NEAR_BLOCKS = ("fp", "fp2", "fp3"), 50, 5
#: Candidates of each document in the first pass over groups that are not yet joined, and how the number grows from pass to pass.
OPEN_FIRST, OPEN_GROWTH = 8, 8


def words_of(text: str | None) -> list[bytes]:
    """Words between blanks, tabs and line ends, with A-Z in lower case."""
    return (text or "").encode().lower().split()


def shingle_hashes(words: list[bytes], width: int, seed: int = SEED) -> list[int]:
    """XXH64 of all runs of ``width`` words joined by blanks, repeats included; fewer words make one shingle."""
    if not words:
        return []
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return [digest(line, seed)]
    ends = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words))) + np.arange(len(words))).tolist()
    return [digest(line[a:b], seed) for a, b in zip([0, *[e + 1 for e in ends]], ends[width - 1:])]


def fingerprint(hashes: list[int]) -> int:
    """64 bits, each set where over half of the hashes have it; as a signed number. No hashes: 0."""
    if not hashes:
        return 0
    counts = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), PART):
        part = np.array(hashes[lo:lo + PART], np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, distinct: bool = False) -> DataFrame:
    """``id_col``, fp long: SimHash over shingles of ``width`` words of every whole text; ``distinct`` counts a shingle once.

    A text of fewer words is one shingle; a null text or one without words has the fingerprint 0. Repeated rows stay.
    """
    def run(rows: Iterator[tuple]):
        for part in in_chunks(rows, 1):
            out = []
            for _, text in part:
                hashes = shingle_hashes(words_of(text), width)
                out.append(fingerprint(list(set(hashes)) if distinct else hashes))
            yield {id_col: [r[0] for r in part], "fp": out}

    return map_documents(docs, [id_col, text_col], f"{id_col} {docs.schema[id_col].dataType.simpleString()}, fp long", run)


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, within: int = 4) -> DataFrame:
    """One row per document: ``id_col``, fingerprint (16 hex digits), component_id.

    Fingerprints that differ in at most ``within`` bits are linked, and component_id is the smallest id that can be reached over
    links; all texts with one fingerprint count, that of empty and null texts too. Copies meet as one fingerprint, so their number
    costs nothing in the search, which is exact (three blocks, one bit each, cover five bits). Rows without an id get a fingerprint
    and share a component with their likes, but never name it; repeated rows stay.
    """
    if within > 5:
        raise ValueError("three blocks of radius 1 are exact up to 5 bits")
    prints = write_once(fingerprints(docs, id_col, text_col, width), "fingerprints")
    classes = write_once(prints.groupBy("fp").agg(F.min(id_col).alias("first")), "classes")
    grown = components(near_links(classes.select(F.col("fp").alias("id"), "fp"), within, 3, 1, classes.count()))
    joined = classes.join(grown.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    named = joined.select("fp", "root").join(smallest, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """group_id and ``id_col`` of every document that isn't the first (smallest id) of its group of near duplicates.

    Two documents are near if their sets of five-word shingles have a Jaccard similarity of 0.8 or more; groups are what such pairs
    connect. Candidates come from SimHash fingerprints through vantage-point trees and are then compared exactly. A spanning forest of
    the nearest by fingerprint comes first, so a group of n that it joins costs n - 1 comparisons. Where it leaves parts of a group of
    candidates unjoined, all candidates between the parts follow, nearest first, in passes that grow until no pair is left.

    Texts with the same words are copies and meet by a digest. Null texts and texts without words are copies of each other. Rows
    without an id are left out; rows that repeat an id are one document.
    """
    def prints(rows: Iterator[tuple]):
        for part in in_chunks(rows, 1):
            out: dict[str, list] = {"doc": [], "copy": [], **{name: [] for name in NEAR_WORDS}}
            for key, text in part:
                words = words_of(text)
                out["doc"].append(key)
                out["copy"].append(xxhash.xxh3_128_digest(b" ".join(words)))
                for k, name in enumerate(NEAR_WORDS):
                    out[name].append(fingerprint(list(set(shingle_hashes(words, 2, SEED + k)))))
            yield out

    known = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    own = write_once(map_documents(known, ["doc", "text"], "doc long, copy binary" + "".join(f", {w} long" for w in NEAR_WORDS), prints), "prints")
    texts = write_once(own.groupBy("copy").agg(F.min("doc").alias("first"), *[F.first(w).alias(w) for w in NEAR_WORDS]), "texts")
    items = write_once(texts.groupBy(*NEAR_WORDS).agg(F.min("first").alias("id")), "items")
    size = items.count()
    same = texts.join(items, [*NEAR_WORDS]).filter("first <> id").select(F.col("first").alias("a"), F.col("id").alias("b"))
    links = near_links(items.select("id", *NEAR_WORDS), NEAR_BITS, NEAR_BLOCKS, 1, size, len(NEAR_WORDS)).select("a", "b")
    ordered = (F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    pairs = write_once(links.unionByName(same).select(*ordered).distinct(), "pairs")

    def compare(rows: Iterator[tuple]):
        for a, b, left, right in rows:
            x, y = (set(shingle_hashes(words_of(t), NEAR_WIDTH)) for t in (left, right))
            both = len(x & y)
            if both and both >= NEAR_SIMILARITY * (len(x) + len(y) - both):
                yield {"a": [a], "b": [b]}

    def compared(pairs: DataFrame) -> DataFrame:
        left = pairs.join(known.withColumnRenamed("doc", "a").withColumnRenamed("text", "left"), "a")
        both = left.join(known.withColumnRenamed("doc", "b").withColumnRenamed("text", "right"), "b")
        return write_once(map_documents(both, ["a", "b", "left", "right"], "a long, b long", compare), "near")

    near = compared(pairs)
    grown = components(near)
    # Any document with a candidate has one in the forest, so what the forest connects are all groups of candidates.
    linked = components(pairs).select(F.col("node").alias("first"), F.col("root").alias("linked"))
    linked = linked.unionByName(linked.select(F.col("linked").alias("first"), "linked").distinct())
    nodes = write_once(texts.join(linked, "first").select(F.col("first").alias("id"), *NEAR_WORDS, "linked"), "nodes")
    lo, hi = 0, OPEN_FIRST
    while True:
        parts = nodes.join(grown.withColumnRenamed("node", "id"), "id", "left").withColumn("part", F.coalesce("root", "id")).drop("root")
        torn = parts.groupBy("linked").agg(F.min("part").alias("least"), F.max("part").alias("most")).filter("least < most").select("linked")
        left = write_once(parts.join(torn, "linked", "left_semi").select("id", *NEAR_WORDS, "part"), "unjoined")
        found = write_once(open_pairs(left, NEAR_BITS, NEAR_BLOCKS, 1, size, lo, hi, len(NEAR_WORDS)), "open")
        more = not found.filter("b is null").isEmpty()
        new = write_once(found.filter("b is not null").select(*ordered).distinct().join(pairs, ["a", "b"], "left_anti"), "pairs")
        if not new.isEmpty():
            pairs = pairs.unionByName(new)
            near = near.unionByName(compared(new))
            grown = components(near)
        if not more:
            break
        lo, hi = hi, hi * OPEN_GROWTH
    # Copies follow their first document.
    named = texts.join(grown.withColumnRenamed("node", "first"), "first", "left").select("copy", F.coalesce("root", "first").alias("group_id"))
    return own.join(named, "copy").filter("doc <> group_id").select("group_id", F.col("doc").alias(id_col)).distinct()
