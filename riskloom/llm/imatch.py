"""I-Match fingerprints: the distinct terms inside a band of inverse document frequency, sorted and hashed, for random lexicon subsets.

A term is in the lexicon if its inverse document frequency ln(N / df) lies in the band; since the band is relative to the number of
documents, the lexicon has at most (distinct terms of a document, on average) * exp(IDF_MOST) entries, however large the corpus is.
Each of the subsets keeps a random eighth, sixteenth, ... of the lexicon. Small subsets rarely see a change, large ones nearly always
do, so the share of equal hashes grades the likeness of two documents. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.texts import write_once

IDF_LEAST, IDF_MOST = 3.0, 6.2
SUBSETS, SUBSETS_EACH, LARGEST = 48, 6, 8
HEX = 4
#: A larger lexicon is joined without a broadcast.
LEXICON_BROADCAST = 1_000_000
NULL_ID = -(1 << 63)
#: No term is empty, so this stands for "the document itself" among exploded terms.
MARK = ""


def terms(text: Column) -> Column:
    """Lower-case runs of letters and digits; a first or last empty string may be among them."""
    return F.split(F.lower(text), r"[^\p{L}\p{N}]+")


def _hex(text: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def lexicon(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """term, code: the terms of the band that some subset keeps. A code's low 48 bits tell which, the rest is a hash of the term."""
    n = texts.count()
    words = texts.select(F.explode(F.array_distinct(terms(F.col(text_col)))).alias("term")).filter(F.col("term") != MARK)
    idf = F.log(F.lit(float(max(1, n))) / F.col("df"))
    # Written first: a filter on what is computed from the term would otherwise be moved in front of the count, to every word.
    band = write_once(words.groupBy("term").agg(F.count(F.lit(1)).alias("df")).filter(idf.between(IDF_LEAST, IDF_MOST)).select("term"), "band")
    kept = F.lit(0).cast("long")
    for j in range(SUBSETS):
        # Six subsets each of every rate 1/8, 1/16, ..., 1/1024.
        kept = kept + F.when(F.pmod(_hex(F.concat(F.lit(f"{j}:"), "term"), 7), F.lit(LARGEST << j // SUBSETS_EACH)) == 0, F.lit(1 << j).cast("long")).otherwise(F.lit(0).cast("long"))
    return band.withColumn("kept", kept).filter("kept > 0").select("term", (F.shiftleft(F.pmod(_hex(F.col("term"), 7), F.lit(1 << 15)), 48) + F.col("kept")).alias("code"))


def subset_hashes(codes: Column, fallback: Column) -> Column:
    """array<string>: for each subset the hash of its sorted codes, empty where it keeps none; without codes ``fallback`` everywhere."""
    has = lambda j: lambda c: F.shiftright(c, j).bitwiseAND(F.lit(1)) == 1
    # As a variable of transform() the array is made once, not for every subset.
    lists = lambda own: F.array(*[F.array_join(F.filter(own, has(j)).cast("array<string>"), ",") for j in range(SUBSETS)])
    hashes = F.transform(F.transform(F.array(codes), lists)[0], lambda s: F.when(s == "", "").otherwise(F.substring(F.md5(s), 1, HEX)))
    spares = F.array(*[F.substring(fallback, 1 + j % (33 - HEX), HEX) for j in range(SUBSETS)])
    return F.when(F.size(codes) > 0, hashes).otherwise(spares)


def likeness(a: Column, b: Column) -> Column:
    """Share of subsets with equal hashes among those that keep a term of either document; 1 for equal fingerprints."""
    pairs = F.arrays_zip(a.alias("x"), b.alias("y"))
    told = F.filter(pairs, lambda p: (p["x"] != "") | (p["y"] != ""))
    same = F.size(F.filter(told, lambda p: p["x"] == p["y"]))
    return F.when(a == b, 1.0).otherwise(F.coalesce(same / F.when(F.size(told) > 0, F.size(told)), F.lit(0.0)))


def with_next(keys: DataFrame) -> DataFrame:
    """``keys`` (id, hash, ...) with next_id and next_hash of the row after it by id, then hash; after the last comes the first.

    Rows are sorted over range partitions, written, and only the first row of each partition is looked at across partitions.
    """
    ranged = write_once(keys.repartitionByRange("id", "hash").withColumn("part", F.spark_partition_id()), "ranged")
    firsts = ranged.groupBy("part").agg(F.min(F.struct("id", "hash")).alias("first"))
    over = Window.orderBy("part")  # a row for each partition
    after = F.coalesce(F.lead("first").over(over), F.min("first").over(Window.partitionBy()))
    edges = write_once(firsts.select("part", after.alias("after")), "edges")
    line = Window.partitionBy("part").orderBy("id", "hash")
    follow = F.coalesce(F.lead(F.struct("id", "hash")).over(line), F.col("after"))
    return ranged.join(edges, "part").withColumn("follow", follow).select(
        *keys.columns, F.col("follow.id").alias("next_id"), F.col("follow.hash").alias("next_hash"))


def fingerprint_and_edit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every document, and its text with the last half replaced by the beginning of the next document.

    Returns ``id_col``, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The last floor(n_chars / 2)
    code points give way to as many (or all) first ones of the next document by id; the last is followed by the first, and a single
    document by itself. A null text counts as empty. A null id counts as the smallest number. Rows that share an id follow each other
    by a hash of the text; rows that repeat id and text are one document in this order, and all of them are returned. Texts without
    a term in any subset are told apart by a hash of the lower-case text.
    """
    d = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d = d.withColumn("hash", F.xxhash64("text"))
    words = write_once(lexicon(d), "lexicon")
    known = words.unionByName(docs.sparkSession.range(1).select(F.lit(MARK).alias("term"), F.lit(-1).cast("long").alias("code")))
    if words.count() <= LEXICON_BROADCAST:
        known = F.broadcast(known)

    order = write_once(with_next(d.groupBy("id", "hash").agg(F.max(F.length("text")).cast("long").alias("n_chars"), F.count(F.lit(1)).alias("copies"))), "order")
    one = d.withColumn("copy", F.row_number().over(Window.partitionBy("id", "hash").orderBy("hash"))).filter("copy = 1").drop("copy")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    heads = one.join(order.select(F.col("next_id").alias("id"), F.col("next_hash").alias("hash"), F.col("id").alias("to_id"), F.col("hash").alias("to_hash"), "n_chars"),
                     ["id", "hash"]).select(F.col("to_id").alias("id"), F.col("to_hash").alias("hash"), F.substring("text", F.lit(1), half).alias("head"))
    n = F.length("text")
    edited = F.concat(F.substring("text", F.lit(1), n - F.floor(n / 2).cast("int")), F.col("head"))
    both = one.join(heads, ["id", "hash"]).select("id", "hash", "text", edited.alias("edited"))
    # The digests are part of the exploded structs: as columns beside a later explode they would be computed once for every term.
    kinds = [(0, F.col("text"), F.lit(None).cast("string")), (1, F.col("edited"), F.sha2("edited", 256))]
    structs = [F.struct(F.lit(k).alias("which"), t.alias("text"), sha.alias("sha"), F.md5(F.lower(t)).alias("spare")) for k, t, sha in kinds]
    told = both.select("id", "hash", F.explode(F.array(*structs)).alias("t"))
    rows = told.select("id", "hash", F.col("t.which").alias("which"), F.col("t.sha").alias("sha"), F.col("t.spare").alias("spare"),
                       F.explode(F.concat(F.array(F.lit(MARK)), terms(F.col("t.text")))).alias("term"))
    # The mark keeps a document whose terms are all outside the band.
    sets = rows.join(known, "term").groupBy("id", "hash", "which").agg(F.first("sha").alias("sha"), F.first("spare").alias("spare"), F.collect_set("code").alias("codes"))
    codes = F.sort_array(F.filter("codes", lambda c: c >= 0))
    prints = sets.select("id", "hash", "which", "sha", subset_hashes(codes, F.col("spare")).alias("print"))
    wide = prints.groupBy("id", "hash").agg(
        F.max("sha").alias("edited_sha256"), F.max(F.when(F.col("which") == 0, F.col("print"))).alias("print"),
        F.max(F.when(F.col("which") == 1, F.col("print"))).alias("edited"))
    wide = write_once(wide, "prints")
    own = order.join(wide, ["id", "hash"])
    after = wide.select(F.col("id").alias("next_id"), F.col("hash").alias("next_hash"), F.col("print").alias("next"))
    out = own.join(after, ["next_id", "next_hash"]).withColumn("_", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    flat = lambda c: F.array_join(F.transform(c, lambda x: F.rpad(x, HEX, "-")), "")
    return out.select(
        F.when(F.col("id") != NULL_ID, F.col("id")).alias(id_col), "n_chars", "edited_sha256", flat(F.col("print")).alias("fingerprint"),
        flat(F.col("edited")).alias("edited_fingerprint"), likeness(F.col("print"), F.col("edited")).alias("near_edited"),
        likeness(F.col("print"), F.col("next")).alias("near_next"))
