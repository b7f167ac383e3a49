"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

The mix is cut into blocks of equally many words. Blocks go to the sources by highest quotients target / 1, / 3, / 5, ..., which
gives whole quotas that add up; inside a source they go to its shards the same way. A shard lines up its documents in a seeded
order; its quota passes over all blocks first, and what is left is a run of blocks from a seeded start. Only DataFrame functions
are used: the highest quotients are found without listing all of them, since the quotas of two slightly different divisors enclose
the true ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.texts import write_once

BLOCK, SHARD = 16, 1 << 20
WEIGHTS, SHARE, MOST = (5.0, 2.0, 1.0), 1.5, 2

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Runs of characters other than blanks, tabs and line ends; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded(id_col: Column, seed: str) -> Column:
    """A number below 2**60 that another engine gives as well: the first 15 hex digits of an MD5."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(id_col.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, target from rows (source, size).

    Sources by code point, null last, take ``weights`` in turn and share ``share`` times all words. A target stops at ``most`` times
    its source; the excess is shared anew by weight. This is a common level for target / weight, found in one pass over the sources
    in the order in which they fill up. All sources pass through one window: there is one row for each.
    """
    # The size is summed before anything else, so a source with a third of all rows is no more work than another.
    sums = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    at = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weighed = sums.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), at + 1)).withColumn(
        "full_at", F.lit(float(most)) * F.col("source_size") / F.col("weight"))
    filling = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    earlier = filling.rowsBetween(Window.unboundedPreceding, -1)
    every = filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = weighed.select(
        "*", F.coalesce(F.sum("source_size").over(earlier), F.lit(0)).alias("full"),
        F.sum("source_size").over(every).alias("all_size"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))).alias("open_weight"),
    )
    # With the sources before this one full, the others stand at this level. It holds from the first source that isn't full then;
    # counting more sources as full lowers it, so that is the highest.
    level = (F.lit(share) * F.col("all_size") - F.lit(float(most)) * F.col("full")) / F.col("open_weight")
    found = F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(every)
    leveled = levels.withColumn("level", level).withColumn("common", F.coalesce(found, F.lit(float("inf"))))
    target = F.least(F.lit(float(most)) * F.col("source_size"), F.col("weight") * F.col("common"))
    return leveled.select("source", "source_size", F.round(target, 6).alias("target"))


def apportion(units: DataFrame, group: list[str], unit: str, seats: str, votes: str, most: str) -> DataFrame:
    """``units`` with a column quota: ``seats`` of each group given to its units by the highest ``votes`` / 1, / 3, / 5, ...

    No unit gets more than ``most``; ties go to the smaller unit. Divisors that give surely too few and surely too many seats
    bound every quota, so only about two quotients for each unit are ranked, never all.
    """
    own = Window.partitionBy(*group)
    total, n = F.sum(votes).over(own), F.count(F.lit(1)).over(own)
    place = lambda seats: F.floor(F.col(votes) * seats / F.col("_all") + F.lit(0.5))
    x = units.withColumns({"_all": total, "_n": n})
    fits = F.col("_all") > 0
    low = F.when(fits, F.least(F.col(most), F.greatest(F.lit(0), place(F.greatest(F.lit(0.0), F.col(seats) - F.col("_n") / 2 - 1))))).otherwise(0)
    high = F.when(fits, F.least(F.col(most), place(F.col(seats) + F.col("_n") / 2 + 1) + 1)).otherwise(0)
    x = x.withColumns({"_low": low.cast("long"), "_high": high.cast("long")})
    x = x.withColumn("_left", F.col(seats) - F.sum("_low").over(own))
    # A first row for each unit keeps those without open quotients.
    rows = x.withColumn("_seat", F.explode(F.sequence(F.col("_low"), F.greatest("_low", "_high"))))
    quotient = F.when(F.col("_seat") > F.col("_low"), F.col(votes) / (2 * F.col("_seat") - 1))
    ranked = rows.withColumn("_rank", F.row_number().over(own.orderBy(quotient.desc_nulls_last(), F.col(unit).asc_nulls_last(), "_seat")))
    won = F.sum(F.when((F.col("_seat") > F.col("_low")) & (F.col("_rank") <= F.col("_left")), 1).otherwise(0))
    return ranked.groupBy(*units.columns).agg((F.min("_low") + won).alias("quota"))


def _overlap(a: Column, b: Column, lo: Column, hi: Column) -> Column:
    return F.greatest(F.lit(0), F.least(b, hi) - F.greatest(a, lo))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: tuple[str, ...] = (),
        weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = "mix", block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """How many words of each document the mix takes.

    Returns ``id_col``, size, source_size, target, taken, and the pieces behind it: passes (whole repeats) and two half-open word
    ranges of the document, [start_1, end_1) and [start_2, end_2), that are taken once more; ``carry`` names columns that come along
    with ``_c_`` before their names.
    A null or empty text has size 0 and is never taken; null sources form one source. Documents that repeat an id are lined up by
    size; equal rows are interchangeable. ``taken`` is at most ``most`` times the size.
    """
    key = seeded(F.col(id_col), seed)
    sized = docs.select(F.col(id_col), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), *[F.col(c).alias(f"_c_{c}") for c in carry])
    light = write_once(sized.select("source", "size", F.col(id_col)), "sizes")
    targets = write_once(source_targets(light, weights, share, most), "targets")  # a row for each source, of known size when reread
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / F.lit(shard)))
    of_shard = lambda x: x.withColumn("shard", F.pmod(seeded(F.col(id_col), seed + " shard"), shards))

    def placed(rows: DataFrame) -> DataFrame:
        return of_shard(rows.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s"))

    # Quotas of sources, then of their shards.
    level = targets.withColumns({
        "_one": F.lit(1), "_seats": F.floor(F.sum("target").over(Window.partitionBy()) / block + F.lit(0.5)),
        "_most": most * F.ceil(F.col("source_size") / block),
    })
    quotas = apportion(level, ["_one"], "source", "_seats", "target", "_most").select("source", F.col("quota").alias("source_quota"))
    parts = placed(light).groupBy("source", "shard").agg(F.sum("size").alias("shard_size"))
    parts = parts.join(quotas.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    parts = parts.withColumns({"shard_blocks": F.ceil(F.col("shard_size") / block), "_most": most * F.ceil(F.col("shard_size") / block)})
    parts = write_once(apportion(parts, ["source"], "shard", "source_quota", "shard_size", "_most").select(
        F.col("source").alias("_s"), F.col("shard").alias("_h"), "shard_blocks", "quota"), "quotas")

    rows = placed(sized if carry else light).withColumn("_key", key)
    line = Window.partitionBy("source", "shard").orderBy("_key", F.col(id_col), "size").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_b", F.sum("size").over(line)).withColumn("_a", F.col("_b") - F.col("size"))
    rows = rows.join(parts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("shard") == F.col("_h")))
    n = F.greatest(F.lit(1), F.col("shard_blocks"))
    start = F.pmod(seeded(F.concat_ws("/", F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")), F.col("shard")), seed + " start"), n)
    rows = rows.withColumns({"passes": F.floor(F.col("quota") / n), "_lo": start * block})
    rows = rows.withColumn("_hi", F.col("_lo") + (F.col("quota") - F.col("passes") * n) * block)
    # The run of blocks goes on at the shard's first block when it reaches the last.
    wrap = F.col("_hi") - n * block
    first, second = _overlap(F.col("_a"), F.col("_b"), F.col("_lo"), F.col("_hi")), _overlap(F.col("_a"), F.col("_b"), F.lit(0), wrap)
    s1 = F.greatest(F.lit(0), F.col("_lo") - F.col("_a"))
    rows = rows.withColumns({"start_1": s1, "end_1": s1 + first, "start_2": F.lit(0).cast("long"), "end_2": second})
    taken = F.col("passes") * F.col("size") + first + second
    return rows.select(id_col, "size", "source_size", "target", taken.cast("long").alias("taken"), "passes", "start_1", "end_1",
                       "start_2", "end_2", *[f"_c_{c}" for c in carry])


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The documents of the mix with the columns of ``docs``: a row for each whole repeat and one for each piece taken once more.

    A piece has its words joined by single blanks; a piece that is the whole document keeps its text. ``n_chars``, where there is
    such a column, follows the text.
    """
    rows = mix(docs, id_col, text_col, source_col, carry=tuple(docs.columns), **options)
    piece = lambda k: F.struct(F.col(f"start_{k}").alias("a"), F.col(f"end_{k}").alias("b"))
    whole = F.struct(F.lit(0).cast("long").alias("a"), F.col("size").alias("b"))
    pieces = F.filter(F.concat(F.array_repeat(whole, F.col("passes").cast("int")), F.array(piece(1), piece(2))), lambda p: p["b"] > p["a"])
    rows = rows.withColumn("_piece", F.explode(pieces))
    text, at, end = F.col(f"_c_{text_col}"), F.col("_piece.a"), F.col("_piece.b")
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"))
    cut = F.array_join(F.slice(words, (at + 1).cast("int"), (end - at).cast("int")), " ")
    text = F.when(end - at == F.col("size"), text).otherwise(cut)
    new = {text_col: text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[new.get(c, F.col(f"_c_{c}")).alias(c) for c in docs.columns])
