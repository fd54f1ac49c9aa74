"""Mix sources to target weights: capped water-filling, then seeded repetition.

Every source gets a share of all words in proportion to its weight, but never
more than ``max_epochs`` times its own words; what a full source cannot take
is shared again among the others by weight until nobody is above its cap.
A source whose target is r times its size takes every document floor(r) times
and a seeded random prefix of its documents once more, so that the words taken
come within half a document of the target.

Everything runs on Spark's own functions. Only two sums per filling round
reach the driver. A hot source is summed into 4,096 hash bins before any
window sees it, and only the documents of the one bin that holds the cut are
ordered.

Defined cases: a null or empty text has size 0 and is never short of its
target; a null source is a source of its own, ordered last; an empty table
gives an empty mix; rows that agree in id (and, for null ids, in text) are
taken together; other columns are kept by ``mix_documents`` and may have any
name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = "mix-1"
BIN_DIGITS = 3  # hex digits: 4,096 bins per source


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A seeded position in the random order of a source's documents (32 hex digits)."""
    name = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(text, F.lit("")))))
    return F.md5(F.concat(F.lit(seed + "|"), name))


def source_key(source: Column) -> Column:
    """Null-safe equality key that keeps a null source apart from every text."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def source_weights(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per source: key, words, weight; weights repeat over sources by code point, null last."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    return per.select(source_key(F.col("source")).alias("key"), "source_size", pick.alias("weight"))


def water_level(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> float:
    """Words per unit of weight once no source is above its cap."""
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        full = F.col("source_size") * max_epochs < F.lit(level) * F.col("weight")
        row = sources.agg(
            F.sum(F.when(full, F.col("source_size") * max_epochs).otherwise(0)).alias("capped"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not row["open"]:
            return level
        risen = float(total - row["capped"]) / row["open"]
        if risen <= level:
            return level
        level = risen


def source_targets(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds target, whole (full repetitions) and rest (words still to draw after them)."""
    level = water_level(sources, max_epochs)
    target = F.least(F.col("source_size").cast("double") * max_epochs, F.lit(level) * F.col("weight"))
    whole = F.when(F.col("source_size") == 0, F.lit(0)).otherwise(F.floor(F.col("target") / F.col("source_size"))).cast("long")
    return (sources.withColumn("target", target).withColumn("whole", whole)
            .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")))


def cuts(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source the last draw (inclusive) whose document is taken once more.

    Documents go by draw while the middle of a document lies within ``rest``.
    Bins are summed first; only the bin in which the cut falls is ordered.
    """
    binned = sizes.withColumn("bin", F.substring("draw", 1, BIN_DIGITS))
    per_bin = binned.groupBy("key", "bin").agg(F.sum("size").alias("bin_size"))
    order = Window.partitionBy("key").orderBy("bin")
    bins = (per_bin.withColumn("below", F.sum("bin_size").over(order) - F.col("bin_size"))
            .join(targets.select("key", "rest"), "key"))
    # the cut lies in the last bin that starts at or below rest
    cut_bin = (bins.where(F.col("below") <= F.col("rest")).groupBy("key")
               .agg(F.max(F.struct("bin", "below", "rest")).alias("b")).select("key", "b.*"))
    by_draw = Window.partitionBy("key").orderBy("draw").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = (binned.join(cut_bin, ["key", "bin"])
              .withColumn("upto", F.col("below") + F.sum("size").over(by_draw))
              .where(F.col("upto") * 2 - F.col("size") <= F.col("rest") * 2))
    last = inside.groupBy("key").agg(F.max("draw").alias("last_draw"))
    # no document of that bin fits: everything before the bin is taken
    return cut_bin.join(last, "key", "left").select("key", F.coalesce("last_draw", "bin").alias("cut"))


def mix_documents(docs: DataFrame, *, max_epochs: int = MAX_EPOCHS, weights: tuple[int, ...] = WEIGHTS,
                  seed: str = SEED, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source") -> DataFrame:
    """``docs`` as a struct column ``doc``, with size, source_size, target, reps (times the document is taken)."""
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
        draw(F.col(id_col), F.col(text_col), seed).alias("draw"),
    )
    sizes = stored(sized.select("source", source_key(F.col("source")).alias("key"), "size", "draw"), "mix-sizes")
    targets = stored(source_targets(stored(source_weights(sizes, weights), "mix-sources"), max_epochs), "mix-targets")
    plan = stored(targets.join(cuts(sizes, targets), "key", "left"), "mix-plan")
    once_more = (F.col("rest") > 0) & (F.col("draw") <= F.col("cut"))
    reps = F.col("whole") + F.when(once_more, 1).otherwise(0)
    return (sized.withColumn("key", source_key(F.col("source"))).join(plan, "key")
            .select("doc", "size", "source_size", "target", reps.cast("long").alias("reps")))
