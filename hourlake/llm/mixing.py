"""Operator 3 (native): mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets an exponential key scaled by its quality weight. A source whose target exceeds
its size is first taken in complete epochs; for the rest its documents are ordered by key, their
sizes prefix-summed, and those within the token budget taken. The prefix sums narrow in on the key at which the
budget ends: sums over slices of the keys find the slice that holds it, sums over parts of that slice the part, until few
documents are left to sort. All others are taken or not by their key alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourlake.llm.common import WORD, fresh, mark, result, stored

#: Weights of the sources in code point order, repeating; the most a target may be in multiples of its source's size.
WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
#: Words from which a document has the full default quality weight of 1, and the least such weight.
FULL_WORDS = 200
LEAST_QUALITY = 0.05
#: Bits of a key's number and of its whole part (larger keys share the largest number), bits that a round of narrowing in looks at, and rows of a
#: source that may be sorted together.
KEY_BITS, KEY_LIMIT_BITS, STEP_BITS, FEW_ROWS = 52, 10, 13, 50_000
#: Sources up to which a table of them is broadcast.
FEW_SOURCES = 20_000


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def default_quality(size: Column) -> Column:
    """Weight of a document where the caller has none: its length, up to FULL_WORDS words."""
    return F.greatest(F.lit(LEAST_QUALITY), F.least(F.lit(1.0), size / F.lit(float(FULL_WORDS))))


def exponential_key(doc_id: Column, quality: Column, seed: int) -> Column:
    """-ln(u) / quality with u from a hash of the seed and the id: the same in every run."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / quality


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """Targets of sources given (source, source_size, ...), a row each.

    All sizes are shared by weight; a target stops at `most` times its source's size and the excess
    goes to the others by weight. In order of cap per weight, those that reach their caps come first,
    so one running sum finds the level of the others. The one unpartitioned window is over sources, not documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    out = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    out = out.withColumn("cap", F.col("source_size") * most).withColumn("ratio", F.col("cap") / F.col("weight"))
    filled = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    out = out.withColumn("place", F.row_number().over(filled)).withColumn("level", level)
    first = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("place", "level"))).over(everything)
    target = F.least(F.col("cap").cast("double"), first["level"] * F.col("weight"))
    return out.withColumn("target", F.coalesce(target, F.col("cap").cast("double"))).drop("weight", "cap", "ratio", "place", "level")


def mix(
    df: DataFrame,
    size: str | None = None,
    quality: Column | None = None,
    seed: int = 20,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    prefix: str = "mix",
) -> DataFrame:
    """Add a struct column `prefix`: size, source_size, target (of the row's source), taken (words) and times (copies).

    size names a column of word counts; without it words of `text` are counted. quality is a column
    of positive weights. A document is taken `times` times, never more than MOST_EPOCHS.

    Nulls: a null text has size 0; null sources form one source, last in order; a null doc_id is hashed as
    the empty id. Documents of size 0 take no words. Ties of keys are broken by id and size; repeated rows
    are documents of their own, and where the budget ends among them as many as fit are taken. An empty table gives an empty result. All columns of df
    pass through, whatever their names; an existing column named `prefix` is replaced.
    """
    df = df.drop(prefix)
    key, n, name, facts = (fresh(df, c) for c in ("_key", "_size", "_source", "_facts"))
    counted = F.coalesce(F.col(size), F.lit(0)).cast("long") if size else word_count(F.col(text))
    rows = df.withColumn(n, counted).withColumn(name, F.col(source))
    rows = rows.withColumn(key, exponential_key(F.col(doc_id), quality if quality is not None else default_quality(F.col(n)), seed))

    since = mark()
    slim = stored(rows.select(F.col(name).alias("source"), F.col(n).alias("size"), F.col(key).alias("key"), F.col(doc_id).alias("id")), "mix-keys")
    targets = source_targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    targets = stored(targets, "mix-targets")
    cuts = result(_cuts(slim, targets), "mix-cuts", since)

    with_facts = _with_sources(rows, cuts.select(F.struct("*").alias(facts)), F.col(name).eqNullSafe(F.col(facts)["source"]))
    of = F.col(facts)
    at_cut = F.struct(F.col(key).alias("key"), F.col(doc_id).alias("id"), F.col(n).alias("size"))
    tied = F.coalesce((at_cut == of["cut"]) & (of["ties"] > of["ties_taken"]), F.lit(False))
    within = of["whole"] | F.coalesce(at_cut <= of["cut"], F.lit(False))

    def taken(some: DataFrame, within: Column) -> DataFrame:
        times = F.when(F.col(n) > 0, F.least(of["epochs"] + within.cast("long"), F.lit(MOST_EPOCHS))).otherwise(0).cast("long")
        fields = F.struct(F.col(n).alias("size"), of["source_size"].alias("source_size"), of["target"].alias("target"), (times * F.col(n)).alias("taken"), times.alias("times"))
        return some.select(*[F.col(f"`{c}`") for c in df.columns], fields.alias(prefix))

    out = taken(with_facts.where(~tied), within)
    if not cuts.where("ties > ties_taken").isEmpty():  # repeated rows of which some are taken: these alone are numbered
        place = fresh(with_facts, "_place")
        numbers = F.row_number().over(Window.partitionBy(name, key, doc_id, n).orderBy(F.lit(1)))
        out = out.union(taken(with_facts.where(tied).withColumn(place, numbers), F.col(place) <= of["ties_taken"]))
    return out


def _with_sources(rows: DataFrame, sources: DataFrame, same: Column) -> DataFrame:
    """rows joined to a table with a row for each source at most: sent to all tasks if its rows are few by count, so that a source of very many rows stays dealt over them."""
    return rows.join(F.broadcast(sources) if sources.count() <= FEW_SOURCES else sources, same)


def _cuts(slim: DataFrame, targets: DataFrame) -> DataFrame:
    """targets with the last document that the rest of each source's budget takes: (cut: key, id, size), or `whole` if it takes all.

    ties are the rows like it, ties_taken how many of them the budget takes. The keys are mapped to whole numbers of KEY_BITS bits in their order; a
    round sums over the next STEP_BITS of those that begin like the cut does, on the executors, until at most FEW_ROWS rows
    of each source are left or no bits are.
    """
    scale = float(1 << KEY_BITS - KEY_LIMIT_BITS)  # a power of two, so that numbers keep the order of keys exactly
    number = F.least(F.floor(F.least(F.col("key"), F.lit(float(1 << KEY_LIMIT_BITS))) * scale).cast("long"), F.lit((1 << KEY_BITS) - 1))
    rows = slim.where("size > 0").withColumn("number", number)
    # at: the first bits of the cut's number; base: words of all rows before those; left: rows that begin so, null if the budget takes all.
    bounds = targets.select(F.col("source").alias("of"), "rest", F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("base"))
    shift = KEY_BITS
    while True:
        inside = _with_sources(rows, bounds, F.col("source").eqNullSafe(F.col("of"))).where(F.shiftright("number", shift) == F.col("at"))
        shift -= STEP_BITS
        sums = inside.groupBy("of", "rest", "base", F.shiftright("number", shift).alias("at")).agg(F.sum("size").alias("words"), F.count("*").alias("left"))
        upto = F.col("base") + F.sum("words").over(Window.partitionBy("of").orderBy("at"))
        sums = sums.withColumn("upto", upto).where("upto > rest")  # slices that end beyond the budget; the first holds its end
        first = F.row_number().over(Window.partitionBy("of").orderBy("at"))
        bounds = sums.withColumn("k", first).where("k = 1").select("of", "rest", "at", (F.col("upto") - F.col("words")).alias("base"), "left")
        bounds = stored(bounds, "mix-bounds")
        most = bounds.agg(F.max("left")).first()[0]
        if (most or 0) <= FEW_ROWS or shift < STEP_BITS:
            break
        bounds = bounds.drop("left")
    inside = _with_sources(rows, bounds, F.col("source").eqNullSafe(F.col("of")))
    inside = inside.where(F.shiftright("number", shift) == F.col("at")).withColumn("row", F.struct("key", "id", "size"))
    order = Window.partitionBy("of").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("base") + F.coalesce(F.sum("size").over(order), F.lit(0))
    judged = inside.withColumn("fits", before + F.col("size") * 0.5 <= F.col("rest"))
    same = judged.groupBy("of", "row").agg(F.count("*").alias("ties"), F.count_if("fits").alias("ties_taken"))
    last = same.where("ties_taken > 0").groupBy("of").agg(F.max(F.struct("row", "ties", "ties_taken")).alias("last"))
    found = bounds.select("of", "at").join(last.withColumnRenamed("of", "of_last"), F.col("of").eqNullSafe(F.col("of_last")), "left")
    none = found.where("last is null").select("of", "at")
    # The last row before the slice, for the few sources where no row of it fits.
    before = _with_sources(rows, stored(none, "mix-none"), F.col("source").eqNullSafe(F.col("of"))).where(F.shiftright("number", shift) < F.col("at"))
    before = before.groupBy("of").agg(F.max(F.struct("key", "id", "size")).alias("cut"))
    cut = found.where("last is not null").select("of", F.col("last.row").alias("cut"), F.col("last.ties").alias("ties"), F.col("last.ties_taken").alias("ties_taken"))
    cut = cut.union(before.select("of", "cut", F.lit(0).cast("long"), F.lit(0).cast("long")))
    out = targets.join(bounds.select(F.col("of").alias("partial")).withColumn("some", F.lit(True)), F.col("source").eqNullSafe(F.col("partial")), "left")
    out = out.join(cut, F.col("source").eqNullSafe(F.col("of")), "left")
    return out.select("source", "source_size", "target", "epochs", F.col("some").isNull().alias("whole"), "cut", F.coalesce("ties", F.lit(0)).alias("ties"), F.coalesce("ties_taken", F.lit(0)).alias("ties_taken"))


def mixed_documents(df: DataFrame, **options) -> DataFrame:
    """The documents that the mix takes, each as often as it takes it, with df's columns, whatever their names.

    Nulls, ties and repeated rows are as in `mix`; documents without words are never taken; an empty table gives an empty result.
    """
    made = fresh(df, "_mix")
    taken = mix(df, prefix=made, **options)
    copy = fresh(taken, "_copy")
    copies = taken.where(F.col(made)["times"] > 0).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(made)["times"])))
    return copies.select(*[F.col(f"`{c}`") for c in df.columns])
