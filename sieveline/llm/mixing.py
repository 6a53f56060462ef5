"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target number of words; each document an expected number of copies, whose whole part
is certain and whose rest is an inclusion probability. Documents are ranked by random odds divided by
inclusion odds, and each source takes its ranking from the top until its target is met. All of it is
built-in functions; texts are read once, for their word counts, and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.llm.sharding import running_totals
from sieveline.llm.texts import text_of, word_count
from sieveline.sources.scratch import written

MOST_COPIES = 3
WEIGHTS = (5, 2, 1)
#: A document of so many words is half way to the full preference for long ones.
HALF_SIZE = 500
#: Bins of the ranking of one source; a power of two. Only the bin that holds the cut is ordered row by row.
BINS = 1 << 14
GRAIN = 1 << 52


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Add ``target`` (double) to a table of ``source`` (unique) and ``source_size`` (long).

    Sources in code point order, null last, weigh ``weights``, repeating, and share the sum of all
    sizes; a target stops at ``most`` times the source's size and the excess is shared again by weight
    until none is above. This is a common level times the weight for the sources below their stop. It is
    found by passes over the table, each of which stops at least one more source; only sums reach the driver.
    """
    ranked = running_totals(
        sources.withColumns({"_null": F.col("source").isNull(), "_one": F.lit(1).cast("long")}), ["_null", "source"], "_one"
    )
    turn = (F.col("position") % len(weights)).cast("int")
    weighed = written(
        ranked.select(
            "source", "source_size", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), turn + 1).alias("weight")
        ),
        "sources",
    )
    stop = most * F.col("source_size")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    stopped = F.lit(False)
    open_weight = open_size = 0
    n_stopped = -1
    while True:
        sums = weighed.agg(
            F.sum(F.when(~stopped, F.col("weight"))).alias("w"),
            F.sum(F.when(stopped, stop)).alias("s"),
            F.count(F.when(stopped, 1)).alias("n"),
        ).first()
        open_weight, open_size = sums["w"] or 0, total - (sums["s"] or 0)
        if sums["n"] == n_stopped or not open_weight:
            break
        n_stopped = sums["n"]
        # the level only rises from pass to pass, so a source once stopped stays so
        stopped = F.col("weight") * F.lit(open_size) > stop * F.lit(open_weight)
    share = (F.col("weight") * F.lit(open_size)).cast("double") / F.lit(float(max(open_weight, 1)))
    return weighed.withColumn("target", F.when(stopped, stop.cast("double")).otherwise(share)).drop("weight")


def uniform(key: Column, seed: int) -> Column:
    """A number strictly between 0 and 1 from 52 bits of an MD5 digest of key and seed."""
    digits = F.substring(F.md5(F.concat_ws("|", key, F.lit(str(seed))).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("long").cast("double") + 0.5) / float(GRAIN)


def drawn(docs: DataFrame, id: str, text: str, source: str, seed: int) -> DataFrame:
    """Add ``_source, _size, _key, _u``: what the decision about a document depends on. No shuffle."""
    content = text_of(text)
    key = F.coalesce(F.col(id).cast("string"), F.md5(content.cast("binary")))
    return docs.withColumns(
        {"_source": F.col(source).cast("string"), "_size": word_count(content), "_key": key, "_u": uniform(key, seed)}
    )


def ranked_by_odds(rows: DataFrame, plan: DataFrame, tilt: float) -> DataFrame:
    """Join the sources' facts and add ``_whole`` copies, ``_odds`` and ``_bin``; the last two are null without a chance.

    The facts are one narrow row per source; Spark broadcasts them if they are small and splits a hot source if not.
    """
    own, total, stop = F.col("_size"), F.col("source_size"), float(MOST_COPIES)
    ratio = F.col("target") / total
    centred = (favour(own) * total - F.col("favoured")).cast("double") / (1000.0 * total)
    expected = ratio + tilt * F.least(ratio, stop - ratio) * centred
    bounded = F.when(total > 0, F.least(F.lit(stop), F.greatest(F.lit(0.0), expected))).otherwise(F.lit(0.0))
    odds = F.col("_u") / (1 - F.col("_u")) / (F.col("_chance") / (1 - F.col("_chance")))
    return (
        rows.join(plan, F.col("_source").eqNullSafe(F.col("plan_source")), "left")
        .withColumn("_expected", bounded)
        .withColumn("_whole", F.floor("_expected").cast("long"))
        .withColumn("_chance", F.col("_expected") - F.col("_whole"))
        .withColumn("_odds", F.when(F.col("_chance") > 0, odds))
        # monotone in the odds, so bins follow the ranking
        .withColumn("_bin", F.floor(F.col("_odds") / (1 + F.col("_odds")) * BINS).cast("int"))
        .drop("_expected", "_chance")
    )


def favour(size: Column) -> Column:
    """The preference for long documents in whole words per mille, so that its sums are exact in any order."""
    return F.floor(size * 1000 / (size + HALF_SIZE)).cast("long")


def cuts_of(ranked: DataFrame) -> DataFrame:
    """Per source the words ``left`` after the whole copies, the bin ``cut`` in which they are met, and the last
    document of that bin (``last``: odds, key, size) that is taken.

    Bins are summed before anything is ordered; only the rows of one bin per source are.
    """
    bins = ranked.groupBy("_source", "_bin", "target").agg(
        F.sum(F.when(F.col("_bin").isNotNull(), F.col("_size")).otherwise(0)).alias("_words"),
        F.sum(F.col("_whole") * F.col("_size")).alias("_certain"),
    )
    own = Window.partitionBy("_source")
    earlier = own.orderBy(F.col("_bin").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    run = bins.withColumns(
        {
            "left": F.col("target") - F.sum("_certain").over(own),
            "_before": F.coalesce(F.sum("_words").over(earlier), F.lit(0)),
        }
    )
    met = F.col("_bin").isNotNull() & (F.col("left") > F.col("_before")) & (F.col("left") <= F.col("_before") + F.col("_words"))
    cuts = run.groupBy(F.col("_source").alias("cut_source")).agg(
        F.max("left").alias("left"),
        F.max(F.when(met, F.col("_bin"))).alias("cut"),
        F.max(F.when(met, F.col("left") - F.col("_before"))).alias("_open"),
    )
    at_cut = ranked.select("_source", "_bin", "_odds", "_key", "_size").join(
        cuts, F.col("_source").eqNullSafe(F.col("cut_source")) & (F.col("_bin") == F.col("cut"))
    )
    order = Window.partitionBy("_source").orderBy("_odds", "_key", "_size")
    peers = F.sum("_size").over(Window.partitionBy("_source", "_odds", "_key", "_size"))
    through = F.sum("_size").over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    # equal documents go together; they are in if their middle lies before the cut: the nearest total
    inside = at_cut.withColumns({"_through": through, "_peers": peers}).where(
        2 * F.col("_through") - F.col("_peers") <= 2 * F.col("_open")
    )
    last = inside.groupBy(F.col("_source").alias("last_source")).agg(
        F.max(F.struct(F.col("_odds").alias("odds"), F.col("_key").alias("key"), F.col("_size").alias("size"))).alias("last")
    )
    return cuts.drop("_open").join(last, F.col("cut_source").eqNullSafe(F.col("last_source")), "left").drop("last_source")


def mix_plan(
    docs: DataFrame, id: str, text: str, source: str, weights: tuple[int, ...], tilt: float, seed: int
) -> tuple[DataFrame, DataFrame]:
    """(plan, sizes): the stored facts of each source, and the stored narrow row of each document."""
    sized = written(
        drawn(docs.select(id, text, source), id, text, source, seed).select(F.col(id).alias("doc_id"), "_source", "_size", "_key", "_u"),
        "sizes",
    )
    sources = written(
        sized.groupBy("_source").agg(F.sum("_size").alias("source_size"), F.sum(favour(F.col("_size")) * F.col("_size")).alias("favoured")),
        "sources",
    )
    targets = source_targets(sources.select(F.col("_source").alias("source"), "source_size"), weights)
    facts = sources.select(F.col("_source").alias("plan_source"), "source_size", "favoured").join(
        targets.select("source", "target"), F.col("plan_source").eqNullSafe(F.col("source"))
    ).drop("source")
    facts = written(facts, "facts")
    cuts = cuts_of(ranked_by_odds(sized, facts, tilt))
    plan = facts.join(cuts, F.col("plan_source").eqNullSafe(F.col("cut_source")), "left").drop("cut_source")
    return written(plan, "plan"), sized


def with_copies(rows: DataFrame, plan: DataFrame, tilt: float) -> DataFrame:
    """Add ``source_size, target, copies`` to rows made by :func:`drawn`: a projection, given the plan."""
    ranked = ranked_by_odds(rows, plan, tilt)
    last = F.col("last")
    before = (F.col("_odds") < last["odds"]) | (
        (F.col("_odds") == last["odds"])
        & ((F.col("_key") < last["key"]) | ((F.col("_key") == last["key"]) & (F.col("_size") <= last["size"])))
    )
    extra = (
        F.when(F.col("_bin").isNull(), F.lit(False))
        .when(F.col("cut").isNull(), F.col("left") > 0)
        .when(F.col("_bin") == F.col("cut"), F.coalesce(before, F.lit(False)))
        .otherwise(F.col("_bin") < F.col("cut"))
    )
    return ranked.withColumn("copies", F.col("_whole") + extra.cast("long")).drop(
        "_whole", "_odds", "_bin", "plan_source", "favoured", "left", "cut", "last"
    )


def mix(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    tilt: float = 0.5,
    seed: int = 2023,
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken``.

    ``size`` is the number of words (0 for a null text). A document of a source with ratio
    ``f = target / source_size`` expects ``f + tilt * min(f, 3 - f) * (h - mean of h over the words of the source)``
    copies, where ``h = size / (size + 500)``: longer documents are more likely, no expectation leaves 0 to 3, and
    the expected words of a source are exactly its target. ``copies`` is the whole part, plus 1
    for the documents that Pareto order sampling takes with the rest as inclusion probability. The
    sample is fixed in words: the ranking is cut where its words come nearest to what the whole copies leave
    open, so a source misses its target by at most half a document. ``taken`` is ``copies * size``.

    Random numbers are digests of the id (of the text where the id is null) and the seed, so reruns agree. Rows
    that tie in odds, id and size are taken alike. A null source is a source of its own. An
    empty table gives no rows. Columns of ``docs`` other than the three named are not read.
    """
    if not 0 <= tilt <= 1:
        raise ValueError("tilt must be between 0 and 1")
    plan, sized = mix_plan(docs, id, text, source, weights, tilt, seed)
    return with_copies(sized, plan, tilt).select(
        "doc_id",
        F.col("_source").alias("source"),
        F.col("_size").alias("size"),
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("_size")).alias("taken"),
    )


def mixed_documents(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    tilt: float = 0.5,
    seed: int = 2023,
) -> DataFrame:
    """The rows of ``docs`` themselves, each as often as :func:`mix` takes it. Texts are not shuffled.

    Columns of ``docs`` keep their names and values, also where the plan uses the same names.
    """
    plan, _ = mix_plan(docs, id, text, source, weights, tilt, seed)
    row = docs.select(F.struct(*docs.columns).alias("_row"), *[F.col(c).alias(f"_in{k}") for k, c in enumerate((id, text, source))])
    made = with_copies(drawn(row, "_in0", "_in1", "_in2", seed), plan, tilt)
    repeated = made.where(F.col("copies") > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return repeated.select("_row.*")
