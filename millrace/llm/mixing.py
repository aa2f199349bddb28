"""Mixing sources to target weights by weighted sampling with exponential keys.

Each source takes whole epochs first. The words that its target leaves are taken from its
documents in the order of exponential keys, the logarithm of a uniform number divided by the
document's quality weight (Efraimidis and Spirakis), until the running sum of sizes meets them.

The order is found from the top down: words are summed in buckets of the key, the bucket that
the budget falls into is split again while it holds many rows, and only the rows of the last one
are sorted. So a source of any size is cut without one task that holds it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import BLANKS, col, fresh, text_of, written
from millrace.operators.ranks import numbered

WEIGHTS = (3, 1, 2)  # of the sources, in order, over and over
SHARE = 1.5  # of all words, that the mix takes
MOST_EPOCHS = 2
SEED = 13

# A key's place is 54 bits below the binary point of its logarithm to base 2, plus 128.
_POINT = 54
_SHIFTS = (49, 39, 29, 19, 9, 0)
SORTED_AT_ONCE = 200_000

_ROW_BITS = 33


def n_words(text: Column) -> Column:
    """Runs without ASCII blanks."""
    return F.size(F.array_remove(F.split(text, BLANKS), "")).cast("long")


def quality_weight(text: Column, size: Column) -> Column:
    """Between 0 and 1: rises with the number of words, falls with symbols per word; null without either."""
    symbols = F.regexp_count(text, F.lit("[#*$%&|<>]"))
    n = size.cast("double")
    return n / (n + 50.0) * F.try_divide(n, n + 5.0 * symbols)


def _uniform(digest: Column) -> Column:
    """Number above 0 and below 1 from 52 bits of an MD5 in hexadecimal digits."""
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def _place(uniform: Column, weight: Column) -> Column:
    """A whole number that grows with the exponential key -ln(uniform) / weight."""
    log = F.log2(-F.log(uniform)) - F.log2(weight)
    bounded = F.greatest(F.lit(-127.0), F.least(F.lit(127.0), log))
    place = ((bounded + 128.0) * float(1 << _POINT)).cast("long")
    return F.when((weight > 0) & ~F.isnan(weight), place).otherwise(F.lit((1 << 62) - 1))


def keyed_rows(
    docs: DataFrame, doc_id: str, text: str, source: str, weight: Column | None, carry: Sequence[str], seed: int
) -> DataFrame:
    """Stored rows (doc_id, source, size, place, tie, row, carried columns)."""
    body, n, own_weight, digest, row = fresh(docs, "body", "n", "w", "digest", "row")
    rows = docs.withColumn(body, text_of(text)).withColumn(n, n_words(F.col(body)))
    # The key follows from seed, id and text, so that a repeated run, a retried task and another
    # partitioning draw the same.
    salted = F.concat(F.coalesce(col(doc_id).cast("string"), F.lit("")), F.lit(f"|{seed}|"), F.md5(F.col(body)))
    rows = rows.withColumn(digest, F.md5(salted))
    given = quality_weight(F.col(body), F.col(n)) if weight is None else weight.cast("double")
    rows = rows.withColumn(own_weight, given)
    return written(
        rows.select(
            F.struct(*[col(c) for c in carry]).alias("carried") if carry else F.lit(None).cast("int").alias("carried"),
            col(doc_id).alias("doc_id"),
            col(source).alias("source"),
            F.col(n).alias("size"),
            _place(_uniform(F.col(digest)), F.col(own_weight)).alias("place"),
            F.conv(F.substring(digest, 14, 15), 16, 10).cast("long").alias("tie"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "keyed",
    )


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most_epochs: int = MOST_EPOCHS
) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size), one row per source.

    Sources in order of code points, null last, take the weights in turn. Targets are in
    proportion to weights and sum to ``share`` of all words, but stop at ``most_epochs`` times the
    source's size; what is over is shared among the others by weight until none is above. Every
    round reads one row of sums; a source that is over stays so, as the level only rises. Without
    words all targets are 0; a ``share`` above ``most_epochs`` takes all sources that often.
    """
    ranked = numbered(sizes, [F.col("source").isNull(), "source"])
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    ranked = written(ranked.select("source", "source_size", turn.alias("weight")), "sources")
    most = most_epochs * F.col("source_size")
    level = None
    while True:
        over = F.lit(False) if level is None else most < level * F.col("weight")
        sums = ranked.agg(
            F.sum("source_size").alias("words"),
            F.sum(F.when(over, most).otherwise(0)).alias("full"),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("weights"),
        ).first()
        if not sums["words"] or not sums["weights"]:
            level = float("inf") if sums["words"] else 0.0
            break
        before, level = level, (share * sums["words"] - sums["full"]) / sums["weights"]
        if before is not None and level <= before:
            level = before
            break
    target = F.least(most.cast("double"), F.lit(level) * F.col("weight"))
    return written(ranked.withColumn("target", target), "targets")


def _meets(rest: Column, before: Column, words: Column) -> Column:
    return (before < rest) & (rest <= before + words)


def _boundary(groups: DataFrame, order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Per source the group of ``groups`` (source, rest, before, words, ...) that its budget ends in."""
    earlier = Window.partitionBy("source").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("words").over(earlier), F.lit(0))
    return (
        groups.withColumn("before", start)
        .where(_meets(F.col("rest"), F.col("before"), F.col("words")))
        .select("source", "rest", "before", *keep)
    )


def _same_source(rows: DataFrame, sources: DataFrame, how: str = "inner") -> DataFrame:
    other = sources.withColumnRenamed("source", "of")
    return rows.join(other, rows["source"].eqNullSafe(other["of"]), how).drop("of")


def _cuts(keyed: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, cut, before, equal): the place, tie and size at which a source's budget runs out,
    the words before it, and the number of rows that are equal there."""
    state = budgets.where("rest > 0").select("source", "rest", F.lit(0).cast("long").alias("before"))
    inside = F.lit(True)
    for shift in _SHIFTS:
        at = F.shiftright("place", shift)
        groups = _same_source(keyed, state).where(inside).groupBy("source", "rest", "before", at.alias("bucket"))
        groups = groups.agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows"))
        state = written(_boundary(groups, ["bucket"], ["bucket", "rows"]), "cut")
        inside = at == F.col("bucket")
        if (state.agg(F.max("rows")).first()[0] or 0) <= SORTED_AT_ONCE:
            break
    # Equal rows are one row here, so a large group of them does not meet in a task.
    groups = _same_source(keyed, state.drop("rows")).where(inside).groupBy("source", "rest", "before", "place", "tie", "size")
    groups = groups.agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("equal"))
    cut = F.struct("place", "tie", "size").alias("cut")
    return _boundary(groups, ["place", "tie", "size"], ["place", "tie", "size", "equal"]).select("source", cut, "before", "equal")


def _counted_off(rows: DataFrame) -> DataFrame:
    """Number equal rows of a source, from 0, a stored partition at a time."""
    rows = rows.withColumn("part", F.shiftright("row", _ROW_BITS))
    sizes = rows.groupBy("source", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col("source").alias("of"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))
    local = F.row_number().over(Window.partitionBy("source", "part").orderBy("row"))
    rows = rows.withColumn("local", local - 1)
    rows = rows.join(sizes, rows["source"].eqNullSafe(sizes["of"]) & (rows["part"] == sizes["p"]))
    return rows.withColumn("number", F.col("ahead") + F.col("local")).drop("of", "p", "part", "local", "ahead")


def mix_sources(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weight: Column | None = None,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most_epochs: int = MOST_EPOCHS,
    carry: Sequence[str] = (),
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, epochs, taken, carried) for every row of ``docs``.

    size: words of the whole text (null: 0). epochs: how often the mix takes the source as a
    whole. taken: words it takes of the document in all; the document at which the source's
    budget ends is taken in part, so a source's words sum to its target, rounded. weight: the document's
    quality weight, a column of ``docs``; rows where it is null, not a number or not above 0 come
    last. carried: a struct of the columns ``carry``, whatever their names.

    A null source is a source. Rows equal in id and text have equal keys and are interchangeable:
    which of them is taken in part is not defined, how many are taken is. Rows of unlike texts under
    one id, or under none, have keys of their own. Empty input: no rows.
    """
    keyed = keyed_rows(docs, doc_id, text, source, weight, carry, seed)
    sizes = keyed.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, most_epochs)
    budget, size = F.col("budget"), F.col("source_size")
    budgets = targets.withColumn("budget", F.floor(F.col("target") + 0.5).cast("long")).select(
        "source",
        "source_size",
        "target",
        F.coalesce(F.expr("try_divide(budget, source_size)").cast("long"), F.lit(0)).alias("guess"),
        "budget",
    )
    # A long quotient by comparison, as the double's may round up.
    epochs = F.when(size == 0, 0).when(F.col("guess") * size > budget, F.col("guess") - 1).otherwise(F.col("guess"))
    budgets = budgets.withColumn("epochs", epochs.cast("long")).withColumn("rest", budget - F.col("epochs") * size)
    budgets = written(budgets.drop("guess", "budget"), "budgets")
    params = written(_same_source(budgets, _cuts(keyed, budgets), "left"), "params")

    rows = _same_source(keyed, params)
    own = F.struct("place", "tie", "size")
    at_cut = F.coalesce((own == F.col("cut")) & (F.col("equal") > 1), F.lit(False))
    rows = rows.where(~at_cut).withColumn("number", F.lit(0).cast("long")).unionByName(_counted_off(rows.where(at_cut)))
    left = F.col("rest") - F.col("before") - F.col("number") * F.col("size")
    part = (
        F.when(F.col("cut").isNull() | (own > F.col("cut")), F.lit(0))
        .when(own < F.col("cut"), F.col("size"))
        .otherwise(F.greatest(F.lit(0), F.least(F.col("size"), left)))
    )
    taken = F.col("epochs") * F.col("size") + part
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", "epochs", taken.cast("long").alias("taken"), "carried"
    )


def mixed_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix itself: (doc_id, source, epoch, text), one row per time a text is taken.

    Whole epochs hold texts as they are. A text that is taken in part gives its first words,
    joined by blanks. Texts without words are not taken.
    """
    rows = mix_sources(docs, doc_id, text, source, carry=[text], **options)
    body = text_of("t")
    whole = F.expr("taken div size").cast("int")
    part = (F.col("taken") % F.col("size")).cast("int")
    words = F.array_remove(F.split(body, BLANKS), "")
    rows = rows.where("taken > 0").withColumn("t", F.col("carried")[text])
    copies = rows.select("*", F.explode(F.sequence(F.lit(0), F.expr("cast((taken - 1) div size as int)"))).alias("epoch"))
    out = F.when(F.col("epoch") < whole, body).otherwise(F.array_join(F.slice(words, 1, part), " "))
    return copies.select("doc_id", "source", "epoch", out.alias("text"))
