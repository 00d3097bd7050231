"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed per cell of source, language and topic; the cells' weights are raked to the targets of one
dimension after the other until all marginals fit. A document's probability is its cell's weight per token,
times one factor, at most 1; the factor is solved for, so that the expected tokens meet the budget.
Only the table of cells is iterated on. Documents are drawn by a hash, alike in every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import let, packed, saved, space_words, whole

DIMENSIONS = ("source", "lang", "topic")
TOLERANCE = 1e-11  # of each marginal, relative to its target
PATIENCE = 25  # pairs of rounds in which the error has to fall by a tenth


def register(text: Column, n_words: Column) -> Column:
    """The default topic: the kind of text by its shape."""
    chars = F.length(text)
    marks = chars - F.length(F.translate(text, "#*$%&|<>", ""))
    lines = chars - F.length(F.translate(text, "\n", "")) + 1
    return F.when(marks * 50 > chars, "marked").when(n_words < 8 * lines, "lines").when(
        n_words < 150, "short").otherwise("long")


def _targets(cells: DataFrame, dim: str, given: dict[str, float] | None, temperature: float) -> DataFrame:
    """The wanted share of each value: as given (others share the rest by tokens), or tokens to a power."""
    sums = cells.groupBy(dim).agg(F.sum("tokens").cast("double").alias("t"))
    if given:
        share = F.lit(None).cast("double")
        for value, part in given.items():
            share = F.when(F.col(dim) == value, F.lit(float(part))).otherwise(share)
        rest = max(0.0, 1 - sum(given.values()))
        sums = sums.withColumn("share", share)
        unlisted = sums.where("share IS NULL").agg(F.sum("t").alias("u"))
        sums = sums.join(F.broadcast(unlisted)).withColumn(  # one row
            "raw", F.coalesce("share", F.col("t") / F.col("u") * rest))
    else:
        sums = sums.withColumn("raw", F.pow("t", F.lit(temperature)))
    total = sums.agg(F.sum("raw").alias("all"))  # one row
    return sums.join(F.broadcast(total)).select(dim, (F.col("raw") / F.col("all")).alias(f"{dim}_share"))


def rake(cells: DataFrame, targets: dict[str, dict[str, float]], temperature: float, tolerance: float = TOLERANCE) -> DataFrame:
    """Cells with ``weight``: their share of all tokens once every marginal fits its targets within the tolerance.

    Raises ``ValueError`` if a value with a target has no tokens, or if the marginals stop coming nearer to targets
    that were given: cells without tokens can make targets that hold each by itself impossible together. Without
    given targets raking ends there: ``marginals`` shows what is left.
    """
    for dim, given in targets.items():
        have = {r[0] for r in cells.where(F.col(dim).isin(*given)).select(dim).distinct().collect()}  # at most the values named
        missing = [v for v, share in given.items() if share > 0 and v not in have]
        if missing and not cells.isEmpty():
            raise ValueError(f"no tokens of {dim} {', '.join(map(repr, sorted(missing)))}, which has a target")
    total = cells.agg(F.sum("tokens").cast("double").alias("total"))  # one row
    out = cells.join(F.broadcast(total)).withColumn("weight", F.col("tokens") / F.col("total")).drop("total")
    for dim in DIMENSIONS:
        out = out.join(_targets(cells, dim, targets.get(dim), temperature), dim)
    errors: list[float] = []
    while True:
        for dim in (*DIMENSIONS, *DIMENSIONS):
            has = F.sum("weight").over(Window.partitionBy(dim))
            out = out.withColumn("weight", F.when(has > 0, F.col("weight") * F.col(f"{dim}_share") / has).otherwise(0.0))
        out = saved(out, "raked")
        errors.append(residual(out))
        if errors[-1] <= tolerance:
            return out
        if len(errors) > PATIENCE and errors[-1] > 0.9 * errors[-1 - PATIENCE]:
            if not any(targets.values()):
                return out
            raise ValueError(f"the targets can't be met together: after {2 * len(errors)} rounds a marginal is still "
                             f"{errors[-1]:.3g} of its target away")


def residual(raked: DataFrame) -> float:
    """The largest error of a marginal, relative to its target."""
    worst = 0.0
    for dim in DIMENSIONS:
        sums = raked.groupBy(dim).agg(F.sum("weight").alias("has"), F.first(f"{dim}_share").alias("share"))
        worst = max(worst, sums.where("share > 0").agg(F.max(F.abs(F.col("has") / F.col("share") - 1))).first()[0] or 0.0)
    return worst


def unclipped(raked: DataFrame, slack: float) -> float:
    """The largest factor at which cells that would be drawn more than whole lose at most ``slack`` of the weight.

    Every marginal share is then within ``slack / (1 - slack)`` of its target. What is lost is convex in the factor's inverse, so
    Newton's steps from zero come from one side and end once the set of such cells stays the same.
    """
    inverse = 0.0
    while True:
        over = F.col("weight") > F.col("tokens") * F.lit(inverse)
        weight, tokens = raked.agg(F.sum(F.when(over, F.col("weight"))), F.sum(F.when(over, F.col("tokens"))).cast("double")).first()
        if not tokens or not (new := (weight - slack) / tokens) > inverse * (1 + 1e-12):
            return 1 / inverse if inverse else 0.0
        inverse = new


def marginals(mixed: DataFrame, targets: dict[str, dict[str, float]] | None = None, temperature: float = 0.7) -> DataFrame:
    """``dimension, value, share, asked, target, expected, drawn`` of what ``mix`` returns for the same targets: shares of
    all tokens, as asked for, as raked, as expected from the probabilities, and of the documents drawn."""
    cells = mixed.groupBy(*DIMENSIONS).agg(
        F.sum("n_tokens").alias("t"), F.max("weight").alias("w"), F.sum(F.col("n_tokens") * F.col("probability")).alias("e"),
        F.sum(F.when(F.col("sampled"), F.col("n_tokens")).otherwise(0)).alias("d"))
    sums = saved(cells.select("t", "w", "e", "d", F.explode(F.array(*[F.struct(
        F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in DIMENSIONS])).alias("m")).groupBy(
        "m.dimension", "m.value").agg(*[F.sum(c).cast("double").alias(c) for c in "twed"]), "mixing-marginals")
    tokens = saved(cells.where("t > 0").withColumnRenamed("t", "tokens"), "mixing-marginal-cells")
    asked = None
    for d in DIMENSIONS:
        part = _targets(tokens, d, (targets or {}).get(d), temperature).select(
            F.lit(d).alias("dimension"), F.col(d).alias("value"), F.col(f"{d}_share").alias("asked"))
        asked = part if asked is None else asked.unionByName(part)
    totals = sums.groupBy("dimension").agg(*[F.sum(c).alias(f"all_{c}") for c in "twed"])
    shares = (("t", "share"), ("w", "target"), ("e", "expected"), ("d", "drawn"))
    shown = [(F.col(c) / F.when(F.col(f"all_{c}") > 0, F.col(f"all_{c}"))).alias(name) for c, name in shares]
    return sums.join(totals, "dimension").join(asked, ["dimension", "value"], "left").select(
        "dimension", "value", shown[0], F.coalesce("asked", F.lit(0.0)).alias("asked"), *shown[1:])


def mix(docs: DataFrame, *, targets: dict[str, dict[str, float]] | None = None, temperature: float = 0.7,
        budget: float | None = 0.9, slack: float = 0.01, tolerance: float = TOLERANCE, seed: int = 7, topic: Column | None = None,
        columns: list[str] | None = None) -> DataFrame:
    """Documents (``row``: ``columns`` or all) with ``source, lang, topic, n_tokens, weight, probability, sampled``.

    ``targets`` gives shares by dimension and value; a dimension without targets gets its tokens to the power
    ``temperature``. Given targets that can't be met raise. ``budget`` is the expected share of tokens drawn. A document is drawn once at most, so cells that
    are too small for their weight are drawn whole and the others make up for them: a budget near 1 leaves the
    marginals where they were. Without a budget (None) it is the largest one that such cells cut by at most
    ``slack`` of the weight; ``marginals`` shows what is met. Null sources and languages form cells of
    their own (shown as ``""``); a null text is empty, and a document without words has no tokens and is never
    drawn. Repeated rows share one draw, as the draw depends on the id (a null one counts as ``""``).
    """
    def value(name: str) -> Column:
        return F.coalesce(docs[f"`{name}`"].cast("string"), F.lit("")).alias(name)

    stats = packed(docs, value("source"), value("lang"), whole(docs["text"]).alias("text"),
                   F.coalesce(docs["doc_id"].cast("string"), F.lit("")).alias("id"))
    stats = stats.withColumn("n_tokens", F.size(space_words(F.col("text"))).cast("long"))
    stats = stats.withColumn("topic", topic if topic is not None else register(F.col("text"), F.col("n_tokens")))
    stats = stats.select(F.struct(*[F.col("row").getField(c).alias(c) for c in columns or docs.columns])
                         .alias("row"), "id", *DIMENSIONS, "n_tokens")
    if "text" not in (columns or docs.columns):  # counting words twice takes less than storing whole texts again
        stats = saved(stats, "mixing-tokens")
    cells = saved(stats.where("n_tokens > 0").groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")), "cells")
    raked = rake(cells, targets or {}, temperature, tolerance)
    ratio = F.col("weight") / F.col("tokens")
    factor, total = 0.0, raked.agg(F.sum("tokens").cast("double")).first()[0] or 0.0
    if budget is None:
        factor = unclipped(raked, slack)
    while budget is not None:  # cells drawn whole leave the others a larger factor, until none joins them
        full = ratio * factor >= 1
        have, rest = raked.agg(F.sum(F.when(full, F.col("tokens")).otherwise(0)).cast("double"),
                               F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        new = (budget * total - have) / rest if rest else factor
        if not new > factor:
            break
        factor = new
    raked = raked.select(*DIMENSIONS, "weight", F.least(F.lit(1.0), ratio * F.lit(factor)).alias("probability"))
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), "id")), 1, 13), 16, 10).cast("double") / 2**52
    chance = F.coalesce("probability", F.lit(0.0))
    return stats.join(raked, list(DIMENSIONS), "left").select(
        "row", *DIMENSIONS, "n_tokens", F.coalesce("weight", F.lit(0.0)).alias("weight"),
        chance.alias("probability"), (draw < chance).alias("sampled"))
