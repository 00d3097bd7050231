"""Quality rules: text statistics, and outliers by minimum-covariance-determinant estimates.

Every document gets word and line statistics and a vector of them on a log scale. For each cell of
language and source, concentration steps look for the share ``support`` of its documents whose
covariance has the least determinant: they start at the medians, and in each step keep the documents
nearest by Mahalanobis distance and estimate anew. A document too far from its cell's centre is rejected.

Sums run over integers and quantiles over histograms of fixed bins, so partial sums merge in any order
to the same result, and no cell's documents are ever gathered.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, UPPER, let, packed, saved, space_words, whole

SYMBOLS = "#*$%&|<>"
WINDOW = 8
STEP = 256  # units in 1 of a logarithm
#: Name of each component, and its least standard deviation in units.
COMPONENTS = {"length": 64, "word_length": 16, "symbols": 64, "repetition": 16, "repeats": 128, "capitals": 64}
DIM = len(COMPONENTS)
PART_ROWS = 1024  # vectors of a cell that meet one copy of its estimate


def _windows(hashes: Column) -> Column:
    """One hash for each window of eight words, out of the words' hashes."""
    def doubled(values: Column, step: int) -> Column:
        return F.zip_with(values, F.slice(values, step + 1, F.size(values)), lambda a, b: F.xxhash64(a, b))

    one = let(hashes, lambda h: doubled(h, 1))
    two = let(one, lambda h: doubled(h, 2))
    four = let(two, lambda h: doubled(h, 4))
    return F.slice(four, 1, F.size(hashes) - (WINDOW - 1))


def _repeat_words(windows: Column) -> Column:
    """Words inside windows that are found twice or more."""
    def neighbours(sorted_windows: Column) -> Column:
        def start(x: Column, i: Column) -> Column:
            before = (i > 0) & (F.get(sorted_windows, i - 1)["h"] == x["h"])
            after = F.coalesce(F.get(sorted_windows, i + 1)["h"] == x["h"], F.lit(False))
            return F.when(before | after, x["p"])

        return F.sort_array(F.filter(F.transform(sorted_windows, start), lambda p: p.isNotNull()))

    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    covered = let(let(ordered, neighbours), lambda starts: F.aggregate(
        F.zip_with(starts, F.slice(starts, 2, F.size(starts)),
                   lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))),
        F.lit(0), lambda total, words: total + words))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), covered).otherwise(0)


def statistics(docs: DataFrame) -> DataFrame:
    """``row`` (the document), its base statistics, and ``x`` (its vector, in whole units).

    A null text counts as an empty one.
    """
    base = packed(docs, whole(docs["text"]).alias("text"))
    base = base.select("row", "text", space_words(F.col("text")).alias("words"))
    base = base.select("row", "text", F.size("words").cast("long").alias("n_words"),
                       F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    text, n = F.col("text"), F.col("n_words")

    def without(chars: str) -> Column:
        return F.length(F.translate(text, chars, ""))

    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    base = base.select(
        "row", "n_words", without(SPACES).cast("long").alias("word_chars"),
        (F.length(text) - without(SYMBOLS)).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.when(n > WINDOW, let(_windows(F.col("hashes")), _repeat_words)).otherwise(0).cast("long")
        .alias("n_repeat_words"),
        (F.length(text) - without(UPPER)).cast("long").alias("n_capitals"),
        F.size(F.array_distinct("hashes")).cast("long").alias("n_distinct"))
    chars, repeated = F.col("word_chars"), F.col("n_repeat_words")
    values = {
        "length": F.log1p(n), "word_length": F.log((chars + 1) / (n + 1)),
        "symbols": F.log1p(100 * F.col("n_symbols") / (chars + 1)),
        "repetition": F.log((n + 1) / (F.col("n_distinct") + 1)),
        "repeats": F.log1p(100 * repeated / (n + 1)), "capitals": F.log1p(100 * F.col("n_capitals") / (chars + 1))}
    return base.withColumns({
        "base_failed": (n < 20) | (100 * repeated > 30 * n),
        "x": F.array(*[F.round(values[c] * STEP).cast("long") for c in COMPONENTS])})


def _quantile(df: DataFrame, keys: list[str], value: str, share: float) -> DataFrame:
    """For each key the least ``value`` that ``share`` of its rows don't exceed; ``value`` has few distinct values."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    per_key = Window.partitionBy(*keys)
    counts = counts.withColumns({
        "below": F.sum("n").over(per_key.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)),
        "all": F.sum("n").over(per_key)})
    return counts.where(F.col("below") >= share * F.col("all")).groupBy(*keys).agg(F.min(value).alias(value))


def _bin(distance: Column) -> Column:
    return F.floor(32 * F.log1p(64 * distance))


def _cells(docs: DataFrame, min_docs: int) -> DataFrame:
    """The cell of each language and source: both, or where that is small the language, or all small ones."""
    small = F.lit("*")
    counts = docs.where(~F.col("base_failed")).groupBy("lang", "source").count()
    counts = counts.withColumn("source_cell", F.when(F.col("count") >= min_docs, F.col("source")).otherwise(small))
    rest = counts.where(F.col("source_cell") == small).groupBy("lang").agg(F.sum("count").alias("rest"))
    counts = counts.join(rest, "lang", "left").withColumn(
        "lang_cell", F.when((F.col("source_cell") == small) & (F.col("rest") < min_docs), small).otherwise(F.col("lang")))
    return saved(counts.select("lang", "source", F.concat_ws("\x1f", "lang_cell", "source_cell").alias("cell"), "count"),
                 "mcd-cells")


def _spread(of_cells: DataFrame, parts: DataFrame) -> DataFrame:
    """A row of each cell once for each of the cell's parts."""
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    return of_cells.join(parts, "cell").select(*of_cells.columns, each)


def _centres(docs: DataFrame) -> DataFrame:
    """For each cell the medians and half the inner quartile range (at least the floor) of the components."""
    long = docs.select("cell", F.posexplode("x").alias("i", "v"))
    parts = None
    for name, share in (("low", 0.25), ("mid", 0.5), ("high", 0.75)):
        part = _quantile(long, ["cell", "i"], "v", share).withColumnRenamed("v", name)
        parts = part if parts is None else parts.join(part, ["cell", "i"])
    floors = F.array(*[F.lit(float(v)) for v in COMPONENTS.values()])
    one = parts.select("cell", F.struct("i", F.col("mid").cast("double").alias("m"), F.greatest(
        (F.col("high") - F.col("low")) / 1.349, F.get(floors, F.col("i"))).alias("s")).alias("e"))
    return one.groupBy("cell").agg(F.sort_array(F.collect_list("e")).alias("e")).select(
        "cell", *[F.col("e")[i]["m"].alias(f"m{i}") for i in range(DIM)],
        *[(F.col("e")[i]["s"] if i == j else F.lit(0.0)).alias(f"l{i}_{j}") for i in range(DIM) for j in range(i + 1)])


def _estimate(docs: DataFrame) -> DataFrame:
    """For each cell the mean and the Cholesky factor of the covariance, with the components' floors added."""
    x = [F.col("x")[i] for i in range(DIM)]
    pairs = list(combinations_with_replacement(range(DIM), 2))
    sums = docs.groupBy("cell").agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        *[F.sum(x[i].cast("decimal(20,0)")).cast("double").alias(f"s{i}") for i in range(DIM)],
        *[F.sum((x[i] * x[j]).cast("decimal(20,0)")).cast("double").alias(f"p{i}_{j}") for i, j in pairs])
    out = sums.select("cell", *[(F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in range(DIM)],
                      *[(F.col(f"p{i}_{j}") / F.col("n") - F.col(f"s{i}") / F.col("n") * F.col(f"s{j}") / F.col("n")
                         + (float(list(COMPONENTS.values())[i]) ** 2 if i == j else 0.0)).alias(f"c{j}_{i}")
                        for i, j in pairs])
    for j in range(DIM):  # column by column; row i of the factor needs the columns before
        for i in range(j, DIM):
            rest = F.col(f"c{i}_{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}")
            out = out.withColumn(f"l{i}_{j}", F.sqrt(F.greatest(rest, F.lit(1e-6))) if i == j
                                 else rest / F.col(f"l{j}_{j}"))
    return saved(out.select("cell", *[f"m{i}" for i in range(DIM)],
                            *[f"l{i}_{j}" for i in range(DIM) for j in range(i + 1)]), "mcd-estimate")


def _distances(docs: DataFrame, estimate: DataFrame, keys: tuple[str, ...] = ("cell",)) -> DataFrame:
    """Documents with ``d2``, the squared Mahalanobis distance to their cell's estimate (null without one)."""
    joined, solved = docs.join(estimate, list(keys), "left"), []
    for i in range(DIM):
        rest = F.col("x")[i] - F.col(f"m{i}")
        for k, y in enumerate(solved):
            rest = rest - F.col(f"l{i}_{k}") * F.col(y)
        joined = joined.withColumn(f"y{i}", rest / F.col(f"l{i}_{i}"))
        solved.append(f"y{i}")
    return joined.select(*docs.columns, sum((F.col(y) * F.col(y) for y in solved), F.lit(0.0)).alias("d2"))


def quality_rules(docs: DataFrame, *, support: float = 0.75, steps: int = 3, min_docs: int = 60,
                  cutoff: float = 200.0, columns: list[str] | None = None) -> DataFrame:
    """Documents (``row``: ``columns`` or all) with base statistics, ``base_failed``, ``distance`` and ``kept``.

    ``distance`` is the squared Mahalanobis distance over its median's ratio to that of normal data;
    it is null for cells without an estimate, whose documents only the base rules judge. Cells of under
    ``min_docs`` documents are pooled by language, and then all together. Ties and repeated rows are
    judged alike; a null text is an empty one; null languages and sources are values like others.
    """
    def tag(name: str) -> Column:  # a null is a value of its own
        return F.coalesce(F.concat(F.lit("="), F.col("row").getField(name).cast("string")), F.lit(""))

    wanted = columns or docs.columns
    stats = saved(statistics(docs).withColumns({"lang": tag("lang"), "source": tag("source")}).withColumn(
        "row", F.struct(*[F.col("row").getField(c).alias(c) for c in wanted])), "quality-statistics")
    cells = _cells(stats, min_docs)
    # A cell's vectors meet its estimates in parts, so that no cell is one task, whatever its size; sums follow per part.
    parts = cells.groupBy("cell").agg((1 + F.floor(F.sum("count") / PART_ROWS)).alias("parts"))
    parted = cells.select("lang", "source", "cell").join(parts, "cell")
    vectors = stats.where(~F.col("base_failed")).select("lang", "source", "x").join(parted, ["lang", "source"]).select(
        "cell", F.pmod(F.monotonically_increasing_id(), "parts").alias("part"), "x")
    vectors = saved(vectors, "mcd-vectors")
    estimate = saved(_centres(vectors), "mcd-centres")
    keys = ("cell", "part")
    for _ in range(steps):
        near = _distances(vectors, _spread(estimate, parts), keys).withColumn("d2", _bin(F.col("d2")))
        limit = saved(_quantile(near, ["cell"], "d2", support).withColumnRenamed("d2", "limit"), "mcd-limit")
        estimate = _estimate(near.join(_spread(limit, parts), list(keys)).where(F.col("d2") <= F.col("limit")).select("cell", "x"))
    middle = _quantile(_distances(vectors, _spread(estimate, parts), keys).withColumn("d2", _bin(F.col("d2"))), ["cell"], "d2", 0.5)
    # The median of a chi-square of DIM degrees, by Wilson and Hilferty.
    normal = DIM * (1 - 2 / (9 * DIM)) ** 3
    scale = saved(middle.select("cell", F.greatest(F.expm1((F.col("d2") + 1) / 32) / 64 / normal, F.lit(1e-3)).alias(
        "scale")), "mcd-scale")
    # Cells, estimates and scales are stored, so Spark knows their sizes and documents are not shuffled to meet them.
    judged = _distances(stats.join(cells.drop("count"), ["lang", "source"], "left"), estimate).join(scale, "cell", "left")
    judged = judged.withColumn("distance", F.col("d2") / F.col("scale"))
    return judged.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))).select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", "kept")
