"""Filling missing salaries: a random forest where a role has enough known
values, a cascade of medians elsewhere, with the origin of each value kept."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import salary, text, vocab
from ..shared import settle, settle_partitions
from .lookups import grouped_medians, median_cascade, with_median_cascade, with_support
from .quantiles import numbered
from .skew import key_counts, lookup


@dataclass(frozen=True)
class ForestSpec:
    """Forest and feature settings."""

    # Fixed values of the forest.
    trees: int = 300
    depth: int = 7
    min_leaf: int = 10
    seed: int = 42
    min_support: int = 30
    low: float = vocab.SALARY_LOW
    high: float = vocab.SALARY_HIGH
    # Split candidates per feature, and memory for the statistics of the nodes
    # that one pass over the data can split (more memory, fewer passes).
    bins: int = 64
    memory_mb: int = 1024
    role: str = "search_role"
    level: str = "job_level"
    city: str = "city"
    skills_count: str = "skills_count"
    value: str = "salary_avg"

    @property
    def labels(self) -> list[str]:
        return [self.role, self.level, self.city]

    @property
    def codes(self) -> list[str]:
        return [f"{c}_code" for c in self.labels]

    @property
    def features(self) -> list[str]:
        return [*self.codes, self.skills_count]


def label_codes(df: DataFrame, name: str) -> DataFrame:
    """Alphabetical codes 0, 1, 2, ... of a column's distinct labels; null is ``nan``."""
    labels = df.select(F.coalesce(F.col(name).cast("string"), F.lit("nan")).alias(name)).distinct()
    return numbered(settle(labels), name, f"{name}_code")


def label_encode(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Add ``<name>_code`` for every listed column."""
    base = df
    for name in names:
        label = F.coalesce(F.col(name).cast("string"), F.lit("nan"))
        table = label_codes(base, name).withColumnRenamed(name, "_label")
        counts = key_counts(base.select(label.alias("_label")), ["_label"])
        df = lookup(df.withColumn("_label", label), table, ["_label"], counts).drop("_label")
    return df


def _base(df: DataFrame, spec: ForestSpec) -> DataFrame:
    """Add city and provenance."""
    if spec.city not in df.columns:
        df = df.withColumn(spec.city, text.city(F.col("location")))
    return df.withColumn("salary_source", salary.source_flag(F.col(spec.value)))


def _cells(base: DataFrame, spec: ForestSpec) -> DataFrame:
    """How many rows there are of each features and value; stored.

    Labels, codes, support, medians and training rows all come from this
    table, so the wide rows are read once more only, to be filled.
    """
    return settle(base.select(*spec.labels, F.coalesce(spec.skills_count, F.lit(0)).alias(spec.skills_count),
                              F.col(spec.value).cast("double").alias(spec.value))
                  .groupBy(*spec.labels, spec.skills_count, spec.value).agg(F.count(F.lit(1)).alias("_cell")))


def _profile(cells: DataFrame, spec: ForestSpec, medians: bool = False) -> DataFrame:
    """Per combination of labels: rows ``n``, rows ``_missing``, codes, ``supported`` and, if asked for, ``_median``; stored."""
    known = F.sum(F.when(F.col(spec.value).isNotNull(), F.col("_cell")).otherwise(0))
    combos = settle(cells.groupBy(*spec.labels).agg(
        F.sum("_cell").alias("n"), (F.sum("_cell") - known).alias("_missing"), known.alias("_known")))
    support = combos.groupBy(spec.role).agg((F.sum("_known") >= spec.min_support).alias("supported"))
    out = lookup(combos.drop("_known"), support, [spec.role], null_safe=True)
    for name in spec.labels:
        codes = label_codes(combos, name).withColumnRenamed(name, "_label")
        out = lookup(out.withColumn("_label", F.coalesce(F.col(name).cast("string"), F.lit("nan"))), codes, ["_label"],
                     key_counts(combos.select(F.coalesce(F.col(name).cast("string"), F.lit("nan")).alias("_label")), ["_label"])
                     ).drop("_label")
    # A null role is nobody's role, so it has no support.
    out = out.withColumn("supported", F.col("supported") & F.col(spec.role).isNotNull())
    if medians:
        found = settle(grouped_medians(cells, spec.value, spec.labels, "_cell"))
        out = median_cascade(settle(out), found, spec.labels, "_median")
    return settle(out)


def _forest(spec: ForestSpec) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=spec.features, outputCol="_features"),
        RandomForestRegressor(
            featuresCol="_features", labelCol=spec.value, predictionCol="_predicted", weightCol="_weight",
            numTrees=spec.trees, maxDepth=spec.depth, minInstancesPerNode=spec.min_leaf,
            seed=spec.seed, maxBins=spec.bins, maxMemoryInMB=spec.memory_mb,
            featureSubsetStrategy="all")])


# Training rows of one partition.  The number of partitions depends on the rows
# alone, so that the seed gives the same forest on any cluster.
TRAINING_PART = 50_000
# Up to so many training rows each is a point of its own; of more, rows of
# equal features are merged into so many points.
MOST_ROWS, MOST_POINTS = 200_000, 32


def _copies(rows: DataFrame, total: int) -> DataFrame:
    """Repeat each row ``_cell`` times, numbered from 1 in ``_copy``.

    A large cell is cut into stretches first, which are dealt out before they
    are repeated, so no array and no task holds a whole cell.
    """
    one = F.lit(1).cast("bigint")
    stretch = F.lit(TRAINING_PART).cast("bigint")
    cut = rows.withColumn("_at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_cell") - 1) / stretch))))
    if total > TRAINING_PART:
        cut = cut.repartition(-(-total // TRAINING_PART), *[F.col(f"`{c}`") for c in cut.columns])
    first = F.col("_at") * stretch
    last = F.least(F.col("_cell"), first + stretch)
    return cut.withColumn("_copy", F.explode(F.sequence(first + one, last))).drop("_at")


def _known(known: DataFrame, profile: DataFrame, spec: ForestSpec, *keep: str) -> DataFrame:
    """Features and known values of supported roles with their number of rows ``_cell``; stored."""
    ready = (lookup(known.filter(F.col(spec.value).isNotNull()), profile.select(*spec.labels, *spec.codes, "supported"),
                    spec.labels, profile.select(*spec.labels, "n"), null_safe=True)
             .filter("supported").select(*spec.features, spec.value, *keep, "_cell"))
    return settle(ready)


def _points(rows: DataFrame, total: int, spec: ForestSpec) -> DataFrame:
    """All training rows as weighted points.

    Up to ``MOST_ROWS`` rows are points of weight one.  Of more, the rows of a
    combination of features with over ``MOST_POINTS`` of them are merged into
    that many points of mean value.  A split is chosen by counts and sums, which
    merged rows keep, and rows of equal features never part; the forest's
    resampling draws points.
    """
    content = [*spec.features, spec.value]
    if total <= MOST_ROWS:
        return _copies(rows, total).withColumn("_weight", F.lit(1.0)).select(*content, "_copy", "_weight")
    most = max(MOST_POINTS, 3 * spec.min_leaf)
    counts = settle(rows.groupBy(*spec.features).agg(F.sum("_cell").alias("_rows"), F.count(F.lit(1)).alias("n")))
    sized = settle(lookup(rows.select(*content, "_cell"), counts.drop("n"), spec.features, counts.select(*spec.features, "n"), null_safe=True))
    few = sized.filter(F.col("_rows") <= most).drop("_rows")
    single = _copies(few, 0).withColumn("_weight", F.lit(1.0)).select(*content, "_copy", "_weight")
    # Equal rows are dealt over the points, beginning at a place that the value gives.
    used = F.least(F.col("_cell"), F.lit(most).cast("bigint"))
    dealt = (sized.filter(F.col("_rows") > most).withColumn("_i", F.explode(F.sequence(F.lit(0).cast("bigint"), used - 1)))
             .withColumn("_n", F.floor(F.col("_cell") / most) + F.when(F.col("_i") < F.col("_cell") % most, 1).otherwise(0))
             .withColumn("_copy", F.pmod(F.pmod(F.xxhash64(*content), F.lit(most)) + F.col("_i"), F.lit(most).cast("bigint"))))
    # Whole numbers, so that the order of summing does not matter.
    scale = 10.0 ** (14 - math.ceil(math.log10(spec.high)))
    whole = F.round(F.col(spec.value) * F.lit(scale)).cast("decimal(28,0)")
    merged = (dealt.groupBy(*spec.features, "_copy").agg(F.sum("_n").alias("_points"), F.sum(whole * F.col("_n")).alias("_sum"))
              .select(*spec.features, (F.col("_sum").cast("double") / F.lit(scale) / F.col("_points")).alias(spec.value), "_copy",
                      F.col("_points").cast("double").alias("_weight")))
    return single.unionByName(merged)


def training_rows(rows: DataFrame, spec: ForestSpec) -> DataFrame:
    """Points of the forest, stored once, dealt out by content and number.

    ``rows`` counts equal rows in ``_cell``.  Features derived from the whole
    table (company frequency and the like) are not among them, so nothing leaks.
    """
    total = rows.agg(F.coalesce(F.sum("_cell"), F.lit(0))).first()[0]
    points = _points(rows, total, spec)
    if total > MOST_ROWS:
        points = settle(points)
        total = points.count()
    content = [*spec.features, spec.value, "_copy"]
    return settle_partitions(points.repartition(max(1, -(-total // TRAINING_PART)), *content).sortWithinPartitions(*content).drop("_copy"))


def _predictions(model: PipelineModel, features: DataFrame, spec: ForestSpec) -> DataFrame:
    """One prediction for each distinct combination of features; stored."""
    return settle(model.transform(features.select(*spec.features).distinct()).select(*spec.features, "_predicted"))


def _trained(cells: DataFrame, profile: DataFrame, spec: ForestSpec) -> PipelineModel | None:
    """The forest, or None if no supported role misses a value."""
    if profile.filter(F.col("supported") & (F.col("_missing") > 0)).isEmpty():
        return None
    return _forest(spec).fit(training_rows(_known(cells, profile, spec), spec))


def _filled(base: DataFrame, cells: DataFrame, profile: DataFrame, model: PipelineModel | None, spec: ForestSpec, *extra: str) -> DataFrame:
    """Put predictions into the open rows of supported roles; one pass over the rows.

    A prediction follows from the features alone, so it is made once for each
    combination of labels and skills and looked up by the rows.
    """
    keys = list(spec.labels)
    if model is None:
        return lookup(base, profile.select(*keys, *spec.codes, "supported", *extra), keys, profile.select(*keys, "n"), null_safe=True)
    value = F.col(spec.value)
    keys.append(spec.skills_count)
    combos = cells.fillna(0, [spec.skills_count]).groupBy(*keys).agg(F.sum("_cell").alias("n"))
    table = lookup(combos, profile.select(*spec.labels, *spec.codes, "supported", *extra), spec.labels,
                   profile.select(*spec.labels, F.col("n")), null_safe=True)
    table = settle(model.transform(table).drop("_features"))
    ready = lookup(base.fillna(0, [spec.skills_count]), table.drop("n"), keys, table.select(*keys, "n"), null_safe=True)
    return (ready.withColumn("_open", value.isNull() & F.col("supported"))
            .withColumn(spec.value, F.when(F.col("_open"), text.clip(F.col("_predicted"), spec.low, spec.high))
                        .otherwise(value))
            .withColumn("salary_source", F.when(F.col("_open"), F.lit("estimated_rf"))
                        .otherwise(F.col("salary_source")))
            .drop("_open", "_predicted"))


def forest_impute(df: DataFrame, spec: ForestSpec = ForestSpec()) -> DataFrame:
    """Fill missing values of supported roles; all other rows stay as they are."""
    base = _base(df, spec)
    cells = _cells(base, spec)
    profile = _profile(cells, spec)
    return _filled(base, cells, profile, _trained(cells, profile, spec), spec).drop("supported", *spec.codes)


def median_impute(df: DataFrame, keys: Sequence[str], value: str = "salary_avg",
                  role: str = "search_role", min_support: int = 30) -> DataFrame:
    """Fill missing values of roles without support from the median cascade."""
    flagged = with_support(df.withColumn("salary_source", salary.source_flag(F.col(value))),
                           role, value, min_support)
    filled = with_median_cascade(flagged, value, keys, "_median")
    open_row = F.col(value).isNull() & ~F.col("supported")
    return (filled
            .withColumn("salary_source", F.when(open_row, F.lit("estimated_median")).otherwise(F.col("salary_source")))
            .withColumn(value, F.when(open_row, F.col("_median")).otherwise(F.col(value)))
            .drop("_median", "supported"))


def hybrid_impute(df: DataFrame, spec: ForestSpec = ForestSpec()) -> DataFrame:
    """Forest for supported roles, median cascade for the others.

    Without a supported role that misses a value nothing is trained, and
    medians fill whatever is missing.
    """
    base = _base(df, spec)
    cells = _cells(base, spec)
    profile = _profile(cells, spec, medians=True)
    missing = F.col(spec.value).isNull()
    filled = _filled(base, cells, profile, _trained(cells, profile, spec), spec, "_median")
    return (filled
            .withColumn("salary_source", F.when(missing, F.lit("estimated_median")).otherwise(F.col("salary_source")))
            .withColumn(spec.value, F.coalesce(spec.value, "_median"))
            .drop("_median", "supported", *spec.codes))


def coverage(df: DataFrame, value: str = "salary_avg", role: str = "search_role",
             min_support: int = 30) -> DataFrame:
    """Rows known, rows to be filled by either method, and their percent."""
    flagged = with_support(df, role, value, min_support)
    method = (F.when(F.col(value).isNotNull(), F.lit("actual"))
              .when(F.col("supported"), F.lit("forest")).otherwise(F.lit("median")))
    counts = flagged.groupBy(method.alias("method")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.col("n") / total * 100).orderBy("method")


def cv_scores(df: DataFrame, order: Sequence[str], spec: ForestSpec = ForestSpec(), folds: int = 5,
              fold: Column | None = None) -> DataFrame:
    """Rows trained and tested, mean absolute error and R2 of every fold; their sums and means.

    ``order`` names columns that identify a row; their hash assigns the fold,
    unless ``fold`` does.
    """
    base = _base(df, spec)
    cells = _cells(base, spec)
    number = (F.pmod(F.xxhash64(*order), F.lit(folds)) if fold is None else fold).cast("int")
    known = base.select(*spec.labels, F.coalesce(spec.skills_count, F.lit(0)).alias(spec.skills_count),
                        F.col(spec.value).cast("double").alias(spec.value), number.alias("_fold"))
    known = known.groupBy(*known.columns).agg(F.count(F.lit(1)).alias("_cell"))
    rows = _known(known, _profile(cells, spec), spec, "_fold")
    total = rows.agg(F.coalesce(F.sum("_cell"), F.lit(0))).first()[0]
    scores = []
    for i in range(folds):
        held = rows.filter(F.col("_fold") == i)
        model = _forest(spec).fit(training_rows(rows.filter(F.col("_fold") != i).drop("_fold"), spec))
        found = lookup(held, _predictions(model, held, spec), spec.features, key_counts(held, spec.features))
        y, error, n = F.col(spec.value), F.col(spec.value) - F.col("_predicted"), F.col("_cell")
        tested, mae, squares, mean = found.agg(
            F.coalesce(F.sum(n), F.lit(0)), F.sum(F.abs(error) * n) / F.sum(n), F.sum(error * error * n), F.sum(y * n) / F.sum(n)).first()
        spread = None if mean is None else held.agg(F.sum((y - F.lit(mean)) * (y - F.lit(mean)) * n)).first()[0]
        r2 = 1 - squares / spread if spread else float("nan")
        scores.append((str(i), total - tested, tested, float("nan") if mae is None else mae, r2))
    trained, tested, mae, r2 = (list(x) for x in list(zip(*scores))[1:])
    scores.append(("mean", sum(trained), sum(tested), sum(mae) / folds, sum(r2) / folds))
    return df.sparkSession.createDataFrame(scores, "fold string, trained bigint, tested bigint, mae double, r2 double")


def feature_importance(df: DataFrame, spec: ForestSpec = ForestSpec()) -> DataFrame:
    """Importance per feature, ascending."""
    base = _base(df, spec)
    cells = _cells(base, spec)
    model = _forest(spec).fit(training_rows(_known(cells, _profile(cells, spec), spec), spec)).stages[-1]
    names = [*spec.labels, spec.skills_count]
    rows = [(n, float(x)) for n, x in zip(names, model.featureImportances.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy("importance")


def source_histogram(df: DataFrame, value: str = "salary_avg", source: str = "salary_source",
                     bins: int = 40, unit: float = 1_000_000) -> DataFrame:
    """Equal-width histogram per provenance, each over its own range, and shares.

    Every bin holds its share of the source's rows and the source's share of
    all rows.
    """
    rows = df.filter(F.col(value).isNotNull()).select(source, (F.col(value) / unit).alias("_v"))
    bounds = rows.groupBy(source).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"),
                                      F.count(F.lit(1)).alias("source_rows"))
    # A handful of provenance flags; one row each.
    placed = lookup(rows, bounds, [source])
    step = F.when(F.col("_hi") > F.col("_lo"),
                  F.least(F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins),
                          F.lit(bins - 1))).otherwise(F.lit(0))
    total = bounds.agg(F.sum("source_rows")).scalar()
    return (placed.groupBy(source, step.cast("int").alias("bin"), "source_rows")
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("source_pct", F.col("source_rows") / total * 100)
            .orderBy(source, "bin"))
