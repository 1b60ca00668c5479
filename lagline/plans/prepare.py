"""The whole preparation: raw table in, feature vectors with label and split out.

Order of the steps: label, date parts, dropped columns, distinct rows, filled gaps,
dropped geography, capped outliers, folded categories, one-hot codes, split, variance and
correlation selection, scaling.

The only shuffle of whole rows is the removal of duplicates, in shares where the rows are many; its
result is written to the scratch folder once, every fit after that is a column-pruned scan of it, and it
is deleted when the prepared rows are written. All fitted
steps end up in one ``PipelineModel`` that prepares new data (batch or streaming) by
projections alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagline import fixed_values as fixed
from lagline.functions.columns import nan_to_null, numeric_columns, quoted, string_columns
from lagline.functions.ranks import row_hash
from lagline.functions.quantiles import quantiles
from lagline.operators.cleaning import (
    ColumnDropper,
    GapFillerModel,
    IqrCapperModel,
    RareFolder,
    distinct_parts,
    drop_duplicate_rows,
    iqr_limits,
    iqr_reach,
    mode_values,
)
from lagline.operators.correlation import prune_for_target
from lagline.operators.features import (
    DateParts,
    LateLabeler,
    Standardizer,
    fit_one_hot,
    select_vector_slots,
)
from lagline.operators.splitting import TRAIN, stratified_split
from lagline.session import remove, scratch_path, shares_of, stage_parts, stage_table

ROW_ID, SPLIT, FEATURES = "row_id", "split", "features"
SHARE_BYTES, MOST_SHARES = 512 << 20, 4  # of rows whose copies are compared at once


@dataclass(frozen=True)
class PrepareConfig:
    """Columns and limits of a preparation; the defaults fit the raw order table."""

    real_days: str = fixed.REAL_DAYS
    scheduled_days: str = fixed.SCHEDULED_DAYS
    order_date: str = fixed.ORDER_DATE
    date_format: str | None = None
    date_prefix: str = fixed.DATE_PART_PREFIX
    label: str = fixed.LABEL
    drop: Sequence[str] = field(
        default_factory=lambda: [
            *fixed.LEAKAGE_COLUMNS,
            *fixed.PERSONAL_COLUMNS,
            *fixed.ID_COLUMNS,
            *fixed.FREE_TEXT_COLUMNS,
            *fixed.INDEX_COLUMNS,
        ]
    )
    drop_geography: Sequence[str] = field(default_factory=lambda: list(fixed.GEOGRAPHY_COLUMNS))
    max_categories: int = fixed.MAX_CATEGORIES
    variance_threshold: float = fixed.VARIANCE_THRESHOLD
    correlation_threshold: float = fixed.CORRELATION_THRESHOLD
    # Of numeric columns that correlate more than this, only the one closer to the label stays.
    prune_threshold: float | None = None
    test_size: float = fixed.TEST_SIZE
    seed: int = fixed.SEED
    exact: bool = True
    # "all" learns medians, modes, limits and categories from every row, as the published
    # results do; "train" keeps test rows out of them.
    fit_rows: str = "all"


@dataclass
class Prepared:
    """Prepared rows (row_id, split, label, features), the fitted stages, the slot names."""

    rows: DataFrame
    stages: PipelineModel
    feature_names: list[str]
    label: str
    checks: Checks | None = None

    def train(self) -> DataFrame:
        return self.rows.where(F.col(SPLIT) == TRAIN)

    def test(self) -> DataFrame:
        return self.rows.where(F.col(SPLIT) != TRAIN)


def prepare(raw: DataFrame, config: PrepareConfig = PrepareConfig()) -> Prepared:
    if config.fit_rows not in ("all", "train"):
        raise ValueError("fit_rows must be 'all' or 'train'")
    label = config.label
    projections = [
        LateLabeler(realCol=config.real_days, scheduledCol=config.scheduled_days, labelCol=label),
        DateParts(inputCol=config.order_date, prefix=config.date_prefix, format=config.date_format),
        ColumnDropper(columns=list(config.drop)),
    ]
    if config.real_days not in raw.columns:
        raise ValueError(f"missing required columns: {[config.real_days]}")
    spark, path = raw.sparkSession, scratch_path(raw.sparkSession, "distinct-rows")
    projected = PipelineModel(projections).transform(nan_to_null(raw))
    shares = shares_of(raw, SHARE_BYTES, MOST_SHARES)
    distinct = distinct_parts(projected, shares) if shares > 1 else [drop_duplicate_rows(projected)]
    # Rows are distinct now, so their content identifies them. NULLs take part in the key.
    content = [c for c in projected.columns if c != label]
    staged = stage_parts((d.withColumn(ROW_ID, row_hash([*content, label], config.seed)) for d in distinct), path)
    checks = Checks(staged, label)
    checks.require_both_classes()
    split = stratified_split(staged, label, [ROW_ID], config.test_size, config.seed, SPLIT)

    fit_rows = split if config.fit_rows == "all" else split.where(F.col(SPLIT) == TRAIN)
    dropper = ColumnDropper(columns=list(config.drop_geography))
    kept = dropper.transform(fit_rows)
    numeric = numeric_columns(kept, [label])
    text = string_columns(kept, [ROW_ID, SPLIT])
    filler, capper = _fit_numbers(kept, numeric, text, config.exact, checks.nulls())
    filled = filler.transform(kept)
    folder = RareFolder(columns=text, maxCategories=config.max_categories).fit(filled)

    folded = folder.transform(capper.transform(filled))
    if config.prune_threshold is not None:
        pruned = prune_for_target(folded, [*numeric, label], label, config.prune_threshold)
        numeric = [c for c in numeric if c not in pruned]
    hot, hot_columns = fit_one_hot(folded, text)
    hot_names = [n for stage in hot for n in stage.slot_names()]  # folding left few
    names = [*numeric, *hot_names]
    assembler = VectorAssembler(inputCols=[*numeric, *hot_columns], outputCol="all_features", handleInvalid="keep")

    cleaned = PipelineModel([dropper, filler, capper, folder, *hot])
    ready = cleaned.transform(split.where(F.col(SPLIT) == TRAIN))
    slots = select_vector_slots(
        assembler.transform(ready).select("all_features"),
        "all_features",
        [filler.getOrDefault("medians").get(c, 0.0) for c in numeric] + [0.0] * len(hot_names),
        config.variance_threshold,
        config.correlation_threshold,
    )
    scaler = Standardizer(columns=numeric).fit(ready)
    slicer = VectorSlicer(inputCol="all_features", outputCol=FEATURES, indices=slots)

    after_split = PipelineModel([dropper, filler, capper, folder, *hot, scaler, assembler, slicer])
    rows = after_split.transform(split).select(ROW_ID, quoted(label), FEATURES, SPLIT)
    done = stage_table(rows, "prepared", [SPLIT])
    remove(spark, path)
    return Prepared(
        done,
        PipelineModel([*projections, *after_split.stages]),
        [names[i] for i in slots],
        label,
        checks,
    )


class Checks:
    """Row, class and missing-value counts of the written rows, all from one scan.

    Spark's observed metrics would save that scan, too, but in 4.1.2 a session that has used them
    can no longer send a freshly fitted logistic model to its tasks.
    """

    def __init__(self, df: DataFrame, label: str) -> None:
        self.columns, self.label = df.columns, label
        counts = [F.count_if(quoted(c).isNull()).alias(f"null_{i}") for i, c in enumerate(df.columns)]
        classes = [F.count_if(quoted(label) == y).alias(f"class_{y}") for y in (0, 1)]
        self.found = df.agg(F.count(F.lit(1)).alias("rows"), *classes, *counts).first().asDict()

    def nulls(self) -> dict[str, int]:
        return {c: self.found[f"null_{i}"] for i, c in enumerate(self.columns)}

    def table(self, spark: SparkSession) -> DataFrame:
        """(check, value): rows, rows of either class, missing values of each column."""
        rows = [(k, self.found[k]) for k in ("rows", "class_0", "class_1")] + [(f"null {c}", n) for c, n in self.nulls().items()]
        return spark.createDataFrame(rows, "check string, value long")

    def require_both_classes(self) -> None:
        n_0, n_1 = self.found["class_0"], self.found["class_1"]
        if not n_0 or not n_1:
            raise ValueError(f"label {self.label!r} has one class only: {n_0} rows of 0, {n_1} of 1")


def _fit_numbers(
    df: DataFrame, numeric: Sequence[str], text: Sequence[str], exact: bool, nulls: dict[str, int]
) -> tuple[GapFillerModel, IqrCapperModel]:
    """Medians, modes and outlier limits; the limits hold for the filled columns.

    One search finds the quartiles of all columns. Only columns with gaps are searched
    again, since filling moves their quartiles; ``nulls`` counts the gaps, of all rows.
    """
    found = quantiles(df, numeric, [0.25, 0.5, 0.75], exact)
    medians = {c: q[1] for c, q in found.items() if q[1] is not None}
    filler = GapFillerModel(medians, mode_values(df, text))
    with_gaps = [c for c in numeric if nulls[c] and c in medians]
    limits = {c: iqr_reach(found[c][0], found[c][2]) for c in medians}
    again = iqr_limits(filler.transform(df), with_gaps, exact)
    limits |= {c: (b["lower"], b["upper"]) for c, b in again.items()}
    capper = IqrCapperModel({c: low for c, (low, _) in limits.items()}, {c: high for c, (_, high) in limits.items()})
    return filler, capper


def prepare_new(raw: DataFrame, stages: PipelineModel, keep: Sequence[str] = ()) -> DataFrame:
    """Prepare new rows as the training rows were; ``keep`` names columns to carry along."""
    carried = nan_to_null(raw).withColumns({f"_kept_{c}": quoted(c) for c in keep})
    done = stages.transform(carried)
    return done.select(*[quoted(f"_kept_{c}").alias(c) for c in keep], FEATURES)
