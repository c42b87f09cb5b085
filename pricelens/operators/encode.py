"""Category encoders as Spark ML stages.

* ``SmoothedTargetEncoder`` — target (mean) encoding with additive smoothing
  ``(n*mean + s*g) / (n + s)`` or sigmoid smoothing
  ``w = 1 / (1 + exp(-(n - min_samples_leaf) / s))``, ``value = g*(1-w) + mean*w``.
  Statistics for all columns come from ONE aggregate over an unpivot, are written to
  the shared folder and stay a DataFrame (never a driver dict); ``transform`` is a
  size-checked lookup join per column, nulls and unseen categories get ``g``.
* ``CategoryIndexer`` — ordinal codes by frequency or alphabet as a written (feature,
  category, code) table, joined like the target statistics: no label list on the driver and
  no limit on the number of categories. One-hot vectors are Spark's ``OneHotEncoder`` over
  such codes. Codes enter the forest as numbers, as in the reference's pandas recipe.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasOutputCols
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelens.config import ADDITIVE_SMOOTHING, SIGMOID_MIN_SAMPLES_LEAF, ColumnRoles
from pricelens.functions.columns import strict_number, with_numbers
from pricelens.functions.joins import DEFAULT_MAX_BROADCAST_BYTES, lookup_join, table_bytes
from pricelens.functions.ranking import sorted_rank
from pricelens.session import materialize

UNKNOWN = "__unknown__"
#: Slots of a feature vector up to which it may be written out as one array, a column a slot.
DENSE_SLOTS = 256


class _TargetParams(HasInputCols, HasOutputCols, HasLabelCol):
    method = Param(Params._dummy(), "method", "additive or sigmoid", TypeConverters.toString)
    smoothing = Param(Params._dummy(), "smoothing", "smoothing strength s", TypeConverters.toFloat)
    minSamplesLeaf = Param(Params._dummy(), "minSamplesLeaf", "sigmoid midpoint", TypeConverters.toFloat)
    singleToPrior = Param(Params._dummy(), "singleToPrior",
                          "sigmoid: a category seen once gets the global mean", TypeConverters.toBoolean)
    nullAsCategory = Param(Params._dummy(), "nullAsCategory",
                           "null gets its own statistics instead of the global mean", TypeConverters.toBoolean)
    maxBroadcastBytes = Param(Params._dummy(), "maxBroadcastBytes",
                              "broadcast the statistics up to this many bytes", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(method="additive", smoothing=ADDITIVE_SMOOTHING,
                         minSamplesLeaf=float(SIGMOID_MIN_SAMPLES_LEAF), singleToPrior=True,
                         nullAsCategory=False, maxBroadcastBytes=DEFAULT_MAX_BROADCAST_BYTES)


class SmoothedTargetEncoder(Estimator, _TargetParams, MLReadable, MLWritable):
    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, labelCol="label", method="additive",
                 smoothing=ADDITIVE_SMOOTHING, minSamplesLeaf=float(SIGMOID_MIN_SAMPLES_LEAF),
                 singleToPrior=True, nullAsCategory=False, maxBroadcastBytes=DEFAULT_MAX_BROADCAST_BYTES):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "SmoothedTargetEncoderModel":
        cols = self.getInputCols()
        y = F.col(self.getLabelCol()).cast("double")
        long = (df.select(y.alias("__y"), *[F.col(c).cast("string").alias(c) for c in cols])
                  .unpivot(["__y"], cols, "feature", "category"))
        # ONE pass: per-category sums and counts; the global mean is then derived from
        # the (small) statistics of the first column instead of another scan.
        raw = materialize(long.groupBy("feature", "category").agg(
            F.sum("__y").alias("sum"), F.count("__y").cast("bigint").alias("n")), "target-sums")
        tot = raw.where(F.col("feature") == cols[0]).agg(F.sum("sum"), F.sum("n")).first()
        g = (tot[0] / tot[1]) if tot[1] else None
        # The value is an expression over the written sums: nothing is written twice.
        mean = F.col("sum") / F.col("n")
        stats = raw.select("feature", "category", mean.alias("mean"), "n", self._value(mean, F.col("n"), g).alias("value"))
        model = SmoothedTargetEncoderModel(stats=stats, globalMean=g if g is not None else float("nan"),
                                           rows=int(tot[1] or 0), bytes_=table_bytes(raw))
        return self._copyValues(model)

    def _value(self, mean, n, g):
        s = F.lit(float(self.getOrDefault(self.smoothing)))
        gl = F.lit(g).cast("double")
        if self.getOrDefault(self.method) == "additive":
            return (n * mean + s * gl) / (n + s)
        if self.getOrDefault(self.method) != "sigmoid":
            raise ValueError("method must be additive or sigmoid")
        w = 1.0 / (1.0 + F.exp(-(n - F.lit(float(self.getOrDefault(self.minSamplesLeaf)))) / s))
        value = gl * (1.0 - w) + mean * w
        if self.getOrDefault(self.singleToPrior):
            value = F.when(n == 1, gl).otherwise(value)
        return value

    def write(self):
        return _ParamsOnlyWriter(self)

    @classmethod
    def read(cls):
        return DefaultParamsReader(cls)


def attach_values(df: DataFrame, values: DataFrame, column: str, out: str, default, small: bool,
                  rows: int, null_safe: bool = False) -> DataFrame:
    """``df`` with ``out``: the value of ``column``'s category in ``values`` (``category, value, n``),
    or ``default`` (None: null). Beyond the broadcast bound, the salted join with the hot categories (at least
    1 % of the ``rows`` fitted on) known from ``n``."""
    keyed = df.withColumn("__cat", F.col(f"`{column}`").cast("string"))
    lookup = values.select(F.col("category").alias("__cat"), F.col("value").alias(out), "n")
    hot = None if small else lookup.where(F.col("n") >= max(1, rows // 100)).select("__cat")
    joined = lookup_join(keyed, lookup.drop("n"), ["__cat"], "left", null_safe=null_safe, hot_keys=hot,
                         materialize=False, small=small)
    if default is not None:
        joined = joined.withColumn(out, F.coalesce(F.col(f"`{out}`"), default))
    return joined.drop("__cat")


def out_of_fold_encode(df: DataFrame, columns: list[str], label: str, fold: str, smoothing: float = ADDITIVE_SMOOTHING,
                       suffix: str = "_te", max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` with ``<column><suffix>``: the additive target encoding fitted on the rows of all other folds, so that
    a row's label is never in its own feature.

    ONE aggregate gives sums and counts per (column, category, fold); a category's own fold is subtracted from
    its total. With sum S and count N over the other folds and g the mean label of the other folds,
    the value is ``(S + smoothing * g) / (N + smoothing)``, and g where no other fold has a label in the category.

    Rows whose ``fold`` is null (a test side) add nothing and get the statistics of all folds. Null labels add
    nothing; a null category gets g, as in ``SmoothedTargetEncoder``; where no other fold has any label, g and
    the values that hang on it are null. The table of statistics has a row per category and fold: it is
    broadcast up to ``max_broadcast_bytes``, beyond that joined with salted hot keys.
    """
    y = F.when(F.col(f"`{fold}`").isNotNull(), F.col(f"`{label}`").cast("double"))
    long = (df.select(y.alias("__y"), F.col(f"`{fold}`").alias("__fold"),
                      *[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
              .unpivot(["__y", "__fold"], columns, "feature", "category"))
    raw = materialize(long.groupBy("feature", "category", "__fold").agg(
        F.coalesce(F.sum("__y"), F.lit(0.0)).alias("sum"), F.count("__y").cast("bigint").alias("n")), "fold-sums")

    def others(name: str, by: list[str]) -> list:
        total = Window.partitionBy(*by)  # a row per fold
        return [(F.sum(c).over(total) - F.col(c)).alias(f"{name}_{c}") for c in ("sum", "n")]

    # The prior: the first column's statistics summed over its categories.
    prior = raw.where(F.col("feature") == columns[0]).groupBy("__fold").agg(F.sum("sum").alias("sum"), F.sum("n").alias("n"))
    whole = prior.agg(F.sum("sum").alias("__s"), F.sum("n").alias("__n"))  # one row
    prior = materialize(prior.join(F.broadcast(whole)).select(
        "__fold", F.when(F.col("__n") > F.col("n"), (F.col("__s") - F.col("sum")) / (F.col("__n") - F.col("n"))).alias("__g")), "fold-priors")
    stats = raw.where(F.col("category").isNotNull()).select(
        "feature", "category", "__fold", *others("o", ["feature", "category"]))
    stats = lookup_join(stats, prior, ["__fold"], "left", null_safe=True, max_broadcast_bytes=max_broadcast_bytes, materialize=False)
    s, n, g = F.lit(float(smoothing)), F.col("o_n"), F.col("__g")
    value = F.when(n > 0, (F.col("o_sum") + F.when(s > 0, s * g).otherwise(0.0)) / (n + s)).otherwise(g)
    stats = materialize(stats.select("feature", "category", "__fold", value.alias("__value")), "fold-values")
    small = table_bytes(stats) <= max_broadcast_bytes
    out = lookup_join(df.withColumn("__fold", F.col(f"`{fold}`")), prior, ["__fold"], "left", null_safe=True,
                      max_broadcast_bytes=max_broadcast_bytes, materialize=False)
    for c in columns:
        values = stats.where(F.col("feature") == c).select("category", "__fold", F.col("__value"))
        out = lookup_join(out.withColumn("__cat", F.col(f"`{c}`").cast("string")), values.withColumnRenamed("category", "__cat"),
                          ["__cat", "__fold"], "left", null_safe=True, materialize=False, small=small)
        out = out.withColumn(f"{c}{suffix}", F.when(F.col("__cat").isNull(), F.col("__g")).otherwise(F.col("__value")))
        out = out.drop("__cat", "__value")
    return out.drop("__fold", "__g")


class SmoothedTargetEncoderModel(Model, _TargetParams, MLReadable, MLWritable):
    """``rows`` and ``bytes_`` of the statistics are known from the fit, so a transform counts nothing."""

    def __init__(self, stats: DataFrame | None = None, globalMean: float | None = None, rows: int = 0,
                 bytes_: int = 0):
        super().__init__()
        self.stats = stats
        self.globalMean = globalMean
        self.rows, self.bytes_ = rows, bytes_

    def _transform(self, df: DataFrame) -> DataFrame:
        g = F.lit(self.globalMean).cast("double")
        small = self.bytes_ <= self.getOrDefault(self.maxBroadcastBytes)
        null_safe = self.getOrDefault(self.nullAsCategory)
        for c, out in zip(self.getInputCols(), self.getOutputCols()):
            df = attach_values(df, self.stats.where(F.col("feature") == c), c, out, g, small, self.rows, null_safe)
        return df

    def write(self):
        return _TargetModelWriter(self)

    @classmethod
    def read(cls):
        return _TargetModelReader(cls)


class _ParamsOnlyWriter(DefaultParamsWriter):
    pass


class _TargetModelWriter(MLWriter):
    def __init__(self, instance: SmoothedTargetEncoderModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession,
                                         extraMetadata={"globalMean": self.instance.globalMean, "rows": self.instance.rows,
                                                        "bytes": self.instance.bytes_})
        self.instance.stats.write.mode("overwrite").parquet(f"{path}/data")


class _TargetModelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> SmoothedTargetEncoderModel:
        spark = self.sparkSession
        meta = DefaultParamsReader.loadMetadata(path, spark)
        model = SmoothedTargetEncoderModel(stats=spark.read.parquet(f"{path}/data"),
                                           globalMean=meta["globalMean"], rows=meta["rows"], bytes_=meta["bytes"])
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


# ---------------------------------------------------------------------------
# Ordinal and one-hot
# ---------------------------------------------------------------------------
class _IndexerParams(HasInputCols, HasOutputCols):
    order = Param(Params._dummy(), "order", "frequency (ties alphabetical) or alphabet", TypeConverters.toString)
    nominalCols = Param(Params._dummy(), "nominalCols", "inputs whose codes are marked as categories of a known number",
                        TypeConverters.toListString)
    maxBroadcastBytes = Param(Params._dummy(), "maxBroadcastBytes",
                              "broadcast the codes up to this many bytes", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(order="frequency", nominalCols=[], maxBroadcastBytes=DEFAULT_MAX_BROADCAST_BYTES)


class CategoryIndexer(Estimator, _IndexerParams, MLReadable, MLWritable):
    """Codes 0, 1, ... per column by descending frequency (ties alphabetical) or alphabetically;
    unknown and null get the code after the last. One counting pass for all columns; the ranks
    come from a distributed sort, so no column is gathered into one task."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, order="frequency", nominalCols=(),
                 maxBroadcastBytes=DEFAULT_MAX_BROADCAST_BYTES):
        super().__init__()
        self._set(**{**self._input_kwargs, "nominalCols": list(nominalCols)})

    def _fit(self, df: DataFrame) -> "CategoryIndexerModel":
        cols = self.getInputCols()
        long = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in cols]).unpivot([], cols, "feature", "category")
        counts = long.where(F.col("category").isNotNull()).groupBy("feature", "category").agg(
            F.count(F.lit(1)).cast("bigint").alias("n"))
        if self.getOrDefault(self.order) not in ("frequency", "alphabet"):
            raise ValueError("order must be frequency or alphabet")
        by = [F.asc("category")] if self.getOrDefault(self.order) == "alphabet" else [F.desc("n"), F.asc("category")]
        codes = sorted_rank(counts, by, by=["feature"], name="__rank")
        codes = materialize(codes.select("feature", "category", "n", (F.col("__rank") - 1).cast("double").alias("value")),
                            "category-codes")
        facts = codes.groupBy("feature").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")).collect()  # a row per column
        sizes = {c: 0 for c in cols} | {r["feature"]: r["k"] for r in facts}
        model = CategoryIndexerModel(codes, sizes, max([0, *(r["n"] for r in facts)]), table_bytes(codes))
        return self._copyValues(model)

    def write(self):
        return _ParamsOnlyWriter(self)

    @classmethod
    def read(cls):
        return DefaultParamsReader(cls)


class CategoryIndexerModel(Model, _IndexerParams, MLReadable, MLWritable):
    def __init__(self, codes: DataFrame | None = None, sizes: dict[str, int] | None = None, rows: int = 0,
                 bytes_: int = 0):
        super().__init__()
        self.codes, self.sizes, self.rows, self.bytes_ = codes, sizes or {}, rows, bytes_

    def _transform(self, df: DataFrame) -> DataFrame:
        small = self.bytes_ <= self.getOrDefault(self.maxBroadcastBytes)
        for c, out in zip(self.getInputCols(), self.getOutputCols()):
            unknown = F.lit(float(self.sizes[c]))
            df = attach_values(df, self.codes.where(F.col("feature") == c), c, out, unknown, small, self.rows)
            if c in self.getOrDefault(self.nominalCols):
                df = _nominal(df, out, self.sizes[c])
        return df

    def write(self):
        return _IndexerModelWriter(self)

    @classmethod
    def read(cls):
        return _IndexerModelReader(cls)


class _IndexerModelWriter(MLWriter):
    def __init__(self, instance: CategoryIndexerModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        m = self.instance
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession,
                                         extraMetadata={"sizes": m.sizes, "rows": m.rows, "bytes": m.bytes_})
        m.codes.write.mode("overwrite").parquet(f"{path}/data")


class _IndexerModelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> CategoryIndexerModel:
        spark = self.sparkSession
        meta = DefaultParamsReader.loadMetadata(path, spark)
        model = CategoryIndexerModel(spark.read.parquet(f"{path}/data"), dict(meta["sizes"]), meta["rows"], meta["bytes"])
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


def ordinal_indexer(cols: list[str], order: str = "frequency", suffix: str = "_idx") -> CategoryIndexer:
    """Codes by frequency (ties alphabetical) or alphabetically; unknown/null -> last code."""
    return CategoryIndexer(inputCols=list(cols), outputCols=[c + suffix for c in cols], order=order)


def one_hot_stages(cols: list[str], order: str = "frequency") -> list:
    """Index then one-hot with every slot kept plus ONE slot for unknown/null.

    The indexer maps unknown/null to code ``numLabels`` and declares ``labels + 1``
    categories, so the encoder must not add a second unknown slot: width = labels + 1.
    """
    idx = CategoryIndexer(inputCols=list(cols), outputCols=[c + "_ohidx" for c in cols], order=order, nominalCols=cols)
    return [idx, _one_hot(cols)]


def _one_hot(cols: list[str] | tuple) -> OneHotEncoder:
    return OneHotEncoder(inputCols=[c + "_ohidx" for c in cols], outputCols=[c + "_vec" for c in cols],
                         dropLast=False, handleInvalid="error")


def _nominal(df: DataFrame, column: str, size: int) -> DataFrame:
    """``column`` marked as codes of ``size`` categories and the unknown one."""
    return df.withMetadata(column, {"ml_attr": {"type": "nominal", "name": column, "num_vals": size + 1}})


def one_hot_wide(df: DataFrame, cols: list[str], labels: dict[str, list[str]] | None = None) -> DataFrame:
    """Wide 0/1 columns named ``<col>_<value>`` (categories sorted), dropping ``cols``.

    A table's columns are named on the driver, so the labels are collected: as many as the
    result has columns. For wide categories use the vectors of ``one_hot_stages``.
    Null/unknown rows get 0 in every column.
    """
    if labels is None:
        long = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in cols]).unpivot([], list(cols), "feature", "category")
        labels = {c: [] for c in cols}
        for r in long.where(F.col("category").isNotNull()).distinct().orderBy("feature", "category").collect():
            labels[r["feature"]].append(r["category"])
    new = {}
    for c in cols:
        for v in labels[c]:
            new[f"{c}_{v}"] = F.when(F.col(c) == v, F.lit(1.0)).otherwise(F.lit(0.0))
    return df.withColumns(new).drop(*cols)


# ---------------------------------------------------------------------------
# Whole feature pipeline
# ---------------------------------------------------------------------------
def add_label(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """``log10(price)`` label; non-positive or null prices give null (never -inf)."""
    p = F.col("__label")
    return with_numbers(df, {"__label": roles.label}).withColumn(roles.label_col, F.when(p > 0, F.log10(p))).drop("__label")


def label_split(df: DataFrame, roles: ColumnRoles):
    """(rows with a valid ``log10(price)`` label, rejected rows with a ``reason``).

    A zero, negative, null or non-numeric price has no logarithm: such rows are kept
    out of training and reported instead of turning into -inf or disappearing.
    """
    p = strict_number(roles.label)
    tagged = df.withColumn(roles.label_col, F.when(p > 0, F.log10(p)))
    reason = (F.when(F.col(roles.label).isNull(), F.lit("price:missing"))
               .when(p.isNull(), F.lit("price:not_numeric"))
               .otherwise(F.lit("price:not_positive")))
    return (tagged.where(F.col(roles.label_col).isNotNull()),
            tagged.where(F.col(roles.label_col).isNull()).drop(roles.label_col).withColumn("reason", reason))


def feature_columns(roles: ColumnRoles) -> list[str]:
    """Assembled order: numeric, ordinal codes, one-hot vectors, target encodings."""
    return (list(roles.numeric) + [c + "_idx" for c in roles.ordinal]
            + [c + "_vec" for c in roles.onehot] + [c + "_te" for c in roles.target])


def feature_pipeline(roles: ColumnRoles, method: str = "additive", smoothing: float = ADDITIVE_SMOOTHING,
                     min_samples_leaf: float = SIGMOID_MIN_SAMPLES_LEAF, ordinal_order: str = "frequency",
                     features_col: str = "features") -> Pipeline:
    te = SmoothedTargetEncoder(inputCols=list(roles.target), outputCols=[c + "_te" for c in roles.target],
                               labelCol=roles.label_col, method=method, smoothing=smoothing,
                               minSamplesLeaf=float(min_samples_leaf))
    # One indexer (one counting pass, one sort) for the ordinal and the one-hot columns.
    coded = list(roles.ordinal) + list(roles.onehot)
    stages = [CategoryIndexer(inputCols=coded, order=ordinal_order, nominalCols=list(roles.onehot),
                              outputCols=[c + "_idx" for c in roles.ordinal] + [c + "_ohidx" for c in roles.onehot])
              ] if coded else []
    stages += [_one_hot(roles.onehot)] if roles.onehot else []
    return Pipeline(stages=[*stages, te, _assembler(roles, features_col)])


def _assembler(roles: ColumnRoles, features_col: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=feature_columns(roles), outputCol=features_col, handleInvalid="keep")


def fold_encoded(df: DataFrame, roles: ColumnRoles, fold: str, folds: list[int], method: str = "additive",
                 smoothing: float = ADDITIVE_SMOOTHING, min_samples_leaf: float = SIGMOID_MIN_SAMPLES_LEAF,
                 ordinal_order: str = "frequency", max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                 max_rows: int | None = None):
    """``(table, features)``: the encoders of ``feature_pipeline`` fitted for every fold on the rows of all other folds,
    in one count and one lookup per column for all folds together.

    ``table`` is written once: ``fold``, the label, the numeric columns and for every categorical column a struct with one
    field per fold, of which a reader of one fold reads one. ``features(rows, k)`` gives rows of it ``features`` and the
    label as the pipeline fitted without fold ``k`` would: the same values, unknown slots and vector widths; with ``dense``
    from one array, in half the time of encoder and assembler, unless they are wider than ``DENSE_SLOTS``. ``df`` has
    no null label or fold and is read twice: pass a written table. ``max_rows``: of a file of ``table`` at most.
    """
    coded = list(roles.ordinal) + list(roles.onehot)
    cols = coded + list(roles.target)
    te = SmoothedTargetEncoder(inputCols=list(roles.target), outputCols=[c + "_te" for c in roles.target],
                               labelCol=roles.label_col, method=method, smoothing=smoothing,
                               minSamplesLeaf=float(min_samples_leaf))
    if ordinal_order not in ("frequency", "alphabet"):
        raise ValueError("order must be frequency or alphabet")
    long = (df.select(F.col(roles.label_col).cast("double").alias("__y"), F.col(fold).alias("__fold"),
                      *[F.col(f"`{c}`").cast("string").alias(c) for c in cols])
              .unpivot(["__y", "__fold"], cols, "feature", "category"))
    raw = materialize(long.groupBy("feature", "category", "__fold").agg(
        F.sum("__y").alias("sum"), F.count(F.lit(1)).alias("n")), "fold-sums")
    priors = {r["__fold"]: (r["sum"], r["n"]) for r in raw.where(F.col("feature") == roles.target[0]).groupBy("__fold").agg(
        F.sum("sum").alias("sum"), F.sum("n").alias("n")).collect()}  # a row per fold

    def others(name: str, k: int):
        return F.sum(F.when(F.col("__fold") != k, F.col(name)))

    def prior(k: int):
        rest = [v for f, v in priors.items() if f != k]
        return sum(v[0] for v in rest) / sum(v[1] for v in rest) if rest else None

    g = {k: prior(k) for k in folds}
    both = [others(name, k).alias(f"{name}{k}") for k in folds for name in ("sum", "n")]
    stats = raw.where(F.col("category").isNotNull()).groupBy("feature", "category").agg(F.sum("n").alias("n"), *both)
    values = [te._value(F.col(f"sum{k}") / F.col(f"n{k}"), F.col(f"n{k}"), g[k]).alias(f"f{k}") for k in folds]
    tables = {"te": materialize(stats.where(F.col("feature").isin(list(roles.target))).select(
        "feature", "category", "n", F.struct(*values).alias("value")), "fold-values")}
    sizes: dict[tuple[int, str], int] = {}
    if coded:
        # A row per category and fold in which it has rows to learn from, ranked within its column and fold.
        entry = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"n{k}").alias("n_k")) for k in folds]))
        ranks = (stats.where(F.col("feature").isin(coded)).select("feature", "category", "n", entry.alias("__e"))
                      .select("feature", "category", "n", "__e.k", "__e.n_k").where(F.col("n_k").isNotNull()))
        by = [F.asc("category")] if ordinal_order == "alphabet" else [F.desc("n_k"), F.asc("category")]
        ranks = materialize(sorted_rank(ranks, by, by=["k", "feature"], name="__rank"), "fold-ranks")
        sizes = {(r["k"], r["feature"]): r["count"] for r in ranks.groupBy("k", "feature").count().collect()}  # folds x columns
        codes = [F.max(F.when(F.col("k") == k, F.col("__rank") - 1)).cast("double").alias(f"f{k}") for k in folds]
        tables["code"] = materialize(ranks.groupBy("feature", "category").agg(
            F.max("n").alias("n"), F.struct(*codes).alias("value")), "fold-codes")
    total = sum(v[1] for v in priors.values())
    table = df.select(fold, roles.label_col, *roles.numeric, *[F.col(f"`{c}`").alias(f"__in_{c}") for c in cols])
    small = {name: table_bytes(t.select("feature", "category", *[F.col(f"value.f{k}") for k in folds])) <= max_broadcast_bytes
             for name, t in tables.items()}
    for c in cols:
        name = "code" if c in coded else "te"
        table = attach_values(table, tables[name].where(F.col("feature") == c), f"__in_{c}", f"__v_{c}", None, small[name],
                              total).drop(f"__in_{c}")
    table = materialize(table, "fold-encoded", max_rows=max_rows)

    def features(rows: DataFrame, k: int, dense: bool = False) -> DataFrame:
        def value(c: str, default, out: str):
            return F.coalesce(F.col(f"`__v_{c}`.f{k}"), F.lit(default).cast("double")).alias(out)

        widths = {c: sizes.get((k, c), 0) + 1 for c in roles.onehot}
        if dense and len(feature_columns(roles)) + sum(widths.values()) <= DENSE_SLOTS:
            slots = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in roles.numeric]
            slots += [value(c, sizes.get((k, c), 0), c) for c in roles.ordinal]
            slots += [(value(c, widths[c] - 1, c) == i).cast("double") for c in roles.onehot for i in range(widths[c])]
            slots += [value(c, g[k], c) for c in roles.target]
            return rows.select(array_to_vector(F.array(*slots)).alias("features"), roles.label_col)
        out = rows.select(roles.label_col, *roles.numeric,
                          *[value(c, sizes.get((k, c), 0), c + "_idx") for c in roles.ordinal],
                          *[value(c, sizes.get((k, c), 0), c + "_ohidx") for c in roles.onehot],
                          *[value(c, g[k], c + "_te") for c in roles.target])
        for c in roles.onehot:
            out = _nominal(out, c + "_ohidx", sizes.get((k, c), 0))
        stages = ([_one_hot(roles.onehot)] if roles.onehot else []) + [_assembler(roles)]
        return Pipeline(stages=stages).fit(out).transform(out).select("features", roles.label_col)

    return table, features


def _all_stages(model) -> list:
    out = []
    for s in getattr(model, "stages", [model]):
        out.extend(_all_stages(s) if isinstance(s, PipelineModel) else [s])
    return out


def encoding_map(model, spark: SparkSession | None = None) -> DataFrame:
    """Long ``(kind, feature, category, value)`` table of every fitted encoder.

    Target statistics and category codes stay distributed. The unknown/null slot of each
    indexer is listed explicitly as ``__unknown__``. A ``global_mean`` row carries the prior.
    """
    parts, rows = [], []
    for st in _all_stages(model):
        if isinstance(st, SmoothedTargetEncoderModel):
            spark = spark or st.stats.sparkSession
            parts.append(st.stats.select(F.lit("target").alias("kind"), "feature", "category", "value"))
            rows.append(("global_mean", st.getLabelCol(), None, float(st.globalMean)))
        elif isinstance(st, CategoryIndexerModel):
            nominal = st.getOrDefault(st.nominalCols)
            kind = F.when(F.col("feature").isin(nominal), "onehot").otherwise("ordinal") if nominal else F.lit("ordinal")
            parts.append(st.codes.select(kind.alias("kind"), "feature", "category", "value"))
            rows += [("onehot" if c in nominal else "ordinal", c, UNKNOWN, float(st.sizes[c])) for c in st.getInputCols()]
    spark = spark or SparkSession.active()
    out = spark.createDataFrame(rows, "kind string, feature string, category string, value double")
    for p in parts:
        out = out.unionByName(p)
    return out


def one_hot_widths(model) -> dict[str, int]:
    """Slots of each one-hot column: its categories and the unknown one."""
    return {c: st.sizes[c] + 1 for st in _all_stages(model)
            if isinstance(st, CategoryIndexerModel) for c in st.getOrDefault(st.nominalCols)}
