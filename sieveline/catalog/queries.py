"""One query per operator, each over whole tables."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.catalog import views
from sieveline.catalog.views import DOC_FEATURES, PLAIN_FEATURES, SEED, table
from sieveline.operators import bins, clean, explain, features, group_bins, lift, metrics, models, ranks, search, selection, split, staged
from sieveline.operators.search import BOOSTED_SPACE
from sieveline.plans.boosting import train_boosted
from sieveline.plans.training import clean_table, train_classifier
from sieveline.sources import artifacts
from sieveline.sources.scratch import scratch_path
from sieveline.sources.tables import read_headerless_csv, read_inferred_csv

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
DIRTY_COLUMNS = ["f1", "f2", "f3"]
# Sizes for queries that run curves and bins in many pieces and rounds, as on large tables.
PIECE, BRACKET = 1_000, 500


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- sources and cleaning ---------------------------------------------------------------------


@query
def csv_scan(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    path = scratch_path(spark, "csv")
    part.write.option("header", False).csv(path)
    schema = "partkey bigint, name string, brand string, type string, size int, price double"
    return read_headerless_csv(spark, path, schema)


@query
def inferred_csv(spark, sf_dir):
    """Orders as a headerless CSV with sentinels in all columns but the id; types and nulls as they are told from the text."""
    path = scratch_path(spark, "csv")
    id, missing = F.col("o_orderkey"), F.lit("?")
    text = lambda c, k: F.when(id % k == 0, missing).otherwise(c.cast("string"))
    table(spark, sf_dir, "orders").select(
        id,
        text(F.col("o_custkey"), 7),
        text(F.col("o_orderkey") * 10_000_000_000, 11),
        text(F.col("o_totalprice").cast("decimal(18,2)"), 5),
        text(F.col("o_orderpriority"), 3),
        missing,
        (F.col("o_orderstatus") == "F").cast("int"),
    ).write.option("header", False).csv(path)
    found = read_inferred_csv(spark, path)
    kinds = F.array(*[F.lit(t) for _, t in found.dtypes])
    return found.withColumn("kinds", F.array_join(kinds, ","))


@query
def sentinel_to_null(spark, sf_dir):
    return clean.sentinel_to_null(views.dirty(spark, sf_dir))


def _cleaned(spark, sf_dir) -> DataFrame:
    df = views.dirty(spark, sf_dir)
    text = [c for c in clean.columns_of_type(df, "string") if c != "target"]
    return clean.cast_to_int(clean.sentinel_to_null(df, columns=text), text)


@query
def cast_columns(spark, sf_dir):
    nulled = clean.sentinel_to_null(views.dirty(spark, sf_dir), columns=DIRTY_COLUMNS)
    return clean.cast_to_double(clean.cast_to_int(nulled, ["f1", "f2"]), ["f3"])


@query
def null_profile(spark, sf_dir):
    return clean.null_profile(clean.sentinel_to_null(views.dirty(spark, sf_dir)))


@query
def drop_sparse_columns(spark, sf_dir):
    return clean.drop_sparse_columns(_cleaned(spark, sf_dir), DIRTY_COLUMNS)


@query
def impute_median(spark, sf_dir):
    nulled = clean.sentinel_to_null(views.dirty(spark, sf_dir), columns=DIRTY_COLUMNS)
    numbers = clean.cast_to_double(nulled, DIRTY_COLUMNS)
    return rounded(clean.handle_missing(numbers, DIRTY_COLUMNS, method="exact"), "f1", "f3")


@query
def impute_nan(spark, sf_dir):
    """NaN counts as missing: a column of mostly NaN goes, the other is filled with its median."""
    id, price, nan = F.col("o_orderkey"), F.col("o_totalprice").cast("double"), F.lit(float("nan"))
    numbers = table(spark, sf_dir, "orders").select(
        id.alias("id"),
        F.when(id % 3 == 0, nan).otherwise(price).alias("f1"),
        F.when(id % 3 == 0, price).otherwise(nan).alias("f2"),
    )
    return rounded(clean.handle_missing(numbers, ["f1", "f2"], method="exact", nan_as_null=True), "f1")


@query
def medians_wide(spark, sf_dir):
    """Exact medians of many columns at once, with intervals small enough to take several rounds."""
    size = 64
    vectors = table(spark, sf_dir, "embeddings").select(*[F.col("embedding")[i].alias(f"e{i}") for i in range(size)])
    found = ranks.exact_medians(vectors, vectors.columns, bracket_rows=100)
    rows = spark.createDataFrame([(i, found[f"e{i}"]) for i in range(size)], "position int, median double")
    return rounded(rows, "median")


@query
def impute_median_disc(spark, sf_dir):
    return clean.handle_missing(_cleaned(spark, sf_dir), DIRTY_COLUMNS, method="approx", error=0.0)


@query
def median_within_error(spark, sf_dir):
    """Whether approximate medians are observed values within the rank error they promise."""
    df = _cleaned(spark, sf_dir)
    found = clean.median_values(df, ["f1", "f3"], "approx", 0.01)

    def close(c: str) -> Column:
        value, half = F.lit(found[c]), F.count(c) / 2
        slack = F.count(c) * 0.01 + 1
        below, upto = F.count_if(F.col(c) < value), F.count_if(F.col(c) <= value)
        return ((upto > below) & (below <= half + slack) & (upto >= half - slack)).alias(c)

    return df.agg(close("f1"), close("f3"))


@query
def binarize_label(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("target"))
    return clean.binarize_label(orders, "target", "F")


@query
def project_features(spark, sf_dir):
    return clean.project_features(table(spark, sf_dir, "orders"), ["o_custkey", "o_totalprice"], "o_orderstatus")


# --- splits -----------------------------------------------------------------------------------


def _order_ids(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))


@query
def hash_split(spark, sf_dir):
    return split.hash_split(_order_ids(spark, sf_dir), "id", seed=SEED)


@query
def random_split(spark, sf_dir):
    train, test = split.random_split(_order_ids(spark, sf_dir), [0.8, 0.2], SEED)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@query
def random_split_union(spark, sf_dir):
    """The parts of a random split hold every row once."""
    train, test = split.random_split(_order_ids(spark, sf_dir), [0.8, 0.2], SEED)
    return train.unionByName(test)


@query
def three_way_split(spark, sf_dir):
    return split.three_way_split(_order_ids(spark, sf_dir), "id")


@query
def kfold_assign(spark, sf_dir):
    return split.assign_folds(_order_ids(spark, sf_dir), "id", 5, SEED)


# --- features ---------------------------------------------------------------------------------


@query
def label_index(spark, sf_dir):
    model = features.fit_label_index(table(spark, sf_dir, "orders"), "o_orderpriority")
    return features.label_table(spark, model)


@query
def label_encode(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_orderpriority")
    return features.encode_label(orders, features.fit_label_index(orders, "o_orderpriority"))


def _elements(vector: str, names: list[str]) -> list[Column]:
    values = vector_to_array(F.col(vector))
    return [values[i].alias(f"x{i + 1}") for i in range(len(names))]


@query
def assemble_features(spark, sf_dir):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", *columns)
    return features.assemble(lines, columns).select("l_orderkey", "l_returnflag", *_elements("features", columns))


@query
def prepare_data(spark, sf_dir):
    columns = ["o_custkey", "o_totalprice"]
    orders = split.hash_split(table(spark, sf_dir, "orders"), "o_orderkey", seed=SEED)
    index = features.fit_label_index(orders, "o_orderstatus")
    train, test = (orders.where(F.col("split") == s) for s in ("train", "test"))
    keep = ["o_orderkey", "split"]
    train, test = features.prepare_data(train, test, columns, "o_orderstatus", index, keep)
    return train.unionByName(test).select(
        F.col("o_orderkey").alias("id"), "split", "label", *_elements("features", columns)
    )


@query
def balanced_weights(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("label"))
    return rounded(features.balanced_weights(orders), "class_weight")


# --- parameter tables -------------------------------------------------------------------------


def _ranges(spark, sf_dir, value: str, num: int) -> DataFrame:
    ends = F.min(value).cast("int").alias("start"), F.max(value).cast("int").alias("stop")
    return table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("brand")).agg(*ends, F.lit(num).alias("num"))


@query
def search_space(spark, sf_dir):
    return search.search_space(_ranges(spark, sf_dir, "p_size", 5), ["brand"])


@query
def param_grid(spark, sf_dir):
    spaces = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("brand")).agg(
        search.even_steps(F.min("p_size"), F.max("p_size"), F.lit(5)).alias("size"),
        search.even_steps(F.min(F.floor("p_retailprice")), F.max(F.floor("p_retailprice")), F.lit(3)).alias("price"),
        search.even_steps(F.min("p_size"), F.max(F.length("p_name")), F.lit(2)).alias("length"),
    )
    return search.parameter_grid(spaces, ["brand"], ["size", "price", "length"])


# --- evaluation -------------------------------------------------------------------------------


@query
def multiclass_metrics(spark, sf_dir):
    result = metrics.multiclass_metrics(views.classified(spark, sf_dir))
    return rounded(result, "accuracy", "weighted_precision", "weighted_recall", "weighted_f1")


@query
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(views.classified(spark, sf_dir))


@query
def confusion_pairs(spark, sf_dir):
    return metrics.confusion_pairs(views.classified(spark, sf_dir))


def _classified_nulls(spark, sf_dir) -> DataFrame:
    df = views.classified(spark, sf_dir)
    return df.select(
        F.when(F.col("id") % 7 != 0, F.col("label")).alias("label"),
        F.when(F.col("id") % 11 != 0, F.col("prediction")).alias("prediction"),
    )


@query
def confusion_nulls(spark, sf_dir):
    return metrics.confusion_matrix(_classified_nulls(spark, sf_dir))


@query
def confusion_other(spark, sf_dir):
    """With the columns given, the predictions of other classes are counted too."""
    return metrics.confusion_matrix(_classified_nulls(spark, sf_dir), classes=["F"])


@query
def metrics_nulls(spark, sf_dir):
    result = metrics.multiclass_metrics(_classified_nulls(spark, sf_dir))
    return rounded(result, "accuracy", "weighted_precision", "weighted_recall", "weighted_f1")


@query
def recall_by_split(spark, sf_dir):
    return rounded(metrics.recall(views.scored_sets(spark, sf_dir), "label", "pred", by="split"), "recall")


@query
def penalized_objective(spark, sf_dir):
    result = metrics.penalized_recall(views.scored_sets(spark, sf_dir), "label", "pred")
    return rounded(result, "train_recall", "validation_recall", "objective")


@query
def roc_curve(spark, sf_dir):
    return rounded(metrics.roc_curve(views.scored(spark, sf_dir)), "fpr", "tpr")


@query
def roc_corners(spark, sf_dir):
    return rounded(metrics.roc_corners(views.scored(spark, sf_dir), score="tied_score"), "fpr", "tpr")


@query
def roc_corners_pieces(spark, sf_dir):
    """Corners of the curves of several sets, in pieces that hold few rows each."""
    return rounded(metrics.roc_corners(views.scored_sets(spark, sf_dir), by="split", piece_rows=PIECE), "fpr", "tpr")


@query
def roc_by_split(spark, sf_dir):
    return rounded(metrics.roc_curve(views.scored_sets(spark, sf_dir), by="split"), "fpr", "tpr")


@query
def roc_auc(spark, sf_dir):
    return rounded(metrics.roc_auc(views.scored(spark, sf_dir)), "auc")


@query
def auc_by_split(spark, sf_dir):
    return rounded(metrics.roc_auc(views.scored_sets(spark, sf_dir), by="split"), "auc")


@query
def hard_auc_by_split(spark, sf_dir):
    return rounded(metrics.roc_auc(views.scored_sets(spark, sf_dir), score="pred", by="split"), "auc")



@query
def roc_pieces(spark, sf_dir):
    return rounded(metrics.roc_curve(views.scored(spark, sf_dir), piece_rows=PIECE), "fpr", "tpr")


@query
def auc_pieces_by_split(spark, sf_dir):
    return rounded(metrics.roc_auc(views.scored_sets(spark, sf_dir), by="split", piece_rows=PIECE), "auc")


@query
def bins_narrowed(spark, sf_dir):
    df = views.scored(spark, sf_dir)
    return bins.fit_quantile_bins(df, "score", bracket_rows=BRACKET).apply(df).select("id", "bin")


@query
def tied_bins_narrowed(spark, sf_dir):
    df = views.scored(spark, sf_dir)
    return bins.fit_score_bins(df, "tied_score", "id", bracket_rows=BRACKET).apply(df).select("id", "bin")


@query
def weighted_bins_narrowed(spark, sf_dir):
    df = views.scored(spark, sf_dir)
    return bins.fit_weighted_bins(df, "tied_score", "id", "w", bracket_rows=BRACKET).apply(df).select("id", "bin")


def _customer_orders(spark, sf_dir) -> DataFrame:
    return views.scored(spark, sf_dir).join(
        table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer")), "id"
    )


@query
def quantile_bins_by_order(spark, sf_dir):
    """Quartiles of the lines of every order: thousands of sets."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("score"))
    return bins.fit_quantile_bins(lines, "score", 4, by="l_orderkey").apply(lines)


@query
def rank_bins_by_customer(spark, sf_dir):
    df = _customer_orders(spark, sf_dir)
    return bins.fit_rank_bins(df, "tied_score", "id", 4, by="customer").apply(df).select("customer", "id", "bin")


@query
def weighted_bins_by_customer(spark, sf_dir):
    df = _customer_orders(spark, sf_dir)
    return bins.fit_weighted_bins(df, "tied_score", "id", "w", 4, by="customer").apply(df).select("customer", "id", "bin")


@query
def set_bins_narrowed(spark, sf_dir):
    """Edges as a table, of sets with many rows, in brackets small enough to take several rounds."""
    df = views.scored_sets(spark, sf_dir)
    fitted = group_bins.fit_by_set(df, "score", "id", 10, "split", BRACKET // 10, kind="rank")
    return fitted.apply(df).select("split", "id", "bin")


@query
def decimal_id_bins(spark, sf_dir):
    """Ties are split by decimal ids that differ only beyond the precision of a double."""
    large = F.lit(1 << 59).cast("decimal(18,0)")
    df = views.scored(spark, sf_dir).withColumn("key", (F.col("id") + large).cast("decimal(18,0)"))
    return bins.fit_rank_bins(df, "tied_score", "key").apply(df).select("id", "bin")


# --- bins, lift and gain ----------------------------------------------------------------------


@query
def quantile_bins(spark, sf_dir):
    df = views.scored(spark, sf_dir)
    return bins.fit_quantile_bins(df, "score").apply(df).select("id", "bin")


@query
def rank_bins(spark, sf_dir):
    df = views.scored(spark, sf_dir)
    return bins.fit_rank_bins(df, "score", "id").apply(df).select("id", "bin")


@query
def tied_score_bins(spark, sf_dir):
    df = views.scored(spark, sf_dir)
    return bins.fit_score_bins(df, "tied_score", "id").apply(df).select("id", "bin")


@query
def weighted_bins(spark, sf_dir):
    df = views.scored(spark, sf_dir)
    return bins.fit_weighted_bins(df, "score", "id", "w").apply(df).select("id", "bin")


@query
def tied_weighted_bins(spark, sf_dir):
    df = views.scored(spark, sf_dir)
    return bins.fit_weighted_bins(df, "tied_score", "id", "w").apply(df).select("id", "bin")


LIFT = ["baseline_percentage", "lift_percentage", "lift_index"]


@query
def lift_table(spark, sf_dir):
    summary = lift.bin_summary(views.scored(spark, sf_dir), "label", "score", "id", weight="w")
    return rounded(lift.lift_table(summary), *LIFT)


@query
def gain_table(spark, sf_dir):
    summary = lift.bin_summary(views.scored(spark, sf_dir), "label", "score", "id")
    return rounded(lift.gain_table(summary), "gain")


@query
def lift_gain_table(spark, sf_dir):
    summary = lift.bin_summary(views.scored(spark, sf_dir), "label", "score", "id")
    return rounded(lift.lift_gain_table(summary), *LIFT, "gain")


@query
def lift_by_split(spark, sf_dir):
    summary = lift.bin_summary(views.scored_sets(spark, sf_dir), "label", "pred", "id", by="split")
    return rounded(lift.lift_gain_table(summary, "split"), *LIFT, "gain")


@query
def lift_null_set(spark, sf_dir):
    """Rows without a set name are a set of their own."""
    df = views.scored_sets(spark, sf_dir).withColumn("split", F.when(F.col("split") != "test", F.col("split")))
    summary = lift.bin_summary(df, "label", "pred", "id", by="split")
    return rounded(lift.lift_table(summary, "split"), *LIFT)


@query
def top_scored_row(spark, sf_dir):
    return models.top_scored(views.scored(spark, sf_dir)).select("id", "label", "score")


# --- attribution tables -----------------------------------------------------------------------


@query
def top_contributions(spark, sf_dir):
    return rounded(explain.top_contributions(views.contrib(spark, sf_dir), k=6), "contribution")


@query
def mean_abs_contribution(spark, sf_dir):
    return rounded(explain.mean_abs_contribution(views.contrib(spark, sf_dir), k=8), "mean_abs")


# --- stored artifacts -------------------------------------------------------------------------


@query
def feature_list_roundtrip(spark, sf_dir):
    kept = clean.drop_sparse_columns(_cleaned(spark, sf_dir), DIRTY_COLUMNS)
    path = scratch_path(spark, "features")
    artifacts.store_features(spark, [c for c in kept.columns if c != "target"], path)
    return artifacts.read_features(spark, path)


@query
def hyperparameters_roundtrip(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    found = orders.agg(
        (F.count_distinct("o_orderpriority") + 3).cast("int").alias("numTrees"),
        (F.count_distinct("o_orderstatus") + 1).cast("int").alias("maxDepth"),
        F.greatest(F.lit(3), F.floor(F.avg("o_totalprice") / 10000)).cast("int").alias("maxBins"),
    )
    path = scratch_path(spark, "hyperparameters")
    artifacts.store_hyperparameters(spark, found.first().asDict(), path)
    loaded = artifacts.load_hyperparameters(spark, path)
    forest = artifacts.with_hyperparameters(models.random_forest(SEED), loaded)
    return artifacts.hyperparameter_table(spark, {name: forest.getOrDefault(name) for name in loaded})


@query
def model_roundtrip(spark, sf_dir):
    """Per test document, whether the stored model scores it like the fitted one."""
    train, test, _ = views.document_vectors(spark, sf_dir, DOC_FEATURES)
    model = models.random_forest(SEED, numTrees=5).fit(train)
    path = scratch_path(spark, "model")
    artifacts.store_model(model, path)
    again = artifacts.load_model(RandomForestClassificationModel, path)
    before = models.score(model, test).select("id", vector_to_array("probability").alias("before"), "features")
    after = again.setProbabilityCol("probability_again").setPredictionCol("p").setRawPredictionCol("r").transform(before)
    return after.select("id", (F.col("before") == vector_to_array("probability_again")).alias("unchanged"))


# --- models -----------------------------------------------------------------------------------


@query
def random_forest_score(spark, sf_dir):
    train, test, _ = views.document_vectors(spark, sf_dir, DOC_FEATURES)
    scored = models.score(models.random_forest(SEED).fit(train), test)
    return models.class_probability(scored).select("id", "label", "prediction", "score")


@query
def forest_probabilities(spark, sf_dir):
    """Per test document, the sum of the class probabilities and whether the most likely class is predicted."""
    train, test, _ = views.document_vectors(spark, sf_dir, DOC_FEATURES)
    scored = models.score(models.random_forest(SEED).fit(train), test).withColumn("p", vector_to_array("probability"))
    likely = F.col("p")[F.col("prediction").cast("int")] == F.array_max("p")
    return scored.select("id", F.round(F.aggregate("p", F.lit(0.0), lambda a, x: a + x), 6).alias("total"), likely.alias("likely"))


@query
def boosted_score(spark, sf_dir):
    train, test, _ = views.document_vectors(spark, sf_dir, DOC_FEATURES)
    settings = {"n_estimators": 10, "max_depth": 4, "max_bin": 63, "learning_rate": 0.1, "class_weight": "balanced"}
    train, weight = models.with_class_weight(train, settings["class_weight"])
    scored = models.score(models.boosted_trees(settings, SEED, weight=weight).fit(train), test)
    return models.class_probability(scored).select("id", "label", "prediction", "score")


@query
def feature_importance(spark, sf_dir):
    names = DOC_FEATURES + PLAIN_FEATURES
    train, _, _ = views.document_vectors(spark, sf_dir, names)
    return features.importance_table(spark, models.random_forest(SEED).fit(train), names)


@query
def importance_of_constant(spark, sf_dir):
    """Importances add up to one and leave nothing to a constant feature."""
    names = DOC_FEATURES + PLAIN_FEATURES
    train, _, _ = views.document_vectors(spark, sf_dir, names)
    importances = features.importance_table(spark, models.random_forest(SEED).fit(train), names)
    constant = F.sum(F.when(F.col("feature") == "constant", F.col("importance")))
    return importances.agg(
        F.count("feature").alias("features"), F.round(F.sum("importance"), 6).alias("total"), constant.alias("constant")
    )


def _indexed_documents(spark, sf_dir) -> DataFrame:
    docs = views.docfeat(spark, sf_dir)
    return features.encode_label(docs, features.fit_label_index(docs, "target"))


@query
def recursive_elimination(spark, sf_dir):
    names = DOC_FEATURES + PLAIN_FEATURES
    kept = selection.recursive_elimination(_indexed_documents(spark, sf_dir), names, 3, SEED)
    return artifacts.feature_table(spark, kept)


@query
def shadow_selection(spark, sf_dir):
    names = DOC_FEATURES + PLAIN_FEATURES
    forest = models.random_forest(SEED, numTrees=10)
    return selection.shadow_selection(_indexed_documents(spark, sf_dir), names, "id", SEED, trials=8, estimator=forest)


@query
def shadow_rejects(spark, sf_dir):
    """A constant feature never beats the shadows and is rejected."""
    names = DOC_FEATURES + PLAIN_FEATURES
    forest = models.random_forest(SEED, numTrees=5)
    found = selection.shadow_selection(
        _indexed_documents(spark, sf_dir), names, "id", SEED, trials=8, estimator=forest, importance="impurity"
    )
    return found.where(F.col("feature") == "constant").select("feature", "hits", "trials", "decision", "importance")


def _in_range(score: str) -> Column:
    return F.col(score).between(-1, 1).alias("in_range")


def _grid(spark, sf_dir) -> search.SearchResult:
    train, _, _ = views.document_vectors(spark, sf_dir, DOC_FEATURES)
    forest = models.random_forest(SEED)
    maps = search.parameter_maps(
        forest, {"numTrees": {"start": 3, "stop": 9, "num": 2}, "maxDepth": {"start": 2, "stop": 5, "num": 2}}
    )
    return search.grid_search(forest, maps, split.assign_folds(train, "id", 3, SEED), folds=3)


@query
def grid_search(spark, sf_dir):
    """The score of every parameter map in every fold, and their mean."""
    return _grid(spark, sf_dir).trials.select("params", "score", F.posexplode("fold_scores").alias("fold", "fold_score"))


@query
def grid_search_shape(spark, sf_dir):
    """The parameter maps tried, the folds of each and whether its score is one."""
    return _grid(spark, sf_dir).trials.select("params", F.size("fold_scores").alias("folds"), _in_range("score"))


@query
def grid_search_folds(spark, sf_dir):
    """How many rows of each class every candidate scored in every fold."""
    found = _grid(spark, sf_dir)
    counts = found.outcomes.groupBy("trial", "fold", "label").agg(F.sum("n").alias("n"))
    return counts.join(found.trials.select("trial", "params"), "trial").select("params", "fold", "label", "n")


@query
def grid_search_majority(spark, sf_dir):
    """Trees without a split predict the class that most training rows have, so their scores can be told without a model."""
    train, _, _ = views.document_vectors(spark, sf_dir, DOC_FEATURES)
    forest = models.random_forest(SEED)
    maps = [{forest.maxDepth: 0, forest.numTrees: n} for n in (20, 40)]
    trials = search.grid_search(forest, maps, split.assign_folds(train, "id", 3, SEED), folds=3).trials
    return trials.select("trial", F.round("score", 6).alias("score"), F.posexplode("fold_scores").alias("fold", "fold_score")).select(
        "trial", "score", "fold", F.round("fold_score", 6).alias("fold_score")
    )


@query
def best_parameters(spark, sf_dir):
    """Parameters of the best model, and whether they are those of the best trial: highest score, then the earlier one."""
    found = _grid(spark, sf_dir)
    best = json.loads(found.trials.orderBy(F.desc("score"), "trial").first()["params"])
    tuned = search.tuned_parameters(found.best_model, ["maxDepth", "numTrees"])
    again = search.refit(models.random_forest(SEED), tuned, views.document_vectors(spark, sf_dir, DOC_FEATURES)[0])
    rows = [(name, value == best[name], value == again.getOrDefault(name)) for name, value in tuned.items()]
    return spark.createDataFrame(rows, "param string, of_best boolean, refitted boolean")


def _random(spark, sf_dir) -> search.SearchResult:
    train, test, _ = views.document_vectors(spark, sf_dir, DOC_FEATURES)
    space = BOOSTED_SPACE | {"n_estimators": ("int", 3, 8), "max_depth": ("int", 3, 6), "min_data_in_leaf": ("int", 4, 20)}
    return search.random_search(train, test, search.draw_settings(space, 4, SEED), SEED, "penalized")


@query
def random_search(spark, sf_dir):
    """The score of every trial."""
    return _random(spark, sf_dir).trials


@query
def random_search_shape(spark, sf_dir):
    """The trials made, how many parameters each has and whether its score is one."""
    trials = _random(spark, sf_dir).trials
    return trials.select("trial", F.size(F.json_object_keys("params")).alias("parameters"), _in_range("score"))


@query
def random_search_sets(spark, sf_dir):
    """How many rows of each class every trial scored in both sets."""
    return _random(spark, sf_dir).outcomes.groupBy("trial", "set", "label").agg(F.sum("n").alias("n"))


def _staged(spark, sf_dir) -> DataFrame:
    train, test, _ = views.document_vectors(spark, sf_dir, DOC_FEATURES)
    model = models.boosted_trees({"n_estimators": 12, "max_depth": 4, "max_bin": 63}, SEED).fit(train)
    return staged.staged_outcomes(test, model, [1, 2, 4, 8, 12], [])


@query
def staged_boosting(spark, sf_dir):
    """Quality of the shorter models inside one fit of boosted trees."""
    return metrics.multiclass_metrics_of(_staged(spark, sf_dir), "n_estimators")


@query
def staged_totals(spark, sf_dir):
    """Every length scores every test row: rows of each class by number of trees."""
    return _staged(spark, sf_dir).groupBy("n_estimators", "label").agg(F.sum("n").alias("n"))


@query
def boosted_probabilities(spark, sf_dir):
    """Per test document, the sum of the class probabilities and whether the most likely class is predicted."""
    train, test, _ = views.document_vectors(spark, sf_dir, DOC_FEATURES)
    scored = models.score(models.boosted_trees({"n_estimators": 5, "max_depth": 3}, SEED).fit(train), test)
    p = scored.withColumn("p", vector_to_array("probability"))
    likely = F.col("p")[F.col("prediction").cast("int")] == F.array_max("p")
    return p.select("id", F.round(F.aggregate("p", F.lit(0.0), lambda a, x: a + x), 6).alias("total"), likely.alias("likely"))


@query
def elimination_of_constant(spark, sf_dir):
    """Recursive elimination never keeps a constant feature above the minimum, and keeps a feature at least."""
    names = DOC_FEATURES + PLAIN_FEATURES
    kept = selection.recursive_elimination(_indexed_documents(spark, sf_dir), names, 3, SEED)
    return artifacts.feature_table(spark, kept).agg(
        F.count_if(F.col("selected_features") == "constant").alias("constant"), (F.count("position") >= 3).alias("enough")
    )


def _explained(spark, sf_dir) -> DataFrame:
    train, test, _ = views.document_vectors(spark, sf_dir, DOC_FEATURES)
    model = models.random_forest(SEED).fit(train)
    explainer = explain.fit_explainer(spark, model)
    return models.class_probability(explain.attribute(models.score(model, test), explainer))


@query
def tree_attribution(spark, sf_dir):
    return _explained(spark, sf_dir).select("id", "base_value", F.posexplode("contributions").alias("feature", "contribution"))


@query
def attribution_adds_up(spark, sf_dir):
    """Per test document, whether base value and attributions sum to the predicted probability."""
    total = F.aggregate("contributions", F.col("base_value"), lambda a, c: a + c)
    return _explained(spark, sf_dir).select("id", (F.abs(total - F.col("score")) < 1e-6).alias("adds_up"))


@query
def class_attributions(spark, sf_dir):
    """Per document and language, whether base value and attributions sum to the predicted probability; all languages in one pass."""
    docs = views.docfeat(spark, sf_dir).join(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang"), "id")
    ready = features.assemble(features.encode_label(docs, features.fit_label_index(docs, "lang")), DOC_FEATURES).select("id", "label", "features")
    model = models.random_forest(SEED, numTrees=10, maxDepth=4).fit(ready)
    explained = explain.attribute_classes(models.score(model, ready), explain.fit_class_explainer(spark, model))
    total = lambda c, base: F.aggregate(c, base, lambda a, x: a + x)
    each = F.zip_with("contributions", "base_values", total)
    close = F.transform(F.arrays_zip(each.alias("sum"), vector_to_array("probability").alias("p")), lambda e: F.abs(e["sum"] - e["p"]) < 1e-6)
    return explained.select("id", F.posexplode(close).alias("class", "adds_up"))


@query
def training_job(spark, sf_dir):
    result = train_classifier(
        views.raw_docfeat(spark, sf_dir),
        scratch_path(spark, "training"),
        key="id",
        ignore=("id",),
        min_features=3,
        ranges={"numTrees": {"start": 5, "stop": 10, "num": 2}},
    )
    return result.confusion


@query
def training_totals(spark, sf_dir):
    """Row totals of a training job's confusion matrix per actual class, the test documents of that class."""
    result = train_classifier(
        views.raw_docfeat(spark, sf_dir),
        scratch_path(spark, "training"),
        key="id",
        ignore=("id",),
        min_features=3,
        ranges={"numTrees": {"start": 5, "stop": 5, "num": 1}},
        median="exact",
        nan_as_null=True,
        unseen="keep",
    )
    predicted = [F.col(c) for c in result.confusion.columns if c.startswith("predicted_")]
    return result.confusion.select("label", sum(predicted, F.lit(0)).alias("n"))


@query
def training_stages(spark, sf_dir):
    """What runs of a training job in one folder do about their stages: the first, the same again, and one with another minimum."""
    table_, folder = views.raw_docfeat(spark, sf_dir), scratch_path(spark, "training")
    runs = []
    for run, least in enumerate((3, 3, 4)):
        ranges = {"numTrees": {"start": 5, "stop": 5, "num": 1}}
        result = train_classifier(table_, folder, key="id", ignore=("id",), min_features=least, ranges=ranges, unseen="keep", median="exact")
        runs.append(result.stages.select(F.lit(run).alias("run"), "stage", "state"))
    return runs[0].unionByName(runs[1]).unionByName(runs[2])


@query
def boosted_job(spark, sf_dir):
    """AUC of train, validation and test after search, shadow selection and refit on documents."""
    small = {
        "n_estimators": ("int", 3, 6),
        "max_depth": ("int", 3, 5),
        "min_data_in_leaf": ("int", 4, 20),
        "min_gain_to_split": ("int", 0, 0),
        "class_weight": ("choice", None),
    }
    result = train_boosted(
        views.docfeat(spark, sf_dir),
        "target",
        "id",
        DOC_FEATURES + PLAIN_FEATURES,
        negative_value=0,
        space=BOOSTED_SPACE | small,
        first_trials=2,
        second_trials=2,
        shadow_trials=8,
    )
    return result.evaluation.auc


@query
def document_quality(spark, sf_dir):
    """Which quality labels does a forest get wrong? Cleaning, split, fit and confusion matrix."""
    cleaned = clean_table(views.raw_docfeat(spark, sf_dir), "target", "id", seed=SEED, median="exact")
    names = [c for c in cleaned.columns if c not in ("id", "target", "_split", "_fold")]
    index = features.fit_label_index(cleaned, "target")
    train, test = (cleaned.where(F.col("_split") == s) for s in ("train", "test"))
    train, test = features.prepare_data(train, test, names, "target", index, ["id"])
    return metrics.confusion_matrix(models.score(models.random_forest(SEED).fit(train), test), classes=[0.0, 1.0])
