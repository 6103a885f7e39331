"""Queries over fitted models. SQL does not express them; tests hold the linear ones
against numpy and check what must hold of the others."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitelattice.operators import expression, features, models, sites

from .catalog import M, OTHERS, REF, consolidated, expression_table, query

TOP = 100
_FEATURES = (*features.DIFFERENCES, *features.IF_BOTH)


def _relative(spark, sf_dir):
    """Design table of the relative analysis over the motifs whose presence varies most."""
    table = consolidated(spark, sf_dir)
    motifs = features.top_by(features.presence_variance(table, REF), "presence_variance", TOP).select(M)
    rel = features.relative_features(features.relative_inputs(table.join(motifs, M, "left_semi")), REF, OTHERS)
    values = sites.persist_table(features.long_values(rel, list(_FEATURES)), "values")
    names = sorted(r[0] for r in features.varying(values).select("feature").collect())  # at most six a motif of ``TOP``
    target = expression.without_reference(expression_table(spark, sf_dir), REF)
    data = models.group_folds(models.design(values, target, names))
    return sites.persist_table(data, "design"), names, values, target


@query()
def linear_cv(spark, sf_dir):
    """Least squares, ridge and lasso under gene-wise folds."""
    data, names, _, _ = _relative(spark, sf_dir)
    return models.metrics_table(spark, models.linear_models(data, names))


@query()
def linear_importances(spark, sf_dir):
    data, names, _, _ = _relative(spark, sf_dir)
    found = models.importances(spark, models.linear_models(data, names), names)
    mean = found.groupBy("feature").agg(F.avg("importance").alias("mean_importance"))
    return mean.orderBy(F.desc("mean_importance"), "feature").limit(10)


@query()
def top_importances(spark, sf_dir):
    data, names, _, _ = _relative(spark, sf_dir)
    return models.top_importances(models.importances(spark, models.linear_models(data, names), names))


@query()
def best_predictions(spark, sf_dir):
    """Predictions and residuals of the best model, linear or of trees."""
    data, names, _, _ = _relative(spark, sf_dir)
    found = models.linear_models(data, names) | {"random_forest": models.tree_model(data, models.forest())}
    best = models.best_model(models.metrics_table(spark, found)).first()
    best = best["model"] if best else "ols"
    return models.predictions(data, found[best]["beta"]) if "beta" in found[best] else models.tree_predictions(data, found[best])


@query()
def forest_cv(spark, sf_dir):
    data, _, _, _ = _relative(spark, sf_dir)
    return models.metrics_table(spark, {"random_forest": models.tree_model(data, models.forest())})


@query()
def boosted_cv(spark, sf_dir):
    data, _, _, _ = _relative(spark, sf_dir)
    return models.metrics_table(spark, {"gradient_boosting": models.tree_model(data, models.boosted())})


@query()
def mixed_effects(spark, sf_dir):
    data, names, _, _ = _relative(spark, sf_dir)
    return models.within_gene(data, names)[0]


@query()
def gene_by_gene(spark, sf_dir):
    """Four lines are too few rows for ten features and the lines: no gene can be fitted,
    and the table is empty. A test fits genes of many lines."""
    data, names, _, _ = _relative(spark, sf_dir)
    return models.gene_by_gene(data, names)


@query()
def approach_comparison(spark, sf_dir):
    data, names, _, _ = _relative(spark, sf_dir)
    return models.compare_approaches(models.gene_by_gene(data, names), models.within_gene(data, names)[1])


@query()
def diagnostic_grid(spark, sf_dir):
    data, names, _, _ = _relative(spark, sf_dir)
    rows = models.row_folds(data.drop("fold"))
    return models.diagnostic_grid(spark, models.gather(rows, names), models.gather(data, names))


@query()
def diagnostic_advice(spark, sf_dir):
    data, names, values, target = _relative(spark, sf_dir)
    grid = models.diagnostic_grid(spark, models.gather(models.row_folds(data.drop("fold")), names), models.gather(data, names))
    return models.recommendations(spark, grid, features.correlations(values, target), features.varying(values))


@query()
def gene_specific_cv(spark, sf_dir):
    """Differences of all gene features."""
    table = features.gene_features(consolidated(spark, sf_dir))
    values = sites.persist_table(features.long_values(features.gene_differences(table, REF), [f"{c}_diff" for c in features.GENE]), "values")
    names = sorted(r[0] for r in features.varying(values).select("feature").collect())
    target = expression.difference(expression_table(spark, sf_dir), REF)
    data = sites.persist_table(models.row_folds(models.design(values, target, names, "expression_difference")), "design")
    return models.metrics_table(spark, models.linear_models(data, names))
