"""Queries over the regulatory layers: which motifs enter, their columns, the products of
pairs, and forests over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitelattice.operators import features, layers, models, sites

from . import oracles as o
from .catalog import M, consolidated, expression_table, query

_PRESENCE = f"select {o.K}, 1 as present, count(*) as count from sites group by 1, 2, 3"
_BODIES = {"presence": _PRESENCE, "position": o.POSITION_LAYER, "variation": o.VARIATION_LAYER, "crossline": o.CROSSLINE_LAYER}
_BLOCKS = o.blocks({name: (body, layers.LAYERS[name][1]) for name, body in _BODIES.items()}, layers.TOP)


def _ranked(spark, sf_dir):
    """Sites, target, the design's rows and the ranking of the motifs."""
    table, target = consolidated(spark, sf_dir), expression_table(spark, sf_dir)
    rows = sites.persist_table(layers.rows_of(table, target), "rows")
    return table, target, rows, layers.presence_ranking(table, rows)


@query(o.over_sites(o.select(f"{M} n_present n_rows variance:d", "select *, cast(spread as double) / greatest(1, n_rows * (n_rows - 1)) as variance from ranked"), o.EXPRESSION, o.RANKED))
def presence_ranking(spark, sf_dir):
    """Sample variance of each motif's presence column over all gene and line rows."""
    return _ranked(spark, sf_dir)[3].drop("spread")


@query(o.over_sites(o.select("gene_id line layer feature value:d", "select * from block"), o.EXPRESSION, o.RANKED, o.GAPS, o.DOMINANT, _BLOCKS))
def motif_blocks(spark, sf_dir):
    """All columns, in all layers, of the fifty motifs whose presence varies most."""
    table, _, _, ranking = _ranked(spark, sf_dir)
    return layers.block_values(table, layers.top_motifs(ranking, layers.TOP), list(layers.LAYERS))


@query(o.over_sites(o.select("layer feature nonzero variance:d", """
select layer, feature, count(*) as nonzero, (var_pop(value) * count(*) + avg(value) * avg(value) * count(*) * (n - count(*)) / n) / greatest(1, n - 1) as variance
from block semi join design_rows using (gene_id, line), (select cast(count(*) as double) as n from design_rows) c group by layer, feature, n"""), o.EXPRESSION, o.RANKED, o.GAPS, o.DOMINANT, _BLOCKS))
def column_variances(spark, sf_dir):
    """Sample variance of each of these columns over all rows, absent values as 0."""
    table, _, rows, ranking = _ranked(spark, sf_dir)
    return layers.column_variances(layers.block_values(table, layers.top_motifs(ranking, layers.TOP), list(layers.LAYERS)), rows)


@query(o.over_sites(o.select("gene_id line motif_1 motif_2 presence_product score_product:d", "select * from products"), o.EXPRESSION, o.RANKED, o.pairs(layers.PAIRED)))
def interaction_pairs(spark, sf_dir):
    """Pairs of the ten motifs whose presence varies most, the one of higher rank first."""
    table, _, _, ranking = _ranked(spark, sf_dir)
    return features.interactions(features.presence(table), features.position_layer(table), layers.top_motifs(ranking, layers.PAIRED))


@query(o.over_sites(o.select("gene_id line feature value:d", """
select gene_id, line, motif_1 || f || motif_2 || '_presence' as feature, v as value
from (select *, unnest(['_X_', '_position_X_']) as f, unnest([cast(presence_product as double), score_product]) as v from products) p where abs(v) > 1e-12"""), o.EXPRESSION, o.RANKED, o.pairs(layers.PAIRED)))
def interaction_features(spark, sf_dir):
    """The products as columns of the design."""
    table, _, _, ranking = _ranked(spark, sf_dir)
    return layers.pair_values(table, layers.top_motifs(ranking, layers.PAIRED)).drop("layer")


_SIZES = f"sizes as (select count(*) filter (place <= {layers.TOP}) as m, least(count(*), {layers.PAIRED}) as p from ranked)"
_COUNTS = [*[f"m * {len(layers.LAYERS[x][2])}" for x in layers.LAYERS], "p * (p - 1)", f"m * {sum(len(layers.LAYERS[x][1]) for x in layers.LAYERS)} + p * (p - 1)"]


@query(o.over_sites(f"select unnest({[*layers.LAYERS, layers.INTERACTION, 'combined']!r}) as layer, unnest([{', '.join(_COUNTS)}]) as n_features from sizes", o.EXPRESSION, o.RANKED, _SIZES))
def layer_sizes(spark, sf_dir):
    """How many columns each layer's model takes, and the model of all layers."""
    ranking = _ranked(spark, sf_dir)[3]
    found = layers.sizes(layers.top_motifs(ranking, layers.TOP), list(layers.LAYERS), layers.top_motifs(ranking, layers.PAIRED))
    return spark.createDataFrame(found, "layer string, n_features long")


@query()
def layer_forests(spark, sf_dir):
    """A forest for each layer over all its columns of the fifty motifs, and one over the
    products of pairs; of 20 trees here (see README), of 100 from the command line."""
    table, target, _, ranking = _ranked(spark, sf_dir)
    fits = layer_fits(spark, table, target, ranking, list(layers.LAYERS), trees=20, combined=False)
    return models.metrics_table(spark, {layer: fit for layer, (fit, _) in fits.items()})


def layer_fits(spark, table, target, ranking, chosen, top=layers.TOP, paired=layers.PAIRED, trees=100, combined=True):
    """layer -> (fit, columns), for each chosen layer, the products (if ``paired``) and all
    together (``combined``, with twice the trees, if asked for)."""
    motifs = layers.top_motifs(ranking, top)
    values = layers.block_values(table, motifs, chosen)
    columns = {layer: layers.block_names(motifs, layer, scored=True) for layer in chosen}
    names = [n for layer in chosen for n in layers.block_names(motifs, layer)]
    if paired:
        values = values.unionByName(layers.pair_values(table, motifs[:paired], "position" in chosen))
        columns[layers.INTERACTION] = layers.pair_names(motifs[:paired], "position" in chosen)
        names += columns[layers.INTERACTION]
    values = sites.persist_table(values, "values")
    out = {}
    if combined:
        columns["combined"] = sorted(names)
    measured = target.join(layers.rows_of(table, target), layers.ROW, "left_semi")
    for layer, own in columns.items():
        if own:
            used = values if layer == "combined" else values.where(F.col("feature").isin(own))
            data = sites.persist_table(models.group_folds(models.design(used, measured, own)), "design")
            out[layer] = (models.tree_model(data, models.forest(trees * (2 if layer == "combined" else 1))), own)
    return out
