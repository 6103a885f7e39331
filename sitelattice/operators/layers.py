"""Regulatory layers: blocks of columns of the motifs whose presence varies most, and the
products of pairs of motifs, as one design.

Everything stays long and sparse: what is 0 is never written, and variances count the
rows that are not there.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import features
from .features import KEYS, MOTIF

ROW = ["gene_id", "line"]
#: Layers of features: how each is made, its columns, and those of them that its own model
#: is fitted on (the model of all layers takes all columns).
LAYERS = {
    "presence": (features.presence, ["present", "count"], ["present", "count"]),
    "position": (
        features.position_layer,
        ["proximal_density", "core_density", "distal_density", "position_weighted_score", "spacing_regularity", "closest_hit_distance", "total_hits"],
        ["proximal_density", "core_density", "distal_density", "position_weighted_score", "spacing_regularity", "closest_hit_distance"],
    ),
    "variation": (
        features.variation_layer,
        ["consensus_similarity_mean", "consensus_similarity_std", "sequence_diversity", "gc_content_mean", "gc_content_std", "length_mean", "length_std", "unique_sequences"],
        ["consensus_similarity_mean", "consensus_similarity_std", "sequence_diversity", "gc_content_mean", "gc_content_std"],
    ),
    "crossline": (features.crossline_layer, *(2 * [["cross_line_diversity", "dominant_sequence_diversity", "line_has_unique_variant"]])),
}
INTERACTION = "interaction"
#: What is nearer to 0 than this is 0 (a spread of equal values is, but for rounding).
ZERO = 1e-12
#: Motifs that enter with all their columns, and those of them whose pairs are multiplied.
TOP, PAIRED = 50, 10


def _written():
    return F.abs("value") > F.lit(ZERO)


def rows_of(sites: DataFrame, target: DataFrame, label: str = "expression") -> DataFrame:
    """(gene_id, line) of every row of the design: has a hit and a measured target."""
    return sites.select(*ROW).distinct().join(target.where(F.col(label).isNotNull()).select(*ROW).distinct(), ROW, "left_semi")


def presence_ranking(sites: DataFrame, rows: DataFrame) -> DataFrame:
    """(motif, n_present, n_rows, variance, place): sample variance of each motif's presence
    column over ``rows``, absent counted as 0, highest first, ties by motif.

    Only counts are needed: c ones among n values spread by c (n - c), a whole number, so
    ranks are exact.
    """
    n = rows.count()
    counts = sites.select(*KEYS).distinct().join(rows, ROW, "left_semi").groupBy(MOTIF).agg(F.count("*").alias("n_present"))
    spread = F.col("n_present") * (F.lit(n) - F.col("n_present"))
    variance = spread.cast("double") / F.lit(float(max(1, n * (n - 1))))
    return counts.select(MOTIF, "n_present", F.lit(n).cast("long").alias("n_rows"), variance.alias("variance"), spread.alias("spread"))


def top_motifs(ranking: DataFrame, n: int) -> list[str]:
    """The first ``n`` motifs, in rank order: a short list by its parameter."""
    return [r[0] for r in ranking.orderBy(F.desc("spread"), MOTIF).limit(n).select(MOTIF).collect()]


def block_values(sites: DataFrame, motifs: list[str], layers: list[str]) -> DataFrame:
    """(gene_id, line, layer, feature, value): all columns of the given motifs in the given
    layers, zeros left out. Other motifs' hits are dropped before anything is computed."""
    own, out = sites.where(F.col(MOTIF).isin(motifs)), None
    for layer in layers:
        make, columns, _ = LAYERS[layer]
        part = features.long_values(make(own), columns).where(_written()).withColumn("layer", F.lit(layer))
        out = part if out is None else out.unionByName(part)
    return out.select(*ROW, "layer", "feature", "value")


def block_names(motifs: list[str], layer: str, scored: bool = False) -> list[str]:
    """The columns of a layer over the given motifs; ``scored``: those its own model takes."""
    return sorted(f"{m}_{c}" for m in motifs for c in LAYERS[layer][2 if scored else 1])


def pair_names(motifs: list[str], position: bool = True) -> list[str]:
    """The product columns of the given motifs, which are in rank order."""
    pairs = list(combinations(motifs, 2))
    return [f"{a}_X_{b}_presence" for a, b in pairs] + [f"{a}_position_X_{b}_presence" for a, b in pairs if position]


def pair_values(sites: DataFrame, motifs: list[str], position: bool = True) -> DataFrame:
    """(gene_id, line, layer, feature, value): for each pair of the given motifs, in rank
    order, the product of their presences and that of the first's position score and the
    second's presence; zeros are never written."""
    own = sites.where(F.col(MOTIF).isin(motifs))
    pairs = features.interactions(features.presence(own), features.position_layer(own), motifs)
    made = [F.struct(F.concat("motif_1", F.lit("_X_"), "motif_2", F.lit("_presence")).alias("feature"), F.col("presence_product").cast("double").alias("value"))]
    if position:
        made.append(F.struct(F.concat("motif_1", F.lit("_position_X_"), "motif_2", F.lit("_presence")).alias("feature"), F.col("score_product").alias("value")))
    return pairs.select(*ROW, F.lit(INTERACTION).alias("layer"), F.inline(F.array(*made))).where(_written())


def column_variances(values: DataFrame, rows: DataFrame) -> DataFrame:
    """(layer, feature, nonzero, variance): sample variance of each column over ``rows``,
    with 0 wherever ``values`` has nothing. The written values' own spread and their mean's
    distance from the zeros add up, so no zero is ever made."""
    n = rows.count()
    m, mean = F.count("*"), F.avg("value")
    squares = F.var_pop("value") * m + mean * mean * m * (F.lit(n) - m) / F.lit(float(max(1, n)))
    return values.join(rows, ROW, "left_semi").groupBy("layer", "feature").agg(m.alias("nonzero"), (squares / F.lit(float(max(1, n - 1)))).alias("variance"))


def sizes(motifs: list[str], layers: list[str], paired: list[str] = ()) -> list[tuple[str, int]]:
    """How many columns each layer's model takes, and the model of all layers."""
    own = [(layer, len(block_names(motifs, layer, scored=True))) for layer in layers]
    pairs = len(pair_names(list(paired), "position" in layers)) if paired else 0
    return [*own, *([(INTERACTION, pairs)] if paired else []), ("combined", sum(len(block_names(motifs, layer)) for layer in layers) + pairs)]


def column_layers(spark, motifs: list[str], layers: list[str], paired: list[str] = ()) -> DataFrame:
    """(feature, layer) of every column of the model of all layers: as many rows as columns."""
    rows = [(c, layer) for layer in layers for c in block_names(motifs, layer)]
    rows += [(c, INTERACTION) for c in (pair_names(list(paired), "position" in layers) if paired else [])]
    return spark.createDataFrame(rows, "feature string, layer string")
