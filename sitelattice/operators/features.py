"""Features of a motif's hits in a gene and line. All tables stay long, keyed by gene,
line and motif, with a column a feature; ``matrix`` pivots for a sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelattice.functions import seq

from . import wide

MOTIF = "consolidated_motif_id"
KEYS = ["gene_id", "line", MOTIF]
POSITION = ["motif_count", "position_mean", "position_std", "position_min", "position_max", "position_range", "density_proximal", "density_core", "density_distal", "spacing_regularity"]
VARIATION = ["seq_diversity", "seq_length_mean", "seq_length_std", "gc_content_mean", "gc_content_std", "mutation_load"]


def _inside(p: Column, low: int, high: int, closed: bool = False) -> Column:
    return F.count_if((p >= low) & ((p <= high) if closed else (p < high)))


def _gaps(sites: DataFrame, position: Column) -> DataFrame:
    """Distance of each hit to the one before it."""
    w = Window.partitionBy(*KEYS).orderBy("_p")
    return sites.withColumn("_p", position).withColumn("_gap", F.col("_p") - F.lag("_p").over(w))


def presence(sites: DataFrame) -> DataFrame:
    return sites.groupBy(*KEYS).agg(F.lit(1).alias("present"), F.count("*").alias("count"))


def position_features(sites: DataFrame) -> DataFrame:
    """Ten features of absolute positions in a 1000-base promoter whose end is the start
    of transcription."""
    p = F.col("_p")
    spread = F.when(F.count("*") > 2, F.stddev_pop("_gap") / (F.avg("_gap") + 1)).otherwise(F.lit(0.0))
    return _gaps(sites, F.abs(F.col("start_pos"))).groupBy(*KEYS).agg(
        F.count("*").alias("motif_count"), F.avg(p).alias("position_mean"), F.stddev_pop(p).alias("position_std"), F.min(p).alias("position_min"), F.max(p).alias("position_max"),
        (F.max(p) - F.min(p)).alias("position_range"), (_inside(p, 700, 1000, True) / F.lit(3.0)).alias("density_proximal"), (_inside(p, 300, 700) / F.lit(4.0)).alias("density_core"),
        (_inside(p, 0, 300) / F.lit(3.0)).alias("density_distal"), spread.alias("spacing_regularity"),
    )


def variation_features(sites: DataFrame) -> DataFrame:
    """Sequence variation against the motif's consensus (without the sequence matcher's
    ratio, see ``matcher_similarity``)."""
    s, n = F.col("sequence"), F.length("sequence")
    return sites.groupBy(*KEYS).agg(
        (F.countDistinct("sequence") / F.count("*")).alias("seq_diversity"), F.avg(n).alias("seq_length_mean"), F.stddev_pop(n).alias("seq_length_std"),
        F.avg(seq.gc_content(s)).alias("gc_content_mean"), F.stddev_pop(seq.gc_content(s)).alias("gc_content_std"),
        F.coalesce(F.avg(seq.mutation_share(s, F.col("motif_consensus"))), F.lit(0.0)).alias("mutation_load"),
    )


def matcher_similarity(sites: DataFrame) -> DataFrame:
    """Mean and spread of the Ratcliff-Obershelp ratio of sequences to their consensus.
    Different pairs are scored once, however many hits have them."""
    pairs = sites.select("sequence", "motif_consensus").distinct().withColumn("ratio", seq.matching_ratio(F.col("sequence"), F.col("motif_consensus")))
    return sites.join(pairs, ["sequence", "motif_consensus"]).groupBy(*KEYS).agg(F.avg("ratio").alias("consensus_similarity_mean"), F.stddev_pop("ratio").alias("consensus_similarity_std"))


def relative_inputs(sites: DataFrame) -> DataFrame:
    """The eleven per-line features that line differences are taken of."""
    p, s = F.col("start_pos"), F.col("sequence")
    return sites.groupBy(*KEYS).agg(
        F.lit(1).alias("present"), F.count("*").alias("count"), F.avg(p).alias("position_mean"), F.stddev_pop(p).alias("position_std"), F.min(p).alias("position_min"), F.max(p).alias("position_max"),
        (_inside(p, 700, 1000, True) / F.lit(3.0)).alias("proximal_density"), (_inside(p, 0, 300) / F.lit(3.0)).alias("distal_density"),
        (F.countDistinct("sequence") / F.count("*")).alias("sequence_diversity"), F.avg(seq.gc_content(s)).alias("gc_content_mean"), F.stddev_pop(seq.gc_content(s)).alias("gc_content_std"),
    )


def position_layer(sites: DataFrame) -> DataFrame:
    """Seven features with distances from position 0 up."""
    p = F.col("_p")
    cv = F.when((F.count("*") > 1) & (F.avg("_gap") > 0), F.stddev_pop("_gap") / F.avg("_gap")).otherwise(F.lit(0.0))
    return _gaps(sites, F.col("start_pos")).groupBy(*KEYS).agg(
        (_inside(p, 0, 500) / F.lit(5.0)).alias("proximal_density"), (_inside(p, 500, 1000) / F.lit(5.0)).alias("core_density"), (_inside(p, 1000, 2000) / F.lit(10.0)).alias("distal_density"),
        F.sum(seq.decay(p)).alias("position_weighted_score"), (1 / (1 + cv)).alias("spacing_regularity"), F.min(p).alias("closest_hit_distance"), F.count("*").alias("total_hits"),
    )


def variation_layer(sites: DataFrame) -> DataFrame:
    s, n = F.col("sequence"), F.length("sequence")
    near = seq.positional_similarity(s, F.col("motif_consensus"))
    return sites.groupBy(*KEYS).agg(
        F.avg(near).alias("consensus_similarity_mean"), F.stddev_pop(near).alias("consensus_similarity_std"), (F.countDistinct("sequence") / F.count("*")).alias("sequence_diversity"),
        F.avg(seq.gc_content(s)).alias("gc_content_mean"), F.stddev_pop(seq.gc_content(s)).alias("gc_content_std"), F.avg(n).alias("length_mean"), F.stddev_pop(n).alias("length_std"),
        F.countDistinct("sequence").alias("unique_sequences"),
    )


def crossline_layer(sites: DataFrame) -> DataFrame:
    """Per gene and motif: diversity over all lines, diversity of the lines' dominant
    sequences, and whether a line's dominant sequence is its own."""
    seqs = sites.groupBy(*KEYS, "sequence").agg(F.count("*").alias("n"))
    gene = ["gene_id", MOTIF]
    whole = seqs.groupBy(*gene).agg((F.countDistinct("sequence") / F.sum("n")).alias("cross_line_diversity"))
    dominant = seqs.groupBy(*KEYS).agg(F.min(F.struct((-F.col("n")).alias("n"), "sequence")).alias("d")).select(*KEYS, F.col("d.sequence").alias("dominant"))
    many = dominant.groupBy(*gene).agg(F.when(F.count("*") > 1, F.countDistinct("dominant") / F.count("*")).otherwise(F.lit(0.0)).alias("dominant_sequence_diversity"))
    alone = F.when(F.count("*").over(Window.partitionBy(*gene, "dominant")) == 1, 1).otherwise(0)
    return dominant.withColumn("line_has_unique_variant", alone).join(whole, gene).join(many, gene).select(*KEYS, "cross_line_diversity", "dominant_sequence_diversity", "line_has_unique_variant")


def gene_features(sites: DataFrame, genes: list[str] | None = None) -> DataFrame:
    """Nine features for chosen genes, dense over each gene's own motifs and all lines."""
    own = sites if genes is None else sites.where(F.col("gene_id").isin(genes))
    found = own.groupBy(*KEYS).agg(
        F.lit(1).alias("present"), F.count("*").alias("count"), F.avg("start_pos").alias("position_mean"), F.stddev_pop("start_pos").alias("position_std"), F.min("start_pos").alias("position_min"),
        F.max("start_pos").alias("position_max"), F.avg("score").alias("score_mean"), F.max("score").alias("score_max"), F.avg(seq.gc_content(F.col("sequence"))).alias("gc_content_mean"),
    )
    cells = found.select("gene_id", MOTIF).distinct().join(found.select("gene_id", "line").distinct(), "gene_id")
    return cells.join(found, KEYS, "left").na.fill(0)


def densify(features: DataFrame, genes: DataFrame, lines: DataFrame, motifs: DataFrame) -> DataFrame:
    """Every gene in every line for every motif, 0 where there is no hit. The result is
    that product by definition; the line and motif lists ride along as one array each,
    so no join pairs rows with rows."""
    cells = genes.select("gene_id")
    for name, side in (("line", lines), (MOTIF, motifs)):
        # Lines and motifs are the columns of the matrix: a few hundred.
        listed = sorted(r[0] for r in side.select(name).distinct().collect())
        cells = cells.withColumn(name, F.explode(F.array(*[F.lit(x) for x in listed])) if listed else F.lit(None).cast("string"))
    return cells.join(features, KEYS, "left").na.fill(0)


def matrix(features: DataFrame, columns: list[str], motifs: list[str] | None = None) -> DataFrame:
    """Wide: a row a gene and line, a column ``<motif>_<feature>``, missing as 0. Without a
    list, all motifs that the table has."""
    return wide.widen(features, ["gene_id", "line"], MOTIF, columns, motifs)


DIFFERENCES = {"presence_diff": "present", "count_diff": "count"}
IF_BOTH = {"position_mean_diff": "position_mean", "proximal_density_diff": "proximal_density", "sequence_diversity_diff": "sequence_diversity", "gc_content_diff": "gc_content_mean"}


def relative_features(per_line: DataFrame, reference: str, lines: list[str] | None = None, genes: DataFrame | None = None) -> DataFrame:
    """Differences of each line's features from the reference line's, a row a gene, line
    and motif of which either has a hit. Presence and count differ always, the others
    only where both have the motif (0 elsewhere).

    The reference's values reach the other lines by one aggregate over gene and motif:
    all lines of a gene and motif meet once, so no self-join is needed.
    """
    cols = [*DIFFERENCES.values(), *IF_BOTH.values()]
    packed = per_line.groupBy("gene_id", MOTIF).agg(
        F.first(F.when(F.col("line") == reference, F.struct(*cols)), ignorenulls=True).alias("r"),
        F.map_from_entries(F.collect_list(F.when(F.col("line") != reference, F.struct(F.col("line"), F.struct(*cols).alias("v"))))).alias("m"),
    )
    others = F.array(*[F.lit(x) for x in lines]) if lines else F.map_keys("m")
    rows = packed.select("gene_id", MOTIF, "r", "m", F.explode(others).alias("line")).withColumn("c", F.try_element_at("m", F.col("line")))
    rows = rows.where(F.col("r").isNotNull() | F.col("c").isNotNull())
    both = F.col("r").isNotNull() & F.col("c").isNotNull()
    value = lambda side, c: F.coalesce(F.col(side)[c], F.lit(0))
    return rows.select(
        "gene_id", "line", MOTIF,
        *[(value("c", c) - value("r", c)).alias(n) for n, c in DIFFERENCES.items()],
        *[F.when(both, F.col("c")[c] - F.col("r")[c]).otherwise(F.lit(0.0)).alias(n) for n, c in IF_BOTH.items()],
    )


def presence_variance(sites: DataFrame, reference: str) -> DataFrame:
    """Population variance over the other lines of the share of a line's genes that
    have the motif."""
    seen = sites.where(F.col("line") != reference).select(*KEYS).distinct()
    genes = seen.select("line", "gene_id").distinct().groupBy("line").agg(F.count("*").alias("n_genes"))
    have = seen.groupBy("line", MOTIF).agg(F.count("*").alias("n"))
    shares = have.join(genes, "line").select(MOTIF, (F.col("n") / F.col("n_genes")).alias("share"))
    # Lines without the motif have share 0; their number is one aggregate away.
    lines = genes.agg(F.count("*").alias("n_lines"))
    sums = shares.groupBy(MOTIF).agg(F.sum("share").alias("s"), F.sum(F.col("share") * F.col("share")).alias("q")).crossJoin(F.broadcast(lines))
    mean = F.col("s") / F.col("n_lines")
    return sums.select(MOTIF, F.greatest(F.lit(0.0), F.col("q") / F.col("n_lines") - mean * mean).alias("presence_variance"))


def top_by(table: DataFrame, value: str, n: int, key: str = MOTIF) -> DataFrame:
    return table.orderBy(F.desc(value), key).limit(n)


def gene_line_support(sites: DataFrame, least: int = 10) -> DataFrame:
    """Motifs by the number of gene and line pairs that have them."""
    return sites.select(*KEYS).distinct().groupBy(MOTIF).agg(F.count("*").alias("n_pairs")).where(F.col("n_pairs") >= least)


def line_counts(sites: DataFrame, lines: tuple[str, ...]) -> DataFrame:
    """Motif by line contingency, with the sample variance of each row, zeros included."""
    wide = sites.groupBy(MOTIF).pivot("line", list(lines)).agg(F.count(F.lit(1))).na.fill(0)
    n = len(lines)
    total = sum(F.col(x) for x in lines)
    squares = sum(F.col(x) * F.col(x) for x in lines)
    return wide.withColumn("line_variance", ((squares - total * total / n) / (n - 1)).cast("double"))


def motifs_per_gene(sites: DataFrame) -> DataFrame:
    n = sites.select("gene_id", MOTIF).distinct().groupBy("gene_id").agg(F.count("*").alias("n"))
    return n.agg(F.avg("n").alias("mean"), F.expr("percentile(n, 0.5D)").alias("median"), F.min("n").alias("least"), F.max("n").alias("most"))


def long_values(features: DataFrame, columns: list[str]) -> DataFrame:
    """(gene_id, line, feature, value): one row a feature."""
    parts = F.array(*[F.struct(F.concat_ws("_", MOTIF, F.lit(c)).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    return features.select("gene_id", "line", F.inline(parts))


def nonzero_counts(values: DataFrame) -> DataFrame:
    return values.groupBy("feature").agg(F.count_if(F.col("value") != 0).alias("nonzero"))


def varying(values: DataFrame) -> DataFrame:
    """Features whose sample variance is not 0 (one value alone has none and stays)."""
    v = values.groupBy("feature").agg(F.var_samp("value").alias("variance"))
    return v.where(F.col("variance").isNull() | (F.col("variance") != 0))


def correlations(values: DataFrame, target: DataFrame) -> DataFrame:
    """Absolute Pearson correlation of each feature with ``expression``; constant ones
    have none."""
    joined = values.join(target.where(F.col("expression").isNotNull()), ["gene_id", "line"])
    spread = F.stddev_pop("value") * F.stddev_pop("expression")
    # corr() itself divides by zero for a constant.
    return joined.groupBy("feature").agg(F.abs(F.try_divide(F.covar_pop("value", "expression"), spread)).alias("correlation")).where(F.col("correlation").isNotNull())


def centred(values: DataFrame, column: str = "value", by: str = "gene_id") -> DataFrame:
    """``column`` less its mean within each gene (and feature, if there is one)."""
    keys = [by, *(["feature"] if "feature" in values.columns else [])]
    return values.withColumn(column, F.col(column) - F.avg(column).over(Window.partitionBy(*keys)))


def interactions(presence_: DataFrame, scores: DataFrame, motifs: list[str]) -> DataFrame:
    """Products of pairs of the given motifs in a gene and line: presence by presence,
    and the first's position score by the second's presence. Rows with a zero product
    are left out. ``motifs`` is a short list, whose pairs are written out."""
    place = {m: i for i, m in enumerate(motifs)}
    chosen = presence_.where(F.col(MOTIF).isin(motifs)).join(scores.select(*KEYS, "position_weighted_score"), KEYS, "left")
    table = F.create_map(*[F.lit(x) for m, i in place.items() for x in (m, i)])
    cell = F.sort_array(F.collect_list(F.struct(F.element_at(table, F.col(MOTIF)).alias("k"), F.col(MOTIF).alias("m"), F.coalesce("position_weighted_score", F.lit(0.0)).alias("s"))))
    cells = chosen.groupBy("gene_id", "line").agg(cell.alias("c"))  # at most one entry a chosen motif
    a = cells.select("gene_id", "line", "c", F.explode("c").alias("a"))
    return a.select("gene_id", "line", "a", F.explode(F.filter("c", lambda b: b["k"] > F.col("a.k"))).alias("b")).select(
        "gene_id", "line", F.col("a.m").alias("motif_1"), F.col("b.m").alias("motif_2"), F.lit(1).alias("presence_product"), F.col("a.s").alias("score_product")
    )


GENE = ["present", "count", "position_mean", "position_std", "position_min", "position_max", "score_mean", "score_max", "gc_content_mean"]


def gene_differences(table: DataFrame, reference: str) -> DataFrame:
    """All nine gene features of each line less the reference line's, absent ones as 0.
    ``table`` is dense over a gene's lines and motifs (``gene_features``)."""
    base = table.where(F.col("line") == reference).select("gene_id", MOTIF, F.struct(*GENE).alias("r"))
    rows = table.where(F.col("line") != reference).join(base, ["gene_id", MOTIF], "left")
    return rows.select(*KEYS, *[(F.col(c) - F.coalesce(F.col("r")[c], F.lit(0))).alias(f"{c}_diff") for c in GENE])


#: Endings of difference features, and the kind of change each stands for.
CHANGES = {"presence_diff": "presence change", "count_diff": "count change", "position_mean_diff": "position shift", "proximal_density_diff": "proximal density change"}


def labelled(table: DataFrame, feature: str = "feature") -> DataFrame:
    """``table`` with the ``motif`` and the kind of ``change`` that a feature stands for."""
    f, motif, change = F.col(feature), None, None
    for end, word in CHANGES.items():
        hit, own = f.endswith("_" + end), F.replace(f, F.lit("_" + end), F.lit(""))
        motif = F.when(hit, own) if motif is None else motif.when(hit, own)
        change = F.when(hit, word) if change is None else change.when(hit, word)
    return table.withColumns({"motif": motif.otherwise(f), "change": change.otherwise("other")})


def extremes(table: DataFrame, value: str, n: int = 10, key: str = "feature") -> DataFrame:
    """The ``n`` rows of the largest and of the smallest values: (side, place, ...)."""
    parts = [
        table.orderBy(order, key).limit(n).select(F.lit(side).alias("side"), F.row_number().over(Window.orderBy(order, key)).alias("place"), key, value)
        for side, order in (("top", F.desc_nulls_last(value)), ("bottom", F.asc_nulls_last(value)))
    ]
    return parts[0].unionAll(parts[1])


def dummies(table: DataFrame, column: str, values: list[str]) -> DataFrame:
    """A 0 or 1 column for each value but the first in order."""
    return table.withColumns({f"{column}_{v}": (F.col(column) == v).cast("int") for v in sorted(values)[1:]})
