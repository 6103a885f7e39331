"""Command line: ``python -m sitelattice.cli <command> ...``.

Every command writes folders of part files below ``--output`` and prints nothing to be
answered. ``full`` runs consolidate, validate, features and the relative analysis over
one another's results.
"""

from __future__ import annotations

import argparse
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelattice.operators import cluster, encode, expression, features, layers, models, quality, sites, standing
from sitelattice.plans.layer_queries import layer_fits
from sitelattice.plans.tables import persist_table
from sitelattice.sources import files, sinks

M = "consolidated_motif_id"
REFERENCE = "IM767"
RELATIVE = [*features.DIFFERENCES, *features.IF_BOTH]


def session() -> SparkSession:
    return SparkSession.builder.appName("sitelattice").getOrCreate()


def consolidate(spark, a) -> DataFrame:
    raw = files.read_sites(spark, a.folder, a.lines.split(",") if a.lines else None)
    table = persist_table(sites.consolidate(raw, a.threshold, not a.no_merge_overlaps, a.overlap_threshold, a.stream_overlaps), "sites")
    sinks.write_sites(table, f"{a.output}/sites")
    sinks.write_table(sites.line_summary(table), f"{a.output}/summary")
    if a.validate:
        validate_table(table, a.output)
    return table


def validate_table(table: DataFrame, output: str) -> str | None:
    profile = persist_table(quality.cluster_profile(table), "profile")
    flagged = quality.cluster_flags(profile)
    sinks.write_table(flagged, f"{output}/validation")
    sinks.write_table(quality.size_histogram(profile), f"{output}/sizes")
    r = quality.verdict(profile).first()
    worst = quality.worst_clusters(flagged).collect()
    sinks.write_text([f"clusters: {r['n_clusters']}", f"flagged: {r['n_flagged']}", f"verdict: {r['verdict']}", *[f"{w[M]}: {w['issues']} ({w['recommendation']})" for w in worst]], profile, f"{output}/validation_report")
    return r["verdict"]


def validate(spark, a) -> int:
    return int(validate_table(files.read_consolidated(spark, a.sites), a.output) == "fail")


def chosen_motifs(table: DataFrame, least: int, top: int | None) -> list[str]:
    """Motifs by support, then first seen; all of them for ``least`` 0."""
    found = sites.supported(table, least).orderBy(F.desc("n_sites"), "first_ord")
    return [r[0] for r in (found.limit(top) if top else found).select(M).collect()]


def make_features(spark, a, table: DataFrame | None = None) -> None:
    table = table if table is not None else files.read_consolidated(spark, a.sites)
    motifs = chosen_motifs(table, a.min_sites, a.top_motifs)
    table = table.where(F.col(M).isin(motifs))
    columns = ["present"]
    long = features.presence(table)
    if not a.simple:
        columns += features.POSITION + features.VARIATION + ["consensus_similarity_mean", "consensus_similarity_std"]
        for more in (features.position_features(table), features.variation_features(table), features.matcher_similarity(table)):
            long = long.join(more, features.KEYS)
    long = persist_table(long, "features")
    given = files.read_expression_lenient(spark, a.expression) if a.expression else None
    sinks.write_features(long, columns, motifs, f"{a.output}/features", given)
    names = [f"{m}_{c}" for m in motifs for c in columns]
    sinks.write_text(sinks.feature_descriptions(sites.supported(table, 0), columns), table, f"{a.output}/feature_descriptions")
    sinks.write_text(sinks.feature_summary(names, long.select("gene_id", "line").distinct().count()), table, f"{a.output}/feature_summary")


def _charts(metrics: DataFrame, importances: DataFrame, data: DataFrame, made: DataFrame, output: str) -> None:
    """The data of the usual charts: bars of the models, heat map and bars of the features,
    boxes and histogram of the target, predicted against actual."""
    sinks.write_table(metrics.select("model", "cv_r2", "cv_std"), f"{output}/charts/models")
    sinks.write_table(sinks.chart_data(importances), f"{output}/charts/importances")
    sinks.write_table(sinks.box_data(data, "y", "line"), f"{output}/charts/target_by_line")
    sinks.write_table(sinks.histogram(data, "y"), f"{output}/charts/target")
    sinks.write_table(made.select("actual", "predicted"), f"{output}/charts/predicted")


def _model_outputs(spark, data: DataFrame, names: list[str], output: str, title: str, kind: str, trees: int, reference: str | None = None) -> None:
    data = persist_table(data, "design")
    found = models.linear_models(data, names)
    found["random_forest"] = models.tree_model(data, models.forest(trees))
    if kind == "relative":
        found["gradient_boosting"] = models.tree_model(data, models.boosted(trees))
    metrics = models.metrics_table(spark, found)
    weights = models.importances(spark, found, names)
    sinks.write_table(features.labelled(weights), f"{output}/importances")
    best = max(found, key=lambda n: (not math.isnan(found[n]["cv_r2"]), found[n]["cv_r2"]))
    made = models.predictions(data, found[best]["beta"]) if "beta" in found[best] else models.tree_predictions(data, found[best])
    sinks.write_table(made, f"{output}/predictions")
    _charts(metrics, weights, data, made, output)
    sinks.write_text(sinks.report(metrics, title, kind, weights, sinks.facts(data, reference)), metrics, f"{output}/report")


def relative(spark, a, table: DataFrame | None = None) -> None:
    table = table if table is not None else files.read_consolidated(spark, a.sites)
    target = files.read_expression(spark, a.expression, reference=a.reference_line)
    lines = sorted(r[0] for r in target.select("line").distinct().collect())
    support = features.gene_line_support(table, a.min_sites)
    if a.selection_method == "frequency":
        top = features.top_by(support, "n_pairs", a.top_motifs)
    else:  # by variance of presence; a choice by correlation falls back to it
        top = features.top_by(features.presence_variance(table.join(support, M, "left_semi"), a.reference_line), "presence_variance", a.top_motifs)
    motifs = sorted(r[0] for r in top.select(M).collect())
    rel = features.relative_features(features.relative_inputs(table.where(F.col(M).isin(motifs))), a.reference_line, lines)
    values = persist_table(features.long_values(rel, RELATIVE), "values")
    sinks.write_table(rel, f"{a.output}/relative_features")
    names = sorted(r[0] for r in features.varying(values).select("feature").collect())
    _model_outputs(spark, models.group_folds(models.design(values, target, names)), names, a.output, "Relative analysis", "relative", a.trees, a.reference_line)


def absolute(spark, a) -> None:
    wide = files.read_features(spark, a.features)
    target = files.read_expression(spark, a.expression, reference=REFERENCE)
    suffixes = ("_present", "_count", "_mean", "_std") if a.detailed else ("_present",)
    names = [c for c in wide.columns if c.endswith(suffixes)]
    values = wide.unpivot(["gene_id", "line"], names, "feature", "value")
    spread = features.varying(values).orderBy(F.desc("variance"), "feature")
    names = sorted(r[0] for r in (spread.limit(a.top_motifs) if a.top_motifs else spread).select("feature").collect())
    _model_outputs(spark, models.group_folds(models.design(values, target, names)), names, a.output, "Absolute analysis", "absolute", a.trees)


def comprehensive(spark, a) -> None:
    """Forests over each layer, over the products of pairs if asked for, and over everything,
    all for the motifs whose presence varies most."""
    table = persist_table(files.read_consolidated(spark, a.sites), "sites")
    target = files.read_expression(spark, a.expression)
    chosen = a.layers.split(",")
    rows = persist_table(layers.rows_of(table, target), "rows")
    ranking = persist_table(layers.presence_ranking(table, rows), "ranking")
    motifs = layers.top_motifs(ranking, a.top_motifs)
    paired = motifs[: layers.PAIRED] if a.interactions else []
    fits = layer_fits(spark, table, target, ranking, chosen, a.top_motifs, len(paired), a.trees)
    metrics = models.metrics_table(spark, {layer: fit for layer, (fit, _) in fits.items()})
    taken = spark.createDataFrame([(layer, len(names)) for layer, (_, names) in fits.items()], "model string, n_features long")
    sinks.write_table(metrics.join(taken, "model"), f"{a.output}/layers")
    sinks.write_table(ranking.drop("spread"), f"{a.output}/motifs")
    if paired:
        sinks.write_table(layers.pair_values(table, paired, "position" in chosen).drop("layer"), f"{a.output}/interactions")
    fit, names = fits["combined"]
    weights = models.importances(spark, {"combined": fit}, names)
    kinds = layers.column_layers(spark, motifs, chosen, paired)
    sinks.write_table(weights.join(F.broadcast(kinds), "feature"), f"{a.output}/importances")
    about = [*sinks.facts(target.join(rows, layers.ROW, "left_semi").withColumnRenamed("expression", "y")), *[f"- features of {layer}: {len(own)}" for layer, (_, own) in fits.items()]]
    sinks.write_text(sinks.report(metrics, "Layers", "absolute", weights, about, kinds=kinds, n=20), metrics, f"{a.output}/report")


def gene_specific(spark, a) -> None:
    genes = [r[0] for r in files.read_genes(spark, a.gene_file, a.genes).collect()]
    table = features.gene_features(files.read_consolidated(spark, a.sites), genes)
    long = files.read_expression(spark, a.expression).where(F.col("gene_id").isin(genes))
    if a.type == "relative":
        values = features.long_values(features.gene_differences(table, a.reference_line), [f"{c}_diff" for c in features.GENE])
        target, label = expression.difference(long, a.reference_line), "expression_difference"
    else:
        values, target, label = features.long_values(table, features.GENE), long, "expression"
    values = persist_table(values, "values")
    names = sorted(r[0] for r in features.varying(values).select("feature").collect())
    data = models.design(values, target, names, label)
    n = data.count()
    if n <= 10:
        sinks.write_text([f"leave-one-out R2: {models.pooled_r2(data):.4f}" if n >= 2 else "too few rows"], data, f"{a.output}/report")
    else:
        _model_outputs(spark, models.row_folds(data, min(5, n)), names, a.output, "Gene-specific analysis", "gene", a.trees)


def mixed(spark, a) -> None:
    wide = files.read_features(spark, a.features)
    keys = ("gene_id", "line")
    names = [c for c, t in wide.dtypes if t == "double" and ("motif" in c.lower() or c.startswith("MOTIF"))]
    values = wide.unpivot(list(keys), names, "feature", "value")
    data = persist_table(models.design(values, files.read_expression(spark, a.expression), names), "design")
    coefficients, found = models.within_gene(data, names)
    by_gene = persist_table(models.gene_by_gene(data, names), "genes")
    if a.approach in ("all", "mixed_effects"):
        sinks.write_table(coefficients, f"{a.output}/mixed_effects")
    if a.approach in ("all", "gene_by_gene"):
        sinks.write_table(by_gene, f"{a.output}/gene_by_gene")
    sinks.write_table(models.compare_approaches(by_gene, found), f"{a.output}/comparison")


def diagnostic(spark, a) -> None:
    table = persist_table(files.read_consolidated(spark, a.sites), "sites")
    target = files.read_expression(spark, a.expression, reference=a.reference_line)
    rel = features.relative_features(features.relative_inputs(table), a.reference_line)
    values = persist_table(features.long_values(rel, list(features.DIFFERENCES)), "values")
    variances = features.varying(values)
    names = sorted(r[0] for r in variances.orderBy(F.desc("variance"), "feature").limit(50).select("feature").collect())
    data = persist_table(models.group_folds(models.design(values, target, names)), "design")
    grid = models.diagnostic_grid(spark, models.gather(models.row_folds(data.drop("fold")), names), models.gather(data, names))
    found = features.correlations(values, target)
    extremes, counts = features.extremes(variances, "variance"), features.extremes(features.nonzero_counts(values), "nonzero").where("side = 'top'")
    for name, t in (("grid", grid), ("variance_extremes", extremes), ("top_nonzero", counts), ("correlations", found), ("variances", variances), ("nonzero", features.nonzero_counts(values)), ("expression", expression.profile(target)), ("motifs_per_gene", features.motifs_per_gene(table))):
        sinks.write_table(t, f"{a.output}/{name}")
    sinks.write_text([r["advice"] for r in models.recommendations(spark, grid, found, variances).orderBy("n").collect()], table, f"{a.output}/advice")


def catalog(spark, a) -> None:
    records = persist_table(files.read_motifs(spark, f"{a.folder.rstrip('/')}/streme_*/streme.txt"), "records")
    placed = persist_table(cluster.cluster(records, a.threshold, "consensus", lambda n: F.format_string("MOTIF_%03d", n)).withColumnRenamed(M, "cluster_id"), "catalog")
    sinks.write_table(encode.occurrences(placed), f"{a.output}/catalog")
    sinks.write_table(placed.select("line", "motif_id", "consensus", "evalue", "n_sites", "width", "cluster_id"), f"{a.output}/line_map")
    found = encode.occurrences(placed)
    marked = placed.join(found.select("cluster_id", "is_common"), "cluster_id")
    sinks.write_catalog(found, encode.regulatory_map(marked), encode.cluster_strings(placed), f"{a.output}/maps")
    pairs = persist_table(encode.similar_line_pairs(records), "pairs")
    sinks.write_pair_report(records, pairs, f"{a.output}/pairs")
    runs = records.groupBy("line").agg(F.count("*").alias("n_motifs"))
    sinks.write_text(sinks.master_report(runs, found, pairs), records, f"{a.output}/report")
    sinks.write_fasta(encode.consensus_list(records), f"{a.output}/strings")
    if a.standing:  # each line is a run, in order
        for line in sorted(r[0] for r in runs.select("line").collect()):
            standing.append(records.where(F.col("line") == line), a.standing, line, a.threshold)
        sinks.write_table(standing.members(spark, a.standing).select("run", "motif_id", "consensus", "cluster_no"), f"{a.output}/standing")


def full(spark, a) -> int:
    table = consolidate(spark, a)
    failed = validate_table(table, a.output) == "fail"
    make_features(spark, a, table)
    if a.expression:
        relative(spark, a, table)
    return int(failed)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sitelattice")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, run, *places: str) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        for x in places:
            c.add_argument(x)
        c.add_argument("--output", default="out")
        c.set_defaults(run=run)
        return c

    def merging(c: argparse.ArgumentParser) -> None:
        c.add_argument("--threshold", type=float, default=0.75)
        c.add_argument("--lines")
        c.add_argument("--no-merge-overlaps", action="store_true")
        c.add_argument("--stream-overlaps", action="store_true", help="merge in constant memory, for hits that touch by the million")
        c.add_argument("--overlap-threshold", type=float, default=0.5)
        c.add_argument("--validate", action="store_true")

    def selecting(c: argparse.ArgumentParser, top: int | None = None) -> None:
        c.add_argument("--top-motifs", type=int, default=top)
        c.add_argument("--min-sites", type=int, default=10)

    def growing(c: argparse.ArgumentParser) -> None:
        c.add_argument("--trees", type=int, default=100, help="trees of a forest, rounds of boosting")

    merging(command("consolidate", consolidate, "folder"))
    command("validate", validate, "sites")
    c = command("features", make_features, "sites")
    c.add_argument("--expression")
    c.add_argument("--simple", action="store_true")
    selecting(c)
    c = command("relative", relative, "sites", "expression")
    growing(c)
    c.add_argument("--reference-line", default=REFERENCE)
    c.add_argument("--selection-method", choices=("variance", "frequency", "expression_corr"), default="variance")
    selecting(c, 100)
    c = command("absolute", absolute, "features", "expression")
    growing(c)
    c.add_argument("--detailed", action="store_true")
    c.add_argument("--top-motifs", type=int)
    c = command("comprehensive", comprehensive, "sites", "expression")
    growing(c)
    c.add_argument("--layers", default=",".join(layers.LAYERS))
    c.add_argument("--interactions", action="store_true")
    c.add_argument("--top-motifs", type=int, default=layers.TOP)
    c = command("gene-specific", gene_specific, "sites", "expression")
    growing(c)
    c.add_argument("--genes")
    c.add_argument("--gene-file")
    c.add_argument("--type", choices=("relative", "absolute"), default="relative")
    c.add_argument("--reference-line", default=REFERENCE)
    c = command("mixed", mixed, "features", "expression")
    c.add_argument("--approach", choices=("all", "mixed_effects", "gene_by_gene"), default="all")
    c = command("diagnostic", diagnostic, "sites", "expression")
    c.add_argument("--reference-line", default=REFERENCE)
    c = command("catalog", catalog, "folder")
    c.add_argument("--standing", help="folder of a catalog that lasts: lines it does not have yet are added to it")
    c.add_argument("--threshold", type=float, default=0.75)
    c = command("full", full, "folder")
    growing(c)
    merging(c)
    c.add_argument("--expression")
    c.add_argument("--simple", action="store_true")
    c.add_argument("--reference-line", default=REFERENCE)
    c.add_argument("--selection-method", default="variance")
    selecting(c, 100)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    found = a.run(session(), a)
    return found if isinstance(found, int) else 0


if __name__ == "__main__":
    raise SystemExit(main())
