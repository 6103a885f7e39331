"""Writers. Tables are written by all executors as a folder of part files in the order
asked for; reports are small texts made from aggregates on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelattice.operators import encode, features
from sitelattice.operators.sites import COLUMNS


def write_sites(sites: DataFrame, path: str) -> None:
    """The 17 columns by motif number, line, gene and start. Ids go beyond three digits, so
    their number orders them, not their text."""
    number = F.regexp_extract("consolidated_motif_id", r"(\d+)", 1).cast("int")
    ordered = sites.orderBy(number, "line", "gene_id", "start_pos", "end_pos", "strand")
    ordered.select(*COLUMNS).write.mode("overwrite").csv(path, sep="\t", header=True, emptyValue="", nullValue="")


def write_features(long: DataFrame, columns: list[str], motifs: list[str] | None, path: str, expression: DataFrame | None = None) -> None:
    """The wide matrix, a row for every gene in every line, columns sorted, missing features 0, missing expression empty."""
    lines = sorted(r[0] for r in long.select("line").distinct().collect())  # a row a line
    cells = long.select("gene_id").distinct().withColumn("line", F.explode(F.array(*[F.lit(x) for x in lines]) if lines else F.array().cast("array<string>")))
    wide = cells.join(features.matrix(long, columns, motifs), ["gene_id", "line"], "left").na.fill(0)
    names = sorted(c for c in wide.columns if c not in ("gene_id", "line"))
    out = wide.select("line", F.col("gene_id").alias("gene"), F.concat_ws("_", "gene_id", "line").alias("gene_line_id"), *[F.col(f"`{c}`") for c in names])
    if expression is not None:
        out = out.join(expression.select(F.col("gene_id").alias("gene"), "line", "expression"), ["gene", "line"], "left")
    out.write.mode("overwrite").csv(path, header=True)


def write_table(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").csv(path, sep="\t", header=True)


def write_text(lines: list[str], df: DataFrame, path: str) -> None:
    """A short report, as text."""
    spark = df.sparkSession
    spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "n int, value string").coalesce(1).sortWithinPartitions("n").select("value").write.mode("overwrite").text(path)


def write_fasta(strings: DataFrame, path: str, header: str = "line", sequence: str = "encoded") -> None:
    strings.select(F.concat(F.lit(">"), F.col(header), F.lit("\n"), F.col(sequence)).alias("value")).write.mode("overwrite").text(path)


def write_json(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").json(path)


def fasta_header(mode: str, instances: DataFrame, by: str = "line") -> DataFrame:
    """Header of each string: mode, number of motifs, consensus and positions."""
    lists = instances.groupBy(by).agg(
        F.count("*").alias("n"), encode._ordered(F.col("consensus"), ",", encode.ORDER).alias("c"), encode._ordered(F.col("position").cast("string"), ",", encode.ORDER).alias("p")
    )
    return lists.select(by, F.concat(F.col(by), F.lit(f" mode={mode} motifs="), F.col("n").cast("string"), F.lit(" consensuses="), "c", F.lit(" positions="), "p").alias("header"))


#: R2 from which a kind of analysis calls a model strong, or moderate, or weak.
BANDS = {"relative": (0.4, 0.2), "absolute": (0.5, 0.2), "gene": (0.7, 0.4, 0.1)}
WORDS = ("strong", "moderate", "weak", "none")


def verdict(r2, kind: str):
    """Band of an R2 column."""
    out = None
    for word, least in zip(WORDS, BANDS[kind], strict=False):
        out = F.when(r2 > F.lit(least), word) if out is None else out.when(r2 > F.lit(least), word)
    return out.otherwise("weak" if kind != "gene" else "none")


#: What a verdict means for the reader.
MEANING = {
    "strong": "Motif features explain much of the variation in expression.",
    "moderate": "Motif features explain a part of the variation in expression.",
    "weak": "Motif features explain little; other mechanisms, or the data, should be looked at.",
    "none": "Motif features explain nothing that carries over to data not seen.",
}


def facts(data: DataFrame, reference: str | None = None) -> list[str]:
    """What a model was fitted on, from one aggregate over its design (gene_id, line, y)."""
    r = data.agg(F.count("*").alias("n"), F.countDistinct("gene_id").alias("genes"), F.array_sort(F.collect_set("line")).alias("lines"), F.min("y").alias("low"), F.max("y").alias("high")).first()
    out = [f"- rows: {r['n']}", f"- genes: {r['genes']}", f"- lines: {', '.join(r['lines'])}"]
    if reference:
        out.append(f"- reference line: {reference}")
    return out + ([f"- target: {r['low']:.3f} to {r['high']:.3f}"] if r["n"] else [])


def report(metrics: DataFrame, title: str, kind: str, importances: DataFrame | None = None, about: list[str] = (), n: int = 10, kinds: DataFrame | None = None) -> list[str]:
    """Markdown of a model comparison: what was fitted, a row a model, the ``n`` most
    important features by motif and kind of change (or by their layers, if ``kinds`` has
    these), and what the best R2 means."""
    rows = metrics.withColumn("band", verdict(F.col("cv_r2"), kind)).orderBy(F.isnan("cv_r2"), F.desc("cv_r2"), "model").collect()
    out = [f"# {title}", "", "| model | cv R2 | sd | R2 | RMSE | verdict |", "| --- | --- | --- | --- | --- | --- |"]
    out += [f"| {r['model']} | {r['cv_r2']:.4f} | {r['cv_std']:.4f} | {r['r2']:.4f} | {r['rmse']:.4f} | {r['band']} |" for r in rows]
    out += ["", f"Best: {rows[0]['model']}" if rows else "No model could be fitted."]
    if about:
        out += ["", "## Data", *about]
    if importances is not None:
        mean = importances.groupBy("feature").agg(F.avg("importance").alias("importance")).orderBy(F.desc("importance"), "feature").limit(n)
        shown = features.labelled(mean) if kinds is None else mean.join(kinds, "feature").select("feature", "importance", F.col("feature").alias("motif"), F.col("layer").alias("change"))
        out += ["", "## Most important features", *[f"- {r['motif']} ({r['change']}): {r['importance']:.4f}" for r in shown.orderBy(F.desc("importance"), "feature").collect()]]
    if rows:
        out += ["", "## Reading", f"{MEANING[rows[0]['band']]} Held-out R2 of the best model: {100 * rows[0]['cv_r2']:.1f} %."]
    return out


#: What the columns of a feature matrix hold, by their ending.
DESCRIBED = {
    "motif_count": "hits of the motif", "position_mean": "mean position of the hits", "position_std": "spread of the positions", "position_min": "first position", "position_max": "last position",
    "position_range": "distance from the first to the last hit", "density_proximal": "hits a 100 bases at 700 to 1000, next to the start of transcription", "density_core": "hits a 100 bases at 300 to 700",
    "density_distal": "hits a 100 bases below 300", "spacing_regularity": "spread of the distances between hits over their mean", "seq_diversity": "different sequences a hit", "seq_length_mean": "mean length",
    "seq_length_std": "spread of the lengths", "gc_content_mean": "mean share of G and C", "gc_content_std": "spread of the share of G and C", "mutation_load": "mean share of bases that differ from the consensus",
    "consensus_similarity_mean": "mean likeness to the consensus", "consensus_similarity_std": "spread of the likeness to the consensus", "present": "1 if the motif has a hit, else 0",
}


def feature_descriptions(support: DataFrame, columns: list[str]) -> list[str]:
    """What the matrix holds: its keys, each kind of column, and the hits of each motif.
    ``support`` (motif, n_sites) is a row a motif chosen."""
    rows = support.orderBy("consolidated_motif_id").collect()
    out = ["# Feature matrix", "", "A row for each gene in each line; a motif without hits there has 0 in all its columns.", "", "## Keys", "- line", "- gene", "- gene_line_id: gene and line", "", "## Columns of each motif"]
    out += [f"- <motif>_{c}: {DESCRIBED.get(c, c)}" for c in columns]
    return [*out, "", "## Motifs", *[f"- {r['consolidated_motif_id']}: {r['n_sites']} hits" for r in rows]]


def feature_summary(columns: list[str], n_rows: int) -> list[str]:
    """Rows, columns, and columns by family of feature."""
    families = {"presence": ("_present",), "position": ("position_", "density_", "spacing_", "motif_count"), "variation": ("seq_", "gc_content", "mutation_load", "consensus_similarity")}
    return [f"rows: {n_rows}", f"features: {len(columns)}", *[f"{name}: {sum(any(k in c for k in keys) for c in columns)}" for name, keys in families.items()]]


def chart_data(importances: DataFrame, n: int = 20) -> DataFrame:
    """What a bar chart or heat map of importances shows: the top features by mean, a
    column a model."""
    top = importances.groupBy("feature").agg(F.avg("importance").alias("mean_importance")).orderBy(F.desc("mean_importance"), "feature").limit(n)
    models = sorted(r[0] for r in importances.select("model").distinct().collect())
    return importances.join(F.broadcast(top), "feature").groupBy("feature", "mean_importance").pivot("model", models).agg(F.first("importance"))


def histogram(table: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """What a histogram shows: (bin, low, high, n) over the column's range."""
    low, high = table.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()
    if low is None:
        return table.sparkSession.createDataFrame([], "bin int, low double, high double, n long")
    width = (high - low) / bins or 1.0
    at = F.least(F.lit(bins - 1), F.floor((F.col(column) - F.lit(low)) / F.lit(width)).cast("int"))
    counts = table.where(F.col(column).isNotNull()).groupBy(at.alias("bin")).agg(F.count("*").alias("n"))
    return counts.select("bin", (F.lit(low) + F.col("bin") * width).alias("low"), (F.lit(low) + (F.col("bin") + 1) * width).alias("high"), "n")


def box_data(table: DataFrame, value: str, by: str) -> DataFrame:
    """What a box plot shows: quartiles, extremes and count of each group."""
    q = lambda p: F.expr(f"percentile(`{value}`, {p}D)")
    return table.groupBy(by).agg(F.min(value).alias("least"), q(0.25).alias("q1"), q(0.5).alias("median"), q(0.75).alias("q3"), F.max(value).alias("most"), F.count(value).alias("n"))


def write_pair_report(motifs: DataFrame, pairs: DataFrame, path: str) -> None:
    """A text line for each motif and each similar pair of paired lines, in order."""
    show = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("N/A"))
    listed = motifs.select(F.lit(0).alias("part"), F.col("line").alias("a"), F.col("motif_id").alias("b"), F.concat_ws(" ", F.lit("line"), "line", F.lit("motif"), "motif_id", F.lit("E"), show("evalue"), F.lit("sites"), show("n_sites"), F.lit("width"), show("width")).alias("value"))
    found = pairs.select(F.lit(1).alias("part"), F.lpad(F.col("pair_no").cast("string"), 8, "0").alias("a"), F.col("motif_1").alias("b"), F.concat_ws(" ", F.lit("pair"), F.col("pair_no").cast("string"), "motif_1", F.concat(F.lit("("), "line_1", F.lit(")")), F.lit("~"), "motif_2", F.concat(F.lit("("), "line_2", F.lit(")"))).alias("value"))
    listed.unionByName(found).orderBy("part", "a", "b").select("value").write.mode("overwrite").text(path)


def master_report(runs: DataFrame, catalog: DataFrame, pairs: DataFrame, n: int = 20) -> list[str]:
    """Markdown over all runs: motifs of each, the pairs compared, the motifs that most
    lines share. ``runs`` (line, n_motifs) and ``pairs`` are a row a run and a similar pair."""
    listed = runs.orderBy("line").collect()
    found = pairs.groupBy("pair_no", "line_1", "line_2").agg(F.count("*").alias("n")).orderBy("pair_no").collect()
    shared = catalog.where("n_lines > 1")
    out = ["# All runs", "", f"runs: {len(listed)}, motifs: {sum(r['n_motifs'] for r in listed)}, clusters: {catalog.count()}, in several lines: {shared.count()}", "", "| line | motifs |", "| --- | --- |"]
    out += [f"| {r['line']} | {r['n_motifs']} |" for r in listed]
    out += ["", "## Similar motifs by pair of lines", *[f"- pair {r['pair_no']}: {r['line_1']} and {r['line_2']}, {r['n']} pairs of motifs" for r in found]]
    return [*out, "", "## Motifs of most lines", *[f"- {r['cluster_id']}: {r['occurrences']} in {r['n_lines']} lines ({r['lines']})" for r in shared.orderBy(F.desc("n_lines"), F.desc("occurrences"), "cluster_id").limit(n).collect()]]


def write_group_report(pairs: DataFrame, path: str) -> None:
    """A text line for each pair of sequences, with its kind, GC contents and lengths."""
    number = lambda c: F.when(F.col(c).isNotNull(), F.format_string("%.3f", F.col(c)))
    line = F.concat_ws("\t", F.concat(F.lit("pair_"), F.col("pair_no").cast("string")), "kind", F.col("first_id").cast("string"), F.col("second_id").cast("string"), number("gc_first"), number("gc_second"), F.col("length_first").cast("string"), F.col("length_second").cast("string"))
    pairs.orderBy("pair_no").select(line.alias("value")).write.mode("overwrite").text(path)


def write_catalog(catalog: DataFrame, maps: DataFrame, strings: DataFrame, path: str) -> None:
    """Catalog and strings as tables, the regulatory maps as JSON, the strings as FASTA."""
    write_table(catalog, f"{path}/catalog")
    write_json(maps, f"{path}/maps")
    write_table(strings, f"{path}/strings")
    for c in strings.columns[1:]:
        write_fasta(strings, f"{path}/fasta_{c}", strings.columns[0], c)
