"""Queries over sources and sinks: files are written from the derived views, in the
formats of the tools they come from, read back, and compared by SQL with what they were
written from."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelattice.operators import encode, expression, features, models, standing
from sitelattice.sources import files, sinks

from . import oracles as o
from . import tables, views
from .catalog import _BY, _INST, _SITE_COLUMNS, _SITE_SQL, M, _instances, consolidated, query, records


def _write_file(rows: DataFrame, path: str, head: list[str] = ()) -> None:
    """One file of the given name: ``head``, then the rows (key, value) in order of key, for
    tables of few rows (motifs, genes and lines)."""
    spark, part = rows.sparkSession, path + ".parts"
    body = rows.select(F.lit(1).alias("p"), "key", "value")
    if head:
        body = body.unionByName(spark.createDataFrame([(0, f"{i:06d}", h) for i, h in enumerate(head)], "p int, key string, value string"))
    body.coalesce(1).sortWithinPartitions("p", "key").select("value").write.text(part)
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(Path(path).getParent())
    made = next(f.getPath() for f in fs.listStatus(Path(part)) if f.getPath().getName().startswith("part-"))
    fs.rename(made, Path(path))
    fs.delete(Path(part), True)


def _write_parts(rows: DataFrame, path: str, head: list[str]) -> None:
    """A folder of files that follow each other in order of key, each with the ``head``."""

    def headed(batches):
        yield pa.RecordBatch.from_pydict({"value": head})
        yield from (pa.RecordBatch.from_arrays(b.columns, ["value"]) for b in batches)  # the head's schema

    rows.orderBy("key").select("value").mapInArrow(headed, "value string").write.text(path)


def _hits(spark: SparkSession, sf_dir: str) -> str:
    """A folder of runs with their hit tables, one a line."""
    folder = tables.new_path(spark, "runs")
    raw = tables.persist_table(views.sites_raw(spark, sf_dir), "raw", by=("line",))
    head = ["# hits", "\t".join(files.REQUIRED)]
    row = F.concat_ws("\t", "original_motif_id", "gene_id", F.col("start_pos").cast("string"), F.col("end_pos").cast("string"), "strand", F.col("score").cast("string"), F.lower("sequence"))
    for line in views.LINES:
        _write_parts(raw.where(F.col("line") == line).select(F.col("src_ord").alias("key"), row.alias("value")), f"{folder}/streme_{line}/sites.tsv", head)
    return folder


def _motif_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder of runs with their motif files, one a line: a block a motif, counted over all hits."""
    folder = tables.new_path(spark, "runs")
    found = tables.persist_table(records(spark, sf_dir), "records")
    block = F.concat_ws(
        "\n", F.concat(F.lit("MOTIF "), "motif_id", F.lit(" STREME")),
        F.concat(F.lit("letter-probability matrix: alength= 4 w= "), F.col("width").cast("string"), F.lit(" nsites= "), F.col("n_sites").cast("string"), F.lit(" E= "), F.col("evalue").cast("string")),
        F.lit(" 0.25 0.25 0.25 0.25\n"),
    )
    for line in views.LINES:
        _write_file(found.where(F.col("line") == line).select(F.format_string("%06d", "ord").alias("key"), block.alias("value")), f"{folder}/streme_{line}/streme.txt", ["MEME version 5", ""])
    return folder


@query(o.with_(o.RAW, o.select("gene_id line original_motif_id start_pos end_pos:i strand score:d sequence", "select * from sites_raw")))
def source_sites(spark, sf_dir):
    """Hit tables of all runs, found by folder, columns by name."""
    return files.read_sites(spark, _hits(spark, sf_dir)).drop("src_ord")


@query(o.with_(o.RAW, o.select("gene_id line original_motif_id start_pos end_pos:i strand score:d sequence", "select * from sites_raw where line in ('IM62', 'IM767')")))
def source_sites_of_lines(spark, sf_dir):
    return files.read_sites(spark, _hits(spark, sf_dir), ["IM62", "IM767"]).drop("src_ord")


@query(o.with_(f"{o.RAW},{o.RECORDS}", o.select("line motif_id consensus width n_sites ord evalue:d", "select line, motif_id, consensus, width, cast(n_sites as int) as n_sites, cast(row_number() over (order by 'streme_' || line, ord) as int) as ord, evalue from records")))
def source_motifs(spark, sf_dir):
    return files.read_motifs(spark, f"{_motif_files(spark, sf_dir)}/streme_*/streme.txt", iupac_only=True)


@query(o.with_(f"{o.RAW},{o.RECORDS}", "select 'streme_' || line as run, count(*) as n_motifs from records group by 1"))
def source_motif_counts(spark, sf_dir):
    return files.motif_counts(spark, f"{_motif_files(spark, sf_dir)}/streme_*/streme.txt")


@query(o.over_sites(o.select(_SITE_COLUMNS, _SITE_SQL)))
def sink_sites(spark, sf_dir):
    """The consolidated table written as text and read back by name."""
    path = tables.new_path(spark, "sites-text")
    sinks.write_sites(consolidated(spark, sf_dir), path)
    return files.read_consolidated(spark, path).drop("src_ord")


@query(o.with_(o.EXPRESSION, o.select("gene_id line expression:d", "select * from expression where expression is not null")))
def source_expression_long(spark, sf_dir):
    path = tables.new_path(spark, "expression")
    sinks.write_table(views.expression_long(spark, sf_dir), path)
    return files.read_expression(spark, path).where("expression is not null")


@query(o.with_(o.EXPRESSION, o.select("gene_id line expression:d", f"select * from expression where expression is not null and line <> '{o.REF}'")))
def source_expression_wide(spark, sf_dir):
    """A table of a column a line, without the reference line."""
    path = tables.new_path(spark, "expression-wide")
    sinks.write_table(expression.to_wide(views.expression_long(spark, sf_dir), list(views.LINES)), path)
    return files.read_expression(spark, path, reference=o.REF).where("expression is not null")


@query(o.with_(o.EXPRESSION, o.select("gene_id line expression:d", "select gene_id, line, coalesce(expression, 0) as expression from expression")))
def source_expression_lenient(spark, sf_dir):
    """Other column names; a missing value is 0."""
    path = tables.new_path(spark, "expression-lenient") + "/expression.tsv"
    long = views.expression_long(spark, sf_dir)
    _write_file(long.select(F.concat_ws("|", "gene_id", "line").alias("key"), F.concat_ws("\t", F.coalesce(F.col("expression").cast("string"), F.lit("")), "line", "gene_id").alias("value")), path, ["value\tLine\tGene"])
    return files.read_expression_lenient(spark, path)


@query(o.over_sites(f"select * from (pivot (select l.line, g.gene_id, g.gene_id || '_' || l.line as gene_line_id, s.{M}, case when s.{M} is null then 0 else 1 end as present from (select distinct gene_id from sites) g cross join (select distinct line from sites) l left join sites s on s.gene_id = g.gene_id and s.line = l.line) on {M} using cast(coalesce(max(present), 0) as double) as present group by line, gene_id, gene_line_id)"))
def sink_features(spark, sf_dir):
    """The wide matrix of every gene in every line, written and read back."""
    path = tables.new_path(spark, "features")
    sinks.write_features(features.presence(consolidated(spark, sf_dir)), ["present"], None, path)
    return files.read_features(spark, path)


@query(o.with_(f"{o.RAW},{o.RECORDS}", "select line as id, string_agg(consensus, '|' order by ord) as sequence from records group by 1"))
def sink_fasta(spark, sf_dir):
    path = tables.new_path(spark, "fasta")
    sinks.write_fasta(encode.consensus_list(records(spark, sf_dir)), path)
    return files.read_fasta(spark, path).select("id", "sequence")


@query(o.with_(f"{o.RAW},{_INST}", f"select unit, unit || ' mode=consensus motifs=' || count(*) || ' consensuses=' || string_agg(consensus, ',' {_BY}) || ' positions=' || string_agg(cast(position as varchar), ',' {_BY}) as header from inst group by 1"))
def fasta_header(spark, sf_dir):
    return sinks.fasta_header("consensus", _instances(spark, sf_dir), "unit")


@query(o.with_(f"{o.RAW},{o.RECORDS}", o.select("motif_id name evalue:d n_sites width", "select motif_id, line as name, case when ord % 7 = 0 then null else evalue end as evalue, cast(n_sites as int) as n_sites, width from records")))
def source_motif_list(spark, sf_dir):
    path = tables.new_path(spark, "motif-list")
    e = F.when(F.col("ord") % 7 == 0, "N/A").otherwise(F.col("evalue").cast("string"))
    rows = records(spark, sf_dir).select(F.concat_ws("\t", "motif_id", "line", e, F.col("n_sites").cast("string"), F.col("width").cast("string")).alias("value"))
    rows.unionAll(spark.createDataFrame([("# comment",), ("",), ("short",)], "value string")).write.text(path)
    return files.read_motif_list(spark, path)


@query(o.with_(o.RAW, "select distinct gene_id from sites_raw"))
def source_genes(spark, sf_dir):
    path = tables.new_path(spark, "genes")
    views.sites_raw(spark, sf_dir).select(F.concat(F.lit(" "), "gene_id", F.lit(" "))).distinct().unionAll(spark.createDataFrame([("",)], "value string")).write.text(path)
    return files.read_genes(spark, path)


@query(o.with_(o.EXPRESSION, o.select("line least:d q1:d median:d q3:d most:d n", "select line, min(expression) as least, quantile_cont(expression, 0.25) as q1, quantile_cont(expression, 0.5) as median, quantile_cont(expression, 0.75) as q3, max(expression) as most, count(expression) as n from expression group by 1")))
def chart_boxes(spark, sf_dir):
    """What a box plot of expression by line shows."""
    return sinks.box_data(views.expression_long(spark, sf_dir), "expression", "line")


@query(o.over_sites(o.select("bin low:d high:d n", "select bin, lo + bin * w as low, lo + (bin + 1) * w as high, count(*) as n from (select lo, w, cast(least(19, floor((cast(start_pos as double) - lo) / w)) as int) as bin from sites, (select cast(min(start_pos) as double) as lo, cast(max(start_pos) - min(start_pos) as double) / 20 as w from sites) r) t group by bin, lo, w")))
def chart_histogram(spark, sf_dir):
    """What a histogram of the hits' positions shows."""
    return sinks.histogram(consolidated(spark, sf_dir), "start_pos")


@query(o.with_(o.EXPRESSION, o.select("gene_id line expression:d " + " ".join(f"line_{x}" for x in sorted(views.LINES)[1:]), "select *, " + ", ".join(f"cast(line = '{x}' as int) as line_{x}" for x in sorted(views.LINES)[1:]) + " from expression")))
def line_dummies(spark, sf_dir):
    return features.dummies(views.expression_long(spark, sf_dir), "line", list(views.LINES))


_CHANGE = "case " + " ".join(f"when ends_with(feature, '_{end}') then '{word}'" for end, word in features.CHANGES.items()) + " else 'other' end"
_OWN = "case " + " ".join(f"when ends_with(feature, '_{end}') then replace(feature, '_{end}', '')" for end in features.CHANGES) + " else feature end"
_ALL_VALUES = "vals as (select gene_id, line, concat_ws('_', consolidated_motif_id, f) as feature, v as value from (select gene_id, line, consolidated_motif_id, unnest(['presence_diff', 'count_diff', 'position_mean_diff', 'proximal_density_diff', 'gc_content_diff']) as f, unnest([cast(presence_diff as double), cast(count_diff as double), position_mean_diff, proximal_density_diff, gc_content_diff]) as v from relative) z)"


def _all_values(spark, sf_dir):
    rel = features.relative_features(features.relative_inputs(consolidated(spark, sf_dir)), o.REF, [x for x in views.LINES if x != o.REF])
    return features.long_values(rel, ["presence_diff", "count_diff", "position_mean_diff", "proximal_density_diff", "gc_content_diff"])


@query(o.over_sites(f"select distinct feature, {_OWN} as motif, {_CHANGE} as change from vals", o.INPUTS, o.RELATIVE, _ALL_VALUES))
def feature_labels(spark, sf_dir):
    """Which motif and which kind of change each feature stands for."""
    return features.labelled(_all_values(spark, sf_dir).select("feature").distinct())


@query(o.over_sites(o.select("side place feature variance:d", "select 'top' as side, cast(row_number() over (order by round(v, 9) desc, feature) as int) as place, feature, v as variance from var_ qualify place <= 10 union all select 'bottom', cast(row_number() over (order by round(v, 9), feature) as int) as place, feature, v from var_ qualify place <= 10"), o.INPUTS, o.RELATIVE, _ALL_VALUES, "var_ as (select feature, var_samp(value) as v from vals group by 1 having var_samp(value) is null or round(var_samp(value), 9) <> 0)"))
def variance_extremes(spark, sf_dir):
    """The ten features that vary most, and the ten that vary least."""
    spread = features.varying(_all_values(spark, sf_dir)).withColumn("variance", F.round("variance", 9)).where("variance is null or variance <> 0")
    return features.extremes(spread, "variance")


@query(o.over_sites("select cast(row_number() over (order by nonzero desc, feature) as int) as place, feature, nonzero from (select feature, count(*) filter (value <> 0) as nonzero from vals group by 1) t qualify place <= 10", o.INPUTS, o.RELATIVE, _ALL_VALUES))
def top_nonzero(spark, sf_dir):
    top = features.extremes(features.nonzero_counts(_all_values(spark, sf_dir)), "nonzero")
    return top.where("side = 'top'").drop("side")


#: Least squares of expression on the five differences of the commonest motif: what SQL can fit.
_ONE = f"first_ as (select {M} from sites group by 1 order by count(*) desc, {M} limit 1), xy as (select e.gene_id, e.line, e.expression as y, coalesce(r.presence_diff, 0) as x from expression e left join (select * from relative join first_ using ({M})) r using (gene_id, line) where e.line <> '{o.REF}' and e.expression is not null)"


@query(o.over_sites(o.select("slope:d intercept:d r2:d n", "select regr_slope(y, x) as slope, regr_intercept(y, x) as intercept, regr_r2(y, x) as r2, regr_count(y, x) as n from xy"), o.INPUTS, o.RELATIVE, o.EXPRESSION, _ONE))
def one_feature_fit(spark, sf_dir):
    """Least squares on one feature, by the sums of products that all linear models use."""
    table = consolidated(spark, sf_dir)
    motif = [r[0] for r in table.groupBy(M).count().orderBy(F.desc("count"), M).limit(1).select(M).collect()]
    rel = features.relative_features(features.relative_inputs(table.where(F.col(M).isin(motif))), o.REF, [x for x in views.LINES if x != o.REF])
    names = [f"{m}_presence_diff" for m in motif]
    data = models.design(features.long_values(rel, ["presence_diff"]), expression.without_reference(views.expression_long(spark, sf_dir), o.REF), names).withColumn("fold", F.lit(0))
    p = models.gather(data, names).total()
    beta = models.ridge(p, 0.0)
    return spark.createDataFrame([(float(beta[1]), float(beta[0]), models.score(p, beta)[0], int(p[0, 0]))], "slope double, intercept double, r2 double, n long")


_STANDING = f"""
standing_rec as (select ord, line, consensus, {o.masks('consensus')} as m from records),
standing_close as (select a.ord as i, b.ord as j from standing_rec a join standing_rec b on a.ord < b.ord and abs(length(a.consensus) - length(b.consensus)) <= 3 and length(a.consensus) >= 3 and length(b.consensus) >= 3
  where {o.similarity('a.consensus', 'b.consensus', 'a.m', 'b.m')} >= 0.75e0), {o.leaders('standing_close', 'standing_rec', 'standing_all')}"""


@query(o.with_(f"{o.RAW},{o.RECORDS},{_STANDING}", "select line as run, ord, cast(cluster_no as int) as cluster_no from standing_all"))
def standing_catalog(spark, sf_dir):
    """Line after line added to a catalog on disk; the oracle sweeps all at once."""
    path, found = tables.new_path(spark, "standing"), tables.persist_table(records(spark, sf_dir), "records")
    for line in sorted(r[0] for r in found.select("line").distinct().collect()):
        standing.append(found.where(F.col("line") == line), path, line)
    return standing.members(spark, path).select("run", "ord", "cluster_no")
