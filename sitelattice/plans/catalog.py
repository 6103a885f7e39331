"""All named queries of the site analytics, with their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelattice.functions import seq
from sitelattice.operators import cluster, consensus, encode, expression, features, quality, sites

from . import oracles as o
from . import tables, views

FLAGSHIP = "consolidate"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
M = "consolidated_motif_id"
REF = views.REFERENCE_LINE
OTHERS = [x for x in views.LINES if x != REF]


def query(sql: str | None = None):
    """Register a query. Doubles are rounded to six places, as in its oracle; what the
    engines sum in another order then agrees. The oracle's round scales, rounds to a whole
    number and scales back, so 41/640 ends in 062; one on the decimal digits would give 063."""

    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(spark, sf_dir)
            return df.select(*[(F.round(F.col(f"`{c}`") * F.lit(1e6)) / F.lit(1e6) + F.lit(0.0)).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes])

        run.__doc__ = f.__doc__
        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.sites_raw(spark, sf_dir).withColumn("pattern", seq.strip_prefix(F.col("original_motif_id")))


_CONSOLIDATED: dict[tuple, str] = {}


def consolidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consolidated table, made and written once a session and input; what is derived
    from it reads the written table."""
    key = (spark.sparkContext.applicationId, sf_dir, tables.stamp(spark, f"{sf_dir}/lineitem.parquet"))
    path = _CONSOLIDATED.get(key)
    if path is None or tables.stamp(spark, path) is None:
        path = _CONSOLIDATED[key] = tables.new_path(spark, "consolidated")
        tables.persist_table(sites.consolidate(views.sites_raw(spark, sf_dir)), "consolidated", path)
    return spark.read.parquet(path)


_EXPRESSION: dict[tuple, str] = {}


def expression_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The expression values, a row a gene and line, made and written once a session and input
    for what reads them several times."""
    key = (spark.sparkContext.applicationId, sf_dir, tables.stamp(spark, f"{sf_dir}/lineitem.parquet"))
    path = _EXPRESSION.get(key)
    if path is None or tables.stamp(spark, path) is None:
        path = _EXPRESSION[key] = tables.new_path(spark, "expression")
        tables.persist_table(views.expression_long(spark, sf_dir), "expression", path)
    return spark.read.parquet(path)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.motif_records(views.sites_raw(spark, sf_dir))


# ---- scans and scalars ----


@query(o.with_(o.RAW, o.select("gene_id line original_motif_id start_pos end_pos:i strand score:d sequence src_ord", "select * from sites_raw")))
def site_scan(spark, sf_dir):
    return views.sites_raw(spark, sf_dir)


@query(o.with_(o.RAW, "select distinct original_motif_id, pattern from raw"))
def strip_prefix(spark, sf_dir):
    return raw(spark, sf_dir).select("original_motif_id", "pattern").distinct()


@query(o.with_(o.RAW, o.select("sequence gc:d a:d t:d g:d c:d reverse_complement length", f"select distinct sequence, {o.gc('sequence')} as gc, {', '.join(f'{o.fraction("sequence", b)} as {b.lower()}' for b in 'ATGC')}, reverse(translate(sequence, '{seq.COMPLEMENT[0]}', '{seq.COMPLEMENT[1]}')) as reverse_complement, cast(length(sequence) as int) as length from raw")))
def sequence_scalars(spark, sf_dir):
    s = F.col("sequence")
    return raw(spark, sf_dir).select("sequence").distinct().select(
        s, seq.gc_content(s).alias("gc"), *[seq.base_fraction(s, b).alias(b.lower()) for b in "ATGC"], seq.reverse_complement(s).alias("reverse_complement"), F.length(s).alias("length")
    )


@query(o.with_(o.RAW, o.select("sequence pattern positional_score:d mutation:d alike", f"select distinct sequence, pattern, {o.positional('sequence', 'pattern')} as positional_score, {o.mutation('sequence', 'pattern')} as mutation, cast(abs({o.gc('sequence')} - {o.gc('pattern')}) < 0.2e0 and cast(least(length(sequence), length(pattern)) as double) / greatest(length(sequence), length(pattern)) > 0.8e0 as int) as alike from raw")))
def sequence_pattern_scores(spark, sf_dir):
    s, p = F.col("sequence"), F.col("pattern")
    pairs = raw(spark, sf_dir).select("sequence", "pattern").distinct()
    return pairs.select(s, p, seq.positional_similarity(s, p).alias("positional_score"), seq.mutation_share(s, p).alias("mutation"), seq.alike(s, p).cast("int").alias("alike"))


def _aligned_sql(a: str, b: str) -> str:
    low, high = f"least(length({a}), length({b}))", f"greatest(length({a}), length({b}))"
    options = []
    for other in (b, f"reverse(translate({b}, '{seq.COMPLEMENT[0]}', '{seq.COMPLEMENT[1]}'))"):
        ma, mb = o.masks(a), o.masks(other)
        options.append(f"cast({o.matches(ma, mb, low)} as double) / {high}")
        for d in range(-3, 4):
            n = f"greatest(0, least({low} - 1, length({b}) - 1 - ({d})) - {max(0, -d)} + 1)"
            options.append(f"case when {n} > 0 and {n} >= {low} * 0.7e0 then cast({o.matches(ma, mb, low, d)} as double) / {n} * (cast({low} as double) / {high}) else 0e0 end")
    return f"greatest({', '.join(options)})"


@query(o.with_(o.RAW, o.select("a b similarity:d comparable aligned:d", f"select x.pattern as a, y.pattern as b, {o.similarity('x.pattern', 'y.pattern', o.masks('x.pattern'), o.masks('y.pattern'))} as similarity, cast(abs(length(x.pattern) - length(y.pattern)) <= 3 and length(x.pattern) >= 3 and length(y.pattern) >= 3 as int) as comparable, {_aligned_sql('x.pattern', 'y.pattern')} as aligned from (select distinct pattern from raw) x join (select distinct pattern from raw) y on abs(length(x.pattern) - length(y.pattern)) <= 3")))
def pattern_scores(spark, sf_dir):
    """Similarities of all patterns whose lengths differ by three at most."""
    p = raw(spark, sf_dir).select("pattern").distinct()
    n = F.length("pattern")
    a = p.select(F.col("pattern").alias("a"), F.explode(F.sequence(n - 3, n + 3)).alias("k"))
    b = p.select(F.col("pattern").alias("b"), n.alias("k"))
    x, y = F.col("a"), F.col("b")
    return a.join(b, "k").select("a", "b", seq.similarity(x, y).alias("similarity"), seq.comparable(x, y).cast("int").alias("comparable"), seq.aligned_similarity(x, y).alias("aligned"))


# ---- consolidation ----


@query(o.with_(f"{o.RAW},{o.CONSENSUS}", "select pattern, true_consensus, n_sites, first_ord from consensus"))
def pattern_consensus(spark, sf_dir):
    return consensus.pattern_consensus(raw(spark, sf_dir))


def _motifs(spark, sf_dir):
    return consensus.with_order(consensus.pattern_consensus(raw(spark, sf_dir)))


@query(o.with_(f"{o.RAW},{o.CONSENSUS},{o.EDGES}", o.select("i j similarity:d", "select cast(i as int) as i, cast(j as int) as j, similarity from near_")))
def motif_similarity_pairs(spark, sf_dir):
    return cluster.similar_pairs(sites.persist_table(_motifs(spark, sf_dir), "motifs"))


@query(o.with_(f"{o.RAW},{o.CONSENSUS},{o.EDGES},{o.CLUSTERS}", f"select pattern, true_consensus, {M}, motif_consensus, cluster_size from clusters"))
def motif_clusters(spark, sf_dir):
    return sites.motif_clusters(raw(spark, sf_dir)).select("pattern", "true_consensus", M, "motif_consensus", "cluster_size")


_MERGED = o.over_sites(o.select(f"gene_id line strand {M} start_pos end_pos:i score:d sequence merged_count length", "select * exclude (merged_count, length), cast(merged_count as int) as merged_count, cast(length as int) as length from merged"))


@query(_MERGED)
def overlap_merge(spark, sf_dir):
    placed = sites.assign_clusters(views.sites_raw(spark, sf_dir))
    return sites.merge_overlaps(placed).select(*sites.GROUP, "start_pos", "end_pos", "score", "sequence", "merged_count", "length")


@query(_MERGED)
def overlap_merge_streamed(spark, sf_dir):
    """The same in memory that does not grow with the hits that touch."""
    placed = sites.assign_clusters(views.sites_raw(spark, sf_dir))
    return sites.merge_overlaps_streamed(placed).select(*sites.GROUP, "start_pos", "end_pos", "score", "sequence", "merged_count", "length")


@query(o.with_(o.RAW, o.select("src_ord gene_id line relative_position total_motifs_in_gene relative_position_fraction:d", "select src_ord, gene_id, line, cast(row_number() over w as int) as relative_position, cast(count(*) over (partition by gene_id, line) as int) as total_motifs_in_gene, cast(row_number() over w as double) / count(*) over (partition by gene_id, line) as relative_position_fraction from raw window w as (partition by gene_id, line order by start_pos, original_motif_id, strand, end_pos, src_ord)")))
def rank_in_gene(spark, sf_dir):
    return sites.rank_in_gene(views.sites_raw(spark, sf_dir)).select("src_ord", "gene_id", "line", "relative_position", "total_motifs_in_gene", "relative_position_fraction")


_SITE_COLUMNS = f"{M} original_motif_id motif_consensus original_streme_consensus line gene_id start_pos end_pos:i strand score:d sequence relative_position total_motifs_in_gene relative_position_fraction:d cluster_size merged_count length"
_SITE_SQL = "select * exclude (relative_position, total_motifs_in_gene, cluster_size, merged_count, length), cast(relative_position as int) as relative_position, cast(total_motifs_in_gene as int) as total_motifs_in_gene, cast(relative_position as double) / total_motifs_in_gene as relative_position_fraction, cast(cluster_size as int) as cluster_size, cast(merged_count as int) as merged_count, cast(length as int) as length from sites"


@query(o.over_sites(o.select(_SITE_COLUMNS, _SITE_SQL)))
def consolidate(spark, sf_dir):
    return sites.consolidate(views.sites_raw(spark, sf_dir)).select(*sites.COLUMNS)


@query(o.over_sites(f"select count(*) as n_sites, count(distinct {M}) as n_motifs, count(distinct line) as n_lines, count(distinct gene_id) as n_genes from sites"))
def global_summary(spark, sf_dir):
    return sites.global_summary(consolidated(spark, sf_dir))


@query(o.over_sites(f"select line, count(distinct gene_id) as n_genes, count(distinct {M}) as n_motifs, count(sequence) as n_sites from sites group by line"))
def line_summary(spark, sf_dir):
    return sites.line_summary(consolidated(spark, sf_dir))


@query(o.over_sites(f"select {M}, count(*) as n_sites, min(motif_consensus) as motif_consensus from sites group by 1 order by n_sites desc, {M} limit 20"))
def top_motifs(spark, sf_dir):
    return sites.top_motifs(consolidated(spark, sf_dir))


@query(o.over_sites(f"select {M}, count(*) as n_sites, min(src_ord) as first_ord from sites group by 1 having count(*) >= 10"))
def motif_support(spark, sf_dir):
    return sites.supported(consolidated(spark, sf_dir))


@query(o.over_sites(f"select {M}, count(*) as n_sites from sites group by 1 having count(*) >= 10 order by n_sites desc, min(src_ord) limit 10"))
def top_supported(spark, sf_dir):
    found = sites.supported(consolidated(spark, sf_dir))
    return found.orderBy(F.desc("n_sites"), "first_ord").limit(10).select(M, "n_sites")


# ---- quality ----


def _profile(spark, sf_dir):
    return quality.cluster_profile(consolidated(spark, sf_dir))


@query(o.over_sites(o.select(f"{M} n_sites n_unique diversity:d n_patterns min_length max_length composition_variance:d samples motif_consensus", "select * exclude (min_length, max_length), cast(min_length as int) as min_length, cast(max_length as int) as max_length from profile"), o.PROFILE))
def cluster_profile(spark, sf_dir):
    return _profile(spark, sf_dir)


@query(o.over_sites(f"select {M}, n_sites, high_diversity, many_patterns, mixed_composition, mixed_length, issues, suspicious, {o.ADVICE} as recommendation from advised", o.PROFILE))
def cluster_flags(spark, sf_dir):
    return quality.cluster_flags(_profile(spark, sf_dir))


#: A threshold at which unlike patterns share clusters, so that there is something to flag.
LOOSE = 0.3


def _loose(sql: str) -> str:
    return sql.replace("similarity >= 0.75e0", f"similarity >= {LOOSE}e0")


def _loose_profile(spark, sf_dir):
    # The profile reads the sites twice.
    return quality.cluster_profile(tables.persist_table(sites.consolidate(views.sites_raw(spark, sf_dir), LOOSE), "consolidated"))


@query(_loose(o.over_sites(f"select {M}, n_sites, high_diversity, many_patterns, mixed_composition, mixed_length, issues, suspicious, {o.ADVICE} as recommendation from advised", o.PROFILE)))
def loose_cluster_flags(spark, sf_dir):
    return quality.cluster_flags(_loose_profile(spark, sf_dir))


@query(_loose(o.over_sites(f"select {M}, n_sites, issues, {o.ADVICE} as recommendation from advised where suspicious = 1 order by n_sites desc, {M} limit 10", o.PROFILE)))
def worst_clusters(spark, sf_dir):
    """The largest flagged clusters of a loose clustering."""
    return quality.worst_clusters(quality.cluster_flags(_loose_profile(spark, sf_dir)))


@query(o.over_sites("select count(*) filter (n_sites = 1) as single, count(*) filter (n_sites between 2 and 10) as small, count(*) filter (n_sites between 11 and 100) as medium, count(*) filter (n_sites > 100) as large from profile", o.PROFILE))
def size_histogram(spark, sf_dir):
    return quality.size_histogram(_profile(spark, sf_dir))


@query(o.over_sites(o.select("n_clusters n_flagged mean_patterns:d max_patterns flagged_share:d verdict", "select count(*) as n_clusters, cast(coalesce(sum(suspicious), 0) as bigint) as n_flagged, avg(n_patterns) as mean_patterns, max(n_patterns) as max_patterns, cast(sum(suspicious) as double) / count(*) as flagged_share, case when count(*) = 0 then null when sum(suspicious) < count(*) * 0.05e0 then 'good' when sum(suspicious) < count(*) * 0.15e0 then 'moderate' else 'fail' end as verdict from advised"), o.PROFILE))
def verdict(spark, sf_dir):
    return quality.verdict(_profile(spark, sf_dir))


# ---- features ----


@query(o.over_sites(f"select {o.K}, 1 as present, count(*) as count from sites group by 1, 2, 3"))
def presence(spark, sf_dir):
    return features.presence(consolidated(spark, sf_dir))


@query(o.over_sites(o.select("gene_id line consolidated_motif_id motif_count position_mean:d position_std:d position_min position_max position_range density_proximal:d density_core:d density_distal:d spacing_regularity:d", f"select {o.K}, count(*) as motif_count, avg(p) as position_mean, stddev_pop(p) as position_std, min(p) as position_min, max(p) as position_max, max(p) - min(p) as position_range, cast(count(*) filter (p >= 700 and p <= 1000) as double) / 3 as density_proximal, cast(count(*) filter (p >= 300 and p < 700) as double) / 4 as density_core, cast(count(*) filter (p >= 0 and p < 300) as double) / 3 as density_distal, case when count(*) > 2 then stddev_pop(gap) / (avg(gap) + 1) else 0e0 end as spacing_regularity from gaps group by 1, 2, 3"), o.GAPS))
def position_features(spark, sf_dir):
    return features.position_features(consolidated(spark, sf_dir))


@query(o.over_sites(o.select("gene_id line consolidated_motif_id seq_diversity:d seq_length_mean:d seq_length_std:d gc_content_mean:d gc_content_std:d mutation_load:d", f"select {o.K}, cast(count(distinct sequence) as double) / count(*) as seq_diversity, avg(length(sequence)) as seq_length_mean, stddev_pop(length(sequence)) as seq_length_std, avg({o.gc('sequence')}) as gc_content_mean, stddev_pop({o.gc('sequence')}) as gc_content_std, coalesce(avg({o.mutation('sequence', 'motif_consensus')}), 0) as mutation_load from sites group by 1, 2, 3")))
def variation_features(spark, sf_dir):
    return features.variation_features(consolidated(spark, sf_dir))


@query(o.over_sites(o.select("gene_id line consolidated_motif_id consensus_similarity_mean:d consensus_similarity_std:d", f"select {o.K}, avg(coalesce(ratio, 0)) as consensus_similarity_mean, stddev_pop(coalesce(ratio, 0)) as consensus_similarity_std from sites left join ratios using (sequence, motif_consensus) group by 1, 2, 3"), o.RATIOS))
def matcher_similarity(spark, sf_dir):
    return features.matcher_similarity(consolidated(spark, sf_dir))


_INPUTS = "gene_id line consolidated_motif_id present count position_mean:d position_std:d position_min position_max proximal_density:d distal_density:d sequence_diversity:d gc_content_mean:d gc_content_std:d"


@query(o.over_sites(o.select(_INPUTS, "select * from inputs"), o.INPUTS))
def relative_inputs(spark, sf_dir):
    return features.relative_inputs(consolidated(spark, sf_dir))


@query(o.over_sites(o.select("gene_id line consolidated_motif_id proximal_density:d core_density:d distal_density:d position_weighted_score:d spacing_regularity:d closest_hit_distance total_hits", o.POSITION_LAYER), o.GAPS))
def position_layer(spark, sf_dir):
    return features.position_layer(consolidated(spark, sf_dir))


@query(o.over_sites(o.select("gene_id line consolidated_motif_id consensus_similarity_mean:d consensus_similarity_std:d sequence_diversity:d gc_content_mean:d gc_content_std:d length_mean:d length_std:d unique_sequences", o.VARIATION_LAYER)))
def variation_layer(spark, sf_dir):
    return features.variation_layer(consolidated(spark, sf_dir))


@query(o.over_sites(o.select("gene_id line consolidated_motif_id cross_line_diversity:d dominant_sequence_diversity:d line_has_unique_variant", o.CROSSLINE_LAYER), o.DOMINANT))
def crossline_layer(spark, sf_dir):
    return features.crossline_layer(consolidated(spark, sf_dir))


@query(o.over_sites(o.select("gene_id line consolidated_motif_id present count position_mean:d position_std:d position_min position_max score_mean:d score_max:d gc_content_mean:d", f"select c.*, coalesce(present, 0) as present, coalesce(count, 0) as count, coalesce(position_mean, 0) as position_mean, coalesce(position_std, 0) as position_std, coalesce(position_min, 0) as position_min, coalesce(position_max, 0) as position_max, coalesce(score_mean, 0) as score_mean, coalesce(score_max, 0) as score_max, coalesce(gc_content_mean, 0) as gc_content_mean from cells c left join found using (gene_id, line, {M})"), f"chosen as (select * from sites), found as (select {o.K}, 1 as present, count(*) as count, avg(start_pos) as position_mean, stddev_pop(start_pos) as position_std, min(start_pos) as position_min, max(start_pos) as position_max, avg(score) as score_mean, max(score) as score_max, avg({o.gc('sequence')}) as gc_content_mean from chosen group by 1, 2, 3), cells as (select gene_id, line, {M} from (select distinct gene_id, {M} from found) a join (select distinct gene_id, line from found) b using (gene_id))"))
def gene_features(spark, sf_dir):
    return features.gene_features(consolidated(spark, sf_dir))


_GENE_CTES = f"chosen as (select * from sites), found as (select {o.K}, 1 as present, count(*) as count, avg(start_pos) as position_mean, stddev_pop(start_pos) as position_std, min(start_pos) as position_min, max(start_pos) as position_max, avg(score) as score_mean, max(score) as score_max, avg({o.gc('sequence')}) as gc_content_mean from chosen group by 1, 2, 3), cells as (select gene_id, line, {M} from (select distinct gene_id, {M} from found) a join (select distinct gene_id, line from found) b using (gene_id))"
_GENE_INTS = ("present", "count", "position_min", "position_max")


@query(o.over_sites(o.select("gene_id line consolidated_motif_id " + " ".join(f"{c}_diff" + ("" if c in _GENE_INTS else ":d") for c in features.GENE), f"select c.gene_id, c.line, c.{M}, " + ", ".join(f"coalesce(f.{c}, 0) - coalesce(r.{c}, 0) as {c}_diff" for c in features.GENE) + f" from cells c left join found f using (gene_id, line, {M}) left join found r on r.gene_id = c.gene_id and r.{M} = c.{M} and r.line = '{REF}' where c.line <> '{REF}'"), _GENE_CTES))
def gene_differences(spark, sf_dir):
    return features.gene_differences(features.gene_features(consolidated(spark, sf_dir)), REF)


def _dense(spark, sf_dir, table=None):
    s = table or consolidated(spark, sf_dir)
    p = features.presence(s)
    keys = sites.persist_table(p, "presence")
    return features.densify(keys, keys.select("gene_id").distinct(), keys, keys)


@query(o.over_sites(f"select g.gene_id, l.line, m.{M}, coalesce(p.present, 0) as present, coalesce(p.count, 0) as count from (select distinct gene_id from sites) g, (select distinct line from sites) l, (select distinct {M} from sites) m left join (select {o.K}, 1 as present, count(*) as count from sites group by 1, 2, 3) p on p.gene_id = g.gene_id and p.line = l.line and p.{M} = m.{M}"))
def dense_presence(spark, sf_dir):
    return _dense(spark, sf_dir)


@query(o.over_sites(f"select * from (pivot (select {o.K}, 1 as present, count(*) as count from sites group by 1, 2, 3) on {M} using coalesce(max(present), 0) as present, coalesce(max(count), 0) as count group by gene_id, line)"))
def feature_matrix_wide(spark, sf_dir):
    """A column for every motif there is."""
    return features.matrix(sites.persist_table(features.presence(consolidated(spark, sf_dir)), "presence"), ["present", "count"])


@query(o.over_sites(f"select {M}, count(*) as n_pairs from (select distinct {o.K} from sites) t group by 1 having count(*) >= 10"))
def gene_line_support(spark, sf_dir):
    return features.gene_line_support(consolidated(spark, sf_dir))


_REL = "gene_id line consolidated_motif_id presence_diff count_diff position_mean_diff:d proximal_density_diff:d sequence_diversity_diff:d gc_content_diff:d"


@query(o.over_sites(o.select(_REL, "select * from relative"), o.INPUTS, o.RELATIVE))
def relative_features(spark, sf_dir):
    return features.relative_features(features.relative_inputs(consolidated(spark, sf_dir)), REF, OTHERS)


@query(o.over_sites(o.select(f"{M} presence_variance:d", "select * from pvar"), o.PVAR))
def presence_variance(spark, sf_dir):
    return features.presence_variance(consolidated(spark, sf_dir), REF)


@query(o.over_sites(o.select(_REL, f"select * from relative where {M} in (select {M} from pvar order by round(presence_variance, 9) desc, {M} limit 100)"), o.INPUTS, o.RELATIVE, o.PVAR))
def relative_selected(spark, sf_dir):
    """Relative features of the motifs whose presence varies most between lines."""
    table = sites.persist_table(consolidated(spark, sf_dir), "sites")
    rank = features.presence_variance(table, REF).withColumn("presence_variance", F.round("presence_variance", 9))
    chosen = features.top_by(rank, "presence_variance", 100).select(M)
    return features.relative_features(features.relative_inputs(table.join(chosen, M, "left_semi")), REF, OTHERS)


@query(o.over_sites(o.select(f"{M} " + " ".join(views.LINES) + " line_variance:d", f"select *, (sq - t * t / 5) / 4 as line_variance from (select {M}, " + ", ".join(f"count(*) filter (line = '{x}') as {x}" for x in views.LINES) + ", cast(count(*) as double) as t, " + " + ".join(f"cast(power(count(*) filter (line = '{x}'), 2) as double)" for x in views.LINES) + f" as sq from sites group by {M}) z")))
def line_counts(spark, sf_dir):
    return features.line_counts(consolidated(spark, sf_dir), views.LINES)


@query(o.over_sites(o.select("mean:d median:d least most", f"select avg(n) as mean, quantile_cont(n, 0.5) as median, min(n) as least, max(n) as most from (select gene_id, count(distinct {M}) as n from sites group by 1) t")))
def motifs_per_gene(spark, sf_dir):
    return features.motifs_per_gene(consolidated(spark, sf_dir))


_LONG = "vals as (select gene_id, line, concat_ws('_', consolidated_motif_id, f) as feature, v as value from (select gene_id, line, consolidated_motif_id, unnest(['presence_diff', 'count_diff', 'position_mean_diff']) as f, unnest([cast(presence_diff as double), cast(count_diff as double), position_mean_diff]) as v from relative) z)"
_LONG_COLUMNS = ["presence_diff", "count_diff", "position_mean_diff"]


def _values(spark, sf_dir):
    rel = features.relative_features(features.relative_inputs(consolidated(spark, sf_dir)), REF, OTHERS)
    return features.long_values(rel, _LONG_COLUMNS)


@query(o.over_sites("select feature, count(*) filter (value <> 0) as nonzero from vals group by 1", o.INPUTS, o.RELATIVE, _LONG))
def nonzero_counts(spark, sf_dir):
    return features.nonzero_counts(_values(spark, sf_dir))


@query(o.over_sites(o.select("feature variance:d", "select feature, var_samp(value) as variance from vals group by 1 having var_samp(value) is null or round(var_samp(value), 9) <> 0"), o.INPUTS, o.RELATIVE, _LONG))
def varying_features(spark, sf_dir):
    return features.varying(_values(spark, sf_dir)).where(F.col("variance").isNull() | (F.round("variance", 9) != 0))


@query(o.over_sites(o.select("feature correlation:d", "select feature, abs(corr(value, expression)) as correlation from vals join expression using (gene_id, line) where expression is not null group by 1 having corr(value, expression) is not null and not isnan(corr(value, expression))"), o.INPUTS, o.RELATIVE, _LONG, o.EXPRESSION))
def feature_correlation(spark, sf_dir):
    return features.correlations(_values(spark, sf_dir), views.expression_long(spark, sf_dir))


@query(o.over_sites(o.select("gene_id line feature value:d", "select gene_id, line, feature, value - avg(value) over (partition by gene_id, feature) as value from vals"), o.INPUTS, o.RELATIVE, _LONG))
def within_gene_centering(spark, sf_dir):
    return features.centred(_values(spark, sf_dir))


# ---- expression ----


@query(o.with_(o.EXPRESSION, o.select("gene_id line expression:d", "select * from expression")))
def expression_long(spark, sf_dir):
    return views.expression_long(spark, sf_dir)


@query(o.with_(o.EXPRESSION, o.select("gene_id " + " ".join(f"{x}:d" for x in views.LINES), "select gene_id, " + ", ".join(f"max(expression) filter (line = '{x}') as {x}" for x in views.LINES) + " from expression group by 1")))
def expression_wide(spark, sf_dir):
    return expression.to_wide(views.expression_long(spark, sf_dir), list(views.LINES))


@query(o.with_(o.EXPRESSION, o.select("gene_id line expression:d", "select g.gene_id, l.line, e.expression from (select distinct gene_id from expression) g, (select unnest(['" + "', '".join(views.LINES) + "']) as line) l left join expression e on e.gene_id = g.gene_id and e.line = l.line")))
def expression_wide_to_long(spark, sf_dir):
    return expression.to_long(expression.to_wide(views.expression_long(spark, sf_dir), list(views.LINES)), list(views.LINES))


@query(o.with_(o.EXPRESSION, o.select("gene_id line expression_difference:d", f"select a.gene_id, a.line, a.expression - b.expression as expression_difference from expression a join expression b on a.gene_id = b.gene_id and b.line = '{REF}' where a.line <> '{REF}'")))
def expression_difference(spark, sf_dir):
    return expression.difference(views.expression_long(spark, sf_dir), REF)


@query(o.with_(o.EXPRESSION, o.select("n least:d most:d mean:d std_population:d std_sample:d zero_share:d", "select count(expression) as n, min(expression) as least, max(expression) as most, avg(expression) as mean, stddev_pop(expression) as std_population, stddev_samp(expression) as std_sample, cast(count(*) filter (expression = 0) as double) / count(expression) as zero_share from expression")))
def expression_profile(spark, sf_dir):
    return expression.profile(views.expression_long(spark, sf_dir))


@query(o.with_(o.EXPRESSION, f"select coalesce(max(abs(expression)) <= 1e-6, true) as reference_is_zero from expression where line = '{REF}'"))
def reference_check(spark, sf_dir):
    return expression.reference_is_zero(expression.to_wide(views.expression_long(spark, sf_dir), list(views.LINES)), REF)


@query(o.over_sites(o.select(f"gene_id line {M} present count expression:d", f"select p.*, e.expression from (select {o.K}, 1 as present, count(*) as count from sites group by 1, 2, 3) p join expression e on e.gene_id = p.gene_id and e.line = p.line"), o.EXPRESSION))
def features_with_expression(spark, sf_dir):
    return expression.attach(features.presence(consolidated(spark, sf_dir)), views.expression_long(spark, sf_dir))


@query(o.over_sites(o.select(f"gene_id line {M} present count expression:d", f"select p.*, e.expression from (select {o.K}, 1 as present, count(*) as count from sites group by 1, 2, 3) p left join (select * from expression where line <> '{REF}') e on e.gene_id = p.gene_id and e.line = p.line"), o.EXPRESSION))
def features_expression_lookup(spark, sf_dir):
    long = expression.without_reference(views.expression_long(spark, sf_dir), REF)
    return expression.attach(features.presence(consolidated(spark, sf_dir)), long, "left")


# ---- strings and catalogs ----

_INST = "inst as (select concat_ws('_', gene_id, line) as unit, pattern as consensus, start_pos as position, cast(length(pattern) as int) as width, strand, src_ord from raw)"


def _instances(spark, sf_dir):
    return raw(spark, sf_dir).select(F.concat_ws("_", "gene_id", "line").alias("unit"), F.col("pattern").alias("consensus"), F.col("start_pos").alias("position"), F.length("pattern").alias("width"), "strand", "src_ord")


_BY = "order by position, consensus, strand, src_ord"
_STR = "case when strand = '-' then '[' || {} || ']' else {} end"


@query(o.with_(f"{o.RAW},{o.RECORDS}", "select line, string_agg(consensus, '|' order by ord) as encoded from records group by 1"))
def regulatory_string(spark, sf_dir):
    return encode.consensus_list(records(spark, sf_dir))


@query(o.with_(f"{o.RAW},{_INST}", f"select unit, string_agg({_STR.format('consensus', 'consensus')}, 'NNN' {_BY}) as encoded from inst group by 1"))
def consensus_string(spark, sf_dir):
    return encode.consensus_string(_instances(spark, sf_dir), "unit")


@query(o.with_(f"{o.RAW},{_INST}", f"select unit, string_agg(format('P{{:03d}}', cast(trunc(cast(position - lo as double) / case when hi > lo then hi - lo else 1 end * 1000) as int)) || {_STR.format('consensus', 'consensus')}, 'NN' {_BY}) as encoded from (select *, min(position) over (partition by unit) as lo, max(position) over (partition by unit) as hi from inst) t group by 1"))
def positional_string(spark, sf_dir):
    return encode.positional_string(_instances(spark, sf_dir), "unit")


@query(o.with_(f"{o.RAW},{_INST}", f"select unit, string_agg(case when gap is null then '' else repeat('N', greatest(0, least(50, gap))) end || consensus, '' {_BY}) as encoded from (select *, position - lag(position + width) over (partition by unit {_BY}) as gap from inst) t group by 1"))
def spaced_string(spark, sf_dir):
    return encode.spaced_string(_instances(spark, sf_dir), "unit")


_VOCAB = "vocab as (select consensus, count(*) as frequency, min(evalue) as best_evalue, string_agg(distinct line, ',' order by line) as lines, format('M{:03d}', row_number() over (order by consensus)) as code from records group by 1)"


@query(o.with_(f"{o.RAW},{o.RECORDS},{_VOCAB}", o.select("consensus frequency best_evalue:d lines code", "select * from vocab")))
def vocabulary(spark, sf_dir):
    return encode.vocabulary(records(spark, sf_dir))


@query(o.with_(f"{o.RAW},{o.RECORDS},{_VOCAB},{_INST}", f"select unit, string_agg({_STR.format('code', 'code')}, '_' {_BY}) as encoded from inst join vocab using (consensus) group by 1"))
def encoded_string(spark, sf_dir):
    return encode.encoded_string(_instances(spark, sf_dir), encode.vocabulary(records(spark, sf_dir)), "unit")


@query(o.with_(f"{o.RAW},{o.RECORDS}", "select * from (pivot (select line, consensus, 1 as one from records) on consensus using coalesce(max(one), 0) group by line)"))
def training_matrix(spark, sf_dir):
    return encode.training_matrix(sites.persist_table(records(spark, sf_dir), "records"))


_ACROSS = f"""rord as (select *, ord as k from records),
ladder as (select a.ord as i, b.ord as j, case when abs(a.width - b.width) > 3 then 0e0 when greatest(a.evalue, b.evalue) < 0.001e0 then 0.8e0 when greatest(a.evalue, b.evalue) < 0.01e0 then 0.6e0 when greatest(a.evalue, b.evalue) < 0.05e0 then 0.4e0 else 0.2e0 end as s from records a join records b on a.ord < b.ord and a.line <> b.line),
close_ as (select i, j from ladder where s >= 0.5e0), {o.leaders('close_', 'rord', 'grouped')},
catalog as (select line, motif_id, consensus, width, n_sites, evalue, ord, cast(cluster_no as int) as cluster_no, format('cluster_{{:d}}', cluster_no) as cluster_id from grouped)"""


def _catalog(spark, sf_dir):
    found = cluster.cluster_across_lines(sites.persist_table(records(spark, sf_dir), "records"))
    return found.select("line", "motif_id", "consensus", "width", "n_sites", "evalue", "ord", "cluster_no", "cluster_id")


@query(o.with_(f"{o.RAW},{o.RECORDS},{_ACROSS}", "select line, ord, cluster_id from catalog"))
def cluster_across_lines(spark, sf_dir):
    return _catalog(spark, sf_dir).select("line", "ord", "cluster_id")


@query(o.with_(f"{o.RAW},{o.RECORDS},vrec as (select consensus, row_number() over (order by consensus) as ord from (select distinct consensus from records) t), al as (select a.ord as i, b.ord as j, {_aligned_sql('a.consensus', 'b.consensus')} as s from vrec a join vrec b on a.ord < b.ord), close_ as (select i, j from al where s >= 0.8e0), {o.leaders('close_', 'vrec', 'grouped')}", "select consensus, format('cluster_{:03d}', cluster_no - 1) as cluster_id from grouped"))
def cluster_aligned(spark, sf_dir):
    words = encode.vocabulary(records(spark, sf_dir)).select("consensus", F.expr("cast(substr(code, 2) as int)").alias("ord"))
    return cluster.cluster_aligned(sites.persist_table(words, "words")).select("consensus", "cluster_id")


@query(o.with_(f"{o.RAW},{o.RECORDS},{_ACROSS}", "select cluster_id, count(distinct line) as n_lines, count(*) as occurrences, string_agg(distinct line, ',' order by line) as lines, cast(count(distinct line) > 1 as int) as is_common from catalog group by 1"))
def motif_catalog(spark, sf_dir):
    return encode.occurrences(_catalog(spark, sf_dir))


@query(o.with_(f"{o.RAW},{o.RECORDS},{_ACROSS}", "select cluster_id, cast(sum(n_sites) as bigint) as total_sites, list_reduce(list(width order by ord), lambda a, x: cast((a + x) // 2 as int)) as mean_width from catalog group by 1"))
def cluster_info(spark, sf_dir):
    return encode.cluster_info(_catalog(spark, sf_dir))


@query(o.with_(f"{o.RAW},{o.RECORDS}", "select line, motif_id, consensus, cast(row_number() over (partition by line order by evalue nulls last, ord) - 1 as int) as place from records"))
def rank_by_evalue(spark, sf_dir):
    return encode.rank_by_evalue(records(spark, sf_dir)).select("line", "motif_id", "consensus", "place")


_RANKED = "ranked as (select c.*, row_number() over (partition by line order by evalue nulls last, ord) as place, cast(count(*) over (partition by cluster_id) > 0 as int) as one from catalog c), common_ as (select cluster_id, cast(count(distinct line) > 1 as int) as is_common from catalog group by 1)"


@query(o.with_(f"{o.RAW},{o.RECORDS},{_ACROSS},{_RANKED}", "select line, string_agg(consensus || ':' || cluster_id || ':' || is_common, ',' order by place) as motifs, count(*) as motif_count, cast(sum(is_common) as bigint) as common_count, cast(sum(1 - is_common) as bigint) as unique_count from ranked join common_ using (cluster_id) group by 1"))
def regulatory_map(spark, sf_dir):
    found = sites.persist_table(_catalog(spark, sf_dir), "catalog")
    common = encode.occurrences(found).select("cluster_id", "is_common")
    maps = encode.regulatory_map(found.join(common, "cluster_id"))
    shown = F.array_join(F.transform("motifs", lambda m: F.concat_ws(":", m["consensus"], m["cluster_id"], m["is_common"].cast("string"))), ",")
    return maps.select("line", shown.alias("motifs"), "motif_count", "common_count", "unique_count")


_SIG = "case when evalue < 0.001e0 then 'H' when evalue < 0.01e0 then 'M' "


@query(o.with_(f"{o.RAW},{o.RECORDS},{_ACROSS},{_RANKED}", f"select line, string_agg(format('M{{:02d}}', cluster_no), '-' order by place) as cluster_string, string_agg({_SIG} when evalue < 0.05e0 then 'L' else 'N' end, '' order by place) as significance_string, string_agg(format('M{{:02d}}', cluster_no) || {_SIG} else 'L' end, '_' order by place) as combined_string from ranked group by 1"))
def cluster_strings(spark, sf_dir):
    return encode.cluster_strings(_catalog(spark, sf_dir))


@query(o.with_(f"{o.RAW},{o.RECORDS},{_ACROSS}", "select r.line, r.motif_id, r.consensus, c.cluster_id from records r left join (select motif_id, consensus, first(cluster_id order by cluster_no) as cluster_id from catalog group by 1, 2) c using (motif_id, consensus)"))
def first_cluster(spark, sf_dir):
    found = sites.persist_table(_catalog(spark, sf_dir), "catalog")
    return encode.assign_first_cluster(found.drop("cluster_id", "cluster_no"), found).select("line", "motif_id", "consensus", "cluster_id")


@query(o.with_(f"numbered as (select doc_id, coalesce(text, '') as text, row_number() over (order by doc_id) - 1 as n from documents), pairs as (select n // 2 as k, max(case when n % 2 = 0 then doc_id end) as a, max(case when n % 2 = 1 then doc_id end) as b, max(case when n % 2 = 0 then text end) as ta, max(case when n % 2 = 1 then text end) as tb from numbered group by 1)", o.select("pair_no first_id second_id kind gc_first:d gc_second:d length_first length_second", f"select k + 1 as pair_no, a as first_id, b as second_id, case when b is null then 'single_remaining' when abs({o.gc('ta')} - {o.gc('tb')}) < 0.2e0 and cast(least(length(ta), length(tb)) as double) / greatest(length(ta), length(tb)) > 0.8e0 then 'similar_pair' else 'dissimilar_pair' end as kind, {o.gc('ta')} as gc_first, {o.gc('tb')} as gc_second, cast(length(ta) as int) as length_first, cast(length(tb) as int) as length_second from pairs")))
def adjacent_pairs(spark, sf_dir):
    """A missing text is an empty one here."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("text", F.coalesce("text", F.lit("")))
    return encode.adjacent_pairs(docs, "doc_id", "doc_id", "text")


@query("select row_number() over (order by a) as pair_no, a as first_id, b as second_id, case when b is not null and kind then 'M1' else 'orphan' end as motif_group from (select a, b, abs(" + o.gc("ta") + " - " + o.gc("tb") + ") < 0.2e0 and cast(least(length(ta), length(tb)) as double) / greatest(length(ta), length(tb)) > 0.8e0 as kind from (select max(case when n % 2 = 0 then doc_id end) as a, max(case when n % 2 = 1 then doc_id end) as b, max(case when n % 2 = 0 then text end) as ta, max(case when n % 2 = 1 then text end) as tb from (select doc_id, text, row_number() over (order by doc_id) - 1 as n from documents) x group by n // 2) y) z")
def pair_groups(spark, sf_dir):
    pairs = encode.adjacent_pairs(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "doc_id", "text")
    return encode.pair_groups(pairs, ["M1", "M2"])


@query(o.with_(f"{o.RAW},{o.RECORDS},lp as (select line, row_number() over (order by line) - 1 as k from (select distinct line from records) t), mp as (select r.*, cast(k // 2 + 1 as int) as pair_no, k % 2 as side from records r join lp using (line))", "select a.pair_no, a.line as line_1, a.motif_id as motif_1, b.line as line_2, b.motif_id as motif_2 from mp a join mp b on a.pair_no = b.pair_no and a.side = 0 and b.side = 1 and abs(a.width - b.width) <= 2 and abs(a.evalue - b.evalue) / greatest(a.evalue, b.evalue, 1e-10) < 0.5e0"))
def similar_line_pairs(spark, sf_dir):
    return encode.similar_line_pairs(sites.persist_table(records(spark, sf_dir), "records"))


@query(o.with_(f"{o.RAW},{o.RECORDS}", "select line, count(*) as n_motifs, cast(dense_rank() over (order by line) + 1 as bigint) // 2 as pair_no from records group by line"))
def motifs_per_line(spark, sf_dir):
    """Motif counts of each run, and the pair that the run belongs to."""
    from pyspark.sql import Window

    n = records(spark, sf_dir).groupBy("line").agg(F.count("*").alias("n_motifs"))
    return n.withColumn("pair_no", F.floor((F.row_number().over(Window.orderBy("line")) + 1) / 2))
