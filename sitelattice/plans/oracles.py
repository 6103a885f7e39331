"""DuckDB texts of the queries, from shared common table expressions."""

from __future__ import annotations

from sitelattice.functions.seq import LETTERS, MASKS
from sitelattice.operators.consensus import CALLS

from . import views

REF = views.REFERENCE_LINE
_D = "cast({} as double)"


def masks(s: str) -> str:
    codes = ", ".join(str(m) for m in MASKS.values())
    return f"list_transform(string_split(upper({s}), ''), lambda c: case when strpos('{LETTERS}', c) > 0 then [{codes}][strpos('{LETTERS}', c)] else ascii(c) * 16 end)"


def meets(a: str, b: str) -> str:
    return f"({a} = {b} or ({a} < 16 and {b} < 16 and {a} & {b} <> 0))"


def matches(a: str, b: str, n: str, shift: int = 0) -> str:
    """Places below ``n`` where the masks meet, b shifted."""
    return f"len(list_filter(range(1, {n} + 1), lambda i: i + {shift} >= 1 and i + {shift} <= len({b}) and {meets(f'{a}[i]', f'{b}[i + {shift}]')}))"


def similarity(a: str, b: str, ma: str, mb: str) -> str:
    n = f"least(length({a}), length({b}))"
    return f"case when {n} = 0 then 0e0 else greatest(0e0, cast({matches(ma, mb, n)} as double) / {n} - abs(length({a}) - length({b})) * 0.2e0) end"


def gc(s: str) -> str:
    return f"case when length({s}) = 0 then 0e0 else cast(length(regexp_replace(upper({s}), '[^GC]', '', 'g')) as double) / length({s}) end"


def fraction(s: str, b: str) -> str:
    return f"case when length({s}) = 0 then 0e0 else cast(length({s}) - length(replace({s}, '{b}', '')) as double) / length({s}) end"


def plain(c: str) -> str:
    return f"{c} in ('A','C','G','T')"


def mutation(s: str, c: str) -> str:
    off = f"len(list_filter(range(1, length({s}) + 1), lambda i: upper({s})[i] <> upper({c})[i] and {plain(f'upper({s})[i]')} and {plain(f'upper({c})[i]')}))"
    return f"case when length({s}) = length({c}) and length({s}) > 0 then cast({off} as double) / length({s}) end"


def positional(s: str, c: str) -> str:
    x, y = f"upper({s})[i]", f"upper({c})[i]"
    each = f"case when {x} = {y} or {x} = 'N' or {y} = 'N' then 1e0 when not {plain(x)} or not {plain(y)} then 0.5e0 else 0e0 end"
    return f"case when length({s}) = length({c}) and length({s}) > 0 then list_sum(list_transform(range(1, length({s}) + 1), lambda i: {each})) / length({s}) else 0e0 end"


RAW = f"sites_raw as ({views.SITES_RAW}), raw as (select *, regexp_replace(original_motif_id, '^[^-]*-', '') as pattern from sites_raw)"

_calls = " ".join(f"when {' + '.join(f'cast({b} as double) / n' for b in bases.split('+'))} >= 0.8e0 then '{letter}'" for letter, bases in CALLS)
CONSENSUS = f"""
seqs as (select pattern, sequence, count(*) as n, min(src_ord) as first_ord from raw group by 1, 2),
lens as (select pattern, length(sequence) as len, sum(n) as n, min(first_ord) as first_ord from seqs group by 1, 2),
modal as (select pattern, cast(sum(n) as bigint) as n_sites, min(first_ord) as first_ord, first(len order by n desc, len) as len from lens group by 1),
bases as (select pattern, p, sum(m) filter (b = 'A') as a, sum(m) filter (b = 'T') as t, sum(m) filter (b = 'G') as g, sum(m) filter (b = 'C') as c
          from (select s.pattern, s.n as m, p, upper(s.sequence)[p] as b from (select *, unnest(range(1, length(sequence) + 1)) as p from seqs) s join modal using (pattern) where length(s.sequence) = modal.len) x group by 1, 2),
called as (select pattern, p, case when n = 0 then 'N' {_calls} else 'N' end as letter
           from (select pattern, p, coalesce(a, 0) as a, coalesce(t, 0) as t, coalesce(g, 0) as g, coalesce(c, 0) as c, coalesce(a, 0) + coalesce(t, 0) + coalesce(g, 0) + coalesce(c, 0) as n from bases) y),
consensus as (select modal.pattern, string_agg(letter, '' order by p) as true_consensus, any_value(n_sites) as n_sites, any_value(first_ord) as first_ord from modal left join called using (pattern) group by 1),
motifs as (select *, row_number() over (order by first_ord, pattern) as ord, {masks('true_consensus')} as m from consensus)"""

EDGES = f"""
edges as (select a.ord as i, b.ord as j, {similarity('a.true_consensus', 'b.true_consensus', 'a.m', 'b.m')} as similarity
          from motifs a join motifs b on a.ord < b.ord and abs(length(a.true_consensus) - length(b.true_consensus)) <= 3
            and length(a.true_consensus) >= 3 and length(b.true_consensus) >= 3),
near_ as (select * from edges where similarity >= 0.75e0)"""


def leaders(pairs: str, table: str, name: str = "placed_motifs") -> str:
    """CTEs that sweep ``table`` (ord) by ``pairs`` (i, j): ord, leader, cluster_no."""
    return f"""
earlier as (select j, list(i) as lead from {pairs} group by j),
sweep(k, chosen) as (
  select cast(0 as bigint), cast([] as bigint[])
  union all
  select k + 1, case when e.lead is not null and list_has_any(chosen, e.lead) then chosen else list_append(chosen, k + 1) end
  from sweep left join earlier e on e.j = sweep.k + 1 where k < (select max(ord) from {table})),
final as (select chosen from sweep where k = (select max(ord) from {table})),
{name} as (select m.*, least(m.ord, coalesce(e.i, m.ord)) as leader, dense_rank() over (order by least(m.ord, coalesce(e.i, m.ord))) as cluster_no
  from {table} m left join (select j, min(i) as i from {pairs}, final where list_contains(chosen, i) and not list_contains(chosen, j) group by j) e on e.j = m.ord)"""


CLUSTERS = f"""{leaders('near_', 'motifs')},
clusters as (select p.pattern, p.true_consensus, p.ord, p.leader, p.cluster_no, format('MOTIF_{{:03d}}', p.cluster_no) as consolidated_motif_id, h.true_consensus as motif_consensus,
               count(*) over (partition by p.leader) as cluster_size
             from placed_motifs p join motifs h on h.ord = p.leader)"""

SITES = """
placed as (select r.*, c.consolidated_motif_id, c.motif_consensus, c.cluster_size from raw r join clusters c using (pattern)),
folded as (
  select gene_id, line, strand, consolidated_motif_id, list_reduce(
    list([{'s': start_pos, 'e': end_pos, 'score': score, 'seq': sequence, 'n': 1, 'len': length(sequence), 'id': original_motif_id, 'pat': pattern, 'cons': motif_consensus, 'size': cluster_size, 'ord': src_ord}] order by start_pos, src_ord),
    lambda a, x: case when cast(greatest(0, least(a[-1].e, x[1].e) - greatest(a[-1].s, x[1].s) + 1) as double) / least(a[-1].e - a[-1].s + 1, x[1].e - x[1].s + 1) >= 0.5e0
      then list_concat(a[1:len(a) - 1], [{'s': least(a[-1].s, x[1].s), 'e': greatest(a[-1].e, x[1].e), 'score': greatest(a[-1].score, x[1].score),
             'seq': case when length(x[1].seq) > length(a[-1].seq) then x[1].seq else a[-1].seq end, 'n': a[-1].n + 1,
             'len': greatest(a[-1].e, x[1].e) - least(a[-1].s, x[1].s) + 1, 'id': a[-1].id, 'pat': a[-1].pat, 'cons': a[-1].cons, 'size': a[-1].size, 'ord': a[-1].ord}])
      else list_concat(a, x) end) as hits
  from placed group by 1, 2, 3, 4),
merged as (select gene_id, line, strand, consolidated_motif_id, h.s as start_pos, h.e as end_pos, h.score as score, h.seq as sequence, h.ord as src_ord, h.id as original_motif_id,
             h.pat as original_streme_consensus, h.cons as motif_consensus, h.size as cluster_size, h.n as merged_count, h.len as length
           from (select gene_id, line, strand, consolidated_motif_id, unnest(hits) as h from folded) t),
sites as (select *, row_number() over (partition by gene_id, line order by start_pos, original_motif_id, strand, end_pos, src_ord) as relative_position,
            count(*) over (partition by gene_id, line) as total_motifs_in_gene from merged)"""

EXPRESSION = f"expression as ({views.EXPRESSION_LONG})"
RECORDS = f"records as ({views.MOTIFS})"
ALL = ",".join((RAW, CONSENSUS, EDGES, CLUSTERS, SITES))


def with_(ctes: str, body: str) -> str:
    return f"with recursive {ctes}\n{body}"


def over_sites(body: str, *more: str) -> str:
    return with_(",".join((ALL, *more)), body)


def rounded(names: str) -> str:
    """``a b:d c:i`` -> columns, those marked :d rounded, :i as int."""
    shape = {"d": "round(cast({0} as double), 6) + 0e0 as {0}", "i": "cast({0} as int) as {0}", "": "{0}"}
    return ", ".join(shape[kind].format(name) for name, _, kind in (n.partition(":") for n in names.split()))


def select(names: str, body: str) -> str:
    return f"select {rounded(names)} from ({body}) q"


GAPS = "gaps as (select *, abs(start_pos) as p, abs(start_pos) - lag(abs(start_pos)) over (partition by gene_id, line, consolidated_motif_id order by abs(start_pos)) as gap from sites)"
K = "gene_id, line, consolidated_motif_id"
PROFILE = f"""
firsts as (select consolidated_motif_id, sequence, k from (select *, row_number() over (partition by consolidated_motif_id order by src_ord) as k from sites) t where k <= 50),
shares as (select consolidated_motif_id, {' + '.join(f"var_pop({fraction('sequence', b)})" for b in 'ATGC')} as composition_variance,
             string_agg(sequence, ',' order by k) filter (k <= 5) as samples from firsts group by 1),
profile as (select consolidated_motif_id, count(*) as n_sites, count(distinct sequence) as n_unique, cast(count(distinct sequence) as double) / count(*) as diversity,
              count(distinct original_streme_consensus) as n_patterns, min(length(sequence)) as min_length, max(length(sequence)) as max_length,
              any_value(composition_variance) as composition_variance, any_value(samples) as samples, min(motif_consensus) as motif_consensus
            from sites join shares using (consolidated_motif_id) group by 1),
flagged as (select consolidated_motif_id, n_sites, composition_variance, n_patterns, cast(diversity > 0.8e0 and n_sites > 20 as int) as high_diversity, cast(n_patterns > 3 as int) as many_patterns,
              cast(composition_variance > 0.3e0 as int) as mixed_composition, cast(max_length - min_length > 5 as int) as mixed_length from profile),
advised as (select *, greatest(high_diversity, many_patterns, mixed_composition, mixed_length) as suspicious,
              concat_ws(',', case when high_diversity = 1 then 'high_diversity' end, case when many_patterns = 1 then 'many_patterns' end,
                        case when mixed_composition = 1 then 'mixed_composition' end, case when mixed_length = 1 then 'mixed_length' end) as issues from flagged)"""
ADVICE = "case when suspicious = 0 then 'none' when composition_variance > 0.4e0 then 'split' when n_patterns > 5 then 'raise threshold' else 'review' end"

INPUTS = f"""
inputs as (select {K}, 1 as present, count(*) as count, avg(start_pos) as position_mean, stddev_pop(start_pos) as position_std, min(start_pos) as position_min, max(start_pos) as position_max,
  cast(count(*) filter (start_pos >= 700 and start_pos <= 1000) as double) / 3 as proximal_density, cast(count(*) filter (start_pos >= 0 and start_pos < 300) as double) / 3 as distal_density,
  cast(count(distinct sequence) as double) / count(*) as sequence_diversity, avg({gc('sequence')}) as gc_content_mean, stddev_pop({gc('sequence')}) as gc_content_std from sites group by 1, 2, 3)"""
RELATIVE = f"""
comp as (select * from inputs where line <> '{REF}'), ref as (select * from inputs where line = '{REF}'),
lines as (select distinct line from sites where line <> '{REF}'),
cells as (select distinct i.gene_id, l.line, i.consolidated_motif_id from inputs i, lines l),
relative as (select x.gene_id, x.line, x.consolidated_motif_id, coalesce(c.present, 0) - coalesce(r.present, 0) as presence_diff, coalesce(c.count, 0) - coalesce(r.count, 0) as count_diff,
  case when c.present = 1 and r.present = 1 then c.position_mean - r.position_mean else 0e0 end as position_mean_diff,
  case when c.present = 1 and r.present = 1 then c.proximal_density - r.proximal_density else 0e0 end as proximal_density_diff,
  case when c.present = 1 and r.present = 1 then c.sequence_diversity - r.sequence_diversity else 0e0 end as sequence_diversity_diff,
  case when c.present = 1 and r.present = 1 then c.gc_content_mean - r.gc_content_mean else 0e0 end as gc_content_diff
  from cells x left join comp c using (gene_id, line, consolidated_motif_id) left join ref r on r.gene_id = x.gene_id and r.consolidated_motif_id = x.consolidated_motif_id
  where c.present = 1 or r.present = 1)"""
PVAR = f"""
seen as (select distinct gene_id, line, consolidated_motif_id from sites where line <> '{REF}'),
ngenes as (select line, count(distinct gene_id) as g from seen group by 1),
grid as (select m.consolidated_motif_id, n.line, n.g from (select distinct consolidated_motif_id from seen) m, ngenes n),
pvar as (select consolidated_motif_id, var_pop(cast(coalesce(k, 0) as double) / g) as presence_variance
  from grid left join (select line, consolidated_motif_id, count(*) as k from seen group by 1, 2) t using (line, consolidated_motif_id) group by 1)"""

#: Ratios of shared blocks: a row a pair of rests, whose longest block is sought among all substrings.
_BLOCK = ("list_max(list_filter(flatten(list_transform(range(1, length(x) + 1), lambda i: list_transform(range(1, length(x) - i + 2), lambda k: {'n': k, 'i': -i}))), "
          "lambda c: contains(y, substr(x, -c.i, c.n))))")  # fmt: skip
RATIOS = f"""
matched as (select distinct sequence, motif_consensus, upper(sequence) as a, upper(motif_consensus) as b from sites where sequence <> '' and motif_consensus <> ''),
rests(a, b, x, y) as (
  select distinct a, b, a, b from matched
  union all
  select a, b, rest.x, rest.y from (
    select a, b, unnest([{{'x': substr(x, 1, i - 1), 'y': substr(y, 1, j - 1)}}, {{'x': substr(x, i + n), 'y': substr(y, j + n)}}]) as rest
    from (select *, strpos(y, substr(x, i, n)) as j from (select a, b, x, y, best.n as n, -best.i as i from (select *, {_BLOCK} as best from rests) q where best is not null) q) q) q
  where rest.x <> '' and rest.y <> ''),
ratios as (select sequence, motif_consensus, 2 * cast(coalesce(n, 0) as double) / (length(a) + length(b)) as ratio
           from matched left join (select a, b, sum(best.n) as n from (select *, {_BLOCK} as best from rests) q group by 1, 2) t using (a, b))"""

POSITION_LAYER = f"select {K}, cast(count(*) filter (start_pos >= 0 and start_pos < 500) as double) / 5 as proximal_density, cast(count(*) filter (start_pos >= 500 and start_pos < 1000) as double) / 5 as core_density, cast(count(*) filter (start_pos >= 1000 and start_pos < 2000) as double) / 10 as distal_density, sum(exp(-cast(start_pos as double) / 1000)) as position_weighted_score, 1 / (1 + case when count(*) > 1 and avg(gap) > 0 then stddev_pop(gap) / avg(gap) else 0e0 end) as spacing_regularity, min(start_pos) as closest_hit_distance, count(*) as total_hits from gaps group by 1, 2, 3"
VARIATION_LAYER = f"select {K}, avg({positional('sequence', 'motif_consensus')}) as consensus_similarity_mean, stddev_pop({positional('sequence', 'motif_consensus')}) as consensus_similarity_std, cast(count(distinct sequence) as double) / count(*) as sequence_diversity, avg({gc('sequence')}) as gc_content_mean, stddev_pop({gc('sequence')}) as gc_content_std, avg(length(sequence)) as length_mean, stddev_pop(length(sequence)) as length_std, count(distinct sequence) as unique_sequences from sites group by 1, 2, 3"
DOMINANT = f"cnt as (select {K}, sequence, count(*) as n from sites group by 1, 2, 3, 4), dom as (select {K}, first(sequence order by n desc, sequence) as dominant from cnt group by 1, 2, 3), whole as (select gene_id, consolidated_motif_id, cast(count(distinct sequence) as double) / count(*) as v from sites group by 1, 2), d2 as (select gene_id, consolidated_motif_id, count(*) as n, count(distinct dominant) as u from dom group by 1, 2)"
CROSSLINE_LAYER = f"select {K}, w.v as cross_line_diversity, case when d2.n > 1 then cast(d2.u as double) / d2.n else 0e0 end as dominant_sequence_diversity, cast(count(*) over (partition by gene_id, consolidated_motif_id, dominant) = 1 as int) as line_has_unique_variant from dom join whole w using (gene_id, consolidated_motif_id) join d2 using (gene_id, consolidated_motif_id)"

#: Rows of the regression design, presence counted over them, and the rank of its spread.
RANKED = f"""
design_rows as (select distinct gene_id, line from sites semi join (select * from expression where expression is not null) e using (gene_id, line)),
present_counts as (select consolidated_motif_id, count(*) as n_present from (select distinct {K} from sites) t semi join design_rows using (gene_id, line) group by 1),
ranked as (select consolidated_motif_id, n_present, (select count(*) from design_rows) as n_rows, n_present * ((select count(*) from design_rows) - n_present) as spread,
             row_number() over (order by n_present * ((select count(*) from design_rows) - n_present) desc, consolidated_motif_id) as place from present_counts)"""


def blocks(layers: dict[str, tuple[str, list[str]]], top: int) -> str:
    """CTE ``block``: the values that are not 0 of the columns of the first ``top`` motifs."""
    parts = [
        f"select gene_id, line, '{name}' as layer, concat_ws('_', consolidated_motif_id, f) as feature, v as value from (select {K}, unnest({columns!r}) as f, "
        f"unnest([{', '.join(f'cast({c} as double)' for c in columns)}]) as v from ({body}) made semi join (select * from ranked where place <= {top}) r using (consolidated_motif_id)) z where abs(v) > 1e-12"
        for name, (body, columns) in layers.items()
    ]
    return f"block as ({' union all '.join(parts)})"


def pairs(top: int) -> str:
    """CTE ``products``: the products of pairs of the first ``top`` motifs, in rank order."""
    return f"""
paired as (select gene_id, line, consolidated_motif_id, place, sum(exp(-cast(start_pos as double) / 1000)) as score from sites join ranked using (consolidated_motif_id) where place <= {top} group by all),
products as (select a.gene_id, a.line, a.consolidated_motif_id as motif_1, b.consolidated_motif_id as motif_2, 1 as presence_product, a.score as score_product
             from paired a join paired b on a.gene_id = b.gene_id and a.line = b.line and a.place < b.place)"""
