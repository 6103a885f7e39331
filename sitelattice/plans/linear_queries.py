"""Queries over linear fits whose numbers do not hang on a solver: fits with a fixed penalty,
and the spread that least squares explains. Their SQL adds up the same products, clears
the columns one by one in a recursive query and puts the solution together from the last."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitelattice.operators import expression, features, models, sites

from . import oracles as o
from .catalog import M, OTHERS, REF, consolidated, expression_table, query

TOP = 100
_FEATURES = (*features.DIFFERENCES, *features.IF_BOTH)
#: scaling, model, penalty.
PENALISED = (("raw", "ridge_1", 1.0), ("raw", "ridge_10", 10.0), ("standardised", "ridge_1", 1.0), ("standardised", "ridge_10", 10.0))
WITHIN = 15


def _design(spark, sf_dir):
    """Relative design table over the motifs whose presence varies most, with both kinds of folds."""
    table = consolidated(spark, sf_dir)
    rank = features.presence_variance(table, REF).withColumn("presence_variance", F.round("presence_variance", 9))
    motifs = features.top_by(rank, "presence_variance", TOP).select(M)
    rel = features.relative_features(features.relative_inputs(table.join(motifs, M, "left_semi")), REF, OTHERS)
    values = sites.persist_table(features.long_values(rel, list(_FEATURES)), "values")
    steady = features.varying(values).where(F.col("variance").isNull() | (F.round("variance", 9) != 0))
    names = sorted(r[0] for r in steady.select("feature").collect())  # at most six a motif of ``TOP``
    target = expression.without_reference(expression_table(spark, sf_dir), REF)
    return sites.persist_table(models.group_folds(models.design(values, target, names)), "design"), names


def _eliminated(columns: str) -> str:
    """CTEs from ``systems`` (key, i, d, row: the symmetric matrix from its diagonal on, then
    the right side) to ``fits`` (key, b). A column that earlier ones make up gets 0."""
    return f"""
elim(key, s, i, d, row) as (
  select key, 1, i, d, row from systems
  union all
  select key, s + 1, i, d, case when f is null then row else list_transform(list_zip(row, above), lambda x: x[1] - x[2] * f) end
  from (select e.*, p.row[e.i - e.s + 1:] as above, case when p.row[1] > 1e-9 * p.d then p.row[e.i - e.s + 1] / p.row[1] end as f
        from elim e join elim p on p.key = e.key and p.i = e.s where e.i > e.s) q),
pivots as materialized (select key, s, d, row from elim where i = s),
back(key, s, b) as (
  select distinct key, {columns} + 1, cast([] as double[]) from systems
  union all
  select b.key, b.s - 1, list_prepend(case when p.row[1] <= 1e-9 * p.d then 0e0 else (p.row[len(p.row)] - coalesce(list_sum(list_transform(list_zip(p.row[2:len(p.row) - 1], b.b), lambda x: x[1] * x[2])), 0e0)) / p.row[1] end, b.b)
  from back b join pivots p on p.key = b.key and p.s = b.s - 1),
fits as materialized (select key, b from back where s = 1)"""


_VALUES = f"""
chosen as (select {M} from pvar order by round(presence_variance, 9) desc, {M} limit {TOP}),
vals as materialized (select gene_id, line, concat_ws('_', {M}, f) as feature, v as value from (select gene_id, line, {M}, unnest({list(_FEATURES)!r}) as f,
  unnest([{', '.join(f'cast({c} as double)' for c in _FEATURES)}]) as v from relative semi join chosen using ({M})) z),
feats as materialized (select feature, row_number() over (order by feature) as i from vals group by 1 having var_samp(value) is null or round(var_samp(value), 9) <> 0),
k as (select count(*) as k from feats),
wanted as (select gene_id, line, expression as y from expression where line <> '{REF}' and expression is not null),
dealt as (select gene_id, (row_number() over (order by count(*) desc, gene_id) - 1) % {models.FOLDS} as fold from wanted group by 1),
rows_ as materialized (select gene_id, line, y, fold as gene_fold, cast(concat('0x', substr(md5(concat_ws('|', gene_id, line, '42')), 1, 8)) as bigint) % {models.FOLDS} as row_fold from wanted join dealt using (gene_id)),
filled as materialized (select r.*, i, value as v from rows_ r join vals using (gene_id, line) join feats using (feature) where value <> 0)"""


def _penalised(folds: str, kinds) -> str:
    """CTEs down to ``held``: R2 and error of every fit on the rows left out of it, or on all."""
    keys = ", ".join(f"('{scaling}', '{name}', {alpha}e0)" for scaling, name, alpha in kinds)
    return f"""{_VALUES},
parts(strategy, fold) as ({folds}),
placed_rows as (select 'genes' as strategy, gene_fold as fold, gene_id, line, y from rows_ union all select 'rows', row_fold, gene_id, line, y from rows_),
columns_ as (select strategy, fold, gene_id, line, i, v from placed_rows join (select gene_id, line, i, v from filled) c using (gene_id, line)
             union all select strategy, fold, gene_id, line, 0, 1e0 from placed_rows union all select strategy, fold, gene_id, line, k + 1, y from placed_rows, k),
products_ as materialized (select a.strategy, a.fold, a.i, b.i as j, sum(a.v * b.v) as p from columns_ a join columns_ b using (strategy, fold, gene_id, line) where a.i <= b.i group by all),
summed as materialized (select q.strategy, q.fold, i, j, sum(p) as p from parts q join products_ x on x.strategy = q.strategy and x.fold <> q.fold group by all),
sizes as materialized (select strategy, fold, p as n from summed where i = 0 and j = 0),
means as materialized (select z.strategy, z.fold, g.i, coalesce(s.p, 0) / n as mean from sizes z cross join (select unnest(range(1, k + 2)) as i from k) g left join summed s on s.strategy = z.strategy and s.fold = z.fold and s.i = 0 and s.j = g.i),
about as materialized (select a.strategy, a.fold, a.i, b.i as j, coalesce(s.p, 0) - n * a.mean * b.mean as c
          from means a join means b on a.strategy = b.strategy and a.fold = b.fold and a.i <= b.i join sizes z on z.strategy = a.strategy and z.fold = a.fold
          left join summed s on s.strategy = a.strategy and s.fold = a.fold and s.i = a.i and s.j = b.i),
kinds(scaling, model, alpha) as (values {keys}),
scales as materialized (select strategy, fold, scaling, i, case when scaling = 'raw' or i = k + 1 or sqrt(greatest(c, 0) / n) < 1e-12 then 1e0 else sqrt(c / n) end as sd
           from about join sizes using (strategy, fold), k, (select distinct scaling from kinds) where i = j),
systems as materialized (select struct_pack(strategy := a.strategy, fold := a.fold, scaling := x.scaling, model := x.model) as key, a.i,
              max(c / (u.sd * w.sd)) filter (a.i = a.j) as d, list(c / (u.sd * w.sd) + case when a.i = a.j then alpha else 0 end order by a.j) as row
            from about a cross join kinds x join scales u on u.strategy = a.strategy and u.fold = a.fold and u.scaling = x.scaling and u.i = a.i
            join scales w on w.strategy = a.strategy and w.fold = a.fold and w.scaling = x.scaling and w.i = a.j where a.i <= (select k from k) group by 1, 2),
{_eliminated('(select k from k)')},
scaled as (select key, unnest(range(1, len(b) + 1)) as i, unnest(b) as b from fits),
coefficients as materialized (select key, s.i, b / sd as b from scaled s join scales u on u.strategy = key.strategy and u.fold = key.fold and u.scaling = key.scaling and u.i = s.i),
intercepts as materialized (select c.key, any_value(y.mean) - sum(m.mean * b) as b from coefficients c join means m on m.strategy = c.key.strategy and m.fold = c.key.fold and m.i = c.i
               join means y on y.strategy = c.key.strategy and y.fold = c.key.fold and y.i = (select k + 1 from k) group by 1),
tested as (select t.key, r.gene_id, r.line, any_value(r.y) as y, any_value(t.b) + coalesce(sum(c.v * f.b), 0) as fitted
           from intercepts t join placed_rows r on r.strategy = t.key.strategy and (r.fold = t.key.fold or t.key.fold = -1)
           left join filled c on c.gene_id = r.gene_id and c.line = r.line left join coefficients f on f.key = t.key and f.i = c.i group by 1, 2, 3),
held as (select key.strategy as cv_strategy, key.fold as fold, key.scaling as scaling, key.model as model, count(*) as n_rows,
           case when var_pop(y) * count(*) > 1e-12 then 1 - sum((y - fitted) * (y - fitted)) / (var_pop(y) * count(*)) else cast('nan' as double) end as r2,
           sqrt(avg((y - fitted) * (y - fitted))) as rmse from tested group by 1, 2, 3, 4)"""


_BASE = (o.INPUTS, o.RELATIVE, o.PVAR, o.EXPRESSION)
_ALL_ROWS = "values ('genes', -1)"
_EACH_FOLD = "select distinct strategy, fold from (select 'genes' as strategy, gene_fold as fold from rows_ union all select 'rows', row_fold from rows_) z"
_EVERY = (("raw", "ols", 0.0), *PENALISED)


@query(o.over_sites(o.select("scaling model n_rows n_features r2:d rmse:d", "select scaling, model, n_rows, k as n_features, r2, rmse from held, k"), *_BASE, _penalised(_ALL_ROWS, _EVERY)))
def fixed_penalty_fits(spark, sf_dir):
    """Spread explained by least squares and by ridges of fixed penalty, over all rows."""
    data, names = _design(spark, sf_dir)
    p = models.gather(data, names).total()
    rows = [(scaling, name, int(p[0, 0]), len(names), *models.score(p, models.penalised(p, alpha, scaling))) for scaling, name, alpha in _EVERY]
    return spark.createDataFrame(rows, "scaling string, model string, n_rows long, n_features long, r2 double, rmse double")


@query(o.over_sites(o.select("feature coefficient:d", "select feature, b as coefficient from coefficients join feats using (i)"), *_BASE, _penalised(_ALL_ROWS, PENALISED[2:3])))
def ridge_coefficients(spark, sf_dir):
    """Coefficients, in the raw scale, of a ridge of penalty 1 on standardised features."""
    data, names = _design(spark, sf_dir)
    beta = models.penalised(models.gather(data, names).total(), 1.0, "standardised")
    return spark.createDataFrame([(f, float(b)) for f, b in zip(names, beta[1:], strict=True)], "feature string, coefficient double")


@query(o.over_sites(o.select("cv_strategy fold scaling model n_rows r2:d rmse:d", "select * from held"), *_BASE, _penalised(_EACH_FOLD, PENALISED)))
def penalised_folds(spark, sf_dir):
    """The penalised part of the diagnostic grid, fold by fold: fits on the other folds, by
    rows and by genes, scored on the one left out."""
    data, names = _design(spark, sf_dir)
    found = []
    for strategy, sums in (("rows", models.gather(models.row_folds(data.drop("fold")), names)), ("genes", models.gather(data, names))):
        for fold, test in sums.products.items():
            rest = sums.total(without=fold)
            for scaling, name, alpha in PENALISED if len(sums.products) > 1 else ():
                found.append((strategy, fold, scaling, name, int(test[0, 0]), *models.score(test, models.penalised(rest, alpha, scaling))))
    return spark.createDataFrame(found, "cv_strategy string, fold long, scaling string, model string, n_rows long, r2 double, rmse double")


_WITHIN = f"""{_VALUES},
later as (select line, row_number() over (order by line) as n from (select distinct line from rows_) z qualify n > 1),
spots as (select feature, i from feats where i <= {WITHIN}), width as (select (select count(*) from spots) + (select count(*) from later) as k),
wide_cells as (select gene_id, line, f.i, coalesce(value, 0e0) as v from rows_ cross join spots f left join vals using (gene_id, line, feature)
               union all select r.gene_id, r.line, (select count(*) from spots) + l.n - 1, cast(r.line = l.line as double) from rows_ r, later l
               union all select gene_id, line, k + 1, y from rows_, width),
swept as materialized (select gene_id, line, i, v - avg(v) over (partition by gene_id, i) as v from wide_cells),
crossed as materialized (select a.i, b.i as j, sum(a.v * b.v) as c from swept a join swept b using (gene_id, line) where a.i <= b.i group by 1, 2),
systems as materialized (select 1 as key, i, max(c) filter (i = j) as d, list(c order by j) as row from crossed where i <= (select k from width) group by 1, 2),
{_eliminated('(select k from width)')},
explained as (select sum(b.b * c) as c from (select unnest(range(1, len(b) + 1)) as i, unnest(b) as b from fits) b join crossed on crossed.i = b.i and j = (select k + 1 from width)),
left_over as (select c.c - coalesce(explained.c, 0) as rss from crossed c, explained where i = j and i = (select k + 1 from width))"""


@query(o.over_sites(o.select("n_obs n_genes n_lines r2:d", "select count(*) as n_obs, count(distinct gene_id) as n_genes, count(distinct line) as n_lines, 1 - any_value(rss) / (count(*) * var_pop(y)) as r2 from rows_, left_over"), *_BASE, _WITHIN))
def within_gene_fit(spark, sf_dir):
    """What the within-gene model explains: features and lines, with all genes' levels swept out."""
    data, names = _design(spark, sf_dir)
    found = models.within_gene(data, names, WITHIN)[1]
    return spark.createDataFrame([(found["n_obs"], found["n_genes"], found["n_lines"], float(found["r2"]))], "n_obs long, n_genes long, n_lines long, r2 double")
