"""Regression of expression on motif features.

Linear models never see rows on the driver: one pass gathers the sums of products of
all features and the target for each fold (a table of size features squared), and every
fit, penalty and cross-validated score follows from those sums. Trees go through
``pyspark.ml``. Numbers differ from other implementations of the same trees in binning
and sampling; they are not meant to be bit-equal.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ALPHAS = (0.1, 1.0, 10.0, 100.0)
FOLDS = 5
#: Parts of the rows by which the lasso's penalty is chosen.
THIRDS = 3
#: Columns of a block of the product table, numbers of rows laid out at once, and numbers of
#: blocks that a task holds (64 MB).
BLOCK = 256
SLICE = 4_000_000
HELD = 8_000_000
#: Groups in which tasks' blocks meet first.
SIDES = 64


def design(values: DataFrame, target: DataFrame, features: list[str], label: str = "expression") -> DataFrame:
    """(gene_id, line, y, x): a dense vector a gene and line; missing features are 0.

    ``values`` is long (gene_id, line, feature, value); ``features`` names the columns.
    """
    k, keys = len(features), {f: i for i, f in enumerate(features)}
    rows = target.where(F.col(label).isNotNull()).select("gene_id", "line", F.col(label).cast("double").alias("y"))
    named = values.sparkSession.createDataFrame([(f, i) for f, i in keys.items()], "feature string, k int")
    # A row's features as places and values; a task lays a batch of them out at once.
    pairs = values.join(F.broadcast(named), "feature").groupBy("gene_id", "line").agg(F.collect_list(F.struct("k", F.coalesce("value", F.lit(0.0)).alias("value"))).alias("m"))
    cells = F.coalesce("m", F.array().cast("array<struct<k:int,value:double>>"))

    def laid(batches):
        for b in batches:
            held = b.column(3)
            row = np.repeat(np.arange(b.num_rows), held.value_lengths().to_numpy(zero_copy_only=False))
            flat, x = held.flatten(), np.zeros((b.num_rows, k))
            x[row, flat.field("k").to_numpy(zero_copy_only=False)] = flat.field("value").to_numpy(zero_copy_only=False)
            ends = pa.array(np.arange(b.num_rows + 1) * k, pa.int32())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], ["gene_id", "line", "y", "x"])

    # A batch is a dense table in a task: its rows are bounded by the session's batch size.
    return rows.join(pairs, ["gene_id", "line"], "left").select("gene_id", "line", "y", cells.alias("m")).mapInArrow(laid, "gene_id string, line string, y double, x array<double>")


def group_folds(data: DataFrame, folds: int = FOLDS, by: str = "gene_id") -> DataFrame:
    """``fold`` so that no group is split: groups by size are dealt round, which
    balances sizes (exactly, if they are equal)."""
    sizes = data.groupBy(by).agg(F.count("*").alias("n"))
    dealt = sizes.withColumn("fold", F.pmod(F.row_number().over(Window.orderBy(F.desc("n"), by)) - 1, F.lit(folds)).cast("int"))  # a row a group
    return data.join(dealt.select(by, "fold"), by)


def row_folds(data: DataFrame, folds: int = FOLDS, seed: int = 42) -> DataFrame:
    """``fold`` by a digest of the row's key, the same in every run and engine."""
    digest = F.conv(F.substring(F.md5(F.concat_ws("|", "gene_id", "line", F.lit(str(seed)))), 1, 8), 16, 10).cast("long")
    return data.withColumn("fold", (digest % folds).cast("int"))


# ---- sums of products ----


@dataclass
class Sums:
    """Of rows (1, x, y): products per fold and third of the rows (a hash of their key)."""

    parts: dict[tuple[int, int], np.ndarray]
    features: list[str]

    @property
    def products(self) -> dict[int, np.ndarray]:
        out: dict[int, np.ndarray] = {}
        for (fold, _), p in sorted(self.parts.items()):
            out[fold] = out.get(fold, 0) + p
        return out

    def total(self, without: int | None = None) -> np.ndarray:
        return sum(p for f, p in self.products.items() if f != without)

    def thirds(self, without: int | None = None) -> list[np.ndarray]:
        """Products of each third of the rows outside a fold."""
        held = [[p for (f, t), p in sorted(self.parts.items()) if f != without and t == third] for third in range(THIRDS)]
        return [sum(h) for h in held if h]


def gather(data: DataFrame, features: list[str]) -> Sums:
    """One pass over the rows, with the product table in blocks of ``BLOCK`` by ``BLOCK``
    columns. A task adds up the blocks on and over the diagonal for each fold and third,
    takes rows ``SLICE`` numbers at a time, and hands its blocks on whenever they come to
    ``HELD`` numbers, so its memory does not grow with the features or the rows. Blocks are
    shuffled by place and meet in two steps, first of every ``SIDES``-th task, then those.
    The driver, which solves for the coefficients, gets (features + 2) squared numbers a
    fold and third.
    """
    k = len(features) + 2
    edges = [(a, min(a + BLOCK, k)) for a in range(0, k, BLOCK)]
    keys = ["key", "a", "b"]

    def handed(held: dict[tuple[int, int, int], np.ndarray]) -> pd.DataFrame:
        return pd.DataFrame([(*at, p.astype("<f8").tobytes()) for at, p in held.items()], columns=[*keys, "p"]).astype({c: "int32" for c in keys})

    def run(batches):
        held: dict[tuple[int, int, int], np.ndarray] = {}
        size = 0
        for batch in batches:
            step = max(1, SLICE // k)
            for b in (batch.iloc[i : i + step] for i in range(0, len(batch), step)):
                rows = np.column_stack((np.ones(len(b)), np.stack(b["x"].to_numpy()) if k > 2 else np.empty((len(b), 0)), b["y"].to_numpy()))
                part_of = (b["fold"].to_numpy() * THIRDS + b["third"].to_numpy()).astype(int)
                for key in np.unique(part_of):
                    part = rows[part_of == key]
                    for a, (a0, a1) in enumerate(edges):
                        for c, (c0, c1) in enumerate(edges[a:], a):
                            at = (int(key), a, c)
                            size += 0 if at in held else (a1 - a0) * (c1 - c0)
                            held[at] = held.get(at, 0) + part[:, a0:a1].T @ part[:, c0:c1]
                            if size > HELD:
                                yield handed(held)
                                held, size = {}, 0
        if held:
            yield handed(held)

    def meet(tables: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(p, "<f8") for p in tables["p"]], axis=0)
        return tables.iloc[:1][keys].assign(p=[total.tobytes()])

    keyed = data.select("fold", F.pmod(F.xxhash64("gene_id", "line", F.lit(7)), F.lit(THIRDS)).alias("third"), "x", "y") if {"gene_id", "line"} <= set(data.columns) else data.select("fold", F.lit(0).alias("third"), "x", "y")
    shape = "key int, a int, b int, p binary"
    blocks = keyed.mapInPandas(run, shape).withColumn("side", F.pmod(F.spark_partition_id(), F.lit(SIDES)))
    out: dict[tuple[int, int], np.ndarray] = {}
    for r in blocks.groupBy(*keys, "side").applyInPandas(meet, shape).groupBy(*keys).applyInPandas(meet, shape).collect():
        (a0, a1), (b0, b1) = edges[r["a"]], edges[r["b"]]
        p = np.frombuffer(bytes(r["p"]), "<f8").reshape(a1 - a0, b1 - b0)
        table = out.setdefault(divmod(r["key"], THIRDS), np.zeros((k, k)))
        table[a0:a1, b0:b1] = p
        table[b0:b1, a0:a1] = p.T
    return Sums(out, list(features))


def _centred(p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Means, and products about the means: xx, xy, yy."""
    n, mean = p[0, 0], p[0, 1:] / p[0, 0]
    c = p[1:, 1:] - n * np.outer(mean, mean)
    return mean, c[:-1, :-1], c[:-1, -1], float(c[-1, -1])


def ridge(p: np.ndarray, alpha: float) -> np.ndarray:
    """(intercept, coefficients); the intercept is not penalised. alpha 0 is least
    squares of least norm."""
    mean, xx, xy, _ = _centred(p)
    if not len(xx):
        b = np.empty(0)
    elif alpha:
        b = np.linalg.lstsq(xx + alpha * np.eye(len(xx)), xy, rcond=1e-10)[0]
    else:
        b = _least_squares(xx, xy)
    return np.concatenate(([mean[-1] - mean[:-1] @ b], b))


def _least_squares(xx: np.ndarray, xy: np.ndarray) -> np.ndarray:
    """Coefficients of least norm. What depends on what is told on scaled columns, so that
    columns in large units do not hide small ones; what the rows leave open is taken out
    in the raw scale."""
    sd = np.sqrt(np.maximum(np.diag(xx), 0))
    sd[sd < 1e-12] = 1.0
    size, axes = np.linalg.eigh(xx / np.outer(sd, sd))
    settled = size > 1e-10 * max(size.max(), 1e-300)
    b = axes[:, settled] @ ((axes[:, settled].T @ (xy / sd)) / size[settled]) / sd
    if not settled.all():
        open_ = np.linalg.qr(axes[:, ~settled] / sd[:, None])[0]
        b = b - open_ @ (open_.T @ b)
    return b


def penalised(p: np.ndarray, alpha: float, scaling: str = "raw") -> np.ndarray:
    """``ridge`` on raw or on standardised features, told in the raw scale."""
    return _scaled_ridge(p, alpha) if scaling == "standardised" else ridge(p, alpha)


def lasso(p: np.ndarray, alpha: float) -> np.ndarray:
    """Least of 1 / (2 n) RSS + alpha |b|."""
    return lasso_paths([p], np.array([[alpha]]), 2000, 1e-6)[0, 0]


def lasso_paths(tables: list[np.ndarray], alphas: np.ndarray, most: int = 200, tolerance: float = 1e-3) -> np.ndarray:
    """(table, alpha, 1 + feature): intercepts and coefficients of each table at each of its
    penalties, in falling order. All tables take their coordinate steps together, each
    penalty from the one before, until no step moves the fit by more than ``tolerance`` of
    the target's spread."""
    centred = [_centred(p) for p in tables]
    mean, xx, xy = (np.stack([c[i] for c in centred]) for i in range(3))
    n, d = np.array([p[0, 0] for p in tables]), np.einsum("pjj->pj", xx)
    flat = d <= 1e-12
    b, g = np.zeros_like(xy), xy.copy()  # g: products with what is left over
    spread = np.maximum(np.array([c[3] for c in centred]), 1e-300)
    out = np.zeros((len(tables), alphas.shape[1], 1 + xy.shape[1]))
    for a in range(alphas.shape[1]):
        least, all_ = n * alphas[:, a], np.arange(xy.shape[1])
        active = all_
        for _ in range(most):
            moved = 0.0
            for j in active:
                r = g[:, j] + d[:, j] * b[:, j]
                new = np.where(flat[:, j], 0.0, np.sign(r) * np.maximum(0.0, np.abs(r) - least) / np.where(flat[:, j], 1.0, d[:, j]))
                step = new - b[:, j]
                if step.any():
                    g -= xx[:, :, j] * step[:, None]
                    b[:, j] = new
                    moved = max(moved, float((step * step * d[:, j] / spread).max()))
            if moved < tolerance * tolerance:
                if len(active) == len(all_):
                    break
                active = all_  # settled among the active: look at all once more
            else:
                active = np.flatnonzero((b != 0).any(axis=0)) if len(active) == len(all_) else active
                active = active if len(active) else all_
        out[:, a, 1:] = b
        out[:, a, 0] = mean[:, -1] - np.einsum("pj,pj->p", mean[:, :-1], b)
    return out


def score(p: np.ndarray, beta: np.ndarray) -> tuple[float, float]:
    """(R2, RMSE) of a fit on the rows that ``p`` sums up; R2 is NaN without spread."""
    v = np.concatenate((beta, [-1.0]))
    rss, tss = max(0.0, float(v @ p @ v)), _centred(p)[3]
    return (1 - rss / tss if tss > 1e-12 else float("nan")), float(np.sqrt(rss / p[0, 0]))


def lasso_alphas(p: np.ndarray, n: int = 100) -> np.ndarray:
    """The usual path: from the least penalty that leaves nothing down to a thousandth."""
    _, _, xy, _ = _centred(p)
    top = float(np.abs(xy).max(initial=0)) / p[0, 0]
    return np.array([top * 10 ** (-3 * i / (n - 1)) for i in range(n)]) if top > 0 else np.ones(n)


def best_lasso(sums: Sums, folds: list[int | None]) -> dict[int | None, float]:
    """Per training part (all but a fold; None: all) the penalty of the least squared error
    over its thirds."""
    tables, paths, tests = [], [], []
    for f in folds:
        thirds, path = sums.thirds(f), lasso_alphas(sums.total(f))
        for t in range(len(thirds) if len(thirds) > 1 else 0):
            tables.append(sum(thirds[:t] + thirds[t + 1 :]))
            paths.append(path)
            tests.append((f, thirds[t]))
    errors: dict[int | None, np.ndarray] = {}
    if tables:
        fits = lasso_paths(tables, np.stack(paths))
        for (f, test), fit in zip(tests, fits, strict=True):
            v = np.concatenate((fit, -np.ones((len(fit), 1))), axis=1)
            errors[f] = errors.get(f, 0) + np.einsum("ai,ij,aj->a", v, test, v) / test[0, 0]
    return {f: float(lasso_alphas(sums.total(f))[int(np.argmin(errors[f])) if f in errors else 0]) for f in folds}


def best_ridge(data: DataFrame, sums: Sums, folds: list[int | None], alphas=ALPHAS) -> dict[int | None, float]:
    """Per training part the penalty of the least squared leave-one-out error: one pass,
    in which each row's error is its residual over one less its leverage."""
    fits = {}
    for f in folds:
        p = sums.total(f)
        mean, xx, _, _ = _centred(p)
        for a in alphas:
            fits[-1 if f is None else f, a] = (ridge(p, a), mean[:-1], np.linalg.pinv(xx + a * np.eye(len(xx))), p[0, 0])

    def run(batches):
        held = dict.fromkeys(fits, 0.0)
        for b in batches:
            if not len(b):
                continue
            x, y, fold = np.stack(b["x"].to_numpy()), b["y"].to_numpy(), b["fold"].to_numpy()
            for (f, a), (beta, mean, inverse, n) in fits.items():
                z = x - mean
                leverage = np.minimum(1 / n + np.einsum("ij,jk,ik->i", z, inverse, z, optimize=True), 1 - 1e-9)
                error = (y - beta[0] - x @ beta[1:]) / (1 - leverage)
                held[f, a] += float((error[fold != f] ** 2).sum())
        yield pd.DataFrame([(f, a, v) for (f, a), v in held.items()], columns=["f", "a", "v"])

    summed = data.select("fold", "x", "y").mapInPandas(run, "f int, a double, v double").groupBy("f", "a").agg(F.sum("v").alias("v")).collect()
    errors = {(r["f"], r["a"]): r["v"] for r in summed}
    return {f: min(alphas, key=lambda a: errors.get((-1 if f is None else f, a), float("inf"))) for f in folds}


def linear_models(data: DataFrame, features: list[str]) -> dict[str, dict]:
    """Cross-validated least squares, ridge and lasso over ``fold``. Penalties are chosen
    inside each training part: the ridge's by leaving one row out, the lasso's by thirds."""
    sums = gather(data, features)
    products = sums.products
    parts = [*(products if len(products) > 1 else []), None]
    if not products:
        return {}
    chosen = {"ols": dict.fromkeys(parts, 0.0), "ridge": best_ridge(data, sums, parts) if features else dict.fromkeys(parts, 1.0), "lasso": best_lasso(sums, parts) if features else dict.fromkeys(parts, 1.0)}
    out = {}
    for name, penalties in chosen.items():
        fit = lasso if name == "lasso" else ridge
        betas = {f: fit(sums.total(f), penalties[f]) for f in parts}
        held = [score(products[f], betas[f])[0] for f in parts if f is not None] or [float("nan")]
        r2, rmse = score(sums.total(), betas[None])
        out[name] = {"cv_r2": float(np.mean(held)), "cv_std": float(np.std(held)), "r2": r2, "rmse": rmse, "beta": betas[None], "alpha": penalties[None]}
    return out


def metrics_table(spark, found: dict[str, dict]) -> DataFrame:
    rows = [(n, *(float(m[k]) for k in ("cv_r2", "cv_std", "r2", "rmse"))) for n, m in found.items()]
    return spark.createDataFrame(rows, "model string, cv_r2 double, cv_std double, r2 double, rmse double")


def importances(spark, found: dict[str, dict], features: list[str]) -> DataFrame:
    """Absolute coefficients, or a tree's importances."""
    rows = [(n, f, float(abs(b))) for n, m in found.items() for f, b in zip(features, m["importances"] if "importances" in m else m["beta"][1:], strict=True)]
    return spark.createDataFrame(rows, "model string, feature string, importance double")


def best_model(metrics: DataFrame) -> DataFrame:
    """The model of the highest cross-validated R2, the first by name of equals."""
    return metrics.where(~F.isnan("cv_r2")).orderBy(F.desc("cv_r2"), "model").limit(1)


def predictions(data: DataFrame, beta: np.ndarray) -> DataFrame:
    """Predicted value and residual of each row, by a column expression."""
    b = F.array(*[F.lit(float(v)) for v in beta[1:]])
    p = F.aggregate(F.zip_with("x", b, lambda a, c: a * c), F.lit(float(beta[0])), lambda t, v: t + v)
    return data.select("gene_id", "line", F.col("y").alias("actual"), p.alias("predicted"), (F.col("y") - p).alias("residual"))


# ---- trees ----


#: Full trees as far as pyspark.ml grows them.
DEPTH = 30


def forest(trees: int = 100, seed: int = 42):
    """Full trees on all features."""
    from pyspark.ml.regression import RandomForestRegressor

    return RandomForestRegressor(featuresCol="v", labelCol="y", numTrees=trees, maxDepth=DEPTH, featureSubsetStrategy="all", seed=seed, maxMemoryInMB=512)


def boosted(rounds: int = 100, seed: int = 42):
    from pyspark.ml.regression import GBTRegressor

    return GBTRegressor(featuresCol="v", labelCol="y", maxIter=rounds, stepSize=0.1, maxDepth=3, seed=seed)


def tree_model(data: DataFrame, estimator, folds: int = FOLDS) -> dict:
    """Cross-validated R2 over ``fold``, full fit, importances. The folds' fits run side by
    side; each is a series of small jobs."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.ml.functions import array_to_vector

    rows = data.select("y", "fold", array_to_vector("x").alias("v")).coalesce(max(1, data.sparkSession.sparkContext.defaultParallelism)).cache()

    def r2(scored: DataFrame) -> tuple[float, float]:
        s = scored.agg(F.count("*"), F.sum(F.pow(F.col("y") - F.col("prediction"), 2)), F.var_pop("y")).first()
        return (1 - s[1] / (s[0] * s[2]) if s[2] else float("nan")), float(np.sqrt(s[1] / s[0])) if s[0] else float("nan")

    def fitted(f: int | None):
        if f is None:
            return estimator.fit(rows)
        train, test = rows.where(F.col("fold") != f), rows.where(F.col("fold") == f)
        return r2(estimator.fit(train).transform(test))[0] if train.take(1) and test.take(1) else None

    rows.count()
    with ThreadPoolExecutor(folds + 1) as pool:
        *held, model = pool.map(fitted, [*range(folds), None])
    held = [h for h in held if h is not None]
    whole = r2(model.transform(rows))
    rows.unpersist()
    return {"cv_r2": float(np.mean(held)) if held else float("nan"), "cv_std": float(np.std(held)) if held else float("nan"), "r2": whole[0], "rmse": whole[1], "importances": model.featureImportances.toArray(), "model": model}


def tree_predictions(data: DataFrame, found: dict) -> DataFrame:
    """Predicted value and residual of each row by a fitted tree model."""
    from pyspark.ml.functions import array_to_vector

    scored = found["model"].transform(data.select("gene_id", "line", "y", array_to_vector("x").alias("v")))
    return scored.select("gene_id", "line", F.col("y").alias("actual"), F.col("prediction").alias("predicted"), (F.col("y") - F.col("prediction")).alias("residual"))


# ---- within-gene models ----


def within_gene(data: DataFrame, features: list[str], most: int = 15) -> tuple[DataFrame, dict]:
    """Least squares of y on features centred within genes, lines and genes.

    Gene effects are swept out by centring everything within genes (Frisch-Waugh), so no
    column a gene is made; R2 is against the plain spread of y.
    """
    used = features[:most]
    lines = sorted(r[0] for r in data.select("line").distinct().collect())[1:]
    w = Window.partitionBy("gene_id")
    columns = [F.get("x", F.lit(i)) for i in range(len(used))] + [(F.col("line") == x).cast("double") for x in lines]
    centred = [(c - F.avg(c).over(w)) for c in (*columns, F.col("y"))]
    rows = data.select(F.array(*centred[:-1]).alias("x") if columns else F.array().cast("array<double>").alias("x"), centred[-1].alias("y"), F.lit(0).alias("fold"))
    names = [*used, *[f"line_{x}" for x in lines]]
    p = gather(rows, names).total()
    beta = ridge(p, 0.0)
    v = np.concatenate((beta, [-1.0]))
    spread = data.agg(F.count("*"), F.var_pop("y"), F.countDistinct("gene_id"), F.countDistinct("line")).first()
    r2 = 1 - float(v @ p @ v) / (spread[0] * spread[1]) if spread[1] else float("nan")
    found = {"r2": r2, "n_obs": spread[0], "n_genes": spread[2], "n_lines": spread[3]}
    coefficients = data.sparkSession.createDataFrame([(f, float(b), float(abs(b))) for f, b in zip(used, beta[1:], strict=False)], "feature string, coefficient double, importance double")
    return coefficients, found


def gene_by_gene(data: DataFrame, features: list[str], most: int = 10, least: int = 3) -> DataFrame:
    """Least squares for each gene on its first features and its lines. Genes with too few
    rows for the columns, or no spread, are left out. A gene has a row a line."""
    used = features[:most]

    def found(**columns) -> pd.DataFrame:
        return pd.DataFrame(columns).astype({"gene_id": str, "r2": float, "n_obs": int, "n_lines": int, "important": int})

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("line")
        y, lines = rows["y"].to_numpy(), sorted(set(rows["line"]))
        x = np.column_stack((np.stack(rows["x"].to_numpy())[:, : len(used)], *[(rows["line"] == v).to_numpy(float) for v in lines[1:]]))
        if len(y) < max(least, x.shape[1] + 1) or y.var() == 0:
            return found(gene_id=[], r2=[], n_obs=[], n_lines=[], important=[])
        a = np.column_stack((np.ones(len(y)), x))
        b = np.linalg.lstsq(a, y, rcond=None)[0]
        r2 = 1 - float(((y - a @ b) ** 2).sum() / ((y - y.mean()) ** 2).sum())
        return found(gene_id=[rows["gene_id"].iloc[0]], r2=[r2], n_obs=[len(y)], n_lines=[len(lines)], important=[int((np.abs(b[1 : 1 + len(used)]) > 0.01).sum())])

    return data.select("gene_id", "line", "y", "x").groupBy("gene_id").applyInPandas(fit, "gene_id string, r2 double, n_obs long, n_lines long, important long")


def compare_approaches(genes: DataFrame, mixed: dict) -> DataFrame:
    """Mean and median R2 of the gene models beside the within-gene one, with advice."""
    r2 = F.lit(float(mixed["r2"]))
    s = genes.agg(F.count("*").alias("n_genes"), F.avg("r2").alias("gene_mean_r2"), F.expr("percentile(r2, 0.5D)").alias("gene_median_r2"), F.count_if(F.col("r2") > 0.5).alias("well_predicted"))
    advice = F.when(r2 > F.lit(0.4), "within-gene model").when(F.col("gene_mean_r2") > F.lit(0.3), "gene by gene").otherwise("more features")
    return s.select("n_genes", "gene_mean_r2", "gene_median_r2", "well_predicted", r2.alias("mixed_r2"), advice.alias("advice"))


# ---- diagnostics ----


def diagnostic_grid(spark, plain: Sums, grouped: Sums) -> DataFrame:
    """{raw, standardised} x {ols, ridge 1, ridge 10} x {row folds, gene folds}."""
    rows = []
    for strategy, sums in (("rows", plain), ("genes", grouped)):
        for scaling in ("raw", "standardised"):
            for name, alpha in (("ols", 0.0), ("ridge_1", 1.0), ("ridge_10", 10.0)):
                held = []
                for fold, test in sums.products.items():
                    p = sums.total(without=fold)
                    if not isinstance(p, np.ndarray):
                        continue
                    held.append(score(test, penalised(p, alpha, scaling))[0])
                rows.append((scaling, name, strategy, float(np.mean(held)) if held else float("nan"), float(np.std(held)) if held else float("nan")))
    return spark.createDataFrame(rows, "approach string, model string, cv_strategy string, cv_r2 double, cv_std double")


def _scaled_ridge(p: np.ndarray, alpha: float) -> np.ndarray:
    """Ridge on features scaled to unit population spread, told in the raw scale."""
    mean, xx, xy, _ = _centred(p)
    sd = np.sqrt(np.maximum(np.diag(xx) / p[0, 0], 0))
    sd[sd < 1e-12] = 1.0
    b = np.linalg.lstsq(xx / np.outer(sd, sd) + alpha * np.eye(len(xx)), xy / sd, rcond=1e-10)[0] / sd
    return np.concatenate(([mean[-1] - mean[:-1] @ b], b))


def recommendations(spark, grid: DataFrame, correlations: DataFrame, variances: DataFrame) -> DataFrame:
    """What the diagnostics suggest, one row an advice that applies."""
    best = grid.where(~F.isnan("cv_r2")).agg(F.max("cv_r2")).first()[0]
    top = correlations.agg(F.max("correlation")).first()[0]
    many = variances.where("variance > 0.1D").count()
    found = [
        ("very weak correlations", top is None or top < 0.01), ("few features vary", many < 10), ("try other features", top is None or top < 0.05),
        ("select features otherwise", many < 20), ("try other models", best is None or best < 0.01), ("check by experiment", True),
    ]
    return spark.createDataFrame([(i, a) for i, (a, on) in enumerate(found) if on], "n int, advice string")


def pooled_r2(data: DataFrame, alpha: float = 0.0) -> float:
    """Leave-one-out R2 over all rows together, for ten rows at most: R2 of one row
    alone is undefined."""
    rows = data.orderBy("gene_id", "line").limit(11).collect()
    if not 2 <= len(rows) <= 10:
        raise ValueError("leave-one-out is for two to ten rows")
    a, y = np.array([[1.0, *r["x"]] for r in rows]), np.array([r["y"] for r in rows])
    full = np.column_stack((a, y))
    errors = []
    for i in range(len(y)):
        b = ridge(np.delete(full, i, 0).T @ np.delete(full, i, 0), alpha)
        errors.append(y[i] - a[i] @ b)
    return 1 - float(np.square(errors).sum() / np.square(y - y.mean()).sum())


def top_importances(found: DataFrame, n: int = 10) -> DataFrame:
    """The n most important features of each model."""
    rank = F.row_number().over(Window.partitionBy("model").orderBy(F.desc("importance"), "feature"))
    return found.withColumn("rank", rank).where(F.col("rank") <= n)
