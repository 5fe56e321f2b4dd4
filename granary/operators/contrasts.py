"""Contrasts of groups: donor-level negative binomial by likelihood with shrinkage, all pairs, cell-level exploratory tests, and the records that go with them."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.functions.expressions import two_sided_normal
from granary.operators import cohort, numeric
from granary.operators.metrics import union_all

#: Samples that an arm and a design need, level, effect under the null hypothesis, cells of an arm.
ARM, DESIGN, ALPHA, EFFECT, ARM_CELLS = 2, 4, 0.05, 1.0, 2
LN2 = math.log(2)
NOTE = "selection-biased: groups were found on the same data"


def _profiles(bulk: DataFrame, samples: DataFrame, factors: DataFrame, focus: str, ref: str) -> DataFrame:
    """A row a gene: counts, size factors and arms over all samples of both groups, zeros included. Arrays are as long as the design has samples."""
    design = samples.where(F.col("grp").isin(focus, ref)).join(factors, "sample").select("sample", "size_factor", (F.col("grp") == focus).cast("int").alias("arm"))
    genes = bulk.join(design, "sample").groupBy("gene_id").agg(F.map_from_entries(F.collect_list(F.struct("sample", "count"))).alias("m")).where(F.exists(F.map_values("m"), lambda x: x > 0))
    all_ = design.agg(F.array_sort(F.collect_list(F.struct("sample", "size_factor", "arm"))).alias("d"))
    return genes.join(all_).select("gene_id", F.transform("d", lambda x: F.coalesce(F.element_at(F.col("m"), x["sample"]), F.lit(0)).cast("double")).alias("y"), F.col("d.size_factor").alias("s"), F.col("d.arm").alias("x"))


def _arrays(y, s, x):
    import numpy as np

    return np.array(y.tolist(), float), np.array(s.tolist(), float), np.array(x.tolist(), float)


def _means(y, s, x):
    """Means of the arms per unit of size factor, with a small floor."""
    import numpy as np

    out = []
    for arm in (0, 1):
        on = x == arm
        out.append(np.maximum((y * on).sum(1) / np.maximum((s * on).sum(1), 1e-12), 1e-3))
    return np.array(out).T


def _log_gamma(z):
    import numpy as np

    return np.vectorize(math.lgamma, otypes=[float])(z)


def _likelihood(y, mu, x, alpha):
    """Negative binomial log-likelihood of each gene with the Cox-Reid adjustment for the two means."""
    import numpy as np

    r = 1 / alpha[:, None]
    ll = (_log_gamma(y + r) - _log_gamma(np.broadcast_to(r, y.shape)) + y * np.log(mu / (mu + r)) - r * np.log1p(mu / r)).sum(1)
    w = mu / (1 + mu * alpha[:, None])
    return ll - 0.5 * sum(np.log(np.maximum((w * (x == arm)).sum(1), 1e-12)) for arm in (0, 1))


def _best_dispersion(y, s, x, centre=None, spread=None):
    """The log dispersion of most likelihood, with a normal prior if there is one: a grid, then golden sections."""
    import numpy as np

    mu = np.where(x == 1, _means(y, s, x)[:, [1]], _means(y, s, x)[:, [0]]) * s

    def value(log_a):
        prior = 0 if centre is None else -((log_a - centre) ** 2) / (2 * spread)
        return _likelihood(y, mu, x, np.exp(log_a)) + prior

    grid = np.linspace(math.log(1e-6), math.log(20), 24)
    at = np.argmax([value(np.full(len(y), g)) for g in grid], axis=0)
    lo, hi, k = grid[np.maximum(at - 1, 0)], grid[np.minimum(at + 1, len(grid) - 1)], (math.sqrt(5) - 1) / 2
    for _ in range(18):
        a, b = hi - k * (hi - lo), lo + k * (hi - lo)
        left = value(a) > value(b)
        lo, hi = np.where(left, lo, a), np.where(left, b, hi)
    return (lo + hi) / 2


def likelihood_contrast(bulk: DataFrame, samples: DataFrame, factors: DataFrame, focus: str, ref: str, *, effect: float = EFFECT, alpha: float = ALPHA) -> DataFrame:
    """gene_id, base_mean, dispersion, log2_fold_change (shrunken), log2_fold_change_mle, error, p_value, p_value_adj, regulation.

    Dispersions by adjusted profile likelihood, a trend a0 + a1 / mean over all genes, then each gene's most likely one under a log-normal prior around the trend. Wald test of |log2 fold change| <= effect; the reported effect is the most likely one under a Cauchy prior whose width is that of the estimates. Genes are rows; per-gene arrays are as long as the design has samples; what is shared by genes are aggregates of one row. Genes without counts in the two groups have no row. Positive: higher in focus.
    """
    d = _profiles(bulk, samples, factors, focus, ref)

    @F.pandas_udf("base_mean double, log_disp double")
    def gene_wise(y, s, x):
        import pandas as pd

        y, s, x = _arrays(y, s, x)
        return pd.DataFrame({"base_mean": (y / s).mean(1), "log_disp": _best_dispersion(y, s, x)})

    d = d.withColumn("g", gene_wise("y", "s", "x")).select("gene_id", "y", "s", "x", "g.*").checkpoint()
    seen = d.where((F.col("log_disp") > math.log(1e-5)) & (F.col("base_mean") > 0.5))
    inv, disp = 1 / F.col("base_mean"), F.exp(F.least("log_disp", F.lit(2.0)))
    t = seen.agg(F.regr_slope(disp, inv).alias("a1"), F.regr_intercept(disp, inv).alias("a0"), F.percentile(disp, 0.5).alias("mid")).select(F.greatest(F.coalesce("a1", F.lit(0.0)), F.lit(0.0)).alias("a1"), F.when(F.col("a0") > 1e-4, F.col("a0")).otherwise(F.coalesce("mid", F.lit(0.1))).alias("a0"))
    d = d.join(t).withColumn("centre", F.log(F.col("a0") + F.col("a1") / F.greatest("base_mean", F.lit(1e-3)))).drop("a0", "a1")
    off = F.abs(F.col("log_disp") - F.col("centre"))
    noise = F.lit(2.0) / F.greatest(F.size("x") - 2, F.lit(1))  # variance of a log variance with so many degrees of freedom
    width = d.where((F.col("log_disp") > math.log(1e-5)) & (F.col("base_mean") > 0.5)).agg(F.greatest(F.coalesce(F.pow(1.4826 * F.percentile(off, 0.5), 2) - F.max(noise), F.lit(0.25)), F.lit(0.25)).alias("spread"))

    @F.pandas_udf("dispersion double, mle double, error double")
    def fitted(y, s, x, centre, spread):
        import numpy as np
        import pandas as pd

        y, s, x = _arrays(y, s, x)
        a = np.exp(_best_dispersion(y, s, x, centre.to_numpy(), spread.to_numpy()))[:, None]
        m = np.log(_means(y, s, x))
        for _ in range(12):  # scoring steps of the two log means
            for arm in (0, 1):
                mu = np.exp(m[:, [arm]]) * s
                w = (x == arm) / (1 + a * mu)
                m[:, arm] += np.clip((w * (y - mu)).sum(1) / np.maximum((w * mu).sum(1), 1e-9), -2, 2)
        m = np.maximum(m, -12)
        mu = np.exp(np.where(x == 1, m[:, [1]], m[:, [0]])) * s
        info = [np.maximum(((x == arm) * mu / (1 + a * mu)).sum(1), 1e-6) for arm in (0, 1)]
        return pd.DataFrame({"dispersion": a[:, 0], "mle": (m[:, 1] - m[:, 0]) / LN2, "error": np.sqrt(1 / info[0] + 1 / info[1]) / LN2})

    d = d.join(width).withColumn("f", fitted("y", "s", "x", "centre", "spread")).select("gene_id", "base_mean", "f.*").checkpoint()
    scale = d.where("error < 5").agg(F.greatest(F.coalesce(F.percentile(F.sqrt(F.greatest(F.col("mle") * F.col("mle") - F.col("error") * F.col("error"), F.lit(0.0))), 0.5), F.lit(0.1)), F.lit(0.1)).alias("scale"))

    @F.pandas_udf("shrunk double, p double")
    def judged(mle, error, scale):
        import numpy as np
        import pandas as pd

        b, e, c = (v.to_numpy()[:, None] for v in (mle, error, scale))
        share = np.linspace(0, 1, 201)[None, :]
        v = -((b * share - b) ** 2) / (2 * e * e) - np.log1p((b * share / c) ** 2)
        p = [min(1.0, math.erfc(max(0.0, abs(x) - effect) / y / math.sqrt(2))) if effect else math.erfc(abs(x) / y / math.sqrt(2)) for x, y in zip(mle, error)]
        return pd.DataFrame({"shrunk": mle.to_numpy() * share[0][v.argmax(1)], "p": p})

    d = d.join(scale).withColumn("j", judged("mle", "error", "scale"))
    d = d.select("gene_id", F.round("base_mean", 4).alias("base_mean"), F.round("dispersion", 5).alias("dispersion"), F.round("j.shrunk", 4).alias("log2_fold_change"), F.round("mle", 4).alias("log2_fold_change_mle"), F.round("error", 4).alias("error"), F.col("j.p").alias("p_value"))
    d = numeric.adjusted(d, "p_value", "gene_id").withColumnRenamed("q", "p_value_adj")
    hit = F.col("p_value_adj") < alpha
    return d.withColumn("regulation", F.when(hit & (F.col("log2_fold_change_mle") > 0), "up").when(hit & (F.col("log2_fold_change_mle") < 0), "down").otherwise("no_change"))


def stamped(df: DataFrame, focus: str, ref: str, effect: float, alpha: float) -> DataFrame:
    """Direction, test and rule on every row."""
    said = {"focus_group": focus, "reference_group": ref, "test": f"negative binomial Wald, H0: |log2FC| <= {effect:g}", "lfc_threshold": float(effect), "alpha": float(alpha), "significance_rule": f"p_value_adj < {alpha:g}", "unit_of_replication": "sample"}
    return df.withColumns({k: F.lit(v) for k, v in said.items()})


def all_pairs(bulk: DataFrame, samples: DataFrame, *, effect: float = EFFECT, alpha: float = ALPHA) -> tuple[DataFrame | None, list[dict]]:
    """Every oriented pair of groups, and a record of each: genes up and down, or why it was left out. The groups of a design are few."""
    sizes = {r.grp: r.n for r in samples.groupBy("grp").agg(F.count("*").alias("n")).collect()}
    frames, records = [], []
    for r in cohort.oriented_pairs(samples, "grp").orderBy("focus_group", "reference_group").collect():
        record = {"focus_group": r.focus_group, "reference_group": r.reference_group, "n_up": 0, "n_down": 0}
        if min(sizes[r.focus_group], sizes[r.reference_group]) < ARM:
            records.append(record | {"status": f"insufficient replicates (need {ARM} a group)"})
            continue
        pair = samples.where(F.col("grp").isin(r.focus_group, r.reference_group))
        of = bulk.join(pair.select("sample"), "sample", "left_semi")
        df = stamped(likelihood_contrast(of, pair, numeric.size_factors(of), r.focus_group, r.reference_group, effect=effect, alpha=alpha), r.focus_group, r.reference_group, effect, alpha).checkpoint()
        n = {x.regulation: x.n for x in df.groupBy("regulation").agg(F.count("*").alias("n")).collect()}
        records.append(record | {"n_up": n.get("up", 0), "n_down": n.get("down", 0), "status": "ok" if n else "no expressed genes"})
        frames.append(df)
    return (union_all(frames) if frames else None), records


def pseudobulk_de(counts: DataFrame, cells: DataFrame, *, celltype: str | None = None, min_cells: int = 10, effect: float = EFFECT, alpha: float = ALPHA) -> tuple[DataFrame | None, list[dict]]:
    """Overall and, if asked, for each cell type. Needs two groups and four samples; raises otherwise. Cell types are few."""
    check_uncorrected(counts)
    design = cells.select("sample", "grp").distinct()
    if design.select("grp").distinct().count() < 2 or design.select("sample").distinct().count() < DESIGN:
        raise ValueError(f"a contrast needs two groups and {DESIGN} samples")
    parts = [("overall", cells)] + [(r[0], cells.where(F.col(celltype) == r[0])) for r in (cells.select(celltype).distinct().orderBy(celltype).collect() if celltype else [])]
    frames, records = [], []
    for name, part in parts:
        bulk = cohort.pseudobulk(counts, part, "sample", min_cells=min_cells).checkpoint()
        kept = design.join(bulk.select("sample").distinct(), "sample", "left_semi")
        df, said = all_pairs(bulk.select("sample", "gene_id", "count"), kept, effect=effect, alpha=alpha)
        records += [x | {"stratum": name} for x in said]
        if df is not None:
            frames.append(df.withColumn("stratum", F.lit(name)))
    return (union_all(frames) if frames else None), records


def check_uncorrected(df: DataFrame, derived: tuple[str, ...] = ("corrected", "integrated", "harmony", "scvi", "combat", "latent", "embedding")) -> None:
    """Contrasts take counts: raises if a column comes from an integration."""
    bad = [c for c in df.columns if any(k in c.lower() for k in derived)]
    if bad:
        raise ValueError(f"columns of an integration can't be tested: {bad}")


def cell_level(values: DataFrame, cells: DataFrame, by: str, *, lfc: float = 1.0, alpha: float = ALPHA) -> DataFrame:
    """Exploratory tests of cells between groups within each value of ``by`` (a cluster or a cell type): rank sums for each oriented pair, with a stamp that cells are no replicates. Arms with fewer than two cells are left out. Strata and groups are few; rows are never collected."""
    frames = []
    arms = {(r[0], r.grp): r.n for r in cells.groupBy(by, "grp").agg(F.count("*").alias("n")).collect()}
    for pair in cohort.oriented_pairs(cells, "grp").collect():
        for x in sorted({k for k, _ in arms if k is not None}, key=str):
            if min(arms.get((x, pair.focus_group), 0), arms.get((x, pair.reference_group), 0)) < ARM_CELLS:
                continue
            part = cells.where((F.col(by) == x) & F.col("grp").isin(pair.focus_group, pair.reference_group)).select("cell_id", "grp")
            v = values.join(part.select("cell_id"), "cell_id", "left_semi")
            ranks = numeric.rank_sum(v, part, "grp").where(F.col("grp") == pair.focus_group).withColumn("p_value", F.round(two_sided_normal(F.col("z")), 9))
            means = numeric.group_means(v, part, "grp")
            m = means.groupBy("gene_id").agg(*[F.coalesce(F.max(F.when(F.col("grp") == g, F.col("mean"))), F.lit(0.0)).alias(k) for g, k in ((pair.focus_group, "a"), (pair.reference_group, "b"))])
            change = F.round(F.log2((F.expm1("a") + 1e-9) / (F.expm1("b") + 1e-9)), 4)
            d = ranks.join(m.select("gene_id", change.alias("log2_fold_change")), "gene_id").drop("grp")
            frames.append(d.withColumns({by: F.lit(x), "focus_group": F.lit(pair.focus_group), "reference_group": F.lit(pair.reference_group)}))
    if not frames:
        raise ValueError("no stratum has two arms")
    d = numeric.adjusted(union_all(frames), "p_value", "gene_id", by, "focus_group", "reference_group").withColumnRenamed("q", "p_value_adj")
    hit = F.col("p_value_adj") < alpha
    return d.withColumns({"regulation": F.when(hit & (F.col("log2_fold_change") > lfc), "up").when(hit & (F.col("log2_fold_change") < -lfc), "down").otherwise("no_change"), "replication": F.lit("pseudoreplicated: cells of a sample are not independent; exploratory only")})


def without_p_values(markers: DataFrame, by: str, order: str) -> DataFrame:
    """Markers of groups that were found on the same data: no p-values, the rank in the order given, and a note."""
    drop = [c for c in ("pvals", "pvals_adj", "p_value", "p_value_adj") if c in markers.columns]
    return markers.drop(*drop).withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(order))).withColumn("note", F.lit(NOTE))


def shrinkage_coefficient(names: list[str], focus: str) -> str | None:
    """Which coefficient of a fit belongs to the focus group: the one at this level, else one that names it, else the only one."""
    found = [n for n in names if n.lower() != "intercept"]
    return next((n for n in found if f"[T.{focus}]" in n), None) or next((n for n in found if focus in n), None) or (found[0] if len(found) == 1 else None)


def provenance(samples: DataFrame, reference: str | None, *, effect: float = EFFECT, alpha: float = ALPHA) -> dict:
    """What a contrast was: groups, reference and why, pairs, rule."""
    groups = sorted(r[0] for r in samples.select("grp").distinct().collect() if r[0] is not None)
    pairs = [(r.focus_group, r.reference_group) for r in cohort.oriented_pairs(samples, "grp").orderBy("focus_group", "reference_group").collect()]
    refs = {b for _, b in pairs}
    return {"groups": groups, "reference_group": reference or (refs.pop() if len(refs) == 1 else None), "reference_reason": "explicit" if reference else "baseline name or alphabetical", "contrasts": [f"{a} vs {b}" for a, b in pairs], "effect_rule": f"H0: |log2FC| <= {effect:g}, p_value_adj < {alpha:g}"}
