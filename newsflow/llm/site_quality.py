"""Quality classification with hierarchical empirical Bayes over sites and paths.

A logistic model of a document's own text gives its evidence. The mean
evidence of a path shrinks toward that of its site, and that of the site
toward the corpus, the more the fewer documents they have; how strongly is
estimated from the spread between sites and between paths. The posterior of
the path takes the place of the corpus mean as the document's prior, without
the document's own share in it, which would count its evidence twice.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from newsflow.llm.common import by_text, id_type, text_hash, whole_row
from newsflow.llm.features import COUNTS, counts
from newsflow.session import materialise

#: Labelled rows that the document model is fitted on, chosen by hash.
FIT_ROWS = 20_000


def _features() -> list[Column]:
    ratio = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return [
        F.least(ratio("n_symbols", "n_words"), F.lit(1.0)),
        ratio("n_upper", "n_letters"),
        ratio("n_repeat_words", "n_words"),
        ratio("n_dup_lines", "n_lines"),
        F.least(ratio("word_chars", "n_words"), F.lit(20.0)),
        F.least(ratio("n_letters", "word_chars"), F.lit(1.0)),
        F.least(ratio("n_exclaims", "n_words"), F.lit(1.0)),
        ratio("n_ended", "n_lines"),
        ratio("n_distinct", "n_words"),
        F.least(ratio("n_bars", "n_words"), F.lit(1.0)),
        F.least(ratio("n_digits", "n_words"), F.lit(1.0)),
        F.log1p("n_words"),
    ]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> tuple[np.ndarray, float]:
    """Weights and intercept of a ridge-penalised logistic model, by Newton's method on standardised features."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    penalty = np.diag([ridge] * x.shape[1] + [1e-6])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (p - y) + penalty @ w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    weights = w[:-1] / scale
    return weights, float(w[-1] - weights @ mean)


def shrinkage(groups: int, rows: float, rows_squared: float, between: float, within: float) -> float:
    """How many documents' worth the parent's mean counts, by the method of moments.

    ``between`` is the sum of n (mean - parent)^2, ``within`` the pooled
    variance inside groups, ``rows_squared`` the sum of n^2.
    """
    spread = (between - (groups - 1) * within) / max(rows - rows_squared / max(rows, 1.0), 1e-9)
    return float(np.clip(within / max(spread, 1e-9), 1.0, 1e6))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    site: Column,
    path: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = 0.5,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """Per row: id, site, path, evidence, site_posterior, path_posterior, quality, kept and _hash (of the text).

    ``labels`` has the id and a 0/1 label; the document model is fitted on at
    most ``fit_rows`` labelled rows chosen by hash, all else covers all rows.
    Without labels of both kinds the evidence is 0.5 everywhere and all
    documents with words are kept. Null and empty texts have quality 0 and are
    not kept; they take no part in the means. Null sites and paths are sites
    and paths. An id with several labels counts once per label in the fit.
    Repeated rows and null ids give a row each; an empty table gives none;
    other columns are not read. Texts are read once.
    """
    schema = f"id {id_type(docs, id_col)}," + ",".join(f"{c} long" for c in COUNTS)
    measured = materialise(
        by_text(docs, id_col, text_col, schema, lambda: lambda key, text: [(key, *counts(text))], {"site": site.cast("string"), "path": path.cast("string"), "_hash": text_hash(F.col(text_col))})
    )
    features = _features()
    given = labels.where(F.col(label_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("_label"))
    sample = (
        measured.where("n_words > 0")
        .join(given, "id")
        .select(F.array(*features).alias("x"), "_label", F.xxhash64("id").alias("_h"), "id")
        .orderBy("_h", "id", "_label")
        .limit(fit_rows)
        .collect()
    )
    y = np.array([r["_label"] for r in sample])
    if len(set(y.tolist())) < 2:
        logit: Column = F.lit(0.0)
    else:
        weights, intercept = fit_logistic(np.array([r["x"] for r in sample], float), y)
        logit = F.lit(intercept)
        for w, f in zip(weights, features):
            logit = logit + F.lit(float(w)) * f
    scored = measured.withColumn("_logit", F.greatest(F.lit(-12.0), F.least(F.lit(12.0), logit))).withColumn(
        "evidence", F.when(F.col("n_words") > 0, 1 / (1 + F.exp(-F.col("_logit")))).otherwise(F.lit(0.0))
    )
    paths = materialise(
        scored.where("n_words > 0")
        .groupBy("site", "path")
        .agg(F.count("*").cast("double").alias("n"), F.sum("evidence").alias("s"), F.sum(F.col("evidence") * F.col("evidence")).alias("q"))
    )
    sites = paths.groupBy("site").agg(F.sum("n").alias("site_n"), F.sum("s").alias("site_s"))
    n, s = paths.agg(F.sum("n"), F.sum("s")).first()
    n, mean = n or 0.0, (s or 0.0) / (n or 1.0)
    mean = min(max(mean, 1e-3), 1 - 1e-3)

    both = materialise(
        paths.alias("p").join(sites.alias("t"), F.col("p.site").eqNullSafe(F.col("t.site"))).select("p.site", "path", "n", "s", "q", "site_n", "site_s")
    )
    p = both.agg(
        F.count("*"),
        F.sum("q") - F.sum(F.col("s") * F.col("s") / F.col("n")),
        F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col("site_s") / F.col("site_n"), 2)),
        F.sum(F.col("n") * F.col("n")),
    ).first()
    t = sites.agg(
        F.count("*"),
        F.sum(F.col("site_n") * F.pow(F.col("site_s") / F.col("site_n") - mean, 2)),
        F.sum(F.col("site_n") * F.col("site_n")),
    ).first()
    within = max((p[1] or 0.0) / max(n - p[0], 1.0), 1e-6)
    to_corpus = shrinkage(t[0], n, t[2] or 0.0, t[1] or 0.0, within)
    to_site = shrinkage(p[0] - t[0] + 1, n, p[3] or 0.0, p[2] or 0.0, within)

    site_posterior = (F.col("site_s") + to_corpus * mean) / (F.col("site_n") + to_corpus)
    posteriors = both.withColumn("site_posterior", site_posterior).withColumn(
        "path_posterior", (F.col("s") + to_site * F.col("site_posterior")) / (F.col("n") + to_site)
    )
    found = posteriors.select(F.col("site").alias("_site"), F.col("path").alias("_path"), "site_posterior", "path_posterior", "n", "s", "site_n", "site_s")
    joined = scored.join(found, F.col("site").eqNullSafe(F.col("_site")) & F.col("path").eqNullSafe(F.col("_path")), "left")
    others_of_site = (F.col("site_s") - F.col("evidence") + to_corpus * mean) / (F.col("site_n") - 1 + to_corpus)
    others = (F.col("s") - F.col("evidence") + to_site * others_of_site) / (F.col("n") - 1 + to_site)
    clipped = F.greatest(F.lit(1e-3), F.least(F.lit(1 - 1e-3), F.coalesce(others, F.lit(mean))))
    total = F.col("_logit") + F.log(clipped / (1 - clipped)) - float(np.log(mean / (1 - mean)))
    quality = F.when(F.col("n_words") > 0, 1 / (1 + F.exp(-total))).otherwise(F.lit(0.0))
    return joined.select(
        F.col("id").alias(id_col), "site", "path", "evidence", "site_posterior", "path_posterior",
        quality.alias("quality"), (quality >= threshold).alias("kept"), "_hash",
    )


def keep_good(docs: DataFrame, labels: DataFrame, site: Column, path: Column, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without those that ``classify`` rejects. All columns are kept."""
    rejected = classify(docs, labels, site, path, id_col, text_col, **options).where("NOT kept")
    rejected = rejected.select(F.col(id_col).alias("_id"), F.col("_hash").alias("_same")).distinct()
    rows = docs.select(whole_row(docs).alias("_doc"), F.col(id_col).alias("_i"), text_hash(F.col(text_col)).alias("_h"))
    return rows.join(rejected, F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_same")), "left_anti").select("_doc.*")
