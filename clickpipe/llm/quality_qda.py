"""Quality classifier: regularised quadratic discriminant analysis.

Each class k is a normal density over transformed statistics of a text.  Its
covariance is shrunk twice, towards the pooled covariance and towards a
diagonal: ``S_k' = (1 - b) * ((1 - a) * S_k + a * S_pooled) + b * D`` with D
the diagonal of the pooled covariance, floored at ``FLOOR``.  The fit takes
one aggregation (class counts, sums and products of the labelled rows; the
driver sees those few numbers only), factors each covariance once
(Cholesky, L L' = S_k') and keeps W = L^-1 and the log determinant.  A score
is ``P(1 | x)`` from the log-density difference, where the Mahalanobis term is
``|W (x - mean)|^2``: plain column arithmetic, so scoring is a narrow JVM map.

Statistics are logs and ratios of counts, with ratios of small counts damped
so that a very short text isn't extreme by being short.

Defined cases: null text is read as empty; an empty text gets a score like any
other; labels other than 0 and 1, and null ones, don't train; several labels
of one id all count; where a class has no labelled rows
there is no density and every score is the prior (share of label 1, 0.5 without
labelled rows; ``fit`` itself raises ``ValueError``); an empty table gives no rows;
ties at the threshold count as predicted 1; repeated rows and extra columns
pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpipe.llm.common import read_table, saved, whole_text

TO_POOLED = 0.1
TO_DIAGONAL = 0.1
FLOOR = 1e-3
THRESHOLD = 0.3
FOLDS = 5
STATISTICS = [f"_s_{i}" for i in range(11)]


def statistics(text: Column) -> dict[str, Column]:
    """Transformed statistics of a text, by name."""
    n = F.length(text).cast("double")
    words = F.split(F.lower(F.trim(text)), r"\s+")
    n_words = F.size(words).cast("double")
    lines = F.split(text, "\n")
    n_lines = F.size(lines).cast("double")

    def share(pattern: str, of: Column) -> Column:
        return F.log1p(F.lit(100.0) * F.regexp_count(text, F.lit(pattern)) / F.greatest(of, F.lit(1.0)))

    return {
        "symbols": share(r"[^\p{L}\p{N}\s.,]", n + 20),
        "capitals": share(r"\p{Lu}", n + 20),
        "digits": share(r"\p{Nd}", n + 20),
        "bars": share(r"\|", n_words + 5),
        "shouts": share(r"!", n_words + 5),
        "marked": share(r"[^\p{L}\p{N}\s]{2,}", n_words + 5),
        "echoes": share(r"(?<!\p{L})(\p{L}+)[,.]? \1(?!\p{L})", n_words),
        "variety": (F.size(F.array_distinct(words)) + 20.0) / (n_words + 20.0),
        "new_lines": (F.size(F.array_distinct(lines)) + 5.0) / (n_lines + 5.0),
        "word_length": F.log((n + 20.0) / (n_words + 4.0)),
        "line_length": F.log1p((n_words + 5.0) / (n_lines + 1.0)),
    }


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Appends the statistics as doubles, named as in ``STATISTICS``."""
    found = statistics(whole_text(text)).values()
    rest = [c for c in df.columns if c not in STATISTICS]
    return df.select(*rest, *[c.cast("double").alias(n) for n, c in zip(STATISTICS, found, strict=True)])


@dataclass(frozen=True)
class QuadraticDiscriminant:
    """Per class: prior, mean, inverse Cholesky factor and its log determinant."""

    priors: tuple[float, float]
    means: tuple[np.ndarray, np.ndarray]
    whiten: tuple[np.ndarray, np.ndarray]
    log_det: tuple[float, float]

    def log_density(self, x: list[Column], k: int) -> Column:
        """Log density of class k with its prior, without the common constant."""
        total = F.lit(float(np.log(self.priors[k]) - 0.5 * self.log_det[k]))
        centred = [c - F.lit(float(m)) for c, m in zip(x, self.means[k], strict=True)]
        for row in self.whiten[k]:
            z = sum((F.lit(float(w)) * c for w, c in zip(row, centred, strict=True) if w), F.lit(0.0))
            total = total - F.lit(0.5) * z * z
        return total

    def score(self, x: list[Column]) -> Column:
        """P(label 1 | x)."""
        gap = self.log_density(x, 1) - self.log_density(x, 0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(gap, F.lit(700.0)), F.lit(-700.0))))


@dataclass(frozen=True)
class PriorOnly:
    """For labels of one class at most: the score is the prior."""

    prior: float

    def score(self, x: list[Column]) -> Column:
        return F.lit(self.prior)


class MissingClass(ValueError):
    """Labelled rows of one class only, or none; ``prior`` is the share of label 1."""

    def __init__(self, prior: float):
        super().__init__("labelled rows of both classes are needed")
        self.prior = prior


def fit(rows: DataFrame, label: str, columns: list[str], to_pooled: float = TO_POOLED,
        to_diagonal: float = TO_DIAGONAL) -> QuadraticDiscriminant:
    """Fits on the rows with label 0 or 1, by one aggregation of moments."""
    pairs = [(i, j) for i in range(len(columns)) for j in range(i + 1)]
    moments = (rows.filter(F.col(label).isin(0, 1)).groupBy(F.col(label).cast("int").alias("k"))
               .agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"m{i}") for i, c in enumerate(columns)],
                    *[F.sum(F.col(columns[i]) * F.col(columns[j])).alias(f"p{i}_{j}") for i, j in pairs]).collect())
    by_class = {r["k"]: r for r in moments}
    if set(by_class) != {0, 1}:
        raise MissingClass(float(next(iter(by_class), 0.5)))
    count, mean, scatter = {}, {}, {}
    for k, r in by_class.items():
        count[k] = r["n"]
        mean[k] = np.array([r[f"m{i}"] for i in range(len(columns))]) / r["n"]
        product = np.zeros((len(columns),) * 2)
        for i, j in pairs:
            product[i, j] = product[j, i] = r[f"p{i}_{j}"]
        scatter[k] = product - r["n"] * np.outer(mean[k], mean[k])
    n = count[0] + count[1]
    pooled = (scatter[0] + scatter[1]) / max(n - 2, 1)
    diagonal = np.diag(np.maximum(np.diag(pooled), FLOOR))
    whiten, log_det = [], []
    for k in (0, 1):
        own = scatter[k] / max(count[k] - 1, 1)
        factor = np.linalg.cholesky((1 - to_diagonal) * ((1 - to_pooled) * own + to_pooled * pooled) + to_diagonal * diagonal)
        whiten.append(np.linalg.inv(factor))
        log_det.append(2 * float(np.log(np.diag(factor)).sum()))
    return QuadraticDiscriminant((count[0] / n, count[1] / n), (mean[0], mean[1]), tuple(whiten), tuple(log_det))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that never train: crc32 of the id as text leaves no remainder by 5 (a null id does train)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(stats: DataFrame, labels: DataFrame) -> QuadraticDiscriminant | PriorOnly:
    """Fits ``labels.quality`` on all labelled rows of ``stats`` (``doc_id`` and
    the statistics) outside the held-out fold; only numbers are shuffled, no text."""
    wanted = labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("_y")).filter("_y IS NOT NULL")
    rows = stats.select("doc_id", *STATISTICS).filter(~held_out()).join(wanted, F.col("doc_id") == F.col("_id"))
    try:
        return fit(rows, "_y", STATISTICS)
    except MissingClass as e:
        return PriorOnly(e.prior)


def classify(stats: DataFrame, model: QuadraticDiscriminant | PriorOnly, threshold: float = THRESHOLD) -> DataFrame:
    """Replaces the statistics by ``score`` and ``predicted`` (1 from the threshold on)."""
    rest = [c for c in stats.columns if c not in ("score", "predicted", *STATISTICS)]
    scored = stats.select(*rest, model.score([F.col(c) for c in STATISTICS]).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op10_quality_qda(spark, sf_dir: str) -> DataFrame:
    """Quality scores of every document; labels of the held-out fold aren't read.

    The texts are read once: their statistics are written to the shared
    folder, then fitted and scored from there.
    """
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    stats = saved(with_statistics(docs).drop("text"), "quality-statistics")
    model = train(stats, read_table(spark, sf_dir, "labels", "doc_id", "quality"))
    return classify(stats, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
