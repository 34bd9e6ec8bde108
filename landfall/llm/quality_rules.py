"""Quality rules: robust multivariate outliers by minimum covariance determinant.

Every whole text gives five transformed statistics: log of its words, of their
mean length, and of its shares of symbols, repeated lines and repeated
three-word windows. For each language and source, the estimate of location and
scatter comes from concentration steps: distances under the estimate so far,
the ``core`` nearest share of the rows, mean and covariance of those, the latter
with the normal law's factor for such a core. Rows at the core's border enter
with the weight that fills it, so that equal copies do not swell it. The steps
run from three starts, all at the medians: median deviations without and with
the correlations of the rows' hyperbolic tangents, and with those of their
directions. Of these, the one of least determinant is kept. Shares are zero in
most clean texts, so each statistic has a least spread. The last scatter is
widened where the median distance is above that of the normal law, and rows
whose squared Mahalanobis distance exceeds the quantile ``trust`` are rejected.
Groups of fewer than ``least_rows`` rows are judged with the other small groups.

Medians and the core's border are read from counts of rows by fine steps of
the measure, so a group of any size is aggregated partially and nothing is
sorted in one task. All is DataFrame functions: the factor of each group's
covariance is computed by columns.

Defined results: a null text has no words; null language or source is a group
of its own; texts without a word have base_failed and no verdict of the method;
repeated rows get equal results; an empty table gives no rows.
"""

from __future__ import annotations

from math import erf, exp, gamma
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import BLANKS, beside, quoted, staged, text_of

SYMBOLS = "#*$%&|<>"
#: Statistics and the least standard deviation that each is taken to have.
LEAST_SPREAD = {"words": 0.3, "word_length": 0.1, "symbols": 0.3, "lines": 0.5, "repeats": 0.5}
_STEPS = 200  # of a measure's scale: a step is half a hundredth


def base_statistics(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """Counts of every text; what its windows repeat is counted once a window is known to repeat."""
    text = F.col("text")
    rows = docs.select(
        F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(lang_col)).cast("string").alias("lang"),
        F.col(quoted(source_col)).cast("string").alias("source"), text_of(text_col).alias("text"),
    )
    blanks = "[\\x20\\x09-\\x0D]+"
    words = F.split(F.trim(text, F.lit(BLANKS)), blanks)
    counted = rows.select(
        "doc_id", "lang", "source",
        F.char_length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(BLANKS)) != "").alias("lines"), words.alias("words"),
    )
    counted = counted.select(
        "doc_id", "lang", "source", "word_chars", "n_symbols",
        F.when(F.col("word_chars") == 0, 0).otherwise(F.size("words")).cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("words") > 2, F.transform(
            F.sequence(F.lit(0), F.size("words") - 3),
            lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)),
        )).otherwise(F.array().cast("array<bigint>")).alias("windows"),
    )
    # Only texts in which a window comes again sort their windows.
    counted = counted.withColumn("again", F.size(F.array_distinct("windows")) < F.size("windows"))
    counted = counted.withColumn("placed", F.when(F.col("again"), F.array_sort(
        F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )))
    same = F.filter(
        F.transform("placed", lambda w, k: F.when(
            (w.h == F.get("placed", k - 1).h) | (w.h == F.get("placed", k + 1).h), w.i
        )), lambda i: i.isNotNull(),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform(same, lambda i: F.array(i, i + 1, i + 2)))))
    return counted.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        F.when(F.col("again"), covered).otherwise(0).cast("long").alias("n_repeat_words"),
    )


def transformed(rows: DataFrame) -> DataFrame:
    """The vector of each row with words."""
    def share(part: str, whole: str) -> Column:
        return F.ln(1 + 100 * F.try_divide(part, whole))

    return rows.withColumns({
        "words": F.ln(F.nullif("n_words", F.lit(0)).cast("double")), "word_length": F.ln(F.try_divide("word_chars", "n_words")),
        "symbols": share("n_symbols", "word_chars"), "lines": share("n_dup_lines", "n_lines"), "repeats": share("n_repeat_words", "n_words"),
    })


def _border(rows: DataFrame, share: float) -> DataFrame:
    """For each group the step in which ``share`` of its rows is reached, and the weight of that step's rows that makes it exact."""
    steps = rows.groupBy("group", "step").count()
    upto = steps.select(
        "group", "step", "count", F.sum("count").over(Window.partitionBy("group").orderBy("step")).alias("upto"),
        F.sum("count").over(Window.partitionBy("group")).alias("all"),
    ).filter(F.col("upto") >= share * F.col("all"))
    weight = 1 - (F.col("upto") - share * F.col("all")) / F.col("count")
    return upto.groupBy("group").agg(F.min("step").alias("border"), F.min_by(weight, "step").alias("part"))


def _quantile(rows: DataFrame, value: str, share: float, name: str) -> DataFrame:
    """For each group the least step under which ``share`` of its rows lie."""
    found = _border(rows.select("group", F.floor(F.col(value) * _STEPS).alias("step")), share)
    return found.select("group", ((F.col("border") + 1) / _STEPS).alias(name))


def _distance(rows: DataFrame, axes: list[str]) -> DataFrame:
    """Squared Mahalanobis distance by forward substitution with the group's factor."""
    for i, axis in enumerate(axes):
        rest = F.col(axis) - F.col(f"mean_{i}")
        for j in range(i):
            rest = rest - F.col(f"f_{i}_{j}") * F.col(f"y_{j}")
        rows = rows.withColumn(f"y_{i}", rest / F.col(f"f_{i}_{i}"))
    total = sum((F.col(f"y_{i}") * F.col(f"y_{i}") for i in range(1, len(axes))), F.col("y_0") * F.col("y_0"))
    return rows.withColumn("d2", total)


def _factor(moments: DataFrame, axes: list[str], scale: Column) -> DataFrame:
    """Means, the lower triangular factor of the covariance, floors included, and the log of its determinant's root."""
    out = moments
    for i, axis in enumerate(axes):
        for j in range(i + 1):
            value = F.col(f"c_{i}_{j}") * scale + (LEAST_SPREAD[axis] ** 2 if i == j else 0.0)
            for k in range(j):
                value = value - F.col(f"f_{i}_{k}") * F.col(f"f_{j}_{k}")
            out = out.withColumn(f"f_{i}_{j}", F.sqrt(F.greatest(value, F.lit(1e-9))) if i == j else value / F.col(f"f_{j}_{j}"))
    names = [f"mean_{i}" for i in range(len(axes))] + [f"f_{i}_{j}" for i in range(len(axes)) for j in range(i + 1)]
    log_det = sum((F.ln(f"f_{i}_{i}") for i in range(1, len(axes))), F.ln("f_0_0"))
    return out.select("group", *names, log_det.alias("log_det"))


def _pairs(axes: list[str]) -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(axes)) for j in range(i + 1)]


def _moments(rows: DataFrame, axes: list[str]) -> DataFrame:
    """Means and covariances of the rows by their weight."""
    pairs, weight = _pairs(axes), F.col("weight")
    sums = rows.groupBy("group").agg(
        F.sum(weight).alias("total"), *(F.sum(weight * F.col(a)).alias(f"s_{i}") for i, a in enumerate(axes)),
        *(F.sum(weight * F.col(axes[i]) * F.col(axes[j])).alias(f"s_{i}_{j}") for i, j in pairs),
    )
    means = {f"mean_{i}": F.col(f"s_{i}") / F.col("total") for i in range(len(axes))}
    return sums.withColumns(means).withColumns(
        {f"c_{i}_{j}": F.col(f"s_{i}_{j}") / F.col("total") - F.col(f"mean_{i}") * F.col(f"mean_{j}") for i, j in pairs}
    )


def _tagged(start: int, group: Column) -> Column:
    """The group as one start's; its first character tells which."""
    return F.concat(F.lit(str(start)), group)


def _first_estimates(rows: DataFrame, axes: list[str]) -> DataFrame:
    """Medians and median deviations, by start with different correlations."""
    out = None
    for i, axis in enumerate(axes):
        middle = staged(_quantile(rows, axis, 0.5, f"mean_{i}"), "middle")
        apart = beside(rows.select("group", axis), middle, ["group"]).withColumn("apart", F.abs(F.col(axis) - F.col(f"mean_{i}")))
        both = middle.join(_quantile(apart, "apart", 0.5, f"mad_{i}"), "group")
        out = both if out is None else out.join(both, "group")
    spread = {f"mad_{i}": F.sqrt((1.4826 * F.col(f"mad_{i}")) ** 2 + LEAST_SPREAD[a] ** 2) for i, a in enumerate(axes)}
    out = staged(out.withColumns(spread), "medians")
    scaled = beside(rows, out, ["group"]).select(
        "group", *(((F.col(a) - F.col(f"mean_{i}")) / F.col(f"mad_{i}")).alias(a) for i, a in enumerate(axes))
    )
    length = F.sqrt(sum((F.col(a) * F.col(a) for a in axes[1:]), F.col(axes[0]) * F.col(axes[0])) + F.lit(1e-12))
    bent = scaled.select(_tagged(1, F.col("group")).alias("group"), *(F.tanh(a).alias(a) for a in axes))
    turned = scaled.select(_tagged(2, F.col("group")).alias("group"), *((F.col(a) / length).alias(a) for a in axes))
    shapes = _moments(bent.unionByName(turned).withColumn("weight", F.lit(1.0)), axes).select(
        F.col("group").alias("tagged"), F.expr("substring(group, 2)").alias("group"), *(f"c_{i}_{j}" for i, j in _pairs(axes))
    )
    plain = out.select(
        _tagged(0, F.col("group")).alias("tagged"), "group", *(F.lit(float(i == j)).alias(f"c_{i}_{j}") for i, j in _pairs(axes))
    )
    related = {}
    for i, j in _pairs(axes):
        share = F.try_divide(f"c_{i}_{j}", F.sqrt(F.greatest(F.col(f"c_{i}_{i}") * F.col(f"c_{j}_{j}"), F.lit(0.0))))
        related[f"c_{i}_{j}"] = F.col(f"mad_{i}") * F.col(f"mad_{j}") * (1.0 if i == j else F.coalesce(share, F.lit(0.0)))
    joined = plain.unionByName(shapes).join(out, "group").withColumns(related).drop("group")
    return _factor(joined.withColumnRenamed("tagged", "group"), axes, F.lit(1.0))


def chi2_quantile(share: float, axes: int) -> float:
    """By Wilson and Hilferty's cube."""
    z = NormalDist().inv_cdf(share)
    return axes * (1 - 2 / (9 * axes) + z * (2 / (9 * axes)) ** 0.5) ** 3


def chi2_share(value: float, axes: int) -> float:
    """The share below ``value``, upwards from one or two axes."""
    share, at = (erf((value / 2) ** 0.5), 1) if axes % 2 else (1 - exp(-value / 2), 2)
    while at < axes:
        share -= (value / 2) ** (at / 2) * exp(-value / 2) / gamma(at / 2 + 1)
        at += 2
    return share


def consistency(core: float, axes: int) -> float:
    """What the covariance of the nearest ``core`` share of normal rows has to be multiplied by."""
    return core / chi2_share(chi2_quantile(core, axes), axes + 2)


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    core: float = 0.5, rounds: int = 4, trust: float = 1 - 1e-9, least_rows: int = 50,
) -> DataFrame:
    """Counts, squared distance and verdict of every row."""
    axes = list(LEAST_SPREAD)
    counts = staged(base_statistics(docs, id_col, text_col, lang_col, source_col), "counts")
    named = counts.withColumn("group", F.to_json(F.struct("lang", "source")))
    sizes = staged(named.filter("n_words > 0").groupBy("group").agg(F.count("*").alias("rows")), "sizes")
    grouped = beside(named, sizes, ["group"], "left").withColumn(
        "group", F.when(F.col("rows") >= least_rows, F.col("group")).otherwise("")
    ).drop("rows")
    vectors = staged(transformed(grouped), "vectors")
    rows = vectors.filter("n_words > 0").select("group", *axes)
    estimate = staged(_first_estimates(rows, axes), "estimate")
    tags = F.explode(F.array(*(_tagged(i, F.col("group")) for i in range(3))))
    tagged = rows.select(tags.alias("group"), *axes)
    widened = F.lit(consistency(core, len(axes)))
    for _ in range(rounds):
        near = _distance(beside(tagged, estimate, ["group"]), axes).select("group", *axes, F.floor(F.ln(F.col("d2") + 1e-6) * _STEPS).alias("step"))
        inner = beside(near, staged(_border(near, core), "border"), ["group"]).filter("step <= border")
        weight = F.when(F.col("step") < F.col("border"), F.lit(1.0)).otherwise(F.col("part"))
        moments = staged(_moments(inner.select("group", *axes, weight.alias("weight")), axes), "moments")
        estimate = staged(_factor(moments, axes, widened), "estimate")
    values = [c for c in estimate.columns if c != "group"]
    best = estimate.groupBy(F.expr("substring(group, 2)").alias("base")).agg(
        F.min_by(F.struct(*values), F.struct("log_det", "group")).alias("least")
    )
    estimate = staged(best.select(F.col("base").alias("group"), "least.*"), "estimate")
    near = _distance(beside(rows, estimate, ["group"]), axes).withColumn("log_d2", F.ln(F.col("d2") + 1e-6))
    middle = _quantile(near.select("group", "log_d2"), "log_d2", 0.5, "middle")
    scaled = estimate.join(middle.withColumn("scale", F.greatest(F.lit(1.0), F.exp("middle") / chi2_quantile(0.5, len(axes)))), "group")
    judged = _distance(beside(vectors, staged(scaled.drop("middle"), "scaled"), ["group"], "left"), axes)
    distance = F.when(F.col("n_words") > 0, F.col("d2") / F.col("scale"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    far = F.coalesce(distance > chi2_quantile(trust, len(axes)), F.lit(False))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & ~far).alias("kept"), distance.alias("distance"),
    )
