"""Quality rules with robust multivariate outliers, in DataFrame functions only.

Base counters per text feed base rules and four transformed statistics.  Per
language and source a regularised minimum-covariance-determinant estimate of
their centre and scatter is fitted (deterministic start at the coordinate-wise
medians, then concentration steps on the most central share of the rows, scatter
made consistent and regularised towards a diagonal target as in Boudt et al.,
"The minimum regularized covariance determinant estimator", 2020); texts beyond
the chi-square cut by squared Mahalanobis distance are rejected.

Every step is an aggregation of sums and counts: order statistics come from
histograms with a bounded number of bins per group, sums run over integers, so
results don't depend on partitioning, and no group meets in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, words_of

STATS = ("word_length", "symbols", "dup_lines", "repeats")
D = len(STATS)
#: Statistics are integers in this unit from here on.
UNIT = 10_000


@dataclass(frozen=True)
class Rules:
    """Parameters of the base rules and of the estimate.

    ``share`` of a group's most central rows is what the estimate is made of and
    ``consistency`` makes its scatter unbiased for a normal bulk (for 0.75 and four
    dimensions); ``cut`` is the 0.99999 quantile of chi-square with four degrees of
    freedom; ``steps`` concentration steps are made from the one deterministic start,
    without restarts (more steps change no verdict on the given documents);
    ``floors`` are the least standard deviations of the statistics, so wide that one
    repeated line in a short text is no outlier by itself, but half of all lines are;
    repeated words are an outlier only together with something else, as the base rule
    already rejects a fifth of them;
    sources with fewer than ``least`` rows of a language are pooled per language,
    and a pool that is still smaller has no estimate and rejects nothing.
    """

    min_words: int = 10
    max_repeat_percent: int = 20
    share: float = 0.75
    consistency: float = 1.486
    steps: int = 3
    cut: float = 28.47
    floors: tuple[float, ...] = (0.15, 0.6, 0.75, 1.0)
    least: int = 40
    bins: int = 64


def counters(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Base counters of every text; null texts count as empty.

    Windows of five words are compared by a 64-bit hash.  Only a text in which two
    windows agree is sorted to find which.
    """
    text = F.coalesce(F.col("__t"), F.lit(""))
    a = docs.select(*keep, F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("__t"))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    b = a.select("*", words_of(F.col("__t")).alias("__w"), lines.alias("__l"))
    gram = lambda i: F.xxhash64(*[F.get(F.col("__w"), i + k) for k in range(5)])
    n = F.size("__w")
    c = b.select(
        *keep, "doc_id", n.cast("long").alias("n_words"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.size("__l").cast("long").alias("n_lines"), (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.when(n >= 5, F.transform(F.sequence(F.lit(0), F.greatest(n - 5, F.lit(0))), gram)).otherwise(F.array().cast("array<bigint>")).alias("__g"),
    )
    twice = F.size(F.array_distinct("__g")) < F.size("__g")
    placed = F.sort_array(F.transform("__g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = c.select("*", F.when(twice, placed).alias("__s")).drop("__g")
    near = lambda x, k: (F.get(F.col("__s"), k - 1)["h"] == x["h"]) | (F.get(F.col("__s"), k + 1)["h"] == x["h"])
    e = d.select("*", F.sort_array(F.transform(F.filter("__s", near), lambda x: x["i"])).alias("__p")).drop("__s")
    first = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    step = lambda s, p: F.struct((p + 5).alias("end"), (s["n"] + (p + 5 - F.greatest(p, s["end"]))).alias("n"))
    covered = F.aggregate("__p", first, step)["n"]
    return e.select("*", F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words")).drop("__p")


def _statistics(rules: Rules) -> list[Column]:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    lines = F.greatest(F.col("n_lines"), F.lit(1)).cast("double")
    raw = (1 + F.col("word_chars") / n, 1 + 100 * F.col("n_symbols") / n, 1 + 100 * F.col("n_dup_lines") / lines, 1 + 100 * F.col("n_repeat_words") / n)
    return [F.floor(F.log(x) * UNIT + 0.5).cast("long").alias(f"q{i}") for i, x in enumerate(raw)]


def _groups(stats: DataFrame, rules: Rules) -> DataFrame:
    """``own`` (a row's language and source) and ``g``, the group whose estimate holds for it; a row per ``own`` that has one."""
    sizes = stats.groupBy("lang_key", "own").agg(F.count("*").alias("n"))
    pooled = F.col("n") < rules.least
    sizes = sizes.select("own", F.when(pooled, F.concat_ws("\x01", "lang_key", F.lit("\x03"))).otherwise(F.col("own")).alias("g"), "n")
    pools = sizes.groupBy("g").agg(F.sum("n").alias("n")).where(F.col("n") >= rules.least)
    return cut(sizes.drop("n").join(pools.select("g"), "g"), "quality-groups")


def _order(rows: DataFrame, keys: list[str], value: str, rank: Column, name: str) -> DataFrame:
    """Per group of ``keys`` the least ``value`` at which the running count reaches ``rank`` (of ``total``)."""
    w = Window.partitionBy(*keys)
    counts = rows.groupBy(*keys, value).agg(F.count("*").alias("c"))
    run = counts.select("*", F.sum("c").over(w.orderBy(value)).alias("run"), F.sum("c").over(w).alias("total"))
    return run.where(F.col("run") >= rank).groupBy(*keys).agg(F.min(value).alias(name), F.first("total").alias("total"))


def _distance(centre: list[Column], root: dict[tuple[int, int], Column]) -> Column:
    """Squared Mahalanobis distance by forward substitution with a Cholesky root."""
    out, y = F.lit(0.0), []
    for i in range(D):
        x = F.col(f"q{i}") / F.lit(float(UNIT)) - centre[i]
        for j in range(i):
            x = x - root[i, j] * y[j]
        y.append(x / root[i, i])
        out = out + y[i] * y[i]
    return out


def _cholesky(m: DataFrame) -> DataFrame:
    """Add the lower root ``l{i}{j}`` of the scatter ``v{i}{j}``, a row per group."""
    for i in range(D):
        for j in range(i + 1):
            x = F.col(f"v{i}{j}")
            for k in range(j):
                x = x - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            m = m.withColumn(f"l{i}{j}", F.sqrt(x) if i == j else x / F.col(f"l{j}{j}"))
    return m


def estimates(stats: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per group ``g``: centre ``m{i}`` and Cholesky root ``l{i}{j}`` of the scatter.

    ``stats`` has ``g`` and the integer statistics ``q0`` to ``q3``; rows without a
    group take no part.
    """
    rows = stats.where("g is not null").select("g", *[f"q{i}" for i in range(D)])
    long = rows.select("g", F.posexplode(F.array(*[F.col(f"q{i}") for i in range(D)])).alias("i", "q")).withColumn("q", F.floor(F.col("q") / 10) * 10)
    middle = _order(long, ["g", "i"], "q", F.ceil(F.col("total") / 2), "mid")
    now = middle.groupBy("g").agg(*[(F.max(F.when(F.col("i") == i, F.col("mid"))) / F.lit(float(UNIT))).alias(f"m{i}") for i in range(D)])
    for i in range(D):
        for j in range(i + 1):
            now = now.withColumn(f"l{i}{j}", F.lit(rules.floors[i] if i == j else 0.0))
    now = cut(now, "quality-start")
    centre, root = [F.col(f"m{i}") for i in range(D)], {(i, j): F.col(f"l{i}{j}") for i in range(D) for j in range(i + 1)}
    for _ in range(rules.steps):
        near = rows.join(now, "g").select("g", *[f"q{i}" for i in range(D)], F.floor(F.log1p(_distance(centre, root)) * rules.bins).alias("bin"))
        bound = cut(_order(near.select("g", "bin"), ["g"], "bin", F.ceil(F.col("total") * rules.share), "most").select("g", "most"), "quality-bound")
        whole = lambda x: F.sum(x.cast("decimal(20,0)")).cast("double")
        sums = [F.count("*").alias("n"), *[whole(F.col(f"q{i}")).alias(f"s{i}") for i in range(D)], *[whole(F.col(f"q{i}") * F.col(f"q{j}")).alias(f"s{i}{j}") for i in range(D) for j in range(i + 1)]]
        m = near.join(bound, "g").where("bin <= most").groupBy("g").agg(*sums)
        m = m.select("g", "n", *[(F.col(f"s{i}") / F.col("n") / UNIT).alias(f"m{i}") for i in range(D)], *[(F.col(f"s{i}{j}") / F.col("n") / UNIT / UNIT).alias(f"e{i}{j}") for i in range(D) for j in range(i + 1)])
        ridge = lambda i, j: rules.floors[i] ** 2 if i == j else 0.0
        m = m.select("g", *[f"m{i}" for i in range(D)], *[(rules.consistency * (F.col(f"e{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}")) + ridge(i, j)).alias(f"v{i}{j}") for i in range(D) for j in range(i + 1)])
        now = cut(_cholesky(m).select("g", *[f"m{i}" for i in range(D)], *[f"l{i}{j}" for i in range(D) for j in range(i + 1)]), "quality-step")
    return now


def judge(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Counters and verdicts, a row per document.

    Returns ``keep``, ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``kept`` and ``distance``
    (squared; null where there is no estimate).  Null and empty texts have no word
    and fail the base rules; null languages and sources are values of their own;
    repeated rows each count and get equal verdicts; ties with the cut are kept; an
    empty table gives an empty one; other columns are ignored.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("\x02"))
    named = docs.select(*keep, F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), part("lang").alias("lang_key"), F.concat_ws("\x01", part("lang"), part("source")).alias("own"))
    base = counters(named, "__id", "__text", (*keep, "lang_key", "own"))
    base = cut(base.select("*", *_statistics(rules)), "quality-stats")
    groups = _groups(base, rules)
    fit = groups.join(estimates(base.join(groups, "own"), rules), "g").drop("g")
    centre, root = [F.col(f"m{i}") for i in range(D)], {(i, j): F.col(f"l{i}{j}") for i in range(D) for j in range(i + 1)}
    failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
    far = F.coalesce(F.col("distance") > rules.cut, F.lit(False))
    # a row per language and source, so small that rows are judged where they are, or else a join that Spark may split
    scored = base.join(cut(fit, "quality-fit"), "own", "left").select(*base.columns, _distance(centre, root).alias("distance"), failed.alias("base_failed"))
    return scored.select(*keep, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~far).alias("kept"), "distance")
