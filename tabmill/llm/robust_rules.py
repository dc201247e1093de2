"""Quality rules: base counts, then robust multivariate outliers by language and source.

A document's counts become a vector of five statistics, each on a log scale
and rounded to a fixed grid. For each pool of documents (language and source;
small ones are pooled by language, then all together) the minimum covariance
determinant estimate is found by concentration steps: start from medians and
absolute deviations, then take again and again mean and covariance of the
half of the pool that lies nearest. Half is what withstands most: with a larger
share, a group of alike bad documents that is larger than the rest of the pool
enters the estimate and has a small distance itself. Documents whose
Mahalanobis distance to it is beyond the cutoff are rejected.

All of it is DataFrame expressions. A step is one pass over the staged
vectors that sums by (pool, distance bin), with partial sums on the map side,
so a pool with most of the rows is no heavier for any one task; all sums are of
integers, so the same rows give the same verdicts in any partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabmill.llm.shared import SPACE, staged, text_of

MIN_POOL = 400  # rows; smaller groups are pooled
LEAST_ROWS = 30  # of the last pool; below it only the base rules speak
KEPT_SHARE = 0.5  # of a pool, nearest rows that the estimate rests on
STEPS = 8  # concentration steps at most
GRID = 256  # steps of a statistic's grid for one unit of its log scale
FLOOR = 0.12  # least standard deviation of a statistic, on its log scale
CUTOFF = 60.0  # squared distance; the quantile of chi-squared with 5 degrees of freedom that is passed once in 10^11
BINS = 32  # distance bins for each doubling
HALF_CHI2 = 4.351  # median of chi-squared with 5 degrees of freedom
STATISTICS = ("word_length", "symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate")
D = len(STATISTICS)
_PAIRS = [(i, j) for i in range(D) for j in range(i + 1)]
_BLANK = " \t\n\x0b\f\r"


def _let(value: Column, body) -> Column:
    """body(value) with value computed once for each row, also where body uses it inside a loop."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(w: Column) -> Column:
    """Words inside a 3-word window that the word list `w` holds twice or more.

    A window is the high bits of its hash with its place in the low bits, so
    that sorted neighbours of equal high bits are candidates; their words
    decide.
    """
    n = F.size(w)

    def windows(low: Column) -> Column:
        hashed = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        return F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), lambda i: hashed(i).bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long"))))

    def counted(v: Column, low: Column) -> Column:
        place = lambda k: F.get(v, k).bitwiseAND(low).cast("int")

        def same(k: Column) -> Column:
            equal = F.get(v, k).bitwiseXOR(F.get(v, k + 1)).between(F.lit(0), low)
            for s in range(3):
                equal = equal & (F.get(w, place(k) + s) == F.get(w, place(k + 1) + s))
            return equal

        both = F.filter(F.sequence(F.lit(0), n - 4), same)
        starts = F.array_distinct(F.flatten(F.transform(both, lambda k: F.array(place(k), place(k + 1)))))
        return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda p: F.array(p, p + 1, p + 2)))))

    low = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(n))) - 1
    return F.when(n < 4, F.lit(0)).otherwise(_let(low, lambda low: _let(windows(low), lambda v: counted(v, low))))


def measures(text: Column) -> Column:
    """Struct of a text's counts."""
    def words(w: Column) -> Column:
        n = F.when(w[0] == "", F.lit(0)).otherwise(F.size(w))
        return F.struct(n.alias("n"), _repeat_words(w).alias("repeats"))

    def lines(a: Column) -> Column:
        return F.struct(F.size(a).alias("n"), (F.size(a) - F.size(F.array_distinct(a))).alias("dups"))

    left = lambda pattern: F.length(F.regexp_replace(text, pattern, ""))
    full = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(_BLANK)) != "")
    return F.struct(
        _let(F.split(F.btrim(text, F.lit(_BLANK)), SPACE), words).alias("words"),
        _let(full, lines).alias("lines"),
        left(SPACE).alias("chars"),
        (F.length(text) - left(r"[#*$%&|<>]+")).alias("symbols"),
        (F.length(text) - left(r"\p{Lu}+")).alias("upper"),
    )


def with_statistics(docs: DataFrame, name: str = "_rules", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`keep` (else all columns) and one struct column `name`: counts, base verdict, pool columns, statistics."""
    kept = [F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]
    raw = docs.select(*kept, F.col("lang").cast("string").alias(f"{name}_lang"), F.col("source").cast("string").alias(f"{name}_source"), measures(text_of(text)).alias(f"{name}_m"))
    m = lambda f: F.col(f"{name}_m.{f}").cast("long")
    n, repeats, dups, lines = m("words.n"), m("words.repeats"), m("lines.dups"), m("lines.n")
    words, chars = F.greatest(n, F.lit(1)), F.greatest(m("chars"), F.lit(1))
    values = [
        F.log(chars / words),
        F.log1p(50 * m("symbols") / chars),
        F.log1p(2 * dups / (lines + 8)),
        F.log1p(2 * repeats / (words + 80)),
        F.log((m("upper") + 4) / (chars + 160)),
    ]
    return raw.select(
        *kept,
        F.struct(
            F.coalesce(f"{name}_lang", F.lit("")).alias("lang"), F.coalesce(f"{name}_source", F.lit("")).alias("source"),
            n.alias("n_words"), m("chars").alias("word_chars"), m("symbols").alias("n_symbols"), dups.alias("n_dup_lines"), repeats.alias("n_repeat_words"),
            ((n < 50) | (100 * repeats > 50 * n)).alias("base_failed"),
            *[F.round(GRID * v).cast("long").alias(f"x{i}") for i, v in enumerate(values)],
        ).alias(name),
    )


def _estimate(sums: DataFrame) -> DataFrame:
    """From n, s0.. and p00.. by pool: means m0.. and the rows of the inverse Cholesky factor k00.."""
    out = sums.select("pool", "n", *[(F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in range(D)], *[F.col(f"p{i}{j}") for i, j in _PAIRS])
    least = (FLOOR * GRID) ** 2
    out = out.withColumns({f"c{i}{j}": F.col(f"p{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}") + (least if i == j else 0.0) for i, j in _PAIRS})
    c = lambda i, j, of: F.col(f"{of}{i}{j}")
    for i in range(D):
        for j in range(i + 1):
            rest = c(i, j, "c") - sum((c(i, k, "l") * c(j, k, "l") for k in range(j)), F.lit(0.0))
            out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-6))) if i == j else rest / c(j, j, "l"))
    for i in range(D):
        for j in range(i, -1, -1):
            rest = F.lit(1.0) if i == j else -sum((c(i, k, "l") * c(k, j, "k") for k in range(j, i)), F.lit(0.0))
            out = out.withColumn(f"k{i}{j}", rest / c(i, i, "l"))
    return out.select("pool", "n", *[f"m{i}" for i in range(D)], *[f"k{i}{j}" for i, j in _PAIRS])


def _distance(name: str) -> Column:
    x = [F.col(f"{name}.x{i}") - F.col(f"m{i}") for i in range(D)]
    rows = [sum((F.col(f"k{i}{j}") * x[j] for j in range(1, i + 1)), F.col(f"k{i}0") * x[0]) for i in range(D)]
    return sum((r * r for r in rows[1:]), rows[0] * rows[0])


def fit(stats: DataFrame, name: str = "_rules") -> DataFrame:
    """Estimates from a staged table with the struct column: one row for each language and source.

    Columns: lang, source, pool, n, means, factors, scale. The table has as many
    rows as there are pairs of language and source.
    """
    flat = stats.select(f"{name}.*")
    sizes = flat.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("rows"))
    small = sizes.where(F.col("rows") < MIN_POOL)
    by_lang = small.groupBy("lang").agg(F.sum("rows").alias("lang_rows"))
    pool = F.when(F.col("rows") >= MIN_POOL, F.to_json(F.array("lang", "source"))).when(F.col("lang_rows") >= MIN_POOL, F.to_json(F.array("lang"))).otherwise("[]")
    pools = staged(sizes.join(by_lang, "lang", "left").select("lang", "source", pool.alias("pool")), "rule-pools")
    pooled = flat.join(pools, ["lang", "source"])

    # Exact medians: a statistic has at most a few thousand values on its grid.
    middle = pooled.groupBy("pool").agg(F.count(F.lit(1)).alias("n"), *[F.percentile(f"x{i}", F.lit(0.5)).alias(f"m{i}") for i in range(D)])
    spread = pools.join(middle, "pool")
    off = flat.join(spread, ["lang", "source"]).groupBy("pool").agg(*[F.percentile(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), F.lit(0.5)).alias(f"d{i}") for i in range(D)])
    scale = lambda i: 1 / F.sqrt(F.pow(1.4826 * F.col(f"d{i}"), 2) + (FLOOR * GRID) ** 2)
    now = middle.join(off, "pool").select("pool", "n", *[f"m{i}" for i in range(D)], *[(scale(i) if i == j else F.lit(0.0)).alias(f"k{i}{j}") for i, j in _PAIRS])
    now, seen = staged(now, "rule-estimates"), None
    for _ in range(STEPS):
        now, mark = _step(flat, pools, now)
        if mark == seen:
            break
        seen = mark
    return staged(pools.join(now, "pool"), "rule-estimates")


def _step(flat: DataFrame, pools: DataFrame, now: DataFrame) -> tuple[DataFrame, int]:
    """A concentration step; the mark is a hash of the rows that it chose."""
    met = flat.select(F.struct("lang", "source", *[f"x{i}" for i in range(D)]).alias("v")).join(
        pools.join(now.drop("n"), "pool"), (F.col("v.lang") == F.col("lang")) & (F.col("v.source") == F.col("source")))
    bin_ = F.floor(BINS * F.log2(1 + _distance("v"))).cast("int")
    x = lambda i: F.col(f"v.x{i}")
    sums = met.groupBy("pool", bin_.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(x(i)).alias(f"s{i}") for i in range(D)], *[F.sum(x(i) * x(j)).alias(f"p{i}{j}") for i, j in _PAIRS])
    order = Window.partitionBy("pool").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("pool")
    sums = sums.withColumns({"below": F.coalesce(F.sum("n").over(order), F.lit(0)), "all": F.sum("n").over(whole)})
    # The bin where half of the pool is reached gives the scale of the distances before this step.
    names = ["n", *[f"s{i}" for i in range(D)], *[f"p{i}{j}" for i, j in _PAIRS]]
    chosen = sums.where(F.col("below") < F.ceil(KEPT_SHARE * F.col("all"))).groupBy("pool").agg(*[F.sum(c).alias(c) for c in names])
    half = sums.where(F.col("below") < F.ceil(0.5 * F.col("all"))).groupBy("pool").agg(F.max("bin").alias("half"), F.max("all").alias("rows"))
    scale = F.greatest(F.lit(1.0), (F.pow(2.0, (F.col("half") + 1) / F.lit(float(BINS))) - 1) / HALF_CHI2)
    new = staged(_estimate(chosen).join(half.select("pool", "rows", scale.alias("scale")), "pool"), "rule-estimates")
    return new, new.agg(F.bit_xor(F.xxhash64("pool", *[f"m{i}" for i in range(D)], *[f"k{i}{j}" for i, j in _PAIRS]))).first()[0]


def judged(stats: DataFrame, estimates: DataFrame, name: str = "_rules") -> DataFrame:
    """`stats` with `name`_distance (squared, in units of its pool) and `name`_kept."""
    slim = estimates.select(F.col("lang").alias(f"{name}_l"), F.col("source").alias(f"{name}_s"), F.struct("rows", "scale", *[f"m{i}" for i in range(D)], *[f"k{i}{j}" for i, j in _PAIRS]).alias(f"{name}_e"))
    joined = stats.join(slim, (F.col(f"{name}.lang") == F.col(f"{name}_l")) & (F.col(f"{name}.source") == F.col(f"{name}_s")), "left")
    e = f"{name}_e"
    x = [F.col(f"{name}.x{i}") - F.col(f"{e}.m{i}") for i in range(D)]
    rows = [sum((F.col(f"{e}.k{i}{j}") * x[j] for j in range(1, i + 1)), F.col(f"{e}.k{i}0") * x[0]) for i in range(D)]
    distance = sum((r * r for r in rows[1:]), rows[0] * rows[0]) / F.col(f"{e}.scale")
    outlier = F.coalesce((F.col(f"{e}.rows") >= LEAST_ROWS) & (distance > CUTOFF), F.lit(False))
    return joined.select(*[F.col(f"`{c}`") for c in stats.columns], distance.alias(f"{name}_distance"), (~F.col(f"{name}.base_failed") & ~outlier).alias(f"{name}_kept"))


def verdicts(docs: DataFrame) -> DataFrame:
    """One row for each row of `docs` (doc_id, text, lang, source): base counts, base_failed, kept, distance.

    Cases: null and empty texts have no words, so base_failed; a null language
    or source is a group of its own, together with the empty name; repeated
    rows are judged alike; an empty table gives no rows; a pool of equal rows
    has the floor as its spread, so all are kept; further columns are ignored.
    """
    stats = staged(with_statistics(docs, keep=["doc_id"]), "rule-statistics")
    out = judged(stats, fit(stats))
    return out.select("doc_id", *[f"_rules.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")], F.col("_rules_kept").alias("kept"), F.col("_rules_distance").alias("distance"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their columns as they were."""
    name = "_rules"
    while any(c.startswith(name) for c in docs.columns):
        name = f"_{name}"
    stats = staged(with_statistics(docs, name), "rule-statistics")
    return judged(stats, fit(stats, name), name).where(F.col(f"{name}_kept")).select(*[F.col(f"`{c}`") for c in docs.columns])
