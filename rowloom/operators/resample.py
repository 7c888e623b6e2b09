"""Class resampling: copies, thinning, synthetic rows, neighbour-based cleaning.

All random choices are hashes of row keys or draw numbers. Ranks come from
`hash_rank`, so a class that holds most of the table is never ordered in one task.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.functions.hashing import hash32, hash60, unit_interval
from rowloom.functions.ranking import hash_rank
from rowloom.operators.neighbors import knn_join

DRAWS_PER_ROW = 10_000


def class_counts(df, label) -> dict:
    return {r[label]: r["count"] for r in df.groupBy(label).count().collect()}


def _lookup(column, mapping, dtype="bigint"):
    out = F.lit(None).cast(dtype)
    for value, number in mapping.items():
        out = F.when(F.col(column) == F.lit(value), F.lit(number).cast(dtype)).otherwise(out)
    return out


def _class_draws(spark, extra, n, seed):
    """(_j, _base): draw j < extra takes the row of rank hash(j) mod n. Spread over all tasks by `range`."""
    j = F.col("id")
    return spark.range(extra).select(j.alias("_j"), (hash60(j, seed) % F.lit(n)).alias("_base"))


def _draws(ranked, n, extra, widest):
    """One row per draw number j < extra: the row of rank r makes the draws r, r + n, r + 2n, ...

    Draws start from the rows, so they spread over all tasks. When few rows must
    make very many draws, blocks of draws are dealt out before they are unrolled.
    """
    some = ranked.filter(F.col("rank") < extra)
    rounds = F.floor((extra - 1 - F.col("rank")) / n)  # the last t with rank + t * n < extra
    if widest <= DRAWS_PER_ROW:
        return some.withColumn("_j", F.explode(F.transform(F.sequence(F.lit(0).cast("bigint"), rounds), lambda t: F.col("rank") + t * n)))
    blocks = some.withColumn("_b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(rounds / DRAWS_PER_ROW))))
    spread = blocks.repartition(F.col("rank"), F.col("_b"))
    first = F.col("_b") * DRAWS_PER_ROW
    last = F.least(rounds, first + DRAWS_PER_ROW - 1)
    return spread.withColumn("_j", F.explode(F.transform(F.sequence(first, last), lambda t: F.col("rank") + t * n))).drop("_b")


def random_oversample(df: DataFrame, key, label, targets=None, seed=42) -> DataFrame:
    """Rows plus random copies until each class has its target count (default: parity).

    `copy_no` is 0 for originals. Draw j of a class copies the row whose rank is
    hash(j) mod n, i.e. drawing with replacement.
    """
    counts = class_counts(df, label)
    targets = targets or {c: max(counts.values()) for c in counts}
    extra = {c: t - counts[c] for c, t in targets.items() if t > counts.get(c, t)}
    originals = df.withColumn("copy_no", F.lit(0).cast("bigint"))
    if not extra:
        return originals
    ranked = hash_rank(df.filter(F.col(label).isin(list(extra))), key, by=[label], seed=seed)
    draws = None
    for c, g in extra.items():
        some = _class_draws(df.sparkSession, g, counts[c], seed).withColumn("_label", F.lit(c))
        draws = some if draws is None else draws.unionByName(some)
    copies = ranked.join(draws, (F.col(label) == F.col("_label")) & (F.col("rank") == F.col("_base")))
    return originals.unionByName(copies.withColumn("copy_no", F.col("_j") + 1).select(originals.columns))


def random_undersample(df, key, label, targets=None, seed=42):
    """Random rows without replacement, down to the target count per class (default: parity)."""
    counts = class_counts(df, label)
    targets = targets or {c: min(counts.values()) for c in counts}
    ranked = hash_rank(df, key, by=[label], seed=seed)
    limit = F.coalesce(_lookup(label, targets), F.col("rank_n"))
    return ranked.filter(F.col("rank") < limit).drop("rank", "rank_n")


def smote(df, key, label, features, k=5, seed=42, targets=None, **search) -> DataFrame:
    """(key, label, features, copy_no): all rows, plus synthetic rows up to the largest class.

    Draw j starts at the class row of rank hash(j) mod n, picks one of its k
    nearest rows of the same class and moves a random part of the way there.
    Synthetic rows keep the key of their base row and have copy_no = j + 1.
    """
    features = list(features)
    counts = class_counts(df, label)
    targets = targets or {c: max(counts.values()) for c in counts}
    extra = {c: t - counts[c] for c, t in targets.items() if t > counts.get(c, t)}
    rows = df.select(key, label, *[F.col(f).cast("double").alias(f) for f in features])
    out = rows.withColumn("copy_no", F.lit(0).cast("bigint"))
    for c in sorted(extra):
        if counts[c] < 2:
            raise ValueError(f"class {c} has no neighbours to interpolate with")
        members = rows.filter(F.col(label) == F.lit(c))
        points = members.withColumn("_vec", F.array(*features))
        near = knn_join(members, points, features, key, k, exclude_self=True, carry=["_vec"], **search)
        lists = near.groupBy("query_id").agg(
            F.array_sort(F.collect_list(F.struct("rank", "_vec"))).alias("_near")  # k entries at most
        )
        ranked = hash_rank(members, key, seed=seed)
        bases = ranked.join(lists, F.col(key) == F.col("query_id")).drop("query_id", "rank_n")
        j = F.col("_j")
        draws = _class_draws(df.sparkSession, extra[c], counts[c], seed).withColumnRenamed("_base", "rank")
        pick = F.col("_near")[(hash32(j, seed + 1) % F.size("_near")).cast("int")]["_vec"]
        step = unit_interval(j, seed + 2)
        made = bases.join(draws, "rank").withColumn("_to", pick).withColumn("_u", step)
        synthetic = made.select(
            key, label,
            *[(F.col(f) + F.col("_u") * (F.col("_to")[i] - F.col(f))).alias(f) for i, f in enumerate(features)],
            (j + 1).alias("copy_no"),
        )
        out = out.unionByName(synthetic)
    return out


def tomek_links(df, key, label, features, **search) -> DataFrame:
    """(a, b, label_a, label_b): rows of different classes that are each other's nearest row."""
    near = knn_join(df, df, features, key, 1, exclude_self=True, carry=[label], **search)
    near = near.select(F.col("query_id").alias("q"), F.col("neighbor_id").alias("n"), F.col(label).alias("_other"))
    own = near.join(df.select(F.col(key).alias("q"), F.col(label).alias("_own")), "q")
    crossing = own.filter(F.col("_own") != F.col("_other"))
    low = F.col("q") < F.col("n")
    return (
        crossing.groupBy(F.least("q", "n").alias("a"), F.greatest("q", "n").alias("b"))
        .agg(
            F.count(F.lit(1)).alias("_seen"),
            F.min(F.when(low, F.col("_own")).otherwise(F.col("_other"))).alias("label_a"),
            F.min(F.when(low, F.col("_other")).otherwise(F.col("_own"))).alias("label_b"),
        )
        .filter("_seen = 2")
        .drop("_seen")
    )


def remove_tomek_links(df, key, label, features, remove="majority", **search):
    """Drop the link members of the largest class ('majority') or both ('all')."""
    links = tomek_links(df, key, label, features, **search)
    members = links.select(F.explode(F.array(
        F.struct(F.col("a").alias("id"), F.col("label_a").alias("l")),
        F.struct(F.col("b").alias("id"), F.col("label_b").alias("l")),
    )).alias("m")).select("m.*")
    if remove == "majority":
        counts = class_counts(df, label)
        biggest = min(counts, key=lambda c: (-counts[c], c))
        members = members.filter(F.col("l") == F.lit(biggest))
    return df.join(members.select(F.col("id").alias(key)), key, "left_anti")


def edited_nearest_neighbours(df, key, label, features, k=3, classes=None, **search):
    """Keep rows whose k nearest rows all share their class; other classes than `classes` stay."""
    near = knn_join(df, df, features, key, k, exclude_self=True, carry=[label], **search)
    near = near.select(F.col("query_id").alias(key), F.col(label).alias("_other"))
    votes = near.groupBy(key).agg(F.min("_other").alias("_lo"), F.max("_other").alias("_hi"))
    agreed = (F.col("_lo") == F.col(label)) & (F.col("_hi") == F.col(label))
    if classes is not None:
        agreed = agreed | ~F.col(label).isin(list(classes))
    return df.join(votes, key).filter(agreed).drop("_lo", "_hi")


def _with_row_key(balanced, key):
    """Synthetic rows share their base key; a (key, copy) text tells all rows apart."""
    return balanced.withColumn("row_key", F.format_string("%s#%012d", F.col(key).cast("string"), F.col("copy_no")))


def smote_tomek(df, key, label, features, k=5, seed=42, **search):
    """Synthetic balance, then both members of every Tomek link leave."""
    balanced = _with_row_key(smote(df, key, label, features, k, seed, **search), key)
    return remove_tomek_links(balanced, "row_key", label, features, remove="all", **search)


def smote_enn(df, key, label, features, k=5, enn_k=3, seed=42, **search):
    """Synthetic balance, then rows whose neighbours disagree leave."""
    balanced = _with_row_key(smote(df, key, label, features, k, seed, **search), key)
    return edited_nearest_neighbours(balanced, "row_key", label, features, enn_k, **search)


def adjust_proportion(df, key, target, group_columns, factor=2, seed=42) -> DataFrame:
    """Per group column and value with both classes: majority x factor, minority // factor.

    The rows come back once per group column (`group_column`, `group_value`); groups
    with a single class are left out. Majority copies are drawn with replacement,
    the minority is thinned without. Equal counts: the smaller class is the majority.
    """
    spread = df.withColumn("_g", F.explode(F.array(*[
        F.struct(F.lit(g).alias("group_column"), F.col(g).cast("string").alias("group_value")) for g in group_columns
    ]))).select("*", "_g.*").drop("_g").filter("group_value is not null")
    group = ["group_column", "group_value"]
    counts = spread.groupBy(*group, target).agg(F.count(F.lit(1)).alias("n"))
    plan = counts.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_classes"),
        F.min_by(target, F.struct(-F.col("n"), F.col(target))).alias("_majority"),
    ).filter("_classes = 2").drop("_classes")
    ranked = hash_rank(spread, key, by=[*group, target], seed=seed).join(plan, group)
    is_major = F.col(target) == F.col("_majority")
    minority = ranked.filter(~is_major & (F.col("rank") < F.floor(F.col("rank_n") / F.lit(factor))))
    majority = ranked.filter(is_major)
    extra = F.floor(F.col("rank_n") * F.lit(float(factor))) - F.col("rank_n")
    draws = _draws(majority.select(*group, "rank", "rank_n"), F.col("rank_n"), extra, factor).select(
        *group, "_j", (hash60(F.col("_j"), seed) % F.col("rank_n")).alias("rank")
    )
    copies = majority.join(draws, [*group, "rank"]).withColumn("copy_no", F.col("_j") + 1)
    cols = [*df.columns, *group, "copy_no"]
    zero = F.lit(0).cast("bigint")
    return (
        majority.withColumn("copy_no", zero).select(cols)
        .unionByName(minority.withColumn("copy_no", zero).select(cols))
        .unionByName(copies.select(cols))
    )
