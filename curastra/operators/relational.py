"""Relational idioms: ordered dedup, resume, lookups, deficits, chunks, limits, and the counts that reports use.

Order never comes from files: every operator that needs it takes an ordering column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import fingerprint, prefix_hash
from .scratch import cut

#: Most rows of a lookup side that is broadcast after being counted.
BROADCAST_ROWS = 1_000_000


def _small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcast if a counted, narrow table is small; otherwise left to a shuffle join."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def where_computed(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that satisfy a condition on costly computed columns.

    A plain filter would be pushed through the projection that computes them, with a copy of every expression, and each
    copy runs again. A row id that is made beside them, and that the filter reads, keeps it where it stands.
    """
    marked = df.withColumn("_row", F.monotonically_increasing_id())
    return marked.where(condition & (F.col("_row") >= 0)).drop("_row")


# dedup


def keep_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key. Only the row's own columns are kept; among equal order values the least hash of the row wins.

    ``min_by`` on a struct of the row sums before the shuffle, so that a hot key is one row per task. Columns that hold maps
    take no part in the hash.
    """
    hashed = [F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()]
    least = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order], F.xxhash64(*hashed))
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), least).alias("_row"))
    return picked.select("_row.*")


def dedup_fingerprint(df: DataFrame, text: str, order: str) -> DataFrame:
    """Keep first by the eight-digit fingerprint of the text."""
    marked = df.withColumn("_fp", fingerprint(text))
    return keep_first(marked, ["_fp"], [order]).drop("_fp")


def dedup_prefix(df: DataFrame, text: str, order: str, seen: DataFrame | None = None) -> DataFrame:
    """Keep first by the hash of the text's first 100 characters, and none whose hash is in ``seen`` (column h)."""
    marked = df.withColumn("_h", prefix_hash(text))
    if seen is not None:
        marked = marked.join(seen.select(F.col("h").alias("_h")).distinct(), "_h", "left_anti")
    return keep_first(marked, ["_h"], [order]).drop("_h")


def drop_unchanged(df: DataFrame, evolved: str, original: str) -> DataFrame:
    """Evolutions that are empty or equal to their parent go."""
    return df.where((F.coalesce(F.col(evolved), F.lit("")) != "") & (F.col(evolved) != F.coalesce(F.col(original), F.lit(""))))


# joins


def resume(todo: DataFrame, done: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key isn't done yet."""
    return todo.join(done.select(*on).distinct(), on, "left_anti")


def append_new(existing: DataFrame, batch: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of a batch to append: first of each key, none that exists; rows with a null key always."""
    keyed = keep_first(batch.where(F.col(key).isNotNull()), [key], [order])
    return resume(keyed, existing.where(F.col(key).isNotNull()), [key]).unionByName(batch.where(F.col(key).isNull()))


def question_lookup(rows: DataFrame, lookup: DataFrame, key: str = "index") -> DataFrame:
    """Inner join on dataset (lower-cased), split and an integer index; other indices find nothing."""
    index = F.when(F.col(key).rlike(r"^\s*[+-]?\d+\s*$"), F.trim(F.col(key)).try_cast("long"))
    probe = rows.withColumn("_d", F.lower("dataset")).withColumn("_i", index)
    build = lookup.select(F.col("dataset").alias("_d"), F.col("split"), F.col("position").alias("_i"), F.col("question"))
    return probe.join(build, ["_d", "split", "_i"]).drop("_d", "_i")


def with_config(df: DataFrame, config: DataFrame, key: str, value: str, default: str) -> DataFrame:
    """``value`` of a small config table by ``key``, else the default."""
    side = config.select(key, F.col(value).alias("_v"))
    return df.join(_small(side), key, "left").withColumn(value, F.coalesce("_v", F.lit(default))).drop("_v")


def deficit(topics: DataFrame, levels: DataFrame, existing: DataFrame, target: int) -> DataFrame:
    """topic, difficulty, needed: how many more each pair needs, where any; both lists are small config tables."""
    have = existing.groupBy("topic", "difficulty").agg(F.count("*").alias("have"))
    pairs = topics.select("topic", F.explode(F.lit([r[0] for r in levels.select("difficulty").distinct().collect()])).alias("difficulty"))
    need = pairs.join(have, ["topic", "difficulty"], "left").withColumn("needed", F.lit(target) - F.coalesce("have", F.lit(0)))
    return need.where("needed > 0").select("topic", "difficulty", F.col("needed").cast("long").alias("needed"))


def deficit_rows(needs: DataFrame) -> DataFrame:
    """One row per missing item, numbered from 1."""
    return needs.withColumn("item", F.explode(F.sequence(F.lit(1).cast("long"), F.col("needed"))))


def combine(left: DataFrame, name: str, values: list) -> DataFrame:
    """Every row with every value of a short fixed list."""
    return left.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def keep_unless_none(df: DataFrame, keep: Column) -> DataFrame:
    """Rows that satisfy ``keep``; all rows if none does. The test is a one-row aggregate, joined by broadcast."""
    flagged = df.withColumn("_keep", F.coalesce(keep, F.lit(False)))
    any_ = flagged.agg(F.coalesce(F.bool_or("_keep"), F.lit(False)).alias("_any"))
    return flagged.join(F.broadcast(any_), F.col("_keep") | ~F.col("_any")).drop("_keep", "_any")


# order: numbering, chunks, limits


def numbered(df: DataFrame, order: list[str | Column], name: str = "rn", parts: int | None = None) -> DataFrame:
    """Rows numbered from 1 over the whole table, without moving them into one task.

    Rows are range-partitioned by the order, numbered inside partitions, and shifted by the counts of earlier ones. The
    ranges are checkpointed: they come from a sample, and counts and rows must see the same ones.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut(df.repartitionByRange(parts, *cols).sortWithinPartitions(*cols).withColumn("_mid", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("_part", F.shiftright("_mid", 33)).withColumn("_at", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", before.alias("_before"))
    return ranged.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_at") + F.col("_before") + 1).drop("_mid", "_part", "_at", "_before")


def running_index(df: DataFrame, by: str, order: str, name: str = "index") -> DataFrame:
    """Rows numbered from 1 within each value of ``by``, in order.

    The whole table is numbered by (by, order) over ranges, and each group's first number is taken off: a hot group is
    spread over many tasks.
    """
    rows = numbered(df, [by, order], "_rn")
    first = rows.groupBy(F.col(by).alias("_by")).agg(F.min("_rn").alias("_first"))
    return rows.join(_small(first), F.col(by).eqNullSafe(F.col("_by"))).withColumn(name, (F.col("_rn") - F.col("_first") + 1).cast("int")).drop("_rn", "_by", "_first")


def contiguous_chunk(df: DataFrame, order: list[str], chunks: int, chunk: int | None = None) -> DataFrame:
    """Rows with ``chunk_id``: runs of ceil(n / chunks) rows in order; only one chunk, if it is given."""
    n = F.broadcast(df.agg(F.count("*").alias("_total")))
    out = numbered(df, order).join(n).withColumn("chunk_id", F.floor((F.col("rn") - 1) / F.ceil(F.col("_total") / chunks)).cast("long")).drop("rn", "_total")
    return out if chunk is None else out.where(F.col("chunk_id") == chunk)


def modulo_chunk(df: DataFrame, position: str, chunks: int, chunk: int) -> DataFrame:
    return df.where(F.pmod(F.col(position), F.lit(chunks)) == chunk)


def first_n(df: DataFrame, order: list[str], n: int, offset: int = 0) -> DataFrame:
    """A slice in order; Spark keeps the n least rows of each task, not a sorted table."""
    ordered = df.orderBy(*order)
    return (ordered.offset(offset) if offset else ordered).limit(n)


def flag_first(df: DataFrame, order: list[str], n: int, name: str = "chosen") -> DataFrame:
    return numbered(df, order, "_rn").withColumn(name, F.col("_rn") <= n).drop("_rn")


def longest(values: Column | str) -> Column:
    """The longest stripped non-empty string of an array, the first one of several; null if there is none."""
    v = F.col(values) if isinstance(values, str) else values
    full = F.filter(F.transform(v, lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x.isNotNull() & (x != ""))
    best = lambda a, x: F.when(a.isNull() | (F.length(x) > F.length(a)), x).otherwise(a)
    return F.aggregate(full, F.lit(None).cast("string"), best)


# counts


def reason_counts(df: DataFrame, reason: str) -> DataFrame:
    """Rows by drop reason; kept rows count as 'kept'."""
    return df.groupBy(F.coalesce(F.col(reason), F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def tri_state(df: DataFrame, flag: str) -> DataFrame:
    f = F.col(flag)
    return df.agg(F.count_if(f).alias("correct"), F.count_if(~f).alias("wrong"), F.count_if(f.isNull()).alias("no_ref"), F.count("*").alias("total"))


def reject_wrong(df: DataFrame, flag: str = "verified") -> DataFrame:
    """True and null stay; only false goes."""
    return where_computed(df, ~F.col(flag).eqNullSafe(F.lit(False)))


def filled_histogram(df: DataFrame, level: str, levels: range) -> DataFrame:
    """Count of every level, absent ones with zero."""
    dim = df.sparkSession.range(levels.start, levels.stop).select(F.col("id").cast("int").alias("level"))
    counts = df.groupBy(F.col(level).cast("int").alias("level")).agg(F.count("*").alias("n"))
    return dim.join(counts, "level", "left").select("level", F.coalesce("n", F.lit(0)).alias("n"))


def mode_first(df: DataFrame, value: str, order: str) -> DataFrame:
    """The commonest value (null is one), of several the one seen first."""
    counts = df.groupBy(value).agg(F.count("*").alias("n"), F.min(order).alias("_first"))
    return counts.orderBy(F.desc("n"), "_first").limit(1).select(value, "n")


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.when(whole > 0, F.round(100.0 * part / whole, digits)).otherwise(F.lit(0.0))


def model_summary(df: DataFrame, model: str = "model_used", dataset: str = "source", status: str = "verification") -> DataFrame:
    s = F.col(status)
    out = df.groupBy(F.col(model).alias("model"), F.col(dataset).alias("dataset")).agg(
        F.count("*").alias("total"), F.count_if(s == "pass").alias("pass"), F.count_if(s == "fail").alias("fail"), F.count_if(s == "unknown").alias("unknown")
    )
    return out.withColumn("pass_pct", percent(F.col("pass"), F.col("total")))


def difficulty_breakdown(df: DataFrame, model: str = "model_used", dataset: str = "source", level: str = "difficulty") -> DataFrame:
    return df.groupBy(F.col(model).alias("model"), F.col(dataset).alias("dataset"), F.col(level).alias("level")).agg(F.count("*").alias("n"))


def model_comparison(df: DataFrame, expected: int, model: str = "model_used", status: str = "verification", response: str = "response") -> DataFrame:
    """Per model: generated of expected, counts and rates, traces, mean length cut to an integer; best first."""
    s, r = F.col(status), F.col(response)
    out = df.groupBy(F.col(model).alias("model")).agg(
        F.count("*").alias("generated"), F.count_if(s == "pass").alias("pass"), F.count_if(s == "fail").alias("fail"), F.count_if(s == "unknown").alias("unknown"),
        F.count_if(F.contains(r, F.lit("<think>"))).alias("has_think"), F.floor(F.sum(F.length(r)) / F.count(r)).cast("long").alias("avg_length"),
    )
    out = out.withColumn("gen_rate", percent(F.col("generated"), F.lit(expected), 0)).withColumn("pass_rate", percent(F.col("pass"), F.col("generated")))
    return out.orderBy(F.desc("pass"), "model")


def best_model(comparison: DataFrame) -> DataFrame:
    return comparison.orderBy(F.desc("pass"), "model").limit(1).select("model", "pass")


def seed_stats(df: DataFrame, seed: str, reason: str) -> DataFrame:
    """Per seed: problems, verified (no reject reason), rejected, accept rate against at least one problem."""
    ok = F.count_if(F.col(reason).isNull())
    out = df.groupBy(seed).agg(F.count("*").alias("problems"), ok.alias("verified"), F.count_if(F.col(reason).isNotNull()).alias("rejected"))
    return out.withColumn("accept_rate", F.col("verified") / F.greatest("problems", F.lit(1)))


def run_status(df: DataFrame, result: str = "result") -> DataFrame:
    """Counts of Pass, Fail and other results, and the pass percentage cut to an integer."""
    r = F.col(result)
    out = df.agg(F.count("*").alias("total"), F.count_if(r == "Pass").alias("passed"), F.count_if(r == "Fail").alias("failed"), F.count_if(~r.isin("Pass", "Fail") | r.isNull()).alias("errors"))
    return out.withColumn("pass_pct", F.when(F.col("total") > 0, F.floor(F.col("passed") * 100 / F.col("total"))).otherwise(0).cast("long"))


def empty_like(spark: SparkSession, df: DataFrame) -> DataFrame:
    return spark.createDataFrame([], df.schema)
