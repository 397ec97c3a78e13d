"""Importance resampling towards a target distribution, in DataFrame functions only.

The features of a text are its n-grams of words, hashed to buckets by crc32. How often each bucket occurs in all texts and
in the target's texts gives its gain, the scaled logarithm of the two smoothed frequencies' ratio; a text's weight is the
floored mean of its features' gains. Weight plus Gumbel noise, a function of seed and id alone, is the score, and the
highest scores are a sample without replacement by importance.

How it runs. Two scans of the texts: one counts buckets (partial counts, so a task sends at most a row a bucket), the other
joins each feature to the broadcast gain table, which has exactly `buckets` rows, and sums by text; a text's features
follow each other in one task, so that a task sends a row a text. The scores, a few numbers a text, are written, range-partitioned by the whole order and sorted; a row's rank is its place in its
partition plus the rows of the partitions before it, so that no task holds more than one range. Rows that are alike in all
that orders them are told apart by their row number, so that they spread over partitions too.

Defined results: a null text has no words; a text without features has the weight 0; a null id is the empty string in the
noise and comes last among ties; rows that share an id are rows of their own, with the same noise; a null text of the target
has no features; with an empty target, or no texts, counts are 0 and the smoothing alone decides; columns other than the two
named are ignored, whatever their names. Characters of ASCII other than letters and digits part words, all others are
letters; only A to Z are lower-cased.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, written

BUCKETS = 10_000
#: The gain table is broadcast: at most this many rows of two numbers.
MOST_BUCKETS = 1 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text, in order."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), NOT_WORD), lambda w: w != "")


def _joined(ws: Column, n: int):
    return lambda i: F.array_join(F.slice(ws, i, n), " ")


def n_grams(ws: Column, shortest: int, longest: int) -> Column:
    """All runs of `shortest` to `longest` consecutive words, each joined by one space."""
    made = [ws] if shortest == 1 else []
    for n in range(max(shortest, 2), longest + 1):
        at = F.when(F.size(ws) >= n, F.sequence(F.lit(1), F.size(ws) - (n - 1))).otherwise(F.array().cast("array<int>"))
        made.append(F.transform(at, _joined(ws, n)))
    return made[0] if len(made) == 1 else F.concat(*made)


def _features(df: DataFrame, keys: list[str], shortest: int, longest: int, buckets: int) -> DataFrame:
    """`keys`, n_words and the bucket of each feature, a row a feature; a text without features keeps one row with none."""
    split = df.withColumn("ws", words(F.col("text")))
    grams = split.select(*keys, F.size("ws").alias("n_words"), F.explode_outer(n_grams(F.col("ws"), shortest, longest)).alias("gram"))
    return grams.select(*keys, "n_words", (F.crc32(F.col("gram").cast("binary")) % buckets).alias("bucket"))


def _counted(df: DataFrame, text_col: str, name: str, **how) -> DataFrame:
    texts = df.select(F.col(text_col).cast("string").alias("text"))
    return _features(texts, [], **how).where("bucket is not null").groupBy("bucket").agg(F.count("*").alias(name))


def gains(df: DataFrame, target: DataFrame, text_col: str = "text", target_text: str = "text", *, shortest: int = 1, longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """A row for each bucket: bucket, s and t (its features in `df` and in `target`), gain."""
    if not 1 <= buckets <= MOST_BUCKETS or not 1 <= shortest <= longest:
        raise ValueError(f"from 1 to {MOST_BUCKETS} buckets, and n-grams from 1 up")
    how = {"shortest": shortest, "longest": longest, "buckets": buckets}
    all_ = df.sparkSession.range(0, buckets, 1, 1).withColumnRenamed("id", "bucket")
    both = all_.join(_counted(df, text_col, "s", **how), "bucket", "left").join(_counted(target, target_text, "t", **how), "bucket", "left")
    table = written(both.select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t")), "bucket-counts")
    total_s, total_t = (float(x) for x in table.agg(F.sum("s"), F.sum("t")).first())
    ratio = (F.col("t") + 1.0) * F.lit(total_s + buckets) / ((F.col("s") + 1.0) * F.lit(total_t + buckets))
    return table.withColumn("gain", F.floor(1000 * F.ln(ratio)).cast("long"))


def gumbel(doc_id: Column, seed: int) -> Column:
    """Scaled Gumbel noise of an id: the first 32 bits of a digest of seed and id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")


def scores(df: DataFrame, table: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shortest: int = 1, longest: int = 1, buckets: int = BUCKETS, seed: int = 2024) -> DataFrame:
    """A row per row of `df`: row (a number of its own), doc_id, n_words, n_features, weight, score."""
    texts = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = _features(texts, ["row", "doc_id"], shortest, longest, buckets).join(F.broadcast(table.select("bucket", "gain")), "bucket", "left")
    sums = rows.groupBy("row", "doc_id", "n_words").agg(F.count("bucket").alias("n_features"), F.sum("gain").alias("total"))
    mean = F.expr("CASE WHEN n_features = 0 THEN 0L ELSE total DIV n_features - CASE WHEN total % n_features < 0 THEN 1 ELSE 0 END END")
    return sums.select("row", "doc_id", F.col("n_words").cast("long").alias("n_words"), "n_features", mean.alias("weight")).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))


def ranked(df: DataFrame, *order: Column) -> DataFrame:
    """`df` with `rank`, from 1 on in the given order: a distributed sort, then each row's place in its partition plus the rows
    of the partitions before it. The table of partition sizes, a row a partition, is all that is gathered."""
    # The number of a row is its partition's times 2**33 plus its place there.
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    placed = written(placed, "sorted")
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    inside = F.col("_place").bitwiseAND((1 << 33) - 1)
    return placed.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn("rank", F.col("_before") + inside + 1).drop("_place", "_part", "_before")


def resample(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", *, percent: int = 10, least_words: int = 20, shortest: int = 1, longest: int = 1, buckets: int = BUCKETS, seed: int = 2024) -> DataFrame:
    """A row per row of `df`: doc_id, n_words, n_features, weight, score, and the rank of those drawn (else null): of the texts
    with at least `least_words` words, `percent` in a hundred, rounded down, those of the highest scores."""
    if not 0 <= percent <= 100:
        raise ValueError("percent is from 0 to 100")
    how = {"shortest": shortest, "longest": longest, "buckets": buckets}
    table = gains(df, target, text_col, target_text, **how)
    scored = written(scores(df, table, id_col, text_col, seed=seed, **how), "weights")
    fit = F.col("n_words") >= least_words
    most = percent * scored.where(fit).count() // 100
    # Texts that are too short come after all others, so that one sort ranks all.
    out = ranked(scored, fit.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row"))
    discard(scored)
    return out.select("doc_id", "n_words", "n_features", "weight", "score", F.when(F.col("rank") <= most, F.col("rank")).alias("rank"))
