"""Line dedup by an exact set-similarity join, in DataFrame functions only.

A line is the set of its blank-separated tokens. Tokens are put in one global order, rarest first (the frequency class of
the token's hash bucket over all texts, then the hash). By prefix filtering, two sets with a Jaccard similarity of at least
the threshold share 1 + k of the first `n - ceil(t n) + 1 + k` tokens of each (k is 0 for sets of under 64 tokens and grows
with them, as chance meetings do). Only those are joined, under a length filter, a positional filter and a bound by parity:
64 bits of a set, each the parity of a share of its tokens, differ from another set's in no more bits than the sets differ
in tokens; the shorter set of two needs fewer of its first tokens for that. What meets often enough is verified on its
tokens. A line goes if any line before it, by document id and line number, matches it.

Lines with equal sets are one set first, so that a line repeated in a third of all documents is one row in the join. Near
copies do not meet pair by pair: in a first round each set is verified against the first set, and the one before it, of
those that share one of its eight rarest tokens (frequent tokens in salted parts); nearly all near copies in large groups
go by that, and a set that has gone is not looked up again, only looked at. Tokens that occur fewer than 32 times are left
out of that round: the few sets that share one are compared in the join anyway.

Rows that share an id, or have none, are numbered in the order of their texts; the number stands in the upper half of
`line_no` in here, so that (id, line_no) is one line of one row and in order. Other rows have number 0 and are not moved.

Defined results: lines without tokens stay; a null text is an empty text and stays null in `remove_lines`; rows with a
null id come first; rows that share an id are ordered by their text; other columns are kept as they are. Thresholds are
over 0 and at most 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, shielded, written

THRESHOLD = 0.8
#: Buckets of token counts, and of the lookup of lines in question, in bits.
BITS, ASKED = 20, 22
#: Tokens of a set that the first round looks at.
RAREST = 8
#: The frequency class (32 times in all texts) from which it looks at a token.
COMMON = 10
#: Sets of so many tokens and more have the parity of 128 shares, as 64 no longer tell strangers apart.
WIDE = 64
#: Rows of two numbers that may be broadcast; more of them are joined by a shuffle.
SMALL = 1 << 19


def _tokens(line: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(line, " "), ""))


def _lookup(rows: DataFrame, bits: int) -> Column:
    """An array of 2**bits numbers from rows (cell, v), 0 for missing ones, as a scalar subquery. One task gathers 2**11 cells,
    the last one as many pieces as there are."""
    kind = rows.schema["v"].dataType
    every = rows.sparkSession.range(1 << bits).select(F.col("id").alias("cell"), F.lit(0).cast(kind).alias("v"))
    filled = rows.select("cell", "v").union(every).groupBy("cell").agg(F.bit_or("v").alias("v"))
    in_order = lambda cs, at, v: F.transform(F.sort_array(F.collect_list(F.struct(at, v))), lambda x: x[v])
    pieces = filled.groupBy(F.shiftright("cell", 11).alias("piece")).agg(in_order(filled, "cell", "v").alias("vs"))
    return pieces.agg(F.flatten(in_order(pieces, "piece", "vs")).alias("a")).scalar()


def _lines(docs: DataFrame) -> DataFrame:
    lines = docs.select("id", "nth", F.posexplode(F.split("text", "\n")).alias("k", "line")).where(F.trim("line") != "")
    return lines.select("id", F.shiftleft("nth", 32).bitwiseOR(F.col("k").cast("long")).alias("line_no"), "line")


def _classes(docs: DataFrame) -> Column:
    """The frequency class of each hash bucket of tokens, two for each doubling, as a lookup."""
    words = docs.select(F.explode(F.split(F.replace(F.col("text"), F.lit("\n"), F.lit(" ")), " ")).alias("w")).where("w <> ''")
    counts = words.groupBy(F.xxhash64("w").bitwiseAND((1 << BITS) - 1).alias("cell")).count()
    counts = written(counts, "line-token-counts")
    return _lookup(counts.select("cell", F.least(F.floor(F.log2(F.col("count")) * 2), F.lit(63)).cast("tinyint").alias("v")), BITS)


def _more(n: Column, threshold: float) -> Column:
    """How many tokens over one two sets of at least n must share in their prefixes."""
    return F.least(F.floor(n / 192).cast("int"), F.lit(4), F.ceil(n * F.lit(threshold) - 1e-9).cast("int") - 1)


def _fits(a: str, b: str, threshold: float) -> Column:
    """The length filter and the bound by parity, for rows with n, parity and half."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    apart, half = (F.col(f"{a}.{p}").bitwiseXOR(F.col(f"{b}.{p}")) for p in ("parity", "half"))
    most = n + m - 2 * F.ceil(_need(n, m, threshold))
    wide = (F.least(n, m) < WIDE) | (F.bit_count(half) + F.bit_count(apart.bitwiseXOR(half)) <= most)
    return (F.least(n, m) >= F.lit(threshold) * F.greatest(n, m) - 1e-9) & (F.bit_count(apart) <= most) & wide


def _need(a: Column, b: Column, threshold: float) -> Column:
    """The least overlap of two sets of those sizes at the threshold, not rounded up."""
    return F.lit(threshold / (1 + threshold)) * (a + b) - 1e-9


def _sets(docs: DataFrame, threshold: float) -> DataFrame:
    """A row per set of tokens: id, line_no (the first line that has it), n, parity (of 64 shares of the tokens), half (of one
    half of each share; 0 for sets of under `WIDE`), prefix (its first tokens, rarest first: 6 bits of the frequency class,
    then 57 of the hash)."""
    hashed = F.array_distinct(F.transform(F.array_remove(F.split("line", " "), ""), lambda w: F.xxhash64(w)))
    # Subqueries may not stand inside lambdas; the optimizer merges the two selects, so that the lookup is in no row.
    lines = _lines(docs).select("id", "line_no", hashed.alias("h"), _classes(docs).alias("classes"))
    of = lambda h: F.coalesce(F.get(F.col("classes"), h.bitwiseAND((1 << BITS) - 1).cast("int")), F.lit(0).cast("tinyint"))
    keyed = F.transform("h", lambda h: F.shiftleft(of(h).cast("long"), 57).bitwiseOR(h.bitwiseAND((1 << 57) - 1)))
    # The explode of one element keeps the optimizer from computing the array anew wherever it is used.
    lines = lines.select("id", "line_no", keyed.alias("keys")).select("id", "line_no", F.explode(F.array(F.sort_array("keys"))).alias("keys")).where(F.size("keys") > 0)
    n = F.size("keys")
    # A shift takes the last six bits of its distance: bits 51 to 56 of the hash. Bit 50 halves each share.
    odd = lambda one: F.aggregate("keys", F.lit(0).cast("long"), lambda a, k: a.bitwiseXOR(F.call_function("shiftleft", one(k), F.shiftright(k, 51).cast("int"))))
    parity = odd(lambda k: F.lit(1).cast("long"))
    half = F.when(n < WIDE, F.lit(0).cast("long")).otherwise(odd(lambda k: F.shiftright(k, 50).bitwiseAND(1)))
    prefix = F.slice("keys", 1, n - F.ceil(n * F.lit(threshold) - 1e-9).cast("int") + 1 + _more(n, threshold))
    first = F.struct("id", "line_no", n.alias("n"), parity.alias("parity"), half.alias("half"), prefix.alias("prefix"))
    sets = lines.select(F.xxhash64("keys").alias("h1"), F.xxhash64(F.lit(1), F.col("keys")).alias("h2"), first.alias("f")).groupBy("h1", "h2").agg(F.min("f").alias("f"))
    return sets.select("f.*")


def _near(sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs (ai, al, bi, bl) of a set with the first one and the one before it among those that share two tokens which
    follow each other in the order (of a prefix's last token: that token), the first of them of class COMMON at least."""
    posts = sets.select("id", "line_no", "n", "parity", "half", "prefix", F.posexplode(F.slice("prefix", 1, RAREST)).alias("i", "token"))
    posts = posts.withColumn("next", F.get("prefix", F.col("i") + 1)).where(F.shiftrightunsigned("token", 57) >= COMMON)
    # Tokens of some thousand lines and more are dealt out, so that no token gathers its sets in one task.
    parts = F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(F.shiftrightunsigned("token", 58).cast("int") - 12, F.lit(0)))
    one = F.struct("id", "line_no", "n", "parity", "half")
    posts = posts.select(one.alias("b"), F.xxhash64("token", "next", F.pmod(F.xxhash64("id", "line_no"), parts)).alias("key"))
    w = Window.partitionBy("key").orderBy("b")
    met = posts.select("b", F.first("b").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("first"), F.lag("b").over(w).alias("last"))
    far = lambda a: ((F.col(f"{a}.id") != F.col("b.id")) | (F.col(f"{a}.line_no") != F.col("b.line_no"))) & _fits(a, "b", threshold)
    met = met.where(far("first") | F.coalesce(far("last"), F.lit(False))).select("b", F.explode(F.array("first", "last")).alias("a")).where(far("a"))
    return met.select(F.col("a.id").alias("ai"), F.col("a.line_no").alias("al"), F.col("b.id").alias("bi"), F.col("b.line_no").alias("bl")).distinct()


def _met(sets: DataFrame, gone: DataFrame, threshold: float, small: bool) -> DataFrame:
    """Pairs (ai, al, bi, bl) of all sets that pass the filters, the later one not yet gone."""
    gone = gone.withColumn("gone", F.lit(1))
    some = sets.join(F.broadcast(gone) if small else gone, ["id", "line_no"], "left")
    posts = some.select("id", "line_no", "n", "parity", "half", F.coalesce("gone", F.lit(0)).alias("gone"), F.posexplode("prefix").alias("i", "token"))
    posts = posts.withColumn("rest", F.col("n") - F.col("i")).drop("i").where("token is not null and n is not null and parity is not null").repartition("token")
    # On the shorter side only the tokens that are far enough to the front for a set of its own length. Both sides read the
    # same shuffle: they use the same columns, and a condition with a row number (never negative) is not moved below it;
    # those that the optimizer would add to one side are on both.
    front = F.col("rest") + _more(F.col("n"), threshold) >= _need(F.col("n"), F.col("n"), threshold)
    a, b = posts.where(F.when(F.monotonically_increasing_id() >= 0, front)).alias("a"), posts.alias("b")
    earlier = (F.col("a.id") < F.col("b.id")) | ((F.col("a.id") == F.col("b.id")) & (F.col("a.line_no") < F.col("b.line_no")))
    n, m = F.col("a.n"), F.col("b.n")
    ordered = (n < m) | ((n == m) & earlier)
    turn = F.when(earlier, F.col("b.gone")).otherwise(F.col("a.gone")) == 0
    more = _more(n, threshold)
    place = F.least(F.col("a.rest"), F.col("b.rest")) + more >= _need(n, m, threshold)
    met = a.join(b, (F.col("a.token") == F.col("b.token")) & ordered & _fits("a", "b", threshold) & turn & place)
    of = lambda c, one, two: F.when(earlier, F.col(f"{one}.{c}")).otherwise(F.col(f"{two}.{c}"))
    met = met.select(of("id", "a", "b").alias("ai"), of("line_no", "a", "b").alias("al"), of("id", "b", "a").alias("bi"), of("line_no", "b", "a").alias("bl"), more.alias("more"))
    met = met.groupBy("ai", "al", "bi", "bl").agg(F.count("*").alias("met"), F.max("more").alias("more"))
    return met.where("met > more").drop("met", "more")


def kept_lines(docs: DataFrame, *, threshold: float = THRESHOLD, small: int = SMALL) -> DataFrame:
    """`docs` (id, nth, text) to (id, nth, line_no) of the lines with tokens that no earlier line matches. Up to
    `small` rows of ids and line numbers are broadcast, more are shuffled; the results are the same."""
    if not 0 < threshold <= 1:
        raise ValueError(f"threshold {threshold}")
    sets = written(_sets(docs, threshold), "line-sets")
    gone, used = _verified(docs, _near(sets, threshold), threshold, small)
    gone = written(gone, "lines-gone")
    discard(*used)
    later = _verified(docs, _met(sets, gone, threshold, gone.count() <= small), threshold, small)[0].union(gone)
    kept = sets.select("id", "line_no").join(later, ["id", "line_no"], "left_anti")
    return kept.select("id", F.shiftright("line_no", 32).alias("nth"), F.col("line_no").bitwiseAND((1 << 32) - 1).cast("int").alias("line_no"))


def _verified(docs: DataFrame, pairs: DataFrame, threshold: float, small: int) -> tuple[DataFrame, tuple[DataFrame, ...]]:
    """(id, line_no) of the later lines (bi, bl) that match their earlier one (ai, al), by the tokens themselves, and the
    tables that it is read from. The lines in question are read again from the texts that have one; if they are many, a
    lookup of 2**ASKED bits keeps most others out of the join."""
    pairs = written(pairs, "line-pairs")
    asked = pairs.select(F.col("ai").alias("id"), F.col("al").alias("line_no")).union(pairs.select("bi", "bl")).distinct()
    if 2 * pairs.count() <= small:
        texts = _lines(docs.join(F.broadcast(asked.select("id").distinct()), "id", "left_semi"))
        asked = F.broadcast(asked)
    else:
        texts = _lines(docs)
        cell = F.xxhash64("id", "line_no").bitwiseAND((1 << ASKED) - 1)
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), cell.bitwiseAND(63).cast("int"))
        word = F.shiftright(cell, 6)
        wanted = _lookup(asked.select(word.alias("cell"), bit.alias("v")), ASKED - 6)
        texts = texts.where(F.get(wanted, word.cast("int")).bitwiseAND(bit) != 0)
    texts = texts.join(asked, ["id", "line_no"]).select("id", "line_no", _tokens(F.col("line")).alias("t"))
    texts = written(texts, "line-tokens")
    one, two = texts.toDF("ai", "al", "at"), texts.toDF("bi", "bl", "bt")
    both = F.size(F.array_intersect("at", "bt"))
    met = pairs.join(one, ["ai", "al"]).join(two, ["bi", "bl"]).where(both >= F.lit(threshold) * (F.size("at") + F.size("bt") - both) - 1e-9)
    return met.select(F.col("bi").alias("id"), F.col("bl").alias("line_no")).distinct(), (pairs, texts)


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`df` with `_id`, the least number for null, and `_nth`, which tells rows of one `_id` apart in the order of their
    texts: 0 where the id is unique, else the row's place among all rows whose id is not."""
    df = df.withColumn("_id", F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))))
    shared = written(df.groupBy("_id").count().where("count > 1").select("_id"), "line-shared-ids")
    if shared.isEmpty():
        return df.withColumn("_nth", F.lit(0).cast("long"))
    rows = df.join(shared, "_id", "left_semi").orderBy("_id", F.coalesce(F.col(text_col), F.lit("")))
    # Numbers rise from part to part and count within each; the parts' sizes make them places.
    rows = written(rows.withColumn("_nth", F.monotonically_increasing_id()), "line-shared-rows")
    part = F.shiftright("_nth", 33)
    sizes = rows.groupBy(part.alias("_part")).count()
    before = sizes.select("_part", (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_before"))
    rows = rows.withColumn("_part", part).join(F.broadcast(before), "_part")
    rows = rows.withColumn("_nth", F.col("_before") + F.col("_nth").bitwiseAND((1 << 33) - 1)).drop("_part", "_before")
    return df.join(shared, "_id", "left_anti").withColumn("_nth", F.lit(0).cast("long")).unionByName(rows)


def _docs(keyed: DataFrame, text_col: str) -> DataFrame:
    return keyed.select(F.col("_id").alias("id"), F.col("_nth").alias("nth"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def line_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, threshold: float = THRESHOLD) -> DataFrame:
    """A row per document: doc_id, n_lines (with tokens), n_removed, kept_lines (numbers from 0, in order)."""
    docs = _docs(_keyed(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text"), "text")
    kept = kept_lines(docs, threshold=threshold).groupBy("id", "nth").agg(F.sort_array(F.collect_list("line_no")).alias("kept"))
    n = F.size(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != ""))
    out = docs.select("id", "nth", n.alias("n")).join(kept, ["id", "nth"], "left").withColumn("kept", F.coalesce("kept", F.array().cast("array<int>")))
    return out.select(F.when(F.col("id") != -(1 << 63), F.col("id")).alias("doc_id"), F.col("n").cast("long").alias("n_lines"), (F.col("n") - F.size("kept")).cast("long").alias("n_removed"), F.col("kept").alias("kept_lines"))


def remove_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, threshold: float = THRESHOLD, drop_emptied: bool = False) -> DataFrame:
    """`df` with later matches taken out of the texts; blank lines and all other columns stay. With `drop_emptied`,
    documents that had lines with tokens and have none left go."""
    columns = df.columns
    df, names = shielded(df, "_id", "_nth", "_kept", "_flags", "_part", "_before", "count")
    id_col, text_col = names[id_col], names[text_col]
    keyed = _keyed(df, id_col, text_col)
    kept = kept_lines(_docs(keyed, text_col), threshold=threshold).groupBy(F.col("id").alias("_id"), F.col("nth").alias("_nth")).agg(F.sort_array(F.collect_list("line_no")).alias("_kept"))
    # A flag for each line up to the last one kept, so that a line's is found by its number.
    before = lambda x, i: F.when(i == 0, -1).otherwise(F.get("_kept", i - 1))
    flags = F.flatten(F.transform("_kept", lambda x, i: F.concat(F.array_repeat(F.lit(False), x - before(x, i) - 1), F.array(F.lit(True)))))
    rows = keyed.join(kept.withColumn("_flags", flags), ["_id", "_nth"], "left")
    lines = F.filter(F.split(F.col(text_col), "\n"), lambda x, i: (F.trim(x) == "") | F.coalesce(F.get("_flags", i), F.lit(False)))
    if drop_emptied:
        rows = rows.where(F.col("_kept").isNotNull() | F.col(text_col).isNull() | (F.trim(F.translate(text_col, "\n", " ")) == ""))
    return rows.withColumn(text_col, F.array_join(lines, "\n")).select([F.col(f"`{n}`").alias(c) for c, n in zip(columns, names.values(), strict=True)])
