"""Reports as text and JSON: issues, conversions, logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import checks


def issues_json(issues: DataFrame) -> DataFrame:
    """(file, json): counts, and every issue in order."""
    item = F.struct(*[c for c in checks.ISSUE if c != "file"])
    c = lambda s: F.count_if(F.col("severity") == s)
    rows = issues.groupBy("file").agg(c("error").alias("errors"), c("warning").alias("warnings"), c("info").alias("infos"), F.array_sort(F.collect_list(item)).alias("issues"))
    return rows.select("file", F.to_json(F.struct("errors", "warnings", "infos", ((F.col("errors") == 0) & (F.col("warnings") == 0)).alias("seamless"), "issues")).alias("json"))


def issues_of_json(docs: DataFrame) -> DataFrame:
    """The issues of such reports again."""
    one = "struct<source:string,severity:string,category:string,code:string,message:string,uri:string,details:string>"
    return docs.select("file", F.explode(F.from_json("json", f"struct<issues:array<{one}>>")["issues"]).alias("x")).select("file", "x.*")


def issues_markdown(issues: DataFrame, most: int = 10) -> DataFrame:
    """(file, text): a table of each severity's first issues."""
    w = Window.partitionBy("file", "severity").orderBy("category", "code", "message", "uri")
    rows = issues.withColumn("k", F.row_number().over(w))
    line = F.concat_ws(" | ", F.lit(""), "category", "code", "message", F.coalesce("uri", F.lit("")), F.lit(""))
    parts = rows.groupBy("file", "severity").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.when(F.col("k") <= most, F.struct("k", F.trim(line).alias("t"))))).alias("top"))
    text = F.concat(F.lit("## "), "severity", F.lit(": "), F.col("n").cast("string"), F.lit("\n\n| category | code | message | uri |\n| - | - | - | - |\n"), F.array_join(F.transform("top", lambda x: x["t"]), "\n"))
    return parts.groupBy("file").agg(F.array_join(F.array_sort(F.collect_list(text)), "\n\n").alias("text"))


def merged(reports: list[DataFrame]) -> DataFrame:
    """Issues of several reports; which is which stays in `source`."""
    return checks.union(reports)


def filtered(issues: DataFrame, *, severity: str | None = None, category: str | None = None) -> DataFrame:
    out = issues
    if severity:
        out = out.where(F.col("severity") == severity)
    return out.where(F.col("category") == category) if category else out


def conversion_text(entities: DataFrame, relationships: DataFrame, skipped: DataFrame, issues: DataFrame | None = None) -> DataFrame:
    """(file, text): counts, the rate, the first five skipped items and the first three warnings."""
    from .compare import conversion_summary

    s = conversion_summary(entities, relationships, skipped)

    def first(df: DataFrame, text, n: int, name: str) -> DataFrame:
        w = Window.partitionBy("file").orderBy(text)
        rows = df.withColumn("t", text).withColumn("k", F.row_number().over(w)).where(F.col("k") <= n)
        return rows.groupBy("file").agg(F.array_join(F.array_sort(F.collect_list("t")), "\n").alias(name))

    out = s.join(first(skipped, F.concat(F.lit("  skipped "), "item_type", F.lit(" "), F.coalesce("name", F.lit("")), F.lit(": "), "reason"), 5, "skips"), "file", "left")
    if issues is not None:
        out = out.join(first(issues.where("severity = 'warning'"), F.concat(F.lit("  warning "), "message"), 3, "warns"), "file", "left")
    else:
        out = out.withColumn("warns", F.lit(None).cast("string"))
    head = F.format_string("%d entities, %d relationships, %d skipped, %.1f %% done", "entities", "relationships", "skipped", "success_rate")
    return out.select("file", F.concat_ws("\n", head, "skips", "warns").alias("text"))


def combined(reports: dict[str, DataFrame]) -> DataFrame:
    """Named reports as one: (report, source, severity, category, n) with sub-totals by report, by severity within a report, by
    severity, and in all; totals are null."""
    rows = None
    for name, issues in sorted(reports.items()):
        one = issues.select(F.lit(name).alias("report"), "source", "severity", "category")
        rows = one if rows is None else rows.unionByName(one)
    sets = [["report", "source", "severity", "category"], ["report", "severity"], ["report"], ["severity"], []]
    return rows.groupingSets(sets, "report", "source", "severity", "category").agg(F.count("*").alias("n"))


def import_log(issues: DataFrame, path: str, *, title: str) -> None:
    """One JSON line for each document with issues, under a title, written over what is there."""
    issues_json(issues).select(F.to_json(F.struct(F.lit(title).alias("title"), "file", F.current_timestamp().alias("at"), F.parse_json("json").alias("report"))).alias("value")).write.mode("overwrite").text(path)


def statistics(issues: DataFrame) -> DataFrame:
    """Counts by source, severity and category, with all sub-totals."""
    return issues.groupingSets([["source", "severity"], ["source"], ["category"], []], "source", "severity", "category").agg(F.count("*").alias("n"))
