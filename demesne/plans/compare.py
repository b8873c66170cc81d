"""Comparing what several extractors found over one corpus."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.errors import PythonException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demesne.functions.scalars import percent_of
from demesne.schemas import UNRESOLVED
from demesne.session import cut

# --- fixed values: outcomes of one extractor on one object ---
RESOLVED, NOT_RESOLVED, ERROR, UNAVAILABLE, MISSING = "resolved", "unresolved", "error", "unavailable", "missing"


def result_status(parse_status: Column) -> Column:
    return F.when(parse_status == UNRESOLVED, NOT_RESOLVED).otherwise(RESOLVED)


def as_results(mined: DataFrame, engine: str, name: str = "object_name") -> DataFrame:
    """Mined objects in the shape every extractor delivers."""
    return mined.select(
        F.lit(engine).alias("engine"),
        F.col(name).alias("object_name"),
        result_status(F.col("parse_status")).alias("status"),
        "referenced_tables",
        "referenced_procs",
        F.col("unresolved_reason").alias("notes"),
    )


def failed_results(corpus: DataFrame, engine: str, status: str, reason: str, name: str = "object_name") -> DataFrame:
    """One row per object of the corpus for an extractor that crashed or is not there."""
    none = F.array().cast("array<string>")
    return corpus.select(
        F.lit(engine).alias("engine"),
        F.col(name).alias("object_name"),
        F.lit(status).alias("status"),
        none.alias("referenced_tables"),
        none.alias("referenced_procs"),
        F.lit(reason).alias("notes"),
    )


def engine_stats(results: DataFrame) -> DataFrame:
    """Outcomes per extractor and its success rate in percent."""
    counts = results.groupBy("engine").agg(
        F.count(F.lit(1)).alias("total_objects"),
        F.count_if(F.col("status") == RESOLVED).alias("resolved"),
        F.count_if(F.col("status") == NOT_RESOLVED).alias("unresolved"),
        F.count_if(F.col("status") == ERROR).alias("failed"),
        F.count_if(F.col("status") != UNAVAILABLE).alias("_ran"),
    )
    return counts.select(
        "engine",
        (F.col("_ran") > 0).alias("available"),
        "total_objects",
        "resolved",
        "unresolved",
        "failed",
        percent_of(F.col("resolved"), F.col("total_objects")).alias("success_rate_pct"),
    )


def object_report(corpus: DataFrame, results: DataFrame, engines: list[str]) -> DataFrame:
    """One wide row per object: every extractor's outcome, and how the first two differ on tables.

    Objects are told apart by database and name where both sides know the
    database; of several results of one extractor the greatest counts.
    """
    keys = [c for c in ("database", "object_name") if c in corpus.columns and c in results.columns]
    fields = F.struct("status", "referenced_tables", "referenced_procs", "notes")
    wide = results.groupBy(*keys).agg(*[F.max(F.when(F.col("engine") == e, fields)).alias(f"_{e}") for e in engines])
    joined = corpus.select(*keys).distinct().join(wide, keys, "left")
    none = F.array().cast("array<string>")
    cols = list(keys)
    for e in engines:
        r = F.col(f"_{e}")
        cols += [
            F.coalesce(r["status"], F.lit(MISSING)).alias(f"{e}_status"),
            F.coalesce(r["referenced_tables"], none).alias(f"{e}_referenced_tables"),
            F.coalesce(r["referenced_procs"], none).alias(f"{e}_referenced_procs"),
            r["notes"].alias(f"{e}_notes"),
        ]
    report = joined.select(*cols)
    if len(engines) < 2:
        return report
    a, b = (F.array_sort(F.array_distinct(f"{e}_referenced_tables")) for e in engines[:2])
    return report.withColumns(
        {
            "tables_agree": a == b,
            f"tables_only_in_{engines[0]}": F.array_except(a, b),
            f"tables_only_in_{engines[1]}": F.array_except(b, a),
        }
    )


def set_difference(df: DataFrame, keys: list[str], label: str, item: str, a: str, b: str) -> DataFrame:
    """Items only one of two labelled sets holds, as rows; no set is ever collected."""
    side = lambda v: F.bool_or(F.col(label) == v)
    seen = df.filter(F.col(label).isin(a, b)).groupBy(*keys, item).agg(side(a).alias("_a"), side(b).alias("_b"))
    only = F.when(F.col("_a"), a).otherwise(b)
    return seen.filter(F.col("_a") != F.col("_b")).select(*keys, item, only.alias("only_in"))


def compare_labelled_sets(
    spine: DataFrame, df: DataFrame, keys: list[str], label: str, item: str, a: str, b: str
) -> DataFrame:
    """Per key: sizes of two labelled item sets, how many items only one holds, and whether they agree."""
    side = lambda v: F.bool_or(F.col(label) == v)
    seen = df.filter(F.col(label).isin(a, b)).groupBy(*keys, item).agg(side(a).alias("_a"), side(b).alias("_b"))
    counts = seen.groupBy(*keys).agg(
        F.count_if("_a").alias(f"{a}_items"),
        F.count_if("_b").alias(f"{b}_items"),
        F.count_if(F.col("_a") & ~F.col("_b")).alias(f"only_in_{a}"),
        F.count_if(F.col("_b") & ~F.col("_a")).alias(f"only_in_{b}"),
    )
    names = [f"{a}_items", f"{b}_items", f"only_in_{a}", f"only_in_{b}"]
    joined = spine.select(*keys).distinct().join(counts, keys, "left")
    filled = joined.select(*keys, *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in names])
    return filled.withColumn("agree", (F.col(f"only_in_{a}") == 0) & (F.col(f"only_in_{b}") == 0))


def union_of_sets(parts: list[DataFrame], cols: list[str]) -> DataFrame:
    """Set union of the rows several extractors found."""
    return reduce(DataFrame.unionByName, [p.select(*cols) for p in parts]).distinct()


def reason_of(exc: Exception) -> str:
    """What went wrong, in one line: of an error inside a task, the error that was raised there."""
    lines = [line.strip() for line in str(exc).splitlines() if line.strip()]
    raised = [line for line in lines if re.match(r"[A-Za-z_.]*(Error|Exception|Interrupt)\b.*", line)]
    if isinstance(exc, PythonException) and raised:
        return raised[-1]
    return f"{type(exc).__name__}: {lines[0] if lines else ''}"


def run_comparison(corpus: DataFrame, extractors: dict, name: str = "object_name") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(results, stats, report) of several extractors, each a function corpus -> results.

    The results of each are written by a job of its own. An extractor that cannot be planned, or crashes at
    work, counts as an error on every object and does not keep the others from being compared.
    """
    parts = []
    for engine, extract in extractors.items():
        try:
            found = extract(corpus)
            scope = [c for c in ("database",) if c in corpus.columns and c in found.columns]
            parts.append(cut(found.select("engine", *scope, "object_name", "status", "referenced_tables", "referenced_procs", "notes")))
        except Exception as exc:
            parts.append(failed_results(corpus, engine, ERROR, reason_of(exc), name))
    shared = [c for c in parts[0].columns if all(c in p.columns for p in parts)]
    results = reduce(DataFrame.unionByName, [p.select(*shared) for p in parts])
    spine = corpus.select(*[c for c in ("database",) if c in corpus.columns], F.col(name).alias("object_name"))
    return results, engine_stats(results), object_report(spine, results, list(extractors))
