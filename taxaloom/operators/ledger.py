"""State tables: resumable work lists, set comparisons, partitions that must add up, run registry."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions import fixed_values as V
from ..functions.rules import case_when
from .ordering import last_state


def status_in(df: DataFrame, column: str, wanted: Sequence[str]) -> DataFrame:
    """Rows in one of the wanted states."""
    return df.where(F.col(column).isin(list(wanted)))


def pending(df: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Work that is not in the finished ledger."""
    return df.join(done.select(*keys).distinct(), list(keys), "left_anti")


def reset(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, removed): rows to be redone are taken out; a NULL predicate keeps the row."""
    hit = F.coalesce(predicate, F.lit(False))
    return df.where(~hit), df.where(hit)


def append_new(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not on file yet; repeats inside the new batch are all kept."""
    return pending(df, existing, keys)


def without(df: DataFrame, queues: Sequence[DataFrame], rescued: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """df minus (union of queues minus rescued)."""
    drop = reduce(lambda a, b: a.unionByName(b), [q.select(*keys) for q in queues]).distinct()
    if rescued is not None:
        drop = drop.join(rescued.select(*keys).distinct(), list(keys), "left_anti")
    return df.join(drop, list(keys), "left_anti")


def compare_sets(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Both differences and the intersection: one row per key with ``side`` = only_left, only_right or both."""
    left = a.select(key).distinct().withColumn("_l", F.lit(True))
    right = b.select(key).distinct().withColumn("_r", F.lit(True))
    side = case_when([(F.col("_r").isNull(), F.lit("only_left")), (F.col("_l").isNull(), F.lit("only_right"))], F.lit("both"))
    return left.join(right, key, "full_outer").select(key, side.alias("side"))


def residual(df: DataFrame, filed: Sequence[DataFrame], key: str, label: str = "Not yet categorised") -> DataFrame:
    """Keys that no category holds, as a category of their own."""
    known = reduce(lambda a, b: a.unionByName(b), [f.select(key) for f in filed]).distinct()
    return df.select(key).distinct().join(known, key, "left_anti").withColumn("category", F.lit(label))


def file_by(df: DataFrame, key: str, rules: dict[str, Column], label: str = "Not yet categorised") -> DataFrame:
    """Distinct keys with the category whose rule holds for one of their rows, or the residual one; a key with two categories raises at run time.

    One aggregate: the rules that hold are gathered per key, so rows of one key that fall in two sets are noticed wherever they lie.
    """
    held = df.groupBy(key).agg(*[F.bool_or(F.coalesce(rule, F.lit(False))).alias(f"_r{i}") for i, rule in enumerate(rules.values())])
    return held.select(key, _only(F.col(key), {name: F.col(f"_r{i}") for i, name in enumerate(rules)}, label).alias("category"))


def _only(key: Column, held: dict[str, Column], otherwise: str | None) -> Column:
    """Name of the one condition that holds; two of them raise."""
    names = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in held.items()]))
    clash = F.raise_error(F.concat(F.lit("sets overlap at "), key.cast("string"), F.lit(": "), F.array_join(names, ", "))).cast("string")
    return F.when(F.size(names) > 1, clash).otherwise(F.coalesce(F.try_element_at(names, F.lit(1)), F.lit(otherwise)))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are blank or held by more than one row."""
    missing = F.greatest(*[F.col(k).isNull() | (F.trim(F.col(k).cast("string")) == "") for k in keys], F.lit(False))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | missing)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows; a blank or repeated key raises when they are read, so the check costs no job of its own."""
    rest = [c for c in df.columns if c not in keys]
    held = df.groupBy(*keys).agg(F.any_value(F.struct(F.lit(1).alias("_"), *rest)).alias("_row"), F.count(F.lit(1)).alias("_n"))
    missing = F.greatest(*[F.col(k).isNull() | (F.trim(F.col(k).cast("string")) == "") for k in keys], F.lit(False))
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    checked = F.when((F.col("_n") > 1) | missing, F.raise_error(F.concat(F.lit("key blank or repeated: "), shown)).cast("boolean")).otherwise(F.lit(True))
    return held.where(checked).select(*[c if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def require_disjoint(frames: dict[str, DataFrame], key: str) -> DataFrame:
    """Keys of all sets with the set's name; a key that sits in two of them raises when the rows are read."""
    tagged = reduce(lambda a, b: a.unionByName(b), [f.select(key).withColumn("category", F.lit(name)) for name, f in frames.items()])
    held = tagged.groupBy(key).agg(*[F.bool_or(F.col("category") == name).alias(f"_s{i}") for i, name in enumerate(frames)])
    return held.select(key, _only(F.col(key), {name: F.col(f"_s{i}") for i, name in enumerate(frames)}, None).alias("category"))


def check_partition(parent: DataFrame, parts: Sequence[DataFrame], measures: Sequence[str]) -> DataFrame:
    """One row of totals per side; raises at run time when the parts do not add up to the parent.

    Sums of floating numbers depend on the order of the rows, by more the more rows there are. So the comparison is of exact decimal sums, whatever the
    order; only what no decimal holds (from 1e16 on) is compared as floating sums, to one part in 1e9.
    """
    sides = [(parent, 0)] + [(p, 1) for p in parts]
    rows = reduce(lambda a, b: a.unionByName(b), [
        d.select(*measures).withColumns({"rows": F.lit(1), "_side": F.lit(side)}) for d, side in sides
    ])
    floating = [m for m in measures if isinstance(rows.schema[m].dataType, (DoubleType, FloatType))]
    exact = {f"_exact_{m}": F.col(m).try_cast("decimal(28,12)") for m in floating}
    rows = rows.withColumns(exact).withColumns({f"_large_{m}": F.when(F.col(f"_exact_{m}").isNull(), F.col(m)) for m in floating})
    names = ["rows", *measures]
    compared = [n for n in names if n not in floating] + list(exact)

    def total(name: str, side: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_side") == side, F.col(name))), F.lit(0))

    def gap(name: str) -> Column:
        return F.abs(F.col(f"parent_{name}") - F.col(f"parts_{name}"))

    summed = [*names, *exact, *[f"_large_{m}" for m in floating]]
    both = rows.agg(*[total(m, side).alias(f"{prefix}_{m}") for m in summed for side, prefix in ((0, "parent"), (1, "parts"))])
    same = [gap(m) < 1e-6 for m in compared] + [gap(f"_large_{m}") < 1e-6 + 1e-9 * F.abs(F.col(f"parent__large_{m}")) for m in floating]
    checked = F.when(reduce(lambda a, b: a & b, same), F.lit(True)).otherwise(F.raise_error(F.lit("partition does not add up")).cast("boolean"))
    return both.select(*[f"{prefix}_{m}" for m in names for prefix in ("parent", "parts")], checked.alias("balances"))


# ---------------------------------------------------------------------------
# run registry
# ---------------------------------------------------------------------------
def classify_level1(flags: DataFrame) -> DataFrame:
    """Exactly one class per paper out of boolean columns completed, only_unsupported, failed, in_progress, method_missing."""
    order = [("completed", "completed"), ("only_unsupported", "method_missing"), ("failed", "failed"),
             ("in_progress", "in_progress"), ("method_missing", "method_missing")]
    label = case_when([(F.coalesce(F.col(c), F.lit(False)), F.lit(v)) for c, v in order], F.lit("in_progress"))
    return flags.withColumn("level1", label)


def step_outcome(outputs: DataFrame) -> DataFrame:
    """Status of a step from what its branches left behind.

    Input: paper, branch, branch_status, n_missing_files, n_rows, n_cols (one row per planned branch).
    """
    ran = F.col("branch_status").isin("done", "failed")
    problem = case_when(
        [(F.col("branch_status") == "failed", F.concat("branch", F.lit(": reported failed"))),
         (F.col("n_missing_files") > 0, F.format_string("%s: missing %d files", "branch", "n_missing_files")),
         ((F.col("n_rows") == 0) | (F.col("n_cols") < 2),
          F.format_string("%s: matrix has %d rows x %d features", F.col("branch"), F.col("n_rows"), F.greatest(F.col("n_cols") - 1, F.lit(0))))],
        F.lit(None).cast("string"),
    )
    deferred = F.col("branch_status").isin(V.DEFERRED_STATUSES)
    # a paper has at most one row per branch of a fixed list, so these lists are short
    per = outputs.groupBy("paper").agg(
        F.count_if(ran).alias("n_ran"),
        F.array_join(F.array_sort(F.collect_set(F.when(ran, problem))), "; ").alias("problems"),
        F.array_join(F.array_sort(F.collect_set(F.when(deferred, F.concat("branch", F.lit("("), "branch_status", F.lit(")"))))), ", ").alias("not_run"),
    )
    status = case_when(
        [((F.col("n_ran") == 0) | (F.col("problems") != ""), F.lit("failed")), (F.col("not_run") != "", F.lit("done_partial"))],
        F.lit("done"),
    )
    reason = case_when(
        [(F.col("n_ran") == 0, F.lit("no branch reported a result")), (F.col("problems") != "", F.col("problems"))], F.col("not_run")
    )
    return per.select("paper", status.alias("status"), reason.alias("reason"))


def download_status(df: DataFrame) -> DataFrame:
    """complete / partial / failed from n_failed, n_unresolved and n_unsupported."""
    label = case_when(
        [(F.col("n_failed") > 0, F.lit("failed")), (F.col("n_unresolved") + F.col("n_unsupported") > 0, F.lit("partial"))],
        F.lit("complete"),
    )
    return df.withColumn("download_status", label)


def needs_retry(status: Column, files_intact: Column, retry_failed: bool = False) -> Column:
    """Complete papers are skipped while their files are intact; failed ones only on request; the rest resumes."""
    return case_when(
        [(status == "complete", ~files_intact), (status.isin("failed", "partial"), F.lit(retry_failed))], F.lit(True)
    )


def deferred_branches(plan: DataFrame) -> DataFrame:
    """Split the blockers of a plan into deferred (about a branch that is set aside) and fatal.

    Input: paper, branches array<struct<branch,status>>, blockers array<string>.
    """
    deferred = F.transform(F.filter("branches", lambda b: b["status"].isin(V.DEFERRED_STATUSES)), lambda b: b["branch"])
    fatal = F.filter("blockers", lambda text: ~F.exists(deferred, lambda d: text.contains(d)))
    ready = F.exists("branches", lambda b: b["status"] == "ready")
    verdict = F.when((F.size(fatal) > 0) | ~ready, F.lit("blocked")).otherwise(F.lit("runs"))
    return plan.select("*", deferred.alias("deferred"), fatal.alias("fatal"), verdict.alias("verdict"))


def paper_risks(papers: DataFrame) -> DataFrame:
    """One row per (paper, risk) for finished papers.

    Input: paper, status, gate, grouped_supported (boolean), chimera_retention, n_deferred.
    """
    done = F.col("status").isin(V.FINISHED_STATUSES)
    no_group = F.col("gate").startswith("pass_quantification_only") | (F.col("grouped_supported") == F.lit(False))
    risks = F.array_compact(F.array(
        F.when(F.coalesce(no_group, F.lit(False)), F.lit(V.RISK_ORDER[0])),
        F.when(F.coalesce(F.col("chimera_retention") < V.MIN_CHIMERA_RETENTION, F.lit(False)), F.lit(V.RISK_ORDER[1])),
        F.when(F.col("n_deferred") > 0, F.lit(V.RISK_ORDER[2])),
    ))
    return papers.where(done).select("paper", F.explode(risks).alias("risk"))


def method_rows(plans: DataFrame) -> DataFrame:
    """One row per (paper, method) that ran, and per branch for which no method exists. Input: paper, branch, status."""
    pairs = [x for k, v in V.BRANCH_METHODS.items() for x in (F.lit(k), F.lit(v))]
    method = F.try_element_at(F.create_map(*pairs), F.col("branch"))
    named = plans.withColumn("method", case_when(
        [((F.col("status") == "done"), method), (F.col("status") == "unsupported", F.concat(F.lit("missing:"), "branch"))],
        F.lit(None).cast("string")))
    return named.where(F.col("method").isNotNull()).select("paper", "method").distinct()


def registry(ledger: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Current state per (paper, step) with done/failed/open flags. Ledger columns: paper, step, status, ..."""
    now = last_state(ledger, keys, order)
    flag = case_when(
        [(F.col("status").isin(V.FINISHED_STATUSES), F.lit("done")), (F.col("status").isin(V.FAILED_STATUSES), F.lit("failed"))], F.lit("open")
    )
    return now.withColumn("state", flag)
