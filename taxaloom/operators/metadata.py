"""Runs to samples, sample handles, claims and the gate in front of quantification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.rules import blank, case_when, reasons
from ..functions.text import nonblank, truthy


def sample_inventory(files: DataFrame, runs: DataFrame, keys: Sequence[str] = ("sample",)) -> DataFrame:
    """One row per sample: runs, files, pairing, files on disk, open questions.

    files: keys, run, file, on_disk; runs: run, library_layout, isolation_source. Where papers share samples, the paper is a key.
    """
    per_run = files.groupBy(*keys, "run").agg(F.count(F.lit(1)).alias("n"), F.count_if("on_disk").alias("d"))
    meta = per_run.join(runs, "run", "left")
    per = meta.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_runs"), F.sum("n").alias("n_files"), F.sum("d").alias("n_on_disk"), F.bool_and(F.col("n") == 2).alias("_pairs"),
        F.min_by(F.upper("library_layout"), "run").alias("library_layout"), F.min_by("isolation_source", "run").alias("isolation_source"))
    pairing = case_when([(F.col("library_layout") != "PAIRED", F.lit("single-end")), (F.col("_pairs"), F.lit("complete"))], F.lit("INCOMPLETE"))
    todo = reasons([(F.col("n_runs") > 1, "several runs for one sample"), (F.col("library_layout").isNull(), "archive metadata unavailable"),
                    (F.lower(F.coalesce("isolation_source", F.lit(""))).isin("", "missing"), "isolation source not given")], "; ")
    return per.select(*keys, "n_runs", "n_files", "n_on_disk", "library_layout", pairing.alias("pairing_status"),
                      F.when(F.col("n_on_disk") == F.col("n_files"), F.lit("complete")).otherwise(F.lit("INCOMPLETE")).alias("download_status"), todo.alias("open_questions"))


def run_to_sample(files: DataFrame, keys: Sequence[str] = ("sample",)) -> DataFrame:
    """Runs and experiments per sample, how several runs are to be treated, and what blocks the sample.

    files: keys, run, experiment, library_layout, branch (one row per FASTQ file of the key).
    """
    per_run = files.groupBy(*keys, "run").agg(
        F.count(F.lit(1)).alias("n"), F.min("experiment").alias("experiment"), F.min("library_layout").alias("library_layout"), F.min("branch").alias("branch"))
    per = per_run.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_runs"), F.min("experiment").alias("_e1"), F.max("experiment").alias("_e2"), F.min_by("library_layout", "run").alias("library_layout"),
        F.min_by("branch", "run").alias("branch"), F.bool_and(F.col("n") == 2).alias("_pairs"))
    one = F.col("_e1").eqNullSafe(F.col("_e2"))
    merge = case_when([(F.col("n_runs") == 1, F.lit("single_run")), (one, F.lit("candidate_technical_replicate_same_experiment"))],
                      F.lit("MULTIPLE_EXPERIMENTS_do_not_merge_without_review"))
    blockers = reasons([
        ((F.upper("library_layout") == "PAIRED") & ~F.col("_pairs"), "paired library with files missing"),
        ((F.col("n_runs") > 1) & ~one, "runs across several experiments"), (F.coalesce(F.col("branch"), F.lit(V.UNRESOLVED)) == V.UNRESOLVED, "assay unresolved"),
        (F.col("branch") == "unsupported_isolate_genome", "isolate or host genome, not a community")], "; ")
    return per.select(*keys, "n_runs", "library_layout", "branch", merge.alias("multi_run_handling"), blockers.alias("blockers"))


def first_run_metadata(files: DataFrame, runs: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("sample",)) -> DataFrame:
    """Metadata of a sample = metadata of its first run."""
    first = files.groupBy(*keys).agg(F.min("run").alias("run"))
    return first.join(runs.select("run", *columns), "run", "left")


def pick_handle(df: DataFrame, keys: Sequence[str], sample: str, levels: Sequence[str]) -> DataFrame:
    """First level at which every sample of the key has a distinct, filled label: keys, chosen level (NULL = none unique).

    ``levels`` are columns, best first. Only (key, level, label) counts are shuffled.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("level"), nonblank(F.col(c).cast("string")).alias("label")) for i, c in enumerate(levels)])
    long = df.select(*keys, F.inline(pairs))
    counted = long.groupBy(*keys, "level", "label").agg(F.count(F.lit(1)).alias("_n"))
    judged = counted.groupBy(*keys, "level").agg(F.bool_and(F.col("label").isNotNull() & (F.col("_n") == 1)).alias("_ok"))
    names = F.array(*[F.lit(c) for c in levels])
    best = judged.groupBy(*keys).agg(F.min(F.when(F.col("_ok"), F.col("level"))).alias("_level"))
    return best.select(*keys, F.try_element_at(names, F.col("_level") + 1).alias("handle"))


def with_handle(df: DataFrame, keys: Sequence[str], sample: str, levels: Sequence[str]) -> DataFrame:
    """Attach the chosen label to every sample; where nothing is unique each row takes its own first filled one."""
    chosen = df.join(pick_handle(df, keys, sample, levels), list(keys))
    by_level = case_when([(F.col("handle") == c, F.col(c).cast("string")) for c in levels],
                         F.coalesce(*[nonblank(F.col(c).cast("string")) for c in levels], F.lit("")))
    return chosen.withColumn("sample_label", by_level).withColumn("handle", F.coalesce("handle", F.lit("none unique")))


def canonical_field(c: Column, aliases: dict[str, str] = V.CLAIM_ALIASES) -> Column:
    pairs = [x for k, v in aliases.items() for x in (F.lit(k), F.lit(v))]
    low = F.lower(F.trim(c))
    return F.coalesce(F.try_element_at(F.create_map(*pairs), low), low)


def merge_defaults(claims: DataFrame, defaults: DataFrame, fields: Sequence[str] = V.CLAIM_FIELDS) -> DataFrame:
    """Every sample gets every field: its own value, else the paper-wide default (tagged), else unknown.

    claims: paper, sample, field, value, confidence, evidence, position; defaults: paper, field, value, confidence, evidence.
    """
    claim = F.struct("value", "confidence", "evidence")
    own = claims.withColumn("field", canonical_field(F.col("field"))).groupBy("paper", "sample", "field").agg(F.min_by(claim, "position").alias("_own"))
    paper = defaults.withColumn("field", canonical_field(F.col("field"))).groupBy("paper", "field").agg(F.min_by(claim, "field").alias("_def"))
    grid = claims.select("paper", "sample").distinct().select("paper", "sample", F.explode(F.array(*[F.lit(f) for f in fields])).alias("field"))
    both = grid.join(own, ["paper", "sample", "field"], "left").join(paper, ["paper", "field"], "left")
    use_own = nonblank(F.col("_own.value")).isNotNull()
    use_def = ~use_own & nonblank(F.col("_def.value")).isNotNull()
    tagged = F.trim(F.concat(F.coalesce("_def.evidence", F.lit("")), F.lit(" [paper-wide default]")))
    keep = F.col("_own").isNotNull()
    pick = lambda f, d: F.when(use_def, F.col(f"_def.{f}") if f != "evidence" else tagged).when(keep, F.col(f"_own.{f}")).otherwise(F.lit(d))
    return both.select("paper", "sample", "field", pick("value", "").alias("value"), pick("confidence", "unknown").alias("confidence"), pick("evidence", "").alias("evidence"),
                       (keep | F.col("_def").isNotNull()).alias("is_given"))


def validate_claims(resolved: DataFrame, expected: DataFrame, required: Sequence[str] = V.REQUIRED_CLAIM_FIELDS) -> DataFrame:
    """Problem rows of a set of claims: paper, sample, field, problem. expected: paper, sample."""
    confirmed = F.coalesce(F.col("confidence") == "confirmed", F.lit(False))
    problem = case_when(
        [(F.col("field").isin(list(required)) & ~F.col("is_given"), F.lit("required field is missing")),
         (~F.coalesce(F.trim("confidence").isin(V.CONFIDENCE_LEVELS), F.lit(False)), F.lit("confidence is not a known level")),
         (confirmed & blank(F.col("evidence")), F.lit("confirmed with no evidence")), (confirmed & blank(F.col("value")), F.lit("confirmed but the value is empty"))],
        F.lit(None).cast("string"))
    rows = resolved.select("paper", "sample", "field", problem.alias("problem")).where("problem IS NOT NULL")
    seen = resolved.select("paper", "sample").distinct().withColumn("_s", F.lit(True))
    want = expected.select("paper", "sample").distinct().withColumn("_w", F.lit(True))
    sides = seen.join(want, ["paper", "sample"], "full_outer").where("_s IS NULL OR _w IS NULL")
    gaps = sides.select("paper", "sample", F.lit("").alias("field"), F.when(F.col("_s").isNull(), F.lit("sample absent from the answer")).otherwise(F.lit("sample was not expected")).alias("problem"))
    return rows.unionByName(gaps)


def gate_facts(samples: DataFrame, key: str = "paper") -> DataFrame:
    """Counts the gate needs, over samples that are no controls.

    samples: key, is_technical_control, sample_label, paper_sample_id, experimental_group.
    """
    absent = lambda c: F.coalesce(nonblank(F.col(c)).isin(V.UNRESOLVED, V.NOT_REPORTED), F.lit(True))
    bio = samples.where(~truthy(F.col("is_technical_control").cast("string")))
    per_label = bio.groupBy(key, nonblank(F.col("sample_label")).alias("_label")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(~absent("paper_sample_id")).alias("_id"), F.count_if(~absent("experimental_group")).alias("_grp"))
    return per_label.groupBy(key).agg(
        F.sum("_n").alias("n_samples"), F.sum("_id").alias("n_own_id"), F.sum("_grp").alias("n_grouped"),
        F.coalesce(F.sum(F.when(F.col("_label").isNull(), F.col("_n"))), F.lit(0)).alias("n_unnamed"),
        F.coalesce(F.sum(F.when(F.col("_label").isNotNull(), F.col("_n") - 1)), F.lit(0)).alias("n_repeated"))


def metadata_gate(df: DataFrame) -> DataFrame:
    """blocked / pass_quantification_only / pass with the reasons.

    Input: n_blockers, n_samples, n_own_id, n_grouped, n_unnamed, n_repeated, n_missing_facts, facts_confidence.
    """
    blocked, indistinct = F.col("n_blockers") > 0, (F.col("n_unnamed") > 0) | (F.col("n_repeated") > 0)
    unsure = F.coalesce(F.col("facts_confidence"), F.lit("unknown")) != "confirmed"
    limited = (F.col("n_grouped") < F.col("n_samples")) | unsure | (F.col("n_missing_facts") > 0)
    gate = case_when([(blocked | indistinct, F.lit("blocked")), (limited, F.lit("pass_quantification_only"))], F.lit("pass"))
    partial = reasons([
        (F.col("n_grouped") < F.col("n_samples"), F.format_string("group label confirmed for only %d of %d samples", F.col("n_grouped").cast("bigint"), F.col("n_samples").cast("bigint"))),
        (F.col("n_own_id") < F.col("n_samples"), F.format_string("own sample id confirmed for only %d of %d", F.col("n_own_id").cast("bigint"), F.col("n_samples").cast("bigint"))),
        (F.col("n_missing_facts") > 0, "key experimental facts missing"), ((F.col("n_missing_facts") == 0) & unsure, "key experimental facts not confirmed")], "; ")
    reason = case_when(
        [(blocked, F.format_string("%d blocking problem(s)", F.col("n_blockers").cast("bigint"))),
         (indistinct, F.format_string("%d sample(s) without a name, %d name(s) repeated", F.col("n_unnamed").cast("bigint"), F.col("n_repeated").cast("bigint"))),
         (limited, partial)], F.lit(""))
    return df.withColumns({"gate": gate, "gate_reason": reason})


def split_controls(samples: DataFrame, alias: str, flag: Column, prefixes: Column | Sequence[str], evidence: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped with the reasons). A control is flagged, or its alias starts with a listed prefix."""
    listed = prefixes if isinstance(prefixes, Column) else F.array(*[F.lit(p) for p in prefixes]).cast("array<string>")
    flagged = truthy(flag.cast("string"))
    named = F.coalesce(F.exists(listed, lambda p: F.startswith(F.col(alias), p)), F.lit(False))
    why = reasons([
        (flagged, F.concat(F.lit("flagged as technical control ("), F.coalesce(evidence if evidence is not None else F.lit(None).cast("string"), F.lit("no evidence recorded")), F.lit(")"))),
        (named, "alias prefix listed for exclusion")], "; ")
    tagged = samples.withColumn("excluded_because", why)
    return tagged.where("excluded_because = ''").drop("excluded_because"), tagged.where("excluded_because <> ''")
