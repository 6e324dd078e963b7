"""Runs, their states and the warnings of a report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def collect_runs(instances: DataFrame, pool: str, since: str) -> DataFrame:
    """Task runs of a pool that began since a time, with their duration in seconds (null while they run)."""
    began = instances.filter((F.col("pool") == pool) & (F.col("start_date") >= F.lit(since).cast("timestamp")))
    seconds = F.unix_timestamp("end_date") - F.unix_timestamp("start_date")
    return began.select("dag_id", "task_id", "run_id", F.coalesce("state", F.lit("(None)")).alias("state"), "start_date", "end_date", "try_number", seconds.alias("duration"))


def run_states(runs: DataFrame, jobs: DataFrame) -> DataFrame:
    """For each job (dag_id) its runs, states as 'failed:1, success:3', and total, longest and mean duration; jobs without
    a run too. A run of no length counts as without a duration."""
    per_state = runs.groupBy("dag_id", "state").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("duration") != 0, F.col("duration"))).alias("total"), F.max(F.when(F.col("duration") != 0, F.col("duration"))).alias("longest"), F.count(F.when(F.col("duration") != 0, 1)).alias("timed"))
    entry = F.struct("state", F.concat_ws(":", "state", F.col("n").cast("string")).alias("text"))
    per_job = per_state.groupBy("dag_id").agg(F.sum("n").alias("runs"), F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda s: s["text"]), ", ").alias("states"), F.sum("total").alias("total"), F.max("longest").alias("longest"), (F.sum("total") / F.sum("timed")).alias("mean"))
    return jobs.select("dag_id").distinct().join(per_job, "dag_id", "left").na.fill(0, ["runs"])


def warnings(runs: DataFrame, touched: DataFrame, live: DataFrame, jobs: DataFrame, expected: DataFrame, outcomes: DataFrame, empty_labels: DataFrame, window_seconds: float, alive: bool = True, idle_below: float = 0.5) -> DataFrame:
    """code, subject, n: what a report warns of.

    runs (dag_id, state, duration); touched (dag_id, label); live: task instances (dag_id, state) that hold a slot; jobs
    (dag_id, is_paused); expected (dag_id, continuous: a job that holds its slot for hours); outcomes (platform, runs,
    skipped, seen, downloaded, budget_hit); empty_labels (label). alive: whether the scheduler's process was found.
    idle_below: the share of the window below which a busy slot counts as idle."""
    one = F.lit(1).cast("long")
    per_job = runs.groupBy("dag_id").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("state").isin("failed", "up_for_retry"), 1)).alias("bad"))
    labels = touched.groupBy("dag_id").agg(F.countDistinct("label").alias("labels"))
    stuck = per_job.join(labels, "dag_id", "left").filter("n >= 3 AND coalesce(labels, 0) <= 1")
    zombie = (F.col("state") == "running") & (not alive)
    held = live.filter(F.col("state").isin("running", "queued", "restarting")).groupBy("dag_id", F.when(zombie, "zombie").otherwise("holds_slot").alias("code")).agg(F.count(F.lit(1)).alias("n"))
    known = expected.join(jobs, "dag_id", "left")
    busy = runs.agg(F.coalesce(F.sum("duration"), F.lit(0)).alias("busy"))
    idle = busy.filter(F.lit(window_seconds > 0) & (F.col("busy") / F.lit(float(window_seconds) or 1.0) < idle_below))
    no_budget = outcomes.agg(F.count(F.lit(1)).alias("k"), F.coalesce(F.sum("budget_hit"), F.lit(0)).alias("hits")).filter("k > 0 AND hits = 0")
    empty = empty_labels.agg(F.count(F.lit(1)).alias("n")).filter("n > 0")  # one row beside one row
    parts = [
        stuck.select(F.lit("stuck_cursor").alias("code"), F.col("dag_id").alias("subject"), "n"),
        held.select("code", F.col("dag_id").alias("subject"), "n"),
        known.filter("continuous AND NOT is_paused").select(F.lit("continuous_on").alias("code"), F.col("dag_id").alias("subject"), one.alias("n")),
        known.filter("NOT continuous AND is_paused").select(F.lit("paused").alias("code"), F.col("dag_id").alias("subject"), one.alias("n")),
        known.filter("is_paused IS NULL").select(F.lit("unknown").alias("code"), F.col("dag_id").alias("subject"), one.alias("n")),
        idle.select(F.lit("idle").alias("code"), F.lit("slot").alias("subject"), F.floor(F.col("busy") / F.lit(float(window_seconds) or 1.0) * 100).cast("long").alias("n")),
        outcomes.filter("skipped > 0").select(F.lit("skipped").alias("code"), F.col("platform").alias("subject"), F.col("skipped").cast("long").alias("n")),
        outcomes.filter("skipped = 0 AND runs > 0 AND downloaded = 0").select(F.lit("no_downloads").alias("code"), F.col("platform").alias("subject"), F.col("seen").cast("long").alias("n")),
        empty.join(F.broadcast(no_budget), F.lit(True)).select(F.lit("discovery_bound").alias("code"), F.lit("labels").alias("subject"), "n"),
        per_job.filter("bad > 0").select(F.lit("failures").alias("code"), F.col("dag_id").alias("subject"), F.col("bad").alias("n")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def section(rows: DataFrame, no: int, title: str, order: list[Column], most: int = 1000) -> DataFrame:
    """section, ord, line: an aggregate's rows as a table of a report, under its title. Nulls are a dash, and what would end a cell
    is escaped. Over ``most`` rows are an error of the running query, not a cut."""
    cells = [F.replace(F.regexp_replace(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("-")), r"\s+", " "), F.lit("|"), F.lit("\\|")) for c in rows.columns]
    ranked = rows.select(F.row_number().over(Window.orderBy(*order)).alias("n"), F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))
    sound = F.when(F.col("n") > most, F.raise_error(F.lit(f"over {most} rows in {title!r}"))).otherwise(F.col("line"))
    head = [f"## {title}", "| " + " | ".join(rows.columns) + " |", "|" + "---|" * len(rows.columns)]
    top = rows.sparkSession.range(1).select(F.posexplode(F.array(*map(F.lit, head))).alias("ord", "line"))
    body = ranked.select((F.col("n") + len(head) - 1).alias("ord"), sound.alias("line"))
    return top.unionByName(body).select(F.lit(no).alias("section"), "ord", "line")


def report(sections: list[tuple[str, DataFrame, list[Column]]]) -> DataFrame:
    """section, ord, line of a whole report, in order."""
    out = None
    for no, (title, rows, order) in enumerate(sections, 1):
        part = section(rows, no, title, order)
        out = part if out is None else out.unionByName(part)
    return out.orderBy("section", "ord")


def write_report(lines: DataFrame, path: str) -> None:
    """A report's lines as one text file, in order; they are as many as its tables have rows, a bounded number."""
    lines.coalesce(1).sortWithinPartitions("section", "ord").select("line").write.mode("overwrite").text(path)
