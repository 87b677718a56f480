"""Operations: inventory metrics, page budgets, chunks of pages, checkpoints, job states and run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagewright.operators.catalog import latest

#: What jobs call their states.
STATES = {
    "queued": "pending", "waiting": "pending", "in_progress": "running", "processing": "running", "success": "succeeded", "completed": "succeeded",
    "error": "failed", "failure": "failed", "needs_review": "review", "canceled": "cancelled",
}
KNOWN = ("pending", "running", "succeeded", "failed", "review", "cancelled", "unknown")


def duplicate_groups(files: DataFrame, content: str, path: str) -> DataFrame:
    """Groups of equal content (by SHA-256) with their number and their sorted paths, in one aggregation over digests and paths."""
    found = files.select(F.sha2(F.coalesce(F.col(content), F.lit("").cast(files.schema[content].dataType)), 256).alias("sha256"), path)
    return found.groupBy("sha256").agg(F.count("*").alias("copies"), F.array_sort(F.collect_list(path)).alias("paths")).where("copies > 1")


def inventory_metrics(files: DataFrame, content: str, size: str) -> DataFrame:
    """How many files there are, how many distinct, how many spare copies, and their total size."""
    per = files.groupBy(F.sha2(F.coalesce(F.col(content), F.lit("")), 256).alias("sha256")).agg(F.count("*").alias("n"), F.sum(size).alias("bytes"))
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("file_count"), F.count("*").alias("unique_count"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_file_count"),
        F.count_if(F.col("n") > 1).alias("duplicate_groups"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"),
    )


def page_chunks(pages: DataFrame, size: int, key: list[str], order: list[str]) -> DataFrame:
    """Numbers a document's pages in chunks of ``size``, from 1."""
    if not 1 <= size <= 100:
        raise ValueError("chunks have 1 to 100 pages")
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return pages.withColumn("chunk", F.floor((place - 1) / size) + 1)


def page_budget(docs: DataFrame, pages: str, order: str, budget: int, per_document: int, group: list[str], status: str | None = None) -> DataFrame:
    """How many pages of each document are taken when documents of a group draw on one budget in order.

    With ``status`` only documents that succeeded or are in review spend what they take; failed ones report no pages and spend none. What a document takes is
    bounded by the budget that is left, so what it spends is that or nothing, and the sum of what came before is all that it depends on.
    """
    capped = docs.withColumn("wanted", F.least(F.col(pages), F.lit(per_document)))
    spends = F.col("wanted") if status is None else F.when(F.col(status).isin("succeeded", "review"), F.col("wanted")).otherwise(0)
    before = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    spent = F.coalesce(F.sum(spends).over(before), F.lit(0))
    return capped.withColumn("taken", F.greatest(F.lit(0), F.least(F.col("wanted"), F.lit(budget) - spent)).cast("long"))


def sequence_gaps(rows: DataFrame, key: list[str], number: str, tie: list[str]) -> DataFrame:
    """Rows whose number does not lie above the one before it."""
    previous = F.lag(number).over(Window.partitionBy(*key).orderBy(*tie))
    return rows.withColumn("previous", previous).where(F.col(number) <= F.col("previous"))


def checkpoint_latest(events: DataFrame, key: str, newest: list[str]) -> DataFrame:
    return latest(events, [key], newest)


def counts(rows: DataFrame, status: str) -> DataFrame:
    return rows.groupBy(F.col(status).alias("status")).agg(F.count("*").alias("n"))


def job_states(rows: DataFrame, state: str) -> DataFrame:
    """Rows with ``state`` in one vocabulary; what is in none of it is ``unknown``."""
    table = F.create_map(*[F.lit(x) for pair in STATES.items() for x in pair])
    low = F.lower(F.trim(state))
    own = F.coalesce(F.try_element_at(table, low), low)
    return rows.withColumn("state", F.when(own.isin(*KNOWN), own).otherwise("unknown"))


#: What statuses of runs and jobs call their kind, alone or after a prefix of their own, and their files' names.
STATUS_KINDS = ("benchmark-run", "job", "job-status", "run-status")
STATUS_FILES = ("job_status.json", "run_status.json")


def is_status_payload(payload: Column, path: Column) -> Column:
    """Whether a JSON text is the status of a run or job: by its kind where it has one, else by a state together with an identity or its file's name."""
    get = lambda k: F.get_json_object(payload, f"$.{k}")
    kind = F.lower(F.trim(get("kind")))
    named = F.coalesce(get("run_id"), get("job_id")).isNotNull() | F.lower(F.substring_index(path, "/", -1)).isin(*STATUS_FILES)
    by_kind = kind.rlike(rf"^(?:.*-)?(?:{'|'.join(STATUS_KINDS)})$")
    return F.coalesce(F.when(kind != "", by_kind).otherwise(F.coalesce(get("state"), get("status")).isNotNull() & named), F.lit(False))


def run_summary(documents: DataFrame, status: str, metrics: dict[str, str]) -> DataFrame:
    """Documents by status and sums of metrics, in one row."""
    by = [F.count_if(F.col(status) == s).alias(f"documents_{s.lower()}") for s in ("succeeded", "review", "failed")]
    return documents.agg(F.count("*").alias("documents"), *by, *[F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in metrics.items()])
