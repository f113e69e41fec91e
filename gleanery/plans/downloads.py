"""Download planning: what is there, what is shared, what is still to be fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.outcome import MIN_FILE_BYTES
from gleanery.operators.keep import first_k, latest
from gleanery.operators.ordered import blocks, finish, running
from gleanery.operators.skew import lookup

HAS_DOCUMENT = "documentoUuid is not null and documentoUuid <> ''"


def by_document(manifest: DataFrame) -> DataFrame:
    """Last manifest entry of each document, in file order."""
    return latest(manifest, "documentoUuid").select("documentoUuid", "archivo", "bytes", "sha256")


def download_plan(
    records: DataFrame,
    manifest: DataFrame,
    probe: DataFrame,
    file_name: Column,
    min_bytes: int = MIN_FILE_BYTES,
    dry_run: bool = False,
) -> DataFrame:
    """Records with ``state`` and ``archivo``.

    ``no-document``; ``present``: noted and on disk, or on disk under its own name; else
    the first record of the document is ``pending`` and later ones are ``shared``. A dry
    run fetches nothing, so there every record of the document is pending.

    What decides is worked out once per document. Only the last join is per record, and documents
    that very many records share are split there by adaptive execution.
    """
    probe = probe.where(F.col("bytes") >= min_bytes)
    named = records.where(HAS_DOCUMENT).withColumn("_name", file_name)
    names = named.groupBy("documentoUuid", "_name").agg(F.min("indice").alias("_at"))
    found = names.join(probe.select(F.col("archivo").alias("_name"), F.lit(True).alias("_there")), "_name", "left")
    documents = found.groupBy("documentoUuid").agg(
        F.min("_at").alias("_first"), F.min(F.when(F.col("_there"), F.col("_at"))).alias("_first_there")
    )
    noted = by_document(manifest).select("documentoUuid", F.col("archivo").alias("_noted"))
    on_disk = noted.join(probe.select(F.col("archivo").alias("_noted")), "_noted", "left_semi")
    documents = documents.join(on_disk, "documentoUuid", "left")
    own = F.col("_first_there") <= F.col("indice") if dry_run else F.col("_first_there") == F.col("_first")
    later = F.lit(False) if dry_run else F.col("indice") > F.col("_first")
    present = F.col("_noted").isNotNull() | F.coalesce(own, F.lit(False))
    state = F.when(present, "present").when(later, "shared").otherwise("pending")
    planned = lookup(named, documents, ["documentoUuid"])
    planned = planned.select(*records.columns, state.alias("state"), F.coalesce("_noted", "_name").alias("archivo"))
    without = records.where(f"not coalesce({HAS_DOCUMENT}, false)").select(
        "*", F.lit("no-document").alias("state"), F.lit(None).cast("string").alias("archivo")
    )
    return planned.unionByName(without)


def next_downloads(plan: DataFrame, n: int) -> DataFrame:
    """The first ``n`` pending downloads in reading order."""
    return plan.where("state = 'pending'").orderBy("indice").limit(n)


def reached(plan: DataFrame, n: int) -> DataFrame:
    """The plan's rows in reading order, as far as a run gets that stops after ``n`` new downloads: with ``reached``, whether it comes to the row.

    A row is reached if fewer than ``n`` downloads come before it, whatever it is itself. The count runs over ranges of the order, so
    no task sorts the whole plan."""
    narrow = plan.select("id", "indice", "pagina", "state")
    counted = running(blocks(narrow, [], ["indice", "id", "state"]), {"_before": ("sum", (F.col("state") == "pending").cast("bigint"))}, inclusive=False)
    return finish(counted).select("id", "indice", "pagina", "state", (F.col("_before") < n).alias("reached"))


def pages_reached(run: DataFrame) -> DataFrame:
    """Per page that a limited run comes to: rows reached, downloads, whether it is ``complete``, and whether the limit was met in the run.

    A page that the limit cuts is not complete, so a resumed run reads it again. A limit that the very last row meets cuts nothing."""
    pages = run.groupBy("pagina").agg(
        F.count_if("reached").alias("rows"), F.count_if(F.col("reached") & (F.col("state") == "pending")).alias("downloads"),
        F.bool_and("reached").alias("complete"),
    )
    met = run.agg(F.bool_or(~F.col("reached")).alias("limit_met"))
    return pages.where("rows > 0").crossJoin(F.broadcast(met))  # one row


def shared_downloads(records: DataFrame) -> DataFrame:
    """Records whose document an earlier record has already brought."""
    with_doc = records.where(HAS_DOCUMENT)
    first = with_doc.groupBy("documentoUuid").agg(F.min("indice").alias("_first"))
    joined = lookup(with_doc, first, ["documentoUuid"])
    return joined.where("indice > _first").drop("_first")


def manifest_entries(plan: DataFrame, probe: DataFrame, manifest: DataFrame, now: Column) -> DataFrame:
    """Entries to append: one per record whose file is there and that is not noted yet."""
    there = plan.where("state = 'present'").select("id", "fuente", "documentoUuid", "pagina", "indice", "archivo")
    # One entry per record: of identical rows the first is noted.
    there = first_k(there, ["id"], [F.col("indice")])
    new = there.join(manifest.select("id").distinct(), "id", "left_anti")
    return lookup(new, probe.select("archivo", "bytes", "sha256"), ["archivo"], "inner").select(
        "id", "fuente", "documentoUuid", "pagina", "indice", "archivo", "bytes", "sha256",
        F.lit(None).cast("string").alias("nombreServidor"), now.alias("descargadoEn"),
    )


def run_summary(plan: DataFrame, results: DataFrame) -> DataFrame:
    """One row: downloaded, present, shared, without document, failed, pending, bytes, success in %.

    ``results`` has ``id, result, bytes`` of the transfers that were tried, one row per id.
    """
    tried = results.select("id", "result", F.col("bytes").alias("_bytes"))
    state = F.when((F.col("state") == "pending") & (F.col("result") == "ok"), "downloaded").when(
        (F.col("state") == "pending") & F.col("result").isNotNull(), "failed"
    ).otherwise(F.col("state"))
    pending = plan.where("state = 'pending'").select("id", "state").join(tried, "id", "left")
    other = plan.where("state <> 'pending'").select(
        "id", "state", F.lit(None).cast("string").alias("result"), F.lit(None).cast("bigint").alias("_bytes")
    )
    whole = pending.unionByName(other).withColumn("state", state)

    def count(name: str) -> Column:
        return F.count_if(F.col("state") == name)

    ok, failed = count("downloaded"), count("failed")
    return whole.agg(
        ok.alias("downloaded"),
        count("present").alias("present"),
        count("shared").alias("shared"),
        count("no-document").alias("no_document"),
        failed.alias("failed"),
        count("pending").alias("pending"),
        F.coalesce(F.sum(F.when(F.col("state") == "downloaded", F.col("_bytes"))), F.lit(0)).alias("bytes"),
        F.round(F.try_divide(ok * 100.0, ok + failed), 1).alias("success_pct"),
    )


def run_status(failed: Column, misuse: Column, findings: Column) -> Column:
    """Meaning of a job's exit: 0 ok, 1 failed, 2 misuse, 3 finished with findings or failures."""
    return F.when(misuse, 2).when(failed, 1).when(findings, 3).otherwise(0)
