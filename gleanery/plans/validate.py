"""The validation report over stored records, their manifest, files and failure queue.

A check that has no input to look at is ``no-evaluable``: an absent DataFrame (``None``)
means that, an empty one does not. Every check is emitted, always in the same order.

The scalar checks share one aggregate over the records. The checks on sets share one shuffle
by key, with partial aggregation before it, so copies of one key are merged early.
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.functions.paging import page_of_index
from gleanery.operators.findings import (
    ERROR, NOT_EVALUABLE, OK, WARNING, Finding, counted, findings_frame, numbers, samples, shown,
)
from gleanery.operators.keep import MAX_SAMPLES, first_k, repeats
from gleanery.operators.positions import first_missing
from gleanery.operators.skew import null_safe, union_all
from gleanery.operators.together import together
from gleanery.sources.control import checkpoint_scan
from gleanery.sources.files import probe_hash, probe_stat
from gleanery.sources.jsonl import CORRUPT, MISTYPED, CorruptLine, check_lines, scan_tolerant, scan_whole
from gleanery.sources.manifest import REQUIRED, queue_scan
from gleanery.sources.schema import MANIFEST_SCHEMA, QUEUE_SCHEMA
from gleanery.sources.sinks import settle
from gleanery.sources.spec import SourceSpec

DATASET, DOCUMENTS, SITE = "dataset", "documents", "site"


def repeated_lines(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first lines that repeat a key already seen, enough of each key to show samples."""
    w = Window.partitionBy(key).orderBy(*order)
    # The upper bound on the rank limits every key before the shuffle.
    ranked = rows.select(key, *order).withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= MAX_SAMPLES + 1)
    return ranked.where("_rank >= 2").drop("_rank")


def dataset_profile(records: DataFrame, spec: SourceSpec, page_size: int) -> DataFrame:
    """One row: lines, valid, invalid, distinct ids, greatest index, misplaced pages."""
    valid = F.size(spec.issues()) == 0
    page = page_of_index(F.col("indice"), page_size)
    return records.select(valid.alias("valid"), "id", "indice", (page != F.col("pagina")).alias("off")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if("valid").alias("valid"),
        F.count_if(~F.col("valid")).alias("invalid"),
        F.count_distinct(F.when(F.col("valid"), F.col("id"))).alias("distinct_ids"),
        F.coalesce(F.max(F.when(F.col("valid"), F.col("indice"))), F.lit(-1)).alias("max_index"),
        F.count_if(F.col("valid") & F.col("off")).alias("misplaced"),
    )


def blank_fields(valid: DataFrame, spec: SourceSpec) -> DataFrame:
    """Blanks per required field, every field listed."""
    names = list(spec.blank_rules)
    counts = valid.agg(*[F.count_if(spec.blank_rules[n]()).alias(n) for n in names])
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return counts.selectExpr(f"stack({len(names)}, {pairs}) as (field, n)")


def shared_documents(valid: DataFrame) -> DataFrame:
    """Documents that reach more than one record, and whether case or ruling differ among them."""
    groups = valid.where("documentoUuid is not null").groupBy("documentoUuid").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("indice").alias("first_index"),
        *[f(c).alias(f"_{a}_{c}") for c in ("expediente", "resolucion") for a, f in (("lo", F.min), ("hi", F.max))],
    )
    differ = (F.col("_lo_expediente") != F.col("_hi_expediente")) | (F.col("_lo_resolucion") != F.col("_hi_resolucion"))
    return groups.where("n > 1").select("documentoUuid", "n", "first_index", differ.alias("heterogeneous"))


def declared_total(live: int | None, given: int | None, checkpoint: int | None) -> tuple[int | None, str | None]:
    """Total to hold the records against, and where it comes from."""
    for value, origin in ((live, "site"), (given, "parameter"), (checkpoint, "checkpoint")):
        if value is not None:
            return value, origin
    return None, None


def declared_total_columns(live: Column, given: Column, checkpoint: Column) -> list[Column]:
    """The same for a table of sources: ``total`` and ``origin`` per row."""
    origin = F.when(live.isNotNull(), "site").when(given.isNotNull(), "parameter").when(checkpoint.isNotNull(), "checkpoint")
    return [F.coalesce(live, given, checkpoint).alias("total"), origin.alias("origin")]


def year_missing(valid: DataFrame) -> DataFrame:
    """Records without a ruling year: with a document that is an error, without one it is not."""
    lacks, doc = F.col("anioResolucion").isNull(), F.col("documentoUuid").isNotNull()
    return valid.agg(F.count_if(lacks & doc).alias("with_document"), F.count_if(lacks & ~doc).alias("without_document"))


def no_document(valid: DataFrame) -> DataFrame:
    """Records without a document, of how many identities."""
    return valid.agg(F.count_if(F.col("documentoUuid").isNull()).alias("n"), F.count_distinct("id").alias("of"))


def download_coverage(manifest: DataFrame, valid: DataFrame) -> DataFrame:
    """Distinct ids noted against records with a document, as one row."""
    noted = manifest.agg(F.count_distinct("id").alias("n")).select(F.lit("noted").alias("k"), "n")
    with_doc = valid.where("documentoUuid <> ''").agg(F.count(F.lit(1)).alias("n")).select(F.lit("with_document").alias("k"), "n")
    both = noted.unionByName(with_doc)
    return both.agg(*[F.max(F.when(F.col("k") == k, F.col("n"))).alias(k) for k in ("noted", "with_document")])


def marks(records: DataFrame, spec: SourceSpec, page_size: int) -> DataFrame:
    """What the checks need of each record, in few narrow columns.

    Rules read every column, lists and long texts too. They are evaluated once here, and
    the checks, which pass over the records several times, read the settled result.
    """
    good, nothing = F.size("_issues") == 0, F.array().cast("array<string>")
    blanks = [F.when(rule(), F.lit(n)) for n, rule in spec.blank_rules.items()]
    kept = {
        "good": good,
        "issues": F.when(~good, F.array_join("_issues", " | ")),
        "misplaced": good & (page_of_index(F.col("indice"), page_size) != F.col("pagina")),
        "blanks": F.when(good, F.array_compact(F.array(*blanks))).otherwise(nothing) if blanks else nothing,
        "no_year": good & F.col("anioResolucion").isNull() if spec.has_year else F.lit(False),
    }
    columns = ["fuente", "id", "indice", "pagina", "documentoUuid"]
    columns += ["expediente", "resolucion"] if spec.blank_rules else []
    for i, check in enumerate(spec.checks):
        kept |= {f"check_{i}": F.when(good & check.rule(), check.label().cast("string"))} if check.rule else {}
        kept |= {f"key_{i}": F.when(good, check.key().cast("string"))} if check.key else {}
    issues = spec.issues()
    if CORRUPT in records.columns:  # a line that is no JSON is no record: neither a good one nor one that breaks a rule
        kept["torn"] = F.col(CORRUPT).isNotNull()
    if MISTYPED in records.columns:  # a field of another type reads as NULL, which a rule may allow
        issues = F.concat(issues, F.transform(MISTYPED, lambda name: F.concat(name, F.lit(": another type"))))
    marked = records.withColumn("_issues", issues)
    return marked.select(*columns, *[F.coalesce(c, F.lit(False)).alias(n) if n in ("good", "misplaced", "no_year", "torn") else c.alias(n) for n, c in kept.items()])


def dataset_findings(
    records: DataFrame, spec: SourceSpec, page_size: int, total: int | None = None, corrupt: int = 0
) -> DataFrame:
    """The nine structural checks, then the domain checks of a source that has them."""
    return findings_of_marks(settle(marks(records, spec, page_size), "marks"), spec, total, corrupt)


def _sets(valid: DataFrame, spec: SourceSpec) -> DataFrame:
    """Rows per id, position, source and document, all in one shuffle: ``kind, key, n, at, differ``."""
    kinds = [("id", F.col("id")), ("place", F.col("indice").cast("string")), ("source", F.col("fuente"))]
    kinds += [(f"check_{i}", F.col(f"key_{i}")) for i, c in enumerate(spec.checks) if c.key]
    fields = []
    if spec.blank_rules:
        kinds.append(("document", F.col("documentoUuid")))
        fields = ["expediente", "resolucion"]
    listed = F.array(*[F.struct(F.lit(k).alias("kind"), c.alias("key")) for k, c in kinds])
    # What documents are compared by is carried for them alone.
    carried = [F.when(F.col("k.kind") == "document", F.xxhash64(F.col(f))).alias(f) for f in fields]
    keyed = valid.select(F.explode(listed).alias("k"), "indice", *fields).select("k.*", "indice", *carried)
    differ = F.lit(False)
    for f in fields:
        differ = differ | F.coalesce(F.min(f) != F.max(f), F.lit(False))
    return keyed.where("key is not null").groupBy("kind", "key").agg(
        F.count(F.lit(1)).alias("n"), F.min("indice").alias("at"), differ.alias("differ")
    )


def _samples(wanted: list[tuple], spark) -> dict[str, list[str]]:
    few: dict[str, list[str]] = {}
    for found in together(spark, [lambda w=w: samples(*w) for w in wanted]):
        few |= found
    return few


def findings_of_marks(marked: DataFrame, spec: SourceSpec, total: int | None = None, corrupt: int = 0) -> DataFrame:
    """Two jobs count everything; samples are looked for only where a check has cases."""
    valid, with_doc = marked.where("good"), F.col("documentoUuid").isNotNull()
    spark, every = marked.sparkSession, F.lit(True)
    scalars = marked.agg(
        F.count_if("good").alias("valid"),
        F.count_if(~F.col("good")).alias("invalid"),
        F.count_if("misplaced").alias("misplaced"),
        (F.max(F.when(F.col("good"), F.col("indice"))) + 1).alias("bound"),
        F.count_if(F.col("good") & ~with_doc).alias("without_doc"),
        F.count_if(F.col("no_year") & with_doc).alias("no_year"),
        *[F.count_if(F.array_contains("blanks", f)).alias(f"blank:{f}") for f in spec.blank_rules],
        *[F.count(f"check_{i}").alias(f"check_{i}") for i, c in enumerate(spec.checks) if c.rule],
    )
    sets = _sets(valid, spec)
    several = F.col("n") > 1
    per_kind = sets.groupBy("kind").agg(
        F.count(F.lit(1)).alias("keys"), F.sum(F.col("n") - 1).alias("repeats"),
        F.count_if(several).alias("several"), F.count_if(several & F.col("differ")).alias("mixed"),
    )
    none = {"keys": 0, "repeats": 0, "several": 0, "mixed": 0}
    n, counts = together(spark, [lambda: numbers(scalars), per_kind.collect])
    by = {"id": none, "place": none, "source": none, "document": none} | {r["kind"]: r.asDict() for r in counts}
    missing = n["bound"] - by["place"]["keys"]
    blanks = {f: n[f"blank:{f}"] for f in spec.blank_rules}

    kinds = [("invalid", ~F.col("good"), F.col("issues")),
             ("misplaced", F.col("misplaced"), F.concat_ws(" ", F.lit("index"), "indice", F.lit("page"), "pagina")),
             ("no_year", F.col("no_year") & with_doc, F.col("resolucion") if spec.has_year else F.lit(""))]
    kinds += [(f"check_{i}", F.col(f"check_{i}").isNotNull(), F.col(f"check_{i}")) for i, c in enumerate(spec.checks) if c.rule]
    here = [
        *[k for k in kinds if n[k[0]]],
        *[("blank", F.array_contains("blanks", f), F.concat("id", F.lit(f":{f}"))) for f, c in blanks.items() if c],
    ]
    wanted = [(marked, here, [F.col("indice"), F.col("id")])] if here else []
    if by["id"]["repeats"]:
        again = repeated_lines(valid, "id", ["indice", "pagina"])
        wanted.append((again, [("id", every, F.col("id"))], [F.col("indice"), F.col("id")]))
    if by["source"]["keys"] > 1:
        wanted.append((sets.where("kind = 'source'"), [("source", every, F.col("key"))], [F.col("at"), F.col("key")]))
    if by["document"]["mixed"]:
        mixed = several & F.col("differ")
        wanted.append((sets.where("kind = 'document'"), [("mixed", mixed, F.col("key"))], [F.col("at"), F.col("key")]))
    if by["place"]["repeats"]:
        # Every further row of a position is a case; five of one position fill the samples.
        nth = F.explode(F.sequence(F.lit(1), F.least(F.col("n") - 1, F.lit(MAX_SAMPLES)).cast("int")))
        twice = sets.where(several & (F.col("kind") == "place")).select("key", "at", nth.alias("nth_row"))
        wanted.append((twice, [("place", every, F.col("key"))], [F.col("at"), F.col("nth_row")]))
    for i, c in enumerate(spec.checks):
        if c.key and by.get(f"check_{i}", none)["repeats"]:
            wanted.append((sets.where(several & (F.col("kind") == f"check_{i}")), [(f"check_{i}", every, F.col("key"))], [F.col("at"), F.col("key")]))
    if missing:
        wanted.append((first_missing(valid, "indice"), [("missing", every, F.col("indice"))], [F.col("indice")]))
    few = _samples(wanted, spark)

    if total is None:
        coverage = Finding("cobertura", NOT_EVALUABLE, n["bound"], f"{shown(n['bound'])} rows at least; no declared total")
    else:
        met = n["bound"] == total
        coverage = Finding("cobertura", OK if met else ERROR, total - n["bound"], f"{shown(n['bound'])} of {shown(total)} declared rows")
    sources = by["source"]["keys"]
    found = [
        counted("jsonl-ilegible", corrupt, "unreadable lines"),
        Finding("dataset-vacio", OK if n["valid"] else ERROR, n["valid"], f"{shown(n['valid'])} valid records"),
        counted("esquema", n["invalid"], "records break a rule", samples=few.get("invalid")),
        counted("id-duplicado", by["id"]["repeats"], "lines repeat an identity", samples=few.get("id")),
        counted("indice-duplicado", by["place"]["repeats"], "lines repeat a position", samples=few.get("place")),
        counted("pagina-incoherente", n["misplaced"], "records on another page than their position's", samples=few.get("misplaced")),
        Finding("fuente-mezclada", ERROR if sources > 1 else OK, sources, f"{shown(sources)} sources", few.get("source", [])),
        counted("indices-ausentes", missing, "positions without a record", WARNING, few.get("missing")),
        coverage,
    ]
    if spec.blank_rules:
        where = ", ".join(f for f, c in blanks.items() if c)
        found += [
            counted("campos-vacios", sum(blanks.values()), "blank required fields" + (f": {where}" if where else ""), samples=few.get("blank")),
            counted("anio-sin-parsear", n["no_year"], "records with a document and no ruling year", samples=few.get("no_year")),
            Finding("sin-documento", OK, n["without_doc"], f"{shown(n['without_doc'])} records without a document"),
            Finding("documento-compartido", OK, by["document"]["several"], f"{shown(by['document']['several'])} documents reach several records"),
            counted("documento-compartido-heterogeneo", by["document"]["mixed"], "shared documents differ in case or ruling", WARNING, few.get("mixed")),
        ]
    for i, c in enumerate(spec.checks):
        cases = by.get(f"check_{i}", none)["repeats"] if c.key else n[f"check_{i}"]
        found.append(counted(c.name, cases, c.words, c.level, few.get(f"check_{i}")))
    return findings_frame(marked.sparkSession, DATASET, 1, found)


def manifest_orphans(manifest: DataFrame, records: DataFrame) -> DataFrame:
    """Manifest ids that no record has, with their number of entries."""
    ids = manifest.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min("indice").alias("first_index"))
    return ids.join(records.select("id").distinct(), "id", "left_anti")


def manifest_uuid_mismatch(manifest: DataFrame, records: DataFrame) -> DataFrame:
    """Entries naming another document than the last record of their id does.

    Equal entries are counted first, so both sides of the join have one row per id and
    document, and a much-repeated id is no burden.
    """
    entries = manifest.groupBy("id", "documentoUuid").agg(F.count(F.lit(1)).alias("n"), F.min("indice").alias("first_index"))
    last = first_k(records.select("id", "indice", F.col("documentoUuid").alias("record_uuid")), ["id"], [F.desc("indice"), F.asc("record_uuid")])
    return entries.join(last.select("id", "record_uuid"), "id").where(null_safe(F.col("documentoUuid"), F.col("record_uuid")))


def manifest_vs_disk(manifest: DataFrame, probe: DataFrame) -> DataFrame:
    """Per file and declared content: entries, and whether file, size or hash do not agree."""
    entries = manifest.groupBy("archivo", "bytes", "sha256").agg(F.count(F.lit(1)).alias("n"))
    disk = probe.select("archivo", F.col("bytes").alias("disk_bytes"), F.col("sha256").alias("disk_sha256"))
    joined = entries.join(disk, "archivo", "left")
    there = F.col("disk_bytes").isNotNull()
    return joined.select(
        "archivo", "bytes", "sha256", "n", "disk_bytes", "disk_sha256",
        (~there).alias("absent"),
        F.coalesce(F.col("bytes") != F.col("disk_bytes"), F.lit(False)).alias("size_differs"),
        F.coalesce(F.col("sha256") != F.col("disk_sha256"), F.lit(False)).alias("hash_differs"),
        F.col("disk_sha256").isNotNull().alias("hashed"),
    )


def shared_files(manifest: DataFrame) -> DataFrame:
    return repeats(manifest.select("archivo"), "archivo")


_DISK = ("archivo-ausente", "tamano-distinto", "hash-distinto")


def _against_records(manifest: DataFrame, records: DataFrame) -> DataFrame:
    """Manifest ids and documents with their entries, and what the records say of them."""
    entries = manifest.groupBy("id", "documentoUuid").agg(F.count(F.lit(1)).alias("n"), F.min("indice").alias("first_index"))
    last = first_k(records.select("id", "indice", F.col("documentoUuid").alias("record_uuid")), ["id"], [F.desc("indice"), F.asc("record_uuid")])
    joined = entries.join(last.select("id", "record_uuid", F.lit(True).alias("known")), "id", "left")
    known = F.coalesce(F.col("known"), F.lit(False))
    return joined.select(
        "id", "documentoUuid", "record_uuid", "n", "first_index", (~known).alias("orphan"),
        (known & null_safe(F.col("documentoUuid"), F.col("record_uuid"))).alias("mismatch"),
    )


def documents_findings(
    records: DataFrame,
    manifest: DataFrame,
    probe: DataFrame | None,
    queue: DataFrame | None,
    invalid_entries: int = 0,
) -> DataFrame:
    """The eleven checks on manifest, files and queue. ``queue`` is collapsed: one row per id."""
    every, spark = F.lit(True), manifest.sparkSession
    with_document = records.agg(F.count_if(F.coalesce(F.col("documentoUuid") != "", F.lit(False))).alias("n"))
    keyed = manifest.select(F.explode(F.array(
        F.struct(F.lit("id").alias("kind"), F.col("id").alias("key")), F.struct(F.lit("file").alias("kind"), F.col("archivo").alias("key"))
    )).alias("k")).select("k.*").groupBy("kind", "key").agg(F.count(F.lit(1)).alias("n"))
    per_kind = keyed.groupBy("kind").agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("keys"), F.sum(F.col("n") - 1).alias("repeats"), F.count_if(F.col("n") > 1).alias("several")
    )
    against = _against_records(manifest, records)
    entries_off = against.agg(F.sum(F.when(F.col("orphan"), F.col("n"))).alias("orphan"), F.sum(F.when(F.col("mismatch"), F.col("n"))).alias("mismatch"))
    jobs = [lambda: numbers(with_document)["n"], per_kind.collect, lambda: numbers(entries_off), lambda: None if queue is None else queue.count()]
    if probe is not None:
        per_file = manifest_vs_disk(manifest, probe).groupBy("archivo").agg(
            F.bool_or("absent").alias("absent"), F.bool_or("hashed").alias("hashed"),
            F.sum(F.when(F.col("size_differs"), F.col("n")).otherwise(0)).alias("size"),
            F.sum(F.when(F.col("hash_differs"), F.col("n")).otherwise(0)).alias("hash"),
        )
        files = per_file.agg(
            F.count_if("absent").alias("absent"), F.count_if("hashed").alias("hashed"), F.sum("size").alias("size"), F.sum("hash").alias("hash")
        )
        jobs.append(lambda: numbers(files))
    with_doc, counts, n, queued, *on_disk = together(spark, jobs)
    none = {"rows": 0, "keys": 0, "repeats": 0, "several": 0}
    by = {"id": none, "file": none} | {r["kind"]: r.asDict() for r in counts}
    entries, repeated = by["id"]["rows"], by["id"]["repeats"]
    said = F.concat("id", F.lit(": "), "documentoUuid", F.lit(" / "), F.coalesce("record_uuid", F.lit("(none)")))
    kinds = [("orphan", F.col("orphan"), F.col("id")), ("mismatch", F.col("mismatch"), said)]
    wanted = [(against, [k for k in kinds if n[k[0]]], [F.col("first_index"), F.col("id"), F.col("documentoUuid")])]
    if repeated:
        again = repeated_lines(manifest, "id", ["indice", "archivo"])
        wanted.append((again, [("id", every, F.col("id"))], [F.col("indice"), F.col("id")]))
    if on_disk:
        n |= on_disk[0]
        kinds = [("absent", F.col("absent"), F.col("archivo")), ("size", F.col("size") > 0, F.col("archivo")), ("hash", F.col("hash") > 0, F.col("archivo"))]
        wanted.append((per_file, [k for k in kinds if n[k[0]]], [F.col("archivo")]))
    few = _samples(wanted, spark)

    def on_entries(check: str, cases: int, words: str, bad: str = ERROR, few: list[str] | None = None) -> Finding:
        return counted(check, cases, words, bad, few) if entries else Finding(check, NOT_EVALUABLE, 0, "no entries to look at")

    if probe is None or not entries:
        reason = "the download folder is not there" if entries else "no entries to look at"
        disk = [Finding(c, NOT_EVALUABLE, 0, reason) for c in _DISK]
    else:
        disk = [
            counted(_DISK[0], n["absent"], "files are not on disk", samples=few.get("absent")),
            counted(_DISK[1], n["size"], "entries with another size than the file", samples=few.get("size")),
            counted(_DISK[2], n["hash"], "entries with another hash than the file", samples=few.get("hash"))
            if n["hashed"] else Finding(_DISK[2], NOT_EVALUABLE, 0, "no file was hashed"),
        ]
    if queue is None:
        pending = Finding("dlq-pendientes", NOT_EVALUABLE, 0, "the failure queue could not be read")
    else:
        pending = counted("dlq-pendientes", queued, "documents wait in the failure queue", WARNING)
    found = [
        counted("manifiesto-invalido", invalid_entries, "malformed entries"),
        Finding("manifiesto-vacio", OK if entries else WARNING, entries, f"{shown(entries)} entries"),
        on_entries("manifiesto-duplicado", repeated, "entries repeat an identity", few=few.get("id")),
        on_entries("manifiesto-huerfano", n["orphan"], "entries without a record", few=few.get("orphan")),
        on_entries("manifiesto-uuid", n["mismatch"], "entries name another document than the record", few=few.get("mismatch")),
        on_entries("archivo-compartido", by["file"]["several"], "files serve several entries", OK),
        Finding("cobertura-descargas", OK, by["id"]["keys"], f"{shown(by['id']['keys'])} of {shown(with_doc)} records with a document"),
        *disk,
        pending,
    ]
    return findings_frame(manifest.sparkSession, DOCUMENTS, 2, found)


def first_page_present(records: DataFrame, site_page: DataFrame) -> DataFrame:
    """Ids that the site shows now and the records lack."""
    return site_page.select("id").distinct().join(records.select("id"), "id", "left_anti")


def site_findings(records: DataFrame, site_page: DataFrame | None, live_total: int | None) -> DataFrame:
    """Comparison with a snapshot of the site; an unreachable site is an error."""
    if site_page is None:
        found = [Finding("sitio-alcanzable", ERROR, 1, "the site could not be asked")]
        return findings_frame(records.sparkSession, SITE, 3, found)
    ids = site_page.select("id").distinct().count()
    lacking = first_page_present(records, site_page)
    gone = lacking.count()
    few = samples(lacking, [("id", F.lit(True), F.col("id"))], [F.col("id")]) if gone else {}
    if gone == 0:
        said = f"{shown(ids)} ids of the first page are all stored"
    elif gone == ids:
        said = "none of the first page is stored: the identity rule may have changed"
    else:
        said = f"{shown(gone)} of {shown(ids)} ids of the first page are not stored yet"
    found = [
        Finding("sitio-total", OK, live_total, f"the site declares {shown(live_total)} rows"),
        Finding("sitio-primera-pagina", ERROR if gone else OK, gone, said, few.get("id", [])),
    ]
    return findings_frame(records.sparkSession, SITE, 3, found)


def validate(
    records: DataFrame,
    spec: SourceSpec,
    page_size: int,
    manifest: DataFrame | None = None,
    probe: DataFrame | None = None,
    queue: DataFrame | None = None,
    total: int | None = None,
    corrupt: int = 0,
    invalid_entries: int = 0,
    site: tuple[DataFrame | None, int | None] | None = None,
    checkpoint: int | None = None,
) -> DataFrame:
    """The whole report: dataset, documents and, where asked for, site. The total is the site's, else ``total``, else the checkpoint's."""
    marked = settle(marks(records, spec, page_size), "marks")
    return _sections(marked, spec, manifest, probe, queue, total, corrupt, invalid_entries, site, checkpoint)


def _sections(
    marked: DataFrame,
    spec: SourceSpec,
    manifest: DataFrame | None,
    probe: DataFrame | None,
    queue: DataFrame | None,
    total: int | None,
    corrupt: int,
    invalid_entries: int,
    site: tuple[DataFrame | None, int | None] | None,
    checkpoint: int | None,
) -> DataFrame:
    live = site[1] if site else None
    known, _ = declared_total(live, total, checkpoint)
    valid = marked.where("good")
    if manifest is None:  # nothing was ever downloaded: the same as an empty manifest
        manifest = marked.sparkSession.createDataFrame([], MANIFEST_SCHEMA)
    sections = [
        lambda: findings_of_marks(marked, spec, known, corrupt),
        lambda: documents_findings(valid, manifest, probe, queue, invalid_entries),
    ]
    if site:
        sections.append(lambda: site_findings(valid, site[0], live))
    return union_all(together(marked.sparkSession, sections))


def unreadable(e: Exception) -> bool:
    """Whether an error says that a file's content is not what it should be: a broken line, or a shape that a scan refuses.

    Everything else, a lost executor or a full disk, is no finding and has to end the report."""
    if isinstance(e, CorruptLine):
        return True
    condition = e.getCondition() if isinstance(e, PySparkException) else None
    return (condition or "").startswith(("USER_RAISED_EXCEPTION", "MALFORMED_RECORD_IN_PARSING")) or "MALFORMED_RECORD_IN_PARSING" in str(e)


def validate_files(
    spark: SparkSession,
    spec: SourceSpec,
    page_size: int,
    paths: dict[str, str],
    probe: DataFrame | None = None,
    total: int | None = None,
    site: tuple[DataFrame | None, int | None] | None = None,
    hashed: bool = False,
) -> tuple[DataFrame, list[str]]:
    """The report over files as a harvest leaves them (``paths``: records, manifest, queue, checkpoint, documents, as ``default_paths``
    names them), and notes on what could not be read. Unreadable lines and malformed entries are counted from the scans; a broken
    queue makes its check not evaluable, a broken resume state is a note. The documents' folder is probed for sizes, or with
    ``hashed`` read for hashes too; where it is missing, its checks are not evaluable. A probe given is used instead.
    """
    notes: list[str] = []

    def marked_and_torn() -> tuple[DataFrame, int]:
        """Records are parsed once: what the checks need of them, and which lines are torn, is landed together."""
        marked = settle(marks(scan_whole(spark, paths["records"], spec.schema), spec, page_size), "marks")
        return marked.where("not torn").drop("torn"), marked.where("torn").count()

    def entries_and_malformed() -> tuple[DataFrame, int]:
        scanned = scan_tolerant(spark, paths["manifest"], MANIFEST_SCHEMA, required=REQUIRED)
        landed = settle(scanned.withColumn(CORRUPT, F.col(CORRUPT).isNotNull()), "manifest")
        return landed.where(~F.col(CORRUPT)).drop(CORRUPT), landed.where(CORRUPT).count()

    def probed() -> DataFrame | None:
        if probe is not None or "documents" not in paths:
            return probe
        found = probe_hash(spark, paths["documents"]) if hashed else probe_stat(spark, paths["documents"])
        return None if found is None else settle(found, "probe")

    def queue_or_none() -> DataFrame | None:
        try:
            try:
                return settle(queue_scan(spark, paths["queue"], looked=False).select("id"), "queue")
            except Exception as e:
                if unreadable(e):
                    check_lines(spark, paths["queue"], QUEUE_SCHEMA)
                raise
        except Exception as e:
            if not unreadable(e):
                raise
            notes.append(f"queue unreadable: {str(e).splitlines()[0][:300]}")
            return None

    def total_or_none() -> int | None:
        try:
            state = checkpoint_scan(spark, paths["checkpoint"]).select("fuente", "total", "actualizadoEn").orderBy(F.desc("actualizadoEn")).first()
            return state["total"] if state else None
        except Exception as e:
            if not unreadable(e):
                raise
            notes.append(f"checkpoint unreadable: {str(e).splitlines()[0][:300]}")
            return None

    (marked, corrupt), (entries, invalid), disk, queue, resumed = together(spark, [marked_and_torn, entries_and_malformed, probed, queue_or_none, total_or_none])
    return _sections(marked, spec, entries, disk, queue, total, corrupt, invalid, site, resumed), notes
