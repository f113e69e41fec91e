"""Scans, sinks and streams: tables are written to shared scratch space and read back."""

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from gleanery.plans import ingest, retry
from gleanery.sources import control, files, jsonl, manifest, sinks
from gleanery.sources import schema as sch
from gleanery.sources.paths import scratch_dir
from gleanery.sources.spec import TYPED, default_paths, spec_of
from gleanery.streaming import jobs
from workload import sql as S
from workload import tables as T
from workload.registry import query


def _as_json(df, name):
    path = scratch_dir(df.sparkSession, name)
    df.write.json(path)
    return path


def _torn_lines(spark, sf):
    """Records as JSON lines; those of toxic texts lack their end."""
    r = T.rich_records(spark, sf)
    line = F.to_json(F.struct("fuente", "id", "indice", "pagina"))
    path = scratch_dir(spark, "lines")
    torn = F.substr(line, F.lit(1), F.length(line) - 3)
    r.select(F.when(F.col("toxic") == 1, torn).otherwise(line).alias("value")).write.text(path)
    return path


@query("jsonl_scan_strict", f"WITH {S.RECORDS} SELECT indice, id, fuente, expediente, documentoUuid, anioResolucion, CAST(len(administrados) AS INT) AS parties FROM records")
def _(spark, sf):
    path = _as_json(T.records(spark, sf), "records")
    r = jsonl.scan_strict(spark, path, TYPED.schema)
    return r.select("indice", "id", "fuente", "expediente", "documentoUuid", "anioResolucion", F.size("administrados").alias("parties"))


def _gapped_lines(spark, sf):
    """Records as JSON lines in order of their position over several files; a blank line follows where the text is toxic, some lines lack their end."""
    r = T.rich_records(spark, sf)
    line = F.to_json(F.struct("fuente", "id", "indice", "pagina"))
    line = F.when(F.col("n_chars") % 97 == 1, F.substr(line, F.lit(1), F.length(line) - 3)).otherwise(line)
    path = scratch_dir(spark, "lines")
    spread = r.select("indice", F.when(F.col("toxic") == 1, F.concat(line, F.lit("\n"))).otherwise(line).alias("value")).repartitionByRange(4, "indice").sortWithinPartitions("indice")
    spread.select("value").write.text(path)
    return path


def _offsets(lines):
    """Lines in the files before each file, by their names."""
    per = lines.groupBy("file").agg(F.max("number").alias("n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return F.broadcast(per.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))


_GAPPED = f"""{S.RECORDS}, g AS (SELECT indice, n_chars, row_number() OVER (ORDER BY indice) + coalesce(sum(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) OVER (ORDER BY indice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS number FROM records)"""


@query("jsonl_line_numbers", f"WITH {_GAPPED} SELECT CAST(number AS BIGINT) AS number, indice FROM g")
def _(spark, sf):
    """The number of every record's line, blank lines counted."""
    lines = jsonl.numbered(spark, _gapped_lines(spark, sf))
    placed = lines.where("trim(value) <> ''").join(_offsets(lines), "file")
    return placed.select((F.col("number") + F.col("before")).alias("number"), F.regexp_extract("value", '"indice":([0-9]+)', 1).cast("bigint").alias("indice"))


@query("jsonl_first_broken", f"WITH {_GAPPED} SELECT CAST(min(number) AS BIGINT) AS number FROM g WHERE n_chars % 97 = 1")
def _(spark, sf):
    """The first broken line of all files, as the strict scan names it."""
    path = _gapped_lines(spark, sf)
    first = jsonl.broken_lines(spark, path, sch.schema(**sch.BASE)).join(_offsets(jsonl.numbered(spark, path)), "file")
    return first.agg(F.min(F.col("number") + F.col("before")).alias("number"))


@query("jsonl_scan_tolerant", f"WITH {S.RECORDS} SELECT CASE WHEN toxic = 1 THEN NULL ELSE indice END AS indice, coalesce(toxic, 0) = 1 AS broken FROM records")
def _(spark, sf):
    lines = jsonl.scan_tolerant(spark, _torn_lines(spark, sf), sch.schema(**sch.BASE))
    return lines.select(F.when(F.col(jsonl.CORRUPT).isNull(), F.col("indice")).alias("indice"), F.col(jsonl.CORRUPT).isNotNull().alias("broken"))


def _cut_files(spark, sf):
    """Records as JSON lines in files that end within a line: what begins each further line also stands at the end, as a separator."""
    r = T.rich_records(spark, sf)
    line = F.to_json(F.struct("fuente", "id", "indice", "pagina"))
    path = scratch_dir(spark, "lines")
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    head = '{"fue'
    r.select(F.when(first, line).otherwise(F.substr(line, F.lit(len(head) + 1))).alias("value")).write.option("lineSep", "\n" + head).text(path)
    return path


@query("torn_tail", f"WITH {S.RECORDS} SELECT CAST(5 AS BIGINT) AS least, CAST(5 AS BIGINT) AS most, count(*) AS whole_lines FROM records")
def _(spark, sf):
    path = _cut_files(spark, sf)
    torn = jsonl.torn_tail(spark, path)
    lines = spark.read.text(path).count()
    return torn.agg(F.min("torn_bytes").alias("least"), F.max("torn_bytes").alias("most"), (F.lit(lines) - F.count("*")).alias("whole_lines"))


@query("torn_lines", f"WITH {S.RECORDS} SELECT count(*) AS whole_lines, true AS at_the_end, 1 AS kinds FROM records")
def _(spark, sf):
    """Torn tails as rows beside a clean table: where each begins, and its bytes; what is left are the whole lines."""
    path, root = _cut_files(spark, sf), scratch_dir(spark, "repaired")
    jsonl.set_aside(spark, path, f"{root}/clean", f"{root}/torn")
    torn = spark.read.parquet(f"{root}/torn")
    ends = jsonl.torn_tail(spark, path).join(torn, "file", "left").agg(F.bool_and(F.octet_length("bytes") == F.col("torn_bytes")).alias("at_the_end"), F.count_distinct("bytes").alias("kinds"))
    whole = spark.read.text(f"{root}/clean").agg(F.count("*").alias("whole_lines"))
    return whole.crossJoin(ends)  # one row each


@query("quarantine", f"WITH {S.RECORDS}, b AS (SELECT '{{\"fuente\":\"' || fuente || '\",\"id\":\"' || id || '\",\"indice\":' || indice || ',\"pagina\":' || pagina || '}}' AS l FROM records WHERE toxic = 1) SELECT substr(l, 1, length(l) - 3) AS line, count(*) AS n FROM b GROUP BY 1")
def _(spark, sf):
    lines = jsonl.scan_tolerant(spark, _torn_lines(spark, sf), sch.schema(**sch.BASE))
    return jsonl.quarantine(lines)


@query("key_index", f"WITH {S.RECORDS} SELECT DISTINCT id FROM records")
def _(spark, sf):
    return jsonl.key_index_of(spark, _cut_files(spark, sf), sch.schema(**sch.BASE))


@query(
    "manifest_scan",
    f"""WITH {S.MANIFEST} SELECT documentoUuid, archivo, bytes, sha256 FROM manifest WHERE bytes >= 300 QUALIFY row_number() OVER (PARTITION BY documentoUuid ORDER BY seq DESC) = 1""",
)
def _(spark, sf):
    from gleanery.plans.downloads import by_document

    m = T.manifest(spark, sf).withColumn("bytes", F.expr("if(bytes >= 300, bytes, null)"))
    valid, _ = manifest.manifest_scan(spark, _as_json(m, "manifest"))
    return by_document(valid)


@query("manifest_mistyped", f"""WITH {S.MANIFEST} SELECT indice, archivo, CASE WHEN indice % 3 <> 1 THEN pagina END AS pagina FROM manifest WHERE indice % 5 <> 2""")
def _(spark, sf):
    """A page of another type is NULL, a size of another type rejects the entry; the same entries whatever is selected."""
    m = T.manifest(spark, sf).withColumn("bytes", F.expr("if(indice % 5 = 2, 'many', cast(bytes as string))")).withColumn("pagina", F.expr("if(indice % 3 = 1, 'p', cast(pagina as string))"))
    line = F.to_json(F.struct(*m.columns))
    line = F.regexp_replace(line, '"(bytes|pagina)":"([0-9]+)"', '"$1":$2')
    path = scratch_dir(spark, "manifest")
    m.select(line.alias("value")).write.text(path)
    valid, broken = manifest.manifest_scan(spark, path)
    assert valid.select("id").count() + broken.select("id").count() == m.count()
    return valid.select("indice", "archivo", "pagina")


@query("manifest_malformed", f"WITH {S.MANIFEST} SELECT indice, archivo FROM manifest WHERE bytes < 300")
def _(spark, sf):
    m = T.manifest(spark, sf).withColumn("bytes", F.expr("if(bytes >= 300, bytes, null)"))
    _, broken = manifest.manifest_scan(spark, _as_json(m, "manifest"))
    return broken.select("indice", "archivo")


@query("dlq_scan", f"WITH {S.QUEUE} SELECT id, seq, error, intentos, CAST(pagina AS VARCHAR) AS pagina FROM latest")
def _(spark, sf):
    q = manifest.queue_scan(spark, _as_json(T.queue(spark, sf), "queue"))
    return q.select("id", "seq", "error", "intentos", F.try_element_at("contexto", F.lit("pagina")).alias("pagina"))


@query("checkpoint_scan", "SELECT c_mktsegment AS fuente, c_custkey AS registros, CASE WHEN c_nationkey = 4 THEN 20 ELSE 10 END AS pageSize, CASE WHEN c_nationkey > 15 THEN c_nationkey > 20 END AS completo FROM customer")
def _(spark, sf):
    state = control.checkpoint_scan(spark, _as_json(T.checkpoints(spark, sf).drop("c_custkey"), "state"), multi_line=False)
    return state.select("fuente", "registros", "pageSize", "completo")


def _item_files(spark, sf):
    """One file per benchmark item: its text and a line break."""
    path = scratch_dir(spark, "files")
    T.table(spark, sf, "benchmark").select("text").write.option("maxRecordsPerFile", 1).text(path)
    return path


@query("file_probe_stat", "SELECT count(*) AS files, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS bytes FROM benchmark")
def _(spark, sf):
    probe = files.probe_stat(spark, _item_files(spark, sf)).where("archivo not like '\\\\_%'")
    return probe.agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))


@query("file_probe_hash", "SELECT CAST(octet_length(encode(text)) + 1 AS BIGINT) AS bytes, sha256(text || chr(10)) AS sha256 FROM benchmark")
def _(spark, sf):
    return files.probe_hash(spark, _item_files(spark, sf)).where("archivo not like '\\\\_%'").select("bytes", "sha256")


@query("file_probe_known", "SELECT CAST(octet_length(encode(text)) + 1 AS BIGINT) AS bytes, sha256(text || chr(10)) AS sha256 FROM benchmark")
def _(spark, sf):
    """A second probe, for which some files are known already."""
    folder = _item_files(spark, sf)
    known = sinks.settle(files.probe_known(spark, folder).where("bytes % 2 = 0"), "known")
    return files.probe_known(spark, folder, known).where("archivo not like '\\\\_%'").select("bytes", "sha256")


@query("source_registry", f"WITH {S.RECORDS} SELECT fuente, 10 AS page_size, '/data/' || fuente || '.jsonl' AS records_path, count(*) AS valid FROM records GROUP BY fuente")
def _(spark, sf):
    spec = spec_of("typed")
    r = T.records(spark, sf).where(F.size(spec.issues()) == 0)
    per = r.groupBy("fuente").agg(F.count(F.lit(1)).alias("valid"))
    path = default_paths("/data", "{}", "scrape")["records"].split("{}")
    return per.select("fuente", F.lit(spec.page_size).alias("page_size"), F.concat(F.lit(path[0]), "fuente", F.lit(path[1])).alias("records_path"), "valid")


@query(
    "append_new_records",
    f"WITH {S.RECORDS} SELECT id, indice FROM records QUALIFY row_number() OVER (PARTITION BY id ORDER BY lang <> 'en', indice) = 1",
)
def _(spark, sf):
    r, path = sinks.settle(T.records(spark, sf), "landed"), scratch_dir(spark, "records")
    english = r.where("unidadFiscalizable = 'en'")
    for batch in (english, r, r):  # the last one appends nothing
        sinks.append_new_records(batch, path)
    return sinks.read_table(spark, path, r.schema).select("id", "indice")


@query("replace_table", f"WITH {S.QUEUE} SELECT id, intentos FROM latest WHERE tipo = 'pdf' AND intentos < 5")
def _(spark, sf):
    q, path = T.queue(spark, sf), scratch_dir(spark, "queue")
    sinks.replace_table(retry.collapse(q), path)
    sinks.replace_table(retry.retryable_entries(sinks.read_current(spark, path, q.schema)), path)
    return sinks.read_current(spark, path, q.schema).select("id", "intentos")


@query("dlq_append", f"WITH {S.QUEUE} SELECT id, seq, error FROM queue")
def _(spark, sf):
    q, path = T.queue(spark, sf), scratch_dir(spark, "queue")
    sinks.append_if_any(q.where("tipo = 'none'"), path)
    sinks.append_if_any(q.where("tipo = 'pdf'"), path)
    sinks.append_if_any(q.where("tipo <> 'pdf'"), path)
    return sinks.read_table(spark, path, q.schema).select("id", "seq", "error")


@query(
    "checkpoint_write",
    f"""WITH {S.RECORDS} SELECT fuente, 'scrape' AS tarea, 10 AS pageSize, max(indice) + 1 AS total, CAST(max(pagina) AS INT) AS ultimaPagina, max(pagina) >= 100 AS done, count(*) AS registros FROM records GROUP BY fuente""",
)
def _(spark, sf):
    r, root = T.records(spark, sf), scratch_dir(spark, "run")
    state = ingest.checkpoint_of(r, "scrape", 10, F.col("indice") + 1, F.lit(100).cast("bigint"), F.expr("timestamp_ntz'2030-01-01 00:00:00'"))
    ingest.ingest(r, f"{root}/records", f"{root}/state", state)
    now = sinks.read_current(spark, f"{root}/state", state.schema)
    return now.select("fuente", "tarea", "pageSize", "total", "ultimaPagina", (F.col("ultimaPagina") >= 100).alias("done"), "registros")


@query("stream_ingest", f"WITH {S.RECORDS} SELECT DISTINCT id FROM records")
def _(spark, sf):
    r, root = T.records(spark, sf), scratch_dir(spark, "stream")
    r.write.json(f"{root}/in")
    stream = jobs.arriving(spark, f"{root}/in", TYPED.schema, files_per_batch=2)
    jobs.ingest_stream(stream, f"{root}/records", f"{root}/checkpoint").awaitTermination()
    return sinks.read_table(spark, f"{root}/records", TYPED.schema).select("id")


@query("stream_dedup", f"WITH {S.RECORDS} SELECT DISTINCT id, CAST(indice % 3 AS INT) AS run FROM records")
def _(spark, sf):
    """Three runs land one after another, each in several batches; an id counts once for each run, and an ended run's ids are let go."""
    r, root = T.records(spark, sf), scratch_dir(spark, "stream")
    runs = r.select("id", (F.col("indice") % 3).cast("int").alias("run")).withColumn("ends", F.timestamp_seconds((F.col("run") + 1) * 86400))
    for run in range(3):
        runs.where(F.col("run") == run).repartition(4).write.mode("append").parquet(f"{root}/in")
        arriving = jobs.arriving(spark, f"{root}/in", runs.schema, "parquet", files_per_batch=2)
        first = jobs.dedup_run_stream(arriving, "run", "ends").select("id", "run")
        first.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start(f"{root}/out").awaitTermination()
    return sinks.read_table(spark, f"{root}/out", first.schema)


@query("stream_dlq_latest", f"WITH {S.QUEUE} SELECT id, seq, intentos FROM latest")
def _(spark, sf):
    q, root = T.queue(spark, sf), scratch_dir(spark, "stream")
    for part in (q.where("hour(ultimoTs) < 12"), q.where("hour(ultimoTs) >= 12")):
        part.write.mode("append").json(f"{root}/in")
        jobs.queue_stream(jobs.arriving(spark, f"{root}/in", sch.QUEUE_SCHEMA), f"{root}/queue", f"{root}/checkpoint").awaitTermination()
        jobs.compact_queue(spark, f"{root}/queue", sch.QUEUE_SCHEMA)
    return jobs.queue_now(spark, f"{root}/queue", sch.QUEUE_SCHEMA).select("id", "seq", "intentos")


def _watched(spark, sf):
    """The log arrives in two parts; an hour is written once it is past by an hour. All hours, the log, and its end."""
    from gleanery.plans.requestlog import classify

    log, root = classify(T.log(spark, sf)).select("ts", "outcome", "latency_ms"), scratch_dir(spark, "stream")
    log = log.withColumn("ts", F.col("ts").cast("timestamp"))
    middle = log.agg(F.expr("timestamp_micros(cast((unix_micros(min(ts)) + unix_micros(max(ts))) / 2 as bigint))")).first()[0]
    schema = sch.schema(ts=sch.TIME, outcome=sch.TEXT, latency_ms=log.schema["latency_ms"].dataType)
    for part in (log.where(F.col("ts") < F.lit(middle)), log.where(F.col("ts") >= F.lit(middle))):
        part.write.mode("append").parquet(f"{root}/in")
        hourly = jobs.health(jobs.arriving(spark, f"{root}/in", schema, "parquet"))
        jobs.finished_stream(hourly, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    landed = spark.read.schema(schema).parquet(f"{root}/in")
    return jobs.health_now(spark, f"{root}/out", landed), landed


def _near(spans, log, width):
    """Spans with whether p50 and p95 are where they should be: the share of values up to each, counted in the log, against the sketches' error and the width of one value."""
    spans = jobs.with_percentiles(spans)
    timed = log.withColumn("start", F.window("ts", width)["start"])
    ranks = timed.join(spans.select("start", "p50_approx", "p95_approx"), "start").groupBy("start").agg(
        *[F.try_divide(F.count_if(F.col("latency_ms") < F.col(p)), F.count("latency_ms")).alias(f"{p}_low") for p in ("p50_approx", "p95_approx")],
        *[F.try_divide(F.count_if(F.col("latency_ms") <= F.col(p)), F.count("latency_ms")).alias(f"{p}_high") for p in ("p50_approx", "p95_approx")],
    )
    slack = 2 * jobs.RANK_ERROR + 1 / F.col("requests")
    near = [((F.col(f"{p}_low") <= r + slack) & (F.col(f"{p}_high") >= r - slack)).alias(n) for p, r, n in (("p50_approx", 0.5, "p50_near"), ("p95_approx", 0.95, "p95_near"))]
    return spans.join(ranks, "start").select(F.col("start").cast("timestamp_ntz").alias("start"), "requests", "ok", "throttled", *near)


_SPANS = f"""WITH {S.LOG} SELECT date_trunc('{{}}', ts) AS start, count(*) AS requests, count(*) FILTER (kind = 'ok') AS ok, count(*) FILTER (kind = 'throttled') AS throttled, true AS p50_near, true AS p95_near
  FROM classified GROUP BY 1"""


@query("stream_health", _SPANS.format("hour"))
def _(spark, sf):
    """Every hour of the log: those that the stream has closed, and the ones still open."""
    hours, log = _watched(spark, sf)
    return _near(hours, log, "1 hour")


@query("stream_health_days", _SPANS.format("day"))
def _(spark, sf):
    """The hours merged to days: counters added up, sketches merged."""
    hours, log = _watched(spark, sf)
    return _near(jobs.health_spans(hours, "1 day"), log, "1 day")


def _generations(spark, sf):
    """What three generations of a run land: the total is another one half way through the first, and again through the second."""
    r, root = sinks.settle(T.records(spark, sf), "landed"), scratch_dir(spark, "stream")  # derived once for six writes
    wide = StructType([*TYPED.schema.fields, StructField("total", LongType())])
    half = F.col("pagina") % 2 == 0
    for number, (early, late) in enumerate(((10, 11), (11, 12), (12, 12)), 1):
        for part, total in ((r.where(half), early), (r.where(~half), late)):
            part.withColumn("total", F.lit(total).cast("bigint")).write.mode("append").json(f"{root}/in/{number}")
    return root, wide


@query("stream_restart", f"WITH {S.RECORDS} SELECT DISTINCT id, 3 AS generation, 12 AS total FROM records")
def _(spark, sf):
    """The total changes twice: each change starts a new reading, and the last one meets one total throughout. Nothing is stored twice."""
    root, wide = _generations(spark, sf)
    number, total = jobs.ingest_generations(spark, lambda n: jobs.arriving(spark, f"{root}/in/{n}", wide), f"{root}/records", f"{root}/state", 10, "total")
    return sinks.read_table(spark, f"{root}/records", TYPED.schema).select("id", F.lit(number).alias("generation"), F.lit(total).alias("total"))


@query("download_restart", f"WITH {S.RECORDS} SELECT id, min(documentoUuid) IS NOT NULL AS noted, 3 AS generation FROM records WHERE documentoUuid <> '' GROUP BY id")
def _(spark, sf):
    """The same for downloads: entries of a generation are noted once its rows agree on the total."""
    root, wide = _generations(spark, sf)

    def entries(number):
        return spark.read.schema(wide).json(f"{root}/in/{number}").where("documentoUuid <> ''").withColumn("descargadoEn", F.col("capturadoEn"))

    number, _ = jobs.download_generations(spark, entries, f"{root}/manifest", f"{root}/state", 10, "total")
    noted = sinks.read_table(spark, f"{root}/manifest", entries(1).schema)
    return noted.select("id", F.col("documentoUuid").isNotNull().alias("noted"), F.lit(number).alias("generation"))
