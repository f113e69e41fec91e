import datetime as dt
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from gleanery.plans import downloads, ingest
from gleanery.sources import control, files, jsonl, manifest, paths, sinks
from gleanery.sources.schema import CHECKPOINT_SCHEMA, QUEUE_SCHEMA, schema, COUNT, TEXT, TIME
from gleanery.streaming import jobs

ROW = schema(id=TEXT, indice=COUNT)
T0 = dt.datetime(2024, 1, 1)


def test_strict_scan(spark, tmp_path):
    assert jsonl.scan_strict(spark, str(tmp_path / "none"), ROW).count() == 0
    good = tmp_path / "good.jsonl"
    good.write_text('{"id":"a","indice":0}\n\n{"id":"b"}\n')
    assert [tuple(r) for r in jsonl.scan_strict(spark, str(good), ROW).collect()] == [("a", 0), ("b", None)]
    bad = tmp_path / "bad.jsonl"
    bad.write_text('{"id":"a","indice":0}\n{"id":"b",')
    with pytest.raises(Exception, match="(?i)malformed|corrupt"):
        jsonl.scan_strict(spark, str(bad), ROW).collect()


def test_strict_whatever_is_selected(spark, tmp_path):
    bad = tmp_path / "bad.jsonl"
    bad.write_text('{"id":"a","indice":0}\n{"id":"b","indice":"zz"}\n')
    for asked in (["id"], ["indice"], []):
        with pytest.raises(Exception, match="corrupt line"):
            jsonl.scan_strict(spark, str(bad), ROW).select(*asked).collect()
    with pytest.raises(Exception, match="corrupt line"):
        jsonl.scan_strict(spark, str(bad), ROW).count()


def test_key_index_of_files(spark, tmp_path):
    cut = tmp_path / "cut"
    cut.mkdir()
    (cut / "a.jsonl").write_text('{"id":"a","indice":0}\n{"id":"a","indice":1}\n{"id":"x","ind')
    (cut / "b.jsonl").write_text('{"id":"b","indice":0}\n')
    assert sorted(r["id"] for r in jsonl.key_index_of(spark, str(cut), ROW).where("id <> 'x'").collect()) == ["a", "b"]
    bad = tmp_path / "bad.jsonl"
    bad.write_text('{"id":"a"}\nbroken\n{"id":"b"}\n')
    with pytest.raises(ValueError, match="broken"):
        jsonl.key_index_of(spark, str(bad), ROW)
    ends = tmp_path / "ends.jsonl"
    ends.write_text('{"id":"a"}\n\n{"id":"b"}\n{"id":"cor')
    assert sorted(r["id"] for r in jsonl.key_index_of(spark, str(ends), ROW).collect()) == ["a", "b"]
    assert jsonl.key_index_of(spark, str(tmp_path / "none"), ROW).count() == 0


def test_last_wins_by_place_in_the_files(spark, tmp_path):
    """Lines without a number of their own, in several files and splits."""
    import os
    import time

    q = tmp_path / "queue"
    q.mkdir()
    entry = '{{"id":"{}","tipo":"pdf","error":"network","intentos":{},"ultimoTs":"2024-01-01T00:00:00.000Z","detalle":"{}"}}\n'
    now = time.time()
    for n, name in enumerate(("z.jsonl", "a.jsonl")):  # the later file has the earlier name
        f = q / name
        f.write_text("".join(entry.format(f"k{i % 50}", 100 * n + i // 50, "x" * 300) for i in range(1000 if n == 0 else 500)))
        os.utime(f, (now + n * 10, now + n * 10))
    m = tmp_path / "m.jsonl"
    m.write_text("".join(f'{{"id":"r{i}","documentoUuid":"d","archivo":"f{i}"}}\n' for i in range(30)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        got = {r["id"]: r["intentos"] for r in manifest.queue_scan(spark, str(q)).collect()}
        assert got == {f"k{i}": 109 for i in range(50)}
        entries, broken = manifest.manifest_scan(spark, str(m), manifest.NAMED)
        assert broken.count() == 0 and [r["archivo"] for r in downloads.by_document(entries).collect()] == ["f29"]
        assert manifest.manifest_scan(spark, str(m))[0].count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_tolerant_scan_and_torn_tail(spark, tmp_path):
    p = tmp_path / "t"
    p.mkdir()
    (p / "a.jsonl").write_text('{"id":"a","indice":0}\nbroken\n{"id":"ñ","ind')
    (p / "b.jsonl").write_text('{"id":"c","indice":1}\n')
    (p / "c.jsonl").write_text("xyz")
    rows = jsonl.scan_tolerant(spark, str(p), ROW)
    assert sorted(r["n"] for r in jsonl.quarantine(rows).collect()) == [1, 1, 1]
    assert sorted(r["id"] for r in jsonl.key_index(rows.where("_corrupt_record is null")).collect()) == ["a", "c"]
    torn = {r["file"].rsplit("/", 1)[1]: r["torn_bytes"] for r in jsonl.torn_tail(spark, str(p)).collect()}
    assert torn == {"a.jsonl": len('{"id":"ñ","ind'.encode()), "b.jsonl": 0, "c.jsonl": 3}


def test_torn_tail_over_splits(spark, tmp_path):
    (tmp_path / "big.jsonl").write_text("\n".join("x" * (i % 50) for i in range(5000)) + "\nlast")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert [r["torn_bytes"] for r in jsonl.torn_tail(spark, str(tmp_path)).collect()] == [4]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_manifest_scan(spark, tmp_path):
    p = tmp_path / "m.jsonl"
    p.write_text('{"id":"a","documentoUuid":"u","archivo":"f","bytes":1,"sha256":"h"}\n{"id":"a","documentoUuid":"u","archivo":"f"}\nnope\n')
    valid, broken = manifest.manifest_scan(spark, str(p))
    assert (valid.count(), broken.count()) == (1, 2)


def test_queue_scan(spark, tmp_path):
    p = tmp_path / "q.jsonl"
    line = '{{"seq":{},"id":"{}","tipo":"pdf","error":"network","intentos":{},"ultimoTs":"2024-01-01T00:00:00.000Z","contexto":{{"pagina":3}}}}\n'
    p.write_text(line.format(1, "a", 1) + line.format(2, "a", 2) + line.format(3, "b", 1))
    got = {r["id"]: (r["intentos"], r["contexto"]) for r in manifest.queue_scan(spark, str(p)).collect()}
    assert got == {"a": (2, {"pagina": "3"}), "b": (1, {"pagina": "3"})}
    p2 = tmp_path / "q2.jsonl"
    p2.write_text(line.format(1, "", 1))
    with pytest.raises(Exception, match="malformed"):
        manifest.queue_scan(spark, str(p2)).collect()
    assert manifest.queue_scan(spark, str(tmp_path / "none")).count() == 0


def test_checkpoint_scan(spark, tmp_path):
    p = tmp_path / "c.json"
    p.write_text('{\n "fuente":"s","tarea":"scrape","pageSize":10,"total":5,\n "ultimaPagina":1,"registros":5,"actualizadoEn":"2024-01-01T00:00:00.000Z"}')
    r = control.checkpoint_scan(spark, str(p)).first()
    assert (r["total"], r["completo"]) == (5, None)
    assert control.checkpoint_scan(spark, str(tmp_path / "none")).count() == 0
    p2 = tmp_path / "bad.json"
    p2.write_text('{"fuente":"s","tarea":"","pageSize":10,"total":5,"ultimaPagina":1,"registros":5,"actualizadoEn":"2024-01-01T00:00:00.000Z"}')
    with pytest.raises(Exception, match="resume state"):
        control.checkpoint_scan(spark, str(p2)).collect()


def test_file_probes(spark, tmp_path):
    d = tmp_path / "docs"
    d.mkdir()
    bodies = {"a b_ñ.pdf": b"%PDF-" + b"x" * 2000, "page.pdf": b"<html>" + b"x" * 2000, "short.pdf": b"%PDF-1"}
    for name, body in bodies.items():
        (d / name).write_bytes(body)
    assert files.probe_stat(spark, str(tmp_path / "none")) is None
    assert {r["archivo"]: r["bytes"] for r in files.probe_stat(spark, str(d)).collect()} == {n: len(b) for n, b in bodies.items()}
    assert {r["archivo"]: r["sha256"] for r in files.probe_hash(spark, str(d)).collect()} == {n: hashlib.sha256(b).hexdigest() for n, b in bodies.items()}
    assert {r["archivo"]: r["problem"] for r in files.file_validity(spark, str(d)).collect()} == {"a b_ñ.pdf": None, "page.pdf": "magic", "short.pdf": "tamano"}
    scan = files.probe_stat(spark, str(d))._jdf.queryExecution().optimizedPlan().toString()
    assert "content" not in scan.split("Project", 1)[1].split("\n")[0]


def test_known_files_keep_their_hashes(spark, tmp_path):
    d, sha = tmp_path / "docs", lambda b: hashlib.sha256(b).hexdigest()
    d.mkdir()
    assert files.probe_known(spark, str(tmp_path / "none")) is None
    for i, name in enumerate(["a.pdf", "b.pdf", "c.pdf"]):
        (d / name).write_bytes(name.encode())
        os.utime(d / name, (1000 + i, 1000 + i))
    first = files.probe_known(spark, str(d))
    assert {r["archivo"]: r["sha256"] for r in first.collect()} == {n: sha(n.encode()) for n in ("a.pdf", "b.pdf", "c.pdf")}
    noted = [(r["path"], r["bytes"], r["modified"], "noted" if r["archivo"] != "c.pdf" else None) for r in first.collect()]
    known = spark.createDataFrame(noted + noted[:1], "path string, bytes bigint, modified timestamp, sha256 string")
    (d / "b.pdf").write_bytes(b"other")  # the same length, another time
    os.utime(d / "b.pdf", (2000, 2000))
    (d / "d.pdf").write_bytes(b"late")
    os.utime(d / "d.pdf", (1001, 1001))  # new, but older by its time than known ones
    now = files.probe_known(spark, str(d), known)
    assert {r["archivo"]: r["sha256"] for r in now.collect()} == {"a.pdf": "noted", "b.pdf": sha(b"other"), "c.pdf": sha(b"c.pdf"), "d.pdf": sha(b"late")}
    assert "PushedFilters: [GreaterThanOrEqual(modificationTime" in now._jdf.queryExecution().toString().replace("IsNotNull(modificationTime), ", "")
    settled = spark.createDataFrame(now.where("archivo <> 'd.pdf'").collect(), now.schema)
    (d / "d.pdf").unlink()
    again = files.probe_known(spark, str(d), settled)  # nothing is new: contents are not read
    assert again.count() == 3 and "sha2(" not in again._jdf.queryExecution().optimizedPlan().toString()


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), ROW)


def test_append_is_idempotent_and_first_wins(spark, tmp_path):
    path = str(tmp_path / "records")
    sinks.append_new_records(rows(spark, ("a", 5), ("a", 2), ("b", 3)), path)
    sinks.append_new_records(rows(spark, ("a", 1), ("c", 9), ("c", 7)), path)
    sinks.append_new_records(rows(spark, ("a", 1), ("c", 9), ("b", 7)), path)
    assert sorted(tuple(r) for r in sinks.read_table(spark, path, ROW).collect()) == [("a", 2), ("b", 3), ("c", 7)]


def test_append_writes_a_batch_nowhere_but_in_the_table(spark, tmp_path, monkeypatch):
    path, made = str(tmp_path / "records"), []
    monkeypatch.setattr(sinks, "settle", lambda rows, name: made.append(name) or rows)
    batch = spark.createDataFrame([(f"k{i % 40}", i, "x" * 50) for i in range(200)] + [(None, 900, "none"), (None, 901, "none")], "id string, indice bigint, text string")
    for _ in range(2):  # a record without an id is no new one the second time either
        sinks.append_new_records(batch, path)
        got = sinks.read_table(spark, path, batch.schema).collect()
        assert sorted((r["id"] or "", r["indice"]) for r in got) == sorted([(f"k{i}", i) for i in range(40)] + [("", 900)])
    assert made == []


def test_append_if_any(spark, tmp_path):
    path = str(tmp_path / "queue")
    assert not sinks.append_if_any(rows(spark), path) and not paths.exists(spark, path)
    assert sinks.append_if_any(rows(spark, ("a", 1)), path) and sinks.read_table(spark, path, ROW).count() == 1


def test_replace_table_may_read_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.read_current(spark, path, ROW).count() == 0
    sinks.replace_table(rows(spark, ("a", 1), ("b", 2)), path)
    sinks.replace_table(sinks.read_current(spark, path, ROW).where("id = 'b'"), path)
    assert [tuple(r) for r in sinks.read_current(spark, path, ROW).collect()] == [("b", 2)]
    # A version that was not written to its end is not seen, and its name is not used again.
    (tmp_path / "t" / "v=000000000009").mkdir()
    assert sinks.read_current(spark, path, ROW).count() == 1
    assert sinks.replace_table(rows(spark), path).endswith("v=000000000010")
    assert sinks.read_current(spark, path, ROW).count() == 0


def test_ingest_writes_state_last(spark, tmp_path):
    run = spark.createDataFrame([("s", "a", 0, 1), ("s", "b", 10, 2)], "fuente string, id string, indice bigint, pagina bigint")
    state = ingest.checkpoint_of(run, "scrape", 10, F.lit(20), F.lit(2), F.lit("2024-01-01").cast("timestamp"))
    for _ in range(2):
        ingest.ingest(run, str(tmp_path / "r"), str(tmp_path / "c"), state)
    assert sinks.read_table(spark, str(tmp_path / "r"), run.schema).count() == 2
    r = sinks.read_current(spark, str(tmp_path / "c"), state.schema).first()
    assert (r["ultimaPagina"], r["completo"], r["registros"], r["total"]) == (2, True, 2, 20)
    assert [f.name for f in state.schema] == [f.name for f in CHECKPOINT_SCHEMA]


def test_scratch_is_below_the_shared_folder(spark):
    assert paths.scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") + "/x-")


def test_stream_ingest_resumes(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for batch in ([("a", 1), ("b", 2)], [("a", 3), ("c", 4)], []):
        rows(spark, *batch).write.mode("append").json(src)
        jobs.ingest_stream(jobs.arriving(spark, src, ROW, files_per_batch=1), out, cp).awaitTermination()
    assert sorted(r["id"] for r in sinks.read_table(spark, out, ROW).collect()) == ["a", "b", "c"]


def test_stream_stops_when_the_total_changed(spark, tmp_path):
    src = str(tmp_path / "in")
    wide = schema(id=TEXT, indice=COUNT, total=COUNT)
    spark.createDataFrame([("a", 0, 7)], wide).write.json(src)
    q = jobs.ingest_stream(jobs.arriving(spark, src, wide), str(tmp_path / "out"), str(tmp_path / "cp"), 8, "total")
    with pytest.raises(Exception, match="declared total"):
        q.awaitTermination()
    # Start over: a new checkpoint location, the same table.
    jobs.ingest_stream(jobs.arriving(spark, src, wide), str(tmp_path / "out"), str(tmp_path / "cp2"), 7, "total").awaitTermination()
    assert sinks.read_table(spark, str(tmp_path / "out"), wide).count() == 1


def test_stream_dedup_with_and_without_delay(spark, tmp_path):
    src, timed = str(tmp_path / "in"), schema(id=TEXT, capturadoEn=TIME)
    spark.createDataFrame([("a", T0), ("a", T0 + dt.timedelta(minutes=1)), ("b", T0)], timed).write.json(src)
    for i, delay in enumerate([None, "1 hour"]):
        out = str(tmp_path / f"out{i}")
        first = jobs.dedup_stream(jobs.arriving(spark, src, timed), delay)
        first.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / f"cp{i}")).trigger(availableNow=True).start(out).awaitTermination()
        assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_stream_queue_keeps_the_latest(spark, tmp_path):
    src, q, cp = (str(tmp_path / n) for n in ("in", "q", "cp"))
    for seq, tries in ((1, 1), (2, 2), (3, 3)):
        row = [(seq, "a", "pdf", "network", tries, T0, "", {}), (seq + 10, f"b{seq}", "pdf", "network", 1, T0, "", {})]
        spark.createDataFrame(row, QUEUE_SCHEMA).write.mode("append").json(src)
        jobs.queue_stream(jobs.arriving(spark, src, QUEUE_SCHEMA), q, cp).awaitTermination()
        if seq == 2:
            jobs.compact_queue(spark, q, QUEUE_SCHEMA)
    got = {r["id"]: r["intentos"] for r in jobs.queue_now(spark, q, QUEUE_SCHEMA).collect()}
    assert got == {"a": 3, "b1": 1, "b2": 1, "b3": 1}
    jobs.compact_queue(spark, q, QUEUE_SCHEMA)
    assert len(paths.children(spark, f"{q}/base")) == 1 and not paths.exists(spark, f"{q}/changes")
    assert {r["id"]: r["intentos"] for r in jobs.queue_now(spark, q, QUEUE_SCHEMA).collect()} == got


def test_queue_stream_by_place(spark, tmp_path):
    """Entries without a number: later files and lines win."""
    src, q, cp = tmp_path / "in", str(tmp_path / "q"), str(tmp_path / "cp")
    src.mkdir()
    schema = QUEUE_SCHEMA.fields
    from pyspark.sql.types import StructType

    bare = StructType([f for f in schema if f.name != "seq"])
    for name, tries in (("z", (1, 2)), ("a", (3, 4))):
        (src / f"{name}.json").write_text("".join(f'{{"id":"k","tipo":"pdf","error":"network","intentos":{t},"ultimoTs":"2024-01-01T00:00:00Z"}}\n' for t in tries))
        rows = jobs.arriving(spark, str(src), bare, place_of_lines=True)
        jobs.queue_stream(rows, q, cp).awaitTermination()
    wide = spark.read.parquet(f"{q}/changes/batch=0").schema
    assert [r["intentos"] for r in jobs.queue_now(spark, q, wide).collect()] == [4]


def test_stream_health(spark, tmp_path):
    src, log = str(tmp_path / "in"), "ts timestamp, outcome string, latency_ms double"
    data = [(T0 + dt.timedelta(minutes=20 * i), "throttled" if i % 3 == 0 else "ok", float(i)) for i in range(9)]
    spark.createDataFrame(data, log).write.parquet(src)
    hourly = jobs.health(jobs.arriving(spark, src, spark.createDataFrame([], log).schema, "parquet"))
    out, landed = str(tmp_path / "out"), lambda: spark.read.parquet(src)
    want = [(3, 2, 1, 1.0), (3, 2, 1, 4.0), (3, 2, 1, 7.0)]

    def found(windows):
        return [(r["requests"], r["ok"], r["throttled"], r["p50_approx"]) for r in jobs.with_percentiles(windows).orderBy("start").collect()]

    assert found(jobs.health_now(spark, out, landed())) == want  # before any run of the stream
    jobs.finished_stream(hourly, out, str(tmp_path / "cp")).awaitTermination()
    assert found(spark.read.parquet(out)) == want[:1]  # the next hours are not past by an hour
    assert found(jobs.health_now(spark, out, landed())) == want
    assert found(jobs.health_spans(jobs.health_now(spark, out, landed()), "1 day")) == [(9, 6, 3, 4.0)]
    more = [(T0 + dt.timedelta(hours=5), "ok", 1.0)]
    spark.createDataFrame(more, log).write.mode("append").parquet(src)
    jobs.finished_stream(hourly, out, str(tmp_path / "cp")).awaitTermination()
    assert found(spark.read.parquet(out)) == want
    assert found(jobs.health_now(spark, out, landed())) == [*want, (1, 1, 0, 1.0)]


def test_merged_sketches_stay_within_their_error(spark):
    log = spark.range(60_000).select((F.lit(T0).cast("timestamp") + F.make_interval(secs=F.col("id") % 86_400)).alias("ts"), F.lit("ok").alias("outcome"), (F.pmod(F.xxhash64("id"), F.lit(10_000)) / 7).alias("latency_ms"))
    hours = jobs._health(log, "1 hour")
    r = jobs.with_percentiles(jobs.health_spans(hours, "1 day")).select("requests", "p50_approx", "p95_approx").first()
    values = sorted(x[0] for x in log.select("latency_ms").collect())
    for share, got in ((0.5, r["p50_approx"]), (0.95, r["p95_approx"])):
        assert values[int(60_000 * (share - 2 * jobs.RANK_ERROR))] <= got <= values[min(59_999, int(60_000 * (share + 2 * jobs.RANK_ERROR)))]


def test_state_of_a_run_is_let_go(spark, tmp_path):
    """Copies over several batches and runs; the state holds one run's ids only."""
    src, seen = str(tmp_path / "in"), schema(run=COUNT, id=TEXT, ends=TIME)
    sizes = []
    for run in range(3):
        for part in range(2):
            rows_ = [(run, f"k{i}", T0 + dt.timedelta(days=run)) for i in range(part, 20)]
            spark.createDataFrame(rows_, seen).write.mode("append").parquet(src)
        first = jobs.dedup_run_stream(jobs.arriving(spark, src, seen, "parquet", files_per_batch=3), "run", "ends")
        q = first.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out"))
        q.awaitTermination()
        sizes.append(q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    got = sorted((r["run"], r["id"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == sorted((run, f"k{i}") for run in range(3) for i in range(20))
    assert sizes[0] == 20 and max(sizes[1:]) <= 40 and sizes[-1] < 60


def test_generations(spark, tmp_path):
    """Read until a whole reading has met one total; a run cut short goes on with its generation."""
    state, log = str(tmp_path / "state"), []
    declared = {1: [10, 11], 2: [11, 12], 3: [12, 12]}

    def read(number, total):
        log.append((number, total))
        for t in declared[number]:
            if t != total:
                raise jobs.TotalChanged(t)

    assert jobs.in_generations(spark, state, 10, read) == (3, 12) and log == [(1, 10), (2, 11), (3, 12)]
    assert jobs.in_generations(spark, state, 12, read) == (3, 12)  # nothing new is asked for
    declared[4] = [13]
    assert jobs.in_generations(spark, state, 13, read) == (4, 13)
    other = str(tmp_path / "other")
    with pytest.raises(ZeroDivisionError):
        jobs.in_generations(spark, other, 10, lambda n, t: read(n, t) if n == 1 else 1 / 0)
    log.clear()
    assert jobs.in_generations(spark, other, 10, read) == (3, 12) and log[0] == (2, 11)
    with pytest.raises(jobs.TotalChanged):
        jobs.in_generations(spark, str(tmp_path / "never"), 0, lambda n, t: (_ for _ in ()).throw(jobs.TotalChanged(t + 1)), restarts=3)
    assert jobs.TotalChanged.within(RuntimeError("x TotalChanged: declared total changed to 17 y")).total == 17


def test_streams_and_downloads_in_generations(spark, tmp_path):
    wide = schema(id=TEXT, indice=COUNT, capturadoEn=TIME, descargadoEn=TIME, total=COUNT)
    for number, totals in ((1, (7, 8)), (2, (8, 8))):
        for i, total in enumerate(totals):
            spark.createDataFrame([(f"k{i}", i, T0, T0, total)], wide).write.mode("append").json(str(tmp_path / f"in{number}"))
    rows_of = lambda n: jobs.arriving(spark, str(tmp_path / f"in{n}"), wide, files_per_batch=1)
    records, state = str(tmp_path / "records"), str(tmp_path / "state")
    assert jobs.ingest_generations(spark, rows_of, records, state, 7, "total") == (2, 8)
    assert sorted(r["id"] for r in sinks.read_table(spark, records, wide).collect()) == ["k0", "k1"]
    assert paths.children(spark, f"{state}/stream") == ["2"]
    landed = lambda n: spark.read.schema(wide).json(str(tmp_path / f"in{n}"))
    noted = str(tmp_path / "manifest")
    assert jobs.download_generations(spark, landed, noted, str(tmp_path / "s2"), 7, "total") == (2, 8)
    assert sinks.read_table(spark, noted, wide).count() == 2


LINE = '{{"id":"k{}","indice":{}}}\n'


def test_line_numbers_over_splits(spark, tmp_path):
    """Blank lines count; numbers and the first broken line are the same for any size of splits."""
    a, b = tmp_path / "a.jsonl", tmp_path / "b.jsonl"
    a.write_text("".join(LINE.format(i, i) + ("\n" if i % 7 == 0 else "") for i in range(900)))
    text = [LINE.format(i, i) for i in range(900)]
    text[611] = '{"id":"k","indice":1}{"id":"glued"}\n'
    text[700] = "no json\n"
    b.write_text("\n".join(text))
    want = {(f.name, n, v) for f in (a, b) for n, v in enumerate(f.read_text().split("\n")[:-1], 1)}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1k", "7k", "1g"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = {(r["file"].rsplit("/", 1)[1], r["number"], r["value"]) for r in jsonl.numbered(spark, str(tmp_path)).collect()}
            assert got == want
            with pytest.raises(jsonl.CorruptLine, match="glued") as e:
                jsonl.scan_strict(spark, str(tmp_path), ROW)
            assert e.value.number == 2 * 611 + 1 and e.value.file.endswith("b.jsonl")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "x.jsonl").write_text('{"id":"a"}\nesto no\n{"id":"c"}\n')
    with pytest.raises(jsonl.CorruptLine) as e:
        jsonl.scan_strict(spark, str(tmp_path / "c"), ROW)
    assert (e.value.number, e.value.sample) == (2, "esto no")
    assert jsonl.numbered(spark, str(tmp_path / "none")).count() == 0


def test_verdict_by_field(spark, tmp_path):
    """The same rows whatever is selected: a mistyped optional field is NULL, a mistyped required one rejects."""
    p = tmp_path / "m.jsonl"
    whole = '"documentoUuid":"u","archivo":"f","bytes":1,"sha256":"h"'
    lines = [f'{{"id":"a",{whole},"pagina":"zz"}}', f'{{"id":5,{whole}}}', f'{{"id":"b",{whole},"pagina":3}}', f'{{"id":"c",{whole}}}{{"id":"d",{whole}}}',
             f'{{"id":"e",{whole.replace("1", chr(34) + "1" + chr(34))}}}', f'{{"id":"f","id":"g",{whole}}}', "null", "[1]", f'{{"id":"h",{whole},"nombreServidor":7}}', f'{{"id":"i",{whole}']
    p.write_text("\n".join(lines) + "\n")
    for columns in (["id"], ["pagina"], ["id", "pagina"], []):
        valid, broken = manifest.manifest_scan(spark, str(p))
        assert valid.select(*columns).count() == 4 and broken.select(*columns).count() == 6
    valid, _ = manifest.manifest_scan(spark, str(p))
    got = {r["id"]: (r["pagina"], r["nombreServidor"]) for r in valid.collect()}
    assert got in ({"a": (None, None), "b": (3, None), "g": (None, None), "h": (None, None)}, {"a": (None, None), "b": (3, None), "f": (None, None), "h": (None, None)})


def test_a_small_batch_reads_one_bucket(spark, tmp_path):
    path = str(tmp_path / "records")
    sinks.append_new_records(rows(spark, *[(f"k{i}", i) for i in range(300)]), path, buckets=16)
    assert sinks.buckets_of(spark, path) == 16 and len([n for n in paths.children(spark, path) if n.startswith("of_16=")]) == 16
    one = spark.createDataFrame([("k7",)], "id string").select(sinks.bucket(F.col("id"), 16)).first()[0]
    stored = sinks.stored_ids(spark, path, [one])
    stored.collect()
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(of_16" in plan and f"= {one})" in plan
    assert 0 < stored.count() < 60 and stored.where("id = 'k7'").count() == 1
    sinks.append_new_records(rows(spark, ("k7", 7), ("new", 1)), path)  # the table keeps its number of buckets
    got = sinks.read_table(spark, path, ROW)
    assert got.columns == ["id", "indice"] and got.count() == 301 and sinks.buckets_of(spark, path) == 16
    assert sinks.stored_ids(spark, path, []).count() == 0 and sinks.stored_ids(spark, str(tmp_path / "none"), [1]).count() == 0


def test_gaps_as_intervals(spark):
    from gleanery.operators.positions import missing_intervals, missing_positions, missing_total

    far = spark.createDataFrame([(0,), (2,), (3,), (3 * 10**15,), (-4,)], "p bigint")
    gaps = missing_intervals(far, "p")
    assert sorted(tuple(r) for r in gaps.collect()) == [(1, 1), (4, 3 * 10**15 - 1)] and missing_total(gaps) == 3 * 10**15 - 3
    wide = spark.createDataFrame([(5,), (25_000,), (310_000,)], "p bigint")
    missing = missing_positions(wide, "p")
    assert missing.count() == 310_001 - 3 == missing.distinct().count() and missing.agg(F.max("p")).first()[0] == 309_999
    assert missing_total(missing_intervals(far.where("p < 0"), "p")) == 0 and missing_positions(far.where("p < 0"), "p").count() == 0


def test_torn_bytes_are_set_aside(spark, tmp_path):
    """What the end of a file holds after its last break, with its address, for any size of splits."""
    src = tmp_path / "in"
    src.mkdir()
    long = '{"id":"a","x":"' + "x" * 200_000 + '"}'
    content = {
        "a": b'{"id":"a"}\n{"id":"b"}\n{"id":"c"', "b": b'{"id":"a"}\n', "c": b"", "d": b'{"id":"a"', "e": long.encode() + b'\n{"id":"cortad',
        "f": "".join(f'{{"id":"ñ{i}"}}\n' for i in range(3000)).encode() + "ñ".encode()[:1], "g": b"\n\n",
    }
    for name, data in content.items():
        (src / name).write_bytes(data)
    want = {n: (d.rfind(b"\n") + 1, d[d.rfind(b"\n") + 1 :]) for n, d in content.items() if not d.endswith(b"\n") and d}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("5k", "1g"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = {r["file"].rsplit("/", 1)[1]: (r["offset"], bytes(r["bytes"])) for r in jsonl.torn_lines(spark, str(src)).collect()}
            assert got == want
            for r in jsonl.addressed(spark, str(src)).collect():
                data = content[r["file"].rsplit("/", 1)[1]]
                assert data[r["offset"] : r["offset"] + len(r["bytes"])] == bytes(r["bytes"]) and r["size"] == len(data)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    jsonl.set_aside(spark, str(src), str(tmp_path / "clean"), str(tmp_path / "torn"))
    whole = sum(d.count(b"\n") for d in content.values())
    assert spark.read.text(str(tmp_path / "clean")).count() == whole and spark.read.parquet(str(tmp_path / "torn")).count() == len(want)
    assert jsonl.torn_lines(spark, str(tmp_path / "none")).count() == 0


def test_generations_are_written_from_records_derived_once(spark, monkeypatch):
    from workload import stores

    landed, settle = [], stores.sinks.settle
    monkeypatch.setattr(stores.sinks, "settle", lambda rows, name: landed.append(name) or settle(rows, name))
    root, wide = stores._generations(spark, "/root/testdata/sf0.001")
    assert landed == ["landed"]
    totals = [sorted(r[0] for r in spark.read.schema(wide).json(f"{root}/in/{n}").select("total").distinct().collect()) for n in (1, 2, 3)]
    assert totals == [[10, 11], [11, 12], [12]]
