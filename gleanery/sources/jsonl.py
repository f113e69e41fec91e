"""JSON Lines: numbered lines, strict and tolerant scans, torn tails, stored ids.

A line is parsed once and judged whole, whichever columns are asked for later. Text that is no JSON is broken. A field of another
JSON type than its column's is NULL, and its name is in ``MISTYPED``; a required one rejects the line.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType, VariantType

from gleanery.operators.keep import PLACE
from gleanery.sources.paths import exists

CORRUPT = "_corrupt_record"
MISTYPED = "_mistyped"
SAMPLE = 200  # characters of a broken line that its error shows


class CorruptLine(ValueError):
    """The first broken line of a file: ``file``, ``number`` (from 1, blank lines counted) and a ``sample`` of it."""

    def __init__(self, file: str, number: int, sample: str):
        super().__init__(f"corrupt line {number} of {file}: {sample}")
        self.file, self.number, self.sample = file, number, sample


def _place() -> Column:
    """Where a line stands: files by time of change and name, then the split, then the row in it."""
    m = F.col("_metadata")
    return F.struct(m["file_modification_time"].alias("at"), m["file_path"].alias("file"), m["file_block_start"].alias("start"), F.monotonically_increasing_id().alias("row")).alias(PLACE)


def _is_json(line: Column) -> Column:
    """Whether a line is one JSON value and nothing else. Two values on a line, as a write after a torn one leaves them, are none."""
    text = F.trim(line)
    closed = F.when(F.startswith(text, F.lit("{")), F.endswith(text, F.lit("}"))).when(F.startswith(text, F.lit("[")), F.endswith(text, F.lit("]"))).otherwise(True)
    return closed & F.coalesce(F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1, F.lit(False))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines with their place, blank ones too."""
    return spark.read.text(path).select("value", _place())


def _judged(lines: DataFrame, schema: StructType) -> DataFrame:
    """Lines that are not blank: ``value``, place, ``_row`` with typed fields, ``_broken``, and the names of mistyped fields."""
    # Spark reads a number into a text column; a text is told from it by the type that the JSON value has.
    wide = StructType([StructField(f.name, VariantType() if f.dataType == StringType() else f.dataType) for f in schema.fields])
    raw = StructType([StructField(f.name, VariantType()) for f in schema.fields if f.dataType != StringType()])
    once = lines.where(F.trim("value") != "").select("*", (~_is_json(F.col("value"))).alias("_broken"), F.from_json("value", wide, {"mode": "PERMISSIVE"}).alias("_typed"))
    # Whether a NULL was given as one is asked of the lines that have one, the others are not parsed again.
    lacks = F.lit(False)
    for f in raw.fields:
        lacks = lacks | F.col("_typed")[f.name].isNull()
    parsed = once.withColumn("_raw", F.when(lacks, F.from_json("value", raw, {"mode": "PERMISSIVE"})))

    def kind(v: Column) -> Column:
        return F.schema_of_variant(v)

    fields, wrong = [], []
    for f in schema.fields:
        typed = F.col("_typed")[f.name]
        if f.dataType == StringType():
            fields.append(F.when(kind(typed) == "STRING", typed.cast("string")).alias(f.name))
            wrong.append(F.when(~F.coalesce(kind(typed), F.lit("VOID")).isin("STRING", "VOID"), f.name))
        else:
            given = F.col("_raw")[f.name].isNotNull() & ~F.is_variant_null(F.col("_raw")[f.name])
            fields.append(typed.alias(f.name))
            wrong.append(F.when(typed.isNull() & given, f.name))
    row = F.when(~F.col("_broken"), F.struct(*fields))
    return parsed.select("value", PLACE, row.alias("_row"), "_broken", F.when(F.col("_broken"), F.array().cast(ArrayType(StringType()))).otherwise(F.array_compact(F.array(*wrong))).alias(MISTYPED))


def _parsed_once(judged: DataFrame) -> DataFrame:
    """Judged lines for a filter on their verdict. It would be moved below the verdict, with the parsing written out in it once for each
    field; it stops at a generated row."""
    return judged.select("value", PLACE, F.inline(F.array(F.struct("_row", "_broken", MISTYPED))))


def _starts(lines: DataFrame, *more: Column) -> DataFrame:
    """A row per split: its first row's id and the number of lines before it in its file. Splits are joined by prefix sums, lines stay where they are."""
    at = F.col(PLACE)
    per = lines.groupBy(at["file"].alias("file"), at["start"].alias("start")).agg(F.min(at["row"]).alias("first"), F.count(F.lit(1)).alias("n"), *more)
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return per.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")


def _number() -> Column:
    return F.col("before") + F.col("row") - F.col("first") + 1


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """Every line: ``file``, ``number`` (from 1, blank lines counted) and ``value``; the same however files are split."""
    if not exists(spark, path):
        return spark.createDataFrame([], "file string, number bigint, value string")
    lines = _lines(spark, path)
    at = lines.select("value", F.col(PLACE)["file"].alias("file"), F.col(PLACE)["start"].alias("start"), F.col(PLACE)["row"].alias("row"))
    starts = F.broadcast(_starts(lines))  # a row per split of the files
    return at.join(starts, ["file", "start"]).select("file", _number().alias("number"), "value")


def broken_lines(spark: SparkSession, path: str, schema: StructType, strict: bool = True) -> DataFrame:
    """The first broken line of each file that has one: ``file``, ``number``, ``value``. With ``strict``, a mistyped field breaks its line too."""
    if not exists(spark, path):
        return spark.createDataFrame([], "file string, number bigint, value string")
    lines = _lines(spark, path)
    judged = _parsed_once(_judged(lines, schema)).select("value", PLACE, (F.col("_broken") | (F.size(MISTYPED) > 0) if strict else F.col("_broken")).alias("bad"))
    row = F.col(PLACE)["row"]
    worst = judged.where("bad").groupBy(F.col(PLACE)["file"].alias("file"), F.col(PLACE)["start"].alias("start")).agg(F.min(row).alias("row"), F.min_by("value", row).alias("value"))
    found = worst.join(_starts(lines), ["file", "start"]).select("file", _number().alias("number"), "value")
    return found.groupBy("file").agg(F.min("number").alias("number"), F.min_by("value", "number").alias("value"))


def check_lines(spark: SparkSession, path: str, schema: StructType, strict: bool = True) -> None:
    """Raise the first broken line of the first file that has one."""
    for r in broken_lines(spark, path, schema, strict).orderBy("file").head(1):
        raise CorruptLine(r["file"], r["number"], r["value"][:SAMPLE])


def _empty(spark: SparkSession, schema: StructType, place: bool) -> DataFrame:
    none = spark.createDataFrame([], schema)
    return none.withColumn(PLACE, F.lit(None).cast("struct<at:timestamp,file:string,start:bigint,row:bigint>")) if place else none


def _columns(schema: StructType) -> list[Column]:
    return [F.col("_row")[f.name].alias(f.name) for f in schema.fields]


def scan_strict(spark: SparkSession, path: str, schema: StructType, place: bool = False, looked: bool = True) -> DataFrame:
    """Lines as rows. No file is no rows; blank lines are skipped; a broken line or a mistyped field is an error that names file and line.

    The files are looked through for their first broken line beforehand, so the error is the same for any size of splits and
    any columns asked for. A line that breaks between that and the reading is an error too. With ``place``, rows keep where their line stands.
    Without ``looked``, lines are parsed once only: whoever meets the error of the reading asks ``check_lines`` for the line.
    """
    if not exists(spark, path):
        return _empty(spark, schema, place)
    if looked:
        check_lines(spark, path, schema)
    judged = _parsed_once(_judged(_lines(spark, path), schema))
    broke = F.raise_error(F.concat(F.lit("corrupt line in "), F.col(PLACE)["file"], F.lit(": "), F.substring("value", 1, SAMPLE))).cast("boolean")
    checked = judged.where(F.when(F.col("_broken") | (F.size(MISTYPED) > 0), broke).otherwise(True))
    return checked.select(*_columns(schema), *([PLACE] if place else []))


def scan_tolerant(spark: SparkSession, path: str, schema: StructType, place: bool = False, required: tuple[str, ...] = ()) -> DataFrame:
    """As the strict scan, but lines that are broken, or lack a required field in its type, keep their text in ``_corrupt_record``.

    A mistyped field that is not required is NULL, and its line counts.
    """
    wide = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    if not exists(spark, path):
        return _empty(spark, wide, place)
    lacking = F.col("_broken")
    for name in required:
        lacking = lacking | F.col("_row")[name].isNull()
    return _judged(_lines(spark, path), schema).select(*_columns(schema), F.when(lacking, F.col("value")).alias(CORRUPT), *([PLACE] if place else []))


def scan_whole(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """As the tolerant scan, with the names of mistyped fields in ``_mistyped``: a rule of the record can judge them."""
    wide = StructType([*schema.fields, StructField(CORRUPT, StringType()), StructField(MISTYPED, ArrayType(StringType()))])
    if not exists(spark, path):
        return spark.createDataFrame([], wide)
    return _judged(_lines(spark, path), schema).select(*_columns(schema), F.when(F.col("_broken"), F.col("value")).alias(CORRUPT), MISTYPED)


def torn_tail(spark: SparkSession, path: str) -> DataFrame:
    """Per file, the bytes after its last line break (0 where the last line is whole).

    Counted from line lengths against the file size, so files are read in splits. The
    last line is the one with the greatest place: its split's start, then its row.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.octet_length("value").cast("bigint").alias("n"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"),
    )
    per = lines.groupBy("file").agg(
        F.max("size").alias("size"), F.sum(F.col("n") + 1).alias("whole"), F.max_by("n", "at").alias("tail")
    )
    torn = F.when(F.col("whole") > F.col("size"), F.col("tail")).otherwise(F.lit(0).cast("bigint"))
    return per.select("file", torn.alias("torn_bytes"))


ADDRESSED = "file string, start bigint, size bigint, local bigint, bytes binary"


def addressed(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its byte address: ``file``, ``offset``, ``bytes`` (without the line break) and the file's ``size``.

    A split counts the bytes from its own first line on, in the order in which it is read; what the splits before it hold, a number for each,
    is added by prefix sums. Bytes are as stored, also where a character was cut."""
    if not exists(spark, path):
        return spark.createDataFrame([], "file string, offset bigint, bytes binary, size bigint")
    m = F.col("_metadata")
    lines = spark.read.option("lineSep", "\n").text(path).select(
        m["file_path"].alias("file"), m["file_block_start"].alias("start"), m["file_size"].alias("size"), F.lit(0).cast("bigint").alias("local"), F.col("value").cast("binary").alias("bytes")
    )

    def run(batches):
        last, at = None, 0  # the split that is read, and how far it has come
        for part in batches:
            files, starts = part.column("file").dictionary_encode(), part.column("start").to_numpy()
            wide = pc.binary_length(part.column("bytes")).to_numpy().astype(np.int64) + 1
            code = files.indices.to_numpy()
            new = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (starts[1:] != starts[:-1])])) if len(code) else []
            before = np.cumsum(wide) - wide
            local = np.empty(len(code), np.int64)
            for i, j in zip(new, [*new[1:], len(code)], strict=True):
                own = (files.dictionary[code[i]].as_py(), int(starts[i]))
                at = at if own == last else 0
                local[i:j] = before[i:j] - before[i] + at
                last, at = own, at + int(wide[i:j].sum())
            yield part.set_column(3, "local", pa.array(local))

    per = lines.groupBy("file", "start").agg(F.sum(F.octet_length("bytes") + 1).alias("n"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    starts = per.select("file", "start", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    placed = lines.mapInArrow(run, ADDRESSED).join(F.broadcast(starts), ["file", "start"])  # a row per split of the files
    return placed.select("file", (F.col("before") + F.col("local")).alias("offset"), "bytes", "size")


def _is_torn() -> Column:
    """The line is not ended by a break: it reaches the end of its file."""
    return F.col("offset") + F.octet_length("bytes") >= F.col("size")


def torn_lines(spark: SparkSession, path: str) -> DataFrame:
    """What a write that was cut short left at the end of files: ``file``, ``offset`` and the ``bytes`` themselves. Nothing for a file whose last line is whole."""
    return addressed(spark, path).where(_is_torn() & (F.octet_length("bytes") > 0)).select("file", "offset", "bytes")


def set_aside(spark: SparkSession, path: str, clean: str, torn: str) -> None:
    """Write the whole lines of ``path`` to ``clean``, in their order, and what is torn to the table ``torn``. The files themselves stay as they are.

    As every line of ``clean`` is ended, what is written next to it starts a line of its own."""
    lines = addressed(spark, path)
    lines.where(~_is_torn()).select(F.col("bytes").cast("string").alias("value")).write.text(clean)
    torn_lines(spark, path).write.parquet(torn)


def quarantine(scanned: DataFrame, key: str = "id") -> DataFrame:
    """Broken lines of a tolerant scan, each once, with how often they occur.

    Spark refuses to read the corrupt column alone, so a key is read along; what could be
    read of it follows from the line and does not split the groups.
    """
    broken = scanned.where(F.col(CORRUPT).isNotNull())
    return broken.groupBy(F.col(CORRUPT).alias("line"), key).agg(F.count(F.lit(1)).alias("n")).select("line", "n")


def key_index(records: DataFrame) -> DataFrame:
    """Ids already stored. Broken lines have none."""
    return records.select("id").where("id is not null").distinct()


def key_index_of(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Ids stored in files. The last line of a file may be broken, as a write that was cut short leaves it; another one is an error."""
    if not exists(spark, path):
        return key_index(spark.createDataFrame([], schema))
    lines = _lines(spark, path)
    ends = _starts(lines, F.count(F.lit(1)).alias("here")).groupBy("file").agg(F.max(F.col("before") + F.col("here")).alias("last"))
    early = broken_lines(spark, path, schema, strict=False).join(ends, "file").where("number < last")
    for r in early.orderBy("file").head(1):
        raise CorruptLine(r["file"], r["number"], r["value"][:SAMPLE])
    return key_index(_judged(lines, schema).where("not _broken").select("_row.*"))
