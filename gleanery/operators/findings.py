"""Findings: one row per check, with a level out of four.

``no-evaluable`` is a level of its own: a check whose input is absent never passes.

The work is in the aggregates that give the numbers and samples. What is left, a fixed few
dozen numbers and five samples per check, is put together on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.operators.keep import MAX_SAMPLES, first_k
from gleanery.sources.schema import COUNT, SMALL, TEXT, TEXTS, schema

# Levels and their symbols in a text report.
ERROR, WARNING, OK, NOT_EVALUABLE = "error", "aviso", "ok", "no-evaluable"
SYMBOLS = {ERROR: "✗", WARNING: "⚠", OK: "✓", NOT_EVALUABLE: "–"}

FINDINGS = schema(
    section_order=SMALL, section=TEXT, check_order=SMALL, check=TEXT, level=TEXT, n=COUNT, message=TEXT, samples=TEXTS
)


@dataclass(frozen=True)
class Finding:
    check: str
    level: str
    n: int
    message: str
    samples: list[str] = field(default_factory=list)


def shown(n: int) -> str:
    return f"{n:,}".replace(",", ".")


def counted(check: str, n: int, words: str, bad: str = ERROR, samples: list[str] | None = None) -> Finding:
    """A check that fails with the given level as soon as there is one case."""
    return Finding(check, bad if n else OK, n, f"{shown(n)} {words}", samples or [])


def findings_frame(spark: SparkSession, section: str, section_order: int, found: list[Finding]) -> DataFrame:
    rows = [(section_order, section, i + 1, f.check, f.level, f.n, f.message, f.samples) for i, f in enumerate(found)]
    return spark.createDataFrame(rows, FINDINGS)


def numbers(stats: DataFrame) -> dict[str, int]:
    """A one-row aggregate as numbers; an empty sum is 0."""
    return {k: v or 0 for k, v in stats.first().asDict().items()}


def samples(rows: DataFrame, kinds: list[tuple[str, Column, Column]], order: list[Column]) -> dict[str, list[str]]:
    """First samples of each kind in one pass over ``rows``: (kind, condition, label).

    A row may give several samples, in the order of ``kinds``. The rank limits every kind
    before the shuffle.
    """
    if not kinds:
        return {}
    given = F.array(*[F.when(cond, F.struct(F.lit(k).alias("kind"), label.cast("string").alias("label"))) for k, cond, label in kinds])
    names = [*[f"o{i}" for i in range(len(order))], "nth"]
    listed = rows.select(F.posexplode(given).alias("nth", "k"), *[o.alias(n) for o, n in zip(order, names)])
    few = first_k(listed.where("k is not null").select("k.*", *names), ["kind"], [F.col(n) for n in names], MAX_SAMPLES)
    out: dict[str, list[str]] = {}
    for r in few.orderBy("kind", *names).collect():  # at most MAX_SAMPLES rows per kind
        out.setdefault(r["kind"], []).append(r["label"])
    return out


def levels(found: DataFrame) -> DataFrame:
    """Findings per level, and whether the report fails: any error does."""
    count = {lv: F.count_if(F.col("level") == lv) for lv in SYMBOLS}
    return found.agg(
        count[ERROR].alias("errors"),
        count[WARNING].alias("warnings"),
        count[OK].alias("ok"),
        count[NOT_EVALUABLE].alias("not_evaluable"),
        (count[ERROR] > 0).alias("failed"),
    )


def report_lines(found: DataFrame) -> DataFrame:
    """Findings as text lines. A report has a few dozen rows, whatever was checked."""
    symbol = F.try_element_at(F.create_map(*[F.lit(x) for p in SYMBOLS.items() for x in p]), F.col("level"))
    width = found.agg(F.max(F.length("check")).alias("_w"))
    shown = F.when(F.size("samples") > 0, F.concat(F.lit(" · e.g. "), F.array_join("samples", ", "))).otherwise("")
    line = F.concat(F.lit("  "), symbol, F.lit(" "), F.rpad("check", F.col("_w"), F.lit(" ")), F.lit("  "), F.col("message"), shown)
    joined = found.join(F.broadcast(width), F.col("_w").isNotNull())
    return joined.select("section_order", "check_order", "section", line.alias("line"))
