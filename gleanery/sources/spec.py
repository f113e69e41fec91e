"""What a source of records looks like: schema, rules, identity and file names."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gleanery.functions import identity
from gleanery.functions.text import FIRST_YEAR, LAST_YEAR, is_blank, is_blank_list, slug
from gleanery.sources.schema import FREE_SCHEMA, TYPED_SCHEMA


def _missing(name: str) -> Column:
    return F.when(F.col(name).isNull(), f"{name}: required")


def _short(name: str) -> Column:
    return F.when(F.coalesce(F.length(name), F.lit(0)) < 1, f"{name}: at least 1 character")


def _least(name: str, low: int) -> Column:
    return F.when(F.coalesce(F.col(name) < low, F.lit(True)), f"{name}: integer >= {low}")


def _base_rules() -> list[Column]:
    return [
        _short("fuente"),
        _short("id"),
        _least("indice", 0),
        _least("pagina", 1),
        _missing("capturadoEn"),
        F.when(F.length("documentoUuid") < 1, "documentoUuid: at least 1 character"),
    ]


def _typed_rules() -> list[Column]:
    hollow = F.exists("administrados", lambda a: F.coalesce(F.length(a), F.lit(0)) < 1)
    return [
        *_base_rules(),
        _missing("expediente"),
        _missing("administrados"),
        F.when(hollow, "administrados: at least 1 character each"),
        _missing("unidadFiscalizable"),
        _missing("sector"),
        _missing("resolucion"),
        F.when(
            ~F.col("anioResolucion").between(FIRST_YEAR, LAST_YEAR),
            f"anioResolucion: within {FIRST_YEAR}..{LAST_YEAR}",
        ),
    ]


def _free_rules() -> list[Column]:
    return [*_base_rules(), _missing("campos"), _short("texto")]


def _file_name(text: Column) -> Column:
    return F.concat(F.concat_ws("_", F.col("documentoUuid"), F.nullif(slug(text), F.lit(""))), F.lit(".pdf"))


def _typed_id() -> Column:
    fields = ("expediente", "administrados", "unidadFiscalizable", "sector", "resolucion", "documentoUuid")
    return identity.typed_id(*[F.col(f) for f in fields])


@dataclass(frozen=True)
class Check:
    """A check that a source brings along, as column expressions over its records.

    With ``rule``, every valid record for which it is true is a case, shown as ``label``. With ``key``, every further record of a key is
    one, and keys are shown. NULL is no case and no key. The report counts them in the jobs that count everything else."""

    name: str
    words: str
    rule: Callable[[], Column] | None = None
    key: Callable[[], Column] | None = None
    label: Callable[[], Column] = lambda: F.col("id")
    level: str = "error"


@dataclass(frozen=True)
class SourceSpec:
    """Everything the jobs need to know of a source. Rules and names are column expressions,
    so a further source plugs in without a Python function per row."""

    name: str
    schema: StructType
    page_size: int | None  # None: not known
    rules: Callable[[], list[Column]]
    record_id: Callable[[], Column]
    file_name: Callable[[], Column]
    literal_source: str | None = None  # the only value of ``fuente``, where one is fixed
    blank_rules: dict[str, Callable[[], Column]] = field(default_factory=dict)
    has_year: bool = False
    checks: tuple[Check, ...] = ()  # of this source alone, after those that every source has

    def issues(self) -> Column:
        """List of ``field: rule`` messages; empty for a valid record."""
        rules = self.rules()
        if self.literal_source is not None:
            rules = [F.when(~F.col("fuente").eqNullSafe(self.literal_source), f"fuente: expected {self.literal_source}"), *rules]
        return F.array_compact(F.array(*rules))


_BLANKS = {f: (lambda f=f: is_blank(F.col(f))) for f in ("expediente", "unidadFiscalizable", "sector", "resolucion")}
_BLANKS["administrados"] = lambda: is_blank_list(F.col("administrados"))

TYPED = SourceSpec(
    "typed",
    TYPED_SCHEMA,
    10,
    _typed_rules,
    _typed_id,
    lambda: _file_name(F.when(F.col("resolucion") == "", F.col("expediente")).otherwise(F.col("resolucion"))),
    blank_rules=_BLANKS,
    has_year=True,
)
FREE = SourceSpec(
    "free",
    FREE_SCHEMA,
    None,
    _free_rules,
    lambda: identity.free_id(F.col("texto"), F.col("documentoUuid")),
    lambda: _file_name(F.col("texto")),
)

REGISTRY = {s.name: s for s in (TYPED, FREE)}


def spec_of(name: str, registry: dict[str, SourceSpec] | None = None) -> SourceSpec:
    known = REGISTRY if registry is None else registry
    if name not in known:
        raise KeyError(f"unknown source {name!r}; known: {', '.join(sorted(known))}")
    return known[name]


def default_paths(root: str, source: str, task: str) -> dict[str, str]:
    """Where a source's tables lie unless told otherwise."""
    return {
        "records": f"{root}/{source}.jsonl",
        "manifest": f"{root}/{source}.descargas.jsonl",
        "queue": f"{root}/{source}.failed.jsonl",
        "checkpoint": f"{root}/{source}.{task}.checkpoint.json",
        "documents": f"{root}/{source}",
    }


def file_name_policy(source: Column, specs: dict[str, SourceSpec]) -> Column:
    """File name by the source of each row; a source without a rule is an error."""
    name = F.raise_error(F.concat(F.lit("no file-name rule for source "), source))
    for value, spec in specs.items():
        name = F.when(source == value, spec.file_name()).otherwise(name)
    return name
