"""Identity of a record: a digest of its content.

A portal's own document id is no key: it may be missing, and several records may share
one. Positions move whenever the portal publishes. What stays is the content.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ID_LENGTH = 24  # fixed value: hex digits kept of the sha1


def _digest(parts: list[Column], separator: str) -> Column:
    # concat_ws skips NULLs and would shift the parts, so none may be NULL.
    whole = F.concat_ws(separator, *[F.coalesce(p, F.lit("")) for p in parts])
    return F.substring(F.sha1(whole.cast("binary")), 1, ID_LENGTH)


def typed_id(
    expediente: Column,
    administrados: Column,
    unidad: Column,
    sector: Column,
    resolucion: Column,
    documento: Column,
) -> Column:
    """Identity of a typed record; the parts are joined by NUL, the parties by a bar."""
    parties = F.array_join(administrados, "|")
    return _digest([expediente, parties, unidad, sector, resolucion, documento], "\u0000")


def free_id(texto: Column, documento: Column) -> Column:
    """Identity of a schemaless record: its whole text, a blank, its document."""
    return _digest([texto, documento], " ")
