"""Schemas as plain values, so that they can be made without a session."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, IntegerType, LongType, MapType, StringType, StructField, StructType, TimestampType,
)

TEXT, COUNT, SMALL, TIME, FLAG = StringType(), LongType(), IntegerType(), TimestampType(), BooleanType()
TEXTS, TEXT_MAP = ArrayType(StringType()), MapType(StringType(), StringType())


def schema(**fields: DataType) -> StructType:
    return StructType([StructField(n, t) for n, t in fields.items()])


BASE = dict(fuente=TEXT, id=TEXT, indice=COUNT, pagina=COUNT, capturadoEn=TIME, documentoUuid=TEXT)
TYPED_SCHEMA = schema(
    **BASE, expediente=TEXT, administrados=TEXTS, unidadFiscalizable=TEXT, sector=TEXT, resolucion=TEXT, anioResolucion=SMALL
)
FREE_SCHEMA = schema(**BASE, campos=TEXT_MAP, texto=TEXT)
MANIFEST_SCHEMA = schema(
    id=TEXT, fuente=TEXT, documentoUuid=TEXT, pagina=COUNT, indice=COUNT, archivo=TEXT, bytes=COUNT, sha256=TEXT,
    nombreServidor=TEXT, descargadoEn=TIME, seq=COUNT,
)
QUEUE_SCHEMA = schema(
    seq=COUNT, id=TEXT, tipo=TEXT, error=TEXT, intentos=SMALL, ultimoTs=TIME, detalle=TEXT, contexto=TEXT_MAP
)
CHECKPOINT_SCHEMA = schema(
    fuente=TEXT, tarea=TEXT, pageSize=SMALL, total=COUNT, ultimaPagina=SMALL, completo=FLAG, registros=COUNT, actualizadoEn=TIME
)
