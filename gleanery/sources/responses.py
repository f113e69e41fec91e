"""Landed responses: partial-XML envelopes and whole pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.functions.markup import is_token_id

_ENVELOPE = """
  changes array<struct<update:array<struct<_id:string,_VALUE:string>>>>,
  redirect array<struct<_url:string>>,
  error array<struct<`error-name`:string,`error-message`:string>>
"""


def partial_responses(responses: DataFrame, body: str = "body") -> DataFrame:
    """Envelope columns next to the response's own: ``es_partial, updates, token, redirect, error``.

    Any other body gives ``es_partial = false`` and never fails the task; so does a broken
    envelope, which is partial and has nothing in it. ``updates`` keeps the order of the
    envelope; of an update sent twice the last content counts.
    """
    keep = [c for c in responses.columns if c != body]
    partial = F.contains(F.col(body), F.lit("<partial-response"))
    # The prolog and anything before the root element is of no use to from_xml.
    root = F.regexp_extract(body, r"(?s)(<partial-response.*)", 1)
    x = F.from_xml(F.when(partial, root), _ENVELOPE, {"mode": "PERMISSIVE", "ignoreNamespace": "true"})
    seen = responses.select(*keep, partial.alias("es_partial"), x.alias("x"))
    sent = F.coalesce(
        F.flatten(F.transform("x.changes", lambda c: F.coalesce(c["update"], F.array().cast("array<struct<_id:string,_VALUE:string>>")))),
        F.array().cast("array<struct<_id:string,_VALUE:string>>"),
    )
    named = F.transform(
        F.filter(sent, lambda u: u["_id"].isNotNull()),
        lambda u: F.struct(u["_id"].alias("id"), F.coalesce(u["_VALUE"], F.lit("")).alias("content")),
    )
    # An id keeps its first place in the order and its last content.
    updates = F.transform(
        F.filter("_named", lambda u, i: ~F.exists(F.slice("_named", F.lit(1), i), lambda v: v["id"] == u["id"])),
        lambda u: F.struct(
            u["id"].alias("id"),
            F.element_at(F.filter("_named", lambda v: v["id"] == u["id"]), -1)["content"].alias("content"),
        ),
    )
    tokens = F.filter(F.col("_named"), lambda u: is_token_id(u["id"]) & (F.trim(u["content"]) != ""))
    name = F.nullif(F.trim(F.get("x.error", F.lit(0))["error-name"]), F.lit(""))
    message = F.trim(F.coalesce(F.get("x.error", F.lit(0))["error-message"], F.lit("")))
    return seen.withColumn("_named", named).select(
        *keep,
        "es_partial",
        updates.alias("updates"),
        F.trim(F.try_element_at(tokens, F.lit(-1))["content"]).alias("token"),
        F.get("x.redirect", F.lit(0))["_url"].alias("redirect"),
        F.when(name.isNotNull(), F.struct(name.alias("name"), message.alias("message"))).alias("error"),
    )


def find_update(updates, target: str):
    """Content of the update with this id, else of the first whose id ends in ``:id``."""
    exact = F.filter(updates, lambda u: u["id"] == target)
    nested = F.filter(updates, lambda u: F.endswith(u["id"], F.lit(":" + target)))
    return F.coalesce(F.get(exact, F.lit(0))["content"], F.get(nested, F.lit(0))["content"])


def response_class():
    """Class over the columns of :func:`partial_responses`; a redirect or an error is an expired view."""
    return (
        F.when(~F.col("es_partial"), "not-partial")
        .when(F.col("error").isNotNull(), "expired-error")
        .when(F.col("redirect").isNotNull(), "expired-redirect")
        .otherwise("partial")
    )
