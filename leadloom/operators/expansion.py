"""Expansion documents: payloads of any shape to 0..n documents, with defaults for keys that are absent, kept as VARIANT.

A key that is there with a null stays null; only an absent key takes the company's value. Documents are objects of any fields, so
they are stored as they are and read with ``try_variant_get``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys of a result object that may hold its documents, the first that does counts.
DOCUMENT_KEYS = "payload doc document raw result results items documents expansion expansions".split()
FALLBACK_SOURCE = "run_company_entity_expansion_wrapper_fallback"
#: Company columns that a document gets where it lacks the key.
DEFAULTS = ("canonical_name", "mailing_city", "mailing_state", "dataset_id", "dataset_run_ref")
OBJECT = "map<string,variant>"


def _is(kind: str, value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith(kind), F.lit(False))


def _objects(items: Column) -> Column:
    return F.filter(items, lambda v: _is("OBJECT", v))


def _items(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def payload_documents(value: Column, wrapped: Column, fallback: Column) -> Column:
    """Array of the documents (variants) in the variant ``value``: an object is one, a list has its objects and those of lists in it. The fields of
    a result object (``wrapped``) are looked through for documents by DOCUMENT_KEYS; without any, and for an object without fields,
    ``fallback`` is the document. A null or plain value has none."""
    none = F.array().cast("array<variant>")
    nested = F.flatten(F.transform(_items(value), lambda v: F.when(_is("OBJECT", v), F.array(v)).when(_is("ARRAY", v), _objects(_items(v))).otherwise(none)))
    fields = F.try_variant_get(value, "$", OBJECT)

    def under(key: str) -> Column:
        v = F.try_variant_get(value, f"$.{key}", "variant")
        found = F.when(_is("OBJECT", v), F.array(v)).when(_is("ARRAY", v), _objects(_items(v)))
        return F.when(F.size(found) > 0, found)

    in_result = F.coalesce(*[under(k) for k in DOCUMENT_KEYS], F.array(fallback))
    of_object = F.when(F.size(fields) == 0, F.array(fallback)).when(wrapped, in_result).otherwise(F.array(value))
    return F.when(_is("OBJECT", value), of_object).when(_is("ARRAY", value), nested).otherwise(none)


def with_defaults(document: Column, defaults: dict[str, Column]) -> Column:
    """The object ``document`` with each of ``defaults`` whose key is absent; a key that holds null keeps it."""
    fields = F.try_variant_get(document, "$", OBJECT)
    given = F.map_from_arrays(F.array(*map(F.lit, defaults)), F.array(*[c.cast("variant") for c in defaults.values()]))
    return F.to_variant_object(F.map_concat(fields, F.map_filter(given, lambda k, _: ~F.map_contains_key(fields, k))))


def expansion_documents(companies: DataFrame, parent_run_id: str, payload: str = "payload", wrapped: str = "wrapped") -> DataFrame:
    """company_id, place and document of every document in the companies' payloads (JSON text; one that is not valid counts as null).

    ``companies`` has id, DEFAULTS, ``payload`` and ``wrapped`` (whether it came as a result object)."""
    value = F.try_parse_json(F.col(payload))
    own = {"parent_run_id": F.lit(parent_run_id), "company_id": F.col("id").cast("bigint")}
    fields = own | {"canonical_name": F.col("canonical_name"), "source": F.lit(FALLBACK_SOURCE)}
    fallback = F.to_variant_object(F.map_from_arrays(F.array(*map(F.lit, [*fields, "payload"])), F.array(*[c.cast("variant") for c in fields.values()], F.col("_value"))))
    parsed = companies.withColumn("_value", value)
    found = parsed.select(*companies.columns, F.posexplode(payload_documents(F.col("_value"), F.coalesce(wrapped, F.lit(False)), fallback)).alias("place", "_doc"))
    return found.select(F.col("id").alias("company_id"), "place", with_defaults(F.col("_doc"), own | {c: F.col(c) for c in DEFAULTS}).alias("document"))


def raw_expansions(expanded: DataFrame, source_key: str, parent_run_id: str, as_of: Column) -> DataFrame:
    """Rows for the raw expansions: every column of ``expanded`` in one object beside the source, the run and the time."""
    payload = F.to_variant_object(F.struct(*[F.col(c) for c in expanded.columns]))
    return expanded.select(F.lit(source_key).alias("source_key"), F.lit(parent_run_id).alias("parent_run_id"), as_of.alias("captured_at"), payload.alias("raw_payload"))


def expansion_run(written: DataFrame, source_key: str, parent_run_id: str, started_at: Column, as_of: Column) -> DataFrame:
    """The run document of an expansion: one row with the number of documents, 0 for none."""
    return written.agg(F.count(F.lit(1)).alias("record_count")).select(
        F.lit(f"company_expansion::{parent_run_id}").alias("run_id"), F.lit(source_key).alias("source_key"), F.lit(parent_run_id).alias("parent_run_id"), started_at.alias("started_at"),
        as_of.alias("completed_at"), F.lit("completed").alias("status"), "record_count", F.lit("serp_discovery").alias("acquisition_method"),
    )


def append_documents(documents: DataFrame, path: str) -> DataFrame:
    """Append ``documents`` to the table at ``path``; all that it has now."""
    documents.write.mode("append").parquet(path)
    return read_documents(documents.sparkSession, path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
