"""Feed documents -> station rows.

A feed document is ``{"last_updated": ..., "data": {"stations": [{...}, ...]}}``.
Documents travel as JSON text (column ``document``) and are parsed once, to
typed stations with just the wanted keys: of a key that is repeated within a
station the last value counts, and other keys are skipped by the parser.
Only a document with a value of another form (a flag or float for a count,
or one that is wrong) is parsed again, as text that is cast strictly.  A key
absent from *every* station of a document is an error, absent from some is
NULL.  That rule is an expression of the same scan: a document whose first
station has a value for every key passes, and only another one is parsed
again, into key maps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.functions.casts import strict_cast
from stationlake.schemas import INFO_SCHEMA, STATUS_SCHEMA

#: The column of the documents' JSON text.
DOCUMENT = "document"


def _feed_type(station: T.DataType) -> T.StructType:
    stations = T.StructType([T.StructField("stations", T.ArrayType(station))])
    return T.StructType([T.StructField("last_updated", T.LongType()), T.StructField("data", stations)])


def _text_type(schema: T.StructType) -> T.StructType:
    """Documents with the keys of ``schema`` of every station, as text."""
    return _feed_type(T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]))


# What does not parse as typed is kept beside the document; the other forms raise.
_BAD = T.StructField("_bad", T.StringType())
_LENIENT = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD.name}
#: Stations with all their keys.
_KEYED = _feed_type(T.MapType(T.StringType(), T.StringType()))


def _strict(kind: T.StructType) -> str:
    """SQL: the stations of a document parsed as ``kind``; raises if malformed."""
    return f"from_json({DOCUMENT}, '{kind.simpleString()}', map('mode', 'FAILFAST')).data.stations"


def _absent(required: Sequence[str]) -> str:
    """SQL: the required keys that no station of the document carries (all, if
    it has no stations)."""
    keys = ", ".join(f"'{k}'" for k in required)
    return f"array_except(array({keys}), flatten(transform({_strict(_KEYED)}, s -> map_keys(s))))"


def documents(lines: DataFrame) -> DataFrame:
    """Text rows (``value``) as feed documents; blank ones are none."""
    return lines.select(F.col("value").alias(DOCUMENT)).where(F.trim(F.col(DOCUMENT)) != "")


def read_feed(spark: SparkSession, path, multi_line: bool = False) -> DataFrame:
    """Read feed documents from a landing folder (or list of paths).

    ``multi_line=True`` for one (pretty-printed) document per file, as a feed
    is fetched; ``False`` for JSON Lines, one document per line, which Spark
    can split across tasks.  A truncated or malformed document fails the job
    that parses it, as a failed parse does in the reference.
    """
    return documents(spark.read.text(path, wholetext=multi_line))


def explode_stations(docs: DataFrame, schema: T.StructType,
                     doc_cols: Sequence[str] = (), check_required: bool = True) -> DataFrame:
    """P1 + P2: one row per station, the keys of ``schema`` in order.

    A value that its type cannot hold raises (``strict_cast``: a non-numeric
    count); true/false and whole floats become integers where the schema has
    those.  Keys outside ``schema`` (including nested objects) are dropped.
    ``doc_cols`` are document-level columns stamped on every row (P3).
    An empty ``stations`` list lacks every required key and so raises.
    """
    kind = T.StructType([*_feed_type(schema).fields, _BAD])
    parsed = docs.select(DOCUMENT, F.from_json(DOCUMENT, kind, _LENIENT).alias("_doc")).select(
        DOCUMENT, "_doc", *[F.col(f"_doc.{c}") for c in doc_cols])
    typed, names = "_doc.data.stations", schema.names
    fields = ", ".join(f"'{f.name}', {strict_cast(f's.`{f.name}`', f.dataType)}" for f in schema.fields)
    cast = f"transform({_strict(_text_type(schema))}, s -> CASE WHEN s IS NOT NULL THEN named_struct({fields}) END)"
    stations = f"CASE WHEN _doc.{_BAD.name} IS NULL THEN {typed} ELSE {cast} END"
    if check_required:
        valued = " AND ".join(f"get({typed}, 0).`{k}` IS NOT NULL" for k in names)
        stations = (f"CASE WHEN _doc.{_BAD.name} IS NULL AND {valued} THEN {typed} "  # the usual document
                    f"WHEN {_strict(_KEYED)} IS NULL THEN raise_error('feed document without data.stations') "
                    f"WHEN size({_absent(names)}) > 0 THEN "
                    f"raise_error(concat('required keys absent from every station: ', array_join({_absent(names)}, ', '))) "
                    f"ELSE {stations} END")
    rows = parsed.select(*doc_cols, F.expr(f"explode({stations})").alias("_s"))
    return rows.select(*[F.col(f"_s.`{k}`") for k in names], *doc_cols)


def status_rows(docs: DataFrame, check_required: bool = True,
                keep_last_updated: bool = True) -> DataFrame:
    """Status documents -> the 10 status columns (+ ``last_updated``)."""
    return explode_stations(docs, STATUS_SCHEMA,
                            ("last_updated",) if keep_last_updated else (), check_required)


def info_rows(docs: DataFrame, check_required: bool = True) -> DataFrame:
    """S2 + P3: info documents -> 7 info columns + document ``last_updated``."""
    keys = T.StructType([f for f in INFO_SCHEMA.fields if f.name != "last_updated"])
    return explode_stations(docs, keys, ("last_updated",), check_required)


def missing_keys(docs: DataFrame, required: Sequence[str]) -> DataFrame:
    """P2 as a report: ``(last_updated, missing_key)`` for each document with
    a station list and each required key that none of its stations carries."""
    keyed = docs.select(F.from_json(DOCUMENT, _KEYED, {"mode": "FAILFAST"}).alias("_doc"))
    stations, keys = "_doc.data.stations", ", ".join(f"'{k}'" for k in required)
    absent = f"CASE WHEN {stations} IS NOT NULL THEN array_except(array({keys}), flatten(transform({stations}, s -> map_keys(s)))) END"
    return keyed.select("_doc.last_updated", F.expr(f"explode({absent})").alias("missing_key"))


def unparseable(document: Column, schema: T.StructType = STATUS_SCHEMA) -> Column:
    """The document's text if it does not parse, else NULL."""
    kind = T.StructType([*_text_type(schema).fields, _BAD])
    return F.from_json(document, kind, _LENIENT)[_BAD.name]
