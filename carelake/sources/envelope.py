"""Change-event envelopes -> classified change images.

Input: any DataFrame with ``topic``, ``position`` (offset / log position) and
``value`` (UTF-8 JSON text or binary) - a Kafka source, a file source, or a
batch table.  The envelope is parsed exactly once with ``from_json``; the
``before``/``after`` images are declared STRING, for which Spark's JSON
reader keeps the object's raw text.  So one decode serves every table
whatever its row shape, and each image is typed later, once, with its own
table schema (``typed_image``) or turned into a VARIANT for raw tables.

Reference behaviour: the envelope must carry a ``payload`` wrapper
(``accept_flat=False``); ``accept_flat=True`` also takes the flat shape a
converter without schemas produces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..registry import ENTITIES, wire_ddl
from .kafka import topics_for

UPSERT_OPS = ("c", "u", "r")     # create, update, snapshot read
DELETE_OP = "d"

_BODY = "op string, before string, after string"
ENVELOPE_DDL = f"payload struct<{_BODY}>, {_BODY}"
#: Server name of the topics that the jobs subscribe to unless told otherwise.
SERVER = "server"


def table_of_topic(topic: Column) -> Column:
    """``server.schema.table`` -> ``table`` (last dotted part)."""
    return F.element_at(F.split(topic, r"\."), -1)


def _present(img: Column) -> Column:
    """A row image is there: neither null nor an empty object."""
    t = F.trim(img)
    return img.isNotNull() & ~t.isin("{}", "null")


#: What stands in an envelope with a text that may read as an object: a quote before a brace, a blank or an escape.
TEXT_OBJECT = ('"{', '" ', '"\\u')


def _is_object(img: Column, value: Column) -> Column:
    """The image is a JSON object.

    The envelope's parser hands out the raw text of an object, which it has read to its end, but also the content
    of a text; only envelopes that may hold such a text have the image parsed again."""
    text = value.cast("string")
    doubt = F.lit(False)
    for x in TEXT_OBJECT:
        doubt = doubt | F.contains(text, F.lit(x))
    return F.startswith(F.trim(img), F.lit("{")) & F.when(doubt, F.try_parse_json(img).isNotNull()).otherwise(F.lit(True))


def decode(df: DataFrame, accept_flat: bool = False, topics=None) -> DataFrame:
    """Add ``table_name, known_table, payload_ok, op, before, after``.

    ``topics``: the subscribed topics, compared whole (default: those of the
    four captured tables on ``SERVER``)."""
    known = list(topics or topics_for(SERVER, ENTITIES))
    env = F.from_json(F.col("value").cast("string"), ENVELOPE_DDL)
    out = df.select("*", env.alias("_env"), table_of_topic(F.col("topic")).alias("table_name"))
    p = F.col("_env.payload")
    p_ok = p.isNotNull() & (p.op.isNotNull() | p.before.isNotNull() | p.after.isNotNull())
    if accept_flat:
        flat_ok = F.col("_env.op").isNotNull()
        pick = lambda f: F.when(p_ok, p[f]).otherwise(F.col(f"_env.{f}"))
        ok = p_ok | flat_ok
    else:
        pick = lambda f: p[f]
        ok = p_ok
    return out.select(
        *[c for c in df.columns], "table_name",
        F.coalesce(F.col("topic").isin(known), F.lit(False)).alias("known_table"),
        ok.alias("payload_ok"),
        F.when(ok, pick("op")).alias("op"),
        F.when(ok, pick("before")).alias("before"),
        F.when(ok, pick("after")).alias("after"),
    )


def typed_image(image: Column, table: str) -> Column:
    """Image JSON text -> struct of the table's wire columns (one parse)."""
    return F.from_json(image, wire_ddl(table))
