"""Label documents from JSON text, field by field, with a row for everything left out.

The text is parsed once, to a variant. Every field is taken by its path and
brought to its type by itself, so a value that does not fit costs only itself:
a label that is no object does not take the other labels along, a corner
written as text reads as its number, and a frame index may be text.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialens.functions.let import let
from vialens.operators.transform import image_key
from vialens.schemas import SCENE_ATTRIBUTES

MALFORMED = "Malformed JSON"
EMPTY = "Empty array"
NOT_OBJECT = "Document is not an object"
NO_KEY = "No image key"
LABEL_NOT_OBJECT = "Label is not an object"

_OBJECT, _ARRAY = "map<string,variant>", "array<variant>"


def _at(v: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(v, path, kind)


def _is_object(v: Column) -> Column:
    return _at(v, "$", _OBJECT).isNotNull()


def _label(v: Column) -> Column:
    corners = [_at(v, f"$.box2d.{c}", "double").alias(c) for c in ("x1", "y1", "x2", "y2")]
    flags = [_at(v, f"$.attributes.{c}", "boolean").alias(c) for c in ("occluded", "truncated")]
    return F.struct(
        _at(v, "$.id", "string").alias("id"),
        _at(v, "$.category", "string").alias("category"),
        F.struct(*corners).alias("box2d"),
        F.struct(
            *flags,
            _at(v, "$.attributes.trafficLightColor", "string").alias("trafficLightColor"),
            _at(v, "$.attributes.crowd", "boolean").alias("crowd"),
        ).alias("attributes"),
    )


def _scene(v: Column, part: str) -> Column:
    return F.struct(*[_at(v, f"$.{part}.{a}", "string").alias(a) for a in SCENE_ATTRIBUTES])


def items(raw: DataFrame, text: str = "value") -> DataFrame:
    """A row per document of each text: the columns of ``raw`` without the text, position, item, reason.

    An element of a top-level array is a document. ``reason`` tells why an item is
    none; a text that does not parse and an empty array are one such row each.
    """
    others = [F.col(f"`{c}`") for c in raw.columns if c != text]
    parts = let(
        F.try_parse_json(text),
        lambda v: let(
            _at(v, "$", _ARRAY),
            lambda a: F.when(v.isNull(), F.array(F.struct(F.lit(MALFORMED).alias("reason"), v.alias("item"))))
            .when(F.size(a) == 0, F.array(F.struct(F.lit(EMPTY).alias("reason"), v.alias("item"))))
            .otherwise(
                F.transform(
                    F.when(a.isNotNull(), a).otherwise(F.array(v)),
                    lambda i: F.struct(
                        F.when(~_is_object(i), NOT_OBJECT).alias("reason"), i.alias("item")
                    ),
                )
            ),
        ),
    )
    return raw.select(*others, F.posexplode(parts).alias("position", "part")).select(
        *others, "position", "part.item", "part.reason"
    )


def label_documents(found: DataFrame) -> DataFrame:
    """Typed label documents of ``items`` that are documents."""
    v = F.col("item")
    labels = F.filter(_at(v, "$.labels", _ARRAY), _is_object)
    return found.where(F.col("reason").isNull()).select(
        *[
            _at(v, f"$.{c}", "string").alias(c)
            for c in ("name", "image_filename", "video_name", "frame_index")
        ],
        _at(v, "$.timestamp", "bigint").alias("timestamp"),
        _scene(v, "metadata").alias("metadata"),
        _scene(v, "attributes").alias("attributes"),
        F.transform(labels, _label).alias("labels"),
    )


def rejects(found: DataFrame) -> DataFrame:
    """What ``items`` has that silver does not: (columns of the source, position, label, reason).

    Whole documents have a NULL ``label``: those that are none, and those without
    an image key. Labels that are no object are listed one by one.
    """
    carried = [c for c in found.columns if c not in ("item", "reason")]
    v = F.col("item")
    key = image_key(_at(v, "$.video_name", "string"), _at(v, "$.frame_index", "string"))
    whole = F.coalesce("reason", F.when(key.isNull(), NO_KEY))
    labels = F.coalesce(_at(v, "$.labels", _ARRAY), F.array().cast(_ARRAY))
    bad = F.filter(
        F.transform(
            labels,
            lambda x, i: F.struct(
                i.alias("label"), F.when(~_is_object(x), LABEL_NOT_OBJECT).alias("reason")
            ),
        ),
        lambda r: r["reason"].isNotNull(),
    )
    alone = F.array(F.struct(F.lit(None).cast("int").alias("label"), whole.alias("reason")))
    rows = F.when(whole.isNotNull(), alone).otherwise(bad)
    return found.select(*carried, F.explode(rows).alias("r")).select(*carried, "r.label", "r.reason")
