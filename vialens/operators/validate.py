"""Structural checks of label documents held as raw JSON text.

Everything is a Variant expression: the document is parsed once in the JVM,
whatever its shape, and no schema is imposed before the verdict.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialens.functions.let import let
from vialens.operators.transform import with_presence
from vialens.schemas import SCENE_ATTRIBUTES

# Required keys, in reporting order.
REQUIRED_FIELDS = ("video_name", "frame_index", "attributes", "labels")
LABEL_FIELDS = ("id", "category", "box2d", "attributes")
BOX_FIELDS = ("x1", "y1", "x2", "y2")
STRICT_FIELDS = ("name", "attributes", "labels")

MALFORMED = "Malformed JSON"
NOT_OBJECT = "Document is not an object"


_OBJECT = "map<string,variant>"
_ARRAY = "array<variant>"


def _as(v: Column, kind: str) -> Column:
    """The variant as an object or array of variants; NULL when it is something else.

    Looks one level deep: values stay variants. A JSON null is neither.
    """
    return F.try_variant_get(v, "$", kind)


def _has(obj: Column, key: str) -> Column:
    return F.map_contains_key(obj, key)


def _errors(*parts: Column) -> Column:
    """The non-NULL messages, in order."""
    return F.array_compact(F.array(*parts))


def _label_errors(label: Column, position: Column) -> Column:
    """Messages of one label; ``label`` holds it and its box as objects, NULL when they are not."""
    prefix = F.concat(F.lit("Label "), position.cast("string"))
    obj, box = label["obj"], label["box"]
    fields = [
        F.when(~_has(obj, k), F.concat(prefix, F.lit(f" missing required field: {k}")))
        for k in LABEL_FIELDS
    ]
    corners = [
        F.when(~_has(box, k), F.concat(prefix, F.lit(f" box2d missing field: {k}")))
        for k in BOX_FIELDS
    ]
    return F.when(
        obj.isNull(), F.array(F.concat(prefix, F.lit(" must be an object")))
    ).otherwise(_errors(*fields, *corners))


def _inner(doc: Column) -> Column:
    return F.struct(
        _as(doc["attributes"], _OBJECT).alias("attributes"), _as(doc["labels"], _ARRAY).alias("labels")
    )


def _label_parts(label: Column) -> Column:
    obj = _as(label, _OBJECT)
    return F.struct(obj.alias("obj"), _as(obj["box2d"], _OBJECT).alias("box"))


def _document_errors(
    v: Column, items: Column, doc: Column, inner: Column, max_labels: int | None
) -> Column:
    """``v`` parsed, ``items`` v as an array, ``doc`` the judged object, ``inner`` its parts."""
    attributes, labels = inner["attributes"], inner["labels"]
    checked = labels if max_labels is None else F.slice(labels, 1, max_labels)
    empty_array = F.size(items) == 0
    top = [
        F.when(empty_array | ~_has(doc, k), F.lit(f"Missing required field: {k}"))
        for k in REQUIRED_FIELDS
    ]
    attrs = [
        F.when(
            _has(doc, "attributes") & attributes.isNull(),
            F.lit("Field 'attributes' must be an object"),
        )
    ] + [
        F.when(~_has(attributes, k), F.lit(f"Missing required attribute: {k}"))
        for k in SCENE_ATTRIBUTES
    ]
    not_list = F.when(
        _has(doc, "labels") & labels.isNull(), F.lit("Field 'labels' must be an array")
    )
    per_label = F.coalesce(
        F.flatten(F.transform(F.transform(checked, _label_parts), _label_errors)),
        F.array().cast("array<string>"),
    )
    return (
        F.when(v.isNull(), F.array(F.lit(MALFORMED)))
        .when(empty_array, _errors(*top))
        .when(doc.isNull(), F.array(F.lit(NOT_OBJECT)))
        .otherwise(F.concat(_errors(*top, *attrs, not_list), per_label))
    )


def document_errors(text: Column, max_labels: int | None = None) -> Column:
    """All errors of a document, joined with "; "; empty when there are none."""

    def judged(v: Column, items: Column) -> Column:
        root = F.when(items.isNotNull(), F.try_element_at(items, F.lit(1))).otherwise(v)
        return let(
            _as(root, _OBJECT),
            lambda doc: let(
                _inner(doc), lambda inner: _document_errors(v, items, doc, inner, max_labels)
            ),
        )

    errors = let(
        F.try_parse_json(text), lambda v: let(_as(v, _ARRAY), lambda items: judged(v, items))
    )
    return F.array_join(errors, "; ")


def validated(
    documents: DataFrame, text: str = "value", max_labels: int | None = None
) -> DataFrame:
    """Adds ``is_valid`` and ``errors`` to documents held as text.

    A top-level array is judged by its first element. Keys must be present but
    may hold null. All labels are checked; ``max_labels=10`` checks the first ten, as the
    original does.
    """
    return documents.withColumn("errors", document_errors(F.col(text), max_labels)).withColumn(
        "is_valid", F.col("errors") == ""
    )


def validation_summary(checked: DataFrame) -> DataFrame:
    return checked.groupBy("is_valid").agg(F.count(F.lit(1)).alias("n_files"))


def _if_strict(text: Column, result: Callable[[Column], Column]) -> Column:
    """``result`` of the document as an object where it passes the second rule set, else NULL."""

    def passes(doc: Column, inner: Column) -> Column:
        ok = F.coalesce(F.size(inner["labels"]) > 0, F.lit(False))
        for k in STRICT_FIELDS:
            ok = ok & _has(doc, k)
        for k in SCENE_ATTRIBUTES:
            ok = ok & _has(inner["attributes"], k)
        return ok

    return let(
        _as(F.try_parse_json(text), _OBJECT),
        lambda doc: let(_inner(doc), lambda inner: F.when(passes(doc, inner), result(doc))),
    )


def strictly_qualified(documents: DataFrame, text: str = "value") -> DataFrame:
    """Documents passing the second rule set; unparseable ones drop out silently."""
    return documents.where(_if_strict(F.col(text), lambda doc: F.lit(True)))


def qualified_names(
    documents: DataFrame, images: DataFrame, text: str = "value", key: str = "name"
) -> DataFrame:
    """Names of the strictly qualified documents, with ``is_present``: whether the image exists."""
    # exploded rather than filtered: a filter would parse every document a second time
    name = _if_strict(
        F.col(text), lambda doc: F.array(F.try_variant_get(doc[key], "$", "string"))
    )
    return with_presence(documents.select(F.explode(name).alias(key)), images, key)
