import json
import random

import pytest

from vialens.operators import validate


SCENE = ("weather", "timeofday", "scene")
NOT_AN_OBJECT = (None, 3, "x", True, [], [1])
NOT_AN_ARRAY = (None, 3, "x", {}, {"0": 1})


class Made:
    """A document and the errors that were built into it."""

    def __init__(self, rng):
        self.rng, self.errors = rng, []
        self.doc = {"name": "n"} if rng.random() > 0.2 else {}
        for key in validate.REQUIRED_FIELDS:
            self.put(self.doc, key, "Missing required field: {}")
        if "attributes" in self.doc:
            self.doc["attributes"] = self.attributes()
        if "labels" in self.doc:
            self.doc["labels"] = self.labels()

    def put(self, obj, key, message, share=0.1):
        """Sets the key, to null at times, or leaves it out and notes the error."""
        if self.rng.random() < share:
            self.errors.append(message.format(key))
        else:
            obj[key] = self.rng.choice([None, 1, "v", 2.5])

    def attributes(self):
        if self.rng.random() < 0.15:
            self.errors.append("Field 'attributes' must be an object")
            return self.rng.choice(NOT_AN_OBJECT)
        out = {}
        for key in SCENE:
            self.put(out, key, "Missing required attribute: {}")
        return out

    def labels(self):
        if self.rng.random() < 0.15:
            self.errors.append("Field 'labels' must be an array")
            return self.rng.choice(NOT_AN_ARRAY)
        return [self.label(i) for i in range(self.rng.randint(0, 13))]

    def label(self, i):
        if self.rng.random() < 0.06:
            self.errors.append(f"Label {i} must be an object")
            return self.rng.choice(NOT_AN_OBJECT)
        out = {}
        for key in validate.LABEL_FIELDS:
            self.put(out, key, f"Label {i} missing required field: {{}}", 0.04)
        if "box2d" in out and self.rng.random() < 0.8:
            out["box2d"] = {}
            for key in validate.BOX_FIELDS:
                self.put(out["box2d"], key, f"Label {i} box2d missing field: {{}}", 0.04)
        return out

    @property
    def strict(self):
        d = self.doc
        return (
            {"name", "attributes", "labels"} <= d.keys()
            and isinstance(d["attributes"], dict)
            and set(SCENE) <= d["attributes"].keys()
            and isinstance(d["labels"], list)
            and d["labels"] != []
        )


def made_document(rng):
    """(text, errors, strictly qualified)"""
    made = Made(rng)
    errors, text, shape = "; ".join(made.errors), json.dumps(made.doc), rng.random()
    if shape < 0.1:
        return json.dumps([made.doc, rng.choice(NOT_AN_OBJECT)]), errors, False
    if shape < 0.2:
        return text[: rng.randint(0, len(text) - 1)], validate.MALFORMED, False
    return text, errors, made.strict


MISSING_ALL = "; ".join(f"Missing required field: {k}" for k in validate.REQUIRED_FIELDS)
SPECIAL = [
    ("", validate.MALFORMED, False),
    ("[]", MISSING_ALL, False),
    ("{}", MISSING_ALL, False),
    ("null", validate.NOT_OBJECT, False),
    ("[[]]", validate.NOT_OBJECT, False),
    ("[null, {}]", validate.NOT_OBJECT, False),
    ("5", validate.NOT_OBJECT, False),
    ('"video_name"', validate.NOT_OBJECT, False),
]


@pytest.fixture(scope="module")
def documents(spark):
    rng = random.Random(11)
    made = SPECIAL + [made_document(rng) for _ in range(1500)]
    rows = [(n, text) for n, (text, _, _) in enumerate(made)]
    return made, spark.createDataFrame(rows, "n long, value string")


def test_errors_are_those_built_in(documents):
    made, df = documents
    for r in validate.validated(df).collect():
        text, errors, _ = made[r.n]
        assert (r.errors, r.is_valid) == (errors, errors == ""), text


def test_strict_rule(documents):
    made, df = documents
    kept = {r.n for r in validate.strictly_qualified(df).collect()}
    assert kept == {n for n, (_, _, strict) in enumerate(made) if strict}


def test_qualified_plus_unqualified_is_all(documents):
    made, df = documents
    counts = validate.validation_summary(validate.validated(df)).collect()
    assert sum(r.n_files for r in counts) == len(made)
    assert min(r.n_files for r in counts) > 50


def test_every_label_is_checked(spark):
    label = {"id": 1, "category": "c", "box2d": None, "attributes": {}}
    doc = dict.fromkeys(validate.REQUIRED_FIELDS, 1)
    doc["attributes"] = dict.fromkeys(("weather", "timeofday", "scene"))
    doc["labels"] = [label] * 10 + [3]
    df = spark.createDataFrame([(json.dumps(doc),)], "value string")
    assert validate.validated(df).head().errors == "Label 10 must be an object"
    assert validate.validated(df, max_labels=10).head().is_valid


def test_text_is_parsed_once(spark):
    df = spark.createDataFrame([("{}",)], "value string").repartition(1)
    plan = validate.strictly_qualified(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1
