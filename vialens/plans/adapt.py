"""The driver tables seen as the inputs of the operators.

Texts that both engines must build alike are SQL expressions valid in Spark and
in ANSI SQL, so the checks read the very same input.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialens.operators.transform import category_mapping

CATEGORY_OF_TYPE = [
    ("ECONOMY", "vehicle", None),
    ("SMALL", "vehicle", None),
    ("MEDIUM", "traffic_sign", None),
    ("STANDARD", "traffic_sign", None),
    ("PROMO", "pedestrian", None),
]

WEATHER = """CASE o_orderpriority WHEN '1-URGENT' THEN 'rainy' WHEN '2-HIGH' THEN 'clear'
    WHEN '3-MEDIUM' THEN 'overcast' WHEN '4-NOT SPECIFIED' THEN 'partly cloudy'
    ELSE 'snowy' END"""
TIMEOFDAY = """CASE o_orderstatus WHEN 'O' THEN 'daytime' WHEN 'F' THEN 'night'
    ELSE 'dawn/dusk' END"""
SCENE = "CASE c_mktsegment WHEN 'MACHINERY' THEN 'highway' ELSE lower(c_mktsegment) END"

# A label document per order, well formed or broken in one of a dozen ways.
_KEY = "CAST(o_orderkey AS VARCHAR(20))"
_ATTRS = (
    """'{"weather":"' || o_orderpriority || '","timeofday":null,"scene":"' || o_orderstatus || '"}'"""
)
_LABEL = """'{"id":"' || CAST(o_custkey AS VARCHAR(20)) || '","category":"car","box2d":{"x1":1,"y1":2,"x2":3.5,"y2":4},"attributes":{}}'"""
_BAD = """'{"id":"7","box2d":{"x1":1,"x2":3,"y1":0},"attributes":null}'"""


_FRAME = "CAST(o_custkey AS VARCHAR(20))"
_TYPED = """'{"id":8,"category":"rider","box2d":{"x1":"1.5","y1":"2","x2":"x","y2":7},"attributes":{"occluded":true,"trafficLightColor":"NA"}}'"""


def _document(attrs: str, labels: str, video: bool = True, frame: str = _FRAME, more: str = "") -> str:
    name = f""""video_name":"v' || {_KEY} || '",""" if video else ""
    return (
        f"""'{{{more}"name":"n' || {_KEY} || '",{name}"frame_index":' || {frame} """
        f"""|| ',"attributes":' || {attrs} || ',"labels":' || {labels} || '}}'"""
    )


_GOOD = _document(_ATTRS, f"'[' || {_LABEL} || ',' || {_LABEL} || ']'")
_LONG = "'[' || repeat(" + _LABEL + " || ',', 10) || " + _BAD + " || ']'"
DOCUMENT_TEXT = f"""CASE o_orderkey % 17
    WHEN 0 THEN {_GOOD}
    WHEN 1 THEN {_document(_ATTRS, "'[]'", video=False)}
    WHEN 2 THEN {_document("'" + '"sunny"' + "'", "'[null,' || " + _LABEL + " || ']'")}
    WHEN 3 THEN {_document("'" + '{"weather":null}' + "'", "'[' || " + _BAD + " || ',3]'")}
    WHEN 4 THEN {_document(_ATTRS, "'{}'")}
    WHEN 5 THEN {_document(_ATTRS, "'[' || " + _LABEL + " || ',' || " + _BAD + " || ']'")}
    WHEN 6 THEN {_document(_ATTRS, "'[{" + '"box2d":null' + "}]'")}
    WHEN 7 THEN substr({_GOOD}, 1, 40)
    WHEN 8 THEN '[' || {_GOOD} || ',5]'
    WHEN 9 THEN '[]'
    WHEN 10 THEN {_document(_ATTRS, _LONG)}
    WHEN 11 THEN '[' || {_KEY} || ']'
    WHEN 12 THEN {_document(_ATTRS, "'[' || " + _TYPED + " || ']'", frame="""'"f7"'""")}
    WHEN 13 THEN {_document(_ATTRS, "'[' || " + _LABEL + " || ',5]'", frame="'1.5'")}
    WHEN 14 THEN {_document(_ATTRS, "'[' || " + _TYPED + " || ',' || " + _LABEL + " || ']'", more='"metadata":{"weather":"fog","scene":""},')}
    WHEN 15 THEN '[' || {_GOOD} || ',' || {_document(_ATTRS, "'[' || " + _LABEL + " || ']'", frame="'99'")} || ']'
    ELSE '{{' || '}}' END"""

REPLY_KEY = "substr(props, 7, length(props) - 7)"
REPLY_TEXT = f"""CASE event_type
    WHEN 'click' THEN 'Here you go:' || chr(10) || '```json' || chr(10)
        || '{{"weather": "w' || {REPLY_KEY} || '", "scene": "street"}}' || chr(10) || '```' || ' done'
    WHEN 'view' THEN 'I think {{"weather":"clear","timeofday":"t' || {REPLY_KEY} || '","scene":"x"}} fits'
    WHEN 'purchase' THEN '{{"attributes": {{"weather": "rainy", "scene": "s' || {REPLY_KEY} || '"}}, "weather": "no"}}'
    WHEN 'signup' THEN '```json{{"timeofday":"night"}}```'
    ELSE 'no idea {{' || {REPLY_KEY} END"""


ATTEMPT_OK = "event_type NOT IN ('error', 'signup')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mapping(spark: SparkSession) -> DataFrame:
    return category_mapping(spark, CATEGORY_OF_TYPE)


def scene_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An image per order."""
    orders, customer = (table(spark, sf_dir, t) for t in ("orders", "customer"))
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("image_id"),
        F.expr(WEATHER).alias("weather"),
        F.expr(TIMEOFDAY).alias("timeofday"),
        F.expr(SCENE).alias("scene"),
    )


def scene_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label per line item, its category the part type."""
    lineitem, part = (table(spark, sf_dir, t) for t in ("lineitem", "part"))
    return lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("label_id"),
        F.col("l_orderkey").alias("image_id"),
        F.col("p_type").alias("category"),
    )


def dated_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The images, ingested on the first day of their order's year."""
    orders = table(spark, sf_dir, "orders")
    dates = orders.select(
        F.col("o_orderkey").alias("image_id"),
        F.trunc("o_orderdate", "year").alias("ingestion_date"),
    )
    return scene_images(spark, sf_dir).join(dates, "image_id")


def dated_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels, with their image's date."""
    dates = dated_images(spark, sf_dir).select("image_id", "ingestion_date")
    return scene_labels(spark, sf_dir).join(dates, "image_id")


def scene_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat scene table: object counts per order."""
    kind = F.col("category")
    counts = (
        scene_labels(spark, sf_dir)
        .groupBy("image_id")
        .agg(
            F.count(F.lit(1)).alias("object_count"),
            F.count_if(kind.isin("ECONOMY", "SMALL")).alias("car_count"),
            F.count_if(kind == "LARGE").alias("truck_count"),
            F.count_if(kind == "PROMO").alias("person_count"),
        )
    )
    names = ("object_count", "car_count", "truck_count", "person_count")
    return (
        scene_images(spark, sf_dir)
        .join(counts, "image_id", "left")
        .withColumns({n: F.coalesce(n, F.lit(0)) for n in names})
    )


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("doc_key"), F.expr(DOCUMENT_TEXT).alias("value")
    )


def label_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as label documents whose names and scenes sit in changing places."""
    orders, customer = (table(spark, sf_dir, t) for t in ("orders", "customer"))
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    scene = F.struct(
        priority.alias("weather"), status.alias("timeofday"), F.col("c_mktsegment").alias("scene")
    )
    key = F.col("o_orderkey").cast("string")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.when(status == "O", F.concat(F.lit("n"), key)).alias("name"),
        F.when(status == "F", F.concat(F.lit("f"), key)).alias("image_filename"),
        F.when(priority != "5-LOW", F.concat(F.lit("v"), key)).alias("video_name"),
        F.col("o_custkey").alias("frame_index"),
        F.when(
            status == "P",
            F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', o_orderdate)"),
        ).alias("timestamp"),
        F.when(status != "F", scene).alias("metadata"),
        F.when(status != "O", scene).alias("attributes"),
        F.when(status != "P", F.array(F.lit(1), F.lit(2))).alias("labels"),
    )


def line_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as label documents: a label per line of text, its box the line's place."""
    lines = F.split("text", "\n")
    number = lambda c: c.cast("double")
    label = lambda line, i: F.struct(
        i.cast("string").alias("id"),
        line.alias("category"),
        F.struct(
            F.lit(0.0).alias("x1"),
            number(i).alias("y1"),
            number(F.length(line)).alias("x2"),
            number(i + 1).alias("y2"),
        ).alias("box2d"),
        F.struct(
            (F.length(line) > 40).alias("occluded"),
            (i == 0).alias("truncated"),
            F.when(F.length(line) % 3 == 0, "NA").otherwise("G").alias("trafficLightColor"),
        ).alias("attributes"),
    )
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("video_name"),
        F.col("doc_id").alias("frame_index"),
        F.transform(lines, label).alias("labels"),
    )


def item_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as label documents of one label each."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("video_name"),
        F.col("l_linenumber").alias("frame_index"),
        F.array(
            F.struct(
                F.col("l_partkey").cast("string").alias("id"),
                F.col("l_linestatus").alias("category"),
                F.struct(
                    F.col("l_linenumber").alias("x1"),
                    F.col("l_quantity").alias("y1"),
                    (F.col("l_linenumber") + F.col("l_suppkey")).alias("x2"),
                    F.col("l_quantity").alias("y2"),
                ).alias("box2d"),
                F.struct(
                    (F.col("l_linestatus") == "F").alias("occluded"),
                    (F.col("l_quantity") > 25).alias("truncated"),
                    F.when(F.col("l_returnflag") == "N", "NA")
                    .otherwise(F.col("l_returnflag"))
                    .alias("trafficLightColor"),
                ).alias("attributes"),
            )
        ).alias("labels"),
    )


GT_BOX = {
    "x1": "CAST(floor(o_totalprice) AS BIGINT) % 300",
    "y1": "(o_orderkey * 37) % 200",
    "w": "60 + (o_orderkey % 5) * 20",
    "h": "60 + (o_orderkey % 3) * 30",
    "category": """CASE o_orderpriority WHEN '1-URGENT' THEN 'Car' WHEN '2-HIGH' THEN 'truck'
        WHEN '3-MEDIUM' THEN 'person' WHEN '4-NOT SPECIFIED' THEN 'traffic light'
        ELSE 'Van' END""",
}
PRED_BOX = {
    "x1": f"({GT_BOX['x1']}) + (o_orderkey % 7 - 3) * 6"
    " + CASE WHEN o_orderkey % 11 = 0 THEN 2000 ELSE 0 END",
    "y1": f"({GT_BOX['y1']}) + (o_orderkey % 4) * 5",
    "w": f"({GT_BOX['w']}) + (o_orderkey % 2) * 10",
    "h": GT_BOX["h"],
    "category": f"CASE WHEN o_orderstatus = 'P' THEN 'bus' ELSE {GT_BOX['category']} END",
}


def boxes(spark: SparkSession, sf_dir: str, spec: dict[str, str]) -> DataFrame:
    """A box per order, in the image of its customer."""
    x, y, w, h = (spec[c] for c in ("x1", "y1", "w", "h"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("image_id"),
        F.col("o_orderkey").alias("idx"),
        F.expr(spec["category"]).alias("category"),
        F.expr(f"CAST({x} AS DOUBLE)").alias("x1"),
        F.expr(f"CAST({y} AS DOUBLE)").alias("y1"),
        F.expr(f"CAST(({x}) + ({w}) AS DOUBLE)").alias("x2"),
        F.expr(f"CAST(({y}) + ({h}) AS DOUBLE)").alias("y2"),
    )


def true_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("name"),
        F.struct(
            F.concat(F.lit("Q"), F.col("quality").cast("string")).alias("weather"),
            F.concat(F.lit("T"), F.col("toxic").cast("string")).alias("timeofday"),
            F.when(F.col("quality") + F.col("toxic") != 1, F.lit("S")).alias("scene"),
        ).alias("attributes"),
    )


def generated_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("name"),
        F.struct(
            F.when(F.col("n_chars") > 1000, "q1").otherwise("Q0").alias("weather"),
            F.when(F.col("lang") == "en", "t0").alias("timeofday"),
            F.lit("S").alias("scene"),
        ).alias("attributes"),
    )


RUN_EVENT = {
    "run_id": "'run-' || CAST(user_id AS VARCHAR(20))",
    "step": """CASE event_type WHEN 'click' THEN 'annotate' WHEN 'view' THEN 'visualize'
        WHEN 'purchase' THEN 'evaluate' WHEN 'error' THEN 'annotate' END""",
    "status": """CASE WHEN event_type = 'error' THEN 'failed' WHEN value < 2 THEN 'running'
        ELSE 'completed' END""",
    "processed": f"""CASE WHEN event_type IN ('click', 'view', 'purchase')
        THEN CAST({REPLY_KEY} AS BIGINT) END""",
    "failed": """CASE WHEN event_type IN ('click', 'view', 'purchase')
        THEN CAST(floor(value) AS BIGINT) % 10 END""",
    "error": f"CASE WHEN event_type = 'error' THEN 'k=' || {REPLY_KEY} END",
}


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").alias("at"), *[F.expr(e).alias(c) for c, e in RUN_EVENT.items()]
    )


def label_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query vector per label: the mean of its vectors."""
    means = (
        table(spark, sf_dir, "embeddings")
        .select("label", F.posexplode("embedding").alias("pos", "v"))
        .groupBy("label", "pos")
        .agg(F.avg(F.col("v").cast("double")).alias("v"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("pos", "v")))
    return means.groupBy(F.col("label").cast("bigint").alias("query_id")).agg(
        F.transform(ordered, lambda x: x["v"]).alias("embedding")
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
