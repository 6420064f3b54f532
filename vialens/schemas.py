"""Declared schemas: no read in this package infers one."""

from pyspark.sql import types as T

SCENE_ATTRIBUTES = ("weather", "timeofday", "scene")

ATTRIBUTES = T.StructType([T.StructField(a, T.StringType()) for a in SCENE_ATTRIBUTES])

BOX = T.StructType([T.StructField(c, T.DoubleType()) for c in ("x1", "y1", "x2", "y2")])

LABEL = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("box2d", BOX),
        T.StructField(
            "attributes",
            T.StructType(
                [
                    T.StructField("occluded", T.BooleanType()),
                    T.StructField("truncated", T.BooleanType()),
                    T.StructField("trafficLightColor", T.StringType()),
                    T.StructField("crowd", T.BooleanType()),
                ]
            ),
        ),
    ]
)

CORRUPT = "_corrupt_record"

# One label document per image (bronze). Every optional branch is declared, so
# a file that lacks one simply reads NULL there.
LABEL_DOCUMENT = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("image_filename", T.StringType()),
        T.StructField("video_name", T.StringType()),
        T.StructField("frame_index", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("metadata", ATTRIBUTES),
        T.StructField("attributes", ATTRIBUTES),
        T.StructField("labels", T.ArrayType(LABEL)),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

GENERATED_ANNOTATION = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("attributes", ATTRIBUTES),
        T.StructField(
            "labels",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.StringType()),
                        T.StructField("category", T.StringType()),
                        T.StructField("box2d", BOX),
                    ]
                )
            ),
        ),
        T.StructField(
            "processing_status",
            T.StructType(
                [
                    T.StructField("scene_classification", T.StringType()),
                    T.StructField("object_detection", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "processing_errors",
            T.StructType(
                [
                    T.StructField("scene_classification", T.StringType()),
                    T.StructField("object_detection", T.StringType()),
                ]
            ),
        ),
    ]
)

SCENE_CSV = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("image_name", *SCENE_ATTRIBUTES)]
    + [
        T.StructField(c, T.IntegerType())
        for c in ("object_count", "car_count", "truck_count", "person_count")
    ]
)

GOLD = T.StructType(
    [T.StructField(c, T.StringType()) for c in (*SCENE_ATTRIBUTES, "mapped_category")]
    + [
        T.StructField("total_count", T.LongType()),
        T.StructField("total_images", T.LongType()),
        T.StructField("avg_count", T.DoubleType()),
        T.StructField("std_dev", T.DoubleType()),
    ]
    + [
        T.StructField(c, T.LongType())
        for c in ("q1_count", "median_count", "q3_count", "min_count", "max_count")
    ]
)

CATEGORY_MAPPING = T.StructType(
    [
        T.StructField("original_category", T.StringType(), False),
        T.StructField("mapped_category", T.StringType(), False),
        T.StructField("category_description", T.StringType()),
    ]
)

# The category dimension of the statistics table.
CATEGORY_ROWS = [
    ("car", "vehicle", "Personal passenger vehicle"),
    ("truck", "vehicle", "Commercial/cargo truck"),
    ("bus", "vehicle", "Public transportation bus"),
    ("bicycle", "vehicle", "Two-wheeled bicycle"),
    ("motorcycle", "vehicle", "Motorized two-wheeler"),
    ("other vehicle", "vehicle", "Other unspecified vehicle types"),
    ("train", "vehicle", "Railway train"),
    ("trailer", "vehicle", "Vehicle trailer/attachment"),
    ("traffic sign", "traffic_sign", "Road signage and traffic signs"),
    ("traffic light", "traffic_sign", "Traffic control lights"),
    ("pedestrian", "pedestrian", "Person walking"),
    ("rider", "pedestrian", "Person riding bicycle/motorcycle"),
    ("other person", "pedestrian", "Other unspecified person types"),
]

# Default category names of the box evaluation (a parameter everywhere).
EVALUATION_CATEGORIES = {
    "car": "vehicle",
    "truck": "vehicle",
    "bus": "vehicle",
    "motorcycle": "vehicle",
    "bicycle": "vehicle",
    "traffic light": "traffic_light",
    "traffic sign": "traffic_sign",
    "stop sign": "traffic_sign",
    "person": "person",
    "pedestrian": "person",
}

# File extensions that count as images.
IMAGE_EXTENSIONS = ("jpg", "jpeg", "png", "gif", "bmp", "tiff", "tif", "webp")
