"""The SQL that each query is checked against."""

from vialens.functions.text import LANGUAGE_INSTRUCTIONS
from vialens.operators import scoring
from vialens.operators.retrieval import CONTEXT_HEAD, CONTEXT_TAIL
from vialens.plans import adapt
from vialens.schemas import EVALUATION_CATEGORIES

ORACLES: dict[str, str] = {}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_MAPPING = "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b, _ in adapt.CATEGORY_OF_TYPE) + (
    ") AS m(original_category, mapped_category)"
)

_SCENES = f"""images AS (
    SELECT o_orderkey AS image_id, {adapt.WEATHER} AS weather, {adapt.TIMEOFDAY} AS timeofday,
        {adapt.SCENE} AS scene
    FROM orders JOIN customer ON o_custkey = c_custkey),
objects AS (
    SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS label_id,
        l_orderkey AS image_id, p_type AS category
    FROM lineitem JOIN part ON l_partkey = p_partkey)"""

_GOLD = f"""{_SCENES},
context AS (
    SELECT o.category AS original_category, m.mapped_category, i.*, o.label_id
    FROM objects o JOIN images i ON o.image_id = i.image_id
    LEFT JOIN {_MAPPING} ON o.category = m.original_category),
per_image AS (
    SELECT weather, timeofday, scene, mapped_category, image_id, count(*) AS n
    FROM context WHERE mapped_category IS NOT NULL GROUP BY ALL),
gold AS (
    SELECT weather, timeofday, scene, mapped_category,
        CAST(sum(n) AS BIGINT) AS total_count, count(*) AS total_images,
        round(avg(n), 6) AS avg_count, round(stddev_samp(n), 6) AS std_dev,
        quantile_disc(n, 0.25) AS q1_count, quantile_disc(n, 0.5) AS median_count,
        quantile_disc(n, 0.75) AS q3_count, min(n) AS min_count, max(n) AS max_count
    FROM per_image GROUP BY ALL)"""

ORACLES["category_distribution"] = f"WITH {_GOLD} SELECT * FROM gold"

ORACLES["gold_incremental"] = ORACLES["category_distribution"]

ORACLES["object_context"] = f"""WITH {_GOLD}
SELECT original_category, mapped_category, weather, timeofday, scene, image_id, label_id
FROM context"""

ORACLES["distinct_values"] = f"WITH {_SCENES} SELECT DISTINCT timeofday FROM images"

ORACLES["value_distribution"] = f"""WITH {_SCENES}
SELECT weather, count(*) AS count FROM images GROUP BY weather"""

_FLAT = f"""{_SCENES},
counts AS (
    SELECT image_id, count(*) AS object_count,
        count(*) FILTER (category IN ('ECONOMY', 'SMALL')) AS car_count,
        count(*) FILTER (category = 'LARGE') AS truck_count,
        count(*) FILTER (category = 'PROMO') AS person_count
    FROM objects GROUP BY image_id),
flat AS (
    SELECT i.*, coalesce(object_count, 0) AS object_count, coalesce(car_count, 0) AS car_count,
        coalesce(truck_count, 0) AS truck_count, coalesce(person_count, 0) AS person_count
    FROM images i LEFT JOIN counts USING (image_id))"""

ORACLES["global_averages"] = f"""WITH {_FLAT}
SELECT round(avg(object_count), 6) AS avg_objects, round(avg(car_count), 6) AS avg_cars,
    round(avg(truck_count), 6) AS avg_trucks, round(avg(person_count), 6) AS avg_persons
FROM flat"""

ORACLES["scene_rollup"] = f"""WITH {_FLAT}
SELECT weather, timeofday, scene, count(*) AS image_count,
    round(avg(object_count), 6) AS avg_objects, CAST(sum(car_count) AS BIGINT) AS total_cars,
    CAST(sum(truck_count) AS BIGINT) AS total_trucks,
    CAST(sum(person_count) AS BIGINT) AS total_persons
FROM flat GROUP BY ALL"""

ORACLES["business_metrics"] = f"""WITH {_FLAT}
SELECT count(*) AS total_images, round(avg(object_count), 6) AS avg_objects_per_image,
    CAST(sum(car_count) AS BIGINT) AS total_cars_detected,
    CAST(sum(truck_count) AS BIGINT) AS total_trucks_detected,
    CAST(sum(person_count) AS BIGINT) AS total_persons_detected,
    count(DISTINCT weather) AS unique_weather_conditions,
    count(DISTINCT scene) AS unique_scene_types, '1.0' AS dataset_version
FROM flat"""

# silver tables

ORACLES["images_projection"] = """
WITH d AS (
    SELECT *, CASE WHEN o_orderpriority <> '5-LOW' THEN 'v' || o_orderkey END AS video
    FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT DISTINCT
    CASE o_orderstatus WHEN 'O' THEN 'n' || o_orderkey WHEN 'F' THEN 'f' || o_orderkey
        ELSE video || '-' || o_custkey || '.jpg' END AS filename,
    video || '-' || o_custkey AS image_id, video AS video_name, o_custkey AS frame_index,
    CASE WHEN o_orderstatus = 'P' THEN CAST(epoch(o_orderdate) AS BIGINT) END AS timestamp,
    o_orderpriority AS weather, o_orderstatus AS timeofday, c_mktsegment AS scene,
    CAST(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 2 END AS INTEGER) AS total_labels
FROM d"""

ORACLES["images_lineage"] = """
SELECT CASE o_orderstatus WHEN 'O' THEN 'n' || o_orderkey WHEN 'F' THEN 'f' || o_orderkey
        ELSE CASE WHEN o_orderpriority <> '5-LOW' THEN 'v' || o_orderkey END
            || '-' || o_custkey || '.jpg' END AS filename,
    '2025-01-02' AS ingestion_date, '2025-01-02 03:04:05' AS processing_date
FROM orders JOIN customer ON o_custkey = c_custkey"""

ORACLES["labels_geometry"] = """
SELECT CAST(l_partkey AS VARCHAR) AS label_id, l_orderkey || '-' || l_linenumber AS image_id,
    l_linestatus AS category, CAST(l_linenumber AS DOUBLE) AS bbox_x1, l_quantity AS bbox_y1,
    CAST(l_linenumber + l_suppkey AS DOUBLE) AS bbox_x2, l_quantity AS bbox_y2,
    CAST(l_suppkey AS DOUBLE) AS bbox_width, 0.0::DOUBLE AS bbox_height,
    0.0::DOUBLE AS bbox_area, l_linestatus = 'F' AS is_occluded,
    l_quantity > 25 AS is_truncated, nullif(l_returnflag, 'N') AS traffic_light_color
FROM lineitem"""

ORACLES["labels_explode"] = """
WITH lines AS (
    SELECT source || '-' || doc_id AS image_id, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
    FROM documents)
SELECT CAST(i AS VARCHAR) AS label_id, image_id, line AS category, 0.0::DOUBLE AS bbox_x1,
    CAST(i AS DOUBLE) AS bbox_y1, CAST(length(line) AS DOUBLE) AS bbox_x2,
    CAST(i + 1 AS DOUBLE) AS bbox_y2, CAST(length(line) AS DOUBLE) AS bbox_width,
    1.0::DOUBLE AS bbox_height, CAST(length(line) AS DOUBLE) AS bbox_area,
    length(line) > 40 AS is_occluded, i = 0 AS is_truncated,
    CASE WHEN length(line) % 3 <> 0 THEN 'G' END AS traffic_light_color
FROM lines"""

_DOCS = f"""docs AS (
    SELECT o_orderkey AS doc_key, {adapt.DOCUMENT_TEXT} AS value FROM orders),
parsed AS (
    SELECT doc_key, CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS v FROM docs),
rooted AS (
    SELECT doc_key, v, json_type(v) = 'ARRAY' AND json_array_length(v) = 0 AS nothing,
        CASE WHEN json_type(v) = 'ARRAY' THEN json_extract(v, '$[0]') ELSE v END AS r
    FROM parsed),
parts AS (
    SELECT *, json_extract(r, '$.attributes') AS a, json_extract(r, '$.labels') AS l
    FROM rooted)"""

_FIELD = "Missing required field: "
_TOP_CHECKS = ", ".join(
    f"CASE WHEN nothing OR json_extract(r, '$.{k}') IS NULL THEN '{_FIELD}{k}' END"
    for k in ("video_name", "frame_index", "attributes", "labels")
)
_ATTRIBUTE_CHECKS = ", ".join(
    f"CASE WHEN json_type(a) = 'OBJECT' AND json_extract(a, '$.{k}') IS NULL "
    f"THEN 'Missing required attribute: {k}' END"
    for k in ("weather", "timeofday", "scene")
)
_LABEL_CHECKS = " UNION ALL ".join(
    [
        """SELECT doc_key, i, 0 AS k, 'Label ' || i || ' must be an object' AS e
        FROM items WHERE json_type(x) <> 'OBJECT'"""
    ]
    + [
        f"""SELECT doc_key, i, {n}, 'Label ' || i || ' missing required field: {k}'
        FROM items WHERE json_type(x) = 'OBJECT' AND json_extract(x, '$.{k}') IS NULL"""
        for n, k in enumerate(("id", "category", "box2d", "attributes"))
    ]
    + [
        f"""SELECT doc_key, i, {n + 4}, 'Label ' || i || ' box2d missing field: {k}'
        FROM items WHERE json_type(x) = 'OBJECT' AND json_type(x, '$.box2d') = 'OBJECT'
            AND json_extract(x, '$.box2d.{k}') IS NULL"""
        for n, k in enumerate(("x1", "y1", "x2", "y2"))
    ]
)
_CHECKED = f"""{_DOCS},
items AS (
    SELECT doc_key, i, json_extract(l, '$[' || i || ']') AS x
    FROM (SELECT doc_key, l, unnest(range(CAST(json_array_length(l) AS BIGINT))) AS i
        FROM parts WHERE json_type(l) = 'ARRAY')),
label_errors AS (
    SELECT doc_key, string_agg(e, '; ' ORDER BY i, k) AS e FROM ({_LABEL_CHECKS}) GROUP BY doc_key),
checked AS (
    SELECT p.doc_key, CASE WHEN v IS NULL THEN 'Malformed JSON'
        WHEN nothing THEN concat_ws('; ', {_TOP_CHECKS})
        WHEN json_type(r) <> 'OBJECT' THEN 'Document is not an object'
        ELSE concat_ws('; ', {_TOP_CHECKS},
            CASE WHEN json_type(a) <> 'OBJECT' THEN 'Field ''attributes'' must be an object' END,
            {_ATTRIBUTE_CHECKS},
            CASE WHEN json_type(l) <> 'ARRAY' THEN 'Field ''labels'' must be an array' END,
            e.e) END AS errors
    FROM parts p LEFT JOIN label_errors e ON p.doc_key = e.doc_key)"""

ORACLES["validate_documents"] = f"""WITH {_CHECKED}
SELECT doc_key, errors = '' AS is_valid, errors FROM checked"""

ORACLES["validate_summary"] = f"""WITH {_CHECKED}
SELECT errors = '' AS is_valid, count(*) AS n_files FROM checked GROUP BY 1"""

_STRICT = """
WHERE json_type(v) = 'OBJECT' AND json_exists(v, '$.name') AND json_type(a) = 'OBJECT'
    AND json_exists(a, '$.weather') AND json_exists(a, '$.timeofday') AND json_exists(a, '$.scene')
    AND json_type(l) = 'ARRAY' AND json_array_length(l) > 0"""

ORACLES["strict_quality"] = f"WITH {_DOCS} SELECT doc_key FROM parts {_STRICT}"

ORACLES["qualified_images"] = f"""WITH {_DOCS}
SELECT json_extract_string(v, '$.name') AS name,
    doc_key IN (SELECT l_orderkey FROM lineitem) AS is_present
FROM parts {_STRICT}"""

ORACLES["dq_profile"] = f"""WITH {_SCENES}
SELECT 'images' AS table_name, 'n_images' AS "check", count(*) AS n FROM images
UNION ALL SELECT 'images', 'null_image_ids', count(*) - count(image_id) FROM images
UNION ALL SELECT 'images', 'distinct_weather', count(DISTINCT weather) FROM images
UNION ALL SELECT 'images', 'distinct_timeofday', count(DISTINCT timeofday) FROM images
UNION ALL SELECT 'images', 'distinct_scene', count(DISTINCT scene) FROM images
UNION ALL SELECT 'labels', 'n_labels', count(*) FROM objects
UNION ALL SELECT 'labels', 'null_label_ids', count(*) FROM objects WHERE category = 'LARGE'
UNION ALL SELECT 'labels', 'distinct_category', count(DISTINCT category) FROM objects"""

ORACLES["transformation_summary"] = f"""WITH {_SCENES}
SELECT 'images' AS table_name, count(*) AS n_rows, CAST(4 AS BIGINT) AS n_columns FROM images
UNION ALL SELECT 'labels', count(*), 3 FROM objects"""

_ROW_OF = {
    "images": ("image_id", "weather", "timeofday", "scene"),
    "objects": ("label_id", "image_id", "category"),
}


def _sampled(table: str, name: str) -> str:
    columns = _ROW_OF[table]
    parts = " || ',' || ".join(f"'\"{c}\":' || coalesce(CAST(to_json({c}) AS VARCHAR), 'null')" for c in columns)
    return f"""SELECT '{name}' AS table_name, CAST(row_number() OVER (ORDER BY {columns[0]}) AS INTEGER) AS row_no,
    '{{' || {parts} || '}}' AS row FROM (SELECT * FROM {table} ORDER BY {columns[0]} LIMIT 5)"""


ORACLES["summary_sample"] = f"""WITH {_SCENES}
{_sampled("images", "images")} UNION ALL {_sampled("objects", "labels")}"""

# membership


def _pages(source: str, keys: str, size: int) -> str:
    return f"""paged AS (
    SELECT *, CAST(floor((row_number() OVER (PARTITION BY {keys} ORDER BY name) - 1) / {size})
        AS BIGINT) AS page
    FROM {source}),
pages AS (
    SELECT {keys}, page, string_agg(name, ',' ORDER BY name) AS members,
        count(*) AS n_members
    FROM paged GROUP BY {keys}, page)"""


ORACLES["group_members"] = f"""WITH named AS (
    SELECT o_orderpriority || '-' || o_custkey AS name, o_orderpriority AS video_name FROM orders),
{_pages("named", "video_name", 500)}
SELECT * FROM pages"""

ORACLES["name_parts"] = """
WITH n AS (
    SELECT o_orderpriority || CASE WHEN o_orderstatus = 'F' THEN '' ELSE '-' END || o_orderkey AS stem,
        o_orderstatus AS s, o_orderpriority AS p, CAST(o_orderkey AS VARCHAR) AS k
    FROM orders)
SELECT stem || CASE WHEN s = 'O' THEN '.JPG' ELSE '.x' END AS name, stem,
    CASE WHEN s = 'F' THEN split_part(p, '-', 1) ELSE p END AS video_name,
    CASE WHEN s = 'F' THEN split_part(p, '-', 2) || k ELSE k END AS frame_index,
    s = 'O' AS is_image
FROM n"""

ORACLES["scene_members"] = f"""WITH {_SCENES},
named AS (
    SELECT CAST(image_id AS VARCHAR) AS name, weather, timeofday,
        CASE WHEN scene = 'highway' THEN 'unknown' ELSE scene END AS scene
    FROM images),
{_pages("named", "weather, timeofday, scene", 100)}
SELECT * FROM pages"""

ORACLES["image_documents"] = f"""
WITH named AS (
    SELECT o_custkey || '-' || o_orderkey || '.jpg' AS name,
        CAST(o_custkey AS VARCHAR) AS video_name, *,
        EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) AS listed
    FROM orders),
videos AS (
    SELECT video_name, count(*) AS n
    FROM named WHERE listed GROUP BY video_name)
SELECT name, video_name, CASE WHEN listed THEN {adapt.WEATHER} END AS weather,
    CASE WHEN listed THEN o_orderstatus END AS labels,
    coalesce(n, 0) AS video_frame_count
FROM named LEFT JOIN videos USING (video_name)"""

ORACLES["video_frames"] = f"""WITH named AS (
    SELECT o_custkey || '-' || o_orderkey || '.jpg' AS name, CAST(o_custkey AS VARCHAR) AS video_name
    FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)),
{_pages("named", "video_name", 10)}
SELECT * FROM pages"""

# text to silver to gold

_TEXT = f"""{_DOCS},
found AS (
    SELECT doc_key, CAST(0 AS BIGINT) AS position, v AS item,
        CASE WHEN v IS NULL THEN 'Malformed JSON' WHEN json_type(v) = 'ARRAY' THEN 'Empty array'
            WHEN json_type(v) <> 'OBJECT' THEN 'Document is not an object' END AS reason
    FROM parsed WHERE v IS NULL OR json_type(v) <> 'ARRAY' OR json_array_length(v) = 0
    UNION ALL
    SELECT doc_key, p, x, CASE WHEN json_type(x) <> 'OBJECT' THEN 'Document is not an object' END
    FROM (SELECT doc_key, p, json_extract(v, '$[' || p || ']') AS x
        FROM (SELECT doc_key, v, unnest(range(CAST(json_array_length(v) AS BIGINT))) AS p
            FROM parsed WHERE json_type(v) = 'ARRAY'))),
keyed AS (
    SELECT *, item ->> '$.video_name' AS video_name, item ->> '$.frame_index' AS frame_index,
        json_extract(item, '$.labels') AS l FROM found),
whole AS (SELECT *, video_name || '-' || frame_index AS image_id FROM keyed
    WHERE reason IS NULL AND video_name IS NOT NULL AND frame_index IS NOT NULL),
raw_labels AS (
    SELECT doc_key, position, image_id, i, json_extract(l, '$[' || i || ']') AS x
    FROM (SELECT *, unnest(range(CAST(json_array_length(l) AS BIGINT))) AS i
        FROM whole WHERE json_type(l) = 'ARRAY')),
text_labels AS (
    SELECT image_id, x ->> '$.id' AS label_id, x ->> '$.category' AS category,
        TRY_CAST(x ->> '$.box2d.x1' AS DOUBLE) AS x1, TRY_CAST(x ->> '$.box2d.y1' AS DOUBLE) AS y1,
        TRY_CAST(x ->> '$.box2d.x2' AS DOUBLE) AS x2, TRY_CAST(x ->> '$.box2d.y2' AS DOUBLE) AS y2,
        TRY_CAST(x ->> '$.attributes.occluded' AS BOOLEAN) AS is_occluded,
        TRY_CAST(x ->> '$.attributes.truncated' AS BOOLEAN) AS is_truncated,
        nullif(x ->> '$.attributes.trafficLightColor', 'NA') AS traffic_light_color
    FROM raw_labels WHERE json_type(x) = 'OBJECT'),
text_images AS (
    SELECT DISTINCT coalesce(item ->> '$.name', item ->> '$.image_filename', image_id || '.jpg') AS filename,
        image_id, video_name, frame_index, CAST(item ->> '$.timestamp' AS BIGINT) AS timestamp,
        coalesce(item ->> '$.metadata.weather', item ->> '$.attributes.weather') AS weather,
        coalesce(item ->> '$.metadata.timeofday', item ->> '$.attributes.timeofday') AS timeofday,
        coalesce(item ->> '$.metadata.scene', item ->> '$.attributes.scene') AS scene,
        CAST(coalesce((SELECT count(*) FROM raw_labels r WHERE r.doc_key = w.doc_key
            AND r.position = w.position AND json_type(r.x) = 'OBJECT'), 0) AS INTEGER) AS total_labels
    FROM whole w)"""

ORACLES["silver_from_text_images"] = f"WITH {_TEXT} SELECT * FROM text_images"

ORACLES["silver_from_text_labels"] = f"""WITH {_TEXT}
SELECT label_id, image_id, category, x1 AS bbox_x1, y1 AS bbox_y1, x2 AS bbox_x2, y2 AS bbox_y2,
    x2 - x1 AS bbox_width, y2 - y1 AS bbox_height, (x2 - x1) * (y2 - y1) AS bbox_area, is_occluded,
    is_truncated, traffic_light_color
FROM text_labels"""

ORACLES["silver_rejects"] = f"""WITH {_TEXT}
SELECT doc_key, position, CAST(NULL AS BIGINT) AS label, coalesce(reason, 'No image key') AS reason
FROM keyed WHERE reason IS NOT NULL OR video_name IS NULL OR frame_index IS NULL
UNION ALL
SELECT doc_key, position, i, 'Label is not an object' FROM raw_labels WHERE json_type(x) <> 'OBJECT'"""

ORACLES["gold_from_text"] = f"""WITH {_TEXT},
per_image AS (
    SELECT weather, timeofday, scene, mapped_category, image_id, count(*) AS n
    FROM text_labels JOIN text_images USING (image_id)
    JOIN (VALUES ('car', 'vehicle'), ('rider', 'pedestrian')) AS m(category, mapped_category) USING (category)
    GROUP BY ALL)
SELECT weather, timeofday, scene, mapped_category,
    CAST(sum(n) AS BIGINT) AS total_count, count(*) AS total_images,
    round(avg(n), 6) AS avg_count, round(stddev_samp(n), 6) AS std_dev,
    quantile_disc(n, 0.25) AS q1_count, quantile_disc(n, 0.5) AS median_count,
    quantile_disc(n, 0.75) AS q3_count, min(n) AS min_count, max(n) AS max_count
FROM per_image GROUP BY ALL"""

ORACLES["scene_of_documents"] = f"""WITH {_TEXT}
SELECT image_id, coalesce(nullif(item ->> '$.metadata.weather', ''), item ->> '$.attributes.weather') AS weather,
    coalesce(nullif(item ->> '$.metadata.timeofday', ''), item ->> '$.attributes.timeofday') AS timeofday,
    coalesce(nullif(item ->> '$.metadata.scene', ''), item ->> '$.attributes.scene') AS scene
FROM whole"""

# scoring

ORACLES["category_counts"] = f"""WITH {_SCENES}
SELECT image_id, category, count(*) AS n_objects,
    upper(category[1]) || lower(category[2:]) AS shown_as
FROM objects GROUP BY image_id, category"""

_COUNTS = f"""counts AS (
    SELECT image_id, coalesce(m.mapped_category, category) AS mapped_category,
        count(*) AS current_count
    FROM objects LEFT JOIN {_MAPPING} ON category = m.original_category GROUP BY ALL)"""

ORACLES["scene_counts"] = f"WITH {_SCENES}, {_COUNTS} SELECT * FROM counts"

_LEVELS = f"""{_GOLD}, {_COUNTS},
levels AS (
    SELECT image_id, weather, timeofday, scene, mapped_category, current_count,
        avg_count AS historical_avg,
        CASE WHEN current_count < q1_count THEN 'below_normal'
            WHEN current_count > q3_count THEN 'above_normal' ELSE 'normal' END AS level,
        CASE WHEN current_count < q1_count THEN 'below normal (Q1: ' || q1_count || ')'
            WHEN current_count > q3_count THEN 'above normal (Q3: ' || q3_count || ')'
            ELSE 'within normal range' END AS level_description,
        'Q1: ' || q1_count || ', Q3: ' || q3_count AS quartile_range,
        'Min: ' || min_count || ', Max: ' || max_count AS full_range,
        CASE WHEN current_count <= q1_count THEN 'bottom 25%'
            WHEN current_count <= median_count THEN '25th-50th percentile'
            WHEN current_count <= q3_count THEN '50th-75th percentile'
            ELSE 'top 25%' END AS percentile_position
    FROM counts JOIN images USING (image_id)
    JOIN gold USING (weather, timeofday, scene, mapped_category))"""

ORACLES["scene_levels"] = f"WITH {_LEVELS} SELECT * FROM levels"

_HEAVY, _LIGHT = (
    "printf(" + _text(t.replace("%s", "%.1f")) + ", v.current_count, v.historical_avg)"
    for t in (scoring.HEAVY_TRAFFIC, scoring.LIGHT_HIGHWAY)
)
_WEATHER_CASES = "\n".join(
    f"WHEN i.weather = '{k}' THEN {_text(t)}" for k, t in scoring.WEATHER_REMINDERS.items()
)
_TIME_CASES = "\n".join(
    f"WHEN i.timeofday = '{k}' THEN {_text(t)}" for k, t in scoring.TIME_REMINDERS.items()
)
ORACLES["scene_reminder"] = f"""WITH {_LEVELS}
SELECT i.image_id, i.weather, i.timeofday, i.scene, CASE {_WEATHER_CASES}
    WHEN v.level = 'above_normal' THEN {_HEAVY}
    WHEN v.level = 'below_normal' AND i.scene = 'highway' THEN {_LIGHT}
    WHEN p.level = 'above_normal' THEN {_text(scoring.MANY_PEDESTRIANS)}
    {_TIME_CASES}
    ELSE {_text(scoring.DEFAULT_REMINDER)} END AS safety_reminder
FROM images i
LEFT JOIN levels v ON i.image_id = v.image_id AND v.mapped_category = 'vehicle'
LEFT JOIN levels p ON i.image_id = p.image_id AND p.mapped_category = 'pedestrian'"""

ORACLES["prompt_context"] = f"""WITH {_LEVELS},
lines AS (
    SELECT image_id, string_agg(printf('%s: %d detected (historical avg: %.1f, level: %s, '
        || 'percentile: %s)', mapped_category, current_count, historical_avg, level_description,
        percentile_position), chr(10) ORDER BY mapped_category) AS context
    FROM levels GROUP BY image_id),
contexts AS (
    SELECT image_id, weather, timeofday, scene, coalesce(context, '') AS context
    FROM images LEFT JOIN lines USING (image_id))
SELECT *, {_text(chr(10) + scoring.PROMPT_HEAD + chr(10) * 2)} || 'ENVIRONMENT:' || chr(10)
    || '- Weather: ' || weather || chr(10) || '- Time: ' || timeofday || chr(10)
    || '- Scene: ' || scene || chr(10) || chr(10) || 'STATISTICAL ANALYSIS:' || chr(10) || context
    || chr(10) || chr(10) || 'INSTRUCTIONS:' || chr(10) || {_text(scoring.PROMPT_RULES)} || '- '
    || {_text(LANGUAGE_INSTRUCTIONS["Korean"])} || chr(10) || {_text(scoring.PROMPT_TAIL)}
    || chr(10) AS prompt
FROM contexts"""

# boxes

ORACLES["normalise_boxes"] = """
WITH d AS (
    SELECT *, CAST(l_linenumber AS DOUBLE) AS n, l_returnflag = 'R' AS share,
        coalesce(CASE WHEN l_linestatus = 'F' THEN l_discount * 10 END,
            CASE WHEN l_quantity <> 9 THEN l_tax * 10 END, 0) AS used
    FROM lineitem)
SELECT l_orderkey, l_linenumber, l_linestatus AS category, round(used, 6) AS confidence_used,
    round(CASE WHEN share THEN n / 100 * 1280 ELSE n END, 6) AS x1,
    round(CASE WHEN share THEN l_quantity / 64 * 720 ELSE l_quantity END, 6) AS y1,
    round(CASE l_returnflag WHEN 'R' THEN (n + 3) / 100 * 1280 WHEN 'N' THEN n + n + 3
        ELSE n + 3 END, 6) AS x2,
    round(CASE l_returnflag WHEN 'R' THEN (l_quantity + 5) / 64 * 720
        WHEN 'N' THEN l_quantity + l_quantity + 5 ELSE l_quantity + 5 END, 6) AS y2
FROM d WHERE used >= CAST(0.25 AS DOUBLE) AND l_tax <> CAST(0.08 AS DOUBLE) AND l_quantity <> 7"""


def _box_table(spec: dict[str, str]) -> str:
    x, y, w, h = (spec[c] for c in ("x1", "y1", "w", "h"))
    return f"""SELECT o_custkey AS image_id, o_orderkey AS idx, {spec["category"]} AS category,
        CAST({x} AS DOUBLE) AS x1, CAST({y} AS DOUBLE) AS y1,
        CAST(({x}) + ({w}) AS DOUBLE) AS x2, CAST(({y}) + ({h}) AS DOUBLE) AS y2 FROM orders"""


_INTER = "(least(g.x2, p.x2) - greatest(g.x1, p.x1)) * (least(g.y2, p.y2) - greatest(g.y1, p.y1))"
_PAIRS = f"""gt AS ({_box_table(adapt.GT_BOX)}),
pred AS ({_box_table(adapt.PRED_BOX)}),
pairs AS (
    SELECT * FROM (
        SELECT g.image_id, g.idx AS g, p.idx AS p, {_INTER} / ((g.x2 - g.x1) * (g.y2 - g.y1)
            + (p.x2 - p.x1) * (p.y2 - p.y1) - {_INTER}) AS iou
        FROM gt g JOIN pred p ON g.image_id = p.image_id
            AND g.x1 < p.x2 AND p.x1 < g.x2 AND g.y1 < p.y2 AND p.y1 < g.y2)
    WHERE iou >= 0.5)"""

ORACLES["box_pairs"] = f"""WITH {_PAIRS}
SELECT image_id, g, p, round(iou, 6) AS iou FROM pairs"""

_MATCHES = f"""{_PAIRS},
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY iou DESC, g, p) AS n FROM pairs),
walk AS (
    SELECT image_id, n, g, p, iou, true AS kept, [g] AS gs, [p] AS ps FROM ranked WHERE n = 1
    UNION ALL
    SELECT r.image_id, r.n, r.g, r.p, r.iou,
        NOT list_contains(w.gs, r.g) AND NOT list_contains(w.ps, r.p),
        CASE WHEN NOT list_contains(w.gs, r.g) AND NOT list_contains(w.ps, r.p)
            THEN list_append(w.gs, r.g) ELSE w.gs END,
        CASE WHEN NOT list_contains(w.gs, r.g) AND NOT list_contains(w.ps, r.p)
            THEN list_append(w.ps, r.p) ELSE w.ps END
    FROM walk w JOIN ranked r ON r.image_id = w.image_id AND r.n = w.n + 1),
matches AS (
    SELECT w.image_id, w.g, w.p, w.iou, a.category AS gt_category, b.category AS pred_category
    FROM walk w JOIN gt a ON w.g = a.idx JOIN pred b ON w.p = b.idx WHERE kept)"""

ORACLES["greedy_match"] = f"""WITH RECURSIVE {_MATCHES}
SELECT image_id, g, p, round(iou, 6) AS iou, CAST(g AS VARCHAR) AS gt_id,
    CAST(p AS VARCHAR) AS pred_id, gt_category, pred_category FROM matches"""

ORACLES["unmatched"] = f"""WITH RECURSIVE {_MATCHES}
SELECT 'g' AS side, image_id, idx, category FROM gt WHERE idx NOT IN (SELECT g FROM matches)
UNION ALL
SELECT 'p', image_id, idx, category FROM pred WHERE idx NOT IN (SELECT p FROM matches)"""


def _class(column: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EVALUATION_CATEGORIES.items())
    return f"CASE lower({column}) {cases} ELSE lower({column}) END"


_OUTCOMES = f"""{_MATCHES},
raw AS (
    SELECT image_id, iou, gt_category, pred_category FROM matches
    UNION ALL
    SELECT image_id, NULL, category, NULL FROM gt WHERE idx NOT IN (SELECT g FROM matches)
    UNION ALL
    SELECT image_id, NULL, NULL, category FROM pred WHERE idx NOT IN (SELECT p FROM matches)),
outcomes AS (
    SELECT *, {_class("gt_category")} AS gc, {_class("pred_category")} AS pc FROM raw)"""


def _scored(select: str, keys: str) -> str:
    """Adds precision, recall and f1 to tp, fp and fn."""
    return f"""{_OUTCOMES},
c AS ({select}),
s AS (
    SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS pr,
        CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS re FROM c),
scored AS (
    SELECT {keys}, tp, fp, fn, round(pr, 6) AS precision, round(re, 6) AS recall,
        round(CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END, 6) AS f1, pr FROM s)"""


ORACLES["image_metrics"] = f"""WITH RECURSIVE {_scored('''
    SELECT image_id, count(*) FILTER (gc = pc) AS tp,
        count(*) FILTER (box AND (gc IS NULL OR gc <> pc)) AS fp,
        count(*) FILTER (box AND pc IS NULL) AS fn, count(gc) AS total_gt, count(pc) AS total_pred
    FROM (SELECT image_id, gc, pc, true AS box FROM outcomes
        UNION ALL SELECT c_custkey, NULL, NULL, false FROM customer)
    GROUP BY image_id''', "image_id, total_gt, total_pred")}
SELECT * EXCLUDE (pr) FROM scored"""

_SWEEP = _scored(
    """
    SELECT k / 20 AS iou_threshold, count(*) FILTER (gc = pc AND iou >= k / 20) AS tp,
        count(*) FILTER (gc IS NULL OR (gc <> pc AND iou >= k / 20)) AS fp,
        count(*) FILTER (pc IS NULL OR iou < k / 20) AS fn
    FROM outcomes CROSS JOIN (SELECT unnest(range(10, 20)) AS k) GROUP BY k""",
    "iou_threshold",
)

ORACLES["threshold_sweep"] = f"WITH RECURSIVE {_SWEEP} SELECT * EXCLUDE (pr) FROM scored"

ORACLES["evaluation_summary"] = f"""WITH RECURSIVE {_SWEEP}
SELECT (SELECT count(*) FROM customer) AS total_images,
    (SELECT count(gc) FROM outcomes) AS total_gt_objects,
    (SELECT count(pc) FROM outcomes) AS total_pred_objects,
    (SELECT count(*) FROM outcomes WHERE gc = pc) AS true_positives,
    (SELECT count(*) FROM outcomes WHERE gc IS NULL OR gc <> pc) AS false_positives,
    (SELECT count(*) FROM outcomes WHERE pc IS NULL OR gc <> pc) AS false_negatives,
    max(precision) FILTER (iou_threshold = 0.5) AS precision_at_50,
    max(recall) FILTER (iou_threshold = 0.5) AS recall_at_50,
    max(f1) FILTER (iou_threshold = 0.5) AS f1_at_50,
    round(avg(pr), 6) AS mean_precision_50_95
FROM scored"""

ORACLES["class_metrics"] = f"""WITH RECURSIVE {_scored('''
    SELECT category, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp,
        CAST(sum(fn) AS BIGINT) AS fn
    FROM (
        SELECT gc AS category, 1 AS tp, 0 AS fp, 0 AS fn FROM outcomes WHERE gc = pc
        UNION ALL SELECT pc, 0, 1, 0 FROM outcomes WHERE gc <> pc OR gc IS NULL
        UNION ALL SELECT gc, 0, 0, 1 FROM outcomes WHERE gc <> pc OR pc IS NULL)
    GROUP BY category''', "category")}
SELECT * EXCLUDE (pr) FROM scored"""

ORACLES["confusion"] = f"""WITH RECURSIVE {_OUTCOMES}
SELECT lower(gt_category) AS gt_category,
    coalesce(lower(pred_category), 'unmatched') AS predicted_as, count(*) AS n
FROM outcomes WHERE gt_category IS NOT NULL GROUP BY 1, 2"""

ORACLES["original_category_metrics"] = f"""WITH RECURSIVE {_OUTCOMES},
c AS (
    SELECT lower(gt_category) AS category, count(*) AS ground_truth_count,
        count(*) FILTER (lower(gt_category) = lower(pred_category)) AS correct_predictions,
        count(pred_category) AS total_matched, count(*) - count(pred_category) AS unmatched
    FROM outcomes WHERE gt_category IS NOT NULL GROUP BY 1),
s AS (
    SELECT *, (SELECT count(*) FROM outcomes o WHERE lower(o.pred_category) = c.category)
        AS total_times_predicted
    FROM c),
r AS (
    SELECT *, CASE WHEN total_times_predicted > 0 THEN correct_predictions / total_times_predicted
        ELSE 0 END AS pr, correct_predictions / ground_truth_count AS re FROM s)
SELECT * EXCLUDE (pr, re), round(pr, 6) AS precision, round(re, 6) AS recall,
    round(CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END, 6) AS f1 FROM r"""

_TRUTH = """truth AS (
    SELECT doc_id AS name, 'Q' || quality AS weather, 'T' || toxic AS timeofday,
        CASE WHEN quality + toxic <> 1 THEN 'S' END AS scene FROM labels),
generated AS (
    SELECT doc_id AS name, CASE WHEN n_chars > 1000 THEN 'q1' ELSE 'Q0' END AS weather,
        CASE WHEN lang = 'en' THEN 't0' END AS timeofday, 'S' AS scene FROM documents)"""
_COMPARED = _TRUTH + ", compared AS (" + " UNION ALL ".join(
    f"""SELECT name, '{a}' AS attribute, lower(t.{a}) = lower(coalesce(g.{a}, '')) AS is_match
    FROM truth t JOIN generated g USING (name) WHERE t.{a} IS NOT NULL"""
    for a in ("weather", "timeofday", "scene")
) + ")"

ORACLES["attribute_accuracy"] = f"""WITH {_COMPARED}
SELECT coalesce(attribute, 'overall') AS attribute, count(*) FILTER (is_match) AS n_match,
    count(*) AS n_compared, round(count(*) FILTER (is_match) / count(*), 6) AS accuracy
FROM compared GROUP BY ROLLUP (attribute)"""

ORACLES["image_attribute_accuracy"] = f"""WITH {_COMPARED}
SELECT name, round(coalesce(count(*) FILTER (is_match) / count(is_match), 1), 6) AS accuracy
FROM truth LEFT JOIN compared USING (name) GROUP BY name"""

ORACLES["evaluated_files"] = """
SELECT c_custkey AS name, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
    THEN 'evaluated' ELSE 'failed' END AS status
FROM customer"""

ORACLES["overlay_rows"] = f"""WITH {_PAIRS}
SELECT image_id, 'ground_truth' AS source, CAST(0 AS INTEGER) AS layer, idx,
    CAST(idx AS VARCHAR) AS label_id, category, x1, y1, x2, y2 FROM gt
UNION ALL
SELECT image_id, 'generated', 1, idx, CAST(idx AS VARCHAR), category, x1, y1, x2, y2 FROM pred"""

ORACLES["overlay_attributes"] = f"WITH {_TRUTH} " + " UNION ALL ".join(
    f"""SELECT g.name, CAST({i} AS INTEGER) AS line_no,
        '{a.capitalize()}: GT=' || coalesce(t.{a}, 'N/A') || ' | GEN='
            || coalesce(g.{a}, 'unknown') AS line,
        coalesce(t.{a}, 'N/A') = coalesce(g.{a}, 'unknown') AND t.{a} IS NOT NULL AS is_match
    FROM generated g LEFT JOIN truth t USING (name)"""
    for i, a in enumerate(("weather", "timeofday", "scene"))
)

# retrieval

ORACLES["chunks"] = """
WITH d AS (
    SELECT source || '-' || doc_id AS city, text,
        unnest(range(CAST(ceil(length(text) / 1500) AS BIGINT))) AS i
    FROM documents)
SELECT sha256(city || ' Brochure.pdf' || chr(1) || i) AS id, city,
    city || ' Brochure.pdf' AS filename, CAST(i AS INTEGER) AS chunk_no,
    substring(text, i * 1500 + 1, 1500) AS content
FROM d"""

ORACLES["corpus"] = """
WITH d AS (
    SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents)
SELECT 'doc_' || i AS id, text AS content, source,
    CAST(len(embedding) AS BIGINT) AS n_dims
FROM d JOIN embeddings ON doc_id = vec_id"""

ORACLES["head_documents"] = "SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 100"

_HITS = """means AS (
    SELECT label, pos, avg(CAST(v AS DOUBLE)) AS v
    FROM (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS pos
        FROM embeddings) GROUP BY label, pos),
centroids AS (
    SELECT CAST(label AS BIGINT) AS query_id, list(v ORDER BY pos) AS q FROM means GROUP BY label),
hits AS (
    SELECT query_id, vec_id AS id,
        round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), q), 9) AS s
    FROM corpus CROSS JOIN centroids),
ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS INTEGER)
        AS rank, id, round(s, 6) AS score FROM hits)"""

ORACLES["vector_topk"] = f"""WITH corpus AS (SELECT * FROM embeddings), {_HITS}
SELECT * FROM ranked WHERE rank <= 5"""

ORACLES["filtered_topk"] = f"""WITH corpus AS (
    SELECT * FROM embeddings WHERE vec_id IN (SELECT doc_id FROM documents WHERE lang = 'en')),
{_HITS}
SELECT * FROM ranked WHERE rank <= 3"""

ORACLES["graph_recall"] = """SELECT CAST(least(10, count(*)) * count(*) FILTER (vec_id % 20 = 0) AS BIGINT)
    AS n_hits, TRUE AS reached FROM embeddings"""

# What BM25 needs, from the texts; the query's hits are ranked in ``by_word``.
_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
_BY_WORD = f"""tf AS (
    SELECT id, term, count(*) AS tf
    FROM (SELECT doc_id AS id, unnest({_WORDS}) AS term FROM documents) GROUP BY id, term),
lengths AS (SELECT id, sum(tf) AS len FROM tf GROUP BY id),
whole AS (SELECT count(*) AS n, avg(len) AS mean FROM lengths),
rarity AS (
    SELECT term, ln(1 + (n - count(*) + 0.5) / (count(*) + 0.5)) AS idf
    FROM tf CROSS JOIN whole GROUP BY term, n),
asked AS (
    SELECT query_id, term, count(*) AS times
    FROM (SELECT item_id AS query_id, unnest({_WORDS}) AS term FROM benchmark) GROUP BY query_id, term),
scores AS (
    SELECT query_id, id, round(sum(times * idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean))), 9) AS s
    FROM asked JOIN rarity USING (term) JOIN tf USING (term) JOIN lengths USING (id) CROSS JOIN whole
    GROUP BY query_id, id),
by_word AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS INTEGER)
        AS rank, id, s FROM scores)"""

ORACLES["keyword_topk"] = f"""WITH {_BY_WORD}
SELECT query_id, rank, id, round(s, 6) AS score FROM by_word WHERE rank <= 10"""

ORACLES["hybrid_topk"] = f"""WITH {_BY_WORD},
cosines AS (
    SELECT q.vec_id AS query_id, e.vec_id AS id,
        round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 9) AS s
    FROM embeddings q JOIN benchmark ON q.vec_id = item_id CROSS JOIN embeddings e),
by_vector AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank, id FROM cosines),
lists AS (
    SELECT query_id, id, rank FROM by_word WHERE rank <= 20
    UNION ALL SELECT query_id, id, rank FROM by_vector WHERE rank <= 20),
both_lists AS (SELECT query_id, id, round(sum(1 / (60 + rank)), 9) AS s FROM lists GROUP BY query_id, id),
placed AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS INTEGER)
        AS rank, id, round(s, 6) AS score FROM both_lists)
SELECT * FROM placed WHERE rank <= 10"""

ORACLES["context"] = f"""WITH corpus AS (SELECT * FROM embeddings), {_HITS}
SELECT query_id, {_text(CONTEXT_HEAD)}
    || string_agg('Source: ' || source || ' => ' || text, chr(10) ORDER BY rank)
    || {_text(CONTEXT_TAIL)} AS system_text
FROM ranked JOIN documents ON id = doc_id WHERE rank <= 3 GROUP BY query_id"""

ORACLES["reply_parse"] = f"""WITH r AS (
    SELECT event_id, {adapt.REPLY_TEXT} AS reply FROM events),
t AS (
    SELECT event_id, CASE WHEN contains(reply, '```json')
        THEN regexp_extract(reply, '```json(.*?)```', 1, 's')
        WHEN contains(reply, '{{') AND contains(reply, '}}')
        THEN regexp_extract(reply, '\\{{.*\\}}', 0, 's') ELSE reply END AS body FROM r),
j AS (
    SELECT event_id, CASE WHEN json_valid(body) THEN CAST(body AS JSON) END AS v FROM t),
f AS (
    SELECT event_id, coalesce(json_extract(v, '$.attributes'), v) AS v FROM j)
SELECT event_id, coalesce(json_extract_string(v, '$.weather'), 'unknown') AS weather,
    coalesce(json_extract_string(v, '$.timeofday'), 'unknown') AS timeofday,
    coalesce(json_extract_string(v, '$.scene'), 'unknown') AS scene
FROM f"""

ORACLES["transcript"] = """
SELECT conv_id, CAST(floor(turn / 4) AS BIGINT) AS part, count(*) AS n_turns,
    string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS transcript
FROM conversations WHERE role IN ('user', 'assistant') GROUP BY 1, 2"""

ORACLES["last_assistant"] = """
SELECT conv_id, max(turn) AS turn, arg_max(text, turn) AS text
FROM conversations WHERE role = 'assistant' GROUP BY conv_id"""

# work lists


def _file_name(key: str) -> str:
    return f"""'p' || {key} || CASE {key} % 4 WHEN 0 THEN '.JPG' WHEN 1 THEN '.tar.png'
        WHEN 2 THEN '.html' ELSE '' END"""


ORACLES["worklist"] = f"""
SELECT {_file_name("page_id")} AS filename FROM pages
WHERE page_id % 4 IN (0, 1) AND page_id NOT IN (SELECT doc_id FROM labels)"""

ORACLES["kept_semi"] = """
SELECT 'd' || doc_id || '_label.json' AS label_file, 'd' || doc_id || '.jpg' AS filename
FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)"""

ORACLES["missing_anti"] = """
SELECT doc_id AS name, doc_id IN (SELECT doc_id FROM labels) AS copied FROM documents"""

# runs

_EVENTS = "ev AS (SELECT event_id, ts, " + ", ".join(
    f"{e} AS {c}" for c, e in adapt.RUN_EVENT.items()
) + " FROM events)"

ORACLES["run_status"] = f"""WITH {_EVENTS},
last AS (
    SELECT DISTINCT ON (run_id, step) run_id, step, status FROM ev
    ORDER BY run_id, step, ts DESC, event_id DESC),
st AS (
    SELECT run_id, count(step) AS n_steps, count(*) FILTER (step IS NOT NULL
        AND status = 'failed') AS bad, count(*) FILTER (step IS NOT NULL
        AND status IN ('completed', 'skipped')) AS good
    FROM last GROUP BY run_id)
SELECT run_id, CASE WHEN n_steps = 0 THEN 'initialized' WHEN bad > 0 THEN 'failed'
    WHEN good = n_steps THEN 'completed' ELSE 'in_progress' END AS status,
    min(ts) AS created_at, max(ts) AS updated_at, n_steps
FROM st JOIN ev USING (run_id) GROUP BY ALL"""

ORACLES["run_progress"] = f"""WITH {_EVENTS},
totals AS (
    SELECT run_id, step, arg_max(status, (ts, event_id)) AS status, sum(processed) AS sp,
        sum(failed) AS sf, arg_max(processed, (ts, event_id)) FILTER (processed IS NOT NULL) AS lp,
        arg_max(failed, (ts, event_id)) FILTER (processed IS NOT NULL) AS lf
    FROM ev WHERE step IS NOT NULL GROUP BY run_id, step),
p AS (
    SELECT run_id, step, status,
        CAST(coalesce(CASE WHEN step = 'evaluate' THEN lp ELSE sp END, 0) AS BIGINT) AS processed,
        CAST(coalesce(CASE WHEN step = 'evaluate' THEN lf ELSE sf END, 0) AS BIGINT) AS failed
    FROM totals)
SELECT run_id, step, status, processed + failed AS total, processed, failed,
    round(processed / greatest(processed + failed, 1) * 100, 6) AS percentage
FROM p"""

ORACLES["run_errors"] = f"""WITH {_EVENTS}, e AS (
    SELECT run_id, CAST(row_number() OVER (PARTITION BY run_id ORDER BY ts DESC, event_id DESC)
        AS INTEGER) AS error_no, coalesce(step, 'unknown') AS step, error
    FROM ev WHERE error IS NOT NULL)
SELECT * FROM e WHERE error_no <= 3"""

ORACLES["job_outcomes"] = """
SELECT event_type, count(*) AS total, count(*) FILTER (value > 10) AS succeeded,
    count(*) FILTER (NOT value > 10) AS failed, round(sum(value), 6) AS seconds,
    round(count(*) FILTER (value > 10) / count(*), 6) AS success_rate,
    round(count(*) / sum(value), 6) AS per_second
FROM events GROUP BY event_type"""

ORACLES["upsert"] = """
WITH both_sides AS (
    SELECT doc_id AS id, lang, source, n_chars AS version, 0 AS n FROM documents
    UNION ALL
    SELECT doc_id * 2, 'xx', 'q' || quality, toxic * 100000 + 1000, 1 FROM labels),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC, n DESC) AS r
    FROM both_sides)
SELECT id, lang, source, CAST(version AS BIGINT) AS version FROM ranked WHERE r = 1"""

ORACLES["upsert_in_buckets"] = ORACLES["upsert"]

_ATTEMPTS = f"""tries AS (SELECT event_id, {adapt.ATTEMPT_OK} AS ok FROM events),
counted AS (SELECT *, sum(CAST(ok AS INTEGER)) OVER (ORDER BY event_id) AS done FROM tries),
numbered AS (
    SELECT event_id, ok, CASE WHEN ok THEN 0 ELSE CAST(sum(1 - CAST(ok AS INTEGER)) OVER (
            PARTITION BY done ORDER BY event_id) AS BIGINT) END AS consecutive,
        CAST(done - CAST(ok AS INTEGER) AS BIGINT) AS succeeded_before
    FROM counted)"""

ORACLES["consecutive_failures"] = f"WITH {_ATTEMPTS} SELECT * FROM numbered"

ORACLES["limited_successes"] = f"""WITH {_ATTEMPTS}
SELECT *, FALSE AS warns FROM numbered WHERE succeeded_before < 500"""

ORACLES["failure_stop"] = f"""WITH {_ATTEMPTS},
stop AS (SELECT min(event_id) AS last FROM numbered WHERE consecutive = 6)
SELECT n.*, consecutive = 6 AS warns FROM numbered n CROSS JOIN stop
WHERE last IS NULL OR event_id <= last"""

ORACLES["sketch_profile"] = """SELECT since, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_customers,
    TRUE AS near, TRUE AS ranked
FROM orders JOIN (VALUES (CAST(1995 AS BIGINT)), (1998), (2000)) y(since) ON year(o_orderdate) >= since
GROUP BY since"""
