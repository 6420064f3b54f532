"""Every operator run over the driver tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialens.functions.text import file_stem, frame_of, is_image_name, reply_attributes, video_of
from vialens.operators import annotate, attempts, documents, evaluation, gold, graph, keyword, matching
from vialens.operators import quality, retrieval, runs, scoring, sketches, transform, validate
from vialens.operators.scale import new_folder, settle
from vialens.plans import adapt, medallion
from vialens.sources.writers import upsert_buckets, upserted, write_buckets, write_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DIGITS = 6


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, DIGITS) for c in columns})


# statistics table


def _gold(spark, d):
    return gold.attribute_distribution(
        adapt.scene_labels(spark, d), adapt.scene_images(spark, d), adapt.mapping(spark), DIGITS
    )


@query
def category_distribution(spark, d):
    return _gold(spark, d)


@query
def gold_incremental(spark, d):
    """The statistics after a late, a replaced and a removed date, from counts by date.

    An image's date is its order's year. The first state lacks one year, has
    half of another's labels, and holds a year that is gone since.
    """
    images, labels = adapt.dated_images(spark, d), adapt.dated_labels(spark, d)
    late, replaced, gone = "1996-01-01", "1998-01-01", "1990-01-01"
    day = F.col("ingestion_date")
    first_images, first_labels = images.where(day != F.lit(late)), labels.where(day != F.lit(late))
    first_labels = first_labels.where((day != F.lit(replaced)) | (F.crc32("label_id") % 2 == 0))
    of_gone = F.lit(gone).cast("date").alias("ingestion_date")
    first_images = first_images.unionByName(images.where(day == F.lit(replaced)).withColumn("ingestion_date", of_gone))
    first_labels = first_labels.unionByName(labels.where(day == F.lit(replaced)).withColumn("ingestion_date", of_gone))
    mapping, path = adapt.mapping(spark), new_folder(spark)
    state = gold.count_state(first_labels, first_images, mapping, "ingestion_date")
    write_table(state, path)
    medallion.update_states(labels, images, mapping, path, [late, replaced, gone])
    return gold.distribution_of(gold.merged_states(spark.read.parquet(path)), DIGITS)


@query
def object_context(spark, d):
    return gold.object_context(
        adapt.scene_labels(spark, d), adapt.scene_images(spark, d), adapt.mapping(spark)
    )


@query
def distinct_values(spark, d):
    return gold.distinct_values(adapt.scene_images(spark, d), "timeofday")


@query
def value_distribution(spark, d):
    return gold.value_distribution(adapt.scene_images(spark, d), "weather")


@query
def global_averages(spark, d):
    out = gold.global_averages(adapt.scene_table(spark, d))
    return _rounded(out, *out.columns)


@query
def scene_rollup(spark, d):
    out = gold.scene_rollup(adapt.scene_table(spark, d)).drop("processing_date")
    return _rounded(out, "avg_objects")


@query
def business_metrics(spark, d):
    out = gold.business_metrics(adapt.scene_table(spark, d)).drop("analysis_date")
    return _rounded(out, "avg_objects_per_image")


# silver tables


@query
def images_projection(spark, d):
    out = transform.images_table(adapt.label_documents(spark, d))
    return out.drop("ingestion_date", "processing_date")


@query
def images_lineage(spark, d):
    """The lineage columns of a given day and time."""
    day, time = F.lit("2025-01-02").cast("date"), F.lit("2025-01-02 03:04:05").cast("timestamp")
    out = transform.images_table(adapt.label_documents(spark, d), day, time)
    return out.select(
        "filename", *[F.col(c).cast("string").alias(c) for c in ("ingestion_date", "processing_date")]
    )


@query
def labels_geometry(spark, d):
    out = transform.labels_table(adapt.item_documents(spark, d))
    return out.drop("ingestion_date", "processing_date")


@query
def labels_explode(spark, d):
    out = transform.labels_table(adapt.line_documents(spark, d))
    return out.drop("ingestion_date", "processing_date")


@query
def validate_documents(spark, d):
    return validate.validated(adapt.document_texts(spark, d)).select(
        "doc_key", "is_valid", "errors"
    )


@query
def validate_summary(spark, d):
    return validate.validation_summary(validate.validated(adapt.document_texts(spark, d)))


@query
def strict_quality(spark, d):
    return validate.strictly_qualified(adapt.document_texts(spark, d)).select("doc_key")


def _silver(spark, d):
    images = adapt.scene_images(spark, d)
    labels = adapt.scene_labels(spark, d).withColumn(
        "label_id", F.when(F.col("category") != "LARGE", F.col("label_id"))
    )
    return images, labels


@query
def dq_profile(spark, d):
    return quality.quality_profile(*_silver(spark, d))


@query
def transformation_summary(spark, d):
    return quality.transformation_summary(*_silver(spark, d)).select(
        "table_name", "n_rows", "n_columns"
    )


@query
def summary_sample(spark, d):
    images, labels = adapt.scene_images(spark, d), adapt.scene_labels(spark, d)
    return quality.sample_rows({"images": (images, ["image_id"]), "labels": (labels, ["label_id"])})


# membership


def _frames(spark, d):
    orders, lineitem = adapt.table(spark, d, "orders"), adapt.table(spark, d, "lineitem")
    with_items = orders.join(
        lineitem.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi"
    )
    return with_items.select(
        F.expr("CAST(o_custkey AS STRING) || '-' || CAST(o_orderkey AS STRING) || '.jpg'").alias(
            "name"
        ),
        F.struct(F.expr(adapt.WEATHER).alias("weather")).alias("attributes"),
        F.array("o_orderstatus").alias("labels"),
    )


@query
def group_members(spark, d):
    named = adapt.table(spark, d, "orders").select(
        F.concat_ws("-", "o_orderpriority", F.col("o_custkey").cast("string")).alias("name")
    )
    pages = gold.video_members(named, page_size=500)
    return pages.withColumn("members", F.array_join("members", ","))


@query
def name_parts(spark, d):
    names = adapt.table(spark, d, "orders").select(
        F.expr(
            "o_orderpriority || CASE WHEN o_orderstatus = 'F' THEN '' ELSE '-' END"
            " || CAST(o_orderkey AS STRING) || CASE WHEN o_orderstatus = 'O' THEN '.JPG' ELSE '.x' END"
        ).alias("name")
    )
    name = F.col("name")
    return names.select(
        "name",
        file_stem(name).alias("stem"),
        video_of(name).alias("video_name"),
        frame_of(name).alias("frame_index"),
        is_image_name(name).alias("is_image"),
    )


@query
def scene_members(spark, d):
    frames = adapt.scene_images(spark, d).select(
        F.col("image_id").cast("string").alias("name"),
        F.struct(
            "weather",
            "timeofday",
            F.when(F.col("scene") != "highway", F.col("scene")).alias("scene"),
        ).alias("attributes"),
    )
    return gold.scene_members(frames, page_size=100).withColumn(
        "members", F.array_join("members", ",")
    )


@query
def image_documents(spark, d):
    images = adapt.table(spark, d, "orders").select(
        F.expr("CAST(o_custkey AS STRING) || '-' || CAST(o_orderkey AS STRING) || '.jpg'").alias(
            "name"
        )
    )
    frames = _frames(spark, d)
    members = settle(gold.video_members(frames, page_size=10))
    return gold.per_image_documents(images, frames, members).select(
        "name",
        "video_name",
        F.col("attributes.weather").alias("weather"),
        F.array_join("labels", ",").alias("labels"),
        F.col("video_frame_count").cast("bigint").alias("video_frame_count"),
    )


@query
def video_frames(spark, d):
    pages = gold.video_members(_frames(spark, d), page_size=10)
    return pages.withColumn("members", F.array_join("members", ","))


# text to silver to gold


def _items(spark, d):
    return documents.items(adapt.document_texts(spark, d))


def _text_documents(spark, d):
    whole = documents.label_documents(_items(spark, d))
    return whole.where("video_name IS NOT NULL AND frame_index IS NOT NULL")


@query
def silver_from_text_images(spark, d):
    out = transform.images_table(_text_documents(spark, d))
    return out.drop("ingestion_date", "processing_date")


@query
def silver_from_text_labels(spark, d):
    out = transform.labels_table(_text_documents(spark, d))
    return out.drop("ingestion_date", "processing_date")


@query
def silver_rejects(spark, d):
    return documents.rejects(_items(spark, d)).select(
        "doc_key", *[F.col(c).cast("bigint").alias(c) for c in ("position", "label")], "reason"
    )


@query
def gold_from_text(spark, d):
    whole = settle(_text_documents(spark, d))
    return gold.attribute_distribution(
        transform.labels_table(whole),
        transform.images_table(whole),
        transform.category_mapping(spark),
        DIGITS,
    )


@query
def scene_of_documents(spark, d):
    return scoring.scene_attributes(_text_documents(spark, d))


# scoring


@query
def category_counts(spark, d):
    return scoring.category_counts(adapt.scene_labels(spark, d))


@query
def scene_counts(spark, d):
    return scoring.scene_counts(adapt.scene_labels(spark, d), adapt.mapping(spark))


def _scored(spark, d):
    baseline = settle(_gold(spark, d))
    return adapt.scene_images(spark, d), scene_counts(spark, d), baseline


@query
def scene_levels(spark, d):
    return scoring.scene_comparison(*_scored(spark, d))


@query
def scene_reminder(spark, d):
    return scoring.scene_reminders(*_scored(spark, d))


@query
def prompt_context(spark, d):
    return scoring.prompt_contexts(*_scored(spark, d), language="Korean")


# boxes


@query
def normalise_boxes(spark, d):
    quantity, line = F.col("l_quantity"), F.col("l_linenumber").cast("double")
    share = F.col("l_returnflag") == "R"
    detections = adapt.table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_quantity") != 7, F.col("l_linestatus")).alias("category"),
        F.expr(
            "CASE l_returnflag WHEN 'A' THEN 'corners' WHEN 'N' THEN 'xywh' ELSE 'normalised' END"
        ).alias("format"),
        F.when(share, line / 100).otherwise(line).alias("a"),
        F.when(share, quantity / 64).otherwise(quantity).alias("b"),
        F.when(share, (line + 3) / 100).otherwise(line + 3).alias("c"),
        F.when(
            F.col("l_tax") != 0.08, F.when(share, (quantity + 5) / 64).otherwise(quantity + 5)
        ).alias("d"),
        F.when(F.col("l_linestatus") == "F", F.col("l_discount") * 10).alias("score"),
        F.when(F.col("l_quantity") != 9, F.col("l_tax") * 10).alias("confidence"),
        F.lit(1280).alias("img_width"),
        F.lit(720).alias("img_height"),
    )
    return _rounded(
        transform.detected_boxes(detections, 0.25), "x1", "y1", "x2", "y2", "confidence_used"
    )


def _boxes(spark, d):
    return adapt.boxes(spark, d, adapt.GT_BOX), adapt.boxes(spark, d, adapt.PRED_BOX)


@query
def box_pairs(spark, d):
    return _rounded(matching.box_pairs(*_boxes(spark, d)), "iou")


@query
def greedy_match(spark, d):
    return _rounded(matching.greedy_match(*_boxes(spark, d)), "iou")


@query
def unmatched(spark, d):
    gt, pred = _boxes(spark, d)
    matches = settle(matching.greedy_match(gt, pred))
    sides = [
        matching.unmatched(boxes, matches, side).select(
            F.lit(side).alias("side"), "image_id", "idx", "category"
        )
        for boxes, side in ((gt, "g"), (pred, "p"))
    ]
    return sides[0].unionByName(sides[1])


def _outcomes(spark, d):
    gt, pred = _boxes(spark, d)
    return settle(evaluation.outcomes(gt, pred, settle(matching.greedy_match(gt, pred))))


def _evaluated(spark, d):
    """An image per customer, also those without a box."""
    return adapt.table(spark, d, "customer").select(F.col("c_custkey").alias("image_id"))


def _scores(df):
    return _rounded(df, "precision", "recall", "f1")


@query
def image_metrics(spark, d):
    return _scores(evaluation.image_metrics(_outcomes(spark, d), _evaluated(spark, d)))


@query
def threshold_sweep(spark, d):
    return _scores(evaluation.threshold_sweep(_outcomes(spark, d)))


@query
def evaluation_summary(spark, d):
    out = evaluation.evaluation_summary(_outcomes(spark, d), _evaluated(spark, d))
    return _rounded(out, "precision_at_50", "recall_at_50", "f1_at_50", "mean_precision_50_95")


@query
def class_metrics(spark, d):
    return _scores(evaluation.class_metrics(_outcomes(spark, d)))


@query
def confusion(spark, d):
    return evaluation.category_confusion(_outcomes(spark, d))


@query
def original_category_metrics(spark, d):
    return _scores(evaluation.original_category_metrics(_outcomes(spark, d)))


def _compared(spark, d):
    return evaluation.attribute_comparison(
        adapt.true_attributes(spark, d), adapt.generated_attributes(spark, d)
    )


@query
def attribute_accuracy(spark, d):
    return _rounded(evaluation.attribute_accuracy(_compared(spark, d)), "accuracy")


@query
def image_attribute_accuracy(spark, d):
    names = adapt.true_attributes(spark, d).select("name")
    return _rounded(
        evaluation.image_attribute_accuracy(names, _compared(spark, d)), "accuracy"
    )


@query
def evaluated_files(spark, d):
    truth = adapt.table(spark, d, "orders").select(F.col("o_custkey").alias("name"))
    predicted = adapt.table(spark, d, "customer").select(F.col("c_custkey").alias("name"))
    return evaluation.evaluated_files(truth, predicted)


@query
def overlay_rows(spark, d):
    return evaluation.overlay_rows(*_boxes(spark, d))


@query
def overlay_attributes(spark, d):
    return evaluation.overlay_attributes(
        adapt.true_attributes(spark, d), adapt.generated_attributes(spark, d)
    )


# retrieval


@query
def chunks(spark, d):
    documents = adapt.table(spark, d, "documents").select(
        F.expr("source || '-' || CAST(doc_id AS STRING) || ' Brochure.pdf'").alias("filename"),
        "text",
    )
    return retrieval.chunk_table(documents)


def _corpus(spark, d):
    documents = retrieval.shaped_documents(
        adapt.table(spark, d, "documents"), "doc_id", F.col("source")
    )
    embeddings = adapt.table(spark, d, "embeddings").withColumnRenamed("vec_id", "doc_id")
    return retrieval.with_embeddings(documents, embeddings, "doc_id")


@query
def corpus(spark, d):
    return _corpus(spark, d).select(
        "id", "content", "source", F.size("embedding").cast("bigint").alias("n_dims")
    )


@query
def head_documents(spark, d):
    """The first 100 documents: a limit is what this operator is."""
    return transform.head_rows(
        adapt.table(spark, d, "documents").select("doc_id", "source"), ["doc_id"], 100
    )


@query
def vector_topk(spark, d):
    hits = retrieval.top_k(adapt.label_centroids(spark, d), adapt.vectors(spark, d), k=5)
    return _rounded(hits, "score")


@query
def filtered_topk(spark, d):
    english = adapt.table(spark, d, "documents").where(F.col("lang") == "en")
    wanted = adapt.vectors(spark, d).join(english.select(F.col("doc_id").alias("id")), "id")
    return _rounded(retrieval.top_k(adapt.label_centroids(spark, d), wanted, k=3), "score")


def _graph_hits(spark, d):
    vectors = adapt.vectors(spark, d)
    queries = vectors.where(F.col("id") % 20 == 0).withColumnRenamed("id", "query_id")
    return vectors, queries, graph.graph_top_k(graph.build_graph(vectors, new_folder(spark)), queries, k=10)


@query
def graph_topk(spark, d):
    """Every twentieth vector against all, by the graph; approximate, so there is no SQL."""
    return _rounded(_graph_hits(spark, d)[-1], "score")


@query
def graph_recall(spark, d):
    """Whether the graph finds 95 of 100 exact hits."""
    vectors, queries, hits = _graph_hits(spark, d)
    measured = graph.recall(hits, retrieval.top_k(queries, vectors, k=10))
    return measured.select("n_hits", (F.col("recall") >= 0.95).alias("reached"))


def _keyword_index(spark, d):
    documents = adapt.table(spark, d, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("content")
    )
    return keyword.build_index(documents, new_folder(spark))


def _asked(spark, d):
    """A text query for every benchmark item."""
    return adapt.table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text")


@query
def keyword_topk(spark, d):
    hits = keyword.keyword_top_k(_keyword_index(spark, d), _asked(spark, d), k=10)
    return _rounded(hits, "score")


@query
def hybrid_topk(spark, d):
    """Keyword and vector hits of one query as one list; an item's vector has its number."""
    asked = _asked(spark, d)
    vectors = adapt.vectors(spark, d)
    queries = vectors.withColumnRenamed("id", "query_id").join(asked, "query_id", "left_semi")
    by_vector = retrieval.top_k(queries, vectors, k=20)
    by_word = keyword.keyword_top_k(_keyword_index(spark, d), asked, k=20)
    return _rounded(keyword.fused([by_word, by_vector], k=10), "score")


@query
def context(spark, d):
    documents = adapt.table(spark, d, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("content"), "source"
    )
    hits = retrieval.top_k(adapt.label_centroids(spark, d), adapt.vectors(spark, d), k=3)
    return retrieval.context_texts(retrieval.hits_with_content(hits, documents))


@query
def reply_parse(spark, d):
    replies = adapt.table(spark, d, "events").select(
        "event_id", F.expr(adapt.REPLY_TEXT).alias("reply")
    )
    return replies.select("event_id", *reply_attributes(F.col("reply")))


@query
def transcript(spark, d):
    return retrieval.transcripts(adapt.table(spark, d, "conversations"), part_turns=4)


@query
def last_assistant(spark, d):
    return retrieval.last_assistant(adapt.table(spark, d, "conversations"))


# attempts


def _attempts(spark, d):
    """An attempt per event; two kinds of five have failed."""
    return adapt.table(spark, d, "events").select("event_id", F.expr(adapt.ATTEMPT_OK).alias("ok"))


@query
def consecutive_failures(spark, d):
    return attempts.numbered_attempts(_attempts(spark, d), ["event_id"])


@query
def limited_successes(spark, d):
    """The attempts up to the 500th success."""
    return attempts.attempted(_attempts(spark, d), limit=500, order=["event_id"])


@query
def failure_stop(spark, d):
    """The attempts up to the sixth failure in a row."""
    return attempts.attempted(_attempts(spark, d), most_failures=6, order=["event_id"])


@query
def sketch_profile(spark, d):
    """Distinct customers since a year from sketches by year, and whether they are near the exact number."""
    orders = adapt.table(spark, d, "orders").select(
        F.year("o_orderdate").cast("bigint").alias("since"), "o_custkey", "o_totalprice"
    )
    kept = settle(sketches.date_sketches(orders, ["o_custkey"], ["o_totalprice"], by="since"))
    parts = []
    for year in (1995, 1998, 2000):
        got = sketches.range_profile(kept, F.col("since") >= year).first()  # one row
        price = F.col("o_totalprice")
        ranks = [F.avg((price <= q).cast("int")) for q in got.quartiles_o_totalprice]
        near = [F.abs(r - q) <= 0.02 for r, q in zip(ranks, sketches.QUARTILES, strict=True)]
        n = F.countDistinct("o_custkey")
        parts.append(
            orders.where(F.col("since") >= year).agg(
                F.lit(year).cast("bigint").alias("since"),
                F.lit(got.n_rows).alias("n_rows"),
                n.alias("n_customers"),
                (F.abs(got.n_o_custkey - n) <= 0.03 * n).alias("near"),
                (near[0] & near[1] & near[2]).alias("ranked"),
            )
        )
    return parts[0].union(parts[1]).union(parts[2])


# work lists


_EXT = (
    "CASE {0} % 4 WHEN 0 THEN '.JPG' WHEN 1 THEN '.tar.png' WHEN 2 THEN '.html' ELSE '' END"
)


def _named(df, key):
    ext = _EXT.format(key)
    return df.select(F.expr(f"'p' || CAST({key} AS STRING) || {ext}").alias("filename"))


@query
def worklist(spark, d):
    files = _named(adapt.table(spark, d, "pages"), "page_id")
    done = _named(adapt.table(spark, d, "labels"), "doc_id")
    return annotate.worklist(files, done)


@query
def kept_semi(spark, d):
    images = adapt.table(spark, d, "documents").select(
        F.expr("'d' || CAST(doc_id AS STRING) || '.jpg'").alias("filename")
    )
    files = adapt.table(spark, d, "labels").select(
        F.expr("'d' || CAST(doc_id AS STRING) || '_label.json'").alias("label_file")
    )
    return transform.with_label_file(images, files)


@query
def missing_anti(spark, d):
    names = adapt.table(spark, d, "documents").select(F.col("doc_id").alias("name"))
    present = adapt.table(spark, d, "labels").select(F.col("doc_id").alias("name"))
    return transform.with_presence(names, present, flag="copied")


@query
def qualified_images(spark, d):
    images = adapt.table(spark, d, "lineitem").select(
        F.concat(F.lit("n"), F.col("l_orderkey").cast("string")).alias("name")
    )
    return validate.qualified_names(adapt.document_texts(spark, d), images)


# runs


@query
def run_status(spark, d):
    return runs.run_listing(adapt.run_events(spark, d))


@query
def run_progress(spark, d):
    return _rounded(runs.step_progress(adapt.run_events(spark, d)), "percentage")


@query
def run_errors(spark, d):
    return runs.recent_errors(adapt.run_events(spark, d)).select(
        "run_id", "error_no", "step", "error"
    )


@query
def job_outcomes(spark, d):
    out = runs.job_outcomes(
        adapt.table(spark, d, "events"), "event_type", F.col("value") > 10, F.col("value")
    )
    return _rounded(out, "seconds", "success_rate", "per_second")


def _upsert_sides(spark, d):
    old = adapt.table(spark, d, "documents").select(
        F.col("doc_id").alias("id"), "lang", "source", F.col("n_chars").alias("version")
    )
    new = adapt.table(spark, d, "labels").select(
        (F.col("doc_id") * 2).alias("id"),
        F.lit("xx").alias("lang"),
        F.concat(F.lit("q"), F.col("quality").cast("string")).alias("source"),
        (F.col("toxic") * 100000 + 1000).cast("bigint").alias("version"),
    )
    return old, new


@query
def upsert(spark, d):
    return upserted(*_upsert_sides(spark, d), "id", "version")


@query
def upsert_in_buckets(spark, d):
    """The same through a table in buckets, of which only those with new keys are rewritten."""
    (old, new), path = _upsert_sides(spark, d), new_folder(spark)
    write_buckets(old, path, "id", 16)
    upsert_buckets(spark, path, new, "id", "version", 16)
    return spark.read.parquet(path).drop("bucket")


