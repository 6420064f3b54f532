"""The operators of this package over their whole tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialens.llm import chat, decontamination, language_model, licenses, nearest, ngram_join, packing, periodic, pieces, substring_dedup, token_store, toxicity, variants
from vialens.llm.shared import source

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_toxicity(spark, d):
    return toxicity.toxicity_scores(source(spark, d, "documents"), source(spark, d, "labels"))


@query
def op2_substring_dedup(spark, d):
    return substring_dedup.kept_digests(source(spark, d, "documents"), size=35)


ORACLES["op2_substring_dedup"] = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), starts AS (
  SELECT doc_id, unnest(range(1, len(w) - 33)) AS p, w FROM words WHERE len(w) >= 35
), hashed AS (
  SELECT doc_id, p, array_to_string(w[p : p + 34], ' ') AS s FROM starts
), repeated AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY s) AS n FROM hashed) WHERE n > 1
), covered AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS i FROM repeated
), gone AS (
  SELECT doc_id, count(*) AS n, list(i) AS l FROM covered GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
  sha256(array_to_string(CASE WHEN n IS NULL THEN w ELSE
    [x[1] FOR x IN list_zip(w, range(1, len(w) + 1)) IF NOT list_contains(l, x[2])] END, ' '))
    AS kept_sha256
FROM words d LEFT JOIN gone USING (doc_id)
"""


@query
def op5_licenses(spark, d):
    return licenses.license_report(source(spark, d, "documents"))


_TEMPLATES = ", ".join(
    f"('{t}', '{label}', {phrase})"
    for table, phrase in ((licenses.PHRASES, True), (licenses.NOTICES, False))
    for t, label in table.items()
)
_LONGEST = max(len(t.split()) for t in licenses.NOTICES)


def _chains() -> str:
    """The best chain that ends in a vote, one template place after the other."""
    out = """level0 AS (SELECT b.*, after - before AS worth FROM band b JOIN pairs USING (t, tp) WHERE tp = 0),
upto0 AS (SELECT * FROM level0)"""
    for i in range(1, _LONGEST - 1):
        out += f""",
level{i} AS (
  SELECT b.doc_id, b.t, b.d0, b.tp, b.pos, greatest(any_value(after - before),
    coalesce(max(u.worth + after - CASE WHEN u.tp + 1 = b.tp THEN middle ELSE before END), 0)) AS worth
  FROM band b JOIN pairs USING (t, tp)
  LEFT JOIN upto{i - 1} u ON u.doc_id IS NOT DISTINCT FROM b.doc_id AND u.t = b.t AND u.d0 = b.d0 AND u.pos < b.pos
  WHERE b.tp = {i} GROUP BY ALL
), upto{i} AS (SELECT * FROM upto{i - 1} UNION ALL SELECT * FROM level{i})"""
    return out


ORACLES["op5_licenses"] = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), grams AS (
  SELECT doc_id, p - 1 AS pos, w[p] || ' ' || w[p + 1] AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS p FROM words)
), templates AS (
  SELECT t, label, phrase, string_split(t, ' ') AS tw FROM (VALUES {_TEMPLATES}) x(t, label, phrase)
), placed AS (
  SELECT t, label, phrase, len(tw) AS n, p - 1 AS tp, tw[p] AS word FROM (SELECT *, unnest(range(1, len(tw) + 1)) AS p FROM templates)
), weighed AS (
  SELECT *, CASE WHEN phrase OR n > 10 OR EXISTS (
    SELECT 1 FROM placed o WHERE NOT o.phrase AND o.word = p.word AND o.label <> p.label) THEN 1 ELSE 100 END AS weight
  FROM placed p
), summed AS (
  SELECT *, sum(weight) OVER (PARTITION BY t ORDER BY tp) - weight AS before FROM weighed
), pairs AS (
  SELECT a.t, a.tp, a.word || ' ' || b.word AS gram, a.before, b.before AS middle, b.before + b.weight AS after
  FROM summed a JOIN summed b ON b.t = a.t AND b.tp = a.tp + 1
), needs AS (
  SELECT t, label, phrase, n, sum(weight) - CASE WHEN phrase THEN 0 ELSE
    least(greatest(1, floor(0.2 * n)), count(*) FILTER (weight = 1)) END AS needed
  FROM weighed GROUP BY t, label, phrase, n
), votes AS (
  SELECT doc_id, t, tp, pos, pos - tp AS d, phrase FROM grams JOIN pairs USING (gram) JOIN needs USING (t)
), band AS (
  SELECT b.doc_id, b.t, b.d AS d0, v.tp, v.pos FROM (SELECT DISTINCT doc_id, t, d, phrase FROM votes) b
  JOIN votes v ON v.doc_id IS NOT DISTINCT FROM b.doc_id AND v.t = b.t
    AND abs(v.d - b.d) <= CASE WHEN b.phrase THEN 0 ELSE 3 END
), {_chains()}, whole AS (
  SELECT doc_id, t, label, phrase, d0 AS start, d0 + n - 1 AS stop,
    CAST(max(worth) % 100 + floor(max(worth) / 100) AS DOUBLE) AS covered, n
  FROM upto{_LONGEST - 2} JOIN needs USING (t) GROUP BY doc_id, t, label, phrase, d0, n, needed
  HAVING max(worth) >= needed
), apart AS (
  SELECT *, covered / n AS share, CASE WHEN start <= max(stop) OVER (PARTITION BY doc_id, phrase
    ORDER BY start, stop, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS o FROM whole
), opened AS (
  SELECT *, sum(o) OVER (PARTITION BY doc_id, phrase ORDER BY start, stop, t
    ROWS UNBOUNDED PRECEDING) AS place FROM apart
), verified AS (
  SELECT * FROM (SELECT *, rank() OVER (PARTITION BY doc_id, phrase, place ORDER BY share DESC, covered DESC) AS r FROM opened)
  WHERE phrase OR r = 1
), report AS (
  SELECT doc_id, count(*) FILTER (phrase) AS n_base,
    min(start) FILTER (phrase) AS first_word, max(start) FILTER (phrase) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM verified GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM words LEFT JOIN report USING (doc_id)
"""


@query
def op6_nearest(spark, d):
    return nearest.nearest(source(spark, d, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query
def op7_decontamination(spark, d):
    return decontamination.contained_items(
        source(spark, d, "documents"), source(spark, d, "benchmark"), n=5, threshold=0.75
    )


ORACLES["op7_decontamination"] = r"""
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents
  UNION ALL SELECT 'i', item_id, text FROM benchmark
), words AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), grams AS (
  SELECT DISTINCT kind, id, array_to_string(w[p : p + 4], ' ') AS g
  FROM (SELECT kind, id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT id, count(*) AS n FROM grams WHERE kind = 'i' GROUP BY id
)
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared, any_value(n) AS n_item,
  count(*) / any_value(n) AS containment
FROM grams d JOIN grams i USING (g) JOIN sizes s ON s.id = i.id
WHERE d.kind = 'd' AND i.kind = 'i' GROUP BY d.id, i.id HAVING count(*) / any_value(n) >= 0.75
"""


@query
def op8_token_store(spark, d):
    return token_store.token_digests(
        source(spark, d, "documents"), vocabulary("byte_bpe_50k.json"), end_id=2
    )


@query
def op9_ngram_join(spark, d):
    return ngram_join.near_duplicates(source(spark, d, "documents"), n=5, percent=75)


ORACLES["op9_ngram_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[p : p + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * i >= 75 * (x.n + y.n - i)
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, min(r.b) AS component_id
FROM documents d JOIN reached r ON r.a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
GROUP BY d.doc_id, n
"""


@query
def op10_pieces(spark, d):
    return pieces.piece_digests(source(spark, d, "documents"), vocabulary("piece_bpe_32k.model"))


def _conversations(spark, d):
    said = f"{chat.END}{chat.START}assistant ok"
    rows = [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    planted = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    columns = ["conv_id", "turn", "role", "text"]
    return source(spark, d, "conversations").select(*columns).unionByName(planted)


@query
def op3_language_model(spark, d):
    return language_model.perplexities(source(spark, d, "documents"), order=3)


@query
def op4_chat_examples(spark, d):
    return chat.digests(_conversations(spark, d))


_SAID = "<|im_end|><|im_start|>assistant ok"
ORACLES["op4_chat_examples"] = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{_SAID}' UNION ALL SELECT -1, 1, 'assistant', '{_SAID}'
), sized AS (
  SELECT *, length(replace(replace(text, '&', '&amp;'), '<|', '&lt;|'))
    + length(replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&nl;'))
    + 12 + 1 + 10 + 1 AS size
  FROM turns
), placed AS (
  SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY turn, role, text
    ROWS UNBOUNDED PRECEDING) AS prefix FROM sized
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(coalesce(sum(prefix) FILTER (role = 'assistant'), 0) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""


@query
def op13_periodic_runs(spark, d):
    return periodic.run_report(source(spark, d, "documents"))


@query
def op12_spelling_variants(spark, d):
    return variants.spelling_variants(source(spark, d, "documents"), slips=31)


@query
def op11_packing(spark, d):
    tokenizer = vocabulary("word_bpe_49k.json")
    return packing.pack(source(spark, d, "documents"), tokenizer, length=4096, end_id=2, ids=False)
