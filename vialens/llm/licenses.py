"""License scans by diagonal voting, in DataFrame functions alone.

Templates are phrases and notices. Every run of ``GRAM`` words of a text and of
a template (phrases as short as that included) has a hash; equal hashes join
text positions to template positions, and position minus template position is
the diagonal. Grams that agree on a diagonal vote for it. A diagonal is merged
with its neighbours up to ``DRIFT`` words away, so a missing or added word does not
split a hit; it is not merged further with theirs, so a span is as long as its
template and that drift. A span is verified in order: of its grams, compared as
text, the chain that rises both in the text and in the template and covers the
most of the template's words. A notice stands if at most ``MISSED`` of its words
are not covered (one of few words), and, where it has under ``SHORT`` grams, all
its key words are: those that no notice of another label has. Phrases must be
there whole, on one diagonal. Of notices whose spans overlap, those with the
largest share of covered words stay, and of these those with the most.

Only grams of some template are ever made into rows: the templates' hashes, a
fixed set, filter the hashes inside each text's array first.

Defined cases: null and empty texts have no words, no labels and a score of 0;
repeated rows give repeated results.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GRAM = 2
DRIFT = 3

# Phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Notices and their labels.
NOTICES = {
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "licensed under cc by 4 0": "cc-by-4.0",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "this work is licensed under the gnu general public license version 2": "gpl-2.0",
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
}

#: Largest share of a notice's words that may be missing or changed; one always may.
MISSED = 0.2
#: Notices of fewer grams need their key words.
SHORT = 10
#: What a key word counts; other words count one.
_KEY = 100


def key_words(notice: str) -> set[str]:
    """The words of a notice that notices of other labels don't have."""
    label = NOTICES[notice]
    others = {w for n, other in NOTICES.items() if other != label for w in n.split()}
    return set(notice.split()) - others


def weights(template: str) -> list[int]:
    """What each word of a template counts."""
    words = template.split()
    if template in PHRASES or len(words) - GRAM + 1 >= SHORT:
        return [1] * len(words)
    keys = key_words(template)
    return [_KEY if w in keys else 1 for w in words]


def needed(template: str) -> int:
    """What the covered words must count together."""
    weight = weights(template)
    missed = 0 if template in PHRASES else max(1, int(MISSED * len(weight)))
    return sum(weight) - min(missed, weight.count(1))

_WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Lower-cased words of ASCII letters and digits and of everything outside ASCII."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lower, _WORD_BREAK, -1), "")


def _gram_hashes(w: Column) -> Column:
    """Hash of the gram from each word on; the last words start none."""
    return F.transform(
        w, lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, GRAM)])
    )


def templates(spark: SparkSession) -> DataFrame:
    """(template, label, is_phrase, needed, weights, n_grams, at, hash, gram): every template by its grams."""
    rows = [(p, label, True, needed(p), weights(p)) for p, label in PHRASES.items()]
    rows += [(p, label, False, needed(p), weights(p)) for p, label in NOTICES.items()]
    table = spark.createDataFrame(
        rows, "template string, label string, is_phrase boolean, needed int, weights array<int>"
    )
    w = F.split("template", " ")
    n = F.size(w) - GRAM + 1
    grams = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.struct(
            i.alias("at"),
            F.xxhash64(*[F.get(w, i + k) for k in range(GRAM)]).alias("hash"),
            F.array_join(F.slice(w, i + 1, F.lit(GRAM)), " ").alias("gram"),
        ),
    )
    rows = table.select("*", n.alias("n_grams"), F.explode(grams).alias("g"))
    return rows.select(
        "template", "label", "is_phrase", "needed", "weights", "n_grams", "g.at", "g.hash", "g.gram"
    )


def gram_hits(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, n_words, pos, hash, gram): the grams of any template in every text.

    A text without one has a row of nulls.
    """
    known = templates(docs.sparkSession).select("hash").distinct().collect()  # a fixed set
    hashes = [r["hash"] for r in known]
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id).cast("long").alias("doc_id"),
        words(F.col(text)).alias("w"),
    )
    numbered = F.transform(
        _gram_hashes(F.col("w")), lambda h, i: F.struct(i.alias("pos"), h.alias("hash"))
    )
    near = F.filter(numbered, lambda g: g["hash"].isin(hashes))
    gram = lambda g: F.array_join(F.slice("w", g["pos"] + 1, F.lit(GRAM)), " ")
    hits = F.transform(near, lambda g: F.struct(g["pos"], g["hash"], gram(g).alias("gram")))
    rows = rows.select("row", "doc_id", F.size("w").cast("long").alias("n_words"), hits.alias("hits"))
    return rows.select("row", "doc_id", "n_words", F.explode_outer("hits").alias("g")).select(
        "row", "doc_id", "n_words", "g.pos", "g.hash", "g.gram"
    )


_TEMPLATE = ["template", "label", "is_phrase", "needed", "weights", "n_grams"]


def diagonals(hits: DataFrame) -> DataFrame:
    """Votes by (row, template, diagonal); ``ats`` are the template grams that agree on it.

    Rows are dealt by text once: the groups and windows that follow stay there.
    """
    grams = templates(hits.sparkSession).withColumnRenamed("gram", "own")
    same = (hits["hash"] == grams["hash"]) & (hits["gram"] == grams["own"])
    met = hits.join(grams, same, "left").drop(grams["hash"])
    return (
        met.repartition("row")
        .groupBy("row", "doc_id", "n_words", *_TEMPLATE, (F.col("pos") - F.col("at")).alias("diagonal"))
        .agg(F.count("at").alias("votes"), F.collect_set("at").alias("ats"))
    )


def _covered(votes: Column) -> Column:
    """What the best chain of ``votes`` (at, pos) counts; both rise along a chain.

    Votes are taken by place in the template, so a vote may follow any taken
    before that has a smaller place and a smaller position.
    """
    none = F.array().cast("array<struct<at:int,pos:int,worth:int>>")

    def worth(first, after):  # of the template's words from first to the one before after
        part = F.slice("weights", first + 1, after - first)
        return F.aggregate(part, F.lit(0), lambda a, w: a + w)

    def step(chains, v):
        earlier = F.filter(chains, lambda c: (c["at"] < v["at"]) & (c["pos"] < v["pos"]))
        joined = F.transform(
            earlier, lambda c: c["worth"] + worth(F.greatest(c["at"] + GRAM, v["at"]), v["at"] + GRAM)
        )
        best = F.greatest(worth(v["at"], v["at"] + GRAM), F.array_max(joined))
        return F.concat(chains, F.array(F.struct(v["at"].alias("at"), v["pos"].alias("pos"), best.alias("worth"))))

    chains = F.aggregate(F.array_sort(votes), none, step)
    return F.array_max(F.transform(chains, lambda c: c["worth"]))


def spans(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, n_words, template, label, is_phrase, start, share): verified spans.

    A text without any has one row with a null template. ``start`` is the word
    where the span's diagonal puts the template's first word.
    """
    votes = diagonals(gram_hits(docs, id, text))
    group = ["row", "doc_id", "n_words", *_TEMPLATE]
    # phrases stand word for word on one diagonal; a notice's votes count for those beside theirs too
    drift = F.when(F.col("is_phrase"), 0).otherwise(DRIFT)
    base = F.col("diagonal")
    one = F.transform("ats", lambda at: F.struct(at.cast("int").alias("at"), (at + base).cast("int").alias("pos")))
    near = votes.withColumn("one", one).withColumn("own", F.explode_outer(F.sequence(base - drift, base + drift)))
    merged = near.groupBy(*group, "own").agg(
        F.flatten(F.collect_list("one")).alias("all_votes"), F.max(F.col("own") == base).alias("voted")
    )
    n = F.size("weights")
    # a chain covers fewer words than there are votes for: most spans need no look at their order
    enough = F.col("voted") & (F.size("all_votes") * GRAM >= n - F.greatest(F.lit(1), F.floor(MISSED * n)))
    worth = F.when(enough, _covered(F.col("all_votes")))
    judged = merged.withColumn("start", F.col("own")).withColumn("worth", worth)
    covered = F.col("worth") % _KEY + F.floor(F.col("worth") / _KEY)
    share = covered / n
    verified = F.coalesce(F.col("worth") >= F.col("needed"), F.lit(False))
    kept = judged.select(
        "row",
        "doc_id",
        "n_words",
        *[F.when(verified, F.col(c)).alias(c) for c in ("template", "label", "is_phrase", "start")],
        F.when(verified, F.col("start") + F.col("n_grams")).alias("end"),
        F.when(verified, share).alias("share"),
        F.when(verified, F.struct(share.alias("share"), covered.alias("covered"))).alias("fit"),
    )
    # of notices that overlap, which differ by a word or a version, the best matched stay
    kind = ["row", "is_phrase"]
    by_start = Window.partitionBy(*kind).orderBy("start", "end", "template")
    before = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    places = kept.withColumn("apart", F.coalesce(F.col("start") > before, F.lit(True)).cast("int"))
    places = places.withColumn("place", F.sum("apart").over(by_start))
    best = F.max("fit").over(Window.partitionBy(*kind, "place"))
    stays = F.coalesce(F.col("is_phrase") | (F.col("fit") == best), F.lit(False))
    columns = ("template", "label", "is_phrase", "start", "share")
    return places.withColumn("stays", stays).select(
        "row", "doc_id", "n_words", *[F.when(F.col("stays"), F.col(c)).alias(c) for c in columns]
    )


def license_report(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per text: words, places of phrases and their first and last word, labels and score.

    ``score`` is the largest share of a template's words that a verified span covers.
    """
    found = spans(docs, id, text)
    base = F.col("is_phrase")
    places = F.when(base, F.col("start").cast("long"))

    def listed(label: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(label)), ",")

    report = found.groupBy("row", "doc_id", "n_words").agg(
        F.count(places).alias("n_base"),
        F.min(places).alias("first_word"),
        F.max(places).alias("last_word"),
        listed(F.when(base, F.col("label"))).alias("base_labels"),
        listed(F.col("label")).alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
    )
    return report.drop("row")
