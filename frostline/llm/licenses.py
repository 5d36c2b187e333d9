"""License scans by diagonal voting, on DataFrame functions alone.

All runs of k words of a text and of the license templates are hashed and joined. A shared run at text position p and
template position t votes for the diagonal p - t. An exact copy puts all its votes on one diagonal, words left out or
put in move the rest to a neighbouring one: diagonals at most `DRIFT` apart are merged, and a merged span counts when
enough of the template's runs voted and it isn't longer than the template allows.

Short phrases are templates with pairs of words as runs, for which one diagonal must hold every run; notices are longer
templates with runs of three. Both go through the same join. Hashes that meet by chance are ruled out by comparing the words.

Null texts have no words. Equal texts are scanned once and get the same answer; rows without a match get zeros and
empty strings. An empty table gives no row. Only the named text is read; a column called like the result is replaced.
"""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from frostline.llm.text import LOWER, UPPER, WORD_PATTERN, native_words, text_key

# The phrases and labels that a scan has to know.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Openings of well-known notices.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
    " documentation files": "mit",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the"
    " license": "apache",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public"
    " license": "gpl",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general"
    " public license": "lgpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the"
    " following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
    " granted": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "licensed under cc by nc 4 0": "cc-by-nc",
}
#: Words of a run for phrases and for notices; how far merged diagonals may lie apart; the share of a notice's runs
#: that must vote, and the most words of a span for each word of the notice.
PHRASE_RUN, NOTICE_RUN, DRIFT, LEAST_VOTES, MOST_LENGTH = 2, 3, 3, 0.6, 1.5


def template_rows(phrases: dict[str, str], notices: dict[str, str]) -> list[tuple]:
    """(template, label, words, runs, k, t, run) for every run of every template."""
    rows = []
    for k, texts in ((PHRASE_RUN, phrases), (NOTICE_RUN, notices)):
        for text, label in texts.items():
            words = text.split()
            if len(words) < k:
                raise ValueError(f"{text!r} has fewer than {k} words")
            runs = len(words) - k + 1
            rows += [(text, label, len(words), runs, k, t, words[t:t + k]) for t in range(runs)]
    return rows


def votes(texts: DataFrame, templates: DataFrame) -> DataFrame:
    """One row for each text, template and pair of positions that share a run: key, template, p, t."""
    words = texts.select("key", native_words(F.col("text")).alias("words"))
    shifted = [F.expr(f"slice(words, {j + 1}, greatest(size(words) - {j}, 0))").alias(f"w{j}") for j in range(NOTICE_RUN)]
    places = words.select("key", F.posexplode(F.arrays_zip(*shifted)).alias("p", "w"))
    run = {k: F.array(*[F.col(f"w.w{j}") for j in range(k)]) for k in (PHRASE_RUN, NOTICE_RUN)}
    hashes = [F.struct(F.xxhash64(F.lit(k), *[F.col(f"w.w{j}") for j in range(k)]).alias("hash"), F.lit(k).alias("k")) for k in run]
    runs = places.select("key", "p", "w", F.explode(F.array(*hashes)).alias("h"))
    # The templates are a fixed few hundred rows.
    known = F.broadcast(templates.select("template", "t", F.xxhash64("k", *[F.get("run", j) for j in range(NOTICE_RUN)]).alias("hash"),
                                         F.col("run").alias("known")))
    same = F.when(F.col("h.k") == PHRASE_RUN, run[PHRASE_RUN]).otherwise(run[NOTICE_RUN]) == F.col("known")
    return runs.join(known, F.col("h.hash") == F.col("hash")).where(same).select("key", "template", "p", "t").distinct()


def spans(found: DataFrame, templates: DataFrame) -> DataFrame:
    """Verified occurrences: key, template, label, phrase (true for phrases), start, end (words) and share of votes."""
    about = F.broadcast(templates.select("template", "label", "n", "runs", "k").distinct())
    lines = found.join(about, "template").withColumn("d", F.col("p") - F.col("t"))
    by_line = lines.groupBy("key", "template", "label", "n", "runs", "k", "d").agg(
        F.count("*").alias("votes"), F.min("p").alias("low"), F.max("p").alias("high"), F.collect_set("t").alias("ts"))
    exact = by_line.where((F.col("k") == PHRASE_RUN) & (F.col("votes") == F.col("runs"))).select(
        "key", "template", "label", F.lit(True).alias("phrase"), F.col("d").alias("start"), (F.col("d") + F.col("n")).alias("end"),
        F.lit(1.0).alias("share"))
    line = Window.partitionBy("key", "template").orderBy("d")
    far = F.coalesce(F.col("d") - F.lag("d").over(line) > DRIFT, F.lit(True)).cast("int")
    merged = by_line.where(F.col("k") == NOTICE_RUN).withColumn("far", far).withColumn("group", F.sum("far").over(line))
    merged = merged.groupBy("key", "template", "label", "n", "runs", "group").agg(
        F.min("low").alias("start"), (F.max("high") + NOTICE_RUN).alias("end"),
        F.size(F.array_distinct(F.flatten(F.collect_list("ts")))).alias("voted"))
    share = F.col("voted") / F.col("runs")
    near = merged.where((share >= LEAST_VOTES) & (F.col("end") - F.col("start") <= MOST_LENGTH * F.col("n"))).select(
        "key", "template", "label", F.lit(False).alias("phrase"), "start", "end", share.alias("share"))
    return exact.unionByName(near)


def scan(docs: DataFrame, text: str = "text", out: str = "licenses", phrases: dict[str, str] = PHRASES,
         notices: dict[str, str] = NOTICES) -> DataFrame:
    """`docs` with a struct `out`: n_words, n_base, first_word, last_word, base_labels, labels, score and the spans."""
    spark: SparkSession = docs.sparkSession
    templates = spark.createDataFrame(template_rows(phrases, notices), "template string, label string, n int, runs int, k int, t int, run array<string>")
    keyed = docs.drop(out).withColumn("_key", text_key(F.col(text)))
    texts = keyed.where("_key IS NOT NULL").select(F.col("_key").alias("key"), F.col(text).alias("text"))
    found = spans(votes(texts, templates), templates).groupBy(F.col("key").alias("_key")).agg(
        F.count_if("phrase").alias("n_base"), F.min(F.when(F.col("phrase"), F.col("start"))).cast("bigint").alias("first_word"),
        F.max(F.when(F.col("phrase"), F.col("start"))).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("phrase"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("share").alias("score"),
        F.array_sort(F.collect_list(F.struct("start", "end", "label", "template", "share"))).alias("spans"))
    found = found.select("_key", F.struct(*found.columns[1:]).alias("_found"))
    joined = keyed.withColumn("_n", F.size(native_words(F.col(text))).cast("bigint")).join(found, "_key", "left")
    one = F.col("_found")
    answer = F.struct(
        F.col("_n").alias("n_words"), F.coalesce(one["n_base"], F.lit(0)).cast("bigint").alias("n_base"),
        one["first_word"].alias("first_word"), one["last_word"].alias("last_word"),
        F.coalesce(one["base_labels"], F.lit("")).alias("base_labels"), F.coalesce(one["labels"], F.lit("")).alias("labels"),
        F.coalesce(one["score"], F.lit(0.0)).alias("score"), one["spans"].alias("spans"))
    return joined.select(*[F.col(c) for c in docs.drop(out).columns], answer.alias(out))


def op4_licenses(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(docs).select("doc_id", *[f"licenses.{c}" for c in (
        "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")])


_TEMPLATES = ",\n    ".join(
    f"('{text}', '{label}', {n}, {runs}, {k}, {t}, '{' '.join(run)}')" for text, label, n, runs, k, t, run in template_rows(PHRASES, NOTICES))
SQL = rf"""
WITH templates(template, label, n, runs, k, t, run) AS (VALUES
    {_TEMPLATES}),
docs AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD_PATTERN}') AS w FROM documents),
places AS (SELECT r, p, k, array_to_string(w[p + 1:p + k], ' ') AS run
    FROM (SELECT r, w, k, unnest(range(0, len(w) - k + 1)) AS p FROM docs, (VALUES ({PHRASE_RUN}), ({NOTICE_RUN})) AS s(k) WHERE len(w) >= k)),
votes AS (SELECT DISTINCT r, template, label, n, runs, t.k, p, t, p - t AS d FROM places JOIN templates t USING (k, run)),
lines AS (SELECT r, template, label, n, runs, k, d, count(*) AS votes FROM votes GROUP BY ALL),
exact AS (SELECT r, label, d AS start FROM lines WHERE k = {PHRASE_RUN} AND votes = runs),
apart AS (SELECT *, CASE WHEN d - lag(d) OVER (PARTITION BY r, template ORDER BY d) <= {DRIFT} THEN 0 ELSE 1 END AS far
    FROM lines WHERE k = {NOTICE_RUN}),
grouped AS (SELECT r, template, d, sum(far) OVER (PARTITION BY r, template ORDER BY d) AS g FROM apart),
near AS (SELECT r, template, label, g, count(DISTINCT t) / any_value(runs) AS share, max(p) + {NOTICE_RUN} - min(p) AS size, any_value(n) AS n
    FROM votes JOIN grouped USING (r, template, d) GROUP BY r, template, label, g),
found AS (SELECT r, label, share FROM near WHERE share >= {LEAST_VOTES} AND size <= {MOST_LENGTH} * n
    UNION ALL SELECT r, label, 1.0 FROM exact),
base AS (SELECT r, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM exact GROUP BY r),
every AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM found GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
    last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
    coalesce(score, 0)::DOUBLE AS score
FROM docs LEFT JOIN base USING (r) LEFT JOIN every USING (r)
"""
