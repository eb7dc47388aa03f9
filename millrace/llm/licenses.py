"""License scans with DataFrame operations only: diagonal voting.

Every rolling word k-gram of a text is looked up among the k-grams of the license templates. A hit at
word p on template word t votes for the diagonal p - t. Neighbouring diagonals (a word more or less)
merge into one candidate, whose matched template words are counted: it stands if they cover enough of
the template. Hash hits are verified on the k-gram's text by the join itself.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import LOWER, UPPER, table, words

#: The phrases of the base scan and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Wording of public license notices, lower case, words only.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("proprietary", "all rights reserved"),
]
K = 3
#: Diagonals this far apart still belong to one candidate.
NEAR = 2
#: Least share of a template's words that a candidate must match.
COVER = 0.75


def template_grams(templates: list[tuple[str, str]] = TEMPLATES, k: int = K) -> list[tuple[int, str, int, str, int]]:
    """(template, label, words in it, k-gram, position) for every rolling k-gram."""
    out = []
    for n, (label, text) in enumerate(templates):
        w = text.split()
        out += [(n, label, len(w), " ".join(w[p : p + k]), p) for p in range(len(w) - k + 1)]
    return out


def phrase_places(w: Column, phrase: list[str], ends: Column) -> Column:
    """Starts of a phrase, given the places `ends` of its last word."""
    back = len(phrase) - 1

    def there(e: Column) -> Column:
        ok = e >= back
        for i, word in enumerate(phrase[:-1]):
            ok = ok & (F.get(w, e - (back - i)) == word)
        return ok

    last = F.filter(ends, lambda e: F.get(w, e) == phrase[-1])
    return F.transform(F.filter(last, there), lambda e: e - back)


def license_scan(docs: DataFrame, keep: list[str], text_col: str = "text", phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES, k: int = K) -> DataFrame:
    """Every row of docs with the columns `keep`, n_words, base (starts of phrases), base_labels, spans, score.

    spans: verified template matches (label, first and last word, cover). Null and empty texts have
    none and score 0. Rows stay apart whatever their ids. The score is the best cover, 1 / 2 at
    least where a base phrase stands.
    """
    spark = docs.sparkSession
    grams = template_grams(templates, k)
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), *(F.col(c) for c in keep), words(F.col(text_col)).alias("_w"))
    last_words = sorted({p.split()[-1] for p in phrases})
    none = F.array().cast("array<int>")

    def starts(n: int) -> Column:
        return F.when(F.size("_w") >= n, F.sequence(F.lit(0), F.size("_w") - n)).otherwise(none)

    hashed = [r[0] for r in spark.createDataFrame([(g,) for g in sorted({g[3] for g in grams})], "g string").select(F.xxhash64(F.split("g", " "))).collect()]
    hit = F.filter(starts(k), lambda p: F.xxhash64(F.slice("_w", p + 1, k)).isin(hashed))
    rows = rows.select("_row", *keep, "_w", F.filter(starts(1), lambda p: F.get("_w", p).isin(last_words)).alias("_e"), F.transform(hit, lambda p: F.struct(p.alias("p"), F.array_join(F.slice("_w", p + 1, k), " ").alias("gram"))).alias("_h"))
    found = {p: phrase_places(F.col("_w"), p.split(), F.col("_e")) for p in phrases}
    labels = F.array_sort(F.array_distinct(F.array_compact(F.array(*(F.when(F.size(v) > 0, F.lit(phrases[p])) for p, v in found.items())))))
    rows = rows.select("_row", *keep, F.size("_w").cast("long").alias("n_words"), F.array_sort(F.concat(none, *found.values())).alias("base"), F.array_join(labels, ",").alias("base_labels"), F.explode_outer("_h").alias("_h"))
    rows = rows.select("_row", *keep, "n_words", "base", "base_labels", F.col("_h.p").alias("p"), F.col("_h.gram").alias("gram"))
    dim = spark.createDataFrame(grams, "t int, label string, t_words int, gram string, t_at int")  # constants, a few hundred rows
    voted = rows.join(F.broadcast(dim), "gram", "left")
    key = ["_row", *keep, "n_words", "base", "base_labels"]
    diagonals = voted.groupBy(*key, "t", "label", "t_words", (F.col("p") - F.col("t_at")).alias("diagonal")).agg(F.collect_set("t_at").alias("t_at"), F.min("p").alias("first"), F.max("p").alias("last"))
    order = Window.partitionBy("_row", "t").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(order) > NEAR
    merged = diagonals.withColumn("_new", F.when(apart, 1).otherwise(0)).withColumn("_part", F.sum("_new").over(order))
    candidates = merged.groupBy(*key, "t", "label", "t_words", "_part").agg(F.flatten(F.collect_list("t_at")).alias("t_at"), F.min("first").alias("first"), (F.max("last") + k - 1).alias("last"))
    matched = F.size(F.array_distinct(F.flatten(F.transform("t_at", lambda a: F.sequence(a, a + k - 1)))))
    candidates = candidates.withColumn("cover", matched / F.col("t_words"))
    span = F.when(F.col("cover") >= COVER, F.struct("first", "last", "label", "cover"))
    out = candidates.groupBy(*key).agg(F.sort_array(F.collect_list(span)).alias("spans"))
    best = F.greatest(F.coalesce(F.array_max(F.transform("spans", lambda s: s["cover"])), F.lit(0.0)), F.when(F.size("base") > 0, 0.5).otherwise(0.0))
    return out.select(*keep, "n_words", "base", "base_labels", "spans", F.round(best, 6).alias("score"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = license_scan(table(spark, sf_dir, "documents"), ["doc_id"])
    labels = F.array_distinct(F.array_sort(F.concat(F.filter(F.split("base_labels", ","), lambda x: x != ""), F.transform("spans", lambda s: s["label"]))))
    return got.select("doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min("base").cast("long").alias("first_word"), F.array_max("base").cast("long").alias("last_word"), "base_labels", F.array_join(labels, ",").alias("labels"), "score")


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


OP4_SQL = rf"""
WITH doc AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
phrase(phrase, n, label) AS (VALUES {_values([(p, len(p.split()), v) for p, v in PHRASES.items()])}),
base AS (
  SELECT r, p, label FROM doc, phrase, unnest(range(0, greatest(len(w) - n + 1, 0))) AS t(p)
  WHERE array_to_string(w[p + 1:p + n], ' ') = phrase),
per_base AS (SELECT r, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY r),
gram(t, label, t_words, gram, t_at) AS (VALUES {_values(template_grams())}),
hit AS (
  SELECT r, p, t, label, t_words, t_at, p - t_at AS diagonal
  FROM (SELECT r, p, array_to_string(w[p + 1:p + {K}], ' ') AS g FROM doc, unnest(range(0, greatest(len(w) - {K} + 1, 0))) AS u(p)) JOIN gram ON g = gram.gram),
diag AS (SELECT DISTINCT r, t, diagonal FROM hit),
edge AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, t ORDER BY diagonal) > {NEAR} THEN 1 ELSE 0 END AS new FROM diag),
part AS (SELECT *, sum(new) OVER (PARTITION BY r, t ORDER BY diagonal) AS part FROM edge),
cand AS (
  SELECT r, t, label, part, count(DISTINCT t_at + i) / max(t_words) AS cover
  FROM hit JOIN part USING (r, t, diagonal), unnest(range(0, {K})) AS u(i) GROUP BY r, t, label, part),
stands AS (SELECT r, label, cover FROM cand WHERE cover >= {COVER}),
best AS (SELECT r, max(cover) AS cover FROM stands GROUP BY r),
every AS (SELECT r, label FROM stands UNION SELECT r, label FROM base),
per_doc AS (SELECT r, string_agg(label, ',' ORDER BY label) AS labels FROM every GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       round(greatest(coalesce(cover, 0.0), CASE WHEN n_base > 0 THEN 0.5 ELSE 0.0 END), 6) AS score
FROM doc LEFT JOIN per_base USING (r) LEFT JOIN best USING (r) LEFT JOIN per_doc USING (r)
"""
