"""License scan: TF-IDF cosine of lines to templates, then inheritance from the nearest directory."""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permaway.operators.scratch import cut, hint_small

#: Statements that headers and licence files carry, by SPDX id (fixed values; a parameter of the scan).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
)
THRESHOLD = 0.8
#: Common words that are taken as anchors last.
COMMON = frozenset("a all and any are by following for from general has in is not of or person provided related source terms that the this to under use with without you".split())
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice)([-_.][^/]*)?$"


class Templates:
    """Weights of the templates: term frequency times idf over the templates, scaled to length 1.

    Terms that no template has get the largest idf. `anchors` are enough of each template's
    heaviest terms that a line without any of them has, by the inequality of
    Cauchy and Schwarz, a cosine below the threshold; they are a filter that loses nothing.
    """

    def __init__(self, templates=TEMPLATES, threshold: float = THRESHOLD):
        bags = [(name, Counter(re.findall("[a-z0-9]+", text.lower()))) for name, text in templates]
        df = Counter(t for _, b in bags for t in b)
        self.unknown = math.log(1 + len(bags)) + 1
        self.idf = {t: math.log((1 + len(bags)) / (1 + n)) + 1 for t, n in sorted(df.items())}
        self.weights, anchors = [], set()
        for name, bag in bags:
            w = {t: n * self.idf[t] for t, n in sorted(bag.items())}
            norm = math.sqrt(sum(x * x for x in w.values()))
            w = {t: x / norm for t, x in w.items()}
            self.weights.append((name, w))
            rest = 1.0
            for t in sorted(w, key=lambda t: (t in COMMON or t.isdigit(), len(t) < 4, -w[t], t)):
                if rest < (threshold * 0.999) ** 2:
                    break
                anchors.add(t)
                rest -= w[t] * w[t]
        self.anchors = sorted(anchors)


def _map(values: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def _once(rows: DataFrame, **columns: Column) -> DataFrame:
    """(_key, columns), each worked out once a row: the generator keeps filters and references
    that follow from being replaced by the expressions themselves."""
    return rows.select("_key", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _adder(idf: Column, weights: Column):
    """Adds a term's part of the scalar product of a line and a template."""
    return lambda a, x: a + F.element_at(idf, x) * F.coalesce(F.element_at(weights, x), F.lit(0.0))


def best_lines(docs: DataFrame, key: str = "doc_id", templates: Templates | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(key, license, score) of the best line of each text that reaches the threshold; of equal
    scores the last name. Whole texts are read; only lines with an anchor are scored, first
    with a bound from above (terms outside the templates counted once each), then exactly.
    Everything before the last, small aggregate is narrow. Null and empty texts have no line;
    rows of one key have one best line between them; an empty table gives none. A statement
    wrapped over several lines is scored line by line and may not reach the threshold."""
    t = templates or Templates(threshold=threshold)
    short = [a for a in t.anchors if len(a) < 5]
    tests = [lambda c, a=a: F.contains(c, F.lit(a)) for a in t.anchors if len(a) >= 5]
    if short:
        tests.append(lambda c: c.rlike("(?<![a-z0-9])(?:" + "|".join(short) + ")(?![a-z0-9])"))
    has = lambda c: _any([f(c) for f in tests])
    # Lowered and split before the filter, which else would lower the text once for each anchor.
    lines = docs.select(F.col(key).alias("_key"), F.explode(F.split(F.lower("text"), "\n")).alias("line")).where(has(F.col("line")))
    idf, known = _map(t.idf), F.array(*[F.lit(x) for x in t.idf])
    terms = F.regexp_extract_all("line", F.lit("([a-z0-9]+)"), 1)
    lines = _once(lines, terms=terms)
    known_terms, others = F.filter("terms", lambda x: F.array_contains(known, x)), F.filter("terms", lambda x: ~F.array_contains(known, x))
    lines = _once(lines, **{"in": known_terms, "out": others})
    tf = lambda x: F.size(F.filter("in", lambda y: y == x)).cast("double") * F.element_at(idf, x)
    squares = F.aggregate(F.transform(F.array_distinct("in"), tf), F.lit(0.0), lambda a, x: a + x * x)
    scores = []
    for name, weights in t.weights:
        own = _map(weights)

        dot = F.aggregate("in", F.lit(0.0), _adder(idf, own))
        scores.append(F.struct(dot.alias("dot"), F.lit(name).alias("license")))
    least = F.sqrt(squares + F.size(F.array_distinct("out")) * F.lit(t.unknown**2))
    lines = _once(lines, out=F.col("out"), in2=squares, best=F.array_max(F.array(*scores)), least=least)
    least = F.col("least")
    lines = lines.where((least > 0) & (F.col("best.dot") >= F.lit(threshold * 0.999) * least))
    # Squares of the counts of terms outside the templates, by one walk over them in order.
    walk = F.aggregate(
        F.sort_array("out"),
        F.struct(F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum")),
        lambda a, x: F.struct(
            x.alias("last"),
            F.when(a["last"] == x, a["run"] + 1.0).otherwise(F.lit(1.0)).alias("run"),
            (a["sum"] + F.when(a["last"] == x, 2.0 * a["run"] + 1.0).otherwise(F.lit(1.0))).alias("sum"),
        ),
    )["sum"]
    score = F.round(F.col("best.dot") / F.sqrt(F.col("in2") + walk * F.lit(t.unknown**2)), 6)
    hit = lines.select("_key", score.alias("score"), F.col("best.license").alias("license")).where(F.col("score") >= threshold)
    top = hit.groupBy("_key").agg(F.max(F.struct("score", "license")).alias("x"))
    return top.select(F.col("_key").alias(key), "x.license", "x.score")


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def inherit(files: DataFrame) -> DataFrame:
    """files(path, license, score, ...) with effective_license, basis and source_dir.

    A file's own licence counts first. Else it takes that of the nearest directory above,
    its own included, in which a licence file (by name) has one; of several there, the one of
    the best score, then the last name. Ancestors are listed for each directory once, not
    for each file, and found by an equality join on the directory.
    """
    folder = F.regexp_replace("path", "/[^/]*$", "")
    f = files.withColumn("_dir", folder)
    owners = f.where(F.col("license").isNotNull() & F.col("path").rlike(LICENCE_FILE))
    owners = owners.groupBy("_dir").agg(F.max(F.struct("score", "license")).alias("x")).select(F.col("_dir").alias("source_dir"), F.col("x.license").alias("_given"))
    dirs = f.where("_dir is not null").select("_dir").distinct()
    parts = F.split("_dir", "/")
    ups = dirs.withColumn("_p", parts).select("_dir", F.explode(F.expr("transform(sequence(1, size(_p)), n -> struct(n as depth, array_join(slice(_p, 1, n), '/') as source_dir))")).alias("u")).select("_dir", "u.*")
    near = ups.join(owners, "source_dir").groupBy("_dir").agg(F.max(F.struct("depth", "source_dir", "_given")).alias("x"))
    near = cut(near.select(F.col("_dir").alias("_at"), "x.source_dir", "x._given"))
    j = f.join(hint_small(near), F.col("_dir") == F.col("_at"), "left")
    own = F.col("license").isNotNull()
    basis = F.when(own & F.col("path").rlike(LICENCE_FILE), "licence file").when(own, "header").when(F.col("_given").isNotNull(), "inherited").otherwise("none")
    j = j.withColumn("effective_license", F.coalesce("license", "_given")).withColumn("basis", basis)
    return j.withColumn("source_dir", F.when(~own, F.col("source_dir"))).drop("_dir", "_at", "_given")


def scan_licenses(docs: DataFrame, path: Column, templates: Templates | None = None) -> DataFrame:
    """doc_id, path, license, score, effective_license, basis, source_dir for every row of docs.

    Null and empty texts have no licence of their own; a null path inherits nothing; rows
    of one doc_id have one best line between them. Other columns are not read.
    """
    best = cut(best_lines(docs.select("doc_id", "text"), "doc_id", templates).withColumnRenamed("doc_id", "_best_id"))
    rows = docs.select("doc_id", path.alias("path"))
    files = rows.join(hint_small(best), F.col("doc_id").eqNullSafe(F.col("_best_id")), "left").drop("_best_id")
    return inherit(cut(files)).select("doc_id", "path", "license", "score", "effective_license", "basis", "source_dir")


def document_path() -> Column:
    """Documents carry no paths; they stand in folders of a hundred within folders of a
    thousand of their source, and the first number of each hundred is its LICENSE file."""
    n = F.col("doc_id")
    name = F.when(n % 100 == 0, F.lit("LICENSE")).otherwise(F.concat(n.cast("string"), F.lit(".txt")))
    return F.concat(F.lit("/"), F.coalesce("source", F.lit("unknown")), F.lit("/"), F.floor(n / 1000).cast("string"), F.lit("/"), F.floor(n / 100).cast("string"), F.lit("/"), name)


def oracle() -> str:
    t = Templates()
    q = lambda s: s.replace("'", "''")
    idf = ", ".join(f"('{q(k)}', {v!r}::DOUBLE)" for k, v in t.idf.items())
    w = ", ".join(f"({i}, '{q(n)}', '{q(k)}', {v!r}::DOUBLE)" for i, (n, b) in enumerate(t.weights) for k, v in b.items())
    return f"""
WITH idf(term, x) AS (VALUES {idf}), w(tpl, license, term, y) AS (VALUES {w}),
u AS (SELECT doc_id, unnest(string_split(lower(text), chr(10))) AS line FROM documents WHERE text IS NOT NULL),
n AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(line, '[a-z0-9]+') AS terms FROM u),
tf AS (SELECT id, doc_id, term, count(*)::DOUBLE AS c FROM (SELECT id, doc_id, unnest(terms) AS term FROM n) GROUP BY ALL),
norm AS (SELECT id, sqrt(sum(c * c * coalesce(x, {t.unknown!r}) * coalesce(x, {t.unknown!r}))) AS l FROM tf LEFT JOIN idf USING (term) GROUP BY id),
dot AS (SELECT id, doc_id, tpl, license, sum(c * x * y) AS d FROM tf JOIN idf USING (term) JOIN w USING (term) GROUP BY ALL),
s AS (SELECT doc_id, license, round(d / l, 6) AS score FROM dot JOIN norm USING (id) WHERE round(d / l, 6) >= {THRESHOLD}),
best AS (SELECT doc_id, score, license FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license DESC) AS r FROM s) WHERE r = 1),
f AS (SELECT d.doc_id, '/' || coalesce(source, 'unknown') || '/' || (d.doc_id // 1000) || '/' || (d.doc_id // 100) AS dir, d.doc_id % 100 = 0 AS is_file, license, score FROM documents d LEFT JOIN best USING (doc_id)),
own AS (SELECT dir, license FROM (SELECT *, row_number() OVER (PARTITION BY dir ORDER BY score DESC, license DESC) AS r FROM f WHERE is_file AND license IS NOT NULL) WHERE r = 1)
SELECT doc_id, f.dir || '/' || CASE WHEN is_file THEN 'LICENSE' ELSE doc_id || '.txt' END AS path, f.license, score,
  coalesce(f.license, own.license) AS effective_license,
  CASE WHEN f.license IS NOT NULL THEN CASE WHEN is_file THEN 'licence file' ELSE 'header' END WHEN own.license IS NOT NULL THEN 'inherited' ELSE 'none' END AS basis,
  CASE WHEN f.license IS NULL AND own.license IS NOT NULL THEN f.dir END AS source_dir
FROM f LEFT JOIN own USING (dir)
"""


SQL = oracle()


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"), document_path())
