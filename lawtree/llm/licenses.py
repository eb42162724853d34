"""Licence scans: TF-IDF cosine of headers and licence files to templates, then inheritance by path.

Every line may be a header; a licence file counts as a whole as well. Both become sparse TF-IDF
vectors, with the number of documents that hold a term taken over all of them for the terms of the
templates; any other term weighs like one never seen. A file has the licence of its best match of
at least MATCH. A file without one inherits that of the nearest directory above it that has a
licence file with a licence. DataFrame operations only.

Most lines are ordinary text. By the Cauchy-Schwarz inequality the cosine to any template is at most
the share of a line's length that lies in terms of templates, so lines where this share is under
MATCH are left out before their terms become rows; no line that could match is among them.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lawtree.llm.common import saved, table

MATCH = 0.6
LICENSE_FILE = "(?i)^(licen[sc]e|copying)"

# The notices of common licences, and that of none. The name of the latter sorts behind the
# others, so that a licence granted beside reserved rights wins at equal scores.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "SPDX-License-Identifier: LGPL-3.0-only"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Reserved", "All rights reserved."),
]


def terms(text: str) -> list[str]:
    return [t for t in re.split("[^a-z0-9]+", text.lower()) if t]


VOCABULARY = sorted({t for _, text in TEMPLATES for t in terms(text)})


def _terms(text: str) -> Column:
    return F.expr(f"array_remove(split(lower({text}), '[^a-z0-9]+'), '')")


def _template_terms(spark: SparkSession) -> DataFrame:
    """(template, license, term, tf) of the fixed templates."""
    rows = [
        (i, name, t, float(terms(text).count(t))) for i, (name, text) in enumerate(TEMPLATES) for t in sorted(set(terms(text)))
    ]
    return spark.createDataFrame(rows, "template int, license string, term string, tf double")


def weights(files: DataFrame, total: int) -> DataFrame:
    """(term, idf) for the terms of the templates, over ``total`` documents."""
    known = F.array(*map(F.lit, VOCABULARY))
    held = files.select(F.explode(F.array_intersect(_terms("text"), known)).alias("term"))
    counts = held.groupBy("term").agg(F.count("*").alias("df"))
    every = files.sparkSession.createDataFrame([(t,) for t in VOCABULARY], "term string")
    idf = F.log((F.lit(total) + 1) / (F.coalesce("df", F.lit(0)) + 1)) + 1
    return every.join(counts, "term", "left").select("term", idf.alias("idf"))


def _may_match(units: DataFrame, idf: DataFrame, total: int) -> DataFrame:
    """``units`` of which enough of the vector of ``terms`` lies in terms of templates for some cosine to reach MATCH.

    ``idf`` has a row per term of the templates. Other terms count once each, which can only raise the share.
    """
    weight = idf.agg(F.map_from_entries(F.collect_list(F.struct("term", "idf")))).scalar()
    known = F.array_intersect("terms", F.array(*map(F.lit, VOCABULARY)))
    met = units.withColumns({"known": known, "weight": weight}).where(F.size("known") > 0)
    tf = lambda t: F.size("terms") - F.size(F.array_remove("terms", t))
    inside = F.aggregate("known", F.lit(0.0), lambda s, t: s + F.pow(tf(t) * F.try_element_at("weight", t), F.lit(2.0)))
    outside = (F.size(F.array_distinct("terms")) - F.size("known")) * (F.log(F.lit(total) + 1) + 1) ** 2
    # The margin is wider than what rounding can make of the score.
    return met.where(inside >= (MATCH * MATCH - 1e-6) * (inside + outside)).drop("known", "weight")


def matches(files: DataFrame) -> DataFrame:
    """(path, hash, license, score): the best match of each file (path, text) that has one."""
    spark = files.sparkSession
    total = files.count()
    idf = saved(weights(files, total), "idf")
    keyed = files.select("path", F.xxhash64("text").alias("hash"), "text").where("text IS NOT NULL")
    headers = keyed.select("path", "hash", F.posexplode(F.split("text", "\n")).alias("unit", "part"))
    whole = keyed.where(F.element_at(F.split("path", "/"), -1).rlike(LICENSE_FILE))
    units = headers.unionByName(whole.select("path", "hash", F.lit(-1).alias("unit"), F.col("text").alias("part")))
    # Terms are one generated row, which no filter on them is pushed below: it would cut the text again for each use.
    units = _may_match(units.select("path", "hash", "unit", F.explode(F.array(_terms("part"))).alias("terms")), idf, total)
    counted = units.distinct().select("path", "hash", "unit", F.explode("terms").alias("term"))
    counted = counted.groupBy("path", "hash", "unit", "term").agg(F.count("*").alias("tf"))
    vector = counted.join(idf, "term", "left").withColumn("other", F.log(F.lit(total) + 1) + 1)
    vector = vector.withColumn("w", F.col("tf") * F.coalesce("idf", "other"))
    norms = vector.groupBy("path", "hash", "unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    model = _template_terms(spark).join(idf, "term").withColumn("v", F.col("tf") * F.col("idf"))
    lengths = model.groupBy("template").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("length"))
    dots = (
        vector.where("idf IS NOT NULL").select("path", "hash", "unit", "term", "w")
        .join(model.select("template", "license", "term", "v"), "term")
        .groupBy("path", "hash", "unit", "template", "license").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    )
    keys = ["path", "hash", "unit"]
    same = [norms[k].eqNullSafe(dots[k]) for k in keys]
    scored = dots.join(norms, same).select(
        dots.path, dots.hash, "license", "template", "dot", "norm"
    ).join(lengths, "template")
    scored = scored.withColumn("score", F.round(F.col("dot") / (F.col("norm") * F.col("length")), 9)).where(F.col("score") >= MATCH)
    best = F.min_by(F.struct("license", "score"), F.struct(-F.col("score"), "license"))
    return scored.groupBy("path", "hash").agg(best.alias("best")).select("path", "hash", "best.license", "best.score")


def _parents(path: str) -> Column:
    """Directories above a path, the nearest first, each with its depth; the root is ''."""
    return F.expr(
        f"""transform(sequence(1, size(split({path}, '/'))), k -> struct(
              size(split({path}, '/')) - k AS depth, array_join(slice(split({path}, '/'), 1, size(split({path}, '/')) - k), '/') AS dir))"""
    )


RESULT = ("license", "license_score", "inherited_from")


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def scan(files: DataFrame) -> DataFrame:
    """``files`` (path, text, others) with ``license``, ``license_score`` and ``inherited_from``.

    A file with a match of its own has no ``inherited_from``; an inherited licence has no score. If
    a directory has several licence files the best match counts, then the first name. Files without
    text have no match and may inherit; a null path inherits nothing. Rows that repeat a path and
    text have the same result. Other columns are kept; columns of these three names are replaced.
    """
    files = files.select(*[F.col(c).cast("string").alias(c) if c in ("path", "text") else _quoted(c) for c in files.columns])
    own = saved(matches(files), "licenses")
    named = own.where(F.element_at(F.split("path", "/"), -1).rlike(LICENSE_FILE))
    folder = F.expr("array_join(slice(split(path, '/'), 1, size(split(path, '/')) - 1), '/')")
    best = F.min_by("license", F.struct(-F.col("score"), "path", "license"))
    folders = named.groupBy(folder.alias("dir")).agg(best.alias("folder_license"))
    paths = files.where("path IS NOT NULL").select("path").distinct()
    above = paths.select("path", F.explode(_parents("path")).alias("up")).select("path", "up.depth", "up.dir")
    nearest = above.join(folders, "dir").groupBy("path").agg(
        F.max_by(F.struct("dir", "folder_license"), "depth").alias("near")
    )
    own = own.select("path", "hash", F.struct("license", "score").alias("best"))
    kept = [c for c in files.columns if c not in (*RESULT, "path", "text")]
    # One struct holds the other columns, so that no name can clash with those of the joins.
    rows = files.select("path", F.xxhash64("text").alias("hash"), F.struct("path", "text", *map(_quoted, kept)).alias("file")).alias("f")
    joined = rows.join(own.alias("o"), F.col("f.path").eqNullSafe(F.col("o.path")) & (F.col("f.hash") == F.col("o.hash")), "left")
    joined = joined.join(nearest.alias("n"), F.col("f.path") == F.col("n.path"), "left")
    found = [
        F.coalesce("o.best.license", "n.near.folder_license"), F.col("o.best.score"),
        F.when(F.col("o.best.license").isNull(), F.col("n.near.dir")),
    ]
    given = [c for c in files.columns if c not in RESULT]
    return joined.select(*[F.col("f.file")[c].alias(c) for c in given], *[x.alias(c) for x, c in zip(found, RESULT)])


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files: ``source/thousands/hundreds/id.txt``, every tenth a licence file.

    Licence files of round hundreds and thousands stand one and two directories higher.
    """
    docs = table(spark, folder, "documents")
    files = docs.select("doc_id", F.expr(PATH).alias("path"), "text")
    return scan(files).select("doc_id", "path", "license", "inherited_from")


PATH = """
concat(source, CASE WHEN doc_id % 1000 = 0 THEN '' ELSE concat('/', floor(doc_id / 1000)) END,
  CASE WHEN doc_id % 100 = 0 THEN '' ELSE concat('/', floor(doc_id / 100)) END,
  CASE WHEN doc_id % 10 = 0 THEN concat('/LICENSE-', doc_id) ELSE concat('/', doc_id, '.txt') END)
"""

_VALUES = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(TEMPLATES))

ORACLE = rf"""
WITH tm AS (SELECT * FROM (VALUES {_VALUES}) v(template, license, text)),
tt AS (
  SELECT template, license, term, count(*) AS tf FROM (
    SELECT template, license, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS term FROM tm
  ) WHERE term <> '' GROUP BY ALL
), f AS (
  SELECT doc_id, text, source || CASE WHEN doc_id % 1000 = 0 THEN '' ELSE '/' || doc_id // 1000 END
    || CASE WHEN doc_id % 100 = 0 THEN '' ELSE '/' || doc_id // 100 END
    || CASE WHEN doc_id % 10 = 0 THEN '/LICENSE-' || doc_id ELSE '/' || doc_id || '.txt' END AS path
  FROM documents
), df AS (
  SELECT term, count(DISTINCT doc_id) AS df FROM (
    SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS term FROM f
  ) WHERE term IN (SELECT term FROM tt) GROUP BY term
), total AS (SELECT count(*) AS n FROM f),
idf AS (
  SELECT term, ln((n + 1) / (coalesce(df, 0) + 1)) + 1 AS idf
  FROM (SELECT DISTINCT term FROM tt) LEFT JOIN df USING (term), total
), units AS (
  SELECT doc_id, unit, part FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS part, generate_subscripts(string_split(text, chr(10)), 1) AS unit FROM f
  )
  UNION ALL
  SELECT doc_id, -1, text FROM f WHERE doc_id % 10 = 0
), ut AS (
  SELECT doc_id, unit, term, count(*) AS tf FROM (
    SELECT doc_id, unit, unnest(regexp_split_to_array(lower(part), '[^a-z0-9]+')) AS term FROM units
  ) WHERE term <> '' GROUP BY ALL
), vec AS (
  SELECT doc_id, unit, ut.term, tf * coalesce(idf, ln(n + 1) + 1) AS w FROM ut LEFT JOIN idf USING (term), total
), norms AS (SELECT doc_id, unit, sqrt(sum(w * w)) AS norm FROM vec GROUP BY ALL),
model AS (SELECT template, license, term, tf * idf AS v FROM tt JOIN idf USING (term)),
lengths AS (SELECT template, sqrt(sum(v * v)) AS length FROM model GROUP BY ALL),
scored AS (
  SELECT doc_id, license, round(dot / (norm * length), 9) AS score FROM (
    SELECT doc_id, unit, template, license, sum(w * v) AS dot FROM vec JOIN model USING (term) GROUP BY ALL
  ) JOIN norms USING (doc_id, unit) JOIN lengths USING (template)
), own AS (
  SELECT doc_id, license AS own, score FROM scored WHERE score >= {MATCH}
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license) = 1
), folders AS (
  SELECT regexp_replace(path, '/[^/]*$', '') AS dir, own AS license FROM f JOIN own USING (doc_id) WHERE doc_id % 10 = 0
  QUALIFY row_number() OVER (PARTITION BY regexp_replace(path, '/[^/]*$', '') ORDER BY score DESC, path, own) = 1
), near AS (
  SELECT doc_id, dir, license FROM f JOIN folders ON starts_with(path, dir || '/')
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length(dir) DESC) = 1
)
SELECT doc_id, path, coalesce(own, near.license) AS license, CASE WHEN own IS NULL THEN near.dir END AS inherited_from
FROM f LEFT JOIN own USING (doc_id) LEFT JOIN near USING (doc_id)
"""
