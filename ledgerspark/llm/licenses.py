"""License scans by ordered signature rules (operator 10). DataFrame functions only.

A text is read as words (A-Z lower-cased). Base phrases are exact runs of words. Beyond them, signature
rules are regexes over the words joined by single spaces: every license name goes through every sentence
template, besides rules for typical sentences of license texts. A rule runs only where its keyword
occurs; most documents hold no keyword at all and stop at one combined test. Detections are intervals:
one that lies inside another of higher priority (or equal priority and greater length, or equal in both
and listed earlier) is suppressed. What is left gives the labels.

Everything is a projection of the row: no shuffle. A null text is empty: no words, no labels, score 0.
Rows map one to one; whole texts are read, also very long ones; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blank_if_null, hidden, read_table
from .spans import let, starts

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: label: phrase, in words
BASE = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}

#: label: (name as a regex over words, keyword that any of its forms holds)
NAMES = {
    "mit": ("(?:mit|expat|x11)", ""),
    "apache-1.1": ("apache(?: software)?(?: license)?(?: version)? 1 1", "apache"),
    "apache-2": ("(?:apache(?: software)?(?: license)?(?: version)? (?:v?2|2 0)|asl 2 0)", ""),
    "bsd-2": ("(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)", "bsd"),
    "bsd-3": ("(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)", "bsd"),
    "bsd-4": ("(?:bsd 4 clause|4 clause bsd|original bsd)", "bsd"),
    "bsd": ("bsd", "bsd"),
    "gpl-1": ("(?:gnu )?(?:gpl|general public license)(?: version)? v?1", "g"),
    "gpl-2": ("(?:gnu )?(?:gpl|general public license)(?: version)? v?2(?: 0)?", "g"),
    "gpl-3": ("(?:gnu )?(?:gpl|general public license)(?: version)? v?3(?: 0)?", "g"),
    "gpl": ("gnu (?:gpl|general public license)", "gnu"),
    "lgpl-2.1": ("(?:gnu )?(?:lgpl|lesser general public license)(?: version)? v?2 1", "l"),
    "lgpl-3": ("(?:gnu )?(?:lgpl|lesser general public license)(?: version)? v?3(?: 0)?", "l"),
    "agpl-3": ("(?:gnu )?(?:agpl|affero general public license)(?: version)? v?3(?: 0)?", "a"),
    "mpl-1.1": ("(?:mpl|mozilla public license)(?: version)? 1 1", "m"),
    "mpl-2": ("(?:mpl|mozilla public license)(?: version)? 2(?: 0)?", "m"),
    "epl-1": ("(?:epl|eclipse public license)(?: version)? v?1(?: 0)?", "e"),
    "epl-2": ("(?:epl|eclipse public license)(?: version)? v?2(?: 0)?", "e"),
    "cddl-1": ("(?:cddl|common development and distribution license)(?: version)? 1 [01]", "d"),
    "cc0": ("(?:cc0|cc zero|creative commons zero)", "c"),
    "cc-by-nc-nd": ("(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:s|atives))", "c"),
    "cc-by-nc-sa": ("(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)", "c"),
    "cc-by-nc": ("(?:cc by nc|creative commons attribution non ?commercial)", "c"),
    "cc-by-nd": ("(?:cc by nd|creative commons attribution no ?deriv(?:s|atives))", "c"),
    "cc-by-sa": ("(?:cc by sa|creative commons attribution share ?alike)", "c"),
    "cc-by": ("(?:cc by|creative commons attribution)", "c"),
    "isc": ("isc", "isc"),
    "zlib": ("zlib(?: libpng)?", "zlib"),
    "boost-1": ("(?:bsl|boost(?: software)?)(?: license)?(?: version)? 1(?: 0)?", "b"),
    "artistic-2": ("artistic(?: license)?(?: version)? 2(?: 0)?", "artistic"),
    "unlicense": ("unlicense", "unlicense"),
    "wtfpl": ("(?:wtfpl|do what the fuck you want to public license)", "w"),
    "python-2": ("(?:psf|python(?: software foundation)?)(?: license)?(?: version)? 2(?: 0)?", "p"),
    "ofl-1.1": ("(?:sil )?(?:ofl|open font license)(?: version)? 1 1", "o"),
    "odbl-1": ("(?:odbl|open database license)(?: version)? 1(?: 0)?", "o"),
    "eupl-1.2": ("(?:eupl|european union public license)(?: version)? 1 2", "eu"),
}
#: (template, keyword, priority); the first that is listed wins among equals
TEMPLATES = (
    ("spdx license identifier {n}(?: only| or later)?", "spdx", 100),
    ("licensed under(?: the)?(?: terms of(?: the)?)? {n}(?: license| licence)?", "licensed under", 90),
    ("licensed by(?: the)? {n}(?: license| licence)?", "licensed by", 85),
    ("(?:released|distributed|published|provided|available)(?: \\S+){{0,3}} under(?: the)?(?: terms of(?: the)?)? {n}(?: license| licence)?", "under", 85),
    ("subject to(?: the)?(?: terms of(?: the)?)? {n}(?: license| licence)?", "subject to", 80),
    ("under(?: the)?(?: terms of(?: the)?)? {n} (?:license|licence)", "under", 75),
    ("licen[sc]es? {n}", "licen", 70),
    ("{n} (?:license|licence|licensed)", "licen", 60),
)
#: label: (sentence as a regex over words, keyword, priority)
SENTENCES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "permission is hereby granted", 95),
    ("apache-2", "you may not use this file except in compliance with the license", "except in compliance with the license", 95),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use", 90),
    ("gpl", "this program is free software you can redistribute it and or modify it", "this program is free software", 90),
    ("lgpl", "this library is free software you can redistribute it and or modify it", "this library is free software", 90),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "source code form is subject", 95),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify", 90),
    ("zlib", "this software is provided as is without any express or implied warranty in no event", "without any express or implied warranty", 90),
    ("boost-1", "permission is hereby granted free of charge to any person or organization obtaining a copy", "person or organization obtaining", 96),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software", 95),
    ("public-domain", "(?:released|dedicated|placed|is) (?:in|into|to) the public domain", "public domain", 60),
    ("proprietary", "all rights reserved", "all rights reserved", 40),
)
#: Every rule's keyword lies in a text in which one of these does.
GATE = r"(?i)licen[sc]|spdx|public|reserved|permission|redistrib|software|under|subject|cc[^0-9a-z]+by"


def rules() -> list[tuple[str, str, str, str, int]]:
    """(label, pattern, keyword, second keyword, priority): every name by every template, then the sentences."""
    made = [(label, " " + t.format(n=name) + " ", f" {k}" if k[0] != "l" else k, key, p)
            for t, k, p in TEMPLATES for label, (name, key) in NAMES.items()]
    return made + [(label, f" {s} ", k, "", p) for label, s, k, p in SENTENCES]


def _places(words: Column, phrase: str) -> Column:
    """Indexes at which the phrase's words stand consecutively."""
    want = phrase.split(" ")

    def match(w: Column, i: Column) -> Column:
        ok = w == want[0]
        for k, x in enumerate(want[1:], 1):
            ok = ok & (F.get(words, i + k) == x)
        return F.when(ok, i)

    return F.filter(F.transform(words, match), lambda i: i.isNotNull())


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replace ``text`` by n_words, base (array of label, word index), found (detections that are left)."""
    docs, names, rest = hidden(docs, text, "n_words", "base", "found")
    kept = [n for c, n in names.items() if c != text]
    lower = F.translate(blank_if_null(F.col(names[text])), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = docs.select(*kept, lower.alias("_t"))
    none = F.array().cast("array<string>")
    out = out.select(*kept, F.regexp_count("_t", F.lit(WORD)).cast("long").alias("n_words"),
                     F.when(F.col("_t").rlike(GATE), F.regexp_extract_all("_t", F.lit(WORD), F.lit(0))).otherwise(none).alias("_w"))
    out = out.withColumn("_n", F.when(F.size("_w") > 0, F.concat(F.lit(" "), F.array_join("_w", " "), F.lit(" "))).otherwise(F.lit("")))
    base = F.concat(*(F.when(F.col("_n").contains(f" {p} "), _named(n, _places(F.col("_w"), p)))
                      .otherwise(F.array().cast("array<struct<label:string,at:bigint>>")) for n, p in BASE.items()))
    table = F.array(*(F.struct(F.lit(i).alias("rule"), F.lit(label).alias("label"), F.lit(pattern).alias("pattern"),
                               F.lit(k).alias("k"), F.lit(k2).alias("k2"), F.lit(p).alias("priority"))
                      for i, (label, pattern, k, k2, p) in enumerate(rules())))
    near = F.filter(table, lambda r: F.col("_n").contains(r["k"]) & F.col("_n").contains(r["k2"]))
    out = out.withColumns({"_base": base, "_near": F.when(F.col("_n") == "", F.filter(table, lambda r: F.lit(False))).otherwise(near)})
    hits = F.flatten(F.transform("_near", _detections))
    out = out.withColumn("_hits", hits)
    left = F.filter("_hits", lambda d: ~F.exists("_hits", lambda e: _hides(e, d)))
    return out.withColumn("_left", left).select(*rest, "n_words", F.col("_base").alias("base"), F.col("_left").alias("found"))


def _named(label: str, places: Column) -> Column:
    return F.transform(places, lambda i: F.struct(F.lit(label).alias("label"), i.cast("long").alias("at")))


def _detections(rule: Column) -> Column:
    found = F.regexp_extract_all(F.col("_n"), rule["pattern"], F.lit(0))
    between = F.split(F.col("_n"), rule["pattern"], -1)

    def detection(m: Column, start: Column) -> Column:
        return F.struct(start.alias("start"), (start + F.length(m)).alias("end"), rule["priority"].alias("priority"),
                        rule["rule"].alias("rule"), rule["label"].alias("label"))

    return let(found, lambda ms: F.zip_with(ms, starts(ms, between), detection))


def _hides(e: Column, d: Column) -> Column:
    """Whether e suppresses d."""
    inside = (e["start"] <= d["start"]) & (e["end"] >= d["end"])
    longer = (e["end"] - e["start"]) > (d["end"] - d["start"])
    earlier = ((e["end"] - e["start"]) == (d["end"] - d["start"])) & (e["rule"] < d["rule"])
    return inside & ((e["priority"] > d["priority"]) | ((e["priority"] == d["priority"]) & (longer | earlier)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    at, base = F.transform("base", lambda b: b["at"]), F.transform("base", lambda b: b["label"])
    own = F.transform("found", lambda d: d["label"])
    best = F.coalesce(F.array_max(F.transform("found", lambda d: d["priority"])), F.lit(0))
    return got.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, own))), ",").alias("labels"),
        (F.greatest(best, F.when(F.size("base") > 0, 60).otherwise(0)) / F.lit(100.0)).alias("score"))


def _sql_text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _sql_base(label: str, phrase: str) -> str:
    want = phrase.split(" ")
    ok = " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(want))
    return f"SELECT rid, '{label}' AS label, i - 1 AS pos FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS i FROM words WHERE n LIKE '% {phrase} %') WHERE {ok}"


SQL = f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
words AS MATERIALIZED (SELECT rid, doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS n FROM (
    SELECT rid, doc_id, regexp_extract_all(t, '{WORD}') AS w FROM docs)),
base AS ({' UNION ALL '.join(_sql_base(n, p) for n, p in BASE.items())}),
rules(rule, label, pattern, k, k2, priority) AS (VALUES {', '.join(f"({i}, {_sql_text(a)}, {_sql_text(p)}, {_sql_text(k)}, {_sql_text(k2)}, {q})" for i, (a, p, k, k2, q) in enumerate(rules()))}),
near AS MATERIALIZED (SELECT rid, n, r.* FROM words JOIN rules r ON contains(n, k) AND contains(n, k2)),
raw AS MATERIALIZED (SELECT rid, rule, label, priority, regexp_extract_all(n, pattern) AS ms, string_split_regex(n, pattern) AS ps
    FROM near WHERE regexp_matches(n, pattern)),
hits AS MATERIALIZED (SELECT rid, rule, label, priority, h.s AS s, h.e AS e FROM (SELECT rid, rule, label, priority, unnest(list_transform(range(1, len(ms) + 1), lambda i: {{
    's': list_sum(list_transform(ps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i-1], lambda x: length(x))), 0),
    'e': list_sum(list_transform(ps[1:i], lambda x: length(x))) + list_sum(list_transform(ms[1:i], lambda x: length(x)))}})) AS h FROM raw)),
found AS (SELECT * FROM hits d WHERE NOT EXISTS (SELECT 1 FROM hits e WHERE e.rid = d.rid AND e.s <= d.s AND e.e >= d.e AND (
    e.priority > d.priority OR (e.priority = d.priority AND (e.e - e.s > d.e - d.s OR (e.e - e.s = d.e - d.s AND e.rule < d.rule)))))),
b AS (SELECT rid, count(*) AS n, min(pos) AS lo, max(pos) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY rid),
l AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (
    SELECT rid, label FROM base UNION ALL SELECT rid, label FROM found) GROUP BY rid),
p AS (SELECT rid, max(priority) AS best FROM found GROUP BY rid)
SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_base, CAST(lo AS BIGINT) AS first_word,
    CAST(hi AS BIGINT) AS last_word, coalesce(b.labels, '') AS base_labels, coalesce(l.labels, '') AS labels,
    greatest(coalesce(best, 0), CASE WHEN b.n > 0 THEN 60 ELSE 0 END) / 100.0::DOUBLE AS score
FROM words LEFT JOIN b USING (rid) LEFT JOIN l USING (rid) LEFT JOIN p USING (rid)
"""
