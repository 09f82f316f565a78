"""Secret scans with corpus-wide ownership frequency (operator 5). DataFrame functions only.

Each kind's pattern gives its leftmost non-overlapping matches; those that fail the kind's length are
dropped. The base kinds always stay. Besides them, ``token`` candidates (long runs with letters and
digits that touch no base span) are decided by the corpus: the hash of every candidate's value is
aggregated to its distinct repositories and owners. A value that one owner alone has is ``live``; one
that ``wide`` owners or more have is an ``example``, copied about; the rest is ``shared``. With ``many``,
a value that so many repositories have is not ``live`` even if they are one owner's, but ``shared``: a
placeholder of one hot owner. Tokens are reported only if live, so placeholders are left alone; base kinds
are reported still. The query judges by owners alone, as its SQL does. Values never leave the scan, only their hashes.

The scan is one pass per row; texts do not move. What is staged and shuffled is one row per document
without its text and one per candidate. Distinct counts combine before the shuffle, so a value that a
third of all rows hold is no hot key, and joining counts back is a join that adaptive execution splits.

A null text is empty; a null owner or repository counts as one owner or repository of its own. Rows map
one to one, repeated ids included. Whole texts are read; offsets count code points, the end exclusive.
Other columns stay as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blank_if_null, fresh, hidden, read_table, stage, with_row_id
from .spans import find_all, starts

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: kind: (pattern, least length of the match, least length of group 2 or 0), in the order of the report
KINDS = {
    "assign": (ASSIGN, 0, 6),
    "access": ("AKIA[A-Z0-9]+", 20, 0),
    "hex": ("[0-9a-f]{24,}", 24, 0),      # runs are maximal, so shorter ones can be left out at once
    "token": ("[A-Za-z0-9+/_-]{20,}", 20, 0),
}
BASE = ("assign", "access", "hex")
WIDE = 3
MANY = 100     # repositories


def _kind(name: str, order: int) -> Column:
    """The spans of one kind as structs that sort by start, then kind."""
    pattern, least, group = KINDS[name]
    m, at = F.col(f"{name}_m"), F.col(f"{name}_s")

    def one(match: Column, i: Column) -> Column:
        value = F.get(F.col(f"{name}_g"), i) if group else match
        ok = F.length(value) >= group if group else F.length(match) >= least
        if name == "token":
            ok = ok & match.rlike("[0-9]") & match.rlike("[A-Za-z]")
        start = F.get(at, i)
        return F.when(ok, F.struct(start.alias("start"), F.lit(order).alias("kind"), (start + F.length(match)).alias("end"),
                                   F.sha2(value, 256).alias("hash")))

    return F.filter(F.transform(m, one), lambda x: x.isNotNull())


def candidates(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and ``found``: every base span and every token that touches none of them."""
    docs, names, back = hidden(docs.select(*keep, F.col(text).alias(fresh(keep, "_t"))))
    *keep, body = names.values()
    out = docs.select(*keep, blank_if_null(F.col(body)).alias("_t"))
    for name, (pattern, _, group) in KINDS.items():
        m, between = find_all(F.col("_t"), pattern)
        out = out.withColumns({f"{name}_m": m, f"{name}_p": between} | (
            {f"{name}_g": F.when(F.col("_t").rlike(pattern), F.regexp_extract_all("_t", F.lit(pattern), F.lit(2)))} if group else {}))
    out = out.drop("_t").withColumns({f"{name}_s": starts(F.col(f"{name}_m"), F.col(f"{name}_p")) for name in KINDS})
    out = out.withColumns({f"{name}_x": _kind(name, i) for i, name in enumerate(KINDS)})
    out = out.withColumn("_base", F.concat(*(F.col(f"{n}_x") for n in BASE)))
    free = F.filter("token_x", lambda c: ~F.exists("_base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    out = out.withColumn("_found", F.array_sort(F.concat("_base", free)))
    return out.select(*back[:-1], F.col("_found").alias("found"))


def scan(docs: DataFrame, row: str, owner: str, repo: str, text: str = "text", wide: int = WIDE, carry: tuple[str, ...] = (),
         many: int | None = None) -> DataFrame:
    """(row, carried columns, spans): each span has start, kind, end, owners, repos, verdict.

    ``row`` is a column of distinct longs. ``many``: None where repositories don't count.
    """
    own = docs.withColumn("_owner", F.col(owner).cast("string")).withColumn("_repo", F.col(repo).cast("string"))
    rows = stage(candidates(own, [row, *carry, "_owner", "_repo"], text), "secrets")
    each = rows.select(F.col(row).alias("_r"), "_owner", "_repo", F.explode("found").alias("s")).select("_r", "_owner", "_repo", "s.*")
    nulls = F.lit("\0null")
    spread = each.groupBy("hash").agg(F.count_distinct(F.coalesce("_owner", nulls)).alias("owners"),
                                      F.count_distinct(F.coalesce("_repo", nulls)).alias("repos"))
    few = F.lit(True) if many is None else F.col("repos") < many
    verdict = F.when((F.col("owners") == 1) & few, "live").when(F.col("owners") >= wide, "example").otherwise("shared")
    judged = each.join(spread, "hash").withColumn("verdict", verdict)
    judged = judged.where((F.col("kind") < len(BASE)) | (F.col("verdict") == "live"))
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    of_row = judged.groupBy("_r").agg(F.array_sort(F.collect_list(F.struct(
        "start", "kind", "end", name.alias("name"), "owners", "repos", "verdict"))).alias("spans"))   # the spans of one text
    none = F.array().cast(of_row.schema["spans"].dataType)
    return rows.join(of_row, F.col(row) == F.col("_r"), "left").select(row, *carry, F.coalesce("spans", none).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, owner: str, repo: str, row: str, text: str = "text", wide: int = WIDE, many: int | None = MANY) -> DataFrame:
    """``docs`` with every span but widely copied examples replaced by [SECRET]."""
    r, cut = fresh(docs.columns, "_r"), fresh(docs.columns, "_cut")
    spans = scan(docs, row, owner, repo, text, wide, many=many).select(F.col(row).alias(r), F.filter("spans", lambda s: s["verdict"] != "example").alias(cut))
    spans = spans.where(F.size(cut) > 0)
    body = F.col(text)
    state = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    # overlapping spans: what lies before the end reached so far is gone already
    rebuilt = F.aggregate(cut, state, lambda acc, s: F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(
        s["end"].alias("at"), F.concat(acc["out"], F.when(s["start"] >= acc["at"], F.concat(_between(body, acc["at"], s["start"]), F.lit("[SECRET]")))
                                       .otherwise(F.lit(""))).alias("out"))),
        lambda acc: F.concat(acc["out"], _between(body, acc["at"], F.length(body))))
    return docs.join(spans, F.col(row) == F.col(r), "left").withColumn(
        text, F.when(F.col(cut).isNull(), body).otherwise(rebuilt)).drop(r, cut)


def _between(text: Column, start: Column, end: Column) -> Column:
    return F.substring(text, (start + 1).cast("int"), (end - start).cast("int"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_row_id(read_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    found = scan(docs, "rid", owner="source", repo="doc_id", carry=("doc_id",))
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))

    def count(field: str, value: int | str) -> Column:
        return F.size(F.filter("spans", lambda s: s[field] == value)).cast("long")

    return found.select(
        "doc_id", *(count("kind", i).alias(f"n_{n}") for i, n in enumerate(BASE)),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
        count("verdict", "live").alias("n_live"), count("verdict", "example").alias("n_example"))


def _sql_kind(name: str, order: int) -> str:
    pattern, least, group = KINDS[name]
    p = "'" + pattern.replace("'", "''") + "'"
    value = "m.g" if group else "m.m"
    ok = f"length({value}) >= {group or least}" + (" AND regexp_matches(m.m, '[0-9]') AND regexp_matches(m.m, '[A-Za-z]')" if name == "token" else "")
    return f"""SELECT rid, doc_id, source, {order} AS kind, '{name}' AS name, m.s AS s, m.s + length(m.m) AS e, sha256({value}) AS h FROM (
        SELECT rid, doc_id, source, unnest(list_transform(range(1, len(ms) + 1), lambda i: {{
            'm': ms[i], 'g': gs[i], 's': list_sum(list_transform(ps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i-1], lambda x: length(x))), 0)}})) AS m
        FROM (SELECT rid, doc_id, source, regexp_extract_all(t, {p}) AS ms, regexp_extract_all(t, {p}, {2 if group else 0}) AS gs,
                     string_split_regex(t, {p}) AS ps FROM docs WHERE regexp_matches(t, {p}))) WHERE {ok}"""


SQL = f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
allk AS MATERIALIZED ({' UNION ALL '.join(_sql_kind(n, i) for i, n in enumerate(KINDS))}),
free AS MATERIALIZED (SELECT * FROM allk a WHERE kind < {len(BASE)} OR NOT EXISTS (
    SELECT 1 FROM allk b WHERE b.kind < {len(BASE)} AND b.rid = a.rid AND b.s < a.e AND a.s < b.e)),
spread AS (SELECT h, count(DISTINCT coalesce(source, 'null?')) AS owners FROM free GROUP BY h),
judged AS (SELECT f.*, owners FROM free f JOIN spread USING (h) WHERE kind < {len(BASE)} OR owners = 1),
per AS (SELECT rid, {', '.join(f"count(*) FILTER (kind = {i}) AS n_{n}" for i, n in enumerate(BASE))},
    coalesce(string_agg(name || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, kind) FILTER (kind < {len(BASE)}), '') AS base,
    string_agg(name || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, kind) AS spans,
    count(*) FILTER (owners = 1) AS n_live, count(*) FILTER (owners >= {WIDE}) AS n_example FROM judged GROUP BY rid)
SELECT doc_id, {', '.join(f"CAST(coalesce(n_{n}, 0) AS BIGINT) AS n_{n}" for n in BASE)}, sha256(coalesce(base, '')) AS base_sha256,
    coalesce(spans, '') AS spans, CAST(coalesce(n_live, 0) AS BIGINT) AS n_live, CAST(coalesce(n_example, 0) AS BIGINT) AS n_example
FROM docs LEFT JOIN per USING (rid)
"""
