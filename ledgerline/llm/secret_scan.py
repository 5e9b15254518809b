"""Secret scans with an incremental blob ledger, in DataFrame functions only.

Every version of a file is content-addressed. The ledger holds the (blob, rule version)
pairs that were scanned, with their findings; a scan takes only blobs that are new under
the current rule version, once each, and joins findings back to all paths.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str  # Java syntax, leftmost matches that don't overlap
    gate: str  # a match contains a match of this cheaper pattern
    group: int = 0
    least: int = 0  # code points that the group must have
    base: bool = True


# Fixed patterns of the base rules, in the order that breaks ties.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]""",
        2,
        12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", r"AKIA[A-Z0-9]{14}", 0, 18),
    Rule("hex", r"[0-9a-f]+", r"[0-9a-f]{16}", 0, 16),
)
#: What this scan adds: spans of key blocks' headers and of prefixed service tokens.
ADDED_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"PRIVATE KEY-----", base=False),
    Rule("prefixed", r"(?:gh[pousr]_|xox[abpr]-|glpat-)[A-Za-z0-9_-]{20,}", r"gh[pousr]_|xox[abpr]-|glpat-", base=False),
)
RULES = BASE_RULES + ADDED_RULES
RULE_VERSION = "1"


def _matches(rule: Rule, order: int) -> Column:
    """Array of (place, before, long, value) of all matches: length of the text since the last match,
    length of the match and of the group that must be long enough. Null where the gate is closed."""
    text, p = F.col("text"), F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, p, F.lit(0))
    value = F.regexp_extract_all(text, p, F.lit(rule.group)) if rule.group else whole
    between = F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(whole))
    rows = F.arrays_zip(F.transform(between, F.length), F.transform(whole, F.length), F.transform(value, F.length))
    rows = F.transform(
        rows,
        lambda x, i: F.struct(
            F.lit(order).alias("kind_no"), i.alias("place"), x["0"].alias("before"), x["1"].alias("long"), x["2"].alias("value")
        ),
    )
    return F.when(text.rlike(rule.gate), rows)


def _found(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """blob, kind_no, start, end of every span in blobs(blob, text)."""
    none = F.array().cast("array<struct<kind_no:int,place:int,before:int,long:int,value:int>>")
    rows = F.concat(*(F.coalesce(_matches(r, i), none) for i, r in enumerate(rules)))
    least = F.element_at(F.array(*(F.lit(r.least) for r in rules)), F.col("kind_no") + 1)
    end = F.sum(F.col("before").cast("long") + F.col("long")).over(Window.partitionBy("blob", "kind_no").orderBy("place"))
    return (
        blobs.where(F.col("text").rlike("|".join(f"(?:{r.gate})" for r in rules)))
        .select("blob", F.inline(rows))
        .withColumn("end", end)
        .where(F.col("value") >= least)
        .select("blob", "kind_no", (F.col("end") - F.col("long")).alias("start"), "end")
    )


LEDGER = "blob string, rules string, spans array<struct<start: bigint, kind_no: int, end: bigint>>"


def scan(
    versions: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    rule_version: str = RULE_VERSION,
    ledger: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(the rows of ``versions`` with blob and spans, the new entries of the ledger).

    ``versions`` has a column text, null meaning empty, and any others: a path, a version. They
    come back but for ones named blob or spans. ``ledger`` (blob, rules, spans) holds earlier
    scans; pairs in it are not scanned again. ``spans``: sorted (start, kind_no, end) in code
    points, end exclusive; empty where nothing was found. Rows that repeat are kept.
    """
    spark = versions.sparkSession
    versions = versions.drop("blob", "spans").withColumn("blob", F.sha2(F.coalesce("text", F.lit("")), 256))
    known = (ledger if ledger is not None else spark.createDataFrame([], LEDGER)).where(F.col("rules") == rule_version)
    known = known.dropDuplicates(["blob"])
    unseen = versions.select("blob", F.coalesce("text", F.lit("")).alias("text"))
    if ledger is not None:
        unseen = unseen.join(known, "blob", "left_anti")
    unseen = unseen.dropDuplicates(["blob"])  # one copy of each blob leaves a map task
    found = (
        _found(unseen, rules)
        .groupBy("blob")
        .agg(F.array_sort(F.collect_list(F.struct("start", "kind_no", "end"))).alias("spans"))
    )
    found = common.written(found, "findings")
    none = F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint>>")
    every = found if ledger is None else found.unionByName(known.where("size(spans) > 0").select("blob", "spans"))
    rows = versions.join(every, "blob", "left").withColumn("spans", F.coalesce("spans", none))
    scanned = versions.select("blob").distinct()
    if ledger is not None:
        scanned = scanned.join(known, "blob", "left_anti")
    entries = scanned.join(found, "blob", "left").select(
        "blob", F.lit(rule_version).alias("rules"), F.coalesce("spans", none).alias("spans")
    )
    return rows, entries


def joined(spans: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind_no"] + 1), s["start"], s["end"])), ","
    )


def op6_secret_scan(spark, sf_dir) -> DataFrame:
    """The documents as the first versions of paths, under an empty ledger."""
    rows, _ = scan(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda i: F.size(F.filter("spans", lambda s: s["kind_no"] == i)).cast("long")
    base = F.filter("spans", lambda s: s["kind_no"] < len(BASE_RULES))
    return rows.select(
        "doc_id",
        *(count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE_RULES)),
        F.sha2(joined(base, RULES), 256).alias("base_sha256"),
        joined(F.col("spans"), RULES).alias("spans"),
    )


def _sql_spans(kind: str, pattern: str, group: int, least: int, order: int) -> str:
    p = pattern.replace("'", "''")
    return f"""
      SELECT doc_id, {order} AS kind_no, '{kind}' AS kind, stop - long AS start, stop FROM (
        SELECT doc_id, long, value, sum(before + long) OVER (PARTITION BY doc_id ORDER BY place) AS stop FROM (
          SELECT doc_id, unnest(range(1, len(m) + 1)) AS place, unnest(list_transform(m, lambda x: length(x))) AS long,
                 unnest(list_transform(v, lambda x: length(x))) AS value,
                 unnest(list_transform(b[1:len(m)], lambda x: length(x))) AS before
          FROM (SELECT doc_id, regexp_extract_all(text, '{p}') AS m, regexp_extract_all(text, '{p}', {group}) AS v,
                       string_split_regex(text, '{p}') AS b FROM texts)))
      WHERE value >= {least}"""


def op6_sql() -> str:
    parts = " UNION ALL ".join(
        _sql_spans(r.kind, r.pattern.replace(r"\x20", " "), r.group, r.least, i) for i, r in enumerate(RULES)
    )
    one = "kind || ':' || start || ':' || stop"
    n = len(BASE_RULES)
    counts = ", ".join(
        f"coalesce(count(*) FILTER (kind_no = {i}), 0)::BIGINT AS n_{r.kind}" for i, r in enumerate(BASE_RULES)
    )
    return f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    spans AS ({parts})
    SELECT d.doc_id, {counts},
           sha256(coalesce(string_agg({one}, ',' ORDER BY start, kind_no) FILTER (kind_no < {n}), '')) AS base_sha256,
           coalesce(string_agg({one}, ',' ORDER BY start, kind_no), '') AS spans
    FROM documents d LEFT JOIN spans s USING (doc_id) GROUP BY d.doc_id"""
