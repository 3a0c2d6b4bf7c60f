"""Registered queries: each applies one operator, with production parameters,
to its whole table and gives the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import (decontaminate, interp_lm, license_rules, mixing, periodic_runs, quality_rank,
                           secret_scan, simhash, suffix_dedup, topk_va, toxicity_crf, turn_repair, winnow_prints)
from lodestone.llm.common import id_bucket, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op1_suffix_dedup")
def op1(spark, sf):
    return suffix_dedup.remove_repeats(read_table(spark, sf, "documents"), least=200).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@register("op2_mix_sources")
def op2(spark, sf):
    return mixing.mix(read_table(spark, sf, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


@register("op9_simhash_near_dedup")
def op9(spark, sf):
    found = simhash.near_duplicates(read_table(spark, sf, "documents"), shingle_words=4, radius=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        "component_id")


OP3_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS vec
           FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.vec, c.vec) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.vec) = len(c.vec) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rk FROM s)
SELECT query_id, CAST(rk AS INTEGER) AS rank, vec_id, score FROM r WHERE rk <= 5
"""


@register("op3_exact_top_k", OP3_SQL)
def op3(spark, sf):
    return topk_va.search(read_table(spark, sf, "embeddings"), F.col("id") % 50 == 0, k=5)


@register("op4_toxicity_crf")
def op4(spark, sf):
    docs = read_table(spark, sf, "documents")
    model = toxicity_crf.train(docs, read_table(spark, sf, "labels"))
    found = toxicity_crf.annotate(docs, model)
    return found.select(F.col("row.doc_id").alias("doc_id"), held_out("row.doc_id", 5, 0),
                        F.col("found.score").alias("score"),
                        (F.col("found.score") >= 0.5).cast("int").alias("predicted"),
                        F.col("found.n_toxic").alias("n_toxic"), F.col("found.spans").alias("spans"))


def held_out(id_col: str, mod: int, fold: int):
    return (id_bucket(F.col(id_col), mod) == fold).alias("held_out")


OP5_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i, w
       FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM bw),
lens AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, lens WHERE len(w) >= n),
grams AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k FROM dw),
hits AS (SELECT g.doc_id, g.i, g.n, win.item_id FROM grams g JOIN win ON g.k = win.k AND g.n = win.n),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM
           (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM
        (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@register("op5_benchmark_decontamination", OP5_SQL)
def op5(spark, sf):
    found = decontaminate.annotate(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"),
                                   window_words=13)
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit",
                        F.size("hit_items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"), "contaminated")


def _op6_sql(gap: int = 2) -> str:
    number = {name: i + 1 for i, name in enumerate(license_rules.SENTENCES)}
    known = ", ".join(f"('{license_rules.normalise(t)}', {number[n]})" for n, t in license_rules.SENTENCES.items())
    rules = ", ".join(f"('{lic}', {[number[n] for n in names]})" for lic, names in license_rules.RULES)
    norm = rf"trim(regexp_replace(lower(regexp_replace(x, '{license_rules.CLAUSE}', '')), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
    return rf"""
WITH known(sentence, id) AS (VALUES {known}), rules(license, want) AS (VALUES {rules}),
d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '([.!?;:])[ \t\r\f\n]+', '\1' || chr(10) || chr(10), 'g') AS t
      FROM documents),
s AS (SELECT doc_id, 'line' AS kind, string_split(t, chr(10)) AS raw FROM d
      UNION ALL SELECT doc_id, 'flow', string_split_regex(t, '\n[ \t\r\f]*\n') FROM d),
c AS (SELECT doc_id, kind, list_filter(list_transform(raw, lambda x: {norm}), lambda x: x <> '') AS said FROM s),
u AS (SELECT doc_id, kind, unnest(range(len(said))) AS pos, unnest(said) AS sentence FROM c),
a AS (SELECT doc_id, kind, list(id ORDER BY pos) AS ids, list(pos ORDER BY pos) AS ats
      FROM u JOIN known USING (sentence) GROUP BY doc_id, kind),
p AS (SELECT *, unnest(range(1, len(ids) + 1)) AS n FROM a),
m AS (SELECT doc_id, kind, license, ats[n] AS low, ats[n + len(want) - 1] AS high FROM p, rules
      WHERE ids[n:n + len(want) - 1] = want
      AND len(list_filter(range(1, len(want)), lambda i: ats[n + i] - ats[n + i - 1] > {gap} + 1)) = 0),
k AS (SELECT DISTINCT * FROM m WHERE NOT EXISTS (SELECT 1 FROM m b WHERE b.doc_id = m.doc_id AND b.kind = m.kind
      AND b.low <= m.low AND b.high >= m.high AND b.high - b.low > m.high - m.low)),
g AS (SELECT doc_id, list_sort(list(DISTINCT license)) AS licenses,
      string_agg(license || ':' || low || ':' || high, ',' ORDER BY low) FILTER (WHERE kind = 'line') AS lines,
      string_agg(license || ':' || low || ':' || high, ',' ORDER BY low) FILTER (WHERE kind = 'flow') AS flow
      FROM k GROUP BY doc_id)
SELECT c.doc_id, CAST(len(said) AS BIGINT) AS n_sentences, CAST(coalesce(len(licenses), 0) AS BIGINT) AS n_licenses,
       coalesce(array_to_string(licenses, ','), '') AS licenses, coalesce(lines, '') AS line_matches,
       coalesce(flow, '') AS flow_matches
FROM c LEFT JOIN g USING (doc_id) WHERE c.kind = 'line'"""


@register("op6_license_rules", _op6_sql())
def op6(spark, sf):
    found = license_rules.annotate(read_table(spark, sf, "documents"))

    def told(col):
        return F.concat_ws(",", F.transform(col, lambda m: F.concat_ws(":", m["license"], m["first"], m["last"])))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_sentences",
                        F.size("licenses").cast("long").alias("n_licenses"),
                        F.concat_ws(",", "licenses").alias("licenses"),
                        told("line_matches").alias("line_matches"), told("flow_matches").alias("flow_matches"))


@register("op7_quality_rank")
def op7(spark, sf):
    docs = read_table(spark, sf, "documents")
    model = quality_rank.train(docs, read_table(spark, sf, "labels"), cut=0.3)
    found = quality_rank.annotate(docs, model)
    return found.select(F.col("row.doc_id").alias("doc_id"), held_out("row.doc_id", 5, 0), "score",
                        (F.col("score") >= 0.3).cast("int").alias("predicted"))


@register("op8_secret_scan")
def op8(spark, sf):
    found = secret_scan.annotate(read_table(spark, sf, "documents"))
    return found.select(F.col("row.doc_id").alias("doc_id"), F.col("found.n_assign").alias("n_assign"),
                        F.col("found.n_access").alias("n_access"), F.col("found.n_hex").alias("n_hex"),
                        F.sha2(F.col("found.base"), 256).alias("base_sha256"),
                        F.col("found.spans").alias("spans"))


@register("op10_deleted_interpolation")
def op10(spark, sf):
    return interp_lm.score(read_table(spark, sf, "documents"))


@register("op11_periodic_runs")
def op11(spark, sf):
    found = periodic_runs.annotate(read_table(spark, sf, "documents"), change=periodic_runs.plant_repeats)
    runs, best = F.col("found.runs"), F.get(F.col("found.runs"), F.col("found.best").cast("int"))
    told = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(F.col("key").alias("doc_id"), F.size(runs).cast("long").alias("n_runs"),
                        best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
                        F.expr("1000 * found.runs[found.best].length div found.runs[found.best].period")
                        .alias("exponent_milli"),
                        F.sha2(F.concat_ws("", told), 256).alias("runs_sha256"),
                        F.sha2(F.col("found.collapsed"), 256).alias("collapsed_sha256"))


@register("op12_winnow_prints")
def op12(spark, sf):
    return winnow_prints.compare_next(read_table(spark, sf, "documents"))


@register("op13_turn_repair")
def op13(spark, sf):
    turns = turn_repair.damage(read_table(spark, sf, "conversations"))
    return turn_repair.repair(turns, copies_col="copies")


@register("pipeline")
def pipeline(spark, sf):
    from corpus_pipeline import run
    return run(spark, sf)
