"""Header names, header rows, mapping, missing columns and suggestions."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadsieve.functions.similarity import similarity
from loadsieve.functions.text import canonical_key
from loadsieve.operators import headers as H
from loadsieve.operators import mapping as M
from loadsieve.session import saved
from loadsieve.sources import grid
from workload import ducksql as D
from workload.fixtures import duck, frame, table

THRESHOLD = 0.78


def target_names(spark, d) -> list[str]:
    """Columns of the one target table, in ordinal order, as a spec lists them."""
    return [r["target"] for r in frame(spark, d, "targets").orderBy("ordinal").collect()]


def propose(spark, d):
    f = lambda name: frame(spark, d, name)
    return M.propose_mapping(f("feeds"), f("targets"), f("config_rules"), f("rules"), THRESHOLD)


def mapping(spark, d):
    """The proposal as a stored table, which is what the later steps read."""
    return saved(propose(spark, d), "mapping")


def feeds_list(spark, d):
    return frame(spark, d, "feeds").select("feed_id", "target_table").distinct()


def missing(spark, d, found=None):
    return M.missing_columns(found or mapping(spark, d), feeds_list(spark, d), frame(spark, d, "targets"))


def missing_columns(spark, d):
    return M.with_defaults(missing(spark, d), frame(spark, d, "target_defaults"))


def scored(spark, d):
    rows = grid.cells_to_rows(frame(spark, d, "grids"))
    return H.score_rows(rows, target_names(spark, d), THRESHOLD).drop("cells")


def q_similarity(spark, d):
    """Each part's header against the name of its part, distinct pairs once."""
    names = table(spark, d, "part").select(F.col("p_partkey"), F.col("p_name"))
    feeds = frame(spark, d, "feeds").withColumn(
        "p_partkey", F.substring("feed_id", 2, 20).cast("bigint") * 40 + F.col("ordinal") - 1
    )
    pairs = feeds.join(names, "p_partkey").select(
        canonical_key(F.col("raw_header")).alias("a"), canonical_key(F.col("p_name")).alias("b")
    )
    return pairs.distinct().select("a", "b", similarity("a", "b").alias("ratio"))


def best_match(spark, d):
    keys = frame(spark, d, "feeds").select("target_table", canonical_key(F.col("raw_header")).alias("key"))
    return M.best_matches(keys, frame(spark, d, "targets"), THRESHOLD)


def header_resolve(spark, d):
    scores = scored(spark, d)
    files = scores.select("file").distinct().withColumn("target_table", F.lit("parts"))
    number = F.substring("file", 2, 20).cast("bigint")
    asked = files.filter(number % 5 == 0).withColumn("header_row", F.lit(7))
    kept = files.filter(number % 3 == 0).withColumn("header_row", (number % 4 + F.when(number % 2 == 0, 1).otherwise(2)).cast("int"))
    return H.resolve_header(files, asked, kept, scores, H.detect_header(scores))


def neardup_report(spark, d):
    return H.near_repeat_report(frame(spark, d, "feeds"), mapping(spark, d)).select(
        "feed_id", "ordinal", "raw_header", "base_key", "detected_name", "target"
    )


def neardup_changed(spark, d):
    current = frame(spark, d, "feeds").select(
        F.col("feed_id").alias("target_table"), "raw_header", F.lower("raw_header").alias("target")
    )
    odd = F.col("target_table").rlike("[13579]$")
    saved = current.withColumn("target", F.when(odd & F.col("raw_header").startswith("S"), F.lit("x")).otherwise(F.col("target")))
    return H.approvals_changed(current, saved)


def alias_mapping(spark, d):
    aliases = table(spark, d, "part").select(
        canonical_key(F.col("p_name")).alias("key"), F.substring_index("p_name", " ", 1).alias("alias")
    )
    return M.alias_mapping(frame(spark, d, "feeds"), aliases.distinct())


def mapping_upsert(spark, d):
    history = frame(spark, d, "rule_history")
    old = history.filter(F.col("version") % 2 == 0).filter(~F.col("raw_header").startswith("Unnamed"))
    return M.merge_rules(old, history.filter(F.col("version") % 2 == 1))


def mapping_lookup(spark, d):
    return M.rules_by_key(frame(spark, d, "rule_history"))


def mapping_coverage(spark, d):
    found = mapping(spark, d)
    return M.coverage(found, missing(spark, d, found))


def mapping_suggest(spark, d):
    found = mapping(spark, d)
    return M.suggest(found, missing(spark, d, found), THRESHOLD)


def mapping_accept(spark, d):
    """Useful hints as rules to remember."""
    return M.accept_suggestions(mapping_suggest(spark, d), "parts", 7)


QUERIES = {
    "similarity": q_similarity,
    "best_match": best_match,
    "header_score": scored,
    "header_detect": lambda s, d: H.detect_header(scored(s, d)),
    "header_valid": lambda s, d: H.valid_headers(scored(s, d)),
    "header_resolve": header_resolve,
    "header_dedup_name": lambda s, d: H.name_headers(frame(s, d, "feeds")).drop("target_table"),
    "neardup_signature": lambda s, d: H.near_repeats(frame(s, d, "feeds")),
    "neardup_report": neardup_report,
    "neardup_changed": neardup_changed,
    "mapping_propose": propose,
    "mapping_apply": lambda s, d: M.column_names(mapping(s, d)).select("feed_id", "ordinal", "raw_header", "column_name"),
    "mapping_autoconfirm": lambda s, d: M.auto_confirm(mapping(s, d)),
    "mapping_low_conf": lambda s, d: M.low_confidence(mapping(s, d)),
    "mapping_coverage": mapping_coverage,
    "missing_columns": missing_columns,
    "mapping_suggest": mapping_suggest,
    "mapping_accept": mapping_accept,
    "mapping_upsert": mapping_upsert,
    "mapping_lookup": mapping_lookup,
    "alias_mapping": alias_mapping,
}


def _named() -> str:
    """Repeat-aware names, key by key."""
    return f"""
SELECT feed_id, ordinal, raw_header, name, {D.key("name")} AS key FROM (
 SELECT *, CASE kind WHEN 1 THEN trim(regexp_replace(txt,'[.][0-9]+$',''))||CAST(CAST(regexp_extract(txt,'([0-9]+)$',1) AS BIGINT)+1 AS VARCHAR)
   WHEN 2 THEN base||CAST(num AS VARCHAR) ELSE CASE WHEN turn = 1 THEN txt ELSE txt||CAST(turn AS VARCHAR) END END AS name
 FROM (SELECT *, row_number() OVER (PARTITION BY feed_id, {D.key("txt")}, kind ORDER BY ordinal) AS turn
  FROM (SELECT h.*, CASE WHEN regexp_matches(txt,'[.][0-9]+$') THEN 1
      WHEN num >= 2 AND EXISTS (SELECT 1 FROM heads o WHERE o.feed_id = h.feed_id AND o.txt = h.base) THEN 2 ELSE 3 END AS kind
    FROM heads h) a) b) c"""


HEADS = """heads AS (SELECT *, TRY_CAST(regexp_extract(txt,'([0-9]+)$',1) AS BIGINT) AS num, trim(regexp_extract(txt,'^(.*?)[0-9]+$',1)) AS base
 FROM (SELECT *, trim(raw_header) AS txt FROM feeds) f)"""


def _mapping_ctes() -> str:
    k_cfg = D.key("raw_header")
    return f"""feeds AS ({duck("feeds")}), targets AS ({duck("targets")}), {HEADS}, named AS ({_named()}),
tkeys AS (SELECT *, {D.key("target")} AS t_key FROM targets),
cfg AS (SELECT {k_cfg} AS key, max(target) AS target FROM ({duck("config_rules")}) q GROUP BY 1),
stored AS (SELECT {k_cfg} AS key, max(target) AS target FROM ({duck("rules")}) q GROUP BY 1),
keys AS (SELECT DISTINCT key FROM named WHERE key NOT IN (SELECT t_key FROM tkeys)),
pairs AS (SELECT key||'/'||t_key AS id, key AS a, t_key AS b FROM keys, tkeys
  WHERE 2.0*least(length(key),length(t_key))/(length(key)+length(t_key)) >= {THRESHOLD}),
ratios AS ({D.similarity("pairs")}),
ranked AS (SELECT p.a AS key, t.target, r.r, row_number() OVER (PARTITION BY p.a ORDER BY r.r DESC, t.ordinal) AS n
  FROM pairs p JOIN ratios r USING (id) JOIN tkeys t ON t.t_key = p.b WHERE r.r >= {THRESHOLD}),
cand AS (SELECT n.*, c.target AS c_t, s.target AS s_t, e.target AS e_t, b.target AS b_t, b.r,
  coalesce(c.target, s.target, e.target, b.target) AS claim
 FROM named n LEFT JOIN cfg c ON c.key = n.key LEFT JOIN stored s ON s.key = n.key LEFT JOIN tkeys e ON e.t_key = n.key
 LEFT JOIN ranked b ON b.key = n.key AND b.n = 1),
turned AS (SELECT *, CASE WHEN claim IS NOT NULL AND claim <> '__IGNORAR__' THEN
  row_number() OVER (PARTITION BY feed_id, claim ORDER BY ordinal) END AS turn FROM cand),
mapping AS (SELECT feed_id, 'parts' AS target_table, ordinal, raw_header, {D.snake("raw_header")} AS snake,
  CASE WHEN c_t IS NOT NULL OR s_t IS NOT NULL OR turn = 1 THEN claim ELSE '__IGNORAR__' END AS target,
  CASE WHEN c_t IS NOT NULL THEN 'config_map' WHEN s_t IS NOT NULL THEN 'mapping_ini'
    WHEN turn = 1 AND e_t IS NOT NULL THEN 'exact' WHEN turn = 1 THEN 'fuzzy'
    WHEN regexp_matches(trim(raw_header), '[.][0-9]+$') THEN 'excel_extra_duplicate' ELSE 'excel_extra' END AS method,
  CASE WHEN c_t IS NOT NULL OR s_t IS NOT NULL OR (turn = 1 AND e_t IS NOT NULL) THEN 1.0
    WHEN turn = 1 THEN round(r, 4) ELSE 0.0 END::DOUBLE AS score FROM turned)"""


def _scores_ctes() -> str:
    """Row scores of the grids, cell by cell."""
    return f"""grids AS ({duck("grids")}), targets AS ({duck("targets")}),
tkeys AS (SELECT *, {D.key("target")} AS t_key FROM targets),
cells AS (SELECT file, row_no, col_no, trim(value) AS txt, {D.key("value")} AS key FROM grids WHERE trim(value) <> ''),
keyed AS (SELECT *, row_number() OVER (PARTITION BY file, row_no, key ORDER BY col_no) AS turn FROM cells WHERE key <> ''),
others AS (SELECT DISTINCT key FROM keyed WHERE key NOT IN (SELECT t_key FROM tkeys)),
pairs AS (SELECT key||'/'||t_key AS id, key AS a, t_key AS b FROM others, tkeys
  WHERE 2.0*least(length(key),length(t_key))/(length(key)+length(t_key)) >= {THRESHOLD}),
ratios AS ({D.similarity("pairs")}),
best AS (SELECT a AS key, max(r) AS r FROM pairs JOIN ratios USING (id) GROUP BY a HAVING max(r) >= {THRESHOLD}),
worth AS (SELECT k.file, k.row_no, CASE WHEN turn = 1 THEN 0.25 ELSE -0.25 END +
  CASE WHEN k.key IN (SELECT t_key FROM tkeys) THEN 6.0 ELSE
    CASE WHEN b.r IS NOT NULL THEN 3.0 + b.r ELSE CASE WHEN regexp_matches(txt,'[a-zA-Z]') THEN 0.4 ELSE 0.0 END
      + CASE WHEN length(txt) <= 60 THEN 0.2 ELSE 0.0 END END
    - CASE WHEN regexp_full_match(lower(txt), 'unnamed[:\\s_0-9-]*') THEN 2.0 ELSE 0.0 END END AS w
  FROM keyed k LEFT JOIN best b ON b.key = k.key),
filled AS (SELECT g.file, g.row_no, count(*) FILTER (WHERE trim(value) <> '') AS n FROM grids g GROUP BY 1, 2),
scores AS (SELECT f.file, f.row_no, CASE WHEN n = 0 THEN -1.0
    ELSE round(coalesce((SELECT sum(w) FROM worth w WHERE w.file = f.file AND w.row_no = f.row_no), 0) + least(n,20)*0.15, 9)
  END::DOUBLE AS score FROM filled f),
detected AS (SELECT file, coalesce(min(row_no) FILTER (WHERE score >= 200),
  arg_min(row_no, struct_pack(s := -score, r := row_no))) AS header_row FROM scores GROUP BY file)"""


def oracles() -> dict[str, str]:
    m, s = f"WITH RECURSIVE {_mapping_ctes()}", f"WITH RECURSIVE {_scores_ctes()}"
    feeds = duck("feeds")
    pair_rows = f"""SELECT DISTINCT {D.key("raw_header")} AS a, {D.key("p_name")} AS b FROM ({feeds}) f
 JOIN part ON p_partkey = CAST(substr(feed_id, 2) AS BIGINT) * 40 + ordinal - 1"""
    named = f"WITH feeds AS ({feeds}), {HEADS}"
    near = f"""SELECT feed_id, ordinal, raw_header, {D.key("b")} AS base_key, b||CAST(n AS VARCHAR) AS detected_name FROM (
 SELECT h.*, CASE WHEN regexp_matches(txt,'[.][0-9]+$') THEN trim(regexp_replace(txt,'[.][0-9]+$','')) ELSE base END AS b,
  CASE WHEN regexp_matches(txt,'[.][0-9]+$') THEN num + 1
    WHEN num >= 2 AND EXISTS (SELECT 1 FROM heads o WHERE o.feed_id = h.feed_id AND o.txt = h.base) THEN num END AS n
 FROM heads h) x WHERE n IS NOT NULL"""
    rule_key = D.key(
        "CASE WHEN regexp_matches(trim(raw_header),'[.][0-9]+$') THEN trim(regexp_replace(trim(raw_header),'[.][0-9]+$',''))"
        "||CAST(CAST(regexp_extract(trim(raw_header),'([0-9]+)$',1) AS BIGINT)+1 AS VARCHAR) ELSE trim(raw_header) END"
    )
    dup = "CASE n WHEN 1 THEN {0} WHEN 2 THEN {0}||'__dup' ELSE {0}||'__dup'||CAST(n AS VARCHAR) END"
    gaps = """gaps AS (SELECT f.feed_id, 'parts' AS target_table, t.target FROM (SELECT DISTINCT feed_id FROM feeds) f, targets t
 WHERE NOT EXISTS (SELECT 1 FROM mapping m WHERE m.feed_id = f.feed_id AND m.target = t.target))"""
    hist = duck("rule_history")
    found = {
        "similarity": f"""WITH RECURSIVE p AS ({pair_rows}), pairs AS (SELECT a||'/'||b AS id, a, b FROM p),
ratios AS ({D.similarity("pairs")}) SELECT a, b, r::DOUBLE AS ratio FROM pairs JOIN ratios USING (id)""",
        "best_match": f"""WITH RECURSIVE feeds AS ({feeds}), targets AS ({duck("targets")}),
tkeys AS (SELECT *, {D.key("target")} AS t_key FROM targets), keys AS (SELECT DISTINCT {D.key("raw_header")} AS key FROM feeds),
pairs AS (SELECT key||'/'||t_key AS id, key AS a, t_key AS b FROM keys, tkeys
  WHERE 2.0*least(length(key),length(t_key))/(length(key)+length(t_key)) >= {THRESHOLD}),
ratios AS ({D.similarity("pairs")})
SELECT 'parts' AS target_table, key, best_target, r::DOUBLE AS ratio FROM (SELECT p.a AS key, t.target AS best_target, r.r,
  row_number() OVER (PARTITION BY p.a ORDER BY r.r DESC, t.ordinal) AS n
  FROM pairs p JOIN ratios r USING (id) JOIN tkeys t ON t.t_key = p.b WHERE r.r >= {THRESHOLD}) q WHERE n = 1""",
        "header_score": f"{s} SELECT * FROM scores",
        "header_detect": f"{s} SELECT * FROM detected",
        "header_valid": f"{s} SELECT * FROM scores WHERE score >= 10",
        "header_resolve": f"""{s}, files AS (SELECT file, header_row, CAST(substr(file,2) AS BIGINT) AS g FROM detected),
kept AS (SELECT g, g % 4 + CASE WHEN g % 2 = 0 THEN 0 ELSE 1 END AS r FROM files WHERE g % 3 = 0),
good AS (SELECT k.g, k.r FROM kept k JOIN scores s ON s.file = 'G'||CAST(k.g AS VARCHAR) AND s.row_no = k.r WHERE s.score >= 10)
SELECT 'parts' AS target_table, file, CASE WHEN f.g % 5 = 0 THEN 6 WHEN o.r IS NOT NULL THEN o.r ELSE header_row END AS header_row,
  CASE WHEN f.g % 5 = 0 THEN 'configured' WHEN o.r IS NOT NULL THEN 'stored' ELSE 'detected' END AS origin
FROM files f LEFT JOIN good o ON o.g = f.g""",
        "header_dedup_name": f"{named} {_named()}",
        "neardup_signature": f"{named} {near}",
        "neardup_report": f"""{m}, near AS ({near}) SELECT n.*, coalesce(m.target, '') AS target FROM near n
LEFT JOIN mapping m ON m.feed_id = n.feed_id AND m.ordinal = n.ordinal""",
        "neardup_changed": f"""SELECT feed_id AS target_table, bool_or(regexp_matches(feed_id,'[13579]$')
  AND starts_with(raw_header,'S') AND lower(raw_header) <> 'x') AS changed FROM ({feeds}) f GROUP BY feed_id""",
        "mapping_propose": f"{m} SELECT * FROM mapping",
        "mapping_apply": f"""{m} SELECT feed_id, ordinal, raw_header, {dup.format("target")} AS column_name FROM (SELECT *,
  row_number() OVER (PARTITION BY feed_id, target ORDER BY ordinal) AS n FROM mapping WHERE target <> '__IGNORAR__') q""",
        "mapping_autoconfirm": f"""{m} SELECT feed_id, count(*) FILTER (WHERE target <> '__IGNORAR__') > 0 AND
  count(*) FILTER (WHERE target <> '__IGNORAR__' AND (method NOT IN ('mapping_ini','config_map','exact')
    OR contains(snake,'__dup') OR target = 'errores')) = 0 AS auto_confirm FROM mapping GROUP BY feed_id""",
        "mapping_low_conf": f"{m} SELECT * FROM mapping WHERE score < 1 AND target <> '__IGNORAR__'",
        "mapping_coverage": f"""{m}, {gaps} SELECT feed_id, count(*) AS source_columns,
  count(*) FILTER (WHERE target <> '__IGNORAR__') AS mapped, count(*) FILTER (WHERE target = '__IGNORAR__') AS ignored,
  (SELECT count(*) FROM gaps g WHERE g.feed_id = m.feed_id) AS missing FROM mapping m GROUP BY feed_id""",
        "missing_columns": f"""{m}, {gaps} SELECT g.*, d.column_default AS default_expr,
  coalesce(d.column_default <> 'now()', false) AS has_literal_default, CASE WHEN d.column_default LIKE '%text' THEN 'x' WHEN
  d.column_default = 'FALSE' THEN 'false' WHEN d.column_default <> 'now()' THEN d.column_default END AS default_value
FROM gaps g JOIN ({duck("target_defaults")}) d USING (target)""",
        "mapping_accept": f"""SELECT 'parts' AS target_table, trim(suggested_header) AS raw_header, target, CAST(7 AS BIGINT) AS version
FROM (<SUGGEST>) s WHERE useful AND trim(coalesce(suggested_header, '')) <> ''""",
        "mapping_suggest": f"""{m}, {gaps},
left_out AS (SELECT feed_id, ordinal, raw_header, {D.key("raw_header")} AS key FROM mapping WHERE target = '__IGNORAR__'),
gkeys AS (SELECT *, {D.key("target")} AS t_key FROM gaps),
spairs AS (SELECT DISTINCT l.key||'/'||g.t_key AS id, l.key AS a, g.t_key AS b FROM left_out l JOIN gkeys g USING (feed_id)),
sratios AS ({D.similarity("spairs")}),
cross_all AS (SELECT g.feed_id, g.target, l.ordinal, l.raw_header, greatest(coalesce(r.r, 0), CASE WHEN l.key <> '' AND
   (contains(g.t_key, l.key) OR contains(l.key, g.t_key)) THEN 0.75 ELSE 0 END) AS w
  FROM gkeys g JOIN left_out l USING (feed_id) LEFT JOIN sratios r ON r.id = l.key||'/'||g.t_key),
top AS (SELECT *, row_number() OVER (PARTITION BY feed_id, target ORDER BY w DESC, ordinal) AS n FROM cross_all WHERE w > 0),
hint AS (SELECT feed_id, (SELECT count(*) FROM left_out l WHERE l.feed_id = f.feed_id) = 1
  AND (SELECT count(*) FROM gaps g WHERE g.feed_id = f.feed_id) = 1 AS one FROM (SELECT DISTINCT feed_id FROM feeds) f)
SELECT g.feed_id, g.target, CASE WHEN t.w > 0 THEN t.raw_header WHEN NOT h.one THEN '' END AS suggested_header,
  round(coalesce(t.w, 0), 4)::DOUBLE AS score, coalesce(t.w, 0) >= {THRESHOLD} OR h.one AS useful
FROM gaps g JOIN hint h USING (feed_id) LEFT JOIN top t ON t.feed_id = g.feed_id AND t.target = g.target AND t.n = 1""",
        "mapping_upsert": f"""SELECT target_table, raw_header, arg_max(target, version) AS target, max(version) AS version
FROM ({hist}) h WHERE NOT (version % 2 = 1 AND target = '__IGNORAR__') AND NOT starts_with(raw_header,'Unnamed')
GROUP BY target_table, raw_header""",
        "mapping_lookup": f"""SELECT target_table, {rule_key} AS key, arg_max(target, version) AS target FROM ({hist}) h GROUP BY 1, 2""",
        "alias_mapping": f"""WITH heads AS (SELECT feed_id, ordinal, raw_header, {D.key("raw_header", False)} AS key FROM ({feeds}) f),
aliases AS (SELECT DISTINCT {D.key("p_name")} AS key, split_part(p_name,' ',1) AS alias FROM part),
mapped AS (SELECT h.*, coalesce(a.alias, h.key) AS mapped FROM heads h LEFT JOIN aliases a USING (key))
SELECT feed_id, ordinal, raw_header, {dup.format("mapped")} AS column_name FROM (SELECT *,
  row_number() OVER (PARTITION BY feed_id, mapped ORDER BY ordinal) AS n FROM mapped) q""",
    }
    found["mapping_accept"] = found["mapping_accept"].replace("<SUGGEST>", found["mapping_suggest"])
    return found
