"""Order-dependent header operators against plain loops on small random feeds."""

import random
import re
from difflib import SequenceMatcher


from loadsieve.functions.text import canonical_key_py as key
from loadsieve.operators import headers as H
from loadsieve.operators import mapping as M

WORDS = ["Estado", "Fecha", "Año", "Total", "Id", "Fecha fin", "Detalle", "Unnamed: 3", "Estados", "Tipo", ""]
TARGETS = ["estado", "estado2", "fecha", "fecha_fin", "ano", "total", "detalle", "detalle3", "id_externo", "tipo"]
HEADERS = "feed_id STRING, target_table STRING, ordinal INT, raw_header STRING"
RULES = "target_table STRING, raw_header STRING, target STRING"


def random_feeds(seed, feeds=60, width=12):
    rng = random.Random(seed)
    suffix = ["", "", "", ".1", ".2", "2", " 3", "4", " (x)", ".07", "02"]
    return {
        f"f{n}": [rng.choice(WORDS) + rng.choice(suffix) for _ in range(rng.randrange(1, width))] for n in range(feeds)
    }


def as_frame(spark, feeds):
    rows = [(f, "t", i, h) for f, hs in feeds.items() for i, h in enumerate(hs, 1)]
    return spark.createDataFrame(rows, HEADERS)


def loop_names(headers):
    """Names one after the other, with a running count per key."""
    known, seen, out = {h.strip() for h in headers}, {}, []
    for h in headers:
        t = h.strip()
        if m := re.fullmatch(r"(.*)\.(\d+)", t):
            out.append(m[1].strip() + str(int(m[2]) + 1))
            continue
        m = re.fullmatch(r"(.*?)(\d+)", t)
        if m and int(m[2]) >= 2 and m[1].strip() in known:
            out.append(m[1].strip() + str(int(m[2])))
            continue
        k = key(t)
        seen[k] = seen.get(k, 0) + 1
        out.append(t if seen[k] == 1 else t + str(seen[k]))
    return out


def test_names_equal_loop(spark):
    feeds = random_feeds(1)
    got = H.name_headers(as_frame(spark, feeds)).orderBy("feed_id", "ordinal").collect()
    mine = {}
    for r in got:
        mine.setdefault(r["feed_id"], []).append(r["name"])
    assert mine == {f: loop_names(hs) for f, hs in feeds.items()}


def loop_mapping(headers, configured, stored, threshold):
    used, out = set(), []
    keys = {key(t): t for t in TARGETS}
    for raw, name in zip(headers, loop_names(headers)):
        k = key(name)
        if k in configured:
            found = (configured[k], "config_map", 1.0)
        elif k in stored:
            found = (stored[k], "mapping_ini", 1.0)
        elif k in keys and keys[k] not in used:
            found = (keys[k], "exact", 1.0)
        else:
            ratios = [SequenceMatcher(None, k, key(t)).ratio() for t in TARGETS]
            top = max(ratios)
            best = TARGETS[ratios.index(top)]
            extra = "excel_extra_duplicate" if re.search(r"\.\d+$", raw.strip()) else "excel_extra"
            fits = top >= threshold and best not in used and k not in keys
            found = (best, "fuzzy", round(top, 4)) if fits else (M.IGNORE, extra, 0.0)
        if found[0] != M.IGNORE:
            used.add(found[0])
        out.append(found)
    return out


def test_mapping_equals_loop(spark):
    feeds = random_feeds(2, feeds=120)
    targets = spark.createDataFrame(
        [("t", i, n) for i, n in enumerate(TARGETS, 1)], "target_table STRING, ordinal INT, target STRING"
    )
    configured = spark.createDataFrame([("t", "Tipo", "tipo")], RULES)
    stored = spark.createDataFrame([("t", "Estado.1", "estado2"), ("t", "Total", M.IGNORE), ("t", "Id", "id_externo")], RULES)
    mapping = M.propose_mapping(as_frame(spark, feeds), targets, configured, stored, 0.78)
    mine = {}
    for r in mapping.orderBy("feed_id", "ordinal").collect():
        mine.setdefault(r["feed_id"], []).append((r["target"], r["method"], r["score"]))
    pins = {"estado2": "estado2", "total": M.IGNORE, "id": "id_externo"}
    assert mine == {f: loop_mapping(hs, {"tipo": "tipo"}, pins, 0.78) for f, hs in feeds.items()}
    sure = {r["feed_id"]: r["auto_confirm"] for r in M.auto_confirm(mapping).collect()}
    for feed, rows in mine.items():
        kept = [m for t, m, _ in rows if t != M.IGNORE]
        assert sure[feed] == (bool(kept) and all(m in M.SURE_METHODS for m in kept))


def loop_score(cells, threshold):
    texts = [c.strip() for c in cells if c is not None and c.strip()]
    if not texts:
        return -1.0
    keys = [key(t) for t in TARGETS]
    score, seen = 0.0, set()
    for t in texts:
        k = key(t)
        if not k:
            continue
        score += -0.25 if k in seen else 0.25
        seen.add(k)
        if k in keys:
            score += 6
            continue
        best = max(SequenceMatcher(None, k, x).ratio() for x in keys)
        if best >= threshold:
            score += 3 + best
        else:
            score += (0.4 if re.search("[a-zA-Z]", t) else 0) + (0.2 if len(t) <= 60 else 0)
        if re.fullmatch(r"unnamed[:\s_0-9\-]*", t.lower()):
            score -= 2
    return round(score + min(len(texts), 20) * 0.15, 9)


def test_scores_and_detection_equal_loop(spark):
    rng = random.Random(4)
    cell = lambda: rng.choice([None, " ", "12,5", "-", rng.choice(WORDS), rng.choice(TARGETS), "x" * 70])
    grids = {f"g{n}": [[cell() for _ in range(6)] for _ in range(rng.randrange(1, 9))] for n in range(40)}
    rows = [(f, r, cells) for f, g in grids.items() for r, cells in enumerate(g)]
    df = spark.createDataFrame(rows, "file STRING, row_no BIGINT, cells ARRAY<STRING>")
    scored = H.score_rows(df, TARGETS)
    got = {(r["file"], r["row_no"]): r["score"] for r in scored.collect()}
    want = {(f, r): loop_score(cells, 0.78) for f, r, cells in rows}
    assert {k: round(v, 6) for k, v in got.items()} == {k: round(v, 6) for k, v in want.items()}
    # the stop level is lowered so that it takes effect
    for stop in (14.0, H.EARLY_STOP_SCORE):
        found = {r["file"]: r["header_row"] for r in H.detect_header(scored, stop).collect()}
        for f, g in grids.items():
            scores = [want[f, r] for r in range(len(g))]
            early = [r for r, s in enumerate(scores) if s >= stop]
            assert found[f] == (early[0] if early else scores.index(max(scores)))


def test_repeated_targets_get_a_suffix(spark):
    rows = [("f", i, f"h{i}", "estado") for i in range(1, 4)] + [("f", 4, "h4", M.IGNORE)]
    mapping = spark.createDataFrame(rows, "feed_id STRING, ordinal INT, raw_header STRING, target STRING")
    names = [r["column_name"] for r in M.column_names(mapping).orderBy("ordinal").collect()]
    assert names == ["estado", "estado__dup", "estado__dup3"]


def test_suggestion_rules(spark):
    mapping = spark.createDataFrame(
        [("a", 1, "Fech", M.IGNORE), ("a", 2, "zzz", M.IGNORE), ("b", 1, "qq", M.IGNORE)],
        "feed_id STRING, ordinal INT, raw_header STRING, target STRING",
    )
    missing = spark.createDataFrame([("a", "fecha"), ("a", "xx"), ("b", "tipo"), ("c", "tipo")], "feed_id STRING, target STRING")
    got = {(r["feed_id"], r["target"]): (r["suggested_header"], r["score"], r["useful"]) for r in M.suggest(mapping, missing).collect()}
    assert got == {
        ("a", "fecha"): ("Fech", 0.8889, True),
        ("a", "xx"): ("", 0.0, False),
        ("b", "tipo"): (None, 0.0, True),
        ("c", "tipo"): ("", 0.0, False),
    }


def test_feeds_may_be_wider_than_a_sheet(spark):
    wide = spark.createDataFrame([("f", "t", 20000, "x"), ("f", "t", 1, "y")], HEADERS)
    assert sorted(r["name"] for r in H.name_headers(wide).collect()) == ["x", "y"]


def test_tables_may_have_any_number_of_columns(spark):
    targets = spark.createDataFrame([("t", i, f"c{i}") for i in range(1, 1702)], "target_table STRING, ordinal INT, target STRING")
    assert M.target_arrays(targets).first()["names"][1700] == "c1701"


def evaluations(df):
    """Python steps of the plan that runs."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("ArrowEvalPython")


def test_similarity_runs_once(spark, sf_dir):
    from workload.headers import best_match, propose

    assert evaluations(best_match(spark, sf_dir)) == 1
    assert evaluations(propose(spark, sf_dir)) == 1
