"""Loads from files to targets: row numbers, splits, repeats, retries, streaming."""

import datetime as dt
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from loadsieve.operators import report as R
from loadsieve.operators import validate as V
from loadsieve.plans import load as L
from loadsieve.plans.fixed_schema import AMOUNTS, fixed_schema_spec
from loadsieve.plans.spec import ColumnMeta, LoadSpec
from loadsieve.sources import catalog, grid, sinks, stores
from loadsieve.streaming.ingest import ingest

NOW = dt.datetime(2024, 5, 6, 7, 8, 9)
SPEC = LoadSpec(
    target="t",
    columns=(
        ColumnMeta("id", "integer"),
        ColumnMeta("fecha_inicio_proyecto", "date"),
        ColumnMeta("fecha_fin_proyecto", "date"),
        ColumnMeta("importe", "numeric(10,2)"),
        ColumnMeta("activo", "boolean"),
        ColumnMeta("nota", "text", column_default="'sin'::text"),
        ColumnMeta("fecha_carga", "timestamp without time zone"),
    ),
    fixed_values={"fecha_carga": "__now_ts__"},
)
RAW = "row_no BIGINT, id STRING, fecha_inicio_proyecto STRING, fecha_fin_proyecto STRING, importe STRING, activo STRING"
ROWS = [
    (1, "1", "01/02/2024", "2024-03-01", "1.234,56", "si"),
    (2, "2.6", "ayer", "2024-03-01", "1", "no"),
    (3, "3", "2024-04-01", "2024-03-01", "2", "no"),
    (4, "4", "1899-12-31", "x", "y", "quizá"),
    (5, " ", "-", "N/A", None, "--"),
    (6, "99999999999", None, None, "7", None),
    (7, "2.5", "46958", "46959", "99999999999", "1"),
]


def paths_at(tmp_path):
    return L.LoadPaths.under(str(tmp_path))


def load(spark, tmp_path, rows=ROWS, load_id="a", **options):
    df = spark.createDataFrame(rows, RAW)
    return L.load_rows(spark, df, SPEC, paths_at(tmp_path), load_id, NOW, keep=["row_no"], **options)


def test_reasons_and_values(spark):
    staged = L.stage(spark.createDataFrame(ROWS, RAW), SPEC, ["row_no"])
    got = {r["row_no"]: r for r in staged.collect()}
    assert {n: r["errores"] for n, r in got.items()} == {
        1: "",
        2: "fecha_inicio_proyecto",
        3: "rango_fechas_proyecto",
        4: "fecha_inicio_proyecto, fecha_fin_proyecto, importe, activo",
        6: "id",
        7: "importe",
    }
    assert got[2]["id"] == 3 and got[1]["nota"] == "sin" and str(got[1]["importe"]) == "1234.56"
    assert got[4]["fecha_inicio_proyecto"] is None and got[4]["raw"]["activo"] == "quizá"
    assert V.valid_rows(staged).count() + V.reject_rows(staged, SPEC, ["row_no"]).count() == staged.count()
    assert [r["reason"] for r in R.top_errors(staged, 2).collect()] == ["fecha_inicio_proyecto", "importe"]


def test_load_writes_everything_and_repeats_safely(spark, tmp_path):
    paths = paths_at(tmp_path)
    for _ in range(2):
        done = load(spark, tmp_path)
    assert (done.rows_read, done.rows_valid, done.rows_invalid, done.status) == (6, 1, 5, "_PARTIAL_ERROR")
    target = spark.read.parquet(paths.target)
    assert target.count() == 1 and target.first()["fecha_carga"] == NOW
    assert [c for c in target.columns if c != "load_id"] == [m.name for m in SPEC.insertable]
    assert spark.read.parquet(paths.rejects).count() == 5
    load(spark, tmp_path, load_id="b")
    assert spark.read.parquet(paths.target).count() == 2


def test_truncate_happens_even_without_loadable_rows(spark, tmp_path):
    load(spark, tmp_path)
    done = load(spark, tmp_path, ROWS[3:4], "b", pre_action=L.TRUNCATE)
    assert done.rows_valid == 0 and done.status is None
    target = spark.read.parquet(done.target_path)
    assert target.count() == 0 and target.columns == [m.name for m in SPEC.insertable] + ["load_id"]


def test_a_repeated_load_leaves_its_last_outcome(spark, tmp_path):
    paths = paths_at(tmp_path)
    good = [(i, str(i), "01/02/2024", "2024-03-01", "1", "si") for i in range(4)]
    bad = [(i, "x", "ayer", None, None, None) for i in range(4)]
    read = lambda p: spark.read.parquet(p).count()
    for action in (None, L.TRUNCATE):
        load(spark, tmp_path, good, "other")
        for rows in (ROWS, good, bad, good[:1] + bad[1:], good):
            done = load(spark, tmp_path, rows, pre_action=action)
            others = 0 if action else 4
            assert read(paths.target) == done.rows_valid + others
            assert spark.read.parquet(paths.rejects).where("load_id = 'a'").count() == done.rows_invalid
    assert len(set(spark.read.parquet(paths.staged).select("load_id").distinct().collect())) == 2


def test_load_ids_of_any_text(spark, tmp_path):
    done = load(spark, tmp_path, load_id="2024/05: a=b %")
    assert spark.read.parquet(done.target_path).first()["load_id"] == "2024/05: a=b %"


def ledger_of(spark, paths):
    return {r["load_id"]: r for r in stores.latest_events(spark.read.schema(stores.LEDGER).parquet(paths.ledger)).collect()}


def test_retries_follow_the_chain(spark, tmp_path):
    paths = paths_at(tmp_path)
    load(spark, tmp_path)  # rejects 2, 3, 4, 6, 7
    fix = lambda *ns: [(n, str(n), "01/01/2024", "02/01/2024", "1", "si") for n in ns]
    retry = lambda rows, load_id, parent: L.retry_load(spark, spark.createDataFrame(rows, RAW), SPEC, paths, load_id, parent, NOW, keep=["row_no"])
    ids = lambda: sorted(r["id"] for r in spark.read.parquet(paths.target).collect())

    done = retry(fix(2), "r1", "a")
    assert (done.rows_read, done.rows_valid) == (1, 1) and ledger_of(spark, paths)["a"]["event"] == stores.RETRY_OPEN
    done = retry(fix(2, 3) + [ROWS[3]], "r2", "a")  # 2 is in already, 4 is as bad as before
    assert (done.rows_read, done.rows_valid, done.rows_invalid) == (2, 1, 1) and ids() == [1, 2, 3]
    for _ in range(2):  # the same retry again
        done = retry(fix(4), "r3", "r2")
        assert done.rows_valid == 1 and ids() == [1, 2, 3, 4]
    now = ledger_of(spark, paths)
    assert now["r2"]["event"] == stores.RETRY_DONE and now["a"]["event"] == stores.RETRY_OPEN
    retry(fix(6, 7), "r4", "a")
    now = ledger_of(spark, paths)
    assert now["a"]["event"] == stores.RETRY_DONE and ids() == [1, 2, 3, 4, 6, 7]
    assert (now["a"]["rows_read"], now["a"]["rows_valid"], now["a"]["rows_invalid"]) == (6, 1, 5)
    assert now["r2"]["parent_load_id"] == "a"
    assert stores.open_retries(spark.read.schema(stores.LEDGER).parquet(paths.ledger)).count() == 0


def test_header_and_rows_beyond_the_first_block(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.txt").write_text("x" * 30000 + "\n\nId|Fecha inicio proyecto|Importe|Activo\n" + "".join(f"{i}|01/02/2024|3,5|si\n|||\n" for i in range(3000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        done, _ = L.load_files(spark, str(source), SPEC, paths_at(tmp_path), "a", NOW)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert (done.rows_read, done.rows_valid, done.rows_invalid) == (3000, 3000, 0)


def test_a_file_without_mapped_columns_keeps_its_rows(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.txt").write_text("zzzz|yyyy\n1|2\n\n3|4\n")
    (source / "b.txt").write_text("id|importe\n1|2\n|\n3|4\n")
    spec = LoadSpec(target="t", columns=SPEC.columns, fixed_values=SPEC.fixed_values, header_row=1)
    done, mapped = L.load_files(spark, str(source), spec, paths_at(tmp_path), "a", NOW)
    assert done.rows_read == 3 + 2 and mapped.needs_review()


def test_text_is_read_twice(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.txt").write_text("Id|Importe\n1|2\n")
    scans = []
    scan_lines, scan_blocks, number_lines = grid.scan_lines, grid.scan_blocks, grid.number_lines
    try:
        grid.scan_blocks = lambda *a, **b: scans.append("blocks") or scan_blocks(*a, **b)
        grid.number_lines = lambda *a, **b: scans.append("lines") or number_lines(*a, **b)
        mapped = L.map_files(spark, str(source), SPEC)
    finally:
        grid.scan_lines, grid.scan_blocks, grid.number_lines = scan_lines, scan_blocks, number_lines
    plan = mapped.rows._jdf.queryExecution().executedPlan().toString()
    assert scans == ["blocks", "lines"] and plan.count("FileScan text") == 1


def test_second_load_learns_from_the_first(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.txt").write_text("Informe\nId|Fechas inicio proyecto|Importe|Observaciones\n1|01/02/2024|x|n\n2|01/02/2024|1|m\n")
    paths = paths_at(tmp_path)
    done, mapped = L.load_files(spark, str(source), SPEC, paths, "a", NOW, only_sure=True)
    assert done is None and not os.path.exists(paths.target) and not os.path.exists(paths.rules)
    missing = {r["target"]: r for r in mapped.missing.collect()}
    assert missing["nota"]["default_expr"] == "'sin'::text" and missing["nota"]["has_literal_default"] and missing["nota"]["default_value"] == "sin"
    assert not missing["activo"]["has_literal_default"]
    coverage = mapped.coverage.first()
    assert (coverage["source_columns"], coverage["mapped"], coverage["ignored"], coverage["missing"]) == (4, 3, 1, 3)
    hints = {r["target"]: r["suggested_header"] for r in mapped.suggestions.where("useful").collect()}
    done, mapped = L.load_files(spark, str(source), SPEC, paths, "a", NOW, annotated=True)
    assert (done.rows_valid, done.rows_invalid) == (1, 1)
    assert [r["reason"] for r in done.top_reasons(spark).collect()] == ["importe"]
    assert sorted(r["errores"] for r in spark.read.parquet(done.annotated_path).collect()) == ["", "importe"]
    L.accept_hints(spark, mapped, SPEC, paths, 2_000_000_000_000)
    done, again = L.load_files(spark, str(source), SPEC, paths, "b", NOW, only_sure=True)
    assert done is not None and again.header_rows.first()["origin"] == "stored"
    methods = {r["raw_header"]: r["method"] for r in again.mapping.collect()}
    assert methods["Fechas inicio proyecto"] == "mapping_ini" and (methods["Observaciones"] == "mapping_ini") == ("nota" in hints)


def test_near_repeats_ask_for_approval_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.txt").write_text("Id|Id.1|Importe|Nota\n1|5|2|x\n")
    spec = replace(SPEC, column_map={"Id": "id", "Id.1": "activo", "Importe": "importe", "Nota": "nota"})
    paths = paths_at(tmp_path)
    run = lambda load_id, **more: L.load_files(spark, str(source), spec, paths, load_id, NOW, **more)
    done, mapped = run("a", only_sure=True)
    assert done is None and [(r["raw_header"], r["target"]) for r in mapped.asks_approval.collect()] == [("Id.1", "activo")]
    assert not os.path.exists(paths.review)
    L.approve(spark, mapped, paths, 1)
    done, _ = run("a", only_sure=True)
    assert done is not None
    review = spark.read.parquet(paths.review)
    assert sorted((r["raw_header"], r["target"], r["load_id"]) for r in review.select("raw_header", "target", "load_id").collect())[1] == ("Id.1", "activo", "a")
    (source / "a.txt").write_text("Id|Importe|Nota\n1|2|x\n")
    assert run("b", only_sure=True)[0] is None  # the approved ones are not there any more
    assert run("b")[0] is not None and run("c", only_sure=True)[0] is not None


@pytest.mark.parametrize("sep,quoted,line,cells", [
    ("^", False, "a^b^", ["a", "b", ""]),
    ("||", False, "a|b||c", ["a|b", "c"]),
    ("\t", False, "a\tb", ["a", "b"]),
    ("]", False, "a]b", ["a", "b"]),
    ("|", True, '"a ""x"""|b', ['a "x"', "b"]),
    ("|", True, '|"a|b"|', ["", "a|b", ""]),
    ("|", True, 'a "b" c|"d" e|"', ['a "b" c', '"d" e', '"']),
    ("||", True, '"a||b"||c|d||""', ["a||b", "c|d", ""]),
    (".", True, '"a.b".c', ["a.b", "c"]),
    ("|", True, "", [""]),
])
def test_cells(spark, sep, quoted, line, cells):
    df = spark.createDataFrame([(line,)], "line STRING")
    assert df.select(grid.cells_of(F.col("line"), sep, quoted)).first()[0] == cells


def test_stream_finds_layouts_and_keeps_row_numbers(spark, tmp_path):
    source = tmp_path / "in dir"
    source.mkdir()
    paths = paths_at(tmp_path)
    (source / "1 a.txt").write_text("Informe\n\nId|Fecha inicio proyecto|Importe|Activo\n1|01/02/2024|5|si\n2|x|1|no\n")
    (source / "2.txt").write_text("Activo|Id|Importe\nno|8|x\n")
    ingest(spark, str(source), None, SPEC, paths, str(tmp_path / "cp"), clock=lambda: NOW).awaitTermination()
    assert [r["id"] for r in spark.read.parquet(paths.target).collect()] == [1]
    rejects = {(os.path.basename(r["file"]).replace("%20", " "), r["row_no"]) for r in spark.read.parquet(paths.rejects).collect()}
    assert rejects == {("1 a.txt", 4), ("2.txt", 1)}


def test_alias_keys_of_the_fixed_layout(spark):
    from loadsieve.plans.fixed_schema import header_aliases

    pairs = {r["key"]: r["alias"] for r in header_aliases(spark, "grupo").collect()}
    assert len(pairs) == 74 and sorted(pairs.values()) == sorted(c.name for c in fixed_schema_spec("grupo").inputs)


def test_whole_numbers_are_exact(spark):
    spec = LoadSpec(target="t", columns=(ColumnMeta("b", "bigint"),))
    texts = ["9007199254740993", "-9223372036854775808", "9223372036854775808", "1.234.567,5", "0,5", "-2,5", "1e3", "x", "inf"]
    got = L.stage(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row_no INT, b STRING"), spec, ["row_no"]).orderBy("row_no").collect()
    assert [r["b"] for r in got] == [9007199254740993, -(2**63), None, 1234568, 1, -3, 1000, None, None]
    assert [r["errores"] for r in got] == ["", "", "b", "", "", "", "", "b", ""]


def test_retry_completes_its_parent(spark, tmp_path):
    paths = paths_at(tmp_path)
    load(spark, tmp_path)
    ledger = spark.read.schema(stores.LEDGER).parquet(paths.ledger)
    assert [r["load_id"] for r in stores.open_retries(ledger).collect()] == ["a"]
    # the whole sheet comes back corrected, with the row that went in before
    fixed = [(n, str(n), "01/01/2024", "02/01/2024", "1", "si") for n in (1, 2, 3, 4, 6, 7)]
    rows = spark.createDataFrame(fixed, RAW).withColumn("Errores", F.lit("old"))
    done = L.retry_load(spark, rows, SPEC, paths, "r", "a", NOW, keep=["row_no"])
    assert (done.rows_read, done.rows_valid, done.rows_invalid, done.status) == (5, 5, 0, None)
    assert sorted(r["id"] for r in spark.read.parquet(paths.target).collect()) == [1, 2, 3, 4, 6, 7]
    ledger = spark.read.schema(stores.LEDGER).parquet(paths.ledger)
    assert stores.open_retries(ledger).count() == 0


def test_row_numbers_when_files_are_split(spark, tmp_path):
    for name, n in (("a.txt", 5000), ("b.txt", 3), ("c.txt", 1700)):
        (tmp_path / name).write_text("".join(f"{name} line {i}\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        lines = grid.scan_lines(spark, str(tmp_path))
        assert lines.select("file", "block").distinct().count() > 8
        blocks = grid.scan_blocks(lines, 4)
        rows = grid.number_lines(lines, blocks).collect()
        head = grid.preview(blocks, 4).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 6703
    assert all(r["line"] == f"{r['file'].rsplit('/', 1)[1]} line {r['row_no']}" for r in rows + head)
    assert len(head) == 4 + 3 + 4


def test_load_of_files_with_different_layouts(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.txt").write_text("Informe\n\nId|Fecha inicio proyecto|Fecha fin proyect|Importe (EUR)|Activo\n1|01/02/2024|45400|3,5|si\n|||-|\n")
    (source / "b.txt").write_text('ACTIVO|"Importe (a|b)"|"Nota"|id|errores\nno|7|"uno|dos"|8|viejo\nno|x||9|\n')
    paths = paths_at(tmp_path)
    done, mapped = L.load_files(spark, str(source), SPEC, paths, "a", NOW, quoted=True)
    assert (done.rows_read, done.rows_valid, done.rows_invalid) == (3, 2, 1)
    rows = {r["id"]: r for r in spark.read.parquet(paths.target).collect()}
    assert rows[1]["fecha_fin_proyecto"] == dt.date(2024, 4, 18) and rows[1]["nota"] == "sin" and float(rows[1]["importe"]) == 3.5
    assert rows[8]["nota"] == "uno|dos" and rows[8]["activo"] is False
    missing = {(os.path.basename(r["feed_id"]), r["target"]) for r in mapped.missing.collect()}
    assert missing == {("a.txt", "nota"), ("b.txt", "fecha_inicio_proyecto"), ("b.txt", "fecha_fin_proyecto")}
    assert {os.path.basename(r["file"]): r["header_row"] for r in mapped.header_rows.collect()} == {"a.txt": 2, "b.txt": 0}


def test_stream_loads_each_file_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    heads = ["id", "fecha_inicio_proyecto", "fecha_fin_proyecto", "importe", "activo"]
    paths = paths_at(tmp_path)

    def run():
        ingest(spark, str(source), heads, SPEC, paths, str(tmp_path / "cp"), clock=lambda: NOW).awaitTermination()
        return sorted(r["id"] for r in spark.read.parquet(paths.target).collect())

    (source / "1.txt").write_text("1|01/02/2024|01/03/2024|5|si\n2|x||1|no\n")
    assert run() == [1]
    (source / "2.txt").write_text("3|||5,5|si\n")
    assert run() == [1, 3]
    assert run() == [1, 3]
    assert spark.read.parquet(paths.rejects).count() == 1


def test_delete_where_keeps_rows_with_null_condition(spark, tmp_path):
    old = spark.createDataFrame([(1, True), (2, False), (3, None)], "id INT, activo BOOLEAN")
    sinks.write_load(old, str(tmp_path / "t"), "old")
    new = spark.createDataFrame([(4, True)], "id INT, activo BOOLEAN")
    sinks.write_replace_where(new, spark, str(tmp_path / "t"), str(tmp_path / "n"), F.col("activo"), "new")
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "n")).collect()) == [2, 3, 4]


def test_newest_file(spark, tmp_path):
    for name, at in (("a.txt", 1_000_000_000), ("b.txt", 1_500_000_000), ("c.csv", 1_600_000_000)):
        (tmp_path / name).write_text("x")
        os.utime(tmp_path / name, (at, at))
    assert grid.pick_file(spark, str(tmp_path), pattern="*.txt").endswith("b.txt")
    assert grid.pick_file(spark, str(tmp_path), "a.txt").endswith("a.txt")
    with pytest.raises(FileNotFoundError):
        grid.pick_file(spark, str(tmp_path), pattern="*.xyz")


def test_spec_from_catalogue(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS sieve_test")
    spark.sql("DROP TABLE IF EXISTS sieve_test.t1")
    spark.sql("CREATE TABLE sieve_test.t1 (id INT, d DATE DEFAULT DATE'2024-01-01', n DECIMAL(8,2), f BOOLEAN, s STRING DEFAULT 'x') USING parquet")
    spec = catalog.spec_from_catalog(spark, "sieve_test.t1")
    assert [(c.name, c.family) for c in spec.columns] == [("id", "integer"), ("d", "date"), ("n", "decimal"), ("f", "boolean"), ("s", "text")]
    assert spec.columns[4].column_default == "'x'"
    assert "sieve_test" in catalog.list_schemas(spark) and catalog.list_tables(spark, "sieve_test") == ["t1"]
    assert catalog.table_exists(spark, "sieve_test", "t1") and not catalog.schema_exists(spark, "nowhere")
    with pytest.raises(ValueError):
        catalog.spec_from_catalog(spark, "sieve_test.t2")
    spark.sql("DROP DATABASE sieve_test CASCADE")


def test_fixed_schema_layout():
    spec = fixed_schema_spec("grupo")
    assert len(spec.columns) == 80 and len(spec.inputs) == 74 and len(AMOUNTS) == 31
    assert [c.name for c in spec.columns][:3] == ["fecha_carga", "periodo", "operacion_cdg"]


def test_no_shuffle_before_the_write(spark):
    staged = L.stage(spark.createDataFrame(ROWS, RAW), SPEC, ["row_no"])
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
