"""Cells cleaned in batches against the same cells cut and cleaned one by one."""

import random
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loadsieve.functions import parsers as P
from loadsieve.functions.text import NULL_TOKENS, NULL_TOKENS_V1, clean_text, whitespace
from loadsieve.operators import cells as C
from loadsieve.plans import load as L
from loadsieve.plans.spec import ColumnMeta, LoadSpec
from loadsieve.sources.grid import split_cells
from workload import loads

ODD = [
    "", " ", "\t a", "a ", "　x ", "\x85y\x85", "   z  \t", "é", " é ", "à", "á ", "€", "¿x?", "​z", " nan", "nan", "None", "NaN", "nano", "-", "--", "—", "–",
    "N/A", "n/a", "1", "-1", "+1", "1.", ".5", "-.5", ".", "-.", "1.2.3", "1e5", "1-", "1,5", "1.234,5", "np.float64(1.5)", "np.int64(3)", "inf", "-Infinity", "0x10", "5f", "5d", "٣",
    "1" * 17 + ".", "1" * 18, "1" * 19, "1" * 400, "0.1", "-0", "00012", "\x1f7", "\x7f1", "\x001", "4.35", "9007199254740993", "123456789.12345678", "01/02/2024", "2024-1-2", "ene-24",
    "45000", "true", "no", "Columna", "dato", "nulo",
]
SPEC = LoadSpec(
    target="t",
    columns=(
        ColumnMeta("fecha", "date"), ColumnMeta("periodo", "date"), ColumnMeta("total", "double precision"), ColumnMeta("tasa", "real"), ColumnMeta("exacto", "numeric(10,2)"),
        ColumnMeta("piezas", "integer"), ColumnMeta("activo", "boolean"), ColumnMeta("origen", "text", column_default="'hoja'::text"), ColumnMeta("nota", "text"), ColumnMeta("sin", "double precision", column_default="1.5"),
    ),
)


def values(rows):
    """Rows that compare, whatever is not a number in them."""
    return sorted(repr(r) for r in rows)


def odd_lines(width, n=400, seed=1):
    pick = random.Random(seed)
    return ["|".join(pick.choice(ODD) for _ in range(pick.choice([width] * 6 + [1, width - 1, width + 2]))) for _ in range(n)] + ["", "|", " ", "|" * width]


@pytest.mark.parametrize("tokens", [NULL_TOKENS, NULL_TOKENS_V1])
def test_cells_are_those_of_single_cleaning(spark, tokens):
    names = list("abcdefg")
    at = [3, 1, None, 7, 2, 9, 1]
    rows = [("f", i, at, line) for i, line in enumerate(odd_lines(8))]
    rows += [("g", i, [None] * 7, line) for i, line in enumerate(["x|y", "", "1"])]
    lines = spark.createDataFrame(rows, "file STRING, row_no BIGINT, at ARRAY<INT>, line STRING").coalesce(1)
    got = C.clean_cells(lines, names, ["b", "d"], "at", "|", tokens, True)
    cells = lines.withColumn("c", split_cells(F.col("line")))
    one = cells.select("file", "row_no", "at", *[clean_text(F.get("c", F.get("at", F.lit(i)) - 1), tokens).alias(n) for i, n in enumerate(names)])
    wanted = F.coalesce(*names).isNotNull() | ~F.exists("at", lambda x: x.isNotNull())
    assert values(got.select(one.columns).collect()) == values(one.where(wanted).collect())
    numbers = got.where(F.col(C.PLAIN + "b").isNotNull())
    both = numbers.select(F.col(C.PLAIN + "b").alias("x"), P.plain_number_of(F.col("b")).alias("y"), P.number_of(F.col("b")).alias("z")).collect()
    assert len(both) > 50 and all(r.x == r.y == r.z for r in both)


def test_plain_numbers_are_told_by_their_bytes():
    data = np.frombuffer("|".join(ODD).encode(), dtype=np.uint8)
    bounds = np.array([0, len(data)])
    starts, ends, _ = C.cut(data, bounds[:1], bounds[1:], ord("|"))
    plain = {t for t, p in zip(ODD, C.is_plain(data, starts, ends)) if p}
    assert plain == {"1", "-1", "1.", ".5", "-.5", "1" * 17 + ".", "1" * 18, "0.1", "-0", "00012", "4.35", "9007199254740993", "123456789.12345678", "45000"}


def test_every_white_space_is_trimmed():
    texts = [a + b + "x" + b + a for a in whitespace() for b in ("", " ", " ", "é")] + [w * 2 for w in whitespace()]
    clean = C.Cleaner("|", ["-"], [])
    _, (got,), _ = clean(pa.array(texts), [1])
    assert got.to_pylist() == [x.strip(whitespace()) for x in texts]


@pytest.mark.parametrize("spec", [replace(SPEC, header_row=1), replace(loads.FIXED, header_row=1)], ids=["generic", "fixed"])
def test_lines_of_files_are_staged_as_their_cells_are(spark, tmp_path, spec):
    names = [m.name for m in spec.inputs if m.name != "sin"]
    for f, seed in enumerate((1, 2)):
        head = "|".join(names if f == 0 else reversed(names))
        body = "\n".join([head, *(x.replace("\x85", "").replace(" ", "") for x in odd_lines(len(names), 150, seed))])
        (tmp_path / f"{f}.txt").write_bytes(body.encode() + b"\n01/02/2024|caf\xe9 \xe2\x82|\xff|7\n")
    mapped = L.map_files(spark, str(tmp_path), spec)
    assert mapped.lines is not None
    together, single = mapped.staged(), L.stage(mapped.rows, spec)
    assert together.schema.simpleString() == single.schema.simpleString()
    want = single.collect()
    assert len(want) > 250 and values(together.collect()) == values(want)
    slim = [r for r in mapped.staged(all_raw=False).collect()]
    assert all((r.raw is None) == (r.errores == "") for r in slim)
    assert values(r for r in slim if r.errores) == values(r for r in want if r.errores)


def test_wide_lines_meet_no_expression_for_each_cell_before_they_are_typed(spark, tmp_path):
    (tmp_path / "a.txt").write_text("|".join(m.name for m in loads.FIXED.inputs) + "\nx|y\n")
    staged = L.map_files(spark, str(tmp_path), replace(loads.FIXED, header_row=1)).staged(all_raw=False)
    plan = staged._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Generate inline" not in plan
    # the three columns that tell summary rows are looked at once more
    assert plan.count("trim(") < 10


def test_a_task_for_each_file_of_the_fixed_layout(spark, tmp_path, monkeypatch):
    rows = [(i * 31_250, 1) for i in range(40)]
    lines = spark.createDataFrame(rows, "l_orderkey BIGINT, l_linenumber INT")
    lines.withColumns({"l_shipdate": F.lit("2020-01-02").cast("date"), "l_extendedprice": F.lit(1.5)}).write.parquet(f"{tmp_path}/sf/lineitem.parquet")
    monkeypatch.setattr(loads, "shared_dir", lambda spark, name: f"{tmp_path}/{name}")
    tasks = []
    write = loads.L.load_files

    def load(spark, folder, *a, **b):
        tasks.extend(p.name.split("-")[1] for p in (tmp_path / "fixed").glob("f=*/part-*"))
        return write(spark, folder, *a, **b)

    monkeypatch.setattr(loads.L, "load_files", load)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    assert loads.load_fixed_files(spark, f"{tmp_path}/sf").count() == 40
    assert len(tasks) == 40 and len(set(tasks)) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
