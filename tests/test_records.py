"""Records of quoted cells with line breaks, at block sizes from a few bytes up, against a reader of whole files."""

import os
import random

import pytest
from pyspark.sql import functions as F

from loadsieve.plans import load as L
from loadsieve.sources import records
from tests.test_loads import NOW, SPEC, paths_at


def brute(text, sep):
    """Records and their cells, character by character."""
    lines = text.split("\n")
    if lines[-1] == "":
        lines.pop()
    found, cells, cell, at, inside, fresh = [], [], "", 0, False, True
    text = "\n".join(lines)

    def clean(raw):
        if len(raw) > 1 and raw[0] == raw[-1] == '"' and '"' not in raw[1:-1].replace('""', ""):
            return raw[1:-1].replace('""', '"')
        return raw

    while at <= len(text):
        if at == len(text) or (text[at] == "\n" and not inside):
            found.append([clean(c) for c in [*cells, cell]])
            cells, cell, fresh, inside = [], "", True, False
            at += 1
        elif inside:
            if text.startswith('""', at):
                cell, at = cell + '""', at + 2
            else:
                inside = text[at] != '"'
                cell, at = cell + text[at], at + 1
        elif text.startswith(sep, at):
            cells, cell, fresh, at = [*cells, cell], "", True, at + len(sep)
        else:
            inside = fresh and text[at] == '"'
            cell, fresh, at = cell + text[at], False, at + 1
    return found if lines else []


@pytest.fixture()
def small_blocks(spark):
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    yield lambda n: spark.conf.set(size, str(n))
    spark.conf.set(size, before)


def read(spark, folder, sep):
    got = records.scan_records(spark, str(folder), sep, 3)
    rows = got.numbered().select("file", "row_no", records.split_records(F.col("line"), sep).alias("cells")).collect()
    heads = {(os.path.basename(r["file"]), r["row_no"]): r["line"] for r in got.preview(3).collect()}
    by_file = {}
    for r in rows:
        by_file.setdefault(os.path.basename(r["file"]), {})[r["row_no"]] = r["cells"]
    lines = {(os.path.basename(r["file"]), r["row_no"]): r["line"] for r in got.numbered().collect()}
    assert heads == {k: v for k, v in lines.items() if k[1] < 3}
    return {f: [rows[i] for i in range(len(rows))] for f, rows in by_file.items()}


@pytest.mark.parametrize("sep", ["|", "||"])
def test_records_against_a_reader_of_whole_files(spark, tmp_path, small_blocks, sep):
    draw = random.Random(len(sep))
    texts = {}
    for n in range(8):
        bits = ['"', '""', sep, "\n", "a", "bc ", "é", "|", "\n"]
        texts[f"r{n}.txt"] = "".join(draw.choice(bits) for _ in range(draw.randint(0, 150)))
    for n in range(2):
        cell = lambda: draw.choice(["x", '"a\nb"', f'"q{sep}""\n""r"', "", '"\n\n\n"', "y" * 30])
        texts[f"s{n}.txt"] = "\n".join(sep.join(cell() for _ in range(4)) for _ in range(12)) + "\n"
    texts["open.txt"] = f'a{sep}"never\nclosed{sep}x\n' * 3
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    want = {n: brute(t, sep) for n, t in texts.items() if brute(t, sep)}
    for size in ((24, 300) if sep == "|" else (120,)):
        small_blocks(size)
        assert read(spark, tmp_path, sep) == want


def test_long_block_tables_are_joined(spark, tmp_path, small_blocks, monkeypatch):
    (tmp_path / "a.txt").write_text('1|"x\ny"|2\n3|4|5\n' * 40)
    small_blocks(60)
    joined = records._joined
    monkeypatch.setattr(records, "_joined", lambda *a: joined(*a, limit=1))
    got = records.scan_records(spark, str(tmp_path)).numbered()
    rows = {r["row_no"]: r["line"] for r in got.collect()}
    assert rows == {i: '1|"x\ny"|2' if i % 2 == 0 else "3|4|5" for i in range(80)}


def test_load_with_line_breaks(spark, tmp_path, small_blocks):
    source = tmp_path / "in"
    source.mkdir()
    rows = "".join(f'{i}|"dos\nlíneas {i}"|{i},5|si\n' for i in range(100))
    (source / "a.txt").write_text('"Informe\nde todo"\n\nId|Nota|Importe|"Activo"\n' + rows + '100|"x\ny"|malo|no\n')
    small_blocks(300)
    paths = paths_at(tmp_path)
    done, _ = L.load_files(spark, str(source), SPEC, paths, "a", NOW, multiline=True)
    assert (done.rows_read, done.rows_valid, done.rows_invalid) == (101, 100, 1)
    got = {r["id"]: r["nota"] for r in spark.read.parquet(paths.target).collect()}
    assert got == {i: f"dos\nlíneas {i}" for i in range(100)}
    bad = spark.read.parquet(paths.rejects).first()
    assert (bad["row_no"], bad["nota"], bad["errores"]) == (103, "x\ny", "importe")
