"""File scans, sinks, load status, retries and whole loads."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadsieve.operators import mapping as M
from loadsieve.operators import report as R
from loadsieve.plans import load as L
from loadsieve.plans.fixed_schema import fixed_schema_spec, header_aliases
from loadsieve.plans.spec import ColumnMeta, LoadSpec
from loadsieve.session import saved, shared_dir, small_frame
from loadsieve.sources import commits, grid, records, sinks, stores
from loadsieve.streaming.ingest import ingest
from workload import ducksql as D
from workload.fixtures import duck, frame, table
from workload.parsing import RENAMED, SPEC, dirty

LOAD_TIME = datetime(2024, 5, 6, 7, 8, 9)

# Rows of a feed file: orders by blocks of 1,000 keys.
FILE_OF = "CAST(floor(k / 1000) AS BIGINT)"

SHEET = LoadSpec(
    target="orders_in",
    columns=(
        ColumnMeta("id_fila", "bigint"),
        ColumnMeta("fecha_pedido", "date"),
        ColumnMeta("importe_total", "double precision"),
        ColumnMeta("pedido_activo", "boolean"),
        ColumnMeta("origen", "text", column_default="'hoja'::text"),
        ColumnMeta("creador", "text"),
        ColumnMeta("id", "bigint", is_identity=True),
    ),
    fixed_values={"creador": "Massive Import"},
    period_columns=("fecha_pedido",),
)


def sheets(spark, d, title="Informe de pedidos", heads=None) -> str:
    """Write the dirty orders as text files like sheets: title, blank line, header, rows.

    Files differ in header spelling and column order. Returns the folder.
    """
    rows = frame(spark, d, "dirty_orders").withColumn("f", F.expr(FILE_OF))
    odd = F.col("f") % 2 == 1
    plain = F.concat_ws("|", "k", "raw_date", "raw_total", "raw_flag")
    turned = F.concat_ws("|", "raw_flag", "raw_total", "k", "raw_date")
    body = rows.select("f", (F.col("k") + 3).alias("at"), F.when(odd, turned).otherwise(plain).alias("value"))
    files = rows.select("f").distinct()
    head = F.when(
        F.col("f") % 2 == 1, "PEDIDO ACTIVO|Importe Total (EUR)|Id Fila|Fechas Pedido"
    ).otherwise("Id fila|Fecha pedido|Importe totl|Pedido activo")
    head = F.lit(heads) if heads else head
    top = files.select(
        "f", F.posexplode(F.array(F.lit(title), F.lit(""), head)).alias("at", "value")
    ).select("f", (F.col("at") - 10).cast("bigint").alias("at"), "value")
    folder = shared_dir(spark, "sheets")
    (
        body.unionByName(top)
        .repartition("f")
        .sortWithinPartitions("f", "at")
        .select("f", "value")
        .write.partitionBy("f")
        .text(folder)
    )
    return folder


def _file_number(c):
    return F.regexp_extract(c, "/f=([0-9]+)/", 1).cast("bigint")


def scan_grid(spark, d):
    lines = grid.number_lines(grid.scan_lines(spark, sheets(spark, d)))
    return lines.filter(F.col("row_no") > 2).select(
        _file_number(F.col("file")).alias("f"), "row_no", grid.split_cells(F.col("line")).alias("cells")
    ).select("f", "row_no", F.concat_ws("~", "cells").alias("cells"))


def scan_delimited(spark, d):
    """Lines with several delimiters, some cells quoted, with delimiters and quotes inside."""
    rows = frame(spark, d, "dirty_orders").select("k", *[F.coalesce(c, F.lit("")).alias(c) for c in ("raw_date", "raw_total", "raw_flag")])
    out = []
    for sep, quoted in (("^", False), ("||", False), ("||", True), ("|", True)):
        if quoted:
            inside = F.concat(F.lit('"a'), F.lit(sep), F.col("raw_date"), F.lit(' ""x"" "'))
            cells = [F.col("k").cast("string"), inside, F.concat(F.lit('"'), F.col("raw_total"), F.lit('"')), F.lit('b "c" d'), F.lit("")]
        else:
            cells = [F.col("k").cast("string"), F.col("raw_date"), F.col("raw_total"), F.col("raw_flag"), F.lit("")]
        folder = shared_dir(spark, "delimited")
        rows.select(F.concat_ws(sep, *cells).alias("value")).write.text(folder)
        read = grid.cells_of(F.col("line"), sep, quoted)
        name = F.lit(f"{sep}{quoted}")
        out.append(grid.scan_lines(spark, folder).select(name.alias("kind"), F.concat_ws("~", read).alias("cells"), F.size(read).alias("width")))
    return reduce(DataFrame.unionByName, out)


def broken_lines(spark, d) -> str:
    """Sheets of the dirty orders whose quoted cells hold delimiters, quotes and line breaks."""
    rows = frame(spark, d, "dirty_orders").withColumn("f", F.expr(FILE_OF))
    note = F.expr("CASE k % 4 WHEN 0 THEN '\"a|\n\"\"b\"\"\n\"' WHEN 1 THEN '\"\n' || k || '\n\n\"' WHEN 2 THEN 'c\"d' ELSE '' END")
    cells = F.concat_ws("|", F.col("k").cast("string"), note, *[F.coalesce(c, F.lit("")) for c in ("raw_date", "raw_total", "raw_flag")])
    head = rows.select("f").distinct().select("f", F.lit(-1).cast("bigint").alias("k"), F.lit('Id fila|"Origen\n"|Fecha pedido|Importe total|Pedido activo').alias("value"))
    folder = shared_dir(spark, "broken-lines")
    files = rows.select("f", "k", cells.alias("value")).unionByName(head)
    files.repartition("f").sortWithinPartitions("f", "k").select("f", "value").write.partitionBy("f").text(folder)
    return folder


def _in_small_blocks(spark, work, size=20_000):
    """Run work with file blocks of so many bytes, whose edges cut many records.

    A block a task would make the tasks grow with the blocks, by the ten thousands, each with a start of its own; so blocks share
    tasks, eight to a core, that stream through them.
    """
    return _with_settings(spark, {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.maxPartitionNum": 8 * spark.sparkContext.defaultParallelism}, work)


def _with_settings(spark, settings, work):
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        return work()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def scan_line_breaks(spark, d):
    """Records of several lines, numbered by record, whatever blocks their lines lie in."""

    def work():
        read = records.scan_records(spark, broken_lines(spark, d)).numbered().where(F.col("row_no") > 0)
        cells = F.concat_ws("~", records.split_records(F.col("line"), "|")).alias("cells")
        return saved(read.select(_file_number(F.col("file")).alias("f"), "row_no", cells), "read-records")

    return _in_small_blocks(spark, work)


def load_line_breaks(spark, d):
    """A load of sheets with line breaks in their cells and in a header."""
    paths = _paths(spark)
    _in_small_blocks(spark, lambda: L.load_files(spark, broken_lines(spark, d), SHEET, paths, "first", LOAD_TIME, multiline=True))
    return sheet_target(spark, paths)


def latest_file(spark, d):
    files = table(spark, d, "events").select(
        "event_type", F.concat(F.lit("f"), F.col("event_id")).alias("path"), F.col("ts").alias("modificationTime")
    )
    return grid.latest_file(files, ["event_type"])


def _paths(spark) -> L.LoadPaths:
    return L.LoadPaths.under(shared_dir(spark, "load"))


def _load(spark, d, paths, rows=None, **options):
    rows = dirty(spark, d) if rows is None else rows
    return L.load_rows(spark, rows, SPEC_K, paths, "first", LOAD_TIME, keep=["k"], **options)


SPEC_K = LoadSpec(
    target="orders_in",
    columns=(*SPEC.columns, ColumnMeta("creador", "text")),
    fixed_values={"creador": "Massive Import"},
    period_columns=SPEC.period_columns,
)
TARGET = "fecha DATE, total DOUBLE, activo BOOLEAN, creador STRING, load_id STRING"
REJECTS = "k BIGINT, fecha STRING, total STRING, activo STRING, errores STRING, load_id STRING"


def _seed(spark, d, path):
    """Earlier contents of the target: rejected or not, the plainly readable totals of `part`."""
    sinks.write_load(_old_rows(spark, d), path, "old")


def _old_rows(spark, d):
    return table(spark, d, "part").select(
        F.expr("date_add(DATE'2020-01-01', p_size)").alias("fecha"),
        F.col("p_retailprice").alias("total"),
        (F.col("p_size") % 2 == 0).alias("activo"),
        F.col("p_brand").alias("creador"),
    )


def append_load(spark, d):
    paths = _paths(spark)
    _seed(spark, d, paths.target)
    _load(spark, d, paths)
    return spark.read.schema(TARGET).parquet(paths.target)


def overwrite_load(spark, d):
    paths = _paths(spark)
    _seed(spark, d, paths.target)
    _load(spark, d, paths, pre_action=L.TRUNCATE)
    return spark.read.schema(TARGET).parquet(paths.target)


def replace_where_load(spark, d):
    paths = _paths(spark)
    _seed(spark, d, paths.target)
    action = L.DeleteWhere(F.col("activo"), paths.target + "_new")
    done = _load(spark, d, paths, pre_action=action)
    return spark.read.schema(TARGET).parquet(done.target_path)


def atomic_load(spark, d):
    """What readers see of a target before, during and after a load that is a transaction, and after loads that were
    killed: one before it published, one between its writes. Reports rows by moment."""
    paths = L.LoadPaths.under(shared_dir(spark, "load"), atomic=True)
    _seed_commit(spark, d, paths, "old")
    seen = lambda moment: paths.read_table(spark, "target").select(F.lit(moment).alias("moment"), "*")
    before = seen("before")
    killed = commits.Attempt(spark, paths.log, "killed")
    killed.write(_old_rows(spark, d), paths.target, "target")
    killed.truncate(paths.target, "target")
    during = seen("during")
    _load(spark, d, paths)
    return before.unionByName(during).unionByName(seen("after"))


def delete_where_load(spark, d):
    """Delete-where in a transaction over a target of several loads, and on a target that is not there yet."""
    paths, fresh = (L.LoadPaths.under(shared_dir(spark, "load"), atomic=True) for _ in range(2))
    for n in range(3):
        _seed_commit(spark, d, paths, f"old {n}", F.col("creador").endswith(str(n + 1)))
    out = []
    for name, p in (("there", paths), ("absent", fresh)):
        _load(spark, d, p, pre_action=L.DeleteWhere(F.col("activo")))
        out.append(p.read_table(spark, "target").select(F.lit(name).alias("target"), "*"))
    return out[0].unionByName(out[1])


def _seed_commit(spark, d, paths, load_id, condition=None):
    old = commits.Attempt(spark, paths.log, load_id)
    rows = _old_rows(spark, d)
    old.write(rows if condition is None else rows.where(condition), paths.target, "target")
    old.publish()


def reject_sink(spark, d):
    paths = _paths(spark)
    _load(spark, d, paths)
    return spark.read.schema(REJECTS).parquet(paths.rejects)


def load_generic(spark, d):
    paths = _paths(spark)
    L.load_files(spark, sheets(spark, d), SHEET, paths, "first", LOAD_TIME)
    return sheet_target(spark, paths)


def header_beyond_block(spark, d):
    """Sheets whose title is longer than a file block, so that the header lies in a later block."""
    paths = _paths(spark)
    folder = sheets(spark, d, title="Informe de pedidos " * 2000)
    _in_small_blocks(spark, lambda: L.load_files(spark, folder, SHEET, paths, "first", LOAD_TIME), 9_000)
    return sheet_target(spark, paths)


def sheet_target(spark, paths):
    names = ", ".join(f"{c.name} {c.spark_type}" for c in SHEET.insertable)
    return spark.read.schema(names + ", load_id STRING").parquet(paths.target).drop("load_id")


def load_unmapped_file(spark, d):
    """Sheets without a header that maps: their rows stay, with defaults and fixed values only."""
    paths = _paths(spark)
    folder = sheets(spark, d, heads="zzz|yyyy|xxxxx|wwww")
    L.load_files(spark, folder, replace(SHEET, header_row=3), paths, "first", LOAD_TIME)
    return sheet_target(spark, paths)


def load_repeat(spark, d):
    """The same load three times: all rows, half of them, and (truncating, elsewhere) only rejects."""
    rows = dirty(spark, d)
    paths, other = _paths(spark), _paths(spark)
    _load(spark, d, paths)
    _load(spark, d, paths, rows.where(F.col("k") % 2 == 0))
    _load(spark, d, other)
    _load(spark, d, other, rows.withColumn("fecha", F.lit("ayer")), pre_action=L.TRUNCATE)
    read = lambda kind, p, columns: spark.read.parquet(p).select(F.lit(kind).alias("kind"), *columns, "load_id")
    none = F.lit("").alias("errores")
    typed = [F.col(c).cast("string").alias(c) for c in ("fecha", "activo")]
    return (
        read("target", paths.target, [*typed, none])
        .unionByName(read("rejects", paths.rejects, [*typed, F.col("errores")]))
        .unionByName(read("truncated", other.target, [*typed, none]))
    )


def load_learns_mapping(spark, d):
    """What the second load of the same kind of sheets finds remembered."""
    paths = _paths(spark)
    L.load_files(spark, sheets(spark, d), SHEET, paths, "first", LOAD_TIME)
    _, again = L.load_files(spark, sheets(spark, d), SHEET, paths, "second", LOAD_TIME, only_sure=True)
    return again.mapping.select(_file_number(F.col("feed_id")).alias("f"), "ordinal", "raw_header", "target", "method", "score")


FIXED = fixed_schema_spec("grupo")
# Rows of a fixed-layout file: lines by blocks of 250,000 keys, some 60 MB of text.
FIXED_FILE_OF = "CAST(floor(k / 250000) AS BIGINT)"
# Bytes of such files, which are not split, that are read by a task: a file is most often larger.
FIXED_BLOCK = 4 << 20
# Tasks at most that write such files.
FIXED_WRITERS = 10_000


def fixed_cells() -> dict[str, str]:
    """SQL of the text of every input of the fixed layout, from a dirty line's number k."""
    cells = {}
    for i, c in enumerate(FIXED.inputs):
        if c.family == "date":
            cells[c.name] = f"'{1 + i % 28:02d}/06/'||CAST(2001 + k % 20 AS STRING)" if c.name != "fecha_fin_proyecto" else "'2030-06-30'"
        elif c.family == "number":
            cells[c.name] = f"CASE k % 9 WHEN {i % 9} THEN 'nan' ELSE CAST(k % 1000 + {i} AS STRING)||'.5' END"
        else:
            cells[c.name] = f"'{c.name[:4]} '||CAST((k + {i}) % 97 AS STRING)"
    return cells


def load_fixed_files(spark, d):
    """Fixed-schema load from files, headers by the alias table, all inputs filled."""
    keys = {r["alias"]: r["key"] for r in header_aliases(spark, "grupo").collect()}
    names = [c.name for c in FIXED.inputs]
    cells = fixed_cells()
    # only keys are shuffled and sorted, as the wide lines follow from them; a file holds so many keys, so that files grow in number, not in size
    keyed = frame(spark, d, "dirty_lineitem").select("k", F.expr(FIXED_FILE_OF).alias("f"), F.lit(False).alias("head"))
    head = keyed.select(F.lit(-1).cast("long").alias("k"), "f", F.lit(True).alias("head")).distinct()
    value = F.when(F.col("head"), "|".join(keys[n] for n in names)).otherwise(F.concat_ws("|", *[F.expr(cells[n]) for n in names]))
    folder = shared_dir(spark, "fixed")
    tasks = min(max(1, keyed.select(F.count_distinct("f")).first()[0]), FIXED_WRITERS)
    files = keyed.unionByName(head).repartitionByRange(tasks, "f").sortWithinPartitions("f", "k").select("f", value.alias("value"))
    # files follow one another in a task: open writers would only bring a sort of the wide lines, once there are more files than writers
    writer = files.write.partitionBy("f").options(compression="gzip", **{"zlib.compress.level": "THREE"})
    _with_settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": 0}, lambda: writer.text(folder))
    paths = _paths(spark)
    spec = replace(FIXED, header_row=1)
    aliases = header_aliases(spark, "grupo")
    # a packed file is several times its size when it is read, so tasks do not take as many bytes of them as of others
    _in_small_blocks(spark, lambda: L.load_files(spark, folder, spec, paths, "first", LOAD_TIME, aliases=aliases), FIXED_BLOCK)
    columns = ", ".join(f"{c.name} {c.spark_type}" for c in spec.insertable)
    return spark.read.schema(columns + ", load_id STRING").parquet(paths.target).drop("load_id")


def load_fixed_schema(spark, d):
    """Fixed-schema load of the lines: headers by alias table, plain numbers, 80 target columns."""
    base = frame(spark, d, "dirty_lineitem")
    lines = base.select(
        "k",
        F.col("raw_date").alias("Periodo"),
        F.concat(F.lit("OP"), F.col("k") % 100).alias("Operación CdG"),
        F.when(F.col("k") % 17 == 0, "Nulos").otherwise(F.col("k").cast("string")).alias("ID"),
        F.when(F.col("k") % 13 == 0, "31/12/2050").otherwise("01/01/2001").alias("Fecha Inicio Proyecto"),
        F.lit("2030-06-30").alias("Fecha Fin Proyecto"),
        F.col("raw_total").alias("Ventas"),
        F.when(F.col("k") % 2 == 0, "nan").otherwise(" 12.5 ").alias("Costes indirectos de mercado"),
        F.col("raw_flag").alias("País"),
        F.lit("x").alias("Sin destino"),
    )
    heads = [c for c in lines.columns if c != "k"]
    feed = small_frame(spark, [("f", i, h) for i, h in enumerate(heads, 1)], "feed_id STRING, ordinal INT, raw_header STRING")
    names = M.alias_mapping(feed, header_aliases(spark, "grupo")).orderBy("ordinal")
    pairs = [(r["raw_header"], r["column_name"]) for r in names.collect()]
    spec = fixed_schema_spec("grupo")
    paths = _paths(spark)
    L.load_rows(spark, M.apply_mapping(lines, pairs, ("k",)), spec, paths, "first", LOAD_TIME, keep=["k"])
    columns = ", ".join(f"{c.name} {c.spark_type}" for c in spec.insertable)
    return spark.read.schema(columns + ", load_id STRING").parquet(paths.target).drop("load_id")


def fixed_row(df):
    """Correction of rejected rows: an unreadable date becomes a readable one."""
    wrong = F.array_contains(F.split("errores", ", "), "fecha")
    return df.withColumn("fecha", F.when(wrong, "01/02/2003").otherwise(F.col("fecha")))


def retry_merge(spark, d):
    """A load and its retries: one that corrects half of its rejects, a retry of that one, run twice,
    and one of the first load again, with rows that are all in by then."""
    paths = _paths(spark)
    _load(spark, d, paths)
    rejects = lambda load: spark.read.schema(REJECTS).parquet(paths.rejects).filter(F.col("load_id") == load).drop("load_id")
    retry = lambda rows, load, parent: L.retry_load(spark, rows, SPEC_K, paths, load, parent, LOAD_TIME, keep=["k"])
    half = F.col("k") % 2 == 0
    first = rejects("first")
    retry(fixed_row(first.filter(half)).unionByName(first.filter(~half)), "r1", "first")
    for _ in range(2):
        retry(fixed_row(rejects("r1")), "r2", "r1")
    retry(fixed_row(first), "r3", "first")
    return spark.read.schema(TARGET).parquet(paths.target)


def header_rows_store(spark, d):
    """Stored header positions: the newest per target table and file."""
    history = table(spark, d, "orders").select(
        F.concat(F.lit("t"), F.col("o_custkey") % 7).alias("target_table"),
        F.concat(F.lit("f"), F.col("o_custkey")).alias("file"),
        (F.col("o_orderkey") % 9 + 1).cast("int").alias("header_row"),
        F.col("o_orderkey").alias("version"),
    )
    return stores.latest_header_rows(history)


def stream_ingest(spark, d):
    folder = shared_dir(spark, "incoming")
    lines = frame(spark, d, "dirty_orders").select(F.concat_ws("|", "raw_date", "raw_total", "raw_flag").alias("value"))
    lines.write.text(folder)
    paths = _paths(spark)
    query = ingest(
        spark, folder, list(RENAMED.values()), SPEC_K, paths, shared_dir(spark, "checkpoint"), "orders_feed",
        clock=lambda: LOAD_TIME,
    )
    query.awaitTermination()
    return spark.read.schema(TARGET).parquet(paths.target).drop("load_id")


def stream_layouts(spark, d):
    """Intake of sheets that differ in layout: each batch finds its header rows and mapping."""
    paths = _paths(spark)
    folder = sheets(spark, d) + "/*"
    query = ingest(spark, folder, None, SHEET, paths, shared_dir(spark, "checkpoint"), "sheets_feed", clock=lambda: LOAD_TIME)
    query.awaitTermination()
    return sheet_target(spark, paths)


QUERIES = {
    "scan_grid": scan_grid,
    "scan_delimited": scan_delimited,
    "scan_line_breaks": scan_line_breaks,
    "load_line_breaks": load_line_breaks,
    "atomic_load": atomic_load,
    "delete_where_load": delete_where_load,
    "header_beyond_block": header_beyond_block,
    "load_unmapped_file": load_unmapped_file,
    "load_repeat": load_repeat,
    "load_learns_mapping": load_learns_mapping,
    "load_fixed_files": load_fixed_files,
    "stream_layouts": stream_layouts,
    "latest_file": latest_file,
    "append_load": append_load,
    "overwrite_load": overwrite_load,
    "replace_where_load": replace_where_load,
    "reject_sink": reject_sink,
    "header_rows_store": header_rows_store,
    "retry_ledger": lambda s, d: stores.open_retries(frame(s, d, "ledger")).select("load_id", "source", "event", "version"),
    "load_status": lambda s, d: R.load_status(frame(s, d, "loads")),
    "retry_status": lambda s, d: R.retry_status(frame(s, d, "loads")),
    "retry_merge": retry_merge,
    "load_generic": load_generic,
    "load_fixed_schema": load_fixed_schema,
    "stream_ingest": stream_ingest,
}


def oracles() -> dict[str, str]:
    base = duck("dirty_orders")
    staged = D.staged(base)
    kept = "(raw_date IS NOT NULL OR raw_total IS NOT NULL OR raw_flag IS NOT NULL)"
    fresh = f"""SELECT fecha, CASE WHEN isinf(total) THEN NULL ELSE total END AS total, activo, 'Massive Import' AS creador,
  'first' AS load_id FROM ({staged}) s WHERE errores = '' AND {kept}"""
    old = """SELECT DATE '2020-01-01' + p_size AS fecha, p_retailprice AS total, p_size % 2 = 0 AS activo, p_brand AS creador,
  'old' AS load_id FROM part"""
    again = D.staged(
        f"""SELECT k, CASE WHEN list_contains(string_split(errores, ', '), 'fecha') THEN '01/02/2003' ELSE raw_date END AS raw_date,
  raw_total, raw_flag FROM ({staged}) s WHERE errores <> '' AND {kept}"""
    )
    loads = duck("loads")
    status = """CASE WHEN rows_valid > 0 AND parent_load_id IS NULL THEN
  CASE WHEN rows_invalid > 0 THEN '_PARTIAL_ERROR' ELSE '_OK' END END"""
    v1 = D.clean("raw_date", ("", "nan", "None"))
    total = D.clean("raw_total", ("", "nan", "None"))
    amounts = fixed_schema_spec("grupo").insertable
    named = {
        "fecha_carga": "TIMESTAMP '2024-05-06 07:08:09'",
        "fecha_creacion": "DATE '2024-05-06'",
        "fecha_ult_modificacion": "DATE '2024-05-06'",
        "creador": "'Massive Import'",
        "ult_modificador": "'Massive Import'",
        "deleted_row": "false",
        "periodo": "d",
        "operacion_cdg": "'OP'||CAST(k % 100 AS VARCHAR)",
        "id_externo": "CASE WHEN k % 17 = 0 THEN 'Nulos' ELSE CAST(k AS VARCHAR) END",
        "fecha_inicio_proyecto": "CASE WHEN k % 13 = 0 THEN DATE '2050-12-31' ELSE DATE '2001-01-01' END",
        "fecha_fin_proyecto": "DATE '2030-06-30'",
        "ventas": "n",
        "costes_indirectos_mercado": "CASE WHEN k % 2 = 0 THEN NULL ELSE 12.5 END::DOUBLE",
        "pais": f"{D.clean('raw_flag', ('', 'nan', 'None'))}",
    }
    kinds = {"string": "VARCHAR", "double": "DOUBLE", "date": "DATE"}
    columns = ", ".join(
        f"{named[c.name]} AS {c.name}" if c.name in named else f"CAST(NULL AS {kinds[c.spark_type]}) AS {c.name}"
        for c in amounts
    )
    sheet_rows = f"""SELECT k AS id_fila, fecha AS fecha_pedido, total AS importe_total, activo AS pedido_activo,
  'hoja' AS origen, 'Massive Import' AS creador FROM ({staged}) s WHERE errores = ''"""
    text_of = lambda c: f"coalesce({c}, '')"
    values = fixed_cells()

    def fixed_value(c) -> str:
        if c.name in FIXED.fixed_values:
            return named[c.name]
        if c.name == "fecha_fin_proyecto":
            return "DATE '2030-06-30'"
        if c.family == "date":
            return f"CAST(strptime({values[c.name]}, '%d/%m/%Y') AS DATE)"
        return f"TRY_CAST(nullif({values[c.name]}, 'nan') AS DOUBLE)" if c.family == "number" else values[c.name]

    fixed_columns = ", ".join(f"{fixed_value(c)} AS {c.name}" for c in FIXED.insertable)
    plain_cells = "concat_ws('~', CAST(k AS VARCHAR), {0}, {1}, {2}, '')".format(*map(text_of, ("raw_date", "raw_total", "raw_flag")))
    quoted_cells = lambda sep: f"""concat_ws('~', CAST(k AS VARCHAR), 'a{sep}'||{text_of("raw_date")}||' "x" ', {text_of("raw_total")}, 'b "c" d', '')"""
    even = f"({staged}) s WHERE k % 2 = 0 AND {kept}"
    heads_of = """SELECT f, unnest(range(1, 5))::INTEGER AS ordinal, unnest(CASE WHEN f % 2 = 1 THEN
  ['PEDIDO ACTIVO','Importe Total (EUR)','Id Fila','Fechas Pedido'] ELSE ['Id fila','Fecha pedido','Importe totl','Pedido activo'] END) AS raw_header,
  unnest(CASE WHEN f % 2 = 1 THEN ['pedido_activo','importe_total','id_fila','fecha_pedido']
    ELSE ['id_fila','fecha_pedido','importe_total','pedido_activo'] END) AS target"""
    note = r"""CASE k % 4 WHEN 0 THEN 'a|'||chr(10)||'"b"'||chr(10) WHEN 1 THEN chr(10)||k||chr(10)||chr(10) WHEN 2 THEN 'c"d' ELSE '' END"""
    # what the cell becomes as a value: trimmed, and a blank one takes the column's default
    note_value = f"coalesce(nullif(trim({note}, ' '||chr(10)), ''), NULL)"
    return {
        "scan_line_breaks": f"""SELECT CAST(floor(k / 1000) AS BIGINT) AS f,
  CAST(row_number() OVER (PARTITION BY CAST(floor(k / 1000) AS BIGINT) ORDER BY k) AS BIGINT) AS row_no,
  concat_ws('~', CAST(k AS VARCHAR), {note}, {", ".join(map(text_of, ("raw_date", "raw_total", "raw_flag")))}) AS cells FROM ({base}) q""",
        "load_line_breaks": f"""SELECT k AS id_fila, fecha AS fecha_pedido, total AS importe_total, activo AS pedido_activo,
  {note_value} AS origen, 'Massive Import' AS creador FROM ({staged}) s WHERE errores = ''""",
        "atomic_load": f"""SELECT 'before' AS moment, * FROM ({old}) a UNION ALL SELECT 'during', * FROM ({old}) b
UNION ALL SELECT 'after', * FROM ({old} UNION ALL {fresh}) c""",
        "delete_where_load": f"""SELECT 'there' AS target, * FROM (SELECT fecha, total, activo, creador, 'old '||(CAST(right(creador, 1) AS INTEGER) - 1) AS load_id
  FROM ({old}) o WHERE NOT coalesce(activo, false) AND right(creador, 1) IN ('1', '2', '3') UNION ALL {fresh}) t
UNION ALL SELECT 'absent', * FROM ({fresh}) n""",
        "scan_delimited": " UNION ALL ".join(
            f"SELECT '{sep}{quoted}' AS kind, {quoted_cells(sep) if quoted else plain_cells} AS cells, 5 AS width FROM ({base}) q"
            for sep, quoted in (("^", False), ("||", False), ("||", True), ("|", True))
        ),
        "header_beyond_block": sheet_rows,
        "stream_layouts": sheet_rows,
        "load_unmapped_file": f"""SELECT CAST(NULL AS BIGINT) AS id_fila, CAST(NULL AS DATE) AS fecha_pedido, CAST(NULL AS DOUBLE) AS importe_total,
  CAST(NULL AS BOOLEAN) AS pedido_activo, 'hoja' AS origen, 'Massive Import' AS creador FROM ({base}) q""",
        "load_repeat": f"""SELECT 'target' AS kind, CAST(fecha AS VARCHAR) AS fecha, CAST(activo AS VARCHAR) AS activo, '' AS errores,
  'first' AS load_id FROM {even} AND errores = ''
UNION ALL SELECT 'rejects', raw_date, raw_flag, errores, 'first' FROM {even} AND errores <> ''""",
        "load_learns_mapping": f"""SELECT *, 'mapping_ini' AS method, 1.0::DOUBLE AS score FROM (
  {heads_of} FROM (SELECT DISTINCT {FILE_OF} AS f FROM ({base}) q) files) h""",
        "load_fixed_files": f"SELECT {fixed_columns} FROM ({duck('dirty_lineitem')}) q",
        "scan_grid": f"""SELECT CAST(floor(k / 1000) AS BIGINT) AS f,
  CAST(2 + row_number() OVER (PARTITION BY CAST(floor(k / 1000) AS BIGINT) ORDER BY k) AS BIGINT) AS row_no,
  CASE WHEN CAST(floor(k / 1000) AS BIGINT) % 2 = 1 THEN concat_ws('~', raw_flag, raw_total, CAST(k AS VARCHAR), raw_date)
    ELSE concat_ws('~', CAST(k AS VARCHAR), raw_date, raw_total, raw_flag) END AS cells FROM ({base}) q""",
        "latest_file": """SELECT event_type, arg_max(path, struct_pack(t := ts, p := path)) AS path, max(ts) AS modificationTime
FROM (SELECT event_type, ts, 'f'||CAST(event_id AS VARCHAR) AS path FROM events) q GROUP BY event_type""",
        "append_load": f"{old} UNION ALL {fresh}",
        "overwrite_load": fresh,
        "replace_where_load": f"SELECT * FROM ({old}) o WHERE NOT coalesce(activo, false) UNION ALL {fresh}",
        "reject_sink": f"""SELECT k, raw_date AS fecha, raw_total AS total, raw_flag AS activo, errores, 'first' AS load_id
FROM ({staged}) s WHERE errores <> '' AND {kept}""",
        "header_rows_store": """SELECT 't'||CAST(o_custkey % 7 AS VARCHAR) AS target_table, 'f'||CAST(o_custkey AS VARCHAR) AS file,
  CAST(arg_max(o_orderkey % 9 + 1, o_orderkey) AS INTEGER) AS header_row FROM orders GROUP BY 1, 2""",
        "retry_ledger": f"""SELECT load_id, source, event, version FROM (SELECT *, row_number() OVER (PARTITION BY load_id
  ORDER BY version DESC) AS n FROM ({duck("ledger")}) l) q WHERE n = 1 AND event = 'retry_open'""",
        "load_status": f"SELECT *, {status} AS status FROM ({loads}) l",
        "retry_status": f"""WITH RECURSIVE l AS (SELECT *, {status} AS status FROM ({loads}) x),
t AS (SELECT load_id AS root, load_id FROM l WHERE parent_load_id IS NULL
  UNION ALL SELECT t.root, l.load_id FROM t JOIN l ON l.parent_load_id = t.load_id),
c AS (SELECT t.root AS load_id, count(*) AS retries, sum(l.rows_valid) AS loaded FROM t JOIN l USING (load_id) WHERE t.load_id <> t.root GROUP BY 1)
SELECT l.load_id, l.status AS first_status, coalesce(c.retries, 0) AS retries, coalesce(c.loaded >= l.rows_invalid, false) AS completed,
  CASE WHEN c.loaded >= l.rows_invalid AND l.status = '_PARTIAL_ERROR' THEN '_OK' ELSE l.status END AS status
FROM l LEFT JOIN c USING (load_id) WHERE l.parent_load_id IS NULL""",
        "retry_merge": f"""{fresh} UNION ALL SELECT fecha, CASE WHEN isinf(total) THEN NULL ELSE total END, activo,
  'Massive Import', CASE WHEN k % 2 = 0 THEN 'r1' ELSE 'r2' END FROM ({again}) a WHERE errores = ''""",
        "load_generic": sheet_rows,
        "load_fixed_schema": f"""SELECT {columns} FROM (SELECT *, {D.period(v1)} AS d, {D.checked_number(total)} AS n
  FROM ({duck("dirty_lineitem")}) q) p
WHERE NOT (({v1} IS NOT NULL AND d IS NULL) OR coalesce(year(d) NOT BETWEEN 1900 AND 2100, false))
  AND NOT ({total} IS NOT NULL AND n IS NULL) AND k % 13 <> 0""",
        "stream_ingest": f"SELECT fecha, total, activo, creador FROM ({fresh}) f",
    }
