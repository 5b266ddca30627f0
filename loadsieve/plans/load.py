"""The load jobs: files to mapped rows, rows to a target table, rejects and a ledger entry."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import datetime
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadsieve.functions.text import clean_text
from loadsieve.operators import headers as H
from loadsieve.operators import mapping as M
from loadsieve.operators.cleaning import (
    ERRORS_COLUMN,
    apply_fixed_values,
    is_summary_row,
    keep_rows,
)
from loadsieve.operators.cells import PLAIN, clean_cells
from loadsieve.operators.report import STATUS_OK, STATUS_PARTIAL, summary_columns, top_errors
from loadsieve.operators.validate import annotate, validate
from loadsieve.plans.spec import LoadSpec
from loadsieve.session import saved, small_frame
from loadsieve.sources import commits, grid, records, sinks
from loadsieve.sources import stores

LAYOUT = "__layout"


@dataclass(frozen=True)
class MappedFiles:
    """Rows of a set of files under target names, and how the names were found.

    `lines` holds the uncut lines of the rows with their layouts, where cells are cut at one `delimiter` of a byte. The reports of a load are made when asked for: target columns no header maps to (with what
    their defaults say), counts per file, hints for the missing columns, and whether a file's
    mapping may go unreviewed.
    """

    rows: DataFrame
    mapping: DataFrame
    header_rows: DataFrame
    targets: DataFrame
    spec: LoadSpec
    approved: DataFrame | None = None
    lines: DataFrame | None = None
    delimiter: str = "|"

    def staged(self, all_raw: bool = True) -> DataFrame:
        """Typed rows with raw text and reasons."""
        if self.lines is None:
            return stage(self.rows, self.spec, all_raw=all_raw)
        return stage_lines(self.lines, self.spec, self.delimiter, all_raw)

    @property
    def near_repeats(self) -> DataFrame:
        """Headers that look like numbered copies of another one, with their targets."""
        return H.near_repeat_report(self.mapping.select("feed_id", "ordinal", "raw_header"), self.mapping)

    @property
    def asks_approval(self) -> DataFrame:
        """The near repeats that this mapping would load, as pairs to approve."""
        taken = self.near_repeats.where(~F.col("target").isin("", M.IGNORE))
        return taken.select(F.lit(self.spec.target).alias("target_table"), "raw_header", "target").distinct()

    @cached_property
    def missing(self) -> DataFrame:
        feeds = self.header_rows.select(F.col("file").alias("feed_id"), "target_table")
        return M.missing_plan(M.missing_columns(self.mapping, feeds, self.targets), self.spec.columns)

    @property
    def coverage(self) -> DataFrame:
        return M.coverage(self.mapping, self.missing)

    @property
    def suggestions(self) -> DataFrame:
        return M.suggest(self.mapping, self.missing, self.spec.threshold)

    @property
    def auto_confirm(self) -> DataFrame:
        return M.auto_confirm(self.mapping)

    def needs_review(self) -> bool:
        """Whether some file's mapping is not sure (a file without a usable header is not), or its near
        repeats are others than those approved last."""
        sure = self.auto_confirm.where("auto_confirm").select(F.col("feed_id").alias("file"))
        if not self.header_rows.join(sure, "file", "left_anti").isEmpty():
            return True
        return self.approved is not None and not H.approvals_changed(self.asks_approval, self.approved).where("changed").isEmpty()


@dataclass(frozen=True)
class LoadResult:
    load_id: str
    rows_read: int
    rows_valid: int
    rows_invalid: int
    status: str | None
    target_path: str
    rejects_path: str
    staged_path: str
    annotated_path: str = ""

    def top_reasons(self, spark: SparkSession) -> DataFrame:
        """Most frequent reasons among this load's rejects."""
        mine = spark.read.parquet(self.rejects_path).filter(F.col("load_id") == self.load_id)
        return top_errors(mine)


@dataclass(frozen=True)
class LoadPaths:
    """Where a target's rows, rejects, staged and annotated loads, ledger, remembered mapping and
    header positions live (shared storage).

    With `log`, a load is one transaction (sources/commits.py): its tables are read with `read_table`,
    and its ledger events are part of the log.
    """

    target: str
    rejects: str
    staged: str
    ledger: str
    annotated: str
    rules: str
    header_rows: str
    log: str = ""
    review: str = ""
    approvals: str = ""

    @classmethod
    def under(cls, base: str, atomic: bool = False) -> LoadPaths:
        names = ("target", "rejects", "staged", "ledger", "annotated", "rules", "header_rows")
        return cls(*[f"{base}/{n}" for n in names], f"{base}/log" if atomic else "", f"{base}/review", f"{base}/approvals")

    def read_table(self, spark: SparkSession, tbl: str, columns: str = "", load_ids: Sequence[str] | None = None) -> DataFrame:
        """A table (target, rejects, annotated, staged) as the last published load left it; `columns` where none may be published."""
        return commits.snapshot(spark, self.log, getattr(self, tbl), tbl, columns, load_ids)


@dataclass(frozen=True)
class DeleteWhere:
    """Pre-load action: remove the matching rows. Loads that are transactions rewrite the files that
    hold such rows; for others the whole result goes to a new path."""

    condition: Column
    new_path: str = ""


TRUNCATE = "truncate"


def spec_targets(spark: SparkSession, spec: LoadSpec) -> DataFrame:
    """Columns of one spec that headers may map to, as a frame."""
    rows = [(spec.target, i + 1, m.name) for i, m in enumerate(spec.inputs)]
    return small_frame(spark, rows, "target_table STRING, ordinal INT, target STRING")


def spec_rules(spark: SparkSession, spec: LoadSpec) -> DataFrame:
    rows = [(spec.target, h, t) for h, t in spec.column_map.items()]
    return small_frame(spark, rows, "target_table STRING, raw_header STRING, target STRING")


def map_files(
    spark: SparkSession,
    path: str | Sequence[str],
    spec: LoadSpec,
    rules: DataFrame | None = None,
    stored_headers: DataFrame | None = None,
    delimiter: str = "|",
    quoted: bool = False,
    aliases: DataFrame | None = None,
    multiline: bool = False,
) -> MappedFiles:
    """Find each file's header row, map its headers to the target, and lay its rows out.

    Files may differ in layout: each file's layout is one small row (the cell position of every
    target column, in target order), joined together with the row offsets of the file's blocks, so
    all files go through one plan and the lines themselves meet a single join. The text is read
    twice: once for the block table, which also holds the first rows, and once for the load.
    `aliases` (key, alias) takes the place of matching: headers are renamed by that table only.
    `multiline`: quoted cells may hold line breaks; rows are records then (sources/records.py).
    """
    rows_seen = max(H.PREVIEW_ROWS, spec.header_row or 0)
    if multiline:
        text = records.scan_records(spark, path, delimiter, rows_seen)
        first, numbered = text.preview(rows_seen), text.numbered
        cells_in = lambda line: records.split_records(line, delimiter)
    else:
        lines = grid.scan_lines(spark, path)
        blocks = grid.scan_blocks(lines, rows_seen)
        first, numbered = grid.preview(blocks, rows_seen), lambda *given: grid.number_lines(lines, blocks, *given)
        cells_in = lambda line: grid.cells_of(line, delimiter, quoted)
    top = first.select("file", "row_no", cells_in(F.col("line")).alias("cells"))
    names = [m.name for m in spec.inputs]
    scored = saved(H.score_rows(top, names, spec.threshold).drop("cells"), "header-scores")
    files = scored.select("file").distinct().withColumn("target_table", F.lit(spec.target))
    nothing = small_frame(spark, [], "target_table STRING, file STRING, header_row INT")
    asked = files.withColumn("header_row", F.lit(spec.header_row)) if spec.header_row else nothing
    kept = stored_headers if stored_headers is not None else nothing
    found = H.detect_header(scored.where(F.col("row_no") < H.PREVIEW_ROWS))
    header_rows = saved(H.resolve_header(files, asked, kept, scored, found), "header-rows")

    headers = grid.header_cells(top, header_rows).withColumn("target_table", F.lit(spec.target))
    headers = saved(headers.filter(F.lower(F.trim("raw_header")) != ERRORS_COLUMN), "headers")
    targets = spec_targets(spark, spec)
    if aliases is None:
        remembered = rules if rules is not None else spec_rules(spark, spec).limit(0)
        mapping = M.propose_mapping(headers, targets, spec_rules(spark, spec), remembered, spec.threshold)
    else:
        mapping = M.alias_proposal(headers, aliases, names)
    mapping = saved(mapping, "mapping")

    entry = F.struct("column_name", "ordinal")
    layouts = M.column_names(mapping).groupBy(F.col("feed_id").alias("file")).agg(
        F.map_from_entries(F.collect_list(entry)).alias("by_name")
    )
    at = F.array(*[F.try_element_at("by_name", F.lit(n)) for n in names])
    placed = header_rows.select("file", "header_row").join(layouts, "file", "left").select("file", "header_row", at.alias(LAYOUT))
    body = numbered(placed, ["header_row", LAYOUT]).filter(F.col("row_no") > F.col("header_row"))
    cells = body.withColumn("__cells", cells_in(F.col("line")))
    cell = lambda i: F.get("__cells", F.get(LAYOUT, F.lit(i)) - 1)
    rows = cells.select("file", "row_no", LAYOUT, *[cell(i).alias(n) for i, n in enumerate(names)])
    uncut = None if multiline or quoted or len(delimiter) != 1 or not delimiter.isascii() else body
    return MappedFiles(rows, mapping, header_rows, targets, spec, lines=uncut, delimiter=delimiter)


def prepare(rows: DataFrame, spec: LoadSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Cleaned text inputs in target order; absent inputs are null, empty rows are gone."""
    have = set(rows.columns)
    names = [m.name for m in spec.inputs]
    text = [
        (clean_text(F.col(n).cast("string"), spec.null_tokens) if n in have else F.lit(None).cast("string")).alias(n)
        for n in names
    ]
    cleaned = rows.select(*keep, *text)
    present = [F.col(n) for n in names if n in have]
    wanted = F.coalesce(*present).isNotNull() if present else F.lit(True)
    if LAYOUT in keep:
        # a file none of whose headers map has no column to be empty in, and keeps its rows
        wanted = wanted | ~F.exists(LAYOUT, lambda at: at.isNotNull())
    if spec.summary_columns:
        wanted = wanted & ~is_summary_row(*[F.col(n) for n in spec.summary_columns])
    return keep_rows(cleaned, wanted, [F.col(c) for c in cleaned.columns])


def stage(rows: DataFrame, spec: LoadSpec, keep: Sequence[str] = ("file", "row_no"), all_raw: bool = True) -> DataFrame:
    """Typed rows with raw text and reasons: one narrow pass over the source.

    Without `all_raw`, rows without errors have no raw text."""
    carry = [LAYOUT] if LAYOUT in rows.columns else []
    have = set(rows.columns)
    if carry:
        absent = {m.name: F.get(LAYOUT, F.lit(i)).isNull() for i, m in enumerate(spec.inputs)}
    else:
        absent = {m.name: F.lit(True) for m in spec.inputs if m.name not in have}
    return validate(prepare(rows, spec, [*keep, *carry]), spec, keep, absent=absent, carry=carry, all_raw=all_raw)


def stage_lines(lines: DataFrame, spec: LoadSpec, delimiter: str, all_raw: bool = True) -> DataFrame:
    """`stage` of lines (file, row_no, layout, line) whose cells are cut and cleaned in batches."""
    names = [m.name for m in spec.inputs]
    numbers = [m.name for m in spec.inputs if m.family == "number"]
    # only defaults ask for the layout of a row
    carry = [LAYOUT] if any(m.column_default for m in spec.inputs) else []
    rows = clean_cells(lines, names, numbers, LAYOUT, delimiter, spec.null_tokens, bool(carry))
    if spec.summary_columns:
        # nothing lies below that the condition could be pushed into
        rows = rows.where(~is_summary_row(*[F.col(n) for n in spec.summary_columns]))
    absent = {m.name: F.get(LAYOUT, F.lit(i)).isNull() for i, m in enumerate(spec.inputs)} if carry else {}
    plain = {n: F.col(PLAIN + n) for n in numbers}
    return validate(rows, spec, ("file", "row_no"), absent=absent, carry=carry, plain=plain, all_raw=all_raw)


def final_columns(staged: DataFrame, spec: LoadSpec, load_time: datetime) -> DataFrame:
    """Staged loadable rows as target rows: fixed values set, insertable columns in order."""
    names = [m.name for m in spec.insertable]
    types = spec.types
    filled = staged.withColumns({n: F.lit(None).cast(types[n]) for n in spec.fixed_values if n in names})
    return apply_fixed_values(filled, spec.fixed_values, names, load_time, types).select(*names)


def load_rows(
    spark: SparkSession,
    rows: DataFrame,
    spec: LoadSpec,
    paths: LoadPaths,
    load_id: str,
    load_time: datetime,
    keep: Sequence[str] = ("file", "row_no"),
    parent_load_id: str | None = None,
    pre_action: str | DeleteWhere | None = None,
    source: str = "",
    annotated: bool = False,
    staged: DataFrame | None = None,
) -> LoadResult:
    """Stage once, then write rejects and loadable rows from the staged copy.

    `staged` takes the place of staging the rows here (stage_lines does the same for lines of files).

    Every output of a load is its own folder and written whole, so the same load_id may run again,
    with the same rows or others, and leaves its last outcome only.

    The source is read and parsed once; counts come from the same pass. Rejects are written
    before the target changes, and the target is replaced only by complete, checked data.
    """
    bad = F.col(ERRORS_COLUMN) != ""
    counts = Observation(f"load {load_id}")
    # loadable rows need no raw text any more, but for an annotated copy of the source
    staged = stage(rows, spec, keep, all_raw=annotated) if staged is None else staged
    slim = staged.withColumn("rejected", bad).observe(counts, *summary_columns())
    out = commits.Attempt(spark, paths.log, load_id) if paths.log else sinks.InPlace(spark, load_id)
    folder = out.write(slim, paths.staged, "staged", ["rejected"])
    seen = counts.get
    # reading back with a known schema spares a footer scan and stands an empty outcome
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in staged.schema.fields]).add("rejected", "boolean")
    mine = spark.read.schema(schema).parquet(folder)

    raw = [F.col(f"raw.{m.name}").alias(m.name) for m in spec.inputs]
    out.write(mine.filter(F.col("rejected")).select(*keep, *raw, ERRORS_COLUMN), paths.rejects, "rejects")
    told = out.write(annotate(mine, spec, keep), paths.annotated, "annotated") if annotated else ""

    final = final_columns(mine.filter(~F.col("rejected")), spec, load_time)
    target = paths.target
    first = parent_load_id is None
    loaded = mine.filter(~F.col("rejected")).select(*keep)
    if first and isinstance(pre_action, DeleteWhere) and not paths.log:
        target = pre_action.new_path
        sinks.write_replace_where(final, spark, paths.target, target, pre_action.condition, load_id)
    else:
        out.write(final, target, "target")
        if first and pre_action == TRUNCATE:
            out.truncate(target, "target")
        elif first and isinstance(pre_action, DeleteWhere):
            out.delete_where(target, "target", pre_action.condition)

    status = None
    if seen["rows_valid"] and first:
        status = STATUS_PARTIAL if seen["rows_invalid"] else STATUS_OK
    events = _events(spark, paths, load_id, parent_load_id, source, seen, load_time, keep, loaded)
    if paths.log:
        out.publish([dict(zip(T.StructType.fromDDL(stores.LEDGER).names, e)) for e in events])
    else:
        stores.append_store(small_frame(spark, events, stores.LEDGER).coalesce(1), paths.ledger)
    return LoadResult(load_id, seen["rows_read"], seen["rows_valid"], seen["rows_invalid"], status, target, paths.rejects, folder, told)


def _ledger(spark: SparkSession, paths: LoadPaths) -> DataFrame:
    return stores.latest_events(commits.ledger(spark, paths.log) if paths.log else stores.read_store(spark, paths.ledger, stores.LEDGER))


def _ancestors(ledger: DataFrame, parent: str | None) -> list[Row]:
    """Latest events of a retry's parent, its parent and so on; a chain is as long as people retry."""
    found: list[Row] = []
    while parent is not None and parent not in {r["load_id"] for r in found}:
        row = ledger.filter(F.col("load_id") == parent).first()
        if row is None:
            break
        found.append(row)
        parent = row["parent_load_id"]
    return found


def _retries_of(ledger: DataFrame, load_id: str) -> list[str]:
    """Ids of the retries of a load, and of their retries."""
    found, new = [], [load_id]
    while new:
        rows = ledger.filter(F.col("parent_load_id").isin(new) & ~F.col("load_id").isin([*found, load_id]))
        new = [r["load_id"] for r in rows.select("load_id").collect()]
        found += new
    return found


def _rows_of(spark: SparkSession, paths: LoadPaths, tbl: str, load_ids: Sequence[str]) -> DataFrame:
    """What some loads have in a table."""
    if paths.log:
        return paths.read_table(spark, tbl, load_ids=load_ids)
    return reduce(DataFrame.unionByName, [spark.read.parquet(sinks.load_folder(spark, getattr(paths, tbl), i)) for i in load_ids])


def _waiting(
    spark: SparkSession, paths: LoadPaths, ledger: DataFrame, load_id: str, keep: Sequence[str], but: str = "", also: DataFrame | None = None
) -> DataFrame:
    """Keys of a load's rejects that none of its retries (other than one) has brought in, nor the rows `also`."""
    rejects = _rows_of(spark, paths, "rejects", [load_id]).select(*keep)
    others = [i for i in _retries_of(ledger, load_id) if i != but]
    # rows in the target come from the staged copies of the loads
    loaded = _rows_of(spark, paths, "staged", others).where("NOT rejected").select(*keep) if others else None
    for rows in (loaded, also):
        rejects = rejects if rows is None else rejects.join(rows, list(keep), "left_anti")
    return rejects


def _events(spark, paths, load_id, parent, source, seen, load_time, keep, loaded) -> list[tuple]:
    """Ledger events of a load. A load that has no reject waiting any more is closed with its own
    counts, whichever of its retries brought the last one in. loaded: keys of the rows this load brings in."""
    before = _ledger(spark, paths)
    mine = before.filter(F.col("load_id") == load_id).first()
    version = max(int(load_time.timestamp() * 1000), mine["version"] + 1 if mine else 0)
    counts = (seen["rows_read"], seen["rows_valid"], seen["rows_invalid"])
    events = [(load_id, parent, source, *counts, stores.LOADED, version)]
    if seen["rows_invalid"] and seen["rows_valid"]:
        events.append((load_id, parent, source, *counts, stores.RETRY_OPEN, version + 1))
    for r in _ancestors(before, parent):
        if _waiting(spark, paths, before, r["load_id"], keep, but=load_id, also=loaded).isEmpty():
            own = (r["rows_read"], r["rows_valid"], r["rows_invalid"])
            events.append((r["load_id"], r["parent_load_id"], r["source"], *own, stores.RETRY_DONE, max(version, r["version"] + 1)))
    return events


def remember(spark: SparkSession, mapped: MappedFiles, spec: LoadSpec, paths: LoadPaths, version: int) -> None:
    """Keep what a load learned: header positions per file, and the target of every mapped header."""
    at = mapped.header_rows.select("target_table", "file", (F.col("header_row") + 1).cast("int").alias("header_row"))
    stores.append_store(at.withColumn("version", F.lit(version).cast("bigint")), paths.header_rows)
    pairs = mapped.mapping.filter(F.col("target") != M.IGNORE).select("target_table", "raw_header", "target").distinct()
    fresh = pairs.withColumn("version", F.lit(version).cast("bigint"))
    none = small_frame(spark, [], stores.RULES)
    stores.append_store(M.merge_rules(none, fresh), paths.rules)


def approve(spark: SparkSession, mapped: MappedFiles, paths: LoadPaths, version: int) -> None:
    """Save the near repeats of a mapping as approved, in place of those approved before."""
    before = stores.read_store(spark, paths.approvals, stores.APPROVALS).where(F.col("target_table") == mapped.spec.target).agg(F.max("version")).first()[0]
    version = max(version, version if before is None else before + 1)
    none = small_frame(spark, [(mapped.spec.target, "", "")], "target_table STRING, raw_header STRING, target STRING")
    rows = mapped.asks_approval.unionByName(none).withColumn("version", F.lit(version).cast("bigint"))
    stores.append_store(rows.coalesce(1), paths.approvals)


def accept_hints(spark: SparkSession, mapped: MappedFiles, spec: LoadSpec, paths: LoadPaths, version: int) -> None:
    """Remember the useful suggestions, so that the next mapping of these headers takes them."""
    hints = M.accept_suggestions(mapped.suggestions, spec.target, version).distinct()
    stores.append_store(M.merge_rules(small_frame(spark, [], stores.RULES), hints), paths.rules)


def load_files(
    spark: SparkSession,
    path: str | Sequence[str],
    spec: LoadSpec,
    paths: LoadPaths,
    load_id: str,
    load_time: datetime,
    rules: DataFrame | None = None,
    stored_headers: DataFrame | None = None,
    delimiter: str = "|",
    quoted: bool = False,
    pre_action: str | DeleteWhere | None = None,
    aliases: DataFrame | None = None,
    only_sure: bool = False,
    annotated: bool = False,
    multiline: bool = False,
) -> tuple[LoadResult | None, MappedFiles]:
    """First load from text files: header rows, mapping, validation, target, rejects, ledger.

    Mapping rules and header positions that earlier loads saved are used unless others are
    given; what this load finds is saved before rows are written, and the mapping is written to
    `review` for whoever checks it. With `only_sure`, nothing is
    loaded or saved while some file's mapping asks for review (`approve` settles near repeats), and the
    result is None.
    """
    if rules is None:
        rules = stores.read_store(spark, paths.rules, stores.RULES)
    if stored_headers is None:
        stored_headers = stores.latest_header_rows(stores.read_store(spark, paths.header_rows, stores.HEADER_ROWS))
    mapped = map_files(spark, path, spec, rules, stored_headers, delimiter, quoted, aliases, multiline)
    if paths.approvals and aliases is None:
        approved = stores.latest_approvals(stores.read_store(spark, paths.approvals, stores.APPROVALS))
        mapped = replace(mapped, approved=approved)
    if only_sure and mapped.needs_review():
        return None, mapped
    version = int(load_time.timestamp() * 1000)
    if aliases is None:
        remember(spark, mapped, spec, paths, version)
    if mapped.approved is not None:
        approve(spark, mapped, paths, version)
    if paths.review:
        sinks.write_load(mapped.mapping.coalesce(1), paths.review, load_id)
    source = path if isinstance(path, str) else ", ".join(path)
    done = load_rows(
        spark, mapped.rows, spec, paths, load_id, load_time, pre_action=pre_action, source=source, annotated=annotated, staged=mapped.staged(annotated)
    )
    return done, mapped


def retry_load(
    spark: SparkSession,
    fixed: DataFrame,
    spec: LoadSpec,
    paths: LoadPaths,
    load_id: str,
    parent_load_id: str,
    load_time: datetime,
    keep: Sequence[str] = ("file", "row_no"),
) -> LoadResult:
    """Load corrected rejects. No pre-load action; rows of the parent that are not among its
    rejects, or that another retry brought in, are left out, so nothing is doubled."""
    rows = fixed.drop(*[c for c in fixed.columns if c.strip().lower() == ERRORS_COLUMN])
    waiting = _waiting(spark, paths, _ledger(spark, paths), parent_load_id, keep, but=load_id)
    again = rows.join(waiting, list(keep), "left_semi")
    return load_rows(spark, again, spec, paths, load_id, load_time, keep, parent_load_id=parent_load_id)
