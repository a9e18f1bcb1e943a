"""Gauge-file scan and parse.

A landing directory holds gauge CSV files: metadata lines, a header line and
data lines, with columns in any order per file, a separator of its own (comma,
semicolon, tab or bar) and its own order of day, month and year. Files are read line by line
(``spark.read.text``), never as one row per file, so a large file is split
over many tasks. The line order inside a file is
``(_metadata.file_block_start, monotonically_increasing_id())``: ids increase
within a task and each block of a file is read in order.

Millions of small files cost more to create, list and open than to read. With
``members`` the landed files are bundles instead: each line is the name of a
gauge file, a tab and a line of it, as ``grep -r '' directory`` or a log shipper
writes them. All lines of a gauge file stand in one bundle, in their order, and a bundle
is split over tasks like any file. Every step below works per gauge file, whose
``file`` is then ``<path of the bundle>#/<name>``.

Steps:

1. ``scan_lines``   file path, entity key (from the path), order columns, text
2. ``file_heads``   per file: the header line (line ``metadata_lines + 1``);
                    a map-side-limited first-N lines of each file
3. ``parse_lines``  data lines ⋈ heads (one row per file), split with a
                    quote-aware pattern at the separator that finds the most
                    columns in the header, cells looked up by header name
                    (S2), NULL tokens (S3), ragged rows rejected (S4), measures
                    ``try_cast`` to double (P9), each date read in every order
                    it allows (P10)
4. ``join_broken``  files with a line of an odd number of quotes: lines inside
                    a quoted cell are put together and parsed once more (S4)
5. ``status``       per file: the order of dates that fits all its lines, rows,
                    rejects, bad dates, reason (S5); rows of failed files are
                    left out (one bad file never stops a run)

Choices where a file leaves some: equal numbers of columns found, the earlier
separator of the list; dates that several orders fit, year first, then day
first, then month first; no order fits all lines, the file has bad dates (those
that its best order does not read). A quoted cell may run over
``MAX_RECORD_LINES`` lines; a quote that does not begin its cell, that is not
closed by then, or whose lines together do not fit the header, joins nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeflow import schemas as S
from gaugeflow.functions.expr import null_tokens, strip_ws, try_doubles
from gaugeflow.operators.windows import first_n_per_key, latest_per_key
from gaugeflow.session import materialize

# Default: entity key = file stem of "<key>.csv".
STEM_PATTERN = r"([^/]+)\.[cC][sS][vV]$"
SEPARATORS = [",", ";", "\t", "|"]
# One cell after its separator, in one pass: characters outside quotes, or
# quoted runs in which separators do not count.
CELL = r'{0}((?:[^"{0}]++|"[^"]*+(?:"|$))*+)'
# A line whose quoted runs are all closed and hold no separator.
NO_QUOTED_SEPARATOR = r'^[^"]*+(?:"[^"{0}]*+"[^"]*+)*+\z'
# A line whose quotes all enclose whole cells without a separator: its cells are
# those of the line without its quotes.
WHOLE_CELLS = r'^(?:"[^"{0}]*+"|[^"{0}]*+)(?:{0}(?:"[^"{0}]*+"|[^"{0}]*+))*+\z'
# A date, or the date part of a timestamp text.
TIME_TEXT = r"(?:[ T]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?: ?(?:Z|UTC|[+-]\d{2}(?::?\d{2})?))?)?$"
YEAR_FIRST = r"^(\d{4})([-/])(\d{1,2})\2(\d{1,2})" + TIME_TEXT
YEAR_LAST = r"^(\d{1,2})([-/. ])(\d{1,2})\2(\d{4})" + TIME_TEXT
# The orders of a date's parts, in the order in which they are preferred.
DATE_ORDERS = ["_ymd", "_dmy", "_mdy"]
MAX_RECORD_LINES = 100
# A line that ends inside a cell which its first character quotes.
OPEN_CELL = r'(?:^|[,;\t|])\s*"(?:[^"]|"")*$'

# Optional header aliases (S6). Off by default: files with variant names then
# fail with "missing columns", as upstream.
VARIANT_ALIASES: dict[str, list[str]] = {
    "Precipitacion(mm)": ["Precipitación(mm)"],
    "VolumenAlm(Mm3)": ["Almacenamiento(hm³)"],
}

ORDER_COLS = ("file_block_start", "line_id")
MEMBER_MARK = "#/"  # between a bundle's path and a member's name; paths have # encoded
REASON_CHARS = 200  # of the reason text of a failed file


@dataclass
class Parsed:
    """Parse result: parsed lines, rejected data lines, per-file status, the
    same with date orders, and headers."""

    parsed: DataFrame
    rejects: DataFrame
    status: DataFrame
    orders: DataFrame
    heads: DataFrame


def scan_lines(spark: SparkSession, path: str | Sequence[str], key_pattern: str = STEM_PATTERN,
               glob: str | None = "*.csv", recursive: bool = False, members: bool = False) -> DataFrame:
    """All lines of all files under ``path`` with file, key and order.
    ``members``: the files are bundles of gauge files, see the module doc."""
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    paths = [path] if isinstance(path, str) else list(path)
    df = reader.text(paths)
    return lines_from_text(df, key_pattern, members)


def scan_files(spark: SparkSession, path: str | Sequence[str], key_pattern: str = STEM_PATTERN,
               glob: str | None = "*.csv", recursive: bool = False) -> DataFrame:
    """(file, key) of every landed file, empty ones included. All scans, that
    of binary files too, skip zero-length files; only Spark's file index has
    them. Their names come from it: it holds one per file on the driver for
    every read of the directory anyway."""
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    paths = [path] if isinstance(path, str) else list(path)
    files = spark.createDataFrame([(n,) for n in reader.text(paths).inputFiles()], "file string")
    return files.select(_norm_path(F.col("file")).alias("file"),
                        F.regexp_extract("file", key_pattern, 1).alias(S.KEY))


def _norm_path(c: Column) -> Column:
    """Same spelling for index paths ('file:///x', plain) and line paths
    ('file:/x', URL-encoded)."""
    return F.regexp_replace(F.url_decode(c), "^file:/+", "file:/")


def _landed_path(file: Column) -> Column:
    """The landed file of a line's ``file``: of a member, its bundle."""
    return _norm_path(F.substring_index(file, MEMBER_MARK, 1))


def with_empty_files(status: DataFrame, files: DataFrame) -> DataFrame:
    """Add files that produced no line at all (empty files) as 'empty'.
    Line paths are URL-encoded, index paths are not: compare decoded."""
    seen = status.select(_landed_path(F.col("file")).alias("file"))
    empty = files.join(seen, files.file == seen.file, "left_anti").select(
        "file", S.KEY, F.lit("empty").alias("status"),
        *[F.lit(0).cast("long").alias(c) for c in ("data_rows", "rejected_rows", "bad_dates")],
        F.lit("empty file").alias("reason"))
    return status.unionByName(empty)


def without_files(files: DataFrame, known: DataFrame) -> DataFrame:
    """Files of the list that ``known`` (a frame with their paths) lacks."""
    seen = known.select(_landed_path(F.col("file")).alias("_seen")).distinct()
    return files.join(seen, F.col("file") == F.col("_seen"), "left_anti")


def lines_from_text(df: DataFrame, key_pattern: str = STEM_PATTERN, members: bool = False) -> DataFrame:
    """Add file, key and line order to a ``text`` DataFrame."""
    return ordered_lines(df.select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("file_block_start")), key_pattern, members)


def ordered_lines(df: DataFrame, key_pattern: str = STEM_PATTERN, members: bool = False) -> DataFrame:
    """Key and line order for lines that have their file and block."""
    if members:
        named, name = F.contains("value", F.lit("\t")), F.substring_index("value", "\t", 1)
        df = df.withColumns({
            "file": F.when(named, F.concat("file", F.lit(MEMBER_MARK), name)).otherwise(F.col("file")),
            "value": F.when(named, F.substr("value", F.length(name) + 2)).otherwise(F.col("value"))})
    return df.select(
        "file",
        F.regexp_extract("file", key_pattern, 1).alias(S.KEY),
        "file_block_start",
        F.monotonically_increasing_id().alias("line_id"),
        F.when(F.contains("value", F.lit("\r")), F.regexp_replace("value", "\r$", "")).otherwise(F.col("value")).alias("value"),
    )


def file_heads(lines: DataFrame, metadata_lines: int = S.GAUGE_METADATA_LINES) -> DataFrame:
    """Per file: the header line and its position (block start, line id).

    The first ``metadata_lines + 1`` lines of each file by (block start, line
    id): a row_number filter that Spark limits map-side, so each task sends at
    most that many lines per file. Normally all of them sit in the first
    block; a header pushed into a later block by long metadata lines is found
    too. Files with fewer lines have ``header_line`` NULL."""
    n = metadata_lines + 1
    top = first_n_per_key(lines, "file", ["file_block_start", "line_id"], n)
    pos = F.struct("file_block_start", "line_id")
    return top.groupBy("file", S.KEY).agg(
        F.count(F.lit(1)).alias("head_lines"),
        F.max(pos).alias("_hpos"),
        F.max_by("value", pos).alias("header_line"),
    ).select(
        "file", S.KEY,
        F.col("_hpos.file_block_start").alias("header_block"),
        F.col("_hpos.line_id").alias("header_id"),
        F.when(F.col("head_lines") >= n, F.col("header_line")).alias("header_line"),
    )


def after_header() -> Column:
    """True for lines after the header line of their file."""
    return (F.col("file_block_start") > F.col("header_block")) | (
        (F.col("file_block_start") == F.col("header_block")) & (F.col("line_id") > F.col("header_id")))


def _has_quote(text: Column) -> Column:
    return F.contains(text, F.lit('"'))


def _unquoted(cell: Column) -> Column:
    """A cell without its outer quotes, doubled quotes unescaped. Most quoted
    cells are one quoted run, whose inside is cut out."""
    inside = F.substr(cell, F.lit(2), F.length(cell) - 2)
    whole = F.startswith(cell, F.lit('"')) & F.endswith(cell, F.lit('"')) & (F.length(cell) > 1) & ~_has_quote(inside)
    return F.when(~_has_quote(cell), cell).when(whole, inside).otherwise(
        F.regexp_replace(F.regexp_replace(cell, r'^\s*"|"\s*$', ""), '""', '"'))


def _in_pattern(sep: str) -> str:
    return "\\|" if sep == "|" else sep


def _raw_split_at(line: Column, sep: str) -> Column:
    """Quote-aware split that leaves the quotes in the cells. The plain split
    is right unless a separator stands in a quoted run."""
    pattern = _in_pattern(sep)
    quoted = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(CELL.format(pattern)), F.lit(1))
    plain = ~_has_quote(line) | F.rlike(line, F.lit(NO_QUOTED_SEPARATOR.format(pattern)))
    return F.when(plain, F.split(line, pattern, -1)).otherwise(quoted)


def _split_at(line: Column, sep: str) -> Column:
    cells = _raw_split_at(line, sep)
    return F.when(_has_quote(line), F.transform(cells, _unquoted)).otherwise(cells)


def _by_separator(separator: Column, made: Callable[[str], Column]) -> Column:
    """``made`` of the line's separator."""
    cells = made(SEPARATORS[-1])
    for sep in reversed(SEPARATORS[:-1]):
        cells = F.when(separator == sep, made(sep)).otherwise(cells)
    return cells


def split_cells(line: Column, separator: Column | None = None) -> Column:
    """Quote-aware split at ``separator`` (one of ``SEPARATORS``; a comma
    unless given), outer quotes removed, doubled quotes unescaped. Lines
    without a quote take the plain split."""
    if separator is None:
        return _split_at(line, ",")
    return _by_separator(separator, lambda sep: _split_at(line, sep))


def _date_forms(cell: Column, formats: Sequence[str] = ()) -> list[Column]:
    """The date of a cell in each of ``DATE_ORDERS``: numbers of one or two
    digits, the year of four, the same mark between them (``-`` or ``/``, also
    a dot or blank where the year is last), blanks around it and a time after
    it allowed. ``formats`` are tried with the first order. Days that do not
    exist are NULL."""
    text = strip_ws(cell)

    def form(pattern: str, parts: str) -> Column:
        # One pass of the pattern: what it does not match stays as it is.
        found = F.regexp_replace(text, pattern, "=" + parts)
        return F.when(F.startswith(found, F.lit("=")), F.substring(found, 2, 10).try_cast("date"))

    plain = (F.length(cell) == 10) & (F.substring(cell, 5, 1) == "-") & (F.substring(cell, 8, 1) == "-")
    ymd = F.when(plain, cell.try_cast("date")).otherwise(
        F.coalesce(form(YEAR_FIRST, "$1-$3-$4"), *[F.try_to_date(text, f) for f in formats]))
    return [ymd, F.when(~plain, form(YEAR_LAST, "$4-$3-$1")), F.when(~plain, form(YEAR_LAST, "$4-$1-$3"))]


def _names(aliases: dict[str, list[str]] | None) -> dict[str, list[str]]:
    """Accepted spellings of every column that is read."""
    return {h: [h, *(aliases or {}).get(h, [])] for h in [S.GAUGE_DATE_HEADER, *S.GAUGE_MEASURE_HEADERS]}


def read_headers(heads: DataFrame, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """Per file of :func:`file_heads`: the separator, the cleaned header cells
    at it, the places of the columns, whether one is absent and which.
    ``_file`` is what parsed lines name their file by, here its path."""
    names = _names(aliases)
    cells = {sep: f"_cells{i}" for i, sep in enumerate(SEPARATORS)}
    split = heads.withColumns({c: F.transform(_split_at(F.col("header_line"), sep), strip_ws) for sep, c in cells.items()})
    spellings = F.array(*[F.array(*map(F.lit, n)) for n in names.values()])

    def present(header: str) -> Column:
        return F.filter(spellings, lambda n: F.arrays_overlap(n, F.col(header)))

    found = split.withColumns({f"{c}_found": F.size(present(c)) for c in cells.values()})
    most = F.greatest(*[f"{c}_found" for c in cells.values()])

    def best(values: dict[str, Column]) -> Column:
        return F.coalesce(*[F.when(F.col(f"{cells[sep]}_found") == most, v) for sep, v in values.items()])

    h = found.select("file", F.col("file").alias("_file"), S.KEY, "header_block", "header_id", "header_line", best({s: F.lit(s) for s in SEPARATORS}).alias("_sep"),
                     best({s: F.col(c) for s, c in cells.items()}).alias("_hdr"))
    # Places of all accepted names, in their order; -1 for absent ones.
    places = [(F.array_position("_hdr", F.lit(n)) - 1).cast("int") for spelled in names.values() for n in spelled]
    absent = F.filter(spellings, lambda n: ~F.arrays_overlap(n, F.col("_hdr")))
    return h.withColumns({"_places": F.array(*places), "_width": F.size("_hdr"),
                          "_absent": F.array_join(F.transform(absent, lambda n: n[0]), ", ")}).withColumn(
        "_missing", F.col("_absent") != "")


def parse_lines(lines: DataFrame, heads: DataFrame | None = None, aliases: dict[str, list[str]] | None = None,
                date_formats: Sequence[str] = (), metadata_lines: int = S.GAUGE_METADATA_LINES) -> Parsed:
    """Parse data lines into raw rows; see the module doc. ``aliases`` maps a
    canonical header to extra accepted names (S6)."""
    headers = read_headers(file_heads(lines, metadata_lines) if heads is None else heads, aliases)
    return _finish(_cells_of(lines, headers, aliases, date_formats), headers)


def _cells_of(lines: DataFrame, headers: DataFrame, aliases: dict[str, list[str]] | None, date_formats: Sequence[str]) -> DataFrame:
    """Data lines with their cells read: measures, the date in every order."""
    names = _names(aliases)
    usable = headers.where(F.col("_hdr").isNotNull() & ~F.col("_missing")).select(
        "file", "_file", "header_block", "header_id", "_sep", "_places", "_width")
    quoted = _has_quote(F.col("value"))
    data = (
        # The file's path and key are in its header's row: not kept with every line.
        lines.drop(S.KEY).join(usable, "file", "inner")
        .where(after_header())
        .where(F.trim(F.col("value")) != "")
        .withColumn("_simple", ~quoted | _by_separator(F.col("_sep"), lambda sep: F.rlike("value", F.lit(WHOLE_CELLS.format(_in_pattern(sep))))))
        .withColumn("_bare", F.when(F.col("_simple") & quoted, F.replace("value", F.lit('"'), F.lit(""))).otherwise(F.col("value")))
        .withColumn("_cells", _by_separator(F.col("_sep"), lambda sep: F.when(F.col("_simple"), F.split("_bare", _in_pattern(sep), -1))
                                            .otherwise(_raw_split_at(F.col("_bare"), sep))))
    )
    # Cells first, each looked up once; then what is made of them: only those
    # that are read lose their quotes. All measures in one expression: six times
    # the cast of one made a method so long that the JVM only interpreted it.
    picked, at = [], 0
    for spelled in names.values():
        picks = [F.get("_cells", F.get("_places", F.lit(at + i))) for i in range(len(spelled))]
        picked.append(picks[0] if len(picks) == 1 else F.coalesce(*picks))
        at += len(spelled)
    measures = [S.GAUGE_MEASURE_HEADERS[h0] for h0 in names if h0 != S.GAUGE_DATE_HEADER]
    names_of = [f"_text{i}" for i in range(len(picked))]
    looked_up = data.select("_file", *ORDER_COLS, "value", "_simple", (F.size("_cells") != F.col("_width")).alias("_ragged"),
                            *[c.alias(n) for c, n in zip(picked, names_of)])
    texts = F.when(F.col("_simple"), F.array(*map(null_tokens, names_of))).otherwise(
        F.transform(F.array(*names_of), lambda c: null_tokens(_unquoted(c))))
    read = looked_up.select("_file", *ORDER_COLS, "value", "_simple", "_ragged", texts.alias("_texts")).select(
        "*", F.get("_texts", F.lit(0)).alias("_date_cell"), F.slice("_texts", 2, len(measures)).alias("_numbers")).select(
        "_file", *ORDER_COLS, "value", "_ragged", "_date_cell",
        *[d.alias(c) for c, d in zip(DATE_ORDERS, _date_forms(F.col("_date_cell"), date_formats))],
        (~F.col("_simple") & _odd_quotes()).alias("_odd"), try_doubles("_numbers").alias("_numbers"))
    # The text of a line is kept where it is reported: of rejected lines.
    return read.select("_file", *ORDER_COLS, F.when(F.col("_ragged"), F.col("value")).alias("value"), "_ragged", "_date_cell",
                       *DATE_ORDERS, "_odd", *[F.get("_numbers", F.lit(i)).alias(c) for i, c in enumerate(measures)])


def _finish(parsed: DataFrame, headers: DataFrame, stage: bool = False) -> Parsed:
    """Status, rows and rejects from parsed lines (see :func:`parse_lines`).
    With ``stage`` the counts per file are written, so their size is known."""
    dated = ~F.col("_ragged") & F.col("_date_cell").isNotNull()
    # Numbers alone, so that they are hash aggregates.
    counts = parsed.groupBy("_file").agg(
        F.count_if(dated).alias("_dated"),
        *[F.count_if(dated & F.col(o).isNotNull()).alias(f"_fits{o}") for o in DATE_ORDERS],
        F.count_if(F.col("_ragged")).alias("rejected_rows"),
    ).withColumn("_fits", F.array(*[f"_fits{o}" for o in DATE_ORDERS])).withColumn(
        "_order", F.array_position("_fits", F.array_max("_fits")).cast("int")).withColumn(
        "data_rows", F.element_at("_fits", F.col("_order"))).select(
        "_file", "_order", "data_rows", "rejected_rows", (F.col("_dated") - F.col("data_rows")).alias("bad_dates"))
    if stage:
        counts = materialize(parsed.sparkSession, counts, "file-counts")
    # The first lines at fault, of the files that report one.
    fault = counts.where((F.col("bad_dates") > 0) | ((F.col("rejected_rows") > 0) & (F.col("data_rows") == 0))).select("_file", "_order")
    bad = dated & F.element_at(F.array(*[F.col(o).isNull() for o in DATE_ORDERS]), F.col("_order"))
    place = F.struct(*ORDER_COLS)
    firsts = parsed.join(fault, "_file").where(F.col("_ragged") | bad).groupBy("_file").agg(
        F.min_by(F.when(bad, F.col("_date_cell")), F.when(bad, place)).alias("_bad"),
        F.min_by(F.when(F.col("_ragged"), F.col("value")), F.when(F.col("_ragged"), place)).alias("_cut"))
    status = headers.select("file", "_file", S.KEY, "header_line", "_missing", "_absent").join(
        counts, "_file", "left").join(firsts, "_file", "left").select(
            "file", "_file", S.KEY,
            F.when(F.col("header_line").isNull(), F.lit("no_header"))
            .when(F.col("_missing"), F.lit("missing_columns"))
            .when(F.col("bad_dates") > 0, F.lit("bad_dates"))
            .when((F.col("rejected_rows") > 0) & (F.col("data_rows") == 0), F.lit("all_rejected"))
            .otherwise(F.lit("ok")).alias("status"),
            F.coalesce("data_rows", F.lit(0)).alias("data_rows"),
            F.coalesce("rejected_rows", F.lit(0)).alias("rejected_rows"),
            F.coalesce("bad_dates", F.lit(0)).alias("bad_dates"),
            "_absent", "_bad", "_cut", F.element_at(F.array(*map(F.lit, DATE_ORDERS)), F.col("_order")).alias("_order"),
        )
    status = status.withColumn("reason", F.left(
        F.when(F.col("status") == "no_header", F.lit("no header line"))
        .when(F.col("status") == "missing_columns", F.concat(F.lit("missing columns: "), F.col("_absent")))
        .when(F.col("status") == "bad_dates", F.concat(F.lit("bad date: "), F.col("_bad")))
        .when(F.col("status") == "all_rejected", F.concat(F.lit("no line fits the header, first: "), F.col("_cut"))),
        F.lit(REASON_CHARS)))
    rejects = parsed.where(F.col("_ragged")).join(headers.select("file", "_file", S.KEY), "_file").select(
        "file", S.KEY, *ORDER_COLS, "value")
    return Parsed(status=status.drop("_file", "_absent", "_bad", "_cut", "_order"), rejects=rejects, parsed=parsed, heads=headers,
                  orders=status.drop("_absent", "_bad", "_cut"))


def accepted_rows(parsed: Parsed, orders: DataFrame | None = None) -> DataFrame:
    """Rows of files whose status is ok (a bad file is dropped whole, S5), with
    the date in their file's order. ``orders`` has one row per file."""
    good = (parsed.orders if orders is None else orders).where(F.col("status") == "ok").select("file", "_file", S.KEY, "_order")
    date = F.coalesce(*[F.when(F.col("_order") == o, F.col(o)) for o in DATE_ORDERS])
    return parsed.parsed.where(~F.col("_ragged")).join(good, "_file").withColumn(S.DATE, date).where(
        F.col(S.DATE).isNotNull()).select(S.KEY, S.DATE, *S.MEASURES, "file", *ORDER_COLS)


def _odd_quotes() -> Column:
    """Whether a line has an odd number of quotes."""
    value = F.col("value")
    return _has_quote(value) & ((F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))) % 2 == 1)


def join_broken(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Lines with those put together that one quoted cell holds (S4). A line
    starts inside a quoted cell if the number of quotes before it, counted in
    its block and over the file's blocks before, is odd. ``headers`` has the
    separator and header cells per file."""
    data = lines.join(headers.select("file", "header_block", "header_id", "_sep", "_hdr"), "file").where(after_header()) \
        .withColumn("_odd", _odd_quotes().cast("int"))
    block, place = ["file", "file_block_start"], F.struct(*ORDER_COLS)
    # One row per block: what the blocks before it hand on.
    ends = data.groupBy(*block).agg(F.sum("_odd").alias("_n"))
    ends = ends.select(*block, (F.sum("_n").over(Window.partitionBy("file").orderBy("file_block_start")) - F.col("_n")).alias("_before"))
    inside = Window.partitionBy(*block).orderBy("line_id")
    opened = data.join(ends, block).withColumn(
        "_starts", (F.col("_before") + F.sum("_odd").over(inside) - F.col("_odd")) % 2 == 0)
    last = opened.groupBy(*block).agg(F.max(F.when(F.col("_starts"), place)).alias("_l"))
    handed = last.select(*block, F.max("_l").over(
        Window.partitionBy("file").orderBy("file_block_start").rowsBetween(Window.unboundedPreceding, -1)).alias("_handed"))
    marked = opened.join(handed, block).withColumn(
        "_record", F.coalesce(F.max(F.when(F.col("_starts"), place)).over(inside), "_handed"))
    sizes = marked.groupBy("file", "_record").agg(F.count(F.lit(1)).alias("_lines"), F.sum("_odd").alias("_quotes"))
    several = sizes.where(F.col("_lines").between(2, MAX_RECORD_LINES) & (F.col("_quotes") % 2 == 0)).select("file", "_record")
    whole = marked.join(several, ["file", "_record"]).groupBy("file", S.KEY, "_record", "_sep", "_hdr").agg(
        F.array_sort(F.collect_list(F.struct(*ORDER_COLS, "value"))).alias("_parts")).select(
        "file", S.KEY, "_record", F.array_join("_parts.value", "\n").alias("value"), "_sep", "_hdr")
    first = F.substring_index("value", "\n", 1)
    # What does not begin a quoted cell, or does not fit the header, stays apart.
    whole = whole.where(F.rlike(first, F.lit(OPEN_CELL)) & (F.size(split_cells(F.col("value"), F.col("_sep"))) == F.size("_hdr"))).select(
        "file", S.KEY, "_record", "value")
    whole = materialize(lines.sparkSession, whole, "joined-lines")
    single = marked.join(whole.select("file", "_record"), ["file", "_record"], "left_anti")
    return single.select("file", S.KEY, *ORDER_COLS, "value").unionByName(
        whole.select("file", S.KEY, *[F.col(f"_record.{c}").alias(c) for c in ORDER_COLS], "value"))


def tail_lines(lines: DataFrame, heads: DataFrame, n: int = S.TAIL_ROWS, per: str = "file") -> DataFrame:
    """Header block plus the last ``n`` data lines of each file.

    The top-n is limited map-side before the shuffle. ``per=S.KEY`` trims each
    entity over all its files instead, by file name and line."""
    h = heads.select("file", "header_block", "header_id")
    marked = lines.join(h, "file", "inner")
    is_data = after_header()
    place = ORDER_COLS if per == "file" else ("file", *ORDER_COLS)
    data = marked.where(is_data).withColumn("_o", F.struct(*place))
    last = latest_per_key(data, per, "_o", n).drop("_o")
    head = marked.where(~is_data)
    return head.unionByName(last).drop("header_block", "header_id")


def load_lines(lines: DataFrame, aliases: dict[str, list[str]] | None = None,
               date_formats: Sequence[str] = (),
               metadata_lines: int = S.GAUGE_METADATA_LINES,
               stage: bool = True, files: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Parse and keep the rows of good files: (rows, rejects, status).

    The per-file head table (one row per file) is computed once. With
    ``stage`` the parsed lines are written once to the shared folder, so the
    text is split and cast a single time and status, rows and rejects are
    read from that table (which also cuts the lineage back to the text).
    ``files`` (see :func:`scan_files`) adds empty files to the status."""
    spark = lines.sparkSession
    headers = read_headers(file_heads(lines, metadata_lines), aliases)
    if stage:
        # Written, so a number can stand for the path: lines are grouped and joined by it.
        headers = materialize(spark, headers.withColumn("_file", F.monotonically_increasing_id()), "heads")
    parsed = _cells_of(lines, headers, aliases, date_formats)
    if stage:
        parsed = materialize(spark, parsed, "parsed-lines")
        broken = materialize(spark, parsed.where("_odd").select("_file").distinct().join(
            headers.select("file", "_file"), "_file"), "broken-files")
        if not broken.isEmpty():
            # Written: they are read several times, the landed text once more.
            torn = materialize(spark, lines.join(broken, "file", "left_semi"), "broken-lines")
            whole = join_broken(torn, headers)
            again = materialize(spark, _cells_of(whole, headers, aliases, date_formats), "parsed-again")
            parsed = parsed.join(broken, "_file", "left_anti").unionByName(again)
    p = _finish(parsed, headers, stage)
    made = materialize(spark, p.orders, "file-status")
    status = made.drop("_file", "_order")
    status = status if files is None else with_empty_files(status, files)
    return accepted_rows(p, made), p.rejects, status
