"""CSV with a header, read as text in splits: normalised column names, quoted newlines, file order."""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window, functions as F, types as T

from paperledger.session import shared_dir

# Doubled quotes stand for a quote inside a quoted field.
CSV_OPTIONS = {"quote": '"', "escape": '"', "encoding": "UTF-8"}

# The rest of a quoted field behind its first quote, a field, and all fields that follow. Only a quote at the start of a field opens it;
# inside two quotes stand for one, and any other quote ends it, whatever follows. Possessive: matched in a loop, without going back.
QUOTED = r'(?s:[^"]*+(?:""[^"]*+)*+"[^,]*+)'
FIELD = f'(?s:"{QUOTED}|[^",][^,]*+|)'
ANY = f"(?:,{FIELD})*+"

# What a line that is not blank holds, as Spark's reader sees it.
PRINTED = r"[^\x00-\x20]"

# Position of a row in its source: file, first byte of the split, place in the split.
FILE_ORDER = ("src_file", "src_block", "src_pos")


def file_place() -> Column:
    """A file's name, then its folder: files of one name in several folders stay apart, in order of name."""
    return F.concat_ws(" ", F.col("_metadata.file_name"), F.regexp_replace(F.col("_metadata.file_path"), r"/[^/]*$", ""))


def files_by_header(spark: SparkSession, path: str | list[str], glob: str) -> list[list[str]]:
    """The files grouped by their first line. The driver gets their names and no more of them than it lists anyway."""
    lines = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    first = lines.filter("block = 0").groupBy("file").agg(F.min_by("value", "at").alias("header"))
    groups = first.groupBy(F.lower(F.regexp_replace("header", "[\\s\ufeff\"]", ""))).agg(F.sort_array(F.collect_list("file")).alias("files"))
    return [[unquote(f) for f in r.files] for r in groups.orderBy("files").collect()]


def spanning_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> list[str]:
    """Files, as `_metadata.file_path` tells them, in which a quoted field holds a newline.

    In all others no line opens a quote that it does not close, so each line is a record. The driver gets names only.
    """
    lines = _reader(spark, glob).option("lineSep", "\n").text(path).filter(ends_inside(F.col("value"), False))
    return [r.file for r in lines.select(F.col("_metadata.file_path").alias("file")).distinct().orderBy("file").collect()]


def _reader(spark: SparkSession, glob: str | None) -> DataFrameReader:
    return spark.read if glob is None else spark.read.option("pathGlobFilter", glob)


def ends_inside(line: Column, starts_inside: bool) -> Column:
    """True if a line ends inside a quoted field, given whether it starts inside one."""
    pattern = f"^{QUOTED}{ANY}$" if starts_inside else f"^{FIELD}{ANY}$"
    return F.when(F.contains(line, F.lit('"')), ~line.rlike(pattern)).otherwise(F.lit(starts_inside))


_closed = re.compile(f"{FIELD}{ANY}\\Z").match
_closes = re.compile(f"{QUOTED}{ANY}\\Z").match
_printed = re.compile(PRINTED).search


class _Split:
    """The lines of a split put together to records, from a given state of quotes."""

    def __init__(self, inside: bool) -> None:
        self.inside, self.held, self.nth = inside, [], 0
        self.head: str | None = None if inside else ""

    def records(self, lines: list[str]) -> list[str]:
        """Records that begin and end in the split so far. The end of one that began before is kept as `head`."""
        out = []
        for line in lines:
            if '"' in line:
                self.inside = not (_closes if self.inside else _closed)(line)
            if self.inside:
                self.held.append(line)
                continue
            if self.held:
                line = "\n".join([*self.held, line])
                self.held = []
            if self.head is None:
                self.head = line
            elif _printed(line):
                out.append(line.removesuffix("\r"))
        self.nth += len(out)
        return out

    def left(self) -> dict:
        """What a record that crosses a border of the split is made of: `head` ends one, `tail` begins one."""
        held = "\n".join(self.held)
        open_from_start = self.head is None
        return {"inside": self.inside, "nth": self.nth, "head": held if open_from_start else self.head, "tail": None if open_from_start or not self.inside else held}


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """Rows in pieces of one split each; a task reads its splits one after the other."""
    for batch in batches:
        at = 0
        ends = sorted({e for c in ("src_file", "src_block") for e in pc.run_end_encode(batch.column(c)).run_ends.to_pylist()}) if len(batch) else []
        for end in ends:
            yield batch.column("src_file")[at].as_py(), batch.column("src_block")[at].as_py(), batch.slice(at, end - at)
            at = end


LEFT = "STRUCT<inside: BOOLEAN, nth: BIGINT, head: STRING, tail: STRING>"


def splits_of(lines: DataFrame) -> DataFrame:
    """`src_file`, `src_block`, `inside`, `left` for the splits of files that have several: the state each starts in and what it leaves.

    Each split finds out what it leaves from either state it may start in. One that leaves the same state from both forgets what was
    before, any other keeps the state or turns it over; so a split starts in the state that the last forgetting one before it
    left, turned over as often as splits since then did.
    """

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{"src_file": split[0], "src_block": split[1], "out": either[0].left(), "within": either[1].left()}], schema=schema)

        part = pa.struct([("inside", pa.bool_()), ("nth", pa.int64()), ("head", pa.string()), ("tail", pa.string())])
        schema = pa.schema([("src_file", pa.string()), ("src_block", pa.int64()), ("out", part), ("within", part)])
        split, either, same = None, (_Split(False), _Split(True)), False
        for file, block, rows in _runs(batches):
            if (file, block) != split:
                if split:
                    yield row()
                split, either, same = (file, block), (_Split(False), _Split(True)), False
            texts = rows.column("value").to_pylist()
            at = 0
            while not same and at < len(texts):
                for state in either:
                    state.records(texts[at:at + 1])
                same = not either[0].inside and not either[1].inside
                at += 1
            if same:  # outside of quotes in both: they go on alike
                either[1].nth += len(either[0].records(texts[at:]))
                either[1].inside, either[1].held = either[0].inside, either[0].held
        if split:
            yield row()

    parts = lines.filter("several").select("src_file", "src_block", "value")
    found = parts.mapInArrow(told, f"src_file STRING, src_block BIGINT, out {LEFT}, within {LEFT}")
    # One row a split, those of one file in a window.
    before = Window.partitionBy("src_file").orderBy("src_block").rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("turns", F.coalesce(F.sum(F.expr("CAST(out.inside AND NOT within.inside AS INT)")).over(before), F.lit(0)))
    forgets = F.when(F.expr("out.inside = within.inside"), F.struct(F.col("out.inside").alias("state"), F.col("turns").alias("turns")))
    known = F.last(forgets, ignorenulls=True).over(before)
    inside = F.coalesce(known["state"], F.lit(False)) != ((F.col("turns") - F.coalesce(known["turns"], F.lit(0))) % 2 == 1)
    found = found.withColumn("inside", inside)
    return found.select("src_file", "src_block", "inside", F.when(F.col("inside"), F.col("within")).otherwise(F.col("out")).alias("left"))


def stitched(lines: DataFrame) -> DataFrame:
    """Records of lines (`value`, `src_file`, `src_block`, `several`): `record`, `is_header`, and `FILE_ORDER` columns that count records.

    Lines are put together where they are read, a split's lines in order, so nothing is shuffled but one row for each split, which
    holds the parts of records that cross its borders. Blank lines outside of quotes are no records, and the CR of a CRLF that
    ends a record is not part of it. A quote that is never closed takes the rest of its file, without the newline that ends it.
    """
    # One row a split, written once: both uses see the same.
    shared_dir(lines.sparkSession)
    splits = splits_of(lines).checkpoint()
    # Small beside the list of splits that the driver holds; a shuffle would lose the order of lines.
    inside = F.broadcast(splits.filter("inside").select("src_file", "src_block", "inside"))
    told = lines.join(inside, ["src_file", "src_block"], "left")
    told = told.select("src_file", "src_block", "value", "several", F.coalesce("inside", F.lit(False)).alias("inside"))

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of(found: list[str], nth: int) -> pa.RecordBatch:
            n = len(found)
            return pa.RecordBatch.from_arrays(
                [pa.repeat(split[0], n), pa.repeat(pa.scalar(split[1], pa.int64()), n), pa.array(found, pa.string()), pa.array(range(nth, nth + n), pa.int64())],
                names=["src_file", "src_block", "record", "nth"])

        def rest() -> list[str]:
            # Where a file is one split, no other tells of a quote that is never closed.
            return ["\n".join(state.held)] if state.held and not several else []

        split, state, several = ("", 0), _Split(False), False
        for file, block, rows in _runs(batches):
            if (file, block) != split:
                yield rows_of(rest(), state.nth)
                split, state, several = (file, block), _Split(rows.column("inside")[0].as_py()), rows.column("several")[0].as_py()
            nth = state.nth
            yield rows_of(state.records(rows.column("value").to_pylist()), nth)
        yield rows_of(rest(), state.nth)

    split = ["src_file", "src_block"]
    whole = told.mapInArrow(put_together, "src_file string, src_block long, record string, nth long")
    # A tail begins a record; the heads of the splits after it belong to it.
    ends = splits.select(*split, F.explode(F.array(
        F.struct(F.lit(0).alias("place"), F.when(F.col("inside"), F.col("left.head")).alias("part"), F.lit(None).cast("long").alias("nth")),
        F.struct(F.lit(1).alias("place"), F.col("left.tail").alias("part"), F.col("left.nth").alias("nth")))).alias("p")).select(*split, "p.*")
    begun = F.sum("place").over(Window.partitionBy("src_file").orderBy("src_block", "place"))
    parts = ends.filter("part IS NOT NULL").withColumn("begun", begun).groupBy("src_file", "begun").agg(
        F.array_sort(F.collect_list(F.struct("src_block", "place", "part", "nth"))).alias("parts"))
    first = F.get("parts", F.lit(0))
    crossing = parts.select(
        "src_file", first["src_block"].alias("src_block"), F.regexp_replace(F.array_join(F.transform("parts", lambda x: x["part"]), "\n"), "\r$", "").alias("record"),
        first["nth"].alias("nth"))
    # The header of a file is the first record of its first split and does not count.
    at_start = F.col("src_block") == 0
    return whole.unionByName(crossing).select(
        "record", (at_start & (F.col("nth") == 0)).alias("is_header"), *split, (F.col("nth") - at_start.cast("long")).alias("src_pos"))


def read_csv_text(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """All columns as strings under lower-cased, trimmed names, plus the `FILE_ORDER` columns.

    Of two headers that become the same name the last wins. Large files are read in splits, those with quoted newlines
    too (see `stitched`); the others need no more than Spark's reader. Files whose header differs from the first one's are
    refused rather than read by position.
    """
    spanning = spanning_files(spark, path, glob)
    first = _reader(spark, glob).options(**CSV_OPTIONS).option("header", False).csv(path).limit(1).collect()
    if not first:
        return spark.createDataFrame([], "src_file string, src_block long, src_pos long")
    raw = [(h or "").removeprefix("\ufeff") for h in first[0]]
    names = [h.lower().strip() for h in raw]
    distinct = len(set(h.lower() for h in raw)) == len(raw) and "" not in raw
    headers = raw if distinct else [f"c{i}" for i in range(len(raw))]
    schema = T.StructType([T.StructField(h, T.StringType()) for h in headers])

    reader = _reader(spark, glob).options(**CSV_OPTIONS).option("header", True).option("enforceSchema", not distinct)
    df = reader.schema(schema).csv(path)
    if spanning:
        # Before the place is told: Spark then leaves these files out.
        df = df.filter(~F.col("_metadata.file_path").isin(*spanning))
    df = df.select("*", *_place())
    if spanning:
        several = (F.col("_metadata.file_block_length") < F.col("_metadata.file_size")).alias("several")
        lines = spark.read.option("lineSep", "\n").text([unquote(f) for f in spanning]).select("value", *_place(), several)
        df = df.unionByName(_parsed(stitched(lines), headers, names if distinct else None))
    last = {name: i for i, name in enumerate(names) if name}
    return df.select(*[F.col(f"`{headers[i]}`").alias(name) for name, i in last.items()], *FILE_ORDER)


def _place() -> list[Column]:
    return [file_place().alias("src_file"), F.col("_metadata.file_block_start").alias("src_block"), F.monotonically_increasing_id().alias("src_pos")]


def _parsed(records: DataFrame, headers: list[str], names: list[str] | None) -> DataFrame:
    """Fields of records without the header lines, which must hold `names` if given."""
    columns = [f"c{i}" for i in range(len(headers))]
    fields = F.from_csv("record", ", ".join(f"{c} string" for c in columns), CSV_OPTIONS)
    data = ~F.col("is_header")
    if names is not None:
        found = F.array(*(F.lower(F.trim(F.replace(F.coalesce(fields[c], F.lit("")), F.lit("\ufeff"), F.lit("")))) for c in columns))
        other = F.raise_error(F.concat(F.lit("the header differs from that of the first file: "), "src_file", F.lit(": "), "record")).cast("boolean")
        data = F.when(data, True).when(found == F.array(*map(F.lit, names)), False).otherwise(other)
    # A generator of one row: each record is parsed once and not again for each of its fields.
    rows = records.filter(data).select(F.inline(F.array(fields)), *FILE_ORDER)
    return rows.select(*[F.col(c).alias(h) for c, h in zip(columns, headers)], *FILE_ORDER)


def place_in_file(block: str = "src_block", pos: str = "src_pos") -> Column:
    """A number that grows along a file, over all its splits.

    A row takes a byte at least, so the start of a split plus a row's place in its task exceeds all of the splits before, which but
    for the last one have a task of their own.
    """
    return F.col(block) + F.col(pos).bitwiseAND((1 << 33) - 1)
