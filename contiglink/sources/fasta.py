"""FASTA files by byte ranges: an index made of pieces of any record, and sequences read through it.

No record is ever a row: files are cut into pieces of equal size, wherever records and lines end, and intervals into
parts of bounded length. So a record may be longer than a task could hold.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .staging import staged

PIECE = 8 << 20  # bytes of a file that are looked at together
#: A line whose start is further back is no header line: names and descriptions are shorter.
HEADER = 1 << 20
PART = 1 << 20  # letters of an interval in one row
BLOCK = 64 << 20  # intervals that start so near to each other are read by one task
NEAR = 4096  # bytes between two ranges that are read along
AT_ONCE = 16 << 20


class Bytes:
    """A file opened for reads at places, local or in a store that pyarrow knows."""

    def __init__(self, uri: str):
        self.uri = uri
        if uri.startswith("file:") or "://" not in uri:
            path = "/" + uri.removeprefix("file:").lstrip("/") if uri.startswith("file:") else uri
            self.file, self.size = open(path, "rb"), os.path.getsize(path)
        else:
            from pyarrow import fs

            store, path = fs.FileSystem.from_uri(uri)
            self.file, self.size = store.open_input_file(path), store.get_file_info(path).size

    def read(self, start: int, end: int) -> bytes:
        self.file.seek(max(0, start))
        return self.file.read(max(0, min(end, self.size) - max(0, start)))

    def __enter__(self) -> Bytes:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        self.file.close()


def file_sizes(spark: SparkSession, path) -> DataFrame:
    """file and size of files, folders or globs; contents are not read."""
    return spark.read.format("binaryFile").load(path).where("length > 0").select(F.col("path").alias("file"), F.col("length").alias("size"))


def pieces(spark: SparkSession, path, piece_bytes: int = PIECE) -> DataFrame:
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(piece_bytes).cast("long")))
    cut = file_sizes(spark, path).select("file", starts.alias("start"))
    return cut.repartition(max(spark.sparkContext.defaultParallelism, 1) * 4, "file", "start")


def _letters(data: bytes) -> int:
    return len(data) - sum(map(data.count, (b"\n", b"\r", b" ", b"\t")))


def piece_records(file: Bytes, start: int, end: int) -> Iterator[tuple]:
    """(header's place or None for what goes on from before, name, place of the first letter, letters, end of the first line or None, carriage return) of each record in a piece."""
    data = file.read(start, end)
    fresh = not start or file.read(start - 1, start) == b"\n"
    inside = 0
    if not fresh:
        before = file.read(start - HEADER, start)
        line = before.rfind(b"\n") + 1
        if (line or len(before) < HEADER) and before[line : line + 1] == b">":  # the piece starts within a header line
            cut = data.find(b"\n")
            inside = len(data) if cut < 0 else cut + 1
    heads = [0] if fresh and data.startswith(b">") else []
    at = data.find(b"\n>")
    while at >= 0:
        heads.append(at + 1)
        at = data.find(b"\n>", at + 1)
    first = heads[0] if heads else len(data)
    if inside < first:
        body = data[inside:first]
        line = body.find(b"\n")
        before = body[line - 1 : line] if line > 0 else file.read(start + inside - 1, start + inside) if not line else b""
        yield None, None, None, _letters(body), None if line < 0 else start + inside + line, before == b"\r"
    for head, until in zip(heads, [*heads[1:], len(data)]):
        cut = data.find(b"\n", head, until)
        if cut < 0:  # the header line goes on in the next piece, which skips it
            rest = file.read(start + head, start + head + HEADER)
            cut = rest.find(b"\n")
            title, letter = rest[1 : cut if cut >= 0 else len(rest)], start + head + (cut + 1 if cut >= 0 else len(rest))
            body = b""
        else:
            title, letter, body = data[head + 1 : cut], start + cut + 1, data[cut + 1 : until]
        name = title.decode("utf-8", "replace").split()
        line = body.find(b"\n")
        yield start + head, name[0] if name else "", letter, _letters(body), None if line < 0 else letter + line, line > 0 and body[line - 1 : line] == b"\r"


_RECORDS = "file string, start long, head long, contig string, offset long, letters long, line_end long, cr boolean"


def index_fasta_file(spark: SparkSession, path, piece_bytes: int = PIECE) -> DataFrame:
    """file, contig, length, offset, linebases, linewidth: as FAI files have them, of each record with a name.

    A record's letters are summed over the pieces that it runs through. What a piece starts with belongs to the last
    header before it, which a row a piece tells.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
        names = [x.split()[0] for x in _RECORDS.split(", ")]
        for batch in batches:
            for uri, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with Bytes(uri) as file:
                    rows = [(uri, start, *r) for r in piece_records(file, start, start + piece_bytes)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    found = staged(pieces(spark, path, piece_bytes).mapInArrow(run, _RECORDS), "fasta-records")
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)  # a row a piece
    last = found.groupBy("file", "start").agg(F.max("head").alias("top")).select("file", "start", F.last("top", ignorenulls=True).over(earlier).alias("carried"))
    rows = found.join(last, ["file", "start"]).withColumn("head", F.coalesce("head", "carried")).where("head is not null")
    of = rows.groupBy("file", "head").agg(F.max("contig").alias("contig"), F.max("offset").alias("offset"), F.sum("letters").alias("length"), F.min(F.when(F.col("line_end").isNotNull(), F.struct("line_end", "cr"))).alias("line"))
    bases = F.coalesce(F.col("line.line_end") - F.col("offset") - F.col("line.cr").cast("long"), F.col("length"))
    width = F.coalesce(F.col("line.line_end") - F.col("offset") + 1, F.col("length") + 1)
    return of.where("contig <> ''").select("file", "contig", "length", "offset", bases.alias("linebases"), width.alias("linewidth"))


def fasta_ranges(bed: DataFrame, index: DataFrame, part: int = PART) -> DataFrame:
    """name (`title::contig:start-stop`), part and sequence of each interval (zero-based, stop exclusive) within its contig.

    bed: contig, start, stop, region_title. index: of index_fasta_file. The index turns intervals into byte ranges;
    ranges that start in one block of a file are read together, those that touch in one read, and nothing else of the
    file is. An interval longer than `part` letters comes in several rows, numbered from 0.
    """
    fit = bed.select("contig", "start", "stop", "region_title").join(index, "contig").where((F.col("start") >= 0) & (F.col("stop") <= F.col("length")) & (F.col("stop") > F.col("start")))
    cut = fit.withColumn("part", F.explode(F.sequence(F.lit(0), F.floor((F.col("stop") - F.col("start") - 1) / part).cast("int"))))
    cut = cut.withColumn("a", F.col("start") + F.col("part").cast("long") * part).withColumn("b", F.least(F.col("stop"), F.col("a") + part) - 1)
    place = lambda x: (F.col("offset") + F.floor(F.col(x) / F.col("linebases")) * F.col("linewidth") + F.col(x) % F.col("linebases")).cast("long")
    name = F.concat("region_title", F.lit("::"), "contig", F.lit(":"), F.col("start").cast("string"), F.lit("-"), F.col("stop").cast("string"))
    ranges = cut.select(name.alias("name"), "part", "file", place("a").alias("first"), (place("b") + 1).alias("last"))
    placed = ranges.withColumn("block", F.floor(F.col("first") / BLOCK)).repartition("file", "block").sortWithinPartitions("file", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file: Bytes | None = None
        for batch in batches:
            names, parts, files, firsts, lasts = (batch.column(k).to_pylist() for k in range(5))
            k = 0
            while k < len(names):
                end, until = k + 1, lasts[k]
                while end < len(names) and files[end] == files[k] and firsts[end] <= until + NEAR and max(until, lasts[end]) - firsts[k] <= AT_ONCE:
                    until, end = max(until, lasts[end]), end + 1
                if file is None or file.uri != files[k]:
                    if file is not None:
                        file.close()
                    file = Bytes(files[k])
                data = file.read(firsts[k], until)
                texts = [_plain(data[a - firsts[k] : b - firsts[k]]) for a, b in zip(firsts[k:end], lasts[k:end])]
                yield pa.RecordBatch.from_arrays([pa.array(names[k:end], pa.string()), pa.array(parts[k:end], pa.int32()), pa.array(texts, pa.string())], ["name", "part", "sequence"])
                k = end

    return placed.select("name", "part", "file", "first", "last").mapInArrow(run, "name string, part int, sequence string")


def _plain(data: bytes) -> str:
    return data.translate(None, b"\r\n \t").decode("utf-8", "replace")


def write_parts(parts: DataFrame, path: str) -> None:
    """Records of name, part and sequence as FASTA; a record's parts are lines one after the other."""
    rows = parts.repartition("name").sortWithinPartitions("name", "part")
    rows.select(F.when(F.col("part") == 0, F.concat(F.lit(">"), "name", F.lit("\n"), "sequence")).otherwise(F.col("sequence")).alias("value")).write.text(path)
