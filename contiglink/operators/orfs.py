"""Open reading frames of contigs, scanned in chunks whose ends are stitched."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import staged
from .regions import SPAN

CHUNK = 1 << 20
#: Codons of the bacterial genetic code, and pairs of complementary letters.
STARTS, STOPS = ("ATG", "GTG", "TTG"), ("TAA", "TAG", "TGA")
COMPLEMENT = {"A": "T", "C": "G", "G": "C", "T": "A"}

_CODE = np.full(256, 64, np.int64)
for _k, _letters in enumerate(("Aa", "Cc", "Gg", "Tt")):
    for _x in _letters:
        _CODE[ord(_x)] = _k


def _table(codons: tuple[str, ...], turn: bool) -> np.ndarray:
    """Whether each codon number is one of these, read on the strand itself or, turned, on the other one."""
    out = np.zeros(64, bool)
    for c in codons:
        own = "".join(COMPLEMENT[x] for x in reversed(c)) if turn else c
        out[sum("ACGT".index(x) << 2 * (2 - j) for j, x in enumerate(own))] = True
    return out


_MARKS = {turn: (_table(STARTS, turn), _table(STOPS, turn)) for turn in (False, True)}


def chunks_of(index: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Intervals that cut every contig of an index into chunks, each with the two letters that its last codons need."""
    cut = index.where("length >= 3").withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / chunk))))
    return cut.select("contig", (F.col("k") * chunk).alias("start"), F.least(F.col("length"), (F.col("k") + 1) * chunk + 2).alias("stop"), F.lit("chunk").alias("region_title"))


_SCAN = "contig string, at long, frame int, low long, high long, first_stop long, last_stop long, head long, tail long"


def scan_chunk(letters: bytes, at: int, own: int) -> Iterator[tuple]:
    """Of the codons that start in a chunk's own letters, by frame: what lies between two stops of the chunk, and what its ends tell.

    Frames 0 to 2 read upward, 3 to 5 downward. A row is either a reading frame (low, high) or the chunk's first and
    last stop with its head (the start codon that counts before the first stop) and tail (that after the last one).
    Upward the first start counts, downward the last, as it is the far end of the frame.
    """
    code = _CODE[np.frombuffer(letters, np.uint8)]
    n = min(own, len(code) - 2)
    if n <= 0:
        return
    codon = (code[:n] << 4) + (code[1 : n + 1] << 2) + code[2 : n + 2]
    known = (code[:n] < 64) & (code[1 : n + 1] < 64) & (code[2 : n + 2] < 64)
    codon = np.where(known, codon, 0)
    place = np.arange(at, at + n)
    for turn, (is_start, is_stop) in _MARKS.items():
        starts, stops = place[known & is_start[codon]], place[known & is_stop[codon]]
        for f in range(3):
            s, e = starts[starts % 3 == f], stops[stops % 3 == f]
            frame = f + 3 * turn
            if not len(e):
                yield None, None, frame, None, None, int(s[-1] if turn else s[0]) if len(s) else None, None
                continue
            gap = np.searchsorted(e, s)  # stops before each start
            if turn:
                last = np.full(len(e) + 1, -1, np.int64)
                last[gap] = s  # the last start of a gap stays
                picked = last
            else:
                picked = np.full(len(e) + 1, -1, np.int64)
                picked[gap[::-1]] = s[::-1]
            inner = np.flatnonzero(picked[1:-1] >= 0) + 1
            for low, high in zip((e[inner - 1] if turn else picked[inner]).tolist(), (picked[inner] if turn else e[inner]).tolist()):
                yield low, high + 3, frame, None, None, None, None
            head, tail = (int(picked[k]) if picked[k] >= 0 else None for k in (0, -1))
            yield None, None, frame, int(e[0]), int(e[-1]), head, tail


def orf_scan(chunks: DataFrame, lengths: DataFrame, min_length: int = 90, chunk: int = CHUNK, span: int = SPAN) -> DataFrame:
    """orf, start, end (from 1, both inclusive), strand and metadata of the open reading frames of all six frames.

    chunks: name (as chunks_of has it read), part and sequence; lengths: contig and length. A frame goes from the
    first start codon after a stop to the next stop, which belongs to it. Where a contig's edge comes first, the frame
    is partial and goes to the edge's last whole codon (partial=10: its low end is missing, 01: its high end). Frames
    of at least min_length letters are numbered by start within their contig. Letters other than ACGT are in no codon.

    Chunks are scanned one by one. A frame that runs over chunks is made of the chunks' end states: stops seen so far
    number the frames of a contig, a row a chunk and frame, and each frame's far start is an aggregate over its rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.int64(), pa.int32(), *[pa.int64()] * 6]
        for batch in batches:
            for contig, at, text in zip(*(batch.column(k) for k in range(3))):
                contig, at = contig.as_py(), at.as_py()
                rows = [(contig, at, frame, low, high, *ends) for low, high, frame, *ends in scan_chunk(text.as_py().encode("utf-8"), at, chunk)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [x.split()[0] for x in _SCAN.split(", ")])

    placed = chunks.select(F.regexp_extract("name", "(?s)^chunk::(.*):[0-9]+-[0-9]+$", 1).alias("contig"), F.regexp_extract("name", ":([0-9]+)-[0-9]+$", 1).cast("long").alias("at"), "sequence")
    found = staged(placed.mapInArrow(run, _SCAN), "orf-scan")
    inner = found.where("low is not null").select("contig", "frame", "low", "high", F.lit("00").alias("partial"))
    before = Window.partitionBy("contig", "frame").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    ends = found.where("low is null").withColumn("g", F.coalesce(F.count("first_stop").over(before), F.lit(0)))
    piece = lambda g, far, opens, closes: F.struct(g.alias("g"), F.col(far).alias("far"), opens.alias("opens"), closes.alias("closes"))
    none = F.lit(None).cast("long")
    closing = piece(F.col("g"), "head", none, F.col("first_stop"))
    opening = piece(F.col("g") + 1, "tail", F.col("last_stop"), none)
    rows = ends.select("contig", "frame", F.explode(F.when(F.col("first_stop").isNotNull(), F.array(closing, opening)).otherwise(F.array(closing))).alias("p")).select("contig", "frame", "p.*")
    frames = rows.groupBy("contig", "frame", "g").agg(F.min("far").alias("first"), F.max("far").alias("last"), F.max("opens").alias("opens"), F.max("closes").alias("closes"))
    frames = frames.join(lengths.select("contig", "length"), "contig").withColumn("f", F.col("frame") % 3)
    edge = F.col("length") - (F.col("length") - F.col("f")) % 3  # behind the last whole codon
    up = F.col("frame") < 3
    low = F.when(up, F.when(F.col("g") == 0, F.col("f").cast("long")).otherwise(F.col("first"))).otherwise(F.when(F.col("g") == 0, F.col("f").cast("long")).otherwise(F.col("opens")))
    high = F.when(up, F.coalesce(F.col("closes") + 3, edge)).otherwise(F.when(F.col("closes").isNull(), edge).otherwise(F.col("last") + 3))
    partial = F.concat(F.when(F.col("g") == 0, "1").otherwise("0"), F.when(F.col("closes").isNull(), "1").otherwise("0"))
    across = frames.select("contig", "frame", low.alias("low"), high.alias("high"), partial.alias("partial"))
    every = inner.unionByName(across).where(F.col("high") - F.col("low") >= min_length)
    every = every.select("contig", (F.col("low") + 1).alias("start"), F.col("high").alias("end"), F.when(F.col("frame") < 3, 1).otherwise(-1).alias("strand"), "partial", F.floor(F.col("low") / span).alias("span"))
    every = staged(every, "orfs")
    spans = Window.partitionBy("contig").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)  # a row a span
    carried = every.groupBy("contig", "span").count().select("contig", "span", F.coalesce(F.sum("count").over(spans), F.lit(0)).alias("carried"))
    number = F.row_number().over(Window.partitionBy("contig", "span").orderBy("start", "end", "strand")) + F.col("carried")
    named = every.join(carried, ["contig", "span"]).withColumn("n", number.cast("string"))
    return named.select(F.concat("contig", F.lit("_"), "n").alias("orf"), "start", "end", "strand", F.concat(F.lit("ID="), "n", F.lit(";partial="), "partial").alias("metadata"))
