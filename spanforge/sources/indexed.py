"""Long sequences by index: FASTA read by byte ranges, as blocks, and intervals fetched from blocks.

A chromosome is never one row. An index has for each sequence its name, length, byte offset of
the first base, and bases and bytes of a line; it is made with Spark or read from a file, and a
data source plans its partitions from it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

BLOCK = 65_536
#: Bases that a task reads.
TASK = 64 * BLOCK
INDEX = "name string, length bigint, offset bigint, line_bases bigint, line_width bigint"


def fasta_index(spark: SparkSession, path: str) -> DataFrame:
    """file and index columns of the FASTA files at path, as Spark's splits of them say.

    Every line belongs to one split, so a split begins where the bytes of those before it end; and
    a line to the last header before it, in its own split or an earlier one. Only widths of lines
    are ordered, a split at a time.
    """
    raw = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("nth"))
    head = F.col("value").startswith(">")
    name = F.split(F.trim(F.substring(F.regexp_replace("value", "\r$", ""), 2, 2**31 - 1)), r"\s+")[0]
    lines = raw.select("file", "split", "nth", F.when(head, name).alias("name"), (F.octet_length("value") + 1).cast("bigint").alias("width"), F.octet_length(F.regexp_replace("value", "\r$", "")).cast("bigint").alias("bases"))
    inside = Window.partitionBy("file", "split").orderBy("nth")
    lines = lines.withColumn("at", F.sum("width").over(inside.rowsBetween(Window.unboundedPreceding, -1))).withColumn("at", F.coalesce("at", F.lit(0)))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("file", "split").agg(F.sum("width").alias("bytes"), F.max(F.when(F.col("name").isNotNull(), F.col("at"))).alias("last"))
    splits = splits.withColumn("begin", F.coalesce(F.sum("bytes").over(before), F.lit(0)))
    splits = splits.withColumn("carried", F.max(F.col("begin") + F.col("last")).over(before)).select("file", "split", "begin", "carried")
    placed = lines.join(splits, ["file", "split"]).withColumn("at", F.col("at") + F.col("begin"))
    own = F.max(F.when(F.col("name").isNotNull(), F.col("at"))).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    owned = placed.withColumn("header", F.coalesce(own, "carried")).filter("header IS NOT NULL")
    base = F.col("name").isNull() & (F.col("bases") > 0)
    first = lambda c: F.min_by(c, F.when(base, F.col("at")))
    made = owned.groupBy("file", "header").agg(F.max("name").alias("name"), F.coalesce(F.sum(F.when(base, F.col("bases"))), F.lit(0)).alias("length"), F.min(F.when(base, F.col("at"))).alias("offset"), first("bases").alias("line_bases"), first("width").alias("line_width"))
    return made.select("file", "name", "length", F.coalesce("offset", "header").alias("offset"), F.coalesce("line_bases", F.lit(0)).alias("line_bases"), F.coalesce("line_width", F.lit(0)).alias("line_width"))


@dataclass
class Run(InputPartition):
    """Pieces (name, length, offset, line_bases, line_width, first block, end block) of one file that a task reads."""

    file: str
    pieces: list[tuple]


class FastaBlocks(DataSource):
    """chrom, block, seq of indexed FASTA; see ``read_blocks``."""

    @classmethod
    def name(cls) -> str:
        return "fasta_blocks"

    def schema(self) -> str:
        return "chrom string, block bigint, seq string"

    def reader(self, schema: StructType) -> FastaReader:
        return FastaReader(dict(self.options))


class FastaReader(DataSourceReader):
    def __init__(self, options: dict):
        self.block = int(options.get("block", BLOCK))
        self.index, self.regions = options["index"], options.get("regions")

    def _wanted(self, name: str, length: int) -> list[tuple[int, int]]:
        """Runs of blocks of a sequence that are asked for, joined where they touch."""
        last = max(-(-length // self.block), 1)
        if self.regions is None:
            return [(0, last)]
        spans = []
        for region in filter(None, self.regions.split("\n")):
            chrom, _, span = region.rpartition(":")
            if chrom == name:
                start, end = (int(x) for x in span.split("-"))
                if end > start and start < length:
                    spans.append((start // self.block, min(-(-end // self.block), last)))
        out: list[tuple[int, int]] = []
        for a, b in sorted(spans):
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], max(b, out[-1][1]))
            else:
                out.append((a, b))
        return out

    def partitions(self) -> Sequence[InputPartition]:
        most, runs, size = max(TASK // self.block, 1), [], 0
        for line in _open(self.index).readall().decode().splitlines():
            file, name, *numbers = line.split("\t")
            length, *shape = (int(x) for x in numbers)
            for a, b in self._wanted(name, length):
                for low in range(a, b, most):
                    up = min(low + most, b)
                    if not runs or runs[-1].file != file or size + up - low > most:
                        runs.append(Run(file, []))
                        size = 0
                    runs[-1].pieces.append((name, length, *shape, low, up))
                    size += up - low
        return runs or [Run("", [])]

    def read(self, partition: Run) -> Iterator[pa.RecordBatch]:
        for name, length, offset, bases, width, first, end in partition.pieces:
            low, up = first * self.block, min(end * self.block, length)
            seq = b""
            if up > low:
                with _open(partition.file) as f:
                    begin = offset + low // bases * width + low % bases
                    stop = offset + (up - 1) // bases * width + (up - 1) % bases + 1
                    seq = f.read_at(stop - begin, begin).translate(None, b"\r\n")
            text = seq.decode()
            blocks = range(first, end)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(blocks)), pa.array(list(blocks), pa.int64()), pa.array([text[i * self.block - low : (i + 1) * self.block - low] for i in blocks])], names=["chrom", "block", "seq"])


def _open(path: str) -> pa.NativeFile:
    from pathlib import PurePosixPath
    from urllib.parse import unquote

    if "://" not in path and not path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem().open_input_file(path)
    if path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem().open_input_file(str(PurePosixPath("/") / unquote(path[5:]).lstrip("/")))
    system, place = pyarrow.fs.FileSystem.from_uri(path)
    return system.open_input_file(place)


def write_index(index: DataFrame, path: str) -> str:
    """The index as one tab-separated file, and where it is; sequences are as many rows."""
    line = F.concat_ws("\t", *[F.col(c).cast("string") for c in ("file", "name", "length", "offset", "line_bases", "line_width")])
    index.orderBy("file", "offset").select(line.alias("value")).coalesce(1).write.text(path)
    return index.sparkSession.read.text(path).select("_metadata.file_path").first()[0]


def read_blocks(spark: SparkSession, index: str, regions: list[tuple[str, int, int]] | None = None, block: int = BLOCK) -> DataFrame:
    """chrom, block, seq of the files that an index names (file, name, length, offset, line_bases, line_width by tabs).

    regions(chrom, start, end): a bounded list; with it only the blocks that they touch are read.
    """
    spark.dataSource.register(FastaBlocks)
    reader = spark.read.format("fasta_blocks").option("index", index).option("block", str(block))
    if regions is not None:
        reader = reader.option("regions", "\n".join(f"{c}:{max(s, 0)}-{e}" for c, s, e in regions if e > 0))
    return reader.load()


def cut_blocks(seqs: DataFrame, size: int = BLOCK) -> DataFrame:
    """seqs(chrom, seq) as chrom, block, seq; a sequence without bases is one empty block."""
    n = F.greatest(F.lit(1), F.ceil(F.char_length("seq") / size)).cast("bigint")
    rows = seqs.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1)))
    return rows.select("chrom", "block", F.expr(f"substring(seq, CAST(block * {size} + 1 AS INT), {size})").alias("seq"))


def fetch(wanted: DataFrame, blocks: DataFrame, size: int = BLOCK) -> DataFrame:
    """wanted(chrom, start, end) with seq, clamped to the sequence; empty where it has nothing, null where there is no such sequence.

    Each interval meets the blocks it touches and gets its part of each; no task holds more of a
    sequence than that.
    """
    place = F.struct("chrom", "start", "end").alias("place")
    need = wanted.select("chrom", "start", "end").distinct().filter("end > start AND end > 0").withColumn("low", F.greatest("start", F.lit(0)))
    need = need.withColumn("block", F.explode(F.expr(f"sequence(low div {size}, (end - 1) div {size})")))
    first = F.greatest(F.col("low") - F.col("block") * size, F.lit(0))
    last = F.least(F.col("end") - F.col("block") * size, F.lit(size))
    parts = need.join(blocks, ["chrom", "block"]).select(place, "block", F.substring("seq", (first + 1).cast("int"), (last - first).cast("int")).alias("part"))
    whole = parts.groupBy("place").agg(F.array_sort(F.collect_list(F.struct("block", "part"))).alias("parts")).select("place", F.array_join("parts.part", "").alias("seq"))
    known = blocks.filter("block = 0").select("chrom", F.lit("").alias("none")).distinct()
    return wanted.join(known, "chrom", "left").join(whole, F.struct(wanted["chrom"], wanted["start"], wanted["end"]) == F.col("place"), "left").select(*[wanted[c] for c in wanted.columns], F.coalesce("seq", "none").alias("seq"))
