"""Small helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itinera.session import scratch_path

#: Unicode White_Space, as the regular expressions of the tokenizers see it (fixed values).
WHITE = "\t-\r \x85\xa0  -     　"


#: Bytes of an Arrow batch that become Python lists at once.
SLICE = 8_000_000


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written once below the shared checkpoint folder and read back: it cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def squeeze(data: bytes, level: int = 6) -> bytes:
    """Compressed bytes, with their length before compression in front."""
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", compression_level=level).compress(data, asbytes=True)


def unsqueeze(packed: bytes) -> bytes:
    return pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)


def text_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only (doc_id long, text string); whatever other columns there are cannot clash with an operator's own."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def map_rows(df: DataFrame, rows: Callable[[Iterable[dict]], Iterable[tuple]], schema: str, lists: bool = True) -> DataFrame:
    """mapInArrow over column lists: ``rows`` gets one dict of Python lists a batch (or, without ``lists``, the batch itself)
    and yields column tuples.

    Batches of wide rows come in slices of about ``SLICE`` bytes, as lists of texts take several times their bytes."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    types = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[dict | pa.RecordBatch]:
            for batch in batches:
                step = max(1, len(batch) // max(1, batch.nbytes // SLICE))
                for at in range(0, max(1, len(batch)), step):
                    part = batch.slice(at, step)
                    yield {n: part.column(i).to_pylist() for i, n in enumerate(batch.schema.names)} if lists else part

        for columns in rows(parts()):
            yield pa.RecordBatch.from_arrays(
                [x if isinstance(x, pa.Array) else pa.array(x, type=f.type) for x, f in zip(columns, types, strict=True)], schema=types
            )

    return df.mapInArrow(run, schema)


def crc32_of(column: str = "doc_id") -> Column:
    """crc32 of the id written as text; null ids count as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def lowest(rows: DataFrame, bits: Column, order: list[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows in ``order``, which begins with a hash whose unsigned 64-bit value is ``bits``.

    A count by leading zeros of the hash finds the threshold below which about n to 2n rows lie; only these are ordered, so
    that no task gets the first n rows of every partition.
    """
    zeros = F.lit(64) - F.length(F.bin(bits))
    counts = {r["zeros"]: r["count"] for r in rows.groupBy(zeros.alias("zeros")).count().collect()}  # 64 rows at most
    bar, have = 0, 0
    for bar in sorted(counts, reverse=True):
        have += counts[bar]
        if have >= n:
            break
    return rows.where(zeros >= bar).orderBy(*order).limit(n)


def unsigned(hash_: Column) -> Column:
    """The bits by which a signed 64-bit hash is ordered, as :func:`lowest` takes them."""
    return hash_.bitwiseXOR(F.lit(-(2**63)))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the undirected edges (a, b); component is the smallest node reachable.

    Alternating large and small stars: each round two partial aggregates and two joins, which adaptive execution can
    split at a hot hub. The edge list is written once a round; only a count and a checksum reach the driver.
    """
    far = F.greatest("a", "b").alias("hi")
    near = F.least("a", "b").alias("lo")
    star = stored(edges.where("a <> b").select(far, near).distinct(), "edges")
    seen = None
    while True:
        both = star.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(star.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        down = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (
            large.join(down, "hi")
            .select(F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
            .select("e.hi", "e.lo")
            .where("hi <> lo")
            .distinct()
        )
        star = stored(small, "edges")
        now = tuple(star.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())
        if now == seen or now[0] == 0:
            break
        seen = now
    roots = star.select(F.col("lo").alias("node")).distinct()
    return star.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
