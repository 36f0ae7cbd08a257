"""Vector code compression: product codes from integer k-means, each nearest entry found by Orchard's search.

A vector of floor(1024 x) integers is cut into parts, and every part position has
its own codebook of at most 256 entries.  Each round assigns the parts of all
vectors and moves every entry to the floor of its parts' mean; all of it is integer
arithmetic, so the result does not depend on how the rows are spread.

The nearest entry is found by Orchard's search.  Every entry has a list of all
entries by distance from it.  A query holds the best entry so far and walks that
entry's list; an entry that is better sends it to its own list, entries it has met
are marked and not measured again, and it stops where the list is farther than
twice the query's own distance, beyond which nothing can be as near.  An entry at
exactly twice the distance is still looked at, so that ties go to the lower index.
Queries of a batch walk together, each at its own place.

Between rounds only codebooks pass through the driver: 256 entries a part.  What
a task sends is one row of sums per entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from recordlake.llm.common import packed, written

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Integers of this size and more would let a sum of squares leave 64 bits.
_LIMIT = 1 << 26
#: Vectors that walk together.
_STEP = 1 << 12

Books = dict[int, list[np.ndarray]]


def quantised(embedding: Column) -> Column:
    """floor(1024 x) of every component, or null where the vector takes no part."""
    cells = F.transform(embedding, lambda x: F.floor(x.cast("double") * SCALE))
    sound = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    large = F.exists(embedding, lambda x: F.abs(x.cast("double") * SCALE) >= _LIMIT)
    refused = F.raise_error(F.lit(f"a component times {SCALE} is {_LIMIT} or more")).cast("array<bigint>")
    return F.when(sound, F.when(large, refused).otherwise(cells))


def bounds(dim: int) -> list[int]:
    """Where the parts of a vector begin and end; parts are equal where the length allows."""
    return [dim * i // PARTS for i in range(PARTS + 1)]


class Orchard:
    """A codebook with the distance-sorted neighbour lists of all its entries."""

    def __init__(self, book: np.ndarray):
        self.book = book
        gaps = ((book[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
        self.lists = np.argsort(gaps, axis=1, kind="stable")
        self.gaps = np.take_along_axis(gaps, self.lists, axis=1)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entry nearest to each query, the lowest of equally near ones, and the squared distance."""
        n, k = len(queries), len(self.book)
        best = np.zeros(n, dtype=np.int64)
        least = ((queries - self.book[0]) ** 2).sum(axis=1)
        met = np.zeros((n, k), dtype=bool)
        met[:, 0] = True
        place = np.zeros(n, dtype=np.int64)
        live = np.arange(n)
        while len(live):
            # Twice the distance is four times its square.
            live = live[self.gaps[best[live], place[live]] <= 4 * least[live]]
            other = self.lists[best[live], place[live]]
            place[live] += 1
            fresh = ~met[live, other]
            at, other = live[fresh], other[fresh]
            met[at, other] = True
            far = ((queries[at] - self.book[other]) ** 2).sum(axis=1)
            better = (far < least[at]) | ((far == least[at]) & (other < best[at]))
            at = at[better]
            best[at], least[at], place[at] = other[better], far[better], 0
            live = live[place[live] < k]
        return best, least


def _assigned(column: pa.Array, books: dict[int, list[Orchard]]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, rows, vectors, codes, squared distances by part) of the vectors of a batch, those of one length together."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    cells = column.flatten().to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        for first in range(0, len(rows), _STEP):
            some = rows[first : first + _STEP]
            x = cells[(ends[some] - dim)[:, None] + np.arange(dim)]
            told = [book.nearest(x[:, a:b]) for book, a, b in zip(books[int(dim)], bounds(int(dim)), bounds(int(dim))[1:])]
            yield int(dim), some, x, np.stack([c for c, _ in told], axis=1), np.stack([d for _, d in told], axis=1)


def _sum_rows(books: Books):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = {dim: [Orchard(b) for b in parts] for dim, parts in books.items()}
        sums = {dim: [np.zeros_like(b) for b in parts] for dim, parts in books.items()}
        counts = {dim: [np.zeros(len(b), dtype=np.int64) for b in parts] for dim, parts in books.items()}
        for batch in batches:
            for dim, _, x, codes, _ in _assigned(batch.column("x"), lists):
                for part, (a, b) in enumerate(zip(bounds(dim), bounds(dim)[1:])):
                    np.add.at(sums[dim][part], codes[:, part], x[:, a:b])
                    counts[dim][part] += np.bincount(codes[:, part], minlength=len(counts[dim][part]))
        for dim in books:
            for part in range(PARTS):
                used = np.flatnonzero(counts[dim][part])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([dim] * len(used), pa.int32()),
                        pa.array([part] * len(used), pa.int32()),
                        pa.array(used, pa.int32()),
                        pa.array(counts[dim][part][used], pa.int64()),
                        pa.array(list(sums[dim][part][used]), pa.list_(pa.int64())),
                    ],
                    ["dim", "part", "entry", "n", "sums"],
                )

    return run


def _first_books(points: DataFrame) -> Books:
    """The parts of the vectors of the ``ENTRIES`` smallest ids of each length, in order."""
    books: Books = {}
    for dim in sorted(r[0] for r in points.select("dim").distinct().collect()):
        known = points.where((F.col("dim") == dim) & F.col("vec_id").isNotNull())
        ids = [r[0] for r in known.select("vec_id").distinct().orderBy("vec_id").limit(ENTRIES).collect()]
        held = known.where(F.col("vec_id") <= max(ids)).groupBy("vec_id").agg(F.min("x").alias("x")).collect() if ids else []
        rows = [r["x"] for r in sorted(held, key=lambda r: r["vec_id"])] or [[0] * dim]
        whole = np.array(rows, dtype=np.int64).reshape(len(rows), dim)
        books[dim] = [whole[:, a:b] for a, b in zip(bounds(dim), bounds(dim)[1:])]
    return books


def _moved(points: DataFrame, books: Books) -> Books:
    """The codebooks after one round."""
    told = points.select("x").mapInArrow(_sum_rows(books), "dim int, part int, entry int, n long, sums array<bigint>")
    exact = F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum")
    cells = told.select("dim", "part", "entry", "n", F.posexplode("sums").alias("pos", "sum"))
    out = {dim: [b.copy() for b in parts] for dim, parts in books.items()}
    for r in cells.groupBy("dim", "part", "entry", "pos").agg(F.sum("n").alias("n"), exact).collect():
        out[r["dim"]][r["part"]][r["entry"], r["pos"]] = int(r["sum"]) // r["n"]
    return out


def fit(points: DataFrame) -> Books:
    """The codebooks of every vector length, from ``vec_id``, ``x`` and ``dim``."""
    books = _first_books(points)
    for _ in range(ROUNDS):
        books = _moved(points, books)
    return books


def books_sha256(parts: list[np.ndarray]) -> str:
    """Of all entries' integers by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(x) for book in parts for x in book.ravel().tolist()).encode()).hexdigest()


def reconstructed(code: bytes, parts: list[np.ndarray]) -> np.ndarray:
    """The integers that a code stands for."""
    return np.concatenate([book[c] for c, book in zip(code, parts)])


def _points(vectors: DataFrame) -> DataFrame:
    cells = [packed(vectors).alias("vec"), F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding")).alias("x")]
    return written(vectors.select(*cells).where("x IS NOT NULL").withColumn("dim", F.size("x")), "code-vectors")


def _code_rows(books: Books):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = {dim: [Orchard(b) for b in parts] for dim, parts in books.items()}
        for batch in batches:
            codes, errors = np.zeros((batch.num_rows, PARTS), dtype=np.uint8), np.zeros(batch.num_rows, dtype=np.int64)
            for _, rows, _, told, far in _assigned(batch.column("x"), lists):
                codes[rows], errors[rows] = told, far.sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec"), batch.column("dim"), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(errors)],
                ["vec", "dim", "code", "error"],
            )

    return run


def compress(vectors: DataFrame) -> tuple[DataFrame, Books]:
    """Every kept row as ``vec`` (all columns) with ``dim``, ``code`` (a byte a part) and ``error``; and the codebooks.

    ``vectors`` has ``vec_id`` and ``embedding``.  A vector that is null, or holds null or
    non-finite components, is dropped; one with a component of 65,536 or more is an error.  Vectors
    of one length share codebooks; a length that is no multiple of the parts is cut as
    evenly as it goes, and the empty vector has code 0 and error 0.  Entries start
    from distinct ids: of rows that repeat one the least vector counts, and a null id starts none (if all are null, one
    entry starts as zeros).  Rows that repeat all weigh in the means and all get a code.  Ties go to the lower
    entry.  An empty table gives an empty result and no codebooks.
    """
    points = _points(vectors)
    books = fit(points.select("vec_id", "x", "dim"))
    shape = StructType([points.schema["vec"], points.schema["dim"], StructField("code", BinaryType()), StructField("error", LongType())])
    return written(points.select("vec", "dim", "x").mapInArrow(_code_rows(books), shape), "codes"), books


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels may be few and hold most rows: their sums are folded by task, and the join leaves its choice to adaptive execution."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    coded, books = compress(vectors)
    rows = coded.select(F.col("vec.vec_id").alias("vec_id"), F.col("vec.label").alias("label"), "dim", "code", "error")
    sums = written(rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of"), "code-labels")
    shas = F.create_map(*[F.lit(x) for dim, parts in books.items() for x in (dim, books_sha256(parts))]) if books else F.lit(None)
    sha = shas[F.col("dim")] if books else F.lit(None).cast("string")
    return rows.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", sha.alias("codebooks_sha256")
    )


def _rounds_sql() -> str:
    """One assignment and one new codebook for every round, then the last assignment."""
    nearest = """near{r} AS MATERIALIZED (
  SELECT rid, part, min(struct_pack(d := d, e := entry)) AS best FROM (
    SELECT p.rid, p.part, e.entry, list_dot_product(p.x, p.x) - 2 * list_dot_product(p.x, e.x) + list_dot_product(e.x, e.x) AS d
    FROM parts p JOIN book{r} e ON e.part = p.part)
  GROUP BY rid, part)"""
    moved = """cells{n} AS (
  SELECT p.part, best.e AS entry, unnest(p.x) AS x, unnest(range(len(p.x))) AS pos FROM parts p JOIN near{r} a ON a.rid = p.rid AND a.part = p.part),
means{n} AS (SELECT part, entry, pos, CAST(sum(CAST(x AS BIGINT)) AS BIGINT) AS s, count(*) AS c FROM cells{n} GROUP BY ALL),
lists{n} AS (SELECT part, entry, list(CAST((s - ((s % c) + c) % c) // c AS DOUBLE) ORDER BY pos) AS x FROM means{n} GROUP BY ALL),
book{n} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(l.x, b.x) AS x FROM book{r} b LEFT JOIN lists{n} l ON l.part = b.part AND l.entry = b.entry)"""
    steps = []
    for r in range(ROUNDS):
        steps += [nearest.format(r=r), moved.format(r=r, n=r + 1)]
    return ",\n".join([*steps, nearest.format(r=ROUNDS)])


ORACLE_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT rid, part, x[part * (len(x) // {PARTS}) + 1:(part + 1) * (len(x) // {PARTS})] AS x FROM kept, range({PARTS}) AS t(part)),
firsts AS (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS entry, x FROM (SELECT vec_id, min(x) AS x FROM kept WHERE vec_id IS NOT NULL GROUP BY vec_id)
  ORDER BY vec_id LIMIT {ENTRIES}),
book0 AS MATERIALIZED (
  SELECT part, entry, x[part * (len(x) // {PARTS}) + 1:(part + 1) * (len(x) // {PARTS})] AS x FROM firsts, range({PARTS}) AS t(part)),
{_rounds_sql()},
told AS (
  SELECT rid, string_agg(lower(printf('%02x', CAST(best.e AS BIGINT))), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM near{ROUNDS} GROUP BY rid),
sha AS (
  SELECT sha256(string_agg(CAST(CAST(v AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256
  FROM (SELECT part, entry, unnest(x) AS v, unnest(range(len(x))) AS pos FROM book{ROUNDS}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN told USING (rid), sha
"""
