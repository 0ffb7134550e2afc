"""Helpers shared by the text operators: tables in the shared folder, words as numbers, checked broadcasts."""

from __future__ import annotations

import ctypes
import functools
import inspect
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.stages import session_run
from ..sources import files

# A side is broadcast only if its rows, counted in a written table, take at
# most this many bytes; beyond it the same join is done by shuffle.
BROADCAST_BYTES = 32 * 1024 * 1024
# A chunk is what one numpy pass works on: so many bytes of text, or documents.
CHUNK_BYTES = 2 * 1024 * 1024
CHUNK_DOCS = 50_000
# Rows of an Arrow batch that become Python objects at a time.
ROWS = 512
VOCABULARY_WORDS = 200_000


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, as ``--py-files`` would."""
    if spark.sparkContext.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="cohortlink-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(spark.sparkContext.applicationId)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# Paths of the tables written within each open ``scratch``.
_scratch: list[list[str]] = []


def written(df: DataFrame, name: str, outside: bool = False) -> DataFrame:
    """The same rows read back from a parquet table of the application's run.

    The table outlives lost executors and cuts the lineage. It is removed at the
    end of the ``scratch`` block it is written in, or with ``outside`` of the
    block around that one; else with the run.
    """
    run = session_run(df.sparkSession)
    path = run.path(name)
    df.write.parquet(path)
    depth = len(_scratch) - (2 if outside else 1)
    if depth >= 0:
        _scratch[depth].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the tables written within the block when it ends; what is to last is written ``outside``."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            files.delete(spark, path)


@functools.cache
def _trim() -> Callable[[int], int] | None:
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def gives_back(run: Callable) -> Callable:
    """A function of a task that, when done, returns to the system what its worker no longer uses.

    Spark keeps workers for later tasks; what they hold counts against the executor.
    """

    def freed() -> None:
        pa.default_memory_pool().release_unused()
        if _trim():
            _trim()(0)

    if inspect.isgeneratorfunction(run):

        @functools.wraps(run)
        def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from run(batches)
            freed()

        return stream

    @functools.wraps(run)
    def group(table: pa.Table) -> pa.Table:
        out = run(table)
        freed()
        return out

    return group


RANGE_BYTES = 8 * 1024 * 1024


def ranges(texts: DataFrame, per_byte: float, range_bytes: int = RANGE_BYTES) -> int:
    """Into how many hash ranges to deal what is made of the texts, ``per_byte`` bytes for each of theirs.

    The texts are measured, so that a range, which one task holds in memory, has
    about ``range_bytes`` whatever the input.
    """
    total = texts.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    return max(1, -int(-total * per_byte // range_bytes))


def broadcast_if_small(table: DataFrame, bytes_per_row: int | Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``table``, marked for broadcast if its measured bytes are within ``limit``.

    ``table`` should be a written one, so that measuring it does not compute it
    again. Unmarked, it is joined by shuffle with the same rows.
    """
    size = F.lit(bytes_per_row) if isinstance(bytes_per_row, int) else bytes_per_row
    total = table.agg(F.sum((size + F.lit(32)).cast("bigint"))).first()[0] or 0
    return F.broadcast(table) if total <= limit else table


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores in front until no column of ``df`` has them."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        found.append(name)
    return found


def giving_way(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df``, in which columns of the given names, in any case, have underscores in front."""
    wanted = {n.lower() for n in names}
    taken = wanted | {c.lower() for c in df.columns}
    columns = []
    for c in df.columns:
        name = c
        if c.lower() in wanted:
            while name.lower() in taken:
                name = "_" + name
            taken.add(name.lower())
        columns.append(F.col(f"`{c}`").alias(name))
    return df.select(*columns)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_and_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text as UTF-8 bytes), without rows that have no id."""
    return docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("text")
    )


def _parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def chunks(
    batches: Iterable[pa.RecordBatch], max_bytes: int = CHUNK_BYTES, max_docs: int = CHUNK_DOCS
) -> Iterator[list[list]]:
    """Rows of (key, text, ...) batches in bounded lists, one per column; a missing text is empty."""
    columns: list[list] | None = None
    size = 0
    for part in _parts(batches):
        if columns is None:
            columns = [[] for _ in range(part.num_columns)]
        for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
            for column, value in zip(columns, row, strict=True):
                column.append(value)
            columns[1][-1] = columns[1][-1] or b""
            size += len(columns[1][-1])
            if size >= max_bytes or len(columns[0]) >= max_docs:
                yield columns
                columns, size = [[] for _ in columns], 0
    if columns and columns[0]:
        yield columns


def keep_rows(docs: DataFrame, text_col: str, make_judge: Callable[[], Callable[[list[bytes]], list[bool]]]) -> DataFrame:
    """The rows of ``docs``, all columns, whose text a judge keeps; each task makes a judge of its own."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = make_judge()
        for batch in _parts(batches):
            start, size, texts = 0, 0, []
            for k, text in enumerate(batch.column(place).cast(pa.binary()).to_pylist()):
                texts.append(text or b"")
                size += len(texts[-1])
                if size >= CHUNK_BYTES or k + 1 == batch.num_rows:
                    yield batch.slice(start, len(texts)).filter(pa.array(judge(texts), pa.bool_()))
                    start, size, texts = k + 1, 0, []

    return docs.mapInArrow(gives_back(run), docs.schema)


def buckets_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The hash range, of ``buckets`` equal ones, that each hash falls in, by its upper half."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def packed(numbers: np.ndarray) -> tuple[int, bytes]:
    """Numbers as offsets from the smallest, in as few bytes as their range takes."""
    base = int(numbers.min()) if len(numbers) else 0
    reach = int(numbers.max()) - base if len(numbers) else 0
    kind = np.uint16 if reach < 1 << 16 else np.uint32 if reach < 1 << 32 else np.uint64
    return base, (numbers.astype(np.int64) - base).astype(kind).tobytes()


def unpacked(base: int, data: bytes, count: int) -> np.ndarray:
    kind = {2: np.uint16, 4: np.uint32, 8: np.uint64}[len(data) // count] if count else np.uint16
    return np.frombuffer(data, dtype=kind).astype(np.int64) + base


class Vocabulary(dict):
    """Word to row number; ``hashes`` has a 64-bit hash for each row. Forgets all words when it is full."""

    def __init__(self, limit: int = VOCABULARY_WORDS):
        super().__init__()
        self.limit = limit
        self.seen: list[int] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.seen)
        self.seen.append(xxhash.xxh3_64_intdigest(word))
        return number

    def hashes(self, documents: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each word of the documents, one after the other, and the words per document."""
        if len(self) > self.limit:
            self.clear()
            self.seen.clear()
        counts = np.fromiter(map(len, documents), dtype=np.int64, count=len(documents))
        numbers = np.fromiter(
            map(self.__getitem__, chain.from_iterable(documents)), dtype=np.int64, count=int(counts.sum())
        )
        return np.array(self.seen, dtype=np.uint64)[numbers], counts


MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread the bits of 64-bit numbers; another salt gives an independent value."""
    x = x ^ np.uint64((salt * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA24BAED4963EE407)
    return x ^ (x >> np.uint64(32))


def window_hashes(words: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """Hash of each run of ``width`` words, without regard to document ends."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    if salt:
        words = mix(words, salt)
    total = words[:n].copy()
    for k in range(1, width):
        total *= MULTIPLIER
        total += words[k : k + n]
    return mix(total, width)


def window_starts(counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the words that begin a run within their document, and the document's number for each."""
    ends = np.cumsum(counts)
    doc = np.repeat(np.arange(len(counts)), counts)
    fits = np.arange(len(doc)) + width <= ends[doc]
    return np.flatnonzero(fits), doc[fits]
