"""Helpers shared by the operators: tables, shared scratch tables, Arrow maps."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from martlane.session import scratch_path

# Rows per Arrow batch handed to Python: texts can be long, so batches stay small.
BATCH_ROWS = 500


def ship_package(spark: SparkSession) -> None:
    """Let the Python workers import this package.

    Where PYTHONPATH already names its folder there is nothing to do; else the
    package is sent to the executors as a zip (once per context).
    """
    sc, root = spark.sparkContext, Path(__file__).resolve().parents[2]
    paths = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root in paths or getattr(sc, "_llm_package", False):
        return
    target = Path(tempfile.mkdtemp(prefix="package-")) / "package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted((root / __package__.partition(".")[0]).rglob("*.py")):
            z.write(f, f.relative_to(root))
    sc.addPyFile(str(target))
    sc._llm_package = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, per_task: int | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage: a lost executor costs a reread of the files, not the
    work that made them.  With ``per_task`` the rows are counted and read in
    tasks of about so many: what follows on a small table then needs no
    shuffle, whatever number of partitions shuffles have.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    if per_task:
        n = out.count()
        out = out.coalesce(max(1, -(-n // per_task)))
        out.small = n <= per_task
    out.scratch = path
    return out


def together(df: DataFrame, small: bool, *keys: str) -> DataFrame:
    """Rows of equal ``keys[0]`` in one task, in the order of ``keys``; ``small``:
    the rows are few enough for one."""
    dealt = df.coalesce(1) if small else df.repartition(keys[0])
    return dealt.sortWithinPartitions(*keys)


def discard(*tables: DataFrame) -> None:
    """Delete ``stored`` tables that nothing reads any more: what was made from
    them has been stored itself."""
    for t in tables:
        sc = t.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(t.scratch)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def map_rows(df: DataFrame, schema: str | T.StructType, rows: Callable[..., Iterable[tuple]],
             *columns: str, held_bytes: int | None = None) -> DataFrame:
    """``rows(iterator of (value of each column, ...))`` yields output tuples.

    The function runs once per partition, so what it builds before its first
    row (a tokenizer, a cache) is built once per task.  With ``held_bytes``,
    an output batch also ends once its texts reach so many characters.
    """
    ship_package(df.sparkSession)
    # Read when the plan is made, so that it holds for this map.
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    out = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    names = [f.name for f in out.fields]
    target = _arrow(out)

    def source(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(lo, BATCH_ROWS)
                yield from zip(*(part.column(i).to_pylist() for i in range(part.num_columns)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for row in rows(source(batches)):
            held.append(row)
            if held_bytes:
                size += sum(len(x) for x in row if isinstance(x, (str, bytes)))
            if len(held) >= 2000 or held_bytes and size >= held_bytes:
                yield _batch(held, names, target)
                held, size = [], 0
        if held:
            yield _batch(held, names, target)

    return df.select(*(F.col(f"`{c}`") for c in columns)).mapInArrow(run, out)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def _batch(held: list[tuple], names: list[str], target: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, type=target.field(i).type) for i, c in enumerate(zip(*held))]
    return pa.RecordBatch.from_arrays(columns, names=names)


def chunks(split: list[list], most: int = 50_000) -> Iterator[tuple[int, int]]:
    """(from, to) over lists of words, ``most`` words or one list at a time."""
    lo = total = 0
    for hi, words in enumerate(split):
        if hi > lo and total + len(words) > most:
            yield lo, hi
            lo, total = hi, 0
        total += len(words)
    if split:
        yield lo, len(split)


class Memo:
    """key -> value, computed for many missing keys at a time, in bounded memory.

    Two generations of at most ``limit`` entries each: when the young one is
    full it becomes the old one, and keys met again return from there.  Keys
    over 64 characters are kept only while they are asked for.
    """

    def __init__(self, compute: Callable[[set[str]], dict], limit: int):
        self.compute, self.limit = compute, limit
        self.words: dict[str, object] = {}
        self._old: dict[str, object] = {}
        self._long: list[str] = []

    def learn(self, keys: Iterable[str]) -> None:
        """Afterwards ``words`` holds every key."""
        for key in self._long:
            self.words.pop(key, None)
        self._long = []
        keys = set(keys)
        # difference() looks the new keys up; "-" with a view walks the whole memo
        missing = keys.difference(self.words)
        if not missing:
            return
        if len(self.words) + len(missing) > self.limit:
            self._old, self.words = self.words, {}
            missing = keys
        old = self._old
        known = {key: old[key] for key in missing if key in old}
        self.words.update(known)
        missing = missing.difference(known)
        if missing:
            self.words.update(self.compute(missing))
            self._long = [key for key in missing if len(key) > 64]


class WordCache(dict):
    """word -> value, filled by ``make`` on a miss.

    Holds at most ``limit`` entries (it starts anew when full) and does not
    keep words over 64 characters; only memory is bounded, never the result.
    """

    def __init__(self, make: Callable[[str], object], limit: int = 300_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, word):
        value = self.make(word)
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[word] = value
        return value


def join_small(rows: DataFrame, named: DataFrame, key: str | list[str], count: str, parts: int = 200,
               small: Column | None = None) -> DataFrame:
    """``rows`` joined with ``named``, which has one row per ``key`` and in
    ``count`` the key's number of rows.

    Keys with a ``parts``-th of all rows or more number at most ``parts``, so
    these are broadcast, and no key's rows gather in one task; the others meet
    by a shuffle.  Where rows of ``named`` are of any length, ``small`` says
    which may be broadcast.
    """
    keys = [key] if isinstance(key, str) else key
    total = named.agg(F.sum(count)).first()[0] or 0
    frequent = F.col(count) * parts >= total
    if small is not None:
        frequent = frequent & small
    hot = F.broadcast(named.filter(frequent))
    rare = rows.join(hot.select(*keys), keys, "left_anti").join(named.filter(~frequent), keys)
    return rows.join(hot, keys).unionByName(rare.select(*rows.columns, *(c for c in named.columns if c not in keys)))


def held_out(doc_id, modulus: int, remainder: int):
    """True where crc32 of the id as text leaves ``remainder`` (null id: False)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == remainder,
                      F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, modulus: int, remainder: int,
                    rows: int) -> DataFrame:
    """doc_id, text, label of at most ``rows`` labelled rows that are not held
    out, those with the smallest hash of their id.

    The chosen labels number at most ``rows``, so they are broadcast and no
    text is shuffled.
    """
    known = (labels.filter(F.col(column).isNotNull() & F.col("doc_id").isNotNull())
             .filter(~held_out("doc_id", modulus, remainder))
             .groupBy("doc_id").agg(F.max(column).cast("int").alias("label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")


def keep_rows(docs: DataFrame, keep: Callable[[], Callable[[str | None], bool]]) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text (null: None)
    passes; ``keep`` makes the test once per task."""
    at = docs.columns.index("text")

    def rows(source):
        test = keep()
        for row in source:
            if test(row[at]):
                yield row

    return map_rows(docs, docs.schema, rows, *docs.columns)
