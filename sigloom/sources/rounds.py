"""Jobs with side effects, done in rounds that commit by themselves.

A Spark job publishes its output when all its tasks are done, so a job that dies leaves nothing behind.  Work that must
not be repeated (calls to a model, sends) is therefore cut into rounds of bounded size; each round appends its rows to
the result table, and a later run leaves out what the table holds.  At most the round in hand is lost.

A job or a task for each round costs far more than a small round itself.  Where the workers can write the result table
(``worker_path``) a task therefore goes through many rounds and puts the rows of each under the table before it begins the next.
"""

from __future__ import annotations

import glob
import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, DecimalType, IntegralType, StringType, StructType

from sigloom.sources.folders import new_folder

ROUND = "_round"
MANY_FILES = 32  # files of a task from which on they are made one when the task ends
GROUP_BYTES = 16 << 20  # rows in the memory of a worker while it does so
PART_BYTES = 32 << 20  # rows of a task that goes through rounds in order

Work = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]  # answers each frame before it takes the next


def table_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The Parquet table under ``path``, or no rows where nothing has been written yet."""
    try:
        found = spark.read.schema(schema).parquet(path)
        found.take(0)
        return found
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def by_hash(todo: DataFrame, keys: list[str], per_round: int) -> Column:
    """A round number for about ``per_round`` rows each, wherever the keys lie."""
    rounds = max(1, -(-todo.count() // per_round))
    return F.pmod(F.xxhash64(*keys), F.lit(rounds)).cast("int")


def append_by_task(todo: DataFrame, per_round: int, work: Callable[[DataFrame], DataFrame], path: str) -> int:
    """Appends ``work(rows)`` to ``path`` for rows in any order; the number of tasks.

    One job does all rounds: version 2 of the file committer publishes the file of a task as soon as the task is done, and
    files of a job that dies stay.  A task gets so few rows that those in the hands of all cores make up one round.  Where
    another committer is set, a job publishes at its end only.
    """
    piece = max(1, per_round // todo.sparkSession.sparkContext.defaultParallelism)
    tasks = -(-todo.count() // piece)
    if tasks:
        work(todo.repartition(tasks)).write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(path)
    return tasks


def worker_path(spark: SparkSession, path: str, schema: StructType) -> str | None:
    """``path`` as the workers' Python opens it; None where only Spark reaches it, or for types other than plain values."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toUri()
    plain = all(isinstance(f.dataType, (StringType, IntegralType, DecimalType, BooleanType)) for f in schema)
    return found.getPath() if plain and found.getScheme() == "file" else None


@contextmanager
def open_run(folder: str | None) -> Iterator[str]:
    """The id of a run that may put files under ``folder`` until it ends or another begins: tasks can outlive a run that failed.

    Open it before the result table is read.  Its mark lies beside the folder.
    """
    run, marks = uuid.uuid4().hex, []
    if folder:
        for other in glob.glob(_mark(glob.escape(folder), "*")):
            os.unlink(other)
        marks = [_mark(folder, run)]
        os.makedirs(os.path.dirname(marks[0]), exist_ok=True)
        open(marks[0], "x").close()
    try:
        yield run
    finally:
        for mark in filter(os.path.exists, marks):
            os.unlink(mark)


def _mark(folder: str, run: str) -> str:
    above, name = os.path.split(folder.rstrip("/"))
    return os.path.join(above, f".{name}-open-{run}")


class Pieces:
    """The files of one task under a Parquet table: one for each round, whole when it is seen, and one for all in the end where they are many.

    Names tell the run, the task and the round, so that a task that runs again finds what it has done.
    """

    def __init__(self, folder: str, run: str, schema: pa.Schema):
        self.folder, self.run, self.schema = folder, run, schema

    def _name(self, of: str) -> str:
        return os.path.join(self.folder, f"part-{self.run}-{of}.parquet")

    def _publish(self, name: str, write: Callable[[str], None]) -> None:
        hidden = os.path.join(self.folder, f"_{uuid.uuid4().hex}")
        write(hidden)
        os.rename(hidden, name)

    def require_open(self) -> None:
        if not os.path.exists(_mark(self.folder, self.run)):
            raise RuntimeError(f"the run of this task over {self.folder} has ended")

    def put(self, number: str, rows: pd.DataFrame) -> None:
        table = pa.Table.from_arrays([pa.Array.from_pandas(rows[f.name], type=f.type) for f in self.schema], schema=self.schema)
        whole = pa.BufferOutputStream()
        pq.write_table(table, whole, use_dictionary=False, store_schema=False)

        def write(file: str) -> None:
            with open(file, "xb") as out:
                out.write(whole.getvalue())

        os.makedirs(self.folder, exist_ok=True)
        self.require_open()
        self._publish(self._name(number), write)

    def has(self, number: str, task: str) -> bool:
        """Whether the rows of a round are there, in a file of their own or in that of the task (which comes before they go)."""
        return os.path.exists(self._name(number)) or os.path.exists(self._name(task))

    def rows(self, numbers: str, columns: list[str]) -> pd.DataFrame:
        """What files of this run whose round fits the pattern hold."""
        found = [pq.ParquetFile(name).read(columns) for name in glob.glob(glob.escape(self._name(""))[:-len(".parquet")] + numbers + ".parquet")]
        return pa.concat_tables(found).to_pandas() if found else pd.DataFrame(columns=columns)

    def merge(self, numbers: list[str], task: str) -> None:
        names = [self._name(n) for n in numbers]
        if len(names) < MANY_FILES or os.path.exists(self._name(task)):
            return

        def write(file: str) -> None:
            held, size = [], 0
            with pq.ParquetWriter(file, self.schema) as out:
                for i, name in enumerate(names):
                    held.append(pq.ParquetFile(name).read())
                    size += held[-1].nbytes
                    if size > GROUP_BYTES or i + 1 == len(names):
                        out.write_table(pa.concat_tables(held))
                        held, size = [], 0

        self._publish(self._name(task), write)  # a run that ends here leaves rows twice, which readers of a result table allow for
        for name in names:
            os.unlink(name)


def append_by_piece(todo: DataFrame, per_round: int, work: Work, folder: str, run: str, schema: StructType, key: str) -> DataFrame:
    """The job that puts ``work`` of the rows, in any order, under ``folder``; its rows say how many.

    A task goes through its rows in pieces so small that those in the hands of all cores make up one round, and puts the
    answers of each before it takes the next.  A task that runs again leaves out the keys it has put already.
    """
    piece = max(1, per_round // todo.sparkSession.sparkContext.defaultParallelism)
    arrow = to_arrow_schema(schema)

    def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        files, me = Pieces(folder, run, arrow), f"{context.partitionId()}-{context.attemptNumber()}"
        known = set(files.rows(f"{context.partitionId()}-*", [key])[key]) if context.attemptNumber() else None

        def pieces() -> Iterator[pd.DataFrame]:
            for frame in frames:
                left = frame if known is None else frame[~frame[key].isin(known)]
                for i in range(0, len(left), piece):
                    files.require_open()
                    yield left.iloc[i:i + piece]

        numbers, rows = [], 0
        for done in work(pieces()):
            numbers.append(f"{me}-{len(numbers)}")
            files.put(numbers[-1], done)
            rows += len(done)
        files.merge(numbers, me)
        yield pd.DataFrame({"rows": [rows]})

    return todo.mapInPandas(task, "rows long")


def _by_round(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[int, pd.DataFrame]]:
    """The rows of each round out of frames in order of their rounds."""
    held = None
    for frame in frames:
        if held is not None:
            frame = pd.concat([held, frame], ignore_index=True)
        if not len(frame):
            continue
        numbers = frame[ROUND].to_numpy()
        edges = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1)]
        for begin, end in zip(edges, edges[1:]):
            yield int(numbers[begin]), frame.iloc[begin:end]
        held = frame.iloc[edges[-1]:]
    if held is not None:
        yield int(held[ROUND].iloc[0]), held


def put_in_order(todo: DataFrame, order: list[str], work: Work, folder: str, run: str, schema: StructType, size: Column) -> int:
    """Puts ``work`` of the rows under ``folder``, round by round in order of ``ROUND``; the number of jobs.

    One round is in hand at any time.  Rows lie side by side in one shuffle, in ranges of rounds with about ``PART_BYTES``
    of ``size`` each; a range is a job of one task, which goes through its rounds in order and puts the rows of each as one
    file before it takes the next.  A task that runs again leaves out the rounds it has put already.
    """
    spark = todo.sparkSession
    arrow = to_arrow_schema(schema)
    total = todo.agg(F.sum(size.cast("bigint"))).first()[0]
    if total is None:
        return 0

    def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, me, numbers, rows = Pieces(folder, run, arrow), f"t{TaskContext.get().partitionId()}", [], 0

        def rounds() -> Iterator[pd.DataFrame]:
            for n, frame in _by_round(frames):
                numbers.append(str(n))
                if not files.has(numbers[-1], me):
                    files.require_open()
                    yield frame

        for done in work(rounds()):
            files.put(numbers[-1], done)
            rows += len(done)
        files.merge(numbers, me)
        yield pd.DataFrame({"rows": [rows]})

    ranges = todo.repartitionByRange(1 + total // PART_BYTES, ROUND).sortWithinPartitions(ROUND, *order)
    rdd = ranges.mapInPandas(task, "rows long").rdd
    for n in range(rdd.getNumPartitions()):
        spark.sparkContext.runJob(rdd, list, [n])
    return rdd.getNumPartitions()


def append_in_rounds(todo: DataFrame, number: Column, work: Callable[[DataFrame], DataFrame], path: str) -> int:
    """Appends ``work(rows)`` to ``path`` for the rows of each round, in order of ``number``; the number of rounds.

    The rows are written once, by round, so that no round evaluates the whole input again.
    """
    spark = todo.sparkSession
    folder = new_folder(spark, "rounds")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A round's rows lie in up to ``width`` files, whatever the number of rounds.
    spread = F.pmod(F.hash(*[F.col(f"`{c}`") for c, kind in todo.dtypes if "map<" not in kind]), F.lit(width))
    staged = todo.withColumn(ROUND, number)
    staged.repartition(F.col(ROUND), spread).write.partitionBy(ROUND).parquet(folder)
    read = spark.read.schema(staged.schema).parquet(folder)
    numbers = sorted(r[0] for r in read.select(ROUND).distinct().toLocalIterator())  # bounded: one per round
    for n in numbers:
        rows = read.filter(F.col(ROUND) == n).drop(ROUND).repartition(width)
        work(rows).write.mode("append").parquet(path)
    return len(numbers)


def commit_in_order(todo: DataFrame, number: Column, work: Callable[[DataFrame], DataFrame], path: str, tasks: int) -> int:
    """As ``append_in_rounds`` for rounds that are many and small and answer with a few narrow rows.

    ``todo`` is read from a stored table.  All rounds are planned once and lie side by side in one shuffle, ``tasks`` partitions
    each; a round is a job over its own partitions, and its rows (never more than one round's) are put under ``path`` as one
    Parquet file before the next begins.
    """
    spark = todo.sparkSession
    read = todo.withColumn(ROUND, number)
    # The window and the broadcast see one row per round.
    at = read.select(ROUND).distinct().withColumn("_at", F.row_number().over(Window.orderBy(ROUND)) - 1)
    rounds = at.count()
    if not rounds:
        return 0
    spread = F.pmod(F.hash(*[F.col(f"`{c}`") for c in todo.columns]), F.lit(tasks))
    placed = read.join(F.broadcast(at), ROUND).withColumn("_part", (F.col("_at") * tasks + spread).cast("int"))
    done = work(placed.repartitionById(rounds * tasks, "_part").drop(ROUND, "_at", "_part"))
    rows = done.rdd
    if rows.getNumPartitions() != rounds * tasks:
        raise ValueError("the work must keep the partitions of its rows")
    for n in range(rounds):
        _put(spark, spark.sparkContext.runJob(rows, list, range(n * tasks, (n + 1) * tasks)), done.schema, path)
    return rounds


def _put(spark: SparkSession, rows: list[Row], schema: StructType, path: str) -> None:
    """Adds a few rows to the Parquet table under ``path`` as one file, which readers see when it is whole."""
    file = pa.BufferOutputStream()
    pq.write_table(pa.Table.from_pylist([r.asDict(recursive=True) for r in rows], schema=to_arrow_schema(schema)), file)
    name, file_path = f"part-{uuid.uuid4().hex}.parquet", spark._jvm.org.apache.hadoop.fs.Path
    hidden, whole = file_path(path, "_" + name), file_path(path, name)
    fs = whole.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(hidden, False)
    out.write(file.getvalue().to_pybytes())
    out.close()
    if not fs.rename(hidden, whole):
        raise OSError(f"{whole.toString()} cannot be put in place")
