"""Writing test sets and run metrics: each is whole or not there, also when a write is repeated or fails."""

from __future__ import annotations

import datetime
import json
import posixpath
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType


def test_set_name(corpus: str, at: datetime.datetime) -> str:
    return f"v2_{corpus.replace(' ', '_')}_{at:%d_%m_%y_T%H_%M}.json"


def storage(path: str):
    """The file system of a path or URI that Arrow knows, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class Part(WriterCommitMessage):
    def __init__(self, path: str, rows: int):
        self.path, self.rows = path, rows


class TestSetWriter(DataSourceWriter):
    """Tasks write their rows as parts in a folder of their own run; the commit strings them together and moves the file to its place."""

    def __init__(self, options: dict):
        self.path, self.run, self.head = options["path"], options["run"], options["head"]
        self.parts = f"{self.path}.{self.run}.parts"

    def write(self, iterator: Iterator) -> Part:
        from pyspark import TaskContext

        task, (files, folder) = TaskContext.get(), storage(self.parts)
        # An attempt that is lost leaves a part that no commit names.
        path = posixpath.join(folder, f"{task.partitionId()}-{task.taskAttemptId()}")
        files.create_dir(folder, recursive=True)
        n = 0
        with files.open_output_stream(path) as out:
            for n, row in enumerate(iterator, 1):
                out.write(((",\n" if n > 1 else "") + row["question"]).encode())
        return Part(path, n)

    def commit(self, messages: list[Part | None]) -> None:
        files, target = storage(self.path)
        _, folder = storage(self.parts)
        files.create_dir(folder, recursive=True)
        whole, first = posixpath.join(folder, "whole"), True
        with files.open_output_stream(whole) as out:
            out.write(self.head.encode()[:-1] + b', "questions": [\n')
            for part in messages:
                if part is not None and part.rows:
                    out.write(b"" if first else b",\n")
                    first = False
                    with files.open_input_stream(part.path) as read:
                        while data := read.read(1 << 20):
                            out.write(data)
            out.write(b"\n]}\n")
        files.move(whole, target)
        files.delete_dir(folder)

    def abort(self, messages: list[Part | None]) -> None:
        from pyarrow import fs

        files, folder = storage(self.parts)
        if files.get_file_info(folder).type != fs.FileType.NotFound:
            files.delete_dir(folder)


class TestSetFile(DataSource):
    """Format ``test_set_file``: rows (question, JSON) to one JSON file at ``path``, after the members of the JSON object ``head``."""

    @classmethod
    def name(cls) -> str:
        return "test_set_file"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return TestSetWriter(self.options)


def write_test_set(questions: DataFrame, summary: DataFrame, folder: str, corpus: str, at: datetime.datetime | None = None, run_id: str = "run") -> str:
    """One JSON file with metadata, summary and questions (in the order of their first column) under {folder}/{corpus}.

    Each task writes its questions, so none are gathered; a run that is repeated under the same
    ``run_id`` puts the same file in place again, and one that fails leaves the file of before.
    """
    at = at or datetime.datetime.now()
    path = f"{folder}/{corpus.replace(' ', '_')}/{test_set_name(corpus, at)}"
    questions.sparkSession.dataSource.register(TestSetFile)
    told = json.loads(summary.select(F.to_json(F.struct(*summary.columns), {"ignoreNullFields": "false"}).alias("j")).first().j)
    head = json.dumps({"metadata": {"created_at": at.timestamp(), "corpus": corpus, "run": run_id}, "summary": told}, ensure_ascii=False)
    first = questions.columns[0]
    rows = questions.repartitionByRange(first).sortWithinPartitions(first).select(F.to_json(F.struct(*questions.columns)).alias("question"))
    rows.write.format("test_set_file").options(run=run_id, head=head).mode("overwrite").save(path)
    return path


def append_run_metrics(metrics: DataFrame, run_id: str, path: str) -> None:
    """(metric, value) rows under a run's id in a Parquet table; what the run had there before is replaced."""
    rows = metrics.select("metric", "value", F.lit(run_id).alias("run_id"))
    rows.write.partitionBy("run_id").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
