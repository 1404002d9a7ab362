"""Messages kept as one file each: a data source of whole files.

Reading lists the files once and gives each task about as many bytes as the others, however many files those are;
files of length 0 are rows too. Writing goes through a temporary folder of each attempt at a task: what
a lost attempt has written is never seen, and the files get their names when all tasks are done.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

FORMAT = "wholefiles"
SCHEMA = "path string, text string"
# Bytes of a task, where a file counts as at least as much as opening it costs.
PARTITION_BYTES = 64 << 20
OPENING_BYTES = 1 << 16
_TEMPORARY = "_temporary"
_BATCH_BYTES = 8 << 20


@dataclass
class Files(InputPartition):
    paths: list[str]


@dataclass
class Written(WriterCommitMessage):
    """The folder of one attempt; the names of its files stay in the store."""

    attempt: str


class WholeFileReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root = options["path"]
        self.bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        # Whether it is an error if nothing is there.
        self.required = options.get("required", "false") == "true"

    def partitions(self) -> list[Files]:
        store, base = fs.FileSystem.from_uri(self.root)
        own = store.get_file_info(base)
        if own.is_file:
            return [Files([own.path])]
        found = store.get_file_info(fs.FileSelector(base, allow_not_found=not self.required, recursive=True))
        hidden = lambda name: any(part[:1] in "._" for part in name.split("/"))
        files = sorted((f.path, f.size) for f in found if f.is_file and not hidden(f.path[len(base) :].lstrip("/")))
        parts, load = [], self.bytes
        for path, size in files:
            if load + max(size, OPENING_BYTES) > self.bytes:
                parts.append(Files([]))
                load = 0
            parts[-1].paths.append(path)
            load += max(size, OPENING_BYTES)
        return parts or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(self.root)
        paths, texts, load = [], [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(texts, pa.string())], names=["path", "text"])

        for path in partition.paths:
            with store.open_input_stream(path, compression=None) as file:
                texts.append(file.read().decode("utf-8", "replace"))
            paths.append(path)
            load += len(texts[-1])
            if load > _BATCH_BYTES:
                yield batch()
                paths, texts, load = [], [], 0
        if paths:
            yield batch()


class WholeFileWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.root = options["path"]

    def write(self, rows: Iterator) -> Written:
        """Write the rows of one attempt below a folder of its own."""
        store, base = fs.FileSystem.from_uri(self.root)
        attempt = f"{base}/{_TEMPORARY}/{uuid.uuid4().hex}"
        made = set()
        for row in rows:
            if not row["path"]:
                raise ValueError("a file needs a path")
            path = f"{attempt}/{row['path']}"
            folder = path.rpartition("/")[0]
            if folder not in made:
                store.create_dir(folder, recursive=True)
                made.add(folder)
            elif store.get_file_info(path).type != fs.FileType.NotFound:
                raise ValueError(f"two rows have the path {row['path']}")
            with store.open_output_stream(path, compression=None) as out:
                out.write((row["text"] or "").encode())
        return Written(attempt)

    def commit(self, messages: list[Written]) -> None:
        """Give the files of the attempts that count their names."""
        store, base = fs.FileSystem.from_uri(self.root)
        store.create_dir(base, recursive=True)

        def move(found: tuple[str, str]) -> None:
            source, target = found
            if store.get_file_info(target).type != fs.FileType.NotFound:
                raise ValueError(f"two rows have the path {target[len(base) + 1 :]}")
            store.move(source, target)

        with ThreadPoolExecutor(16) as pool:
            for message in messages:
                if message is None or store.get_file_info(message.attempt).type == fs.FileType.NotFound:
                    continue
                found = store.get_file_info(fs.FileSelector(message.attempt, recursive=True))
                moves = [(f.path, base + f.path[len(message.attempt) :]) for f in found if f.is_file]
                for folder in {target.rpartition("/")[0] for _, target in moves}:
                    store.create_dir(folder, recursive=True)
                list(pool.map(move, moves))
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        """Remove what attempts have left."""
        store, base = fs.FileSystem.from_uri(self.root)
        if store.get_file_info(f"{base}/{_TEMPORARY}").type != fs.FileType.NotFound:
            store.delete_dir(f"{base}/{_TEMPORARY}")


class WholeFiles(DataSource):
    """``spark.read.format("wholefiles").load(root)`` and the same for writing; rows are (path, text)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WholeFileReader:
        return WholeFileReader(self.options)

    def writer(self, schema, overwrite: bool) -> WholeFileWriter:
        return WholeFileWriter(self.options)
