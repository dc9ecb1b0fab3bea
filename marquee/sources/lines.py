"""Growing files of vote lines as a stream that can be replayed.

A writer appends lines ``title <tab> rating <tab> milliseconds`` to files of a folder. A place
in the stream is a number of bytes for each file, so a batch that is run again reads the same
bytes, and a line is read once however often the stream is started anew. A line that its
writer has not ended yet waits for its line break. Nothing listens on a port.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from marquee.functions import millis_time

#: Bytes that a batch takes at most, unless one line is longer; and bytes that a task reads at most.
BATCH_BYTES = 256 << 20
TASK_BYTES = 32 << 20
_STEP = 1 << 20

FORMAT = "growing_lines"


@dataclass
class Stretch(InputPartition):
    """Bytes of one file, from the start of a line to the end of one."""

    path: str
    start: int
    end: int


class GrowingLines(DataSource):
    """Options: ``path``, the folder; ``progress``, a folder of the stream's own; ``batchBytes``, ``taskBytes``.

    ``from`` is the place that a new stream starts at, as another one's checkpoint has it.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string, file string, at bigint"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return GrowingLinesReader(self.options)


class GrowingLinesReader(DataSourceStreamReader):
    """Places are ``{file: bytes}``.

    A batch ends so many bytes after the last place that was handed out. That place is also
    written to ``progress`` before it is handed out, so it is known after a restart and never
    behind what the stream has noted; at worst the first batch then is up to twice as long.
    """

    def __init__(self, options: dict[str, str]):
        self.store, self.folder = fs.FileSystem.from_uri(options["path"])
        self.progress_store, self.progress = fs.FileSystem.from_uri(options["progress"])
        self.batch_bytes = int(options.get("batchbytes") or options.get("batchBytes") or BATCH_BYTES)
        self.task_bytes = int(options.get("taskbytes") or options.get("taskBytes") or TASK_BYTES)
        self.uri = options["path"]
        self.first = json.loads(options.get("from") or "{}")
        self.last: dict[str, int] | None = None

    def initialOffset(self) -> dict:
        return self.first

    def latestOffset(self) -> dict:
        if self.last is None:
            self.last = self._noted()
        place, left = dict(self.last), self.batch_bytes
        for name, size in self._sizes():
            at = place.get(name, 0)
            if left > 0 and size > at:
                end = self._last_break(name, at, size, left, place == self.last)
                left -= end - at
                if end > at:
                    place[name] = end
        if place != self.last:
            self._note(place)
            self.last = place
        return place

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        found: list[InputPartition] = []
        for name, stop in sorted(end.items()):
            at = start.get(name, 0)
            while at < stop:
                cut = stop if stop - at <= self.task_bytes else self._last_break(name, at, stop, self.task_bytes, True)
                found.append(Stretch(name, at, cut))
                at = cut
        return found

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        """Lines with the file and the byte that each begins at."""
        store, folder = fs.FileSystem.from_uri(self.uri)
        at, rest = partition.start, b""
        with store.open_input_file(f"{folder}/{partition.path}") as file:
            file.seek(at)
            left = partition.end - at
            while left:
                read = file.read(min(_STEP, left))
                if not read:
                    raise OSError(f"{partition.path} is shorter than it was: {partition.end - left} of {partition.end} bytes")
                left -= len(read)
                *lines, rest = (rest + read).split(b"\n")
                for line in lines:
                    yield line.decode("utf-8", "replace").removesuffix("\r"), partition.path, at
                    at += len(line) + 1

    def commit(self, end: dict) -> None:
        pass

    def __getstate__(self) -> dict:
        """File systems are opened anew where the reader is taken to."""
        return {k: v for k, v in self.__dict__.items() if k not in ("store", "progress_store")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.store = fs.FileSystem.from_uri(self.uri)[0]

    def _sizes(self) -> list[tuple[str, int]]:
        """Files by name. Names that begin with a dot or an underscore are not read."""
        listed = self.store.get_file_info(fs.FileSelector(self.folder, allow_not_found=True))
        return sorted((f.base_name, f.size) for f in listed if f.is_file and f.base_name[0] not in "._")

    def _last_break(self, name: str, at: int, size: int, most: int, longer: bool) -> int:
        """Where the last whole line ends within ``most`` bytes, or ``at``; with ``longer`` a line beyond them is taken too."""
        with self.store.open_input_file(f"{self.folder}/{name}") as file:
            low = end = min(size, at + most)
            while low > at:  # backwards from the bound
                low, high = max(at, low - _STEP), low
                file.seek(low)
                found = file.read(high - low).rfind(b"\n")
                if found >= 0:
                    return low + found + 1
            while longer and end < size:
                file.seek(end)
                read = file.read(min(_STEP, size - end))
                found = read.find(b"\n")
                if found >= 0:
                    return end + found + 1
                end += len(read)
        return at

    def _noted(self) -> dict[str, int]:
        listed = self.progress_store.get_file_info(fs.FileSelector(self.progress, allow_not_found=True))
        places = sorted(f.path for f in listed if f.is_file and f.base_name.startswith("place-"))
        if not places:
            return self.first
        with self.progress_store.open_input_file(places[-1]) as file:
            return json.loads(file.read())

    def _note(self, place: dict[str, int]) -> None:
        """A new file for each place, written under another name first; the one before the last goes."""
        self.progress_store.create_dir(self.progress, recursive=True)
        total = sum(place.values())
        written = f"{self.progress}/_{uuid.uuid4().hex}"
        with self.progress_store.open_output_stream(written) as file:
            file.write(json.dumps(place).encode())
        self.progress_store.move(written, f"{self.progress}/place-{total:020}")
        listed = self.progress_store.get_file_info(fs.FileSelector(self.progress))
        for old in sorted(f.path for f in listed if f.base_name.startswith("place-"))[:-2]:
            self.progress_store.delete_file(old)


def growing_votes(spark: SparkSession, folder: str, progress: str, batch_bytes: int = BATCH_BYTES,
                  task_bytes: int = TASK_BYTES, start: str | None = None) -> DataFrame:
    """Votes from growing files, timed by the milliseconds that every line carries.

    ``folder`` and ``progress`` are URIs, or absolute paths of a folder that driver and
    executors share; ``progress`` belongs to one stream, like its checkpoint. A line without
    title, rating or time is dropped. Files may grow and new ones may come; what was read must
    not change. ``start`` is a place to start a new stream at.
    """
    spark.dataSource.register(GrowingLines)
    lines = (
        spark.readStream.format(FORMAT).option("path", folder).option("progress", progress)
        .option("batchBytes", batch_bytes).option("taskBytes", task_bytes)
        .option("from", start or "{}").load()
    )
    parts = F.split("value", "\t")
    number = [F.expr(f"try_cast(get(split(value, '\t'), {n}) AS BIGINT)") for n in (1, 2)]
    return lines.select(F.get(parts, F.lit(0)).alias("title_id"), number[0].alias("rating"),
                        millis_time(number[1]).alias("ts")).where(
        "title_id IS NOT NULL AND rating IS NOT NULL AND ts IS NOT NULL")
