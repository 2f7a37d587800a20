"""Tables that grow by whole micro-batches.

A micro-batch is written aside, with its counters in a small file beside the rows, and moved into
place by one rename.  Readers see all of a batch or nothing of it, a batch that is repeated finds its
folder there and does nothing, and counters are as complete as rows.

Every FAN batches are written once more into one folder, in the table's clustered order; every FAN of
these folders again, and so on.  A table of any age has a few folders for each power of FAN, and only
what is new since the last time is rewritten.  What such a folder covers is deleted one round later, as
soon as the streams that follow the table have read it.

Object stores that cannot rename a folder need a committer or a table format in place of this.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from txnlake import files

FAN = 10
COUNTERS = "_counters"


def added(*counters: dict) -> dict[str, dict[str, int]]:
    """Counters {metric: {name: number}} summed."""
    total: dict[str, dict[str, int]] = {}
    for one in counters:
        for metric, numbers in one.items():
            own = total.setdefault(metric, {})
            for name, number in numbers.items():
                own[name] = own.get(name, 0) + (number or 0)
    return total


def since(now: dict, before: dict) -> dict[str, dict[str, int]]:
    """What has been counted between two totals."""
    minus = {m: {name: -n for name, n in numbers.items()} for m, numbers in before.items()}
    return added(now, minus)


@dataclass(frozen=True)
class BatchTable:
    """A folder of published batches, numbered from 0.

    `parts` are the subfolders of rows that a batch may have, with their schemas; `followers` are
    the files in which streams that read this table keep how far they are.
    """

    path: str
    parts: dict[str, str]
    followers: tuple[str, ...] = ()

    def folder(self, number: int, level: int = 0) -> str:
        return f"{self.path}/level={level}/number={number:012d}"

    def publish(
        self, spark: SparkSession, number: int, write: Callable[[str], dict], level: int = 0
    ) -> bool:
        """Move what `write(folder)` writes into place, with the counters it returns.

        False, and nothing done, where this batch is there already.
        """
        final = self.folder(number, level)
        if files.exists(spark, final):
            return False
        aside = f"{self.path}/_aside/level={level}-number={number}"
        files.delete(spark, aside)
        counted = write(aside)
        files.write_text(spark, f"{aside}/{COUNTERS}", json.dumps(counted))
        files.move(spark, aside, final)
        return True

    def take(
        self,
        spark: SparkSession,
        number: int,
        write: Callable[[str], dict],
        ordered: Callable[[DataFrame, str], DataFrame] = lambda df, part: df,
    ) -> None:
        """Publish a micro-batch, and fold what has become complete by it.

        A fold that a crash has prevented is made up for when the batch is repeated.
        """
        self.publish(spark, number, write)
        level = 0
        while (number + 1) % FAN == 0:
            number, level = number // FAN, level + 1
            children = [self.folder(n, level - 1) for n in range(number * FAN, (number + 1) * FAN)]
            children = [child for child in children if files.exists(spark, child)]
            folded = self.publish(
                spark, number, lambda aside, of=children: self._fold(spark, of, aside, ordered), level
            )
            if folded:
                self._expire(spark, number, level)

    def _fold(self, spark, children: list[str], aside: str, ordered) -> dict:
        for part in self.parts:
            rows = self._rows(spark, part, children)
            if rows is not None:
                ordered(rows, part).write.parquet(f"{aside}/{part}")
        return added(*(self._counters(spark, child) for child in children))

    def _expire(self, spark: SparkSession, number: int, level: int) -> None:
        """Delete what earlier folders of this level cover; the last one's readers may be at work."""
        end = number * FAN
        if level == 1:
            read = [files.read_text(spark, place) for place in self.followers]
            end = min([end, *(int(text) if text else 0 for text in read)])
        for child in files.children(spark, f"{self.path}/level={level - 1}"):
            if _number(child) < end:
                files.delete(spark, child)

    def live(self, spark: SparkSession) -> list[str]:
        """Folders that together have every batch once, the oldest first."""
        levels = sorted(map(_number, files.children(spark, self.path)), reverse=True)
        found, covered = [], 0
        for level in levels:
            span = FAN**level
            for number in map(_number, files.children(spark, f"{self.path}/level={level}")):
                if number * span >= covered:
                    found.append(self.folder(number, level))
                    covered = (number + 1) * span
        return found

    def folders(self, spark: SparkSession, part: str) -> list[str]:
        """The subfolders with rows of a part."""
        places = [f"{folder}/{part}" for folder in self.live(spark)]
        return [place for place in places if files.exists(spark, place)]

    def _rows(self, spark: SparkSession, part: str, folders: list[str]) -> DataFrame | None:
        places = [f"{folder}/{part}" for folder in folders]
        places = [place for place in places if files.exists(spark, place)]
        return spark.read.schema(self.parts[part]).parquet(*places) if places else None

    def read(self, spark: SparkSession, part: str) -> DataFrame:
        """The rows of a part, as they stand."""
        rows = self._rows(spark, part, self.live(spark))
        return spark.createDataFrame([], self.parts[part]) if rows is None else rows

    def pattern(self, part: str) -> str:
        """Where a stream that follows the table finds the rows of its batches."""
        return f"{self.path}/level=0/*/{part}"

    def _counters(self, spark: SparkSession, folder: str) -> dict:
        return json.loads(files.read_text(spark, f"{folder}/{COUNTERS}"))

    def totals(self, spark: SparkSession) -> dict[str, dict[str, int]]:
        """The counters of all batches, summed."""
        return added(*(self._counters(spark, folder) for folder in self.live(spark)))


def _number(path: str) -> int:
    return int(path.rsplit("=", 1)[1])


def number_of(path: str) -> int:
    """The batch that a file lies in."""
    return int(path.rsplit("/number=", 1)[1].split("/")[0])
