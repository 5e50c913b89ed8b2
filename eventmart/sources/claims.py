"""Claims on run days, so that jobs which run at the same time do not do a day twice or undo each other's bookkeeping.

A claim is a file that only one job can create; it names its owner and until when it holds. A job that fails lets go at
once; of one that was killed the claim runs out. Either way the file stays, and says that the day was begun and not ended: the
next job that comes takes it over, by creating the claim's successor, and does the day again.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession

from eventmart.functions.ranges import Day, as_date
from eventmart.sources.files import content, create, delete, exists, matching

#: Seconds after which a claim that nobody has ended may be taken over.
LEASE = 6 * 3600


class Claims:
    """The claims of one job below a folder that all jobs of a warehouse share."""

    def __init__(self, spark: SparkSession, folder: str, lease: float = LEASE):
        self._spark, self._folder, self._lease = spark, folder.rstrip("/"), lease
        self._owner = uuid.uuid4().hex
        self._held: dict[Day, int] = {}

    def _standing(self) -> dict[Day, int]:
        """The last claim's number on each run day."""
        last: dict[Day, int] = {}
        for path in matching(self._spark, f"{self._folder}/*.*"):
            day, _, number = path.rsplit("/", 1)[-1].rpartition(".")
            last[as_date(day)] = max(last.get(as_date(day), 0), int(number))
        return last

    def _path(self, day: Day, number: int) -> str:
        return f"{self._folder}/{day}.{number}"

    def _runs_out(self, day: Day, number: int) -> float:
        """When a claim ends; one whose text is not written yet has just been made."""
        text = content(self._spark, self._path(day, number))
        return float(text.split()[1]) if text else time.time() + self._lease

    def unfinished(self) -> list[Day]:
        """Days that were begun and not ended, by jobs that are no longer at them."""
        now = time.time()
        return sorted(day for day, number in self._standing().items() if self._runs_out(day, number) <= now)

    def take(self, days: Iterable[Day]) -> list[Day]:
        """Claim days; returns those that are this job's now, without those another job is at."""
        standing, now = self._standing(), time.time()
        for day in sorted({as_date(day) for day in days}):
            number = standing.get(day, 0)
            if number and self._runs_out(day, number) > now:
                continue
            if create(self._spark, self._path(day, number + 1), f"{self._owner} {now + self._lease}"):
                self._held[day] = number + 1
        return sorted(self._held)

    def end(self) -> None:
        """The days are done: their claims go, and the folder with the last one."""
        for day, number in self._held.items():
            # The last number goes last, so that no older claim stands alone.
            for past in range(1, number + 1):
                delete(self._spark, self._path(day, past))
        self._held = {}
        if exists(self._spark, self._folder) and not matching(self._spark, f"{self._folder}/*"):
            delete(self._spark, self._folder)

    def let_go(self) -> None:
        """The days are not done: whoever comes next may take them at once."""
        for day, number in self._held.items():
            create(self._spark, self._path(day, number + 1), f"{self._owner} 0")
        self._held = {}
