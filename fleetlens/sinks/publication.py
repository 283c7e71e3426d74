"""Generations of tables under one pointer, published by compare-and-set.

A publication is staged under a name of its own, checked against the generation it was
made from, and becomes visible by one commit file whose name is the next number. The file
system lets only one writer create that name, so of rivals that read the same generation
one wins and the others get ``Conflict``; readers see a generation whole or not at all.
Commits are never changed: they are the history.

A generation covers a scope (its complete batches). A publication that covers less than
the one before is refused, unless it is asked for as a rebase: with the generation it
replaces, exactly the batches that go, and a reason, all of which the commit keeps.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Batches that a commit may name as added or removed; a scope itself stays in its table.
NAMED = 10_000
SCOPE = "_scope"


class Refused(ValueError):
    """The publication breaks a rule; what was published before stays."""


class Conflict(RuntimeError):
    """Another writer has published since the generation was read."""


@dataclass
class Commit:
    generation: int
    folder: str
    tables: list[str]
    previous: int | None = None
    batches: int = 0
    added: list[int] = field(default_factory=list)
    removed: list[int] = field(default_factory=list)
    reason: str | None = None
    at: str = ""


class Publication:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # reading

    def latest(self) -> Commit | None:
        numbers = self._numbers()
        return self._commit(numbers[-1]) if numbers else None

    def history(self, limit: int = 10) -> list[Commit]:
        """Commits, the newest first."""
        return [self._commit(n) for n in self._numbers()[::-1][:limit]]

    def table(self, name: str, generation: int | None = None) -> DataFrame:
        commit = self.latest() if generation is None else self._commit(generation)
        if commit is None or name not in commit.tables:
            raise Refused(f"no published table {name}")
        return self.spark.read.parquet(f"{commit.folder}/{name}")

    # writing

    def publish(
        self, tables: Mapping[str, DataFrame], scope: DataFrame, *, expected: int | None = None, removed: set[int] | None = None,
        reason: str | None = None, unchanged: Callable[[], bool] = lambda: True,
    ) -> Commit:
        """Publishes ``tables`` that cover ``scope`` (column batch) as the generation after ``expected`` (None: the first).

        ``removed`` and ``reason`` ask for a rebase. ``unchanged`` is called after the
        tables are staged: whether the inputs still are what they were.
        """
        rebase = removed is not None or reason is not None
        if rebase and (not removed or not (reason or "").strip() or expected is None or any(b <= 0 for b in removed)):
            raise Refused("a rebase names the generation it replaces, the batches that go and a reason")
        self._expect(expected)
        folder = f"{self.root}/generations/{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"
        try:
            for name, df in tables.items():
                df.write.parquet(f"{folder}/{name}")
            scope.select(F.col("batch").cast("bigint")).distinct().write.parquet(f"{folder}/{SCOPE}")
            commit = self._checked(folder, sorted(tables), expected, removed, reason)
            if not unchanged():
                raise Refused("inputs changed while tables were made")
            if not self._create(f"{self.root}/commits/{commit.generation:010d}.json", json.dumps(asdict(commit), ensure_ascii=False, sort_keys=True)):
                raise Conflict(f"generation {commit.generation} was published by another writer")
            return commit
        except BaseException as failure:
            self._fs.delete(self._path(folder), True)  # never visible: no commit names it
            self._create(f"{self.root}/failures/{uuid.uuid4().hex}.json", json.dumps({"error": str(failure)[:2000], "expected": expected, "at": _now()}, ensure_ascii=False))
            raise

    def restore(self, tables: Mapping[str, DataFrame], scope: DataFrame) -> Commit:
        """All tables of a recovered snapshot, into an empty place only."""
        return self.publish(tables, scope, expected=None)

    def failures(self) -> DataFrame:
        """Publications that were refused or failed: at, expected, error."""
        return self.spark.read.schema("at string, expected bigint, error string").json(f"{self.root}/failure[s]")

    def vacuum(self, keep: int = 10) -> list[str]:
        """Deletes the tables of generations before the last ``keep`` and of publications that never ended; commits stay.

        Call it where no publication is under way.
        """
        kept = {c.folder for c in self.history(keep)}
        folders = self._path(f"{self.root}/generations")
        there = [str(f.getPath()) for f in self._fs.listStatus(folders)] if self._fs.exists(folders) else []
        gone = [f for f in there if f.rsplit("/", 1)[-1] not in {k.rsplit("/", 1)[-1] for k in kept}]
        for f in gone:
            self._fs.delete(self._path(f), True)
        return gone

    # steps

    def _expect(self, expected: int | None) -> None:
        numbers = self._numbers()
        now = numbers[-1] if numbers else None
        if now != expected:
            raise Conflict(f"generation {now} is published, {expected} was read")

    def _checked(self, folder: str, tables: list[str], expected: int | None, removed: set[int] | None, reason: str | None) -> Commit:
        new = self.spark.read.parquet(f"{folder}/{SCOPE}")
        n = new.count()
        if not n or new.where("batch IS NULL OR batch <= 0").count():
            raise Refused("no complete batches: an empty scope would publish a gap of nothing")
        commit = Commit((expected or 0) + 1, folder, tables, expected, n, at=_now())
        if expected is None:
            return commit
        old = self.spark.read.parquet(f"{self._commit(expected).folder}/{SCOPE}")
        gone, come = (_named(a.join(b, "batch", "left_anti")) for a, b in ((old, new), (new, old)))
        if removed is None and gone:
            raise Refused(f"batches {gone} would be lost; restore them, or rebase with exactly these and a reason")
        if removed is not None and set(gone) != set(removed):
            raise Refused(f"batches {gone} would go, {sorted(removed)} were named")
        commit.added, commit.removed, commit.reason = come, gone, (reason or "").strip() or None
        return commit

    def _numbers(self) -> list[int]:
        folder = self._path(f"{self.root}/commits")
        if not self._fs.exists(folder):
            return []
        names = (f.getPath().getName() for f in self._fs.listStatus(folder))
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def _commit(self, generation: int) -> Commit:
        path = self._path(f"{self.root}/commits/{generation:010d}.json")
        stream = self._fs.open(path)
        try:
            return Commit(**json.loads(bytes(stream.readAllBytes())))
        finally:
            stream.close()

    def _create(self, path: str, content: str) -> bool:
        """Creates a whole file under a name that doesn't exist yet; False where it does."""
        at = self._path(path)
        self._fs.mkdirs(at.getParent())
        if self._fs.getScheme() == "file":  # a hard link is the local file system's exclusive create
            here = at.toUri().getPath()
            own = f"{os.path.dirname(here)}/.{uuid.uuid4().hex}"
            with open(own, "w", encoding="utf-8") as file:
                file.write(content)
                file.flush()
                os.fsync(file.fileno())
            try:
                os.link(own, here)
            except FileExistsError:
                return False
            finally:
                os.unlink(own)
            return True
        try:
            stream = self._fs.create(at, False)
        except Exception:
            if self._fs.exists(at):
                return False
            raise
        try:
            stream.write(content.encode())
        finally:
            stream.close()
        return True


def _named(batches: DataFrame) -> list[int]:
    rows = batches.orderBy("batch").limit(NAMED + 1).collect()
    if len(rows) > NAMED:
        raise Refused(f"more than {NAMED} batches changed")
    return [r.batch for r in rows]


def _now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="seconds")
