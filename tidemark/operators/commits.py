"""A group's position at one path, replaced as a whole (OFF-4, STR-5).

The file holds, for each topic, the last ranges as ``"p:off,p:off"`` strings
(OFF-2), and for each run the newest batch it has finished. It is written aside
and renamed over the old one, so a reader finds the old or the new content,
never half of it or nothing; a start reads this one small file however many
batches the log holds. Because the positions and the finished batches change
together, whatever goes by the file (the counters' visibility) commits in the
same step as the offsets.

One run owns the file at a time: a start takes it over, and a run that lost it
is refused when it tries to commit, so that a consumer that was believed dead
cannot add a batch that its successor has counted.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from tidemark.session import exists, read_small, replace_file

Positions = dict[tuple[str, int], int]


class TakenOver(RuntimeError):
    """Another run has started for this group."""


def encode_positions(positions: Positions) -> dict[str, str]:
    """``"p:off,p:off"`` per topic (the driver-side form of OFF-2)."""
    out: dict[str, list[str]] = {}
    for (topic, partition), offset in sorted(positions.items()):
        out.setdefault(topic, []).append(f"{partition}:{offset}")
    return {t: ",".join(v) for t, v in out.items()}


def decode_positions(text: dict[str, str]) -> Positions:
    return {(t, int(p)): int(o) for t, some in text.items() for p, o in (x.split(":") for x in some.split(",") if x)}


@dataclass
class Commit:
    owner: str = ""
    run_id: str = ""  # of the last commit
    batch_id: int = -1
    begins: Positions = field(default_factory=dict)
    ends: Positions = field(default_factory=dict)
    finished: dict[str, int] = field(default_factory=dict)  # run: its newest batch

    def to_text(self) -> str:
        return json.dumps({"owner": self.owner, "run_id": self.run_id, "batch_id": self.batch_id,
                           "from": encode_positions(self.begins), "until": encode_positions(self.ends),
                           "finished": self.finished}, sort_keys=True)

    @classmethod
    def of_text(cls, text: str) -> Commit:
        d = json.loads(text)
        return cls(d["owner"], d["run_id"], d["batch_id"], decode_positions(d["from"]), decode_positions(d["until"]),
                   d["finished"])

    def before(self, run_id: str, batch_id: int, commit: str) -> Positions:
        """Positions that a batch begins from: what the last batch reached;
        if this is that batch again, or a new run and the position is saved
        before the work, what the last batch began from."""
        again = batch_id <= self.batch_id if run_id == self.run_id else commit == "before"
        return dict(self.begins if again else self.ends)


class CommitFile:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def read(self) -> Commit | None:
        if not exists(self.spark, self.path):
            return None
        return Commit.of_text(read_small(self.spark, self.path))

    def _replace(self, commit: Commit) -> None:
        replace_file(self.spark, self.path, f"{self.path}.{uuid.uuid4().hex}", commit.to_text())

    def take(self, run_id: str) -> None:
        """Make this run the owner; positions stay as they are."""
        now = self.read() or Commit()
        if now.owner != run_id:
            now.owner = run_id
            self._replace(now)

    def commit(self, run_id: str, batch_id: int, ranges: list[tuple[str, int, int, int]]) -> None:
        """Save a batch's (topic, partition, from, until) ranges and that the
        batch is finished."""
        now = self.read() or Commit(owner=run_id)
        if now.owner != run_id:
            raise TakenOver(f"run {now.owner} has taken over from {run_id}; batch {batch_id} is not committed")
        now.run_id, now.batch_id = run_id, batch_id
        now.finished[run_id] = batch_id
        for t, p, a, b in ranges:
            now.begins[t, p], now.ends[t, p] = a, b
        self._replace(now)

    def forget(self, runs: set[str]) -> None:
        """Drop runs whose batches nobody needs to look up any more."""
        now = self.read()
        if now and runs & set(now.finished) - {now.owner}:
            now.finished = {r: b for r, b in now.finished.items() if r not in runs or r == now.owner}
            self._replace(now)
