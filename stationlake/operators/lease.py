"""A lease on a table: one maintenance run at a time, with fencing numbers.

Leases are small files ``_compaction/lease/<number>`` that are created without
overwriting.  The highest number is the newest lease; it is held until it is
released (``<number>.done``) or its time has run out.  Who takes over creates
the next number, so a run that was thought dead can see, before it changes
the table, that it no longer holds the lease.
"""

from __future__ import annotations

import json
import time
import uuid

from stationlake.fs import HadoopFS

#: Seconds a lease lasts without renewal, and that a new lease waits before it
#: reads itself back (for file systems whose create is not atomic).
LEASE_SECONDS, SETTLE_SECONDS = 3600, 0.05


class LeaseHeld(RuntimeError):
    """Another run holds the lease."""


class LeaseLost(RuntimeError):
    """The lease ran out and another run took over."""


def _numbers(names: list[str]) -> tuple[list[int], set[int]]:
    """(numbers of the leases, those released)."""
    taken = sorted(int(n) for n in names if n.isdigit())
    return taken, {int(n[:-5]) for n in names if n.endswith(".done") and n[:-5].isdigit()}


class TableLease:
    """``with TableLease(fs, root): ...``; raises LeaseHeld if it is taken."""

    def __init__(self, fs: HadoopFS, root: str, seconds: float = LEASE_SECONDS):
        self.fs, self.dir, self.seconds = fs, f"{root.rstrip('/')}/_compaction/lease", seconds
        self.owner, self.number = uuid.uuid4().hex, 0

    def _path(self, number: int) -> str:
        return f"{self.dir}/{number:010d}"

    def _names(self) -> list[str]:
        return [p.rsplit("/", 1)[1] for p in self.fs.list_dir(self.dir)]

    def _record(self) -> str:
        return json.dumps({"owner": self.owner, "expires": time.time() + self.seconds})

    def _read(self, number: int) -> dict:
        try:
            return json.loads(self.fs.read_text(self._path(number)))
        except Exception:  # being written, or just removed: as good as held
            return {"owner": None, "expires": time.time() + SETTLE_SECONDS}

    def acquire(self) -> "TableLease":
        taken, released = _numbers(self._names())
        newest = taken[-1] if taken else 0
        if newest and newest not in released and self._read(newest)["expires"] > time.time():
            raise LeaseHeld(f"another run holds lease {newest} of {self.dir}")
        if not self.fs.create_new(self._path(newest + 1), self._record()):
            raise LeaseHeld(f"another run took lease {newest + 1} of {self.dir}")
        time.sleep(SETTLE_SECONDS)
        if self._read(newest + 1)["owner"] != self.owner:
            raise LeaseHeld(f"another run took lease {newest + 1} of {self.dir}")
        self.number = newest + 1
        for old in (n for n in taken if n < newest):  # the newest two remain
            self.fs.delete(self._path(old), recursive=False)
            self.fs.delete(f"{self._path(old)}.done", recursive=False)
        return self

    def check(self) -> None:
        """Renew; raises LeaseLost if another run has a higher number."""
        taken, _ = _numbers(self._names())
        if not taken or taken[-1] != self.number:
            raise LeaseLost(f"lease {self.number} of {self.dir} was taken over by {taken[-1] if taken else 'nobody known'}")
        self.fs.write_text(self._path(self.number), self._record())

    def release(self) -> None:
        self.fs.write_text(f"{self._path(self.number)}.done", "")

    def __enter__(self) -> "TableLease":
        return self.acquire()

    def __exit__(self, *_) -> None:
        self.release()
