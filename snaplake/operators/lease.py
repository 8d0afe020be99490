"""A claim that one driver at a time has on something, as marks that all drivers see.

A lease is a file that only one driver can create; it says whose it is and until when. Its holder puts off the end while it
works. A driver that is lost lets the lease expire, and the next one takes it over by creating the lease of the next
number, which again only one can. A finished lease says so.
"""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable
from dataclasses import dataclass

from snaplake.marks import Marks


@dataclass(frozen=True)
class Claim:
    number: int
    owner: str
    until: float  # seconds since the epoch, by the holder's clock

    def active(self, now: float) -> bool:
        return self.until > now


class Lease:
    """Clocks of drivers may differ by much less than ``seconds``."""

    def __init__(self, marks: Marks, name: str, owner: str, seconds: float = 120.0, clock: Callable[[], float] = time.time):
        self.marks, self.name, self.owner, self.seconds, self.clock = marks, name, owner, seconds, clock
        self._number: int | None = None
        self._beat: threading.Thread | None = None
        self._done = threading.Event()

    def _mark(self, number: int) -> str:
        return f"{self.name}.{number:08d}"

    def current(self) -> Claim | None:
        """The latest claim, active or not."""
        numbers = [int(tail) for n in self.marks.names(f"{self.name}.") if (tail := n.rpartition(".")[2]).isdigit() and len(tail) == 8]
        for number in sorted(numbers, reverse=True):
            said = self.marks.read(self._mark(number))
            if said is not None:
                return Claim(number, *(json.loads(said)[k] for k in ("owner", "until")))
        return None

    def acquire(self) -> bool:
        """Take the lease if nobody has it; of several that try, one does."""
        held = self.current()
        if held is not None and held.active(self.clock()):
            return False
        number = held.number + 1 if held else 0
        if not self.marks.create(self._mark(number), self._text(self.clock() + self.seconds)):
            return False
        self._number = number
        for n in range(max(0, number - 8), number - 1):  # those before the last one tell nobody anything
            self.marks.take_away(self._mark(n))
        return True

    def _text(self, until: float) -> str:
        return json.dumps({"owner": self.owner, "until": until})

    def renew(self) -> bool:
        """Put off the end; False if another driver has taken the lease over."""
        held = self.current()
        if self._number is None or held is None or held.number != self._number:
            return False
        self.marks.replace(self._mark(self._number), self._text(self.clock() + self.seconds))
        return True

    def release(self) -> None:
        self._done.set()
        held = self.current()
        if self._number is not None and held is not None and held.number == self._number:
            self.marks.replace(self._mark(self._number), self._text(0.0))
        self._number = None

    def keep(self, lost: Callable[[], None]) -> None:
        """Renew in the background until the release; call ``lost`` if the lease is another driver's."""

        def beat() -> None:
            while not self._done.wait(self.seconds / 3):
                if not self.renew():
                    if not self._done.is_set():
                        lost()
                    return

        self._beat = threading.Thread(target=beat, name=f"lease-{self.name}", daemon=True)
        self._beat.start()
