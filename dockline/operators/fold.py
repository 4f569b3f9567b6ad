"""The admission fold over one Arrow batch, without a loop over its rows.

Rows are sorted by key and time. Whatever was accepted last, the next accepted row
is the first one that meets any of a few conditions, and each of those is a search
in the sorted rows. So every row gets a pointer to the row that would be accepted
after it; following the pointers from the first row of a key gives the accepted
rows, and they decide all others at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ..constants import ACCEPTED, COOLDOWN, DOUBLE_TAP, DUPLICATE, LATE, PENDING

NUMBERS = ("_at", "_double_tap", "_cooldown", "_ttl", "_delay", "_sched", "_until", "_expire")
# Positions stay below this, so that sums with a window cannot overflow.
_LIMIT = 1 << 61


class Rows:
    """The columns of a batch as arrays; seed rows only carry a state."""

    def __init__(self, columns: dict[str, pa.Array]):
        self.n = n = len(columns["_key"])
        key = columns["_key"]
        starts = np.concatenate([[True], pc.not_equal(key.slice(1), key.slice(0, n - 1)).to_numpy(zero_copy_only=False)])
        first = np.flatnonzero(starts)
        self.run = np.cumsum(starts) - 1
        self.start = first[self.run]
        self.end = np.append(first[1:], n)[self.run]
        self.seed = columns["_seed"].to_numpy(zero_copy_only=False).astype(bool)
        self.force = columns["_force"].to_numpy(zero_copy_only=False).astype(bool)
        for name in NUMBERS:
            setattr(self, name[1:], pc.fill_null(columns[name], 0).to_numpy(zero_copy_only=False).astype(np.int64))
        self.uid, self.digest = _codes(columns["_uid"]), _codes(columns["_digest"])
        # What each row would be as an accepted task.
        fresh = ~self.seed
        self.sched = np.where(fresh, np.where(self.force, self.at, self.at + self.delay), self.sched)
        until = np.maximum(self.at + self.double_tap + self.cooldown, self.sched)
        self.until = np.where(fresh, until, self.until)
        self.expire = np.where(fresh, self.until + self.ttl, self.expire)
        # The windows of a key, which a seed row does not have.
        last = self.end - 1
        self.dt, self.cd = self.double_tap[last], self.cooldown[last]

    def uniform(self) -> bool:
        """Whether each key keeps its windows and positions fit into integers."""
        events = ~self.seed
        same = np.all(self.double_tap[events] == self.dt[events]) and np.all(self.cooldown[events] == self.cd[events])
        return bool(same) and self._span() < _LIMIT // (int(self.run[-1]) + 2)

    def _span(self) -> int:
        ends = np.maximum(self.sched, self.until) - self.at
        reach = max(int(self.dt.max()), int(self.cd.max()), int(ends.max()))
        return int(self.at.max()) - int(self.at.min()) + reach + 3

    def successors(self) -> np.ndarray:
        """Per row, the row accepted next if this one was accepted; ``n`` if none is."""
        n, events = self.n, ~self.seed
        low, span = int(self.at.min()), self._span()
        base = self.run * span
        # A seed comes before all events of its key, whatever its time.
        position = base + np.where(self.seed, 0, self.at - low + 1)

        def at_or_after(moment: np.ndarray, side: str = "left") -> np.ndarray:
            return np.searchsorted(position, base + (moment - low + 1), side)

        tapped = at_or_after(self.at + self.dt)
        ready = at_or_after(np.maximum(self.at + self.dt, self.sched))
        # Out of the look-back: accepted in any case.
        best = at_or_after(self.at + self.cd, "right")
        # Past its cooldown, which may be shorter if the windows have been changed since.
        calm = at_or_after(np.maximum(np.maximum(self.at + self.dt, self.sched), self.until))
        best = np.minimum(best, _first_other(events, self.uid, calm, self.uid))
        # Forced: only the double tap and a repeated uid hold it back.
        best = np.minimum(best, _first_other(events & self.force, self.uid, tapped, self.uid))
        # A new uid counts as a change.
        best = np.minimum(best, _first_other(events & (self.uid > 0), self.uid, ready, self.uid))
        # So does a new digest of an event without a uid.
        best = np.minimum(best, _first_other(events & (self.uid == 0) & (self.digest > 0), self.digest, ready, self.digest))
        best = np.maximum(best, np.arange(n) + 1)
        return np.where(best < self.end, best, n)

    def accepted(self, following: np.ndarray) -> np.ndarray:
        """The rows accepted when each key starts with its first row."""
        marks, n, pointers = np.zeros(self.n, bool), self.n, following.tolist()
        chain = []
        for row in np.unique(self.start).tolist():
            while row < n:
                chain.append(row)
                row = pointers[row]
        marks[chain] = True
        return marks

    def ends(self, following: np.ndarray) -> np.ndarray:
        """Per row, the last row accepted if this one was accepted."""
        last = list(range(self.n))
        pointers = following.tolist()
        for row in range(self.n - 1, -1, -1):
            if pointers[row] < self.n:
                last[row] = last[pointers[row]]
        return np.array(last)

    def possible_starts(self) -> int:
        """How many leading rows can be the first one accepted in a run of one key.

        Whatever came before, a row later than the first by more than the look-back
        is accepted.
        """
        return min(int(np.searchsorted(self.at, self.at[0] + self.cd[0], "right")) + 1, self.n)

    def answers(self, accepted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Status of every row, and the row whose task it answers with."""
        index = np.arange(self.n)
        holder = np.maximum.accumulate(np.where(accepted, index, -1))
        status = np.select(
            [
                self.seed,
                accepted,
                self.at < self.at[holder],
                (self.uid > 0) & (self.uid == self.uid[holder]),
                self.at < self.at[holder] + self.double_tap,
                self.at < self.sched[holder],
            ],
            [None, ACCEPTED, LATE, DUPLICATE, DOUBLE_TAP, PENDING],
            COOLDOWN,
        )
        return status, holder


def _codes(column: pa.Array) -> np.ndarray:
    """Texts as numbers; a missing or empty one is 0."""
    encoded = pc.dictionary_encode(pc.fill_null(column, ""))
    codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    empty = pc.index(encoded.dictionary, "").as_py()
    return np.where(codes == empty + 1, 0, codes)


def _first_other(member: np.ndarray, value: np.ndarray, since: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Per row, the first member at or after ``since`` whose value is not the row's own.

    A row's own 0 stands for no value and equals nothing.
    """
    n = len(member)
    places = np.flatnonzero(member)
    if not len(places):
        return np.full(n, n)
    values = value[places]
    changes = np.flatnonzero(values[1:] != values[:-1]) + 1
    # For each member, the first later one with another value.
    after = np.append(changes, len(places))[np.searchsorted(changes, np.arange(len(places)), "right")]
    at = np.searchsorted(places, since)
    found = np.minimum(at, len(places) - 1)
    same = (at < len(places)) & (own > 0) & (values[found] == own)
    at = np.where(same, after[found], at)
    return np.append(places, n)[at]
