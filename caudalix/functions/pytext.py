"""Unicode text forms in Python, for functions that run once per distinct value of a batch."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator

import pandas as pd

from caudalix.functions.fold import FULL_WIDTH, HYPHENS, IGNORABLE, LOOK_ALIKES, ODD_BLANKS

_INVISIBLE = re.compile(f"[{IGNORABLE}]")
_TABLE = (
    {ord(k): v for k, v in LOOK_ALIKES.items() if k != "α"}
    | {ord(k): v for k, v in FULL_WIDTH.items()}
    | dict.fromkeys(map(ord, ODD_BLANKS), " ")
    | dict.fromkeys(map(ord, HYPHENS), "-")
)
_ALPHA_IN_WORD = re.compile(r"(?<=[A-Za-zÀ-ÿ])α|α(?=[A-Za-zÀ-ÿ])")


def plain_text(s: str) -> str:
    """Composed text in plain letters, blanks and hyphens without invisible characters; signs and case stay."""
    s = unicodedata.normalize("NFC", _INVISIBLE.sub("", s)).translate(_TABLE)
    return unicodedata.normalize("NFC", _ALPHA_IN_WORD.sub("a", s))


def fold_text(s: str) -> str:
    """Plain, compatibility-folded, without accents and case, blanks collapsed; alpha and beta are spelled."""
    s = unicodedata.normalize("NFKD", plain_text(s)).casefold()
    s = "".join(c for c in s if not unicodedata.combining(c))
    return " ".join(s.replace("α", "alfa ").replace("β", "beta ").split())


def key_text(s: str) -> str:
    """Letters and digits of the folded text."""
    return "".join(c for c in fold_text(s) if c.isalnum())


class Memo(dict):
    """A function's results by argument; emptied when it holds ``most`` of them, so a worker's memory is bounded."""

    def __init__(self, function: Callable, most: int = 200_000):
        super().__init__()
        self.function, self.most = function, most

    def __missing__(self, argument):
        if len(self) >= self.most:
            self.clear()
        self[argument] = out = self.function(argument)
        return out


def per_distinct(values: pd.Series, function: Callable[[str], object]) -> list:
    """``function`` of each value, called once per distinct value of the series; null gives None."""
    codes, distinct = pd.factorize(values, use_na_sentinel=True)
    made = [function(v) for v in distinct]
    return [made[c] if c >= 0 else None for c in codes]


def edit_distance(a: str, b: str, most: int) -> int:
    """Edits between ``a`` and ``b`` (insert, delete, replace, swap of neighbours); more than ``most`` gives most+1."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before: list[int] = []
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            cost = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            row.append(cost)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return min(last[-1], most + 1)


class NearKeys:
    """A fixed set of keys, searched by start and by small slips without comparing all of them.

    Short keys are listed under what is left of them when as many characters as their ``edits`` are dropped: a text
    within that distance leaves one of the same rests. A longer key is cut into more pieces than its edits can touch (a
    swap of neighbours may touch two), so such a text holds one of them unchanged and nearly in its place.
    """

    #: Keys up to so many characters are short: they have at most 79 rests.
    SHORT = 12

    def __init__(self, keys: Iterable[str], edits: Callable[[str], int]):
        self.keys = sorted(set(keys))
        self.edits = edits
        self.rests: dict[str, list[str]] = {}
        self.pieces: dict[tuple[int, int, str], list[str]] = {}
        self.cuts: dict[int, set[int]] = {}
        for key in self.keys:
            if len(key) <= self.SHORT:
                for rest in self._dropped(key, edits(key)):
                    self.rests.setdefault(rest, []).append(key)
                continue
            count = 2 * edits(key) + 1
            self.cuts.setdefault(len(key), set()).add(count)
            for start, end in self._ends(len(key), count):
                self.pieces.setdefault((len(key), start, key[start:end]), []).append(key)
        self.most = max(map(edits, self.keys), default=0)

    @staticmethod
    def _dropped(text: str, most: int) -> set[str]:
        """``text`` without up to ``most`` of its characters, every way."""
        found = last = {text}
        for _ in range(most):
            last = {t[:i] + t[i + 1 :] for t in last for i in range(len(t))}
            found = found | last
        return found

    @staticmethod
    def _ends(length: int, count: int) -> Iterator[tuple[int, int]]:
        bounds = [i * length // count for i in range(count + 1)]
        return ((a, b) for a, b in zip(bounds, bounds[1:]) if a < b)

    def begun_by(self, text: str) -> Iterator[str]:
        """The keys that start with ``text``."""
        for i in range(bisect_left(self.keys, text), len(self.keys)):
            if not self.keys[i].startswith(text):
                return
            yield self.keys[i]

    def near(self, text: str) -> Iterator[tuple[str, int]]:
        """The keys within their edits of ``text``, with the distance."""
        seen: set[str] = set()
        if len(text) <= self.SHORT + self.most:
            for rest in self._dropped(text, self.most):
                seen.update(self.rests.get(rest, ()))
        for length in range(max(1, len(text) - self.most), len(text) + self.most + 1):
            for count in self.cuts.get(length, ()):
                shift = count // 2
                for start, end in self._ends(length, count):
                    for at in range(max(0, start - shift), min(start + shift, len(text) - end + start) + 1):
                        seen.update(self.pieces.get((length, start, text[at : at + end - start]), ()))
        for key in sorted(seen):
            limit = self.edits(key)
            if (d := edit_distance(text, key, limit)) <= limit:
                yield key, d


def words_of(folded: str) -> list[str]:
    """Runs of letters and digits."""
    return re.findall(r"[^\W_]+", folded)


def joined(values: Iterable[str]) -> str:
    return " ".join(values)
