"""Looking up typed names in a short canonical list: exact key, any word order, abbreviated words, small slips.

The list's size is checked before it is collected, so what each task carries is a constant. A name is looked up once
per distinct value of a batch.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudalix.functions.pytext import NearKeys, fold_text, key_text, words_of

#: A canonical list is a constant of the plan up to this many rows (some 100 MB in each worker); more raise an error.
MOST_ROWS = 200_000


def small_rows(df: DataFrame, most: int = MOST_ROWS) -> list:
    """The rows of a table that is small by definition; more than ``most`` raise ValueError."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows in what should be a short fixed list")
    return rows


def named(ref: DataFrame, id_col: str, columns: tuple[str, ...], list_col: str | None = None) -> list[tuple[int, str]]:
    """(id, name) of every name of the list: plain ``columns``, and ``; ``-separated names in ``list_col``."""
    found = [F.array(*[F.col(c) for c in columns])]
    if list_col:
        found.append(F.coalesce(F.split(F.col(list_col), r";\s*"), F.array().cast("array<string>")))
    names = ref.select(F.col(id_col).alias("ref"), F.explode(F.concat(*found)).alias("name"))
    return sorted({(r.ref, r.name) for r in small_rows(names.where("trim(name) <> ''"))})


@dataclass
class Lookup:
    """Finds the id of the name meant by a typed text; None where there is none.

    In order: the same letters and digits; the same words in another order; the start of one name only (six letters
    or more); every word the start of the name's word; one edit (names of five to seven letters) or two (longer). A tie between ids at one step gives None.
    """

    names: list[tuple[int, str]]
    keys: dict[str, int] = field(default_factory=dict)
    orders: dict[tuple[str, ...], int] = field(default_factory=dict)

    def __post_init__(self):
        for ref, name in self.names:
            self.keys.setdefault(key_text(name), ref)
            self.orders.setdefault(tuple(sorted(words_of(fold_text(name)))), ref)
        self.first: dict[tuple[int, str], list[tuple[int, list[str]]]] = {}
        for ref, name in self.names:
            words = words_of(fold_text(name))
            for size in range(1, len(words[0]) + 1) if words else ():
                self.first.setdefault((len(words), words[0][:size]), []).append((ref, words))
        self.long = NearKeys((key for key in self.keys if len(key) >= 5), lambda key: 1 if len(key) <= 7 else 2)

    def __call__(self, typed: str | None) -> int | None:
        if not typed or not (key := key_text(typed)):
            return None
        if key in self.keys:
            return self.keys[key]
        words = words_of(fold_text(typed))
        if (ref := self.orders.get(tuple(sorted(words)))) is not None:
            return ref
        if len(key) >= 6 and len(begun := {self.keys[k] for k in self.long.begun_by(key)}) == 1:
            return begun.pop()
        if len(words) > 1 and len(key) >= 5:
            fits = {r for r, w in self.first.get((len(words), words[0]), ()) if all(a.startswith(b) for a, b in zip(w, words))}
            if len(fits) == 1:
                return fits.pop()
        near = [(d, self.keys[k]) for k, d in self.long.near(key)]
        best = {ref for d, ref in near if d == min(near)[0]}
        return best.pop() if len(best) == 1 else None
