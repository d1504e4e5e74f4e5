"""Freely typed values mapped to a canonical list.

A multi-pattern automaton over all canonical names, other names and spellings made by rule finds the names embedded in
a value; of overlapping mentions the longest wins. What has no mention goes to token-set similarity, where a token may
match by a small slip or as an abbreviation, and a value that was cut may be the start of a name. Names are compared
only where they have a word (or, as one word, a piece) like one of the value's, so a long list costs no more than the
names that resemble a value. Values are worked out once per distinct text of a batch; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from caudalix.functions.pytext import Memo, NearKeys, edit_distance, fold_text, words_of

# Number words up to twelve, folded.
NUMBERS = ("zero", "uma", "duas", "tres", "quatro", "cinco", "seis", "sete", "oito", "nove", "dez", "onze", "doze")
# Words around a name that say nothing about which entry is meant, folded.
FILLERS = frozenset("de do da dos das e a o em no na parametro determinacao amostragem analise saida entrada por".split())
# What a unit after a dash or comma starts with, folded.
UNIT_START = (
    "mg ug mcg ng g kg ufc cfu m3 hm3 l litros metros miligramas microgramas gramas quilogramas graus °c °f kelvin k c f "
    "unidades escala sorensen us ms s microsiemens t ton toneladas"
).split()
_TAIL = re.compile(r"(?:\s+-|,)\s*(" + "|".join(map(re.escape, UNIT_START)) + r")(?![a-z]).*$")
_CUT_MARK = re.compile(r"\s*(?:\.\.\.|…|\(\.\.\.\)|\(…\))+\s*$")


def frequency_names(per_year: int) -> list[str]:
    """Ways to say how often a year something is done, by rule from the number of times."""
    out: list[str] = []

    def times(n: int, units: tuple[str, ...]) -> None:
        counts = [str(n), f"{n}x", f"{n} x", f"{n} vez", f"{n} vezes"]
        counts += [NUMBERS[n], f"{NUMBERS[n]} vez", f"{NUMBERS[n]} vezes"] if n < len(NUMBERS) else []
        for u in units:
            out.extend(f"{c}{link}{u}" for c in counts for link in (" ", " por ", " ao ", " a ", " em cada "))

    def every(n: int, singular: str, plural: str, article: str) -> None:
        if n == 1:
            out.extend((f"cada {singular}", f"{article} os {plural}", f"{article} as {plural}"))
        out.extend((f"{n} em {n} {plural}", f"cada {n} {plural}", f"1 {n} {plural}", f"1x {n} {plural}"))
        if 1 < n < len(NUMBERS):
            word = {2: "dois", 1: "um"}.get(n, NUMBERS[n])
            out.extend((f"{word} em {word} {plural}", f"cada {word} {plural}"))

    times(per_year, ("ano",))
    if per_year == 365:
        every(1, "dia", "dias", "todos"), times(1, ("dia",))
    if per_year % 52 == 0:
        times(per_year // 52, ("semana",))
        if per_year == 52:
            every(1, "semana", "semanas", "todas"), every(7, "semana", "dias", "todos")
    if per_year % 12 == 0:
        times(per_year // 12, ("mes",))
        if per_year == 24:
            every(15, "quinzena", "dias", "todas"), times(1, ("quinzena",)), out.append("cada quinzena")
        if per_year == 12:
            every(1, "mes", "meses", "todos")
    if 12 % per_year == 0 and per_year < 12:
        months = 12 // per_year
        every(months, "ano" if months == 12 else "periodo", "meses", "todos")
        spans = {2: "bimestre", 3: "trimestre", 4: "quadrimestre", 6: "semestre"}
        if months in spans:
            times(1, (spans[months],)), out.append(f"cada {spans[months]}")
        if months == 12:
            every(1, "ano", "anos", "todos")
    return out


@dataclass(frozen=True)
class Entry:
    ref: int
    name: str
    others: tuple[str, ...] = ()
    code: str | None = None
    per_year: int | None = None


def _tokens(text: str) -> str:
    return " ".join(re.findall(r"\d+|[^\W\d_]+", text))


class Mapper:
    """Finds the entry of one list meant by a typed value: ``mapper(value) -> (ref or 0, confidence)``.

    Ties between entries of the same length or similarity give no entry (0), as does a value with no mention whose
    best similarity is below ``least``; its confidence then rests on the names that could have reached it.
    """

    def __init__(self, entries: list[Entry], least: float = 0.72):
        import ahocorasick

        self.least = least
        self.automaton = ahocorasick.Automaton()
        patterns: dict[str, set[int]] = {}
        self.sets: list[tuple[int, list[str]]] = []
        whole: dict[str, set[int]] = {}
        for e in entries:
            spelled = [fold_text(e.name), *[fold_text(o) for o in e.others]]
            for folded in [*spelled, *([fold_text(e.code)] if e.code else [])]:
                whole.setdefault("".join(words_of(folded)), set()).add(e.ref)
                if len(folded) > 1:
                    patterns.setdefault(_tokens(folded), set()).add(e.ref)
                bare = re.sub(r"\s*\(.*?\)", "", folded)
                if bare != folded:
                    patterns.setdefault(_tokens(bare), set()).add(e.ref)
            for folded in spelled:
                self.sets.append((e.ref, [t for t in words_of(re.sub(r"\(.*?\)", "", folded)) if t not in FILLERS] or words_of(folded)))
            if e.per_year:
                name = fold_text(e.name)
                # Adjective endings and the adverb made from the adjective's feminine form.
                for other in {name + "mente", re.sub("a$", "o", name), re.sub("o$", "a", name) + "mente"}:
                    patterns.setdefault(other, set()).add(e.ref)
                for other in frequency_names(e.per_year):
                    patterns.setdefault(_tokens(other), set()).add(e.ref)
        self.whole = {k: next(iter(v)) for k, v in whole.items() if len(v) == 1}
        for pattern, refs in patterns.items():
            if len(refs) == 1 and pattern:
                self.automaton.add_word(f" {pattern} ", (len(pattern), next(iter(refs))))
        if len(self.automaton):
            self.automaton.make_automaton()
        self.starts = NearKeys((k for k in self.whole if len(k) >= 5), lambda k: 1 if len(k) < 8 else 2)
        #: Which names (by their place in ``sets``) have each word, once for each time they have it.
        self.having: dict[str, list[int]] = {}
        for i, (_, tokens) in enumerate(self.sets):
            for t in tokens:
                self.having.setdefault(t, []).append(i)
        self.tokens = NearKeys(self.having, _slips)

    def __call__(self, typed: str) -> tuple[int, float]:
        folded = _TAIL.sub("", fold_text(_CUT_MARK.sub("", typed)))
        folded = re.sub(r"\s*[(\[].*$", "", folded) or folded
        key = "".join(words_of(folded))
        if not key:
            return 0, 1.0
        if key in self.whole:
            return self.whole[key], 1.0
        if (ref := self.mention(folded)) is not None:
            return ref, 0.95
        return self.similar(folded, key)

    def mention(self, folded: str) -> int | None:
        """The entry of the longest mention; None without one, or where mentions of several entries remain."""
        if not len(self.automaton):
            return None
        text = f" {_tokens(folded)} "
        found = sorted(((size, end - size, end, ref) for end, (size, ref) in self.automaton.iter(text)), reverse=True)
        taken: list[tuple[int, int, int]] = []
        for size, start, end, ref in found:
            if all(end <= a or start >= b for a, b, _ in taken):
                taken.append((start, end, ref))
        refs = {ref for _, _, ref in taken}
        return refs.pop() if len(refs) == 1 else None

    def similar(self, folded: str, key: str) -> tuple[int, float]:
        begun = {self.whole[k] for k in self.starts.begun_by(key)} if len(key) >= 4 else set()
        if len(begun) == 1:
            return begun.pop(), 0.9
        tokens = [t for t in words_of(folded) if t not in FILLERS]
        if not tokens:
            return 0, 1.0
        best: dict[int, float] = {}
        for i, shared in self.resembling(tokens).items():
            ref, names = self.sets[i]
            # With all of the words that resemble one matched in full a name's similarity were this.
            if 2 * shared < self.least * (sum(map(len, names)) + shared) - 1e-9:
                continue
            score = _set_similarity(tokens, names)
            if score > best.get(ref, 0.0):
                best[ref] = score
        for k, d in self.starts.near(key):  # a slip in a name typed as one word, or over a blank
            best[self.whole[k]] = max(best.get(self.whole[k], 0.0), 1.0 - d / len(k))
        ranked = sorted(best.items(), key=lambda x: -x[1])
        if not ranked or ranked[0][1] < self.least:
            return 0, 1.0 - (ranked[0][1] if ranked else 0.0)
        if len(ranked) > 1 and ranked[1][1] == ranked[0][1]:
            return 0, 0.5
        return ranked[0][0], ranked[0][1]

    def resembling(self, typed: list[str]) -> Counter:
        """The names that have words like one of ``typed``, with the length of those words: no other name has a
        similarity above 0."""
        like: set[str] = set()
        for t in set(typed):
            if len(t) >= 2:
                like.update(self.tokens.begun_by(t))
            elif t in self.having:
                like.add(t)
            like.update(k for k, _ in self.tokens.near(t))
        shared: Counter = Counter()
        for t in sorted(like):
            for i in self.having[t]:
                shared[i] += len(t)
        return shared


def _slips(word: str) -> int:
    return 0 if len(word) < 4 else 1 if len(word) < 8 else 2


def _token_similarity(typed: str, known: str) -> float:
    if typed == known:
        return 1.0
    if len(typed) >= 3 and known.startswith(typed):
        return 0.95
    limit = _slips(known)
    d = edit_distance(typed, known, limit)
    if d <= limit:
        return 1.0 - d / max(len(known), len(typed))
    # An abbreviation of two letters ("Ox.") still says which word is meant.
    return 0.9 if len(typed) == 2 and known.startswith(typed) else 0.0


def _set_similarity(typed: list[str], known: list[str]) -> float:
    """Twice the matched length over both lengths; each token is matched once, best pairs first."""
    pairs = sorted(((_token_similarity(a, b), i, j) for i, a in enumerate(typed) for j, b in enumerate(known)), reverse=True)
    used_a: set[int] = set()
    used_b: set[int] = set()
    matched = 0.0
    for s, i, j in pairs:
        if s > 0 and i not in used_a and j not in used_b:
            used_a.add(i), used_b.add(j)
            matched += s * 2 * len(known[j])
    lengths = sum(len(known[j]) for j in range(len(known)))
    # A typed token counts with the length of the word it stands for.
    own = sum(len(a) for i, a in enumerate(typed) if i not in used_a) + sum(len(known[j]) for j in used_b)
    return matched / (lengths + own)


def mapped(c: Column, entries: list[Entry], least: float = 0.72) -> Column:
    """struct(ref_id, confianca) of each value: the entry meant, 0 where the list has none; null gives null fields."""
    memo = Memo(Mapper(entries, least))

    @F.pandas_udf("ref_id long, confianca double")
    def found(values: pd.Series) -> pd.DataFrame:
        codes, distinct = pd.factorize(values, use_na_sentinel=True)
        made = [memo[v] for v in distinct]
        rows = [made[i] if i >= 0 else (None, None) for i in codes]
        return pd.DataFrame(rows, columns=["ref_id", "confianca"]).astype({"ref_id": "Int64", "confianca": "float64"})

    # Marked so that the optimizer does not copy it to each use of its fields.
    return found.asNondeterministic()(c)
