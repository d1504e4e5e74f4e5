"""Evaluation passages inside training text, by an FM-index per shard of the corpus.

A shard is a run of documents of one partition, as a sequence of word numbers. A phrase has only words of the passages,
so of a document only the runs of ``least`` and more such words are kept, set apart by a separator, with their places.
The shard's suffix array gives the Burrows-Wheeler transform, which is kept in a wavelet matrix. All test phrases (the
windows of ``least`` words of the passages) are searched backward at once, occurrences are located by walking to sampled
suffix positions, and the spans of one passage in one document are merged. Only the passages travel, as word numbers;
documents are read once and nothing is shuffled.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of a shard, and every how many positions the suffix array is kept.
SHARD_WORDS, SAMPLE = 1 << 17, 8
#: Passages are a constant of the plan up to so many words (64 MB as numbers, some 100,000 passages); more of them are
#: searched in further blocks, each with a pass over the documents.
BLOCK_WORDS = 1 << 24
#: Phrases searched at once in a shard.
SEARCHED = 1 << 18
_WORD = re.compile(r"[^\W_]+")
#: The accents of Latin letters, and where all other combining characters lie.
_ACCENTS, _OTHER_MARKS = re.compile("[\u0300-\u036f]+"), re.compile("[\u0483-\u1fff\u20d0-\U0001efff]")


def words(text: str | None) -> list[str]:
    """Runs of letters and digits, without case and accents. Null gives none."""
    if not text:
        return []
    text = unicodedata.normalize("NFKD", text.casefold())
    if not text.isascii():
        text = _ACCENTS.sub("", text)
        if _OTHER_MARKS.search(text):
            text = "".join(c for c in text if not unicodedata.combining(c))
    return _WORD.findall(text)


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``s`` in order, by doubling the compared length until all differ."""
    n = len(s)
    rank = np.unique(s, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    width = 1
    while True:
        second = np.full(n, -1, np.int64)
        second[:-width] = rank[width:] if width < n else second[:-width]
        pair = rank * (n + 1) + second + 1
        order = np.argsort(pair, kind="stable")
        ordered = pair[order]
        fresh = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        width *= 2
        if fresh[-1] == n - 1 or width >= n:
            return order


class WaveletMatrix:
    """Ranks and accesses over a sequence of numbers below 2**bits, many at a time."""

    def __init__(self, s: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (s >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(int(len(s) - self.ones[-1][-1]))
            s = np.concatenate([s[bit == 0], s[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before ``at``; both are arrays."""
        low, high = np.zeros_like(at), at
        for i, level in enumerate(range(self.bits - 1, -1, -1)):
            one = ((symbol >> level) & 1).astype(bool)
            a, b = self.ones[i][low], self.ones[i][high]
            low = np.where(one, self.zeros[i] + a, low - a)
            high = np.where(one, self.zeros[i] + b, high - b)
        return high - low

    def access(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros_like(at)
        for i in range(self.bits):
            a = self.ones[i][at]
            one = self.ones[i][at + 1] > a
            out = out * 2 + one
            at = np.where(one, self.zeros[i] + a, at - a)
        return out


class FMIndex:
    """Backward search over one shard. Symbol 0 is the end, 1 the separator."""

    def __init__(self, s: np.ndarray, alphabet: int, sample: int = SAMPLE):
        s = np.append(s, 0)
        order = suffix_array(s)
        bwt = s[order - 1]
        self.n = len(s)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(bwt, minlength=alphabet))]).astype(np.int64)
        self.tree = WaveletMatrix(bwt, max(1, int(alphabet - 1).bit_length()))
        kept = order % sample == 0
        self.kept_rank = np.concatenate([[0], np.cumsum(kept)])
        self.kept, self.kept_at = kept, order[kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix range of each row of ``phrases``; empty where the phrase does not occur."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.n, np.int64)
        alive = np.arange(len(phrases))
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[alive, column]
            low[alive] = self.before[symbol] + self.tree.rank(symbol, low[alive])
            high[alive] = self.before[symbol] + self.tree.rank(symbol, high[alive])
            gone = low[alive] >= high[alive]
            high[alive[gone]] = low[alive[gone]]
            alive = alive[~gone]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: steps to the nearest sampled position before each."""
        at, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.full(len(rows), -1, np.int64)
        left = np.arange(len(rows))
        while len(left):
            here = at[left]
            done = self.kept[here]
            hit = left[done]
            out[hit] = (self.kept_at[self.kept_rank[at[hit]]] + steps[hit]) % self.n
            left = left[~done]
            symbol = self.tree.access(at[left])
            at[left] = self.before[symbol] + self.tree.rank(symbol, at[left])
            steps[left] += 1
        return out


class Passages:
    """Test passages as word numbers, one after the other."""

    def __init__(self):
        self.symbols: dict[str, int] = {}
        self.items: list[int] = []
        self.ids, self.ends = array("i"), array("q")

    def add(self, item: int, text: str) -> None:
        self.items.append(item)
        self.ids.extend([self.symbols.setdefault(w, len(self.symbols) + 2) for w in words(text)])
        self.ends.append(len(self.ids))

    def phrases(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All words, where the windows of ``least`` words start that lie in one passage, and each one's passage."""
        ids, ends = np.frombuffer(self.ids, np.int32) if self.ids else np.zeros(0, np.int32), np.frombuffer(self.ends, np.int64)
        owner = np.searchsorted(ends, np.arange(len(ids)), side="right")
        inside = np.arange(len(ids)) + least <= ends[owner]
        return ids, np.flatnonzero(inside), owner[inside]


def known_runs(ids: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Start and end of the runs of ``least`` and more known words (numbers above 0)."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], ids > 0, [0]]).astype(np.int8)))
    return [(a, b) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()) if b - a >= least]


def _finder(passages: Passages, least: int, shard_words: int):
    symbols = passages.symbols

    def search_shard(docs: list[tuple[int, int, np.ndarray]]) -> pd.DataFrame:
        """docs: (document, word offset of this part, word numbers)."""
        words_, windows, owner = passages.phrases(least)
        items = np.array(passages.items, np.int64)
        starts = np.cumsum([0, *[len(d[2]) + 1 for d in docs]])
        s = np.ones(starts[-1], np.int64)
        for (_, _, ids), at in zip(docs, starts):
            s[at : at + len(ids)] = ids
        index = FMIndex(s, len(symbols) + 2)
        ids, offsets = np.array([d[0] for d in docs], object), np.array([d[1] for d in docs], np.int64)
        out = [pd.DataFrame({"id": [], "item": [], "start": []})]
        for block in range(0, len(windows), SEARCHED):
            begin = windows[block : block + SEARCHED]
            low, high = index.search(words_[begin[:, None] + np.arange(least)].astype(np.int64))
            counts = high - low
            found = np.flatnonzero(counts)
            if not len(found):
                continue
            c = counts[found]
            inside = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
            at = index.locate(np.repeat(low[found], c) + inside)
            doc = np.searchsorted(starts, at, side="right") - 1
            item = items[owner[block + np.repeat(found, c)]]
            out.append(pd.DataFrame({"id": ids[doc], "item": item, "start": at - starts[doc] + offsets[doc]}))
        return pd.concat(out[1:] or out)

    def merged(hits: list[pd.DataFrame]) -> pd.DataFrame:
        all_ = pd.concat(hits).drop_duplicates().sort_values(["id", "item", "start"])
        if not len(all_):
            return pd.DataFrame({"id": [], "item": [], "first_word": [], "last_word": []})
        same = (all_["id"] == all_["id"].shift()) & (all_["item"] == all_["item"].shift())
        # Phrases that overlap or touch make one span.
        run = (~(same & (all_["start"] <= all_["start"].shift() + least))).cumsum()
        spans = all_.groupby(run).agg(id=("id", "first"), item=("item", "first"), a=("start", "min"), b=("start", "max"))
        return pd.DataFrame(
            {"id": spans["id"], "item": spans["item"], "first_word": spans["a"] + 1, "last_word": spans["b"] + least}
        )

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard: list[tuple[int, int, np.ndarray]] = []
        size, hits = 0, []
        known = symbols.get
        for batch in batches:
            for doc, text in zip(batch["id"], batch["text"]):
                found = words(text)
                ids = np.fromiter((known(w, 0) for w in found), np.int64, len(found))
                for first, last in known_runs(ids, least):
                    # Parts of a run longer than a shard overlap by one word less than a phrase.
                    for at in range(first, max(first + 1, last - least + 1), shard_words):
                        part = ids[at : min(last, at + shard_words + least - 1)]
                        shard.append((doc, at, part))
                        size += len(part) + 1
                        if size >= shard_words:
                            hits.append(search_shard(shard))
                            shard, size = [], 0
                if not shard and hits:  # a document has ended together with its shard
                    yield merged(hits)
                    hits = []
        if shard:
            hits.append(search_shard(shard))
        if hits:
            yield merged(hits)

    return find


def spans(
    docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, least: int = 13,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """Spans of ``docs`` that hold at least ``least`` consecutive words of an item.

    doc_id, item_id, first_word, last_word (counted from 1 over the document's words). Differences of case, accents,
    punctuation and white space do not count. Null, empty and short texts hold nothing; repeated documents are found
    each for itself; a span of two items is listed for both. Without items, or without documents, no row.
    """
    id_type = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where(F.length("text") > 2 * least - 2)
    schema = f"id {id_type}, item long, first_word long, last_word long"
    blocks = [Passages()]
    known = items.select(F.col(item_id).cast("long"), item_text).where(f"{item_text} is not null").toLocalIterator()
    for item, passage in known:
        if len(blocks[-1].ids) >= BLOCK_WORDS:
            blocks.append(Passages())
        blocks[-1].add(item, passage)
    found = [rows.mapInPandas(_finder(block, least, shard_words), schema) for block in blocks]
    out = reduce(DataFrame.unionByName, found)
    return out.select(F.col("id").alias(doc_id), F.col("item").alias(item_id), "first_word", "last_word")
