"""Language of documents and of the segments of mixed ones, word first with backoff.

A known word is scored by its log frequency in each language; an unseen word falls back to its longest known character
n-grams, from five characters down to one. The model is fitted on a bounded sample of labelled documents (labels may be
wrong, texts mixed): a first model from the labels decides each sentence, and a second one is counted from the sentences
so decided. Every document is then scored whole, sentence by sentence.

A sentence needs several words that speak for its language: the symbols and units of a table's row ("HC | 40,0 | mg/L")
belong to none, and what few wrong labels say about one symbol must not decide a row.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudalix.functions.pytext import Memo, per_distinct

LANGUAGES = ("pt", "en", "es", "fr", "de")
#: The classifier is fitted on about so many labelled documents of each language, chosen by a hash of their id.
SAMPLE_DOCS = 1_500
#: Longer documents are left out of the sample, whose size is so bounded; they are scored whole like all others.
SAMPLE_CHARS = 20_000
#: The sample is drawn from so many spellings of labels, the most frequent ones.
MOST_LABELS = 10_000
NGRAMS = (5, 4, 3, 2, 1)
#: Log-odds below which a sentence follows its neighbours instead of deciding for itself.
MARGIN = 2.5
#: Different words of two letters or more that must speak for a language before a sentence decides.
LEAST_WORDS = 3

# How labels name the languages, beside their two-letter code.
LABEL_NAMES = {
    "pt": ("por", "português", "portugues", "portuguese", "portugais", "portugiesisch", "portugués"),
    "en": ("eng", "english", "inglês", "ingles", "inglés", "anglais", "englisch"),
    "es": ("spa", "esp", "español", "espanol", "espanhol", "castellano", "castelhano", "spanish", "espagnol", "spanisch"),
    "fr": ("fra", "fre", "français", "francais", "francês", "frances", "francés", "french", "französisch"),
    "de": ("deu", "ger", "deutsch", "alemão", "alemao", "alemán", "german", "allemand"),
    "it": ("ita", "italiano", "italian", "italien", "italienisch"),
    "gl": ("glg", "galego", "gallego", "galician"),
    "ca": ("cat", "català", "catalán", "catalão", "catalan"),
}
# Labels that say there is none.
NO_LABEL = ("", "und", "??", "?", "n/a", "na", "-", "none", "null", "unknown", "unk", "mul", "zxx", "s/d", "...", "(vazio)")

_LINE = re.compile(r"[^\r\n\x0b\x0c\x85  ]+")
#: Behind a stop, marks may set texts apart (" / ", " — ") in front of the next sentence.
_SENTENCE_END = re.compile(r"(?<=[.!?…])[\"'”»)\]]*\s+(?=\W{0,12}[A-ZÀ-ÖØ-Þ\d])")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")


_CODES = {name: code for code, spelled in LABEL_NAMES.items() for name in spelled}
_REGION = re.compile(r"([^\W\d_]+)(?:[-_].*)?")


def code_of(label: str | None) -> str | None:
    """The two-letter code a label names, in any case, with or without region; None for a missing label. Another text
    stays as it is (it names no language of the list)."""
    text = (label or "").strip().lower()
    if text in NO_LABEL:
        return None
    found = _REGION.fullmatch(text)
    base = found[1] if found else text
    return _CODES.get(base, base)


def label_code(c: Column) -> Column:
    """``code_of`` each label, worked out once per distinct label of a batch."""

    @F.pandas_udf("string")
    def coded(labels: pd.Series) -> pd.Series:
        return pd.Series(per_distinct(labels, code_of), dtype=object)

    return coded(c)


def sentences(text: str) -> list[str]:
    """Whole sentences in order. A line that goes on in lower case belongs to the sentence before it."""
    out: list[str] = []
    for line in _LINE.findall(text):
        line = line.strip()
        if not line:
            continue
        parts = [p for p in _SENTENCE_END.split(line) if p]
        if out and parts and parts[0][:1].islower() and not out[-1].rstrip().endswith((".", "!", "?", ":", ";")):
            out[-1] += " " + parts.pop(0)
        out.extend(parts)
    return out


class Model:
    """Scores of words and texts by language; holds plain dictionaries, so it travels to the workers."""

    def __init__(self, counts: dict[str, Counter]):
        self.languages = tuple(lang for lang in LANGUAGES if counts.get(lang))
        vocabulary = {w for lang in self.languages for w in counts[lang]}
        self.words = self._logs(counts, vocabulary)
        grams: dict[int, dict[str, Counter]] = {n: defaultdict(Counter) for n in NGRAMS}
        for lang in self.languages:
            for word, n in counts[lang].items():
                marked = f"^{word}$"
                for k in NGRAMS:
                    for i in range(len(marked) - k + 1):
                        grams[k][lang][marked[i : i + k]] += n
        self.grams = {k: self._logs(c, {g for lang in c for g in c[lang]}) for k, c in grams.items()}
        self.unseen: dict[str, tuple[float, ...]] = {}

    def _logs(self, counts, keys) -> dict[str, tuple[float, ...]]:
        # A language's share of the sample is no evidence; add a tenth of a count to every key.
        totals = [sum(counts[lang].values()) + 0.1 * len(keys) for lang in self.languages]
        table = {}
        for key in keys:
            row = [math.log((counts[lang][key] + 0.1) / t) for lang, t in zip(self.languages, totals)]
            mean = sum(row) / len(row)
            table[key] = tuple(x - mean for x in row)
        return table

    def word(self, word: str) -> tuple[float, ...]:
        if (known := self.words.get(word)) is not None:
            return known
        if (known := self.unseen.get(word)) is not None:
            return known
        marked = f"^{word}$"
        score = (0.0,) * len(self.languages)
        for k in NGRAMS:
            found = [g for i in range(len(marked) - k + 1) if (g := self.grams[k].get(marked[i : i + k]))]
            if found:
                # The mean of the n-grams, at less weight than a known word.
                score = tuple(0.4 * sum(col) / len(found) for col in zip(*found))
                break
        if len(self.unseen) > 100_000:
            self.unseen.clear()
        self.unseen[word] = score
        return score

    def text(self, text: str) -> tuple[list[float], int]:
        """The scores of a text, and its language's number where the text decides, else -1."""
        words = _WORD.findall(text.lower())
        if not words:
            return [0.0] * len(self.languages), -1
        known = self.words.get
        scores = [known(w) or self.word(w) for w in words]
        total = [sum(column) for column in zip(*scores)]
        top = max(total)
        best = total.index(top)
        if len(total) == 1:
            return total, best
        second = max(range(len(total)), key=lambda i: total[i] if i != best else -math.inf)
        if top - total[second] < MARGIN:
            return total, -1
        speaking: set[str] = set()
        for w, s in zip(words, scores):
            if len(w) > 1 and s[best] > s[second]:
                speaking.add(w)
                if len(speaking) == LEAST_WORDS:
                    return total, best
        return total, -1


def fit(labelled: list[tuple[str, str]]) -> Model | None:
    """A model from (code, text) pairs; None without any. Counted twice: by label, then by the sentences' own scores."""
    counts: dict[str, Counter] = defaultdict(Counter)
    split = [(lang, [s for s in sentences(text)]) for lang, text in labelled if lang in LANGUAGES and text]
    for lang, parts in split:
        for s in parts:
            counts[lang].update(_WORD.findall(s.lower()))
    first = Model(counts)
    if not first.languages:
        return None
    counts = defaultdict(Counter)
    for _, parts in split:
        for s in parts:
            _, best = first.text(s)
            if best >= 0:
                counts[first.languages[best]].update(_WORD.findall(s.lower()))
    second = Model(counts)
    return second if second.languages else first


def sample(docs: DataFrame, doc_id: str, text: str, lang: str, most: int = SAMPLE_DOCS) -> list[tuple[str, str]]:
    """At most about ``most`` different labelled texts of each language, by a hash of the text: (code, text).

    A text is taken once, with its most frequent label, however many documents repeat it. The choice depends on nothing
    but the texts and labels.
    """
    spark = docs.sparkSession
    spelled = docs.where(F.col(text).isNotNull()).groupBy(F.col(lang).alias("label")).agg(F.count("*").alias("n"))
    known = spelled.withColumn("code", label_code(F.col("label"))).where(F.col("code").isin(*LANGUAGES))
    labels = known.orderBy(F.desc("n"), "label").limit(MOST_LABELS).collect()
    size: Counter = Counter()
    for r in labels:
        size[r["code"]] += r["n"]
    # At most MOST_LABELS rows: a constant of the plan.
    share = [(r["label"], r["code"], min(1_000_000, math.ceil(1_000_000 * most / size[r["code"]]))) for r in labels]
    if not share:
        return []
    keep = F.broadcast(spark.createDataFrame(share, "label string, code string, keep int"))
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("label")).where(F.length("text").between(1, SAMPLE_CHARS))
    place = F.pmod(F.xxhash64("text"), F.lit(1_000_000))
    chosen = rows.join(keep, "label").where(place < F.col("keep")).groupBy("text").agg(F.mode("code", True).alias("code"))
    # The shares above hold on average; the order makes the bound on the driver's memory exact and its choice stable.
    found = chosen.orderBy(place, "text").limit(2 * most * len(LANGUAGES)).collect()
    return [(r["code"], r["text"]) for r in found]


def segments(model: Model, text: str) -> list[tuple[str, float, int]]:
    """Runs of whole sentences in one language: (language, confidence, characters), in order; none without words.

    A sentence that does not decide (no words, figures, a name alone, a table's row) follows the one before it, or the first that
    decides.
    """
    runs: list[list] = []  # language, scores, characters
    waiting = 0
    spare = [0.0] * len(model.languages)
    for s in sentences(text):
        score, best = model.text(s)
        if best < 0:
            spare = [a + b for a, b in zip(spare, score)]
            if runs:
                runs[-1][2] += len(s)
            else:
                waiting += len(s)
            continue
        if runs and runs[-1][0] == best:
            runs[-1][1] = [a + b for a, b in zip(runs[-1][1], score)]
            runs[-1][2] += len(s)
        else:
            runs.append([best, score, len(s) + waiting])
            waiting = 0
    if not runs:
        if not any(spare):
            return []
        runs = [[spare.index(max(spare)), spare, waiting]]
    return [(model.languages[b], _confidence(scores, b), n) for b, scores, n in runs]


def _confidence(scores: list[float], best: int) -> float:
    top = max(scores)
    return math.exp(scores[best] - top) / sum(math.exp(x - top) for x in scores)


def identify(docs: DataFrame, doc_id: str, text: str, lang: str, model: Model | None = None, most: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, segmento, lang, confianca, n_chars, label: row 0 of each document is its main language (that of most of
    its characters), rows 1.. the segments of a document in several languages. ``label`` is the delivered label's code.

    Null, blank and wordless texts give no row; without any labelled document there is no model and no row. Repeated
    documents are judged each for itself. Other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("label"))
    id_type = docs.schema[doc_id].dataType.simpleString()
    if model is None:
        model = fit(sample(docs, doc_id, text, lang, most))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = Memo(code_of)
        for batch in batches:
            out = []
            for i, t, raw in zip(batch["id"], batch["text"], batch["label"]):
                label = codes[raw]
                found = segments(model, t) if model and t else []
                if not found:
                    continue
                size: Counter = Counter()
                weight: Counter = Counter()
                for language, confidence, n in found:
                    size[language] += n
                    weight[language] += n * confidence
                main, n = size.most_common(1)[0]
                out.append((i, 0, main, weight[main] / max(1, n), n, label))
                if len(size) > 1:
                    out.extend((i, k, language, c, n, label) for k, (language, c, n) in enumerate(found, 1))
            yield pd.DataFrame(out, columns=["id", "segmento", "lang", "confianca", "n_chars", "label"])

    schema = f"id {id_type}, segmento long, lang string, confianca double, n_chars long, label string"
    return rows.where("text is not null").mapInPandas(judge, schema).withColumnRenamed("id", doc_id)
