"""Old against new licence of an asset, parameter by parameter; interval relations; text pairs and their answers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudalix.functions.text import legal_norm, text_pair_key


def interval_relation(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    """How two periods lie: igual, sobrepostos, separados, or desconhecido where a date is missing."""
    return (
        F.when(a1.isNull() | a2.isNull() | b1.isNull() | b2.isNull(), "desconhecido")
        .when((a1 == b1) & (a2 == b2), "igual")
        .when((a1 <= b2) & (b1 <= a2), "sobrepostos")
        .otherwise("separados")
    )


def oldest_and_newest(df: DataFrame, asset: str, start: str, row_id: str, chosen: DataFrame | None = None) -> DataFrame:
    """asset, antiga, nova: the ids of the first and last version by start (undated ones left out); assets with one
    version give no row. ``chosen`` (asset, antiga, nova) names the pair of some assets instead."""
    dated = df.where(F.col(asset).isNotNull() & F.col(start).isNotNull())
    ends = dated.groupBy(asset).agg(F.min(F.struct(start, row_id)).alias("_first"), F.max(F.struct(start, row_id)).alias("_last"))
    found = ends.where(F.col("_first") != F.col("_last")).select(asset, F.col(f"_first.{row_id}").alias("antiga"), F.col(f"_last.{row_id}").alias("nova"))
    if chosen is None:
        return found
    return found.join(chosen, asset, "left_anti").unionByName(chosen.select(asset, "antiga", "nova"))


def compared(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer comparison by key. Both sides: keys, vle, texto (legal text), criterios (array or null).

    estado says what became of the parameter; mais and menos are the criteria that came and went.
    """
    o = old.select(*keys, F.struct("vle", "texto", "criterios").alias("o"))
    n = new.select(*keys, F.struct("vle", "texto", "criterios").alias("n"))
    both = o.join(n, keys, "full")
    crit_o, crit_n = F.array_sort("o.criterios"), F.array_sort("n.criterios")
    state = (
        F.when(F.col("n").isNull(), "removido")
        .when(F.col("o").isNull(), "novo")
        .when(crit_o.isNotNull() & crit_n.isNotNull(), F.when(crit_o == crit_n, "sem alteração").otherwise("altera"))
        .when(legal_norm(F.col("o.texto")) != legal_norm(F.col("n.texto")), "a confirmar")
        .otherwise("provável sem alteração")
    )
    minus = lambda a, b: F.coalesce(F.array_join(F.array_sort(F.array_except(a, b)), "; "), F.lit(""))
    return both.select(
        *keys,
        F.coalesce("o.vle", F.lit("")).alias("vle_antigo"),
        F.coalesce("n.vle", F.lit("")).alias("vle_novo"),
        state.alias("estado"),
        minus(F.col("n.criterios"), F.col("o.criterios")).alias("mais"),
        minus(F.col("o.criterios"), F.col("n.criterios")).alias("menos"),
    )


def text_pairs(df: DataFrame, columns: list[str], row_id: str) -> DataFrame:
    """chave, n, exemplo (lowest row_id) of the distinct tuples of comparable texts."""
    return df.groupBy(text_pair_key(*[F.col(c) for c in columns]).alias("chave")).agg(F.count("*").alias("n"), F.min(row_id).alias("exemplo"))


def answered(pairs: DataFrame, answers: DataFrame) -> DataFrame:
    """Each pair with its stored answer, PENDENTE where there is none; answers are unique by chave."""
    return pairs.join(answers.select("chave", "resposta"), "chave", "left").fillna("PENDENTE", ["resposta"])


def answer_field(c: Column, name: str) -> Column:
    """The value of a ``NAME: value`` line of an answer; empty text without one."""
    return F.trim(F.regexp_extract(F.coalesce(c, F.lit("")), rf"(?im)^\s*{name}\s*:\s*(.*)$", 1))


def first_message(c: Column) -> Column:
    """The content of the first object of type ``message`` in a model's answer (JSON objects with blank lines between
    them; the content may stand in an object of its own). Chunks that are no JSON are passed over; without a message
    the text itself, trimmed."""
    chunks = F.filter(F.split(c, "\\n\\n"), lambda x: F.get_json_object(x, "$.type") == "message")
    first = F.get(chunks, 0)
    inner = F.coalesce(F.get_json_object(first, "$.content.content"), F.when(F.get_json_object(first, "$.content").startswith("{"), F.lit("")), F.get_json_object(first, "$.content"), F.lit(""))
    return F.when(F.size(chunks) > 0, inner).otherwise(F.trim(c))


def asked(pairs: DataFrame, answers: DataFrame, ask: Callable[[str, str], str]) -> DataFrame:
    """New answers (chave, resposta) to the pairs (chave, antes, depois) that ``answers`` lacks, each asked once.

    ``ask`` gets both texts; where it fails, or gives nothing, there is no answer to store and the pair stays pending.
    """

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, before, after in zip(batch["chave"], batch["antes"], batch["depois"]):
                try:
                    said = ask(before, after)
                except Exception:  # noqa: BLE001  whatever the model's client raises: an error is no answer
                    continue
                if said:
                    rows.append((key, said))
            yield pd.DataFrame(rows, columns=["chave", "resposta"], dtype=object)

    fresh = pairs.dropDuplicates(["chave"]).join(answers, "chave", "left_anti").select("chave", "antes", "depois")
    return fresh.mapInPandas(answer, "chave string, resposta string")
