"""Encoding a corpus with a public byte-level BPE tokenizer.

A text is pre-tokenised in overlapping chunks; a chunk's boundaries are right from the first one on that the chunk before
it shares in the overlap (a pre-token depends only on the text after its start). The stitched text is cut at such shared
boundaries into pieces, which are encoded and put together in order. Texts of one chunk (``part`` characters) are one
piece; the chunks of longer ones stay in their task, where documents run in parallel anyway, and only those of texts
beyond ``chunk`` characters become rows of their own. The ids are the same either way.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folder of the public vocabulary files; a parameter of every function here.
TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern published with the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters a text may have before its chunks become rows of their own, and by which those overlap.
CHUNK, OVERLAP = 1 << 18, 1 << 12
#: The same for chunks inside a task.
PART, PART_OVERLAP = 1 << 11, 1 << 7


@lru_cache(maxsize=2)
def encoding(path: str):
    """The tokenizer of a vocabulary file, once per worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def _pattern():
    return regex.compile(PATTERN)


def starts(text: str) -> list[int]:
    """Where the pre-tokens of ``text`` start, and its end."""
    return [m.start() for m in _pattern().finditer(text)] + [len(text)]


def stitch(chunks: list[tuple[int, str]], bounds: list[list[int]]) -> list[str]:
    """Pieces of a text whose ends are pre-token boundaries, from its overlapping chunks (offset, text) in order and
    each chunk's own boundaries. Where two chunks share no boundary in their overlap, the chunk is read again together
    with what stands before it since the last right boundary."""
    pieces: list[str] = []
    offset, text, own = *chunks[0], bounds[0]
    begin = 0  # the first boundary of the text at hand that is right and not yet in a piece
    for (next_offset, next_text), next_own in zip(chunks[1:], bounds[1:]):
        shift = next_offset - offset
        # The last pre-token of a chunk may go on beyond it. A piece must not end in a blank: its end would decide
        # what the blanks before it become.
        mine = {b for b in own[:-2] if b >= max(shift, begin, 1) and not text[b - 1].isspace()}
        shared = next((b for b in next_own[:-2] if b + shift in mine), None)
        if shared is None:
            text = text[begin:shift] + next_text if begin <= shift else text[begin:] + next_text[len(text) - shift :]
            offset += begin
            begin, own = 0, starts(text)
            continue
        pieces.append(text[begin : shared + shift])
        offset, text, own, begin = next_offset, next_text, next_own, shared
    pieces.append(text[begin:])
    return [p for p in pieces if p]


def pieces_of(text: str, part: int, overlap: int) -> list[str]:
    """The pieces of a text by its overlapping chunks of ``part`` characters; a text of one chunk is one piece."""
    if len(text) <= part:
        return [text]
    chunks = [(at, text[at : at + part + overlap]) for at in range(0, len(text), part)]
    return stitch(chunks, [starts(c) for _, c in chunks])


def _encoder(path: str, part: int = PART, overlap: int = PART_OVERLAP):
    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        bpe = encoding(path).encode_ordinary
        return pd.Series([[i for p in pieces_of(t, part, overlap) for i in bpe(p)] if t else [] for t in texts], dtype=object)

    return encode


def encode(
    df: DataFrame, id_col: str, text_col: str, path: str = f"{TOKENIZERS}/{VOCABULARY}", chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """id_col and ids (array of int), one row per row of ``df``; ids must be unique for texts longer than ``chunk``.

    A null text and an empty text both give an empty list. Special-token strings in a text are ordinary text. Other
    columns are not read.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    is_long = F.length("text") > chunk
    short = rows.where(~F.coalesce(is_long, F.lit(False))).select("id", _encoder(path)("text").alias("ids"))
    ids = short.unionByName(_encode_long(rows.where(is_long), path, chunk, overlap))
    return ids.select(F.col("id").alias(id_col), "ids")


def _encode_long(rows: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    id_type = rows.schema["id"].dataType.simpleString()
    offsets = F.sequence(F.lit(0), F.length("text") - 1, F.lit(chunk))
    cut = rows.select("id", "text", F.explode(offsets).alias("at")).select(
        "id", "at", F.substring(F.col("text"), F.col("at") + 1, F.lit(chunk + overlap)).alias("part")
    )

    def bounds(batches):
        for b in batches:
            yield b.assign(bounds=[starts(t) for t in b["part"]])

    def join(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("at")
        pieces = stitch(list(zip(group["at"].tolist(), group["part"])), [list(b) for b in group["bounds"]])
        return pd.DataFrame({"id": [group["id"].iloc[0]] * len(pieces), "seq": range(len(pieces)), "piece": pieces})

    # One group is the chunks of one text, which was one row before.
    pieces = (
        cut.repartition("id", "at")
        .mapInPandas(bounds, f"id {id_type}, at int, part string, bounds array<int>")
        .groupBy("id")
        .applyInPandas(join, f"id {id_type}, seq int, piece string")
    )
    encoded = pieces.repartition("id", "seq").select("id", "seq", _encoder(path)("piece").alias("ids"))
    ordered = F.array_sort(F.collect_list(F.struct("seq", "ids")))
    return encoded.groupBy("id").agg(F.flatten(F.transform(ordered, lambda x: x["ids"])).alias("ids"))


def decode(df: DataFrame, id_col: str, ids_col: str, path: str = f"{TOKENIZERS}/{VOCABULARY}") -> DataFrame:
    """id_col and text: the raw bytes of the ids concatenated, read as UTF-8. Null or no ids give empty text."""

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        bpe = encoding(path)
        return pd.Series([b"".join(map(bpe.decode_single_token_bytes, x)).decode() if x is not None else "" for x in ids])

    return df.select(id_col, text(F.col(ids_col)).alias("text"))
