"""Items into containers of fixed capacity, by first-fit decreasing with a tournament tree.

Documents are measured in tokens of a public tokenizer, in Arrow batches beside
the scan; only ids and sizes are shuffled, never texts. A document longer than
the capacity is divided into full containers and a rest; nothing else is
divided. Items are dealt to random groups of about ``GROUP`` items by a hash of
their id, and every group is packed on its own: items in falling order of
size, each into the first container that has room, found in a tournament tree
over the containers' free room in logarithmic time. Groups are bounded, so no
task grows with the data, and a group's loss is at most its last containers.

Cases: null and empty texts have no tokens and are in no container; very long
texts are divided; items of equal size are packed in order of id; repeated ids
are repeated items (each row is an item of its own if its text differs, also if
both have as many tokens; rows wholly alike count once); a document without an id
is an item like others; an empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how byte-level BPE cuts a text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CAPACITY = 2048
GROUP = 20_000
_LOADED: dict[str, object] = {}


def tokenizer(path: str):
    """The tokenizer of a rank file, loaded once per worker."""
    if path not in _LOADED:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _LOADED[path] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def token_counts(documents: DataFrame, path: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, h) of documents with at least one token; h tells texts apart."""
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h")).where("text <> ''")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = tokenizer(path).encode_ordinary
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "n_tokens": [len(encode(t)) for t in pdf["text"]], "h": pdf["h"]})

    return docs.mapInPandas(run, "doc_id long, n_tokens long, h long").where("n_tokens > 0")


def pieces(sizes: DataFrame, capacity: int) -> DataFrame:
    """(doc_id, part, start, size): documents divided into pieces of at most the capacity."""
    parts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_tokens") - 1) / capacity))
    return sizes.withColumn("part", F.explode(parts)).select(
        "doc_id", "h", "part", (F.col("part") * capacity).alias("start"), F.least(F.lit(capacity).cast("long"), F.col("n_tokens") - F.col("part") * capacity).alias("size")
    )


class Tournament:
    """Free room of containers; finds the first container with at least a given room."""

    def __init__(self, n: int, capacity: int) -> None:
        self.leaves = 1 << max(0, (n - 1).bit_length())
        self.room = [capacity] * (2 * self.leaves)

    def put(self, size: int) -> int:
        room, k = self.room, 1
        while k < self.leaves:
            k *= 2
            if room[k] < size:
                k += 1
        room[k] -= size
        at = k - self.leaves
        k >>= 1
        while k:
            a, b = room[2 * k], room[2 * k + 1]
            top = a if a >= b else b
            if room[k] == top:
                break
            room[k] = top
            k >>= 1
        return at


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """Container number of each item; sizes must be in falling order and within the capacity."""
    tree = Tournament(max(1, len(sizes)), capacity)
    return [tree.put(s) for s in sizes]


def pack(sizes: DataFrame, capacity: int = CAPACITY, group: int = GROUP, seed: str = "42") -> DataFrame:
    """(container, doc_id, part, start, size) of documents (doc_id, n_tokens), with ``h`` where texts of one id are told apart.

    ``container`` is unique over all groups. Full pieces are containers of their own.
    """
    if capacity < 1:
        raise ValueError("the capacity must be at least 1")
    own = sizes.select("doc_id", "n_tokens", F.col("h") if dict(sizes.dtypes).get("h") == "bigint" else F.lit(0).cast("long").alias("h"))
    items = pieces(own.distinct(), capacity)
    n = items.count()
    groups = max(1, -(-n // group))
    dealt = items.withColumn("g", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "part"), F.lit(groups)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "doc_id", "part", "h"], ascending=[False, True, True, True])
        at = first_fit_decreasing(pdf["size"].tolist(), capacity)
        return pdf.assign(container=[f"{g}-{k}" for g, k in zip(pdf["g"], at)], doc_id=pdf["doc_id"].astype("Int64"))[["container", "doc_id", "part", "start", "size"]]

    return dealt.groupBy("g").applyInPandas(run, "container string, doc_id long, part long, start long, size long")
