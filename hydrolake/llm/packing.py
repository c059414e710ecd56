"""Packing token sequences: first-fit decreasing with a tournament tree of bin capacities, in randomised groups."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydrolake.llm.common import materialize, whole_text

#: Texts of these characters alone take the fast encoder; both encoders split them alike (see tests).
PLAIN = re.compile(r"[^\t-\r\x20-\x7e\xa1-ɏ‐-‧€]")

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


@lru_cache(maxsize=2)
def _encoders(tokenizer_json: str, ranks_file: str | None):
    """The tokenizer as its file has it, its added tokens, and a faster encoder of the same vocabulary."""
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(tokenizer_json)
    added = tuple(t.content for t in exact.get_added_tokens_decoder().values())
    fast = None
    if ranks_file:
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return exact, added, fast


def encode(text: str, tokenizer_json: str, ranks_file: str | None) -> np.ndarray:
    """Token ids of a whole text, as the tokenizer gives them with add_special_tokens=False.

    The faster encoder takes only texts of PLAIN characters without an added token's string, where both are equal.
    """
    exact, added, fast = _encoders(tokenizer_json, ranks_file)
    if fast is not None and not PLAIN.search(text) and not any(t in text for t in added):
        return np.asarray(fast.encode_to_numpy(text, disallowed_special=()), dtype="<u4")
    return np.array(exact.encode(text, add_special_tokens=False).ids, dtype="<u4")


def token_pieces(docs: DataFrame, tokenizer_json: str, ranks_file: str | None, seq_len: int = 1024, end_id: int = 0) -> DataFrame:
    """One row per piece of at most ``seq_len`` ids: PIECES and _salt, a random number of the row that deals it to a group.

    Null text counts as empty, so each document has a piece. doc_id must be an integer or null. Only lengths and
    checksums leave the task; ids and texts are never shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = np.random.default_rng(TaskContext.get().partitionId())  # a task that is run again gives the same
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(encode(text, tokenizer_json, ranks_file), np.array([end_id], "<u4")).astype("<u4")
                for start in range(0, len(ids), seq_len):
                    piece = ids[start : start + seq_len]
                    out.append((doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids), int(salt.integers(2**62))))
            cols = list(zip(*out, strict=True)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "_salt"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(run, f"{PIECES}, _salt long")


def first_fit_decreasing(lengths: Sequence[int], capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item. Items go, longest first, to the first bin with room.

    The tournament tree holds at each node the largest room of the bins below, so the first bin with room is found
    by going down from the root: O(log n) an item.
    """
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    leaves = 1 << max(0, (n - 1).bit_length())
    room = [capacity] * (2 * leaves)
    for i in np.argsort(-np.asarray(lengths, dtype=np.int64), kind="stable").tolist():
        need, node = int(lengths[i]), 1
        while node < leaves:
            node *= 2
            if room[node] < need:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - room[node]
        room[node] -= need
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
    return bins, offsets


def pack(pieces: DataFrame, seq_len: int = 1024, pieces_per_group: int = 4000, n_pieces: int | None = None, seed: int = 7) -> DataFrame:
    """``pieces`` with sequence_id and offset.

    Pieces are dealt by a hash of their _salt (written with them) to groups of about ``pieces_per_group``, so copies of
    a row and null doc_ids spread like others; each group is packed alone, so a lost task is simply run again and gives
    the same sequences. Full pieces fill a sequence of their own in the same way. A sequence_id is group * 2^32 + the
    bin's number.
    """
    count = pieces.count() if n_pieces is None else n_pieces
    groups = max(1, -(-count // pieces_per_group))
    rest = [f for f in pieces.schema.names if f not in ("doc_id", "start", "length", "_salt")]

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_salt", "start"], kind="stable").reset_index(drop=True)
        bins, offsets = first_fit_decreasing(pdf["length"].to_numpy(), seq_len)
        pdf["sequence_id"] = int(key[0]) * 2**32 + bins
        pdf["offset"] = offsets
        return pdf[["doc_id", "start", "length", *rest, "sequence_id", "offset"]]

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.select("doc_id", "start", "length", *rest).schema)
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("_salt", F.lit(seed)), F.lit(groups)))
    return dealt.groupBy("_group").applyInPandas(run, f"{schema}, sequence_id long, offset long")


def public_files() -> tuple[str, str]:
    """The public byte-level BPE of 50k entries, and the same vocabulary as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def pack_documents(docs: DataFrame, tokenizer_json: str, ranks_file: str | None = None, seq_len: int = 1024, pieces_per_group: int = 4000) -> DataFrame:
    """Tokenise once, write the pieces' lengths to the shared folder, pack these."""
    pieces = materialize(token_pieces(docs, tokenizer_json, ranks_file, seq_len), "pieces")
    return pack(pieces, seq_len, pieces_per_group)
