"""Cost-balanced packing of documents into sequences of a fixed number of tokens."""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapwatch.llm.tables import slices

SEQUENCE_TOKENS = 2048
END_OF_DOCUMENT = 1
# So many tokens are packed together; this bounds the memory of a task.
POOL_TOKENS = 1 << 20
# A sequence's estimated cost is the sum of length + length ** 2 / QUADRATIC over its pieces: attention stays
# within a piece.
QUADRATIC = 1024.0

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def tokenizer_path(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return path


def encoder(path: str):
    """text -> ids of a byte-level BPE tokenizer file, as an array of unsigned 32-bit numbers.

    The file's own vocabulary and pattern are run by tiktoken, which gives the ids that ``tokenizers`` gives for
    it in about a sixth of the time. A text is cut at the file's added tokens, which have ids of their own.
    """
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    vocabulary, added = described["model"]["vocab"], {t["content"]: t["id"] for t in described["added_tokens"]}
    if any(t[flag] for t in described["added_tokens"] for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"{path}: added tokens that match by their surroundings are not supported")
    # The file writes a byte that has no visible character as a character from 256 on, in byte order.
    visible = [b for b in range(256) if chr(b).isprintable() and chr(b) != " " and b != 0xAD]
    hidden = [b for b in range(256) if b not in visible]
    byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
    ranks = {bytes(byte_of[c] for c in word): i for word, i in vocabulary.items() if word not in added}
    encoding = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    cuts = re.compile("|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) or r"(?!)")

    def ids(text: str) -> np.ndarray:
        return np.asarray(encoding.encode_to_numpy(text, disallowed_special=()), dtype="<u4")

    def encode(text: str) -> np.ndarray:
        parts, at = [], 0
        for cut in cuts.finditer(text):
            parts += [ids(text[at : cut.start()]), np.array([added[cut[0]]], "<u4")]
            at = cut.end()
        return np.concatenate([*parts, ids(text[at:])]) if parts else ids(text)

    return encode


def balance(lengths: list[int], capacity: int = SEQUENCE_TOKENS) -> list[list[tuple[int, int, int]]]:
    """Sequences of (piece, start in the piece, length), which hold every token of every piece once.

    As many sequences as the tokens need are open from the start. Pieces go by descending cost, each to the sequence
    of the lowest cost that has room for it. A piece that fits nowhere fills the cheapest sequence that has any
    room, and what is left of it takes its turn again. So less than one sequence's worth of room stays empty.
    """
    count = -(-sum(lengths) // capacity)
    room, cost = np.full(count, capacity), np.zeros(count)
    sequences: list[list[tuple[int, int, int]]] = [[] for _ in range(count)]
    waiting = [(-length, piece, 0) for piece, length in enumerate(lengths) if length]
    heapq.heapify(waiting)
    while waiting:
        longest, piece, start = heapq.heappop(waiting)
        length = -longest
        fits = room >= length
        at = int(np.argmin(np.where(fits if fits.any() else room > 0, cost, np.inf)))
        taken = min(length, int(room[at]))
        sequences[at].append((piece, start, taken))
        room[at] -= taken
        cost[at] += taken + taken * taken / QUADRATIC
        if taken < length:
            heapq.heappush(waiting, (taken - length, piece, start + taken))
    return [s for s in sequences if s]


def pack(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: its document, place in it, tokens, sequence and place there, ids (32-bit, little-endian).

    Documents are tokenised and packed where they are read, a pool of POOL_TOKENS at a time, without a shuffle:
    whole sequences are cut off a long document first, the rest is balanced. A sequence's number is made of the
    partition and a count, so that it is unique and the same when a task runs again. Only the last sequences of a
    pool are not full. NULL and empty texts have one token, the end mark; repeated rows are packed each; NULL keys
    stay NULL; an empty table gives no rows. Other columns are not looked at.
    """
    path = tokenizer_path(path)
    schema = pa.schema(
        [(n, pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")] + [("ids", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path), np.array([END_OF_DOCUMENT], "<u4")
        number = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        pool: list[tuple] = []
        held = 0

        def place(doc, tokens, start, ids, sequence, offset):
            rows.append((doc, start, len(ids), tokens, sequence, offset, ids.tobytes()))

        def emit():
            columns = list(zip(*rows)) or [[]] * len(schema)
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            rows.clear()
            return batch

        def empty_pool():
            nonlocal number, held
            for sequence in balance([len(p[3]) for p in pool]):
                offset = 0
                for piece, start, length in sequence:
                    doc, tokens, before, ids = pool[piece]
                    place(doc, tokens, before + start, ids[start : start + length], number, offset)
                    offset += length
                number += 1
            pool.clear()
            held = 0

        for batch in slices(batches):
            for doc, body in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = np.concatenate([encode(body.as_py() or ""), end])
                whole = len(ids) // SEQUENCE_TOKENS * SEQUENCE_TOKENS
                for start in range(0, whole, SEQUENCE_TOKENS):
                    place(doc, len(ids), start, ids[start : start + SEQUENCE_TOKENS], number, 0)
                    number += 1
                if whole < len(ids):
                    pool.append((doc, len(ids), whole, ids[whole:]))
                    held += len(ids) - whole
                if held >= POOL_TOKENS:
                    empty_pool()
                if len(rows) >= 1000:
                    yield emit()
        empty_pool()
        yield emit()

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, PIECES)
