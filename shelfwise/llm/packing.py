"""Packing by power-of-two decomposition.

A document's token ids are cut into pieces whose lengths are powers of two: as
many of the longest as fit, then the binary digits of the rest.  Every piece is
a sequence of its own, so no sequence crosses documents and none is padded;
sequences of one length share a bucket, which is what a training step draws from.

The work is one narrow pass: no shuffle, and a task holds one batch of texts.  A
bucket with a third of all sequences needs no task of its own, as sequences are
numbered within (bucket, task): sequence_id holds the bucket, the task and a count.

Tokenizing: white space parts the tokenizer's words, and no token spans it, so a
text's ids are the ids of its stretches between spaces and line ends.  A
different stretch is tokenized once (the memory for known stretches is
bounded; it is emptied when full), and a Python worker keeps them for its next task.

Defined results: null and empty texts are the end id alone; repeated rows and null
ids are packed like any others; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from shelfwise.llm.common import bound_batches

SEQUENCE_TOKENS = 4096
END_ID = 2
#: Bytes of ids and of text that a task keeps for known stretches.
KNOWN_BYTES = 200 << 20
#: A special token of the tokenizer, put between stretches of one call.
SEPARATOR = "<|startoftext|>"
TOGETHER = 4000
#: Punctuation that the tokenizer parts from an ASCII letter or digit before it.
CLOSING = ".,;:!?%*#$&|"


def piece_lengths(total: int, longest: int = SEQUENCE_TOKENS) -> list[int]:
    """Powers of two, falling, that add up to ``total``; none above ``longest``."""
    whole, rest = divmod(total, longest)
    return [longest] * whole + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


class StretchTokenizer:
    """Token ids of texts as bytes (little-endian unsigned 32 bits)."""

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.separator_id = self.tokenizer.token_to_id(SEPARATOR)
        self.known: dict[str, bytes] = {}
        self.held = 0

    def _learn(self, new: list[str]) -> None:
        """New stretches are put together from known or new cores (lower case, as
        the tokenizer does not tell cases apart) and closing punctuation."""
        parts = {}
        for s in new:
            core = s.rstrip(CLOSING)
            # other letters may change before they are parted from what follows: some
            # lower-case or normalised forms end with a mark, which joins punctuation
            tail = s[len(core):] if core and core[-1].isascii() and core[-1].isalnum() else ""
            core = s[:len(s) - len(tail)]
            parts[s] = core.lower() if core.isascii() and SEPARATOR[:2] not in core else core, tail
        self._encode_new(list({x for pair in parts.values() for x in pair}.difference(self.known)))
        known = self.known
        for s, (core, tail) in parts.items():
            if s not in known:
                self._keep(s, known[core] + known[tail])

    def _encode_new(self, new: list[str]) -> None:
        """One call for many stretches, with a special token between them whose id
        parts their ids again."""
        for at in range(0, len(new), TOGETHER):
            some = [s for s in new[at:at + TOGETHER] if SEPARATOR not in s]
            ids = np.array(self.tokenizer.encode(SEPARATOR.join(some), add_special_tokens=False).ids, dtype="<u4")
            ends = np.append(np.flatnonzero(ids == self.separator_id), len(ids)) * 4
            raw, start = ids.tobytes(), 0
            for s, e in zip(some, ends.tolist()):
                self._keep(s, raw[start:e])
                start = e + 4
            for s in new[at:at + TOGETHER]:
                if SEPARATOR in s:
                    own = self.tokenizer.encode(s, add_special_tokens=False).ids
                    self._keep(s, np.array(own, dtype="<u4").tobytes())

    def _keep(self, stretch: str, ids: bytes) -> None:
        self.known[stretch] = ids
        self.held += len(ids) + len(stretch) + 150

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for text in texts:
            stretches = text.replace("\n", " ").split(" ")
            new = set(stretches).difference(self.known)
            if new:
                if self.held > KNOWN_BYTES:
                    self.known.clear()
                    self.held, new = 0, set(stretches)
                self._learn(list(new))
            yield b"".join(map(self.known.__getitem__, stretches))


_TOKENIZERS: dict[str, StretchTokenizer] = {}


def worker_tokenizer(tokenizer_file: str) -> StretchTokenizer:
    """This Python worker's tokenizer for a file."""
    if tokenizer_file not in _TOKENIZERS:
        _TOKENIZERS[tokenizer_file] = StretchTokenizer(tokenizer_file)
    return _TOKENIZERS[tokenizer_file]


def pack(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text",
         longest: int = SEQUENCE_TOKENS, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, bucket`` (the length is 2**bucket) and, if asked for,
    ``ids`` (little-endian unsigned 32 bits).

    ``tokenizer_file`` must be readable at that path on every executor.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    bound_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType
    arrow_id = to_arrow_type(id_type)
    end = end_id.to_bytes(4, "little")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        tokenizer = worker_tokenizer(tokenizer_file)
        numbered = [0] * 64
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket", "ids"]
        types = [arrow_id, *[pa.int64()] * 6, pa.int32(), pa.binary()]
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc_id, ids in zip(batch.column(0).to_pylist(), tokenizer.encode(texts)):
                ids += end
                total, start = len(ids) // 4, 0
                for length in piece_lengths(total, longest):
                    bucket = length.bit_length() - 1
                    own = ids[4 * start:4 * (start + length)]
                    sequence = bucket << 57 | task << 32 | numbered[bucket]
                    numbered[bucket] += 1
                    for column, value in zip(rows, (doc_id, start, length, zlib.crc32(own), total, sequence, 0, bucket, own)):
                        column.append(value)
                    start += length
            n = len(names) if with_ids else len(names) - 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows[:n], types)], names=names[:n])

    schema = (f"doc_id {id_type.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long, bucket int" + (", ids binary" if with_ids else ""))
    return docs.select(f"`{id_col}`", f"`{text_col}`").mapInArrow(packed, schema)
