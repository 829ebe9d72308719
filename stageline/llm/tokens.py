"""Token ids of a public vocabulary, the file read by the driver and sent to the tasks."""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
import tiktoken.registry
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stageline.llm.common import slices, text_rows

#: how byte-level BPE splits a text before it merges (fixed value of the public vocabulary)
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: white space in a row that is left to the vocabulary's own library: the split above goes
#: back over such a run place by place, and runs out of stack at about a million
LONG_SPACE = 50_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def read_vocabulary(path: str | None = None) -> str:
    with open(path or default_vocabulary(), encoding="utf-8") as file:
        return file.read()


def _byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as they are, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in printable}
    rest = (b for b in range(256) if b not in printable)
    return letters | {chr(256 + i): b for i, b in enumerate(rest)}


def _is_plain_byte_bpe(spec: dict) -> bool:
    """Ids in merge order, no normaliser, the usual split: what merging by rank gives alike."""
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    if model.get("type", "BPE") != "BPE" or spec.get("normalizer") or split.get("type") != "ByteLevel":
        return False
    if split.get("add_prefix_space") or not split.get("use_regex", True) or model.get("dropout"):
        return False
    if model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or model.get("ignore_merges"):
        return False
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        return False
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    ids = [model["vocab"].get(m, -1) for m in merged]
    return ids == list(range(256, 256 + len(ids)))


def encoder(vocabulary: str) -> Callable[[str], list[int]]:
    """Text to ids, without special tokens added; those written in a text keep their own ids.

    A plain byte-level BPE is merged by rank, which gives the same ids several times
    faster; any other vocabulary, and any text with a very long run of white space, goes
    through its own library. Kept for later tasks of the same worker.
    """
    name = "stageline-" + hashlib.sha256(vocabulary.encode()).hexdigest()
    known = tiktoken.registry.ENCODINGS
    if name not in known:
        spec = json.loads(vocabulary)
        if _is_plain_byte_bpe(spec):
            special = {t["content"]: t["id"] for t in spec["added_tokens"]}
            letters = _byte_of_letter()
            ranks = {
                bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special
            }
            known[name] = tiktoken.Encoding(name, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)
        else:
            known[name] = Tokenizer.from_str(vocabulary)
    held = known[name]
    if isinstance(held, Tokenizer):
        return lambda text: held.encode(text, add_special_tokens=False).ids
    special = held.special_tokens_set

    def encode(text: str) -> list[int]:
        if _has_long_space(text):
            return _library(vocabulary).encode(text, add_special_tokens=False).ids
        if any(s in text for s in special):
            return held.encode(text, allowed_special="all")
        return held.encode_ordinary(text)

    return encode


@functools.lru_cache(maxsize=2)
def _library(vocabulary: str) -> Tokenizer:
    return Tokenizer.from_str(vocabulary)


def _has_long_space(text: str) -> bool:
    return len(text) > LONG_SPACE and any(m.end() - m.start() > LONG_SPACE for m in re.finditer(r"\s+", text))


def encoded(batch: pa.RecordBatch, encode: Callable[[str], list[int]]) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and ids of each text; equal texts of a batch are encoded once."""
    known: dict[str, np.ndarray] = {}
    for i, text in enumerate(batch.column("text").to_pylist()):
        ids = known.get(text)
        if ids is None:
            ids = known[text] = np.asarray(encode(text), np.uint32)
        yield i, ids


def token_lengths(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``n_tokens``, one row per document; null text has none."""
    spec = read_vocabulary(vocabulary)

    def count(batches):
        encode = encoder(spec)
        for batch in slices(batches):
            lengths = np.zeros(batch.num_rows, np.int64)
            for i, ids in encoded(batch, encode):
                lengths[i] = len(ids)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(lengths)], names=["doc_id", "n_tokens"])

    rows = text_rows(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    return rows.mapInArrow(count, "doc_id long, n_tokens long")
