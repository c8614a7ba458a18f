"""Token ids of whole texts, by a public tokenizer's file, with a memo of words.

A tokenizer that is cut at ASCII white space gives the same ids for the parts as for the whole, so each distinct part is encoded once per
worker process. Texts where that doesn't hold (other white space, strings of special tokens) are encoded whole.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Parts and pieces that one worker process keeps, the first that it meets; later new ones are encoded each time.
MEMO_PARTS, MEMO_PIECES = 60_000, 700_000
#: Longer words are not kept.
MEMO_LONGEST = 64
_LETTERS, _STOPS = "A-Za-zÀ-ÖØ-öø-ÿ", ".,;:!?#*$%&|<>"
_UNUSUAL = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -​    　﻿]|<\\|")


class _Memo(dict):
    """A dict that fills itself up to a number of entries."""

    def __init__(self, make: Callable[[str], bytes], entries: int):
        super().__init__()
        self._make, self._entries = make, entries

    def __missing__(self, part: str) -> bytes:
        made = self._make(part)
        if len(self) < self._entries and len(part) <= MEMO_LONGEST:
            self[part] = made
        return made


class WordwiseTokenizer:
    """Ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self._whole = Tokenizer.from_file(path)
        self.n_ids = self._whole.get_vocab_size()
        self._pieces, self._parts = _Memo(self._piece, MEMO_PIECES), _Memo(self._part, MEMO_PARTS)
        drops_space = self._ids("a b") == self._ids("a") + self._ids("b")
        self._cut = re.compile(r"[^ \t-\r]+" if drops_space else r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+").findall
        self._spaced = not drops_space
        # Plain words with stops behind them are most of all parts: the pieces that they split into are known.
        self._plain = re.compile(rf"({'' if drops_space else '\n?'})({'' if drops_space else ' ?'}[{_LETTERS}]+)([{_STOPS}]*)").fullmatch
        self._lower = self._ids("A") == self._ids("a")
        mapped = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(256) if re.match(f"[{_LETTERS}{_STOPS} \n]", chr(c))]
        self._bytes = {ord(c): mapped.pre_tokenize_str(c)[0][0] for c in letters}

    def _ids(self, text: str) -> bytes:
        return np.asarray(self._whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _modelled(self, piece: str) -> bytes:
        ids = [token.id for token in self._whole.model.tokenize(piece)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        return self._modelled(piece.translate(self._bytes)) if piece else b""

    def _part(self, part: str) -> bytes:
        # Most parts are ASCII letters with at most one stop behind them: these checks cost a fraction of the pattern's.
        body, stop = (part[:-1], part[-1]) if part[-1] in _STOPS else (part, "")
        if body.isascii() and (body[1:] if self._spaced and body[:1] == " " else body).isalpha():
            ids = self._pieces[body.lower() if self._lower else body]
            return ids + self._pieces[stop] if stop else ids
        if plain := self._plain(part):
            space, word, stops = plain.groups()
            pieces = self._pieces
            return pieces[space] + pieces[word.lower() if self._lower else word] + pieces[stops]
        normal = self._whole.normalizer.normalize_str(part) if self._whole.normalizer else part
        return b"".join([self._modelled(piece) for piece, _ in self._whole.pre_tokenizer.pre_tokenize_str(normal)])

    def encode(self, text: str) -> bytes:
        if _UNUSUAL.search(text):
            return self._ids(text)
        return b"".join(map(self._parts.__getitem__, self._cut(text)))


@lru_cache(maxsize=2)
def wordwise(path: str) -> WordwiseTokenizer:
    """One per file and worker process, so that tasks share the memo."""
    return WordwiseTokenizer(path)


def encode_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    then: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None,
    schema: str | None = None,
) -> DataFrame:
    """(key, ids): the ids of each whole text and `end_id`, as little-endian unsigned 32-bit integers.

    `then` turns each batch of these columns into one of `schema` in the same Python worker, which a second step would double.

    `tokenizer` is the path of a tokenizers file that every executor has. Null and empty texts give the end id alone; each row gives one
    row, repeated or not.
    """
    schema = schema or docs.select(key).schema.add("ids", "binary", False)
    end = struct.pack("<I", end_id)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids = wordwise(tokenizer).encode
        for batch in batches:
            ids = [to_ids(value) + end if value else end for value in batch.column(1).to_pylist()]
            encoded = pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=[key, "ids"])
            yield then(encoded) if then else encoded

    return docs.select(key, text).mapInArrow(encode, schema)
