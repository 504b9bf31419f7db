"""Token counts by whole tokens: most pre-tokens are counted without merging.

For a word-end BPE vocabulary it is proved once, per worker and vocabulary,
which of its strings the merges turn into one token: each entry with the end
mark is put through the merges alone.  A pre-token that is such a string counts
one; the others are merged, and a bounded table remembers their counts.

Texts of plain Latin script are lower-cased and cut into pre-tokens here by the
vocabulary's own pattern.  Others go through the vocabulary's normaliser and
pre-tokeniser, whose Unicode tables decide what is a letter.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tradewind.llm.common import small_batches

OVER = 2048
#: Counts of merged pre-tokens kept by a worker before it starts afresh.
REMEMBERED = 400_000

# Fixed values of the vocabulary: its pattern of pre-tokens and its end mark.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"

# Texts of these characters need no table but Python's: NFC keeps them as they
# are, and lower-casing keeps them among themselves, which U+0130 would not.
_LAST = 0x17F
_OTHER = re.compile(r"[^\t-\r\x20-~\xa1-\u012f\u0131-\u017f]")


def plain_pieces() -> re.Pattern:
    """The pattern with letters and numbers up to the last plain character spelled out."""

    def members(kind: str) -> str:
        return "".join(re.escape(chr(c)) for c in range(_LAST + 1) if unicodedata.category(chr(c))[0] == kind)

    return re.compile(PATTERN.replace(r"\p{L}", members("L")).replace(r"\p{N}", members("N")))


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves; the others follow from U+0100 on.
    """
    letters, spare = {}, 0x100
    for byte in range(256):
        if 0x21 <= byte <= 0x7E or 0xA1 <= byte <= 0xAC or 0xAE <= byte <= 0xFF:
            letters[byte] = chr(byte)
        else:
            letters[byte] = chr(spare)
            spare += 1
    return letters


class _Counts(dict):
    """Tokens of a pre-token: whole tokens beforehand, others when first met."""

    def __init__(self, tokenizer: Tokenizer) -> None:
        self.merges, self.letters = tokenizer.model, byte_letters()
        byte_of = {letter: byte for byte, letter in self.letters.items()}
        for entry in tokenizer.get_vocab(with_added_tokens=False):
            body = entry.removesuffix(WORD_END)
            if body == entry or not body or len(self.merges.tokenize(body)) != 1:
                continue
            try:
                self[bytes(map(byte_of.__getitem__, body)).decode()] = 1
            except (KeyError, UnicodeDecodeError):
                continue
        self.proved = len(self)
        self.whole = dict(self)

    def __missing__(self, piece: str) -> int:
        if len(self) > self.proved + REMEMBERED:
            self.clear()
            self.update(self.whole)
        count = len(self.merges.tokenize(piece.encode().decode("latin-1").translate(self.letters)))
        if len(piece) <= 64:
            self[piece] = count
        return count


class Counter:
    """Counts tokens of whole texts as the vocabulary's library does."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.counts = _Counts(self.tokenizer)
        self.pieces = plain_pieces()
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def _part(self, text: str) -> int:
        if not _OTHER.search(text):
            return sum(map(self.counts.__getitem__, self.pieces.findall(text.lower())))
        plain = self.tokenizer.normalizer.normalize_str(text)
        # The pre-tokeniser's pieces are in byte letters already.
        found = self.tokenizer.pre_tokenizer.pre_tokenize_str(plain)
        return sum(self.counts[plain[start:end]] for _, (start, end) in found)

    def __call__(self, text: str) -> int:
        if self.special is None or "<|" not in text or not self.special.search(text):
            return self._part(text)
        return len(self.special.findall(text)) + sum(map(self._part, self.special.split(text)))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, vocabulary: str, limit: int = OVER) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of ``docs`` (doc_id, text).

    ``vocabulary`` is a path every executor has, as installed with the library.  A
    NULL or empty text has 0 bytes and 0 tokens.  Repeated rows and rows without
    an id are counted each; an empty table gives no rows; other columns are not
    looked at.
    """
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens_of = counter(vocabulary)
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            tokens = [tokens_of(text) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(text.encode()) for text in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        count, f"doc_id {doc_id}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
