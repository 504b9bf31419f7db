"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The transducer is compiled from a model file of the BPE kind: the normaliser (spaces to
the visible mark, one in front), an automaton of all pieces that merging
can reach, and arcs that spell a character without a piece in bytes.  Its states hold the
piece just written.  An arc from piece ``u`` to piece ``t`` weighs nothing if merging
``u + t`` alone gives back just these two, and is missing, infinitely heavy,
otherwise.  Merges never cross a boundary that merging both neighbours keeps,
so the shortest path through the composition with a text, of weight zero, spells
exactly the pieces that merging the whole text gives.

Composition runs from left to right and keeps the one live state of each position.  Pieces never hold a mark
after another character, nor certain signs after a letter, so texts fall apart there into chunks; a bounded
table remembers chunks.  Weights are worked out when first needed and kept with the state they leave, likewise bounded.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2 as model_file

from tradewind.llm.common import small_batches

MARK = "▁"
# Kinds of pieces in model files: fixed values of the format.
_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE = 1, 2, 3, 4, 6
_BPE = 2
#: Entries of the tables of chunks and of weights before they start afresh.
REMEMBERED = 400_000
_CHUNK_LETTERS = 64


def _cell(numbers: list[int]) -> bytes:
    return np.array(numbers, np.int32).tobytes()


class _Known(dict):
    """Chunks and their piece numbers; the numbers of one not listed are worked out."""

    def __init__(self, find: Callable[[str], bytes]) -> None:
        self.find = find

    def __missing__(self, chunk: str) -> bytes:
        ids = self.find(chunk)
        if len(chunk) <= _CHUNK_LETTERS:
            if len(self) > REMEMBERED:
                self.clear()
            self[chunk] = ids
        return ids


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("tradewind_each_byte", _each_byte)


class Transducer:
    def __init__(self, path: str) -> None:
        model = model_file.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules = model.normalizer_spec
        if model.trainer_spec.model_type != _BPE or not model.trainer_spec.byte_fallback:
            raise ValueError("only BPE models with byte fallback are compiled")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models that leave characters as they are, but for spaces, are compiled")
        if any(p.type == _USER for p in model.pieces):
            raise ValueError("pieces of the user's are not compiled")
        self.prefix = rules.add_dummy_prefix
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        self.scores = {p.piece: p.score for p in model.pieces if p.type == _NORMAL}
        self.byte_ids = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == _BYTE}
        self.letters = {c for piece in self.ids for c in piece}
        self.spelled = [self._spelled(p) for p in model.pieces]

        #: By piece, what is known of the arcs that leave it.
        self.fits: dict[str, dict[str, bool]] = {}
        self.n_fits = 0
        # A state: its length, the piece just written, the arcs that leave it, and its numbers.
        self.start = (0, "", {}, b"")
        self.pieces = ahocorasick.Automaton()
        for piece, number in self.ids.items():
            if self.merge(piece) == [piece]:
                self.pieces.add_word(piece, (len(piece), piece, self.fits.setdefault(piece, {}), _cell([number])))
        self.pieces.make_automaton()
        # Chunks may be cut before marks, around characters that no piece holds, and before signs that follow no letter.
        if any(MARK in piece.lstrip(MARK) for piece in self.ids):
            self.chunk = re.compile(r"(?s).+")
        else:
            alone = "".join(re.escape(c) for c in "\n\t\r" if c not in self.letters)
            signs = "".join(re.escape(c) for c in sorted(self._signs()))
            other = f"[^{MARK}{alone}{signs}]"
            kinds = [f"{MARK}?{other}+", *([f"{MARK}*[{signs}]+{other}*"] if signs else []), f"{MARK}+{other}*"]
            self.chunk = re.compile("|".join([*kinds, *([f"[{alone}]"] if alone else [])]))
        self.known = _Known(self._chunk_ids)

    def _signs(self) -> set[str]:
        """Characters but letters that no piece holds right after one that is neither of them nor the mark: merges never cross there.

        Those beyond 16 bits are left out, as a pattern compares them one by one.
        """
        follows = {(a, b) for piece in self.ids for a, b in zip(piece, piece[1:])}
        signs = {c for c in self.letters if not c.isalpha() and c != MARK and ord(c) < 1 << 16}
        while crossed := {b for a, b in follows if b in signs and a not in signs and a != MARK}:
            signs -= crossed
        return signs

    @staticmethod
    def _spelled(piece) -> bytes:  # noqa: ANN001
        if piece.type == _BYTE:
            return bytes([int(piece.piece[1:-1], 16)])
        if piece.type == _CONTROL:
            return b""
        if piece.type == _UNKNOWN:
            return " ⁇ ".encode()
        return piece.piece.encode()

    def merge(self, text: str) -> list[str]:
        """Pieces by merging, best score first, leftmost among equals: what arcs are weighed by."""
        parts, score, none = list(text), self.scores.get, -float("inf")
        found = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while found and (best := max(found)) != none:
            at = found.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del found[at]
            if at:
                found[at - 1] = score(parts[at - 1] + parts[at], none)
            if at < len(found):
                found[at] = score(parts[at] + parts[at + 1], none)
        return parts

    def _open(self, before: str, piece: str) -> bool:
        """Whether the arc from one piece to the next weighs nothing."""
        arcs = self.fits.setdefault(before, {})
        found = arcs.get(piece)
        if found is None:
            if self.n_fits > REMEMBERED:
                for some in self.fits.values():
                    some.clear()
                self.n_fits = 0
            found = arcs[piece] = self.merge(before + piece) == [before, piece]
            self.n_fits += 1
        return found

    def _spelling(self, letter: str) -> tuple[int, str, dict[str, bool], bytes]:
        """The state after a character that is written in bytes."""
        if letter in self.ids:
            raise ValueError(f"no path to {letter!r}")
        # Nothing merges with a character that no piece holds: it is left as the start is.
        arcs = self.fits.setdefault(letter, {}) if letter in self.letters else self.start[2]
        return 1, letter, arcs, _cell([self.byte_ids[b] for b in letter.encode()])

    def _states(self, chunk: str) -> list[tuple[int, str, dict[str, bool], bytes]]:
        """The states of the shortest path."""
        live, free, is_open = [self.start], self.start[2], self._open
        for end, state in self.pieces.iter(chunk):
            done = len(live) - 1
            if end < done:
                continue
            while done < end:
                live.append(self._spelling(chunk[done]))
                done += 1
            before = live[end + 1 - state[0]]
            arcs = before[2]
            if arcs is free or (f := arcs.get(state[1])) or (f is None and is_open(before[1], state[1])):
                live.append(state)
        for letter in chunk[len(live) - 1 :]:
            live.append(self._spelling(letter))
        out, at = [], len(chunk)
        while at:
            out.append(live[at])
            at -= live[at][0]
        return out[::-1]

    def path(self, chunk: str) -> list[str]:
        """The pieces of the shortest path, single characters where bytes are written."""
        return [state[1] for state in self._states(chunk)]

    def _chunk_ids(self, chunk: str) -> bytes:
        return b"".join([state[3] for state in self._states(chunk)])

    def encode(self, text: str) -> bytes:
        """Piece numbers of a text as 32-bit integers."""
        if not text:
            return b""
        plain = text.replace(" ", MARK)
        return b"".join(map(self.known.__getitem__, self.chunk.findall(MARK + plain if self.prefix else plain)))

    def decode(self, ids: list[int]) -> str:
        """The text that pieces spell; bytes that spell no character become replacement characters."""
        spelled = b"".join(map(self.spelled.__getitem__, ids)).decode(errors="tradewind_each_byte").replace(MARK, " ")
        return spelled[1:] if self.prefix and spelled.startswith(" ") else spelled


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def encode(docs: DataFrame, model: str, check: bool = True) -> DataFrame:
    """``docs`` without ``text``, with ``piece_ids`` (array<int>), ``n_pieces`` and ``lossless``.

    ``model`` is a path every executor has, as installed with the library.  A NULL or
    empty text has no pieces.  ``lossless`` says whether decoding gives the text back,
    which marks already in the text prevent; without ``check`` it is left out.  Repeated rows
    are encoded each; an empty table gives no rows; other columns stay, and one named
    like a new column is replaced.
    """
    small_batches(docs.sparkSession)
    added = ["piece_ids", "n_pieces", "lossless"][: 2 + check]
    kept = [c for c in docs.columns if c != "text" and c not in added]
    fields = [docs.schema[c] for c in kept]
    new = [T.StructField("piece_ids", T.ArrayType(T.IntegerType())), T.StructField("n_pieces", T.LongType())]
    new += [T.StructField("lossless", T.BooleanType())] if check else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            cells = [machine.encode(t) for t in texts]
            sizes = np.array([len(c) // 4 for c in cells], np.int64)
            offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            flat = np.frombuffer(b"".join(cells), np.int32)
            columns = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(sizes)]
            if check:
                same = [machine.decode(np.frombuffer(c, np.int32).tolist()) == t for c, t in zip(cells, texts, strict=True)]
                columns.append(pa.array(same, pa.bool_()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns], [*kept, *added])

    return docs.select(*kept, "text").mapInArrow(run, T.StructType(fields + new))


def decode(rows: DataFrame, model: str) -> DataFrame:
    """``rows`` with ``text`` spelled by ``piece_ids`` (array<int>) in place of it; NULL ids give NULL.

    Ids without a piece raise an error.  Other columns stay.
    """
    small_batches(rows.sparkSession)
    kept = [c for c in rows.columns if c not in ("piece_ids", "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model)
        for batch in batches:
            texts = [None if ids is None else machine.decode(ids) for ids in batch.column("piece_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.string())], [*kept, "text"])

    fields = [rows.schema[c] for c in kept]
    return rows.select(*kept, "piece_ids").mapInArrow(run, T.StructType([*fields, T.StructField("text", T.StringType())]))
