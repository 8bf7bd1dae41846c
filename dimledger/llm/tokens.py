"""Token ids of whole texts, by batches, through tables of pieces.

Texts are cut at points that the tokenizer can never join characters across,
so the ids of a text are the ids of its pieces one after the other. Words
repeat, so each worker asks the library for every distinct piece once and
keeps a bounded table of the answers.
"""

from __future__ import annotations

import os
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MAX_PIECES = 400_000     # pieces kept per worker between batches: some 200 bytes each
ASKED = 256              # pieces in one call of the library: its objects stay few and near

# Kinds of bytes; bytes of unknown kind are never cut from their neighbours.
UNKNOWN, LETTER, DIGIT, VISIBLE, APOSTROPHE, SPACE, BLANK = range(7)
KINDS = np.full(256, UNKNOWN, np.uint8)
KINDS[33:127] = VISIBLE
KINDS[9:14] = SPACE
KINDS[48:58] = DIGIT
KINDS[65:91] = KINDS[97:123] = LETTER
KINDS[32], KINDS[39] = BLANK, APOSTROPHE
LETTER_LEADS = np.zeros(256, bool)
LETTER_LEADS[[0xC3, 0xC4, 0xC5, 0xD0, 0xD1]] = True


def led_by_space(texts: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(pa.scalar(""), pc.fill_null(texts, ""), " ")


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(offsets, bytes)`` of a batch of strings."""
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], width)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return offsets - offsets[0], raw


class PieceTable:
    """Ids of batches of texts; a subclass says where to cut and asks its library."""

    def __init__(self, max_pieces: int = MAX_PIECES):
        self.max_pieces = max_pieces
        self.places: dict[bytes, int] = {}
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.flat = np.zeros(0, "<u4")

    def cuts(self, raw: np.ndarray) -> np.ndarray:
        """Marks of the bytes before which a text may be cut."""
        raise NotImplementedError

    def ask(self, pieces: list[str]) -> list[list[int]]:
        """Ids of each piece."""
        raise NotImplementedError

    def _keep(self, pieces: list[bytes], place: np.ndarray) -> None:
        """Forget all pieces but these, which are at ``place``."""
        sizes = self.sizes[place]
        starts = np.cumsum(sizes) - sizes
        self.flat = self.flat[np.arange(int(sizes.sum())) + np.repeat(self.starts[place] - starts, sizes)]
        self.places = dict(zip(pieces, range(len(pieces)), strict=True))
        self.starts, self.sizes = starts, sizes

    def _places(self, distinct: list[bytes]) -> np.ndarray:
        """Numbers of pieces in the table; new ones are asked for and added. A
        full table keeps those of the present batch: they are mostly the common
        ones, and what it drops are mostly words met once."""
        place = np.fromiter(map(self.places.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(place < 0)
        if len(new) and len(self.places) + len(new) > self.max_pieces:
            known = np.flatnonzero(place >= 0)
            self._keep([distinct[k] for k in known.tolist()], place[known])
            place[known] = np.arange(len(known))
        if len(new):
            missing = [distinct[k] for k in new.tolist()]
            got = self.ask([p.decode() for p in missing])
            sizes = np.fromiter(map(len, got), np.int64, len(got))
            ids = np.fromiter(chain.from_iterable(got), "<u4", int(sizes.sum()))
            place[new] = np.arange(len(self.sizes), len(self.sizes) + len(new))
            self.places.update(zip(missing, place[new].tolist(), strict=True))
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.flat = np.concatenate([self.flat, ids])
        return place

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(offsets, ids)`` of a batch: the ids of text i are
        ``ids[offsets[i]:offsets[i + 1]]``. NULL is the empty text."""
        offsets, raw = text_bytes(pc.fill_null(texts, ""))
        if not len(raw):
            return np.zeros(len(texts) + 1, np.int64), np.empty(0, "<u4")
        mark = self.cuts(raw)
        mark[offsets[:-1][offsets[:-1] < len(raw)]] = True
        begins = np.flatnonzero(mark)
        bounds = np.append(begins, len(raw)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(bounds), pa.py_buffer(raw)])
        coded = pieces.dictionary_encode()
        place = self._places(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
        sizes = self.sizes[place]
        ends = np.cumsum(sizes)
        width = np.int32 if max(int(ends[-1]), len(self.flat)) < 1 << 31 else np.int64
        index = np.arange(int(ends[-1]), dtype=width)
        index += np.repeat((self.starts[place] - (ends - sizes)).astype(width), sizes)
        return np.append(0, ends)[np.searchsorted(begins, offsets)], self.flat[index]


class ByteBpe(PieceTable):
    """A byte-level BPE of the tokenizers library.

    Its pattern never joins letters, digits, other visible characters and white
    space, but for one blank before a run and the letters of a contraction
    after an apostrophe. So a text may be cut between two ASCII characters (or
    letters of two bytes) of different kinds, but not after a blank, after
    several spaces or between an apostrophe and a letter. ``plain`` makes the strings of added tokens
    ordinary text; otherwise texts that hold one are encoded whole.
    """

    def __init__(self, path: str, plain: bool, max_pieces: int = MAX_PIECES):
        super().__init__(max_pieces)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.added = [] if plain else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def cuts(self, raw: np.ndarray) -> np.ndarray:
        kind = KINDS[raw]
        # Latin and Cyrillic letters of two bytes, but for the signs for times and divided.
        lead = np.flatnonzero(LETTER_LEADS[raw[:-1]])
        lead = lead[~((raw[lead] == 0xC3) & ((raw[lead + 1] & 0xDF) == 0x97))]
        kind[lead] = kind[lead + 1] = LETTER
        before, after = kind[:-1], kind[1:]
        out = np.zeros(len(raw), dtype=bool)
        out[1:] = ((before != after) & (before != BLANK) & (before != UNKNOWN) & (after != UNKNOWN)
                   & ~((before == VISIBLE) & (after == APOSTROPHE))
                   & ~((before == APOSTROPHE) & ((after == VISIBLE) | (after == LETTER)))
                   & ~((before == SPACE) & (after == BLANK)))
        # The last of several spaces falls to the run after them: cut after a lone one only.
        alone = np.ones(len(before), dtype=bool)
        alone[1:] = (kind[:-2] != SPACE) & (kind[:-2] != BLANK) & (kind[:-2] != UNKNOWN)
        out[1:] &= (before != SPACE) | alone
        return out

    def ask(self, pieces: list[str]) -> list[list[int]]:
        return [e.ids for k in range(0, len(pieces), ASKED)
                for e in self.tokenizer.encode_batch_fast(pieces[k:k + ASKED], add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        held = np.zeros(len(texts), dtype=bool)
        for token in self.added:
            held |= pc.fill_null(pc.match_substring(texts, token), False).to_numpy(zero_copy_only=False)
        if not held.any():
            return super().encode(texts)
        offsets, ids = super().encode(pc.if_else(pa.array(held), "", texts))
        parts = [ids[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        for k in np.flatnonzero(held).tolist():
            parts[k] = np.array(self.tokenizer.encode(texts[k].as_py(), add_special_tokens=False).ids, "<u4")
        return np.append(0, np.cumsum([len(p) for p in parts])), np.concatenate(parts)

    def token_bytes(self) -> list[bytes]:
        """Bytes of each id: every byte stands as one visible character."""
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(visible)]
        byte_of = {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}
        tokens = [self.tokenizer.id_to_token(i) for i in range(self.tokenizer.get_vocab_size())]
        return [bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for t in tokens]


class PieceBpe(PieceTable):
    """A BPE of the sentencepiece library that puts a blank before a text; texts
    come with that blank (``led_by_space``).

    No piece of the vocabulary has a blank after another character, or a line
    feed beside any, so a text may be cut before a blank that follows another
    character and before a line feed.
    """

    def __init__(self, path: str, max_pieces: int = MAX_PIECES):
        super().__init__(max_pieces)
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        if any("▁" in p.lstrip("▁") or "\n" in p for p in pieces):
            raise ValueError("pieces of this vocabulary go across blanks or line feeds")
        self.blank = self.model.piece_to_id("▁")

    def cuts(self, raw: np.ndarray) -> np.ndarray:
        out = raw == 10
        out[1:] |= (raw[1:] == 32) & (raw[:-1] != 32)
        return out

    def ask(self, pieces: list[str]) -> list[list[int]]:
        # The library adds the blank; before a line feed it stands alone and goes.
        got = self.model.encode([p[1:] if p[0] == " " else p for p in pieces], num_threads=1)
        return [[self.blank] if p == " " else ids if p[0] == " " else ids[1:]
                for p, ids in zip(pieces, got, strict=True)]

    def token_bytes(self) -> list[bytes]:
        out = []
        for i in range(self.model.vocab_size()):
            piece = self.model.id_to_piece(i)
            out.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())
        return out


_ENCODERS: dict[tuple, PieceTable] = {}


def encoder(kind: type[PieceTable], *args) -> PieceTable:
    """One encoder per worker process, kind and vocabulary file."""
    if (kind, args) not in _ENCODERS:
        _ENCODERS[(kind, args)] = kind(*args)
    return _ENCODERS[(kind, args)]
